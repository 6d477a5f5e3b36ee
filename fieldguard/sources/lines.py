"""Reading finished log lines, and sinks that only ever see what a transform released."""

from __future__ import annotations

from collections.abc import Callable

from pyspark import StorageLevel
from pyspark.sql import DataFrame, SparkSession

from ..config import ScanConfig
from ..operators.lines import redact_lines


def spread(df: DataFrame) -> DataFrame:
    """The rows of a source of fewer files than tasks, dealt over all tasks; others as they are. A file of one row group is
    read by one task, and masking a row costs far more than moving it."""
    n = df.sparkSession.sparkContext.defaultParallelism
    return df.repartition(n) if len(df.inputFiles()) < n else df


def read_redacted_lines(spark: SparkSession, path: str, config: ScanConfig = ScanConfig(), stream: bool = False) -> DataFrame:
    """(value): the lines of text files, redacted."""
    reader = spark.readStream if stream else spark.read
    return redact_lines(reader.text(path), "value", config)


def redacting_sink(transform: Callable[[DataFrame], DataFrame], write: Callable[[DataFrame, int], None], host: Callable[[DataFrame], DataFrame] | None = None):
    """A foreachBatch function: the host's own step first, the redaction last, then write. Where the host's step raises, be it
    when its plan is made or when its rows flow, or returns no frame, the batch is redacted as it came.

    The host's frame is kept (in memory and on disk) once it is made, so what fails in it fails before anything is written, and
    its step runs once.
    """
    def run(batch: DataFrame, epoch: int) -> None:
        shown = kept = None
        if host is not None:
            try:
                shown = host(batch)
                if isinstance(shown, DataFrame):
                    kept = shown.persist(StorageLevel.MEMORY_AND_DISK)
                    kept.write.format("noop").mode("overwrite").save()
            except Exception:
                shown = None
        try:
            write(transform(shown if isinstance(shown, DataFrame) else batch), epoch)
        finally:
            if kept is not None:
                kept.unpersist()

    return run
