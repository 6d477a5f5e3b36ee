"""Helpers shared by the training-data operators."""

from __future__ import annotations

import atexit
import ctypes
import tempfile
import uuid
from collections.abc import Callable, Iterable, Iterator

import numpy as np
import pyarrow as pa
import pyarrow.compute as pc
from pyspark.sql import Column, DataFrame, SparkSession
from pyspark.sql import functions as F

#: Rows, and bytes of strings, handled together inside a Python worker; they bound what one step holds beside its input batch.
SLICE_ROWS = 512
SLICE_BYTES = 2 << 20


def load(spark: SparkSession, sf_dir: str, table: str) -> DataFrame:
    """A table; rows of fewer files than tasks are dealt over all tasks, as a file of one row group is read by one."""
    df = spark.read.parquet(f"{sf_dir}/{table}.parquet")
    n = spark.sparkContext.defaultParallelism
    return df.repartition(n) if len(df.inputFiles()) < n else df


def text_bytes(name: str = "text") -> Column:
    """The UTF-8 bytes of a text column; null counts as empty."""
    return F.coalesce(F.col(name), F.lit("")).cast("binary")


def shared_root(spark: SparkSession) -> str:
    """The folder that driver and executors share: spark.checkpoint.dir, or in local mode a temporary one where it is unset."""
    root = spark.conf.get("spark.checkpoint.dir", None) or spark.sparkContext.getConf().get("spark.checkpoint.dir")
    if not root:
        current = spark.sparkContext._jsc.sc().getCheckpointDir()
        if current.isDefined():
            return current.get()
        if not spark.sparkContext.master.startswith("local[") and spark.sparkContext.master != "local":
            raise ValueError("spark.checkpoint.dir must name a folder that the driver and all executors share")
        root = "file://" + tempfile.mkdtemp(prefix="fieldguard-")
        spark.sparkContext.setCheckpointDir(root)
    return root


def _remove(spark: SparkSession, path: str) -> None:
    try:
        jvm = spark.sparkContext._jvm
        where = jvm.org.apache.hadoop.fs.Path(path)
        where.getFileSystem(spark.sparkContext._jsc.hadoopConfiguration()).delete(where, True)
    except Exception:  # the session is gone; the folder belongs to the application
        pass


#: Narrow rows in a file of an intermediate table.
FILE_ROWS = 250_000


def compact(df: DataFrame, rows: int) -> DataFrame:
    """df in as many partitions as files of at most rows narrow rows in all need, where it has more."""
    return df.coalesce(max(1, -(-rows // FILE_ROWS)))


_WRITTEN: dict[int, tuple[DataFrame, str]] = {}


def materialize(df: DataFrame) -> DataFrame:
    """Write df once to the shared folder and read it back: cuts lineage and survives lost executors."""
    spark = df.sparkSession
    path = f"{shared_root(spark)}/fieldguard-{uuid.uuid4().hex}"
    df.write.parquet(path)
    out = spark.read.schema(df.schema).parquet(path)
    _WRITTEN[id(out)] = out, path
    atexit.register(_remove, spark, path)
    return out


def discard(df: DataFrame) -> None:
    """Remove the files of a materialized df that nothing reads any more; without effect on others."""
    written = _WRITTEN.pop(id(df), None)
    if written:
        _remove(df.sparkSession, written[1])


def partitions_for(spark: SparkSession, n_bytes: int, target: int = 32 << 20) -> int:
    """Enough shuffle partitions that each gets at most about target bytes."""
    return max(int(spark.conf.get("spark.sql.shuffle.partitions")), -(-n_bytes // target))


_CACHES: dict[str, Callable[[], None]] = {}


def claim(name: str, clear: Callable[[], None]) -> None:
    """Says that an operator starts to fill its worker's caches; those of all other operators are emptied first."""
    for other in [n for n in _CACHES if n != name]:
        _CACHES.pop(other)()
    _CACHES[name] = clear


def tidy() -> None:
    """Gives memory that a worker has freed back to the machine, where idle workers would keep it."""
    pa.default_memory_pool().release_unused()
    try:
        ctypes.CDLL(None).malloc_trim(0)
    except (AttributeError, OSError):  # another C library
        pass


def tidied(run: Callable) -> Callable:
    """An mapInArrow function that tidies up when its task's rows are done."""
    def whole(batches: Iterator[pa.RecordBatch]) -> Iterator[pa.RecordBatch]:
        try:
            yield from run(batches)
        finally:
            tidy()

    return whole


def slices(batches: Iterable[pa.RecordBatch], rows: int = SLICE_ROWS, most: int = SLICE_BYTES) -> Iterator[pa.RecordBatch]:
    """Batches cut into parts of at most so many rows and about so many bytes; a longer row is a part of its own."""
    for batch in batches:
        size = np.zeros(batch.num_rows, np.int64)
        for column in batch.columns:
            if pa.types.is_string(column.type) or pa.types.is_binary(column.type):
                size += pc.fill_null(pc.binary_length(column), 0).to_numpy(zero_copy_only=False)
        at = 0
        upto = np.cumsum(size)
        while at < batch.num_rows:
            before = upto[at - 1] if at else 0
            n = int(np.searchsorted(upto[at : at + rows], before + most, "right"))
            n = max(1, n)
            yield batch.slice(at, n)
            at += n


def by_rows(fn: Callable[[dict[str, list]], dict[str, Iterable]], schema: pa.Schema) -> Callable:
    """An mapInArrow function from one on column lists, called for a slice of bounded rows and bytes at a time."""

    def run(batches: Iterator[pa.RecordBatch]) -> Iterator[pa.RecordBatch]:
        for part in slices(batches):
            out = fn({n: part.column(i).to_pylist() for i, n in enumerate(part.schema.names)})
            yield pa.RecordBatch.from_arrays([pa.array(out[f.name], f.type) for f in schema], schema=schema)

    return tidied(run)


def ship_file(spark: SparkSession, path: str, most: int = 16 << 20):
    """A broadcast of a small file's bytes, so that executors need no copy of the file."""
    with open(path, "rb") as f:
        raw = f.read(most + 1)
    if len(raw) > most:
        raise ValueError(f"{path} has over {most} bytes, too many to broadcast")
    return spark.sparkContext.broadcast(raw)


#: Edges that one task contracts to stars.
CONTRACTED = 1 << 18


def _contract(batches: Iterator[pa.RecordBatch]) -> Iterator[pa.RecordBatch]:
    """The components of a task's own edges as stars (u, v) around their smallest nodes, by union-find."""
    up: dict[int, int] = {}

    def root(x: int) -> int:
        top = x
        while (nxt := up.setdefault(top, top)) != top:
            top = nxt
        while up[x] != top:
            up[x], x = top, up[x]
        return top

    for batch in batches:
        for u, v in zip(batch.column(0).to_pylist(), batch.column(1).to_pylist()):
            a, b = root(u), root(v)
            up[max(a, b)] = min(a, b)
    leaves = [x for x in up if root(x) != x]
    yield pa.RecordBatch.from_arrays([pa.array(leaves, pa.int64()), pa.array([root(x) for x in leaves], pa.int64())], names=["u", "v"])


def connected_components(edges: DataFrame, a: str = "a", b: str = "b") -> DataFrame:
    """(node, component): the smallest node reachable over undirected edges, for every node in edges.

    Tasks first contract CONTRACTED edges each to stars. Where one task had them all these are the components; else
    large-star and small-star steps alternate, each linear in the number of edges, until the edges are stars
    around their smallest nodes. Nodes without edges do not appear. Null ends are ignored.
    """
    e = materialize(edges.select(F.greatest(a, b).cast("long").alias("u"), F.least(a, b).cast("long").alias("v")).where(f"{a} is not null and {b} is not null and {a} != {b}"))
    tasks = max(1, -(-e.count() // CONTRACTED))
    before, e = e, materialize(e.repartition(tasks).mapInArrow(_contract, "u long, v long"))
    discard(before)
    while tasks > 1:
        # large star: every larger neighbour of a node goes to the smallest of its neighbourhood
        both = e.union(e.select(F.col("v").alias("u"), F.col("u").alias("v")))
        low = both.groupBy("u").agg(F.min("v").alias("low")).withColumn("low", F.least("low", "u"))
        large = both.join(low, "u").where("v > u").select(F.col("v").alias("u"), F.col("low").alias("v")).where("u != v")
        # small star: every smaller neighbour, and the node, go to the smallest
        low = large.groupBy("u").agg(F.min("v").alias("low"))
        small = large.join(low, "u").select(F.col("v").alias("u"), F.col("low").alias("v")).where("u != v").union(low.select("u", F.col("low").alias("v")))
        before, e = e, materialize(small.distinct())
        discard(before)
        # stars: no node is a leaf and a centre, and no leaf has two centres
        ends = e.select(F.col("u").alias("n"), F.lit(1).alias("leaf")).union(e.select(F.col("v").alias("n"), F.lit(0).alias("leaf")))
        if ends.groupBy("n").agg(F.min("leaf").alias("x"), F.max("leaf").alias("y"), F.sum("leaf").alias("k")).where("x != y or k > 1").isEmpty():
            break
    return e.select(F.col("u").alias("node"), F.col("v").alias("component")).union(e.select(F.col("v").alias("node"), F.col("v").alias("component")).distinct())
