"""A processor of micro-batches between a host's stream and its exporter: redacted in front, lifecycle passed on."""

from __future__ import annotations

import warnings
from collections.abc import Callable

from pyspark.sql import DataFrame, Observation
from pyspark.sql import functions as F

from ..constants import COUNTS


class RedactingProcessor:
    """A foreachBatch function. transform adds a column outcome with values (the six counts) and dropped; write exports
    what isn't dropped, and is asked once for flush and shutdown where it has them.

    A batch is masked once: its counts are observed while write runs its one action over the frame. Outcomes reach notify
    after the export: (epoch, units, dropped, counts). Neither notify nor a failing flush changes
    what is exported; dropped units are warned of once. After shutdown batches are discarded.
    """

    def __init__(self, transform: Callable[[DataFrame], DataFrame], write: Callable[[DataFrame, int], None], notify: Callable | None = None):
        if not callable(transform) or not callable(write):
            raise TypeError("transform and write must be functions")
        self.transform, self.write, self.notify = transform, write, notify
        self.closed = self.warned = False

    @property
    def enabled(self) -> bool:
        return not self.closed

    def __call__(self, batch: DataFrame, epoch: int) -> None:
        if self.closed:
            return
        masked = self.transform(batch)
        values, seen = masked["outcome"]["values"], Observation(f"processor-{epoch}")
        # the counts are taken while the one pass that exports runs; dropped units are seen before they are left out
        counted = masked.observe(seen, F.count(F.lit(1)).alias("units"), F.count_if(masked["outcome"]["dropped"]).alias("dropped"), *[F.sum(values[k]).alias(k) for k in COUNTS])
        self.write(counted.where(~F.col("outcome.dropped")).drop("outcome"), epoch)
        totals = seen.get
        if totals["dropped"] and not self.warned:
            self.warned = True
            warnings.warn("units that could not be redacted were dropped", stacklevel=2)
        if self.notify is not None:
            try:
                self.notify(epoch, totals["units"], totals["dropped"], {k: totals[k] or 0 for k in COUNTS})
            except Exception:
                pass  # an observer never changes what is exported

    def _ask(self, name: str) -> None:
        step = getattr(self.write, name, None)
        if callable(step):
            step()

    def force_flush(self) -> None:
        if not self.closed:
            self._ask("flush")

    def shutdown(self) -> None:
        """Passed on once; later batches and calls have no effect."""
        if not self.closed:
            self.closed = True
            self._ask("shutdown")
