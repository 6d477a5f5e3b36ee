"""Staged streams in Structured Streaming: chunks wait in keyed state until their finalize and all before it are there.

State holds chunks and places alone; a stream that is complete leaves it as one text, which the plan behind scans.
"""

from __future__ import annotations

from collections.abc import Iterator

import pandas as pd
from pyspark.sql import DataFrame
from pyspark.sql import functions as F
from pyspark.sql.streaming.state import GroupState, GroupStateTimeout

from ..config import ScanConfig
from ..plans.context import sanitize_text

DONE = "stream_id long, outcome string, text string, reason string, code string"
STATE = "seqs array<long>, chunks array<string>, end long, closed boolean, units long"


def staged(df: DataFrame, config: ScanConfig = ScanConfig(), limits: dict | None = None, max_buffer: int = 1 << 20, idle: str = "10 minutes") -> DataFrame:
    """One outcome for each stream of rows (stream_id, seq, op, chunk), op in append, finalize, abort.

    Rows may arrive in any order: a finalize at seq n releases only when 0 to n - 1 are present. What comes after
    the outcome is discarded, a second finalize gives lifecycle. A buffer over max_buffer characters blocks; a
    stream idle for longer than idle is aborted.
    """
    millis = pd.Timedelta(idle).value // 1_000_000

    def step(key: tuple, batches: Iterator[pd.DataFrame], state: GroupState) -> Iterator[pd.DataFrame]:
        def out(outcome: str, text: str | None = None, reason: str | None = None, code: str | None = None) -> pd.DataFrame:
            return pd.DataFrame([[key[0], outcome, text, reason, code]], columns=["stream_id", "outcome", "text", "reason", "code"])

        seqs, chunks, end, closed, units = state.get if state.exists else ([], [], -1, False, 0)
        held = dict(zip(seqs, chunks))
        if state.hasTimedOut:
            state.remove()
            if not closed:
                yield out("aborted")
            return
        rows = pd.concat(list(batches)).sort_values("seq", kind="stable")
        for seq, op, chunk in zip(rows["seq"], rows["op"], rows["chunk"]):
            if closed:
                if op == "finalize":
                    yield out("blocked", reason="lifecycle")
                continue
            if op == "abort":
                closed, held = True, {}
                yield out("aborted")
            elif op == "finalize":
                end = int(seq) if end < 0 else end
            elif int(seq) not in held:
                held[int(seq)] = chunk or ""
                units += len(chunk or "")
                if units > max_buffer:
                    closed, held = True, {}
                    yield out("blocked", reason="limit_exceeded", code="BUFFER_LIMIT_EXCEEDED")
        if not closed and end >= 0 and all(i in held for i in range(end)):
            whole = "".join(held[i] for i in range(end))
            closed, held = True, {}
            yield out("ok", whole)
        state.update((list(held), list(held.values()), end, closed, units))
        state.setTimeoutDuration(millis)

    done = df.groupBy("stream_id").applyInPandasWithState(step, DONE, STATE, "append", GroupStateTimeout.ProcessingTimeTimeout)
    whole = done.withColumn("fg_o", F.when(F.col("outcome") == "ok", sanitize_text(F.col("text"), None, config, limits)))
    decided = lambda c, own: F.when(F.col("fg_o").isNotNull(), F.col(f"fg_o.{c}")).otherwise(own).alias(c)
    return whole.select("stream_id", decided("outcome", F.col("outcome")), decided("value", F.lit(None).cast("string")), decided("reason", F.col("reason")), decided("code", F.col("code")))
