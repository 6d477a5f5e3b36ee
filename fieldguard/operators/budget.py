"""Operation budgets as prefix sums, and outcome counts as sums.

Charges are never negative, so a budget that stays exhausted once it is exceeded allows exactly the leaves whose
inclusive running sums stay within every limit.
"""

from __future__ import annotations

from pyspark.sql import Column, DataFrame, Window
from pyspark.sql import functions as F

from ..constants import COUNTS, OPERATION_LIMITS, resolve_limits

#: Usage counters by the limit that holds them.
USAGE = {"bytes": "max_bytes", "nodes": "max_nodes", "keys": "max_keys", "leaves": "max_leaves", "scans": "max_scans", "findings": "max_findings"}
#: Rows of an operation that are summed up in one task; the ranges of a larger one are summed up apart.
ROWS = 100_000


def running_sums(df: DataFrame, op: str, ordinal: str, costs: dict[str, Column], rows: int = ROWS) -> DataFrame:
    """df with used_<counter>, inclusive running sums of the costs in ordinal order, for each operation.

    An operation of over rows rows is cut into ranges of its ordinals, equal in width: the sums of whole ranges come first,
    and a range's rows start from those before it, so no task has more than its share where ordinals are spread evenly. How
    many such operations there are is counted when the plan is made. ordinal is a number, null before all.
    """
    sizes = df.groupBy(F.col(op).alias("fg_op")).agg(F.count("*").alias("n"), F.min(F.col(ordinal).cast("double")).alias("least"), F.max(F.col(ordinal).cast("double")).alias("most")).where(F.col("n") > rows)
    large = sizes.count()
    within = lambda *parts: Window.partitionBy(*parts).orderBy(F.asc_nulls_first(ordinal)).rowsBetween(Window.unboundedPreceding, Window.currentRow)
    if not large:  # dealt by the operation alone, so that grouping by it deals nothing again
        return df.withColumns({f"used_{k}": F.sum(c.cast("long")).over(within(op)) for k, c in costs.items()})
    order = within(op, "fg_range")
    share = (F.col(ordinal).cast("double") - F.col("least")) / F.greatest(F.col("most") - F.col("least"), F.lit(1.0))
    range_ = F.coalesce(F.floor(share * F.ceil(F.col("n") / rows)), F.lit(0)).cast("long")
    named = df.join(F.broadcast(sizes) if large <= 10_000 else sizes, F.col(op).eqNullSafe(F.col("fg_op")), "left").withColumn("fg_range", range_).drop("fg_op", "n", "least", "most")
    named = named.withColumns({f"fg_cost_{k}": c.cast("long") for k, c in costs.items()})
    sums = named.groupBy(F.col(op).alias("fg_op"), F.col("fg_range").alias("fg_at")).agg(*[F.sum(f"fg_cost_{k}").alias(f"fg_sum_{k}") for k in costs])
    earlier = Window.partitionBy("fg_op").orderBy("fg_at").rowsBetween(Window.unboundedPreceding, -1)
    starts = sums.select("fg_op", "fg_at", *[F.coalesce(F.sum(f"fg_sum_{k}").over(earlier), F.lit(0)).alias(f"fg_start_{k}") for k in costs])
    out = named.withColumns({f"used_{k}": F.sum(f"fg_cost_{k}").over(order) for k in costs})
    out = out.join(starts, F.col(op).eqNullSafe(F.col("fg_op")) & (F.col("fg_range") == F.col("fg_at")))
    out = out.withColumns({f"used_{k}": F.col(f"used_{k}") + F.col(f"fg_start_{k}") for k in costs})
    return out.select(*df.columns, *[f"used_{k}" for k in costs])


def charge(df: DataFrame, op: str, ordinal: str, costs: dict[str, Column], limits: dict | None = None, rows: int = ROWS) -> DataFrame:
    """df with allowed, and used_<counter> (running sums per operation) for each of the costs given."""
    most = resolve_limits(limits, OPERATION_LIMITS)
    out, allowed = running_sums(df, op, ordinal, costs, rows), F.lit(True)
    for k in costs:
        allowed = allowed & (F.col(f"used_{k}") <= most[USAGE[k]])
    return out.withColumn("allowed", allowed)


def usage(charged: DataFrame, op: str, costs: dict[str, Column]) -> DataFrame:
    """What each operation spent: the sums over its allowed leaves."""
    return charged.groupBy(op).agg(*[F.sum(F.when(F.col("allowed"), c).otherwise(0)).cast("long").alias(k) for k, c in costs.items()])


def digest(text: Column) -> Column:
    """What stands for a text where texts are compared across rows, so that no text is shuffled."""
    return F.unhex(F.sha2(text, 256))


def first_of_text(df: DataFrame, op: str, ordinal: str, text: str, longest: int = 1024, most: int | None = None) -> DataFrame:
    """df with scanned: whether a row's text is scanned, as the first of its operation with that text (of rows with one
    ordinal, each); repeats of texts of up to longest characters are remembered, of at most the most texts seen first.

    First places are least ordinals of (operation, digest), combined before they are shuffled, and join on the place as well, so
    a text that very many rows share is no hot key."""
    own = df.withColumn("fg_digest", F.when(F.length(text) <= longest, digest(F.col(text))))
    first = own.where("fg_digest is not null").groupBy(F.col(op).alias("fg_op"), F.col("fg_digest").alias("fg_of")).agg(F.min(ordinal).alias("fg_first"))
    if most is not None:
        first = first.withColumn("fg_known", F.row_number().over(Window.partitionBy("fg_op").orderBy("fg_first", "fg_of")) <= most)
        kept = first.where("fg_known")
        is_known = own.join(kept.select("fg_op", "fg_of", "fg_first"), F.col(op).eqNullSafe(F.col("fg_op")) & (F.col("fg_digest") == F.col("fg_of")), "left")
        return is_known.withColumn("scanned", F.col("fg_first").isNull() | (F.col("fg_first") == F.col(ordinal))).select(*df.columns, "scanned")
    found = own.join(first, F.col(op).eqNullSafe(F.col("fg_op")) & (F.col("fg_digest") == F.col("fg_of")) & (F.col(ordinal) == F.col("fg_first")), "left")
    return found.withColumn("scanned", F.col("fg_digest").isNull() | F.col("fg_first").isNotNull()).select(*df.columns, "scanned")


def scan_once(df: DataFrame, text: str, mask, out: str = "m", longest: int = 1024) -> DataFrame:
    """df with mask(text) in out, where texts of up to longest characters are masked once however often they occur.

    Worth its shuffle where texts repeat much: one text of each digest is masked and joined back by it, long texts are masked
    where they are. A text that very many rows share is one row on the other side, whose join Spark splits.
    """
    own = df.withColumn("fg_digest", F.when(F.length(text) <= longest, digest(F.col(text))))
    known = own.where("fg_digest is not null").groupBy(F.col("fg_digest").alias("fg_of")).agg(F.min(text).alias("fg_text")).select("fg_of", mask(F.col("fg_text")).alias("fg_masked"))
    joined = own.where("fg_digest is not null").join(known, F.col("fg_digest") == F.col("fg_of")).withColumn(out, F.col("fg_masked"))
    return joined.select(*df.columns, out).unionByName(own.where("fg_digest is null").withColumn(out, mask(F.col(text))).select(*df.columns, out))


def count_outcomes(df: DataFrame, leaf: str, *by: str) -> DataFrame:
    """The six counts over a column of masked leaves, for each group."""
    o, n = F.col(leaf)["outcome"], F.col(leaf)["findings"]
    counts = {"scanned": F.count_if(o.isNotNull() & (o != "limited")), "findings": F.coalesce(F.sum(n), F.lit(0)).cast("long")} | {k: F.count_if(o == k) for k in COUNTS[2:]}
    return df.groupBy(*by).agg(*[counts[k].alias(k) for k in COUNTS])


def add_counts(a: Column, b: Column) -> Column:
    """The sum of two structs of counts, field by field."""
    return F.struct(*[(a[k] + b[k]).alias(k) for k in COUNTS])


def observe_counts(df: DataFrame, leaf: str, name: str = "fieldguard"):
    """(df, Observation): the counts become readable after the first action on df."""
    from pyspark.sql import Observation

    seen = Observation(name)
    o, n = F.col(leaf)["outcome"], F.col(leaf)["findings"]
    return df.observe(seen, F.count_if(o.isNotNull() & (o != "limited")).alias("scanned"), F.sum(n).alias("findings"), *[F.count_if(o == k).alias(k) for k in COUNTS[2:]]), seen
