"""Reading back what a host has written: a unit whose written values aren't those that were released is dropped."""

from __future__ import annotations

from pyspark.sql import Column, DataFrame
from pyspark.sql import functions as F
from pyspark.sql import types as T


def reflects(released: Column, written: Column, t: T.DataType, truncated: bool = False) -> Column:
    """Whether written is what was released; truncated: texts, arrays and bags may have been cut by the host's own limits,
    never changed. Null stands for null alone."""
    if isinstance(t, T.StringType):
        same = released == written
        fine = same | released.startswith(written) if truncated else same
    elif isinstance(t, T.ArrayType):
        n = F.size(written)
        pairs = F.zip_with(F.slice(released, F.lit(1), F.greatest(n, F.lit(0))), written, lambda a, b: reflects(a, b, t.elementType, truncated))
        fine = (n <= F.size(released) if truncated else n == F.size(released)) & F.forall(pairs, lambda x: x)
    elif isinstance(t, T.MapType):
        n = F.size(written)
        known = F.forall(F.map_entries(written), lambda e: F.array_contains(F.map_keys(released), e["key"]) & reflects(F.try_element_at(released, e["key"]), e["value"], t.valueType, truncated))
        fine = (n <= F.size(released) if truncated else n == F.size(released)) & known
    elif isinstance(t, T.StructType):
        fine = F.lit(True)
        for f in t.fields:
            fine = fine & reflects(released[f.name], written[f.name], f.dataType, truncated)
    else:
        fine = released == written
    return F.when(released.isNull() | written.isNull(), released.isNull() & written.isNull()).otherwise(F.coalesce(fine, F.lit(False)))


def checked(released: DataFrame, written: DataFrame, key: str, *names: str, truncated: bool = False) -> DataFrame:
    """written with dropped: whether one of the named columns isn't what was released under the row's key. Rows that were
    never released are dropped. One equi-join by key."""
    own = released.select(F.col(key).alias("fg_key"), *[F.col(n).alias(f"fg_{n}") for n in names])
    fine = F.col("fg_key").isNotNull()
    for n in names:
        fine = fine & reflects(F.col(f"fg_{n}"), F.col(n), released.schema[n].dataType, truncated)
    out = written.join(own, F.col(key) == F.col("fg_key"), "left").withColumn("dropped", ~fine)
    return out.drop("fg_key", *[f"fg_{n}" for n in names])
