"""Which personal-data selectors are active, read from an identity such as credentials=full;selectors=a,b."""

from __future__ import annotations

from pyspark.sql import Column, SparkSession
from pyspark.sql import functions as F


class ActivationError(RuntimeError):
    def __init__(self, code: str):
        super().__init__(code)
        self.code = code


def active_selectors(identity: Column) -> Column:
    """The active selectors, an empty array for off, empty or no field."""
    field = F.coalesce(F.try_element_at(F.str_to_map(identity, F.lit(";"), F.lit("=")), F.lit("selectors")), F.lit(""))
    none = F.expr("cast(array() as array<string>)")
    return F.when(field.isin("", "off"), none).otherwise(F.array_sort(F.array_distinct(F.split(field, ","))))


def reflects(identity: Column, requested: list[str]) -> Column:
    """Every requested selector is active; an empty request requires that none is."""
    active = active_selectors(identity)
    if not requested:
        return F.size(active) == 0
    out = F.lit(True)
    for r in requested:
        out = out & F.array_contains(active, r)
    return out


_KEY = "spark.fieldguard.activation"


def activate(spark: SparkSession, pii: list[str] | None = None) -> str:
    """Record the session's selection once; another one later is a conflict, none accepts what is there."""
    current = spark.conf.get(_KEY, None)
    if pii is None:
        return current or "credentials=full;selectors=off"
    wanted = "credentials=full;selectors=" + (",".join(sorted(set(pii))) or "off")
    if current is not None and current != wanted:
        raise ActivationError("PII_ACTIVATION_CONFLICT")
    spark.conf.set(_KEY, wanted)
    return wanted


def read_activation(spark: SparkSession) -> str | None:
    """The identity that the session was activated with, None before."""
    return spark.conf.get(_KEY, None)


def is_conflict(error: BaseException) -> bool:
    """Whether an error is that of a second, different selection, by its code alone."""
    return getattr(error, "code", None) == "PII_ACTIVATION_CONFLICT"
