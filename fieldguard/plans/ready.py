"""Boundaries from checked options, and whether one with given options would work."""

from __future__ import annotations

from collections.abc import Callable

from pyspark.sql import SparkSession
from pyspark.sql import functions as F

from ..config import OptionsError, ScanConfig
from ..constants import CONTEXT_LIMITS, CORE_CODES, INCREMENTAL_LIMITS
from ..operators.strict import Strict

READY = ("ready", "import_failed", "core_incompatible", "activation_failed", "activation_conflict", "options_rejected", "limits_invalid", "probe_failed", "not_initialized")


def is_strict_limits(limits: object) -> bool:
    """Whether both bounds of a strict walk are whole numbers of at least 0 that a double holds exactly."""
    return isinstance(limits, dict) and all(type(limits.get(k)) is int and 0 <= limits[k] < 2**53 for k in ("max_depth", "max_nodes"))


def _whole_set(given: object, names: dict) -> bool:
    return isinstance(given, dict) and given.keys() == names.keys() and all(type(v) is int and v > 0 for v in given.values())


def validate_options(options: dict) -> None:
    """Limits are whole sets; options of scans that a boundary doesn't take are refused by name, and errors are fixed texts
    without any value."""
    refused = [n for n in ("ruleset", "scan_limits", "scan_config") if n in options]
    if refused:
        raise OptionsError("CORE_OPTION_UNSUPPORTED", tuple(refused[:1]))
    for name, default in (("limits", CONTEXT_LIMITS), ("incremental", INCREMENTAL_LIMITS)):
        if name in options and not _whole_set(options[name], default):
            raise OptionsError("CORE_OPTION_REJECTED", (name,), "INVALID_LIMITS")
    wrong = [n for n in ("evaluate", "formatter") if options.get(n) is not None and not callable(options[n])]
    if wrong:
        raise OptionsError("CORE_OPTION_REJECTED", tuple(wrong[:1]))
    if options.get("evaluate") is not None and options.get("rules"):
        raise OptionsError("CORE_OPTION_REJECTED", ("evaluate", "rules"))


def with_default_limits(options: dict) -> dict:
    """Whole sets of limits where none is given; a set given is taken as it is, never merged field by field."""
    return {"limits": dict(CONTEXT_LIMITS), "incremental": dict(INCREMENTAL_LIMITS)} | options


def _code(error: Exception) -> str | None:
    code = getattr(error, "code", None)
    return code if code in CORE_CODES else None


def create_strict(start: Callable[[], object] | None = None, **options) -> Strict:
    """The rules of a boundary from checked options. start prepares the scanner; where it raises, the boundary exists all the
    same and every operation is blocked as core_error."""
    options, failure = with_default_limits(options), None
    validate_options(options)
    try:
        if start is not None:
            start()
    except Exception as e:
        failure = _code(e) or "INITIALIZATION_FAILED"
    config = ScanConfig(rules=options.get("rules", ()), pii=bool(options.get("pii")), evaluate=options.get("evaluate"), formatter=options.get("formatter"))
    return Strict(config, options["limits"], options.get("operation"), failure, options.get("binary", "block"))


def check_ready(spark: SparkSession, start: Callable[[], object] | None = None, **options) -> dict:
    """{status, stage, code}: whether a boundary with these options would work, by a fixed probe of one row; it never raises."""
    from .context import sanitize_text

    said = lambda status, stage, code=None: {"status": status, "stage": stage, "code": code}
    try:
        rules = create_strict(None, **options)
    except OptionsError as e:
        return said("limits_invalid" if e.core_code == "INVALID_LIMITS" else "options_rejected", "options", e.core_code)
    except Exception:
        return said("options_rejected", "options")
    try:
        if start is not None:
            start()
    except Exception as e:
        if getattr(e, "code", None) == "PII_ACTIVATION_CONFLICT":
            return said("activation_conflict", "activate", e.code)
        return said("not_initialized" if _code(e) == "NOT_INITIALIZED" else "activation_failed", "activate", _code(e))
    secret = "A" * 36
    try:
        o = spark.range(1).select(sanitize_text(F.lit("api_key=" + "gh" + "p_" + secret), None, rules.config, rules.limits).alias("o")).first()["o"]
    except Exception:
        return said("probe_failed", "probe")
    fine = o["outcome"] == "ok" and secret not in o["value"] or o["reason"] == "policy"
    return said("ready" if fine else "probe_failed", "probe", o["code"])
