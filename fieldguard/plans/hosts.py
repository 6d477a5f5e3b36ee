"""Log calls, log records, spans and telemetry logs as DataFrame plans. Each host unit is one row and one operation."""

from __future__ import annotations

from dataclasses import replace

from pyspark.sql import Column, DataFrame
from pyspark.sql import functions as F
from pyspark.sql import types as T

from ..config import ScanConfig
from ..constants import COUNTS, ERROR, LIMIT
from ..functions.leaf import mask_leaf, mask_leaf_outcome
from ..functions.arrays import bind as _bind
from ..operators.budget import add_counts
from ..operators.lines import is_replacement_line, redact_lines
from ..operators.walk import Target, Walk, mask_exception_text, mask_row

MARK = r"%[sdifoOj%]"


def format_message(fmt: Column, args: Column, kinds: Column | None = None) -> Column:
    """printf over an array of strings: %s as it is, %d and %f as a number, %i its floor, %o %O %j as JSON; %% is a percent
    sign, placeholders without a value stay, further values are dropped.

    kinds: an array beside args that says which values are JSON texts of objects and arrays ('json'), which stand for
    themselves under %o %O %j; others are strings, which get single quotes there.
    """
    def number(x: Column) -> Column:
        whole = (x == F.floor(x)) & (F.abs(x) < 1e15)
        return F.when(x.isNull() | F.isnan(x), "NaN").when(x == float("inf"), "Infinity").when(x == float("-inf"), "-Infinity").when(whole, x.cast("long").cast("string")).otherwise(x.cast("string"))

    def build(x: Column) -> Column:
        marks, gaps = x["marks"], x["gaps"]

        def piece(m: Column, i: Column) -> Column:
            def put(n: Column) -> Column:
                value = F.get(args, n - 1)
                read = F.when(F.trim(value) == "", F.lit(0.0)).otherwise(F.trim(value).try_cast("double"))
                plain = F.lit(True) if kinds is None else F.coalesce(F.get(kinds, n - 1) != "json", F.lit(True))
                shown = F.when(m == "%%", "%").when(n > F.size(args), m).when(m == "%s", F.coalesce(value, F.lit("null")))
                shown = shown.when(m.isin("%o", "%O", "%j"), F.when(value.isNull(), "null").when(plain, F.concat(F.lit("'"), value, F.lit("'"))).otherwise(value)).when(value.isNull(), m)
                return shown.when(m == "%i", number(F.floor(read).cast("double"))).otherwise(number(read))

            return F.concat(F.get(gaps, i), _bind(F.size(F.filter(F.slice(marks, F.lit(1), i + 1), lambda k: k != "%%")), put))

        return F.concat(F.array_join(F.transform(marks, piece), ""), F.get(gaps, F.size(gaps) - 1))

    # without values the format is the message, percent signs and all
    whole = _bind(F.struct(F.regexp_extract_all(fmt, F.lit(MARK), F.lit(0)).alias("marks"), F.split(fmt, MARK, -1).alias("gaps")), build)
    return F.when(fmt.isNotNull(), F.when((F.coalesce(F.size(args), F.lit(0)) <= 0) | ~fmt.contains("%"), fmt).otherwise(whole))


def message_index(first_is_object: Column) -> Column:
    """Where a log call's message stands: after a first argument that is an object, null or missing, else first."""
    return F.when(F.coalesce(first_is_object, F.lit(True)), 1).otherwise(0)


def mask_message(message: Column, prefix: Column | None = None, config: ScanConfig = ScanConfig()) -> Column:
    """Prefix and message scanned as one leaf; the prefix goes again where it still stands in front."""
    if prefix is None:
        return mask_leaf(message, None, config)
    masked = mask_leaf(F.concat(prefix, message), None, config)
    return _bind(masked, lambda m: F.when(m.startswith(prefix), F.substr(m, F.length(prefix) + 1)).otherwise(m))


def redact_log_calls(df: DataFrame, obj: str = "obj", fmt: str = "fmt", args: str = "args", prefix: str = "msg_prefix", level: str = "level", walk: Walk = Walk(), host=None) -> DataFrame:
    """Log calls (level, obj, fmt, args, msg_prefix) to finished lines, with outcome struct<host, unit, level, stages, values,
    lineReplaced>.

    The first pass formats the message and masks the arguments as one tree: the object under its own keys, and the
    message, scanned with the prefix in front, without one. Then the line is built (by host, a function of the frame that
    adds the column line, else as JSON of level, the object's fields and msg), and the second pass redacts the line. Both
    spend one budget and count into one outcome. A null obj is a call without an object.
    """
    message = F.coalesce(F.col(prefix), F.lit("")) if prefix in df.columns else F.lit("")
    joined = F.concat(message, format_message(F.col(fmt), F.col(args)))
    out = df.withColumn("fg_msg", joined)
    out = mask_row(out, Target(obj, None, 1), Target("fg_msg", None, 1), walk=replace(walk, limits={**(walk.limits or {})}), outcome="fg_first")
    out = out.withColumn("msg", F.when(F.col("fg_msg").startswith(message), F.substr("fg_msg", F.length(message) + 1)).otherwise(F.col("fg_msg")))
    if host is not None:
        out = host(out)
    else:
        names = df.schema[obj].dataType.fieldNames() if isinstance(df.schema[obj].dataType, T.StructType) else []
        fields = [F.col(level).alias("level"), *[F.col(obj)[n].alias(n) for n in names if n not in ("level", "msg")], F.concat(message, F.col("msg")).alias("msg")]
        out = out.withColumn("line", F.concat(F.to_json(F.struct(*fields)), F.lit("\n")))
    out = redact_lines(out.withColumn("fg_used", F.col("fg_first.usage")), "line", walk.config, None, walk, "fg_used", "fg_second", usage=False)
    outcome = F.struct(
        F.lit("pino").alias("host"), F.lit("log-record").alias("unit"), F.col(level).alias("level"), F.array(F.lit("log-method"), F.lit("stream-write")).alias("stages"),
        add_counts(F.col("fg_first.counts"), F.col("fg_second.counts")).alias("values"), is_replacement_line(F.col("line")).alias("lineReplaced"),
    )
    return out.withColumn("outcome", outcome).drop("fg_msg", "fg_first", "fg_second", "fg_used")


def redact_log_records(df: DataFrame, extra_fields: list[str] | None = None, walk: Walk = Walk(), outcome: str | None = None) -> DataFrame:
    """Log records: the formatted message masked and its arguments cleared, traceback and stack as one leaf each,
    the named fields of extra under their names; other extras stay. No record is dropped. All leaves of a record spend
    one budget. outcome names a column struct<level, values>: the six counts beside the record's level, if it has one."""
    message = F.coalesce(format_message(F.col("msg"), F.col("args")), F.when(F.col("msg").isNotNull(), ERROR))
    out, targets = df.withColumn("msg", message), [Target("msg")]
    for name in ("exc_text", "stack_info"):
        if name in df.columns:
            if walk.limit("max_depth") <= 0:
                out = out.withColumn(name, mask_exception_text(F.col(name), walk))
            else:
                targets.append(Target(name))
    if extra_fields and "extra" in df.columns:
        out = out.withColumn("fg_extra", F.map_filter("extra", lambda k, v: k.isin(extra_fields)))
        targets.append(Target("fg_extra", None, -1))
    out = mask_row(out, *targets, walk=walk, outcome=outcome and "fg_outcome", usage=False)
    if extra_fields and "extra" in df.columns:
        out = out.withColumn("extra", F.transform_values("extra", lambda k, v: F.when(k.isin(extra_fields), F.try_element_at("fg_extra", k)).otherwise(v))).drop("fg_extra")
    if outcome:
        level = F.col("levelno") if "levelno" in df.columns else F.lit(None).cast("int")
        out = out.withColumn(outcome, F.struct(level.alias("level"), F.col("fg_outcome.counts").alias("values"))).drop("fg_outcome")
    return out.withColumn("args", F.lit(None).cast("array<string>"))


def redact_attributes(df: DataFrame, *names: str, walk: Walk = Walk(), outcome: str | None = None) -> DataFrame:
    """Attribute bags on their own: strings under their keys, elements of arrays without one; a null bag stays null."""
    return mask_row(df, *[Target(n, None, -1) for n in names], walk=replace(walk, charge_nodes=False, charge_fields=False), outcome=outcome)


def redact_spans(df: DataFrame, walk: Walk = Walk(), outcome: str | None = None) -> DataFrame:
    """Spans: name without a key, attributes under theirs, elements of array attributes without, status message,
    names and attributes of events, attributes of links. Numbers pass. outcome names a column struct<values, dropped>."""
    own = replace(walk, charge_nodes=False, charge_fields=False, bare=("name", "message"))
    targets = [Target(n, None, d) for n, d in (("name", 0), ("attributes", -1), ("array_attributes", -1), ("status", 0), ("events", 0), ("links", 0)) if n in df.columns]
    out = mask_row(df, *targets, walk=own, outcome=outcome and "fg_outcome", usage=False)
    if outcome:
        out = out.withColumn(outcome, F.struct(F.col("fg_outcome.counts").alias("values"), F.col("fg_outcome.dropped").alias("dropped"))).drop("fg_outcome")
    return out


def redact_otel_logs(df: DataFrame, walk: Walk | None = None, outcome: str | None = None) -> DataFrame:
    """Telemetry logs: body (text, structured or bytes), severity text, event name, attributes; no key context and no
    operation budget, but the walk's nodes and leaves for the whole record. A container cut to its width counts as
    limited. Bytes are strict UTF-8 text, else the error marker. outcome names a column struct<values, dropped>."""
    walk = walk or Walk(key_context=False, operation=False, count_dropped=True)
    out, targets, tail = df, [], {}
    for name in ("body", "body_bytes", "severity_text", "event_name", "attributes"):
        if name not in df.columns:
            continue
        if name == "body_bytes":
            data, long_ = F.col(name), F.octet_length(F.col(name)) > walk.limit("max_string_length")
            out = out.withColumn("fg_bytes", F.when(~long_, F.try_validate_utf8(data.cast("string"))))
            tail[name] = F.when(data.isNotNull(), F.when(long_, LIMIT).when(F.col("fg_valid"), F.col("fg_bytes")).otherwise(ERROR).cast("binary"))
            out = out.withColumns({"fg_valid": F.col("fg_bytes").isNotNull(), "fg_long": F.coalesce(long_, F.lit(False)), "fg_bad": data.isNotNull() & ~F.coalesce(long_, F.lit(False)) & F.col("fg_bytes").isNull()})
            targets.append(Target("fg_bytes"))
        else:
            targets.append(Target(name, None, -1 if name == "attributes" else 0))
    out = mask_row(out, *targets, walk=walk, outcome=outcome and "fg_outcome", usage=False)
    if outcome:
        counts = {k: F.col("fg_outcome.counts")[k] for k in COUNTS}
        if tail:
            counts["limited"], counts["failed"] = counts["limited"] + F.col("fg_long").cast("long"), counts["failed"] + F.col("fg_bad").cast("long")
        out = out.withColumn(outcome, F.struct(F.struct(*[c.alias(k) for k, c in counts.items()]).alias("values"), F.col("fg_outcome.dropped").alias("dropped"))).drop("fg_outcome")
    return out.withColumns(tail).drop("fg_bytes", "fg_valid", "fg_long", "fg_bad")


def span_leaves(df: DataFrame, key: str, walk: Walk = Walk()) -> DataFrame:
    """(key, leaf): one masked leaf a row for the span's name and attributes, for counting."""
    names = df.select(key, mask_leaf_outcome(F.col("name"), None, walk.config).alias("leaf"))
    bags = df.select(key, F.explode("attributes").alias("k", "v")).select(key, mask_leaf_outcome(F.col("v"), F.col("k"), walk.config).alias("leaf"))
    return names.unionByName(bags)
