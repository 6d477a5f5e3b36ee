"""Strict boundaries over rows: texts, contexts of many parts, staged streams, and the fixed forms of what crosses.

A whole operation is released or nothing is. Operations over many rows spend one budget: charges are prefix sums in the order
of their parts, the first part that can't be released decides, and values are gathered only up to the limits.
"""

from __future__ import annotations

from pyspark.sql import Column, DataFrame
from pyspark.sql import functions as F

from ..config import ScanConfig
from ..constants import (
    BLOCKED_TEXT,
    CONTEXT_LIMITS,
    CORE_CODES,
    FINDING,
    INCREMENTAL_LIMITS,
    LIMIT_CODES,
    OPERATION_LIMITS,
    RESOURCE_BLOCKED_TEXT,
    RESOURCE_ERROR_CODE,
    RESOURCE_ERROR_TEXT,
    TOOL_ERROR_TEXT,
    resolve_limits,
)
from ..functions.arrays import apply, fence, let, quote, struct
from ..functions.arrays import bind as _bind
from ..functions.leaf import _has, decide
from ..functions.scanner import PRIVATE_KEY, scan
from ..operators.budget import USAGE, first_of_text, running_sums
from ..operators.strict import MEMO, MEMO_LENGTH, Strict

OUTCOME = f"struct<outcome:string,value:string,findings:array<{FINDING}>,reason:string,code:string,emitted:array<{FINDING}>>"


def _outcome(kind: str, value: Column | None = None, findings: Column | None = None, reason: str | None = None, code: Column | str | None = None, emitted: Column | None = None) -> Column:
    none = F.expr(f"cast(array() as array<{FINDING}>)")
    return F.struct(
        F.lit(kind).alias("outcome"), (value if value is not None else F.lit(None).cast("string")).alias("value"),
        (findings if findings is not None else F.lit(None).cast(f"array<{FINDING}>")).alias("findings"), F.lit(reason).cast("string").alias("reason"),
        (code if isinstance(code, Column) else F.lit(code).cast("string")).alias("code"), (emitted if emitted is not None else none).alias("emitted"),
    )


def sanitize_text(text: Column, key: Column | None = None, config: ScanConfig = ScanConfig(), limits: dict | None = None, aborted: Column | None = None) -> Column:
    """ok with the text and its findings, blocked with a reason and a limit's code, or aborted; emitted has the findings that
    an observer sees, those of blocked texts as well. A null is ok."""
    most = resolve_limits(limits, CONTEXT_LIMITS)

    def judge(r: Column) -> Column:
        return (
            F.when(r["code"].isNotNull(), _outcome("blocked", reason="core_error", code=r["code"]))
            .when(r["broken"] & ~r["outside"], _outcome("blocked", reason="core_error"))
            .when(F.size(r["findings"]) > most["max_findings"], _outcome("blocked", reason="limit_exceeded", code="FINDING_LIMIT_EXCEEDED"))
            .when(r["outside"], _outcome("blocked", reason="policy"))
            .when(_has(r["findings"], "block"), _outcome("blocked", reason="policy", emitted=r["findings"]))
            .otherwise(_outcome("ok", r["text"], r["findings"], emitted=r["findings"]))
        )

    out = F.when(text.isNull(), _outcome("ok", findings=F.expr(f"cast(array() as array<{FINDING}>)")))
    out = out.when(F.octet_length(text) > most["max_input_bytes"], _outcome("blocked", reason="limit_exceeded", code="INPUT_LIMIT_EXCEEDED"))
    out = out.otherwise(_bind(decide(text, key, config), judge))
    return out if aborted is None else F.when(aborted, _outcome("aborted")).otherwise(out)


# --- contexts ----------------------------------------------------------------------------------------------


def _parts(df: DataFrame, op: str, turn: str, text: str, role: str, rules: Strict) -> DataFrame:
    """df with fg_o (each part's own outcome), fg_bad struct<turn, reason, code> where it can't be released, fg_part (its place)
    and fg_fits (whether its operation has room for it)."""
    budget = rules.budget()
    out = first_of_text(df, op, turn, text, MEMO_LENGTH, MEMO)
    out = out.withColumn("fg_o", fence(sanitize_text(F.col(text), None, rules.config, rules.limits)))
    scanned, octets = F.when(F.col("scanned") & F.col(text).isNotNull(), 1).otherwise(0), F.octet_length(F.coalesce(F.col(text), F.lit("")))
    costs = {"nodes": F.lit(1), "leaves": F.lit(1), "scans": scanned, "bytes": F.when(F.col("scanned"), octets).otherwise(0), "findings": F.size("fg_o.emitted")}
    out = running_sums(out, op, turn, costs).withColumn("fg_part", F.col("used_nodes") - 1)
    over = F.lit(False)
    for k in ("nodes", "leaves", "scans", "bytes"):
        over = over | (F.col(f"used_{k}") > budget[USAGE[k]])
    refused = lambda reason, code=None: F.struct(F.col(turn).alias("turn"), F.lit(reason).alias("reason"), (F.lit(None).cast("string") if code is None else code).alias("code"))
    own = F.col("fg_o.outcome") != "ok"
    bad = F.when(F.col(role).isNull(), refused("unsupported_value")) if role else F.when(F.lit(False), refused("unsupported_value"))
    bad = bad.when(over, refused("limit_exceeded"))
    bad = bad.when(own & (F.size("fg_o.emitted") == 0), F.struct(F.col(turn).alias("turn"), F.col("fg_o.reason").alias("reason"), F.col("fg_o.code").alias("code")))
    bad = bad.when(F.col("used_findings") > budget["max_findings"], refused("limit_exceeded")).when(own, F.struct(F.col(turn).alias("turn"), F.col("fg_o.reason").alias("reason"), F.col("fg_o.code").alias("code")))
    return out.withColumns({"fg_bad": bad, "fg_fits": ~over & (F.col("used_findings") <= budget["max_findings"])}).drop("scanned", *[f"used_{k}" for k in costs])


def build_context(df: DataFrame, op: str = "conv_id", turn: str = "turn", config: ScanConfig = ScanConfig(), limits: dict | None = None, operation: dict | None = None, text: str = "text", role: str = "role") -> DataFrame:
    """(op, outcome, reason, code, messages, n_findings): the messages of all parts in turn order, or the first failure.

    Parts share one budget and one memo: a short text that its operation has scanned isn't charged again. A part without a role
    is no part. Only parts that their operation has room for are gathered, so the limits bound what is gathered; a turn that
    occurs twice is in the order of its text.
    """
    parts = _parts(df, op, turn, text, role, Strict(config, limits, operation))
    message = F.struct(F.col(turn).alias("turn"), F.col(role).alias("role"), F.col("fg_o.value").alias("content"))
    g = parts.groupBy(op).agg(F.min("fg_bad").alias("bad"), F.array_sort(F.collect_list(F.when(F.col("fg_fits"), message))).alias("m"), F.sum(F.size("fg_o.emitted")).alias("n"))
    ok = F.col("bad").isNull()
    return g.select(
        op, F.when(ok, "ok").otherwise("blocked").alias("outcome"), F.col("bad.reason").alias("reason"), F.col("bad.code").alias("code"),
        F.when(ok, F.to_json(F.transform("m", lambda x: x.dropFields("turn")))).alias("messages"), F.when(ok, F.col("n")).cast("long").alias("n_findings"),
    )


def context_findings(df: DataFrame, op: str = "conv_id", turn: str = "turn", config: ScanConfig = ScanConfig(), limits: dict | None = None, operation: dict | None = None, text: str = "text", role: str = "role") -> DataFrame:
    """(op, turn, part, finding): the side table of findings that an observer sees, one row each: those of the parts before the
    first that can't be released, and of that one where its policy refuses it."""
    parts = _parts(df, op, turn, text, role, Strict(config, limits, operation))
    ends = parts.where("fg_bad is not null").groupBy(F.col(op).alias("fg_op")).agg(F.min("fg_bad").alias("fg_end"))
    seen = parts.where(F.size("fg_o.emitted") > 0).join(ends, F.col(op).eqNullSafe(F.col("fg_op")), "left")
    before = F.col("fg_end").isNull() | (F.col(turn) < F.col("fg_end.turn")) | ((F.col(turn) == F.col("fg_end.turn")) & (F.col("fg_end.reason") == "policy"))
    return seen.where(before).select(op, turn, F.col("fg_part").alias("part"), F.explode("fg_o.emitted").alias("finding"))


# --- streams -----------------------------------------------------------------------------------------------

#: The end of a text that a key block may go on from.
_OPEN = r"-----BEGIN [A-Z ]{0,20}PRIVATE KEY-----[A-Za-z0-9+/=\s]*(?:-[A-Z -]*)?\z"


def _held_sql(most: dict[str, int]) -> str:
    """struct<out, code, ..> after the chunks x: how many characters of them were released, and the bound that was passed. Lines are released that can't be part of a longer match: nothing but a key block goes over a
    line's end, and nothing ends inside one."""
    # chunks since the last look stay where they are: in the state, each step would copy all of them
    joined = "concat(q_.held, array_join(transform(slice(x, q_.since + 1, q_.at - q_.since + 1), y_ -> y_.chunk), ''))"
    opened = f"length(h_) - length(regexp_extract(h_, {quote(_OPEN)}, 0))"
    marks = "translate(substr(h_, 1, n_), '\u0001', ' ')"
    apart = f"split(regexp_replace({marks}, {quote(PRIVATE_KEY)}, '\u0001$0\u0001'), '\u0001', -1)"
    shown = f"array_join(transform({apart}, (p_, i_) -> CASE WHEN i_ % 2 = 1 THEN translate(p_, '\n', ' ') ELSE p_ END), '')"
    tail = let("l_", f"locate('\\n', reverse({shown}))", "CASE WHEN l_ = 0 THEN n_ ELSE l_ - 1 END")
    kept = f"substr(h_, n_ - {tail} + 1)"
    runs = lambda text: f"transform(split({text}, {quote(chr(92) + 's+')}), w_ -> octet_length(w_))"
    longest = lambda xs: f"array_max({xs})"

    def after(held: str, since: str, end: str, out: str, peak: str, run: str, size: str, opened: str, dash: str) -> str:
        code = f"CASE WHEN {opened} AND {size} > {most['max_multiline_bytes']} THEN 'MULTILINE_LIMIT_EXCEEDED' WHEN NOT ({opened}) AND {peak} > {most['max_token_bytes']} THEN 'TOKEN_LIMIT_EXCEEDED' WHEN {size} > {most['max_buffered_bytes']} THEN 'BUFFER_LIMIT_EXCEEDED' END"
        return let("e_", code, struct(held=f"CASE WHEN e_ IS NULL THEN {held} ELSE '' END", since=since, at="q_.at + 1", end=f"right({end}, 4)", out=f"CASE WHEN e_ IS NULL THEN {out} ELSE q_.out END", code="e_", peak=peak, run=run, size=size, dash=dash))

    # text that ends no line and begins no block is only added; what is held back is looked through where it may be released
    first, last = "get(g_, 0)", "get(g_, size(g_) - 1)"
    added = let("g_", runs("c_.chunk"), after("q_.held", "q_.since", "concat(q_.end, c_.chunk)", "q_.out", f"greatest(q_.peak, q_.run + {first}, {longest('g_')})", f"CASE WHEN size(g_) = 1 THEN q_.run + {first} ELSE {last} END", "q_.size + octet_length(c_.chunk)", "false", "false"))
    looked = let("h_", joined, let("n_", opened, let("k_", kept, let("g_", runs("k_"), after("k_", "q_.at + 1", "k_", "q_.out + length(h_) - length(k_)", longest("g_"), last, "octet_length(k_)", "n_ < length(h_)", "contains(k_, '-----')")))))
    plain = "NOT q_.dash AND NOT contains(c_.chunk, '\\n') AND NOT contains(concat(q_.end, c_.chunk), '-----')"
    step = f"CASE WHEN q_.code IS NOT NULL THEN q_ WHEN {plain} THEN {added} ELSE {looked} END"
    zero = struct(held="''", since="0", at="0", end="''", out="0", code="cast(null as string)", peak="0", run="0", size="0", dash="false")
    return f"aggregate(x, {zero}, (q_, c_) -> {step})"


def stream_batch(df: DataFrame, stream: str = "stream_id", seq: str = "seq", op: str = "op", chunk: str = "chunk", config: ScanConfig = ScanConfig(), limits: dict | None = None, incremental: dict | bool = False, failure: str | None = None) -> DataFrame:
    """(stream, outcome, value, findings, reason, code): the chunks up to the first finalize, released as a whole or not at all.

    op: append, finalize, abort or fail (the producer has failed). An abort before the end gives aborted, a failed producer
    tool_error, an append without a chunk unsupported_value; no finalize, or a second one, gives lifecycle; chunks after the
    end are discarded. limits: of the whole text. incremental: bounds of what is held back while chunks arrive, as
    INCREMENTAL_LIMITS (True: their defaults), in whose place whole texts have no bounds of their own; a finding that blocks
    in what was released before a bound was passed decides first. failure: a code with which the scanner failed to start.
    Chunks beyond the limit of all bytes are never gathered, so the limit bounds a stream's row.
    """
    bounds = resolve_limits(incremental if isinstance(incremental, dict) else None, INCREMENTAL_LIMITS) if incremental is not False else None
    whole = resolve_limits(limits, CONTEXT_LIMITS) if bounds is None else {"max_input_bytes": bounds["max_input_bytes"], "max_findings": OPERATION_LIMITS["max_findings"]}
    is_append = F.col(op) == "append"
    used = running_sums(df, stream, seq, {"bytes": F.when(is_append, F.octet_length(F.coalesce(F.col(chunk), F.lit("")))).otherwise(0)})
    fits = F.col("used_bytes") <= whole["max_input_bytes"]
    first = lambda c: F.min(F.when(c, F.col(seq)))
    g = used.groupBy(stream).agg(
        F.array_sort(F.collect_list(F.when(is_append & fits & (F.coalesce(F.length(chunk), F.lit(0)) > 0), F.struct(F.col(seq).alias("seq"), F.col(chunk).alias("chunk"))))).alias("chunks"),
        first(F.col(op) == "finalize").alias("end"), F.count_if(F.col(op) == "finalize").alias("ends"), first(F.col(op) == "abort").alias("abort"), first(F.col(op) == "fail").alias("fail"),
        first(is_append & F.col(chunk).isNull()).alias("odd"), first(is_append & ~fits).alias("long"),
    )
    before_end = lambda c: F.col(c).isNotNull() & (F.col("end").isNull() | (F.col(c) < F.col("end")))
    g = g.withColumn("chunks", F.filter("chunks", lambda s: F.col("end").isNull() | (s["seq"] < F.col("end"))))
    held = apply(F.col("chunks"), f"x -> {_held_sql(bounds)}") if bounds else F.expr("named_struct('held', '', 'out', 0, 'code', cast(null as string))")
    g = g.withColumn("held", held).withColumn("whole", F.array_join(F.transform("chunks", lambda s: s["chunk"]), ""))
    stopped = F.col("held.code").isNotNull()
    long_ = before_end("long")
    # a bound that was passed leaves what was released before it, whose findings come first
    text = F.when(stopped | (long_ & F.lit(bounds is not None)), F.substr("whole", F.lit(1), F.col("held.out"))).otherwise(F.col("whole"))
    g = g.withColumn("o", sanitize_text(text, None, config, whole))
    limit = lambda code: _outcome("blocked", reason="limit_exceeded", code=code)
    if failure:
        o = F.when(F.lit(True), _outcome("blocked", reason="core_error", code=failure))
    else:
        o = F.when(before_end("abort"), _outcome("aborted")).when(before_end("fail"), _outcome("tool_error")).when(F.col("ends") != 1, _outcome("blocked", reason="lifecycle"))
    o = o.when((F.col("o.outcome") != "ok") & (F.col("o.reason") != "limit_exceeded"), F.col("o")).when(before_end("odd"), _outcome("blocked", reason="unsupported_value"))
    o = o.when(stopped, limit(F.col("held.code"))).when(long_, limit("INPUT_LIMIT_EXCEEDED"))
    if bounds is not None:  # the findings of a stream are a budget's
        o = o.when(F.col("o.code") == "FINDING_LIMIT_EXCEEDED", _outcome("blocked", reason="limit_exceeded"))
    return g.select(stream, fence(o.otherwise(F.col("o"))).alias("o")).select(stream, "o.outcome", "o.value", "o.findings", "o.reason", "o.code")


def streamed_tool_results(df: DataFrame, stream: str = "stream_id", **options) -> DataFrame:
    """(stream, outcome, value, findings, reason, code): chunks of tools as results of one text block."""
    out = stream_batch(df, stream, **options)
    block = F.struct(F.array(F.struct(F.lit("text").alias("type"), F.col("value").alias("text"))).alias("content"))
    return out.withColumn("value", F.when(F.col("value").isNotNull(), F.to_json(block)))


def backstop(part: Column, config: ScanConfig = ScanConfig()) -> Column:
    """Whether the serialised part, with its keys beside its values, still holds a decisive finding."""
    return F.coalesce(_has(scan(part, config)["findings"], "redact", "block"), F.lit(False))


def error_reason(code: Column) -> Column:
    """struct<reason, code> of a core error code: limits, lifecycle, or core_error; unknown codes don't cross."""
    known = F.when(code.isin(*CORE_CODES), code)
    reason = F.when(code.isin(*LIMIT_CODES), "limit_exceeded").when(code == "INVALID_STATE", "lifecycle").otherwise("core_error")
    return F.struct(reason.alias("reason"), known.alias("code"))


def wire(outcome: Column, value: Column) -> Column:
    """JSON text of a tool result on the wire: the value, a fixed input-free result, or null for aborted."""
    fixed = lambda text: f'{{"content":[{{"type":"text","text":"{text}"}}],"isError":true}}'
    return F.when(outcome == "ok", value).when(outcome == "blocked", fixed(BLOCKED_TEXT)).when(outcome == "tool_error", fixed(TOOL_ERROR_TEXT))


def resource_wire(outcome: Column, value: Column) -> Column:
    """JSON text of a resource response: {"result"}, a fixed {"error"}, or null for aborted."""
    fixed = lambda text: f'{{"error":{{"code":{RESOURCE_ERROR_CODE},"message":"{text}"}}}}'
    ok = F.concat(F.lit('{"result":'), value, F.lit("}"))
    return F.when(outcome == "ok", ok).when(outcome == "blocked", fixed(RESOURCE_BLOCKED_TEXT)).when(outcome == "read_error", fixed(RESOURCE_ERROR_TEXT))


def audit(df: DataFrame, stage: str) -> DataFrame:
    """(stage, outcome, reason, code, n) over rows with an outcome struct o."""
    return df.groupBy(F.lit(stage).alias("stage"), F.col("o.outcome").alias("outcome"), F.col("o.reason").alias("reason"), F.col("o.code").alias("code")).agg(F.count("*").alias("n"))
