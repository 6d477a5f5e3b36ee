"""Redacting finished JSON lines: value literals are masked in place, every other byte stays.

A line is cut at its string literals; those that are values are a row's leaves with the keys they stand directly under, masked
like any others. Whatever isn't one strict JSON value becomes a fixed line and never leaves as it was.
"""

from __future__ import annotations

from collections.abc import Callable
from dataclasses import replace

from pyspark.sql import Column, DataFrame
from pyspark.sql import functions as F

from ..config import ScanConfig
from ..constants import COUNTS, ERROR_LINE, LIMIT, LIMIT_LINE, LINE_LIMITS, resolve_limits
from ..functions.arrays import apply, fence, let, quote, struct
from ..functions.json_text import STRING, is_json, literal_of, text_of, turns_of
from ..functions.scanner import CUT
from .walk import EVENTS, LEAVES, SAME, STEPS, USED, Walk, counts_sql, mask_leaves, operation_limits


def _spans_sql(turns: str) -> str:
    """array<struct<at, token, key, value>> of the literals: at is a literal's place in turns; key the literal of its direct
    key, null without one."""
    before = f"get({turns}, i_ - 2)"
    keyed = f"i_ > 1 AND endswith({before}, ':') AND trim(BOTH ' \\t\\r\\n' FROM get({turns}, i_ - 1)) = ''"
    one = struct(at="i_", token="q_", key=f"CASE WHEN {keyed} THEN regexp_extract({before}, {quote('^' + STRING)}, 0) END", value="NOT endswith(q_, ':')")
    return f"filter(transform({turns}, (q_, i_) -> {one}), g_ -> g_.at % 2 = 1)"


def value_spans(line: Column) -> Column:
    """array<struct<token, key, value>>: the literals in order, what stands in the literal of the direct key of each, and
    whether it is a value."""
    one = struct(token="g_.token", key="substr(g_.key, 2, length(g_.key) - 2)", value="g_.value")
    spans = _spans_sql("r_")
    return apply(line, f"x -> {let('r_', turns_of('x', CUT), f'transform({spans}, g_ -> {one})')}")


#: What becomes of a line: redacted, or one of the fixed lines.
FINE, LIMITED, BROKEN = 0, 1, 2


def redact_lines(df: DataFrame, line: str = "line", config: ScanConfig = ScanConfig(), limits: dict | None = None, walk: Walk | dict | None = None, before: str | None = None, outcome: str | None = None, usage: bool = True) -> DataFrame:
    """df with its column of lines redacted; a null stays null.

    limits: LINE_LIMITS, of which the first that is passed makes the line the fixed one for limits, looked at in the order
    length, literals, their size; then a line that isn't one strict JSON value is the fixed one for errors. A final newline
    stays. Literals that don't change keep their own bytes, escapes included; others are escaped anew. walk: a Walk, or limits
    of one. Literals beyond its array width become the limit marker. before: a column with what the line's operation has
    spent. outcome names a column struct<counts, usage> with what the operation has spent after it, or struct<counts>
    where usage isn't asked for.
    """
    walk = walk if isinstance(walk, Walk) else Walk(config, walk)
    walk, most, op = replace(walk, config=config), resolve_limits(limits, LINE_LIMITS), operation_limits(walk)
    # bytes are known, and characters are no more; a line that holds the sign of a cut itself is no JSON
    fits = f"octet_length(`{line}`) <= {most['max_line']} OR length(`{line}`) <= {most['max_line']}"
    out = df.withColumn("fg_json", F.expr(f"CASE WHEN {fits} THEN NOT contains(`{line}`, {quote(CUT)}) AND {is_json(f'`{line}`')} END"))
    out = out.withColumn("fg_turns", F.expr(f"CASE WHEN fg_json THEN {turns_of(f'`{line}`', CUT, True)} WHEN NOT fg_json THEN {turns_of(f'`{line}`', CUT)} END"))
    out = out.withColumn("fg_spans", apply(F.col("fg_turns"), f"x -> filter({_spans_sql('x')}, g_ -> g_.value)"))
    size = lambda of: f"aggregate(fg_spans, 0L, (s_, g_) -> s_ + {of}(g_.token) + coalesce({of}(g_.key), 0))"
    spent = f"coalesce(`{before}`.nodes, 0L)" if before else "0L"
    ends = f"WHEN {spent} + 1 > {op['max_nodes']} THEN {LIMITED} " if op else ""
    if walk.limit("max_depth") <= 0 or walk.limit("max_nodes") <= 0:
        ends = f"WHEN true THEN {BROKEN} "  # the line's own list of literals isn't entered
    ceilings = f"WHEN fg_turns IS NULL OR size(fg_spans) > {most['max_spans']} OR {size('octet_length')} > {most['max_decode']} AND {size('length')} > {most['max_decode']} THEN {LIMITED}"
    out = out.withColumn("fg_end", F.expr(f"CASE WHEN `{line}` IS NULL THEN {FINE} {ceilings} WHEN NOT fg_json THEN {BROKEN} {ends}ELSE {FINE} END"))
    width = walk.limit("max_array_length")
    leaf = struct(k=f"CASE WHEN g_.key IS NOT NULL THEN {text_of('g_.key')} END" if walk.key_context else "cast(null as string)", t=text_of("g_.token"))
    kept = f"slice(x.spans, 1, {width})" if width else "filter(x.spans, g_ -> false)"
    given = F.struct(F.col("fg_spans").alias("spans"), F.col("fg_end").alias("end"))
    out = out.withColumn("fg_l", apply(given, f"x -> CASE WHEN x.end = {FINE} AND x.spans IS NOT NULL THEN transform({kept}, g_ -> {leaf}) ELSE cast(array() as {LEAVES}) END"))
    event = lambda leaf: struct(leaf=leaf, nodes="1", keys="0", limited="0", failed="0")
    events = apply(F.col("fg_l"), f"x -> cast(concat(array({event('false')}), transform(x, lf_ -> {event('true')})) as {EVENTS})")
    if before:
        zero = F.struct(*[F.coalesce(F.col(before)[u], F.lit(0)).cast("long").alias(u) for u in USED])
        out = out.withColumn("fg_before", zero)
    out = mask_leaves(out, events, walk, (1, 1), bool(outcome) and usage, "fg_before" if before else None, (F.size("fg_l") + 1, F.lit(0)))
    masked = f"CASE WHEN g_.m IS NULL THEN {quote(None)} WHEN g_.m.text = g_.l.t THEN g_.s.token ELSE {literal_of('g_.m.text')} END"
    fields = F.struct(*[F.col(f"fg_{k}").alias(k) for k in ("turns", "spans", "l", "m", "way")])
    # each value behind all that stands between it and the one before; values that weren't reached are refused
    new = let("g_", struct(s="s_", m="get(x.m, i_)", l="get(x.l, i_)"), f"coalesce({masked}, {quote(chr(34) + LIMIT + chr(34))})")
    past = "coalesce(get(x.spans, i_ - 1).at, -1)"
    tail = "coalesce(get(x.spans, size(x.spans) - 1).at, -1)"
    pieces = f"concat(array_join(transform(x.spans, (s_, i_) -> concat(array_join(slice(x.turns, {past} + 2, s_.at - {past} - 1), ''), {new})), ''), array_join(slice(x.turns, {tail} + 2, size(x.turns)), ''))"
    out = out.withColumn("fg_text", apply(fields, f"x -> CASE WHEN x.way = {SAME} AND size(x.spans) <= {width} THEN array_join(x.turns, '') ELSE {pieces} END"))
    end = f"CASE WHEN endswith(`{line}`, '\\n') THEN '\\n' ELSE '' END"
    text = F.expr(f"CASE WHEN `{line}` IS NULL THEN NULL WHEN fg_end = {LIMITED} THEN concat({quote(LIMIT_LINE)}, {end}) WHEN fg_end = {BROKEN} THEN concat({quote(ERROR_LINE)}, {end}) ELSE fg_text END")
    found = {line: text}
    if outcome:
        whole = F.struct(*[F.col(f"fg_{k}").alias(k) for k in ("l", "m", "a", "spans", "end")], F.col(line).isNull().alias("none"), *([F.col("fg_before").alias("before")] if before else []))
        fixed = {LIMITED: "limited", BROKEN: "failed"}
        cut = f"greatest(size(x.spans) - {width}, 0)"
        counts = let("n_", counts_sql(), struct(**{k: f"CASE WHEN x.none THEN 0L WHEN x.end <> {FINE} THEN " + (" ".join(["CASE x.end", *[f"WHEN {e} THEN 1L" for e, name in fixed.items() if name == k], "ELSE 0L END"]) if k in fixed.values() else "0L") + f" ELSE n_.{k}" + (f" + {cut}" if k == "limited" else "") + " END" for k in COUNTS}))
        was = (lambda u: f"x.before.{u}") if before else (lambda u: "0L")
        spends = struct(**{u: f"{was(u)} + CASE WHEN x.none OR x.end <> {FINE} THEN 0L ELSE coalesce(x.a.last.{u}, 0L) END" for u in USED})
        found[outcome] = apply(whole, f"x -> {struct(counts=counts, usage=spends) if usage else struct(counts=counts)}")
    return out.withColumns({k: fence(c) for k, c in found.items()}).drop("fg_json", "fg_turns", "fg_spans", "fg_end", "fg_text", "fg_before", *STEPS)


def redact_lines_after(df: DataFrame, host: Callable[[Column], Column], line: str = "line", config: ScanConfig = ScanConfig(), limits: dict | None = None) -> DataFrame:
    """Lines that a host's own hook, a function of a Column, has seen first. Where it raises while the plan is made, or gives a
    null, the original line is redacted."""
    try:
        shown = host(F.col(line))
    except Exception:
        shown = F.col(line)
    shown = shown.cast("string") if isinstance(shown, Column) else F.col(line)
    return redact_lines(df.withColumn(line, F.coalesce(shown, F.col(line))), line, config, limits)


def is_replacement_line(line: Column) -> Column:
    """Whether a line is one of the fixed ones, with or without its newline."""
    return F.coalesce(line.isin(ERROR_LINE, LIMIT_LINE, ERROR_LINE + "\n", LIMIT_LINE + "\n"), F.lit(False))
