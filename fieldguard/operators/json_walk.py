"""Masking JSON texts of any shape, permissively: what can't be released becomes a marker and the walk goes on.

The tokens of a text are folded with a stack of containers: which values are kept, which are beyond a width, which containers
are too deep. The kept strings are a row's leaves, masked like those of typed columns.
"""

from __future__ import annotations

from dataclasses import replace

from pyspark.sql import DataFrame
from pyspark.sql import functions as F

from ..config import ScanConfig
from ..constants import COUNTS, ERROR, LIMIT
from ..functions.arrays import among, apply, fence, let, quote, running_sql, struct
from ..functions.json_text import literal_of
from .strict import json_events, json_tokens
from .walk import EVENTS, LEAVES, STEPS, USED, Walk, counts_sql, mask_leaves

#: What becomes of a token: dropped, kept, kept behind a comma, the limit marker, that behind a comma.
DROP, KEEP, NEXT, LIMITED, NEXT_LIMITED = "d", "k", "c", "l", "m"
#: Tokens that one fold goes over; longer texts are folded part by part, as marks are appended one by one.
PART = 256


def _marks_sql(walk: Walk) -> str:
    """A mark for each event in x.e."""
    width, keys, depth = walk.limit("max_array_length"), walk.limit("max_object_keys"), walk.limit("max_depth")
    def nxt(mark: str, stack: str = "q_.stack", skip: str = "q_.skip", drop: str = "q_.drop") -> str:
        return struct(stack=stack, skip=skip, drop=drop, marks=f"concat(q_.marks, {mark})")

    top = "get(q_.stack, size(q_.stack) - 1)"
    counted = f"concat(slice(q_.stack, 1, size(q_.stack) - 1), array({struct(object='tp_.object', n='tp_.n + 1')}))"
    under = f"CASE WHEN tp_ IS NULL OR tp_.object THEN q_.stack ELSE {counted} END"
    comma = "tp_ IS NOT NULL AND NOT tp_.object AND tp_.n > 0"
    pushed = f"concat(ud_, array({struct(object="get(x.tokens, e_.place) = '{'", n='0')}))"
    skipped = "CASE WHEN e_.kind = 'open' THEN 1 ELSE 0 END"
    value = let("ud_", under, (
        f"CASE WHEN q_.drop OR tp_ IS NOT NULL AND NOT tp_.object AND tp_.n >= {width} THEN {nxt(quote(DROP), skip=skipped, drop='false')} "
        f"WHEN e_.kind = 'open' AND size(q_.stack) >= {depth} THEN {nxt(f'CASE WHEN {comma} THEN {quote(NEXT_LIMITED)} ELSE {quote(LIMITED)} END', 'ud_', '1')} "
        f"WHEN e_.kind = 'open' THEN {nxt(f'CASE WHEN {comma} THEN {quote(NEXT)} ELSE {quote(KEEP)} END', pushed)} "
        f"ELSE {nxt(f'CASE WHEN {comma} THEN {quote(NEXT)} ELSE {quote(KEEP)} END', 'ud_')} END"
    ))
    deeper = "q_.skip + CASE e_.kind WHEN 'open' THEN 1 WHEN 'close' THEN -1 ELSE 0 END"
    step = let("tp_", top, (
        f"CASE WHEN e_.kind = 'none' THEN {nxt(quote(DROP))} WHEN q_.skip > 0 THEN {nxt(quote(DROP), skip=deeper)} "
        f"WHEN e_.kind = 'close' THEN {nxt(quote(KEEP), 'slice(q_.stack, 1, size(q_.stack) - 1)')} "
        f"WHEN e_.kind = 'key' AND tp_.n >= {keys} THEN {nxt(quote(DROP), drop='true')} WHEN e_.kind = 'key' THEN {nxt(f'CASE WHEN tp_.n > 0 THEN {quote(NEXT)} ELSE {quote(KEEP)} END', counted)} ELSE {value} END"
    ))
    placed = "transform(x.e, (e_, i_) -> named_struct('kind', e_.kind, 'place', i_))"
    fold = f"aggregate(slice(ev_, b_ * {PART} + 1, {PART}), {struct(stack='w_.stack', skip='w_.skip', drop='w_.drop', marks=quote(''))}, (q_, e_) -> {step})"
    parts = let("z_", fold, struct(stack="z_.stack", skip="z_.skip", drop="z_.drop", marks="concat(w_.marks, array(z_.marks))"))
    zero = struct(stack="cast(array() as array<struct<object:boolean,n:int>>)", skip="0", drop="false", marks="cast(array() as array<string>)")
    whole = f"aggregate(sequence(0, cast(ceil(size(ev_) / {PART}) as int) - 1), {zero}, (w_, b_) -> {parts}, w_ -> split(array_join(w_.marks, ''), ''))"
    return f"CASE WHEN size(x.e) > 0 THEN {let('ev_', placed, whole)} END"


def mask_json(df: DataFrame, column: str, config: ScanConfig = ScanConfig(), limits: dict | None = None, operation: dict | bool | None = None, outcome: str | None = None) -> DataFrame:
    """df with a column of JSON texts masked: compact JSON text again, numbers as they were written.

    Elements beyond the array width and keys beyond the object width are dropped, containers too deep are the limit marker,
    and so is every leaf from the first event on that a limit refuses. Text that isn't strict JSON becomes the error marker
    as a JSON string; a null stays null. outcome names a column struct<counts, usage>.
    """
    walk = replace(Walk(config, limits), operation=operation)
    out = df.withColumn("fg_tokens", json_tokens(F.col(column)))
    out = out.withColumn("fg_e", json_events(F.col("fg_tokens")))
    given = lambda *names: F.struct(*[F.col(f"fg_{n}").alias(n) for n in names])
    out = out.withColumn("fg_marks", apply(given("tokens", "e"), f"x -> {_marks_sql(walk)}"))
    kept = among("get(x.marks, i_)", KEEP, NEXT)
    leaf = struct(k="e_.k" if walk.key_context else "cast(null as string)", t="e_.t")
    out = out.withColumn("fg_l", apply(given("e", "marks"), f"x -> coalesce(filter(transform(x.e, (e_, i_) -> CASE WHEN e_.kind = 'leaf' AND {kept} THEN {leaf} END), lf_ -> lf_ IS NOT NULL), cast(array() as {LEAVES}))"))
    flag = lambda test: f"CASE WHEN {test} THEN 1 ELSE 0 END"
    event = struct(leaf="e_.kind = 'leaf'", nodes=flag(among("e_.kind", "open", "node", "leaf")), keys=flag("e_.kind = 'key'"), limited=flag(among("get(x.marks, i_)", LIMITED, NEXT_LIMITED)), failed="0")
    events = apply(given("e", "marks"), f"x -> coalesce(cast(filter(transform(x.e, (e_, i_) -> CASE WHEN get(x.marks, i_) <> {quote(DROP)} AND e_.kind <> 'close' THEN {event} END), v_ -> v_ IS NOT NULL) as {EVENTS}), cast(array() as {EVENTS}))")
    out = mask_leaves(out, events, walk, None, bool(outcome))
    # which leaf a token is, by how many came before it
    one = f"transform(x.e, (e_, i_) -> CASE WHEN e_.kind = 'leaf' AND {kept} THEN 1L ELSE 0L END)"
    out = out.withColumn("fg_nth", apply(given("e", "marks"), f"x -> {running_sql(one)}"))
    shown = f"CASE WHEN get(x.e, i_).kind = 'leaf' THEN CASE WHEN get(x.m, cast(get(x.nth, i_) as int)).text = get(x.e, i_).t THEN q_ ELSE {literal_of('get(x.m, cast(get(x.nth, i_) as int)).text')} END WHEN get(x.e, i_).kind = 'key' THEN concat(q_, ':') ELSE q_ END"
    limit = quote('"' + LIMIT + '"')
    piece = f"CASE get(x.marks, i_) WHEN {quote(DROP)} THEN '' WHEN {quote(LIMITED)} THEN {limit} WHEN {quote(NEXT_LIMITED)} THEN concat(',', {limit}) WHEN {quote(NEXT)} THEN concat(',', {shown}) ELSE {shown} END"
    text = apply(given("tokens", "e", "marks", "m", "nth"), f"x -> array_join(transform(x.tokens, (q_, i_) -> {piece}), '')")
    found = {column: F.when(F.col(column).isNotNull(), F.coalesce(text, F.lit('"' + ERROR + '"')))}
    if outcome:
        whole = F.struct(*[F.col(f"fg_{k}").alias(k) for k in ("l", "m", "a")], (F.col(column).isNotNull() & F.col("fg_tokens").isNull()).alias("broken"))
        counts = let("n_", counts_sql(), struct(**{k: f"n_.{k}" + (" + CASE WHEN x.broken THEN 1L ELSE 0L END" if k == "failed" else "") for k in COUNTS}))
        found[outcome] = apply(whole, f"x -> {struct(counts=counts, usage=struct(**{u: f'coalesce(x.a.last.{u}, 0L)' for u in USED}))}")
    return out.withColumns({k: fence(c) for k, c in found.items()}).drop("fg_tokens", "fg_e", "fg_marks", "fg_nth", *STEPS)

