"""Strict walks: a whole value is released or nothing is.

A value is one array of events in document order, with every key before its value, whether it comes from a typed column or
from the tokens of a JSON text. Each event is judged on its own; the least place of any refusal decides, and only where
there is none is the value built again. What a value spends of its operation's budget is summed up over the events.
"""

from __future__ import annotations

from dataclasses import dataclass, field

from pyspark.sql import Column, DataFrame
from pyspark.sql import functions as F
from pyspark.sql import types as T

from ..config import ScanConfig
from ..constants import CONTEXT_LIMITS, FINDING, OPERATION_LIMITS, resolve_limits
from ..functions.arrays import FEW, among, apply, fence, let, quote, running_sql, struct
from ..functions.json_text import TOKEN, is_json, literal_of, lone_surrogate, text_of
from ..functions.leaf import decide_sql, has_sql, view_sql
from ..functions.scanner import scan_sql, sign_sql, with_callables
from .walk import _name, check_type

#: kind: open (a container), node (a scalar), leaf, key, or none (no event); bad: a value that can't be released.
EVENT = "struct<kind:string,k:string,t:string,up:bigint,bad:string>"
#: A judged event: the text that stands for it, its findings and the texts that were scanned; reason and code of a refusal;
#: hidden: its findings reach no observer.
JUDGED = f"struct<text:string,findings:array<{FINDING}>,scanned:array<string>,reason:string,code:string,hidden:boolean>"
SEEN = "array<struct<id:string,type:string,detector:string,confidence:string,action:string,obfuscation:string,start:int,end:int,partIndex:int,rangeScope:string,leafOrdinal:int,keyOrdinal:int,boundary:string>>"
OUTCOME = f"struct<outcome:string,value:string,findings:{SEEN},emitted:{SEEN},reason:string,code:string>"
#: Texts that an operation remembers at most, and the longest of them: a repeat of one isn't charged.
MEMO, MEMO_LENGTH = 1024, 1024
USED = ("nodes", "keys", "leaves", "scans", "bytes", "findings")
#: Whether an event e_ is charged as a node.
_NODE = among("e_.kind", "open", "node", "leaf")


def _of_kind(*kinds: str) -> str:
    """How many events in x.e are of some kinds: the engine's own functions of lists, where a lambda would be called for each."""
    rest = "x.e.kind"
    for k in kinds:
        rest = f"array_remove({rest}, {quote(k)})"
    return f"(size(x.e) - size({rest}))"


#: Whether judged events in x.d hold any finding.
_ANY = "size(flatten(x.d.findings)) > 0"


@dataclass(frozen=True)
class Strict:
    """limits as CONTEXT_LIMITS, operation as OPERATION_LIMITS; failure: a code with which the scanner failed to start, so that
    every operation is blocked; binary: whether the data of tool results and resources is blocked or passes unscanned."""

    config: ScanConfig = field(default_factory=ScanConfig)
    limits: dict | None = None
    operation: dict | None = None
    failure: str | None = None
    binary: str = "block"

    def __post_init__(self):
        if self.binary not in ("block", "pass"):
            raise TypeError('binary must be "block" or "pass"')

    def most(self) -> dict[str, int]:
        return resolve_limits(self.limits, CONTEXT_LIMITS)

    def budget(self) -> dict[str, int]:
        """One accepted text always fits the bytes that aren't given otherwise."""
        floor = {"max_bytes": max(OPERATION_LIMITS["max_bytes"], 4 * self.most()["max_input_bytes"])}
        return resolve_limits(floor | (self.operation or {}), OPERATION_LIMITS)


def judged_sql(rules: Strict, names: tuple[str, ...], event: str = "ev_", alone: str = "get(x.alone, evi_)") -> str:
    """JUDGED of an event; alone: the scan of its text, null where nothing in it or in its view can match."""
    most, none = rules.most(), "cast(array() as array<string>)"
    empty = f"cast(array() as array<{FINDING}>)"

    def out(text: str = "cast(null as string)", findings: str = empty, scanned: str = none, reason: str | None = None, code: str | None = None, hidden: str = "false") -> str:
        return struct(text=text, findings=findings, scanned=scanned, reason=reason or "cast(null as string)", code=code or "cast(null as string)", hidden=hidden)

    lone = f"CASE WHEN {event}.bad = 'core_error' THEN 'UNPAIRED_SURROGATE' END"
    limit, core, policy = quote("limit_exceeded"), quote("core_error"), quote("policy")
    one, two = f"array({event}.t)", f"array({event}.t, {view_sql(f'{event}.t', f'{event}.k')})"
    scanned = f"CASE WHEN r_.scans = 1 THEN {one} ELSE {two} END"
    long_view = f"r_.scans = 2 AND octet_length({event}.t) + octet_length({event}.k) + 7 > {most['max_input_bytes']}"
    leaf = let("r_", decide_sql(f"{event}.t", f"{event}.k", rules.config, "x", names, alone), (
        f"CASE WHEN r_.code IS NOT NULL THEN {out(scanned=scanned, reason=core, code='r_.code')} "
        f"WHEN r_.peak > {most['max_findings']} THEN {out(scanned=scanned, reason=limit, code=quote('FINDING_LIMIT_EXCEEDED'))} "
        f"WHEN {long_view} THEN {out(scanned=scanned, reason=limit, code=quote('INPUT_LIMIT_EXCEEDED'))} "
        f"WHEN r_.outside THEN {out(scanned=scanned, reason=policy)} WHEN r_.broken THEN {out(scanned=scanned, reason=core)} "
        f"WHEN {has_sql('r_.findings', 'block')} THEN {out(findings='r_.findings', scanned=scanned, reason=policy)} "
        f"ELSE {out('r_.text', 'r_.findings', scanned)} END"
    ))
    clean = f"CASE WHEN {event}.k IS NULL THEN {one} ELSE {two} END"
    long_clean = f"{event}.k IS NOT NULL AND octet_length({event}.t) + octet_length({event}.k) + 7 > {most['max_input_bytes']}"
    key = (
        f"CASE WHEN {alone} IS NULL THEN {out(scanned=one)} WHEN {alone}.code IS NOT NULL THEN {out(scanned=one, reason=core, code=f'{alone}.code')} "
        f"WHEN size({alone}.findings) > {most['max_findings']} THEN {out(scanned=one, reason=limit, code=quote('FINDING_LIMIT_EXCEEDED'))} "
        f"WHEN {has_sql(f'{alone}.findings', 'redact', 'block')} THEN {out(findings=f'{alone}.findings', scanned=one, reason=policy)} ELSE {out(findings=f'{alone}.findings', scanned=one)} END"
    )
    failed = f"WHEN {among(f'{event}.kind', 'leaf', 'key')} THEN {out(reason=core, code=quote(rules.failure))} " if rules.failure else ""
    return (
        f"CASE WHEN {event}.bad IS NOT NULL THEN {out(reason=f'{event}.bad', code=lone)} {failed}"
        f"WHEN NOT {among(f'{event}.kind', 'leaf', 'key')} THEN {out()} WHEN octet_length({event}.t) > {most['max_input_bytes']} THEN {out(scanned=one, reason=limit, code=quote('INPUT_LIMIT_EXCEEDED'))} "
        f"WHEN {event}.kind = 'key' THEN {key} WHEN {alone} IS NULL AND {long_clean} THEN {out(scanned=clean, reason=limit, code=quote('INPUT_LIMIT_EXCEEDED'))} "
        f"WHEN {alone} IS NULL THEN {out(f'{event}.t', scanned=clean)} ELSE {leaf} END"
    )


def _spent(memo: bool) -> str:
    """What all events in x.d and x.e take of an operation's budget; of short texts that repeat the first alone."""
    texts = "flatten(x.d.scanned)"
    known = f"slice(array_distinct(filter(s_, t_ -> length(t_) <= {MEMO_LENGTH})), 1, {MEMO})" if memo else "cast(array() as array<string>)"
    repeated = f"t_ -> length(t_) > {MEMO_LENGTH} OR (size(k_) >= {MEMO} AND NOT array_contains(k_, t_))" if memo else "t_ -> true"
    octets = lambda xs: f"aggregate({xs}, 0L, (b_, t_) -> b_ + octet_length(t_))"
    count = lambda *kinds: f"cast({_of_kind(*kinds)} as bigint)"
    def all_of(scans: str, size: str) -> str:
        return struct(nodes=count("open", "node", "leaf"), keys=count("key"), leaves=count("leaf"), scans=f"cast({scans} as bigint)", bytes=f"cast({size} as bigint)", findings="cast(size(flatten(x.d.findings)) as bigint)")

    long = let("k_", known, let("o_", f"filter(s_, {repeated})", all_of("size(k_) + size(o_)", f"{octets('k_')} + {octets('o_')}")))
    if not memo:
        return let("s_", texts, long)
    # few texts, short together, are all remembered: the engine's own functions count them
    short = let("k_", "array_distinct(s_)", all_of("size(k_)", "octet_length(array_join(k_, ''))"))
    return let("s_", texts, f"CASE WHEN size(s_) <= {MEMO} AND octet_length(array_join(s_, '')) <= {MEMO_LENGTH} THEN {short} ELSE {long} END")


def _ends(most: dict[str, int], memo: bool) -> str:
    """struct<hard, found>: the places of the first events that the budget has no room for, by what is charged before their
    scans and by their findings. Looked for only where the sums of all events are over the budget."""
    add = {
        "nodes": f"CASE WHEN {_NODE} THEN 1L ELSE 0L END", "keys": "CASE WHEN e_.kind = 'key' THEN 1L ELSE 0L END", "leaves": "CASE WHEN e_.kind = 'leaf' THEN 1L ELSE 0L END",
        "scans": "cast(size(f_) as bigint)", "bytes": "aggregate(f_, 0L, (b_, t_) -> b_ + octet_length(t_))", "findings": "cast(size(d_.findings) as bigint)",
    }
    fresh = f"filter(array_distinct(d_.scanned), t_ -> length(t_) > {MEMO_LENGTH} OR NOT array_contains(q_.known, t_))" if memo else "d_.scanned"
    known = f"CASE WHEN size(q_.known) < {MEMO} THEN slice(concat(q_.known, filter(f_, t_ -> length(t_) <= {MEMO_LENGTH})), 1, {MEMO}) ELSE q_.known END" if memo else "q_.known"
    over = " OR ".join(f"u_.{u} > {most[f'max_{u}']}" for u in USED if u != "findings")
    nxt = struct(at="q_.at + 1", now="u_", known=known, hard=f"coalesce(q_.hard, CASE WHEN {over} THEN q_.at END)", found=f"coalesce(q_.found, CASE WHEN u_.findings > {most['max_findings']} THEN q_.at END)")
    step = let("d_", "get(x.d, q_.at)", let("f_", fresh, let("u_", struct(**{u: f"q_.now.{u} + {c}" for u, c in add.items()}), nxt)))
    zero = struct(at="0", now=struct(**{u: "0L" for u in USED}), known="cast(array() as array<string>)", hard="cast(null as int)", found="cast(null as int)")
    return f"aggregate(x.e, {zero}, (q_, e_) -> {step})"


def _seen(events: str, judged: str, label: str, part: str, scope: str | None) -> str:
    """The findings of judged events, each with its place among keys or leaves."""
    scope, kind = scope or "cast(null as string)", f"get({events}, i_).kind"
    # the few events of most values are counted anew for each finding, by the engine's own functions
    nth = lambda of, name: f"CASE WHEN x.{name} IS NULL THEN i_ - size(array_remove(slice({events}.kind, 1, i_), '{of}')) ELSE cast(get(x.{name}, i_) as int) END"
    where = {
        "partIndex": part, "rangeScope": f"coalesce({scope}, CASE WHEN {kind} = 'key' THEN 'key' ELSE 'leaf' END)",
        "leafOrdinal": f"CASE WHEN {scope} IS NULL AND {kind} = 'leaf' THEN {nth('leaf', 'leaves')} END", "keyOrdinal": f"CASE WHEN {scope} IS NULL AND {kind} = 'key' THEN {nth('key', 'keys')} END",
    }
    fields = ("id", "type", "detector", "confidence", "action", "obfuscation", "start", "end")
    one = "named_struct(" + ", ".join([f"'{f}', f_.{f}" for f in fields] + [f"'{k}', {v}" for k, v in where.items()] + [f"'boundary', {quote(label)}"]) + ")"
    return f"flatten(transform({judged}, (d_, i_) -> transform(d_.findings, f_ -> {one})))"


def judge(df: DataFrame, rules: Strict, label: str = "user-input", part: str = "0", scope: str | None = None, memo: bool = True) -> DataFrame:
    """df, which has fg_e (array of EVENT), with fg_d (its judged events up to the first refusal of shape), fg_bad
    struct<reason, code> of the first refusal of all (null: none), fg_kept and fg_seen (findings of a value that is released,
    and those that an observer sees), and fg_spent. part, scope: SQL of a finding's part and of its scope, where that is
    neither a leaf's nor a key's."""
    most, budget = rules.most(), rules.budget()
    out = df

    def step(name: str, body: str, *of: str) -> None:
        nonlocal out
        value, _ = with_callables(rules.config, **{k: F.col(f"fg_{k}") for k in of})
        out = out.withColumn(f"fg_{name}", apply(value, f"x -> {body}"))

    _, names = with_callables(rules.config)
    # what is too deep or one node too many is refused before anything behind it is scanned
    node, deep = f"CASE WHEN {_NODE} THEN 1L ELSE 0L END", "CASE WHEN e_.kind = 'open' THEN 1L WHEN e_.kind = 'close' THEN -1L ELSE 0L END"
    places = let("n_", running_sql(f"transform(x.e, e_ -> {node})"), let("u_", running_sql(f"transform(x.e, e_ -> {deep})"), f"transform(x.e, (e_, i_) -> CASE WHEN {node} = 1 AND get(n_, i_) + 1 > {most['max_nodes']} OR e_.kind = 'open' AND get(u_, i_) + 1 > {most['max_depth']} THEN i_ END)"))
    few = f"(size(x.e) <= {most['max_nodes']} OR {_of_kind('open', 'node', 'leaf')} <= {most['max_nodes']}) AND (size(x.e) <= {most['max_depth']} OR {_of_kind('open')} <= {most['max_depth']})"
    step("over", f"CASE WHEN {few} THEN cast(null as int) ELSE get(filter({places}, p_ -> p_ IS NOT NULL), 0) END", "e")
    step("e", "CASE WHEN x.over IS NULL THEN x.e ELSE slice(x.e, 1, x.over) END", "e", "over")
    seen = let("y_", f"CASE WHEN ev_.kind = 'key' OR ev_.k IS NULL THEN ev_.t ELSE {view_sql('ev_.t', 'ev_.k')} END", sign_sql("y_", rules.config))
    step("alone", f"transform(x.e, ev_ -> CASE WHEN {among('ev_.kind', 'leaf', 'key')} AND octet_length(ev_.t) <= {most['max_input_bytes']} AND {seen} THEN {scan_sql('ev_.t', rules.config, None, 'x', names)} END)", "e")
    step("d", f"transform(x.e, (ev_, evi_) -> {judged_sql(rules, names)})", "e", "alone")
    step("first", "CASE WHEN array_join(x.d.reason, '') <> '' THEN get(filter(transform(x.d, (d_, i_) -> CASE WHEN d_.reason IS NOT NULL THEN i_ END), p_ -> p_ IS NOT NULL), 0) END", "d")
    step("e", "CASE WHEN x.first IS NULL THEN x.e ELSE slice(x.e, 1, x.first + 1) END", "e", "first")
    step("d", "CASE WHEN x.first IS NULL THEN x.d ELSE slice(x.d, 1, x.first + 1) END", "d", "first")
    step("spent", _spent(memo), "e", "d")
    over = " OR ".join(f"x.spent.{u} > {budget[f'max_{u}']}" for u in USED)
    step("ends", f"CASE WHEN {over} THEN {let('z_', _ends(budget, memo), struct(hard='z_.hard', found='z_.found'))} END", "e", "d", "spent")
    refused = let("d_", "get(x.d, x.first)", struct(reason="d_.reason", code="d_.code"))
    limit = struct(reason="'limit_exceeded'", code="cast(null as string)")
    hard = "coalesce(x.ends.hard <= coalesce(x.first, 2147483647), false)"
    found = "coalesce(x.ends.found < coalesce(x.first, 2147483647) OR x.ends.found = x.first AND size(get(x.d, x.first).findings) > 0, false)"
    step("bad", f"CASE WHEN {hard} OR {found} THEN {limit} WHEN x.first IS NOT NULL THEN {refused} WHEN x.over IS NOT NULL THEN {limit} END", "d", "first", "over", "ends")
    ordinal = lambda kind: running_sql(f"transform(x.e, e_ -> CASE WHEN e_.kind = '{kind}' THEN 1L ELSE 0L END)")
    step("leaves", f"CASE WHEN size(x.e) > {FEW} AND {_ANY} THEN {ordinal('leaf')} END", "e", "d")
    step("keys", f"CASE WHEN size(x.e) > {FEW} AND {_ANY} THEN {ordinal('key')} END", "e", "d")
    shown = "CASE WHEN x.ends IS NULL THEN x.d ELSE slice(x.d, 1, least(coalesce(x.ends.hard, 2147483647), coalesce(x.ends.found, 2147483647))) END"
    step("seen", f"CASE WHEN x.d IS NOT NULL AND NOT {_ANY} THEN cast(array() as {SEEN}) ELSE {_seen('x.e', shown, label, part, scope)} END", "e", "d", "ends", "leaves", "keys")
    step("kept", "CASE WHEN x.bad IS NULL THEN filter(x.seen, f_ -> f_.rangeScope <> 'key') END", "seen", "bad")
    return out


#: What judge adds, and its input.
STEPS = tuple(f"fg_{n}" for n in ("e", "over", "alone", "d", "first", "spent", "ends", "bad", "leaves", "keys", "seen", "kept"))


# --- typed columns -----------------------------------------------------------------------------------------


class Events:
    """Events of a typed value, and the value built again from its judged leaves, as SQL text."""

    def __init__(self):
        self.used = 0

    def _var(self) -> str:
        self.used += 1
        return f"v{self.used}_"

    @staticmethod
    def one(kind: str, key: str | None = None, text: str | None = None, up: str = "1L", bad: str | None = None) -> str:
        return f"array({struct(kind=quote(kind), k=key or 'cast(null as string)', t=text or 'cast(null as string)', up=up, bad=bad or 'cast(null as string)')})"

    def of(self, value: str, t: T.DataType, key: str | None = None) -> str:
        """The events; a null is a scalar, whatever its type. Numbers that aren't finite, and bytes, can't be released."""
        null = f"CASE WHEN {value} IS NULL THEN {self.one('node')} ELSE "
        if isinstance(t, T.StringType):
            return null + self.one("leaf", key, value) + " END"
        if isinstance(t, T.BinaryType):
            return null + self.one("node", bad="'unsupported_value'") + " END"
        if isinstance(t, (T.DoubleType, T.FloatType)):
            return self.one("node", bad=f"CASE WHEN isnan({value}) OR abs({value}) = double('Infinity') THEN 'unsupported_value' END")
        if not isinstance(t, (T.StructType, T.ArrayType, T.MapType)):
            return self.one("node")
        if isinstance(t, T.StructType):
            inner = [p for f in t.fields for p in (self.one("key", text=quote(f.name)), self.of(_name(value, f.name), f.dataType, quote(f.name)))]
            return f"{null}concat({', '.join([self.one('open'), *inner, self.one('close')])}) END"
        x = self._var()
        if isinstance(t, T.ArrayType):
            inner = f"flatten(transform({value}, {x} -> {self.of(x, t.elementType)}))"
        elif isinstance(t.keyType, T.StringType):
            inner = f"flatten(transform(map_entries({value}), {x} -> concat({self.one('key', text=f'{x}.key')}, {self.of(f'{x}.value', t.valueType, f'{x}.key')})))"
        else:  # a key that is no text can't be one of an object
            inner = self.one("node", bad="'unsupported_value'")
        return f"{null}concat({self.one('open')}, {inner}, {self.one('close')}) END"

    def count(self, value: str, t: T.DataType) -> str:
        """How many events a value has: "1" where that is known."""
        if not isinstance(t, (T.StructType, T.ArrayType, T.MapType)):
            return "1"
        if isinstance(t, T.StructType):
            return f"CASE WHEN {value} IS NULL THEN 1 ELSE " + " + ".join([str(2 + len(t.fields)), *[self.count(_name(value, f.name), f.dataType) for f in t.fields]]) + " END"
        x, is_map = self._var(), isinstance(t, T.MapType)
        each = self.count(f"{x}.value" if is_map else x, t.valueType if is_map else t.elementType)
        return f"CASE WHEN {value} IS NULL THEN 1 ELSE aggregate({f'map_entries({value})' if is_map else value}, 2, (a{x}, {x}) -> a{x} + {int(is_map)} + {each}) END"

    def build(self, value: str, t: T.DataType, place: str) -> str:
        """The value with the texts of x.d from a place on."""
        if isinstance(t, T.StringType):
            return f"get(x.d, {place}).text"
        if not isinstance(t, (T.StructType, T.ArrayType, T.MapType)):
            return value
        if isinstance(t, T.StructType):
            if not t.fields:
                return value
            # a place is worked out once and named, and so are the sums of the sizes of earlier fields
            at, sums = self._var(), self._var()
            sizes = [self.count(_name(value, f.name), f.dataType) for f in t.fields]
            fixed = all(n == "1" for n in sizes)
            start = (lambda i: f"{at} + {2 + 2 * i}") if fixed else (lambda i: f"{at} + {2 + i} + cast(get({sums}, {i}) as int)")
            whole = f"named_struct({', '.join(f'{quote(f.name)}, {self.build(_name(value, f.name), f.dataType, start(i))}' for i, f in enumerate(t.fields))})"
            if not fixed:
                whole = let(sums, running_sql(f"array({', '.join(f'cast({n} as bigint)' for n in sizes)})"), whole)
            return f"CASE WHEN {value} IS NOT NULL THEN {let(at, place, whole)} END"
        x, i, starts, at, is_map = self._var(), self._var(), self._var(), self._var(), isinstance(t, T.MapType)
        inner, kept = (t.valueType, f"map_entries({value})") if is_map else (t.elementType, value)
        part = f"{x}.value" if is_map else x
        if self.count(part, inner) == "1":
            built = self.build(part, inner, f"{at} + {1 + int(is_map)} + {1 + int(is_map)} * {i}")
            one = f"named_struct('key', {x}.key, 'value', {built})" if is_map else built
            whole = f"transform({kept}, ({x}, {i}) -> {one})"
            return f"CASE WHEN {value} IS NOT NULL THEN {let(at, place, f'map_from_entries({whole})' if is_map else whole)} END"
        each = f"cast({int(is_map)} + {self.count(part, inner)} as bigint)"
        built = self.build(part, inner, f"{at} + {1 + int(is_map)} + cast(get({starts}, {i}) as int)")
        one = f"named_struct('key', {x}.key, 'value', {built})" if is_map else built
        whole = let(starts, running_sql(f"transform({kept}, {x} -> {each})"), f"transform({kept}, ({x}, {i}) -> {one})")
        return f"CASE WHEN {value} IS NOT NULL THEN {let(at, place, f'map_from_entries({whole})' if is_map else whole)} END"


def sanitize_column(df: DataFrame, name: str, rules: Strict = Strict(), outcome: str = "outcome", label: str = "user-input", aborted: Column | None = None) -> DataFrame:
    """df with a typed column released as a whole or null, and outcome struct<outcome, findings, emitted, reason, code, usage>.

    Every string is scanned under its direct key, every key and struct field on its own before its value; a finding that
    redacts or blocks in a key, or blocks in a value, too much depth, nodes or budget, numbers that aren't finite and bytes
    refuse the value, the first of them in document order. A null is released as it is. aborted: a condition of rows.
    """
    check_type(df.schema[name].dataType)
    kind, events = df.schema[name].dataType, Events()
    value = F.struct(F.col(name).alias("v"))
    out = judge(df.withColumn("fg_e", apply(value, f"x -> {events.of('x.v', kind)}")), rules, label)
    out = out.withColumn("fg_stop", F.coalesce(aborted, F.lit(False)) if aborted is not None else F.lit(False))
    given = F.struct(F.col(name).alias("v"), F.col("fg_d").alias("d"), (F.col("fg_bad").isNull() & ~F.col("fg_stop")).alias("ok"))
    spent = f"cast(null as struct<{', '.join(f'{u}:bigint' for u in USED)}>)"
    found = F.expr(
        "named_struct('outcome', CASE WHEN fg_stop THEN 'aborted' WHEN fg_bad IS NULL THEN 'ok' ELSE 'blocked' END, 'findings', CASE WHEN NOT fg_stop THEN fg_kept END, 'emitted', CASE WHEN NOT fg_stop THEN fg_seen END, "
        f"'reason', CASE WHEN NOT fg_stop THEN fg_bad.reason END, 'code', CASE WHEN NOT fg_stop THEN fg_bad.code END, 'usage', CASE WHEN fg_stop OR fg_bad IS NOT NULL THEN {spent} ELSE fg_spent END)"
    )
    return out.withColumns({name: fence(apply(given, f"x -> CASE WHEN x.ok THEN {events.build('x.v', kind, '0')} END")), outcome: fence(found)}).drop("fg_stop", *STEPS)


# --- JSON texts --------------------------------------------------------------------------------------------


def json_tokens(text: Column) -> Column:
    """The tokens of a text that is one strict JSON value, else null."""
    return apply(text, f"x -> CASE WHEN {is_json('x')} THEN regexp_extract_all(x, {quote(TOKEN)}, 0) END")


def json_events(tokens: Column) -> Column:
    """An event for each token: keys and strings with their texts, containers at both ends, scalars; punctuation is none."""
    is_key = "get(x, i_ + 1) <=> ':'"
    key = f"CASE WHEN NOT ({is_key}) AND get(x, i_ - 1) <=> ':' THEN {text_of('get(x, i_ - 2)')} END"
    text = struct(kind=f"CASE WHEN {is_key} THEN 'key' ELSE 'leaf' END", k=key, t=text_of("q_"), up="1L", bad=f"CASE WHEN {lone_surrogate('q_')} THEN 'core_error' END")
    kind = f"CASE WHEN {among('q_', ',', ':')} THEN 'none' WHEN {among('q_', '{', '[')} THEN 'open' WHEN {among('q_', '}', ']')} THEN 'close' ELSE 'node' END"
    other = struct(kind=kind, k=quote(None), t=quote(None), up="1L", bad=quote(None))
    one = f"CASE WHEN startswith(q_, '\"') THEN {text} ELSE {other} END"
    return apply(tokens, f"x -> cast(transform(x, (q_, i_) -> {one}) as array<{EVENT}>)")


def json_value(fields: str = "x") -> str:
    """The text of the tokens of a value whose judged events are d: compact, and changed where a text was."""
    new = f"CASE WHEN get({fields}.e, i_).kind = 'leaf' AND get({fields}.d, i_).text <> get({fields}.e, i_).t THEN {literal_of(f'get({fields}.d, i_).text')} ELSE q_ END"
    return f"array_join(transform({fields}.tokens, (q_, i_) -> {new}), '')"
