"""Masking whole values: expressions compiled from the schema, never per-row Python.

A row is one operation. Its leaves are listed in document order and masked by one expression, and the values are built again
from the masked leaves by their places. A row that surely meets no limit needs no more; of any other the charges of all its
events (containers, leaves, scalars) are summed up in order, and what a charge refuses becomes the limit marker. A row whose
leaves hold no match at all passes as it is. Costs grow with the row and not with its square.
"""

from __future__ import annotations

from dataclasses import dataclass, field

from pyspark.sql import Column, DataFrame
from pyspark.sql import functions as F
from pyspark.sql import types as T

from ..config import ScanConfig
from ..constants import BLOCKED, COUNTS, ERROR, LIMIT, OPERATION_LIMITS, WALK_LIMITS, resolve_limits
from ..functions.arrays import apply, fence, let, quote, running_sql, struct
from ..functions.leaf import CHARGED, charged_sql, mask_leaf, seen_sql, view_sql
from ..functions.scanner import CUT, KEPT, LONG, UNJUDGED, holds_sql, is_simple, rewritten_sql, scan_sql, sign_sql, start_sql, with_callables

#: Types whose values hold no text: they pass as they are.
PLAIN = (T.NumericType, T.BooleanType, T.DateType, T.TimestampType, T.TimestampNTZType, T.NullType)
LEAVES = "array<struct<k:string,t:string>>"
EVENTS = "array<struct<leaf:boolean,nodes:int,keys:int,limited:int,failed:int>>"


@dataclass(frozen=True)
class Walk:
    """limits as WALK_LIMITS; key_context: whether a leaf is also scanned under its direct key.

    operation: limits of the row's operation budget as OPERATION_LIMITS, False for none; count_dropped: whether a
    container cut to its width counts as limited; charge_nodes, charge_fields: whether values are charged as nodes and
    struct fields as keys (hosts of attribute bags charge the bags' keys and leaves alone); bare: fields of structs whose
    strings have no key.
    """

    config: ScanConfig = field(default_factory=ScanConfig)
    limits: dict | None = None
    key_context: bool = True
    operation: dict | bool | None = None
    count_dropped: bool = False
    charge_nodes: bool = True
    charge_fields: bool = True
    bare: tuple[str, ...] = ()
    #: False leaves every leaf as it is: what a walk costs without its scanner.
    scan: bool = True

    def limit(self, name: str) -> int:
        return resolve_limits(self.limits, WALK_LIMITS)[name]


@dataclass(frozen=True)
class Target:
    """One column of a row's operation: its strings' key, and the depth of its value (-1: a bag whose values are roots)."""

    name: str
    key: str | None = None
    depth: int = 0


def _is_error(t: T.DataType) -> bool:
    return isinstance(t, T.StructType) and {"type", "message", "stack"} <= set(t.fieldNames())


def check_type(t: T.DataType) -> None:
    """Fails at plan time for a type whose text the walk can't reach, so that nothing passes unmasked."""
    if isinstance(t, T.ArrayType):
        check_type(t.elementType)
    elif isinstance(t, T.MapType):
        check_type(t.valueType)
    elif isinstance(t, T.StructType):
        for f in t.fields:
            check_type(f.dataType)
    elif not isinstance(t, (T.StringType, T.BinaryType, *PLAIN)):
        raise TypeError(f"values of type {t.simpleString()} can't be masked")


def _scalar(t: T.DataType) -> bool:
    return isinstance(t, (T.BinaryType, *PLAIN))


def _name(of: str, field: str) -> str:
    return f"{of}.`{field.replace('`', '``')}`"


class Shape:
    """The expressions of one type, as SQL text: its leaves, how many they are, its events, and the value built again."""

    def __init__(self, walk: Walk):
        self.walk, self.node, self.used = walk, int(walk.charge_nodes), 0

    def _var(self) -> str:
        self.used += 1
        return f"v{self.used}_"

    def _width(self, t: T.DataType) -> int:
        return self.walk.limit("max_array_length" if isinstance(t, T.ArrayType) else "max_object_keys")

    def _kept(self, value: str, t: T.DataType) -> str:
        """The elements of an array, or the entries of a map, up to the width."""
        whole = value if isinstance(t, T.ArrayType) else f"map_entries({value})"
        return f"slice({whole}, 1, {self._width(t)})" if self._width(t) else f"filter({whole}, n_ -> false)"

    def _inner(self, t: T.DataType) -> T.DataType:
        return t.elementType if isinstance(t, T.ArrayType) else t.valueType

    def _fields(self, t: T.StructType) -> list[T.StructField]:
        return t.fields[: self.walk.limit("max_object_keys")]

    def _key(self, t: T.StructType, name: str) -> str | None:
        bare = {*self.walk.bare, *(("type", "message", "stack") if _is_error(t) else ())}
        return None if name in bare else quote(name)

    def entered(self, t: T.DataType, depth: int) -> bool:
        return depth < self.walk.limit("max_depth")

    def count(self, value: str, t: T.DataType, depth: int) -> int | str:
        """How many leaves a value has: a number where the type says it."""
        if isinstance(t, T.StringType):
            return 1
        if _scalar(t) or not self.entered(t, depth):
            return 0
        if isinstance(t, T.StructType):
            parts = [self.count(_name(value, f.name), f.dataType, depth + 1) for f in self._fields(t)]
            fixed, rest = sum(p for p in parts if isinstance(p, int)), [p for p in parts if not isinstance(p, int)]
            return " + ".join([str(fixed), *rest]) if rest else fixed
        x = self._var()
        each = self.count(x if isinstance(t, T.ArrayType) else f"{x}.value", self._inner(t), depth + 1)
        if each == 0:
            return 0
        if isinstance(each, int):
            return f"greatest(coalesce(size({self._kept(value, t)}), 0), 0) * {each}"
        return f"coalesce(aggregate({self._kept(value, t)}, 0, (a{x}, {x}) -> a{x} + {each}), 0)"

    def _leaf(self, value: str, key: str | None) -> str:
        return struct(k=(key if self.walk.key_context else None) or "cast(null as string)", t=value)

    def leaves(self, value: str, t: T.DataType, key: str | None, depth: int) -> str | None:
        """The leaves of a value with their keys; None where the type has none."""
        if isinstance(t, T.StringType):
            return f"array({self._leaf(value, key)})"
        if self.count(value, t, depth) == 0:
            return None
        if isinstance(t, T.StructType):
            parts = [self.leaves(_name(value, f.name), f.dataType, self._key(t, f.name), depth + 1) for f in self._fields(t)]
            return f"concat({', '.join(p for p in parts if p)})"
        x, inner = self._var(), self._inner(t)
        named = isinstance(t, T.MapType) and isinstance(t.keyType, T.StringType)
        part, own = x if isinstance(t, T.ArrayType) else f"{x}.value", f"{x}.key" if named else None
        if isinstance(inner, T.StringType):
            return f"coalesce(transform({self._kept(value, t)}, {x} -> {self._leaf(part, own)}), cast(array() as {LEAVES}))"
        one = self.leaves(part, inner, own, depth + 1)
        return f"coalesce(flatten(transform({self._kept(value, t)}, {x} -> {one})), cast(array() as {LEAVES}))"

    def _event(self, there: str, leaf: bool = False, nodes: str = "1", keys: int = 0, limited: str | None = None, failed: str | None = None) -> str:
        flag = lambda c: f"CASE WHEN {c} THEN 1 ELSE 0 END" if c else "0"
        return f"array({struct(leaf=str(leaf).lower(), nodes=f'CASE WHEN {there} THEN {nodes} ELSE 0 END' if self.node else '0', keys=f'CASE WHEN {there} THEN {keys} ELSE 0 END', limited=flag(limited), failed=flag(failed))})"

    def events(self, value: str, t: T.DataType, depth: int, there: str = "true", keyed: bool = False) -> str:
        """What a value is charged, in order, its leaves as leaves() lists them; there: whether its parent is there at all;
        keyed: whether its key is charged."""
        keys, given = int(keyed), f"{value} IS NOT NULL"
        if isinstance(t, T.StringType):
            return self._event(there, True, keys=keys)
        if _scalar(t):
            return self._event(there, keys=keys, failed=given if isinstance(t, T.BinaryType) else None)
        if not self.entered(t, depth):
            return self._event(there, keys=keys, limited=given)
        inside = f"({there} AND {given})"
        if isinstance(t, T.StructType):
            parts = [self.events(_name(value, f.name), f.dataType, depth + 1, inside, self.walk.charge_fields) for f in self._fields(t)]
            cut = inside if self.walk.count_dropped and len(t.fields) > len(self._fields(t)) else None
            return f"concat({', '.join([self._event(there, keys=keys, limited=cut), *parts])})"
        inner, whole = self._inner(t), f"coalesce(size({value}), 0)"
        cut = f"{inside} AND {whole} > {self._width(t)}" if self.walk.count_dropped else None
        n = f"least(greatest({whole}, 0), {self._width(t)})"
        nodes = f"{int(depth >= 0)}" + (f" + {n}" if _scalar(inner) else "")
        head = self._event(there, nodes=nodes, keys=keys, limited=cut, failed=f"{inside} AND {n} > 0" if isinstance(inner, T.BinaryType) else None)
        if _scalar(inner):
            return head
        x = self._var()
        rest = self.events(x if isinstance(t, T.ArrayType) else f"{x}.value", inner, depth + 1, "true", isinstance(t, T.MapType))
        return f"concat({head}, coalesce(flatten(transform({self._kept(value, t)}, {x} -> {rest})), cast(array() as {EVENTS})))"

    def total(self, what: str, value: str, t: T.DataType, depth: int, there: str = "true", keyed: bool = False) -> str:
        """The sum of what (nodes or keys) over a value's events, without a list of them."""
        given = f"{value} IS NOT NULL"
        flag = lambda n: n if there == "true" else f"CASE WHEN {there} THEN {n} ELSE 0 END"
        own = flag(str(int(keyed)) if what == "keys" else str(self.node))
        if isinstance(t, T.StringType) or _scalar(t) or not self.entered(t, depth):
            return own
        inside = given if there == "true" else f"{there} AND {given}"
        if isinstance(t, T.StructType):
            return " + ".join([own, *[self.total(what, _name(value, f.name), f.dataType, depth + 1, inside, self.walk.charge_fields) for f in self._fields(t)]])
        inner, n = self._inner(t), f"least(greatest(coalesce(size({value}), 0), 0), {self._width(t)})"
        if what == "nodes":
            own = flag(f"({int(depth >= 0)}{f' + {n}' if _scalar(inner) else ''})") if self.node else "0"
        if _scalar(inner) or what == "nodes" and not self.node:
            return own
        x = self._var()
        each = self.total(what, x if isinstance(t, T.ArrayType) else f"{x}.value", inner, depth + 1, "true", isinstance(t, T.MapType))
        return f"{own} + " + (f"{n} * {each}" if each.isdigit() else f"coalesce(aggregate({self._kept(value, t)}, 0, (a{x}, {x}) -> a{x} + {each}), 0)")

    def build(self, value: str, t: T.DataType, depth: int, place: str) -> str:
        """The value with the leaves that done_ holds from a place on."""
        if isinstance(t, T.StringType):
            return f"get(done_, {place})"
        if isinstance(t, T.BinaryType):
            return f"CASE WHEN {value} IS NOT NULL THEN cast({quote(ERROR)} as binary) END"
        if _scalar(t):
            return value
        if not self.entered(t, depth):
            return f"CASE WHEN {value} IS NOT NULL THEN {_refused(t, LIMIT)} END"
        if isinstance(t, T.StructType):
            fields, at = [], place
            for f in self._fields(t):
                fields.append(f"{quote(f.name)}, {self.build(_name(value, f.name), f.dataType, depth + 1, at)}")
                n = self.count(_name(value, f.name), f.dataType, depth + 1)
                at = f"{at} + {n}" if n != 0 else at
            return f"CASE WHEN {value} IS NOT NULL THEN named_struct({', '.join(fields)}) END" if fields else value
        if not place.isdigit():  # worked out once, not for each leaf
            at = self._var()
            return let(at, place, self._built(value, t, depth, at))
        return self._built(value, t, depth, place)

    def _built(self, value: str, t: T.ArrayType | T.MapType, depth: int, place: str) -> str:
        inner, kept, x, i = self._inner(t), self._kept(value, t), self._var(), self._var()
        is_map = isinstance(t, T.MapType)
        part = f"{x}.value" if is_map else x
        made = (lambda xs: f"map_from_entries({xs})") if is_map else (lambda xs: xs)
        put = (lambda v: f"named_struct('key', {x}.key, 'value', {v})") if is_map else (lambda v: v)
        each = self.count(part, inner, depth + 1)
        if each == 0:
            return made(f"transform({kept}, {x} -> {put(self.build(part, inner, depth + 1, place))})")
        if isinstance(each, int):
            return made(f"transform({kept}, ({x}, {i}) -> {put(self.build(part, inner, depth + 1, f'{place} + {i} * {each}'))})")
        starts = self._var()
        sums = running_sql(f"transform({kept}, {x} -> cast({each} as bigint))")
        return made(let(starts, sums, f"transform({kept}, ({x}, {i}) -> {put(self.build(part, inner, depth + 1, f'{place} + cast(get({starts}, {i}) as int)'))})"))

    def bound(self, value: str, t: T.DataType, depth: int) -> tuple[int, int, int, list[str]] | None:
        """(least texts, events beside them, events for each text at most, counts of more events) of a value; None where a walk
        may change it without a match. Elements that may be without a text are counted as they are."""
        if isinstance(t, T.StringType):
            return 1, 0, 1, []
        if _scalar(t):
            return None if isinstance(t, T.BinaryType) else (0, 1, 1, [])
        if not self.entered(t, depth):
            return None
        if isinstance(t, T.StructType):
            parts = [self.bound(_name(value, f.name), f.dataType, depth + 1) for f in t.fields]
            if None in parts or len(t.fields) > len(self._fields(t)):
                return None
            return sum(p[0] for p in parts), 1 + sum(p[1] for p in parts), max([p[2] for p in parts], default=1), [c for p in parts for c in p[3]]
        x = self._var()
        inner = self.bound(x, self._inner(t), depth + 1)
        if inner is None:
            return None
        least, other, each, more = inner
        counts = []
        if more:
            values = value if isinstance(t, T.ArrayType) else f"map_values({value})"
            counts.append(f"coalesce(aggregate({values}, 0L, (a{x}, {x}) -> a{x} + {' + '.join(more)}), 0L)")
        if least:
            return 0, 1, other + each, counts
        return 0, 1, each, [f"cast(greatest(coalesce(size({value}), 0), 0) as bigint) * {other}", *counts]


def _refused(t: T.DataType, marker: str) -> str:
    """What stands for a container that isn't entered: the marker where the type can hold it, else null."""
    if isinstance(t, T.ArrayType) and isinstance(t.elementType, T.StringType):
        return f"array({quote(marker)})"
    if isinstance(t, T.MapType) and isinstance(t.valueType, T.StringType) and isinstance(t.keyType, T.StringType):
        return f"map('marker', {quote(marker)})"
    return f"cast(null as {t.simpleString()})"


USED = ("nodes", "keys", "leaves", "scans", "bytes", "findings")
ZERO = struct(**{u: "0L" for u in USED})
#: The ways of a row: as it is, masked without a look at limits, with its charges summed up, and rewritten as one text.
SAME, SMALL, CHARGE, ONCE = 0, 1, 2, 3
#: Stands between the texts of a row's leaves. No match goes past it, and it stands for a text's start.
MARK, BETWEEN = "\u0003", "\n\u0003\n"


def operation_limits(walk: Walk) -> dict[str, int] | None:
    return None if walk.operation is False else resolve_limits(walk.operation if isinstance(walk.operation, dict) else None, OPERATION_LIMITS)


def allowed_sql(used: str, walk: Walk, before: str | None = None) -> str:
    """Whether counters are within the limits of the walk and, with those before it, of its operation."""
    tests = [f"{used}.leaves <= {walk.limit('max_total_leaves')}"] + ([f"{used}.nodes <= {walk.limit('max_nodes')}"] if walk.charge_nodes else [])
    tests += [f"{used}.{u}{f' + {before}.{u}' if before else ''} <= {most}" for u, most in ((u, (operation_limits(walk) or {}).get(f"max_{u}")) for u in USED) if most is not None]
    return " AND ".join(tests)


def longest_of(walk: Walk, before: str | None = None, findings: bool = True) -> int:
    """The bytes of texts up to which no limit of bytes or, where asked for, of findings can be met."""
    op = operation_limits(walk)
    longest, share = min(walk.limit("max_string_length"), walk.config.max_input_bytes or 1 << 62), 2 if before else 1
    if op:
        longest = min(longest, op["max_bytes"] // 2 // share)
        if findings:
            longest = min(longest, op["max_findings"] * 4 // share)  # a finding has 8 characters and is found twice at most
    return longest


def fits_sql(walk: Walk, size: str, other: int, each: int, before: str | None = None, more: str | None = None, findings: bool = True) -> str:
    """Whether the leaves x.l are so few, and their texts of so many bytes together, that no limit can be met, that of findings
    only where asked for. other, each: events beside the leaves, and for each of them, at most; before: what the operation has
    spent, half of each limit at most; more: other events still."""
    op = operation_limits(walk)
    most = min(walk.limit("max_nodes"), walk.limit("max_total_leaves"), walk.limit("max_array_length"), walk.limit("max_object_keys"))
    longest, share = longest_of(walk, before, findings), 2 if before else 1
    if op:
        most = min(most, op["max_nodes"] // share, op["max_keys"] // share, op["max_leaves"] // share, op["max_scans"] // 2 // share)
    fits = f"{f'{each}L * size(x.l) + {more} <= {most - other}' if more else f'size(x.l) <= {(most - other) // each}'} AND {size} <= {longest}"
    if before and op:
        fits += "".join(f" AND {before}.{u} <= {op[f'max_{u}'] // 2}" for u in USED)
    return fits


def way_sql(walk: Walk, other: int, each: int, before: str | None = None, more: str | None = None) -> str:
    """The way of a row with the leaves x.l. It is SMALL if so few and short that no limit can be met, SAME if their views,
    one a line, hold no match together besides: a leaf's match shows in its view, and a view's in these lines, where a
    line's end stands for its start."""
    lines = f"array_join(transform(x.l, lf_ -> CASE WHEN lf_.k IS NULL THEN lf_.t ELSE {view_sql('lf_.t', 'lf_.k')} END), '\\n')"
    return let("y_", lines, f"CASE WHEN NOT ({fits_sql(walk, 'octet_length(y_)', other, each, before, more)}) THEN {CHARGE} WHEN {holds_sql('y_', walk.config)} THEN {SMALL} ELSE {SAME} END")


def once_texts_sql(config: ScanConfig) -> str:
    """The texts of the leaves x.l and behind each its view, empty without a key, as one text. Under a key that holds no sign of
    a match the view has the matches of the text, as none goes past the frame: for a long text its frame is enough."""
    text, between = "coalesce(lf_.t, '')", quote(BETWEEN)
    seen = f"CASE WHEN octet_length(lf_.t) > {LONG} AND NOT {sign_sql('lf_.k', config)} THEN '' ELSE {text} END"
    return f"array_join(transform(x.l, lf_ -> CASE WHEN lf_.k IS NULL THEN concat({text}, {between}) ELSE concat({text}, {between}, {view_sql(seen, 'lf_.k')}) END), {between})"


def once_way_sql(walk: Walk, other: int, each: int, before: str | None = None, more: str | None = None) -> str:
    """way_sql() of a row whose once_texts_sql() is x.j, rewritten x.r: ONCE where each match is simply rewritten. In texts so
    long that they might hold too many findings these are counted: each is a cut, or two where its view was left out."""
    marks = f"octet_length(x.j) - octet_length(replace(x.j, {quote(MARK)}, '')) = 2 * size(x.l) - 1"
    unjudged = " OR ".join(f"contains(x.j, {quote(s)})" for s in (*UNJUDGED, CUT, KEPT))
    op, short = operation_limits(walk), longest_of(walk, before)
    small = f"CASE WHEN octet_length(x.j) <= {short} THEN {SMALL} ELSE {CHARGE} END"
    many = ""
    if op and short < longest_of(walk, before, False):
        found = f"2 * (octet_length(x.r) - octet_length(replace(x.r, {quote(CUT)}, '')))"
        many = f"WHEN octet_length(x.j) > {short} AND {found} > {op['max_findings'] // (2 if before else 1)} THEN {CHARGE} "
    return (
        f"CASE WHEN NOT ({fits_sql(walk, 'octet_length(x.j)', other, each, before, more, False)}) THEN {CHARGE} WHEN {unjudged} THEN {small} "
        f"WHEN NOT contains(x.r, {quote(CUT)}) THEN {SAME} WHEN contains(x.r, {quote(KEPT)}) OR NOT {marks} THEN {small} {many}ELSE {ONCE} END"
    )


def once_leaf_sql(usage: bool) -> str:
    """The masked leaf lf_ at lfi_ from the rewritten texts x.p: the text's where anything in it was rewritten, else its view's,
    which blocks where more than the text was."""
    alone, view, head = "get(x.p, lfi_ * 2)", "get(x.p, lfi_ * 2 + 1)", "(length(lf_.k) + 5)"

    def leaf(out: str, outcome: str, findings: str, scans: str, size: str, found: str) -> str:
        return struct(text=out, outcome=quote(outcome), findings=findings, scans=scans if usage else "0", bytes=f"cast({size if usage else 0} as bigint)", found=found if usage else "0")

    one = "concat(get(w_, 0), '<SECRET_1>', get(w_, 1))"
    more = "array_join(transform(w_, (s_, j_) -> CASE WHEN j_ = 0 THEN s_ ELSE concat('<SECRET_', cast(j_ as string), '>', s_) END), '')"
    redacted = lambda text, scans, size: let("w_", f"split({text}, {quote(CUT)}, -1)", leaf(f"CASE WHEN size(w_) = 2 THEN {one} ELSE {more} END", "redacted", "size(w_) - 1", scans, size, "size(w_) - 1"))
    octets = "octet_length(lf_.t)"
    both = f"{octets} * 2 + octet_length(lf_.k) + 7"
    framed = f"startswith({view}, concat('{{\"', lf_.k, '\":\"')) AND endswith({view}, '\"}}') AND length({view}) >= {head} + 2"
    blocked = leaf(quote(BLOCKED), "blocked", "0", "2", both, f"size(split({view}, {quote(CUT)}, -1)) - 1")
    seen = f"CASE WHEN {framed} THEN {redacted(f'substr({view}, {head} + 1, length({view}) - {head} - 2)', '2', both)} ELSE {blocked} END"
    return f"CASE WHEN lf_.t IS NULL THEN NULL WHEN contains({alone}, {quote(CUT)}) THEN {redacted(alone, '1', octets)} WHEN contains({view}, {quote(CUT)}) THEN {seen} ELSE {unchanged_sql('lf_', usage)} END"


def _sums(nodes: str, keys: str) -> str:
    total = lambda charge: f"aggregate(x.m, 0L, (s_, z_) -> s_ + {charge})"
    return struct(nodes=nodes, keys=keys, leaves="cast(size(filter(x.m, z_ -> z_ IS NOT NULL)) as bigint)", scans=total("coalesce(z_.scans, 0)"), bytes=total("coalesce(z_.bytes, 0L)"), findings=total("coalesce(z_.found, 0)"))


def spent_sql() -> str:
    """charges_sql() of a row that meets no limit, with x.nodes and x.keys."""
    sums = _sums("cast(x.nodes as bigint)", "cast(x.keys as bigint)")
    return let("t_", sums, struct(now="t_", at="size(x.m)", k="size(x.m)", last="t_", limited="0", failed="0"))


def charges_sql(events: str, walk: Walk, before: str | None = None) -> str:
    """struct<nodes.., k, last, all, limited, failed>: how many leaves of x.m stay within all limits (charges never go down, so
    they come first), what was spent up to there, and the refusals that no leaf stands for."""
    add = {"nodes": "e_.nodes", "keys": "e_.keys", "leaves": "CASE WHEN c_ IS NULL THEN 0 ELSE 1 END", "scans": "coalesce(c_.scans, 0)", "bytes": "coalesce(c_.bytes, 0)", "findings": "coalesce(c_.found, 0)"}
    spent = struct(**{u: f"q_.now.{u} + cast({add[u]} as bigint)" for u in USED})
    ok = allowed_sql("u_", walk, before)
    nxt = struct(
        now="u_", at="q_.at + CASE WHEN e_.leaf THEN 1 ELSE 0 END", k="q_.k + CASE WHEN e_.leaf AND o_ THEN 1 ELSE 0 END", last="CASE WHEN o_ THEN u_ ELSE q_.last END",
        limited="q_.limited + e_.limited", failed="q_.failed + e_.failed",
    )
    step = let("c_", "CASE WHEN e_.leaf THEN get(x.m, q_.at) END", let("u_", spent, let("o_", ok, nxt)))
    zero = struct(now=ZERO, at="0", k="0", last=ZERO, limited="0", failed="0")
    # charges only add up: where their sums are within all limits nothing is refused, and no place is looked for
    total = lambda of, charge: f"aggregate({of}, 0L, (s_, z_) -> s_ + {charge})"
    sums = _sums(total("ev_", "z_.nodes"), total("ev_", "z_.keys"))
    whole = struct(now="t_", at="size(x.m)", k="size(x.m)", last="t_", limited=f"cast({total('ev_', 'z_.limited')} as int)", failed=f"cast({total('ev_', 'z_.failed')} as int)")
    return let("ev_", events, let("t_", sums, f"CASE WHEN {allowed_sql('t_', walk, before)} THEN {whole} ELSE aggregate(ev_, {zero}, (q_, e_) -> {step}) END"))


def unchanged_sql(leaf: str, charged: bool = True) -> str:
    """The masked leaf of one without a match."""
    scans, size = f"CASE WHEN {leaf}.k IS NULL THEN 1 ELSE 2 END", f"CASE WHEN {leaf}.k IS NULL THEN octet_length({leaf}.t) ELSE octet_length({leaf}.t) * 2 + octet_length({leaf}.k) + 7 END"
    same = struct(text=f"{leaf}.t", outcome="'unchanged'", findings="0", scans=scans if charged else "0", bytes=f"cast({size if charged else 0} as bigint)", found="0")
    return f"CASE WHEN {leaf}.t IS NOT NULL THEN {same} END"


def mask_leaves(df: DataFrame, events: Column, walk: Walk, small: tuple[int, int] | None, usage: bool = True, before: str | None = None, total: tuple[Column, Column] | None = None, more: Column | None = None) -> DataFrame:
    """df with fg_way (the row's way), fg_m (the masked leaves of its column fg_l, within all limits) and fg_a (charges_sql,
    null where it wasn't needed). Where usage isn't asked for, fg_m is null for a row whose way is SAME. events: the row's
    events, made only where they are summed up; small: other and each of way_sql, None where a row can't be told; before: a
    column with what its operation has spent; total: the nodes and keys of all events; more: events that small doesn't
    bound. Each step is a column of its own, since one expression of all would nest too deeply for the analyser."""
    def step(name: str, body: str, *of: str, **more: Column) -> None:
        nonlocal out
        value, _ = with_callables(walk.config, **{k: F.col(f"fg_{k}") for k in of}, **more)
        out = out.withColumn(f"fg_{name}", apply(value, f"x -> {body}"))

    _, names = with_callables(walk.config)
    out, past = df, {"before": F.col(before)} if before else {}
    spent = "x.before" if before else None
    among, others = ("x.more", {"more": more}) if more is not None else (None, {})
    once = bool(small and walk.scan and is_simple(walk.config))
    if once:
        step("j", once_texts_sql(walk.config), "l")
        longest = longest_of(walk, before, False)
        cut = lambda of: f"cast(substr(cast(fg_j as binary), {of}) as string)"
        out = out.withColumn("fg_at", apply(F.col("fg_j"), f"x -> CASE WHEN octet_length(x) <= {longest} THEN {start_sql('x', walk.config)} END"))
        out = out.withColumn("fg_r", F.expr(f"CASE WHEN octet_length(fg_j) <= {longest} THEN CASE WHEN fg_at IS NULL THEN fg_j ELSE concat({cut('1, fg_at')}, {rewritten_sql(cut('fg_at + 1'))}) END END"))
        step("way", once_way_sql(walk, *small, spent, among), "l", "j", "r", **past, **others)
    elif small and walk.scan:
        step("way", way_sql(walk, *small, spent, among), "l", **past, **others)
    else:
        out = out.withColumn("fg_way", F.lit(CHARGE))
    if walk.scan:
        alone = f"transform(x.l, lf_ -> CASE WHEN {seen_sql('lf_.t', 'lf_.k' if walk.key_context else None, walk.config)} THEN {scan_sql('lf_.t', walk.config, None, 'x', names)} END)"
        step("alone", f"CASE WHEN x.way = {SMALL} OR x.way = {CHARGE} THEN {alone} END", "l", "way")
        masked = charged_sql("lf_.t", "lf_.k" if walk.key_context else None, walk.config, walk.limit("max_string_length"), "x", names, "get(x.alone, i_)").replace("get(x.alone, i_)", "get(x.alone, lfi_)")
        same = f"cast(transform(x.l, lf_ -> {unchanged_sql('lf_')}) as array<{CHARGED}>)" if usage else f"cast(null as array<{CHARGED}>)"
        others = f"WHEN x.way = {ONCE} THEN cast(transform(x.l, (lf_, lfi_) -> {once_leaf_sql(usage)}) as array<{CHARGED}>) " if once else ""
        if once:
            out = out.withColumn("fg_p", F.expr(f"CASE WHEN fg_way = {ONCE} THEN split(fg_r, {quote(BETWEEN)}, -1) END"))
        step("m", f"CASE WHEN x.way = {SAME} THEN {same} {others}ELSE transform(x.l, (lf_, lfi_) -> {masked}) END", "l", "way", "alone", *(["p"] if once else []))
    else:
        step("m", f"cast(transform(x.l, lf_ -> {unchanged_sql('lf_', False)}) as array<{CHARGED}>)", "l")
    summed, rest = F.col("fg_way") == CHARGE if total or not usage else F.lit(True), {}
    if usage and total:
        rest = {"nodes": F.when(~summed, total[0]), "keys": F.when(~summed, total[1])}
    others = f"ELSE {spent_sql()} " if rest else ""
    step("a", f"CASE WHEN x.events IS NOT NULL THEN {charges_sql('x.events', walk, spent)} {others}END", "m", events=F.when(summed, events), **rest, **past)
    marker = struct(text=quote(LIMIT), outcome="'limited'", findings="0", scans="0", bytes="0L", found="0")
    cut = f"cast(transform(x.m, (c_, i_) -> CASE WHEN i_ < x.a.k OR c_ IS NULL THEN c_ ELSE {marker} END) as array<{CHARGED}>)"
    step("m", f"CASE WHEN x.a IS NULL OR x.a.k >= size(x.m) THEN x.m ELSE {cut} END", "m", "a")
    return out


#: What mask_leaves adds, and its input.
STEPS = ("fg_l", "fg_j", "fg_at", "fg_r", "fg_way", "fg_alone", "fg_p", "fg_m", "fg_a")


def counts_sql() -> str:
    """The six counts over the leaves x.l, x.m and x.a."""
    own = lambda k: f"coalesce(cast(size(filter(x.m, c_ -> c_.outcome = '{k}')) as bigint), 0L)"
    scanned = "CASE WHEN x.m IS NULL THEN cast(size(filter(x.l, lf_ -> lf_.t IS NOT NULL)) as bigint) ELSE cast(size(filter(x.m, c_ -> c_ IS NOT NULL AND c_.outcome <> 'limited')) as bigint) END"
    values = {"scanned": scanned, "findings": "coalesce(aggregate(x.m, 0L, (s_, c_) -> s_ + coalesce(c_.findings, 0)), 0L)"}
    for k in COUNTS[2:]:
        values[k] = f"CASE WHEN x.m IS NULL THEN 0L ELSE {own(k)} END" + (f" + coalesce(cast(x.a.{k} as bigint), 0L)" if k in ("limited", "failed") else "")
    return struct(**{k: values[k] for k in COUNTS})


def mask_row(df: DataFrame, *targets: Target, walk: Walk = Walk(), outcome: str | None = None, usage: bool = True) -> DataFrame:
    """df with the targets' columns masked, all of a row as one operation; their types stay.

    Numbers, booleans, dates and nulls pass; bytes become the error marker; containers deeper than max_depth are refused,
    arrays, maps and structs are cut to their widths. From the first event on that passes a limit of the walk or of the
    operation all leaves become the limit marker, since charges never go down. outcome names a column
    struct<counts, usage, dropped>: the six counts of the row's leaves, what its operation spent (null unless usage is asked
    for), and whether a row can't be represented (never, as types that can't be masked fail here, at plan time).
    """
    for t in targets:
        check_type(df.schema[t.name].dataType)
    shape, usage = Shape(walk), bool(outcome) and usage
    columns = [(f"x.c{n}", df.schema[t.name].dataType, quote(t.key) if t.key is not None else None, t) for n, t in enumerate(targets)]
    row = {f"c{n}": F.col(t.name) for n, t in enumerate(targets)}
    whole = F.struct(*[c.alias(k) for k, c in row.items()], F.lit(0).alias("any"))
    leaves = [p for p in (shape.leaves(c, kind, key, t.depth) for c, kind, key, t in columns) if p]
    events = [shape.events(c, kind, t.depth) for c, kind, _, t in columns]
    bounds = [shape.bound(c, kind, t.depth) for c, kind, _, t in columns]
    small, more = None, None
    if None not in bounds:
        small, counts = (sum(b[1] for b in bounds), max([b[2] for b in bounds], default=1)), [c for b in bounds for c in b[3]]
        more = apply(whole, f"x -> {' + '.join(counts)}") if counts else None
    out = df.withColumn("fg_l", apply(whole, f"x -> concat({', '.join([*leaves, f'cast(array() as {LEAVES})'])})"))
    totals = [" + ".join([shape.total(what, c, kind, t.depth) for c, kind, _, t in columns] or ["0"]) for what in ("nodes", "keys")]
    out = mask_leaves(out, apply(whole, f"x -> concat({', '.join([*events, f'cast(array() as {EVENTS})'])})"), walk, small, usage, total=tuple(apply(whole, f"x -> {n}") for n in totals), more=more)
    built, place = {}, "0"
    for c, kind, _, t in columns:
        whole_again = shape.build(c, kind, t.depth, place)
        built[c[2:]] = f"CASE WHEN x.way = {SAME} THEN {c} ELSE {whole_again} END" if small and walk.scan else whole_again
        n = shape.count(c, kind, t.depth)
        place = f"{place} + {n}" if n != 0 else place
    given = F.struct(*[c.alias(k) for k, c in row.items()], F.col("fg_m").alias("m"), F.col("fg_way").alias("way"))
    out = out.withColumn("fg_row", apply(given, f"x -> {let('done_', 'transform(x.m, c_ -> c_.text)', struct(**built))}") if built else F.lit(None))
    found = {t.name: F.col(f"fg_row.c{n}") for n, t in enumerate(targets)}
    if outcome:
        spent = "x.a.last" if usage else f"cast(null as struct<{', '.join(f'{u}:bigint' for u in USED)}>)"
        counted = F.struct(*[F.col(f"fg_{k}").alias(k) for k in ("l", "m", "a")])
        found[outcome] = apply(counted, f"x -> {struct(counts=counts_sql(), usage=spent, dropped='false')}")
    return out.withColumns({k: fence(c) for k, c in found.items()}).drop("fg_row", *STEPS)


def mask_columns(df: DataFrame, *names: str, walk: Walk = Walk(), keyed: bool = True, outcome: str | None = None) -> DataFrame:
    """df with the named columns (all, without any) masked; a column's name is its strings' key."""
    return mask_row(df, *[Target(n, n if keyed else None) for n in names or df.columns], walk=walk, outcome=outcome)


def mask_keyed_leaves(values: Column, keys: Column, walk: Walk = Walk()) -> Column:
    """An array of leaves masked with the parallel array of keys (null: none)."""
    return F.zip_with(values, keys, lambda v, k: mask_leaf(v, k, walk.config, walk.limit("max_string_length")))


def mask_exception_text(text: Column, walk: Walk = Walk()) -> Column:
    """A formatted traceback as one leaf."""
    if walk.limit("max_depth") <= 0:
        return F.when(text.isNotNull(), LIMIT)
    return mask_leaf(text, None, walk.config, walk.limit("max_string_length"))


def mask_bytes(data: Column, walk: Walk = Walk()) -> Column:
    """Bytes as strict UTF-8 text, masked and encoded again; invalid ones become the error marker, long ones the limit marker."""
    text = F.try_validate_utf8(data.cast("string"))
    masked = mask_leaf(text, None, walk.config, walk.limit("max_string_length"))
    out = F.when(F.octet_length(data) > walk.limit("max_string_length"), LIMIT).when(text.isNull(), ERROR).otherwise(masked)
    return F.when(data.isNotNull(), out.cast("binary"))


__all__ = ["BLOCKED", "Target", "Walk", "mask_bytes", "mask_columns", "mask_exception_text", "mask_keyed_leaves", "mask_row"]
