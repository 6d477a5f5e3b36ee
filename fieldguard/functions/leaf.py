"""Masking one leaf: limits, the scan alone, the scan in the context of its key, and the outcome."""

from __future__ import annotations

from pyspark.sql import Column
from pyspark.sql import functions as F

from ..config import ScanConfig
from ..constants import BLOCKED, COUNTS, ERROR, FINDING, LIMIT, WALK_LIMITS
from .arrays import among, apply, bind, let, quote, struct
from .scanner import scan_sql, sign_sql, with_callables

LEAF = "struct<text:string,outcome:string,findings:int>"
CHARGED = "struct<text:string,outcome:string,findings:int,scans:int,bytes:bigint,found:int>"


def _has(findings: Column, *actions: str) -> Column:
    return F.exists(findings, lambda f: f["action"].isin(*actions))


def has_sql(findings: str, *actions: str) -> str:
    return f"exists({findings}, h_ -> {among('h_.action', *actions)})"


def view_sql(text: str, key: str) -> str:
    """The leaf's view in the context of its key; never escaped."""
    return f"concat('{{\"', {key}, '\":\"', {text}, '\"}}')"


def _key_view(text: str, key: str, config: ScanConfig, maps: str, names: tuple[str, ...]) -> str:
    """struct<text, findings, outside, broken, code, found> of the view for the leaf; outside: a decisive finding beyond it;
    broken: the frame didn't come back as it went in."""
    inside = "d_.start >= n_.at AND d_.end <= n_.at + n_.size"
    moved = struct(id="d_.id", type="d_.type", detector="d_.detector", confidence="d_.confidence", action="d_.action", obfuscation="d_.obfuscation", start="d_.start - n_.at", end="d_.end - n_.at")
    out = struct(
        text="substr(w_.text, n_.at + 1, length(w_.text) - n_.at - 2)", findings=f"cast(transform(filter(w_.findings, d_ -> {inside}), d_ -> {moved}) as array<{FINDING}>)", outside="o_",
        broken=f"coalesce(NOT o_ AND NOT (startswith(w_.text, concat('{{\"', {key}, '\":\"')) AND endswith(w_.text, '\"}}') AND length(w_.text) >= n_.at + 2), true)", code="w_.code", found="size(w_.findings)",
    )
    outside = f"exists(w_.findings, d_ -> NOT ({inside}) AND {among('d_.action', 'redact', 'block')})"
    return let("n_", struct(at=f"length({key}) + 5", size=f"length({text})"), let("w_", scan_sql(view_sql(text, key), config, None, maps, names), let("o_", outside, out)))


def decide_sql(text: str, key: str | None, config: ScanConfig, maps: str = "x", names: tuple[str, ...] = (), alone: str | None = None, then=struct) -> str:
    """struct<text, findings, outside, broken, code, scans, bytes, found, peak> of the leaf: alone if that redacts, blocks or
    fails, else its key's view where it redacts, blocks, or alone found nothing. Two results are never merged. scans, bytes
    and found are what both scans took and found, peak the findings of the one that found more. alone: the leaf's own scan,
    where it has been made before. then: what is made of these fields, given by name, in place of a struct."""
    alone = alone or scan_sql(text, config, None, maps, names)
    size = f"cast(octet_length({text}) as bigint)"
    fields = ("text", "findings", "outside", "broken", "code")
    own = {"text": "a_.text", "findings": "a_.findings", "outside": "false", "broken": "a_.text IS NULL", "code": "a_.code", "scans": "1", "bytes": size, "found": "size(a_.findings)", "peak": "size(a_.findings)"}
    if key is None:
        return let("a_", alone, then(**own))
    both = {"scans": "2", "bytes": f"{size} * 2 + octet_length({key}) + 7", "found": "size(a_.findings) + v_.found", "peak": "greatest(size(a_.findings), v_.found)"}
    keep = f"v_.code IS NULL AND NOT v_.outside AND NOT {has_sql('v_.findings', 'redact', 'block')} AND size(a_.findings) > 0"
    kept = {"text": "a_.text", "findings": "a_.findings", "outside": "false", "broken": "false", "code": "cast(null as string)", **both}
    view = let("v_", _key_view(text, key, config, maps, names), f"CASE WHEN {keep} THEN {then(**kept)} ELSE {then(**{f: f'v_.{f}' for f in fields}, **both)} END")
    return let("a_", alone, f"CASE WHEN {key} IS NULL OR a_.code IS NOT NULL OR {has_sql('a_.findings', 'redact', 'block')} THEN {then(**own)} ELSE {view} END")


def seen_sql(text: str, key: str | None, config: ScanConfig) -> str:
    """Whether a leaf's view may hold a match; where it doesn't, the leaf holds none either."""
    return let("y_", f"CASE WHEN {key} IS NULL THEN {text} ELSE {view_sql(text, key)} END" if key else text, sign_sql("y_", config))


def charged_sql(text: str, key: str | None, config: ScanConfig, max_string_length: int, maps: str = "x", names: tuple[str, ...] = (), alone: str | None = None) -> str:
    """charged_leaf() of a text and a key given as SQL. alone: the scan of the text alone, null where its view holds no match."""
    def leaf(out: str, outcome: str, findings: str = "0", scans: str = "0", size: str = "0", found: str = "0") -> str:
        return struct(text=out, outcome=outcome, findings=f"cast({findings} as int)", scans=f"cast({scans} as int)", bytes=f"cast({size} as bigint)", found=f"cast({found} as int)")

    octets = f"octet_length({text})"

    def judged(**r: str) -> str:
        spent = {"scans": r["scans"], "size": r["bytes"], "found": r["found"]}
        failed = f"({r['broken']}) OR {r['code']} IS NOT NULL" + (f" OR size({r['findings']}) > {config.max_findings}" if config.max_findings is not None else "")
        outcome = f"CASE WHEN {r['text']} <> {text} THEN 'redacted' ELSE 'unchanged' END"
        return (
            f"CASE WHEN {failed} THEN {leaf(quote(ERROR), quote('failed'), **spent)} WHEN {r['outside']} THEN {leaf(quote(BLOCKED), quote('blocked'), **spent)} "
            f"WHEN {has_sql(r['findings'], 'block')} THEN {leaf(quote(BLOCKED), quote('blocked'), 'size(' + r['findings'] + ')', **spent)} "
            f"ELSE {leaf(r['text'], outcome, 'size(' + r['findings'] + ')', **spent)} END"
        )

    whens = [f"WHEN {text} IS NULL THEN NULL", f"WHEN length({text}) > {max_string_length}" + (f" OR coalesce(length({key}) > {max_string_length}, false)" if key else "") + f" THEN {leaf(quote(LIMIT), quote('limited'))}"]
    if config.max_input_bytes is not None:
        whens.append(f"WHEN {octets} > {config.max_input_bytes} THEN {leaf(quote(ERROR), quote('failed'), '0', '1', octets)}")
        if key:
            acts = let("z_", alone or scan_sql(text, config, None, maps, names), f"coalesce({has_sql('z_.findings', 'redact', 'block')}, false)")
            whens.append(f"WHEN {key} IS NOT NULL AND {octets} + octet_length({key}) + 7 > {config.max_input_bytes} AND NOT {acts} THEN {leaf(quote(ERROR), quote('failed'), '0', '1', octets)}")
    scans = f"CASE WHEN {key} IS NULL THEN 1 ELSE 2 END" if key else "1"
    size = f"CASE WHEN {key} IS NULL THEN {octets} ELSE {octets} * 2 + octet_length({key}) + 7 END" if key else octets
    unseen = f"{alone} IS NULL" if alone else f"NOT {seen_sql(text, key, config)}"
    whens.append(f"WHEN {unseen} THEN {leaf(text, quote('unchanged'), '0', scans, size)}")
    return f"CASE {' '.join(whens)} ELSE {decide_sql(text, key, config, maps, names, alone, judged)} END"


def charged_leaf(text: Column, key: Column | None = None, config: ScanConfig = ScanConfig(), max_string_length: int = WALK_LIMITS["max_string_length"]) -> Column:
    """struct<text, outcome, findings, scans, bytes, found>: the masked leaf with what it spent; null for null. Limits
    come before any scan; a scan of more bytes than the whole-input limit fails, the view's as well as the leaf's. Where the
    leaf's view holds no match at all, the leaf holds none either and neither is analysed."""
    value, names = with_callables(config, t=text, **({} if key is None else {"k": key}))
    return apply(value, f"x -> {charged_sql('x.t', None if key is None else 'x.k', config, max_string_length, 'x', names)}")


def decide(text: Column, key: Column | None, config: ScanConfig) -> Column:
    value, names = with_callables(config, t=text, **({} if key is None else {"k": key}))
    return apply(value, f"x -> {decide_sql('x.t', None if key is None else 'x.k', config, 'x', names)}")


def mask_leaf_outcome(text: Column, key: Column | None = None, config: ScanConfig = ScanConfig(), max_string_length: int = WALK_LIMITS["max_string_length"]) -> Column:
    """struct<text, outcome, findings>; null for null."""
    return bind(charged_leaf(text, key, config, max_string_length), lambda m: F.when(m.isNotNull(), F.struct(m["text"].alias("text"), m["outcome"].alias("outcome"), m["findings"].alias("findings"))))


def mask_leaf(text: Column, key: Column | None = None, config: ScanConfig = ScanConfig(), max_string_length: int = WALK_LIMITS["max_string_length"]) -> Column:
    return bind(mask_leaf_outcome(text, key, config, max_string_length), lambda x: x["text"])


def counts_of(leaf: Column) -> Column:
    """The six counts of one leaf; zeros for a null."""
    o = leaf["outcome"]
    one = lambda c: F.when(F.coalesce(c, F.lit(False)), 1).otherwise(0).cast("long")
    values = {"scanned": one(o.isNotNull() & (o != "limited")), "findings": F.coalesce(leaf["findings"], F.lit(0)).cast("long")} | {k: one(o == k) for k in COUNTS[2:]}
    return F.struct(*[values[k].alias(k) for k in COUNTS])
