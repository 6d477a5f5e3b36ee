"""Detector packs compiled to expressions: scan(text) gives the rewritten text and its findings.

A pack is one combined alternation of a portable dialect (no look-around, no word boundary), tried first as a
cheap predicate, so that texts without a match are passed on untouched. Each match is split again into what
stands before the value and the value, which alone is reported and rewritten.
"""

from __future__ import annotations

from collections.abc import Callable
from dataclasses import dataclass

from pyspark.sql import Column
from pyspark.sql import functions as F

from ..config import Found, ScanConfig
from ..constants import ACTIONS, FINDING
from .arrays import among, apply, let, quote, running_sql, struct

# What the detectors look for.
_KEY = r"(?:[Dd][Bb]_|[Cc][Ll][Ii][Ee][Nn][Tt]_|[Aa][Cc][Cc][Ee][Ss][Ss]_|[Aa][Uu][Tt][Hh]_)?(?:[Aa][Pp][Ii][_-]?[Kk][Ee][Yy]|[Pp][Aa][Ss][Ss][Ww][Oo][Rr][Dd]|[Pp][Aa][Ss][Ss][Ww][Dd]|[Ss][Ee][Cc][Rr][Ee][Tt]|[Tt][Oo][Kk][Ee][Nn])"
_BEFORE = r"(?:^|[^A-Za-z0-9_])"
_ASSIGN = _BEFORE + _KEY + r"[\x22']?[ \t]*[:=][ \t]*"
_QUOTED = r"\x22[^\x22<{$*\n][^\x22\n]{7,}"
_BARE = r"[^ \t\n\r\x22'<>{}$*,;&][^ \t\n\r\x22'<>,;&]{7,}"
PRIVATE_KEY = r"-----BEGIN [A-Z ]{0,20}PRIVATE KEY-----[A-Za-z0-9+/=\s]*-----END [A-Z ]{0,20}PRIVATE KEY-----"
_GITHUB = r"gh[opsur]_[A-Za-z0-9]{36}"
_JWT = r"eyJ[A-Za-z0-9_-]{8,}\.[A-Za-z0-9_-]{8,}\.[A-Za-z0-9_-]{8,}"
_CONTEXTUAL = f"{_ASSIGN}(?:{_QUOTED}|{_BARE})"
_MAIL_WORD = r"(?:[Ee]-?[Mm]ail|[Cc]ontact)[ \t]*[:=]?[ \t]*"
_MAIL = r"[A-Za-z0-9._%+-]{1,64}@[A-Za-z0-9][A-Za-z0-9.-]{0,252}\.[A-Za-z]{2,24}"  # no group under a star: Java would recurse for each turn
#: Shortest values of contextual secrets that are found at all, and found with high confidence.
SHORTEST, CERTAIN = 8, 16


#: In lower case, what every match of the built-in detectors holds.
SIGNS = ("api_key", "api-key", "apikey", "passw", "secret", "token", "gho_", "ghp_", "ghs_", "ghu_", "ghr_", "eyj", "-----begin")


def signs_of(config: ScanConfig) -> tuple[str, ...] | None:
    """One of these stands in every text with a match; None where a ruleset makes that unknown."""
    return None if config.ruleset else (*SIGNS, "@") if config.pii else SIGNS


def sign_sql(text: str, config: ScanConfig, pack: Pack | None = None) -> str:
    """Whether a text may hold a match: most texts hold no sign of one, which is far cheaper to see than that they hold none."""
    signs = signs_of(config) if pack is None else None
    if signs is None:
        return f"({text} rlike {searched_for(pack or builtin_pack(config))})"
    return let("low_", f"lower({text})", _signs_sql(signs))


#: Starts that several signs share: where none stands, none of these signs needs be looked for.
_STARTS = ("api", "gh")


def _signs_sql(signs: tuple[str, ...]) -> str:
    """Whether low_ holds one of some signs."""
    holds = lambda *of: " OR ".join(f"contains(low_, {quote(x)})" for x in of)
    shared = [f"contains(low_, {quote(p)}) AND ({holds(*[s for s in signs if s.startswith(p)])})" for p in _STARTS]
    return " OR ".join([*shared, holds(*[s for s in signs if not s.startswith(_STARTS)])])


def holds_sql(text: str, config: ScanConfig, pack: Pack | None = None) -> str:
    """Whether a text holds a match."""
    return f"({sign_sql(text, config, pack)} AND {text} rlike {searched_for(pack or builtin_pack(config))})"


#: Stands behind what is kept of a value that isn't simply rewritten.
KEPT = "\u0004"
#: Starts of what the simple pattern doesn't judge: values that are blocked or no finding.
UNJUDGED = ("-----BEGIN", "op://")


def is_simple(config: ScanConfig) -> bool:
    """Whether a config finds and does what the simple pattern knows."""
    return not (config.policy or config.evaluate or config.formatter or config.rules or config.ruleset or config.pii) and config.max_findings is None


def rewritten_sql(text: str) -> str:
    """A text with CUT for each value that a simple config rewrites, and CUT, a part of the value and KEPT for each that it only
    warns of. The text holds neither sign, nor any start of UNJUDGED."""
    quoted, bare = r"[^\x22\n]", r"[^ \t\n\r\x22'<>,;&]"
    long_, short = f"{{{CERTAIN - 1},}}", f"{{{SHORTEST - 1},{CERTAIN - 2}}}"
    value = rf"(\x22)[^\x22<{{$*\n](?:{quoted}{long_}|({quoted}{short}))|[^ \t\n\r\x22'<>{{}}$*,;&](?:{bare}{long_}|({bare}{short}))"
    pattern = f"({_ASSIGN})(?:{value})|{_GITHUB}|{_JWT}"
    return f"replace(regexp_replace({text}, {quote(_by_class(pattern))}, concat('$1$2', {quote(CUT)}, '$3$4', {quote(KEPT)})), {quote(CUT + KEPT)}, {quote(CUT)})"


#: Bytes beyond which a text is searched from its first sign on.
LONG = 4096
#: In lower case, what every match of the simple pattern holds, and the characters that stand before it in a match at most, and one more.
_FIRST_SIGNS, _AHEAD = ("api", "passw", "secret", "token", "gh", "eyj"), 9


def start_sql(text: str, config: ScanConfig) -> str:
    """How many characters at the start of a text, all of one byte, surely come before all matches of the simple pattern; null
    where the text holds none."""
    none = "octet_length(low_)"
    first = ", ".join(f"CASE WHEN contains(low_, {quote(s)}) THEN octet_length(substring_index(low_, {quote(s)}, 1)) ELSE {none} END" for s in _FIRST_SIGNS)
    # what has as many bytes as characters is as long in lower case, so that places there are places in the text
    plain = f"CASE WHEN s_ > {_AHEAD} AND octet_length(substr({text}, 1, s_ - {_AHEAD})) = s_ - {_AHEAD} THEN s_ - {_AHEAD} ELSE 0 END"
    far = let("s_", f"least({first})", f"CASE WHEN s_ < {none} THEN {plain} END")
    return let("low_", f"lower({text})", f"CASE WHEN octet_length({text}) > {LONG} THEN {far} WHEN {_signs_sql(signs_of(config))} THEN 0 END")


def holds_match(text: Column, config: ScanConfig, pack: Pack | None = None) -> Column:
    return apply(text, f"x -> {holds_sql('x', config, pack)}")


@dataclass(frozen=True)
class Pack:
    """pattern: all detectors; before: what precedes a match's value; kinds: (type, detector, pattern of the value, confidence)
    in order, the confidence None where it depends on the value's length; ignored: values that are no finding."""

    pattern: str
    before: str
    kinds: tuple[tuple[str, str, str, str | None], ...]
    ignored: str = r"^op://"


#: What every key begins with.
_FIRST = "[DdCcAaPpSsTt]"


def _by_class(pattern: str) -> str:
    """A pattern with the engine's own class for what is no character of a word: a table where a list of ranges is gone through
    for each character of a text. Behind it a key's first letter is looked at before all its spellings are tried."""
    return pattern.replace(_BEFORE + _KEY, rf"(?:^|\W)(?={_FIRST})" + _KEY).replace("[^A-Za-z0-9_]", r"\W")


def searched_for(pack: Pack) -> str:
    """The literal of a pack's pattern as the engine searches for it."""
    return quote(_by_class(pack.pattern))


def builtin_pack(config: ScanConfig = ScanConfig()) -> Pack:
    kinds = [
        ("private_key", "private-key", f"^{PRIVATE_KEY}$", "high"),
        ("github_token", "github-token", f"^{_GITHUB}$", "high"),
        ("jwt", "jwt", f"^{_JWT}$", "high"),
    ]
    parts = [PRIVATE_KEY, _CONTEXTUAL, _GITHUB, _JWT]
    before = f"{_ASSIGN}[\\x22']?"
    if config.pii:
        kinds += [("pii_global_email", "global-email", f"^{_MAIL}$", None)]
        parts += [f"(?:{_MAIL_WORD})?{_MAIL}"]
        before = f"{before}|{_MAIL_WORD}"
    for name, pattern in config.ruleset:
        kinds.append((name, name, f"^{pattern}$", "medium"))
        parts.append(pattern)
    kinds.append(("contextual_secret", "generic-token", "", None))
    return Pack("|".join(parts), f"^(?:{before})", tuple(kinds))


#: Stands for the number in a placeholder's text, and before the code of a placeholder that failed.
NUMBER, FAILED = "\u0001", "\u0002"
#: Stands on both sides of a match where a text is cut.
CUT = "\u0000"


def _kinds(pack: Pack) -> list[Found]:
    """What is known of findings when the plan is made: each kind with each confidence that it may have."""
    return [Found(t, d, confidence) for t, d, _, c in pack.kinds for confidence in ((c,) if c is not None else ("high", "medium"))]


def _name(found: Found) -> str:
    return f"{found.type}|{found.confidence}"


def callables(config: ScanConfig, pack: Pack | None = None, formatter: Callable[[Column, Column], Column] | None = None) -> dict[str, Column]:
    """What the config's functions say of each kind of finding, as maps that travel with a text: actions, or the codes of
    what failed, and placeholders with NUMBER for the number."""
    kinds, out = _kinds(pack or builtin_pack(config)), {}

    def asked(f: Callable[[Found], Column | str | None]) -> Column:
        return F.create_map(*[x for k in kinds for x in (F.lit(_name(k)), f(k))])

    def action(k: Found) -> Column:
        if config.policy is not None:
            chosen = config.policy(F.lit(k.type), F.lit(k.confidence))
            return F.when(chosen.isin(*ACTIONS), chosen).otherwise("INVALID_POLICY_ACTION")
        try:
            chosen = config.evaluate(k)
        except Exception:  # never read
            return F.lit("POLICY_FAILURE")
        return F.lit(chosen if chosen in ACTIONS else "INVALID_POLICY_ACTION")

    def shown(k: Found) -> Column:
        if formatter is not None:
            return F.coalesce(formatter(F.lit(k.type), F.lit(NUMBER)), F.lit(FAILED + "PLACEHOLDER_FAILURE"))
        try:
            made = config.formatter(k, F.lit(NUMBER))
        except Exception:  # never read
            return F.lit(FAILED + "PLACEHOLDER_FAILURE")
        if isinstance(made, Column):
            return F.coalesce(made.cast("string"), F.lit(FAILED + "PLACEHOLDER_FAILURE"))
        # a number that was made text on the driver isn't the finding's
        return F.lit(made if isinstance(made, str) and "Column<" not in made else FAILED + "INVALID_PLACEHOLDER")

    if config.policy is not None or config.evaluate is not None:
        out["acts"] = asked(action)
    if config.formatter is not None or formatter is not None:
        out["shown"] = asked(shown)
    return out


def _cases(pack: Pack, value: str) -> str:
    """The place of the first kind whose pattern the value has."""
    whens = " ".join(f"WHEN {value} rlike {quote(p)} THEN {i}" for i, (_, _, p, _) in enumerate(pack.kinds) if p)
    rest = next((str(i) for i, k in enumerate(pack.kinds) if not k[2]), "null")
    return f"CASE {whens} ELSE {rest} END"


def _confidences(pack: Pack, prefix: str, value: str, kind: str) -> str:
    whens = []
    for i, (t, _, _, c) in enumerate(pack.kinds):
        sure = f"length({prefix}) > 0" if t == "pii_global_email" else f"length({value}) >= {CERTAIN}"
        whens.append(f"WHEN {kind} = {i} THEN " + (quote(c) if c is not None else f"CASE WHEN {sure} THEN 'high' ELSE 'medium' END"))
    return f"CASE {' '.join(whens)} END"


def scan_sql(text: str, config: ScanConfig, pack: Pack | None = None, maps: str = "x", names: tuple[str, ...] = ()) -> str:
    """scan() of a text given as SQL; maps: the variable whose fields acts and shown, where they are among names, are those of
    callables()."""
    given, pack = pack, pack or builtin_pack(config)
    empty = f"cast(array() as array<{FINDING}>)"
    pick = lambda place, i: f"get(array({', '.join(quote(k[i]) for k in pack.kinds)}), {place})"
    which = lambda t, c: f"concat({t}, '|', {c})"
    acts = lambda t, c: f"coalesce({maps}.acts[{which(t, c)}], 'INVALID_POLICY_ACTION')" if "acts" in names else config.action_sql(t, c)
    shows = lambda t, c, number: f"replace({maps}.shown[{which(t, c)}], {quote(NUMBER)}, {number})" if "shown" in names else f"concat('<SECRET_', {number}, '>')"
    act, shown = acts("k_.type", "k_.confidence"), shows("k_.type", "k_.confidence", "cast(get(u_.numbers, i_) + 1 as string)")
    prefix = let("b_", f"regexp_extract(q_, {quote(_by_class(pack.before))}, 0)", "CASE WHEN length(b_) < length(q_) THEN b_ ELSE '' END")
    sides = let("p_", prefix, struct(prefix="p_", value="substr(q_, length(p_) + 1)"))
    sorted_ = struct(prefix="k_.prefix", value="k_.value", kind=_cases(pack, "k_.value"), ignored=f"k_.value rlike {quote(pack.ignored)}")
    sure = struct(prefix="k_.prefix", value="k_.value", ignored="k_.ignored", type=pick("k_.kind", 0), detector=pick("k_.kind", 1), confidence=_confidences(pack, "k_.prefix", "k_.value", "k_.kind"))
    acted = struct(prefix="k_.prefix", value="k_.value", ignored="k_.ignored", type="k_.type", detector="k_.detector", confidence="k_.confidence", action=f"CASE WHEN k_.ignored THEN 'allow' ELSE {act} END")
    found = f"transform(transform(transform(transform(m_.matches, q_ -> {sides}), k_ -> {sorted_}), k_ -> {sure}), k_ -> {acted})"
    # places and numbers are running sums over gaps and matches, so that nothing is looked for from the start again
    lengths = "transform(f_, (k_, i_) -> cast(length(get(m_.gaps, i_)) + length(k_.prefix) + length(k_.value) as bigint))"
    sums = struct(starts=running_sql(lengths), numbers=running_sql("transform(f_, k_ -> CASE WHEN k_.action = 'redact' THEN 1L ELSE 0L END)"))
    start = "get(u_.starts, i_) + length(get(m_.gaps, i_)) + length(k_.prefix)"
    whole = struct(ignored="k_.ignored", type="k_.type", detector="k_.detector", confidence="k_.confidence", action="k_.action", start=f"cast({start} as int)", end=f"cast({start} + length(k_.value) as int)")
    numbered = struct(id="concat('finding-', cast(i_ + 1 as string))", type="g_.type", detector="g_.detector", confidence="g_.confidence", action="g_.action", obfuscation="'none'", start="g_.start", end="g_.end")
    findings = f"cast(transform(filter(transform(f_, (k_, i_) -> {whole}), g_ -> NOT g_.ignored), (g_, i_) -> {numbered}) as array<{FINDING}>)"
    failed = f"get(filter(concat(transform(f_, k_ -> CASE WHEN NOT {among('k_.action', *ACTIONS)} THEN k_.action END), transform(s_, y_ -> CASE WHEN startswith(y_, {quote(FAILED)}) THEN substr(y_, 2) END)), c_ -> c_ IS NOT NULL), 0)"
    joined = "array_join(concat(transform(f_, (k_, i_) -> concat(get(m_.gaps, i_), k_.prefix, coalesce(get(s_, i_), k_.value))), array(get(m_.gaps, size(m_.gaps) - 1))), '')"
    out = let("s_", f"transform(f_, (k_, i_) -> CASE WHEN k_.action = 'redact' THEN {shown} END)", let("e_", failed, struct(text=f"CASE WHEN e_ IS NULL THEN {joined} END", findings=findings, code="e_")))
    # gaps and matches by turns: the text is searched once, between signs that it doesn't hold itself
    by_sign = f"split(regexp_replace(t_, {searched_for(pack)}, concat({quote(CUT)}, '$0', {quote(CUT)})), {quote(CUT)}, -1)"
    by_pattern = f"flatten(zip_with(split(t_, {searched_for(pack)}, -1), regexp_extract_all(t_, {searched_for(pack)}, 0), (g_, q_) -> array(g_, q_)))"
    turns = f"CASE WHEN contains(t_, {quote(CUT)}) THEN {by_pattern} ELSE {by_sign} END"
    parts = struct(matches="filter(r_, (q_, i_) -> i_ % 2 = 1 AND q_ IS NOT NULL)", gaps="filter(r_, (q_, i_) -> i_ % 2 = 0)")
    none = struct(text="t_", findings=empty, code="cast(null as string)")
    analysed = let("m_", parts, let("f_", found, let("u_", sums, out)))
    # most texts with a match have one, which needs no lists
    at, kind, detector = "length(get(r_, 0)) + length(p_)", pick("n_", 0), pick("n_", 1)
    only = f"array({struct(id=quote('finding-1'), type=kind, detector=detector, confidence='c_', action='a_', obfuscation=quote('none'), start=at, end=f'{at} + length(v_)')})"
    result = lambda text, code: struct(text=text, findings=f"CASE WHEN g_ THEN {empty} ELSE {only} END", code=code)
    made = "concat(get(r_, 0), p_, coalesce(y_, v_), get(r_, 2))"
    wrong = f"CASE WHEN NOT {among('a_', *ACTIONS)} THEN a_ WHEN startswith(y_, {quote(FAILED)}) THEN substr(y_, 2) END"
    single = let("e_", wrong, result(f"CASE WHEN e_ IS NULL THEN {made} END", "e_")) if names else result(made, quote(None))
    lets = {
        "q_": "get(r_, 1)", "p_": prefix, "v_": "substr(q_, length(p_) + 1)", "g_": f"v_ rlike {quote(pack.ignored)}", "n_": _cases(pack, "v_"), "c_": _confidences(pack, "p_", "v_", "n_"),
        "a_": f"CASE WHEN g_ THEN 'allow' ELSE {acts(kind, 'c_')} END", "y_": f"CASE WHEN a_ = 'redact' THEN {shows(kind, 'c_', quote('1'))} END",
    }
    for name, value in reversed(lets.items()):
        single = let(name, value, single)
    searched = let("r_", turns, f"CASE WHEN size(r_) < 3 THEN {none} WHEN size(r_) = 3 AND get(r_, 1) IS NOT NULL THEN {single} ELSE {analysed} END")
    return let("t_", text, f"CASE WHEN t_ IS NULL THEN NULL WHEN {sign_sql('t_', config, given)} THEN {searched} ELSE {none} END")


def with_callables(config: ScanConfig, **values: Column) -> tuple[Column, tuple[str, ...]]:
    """The argument of a body that scans: a struct of values beside the maps of the config's functions, and their names."""
    maps = callables(config)
    return F.struct(*[c.alias(k) for k, c in (values | maps).items()]), tuple(maps)


def scan(text: Column, config: ScanConfig = ScanConfig(), pack: Pack | None = None, formatter: Callable[[Column, Column], Column] | None = None) -> Column:
    """struct<text, findings, code>: null for a null text. Placeholders count the rewritten findings in text order.

    formatter: (type, number as text) to the placeholder; <SECRET_n> without. code: what a policy or a formatter failed
    with, else null; the text is null then. The text is split once at the pattern, and its cost doesn't grow with the
    square of its matches.
    """
    maps = callables(config, pack, formatter)
    value = F.struct(text.alias("t"), *[c.alias(k) for k, c in maps.items()])
    return apply(value, f"x -> {scan_sql('x.t', config, pack, 'x', tuple(maps))}")


def fixture_scan(text: Column) -> Column:
    """The small deterministic scanner of the tests: struct<text, findings, failed>."""
    def finding(action: str, kind: str, at: Column, n: Column) -> Column:
        f = F.struct(
            F.lit("finding-1").alias("id"), F.lit(kind).alias("type"), F.lit("fixture").alias("detector"), F.lit("high").alias("confidence"), F.lit(action).alias("action"),
            F.lit("none").alias("obfuscation"), (at - 1).cast("int").alias("start"), (at - 1 + n).cast("int").alias("end"),
        )
        return F.array(f).cast(f"array<{FINDING}>")

    none = F.expr(f"cast(array() as array<{FINDING}>)")
    token = F.regexp_extract(text, r"SECRET_TOKEN_\d+", 0)
    at = F.locate("SECRET_TOKEN_", text)
    at = F.instr(text, token)
    redacted = F.concat(F.substr(text, F.lit(1), at - 1), F.lit("<SECRET_1>"), F.substr(text, at + F.length(token)))
    return (
        F.when(text.isNull(), None)
        .when(text.contains("BOOM"), F.struct(text.alias("text"), none.alias("findings"), F.lit(True).alias("failed")))
        .when(text.contains("BLOCK_ME"), F.struct(text.alias("text"), finding("block", "fixture_block", F.locate("BLOCK_ME", text), F.lit(8)).alias("findings"), F.lit(False).alias("failed")))
        .when(token != "", F.struct(redacted.alias("text"), finding("redact", "fixture_token", at, F.length(token)).alias("findings"), F.lit(False).alias("failed")))
        .when(text.contains("WARN_ME"), F.struct(text.alias("text"), finding("warn", "fixture_warn", F.locate("WARN_ME", text), F.lit(7)).alias("findings"), F.lit(False).alias("failed")))
        .otherwise(F.struct(text.alias("text"), none.alias("findings"), F.lit(False).alias("failed")))
    )
