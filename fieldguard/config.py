"""Scan configuration: declarative policies, rulesets, versions. Checked once, on the driver."""

from __future__ import annotations

import json
import re
from collections.abc import Callable
from dataclasses import dataclass

from pyspark.sql import Column
from pyspark.sql import functions as F

from .constants import ACTIONS


class OptionsError(ValueError):
    """A fixed code and the names of options, never their values."""

    def __init__(self, code: str, options: tuple[str, ...] = (), core_code: str | None = None):
        super().__init__(f"{code}: {', '.join(options)}")
        self.code, self.options, self.core_code = code, options, core_code


def parse_policy(document: str | bytes | dict) -> tuple[tuple[tuple[str, ...], str], ...]:
    """((types, action), ...) in rule order from a declarative policy of revision 1."""
    try:
        doc = document if isinstance(document, dict) else json.loads(document)
        rules = doc["rules"]
        if doc.get("actionPolicyRevision") != 1 or doc.get("base") != "default" or set(doc) - {"actionPolicyRevision", "base", "rules"}:
            raise ValueError
        out = []
        for rule in rules:
            types, action = rule["match"]["type"], rule["action"]
            if set(rule["match"]) != {"type"} or action not in (*ACTIONS, "default") or not all(isinstance(t, str) for t in types) or not isinstance(rule["id"], str):
                raise ValueError
            out.append((tuple(types), action))
        return tuple(out)
    except (ValueError, KeyError, TypeError) as e:
        raise OptionsError("CORE_OPTION_REJECTED", ("actionPolicy",), "INVALID_ACTION_POLICY") from e


def parse_ruleset(text: str | bytes) -> tuple[tuple[str, str], ...]:
    """((detector, pattern), ...) of "name: value" lines: a revision, then six fields for each detector."""
    bad = OptionsError("CORE_OPTION_REJECTED", ("ruleset",), "INVALID_RULESET")
    lines = [x.strip().partition(": ") for x in (text.decode() if isinstance(text, bytes) else text).splitlines() if x.strip()]
    if not lines or lines[0] != ("ruleset-revision", ": ", "1") or len(lines) < 7 or len(lines) % 6 != 1:
        raise bad
    alphabets = {"alnum": "A-Za-z0-9", "alnum-dash": "A-Za-z0-9-", "hex": "0-9a-f", "digits": "0-9"}
    found = []
    for at in range(1, len(lines), 6):
        entry = {name: value for name, _, value in lines[at : at + 6]}
        if tuple(entry) != ("detector", "specificity", "prefix", "alphabet", "run", "validator"):
            raise bad
        run, prefix = re.fullmatch(r"at-least (\d+)", entry["run"]), re.fullmatch(r'"([A-Za-z0-9_-]+)"', entry["prefix"])
        if not run or not prefix or entry["alphabet"] not in alphabets or entry["validator"] != "none":
            raise bad
        found.append((entry["detector"], f"{prefix[1]}[{alphabets[entry['alphabet']]}]{{{min(int(run[1]), 1000)},}}"))
    return tuple(found)


@dataclass(frozen=True)
class Found:
    """What is known of a finding when a plan is made: no text, no place."""

    type: str
    detector: str
    confidence: str
    obfuscation: str = "none"


@dataclass(frozen=True)
class ScanConfig:
    """policy: a function of (type, confidence) Columns to an action, or rules: of a declarative policy; not both.

    evaluate and formatter are Python's: functions of a Found to an action, and of a Found and its number, a Column, to a
    placeholder (a Column, or a text that doesn't show the number). They are asked when the plan is made, once for each kind
    of finding, since there are few, so no row calls Python. What is no action, and what they raise, fails the scan of a
    text with such a finding with a code.
    """

    policy: Callable[[Column, Column], Column] | None = None
    evaluate: Callable | None = None
    formatter: Callable | None = None
    rules: tuple[tuple[tuple[str, ...], str], ...] = ()
    ruleset: tuple[tuple[str, str], ...] = ()
    pii: bool = False
    max_input_bytes: int | None = None
    max_findings: int | None = None

    def __post_init__(self):
        if (self.policy is not None or self.evaluate is not None) and self.rules:
            raise OptionsError("CORE_OPTION_REJECTED", ("policy", "actionPolicy"))

    def action_sql(self, kind: str, confidence: str) -> str:
        """The same as SQL text; a function of a policy has none."""
        default = f"CASE WHEN {kind} = 'private_key' THEN 'block' WHEN {confidence} = 'high' THEN 'redact' ELSE 'warn' END"
        if not self.rules:
            return default
        whens = " ".join(f"WHEN {kind} IN ({', '.join(repr(t) for t in types)}) THEN {default if a == 'default' else repr(a)}" for types, a in self.rules)
        return f"CASE {whens} ELSE {default} END"


def version_key(v: Column) -> Column:
    """A comparable struct of a version; null where it can't be read.

    Semantic versions with any dotted prerelease (numbers before names, fewer parts before more; build metadata doesn't
    count), and Python's short form of them: 1.2.3a1, 1.2.3b2, 1.2.3rc1.
    """
    semantic = r"^(\d+)\.(\d+)\.(\d+)(?:-([0-9A-Za-z-]+(?:\.[0-9A-Za-z-]+)*))?(?:\+[0-9A-Za-z.-]+)?$"
    short = r"^(\d+)\.(\d+)\.(\d+)(a|b|rc)(\d+)$"
    none = F.expr("cast(array() as array<struct<kind:int,number:bigint,name:string>>)")

    def part(x: Column) -> Column:
        number = F.when(x.rlike(r"^\d+$"), x.try_cast("bigint"))
        return F.struct(F.when(number.isNotNull(), 0).otherwise(1).alias("kind"), F.coalesce(number, F.lit(0)).alias("number"), F.when(number.isNotNull(), "").otherwise(x).alias("name"))

    def key(pattern: str, release: Column, parts: Column) -> Column:
        n = [F.regexp_extract(v, pattern, i).try_cast("int") for i in (1, 2, 3)]
        return F.struct(n[0].alias("a"), n[1].alias("b"), n[2].alias("c"), release.alias("d"), parts.alias("e"))

    pre, letter = F.regexp_extract(v, semantic, 4), F.regexp_extract(v, short, 4)
    named = F.when(letter == "a", "alpha").when(letter == "b", "beta").otherwise(letter)
    return (
        F.when(v.rlike(semantic), key(semantic, F.when(pre == "", 1).otherwise(0), F.when(pre == "", none).otherwise(F.transform(F.split(pre, "\\."), part))))
        .when(v.rlike(short), key(short, F.lit(0), F.array(part(named), part(F.regexp_extract(v, short, 5)))))
    )


def version_at_least(v: Column, floor: str) -> Column:
    """False for a version that can't be read."""
    return F.coalesce(version_key(v) >= version_key(F.lit(floor)), F.lit(False))


#: Options of a scan, by name, that may be given loosely instead of a checked ScanConfig.
SCAN_OPTIONS = ("policy", "action_policy", "ruleset", "pii", "scan_limits", "evaluate", "formatter")


def snapshot_action_policy(document: str | bytes | dict) -> str | bytes:
    """A policy document as it is now: text stays, bytes are copied, an object is serialised once."""
    if isinstance(document, str):
        return document
    if isinstance(document, (bytes, bytearray, memoryview)):
        return bytes(document)
    if not isinstance(document, dict):
        raise OptionsError("CORE_OPTION_REJECTED", ("action_policy",), "INVALID_ACTION_POLICY")
    try:
        return json.dumps(document)
    except (TypeError, ValueError) as e:
        raise OptionsError("CORE_OPTION_REJECTED", ("action_policy",), "INVALID_ACTION_POLICY") from e


def resolve_scan_config(options: dict | None = None) -> ScanConfig:
    """A checked ScanConfig from loose options; unknown ones are ignored, as they belong to hosts. Errors name options only."""
    o = dict(options or {})
    for name in ("policy", "evaluate", "formatter"):
        if o.get(name) is not None and not callable(o[name]):
            raise OptionsError("CORE_OPTION_REJECTED", (name,))
    if o.get("action_policy") is not None and (o.get("policy") is not None or o.get("evaluate") is not None):
        raise OptionsError("CORE_OPTION_REJECTED", ("policy", "action_policy"))
    if o.get("ruleset") is not None and not isinstance(o["ruleset"], (str, bytes)):
        raise OptionsError("CORE_OPTION_REJECTED", ("ruleset",), "INVALID_RULESET")
    limits = o.get("scan_limits")
    if limits is not None:
        known = isinstance(limits, dict) and set(limits) <= {"max_input_bytes", "max_findings"}
        if not known or not all(isinstance(v, int) and not isinstance(v, bool) and v > 0 for v in limits.values()):
            raise OptionsError("CORE_OPTION_REJECTED", ("scan_limits",), "INVALID_LIMITS")
    return ScanConfig(
        policy=o.get("policy"), evaluate=o.get("evaluate"), formatter=o.get("formatter"), pii=bool(o.get("pii")),
        rules=parse_policy(snapshot_action_policy(o["action_policy"])) if o.get("action_policy") is not None else (),
        ruleset=parse_ruleset(o["ruleset"]) if o.get("ruleset") is not None else (),
        max_input_bytes=(limits or {}).get("max_input_bytes"), max_findings=(limits or {}).get("max_findings"),
    )


def scan_config_of(options: dict) -> ScanConfig:
    """The config of a host's options: the checked one under scan_config, or one made of loose options; never both."""
    given = options.get("scan_config")
    if given is None:
        return resolve_scan_config(options)
    if not isinstance(given, ScanConfig):
        raise TypeError("scan_config must come from resolve_scan_config")
    if any(options.get(n) is not None for n in SCAN_OPTIONS):
        raise TypeError("scan_config can't be given beside options of a scan")
    return given


def bind_scan_config(options: dict) -> dict:
    """Options with their config checked once and bound: copies and merges of them carry it on."""
    return {k: v for k, v in options.items() if k not in SCAN_OPTIONS} | {"scan_config": scan_config_of(options)}


#: The lowest versions of the engine below that offer an option.
FLOORS = {"ruleset": "3.5.0", "formatter": "3.5.0", "action_policy": "3.5.0"}


def verify_scan_options(spark, config: ScanConfig, version: str | None = None) -> None:
    """Fails now where a plan would fail later: versions first, then one scan of an empty text."""
    from .functions.scanner import scan

    version = version or spark.version
    needed = [n for n, used in (("ruleset", config.ruleset), ("formatter", config.formatter), ("action_policy", config.rules)) if used]
    for name in needed:
        if not spark.range(1).select(version_at_least(F.lit(version), FLOORS[name])).first()[0]:
            raise OptionsError("CORE_OPTION_UNSUPPORTED", (name,))
    try:
        spark.range(1).select(scan(F.lit(""), config)).collect()
    except Exception as e:
        raise OptionsError("CORE_OPTION_REJECTED", tuple(needed) or ("policy",)) from e
