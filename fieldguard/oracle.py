"""SQL text of the scanner, for the oracles: the same rules by lists and lambdas of the SQL engine."""

from __future__ import annotations

from .config import ScanConfig
from .functions.scanner import CERTAIN, builtin_pack


def quote(s: str) -> str:
    return "'" + s.replace("'", "''") + "'"


def scan_ctes(source: str, config: ScanConfig = ScanConfig(), name: str = "s", placeholder: str = "'<SECRET_' || {n} || '>'") -> str:
    """CTEs that end in name: the columns of source with xs (matches), masked, n_findings, n_redacted, blocked."""
    pack = builtin_pack(config)
    pattern, before = quote(pack.pattern), quote(pack.before)
    kinds, confs = [], []
    for t, _, p, c in pack.kinds:
        test = f"WHEN regexp_matches(x.v, {quote(p)})" if p else "ELSE"
        conf = f"'{c}'" if c else f"CASE WHEN length(x.p) > 0 THEN 'high' ELSE 'medium' END" if t == "pii_global_email" else f"CASE WHEN length(x.v) >= {CERTAIN} THEN 'high' ELSE 'medium' END"
        kinds.append(f"{test} THEN '{t}'" if p else f"ELSE '{t}'")
        confs.append(f"{test} THEN {conf}" if p else f"ELSE {conf}")
    kind, conf = f"CASE {' '.join(kinds)} END", f"CASE {' '.join(confs)} END"
    action = config.action_sql("x.k", "x.c")
    shown = placeholder.format(n="len(list_filter(xs[1:i], lambda o: o.a = 'redact'))", kind="xs[i].k")
    return f"""
{name}1 AS (SELECT *, regexp_extract_all(text, {pattern}) AS ms, string_split_regex(text, {pattern}) AS ps FROM {source}),
{name}2 AS (SELECT *, list_transform(ms, lambda m: {{'p': CASE WHEN length(regexp_extract(m, {before})) < length(m) THEN regexp_extract(m, {before}) ELSE '' END, 'm': m}}) AS y FROM {name}1),
{name}3 AS (SELECT * EXCLUDE y, list_transform(y, lambda x: {{'p': x.p, 'v': substr(x.m, length(x.p) + 1)}}) AS y FROM {name}2),
{name}4 AS (SELECT * EXCLUDE y, list_transform(y, lambda x: {{'p': x.p, 'v': x.v, 'k': {kind}, 'c': {conf}}}) AS y FROM {name}3),
{name}5 AS (SELECT * EXCLUDE y, list_transform(y, lambda x: {{'p': x.p, 'v': x.v, 'k': x.k, 'c': x.c, 'g': starts_with(x.v, 'op://'), 'a': CASE WHEN starts_with(x.v, 'op://') THEN 'allow' ELSE {action} END}}) AS xs FROM {name}4),
{name} AS (SELECT *, CASE WHEN text IS NULL THEN NULL WHEN len(xs) = 0 THEN text ELSE array_to_string(list_transform(range(1, len(xs) + 1), lambda i: ps[i] || xs[i].p || CASE WHEN xs[i].a = 'redact' THEN {shown} ELSE xs[i].v END), '') || ps[len(xs) + 1] END AS masked,
  coalesce(len(list_filter(xs, lambda o: NOT o.g)), 0) AS n_findings, coalesce(len(list_filter(xs, lambda o: o.a = 'redact')), 0) AS n_redacted, coalesce(len(list_filter(xs, lambda o: o.a = 'block')), 0) > 0 AS blocked FROM {name}5)"""


def leaf_columns() -> str:
    """masked_text, outcome and findings of a scanned source named s."""
    return """CASE WHEN text IS NULL THEN NULL WHEN blocked THEN '[REDACTED:BLOCKED]' ELSE masked END AS masked_text,
  CASE WHEN text IS NULL THEN NULL WHEN blocked THEN 'blocked' WHEN masked <> text THEN 'redacted' ELSE 'unchanged' END AS outcome,
  CASE WHEN text IS NULL THEN NULL ELSE n_findings END AS findings"""
