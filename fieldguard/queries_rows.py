"""Registered queries of the compiled walk and its hosts: budgets, outcomes, log calls, lines, workloads."""

from __future__ import annotations

from pyspark.sql import Column, DataFrame
from pyspark.sql import functions as F

from . import workloads
from .config import ScanConfig, version_at_least
from .constants import COUNTS
from .functions.leaf import mask_leaf_outcome
from .operators.budget import add_counts, scan_once
from .operators.json_walk import mask_json
from .operators.lines import is_replacement_line, redact_lines, redact_lines_after, value_spans
from .operators.walk import Target, Walk, mask_columns, mask_keyed_leaves, mask_row
from .oracle import scan_ctes
from .plans import hosts, readback
from .queries import DOCS, _CONV, choice, conversations, query, rules, spans, table, token, token_sql

ZERO = "0::BIGINT"


def fields(struct: str, *names: str) -> list[Column]:
    return [F.col(f"{struct}.{n}").alias(n) for n in names]


# --- budgets of a row --------------------------------------------------------------------------------------

_LIMIT = "'[REDACTED:LIMIT_EXCEEDED]'"


def lists(spark, d) -> DataFrame:
    """Parts with an array of up to five texts, each with a token."""
    k = F.col("p_partkey")
    items = F.transform(F.sequence(F.lit(0), (k % 5).cast("int")), lambda i: F.concat(F.lit("t "), token(k)))
    return table(spark, d, "part").select("p_partkey", items.alias("items"), F.lit("end").alias("tail"))


def budget_sql(allowed: str, tail: str) -> str:
    """allowed: how many of the items are; tail: whether what follows them is."""
    return f"""WITH p AS (SELECT p_partkey, (p_partkey % 5 + 1)::BIGINT AS n FROM part), a AS (SELECT *, {allowed} AS a FROM p)
SELECT p_partkey, array_to_string(list_transform(range(n), lambda i: CASE WHEN i < a THEN 't <SECRET_1>' ELSE {_LIMIT} END), '|') AS items, CASE WHEN {tail} THEN 'end' ELSE {_LIMIT} END AS tail,
 (least(n, a) + CASE WHEN {tail} THEN 1 ELSE 0 END)::BIGINT AS scanned, (greatest(n - a, 0) + CASE WHEN {tail} THEN 0 ELSE 1 END)::BIGINT AS limited FROM a"""


def budget_query(limits: dict | None = None, operation: dict | None = None):
    def run(spark, d):
        m = mask_row(lists(spark, d), Target("items"), Target("tail"), walk=Walk(limits=limits, operation=operation), outcome="o")
        return m.select("p_partkey", F.array_join("items", "|").alias("items"), "tail", *fields("o.counts", "scanned", "limited"))

    return run


#: Of each row: one node for the list, one for each item, one for the tail; a leaf a text; one scan a leaf, as no key is near.
BUDGETS = {
    "walk_max_total_leaves": (budget_query({"max_total_leaves": 3}), budget_sql("least(n, 3)", "n < 3")),
    "walk_max_nodes": (budget_query({"max_nodes": 4}), budget_sql("least(n, 3)", "n < 3")),
    "budget_operation_max_nodes": (budget_query(operation={"max_nodes": 4}), budget_sql("least(n, 3)", "n < 3")),
    "budget_operation_max_leaves": (budget_query(operation={"max_leaves": 2}), budget_sql("least(n, 2)", "n < 2")),
    "budget_operation_max_scans": (budget_query(operation={"max_scans": 2}), budget_sql("least(n, 2)", "n < 2")),
    "budget_operation_max_bytes": (budget_query(operation={"max_bytes": 100}), budget_sql("least(n, 2)", "n <= 2")),
    "budget_operation_max_findings": (budget_query(operation={"max_findings": 3}), budget_sql("least(n, 3)", "n <= 3")),
}
for _name, (_run, _sql) in BUDGETS.items():
    _run.__name__ = _name
    query(_sql)(_run)


@query(f"""SELECT p_partkey, CASE WHEN p_partkey % 2 = 0 THEN 'a' ELSE {_LIMIT} END AS a, {_LIMIT} AS b, 1::BIGINT + p_partkey % 2 AS keys, 1::BIGINT + p_partkey % 2 AS limited FROM part""")
def budget_operation_max_keys(spark, d):
    """Struct fields are charged as keys: the second, or already the first, is over the budget."""
    k = F.col("p_partkey")
    df = table(spark, d, "part").select("p_partkey", F.struct(F.lit("a").alias("a"), F.lit("b").alias("b")).alias("v"), (k % 2).alias("odd"))
    even = mask_row(df, Target("v"), walk=Walk(operation={"max_keys": 1}), outcome="o")
    none = mask_row(df, Target("v"), walk=Walk(operation={"max_keys": 0}), outcome="o")
    pick = lambda m, used: m.select("p_partkey", "v.a", "v.b", F.lit(used).cast("long").alias("keys"), "o.counts.limited")
    return pick(even.where("odd = 0"), 1).unionByName(pick(none.where("odd = 1"), 2))


@query(f"""WITH {scan_ctes(_CONV)} SELECT conv_id, turn, 4::BIGINT AS nodes, 3::BIGINT AS keys, 2::BIGINT AS leaves, (CASE WHEN n_redacted > 0 THEN 1 ELSE 2 END + 2)::BIGINT AS scans,
 (strlen(text) * CASE WHEN n_redacted > 0 THEN 1 ELSE 2 END + CASE WHEN n_redacted > 0 THEN 0 ELSE 11 END + strlen(role) * 2 + 11)::BIGINT AS bytes, n_findings::BIGINT AS findings FROM s WHERE NOT blocked AND n_findings = n_redacted""")
def budget_operation_usage(spark, d):
    """What masking a struct of three fields spends: both scans of a leaf under its key are charged."""
    c = conversations(spark, d).select("conv_id", "turn", F.struct("text", "role", F.lit(1).alias("n")).alias("v"))
    m = mask_columns(c, "v", keyed=False, outcome="o")
    return m.where("o.counts.blocked = 0 and o.counts.findings = o.usage.findings").select("conv_id", "turn", *fields("o.usage", "nodes", "keys", "leaves", "scans", "bytes", "findings"))


@query("SELECT s_suppkey, 'ok' AS plain, '[REDACTED:BLOCKED]' AS under_token, 1::BIGINT AS blocked, 0::BIGINT AS findings FROM supplier")
def view_finding_outside_leaf(spark, d):
    """A leaf under a key that is a token itself: the finding lies outside of the leaf, which is blocked with no findings."""
    k = F.col("s_suppkey")
    df = table(spark, d, "supplier").select(k, F.create_map(F.lit("note"), F.lit("ok"), token(k), F.lit("value")).alias("m"), token(k).alias("t"))
    m = mask_row(df, Target("m", None, -1), outcome="o")
    return m.select(k, F.col("m")["note"].alias("plain"), F.element_at("m", F.col("t")).alias("under_token"), *fields("o.counts", "blocked", "findings"))


@query("SELECT c_custkey, '[REDACTED:ERROR]' AS masked, 1::BIGINT AS failed FROM customer")
def policy_without_action(spark, d):
    """A column policy whose result is no action fails the leaf; nothing passes."""
    config = ScanConfig(policy=lambda kind, confidence: F.lit("drop"))
    df = table(spark, d, "customer").select("c_custkey", F.concat(F.lit("key "), token(F.col("c_custkey"))).alias("masked"))
    return mask_row(df, Target("masked"), walk=Walk(config), outcome="o").select("c_custkey", "masked", "o.counts.failed")


@query("SELECT c_custkey, CASE WHEN c_custkey % 2 = 0 THEN 'x' ELSE '[REDACTED:ERROR]' END AS masked FROM customer")
def scan_limit_of_the_view(spark, d):
    """The whole-input limit holds for the view of a leaf under its key as well as for the leaf."""
    k = F.col("c_custkey")
    df = table(spark, d, "customer").select(k, F.struct(F.when(k % 2 == 0, "x").otherwise(F.repeat(F.lit("x"), 30)).alias("note")).alias("v"))
    return mask_columns(df, "v", walk=Walk(ScanConfig(max_input_bytes=35))).select(k, F.col("v.note").alias("masked"))


@query("""SELECT p_partkey, least(3, p_partkey % 6)::BIGINT AS n, CASE WHEN p_partkey % 6 > 3 THEN 1 ELSE 0 END::BIGINT AS limited, least(3, p_partkey % 6)::BIGINT AS scanned FROM part""")
def dropped_elements_count_as_limited(spark, d):
    df = table(spark, d, "part").select("p_partkey", F.array_repeat(F.lit("x"), (F.col("p_partkey") % 6).cast("int")).alias("body"))
    m = hosts.redact_otel_logs(df, Walk(limits={"max_array_length": 3}, key_context=False, operation=False, count_dropped=True), "o")
    return m.select("p_partkey", F.size("body").cast("long").alias("n"), *fields("o.values", "limited", "scanned"))


@query("SELECT event_id, CASE WHEN event_id % 2 = 0 THEN '<SECRET_1>' ELSE 'short' END AS a, md5(event_id::VARCHAR) AS b FROM events")
def keyed_leaves(spark, d):
    """A flat list of leaves beside a list of their keys."""
    i = F.col("event_id")
    h = F.md5(i.cast("string"))
    out = mask_keyed_leaves(F.array(F.when(i % 2 == 0, h).otherwise("short"), h), F.array(F.lit("password"), F.lit(None).cast("string")))
    return table(spark, d, "events").select(i, out.alias("o")).select(i, F.get("o", F.lit(0)).alias("a"), F.get("o", F.lit(1)).alias("b"))


@query("SELECT event_id, '{\"a\":[\"x\",{\"password\":\"' || CASE WHEN event_id % 2 = 0 THEN '<SECRET_1>' ELSE 'short' END || '\"}],\"n\":1.5,\"none\":null}' AS value, 2::BIGINT AS scanned, (1 - event_id % 2)::BIGINT AS redacted, 7::BIGINT AS nodes, 4::BIGINT AS keys FROM events")
def mask_json_events(spark, d):
    """JSON of any shape, permissively, with the counts and the usage of each row's operation."""
    i = F.col("event_id")
    v = F.concat(F.lit('{"a":["x",{"password":"'), F.when(i % 2 == 0, F.md5(i.cast("string"))).otherwise("short"), F.lit('"}],"n":1.5,"none":null}'))
    return mask_json(table(spark, d, "events").select(i, v.alias("value")), "value", outcome="o").select(i, "value", *fields("o.counts", "scanned", "redacted"), *fields("o.usage", "nodes", "keys"))


# --- outcomes of hosts -------------------------------------------------------------------------------------


@query("""SELECT event_id AS span_id, 9::BIGINT AS scanned, (5 + CASE WHEN event_id % 8 = 0 THEN 1 ELSE 0 END)::BIGINT AS findings, (5 + CASE WHEN event_id % 8 = 0 THEN 1 ELSE 0 END)::BIGINT AS redacted,
0::BIGINT AS blocked, 0::BIGINT AS limited, 0::BIGINT AS failed, false AS dropped FROM events""")
def span_records(spark, d):
    """One outcome for each span, over its name, attributes, arrays, status, events and links."""
    return hosts.redact_spans(spans(spark, d), outcome="o").select("span_id", *fields("o.values", *COUNTS), "o.dropped")


@query("SELECT event_id, '<SECRET_1>' AS api_key, 'x' AS note, 'plain|<SECRET_1>' AS listed FROM events")
def attribute_bags(spark, d):
    i = F.col("event_id")
    df = table(spark, d, "events").select(i, F.create_map(F.lit("api_key"), F.md5(i.cast("string")), F.lit("note"), F.lit("x")).alias("bag"), F.create_map(F.lit("password"), F.array(F.lit("plain"), token(i))).alias("lists"), F.lit(None).cast("map<string,string>").alias("nothing"))
    m = hosts.redact_attributes(df, "bag", "lists", "nothing").where("nothing is null")
    return m.select(i, F.col("bag")["api_key"].alias("api_key"), F.col("bag")["note"].alias("note"), F.array_join(F.col("lists")["password"], "|").alias("listed"))


@query("""SELECT event_id % 3 AS level, count(*) * 3 AS scanned, count(*) * 3 AS redacted, 0::BIGINT AS failed FROM events GROUP BY ALL""")
def log_record_outcomes(spark, d):
    i = F.col("event_id")
    df = table(spark, d, "events").select("event_id", (i % 3).cast("int").alias("levelno"), F.lit("login with %s").alias("msg"), F.array(token(i)).alias("args"), F.concat(F.lit("Traceback "), token(i)).alias("exc_text"), F.create_map(F.lit("password"), F.md5(i.cast("string")), F.lit("other"), token(i)).alias("extra"))
    r = hosts.redact_log_records(df, ["password"], outcome="o")
    return r.groupBy(F.col("o.level").cast("long").alias("level")).agg(*[F.sum(f"o.values.{k}").alias(k) for k in ("scanned", "redacted", "failed")])


@query("SELECT event_id, [hex('body <SECRET_1>'), hex('[REDACTED:ERROR]'), hex('plain')][event_id % 3 + 1] AS body, (CASE WHEN event_id % 3 = 1 THEN 1 ELSE 0 END)::BIGINT AS failed, (CASE WHEN event_id % 3 = 0 THEN 1 ELSE 0 END)::BIGINT AS redacted, (CASE WHEN event_id % 3 = 1 THEN 1 ELSE 2 END)::BIGINT AS scanned, event_type AS severity_text FROM events")
def otel_record_outcomes(spark, d):
    i = F.col("event_id")
    data = F.when(i % 3 == 0, F.concat(F.lit("body "), token(i)).cast("binary")).when(i % 3 == 1, F.unhex(F.lit("FF00FE"))).otherwise(F.lit("plain").cast("binary"))
    df = table(spark, d, "events").select(i, data.alias("body_bytes"), F.col("event_type").alias("severity_text"))
    m = hosts.redact_otel_logs(df, outcome="o")
    return m.select(i, F.hex("body_bytes").alias("body"), *fields("o.values", "failed", "redacted", "scanned"), "severity_text")


@query("""SELECT event_id, event_id % 5 IN (1, 2) AS strict, event_id % 5 = 1 AS lenient FROM events""")
def spans_read_back(spark, d):
    """What a host wrote against what was released: changed values drop the unit, cut ones only where cutting isn't allowed."""
    i = F.col("event_id")
    df = table(spark, d, "events").select(i, F.concat(F.lit("see "), token(i)).alias("name"), F.create_map(F.lit("k"), F.col("event_type"), F.lit("t"), token(i)).alias("attributes"))
    released = hosts.redact_spans(df)
    name = F.when(i % 5 == 1, F.concat(F.lit("see "), token(i))).when(i % 5 == 2, F.substr("name", F.lit(1), F.lit(6))).otherwise(F.col("name"))
    written = released.withColumn("name", name)
    both = [readback.checked(released, written, "event_id", "name", "attributes", truncated=cut).select(F.col("event_id").alias(f"id_{n}"), F.col("dropped").alias(n)) for n, cut in (("strict", False), ("lenient", True))]
    return both[0].join(both[1], F.col("id_strict") == F.col("id_lenient")).select(F.col("id_strict").alias("event_id"), "strict", "lenient")


# --- log calls and lines -----------------------------------------------------------------------------------


def calls(spark, d) -> DataFrame:
    i = F.col("event_id")
    obj = F.struct(F.when(i % 4 == 0, token(i)).otherwise("short").alias("api_key"), F.col("event_type").alias("type"), F.struct(F.concat(F.lit("at "), token(i)).alias("note")).alias("inner"))
    return table(spark, d, "events").select(i, (F.lit(10) * (i % 3 + 1)).cast("int").alias("level"), obj.alias("obj"), F.lit("user %s did %d").alias("fmt"), F.array(F.when(i % 2 == 0, token(i)).otherwise("x"), F.col("user_id").cast("string")).alias("args"), F.when(i % 5 == 0, "[w] ").otherwise("").alias("msg_prefix"))


_KEY = "CASE WHEN event_id % 4 = 0 THEN '<SECRET_1>' ELSE 'short' END"
_WHO = "CASE WHEN event_id % 2 = 0 THEN '<SECRET_1>' ELSE 'x' END"


@query(f"""SELECT event_id, '{{"level":' || 10 * (event_id % 3 + 1) || ',"api_key":"' || {_KEY} || '","type":"' || event_type || '","inner":{{"note":"at <SECRET_1>"}},"msg":"' || CASE WHEN event_id % 5 = 0 THEN '[w] ' ELSE '' END || 'user ' || {_WHO} || ' did ' || user_id || '"}}' || chr(10) AS line,
 'user ' || {_WHO} || ' did ' || user_id AS msg, 8::BIGINT AS scanned, (1 + CASE WHEN event_id % 4 = 0 THEN 1 ELSE 0 END + CASE WHEN event_id % 2 = 0 THEN 1 ELSE 0 END)::BIGINT AS redacted, false AS replaced FROM events""")
def log_calls(spark, d):
    """Both passes of a call: the arguments as one tree, then the line; one outcome over both."""
    c = hosts.redact_log_calls(calls(spark, d))
    return c.select("event_id", "line", "msg", *fields("outcome.values", "scanned", "redacted"), F.col("outcome.lineReplaced").alias("replaced"))


@query("SELECT (10 * (event_id % 3 + 1))::BIGINT AS level, count(*) AS calls, count(*) * 8 AS scanned, 'log-method,stream-write' AS stages FROM events GROUP BY ALL")
def log_call_outcomes(spark, d):
    c = hosts.redact_log_calls(calls(spark, d))
    return c.groupBy(F.col("outcome.level").cast("long").alias("level"), F.array_join("outcome.stages", ",").alias("stages")).agg(F.count("*").alias("calls"), F.sum("outcome.values.scanned").alias("scanned"))


@query(f"SELECT event_id, '{{\"msg\":\"[REDACTED:LIMIT_EXCEEDED]\"}}' || chr(10) AS line, true AS replaced FROM events")
def log_call_shared_budget(spark, d):
    """The second pass goes on with what the first has left of the budget, here nothing."""
    c = hosts.redact_log_calls(calls(spark, d), walk=Walk(operation={"max_leaves": 4, "max_nodes": 6}))
    return c.select("event_id", "line", F.col("outcome.lineReplaced").alias("replaced"))


_HOSTILE = [
    "{'password':'TOKEN'}", '{"a":"x","b":\'TOKEN\'}', '{"a":"TOKEN"} trailing', '{"a":"TOKEN"', '["TOKEN"]', '{"a":NaN,"b":"TOKEN"}', '{"a":"one\\ntwo API_KEY=TOKEN"}', '{"a":"tab\there TOKEN"}', ' { "password" : "abcdefghijklmnopqrst" } ',
    '{"a":"q\\"uote TOKEN"}', '{"a":[1,-2.5e3,true,null,"TOKEN"],"a":{"b":"\\u00e9 TOKEN"}}', '{"a":01,"b":"TOKEN"}', '{"a":"TOKEN",}', '"TOKEN"', "", "12", '{"\\u0070assword":"abcdefghijklmnopqrst"}', '{"a":"\\ud83d\\ude00 plain"}', "{\"a\":\"TOKEN\"}﻿",
]
_ERROR = '{"msg":"[REDACTED:ERROR]"}'
_REDACTED = [
    _ERROR, _ERROR, _ERROR, _ERROR, '["<SECRET_1>"]', _ERROR, '{"a":"one\\ntwo API_KEY=<SECRET_1>"}', _ERROR, ' { "password" : "<SECRET_1>" } ',
    '{"a":"q\\"uote <SECRET_1>"}', '{"a":[1,-2.5e3,true,null,"<SECRET_1>"],"a":{"b":"é <SECRET_1>"}}', _ERROR, _ERROR, '"<SECRET_1>"', _ERROR, "12", '{"\\u0070assword":"<SECRET_1>"}', '{"a":"\\ud83d\\ude00 plain"}', _ERROR,
]


def _choice(items: list[str]) -> str:
    return "[" + ", ".join("'" + x.replace("'", "''") + "'" for x in items) + "]"


@query(f"SELECT event_id, {_choice(_REDACTED)}[event_id % {len(_REDACTED)} + 1] AS line FROM events")
def json_lines_hostile(spark, d):
    """Lines that aren't strict JSON never pass; what changes is escaped again, what doesn't keeps its bytes."""
    i = F.col("event_id")
    line = F.replace(F.element_at(F.array(*[F.lit(x) for x in _HOSTILE]), (i % len(_HOSTILE) + 1).cast("int")), F.lit("TOKEN"), token(i))
    return redact_lines(table(spark, d, "events").select(i, line.alias("line")))


@query("SELECT s_suppkey, (1000009 + s_suppkey)::BIGINT AS n, '{\"a\":\"' AS head, ' <SECRET_1>\"}' AS tail FROM supplier")
def json_lines_long_literals(spark, d):
    """A literal of a million characters, with a token at its end and escapes all along."""
    k = F.col("s_suppkey")
    line = F.concat(F.lit('{"a":"'), F.repeat(F.lit("\\n"), 500_000 - 5), F.repeat(F.lit("y"), k.cast("int")), F.lit(" "), token(k), F.lit('"}'))
    out = redact_lines(table(spark, d, "supplier").select(k, line.alias("o")), "o", walk={"max_string_length": 1 << 21})
    return out.select(k, F.length("o").cast("long").alias("n"), F.substr("o", F.lit(1), F.lit(6)).alias("head"), F.substr("o", F.length("o") - 12, F.lit(13)).alias("tail"))


@query("SELECT event_id, 6::BIGINT AS n_values, 'level' AS first_key, 'msg|api_key|||' AS keys FROM events")
def line_value_spans(spark, d):
    """The literals of a line that are values, with the key each stands directly under."""
    i = F.col("event_id")
    line = F.concat(F.lit('{"level":"'), i.cast("string"), F.lit('","msg" : "a \\"b\\": c","api_key":"x","tags":["a","b"],"n":{"k":["c"]}}'))
    v = F.filter(value_spans(line), lambda s: s["value"])
    return table(spark, d, "events").select(i, v.alias("v")).select(i, F.size("v").cast("long").alias("n_values"), F.get("v", F.lit(0))["key"].alias("first_key"), F.array_join(F.transform(F.slice("v", 2, 5), lambda s: F.coalesce(s["key"], F.lit(""))), "|").alias("keys"))


@query("SELECT event_id, event_id % 3 <> 2 AS replaced FROM events")
def replacement_lines(spark, d):
    i = F.col("event_id")
    line = F.when(i % 3 == 0, "no json\n").when(i % 3 == 1, '{"a":"' + "x" * 90 + '"}').otherwise('{"msg":"[REDACTED:ERROR] not"}')
    return redact_lines(table(spark, d, "events").select(i, line.alias("line")), limits={"max_line": 80}).select(i, is_replacement_line(F.col("line")).alias("replaced"))


@query("SELECT event_id, 'a 7.25 b 7 c ''text'' d {\"k\":1} e 100% f NaN g ' || event_id || ' h %d %' AS message, 'plain %s %d' AS bare FROM events")
def printf_dialect(spark, d):
    i = F.col("event_id")
    args = F.array(F.lit("7.25"), F.lit("7.9"), F.lit("text"), F.lit('{"k":1}'), F.lit("many"), i.cast("string"))
    kinds = F.array(*[F.lit(k) for k in ("number", "number", "string", "json", "string", "number")])
    shown = hosts.format_message(F.lit("a %f b %i c %o d %j e 100%% f %d g %s h %d %"), args, kinds)
    return table(spark, d, "events").select(i, shown.alias("message"), hosts.format_message(F.lit("plain %s %d"), F.array().cast("array<string>")).alias("bare"))


@query("SELECT event_id, CASE WHEN event_id % 3 = 2 THEN 0 ELSE 1 END::BIGINT AS place FROM events")
def message_places(spark, d):
    i = F.col("event_id")
    is_object = F.when(i % 3 == 0, True).when(i % 3 == 2, False)
    return table(spark, d, "events").select(i, hosts.message_index(is_object).cast("long").alias("place"))


@query(f"WITH {scan_ctes(DOCS)} SELECT source, (count(*) * 2)::BIGINT AS scanned, (sum(n_findings) * 2)::BIGINT AS findings, (count(*) FILTER (WHERE masked <> text AND NOT blocked) * 2)::BIGINT AS redacted FROM s GROUP BY source")
def counts_of_two_passes(spark, d):
    m = mask_row(table(spark, d, DOCS).select("source", "text"), Target("text"), outcome="o").select("source", add_counts(F.col("o.counts"), F.col("o.counts")).alias("c"))
    return m.groupBy("source").agg(*[F.sum(f"c.{k}").alias(k) for k in ("scanned", "findings", "redacted")])


_PYTHON_VERSIONS = [("1.2.3", True), ("1.2.3rc1", False), ("1.2.3b2", False), ("1.2.4a1", True), ("1.2.3.post1", False), ("1.2.3.dev4", False), ("1.3", False), ("1.3.0b1", True), ("1.2.3+build.5", True), ("1.2.3-rc.1.x", False), ("1.2.3-99", False), ("2.0.0-alpha", True), ("v1.2.3", False), ("1.2", False)]


@query(f"SELECT c_custkey, {choice([v for v, _ in _PYTHON_VERSIONS], 'c_custkey', True)} AS v, {choice([ok for _, ok in _PYTHON_VERSIONS], 'c_custkey', True)} AS ok FROM customer")
def version_dialects(spark, d):
    return table(spark, d, "customer").select("c_custkey", choice([v for v, _ in _PYTHON_VERSIONS], "c_custkey").alias("v")).withColumn("ok", version_at_least(F.col("v"), "1.2.3"))


@query(f"WITH {scan_ctes('(SELECT doc_id, text || chr(32) || ' + token_sql('doc_id') + ' AS text FROM documents)', rules(('github_token', 'warn')))} SELECT doc_id, masked AS masked_text, n_findings AS findings FROM s")
def overlay_token_warn(spark, d):
    df = table(spark, d, DOCS).select("doc_id", F.concat("text", F.lit(" "), token(F.col("doc_id"))).alias("masked_text"))
    return mask_row(df, Target("masked_text"), walk=Walk(rules(("github_token", "warn"))), outcome="o").select("doc_id", "masked_text", "o.counts.findings")


@query("SELECT event_id, CASE event_id % 3 WHEN 0 THEN '{\"host\":\"<SECRET_1>\"}' WHEN 1 THEN '{\"a\":\"<SECRET_1>\"}' ELSE '{\"msg\":\"[REDACTED:ERROR]\"}' END AS line FROM events")
def lines_after_host_hooks(spark, d):
    """A host's own hook: one that rewrites the line, one that raises, one that gives nothing, one that breaks the line."""
    i = F.col("event_id")

    def rewrites(line: Column) -> Column:
        return F.replace(line, F.lit('"a"'), F.lit('"host"'))

    def raises(line: Column) -> Column:
        raise RuntimeError("no hook")

    lines = table(spark, d, "events").select(i, F.concat(F.lit('{"a":"'), token(i), F.lit('"}')).alias("line"))
    hosts_ = (rewrites, raises, lambda line: F.concat(line, F.lit("2")))
    parts = [redact_lines_after(lines.where(i % 3 == k), host) for k, host in enumerate(hosts_)]
    return parts[0].unionByName(parts[1]).unionByName(parts[2])


@query(f"WITH {scan_ctes(_CONV)} SELECT conv_id, turn, masked AS masked_text, n_findings::BIGINT AS findings FROM s WHERE NOT blocked")
def memo_masked_texts(spark, d):
    """Repeated short texts are scanned once and joined back."""
    c = scan_once(conversations(spark, d).select("conv_id", "turn", "text"), "text", mask_leaf_outcome)
    return c.where("m.outcome <> 'blocked'").select("conv_id", "turn", F.col("m.text").alias("masked_text"), F.col("m.findings").cast("long").alias("findings"))


@query("SELECT event_id, 'login with <SECRET_1>' AS msg, '<SECRET_1>' AS password, 0::BIGINT AS redacted FROM events")
def log_records_filtered_twice(spark, d):
    """Two filters over one record: the second finds nothing to do."""
    i = F.col("event_id")
    df = table(spark, d, "events").select("event_id", F.lit("login with %s").alias("msg"), F.array(token(i)).alias("args"), F.create_map(F.lit("password"), F.md5(i.cast("string"))).alias("extra"))
    once = hosts.redact_log_records(df, ["password"])
    twice = hosts.redact_log_records(once, ["password"], outcome="o")
    return twice.select("event_id", "msg", F.col("extra")["password"].alias("password"), F.col("o.values.redacted").alias("redacted"))


# --- workloads ---------------------------------------------------------------------------------------------


def units(spark, d, name: str) -> DataFrame:
    """The keys of a table as the units of a workload."""
    t = table(spark, d, name)
    return t.select(F.col(t.columns[0]).cast("long").alias("id"))


def profile_query(name: str, source: str):
    """Units, tokens found and leaves scanned of a profile, masked: one unit for each row of a table."""
    def run(spark, d):
        w = workloads.build(units(spark, d, source), name)
        if workloads.PROFILES[name].shape == "span":
            m = hosts.redact_spans(w, outcome="o").select("o.values")
        elif workloads.PROFILES[name].shape == "payload":
            m = mask_columns(w, "messages", "tool_calls", keyed=False, outcome="o").select(F.col("o.counts").alias("values"))
        else:
            m = mask_columns(w, "obj", "args", keyed=False, outcome="o").select(F.col("o.counts").alias("values"))
        return m.agg(F.count("*").alias("units"), F.sum("values.redacted").alias("redacted"), F.sum("values.scanned").alias("scanned"), F.sum("values.limited").alias("limited"))

    return run


#: (table, its key, leaves of each unit, refusals of each): a token in every eighth unit.
EXPECTED = {
    "log-flat": ("customer", "c_custkey", 10, 0), "log-nested": ("customer", "c_custkey", 27, 0), "span-attributes": ("customer", "c_custkey", 44, 0), "mask-payload": ("customer", "c_custkey", 20, 0),
    "log-scale-4x": ("supplier", "s_suppkey", 34, 0), "log-scale-16x": ("supplier", "s_suppkey", 130, 0), "limit-depth": ("supplier", "s_suppkey", 10, 1), "limit-keys": ("supplier", "s_suppkey", 202, 0),
    "limit-array": ("supplier", "s_suppkey", 1010, 0), "limit-string-over": ("supplier", "s_suppkey", 10, 1),
}
for _name, (_table, _key, _leaves, _over) in EXPECTED.items():
    _run = profile_query(_name, _table)
    _run.__name__ = "workload_" + _name.replace("-", "_")
    query(f"SELECT count(*) AS units, count(*) FILTER (WHERE {_key} % 8 = 0) AS redacted, count(*) * {_leaves} AS scanned, (count(*) * {_over})::BIGINT AS limited FROM {_table}")(_run)


@query("SELECT count(*) AS units, count(*) AS digests, true AS same FROM customer")
def workload_digests(spark, d):
    """The same units in two runs, whatever the partitions."""
    w = workloads.build(units(spark, d, "customer"), "log-nested")
    one, two = (x.select("record_id", workloads.digest(w).alias(n)) for x, n in ((w, "a"), (w.repartition(7), "b")))
    return one.join(two, "record_id").agg(F.count("*").alias("units"), F.count_distinct("a").alias("digests"), F.min(F.col("a") == F.col("b")).alias("same"))
