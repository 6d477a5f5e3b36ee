"""The registered queries of the sanitising engine and their SQL oracles.

Tables without secrets get synthetic tokens by expression: a prefix and 36 characters made of a hash of the row.
"""

from __future__ import annotations

from collections.abc import Callable

from pyspark.sql import Column, DataFrame, SparkSession
from pyspark.sql import functions as F

from .activation import active_selectors, reflects
from .config import ScanConfig, parse_policy, parse_ruleset, version_at_least
from .constants import COUNTS
from .functions.leaf import mask_leaf, mask_leaf_outcome
from .functions.scanner import fixture_scan, scan
from .operators.budget import charge, count_outcomes, first_of_text, usage
from .operators.lines import redact_lines
from .operators.strict import Strict, sanitize_column
from .operators.walk import Walk, mask_bytes, mask_columns
from .oracle import leaf_columns, quote, scan_ctes
from .plans import context, hosts, strict
from .sources.lines import spread

QUERIES: dict[str, Callable[[SparkSession, str], DataFrame]] = {}
ORACLES: dict[str, str] = {}


def query(sql: str | None = None):
    def register(f):
        QUERIES[f.__name__] = f
        if sql:
            ORACLES[f.__name__] = sql
        return f

    return register


def table(spark: SparkSession, d: str, name: str) -> DataFrame:
    return spread(spark.read.parquet(f"{d}/{name}.parquet"))


def token(key: Column) -> Column:
    """A synthetic token: the prefix, a hash of 32 hexadecimal digits, and 0000."""
    return F.concat(F.lit("gh"), F.lit("p_"), F.md5(key.cast("string")), F.lit("0000"))


def token_sql(key: str) -> str:
    return f"'gh' || 'p_' || md5({key}::VARCHAR) || '0000'"


def leaf_fields(leaf: str = "m") -> list[Column]:
    return [F.col(f"{leaf}.text").alias("masked_text"), F.col(f"{leaf}.outcome").alias("outcome"), F.col(f"{leaf}.findings").cast("long").alias("findings")]


def entry(spark: SparkSession, d: str) -> DataFrame:
    """Masked documents with the counts of their source."""
    docs = table(spark, d, "documents").withColumn("m", mask_leaf_outcome(F.col("text")))
    return docs.select("doc_id", "source", *leaf_fields()).join(count_outcomes(docs, "m", "source").drop("findings"), "source")


# --- the scanner and leaves -------------------------------------------------------------------------------

DOCS = "documents"
_COUNT_SQL = ", ".join(
    [f"count(*) FILTER (WHERE outcome IS NOT NULL AND outcome <> 'limited') AS {COUNTS[0]}", f"coalesce(sum(findings), 0)::BIGINT AS {COUNTS[1]}"]
    + [f"count(*) FILTER (WHERE outcome = '{k}') AS {k}" for k in COUNTS[2:]]
)


def masked_docs(spark: SparkSession, d: str, config: ScanConfig = ScanConfig()) -> DataFrame:
    return table(spark, d, DOCS).withColumn("m", mask_leaf_outcome(F.col("text"), None, config))


def masked_sql(config: ScanConfig = ScanConfig(), columns: str = "doc_id", source: str = DOCS) -> str:
    return f"WITH {scan_ctes(source, config)} SELECT {columns}, {leaf_columns()} FROM s"


@query(masked_sql())
def mask_documents(spark, d):
    return masked_docs(spark, d).select("doc_id", *leaf_fields())


@query(masked_sql(columns="page_id", source="(SELECT page_id, html AS text FROM pages)"))
def mask_pages(spark, d):
    return table(spark, d, "pages").select("page_id", mask_leaf_outcome(F.col("html")).alias("m")).select("page_id", *leaf_fields())


_CONV = f"(SELECT conv_id, turn, role, CASE WHEN (conv_id + turn) % 5 = 0 THEN text || ' API_KEY=' || {token_sql('conv_id')} || ' end' ELSE text END AS text FROM conversations)"


def conversations(spark, d) -> DataFrame:
    c = table(spark, d, "conversations")
    return c.withColumn("text", F.when((F.col("conv_id") + F.col("turn")) % 5 == 0, F.concat("text", F.lit(" API_KEY="), token(F.col("conv_id")), F.lit(" end"))).otherwise(F.col("text")))


@query(masked_sql(columns="conv_id, turn", source=_CONV))
def mask_conversations(spark, d):
    return conversations(spark, d).select("conv_id", "turn", mask_leaf_outcome(F.col("text")).alias("m")).select("conv_id", "turn", *leaf_fields())


_START = "list_sum(list_transform(ps[1:i], lambda p: length(p)))::BIGINT + coalesce(list_sum(list_transform(xs[1:i - 1], lambda o: length(o.p) + length(o.v))), 0)::BIGINT + length(xs[i].p)"


def findings_sql(config: ScanConfig = ScanConfig(), head: str = "SELECT doc_id, type, confidence, action, start_at, end_at FROM f", source: str = DOCS) -> str:
    return f"""WITH {scan_ctes(source, config)},
u AS (SELECT *, unnest(range(1, len(xs) + 1)) AS i FROM s WHERE len(xs) > 0),
f AS (SELECT *, xs[i].k AS type, xs[i].c AS confidence, xs[i].a AS action, ({_START})::BIGINT AS start_at, ({_START} + length(xs[i].v))::BIGINT AS end_at FROM u WHERE NOT xs[i].g)
{head}"""


def findings(df: DataFrame, config: ScanConfig, *keys: str) -> DataFrame:
    f = df.select(*keys, scan(F.col("text"), config).alias("s")).where(F.size("s.findings") > 0).select(*keys, F.explode("s.findings").alias("f"))
    return f.select(*keys, "f.type", "f.confidence", "f.action", F.col("f.start").cast("long").alias("start_at"), F.col("f.end").cast("long").alias("end_at"))


@query(findings_sql())
def findings_documents(spark, d):
    return findings(table(spark, d, DOCS), ScanConfig(), "doc_id")


PII = ScanConfig(pii=True)


@query(findings_sql(PII))
def findings_pii_documents(spark, d):
    return findings(table(spark, d, DOCS), PII, "doc_id")


@query(findings_sql(PII, "SELECT type, action, count(*) AS n FROM f GROUP BY type, action"))
def findings_by_type(spark, d):
    return findings(table(spark, d, DOCS), PII, "doc_id").groupBy("type", "action").agg(F.count("*").alias("n"))


def counts_sql(by: str, config: ScanConfig = ScanConfig(), source: str = DOCS) -> str:
    group = f" GROUP BY {by}" if by else ""
    return f"WITH {scan_ctes(source, config)}, l AS (SELECT *, {leaf_columns()} FROM s) SELECT {by + ', ' if by else ''}{_COUNT_SQL} FROM l{group}"


@query(counts_sql("source"))
def counters_by_source(spark, d):
    return count_outcomes(masked_docs(spark, d), "m", "source")


@query(counts_sql("lang"))
def counters_by_lang(spark, d):
    return count_outcomes(masked_docs(spark, d), "m", "lang")


@query(counts_sql(""))
def counters_total(spark, d):
    return count_outcomes(masked_docs(spark, d), "m")


@query(f"WITH {scan_ctes(DOCS, PII)} SELECT doc_id, n_findings AS findings FROM s WHERE n_findings > 0 AND n_redacted = 0 AND NOT blocked")
def warn_gap_documents(spark, d):
    m = masked_docs(spark, d, PII)
    return m.where((F.col("m.findings") > 0) & (F.col("m.outcome") == "unchanged")).select("doc_id", F.col("m.findings").cast("long").alias("findings"))


_PEM_DOC = "(SELECT doc_id, CASE WHEN doc_id % 7 = 0 THEN text || chr(10) || '-----BEGIN ' || 'PRIVATE KEY-----' || chr(10) || md5(text) || chr(10) || '-----END ' || 'PRIVATE KEY-----' ELSE text END AS text FROM documents)"


def pem_docs(spark, d) -> DataFrame:
    t = F.col("text")
    pem = F.concat(t, F.lit("\n-----BEGIN "), F.lit("PRIVATE KEY-----\n"), F.md5(t), F.lit("\n-----END "), F.lit("PRIVATE KEY-----"))
    return table(spark, d, DOCS).select("doc_id", F.when(F.col("doc_id") % 7 == 0, pem).otherwise(t).alias("text"))


@query(masked_sql(source=_PEM_DOC))
def block_policy_documents(spark, d):
    return pem_docs(spark, d).select("doc_id", mask_leaf_outcome(F.col("text")).alias("m")).select("doc_id", *leaf_fields())


# --- policies, rulesets, formats, limits ------------------------------------------------------------------


def rules(*pairs: tuple[str, str]) -> ScanConfig:
    doc = {"actionPolicyRevision": 1, "base": "default", "rules": [{"id": f"r{i}", "match": {"type": [t]}, "action": a} for i, (t, a) in enumerate(pairs)]}
    return ScanConfig(rules=parse_policy(doc), pii=True)


OVERLAYS = {
    "overlay_secret_warn": rules(("contextual_secret", "warn")),
    "overlay_secret_block": rules(("contextual_secret", "block")),
    "overlay_email_redact": rules(("pii_global_email", "redact")),
    "overlay_redact_all": rules(("contextual_secret", "redact"), ("pii_global_email", "redact"), ("private_key", "redact")),
    "overlay_first_match": rules(("contextual_secret", "default"), ("contextual_secret", "block"), ("pii_global_email", "allow")),
}
for _name, _config in OVERLAYS.items():
    QUERIES[_name] = lambda spark, d, c=_config: masked_docs(spark, d, c).select("doc_id", *leaf_fields())
    ORACLES[_name] = masked_sql(_config)


@query(masked_sql(rules(("contextual_secret", "block"), ("pii_global_email", "redact"))))
def policy_callback_documents(spark, d):
    """A column policy replaces the default for every finding."""
    config = ScanConfig(policy=lambda kind, confidence: F.when(kind == "contextual_secret", "block").otherwise("redact"), pii=True)
    return masked_docs(spark, d, config).select("doc_id", *leaf_fields())


RULESET = ScanConfig(ruleset=parse_ruleset("ruleset-revision: 1\ndetector: order-number\nspecificity: contextual\nprefix: \"ORD-\"\nalphabet: digits\nrun: at-least 6\nvalidator: none"))
_ORD = "(SELECT doc_id, text || ' ORD-' || (1000000 + doc_id) || ' ORD-12' AS text FROM documents)"


@query(findings_sql(RULESET, source=_ORD))
def ruleset_documents(spark, d):
    docs = table(spark, d, DOCS).select("doc_id", F.concat("text", F.lit(" ORD-"), (F.col("doc_id") + 1_000_000).cast("string"), F.lit(" ORD-12")).alias("text"))
    return findings(docs, RULESET, "doc_id")


@query(f"WITH {scan_ctes(DOCS, placeholder=chr(39) + '[' + chr(39) + ' || {kind} || ' + chr(39) + '#' + chr(39) + ' || {n} || ' + chr(39) + ']' + chr(39))} SELECT doc_id, masked AS masked_text FROM s")
def formatter_documents(spark, d):
    shown = scan(F.col("text"), formatter=lambda kind, n: F.concat(F.lit("["), kind, F.lit("#"), n.cast("string"), F.lit("]")))
    return table(spark, d, DOCS).select("doc_id", shown["text"].alias("masked_text"))


@query(f"""WITH {scan_ctes(DOCS)} SELECT doc_id,
CASE WHEN strlen(text) > 3000 OR n_findings > 1 THEN '[REDACTED:ERROR]' WHEN blocked THEN '[REDACTED:BLOCKED]' ELSE masked END AS masked_text,
CASE WHEN strlen(text) > 3000 OR n_findings > 1 THEN 'failed' WHEN blocked THEN 'blocked' WHEN masked <> text THEN 'redacted' ELSE 'unchanged' END AS outcome FROM s""")
def scan_limits_documents(spark, d):
    m = masked_docs(spark, d, ScanConfig(max_input_bytes=3000, max_findings=1))
    return m.select("doc_id", F.col("m.text").alias("masked_text"), F.col("m.outcome").alias("outcome"))


@query(f"""WITH {scan_ctes(DOCS)} SELECT doc_id, CASE WHEN length(text) > 2000 THEN '[REDACTED:LIMIT_EXCEEDED]' WHEN blocked THEN '[REDACTED:BLOCKED]' ELSE masked END AS masked_text,
CASE WHEN length(text) > 2000 THEN 'limited' WHEN blocked THEN 'blocked' WHEN masked <> text THEN 'redacted' ELSE 'unchanged' END AS outcome FROM s""")
def limit_max_string_length(spark, d):
    m = table(spark, d, DOCS).select("doc_id", mask_leaf_outcome(F.col("text"), max_string_length=2000).alias("m"))
    return m.select("doc_id", F.col("m.text").alias("masked_text"), F.col("m.outcome").alias("outcome"))


@query("""SELECT doc_id, CASE WHEN contains(t, 'BOOM') THEN 'failed' WHEN contains(t, 'BLOCK_ME') THEN 'block' WHEN regexp_matches(t, 'SECRET_TOKEN_[0-9]+') THEN 'redact' WHEN contains(t, 'WARN_ME') THEN 'warn' ELSE 'none' END AS action,
CASE WHEN contains(t, 'BOOM') OR contains(t, 'BLOCK_ME') THEN t ELSE regexp_replace(t, 'SECRET_TOKEN_[0-9]+', '<SECRET_1>') END AS masked_text
FROM (SELECT doc_id, text || [' BOOM', ' BLOCK_ME', ' SECRET_TOKEN_12 SECRET_TOKEN_3', ' WARN_ME', ''][doc_id % 5 + 1] AS t FROM documents)""")
def fixture_scanner_documents(spark, d):
    tail = F.element_at(F.array(*[F.lit(x) for x in (" BOOM", " BLOCK_ME", " SECRET_TOKEN_12 SECRET_TOKEN_3", " WARN_ME", "")]), (F.col("doc_id") % 5 + 1).cast("int"))
    s = table(spark, d, DOCS).select("doc_id", fixture_scan(F.concat("text", tail)).alias("s"))
    return s.select("doc_id", F.when(F.col("s.failed"), "failed").otherwise(F.coalesce(F.get(F.col("s.findings"), F.lit(0))["action"], F.lit("none"))).alias("action"), F.col("s.text").alias("masked_text"))


# --- key context -----------------------------------------------------------------------------------------

_KEYED = """(SELECT event_id, ['password', 'client_secret', 'name', 'api_key', 'note', 'password_policy'][event_id % 6 + 1] AS k,
 substr(md5(event_id::VARCHAR), 1, [4, 10, 20][event_id % 3 + 1]) AS text FROM events)"""


@query(f"""SELECT event_id, k, CASE WHEN k IN ('password', 'client_secret', 'api_key') AND length(text) >= 16 THEN '<SECRET_1>' ELSE text END AS masked_text,
(CASE WHEN k IN ('password', 'client_secret', 'api_key') AND length(text) >= 8 THEN 1 ELSE 0 END)::BIGINT AS findings FROM {_KEYED}""")
def key_context_columns(spark, d):
    pick = lambda xs: F.element_at(F.array(*map(F.lit, xs)), (F.col("event_id") % len(xs) + 1).cast("int"))
    e = table(spark, d, "events").select("event_id", pick(["password", "client_secret", "name", "api_key", "note", "password_policy"]).alias("k"), F.md5(F.col("event_id").cast("string")).alias("h"), pick([4, 10, 20]).alias("n"))
    m = e.select("event_id", "k", mask_leaf_outcome(F.substr("h", F.lit(1), F.col("n")), F.col("k")).alias("m"))
    return m.select("event_id", "k", F.col("m.text").alias("masked_text"), F.col("m.findings").cast("long").alias("findings"))


# --- configuration ---------------------------------------------------------------------------------------

_VERSIONS = ["0.1.0-beta.12", "0.1.0-beta.2", "0.1.0", "0.2.0-alpha.1", "1.0", "0.1.0-rc.1", "10.0.0", "0.0.9"]


def choice(values: list, key: str, sql: bool = False):
    """One of some values for each row of a table, by its key."""
    if sql:
        return "[" + ", ".join(quote(v) if isinstance(v, str) else str(v).lower() for v in values) + f"][{key} % {len(values)} + 1]"
    return F.element_at(F.array(*[F.lit(v) for v in values]), (F.col(key) % len(values) + 1).cast("int"))


@query(f"SELECT p_partkey, {choice(_VERSIONS, 'p_partkey', True)} AS v, {choice([True, False, True, True, False, True, True, False], 'p_partkey', True)} AS ok FROM part")
def version_floor(spark, d):
    """Versions that come with the rows of a table."""
    return table(spark, d, "part").select("p_partkey", choice(_VERSIONS, "p_partkey").alias("v")).withColumn("ok", version_at_least(F.col("v"), "0.1.0-beta.12"))


_IDENTITIES = ["credentials=full;selectors=pii:global;families=a", "credentials=full;selectors=off", "selectors=pii:global,pii:kr", "credentials=full", "selectors="]


@query(f"SELECT s_suppkey, identity, CASE WHEN s IN ('', 'off') THEN 0 ELSE len(string_split(s, ',')) END::BIGINT AS n_active, list_contains(string_split(s, ','), 'pii:global') AS has_global, s IN ('', 'off') AS is_off FROM (SELECT s_suppkey, identity, regexp_extract(identity, 'selectors=([^;]*)', 1) AS s FROM (SELECT s_suppkey, {choice(_IDENTITIES, 's_suppkey', True)} AS identity FROM supplier))")
def activation_reflects(spark, d):
    i = F.col("identity")
    own = table(spark, d, "supplier").select("s_suppkey", choice(_IDENTITIES, "s_suppkey").alias("identity"))
    return own.select("s_suppkey", i, F.size(active_selectors(i)).cast("long").alias("n_active"), reflects(i, ["pii:global"]).alias("has_global"), reflects(i, []).alias("is_off"))


# --- walking values --------------------------------------------------------------------------------------

_ORDER_TEXT = f"(SELECT o_orderkey, o_totalprice, 'order ' || o_orderkey || CASE WHEN o_orderkey % 8 = 0 THEN ' key ' || {token_sql('o_orderkey')} ELSE '' END AS text FROM orders)"


@query(f"WITH {scan_ctes(_ORDER_TEXT)} SELECT o_orderkey, o_totalprice AS price, masked AS note, masked AS deep, CASE WHEN n_redacted > 0 THEN masked ELSE text END AS listed FROM s")
def mask_nested_orders(spark, d):
    key = F.col("o_orderkey")
    note = F.concat(F.lit("order "), key.cast("string"), F.when(key % 8 == 0, F.concat(F.lit(" key "), token(key))).otherwise(""))
    df = table(spark, d, "orders").select("o_orderkey", F.struct(F.col("o_totalprice").alias("price"), note.alias("note"), F.struct(F.struct(note.alias("deep")).alias("b")).alias("a"), F.array(note, F.lit(None)).alias("list")).alias("v"))
    m = mask_columns(df, "v")
    return m.select("o_orderkey", "v.price", "v.note", "v.a.b.deep", F.get("v.list", F.lit(0)).alias("listed"))


@query("SELECT c_custkey, '<SECRET_1>' AS api_key, 'plain text of ' || c_custkey AS note FROM customer")
def mask_map_attributes(spark, d):
    k = F.col("c_custkey")
    df = table(spark, d, "customer").select("c_custkey", F.create_map(F.lit("api_key"), F.md5(k.cast("string")), F.lit("note"), F.concat(F.lit("plain text of "), k.cast("string"))).alias("attributes"))
    m = mask_columns(df, "attributes")
    return m.select("c_custkey", F.col("attributes")["api_key"].alias("api_key"), F.col("attributes")["note"].alias("note"))


@query("SELECT p_partkey, least(3, p_partkey % 6)::BIGINT AS n, 2::BIGINT AS n_keys FROM part")
def mask_array_width(spark, d):
    df = table(spark, d, "part").select("p_partkey", F.array_repeat(F.lit("x"), (F.col("p_partkey") % 6).cast("int")).alias("a"), F.create_map(*[F.lit(x) for x in "aabbcc"]).alias("m"))
    w = mask_columns(df, "a", "m", walk=Walk(limits={"max_array_length": 3, "max_object_keys": 2}))
    return w.select("p_partkey", F.size("a").cast("long").alias("n"), F.size("m").cast("long").alias("n_keys"))


@query("SELECT s_suppkey, 'a' AS level1, CAST(NULL AS VARCHAR) AS level3, '[REDACTED:LIMIT_EXCEEDED]' AS list3 FROM supplier")
def depth_limit(spark, d):
    deep = F.struct(F.lit("a").alias("t"), F.struct(F.lit("b").alias("t"), F.struct(F.lit("c").alias("t")).alias("x"), F.array(F.lit("d")).alias("l")).alias("x"))
    m = mask_columns(table(spark, d, "supplier").select("s_suppkey", deep.alias("v")), "v", walk=Walk(limits={"max_depth": 2}))
    return m.select("s_suppkey", F.col("v.t").alias("level1"), F.col("v.x.x.t").alias("level3"), F.get("v.x.l", F.lit(0)).alias("list3"))


@query("SELECT s_suppkey, 'failed with <SECRET_1>' AS message, 'secret short' AS stack, '<SECRET_1>' AS password, 'inner <SECRET_1>' AS cause FROM supplier")
def mask_exception_chain(spark, d):
    t = token(F.col("s_suppkey"))
    inner = F.struct(F.lit("E").alias("type"), F.concat(F.lit("inner "), t).alias("message"), F.lit("at").alias("stack"))
    err = F.struct(F.lit("E").alias("type"), F.concat(F.lit("failed with "), t).alias("message"), F.lit("secret short").alias("stack"), F.md5(t).alias("password"), inner.alias("cause"))
    m = mask_columns(table(spark, d, "supplier").select("s_suppkey", err.alias("error")), "error")
    return m.select("s_suppkey", "error.message", "error.stack", "error.password", F.col("error.cause.message").alias("cause"))


# --- budgets ---------------------------------------------------------------------------------------------

_COSTS = {"bytes": F.octet_length, "leaves": lambda _: F.lit(1), "scans": lambda _: F.lit(1)}


def charged(spark, d, limits: dict, *names: str) -> tuple[DataFrame, dict[str, Column]]:
    costs = {n: _COSTS[n](F.col("text")) for n in names}
    return charge(table(spark, d, "conversations"), "conv_id", "turn", costs, limits), costs


@query("SELECT conv_id, turn, count(*) OVER w <= 2 AS allowed FROM conversations WINDOW w AS (PARTITION BY conv_id ORDER BY turn ROWS UNBOUNDED PRECEDING)")
def budget_leaves(spark, d):
    return charged(spark, d, {"max_leaves": 2}, "leaves")[0].select("conv_id", "turn", "allowed")


@query("SELECT conv_id, turn, (sum(strlen(text)) OVER w)::BIGINT AS used_bytes, sum(strlen(text)) OVER w <= 600 AND count(*) OVER w <= 3 AS allowed FROM conversations WINDOW w AS (PARTITION BY conv_id ORDER BY turn ROWS UNBOUNDED PRECEDING)")
def budget_bytes(spark, d):
    return charged(spark, d, {"max_bytes": 600, "max_scans": 3}, "bytes", "scans")[0].select("conv_id", "turn", "used_bytes", "allowed")


@query("""WITH c AS (SELECT *, sum(strlen(text)) OVER w <= 600 AS allowed FROM conversations WINDOW w AS (PARTITION BY conv_id ORDER BY turn ROWS UNBOUNDED PRECEDING))
SELECT conv_id, coalesce(sum(strlen(text)) FILTER (WHERE allowed), 0)::BIGINT AS bytes, count(*) FILTER (WHERE allowed) AS leaves FROM c GROUP BY conv_id""")
def budget_usage(spark, d):
    c, costs = charged(spark, d, {"max_bytes": 600}, "bytes", "leaves")
    return usage(c, "conv_id", costs)


@query(f"""WITH {scan_ctes(_CONV)} SELECT conv_id, turn, (sum(n_findings) OVER w)::BIGINT AS used_findings, sum(n_findings) OVER w <= 1 AS allowed FROM s WINDOW w AS (PARTITION BY conv_id ORDER BY turn ROWS UNBOUNDED PRECEDING)""")
def budget_findings(spark, d):
    c = conversations(spark, d).withColumn("n", F.size(scan(F.col("text"))["findings"]))
    return charge(c, "conv_id", "turn", {"findings": F.col("n")}, {"max_findings": 1}).select("conv_id", "turn", "used_findings", "allowed")


@query("SELECT source, count(DISTINCT text) FILTER (WHERE length(text) <= 1024) + count(*) FILTER (WHERE length(text) > 1024) AS scans FROM documents GROUP BY source")
def memo_distinct_scans(spark, d):
    return first_of_text(table(spark, d, DOCS), "source", "doc_id", "text").groupBy("source").agg(F.count_if("scanned").alias("scans"))


# --- hosts -----------------------------------------------------------------------------------------------

_LINE = f"""'{{"level":30,"id":' || event_id || ',"msg":"user ' || user_id || '","api_key":"' || CASE WHEN event_id % 8 = 0 THEN {token_sql('event_id')} ELSE 'short' END || '","tags":["a\\\\n","b"],"n":{{"x":1.5}}}}'"""
_LINE_OUT = """'{"level":30,"id":' || event_id || ',"msg":"user ' || user_id || '","api_key":"' || CASE WHEN event_id % 8 = 0 THEN '<SECRET_1>' ELSE 'short' END || '","tags":["a\\\\n","b"],"n":{"x":1.5}}'"""


def event_lines(spark, d) -> DataFrame:
    i = F.col("event_id")
    secret = F.when(i % 8 == 0, token(i)).otherwise("short")
    line = F.concat(F.lit('{"level":30,"id":'), i.cast("string"), F.lit(',"msg":"user '), F.col("user_id").cast("string"), F.lit('","api_key":"'), secret, F.lit('","tags":["a\\\\n","b"],"n":{"x":1.5}}'))
    return table(spark, d, "events").select("event_id", "user_id", line.alias("line"))


@query(f"SELECT event_id, {_LINE_OUT} AS line FROM events")
def json_lines_events(spark, d):
    return redact_lines(event_lines(spark, d)).select("event_id", "line")


@query("""SELECT event_id, CASE WHEN event_id % 3 = 0 THEN '{"msg":"[REDACTED:ERROR]"}' || chr(10) WHEN event_id % 3 = 1 THEN '{"msg":"[REDACTED:LIMIT_EXCEEDED]"}' ELSE '{"a":"b"}' || chr(10) END AS line FROM events""")
def json_line_limits(spark, d):
    i = F.col("event_id")
    line = F.when(i % 3 == 0, '{"a":"b"} trailing\n').when(i % 3 == 1, F.concat(F.lit('{"a":"'), F.repeat(F.lit("x"), 90), F.lit('"}'))).otherwise('{"a":"b"}\n')
    return redact_lines(table(spark, d, "events").select("event_id", line.alias("line")), limits={"max_line": 80})


@query("SELECT event_id, 'user ' || user_id || ' did ' || event_type || ' 100% of 7 and %s' AS message FROM events")
def printf_messages(spark, d):
    args = F.array(F.col("user_id").cast("string"), "event_type", F.lit("7.9"))
    return table(spark, d, "events").select("event_id", hosts.format_message(F.lit("user %d did %s 100%% of %i and %s"), args).alias("message"))


@query("SELECT event_id, CASE WHEN event_id % 2 = 0 THEN ' key <SECRET_1>' ELSE ' plain' END AS message FROM events")
def msg_prefix(spark, d):
    i = F.col("event_id")
    message = F.when(i % 2 == 0, F.concat(F.lit(" key "), token(i))).otherwise(" plain")
    return table(spark, d, "events").select("event_id", hosts.mask_message(message, F.lit("[worker]")).alias("message"))


@query("SELECT event_id, 'login with <SECRET_1> by ' || user_id AS msg, 'Traceback <SECRET_1>' AS exc_text, '<SECRET_1>' AS password, md5(event_id::VARCHAR) AS other FROM events")
def log_records(spark, d):
    i = F.col("event_id")
    df = table(spark, d, "events").select(
        "event_id", F.lit("login with %s by %d").alias("msg"), F.array(token(i), F.col("user_id").cast("string")).alias("args"), F.concat(F.lit("Traceback "), token(i)).alias("exc_text"),
        F.create_map(F.lit("password"), F.md5(i.cast("string")), F.lit("secret"), F.md5(i.cast("string"))).alias("extra"),
    )
    r = hosts.redact_log_records(df, ["password"])
    return r.select("event_id", "msg", "exc_text", F.col("extra")["password"].alias("password"), F.col("extra")["secret"].alias("other"))


def spans(spark, d) -> DataFrame:
    i = F.col("event_id")
    return table(spark, d, "events").select(
        i.alias("span_id"), F.concat(F.lit("GET "), "event_type").alias("name"),
        F.create_map(F.lit("api_key"), F.md5(i.cast("string")), F.lit("url"), F.concat(F.lit("http://x/?q="), F.when(i % 8 == 0, token(i)).otherwise("1"))).alias("attributes"),
        F.create_map(F.lit("password"), F.array(F.lit("plainvalue123456"), F.lit(None), token(i))).alias("array_attributes"), F.create_map(F.lit("n"), F.col("value")).alias("numeric_attributes"),
        F.struct(F.lit(2).alias("code"), F.concat(F.lit("bad "), token(i)).alias("message")).alias("status"),
        F.array(F.struct(F.lit("retry").alias("name"), F.create_map(F.lit("secret"), F.md5(i.cast("string"))).alias("attributes"))).alias("events"),
        F.array(F.struct(F.create_map(F.lit("k"), token(i)).alias("attributes"))).alias("links"),
    )


@query("""SELECT event_id AS span_id, 'GET ' || event_type AS name, '<SECRET_1>' AS api_key, 'http://x/?q=' || CASE WHEN event_id % 8 = 0 THEN '<SECRET_1>' ELSE '1' END AS url,
'plainvalue123456|<SECRET_1>' AS listed, 'bad <SECRET_1>' AS status, '<SECRET_1>' AS event_secret, '<SECRET_1>' AS link, value AS n FROM events""")
def spans_from_events(spark, d):
    s = hosts.redact_spans(spans(spark, d))
    return s.select(
        "span_id", "name", F.col("attributes")["api_key"].alias("api_key"), F.col("attributes")["url"].alias("url"), F.array_join(F.col("array_attributes")["password"], "|").alias("listed"),
        F.col("status.message").alias("status"), F.get("events", F.lit(0))["attributes"]["secret"].alias("event_secret"), F.get("links", F.lit(0))["attributes"]["k"].alias("link"), F.col("numeric_attributes")["n"].alias("n"),
    )


@query("""SELECT event_id AS span_id, 3::BIGINT AS scanned, (1 + CASE WHEN event_id % 8 = 0 THEN 1 ELSE 0 END)::BIGINT AS findings, (1 + CASE WHEN event_id % 8 = 0 THEN 1 ELSE 0 END)::BIGINT AS redacted,
0::BIGINT AS blocked, 0::BIGINT AS limited, 0::BIGINT AS failed FROM events""")
def span_outcomes(spark, d):
    return count_outcomes(hosts.span_leaves(spans(spark, d).select("span_id", "name", "attributes"), "span_id"), "leaf", "span_id")


@query("SELECT event_id, 'body <SECRET_1>' AS body, event_type AS event_name, md5(event_id::VARCHAR) AS password FROM events")
def otel_logs(spark, d):
    """No key context in this host: an attribute under a credential key passes unless its own text says more."""
    i = F.col("event_id")
    df = table(spark, d, "events").select("event_id", F.concat(F.lit("body "), token(i)).alias("body"), F.col("event_type").alias("event_name"), F.create_map(F.lit("password"), F.md5(i.cast("string"))).alias("attributes"))
    return hosts.redact_otel_logs(df).select("event_id", "body", "event_name", F.col("attributes")["password"].alias("password"))


@query("SELECT event_id, [hex('body <SECRET_1>'), hex('[REDACTED:ERROR]'), hex('plain')][event_id % 3 + 1] AS body FROM events")
def otel_bytes(spark, d):
    i = F.col("event_id")
    data = F.when(i % 3 == 0, F.concat(F.lit("body "), token(i)).cast("binary")).when(i % 3 == 1, F.unhex(F.lit("FF00FE"))).otherwise(F.lit("plain").cast("binary"))
    return table(spark, d, "events").select("event_id", F.hex(mask_bytes(data)).alias("body"))


# --- strict boundaries -----------------------------------------------------------------------------------

_STRICT = """CASE WHEN strlen(text) > 65536 THEN 'blocked' WHEN blocked THEN 'blocked' ELSE 'ok' END AS outcome,
CASE WHEN strlen(text) > 65536 THEN 'limit_exceeded' WHEN blocked THEN 'policy' END AS reason, CASE WHEN strlen(text) > 65536 THEN 'INPUT_LIMIT_EXCEEDED' END AS code"""


def strict_docs(spark, d) -> DataFrame:
    return pem_docs(spark, d).select("doc_id", context.sanitize_text(F.col("text")).alias("o"))


@query(f"WITH {scan_ctes(_PEM_DOC)} SELECT doc_id, {_STRICT}, CASE WHEN strlen(text) <= 65536 AND NOT blocked THEN masked END AS value FROM s")
def sanitize_text_outcomes(spark, d):
    return strict_docs(spark, d).select("doc_id", "o.outcome", "o.reason", "o.code", "o.value")


@query(f"WITH {scan_ctes(_PEM_DOC)}, o AS (SELECT {_STRICT} FROM s) SELECT 'text' AS stage, outcome, reason, code, count(*) AS n FROM o GROUP BY ALL")
def block_reasons(spark, d):
    return context.audit(strict_docs(spark, d), "text")


@query(f"""SELECT event_id, CASE WHEN event_id % 4 = 0 THEN 'blocked' ELSE 'ok' END AS outcome, CASE WHEN event_id % 4 = 0 THEN 'policy' END AS reason,
CASE WHEN event_id % 4 <> 0 THEN '{{"' || CASE WHEN event_id % 4 = 1 THEN 'password' ELSE 'note' END || '":"' || CASE WHEN event_id % 4 = 1 THEN '<SECRET_1>' ELSE md5(event_id::VARCHAR) END || '","type":"' || event_type || '"}}' END AS value FROM events""")
def sanitize_value_props(spark, d):
    """Objects whose first key holds a token, a credential key, or neither."""
    i = F.col("event_id")
    key = F.when(i % 4 == 0, token(i)).when(i % 4 == 1, "password").otherwise("note")
    v = F.create_map(key, F.md5(i.cast("string")), F.lit("type"), F.col("event_type"))
    o = sanitize_column(table(spark, d, "events").select("event_id", v.alias("v")), "v", outcome="o")
    return o.select("event_id", "o.outcome", "o.reason", F.to_json("v").alias("value"))


_CTX = f"(SELECT conv_id, turn, role, CASE WHEN conv_id % 9 = 0 AND turn % 2 = 1 THEN text || ' -----BEGIN ' || 'PRIVATE KEY-----' || chr(10) || md5(text) || chr(10) || '-----END ' || 'PRIVATE KEY-----' ELSE text END AS text FROM {_CONV})"


@query(f"""WITH {scan_ctes(_CTX)} SELECT conv_id, CASE WHEN bool_or(blocked) THEN 'blocked' ELSE 'ok' END AS outcome, CASE WHEN bool_or(blocked) THEN 'policy' END AS reason,
CASE WHEN NOT bool_or(blocked) THEN sum(n_findings)::BIGINT END AS n_findings, CASE WHEN NOT bool_or(blocked) THEN md5(string_agg(role || ':' || masked, '|' ORDER BY turn)) END AS digest FROM s GROUP BY conv_id""")
def build_context_conversations(spark, d):
    t = F.col("text")
    pem = F.concat(t, F.lit(" -----BEGIN "), F.lit("PRIVATE KEY-----\n"), F.md5(t), F.lit("\n-----END "), F.lit("PRIVATE KEY-----"))
    c = conversations(spark, d).withColumn("text", F.when((F.col("conv_id") % 9 == 0) & (F.col("turn") % 2 == 1), pem).otherwise(t))
    b = context.build_context(c)
    messages = F.from_json("messages", "array<struct<role:string,content:string>>")
    return b.select("conv_id", "outcome", "reason", "n_findings", F.md5(F.array_join(F.transform(messages, lambda m: F.concat(m["role"], F.lit(":"), m["content"])), "|")).alias("digest"))


@query(findings_sql(source=_CONV, head="SELECT conv_id, turn, row_number() OVER (PARTITION BY conv_id ORDER BY turn, start_at)::BIGINT - 1 AS ordinal, start_at, end_at FROM f"))
def context_occurrences(spark, d):
    from pyspark.sql import Window

    f = findings(conversations(spark, d), ScanConfig(), "conv_id", "turn")
    return f.select("conv_id", "turn", (F.row_number().over(Window.partitionBy("conv_id").orderBy("turn", "start_at")) - 1).cast("long").alias("ordinal"), "start_at", "end_at")


def chunks(spark, d, size: int = 64) -> DataFrame:
    """Documents cut into chunks, each stream ended by a finalize."""
    n = F.ceil(F.length("text") / size).cast("int")
    parts = F.transform(F.sequence(F.lit(0), F.greatest(n, F.lit(1)) - 1), lambda i: F.struct(i.cast("long").alias("seq"), F.lit("append").alias("op"), F.substr(F.col("text"), i * size + 1, F.lit(size)).alias("chunk")))
    end = F.struct(F.greatest(n, F.lit(1)).cast("long").alias("seq"), F.lit("finalize").alias("op"), F.lit(None).cast("string").alias("chunk"))
    return table(spark, d, DOCS).select(F.col("doc_id").alias("stream_id"), F.explode(F.concat(parts, F.array(end))).alias("s")).select("stream_id", "s.*")


@query(f"WITH {scan_ctes(DOCS)} SELECT doc_id AS stream_id, CASE WHEN strlen(text) > 65536 THEN 'blocked' ELSE 'ok' END AS outcome, CASE WHEN strlen(text) <= 65536 THEN masked END AS value FROM s")
def stream_batch_documents(spark, d):
    return context.stream_batch(chunks(spark, d)).select("stream_id", "outcome", "value")


@query("SELECT doc_id AS stream_id, CASE WHEN doc_id % 2 = 0 THEN 'aborted' WHEN doc_id % 4 = 1 THEN 'blocked' ELSE 'blocked' END AS outcome, CASE WHEN doc_id % 2 = 1 THEN 'lifecycle' END AS reason FROM documents")
def stream_abort_and_lifecycle(spark, d):
    """Even streams are aborted before their end; odd ones have two ends or none."""
    c = table(spark, d, DOCS).select(F.col("doc_id").alias("stream_id"), "text")
    last = F.when(F.col("stream_id") % 2 == 0, F.array(F.lit("append"), F.lit("abort"), F.lit("finalize"))).when(F.col("stream_id") % 4 == 1, F.array(F.lit("append"), F.lit("finalize"), F.lit("finalize"))).otherwise(F.array(F.lit("append")))
    c = c.select("stream_id", "text", F.posexplode(last).alias("p", "op")).select("stream_id", F.col("p").cast("long").alias("seq"), "op", F.when(F.col("op") == "append", F.col("text")).alias("chunk"))
    return context.stream_batch(c).select("stream_id", "outcome", "reason")


# --- tools and resources ---------------------------------------------------------------------------------


def tool_calls(spark, d, binary: str = "block") -> DataFrame:
    """Results of two blocks: the page's whole html, and an image, an unknown type or a text with a token."""
    i = F.col("page_id")
    block = lambda kind, text, data=None: F.struct(F.lit(kind).alias("type"), (text if isinstance(text, Column) else F.lit(text)).cast("string").alias("text"), F.lit(data).cast("string").alias("data"))
    second = F.when(i % 5 == 0, block("image", None, "AAAA")).when(i % 5 == 1, block("video", None)).otherwise(block("text", F.concat(F.lit("k "), token(i))))
    whole = F.to_json(F.struct(F.array(block("text", F.col("html")), second).alias("content")))
    return strict.sanitize(table(spark, d, "pages"), "tool_result", whole, Strict(binary=binary), "tool-result", failed=i % 5 == 4).select(i, "o")


_HTML = "(SELECT page_id, html AS text FROM pages)"
#: A text block is also scanned under its key, in a view that is 11 bytes longer.
_TOO_LARGE = "strlen(text) > 65536 - 11 AND n_findings = 0 OR strlen(text) > 65536"


def _tool_sql(refused: str) -> str:
    return f"""t AS (SELECT *, CASE WHEN page_id % 5 = 4 THEN 'tool_error' WHEN page_id % 5 IN ({refused}) THEN 'blocked' WHEN {_TOO_LARGE} OR blocked THEN 'blocked' ELSE 'ok' END AS outcome,
 CASE WHEN page_id % 5 = 4 THEN NULL WHEN page_id % 5 IN ({refused}) THEN 'unsupported_value' WHEN {_TOO_LARGE} THEN 'limit_exceeded' WHEN blocked THEN 'policy' END AS reason,
 CASE WHEN page_id % 5 = 4 OR page_id % 5 IN ({refused}) THEN NULL WHEN {_TOO_LARGE} THEN 'INPUT_LIMIT_EXCEEDED' END AS code FROM s)"""


@query(f"WITH {scan_ctes(_HTML)}, {_tool_sql('0, 1')} SELECT page_id, outcome, reason, code, CASE WHEN outcome = 'ok' THEN masked END AS first, CASE WHEN outcome = 'ok' THEN 'k <SECRET_1>' END AS second FROM t")
def tool_results_pages(spark, d):
    part = lambda i: F.get_json_object("o.value", f"$.content[{i}].text")
    return tool_calls(spark, d).select("page_id", "o.outcome", "o.reason", "o.code", part(0).alias("first"), part(1).alias("second"))


@query(f"WITH {scan_ctes(_HTML)}, {_tool_sql('1')} SELECT page_id, outcome, CASE WHEN outcome = 'ok' AND page_id % 5 = 0 THEN '{{\"type\":\"image\",\"data\":\"AAAA\"}}' WHEN outcome = 'ok' THEN '{{\"type\":\"text\",\"text\":\"k <SECRET_1>\"}}' END AS second FROM t")
def tool_binary_policy(spark, d):
    """Binary blocks that pass come back unscanned, in their place and order."""
    return tool_calls(spark, d, "pass").select("page_id", "o.outcome", F.get_json_object("o.value", "$.content[1]").alias("second"))


@query(f"WITH {scan_ctes(_HTML)}, {_tool_sql('0, 1')} SELECT 'tool' AS stage, outcome, reason, code, count(*) AS n FROM t GROUP BY ALL")
def audit_counts(spark, d):
    return context.audit(tool_calls(spark, d), "tool")


def _fixed_sql() -> str:
    from .constants import BLOCKED_TEXT, TOOL_ERROR_TEXT

    fixed = lambda t: quote(f'{{"content":[{{"type":"text","text":"{t}"}}],"isError":true}}')
    return f"WITH {scan_ctes(_HTML)}, {_tool_sql('0, 1')} SELECT page_id, CASE WHEN outcome = 'tool_error' THEN {fixed(TOOL_ERROR_TEXT)} WHEN outcome = 'blocked' THEN {fixed(BLOCKED_TEXT)} ELSE masked END AS sent FROM t"


@query(_fixed_sql())
def wire_results(spark, d):
    sent = context.wire(F.col("o.outcome"), F.col("o.value"))
    return tool_calls(spark, d).select("page_id", F.when(F.col("o.outcome") == "ok", F.get_json_object(sent, "$.content[0].text")).otherwise(sent).alias("sent"))


@query("SELECT page_id, page_id % 2 = 1 AS caught FROM pages")
def tool_backstop(spark, d):
    """Keys beside values in the serialised part: what the leaves alone don't show."""
    i = F.col("page_id")
    part = F.concat(F.lit('{"'), F.when(i % 2 == 1, "password").otherwise("note"), F.lit('":"'), F.md5(i.cast("string")), F.lit('"}'))
    return table(spark, d, "pages").select(i, context.backstop(part).alias("caught"))


def resource_reads(spark, d, binary: str = "block") -> DataFrame:
    """Resources with a text, a blob or both; every fourth uri holds a token; every seventh read fails."""
    i = F.col("page_id")
    text = F.when(i % 3 != 1, F.concat(F.lit("see "), token(i)))
    blob = F.when(i % 3 != 0, F.lit("AAAA"))
    uri = F.when(i % 4 == 0, F.concat(F.lit("file://x/"), token(i))).otherwise(F.col("url"))
    whole = F.to_json(F.struct(F.array(F.struct(uri.alias("uri"), text.alias("text"), blob.alias("blob"))).alias("contents")))
    return strict.sanitize(table(spark, d, "pages"), "resource_result", whole, Strict(binary=binary), "resource", failed=i % 7 == 3).select(i, "o")


_RESOURCE = """CASE WHEN page_id % 7 = 3 THEN 'read_error' WHEN page_id % 3 {} THEN 'ok' ELSE 'blocked' END"""
_URI = "CASE WHEN page_id % 4 = 0 THEN 'file://x/<SECRET_1>' ELSE url END"


@query(f"SELECT page_id, {_RESOURCE.format('= 0')} AS outcome, CASE WHEN page_id % 3 = 0 AND page_id % 7 <> 3 THEN 'see <SECRET_1>' END AS text, CASE WHEN page_id % 3 = 0 AND page_id % 7 <> 3 THEN {_URI} END AS uri FROM pages")
def resource_contents(spark, d):
    """Every field of a resource is scanned, its uri as well."""
    field = lambda n: F.get_json_object("o.value", f"$.contents[0].{n}")
    return resource_reads(spark, d).select("page_id", "o.outcome", field("text").alias("text"), field("uri").alias("uri"))


def _read_sql() -> str:
    from .constants import RESOURCE_BLOCKED_TEXT, RESOURCE_ERROR_CODE, RESOURCE_ERROR_TEXT

    fixed = lambda t: quote(f'{{"error":{{"code":{RESOURCE_ERROR_CODE},"message":"{t}"}}}}')
    value = f"""'{{"result":{{"contents":[{{"uri":"' || {_URI} || '",' || CASE WHEN page_id % 3 = 0 THEN '"text":"see <SECRET_1>"' ELSE '"blob":"AAAA"' END || '}}]}}}}'"""
    return f"WITH r AS (SELECT *, {_RESOURCE.format('<> 2')} AS outcome FROM pages) SELECT page_id, CASE outcome WHEN 'read_error' THEN {fixed(RESOURCE_ERROR_TEXT)} WHEN 'blocked' THEN {fixed(RESOURCE_BLOCKED_TEXT)} ELSE {value} END AS sent FROM r"


@query(_read_sql())
def resource_responses(spark, d):
    """Resource reads on the wire, where blobs pass."""
    return resource_reads(spark, d, "pass").select("page_id", context.resource_wire(F.col("o.outcome"), F.col("o.value")).alias("sent"))


@query(f"WITH {scan_ctes(DOCS)}, a AS (SELECT doc_id, masked AS text FROM s), {scan_ctes('a', name='r')} SELECT count(*) AS n, count(*) FILTER (WHERE r.masked IS DISTINCT FROM r.text) AS changed FROM r")
def idempotent_masking(spark, d):
    """Masking what is masked changes nothing."""
    once = table(spark, d, DOCS).select(mask_leaf(F.col("text")).alias("text"))
    return once.select((~mask_leaf(F.col("text")).eqNullSafe(F.col("text"))).alias("c")).agg(F.count("*").alias("n"), F.count_if("c").alias("changed"))


def _all() -> None:
    from . import queries_rows, queries_strict  # noqa: F401  these register theirs


def queries() -> dict[str, Callable[[SparkSession, str], DataFrame]]:
    _all()
    return dict(QUERIES)


def oracle_sql() -> dict[str, str]:
    _all()
    return dict(ORACLES)
