"""Queries against their SQL oracles on the smallest tables."""

import json
import os
import re

import duckdb
import pandas as pd
import pytest

from fieldguard import queries as Q

DATA = "/root/testdata/sf0.001"
SOME = [
    "mask_documents", "findings_pii_documents", "counters_by_source", "block_policy_documents", "overlay_redact_all", "ruleset_documents", "key_context_columns",
    "version_floor", "activation_reflects", "mask_map_attributes", "budget_bytes", "json_lines_events", "printf_messages", "build_context_conversations",
    "stream_abort_and_lifecycle", "wire_results", "idempotent_masking", "json_lines_hostile", "json_lines_long_literals", "log_calls", "log_call_shared_budget", "span_records", "log_record_outcomes",
    "otel_record_outcomes", "budget_operation_usage", "budget_operation_max_scans", "view_finding_outside_leaf", "sanitize_value_nested", "contexts_with_roles", "context_findings", "emitted_findings", "streamed_documents",
    "incremental_limits", "tool_arguments", "tool_results_structured", "resource_contents", "resource_responses", "callbacks_that_fail", "printf_dialect", "version_dialects", "workload_log_nested", "workload_parity",
]
pytestmark = pytest.mark.skipif(not os.path.isdir(DATA), reason="no test tables")


def plain(frame: pd.DataFrame) -> list[tuple]:
    def one(v):
        if v is None or v is pd.NA or v != v:
            return ""
        return str(int(v)) if isinstance(v, float) and v == int(v) else str(v)

    columns = sorted(frame.columns)
    return sorted(tuple(one(v) for v in row) for row in frame[columns].astype(object).itertuples(index=False))


@pytest.fixture(scope="module")
def con():
    c = duckdb.connect()
    for t in os.listdir(DATA):
        c.execute(f"CREATE VIEW {t.split('.')[0]} AS SELECT * FROM '{DATA}/{t}'")
    return c


@pytest.mark.parametrize("name", SOME)
def test_oracle(spark, con, name):
    mine, theirs = Q.queries()[name](spark, DATA).toPandas(), con.execute(Q.oracle_sql()[name]).df()
    assert sorted(mine.columns) == sorted(theirs.columns)
    assert plain(mine) == plain(theirs)


def test_every_query_has_an_oracle():
    assert set(Q.queries()) == set(Q.oracle_sql()) and not any(re.match(r"op\d", n) for n in Q.queries())


@pytest.mark.parametrize("name", ["mask_documents", "spans_from_events", "sanitize_text_outcomes", "log_records", "mask_nested_orders", "otel_logs"])
def test_no_python_on_the_default_path(spark, name):
    plan = Q.QUERIES[name](spark, DATA)._jdf.queryExecution().executedPlan().toString()
    assert "Python" not in plan and "Arrow" not in plan and "Pandas" not in plan


def test_entry(spark):
    assert Q.entry(spark, DATA).count() > 0


def test_tool_queries_scan_whole_pages(spark, tmp_path):
    """A private key far behind the start blocks the page, a token there is masked, and the byte limit of the texts holds,
    also for the view of a text under its key."""
    pem = "-----BEGIN " + "PRIVATE KEY-----\n" + "ab12" * 8 + "\n-----END " + "PRIVATE KEY-----"
    key = "gh" + "p_" + "0123456789abcdef" * 2 + "0000"
    pages = [(2, "u", "é" * 600 + " " + pem), (3, "u", "x " * 600 + key), (7, "u", "x" * 65_525), (8, "u", "x" * 65_526), (12, "u", None), (13, "u", "")]
    spark.createDataFrame(pages, "page_id long, url string, html string").write.parquet(f"{tmp_path}/pages.parquet")
    d = str(tmp_path)
    found = {r["page_id"]: (r["o"]["outcome"], r["o"]["reason"], r["o"]["code"], json.loads(r["o"]["value"])["content"][0].get("text") if r["o"]["value"] else None) for r in Q.tool_calls(spark, d).collect()}
    assert found[2] == ("blocked", "policy", None, None)
    assert found[3] == ("ok", None, None, "x " * 600 + "<SECRET_1>")
    assert found[7][:3] == ("ok", None, None) and len(found[7][3]) == 65_525
    assert found[8] == ("blocked", "limit_exceeded", "INPUT_LIMIT_EXCEEDED", None)
    assert found[13] == ("ok", None, None, "")
    assert {r["page_id"]: r["outcome"] for r in Q.QUERIES["tool_binary_policy"](spark, d).collect()}[2] == "blocked"
    assert {r["page_id"]: r["sent"] for r in Q.QUERIES["wire_results"](spark, d).collect()}[2].endswith('"isError":true}')
    assert any(r["reason"] == "policy" and r["n"] == 1 for r in Q.QUERIES["audit_counts"](spark, d).collect())
