"""Strict boundaries, contexts, streams, tools and live hosts on small cases."""

import json
import os
import random
import shutil
import subprocess
import sys

import pytest
from pyspark.sql import functions as F

from fieldguard.config import OptionsError, ScanConfig, bind_scan_config, resolve_scan_config, scan_config_of, snapshot_action_policy, verify_scan_options
from fieldguard.operators.strict import Strict, sanitize_column
from fieldguard.plans import context
from fieldguard.plans.ready import check_ready, create_strict, is_strict_limits, with_default_limits
from fieldguard.plans.strict import call_tools, sanitize

TOKEN = "gh" + "p_" + "SYNTHETICREVOKED0" + "A" * 19
PEM = "-----BEGIN " + "PRIVATE KEY-----\nabcd\n-----END " + "PRIVATE KEY-----"
LONG = "synthetic-but-not-a-secret"
LIMITS = {"max_input_bytes": 2048, "max_findings": 8, "max_depth": 4, "max_nodes": 32}
BOUNDS = {"max_input_bytes": 2048, "max_buffered_bytes": 1024, "max_token_bytes": 512, "max_multiline_bytes": 800}


def raising(*_):
    raise RuntimeError("input " + TOKEN)


def outcomes(spark, operation, values, rules=Strict(), **options):
    """The outcome of each value, with its value read again."""
    df = spark.createDataFrame([(i, v if isinstance(v, str) and operation == "raw" else json.dumps(v)) for i, v in enumerate(values)], "i int, v string").repartition(2)
    rows = sanitize(df, operation, F.col("v"), rules, **options).orderBy("i").collect()
    return [r["o"] for r in rows]


def shown(o):
    return (o["outcome"], json.loads(o["value"])) if o["outcome"] == "ok" else (o["outcome"], o["reason"], o["code"])


#: Values, what becomes of them, and the types of the findings that an ok outcome has.
VALUES = [
    ({"a": "text", "n": [1, 2.5, True, None]}, ("ok", {"a": "text", "n": [1, 2.5, True, None]}), []),
    ({"x": [{"env": "KEY " + TOKEN}]}, ("ok", {"x": [{"env": "KEY <SECRET_1>"}]}), ["github_token"]),
    ({"password": LONG, "user": LONG}, ("ok", {"password": "<SECRET_1>", "user": LONG}), ["contextual_secret"]),
    ({"password": [LONG], "auth": {"value": LONG}}, ("ok", {"password": [LONG], "auth": {"value": LONG}}), []),
    ({"secret": "EIGHT888"}, ("ok", {"secret": "EIGHT888"}), ["contextual_secret"]),
    ({"password": "<SECRET_1>", "api_key": "op://a/b/c", "token": "${TOKEN}", "secret": "{{ it }}"}, ("ok", {"password": "<SECRET_1>", "api_key": "op://a/b/c", "token": "${TOKEN}", "secret": "{{ it }}"}), []),
    ({"token_count": "4096 and more", "csrf_token": LONG, "token_type": "Bearer of it"}, ("ok", {"token_count": "4096 and more", "csrf_token": LONG, "token_type": "Bearer of it"}), []),
    ({"safe": "text", "pem": PEM}, ("blocked", "policy", None), None),
    ({TOKEN: "text"}, ("blocked", "policy", None), None),
    ({"a": {"b": {"c": {"d": {"e": "x"}}}}}, ("blocked", "limit_exceeded", None), None),
    (["x"] * 40, ("blocked", "limit_exceeded", None), None),
    ({"password": "text of it " * 185}, ("blocked", "limit_exceeded", "INPUT_LIMIT_EXCEEDED"), None),
    ({"lone": "a\ud800b"}, ("blocked", "core_error", "UNPAIRED_SURROGATE"), None),
    ("secret=EIGHT888 " * 9, ("blocked", "limit_exceeded", "FINDING_LIMIT_EXCEEDED"), None),
]




def test_values(spark):
    for o, (_, want, types) in zip(outcomes(spark, "value", [v for v, _, _ in VALUES], Strict(limits=LIMITS)), VALUES):
        assert shown(o) == want
        assert types is None and o["findings"] is None or [f["type"] for f in o["findings"]] == types


def test_keys_are_data_and_places_of_findings(spark):
    value = {"__proto__": {"password": LONG}, "constructor": "x", "": "y", "list": [TOKEN, {"k": "secret=EIGHT888"}]}
    o = outcomes(spark, "value", [value], label="tool-result")[0]
    assert json.loads(o["value"]) == {**value, "__proto__": {"password": "<SECRET_1>"}, "list": ["<SECRET_1>", {"k": "secret=EIGHT888"}]} and list(json.loads(o["value"])) == list(value)
    assert [(f["leafOrdinal"], f["rangeScope"], f["boundary"]) for f in o["findings"]] == [(0, "leaf", "tool-result"), (3, "leaf", "tool-result"), (4, "leaf", "tool-result")]
    both = outcomes(spark, "value", [{"a": TOKEN, "b": [PEM], "c": TOKEN}, {"a": TOKEN, TOKEN: 1}])
    assert [[(f["rangeScope"], f["leafOrdinal"], f["keyOrdinal"], f["action"]) for f in o["emitted"]] for o in both] == [[("leaf", 0, None, "redact"), ("leaf", 1, None, "block")], [("leaf", 0, None, "redact"), ("key", None, 1, "redact")]]


def test_budgets_and_failures_of_values(spark):
    six = [f"t{k}" for k in range(6)]
    for operation, value, fine in (({"max_scans": 4}, six, False), ({"max_scans": 4}, ["same"] * 6, True), ({"max_leaves": 5}, six, False), ({"max_keys": 1}, {"a": 1, "b": 2}, False), ({"max_bytes": 11}, six, False), ({"max_bytes": 12}, six, True), ({"max_findings": 1}, [TOKEN, TOKEN], False)):
        o = outcomes(spark, "value", [value], Strict(operation=operation))[0]
        assert (o["outcome"], o["reason"], o["code"]) == (("ok", None, None) if fine else ("blocked", "limit_exceeded", None)), operation
    first = outcomes(spark, "value", [["a", "b", PEM, "c"], [PEM, "a", "b", "c"]], Strict(operation={"max_scans": 2}))
    assert [o["reason"] for o in first] == ["limit_exceeded", "policy"]  # what comes first decides
    for config, code in ((ScanConfig(evaluate=raising), "POLICY_FAILURE"), (ScanConfig(evaluate=lambda f: "drop"), "INVALID_POLICY_ACTION"), (ScanConfig(formatter=raising), "PLACEHOLDER_FAILURE")):
        assert [shown(o) for o in outcomes(spark, "text", [TOKEN, "x"], Strict(config))] == [("blocked", "core_error", code), ("ok", "x")]
    assert shown(outcomes(spark, "text", [TOKEN], Strict(ScanConfig(formatter=lambda f, n: F.concat(F.lit(f.type + "#"), n))))[0]) == ("ok", "github_token#1")
    assert shown(outcomes(spark, "value", [{"a": "x"}], Strict(failure="NOT_INITIALIZED"))[0]) == ("blocked", "core_error", "NOT_INITIALIZED")
    assert [shown(o)[0] for o in outcomes(spark, "text", [7, ["x"]])] == ["blocked"] * 2
    assert [f["rangeScope"] for f in outcomes(spark, "dispatch", [TOKEN])[0]["findings"]] == ["text"]


def test_typed_columns_equal_json(spark):
    """Strict values of typed columns against the same values as JSON: outcomes, findings and the values released."""
    r = random.Random(4)
    text = lambda: r.choice(["plain", "plain", TOKEN, "secret=EIGHT888", "é", "x" * 30, PEM if r.random() < 0.1 else "y", None])
    rows = [(i, {"name": text(), "password": text(), "n": i, "tags": [text() for _ in range(r.randint(0, 4))], "bag": {(TOKEN if r.random() < 0.05 else f"k{k}"): text() for k in range(r.randint(0, 3))}, "inner": [{"secret": text(), "deep": {"note": [text()]}} for _ in range(r.randint(0, 3))]}) for i in range(80)]
    schema = "i int, v struct<name:string,password:string,n:int,tags:array<string>,bag:map<string,string>,inner:array<struct<secret:string,deep:struct<note:array<string>>>>>"
    df = spark.createDataFrame(rows, schema).withColumn("j", F.to_json("v", {"ignoreNullFields": "false"}))
    seen = set()
    for rules in (Strict(), Strict(limits={**LIMITS, "max_nodes": 20}), Strict(limits={**LIMITS, "max_depth": 3}), Strict(operation={"max_scans": 9}), Strict(operation={"max_bytes": 200})):
        both = sanitize(sanitize_column(df, "v", rules, "mine"), "value", F.col("j"), rules, into="theirs").withColumn("v", F.to_json("v", {"ignoreNullFields": "false"}))
        for x in both.collect():
            mine, theirs = x["mine"], x["theirs"]
            assert [mine[k] for k in ("outcome", "reason", "code", "findings", "emitted")] == [theirs[k] for k in ("outcome", "reason", "code", "findings", "emitted")]
            assert (x["v"] if mine["outcome"] == "ok" else None) == theirs["value"]
            seen.add((mine["outcome"], mine["reason"]))
    assert seen == {("ok", None), ("blocked", "policy"), ("blocked", "limit_exceeded")}


def test_typed_values_that_cannot_be_released(spark):
    df = spark.createDataFrame([(1, float("nan"), {1: "x"}, bytearray(b"x")), (2, 1.5, None, None)], "i int, d double, m map<int,string>, b binary")
    for name in ("d", "m", "b"):
        got = sanitize_column(df, name).orderBy("i").collect()
        assert [(x["outcome"]["outcome"], x["outcome"]["reason"]) for x in got] == [("blocked", "unsupported_value"), ("ok", None)] and got[0][name] is None
    assert "Python" not in sanitize_column(df, "d")._jdf.queryExecution().executedPlan().toString()


def test_contexts_share_budget_and_memo(spark):
    same = [("user", "same")] * 5
    cases = [[("user", "KEY " + TOKEN), ("tool", "x")], [("user", "x"), ("user", PEM)], [("user", "x"), (None, PEM)], same, [("user", "a"), ("user", "b")], [("user", PEM), ("user", "b")], [("user", TOKEN)] * 2]
    df = spark.createDataFrame([(i, n, *p) for i, parts in enumerate(cases) for n, p in enumerate(parts)], "conv_id int, turn int, role string, text string")

    def built(**options):
        return {x["conv_id"]: x for x in context.build_context(df, **options).collect()}

    o = built()
    assert json.loads(o[0]["messages"]) == [{"role": "user", "content": "KEY <SECRET_1>"}, {"role": "tool", "content": "x"}] and o[0]["n_findings"] == 1
    assert [o[i]["reason"] for i in range(7)] == [None, "policy", "unsupported_value", None, None, "policy", None]
    assert [x["reason"] for _, x in sorted(built(operation={"max_scans": 1}).items())] == ["limit_exceeded", "limit_exceeded", "unsupported_value", None, "limit_exceeded", "policy", None]
    assert [x["reason"] for _, x in sorted(built(operation={"max_leaves": 4, "max_findings": 1}).items())] == [None, "policy", "unsupported_value", "limit_exceeded", None, "policy", "limit_exceeded"]
    df = spark.createDataFrame([(1, 0, "user", TOKEN), (1, 1, "user", PEM), (1, 2, "user", TOKEN), (2, 0, "user", TOKEN), (2, 1, None, TOKEN)], "conv_id int, turn int, role string, text string")
    assert sorted((f["conv_id"], f["turn"], f["part"], f["finding"]["action"]) for f in context.context_findings(df).collect()) == [(1, 0, 0, "redact"), (1, 1, 1, "block"), (2, 0, 0, "redact")]


def test_streams(spark):
    life, ok = ("blocked", None, "lifecycle", None), ("ok", "API_KEY=<SECRET_1>", None, None)
    limit = lambda code: ("blocked", None, "limit_exceeded", code)
    end, abort = "finalize", "abort"
    cases = [
        (["API_KEY=" + TOKEN[:11], TOKEN[11:], (end,)], ok), (["text", (end,), (end,)], life), (["text"], life), (["a", (abort,), "b", (end,)], ("aborted", None, None, None)), (["text", (end,), TOKEN], ("ok", "text", None, None)),
        (["x\n" + PEM[:30], PEM[30:] + "\n", "y\n", (end,)], ("blocked", None, "policy", None)), (["a", None, (end,)], ("blocked", None, "unsupported_value", None)), (["a", ("fail",), (end,)], ("tool_error", None, None, None)),
        (["line of it\n" * 200, (end,)], limit("INPUT_LIMIT_EXCEEDED")), (["line of it\n" * 90] * 3 + [(end,)], limit("INPUT_LIMIT_EXCEEDED")), (["x " * 600, (end,)], limit("BUFFER_LIMIT_EXCEEDED")), (["x " * 300, "y " * 300, (end,)], limit("BUFFER_LIMIT_EXCEEDED")),
        (["x" * 600, (end,)], limit("TOKEN_LIMIT_EXCEEDED")), (["x" * 300, "x" * 300, (end,)], limit("TOKEN_LIMIT_EXCEEDED")), (["x" * 300, " ", "x" * 300, (end,)], ("ok", "x" * 300 + " " + "x" * 300, None, None)),
        ([PEM[:30] + "QUJD\n" * 170, (end,)], limit("MULTILINE_LIMIT_EXCEEDED")), ([PEM[:20], PEM[20:30] + "QUJD\n" * 100, "QUJD\n" * 70, (end,)], limit("MULTILINE_LIMIT_EXCEEDED")),
        ([PEM + "\n", "x" * 600, (end,)], ("blocked", None, "policy", None)), (["a line\n" + "x" * 600, "y", (end,)], limit("TOKEN_LIMIT_EXCEEDED")), (["", "", (end,)], ("ok", "", None, None)),
    ]
    rows = [(i, n, *(("append", s) if s is None or isinstance(s, str) else (s[0], None))) for i, (steps, _) in enumerate(cases) for n, s in enumerate(steps)]
    df = spark.createDataFrame(rows, "stream_id int, seq int, op string, chunk string").repartition(3)
    got = {x["stream_id"]: (x["outcome"], x["value"], x["reason"], x["code"]) for x in context.stream_batch(df, incremental=BOUNDS).collect()}
    for i, (steps, want) in enumerate(cases):
        assert got[i] == want, steps
    assert context.stream_batch(df, incremental=True, failure="NOT_INITIALIZED").where("code = 'NOT_INITIALIZED'").count() == len(cases)


def test_every_partition_gives_the_whole(spark):
    r = random.Random(5)
    pool = ["plain words\n", "password=hunter2hunter2hunter2\n", f"API_KEY={TOKEN} ", PEM[:39], PEM[39:], "\n", "x", "-----BEGIN ", "é token: 'abcdefghijklmnop' ", "\n\n", "customer email: a@b.example.com ", "----", "-"]
    whole = ["".join(r.choice(pool) for _ in range(r.randint(1, 12))) for _ in range(120)]
    rows = []
    for i, text in enumerate(whole):
        at = n = 0
        while at < len(text):
            k = r.randint(1, 15)
            rows.append((i, n, "append", text[at : at + k]))
            at, n = at + k, n + 1
        rows.append((i, n, "finalize", None))
    df = spark.createDataFrame(rows, "stream_id int, seq int, op string, chunk string")
    one = spark.createDataFrame(list(enumerate(whole)), "i int, t string").select("i", context.sanitize_text(F.col("t")).alias("o"))
    want = {x["i"]: (x["o"]["outcome"], x["o"]["value"], x["o"]["reason"]) for x in one.collect()}
    assert {x["stream_id"]: (x["outcome"], x["value"], x["reason"]) for x in context.stream_batch(df, incremental=True).collect()} == want


def test_tool_results_arguments_and_calls(spark):
    text = lambda s, **k: {"type": "text", "text": s, **k}
    image, audio = {"type": "image", "data": TOKEN, "mimeType": "x"}, {"type": "audio", "data": 7}
    blob = {"type": "resource", "resource": {"uri": "u " + TOKEN, "blob": "AA"}, "note": "n"}
    bad = [None, [], {"content": {}}, {"content": ["x"]}, {"content": [{"type": "video"}]}, {"content": [image]}, {"content": [{"type": "resource", "resource": "x"}]}, {"content": [{"text": "x"}]}, {"content": [[]]}]
    fine = [{"content": [text("KEY " + TOKEN)], "meta": {"password": LONG}}, {}, {"content": []}, {"content": [{"type": "resource_link", "uri": "v", "data": "scanned " + TOKEN}]}]
    # what only stands beside its key in the text of a part: numbers under a credential's key
    beside = [{"content": [], "api_key": 123456789012345678}, {"content": [text("x", token=1234567890123456789)]}, {"content": [text("token: \"x")]}]
    all_ = outcomes(spark, "tool_result", bad + fine + beside)
    assert [o["reason"] for o in all_[: len(bad)]] == ["unsupported_value"] * len(bad) and [o["reason"] for o in all_[-3:]] == ["policy", "policy", None]
    assert [json.loads(o["value"]) for o in all_[len(bad) : -3]] == [{"content": [text("KEY <SECRET_1>")], "meta": {"password": "<SECRET_1>"}}, {}, {"content": []}, {"content": [{"type": "resource_link", "uri": "v", "data": "scanned <SECRET_1>"}]}]
    passing = outcomes(spark, "tool_result", [{"content": [image, text("x")]}, {"content": [audio]}, {"content": [blob]}, {"content": [text("x", more={"blob": TOKEN, "data": TOKEN})]}], Strict(binary="pass"))
    assert json.loads(passing[0]["value"]) == {"content": [image, text("x")]} and list(json.loads(passing[0]["value"])["content"][0]) == ["type", "data", "mimeType"] and passing[1]["reason"] == "unsupported_value"
    assert json.loads(passing[2]["value"])["content"][0] == {"type": "resource", "resource": {"uri": "u <SECRET_1>", "blob": "AA"}, "note": "n"}
    assert json.loads(passing[3]["value"])["content"][0]["more"] == {"blob": "<SECRET_1>", "data": "<SECRET_1>"}
    assert [shown(o)[0] for o in outcomes(spark, "tool_arguments", [{"a": {"api_key": 1, "b": "x"}}, [1], {TOKEN: 1}])] == ["ok", "blocked", "blocked"]
    with pytest.raises(TypeError):
        Strict(binary="keep")
    seen = []
    calls = spark.createDataFrame([(1, json.dumps({"password": LONG})), (2, json.dumps({TOKEN: 1})), (3, None), (4, '{"fail":1}')], "id int, arguments string")

    def tool(df):
        seen.extend(sorted((r["id"], r["arguments"]) for r in df.collect()))
        return df.withColumn("result", F.when(F.col("id") != 4, F.lit(json.dumps({"content": [text(TOKEN)]}))))

    got = {x["id"]: (x["o"]["outcome"], x["fg_stage"]) for x in call_tools(calls, tool).collect()}
    assert got == {1: ("ok", "result"), 2: ("blocked", "arguments"), 3: ("ok", "result"), 4: ("tool_error", "result")} and [i for i, _ in seen] == [1, 3, 4] and seen[0][1] == '{"password":"<SECRET_1>"}'


def test_resources(spark):
    read = lambda **c: {"contents": [c]}
    bad = [read(uri="u"), read(uri="u", text="x", blob="AA"), read(uri="u", text=7), read(uri="u", blob="AA"), {}, {"contents": "x"}, {"contents": ["x"]}, []]
    got = outcomes(spark, "resource_result", [*bad, read(uri="f://" + TOKEN, text="KEY " + TOKEN)], label="resource")
    assert [o["reason"] for o in got[:-1]] == ["unsupported_value"] * len(bad) and json.loads(got[-1]["value"]) == read(uri="f://<SECRET_1>", text="KEY <SECRET_1>")
    assert json.loads(outcomes(spark, "resource_result", [read(uri="u", blob=TOKEN)], Strict(binary="pass"))[0]["value"]) == read(uri="u", blob=TOKEN)


def test_options_and_factories(spark):
    assert with_default_limits({})["limits"]["max_depth"] == 16 and with_default_limits({"limits": None})["limits"] is None
    for bad in ({"ruleset": "x"}, {"scan_limits": {}}, {"scan_config": 1}, {"limits": None}, {"limits": {"max_depth": 1}}, {"limits": {**LIMITS, "max_nodes": 0}}, {"incremental": {}}, {"evaluate": 7}, {"evaluate": len, "rules": ((("x",), "warn"),)}):
        with pytest.raises(OptionsError) as e:
            create_strict(**bad)
        assert TOKEN not in str(e.value)
    assert create_strict(raising).failure == "INITIALIZATION_FAILED" and create_strict(None, binary="pass").binary == "pass"
    assert check_ready(spark)["status"] == "ready" and check_ready(spark, raising)["status"] == "activation_failed" and check_ready(spark, limits={"max_depth": 1})["status"] == "limits_invalid"
    assert check_ready(spark, ruleset="x")["status"] == "options_rejected" and check_ready(spark, evaluate=raising) == {"status": "probe_failed", "stage": "probe", "code": "POLICY_FAILURE"}
    assert is_strict_limits({"max_depth": 1, "max_nodes": 0}) and not any(map(is_strict_limits, ({"max_depth": 1}, {"max_depth": -1, "max_nodes": 1}, {"max_depth": 1.5, "max_nodes": 1}, {"max_depth": True, "max_nodes": 1}, None)))
    # scan options: checked once, bound, never beside loose ones
    doc = {"actionPolicyRevision": 1, "base": "default", "rules": []}
    snap = snapshot_action_policy(doc)
    doc["rules"].append(7)
    assert snap == snapshot_action_policy(snap) and "7" not in snap and snapshot_action_policy(bytearray(b"x")) == b"x"
    c = resolve_scan_config({"scan_limits": {"max_findings": 2}, "pii": True, "host_option": 1})
    assert (c.max_findings, c.pii) == (2, True) and scan_config_of({"scan_config": c}) is c
    assert bind_scan_config({"pii": True, "name": "x"})["name"] == "x" and "pii" not in bind_scan_config({"pii": True})
    for bad in ({"scan_config": c, "pii": True}, {"scan_config": {}}):
        with pytest.raises(TypeError):
            scan_config_of(bad)
    for bad in ({"policy": 7}, {"action_policy": 7}, {"action_policy": "x"}, {"ruleset": 7}, {"ruleset": "x"}, {"scan_limits": {"max_findings": 0}}, {"scan_limits": {"other": 1}}, {"policy": len, "action_policy": snap}):
        with pytest.raises(OptionsError):
            resolve_scan_config(bad)
    verify_scan_options(spark, ScanConfig())
    with pytest.raises(OptionsError) as e:
        verify_scan_options(spark, ScanConfig(rules=((("x",), "warn"),)), "3.4.0")
    assert e.value.code == "CORE_OPTION_UNSUPPORTED"


def test_live_hosts(spark, tmp_path):
    from fieldguard.session import Sanitizer

    spark.conf.unset("spark.fieldguard.activation")
    s = Sanitizer(spark, limits={"max_string_length": 100})
    df = spark.createDataFrame([("KEY " + TOKEN, "x" * 101)], "a string, b string")
    row = s.mask_secrets(df, outcome="o").first()
    assert (row["a"], row["b"]) == ("KEY <SECRET_1>", "[REDACTED:LIMIT_EXCEEDED]") and row["o"]["counts"]["limited"] == 1
    assert s.sanitize(df, "text", F.get(F.split(F.to_json(F.struct("a")), "[:}]"), F.lit(1))).first()["o"]["value"] == '"KEY <SECRET_1>"' and s.sanitize_column(df, "a").first()["a"] == "KEY <SECRET_1>"
    for ignored in ({"evaluate": raising}, {"rules": ((("x",), "block"),)}, {"pii": True}):
        with pytest.raises(OptionsError):
            s.strict(**ignored)
    assert s.redact_otel_logs(df.select(F.col("a").alias("body"))).first()["body"] == "KEY <SECRET_1>"
    (tmp_path / "l.txt").write_text('{"k":"' + TOKEN + '"}\nno json\n')
    assert [r[0] for r in s.read_lines(str(tmp_path / "l.txt")).collect()] == ['{"k":"<SECRET_1>"}', '{"msg":"[REDACTED:ERROR]"}']
    got = []
    s.sink(lambda f, epoch: got.extend(r["value"] for r in f.collect()), lambda f: f.withColumn("value", F.concat("value", F.lit(" "))))(spark.createDataFrame([('{"k":"' + TOKEN + '"}',)], "value string"), 0)
    broken = F.udf(raising)
    for host in (raising, lambda f: None, lambda f: f.withColumn("value", broken("value"))):
        s.sink(lambda f, epoch: got.extend(r["value"] for r in f.collect()), host)(spark.createDataFrame([('{"k":"' + TOKEN + '"}',)], "value string"), 1)
    assert got == ['{"k":"<SECRET_1>"} '] + ['{"k":"<SECRET_1>"}'] * 3
    with pytest.raises(OptionsError):
        Sanitizer(spark, policy=lambda kind, confidence: kind.nonsense())
    spark.conf.unset("spark.fieldguard.activation")


def test_processor_lifecycle(spark):
    from fieldguard.plans.hosts import redact_otel_logs
    from fieldguard.sources.processor import RedactingProcessor

    class Exporter:
        def __init__(self):
            self.rows, self.calls = [], []

        def __call__(self, batch, epoch):
            self.rows += [r["body"] for r in batch.collect()]

        def flush(self):
            self.calls.append("flush")

        def shutdown(self):
            self.calls.append("shutdown")

    out, seen = Exporter(), []

    def transform(batch):
        masked = redact_otel_logs(batch, outcome="outcome")
        return masked.withColumn("outcome", masked["outcome"].withField("dropped", masked["body"] == "odd"))

    p = RedactingProcessor(transform, out, lambda *a: seen.append(a) or raising())
    batch = spark.createDataFrame([("a " + TOKEN,), ("odd",)], "body string")
    with pytest.warns(UserWarning):
        p(batch, 0)
    p.force_flush()
    assert p.enabled and out.rows == ["a <SECRET_1>"] and seen[0][:3] == (0, 2, 1) and seen[0][3]["redacted"] == 1
    p.shutdown(), p.shutdown(), p.force_flush(), p(batch, 1)
    assert not p.enabled and out.calls == ["flush", "shutdown"] and len(out.rows) == 1
    with pytest.raises(TypeError):
        RedactingProcessor(None, out)


def test_read_back(spark):
    from fieldguard.plans.readback import checked

    schema = "k int, t string, a array<string>, m map<string,string>, s struct<x:string,n:int>"
    mine = (1, "text", ["a", "b"], {"p": "q", "r": "s"}, ("x", 1))
    others = [mine, (1, "te", ["a"], {"p": "q"}, ("x", 1)), (1, "Text", ["a", "b"], {"p": "q", "r": "s"}, ("x", 1)), (1, "text", ["b", "a"], {"p": "q", "r": "s"}, ("x", 1)), (1, "text", ["a", "b"], {"p": "q", "z": "s"}, ("x", 1)), (1, "text", ["a", "b"], {"p": "q", "r": "s"}, ("x", 2)), (1, None, ["a", "b"], {"p": "q", "r": "s"}, ("x", 1)), (2, "text", ["a", "b"], {"p": "q", "r": "s"}, ("x", 1))]
    released = spark.createDataFrame([mine], schema)
    for truncated, want in ((False, [False] + [True] * 7), (True, [False, False] + [True] * 6)):
        got = [checked(released, spark.createDataFrame([w], schema), "k", "t", "a", "m", "s", truncated=truncated).first()["dropped"] for w in others]
        assert got == want


def test_the_engine_works_without_the_corpus_operators(tmp_path):
    root = os.path.dirname(os.path.dirname(os.path.abspath(__file__)))
    copy = tmp_path / "repo"
    shutil.copytree(root, copy, ignore=shutil.ignore_patterns(".git", "llm", "corpus_pipeline.py", "__pycache__", ".pytest_cache"))
    code = "import __spark_entry__ as e; q = e.queries(); assert len(q) > 90 and set(e.oracle_sql()) == set(q) and not any(n[:2] == 'op' and n[2].isdigit() for n in q) and 'pipeline' not in q"
    subprocess.run([sys.executable, "-c", code], cwd=copy, check=True, env={**os.environ, "PYTHONPATH": ""})
