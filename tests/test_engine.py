"""The scanner, leaves, walkers, configuration and streams on small cases."""

import json
import random

import pytest
from pyspark.sql import functions as F

from fieldguard.activation import ActivationError, activate
from fieldguard.config import OptionsError, ScanConfig, parse_policy, parse_ruleset
from fieldguard.constants import BLOCKED, ERROR, ERROR_LINE, LIMIT, LIMIT_LINE, WALK_LIMITS, resolve_limit
from fieldguard.functions.arrays import running
from fieldguard.functions.leaf import mask_leaf, mask_leaf_outcome
from fieldguard.functions.scanner import scan
from fieldguard.operators.budget import charge, first_of_text, observe_counts
from fieldguard.operators.json_walk import mask_json
from fieldguard.operators.lines import redact_lines
from fieldguard.operators.walk import Walk, mask_columns

TOKEN = "gh" + "p_" + "SYNTHETICREVOKED0" + "A" * 19
PEM = "-----BEGIN " + "PRIVATE KEY-----\nabcd\n-----END " + "PRIVATE KEY-----"
#: text, rewritten text, (type, confidence, action, start, end) of each finding
CASES = [
    ("API_KEY=" + TOKEN, "API_KEY=<SECRET_1>", [("github_token", "high", "redact", 8, 48)]),
    ("secret=SECRET01", "secret=SECRET01", [("contextual_secret", "medium", "warn", 7, 15)]),
    ("password=hunter2hunter2", "password=hunter2hunter2", [("contextual_secret", "medium", "warn", 9, 23)]),
    ('{"password":"synthetic-not-a-secret"}', '{"password":"<SECRET_1>"}', [("contextual_secret", "high", "redact", 13, 35)]),
    ("token=op://vault/item/field", "token=op://vault/item/field", []),
    ("api_key={{ template }} password=${VAR}", "api_key={{ template }} password=${VAR}", []),
    ("api_key=<your-api-key> secret=******** token=<SECRET_1>", "api_key=<your-api-key> secret=******** token=<SECRET_1>", []),
    ("token_count=12345678901 password_policy=abcdefghijk csrf_token=abcdefghijk", "token_count=12345678901 password_policy=abcdefghijk csrf_token=abcdefghijk", []),
    ("api_key=<rsv_" + "0" * 32 + ">", "api_key=<rsv_" + "0" * 32 + ">", []),
    (f"a {TOKEN} b {TOKEN}", "a <SECRET_1> b <SECRET_2>", [("github_token", "high", "redact", 2, 42), ("github_token", "high", "redact", 45, 85)]),
    (PEM, PEM, [("private_key", "high", "block", 0, len(PEM))]),
    ("é" * 3 + " token=" + "z" * 20, "é" * 3 + " token=<SECRET_1>", [("contextual_secret", "high", "redact", 10, 30)]),
    ("", "", []),
]


def texts(spark, *values):
    return spark.createDataFrame([(i, t) for i, t in enumerate(values)], "i int, t string")


def scanned(spark, text, config=ScanConfig(), **options):
    return texts(spark, text).select(scan(F.col("t"), config, **options).alias("s")).first()["s"]


def test_scan(spark):
    df = spark.createDataFrame([(i, t) for i, (t, _, _) in enumerate(CASES)] + [(99, None)], "i int, t string")
    rows = {r["i"]: r["s"] for r in df.select("i", scan(F.col("t")).alias("s")).collect()}
    assert rows[99] is None
    for i, (_, out, found) in enumerate(CASES):
        assert rows[i]["text"] == out and rows[i]["code"] is None
        assert [(f["type"], f["confidence"], f["action"], f["start"], f["end"]) for f in rows[i]["findings"]] == found
        assert [f["id"] for f in rows[i]["findings"]] == [f"finding-{n + 1}" for n in range(len(found))]


def test_texts_that_hold_the_signs_a_text_is_cut_by(spark):
    s = scanned(spark, f"a\x00 {TOKEN}\x00b\x01 {TOKEN}\x00")
    assert s["text"] == "a\x00 <SECRET_1>\x00b\x01 <SECRET_2>\x00" and [(f["start"], f["end"]) for f in s["findings"]] == [(3, 43), (47, 87)]


def test_running_sums(spark):
    for n in (0, 1, 63, 64, 65, 200, 5000):
        v = [(i * 7) % 11 for i in range(n)]
        got = spark.createDataFrame([(v,)], "v array<bigint>").select(running(F.col("v"))).first()[0]
        assert got == [sum(v[:i]) for i in range(n)] if n < 300 else got[-1] == sum(v[:-1])


def test_many_matches_in_one_text(spark):
    """Places, numbers and texts of thousands of matches, beyond the block of the running sums."""
    n = 3000
    s = scanned(spark, f"key {TOKEN} " * n)
    assert s["text"] == "".join(f"key <SECRET_{i}> " for i in range(1, n + 1)) and len(s["findings"]) == n
    assert all((f["start"], f["id"]) == (i * 45 + 4, f"finding-{i + 1}") for i, f in enumerate(s["findings"]))


def test_callables_are_asked_once_for_each_kind(spark):
    """Python's policies and formatters when the plan is made; what they raise, and what is no action, is a code."""
    def fail(*_):
        raise RuntimeError("never read")

    for config, text, code in (
        (ScanConfig(evaluate=lambda f: "warn" if f.type == "github_token" else "redact"), TOKEN, None), (ScanConfig(evaluate=fail), None, "POLICY_FAILURE"), (ScanConfig(evaluate=lambda f: "drop"), None, "INVALID_POLICY_ACTION"),
        (ScanConfig(formatter=fail), None, "PLACEHOLDER_FAILURE"), (ScanConfig(formatter=lambda f, n: 7), None, "INVALID_PLACEHOLDER"), (ScanConfig(formatter=lambda f, n: f"[{n}]"), None, "INVALID_PLACEHOLDER"),
        (ScanConfig(formatter=lambda f, n: F.concat(F.lit(f"[{f.type}#"), n, F.lit("]"))), "[github_token#1]", None), (ScanConfig(policy=lambda k, c: F.lit("nothing")), None, "INVALID_POLICY_ACTION"),
    ):
        s = scanned(spark, TOKEN, config)
        assert (s["text"], s["code"]) == (text, code)
        m = texts(spark, TOKEN, "clean").select(mask_leaf_outcome(F.col("t"), None, config).alias("m")).collect()
        assert m[0]["m"]["outcome"] == ("failed" if code else "unchanged" if text == TOKEN else "redacted") and m[1]["m"]["outcome"] == "unchanged"


def test_email_needs_its_switch_and_a_context_word(spark):
    df = spark.createDataFrame([("customer email: a.b@example.com",), ("see a.b@example.com",)], "t string")
    on = [r[0] for r in df.select(scan(F.col("t"), ScanConfig(pii=True))["text"]).collect()]
    assert on == ["customer email: <SECRET_1>", "see a.b@example.com"]
    assert df.select(scan(F.col("t"))["text"].alias("x")).where("x like '%SECRET%'").count() == 0


def test_leaf_outcomes_and_key_context(spark):
    rows = [("client_secret", "가나다라마바사아자차카타파하거너"), ("password", "short"), ("name", "synthetic prose of some length"), ("password", "synthetic prose of some length"), (None, PEM), ("k", "x" * 31), ("k", None)]
    df = spark.createDataFrame(rows, "k string, t string")
    got = [r[0] and tuple(r[0]) for r in df.select(mask_leaf_outcome(F.col("t"), F.col("k"), max_string_length=200).alias("m")).collect()]
    assert got == [("<SECRET_1>", "redacted", 1), ("short", "unchanged", 0), (rows[2][1], "unchanged", 0), ("<SECRET_1>", "redacted", 1), (BLOCKED, "blocked", 1), ("x" * 31, "unchanged", 0), None]
    assert df.select(mask_leaf_outcome(F.col("t"), max_string_length=4).alias("m")).where("m.outcome = 'limited'").count() == 6


def test_planted_tokens_never_survive(spark):
    r = random.Random(7)
    pool = "ab =:\"'{}<>$\n\t-_/\\é日😀\x00\x01token passwordgh"
    noise = lambda: "".join(r.choice(pool) for _ in range(r.randint(0, 40)))
    rows = [f"{noise()} {TOKEN} {noise()}" for _ in range(400)]
    once = texts(spark, *rows).select("t", mask_leaf_outcome(F.col("t")).alias("m")).cache()
    assert all(TOKEN not in x["m"]["text"] and x["m"]["outcome"] in ("redacted", "blocked") for x in once.collect())
    assert once.where(mask_leaf(F.col("m.text")) != F.col("m.text")).count() == 0


def test_policies_and_rulesets(spark):
    doc = {"actionPolicyRevision": 1, "base": "default", "rules": [{"id": "a", "match": {"type": ["github_token"]}, "action": "warn"}, {"id": "b", "match": {"type": ["github_token"]}, "action": "block"}]}
    assert parse_policy(doc) == parse_policy(json.dumps(doc)) == parse_policy(json.dumps(doc).encode()) == ((("github_token",), "warn"), (("github_token",), "block"))
    assert scanned(spark, TOKEN, ScanConfig(rules=parse_policy(doc)))["text"] == TOKEN
    for bad in ({**doc, "actionPolicyRevision": 2}, {**doc, "x": 1}, "nonsense", {**doc, "rules": [{"id": "a", "match": {"detector": []}, "action": "warn"}]}):
        with pytest.raises(OptionsError) as e:
            parse_policy(bad)
        assert e.value.core_code == "INVALID_ACTION_POLICY" and "nonsense" not in str(e.value)
    text = 'ruleset-revision: 1\ndetector: own\nspecificity: contextual\nprefix: "{}"\nalphabet: {}\nrun: at-least {}\nvalidator: none\n'
    own = ScanConfig(ruleset=parse_ruleset(text.format("gh" + "p_", "alnum", 10)))
    assert [f["type"] for t in (TOKEN, "gh" + "p_" + "a" * 12) for f in scanned(spark, t, own)["findings"]] == ["github_token", "own"]
    for alphabet, body in (("alnum", "aZ9"), ("alnum-dash", "a-9"), ("hex", "0af"), ("digits", "123")):
        c = ScanConfig(ruleset=parse_ruleset(text.format("ID-", alphabet, 6)))
        assert [(f["type"], f["confidence"], f["action"]) for f in scanned(spark, "x ID-" + body * 2 + " y", c)["findings"]] == [("own", "medium", "warn")]
        assert not scanned(spark, "x ID-" + body + " y", c)["findings"]
    with pytest.raises(OptionsError):
        parse_ruleset("ruleset-revision: 1\nBROKEN\n")
    with pytest.raises(OptionsError):
        ScanConfig(policy=lambda k, c: c, rules=parse_policy(doc))


def test_limits_and_budgets(spark):
    assert [resolve_limit(v, 7) for v in (3, 0, -1, True, None, float("nan"), "3")] == [3, 0, 7, 7, 7, 7, 7]
    r = random.Random(2)
    rows = [(op, i * 3, r.randint(0, 9)) for op, n in (("big", 500), ("small", 7), (None, 30)) for i in range(n)]
    df = spark.createDataFrame(rows, "op string, at long, cost long")
    want = {}
    for op, at, cost in rows:
        want[op, at] = want.get((op, at - 3), 0) + cost
    for most in (10, 100, 10_000):  # ranges of one operation, and operations as they are
        got = {(x["op"], x["at"]): (x["used_bytes"], x["allowed"]) for x in charge(df, "op", "at", {"bytes": F.col("cost")}, {"max_bytes": 50}, rows=most).collect()}
        assert got == {k: (v, v <= 50) for k, v in want.items()}
    same = spark.createDataFrame([(1, 0, "a"), (1, 1, "a"), (1, 2, "b"), (2, 5, "a"), (1, 3, "x" * 2000), (1, 4, "x" * 2000), (1, 5, "c"), (1, 6, "c")], "op int, at int, t string")
    assert [x["scanned"] for x in first_of_text(same, "op", "at", "t").orderBy("op", "at").collect()] == [True, False, True, True, True, True, False, True]
    assert [x["scanned"] for x in first_of_text(same, "op", "at", "t", most=2).orderBy("op", "at").collect()] == [True, False, True, True, True, True, True, True]


def walked(spark, value, operation=None, **limits):
    df = spark.createDataFrame([(json.dumps(value),)], "v string")
    x = mask_json(df, "v", limits=limits, operation=operation, outcome="o").first()
    return json.loads(x["v"]), x["o"]["counts"].asDict()


def test_permissive_walk(spark):
    v = {"msg": "a " + TOKEN, "api_key": "x" * 20, "list": ["b", {"password": "y" * 20}], "n": 1.5, "none": None}
    out, counts = walked(spark, v)
    assert out == {"msg": "a <SECRET_1>", "api_key": "<SECRET_1>", "list": ["b", {"password": "<SECRET_1>"}], "n": 1.5, "none": None}
    assert counts == {"scanned": 4, "findings": 3, "redacted": 3, "blocked": 0, "limited": 0, "failed": 0}
    assert walked(spark, [[["x"]]], max_depth=2)[0] == [[LIMIT]]
    assert walked(spark, {"a": "1", "b": {"x": 1}, "c": "3"}, max_object_keys=1)[0] == {"a": "1"}
    assert walked(spark, ["a", "b", "c"], max_array_length=2)[0] == ["a", "b"]
    assert walked(spark, [["a"], {"k": ["b", {}]}, 1, "c"], max_array_length=2)[0] == [["a"], {"k": ["b", {}]}]
    for limits, operation in (({"max_total_leaves": 2}, None), ({"max_nodes": 3}, None), ({}, {"max_leaves": 2}), ({}, {"max_nodes": 3}), ({}, {"max_scans": 2}), ({}, {"max_bytes": 2})):
        assert walked(spark, ["a", "b", "c"], operation, **limits)[0] == ["a", "b", LIMIT]
    assert walked(spark, {"k": "x"}, {"max_scans": 1})[0] == {"k": LIMIT}  # its view is a second scan
    assert walked(spark, list(range(2000)))[0] == list(range(1000)) and WALK_LIMITS["max_depth"] == 8
    df = spark.createDataFrame([('{"b":"1","api_key":"' + "x" * 20 + '"}',), ("no json",), (None,), ("[1] 2",)], "j string")
    assert [r[0] for r in mask_json(df, "j").collect()] == ['{"b":"1","api_key":"<SECRET_1>"}', f'"{ERROR}"', None, f'"{ERROR}"']


def test_typed_walk_equals_the_walk_of_json(spark):
    """The walk compiled from a schema against the walk of the same values as JSON: values, counts and usage."""
    r = random.Random(3)
    text = lambda: r.choice(["plain", TOKEN, "password=hunter2hunter2", "x" * 20, "short", "a " + TOKEN + " b " + TOKEN, PEM, "é"])
    rows = [(i, {"name": text(), "password": text(), "n": i, "tags": [text() for _ in range(r.randint(0, 4))], "bag": {f"k{k}": text() for k in range(r.randint(0, 3))} | {"api_key": text()}, "inner": [{"secret": text(), "deep": {"note": text()}} for _ in range(r.randint(0, 3))]}) for i in range(60)]
    schema = "i int, v struct<name:string,password:string,n:int,tags:array<string>,bag:map<string,string>,inner:array<struct<secret:string,deep:struct<note:string>>>>"
    df = spark.createDataFrame(rows, schema).withColumn("j", F.to_json("v"))
    for limits, operation in ((None, None), ({"max_total_leaves": 6}, None), ({"max_nodes": 9}, None), (None, {"max_scans": 9}), (None, {"max_bytes": 200}), (None, {"max_findings": 3}), (None, {"max_keys": 5})):
        typed = mask_columns(df, "v", walk=Walk(limits=limits, operation=operation), keyed=False, outcome="o")
        loose = mask_json(typed.withColumnRenamed("o", "mine"), "j", limits=limits, operation=operation, outcome="theirs")
        for x in loose.collect():
            assert x["v"].asDict(True) == json.loads(x["j"]) and x["mine"]["counts"] == x["theirs"]["counts"]
            assert limits or operation or x["mine"]["usage"] == x["theirs"]["usage"]  # a key is an event of its own in JSON


def test_clean_rows_take_the_short_way_to_the_same_end(spark):
    """With an outcome every row is taken apart; without one clean rows aren't: the columns are the same, also near limits."""
    r = random.Random(8)
    text = lambda: r.choice(["plain", "other words", "short", None, "12345678", "x" * 30, TOKEN if r.random() < 0.2 else "y"])
    value = lambda i: {"name": text(), "password": r.choice(["s", text()]), "n": i, "tags": r.choice([None, [text() for _ in range(r.randint(0, 5))]]), "bag": {f"k{k}": text() for k in range(r.randint(0, 4))}, "inner": [{"secret": r.choice(["s", text()]), "more": {"a": text()}} for _ in range(r.randint(0, 3))]}
    schema = "i int, v struct<name:string,password:string,n:int,tags:array<string>,bag:map<string,string>,inner:array<struct<secret:string,more:map<string,string>>>>, api_key string"
    df = spark.createDataFrame([(i, value(i), text()) for i in range(150)] + [(900, None, None)], schema).repartition(2).cache()
    some = ((None, None), ({"max_array_length": 3}, None), ({"max_object_keys": 6}, None), ({"max_total_leaves": 7}, None), ({"max_nodes": 12}, None), ({"max_string_length": 20}, None), ({"max_depth": 2}, None), (None, {"max_scans": 14}), (None, {"max_keys": 9}), (None, {"max_bytes": 300}))
    for n, (limits, operation) in enumerate(some):
        walk = Walk(ScanConfig(max_input_bytes=60 if n % 2 else None), limits, operation=operation)
        for names in (("v", "api_key"),):
            short, long_ = (mask_columns(df, *names, walk=walk, outcome=o).select("i", *names) for o in (None, "o"))
            assert sorted(map(repr, short.collect())) == sorted(map(repr, long_.collect()))


def test_types_that_cannot_be_masked_are_refused(spark):
    df = spark.sql("select parse_json('{\"a\":\"x\"}') as v, 1 as n")
    with pytest.raises(TypeError):
        mask_columns(df, "v")
    with pytest.raises(TypeError):
        mask_columns(df.select(F.array("v").alias("v")), "v")


def test_long_and_repetitive_texts(spark):
    """Texts that make backtracking patterns recurse or take their square: they come through, masked."""
    big = ["a@" + "b." * 20_000 + "com", "x@" * 50_000, "token=" * 30_000, "-----BEGIN " * 20_000, ("-----BEGIN PRIVATE KEY-----\n" + "A" * 60 + "\n") * 3000, "eyJ" + "a" * 200_000, "token:" + " " * 200_000, '"' * 150_000, "\\" * 199_999]
    df = spark.createDataFrame([(i, t + " " + TOKEN) for i, t in enumerate(big)], "i int, t string")
    for config in (ScanConfig(), ScanConfig(pii=True)):
        got = {r["i"]: r["t"] for r in df.select("i", scan(F.col("t"), config)["text"].alias("t")).collect()}
        for i, t in enumerate(big):
            assert TOKEN not in got[i] and len(got[i]) > 9, i
    line = df.select("i", F.to_json(F.struct("t")).alias("l"))
    assert all(TOKEN not in r["l"] for r in redact_lines(line, "l").collect())


def lined(spark, text, **options):
    return redact_lines(spark.createDataFrame([(text,)], "line string"), **options).first()["line"]


def test_json_lines(spark):
    lines = ['{"a":"\\u0041","password":"' + "q" * 16 + '"}\n', "not json\n", '{"a":1} x', '{"k" : "' + TOKEN + '" , "e":"\\"q\\""}', None, "1][2", "1,2", '{"a":1}{"b":2}', '"a":1']
    got = [r[0] for r in redact_lines(spark.createDataFrame([(x,) for x in lines], "l string"), "l").collect()]
    assert got == ['{"a":"\\u0041","password":"<SECRET_1>"}\n', ERROR_LINE + "\n", ERROR_LINE, '{"k" : "<SECRET_1>" , "e":"\\"q\\""}', None] + [ERROR_LINE] * 4
    assert lined(spark, "[" * 100_000 + "]" * 100_000) == ERROR_LINE and lined(spark, '["x","y"]', walk={"max_array_length": 1}) == f'["x","{LIMIT}"]'
    assert lined(spark, '["x","y"]\n', limits={"max_spans": 1}) == LIMIT_LINE + "\n" == lined(spark, '["x","y"]\n', limits={"max_decode": 5})
    many = "[" + ",".join(f'{{"k{i}":"{TOKEN}","n":[{i}]}}' for i in range(400)) + "]"
    assert lined(spark, many) == many.replace(TOKEN, "<SECRET_1>")
    df = spark.createDataFrame([('["x","y"]',)], "line string").withColumn("spent", F.struct(*[F.lit(2 if u == "leaves" else 0).cast("long").alias(u) for u in ("nodes", "keys", "leaves", "scans", "bytes", "findings")]))
    x = redact_lines(df, walk=Walk(operation={"max_leaves": 3}), before="spent", outcome="o").first()
    assert x["line"] == f'["x","{LIMIT}"]' and x["o"]["counts"]["limited"] == 1 and x["o"]["usage"]["leaves"] == 3


def test_a_filter_on_what_is_masked_does_not_repeat_the_plan(spark):
    df = redact_lines(spark.createDataFrame([('{"a":"' + TOKEN + '"}',)], "line string"), outcome="o").where("line like '%SECRET%' and o.counts.redacted = 1")
    assert df._jdf.queryExecution().optimizedPlan().toString().count("regexp_extract_all") + df._jdf.queryExecution().optimizedPlan().toString().count("from_json") < 60 and df.count() == 1


def test_observation(spark):
    df = spark.createDataFrame([("a " + TOKEN,), ("b",)], "t string").select(mask_leaf_outcome(F.col("t")).alias("m"))
    out, seen = observe_counts(df, "m")
    out.collect()
    assert seen.get["scanned"] == 2 and seen.get["redacted"] == 1


def test_activation(spark):
    spark.conf.unset("spark.fieldguard.activation")
    assert activate(spark).endswith("selectors=off")
    one = activate(spark, ["pii:global"])
    assert activate(spark) == one == activate(spark, ["pii:global"])
    with pytest.raises(ActivationError):
        activate(spark, ["pii:other"])
    spark.conf.unset("spark.fieldguard.activation")


def test_streams_release_whole_or_nothing(spark, tmp_path):
    """Every cut of a text gives what the whole text gives, chunks arriving out of order over several batches."""
    from fieldguard.streaming.staged import staged

    text = "key API_KEY=" + TOKEN + " end"
    rows = []
    for s, cut in enumerate((1, 20, len(text))):
        parts = [text[i : i + cut] for i in range(0, len(text), cut)]
        rows += [(s, i, "append", p) for i, p in enumerate(parts)] + [(s, len(parts), "finalize", None)]
    rows += [(9, 0, "append", "x"), (9, 1, "abort", None), (8, 0, "append", PEM), (8, 1, "finalize", None)]
    rows = rows[::-1]
    src = tmp_path / "in"
    for i in range(2):
        spark.createDataFrame(rows[i::2], "stream_id long, seq long, op string, chunk string").coalesce(1).write.mode("append").parquet(str(src))
    stream = spark.readStream.schema("stream_id long, seq long, op string, chunk string").option("maxFilesPerTrigger", 1).parquet(str(src))
    q = staged(stream).writeStream.format("memory").queryName("staged").outputMode("append").option("checkpointLocation", str(tmp_path / "c")).trigger(availableNow=True).start()
    q.awaitTermination(30)
    q.stop()
    got = {r["stream_id"]: (r["outcome"], r["value"], r["reason"]) for r in spark.table("staged").collect()}
    assert got == {**{s: ("ok", "key API_KEY=<SECRET_1> end", None) for s in range(3)}, 9: ("aborted", None, None), 8: ("blocked", None, "policy")}
