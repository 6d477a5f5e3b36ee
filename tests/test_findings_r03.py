"""Small cases of the third round's findings."""

import pytest
from pyspark.sql import functions as F

from fieldguard.functions.arrays import fence
from fieldguard.operators.strict import Strict, sanitize_column
from fieldguard.plans.strict import sanitize

TOKEN = "gh" + "p_" + "SYNTHETICREVOKED0" + "A" * 19


def optimized(df):
    return df._jdf.queryExecution().optimizedPlan().toString()


def test_a_filter_on_a_fenced_column_stays_above_it(spark):
    """the optimiser folds rand(0) >= 0, and then copies all steps into each filter on an outcome."""
    plan = optimized(spark.range(4).withColumn("o", fence(F.col("id") * 7)).where("o = 14").withColumn("p", F.col("o") + 1)).splitlines()
    assert any(line.lstrip("+- :").startswith("Filter") and "* 7" not in line for line in plan)
    df = spark.createDataFrame([(1, '{"a":"%s"}' % TOKEN)], "i int, v string")
    o = sanitize(df, "value", F.col("v"))
    shown = o.select("i", F.explode("o.emitted").alias("f")).where("f.boundary = 'user-input'")
    assert len(optimized(shown)) < 2 * len(optimized(o))
    assert [r["f"]["leafOrdinal"] for r in shown.collect()] == [0]


def test_lambdas_hold_no_list_of_branches(spark):
    """A CASE inside a lambda looks its branches up in a list for each value; calls of if don't."""
    from fieldguard.functions.arrays import apply, running

    body = "x -> CASE WHEN x = 'CASE' THEN 'a' WHEN x = 'it\\'s END' THEN CASE x WHEN 'q' THEN 'r' ELSE 'b' END WHEN x = 'n' THEN CASE WHEN x = 'm' THEN 'c' END ELSE 'd' END"
    df = spark.createDataFrame([("CASE",), ("it's END",), ("n",), ("z",)], "t string")
    assert [r[0] for r in df.select(apply(F.col("t"), body)).collect()] == ["a", "b", None, "d"]
    assert "CASE WHEN" not in optimized(df.select(apply(F.col("t"), "x -> CASE WHEN x = 'a' THEN 1 WHEN x = 'b' THEN 2 END").alias("o")))
    for n in (0, 1, 8, 9, 63, 65, 512, 513, 1500):
        got = spark.range(1).select(running(F.transform(F.sequence(F.lit(1), F.lit(n)), lambda k: k.cast("long")) if n else F.array().cast("array<bigint>")).alias("r")).first()["r"]
        assert got == [k * (k + 1) // 2 for k in range(n)]


def test_a_sample_of_vectors_is_chosen_before_it_is_sent(spark):
    """every task sent as many vectors to the driver as the whole sample has."""
    from fieldguard.llm.ann import hashed_sample

    good = spark.range(0, 40_000, 1, 40).select(F.col("id").alias("vec_id"), F.array(F.col("id").cast("double")).alias("v"))
    chosen = hashed_sample(good, 100)
    want = [r["vec_id"] for r in good.orderBy(F.xxhash64("vec_id"), "vec_id", "v").limit(100).collect()]
    assert [r["vec_id"] for r in chosen.collect()] == want
    test = next(line for line in optimized(chosen).splitlines() if "Filter" in line)
    assert "xxhash64" in test
    last = int(test.split("<= ")[1].split(")")[0])
    assert 100 <= good.where(F.shiftright(F.xxhash64("vec_id"), 52) <= last).count() < 200
    assert hashed_sample(good.limit(7), 100).count() == 7


def test_an_escape_in_a_literal_is_no_alternative_of_classes():
    """two classes were tried for each escape of a literal, which was most of the time of lines of a million characters."""
    from fieldguard.functions.json_text import LITERAL

    assert "[\\s\\S]" not in LITERAL and "(?s:.)" in LITERAL


def test_first_failure_by_the_bytes_of_the_text(spark, tmp_path):
    """texts of 1993 to 2000 bytes were over the limit with their key, which the SQL doesn't count."""
    from fieldguard.queries_strict import sanitize_first_failure

    docs = [(2 * n, "x" * n, "en", "a", n) for n in (1992, 1993, 1999, 2000, 2001)] + [(7, "\u00e9" * 1000, "en", "a", 1000), (5, "\u00e9" * 1000 + "x", "en", "a", 1001), (11, None, "en", "a", 0)]
    spark.createDataFrame(docs, "doc_id long, text string, lang string, source string, n_chars int").write.parquet(str(tmp_path / "documents.parquet"))
    got = {r["doc_id"]: (r["outcome"], r["reason"], r["code"]) for r in sanitize_first_failure(spark, str(tmp_path)).collect()}
    for i, text, *_ in docs:
        long_ = len((text or "").encode()) > 2000
        reason = "limit_exceeded" if long_ or i % 3 == 0 else "policy" if i % 2 == 0 else None
        assert got[i] == ("blocked" if reason else "ok", reason, "INPUT_LIMIT_EXCEEDED" if long_ else None), i


def test_chunks_are_cut_in_one_pass_and_dealt_once(spark):
    """F8: each chunk's substr counted its text from the start, and chunks were shuffled for their sums and again for their streams."""
    from fieldguard import workloads
    from fieldguard.plans import context

    texts = [(1, "a\U0001f600\né" * 9), (2, ""), (3, None), (4, "x" * 8), (5, "line\n" * 3 + "-----BEGIN " + "\r\n y")]
    chunks = workloads.stream_chunks(spark.createDataFrame(texts, "k long, t string"), F.col("t"), "k", 4)
    assert "substring" not in optimized(chunks)
    got = {}
    for r in sorted(chunks.collect(), key=lambda r: (r["stream_id"], r["seq"])):
        got.setdefault(r["stream_id"], []).append((r["seq"], r["op"], r["chunk"]))
    for k, t in texts:
        want = [t[i : i + 4] for i in range(0, len(t), 4)] if t else [t]
        assert got[k] == [(i, "append", c) for i, c in enumerate(want)] + [(len(want), "finalize", None)]
    streams = context.stream_batch(chunks, incremental=True)
    assert streams._jdf.queryExecution().executedPlan().toString().count("Exchange hashpartitioning") == 1
    assert {r["stream_id"]: (r["outcome"], r["value"]) for r in streams.collect()} == {k: ("ok", t) if t is not None else ("blocked", None) for k, t in texts}


def test_what_is_held_back_is_no_longer_in_the_state(spark):
    """F8: a line without an end was copied, chunk by chunk, with all of the state."""
    from fieldguard.plans.context import stream_batch

    def stream(k, *chunks):
        return [(k, i, "append", c) for i, c in enumerate(chunks)] + [(k, len(chunks), "finalize", None)]

    rows = stream(1, "ab", "cd", "e\nf", "g--", "---", "h", "i\n") + stream(2, *["abcd "] * 30) + stream(3, *["abcd "] * 5, "\n", *["abcd "] * 5) + stream(4, *["abcd"] * 12)
    df = spark.createDataFrame(rows, "stream_id long, seq long, op string, chunk string")
    got = {r["stream_id"]: (r["outcome"], r["value"], r["code"]) for r in stream_batch(df, incremental={"max_input_bytes": 1000, "max_buffered_bytes": 40, "max_token_bytes": 30, "max_multiline_bytes": 100}).collect()}
    assert got == {1: ("ok", "abcde\nfg-----hi\n", None), 2: ("blocked", None, "BUFFER_LIMIT_EXCEEDED"), 3: ("ok", "abcd " * 5 + "\n" + "abcd " * 5, None), 4: ("blocked", None, "TOKEN_LIMIT_EXCEEDED")}


def test_names_and_single_matches_make_no_lists(spark):
    """A name was an array of one whose body was copied, an IN ended by an exception, and one match went through the
    lists of many."""
    from fieldguard.config import ScanConfig
    from fieldguard.functions.arrays import apply, let
    from fieldguard.functions.scanner import scan

    df = spark.createDataFrame([("a %s b" % TOKEN,), ("%s %s" % (TOKEN, TOKEN),), ("x token=op://vault/item y",), ("x token=abcdefgh y",), (None,)], "t string")
    plan = optimized(df.select(apply(F.col("t"), "x -> " + let("y_", "upper(x)", "concat(y_, y_)")).alias("o")))
    assert "transform(" not in plan and "array_repeat" not in plan
    assert " IN (" not in optimized(df.select(scan(F.col("t")).alias("s")))
    got = [r["s"] and (r["s"]["text"], [(f["id"], f["type"], f["action"], f["start"], f["end"]) for f in r["s"]["findings"]], r["s"]["code"]) for r in df.select(scan(F.col("t")).alias("s")).collect()]
    one = lambda n, a: ("finding-%d" % n, "github_token", "redact", a, a + 40)
    assert got == [("a <SECRET_1> b", [one(1, 2)], None), ("<SECRET_1> <SECRET_2>", [one(1, 0), one(2, 41)], None), ("x token=op://vault/item y", [], None), ("x token=abcdefgh y", [("finding-1", "contextual_secret", "warn", 8, 16)], None), None]
    for config, code in ((ScanConfig(evaluate=lambda f: "drop"), "INVALID_POLICY_ACTION"), (ScanConfig(formatter=lambda f, n: 1 / 0), "PLACEHOLDER_FAILURE")):
        assert [(r["s"]["text"], r["s"]["code"]) for r in df.limit(2).select(scan(F.col("t"), config).alias("s")).collect()] == [(None, code)] * 2


def test_patterns_use_the_class_of_words(spark):
    """a list of ranges was gone through for each character of a text."""
    from fieldguard.functions.scanner import builtin_pack, scan, searched_for

    assert "[^A-Za-z0-9_]" in builtin_pack().pattern and "[^A-Za-z0-9_]" not in searched_for(builtin_pack())
    texts = ["_token=abcdefgh", "1token=abcdefgh", "étoken=abcdefgh", "token=abcdefgh", "-token=abcdefgh", "\ntoken=abcdefgh"]
    found = spark.createDataFrame([(t,) for t in texts], "t string").select(F.size(scan(F.col("t"))["findings"]).alias("n"))
    assert [r["n"] for r in found.collect()] == [0, 0, 1, 1, 1, 1]


def test_rows_rewritten_as_one_text_are_as_leaf_by_leaf(spark, monkeypatch):
    """Each leaf was cut and judged by itself, and maps and arrays of elements that may hold no
    text had all their charges summed up."""
    from fieldguard.operators import walk

    secret, short = "abcdefgh" * 3, "abcdefgh1"
    texts = [
        TOKEN, f"a {TOKEN} b {TOKEN}", f"password={secret}", f"password = \"{secret} x\" y", f"token: {short}", f"secret='{secret}", f"-token:={secret}", f"xtoken={secret}", f"\ntoken={secret}\nz", "plain", "", None, f"token=op://{secret}",
        f"eyJ{secret}.{secret}.{secret}", "-----BEGIN PRIVATE KEY-----\nabc\n-----END PRIVATE KEY-----", f"password=\"-----BEGIN PRIVATE KEY-----{secret}-----END PRIVATE KEY-----\"", f"\u0000{TOKEN}", f"{TOKEN}\u0004", f"\u0003{TOKEN}", f"\n\u0003\n{TOKEN}", "<SECRET_1>", f"😀token={'😀' * 15}", f"token={'😀' * 16}",
        f"secret={secret}<b", f"secret=\"{secret}", "password:", f"a\"b{TOKEN}", f"{secret}\"", secret,
    ]
    keys = ["api_key", "note", f"password={secret}", "a\"token", f"x {TOKEN}", "token\":\"password"]
    rows = [(i, {k: t, "n": "x"}, [t, "x", texts[i % len(texts)]], [({k: t},), ({},), (None,)], (t, (k,))) for i, (k, t) in enumerate((k, t) for k in keys for t in texts)]
    df = spark.createDataFrame(rows, "i int, m map<string,string>, a array<string>, l array<struct<o:map<string,string>>>, s struct<password:string,in:struct<b:string>>")

    def masked(w):
        out = walk.mask_row(df, *[walk.Target(c, c) for c in "mals"], walk=w, outcome="o")
        return out.select("i", F.to_json(F.struct("m", "a", "l", "s", "o")).alias("v")).orderBy("i").collect()

    for w in (walk.Walk(), walk.Walk(charge_nodes=False, charge_fields=False), walk.Walk(operation={"max_nodes": 30}), walk.Walk(operation={"max_keys": 3})):
        once = masked(w)
        monkeypatch.setattr(walk, "is_simple", lambda config: False)
        monkeypatch.setattr(walk.Shape, "bound", lambda *_: None)
        assert once == masked(w)
        monkeypatch.undo()
    ways = []
    leaves = walk.mask_leaves
    monkeypatch.setattr(walk, "mask_leaves", lambda *a, **k: ways.append(leaves(*a, **k)) or ways[-1])
    out = walk.mask_row(df.where("i = 0"), *[walk.Target(c, c) for c in "mals"], outcome="o")
    assert ways[0].select("fg_way").first()[0] == walk.ONCE and out.count() == 1


def test_strict_steps_count_without_a_lambda_for_each_event(spark):
    """kinds, findings and scanned texts of events were counted by lambdas, and findings placed where there were none."""
    from fieldguard.functions.scanner import builtin_pack, searched_for
    from fieldguard.operators import strict

    assert "lambda" not in optimized(spark.range(1).selectExpr("named_struct('e', array(named_struct('kind', string(id)))) x").selectExpr(f"{strict._of_kind('open', 'leaf')} n"))
    assert "(?=[DdCcAaPpSsTt])" in searched_for(builtin_pack())
    rows = [('["t1","t2","t1"]', "ok"), ('["t1","t2","t3"]', "blocked"), ('["%s"]' % TOKEN, "ok"), ('{"%s":1}' % TOKEN, "blocked"), ("[[1]]", "ok"), ("[]", "ok"), ("[" * 17 + "]" * 17, "blocked")]
    o = sanitize(spark.createDataFrame([(i, v) for i, (v, _) in enumerate(rows)], "i int, v string"), "value", F.col("v"), Strict(operation={"max_scans": 2}))
    got = {r["i"]: r["o"] for r in o.collect()}
    assert [got[i]["outcome"] for i in range(len(rows))] == [x for _, x in rows]
    assert [len(got[i]["emitted"]) for i in range(len(rows))] == [0, 0, 1, 1, 0, 0, 0] and got[2]["value"] == '["<SECRET_1>"]'
