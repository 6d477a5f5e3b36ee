"""Small cases of the fourth round's findings."""

import json

from pyspark.sql import functions as F

from fieldguard.config import ScanConfig
from fieldguard.functions.json_text import is_json, turns_of
from fieldguard.operators.lines import redact_lines

TOKEN = "gh" + "p_" + "SYNTHETICREVOKED0" + "A" * 19


def test_long_literals_have_the_results_of_any_others(spark):
    """a text of over 400,000 bytes was searched twice over, with its view, and then once more leaf by leaf. Searched from
    the first sign on it gives what a config does that knows no such way."""
    fill = ["x " * 3000, "\n" * 5000, "é " * 3000, "\u212a \u0130" * 2000, "gh api " * 800, "A" * 210_000]
    ends = [TOKEN, "password=abcdefghijklmnopqrst", "client_secret: 'abcdefgh", "db_Api_Key = abcdefghij, x", "no sign", "op://a token=op://abcdefgh", "to\u212aen=abcdefghijkl", "eyJ" + "a" * 9 + "." + "b" * 9 + "." + "c" * 9, "-----BEGIN PRIVATE KEY-----\nab\n-----END PRIVATE KEY-----", "token"]
    rows = []
    for f in fill:
        for e in ends:
            for key in ("a", "password", "x\" token", "tok"):
                rows += [json.dumps({key: f + e + " y"}, ensure_ascii=False), json.dumps({key: e + " " + f, "b": f + e})]
    df = spark.createDataFrame(list(enumerate(rows)), "i int, line string").repartition(8)
    wide = {"max_string_length": 1 << 21}
    m = redact_lines(df, walk=wide, outcome="o").collect()
    n = redact_lines(df, config=ScanConfig(max_findings=1 << 20), walk=wide, outcome="o").collect()
    assert {r["i"]: r for r in m} == {r["i"]: r for r in n}


def test_a_long_text_goes_the_way_of_short_ones(spark):
    """many bytes alone don't make a row's charges be summed up, which scanned each leaf by itself; many findings do."""
    from fieldguard.operators.walk import CHARGE, LEAVES, ONCE, SAME, Walk, mask_leaves

    texts = ["x\n" * 300_000 + TOKEN, "x\n" * 300_000, ("token=abcdefghijklmnopqrst " * 60_000), "token=abcdefghijklmnopqrst " * 20_000]
    df = spark.createDataFrame(list(enumerate(texts)), "i int, t string").repartition(4).withColumn("fg_l", F.expr(f"cast(array(named_struct('k', 'a', 't', t)) as {LEAVES})"))
    none = F.expr("cast(array() as array<struct<leaf:boolean,nodes:int,keys:int,limited:int,failed:int>>)")
    out = mask_leaves(df, none, Walk(limits={"max_string_length": 1 << 22}), (1, 1), False).select("i", "fg_way").collect()
    assert {r["i"]: r["fg_way"] for r in out} == {0: ONCE, 1: SAME, 2: CHARGE, 3: ONCE}


def test_the_turns_of_a_strict_line(spark):
    """each escape was a turn of the search for a literal's end."""
    lines = [r'{"a":"\\","b\"":"\\\"","c" : ["\n\\n","x\u005c"],"d":1}', r'"\\\\\\\""', "[]", r'{"":""}', r'["a]","b}"]', '12', r'{"a":"\/]"}']
    df = spark.createDataFrame([(x,) for x in lines], "l string")
    for r in df.select("l", F.expr(turns_of("l", "\0")).alias("old"), F.expr(turns_of("l", "\0", True)).alias("new"), F.expr(is_json("l")).alias("ok")).collect():
        assert r["ok"] and r["old"] == r["new"] and "".join(r["new"]) == r["l"]
    bad = ["", " ", "1,2", "1 2", "1] 2", "[1],[2]", '"a', '"a" b', "{}{}", '{"a":1} x', '{"a":1', '{"a":1},{"b":2}', '1}', '1},"w":{"x":1', '{"a" 1}', "nul", "01", "'a'", "NaN", '{"a":"\t"}', '"\\x"', "1,", ",1", '{"a":1,}', "[1", "1[", '{"a":1}}', "/*c*/1", "1//", "\ufeff1", '{"a":"\x05"}']
    got = spark.createDataFrame([(x,) for x in bad], "l string").select("l", F.expr(is_json("l")).alias("ok")).collect()
    assert [r["l"] for r in got if r["ok"]] == []


def test_few_events_are_counted_without_running_sums(spark):
    """each event was copied by a cast, and each value's places were running sums. Values of few and of many events, of
    short and of long texts, have the same places, usage and values."""
    from fieldguard.operators.strict import sanitize_column

    rows = []
    for i, (n, long) in enumerate([(0, ""), (3, ""), (31, ""), (32, ""), (200, ""), (3, "y" * 1100), (40, "y" * 300)]):
        rows.append((i, {"xs": [f"t {j % 2}{long}" for j in range(n)] + [TOKEN, None], "bag": {f"k{j}": TOKEN if j == 1 else "t 0" + long for j in range(min(n, 3))}, "rest": [[{"z": "t 1" + long}], None, [{"z": None}, {"z": TOKEN}]]}))
    df = spark.createDataFrame(rows, "i int, v struct<xs:array<string>,bag:map<string,string>,rest:array<array<struct<z:string>>>>")
    o = sanitize_column(df, "v", outcome="o")
    plan = o._jdf.queryExecution().optimizedPlan().toString()
    assert "as array<struct<kind:" not in plan and "as array<struct<text:" not in plan
    for r, (_, v) in zip(o.orderBy("i").collect(), rows):
        mask = lambda t: t and t.replace(TOKEN, "<SECRET_1>")
        got, n = r["v"].asDict(True), len(v["xs"])
        assert got == {"xs": [mask(t) for t in v["xs"]], "bag": {k: mask(t) for k, t in v["bag"].items()}, "rest": [p and [{"z": mask(q["z"])} for q in p] for p in v["rest"]]}
        # leaves in order: those of xs without its null, those of the bag, the two of rest
        texts = [t for t in v["xs"] if t] + list(v["bag"].values()) + [v["rest"][0][0]["z"], TOKEN]
        assert [f["leafOrdinal"] for f in r["o"]["findings"]] == [k for k, t in enumerate(texts) if t == TOKEN], n
        scanned = ["xs", "bag", "rest", "z", "z", "z", *v["bag"]] + [t for t in v["xs"] if t]
        for k, t in [*v["bag"].items(), ("z", v["rest"][0][0]["z"]), ("z", TOKEN)]:
            scanned += [t] if t == TOKEN else [t, '{"%s":"%s"}' % (k, t)]
        charged = list({t: 1 for t in scanned if len(t) <= 1024}) + [t for t in scanned if len(t) > 1024]
        use = r["o"]["usage"]
        assert (use["scans"], use["bytes"], use["leaves"], use["findings"]) == (len(charged), sum(map(len, charged)), len(texts), texts.count(TOKEN))
