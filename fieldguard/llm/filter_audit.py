"""Filter interaction audit: what each of several filters removes in every order in which they may be applied.

A document is a set of failure flags. Documents are counted by part and flags; an SQL CUBE over the flags then has, in
the grouping set of each subset of them, a row where all of these are false: the subset's survivors. A step of an order
takes one subset of filters to the next, so a pair of subsets, joined, says what the step removes. Only built-in functions
run, and only narrow rows are shuffled: a document's text counts by its digest.
"""

from __future__ import annotations

from dataclasses import dataclass
from itertools import permutations

from pyspark.sql import Column, DataFrame
from pyspark.sql import functions as F

from .common import materialize

FILTERS = "ABCDE"
WHITE = r"[\x20\x09-\x0D]+"


@dataclass(frozen=True)
class Rules:
    """The bounds of the filters: A fewer words, B a smaller percentage of distinct words, C a larger percentage of capitals
    A-Z among code points, D any of the signs, E a text that a smaller doc_id has too."""

    words: int = 50
    distinct: int = 65
    capitals: int = 5
    signs: str = "#$%&*|"


def _flags(text: Column, rules: Rules) -> dict[str, Column]:
    """The flags of filters A to D over a text without nulls."""
    words = F.filter(F.split(text, WHITE), lambda w: w != "")
    capitals = F.length(text) - F.length(F.regexp_replace(text, "[A-Z]", ""))
    signs = F.lit(False)
    for s in rules.signs:
        signs = signs | text.contains(s)
    return {
        "A": F.size(words) < rules.words,
        "B": F.size(F.array_distinct(words)) * 100 < F.size(words) * rules.distinct,
        "C": capitals.cast("long") * 100 > F.length(text).cast("long") * rules.capitals,
        "D": signs,
    }


def judged(docs: DataFrame, labels: DataFrame | None = None, rules: Rules = Rules()) -> DataFrame:
    """(part, A, B, C, D, E, good, toxic) of every row: its failure flags, and whether its labels call it good or toxic.

    A null text is an empty one and a null source the part ''. A row fails E where a smaller doc_id has its text; rows of one
    doc_id don't fail by each other, and a null doc_id is larger than all others. Several labels of a doc_id hold together;
    a row without a label, or without a doc_id, is neither good nor toxic.
    """
    text = F.coalesce(F.col("text"), F.lit(""))
    own = docs.select(F.col("doc_id").cast("long").alias("doc_id"), F.coalesce(F.col("source"), F.lit("")).alias("part"), text.alias("text"))
    # read twice below, so the narrow rows are written, not the texts
    own = materialize(own.select("doc_id", "part", F.unhex(F.sha2("text", 256)).alias("digest"), *[c.alias(k) for k, c in _flags(F.col("text"), rules).items()]))
    # a text's rows pass E where they are of its first doc_id; digest and doc_id together are the key, so that a text which
    # very many rows have is no hot one
    heads = own.groupBy("digest").agg(F.min("doc_id").alias("first")).select(F.col("digest").alias("head"), "first", F.lit(True).alias("passes"))
    found = own.join(heads, (F.col("digest") == F.col("head")) & F.col("doc_id").eqNullSafe(F.col("first")), "left")
    found = found.select("doc_id", "part", *"ABCD", F.col("passes").isNull().alias("E"))
    if labels is None:
        return found.withColumns({"good": F.lit(False), "toxic": F.lit(False)}).drop("doc_id")
    marks = labels.where("doc_id is not null").groupBy(F.col("doc_id").cast("long").alias("label_id")).agg(F.max(F.col("quality") == 1).alias("good"), F.max(F.col("toxic") == 1).alias("toxic"))
    joined = found.join(marks, F.col("doc_id") == F.col("label_id"), "left")
    return joined.select("part", *FILTERS, *[F.coalesce(F.col(k), F.lit(False)).alias(k) for k in ("good", "toxic")])


def survivors(flags: DataFrame) -> DataFrame:
    """(part, subset, kept, good, toxic) for every part and subset, zeros included: what is left once the subset's filters
    (bit i for the i-th of FILTERS) have been applied. flags: rows as judged() gives them."""
    count = lambda c: F.count_if(c).alias(c)
    base = flags.groupBy("part", *FILTERS).agg(F.count("*").alias("n"), count("good"), count("toxic"))
    cube = base.cube("part", *FILTERS)
    sums = cube.agg(F.sum("n").alias("kept"), F.sum("good").alias("good"), F.sum("toxic").alias("toxic"), *[F.grouping(f).alias(f"rolled_{f}") for f in ("part", *FILTERS)])
    subset = sum((F.when(F.col(f"rolled_{f}") == 0, 1 << i).otherwise(0) for i, f in enumerate(FILTERS)), F.lit(0))
    clean = F.lit(True)
    for f in FILTERS:
        clean = clean & ((F.col(f"rolled_{f}") == 1) | ~F.coalesce(F.col(f), F.lit(False)))
    found = sums.where((F.col("rolled_part") == 0) & clean).select(F.col("part").alias("p"), subset.alias("s"), "kept", "good", "toxic")
    whole = base.select("part").distinct().withColumn("subset", F.explode(F.sequence(F.lit(0), F.lit((1 << len(FILTERS)) - 1))))
    zero = lambda c: F.coalesce(F.col(c), F.lit(0)).cast("long").alias(c)
    return whole.join(found, (F.col("part") == F.col("p")) & (F.col("subset") == F.col("s")), "left").select("part", "subset", zero("kept"), zero("good"), zero("toxic"))


def audit(flags: DataFrame) -> DataFrame:
    """(part, filter_order, step, kept, removed, redundant, unique_fails, good_lost, toxic_lost, shapley): a row for each part,
    order of the filters and step of it. No rows where there are no documents."""
    spark, full = flags.sparkSession, (1 << len(FILTERS)) - 1
    left = materialize(survivors(flags))
    steps = []
    for order in permutations(range(len(FILTERS))):
        before = 0
        for step, i in enumerate(order, 1):
            steps.append(("".join(FILTERS[k] for k in order), step, before, before | 1 << i, 1 << i, full & ~(1 << i)))
            before |= 1 << i
    # 5 * 5! rows of constants
    pairs = spark.createDataFrame(steps, "filter_order string, step int, before int, after int, alone int, others int")
    at = lambda name, columns: left.select("part", F.col("subset").alias(name), *[F.col(c).alias(f"{c}_{name}") for c in columns])
    pairs = F.broadcast(pairs)
    out = at("before", ("kept", "good", "toxic")).join(pairs, "before").join(at("after", ("kept", "good", "toxic")), ["part", "after"])
    out = out.join(at("alone", ("kept",)), ["part", "alone"]).join(at("others", ("kept",)), ["part", "others"])
    out = out.join(at("none", ("kept",)).where("none = 0").drop("none"), "part").join(at("all", ("kept",)).where(F.col("all") == full).drop("all"), "part")
    out = out.withColumn("removed", F.col("kept_before") - F.col("kept_after"))
    sums = out.groupBy(F.col("part").alias("of_part"), F.col("alone").alias("of")).agg(F.sum("removed").alias("shapley"))
    out = out.join(sums, (F.col("part") == F.col("of_part")) & (F.col("alone") == F.col("of")))
    return out.select(
        "part", "filter_order", "step", F.col("kept_after").alias("kept"), "removed", (F.col("kept_none") - F.col("kept_alone") - F.col("removed")).alias("redundant"), (F.col("kept_others") - F.col("kept_all")).alias("unique_fails"),
        (F.col("good_before") - F.col("good_after")).alias("good_lost"), (F.col("toxic_before") - F.col("toxic_after")).alias("toxic_lost"), "shapley",
    )


def filter_audit(docs: DataFrame, labels: DataFrame | None = None, rules: Rules = Rules()) -> DataFrame:
    return audit(judged(docs, labels, rules))


#: The same over documents and labels, by sending every document through every order.
ORACLE = r"""
WITH d AS (SELECT doc_id, coalesce(source, '') AS part, coalesce(text, '') AS t FROM documents),
w AS (SELECT *, regexp_extract_all(t, '[^\x20\x09-\x0D]+') AS ws, min(doc_id) OVER (PARTITION BY t) AS first FROM d),
f AS (SELECT part, len(ws) < 50 AS a, 100 * len(list_distinct(ws)) < 65 * len(ws) AS b, 100 * length(regexp_replace(t, '[^A-Z]', '', 'g')) > 5 * length(t) AS c,
  regexp_matches(t, '[#$%&*|]') AS d, w.doc_id > first AS e, coalesce(quality = 1, false) AS good, coalesce(toxic = 1, false) AS toxic FROM w LEFT JOIN labels l ON l.doc_id = w.doc_id),
g AS (SELECT part, good, toxic, (CASE WHEN a THEN 'A' ELSE '' END || CASE WHEN b THEN 'B' ELSE '' END || CASE WHEN c THEN 'C' ELSE '' END || CASE WHEN d THEN 'D' ELSE '' END || CASE WHEN e THEN 'E' ELSE '' END) AS fails FROM f),
k AS (SELECT unnest(['A', 'B', 'C', 'D', 'E']) AS x),
o AS (SELECT p.x || q.x || r.x || s.x || t.x AS o FROM k p, k q, k r, k s, k t WHERE len(list_distinct([p.x, q.x, r.x, s.x, t.x])) = 5),
st AS (SELECT o, unnest(range(1, 6)) AS step FROM o),
x AS (SELECT part, good, toxic, fails, o, step, o[step] AS own, contains(fails, o[step]) AS hit, len(list_filter(range(1, step), lambda i: contains(fails, o[i]))) > 0 AS gone FROM g, st),
c AS (SELECT part, o AS filter_order, step, own, count(*) FILTER (WHERE NOT hit AND NOT gone) AS kept, count(*) FILTER (WHERE hit AND NOT gone) AS removed, count(*) FILTER (WHERE hit AND gone) AS redundant,
  count(*) FILTER (WHERE fails = own) AS unique_fails, count(*) FILTER (WHERE hit AND NOT gone AND good) AS good_lost, count(*) FILTER (WHERE hit AND NOT gone AND toxic) AS toxic_lost FROM x GROUP BY ALL)
SELECT part, filter_order, step::INT AS step, kept, removed, redundant, unique_fails, good_lost, toxic_lost, (sum(removed) OVER (PARTITION BY part, own))::BIGINT AS shapley FROM c"""
