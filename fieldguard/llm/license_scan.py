"""License scans by diagonal voting, in DataFrame functions only.

Every rolling word k-gram of a text is hashed and joined to the positions of the templates, a table of any size.
Hits with one difference between text and template position lie on one diagonal and vote for the template standing
there; neighbouring diagonals (a word more or less) are merged, and a span counts when its grams cover enough of the
template within a span of fitting length. Grams are compared by two independent hashes of their words, 96 bits in all:
among 10**13 grams of a corpus and 10**6 of templates, one false hit is expected in 10**9 such runs.
"""

from __future__ import annotations

import re
from dataclasses import dataclass

from pyspark.sql import Column, DataFrame, SparkSession, Window
from pyspark.sql import functions as F

from .common import materialize

# What separates words, the base phrases with their labels, and openings of well-known notices.
SEPARATOR = r"[\x00-\x2F\x3A-\x60\x7B-\x7F]+"
PHRASES = {"gnu general public license": "gpl", "apache license": "apache", "cc by": "cc-by", "mit license": "mit"}
NOTICES = (
    ("mit", "permission is hereby granted free of charge to any person obtaining a copy of this software and associated documentation files to deal in the software without restriction"),
    ("apache", "you may not use this file except in compliance with the license you may obtain a copy of the license at http www apache org licenses license 2 0"),
    ("gpl", "this program is free software you can redistribute it and or modify it under the terms of the gnu general public license as published by the free software foundation"),
    ("lgpl", "this library is free software you can redistribute it and or modify it under the terms of the gnu lesser general public license as published by the free software foundation"),
    ("bsd", "redistribution and use in source and binary forms with or without modification are permitted provided that the following conditions are met"),
    ("isc", "permission to use copy modify and or distribute this software for any purpose with or without fee is hereby granted provided that the above copyright notice"),
    ("mpl", "this source code form is subject to the terms of the mozilla public license v 2 0"),
    ("cc-by", "this work is licensed under a creative commons attribution 4 0 international license"),
    ("unlicense", "this is free and unencumbered software released into the public domain"),
)


@dataclass(frozen=True)
class Voting:
    """k-gram lengths for phrases and notices, least covered share of a notice, words that a diagonal may shift, and
    template positions (about 40 bytes each) up to which they are broadcast; a larger table meets the grams in a shuffle."""

    phrase_k: int = 2
    notice_k: int = 4
    cover: float = 0.5
    shift: int = 3
    broadcast: int = 200_000


def _grams(voting: Voting) -> list[tuple[str, bool, int, int, int, str]]:
    """(label, phrase?, template, grams in it, position, gram)."""
    out = []
    for t, (text, label) in enumerate(PHRASES.items()):
        w = text.split()
        out += [(label, True, t, len(w) - voting.phrase_k + 1, i, " ".join(w[i : i + voting.phrase_k])) for i in range(len(w) - voting.phrase_k + 1)]
    for t, (label, text) in enumerate(NOTICES, len(PHRASES)):
        w = text.split()
        out += [(label, False, t, len(w) - voting.notice_k + 1, i, " ".join(w[i : i + voting.notice_k])) for i in range(len(w) - voting.notice_k + 1)]
    return out


def default_templates(spark: SparkSession) -> DataFrame:
    """(label, phrase, text): the base phrases and the openings of well-known notices."""
    rows = [(label, True, text) for text, label in PHRASES.items()] + [(label, False, text) for label, text in NOTICES]
    return spark.createDataFrame(rows, "label string, phrase boolean, text string")


def _grams_of(ws: Column, k: int) -> Column:
    """array<struct<pos, hash, other>> of all rolling k-grams; positions count from the first word."""
    lead = F.when(F.get(ws, F.lit(0)) == "", 1).otherwise(0)
    n = F.size(ws) - F.when(F.get(ws, F.size(ws) - 1) == "", 1).otherwise(0)  # where an empty word ends the text, also of a text without words
    places = F.when(n - lead >= k, F.sequence(lead, n - k)).otherwise(F.expr("cast(array() as array<int>)"))
    words = lambda i: [F.get(ws, i + j) for j in range(k)]
    return F.transform(places, lambda i: F.struct((i - lead).alias("pos"), F.xxhash64(*words(i)).alias("hash"), F.hash(*words(i)).alias("other")))


def _positions(templates: DataFrame, voting: Voting) -> DataFrame:
    """(label, phrase, template, n_grams, tpos, t_hash, t_other): every gram of every template; templates shorter than
    a gram have none. One template given twice counts once."""
    t = templates.select(F.col("label").cast("string").alias("label"), F.col("phrase").cast("boolean").alias("phrase"), words_of("text").alias("ws")).distinct()
    t = t.withColumn("template", F.xxhash64("label", "phrase", "ws"))
    t = t.select("label", "phrase", "template", F.when(F.col("phrase"), _grams_of(F.col("ws"), voting.phrase_k)).otherwise(_grams_of(F.col("ws"), voting.notice_k)).alias("grams"))
    t = t.select("label", "phrase", "template", F.size("grams").alias("n_grams"), F.explode("grams").alias("g"))
    return t.select("label", "phrase", "template", "n_grams", F.col("g.pos").alias("tpos"), F.col("g.hash").alias("t_hash"), F.col("g.other").alias("t_other"))


def words_of(text: str = "text") -> Column:
    """Words in order; an empty one may stand first and last, where the text begins or ends with separators."""
    lower = F.lower(F.replace(F.coalesce(F.col(text), F.lit("")), F.lit(chr(0x212A)), F.lit(chr(0xE9))))  # the Kelvin sign is no ASCII k
    return F.split(lower, SEPARATOR)


def scan_licenses(docs: DataFrame, voting: Voting = Voting(), templates: DataFrame | None = None) -> DataFrame:
    """(doc_id, n_words, n_base, first_word, last_word, base_labels, labels, score) for every row of docs.

    templates (label, phrase, text): phrases count where their words stand consecutively, others where enough of them
    stands; those of default_templates() without. score is the largest share of a template that a span covers, 1 where
    a base phrase stands. A null or empty text has 0 words, no labels ("") and score 0. Null doc_id and rows repeated
    with one doc_id stay, each with the result of its own text. Other columns are ignored. The grams of a text meet the
    template positions where it is read while these are few enough to broadcast; what is shuffled then is a narrow
    table of rows and the few grams that occur in templates.
    """
    t = materialize(_positions(templates if templates is not None else default_templates(docs.sparkSession), voting))
    few = t.count() <= voting.broadcast

    def count(ws: Column) -> Column:
        n = F.size(ws) - F.when(F.get(ws, F.lit(0)) == "", 1).otherwise(0) - F.when((F.size(ws) > 1) & (F.get(ws, F.size(ws) - 1) == ""), 1).otherwise(0)
        return n.cast("long")

    # the words are bound once as a lambda's argument, so that no rewrite splits the text again at each place
    bound = lambda f: F.get(F.transform(F.array(words_of()), f), F.lit(0))
    key = ["doc_id", "th"]
    ids = [F.col("doc_id").cast("long").alias("doc_id"), F.xxhash64(F.coalesce("text", F.lit(""))).alias("th")]
    rows = docs.select(*ids, bound(count).alias("n_words"))
    grams = docs.select(*ids, F.explode(bound(lambda ws: F.concat(_grams_of(ws, voting.phrase_k), _grams_of(ws, voting.notice_k)))).alias("g"))
    grams = grams.select(*key, "g.pos", "g.hash", "g.other")
    hits = grams.join(F.broadcast(t) if few else t, (F.col("hash") == F.col("t_hash")) & (F.col("other") == F.col("t_other")))
    votes = hits.select(*key, "label", "phrase", "template", "n_grams", "tpos", "pos", (F.col("pos") - F.col("tpos")).alias("diagonal"))
    votes = materialize(votes.distinct())  # rows repeated with one doc_id and text vote once
    diagonals = votes.groupBy(*key, "label", "phrase", "template", "n_grams", "diagonal").agg(
        F.count("*").alias("n"), F.min("pos").alias("start"), F.max("pos").alias("stop"), F.collect_set("tpos").alias("at")
    )
    base = diagonals.where("phrase and n = n_grams").groupBy(*key).agg(
        F.count("*").alias("n_base"), F.min("diagonal").cast("long").alias("first_word"), F.max("diagonal").cast("long").alias("last_word"), F.collect_set("label").alias("base")
    )
    by = Window.partitionBy(*key, "template").orderBy("diagonal")
    far = (F.col("diagonal") - F.lag("diagonal").over(by) > voting.shift) | F.lag("diagonal").over(by).isNull()
    spans = diagonals.where("not phrase").withColumn("island", F.sum(far.cast("int")).over(by)).groupBy(*key, "label", "template", "n_grams", "island").agg(
        F.size(F.array_distinct(F.flatten(F.collect_list("at")))).alias("covered"), F.min("start").alias("start"), F.max("stop").alias("stop")
    )
    spans = spans.withColumn("share", F.least(F.lit(1.0), F.col("covered") / F.col("n_grams")))
    spans = spans.withColumn("found", (F.col("share") >= voting.cover) & (F.col("stop") - F.col("start") <= F.col("n_grams") * 1.5))
    fuzzy = spans.groupBy(*key).agg(F.collect_set(F.when(F.col("found"), F.col("label"))).alias("own"), F.max("share").alias("share"))
    found = base.withColumns({"own": F.lit(None).cast("array<string>"), "share": F.lit(1.0)}).unionByName(
        fuzzy.withColumns({"n_base": F.lit(0).cast("long"), "first_word": F.lit(None).cast("long"), "last_word": F.lit(None).cast("long"), "base": F.lit(None).cast("array<string>")})
    )
    found = found.groupBy(*key).agg(
        F.sum("n_base").alias("n_base"), F.max("first_word").alias("first_word"), F.max("last_word").alias("last_word"), F.max("share").alias("share"),
        F.flatten(F.collect_list("base")).alias("base"), F.flatten(F.collect_list("own")).alias("own"),
    )
    found = found.select(F.col("doc_id").alias("f_id"), F.col("th").alias("f_th"), "n_base", "first_word", "last_word", "share", "base", F.array_union("base", "own").alias("all"))
    out = rows.join(found, F.col("doc_id").eqNullSafe(F.col("f_id")) & (F.col("th") == F.col("f_th")), "left")
    none = F.expr("cast(array() as array<string>)")
    return out.select(
        "doc_id", "n_words", F.coalesce("n_base", F.lit(0)).cast("long").alias("n_base"), "first_word", "last_word",
        F.array_join(F.array_sort(F.array_distinct(F.coalesce("base", none))), ",").alias("base_labels"),
        F.array_join(F.array_sort(F.array_distinct(F.coalesce("all", none))), ",").alias("labels"),
        F.coalesce("share", F.lit(0.0)).alias("score"),
    )


def oracle() -> str:
    """The same by SQL: every gram as words, without hashes."""
    voting = Voting()
    values = ", ".join("('{}', {}, {}, {}, {}, '{}')".format(*g) for g in _grams(voting))
    grams = " UNION ALL ".join(
        f"SELECT rid, i - 1 AS pos, array_to_string(ws[i:i + {k - 1}], ' ') AS gram FROM p WHERE i + {k - 1} <= n_words" for k in (voting.phrase_k, voting.notice_k)
    )
    return rf"""
WITH t(label, phrase, template, n_grams, tpos, gram) AS (VALUES {values}),
d AS (SELECT row_number() OVER () AS rid, doc_id, list_filter(regexp_split_to_array(lower(replace(coalesce(text, ''), chr(8490), chr(233))), '{SEPARATOR}'), lambda w: w <> '') AS ws FROM documents),
r AS (SELECT rid, doc_id, ws, len(ws)::BIGINT AS n_words FROM d),
p AS (SELECT rid, ws, n_words, unnest(range(1, n_words + 1)) AS i FROM r),
h AS ({grams}),
v AS (SELECT DISTINCT rid, label, phrase, template, n_grams, tpos, pos, pos - tpos AS diagonal FROM h JOIN t ON h.gram = t.gram),
g AS (SELECT rid, label, phrase, template, n_grams, diagonal, count(*) AS n, min(pos) AS start, max(pos) AS stop, list(tpos) AS places FROM v GROUP BY ALL),
b AS (SELECT rid, count(*)::BIGINT AS n_base, min(diagonal)::BIGINT AS first_word, max(diagonal)::BIGINT AS last_word, list(DISTINCT label) AS base FROM g WHERE phrase AND n = n_grams GROUP BY rid),
k AS (SELECT *, sum(CASE WHEN diagonal - before <= {voting.shift} THEN 0 ELSE 1 END) OVER (PARTITION BY rid, template ORDER BY diagonal) AS island
      FROM (SELECT *, lag(diagonal) OVER (PARTITION BY rid, template ORDER BY diagonal) AS before FROM g WHERE NOT phrase)),
s AS (SELECT rid, label, template, n_grams, least(1.0::DOUBLE, len(list_distinct(flatten(list(places))))::DOUBLE / n_grams) AS share, max(stop) - min(start) AS long FROM k GROUP BY rid, label, template, n_grams, island),
f AS (SELECT rid, max(share) AS share, list(DISTINCT label) FILTER (WHERE share >= {voting.cover} AND long <= n_grams * 1.5) AS own FROM s GROUP BY rid)
SELECT doc_id, n_words, coalesce(n_base, 0) AS n_base, first_word, last_word,
       array_to_string(list_sort(coalesce(base, [])), ',') AS base_labels,
       array_to_string(list_sort(list_distinct(list_concat(coalesce(base, []), coalesce(own, [])))), ',') AS labels,
       CASE WHEN n_base > 0 THEN 1.0 ELSE coalesce(share, 0.0) END::DOUBLE AS score
FROM r LEFT JOIN b USING (rid) LEFT JOIN f USING (rid)"""


assert all(re.fullmatch(r"[a-z0-9 ]+", x) for x in [*PHRASES, *(t for _, t in NOTICES)])
