"""Extreme vectors, names of elements that the builder hasn't listed, short secrets, words and stems of any length."""

import random

import pytest
from pyspark.sql import functions as F

PROSE = "The quick story of the town is that it was in the valley and that the people of the town were happy with it for a long time, as it was on the river and by the hills. " * 3


def test_neighbours_of_extreme_vectors(spark):
    from fieldguard.llm.ann import nearest

    rows = [(50, [1.0, 0.0, 0.1]), (1, [1e-200, 0.0, 1e-201]), (2, [1e200, 0.0, 1e199]), (3, [1.0, 0.0, 0.0]), (4, [0.0, 1.0, 0.0]), (5, [5e-324, 0.0, 0.0]), (6, [1.7e308, 1.7e308, 0.0])]
    df = spark.createDataFrame(rows, "vec_id long, embedding array<double>")
    got = [(r["vec_id"], r["score"]) for r in nearest(df, F.col("vec_id") % 50 == 0, 6).orderBy("rank").collect()]
    assert {got[0][0], got[1][0]} == {1, 2} and [i for i, _ in got[2:]] == [3, 5, 6, 4]
    assert all(abs(s - w) < 1e-12 for (_, s), w in zip(got, (1, 1, 1 / 1.01**0.5, 1 / 1.01**0.5, 1 / 2.02**0.5, 0)))


@pytest.mark.parametrize("name", "reader-comments user-comments comment-body comment-content commentList related-articles newsletter-signup cookie-policy leaderboard-ad google-ads main-nav left-sidebar-content discussion responses".split())
def test_names_of_elements_that_are_not_the_article(name):
    from fieldguard.llm.html_extract import extract

    page = f'<html><body><article><p>{PROSE}</p><div class="{name}"><p>Short remark by Joe here</p><p>I liked it, thanks</p></div><p>{PROSE}end.</p></article></body></html>'
    assert extract(page) == f"{PROSE.strip()} {PROSE}end."


def test_names_that_tell_of_a_page_and_prose_that_settles_doubts():
    from fieldguard.llm.html_extract import extract

    for name in ("has-sidebar", "no-comments", "with-ads"):
        assert extract(f'<article><div class="{name}"><p>{PROSE}</p></div></article>') == PROSE.strip()
    assert extract(f'<article><div class="discussion"><p>{PROSE}</p></div></article>') == PROSE.strip()
    assert extract(f'<div class="content-sidebar-wrap"><article><p>{PROSE}</p><p>Short.</p></article></div>') == f"{PROSE.strip()} Short."


def test_formulas_and_control_characters_stay():
    from fieldguard.llm.html_extract import extract

    assert extract(f"<article><p>{PROSE} so <math><mi>E</mi><mo>=</mo><mi>m</mi></math></p></article>").endswith("so E=m")
    assert "a\x01b" in extract(f"<article><p>{PROSE} a\x01b</p></article>")


def test_bits_alone_say_how_short_a_secret_may_be():
    from fieldguard.llm.secret_scan import Battery, candidates

    assert Battery().least() == 15 and Battery(bits=60).least() == 10
    assert candidates(b"abcDEF123ghi+/x", 15) == [(0, 15)] and not candidates(b"abcDEF123ghi+/", 15)


def test_terms_of_any_length():
    from fieldguard.llm.toxicity import Rules, candidates

    assert {"a", "go", "extraordinarily", "extr*", "extraor*"} <= candidates("a go extraordinarily", Rules()) and "extraordinaril*" in candidates("extraordinarily", Rules(longest_stem=None))
    few = candidates("a go extraordinarily", Rules(least_letters=3, longest_stem=7))
    assert few == {"extraordinarily", "extr*", "extra*", "extrao*", "extraor*"}


def test_random_keys_are_found_beside_names(spark):
    from fieldguard.llm.secret_scan import scan_documents

    r = random.Random(6)
    key = "".join(r.choice("ABCDEFGHIJKLMNOPQRSTUVWXYZabcdefghijklmnopqrstuvwxyz0123456789+/") for _ in range(44))
    rows = [(1, f"use {key} here"), (2, "getUserAccountName2 totalPriceList3"), (3, None)]
    got = {x["doc_id"]: x["spans"] for x in scan_documents(spark.createDataFrame(rows, "doc_id long, text string")).collect()}
    assert got == {1: "random:4:48", 2: "", 3: ""}
