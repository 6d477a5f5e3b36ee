"""The registered queries of the training-data operators, and their SQL where it can express them."""

from __future__ import annotations

from collections.abc import Callable

from pyspark.sql import DataFrame, SparkSession

from .common import load


def _vocabulary(name: str) -> str:
    import public_tokenizers

    return public_tokenizers.path(name)


def op1_html_extraction(spark: SparkSession, sf_dir: str) -> DataFrame:
    from .html_extract import extract_pages

    return extract_pages(load(spark, sf_dir, "pages"))


def op2_byte_bpe(spark: SparkSession, sf_dir: str) -> DataFrame:
    import public_tokenizers

    from .bpe import encode_documents

    return encode_documents(load(spark, sf_dir, "documents"), _vocabulary("byte_bpe_50k.tiktoken"), public_tokenizers.PATTERN, with_ids=False)


def op3_toxicity(spark: SparkSession, sf_dir: str) -> DataFrame:
    from .toxicity import fit, score_documents

    docs = load(spark, sf_dir, "documents")
    return score_documents(docs, fit(docs, load(spark, sf_dir, "labels")))


def op4_token_count(spark: SparkSession, sf_dir: str) -> DataFrame:
    from .token_count import count_tokens

    return count_tokens(load(spark, sf_dir, "documents"), _vocabulary("piece_bpe_32k.model"))


def op5_ann_search(spark: SparkSession, sf_dir: str) -> DataFrame:
    from pyspark.sql import functions as F

    from .ann import nearest

    return nearest(load(spark, sf_dir, "embeddings"), F.col("vec_id") % 50 == 0)


def op6_jaccard_join(spark: SparkSession, sf_dir: str) -> DataFrame:
    from .jaccard import near_duplicates

    return near_duplicates(load(spark, sf_dir, "documents"))


def op7_license_scan(spark: SparkSession, sf_dir: str) -> DataFrame:
    from .license_scan import scan_licenses

    return scan_licenses(load(spark, sf_dir, "documents"))


def op8_secret_scan(spark: SparkSession, sf_dir: str) -> DataFrame:
    from .secret_scan import scan_documents

    return scan_documents(load(spark, sf_dir, "documents"))


def op9_mixing(spark: SparkSession, sf_dir: str) -> DataFrame:
    from .mixing import mix_sizes

    return mix_sizes(load(spark, sf_dir, "documents"))


def op10_exact_dedup(spark: SparkSession, sf_dir: str) -> DataFrame:
    from .exact_dedup import exact_dedup

    return exact_dedup(load(spark, sf_dir, "documents"))


def op11_line_dedup(spark: SparkSession, sf_dir: str) -> DataFrame:
    from .line_dedup import line_dedup

    return line_dedup(load(spark, sf_dir, "documents"))


def op12_vector_codes(spark: SparkSession, sf_dir: str) -> DataFrame:
    from .vector_codes import compress

    return compress(load(spark, sf_dir, "embeddings"))


def op13_filter_audit(spark: SparkSession, sf_dir: str) -> DataFrame:
    from .filter_audit import filter_audit

    return filter_audit(load(spark, sf_dir, "documents"), load(spark, sf_dir, "labels"))


def queries() -> dict[str, Callable[[SparkSession, str], DataFrame]]:
    return {
        "op1_html_extraction": op1_html_extraction,
        "op2_byte_bpe": op2_byte_bpe,
        "op3_toxicity": op3_toxicity,
        "op4_token_count": op4_token_count,
        "op5_ann_search": op5_ann_search,
        "op6_jaccard_join": op6_jaccard_join,
        "op7_license_scan": op7_license_scan,
        "op8_secret_scan": op8_secret_scan,
        "op9_mixing": op9_mixing,
        "op10_exact_dedup": op10_exact_dedup,
        "op11_line_dedup": op11_line_dedup,
        "op12_vector_codes": op12_vector_codes,
        "op13_filter_audit": op13_filter_audit,
    }


_NORMAL = r"regexp_replace(coalesce(text, ''), '[\x20\x09-\x0D]', '', 'g')"


def oracle_sql() -> dict[str, str]:
    from . import filter_audit, license_scan, line_dedup, vector_codes

    return {
        "op11_line_dedup": line_dedup.ORACLE,
        "op12_vector_codes": vector_codes.oracle(),
        "op13_filter_audit": filter_audit.ORACLE,
        "op7_license_scan": license_scan.oracle(),
        "op10_exact_dedup": f"""
WITH t AS (SELECT doc_id, length(coalesce(text, '')) AS points, {_NORMAL} AS norm FROM documents),
w AS (SELECT doc_id, norm,
             first_value(doc_id) OVER (PARTITION BY norm ORDER BY points DESC, doc_id NULLS LAST) AS keep_id,
             points = max(points) OVER (PARTITION BY norm) AS longest,
             count(*) OVER (PARTITION BY norm) AS group_size FROM t)
SELECT doc_id, keep_id, group_size, doc_id IS NOT DISTINCT FROM keep_id AND longest AS kept, sha256(norm) AS text_sha256 FROM w""",
        "op9_mixing": r"""
WITH d AS (SELECT doc_id, source, len(regexp_extract_all(coalesce(text, ''), '[^\x20\x09-\x0D]+'))::BIGINT AS size,
                  md5(coalesce(doc_id::VARCHAR, '') || ':' || coalesce(text, '')) AS key FROM documents),
s AS (SELECT source, sum(size)::BIGINT AS source_size, row_number() OVER (ORDER BY source NULLS LAST) - 1 AS place FROM d GROUP BY source),
c AS (SELECT *, [5, 2, 1][place % 3 + 1]::DOUBLE AS weight, (source_size * 2)::DOUBLE AS cap, cap / weight AS ratio FROM s),
v AS (SELECT *, (sum(source_size) OVER () * 1.5 - (sum(cap) OVER o - cap)) / sum(weight) OVER (ORDER BY ratio, place ROWS BETWEEN CURRENT ROW AND UNBOUNDED FOLLOWING) AS level
      FROM c WINDOW o AS (ORDER BY ratio, place ROWS UNBOUNDED PRECEDING)),
f AS (SELECT place AS free_place, ratio AS free_ratio, level AS free_level FROM v WHERE level <= ratio ORDER BY ratio, place LIMIT 1),
t AS (SELECT v.*, CASE WHEN free_place IS NULL OR (ratio, place) < (free_ratio, free_place) THEN cap ELSE weight * free_level END AS target,
             greatest(1, ceil(source_size / 200000))::BIGINT AS n_blocks FROM v LEFT JOIN f ON true),
g AS (SELECT *, CASE WHEN source_size > 0 THEN floor(target / source_size) ELSE 0 END::BIGINT AS passes,
             CASE WHEN source_size > 0 THEN floor(target - floor(target / source_size) * source_size) ELSE 0 END::BIGINT AS rest FROM t),
r AS (SELECT d.doc_id, d.size, d.key, g.source_size, g.target, g.place, g.passes, g.rest, ('0x' || substr(d.key, 1, 8))::BIGINT % n_blocks AS block
      FROM d JOIN g ON d.source IS NOT DISTINCT FROM g.source),
b AS (SELECT place, block, rest, sum(size)::BIGINT AS words, md5('7:' || place || ':' || block) AS turn FROM r GROUP BY place, block, rest),
u AS (SELECT *, sum(words) OVER (PARTITION BY place ORDER BY turn, block ROWS UNBOUNDED PRECEDING) AS upto FROM b),
k AS (SELECT r.place, r.block, r.key, sum(r.size) AS words, count(*) AS same, u.rest - u.upto + u.words AS part
      FROM r JOIN u ON r.place = u.place AND r.block = u.block WHERE u.upto > u.rest AND u.upto - u.words < u.rest GROUP BY ALL),
l AS (SELECT *, sum(words) OVER (PARTITION BY place, block ORDER BY key ROWS UNBOUNDED PRECEDING) AS upto FROM k),
m AS (SELECT place, block, key AS cut, floor((part - upto + words) / same)::BIGINT AS cut_words FROM l WHERE upto > part AND upto - words <= part)
SELECT r.doc_id, r.size, r.source_size, r.target,
       (r.size * (r.passes + CASE WHEN u.upto <= r.rest THEN 1 ELSE 0 END) + CASE WHEN r.key < m.cut THEN r.size WHEN r.key = m.cut THEN m.cut_words ELSE 0 END)::BIGINT AS taken
FROM r JOIN u ON r.place = u.place AND r.block = u.block LEFT JOIN m ON r.place = m.place AND r.block = m.block""",
    }
