"""Vector code compression: product codes of whole numbers, found by partial-distance search.

Vectors become whole numbers and are cut into parts; every part position has a codebook of a few entries, learnt in a
fixed number of rounds. The search for a part's nearest entry sums up squared differences one dimension after the other,
those where the codebook's entries differ most first, and drops an entry for a vector once its sum is strictly above the
best complete distance found: masks over all vectors of a slice say which are still in the race.
"""

from __future__ import annotations

import hashlib
from collections.abc import Iterator
from dataclasses import dataclass
from decimal import Decimal

import numpy as np
import pyarrow as pa
from pyspark.sql import DataFrame
from pyspark.sql import functions as F

from .common import materialize, tidied

#: The largest value of a long; larger errors end there.
MOST = (1 << 63) - 1
#: Rows searched together; they bound what a search holds.
ROWS = 4096
#: Whole numbers of more digits can't be summed up exactly by the engine.
DIGITS = 28


@dataclass(frozen=True)
class Codec:
    """parts of a vector, entries of a codebook (256 at most, for two hex digits a code), the scale before rounding down,
    and rounds of learning."""

    parts: int = 8
    entries: int = 16
    scale: int = 4096
    rounds: int = 6

    def __post_init__(self):
        if not (self.parts >= 1 and 1 <= self.entries <= 256 and self.scale >= 1 and self.rounds >= 0):
            raise ValueError("parts, entries, scale or rounds out of range")


def valid_rows(df: DataFrame, codec: Codec = Codec(), vec_id: str = "vec_id", embedding: str = "embedding", label: str = "label") -> DataFrame:
    """(vec_id, label, v): rows whose vector isn't null and holds finite components alone. A component whose whole number
    has over DIGITS digits counts as infinite."""
    v, most = F.col(embedding).cast("array<double>"), float(10**DIGITS) / codec.scale
    fine = F.forall(v, lambda x: x.isNotNull() & ~F.isnan(x) & (F.abs(x) < most))
    return df.where(F.col(embedding).isNotNull()).where(fine).select(F.col(vec_id).cast("long").alias("vec_id"), F.col(label).alias("label"), v.alias("v"))


def whole(v: np.ndarray, codec: Codec) -> np.ndarray:
    """floor(scale * x) as 64-bit numbers, or as Python's where one of them needs more."""
    x = np.floor(v * float(codec.scale))
    if not x.size or np.abs(x).max() < float(1 << 62):
        return x.astype(np.int64)
    out = np.empty(x.shape, object)
    out.ravel()[:] = [int(c) for c in x.ravel()]
    return out


def cut(x: np.ndarray, codec: Codec) -> np.ndarray:
    """[rows, parts, width]; a dimension that parts don't divide is filled up with zeros, which are near all entries alike."""
    width = -(-x.shape[1] // codec.parts) if x.shape[1] else 0
    out = np.zeros((len(x), codec.parts, width), x.dtype)
    out.reshape(len(x), -1)[:, : x.shape[1]] = x
    return out


def _exact(x: np.ndarray, book: np.ndarray) -> tuple[np.ndarray, np.ndarray]:
    """Both as numbers whose squared distances can't overflow."""
    top = max([int(abs(a).max()) for a in (x, book) if a.size] or [0])
    if (2 * top) ** 2 * max(1, x.shape[-1]) <= MOST:
        return x.astype(np.int64, copy=False), book.astype(np.int64, copy=False)
    return x.astype(object), book.astype(object)


def search(x: np.ndarray, book: np.ndarray) -> tuple[np.ndarray, np.ndarray]:
    """(code, distance) of the nearest entry of book [entries, width] for each row of x; of equal ones the first."""
    x, book = _exact(x, book)
    spread = [len(book) * sum(int(c) ** 2 for c in column) - sum(int(c) for c in column) ** 2 for column in book.T]
    order = sorted(range(book.shape[1]), key=lambda t: (-spread[t], t))
    code, best = np.zeros(len(x), np.int64), ((x - book[0]) ** 2).sum(1) if book.shape[1] else np.zeros(len(x), x.dtype)
    for j in range(1, len(book)):
        alive, total = np.arange(len(x)), np.zeros(len(x), best.dtype)
        for t in order:
            total = total + (x[alive, t] - book[j, t]) ** 2
            stays = (total <= best[alive]).astype(bool)
            if not stays.all():
                alive, total = alive[stays], total[stays]
                if not len(alive):
                    break
        nearer = (total < best[alive]).astype(bool)
        best[alive[nearer]], code[alive[nearer]] = total[nearer], j
    return code, best


def _vectors(batches: Iterator[pa.RecordBatch], d: int, codec: Codec) -> Iterator[tuple[pa.RecordBatch, np.ndarray]]:
    for batch in batches:
        for at in range(0, batch.num_rows, ROWS):
            part = batch.slice(at, ROWS)
            flat = part.column(part.schema.get_field_index("v")).flatten().to_numpy(zero_copy_only=False)
            yield part, cut(whole(flat.reshape(part.num_rows, d), codec), codec)


def _summer(books: np.ndarray, d: int, codec: Codec):
    """Rows (part, entry, position, total, n) of a task: the sums of the parts nearest to each entry."""
    schema = pa.schema([("part", pa.int32()), ("entry", pa.int32()), ("position", pa.int32()), ("total", pa.decimal128(38, 0)), ("n", pa.int64())])

    def run(batches: Iterator[pa.RecordBatch]) -> Iterator[pa.RecordBatch]:
        k, width = books.shape[1], books.shape[2]
        totals, counts = [[[0] * width for _ in range(k)] for _ in range(codec.parts)], np.zeros((codec.parts, k), np.int64)
        for _, x in _vectors(batches, d, codec):
            for p in range(codec.parts):
                code, _ = search(x[:, p], books[p])
                counts[p] += np.bincount(code, minlength=k)
                small = x.dtype != object and int(np.abs(x[:, p]).max(initial=0)) * len(x) < MOST
                for j in np.unique(code):
                    members = x[code == j, p]
                    add = members.sum(0) if small else [sum(int(c) for c in column) for column in members.T]
                    totals[p][j] = [a + int(b) for a, b in zip(totals[p][j], add)]
        rows = [(p, j, t, Decimal(totals[p][j][t]), int(counts[p, j])) for p in range(codec.parts) for j in range(k) if counts[p, j] for t in range(width)]
        if rows:
            yield pa.RecordBatch.from_arrays([pa.array(c, f.type) for c, f in zip(zip(*rows), schema)], schema=schema)

    return tidied(run)


def _coder(books: np.ndarray, d: int, codec: Codec):
    schema = pa.schema([("code", pa.string()), ("error", pa.decimal128(38, 0))])

    def run(batches: Iterator[pa.RecordBatch]) -> Iterator[pa.RecordBatch]:
        for part, x in _vectors(batches, d, codec):
            found = [search(x[:, p], books[p]) for p in range(codec.parts)]
            names = ["".join(f"{c:02x}" for c in row) for row in np.stack([c for c, _ in found], 1).tolist()]
            errors = [Decimal(min(MOST, sum(int(e) for e in row))) for row in zip(*[e.tolist() for _, e in found])]
            yield pa.RecordBatch.from_arrays([part.column(0), part.column(1), pa.array(names, pa.string()), pa.array(errors, schema.field("error").type)], names=["vec_id", "label", "code", "error"])

    return tidied(run)


@dataclass(frozen=True)
class Codebooks:
    """books: whole numbers [parts, entries, width]; d: the dimension of the vectors that they are for."""

    books: np.ndarray
    d: int
    codec: Codec

    def digest(self) -> str:
        return hashlib.sha256(",".join(str(int(c)) for c in self.books.ravel()).encode()).hexdigest()


def learn(rows: DataFrame, codec: Codec = Codec()) -> tuple[DataFrame, Codebooks | None]:
    """The rows of the commonest dimension (of equal ones the largest), and codebooks learnt from all of them: from the
    parts of the rows of the smallest vec_ids (nulls last, ties by the vectors), in rounds of assigning every part to its
    nearest entry and moving each entry to the floor of its parts' mean; entries without parts stay. The driver gets the
    codebooks' own size from each round and nothing of the rows. None where there are no rows."""
    sizes = rows.groupBy(F.size("v").alias("d")).count().orderBy(F.desc("count"), F.desc("d")).first()
    if sizes is None:
        return rows, None
    d = sizes["d"]
    rows = rows.where(F.size("v") == d)
    first = rows.orderBy(F.asc_nulls_last("vec_id"), "v").limit(codec.entries).collect()
    seeds = cut(whole(np.array([r["v"] for r in first], np.float64).reshape(len(first), d), codec), codec)
    books = np.ascontiguousarray(seeds.transpose(1, 0, 2))
    for _ in range(codec.rounds):
        sums = rows.select("vec_id", "label", "v").mapInArrow(_summer(books, d, codec), "part int, entry int, position int, total decimal(38,0), n long")
        moved = books.astype(object)
        for r in sums.groupBy("part", "entry", "position").agg(F.sum("total").alias("total"), F.sum("n").alias("n")).collect():
            moved[r["part"], r["entry"], r["position"]] = int(r["total"]) // r["n"]
        books = moved.astype(np.int64) if all(abs(int(c)) <= MOST for c in moved.ravel()) else moved
    return rows, Codebooks(books, d, codec)


def encode(rows: DataFrame, books: Codebooks) -> DataFrame:
    """(vec_id, label, code, error): two hex digits for each part's entry, and the squared distances summed over the parts."""
    label = rows.schema["label"].dataType.simpleString()
    return rows.select("vec_id", "label", "v").mapInArrow(_coder(books.books, books.d, books.codec), f"vec_id long, label {label}, code string, error decimal(38,0)")


def decode(codes: DataFrame, books: Codebooks) -> DataFrame:
    """codes with v, the components that a code stands for: the entries of its parts over the scale."""
    table = [[[float(int(c)) / books.codec.scale for c in entry] for entry in part] for part in books.books]
    entries = F.array(*[F.array(*[F.array(*[F.lit(c) for c in entry]).cast("array<double>") for entry in part]) for part in table])
    at = lambda i: F.conv(F.substr(F.col("code"), i * 2 + 1, F.lit(2)), 16, 10).cast("int")
    parts = F.transform(F.sequence(F.lit(0), F.lit(books.codec.parts - 1)), lambda i: F.get(F.get(entries, i), at(i)))
    return codes.withColumn("v", F.slice(F.flatten(parts), 1, books.d) if books.d else F.array().cast("array<double>"))


def compress(df: DataFrame, codec: Codec = Codec(), vec_id: str = "vec_id", embedding: str = "embedding", label: str = "label") -> DataFrame:
    """(vec_id, code, error, label_error, codebooks_sha256) of every row with a vector of finite components.

    Vectors of another dimension than the commonest are left out; rows that share a vec_id are rows of their own. Fewer rows
    than entries make smaller codebooks. Errors end at the largest long. An empty table gives no rows.
    """
    rows = materialize(valid_rows(df, codec, vec_id, embedding, label))
    rows, books = learn(rows, codec)
    if books is None:
        return rows.select("vec_id", F.lit("").alias("code"), F.lit(0).cast("long").alias("error"), F.lit(0).cast("long").alias("label_error"), F.lit("").alias("codebooks_sha256"))
    coded = materialize(encode(rows, books))
    as_long = lambda c: F.least(c, F.lit(MOST)).cast("long")
    sums = coded.groupBy(F.col("label").alias("fg_label")).agg(F.sum("error").alias("label_error"))
    return coded.join(sums, F.col("label").eqNullSafe(F.col("fg_label"))).select("vec_id", "code", as_long(F.col("error")).alias("error"), as_long(F.col("label_error")).alias("label_error"), F.lit(books.digest()).alias("codebooks_sha256"))


def oracle(codec: Codec = Codec()) -> str:
    """The same over the table embeddings, with every distance in full and one query for each round."""
    ctes = [
        "r AS (SELECT row_number() OVER (ORDER BY vec_id, embedding) - 1 AS n, vec_id, label, embedding FROM embeddings WHERE embedding IS NOT NULL AND len(list_filter(embedding, lambda x: x IS NULL OR NOT isfinite(x))) = 0)",
        f"c AS MATERIALIZED (SELECT n, (place - 1) // (size // {codec.parts}) AS part, (place - 1) % (size // {codec.parts}) AS position, floor({codec.scale} * x::DOUBLE)::BIGINT AS x FROM (SELECT n, len(embedding) AS size, unnest(embedding) AS x, generate_subscripts(embedding, 1) AS place FROM r))",
        f"b0 AS MATERIALIZED (SELECT part, n AS entry, position, x AS y FROM c WHERE n < {codec.entries})",
    ]
    for i in range(codec.rounds + 1):
        ctes.append(f"d{i} AS (SELECT c.n, c.part, b.entry, sum((c.x - b.y) * (c.x - b.y)) AS apart FROM c JOIN b{i} b ON c.part = b.part AND c.position = b.position GROUP BY ALL)")
        ctes.append(f"a{i} AS MATERIALIZED (SELECT n, part, apart, entry FROM d{i} QUALIFY row_number() OVER (PARTITION BY n, part ORDER BY apart, entry) = 1)")
        if i < codec.rounds:
            ctes.append(f"m{i} AS (SELECT c.part, a.entry, c.position, sum(c.x)::HUGEINT AS total, count(*)::HUGEINT AS k FROM c JOIN a{i} a ON c.n = a.n AND c.part = a.part GROUP BY ALL)")
            floor = "CASE WHEN total >= 0 THEN total // k ELSE -((-total + k - 1) // k) END"
            ctes.append(f"b{i + 1} AS MATERIALIZED (SELECT b.part, b.entry, b.position, coalesce({floor}, b.y)::BIGINT AS y FROM b{i} b LEFT JOIN m{i} m ON b.part = m.part AND b.entry = m.entry AND b.position = m.position)")
    last = codec.rounds
    ctes.append(f"o AS (SELECT n, string_agg(printf('%02x', entry::INT), '' ORDER BY part) AS code, sum(apart)::BIGINT AS error FROM a{last} GROUP BY n)")
    ctes.append(f"h AS (SELECT sha256(string_agg(y::VARCHAR, ',' ORDER BY part, entry, position)) AS codebooks_sha256 FROM b{last})")
    return "WITH " + ",\n".join(ctes) + "\nSELECT vec_id, code, error, (sum(error) OVER (PARTITION BY label))::BIGINT AS label_error, codebooks_sha256 FROM o JOIN r USING (n), h"
