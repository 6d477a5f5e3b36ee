"""Approximate nearest neighbours by score-aware anisotropic quantisation.

Vectors, scaled to length one, are product-quantised to four bits a subspace. Code books and codes minimise a
loss that weighs the residual's part parallel to the vector more than the rest, since that part changes inner
products with the queries that matter. Queries scan all codes, in blocks, by table look-ups; every code whose
bound reaches the best found is ranked exactly on the original vector, so that no neighbour is lost.
"""

from __future__ import annotations

import zlib
from collections.abc import Iterator
from dataclasses import dataclass

import numpy as np
import pyarrow as pa
from pyspark.sql import Column, DataFrame, Window
from pyspark.sql import functions as F
from pyspark.sql import types as T

from .common import materialize


@dataclass(frozen=True)
class Index:
    """sample: rows that code books are fitted on, those with the smallest hash of vec_id; every row is indexed.

    dims: dimensions of a subspace (16 centres each); threshold: cosine above which scores matter, which sets
    the weight of the parallel residual; rerank: best codes of each query and block that are ranked exactly first,
    which sets the score that the bound of any other code must reach to be ranked too.
    """

    sample: int = 8192
    dims: int = 2
    threshold: float = 0.2
    steps: int = 8
    rerank: int = 100
    code_rows: int = 8192
    query_rows: int = 128
    #: Pairs of a block of codes and one of queries that a task gets before there are more groups than tasks.
    pairs: int = 64


def valid_vectors(df: DataFrame, vec_id: str = "vec_id", embedding: str = "embedding") -> DataFrame:
    """(vec_id, v): vectors of finite components, not all zero, with an id."""
    v = F.col(embedding).cast("array<double>")
    fine = F.forall(v, lambda x: x.isNotNull() & ~F.isnan(x) & (F.abs(x) < float("inf"))) & F.exists(v, lambda x: x != 0)
    return df.where(F.col(vec_id).isNotNull() & F.col(embedding).isNotNull()).where(fine).select(F.col(vec_id).cast("long").alias("vec_id"), F.col(embedding).alias("v"))


#: Ranges of hashes that are counted to choose a sample.
RANGES = 1 << 12


def hashed_sample(good: DataFrame, rows: int) -> DataFrame:
    """The rows with the smallest hashes of vec_id. Hashes beyond the range that holds the last of them are dropped where they
    are read: a task's best rows would otherwise all go to the driver, from every task as many as the whole sample has."""
    part = F.shiftright(F.xxhash64("vec_id"), 64 - RANGES.bit_length() + 1)
    counted = sorted(good.groupBy(part.alias("part")).count().collect())  # at most RANGES rows
    upto, last = 0, None
    for last, n in counted:
        upto += n
        if upto >= rows:
            break
    return good.where(part <= F.lit(last)).orderBy(F.xxhash64("vec_id"), "vec_id", "v").limit(rows)


def near_one(x: np.ndarray) -> np.ndarray:
    """Vectors times powers of two, so that their largest components lie between a half and one: squares neither under- nor
    overflow, and no other digit of a vector or of a cosine changes."""
    x = np.asarray(x, np.float64)
    _, power = np.frexp(np.abs(x).max(axis=1, keepdims=True, initial=0))
    return np.ldexp(x, -power)


def eta(d: int, threshold: float) -> float:
    """Weight of the parallel residual against the orthogonal one for unit vectors in d dimensions."""
    return max(1.0, (d - 1) * threshold**2 / (1 - threshold**2))


class Quantiser:
    def __init__(self, d: int, index: Index, centres: np.ndarray | None = None):
        self.index, self.d = index, d
        self.m = -(-d // index.dims)
        self.h = eta(d, index.threshold)
        self.centres = centres  # [m, 16, dims]

    def split(self, x: np.ndarray) -> np.ndarray:
        """Unit vectors as [n, m, dims], zeros after the last dimension."""
        x = near_one(x)
        x = x / np.linalg.norm(x, axis=1, keepdims=True)
        out = np.zeros((len(x), self.m * self.index.dims), np.float64)
        out[:, : self.d] = x
        return out.reshape(len(x), self.m, self.index.dims)

    def assign(self, x: np.ndarray, rounds: int = 2) -> np.ndarray:
        """Codes of least anisotropic loss: nearest centres first, then one subspace after the other given the rest."""
        n = len(x)
        apart = ((x[:, :, None, :] - self.centres[None]) ** 2).sum(3)  # [n, m, 16]
        along = (x[:, :, None, :] * (x[:, :, None, :] - self.centres[None])).sum(3)  # residual's part along the vector
        code = apart.argmin(2)
        rows = np.arange(n)
        total = np.take_along_axis(along, code[:, :, None], 2)[:, :, 0].sum(1)
        for _ in range(rounds):
            for j in range(self.m):
                rest = total - along[rows, j, code[:, j]]
                loss = apart[:, j] + (self.h - 1) * (rest[:, None] + along[:, j]) ** 2
                code[:, j] = loss.argmin(1)
                total = rest + along[rows, j, code[:, j]]
        return code

    def fit(self, x: np.ndarray) -> None:
        """Alternate codes and centres on the sample; a centre solves its weighted least-squares problem."""
        x = self.split(x)
        n, m, k = x.shape
        place = np.linspace(0, n - 1, 16).astype(int)
        self.centres = np.stack([x[np.lexsort((x[:, j, -1], x[:, j, 0]))[place], j] for j in range(m)])
        for step in range(self.index.steps):
            code = self.assign(x, 0 if step < self.index.steps // 2 else 1)
            along = np.stack([(x[:, j] * (x[:, j] - self.centres[j][code[:, j]])).sum(1) for j in range(m)], 1)
            total = along.sum(1)
            for j in range(m):
                for c in range(16):
                    own = code[:, j] == c
                    if not own.any():
                        continue
                    y, rest = x[own, j], (total - along[:, j])[own]
                    h = self.h - 1 if step >= self.index.steps // 2 else 0.0
                    left = len(y) * np.eye(k) + h * y.T @ y
                    right = y.sum(0) + h * ((rest + (y**2).sum(1))[:, None] * y).sum(0)
                    self.centres[j, c] = np.linalg.solve(left + 1e-9 * np.eye(k), right)

    def encode(self, x: np.ndarray) -> tuple[np.ndarray, np.ndarray]:
        """Two codes a byte, and how far at most a cosine with the vector lies from its approximate one: the
        residual's norm, with what the float sums of scores may lose."""
        x = self.split(x)
        code = self.assign(x)
        off = np.sqrt(((x - self.centres[np.arange(self.m), code]) ** 2).sum((1, 2))) + 1e-6 * (self.m + 1)
        off = np.where(np.isfinite(off), off, np.inf).astype(np.float32)
        code = code.astype(np.uint8)
        if self.m % 2:
            code = np.concatenate([code, np.zeros((len(code), 1), np.uint8)], 1)
        return code[:, 0::2] << 4 | code[:, 1::2], off

    def scores(self, queries: np.ndarray, codes: np.ndarray) -> np.ndarray:
        """Approximate cosines [queries, codes]: a look-up in one table of 256 sums for each byte of codes."""
        q = self.split(queries)
        table = np.einsum("qmk,mck->qmc", q, self.centres).astype(np.float32)
        if self.m % 2:
            table = np.concatenate([table, np.zeros((len(q), 1, 16), np.float32)], 1)
        pairs = (table[:, 0::2, :, None] + table[:, 1::2, None, :]).reshape(len(q), -1, 256)
        out = np.zeros((len(q), len(codes)), np.float32)
        for j in range(pairs.shape[1]):
            out += pairs[:, j][:, codes[:, j]]
        return out


def best(scores: np.ndarray, ids: np.ndarray, rows: np.ndarray, own: np.ndarray, k: int) -> list[np.ndarray]:
    """For each query the places of its k best codes of other rows than its own, ties to smaller ids."""
    out = []
    for row, me in zip(scores, own):
        row = np.where(rows == me, -np.inf, row)
        if len(row) > k:
            least = np.partition(row, len(row) - k)[len(row) - k]
            at = np.flatnonzero(row >= least)
        else:
            at = np.arange(len(row))
        at = at[np.lexsort((ids[at], -row[at]))][:k]
        out.append(at[np.isfinite(row[at])])
    return out


def dots(x: np.ndarray, y: np.ndarray) -> np.ndarray:
    """Inner products by column of [d, n] in double precision, summed from the first component to the last."""
    out = np.zeros(y.shape[1])
    for p, q in zip(x, y):
        out += p * q
    return out


def exact_best(q: np.ndarray, others: np.ndarray, near: np.ndarray, first: np.ndarray, off: np.ndarray, ids: np.ndarray, x: np.ndarray, norms: np.ndarray, k: int) -> tuple[np.ndarray, np.ndarray]:
    """Places and exact cosines of the k of the other vectors [n, d] nearest to q, ties to smaller ids.

    The k-th best of the places first is a score that the k-th best of all doesn't fall below. A vector whose
    approximate score near falls short of it by more than off cannot be among the best; all others are ranked.
    """
    def cosines(at: np.ndarray) -> np.ndarray:
        return dots(q, np.ascontiguousarray(x[at].T, np.float64)) / (np.sqrt(dots(q[:, None], q[:, None])) * norms[at])

    least = -np.inf
    if len(first) >= k:
        known = cosines(first)
        least = np.partition(np.where(np.isnan(known), -np.inf, known), len(known) - k)[len(known) - k]
    at = np.flatnonzero(~(near + off < least) & others)
    score = cosines(at)
    top = np.lexsort((ids[at], -np.where(np.isnan(score), np.inf, score)))[:k]
    return at[top], score[top]


def nearest(vectors: DataFrame, queries: Column, k: int = 5, index: Index = Index()) -> DataFrame:
    """(query_id, rank, vec_id, score): the k nearest by cosine for every row of vectors where queries holds.

    Vectors that are null, zero or hold null or non-finite components take no part, nor rows without vec_id,
    nor vectors whose dimension isn't the most common one (of equally common ones the largest). Every row is a
    candidate for all other rows: of rows that share a vec_id each may be found, and each that asks has its own ranks.
    All candidates, if fewer than k; an empty table gives no rows.
    A query block meets each block of codes once, with the vectors beside the codes, and keeps the k exactly best
    of it with ties to smaller vec_id: near copies in any number displace nothing. Other columns are ignored.
    """
    spark = vectors.sparkSession
    good = materialize(valid_vectors(vectors).withColumn("row", F.monotonically_increasing_id()))
    dims = good.groupBy(F.size("v").alias("d")).count().orderBy(F.desc("count"), F.desc("d")).first()
    none = "query_id long, rank int, vec_id long, score double"
    if dims is None:
        return spark.createDataFrame([], none)
    d = dims["d"]
    good = good.where(F.size("v") == d)
    sample = hashed_sample(good, index.sample).toPandas()
    quantiser = Quantiser(d, index)
    quantiser.fit(np.stack(sample["v"].to_numpy()).astype(np.float64))
    shared = spark.sparkContext.broadcast(quantiser.centres)  # 16 * d numbers
    asked = good.where(queries)
    n, n_queries = good.count(), asked.count()
    wide = np.float32 if isinstance(good.schema["v"].dataType.elementType, T.FloatType) else np.float64
    code_blocks, query_blocks = -(-n // index.code_rows), max(1, -(-n_queries // index.query_rows))

    def encode(batches: Iterator[pa.RecordBatch]) -> Iterator[pa.RecordBatch]:
        q = Quantiser(d, index, shared.value)
        held = []

        def flush():
            i, r, c, e, x = (np.concatenate(part) for part in zip(*held))
            held.clear()
            return pa.RecordBatch.from_arrays([pa.array([zlib.crc32(r[:1].tobytes())], pa.int64()), *(pa.array([part.tobytes()]) for part in (i, r, c, e, x))], names=["g", "ids", "rows", "codes", "off", "v"])

        for batch in batches:
            for at in range(0, batch.num_rows, 4096):
                part = batch.slice(at, 4096)
                x = part.column(2).flatten().to_numpy(zero_copy_only=False).reshape(-1, d).astype(wide)
                x = near_one(x) if wide is np.float64 else x
                held.append((part.column(0).to_numpy(), part.column(1).to_numpy(), *q.encode(x.astype(np.float64)), x))
                if sum(len(h[0]) for h in held) >= index.code_rows:
                    yield flush()
        if held:
            yield flush()

    def block(batches: Iterator[pa.RecordBatch]) -> Iterator[pa.RecordBatch]:
        for batch in batches:
            for at in range(0, batch.num_rows, index.query_rows):
                part = batch.slice(at, index.query_rows)
                x = part.column(2).flatten().to_numpy(zero_copy_only=False).astype(np.float64)
                x = near_one(x.reshape(-1, d)).ravel() if wide is np.float64 else x  # squares of single floats fit as they are
                yield pa.RecordBatch.from_arrays([pa.array([part.column(0).to_numpy().tobytes()]), pa.array([part.column(1).to_numpy().tobytes()]), pa.array([x.tobytes()])], names=["asks", "own", "x"])

    def scan(batches: Iterator[pa.RecordBatch]) -> Iterator[pa.RecordBatch]:
        q = Quantiser(d, index, shared.value)
        for batch in batches:
            for row in range(batch.num_rows):
                asks, own, q_x, ids, rows, codes, off, x = (np.frombuffer(c[row].as_buffer(), kind) for c, kind in zip(batch.columns, (np.int64, np.int64, np.float64, np.int64, np.int64, np.uint8, np.float32, wide)))
                q_x, x = q_x.reshape(-1, d), x.reshape(-1, d)
                s = q.scores(q_x, codes.reshape(len(ids), -1))
                each = np.ascontiguousarray(x.T, np.float64)
                norms = np.sqrt(dots(each, each))
                first = best(s, ids, rows, own, max(index.rerank, k))
                found = [exact_best(q_x[i], rows != own[i], s[i], first[i], off, ids, x, norms, k) for i in range(len(own))]
                n = [len(at) for at, _ in found]
                yield pa.RecordBatch.from_arrays(
                    [pa.array(np.repeat(asks, n)), pa.array(np.repeat(own, n)), pa.array(ids[np.concatenate([at for at, _ in found])]), pa.array(np.concatenate([score for _, score in found]))],
                    names=["query_id", "own", "vec_id", "score"],
                )

    parts = max(1, min(code_blocks, int(spark.conf.get("spark.sql.shuffle.partitions"))))
    codes = good.select("vec_id", "row", "v").repartition(parts).mapInArrow(encode, "g long, ids binary, rows binary, codes binary, off binary, v binary")
    blocks = asked.select("vec_id", "row", "v").repartition(max(1, query_blocks // 4)).mapInArrow(block, "asks binary, own binary, x binary")
    # the stated queries against all rows, on a grid: each block of codes goes once to each group of query blocks and
    # each block of queries once to each group of code blocks. The grid has as many cells as keep all tasks busy, and
    # its sides are such that the least is sent
    tasks = 4 * max(spark.sparkContext.defaultParallelism, int(spark.conf.get("spark.sql.shuffle.partitions")))
    cells = max(1, min(tasks, max(8, -(-code_blocks * query_blocks // index.pairs))))
    down = min(query_blocks, max(1, round((cells * 2 * n_queries / n) ** 0.5)))
    across = min(code_blocks, -(-cells // down))
    codes = materialize(codes).withColumn("a", F.pmod("g", F.lit(across)).cast("int")).withColumn("b", F.explode(F.sequence(F.lit(0), F.lit(down - 1))))
    blocks = materialize(blocks).withColumn("b", F.pmod(F.crc32("own"), F.lit(down)).cast("int")).withColumn("a", F.explode(F.sequence(F.lit(0), F.lit(across - 1))))
    found = blocks.join(codes.hint("merge"), ["a", "b"]).select("asks", "own", "x", "ids", "rows", "codes", "off", codes["v"]).mapInArrow(scan, "query_id long, own long, vec_id long, score double")
    rank = F.row_number().over(Window.partitionBy("own").orderBy(F.desc("score"), "vec_id"))
    return found.withColumn("rank", rank).where(F.col("rank") <= k).select("query_id", F.col("rank").cast("int").alias("rank"), "vec_id", "score")
