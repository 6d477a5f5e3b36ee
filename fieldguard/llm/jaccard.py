"""N-gram Jaccard join by universe-partition pigeonhole.

Two sets with Jaccard similarity >= t differ in at most H elements, H fixed by t and their sizes. Within a size
band the universe of shingles is hashed into m > H segments, so at least one segment of such a pair holds the
same subset in both sets (or, with its allowance of one, subsets one deletion apart). Each set indexes the
subsets of its segments; which of them it probes with is allocated by cost: those whose shingles are rarest in
a count sketch of the whole corpus, until the allowances exceed H. Candidates are verified on the full sets.

Copies (equal sets) are one node, known by a number of its own. In a bucket of equal signatures every member is
first compared with one centre; only members whose components still differ are compared among themselves, so that
a group of near copies costs its size and not its square, and no link between components is lost.

Sets hold 64-bit hashes of shingles, and verification is exact on these: two different shingles share a hash with a
chance of 2**-64 a pair, so a set's size or a link can be off by one shingle in about one of 10**12 sets of ordinary
size. Words of over 64 bytes are hashed by BLAKE2, shorter ones by polynomials of random coefficients.
"""

from __future__ import annotations

import hashlib
import math
import re
from collections.abc import Iterator
from dataclasses import dataclass

import numpy as np
import pyarrow as pa
from pyspark.sql import DataFrame
from pyspark.sql import functions as F

from .common import compact, connected_components, discard, materialize, slices, text_bytes, tidied

#: Texts handled at once by a worker, by bytes; one longer text is handled alone.
CHUNK_BYTES = 1 << 20
#: Counters of the corpus sketch: a fixed number whatever the corpus.
SKETCH = 1 << 18
#: Counters that travel together.
SKETCH_PART = 1 << 14
#: Parts of a component that are named apart.
SALTS = 8
#: Bits of the parity sketch whose Hamming distance bounds the symmetric difference of two sets from below.
PARITY_WORDS = 16


@dataclass(frozen=True)
class Join:
    """words in a shingle; similarity >= num / den; bands grow by 2; slack: segments beyond those required."""

    words: int = 5
    num: int = 75
    den: int = 100
    slack: float = 0.10
    #: One segment in this many also indexes its one-deletion neighbourhood.
    deletions: int = 16


def mix64(x: np.ndarray) -> np.ndarray:
    """A bijective scrambling of 64-bit integers."""
    x = (x ^ (x >> np.uint64(31))) * np.uint64(0x9E3779B97F4A7C15)
    x = (x ^ (x >> np.uint64(29))) * np.uint64(0xD6E8FEB86659FD93)
    return x ^ (x >> np.uint64(32))


#: Bytes of joined texts that are hashed at once.
HASH_BLOCK = 1 << 20
#: Bytes of a word above which it is hashed on its own.
LONG_WORD = 64
_SPACE = re.compile(rb"[\x20\x09-\x0D]")
_IN_WORD = np.ones(256, bool)
_IN_WORD[[0x20, 0x09, 0x0A, 0x0B, 0x0C, 0x0D]] = False
_OF_BYTE = mix64(np.arange(1, 257, dtype=np.uint64) * np.uint64(0x9E3779B97F4A7C15))
_BASE = 0xD1342543DE82EF95


def _powers(base: int, n: int) -> np.ndarray:
    out = np.full(n, base, np.uint64)
    out[0] = 1
    return np.multiply.accumulate(out)


_POWER = _powers(_BASE, HASH_BLOCK + (1 << 12)), _powers(pow(_BASE, -1, 1 << 64), HASH_BLOCK + (1 << 12))


def word_hashes(data: bytes) -> tuple[np.ndarray, np.ndarray]:
    """(starts, hashes) of the words of data, which ends with white space; from a prefix sum of byte values by place."""
    starts, hashes, at = [np.zeros(0, np.int64)], [np.zeros(0, np.uint64)], 0
    while at < len(data):
        end = min(at + HASH_BLOCK, len(data))
        end = _SPACE.search(data, end - 1).end()  # a word is never cut
        b = np.frombuffer(data, np.uint8, end - at, at)
        inside = _IN_WORD[b]
        edge = np.flatnonzero(np.diff(inside, prepend=False))
        first, after = edge[0::2], edge[1::2]
        up, down = _POWER if len(b) < len(_POWER[0]) else (_powers(_BASE, len(b) + 1), _powers(pow(_BASE, -1, 1 << 64), len(b) + 1))
        total = np.concatenate([np.zeros(1, np.uint64), np.cumsum(_OF_BYTE[b] * up[: len(b)])])
        n = after - first
        h = mix64((total[after] - total[first]) * down[first] + n.astype(np.uint64))
        for i in np.flatnonzero(n > LONG_WORD):
            h[i] = np.frombuffer(hashlib.blake2b(data[at + first[i] : at + after[i]], digest_size=8).digest(), "<u8")[0]
        starts.append(first + at)
        hashes.append(h)
        at = end
    return np.concatenate(starts), np.concatenate(hashes)


def shingles(texts: list[bytes], k: int) -> tuple[np.ndarray, np.ndarray]:
    """(hashes, bounds): the sorted distinct k-word shingles of text i are hashes[bounds[i]:bounds[i + 1]]."""
    data = b"".join([t.lower() + b"\n" for t in texts])  # of bytes: A-Z only, and white space is exactly \x20 and \x09-\x0D
    starts, h = word_hashes(data)
    first = np.searchsorted(starts, np.cumsum([0, *[len(t) + 1 for t in texts]]))
    whole = np.zeros(len(h), np.uint64)
    padded = np.concatenate([h, np.zeros(k, np.uint64)])
    for j in range(k):
        whole = mix64(whole * np.uint64(0x2545F4914F6CDD1D) + padded[j : j + len(h)])
    sets = []
    for a, b in zip(first.tolist(), first[1:].tolist()):
        n = b - a
        if n >= k:
            x = np.sort(whole[a : b - k + 1])
            new = np.ones(len(x), bool)
            new[1:] = x[1:] != x[:-1]
            sets.append(x[new])
        elif n:  # fewer words: the whole sequence is the only one
            acc = np.array([n], np.uint64)
            for x in h[a:b]:
                acc = mix64(acc * np.uint64(0x2545F4914F6CDD1D) + x)
            sets.append(acc)
        else:
            sets.append(whole[:0])
    return np.concatenate([whole[:0], *sets]), np.cumsum([0, *map(len, sets)])


def chunked(batches: Iterator[pa.RecordBatch]) -> Iterator[dict[str, list]]:
    for part in slices(batches, 1 << 14, CHUNK_BYTES):
        yield {n: part.column(i).to_pylist() for i, n in enumerate(part.schema.names)}


def most_apart(a: int, b: int, join: Join) -> int:
    """The largest symmetric difference of two sets of these sizes that link."""
    return (a + b) * (join.den - join.num) // (join.den + join.num)


def band_of(n: np.ndarray) -> np.ndarray:
    return np.ceil(np.log2(np.maximum(n, 1))).astype(np.int64)


def segments_of(band: int, join: Join) -> int:
    """Segments of the sets with up to hi = 2 ** band shingles, enough for any partner of at least their size.

    0 stands for one segment for each shingle: in small bands, where fewer would often be empty.
    """
    hi = 1 << int(band)
    if hi <= 64:
        return 0
    return math.ceil((most_apart(hi, hi * join.den // join.num, join) + 1) * (1 + join.slack)) + 2


def signatures(sets: np.ndarray, bounds: np.ndarray, cost_of: np.ndarray, join: Join) -> tuple[np.ndarray, np.ndarray, int]:
    """(signatures, place of their set, sets whose allowances do not exceed H).

    Bit 0 of a signature is set on those that probe; those without are index only. Sets probe in their own
    band and in the one below it, where partners down to num / den of their size lie.
    """
    sizes = np.diff(bounds)
    sigs, owners, lacking = [np.zeros(0, np.uint64)], [np.zeros(0, np.int64)], 0
    cost_shingle = cost_of[(sets >> np.uint64(20)) % np.uint64(SKETCH)]
    for lower in (0, 1):
        bands = band_of(sizes) - lower
        reach = (sizes > 0) & (bands >= 0)
        if lower:
            reach &= sizes * join.num <= join.den * (1 << np.maximum(bands, 0))
        for band in np.unique(bands[reach]):
            m = segments_of(band, join)
            chosen = np.flatnonzero(reach & (bands == band))
            here = sizes[chosen]
            doc = np.repeat(np.arange(len(chosen)), here)
            at = np.repeat(bounds[chosen] - np.concatenate([[0], np.cumsum(here)[:-1]]), here) + np.arange(here.sum())
            x, cost = sets[at], cost_shingle[at]
            scrambled = mix64(x)
            salt = mix64(np.array([band + 1], np.uint64))[0]
            if m:
                seg = (mix64(x ^ np.uint64(0xA5A5A5A5)) % np.uint64(m)).astype(np.int64)
                order = np.lexsort((cost, doc * m + seg))
                doc, seg, cost, scrambled = doc[order], seg[order], cost[order], scrambled[order]
                start = np.flatnonzero(np.concatenate([[True], (doc[1:] != doc[:-1]) | (seg[1:] != seg[:-1])]))
                count = np.diff(np.append(start, len(doc)))
                total = np.add.reduceat(scrambled, start)  # a subset is known by the sum of its scrambled shingles
                d, s, rare = doc[start], seg[start], cost[start]
                salts = mix64(s.astype(np.uint64) * np.uint64(64) + salt)
                dense = np.flatnonzero((s < max(1, m // join.deletions)) & (count > 1))
                second = cost[start[dense] + 1]  # what is left when the rarest goes
            else:
                total, d, rare, salts, dense, second = scrambled, doc, cost, salt, np.zeros(0, np.int64), np.zeros(0, np.int64)
            exact = mix64(total ^ salts) & ~np.uint64(1)
            # allocation: the cheapest allowances first until they exceed H
            hi = np.minimum(here, 1 << int(band))
            need = (here + hi) * (join.den - join.num) // (join.den + join.num) + 1
            item_doc, item_cost = np.concatenate([d, d[dense]]), np.concatenate([rare, second])
            order = np.lexsort((item_cost, item_doc))
            have = np.bincount(item_doc, minlength=len(chosen))
            rank = np.empty(len(order), np.int64)
            rank[order] = np.arange(len(order)) - np.repeat(np.cumsum(have) - have, have)
            taken = rank < need[item_doc]
            lacking += int((have < need).sum())
            probe, near = taken[: len(d)].copy(), taken[len(d) :]
            probe[dense[near]] = True
            keep = probe if lower else slice(None)  # only a set's own band indexes it
            sigs.append((exact | probe.astype(np.uint64))[keep])
            owners.append(chosen[d[keep]])
            use = dense[near] if lower else dense
            if len(use):
                flags = np.repeat(near[near] if lower else near, count[use])
                member = np.repeat(start[use] - np.concatenate([[0], np.cumsum(count[use])[:-1]]), count[use]) + np.arange(count[use].sum())
                of = np.repeat(use, count[use])
                sigs.append((mix64((total[of] - scrambled[member]) ^ salts[of]) & ~np.uint64(1)) | flags.astype(np.uint64))
                owners.append(chosen[d[of]])
    return np.concatenate(sigs), np.concatenate(owners), lacking


def parity(x: np.ndarray) -> np.ndarray:
    """Bits that say which of 64 * PARITY_WORDS classes hold an odd number of shingles."""
    odd = np.bincount((x % np.uint64(64 * PARITY_WORDS)).astype(np.int64), minlength=64 * PARITY_WORDS) & 1
    return np.packbits(odd.astype(np.uint8)).view(np.uint64)


_FIRST = pa.schema([("doc_id", pa.int64()), ("n", pa.int64()), ("key", pa.binary()), ("bits", pa.binary())])


def _keys(k: int):
    """Pass one: (doc_id, n, key, parity bits) for each row and, with n < 0, the task's share of the corpus sketch in bits."""

    def run(batches: Iterator[pa.RecordBatch]) -> Iterator[pa.RecordBatch]:
        sketch = np.zeros(SKETCH, np.int64)
        for x in chunked(batches):
            sets, b = shingles(x["text"], k)
            sketch += np.bincount(((sets >> np.uint64(20)) % np.uint64(SKETCH)).astype(np.int64), minlength=SKETCH)
            own = [sets[b[i] : b[i + 1]] for i in range(len(x["text"]))]
            keys = [hashlib.blake2b(s.tobytes(), digest_size=16).digest() for s in own]
            rows = x["doc_id"], np.diff(b), keys, [parity(s).tobytes() for s in own]
            yield pa.RecordBatch.from_arrays([pa.array(c, f.type) for c, f in zip(rows, _FIRST)], schema=_FIRST)
        used = [i for i in range(SKETCH // SKETCH_PART) if sketch[i * SKETCH_PART : (i + 1) * SKETCH_PART].any()]
        rows = [None] * len(used), [-1 - i for i in used], [None] * len(used), [sketch[i * SKETCH_PART : (i + 1) * SKETCH_PART].astype("<i8").tobytes() for i in used]
        yield pa.RecordBatch.from_arrays([pa.array(c, f.type) for c, f in zip(rows, _FIRST)], schema=_FIRST)

    return run


def _sum_sketches(key, table):
    total = np.zeros(SKETCH_PART, np.int64)
    for bits in table.column("bits").to_pylist():
        total += np.frombuffer(bits, "<i8")
    return pa.table({"n": pa.array([key[0].as_py()], pa.int64()), "bits": pa.array([total.tobytes()], pa.binary())})


def _emit_signatures(cost, join: Join, buckets: int):
    """(bucket, sigs, at, ids): packed signatures of a chunk of sets, and the sets whose ids they are."""

    def run(batches: Iterator[pa.RecordBatch]) -> Iterator[pa.RecordBatch]:
        cost_of = np.frombuffer(cost.value, np.int64)
        for x in chunked(batches):
            sets, b = shingles(x["text"], join.words)
            ids = np.array(x["node"], np.int64)
            sig, own, lacking = signatures(sets, b, cost_of, join)
            bucket = (sig >> np.uint64(48)) % np.uint64(buckets)
            order = np.argsort(bucket, kind="stable")
            sig, own, bucket = sig[order], own[order], bucket[order]
            cuts = np.searchsorted(bucket, np.arange(buckets + 1).astype(np.uint64))
            rows = []
            for i in np.flatnonzero(np.diff(cuts)):
                part = sig[cuts[i] : cuts[i + 1]]
                members, at = np.unique(own[cuts[i] : cuts[i + 1]], return_inverse=True)
                low = np.ascontiguousarray(part.astype("<u8").view(np.uint8).reshape(-1, 8)[:, :6]).tobytes()  # the bucket has the high bits
                rows.append((int(i), low + (part >> np.uint64(48)).astype("<u2").tobytes(), at.astype("<u4").tobytes(), ids[members].tobytes()))
            if lacking:
                rows.append((-1, b"", b"", b""))
            yield pa.RecordBatch.from_arrays([pa.array(c, t) for c, t in zip(zip(*rows), _PACKED.types)] if rows else [pa.array([], t) for t in _PACKED.types], schema=_PACKED)

    return run


_PACKED = pa.schema([("bucket", pa.int32()), ("sigs", pa.binary()), ("at", pa.binary()), ("ids", pa.binary())])
_GROUPS = pa.schema([("g", pa.int64()), ("node", pa.int64()), ("probe", pa.bool_())])


def _groups(key, table):
    """(g, node, probe): sets with equal signatures, at least one probing; groups of the same members once and under
    one g. A null row: a set lacked allowances."""
    if key[0].as_py() < 0:
        return pa.table([pa.array([None], t) for t in _GROUPS.types], schema=_GROUPS)
    sigs, ids = [], []
    for sig, at, own in zip(*(table.column(n).to_pylist() for n in ("sigs", "at", "ids"))):
        n = len(sig) // 8
        whole = np.zeros((n, 8), np.uint8)
        whole[:, :6] = np.frombuffer(sig, np.uint8, 6 * n).reshape(n, 6)
        whole[:, 6:] = np.frombuffer(sig, np.uint8, 2 * n, 6 * n).reshape(n, 2)
        sigs.append(whole.view("<u8").ravel())
        ids.append(np.frombuffer(own, np.int64)[np.frombuffer(at, "<u4")])
    sig, own = np.concatenate(sigs), np.concatenate(ids)
    del sigs, ids
    order = np.lexsort((own, sig >> np.uint64(1)))
    sig, own = sig[order], own[order]
    key, flag = sig >> np.uint64(1), (sig & np.uint64(1)).astype(bool)
    new_sig = np.concatenate([[True], key[1:] != key[:-1]])
    start = np.flatnonzero(new_sig | np.concatenate([[True], own[1:] != own[:-1]]))
    flag = np.logical_or.reduceat(flag, start)
    key, own = key[start], own[start]
    start = np.flatnonzero(np.concatenate([[True], key[1:] != key[:-1]]))
    count = np.diff(np.append(start, len(key)))
    members = np.add.reduceat(mix64(own.astype(np.uint64)), start)
    found: dict[tuple[int, int], list] = {}
    for i in np.flatnonzero((count > 1) & np.logical_or.reduceat(flag, start)):
        a, n = start[i], count[i]
        have = found.setdefault((int(members[i]), int(n)), [own[a : a + n], np.zeros(n, bool)])
        have[1] |= flag[a : a + n]
    if not found:
        return pa.table([pa.array([], t) for t in _GROUPS.types], schema=_GROUPS)
    n = np.array([k[1] for k in found], np.uint64)
    g = mix64(np.array([k[0] for k in found], np.uint64) + n * np.uint64(0x9E3779B97F4A7C15)).astype(np.int64)
    cols = np.repeat(g, n.astype(np.int64)), np.concatenate([v[0] for v in found.values()]), np.concatenate([v[1] for v in found.values()])
    return pa.table([pa.array(c, t) for c, t in zip(cols, _GROUPS.types)], schema=_GROUPS)


def _plausible(pairs: DataFrame, reps: DataFrame, join: Join) -> DataFrame:
    """(a, b, n): those of pairs (a, b) that sizes and parity bits allow to link; n is the size of b."""
    of = lambda c: reps.select(F.col("node").alias(c), F.col("n").alias(f"n_{c}"), F.col("bits").alias(f"bits_{c}"))

    def run(batches: Iterator[pa.RecordBatch]) -> Iterator[pa.RecordBatch]:
        for batch in batches:
            n_a, n_b = batch.column("n_a").to_numpy(), batch.column("n_b").to_numpy()
            bits = [np.frombuffer(b"".join(batch.column(f"bits_{c}").to_pylist()), np.uint64).reshape(batch.num_rows, -1) for c in "ab"]
            most = (n_a + n_b) * (join.den - join.num) // (join.den + join.num)
            fine = (np.abs(n_a - n_b) <= most) & (np.bitwise_count(bits[0] ^ bits[1]).sum(1) <= most)
            yield batch.select(["a", "b", "n_b"]).rename_columns(["a", "b", "n"]).filter(pa.array(fine))

    return pairs.join(of("a"), "a").join(of("b"), "b").select("a", "b", "n_a", "n_b", "bits_a", "bits_b").mapInArrow(run, "a long, b long, n long")


#: Members of one centre, and shingles of theirs, that a verifying task takes at once.
STAR = 512
STAR_SHINGLES = 1 << 21
#: Of the bitmap of wanted documents, at most 2 ** MOST_BITS bits.
MOST_BITS = 27


def _verified(pairs: DataFrame, rows: int, reps: DataFrame, docs: DataFrame, join: Join, partitions: int) -> DataFrame:
    """(a, b): those of pairs (a, b, n), so many rows at most, whose full sets link. Each b's set goes to its a, in groups of bounded size, in
    which the centre's set is held and the members' pass by."""
    pairs = pairs.withColumn("salt", F.pmod(F.xxhash64("b"), F.lit(1 << 20)))
    sizes = pairs.groupBy("a").agg(F.ceil(F.greatest(F.count("*") / STAR, F.sum("n") / STAR_SHINGLES)).alias("salts"))
    to_b = pairs.join(sizes, "a").select(F.col("b").alias("node"), F.struct(F.col("a").alias("centre"), (F.col("salt") % F.col("salts")).cast("int").alias("salt")).alias("to"))
    to_a = sizes.select(F.col("a").alias("node"), F.explode(F.sequence(F.lit(0), F.col("salts").cast("int") - 1)).alias("salt")).select("node", F.struct(F.col("node").alias("centre"), "salt").alias("to"))
    wanted = materialize(compact(to_b.union(to_a), 2 * rows))
    need = reps.join(wanted.select("node").distinct(), "node", "left_semi").select("node", "rep", "key")
    # a bitmap of the wanted documents, of bounded size, spares the others the shuffle; the join decides
    n_bits = 1 << min(MOST_BITS, max(15, (16 * need.count()).bit_length()))
    place = lambda c: F.pmod(F.xxhash64(c), F.lit(n_bits))
    parts = need.select((place("rep") + 1).alias("h")).groupBy(F.bitmap_bucket_number("h").alias("part")).agg(F.bitmap_construct_agg(F.bitmap_bit_position("h")).alias("bits")).collect()
    bitmap = bytearray(n_bits // 8)
    for r in parts:
        at = (r["part"] - 1) * 4096
        bitmap[at : at + 4096] = r["bits"][: n_bits // 8 - at]
    bitmap = docs.sparkSession.sparkContext.broadcast(bytes(bitmap))

    def sets_of(batches):
        bits = np.frombuffer(bitmap.value, np.uint8)

        def wanted_only():
            for batch in batches:
                h = batch.column("h").to_numpy()
                yield batch.filter(pa.array((bits[(h >> 3)] >> (h & 7).astype(np.uint8)) & 1 == 1))

        for x in chunked(wanted_only()):
            sets, b = shingles(x["text"], join.words)
            own = [sets[b[i] : b[i + 1]].tobytes() for i in range(len(x["text"]))]
            keys = [hashlib.blake2b(s, digest_size=16).digest() for s in own]
            yield pa.RecordBatch.from_arrays([pa.array(x["doc_id"], pa.int64()), pa.array(keys, pa.binary()), pa.array(own, pa.binary())], names=["doc_id", "own_key", "set"])

    sets = docs.where("doc_id is not null").select("doc_id", place("doc_id").alias("h"), "text").mapInArrow(tidied(sets_of), "doc_id long, own_key binary, set binary")
    sets = sets.join(need, (F.col("doc_id") == F.col("rep")) & (F.col("own_key") == F.col("key"))).select("node", "set")
    dealt = wanted.join(sets, "node").select("to.centre", "to.salt", "node", "set").repartition(partitions, "centre", "salt").sortWithinPartitions("centre", "salt", F.col("node") != F.col("centre"))

    def decide(batches: Iterator[pa.RecordBatch]) -> Iterator[pa.RecordBatch]:
        at, x = None, np.zeros(0, np.uint64)  # the centre, which comes before its members, and its set
        for batch in batches:
            a, b = [], []
            for centre, node, own in zip(batch.column("centre").to_pylist(), batch.column("node").to_pylist(), batch.column("set")):
                y = np.frombuffer(own.as_buffer(), np.uint64)
                if node == centre:
                    at, x = centre, y.copy()
                elif at == centre:
                    both = int((x[np.minimum(np.searchsorted(x, y), len(x) - 1)] == y).sum())
                    if join.den * both >= join.num * (len(x) + len(y) - both):
                        a.append(centre)
                        b.append(node)
            yield pa.RecordBatch.from_arrays([pa.array(a, pa.int64()), pa.array(b, pa.int64())], names=["a", "b"])

    return materialize(dealt.mapInArrow(tidied(decide), "a long, b long"))


#: Members of a group that one task compares with each other at once.
BLOCK = 2048
#: Words of the parity sketch that are compared at first.
FIRST_WORDS = 4
def _compare(x: np.ndarray, y: np.ndarray, n: np.ndarray, bits: np.ndarray, component: np.ndarray, join: Join) -> Iterator[tuple[np.ndarray, np.ndarray, np.ndarray]]:
    """(members of x, of y, distance of their parity bits) for pairs in different components that sizes and parity allow to link."""
    x, y = x[np.argsort(n[x], kind="stable")], y[np.argsort(n[y], kind="stable")]
    sizes = n[y]
    for at in range(0, len(x), 128):
        p = x[at : at + 128]
        low, high = np.searchsorted(sizes, n[p[0]] * join.num // join.den), np.searchsorted(sizes, n[p[-1]] * join.den // join.num + 1, "right")
        q = y[low:high]
        most = (n[p][:, None] + n[q][None]) * (join.den - join.num) // (join.den + join.num)
        apart = np.zeros((len(p), len(q)), np.int32)
        for w in range(FIRST_WORDS):
            apart += np.bitwise_count(bits[p, w][:, None] ^ bits[q, w][None])
        i, j = np.nonzero((apart <= most) & (component[p][:, None] != component[q][None]))
        apart, most = apart[i, j], most[i, j]
        apart = apart + np.bitwise_count(bits[p[i], FIRST_WORDS:] ^ bits[q[j], FIRST_WORDS:]).sum(1)
        fine = (apart <= most) & (np.abs(n[p[i]] - n[q[j]]) <= most)
        yield p[i[fine]], q[j[fine]], apart[fine]


#: Members of a group up to which groups are compared many at once.
SMALL = 64


def _small_groups(starts: np.ndarray, sizes: np.ndarray, cols: dict[str, np.ndarray], bits: np.ndarray, join: Join) -> Iterator[tuple[np.ndarray, np.ndarray, np.ndarray]]:
    """(places, places, distance of parity bits) as _compare gives them, for all groups of few members."""
    n, component, probe = cols["n"], cols["component"], cols["probe"]
    for size in np.unique(sizes):
        i, j = np.triu_indices(size, 1)
        own = starts[sizes == size]
        step = max(1, (1 << 20) // max(1, len(i)))
        for at in range(0, len(own), step):
            p, q = ((own[at : at + step, None] + k[None]).ravel() for k in (i, j))
            most = (n[p] + n[q]) * (join.den - join.num) // (join.den + join.num)
            fine = (component[p] != component[q]) & (probe[p] | probe[q]) & (np.abs(n[p] - n[q]) <= most)
            p, q, most = p[fine], q[fine], most[fine]
            apart = np.bitwise_count(bits[p] ^ bits[q]).sum(1).astype(np.int64)
            fine = apart <= most
            yield p[fine], q[fine], apart[fine]


def _large_group(at: np.ndarray, i: int, j: int, cols: dict[str, np.ndarray], bits: np.ndarray, join: Join) -> Iterator[tuple[np.ndarray, np.ndarray, np.ndarray]]:
    """The same for one group, or two of its blocks."""
    block, probe = cols["block"][at], cols["probe"][at]
    _, of = np.unique(cols["component"][at], return_inverse=True)
    largest = of == np.bincount(of).argmax()  # most are in one component, whose members needn't be compared with each other
    for left, right in ((i, j), (j, i)) if i != j else ((i, i),):
        asks = probe & (block == left)
        for x, y in ((asks & largest, (block == right) & ~largest), (asks & ~largest, block == right)):
            for p, q, apart in _compare(np.flatnonzero(x), np.flatnonzero(y), cols["n"][at], bits[at], of, join):
                once = ~(probe[p] & probe[q] & (p > q))  # where both ask the pair comes twice
                yield at[p[once]], at[q[once]], apart[once].astype(np.int64)


#: Pairs that a comparing task holds before it thins them out or passes them on.
HELD_PAIRS = 1 << 18


def _nearest(pairs: list[np.ndarray], component: np.ndarray, keep: int) -> tuple[list[np.ndarray], np.ndarray]:
    """The pairs (p, q, distance, group) that are among the keep nearest of one of their components within the group, and
    the groups that have others. Thinning parts out first doesn't change what is left of the whole."""
    p, q, apart, group = pairs
    both, of, near = np.concatenate([group, group]), component[np.concatenate([p, q])], np.concatenate([apart, apart])
    order = np.lexsort((near, of, both))
    first = np.ones(len(order), bool)
    first[1:] = (both[order][1:] != both[order][:-1]) | (of[order][1:] != of[order][:-1])
    rank = np.arange(len(order)) - np.maximum.accumulate(np.where(first, np.arange(len(order)), 0))
    kept = np.zeros(len(p), bool)
    if len(p):
        kept[order[rank < keep] % len(p)] = True
    return [x[kept] for x in pairs], np.unique(group[~kept])


def _near(keep: int | None, join: Join):
    """(g, a, b, n, more) of rows sorted by group and blocks: pairs of a block of one group, or of two of its blocks, that
    the sizes and parity bits allow to link: in different components, one of them probing. Of the pairs of each
    component the keep nearest, all for None; more says that the group has others."""
    names = ("g", "i", "j", "node", "n", "component", "probe", "block")

    def pairs_of(table: pa.Table) -> Iterator[pa.RecordBatch]:
        cols = {c: table.column(c).to_numpy() for c in names}
        bits = np.frombuffer(b"".join(table.column("bits").to_pylist()), np.uint64).reshape(len(cols["g"]), -1)
        new = np.flatnonzero(np.concatenate([[True], (cols["g"][1:] != cols["g"][:-1]) | (cols["i"][1:] != cols["i"][:-1]) | (cols["j"][1:] != cols["j"][:-1])]))
        sizes = np.diff(np.append(new, len(cols["g"])))
        few = (sizes <= SMALL) & (cols["i"][new] == cols["j"][new])
        node, n, held, more = cols["node"], cols["n"], [], np.zeros(len(new), bool)

        def batch(p, q, apart, group) -> pa.RecordBatch:
            out = cols["g"][p], np.maximum(node[p], node[q]), np.minimum(node[p], node[q]), np.where(node[p] < node[q], n[p], n[q]), more[group]
            return pa.RecordBatch.from_arrays([pa.array(c) for c in out], names=["g", "a", "b", "n", "more"])

        def joined() -> list[np.ndarray]:
            return [np.concatenate([np.zeros(0, np.int64), *c]) for c in zip(*held)] if held else [np.zeros(0, np.int64)] * 4

        def thinned() -> list[np.ndarray]:
            pairs = joined()
            if keep is not None:
                pairs, others = _nearest(pairs, cols["component"], keep)
                more[others] = True
            return pairs

        def groups() -> Iterator[Iterator[tuple]]:
            yield _small_groups(new[few], sizes[few], cols, bits, join)
            for start, size in zip(new[~few].tolist(), sizes[~few].tolist()):
                yield _large_group(np.arange(start, start + size), cols["i"][start], cols["j"][start], cols, bits, join)

        for found in groups():
            for p, q, apart in found:
                held.append((p, q, apart, np.searchsorted(new, p, "right") - 1))
                if sum(len(h[0]) for h in held) > HELD_PAIRS:
                    pairs = thinned()
                    held.clear()
                    if keep is None:
                        yield batch(*pairs)
                    else:
                        held.append(tuple(pairs))
            pairs = thinned()
            held.clear()
            yield batch(*pairs)

    def run(batches: Iterator[pa.RecordBatch]) -> Iterator[pa.RecordBatch]:
        held = None
        for batch in batches:
            held = pa.Table.from_batches([batch]) if held is None else pa.concat_tables([held, pa.Table.from_batches([batch])])
            key = [held.column(c).to_numpy() for c in ("g", "i", "j")]
            same = (key[0] == key[0][-1]) & (key[1] == key[1][-1]) & (key[2] == key[2][-1])
            last = int(np.argmax(same)) if len(same) else 0  # the last group may go on in the next batch
            if last:
                yield from pairs_of(held.slice(0, last))
                held = held.slice(last)
        if held is not None and held.num_rows:
            yield from pairs_of(held)

    return run


def _same_documents(rows: DataFrame, reps: DataFrame) -> DataFrame | None:
    """(a, b): nodes that share a doc_id, each with one of them; None where no doc_id has several texts."""
    several = rows.where("n > 0 and doc_id is not null").groupBy("doc_id").agg(F.min("key").alias("one"), F.max("key").alias("other")).where("one != other")
    several = materialize(several.select(F.col("doc_id").alias("s_id"), "one"))
    if several.isEmpty():
        return None
    pairs = rows.join(several, F.col("doc_id") == F.col("s_id")).where("n > 0 and key != one").select("key", "one").distinct()
    node = lambda k, as_: reps.select(F.col("key").alias(k), F.col("node").alias(as_))
    return materialize(pairs.join(node("key", "a"), "key").join(node("one", "b"), "one").select("a", "b"))


def similarity_classes(docs: DataFrame, join: Join = Join(), rounds: int = 4) -> DataFrame:
    """(doc_id, n_shingles, component_id) for every row of docs: see near_duplicates for the rules."""
    spark = docs.sparkSession
    docs = docs.select(F.col("doc_id").cast("long").alias("doc_id"), text_bytes().alias("text"))
    first = materialize(docs.mapInArrow(tidied(_keys(join.words)), "doc_id long, n long, key binary, bits binary"))
    rows = first.where("n >= 0").drop("bits")
    reps = first.where("n > 0").groupBy("key").agg(F.min("doc_id").alias("rep"), F.max("n").alias("n"), F.max("bits").alias("bits")).where("rep is not null")
    reps = materialize(compact(reps, first.count()).withColumn("node", F.monotonically_increasing_id()))
    counts = first.where("n < 0").select("n", "bits").groupBy("n").applyInArrow(_sum_sketches, "n long, bits binary").collect()  # SKETCH numbers in all
    cost = np.zeros(SKETCH, np.int64)
    for r in counts:
        cost[(-1 - r["n"]) * SKETCH_PART :][:SKETCH_PART] = np.frombuffer(r["bits"], "<i8")
    cost = spark.sparkContext.broadcast(cost.tobytes())
    total = reps.agg(F.sum("n")).first()[0] or 0
    partitions = max(int(spark.conf.get("spark.sql.shuffle.partitions")), -(-total // 3_000_000))
    while True:
        # where a doc_id has several texts each of them goes under each of its nodes, which adds candidates only
        texts = docs.join(reps.select("rep", "node"), docs["doc_id"] == F.col("rep")).select("node", "text")
        packed = texts.mapInArrow(tidied(_emit_signatures(cost, join, partitions)), "bucket int, sigs binary, at binary, ids binary")
        groups = materialize(packed.groupBy("bucket").applyInArrow(_groups, "g long, node long, probe boolean"))
        if groups.where("g is null").isEmpty():
            break
        discard(groups)
        join = Join(join.words, join.num, join.den, join.slack * 2 + 0.1, join.deletions)
    members = materialize(compact(groups.groupBy("g", "node").agg(F.max("probe").alias("probe")), groups.count()))
    discard(groups)
    # round one: one centre for each member, the first probing one of its groups
    centre = members.where("probe").groupBy("g").agg(F.min("node").alias("centre"))
    star = members.join(centre, "g").where("node != centre").groupBy("node").agg(F.min("centre").alias("centre"))
    star = star.select(F.col("centre").alias("a"), F.col("node").alias("b"))
    n = reps.count()
    edges = _verified(materialize(compact(_plausible(star, reps, join), n)), n, reps, docs, join, partitions)
    same = _same_documents(rows, reps)
    part = materialize(connected_components(edges if same is None else edges.union(same)))
    for turn in range(rounds):
        # groups in which several components are left, with what the bounds need
        g = members.join(part, "node", "left").withColumn("component", F.coalesce("component", "node"))
        apart = g.groupBy("g").agg(F.count("*").alias("size"), F.min("component").alias("c1"), F.max("component").alias("c2")).where("c1 != c2").select("g", F.ceil(F.col("size") / BLOCK).cast("int").alias("blocks"))
        open_ = materialize(compact(g.join(apart, "g").select("g", "node", "probe", "component", "blocks"), members.count()))
        if open_.isEmpty():
            break
        full = open_.join(reps.select("node", "n", "bits"), "node").withColumn("block", F.pmod(F.xxhash64("node"), F.col("blocks")).cast("int"))
        # each block meets itself and every other block of its group
        full = full.withColumn("j", F.explode(F.sequence(F.lit(0), F.col("blocks") - 1))).select("g", F.least("block", "j").alias("i"), F.greatest("block", "j").alias("j"), "node", "probe", "component", "n", "bits", "block")
        full = full.repartition(partitions, "g", "i", "j").sortWithinPartitions("g", "i", "j")  # few bytes but many comparisons: not to be coalesced
        # ever more of each component's nearest pairs, and in the last round all that are left
        near = materialize(full.mapInArrow(tidied(_near(8**turn if turn + 1 < rounds else None, join)), "g long, a long, b long, n long, more boolean"))
        found = _verified(near.select("a", "b", "n").distinct(), near.count(), reps, docs, join, partitions)
        before, part = part, materialize(connected_components(part.where("node != component").select(F.col("node").alias("a"), F.col("component").alias("b")).union(found)))
        # a group whose pairs have all been decided is done
        members = materialize(compact(open_.join(near.where("more").select("g").distinct(), "g", "left_semi").select("g", "node", "probe"), open_.count()))
        for done in (open_, near, found, before):
            discard(done)
    # one component may hold most sets: its smallest document goes to each of several parts of them
    low = part.join(reps.select("node", "rep"), "node").groupBy("component").agg(F.min("rep").alias("low")).withColumn("salt", F.explode(F.sequence(F.lit(0), F.lit(SALTS - 1))))
    named = reps.join(part, "node", "left").withColumn("salt", F.pmod(F.xxhash64("node"), F.lit(SALTS)).cast("int"))
    classes = named.join(low, ["component", "salt"], "left").select(F.col("key").alias("c_key"), F.coalesce("low", "rep").alias("component_id"))
    return rows.join(classes, (F.col("key") == F.col("c_key")) & (F.col("n") > 0), "left").select("doc_id", F.col("n").alias("n_shingles"), F.coalesce("component_id", "doc_id").alias("component_id"))


def near_duplicates(docs: DataFrame, join: Join = Join()) -> DataFrame:
    """(doc_id, n_shingles, component_id) for every row of docs.

    A text's set is its distinct shingles of join.words words; with fewer words, the whole sequence; a null
    text or one without words has an empty set, links with nothing and is its own component. Rows repeated
    with one doc_id count as one document for what is reachable, and each is a row of the result. A row with
    a null doc_id takes the component of its class, null where no doc_id is in it. Other columns are ignored.
    """
    return similarity_classes(docs, join)
