"""Line deduplication by two Bloom filters: lines seen once, and lines seen twice.

Every task marks the lines of its documents; the marks of a segment of the filters meet in one task, which sees
which lines were marked before. Only lines that the second filter holds are suspected to repeat; they alone are
shuffled, as whole keys, and counted exactly. A filter errs on the side of suspicion, so no repeated line is missed and
no other one is dropped, however full the filters are.
"""

from __future__ import annotations

import zlib
from array import array
from collections.abc import Iterator
from dataclasses import dataclass

import numpy as np
import pyarrow as pa
import xxhash
from pyspark.sql import Column, DataFrame
from pyspark.sql import functions as F
from pyspark.sql import types as T

from .common import claim, discard, materialize, slices, tidied

#: [\x20\x09-\x0D]
WHITE = b" \t\n\x0b\x0c\r"
#: Bits of a segment of a filter; segments are built apart from one another.
SEGMENT = 1 << 17
#: Hashes, and bytes of keys, that a task holds before it passes them on.
HELD, HELD_BYTES = 1 << 20, 8 << 20
#: Copies of each frequent key that a key's lines are dealt over where keys are joined in a shuffle.
SALTS = 16


@dataclass(frozen=True)
class Rules:
    """A line's key is the line without white space at its ends, A-Z in lower case. Keys of at least min_chars code points
    that min_docs documents hold lose their lines; with keep_first the first of them (least doc_id, nulls last, then least
    place) stays.

    bits: bits of a filter for each line; filter_bytes: most bytes of the second filter as it is broadcast, where a larger
    one is folded, which makes more lines suspected and changes no result; key_bytes: most bytes of frequent keys that are
    broadcast, where more are joined in a shuffle.
    """

    min_docs: int = 10
    min_chars: int = 1
    keep_first: bool = False
    bits: int = 16
    filter_bytes: int = 32 << 20
    key_bytes: int = 8 << 20


def line_keys(raw: bytes) -> list[bytes]:
    """The keys of a text's lines in order; bytes.lower touches A-Z alone."""
    return [line.strip(WHITE) for line in raw.lower().split(b"\n")]


def _long_enough(keys: set[bytes], rules: Rules) -> set[bytes]:
    if rules.min_chars <= 1:
        keys.discard(b"")
        return keys
    return {k for k in keys if len(k) >= rules.min_chars and len(k.decode("utf-8", "replace")) >= rules.min_chars}


def _texts(batches: Iterator[pa.RecordBatch]) -> Iterator[tuple[pa.RecordBatch, list[bytes]]]:
    for part in slices(batches):
        yield part, [x or b"" for x in part.column(part.schema.get_field_index("text")).cast(pa.binary()).to_pylist()]


def _places(h: np.ndarray, segments: int) -> tuple[np.ndarray, np.ndarray]:
    """The segment of each hash and its two bits in it, as [n, 2]."""
    bits = np.stack([(h >> np.uint64(30)) & np.uint64(SEGMENT - 1), (h >> np.uint64(47)) & np.uint64(SEGMENT - 1)], 1)
    return (h & np.uint64(segments - 1)).astype(np.int64), bits.astype(np.uint32)


def _marker(segments: int, rules: Rules):
    """Rows (segment, once, twice): the bits of the lines of a task's documents, and of those that several of them hold."""
    def flush(held: array) -> pa.RecordBatch:
        h, n = np.unique(np.frombuffer(held, np.uint64), return_counts=True)
        segment, bits = _places(h, segments)
        order = np.argsort(segment, kind="stable")
        segment, bits, n = segment[order], bits[order], n[order]
        cuts = np.flatnonzero(np.diff(segment, prepend=-1))
        once, twice = [], []
        for a, b in zip(cuts, [*cuts[1:], len(segment)]):
            once.append(bits[a:b].tobytes())
            twice.append(bits[a:b][n[a:b] > 1].tobytes())
        return pa.RecordBatch.from_arrays([pa.array(segment[cuts], pa.int64()), pa.array(once, pa.binary()), pa.array(twice, pa.binary())], names=["segment", "once", "twice"])

    def run(batches: Iterator[pa.RecordBatch]) -> Iterator[pa.RecordBatch]:
        held = array("Q")
        for _, texts in _texts(batches):
            for raw in texts:
                held.extend(map(xxhash.xxh3_64_intdigest, _long_enough(set(line_keys(raw)), rules)))
            if len(held) >= HELD:
                yield flush(held)
                held = array("Q")
        if held:
            yield flush(held)

    return tidied(run)


def _twice(table: pa.Table) -> pa.Table:
    """A segment of the second filter: the bits of lines marked when all their bits were marked before."""
    once, twice = np.zeros(SEGMENT, bool), np.zeros(SEGMENT, bool)
    for a, b in zip(table["once"].to_pylist(), table["twice"].to_pylist()):
        bits = np.frombuffer(a, np.uint32).reshape(-1, 2)
        twice[bits[once[bits].all(1)]] = True
        once[bits] = True
        twice[np.frombuffer(b, np.uint32)] = True
    return pa.table({"segment": table["segment"].slice(0, 1), "bits": pa.array([zlib.compress(np.packbits(twice).tobytes(), 1)], pa.binary())})


def _folded(table: pa.Table) -> pa.Table:
    out = np.zeros(SEGMENT // 8, np.uint8)
    for b in table["bits"].to_pylist():
        out |= np.frombuffer(zlib.decompress(b), np.uint8)
    return pa.table({"segment": table["segment"].slice(0, 1), "bits": pa.array([zlib.compress(out.tobytes(), 1)], pa.binary())})


def seen_twice(docs: DataFrame, rules: Rules = Rules()) -> tuple[int, list[tuple[int, bytes]]]:
    """The second filter: its number of segments, and the compressed bits of those that have any; at most filter_bytes."""
    lines = docs.agg(F.sum(F.length("text") - F.length(F.replace(F.col("text"), F.lit("\n"))) + 1)).first()[0] or 0
    segments = 64
    while segments * SEGMENT < lines * rules.bits and segments < 1 << 30:
        segments *= 2
    marked = docs.select("text").mapInArrow(_marker(segments, rules), "segment long, once binary, twice binary")
    found = marked.groupBy("segment").applyInArrow(_twice, "segment long, bits binary")
    most = 1
    while most * 2 * SEGMENT // 8 <= rules.filter_bytes:
        most *= 2
    if segments > most:
        found = found.select((F.col("segment") % most).alias("segment"), "bits").groupBy("segment").applyInArrow(_folded, "segment long, bits binary")
        segments = most
    return segments, [(r["segment"], bytes(r["bits"])) for r in found.toLocalIterator()]


_FILTERS: dict[int, np.ndarray] = {}


def _filter(shipped) -> np.ndarray:
    """[segments, bytes] of a broadcast filter, made once in a worker."""
    claim("line_dedup", _FILTERS.clear)
    if shipped.id not in _FILTERS:
        _FILTERS.clear()
        segments, parts = shipped.value
        bits = np.zeros((segments, SEGMENT // 8), np.uint8)
        for s, b in parts:
            bits[s] = np.frombuffer(zlib.decompress(b), np.uint8)
        _FILTERS[shipped.id] = bits
    return _FILTERS[shipped.id]


class Shipped:
    """A broadcast with an id that workers know it by."""

    def __init__(self, spark, value):
        self._value = spark.sparkContext.broadcast(value)
        self.id = id(self._value)

    @property
    def value(self):
        return self._value.value


def _suspected(keys: list[bytes], bits: np.ndarray) -> list[bytes]:
    """The keys that the second filter holds."""
    if not keys:
        return keys
    segment, at = _places(np.fromiter(map(xxhash.xxh3_64_intdigest, keys), np.uint64, len(keys)), len(bits))
    held = (bits[segment[:, None], at >> 3] >> (7 - (at & 7)).astype(np.uint8)) & 1
    return [keys[i] for i in np.flatnonzero(held.all(1))]


def _counter(shipped, rules: Rules):
    """Rows (key, docs, first): the suspected keys of a task, in how many of its documents each is, and its first place."""
    first = pa.struct([("unknown", pa.bool_()), ("doc_id", pa.int64()), ("line", pa.int64())])
    schema = pa.schema([("key", pa.binary()), ("docs", pa.int64()), ("first", first)])

    def flush(held: dict) -> pa.RecordBatch:
        places = [dict(zip(("unknown", "doc_id", "line"), f)) if f else None for _, f in held.values()]
        return pa.RecordBatch.from_arrays([pa.array(list(held), pa.binary()), pa.array([n for n, _ in held.values()], pa.int64()), pa.array(places, first)], schema=schema)

    def run(batches: Iterator[pa.RecordBatch]) -> Iterator[pa.RecordBatch]:
        bits, held, size = _filter(shipped), {}, 0
        for part, texts in _texts(batches):
            ids = part.column(0).to_pylist()
            for doc_id, raw in zip(ids, texts):
                lines = line_keys(raw)
                for key in _suspected(list(_long_enough(set(lines), rules)), bits):
                    place = (doc_id is None, doc_id or 0, lines.index(key)) if rules.keep_first else None
                    known = held.get(key)
                    if known is None:
                        size += len(key) + 100
                        held[key] = 1, place
                    else:
                        held[key] = known[0] + 1, min(known[1], place) if place else None
            if size > HELD_BYTES:
                yield flush(held)
                held, size = {}, 0
        if held:
            yield flush(held)

    return tidied(run)


def frequent_lines(docs: DataFrame, rules: Rules = Rules(), shipped: Shipped | None = None) -> DataFrame:
    """(key, docs, first): the keys to drop, in how many documents each is, and with keep_first the first place of each.
    A document with a line twice counts once; rows are documents, those of repeated ids as well."""
    shipped = shipped or Shipped(docs.sparkSession, seen_twice(docs, rules))
    counted = docs.select(F.col("doc_id").cast("long"), "text").mapInArrow(_counter(shipped, rules), "key binary, docs long, first struct<unknown:boolean,doc_id:bigint,line:bigint>")
    return counted.groupBy("key").agg(F.sum("docs").alias("docs"), F.min("first").alias("first")).where(F.col("docs") >= rules.min_docs)


def _cut(raw: bytes, drop) -> tuple[bytes, int, int]:
    """(what stays, lines, lines dropped); drop says of a place and a key whether the line goes."""
    lines = raw.split(b"\n")
    stay = [line for i, (line, key) in enumerate(zip(lines, line_keys(raw))) if not drop(i, key)]
    return b"\n".join(stay), len(lines), len(lines) - len(stay)


def _output(part: pa.RecordBatch, cut: list[tuple[bytes, int, int]], out: pa.Schema) -> pa.RecordBatch:
    at = out.get_field_index("text")
    columns = list(part.columns[: len(out) - 1])
    columns[at] = pa.array([c[0] for c in cut], pa.binary()).cast(pa.string(), safe=False)
    counts = pa.StructArray.from_arrays([pa.array([c[1] for c in cut], pa.int64()), pa.array([c[2] for c in cut], pa.int64())], names=["n_lines", "n_dropped"])
    return pa.RecordBatch.from_arrays([*columns, counts], names=out.names)


def _by_set(frequent, id_at: int):
    """Cuts texts by a broadcast dictionary of the frequent keys and their first places."""
    def run(batches: Iterator[pa.RecordBatch]) -> Iterator[pa.RecordBatch]:
        gone = frequent.value
        for part, texts in _texts(batches):
            ids = part.column(id_at).to_pylist()
            cut = [_cut(raw, lambda i, key, d=d: key in gone and gone[key] != (d, i)) for d, raw in zip(ids, texts)]
            yield _output(part, cut, pa.schema([*part.schema, ("fg_lines", pa.null())]))

    return tidied(run)


def _by_places(id_at: int):
    """Cuts texts at the places that the last column lists, but where they are a key's first and the row is its document."""
    def run(batches: Iterator[pa.RecordBatch]) -> Iterator[pa.RecordBatch]:
        for part, texts in _texts(batches):
            cut = []
            for d, raw, places in zip(part.column(id_at).to_pylist(), texts, part.column(part.num_columns - 1).to_pylist()):
                gone = {p["line"] for p in places or () if not p["stays"] or (None if p["stays"]["unknown"] else p["stays"]["doc_id"]) != d}
                cut.append(_cut(raw, lambda i, _, g=gone: i in g))
            yield _output(part, cut, pa.schema([*list(part.schema)[:-1], ("fg_lines", pa.null())]))

    return tidied(run)


def _finder(shipped):
    """Rows (line, key) for each suspected line of a text."""
    schema = pa.schema([("digest", pa.string()), ("line", pa.int32()), ("key", pa.binary())])

    def run(batches: Iterator[pa.RecordBatch]) -> Iterator[pa.RecordBatch]:
        bits = _filter(shipped)
        for part, texts in _texts(batches):
            rows = []
            for digest, raw in zip(part.column(0).to_pylist(), texts):
                lines = line_keys(raw)
                known = set(_suspected(list(set(lines)), bits))
                rows += [(digest, i, key) for i, key in enumerate(lines) if key in known]
            if rows:
                yield pa.RecordBatch.from_arrays([pa.array(c, f.type) for c, f in zip(zip(*rows), schema)], schema=schema)

    return tidied(run)


def _digest(text: Column) -> Column:
    return F.sha2(F.coalesce(text, F.lit("")), 256)


def drop_repeated_lines(docs: DataFrame, rules: Rules = Rules()) -> DataFrame:
    """docs with the lines of frequent keys cut from text, and fg_lines struct<n_lines, n_dropped>.

    Lines end at \\n; what stays is joined by \\n again, and is an empty text where nothing does. A null or empty text is one
    empty line, whose key is no key, so that it stays; a null comes out empty. Rows that repeat count as documents of
    their own and all lose the line, but with keep_first every row of the first doc_id keeps its line at the first place.
    Extra columns pass, whatever their names.
    """
    spark, own = docs.sparkSession, docs.select("doc_id", "text")
    shipped = Shipped(spark, seen_twice(own, rules))
    frequent = materialize(frequent_lines(own, rules, shipped))
    size = frequent.agg(F.sum(F.octet_length("key") + 64)).first()[0] or 0
    out = T.StructType([*[f if f.name != "text" else T.StructField("text", T.StringType()) for f in docs.schema], T.StructField("fg_lines", T.StructType([T.StructField("n_lines", T.LongType()), T.StructField("n_dropped", T.LongType())]))])
    if size <= rules.key_bytes:
        first = lambda f: (None if f["unknown"] else f["doc_id"], f["line"]) if f else None
        gone = spark.sparkContext.broadcast({bytes(r["key"]): first(r["first"]) for r in frequent.toLocalIterator()})
        discard(frequent)
        return docs.mapInArrow(_by_set(gone, docs.columns.index("doc_id")), out)
    # too many keys to broadcast: the suspected lines of each different text meet them in a shuffle
    lines = own.select(_digest(F.col("text")).alias("digest"), "text").mapInArrow(_finder(shipped), "digest string, line int, key binary")
    salted = frequent.select("key", "first", F.explode(F.sequence(F.lit(0), F.lit(SALTS - 1))).alias("salt"))
    found = lines.withColumn("salt", F.pmod(F.xxhash64("digest"), F.lit(SALTS)).cast("int")).join(salted, ["key", "salt"])
    stays = F.when(F.col("first.line") == F.col("line"), F.struct(F.col("first.unknown").alias("unknown"), F.col("first.doc_id").alias("doc_id")))  # where this place is a key's first
    places = found.groupBy(F.col("digest").alias("fg_digest")).agg(F.collect_set(F.struct("line", stays.alias("stays"))).alias("fg_places"))
    named = docs.withColumn("fg_digest", _digest(F.col("text"))).join(places, "fg_digest", "left")
    return named.select(*docs.columns, "fg_places").mapInArrow(_by_places(docs.columns.index("doc_id")), out)


def line_dedup(docs: DataFrame, rules: Rules = Rules()) -> DataFrame:
    """(doc_id, n_lines, n_dropped, kept_sha256) of every row."""
    kept = drop_repeated_lines(docs.select("doc_id", "text"), rules)
    return kept.select("doc_id", "fg_lines.n_lines", "fg_lines.n_dropped", F.sha2("text", 256).alias("kept_sha256"))


#: The same over the table documents, lines as rows.
ORACLE = r"""
WITH d AS (SELECT doc_id, row_number() OVER () AS n, string_split(coalesce(text, ''), chr(10)) AS lines FROM documents),
l AS (SELECT n, unnest(lines) AS line, generate_subscripts(lines, 1) AS place FROM d),
k AS (SELECT *, translate(regexp_replace(regexp_replace(line, '^[\x20\x09-\x0D]+', ''), '[\x20\x09-\x0D]+$', ''), 'ABCDEFGHIJKLMNOPQRSTUVWXYZ', 'abcdefghijklmnopqrstuvwxyz') AS key FROM l),
f AS (SELECT key FROM k WHERE key <> '' GROUP BY key HAVING count(DISTINCT n) >= 10),
c AS (SELECT n, count(*) AS dropped FROM k WHERE key IN (SELECT key FROM f) GROUP BY n),
s AS (SELECT n, string_agg(line, chr(10) ORDER BY place) AS kept FROM k WHERE key NOT IN (SELECT key FROM f) GROUP BY n)
SELECT doc_id, len(lines)::BIGINT AS n_lines, coalesce(dropped, 0)::BIGINT AS n_dropped, sha256(coalesce(kept, '')) AS kept_sha256
FROM d LEFT JOIN c USING (n) LEFT JOIN s USING (n)"""
