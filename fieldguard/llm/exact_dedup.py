"""Exact deduplication by Patricia-trie owners.

Texts are normalised, equal ones are combined where they are read, and the rest are dealt by length and
content hash. Each partition inserts the full byte strings into a compressed radix trie; a terminal node
holds the owner, so equality is decided on bytes and never on a digest alone. A trie that outgrows its
allowance spills whole subtrees, as rows that the next round deals to twice as many partitions, through the
shared folder: nothing is kept on a machine of its own.
"""

from __future__ import annotations

import hashlib
from collections.abc import Iterator

import pyarrow as pa
from pyspark.sql import DataFrame
from pyspark.sql import functions as F

from .common import claim, materialize, partitions_for, slices, text_bytes, tidied

#: [\x20\x09-\x0D]
WHITE = b" \t\n\x0b\x0c\r"
#: Bytes that one trie holds before subtrees are spilled.
TRIE_BYTES = 64 << 20
#: Bytes that the combining step before the shuffle holds before it passes them on.
COMBINE_BYTES = 16 << 20
#: What a node takes beside its label.
NODE_BYTES = 450


class Node:
    """label: the bytes on the edge to this node; owner: (-code points, doc_id or None, count) at a terminal;
    spilled: the subtree is gone, and what belongs to it goes after it."""

    __slots__ = ("label", "next", "owner", "spilled")

    def __init__(self, label: bytes, owner=None):
        self.label, self.next, self.owner, self.spilled = label, {}, owner, False


def common_prefix(a: bytes, b: bytes, at: int) -> int:
    """How many bytes a shares with b from its place at."""
    low, high = 0, min(len(a), len(b) - at)
    while low < high:
        mid = (low + high + 1) // 2
        if a[low:mid] == b[at + low : at + mid]:
            low = mid
        else:
            high = mid - 1
    return low


def better(a: tuple, b: tuple) -> tuple:
    """The owner of equal texts: most code points, then smallest doc_id (null last); counts add up."""
    first = min(a, b, key=lambda o: (o[0], o[1] is None, o[1] or 0))
    return first[0], first[1], a[2] + b[2]


class PatriciaTrie:
    """A radix tree over byte strings with a bound on what it keeps in memory."""

    def __init__(self, most: int = TRIE_BYTES):
        self.root, self.most, self.held = Node(b""), most, 0

    def insert(self, key: bytes, owner: tuple) -> list[tuple[bytes, tuple]]:
        """Adds a key; returns the (key, owner) that the trie no longer holds and never saw the end of."""
        node, at = self.root, 0
        while at < len(key):
            child = node.next.get(key[at])
            if child is None:
                node.next[key[at]] = Node(key[at:], owner)
                self.held += len(key) - at + NODE_BYTES
                break
            label = child.label
            if key.startswith(label, at):
                if child.spilled:
                    return [(key, owner)]
                node, at = child, at + len(label)
                continue
            same = common_prefix(label, key, at)
            upper = Node(label[:same])
            node.next[key[at]] = upper
            child.label = label[same:]
            upper.next[child.label[0]] = child
            node, at = upper, at + same
            self.held += NODE_BYTES
        else:
            node.owner = owner if node.owner is None else better(node.owner, owner)
        return self._spill() if self.held > self.most else []

    def _spill(self) -> list[tuple[bytes, tuple]]:
        """Takes subtrees, the largest first, from under the first node that branches, until half of the allowance is free."""
        node, prefix = self.root, b""
        while node.owner is None and len(node.next) == 1:
            (node,) = node.next.values()
            if node.spilled:
                return []
            prefix += node.label
        sizes = {k: sum(len(n.label) + NODE_BYTES for n, _ in self._nodes(c, b"")) for k, c in node.next.items() if not c.spilled}
        out = []
        for k in sorted(sizes, key=sizes.get, reverse=True):
            if self.held <= self.most // 2:
                break
            child = node.next[k]
            out += self._walk(child, prefix)
            node.next[k] = Node(child.label[:1])  # whatever goes this way goes after it
            node.next[k].spilled = True
            self.held -= sizes[k] - 1 - NODE_BYTES
        return out

    @staticmethod
    def _nodes(top: Node, prefix: bytes) -> Iterator[tuple[Node, bytes]]:
        stack = [(top, prefix)]
        while stack:
            node, prefix = stack.pop()
            yield node, prefix
            stack += [(n, prefix + node.label) for n in node.next.values()]

    @classmethod
    def _walk(cls, top: Node, prefix: bytes) -> Iterator[tuple[bytes, tuple]]:
        for node, before in cls._nodes(top, prefix):
            if node.owner is not None:
                yield before + node.label, node.owner

    def items(self) -> Iterator[tuple[bytes, tuple]]:
        """All (key, owner) that the trie holds; empties it."""
        root, self.root, self.held = self.root, Node(b""), 0
        yield from self._walk(root, b"")


_OWNERS = pa.schema([("text", pa.binary()), ("sha", pa.binary()), ("size", pa.int64()), ("points", pa.int64()), ("owner", pa.int64()), ("n", pa.int64())])


def _emit(items: Iterator[tuple[bytes, tuple]], with_text: bool) -> Iterator[pa.RecordBatch]:
    rows, held = [], 0
    for key, (points, owner, n) in items:
        rows.append((key if with_text else None, hashlib.sha256(key).digest(), len(key), -points, owner, n))
        held += len(key) * with_text + 100
        if held > 4 << 20:
            yield pa.RecordBatch.from_arrays([pa.array(c, f.type) for c, f in zip(zip(*rows), _OWNERS)], schema=_OWNERS)
            rows, held = [], 0
    if rows:
        yield pa.RecordBatch.from_arrays([pa.array(c, f.type) for c, f in zip(zip(*rows), _OWNERS)], schema=_OWNERS)


def _combine(batches: Iterator[pa.RecordBatch]) -> Iterator[pa.RecordBatch]:
    claim("exact_dedup", lambda: None)
    trie = PatriciaTrie(4 * COMBINE_BYTES)
    for batch in slices(batches):
        for doc_id, text, points in zip(*(c.to_pylist() for c in batch.columns)):
            yield from _emit(iter(trie.insert(text.translate(None, WHITE), (-points, doc_id, 1))), True)
        if trie.held > COMBINE_BYTES:
            yield from _emit(trie.items(), True)
    yield from _emit(trie.items(), True)


def _own(most: int):
    """Owners without their texts; what had to be spilled, with its text."""

    def run(batches: Iterator[pa.RecordBatch]) -> Iterator[pa.RecordBatch]:
        trie = PatriciaTrie(most)

        def spilled(batch: pa.RecordBatch) -> Iterator[tuple[bytes, tuple]]:
            for text, points, owner, n in zip(*(batch.column(i).to_pylist() for i in range(4))):
                yield from trie.insert(text, (-points, owner, n))

        for batch in slices(batches):
            yield from _emit(spilled(batch), True)
        yield from _emit(trie.items(), False)

    return run


def _digest(batches: Iterator[pa.RecordBatch]) -> Iterator[pa.RecordBatch]:
    for batch in slices(batches):
        i = batch.schema.get_field_index("text")
        shas = [hashlib.sha256(t.translate(None, WHITE)).digest() for t in batch.column(i).to_pylist()]
        names = [n for n in batch.schema.names if n != "text"]
        yield pa.RecordBatch.from_arrays([batch.column(n) for n in names] + [pa.array(shas, pa.binary())], names=[*names, "sha"])


def _rows(docs: DataFrame) -> DataFrame:
    return docs.select(F.col("doc_id").cast("long").alias("doc_id"), text_bytes().alias("text"), F.length(F.coalesce("text", F.lit(""))).cast("long").alias("points"))


def text_owners(docs: DataFrame, most: int = TRIE_BYTES) -> DataFrame:
    """(sha, size, keep_id, keep_points, group_size): one row for each distinct normalised text.

    Tries hold at most so many bytes, or one text. Two different texts with one SHA-256 would stop the job with a
    clear error instead of being merged.
    """
    schema = "text binary, sha binary, size long, points long, owner long, n long"
    n = partitions_for(docs.sparkSession, docs.agg(F.sum(F.octet_length("text"))).first()[0] or 0)
    left, settled = _rows(docs).mapInArrow(tidied(_combine), schema), None
    while True:
        part = materialize(left.repartition(n, "size", "sha").select("text", "points", "owner", "n").mapInArrow(tidied(_own(most)), schema))
        own = part.where("text is null").drop("text")
        settled = own if settled is None else settled.union(own)
        left = part.where("text is not null")
        if left.isEmpty():
            break
        n *= 2
    owners = settled.groupBy("sha").agg(F.max("size").alias("size"), F.max("owner").alias("keep_id"), F.max("points").alias("keep_points"), F.max("n").alias("group_size"), F.count("*").alias("texts"))
    return owners.select("sha", "size", F.when(F.col("texts") > 1, F.raise_error(F.lit("two texts share a SHA-256"))).otherwise(F.col("keep_id")).alias("keep_id"), "keep_points", "group_size")


def _decided(docs: DataFrame) -> DataFrame:
    """(doc_id, points, sha, keep_id, group_size, kept) for every row of docs."""
    rows = _rows(docs).mapInArrow(tidied(_digest), "doc_id long, points long, sha binary")
    kept = F.col("doc_id").eqNullSafe(F.col("keep_id")) & (F.col("points") == F.col("keep_points"))
    return rows.join(text_owners(docs), "sha").select("doc_id", "points", "sha", "keep_id", "group_size", kept.alias("kept"))


def exact_dedup(docs: DataFrame) -> DataFrame:
    """(doc_id, keep_id, group_size, kept, text_sha256) for every row of docs.

    Texts are equal when identical without [\\x20\\x09-\\x0D]; null counts as empty. The row with most code
    points in the original text, then the smallest doc_id (null after all others), stays. Of rows repeated
    with one doc_id each counts in group_size; kept is true on the rows that have both the keep_id and as many code
    points as the owner, which are one row unless rows are repeated as a whole. Other columns are ignored. One
    shuffle of one text for each distinct content and reading task, and one join of doc_id and digest, whose hot
    keys Spark splits.
    """
    return _decided(docs).select("doc_id", "keep_id", "group_size", "kept", F.lower(F.hex("sha")).alias("text_sha256"))


def drop_copies(docs: DataFrame) -> DataFrame:
    """The rows of docs that stay, with their columns; of rows repeated as a whole, one.

    What stays is decided on narrow rows; whole rows then meet these decisions in one join.
    """
    names = docs.columns
    stay = materialize(_decided(docs).where("kept").groupBy(F.col("doc_id").alias("k_id"), F.col("points").alias("k_points"), F.col("sha").alias("k_sha")).agg(F.count("*").alias("k_n")))
    rows = docs.mapInArrow(tidied(_with_digest(docs)), docs.withColumn("fg_sha", F.lit(b"")).schema)
    same = (F.col("fg_sha") == F.col("k_sha")) & F.col("doc_id").cast("long").eqNullSafe(F.col("k_id")) & (F.length(F.coalesce("text", F.lit(""))) == F.col("k_points"))
    kept = rows.join(stay, same)
    single, several = kept.where("k_n = 1"), kept.where("k_n > 1")
    if stay.where("k_n > 1").isEmpty():
        return single.select(*names)
    return single.select(*names).unionByName(several.dropDuplicates(["fg_sha"]).select(*names))


def _with_digest(docs: DataFrame):
    def run(batches: Iterator[pa.RecordBatch]) -> Iterator[pa.RecordBatch]:
        for batch in slices(batches):
            texts = batch.column(batch.schema.get_field_index("text")).cast(pa.binary()).to_pylist()
            shas = [hashlib.sha256((t or b"").translate(None, WHITE)).digest() for t in texts]
            yield pa.RecordBatch.from_arrays([*batch.columns, pa.array(shas, pa.binary())], names=[*batch.schema.names, "fg_sha"])

    return run
