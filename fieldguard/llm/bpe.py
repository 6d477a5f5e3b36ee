"""Byte-level BPE encoding and decoding by prefix dynamic programming.

For every byte prefix of a piece exactly one token can end its encoding. The table keeps that token, so an
encoding is read off backwards, an append only adds entries, and an edit recomputes entries until they agree
with the old ones again.
"""

from __future__ import annotations

import base64
import hashlib
from itertools import chain

import numpy as np
import pyarrow as pa
from pyspark.sql import DataFrame
from pyspark.sql import functions as F

from .common import by_rows, claim, ship_file, text_bytes

NO_TOKEN = -1
#: Chunks, and characters or ids of chunks, above which a worker forgets all before the next slice of texts.
CACHE_ENTRIES = 200_000
CACHE_BYTES = 4 << 20
#: Pairs of tokens of which a worker knows whether one can follow the other.
STORED = 1 << 18
#: Bytes of a piece up to which pieces are encoded together; longer ones one by one.
TOGETHER = 64
#: The only pattern for which chunks between spaces may be encoded apart; others match texts as a whole.
CHUNKED = r"'s|'t|'re|'ve|'m|'ll|'d| ?\p{L}+| ?\p{N}+| ?[^\s\p{L}\p{N}]+|\s+(?!\S)|\s+"


def read_ranks(raw: bytes) -> dict[bytes, int]:
    """Ranks from the lines "base64 rank" of a .tiktoken file."""
    return {base64.b64decode(token): int(rank) for token, rank in map(bytes.split, raw.splitlines()) if token}


class IntMap:
    """An open-addressing table from int64 of at least 0 to int64, looked up by whole arrays."""

    def __init__(self, keys: np.ndarray, values: np.ndarray, room: int = 0):
        self.bits = max(4, (2 * max(room, len(keys))).bit_length())
        self.keys = np.full(1 << self.bits, -1, np.int64)
        self.values = np.zeros(1 << self.bits, np.int64)
        self.n = 0
        self.put(keys, values)

    def _home(self, keys: np.ndarray) -> np.ndarray:
        return ((keys.astype(np.uint64) * np.uint64(0x9E3779B97F4A7C15)) >> np.uint64(64 - self.bits)).astype(np.int64)

    def put(self, keys: np.ndarray, values: np.ndarray) -> None:
        """Adds distinct keys that aren't in the table."""
        at, self.n = self._home(keys), self.n + len(keys)
        while len(keys):
            free = self.keys[at] < 0
            self.keys[at[free]] = keys[free]
            mine = free & (self.keys[at] == keys)  # of several keys for one free place the last one has it
            self.values[at[mine]] = values[mine]
            keys, values, at = keys[~mine], values[~mine], (at[~mine] + 1) & (len(self.keys) - 1)

    def get(self, keys: np.ndarray, default: int) -> np.ndarray:
        out = np.full(len(keys), default, np.int64)
        at, open_ = self._home(keys), np.arange(len(keys))
        while len(open_):
            there = self.keys[at]
            hit = there == keys
            out[open_[hit]] = self.values[at[hit]]
            on = ~hit & (there >= 0)
            keys, open_, at = keys[on], open_[on], (at[on] + 1) & (len(self.keys) - 1)
        return out


class PrefixBPE:
    """Tables for encoding by ranks; a token's rank is its id and the order of its merge."""

    def __init__(self, ranks: dict[bytes, int]):
        self.ranks = ranks
        self.token = {i: t for t, i in ranks.items()}
        self.left: dict[int, int] = {}
        self.right: dict[int, int] = {}
        self.merge: dict[tuple[int, int], int] = {}
        self.unreachable: set[int] = set()
        for i in sorted(self.token):
            t = self.token[i]
            if len(t) < 2:
                continue
            for cut in range(1, len(t)):
                a, b = ranks.get(t[:cut], i), ranks.get(t[cut:], i)
                if a < i and b < i and a not in self.unreachable and b not in self.unreachable and self.stays(a, b):
                    self.left[i], self.right[i], self.merge[a, b] = a, b, i
                    break
            else:
                self.unreachable.add(i)
        self._automaton()

    def _automaton(self) -> None:
        """Aho-Corasick over the tokens that merges can make: edges, failure links, and for each state the
        tokens that end there, longest first."""
        self.edge: dict[int, int] = {}
        self.length = [0] * (max(self.token) + 1)
        states, own = [(0, 0)], [NO_TOKEN]  # (parent, byte) of each state
        for i, t in self.token.items():
            self.length[i] = len(t)
            if i in self.unreachable:
                continue
            at = 0
            for c in t:
                nxt = self.edge.get(at << 8 | c)
                if nxt is None:
                    nxt = self.edge[at << 8 | c] = len(states)
                    states.append((at, c))
                    own.append(NO_TOKEN)
                at = nxt
            own[at] = i
        depth = [0] * len(states)
        for at in range(1, len(states)):
            depth[at] = depth[states[at][0]] + 1
        self.fail = [0] * len(states)
        self.ends: list[tuple[int, ...]] = [()] * len(states)
        shorter = [0] * len(states)  # the longest state of a token that ends here besides the state's own
        for at in sorted(range(1, len(states)), key=depth.__getitem__):
            parent, c = states[at]
            up = self.fail[at] = self.follow(self.fail[parent], c) if parent else 0
            shorter[at] = up if own[up] != NO_TOKEN else shorter[up]
            ends = self.ends[up]
            self.ends[at] = ends if own[at] == NO_TOKEN else (own[at], *ends)
        # the same as arrays, for many pieces at once
        self.edges = IntMap(np.fromiter(self.edge.keys(), np.int64, len(self.edge)), np.fromiter(self.edge.values(), np.int64, len(self.edge)))
        self.fails, self.own, self.shorter, self.lengths = (np.array(x, np.int64) for x in (self.fail, own, shorter, self.length))
        self.fits = IntMap(np.zeros(0, np.int64), np.zeros(0, np.int64), STORED)

    def follow(self, state: int, c: int) -> int:
        while True:
            nxt = self.edge.get(state << 8 | c)
            if nxt is not None:
                return nxt
            if not state:
                return 0
            state = self.fail[state]

    def stays(self, x: int, y: int) -> bool:
        """Whether token y can follow token x: undoing their merges, latest first, no merge across them comes earlier."""
        before = len(self.token) + 1
        while True:
            across = self.merge.get((x, y))
            if across is not None and across < before:
                return False
            whole_x, whole_y = x not in self.left, y not in self.left
            if whole_x and whole_y:
                return True
            if not whole_x and (whole_y or x > y):
                before, x = x, self.right[x]
            else:  # among equal merges the left one comes first, hence one more
                before, y = y + 1, self.left[y]

    def fit(self, before: np.ndarray, i: np.ndarray) -> np.ndarray:
        """stays() for pairs of tokens, remembered."""
        keys = before << 24 | i
        known = self.fits.get(keys, -1)
        new = np.unique(keys[known < 0])
        if len(new):
            values = np.fromiter((self.stays(k >> 24, k & 0xFFFFFF) for k in new.tolist()), np.int64, len(new))
            known[known < 0] = values[np.searchsorted(new, keys[known < 0])]
            if self.fits.n + len(new) > STORED:
                self.fits = IntMap(np.zeros(0, np.int64), np.zeros(0, np.int64), STORED)
            if len(new) <= STORED:
                self.fits.put(new, values)
        return known.astype(bool)

    def last_token(self, state: int, end: int, last) -> int:
        """The only token that can end the encoding of a prefix of end bytes, given its state and last(shorter)."""
        for i in self.ends[state]:
            start = end - self.length[i]
            if not start or self.stays(last(start), i):
                return i
        raise ValueError("the ranks lack a byte of the text")

    def encode_pieces(self, pieces: list[bytes]) -> tuple[np.ndarray, np.ndarray]:
        """(ids of all pieces in order, how many each has) of matches of the splitting pattern; those of up to TOGETHER
        bytes in step."""
        single = np.fromiter((self.ranks.get(p, NO_TOKEN) for p in pieces), np.int64, len(pieces))
        sizes = np.fromiter(map(len, pieces), np.int64, len(pieces))
        rows, ids = [np.flatnonzero(single >= 0)], [single[single >= 0]]
        for n in np.flatnonzero((single < 0) & (sizes > TOGETHER)).tolist():
            own = PrefixTable(self, pieces[n]).ids()
            rows.append(np.full(len(own), n))
            ids.append(np.array(own, np.int64))
        rest = np.flatnonzero((single < 0) & (sizes <= TOGETHER) & (sizes > 0))
        rest = rest[np.argsort(-sizes[rest], kind="stable")]
        for at in range(0, len(rest), 1 << 13):
            part = rest[at : at + (1 << 13)]
            own, i = self._together([pieces[n] for n in part.tolist()], sizes[part])
            rows.append(part[own])
            ids.append(i)
        rows, ids = np.concatenate(rows), np.concatenate(ids)
        order = np.argsort(rows, kind="stable")
        return ids[order], np.bincount(rows, minlength=len(pieces))

    def _together(self, pieces: list[bytes], sizes: np.ndarray) -> tuple[np.ndarray, np.ndarray]:
        """(place of the piece, id) by the prefix tables of pieces, longest first, each piece's ids in order: one column
        of last tokens for each length of prefix."""
        wide = int(sizes[0])
        data = np.zeros((len(pieces), wide), np.uint8)
        data[np.arange(wide) < sizes[:, None]] = np.frombuffer(b"".join(pieces), np.uint8)
        last = np.full((wide + 1, len(pieces)), NO_TOKEN, np.int32)
        state = np.zeros(len(pieces), np.int64)
        for end in range(1, wide + 1):
            n = int(np.searchsorted(-sizes, -end, "right"))
            at, c = state[:n], data[:n, end - 1].astype(np.int64)
            to = self.edges.get(at << 8 | c, -1)
            lost = np.flatnonzero(to < 0)
            from_ = at[lost]
            while len(lost):
                lost, from_ = lost[from_ > 0], from_[from_ > 0]
                from_ = self.fails[from_]
                nxt = self.edges.get(from_ << 8 | c[lost], -1)
                to[lost] = nxt
                lost, from_ = lost[nxt < 0], from_[nxt < 0]
            state[:n] = to = np.maximum(to, 0)
            open_ = np.arange(n)
            ending = np.where(self.own[to] != NO_TOKEN, to, self.shorter[to])
            while len(open_):
                if not ending.all():
                    raise ValueError("the ranks lack a byte of the text")
                i = self.own[ending]
                start = end - self.lengths[i]
                fine = start == 0
                inner = np.flatnonzero(~fine)
                fine[inner] = self.fit(last[start[inner], open_[inner]].astype(np.int64), i[inner])
                last[end, open_[fine]] = i[fine]
                open_, ending = open_[~fine], self.shorter[ending[~fine]]
        # read off backwards, all pieces in step
        rows, end, steps = np.arange(len(pieces)), sizes.copy(), []
        while len(rows):
            i = last[end[rows], rows].astype(np.int64)
            steps.append((rows, i))
            end[rows] -= self.lengths[i]
            rows = rows[end[rows] > 0]
        rows, ids = np.concatenate([r for r, _ in steps[::-1]]), np.concatenate([i for _, i in steps[::-1]])
        order = np.argsort(rows, kind="stable")
        return rows[order], ids[order]

    def encode_piece(self, data: bytes) -> list[int]:
        """Ids of one match of the splitting pattern."""
        return self.encode_pieces([data])[0].tolist()

    def read_off(self, last: list[int]) -> list[int]:
        ids, end = [], len(last) - 1
        while end:
            ids.append(last[end])
            end -= self.length[last[end]]
        return ids[::-1]

    def decode(self, ids: list[int]) -> bytes:
        return b"".join([self.token[i] for i in ids])


class PrefixTable:
    """The encoding of one growing or edited piece: for each prefix its automaton state and its last token."""

    def __init__(self, bpe: PrefixBPE, data: bytes = b""):
        self.bpe, self.data, self.last, self.state = bpe, bytearray(), [NO_TOKEN], [0]
        self.append(data)

    def _extend(self, c: int) -> None:
        self.state.append(self.bpe.follow(self.state[-1], c))
        self.last.append(self.bpe.last_token(self.state[-1], len(self.last), self.last.__getitem__))

    def append(self, data: bytes) -> None:
        self.data += data
        for c in data:
            self._extend(c)

    def replace(self, start: int, stop: int, data: bytes) -> int:
        """Put data in the place of [start, stop); returns how many entries had to be made anew."""
        last, state, longest = self.last[stop + 1 :], self.state[stop + 1 :], max(self.bpe.length)
        self.data[start:stop] = data
        del self.last[start + 1 :], self.state[start + 1 :]
        agree = made = 0
        for end in range(start + 1, len(self.data) + 1):
            self._extend(self.data[end - 1])
            made += 1
            old = end - start - len(data) - 1
            agree = agree + 1 if old >= 0 and last[old] == self.last[-1] and state[old] == self.state[-1] else 0
            if agree >= longest:  # from here on both tables follow the same rule from the same entries
                self.last += last[old + 1 :]
                self.state += state[old + 1 :]
                break
        return made

    def ids(self) -> list[int]:
        """Ids as tiktoken gives them; a piece that is a token as a whole is that token."""
        if (i := self.bpe.ranks.get(bytes(self.data))) is not None:
            return [i]
        return self.bpe.read_off(self.last)


def gathered(values: np.ndarray, starts: np.ndarray, sizes: np.ndarray) -> np.ndarray:
    """The runs of values with these starts and sizes, one after the other."""
    upto = np.cumsum(sizes)
    return values[np.repeat(starts - upto + sizes, sizes) + np.arange(upto[-1] if len(upto) else 0)]


class Runs:
    """Runs of ids, by number, in arrays that grow."""

    def __init__(self):
        self.ids, self.starts, self.sizes, self.n, self.used = np.zeros(1 << 16, np.int32), np.zeros(1 << 14, np.int64), np.zeros(1 << 14, np.int64), 0, 0

    def add(self, ids: np.ndarray, sizes: np.ndarray) -> int:
        """Appends runs; the number of the first."""
        while self.used + len(ids) > len(self.ids):
            self.ids = np.concatenate([self.ids, np.zeros_like(self.ids)])
        while self.n + len(sizes) > len(self.sizes):
            self.starts, self.sizes = (np.concatenate([x, np.zeros_like(x)]) for x in (self.starts, self.sizes))
        first = self.n
        self.ids[self.used : self.used + len(ids)] = ids
        self.sizes[first : first + len(sizes)] = sizes
        self.starts[first : first + len(sizes)] = self.used + np.cumsum(sizes) - sizes
        self.n, self.used = first + len(sizes), self.used + len(ids)
        return first

    def of(self, runs: np.ndarray) -> tuple[np.ndarray, np.ndarray]:
        """(ids of these runs one after the other, their sizes)."""
        return gathered(self.ids, self.starts[runs], self.sizes[runs]), self.sizes[runs]


class TextEncoder:
    """Encodes whole texts: each match of the pattern separately, repeated chunks remembered.

    A chunk is what follows a space up to the next one. By the pattern CHUNKED a space before anything but white
    space always starts a match, so chunks are encoded apart. Texts with other spaces, and all texts under other
    patterns, are matched whole.
    """

    def __init__(self, bpe: PrefixBPE, pattern: str):
        import regex

        self.bpe, self.find = bpe, regex.compile(pattern).findall
        self.odd = regex.compile(r" [\s\x1c-\x1f]| $" if pattern == CHUNKED else "").search
        # every token's bytes, and its id in decimal after a space, as runs in one array each
        n = max(bpe.token) + 1
        shown, plain = [b" %d" % i for i in range(n)], [bpe.token.get(i, b"") for i in range(n)]
        self.shown, self.plain = (tuple((np.frombuffer(b"".join(x), np.uint8), np.cumsum([0, *map(len, x)])[:-1], np.array(list(map(len, x))))) for x in (shown, plain))
        self._forget()

    def _forget(self) -> None:
        self.chunks: dict[str, int] = {}
        self.runs, self.held = Runs(), 0

    def _encode(self, found: list[str]) -> tuple[np.ndarray, np.ndarray]:
        """(ids of all matches one after the other, how many each has)."""
        place = {p: n for n, p in enumerate(dict.fromkeys(found))}
        ids, sizes = self.bpe.encode_pieces([p.encode() for p in place])
        at = np.fromiter(map(place.__getitem__, found), np.int64, len(found))
        return gathered(ids, (np.cumsum(sizes) - sizes)[at], sizes[at]), sizes[at]

    def _learn(self, chunks: list[str]) -> None:
        """Encodes chunks, each after a space, which is where its first match starts; no other match has one."""
        found = self.find(" " + " ".join(chunks))
        ids, sizes = self._encode(found)
        starts = np.flatnonzero(np.fromiter((p[0] == " " for p in found), bool, len(found)))
        first = self.runs.add(ids, np.add.reduceat(sizes, starts))
        self.chunks.update(zip(chunks, range(first, first + len(chunks))))
        self.held += sum(map(len, chunks))

    def encode_all(self, texts: list[str]) -> tuple[np.ndarray, np.ndarray]:
        """(ids of all texts one after the other, how many each has)."""
        if len(self.chunks) > CACHE_ENTRIES or self.held > CACHE_BYTES or self.runs.used > CACHE_BYTES:
            self._forget()
        parts = [[t] if self.odd(t) else t.split(" ") for t in texts]
        lacking = list(set(chain.from_iterable([p[1:] for p in parts])) - self.chunks.keys())
        if lacking:
            self._learn(lacking)
        # what no space precedes, and texts with other spaces, are encoded as they are
        found = [self.find(p[0]) for p in parts]
        ids, sizes = self._encode(list(chain.from_iterable(found)))
        upto = np.concatenate([[0], np.cumsum(sizes)])[np.cumsum([0, *map(len, found)])]
        first, runs, known = self.runs.add(ids, np.diff(upto)), [], self.chunks.__getitem__
        for n, p in enumerate(parts, first):
            runs.append(n)
            runs += map(known, p[1:])
        ids, sizes = self.runs.of(np.array(runs, np.int64))
        ends = np.cumsum([len(p) for p in parts])
        upto = np.concatenate([[0], np.cumsum(sizes)])
        return ids, np.diff(upto[np.concatenate([[0], ends])])

    def encode(self, text: str) -> list[int]:
        return self.encode_all([text])[0].tolist()

    def written(self, table: tuple, ids: np.ndarray, sizes: np.ndarray, most: int = 1 << 18) -> list[memoryview]:
        """For each text the runs of its ids in one of the tables shown and plain, made for about most bytes at a time."""
        bytes_, starts, lengths = table
        own = lengths[ids]
        upto = np.concatenate([[0], np.cumsum(own)])[np.concatenate([[0], np.cumsum(sizes)])]
        ends = np.concatenate([[0], np.cumsum(sizes)])
        out: list[memoryview] = []
        while len(out) < len(sizes):
            first = len(out)
            last = max(first + 1, int(np.searchsorted(upto, upto[first] + most, "right")) - 1)
            part = slice(ends[first], ends[last])
            data = memoryview(gathered(bytes_, starts[ids[part]], own[part]))
            at = (upto[first : last + 1] - upto[first]).tolist()
            out += [data[a:b] for a, b in zip(at, at[1:])]
        return out

    def encode_decode(self, texts: list[str]) -> list[tuple[int, memoryview, memoryview]]:
        """For each text the number of ids, the ids in decimal, joined by one space, and what they decode to."""
        ids, sizes = self.encode_all(texts)
        return [(n, a[1:], b) for n, a, b in zip(sizes.tolist(), self.written(self.shown, ids, sizes), self.written(self.plain, ids, sizes))]


_ENCODERS: dict[str, TextEncoder] = {}


def text_encoder(raw: bytes, pattern: str) -> TextEncoder:
    """The worker's encoder for this vocabulary, made once."""
    key = hashlib.sha256(raw + pattern.encode()).hexdigest()
    claim("bpe", _ENCODERS.clear)
    if key not in _ENCODERS:
        _ENCODERS.clear()
        _ENCODERS[key] = TextEncoder(PrefixBPE(read_ranks(raw)), pattern)
    return _ENCODERS[key]


def encode_documents(docs: DataFrame, vocabulary: str, pattern: str, with_ids: bool = True) -> DataFrame:
    """(doc_id, n_tokens, ids_sha256, decoded_sha256[, ids, decoded]) for every row of docs.

    Encodes the whole text by the ranks in the file vocabulary, without special tokens, and decodes the ids
    again. A null text counts as empty: 0 tokens and the digests of nothing. A null or repeated doc_id stays
    as it is, one row for each row of docs. Other columns are ignored. The step is narrow: no shuffle; the
    vocabulary (a file of at most 16 MiB) is the only broadcast.
    """
    raw = ship_file(docs.sparkSession, vocabulary)
    fields = [("doc_id", pa.int64()), ("n_tokens", pa.int64()), ("ids_sha256", pa.string()), ("decoded_sha256", pa.string())]
    schema = "doc_id long, n_tokens long, ids_sha256 string, decoded_sha256 string"
    if with_ids:
        fields += [("ids", pa.list_(pa.int32())), ("decoded", pa.binary())]
        schema += ", ids array<int>, decoded binary"

    def run(batches):
        encoder = text_encoder(raw.value, pattern)

        def rows(x):
            out = {name: [] for name, _ in fields}
            out["doc_id"] = x["doc_id"]
            ids, sizes = encoder.encode_all([t.decode() for t in x["text"]])
            decoded = encoder.written(encoder.plain, ids, sizes)
            out["n_tokens"] = sizes.tolist()
            out["ids_sha256"] = [hashlib.sha256(shown[1:]).hexdigest() for shown in encoder.written(encoder.shown, ids, sizes)]
            out["decoded_sha256"] = [hashlib.sha256(d).hexdigest() for d in decoded]
            if with_ids:
                out["ids"] = np.split(ids, np.cumsum(sizes)[:-1]) if len(sizes) else []
                out["decoded"] = map(bytes, decoded)
            return out

        yield from by_rows(rows, pa.schema(fields))(batches)

    return docs.select(F.col("doc_id").cast("long").alias("doc_id"), text_bytes().alias("text")).mapInArrow(run, schema)
