"""Token counts by a count-only Viterbi search over a unigram vocabulary.

An Aho-Corasick automaton lists the pieces that end at each place of a word. The search keeps the best score
and the number of tokens up to a place, no lattice and no path. Ties fall as in the tokenizers library: a later
start must be better, so of equal paths the one with the longest last piece stays; neighbouring unknown
characters are one unknown piece, which falls back to its bytes.
"""

from __future__ import annotations

import hashlib

import pyarrow as pa
from pyspark.sql import DataFrame
from pyspark.sql import functions as F

from .common import by_rows, claim, ship_file, text_bytes

SPACE = "\u2581"
#: What an unknown character scores below the worst piece.
UNKNOWN = 10.0
#: Words whose counts a worker keeps; a full cache is emptied.
STORED = 500_000


def read_pieces(raw: bytes) -> tuple[list[tuple[str, float]], int]:
    """(piece, score) by id, and the id of the unknown piece, of a SentencePiece model file."""
    import sentencepiece

    model = sentencepiece.SentencePieceProcessor(model_proto=raw)
    return [(model.id_to_piece(i), float(model.get_score(i))) for i in range(model.get_piece_size())], model.unk_id()


class Counter:
    def __init__(self, pieces: list[tuple[str, float]]):
        import ahocorasick

        self.known = {p for p, _ in pieces}
        self.bytes = all(f"<0x{i:02X}>" in self.known for i in range(256))
        self.unknown = min(s for _, s in pieces) - UNKNOWN
        self.automaton = ahocorasick.Automaton()
        for p, s in pieces:
            if p:
                self.automaton.add_word(p, (len(p), s))
        self.automaton.make_automaton()
        self.words: dict[str, int] = {}

    def _run(self, s: str) -> int:
        """Tokens of a run of unknown characters."""
        if s in self.known or not self.bytes:
            return 1
        return len(s.encode("utf-8", "surrogatepass"))

    def count_word(self, s: str) -> int:
        """Tokens of one pretokenised word, with its space sign."""
        n = len(s)
        ends: list[list[tuple[int, float]]] = [[] for _ in range(n + 1)]
        for last, match in self.automaton.iter(s):
            ends[last + 1].append(match)
        score, count, run = [0.0] * (n + 1), [0] * (n + 1), [-1] * (n + 1)  # run: where the unknown run that ends here began
        for end in range(1, n + 1):
            best = None
            single = False
            for length, own in sorted(ends[end], reverse=True):
                start = end - length
                single |= length == 1
                total = score[start] + own
                if best is None or total > best:
                    best, at, new_run = total, start, -1
            if not single:
                total = score[end - 1] + self.unknown
                if best is None or total > best:
                    best, at, new_run = total, end - 1, run[end - 1] if run[end - 1] >= 0 else end - 1
            score[end], run[end] = best, new_run
            if new_run >= 0:
                count[end] = count[new_run]
            else:
                count[end] = count[at] + 1 + (self._run(s[run[at] : at]) if run[at] >= 0 else 0)
        return count[n] + (self._run(s[run[n] : n]) if run[n] >= 0 else 0)

    def count(self, text: str) -> int:
        """Tokens of a whole text: a space sign before each word, words split at spaces only."""
        if not text:
            return 0
        parts = text.replace(SPACE, " ").split(" ")
        total, words = 0, self.words
        for w in parts[1:] if text[0] in (" ", SPACE) else parts:
            k = words.get(w)
            if k is None:
                k = self.count_word(SPACE + w)
                if len(w) <= 64:
                    if len(words) >= STORED:
                        words.clear()
                    words[w] = k
            total += k
        return total


_COUNTERS: dict[str, Counter] = {}


def counter(raw: bytes) -> Counter:
    key = hashlib.sha256(raw).hexdigest()
    claim("token_count", _COUNTERS.clear)
    if key not in _COUNTERS:
        _COUNTERS.clear()
        _COUNTERS[key] = Counter(read_pieces(raw)[0])
    return _COUNTERS[key]


_SCHEMA = pa.schema([("doc_id", pa.int64()), ("n_tokens", pa.int64()), ("n_chars", pa.int64())])


def count_tokens(docs: DataFrame, vocabulary: str) -> DataFrame:
    """(doc_id, n_tokens, n_chars) for every row of docs, by the pieces and scores in the file vocabulary.

    A null or empty text has 0 tokens. Null or repeated doc_id stay; other columns are ignored. Whole texts;
    narrow: no shuffle; the vocabulary (a file of at most 16 MiB) is the only broadcast.
    """
    raw = ship_file(docs.sparkSession, vocabulary)

    def run(batches):
        c = counter(raw.value)

        def rows(x):
            texts = [t.decode() for t in x["text"]]
            return {"doc_id": x["doc_id"], "n_tokens": list(map(c.count, texts)), "n_chars": list(map(len, texts))}

        yield from by_rows(rows, _SCHEMA)(batches)

    return docs.select(F.col("doc_id").cast("long").alias("doc_id"), text_bytes().alias("text")).mapInArrow(run, "doc_id long, n_tokens long, n_chars long")
