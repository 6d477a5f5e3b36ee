"""Toxicity by Levenshtein automata over a lexicon trie, with context windows.

The lexicon (words and word stems with weights) is learned from labelled documents. A trie of it is intersected
with the Levenshtein automaton of each word, as one deterministic automaton made lazily and kept by the worker:
a word costs a few look-ups. Hits are weighed by the window around them: quotation marks and reporting
words speak for quoting, words of address for abuse. A logistic model on these sums gives the score.
"""

from __future__ import annotations

import math
import re
from array import array
from collections import Counter
from collections.abc import Iterator
from dataclasses import dataclass, field

import numpy as np
import pyarrow as pa
from pyspark.sql import Column, DataFrame
from pyspark.sql import functions as F

from .common import by_rows, claim, discard, materialize, slices, text_bytes, tidied

WORD = re.compile(r"[^\W_]+")
# Signs of quotation and of address in a window.
REPORTING = frozenset("said says wrote writes quoted quote quotes called says reported reports claims claimed cited dit écrit sagte schrieb dijo escribió".split())
ADDRESS = frozenset("you your youre u ur tu toi vous votre du dich dir ihr dein sie usted tú vosotros".split())
#: What a hit that a window reports instead of addressing still counts.
REPORTED = 0.5
QUOTES = "\"“”„«»‹›"
QUOTED = re.compile(f"[{QUOTES}]")
#: Words that a worker remembers, letters of the longest of them, and moves and pairs of (node, edits), four bytes each,
#: that its automaton keeps before it starts anew.
STORED = 200_000
STORED_LETTERS = 64
STORED_MOVES = 400_000
STORED_PAIRS = 8_000_000


@dataclass(frozen=True)
class Rules:
    """sample: labelled rows that the model is fitted on, those with the smallest hash of doc_id.

    entries: size of the lexicon; candidates: terms among which it is chosen; window: words on either side of a hit;
    stem: letters of the shortest stem, longest_stem those of the longest (None: any); least_letters: letters of the shortest
    word; folds: parts of the sample whose features come from the lexicons of the others.
    """

    sample: int = 8_000
    entries: int = 2_000
    candidates: int = 30_000
    folds: int = 4
    least_docs: int = 3
    least_weight: float = 1.5
    stem: int = 4
    longest_stem: int | None = 7
    least_letters: int = 1
    window: int = 6


def edits_for(term: str) -> int:
    """Edits allowed in a word for this term."""
    return 0 if len(term) < 5 else 1 if len(term) < 9 else 2


class FuzzyLexicon:
    """Words within the allowed edits of a term. Stems end in * and accept what follows, without edits."""

    def __init__(self, terms: dict[str, float]):
        self.weight = dict(terms)
        self.child: list[dict[str, int]] = [{}]
        self.whole: list[str | None] = [None]
        self.stem: list[str | None] = [None]
        self.room: list[int] = [0]  # most edits that a term below allows
        for term in terms:
            body, at = term.rstrip("*"), 0
            room = 0 if term.endswith("*") else edits_for(body)
            self.room[0] = max(self.room[0], room)
            for c in body:
                nxt = self.child[at].get(c)
                if nxt is None:
                    nxt = self.child[at][c] = len(self.child)
                    self.child.append({})
                    self.whole.append(None)
                    self.stem.append(None)
                    self.room.append(0)
                at = nxt
                self.room[at] = max(self.room[at], room)
            if term.endswith("*"):
                self.stem[at] = term
            else:
                self.whole[at] = term
        self._reset()

    def _reset(self) -> None:
        start = self._close([0])
        self.states: dict[tuple, int] = {(start, ()): 0}
        self.sets: list[bytes] = [start]  # of each state its pairs as node << 2 | edits, four bytes each
        self.stems: list[tuple[str, ...]] = [()]
        self.move: dict[int, int] = {}
        self.pairs = 0
        self.ends: list[tuple | None] = [None]

    def _close(self, items: list[int]) -> bytes:
        """All pairs reached by leaving out letters of the term, the fewest edits for each node."""
        least: dict[int, int] = {}
        while items:
            pair = items.pop()
            node, e = pair >> 2, pair & 3
            if e > self.room[node] or least.get(node, 9) <= e:
                continue
            least[node] = e
            if e < 2:
                items += [n << 2 | e + 1 for n in self.child[node].values()]
        return array("I", sorted([node << 2 | e for node, e in least.items()])).tobytes()

    def _next(self, state: int, c: str) -> int:
        key = state << 21 | ord(c)
        nxt = self.move.get(key)
        if nxt is None:
            items: set[int] = set()
            stems = []
            for pair in array("I", self.sets[state]):
                node, e = pair >> 2, pair & 3
                own = self.child[node].get(c)
                if own is not None:
                    items.add(own << 2 | e)
                    if e == 0 and self.stem[own]:
                        stems.append(self.stem[own])
                if e < 2 and e < self.room[node]:  # another letter, or one more than the term has
                    items.add(node << 2 | e + 1)
                    items.update([n << 2 | e + 1 for n in self.child[node].values() if n != own])
            reached = self._close(list(items))
            # -1: nothing can be reached any more, so what follows needn't be read
            if not reached and not stems:
                nxt = -1
            else:
                whole = (reached, tuple(stems))
                nxt = self.states.get(whole)
                if nxt is None:
                    nxt = self.states[whole] = len(self.sets)
                    self.sets.append(reached)
                    self.pairs += len(reached) // 4 + 40
                    self.stems.append(tuple(stems))
                    self.ends.append(None)
            self.move[key] = nxt
        return nxt

    def match(self, word: str) -> tuple[tuple[str, int], ...]:
        """(term, edits) of the terms that the word is a spelling of; for a stem 0."""
        if self.pairs > STORED_PAIRS or len(self.move) > STORED_MOVES:
            self._reset()
        state, found = 0, []
        move = self.move
        for c in word:
            nxt = move.get(state << 21 | ord(c))
            state = self._next(state, c) if nxt is None else nxt
            if state < 0:
                return tuple(found)
            if self.stems[state]:
                found += [(s, 0) for s in self.stems[state]]
        ends = self.ends[state]
        if ends is None:
            found_ = [(self.whole[pair >> 2], pair & 3) for pair in array("I", self.sets[state])]
            ends = self.ends[state] = tuple((t, e) for t, e in found_ if t and e <= edits_for(t))
        return (*found, *ends)


class _Words(dict):
    """What a word matches, remembered."""

    def __init__(self, lexicon: FuzzyLexicon):
        super().__init__()
        self.lexicon = lexicon

    def __missing__(self, word: str):
        best = None
        for term, e in self.lexicon.match(word):
            w = self.lexicon.weight[term]
            kind = 2 if term.endswith("*") else 1 if e else 0
            if best is None or (w / (1 + e)) > best[0]:
                best = (w / (1 + e), kind)
        if len(word) <= STORED_LETTERS:
            if len(self) >= STORED:
                self.clear()
            self[word] = best
        return best


N_FEATURES = 9


def features(text: str, words: _Words, window: int) -> list[float]:
    """Sums over the hits of a text: by kind of match, in abuse and in quotation, and their density."""
    found = WORD.findall(text.lower())
    hits = [(i, h) for i, h in enumerate(map(words.__getitem__, found)) if h]
    out = [0.0] * N_FEATURES
    if not hits:
        return out
    kinds = [0.0, 0.0, 0.0]
    quoted = address = 0.0
    for i, (w, kind) in hits:
        around = found[max(0, i - window) : i + window + 1]
        if not REPORTING.isdisjoint(around):
            quoted += w
            w *= REPORTED
        kinds[kind] += w
        if not ADDRESS.isdisjoint(around):
            address += w
    if any(q in text for q in QUOTES):
        quoted += _inside_quotes(text, words)
    n = max(1, len(found))
    for j in range(3):
        out[j] = math.log1p(kinds[j])
    out[3] = math.log1p(max(h[0] for _, h in hits))
    out[4] = math.log1p(address)
    out[5] = math.log1p(quoted)
    out[6] = 100 * sum(kinds) / (n + 20)
    out[7] = 100 * kinds[0] / (n + 20)
    out[8] = math.log1p(len(hits))
    return out


def _inside_quotes(text: str, words: _Words) -> float:
    """Weights of the hits between a mark of quotation and the next one in the same line; a line's odd last mark opens nothing."""
    total = 0.0
    for line in text.split("\n"):
        for part in QUOTED.split(line)[1:-1:2]:
            total += sum(h[0] for h in map(words.__getitem__, WORD.findall(part.lower())) if h)
    return total


@dataclass
class Model:
    terms: dict[str, float]
    coef: np.ndarray
    bias: float
    mean: np.ndarray
    scale: np.ndarray
    rules: Rules = field(default_factory=Rules)

    def score(self, x: list[float]) -> float:
        z = float(np.dot((np.asarray(x) - self.mean) / self.scale, self.coef) + self.bias)
        return 1 / (1 + math.exp(-max(-30.0, min(30.0, z))))


def candidates(text: str, rules: Rules) -> set[str]:
    """Words of a text, and stems that its words begin with."""
    out = set()
    for w in set(WORD.findall(text.lower())):
        if len(w) >= rules.least_letters:
            out.add(w)
        for k in range(rules.stem, len(w) if rules.longest_stem is None else min(rules.longest_stem + 1, len(w))):
            out.add(w[:k] + "*")
    return out


def strength(k: float, other: float, n1: int, n0: int) -> tuple[float, float]:
    """(weight, weight less what chance may add) of a term in k of n1 toxic and other of n0 clean documents: smoothed log-odds."""
    weight = math.log((k + 0.5) / (n1 + 1)) - math.log((other + 0.5) / (n0 + 1))
    return weight, weight - 1.3 * math.sqrt(1 / (k + 0.5) + 1 / (other + 0.5))


def lexicon(counts: dict[str, tuple[int, int]], n1: int, n0: int, rules: Rules) -> dict[str, float]:
    """Weights by term from (clean, toxic) documents with the term: the surest terms, without those that another one covers."""
    ranked = []
    for term, (other, k) in counts.items():
        if k >= rules.least_docs:
            weight, sure = strength(k, other, n1, n0)
            if weight >= rules.least_weight and sure > 0:
                ranked.append((sure * math.sqrt(k), term, weight))
    ranked.sort(key=lambda r: (-r[0], r[1]))
    out: dict[str, float] = {}
    single: dict[str, int] = {}  # documents of the commonest word under each stem
    for _, term, _ in ranked:
        for k in range(rules.stem, len(term) if rules.longest_stem is None else min(rules.longest_stem + 1, len(term))) if not term.endswith("*") else ():
            single[term[:k] + "*"] = max(single.get(term[:k] + "*", 0), counts[term][1])
    for _, term, weight in ranked:
        if term.endswith("*"):
            if single.get(term, 0) >= 0.9 * counts[term][1]:  # one word, which with its misspellings says as much
                continue
            if any(out.get(term[:k] + "*", -9) >= weight - 0.3 for k in range(rules.stem, len(term) - 1)):  # a shorter stem says as much
                continue
        out[term] = weight
        if len(out) >= rules.entries:
            break
    return out


def regression(x: np.ndarray, y: np.ndarray) -> tuple[np.ndarray, float, np.ndarray, np.ndarray]:
    """(coefficients, bias, means, scales) of a lightly regularised logistic regression by Newton steps."""
    mean, scale = (x.mean(0), x.std(0) + 1e-6) if len(x) else (np.zeros(N_FEATURES), np.ones(N_FEATURES))
    z = np.c_[(x - mean) / scale, np.ones(len(x))]
    w = np.zeros(N_FEATURES + 1)
    w[-1] = math.log(max(1, y.sum()) / max(1, len(y) - y.sum()))
    for _ in range(30 if len(x) else 0):
        p = 1 / (1 + np.exp(-np.clip(z @ w, -30, 30)))
        h = (z * (p * (1 - p))[:, None]).T @ z + 0.5 * np.eye(len(w))
        step = np.linalg.solve(h, z.T @ (y - p) - 0.5 * np.r_[w[:-1], 0])
        w += step
        if np.abs(step).max() < 1e-6:
            break
    return w[:-1], float(w[-1]), mean, scale


def held_out(doc_id: Column) -> Column:
    return F.coalesce(F.crc32(doc_id.cast("string")) % 5 == 0, F.lit(False))


def _term_counts(sample: DataFrame, rules: Rules) -> DataFrame:
    """(term, fold, toxic, n): documents of the sample with each term, added up where they are read."""
    schema = pa.schema([("term", pa.string()), ("fold", pa.int32()), ("toxic", pa.int32()), ("n", pa.int64())])

    def run(batches: Iterator[pa.RecordBatch]) -> Iterator[pa.RecordBatch]:
        for batch in slices(batches):
            seen: Counter = Counter()
            for fold, toxic, text in zip(*(batch.column(c).to_pylist() for c in ("fold", "toxic", "text"))):
                seen.update((term, fold, toxic) for term in candidates(text, rules))
            rows = [(*k, n) for k, n in seen.items()]
            yield pa.RecordBatch.from_arrays([pa.array(c, f.type) for c, f in zip(zip(*rows), schema)] if rows else [pa.array([], f.type) for f in schema], schema=schema)

    return sample.mapInArrow(tidied(run), "term string, fold int, toxic int, n long")


def fit(docs: DataFrame, labels: DataFrame, rules: Rules = Rules()) -> Model:
    """A model from at most rules.sample labelled rows that aren't held out; a document with several labels is toxic if one says so.

    Terms are counted and features are made where the texts are; the driver gets the counts of rules.candidates
    terms and the few features of each row of the sample, and no text.
    """
    y = labels.where(F.col("toxic").isNotNull() & F.col("doc_id").isNotNull()).where(~held_out(F.col("doc_id")))
    y = y.groupBy(F.col("doc_id").cast("long").alias("l_id")).agg(F.max(F.col("toxic").cast("int")).alias("toxic"))
    y = y.orderBy(F.xxhash64("l_id"), "l_id").limit(rules.sample)
    rows = docs.select(F.col("doc_id").cast("long").alias("doc_id"), text_bytes().cast("string").alias("text")).join(F.broadcast(y), F.col("doc_id") == F.col("l_id"))
    rows = rows.groupBy("doc_id").agg(F.min("text").alias("text"), (F.max("toxic") > 0).cast("int").alias("toxic"))
    sample = materialize(rows.withColumn("fold", F.pmod(F.xxhash64("doc_id"), F.lit(rules.folds)).cast("int")))
    n = {r["toxic"]: r["n"] for r in sample.groupBy("toxic").agg(F.count("*").alias("n")).collect()}
    n1, n0 = max(1, n.get(1, 0)), max(1, n.get(0, 0))
    both = [F.sum(F.when(F.col("toxic") == t, F.col("n")).otherwise(0)) for t in (0, 1)]
    parts = [F.sum(F.when((F.col("toxic") == t) & (F.col("fold") == f), F.col("n")).otherwise(0)).alias(f"f{f}_{t}") for f in range(rules.folds) for t in (0, 1)]
    terms = _term_counts(sample, rules).groupBy("term").agg(both[0].alias("clean"), both[1].alias("hits"), *parts).where(F.col("hits") >= rules.least_docs)
    weight = F.log((F.col("hits") + 0.5) / (n1 + 1)) - F.log((F.col("clean") + 0.5) / (n0 + 1))
    sure = weight - 1.3 * F.sqrt(1 / (F.col("hits") + 0.5) + 1 / (F.col("clean") + 0.5))
    best = terms.where(weight > 0).orderBy(F.desc(sure * F.sqrt("hits")), "term").limit(rules.candidates).collect()
    counts = {r["term"]: (r["clean"], r["hits"]) for r in best}
    # features of a fold come from a lexicon learned without it, so that the weights of rare terms aren't overrated
    without = [lexicon({r["term"]: (r["clean"] - r[f"f{f}_0"], r["hits"] - r[f"f{f}_1"]) for r in best}, n1, n0, rules) for f in range(rules.folds)]
    shared = docs.sparkSession.sparkContext.broadcast(without)

    def run(batches: Iterator[pa.RecordBatch]) -> Iterator[pa.RecordBatch]:
        fold, words = None, None
        for batch in slices(batches):
            x = []
            for f, text in zip(batch.column("fold").to_pylist(), batch.column("text").to_pylist()):
                if f != fold:
                    fold, words = f, _Words(FuzzyLexicon(shared.value[f]))
                x.append(features(text, words, rules.window))
            yield pa.RecordBatch.from_arrays([batch.column("doc_id"), batch.column("toxic"), pa.array(x, pa.list_(pa.float64()))], names=["doc_id", "toxic", "x"])

    dealt = sample.repartition(4 * rules.folds, "fold", F.pmod(F.xxhash64(F.lit(1), "doc_id"), F.lit(4))).sortWithinPartitions("fold", "doc_id")
    rows = sorted(dealt.mapInArrow(tidied(run), "doc_id long, toxic int, x array<double>").collect())
    discard(sample)
    coef, bias, mean, scale = regression(np.array([r["x"] for r in rows], float).reshape(-1, N_FEATURES), np.array([r["toxic"] for r in rows], float))
    return Model(lexicon(counts, n1, n0, rules), coef, bias, mean, scale, rules)


_SCHEMA = pa.schema([("doc_id", pa.int64()), ("score", pa.float64())])
_MODELS: list[tuple[Model, _Words]] = []


def _words_for(model: Model) -> _Words:
    """The worker's remembered words for this model."""
    claim("toxicity", _MODELS.clear)
    if not _MODELS or _MODELS[0][0] is not model:
        _MODELS[:] = [(model, _Words(FuzzyLexicon(model.terms)))]
    return _MODELS[0][1]


def score_documents(docs: DataFrame, model: Model) -> DataFrame:
    """(doc_id, held_out, score, predicted) for every row of docs, from its whole text alone.

    A null or empty text, or one without hits, gets the model's base score. Null (not held out) or repeated
    doc_id stay as they are; other columns are ignored. Narrow: no shuffle; the model (at most
    rules.entries terms) is the only thing broadcast.
    """
    shared = docs.sparkSession.sparkContext.broadcast(model)

    def run(batches):
        m = shared.value
        words = _words_for(m)

        def rows(x):
            return {"doc_id": x["doc_id"], "score": [m.score(features(t.decode(), words, m.rules.window)) for t in x["text"]]}

        yield from by_rows(rows, _SCHEMA)(batches)

    out = docs.select(F.col("doc_id").cast("long").alias("doc_id"), text_bytes().alias("text")).mapInArrow(run, "doc_id long, score double")
    return out.select("doc_id", held_out(F.col("doc_id")).alias("held_out"), "score", (F.col("score") >= 0.5).cast("int").alias("predicted"))


def drop_toxic(docs: DataFrame, model: Model, most: float = 0.5) -> DataFrame:
    """The rows of docs that score under most, with their columns."""
    shared = docs.sparkSession.sparkContext.broadcast(model)

    def run(batches):
        m = shared.value
        words = _words_for(m)
        for batch in slices(batches):
            texts = batch.column(batch.schema.get_field_index("text")).to_pylist()
            yield batch.filter(pa.array([m.score(features(t or "", words, m.rules.window)) < most for t in texts], pa.bool_()))

    return docs.mapInArrow(tidied(run), docs.schema)
