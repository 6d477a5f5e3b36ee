"""Secret scans: fixed patterns, and a battery of randomness tests on other key-like strings.

A candidate's encoding is inferred from its characters; a run of characters is split at '=' signs inside it, and
where no encoding has all of its characters, at those outside base64 and at those outside base64url. Chi-squared
uniformity over the alphabet, the runs test and the lag-one serial correlation each ask whether it could be random;
their joint p-value is large for keys. How large it gets for ordinary identifiers is known from a null model: names
glued from common words and numbers, put through the same battery for each encoding and length. A candidate's
chance of being ordinary is the share of such names that look at least as random, and the Benjamini-Hochberg
procedure, weighted by length, over all candidates of the corpus holds the share of ordinary strings among those
reported to the level. It needs the candidates' counts by length and chance alone: one small aggregate.
"""

from __future__ import annotations

import hashlib
import math
import random
import re
from collections.abc import Iterator
from dataclasses import dataclass

import numpy as np
import pyarrow as pa
from pyspark.sql import DataFrame
from pyspark.sql import functions as F

from .common import by_rows, materialize, text_bytes

# The base patterns, by bytes so that case folding is that of ASCII.
ASSIGN = re.compile(rb"""(password|passwd|secret|token|api_?key)["']?\x20*[:=]\x20*["']?([A-Za-z0-9+/_.=-]+)""", re.I)
ACCESS = re.compile(rb"AKIA[A-Z0-9]+")
HEX = re.compile(rb"[0-9a-f]{16,}")  # the same as runs of any length without the shorter ones
PART = re.compile(rb"[A-Za-z0-9+/_-]+(?:=+\Z)?")  # '=' is padding at the end of a run, else it separates
PIECES = (re.compile(rb"[A-Za-z0-9+/]+=*"), re.compile(rb"[A-Za-z0-9_-]+=*"))
KINDS = ("assign", "access", "hex", "random")
DIGITS = b"0123456789"
LOWER = b"abcdefghijklmnopqrstuvwxyz"
ALPHABETS = (
    ("hex", DIGITS + b"abcdef"),
    ("HEX", DIGITS + b"ABCDEF"),
    ("base32", LOWER.upper() + b"234567"),
    ("base36", DIGITS + LOWER),
    ("BASE36", DIGITS + LOWER.upper()),
    ("base62", DIGITS + LOWER.upper() + LOWER),
    ("base64", LOWER.upper() + LOWER + DIGITS + b"+/"),
    ("base64url", LOWER.upper() + LOWER + DIGITS + b"-_"),
)


# Letters from the commonest to the rarest, and parts of ordinary names.
BY_FREQUENCY = b"etaoinsrhldcumfpgwybvkxjqz"
PARTS = (
    "get set is has add new old max min user name file path index value count size list item map key id type data table column row query "
    "result error warning version build release test sample config service manager factory handler request response message client server "
    "session account order customer product price total date time start end first last next previous source target input output image page "
    "header footer content body title label button form field group section section module package class method function object string "
    "number float array buffer stream reader writer parser builder context state status event action model view controller default global "
    "local remote public private internal external main common base util helper support main download upload update delete create insert "
    "der die das und haus zeit wert liste datei konto les des une nom fichier valeur compte prix los las casa valor lista cuenta precio"
).split()
#: Lengths for which the null model has names; a candidate is held to the largest that doesn't exceed its own.
LENGTHS = (20, 22, 24, 28, 32, 40, 48, 64, 96, 128)
#: Names of the null model for each encoding and length, and how many of the most random-looking of them tell how
#: fast chances fall beyond.
NAMES = 4000
TAIL = 40
#: Steps in which a chance halves, and the most of them: chances travel as whole numbers.
STEPS, MOST_STEPS = 8, 400


@dataclass(frozen=True)
class Battery:
    """level: share of ordinary strings tolerated among those reported; bits: least information for which the tests
    have power. It alone says how short a string may be: 23 characters of hex digits, 15 of base64."""

    level: float = 0.05
    bits: float = 90.0

    def least(self) -> int:
        """Characters that the bits take in the largest alphabet."""
        return max(1, math.ceil(self.bits / math.log2(max(len(a) for _, a in ALPHABETS))))


def chi_squared_tail(x: float, k: int) -> float:
    """P(X > x) for k degrees of freedom, by its finite sums for even and odd k."""
    if x <= 0:
        return 1.0
    if x > 1400:
        return 0.0
    odd = k % 2
    term = math.sqrt(2 * x / math.pi) if odd else 1.0
    total = term if k > 1 else 0.0
    for i in range(1, k // 2):
        term *= x / (2 * i + odd)
        total += term
    return min(1.0, (math.erfc(math.sqrt(x / 2)) if odd else 0.0) + math.exp(-x / 2) * total)


def infer(data: bytes) -> tuple[str, bytes] | None:
    """The smallest alphabet that holds all characters; None if characters of one class only (words, numbers)."""
    body = data.rstrip(b"=")
    chars = set(body)
    if not (chars & set(DIGITS) and chars - set(DIGITS)):
        return None
    return next(((n, a) for n, a in ALPHABETS if chars <= set(a)), None)


def candidates(run: bytes, least: int = 1) -> list[tuple[int, int]]:
    """(start, end) of the pieces of a run to test, by start: its parts between '=' signs, and where no alphabet
    holds all characters of one, the longest pieces in base64 and those in base64url, which may overlap."""
    out = set()
    for part in PART.finditer(run):
        chars = set(part[0].rstrip(b"="))
        if any(chars <= set(a) for _, a in ALPHABETS):
            out.add(part.span())
        else:
            out |= {(part.start() + m.start(), part.start() + m.end()) for p in PIECES for m in p.finditer(part[0])}
    return sorted((a, b) for a, b in out if b - a >= least)


def merged(spans: list[tuple[int, int, str]]) -> list[tuple[int, int, str]]:
    """Spans of one kind, by start, with those that overlap made one."""
    out = []
    for a, b, kind in spans:
        if out and a < out[-1][1]:
            out[-1] = (out[-1][0], max(b, out[-1][1]), kind)
        else:
            out.append((a, b, kind))
    return out


def in_order(alphabet: bytes) -> bytes:
    """The alphabet with its letters from common to rare, so that ordinary words crowd at their beginning."""
    letters = [bytes([c]) for c in BY_FREQUENCY + BY_FREQUENCY.upper() if c in alphabet]
    return b"".join(letters) + bytes(c for c in alphabet if bytes([c]) not in letters)


def battery_p(rows: np.ndarray, k: int) -> np.ndarray:
    """For each row of places in an alphabet of k characters the joint p-value (Fisher) of chi-squared uniformity, the
    runs test and lag-one serial correlation, under the hypothesis that the row is random."""
    m, n = rows.shape
    bins = max(2, min(k, n // 5))
    width = np.bincount(np.arange(k) * bins // k, minlength=bins)
    counts = np.zeros((m, bins))
    np.add.at(counts, (np.arange(m)[:, None], rows * bins // k), 1)
    expected = n * width / k
    chi = ((counts - expected) ** 2 / expected).sum(1)
    high = rows >= k / 2
    n1 = high.sum(1)
    n0 = n - n1
    mean = 1 + 2 * n0 * n1 / n
    deviation = np.sqrt(np.maximum(1e-9, (mean - 1) * (mean - 2) / (n - 1)))
    runs = 1 + (high[:, 1:] != high[:, :-1]).sum(1)
    z_runs = np.where((n0 > 0) & (n1 > 0), np.abs(runs - mean) / deviation, math.sqrt(2 * n))
    off = rows - rows.mean(1, keepdims=True)
    square = (off**2).sum(1)
    r = np.where(square > 0, (off[:, 1:] * off[:, :-1]).sum(1) / np.where(square > 0, square, 1), 1.0)
    z_serial = np.abs(r + 1 / n) * math.sqrt(n)
    out = np.empty(m)
    for i in range(m):
        p = chi_squared_tail(float(chi[i]), bins - 1), math.erfc(z_runs[i] / math.sqrt(2)), math.erfc(z_serial[i] / math.sqrt(2))
        out[i] = chi_squared_tail(-2 * sum(math.log(max(x, 1e-300)) for x in p), 6)
    return out


def _places(strings: list[bytes], alphabet: bytes) -> np.ndarray:
    table = np.zeros(256, np.int64)
    table[np.frombuffer(in_order(alphabet), np.uint8)] = np.arange(len(alphabet))
    return table[np.frombuffer(b"".join(strings), np.uint8)].reshape(len(strings), -1)


def ordinary_names(encoding: str, length: int, n: int = NAMES) -> list[bytes]:
    """Names of the null model: of the encoding's characters, some of them digits and some not, always the same."""
    alphabet = set(dict(ALPHABETS)[encoding])
    digits, others = bytes(sorted(alphabet & set(DIGITS))).decode(), sorted(alphabet - set(DIGITS))
    r = random.Random(f"{encoding} {length}")
    out = []
    while len(out) < n:
        s = ""
        number = lambda: r.choice([str(r.randrange(10)), str(r.randrange(1900, 2100)), str(r.randrange(1000)), f"{r.randrange(10**6):06d}"])
        joint, capital = r.choice(["", "", "_", "-", "/"]), r.choice([str.lower, str.capitalize, str.upper])
        if encoding.lower() == "hex":
            unit = r.choice(["".join(r.choice("0123456789") for _ in range(r.randint(1, 8))), f"20{r.randrange(10**6):06d}", "0" * r.randint(2, 9), r.choice(["dead", "beef", "cafe", "face", "feed", "abcdef", "abc"])])
            while len(s) < length:
                s += unit if r.random() < 0.6 else r.choice([number(), r.choice(["dead", "beef", "cafe", "face", "feed", "abc", "a", "f"])])
            s = s.upper() if encoding == "HEX" else s
        else:
            while len(s) < length:
                s += (joint if s else "") + (number() if r.random() < 0.2 else capital(r.choice(PARTS)))
            s = s if any(c in alphabet for c in LOWER) else s.upper()
            s = s if any(c in alphabet for c in LOWER.upper()) else s.lower()
        # characters of other encodings go; a name without digits ends in a number, as it would be no candidate else
        b = bytes(c for c in s.encode() if c in alphabet)[:length]
        if len(b) < length:
            b += bytes(r.choice(others) for _ in range(1)) * (length - len(b))
        if not set(b) & set(DIGITS):
            tail = "".join(r.choice(digits) for _ in range(r.randint(1, 4)))
            b = b[: length - len(tail)] + tail.encode()
        if set(b) <= set(DIGITS):
            b = bytes([r.choice(others)]) + b[1:]
        out.append(b)
    return out


_NULL: dict[tuple[str, int], np.ndarray] = {}


def null_model(encoding: str, length: int) -> np.ndarray:
    """The battery's p-values for ordinary names, ascending; made once by a worker."""
    known = _NULL.get((encoding, length))
    if known is None:
        alphabet = dict(ALPHABETS)[encoding]
        known = _NULL[encoding, length] = np.sort(battery_p(_places(ordinary_names(encoding, length), alphabet), len(alphabet)))
    return known


def chance(p: float, null: np.ndarray) -> float:
    """The share of ordinary names that look at least as random as p, from the ascending p-values of the null model.

    Beyond its TAIL largest the share falls exponentially with the logarithm of p, at the rate of those.
    """
    edge, own = np.log(null[-TAIL]), math.log(max(p, 1e-300))
    if own <= edge:
        return (len(null) - np.searchsorted(null, p) + 1) / (len(null) + 1)
    rate = 1 / max(1e-3, float(np.mean(np.log(null[-TAIL:]) - edge)))
    return TAIL / len(null) * math.exp(-rate * (own - edge))


def steps_ordinary(data: bytes, encoding: str) -> tuple[int, int]:
    """(length of the null model's names, how often the chance of being one of them halves from 1, in STEPS)."""
    body, alphabet = data.rstrip(b"="), dict(ALPHABETS)[encoding]
    length = max(n for n in LENGTHS if n <= max(len(body), LENGTHS[0]))
    share = chance(float(battery_p(_places([body], alphabet), len(alphabet))[0]), null_model(encoding, length))
    return length, min(MOST_STEPS, int(-math.log2(max(share, 1e-300)) * STEPS))


def threshold(counts: dict[tuple[int, int], int], level: float) -> dict[int, int]:
    """For each length the fewest steps with which a candidate is reported, from the number of candidates by (length,
    steps): Benjamini-Hochberg with weights in proportion to length."""
    m = sum(counts.values())
    mean = sum(n * c for (n, _), c in counts.items()) / max(1, m)
    of = lambda n, k: 2.0 ** (-k / STEPS) * mean / n
    most, rank = -1.0, 0
    for p, c in sorted((of(n, k), c) for (n, k), c in counts.items()):
        rank += c
        if p <= level * rank / m:
            most = p
    return {n: min((k for n_, k in counts if n_ == n and of(n, k) <= most), default=MOST_STEPS + 1) for n, _ in counts}


def scan(text: bytes, battery: Battery = Battery()) -> tuple[list[tuple[int, int, str]], list[tuple[int, int, int, int]]]:
    """(base spans, candidates): (start, end, kind) by start and then kind in the order of KINDS; (start, end, length and
    steps of steps_ordinary). All places are in code points."""
    spans = [(m.start(), m.end(), "assign") for m in ASSIGN.finditer(text) if m.end(2) - m.start(2) >= 12]
    spans += [(m.start(), m.end(), "access") for m in ACCESS.finditer(text) if m.end() - m.start() >= 18]
    spans += [(m.start(), m.end(), "hex") for m in HEX.finditer(text)]
    taken = sorted((a, b) for a, b, _ in spans)
    tests, i = [], 0
    least = battery.least()
    for m in re.finditer(rb"[A-Za-z0-9+/_=-]{%d,}" % least, text):  # shorter runs hold fewer bits in any alphabet
        for start, end in candidates(m[0], least):
            start, end = m.start() + start, m.start() + end
            while i < len(taken) and taken[i][1] <= start:
                i += 1
            if any(a < end for a, _ in taken[i : i + 1]):
                continue
            data = text[start:end]
            known = infer(data)
            if known and len(data) * math.log2(len(known[1])) >= battery.bits:
                tests.append((start, end, *steps_ordinary(data, known[0])))
    spans.sort(key=lambda x: (x[0], KINDS.index(x[2])))
    if (spans or tests) and not text.isascii():
        points, at, n = {}, 0, 0
        for p in sorted({p for x in [*spans, *tests] for p in x[:2]}):
            n += len(text[at:p].decode())
            at = p
            points[p] = n
        spans, tests = ([(points[x[0]], points[x[1]], *x[2:]) for x in xs] for xs in (spans, tests))
    return spans, tests


def reported(spans: list[tuple[int, int, str]], tests: list[tuple[int, int, int, int]], least: dict[int, int]) -> list[tuple[int, int, str]]:
    """All spans of a text: the base ones, and the candidates that the control lets through, overlapping ones made one."""
    own = merged(sorted((a, b, "random") for a, b, n, k in tests if k >= least.get(n, MOST_STEPS + 1)))
    return sorted(spans + own, key=lambda x: (x[0], KINDS.index(x[2])))


def joined(spans: list[tuple[int, int, str]]) -> str:
    return ",".join(f"{k}:{a}:{b}" for a, b, k in spans)


_FIRST = pa.schema(
    [("doc_id", pa.int64()), ("n_assign", pa.int64()), ("n_access", pa.int64()), ("n_hex", pa.int64()), ("base_sha256", pa.string()), ("base", pa.string()), ("tests", pa.list_(pa.list_(pa.int64())))]
)


def scan_documents(docs: DataFrame, battery: Battery = Battery()) -> DataFrame:
    """(doc_id, n_assign, n_access, n_hex, base_sha256, spans, n_random) for every row of docs.

    Base kinds are leftmost and non-overlapping within a kind, matches that are too short dropped after
    matching; a span covers the whole match. A null or empty text has no spans. Null or repeated doc_id stay,
    other columns are ignored. Whole texts are read, once, to a narrow table of spans and candidates, whose counts
    by length and chance (at most len(LENGTHS) * MOST_STEPS rows) set the bounds for the whole corpus. No shuffle but theirs.
    """

    def rows(x):
        out = {f.name: [] for f in _FIRST}
        out["doc_id"] = x["doc_id"]
        for text in x["text"]:
            spans, tests = scan(text, battery)
            for kind in KINDS[:3]:
                out[f"n_{kind}"].append(sum(s[2] == kind for s in spans))
            out["base"].append(joined(spans))
            out["base_sha256"].append(hashlib.sha256(joined(spans).encode()).hexdigest())
            out["tests"].append(tests)
        return out

    schema = "doc_id long, n_assign long, n_access long, n_hex long, base_sha256 string"
    first = materialize(docs.select(F.col("doc_id").cast("long").alias("doc_id"), text_bytes().alias("text")).mapInArrow(by_rows(rows, _FIRST), f"{schema}, base string, tests array<array<long>>"))
    test = F.col("t")
    counts = first.where(F.size("tests") > 0).select(F.explode("tests").alias("t")).groupBy(test[2].alias("n"), test[3].alias("k")).agg(F.count("*").alias("c")).collect()
    least = threshold({(r["n"], r["k"]): r["c"] for r in counts}, battery.level)

    def finish(batches: Iterator[pa.RecordBatch]) -> Iterator[pa.RecordBatch]:
        for batch in batches:
            spans, n = [], []
            for base, tests in zip(batch.column("base").to_pylist(), batch.column("tests").to_pylist()):
                if tests:
                    known = [(int(a), int(b), kind) for kind, a, b in (x.split(":") for x in base.split(",") if x)]
                    found = reported(known, [tuple(t) for t in tests], least)
                    spans.append(joined(found))
                    n.append(len(found) - len(known))
                else:
                    spans.append(base)
                    n.append(0)
            names = ["doc_id", "n_assign", "n_access", "n_hex", "base_sha256"]
            yield pa.RecordBatch.from_arrays([*(batch.column(c) for c in names), pa.array(spans, pa.string()), pa.array(n, pa.int64())], names=[*names, "spans", "n_random"])

    return first.mapInArrow(finish, f"{schema}, spans string, n_random long")
