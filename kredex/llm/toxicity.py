"""Toxicity of texts restored by a noisy-channel decoder.

*Channel.* Writers hide words in three ways: look-alike symbols for letters
(``1d10t``), letters set apart (``i d i o t``, ``i.d.i.o.t``) and repetition
(``idiooot``). A piece of text that shows one of these becomes a lattice: every
symbol may be each letter it stands for or itself, every repeated letter and
every separator may be dropped, each at a cost.

*Source.* A character trigram model, counted over all documents: the letters
a-z, one symbol for letters past ASCII, one for everything between words. Its
table has at most 28 ** 3 cells, so collecting it has a fixed bound.

*Decoding.* Viterbi over (last two characters) finds the likeliest letters of
each lattice; texts without such pieces are their own restoration. Pieces end
at ``LONGEST`` symbols and go on in the next one, so a text of any length is
decoded whole.

*Score.* Words of the restored text, and word stems that it repeats, that tell
the labels apart (log-odds at least ``LEAST_Z`` standard errors from 0, in at least ``LEAST_DOCS`` texts) feed a
logistic regression with an L2 penalty. Copies of a text tell nothing new, so
training rows that share a smallest three-word shingle hash (of ``KEYS`` hash
functions, the largest such group) share a weight of 1. The training sample is bounded: about ``MOST_LABELS`` rows of each label,
by a hash of the id, and their weights restore the labels' real shares.

Defined cases: null text is empty and scores like a text without telling words;
null ids are in no training fold and not held out; without both labels every
score is the share of label 1 (0.5 without labels); repeated rows are rows;
empty tables give no rows; other columns are ignored.
"""

from __future__ import annotations

import math
import re
import zlib
from collections import Counter
from collections.abc import Iterator
from dataclasses import dataclass

import numpy as np
import pyarrow as pa
from pyspark.sql import DataFrame
from pyspark.sql import functions as F

from .common import crc_mod, likely_in, map_texts, stored

# Look-alikes of letters.
LOOKS = {"0": "o", "1": "il", "2": "z", "3": "e", "4": "a", "5": "s", "6": "g", "7": "t", "8": "b", "9": "g",
         "@": "a", "$": "s", "!": "il", "|": "il", "+": "t", "(": "c", "*": "aeiou"}
LETTERS = "abcdefghijklmnopqrstuvwxyz"
OTHER, GAP = 26, 27                 # a letter past ASCII; anything between words
SIZE = 28
#: Costs of the channel, in nats: a look-alike; a letter dropped from a run of
#: three or more, or from a pair; a separator kept between letters set apart; a
#: symbol that stands for itself.
SWAP, REPEAT, PAIR, KEEP, SELF = 1.0, 0.5, 7.0, 3.0, 8.0
PRIOR = 0.1
#: Symbols decoded as one lattice.
LONGEST = 256
CACHE = 1 << 16

MOST_LABELS = 8000
CUT = 0.7
LEAST_DOCS, LEAST_Z = 5, 4.0
MOST_FEATURES = 2000
L2, STEPS = 0.05, 400
KEYS = 4
STEMS = (5, 6, 7, 8)


def _classes() -> np.ndarray:
    t = np.full(256, GAP, np.uint8)
    t[0x61:0x7B] = t[0x41:0x5B] = np.arange(26)
    t[0x80:] = OTHER
    return t


CLASS = _classes()


def count_trigrams(docs: DataFrame, text: str = "text") -> np.ndarray:
    """Counts of three consecutive characters over all texts, each between two
    gaps; runs of gaps are one. At most SIZE ** 3 rows reach the driver."""

    def run(batches: Iterator[pa.RecordBatch]) -> Iterator[pa.RecordBatch]:
        total = np.zeros(SIZE ** 3, np.int64)
        edge = np.full(2, GAP, np.uint8)
        for b in batches:
            for v in b.column(0):
                if not v.is_valid:
                    continue
                c = CLASS[np.frombuffer(v.as_buffer(), np.uint8)]
                keep = np.ones(len(c), bool)
                keep[1:] = (c[1:] != GAP) | (c[:-1] != GAP)
                c = np.concatenate([edge, c[keep], edge[:1]]).astype(np.int32)
                total += np.bincount((c[:-2] * SIZE + c[1:-1]) * SIZE + c[2:], minlength=SIZE ** 3)
        some = np.flatnonzero(total)
        yield pa.RecordBatch.from_arrays([pa.array(some, pa.int64()), pa.array(total[some], pa.int64())], names=["k", "n"])

    out = np.zeros(SIZE ** 3, np.int64)
    rows = docs.select(F.col(text).cast("binary").alias("text")).mapInArrow(run, "k long, n long")
    for r in rows.groupBy("k").agg(F.sum("n").alias("n")).collect():
        out[r["k"]] = r["n"]
    return out


def language_model(counts: np.ndarray) -> np.ndarray:
    """Cost, in nats, of a character after two others: trigram shares smoothed
    by bigram shares, those by the share of the character."""
    c3 = counts.reshape(SIZE, SIZE, SIZE).astype(float)
    c2, c1 = c3.sum(0), c3.sum((0, 1))
    p1 = (c1 + PRIOR) / (c1.sum() + PRIOR * SIZE)
    p2 = (c2 + 10 * PRIOR * p1) / (c2.sum(1, keepdims=True) + 10 * PRIOR)
    return -np.log((c3 + 10 * PRIOR * p2) / (c3.sum(2, keepdims=True) + 10 * PRIOR))


_LETTER = np.isin(np.arange(256), np.frombuffer(LETTERS.encode(), np.uint8))
_LOOK = np.isin(np.arange(256), np.frombuffer("".join(LOOKS).encode(), np.uint8))
_SEPARATOR = np.isin(np.arange(256), np.frombuffer(b" .-_*~/", np.uint8))
_OTHER = np.arange(256) >= 0x80


def signs(low: list[bytes]) -> list[bool]:
    """Which of the lower-cased texts can hold a hidden word: a letter three
    times, a look-alike beside a letter, three single symbols set apart."""
    text = np.frombuffer(b"\0\0\0\0\0".join([*low, b""]), np.uint8)
    if not len(text):
        return []
    letter, look, gap = _LETTER[text], _LOOK[text], _SEPARATOR[text]
    hit = np.zeros(len(text), bool)
    hit[:-2] |= letter[:-2] & (text[:-2] == text[1:-1]) & (text[1:-1] == text[2:])
    hit[:-1] |= letter[:-1] & look[1:] | look[:-1] & letter[1:]
    body = letter | look & ~gap | _OTHER[text]
    single = letter | look
    single[1:] &= ~body[:-1]
    single[:-1] &= ~body[1:]
    hit[:-4] |= single[:-4] & gap[1:-3] & single[2:-2] & gap[3:-1] & single[4:]
    total = np.concatenate([[0], np.cumsum(hit)])
    end = np.cumsum([len(t) + 5 for t in low])
    start = np.concatenate([[0], end[:-1]])
    return (total[end] > total[start]).tolist()


class Decoder:
    """Restores the letters of hidden words."""

    # a letter three times, a look-alike beside a letter, letters set apart
    HIDDEN = re.compile(rb"""
        (?<![a-z0-9\x80-\xff])[a-z@$!|0-9](?:[ .\-_*~/][a-z@$!|0-9](?![a-z0-9\x80-\xff])){2,}
      | [a-z0-9@$!|+(*]*?(?:([a-z])\1\1|[a-z][0-9@$!|+(*]+(?=[a-z])|[0-9@$!|+(]+(?=[a-z]{2})|[a-z][0-9@$]+)(?:[a-z0-9@$!|+(*]*[a-z0-9@$])?
    """, re.X)
    def __init__(self, cost: np.ndarray):
        self.cost = cost.tolist()
        self.known: dict[bytes, bytes] = {}

    def restore(self, texts: list[bytes]) -> list[bytes]:
        """The texts in lower case, hidden words in plain letters."""
        low = [t.lower() for t in texts]
        return [self.HIDDEN.sub(self._piece, t) if s else t for t, s in zip(low, signs(low))]

    def _piece(self, m: re.Match) -> bytes:
        piece = m[0]
        if piece.upper() == piece:              # numbers and marks alone
            return piece
        got = self.known.get(piece) if len(piece) <= 64 else None
        if got is None:
            got = b"".join(self.decode(piece[i:i + LONGEST]) for i in range(0, len(piece), LONGEST))
            if len(piece) <= 64 and len(self.known) < CACHE:
                self.known[piece] = got
        return got

    def decode(self, piece: bytes) -> bytes:
        """The likeliest restoration of one lattice."""
        return self.reading(piece)[1]

    def reading(self, piece: bytes) -> tuple[float, bytes]:
        """The least cost of a lattice and its text: best (cost, text) by the
        last two characters."""
        symbols = piece.decode("latin-1")
        apart = len(symbols) > 2 and all(x in " .-_*~/" for x in symbols[1::2])
        # of a symbol, how often it stands in a row
        runs = [len(m[0]) for m in re.finditer(r"(.)\1*", symbols, re.S) for _ in m[0]]
        # state: (character before, last character) -> cost, path (linked back)
        best: dict[tuple[int, int], tuple[float, tuple | None]] = {(GAP, GAP): (0.0, None)}
        for at, s in enumerate(symbols):
            separator = apart and at % 2 == 1
            options: list[tuple[int, str, float]] = []
            if "a" <= s <= "z":
                options.append((ord(s) - 97, s, 0.0))
            else:
                if not separator:
                    options += [(ord(x) - 97, x, SWAP + math.log(len(LOOKS[s]))) for x in LOOKS.get(s, "")]
                options.append((GAP, s, KEEP if separator else SELF))
            then: dict[tuple[int, int], tuple[float, tuple | None]] = {}
            for (a, b), (cost, path) in best.items():
                row = self.cost[a][b]
                for c, x, own in options:
                    if c == GAP and b == GAP:                 # gaps are one
                        key, total = (a, b), cost + own
                    else:
                        key, total = (b, c), cost + own + row[c]
                    if key not in then or total < then[key][0]:
                        then[key] = (total, (path, x))
                    if c == b and c < OTHER:                  # a repetition
                        total = cost + own + (REPEAT if runs[at] > 2 or apart else PAIR)
                        if (a, b) not in then or total < then[a, b][0]:
                            then[a, b] = (total, (path, ""))
                if separator and ((a, b) not in then or cost < then[a, b][0]):
                    then[a, b] = (cost, (path, ""))
            best = then
        least, _, path = min((cost + (self.cost[a][b][GAP] if b != GAP else 0.0), k, path)
                             for k, ((a, b), (cost, path)) in enumerate(best.items()))
        out = []
        while path is not None:
            path, x = path
            out.append(x)
        return least, "".join(reversed(out)).encode("latin-1")


_MARKS = bytes(c if 0x61 <= c <= 0x7A or c >= 0x80 else 0x20 for c in range(256))


def words(restored: bytes) -> list[bytes]:
    return restored.translate(_MARKS).split()


def clues(restored: bytes) -> set[bytes]:
    """What may tell the labels apart: the words, and the stems (first STEMS
    bytes, with a mark before) that two or more longer words share."""
    found = words(restored)
    out = set(found)
    for n in STEMS:
        count = Counter(w[:n] for w in found if len(w) > n)
        out.update(b"^" + w for w, k in count.items() if k > 1)
    return out


@dataclass
class Scorer:
    weight: dict[bytes, float]
    bias: float

    def score(self, restored: bytes) -> float:
        found = words(restored)
        hits = self.weight.keys() & set(found)
        for n in STEMS:
            stems = self.stems(n)
            count = Counter(w[:n] for w in found if w[:n] in stems and len(w) > n) if stems else {}
            hits.update(b"^" + w for w, k in count.items() if k > 1)
        z = self.bias + sum(self.weight[w] for w in sorted(hits))
        return 1 / (1 + math.exp(-max(-35.0, min(35.0, z))))


    def stems(self, n: int) -> set[bytes]:
        if not hasattr(self, "_stems"):
            self._stems = {k: {w[1:] for w in self.weight if w[:1] == b"^" and len(w) == k + 1} for k in STEMS}
        return self._stems[n]


def fit(rows: list[tuple[float, int, list[int]]], names: list[bytes]) -> Scorer:
    """From (weight, label, indices of the telling words) rows."""
    w = np.array([r[0] for r in rows])
    y = np.array([r[1] for r in rows], float)
    x = np.zeros((len(rows), len(names) + 1), np.float32)
    x[:, -1] = 1
    for i, r in enumerate(rows):
        x[i, r[2]] = 1
    penalty = np.full(len(names) + 1, L2)
    penalty[-1] = 0
    share = np.clip((w * y).sum() / w.sum(), 1e-4, 1 - 1e-4)
    b = np.zeros(len(names) + 1)
    b[-1] = math.log(share / (1 - share))
    # steps along the diagonal of the curvature's bound
    reach = (w[:, None] * x * x.sum(1, keepdims=True)).sum(0) / 4 + penalty
    v = np.zeros_like(b)
    for _ in range(STEPS):
        p = 1 / (1 + np.exp(-np.clip(x @ b, -35, 35)))
        v = 0.9 * v - 0.5 * (x.T @ (w * (p - y)) + penalty * b) / reach
        b = b + v
    return Scorer(dict(zip(names, b[:-1].tolist())), float(b[-1]))


def _copy_keys(restored: bytes) -> list[int]:
    """Smallest hashes of the three-word shingles under KEYS hash functions:
    near copies share most of them."""
    w = words(restored)
    h = np.array([zlib.crc32(b" ".join(w[i:i + 3])) for i in range(max(1, len(w) - 2))], np.uint64)
    return [int((h * np.uint64(2 * k + 1) * np.uint64(0x9E3779B1) % np.uint64(0xFFFFFFFB)).min()) for k in range(KEYS)]


def train(docs: DataFrame, labels: DataFrame, cost: np.ndarray, doc_id: str = "doc_id", text: str = "text",
          label: str = "toxic") -> Scorer:
    """Fits the scorer on the labelled rows of the training fold (see the
    module's bounds)."""
    rows = labels.where((crc_mod(doc_id, 3) != 1) & F.col(label).isin(0, 1)).select(
        F.col(doc_id).alias("i"), F.col(label).cast("int").alias("y"))
    counts = {r["y"]: r["count"] for r in rows.groupBy("y").count().collect()}
    if len(counts) < 2:
        return Scorer({}, 35.0 * (1 if counts.get(1) else -1) if counts else 0.0)
    share = {y: min(1.0, MOST_LABELS / n) for y, n in counts.items()}
    point = F.pmod(F.xxhash64("i", F.lit(11)), F.lit(1 << 30)) / float(1 << 30)
    of_label = F.when(F.col("y") == 1, F.lit(share[1])).otherwise(F.lit(share[0]))
    # the bound holds for any input: rows are cut by the hash that picks them
    picked = stored(rows.withColumn("p", point).where(F.col("p") < of_label).orderBy("p", "i", "y").limit(4 * MOST_LABELS))
    texts = likely_in(docs.select(F.col(doc_id).alias("i"), F.col(text).alias("t")), picked, "i").join(picked, "i")

    def make():
        decoder = Decoder(cost)

        def run(batch: list[bytes]) -> dict[str, list]:
            got = decoder.restore(batch)
            return {"copies": [_copy_keys(t) for t in got], "w": [sorted(clues(t)) for t in got]}

        return run

    sample = stored(map_texts(texts, "t", ["i", "y"], "copies array<long>, w array<binary>", make))
    sample = sample.withColumn("row", F.monotonically_increasing_id())
    keys = sample.select("row", F.posexplode("copies").alias("k", "key"))
    often = keys.join(keys.groupBy("k", "key").agg(F.count(F.lit(1)).alias("m")), ["k", "key"])
    weighed = sample.join(often.groupBy("row").agg(F.max("m").alias("m")), "row").select(
        "y", "w", (1 / F.col("m")).alias("weight"))
    sums = {r["y"]: r["n"] for r in weighed.groupBy("y").agg(F.sum("weight").alias("n")).collect()}
    if len(sums) < 2:
        return Scorer({}, 0.0)
    # words whose log-odds lie clear of 0, weights standing for texts
    n0, n1 = F.lit(sums[0]), F.lit(sums[1])
    of = (weighed.select("y", "weight", F.explode("w").alias("w")).groupBy("w")
          .agg(F.sum(F.when(F.col("y") == 1, F.col("weight")).otherwise(0.0)).alias("a"),
               F.sum(F.when(F.col("y") == 0, F.col("weight")).otherwise(0.0)).alias("b")))
    a, b = F.col("a") + 0.5, F.col("b") + 0.5
    odds = F.log(a / (n1 - F.col("a") + 0.5)) - F.log(b / (n0 - F.col("b") + 0.5))
    z = F.abs(odds) / F.sqrt(1 / a + 1 / b)
    telling = (of.where((F.col("a") + F.col("b") >= LEAST_DOCS) & (z >= LEAST_Z))
               .select("w", F.round(z, 6).alias("z")).orderBy(F.desc("z"), "w").limit(MOST_FEATURES).collect())
    names = sorted(bytes(r["w"]) for r in telling)
    place = {w: k for k, w in enumerate(names)}

    def indexed(batches: Iterator[pa.RecordBatch]) -> Iterator[pa.RecordBatch]:
        for x in batches:
            hits = [sorted(place[w] for w in ws if w in place) for ws in x["w"].to_pylist()]
            yield pa.RecordBatch.from_arrays([x["y"], x["weight"], pa.array(hits, pa.list_(pa.int64()))], names=["y", "weight", "x"])

    got = weighed.mapInArrow(indexed, "y int, weight double, x array<long>").collect()      # a bounded sample
    return fit(sorted((r["weight"] / share[r["y"]], r["y"], list(r["x"])) for r in got), names)


def predict(docs: DataFrame, scorer: Scorer, cost: np.ndarray, keep: list[str], text: str = "text") -> DataFrame:
    """``keep`` columns, ``score`` and ``predicted``."""

    def make():
        decoder = Decoder(cost)

        def run(texts: list[bytes]) -> dict[str, list]:
            return {"score": [scorer.score(t) for t in decoder.restore(texts)]}

        return run

    return (map_texts(docs, text, keep, "score double", make)
            .withColumn("predicted", F.when(F.col("score") >= CUT, 1).otherwise(0)))


def restored_texts(docs: DataFrame, keep: list[str], text: str = "text", cost: np.ndarray | None = None) -> DataFrame:
    """``keep`` columns and ``restored``, the text in lower case with hidden
    words in plain letters."""
    cost = language_model(count_trigrams(docs, text)) if cost is None else cost

    def make():
        decoder = Decoder(cost)
        return lambda texts: {"restored": decoder.restore(texts)}

    return map_texts(docs, text, keep, "restored binary", make)


def score_toxicity(docs: DataFrame, labels: DataFrame, doc_id: str = "doc_id", text: str = "text",
                   label: str = "toxic") -> DataFrame:
    """Per document: doc_id, held_out, score, predicted. Learns from labels
    whose fold (crc32 of the id as text, modulo 3) is not 1."""
    cost = language_model(count_trigrams(docs, text))
    scorer = train(docs, labels, cost, doc_id, text, label)
    rows = docs.select(F.col(doc_id).alias("doc_id"), F.col(text).alias("text"),
                       F.coalesce(crc_mod(doc_id, 3) == 1, F.lit(False)).alias("held_out"))
    return predict(rows, scorer, cost, ["doc_id", "held_out"])
