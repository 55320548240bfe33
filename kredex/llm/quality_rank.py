"""Quality classifier by Bradley-Terry pairwise ranking.

A document's strength is linear in features of its text. For a pair of
documents of which one is labelled better, the Bradley-Terry model gives the
better one's win the probability sigmoid(strength difference), so learning is
logistic loss on feature differences. The pairs are every labelled row of label
1 with every one of label 0, in the folds for training. The threshold is the
quantile of the training strengths at the share of label 0; strengths are
shifted and scaled so that this quantile scores ``CUT``.

All pairs in linear time: a pair's terms are smooth functions of its two
strengths, so they are interpolated on Chebyshev nodes in cells of the strength
axis (to about 1e-12 of a term). One pass sums, per cell, node and label, the
rows' weights, features and feature products; the pair sums are then taken over
nodes on the driver, whose work and memory do not grow with the rows. The loss
is minimised by Newton steps, one pass each, until they no longer gain. The
quantile is an order statistic of all training rows, selected by digits.

Features are computed once per document and stored; training and scoring read
them. A document labelled twice counts per label row.

Defined cases: null text is empty; an empty text has a score like any other
(all its features are 0); null ids are in no training fold and not held out;
without both labels every score is the prior (share of label 1, 0.5 without
labels); repeated rows are rows; empty tables give no rows; other columns are
ignored.
"""

from __future__ import annotations

import math
from collections import Counter
from collections.abc import Callable, Iterator
from dataclasses import dataclass

import numpy as np
import pyarrow as pa
from pyspark import TaskContext
from pyspark.sql import DataFrame
from pyspark.sql import functions as F

from .common import crc_mod, dropped, map_texts, stored

#: Rows per label of ``sample``; the ranker itself learns from all of them.
MOST_LABELS = 4000
CUT = 0.3
L2 = 1e-3
#: Passes of Newton's method at most (about 10 are needed), and the gain of a
#: step below which it ends.
PASSES = 100
GAIN = 1e-12
#: Width of a cell of the strength axis, and Chebyshev nodes in it.
CELL = 2.0
NODES = 16

FEATURES = ("log_words", "word_bytes", "symbols", "capitals", "digits", "marks", "pipes", "not_ascii",
            "line_words", "repeated_lines", "repeated_words", "top_word", "runs", "long_words", "odd_words")


def features(text: bytes) -> list[float]:
    """Fixed-length description of a text, shares where possible."""
    words = text.split()
    if not words:
        return [0.0] * len(FEATURES)
    n, size = len(words), sum(map(len, words))
    lines = [x for x in text.split(b"\n") if x.strip()]
    counts = Counter(words)
    plain = text.translate(None, b" \t\n\r\x0b\x0c")
    letters = plain.translate(None, _NOT_LETTERS)
    return [
        math.log1p(n),
        size / n,
        sum(map(plain.count, (b"#", b"*", b"$", b"%", b"&", b"<", b">"))) / size,
        len(letters.translate(None, _SMALL)) / max(1, len(letters)),
        len(plain) and (len(plain) - len(plain.translate(None, b"0123456789"))) / size,
        (plain.count(b"!") + plain.count(b"?")) / size,
        plain.count(b"|") / n,
        (size - len(plain.translate(None, _HIGH))) / size,
        math.log1p(n / len(lines)),
        1 - len(set(lines)) / len(lines),
        1 - len(counts) / n,
        max(counts.values()) / n,
        sum(a == b for a, b in zip(words, words[1:])) / n,
        sum(len(w) > 24 for w in words) / n,
        sum(not w[:1].isalpha() and w[0] < 0x80 for w in words) / n,
    ]


_NOT_LETTERS = bytes(c for c in range(256) if not (65 <= c <= 90 or 97 <= c <= 122))
_SMALL = bytes(range(97, 123))
_HIGH = bytes(range(128, 256))


def _featurer():
    def run(texts: list[bytes]) -> dict[str, list]:
        return {"x": [features(t) for t in texts]}

    return run


@dataclass
class Ranker:
    mean: np.ndarray
    scale: np.ndarray
    weight: np.ndarray
    shift: float
    spread: float
    prior: float

    def score(self, x: np.ndarray) -> np.ndarray:
        z = (np.clip((x - self.mean) / self.scale, -8, 8) @ self.weight - self.shift) / self.spread
        return 1 / (1 + np.exp(-np.clip(z + math.log(CUT / (1 - CUT)), -35, 35)))


#: Sums of ``f(features, labels)``, an array per key, over all training rows.
Summed = Callable[[Callable[[np.ndarray, np.ndarray], dict[int, np.ndarray]]], dict[int, np.ndarray]]


def fit(x: np.ndarray, y: np.ndarray) -> Ranker | float:
    """``train`` on features and 0/1 labels in memory."""
    return train(lambda f: f(x, y))


def train(summed: Summed) -> Ranker | float:
    """A ranker from all pairs of the rows that ``summed`` goes over; the share
    of label 1 when only one label (or none) is present."""
    got = summed(lambda x, y: {0: np.array([len(y), (y == 1).sum()], float), 1: x.sum(0)})
    n, n_good = got[0] if got else (0.0, 0.0)
    n_bad = n - n_good
    if not n_good or not n_bad:
        return float(n_good / n) if n else 0.5
    mean = got[1] / n
    scale = np.sqrt(summed(lambda x, y: {0: ((x - mean) ** 2).sum(0)})[0] / n) + 1e-6
    best, w, step = -math.inf, np.zeros(len(mean)), np.zeros(len(mean))
    for _ in range(PASSES):
        at = w + step
        cells = summed(lambda x, y: _cells(_standard(x, mean, scale), y, at))
        value, gradient, curve = _pair_sums(cells, n_good * n_bad)
        value -= L2 / 2 * at @ at
        if value < best - GAIN:           # the step was too long
            step = step / 2
            continue
        gain, best, w = value - best, value, at
        if gain < GAIN:
            break
        step = np.linalg.solve(curve + L2 * np.eye(len(w)), gradient - L2 * w)
    # the quantile at the share of label 0, midway to its neighbour above
    ranks = [int(n_bad) - 1, min(int(n_bad), int(n) - 1)]
    shift = sum(_order_statistics(summed, lambda x: _strength(_standard(x, mean, scale), w), ranks)) / 2
    total = sum(m.sum((0, 1)) for m in summed(lambda x, y: _cells(_standard(x, mean, scale), y, w)).values()) / n
    first, second = total[1:1 + len(w)], _square(total[1 + len(w):], len(w))
    spread = math.sqrt(max(0.0, w @ second @ w - (first @ w) ** 2))
    return Ranker(mean, scale, w, shift, max(spread / 2, 1e-6), float(n_good / n))


def _standard(x: np.ndarray, mean: np.ndarray, scale: np.ndarray) -> np.ndarray:
    return np.clip((x - mean) / scale, -8, 8)


def _strength(s: np.ndarray, w: np.ndarray) -> np.ndarray:
    return (s * w).sum(1)                 # a row's value does not depend on its batch


_PLACES = np.cos((np.arange(NODES) + 0.5) * math.pi / NODES)
_TO_NODES = np.cos(np.outer(np.arange(NODES), np.arccos(_PLACES))) * np.where(np.arange(NODES) > 0, 2, 1)[:, None] / NODES


def _square(flat: np.ndarray, d: int) -> np.ndarray:
    """Symmetric matrices (last two axes) from their upper triangles (last axis)."""
    out = np.zeros((*flat.shape[:-1], d, d))
    i, j = np.triu_indices(d)
    out[..., i, j] = out[..., j, i] = flat
    return out


def _cells(s: np.ndarray, y: np.ndarray, w: np.ndarray) -> dict[int, np.ndarray]:
    """Per cell of the strength axis: (label, node) -> interpolation weight, and
    by that weight the features and their products, summed over the rows."""
    strength = _strength(s, w)
    cell = np.floor(strength / CELL).astype(int)
    place = np.clip(strength / CELL * 2 - 2 * cell - 1, -1, 1)
    to_nodes = np.cos(np.arccos(place)[:, None] * np.arange(NODES)) @ _TO_NODES
    i, j = np.triu_indices(s.shape[1])
    terms = np.concatenate([np.ones((len(s), 1)), s, s[:, i] * s[:, j]], axis=1)
    return {int(c): np.stack([to_nodes[at].T @ terms[at] for at in ((cell == c) & (y == label) for label in (0, 1))])
            for c in np.unique(cell)}


def _pair_sums(cells: dict[int, np.ndarray], pairs: float) -> tuple[float, np.ndarray, np.ndarray]:
    """Mean log likelihood of all pairs, its gradient and its negated second
    derivative, from the sums of ``_cells``."""
    d = int((math.sqrt(8 * next(iter(cells.values())).shape[2] + 1) - 3) / 2)
    each = [((c + (_PLACES + 1) / 2) * CELL, m) for c, m in sorted(cells.items())]
    value, gradient, curve = 0.0, np.zeros(d), np.zeros((d, d))
    split = lambda m: (m[:, 0], m[:, 1:1 + d], m[:, 1 + d:])
    for at_bad, bad in ((at, m[0]) for at, m in each):
        n_bad, x_bad, xx_bad = split(bad)
        for at_good, good in ((at, m[1]) for at, m in each):
            n_good, x_good, xx_good = split(good)
            behind = at_bad[None, :] - at_good[:, None]
            lose = 1 / (1 + np.exp(-np.clip(behind, -700, 700)))       # probability of the worse one
            value -= n_good @ np.logaddexp(0, behind) @ n_bad
            gradient += (lose @ n_bad) @ x_good - (n_good @ lose) @ x_bad
            slope = lose * (1 - lose)
            cross = x_good.T @ slope @ x_bad
            curve += _square((slope @ n_bad) @ xx_good + (n_good @ slope) @ xx_bad, d) - cross - cross.T
    return float(value / pairs), gradient / pairs, curve / pairs


#: Bits of a digit by which order statistics are selected; a pass each.
DIGIT = 16


def _order_statistics(summed: Summed, value: Callable[[np.ndarray], np.ndarray], ranks: list[int]) -> list[float]:
    """The values of these ranks (from 0) among all rows: their bits, made to
    sort like the numbers, are found digit by digit from counts."""
    found, left = [0] * len(ranks), list(ranks)
    for shift in range(64 - DIGIT, -1, -DIGIT):
        prefixes = list(dict.fromkeys(found))

        def counts(x, y):
            bits = (value(x) + 0.0).view(np.int64)
            keys = np.where(bits < 0, ~bits, bits | np.int64(-1 << 63)).view(np.uint64)
            above = keys >> np.uint64(shift) >> np.uint64(DIGIT) if shift + DIGIT < 64 else np.zeros_like(keys)
            digit = (keys >> np.uint64(shift) & np.uint64((1 << DIGIT) - 1)).astype(int)
            return {k: np.bincount(digit[above == np.uint64(p)], minlength=1 << DIGIT).astype(float)
                    for k, p in enumerate(prefixes)}

        got = summed(counts)
        for r, p in enumerate(list(found)):
            upto = np.cumsum(got[prefixes.index(p)])
            digit = int(np.searchsorted(upto, left[r], side="right"))
            left[r] -= int(upto[digit - 1]) if digit else 0
            found[r] = p << DIGIT | digit
    keys = np.array(found, np.uint64)
    bits = np.where(keys >> np.uint64(63) > 0, keys & np.uint64((1 << 63) - 1), ~keys)
    return bits.view(np.float64).tolist()


def summed_over(rows: DataFrame) -> Summed:
    """Sums over the stored ``rows`` (x, y). A task returns an array per key;
    the tasks' arrays are summed per key, in the order of the tasks, so a rerun
    over the same table gives the same bits."""
    def summed(f):
        def partial(batches: Iterator[pa.RecordBatch]) -> Iterator[pa.RecordBatch]:
            total: dict[int, np.ndarray] = {}
            for b in batches:
                if b.num_rows:
                    x = b.column(0).flatten().to_numpy(zero_copy_only=False).reshape(b.num_rows, -1)
                    _add(total, f(x, b.column(1).to_numpy(zero_copy_only=False)))
            task = TaskContext.get().partitionId()
            yield from _sent((k, task, v) for k, v in total.items())

        def whole(batches: Iterator[pa.RecordBatch]) -> Iterator[pa.RecordBatch]:
            total: dict[int, np.ndarray] = {}
            for b in batches:
                for k, shape, v in zip(b.column(0).to_pylist(), b.column(2).to_pylist(), b.column(3).to_pylist()):
                    _add(total, {k: np.frombuffer(v).reshape(shape)})
            yield from _sent((k, 0, v) for k, v in total.items())

        got = (rows.select("x", "y").mapInArrow(partial, _SENT).repartition("k").sortWithinPartitions("k", "task")
               .mapInArrow(whole, _SENT).collect())
        return {r["k"]: np.frombuffer(bytes(r["v"])).reshape(r["shape"]) for r in got}

    return summed


_SENT = "k long, task long, shape array<long>, v binary"


def _add(total: dict[int, np.ndarray], more: dict[int, np.ndarray]) -> None:
    for k, v in more.items():
        total[k] = total[k] + v if k in total else v


def _sent(rows) -> Iterator[pa.RecordBatch]:
    kinds = [pa.int64(), pa.int64(), pa.list_(pa.int64()), pa.binary()]
    for k, task, v in rows:
        row = [k, task, list(v.shape), np.ascontiguousarray(v, float).tobytes()]
        yield pa.RecordBatch.from_arrays([pa.array([c], t) for c, t in zip(row, kinds)], names=["k", "task", "shape", "v"])


def sample(docs: DataFrame, labels: DataFrame, doc_id: str, text: str, label: str) -> tuple[np.ndarray, np.ndarray]:
    """Features and labels of a bounded draw of the training rows, for a look at
    a few of them; ``rank_quality`` learns from every row."""
    rows = labels.where((crc_mod(doc_id, 5) != 0) & F.col(label).isNotNull()).select(
        F.col(doc_id).alias("i"), F.col(label).cast("int").alias("y"))
    counts = {r["y"]: r["count"] for r in rows.where("y in (0, 1)").groupBy("y").count().collect()}
    share = F.lit(0.0)
    for y, n in counts.items():
        share = F.when(F.col("y") == y, F.lit(min(1.0, MOST_LABELS / n))).otherwise(share)
    point = F.pmod(F.xxhash64("i"), F.lit(1 << 30)) / float(1 << 30)
    # the bound holds for any input: rows are cut by the hash that picks them,
    # so a rerun learns from the same ones
    picked = rows.withColumn("p", point).where(F.col("p") < share).orderBy("p", "i", "y").limit(4 * MOST_LABELS)
    texts = docs.select(F.col(doc_id).alias("i"), F.col(text).alias("t")).join(F.broadcast(picked), "i")
    got = (map_texts(texts, "t", ["i", "y", "p"], "x array<double>", _featurer)
           .orderBy("p", "i", "y", "x").limit(8 * MOST_LABELS).collect())
    got.sort(key=lambda r: (r["i"], r["y"], r["x"]))
    return (np.array([r["x"] for r in got]).reshape(-1, len(FEATURES)), np.array([r["y"] for r in got]))


def predict(features: DataFrame, model: Ranker | float, keep: list[str]) -> DataFrame:
    """``keep`` columns, ``score`` and ``predicted`` of rows with features ``x``."""
    from pyspark.sql import types as T
    src = features.select(*keep, "x")
    out = T.StructType([*src.drop("x").schema.fields, T.StructField("score", T.DoubleType())])

    def run(batches: Iterator[pa.RecordBatch]) -> Iterator[pa.RecordBatch]:
        for b in batches:
            if isinstance(model, float):
                score = np.full(b.num_rows, model)
            else:
                score = model.score(b.column(len(keep)).flatten().to_numpy(zero_copy_only=False).reshape(-1, len(FEATURES)))
            yield pa.RecordBatch.from_arrays([*b.columns[:-1], pa.array(score, pa.float64())], names=[*keep, "score"])

    return src.mapInArrow(run, out).withColumn("predicted", F.when(F.col("score") >= CUT, 1).otherwise(0))


def training_rows(features: DataFrame, labels: DataFrame, doc_id: str, label: str) -> DataFrame:
    """(x, y) of every label row outside the held-out fold, per document row of its id."""
    rows = labels.where(crc_mod(doc_id, 5) != 0).select(F.col(doc_id).alias("doc_id"), F.col(label).cast("int").alias("y"))
    return features.join(rows.where("y in (0, 1)"), "doc_id").select("x", "y")


def rank_quality(docs: DataFrame, labels: DataFrame, doc_id: str = "doc_id", text: str = "text",
                 label: str = "quality") -> DataFrame:
    """Per document: doc_id, held_out, score, predicted. Learns from all labels
    whose fold (crc32 of the id as text, modulo 5) is not 0."""
    rows = docs.select(F.col(doc_id).alias("doc_id"), F.col(text).alias("text"),
                       F.coalesce(crc_mod(doc_id, 5) == 0, F.lit(False)).alias("held_out"))
    features_of = stored(map_texts(rows, "text", ["doc_id", "held_out"], "x array<double>", _featurer))
    training = stored(training_rows(features_of, labels, doc_id, label))
    model = train(summed_over(training))
    dropped(training)
    return predict(features_of, model, ["doc_id", "held_out"])
