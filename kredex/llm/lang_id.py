"""Language identification with a byte convolutional network.

The network reads fixed windows of ``WINDOW`` UTF-8 bytes of the lower-cased
text: filters of several widths over one-hot bytes (a filter's weights are a
table by position and byte, so a convolution is a sum of table rows), ReLU, max
over the window, softmax. It is trained here in numpy with Adam on labelled
windows, cropped at random so that short texts are covered. A text of any
length is cut into windows; their logits are averaged by bytes.

Training sample: every language of the training folds, ``PER_LANGUAGE``
documents of each (all it has, if fewer), chosen by a hash of the id; with many
languages fewer of each, so that it stays at ``MOST_DOCUMENTS``, but never less
than ``LEAST_PER_LANGUAGE`` (from 400 languages on the sample grows with their
number). Up to ``PIECES`` evenly spread windows of each document.

Defined cases: null text, or text without a letter, is ``und`` with score 0; so
is everything when no row has a label; rows with null ids are in no training
fold; repeated rows are rows; empty tables give no rows; other columns are
ignored.
"""

from __future__ import annotations

from dataclasses import dataclass, field

import numpy as np
from pyspark.sql import Column, DataFrame, Window
from pyspark.sql import functions as F

from .common import crc_mod, map_texts

WINDOW = 256
WIDTHS = (2, 3, 4)
FILTERS = 16
PER_LANGUAGE = 500
MOST_DOCUMENTS = 20_000
LEAST_PER_LANGUAGE = 50
PIECES = 4
EPOCHS = 12
UNKNOWN = "und"


@dataclass
class Net:
    labels: list[str]
    tables: list[np.ndarray] = field(default_factory=list)     # per width: (width, 256, filters)
    bias: list[np.ndarray] = field(default_factory=list)
    out: np.ndarray | None = None
    out_bias: np.ndarray | None = None

    def features(self, x: np.ndarray, size: np.ndarray) -> tuple[np.ndarray, list[np.ndarray]]:
        """Max-pooled activations of windows x (n, WINDOW), and where each
        maximum is. Positions past a window's bytes do not count."""
        pooled, places = [], []
        for w, table, b in zip(WIDTHS, self.tables, self.bias):
            n = x.shape[1] - w + 1
            act = table[0][x[:, :n]]
            for j in range(1, w):
                act += table[j][x[:, j:j + n]]
            past = np.arange(n) >= np.maximum(size[:, None] - w + 1, 1)
            act[past] = -1e9
            at = act.argmax(1)
            pooled.append(np.maximum(np.take_along_axis(act, at[:, None], 1)[:, 0] + b, 0))
            places.append(at)
        return np.concatenate(pooled, 1), places

    def logits(self, x: np.ndarray, size: np.ndarray) -> np.ndarray:
        return self.features(x, size)[0] @ self.out + self.out_bias


def windows(text: bytes) -> tuple[np.ndarray, np.ndarray]:
    """All windows of a text, the last one padded, and their sizes."""
    n = max(1, -(-len(text) // WINDOW))
    x = np.zeros(n * WINDOW, np.uint8)
    x[:len(text)] = np.frombuffer(text, np.uint8)
    size = np.full(n, WINDOW)
    size[-1] = max(1, len(text) - (n - 1) * WINDOW)
    return x.reshape(n, WINDOW), size


def _softmax(z: np.ndarray) -> np.ndarray:
    e = np.exp(z - z.max(1, keepdims=True))
    return e / e.sum(1, keepdims=True)


def fit(samples: list[tuple[bytes, str]], epochs: int = EPOCHS, seed: int = 5) -> Net:
    """A network from (window bytes, label) samples."""
    net = Net(sorted({y for _, y in samples}))
    k, rng = len(net.labels), np.random.default_rng(seed)
    for w in WIDTHS:
        table = rng.normal(0, 0.3, (w, 256, FILTERS)).astype(np.float32)
        net.tables.append(table)
        net.bias.append(np.zeros(FILTERS, np.float32))
    net.out = rng.normal(0, 0.1, (FILTERS * len(WIDTHS), k)).astype(np.float32)
    net.out_bias = np.zeros(k, np.float32)
    if k < 2:
        return net
    y = np.array([net.labels.index(s[1]) for s in samples])
    weight = (len(y) / k / np.bincount(y, minlength=k))[y]
    params = [*net.tables, *net.bias, net.out, net.out_bias]
    m1, m2, step = [np.zeros_like(p) for p in params], [np.zeros_like(p) for p in params], 0
    for epoch in range(epochs):
        rate = 0.01 * 0.5 ** (epoch // 4)
        order = rng.permutation(len(samples))
        for at in range(0, len(order), 64):
            pick = order[at:at + 64]
            x, size = np.zeros((len(pick), WINDOW), np.uint8), np.ones(len(pick), np.int64)
            for i, p in enumerate(pick):
                t = samples[p][0]
                n = min(len(t), int(WINDOW * rng.random() ** 1.5) + 4)
                a = int(rng.integers(0, len(t) - n + 1))
                x[i, :n] = np.frombuffer(t[a:a + n], np.uint8)
                size[i] = max(n, 1)
            f, places = net.features(x, size)
            g = _softmax(f @ net.out + net.out_bias)
            g[np.arange(len(pick)), y[pick]] -= 1
            g *= (weight[pick] / len(pick))[:, None]
            back = (g @ net.out.T) * (f > 0)
            grads = [np.zeros_like(t) for t in net.tables]
            bias = []
            for i, w in enumerate(WIDTHS):
                b = back[:, i * FILTERS:(i + 1) * FILTERS]
                bias.append(b.sum(0))
                for j in range(w):
                    seen = np.take_along_axis(x, places[i] + j, 1)
                    np.add.at(grads[i][j], (seen, np.arange(FILTERS)), b)
            grads += [*bias, f.T @ g, g.sum(0)]
            step += 1
            for p, d, a, b in zip(params, grads, m1, m2):
                a += 0.1 * (d - a)
                b += 0.001 * (d * d - b)
                p -= (rate * (a / (1 - 0.9 ** step)) / (np.sqrt(b / (1 - 0.999 ** step)) + 1e-8)).astype(np.float32)
    return net


def sample(docs: DataFrame, train: Column, doc_id: str, text: str, lang: str) -> list[tuple[bytes, str]]:
    """The training windows (see the module's bounds)."""
    rows = (docs.where(train & F.col(lang).isNotNull() & (F.octet_length(F.col(text)) > 0))
            .select(F.col(doc_id).alias("i"), F.col(lang).cast("string").alias("y"), F.col(text).alias("t")))
    # one row per label, as the network has them
    counts = [(r["y"], r["count"]) for r in rows.groupBy("y").count().collect()]
    if not counts:
        return []
    quota = max(min(PER_LANGUAGE, MOST_DOCUMENTS // len(counts)), LEAST_PER_LANGUAGE)
    # the shares are a little larger than the quota; the rank cuts to it
    shares = docs.sparkSession.createDataFrame([(y, min(1.0, (quota + 4 * quota ** 0.5) / n)) for y, n in counts],
                                               "label string, share double")
    point = F.pmod(F.xxhash64("i"), F.lit(1 << 30)) / float(1 << 30)
    cut = F.transform(F.sequence(F.lit(0), F.lit(PIECES - 1)), lambda k: F.substring(
        F.col("b"), F.floor(F.greatest(F.octet_length("b") - WINDOW, F.lit(0)) * k / (PIECES - 1)).cast("int") + 1,
        F.lit(WINDOW)))
    rank = F.row_number().over(Window.partitionBy("y").orderBy("point", "i", "pieces"))
    picked = (rows.withColumn("point", point).join(F.broadcast(shares), (F.col("y") == F.col("label")) & (F.col("point") < F.col("share")))
              .select("i", "y", "point", F.lower("t").cast("binary").alias("b"))
              .select("i", "y", "point", F.array_distinct(cut).alias("pieces"))
              .withColumn("rank", rank).where(F.col("rank") <= quota).select("i", "y", "pieces").collect())
    picked.sort(key=lambda r: (r["i"], r["y"], [bytes(p) for p in r["pieces"]]))
    return [(bytes(p), r["y"]) for r in picked for p in r["pieces"]]


def predict(docs: DataFrame, net: Net, keep: list[str], text: str = "text") -> DataFrame:
    """``keep`` columns, ``lang_pred`` and ``score`` (mean probability)."""

    def make():
        def run(texts: list[bytes]) -> dict[str, list]:
            langs, scores = [], []
            held: list[tuple[np.ndarray, np.ndarray]] = []
            for t in texts:
                held.append(windows(t.decode().lower().encode()))
            x = np.concatenate([h[0] for h in held])
            size = np.concatenate([h[1] for h in held])
            z = np.concatenate([net.logits(x[i:i + 256], size[i:i + 256]) for i in range(0, len(x), 256)])
            start = np.concatenate([[0], np.cumsum([len(h[1]) for h in held])[:-1]])
            total = np.add.reduceat(z * size[:, None], start) / np.add.reduceat(size, start)[:, None]
            p = _softmax(total.astype(np.float64))
            best = p.argmax(1)
            langs = [net.labels[i] for i in best]
            scores = p[np.arange(len(p)), best].clip(0, 1).tolist()
            return {"lang_pred": langs, "score": scores}

        return run

    rows = docs.select(*keep, F.col(text).alias("__t"), F.coalesce(F.col(text).rlike(r"\p{L}"), F.lit(False)).alias("__l"))
    if not net.labels:
        return rows.select(*keep, F.lit(UNKNOWN).alias("lang_pred"), F.lit(0.0).alias("score"))
    out = map_texts(rows, "__t", [*keep, "__l"], "lang_pred string, score double", make)
    return out.select(*keep, F.when(F.col("__l"), F.col("lang_pred")).otherwise(UNKNOWN).alias("lang_pred"),
                      F.when(F.col("__l"), F.col("score")).otherwise(0.0).alias("score"))


def identify(docs: DataFrame, doc_id: str = "doc_id", text: str = "text", lang: str = "lang") -> DataFrame:
    """Per document: doc_id, held_out, lang_pred, score. Learns from the rows
    whose fold (crc32 of the id as text, modulo 4) is not 2."""
    net = fit(sample(docs, crc_mod(doc_id, 4) != 2, doc_id, text, lang))
    rows = docs.select(F.col(doc_id).alias("doc_id"), F.col(text).alias("text"),
                       F.coalesce(crc_mod(doc_id, 4) == 2, F.lit(False)).alias("held_out"))
    return predict(rows, net, ["doc_id", "held_out"])
