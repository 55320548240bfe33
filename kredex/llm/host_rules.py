"""Quality rules at host level.

Each document gets the base counts of the contract and a base verdict. The
failures are then aggregated by host (here ``source``). A host's failure rate
is shrunk by a beta prior fitted to all hosts (empirical Bayes, method of
moments), so that a host with few documents is not judged by them alone. A
host whose shrunk rate reaches ``max_rate`` is rejected, and its verdict is
joined back: a document is kept if it passes itself and its host does.

Defined cases: null or empty text has no words and fails the base rule; a null
host is a host of its own; repeated rows count as rows; an empty table gives
no rows; further columns are ignored. With one host, or equal rates, the
prior has no spread to fit and is Beta(1, 1).

Scale: one pass over the texts (Arrow, counts only), written once to the
shared folder; a host holding a third of the rows is combined map-side. The
join against the rejected hosts is left to Spark: it broadcasts them only
below its byte threshold and splits hot hosts of a shuffle join otherwise,
since both sides are plain tables.
"""

from __future__ import annotations

import numpy as np
from pyspark.sql import Column, DataFrame
from pyspark.sql import functions as F

from .common import map_texts, stored

# Fixed values of the base rules.
SYMBOLS = "#*$%&|<>"
MIN_WORDS = 10
MAX_REPEAT_PERCENT = 20
WINDOW = 5
#: A host whose shrunk failure rate reaches this share is rejected.
MAX_RATE = 0.5

COUNTS = "n_words long, word_chars long, n_symbols long, n_dup_lines long, n_repeat_words long"


def repeat_words(words: list[bytes], width: int = WINDOW) -> int:
    """Words inside ``width``-word windows that occur at least twice in the
    text. Window ids come from exact re-ranking of (left half, right half)
    pairs, so memory stays a few integers per word."""
    n = len(words) - width + 1
    if n < 2:
        return 0
    ids: dict[bytes, int] = {}
    w = np.fromiter((ids.setdefault(x, len(ids)) for x in words), np.int64, len(words))
    if len(ids) == len(words):
        return 0

    def pair(a: np.ndarray, b: np.ndarray) -> np.ndarray:
        return np.unique(a * (int(b.max()) + 1) + b, return_inverse=True)[1]

    two = pair(w[:-1], w[1:])
    four = pair(two[:-2], two[2:])
    win, count = np.unique(four[:n] * len(ids) + w[width - 1:], return_inverse=True,
                           return_counts=True)[1:]
    again = count[win] > 1
    edge = np.zeros(len(words) + 1, np.int64)
    np.add.at(edge, np.flatnonzero(again), 1)
    np.add.at(edge, np.flatnonzero(again) + width, -1)
    return int((np.cumsum(edge) > 0).sum())


def _counter():
    symbols = [c.encode() for c in SYMBOLS]

    def count(texts: list[bytes]) -> dict[str, list[int]]:
        out: dict[str, list[int]] = {k: [] for k in
                                     ("n_words", "word_chars", "n_symbols", "n_dup_lines", "n_repeat_words")}
        for t in texts:
            words = t.split()
            lines = [x for x in t.split(b"\n") if x.strip()]
            joined = b"".join(words)
            out["n_words"].append(len(words))
            out["word_chars"].append(len(joined.decode()) if not joined.isascii() else len(joined))
            out["n_symbols"].append(sum(t.count(c) for c in symbols))
            out["n_dup_lines"].append(len(lines) - len(set(lines)))
            out["n_repeat_words"].append(repeat_words(words))
        return out

    return count


def base_failed() -> Column:
    return ((F.col("n_words") < MIN_WORDS)
            | (100 * F.col("n_repeat_words") > MAX_REPEAT_PERCENT * F.col("n_words")))


def base_counts(docs: DataFrame, keep: list[str], text: str = "text") -> DataFrame:
    """``keep`` columns plus the base counts and ``base_failed`` per document."""
    return (map_texts(docs, text, keep, COUNTS, _counter)
            .withColumn("base_failed", base_failed()))


def host_rates(base: DataFrame, host: str, key: str = "host") -> DataFrame:
    """(host, n_docs, n_failed, rate) with the shrunk failure rate.

    The prior's mean m and variance v over hosts give alpha + beta =
    m (1 - m) / v - 1, where v is the variance of the hosts' raw rates less
    what sampling alone explains (floored), so noise is not taken for spread.
    """
    per = stored(base.groupBy(F.col(host).alias(key)).agg(
        F.count(F.lit(1)).alias("n_docs"),
        F.sum(F.col("base_failed").cast("long")).alias("n_failed")))
    raw = F.col("n_failed") / F.col("n_docs")
    m = per.agg(F.avg(raw).alias("m"), F.var_samp(raw).alias("v"),
                F.avg(1 / F.col("n_docs")).alias("inv")).first()
    mean, var, inv = m["m"], m["v"], m["inv"]
    a, b = 1.0, 1.0
    if mean is not None and 0 < mean < 1 and var:
        spread = max(var - mean * (1 - mean) * inv, var * 0.01)
        weight = max(mean * (1 - mean) / spread - 1, 1e-3)
        a, b = mean * weight, (1 - mean) * weight
    return per.withColumn("rate", (F.col("n_failed") + a) / (F.col("n_docs") + a + b))


def rejected_hosts(base: DataFrame, host: str, max_rate: float = MAX_RATE) -> DataFrame:
    """Hosts whose shrunk failure rate reaches ``max_rate``, as a written table."""
    return stored(host_rates(base, host).where(F.col("rate") >= max_rate)
                  .select("host", F.lit(True).alias("host_failed")))


def quality_rules(docs: DataFrame, doc_id: str = "doc_id", host: str = "source",
                  text: str = "text", max_rate: float = MAX_RATE) -> DataFrame:
    """Per document: id, base counts, ``base_failed``, ``host_failed``, ``kept``."""
    ids = docs.select(F.col(doc_id).alias("doc_id"), F.col(host).alias("host"), F.col(text).alias("text"))
    base = stored(base_counts(ids, ["doc_id", "host"]))
    bad = rejected_hosts(base, "host", max_rate)
    return (base.alias("d").join(bad.alias("h"), F.col("d.host").eqNullSafe(F.col("h.host")), "left")
            .select("d.doc_id", "n_words", "word_chars", "n_symbols", "n_dup_lines",
                    "n_repeat_words", "base_failed",
                    F.coalesce("host_failed", F.lit(False)).alias("host_failed"))
            .withColumn("kept", ~F.col("base_failed") & ~F.col("host_failed")))


def quality_filter(docs: DataFrame, host: str = "source", text: str = "text",
                   max_rate: float = MAX_RATE) -> DataFrame:
    """The documents the rules keep, with all their columns. The host rates
    come from a first pass; the second pass judges each text in place, so the
    texts are not shuffled unless the rejected hosts outgrow a broadcast."""
    ids = docs.select(F.col(host).alias("host"), F.col(text).alias("text"))
    bad = rejected_hosts(stored(base_counts(ids, ["host"])), "host", max_rate)
    cols = docs.columns
    held = docs.select(*[F.col(c).alias(f"c{i}") for i, c in enumerate(cols)])
    judged = (base_counts(held, held.columns, f"c{cols.index(text)}")
              .where(~F.col("base_failed")))
    at = f"c{cols.index(host)}"
    return (judged.join(bad, F.col(at).eqNullSafe(F.col("host")), "left_anti")
            .select(*[F.col(f"c{i}").alias(c) for i, c in enumerate(cols)]))
