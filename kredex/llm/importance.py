"""Target-distribution importance resampling on hashed word n-grams.

A document's features are its runs of 1 to ``MOST_WORDS`` consecutive words.
Each falls into one of ``BUCKETS`` buckets by the CRC-32 of its bytes. A
bucket's gain is the log ratio of its (add-one) shares in the target texts and
in the documents; a document's weight is the sum of gains over its features.
Documents are drawn without replacement by the Gumbel top-k rule: weight plus
Gumbel noise, made of a hash of the id, the highest ones drawn.

*Length-bucketed CRC matrices.* A task works through its texts in blocks of
about ``BLOCK_BYTES``. The distinct features of a block are found on integer
word codes; their bytes are grouped by equal length into two-dimensional uint8
arrays. All CRCs of a length are updated together, one column of bytes at a
time, and the buckets are scattered back to the places of their features. A
feature longer than ``WIDEST`` bytes is cut into rows of that many bytes, whose
CRCs advance together in the same way and are then combined in order.

The buckets of every document are written once, as 16-bit integers; counts and
weights read them. *Counts* are sums over every text, folded per task to at most
``BUCKETS`` rows.
*Ranks*: bin edges are quantiles of the scores (a bounded number of literals);
exact counts per bin place the bins, rows are ranked inside a bin, and only
bins that reach the draw are ranked. No step gathers all rows.

Defined cases: null text has no words; a document without words has no
features and weight 0; fewer than ``LEAST_WORDS`` words: scored, never drawn;
a null id hashes as the empty text and is the last of its ties; repeated rows
are rows of their own with ranks of their own; without targets the shares are
the add-one prior; empty tables give no rows; other columns are ignored.
"""

from __future__ import annotations

import math
from collections import defaultdict
from collections.abc import Iterator

import numpy as np
import pyarrow as pa
from pyspark.sql import DataFrame
from pyspark.sql import functions as F

from .common import map_texts, stored

MOST_WORDS = 3
BUCKETS = 10_000
LEAST_WORDS = 20
#: Hundredths of the documents with enough words that are drawn.
PERCENT = 5
SEED = "42"
#: Bytes of words whose features are hashed together.
BLOCK_BYTES = 1 << 20
WIDEST = 256
#: Upper tail of the scores that is cut into bins, and the number of bins.
TAIL, BINS = 0.9, 400
#: Copies of one row ranked by one generated array.
RUN = 100_000


def _word_table() -> np.ndarray:
    """Byte to lower-cased word byte, or space. Word bytes are 0-9, a-z (A-Z
    lower-cased) and all bytes of characters past ASCII."""
    t = np.full(256, 32, np.uint8)
    for a, b in ((0x30, 0x3A), (0x61, 0x7B), (0x80, 0x100)):
        t[a:b] = np.arange(a, b)
    t[0x41:0x5B] = np.arange(0x61, 0x7B)
    return t


LOWER = _word_table()


def _crc_table() -> np.ndarray:
    """Effect of one byte on a CRC-32 (reflected polynomial 0xEDB88320)."""
    t = np.arange(256, dtype=np.uint32)
    for _ in range(8):
        t = np.where(t & 1, (t >> 1) ^ np.uint32(0xEDB88320), t >> 1).astype(np.uint32)
    return t


CRC = _crc_table()


def _columns(rows: np.ndarray, state: np.ndarray) -> np.ndarray:
    """CRC states after the bytes of each row, one column at a time."""
    for column in np.ascontiguousarray(rows.T):
        state = CRC[(state ^ column) & np.uint32(0xFF)] ^ (state >> np.uint32(8))
    return state


def _shift_matrix(n: int) -> np.ndarray:
    """Images of the 32 unit states under ``n`` zero bytes (CRC states are
    linear over GF(2))."""
    image = np.uint32(1) << np.arange(32, dtype=np.uint32)
    return _columns(np.zeros((32, n), np.uint8), image)


def _apply(matrix: np.ndarray, state: int) -> int:
    out = 0
    for bit in range(32):
        if state >> bit & 1:
            out ^= int(matrix[bit])
    return out


def long_crc(text: np.ndarray, shift: np.ndarray) -> int:
    """CRC of one long byte string: rows of WIDEST bytes advance together from
    a zero state; their states are then chained, each shifted by a row."""
    whole = len(text) // WIDEST * WIDEST
    state = 0xFFFFFFFF
    for own in _columns(text[:whole].reshape(-1, WIDEST), np.zeros(whole // WIDEST, np.uint32)).tolist():
        state = _apply(shift, state) ^ own
    rest = text[whole:].reshape(1, -1)
    return int(_columns(rest, np.array([state], np.uint32))[0]) ^ 0xFFFFFFFF


def crcs(text: np.ndarray, start: np.ndarray, size: np.ndarray, shift: np.ndarray) -> np.ndarray:
    """CRC-32 of the byte strings text[start : start + size], length by length."""
    out = np.empty(len(start), np.uint32)
    order = np.argsort(size, kind="stable")
    cuts = np.flatnonzero(np.diff(size[order])) + 1
    for group in np.split(order, cuts):
        if not len(group):
            continue
        n = int(size[group[0]])
        if n > WIDEST:
            out[group] = [long_crc(text[a:a + n], shift) for a in start[group].tolist()]
            continue
        rows = text[start[group][:, None] + np.arange(n)]
        out[group] = _columns(rows, np.full(len(group), 0xFFFFFFFF, np.uint32)) ^ np.uint32(0xFFFFFFFF)
    return out


class Features:
    """Buckets of the features of whole texts."""

    def __init__(self, buckets: int = BUCKETS, most_words: int = MOST_WORDS):
        self.buckets, self.most_words, self.shift = buckets, most_words, _shift_matrix(WIDEST)

    def words(self, texts: list[bytes]) -> tuple[np.ndarray, np.ndarray, np.ndarray, np.ndarray]:
        """(bytes with one space after every word, word starts, word ends, the
        first word of each text and the end)."""
        raw = LOWER[np.frombuffer(b" ".join([*texts, b""]), np.uint8)]
        word = raw != 32
        last = np.zeros(len(raw), bool)
        last[1:] = word[:-1] & ~word[1:]
        kept = word | last
        text = raw[kept]
        end = np.flatnonzero(text == 32)
        start = np.concatenate([np.zeros(min(1, len(end)), np.int64), end[:-1] + 1])
        # texts end where their separator stood before the spaces were dropped
        cut = np.cumsum([len(t) + 1 for t in texts], dtype=np.int64)
        ends_before = np.concatenate([[0], np.cumsum(last)])
        return text, start, end, np.concatenate([[0], ends_before[cut]]).astype(np.int64)

    def buckets_of(self, texts: list[bytes]) -> tuple[np.ndarray, np.ndarray]:
        """(words per text, buckets of all features, text after text)."""
        text, start, end, first = self.words(texts)
        n = np.diff(first)
        own = np.repeat(np.arange(len(n)), n)
        base = np.concatenate([[0], np.cumsum(n_features(n, self.most_words))])
        out = np.empty(base[-1], np.uint16)
        for k, at, bucket in self._blocks(text, start, end, own):
            # the runs of k words of a text stand behind its shorter runs
            t = own[at]
            out[base[t] + n_features(n, k - 1)[t] + at - first[t]] = bucket
        return n, out

    def _blocks(self, text: np.ndarray, start: np.ndarray, end: np.ndarray,
                own: np.ndarray) -> Iterator[tuple[int, np.ndarray, np.ndarray]]:
        """(words of a feature, its first word, its bucket), block by block."""
        n = len(start)
        a = 0
        while a < n:
            b = max(a + 1, int(np.searchsorted(start, start[a] + BLOCK_BYTES)))
            far = min(n, b + self.most_words - 1)
            codes: defaultdict[bytes, int] = defaultdict()
            codes.default_factory = codes.__len__        # a new word gets the next code
            names = text[start[a]:end[far - 1]].tobytes().split(b" ")
            word = np.fromiter(map(codes.__getitem__, names), np.int64, len(names))
            code = word[:b - a]
            at = np.arange(a, b)
            for k in range(1, self.most_words + 1):
                if k > 1:
                    fits = (at + k <= n)
                    fits[fits] = own[at[fits]] == own[at[fits] + k - 1]
                    at, code = at[fits], code[fits] * len(codes) + word[at[fits] + k - 1 - a]
                if not len(at):
                    break
                _, one, where = np.unique(code, return_index=True, return_inverse=True)
                place = at[one]
                bucket = crcs(text, start[place], end[place + k - 1] - start[place], self.shift) % np.uint32(self.buckets)
                code = where.astype(np.int64)        # codes stay below the block's number of features
                yield k, at, bucket.astype(np.uint16)[where]
            a = b


def n_features(n_words, most_words: int = MOST_WORDS):
    return sum((np.maximum(n_words - k, 0) for k in range(most_words)), np.zeros_like(n_words))


def hashed(docs: DataFrame, keep: list[str], text: str = "text", buckets: int = BUCKETS) -> DataFrame:
    """``keep`` columns, n_words and the buckets of all features as 16-bit
    integers."""
    if buckets > 1 << 16:
        raise ValueError("buckets are stored as 16-bit integers")

    def make():
        f = Features(buckets)

        def run(texts: list[bytes]) -> dict[str, list]:
            words, packed = [], []
            for part in _portions(texts):
                n, found = f.buckets_of(part)
                cut = np.concatenate([[0], np.cumsum(n_features(n))])
                words += n.tolist()
                packed += [found[a:b].tobytes() for a, b in zip(cut[:-1].tolist(), cut[1:].tolist())]
            return {"n_words": words, "buckets": packed}

        return run

    return map_texts(docs, text, keep, "n_words long, buckets binary", make)


def _portions(texts: list[bytes]) -> Iterator[list[bytes]]:
    """Consecutive texts of about a block together; a longer one is alone."""
    held: list[bytes] = []
    size = 0
    for t in texts:
        if held and size + len(t) > BLOCK_BYTES:
            yield held
            held, size = [], 0
        held.append(t)
        size += len(t)
    if held:
        yield held


def bucket_counts(features: DataFrame, buckets: int = BUCKETS) -> np.ndarray:
    """Number of features per bucket over all rows of ``hashed``; a task folds
    its rows to at most ``buckets``, and as many reach the driver."""

    def run(batches: Iterator[pa.RecordBatch]) -> Iterator[pa.RecordBatch]:
        total = np.zeros(buckets, np.int64)
        for b in batches:
            for v in b.column(0):
                total += np.bincount(np.frombuffer(v.as_buffer(), np.uint16), minlength=buckets)
        some = np.flatnonzero(total)
        yield pa.RecordBatch.from_arrays([pa.array(some, pa.int64()), pa.array(total[some], pa.int64())],
                                         names=["bucket", "n"])

    out = np.zeros(buckets, np.int64)
    for r in features.select("buckets").mapInArrow(run, "bucket long, n long").groupBy("bucket").agg(F.sum("n").alias("n")).collect():
        out[r["bucket"]] = r["n"]
    return out


def gains(target: np.ndarray, source: np.ndarray) -> list[int]:
    """Thousandths of a nat per bucket, rounded down."""
    k, t_all, s_all = len(source), int(target.sum()), int(source.sum())
    return [math.floor(1000 * math.log(((t + 1.0) * (s_all + k)) / ((s + 1.0) * (t_all + k))))
            for t, s in zip(target.tolist(), source.tolist())]


def weights(features: DataFrame, gain: list[int]) -> DataFrame:
    """doc_id, n_words, n_features and weight from rows of ``hashed``."""
    value = np.array(gain, np.int64)

    def run(batches: Iterator[pa.RecordBatch]) -> Iterator[pa.RecordBatch]:
        for b in batches:
            n = b["n_words"].to_numpy()
            weight = [int(value[np.frombuffer(v.as_buffer(), np.uint16)].sum()) for v in b["buckets"]]
            yield pa.RecordBatch.from_arrays([b["doc_id"], b["n_words"], pa.array(n_features(n), pa.int64()),
                                              pa.array(weight, pa.int64())],
                                             names=["doc_id", "n_words", "n_features", "weight"])

    kind = features.schema["doc_id"].dataType.simpleString()
    return (features.select("doc_id", "n_words", "buckets")
            .mapInArrow(run, f"doc_id {kind}, n_words long, n_features long, weight long"))


def gumbel(doc_id: str, seed: str = SEED):
    """Gumbel noise in thousandths, from the first 32 bits of sha256."""
    name = F.concat(F.lit(f"{seed}:"), F.coalesce(F.col(doc_id).cast("string"), F.lit("")))
    h = F.conv(F.substring(F.sha2(name, 256), 1, 8), 16, 10).cast("double")
    return F.floor(F.lit(-1000.0) * F.log(-F.log((h + 0.5) / 4294967296.0)))


def ranked(scored: DataFrame, least_words: int = LEAST_WORDS, percent: int = PERCENT) -> DataFrame:
    """``scored`` (a stored table) with ``rank`` of the drawn rows."""
    cols = scored.columns
    able = F.col("n_words") >= least_words
    points = [TAIL + (1 - TAIL) * i / BINS for i in range(BINS)] if percent <= 100 * (1 - TAIL) - 1 else \
        [i / BINS for i in range(BINS)]
    one = scored.where(able).agg(F.count(F.lit(1)).alias("n"), F.percentile_approx("score", points, 20_000).alias("edges")).first()
    drawn = percent * one["n"] // 100
    if not drawn:
        return scored.withColumn("rank", F.lit(None).cast("long"))
    edges = sorted({int(e) for e in one["edges"]})
    # bin of a score: how many edges it reaches
    bin_of = F.size(F.filter(F.array(*[F.lit(e) for e in edges]), lambda e: F.col("score") >= e))
    binned = scored.withColumn("bin", F.when(able, bin_of))
    counts = {r["bin"]: r["count"] for r in binned.where(able).groupBy("bin").count().collect()}
    before, above = {}, 0
    for b in sorted(counts, reverse=True):
        if above < drawn:
            before[b] = above
        above += counts[b]
    # equal rows are ranked as one and counted, so none of them is a hot key
    one_of = binned.where(F.col("bin") >= min(before)).groupBy("bin", *cols).agg(F.count(F.lit(1)).alias("m"))
    offset = F.element_at(F.create_map(*[F.lit(x).cast("long") for kv in before.items() for x in kv]), F.col("bin").cast("long"))
    from pyspark.sql import Window
    w = (Window.partitionBy("bin").orderBy(F.desc("score"), F.asc_nulls_last("doc_id"), "n_features", "n_words")
         .rowsBetween(Window.unboundedPreceding, Window.currentRow))
    last = one_of.withColumn("last", offset + F.sum("m").over(w))
    low = F.col("last") - F.col("m") + 1
    runs = last.withColumn("a", F.explode(F.sequence(low, F.col("last"), F.lit(RUN).cast("long"))))
    each = runs.withColumn("rank", F.explode(F.sequence("a", F.least(F.col("last"), F.col("a") + (RUN - 1)))))
    each = each.select(*cols, F.when(F.col("rank") <= drawn, F.col("rank")).alias("rank"))
    rest = binned.where(F.coalesce(F.col("bin") < min(before), F.lit(True))).select(*cols, F.lit(None).cast("long").alias("rank"))
    return each.unionByName(rest)


def resample(docs: DataFrame, targets: DataFrame, doc_id: str = "doc_id", text: str = "text",
             target_text: str = "text", percent: int = PERCENT, least_words: int = LEAST_WORDS) -> DataFrame:
    """Per document: doc_id, n_features, weight, score, rank (null: not drawn)
    and n_words."""
    rows = docs.select(F.col(doc_id).alias("doc_id"), F.col(text).alias("text"))
    features = stored(hashed(rows, ["doc_id"]))
    gain = gains(bucket_counts(hashed(targets.select(F.col(target_text).alias("text")), [])), bucket_counts(features))
    scored = stored(weights(features, gain).withColumn("score", F.col("weight") + gumbel("doc_id")))
    return ranked(scored, least_words, percent).select("doc_id", "n_features", "weight", "score", "rank", "n_words")
