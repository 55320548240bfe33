"""Suffix-array dedup: bytes under a ``LENGTH``-byte string that starts at two
or more places of the corpus are removed.

Suffixes are sorted block by block, and only those that can have a partner:

1. *Whole copies.* Texts are keyed by their digest; of a text with copies
   every byte goes, and further steps see each distinct text once.
2. *Buckets.* Every window (``LENGTH``-byte string) belongs to the bucket of the
   smallest hash among its ``SEED``-byte substrings. Equal windows share their
   bucket, and neighbouring windows mostly do, so a text becomes a few slices
   (runs of windows of one bucket). Buckets with a single occurrence hold no
   repeat and are dropped before any text moves.
3. *Blockwise sort.* The slices of whole buckets are gathered to blocks of
   bounded size. Per block, the positions of a difference cover ({0, 1, 3} mod
   7) are ranked by doubling. Then the windows are sorted one suffix bucket
   (equal leading bytes) at a time: two suffixes i, j are ordered by fewer than
   7 bytes and, where those tie, by the precomputed ranks at i + d and j + d,
   with d chosen so that both are cover positions. Neighbours in the order
   whose common prefix reaches ``LENGTH`` repeat.
4. *Very large buckets* (over ``HOT_BYTES`` of slices, such as a passage in a
   third of all texts) would not fit one block: their windows are counted by
   128-bit digest instead, combined map-side, with the same outcome.

Defined cases: null text is empty; texts shorter than ``LENGTH`` bytes lose
nothing; repeated rows are copies; ids may be null or repeat (all steps key on
the text's digest); empty tables give no rows; other columns are ignored. The
bytes kept may split a character, so they are binary.
"""

from __future__ import annotations

import hashlib
from collections.abc import Iterator

import numpy as np
import pyarrow as pa
from pyspark.sql import Column, DataFrame
from pyspark.sql import functions as F

from .common import map_texts, marked_likely, stored

LENGTH = 400
SEED = 64
#: Window starts hashed at once (a longer text goes in parts).
PART = 1 << 18
#: Bytes of slices gathered to one block, and the bucket size beyond which
#: windows are counted by digest.
BLOCK_BYTES = 2 << 20
HOT_BYTES = 8 << 20

#: Bits of a rank in a sort key, beside five bytes of text.
RANK_BITS = 24
# The difference cover: any two residues mod 7 have a shift d < 7 that takes
# both into it.
PERIOD, COVER = 7, (0, 1, 3)
SHIFT = np.array([[next(d for d in range(PERIOD) if (a + d) % PERIOD in COVER and (b + d) % PERIOD in COVER)
                   for b in range(PERIOD)] for a in range(PERIOD)], np.int64)


def _sliding(x: np.ndarray, width: int, f) -> np.ndarray:
    """f over every ``width`` consecutive values, by doubling."""
    size, cur = 1, x
    while size * 2 <= width:
        cur = f(cur[:-size], cur[size:])
        size *= 2
    rest = width - size
    return f(cur[:len(cur) - rest], cur[rest:]) if rest else cur


class Seeds:
    """Rolling hashes of all SEED-byte strings, and the slices of a text."""

    def __init__(self, length: int, seed: int):
        self.length, self.seed = length, seed
        base = 0x9E3779B97F4A7C15
        n = PART + length
        self.value = np.random.default_rng(77).integers(0, 2 ** 63, 256, dtype=np.uint64)
        self.power = np.cumprod(np.full(n, base, np.uint64))
        self.inverse = np.cumprod(np.full(n, pow(base, -1, 2 ** 64), np.uint64))

    def slices(self, text: bytes) -> tuple[list, list, list, list]:
        """(bucket, first window start, last window start, whether the bucket's
        seed occurs more than once here) per run of windows of one bucket."""
        out: tuple[list, list, list, list] = ([], [], [], [])
        for at in range(0, len(text) - self.length + 1, PART):
            a = np.frombuffer(text, np.uint8)[at:at + PART + self.length - 1]
            h = np.zeros(len(a) + 1, np.uint64)
            np.cumsum(self.value[a] * self.power[:len(a)], out=h[1:])
            h = (h[self.seed:] - h[:-self.seed]) * self.inverse[:len(a) - self.seed + 1]
            h = (h ^ (h >> np.uint64(31))) * np.uint64(0xD6E8FEB86659FD93)
            h ^= h >> np.uint64(29)
            width = self.length - self.seed + 1
            low = _sliding(h, width, np.minimum)
            lo = np.concatenate([[0], np.flatnonzero(low[1:] != low[:-1]) + 1])
            hi = np.concatenate([lo[1:], [len(low)]]) - 1
            pad = np.zeros(width - 1, np.uint64)
            top = _sliding(np.concatenate([pad, low, pad]), width, np.maximum)
            value, times = np.unique(h[h == top], return_counts=True)
            bucket = low[lo]
            out[0].extend(bucket.view(np.int64).tolist())
            out[1].extend((lo + at).tolist())
            out[2].extend((hi + at).tolist())
            out[3].extend((times[np.searchsorted(value, bucket)] > 1).tolist())
        return out


def _ranks(keys: np.ndarray) -> np.ndarray:
    """Dense ranks from 1."""
    return np.unique(keys, return_inverse=True)[1].astype(np.uint32) + np.uint32(1)


def _words(text: np.ndarray, at: np.ndarray) -> np.ndarray:
    """The 8 bytes at each position as a big-endian number."""
    return np.lib.stride_tricks.sliding_window_view(text, 8)[at].copy().view(">u8").ravel().astype(np.uint64)


def cover_ranks(text: np.ndarray, length: int) -> tuple[int, np.ndarray, np.ndarray]:
    """Ranks of the cover positions by their first 7, 14, 28, ... bytes.
    Returns a depth of at most ``length`` - 6 with its ranks, and the ranks at
    the first depth of at least ``length``. Arrays are indexed by position
    (0: not ranked) and run past the text."""
    n = len(text) - 8
    at = np.flatnonzero(np.isin(np.arange(PERIOD), COVER)[np.arange(n) % PERIOD])
    depth = short = PERIOD
    rank = np.zeros(len(text) + 4 * length, np.uint32)
    rank[at] = _ranks(_words(text, at) >> np.uint64(8))
    ranked = rank
    while depth < length:
        pair = rank[at].astype(np.uint64) << np.uint64(32) | rank[at + depth]
        rank = np.zeros_like(rank)
        rank[at] = _ranks(pair)
        depth *= 2
        if depth <= length - PERIOD + 1:
            short, ranked = depth, rank
    return short, ranked, rank


def _bucket_order(text: np.ndarray, at: np.ndarray, rank: np.ndarray) -> np.ndarray:
    """Suffixes with an equal first byte, sorted. Each residue class is sorted
    by (bytes before the next cover position, rank there); the classes are
    merged by binary searches, each pair at its own shift."""
    ahead = _words(text, at) << np.uint64(8) >> np.uint64(24)       # bytes 1 to 5
    classes = [np.flatnonzero(at % PERIOD == r) for r in range(PERIOD)]
    keys: dict[tuple[int, int], np.ndarray] = {}
    for r, own in enumerate(classes):
        for d in range(PERIOD):
            if (r + d) % PERIOD in COVER and len(own):
                lead = ahead[own] >> np.uint64(8 * (6 - d)) if d > 1 else np.uint64(0)
                keys[r, d] = lead << np.uint64(RANK_BITS) | rank[at[own] + d]
    order = np.zeros(len(at), np.int64)
    sorted_keys = {k: np.sort(v) for k, v in keys.items()}
    for r, own in enumerate(classes):
        if not len(own):
            continue
        inner = np.empty(len(own), np.int64)
        inner[np.argsort(keys[r, int(SHIFT[r, r])], kind="stable")] = np.arange(len(own))
        for other in range(PERIOD):
            if other != r and len(classes[other]):
                d = int(SHIFT[r, other])
                inner += np.searchsorted(sorted_keys[other, d], keys[r, d], side="left" if r < other else "right")
        order[own] = inner
    return at[np.argsort(order, kind="stable")]


def repeated_windows(text: np.ndarray, windows: np.ndarray, length: int) -> np.ndarray:
    """Which of the window starts of a block have an equal window in it.
    ``text`` runs at least ``length`` + 8 bytes past the last window;
    ``length`` is 16 at least."""
    short, ranked, rank = cover_ranks(text, length)
    if len(text) >= 2 << RANK_BITS:
        raise ValueError("the block is too large for its ranks")
    lead = text[windows]
    by_lead = np.argsort(lead, kind="stable").astype(np.int32)
    cuts = np.flatnonzero(np.diff(lead[by_lead])) + 1
    del lead
    flag = np.zeros(len(text), bool)
    for bucket in np.split(by_lead, cuts):
        if len(bucket) < 2:
            continue
        s = _bucket_order(text, windows[bucket].astype(np.int64), rank)
        i, j = s[:-1], s[1:]
        d = SHIFT[i % PERIOD, j % PERIOD]
        # equal first 8 bytes, equal ``short`` bytes at d and at the last
        # common cover position, equal last 8 bytes: together all ``length``
        last = d + (length - short - d) // PERIOD * PERIOD
        same = ((ranked[i + d] == ranked[j + d]) & (ranked[i + last] == ranked[j + last]))
        k = np.flatnonzero(same)
        i, j = i[k], j[k]
        k = (_words(text, i) == _words(text, j)) & (_words(text, i + length - 8) == _words(text, j + length - 8))
        flag[i[k]] = True
        flag[j[k]] = True
    return flag[windows]


def block_repeats(pieces: list[bytes], length: int) -> list[list[tuple[int, int]]]:
    """Per slice, the [s, e) runs of its window starts that repeat in the block."""
    size = np.array([len(p) for p in pieces])
    start = np.concatenate([[0], np.cumsum(size)[:-1]])
    text = np.frombuffer(b"".join([*pieces, bytes(length + 16)]), np.uint8)
    count = size - length + 1
    piece = np.repeat(np.arange(len(pieces), dtype=np.int32), count)
    offset = np.arange(count.sum(), dtype=np.int32) - np.repeat((np.cumsum(count) - count).astype(np.int32), count)
    hit = np.flatnonzero(repeated_windows(text, start.astype(np.int32)[piece] + offset, length))
    out: list[list[tuple[int, int]]] = [[] for _ in pieces]
    if len(hit):
        p, o = piece[hit], offset[hit]
        first = np.concatenate([[True], (np.diff(p) != 0) | (np.diff(o) != 1)])
        final = np.concatenate([first[1:], [True]])
        for k, a, b in zip(p[first].tolist(), o[first].tolist(), o[final].tolist()):
            out[k].append((a, b + 1))
    return out


def _slicer(length: int, seed: int):
    def make():
        cut = Seeds(length, seed)

        def run(texts: list[bytes]) -> dict[str, list]:
            got = [cut.slices(t) for t in texts]
            return {"slices": [[{"bucket": b, "lo": x, "hi": y, "again": z} for b, x, y, z in zip(*g)] for g in got]}

        return run

    return make


def _sort_blocks(length: int, block_bytes: int):
    def run(batches: Iterator[pa.RecordBatch]) -> Iterator[pa.RecordBatch]:
        rows: list[tuple[bytes, int, bytes]] = []       # whole buckets of the block
        own: list[tuple[bytes, int, bytes]] = []        # the bucket being read
        size, own_size, last = 0, 0, None

        def found_in(rows: list):
            got = block_repeats([r[2] for r in rows], length)
            found = [(d, lo + a, lo + b) for (d, lo, _), runs in zip(rows, got) for a, b in runs]
            return pa.RecordBatch.from_arrays(
                [pa.array([f[0] for f in found], pa.binary()), pa.array([f[1] for f in found], pa.int64()),
                 pa.array([f[2] for f in found], pa.int64())], names=["digest", "s", "e"])

        for batch in batches:
            for bucket, digest, lo, piece in zip(*(batch[c].to_pylist() for c in ("bucket", "digest", "lo", "piece"))):
                if bucket != last:
                    if rows and size + own_size > block_bytes:
                        yield found_in(rows)
                        rows, size = [], 0
                    rows, size, own, own_size = rows + own, size + own_size, [], 0
                own.append((digest, lo, piece))
                own_size += len(piece)
                last = bucket
        if rows and size + own_size > block_bytes:
            yield found_in(rows)
            rows = []
        if rows or own:
            yield found_in(rows + own)

    return run


def _cutter(length: int):
    def make():
        def run(texts: list[bytes], spans: list[list]) -> tuple[list, ...]:
            out: tuple[list, ...] = ([], [], [], [])
            for t, s in zip(texts, spans):
                edge = np.zeros(len(t) + 1, np.int64)
                a = np.array([x["s"] for x in s], np.int64)
                b = np.array([x["e"] for x in s], np.int64) - 1 + length
                np.add.at(edge, a, 1)
                np.add.at(edge, b, -1)
                gone = np.cumsum(edge[:-1]) > 0
                kept = np.frombuffer(t, np.uint8)[~gone].tobytes()
                out[0].append(int(gone.sum()))
                out[1].append(int(gone[0]) + int((np.diff(gone.astype(np.int8)) == 1).sum()))
                out[2].append(hashlib.sha256(kept).hexdigest())
                out[3].append(kept)
            return out

        return run

    return make


def _removed(pairs: DataFrame, length: int, with_text: bool) -> DataFrame:
    """(digest, n_removed, n_spans, kept_sha256[, kept]) from (digest, text,
    spans of window starts)."""
    schema = "digest binary, n_removed long, n_spans long, kept_sha256 string" + ", kept binary" * with_text

    def run(batches: Iterator[pa.RecordBatch]) -> Iterator[pa.RecordBatch]:
        cut = _cutter(length)()
        for b in batches:
            for i in range(b.num_rows):
                row = b.slice(i, 1)
                got = cut(row["text"].to_pylist(), row["spans"].to_pylist())
                cols = [row["digest"], pa.array(got[0], pa.int64()), pa.array(got[1], pa.int64()), pa.array(got[2])]
                if with_text:
                    cols.append(pa.array(got[3], pa.binary()))
                yield pa.RecordBatch.from_arrays(cols, names=schema.replace(",", "").split()[::2])

    return pairs.select("digest", "text", "spans").mapInArrow(run, schema)


def repeats(docs: DataFrame, text: str = "text", length: int = LENGTH, seed: int = SEED,
            block_bytes: int = BLOCK_BYTES, hot_bytes: int = HOT_BYTES, with_text: bool = False) -> DataFrame:
    """(digest of a text, n_removed, n_spans, kept_sha256[, kept]) for every
    distinct text that loses bytes."""
    source = docs.select(F.col(text).cast("binary").alias("text"))
    source = source.where(F.octet_length("text") >= length).withColumn("digest", F.expr(DIGEST))
    copied = stored(source.groupBy("digest").agg(F.count(F.lit(1)).alias("n"), F.max(F.octet_length("text")).alias("bytes"))
                    .where("n > 1"))
    runs = stored(map_texts(source, "text", ["digest"],
                            "slices array<struct<bucket:long,lo:long,hi:long,again:boolean>>", _slicer(length, seed))
                  .select("digest", F.explode("slices").alias("r")).select("digest", "r.*"))
    here = F.struct("digest", "lo")
    buckets = stored(runs.groupBy("bucket").agg(F.min(here).alias("x"), F.max(here).alias("y"), F.max("again").alias("z"))
                     .where("x <> y or z").select("bucket"))
    slices = stored(runs.join(buckets, "bucket").select("bucket", "digest", "lo", "hi").distinct())
    hot = stored(slices.groupBy("bucket").agg(F.sum(F.col("hi") - F.col("lo") + length).alias("size"))
                 .where(F.col("size") > hot_bytes).select("bucket", F.lit(True).alias("hot")))
    per_text = stored(slices.groupBy("digest").agg(F.collect_list(F.struct("bucket", "lo", "hi")).alias("slices")))
    texts = stored(source.join(per_text, "digest").dropDuplicates(["digest"]))
    pieces = (texts.select("digest", "text", F.explode("slices").alias("r"))
              .select("digest", "r.bucket", "r.lo",
                      F.expr(f"substring(text, cast(r.lo + 1 as int), cast(r.hi - r.lo + {length} as int))").alias("piece"))
              .join(hot, "bucket", "left"))
    cold = (pieces.where("hot is null").select("bucket", "digest", "lo", "piece")
            .repartition("bucket").sortWithinPartitions("bucket")
            .mapInArrow(_sort_blocks(length, block_bytes), "digest binary, s long, e long"))
    spans = stored(cold)
    if not hot.isEmpty():
        windows = stored(pieces.where("hot").select("digest", "lo", "piece", F.explode(
            F.sequence(F.lit(0), F.octet_length("piece") - length)).alias("i"))
            .select("digest", (F.col("lo") + F.col("i")).alias("s"),
                    F.expr(f"substring(unhex(sha2(substring(piece, i + 1, {length}), 256)), 1, 16)").alias("w")))
        place = F.struct("digest", "s")
        often = stored(windows.groupBy("w").agg(F.min(place).alias("x"), F.max(place).alias("y")).where("x <> y").select("w"))
        spans = spans.unionByName(windows.join(often, "w").select("digest", "s", (F.col("s") + 1).alias("e")))
    spans = spans.groupBy("digest").agg(F.collect_list(F.struct("s", "e")).alias("spans"))
    some = (texts.select("digest", "text").join(spans, "digest").join(copied, "digest", "left_anti"))
    cols = ["digest", "n_removed", "n_spans", "kept_sha256"] + ["kept"] * with_text
    whole = copied.select("digest", F.col("bytes").cast("long").alias("n_removed"), F.lit(1).cast("long").alias("n_spans"),
                          F.lit(hashlib.sha256(b"").hexdigest()).alias("kept_sha256"),
                          F.lit(b"").alias("kept")).select(*cols)
    return stored(_removed(some, length, with_text).select(*cols).unionByName(whole))


DIGEST = "substring(unhex(sha2(text, 256)), 1, 16)"


def suffix_dedup(docs: DataFrame, doc_id: str = "doc_id", text: str = "text", **settings) -> DataFrame:
    """Per document: doc_id, n_bytes, n_removed, n_spans, kept_sha256 (and
    ``kept``, the bytes that stay, with ``with_text=True``). Texts that can have
    lost nothing keep theirs where they are read; only the others are joined."""
    found = repeats(docs, text, **settings)
    rows = (docs.select(F.col(doc_id).alias("doc_id"), F.coalesce(F.col(text).cast("binary"), F.lit(b"")).alias("text"))
            .select("doc_id", F.expr(DIGEST).alias("digest"), F.octet_length("text").cast("long").alias("n_bytes"),
                    F.sha2("text", 256).alias("whole"), *[F.col("text")] * bool(settings.get("with_text"))))
    zero = F.lit(0).cast("long")
    kept = [F.coalesce("kept", "text").alias("kept")] * bool(settings.get("with_text"))

    def told(of: DataFrame) -> DataFrame:
        return of.select("doc_id", "n_bytes", F.coalesce("n_removed", zero).alias("n_removed"),
                         F.coalesce("n_spans", zero).alias("n_spans"),
                         F.coalesce("kept_sha256", "whole").alias("kept_sha256"), *kept)

    if not settings.get("with_text"):
        return told(rows.join(found, "digest", "left"))
    marked = marked_likely(rows, found.select("digest"), "digest")
    none = [F.lit(None).cast(found.schema[c].dataType).alias(c) for c in found.columns if c != "digest"]
    return told(marked.where("__likely").join(found, "digest", "left")).unionByName(
        told(marked.where(~F.col("__likely")).select("*", *none)))


def remaining_text(kept) -> Column:
    """The kept bytes as text; a character cut in two becomes U+FFFD."""
    return F.make_valid_utf8(F.col(kept).cast("string"))
