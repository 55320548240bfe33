"""MinHash near-dedup with odd sketches.

A document's set holds its distinct ``WIDTH``-word shingles (words: A-Z
lower-cased, cut at ASCII white space; fewer words: the whole sequence is one
shingle). Documents whose sets have a Jaccard similarity of at least 80 % are
linked; the groups are the connected components.

1. One pass over the texts gives each document a class key (digest of its word
   sequence), ``BANDS`` x ``ROWS`` MinHash values folded into band buckets, and
   the odd sketch: each value of its bottom-``SAMPLE`` MinHash sample toggles
   one of ``BITS`` bits. A pair at similarity s shares a bucket with
   probability 1 - (1 - s**ROWS)**BANDS, which is 0.999997 at 0.8.
2. Documents of one class become one node, combined map-side.
3. Hub round: in each bucket every member is compared with one hub, the member
   that shares most buckets, so a bucket gives one pair per member and not all
   pairs. The XOR population count of two odd sketches estimates how many
   samples differ. For sets no larger than the sample it cannot exceed the size
   of the symmetric difference, so the test is exact in that it loses no link:
   a link needs a difference of at most a ninth of the sizes' sum. For larger
   sets the limit lies 5.9 standard deviations beyond the worst linked pair.
4. Surviving pairs are verified on the full sets; links give the components.
5. Closing: the pairs of a bucket that are still in different components are
   tested by their sketches inside a join, in blocks, so only pairs that are
   almost surely links leave it; these are verified and linked too.

Defined cases: a text without words is linked with nothing and is its own
component; null ids are never the smallest unless all are null; rows with equal
text are one node, also if they repeat an id; empty tables give no rows; other
columns are ignored.
"""

from __future__ import annotations

import hashlib
import math
from collections.abc import Iterator

import numpy as np
import pyarrow as pa
import xxhash
from pyspark.sql import Column, DataFrame
from pyspark.sql import functions as F

from .common import likely_in, map_texts, marked_likely, stored

WIDTH = 2
SIMILAR = 80                     # percent
BANDS, ROWS = 32, 5
SAMPLE = 1024
BITS = 2048
#: Differing samples allowed to sets larger than the sample. The mean of the
#: worst linked pair (similarity 0.8, one set holds the other) is 0.4 * SAMPLE;
#: counting the bitmap's own noise too, the limit on the XOR count lies 5.9
#: standard deviations beyond that pair's mean at 20,000 shingles (simulated).
MOST_APART = 600
#: Members verified per copy of a hub's text; members per block of the
#: closing join.
HUB_SHARE = 256
BLOCK = 2048

_SAMPLES = BANDS * ROWS


def _odd(n: int, seed: int) -> np.ndarray:
    return np.random.default_rng(seed).integers(0, 2 ** 63, n, dtype=np.uint64) * np.uint64(2) + np.uint64(1)


def _mix(x: np.ndarray) -> np.ndarray:
    x = (x ^ (x >> np.uint64(32))) * np.uint64(0xD6E8FEB86659FD93)
    x = (x ^ (x >> np.uint64(32))) * np.uint64(0xD6E8FEB86659FD93)
    return x ^ (x >> np.uint64(32))


def shingle_set(words: list[bytes], width: int = WIDTH) -> set[tuple[bytes, ...]]:
    """The exact shingle set."""
    if not words:
        return set()
    if len(words) < width:
        return {tuple(words)}
    return set(zip(*(words[i:] for i in range(width))))


def shingle_hashes(words: list[bytes], width: int = WIDTH) -> np.ndarray:
    """Distinct 64-bit shingle hashes."""
    h = np.fromiter(map(xxhash.xxh3_64_intdigest, words), np.uint64, len(words))
    k = min(width, len(words))
    out = h[:len(h) - k + 1].copy()
    for i in range(1, k):
        out = _mix(out) + h[i:len(h) - k + 1 + i]
    return np.unique(_mix(out))


def min_hashes(x: np.ndarray, factors: np.ndarray) -> np.ndarray:
    out = np.full(len(factors), np.uint64(2 ** 64 - 1))
    for i in range(0, len(x), 4096):
        np.minimum(out, np.multiply.outer(factors, x[i:i + 4096]).min(1), out=out)
    return out


def odd_sketch(x: np.ndarray) -> np.ndarray:
    """BITS / 64 words: the parity of the bottom-SAMPLE hashes per bit. ``x``
    is sorted."""
    bit = (_mix(x[:SAMPLE] + np.uint64(0x9E3779B97F4A7C15)) % np.uint64(BITS)).astype(np.int64)
    odd = (np.bincount(bit, minlength=BITS) & 1).astype(np.uint8)
    return np.packbits(odd, bitorder="little").view(np.int64)


def band_buckets(samples: np.ndarray) -> np.ndarray:
    out = np.zeros((len(samples), BANDS), np.uint64) + np.arange(BANDS, dtype=np.uint64)
    for j in range(ROWS):
        out = _mix(out) + samples[:, j::ROWS]
    return _mix(out).view(np.int64)


SIGNED = "key binary, n_shingles long, buckets array<long>, sketch array<long>"


def _signer():
    factors = _odd(_SAMPLES, 20240229)

    def rows(m: np.ndarray, present: list[bool]) -> pa.ListArray:
        full = np.flatnonzero(present)
        at = np.zeros(len(present) + 1, np.int32)
        at[full + 1] = m.shape[1]
        return pa.ListArray.from_arrays(pa.array(np.cumsum(at), pa.int32()), pa.array(m.ravel()))

    def sign(texts: list[bytes]) -> dict:
        keys, counts, samples, sketches = [], [], [], []
        for t in texts:
            words = t.lower().split()
            if not words:
                keys.append(None)
                counts.append(0)
                continue
            keys.append(hashlib.sha256(b" ".join(words)).digest()[:16])
            x = shingle_hashes(words)
            counts.append(len(x))
            samples.append(min_hashes(x, factors))
            sketches.append(odd_sketch(x))
        present = [k is not None for k in keys]
        m = np.array(samples, np.uint64).reshape(-1, _SAMPLES)
        return {"key": keys, "n_shingles": counts, "buckets": rows(band_buckets(m), present),
                "sketch": rows(np.array(sketches, np.int64).reshape(-1, BITS // 64), present)}

    return sign


def may_link(a: str, b: str) -> Column:
    """Whether the sets' sizes and sketches (columns ``n`` and ``sketch``
    with the prefixes ``a`` and ``b``) allow a link."""
    na, nb, sa, sb = (F.col(x + y) for y in ("n", "sketch") for x in (a, b))
    z = sum(F.bit_count(F.get(sa, F.lit(i)).bitwiseXOR(F.get(sb, F.lit(i)))) for i in range(BITS // 64))
    most = math.floor(BITS / 2 * (1 - math.exp(-2 * MOST_APART / BITS)))
    return ((100 * F.least(na, nb) >= SIMILAR * F.greatest(na, nb))
            & (z <= F.when(F.greatest(na, nb) <= SAMPLE, F.floor((na + nb) * (100 - SIMILAR) / (100 + SIMILAR)))
               .otherwise(F.lit(most))))


def _verify(pairs: DataFrame, texts: DataFrame) -> DataFrame:
    """The (a, b) pairs linked on their full sets. Each hub ``a`` travels once
    per HUB_SHARE of its members; sorted partitions stream hub, then members,
    so a task holds one hub's set and one Arrow batch."""
    shares = (pairs.groupBy("a").agg(F.ceil(F.count(F.lit(1)) / HUB_SHARE).cast("int").alias("n")))
    shares = stored(shares)
    split = pairs.join(shares, "a").withColumn("s", F.pmod(F.xxhash64("b"), F.col("n")).cast("int"))
    members = (split.join(texts, F.col("b") == F.col("node"))
               .select("a", "s", F.lit(1).alias("m"), "b", "text"))
    hubs = (shares.join(texts, F.col("a") == F.col("node"))
            .select("a", F.explode(F.sequence(F.lit(0), F.col("n") - 1)).alias("s"), F.lit(0).alias("m"),
                    F.col("a").alias("b"), "text"))
    both = (hubs.unionByName(members).repartition("a", "s")
            .sortWithinPartitions("a", "s", "m"))

    def run(batches: Iterator[pa.RecordBatch]) -> Iterator[pa.RecordBatch]:
        hub, own = None, set()
        for batch in batches:
            out_a, out_b = [], []
            for a, m, b, t in zip(batch["a"], batch["m"], batch["b"], batch["text"]):
                s = shingle_set(t.as_py().lower().split())
                if m.as_py() == 0:
                    hub, own = a.as_py(), s
                    continue
                both = len(own & s)
                if 100 * both >= SIMILAR * (len(own) + len(s) - both):
                    out_a.append(hub)
                    out_b.append(b.as_py())
            yield pa.RecordBatch.from_arrays([pa.array(out_a, pa.int64()), pa.array(out_b, pa.int64())],
                                             names=["a", "b"])

    return stored(both.mapInArrow(run, "a long, b long"))


def components(edges: DataFrame) -> DataFrame:
    """(node, label): the smallest node reachable over the (a, b) edges, for
    nodes that have an edge. Minimum over neighbours, then pointer jumping,
    each round written to the shared folder."""
    both = stored(edges.unionByName(edges.select(F.col("b").alias("a"), F.col("a").alias("b"))).distinct())
    labels = stored(both.groupBy(F.col("a").alias("node")).agg(F.least(F.min("b"), F.first("a")).alias("label")))
    while True:
        near = (both.join(labels.withColumnRenamed("node", "b"), "b")
                .groupBy(F.col("a").alias("node")).agg(F.min("label").alias("low")))
        step = labels.join(near, "node").select("node", F.least("label", "low").alias("to"), F.col("label").alias("old"))
        jump = labels.select(F.col("node").alias("to"), F.col("label").alias("next"))
        new = stored(step.join(jump, "to").select("node", F.least("to", "next").alias("label"), "old"))
        labels = new.select("node", "label")
        if new.where("label <> old").isEmpty():
            return labels


def _labelled(members: DataFrame, labels: DataFrame | None) -> DataFrame:
    if labels is None:
        return members.withColumn("label", F.col("node"))
    return (members.join(labels, "node", "left")
            .withColumn("label", F.coalesce("label", "node")))


def _link(nodes: DataFrame, texts_of, block: int) -> DataFrame | None:
    """Labels of the linked nodes (None: no bucket holds two nodes)."""
    sets = nodes.select("node", "sketch", F.col("n_shingles").alias("n"))
    bands = nodes.select("node", F.explode("buckets").alias("bucket"))
    several = stored(bands.groupBy("bucket").agg(F.count(F.lit(1)).alias("size")).where("size > 1"))
    members = stored(likely_in(bands, several, "bucket").join(several, "bucket").select("bucket", "node", "size"))
    degree = stored(members.groupBy("node").agg(F.sum("size").alias("degree")))
    central = F.max(F.struct("degree", "node"))
    hubs = stored(members.join(degree, "node").groupBy("bucket").agg(central.alias("h"))
                  .select("bucket", F.col("h.node").alias("a")))
    pairs = (members.join(hubs, "bucket").where("node <> a").select("a", F.col("node").alias("b")).distinct())
    links = _checked(pairs, sets, texts_of)
    labels = components(links) if links is not None else None

    rows = _labelled(members, labels)
    mixed = stored(rows.groupBy("bucket").agg(F.min("label").alias("x"), F.max("label").alias("y"))
                   .where("x <> y").select("bucket"))
    pairs = _closing_pairs(stored(rows.join(mixed, "bucket")), sets, block)
    more = _checked(pairs, sets, texts_of)
    if more is None:
        return labels
    return components(more if links is None else links.unionByName(more))


def _checked(pairs: DataFrame, sets: DataFrame, texts_of) -> DataFrame | None:
    """The (a, b) pairs that are links: sketches first, then the full sets."""
    sides = [sets.select(F.col("node").alias(x), F.col("n").alias(f"{x}_n"), F.col("sketch").alias(f"{x}_sketch"))
             for x in "ab"]
    pairs = stored(pairs.join(sides[0], "a").join(sides[1], "b").where(may_link("a_", "b_")).select("a", "b"))
    if pairs.isEmpty():
        return None
    needed = pairs.select(F.col("a").alias("node")).unionByName(pairs.select(F.col("b").alias("node"))).distinct()
    return _verify(pairs, stored(texts_of(needed)))


def _closing_sides(rows: DataFrame, block: int) -> tuple[DataFrame, DataFrame]:
    """Both sides of the join that compares members of a still-mixed bucket:
    each member outside the bucket's largest label with every member. A late
    label in a bucket of many copies costs as many pairs as the bucket has
    members, not their square. Both sides are cut into blocks, and each pair of
    blocks is one join key, so that no task holds a large bucket."""
    label = (rows.groupBy("bucket", "label").agg(F.count(F.lit(1)).alias("m"))
             .groupBy("bucket").agg(F.max(F.struct("m", "label")).alias("top"), F.sum("m").alias("all")))
    label = stored(label.select("bucket", F.col("top.label").alias("major"),
                                F.ceil((F.col("all") - F.col("top.m")) / block).cast("int").alias("ki"),
                                F.ceil(F.col("all") / block).cast("int").alias("kj")))
    rows = rows.join(label, "bucket")
    own = F.xxhash64("node", F.lit("block"))
    minor = (rows.where("label <> major").withColumn("i", F.pmod(own, "ki").cast("int"))
             .withColumn("j", F.explode(F.sequence(F.lit(0), F.col("kj") - 1))))
    every = (rows.withColumn("j", F.pmod(own, "kj").cast("int"))
             .withColumn("i", F.explode(F.sequence(F.lit(0), F.col("ki") - 1))))
    return tuple(d.select("bucket", "i", "j", *[F.col(c).alias(f"{x}_{c}") for c in d.columns if c in ("node", "label", "n", "sketch")])
                 for d, x in ((minor, "p"), (every, "q")))


def _closing_pairs(rows: DataFrame, sets: DataFrame, block: int) -> DataFrame:
    """The pairs with different labels of each still-mixed bucket whose
    sketches agree; the sketches are tested inside the join."""
    minor, every = _closing_sides(rows.select("bucket", "node", "label").join(sets, "node"), block)
    at = [minor[c] == every[c] for c in ("bucket", "i", "j")]
    return (minor.join(every, [*at, F.col("p_label") != F.col("q_label"), may_link("p_", "q_")])
            .select(F.least("p_node", "q_node").alias("a"), F.greatest("p_node", "q_node").alias("b")).distinct())


def _grouped(docs: DataFrame, doc_id: str, text: str, block: int) -> DataFrame:
    """Per document: doc_id, digest, n_shingles, label of its group (null
    without words) and the group's component_id."""
    source = docs.select(F.col(doc_id).alias("doc_id"), F.col(text).alias("text"), _digest(text).alias("digest"))
    signed = stored(map_texts(source, "text", ["doc_id", "digest"], SIGNED, _signer))
    nodes = stored(signed.where("key is not null").groupBy("key")
                   .agg(F.min("doc_id").alias("least_id"), F.min("digest").alias("digest"),
                        F.min("n_shingles").alias("n_shingles"),
                        F.first("buckets").alias("buckets"), F.first("sketch").alias("sketch"))
                   .withColumn("node", F.monotonically_increasing_id()))

    def texts_of(needed: DataFrame) -> DataFrame:
        wanted = stored(nodes.select("node", "digest").join(needed, "node"))
        rows = source.select("digest", F.col("text").cast("binary").alias("text"))
        return (likely_in(rows, wanted, "digest").join(wanted, "digest").dropDuplicates(["node"]).select("node", "text"))

    labels = _link(nodes, texts_of, block)
    rows = _labelled(nodes.select("key", "node", "least_id"), labels)
    least = stored(rows.groupBy("label").agg(F.min("least_id").alias("component_id")))
    classes = stored(rows.join(least, "label").select("key", "label", "component_id"))
    return signed.select("doc_id", "digest", "n_shingles", "key").join(classes, "key", "left")


def near_duplicates(docs: DataFrame, doc_id: str = "doc_id", text: str = "text",
                    block: int = BLOCK) -> DataFrame:
    """Per document: doc_id, n_shingles, component_id, kept (and the text's
    digest)."""
    return (_grouped(docs, doc_id, text, block)
            .select("doc_id", "n_shingles",
                    F.when(F.col("key").isNull(), F.col("doc_id")).otherwise(F.col("component_id")).alias("component_id"),
                    "digest")
            .withColumn("kept", F.col("doc_id").eqNullSafe(F.col("component_id")))
            .select("doc_id", "n_shingles", "component_id", "kept", "digest"))


def _digest(text: str) -> Column:
    """16-byte digest of the whole text (null: of the empty text)."""
    return F.expr(f"substring(unhex(sha2(coalesce(cast(`{text}` as binary), cast('' as binary)), 256)), 1, 16)")


def keep_one(docs: DataFrame, doc_id: str = "doc_id", text: str = "text", block: int = BLOCK) -> DataFrame:
    """One document of each group, with all columns: the smallest id (a null
    id is the last), of texts that share it the smallest digest; of rows that
    repeat both, one. Texts without words all stay. Only rows whose text is
    dropped somewhere meet the verdicts, in one join; the others pass in place.
    Verdicts hold how often a surviving row occurs, so that only survivors that
    repeat are folded."""
    cols = docs.columns
    at = f"c{cols.index(doc_id)}"
    back = [F.col(f"c{i}").alias(c) for i, c in enumerate(cols)]
    seen = stored(_grouped(docs, doc_id, text, block).where("n_shingles > 0")
                  .groupBy("label", "digest", F.col("doc_id").alias("id")).agg(F.count(F.lit(1)).alias("n")))
    first = F.min(F.struct(F.col("id").isNull().alias("no_id"), "id", "digest", "n")).alias("best")
    best = stored(seen.groupBy("label").agg(first, F.sum("n").alias("rows")).where("rows > 1")
                  .select("label", F.col("best.id").alias("best_id"), F.col("best.digest").alias("best_digest"),
                          F.col("best.n").alias("copies")))
    # a text lies in one group, so its rows agree on the best; a text whose one
    # row survives needs no verdict
    verdicts = (seen.join(best, "label").groupBy("digest")
                .agg(F.sum("n").alias("rows"), *[F.max(c).alias(c) for c in ("best_id", "best_digest", "copies")])
                .withColumn("wins", F.col("digest") == F.col("best_digest")))
    judged = stored(verdicts.where("not (wins and rows = 1)").select("digest", "wins", "best_id", "copies"))
    held = docs.select(*[F.col(c).alias(f"c{i}") for i, c in enumerate(cols)], _digest(text).alias("digest"))
    marked = marked_likely(held, judged, "digest")
    survives = F.col("wins") & F.col(at).eqNullSafe(F.col("best_id"))
    # rows that only share a bit with a judged text have no verdict and pass too
    kept = (marked.where("__likely").join(judged, "digest", "left")
            .where(F.col("wins").isNull() | (survives & (F.col("copies") == 1))))
    repeated = judged.where("wins and copies > 1")
    folded = (likely_in(held, repeated, "digest").join(repeated, "digest").where(survives)
              .dropDuplicates(["digest", at]))
    return (marked.where("not __likely").select(*back).unionByName(kept.select(*back))
            .unionByName(folded.select(*back)))
