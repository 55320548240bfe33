"""Vector code compression: product codes trained by ball k-means.

Vectors become integers (floor of ``SCALE`` times a component) and are cut into
``PARTS`` equal consecutive parts. Each part position has a codebook of up to
``ENTRIES`` entries, first that part of the vectors with the smallest ids. A
round assigns every part to its nearest entry (ties: the lower index) and
replaces each entry by the floor of its parts' mean; an entry without parts
stays. After the last round the parts are assigned once more.

*Ball k-means.* After an update, the parts of an entry form a ball: its centre
is the new entry, its radius their largest distance to it. An entry is a
neighbour only if it lies within twice the radius; a ball without neighbours
skips the round. A part at distance d from its own entry can only change to an
entry within 2 d of it, so the neighbours sorted by distance cut the ball into
a stable core (no neighbour within 2 d: nothing to do) and annular rings (the
first k neighbours within 2 d: only these are compared). All tests compare
exact integers (four times the squared distance), so the codes equal those of
comparing all entries, ties included.

*On Spark.* Vectors are packed once to rows of up to ``PACK`` vectors (ids,
labels, integers, codes). Each round reads those rows, keeps the balls within a
row, and writes the rows with new codes and their sums per entry; the sums per
(part, entry), at most PARTS * ENTRIES rows, meet in one small aggregate, whose
result is the next codebook. A round's table replaces the one before, which is
then deleted; nothing else is shuffled, and a lost task is read again.

Defined cases: rows whose vector is null or holds null or non-finite components
are dropped; of equal ids the vector smaller in components comes first; null
ids come last; with fewer vectors than ``ENTRIES`` the codebooks are shorter;
repeated rows count as often as they occur; null labels are one label; an empty
table gives no rows; other columns are ignored. Vectors of different lengths, a
length that ``PARTS`` does not divide, or integers so large that squared
distances could leave 64 bits are an error.
"""

from __future__ import annotations

import hashlib
from collections.abc import Iterator

import numpy as np
import pyarrow as pa
from pyspark.sql import DataFrame
from pyspark.sql import functions as F

from .common import dropped, stored

PARTS = 8
ENTRIES = 16
ROUNDS = 6
SCALE = 4096
PACK = 10_000

PACKED = "ids binary, labels binary, ints binary, codes binary, sums binary"


def kept_vectors(table: DataFrame, vec_id: str, vector: str, label: str) -> DataFrame:
    """(i, label, v): vectors as integers, rows with a null or non-finite
    component dropped."""
    v = F.col(vector).cast("array<double>")
    whole = F.forall(v, lambda x: x.isNotNull() & ~F.isnan(x) & (F.abs(x) < float("inf")))
    return (table.where(F.col(vector).isNotNull() & whole)
            .select(F.col(vec_id).cast("long").alias("i"), F.col(label).cast("string").alias("label"), v.alias("x"))
            .withColumn("v", F.transform("x", lambda x: F.floor(x * float(SCALE)))).drop("x"))


def balls(points: np.ndarray, codes: np.ndarray, book: np.ndarray) -> tuple[np.ndarray, np.ndarray, int]:
    """(codes, squared distances, candidate distances computed) of one part
    position's ``points`` under ``book``, from the codes of the round before."""
    own = ((points - book[codes]) ** 2).sum(1)
    apart = ((book[:, None] - book[None]) ** 2).sum(2)
    radius = np.zeros(len(book), np.int64)
    np.maximum.at(radius, codes, own)
    neighbour = apart <= 4 * radius[:, None]
    np.fill_diagonal(neighbour, False)
    # per entry its neighbours by distance, others last and never reached
    far = np.where(neighbour, apart, np.iinfo(np.int64).max)
    order = np.argsort(far, axis=1, kind="stable")
    reach = np.take_along_axis(far, order, 1)
    ring = np.zeros(len(points), np.int64)          # how many neighbours lie within 2 d
    for e in np.flatnonzero(neighbour.any(1)).tolist():
        mine = np.flatnonzero(codes == e)
        ring[mine] = np.searchsorted(reach[e], 4 * own[mine], side="right")
    moving = np.flatnonzero(ring)
    if not len(moving):
        return codes, own, 0
    times = ring[moving]
    first = np.cumsum(times) - times
    point = np.repeat(moving, times)
    entry = order[codes[point], np.arange(len(point)) - np.repeat(first, times)]
    there = ((points[point] - book[entry]) ** 2).sum(1)
    # the least (distance, index), own entry included
    best = np.minimum(np.minimum.reduceat(there * ENTRIES + entry, first), own[moving] * ENTRIES + codes[moving])
    codes, own = codes.copy(), own.copy()
    codes[moving], own[moving] = best % ENTRIES, best // ENTRIES
    return codes, own, len(point)


def nearest(points: np.ndarray, book: np.ndarray) -> tuple[np.ndarray, np.ndarray]:
    """Codes and squared distances by comparing all entries."""
    apart = np.stack([((points - e) ** 2).sum(1) for e in book], 1)
    codes = apart.argmin(1)
    return codes, apart[np.arange(len(points)), codes]


def _assigned(ints: np.ndarray, codes: np.ndarray | None, books: list[np.ndarray]) -> tuple[np.ndarray, np.ndarray]:
    """(codes, squared distances) by (vector, part)."""
    parts = ints.reshape(len(ints), len(books), -1)
    got = [nearest(parts[:, p], b) if codes is None else balls(parts[:, p], codes[:, p].astype(np.int64), b)[:2]
           for p, b in enumerate(books)]
    return np.stack([g[0] for g in got], 1).astype(np.uint8), np.stack([g[1] for g in got], 1)


def _sums(ints: np.ndarray, codes: np.ndarray, books: list[np.ndarray]) -> bytes:
    """Component sums and the count, by (part, entry)."""
    parts = ints.reshape(len(ints), len(books), -1)
    out = np.zeros((len(books), ENTRIES, parts.shape[2] + 1), np.int64)
    for p in range(len(books)):
        np.add.at(out[p, :, :-1], codes[:, p], parts[:, p])
        out[p, :, -1] = np.bincount(codes[:, p], minlength=ENTRIES)
    return out.tobytes()


def _packed(vectors: DataFrame) -> DataFrame:
    """Rows of up to PACK vectors, in the order they are read."""

    def run(batches: Iterator[pa.RecordBatch]) -> Iterator[pa.RecordBatch]:
        for b in batches:
            for at in range(0, b.num_rows, PACK):
                part = b.slice(at, PACK)
                ints = part["v"].flatten().to_numpy(zero_copy_only=False).astype(np.int32)
                cells = (_ipc(part["i"]), _ipc(part["label"]), ints.tobytes(), None, None)
                yield pa.RecordBatch.from_arrays([pa.array([c], pa.binary()) for c in cells],
                                                 names=["ids", "labels", "ints", "codes", "sums"])

    return stored(vectors.select("i", "label", "v").mapInArrow(run, PACKED))


def _ipc(column: pa.Array) -> bytes:
    out = pa.BufferOutputStream()
    batch = pa.RecordBatch.from_arrays([column], names=["c"])
    with pa.ipc.new_stream(out, batch.schema) as w:
        w.write_batch(batch)
    return out.getvalue().to_pybytes()


def _column(data: bytes) -> pa.Array:
    return pa.ipc.open_stream(data).read_next_batch()["c"]


def _ints(data: bytes, size: int) -> np.ndarray:
    return np.frombuffer(data, np.int32).astype(np.int64).reshape(-1, size)


def _round(packed: DataFrame, books: list[np.ndarray], size: int) -> DataFrame:
    """The packed rows with the codes under ``books`` and their sums."""

    def run(batches: Iterator[pa.RecordBatch]) -> Iterator[pa.RecordBatch]:
        for b in batches:
            for i in range(b.num_rows):
                row = b.slice(i, 1)
                ints = _ints(row["ints"][0].as_py(), size)
                old = row["codes"][0].as_py()
                old = None if old is None else np.frombuffer(old, np.uint8).reshape(-1, len(books))
                codes, _ = _assigned(ints, old, books)
                yield pa.RecordBatch.from_arrays(
                    [row["ids"], row["labels"], row["ints"], pa.array([codes.tobytes()], pa.binary()),
                     pa.array([_sums(ints, codes, books)], pa.binary())], names=["ids", "labels", "ints", "codes", "sums"])

    return stored(packed.mapInArrow(run, PACKED))


def _updated(packed: DataFrame, books: list[np.ndarray], size: int) -> list[np.ndarray]:
    """The codebooks after one round: floor of the mean of each entry's parts."""
    width = size // len(books) + 1

    def run(batches: Iterator[pa.RecordBatch]) -> Iterator[pa.RecordBatch]:
        total = np.zeros((len(books), ENTRIES, width), np.int64)
        for b in batches:
            for v in b["sums"]:
                total += np.frombuffer(v.as_py(), np.int64).reshape(total.shape)
        used = np.argwhere(total[:, :, -1] > 0)
        yield pa.RecordBatch.from_arrays(
            [pa.array(used[:, 0], pa.int64()), pa.array(used[:, 1], pa.int64()),
             pa.array([total[p, e].tolist() for p, e in used.tolist()], pa.list_(pa.int64()))], names=["p", "e", "s"])

    cols = [F.sum(F.get("s", F.lit(k)).cast("decimal(38,0)")).alias(f"s{k}") for k in range(width)]
    rows = packed.select("sums").mapInArrow(run, "p long, e long, s array<long>").groupBy("p", "e").agg(*cols).collect()
    out = [b.copy() for b in books]
    for r in rows:                                    # at most PARTS * ENTRIES
        out[r["p"]][r["e"]] = [int(r[f"s{k}"]) // int(r[f"s{width - 1}"]) for k in range(width - 1)]
    return out


def first_books(vectors: DataFrame, size: int, parts: int, entries: int) -> list[np.ndarray]:
    least = vectors.orderBy(F.asc_nulls_last("i"), "v").limit(entries).select("v").collect()
    start = np.array([r["v"] for r in least], np.int64).reshape(len(least), parts, size // parts)
    return [start[:, p].copy() for p in range(parts)]


def books_digest(books: list[np.ndarray]) -> str:
    return hashlib.sha256(",".join(str(x) for b in books for e in b.tolist() for x in e).encode()).hexdigest()


def coded(packed: DataFrame, books: list[np.ndarray], size: int) -> DataFrame:
    """(vec_id, label, code, error) per vector, assigned once more."""

    def run(batches: Iterator[pa.RecordBatch]) -> Iterator[pa.RecordBatch]:
        for b in batches:
            for i in range(b.num_rows):
                row = b.slice(i, 1)
                old = np.frombuffer(row["codes"][0].as_py(), np.uint8).reshape(-1, len(books))
                codes, error = _assigned(_ints(row["ints"][0].as_py(), size), old, books)
                text = codes.tobytes().hex()
                n = 2 * len(books)
                yield pa.RecordBatch.from_arrays(
                    [_column(row["ids"][0].as_py()), _column(row["labels"][0].as_py()),
                     pa.array([text[k:k + n] for k in range(0, len(text), n)], pa.string()),
                     pa.array(error.sum(1), pa.int64())], names=["vec_id", "label", "code", "error"])

    return packed.mapInArrow(run, "vec_id long, label string, code string, error long")


def compress(table: DataFrame, vec_id: str = "vec_id", vector: str = "embedding", label: str = "label",
             parts: int = PARTS, entries: int = ENTRIES, rounds: int = ROUNDS) -> tuple[DataFrame, list[np.ndarray]]:
    """((vec_id, label, code, error), codebooks)."""
    if entries > ENTRIES:
        raise ValueError(f"at most {ENTRIES} entries")
    vectors = kept_vectors(table, vec_id, vector, label)
    seen = vectors.agg(F.min(F.size("v")).alias("least"), F.max(F.size("v")).alias("size"),
                       F.max(F.array_max(F.transform("v", lambda x: F.abs(x)))).alias("most")).first()
    if seen["size"] is None:
        empty = vectors.select(F.col("i").alias("vec_id"), "label", F.lit("").alias("code"), F.lit(0).cast("long").alias("error"))
        return empty.where("false"), []
    size = seen["size"]
    if seen["least"] != size or size % parts or not size:
        raise ValueError(f"vectors of {seen['least']} to {size} components can't be cut into {parts} equal parts")
    if (size // parts) * (2 * seen["most"]) ** 2 * ENTRIES >= 1 << 63:
        raise ValueError(f"a component of size {seen['most']} is too large for 64-bit distances")
    books = first_books(vectors, size, parts, entries)
    packed = _packed(vectors)
    for _ in range(rounds):
        after = _round(packed, books, size)
        books = _updated(after, books, size)
        dropped(packed)
        packed = after
    return coded(packed, books, size), books


def vector_codes(table: DataFrame, vec_id: str = "vec_id", vector: str = "embedding", label: str = "label") -> DataFrame:
    """Per kept vector: vec_id, code, error, label_error (the errors summed over
    equal labels) and the digest of all codebooks."""
    rows, books = compress(table, vec_id, vector, label)
    rows = stored(rows)
    total = stored(rows.groupBy("label").agg(F.sum("error").alias("label_error"))).select(
        F.col("label").alias("of_label"), "label_error")
    return (rows.join(total, F.col("label").eqNullSafe(F.col("of_label")), "left")
            .select("vec_id", "code", "error", "label_error", F.lit(books_digest(books)).alias("codebooks_sha256")))
