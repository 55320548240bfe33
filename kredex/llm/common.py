"""Helpers shared by the operators of this package."""

from __future__ import annotations

import hashlib
from collections.abc import Callable, Iterator

import pyarrow as pa
import pyarrow.compute as pc
from pyspark.sql import DataFrame, SparkSession
from pyspark.sql import functions as F

from ..session import remove_path, scratch_path

# The word of the text contracts (anything but ASCII white space)
# and the ASCII white space between words. ``bytes.split()`` cuts at exactly
# these bytes and ``bytes.lower()`` lower-cases exactly A-Z.
WORD = r"[^\x20\x09-\x0D]+"

#: Bytes of text a task holds decoded at once; a longer single text is one chunk.
CHUNK_BYTES = 4 << 20


def table(spark: SparkSession, sf_dir: str, name: str) -> DataFrame:
    return spark.read.parquet(f"{sf_dir}/{name}.parquet")


def shared_dir(spark: SparkSession) -> str:
    """A new folder path in the session's folder for intermediate tables, which
    is removed when the session's process ends."""
    return scratch_path(spark, "llm")


def stored(df: DataFrame) -> DataFrame:
    """``df`` written once to the shared folder and read back: cuts the
    lineage, survives lost executors and gives later joins its real size."""
    spark = df.sparkSession
    path = shared_dir(spark)
    df.write.parquet(path)
    return spark.read.schema(df.schema).parquet(path)


def dropped(table: DataFrame) -> None:
    """Delete a table written by ``stored`` that nothing reads any more."""
    for f in {x.rsplit("/", 1)[0] for x in table.inputFiles()}:
        if "/llm-" in f:
            remove_path(table.sparkSession, f)


def once(df: DataFrame, name: str, value) -> DataFrame:
    """``df`` with a column that Spark computes once per row. A plain column
    may be copied by the optimizer into every use, into filters it pushes down
    and into lambda bodies that run per element; the output of a generator is
    not."""
    return df.withColumn(name, F.explode(F.array(value)))


#: Bits of the bitmap of ``likely_in``; its table has at most BITMAP / 64 rows.
BITMAP = 1 << 24


def likely_in(rows: DataFrame, wanted: DataFrame, key: str) -> DataFrame:
    """The ``rows`` whose ``key`` can be among the keys of ``wanted``: no row
    with a wanted key is lost, some others may pass. The wanted keys are folded
    into a bitmap of fixed size, so its broadcast is at most BITMAP / 64 rows
    (4 MB) for any input; an exact join follows, which then shuffles little
    more than the rows it keeps."""
    return marked_likely(rows, wanted, key).where("__likely").drop("__likely")


def marked_likely(rows: DataFrame, wanted: DataFrame, key: str) -> DataFrame:
    """All ``rows``, with a boolean column ``__likely`` (see ``likely_in``)."""
    point = F.pmod(F.xxhash64(key), F.lit(BITMAP))
    bits = (wanted.select(F.shiftright(point, 6).alias("__w"), F.pmod(point, F.lit(64)).cast("int").alias("__b"))
            .groupBy("__w").agg(F.bit_or(F.expr("shiftleft(1L, __b)")).alias("__m")))
    spread = rows.withColumn("__w", F.shiftright(point, 6)).withColumn("__b", F.pmod(point, F.lit(64)).cast("int"))
    return (spread.join(F.broadcast(bits), "__w", "left")
            .withColumn("__likely", F.expr("coalesce((shiftrightunsigned(__m, __b) & 1L) = 1L, false)"))
            .drop("__w", "__b", "__m"))


def map_texts(df: DataFrame, text: str, keep: list[str], schema: str,
              make: Callable[[], Callable[[list[bytes]], dict[str, list | pa.Array]]]) -> DataFrame:
    """One output row per input row: the ``keep`` columns, then the columns
    ``make()(texts)`` returns for a list of whole texts (UTF-8 bytes, null:
    empty). ``make`` runs once per task. Rows stream through in Arrow batches;
    ``schema`` is the DDL of the added columns."""
    # the text travels once, also when it is one of the columns to keep
    at_text = keep.index(text) if text in keep else len(keep)
    src = df.select(*[F.col(c) for c in keep],
                    *([] if text in keep else [F.col(text).cast("binary").alias("__text")]))
    kept = src.select(*[src[c] for c in keep]).schema
    added = _schema(schema)
    out = _struct(list(kept.fields) + list(added.fields))
    names = [f.name for f in added.fields]
    n_kept = len(keep)

    def run(batches: Iterator[pa.RecordBatch]) -> Iterator[pa.RecordBatch]:
        from pyspark.sql.pandas.types import to_arrow_schema
        target = to_arrow_schema(out)
        f = make()
        for b in batches:
            at, texts = 0, b.column(at_text).cast(pa.binary())
            sizes = pc.fill_null(pc.binary_length(texts), 0).to_pylist()
            while at < b.num_rows:
                end, size = at, 0
                while end < b.num_rows and (end == at or size + sizes[end] <= CHUNK_BYTES):
                    size += sizes[end]
                    end += 1
                got = f([v.as_py() or b"" for v in texts[at:end]])
                cols = [b.column(i)[at:end] for i in range(n_kept)] + [got[n] for n in names]
                cols = [c.cast(t.type) if isinstance(c, pa.Array) else pa.array(c, t.type)
                        for c, t in zip(cols, target)]
                yield pa.RecordBatch.from_arrays(cols, schema=target)
                at = end
        pa.default_memory_pool().release_unused()

    return src.mapInArrow(run, out)


def _schema(ddl: str):
    from pyspark.sql import types as T
    return T._parse_datatype_string(ddl)


def _struct(fields):
    from pyspark.sql import types as T
    return T.StructType([T.StructField(f.name, f.dataType, True) for f in fields])


def crc_mod(col, n: int):
    """crc32 of the id as text, modulo ``n``: the fold of a document (the fold
    of a null id is null)."""
    return F.crc32(F.col(col).cast("string").cast("binary")) % n


def sha(b: bytes) -> str:
    return hashlib.sha256(b).hexdigest()
