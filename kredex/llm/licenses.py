"""License scans, in DataFrame functions only.

A text is cut to lower-cased words and these to ``WIDTH``-word shingles.
Templates are compared with overlapping windows of their own length: windows of
s shingles for a template of s, every ``max(1, s / 4)`` shingles. Each of
``bands_for(...)`` bands holds one MinHash value; a window whose minimum equals
the template's in any band is a candidate. At the lowest similarity of a window
that the verification can accept (``LEAST_JACCARD``) this happens with a
probability of at least ``SURE``. Candidates are verified by exact shingle
containment: at least ``CONTAINED`` percent of the template's shingles occur in
the window or within one step around it.

A minimum can only equal the template's if the window holds the shingle that
attains it, so a text is first searched for these few shingles, and only the
neighbourhoods of their occurrences are windowed. The templates are a fixed
query set given as a parameter; everything else stays distributed.

Result: one row per document id and template found: the size of the template
in shingles, the most shared shingles of an accepted window and the word at
which the first accepted window's match starts.

Defined cases: null or empty texts and texts of fewer than five words match
nothing; rows that repeat an id are one document; null ids form one; a template
of fewer than five words is an error; empty tables give no rows; other columns
are ignored.
"""

from __future__ import annotations

import math
import re

from pyspark.sql import Column, DataFrame
from pyspark.sql import functions as F

from .common import once
from .license_texts import TEMPLATES

WIDTH = 5
CONTAINED = 80                   # percent
#: Jaccard similarity of a window one half step off a template of which it
#: holds 80 %: (0.8 - 1/8) / (1.2 + 1/8).
LEAST_JACCARD = 0.5
SURE = 0.9999


def bands_for(similarity: float = LEAST_JACCARD, sure: float = SURE) -> int:
    """One-value bands needed so that a pair of this similarity collides in
    one of them with probability ``sure``."""
    return math.ceil(math.log(1 - sure) / math.log(1 - similarity))


def words(text: Column) -> Column:
    flat = F.trim(F.regexp_replace(F.lower(F.coalesce(text, F.lit(""))), r"[^\p{L}\p{N}]+", " "))
    return F.split(flat, " ", -1)


def shingles(w: Column) -> Column:
    """Shingle hashes by position; empty below WIDTH words."""
    return F.when(F.size(w) >= WIDTH, F.transform(
        F.sequence(F.lit(0), F.size(w) - WIDTH), lambda i: F.xxhash64(F.slice(w, i + 1, F.lit(WIDTH))))
    ).otherwise(F.array().cast("array<bigint>"))


def _band(x: Column, band: Column) -> Column:
    return F.xxhash64(band, x)


def _templates(spark, templates: dict[str, str]) -> DataFrame:
    """(license, size, step, t: its distinct shingles)."""
    short = [k for k, v in templates.items() if len(re.findall(r"[^\W_]+", v)) < WIDTH]
    if short:
        raise ValueError(f"templates need {WIDTH} words: {short}")
    rows = spark.createDataFrame(sorted(templates.items()), "license string, text string")
    return (rows.withColumn("w", words(F.col("text"))).withColumn("sh", shingles(F.col("w")))
            .select("license", "w", "sh", F.array_distinct("sh").alias("t"))
            .withColumn("size", F.size("t")).withColumn("step", F.greatest(F.lit(1), F.floor(F.col("size") / 4).cast("int"))))


def scan_licenses(docs: DataFrame, doc_id: str = "doc_id", text: str = "text",
                  templates: dict[str, str] = TEMPLATES) -> DataFrame:
    """(doc_id, license, n_template, n_shared, first_word) per template found."""
    known = _templates(docs.sparkSession, templates)
    bands = F.explode(F.sequence(F.lit(0), F.lit(bands_for() - 1)))
    anchors = (known.withColumn("band", bands)
               .withColumn("key", F.array_min(F.transform("t", lambda x: _band(x, F.col("band")))))
               .withColumn("anchor", F.explode("t")).where(_band(F.col("anchor"), F.col("band")) == F.col("key")))
    # the templates are a parameter of a few lines: their anchors, the words
    # these start with and the sizes are constants
    fixed = anchors.select("anchor", "size", "step", "w", "sh").distinct().collect()
    first = sorted({r["anchor"] for r in fixed})
    leads = sorted({w for r in fixed for w, x in zip(r["w"], r["sh"]) if x == r["anchor"]})
    # how far the windows around an occurrence reach, over the anchor's templates
    reaches = anchors.groupBy(F.col("anchor").alias("x")).agg(F.max(F.col("size") + 2 * F.col("step")).alias("reach"))
    anchors = anchors.drop("w", "sh")

    rows = docs.select(F.col(doc_id).alias("doc_id"), F.col(text).alias("text"))
    rows = once(rows, "w", words(F.col("text"))).select("doc_id", "w")
    shingle = F.transform("w", lambda x, i: F.struct(i.alias("i"), F.when(
        x.isin(leads), F.xxhash64(F.slice("w", i + 1, F.lit(WIDTH)))).alias("x")))
    rows = once(rows, "p", F.filter(shingle, lambda s: s["x"].isin(first)))
    # one row per occurrence, with the shingles of its neighbourhood only
    # (``base``: the position of the first)
    near = (rows.select("doc_id", "w", F.explode("p").alias("p"))
            .select("doc_id", F.col("p.i").alias("i"), F.col("p.x").alias("anchor"), "w")
            .join(F.broadcast(reaches), F.col("anchor") == F.col("x"))
            .withColumn("base", F.greatest(F.col("i") - F.col("reach"), F.lit(0)))
            .select("doc_id", "i", "anchor", "base",
                    F.slice("w", F.col("base") + 1, 2 * F.col("reach") + WIDTH).alias("words")))
    near = once(near, "near", shingles(F.col("words"))).drop("words")
    hits = near.join(F.broadcast(anchors), "anchor")
    # window starts on the template's grid that hold the occurrence
    low = F.greatest(F.ceil((F.col("i") - F.col("size") + 1) / F.col("step")).cast("int") * F.col("step"), F.lit(0))
    starts = F.when(low <= F.col("i"), F.sequence(low, F.col("i"), F.col("step")))
    windows = hits.withColumn("start", F.explode(starts))
    smallest = F.array_min(F.transform(F.slice("near", F.col("start") - F.col("base") + 1, F.col("size")),
                                       lambda x: _band(x, F.col("band"))))
    from_ = F.greatest(F.col("start") - F.col("step"), F.lit(0))
    region = F.slice("near", from_ - F.col("base") + 1, F.col("start") + F.col("size") + F.col("step") - from_)
    found = (windows.where(smallest == F.col("key"))
             .select("doc_id", "license", "size", "t", from_.alias("from"), region.alias("region"))
             .select("doc_id", "license", "size", "from", F.array_intersect("region", "t").alias("shared"), "region")
             .where(100 * F.size("shared") >= CONTAINED * F.col("size")))
    at = F.array_min(F.transform("shared", lambda x: F.array_position("region", x))) - 1
    return (found.withColumn("at", at + F.col("from"))
            .groupBy("doc_id", "license")
            .agg(F.max("size").cast("long").alias("n_template"), F.max(F.size("shared")).cast("long").alias("n_shared"),
                 F.min("at").cast("long").alias("first_word")))
