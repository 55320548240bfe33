"""Secret scans with character Markov models, in DataFrame functions only.

Base rules find assignments, access keys and long hex strings. On top, two
first-order Markov models over characters are trained from labelled samples:
the values of the base spans of the whole corpus are the random strings, its
long words outside base spans, in the ways identifiers are formed of words, the
ordinary identifiers. A candidate (a run of
``LEAST_CANDIDATE`` or more key characters) whose log-likelihood ratio per
transition reaches ``THRESHOLD`` is added as a ``markov`` span. Base spans are cut
out of a run first; each rest of at least ``LEAST_CANDIDATE`` characters is a
candidate of its own.

The models are transition counts, at most one row per pair of characters of
the alphabet, so collecting them has a fixed bound. Ratios are whole
thousandths, so sums do not depend on their order. Match positions come from
``split`` (the text between matches) and a doubling prefix sum, so a text with
m matches costs m log m.

Defined cases: null text is empty and has no spans; positions are code points,
end exclusive; repeated rows and null ids are rows like others; with no base
span in the corpus the random model is uniform; empty tables give no
rows; other columns are ignored.
"""

from __future__ import annotations

import math
from functools import reduce

from pyspark.sql import Column, DataFrame
from pyspark.sql import functions as F

from .common import once

# The base rules, letters of the assignment keywords in either case.
KEYWORDS = ("password", "passwd", "secret", "token", "api_?key")
KINDS = ("assign", "access", "hex", "markov")
LEAST_VALUE = 6


def _either_case(word: str) -> str:
    return "".join(f"[{c.upper()}{c}]" if c.isalpha() else c for c in word)


ASSIGN = "(" + "|".join(map(_either_case, KEYWORDS)) + r""")["']?\x20*[:=]\x20*["']?([A-Za-z0-9+/_.=-]+)"""
# A run of key characters is matched whole, so a least length in the pattern
# drops the same matches as a later filter.
ACCESS = r"AKIA[A-Z0-9]{16,}"
HEX = r"[0-9a-f]{24,}"

ALPHABET = "ABCDEFGHIJKLMNOPQRSTUVWXYZabcdefghijklmnopqrstuvwxyz0123456789+/_-"
LEAST_CANDIDATE = 20
CANDIDATE = r"[A-Za-z0-9+/_-]{20,}"
WORD = r"[A-Za-z0-9_]{12,}"
#: Weight of the uniform prior per character, in transitions.
PRIOR = 6.6
#: Thousandths of a nat per transition from which a candidate is a secret.
THRESHOLD = 700
MASK = "[SECRET]"


def _prefix_sums(lengths: Column) -> Column:
    """Running sums of an array of ints, by doubling."""
    rounds = F.sequence(F.lit(0), F.ceil(F.log2(F.greatest(F.size(lengths), F.lit(1)))).cast("int"))

    def double(acc: Column, k: Column) -> Column:
        back = F.pow(F.lit(2), k).cast("int")
        return F.transform(acc, lambda x, i: x + F.when(i >= back, F.get(acc, i - back)).otherwise(F.lit(0)))

    return F.aggregate(rounds, lengths, double)


_SPAN = "array<struct<start:int,kind:int,end:int,value:string>>"


def _spans(text: Column, pattern: str, kind: int, value_group: int = 0) -> Column:
    """All matches as (start, kind, end, value), empty without a match."""
    found = F.regexp_extract_all(text, F.lit(pattern), F.lit(0))
    values = F.regexp_extract_all(text, F.lit(pattern), F.lit(value_group))
    pieces = F.split(text, pattern, -1)
    widths = F.zip_with(F.slice(pieces, F.lit(1), F.size(found)), found, lambda a, b: F.length(a) + F.length(b))
    ends = _prefix_sums(widths)
    spans = F.zip_with(F.arrays_zip(found.alias("m"), values.alias("v")), ends, lambda x, end: F.struct(
        (end - F.length(x["m"])).alias("start"), F.lit(kind).alias("kind"), end.alias("end"),
        x["v"].alias("value"))).cast(_SPAN)
    return F.when(text.rlike(pattern), spans).otherwise(F.array().cast(_SPAN))


def base_spans(docs: DataFrame, text: str = "text") -> DataFrame:
    """``docs`` with the array column ``base`` of base spans, sorted."""
    t = F.coalesce(F.col(text).cast("string"), F.lit(""))
    assign = F.filter(_spans(t, ASSIGN, 0, 2), lambda s: F.length(s["value"]) >= LEAST_VALUE)
    return once(docs, "base", F.array_sort(F.concat(assign, _spans(t, ACCESS, 1), _spans(t, HEX, 2))))


def _characters(token: Column) -> Column:
    """The characters of a string. Places in a string are found by walking it,
    those of an array directly, so long tokens are split once."""
    return F.split(token, "", -1)


def _adjacent(values: Column, f) -> Column:
    """``f`` over neighbouring elements of an array of one element or more."""
    n = F.size(values) - 1
    return F.zip_with(F.slice(values, F.lit(1), n), F.slice(values, F.lit(2), n), f)


def _transitions(words: DataFrame) -> DataFrame:
    """Counts of adjacent characters in the column ``w``, characters outside
    the alphabet left out."""
    rows = once(words.where("length(w) > 1"), "c", _characters(F.col("w")))
    pairs = rows.select(F.explode(_adjacent(F.col("c"), lambda a, b: F.concat(a, b))).alias("pair"))
    return pairs.where(F.col("pair").rlike(r"^[A-Za-z0-9+/_-]{2}$")).groupBy("pair").count()


def identifier(w: Column) -> Column:
    """A word as identifiers are formed of it: alone, in capitals, in camel
    case, joined by the marks of the alphabet."""
    camel = F.concat(F.lower(w), F.initcap(w))
    return F.concat(w, F.lit("_"), F.upper(w), F.lit("/"), camel, F.lit("-"), w)


def train(docs: DataFrame, text: str = "text") -> list[int]:
    """Log-likelihood ratios, in thousandths, by (previous, next) character."""
    rows = base_spans(docs.select(F.col(text).alias("text")))
    random = _transitions(rows.select(F.explode("base.value").alias("w")))
    plain = F.coalesce("text", F.lit(""))
    # base spans are cut out, so a word next to one is a sample, its value not
    for pattern in (ASSIGN, ACCESS, HEX):
        plain = F.regexp_replace(plain, pattern, " ")
    words = rows.select(F.explode(F.regexp_extract_all(plain, F.lit(WORD), F.lit(0))).alias("w"))
    words = _transitions(words.select(identifier(F.col("w")).alias("w")))
    counts = (random.withColumn("label", F.lit(1)).unionByName(words.withColumn("label", F.lit(0)))).collect()
    return ratios({r["pair"]: r["count"] for r in counts if r["label"]},
                  {r["pair"]: r["count"] for r in counts if not r["label"]})


def ratios(random: dict[str, int], words: dict[str, int]) -> list[int]:
    """The random model is an even mixture of the Markov model of the samples
    and of uniform characters, so that it covers alphabets the samples lack."""
    k = len(ALPHABET)

    def p(counts: dict[str, int]) -> dict[str, float]:
        rows = {a: sum(counts.get(a + b, 0) for b in ALPHABET) for a in ALPHABET}
        return {a + b: (counts.get(a + b, 0) + PRIOR / k) / (rows[a] + PRIOR) for a in ALPHABET for b in ALPHABET}

    r, w = p(random), p(words)
    return [round(1000 * math.log((r[a + b] + 1 / k) / 2 / w[a + b])) for a in ALPHABET for b in ALPHABET]


def _ratio(token: Column, table: Column) -> Column:
    """Sum of the transition ratios of a token of alphabet characters."""
    k = len(ALPHABET)
    codes = F.transform(_characters(token), lambda c: F.position(c, F.lit(ALPHABET)))
    steps = _adjacent(codes, lambda a, b: F.element_at(table, (a - 1) * k + b))
    return F.aggregate(steps, F.lit(0).cast("long"), lambda s, x: s + x)


def _table(model: list[int]) -> Column:
    return F.split(F.lit(",".join(map(str, model))), ",").cast("array<int>")


def _random(token: Column, table: Column) -> Column:
    return _ratio(token, table) >= F.lit(THRESHOLD).cast("long") * (F.length(token) - 1)


def _running_max(values: Column) -> Column:
    """Running maxima of an array of ints, by doubling."""
    rounds = F.sequence(F.lit(0), F.ceil(F.log2(F.greatest(F.size(values), F.lit(1)))).cast("int"))

    def double(acc: Column, k: Column) -> Column:
        back = F.pow(F.lit(2), k).cast("int")
        return F.transform(acc, lambda x, i: F.when(i >= back, F.greatest(x, F.get(acc, i - back))).otherwise(x))

    return F.aggregate(rounds, values, double)


def _rests(run: Column, base: Column) -> Column:
    """What is left of a candidate run (ASCII) without the sorted base spans it
    overlaps: the gaps of LEAST_CANDIDATE characters or more."""
    begins = F.concat(F.array(run["start"]), _running_max(F.transform(base, lambda b: F.greatest(b["end"], run["start"]))))
    ends = F.concat(F.transform(base, lambda b: F.least(b["start"], run["end"])), F.array(run["end"]))
    bytes_ = run["value"].cast("binary")
    gaps = F.filter(F.zip_with(begins, ends, lambda a, b: F.struct(a.alias("a"), b.alias("b"))),
                    lambda g: g["b"] - g["a"] >= LEAST_CANDIDATE)
    return F.transform(gaps, lambda g: F.struct(
        g["a"].alias("start"), F.lit(3).alias("kind"), g["b"].alias("end"),
        F.substring(bytes_, g["a"] - run["start"] + 1, g["b"] - g["a"]).cast("string").alias("value"))).cast(_SPAN)


def added_spans(rows: DataFrame, model: list[int], text: str = "text") -> DataFrame:
    """``rows`` (with ``base``) plus the array column ``added``."""
    t = F.coalesce(F.col(text).cast("string"), F.lit(""))
    table = _table(model)
    rows = once(rows, "added", _spans(t, CANDIDATE, 3))

    def pieces(s: Column) -> Column:
        over = F.filter("base", lambda b: (b["start"] < s["end"]) & (s["start"] < b["end"]))
        return F.when(F.exists("base", lambda b: (b["start"] < s["end"]) & (s["start"] < b["end"])), _rests(s, over)) \
            .otherwise(F.array(s))

    rows = once(rows, "added", F.when((F.size("added") == 0) | (F.size("base") == 0), F.col("added"))
                .otherwise(F.flatten(F.transform("added", pieces))))
    return once(rows, "added", F.when(F.size("added") == 0, F.col("added"))
                .otherwise(F.filter("added", lambda s: _random(s["value"], table))))


def _joined(spans: Column) -> Column:
    names = F.array(*map(F.lit, KINDS))
    return F.array_join(F.transform(spans, lambda s: F.concat_ws(
        ":", F.get(names, s["kind"]), s["start"].cast("string"), s["end"].cast("string"))), ",")


def scan_secrets(docs: DataFrame, doc_id: str = "doc_id", text: str = "text",
                 model: list[int] | None = None) -> DataFrame:
    """Per document: doc_id, counts by base kind, digest of the base spans and
    all spans as text, and ``found`` (the spans with their values)."""
    docs = docs.select(F.col(doc_id).alias("doc_id"), F.col(text).alias("text"))
    model = model or train(docs)
    rows = added_spans(base_spans(docs), model)

    def count(kind: int) -> Column:
        return F.size(F.filter("base", lambda s: s["kind"] == kind)).cast("long")

    return (rows.withColumn("found", F.array_sort(F.concat("base", "added")))
            .select("doc_id", count(0).alias("n_assign"), count(1).alias("n_access"), count(2).alias("n_hex"),
                    F.sha2(_joined(F.col("base")), 256).alias("base_sha256"),
                    _joined(F.col("found")).alias("spans"), "found"))


def _masked(text: Column, pattern: str, secret) -> Column:
    """``text`` with the matches that ``secret(match, group 2 or match)``
    accepts replaced by MASK."""
    group = 2 if pattern == ASSIGN else 0
    found = F.regexp_extract_all(text, F.lit(pattern), F.lit(0))
    values = F.regexp_extract_all(text, F.lit(pattern), F.lit(group))
    shown = F.transform(F.arrays_zip(found.alias("m"), values.alias("v")),
                        lambda x: F.when(secret(x["v"]), F.lit(MASK)).otherwise(x["m"]))
    pieces = F.split(text, pattern, -1)
    joined = F.array_join(F.zip_with(pieces, F.concat(shown, F.array(F.lit(""))), lambda a, b: F.concat(a, b)), "")
    return F.when(text.rlike(pattern), joined).otherwise(text)


def mask_secrets(docs: DataFrame, text: str = "text", model: list[int] | None = None) -> DataFrame:
    """All columns of ``docs``, with secrets in ``text`` replaced by MASK: first
    assignments, then access keys, hex strings and random candidates, each in
    what the step before left. Null stays null."""
    model = model or train(docs, text)
    table = _table(model)
    steps = ((ASSIGN, lambda v: F.length(v) >= LEAST_VALUE), (ACCESS, lambda v: F.lit(True)),
             (HEX, lambda v: F.lit(True)), (CANDIDATE, lambda v: _random(v, table)))
    return reduce(lambda d, s: d.withColumn(text, _masked(F.col(text), *s)), steps, docs)
