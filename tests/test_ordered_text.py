"""Ordered concatenation in ranges equals the plain one, large groups or not."""

import random
from collections import Counter, defaultdict

import pytest
from pyspark.sql import functions as F

from kredex.operators import facts
from kredex.operators.ordered_text import ordered_concat, ranged, text_rank

SCHEMA = "nro_prestamo bigint, orden int, descripcion string"


def plain(rows, sep="; "):
    by = defaultdict(list)
    for k, o, t in rows:
        by[k].append((o is not None, o or 0, t))
    return {k: sep.join(t for _, _, t in sorted((x for x in v if x[2] is not None), key=lambda x: (x[0], x[1], x[2].encode())))
            if any(x[2] is not None for x in v) else None for k, v in by.items()}


def corpus(kind, n=900):
    rng = random.Random(kind)
    word = lambda: "".join(rng.choice("abcéz ñ日") for _ in range(rng.randrange(0, 12)))
    # loan 1 holds a third of the rows
    keys = [1 if rng.random() < 0.34 else rng.randrange(2, 60) for _ in range(n)]
    order = {"spread": lambda: rng.randrange(1, 500), "same": lambda: 7, "few": lambda: rng.choice([None, 3, 3, 3, 3, 4, 9]),
             "null": lambda: None}[kind]
    return [(k, order(), None if rng.random() < 0.05 else word()) for k in keys]


@pytest.mark.parametrize("kind", ["spread", "same", "few", "null"])
def test_equals_the_plain_concatenation(spark, kind):
    rows = corpus(kind)
    df = spark.createDataFrame(rows, SCHEMA).repartition(3)
    want = plain(rows)
    for limit in (20, 10 ** 9):
        got = {r.nro_prestamo: r.collateral_description for r in facts.collateral_text(df, "; ", limit).collect()}
        assert got == want, limit


@pytest.mark.parametrize("kind", ["spread", "same", "few", "null"])
def test_a_large_group_is_spread(spark, kind):
    """The loan with a third of the rows is joined in ranges about as large as
    the other groups."""
    rows = [(k, o, f"{i * 7919 % 4001:05d} text") for i, (k, o, _) in enumerate(corpus(kind, 3000))]
    df = spark.createDataFrame(rows, SCHEMA)
    limit = 50
    sizes = [r["count"] for r in ranged(df, "nro_prestamo", "orden", "descripcion", limit)
             .groupBy("nro_prestamo", "_by_order", "_by_text").count().collect()]
    assert sum(sizes) == len(rows) and max(Counter(k for k, _, _ in rows).values()) > 900
    assert max(sizes) <= 2.5 * limit, sorted(sizes)[-5:]


def test_text_rank_keeps_the_order(spark):
    texts = ["", "a", "a ", "ab", "abcdefg", "abcdefgh", "b", "é", "ñ", "日本", "z", "\U0001F600"]
    rows = spark.createDataFrame([(t,) for t in texts], "t string").select("t", text_rank("t").alias("r")).collect()
    by = [r.r for r in sorted(rows, key=lambda r: r.t.encode())]
    assert by == sorted(by) and len(set(by)) == len(texts) - 1       # the first bytes of two are equal


def test_separator_is_checked(spark):
    df = spark.createDataFrame([], SCHEMA)
    with pytest.raises(ValueError, match="separator"):
        ordered_concat(df, "nro_prestamo", "orden", "descripcion", "'", "x")
    assert facts.collateral_text(df).collect() == []
