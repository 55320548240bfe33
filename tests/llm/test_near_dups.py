"""Near-dedup against all pairs, edge cases and the closing step."""
import random

from kredex.llm import near_dups as N

import brute


def digest(df):
    return {(r.doc_id, r.n_shingles, r.component_id, r.kept) for r in df.collect()}


def family(seed, copies=60):
    """Edits of one text, so that pairwise similarities lie around the limit."""
    rng = random.Random(seed)
    words = [f"w{rng.randrange(10**6)}" for _ in range(120)]
    out = []
    for _ in range(copies):
        w = list(words)
        for _ in range(rng.randrange(0, 12)):
            w[rng.randrange(len(w))] = f"x{rng.randrange(10**6)}"
        out.append(" ".join(w))
    return out


def test_families_equal_all_pairs(make_docs):
    texts = family(1) + family(2, 30) + family(3, 5)
    rows = [(100 + i * 3 % 400, t) for i, t in enumerate(texts)]
    got = digest(N.near_duplicates(make_docs(rows)))
    assert got == brute.near_dups(rows)


def test_closing_step_in_blocks(make_docs):
    rows = list(enumerate(family(4, 80)))
    assert digest(N.near_duplicates(make_docs(rows), block=7)) == brute.near_dups(rows)


def test_edges(edge_docs, no_docs):
    assert digest(N.near_duplicates(edge_docs)) == brute.near_dups(brute.EDGES)
    assert N.near_duplicates(no_docs).collect() == []


def test_keep_one(make_docs, edge_docs, no_docs):
    rows = [(i, t) for i, t in enumerate(family(5, 40) + ["", None, "lone text of five words"])] + [(0, family(5, 40)[0])]
    docs = make_docs(rows, ("key", "digest"))
    got = sorted(r.doc_id for r in N.keep_one(docs).collect())
    want = sorted({r[0] for r in brute.near_dups(rows) if r[3]})
    assert got == want
    assert N.keep_one(docs).columns == docs.columns
    assert N.keep_one(no_docs).collect() == []
    assert sorted(str(r.doc_id) for r in N.keep_one(edge_docs).collect()) == \
        ["1", "2", "3", "5", "6", "7", "8", "9"]


def test_keep_one_moves_a_text_once(spark, make_docs):
    """Whole texts meet the verdicts in one join, also without broadcasts; a
    second one takes survivors that repeat to their fold."""
    docs = make_docs([*enumerate(family(6, 20))])
    prev = spark.conf.get("spark.sql.autoBroadcastJoinThreshold")
    spark.conf.set("spark.sql.autoBroadcastJoinThreshold", "-1")
    try:
        tree = N.keep_one(docs)._jdf.queryExecution().sparkPlan().toString()
    finally:
        spark.conf.set("spark.sql.autoBroadcastJoinThreshold", prev)
    assert tree.count("SortMergeJoin") == 2


def test_keep_one_folds_only_equal_rows(make_docs):
    """Rows that repeat id and text give one row; of one text under several
    ids the smallest stays; rows without words stay as often as they come."""
    a, lone = family(7, 1)[0], "five words of their own"
    rows = [(5, a), (5, a), (3, a), (3, a), (None, a), (9, lone), (9, lone), (8, ""), (8, "")]
    got = sorted((str(r.doc_id), r.text) for r in N.keep_one(make_docs(rows)).collect())
    assert got == [("3", a), ("8", ""), ("8", ""), ("9", lone)]


def test_sketch_never_loses_a_link():
    import numpy as np
    rng = np.random.default_rng(0)
    for size in (20, 300, 1000):
        a = np.unique(rng.integers(0, 2 ** 63, size, dtype=np.uint64))
        drop = size // 10
        b = np.unique(np.concatenate([a[drop:], rng.integers(0, 2 ** 63, drop, dtype=np.uint64)]))
        z = int(np.bitwise_count((N.odd_sketch(a) ^ N.odd_sketch(b)).view(np.uint64)).sum())
        assert z <= len(np.setxor1d(a, b))


def test_sketch_limit_of_large_sets():
    """The worst linked pair: one set holds 80 % of the other."""
    import math
    import numpy as np
    rng = np.random.default_rng(1)
    most = math.floor(N.BITS / 2 * (1 - math.exp(-2 * N.MOST_APART / N.BITS)))
    for size in (3000, 20000):
        z = []
        for _ in range(400):
            b = rng.integers(0, 2 ** 63, size, dtype=np.uint64)
            a, b = np.sort(b[:size * 8 // 10]), np.sort(b)
            z.append(int(np.bitwise_count((N.odd_sketch(a) ^ N.odd_sketch(b)).view(np.uint64)).sum()))
        assert max(z) <= most and most >= np.mean(z) + 5 * np.std(z)
