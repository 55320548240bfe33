"""Toxicity, importance resampling and vector codes against plain versions."""
import hashlib
import math
import random
import re
import zlib

import numpy as np
import pytest
from pyspark.sql import functions as F

import brute
from kredex.llm import importance as I
from kredex.llm import toxicity as X
from kredex.llm import vector_codes as V

CLASHES = [*brute.CLASHES, "score", "rank", "bin", "weight", "n_features", "buckets", "i", "y", "v", "code", "error"]


# ---- importance resampling -------------------------------------------------

def features(text):
    w = re.findall(brute.BENCH_WORD, brute.lower(text))
    return [zlib.crc32(" ".join(w[i:i + k]).encode()) % 10000 for k in (1, 2, 3) for i in range(len(w) - k + 1)], len(w)


def plain_resample(docs, targets, percent=5, least=20):
    s, t = np.zeros(10000, int), np.zeros(10000, int)
    got = [(d, *features(x)) for d, x in docs]
    for _, f, _ in got:
        np.add.at(s, f, 1)
    for x in targets:
        np.add.at(t, features(x)[0], 1)
    big_s, big_t = int(s.sum()), int(t.sum())
    gain = [math.floor(1000 * math.log((b + 1) * (big_s + 10000) / ((a + 1) * (big_t + 10000)))) for a, b in zip(s.tolist(), t.tolist())]
    rows = []
    for d, f, n in got:
        h = int(hashlib.sha256(f"42:{'' if d is None else d}".encode()).hexdigest()[:8], 16)
        weight = sum(gain[x] for x in f)
        rows.append([d, len(f), weight, weight + math.floor(-1000 * math.log(-math.log((h + 0.5) / 4294967296))), None, n])
    able = sorted((r for r in rows if r[5] >= least), key=lambda r: (-r[3], r[0] is None, r[0] or 0))
    for k, r in enumerate(able[:percent * len(able) // 100]):
        r[4] = k + 1
    return sorted(map(tuple, rows), key=str)


def drawn(df):
    return sorted((tuple(r) for r in df.select("doc_id", "n_features", "weight", "score", "rank", "n_words").collect()), key=str)


def test_features_of_odd_texts(monkeypatch):
    rng = random.Random(4)
    texts = [t for _, t in brute.EDGES] + ["a" * 5000 + " b " + "q" * 777, "x" * 256, "x" * 257, "Ab-cD  eF"]
    texts += [" ".join(rng.choice(["the", "of", "Th", "x1", "zzé"]) for _ in range(rng.randrange(60))) for _ in range(40)]
    want = [features(t) for t in texts]
    for block in (1 << 20, 50):
        monkeypatch.setattr(I, "BLOCK_BYTES", block)
        n, found = I.Features().buckets_of([(t or "").encode() for t in texts])
        assert n.tolist() == [w[1] for w in want]
        assert found.tolist() == [x for w in want for x in w[0]]


def test_resampling(spark, make_docs):
    rng = random.Random(9)
    text = lambda n: " ".join(rng.choice("alpha beta gamma delta eps zeta eta theta".split()) for _ in range(n))
    rows = [(i, text(rng.randrange(10, 60))) for i in range(300)]
    rows += [rows[7]] * 5 + [(None, rows[3][1]), (None, rows[3][1]), (None, None), (500, "")] + [r[:2] for r in brute.EDGES]
    targets = ["alpha beta gamma alpha beta gamma", None, "theta"]
    bench = spark.createDataFrame([(k, t) for k, t in enumerate(targets)], "item_id long, text string")
    docs = make_docs(rows, CLASHES)
    assert drawn(I.resample(docs, bench)) == plain_resample(rows, targets)
    half = drawn(I.resample(docs, bench, percent=50))
    assert half == plain_resample(rows, targets, percent=50)
    assert sorted(r[4] for r in half if r[4]) == list(range(1, 1 + sum(r[4] is not None for r in half)))


def test_resampling_many_equal_rows(spark, make_docs, monkeypatch):
    monkeypatch.setattr(I, "RUN", 7)
    rows = [(1, "one two three " * 10)] * 400 + [(k, f"other words {k} " * 8) for k in range(2, 60)]
    bench = spark.createDataFrame([(1, "one two three")], "item_id long, text string")
    got = drawn(I.resample(make_docs(rows), bench, percent=30))
    assert got == plain_resample(rows, ["one two three"], percent=30)


def test_resampling_empty(spark, no_docs, edge_docs):
    bench = spark.createDataFrame([], "item_id long, text string")
    assert I.resample(no_docs, bench).collect() == []
    assert drawn(I.resample(edge_docs, bench)) == plain_resample([r[:2] for r in brute.EDGES], [])


# ---- vector codes ------------------------------------------------------------

def plain_codes(rows, rounds=6):
    """Every part against every entry."""
    kept = [(i, x, lab) for i, x, lab in rows
            if x is not None and all(v is not None and math.isfinite(v) for v in x)]
    ints = [(i, [math.floor(4096 * v) for v in x], lab) for i, x, lab in kept]
    if not ints:
        return []
    size = len(ints[0][1]) // 8
    part = lambda x, p: x[p * size:(p + 1) * size]
    first = sorted(ints, key=lambda r: (r[0] is None, r[0] or 0, r[1]))[:16]
    books = [[part(r[1], p) for r in first] for p in range(8)]
    near = lambda x, b: min((sum((a - c) ** 2 for a, c in zip(x, e)), k) for k, e in enumerate(b))
    for _ in range(rounds):
        for p in range(8):
            own = [[] for _ in books[p]]
            for _, x, _ in ints:
                own[near(part(x, p), books[p])[1]].append(part(x, p))
            books[p] = [[sum(c) // len(m) for c in zip(*m)] if m else e for e, m in zip(books[p], own)]
    digest = hashlib.sha256(",".join(str(v) for b in books for e in b for v in e).encode()).hexdigest()
    out, by = [], {}
    for i, x, lab in ints:
        got = [near(part(x, p), books[p]) for p in range(8)]
        err = sum(d for d, _ in got)
        by[lab] = by.get(lab, 0) + err
        out.append((i, "".join(f"{k:02x}" for _, k in got), err, lab))
    return sorted([(i, c, e, by[lab], digest) for i, c, e, lab in out], key=str)


VECTORS = "vec_id long, embedding array<float>, label int"


def codes_of(df):
    return sorted((tuple(r) for r in df.collect()), key=str)


def f32(x):
    return float(np.float32(x))


@pytest.mark.parametrize("seed,width", [(1, 16), (2, 8)])
def test_codes_equal_all_comparisons(spark, monkeypatch, seed, width):
    monkeypatch.setattr(V, "PACK", 37)
    rng = random.Random(seed)
    # few values: many ties, equal entries and entries that lose all parts
    rows = [(rng.choice([k, k, None if k > 100 else k]), [f32(rng.choice([-1, 0, 0.25, 0.5, 1]) * rng.choice([1, 0.1])) for _ in range(width)],
             rng.choice([None, 1, 2])) for k in range(160)]
    rows += [rows[5], rows[5], (900, None, 1), (901, [None] * width, 1), (902, [float("nan")] * width, 1),
             (903, [float("inf")] + [0.0] * (width - 1), 2)]
    df = spark.createDataFrame(rows, VECTORS).withColumn("code", F.lit(1)).withColumn("x", F.lit(2)).repartition(3)
    assert codes_of(V.vector_codes(df)) == plain_codes(rows)


def test_ball_bounds_skip_work():
    """Far balls are not compared at all, and every result is the nearest."""
    rng = np.random.default_rng(3)
    book = rng.integers(-40_000, 40_000, (16, 4))
    points = book[rng.integers(0, 16, 4000)] + rng.integers(-300, 300, (4000, 4))
    codes, _ = V.nearest(points, book)
    after, own, compared = V.balls(points, codes, book)
    assert (after == codes).all() and compared < 0.2 * 15 * len(points)
    moved = book + rng.integers(-9000, 9000, book.shape)
    want = V.nearest(points, moved)
    got = V.balls(points, codes, moved)
    assert (got[0] == want[0]).all() and (got[1] == want[1]).all() and got[2] < 15 * len(points)


def test_codes_at_the_edges(spark):
    assert V.vector_codes(spark.createDataFrame([], VECTORS)).collect() == []
    few = [(3, [0.5] * 8, None), (1, [-0.5] * 8, 7)]
    assert codes_of(V.vector_codes(spark.createDataFrame(few, VECTORS))) == plain_codes(few)
    for bad in ([(1, [0.0] * 8, 1), (2, [0.0] * 16, 1)], [(1, [0.0] * 9, 1)], [(1, [1e12] * 8, 1)]):
        with pytest.raises(ValueError):
            V.vector_codes(spark.createDataFrame(bad, VECTORS))


# ---- toxicity ------------------------------------------------------------------

INSULTS = ("idiot", "moron", "stupid", "pathetic", "worthless")
HIDERS = (lambda w: w, lambda w: w.translate(str.maketrans("aeios", "4310$")), " ".join, ".".join,
          lambda w: w[:2] + w[2] * 4 + w[3:], str.upper)


def toxic_corpus(n=900):
    rng = random.Random(5)
    plain = [a + b for a in ("lan", "ter", "min", "son", "ber", "tal", "ren") for b in ("der", "ing", "son", "ten", "is", "or", "et")]
    docs, labels = [], []
    for i in range(n):
        bad = i % 4 == 0
        w = [rng.choice(plain) for _ in range(40)]
        if bad:
            hide = HIDERS[0] if rng.random() < 0.6 else rng.choice(HIDERS)
            for _ in range(2):
                w.insert(rng.randrange(len(w)), hide(rng.choice(INSULTS)))
        docs.append((i, " ".join(w)))
        if i % 10 != 9:
            labels.append((i, int(bad)))
    return docs, labels


def exact_cost(cost, restored):
    """Source cost of a text by the trigram table."""
    c = [X.GAP, X.GAP]
    total = 0.0
    for ch in [*restored.encode("latin-1"), None]:
        k = X.GAP if ch is None else int(X.CLASS[ch])
        if k == X.GAP and c[-1] == X.GAP:
            continue
        total += cost[c[-2]][c[-1]][k]
        c.append(k)
    return total


def test_viterbi_finds_the_least_cost(spark):
    """All readings of a lattice, one by one."""
    import itertools
    rng = np.random.default_rng(8)
    decoder = X.Decoder(X.language_model(rng.integers(0, 50, X.SIZE ** 3)))

    def readings(piece):
        runs = [len(m[0]) for m in re.finditer(r"(.)\1*", piece) for _ in m[0]]
        for choice in itertools.product(*[[(s, 0.0)] if s.isalpha() else
                                          [(x, X.SWAP + math.log(len(X.LOOKS[s]))) for x in X.LOOKS.get(s, "")] + [(s, X.SELF)]
                                          for s in piece]):
            for drop in itertools.product((False, True), repeat=len(piece)):
                out, cost = "", 0.0
                for k, ((x, own), gone) in enumerate(zip(choice, drop)):
                    cost += own
                    if gone:
                        if not (out and x.isalpha() and out[-1] == x):
                            cost = math.inf
                        cost += X.REPEAT if runs[k] > 2 else X.PAIR
                    else:
                        out += x
                yield cost + exact_cost(decoder.cost, out), out

    for piece in ("1d10t", "m00n", "aaab", "$t1ck", "b4d!x"):
        least, text = min(readings(piece))
        cost, got = decoder.reading(piece.encode())
        assert math.isclose(cost, least, rel_tol=1e-9) and got.decode() == text


def test_hidden_words_are_restored(spark, make_docs):
    docs, labels = toxic_corpus()
    cost = X.language_model(X.count_trigrams(make_docs(docs)))
    d = X.Decoder(cost)
    for word in INSULTS:
        for hide in HIDERS:
            assert word in d.restore([f"ter {hide(word)} lanis".encode()])[0].decode(), (word, hide(word))
    kept = ["landerer 42 5", "", "x", "tall beet"]
    assert d.restore([t.encode() for t in kept]) == [t.encode() for t in kept]
    long = "a " * 3000
    assert len(d.restore([long.encode()])[0]) <= len(long)


def test_toxicity_held_out(spark, make_docs):
    docs, labels = toxic_corpus()
    extra = [r[:2] for r in brute.EDGES if r[0] is None or r[0] > 2]
    table = spark.createDataFrame([*labels, (None, 1), (3, None)], "doc_id long, toxic int")
    got = X.score_toxicity(make_docs([*docs, *[(None if d is None else d + 5000, t) for d, t in extra]], CLASHES), table).collect()
    assert len(got) == len(docs) + len(extra)
    truth = {i: int(i % 4 == 0) for i, _ in docs}
    held = [r for r in got if r.held_out and r.doc_id in truth]
    assert all(r.held_out == (zlib.crc32(str(r.doc_id).encode()) % 3 == 1) for r in got if r.doc_id is not None)
    assert len(held) > 200 and np.mean([r.predicted == truth[r.doc_id] for r in held]) > 0.97
    assert all(0 <= r.score <= 1 and r.predicted == int(r.score >= 0.7) for r in got)
    assert all(not r.predicted for r in got if r.doc_id is None or r.doc_id >= 5000)


def test_toxicity_without_labels(spark, make_docs, no_docs, edge_docs):
    none = spark.createDataFrame([], "doc_id long, toxic int")
    assert X.score_toxicity(no_docs, none).collect() == []
    assert {r.score for r in X.score_toxicity(edge_docs, none).collect()} == {0.5}
