"""The language network and the quality ranker against plain versions."""
import math
import random
import zlib

import numpy as np
import pytest

from kredex.llm import lang_id as G
from kredex.llm import quality_rank as Q


def tiny_net(seed=1):
    rng = np.random.default_rng(seed)
    net = G.Net(["aa", "bb", "cc"])
    for w in G.WIDTHS:
        net.tables.append(rng.normal(0, 1, (w, 256, G.FILTERS)).astype(np.float32))
        net.bias.append(rng.normal(0, 0.5, G.FILTERS).astype(np.float32))
    net.out = rng.normal(0, 0.5, (G.FILTERS * len(G.WIDTHS), 3)).astype(np.float32)
    net.out_bias = rng.normal(0, 0.5, 3).astype(np.float32)
    return net


def plain_logits(net, piece):
    """Convolution, pooling and the last layer, one number at a time."""
    padded = list(piece) + [0] * (G.WINDOW - len(piece))
    pooled = []
    for w, table, bias in zip(G.WIDTHS, net.tables, net.bias):
        for f in range(G.FILTERS):
            best = -math.inf
            for at in range(max(1, len(piece) - w + 1)):
                best = max(best, sum(float(table[j][padded[at + j]][f]) for j in range(w)))
            pooled.append(max(0.0, best + float(bias[f])))
    return [sum(p * float(net.out[i][k]) for i, p in enumerate(pooled)) + float(net.out_bias[k]) for k in range(3)]


def plain_prediction(net, text):
    """Label and probability of a whole text: logits of its windows, weighted by their bytes."""
    b = text.lower().encode()
    pieces = [b[i:i + G.WINDOW] for i in range(0, len(b), G.WINDOW)]
    total = np.zeros(3)
    for p in pieces:
        total += len(p) * np.array(plain_logits(net, p))
    e = np.exp(total / len(b) - (total / len(b)).max())
    return net.labels[int(e.argmax())], float(e.max() / e.sum())


def test_network_equals_plain_loops(make_docs):
    net, rng = tiny_net(), random.Random(2)
    texts = ["".join(rng.choice("abcdé ñ日xyz") for _ in range(n)) for n in (1, 2, 3, 4, 5, 60, 256, 257, 700)]
    for t in texts:
        x, size = G.windows(t.lower().encode())
        got = net.logits(x, size)
        for k in range(len(x)):
            assert got[k] == pytest.approx(plain_logits(net, bytes(x[k][:size[k]])), rel=1e-3, abs=1e-3)
    rows = [(i, t) for i, t in enumerate(texts) if any(c.isalpha() for c in t)]
    got = {r.doc_id: r for r in G.predict(make_docs(rows), net, ["doc_id"]).collect()}
    for i, t in rows:
        label, p = plain_prediction(net, t)
        assert got[i].lang_pred == label and got[i].score == pytest.approx(p, rel=1e-3, abs=1e-3)


def test_training_lowers_the_plain_loss():
    rng = random.Random(4)
    words = {"aa": "the and ing tion", "bb": "der und ung keit", "cc": "que los cion ado"}
    samples = [(" ".join(rng.choice(words[y].split()) for _ in range(30)).encode(), y) for y in words for _ in range(200)]
    loss = lambda net: np.mean([-math.log(max(1e-12, math.exp(z[net.labels.index(y)] - max(z))
                                              / sum(math.exp(v - max(z)) for v in z)))
                                for t, y in samples[::50] for z in [plain_logits(net, t[:G.WINDOW])]])
    before, after = loss(G.fit(samples, epochs=0)), loss(G.fit(samples))
    assert before > 0.5 and after < 0.1 * before


def plain_ranking(x, y, steps=4000):
    """Logistic loss on the feature differences of all pairs, plain descent."""
    s = np.clip((x - x.mean(0)) / (x.std(0) + 1e-6), -8, 8)
    diff = np.array([s[i] - s[j] for i in np.flatnonzero(y == 1) for j in np.flatnonzero(y == 0)])
    w = np.zeros(x.shape[1])
    for _ in range(steps):
        lose = 1 / (1 + np.exp(diff @ w))
        w += 0.1 * ((diff * lose[:, None]).mean(0) - Q.L2 * w)
    return s @ w


def test_ranker_equals_all_pairs():
    rng = np.random.default_rng(6)
    y = (np.arange(60) % 3 > 0).astype(int)
    x = rng.normal(0, 1, (60, len(Q.FEATURES))) + y[:, None] * np.linspace(0, 0.8, len(Q.FEATURES))
    model = Q.fit(x, y)
    strength = np.clip((x - model.mean) / model.scale, -8, 8) @ model.weight
    want = plain_ranking(x, y)
    assert np.corrcoef(strength, want)[0, 1] > 0.99
    # the threshold is the quantile of the strengths at the share of label 0
    assert (strength < model.shift).sum() == (y == 0).sum()
    assert (model.score(x) >= Q.CUT).sum() == (y == 1).sum()
    pairs = [(i, j) for i in np.flatnonzero(y == 1) for j in np.flatnonzero(y == 0)]
    assert np.mean([strength[i] > strength[j] for i, j in pairs]) == pytest.approx(
        np.mean([want[i] > want[j] for i, j in pairs]), abs=0.02)


def test_samples_do_not_depend_on_the_partitioning(spark, make_docs, monkeypatch):
    """A rerun learns from the same rows, also past the bound."""
    monkeypatch.setattr(Q, "MOST_LABELS", 10)
    rng = random.Random(8)
    rows = [(i % 40, " ".join(rng.choice(["alpha", "beta", "##"]) for _ in range(9))) for i in range(400)]
    labels = spark.createDataFrame([(i, i % 2) for i in range(40) for _ in range(9)], "doc_id long, quality int")
    got = [Q.sample(make_docs(rows).repartition(k), labels.repartition(k), "doc_id", "text", "quality") for k in (1, 5)]
    assert len(got[0][1]) == 80 and all((a == b).all() for a, b in zip(*got))


def uneven_rows(n=400, seed=11):
    """Overlapping labels, some rows far out, few of label 0."""
    rng = np.random.default_rng(seed)
    y = (np.arange(n) % 7 > 0).astype(int)
    x = rng.normal(0, 1, (n, len(Q.FEATURES))) * np.linspace(1, 5, len(Q.FEATURES)) + y[:, None] * np.linspace(0, 0.6, len(Q.FEATURES))
    x[:9] *= 30
    return x, y


def test_ranker_is_at_the_optimum_of_all_pairs():
    """The gradient of the loss over every pair, none left out, vanishes."""
    x, y = uneven_rows()
    model = Q.fit(x, y)
    s = np.clip((x - x.mean(0)) / (x.std(0) + 1e-6), -8, 8)
    diff = np.array([s[i] - s[j] for i in np.flatnonzero(y == 1) for j in np.flatnonzero(y == 0)])
    lose = 1 / (1 + np.exp(diff @ model.weight))
    assert np.abs((diff * lose[:, None]).mean(0) - Q.L2 * model.weight).max() < 1e-9
    order, k = np.sort(s @ model.weight), (y == 0).sum()
    assert model.shift == pytest.approx((order[k - 1] + order[k]) / 2, rel=1e-9)
    assert model.spread == pytest.approx((s @ model.weight).std() / 2, rel=1e-9)


def test_ranker_over_a_table_equals_the_one_in_memory(spark):
    x, y = uneven_rows()
    rows = spark.createDataFrame([(v.tolist(), int(k)) for v, k in zip(x, y)], "x array<double>, y int")
    want = Q.fit(x, y)
    for parts in (1, 7):
        got = Q.train(Q.summed_over(rows.repartition(parts)))
        assert np.allclose(got.weight, want.weight, rtol=1e-6, atol=1e-8)
        assert [got.shift, got.spread, got.prior] == pytest.approx([want.shift, want.spread, want.prior], rel=1e-6)


def test_every_label_row_trains(spark, make_docs, monkeypatch):
    """No bound on the labelled rows: a label row counts once per document row."""
    monkeypatch.setattr(Q, "MOST_LABELS", 3)
    docs = make_docs([(i % 50, f"alpha beta {i}") for i in range(200)])
    labels = spark.createDataFrame([(i, i % 2) for i in range(60) for _ in range(3)] + [(1, None), (None, 1), (2, 5)], "doc_id long, quality int")
    seen = []
    monkeypatch.setattr(Q, "train", lambda summed: seen.append(summed(lambda x, y: {0: np.array([len(y), y.sum()], float)})) or 0.5)
    assert Q.rank_quality(docs, labels).count() == 200
    folds = [i for i in range(50) if zlib.crc32(str(i).encode()) % 5]
    assert seen[0][0].tolist() == [12 * len(folds), 12 * sum(i % 2 for i in folds)]


def test_order_statistics():
    x = np.array([3.0, -0.0, 0.0, -2.5, 1e-300, 3.0, -1e300, 7.25, -2.5])[:, None]
    got = Q._order_statistics(lambda f: f(x, None), lambda v: v[:, 0], list(range(9)))
    assert got == sorted(x[:, 0])
