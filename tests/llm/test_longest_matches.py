"""Longest verbatim matches against all diagonals."""
import random
import re

import brute
from kredex.llm import decontaminate as D


def plain(text, items, window):
    w = re.findall(brute.BENCH_WORD, brute.lower(text))
    out = []
    for name, t in items:
        v = re.findall(brute.BENCH_WORD, brute.lower(t))
        least = min(window, len(v))
        for i in range(len(v)):
            for j in range(len(w)):
                if v[i] == w[j] and not (i and j and v[i - 1] == w[j - 1]):
                    n = 0
                    while i + n < len(v) and j + n < len(w) and v[i + n] == w[j + n]:
                        n += 1
                    if n >= least:
                        out.append((name or "", i, j, n))
    return sorted(out)


def corpus(seed):
    rng = random.Random(seed)
    words = [f"w{i}" for i in range(40)]
    items = [(f"i{k}", " ".join(rng.choice(words) for _ in range(rng.choice([2, 5, 12, 30])))) for k in range(8)]
    items += [("same", "x x x x x x"), ("i0", "other words of i0"), (None, "no name here"), ("none", None), ("marks", "...")]
    texts = []
    for _ in range(40):
        t = [rng.choice([*words, "out", "side"]) for _ in range(rng.randrange(60))]
        name, item = rng.choice(items)
        v = (item or "").split()
        a = rng.randrange(len(v) + 1)
        at = rng.randrange(len(t) + 1)
        t[at:at] = v[a:a + rng.randrange(1, 31)]
        texts.append(" ".join(t))
    return texts + ["x " * 9, "", "X, x; x x x x x no name HERE"], items


def found(texts, items, window):
    q = D.Suffixes([(n or "", D.words_of((t or "").encode())) for n, t in items if D.words_of((t or "").encode())], window)
    out = [[] for _ in texts]
    for d, *m in D.shard_matches([t.encode() for t in texts], q):
        out[d].append(tuple(m))
    return [sorted(x) for x in out]


def test_equals_all_diagonals(monkeypatch):
    for seed in range(12):
        texts, items = corpus(seed)
        for window, pairs in ((4, 1 << 20), (6, 3), (1, 1 << 20)):
            monkeypatch.setattr(D, "PAIRS_AT_ONCE", pairs)
            want = [plain(t, items, window) for t in texts]
            assert found(texts, items, window) == want, (seed, window)
            assert window > 4 or any(want)


def test_places_in_documents(spark, make_docs, no_docs):
    texts, items = corpus(3)
    bench = spark.createDataFrame(items, "item_id string, text string")
    docs = make_docs([*enumerate(texts), (None, texts[0]), (7, None)], brute.CLASHES)
    want = sorted(((str(d), *m) for d, t in [*enumerate(texts), (None, texts[0])] for m in plain(t, items, 4)))
    for block in (10 ** 6, 20):                      # one block, many
        got = D.longest_matches(docs, bench, ["doc_id"], window=4, block_words=block).collect()
        assert sorted((str(r.doc_id), r.item, r.item_start, r.start, r.length) for r in got) == want
    assert D.longest_matches(no_docs, bench, ["doc_id"]).collect() == []
    assert D.longest_matches(docs, bench.where("false"), ["doc_id"]).collect() == []
