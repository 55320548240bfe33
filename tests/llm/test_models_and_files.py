"""Language and quality models (held-out accuracy), BPE (against tiktoken),
WARC (round trip)."""
import gzip
import io
import random
import zlib

import numpy as np
import pytest
from pyspark.sql import functions as F

import brute
from kredex.llm import byte_bpe as B
from kredex.llm import lang_id as G
from kredex.llm import quality_rank as Q
from kredex.llm import warc as W

SF = "/root/testdata/sf0.01"


# ---- language

def test_language_held_out(spark):
    docs = spark.read.parquet(f"{SF}/documents.parquet")
    got = G.identify(docs).join(docs.select("doc_id", "lang"), "doc_id").where("held_out").collect()
    assert len(got) > 200
    assert np.mean([r.lang == r.lang_pred for r in got]) >= 0.97
    assert all(0 <= r.score <= 1 for r in got)


def test_language_edges(make_docs, edge_docs, no_docs):
    rows = [(i, "the cat and the dog are in the house" if i % 2 else "der hund und die katze sind im haus", "en" if i % 2 else "de")
            for i in range(60)] + [(90, None), (91, "12 34 !!"), (92, ""), (93, "the", None), (None, "und die")]
    got = {r.doc_id: r for r in G.identify(make_docs(rows, brute.CLASHES)).collect()}
    assert {got[i].lang_pred for i in (90, 91, 92)} == {"und"} and got[90].score == 0
    assert np.mean([got[i].lang_pred == ("en" if i % 2 else "de") for i in range(60)]) > 0.95
    assert len(G.identify(edge_docs).collect()) == len(brute.EDGES)
    assert G.identify(no_docs).collect() == []


def test_language_ignores_labels_of_the_held_out_fold(make_docs):
    rows = [(i, "aaa bbb" if i % 2 else "ccc ddd", "x" if i % 2 else "y") for i in range(40)]
    import zlib
    swapped = [(i, t, "swapped" if zlib.crc32(str(i).encode()) % 4 == 2 else y) for i, t, y in rows]
    a, b = ({r.doc_id: (r.lang_pred, r.score) for r in G.identify(make_docs(x)).collect()} for x in (rows, swapped))
    assert a == b


def test_every_language_is_learned(make_docs, monkeypatch):
    rng = random.Random(3)
    rows = []
    for k in range(46):
        letters = [chr(0x4E00 + 40 * k + j) for j in range(6)]      # an alphabet per language
        rows += [(100 * k + i, " ".join("".join(rng.choices(letters, k=4)) for _ in range(12)), f"l{k}")
                 for i in range(12 + (k < 3) * 20)]
    docs = make_docs(rows)
    train = F.crc32(F.col("doc_id").cast("string").cast("binary")) % 4 != 2
    sample = G.sample(docs, train, "doc_id", "text", "lang")
    assert {y for _, y in sample} == {f"l{k}" for k in range(46)}
    got = {r.doc_id: r.lang_pred for r in G.identify(docs).collect()}
    assert {got[i] for i, _, _ in rows} == {f"l{k}" for k in range(46)}
    # a smaller sample lowers the quota of all, down to the floor
    monkeypatch.setattr(G, "MOST_DOCUMENTS", 46 * 7)
    monkeypatch.setattr(G, "LEAST_PER_LANGUAGE", 5)
    few = [y for _, y in G.sample(docs, train, "doc_id", "text", "lang")]
    assert len(set(few)) == 46 and max(few.count(y) for y in set(few)) <= 7


# ---- quality

def test_quality_held_out(spark):
    docs, labels = (spark.read.parquet(f"{SF}/{t}.parquet") for t in ("documents", "labels"))
    got = Q.rank_quality(docs, labels).join(labels, "doc_id").collect()
    assert np.mean([r.predicted == r.quality for r in got]) >= 0.97
    held = [r for r in got if r.held_out]
    good, bad = ([r.score for r in held if r.quality == y] for y in (1, 0))
    assert good and bad and np.mean([g > b for g in good for b in bad]) >= 0.97
    assert all((r.score >= 0.3) == (r.predicted == 1) and 0 <= r.score <= 1 for r in got)


def test_quality_edges(spark, edge_docs, no_docs):
    labels = spark.createDataFrame([(1, 1, 0), (2, None, 0), (3, 1, 0), (None, 0, 0), (6, 0, 1), (6, 0, 1), (8, 0, 0), (9, 1, 0)],
                                   "doc_id long, quality int, toxic int").withColumn("x", F.lit(1))
    got = Q.rank_quality(edge_docs, labels).collect()
    assert len(got) == len(brute.EDGES) and all(0 <= r.score <= 1 for r in got)
    assert Q.rank_quality(no_docs, labels).collect() == []
    none = Q.rank_quality(edge_docs, labels.where("false")).collect()
    assert {r.score for r in none} == {0.5}


# ---- BPE

@pytest.fixture(scope="module")
def both():
    import public_tokenizers as P
    import tiktoken
    own = B.Codec.load(P.path("byte_bpe_50k.tiktoken"))
    return own, tiktoken.Encoding("own", pat_str=P.PATTERN, mergeable_ranks=own.ranks, special_tokens={})


def test_bpe_equals_the_library(both, monkeypatch):
    own, lib = both
    rng = random.Random(1)
    parts = ["a", "b", "s", "t", "re", "ve", "ll", "'", "'s", "'t", " ", "  ", "\n", "\t", "1", "23", "!", "é", "ß", "日本", "😀",
             " ", " ", "²", "Ⅷ", "\x00", "_", "-", "I'm", " 's", "ſ", "́"]
    texts = ["".join(rng.choice(parts) for _ in range(rng.randrange(60))) for _ in range(4000)]
    texts += ["a" * 3000, "xyz" * 900, " " * 900 + "x", "'s" * 500, "日本" * 500, "", "\n", "<|endoftext|>"]
    for part in (B.PART, 17):
        monkeypatch.setattr(B, "PART", part)
        few = texts if part > 100 else texts[::8] + texts[-8:]
        ids, offsets = own.encode([t.encode() for t in few])
        assert [np.frombuffer(x, "<u4").tolist() for x in ids] == [lib.encode_ordinary(t) for t in few]
        assert [own.decode(x) for x in ids] == [t.encode() for t in few]
        assert all(o[-1] == len(t.encode()) for o, t in zip(offsets, few))


def test_bpe_query(both, edge_docs, no_docs):
    _, lib = both
    got = sorted((str(r.doc_id), r.n_tokens, r.ids_sha256, r.decoded_sha256) for r in B.round_trip(edge_docs).collect())
    want = []
    for d, t in brute.EDGES:
        ids = lib.encode_ordinary(t or "")
        want.append((str(d), len(ids), brute.sha(np.array(ids, "<u4").tobytes()), brute.sha(t or "")))
    assert got == sorted(want)
    assert B.round_trip(no_docs).collect() == []
    coded = B.encode(edge_docs, ["doc_id"])
    back = sorted((str(r.doc_id), bytes(r.decoded)) for r in B.decode(coded, ["doc_id"]).collect())
    assert back == sorted((str(d), (t or "").encode()) for d, t in brute.EDGES)


# ---- WARC

def pages(spark, rows):
    df = spark.createDataFrame(rows, "page_id long, url string, html string").repartition(3)
    return df.withColumn("digest", F.lit(1)).withColumn("payload", F.lit(1)).withColumn("name", F.lit(1))


def test_warc_round_trip(spark, tmp_path, monkeypatch):
    big = "<p>é" + "x" * 200
    rows = [(5, "http://a/1", big), (3, "http://a/2\r\nX: y", big), (9, None, big), (1, "u", "small"), (2, "u", "small"),
            (4, "u", None), (6, "u", ""), (None, "u", big), (3, "u", big), (7, "u", "\r\n\r\nWARC/1.1\r\n\r\n" * 20),
            (8, "u", "y" * 3_000_000), (10, "u", "x" * 99), (11, "u", "x" * 99), (12, "u", "x" * 100), (13, "u", "x" * 100)]
    got = W.archive_round_trip(pages(spark, rows), folder=str(tmp_path / "w")).collect()
    first = {big: 3, "x" * 100: 12}
    want = []
    for i, _, h in rows:
        f = first.get(h or "")
        again = f is not None and i != f
        want.append((str(i), len((h or "").encode()), brute.sha(h or ""), "revisit" if again else "response",
                     str(f) if again else "None"))
    assert sorted((str(r[0]), r[1], r[2], r[3], str(r[4])) for r in got) == sorted(want)
    # the archives are sound gzip, and every member starts at an indexed offset
    files = list((tmp_path / "w" / "records").glob("*.warc.gz"))
    assert files and not list((tmp_path / "w").rglob("*.open"))
    records = 0
    for f in files:
        raw = f.read_bytes()
        for line in (f.parent / (f.name + ".idx")).read_text().splitlines():
            o, n, kind, rid = line.split(" ")
            head = gzip.decompress(raw[int(o):int(o) + int(n)]).split(b"\r\n\r\n")[0].decode()
            assert head.startswith("WARC/1.1") and f"WARC-Record-ID: {rid}" in head and kind in head
            records += 1
    assert records == len(rows)
    for f in (tmp_path / "w" / "monolithic").glob("*.warc.gz"):
        raw = f.read_bytes()
        import zlib
        d = zlib.decompressobj(31)
        d.decompress(raw)
        assert d.eof and not d.unused_data       # one member


def test_warc_reading_is_linear_and_bounded():
    """Many small records in one archive: work in proportion to its size. A
    payload that inflates a thousandfold: a few MB of buffer."""
    import hashlib
    import time

    def archive(n):
        gz = zlib.compressobj(4, zlib.DEFLATED, 31)
        parts = []
        for i in range(n):
            p = b"%d " % i * 90
            parts.append(gz.compress(W.record(i, f"http://x/{i}", p, hashlib.sha256(p).hexdigest(), "response", None)))
        return b"".join([*parts, gz.flush()])

    def read(data):
        began, s, n = time.process_time(), W._Inflated(io.BytesIO(data)), 0
        while (h := s.until(b"\r\n\r\n")) is not None:
            n += bool(sum(map(len, s.exactly(int(W.headers(h)["Content-Length"]) + 4))))
        assert s.largest < 3 << 20
        return n, time.process_time() - began

    small, large = read(archive(5_000)), read(archive(50_000))
    assert (small[0], large[0]) == (5_000, 50_000)
    assert large[1] < 30 * max(small[1], 0.05)          # ten times the records; 100 times the work if quadratic
    gz = zlib.compressobj(9, zlib.DEFLATED, 31)
    data = gz.compress(W.record(1, None, b"a" * 100_000_000, "x", "response", None)) + gz.flush()
    assert len(data) < 200_000 and read(data)[0] == 1


def test_warc_empty(spark, tmp_path):
    none = pages(spark, [(1, "u", "x")]).where("page_id = 2")
    assert W.archive_round_trip(none, folder=str(tmp_path / "w")).collect() == []


def test_warc_broken_archive():
    import io
    with pytest.raises(ValueError):
        list(W._Inflated(io.BytesIO(gzip.compress(b"abc"))).exactly(5))
