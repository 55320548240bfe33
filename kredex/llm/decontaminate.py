"""Benchmark decontamination with suffix arrays of the training text.

Each task cuts its documents into shards of bounded size and builds a word
suffix array per shard. The array is sparse: it leaves out suffixes whose first
two words start no test window, since no search could end in them. Every test
window (every suffix of a benchmark item, cut to the window length) is then
binary-searched, all at once, one word deeper per round. The intervals found
are the verbatim occurrences and their locations. The benchmark is the query
set: the driver reads it in blocks of bounded size and runs one pass per block.
``longest_matches`` extends each occurrence as far as item and document agree, and
returns the matches with their places.

Words: A-Z lower-cased, then runs of digits, letters a-z and non-ASCII
characters. A window is ``window`` consecutive words of an item; an item with
fewer words (but some) is one window.

Defined cases: null or empty texts have no words; repeated items and rows
count once each as items and rows; a null item id counts as the item '';
empty tables give no rows, or no hits; further columns are ignored.
"""

from __future__ import annotations

from collections.abc import Iterator

import numpy as np
from pyspark.sql import DataFrame
from pyspark.sql import functions as F

from .common import map_texts, stored

#: Fixed value: bytes that belong to words (lower-cased), all else separates.
WORD_BYTES = bytes(
    c + 32 if 0x41 <= c <= 0x5A
    else c if 0x30 <= c <= 0x39 or 0x61 <= c <= 0x7A or c >= 0x80
    else 0x20
    for c in range(256)
)
WINDOW = 10
#: Words of benchmark text searched per pass (the size bound of what a pass
#: ships to the tasks), and words of documents per suffix array.
BLOCK_WORDS = 2_000_000
SHARD_WORDS = 2_000_000


def words_of(text: bytes) -> list[bytes]:
    return text.translate(WORD_BYTES).split()


class Queries:
    """The distinct test windows of one benchmark block."""

    def __init__(self, items: list[tuple[str, list[bytes]]], window: int):
        self.window = window
        self.vocabulary: dict[bytes, int] = {}
        classes: dict[tuple[int, ...], set[str]] = {}
        for name, words in items:
            ids = [self.vocabulary.setdefault(w, len(self.vocabulary) + 1) for w in words]
            for i in range(max(1, len(ids) - window + 1) if ids else 0):
                classes.setdefault(tuple(ids[i:i + window]), set()).add(name)
        self.items = [frozenset(v) for v in classes.values()]
        self.length = np.array([len(k) for k in classes], np.int64)
        self.words = np.zeros((len(classes), window), np.int64)
        for row, k in zip(self.words, classes):
            row[:len(k)] = k
        one = self.length == 1
        self.single = np.unique(self.words[one, 0])
        self.pairs = np.unique(self._pair(self.words[~one, 0], self.words[~one, 1])) if window > 1 else self.single[:0]

    def _pair(self, a: np.ndarray, b: np.ndarray) -> np.ndarray:
        return a * (len(self.vocabulary) + 1) + b


def suffix_array(words: np.ndarray, queries: Queries) -> np.ndarray:
    """Starts of the shard's suffixes that can open a test window, sorted by
    their first ``window`` words. ``words`` ends with ``window`` zeros; 0 is
    any word outside the benchmark and any end of a document."""
    n = len(words) - queries.window
    at = np.flatnonzero(words[:n])
    keep = _member(queries._pair(words[at], words[at + 1]), queries.pairs)
    if len(queries.single):
        keep |= _member(words[at], queries.single)
    at = at[keep]
    return at[np.lexsort([words[at + d] for d in range(queries.window - 1, -1, -1)])]


def _member(values: np.ndarray, within: np.ndarray) -> np.ndarray:
    if not len(within):
        return np.zeros(len(values), bool)
    i = np.searchsorted(within, values)
    i[i == len(within)] = 0
    return within[i] == values


def search(array: np.ndarray, words: np.ndarray, queries: Queries) -> tuple[np.ndarray, np.ndarray]:
    """[lo, hi) of the suffix array per test window: binary search of every
    window at once, one word deeper per round."""
    q = len(queries.length)
    lo, hi = np.zeros(q, np.int64), np.full(q, len(array), np.int64)
    for depth in range(queries.window):
        live = np.flatnonzero((queries.length > depth) & (lo < hi))
        if not len(live):
            break
        want = queries.words[live, depth]
        lo[live], hi[live] = (
            _bound(array, words, depth, want, lo[live], hi[live], upper=False),
            _bound(array, words, depth, want, lo[live], hi[live], upper=True),
        )
    return lo, hi


def _bound(array, words, depth, want, lo, hi, upper):
    a, b = lo.copy(), hi.copy()
    while True:
        live = np.flatnonzero(a < b)
        if not len(live):
            return a
        mid = (a[live] + b[live]) >> 1
        seen = words[array[mid] + depth]
        right = seen <= want[live] if upper else seen < want[live]
        a[live[right]] = mid[right] + 1
        b[live[~right]] = mid[~right]


def shard_hits(texts: list[bytes], queries: Queries) -> Iterator[tuple[int, np.ndarray, set[str]]]:
    """Per text of one shard: number of words, hit flag per word, names of the
    items with an occurring window."""
    get, ids, starts = queries.vocabulary.get, [], [0]
    for t in texts:
        ids.append(np.fromiter((get(w, 0) for w in words_of(t)), np.int64))
        ids.append(np.zeros(1, np.int64))           # ends the document
        starts.append(starts[-1] + len(ids[-2]) + 1)
    words = np.concatenate([*ids, np.zeros(queries.window, np.int64)])
    array = suffix_array(words, queries)
    lo, hi = search(array, words, queries)
    found = np.flatnonzero(hi > lo)
    count = (hi - lo)[found]
    kind = np.repeat(found, count)
    at = array[np.repeat(lo[found] - np.cumsum(count) + count, count) + np.arange(count.sum())]
    edge = np.zeros(len(words) + 1, np.int64)
    np.add.at(edge, at, 1)
    np.add.at(edge, at + queries.length[kind], -1)
    hit = np.cumsum(edge) > 0
    starts = np.array(starts)
    doc = np.searchsorted(starts, at, side="right") - 1
    items: dict[int, set[str]] = {}
    for d, k in np.unique(np.stack([doc, kind], 1), axis=0).tolist():
        items.setdefault(d, set()).update(queries.items[k])
    for d in range(len(texts)):
        yield starts[d + 1] - starts[d] - 1, hit[starts[d]:starts[d + 1] - 1], items.get(d, set())


def _shards(texts: list[bytes], limit: int) -> Iterator[list[bytes]]:
    """Lists of texts of about ``limit`` words (a longer text is one shard)."""
    out, size = [], 0
    for t in texts:
        n = len(t) // 5
        if out and size + n > limit:
            yield out
            out, size = [], 0
        out.append(t)
        size += n
    if out:
        yield out


class Suffixes(Queries):
    """The test suffixes of one benchmark block: its windows, where in which
    item each stands, and the items' words."""

    def __init__(self, items: list[tuple[str, list[bytes]]], window: int):
        super().__init__(items, window)
        self.names = [name for name, _ in items]
        ids = [np.array([self.vocabulary[w] for w in words], np.int64) for _, words in items]
        self.item_start = np.cumsum([0, *[len(x) + 1 for x in ids]])
        self.text = np.concatenate([*[np.append(x, -1) for x in ids], np.full(1, -1, np.int64)])
        kinds = {tuple(row[:n]): k for k, (row, n) in enumerate(zip(self.words.tolist(), self.length.tolist()))}
        kind, place = [], []
        for x, at in zip(ids, self.item_start.tolist()):
            v = x.tolist()
            for i in range(max(1, len(v) - window + 1) if v else 0):
                kind.append(kinds[tuple(v[i:i + window])])
                place.append(at + i)
        order = np.argsort(np.array(kind, np.int64), kind="stable")
        self.place = np.array(place, np.int64)[order]
        self.first = np.searchsorted(np.array(kind, np.int64)[order], np.arange(len(self.length) + 1))


#: (test suffix, place) pairs extended at once.
PAIRS_AT_ONCE = 1 << 20


def shard_matches(texts: list[bytes], queries: Suffixes) -> Iterator[tuple[int, str, int, int, int]]:
    """The longest verbatim matches of one shard: (text, item, first word in the
    item, first word in the text, words). Every test suffix that occurs is
    extended from each of its places as far as item and text agree; a match that
    begins one word earlier is reported there."""
    get, ids, starts = queries.vocabulary.get, [], [0]
    for t in texts:
        ids += [np.fromiter((get(w, 0) for w in words_of(t)), np.int64), np.zeros(1, np.int64)]
        starts.append(starts[-1] + len(ids[-2]) + 1)
    words = np.concatenate([*ids, np.zeros(queries.window, np.int64)])
    array = suffix_array(words, queries)
    lo, hi = search(array, words, queries)
    starts = np.array(starts)
    before = np.concatenate([[-2], words])             # the word before a place in the text
    before[starts[1:]] = -2
    item_before = np.concatenate([[-3], queries.text])
    for k in np.flatnonzero(hi > lo).tolist():
        own = queries.place[queries.first[k]:queries.first[k + 1]]
        step = max(1, PAIRS_AT_ONCE // len(own))
        for a in range(int(lo[k]), int(hi[k]), step):
            at = array[a:min(a + step, int(hi[k]))]
            i, j = (x.ravel() for x in np.meshgrid(own, at, indexing="ij"))
            left = (item_before[i] != before[j]) | (before[j] == 0)
            i, j = i[left], j[left]
            size = np.full(len(i), int(queries.length[k]), np.int64)
            live = np.arange(len(i))
            while len(live):
                same = queries.text[i[live] + size[live]] == words[j[live] + size[live]]
                live = live[same]
                size[live] += 1
            item = np.searchsorted(queries.item_start, i, side="right") - 1
            doc = np.searchsorted(starts, j, side="right") - 1
            for d, m, x, y, n in zip(doc.tolist(), item.tolist(), (i - queries.item_start[item]).tolist(),
                                     (j - starts[doc]).tolist(), size.tolist()):
                yield d, queries.names[m], x, y, n


MATCH = "array<struct<item:string,item_start:long,start:long,length:long>>"


def longest_matches(docs: DataFrame, benchmark: DataFrame, keep: list[str], text: str = "text",
                    item_id: str = "item_id", item_text: str = "text", window: int = WINDOW,
                    block_words: int = BLOCK_WORDS) -> DataFrame:
    """``keep`` columns, item, item_start, start and length (in words) of every
    longest verbatim match of at least a window (a shorter item: of the whole
    item) between a document and a benchmark item. One pass per block."""

    def finder(queries: Suffixes):
        def make():
            def find(texts: list[bytes]) -> dict[str, list]:
                out: list[list] = []
                for part in _shards(texts, SHARD_WORDS):
                    got: list[list] = [[] for _ in part]
                    for d, name, x, y, n in shard_matches(part, queries):
                        got[d].append({"item": name, "item_start": x, "start": y, "length": n})
                    out += got
                return {"matches": out}
            return find
        return make

    passes = [map_texts(docs, text, keep, f"matches {MATCH}", finder(Suffixes(block, window)))
              for block in _blocks(benchmark, item_id, item_text, block_words)]
    if not passes:
        return docs.select(*keep, F.array().cast(MATCH).alias("m")).select(*keep, F.explode("m").alias("m")).select(*keep, "m.*")
    every = passes[0]
    for p in passes[1:]:
        every = every.unionByName(p)
    return every.select(*keep, F.explode("matches").alias("m")).select(*keep, "m.*")


def _blocks(benchmark: DataFrame, item_id: str, text: str, limit: int):
    """The items in lists of at most ``limit`` words, one at a time."""
    out, size = [], 0
    rows = benchmark.select(F.col(item_id).cast("string"), F.col(text).cast("binary"))
    for name, t in rows.toLocalIterator():
        words = words_of(bytes(t or b""))
        if not words:
            continue
        if out and size + len(words) > limit:
            yield out
            out, size = [], 0
        out.append((name or "", words))
        size += len(words)
    if out:
        yield out


def _finder(queries: Queries | None, spans: bool):
    def make():
        def find(texts: list[bytes]) -> dict[str, list]:
            out: dict[str, list] = {"n_words": [], "n_hit": [], "items": [], "spans": []}
            for part in _shards(texts, SHARD_WORDS):
                got = (shard_hits(part, queries) if queries else
                       ((len(words_of(t)), np.zeros(0, bool), set()) for t in part))
                for n, hit, items in got:
                    out["n_words"].append(int(n))
                    out["n_hit"].append(int(hit.sum()))
                    out["items"].append(sorted(items))
                    if spans:
                        e = np.flatnonzero(np.diff(np.concatenate([[0], hit.astype(np.int8), [0]])))
                        out["spans"].append([{"s": int(a), "e": int(b)} for a, b in zip(e[::2], e[1::2])])
                    else:
                        out["spans"].append([])
            return out

        return find

    return make


FOUND = "n_words long, n_hit long, items array<string>, spans array<struct<s:long,e:long>>"


def find_contamination(docs: DataFrame, benchmark: DataFrame, keep: list[str], text: str = "text",
                       item_id: str = "item_id", item_text: str = "text", window: int = WINDOW,
                       block_words: int = BLOCK_WORDS) -> DataFrame:
    """``keep`` columns of every document plus n_words, n_hit (words inside an
    occurring window) and the sorted names of the items that occur."""
    blocks = _blocks(benchmark, item_id, item_text, block_words)
    first, second = next(blocks, None), next(blocks, None)
    queries = Queries(first, window) if first else None
    if second is None:
        return map_texts(docs, text, keep, FOUND, _finder(queries, False)).drop("spans")
    # more blocks: a pass each over the texts; hits are united per text (its
    # digest is the key, so copies of a text bring their row once)
    source = docs.select(F.col(text).alias("text")).withColumn("key", F.sha2(F.col("text").cast("binary"), 256))
    passes = []
    for block in _chain([first, second], blocks):
        p = map_texts(source, "text", ["key"], FOUND, _finder(Queries(block, window), True))
        passes.append(stored(p.where("n_hit > 0").select("key", "items", "spans").dropDuplicates(["key"])))
    every = passes[0]
    for p in passes[1:]:
        every = every.unionByName(p)
    united = (every.groupBy("key")
              .agg(F.array_sort(F.flatten(F.collect_list("spans"))).alias("spans"),
                   F.array_sort(F.array_distinct(F.flatten(F.collect_list("items")))).alias("items"))
              .select("key", "items", _covered("spans").alias("n_hit")))
    counted = map_texts(docs.select(*keep, F.col(text).alias("__t"),
                                    F.sha2(F.col(text).cast("binary"), 256).alias("__key")),
                        "__t", [*keep, "__key"], FOUND, _finder(None, False)).select(*keep, "__key", "n_words")
    return (counted.join(stored(united), F.col("__key") == F.col("key"), "left")
            .select(*keep, "n_words", F.coalesce("n_hit", F.lit(0)).cast("long").alias("n_hit"),
                    F.coalesce("items", F.array().cast("array<string>")).alias("items")))


def _chain(head, rest):
    yield from head
    yield from rest


def _covered(spans: str):
    """Words covered by sorted [s, e) spans, overlaps counted once."""
    zero = F.struct(F.lit(0).cast("long").alias("n"), F.lit(0).cast("long").alias("end"))
    return F.aggregate(
        spans, zero,
        lambda acc, x: F.struct(
            (acc["n"] + F.greatest(F.lit(0).cast("long"), x["e"] - F.greatest(x["s"], acc["end"]))).alias("n"),
            F.greatest(acc["end"], x["e"]).alias("end")),
        lambda acc: acc["n"])


def decontamination(docs: DataFrame, benchmark: DataFrame, doc_id: str = "doc_id",
                    text: str = "text") -> DataFrame:
    """Digest of the contract: one row per document."""
    rows = docs.select(F.col(doc_id).alias("doc_id"), F.col(text).alias("text"))
    return find_contamination(rows, benchmark, ["doc_id"]).select(
        "doc_id", "n_words", "n_hit", F.size("items").cast("long").alias("n_items"),
        F.sha2(F.concat_ws(",", "items"), 256).alias("items_sha256"),
        (F.col("n_hit") > 0).alias("contaminated"))


def clean_documents(docs: DataFrame, benchmark: DataFrame, text: str = "text") -> DataFrame:
    """The documents no benchmark window occurs in, with all their columns."""
    cols = docs.columns
    held = docs.select(*[F.col(c).alias(f"c{i}") for i, c in enumerate(cols)])
    return (find_contamination(held, benchmark, held.columns, f"c{cols.index(text)}")
            .where("n_hit = 0").select(*[F.col(f"c{i}").alias(c) for i, c in enumerate(cols)]))

