"""Byte-level BPE encoding and decoding.

Pre-tokenisation uses no regular expression. Each code point has a class
(letter, number, space, other white space, apostrophe, other), refined by what
follows it. A small automaton says where tokens start. Its transition functions
are composed as elements of a finite monoid (a multiplication table), and a
blocked scan over the classes gives the state before every character, so the
work is a few array look-ups per character. The slices between token starts are
merged by rank, with a bounded cache of finished slices. The byte offsets of
the slices are kept, and ids decode to bytes through the rank table.

Very long texts are scanned in parts: the state is carried over, and the
classes look three characters ahead. A slice of many bytes merges through a
heap, in n log n.

Defined cases: null text is empty (no ids); an empty table gives no rows;
repeated rows, null ids and other columns have no effect.
"""

from __future__ import annotations

import base64
import hashlib
import heapq
import sys
import unicodedata

import numpy as np
from pyspark.sql import DataFrame
from pyspark.sql import functions as F

from .common import map_texts

# Fixed values of the pre-token pattern: the white space of \s, and the
# contractions by what follows the apostrophe.
WHITE_SPACE = [*range(0x09, 0x0E), 0x20, 0x85, 0xA0, 0x1680, *range(0x2000, 0x200B),
               0x2028, 0x2029, 0x202F, 0x205F, 0x3000]
SHORT_ENDINGS = "stmd"
LONG_ENDINGS = ("re", "ve", "ll")

# Classes. PREFIX: a space before a non-space. LONE: other white space before
# a non-space. RUN: white space before white space or the end. SHORT, LONG: an
# apostrophe that opens a contraction of one or two letters if a token starts
# there.
LETTER, NUMBER, OTHER, PREFIX, LONE, RUN, SHORT, LONG, END = range(9)
# States: what the last character left open. ONE, TWO: letters of a contraction
# still to come.
FRESH, IN_LETTERS, IN_NUMBERS, IN_OTHERS, AFTER_PREFIX, IN_SPACES, ONE, TWO = range(8)


def _step(state: int, kind: int) -> tuple[int, bool]:
    """(next state, whether a token starts at this character)."""
    if kind == END:
        return FRESH, True
    if state == TWO:
        return ONE, False
    if state == ONE:
        return FRESH, False
    if kind in (PREFIX, LONE):
        return (AFTER_PREFIX if kind == PREFIX else FRESH), True
    if kind == RUN:
        return IN_SPACES, state != IN_SPACES
    joined = {LETTER: IN_LETTERS, NUMBER: IN_NUMBERS}.get(kind, IN_OTHERS)
    if state in (joined, AFTER_PREFIX):
        return joined, False
    if kind in (SHORT, LONG):
        return (ONE if kind == SHORT else TWO), True
    return joined, True


def _monoid() -> tuple[np.ndarray, np.ndarray, np.ndarray]:
    """(class -> element, multiplication table, element x state -> state)."""
    gens = [tuple(_step(s, k)[0] for s in range(8)) for k in range(9)]
    elements = {tuple(range(8)): 0}
    todo = list(elements)
    while todo:
        e = todo.pop()
        for g in gens:
            x = tuple(g[s] for s in e)
            if x not in elements:
                elements[x] = len(elements)
                todo.append(x)
    every = list(elements)
    table = [[elements[tuple(b[s] for s in a)] for b in every] for a in every]
    return (np.array([elements[g] for g in gens], np.int16), np.array(table, np.int16), np.array(every, np.int8))


ELEMENT, TIMES, APPLY = _monoid()
STARTS = np.array([[_step(s, k)[1] for k in range(9)] for s in range(8)])
SCAN = 64
#: Code points scanned at once.
PART = 1 << 20


def _base_classes() -> np.ndarray:
    """Class by code point, white space as RUN."""
    out = np.full(sys.maxunicode + 1, OTHER, np.uint8)
    for c in range(sys.maxunicode + 1):
        general = unicodedata.category(chr(c))[0]
        if general == "L":
            out[c] = LETTER
        elif general == "N":
            out[c] = NUMBER
    out[WHITE_SPACE] = RUN
    return out


def classes(points: np.ndarray, ends: np.ndarray, base: np.ndarray) -> np.ndarray:
    """Classes of code points. ``ends``: indices of the separators between
    texts; they, and the end of the array, end a text."""
    kind = base[points]
    kind[ends] = END
    follows = np.concatenate([kind[1:], [END]])
    last = (kind == RUN) & (follows != RUN) & (follows != END)
    kind[last] = np.where(points[last] == 0x20, PREFIX, LONE)
    quote = np.flatnonzero(points == 0x27)
    if len(quote):
        ahead = np.concatenate([points, [0, 0]])
        a, b = ahead[quote + 1], ahead[quote + 2]
        kind[quote[np.isin(a, [ord(c) for c in SHORT_ENDINGS])]] = SHORT
        for x, y in LONG_ENDINGS:
            kind[quote[(a == ord(x)) & (b == ord(y))]] = LONG
    return kind


def scan(kind: np.ndarray, state: int = FRESH) -> tuple[np.ndarray, int]:
    """The automaton's state before every class, and after the last: products
    of the transition functions within rows of SCAN, the rows' products scanned
    likewise, then both applied."""
    n = len(kind)
    e = ELEMENT[kind]
    if n <= SCAN:
        before, out = np.empty(n, np.int8), state
        for i, x in enumerate(e.tolist()):
            before[i] = out
            out = int(APPLY[x, out])
        return before, out
    rows = -(-n // SCAN)
    grid = np.zeros(rows * SCAN, np.int16)          # 0 is the identity
    grid[:n] = e
    grid = np.ascontiguousarray(grid.reshape(rows, SCAN).T)
    prefix = np.empty_like(grid)
    acc = np.zeros(rows, np.int16)
    for j in range(SCAN):
        prefix[j] = acc
        acc = TIMES[acc, grid[j]]
    entry = np.empty(rows, np.int8)
    carry = _scan_elements(acc, state, entry)
    return APPLY[prefix, entry].T.ravel()[:n], carry


def _scan_elements(e: np.ndarray, state: int, entry: np.ndarray) -> int:
    if len(e) <= SCAN:
        for i, x in enumerate(e.tolist()):
            entry[i] = state
            state = int(APPLY[x, state])
        return state
    rows = -(-len(e) // SCAN)
    grid = np.zeros(rows * SCAN, np.int16)
    grid[:len(e)] = e
    grid = np.ascontiguousarray(grid.reshape(rows, SCAN).T)
    prefix = np.empty_like(grid)
    acc = np.zeros(rows, np.int16)
    for j in range(SCAN):
        prefix[j] = acc
        acc = TIMES[acc, grid[j]]
    inner = np.empty(rows, np.int8)
    state = _scan_elements(acc, state, inner)
    entry[:] = APPLY[prefix, inner].T.ravel()[:len(e)]
    return state


class _Cache(dict):
    """Ids of finished slices; a missing short slice is merged and kept."""

    def __init__(self, merge):
        super().__init__()
        self.merge = merge

    def __missing__(self, piece: bytes) -> bytes:
        ids = np.array(self.merge(piece), "<u4").tobytes()
        if len(piece) <= 64:
            self[piece] = ids
        return ids


class Codec:
    """Encoder and decoder for one rank table (``ranks``: bytes to id)."""

    CACHE = 150_000

    def __init__(self, ranks: dict[bytes, int]):
        self.ranks = ranks
        self.tokens = {i: b for b, i in ranks.items()}
        self.cache = _Cache(self._merge)
        self.base = _base_classes()

    @classmethod
    def load(cls, path: str) -> Codec:
        """Ranks from a file with a base64 token and its rank per line."""
        with open(path, "rb") as f:
            return cls({base64.b64decode(t): int(r) for t, r in map(bytes.split, f)})

    def starts(self, texts: list[bytes]) -> list[np.ndarray]:
        """Per text: byte offsets at which pre-tokens start, then its length.
        The texts are scanned as one, with a separator after each."""
        size = np.array([len(t) for t in texts], np.int64) + 1
        joined = (b"\0".join([*texts, b""])).decode()
        bounds = np.cumsum(size) - 1                # byte offsets of the separators
        out, state, at = [], FRESH, 0
        for i in range(0, len(joined), PART):
            points = np.frombuffer(joined[i:i + PART + 3].encode("utf-32-le"), np.uint32)
            width = 1 + (points > 0x7F).astype(np.int64) + (points > 0x7FF) + (points > 0xFFFF)
            offset = np.cumsum(width) - width + at
            a, b = np.searchsorted(bounds, [offset[0], offset[-1] + 1])
            kind = classes(points, np.searchsorted(offset, bounds[a:b]), self.base)[:PART]
            before, state = scan(kind, state)
            offset = offset[:PART]
            out.append(offset[STARTS[before, kind]])
            at = int(offset[-1] + width[len(offset) - 1])
        every = np.concatenate(out) if out else np.zeros(0, np.int64)
        cuts = np.searchsorted(every, bounds)       # every separator is a start
        first = np.concatenate([[0], cuts[:-1] + 1])
        return [every[x:y + 1] - (e - n + 1) for x, y, e, n in zip(first, cuts, bounds, size)]

    def _merge(self, piece: bytes) -> list[int]:
        if piece in self.ranks:
            return [self.ranks[piece]]
        if len(piece) > 256:
            return self._merge_long(piece)
        get, none = self.ranks.get, len(self.ranks) + (1 << 32)
        at = list(range(len(piece) + 1))
        rank = [get(piece[i:i + 2], none) for i in range(len(piece) - 1)]
        while rank:
            best = min(rank)
            if best == none:
                break
            i = rank.index(best)
            del at[i + 1], rank[i]
            if i < len(rank):
                rank[i] = get(piece[at[i]:at[i + 2]], none)
            if i:
                rank[i - 1] = get(piece[at[i - 1]:at[i + 1]], none)
        return [self.ranks[piece[a:b]] for a, b in zip(at, at[1:])]

    def _merge_long(self, piece: bytes) -> list[int]:
        """The same merges (lowest rank, leftmost first) by a heap over a
        linked list."""
        n, get = len(piece), self.ranks.get
        end = list(range(1, n + 1))
        prev = list(range(-1, n - 1))
        alive = bytearray([1]) * n
        heap = [(r, i, i + 2) for i in range(n - 1) if (r := get(piece[i:i + 2])) is not None]
        heapq.heapify(heap)
        while heap:
            _, i, stop = heapq.heappop(heap)
            j = end[i]
            if not alive[i] or j >= n or end[j] != stop:
                continue
            alive[j] = 0
            end[i] = stop
            if stop < n:
                prev[stop] = i
                if (r := get(piece[i:end[stop]])) is not None:
                    heapq.heappush(heap, (r, i, end[stop]))
            p = prev[i]
            if p >= 0 and (r := get(piece[p:stop])) is not None:
                heapq.heappush(heap, (r, p, stop))
        return [self.ranks[piece[i:end[i]]] for i in range(n) if alive[i]]

    def encode(self, texts: list[bytes]) -> tuple[list[bytes], list[np.ndarray]]:
        """Per text: its ids as little-endian unsigned 32-bit integers, and the
        byte offsets of its pre-tokens."""
        offsets = self.starts(texts)
        if len(self.cache) > self.CACHE:
            self.cache.clear()
        ids = []
        for t, o in zip(texts, offsets):
            at = o.tolist()
            ids.append(b"".join([self.cache[t[a:b]] for a, b in zip(at, at[1:])]))
        return ids, offsets

    def decode(self, ids: bytes) -> bytes:
        return b"".join(map(self.tokens.__getitem__, np.frombuffer(ids, "<u4").tolist()))


_LOADED: dict[str, Codec] = {}


def codec(path: str) -> Codec:
    """The codec of a rank file, loaded once per worker process."""
    if path not in _LOADED:
        _LOADED[path] = Codec.load(path)
    return _LOADED[path]


def _path(path: str | None) -> str:
    if path is None:
        import public_tokenizers
        path = public_tokenizers.path("byte_bpe_50k.tiktoken")
    return path


def encode(docs: DataFrame, keep: list[str], text: str = "text", path: str | None = None) -> DataFrame:
    """``keep`` columns, ``ids`` array<int> and the byte ``offsets`` of the
    pre-tokens (their starts, then the length) of every text."""
    path = _path(path)

    def make():
        own = codec(path)

        def run(texts: list[bytes]) -> dict[str, list]:
            ids, offsets = own.encode(texts)
            return {"ids": [np.frombuffer(x, "<u4").astype(np.int32) for x in ids], "offsets": offsets}

        return run

    return map_texts(docs, text, keep, "ids array<int>, offsets array<long>", make)


def decode(encoded: DataFrame, keep: list[str], ids: str = "ids", path: str | None = None) -> DataFrame:
    """``keep`` columns and the decoded bytes of an ``ids`` column."""
    path = _path(path)
    import pyarrow as pa
    rows = encoded.select(*keep, F.col(ids).cast("array<int>").alias("ids"))
    from pyspark.sql import types as T
    schema = T.StructType([*rows.drop("ids").schema.fields, T.StructField("decoded", T.BinaryType())])

    def run(batches):
        own = codec(path)
        for b in batches:
            out = [own.decode(np.array(x.as_py() or [], "<u4").tobytes()) for x in b.column(b.num_columns - 1)]
            yield pa.RecordBatch.from_arrays([*b.columns[:-1], pa.array(out, pa.binary())], names=schema.names)

    return rows.mapInArrow(run, schema)


def round_trip(docs: DataFrame, doc_id: str = "doc_id", text: str = "text", path: str | None = None) -> DataFrame:
    """Per document: n_tokens, digest of the ids, digest of what they decode to."""
    path = _path(path)

    def make():
        own = codec(path)

        def run(texts: list[bytes]) -> dict[str, list]:
            ids, _ = own.encode(texts)
            return {"n_tokens": [len(x) // 4 for x in ids],
                    "ids_sha256": [hashlib.sha256(x).hexdigest() for x in ids],
                    "decoded_sha256": [hashlib.sha256(own.decode(x)).hexdigest() for x in ids]}

        return run

    rows = docs.select(F.col(doc_id).alias("doc_id"), F.col(text).alias("text"))
    return map_texts(rows, "text", ["doc_id"], "n_tokens long, ids_sha256 string, decoded_sha256 string", make)
