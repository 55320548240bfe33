"""Plain single-process versions of the operators, for small inputs."""
import hashlib
import re

# Column names the operators use inside, and documents at the edges.
CLASHES = ("n_words", "key", "digest", "node", "label", "kept", "host", "c0", "bucket", "base", "items", "spans", "w", "p")
EDGES = [(1, None), (2, ""), (3, " \n\t "), (None, "one two three"), (5, "one two three"), (5, "one two three"),
         (6, "ünï ćödé 日本語 \U0001F600 text here"), (7, "word " * 30000), (8, "a" * 3000), (9, "x")]

ASCII_SPACE = "[^\x20\x09-\x0d]+"


def words(text):
    return re.findall(ASCII_SPACE, text or "")


def lower(text):
    return re.sub("[A-Z]", lambda m: m[0].lower(), text or "")


def near_dups(rows):
    sets, group = near_groups(rows)
    least = {}
    for i, (d, _) in enumerate(rows):
        if d is not None and sets[i]:
            least[group[i]] = min(d, least.get(group[i], d))
    out = set()
    for i, (d, _) in enumerate(rows):
        c = least.get(group[i]) if sets[i] else d
        out.add((d, len(sets[i]), c, d == c))
    return out


def near_groups(rows):
    """Shingle sets and the group of each row."""
    sets = []
    for _, t in rows:
        w = words(lower(t))
        sets.append(frozenset(zip(w, w[1:])) if len(w) > 1 else frozenset([tuple(w)]) if w else frozenset())
    group = list(range(len(rows)))

    def find(x):
        while group[x] != x:
            x = group[x]
        return x

    for i, a in enumerate(sets):
        for j in range(i):
            if a and sets[j] and 100 * len(a & sets[j]) >= 80 * len(a | sets[j]):
                group[find(i)] = find(j)
    return sets, [find(i) for i in range(len(rows))]


def sha(text):
    return hashlib.sha256(text if isinstance(text, bytes) else text.encode()).hexdigest()


def quality(text):
    """(n_words, word_chars, n_symbols, n_dup_lines, n_repeat_words, base_failed)"""
    t = text or ""
    w = words(t)
    lines = [x for x in t.split("\n") if words(x)]
    wins = [tuple(w[i:i + 5]) for i in range(len(w) - 4)]
    count = {}
    for x in wins:
        count[x] = count.get(x, 0) + 1
    hit = {j for i, x in enumerate(wins) if count[x] > 1 for j in range(i, i + 5)}
    return (len(w), sum(map(len, w)), sum(t.count(c) for c in "#*$%&|<>"), len(lines) - len(set(lines)), len(hit),
            len(w) < 10 or 100 * len(hit) > 20 * len(w))


BENCH_WORD = "[^\x00-\x2f\x3a-\x60\x7b-\x7f]+"


def contamination(text, items):
    """(n_words, n_hit, sorted names of the items that occur)"""
    w = re.findall(BENCH_WORD, lower(text))
    hit, names = set(), set()
    for name, t in items:
        v = re.findall(BENCH_WORD, lower(t))
        n = min(10, len(v))
        for i in range(max(0, len(v) - 9) or (1 if v else 0)):
            for j in range(len(w) - n + 1):
                if w[j:j + n] == v[i:i + n]:
                    hit |= set(range(j, j + n))
                    names.add("" if name is None else str(name))
    return len(w), len(hit), sorted(names)


def repeated_bytes(texts, length):
    """(n_bytes, n_removed, n_spans, kept_sha256) per text"""
    raw = [(t or "").encode() for t in texts]
    count = {}
    for b in raw:
        for i in range(len(b) - length + 1):
            count[b[i:i + length]] = count.get(b[i:i + length], 0) + 1
    out = []
    for b in raw:
        gone = bytearray(len(b))
        for i in range(len(b) - length + 1):
            if count[b[i:i + length]] > 1:
                gone[i:i + length] = b"\1" * length
        runs = sum(1 for i, x in enumerate(gone) if x and (i == 0 or not gone[i - 1]))
        out.append((len(b), sum(gone), runs, sha(bytes(x for x, g in zip(b, gone) if not g))))
    return out


SECRET_KINDS = ("assign", "access", "hex", "markov")


def base_spans(text):
    t = text or ""
    keyword = "|".join("".join(f"[{c.upper()}{c}]" if c.isalpha() else c for c in k)
                       for k in ("password", "passwd", "secret", "token", "api_?key"))
    assign = re.compile(f"({keyword})" + r"""["']?\x20*[:=]\x20*["']?([A-Za-z0-9+/_.=-]+)""")
    out = [(m.start(), 0, m.end()) for m in assign.finditer(t) if len(m[2]) >= 6]
    out += [(m.start(), 1, m.end()) for m in re.finditer("AKIA[A-Z0-9]+", t) if len(m[0]) >= 20]
    out += [(m.start(), 2, m.end()) for m in re.finditer("[0-9a-f]+", t) if len(m[0]) >= 24]
    return sorted(out)


def all_spans(text, model, alphabet, threshold):
    t, base = text or "", base_spans(text)
    out = list(base)
    free = list(t)
    for a, _, b in base:
        free[a:b] = " " * (b - a)
    for m in re.finditer("[A-Za-z0-9+/_-]{20,}", "".join(free)):
        if ratio(m[0], model, alphabet) >= threshold * (len(m[0]) - 1):
            out.append((m.start(), 3, m.end()))
    return sorted(out)


def ratio(token, model, alphabet):
    return sum(model[alphabet.index(a) * len(alphabet) + alphabet.index(b)] for a, b in zip(token, token[1:]))


def masked(text, model, alphabet, threshold):
    """Secrets replaced kind by kind, each in what the kind before left."""
    if text is None:
        return None
    keyword = "|".join("".join(f"[{c.upper()}{c}]" if c.isalpha() else c for c in k)
                       for k in ("password", "passwd", "secret", "token", "api_?key"))
    t = re.sub(f"({keyword})" + r"""["']?\x20*[:=]\x20*["']?([A-Za-z0-9+/_.=-]+)""",
               lambda m: "[SECRET]" if len(m[2]) >= 6 else m[0], text)
    t = re.sub("AKIA[A-Z0-9]{16,}", "[SECRET]", t)
    t = re.sub("[0-9a-f]{24,}", "[SECRET]", t)
    return re.sub("[A-Za-z0-9+/_-]{20,}", lambda m: "[SECRET]" if ratio(m[0], model, alphabet)
                  >= threshold * (len(m[0]) - 1) else m[0], t)


def joined(spans):
    return ",".join(f"{SECRET_KINDS[k]}:{a}:{b}" for a, k, b in spans)
