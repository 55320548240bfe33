"""Registered queries of this package and their DuckDB equivalents.

Each ``opN_<name>`` runs its operator with production parameters over the
whole of its table. Queries without SQL here are tested against a brute-force
version, a round trip or held-out accuracy in ``tests/llm``.
"""

from __future__ import annotations

from . import (byte_bpe, decontaminate, host_rules, importance, lang_id, licenses, near_dups, quality_rank, secrets,
               suffix_dedup, toxicity, vector_codes, warc)
from .common import table


def op1_byte_cnn_language(spark, sf_dir):
    return lang_id.identify(table(spark, sf_dir, "documents"))


def op2_host_quality_rules(spark, sf_dir):
    return host_rules.quality_rules(table(spark, sf_dir, "documents"))


OP2_SQL = r"""
WITH d AS (
  SELECT row_number() OVER () AS rid, doc_id, source,
         regexp_extract_all(coalesce(text, ''), '[^\x20\x09-\x0D]+') AS ws,
         coalesce(text, '') AS t,
         list_filter(string_split(coalesce(text, ''), chr(10)),
                     lambda x: regexp_matches(x, '[^\x20\x09-\x0D]')) AS ls
  FROM documents
), w AS (
  SELECT rid, i, list_slice(ws, i, i + 4) AS win
  FROM (SELECT rid, ws, unnest(range(1, len(ws) - 3)) AS i FROM d WHERE len(ws) >= 5)
), again AS (
  SELECT rid, win FROM w GROUP BY rid, win HAVING count(*) > 1
), hit AS (
  SELECT rid, count(DISTINCT p) AS n
  FROM (SELECT w.rid, unnest(range(w.i, w.i + 5)) AS p FROM w JOIN again USING (rid, win))
  GROUP BY rid
), base AS (
  SELECT d.rid, doc_id, source, len(ws)::BIGINT AS n_words,
         length(regexp_replace(t, '[\x20\x09-\x0D]', '', 'g'))::BIGINT AS word_chars,
         (length(t) - length(regexp_replace(t, '[#*$%&|<>]', '', 'g')))::BIGINT AS n_symbols,
         (len(ls) - len(list_distinct(ls)))::BIGINT AS n_dup_lines,
         coalesce(hit.n, 0)::BIGINT AS n_repeat_words
  FROM d LEFT JOIN hit ON d.rid = hit.rid
), judged AS (
  SELECT *, (n_words < 10 OR 100 * n_repeat_words > 20 * n_words) AS base_failed FROM base
), hosts AS (
  SELECT source, count(*) AS n, sum(base_failed::INT) AS f FROM judged GROUP BY source
), moments AS (
  SELECT avg(f / n) AS m, var_samp(f / n) AS v, avg(1.0::DOUBLE / n) AS inv FROM hosts
), weight AS (
  SELECT m, CASE WHEN m > 0 AND m < 1 AND v > 0
                 THEN greatest(m * (1 - m) / greatest(v - m * (1 - m) * inv, v * 0.01) - 1, 0.001) END AS k
  FROM moments
), bad AS (
  SELECT source FROM hosts, weight
  WHERE (f + coalesce(m * k, 1)) / (n + coalesce(k, 2)) >= 0.5
)
SELECT doc_id, n_words, word_chars, n_symbols, n_dup_lines, n_repeat_words, base_failed,
       EXISTS (SELECT 1 FROM bad WHERE bad.source IS NOT DISTINCT FROM judged.source) AS host_failed,
       NOT base_failed AND NOT EXISTS
         (SELECT 1 FROM bad WHERE bad.source IS NOT DISTINCT FROM judged.source) AS kept
FROM judged
"""


def op3_license_scans(spark, sf_dir):
    return licenses.scan_licenses(table(spark, sf_dir, "documents"))


def _op3_sql() -> str:
    """All windows of every text against every template."""
    import re
    rows = []
    for name, text in sorted(licenses.TEMPLATES.items()):
        w = re.findall(r"[a-z0-9]+", text.lower())
        parts = list(dict.fromkeys(" ".join(w[i:i + 5]) for i in range(len(w) - 4)))
        rows += [f"('{name}', '{x}', {len(parts)}, {max(1, len(parts) // 4)})" for x in parts]
    return r"""
WITH known(license, shingle, size, step) AS (VALUES """ + ", ".join(rows) + r"""),
texts AS (
  SELECT doc_id, row_number() OVER () AS rid,
         regexp_extract_all(lower(coalesce(text, '')), '[\p{L}\p{N}]+') AS w
  FROM documents
), matches AS (
  SELECT rid, doc_id, n, license, size, step, pos, shingle
  FROM (SELECT rid, doc_id, len(w) - 4 AS n, i AS pos, array_to_string(list_slice(w, i + 1, i + 5), ' ') AS shingle
        FROM (SELECT *, unnest(range(0, len(w) - 4)) AS i FROM texts WHERE len(w) >= 5)) JOIN known USING (shingle)
), windows AS (
  SELECT DISTINCT rid, license, k * step AS start
  FROM (SELECT *, unnest(range(greatest(pos - size - step, 0) // step, (pos + step) // step + 1)) AS k FROM matches)
  WHERE k * step < n
), judged AS (
  SELECT doc_id, license, size, count(DISTINCT shingle) AS shared, min(pos) AS found_at
  FROM windows JOIN matches USING (rid, license)
  WHERE pos >= start - step AND pos < start + size + step
  GROUP BY rid, doc_id, license, size, start
  HAVING 100 * shared >= 80 * size
)
SELECT doc_id, license, max(size)::BIGINT AS n_template, max(shared)::BIGINT AS n_shared, min(found_at)::BIGINT AS first_word
FROM judged GROUP BY doc_id, license
"""


def op4_odd_sketch_near_dups(spark, sf_dir):
    return near_dups.near_duplicates(table(spark, sf_dir, "documents"))


def op5_byte_bpe(spark, sf_dir):
    return byte_bpe.round_trip(table(spark, sf_dir, "documents"))


def op6_warc_normaliser(spark, sf_dir):
    return warc.archive_round_trip(table(spark, sf_dir, "pages"))


OP6_SQL = """
WITH p AS (
  SELECT page_id, octet_length(encode(coalesce(html, '')))::BIGINT AS payload_bytes,
         sha256(coalesce(html, '')) AS payload_digest
  FROM pages
), firsts AS (
  SELECT payload_digest, min(page_id) AS first_id FROM p WHERE payload_bytes >= 100
  GROUP BY payload_digest HAVING count(*) > 1
)
SELECT page_id, payload_bytes, payload_digest,
       CASE WHEN first_id IS NOT NULL AND page_id IS DISTINCT FROM first_id THEN 'revisit' ELSE 'response' END
         AS record_type,
       CASE WHEN page_id IS DISTINCT FROM first_id THEN first_id END AS refers_to
FROM p LEFT JOIN firsts USING (payload_digest)
"""


def op7_bradley_terry_quality(spark, sf_dir):
    return quality_rank.rank_quality(table(spark, sf_dir, "documents"), table(spark, sf_dir, "labels"))


def op8_markov_secrets(spark, sf_dir):
    return secrets.scan_secrets(table(spark, sf_dir, "documents")).drop("found")


def _op8_sql() -> str:
    """Base spans by split positions, both models by counting, and their ratio."""
    q = lambda p: p.replace("'", "''")
    rules = ((0, secrets.ASSIGN, 2, secrets.LEAST_VALUE), (1, secrets.ACCESS, 0, 0), (2, secrets.HEX, 0, 0))
    each = " UNION ALL ".join(
        f"SELECT rid, {kind} AS kind, {least} AS least, regexp_extract_all(t, '{q(p)}') AS m, "
        f"regexp_extract_all(t, '{q(p)}', {group}) AS v, string_split_regex(t, '{q(p)}') AS s FROM texts"
        for kind, p, group, least in (*rules, (3, secrets.CANDIDATE, 0, 0)))
    plain = "t"
    for _, p, _, _ in rules:
        plain = f"regexp_replace({plain}, '{q(p)}', ' ', 'g')"
    names = "['" + "', '".join(secrets.KINDS) + "']"
    k, prior = len(secrets.ALPHABET), secrets.PRIOR
    joined = f"string_agg({names}[kind + 1] || ':' || a || ':' || b, ',' ORDER BY a, kind)"
    return rf"""
WITH texts AS (
  SELECT row_number() OVER () AS rid, doc_id, coalesce(text, '') AS t FROM documents
), found AS (
  SELECT rid, kind, v[i] AS value,
         (list_sum(list_transform(s[1:i], lambda x: length(x))) + coalesce(list_sum(list_transform(m[1:i - 1], lambda x: length(x))), 0))::BIGINT AS a,
         (list_sum(list_transform(s[1:i], lambda x: length(x))) + list_sum(list_transform(m[1:i], lambda x: length(x))))::BIGINT AS b
  FROM (SELECT *, unnest(range(1, len(m) + 1)) AS i FROM ({each}) WHERE len(m) > 0) WHERE length(v[i]) >= least
), base AS (
  SELECT * FROM found WHERE kind < 3
), letters AS (
  SELECT unnest(string_split('{secrets.ALPHABET}', '')) AS c
), samples AS (
  SELECT 'r' AS label, value AS w FROM base
  UNION ALL SELECT 'w', w || '_' || upper(w) || '/' || lower(w) || upper(w[1]) || lower(w[2:]) || '-' || w
  FROM (SELECT unnest(regexp_extract_all({plain}, '{secrets.WORD}')) AS w FROM texts)
), steps AS (
  SELECT label, substr(w, i, 2) AS pair, count(*) AS n
  FROM (SELECT label, w, unnest(range(1, length(w))) AS i FROM samples)
  WHERE regexp_full_match(substr(w, i, 2), '[A-Za-z0-9+/_-][A-Za-z0-9+/_-]') GROUP BY 1, 2
), model AS (
  SELECT p.c || q.c AS pair, l.label,
         (coalesce(any_value(n), 0) + {prior}::DOUBLE / {k}) / (sum(coalesce(any_value(n), 0)) OVER (PARTITION BY p.c, l.label) + {prior}::DOUBLE) AS share
  FROM letters p, letters q, (VALUES ('r'), ('w')) AS l(label) LEFT JOIN steps ON steps.pair = p.c || q.c AND steps.label = l.label
  GROUP BY p.c, q.c, l.label
), ratio AS (
  SELECT pair, round(1000 * ln((max(share) FILTER (label = 'r') + 1::DOUBLE / {k}) / 2 / max(share) FILTER (label = 'w')))::BIGINT AS r
  FROM model GROUP BY pair
), cut AS (
  SELECT c.rid, c.a AS run_a, c.b AS run_b, c.value, x.a, x.b,
         max(x.b) OVER w AS done, lead(x.a) OVER w AS next
  FROM found c JOIN base x ON x.rid = c.rid AND x.a < c.b AND c.a < x.b WHERE c.kind = 3
  WINDOW w AS (PARTITION BY c.rid, c.a ORDER BY x.a, x.kind, x.b)
), candidates AS (
  SELECT rid, a, b, value FROM found c WHERE kind = 3
    AND NOT EXISTS (SELECT 1 FROM base WHERE base.rid = c.rid AND base.a < c.b AND c.a < base.b)
  UNION ALL SELECT rid, a, b, substr(run, a - run_a + 1, b - a) FROM (
    SELECT rid, run_a, value AS run, greatest(done, run_a) AS a, least(coalesce(next, run_b), run_b) AS b FROM cut
    UNION ALL SELECT rid, run_a, any_value(value), run_a, min(a) FROM cut GROUP BY rid, run_a)
  WHERE b - a >= {secrets.LEAST_CANDIDATE}
), added AS (
  SELECT c.rid, 3 AS kind, c.a, c.b
  FROM (SELECT *, unnest(range(1, length(value))) AS i FROM candidates) c JOIN ratio ON ratio.pair = substr(value, i, 2)
  GROUP BY c.rid, c.a, c.b, length(value) HAVING sum(r) >= {secrets.THRESHOLD} * (length(value) - 1)
), spans AS (
  SELECT rid, kind, a, b FROM base UNION ALL SELECT * FROM added
), told AS (
  SELECT rid, {joined} AS spans, coalesce({joined.replace("ORDER BY a, kind)", "ORDER BY a, kind) FILTER (kind < 3)")}, '') AS based,
         count(*) FILTER (kind = 0) AS n0, count(*) FILTER (kind = 1) AS n1, count(*) FILTER (kind = 2) AS n2
  FROM spans GROUP BY rid
)
SELECT doc_id, coalesce(n0, 0)::BIGINT AS n_assign, coalesce(n1, 0)::BIGINT AS n_access, coalesce(n2, 0)::BIGINT AS n_hex,
       sha256(coalesce(based, '')) AS base_sha256, coalesce(spans, '') AS spans
FROM texts LEFT JOIN told USING (rid)
"""


def op9_suffix_array_decontamination(spark, sf_dir):
    return decontaminate.decontamination(table(spark, sf_dir, "documents"), table(spark, sf_dir, "benchmark"))


OP9_SQL = r"""
WITH lowered AS (
  SELECT row_number() OVER () AS rid, doc_id,
         regexp_extract_all(translate(coalesce(text, ''), 'ABCDEFGHIJKLMNOPQRSTUVWXYZ', 'abcdefghijklmnopqrstuvwxyz'),
                            '[^\x00-\x2F\x3A-\x60\x7B-\x7F]+') AS ws
  FROM documents
), items AS (
  SELECT coalesce(item_id::VARCHAR, '') AS item,
         regexp_extract_all(translate(coalesce(text, ''), 'ABCDEFGHIJKLMNOPQRSTUVWXYZ', 'abcdefghijklmnopqrstuvwxyz'),
                            '[^\x00-\x2F\x3A-\x60\x7B-\x7F]+') AS ws
  FROM benchmark
), windows AS (
  SELECT DISTINCT item, least(10, len(ws)) AS n, array_to_string(list_slice(ws, i, i + least(10, len(ws)) - 1), ' ') AS win
  FROM (SELECT item, ws, unnest(range(1, greatest(len(ws) - 9, 1) + 1)) AS i FROM items WHERE len(ws) > 0)
), sizes AS (
  SELECT DISTINCT n FROM windows
), starts AS (
  SELECT rid, i, n, array_to_string(list_slice(ws, i, i + n - 1), ' ') AS win
  FROM (SELECT rid, ws, n, unnest(range(1, len(ws) - n + 2)) AS i FROM lowered, sizes WHERE len(ws) >= n)
), found AS (
  SELECT rid, i, n, item FROM starts JOIN windows USING (n, win)
), words AS (
  SELECT rid, count(DISTINCT p) AS n_hit FROM (SELECT rid, unnest(range(i, i + n)) AS p FROM found) GROUP BY rid
), named AS (
  SELECT rid, count(*) AS n_items, string_agg(item, ',' ORDER BY item) AS items
  FROM (SELECT DISTINCT rid, item FROM found) GROUP BY rid
)
SELECT doc_id, len(ws)::BIGINT AS n_words, coalesce(n_hit, 0)::BIGINT AS n_hit,
       coalesce(n_items, 0)::BIGINT AS n_items, sha256(coalesce(items, '')) AS items_sha256,
       coalesce(n_hit, 0) > 0 AS contaminated
FROM lowered LEFT JOIN words USING (rid) LEFT JOIN named USING (rid)
"""

def op10_blockwise_suffix_dedup(spark, sf_dir):
    out = suffix_dedup.suffix_dedup(table(spark, sf_dir, "documents"), with_text=True)
    return out.select(*[c for c in out.columns if c != "kept"], (out["n_bytes"] - out["n_removed"]).alias("n_kept"),
                      suffix_dedup.remaining_text("kept").alias("text"))



def op11_noisy_channel_toxicity(spark, sf_dir):
    return toxicity.score_toxicity(table(spark, sf_dir, "documents"), table(spark, sf_dir, "labels"))


def op12_crc_importance_resampling(spark, sf_dir):
    return importance.resample(table(spark, sf_dir, "documents"), table(spark, sf_dir, "benchmark"))


def _op12_sql() -> str:
    """CRC-32 by folding the bytes of each distinct feature."""
    k = importance.BUCKETS
    split = ("regexp_extract_all(translate(coalesce(text, ''), 'ABCDEFGHIJKLMNOPQRSTUVWXYZ', 'abcdefghijklmnopqrstuvwxyz'), "
             r"'[^\x00-\x2F\x3A-\x60\x7B-\x7F]+')")
    runs = " UNION ALL ".join(
        f"SELECT of, rid, array_to_string(list_slice(ws, i, i + {n}), ' ') AS x FROM "
        f"(SELECT of, rid, ws, unnest(range(1, len(ws) - {n} + 1)) AS i FROM texts WHERE len(ws) > {n})" for n in range(3))
    return rf"""
WITH texts AS (
  SELECT 's' AS of, row_number() OVER () AS rid, doc_id, {split} AS ws FROM documents
  UNION ALL SELECT 't', row_number() OVER (), NULL, {split} FROM benchmark
), found AS MATERIALIZED ({runs}),
byte_step AS MATERIALIZED (
  SELECT list(list_reduce(list_prepend(b, range(8)), lambda a, i: if(a % 2 = 1, xor(a // 2, 3988292384), a // 2)) ORDER BY b) AS step
  FROM (SELECT unnest(range(256))::BIGINT AS b)
), hashed AS MATERIALIZED (
  SELECT x, xor(list_reduce(list_prepend(4294967295::BIGINT, list_transform(range(1, length(h), 2),
              lambda i: (16 * (instr('0123456789ABCDEF', h[i]) - 1) + instr('0123456789ABCDEF', h[i + 1]) - 1)::BIGINT)),
            lambda a, b: xor(a // 256, step[xor(a, b) % 256 + 1])), 4294967295) % {k} AS bucket
  FROM (SELECT x, hex(encode(x)) AS h FROM (SELECT DISTINCT x FROM found)), byte_step
), counts AS (
  SELECT bucket, count(*) FILTER (of = 's') AS s, count(*) FILTER (of = 't') AS t FROM found JOIN hashed USING (x) GROUP BY bucket
), totals AS (
  SELECT coalesce(sum(s), 0) AS s_all, coalesce(sum(t), 0) AS t_all FROM counts
), gain AS (
  SELECT bucket, floor(1000 * ln(((t + 1)::DOUBLE * (s_all + {k})::DOUBLE) / ((s + 1)::DOUBLE * (t_all + {k})::DOUBLE)))::BIGINT AS g
  FROM counts, totals
), weighed AS (
  SELECT rid, count(*) AS n_features, sum(g) AS weight FROM found JOIN hashed USING (x) JOIN gain USING (bucket)
  WHERE of = 's' GROUP BY rid
), scored AS (
  SELECT doc_id, len(ws)::BIGINT AS n_words, coalesce(n_features, 0)::BIGINT AS n_features, coalesce(weight, 0)::BIGINT AS weight,
         (coalesce(weight, 0) + floor(-1000 * ln(-ln((('0x' || substr(sha256('{importance.SEED}:' || coalesce(doc_id::VARCHAR, '')), 1, 8))::BIGINT
                                                + 0.5::DOUBLE) / 4294967296::DOUBLE))))::BIGINT AS score, rid
  FROM texts LEFT JOIN weighed USING (rid) WHERE of = 's'
), placed AS (
  SELECT rid, row_number() OVER (ORDER BY score DESC, doc_id NULLS LAST, n_features, n_words) AS place, count(*) OVER () AS n
  FROM scored WHERE n_words >= {importance.LEAST_WORDS}
)
SELECT doc_id, n_features, weight, score, CASE WHEN place <= {importance.PERCENT} * n // 100 THEN place END AS rank, n_words
FROM scored LEFT JOIN placed USING (rid)
"""


def op13_ball_kmeans_codes(spark, sf_dir):
    return vector_codes.vector_codes(table(spark, sf_dir, "embeddings"))


def _op13_sql() -> str:
    """Every part against every entry, round by round."""
    v = vector_codes

    def assigned(k: int) -> str:
        return f"""a{k} AS MATERIALIZED (
  SELECT rid, p, v, arg_min(e, [d, e]) AS e, min(d) AS d
  FROM (SELECT rid, part.p, v, e, list_sum(list_transform(list_zip(v, c), lambda z: (z[1] - z[2]) * (z[1] - z[2]))) AS d
        FROM part JOIN book{k} ON book{k}.p = part.p) GROUP BY rid, p, v)"""

    def updated(k: int) -> str:
        return f"""book{k + 1} AS MATERIALIZED (
  SELECT p, e, coalesce(n, c) AS c FROM book{k} LEFT JOIN (
    SELECT p, e, list(floor_mean ORDER BY k) AS n FROM (
      SELECT p, e, k, floor(sum(v[k])::DECIMAL(38,0) / count(*))::BIGINT AS floor_mean
      FROM (SELECT p, e, v, unnest(range(1, len(v) + 1)) AS k FROM a{k}) GROUP BY p, e, k) GROUP BY p, e) USING (p, e))"""

    rounds = ",\n".join(x for k in range(v.ROUNDS) for x in (assigned(k), updated(k)))
    return f"""
WITH kept AS MATERIALIZED (
  SELECT row_number() OVER (ORDER BY vec_id NULLS LAST, x) AS rid, vec_id, label, x FROM (
    SELECT vec_id, label, list_transform(embedding, lambda x: floor({v.SCALE} * x::DOUBLE)::BIGINT) AS x FROM embeddings
    WHERE embedding IS NOT NULL AND len(list_filter(embedding, lambda x: x IS NULL OR NOT isfinite(x))) = 0)
), part AS MATERIALIZED (
  SELECT rid, p, list_slice(x, p * (len(x) // {v.PARTS}) + 1, (p + 1) * (len(x) // {v.PARTS})) AS v
  FROM (SELECT rid, x, unnest(range({v.PARTS})) AS p FROM kept)
), book0 AS MATERIALIZED (
  SELECT p, rid - 1 AS e, v AS c FROM part WHERE rid <= {v.ENTRIES}
), {rounds}, {assigned(v.ROUNDS)},
vectors AS (
  SELECT rid, string_agg(printf('%02x', e::INTEGER), '' ORDER BY p) AS code, sum(d)::BIGINT AS error FROM a{v.ROUNDS} GROUP BY rid
), digest AS (
  SELECT sha256(string_agg(array_to_string(c, ','), ',' ORDER BY p, e)) AS codebooks_sha256 FROM book{v.ROUNDS}
)
SELECT vec_id, code, error, (sum(error) OVER (PARTITION BY label))::BIGINT AS label_error, codebooks_sha256
FROM kept JOIN vectors USING (rid), digest
"""


QUERIES = {f.__name__: f for f in (
    op1_byte_cnn_language, op2_host_quality_rules, op3_license_scans, op4_odd_sketch_near_dups, op5_byte_bpe,
    op6_warc_normaliser, op7_bradley_terry_quality, op8_markov_secrets, op9_suffix_array_decontamination,
    op10_blockwise_suffix_dedup, op11_noisy_channel_toxicity, op12_crc_importance_resampling, op13_ball_kmeans_codes)}

ORACLE = {
    "op3_license_scans": _op3_sql(),
    "op8_markov_secrets": _op8_sql(),
    "op6_warc_normaliser": OP6_SQL,
    "op2_host_quality_rules": OP2_SQL,
    "op9_suffix_array_decontamination": OP9_SQL,
    "op12_crc_importance_resampling": _op12_sql(),
    "op13_ball_kmeans_codes": _op13_sql(),
}
