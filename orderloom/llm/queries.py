"""The contract queries of the training-data operators, and their SQL counterparts where SQL can express them."""

from __future__ import annotations

from orderloom.llm.bpe import op5_bpe
from orderloom.llm.cotraining import op1_quality_cotraining
from orderloom.llm.hnsw import op3_nearest
from orderloom.llm.jaccard import op9_jaccard_join
from orderloom.llm.lblm import op4_lm_scoring
from orderloom.llm.mixing import op7_mixing
from orderloom.llm.orderminhash import op2_order_minhash
from orderloom.llm.pii import op6_pii
from orderloom.llm.spelling import op12_spelling_variants
from orderloom.llm.suffixdedup import op10_suffix_dedup
from orderloom.llm.toxicity import op8_toxicity
from orderloom.llm.vectorcodes import op11_vector_codes
from orderloom.llm.windowdedup import op13_window_dedup

QUERIES = {
    "op1_quality_cotraining": op1_quality_cotraining,
    "op2_order_minhash": op2_order_minhash,
    "op3_nearest": op3_nearest,
    "op4_lm_scoring": op4_lm_scoring,
    "op5_bpe": op5_bpe,
    "op6_pii": op6_pii,
    "op7_mixing": op7_mixing,
    "op8_toxicity": op8_toxicity,
    "op9_jaccard_join": op9_jaccard_join,
    "op10_suffix_dedup": op10_suffix_dedup,
    "op11_vector_codes": op11_vector_codes,
    "op12_spelling_variants": op12_spelling_variants,
    "op13_window_dedup": op13_window_dedup,
}


def _vector_codes_sql(parts: int = 4, entries: int = 256, rounds: int = 4) -> str:
    """Exhaustive k-means in integers, a few views per round."""
    steps = [
        f"""WITH scaled AS MATERIALIZED (
  SELECT vec_id, label, list_transform(embedding, lambda x: CAST(floor(1024 * CAST(x AS DOUBLE)) AS BIGINT)) AS v,
         row_number() OVER (ORDER BY vec_id NULLS LAST, embedding) AS rid
  FROM embeddings WHERE embedding IS NOT NULL AND len(list_filter(embedding, lambda x: x IS NULL OR NOT isfinite(x))) = 0
), cut AS MATERIALIZED (
  SELECT rid, p, v[p * (len(v) // {parts}) + 1 : (p + 1) * (len(v) // {parts})] AS x FROM scaled, (SELECT range AS p FROM range({parts}))
), book0 AS MATERIALIZED (SELECT p, rid - 1 AS e, x AS c FROM cut WHERE rid <= {entries})"""
    ]
    near = """near{k} AS MATERIALIZED (
  SELECT rid, p, x, best[1] AS d, best[2] AS e FROM (
    SELECT rid, cut.p, x, min([CAST(list_sum(list_transform(list_zip(x, c), lambda z: (z[1] - z[2]) * (z[1] - z[2]))) AS BIGINT), e]) AS best
    FROM cut JOIN book{k} b ON b.p = cut.p GROUP BY rid, cut.p, x)
)"""
    new = """sums{k} AS (
  SELECT p, e, i, CAST(sum(x[i]) AS BIGINT) AS s, count(*) AS n FROM near{k}, (SELECT unnest(range(1, len(x) + 1)) AS i FROM cut WHERE rid = 1 AND p = 0)
  GROUP BY p, e, i
), book{next} AS MATERIALIZED (
  SELECT b.p, b.e, coalesce(m.c, b.c) AS c FROM book{k} b LEFT JOIN (
    SELECT p, e, list((s - ((s % n) + n) % n) // n ORDER BY i) AS c FROM sums{k} GROUP BY p, e) m ON m.p = b.p AND m.e = b.e
)"""
    for k in range(rounds):
        steps += [near.format(k=k), new.format(k=k, next=k + 1)]
    steps.append(near.format(k=rounds))
    steps.append(f"""coded AS (
  SELECT rid, string_agg(printf('%02x', CAST(e AS INT)), '' ORDER BY p) AS code, CAST(sum(d) AS BIGINT) AS error FROM near{rounds} GROUP BY rid
), digest AS (SELECT sha256(string_agg(array_to_string(c, ','), ',' ORDER BY p, e)) AS h FROM book{rounds})
SELECT vec_id, code, error, CAST(sum(error) OVER (PARTITION BY label) AS BIGINT) AS label_error, h AS codebooks_sha256
FROM scaled JOIN coded USING (rid), digest""")
    return ",\n".join(steps)


ORACLES: dict[str, str] = {
    "op11_vector_codes": _vector_codes_sql(),
    "op9_jaccard_join": r"""
WITH RECURSIVE tokens AS (
  SELECT row_number() OVER () AS rid, doc_id,
         regexp_extract_all(translate(coalesce(text, ''), 'ABCDEFGHIJKLMNOPQRSTUVWXYZ', 'abcdefghijklmnopqrstuvwxyz'),
                            '[^\x20\x09-\x0D]+') AS w
  FROM documents
), sets AS (
  SELECT rid, doc_id, CASE WHEN len(w) = 0 THEN [] WHEN len(w) < 3 THEN [array_to_string(w, ' ')]
         ELSE list_distinct(list_transform(range(1, len(w) - 1), lambda i: w[i] || ' ' || w[i + 1] || ' ' || w[i + 2])) END AS s
  FROM tokens
), grams AS (SELECT rid, len(s) AS n, unnest(s) AS shingle FROM sets),
links AS MATERIALIZED (
  SELECT x.rid AS a, y.rid AS b FROM grams x JOIN grams y ON x.shingle = y.shingle AND x.rid <> y.rid
  GROUP BY x.rid, y.rid, x.n, y.n HAVING 100 * count(*) >= 90 * (x.n + y.n - count(*))
), reach(rid, root) AS (
  SELECT rid, doc_id FROM sets
  UNION
  SELECT l.b, r.root FROM reach r JOIN links l ON l.a = r.rid
), roots AS (SELECT rid, min(root) AS component_id FROM reach GROUP BY rid),
degree AS (SELECT a AS rid, count(*) AS n_links FROM links GROUP BY a)
SELECT doc_id, CAST(len(s) AS BIGINT) AS n_shingles, component_id, CAST(coalesce(n_links, 0) AS BIGINT) AS n_links
FROM sets JOIN roots USING (rid) LEFT JOIN degree USING (rid)
""",
    "op13_window_dedup": r"""
WITH tokens AS (SELECT row_number() OVER () AS rid, doc_id, regexp_extract_all(coalesce(text, ''), '[^\x20\x09-\x0D]+') AS w FROM documents),
windows AS MATERIALIZED (
  SELECT rid, doc_id, i, array_to_string(w[i : i + 12], ' ') AS sequence
  FROM (SELECT rid, doc_id, w, unnest(range(1, len(w) - 11)) AS i FROM tokens WHERE doc_id IS NOT NULL)
), least AS (SELECT sequence, min(doc_id) AS first_doc FROM windows GROUP BY sequence),
gone AS (
  SELECT rid, list_sort(list_distinct(flatten(list(range(i, i + 13))))) AS places
  FROM windows JOIN least USING (sequence) WHERE doc_id > first_doc GROUP BY rid
), kept AS (
  SELECT rid, string_agg(word, ' ' ORDER BY i) AS text
  FROM (SELECT t.rid, unnest(t.w) AS word, unnest(range(1, len(t.w) + 1)) AS i FROM tokens t) x
  WHERE NOT EXISTS (SELECT 1 FROM (SELECT rid, unnest(places) AS place FROM gone) g WHERE g.rid = x.rid AND g.place = x.i)
  GROUP BY rid
)
SELECT doc_id, CAST(len(w) AS BIGINT) AS n_words, CAST(coalesce(len(places), 0) AS BIGINT) AS n_removed,
       sha256(coalesce(k.text, '')) AS kept_sha256
FROM tokens LEFT JOIN gone USING (rid) LEFT JOIN kept k USING (rid)
""",
    "op12_spelling_variants": r"""
WITH RECURSIVE crc AS (
  SELECT list(list_reduce(list_prepend(i, range(8)), lambda c, k: CASE WHEN c & 1 = 1 THEN xor(3988292384, c >> 1) ELSE c >> 1 END) ORDER BY i) AS t
  FROM (SELECT CAST(range AS BIGINT) AS i FROM range(256))
), tokens AS (
  SELECT doc_id, unnest(regexp_extract_all(translate(coalesce(text, ''), 'ABCDEFGHIJKLMNOPQRSTUVWXYZ', 'abcdefghijklmnopqrstuvwxyz'),
                                           '[A-Za-z\x{C0}-\x{FF}]+')) AS run
  FROM documents
), runs AS (SELECT doc_id, run, count(*) AS n FROM tokens WHERE length(run) >= 6 GROUP BY ALL),
bytes AS (
  SELECT run, n, flatten(list_transform(string_split(coalesce(CAST(doc_id AS VARCHAR), '') || ':' || run, ''),
                                        lambda c: CASE WHEN ord(c) < 128 THEN [CAST(ord(c) AS BIGINT)] ELSE [195, ord(c) - 64] END)) AS raw
  FROM runs
), hashed AS (
  SELECT run, n, xor(list_reduce(list_prepend(4294967295, raw), lambda c, b: xor(c >> 8, t[(xor(c, b) & 255) + 1])), 4294967295) AS h
  FROM bytes, crc
), damaged AS (
  SELECT CASE WHEN h % 199 = 0 THEN substr(run, 1, h % length(run)) || substr(run, h % length(run) + 2) ELSE run END AS word, n FROM hashed
), words AS MATERIALIZED (
  SELECT word, CAST(sum(n) AS BIGINT) AS n FROM damaged WHERE length(word) >= 6 GROUP BY word HAVING sum(n) >= 5
), less AS MATERIALIZED (
  SELECT word, n, i, substr(word, 1, i - 1) || substr(word, i + 1) AS rest FROM (SELECT word, n, unnest(range(1, length(word) + 1)) AS i FROM words)
), near AS (
  SELECT DISTINCT x.word AS a, y.word AS b, y.n AS n FROM less x JOIN less y ON x.i = y.i AND x.rest = y.rest AND x.word <> y.word
  UNION
  SELECT l.word, w.word, w.n FROM less l JOIN words w ON w.word = l.rest
  UNION
  SELECT w.word, l.word, l.n FROM less l JOIN words w ON w.word = l.rest
), ranked AS (
  SELECT a, b, n, count(*) OVER (PARTITION BY a) AS n_near, row_number() OVER (PARTITION BY a ORDER BY n DESC, encode(b)) AS place FROM near
), formed AS MATERIALIZED (
  SELECT w.word, w.n, coalesce(r.n_near, 0) AS n_near, CASE WHEN r.n >= 5 * w.n THEN r.b END AS form,
         CASE WHEN r.n >= 5 * w.n THEN r.n END AS form_n
  FROM words w LEFT JOIN ranked r ON r.a = w.word AND r.place = 1
), walk AS (
  SELECT word, word AS at FROM formed
  UNION ALL
  SELECT k.word, f.form FROM walk k JOIN formed f ON f.word = k.at WHERE f.form IS NOT NULL
), last AS (SELECT k.word, k.at AS root FROM walk k JOIN formed f ON f.word = k.at WHERE f.form IS NULL)
SELECT f.word, f.form, l.root, f.n, f.n_near, f.form_n FROM formed f JOIN last l ON l.word = f.word
""",
}
