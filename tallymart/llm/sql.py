"""SQL counterparts of the queries, for another engine over the same tables."""

WORD = r"[^\x20\x09-\x0D]+"

NEAR_DEDUP = rf"""
WITH RECURSIVE docs AS (
  SELECT doc_id, regexp_extract_all(
    translate(coalesce(text, ''), 'ABCDEFGHIJKLMNOPQRSTUVWXYZ', 'abcdefghijklmnopqrstuvwxyz'), '{WORD}') AS w
  FROM documents),
sets AS (
  SELECT doc_id, CASE WHEN len(w) = 0 THEN []
    WHEN len(w) < 5 THEN [array_to_string(w, ' ')]
    ELSE list_distinct(list_transform(range(1, len(w) - 3), lambda i: array_to_string(w[i:i+4], ' '))) END AS s
  FROM docs),
sizes AS (SELECT doc_id, len(s) AS n FROM sets),
shingles AS (SELECT doc_id, unnest(s) AS g FROM sets),
common AS (
  SELECT x.doc_id AS a, y.doc_id AS b, count(*) AS n
  FROM shingles x JOIN shingles y ON x.g = y.g AND x.doc_id < y.doc_id GROUP BY ALL),
links AS (
  SELECT a, b FROM common c JOIN sizes p ON p.doc_id = a JOIN sizes q ON q.doc_id = b
  WHERE 100 * c.n >= 75 * (p.n + q.n - c.n)),
ends AS (SELECT a, b FROM links UNION ALL SELECT b, a FROM links),
reach(a, b) AS (SELECT a, b FROM ends UNION SELECT r.a, e.b FROM reach r JOIN ends e ON r.b = e.a),
least_of AS (SELECT a, min(b) AS m FROM reach GROUP BY a)
SELECT doc_id, n AS n_shingles, least(doc_id, coalesce(m, doc_id)) AS component_id,
  doc_id = least(doc_id, coalesce(m, doc_id)) AS kept
FROM sizes LEFT JOIN least_of ON a = doc_id
"""

MIXING = rf"""
WITH sizes AS (
  SELECT doc_id, source, CAST(len(regexp_extract_all(coalesce(text, ''), '{WORD}')) AS BIGINT) AS size,
    CAST(CAST('0x' || substr(md5('mix:' || coalesce(CAST(doc_id AS VARCHAR), 'text:' || coalesce(text, ''))), 1, 13)
      AS BIGINT) AS DOUBLE) / 4503599627370496.0 AS coin
  FROM documents),
totals AS (SELECT source, CAST(sum(size) AS BIGINT) AS n FROM sizes GROUP BY source),
weighed AS (
  SELECT source, n, [5, 2, 1][(row_number() OVER (ORDER BY source NULLS LAST) - 1) % 3 + 1] AS w FROM totals),
levels AS (
  SELECT *, (CAST(sum(n) OVER () AS DOUBLE) * 1.5
      - coalesce(CAST(sum(2 * n) OVER (o ROWS BETWEEN UNBOUNDED PRECEDING AND 1 PRECEDING) AS DOUBLE), 0))
    / CAST(sum(w) OVER (o ROWS BETWEEN CURRENT ROW AND UNBOUNDED FOLLOWING) AS DOUBLE) AS level
  FROM weighed WINDOW o AS (ORDER BY CAST(n AS DOUBLE) / w, source NULLS LAST)),
targets AS (SELECT source, n, least(CAST(2 * n AS DOUBLE), max(level) OVER () * w) AS target FROM levels),
rated AS (
  SELECT s.doc_id, s.size, t.n AS source_size, t.target, s.coin,
    CASE WHEN t.n > 0 THEN t.target / t.n ELSE 0.0 END AS rate
  FROM sizes s JOIN targets t ON s.source IS NOT DISTINCT FROM t.source),
counted AS (
  SELECT *, CAST(floor(rate) AS INTEGER) + CASE WHEN coin < rate - floor(rate) THEN 1 ELSE 0 END AS copies FROM rated)
SELECT doc_id, size, source_size, target, CAST(size * copies AS BIGINT) AS taken, copies FROM counted
"""


def license_sql(known, spellings, copyright_line, not_word) -> str:
    def canonical(x: str) -> str:
        small = f"translate({x}, 'ABCDEFGHIJKLMNOPQRSTUVWXYZ', 'abcdefghijklmnopqrstuvwxyz')"
        out = f"regexp_replace({small}, '{copyright_line}', chr(10), 'g')"
        out = f"' ' || trim(regexp_replace({out}, '{not_word}', ' ', 'g')) || ' '"
        for a, b in spellings.items():
            out = f"replace({out}, ' {a} ', ' {b} ')"
        return f"sha256(trim({out}))"

    values = ", ".join(f"('{name}', '{text}')" for name, text in known)
    return f"""
WITH known AS (
  SELECT {canonical('t')} AS digest, min(name) AS license FROM (VALUES {values}) v(name, t) GROUP BY 1),
docs AS (SELECT row_number() OVER () AS r, doc_id, coalesce(text, '') AS text FROM documents),
lines AS (SELECT r, unnest(string_split(text, chr(10))) AS line FROM docs),
found AS (
  SELECT r, string_agg(DISTINCT license, ',' ORDER BY license) AS line_licenses, count(*) AS n
  FROM lines JOIN known ON known.digest = {canonical('line')} WHERE length(trim(line)) > 0 GROUP BY r)
SELECT doc_id, {canonical('text')} AS text_digest, license, coalesce(line_licenses, '') AS line_licenses,
  coalesce(n, 0) AS n_license_lines
FROM docs LEFT JOIN found USING (r) LEFT JOIN known ON known.digest = {canonical('text')}
"""


def _sha_leaf(text: str) -> str:
    fields = ["CAST(doc_id AS VARCHAR)", "source", "lang", "CAST(n_chars AS VARCHAR)", text]
    return "sha256(" + " || ".join(f"coalesce(strlen({f}) || ':' || {f}, '-')" for f in fields) + ")"


# crc32 of the doc_id's digits, bit by bit
_CRC = """xor(list_reduce(list_prepend(4294967295::BIGINT, list_transform(range(1, strlen(id) + 1), lambda i: CAST(ascii(id[i]) AS BIGINT))),
  lambda c, b: list_reduce([xor(c, b), 0, 0, 0, 0, 0, 0, 0, 0], lambda x, z: CASE WHEN x & 1 = 1 THEN xor(x >> 1, 3988292384) ELSE x >> 1 END)),
  4294967295)"""

MERKLE = f"""
WITH RECURSIVE docs AS (SELECT *, coalesce(CAST(doc_id AS VARCHAR), '') AS id FROM documents),
leaves AS (
  SELECT doc_id, source, {_sha_leaf("text")} AS leaf,
    CASE WHEN {_CRC} % 2 = 0 THEN {_sha_leaf("replace(text, chr(10), '')")} ELSE {_sha_leaf("text")} END AS changed
  FROM docs),
placed AS (
  SELECT *, row_number() OVER (PARTITION BY source ORDER BY doc_id NULLS FIRST, leaf) - 1 AS idx,
    count(*) OVER (PARTITION BY source) AS n, coalesce('s' || source, '') AS tree FROM leaves),
nodes AS (
  SELECT tree, 0 AS lvl, idx, n, leaf AS d FROM placed
  UNION ALL
  SELECT tree, lvl + 1, idx // 3, (n + 2) // 3, sha256(string_agg(d, '' ORDER BY idx))
  FROM nodes WHERE n > 1 GROUP BY tree, lvl, idx // 3, n),
heads AS (
  SELECT tree, d AS subroot, row_number() OVER (ORDER BY tree) - 1 AS idx, count(*) OVER () AS n FROM nodes WHERE n = 1),
top AS (
  SELECT 0 AS lvl, idx, n, subroot AS d FROM heads
  UNION ALL
  SELECT lvl + 1, idx // 3, (n + 2) // 3, sha256(string_agg(d, '' ORDER BY idx)) FROM top WHERE n > 1 GROUP BY lvl, idx // 3, n),
rows AS (SELECT *, row_number() OVER () AS r FROM placed),
walk AS (
  SELECT r, tree, 0 AS lvl, idx, n, changed AS d, '' AS proof FROM rows
  UNION ALL
  SELECT w.r, w.tree, w.lvl + 1, w.idx // 3, (w.n + 2) // 3,
    sha256(string_agg(CASE WHEN x.idx = w.idx THEN w.d ELSE x.d END, '' ORDER BY x.idx)),
    w.proof || coalesce(string_agg(CASE WHEN x.idx <> w.idx THEN x.d END, '' ORDER BY x.idx), '')
  FROM walk w JOIN nodes x ON x.tree = w.tree AND x.lvl = w.lvl AND x.idx // 3 = w.idx // 3
  WHERE w.n > 1 GROUP BY w.r, w.tree, w.lvl, w.idx, w.n, w.d, w.proof),
climb AS (
  SELECT w.r, 0 AS lvl, h.idx, h.n, w.d, w.proof FROM walk w JOIN heads h USING (tree) WHERE w.n = 1
  UNION ALL
  SELECT w.r, w.lvl + 1, w.idx // 3, (w.n + 2) // 3,
    sha256(string_agg(CASE WHEN x.idx = w.idx THEN w.d ELSE x.d END, '' ORDER BY x.idx)),
    w.proof || coalesce(string_agg(CASE WHEN x.idx <> w.idx THEN x.d END, '' ORDER BY x.idx), '')
  FROM climb w JOIN top x ON x.lvl = w.lvl AND x.idx // 3 = w.idx // 3
  WHERE w.n > 1 GROUP BY w.r, w.lvl, w.idx, w.n, w.d, w.proof)
SELECT p.doc_id, p.leaf, h.subroot, t.d AS root, sha256(c.proof) AS proof_sha256, c.d AS folded_root, c.d = t.d AS verified
FROM rows p JOIN climb c USING (r) JOIN heads h USING (tree) CROSS JOIN top t WHERE c.n = 1 AND t.n = 1
"""


def vector_code_sql(parts: int = 4, entries: int = 256, rounds: int = 4) -> str:
    """Rounds written out one after the other; distances are summed component by component."""
    size = "(SELECT CAST(len(x) AS BIGINT) FROM kept ORDER BY vec_id LIMIT 1)"
    out = f"""
WITH kept AS MATERIALIZED (
  SELECT vec_id, label, list_transform(embedding, lambda v: CAST(floor(1024 * CAST(v AS DOUBLE)) AS BIGINT)) AS x
  FROM embeddings
  WHERE embedding IS NOT NULL AND len(list_filter(embedding, lambda v: v IS NULL OR NOT isfinite(v))) = 0),
cut AS MATERIALIZED (
  SELECT vec_id, p, list_slice(x, CAST(p * {size} // {parts} + 1 AS BIGINT), CAST((p + 1) * {size} // {parts} AS BIGINT)) AS x
  FROM kept, range({parts}) r(p)),
book0 AS MATERIALIZED (
  SELECT p, row_number() OVER (PARTITION BY p ORDER BY vec_id) - 1 AS e, x AS c
  FROM cut WHERE vec_id IN (SELECT vec_id FROM kept ORDER BY vec_id LIMIT {entries}))"""
    for k in range(rounds + 1):
        out += f""",
near{k} AS MATERIALIZED (
  SELECT vec_id, p, min(e) FILTER (d = least) AS e, any_value(least) AS d FROM (
    SELECT vec_id, p, e, d, min(d) OVER (PARTITION BY vec_id, p) AS least FROM (
      SELECT vec_id, t.p, e, list_sum(list_transform(list_zip(x, c), lambda z: (z[1] - z[2]) * (z[1] - z[2]))) AS d
      FROM cut t JOIN book{k} b ON t.p = b.p))
  GROUP BY vec_id, p)"""
        if k < rounds:
            out += f""",
mean{k} AS (
  SELECT p, e, list(m ORDER BY i) AS c FROM (
    SELECT p, e, i, CAST(floor(sum(v) / count(*)) AS BIGINT) AS m
    FROM (SELECT p, e, unnest(x) AS v, unnest(range(1, len(x) + 1)) AS i FROM near{k} JOIN cut USING (vec_id, p))
    GROUP BY p, e, i) GROUP BY p, e),
book{k + 1} AS MATERIALIZED (
  SELECT p, e, coalesce(m.c, b.c) AS c FROM book{k} b LEFT JOIN mean{k} m USING (p, e))"""
    return out + f"""
SELECT vec_id, code, CAST(error AS BIGINT) AS error, CAST(sum(error) OVER (PARTITION BY label) AS BIGINT) AS label_error,
  (SELECT sha256(string_agg(array_to_string(c, ','), ',' ORDER BY p, e)) FROM book{rounds}) AS codebooks_sha256
FROM kept JOIN (
  SELECT vec_id, string_agg(lower(printf('%02x', e)), '' ORDER BY p) AS code, sum(d) AS error
  FROM near{rounds} GROUP BY vec_id) USING (vec_id)
"""
