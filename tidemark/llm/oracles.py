"""DuckDB SQL of the queries that SQL can express."""

TOP_K = """
WITH v AS (
  SELECT vec_id AS id, min(list_transform(embedding, lambda x: CAST(floor(1024 * CAST(x AS DOUBLE)) AS BIGINT))) AS v
  FROM embeddings
  WHERE vec_id IS NOT NULL AND len(embedding) > 0 AND NOT list_contains(list_transform(embedding, lambda x: x IS NULL OR NOT isfinite(x)), true)
  GROUP BY vec_id),
c AS (SELECT id, generate_subscripts(v, 1) AS k, unnest(v) AS x FROM v),
s AS (
  SELECT q.id AS query_id, c.id AS vec_id, CAST(sum(q.x * c.x) AS BIGINT) AS score
  FROM c AS q JOIN c ON q.k = c.k AND q.id <> c.id WHERE q.id % 100 = 0 GROUP BY 1, 2)
SELECT query_id, CAST(row_number() OVER (PARTITION BY query_id ORDER BY score DESC, vec_id) AS INTEGER) AS rank, vec_id, score
FROM s QUALIFY rank <= 10
"""

_WORDS = r"regexp_extract_all(translate(coalesce({text}, ''), 'ABCDEFGHIJKLMNOPQRSTUVWXYZ', 'abcdefghijklmnopqrstuvwxyz'), '[^\x00-\x2F\x3A-\x60\x7B-\x7F]+')"

DECONTAMINATION = f"""
WITH d AS (SELECT doc_id, {_WORDS.format(text='text')} AS w FROM documents),
b AS (SELECT CAST(item_id AS VARCHAR) AS item, {_WORDS.format(text='text')} AS w FROM benchmark WHERE item_id IS NOT NULL),
i AS (SELECT item, w, least(len(w), 10) AS size, unnest(range(1, greatest(1, len(w) - 9) + 1)) AS k FROM b WHERE len(w) > 0),
windows AS (SELECT DISTINCT item, size, list_slice(w, k, k + size - 1) AS words FROM i),
sizes AS (SELECT DISTINCT size FROM windows),
p AS (SELECT doc_id, w, size, unnest(range(1, len(w) - size + 2)) AS k FROM d, sizes WHERE len(w) >= size),
hits AS (
  SELECT p.doc_id, p.k, p.size, windows.item FROM (SELECT doc_id, size, k, list_slice(w, k, k + size - 1) AS words FROM p) AS p
  JOIN windows ON p.size = windows.size AND p.words = windows.words),
marked AS (SELECT doc_id, count(DISTINCT place) AS n_hit FROM (SELECT doc_id, unnest(range(k, k + size)) AS place FROM hits) GROUP BY doc_id),
items AS (SELECT doc_id, count(*) AS n_items, string_agg(item, ',' ORDER BY item) AS items FROM (SELECT DISTINCT doc_id, item FROM hits) GROUP BY doc_id)
SELECT d.doc_id, CAST(len(d.w) AS BIGINT) AS n_words, coalesce(n_hit, 0) AS n_hit, coalesce(n_items, 0) AS n_items,
  sha256(coalesce(items, '')) AS items_sha256, coalesce(n_hit, 0) > 0 AS contaminated
FROM d LEFT JOIN marked USING (doc_id) LEFT JOIN items USING (doc_id)
"""

WARC = """
WITH p AS (SELECT page_id, coalesce(html, '') AS body FROM pages),
d AS (SELECT page_id, CAST(strlen(body) AS BIGINT) AS payload_bytes, sha256(body) AS payload_digest FROM p),
f AS (SELECT payload_digest, min(page_id) AS first_id FROM d WHERE payload_bytes >= 100 GROUP BY payload_digest)
SELECT page_id, payload_bytes, payload_digest, CASE WHEN page_id IS DISTINCT FROM first_id AND first_id IS NOT NULL THEN 'revisit' ELSE 'response' END AS record_type,
  CASE WHEN page_id IS DISTINCT FROM first_id THEN first_id END AS refers_to
FROM d LEFT JOIN f USING (payload_digest)
"""

FILL_MIDDLE = r"""
WITH d AS (
  SELECT doc_id, coalesce(text, '') AS t, regexp_extract_all(coalesce(text, ''), '[\x20\x09-\x0D]*[^\x20\x09-\x0D]+|[\x20\x09-\x0D]+') AS u,
    sha256('42:' || coalesce(CAST(doc_id AS VARCHAR), '')) AS h
  FROM documents),
x AS (
  SELECT doc_id, t, u, CAST(len(u) AS BIGINT) AS n, CAST('0x' || h[1:8] AS BIGINT) AS h1, CAST('0x' || h[9:16] AS BIGINT) AS h2,
    CAST('0x' || h[17:24] AS BIGINT) AS h3, CAST('0x' || h[25:32] AS BIGINT) AS h4
  FROM d),
c AS (
  SELECT *, least(h1 % (n + 1), h2 % (n + 1)) AS a, greatest(h1 % (n + 1), h2 % (n + 1)) AS b,
    CASE WHEN t = '' OR contains(t, '<P>') OR contains(t, '<S>') OR contains(t, '<M>') OR h3 % 100 >= 50 THEN 'plain' WHEN h4 % 100 < 80 THEN 'spm' ELSE 'psm' END AS form
  FROM x),
p AS (SELECT *, array_to_string(u[1:a], '') AS prefix, array_to_string(u[a + 1:b], '') AS middle, array_to_string(u[b + 1:n], '') AS suffix FROM c)
SELECT doc_id, n, form, CASE WHEN form <> 'plain' THEN CAST(length(prefix) AS BIGINT) END AS prefix_chars,
  CASE WHEN form <> 'plain' THEN CAST(length(middle) AS BIGINT) END AS middle_chars,
  sha256(CASE form WHEN 'plain' THEN t WHEN 'psm' THEN '<P>' || prefix || '<S>' || suffix || '<M>' || middle ELSE '<S>' || suffix || '<P>' || prefix || '<M>' || middle END) AS output_sha256,
  sha256(t) AS restored_sha256
FROM p
"""

def _vector_codes(rounds: int = 4, scale: int = 1024, entries: int = 256) -> str:
    assign = (
        "SELECT row, label, p, e, d FROM (SELECT parts.row, any_value(parts.label) AS label, parts.p, {book}.e, CAST(sum((x - c) * (x - c)) AS BIGINT) AS d "
        "FROM parts JOIN {book} ON parts.p = {book}.p AND parts.k = {book}.k GROUP BY parts.row, parts.p, {book}.e) "
        "QUALIFY row_number() OVER (PARTITION BY row, p ORDER BY d, e) = 1")
    steps = []
    for r in range(1, rounds + 1):
        steps.append(f"a{r} AS MATERIALIZED ({assign.format(book=f'b{r - 1}')})")
        steps.append(
            f"m{r} AS MATERIALIZED (SELECT p, e, k, CAST(floor(CAST(sum(x) AS DOUBLE) / count(*)) AS BIGINT) AS c FROM a{r} JOIN parts USING (row, p) GROUP BY p, e, k)")
        steps.append(f"b{r} AS MATERIALIZED (SELECT b{r - 1}.p, b{r - 1}.e, b{r - 1}.k, coalesce(m{r}.c, b{r - 1}.c) AS c FROM b{r - 1} LEFT JOIN m{r} USING (p, e, k))")
    return f"""
WITH v AS MATERIALIZED (
  SELECT vec_id, label, row_number() OVER (ORDER BY vec_id NULLS LAST, v) AS row, v FROM (
    SELECT vec_id, label, list_transform(embedding, lambda x: CAST(floor({scale} * CAST(x AS DOUBLE)) AS BIGINT)) AS v
    FROM embeddings
    WHERE len(embedding) > 0 AND NOT list_contains(list_transform(embedding, lambda x: x IS NULL OR NOT isfinite(x)), true))),
c AS (SELECT row, label, len(v) // 4 AS w, generate_subscripts(v, 1) - 1 AS i, unnest(v) AS x FROM v),
parts AS MATERIALIZED (SELECT row, label, i // w AS p, i % w AS k, x FROM c),
b0 AS MATERIALIZED (SELECT p, row - 1 AS e, k, x AS c FROM parts WHERE row <= {entries}),
{', '.join(steps)},
done AS MATERIALIZED ({assign.format(book=f'b{rounds}')}),
codes AS (SELECT row, string_agg(format('{{:02x}}', e), '' ORDER BY p) AS code, CAST(sum(d) AS BIGINT) AS error FROM done GROUP BY row),
books AS (SELECT sha256(string_agg(CAST(c AS VARCHAR), ',' ORDER BY p, e, k)) AS codebooks_sha256 FROM b{rounds})
SELECT vec_id, code, error, CAST(sum(error) OVER (PARTITION BY label) AS BIGINT) AS label_error, codebooks_sha256
FROM codes JOIN v USING (row), books
"""


VECTOR_CODES = _vector_codes()

ORACLES = {"op7_top_k_search": TOP_K, "op8_decontamination": DECONTAMINATION, "op9_warc": WARC, "op11_vector_codes": VECTOR_CODES, "op13_fill_in_middle": FILL_MIDDLE}
