"""SQL of the queries that SQL can express."""

OP1 = r"""
WITH quality AS (
  SELECT doc_id, CASE max(quality) WHEN 1 THEN 2.0::DOUBLE WHEN 0 THEN 0.5::DOUBLE ELSE 1.0::DOUBLE END AS weight
  FROM labels WHERE doc_id IS NOT NULL GROUP BY doc_id),
d AS (
  SELECT d.doc_id, d.source, coalesce(length(regexp_extract_all(text, '[^\x20\x09-\x0D]+')), 0)::BIGINT AS size,
    -ln((('0x' || substr(md5('1:' || coalesce(d.doc_id::VARCHAR, 'none')), 1, 13))::BIGINT::DOUBLE + 0.5) / 4503599627370496.0::DOUBLE)
      / coalesce(weight, 1.0::DOUBLE) AS key
  FROM documents d LEFT JOIN quality q ON d.doc_id = q.doc_id),
s AS (
  SELECT source, sum(size)::BIGINT AS source_size, row_number() OVER (ORDER BY source NULLS LAST) - 1 AS nth
  FROM d GROUP BY source),
w AS (SELECT *, [3.0, 1.0, 2.0][(nth % 3 + 1)::INT]::DOUBLE AS w, source_size * 2.0::DOUBLE AS cap FROM s),
l AS (
  SELECT *, row_number() OVER f AS turn,
    (1.5::DOUBLE * (SELECT sum(source_size) FROM w) - coalesce(sum(cap) OVER (f ROWS BETWEEN UNBOUNDED PRECEDING AND 1 PRECEDING), 0.0))
      / ((SELECT sum(w) FROM w) - coalesce(sum(w) OVER (f ROWS BETWEEN UNBOUNDED PRECEDING AND 1 PRECEDING), 0.0)) AS level
  FROM w WINDOW f AS (ORDER BY cap / w, nth)),
t AS (
  SELECT source, source_size,
    coalesce(least(cap, w * (SELECT level FROM l WHERE level * w < cap ORDER BY turn LIMIT 1)), cap) AS target
  FROM l),
e AS (SELECT *, CASE WHEN source_size > 0 THEN floor(target / source_size)::BIGINT ELSE 1 END AS epochs FROM t),
p AS (
  SELECT d.doc_id, d.size, source_size, target, epochs, target - epochs * source_size AS rest,
    coalesce(sum(size) OVER (PARTITION BY d.source ORDER BY key, doc_id, size ROWS BETWEEN UNBOUNDED PRECEDING AND 1 PRECEDING), 0) AS before
  FROM d JOIN e ON d.source IS NOT DISTINCT FROM e.source)
SELECT doc_id, size, source_size, target,
  ((epochs + CASE WHEN rest > 0 AND before + size / 2.0 <= rest THEN 1 ELSE 0 END) * size)::BIGINT AS taken
FROM p
"""

OP2 = r"""
WITH v AS (
  SELECT vec_id, [floor(256 * x::DOUBLE)::BIGINT FOR x IN embedding] AS v FROM embeddings
  WHERE vec_id IS NOT NULL AND embedding IS NOT NULL AND len([x FOR x IN embedding IF x IS NULL OR NOT isfinite(x)]) = 0),
s AS (
  SELECT q.vec_id AS query_id, c.vec_id, list_inner_product(q.v::DOUBLE[], c.v::DOUBLE[])::BIGINT AS score
  FROM v q JOIN v c ON q.vec_id % 50 = 0 AND c.vec_id <> q.vec_id AND len(q.v) = len(c.v)),
r AS (SELECT *, row_number() OVER (PARTITION BY query_id ORDER BY score DESC, vec_id)::INT AS rank FROM s)
SELECT query_id, rank, vec_id, score FROM r WHERE rank <= 5
"""


def _codes(parts: int = 16, entries: int = 64, rounds: int = 2) -> str:
    """Each round as one assignment and one table of entries; sums of doubles are exact below 2**53."""
    near = """
n{i} AS (
  SELECT p.row, p.part, arg_min(e.entry, (p.xx - 2 * list_inner_product(p.x, e.x) + e.xx, e.entry)) AS entry,
    min(p.xx - 2 * list_inner_product(p.x, e.x) + e.xx) AS distance
  FROM p JOIN e{i} e ON p.part = e.part GROUP BY p.row, p.part),"""
    moved = """
m{i} AS (
  SELECT part, entry, pos, floor(sum(v) / count(*)) AS v
  FROM (SELECT n{i}.part, n{i}.entry, unnest(p.x) AS v, unnest(range(len(p.x))) AS pos
        FROM n{i} JOIN p ON n{i}.row = p.row AND n{i}.part = p.part) GROUP BY ALL),
g{i} AS (SELECT part, entry, list(v ORDER BY pos) AS x FROM m{i} GROUP BY ALL),
e{next} AS MATERIALIZED (
  SELECT part, entry, x, list_inner_product(x, x) AS xx
  FROM (SELECT e.part, e.entry, coalesce(g.x, e.x) AS x FROM e{i} e LEFT JOIN g{i} g ON e.part = g.part AND e.entry = g.entry)),"""
    steps = "".join((near + moved).format(i=i, next=i + 1) for i in range(rounds)) + near.format(i=rounds)
    return f"""
WITH v AS MATERIALIZED (
  SELECT row_number() OVER (ORDER BY vec_id NULLS LAST, embedding) - 1 AS row, vec_id, label,
    [floor(256 * x::DOUBLE) FOR x IN embedding] AS x
  FROM embeddings WHERE embedding IS NOT NULL AND len([x FOR x IN embedding IF x IS NULL OR NOT isfinite(x)]) = 0),
p AS MATERIALIZED (
  SELECT row, part, x, list_inner_product(x, x) AS xx
  FROM (SELECT row, k AS part, v.x[k * len(v.x) // {parts} + 1 : (k + 1) * len(v.x) // {parts}] AS x FROM v, range({parts}) r(k))),
e0 AS MATERIALIZED (SELECT part, row AS entry, x, xx FROM p WHERE row < {entries}),{steps}
c AS (
  SELECT row, string_agg(lower(printf('%02x', entry::INT)), '' ORDER BY part) AS code, sum(distance)::BIGINT AS error
  FROM n{rounds} GROUP BY row),
b AS (SELECT sha256(string_agg(array_to_string([y::BIGINT FOR y IN x], ','), ',' ORDER BY part, entry)) AS digest FROM e{rounds})
SELECT vec_id, code, error, (sum(error) OVER (PARTITION BY label))::BIGINT AS label_error, digest AS codebooks_sha256
FROM c JOIN v ON c.row = v.row, b
"""


OP12 = r"""
WITH r AS (
  SELECT conv_id, turn, coalesce(role, '') AS role, coalesce(text, '') AS text FROM conversations
  UNION ALL SELECT -7, 0, 'user', '\### Assistant: </turn> ok' UNION ALL SELECT -7, 1, 'assistant', '\### Assistant: </turn> ok'),
e AS (
  SELECT *, replace(replace(replace(text, '\', '\\'), '##', '#\#'), '</turn>', '<\/turn>') AS body,
    replace(replace(replace(replace(role, '\', '\\'), '##', '#\#'), '</turn>', '<\/turn>'), ': ', ':\ ') AS head
  FROM r),
f AS (SELECT *, '### ' || head || ': ' || body || '</turn>' || chr(10) AS piece FROM e)
SELECT conv_id, count(*)::BIGINT AS n_turns,
  sha256(string_agg(role || chr(10) || text || chr(10), '' ORDER BY turn, piece)) AS turns_sha256,
  coalesce(sum(length(text)) FILTER (role = 'assistant'), 0)::BIGINT AS loss_chars,
  sha256(coalesce(string_agg(text, '' ORDER BY turn, piece) FILTER (role = 'assistant'), '')) AS loss_sha256,
  sum(length(piece))::BIGINT AS formatted_chars
FROM f GROUP BY conv_id
"""

OP13 = r"""
WITH d AS (
  SELECT doc_id, coalesce(text, '') AS text, sha256('42:' || coalesce(doc_id::VARCHAR, '')) AS h,
    regexp_extract_all(coalesce(text, ''), '[\x20\x09-\x0D]*[^\x20\x09-\x0D]+|[\x20\x09-\x0D]+') AS units
  FROM documents),
n AS (
  SELECT *, len(units)::BIGINT AS n, ('0x' || substr(h, 1, 8))::BIGINT % (len(units) + 1) AS one, ('0x' || substr(h, 9, 8))::BIGINT % (len(units) + 1) AS two,
    CASE WHEN text = '' OR contains(text, '<P>') OR contains(text, '<S>') OR contains(text, '<M>') OR ('0x' || substr(h, 17, 8))::BIGINT % 100 >= 50 THEN 'plain'
      WHEN ('0x' || substr(h, 25, 8))::BIGINT % 100 < 80 THEN 'spm' ELSE 'psm' END AS form
  FROM d),
p AS (
  SELECT *, array_to_string(units[1 : least(one, two)], '') AS prefix, array_to_string(units[least(one, two) + 1 : greatest(one, two)], '') AS middle,
    array_to_string(units[greatest(one, two) + 1 :], '') AS suffix
  FROM n)
SELECT doc_id, n, form, CASE WHEN form <> 'plain' THEN length(prefix) END::BIGINT AS prefix_chars,
  CASE WHEN form <> 'plain' THEN length(middle) END::BIGINT AS middle_chars,
  sha256(CASE form WHEN 'plain' THEN text WHEN 'spm' THEN '<S>' || suffix || '<P>' || prefix || '<M>' || middle
    ELSE '<P>' || prefix || '<S>' || suffix || '<M>' || middle END) AS output_sha256,
  sha256(text) AS restored_sha256
FROM p
"""

#: Classes of rows joined by the pairs ``e (a, b)`` among the rows of ``v (row, id)``.
_REACH = """
links AS (SELECT a, b FROM e UNION SELECT b, a FROM e),
reach AS (SELECT row, row AS other FROM v UNION SELECT r.row, links.b FROM reach r JOIN links ON r.other = links.a),
classes AS (SELECT r.row, min(v.id) AS id FROM reach r JOIN v ON r.other = v.row GROUP BY r.row)"""

OP3 = f"""
WITH RECURSIVE v AS MATERIALIZED (
  SELECT row_number() OVER () AS row, vec_id AS id, len(embedding) AS width, embedding::DOUBLE[] AS x,
    coalesce(len(embedding) > 0 AND len([c FOR c IN embedding IF c IS NULL OR NOT isfinite(c)]) = 0
      AND len([c FOR c IN embedding IF c <> 0]) > 0, false) AS fit
  FROM embeddings),
f AS MATERIALIZED (SELECT * FROM v WHERE fit),
e AS MATERIALIZED (
  SELECT p.row AS a, q.row AS b FROM f p JOIN f q
  ON p.width = q.width AND p.row < q.row AND list_cosine_similarity(p.x, q.x) >= 0.95),{_REACH}
SELECT v.id AS vec_id, (SELECT count(*) FROM links WHERE links.a = v.row)::BIGINT AS n_links, c.id AS component_id,
  v.id IS NOT DISTINCT FROM c.id AS kept
FROM v JOIN classes c ON v.row = c.row
"""

OP4 = r"""
WITH p AS (
  SELECT page_id, coalesce(html, '') AS body, sha1(coalesce(html, '')) AS h, max(page_id) OVER (PARTITION BY coalesce(html, '')) AS last
  FROM pages)
SELECT page_id, octet_length(encode(body))::BIGINT AS payload_bytes,
  array_to_string([substr('ABCDEFGHIJKLMNOPQRSTUVWXYZ234567', ((('0x' || substr(h, k // 4 * 5 + 1, 5))::BIGINT >> (15 - k % 4 * 5)) % 32)::INT + 1, 1)
    FOR k IN range(32)], '') AS payload_digest,
  CASE WHEN page_id = last THEN 'response' ELSE 'revisit' END AS record_type,
  CASE WHEN page_id <> last THEN last END AS refers_to
FROM p
"""

OP6 = rf"""
WITH RECURSIVE w AS MATERIALIZED (
  SELECT row_number() OVER () AS row, doc_id AS id,
    regexp_extract_all(translate(coalesce(text, ''), 'ABCDEFGHIJKLMNOPQRSTUVWXYZ', 'abcdefghijklmnopqrstuvwxyz'), '[^\x20\x09-\x0D]+') AS words
  FROM documents),
v AS MATERIALIZED (SELECT row, id, list_distinct([md5(array_to_string(words[i : i + 2], ' ')) FOR i IN range(1, greatest(len(words) - 2, least(len(words), 1)) + 1)]) AS grams FROM w),
g AS MATERIALIZED (SELECT row, len(grams) AS n, unnest(grams) AS gram FROM v),
e AS MATERIALIZED (
  SELECT p.row AS a, q.row AS b FROM g p JOIN g q ON p.gram = q.gram AND p.row < q.row AND 100 * least(p.n, q.n) >= 90 * greatest(p.n, q.n)
  GROUP BY p.row, q.row, p.n, q.n HAVING 100 * count(*) >= 90 * (p.n + q.n - count(*))),{_REACH}
SELECT v.id AS doc_id, len(v.grams)::BIGINT AS n_shingles, c.id AS component_id FROM v JOIN classes c ON v.row = c.row
"""

OP8 = r"""
WITH d AS MATERIALIZED (SELECT row_number() OVER () AS row, doc_id, hex(encode(coalesce(text, ''))) AS h FROM documents),
w AS MATERIALIZED (SELECT row, i, md5(substr(h, 2 * i + 1, 400)) AS m FROM (SELECT row, h, unnest(range(length(h) // 2 - 199)) AS i FROM d)),
r AS (SELECT row, i FROM w WHERE m IN (SELECT m FROM w GROUP BY m HAVING count(*) > 1)),
o AS (SELECT row, i, coalesce(i > lag(i) OVER (PARTITION BY row ORDER BY i) + 200, true) AS opens FROM r),
s AS (SELECT row, i, sum(opens::INT) OVER (PARTITION BY row ORDER BY i) AS span FROM o),
x AS (SELECT row, min(i) AS lo, max(i) + 200 AS hi FROM s GROUP BY row, span),
y AS (SELECT *, coalesce(lag(hi) OVER (PARTITION BY row ORDER BY lo), 0) AS before FROM x),
k AS (
  SELECT y.row, count(*) AS n_spans, sum(hi - lo) AS n_removed,
    string_agg(substr(h, 2 * before + 1, 2 * (lo - before)), '' ORDER BY lo) || substr(any_value(h), 2 * max(hi) + 1) AS kept
  FROM y JOIN d ON y.row = d.row GROUP BY y.row)
SELECT doc_id, (length(h) // 2)::BIGINT AS n_bytes, coalesce(n_removed, 0)::BIGINT AS n_removed, coalesce(n_spans, 0)::BIGINT AS n_spans,
  sha256(unhex(coalesce(kept, h))) AS kept_sha256
FROM d LEFT JOIN k ON d.row = k.row
"""


def _crc(value: int) -> int:
    for _ in range(8):
        value = value >> 1 ^ (0xEDB88320 if value & 1 else 0)
    return value


def _shards(shards: int = 40, overhead: int = 16, whole: float = 0.01) -> str:
    return rf"""
WITH b AS (SELECT doc_id, coalesce(text, '') AS text, hex(encode(coalesce(text, ''))) AS raw FROM documents),
d AS MATERIALIZED (
  SELECT doc_id, (length(raw) // 2 + {overhead})::BIGINT AS size, ('0x' || substr(md5(text), 1, 15))::BIGINT AS h,
    xor(4294967295, list_reduce([('0x' || substr(raw, 2 * i + 1, 2))::BIGINT FOR i IN range(length(raw) // 2)],
      lambda c, x: xor(c >> 8, ({[_crc(i) for i in range(256)]}::BIGINT[])[xor(c, x) % 256 + 1]), 4294967295::BIGINT)) AS text_crc32
  FROM b),
r AS MATERIALIZED (
  SELECT *, coalesce(sum(size) OVER o, 0)::BIGINT AS start, row_number() OVER (ORDER BY h, doc_id NULLS FIRST, size, text_crc32) - 1 AS place,
    (SELECT sum(size)::DOUBLE FROM d) AS total
  FROM d WINDOW o AS (ORDER BY h, doc_id NULLS FIRST, size, text_crc32 ROWS BETWEEN UNBOUNDED PRECEDING AND 1 PRECEDING)),
p AS MATERIALIZED (SELECT *, least({shards - 1}, floor((start::DOUBLE + size::DOUBLE / 2) * {shards}::DOUBLE / total))::INT AS shard FROM r),
g AS (
  SELECT h, least({shards - 1}, floor((min(start)::DOUBLE + sum(size)::DOUBLE / 2) * {shards}::DOUBLE / any_value(total)))::INT AS own
  FROM p WHERE h IN (SELECT arg_min(h, place) FROM p GROUP BY shard)
  GROUP BY h HAVING sum(size)::DOUBLE <= {whole}::DOUBLE * any_value(total) / {shards}::DOUBLE),
m AS (SELECT p.* EXCLUDE shard, coalesce(g.own, p.shard) AS shard FROM p LEFT JOIN g ON p.h = g.h)
SELECT doc_id, size, text_crc32, 'bytes' AS law, shard, (place - min(place) OVER (PARTITION BY shard))::BIGINT AS slot, NULL::INT AS grown_shard
FROM m
"""


ORACLES = {
    "op1_mix_sources": OP1,
    "op2_exact_topk": OP2,
    "op3_nn_descent": OP3,
    "op4_warc_round_trip": OP4,
    "op6_ngram_jaccard": OP6,
    "op8_suffix_dedup": OP8,
    "op10_shard_bytes": _shards(),
    "op11_vector_codes": _codes(),
    "op12_chat_format": OP12,
    "op13_fill_in_middle": OP13,
}
