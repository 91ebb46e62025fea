"""SQL for each registered query, in the dialect of the checking engine."""

# Fixed value: the whitespace class of tessella.functions.strings in RE2 syntax.
_SPACE = r"[\t-\r\x1c-\x1f\x{85}\p{Z}]+"

_DOC_WORDS = rf"""
doc_words AS (
  SELECT doc_id, word FROM (
    SELECT doc_id, unnest(regexp_split_to_array(lower(text), '{_SPACE}')) AS word FROM documents)
  WHERE word <> '')"""

_WORD_SETS = rf"""{_DOC_WORDS},
turn_words AS (
  SELECT word FROM (
    SELECT unnest(regexp_split_to_array(lower(text), '{_SPACE}')) AS word FROM conversations)
  WHERE word <> ''),
members AS (
  SELECT word AS element, 'R' AS label FROM doc_words
  UNION ALL SELECT word, 'S' FROM turn_words)"""

# Fixed value: word characters of tessella.functions.strings in RE2 syntax.
_WORD = r"[\p{L}\p{N}_]"

_BLOG_FILES = rf"""
stems AS (
  SELECT item_id, unnest(regexp_extract_all(lower(text), '{_WORD}+') || regexp_extract_all(lower(text), '{_WORD}+[ -]{_WORD}+')) AS term
  FROM benchmark),
blog_files AS (
  SELECT 'b' || item_id || '.x.y.' || term || '.z.xml' AS file_name, term FROM stems)"""

_POSTS = r"""
lines AS (
  SELECT doc_id, unnest(string_split(text, chr(10))) AS line,
         generate_subscripts(string_split(text, chr(10)), 1) - 1 AS pos
  FROM documents),
dated AS (
  SELECT 'doc.' || doc_id AS file_name,
         DATE '2004-01-01' + CAST((doc_id * 3 + pos) % 1461 AS INTEGER) AS day,
         replace(line, '<', ' ') AS body
  FROM lines),
posts AS (
  SELECT file_name, strftime(day, '%Y') AS year, strftime(day, '%B') AS month, body FROM dated)"""

# Every word is put between two marks, in bodies and terms: what a marked body holds of a marked
# term are whole words.  A post is compared with the terms whose first and last word it holds side
# by side, and what replacing the term takes away counts its mentions.
_MENTIONS = rf"""{_BLOG_FILES},{_POSTS},
numbered AS (
  SELECT row_number() OVER () AS post, year || '-' || month AS year_month, lower(body) AS body FROM posts),
words AS MATERIALIZED (SELECT post, regexp_extract_all(body, '{_WORD}+') AS w FROM numbered),
terms AS MATERIALIZED (
  SELECT term, w[1] AS one, w[2] AS two, regexp_replace(term, '({_WORD}+)', chr(57344) || '\1' || chr(57345), 'g') AS key
  FROM (SELECT DISTINCT term, regexp_extract_all(term, '{_WORD}+') AS w FROM blog_files WHERE term <> '')),
pairs AS MATERIALIZED (
  SELECT post, unnest(w) AS one, unnest(w[2:] || [NULL]) AS two FROM words WHERE len(w) > 0),
near AS (
  SELECT post, term, key FROM pairs JOIN terms ON pairs.one = terms.one WHERE terms.two IS NULL
  UNION
  SELECT post, term, key FROM pairs JOIN terms ON pairs.one = terms.one AND pairs.two = terms.two),
marked AS (SELECT post, year_month, regexp_replace(body, '({_WORD}+)', chr(57344) || '\1' || chr(57345), 'g') AS body FROM numbered),
mentions AS (
  SELECT year_month, term, n FROM (
    SELECT year_month, term, CAST(sum((length(body) - length(replace(body, key, ''))) // length(key)) AS BIGINT) AS n
    FROM near JOIN marked ON near.post = marked.post GROUP BY year_month, term)
  WHERE n > 0)"""

_GRAY = """
gray AS (
  SELECT vec_id, (i - 1) // 8 AS r, (i - 1) % 8 AS c, CAST(floor((CAST(x AS DOUBLE) + 1) * 127.5e0) AS INTEGER) AS v
  FROM (SELECT vec_id, unnest(embedding) AS x, generate_subscripts(embedding, 1) AS i FROM embeddings))"""

_TILES = f"""{_GRAY},
tiles AS (
  SELECT CAST(vec_id AS VARCHAR) AS image, CAST(r // 4 AS INTEGER) AS row, CAST(c // 4 AS INTEGER) AS col,
         vec_id || '-' || ((r // 4) * 2 + c // 4) AS tile_id,
         string_agg(CAST(v AS VARCHAR), ',' ORDER BY r, c) AS cells,
         max(CASE WHEN r % 4 = 0 AND c % 4 = 0 THEN v END) AS cell
  FROM gray GROUP BY ALL)"""


def _signs(grid: str, width: int, height: int) -> str:
    """CTEs ``row_signs`` and ``col_signs`` of a long grid (vec_id, r, c, v)."""

    def sign(over: str) -> str:
        d = f"(lead(v) OVER ({over}) - v)"
        return f"CASE WHEN {d} > 1 THEN 1 WHEN {d} < -1 THEN -1 ELSE 0 END"

    return f"""
row_signs AS (
  SELECT vec_id, pos, s FROM (
    SELECT vec_id, c, CAST(r * {width - 1} + c AS INTEGER) AS pos,
           CAST({sign("PARTITION BY vec_id, r ORDER BY c")} AS TINYINT) AS s FROM {grid})
  WHERE c < {width - 1}),
col_signs AS (
  SELECT vec_id, pos, s FROM (
    SELECT vec_id, r, CAST(r * {width} + c AS INTEGER) AS pos,
           CAST({sign("PARTITION BY vec_id, c ORDER BY r")} AS TINYINT) AS s FROM {grid})
  WHERE r < {height - 1}),
feat AS (
  SELECT vec_id, list(s ORDER BY part, pos) AS f FROM (
    SELECT vec_id, 0 AS part, pos, s FROM row_signs UNION ALL SELECT vec_id, 1, pos, s FROM col_signs)
  GROUP BY vec_id)"""


_FEAT = _GRAY + "," + _signs("gray", 8, 8)

_HALF = """
half AS (
  SELECT vec_id, r // 2 AS r, c // 2 AS c, sum(v) / 4.0e0 AS v FROM gray GROUP BY 1, 2, 3)"""

# What is wrong with an archive, by the last digit of its id.
_WRONG = """CASE vec_id % 10
    WHEN 4 THEN 'not uint8 rows x columns x channels' WHEN 5 THEN 'not a zip archive' WHEN 6 THEN 'does not fit the tiles or blocks'
    WHEN 7 THEN 'too few channels' WHEN 8 THEN 'no member with the suffix' WHEN 9 THEN 'does not decode' END"""

# Images of 4 x 4 pixels of four channels; tiles of 2 x 2 pixels.
_PIXELS = f"""{_GRAY},
channels AS (
  SELECT vec_id, (r * 8 + c) // 16 AS y, (r * 8 + c) // 4 % 4 AS x, (r * 8 + c) % 4 AS ch, greatest(least(v, 255), 0) AS v FROM gray),
tiled AS (
  SELECT *, 'e' || vec_id || '.zip' AS image, CAST(y // 2 AS INTEGER) AS row, CAST(x // 2 AS INTEGER) AS col,
         'e' || vec_id || '.zip-' || (y // 2 * 2 + x // 2) AS tile_id
  FROM channels WHERE vec_id % 10 NOT IN (4, 5, 6, 8, 9) AND NOT (vec_id % 10 = 7 AND ch = 3))"""


def _sign(difference: str) -> str:
    return f"CASE WHEN {difference} > 1 THEN 1 WHEN {difference} < -1 THEN -1 ELSE 0 END"


def _bits(feat: str, n: int, m: int) -> str:
    """CTE ``bits`` of the CTE ``feat``: ``n`` features, ``m`` bits."""
    step = n // m
    if n % m == 0:
        chunks = f"""
  SELECT vec_id, i, '[' || array_to_string(f[i * {step} + 1 : (i + 1) * {step}], ', ') || ']' AS s FROM feat, range({m}) t(i)"""
    else:  # half of the chunks forward, half backward, which end one before the last
        chunks = f"""
  SELECT vec_id, i, '[' || array_to_string(f[i * {2 * step} + 1 : (i + 1) * {2 * step}], ', ') || ']' AS s
  FROM feat, range({m // 2}) t(i)
  UNION ALL
  SELECT vec_id, i + {m // 2}, '[' || array_to_string(f[{n} - (i + 1) * {2 * step} : {n - 1} - i * {2 * step}], ', ') || ']'
  FROM feat, range({m // 2}) t(i)"""
    return f"""{feat},
chunks AS ({chunks}),
bits AS (
  SELECT vec_id, i, CAST(substr(ltrim(bin(CAST('0x' || md5(s) AS UHUGEINT)), '0'), 63, 1) AS INTEGER) AS bit
  FROM chunks)"""


_BITS = _bits(_FEAT, 112, 32)

_EXEMPLARS = "exemplars AS (SELECT min(vec_id) AS vec_id FROM embeddings GROUP BY label)"


def _buckets(b: int, m: int = 32) -> str:
    return f"""
  SELECT vec_id, CAST(i // {b} AS INTEGER) AS band, CAST(sum(bit * (1 << ({b - 1} - i % {b}))) AS BIGINT) AS bucket
  FROM bits WHERE i < {m // b * b} GROUP BY 1, 2"""


def _matches(bits: str, m: int) -> str:
    return f"""{bits},
{_EXEMPLARS},
buckets AS ({_buckets(8, m)}),
matches AS (
  SELECT DISTINCT o.vec_id AS candidate, b.vec_id
  FROM buckets b JOIN (SELECT * FROM buckets WHERE vec_id IN (SELECT vec_id FROM exemplars)) o
    USING (band, bucket))"""


_MATCHES = _matches(_BITS, 32)


def _similar(matches: str, n: int, seed: int) -> str:
    """Ranked distances in the space that the z-scored rows of a sample of ``n`` span.

    With Z the sample, G = Z Z' and w = Z (x - c), the squared length of the part of x - c in that
    space is w' H w, H the inverse of G on a largest independent set of rows and zero elsewhere.
    One step of elimination a row: a row whose pivot vanishes depends on those before it and goes.
    No singular vectors are computed.
    """
    return f"""
WITH RECURSIVE {matches},
drawn AS (
  SELECT f, row_number() OVER (ORDER BY md5(vec_id || ':{seed}'), vec_id) AS i
  FROM feat WHERE vec_id IN (SELECT vec_id FROM matches) QUALIFY i <= {n}),
cells AS (SELECT i, unnest(f) AS x, generate_subscripts(f, 1) AS pos FROM drawn),
stats AS (SELECT pos, avg(x) AS mean, stddev_pop(x) AS sd FROM cells GROUP BY pos),
z AS MATERIALIZED (
  SELECT i, list((x - mean) / CASE WHEN sd = 0 THEN 1 ELSE sd END ORDER BY pos) AS z
  FROM cells JOIN stats USING (pos) GROUP BY i),
size AS (SELECT CAST(count(*) AS INTEGER) AS n FROM z),
gram AS (SELECT a.i, list(list_inner_product(a.z, b.z) ORDER BY b.i) AS g FROM z a, z b GROUP BY a.i),
augmented AS (SELECT list(g || [CASE WHEN j = i THEN 1e0 ELSE 0e0 END FOR j IN range(1, n + 1)] ORDER BY i) AS m FROM gram, size),
steps AS (
  SELECT 0 AS k, m FROM augmented
  UNION ALL
  SELECT k + 1, [CASE WHEN i = k + 1 THEN p ELSE [r[j] - r[k + 1] * p[j] FOR j IN range(1, len(r) + 1)] END FOR r, i IN m]
  FROM (SELECT k, m, CASE WHEN m[k + 1][k + 1] > 1e-9 THEN [x / m[k + 1][k + 1] FOR x IN m[k + 1]] ELSE [0 * x FOR x IN m[k + 1]] END AS p FROM steps)
  WHERE k < len(m)),
inverse AS (SELECT [r[n + 1 :] FOR r IN m] AS h FROM steps, size WHERE k = n),
seen AS MATERIALIZED (
  SELECT vec_id, list(list_inner_product(z, CAST(f AS DOUBLE[])) ORDER BY i) AS p
  FROM feat, z WHERE vec_id IN (SELECT vec_id FROM matches) GROUP BY vec_id),
apart AS (
  SELECT candidate, m.vec_id, [a - b.p[i] FOR a, i IN o.p] AS w
  FROM matches m JOIN seen o ON m.candidate = o.vec_id JOIN seen b ON m.vec_id = b.vec_id),
distances AS (
  SELECT candidate, vec_id, round(sqrt(greatest(list_inner_product(w, [list_inner_product(r, w) FOR r IN h]), 0)), 6) + 0 AS distance
  FROM apart, inverse)
SELECT candidate, vec_id, distance,
       CAST(row_number() OVER (PARTITION BY candidate ORDER BY distance, vec_id) AS INTEGER) AS rank
FROM distances"""

_DISTANCES = f"""{_MATCHES},
cells AS (
  SELECT vec_id, unnest(embedding) AS x, generate_subscripts(embedding, 1) AS i FROM embeddings),
distances AS (
  SELECT candidate, m.vec_id,
         round(sqrt(sum((CAST(a.x AS DOUBLE) - b.x) * (CAST(a.x AS DOUBLE) - b.x))), 6) + 0 AS distance
  FROM matches m JOIN cells a ON a.vec_id = m.candidate JOIN cells b ON b.vec_id = m.vec_id AND b.i = a.i
  GROUP BY 1, 2),
ranked AS (
  SELECT candidate, vec_id, distance,
         CAST(row_number() OVER (PARTITION BY candidate ORDER BY distance, vec_id) AS INTEGER) AS rank
  FROM distances)"""

_FEATURE_TEXT = "array_to_string(f, ',') AS features"

ORACLES: dict[str, str] = {
    "tokens": rf"""
        SELECT doc_id, word FROM (
          SELECT doc_id, unnest(regexp_split_to_array(text, '{_SPACE}')) AS word FROM documents)
        WHERE word <> ''""",
    "word_count": f"WITH {_DOC_WORDS} SELECT word, count(*) AS n FROM doc_words GROUP BY word",
    "term_frequency": f"WITH {_DOC_WORDS} SELECT doc_id, word, count(*) AS n FROM doc_words GROUP BY doc_id, word",
    "word_count_from_tf": f"WITH {_DOC_WORDS} SELECT word, count(*) AS n FROM doc_words GROUP BY word",
    "map_reduce_word_count": f"WITH {_DOC_WORDS} SELECT word, count(*) AS n FROM doc_words GROUP BY word",
    "map_reduce_set_difference": f"""
        WITH {_WORD_SETS} SELECT element FROM members GROUP BY element HAVING count(*) = 1 AND min(label) = 'R'""",
    "key_bucket_report": f"""
        WITH {_DOC_WORDS}
        SELECT 'word' AS key,
               CAST(list_sum(list_transform(string_split(word, ''), lambda ch: unicode(ch))) % 3 AS INTEGER) AS bucket,
               count(*) AS n
        FROM doc_words GROUP BY 1, 2
        UNION ALL
        SELECT 'doc_id', CAST(doc_id % 7 AS INTEGER), count(*) FROM documents GROUP BY 1, 2""",
    "bernoulli_subset": """
        WITH keyed AS (
          SELECT 'R' AS label, c_custkey AS element, 0.5e0 AS p FROM customer
          UNION ALL SELECT 'S', o_orderkey, 0.75e0 FROM orders)
        SELECT label, element FROM keyed
        WHERE CAST('0x' || substr(md5(element || ':7'), 1, 8) AS UBIGINT) / 4294967296.0e0 > p""",
    "path_basename": "SELECT page_id, string_split(url, '/')[-1] AS base_name FROM pages",
    "name_field": f"WITH {_BLOG_FILES} SELECT file_name, string_split(file_name, '.')[4] AS field FROM blog_files",
    "vocabulary_distinct": f"WITH {_BLOG_FILES} SELECT DISTINCT term FROM blog_files WHERE term <> ''",
    "set_membership": f"WITH {_WORD_SETS} SELECT element, label FROM members",
    "labels_per_element": f"""
        WITH {_WORD_SETS}
        SELECT element, string_agg(DISTINCT label, ',' ORDER BY label) AS labels FROM members GROUP BY element""",
    "set_difference": """
        SELECT p_partkey || ':' || p_size AS element FROM part
        EXCEPT SELECT l_partkey || ':' || CAST(l_quantity AS INTEGER) FROM lineitem""",
    "set_difference_words": f"""
        WITH {_WORD_SETS} SELECT word AS element FROM doc_words EXCEPT SELECT word FROM turn_words""",
    "set_difference_once": f"""
        WITH {_WORD_SETS} SELECT element FROM members GROUP BY element HAVING count(*) = 1 AND min(label) = 'R'""",
    "split_records": r"""
        SELECT page_id, part FROM (SELECT page_id, unnest(string_split(html, '</p>')) AS part FROM pages)
        WHERE regexp_matches(part, '\S')""",
    "strip_markup": r"""
        SELECT page_id, regexp_replace(part, '<p>\s*', '', 'gi') AS part
        FROM (SELECT page_id, unnest(string_split(html, '</p>')) AS part FROM pages)
        WHERE regexp_matches(part, '\S')""",
    "strip_line_ends": "SELECT doc_id, replace(text, chr(10), '') AS text FROM documents",
    "post_fields": f"""
        WITH {_POSTS} SELECT file_name, year, month, body, year || '-' || month AS year_month FROM posts""",
    "rejected_posts": """
        SELECT 'doc.' || doc_id AS file_name, CAST(1 AS BIGINT) AS n FROM documents WHERE n_chars > 2000""",
    "term_mentions": f"WITH {_MENTIONS} SELECT year_month, term, n FROM mentions",
    "months_per_term": f"""
        WITH {_MENTIONS}
        SELECT term, string_agg(year_month || '=' || n, ';' ORDER BY year_month) AS months
        FROM mentions GROUP BY term""",
    "blog_industry_mentions": f"WITH {_MENTIONS} SELECT year_month, term, n FROM mentions",
    "tile_grid": f"WITH {_TILES} SELECT image, row, col, tile_id, cells FROM tiles",
    "tile_ids": f"WITH {_TILES} SELECT tile_id, image, CAST(row * 2 + col AS INTEGER) AS index FROM tiles",
    "select_tiles": f"""
        WITH {_TILES}, {_EXEMPLARS}
        SELECT tile_id, cells FROM tiles
        WHERE tile_id IN (SELECT vec_id || '-' || i FROM exemplars, (VALUES (0), (3)) t(i))""",
    "pixel_at": f"WITH {_TILES} SELECT tile_id, cell FROM tiles",
    "intensity": f"""
        WITH {_GRAY},
        pixels AS (
          SELECT vec_id, CAST((r * 8 + c) // 4 AS INTEGER) AS pos,
                 max(CASE WHEN c % 4 = 0 THEN v END) AS red, max(CASE WHEN c % 4 = 1 THEN v END) AS green,
                 max(CASE WHEN c % 4 = 2 THEN v END) AS blue, max(CASE WHEN c % 4 = 3 THEN v END) AS ir
          FROM gray GROUP BY 1, 2)
        SELECT vec_id, pos, CAST(trunc((red + green + blue) / 3.0e0 * ir / 100.0e0) AS INTEGER) AS v FROM pixels""",
    "block_mean": f"""
        WITH {_GRAY},{_HALF} SELECT vec_id, CAST(r * 4 + c AS INTEGER) AS pos, v FROM half""",
    "row_diff_sign": f"WITH {_FEAT} SELECT vec_id, pos, s FROM row_signs",
    "col_diff_sign": f"WITH {_FEAT} SELECT vec_id, pos, s FROM col_signs",
    "lifted_sign": f"WITH {_FEAT} SELECT vec_id, pos, s FROM row_signs",
    "tile_features": f"WITH {_FEAT} SELECT vec_id, {_FEATURE_TEXT} FROM feat",
    "reduced_features": f"""
        WITH {_GRAY},{_HALF},{_signs("half", 4, 4)} SELECT vec_id, {_FEATURE_TEXT} FROM feat""",
    "feature_lengths": f"WITH {_FEAT} SELECT CAST(len(f) AS INTEGER) AS length, count(*) AS n FROM feat GROUP BY 1",
    "archive_features": f"""
        WITH {_PIXELS},
        pixels AS (
          SELECT tile_id, y % 2 AS y, x % 2 AS x, trunc(sum(v) FILTER (ch < 3) / 3.0e0 * max(v) FILTER (ch = 3) / 100.0e0) AS v
          FROM tiled WHERE vec_id % 10 < 4 GROUP BY 1, 2, 3, tiled.y, tiled.x),
        corners AS (
          SELECT tile_id, max(v) FILTER (y = 0 AND x = 0) AS a, max(v) FILTER (y = 0 AND x = 1) AS b,
                 max(v) FILTER (y = 1 AND x = 0) AS c, max(v) FILTER (y = 1 AND x = 1) AS d
          FROM pixels GROUP BY 1)
        SELECT tile_id, CAST(1 AS INTEGER) AS block,
               concat_ws(',', {_sign("b - a")}, {_sign("d - c")}, {_sign("c - a")}, {_sign("d - b")}) AS features
        FROM corners
        UNION ALL SELECT tile_id, 2, '' FROM corners""",
    "archive_rejects": f"""
        SELECT 'e' || vec_id || '.zip' AS file_name, {_WRONG} AS reason FROM embeddings WHERE vec_id % 10 > 3""",
    "raster_tiles": f"""
        WITH {_PIXELS}
        SELECT image, row, col, tile_id, CAST(2 AS INTEGER) AS height, CAST(2 AS INTEGER) AS width, CAST(max(ch) + 1 AS INTEGER) AS channels,
               string_agg(printf('%02x', v), '' ORDER BY y, x, ch) AS cells, CAST(NULL AS VARCHAR) AS reason
        FROM tiled GROUP BY image, row, col, tile_id
        UNION ALL
        SELECT 'e' || vec_id || '.zip', NULL, NULL, NULL, NULL, NULL, NULL, NULL, {_WRONG}
        FROM embeddings WHERE vec_id % 10 IN (4, 5, 6, 8, 9)""",
    "raster_pixels": f"""
        WITH {_PIXELS}
        SELECT tile_id, string_agg(CAST(v AS VARCHAR), ',' ORDER BY ch) AS pixel
        FROM tiled WHERE y % 2 = 1 AND x % 2 = 0 GROUP BY tile_id""",
    "signature_bits": f"""
        WITH {_BITS} SELECT vec_id, string_agg(CAST(bit AS VARCHAR), '' ORDER BY i) AS bits FROM bits GROUP BY vec_id""",
    "signature_bits_divisible": f"""
        WITH {_bits(_FEAT, 112, 16)} SELECT vec_id, string_agg(CAST(bit AS VARCHAR), '' ORDER BY i) AS bits FROM bits GROUP BY vec_id""",
    "lsh_buckets": f"WITH {_BITS} {_buckets(8)}",
    "buckets_per_tile": f"""
        WITH {_BITS}, buckets AS ({_buckets(8)})
        SELECT vec_id, string_agg(band || ':' || bucket, ';' ORDER BY band) AS buckets FROM buckets GROUP BY vec_id""",
    "lsh_matches": f"WITH {_MATCHES} SELECT candidate, vec_id FROM matches",
    "matched_any": f"WITH {_MATCHES} SELECT DISTINCT vec_id FROM matches",
    "lsh_match_counts": f"WITH {_MATCHES} SELECT candidate, count(*) AS n FROM matches GROUP BY candidate",
    "lsh_band_sweep": f"""
        WITH {_BITS}, {_EXEMPLARS},
        sized AS (
          SELECT 6 AS b, * FROM ({_buckets(6)}) UNION ALL
          SELECT 8 AS b, * FROM ({_buckets(8)}) UNION ALL
          SELECT 10 AS b, * FROM ({_buckets(10)})),
        own AS (SELECT * FROM sized WHERE vec_id IN (SELECT vec_id FROM exemplars))
        SELECT b, candidate, count(*) AS n FROM (
          SELECT DISTINCT sized.b AS b, own.vec_id AS candidate, sized.vec_id
          FROM sized JOIN own ON sized.b = own.b AND sized.band = own.band AND sized.bucket = own.bucket)
        GROUP BY b, candidate""",
    "matched_features": f"""
        WITH {_MATCHES} SELECT vec_id, {_FEATURE_TEXT} FROM feat WHERE vec_id IN (SELECT vec_id FROM matches)""",
    "sample_rows": f"""
        WITH {_FEAT} SELECT vec_id, {_FEATURE_TEXT} FROM feat ORDER BY md5(vec_id || ':7'), vec_id LIMIT 10""",
    "column_stats": """
        WITH cells AS (
          SELECT CAST(generate_subscripts(embedding, 1) - 1 AS INTEGER) AS pos, unnest(embedding) AS x FROM embeddings)
        SELECT pos, round(avg(CAST(x AS DOUBLE)), 6) + 0 AS mean, round(stddev_pop(CAST(x AS DOUBLE)), 6) + 0 AS std
        FROM cells GROUP BY pos""",
    "zscore": """
        WITH cells AS (
          SELECT vec_id, CAST(generate_subscripts(embedding, 1) - 1 AS INTEGER) AS pos,
                 CAST(unnest(embedding) AS DOUBLE) AS x FROM embeddings),
        stats AS (SELECT pos, avg(x) AS mean, stddev_pop(x) AS sd FROM cells GROUP BY pos)
        SELECT vec_id, pos, round((x - mean) / CASE WHEN sd = 0 THEN 1 ELSE sd END, 6) + 0 AS z
        FROM cells JOIN stats USING (pos)""",
    "project_fixed_basis": f"""
        WITH {_FEAT},
        cells AS (SELECT vec_id, generate_subscripts(f, 1) - 1 AS pos, unnest(f) AS x FROM feat)
        SELECT vec_id, CAST(comp AS INTEGER) AS pos,
               round(sum(x * (((cells.pos * 7 + comp * 13) % 11 - 5) / 10.0e0)), 6) + 0 AS z
        FROM cells, range(4) t(comp) GROUP BY 1, 2""",
    "pair_distance": f"WITH {_DISTANCES} SELECT candidate, vec_id, distance FROM distances",
    "ranked_neighbours": f"WITH {_DISTANCES} SELECT candidate, vec_id, distance, rank FROM ranked",
    "nearest_neighbours": f"WITH {_DISTANCES} SELECT candidate, vec_id, distance, rank FROM ranked WHERE rank <= 5",
    "similar_images": _similar(_MATCHES, 10, 0),
    "similar_images_by_block": f"""
        SELECT CAST(1 AS INTEGER) AS block, * FROM ({_similar(_MATCHES, 10, 0)})
        UNION ALL
        SELECT 2, * FROM ({_similar(_matches(_bits(_GRAY + "," + _HALF + "," + _signs("half", 4, 4), 24, 16), 16), 10, 0)})""",
}
