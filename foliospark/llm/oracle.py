"""DuckDB statements for the queries of this package that SQL can express.

The others rest on bounded-error matching, learned models, checksums of tokens, alignments or
BPE merges; they are tested against plain versions in ``tests/llm``.
"""

from __future__ import annotations

from foliospark.llm.common import WORD
from foliospark.llm.queries import PROBE

UPPER, LOWER = "'ABCDEFGHIJKLMNOPQRSTUVWXYZ'", "'abcdefghijklmnopqrstuvwxyz'"


def words(text: str) -> str:
    return f"regexp_extract_all(translate(coalesce({text}, ''), {UPPER}, {LOWER}), '{WORD}')"


OP3 = rf"""
WITH docs AS (SELECT doc_id, {words("text")} AS w FROM documents),
items AS (
  SELECT coalesce(CAST(item_id AS VARCHAR), '') AS item, {words("text")} AS w FROM benchmark
),
cut AS (
  SELECT item, w, least(10, len(w)) AS n, unnest(range(1, greatest(len(w) - 9, 1) + 1)) AS i
  FROM items WHERE len(w) > 0
),
windows AS (SELECT DISTINCT item, n, array_to_string(list_slice(w, i, i + n - 1), ' ') AS win FROM cut),
sizes AS (SELECT DISTINCT n FROM windows),
places AS (
  SELECT doc_id, w, n, unnest(range(1, len(w) - n + 2)) AS i FROM docs JOIN sizes ON len(w) >= n
),
hits AS (
  SELECT p.doc_id, p.i, p.n, x.item
  FROM places p JOIN windows x ON x.n = p.n AND x.win = array_to_string(list_slice(p.w, p.i, p.i + p.n - 1), ' ')
),
marked AS (
  SELECT doc_id, count(DISTINCT word_no) AS n_hit
  FROM (SELECT doc_id, unnest(range(i, i + n)) AS word_no FROM hits) GROUP BY doc_id
),
owners AS (
  SELECT doc_id, count(*) AS n_items, string_agg(item, ',' ORDER BY item) AS names
  FROM (SELECT DISTINCT doc_id, item FROM hits) GROUP BY doc_id
)
SELECT d.doc_id, len(d.w) AS n_words, coalesce(m.n_hit, 0) AS n_hit, coalesce(o.n_items, 0) AS n_items,
       sha256(coalesce(o.names, '')) AS items_sha256, m.n_hit IS NOT NULL AS contaminated
FROM docs d LEFT JOIN marked m USING (doc_id) LEFT JOIN owners o USING (doc_id)"""


def escaped(text: str) -> str:
    return rf"replace(replace({text}, '\', '\\'), '<|', '<\|')"


# A block costs its start mark, role and line break, and its end mark; another turn of the
# block costs one mark.
OP8 = rf"""
WITH turns AS (
  SELECT conv_id, turn, coalesce(role, '') AS role, coalesce(text, '') AS text FROM conversations
  UNION ALL SELECT -1, 0, 'user', '{PROBE}' UNION ALL SELECT -1, 1, 'assistant', '{PROBE}'
),
marked AS (
  SELECT *, role IS DISTINCT FROM lag(role) OVER (PARTITION BY conv_id ORDER BY turn, role, text) AS opens
  FROM turns
),
wide AS (
  SELECT conv_id, count(*) AS n_turns,
         sha256(string_agg(role || chr(10) || text || chr(10), '' ORDER BY turn, role, text)) AS turns_sha256,
         coalesce(string_agg(text, '' ORDER BY turn, text) FILTER (WHERE role = 'assistant'), '') AS learned,
         sum(length({escaped("text")})
             + CASE WHEN opens THEN length('<|im_start|>') + length({escaped("role")}) + 1 + length('<|im_end|>') + 1
                    ELSE length('<|im_next|>') END) AS formatted_chars
  FROM marked GROUP BY conv_id
)
SELECT conv_id, n_turns, turns_sha256, length(learned) AS loss_chars, sha256(learned) AS loss_sha256,
       CAST(formatted_chars AS BIGINT) AS formatted_chars
FROM wide"""


def nibble(at: str) -> str:
    return f"(strpos('0123456789abcdef', substr(h, {at}, 1)) - 1)"


# Five bits of the digest at a time, from two of its hex digits.
OP10 = f"""
WITH p AS (
  SELECT page_id, strlen(coalesce(html, '')) AS payload_bytes, sha1(coalesce(html, '')) AS h FROM pages
),
f AS (SELECT *, min(page_id) OVER (PARTITION BY h) AS first_id FROM p)
SELECT page_id, payload_bytes,
       array_to_string(list_transform(range(0, 32), lambda k:
         substr('ABCDEFGHIJKLMNOPQRSTUVWXYZ234567',
           CAST((({nibble("5 * k // 4 + 1")} * 16 + {nibble("5 * k // 4 + 2")})
                 // CAST(pow(2, 3 - (5 * k) % 4) AS BIGINT)) % 32 + 1 AS BIGINT), 1)), '') AS payload_digest,
       CASE WHEN page_id = first_id THEN 'response' ELSE 'revisit' END AS record_type,
       CASE WHEN page_id <> first_id THEN first_id END AS refers_to,
       true AS intact
FROM f"""

# Features per text, the CRC-32 of each distinct one byte by byte, gains, scores, ranks. The table of
# the checksum follows from its polynomial, 0xEDB88320.
OP11 = rf"""
WITH RECURSIVE steps AS (
  SELECT b, b AS v, 0 AS k FROM range(256) t(b)
  UNION ALL
  SELECT b, CASE WHEN v % 2 = 1 THEN xor(v // 2, 3988292384) ELSE v // 2 END, k + 1 FROM steps WHERE k < 8
),
crc AS MATERIALIZED (SELECT list(v ORDER BY b) AS t FROM steps WHERE k = 8),
texts AS (
  SELECT true AS source, doc_id AS id, {words("text")} AS w FROM documents
  UNION ALL SELECT false, item_id, {words("text")} FROM benchmark
),
features AS MATERIALIZED (
  SELECT source, id, w[i] AS f FROM (SELECT *, unnest(range(1, len(w) + 1)) AS i FROM texts)
  UNION ALL
  SELECT source, id, w[i] || ' ' || w[i + 1] FROM (SELECT *, unnest(range(1, len(w))) AS i FROM texts)
),
hexed AS (SELECT f, lower(hex(f)) AS h FROM (SELECT DISTINCT f FROM features)),
hashed AS MATERIALIZED (
  SELECT f, xor(list_reduce(
      list_prepend(4294967295, list_transform(range(0, length(h) // 2), lambda j: CAST({"strpos('0123456789abcdef', substr(h, 2 * j + 1, 1)) - 1"} AS BIGINT) * 16
        + {"strpos('0123456789abcdef', substr(h, 2 * j + 2, 1)) - 1"})),
      lambda c, b: xor(c // 256, t[xor(c, b) % 256 + 1])), 4294967295) % 10000 AS bucket
  FROM hexed, crc
),
placed AS MATERIALIZED (SELECT source, id, bucket FROM features JOIN hashed USING (f)),
counts AS (
  SELECT b AS bucket, coalesce(s, 0) AS s, coalesce(t, 0) AS t
  FROM range(10000) r(b) LEFT JOIN (
    SELECT bucket, count(*) FILTER (WHERE source) AS s, count(*) FILTER (WHERE NOT source) AS t
    FROM placed GROUP BY bucket) ON bucket = b
),
gains AS (
  SELECT bucket, CAST(floor(1000 * ln((CAST(t + 1 AS DOUBLE) * CAST(sum(s) OVER () + 10000 AS DOUBLE))
    / (CAST(s + 1 AS DOUBLE) * CAST(sum(t) OVER () + 10000 AS DOUBLE)))) AS BIGINT) AS gain
  FROM counts
),
weights AS (
  SELECT id, count(*) AS n_features, CAST(sum(gain) AS BIGINT) AS total
  FROM placed JOIN gains USING (bucket) WHERE source GROUP BY id
),
scored AS (
  SELECT doc_id, len({words("text")}) AS n_words, coalesce(n_features, 0) AS n_features,
         CASE WHEN n_features IS NULL THEN 0
              ELSE (total - ((total % n_features) + n_features) % n_features) // n_features END AS weight,
         CAST(floor(-1000 * ln(-ln((CAST('0x' || substr(sha256('7:' || doc_id), 1, 8) AS BIGINT) + 0.5::DOUBLE)
           / 4294967296::DOUBLE))) AS BIGINT) AS noise
  FROM documents LEFT JOIN weights ON id = doc_id
),
ranked AS (
  SELECT *, row_number() OVER (PARTITION BY n_words >= 20 ORDER BY weight + noise DESC, doc_id) AS place,
         count(*) FILTER (WHERE n_words >= 20) OVER () AS n
  FROM scored
)
SELECT doc_id, n_features, weight, weight + noise AS score,
       CASE WHEN n_words >= 20 AND place <= 25 * n // 100 THEN place END AS rank
FROM ranked"""

# Phrases as lists of words; a part of a frequent phrase is frequent itself.
OP13 = r"""
WITH pieces AS (
  SELECT coalesce(lang, 'und') AS lang, unnest(regexp_split_to_array(
    translate(coalesce(text, ''), 'ABCDEFGHIJKLMNOPQRSTUVWXYZ', 'abcdefghijklmnopqrstuvwxyz'),
    '[.,;:!?
-]')) AS piece
  FROM documents
),
lists AS MATERIALIZED (SELECT lang, regexp_extract_all(piece, '[^ 	]+') AS w FROM pieces),
grams AS (
  SELECT lang, k, w[i:i + k - 1] AS g
  FROM (SELECT lang, w, k, unnest(range(1, len(w) - k + 2)) AS i
        FROM lists, range(1, 6) r(k) WHERE len(w) >= k)
),
counted AS MATERIALIZED (SELECT lang, k, g, count(*) AS f FROM grams GROUP BY ALL HAVING count(*) >= 100),
totals AS (SELECT lang, sum(len(w)) AS n FROM lists GROUP BY lang),
cuts AS (SELECT *, unnest(range(1, k)) AS c FROM counted WHERE k > 1),
scored AS (
  SELECT x.lang, x.k, x.g, x.f AS a, l.f AS l, r.f AS r, n, c,
         CAST(1000 * CAST(x.f AS HUGEINT) * n // (CAST(l.f AS HUGEINT) * r.f) AS BIGINT) AS score
  FROM cuts x JOIN totals USING (lang)
  JOIN counted l ON l.lang = x.lang AND l.k = c AND l.g = x.g[1:c]
  JOIN counted r ON r.lang = x.lang AND r.k = x.k - c AND r.g = x.g[c + 1:x.k]
),
lowest AS MATERIALIZED (
  SELECT * FROM scored QUALIFY row_number() OVER (PARTITION BY lang, g ORDER BY score, c) = 1
),
inner_parts AS (
  SELECT lang, k, a, unnest(range(2, k)) AS m, g FROM lowest
),
held AS (
  SELECT lang, part, max(a) AS longer
  FROM (SELECT lang, a, g[i:i + m - 1] AS part
        FROM (SELECT *, unnest(range(1, k - m + 2)) AS i FROM inner_parts)) GROUP BY ALL
),
kept AS (
  SELECT s.*, array_to_string(g, ' ') AS phrase
  FROM lowest s LEFT JOIN held h ON h.lang = s.lang AND h.part = s.g
  WHERE longer IS NULL OR 100 * longer < 100 * a
)
SELECT lang, row_number() OVER (PARTITION BY lang ORDER BY score DESC, a DESC, phrase) AS rank,
       phrase, a, l, r, CAST(n AS BIGINT) AS n, score
FROM kept QUALIFY rank <= 2000"""

ORACLE_SQL: dict[str, str] = {
    "op3_decontaminate": OP3,
    "op8_chat_format": OP8,
    "op10_warc": OP10,
    "op11_resampling": OP11,
    "op13_collocations": OP13,
}
