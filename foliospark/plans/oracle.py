"""ANSI SQL counterparts of the registered queries, written for DuckDB.

They state the expected result in their own way: recursion for the greedy packing, windows for the
latest event, CASE tables for the element types.
"""

from __future__ import annotations

from foliospark import constants as K


def quote(text: str) -> str:
    return "'" + text.replace("'", "''") + "'"


def in_list(values) -> str:
    return "(" + ", ".join(quote(v) for v in values) + ")"


SPACES = " || ".join(f"chr({ord(c)})" for c in K.WHITESPACE)
BREAK = quote(K.BATCH_SEPARATOR)
PATTERN = r"'<(h1|h2|p|li|nav|header|footer|table|td|div|img|a)\b([^>]*)>([^<]*)'"
TRANSLATABLE = in_list(K.TRANSLATABLE_TYPES)


def strip(text: str) -> str:
    return f"trim({text}, {SPACES})"


ELEMENTS = rf"""
matches AS (
  SELECT page_id, url,
         unnest(regexp_extract_all(html, {PATTERN}, 1)) AS tag,
         unnest(regexp_extract_all(html, {PATTERN}, 2)) AS attrs,
         unnest(regexp_extract_all(html, {PATTERN}, 3)) AS inner_text,
         generate_subscripts(regexp_extract_all(html, {PATTERN}, 1), 1) - 1 AS i
  FROM pages
),
elements AS (
  SELECT page_id, url, CAST(i AS INTEGER) AS elem_idx,
         CASE WHEN tag IN ('h1', 'h2') THEN 'title' WHEN tag IN ('p', 'li') THEN 'text'
              WHEN tag IN ('nav', 'header') THEN 'header' WHEN tag = 'footer' THEN 'footer'
              WHEN tag IN ('table', 'td', 'div') THEN 'table' WHEN tag = 'img' THEN 'image'
              ELSE 'unknown' END AS element_type,
         inner_text AS text, CAST(i // 10 AS INTEGER) AS page_idx,
         nullif(regexp_extract(attrs, '(?:href|src)="([^"]*)"', 1), '') AS img_path,
         CASE tag WHEN 'h1' THEN '1' WHEN 'h2' THEN '2' END AS text_level
  FROM matches
)"""
FLAT = "page_id, elem_idx, element_type, text, page_idx, 0 AS n_bbox, img_path, text_level"

SUMMARY = f"""WITH {ELEMENTS}
            SELECT p.page_id, count(e.elem_idx) AS total_elements,
                   coalesce(max(e.page_idx) + 1, 0) AS page_count,
                   count(*) FILTER (WHERE e.element_type IN {TRANSLATABLE}) AS translatable_count,
                   count(DISTINCT e.element_type) AS n_types,
                   count(*) FILTER (WHERE e.element_type = 'title') AS n_titles
            FROM pages p LEFT JOIN elements e USING (page_id) GROUP BY p.page_id"""

# What becomes of each page's layout file.
PAGE_OK = "NOT (url LIKE '%#top' OR url LIKE '%?utm%' OR url LIKE '%?page%')"
PAGE_BAD_FIELD = "url LIKE '%.html'"
LAYOUT_ERROR = "layout file is not a JSON array of objects"

CHUNKS = f"""
paras AS (
  SELECT doc_id, unnest(string_split(text, chr(10))) AS p,
         generate_subscripts(string_split(text, chr(10)), 1) AS i
  FROM documents
),
fold AS (
  SELECT doc_id, i, length(p) AS running, 0 AS chunk_idx FROM paras WHERE i = 1
  UNION ALL
  SELECT f.doc_id, n.i,
         CASE WHEN f.running + length(n.p) > {K.MAX_CHARS} THEN length(n.p)
              ELSE f.running + length(n.p) END,
         CASE WHEN f.running + length(n.p) > {K.MAX_CHARS} THEN f.chunk_idx + 1
              ELSE f.chunk_idx END
  FROM fold f JOIN paras n ON n.doc_id = f.doc_id AND n.i = f.i + 1
),
chunks AS (
  SELECT f.doc_id, CAST(f.chunk_idx AS INTEGER) AS chunk_idx,
         string_agg(p.p, chr(10) ORDER BY p.i) AS chunk
  FROM fold f JOIN paras p ON p.doc_id = f.doc_id AND p.i = f.i
  GROUP BY f.doc_id, f.chunk_idx
)"""


def translated(text: str) -> str:
    """translated, success and error of the refusing translator."""
    return f"""
  CASE WHEN {strip(text)} = '' OR contains({text}, 'ß') THEN ''
       ELSE {strip("'[en] ' || " + text)} END AS translated,
  {strip(text)} = '' OR NOT contains({text}, 'ß') AS success,
  CASE WHEN {strip(text)} <> '' AND contains({text}, 'ß') THEN 'refused' ELSE '' END AS error"""


CHUNK_RESULTS = f"""WITH RECURSIVE {CHUNKS}
SELECT doc_id, chunk_idx, chunk AS original, {translated("chunk")} FROM chunks"""

TARGETS = "CASE lang WHEN 'en' THEN '英文' WHEN 'fr' THEN '法语' WHEN 'de' THEN '德文' ELSE 'Español' END"
SUFFIX = "CASE lang WHEN 'en' THEN 'en' WHEN 'fr' THEN 'fr' WHEN 'de' THEN 'de' ELSE 'translated' END"
PROMPT_HEAD, PROMPT_TAIL = K.MARKDOWN_PROMPT.split("{target_lang}")

BATCHES = f"""
turns AS (
  SELECT conv_id, turn, turn // 3 AS batch_id, text, {strip("coalesce(text, '')")} = '' AS blank
  FROM conversations
),
numbered AS (
  SELECT *, sum(CASE WHEN blank THEN 0 ELSE 1 END)
              OVER (PARTITION BY conv_id, batch_id ORDER BY turn) AS part
  FROM turns
),
batches AS (
  SELECT conv_id, batch_id, CAST(count(*) AS INTEGER) AS n_rows,
         CAST(count(*) FILTER (WHERE NOT blank) AS INTEGER) AS n_sent,
         string_agg(text, {BREAK} ORDER BY turn) FILTER (WHERE NOT blank) AS combined
  FROM turns GROUP BY conv_id, batch_id
),
unpacked AS (
  SELECT n.conv_id, n.turn, n.batch_id, n.text AS original, n.blank,
         b.combined IS NOT NULL AND contains(b.combined, 'ñ') AS failed,
         NOT n.blank AND n.part = b.n_sent AND contains(b.combined, 'ß') AS emptied,
         b.n_sent AS n_sent
  FROM numbered n JOIN batches b USING (conv_id, batch_id)
),
results AS (
  SELECT conv_id, turn, batch_id, original,
         CASE WHEN failed OR emptied OR blank THEN '' ELSE {strip("'[en] ' || original")} END AS translated,
         NOT failed AS success,
         CASE WHEN failed THEN 'refused' ELSE '' END AS error,
         -- A response without any part still holds one empty text, so a lone row misses nothing.
         emptied AND NOT failed AND n_sent > 1 AS missing_part
  FROM unpacked
)"""

STATE = f"""
manifest AS (
  SELECT CAST(user_id AS VARCHAR) AS doc_id,
         coalesce(max(ts) FILTER (WHERE event_type = 'signup'), min(ts)) AS mtime
  FROM events GROUP BY user_id
),
log AS (
  SELECT CAST(user_id AS VARCHAR) AS doc_id, event_id, ts, props,
         CASE event_id % 3 WHEN 0 THEN 'parse' WHEN 1 THEN 'layout' ELSE 'translate' END AS stage,
         CASE WHEN event_type IN ('purchase', 'view') THEN 'done' WHEN event_type = 'click' THEN 'skipped'
              WHEN event_type = 'error' THEN 'failed' ELSE 'pending' END AS status
  FROM events
),
ranked AS (
  SELECT *, row_number() OVER (PARTITION BY doc_id, stage ORDER BY ts DESC, event_id DESC) AS rn,
         max(ts) FILTER (WHERE status = 'done') OVER (PARTITION BY doc_id, stage) AS done_at
  FROM log
),
state AS (
  SELECT m.doc_id, m.mtime, s.stage, coalesce(r.status, 'pending') AS status, r.ts,
         coalesce(r.done_at, TIMESTAMP '1970-01-01 00:00:00') AS source_mtime,
         CASE WHEN r.status = 'failed' THEN r.props ELSE '' END AS error
  FROM manifest m CROSS JOIN (VALUES ('parse'), ('layout'), ('translate')) s(stage)
  LEFT JOIN ranked r ON r.doc_id = m.doc_id AND r.stage = s.stage AND r.rn = 1
),
wide AS (
  SELECT doc_id,
         max(status) FILTER (WHERE stage = 'parse') AS parse,
         max(status) FILTER (WHERE stage = 'layout') AS layout,
         max(status) FILTER (WHERE stage = 'translate') AS translate,
         max(error) FILTER (WHERE stage = 'parse') AS parse_error,
         max(error) FILTER (WHERE stage = 'translate') AS translate_error,
         bool_and(status IN ('done', 'skipped')) AS all_done,
         bool_and(status IN ('done', 'skipped')) FILTER (WHERE stage <> 'translate') AS first_two,
         bool_or(status = 'skipped') AS any_skipped
  FROM state GROUP BY doc_id
),
outcomes AS (
  SELECT *, parse <> 'failed' AS success,
         CASE WHEN NOT all_done THEN 'failed' WHEN parse = 'failed' OR any_skipped THEN 'skipped'
              ELSE 'success' END AS outcome,
         CASE WHEN NOT first_two THEN 'failed' WHEN parse = 'failed' OR any_skipped THEN 'skipped'
              ELSE 'success' END AS outcome_without_translation
  FROM wide
)"""

# Which of the first two runs holds a page's layout.
PAGE_RUN = "CASE WHEN page_id % 5 = 0 OR url LIKE '%.html' THEN 2 ELSE 1 END"

NEEDED = "status <> 'done' OR mtime > source_mtime"


RUN = rf"""paras AS (
              SELECT url, string_agg(inner_text, chr(10) || chr(10) ORDER BY i) AS markdown
              FROM (SELECT url,
                           unnest(regexp_extract_all(html, {PATTERN}, 1)) AS tag,
                           unnest(regexp_extract_all(html, {PATTERN}, 3)) AS inner_text,
                           generate_subscripts(regexp_extract_all(html, {PATTERN}, 1), 1) AS i
                    FROM pages)
              WHERE tag = 'p' GROUP BY url
            ),
            split AS (
              SELECT url, unnest(string_split(markdown, chr(10) || chr(10))) AS p,
                     generate_subscripts(string_split(markdown, chr(10) || chr(10)), 1) AS i
              FROM paras
            ),
            fold AS (
              SELECT url, i, length(p) AS running, 0 AS chunk_idx FROM split WHERE i = 1
              UNION ALL
              SELECT f.url, n.i,
                     CASE WHEN f.running + length(n.p) > {K.MAX_CHARS} THEN length(n.p) ELSE f.running + length(n.p) END,
                     CASE WHEN f.running + length(n.p) > {K.MAX_CHARS} THEN f.chunk_idx + 1 ELSE f.chunk_idx END
              FROM fold f JOIN split n ON n.url = f.url AND n.i = f.i + 1
            ),
            refused AS (
              SELECT f.url, count(DISTINCT f.chunk_idx) AS n
              FROM fold f JOIN split s ON s.url = f.url AND s.i = f.i WHERE contains(s.p, 'ß') GROUP BY f.url
            ),
            facts AS (
              SELECT p.url, p.url LIKE '%.html' AS no_parse, p.url LIKE '%#top' AS no_layout,
                     p.url LIKE '%/' OR m.markdown IS NULL OR {strip("m.markdown")} = '' AS no_markdown,
                     coalesce(r.n, 0) AS n
              FROM pages p LEFT JOIN paras m USING (url) LEFT JOIN refused r USING (url)
            )"""


def statements() -> dict[str, str]:
    found = {
        "elements_from_pages": f"WITH {ELEMENTS} SELECT {FLAT} FROM elements",
        "element_metadata": f"""WITH {ELEMENTS}
            SELECT page_id, elem_idx, 'img_path' AS key, img_path AS value FROM elements WHERE img_path IS NOT NULL
            UNION ALL
            SELECT page_id, elem_idx, 'text_level', text_level FROM elements WHERE text_level IS NOT NULL""",
        "elements_by_type": f"WITH {ELEMENTS} SELECT {FLAT} FROM elements WHERE element_type = 'title'",
        "elements_by_page": f"WITH {ELEMENTS} SELECT {FLAT} FROM elements WHERE page_idx = 1",
        "translatable_elements": f"WITH {ELEMENTS} SELECT {FLAT} FROM elements WHERE element_type IN {TRANSLATABLE}",
        "layout_summary": SUMMARY,
        "layout_summary_of_manifest": SUMMARY,
        "type_distribution": f"""WITH {ELEMENTS}
            SELECT page_id, element_type, count(*) AS n FROM elements GROUP BY page_id, element_type""",
        "layout_json": f"""WITH {ELEMENTS}
            SELECT p.page_id, {PAGE_OK.replace("url", "p.url")} AS success,
                   CASE WHEN p.url LIKE '%.html' AND e.elem_idx IS NOT NULL THEN 1 ELSE 0 END AS n_bad_fields,
                   e.elem_idx, e.element_type, coalesce(e.text, '') AS text,
                   CASE WHEN p.url LIKE '%.html' OR e.elem_idx IS NULL THEN -1 ELSE e.page_idx END AS page_idx,
                   CASE WHEN e.elem_idx IS NULL THEN 0 ELSE 2 END AS n_bbox,
                   e.img_path, CAST(NULL AS VARCHAR) AS text_level
            FROM pages p LEFT JOIN (SELECT * FROM elements WHERE {PAGE_OK}) e USING (page_id)""",
        "layout_json_summary": f"""WITH {ELEMENTS}
            SELECT p.page_id, {PAGE_OK.replace("url", "p.url")} AS success,
                   CASE WHEN {PAGE_OK.replace("url", "p.url")} THEN '' ELSE {quote(LAYOUT_ERROR)} END AS error,
                   count(e.elem_idx) AS total_elements,
                   CASE WHEN p.url LIKE '%.html' THEN 0 ELSE coalesce(max(e.page_idx) + 1, 0) END AS page_count,
                   count(*) FILTER (WHERE e.element_type IN {TRANSLATABLE}) AS translatable_count
            FROM pages p LEFT JOIN (SELECT * FROM elements WHERE {PAGE_OK}) e USING (page_id)
            GROUP BY p.page_id, p.url""",
        "extract_elements": f"""WITH {ELEMENTS}
            SELECT p.page_id, NOT p.url LIKE '%.html' AS extracted,
                   CASE WHEN p.url LIKE '%.html' THEN 'cannot open page' ELSE '' END AS extract_error,
                   NOT (p.url LIKE '%.html' OR p.url LIKE '%#top') AS success,
                   e.elem_idx, e.element_type, coalesce(e.text, '') AS text,
                   coalesce(e.page_idx, -1) AS page_idx, 0 AS n_bbox, e.img_path, e.text_level
            FROM pages p LEFT JOIN (
              SELECT * FROM elements WHERE NOT (url LIKE '%.html' OR url LIKE '%#top')) e USING (page_id)""",
        "paragraphs": f"""
            WITH p AS (
              SELECT doc_id, unnest(string_split(text, chr(10))) AS paragraph,
                     CAST(generate_subscripts(string_split(text, chr(10)), 1) - 1 AS INTEGER) AS para_idx
              FROM documents)
            SELECT doc_id, para_idx, paragraph, {strip("paragraph")} AS stripped,
                   {strip("paragraph")} = '' AS is_blank FROM p""",
        "markdown_chunks": f"WITH RECURSIVE {CHUNKS} SELECT doc_id, chunk_idx, chunk FROM chunks",
        "reassembled": "SELECT doc_id, text AS content FROM documents",
        "reassembled_parts": f"""WITH RECURSIVE {CHUNKS}
            SELECT doc_id, CAST(chunk_idx // 2 AS BIGINT) AS part_no,
                   string_agg(chunk, chr(10) ORDER BY chunk_idx) AS content
            FROM chunks GROUP BY doc_id, chunk_idx // 2""",
        "translate_requests": f"""WITH RECURSIVE {CHUNKS}
            SELECT c.doc_id, c.chunk_idx, 'chat-model' AS model,
                   {quote(PROMPT_HEAD)} || {TARGETS} || {quote(PROMPT_TAIL)} AS system_prompt,
                   'user' AS user_role, c.chunk AS user_text, CAST(0.1 AS DOUBLE) AS temperature
            FROM chunks c JOIN documents d USING (doc_id)""",
        "lang_suffix": f"""SELECT doc_id, {SUFFIX} AS suffix,
            'doc' || doc_id || '_' || {SUFFIX} || '.md' AS out_name FROM documents""",
        "translate_chunks": CHUNK_RESULTS,
        "translate_copies": CHUNK_RESULTS,
        "translate_single": f"SELECT conv_id, turn, {translated('text')} FROM conversations",
        "chunk_fallback": f"""WITH RECURSIVE {CHUNKS},
            marked AS (SELECT *, regexp_matches(chunk, '[0-9]') OR contains(chunk, 'ß') AS fell_back FROM chunks)
            SELECT doc_id, chunk_idx, chunk,
                   CASE WHEN fell_back THEN chunk ELSE '[en] ' || chunk END AS final, fell_back FROM marked""",
        "translate_markdown": f"""WITH RECURSIVE {CHUNKS},
            results AS (SELECT doc_id, chunk_idx, chunk, {translated("chunk")} FROM chunks),
            whole AS (
              SELECT doc_id, string_agg(CASE WHEN success THEN translated ELSE chunk END, chr(10) ORDER BY chunk_idx) AS content,
                     CAST(count(*) AS INTEGER) AS n_chunks,
                     CAST(count(*) FILTER (WHERE NOT success) AS INTEGER) AS n_failed_chunks
              FROM results GROUP BY doc_id)
            SELECT d.doc_id,
                   CASE WHEN {strip("d.text")} = '' THEN d.text ELSE w.content END AS content,
                   CASE WHEN {strip("d.text")} = '' THEN 0 ELSE w.n_chunks END AS n_chunks,
                   CASE WHEN {strip("d.text")} = '' THEN 0 ELSE w.n_failed_chunks END AS n_failed_chunks
            FROM documents d LEFT JOIN whole w USING (doc_id)""",
        "stream_retries": f"""WITH RECURSIVE {CHUNKS},
            results AS (SELECT doc_id, chunk_idx, chunk, {translated("chunk")} FROM chunks),
            whole AS (
              SELECT doc_id, CAST(count(*) AS INTEGER) AS n_chunks,
                     string_agg(CASE WHEN success THEN translated ELSE {strip("'[later] ' || chunk")} END, chr(10)
                                ORDER BY chunk_idx) AS content
              FROM results GROUP BY doc_id)
            SELECT d.doc_id, CASE WHEN {strip("d.text")} = '' THEN d.text ELSE w.content END AS content,
                   CASE WHEN {strip("d.text")} = '' THEN 0 ELSE w.n_chunks END AS n_chunks, CAST(0 AS INTEGER) AS n_failed_chunks
            FROM documents d LEFT JOIN whole w USING (doc_id)""",
        "batch_pack": f"WITH {BATCHES} SELECT conv_id, batch_id, n_rows, n_sent, combined FROM batches",
        "batch_unpack": f"WITH {BATCHES} SELECT * FROM results",
        "batch_results": f"""WITH {BATCHES}
            SELECT conv_id, turn, original, translated, success AND NOT missing_part AS success,
                   CASE WHEN missing_part THEN {quote(K.NO_RESULT_ERROR)} ELSE error END AS error
            FROM results""",
        # All ways to lose as many turns as there are parts too few, and the one with the closest lengths.
        "batch_align": f"""WITH turns AS (
              SELECT conv_id, turn, turn // 5 AS batch_id, text, {strip("coalesce(text, '')")} = '' AS blank
              FROM conversations
            ),
            sent AS (
              SELECT *, CAST(row_number() OVER w - 1 AS INTEGER) AS pos, CAST(count(*) OVER p AS INTEGER) AS k,
                     string_agg(text, {BREAK} ORDER BY turn) OVER p AS combined
              FROM turns WHERE NOT blank
              WINDOW w AS (PARTITION BY conv_id, batch_id ORDER BY turn), p AS (PARTITION BY conv_id, batch_id)
            ),
            answered AS (
              SELECT *, contains(combined, 'ñ') AS failed,
                     CASE WHEN k > 1 AND contains(combined, 'ß') THEN 0
                          WHEN k > 1 AND contains(combined, 'e') THEN k // 2 END AS gone
              FROM sent
            ),
            batches AS (
              SELECT conv_id, batch_id, any_value(k) AS k, any_value(failed) AS failed,
                     list(length({strip("text")}) ORDER BY pos) AS lo,
                     list({strip("'[en] ' || text")} ORDER BY pos) FILTER (WHERE gone IS NULL OR pos <> gone) AS parts
              FROM answered GROUP BY conv_id, batch_id
            ),
            ways AS (
              SELECT *, list_filter(range(0, k), lambda i: (mask >> i) % 2 = 1) AS lost,
                     list_filter(range(0, k), lambda i: (mask >> i) % 2 = 0) AS kept
              FROM (SELECT *, unnest(range(0, CAST(pow(2, k) AS BIGINT))) AS mask FROM batches)
              WHERE bit_count(mask) = k - len(parts)
            ),
            best AS (
              SELECT * FROM ways QUALIFY row_number() OVER (
                PARTITION BY conv_id, batch_id
                ORDER BY list_sum(list_transform(range(1, len(kept) + 1), lambda j: abs(lo[kept[j] + 1] - length(parts[j])))),
                         lost DESC) = 1
            )
            SELECT t.conv_id, t.turn, NOT coalesce(b.failed, false) AS success,
                   CASE WHEN b.failed THEN 'refused' ELSE '' END AS error,
                   CASE WHEN t.blank OR b.failed OR list_contains(b.lost, s.pos) THEN ''
                        ELSE b.parts[list_position(b.kept, s.pos)] END AS aligned,
                   coalesce(NOT t.blank AND NOT b.failed AND list_contains(b.lost, s.pos), false) AS lost
            FROM turns t LEFT JOIN sent s ON s.conv_id = t.conv_id AND s.turn = t.turn
            LEFT JOIN best b ON b.conv_id = t.conv_id AND b.batch_id = t.batch_id""",
        "document_keys": r"""
            WITH u AS (SELECT page_id, url, list_extract(string_split(url, '/'), -1) AS name FROM pages),
            n AS (SELECT *, CASE WHEN url LIKE '%/' THEN '' WHEN strpos(name, '.') > 1 AND name NOT LIKE '%.'
                    THEN regexp_replace(name, '\.[^.]*$', '') ELSE name END AS stem FROM u)
            SELECT page_id, sha256(url) AS doc_id, stem,
                   CASE WHEN stem = '426' THEN '/data/780#top/426' ELSE '/data/780#top/426/' || stem END AS output_dir
            FROM n""",
        "artifacts": """
            WITH p AS (SELECT url, 'p' || page_id AS stem, '/data/output/p' || page_id AS base FROM pages)
            SELECT stem,
              CASE WHEN url LIKE '%#top' THEN base || '/auto' WHEN url LIKE '%.html' THEN base || '/b/auto'
                   WHEN url LIKE '%?page%' THEN base WHEN url LIKE '%?utm%' THEN base || '/auto'
                   WHEN url NOT LIKE '%/' THEN base || '/auto' END AS artifact_dir,
              CASE WHEN url LIKE '%#top' THEN base || '/auto/' || stem || '_content_list.json'
                   WHEN url LIKE '%.html' THEN base || '/b/auto/a_content_list.json'
                   WHEN url LIKE '%?page%' OR url LIKE '%?utm%' THEN NULL
                   WHEN url NOT LIKE '%/' THEN base || '/auto/y_content_list.json' END AS layout_path,
              CASE WHEN url LIKE '%#top' THEN base || '/auto/' || stem || '.md'
                   WHEN url LIKE '%.html' THEN base || '/b/auto/n.md'
                   WHEN url LIKE '%?page%' THEN base || '/' || stem || '.md' END AS markdown_path
            FROM p""",
        "document_gate": f"""SELECT doc_id,
            CASE WHEN lang IN ('es', 'de') OR {strip("text")} = '' THEN 'skipped' ELSE 'run' END AS gate
            FROM documents""",
        "stage_state": f"WITH {STATE} SELECT doc_id, stage, status, ts, source_mtime, error FROM state",
        "stage_needed": f"WITH {STATE} SELECT doc_id, stage, {NEEDED} AS needed FROM state",
        "unfinished_documents": f"""WITH {STATE}
            SELECT doc_id, '/data/in/' || doc_id || '.pdf' AS path FROM state WHERE stage = 'layout' AND ({NEEDED})""",
        "all_done": f"WITH {STATE} SELECT doc_id, all_done, first_two AS parsed_and_laid_out FROM wide",
        "state_overview": f"""WITH {STATE}
            SELECT doc_id, '/data/in/' || doc_id || '.pdf' AS path,
                   max(source_mtime) OVER (PARTITION BY doc_id) AS source_mtime, stage, status, error FROM state""",
        "outcomes": f"WITH {STATE} SELECT doc_id, success, outcome, outcome_without_translation FROM outcomes",
        "batch_totals": f"""WITH {STATE}
            SELECT count(*) AS total, count(*) FILTER (WHERE outcome = 'success') AS success,
                   count(*) FILTER (WHERE outcome = 'skipped') AS skipped,
                   count(*) FILTER (WHERE outcome = 'failed') AS failed,
                   count(*) FILTER (WHERE outcome = 'failed') = 0 AS ok FROM outcomes""",
        "batch_details": f"""WITH {STATE}
            SELECT doc_id || '.pdf' AS file, success, parse_error AS error, outcome,
                   layout AS layout_status, translate_error FROM outcomes""",
        "batch_run": f"""WITH RECURSIVE {RUN}
            SELECT url AS path,
                   NOT (no_parse OR no_layout OR (n > 0 AND NOT no_markdown)) AS success,
                   CASE WHEN no_parse THEN 'cannot open page' WHEN no_layout THEN {quote(LAYOUT_ERROR)}
                        WHEN n > 0 AND NOT no_markdown THEN n || ' chunks failed' ELSE '' END AS error,
                   CASE WHEN no_parse OR no_layout OR (n > 0 AND NOT no_markdown) THEN 'failed'
                        WHEN no_markdown THEN 'skipped' ELSE 'success' END AS outcome,
                   CASE WHEN no_parse THEN 'failed' ELSE 'done' END AS parse,
                   CASE WHEN no_parse THEN 'pending' WHEN no_layout THEN 'failed' ELSE 'done' END AS layout,
                   CASE WHEN no_parse OR no_layout THEN 'pending' WHEN no_markdown THEN 'skipped'
                        WHEN n > 0 THEN 'failed' ELSE 'done' END AS translate,
                   CASE WHEN no_parse THEN 1 WHEN no_layout OR no_markdown THEN 2 ELSE 3 END AS stages_run
            FROM facts""",
        "batch_run_elements": f"""WITH {ELEMENTS}
            SELECT sha256(url) AS doc_id, elem_idx, element_type, coalesce(text, '') AS text, page_idx,
                   CAST(elem_idx AS DOUBLE) AS x, CAST(0.5 AS DOUBLE) AS y, 2 AS n_bbox
            FROM elements WHERE NOT (url LIKE '%.html' OR url LIKE '%#top')""",
        "batch_run_summary": f"""WITH RECURSIVE {RUN},
            o AS (SELECT CASE WHEN no_parse OR no_layout OR (n > 0 AND NOT no_markdown) THEN 'failed'
                              WHEN no_markdown THEN 'skipped' ELSE 'success' END AS outcome FROM facts)
            SELECT count(*) AS total, count(*) FILTER (WHERE outcome = 'success') AS success,
                   count(*) FILTER (WHERE outcome = 'skipped') AS skipped,
                   count(*) FILTER (WHERE outcome = 'failed') AS failed,
                   count(*) FILTER (WHERE outcome = 'failed') = 0 AS ok FROM o""",
        "batch_run_markdown": f"""WITH RECURSIVE {RUN},
            pieces AS (
              SELECT f.url, f.chunk_idx, string_agg(s.p, chr(10) || chr(10) ORDER BY s.i) AS chunk
              FROM fold f JOIN split s ON s.url = f.url AND s.i = f.i GROUP BY f.url, f.chunk_idx
            ),
            results AS (SELECT url, chunk_idx, chunk, {translated("chunk")} FROM pieces),
            whole AS (
              SELECT url, string_agg(CASE WHEN success THEN translated ELSE chunk END, chr(10) || chr(10)
                                     ORDER BY chunk_idx) AS content,
                     CAST(count(*) FILTER (WHERE NOT success) AS INTEGER) AS n_failed_chunks
              FROM results GROUP BY url
            )
            SELECT sha256(url) AS doc_id, 'p' || page_id || '_en.md' AS out_name, n_failed_chunks, content
            FROM whole JOIN facts USING (url) JOIN pages USING (url)
            WHERE NOT (no_parse OR no_layout OR no_markdown)""",
        # Later runs: what failed to open opens, nothing is refused, every fifth page has changed.
        "batch_rerun": f"""WITH RECURSIVE {RUN},
            again AS (
              SELECT url, page_id % 5 = 0 OR no_parse AS parsed, no_layout,
                     (url LIKE '%/' OR m.markdown IS NULL OR {strip("m.markdown")} = '') AS no_markdown, n
              FROM facts JOIN pages USING (url) LEFT JOIN paras m USING (url)
            )
            SELECT 2 AS run_no, url AS path, NOT no_layout AS success,
                   CASE WHEN no_layout THEN 'failed' WHEN no_markdown THEN 'skipped' ELSE 'success' END AS outcome,
                   CASE WHEN no_layout THEN 1 WHEN parsed THEN 2 ELSE 0 END
                     + CASE WHEN parsed AND no_layout THEN 1
                            WHEN no_layout OR no_markdown THEN 0
                            WHEN parsed OR n > 0 THEN 1 ELSE 0 END AS stages_run
            FROM again
            UNION ALL
            SELECT 3, url, NOT no_layout,
                   CASE WHEN no_layout THEN 'failed' WHEN no_markdown THEN 'skipped' ELSE 'success' END,
                   CASE WHEN no_layout OR NOT no_markdown THEN 1 ELSE 0 END
            FROM again""",
        # What was refused in the first run is sent by the second, nothing by the third.
        "batch_memory": f"""WITH RECURSIVE {RUN},
            pieces AS (
              SELECT f.url, f.chunk_idx, string_agg(s.p, chr(10) || chr(10) ORDER BY s.i) AS chunk
              FROM fold f JOIN split s ON s.url = f.url AND s.i = f.i JOIN facts ON facts.url = f.url
              WHERE NOT (no_parse OR no_layout OR no_markdown) GROUP BY f.url, f.chunk_idx
            ),
            results AS (SELECT url, chunk_idx, chunk, {translated("chunk")} FROM pieces),
            final AS (
              SELECT run_no, url, chunk_idx, chunk, NOT success AND run_no = 1 AS failed,
                     CASE WHEN success THEN translated WHEN run_no = 1 THEN chunk
                          ELSE {strip("'[later] ' || chunk")} END AS text
              FROM results, (VALUES (1), (2), (3)) r(run_no)
            ),
            sent AS (
              SELECT 1 AS run_no, count(DISTINCT chunk) AS n_sent FROM results WHERE {strip("chunk")} <> ''
              UNION ALL SELECT 2, count(DISTINCT chunk) FROM results WHERE NOT success
              UNION ALL SELECT 3, 0
            )
            SELECT run_no, sha256('copy ' || run_no || ' of ' || url) AS doc_id,
                   CAST(count(*) FILTER (WHERE failed) AS INTEGER) AS n_failed_chunks,
                   string_agg(text, chr(10) || chr(10) ORDER BY chunk_idx) AS content,
                   CAST(any_value(n_sent) AS INTEGER) AS n_sent
            FROM final JOIN sent USING (run_no) GROUP BY run_no, url""",
        "current_elements": f"""WITH {ELEMENTS}
            SELECT sha256(url) AS doc_id, {PAGE_RUN} AS run_no, elem_idx, element_type, coalesce(text, '') AS text,
                   page_idx, CAST(elem_idx AS DOUBLE) AS x
            FROM elements WHERE NOT url LIKE '%#top'""",
        "current_summaries": f"""WITH s AS ({SUMMARY})
            SELECT sha256(url) AS doc_id, {PAGE_RUN} AS run_no, total_elements, page_count, translatable_count
            FROM s JOIN pages USING (page_id) WHERE NOT url LIKE '%#top'""",
        # In the second run all chunks of changed documents are new, of others those refused before.
        "current_translations": f"""WITH RECURSIVE {RUN},
            pieces AS (
              SELECT f.url, f.chunk_idx, string_agg(s.p, chr(10) || chr(10) ORDER BY s.i) AS chunk
              FROM fold f JOIN split s ON s.url = f.url AND s.i = f.i GROUP BY f.url, f.chunk_idx
            ),
            results AS (SELECT url, chunk, chunk_idx, {strip("'[later] ' || chunk")} AS later, {translated("chunk")} FROM pieces),
            named AS (SELECT *, {PAGE_RUN} AS parsed_in FROM results JOIN facts USING (url) JOIN pages USING (url)
                      WHERE NOT (no_layout OR no_markdown))
            SELECT sha256(url) AS doc_id, greatest(any_value(parsed_in), max(CASE WHEN success THEN 1 ELSE 2 END)) AS run_no,
                   '英文' AS target_lang, 'p' || any_value(page_id) || '_en.md' AS out_name, CAST(0 AS INTEGER) AS n_failed_chunks,
                   string_agg(CASE WHEN {strip("chunk")} = '' THEN '' WHEN parsed_in = 2 OR NOT success THEN later
                                   ELSE translated END, chr(10) || chr(10) ORDER BY chunk_idx) AS content
            FROM named GROUP BY url
            UNION ALL
            SELECT sha256(url), 3, '中文', 'p' || any_value(page_id) || '_zh.md', CAST(0 AS INTEGER),
                   string_agg(CASE WHEN {strip("chunk")} = '' THEN '' ELSE later END, chr(10) || chr(10) ORDER BY chunk_idx)
            FROM named GROUP BY url""",
        "source_files": """SELECT page_id, 'p' || page_id || '.PDF' AS file,
            replace(regexp_extract(url, '//([^/]+)', 1), '.', '/') AS host, strlen(html) AS length, true AS in_order FROM pages""",
        "artifact_files": f"""WITH {ELEMENTS}
            SELECT p.page_id, {PAGE_OK.replace("url", "p.url")} AS success,
                   CASE WHEN {PAGE_OK.replace("url", "p.url")} THEN '' ELSE {quote(LAYOUT_ERROR)} END AS error,
                   p.url AS markdown,
                   count(e.elem_idx) AS total_elements,
                   CASE WHEN p.url LIKE '%.html' THEN 0 ELSE coalesce(max(e.page_idx) + 1, 0) END AS page_count,
                   count(*) FILTER (WHERE e.element_type IN {TRANSLATABLE}) AS translatable_count
            FROM pages p LEFT JOIN (SELECT * FROM elements WHERE {PAGE_OK}) e USING (page_id)
            GROUP BY p.page_id, p.url""",
        "markdown_files": "SELECT doc_id, text AS content FROM documents",
        "summary_files": SUMMARY,
        "translated_files": f"""WITH RECURSIVE {CHUNKS},
            results AS (SELECT doc_id, chunk_idx, chunk, {translated("chunk")} FROM chunks),
            whole AS (SELECT doc_id, string_agg(CASE WHEN success THEN translated ELSE chunk END, chr(10)
                                                ORDER BY chunk_idx) AS content FROM results GROUP BY doc_id)
            SELECT 's' || (doc_id // 4) || '_en.md' AS file,
                   CASE WHEN {strip("d.text")} = '' THEN d.text ELSE w.content END AS content
            FROM documents d LEFT JOIN whole w USING (doc_id)""",
        "result_files": CHUNK_RESULTS,
        "saved_state_files": f"WITH {STATE} SELECT doc_id, stage, status, error FROM state",
        "run_from_artifacts": f"""SELECT page_id, {PAGE_OK} AS success,
            CASE WHEN {PAGE_OK} THEN '' ELSE {quote(LAYOUT_ERROR)} END AS error,
            CASE WHEN {PAGE_OK} THEN 'success' ELSE 'failed' END AS outcome,
            CASE WHEN {PAGE_OK} THEN 3 ELSE 2 END AS stages_run FROM pages""",
    }
    found["layout_json_parts"] = found["layout_json"]
    found["layout_file_parts"] = found["layout_json"]
    found["paragraph_chunks"] = found["markdown_chunks"]
    found["stream_stage_needed"] = found["stage_needed"]
    found["stream_markdown"] = found["translate_markdown"]
    return found
