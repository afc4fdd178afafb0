"""Explicit schemas of the tables; nothing is ever inferred."""

STAGE_EVENTS = (
    "doc_id STRING, stage STRING, target_lang STRING, status STRING, ts TIMESTAMP, "
    "error STRING, source_mtime TIMESTAMP, run_id STRING"
)

TRANSLATED_CHUNKS = (
    "doc_id STRING, chunk_idx INT, chunk_key STRING, original STRING, translated STRING, "
    "success BOOLEAN, error STRING, target_lang STRING, run_id STRING"
)

# Extractor output, with what the later stages need to know so that they can go on without a join.
EXTRACTED = (
    "doc_id STRING, layout_json STRING, markdown STRING, success BOOLEAN, error STRING, "
    "mtime TIMESTAMP, stem STRING, layout_needed BOOLEAN, translate_needed BOOLEAN"
)

# Results of a translation memory; ``run_id`` is the folder of the run that has sent the text.
MEMORY = (
    "chunk_key STRING, original STRING, translated STRING, success BOOLEAN, error STRING, run_id STRING"
)

ELEMENTS = (
    "doc_id STRING, mtime TIMESTAMP, success BOOLEAN, error STRING, elem_idx INT, element_type STRING, "
    "text STRING, page_idx INT, bbox ARRAY<DOUBLE>, metadata MAP<STRING, STRING>"
)

SUMMARY = (
    "doc_id STRING, mtime TIMESTAMP, success BOOLEAN, error STRING, total_elements BIGINT, page_count INT, "
    "type_distribution MAP<STRING, BIGINT>, translatable_count BIGINT"
)

TRANSLATED = (
    "doc_id STRING, mtime TIMESTAMP, stem STRING, target_lang STRING, out_name STRING, n_failed_chunks INT, "
    "content STRING"
)
