"""Fixed values.

Everything in this module has to equal the values the data and the prompts are defined with,
otherwise results differ; none of it is logic.
"""

# The closed set of layout element types.
ELEMENT_TYPES = (
    "text",
    "title",
    "header",
    "footer",
    "page_number",
    "image",
    "table",
    "ocr_text",
    "interline_equation",
    "footnote",
    "unknown",
)
UNKNOWN_TYPE = "unknown"
TABLE_TYPE = "table"

# The types whose text is sent to translation.
TRANSLATABLE_TYPES = (
    "text",
    "title",
    "header",
    "footer",
    "ocr_text",
    "interline_equation",
)

# Element keys kept as metadata.
METADATA_KEYS = ("img_path", "table_caption", "table_footnote", "text_level", "level")

# File name endings of the layout and Markdown artifacts and the artifact folder.
LAYOUT_SUFFIX = "_content_list.json"
MARKDOWN_SUFFIX = ".md"
ARTIFACT_DIR = "auto"

# Target language to file name suffix.
LANGUAGE_SUFFIX = {
    "中文": "zh",
    "英文": "en",
    "日文": "ja",
    "日语": "ja",
    "韩文": "ko",
    "韩语": "ko",
    "法文": "fr",
    "法语": "fr",
    "德文": "de",
    "德语": "de",
}
OTHER_LANGUAGE_SUFFIX = "translated"
DEFAULT_TARGET_LANG = "英文"

# Chunking, batching and request settings.
PARAGRAPH_SEPARATOR = "\n\n"
BATCH_SEPARATOR = "\n\n---PARAGRAPH_BREAK---\n\n"
MAX_CHARS = 3000
BATCH_SIZE = 32
TEMPERATURE = 0.1
MAX_ATTEMPTS = 3
# Our own bound on calls: texts in one call.
TEXTS_PER_CALL = 1
NO_RESULT_ERROR = "未知错误"

# The system prompts, {target_lang} is filled in per request.
TEXT_PROMPT = (
    "You are a professional translator. "
    "Translate the following text into {target_lang}. "
    "Preserve the original format (markdown, html tags, line breaks) as much as possible. "
    "Only return the translated text without explanations."
)
BATCH_PROMPT = (
    "You are a professional translator. "
    "Translate the following text into {target_lang}. "
    "Preserve the original format (markdown, html tags, line breaks) as much as possible. "
    "The text contains multiple paragraphs separated by '---PARAGRAPH_BREAK---'. "
    "You must return the translated text with the exact same separators, one translated paragraph per original paragraph. "
    "Do not add any extra explanation."
)
MARKDOWN_PROMPT = (
    "You are a professional translator. "
    "Translate the following Markdown text into {target_lang}. "
    "CRITICAL REQUIREMENTS:\n"
    "1. Preserve ALL Markdown syntax exactly (headings, lists, tables, code blocks, etc.)\n"
    "2. Do NOT modify any image references like ![alt](path) or image paths\n"
    "3. Do NOT modify any URL links like [text](url)\n"
    "4. Do NOT modify any HTML tags\n"
    "5. Only translate natural language text content\n"
    "6. Return the complete translated text, keeping the same structure"
)

# Stages in running order and stage statuses.
STAGE_PARSE = "parse"
STAGE_LAYOUT = "layout"
STAGE_TRANSLATE = "translate"
STAGES = (STAGE_PARSE, STAGE_LAYOUT, STAGE_TRANSLATE)

PENDING = "pending"
DONE = "done"
SKIPPED = "skipped"
FAILED = "failed"
STATUSES = (PENDING, DONE, SKIPPED, FAILED)

# The characters removed by Python's ``str.strip()``.
WHITESPACE = (
    "\t\n\x0b\x0c\r\x1c\x1d\x1e\x1f \x85\xa0\u1680"
    "\u2000\u2001\u2002\u2003\u2004\u2005\u2006\u2007\u2008\u2009\u200a"
    "\u2028\u2029\u202f\u205f\u3000"
)
BYTE_ORDER_MARK = "\ufeff"
