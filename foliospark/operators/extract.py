"""Raw documents to layout elements."""

from __future__ import annotations

from collections.abc import Callable

from pyspark.sql import DataFrame
from pyspark.sql import functions as F

from foliospark import constants as K
from foliospark.operators import calls


NO_LAYOUT = "no layout file"


def extract_elements(
    files: DataFrame,
    fn: Callable,
    key: str = "doc_id",
    path: str = "path",
    content: str | None = None,
    keep: tuple[str, ...] = (),
    parallelism: int | None = None,
    max_attempts: int = K.MAX_ATTEMPTS,
    wait_seconds: float = 1.0,
) -> DataFrame:
    """Run a user's extractor over documents.

    ``fn(path, content)`` returns the element list (or its JSON text) and the Markdown text or
    None. Without a ``content`` column the task opens each file itself. One row per document
    comes back, with ``success``, ``error`` and the columns to ``keep``; :func:`foliospark.operators.elements.parse_layout`
    takes it from there. The function may run again on a task retry: write the result once and
    read it back before using it twice.
    """
    columns = [key, F.col(path).alias("path")]
    if content:
        columns.append(F.col(content).alias("content"))
    rows = files.select(*columns, *keep)
    if parallelism:
        rows = rows.repartition(parallelism)
    types = {f.name: f"`{f.name}` {f.dataType.simpleString()}" for f in rows.schema.fields}
    schema = f"{types[key]}, layout_json string, markdown string, success boolean, error string"
    schema = ", ".join([schema, *[types[c] for c in keep]])
    task = calls.extract_documents(fn, max_attempts, wait_seconds, bool(content))
    return rows.mapInArrow(task, schema)


def opened_artifacts(docs: DataFrame, keep: tuple[str, ...], parallelism: int | None) -> DataFrame:
    """The layout and Markdown files that a parser has left, in the columns of
    :func:`extract_elements`. The tasks open them; a document without a layout file fails."""
    rows = docs.select("doc_id", "layout_path", "markdown_path", *keep)
    if parallelism:
        rows = rows.repartition(parallelism)
    columns = ", ".join(f"`{f.name}` {f.dataType.simpleString()}" for f in rows.schema.fields)
    opened = rows.mapInArrow(
        calls.open_texts({"layout_path": "layout_json", "markdown_path": "markdown"}),
        f"{columns}, layout_json string, markdown string",
    )
    success = F.col("layout_json").isNotNull()
    error = F.when(success, "").otherwise(NO_LAYOUT)
    return opened.select(
        "doc_id", "layout_json", "markdown", success.alias("success"), error.alias("error"), *keep
    )


# Extraction rule for web pages: tag to raw element type; ``a`` maps to a type outside the set.
PAGE_TAGS = {
    "h1": "title",
    "h2": "title",
    "p": "text",
    "li": "text",
    "nav": "header",
    "header": "header",
    "footer": "footer",
    "table": "table",
    "td": "table",
    "div": "table",
    "img": "image",
    "a": "link",
}
PAGE_PATTERN = r"<(" + "|".join(PAGE_TAGS) + r")\b([^>]*)>([^<]*)"
ELEMENTS_PER_PAGE = 10


def elements_from_html(
    pages: DataFrame, keys: list[str], html: str = "html", outer: bool = False
) -> DataFrame:
    """Raw elements from HTML text, by regular expression and without leaving the JVM.

    The page is matched once; the parts of a match are taken from the short match alone.
    ``outer`` keeps pages without elements as one row with a NULL ``elem_idx``.
    """
    tag = F.regexp_extract("match", PAGE_PATTERN, 1)
    attributes = F.regexp_extract("match", PAGE_PATTERN, 2)
    inner = F.regexp_extract("match", PAGE_PATTERN, 3)
    tags = F.create_map(*[F.lit(x) for pair in PAGE_TAGS.items() for x in pair])
    matches = F.regexp_extract_all(F.col(html), F.lit(PAGE_PATTERN), F.lit(0))
    explode = F.posexplode_outer if outer else F.posexplode
    rows = (
        pages.select(*keys, explode(matches).alias("elem_idx", "match"))
        .select(*keys, "elem_idx", tag.alias("tag"), attributes.alias("attrs"), inner.alias("inner"))
        .withColumn("type", F.element_at(tags, F.col("tag")))
    )
    is_table = F.col("type") == K.TABLE_TYPE
    href = F.regexp_extract("attrs", r'(?:href|src)="([^"]*)"', 1)
    nothing = F.lit(None).cast("string")
    return rows.select(
        *keys,
        "elem_idx",
        "type",
        F.when(~is_table, F.col("inner")).alias("text"),
        F.when(is_table, F.col("inner")).alias("table_body"),
        F.floor(F.col("elem_idx") / ELEMENTS_PER_PAGE).cast("int").alias("page_idx"),
        F.lit(None).cast("array<double>").alias("bbox"),
        F.when(href != "", href).alias("img_path"),
        nothing.alias("table_caption"),
        nothing.alias("table_footnote"),
        F.when(F.col("tag") == "h1", "1").when(F.col("tag") == "h2", "2").alias("text_level"),
        nothing.alias("level"),
    )
