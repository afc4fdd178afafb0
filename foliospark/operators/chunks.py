"""Paragraphs, chunks and row batches."""

from __future__ import annotations

from pyspark.sql import Column, DataFrame
from pyspark.sql import functions as F

from foliospark import constants as K
from foliospark.functions import text as T


def paragraphs(
    docs: DataFrame, keys: list[str], content: str = "content", separator=K.PARAGRAPH_SEPARATOR
) -> DataFrame:
    """One row per paragraph, empty ones included, in document order."""
    return docs.select(
        *keys,
        F.posexplode(T.split_literal(F.col(content), separator)).alias("para_idx", "paragraph"),
    )


def _with_starts(docs: DataFrame, content: str, separator: str, max_chars: int) -> DataFrame:
    """Add the paragraph array, the paragraph lengths and the chunk offsets as columns.

    Each is used more than once by what follows, which keeps the optimizer from merging the
    projections and so from repeating the split for every chunk.
    """
    return (
        docs.withColumn("_paragraphs", T.split_literal(F.col(content), separator))
        .withColumn("_lengths", F.transform("_paragraphs", lambda p: F.length(p)))
        .withColumn("_starts", T.chunk_starts(F.col("_lengths"), max_chars))
    )


def with_chunks(
    docs: DataFrame,
    content: str = "content",
    separator: str = K.PARAGRAPH_SEPARATOR,
    max_chars: int = K.MAX_CHARS,
) -> DataFrame:
    """Add ``chunks``, the document's paragraphs packed into size-bounded texts.

    Narrow: no shuffle, no Python.
    """
    chunks = T.join_slices(F.col("_paragraphs"), F.col("_starts"), separator)
    return (
        _with_starts(docs, content, separator, max_chars)
        .withColumn("chunks", chunks)
        .drop("_paragraphs", "_lengths", "_starts")
    )


def chunk_rows(
    docs: DataFrame,
    keys: list[str],
    content: str = "content",
    separator: str = K.PARAGRAPH_SEPARATOR,
    max_chars: int = K.MAX_CHARS,
) -> DataFrame:
    """One row per chunk: the keys, ``chunk_idx`` and ``chunk``.

    The chunks are exploded as an expression. Exploding a column would make the optimizer infer a
    filter on it, push that to the scan and compute every chunk a second time there.
    """
    chunks = T.join_slices(F.col("_paragraphs"), F.col("_starts"), separator)
    return _with_starts(docs, content, separator, max_chars).select(
        *keys, F.posexplode(chunks).alias("chunk_idx", "chunk")
    )


def reassemble(
    chunks: DataFrame, keys: list[str], text: str = "chunk", separator=K.PARAGRAPH_SEPARATOR
) -> DataFrame:
    """Put the chunks of every document back together, in order.

    A document came out of one text cell and goes back into one, so a group is bounded by the
    cell size. Use :func:`reassemble_parts` for chunk tables with documents beyond that.
    """
    pairs = F.array_sort(F.collect_list(F.struct("chunk_idx", F.col(text).alias("txt"))))
    return (
        chunks.groupBy(*keys)
        .agg(pairs.alias("pairs"))
        .select(*keys, F.array_join(F.col("pairs.txt"), separator).alias("content"))
    )


def reassemble_parts(
    chunks: DataFrame,
    keys: list[str],
    text: str = "chunk",
    separator=K.PARAGRAPH_SEPARATOR,
    chunks_per_part: int = 1024,
) -> DataFrame:
    """Like :func:`reassemble`, with long documents spread over rows numbered ``part_no``.

    Joining the parts of a document in order with the separator gives the whole document. The
    group is a fixed number of chunks, so one document may hold any share of the table.
    """
    parts = chunks.withColumn("part_no", F.floor(F.col("chunk_idx") / chunks_per_part))
    return reassemble(parts, [*keys, "part_no"], text, separator)


def pack_batches(
    rows: DataFrame,
    keys: list[str],
    index: str,
    text: str = "text",
    batch_size: int = K.BATCH_SIZE,
) -> DataFrame:
    """Pack consecutive rows into one request text per batch.

    ``index`` is the zero-based position within the document, so batches need no window and no
    order over a whole document: a group is at most ``batch_size`` rows, and the batches of one
    document spread over all tasks. ``rows`` keeps every row in order; ``combined`` joins the
    non-blank texts and is NULL when there is nothing to send.
    """
    size = max(1, batch_size)
    row = F.struct(
        F.col(index).alias("row_idx"), F.col(text).alias("text"), T.is_blank(F.col(text)).alias("blank")
    )
    grouped = (
        rows.withColumn("batch_id", F.floor(F.col(index) / size))
        .groupBy(*keys, "batch_id")
        .agg(F.array_sort(F.collect_list(row)).alias("rows"))
    )
    kept = F.filter("rows", lambda r: ~r["blank"])
    return grouped.withColumn("kept", kept).select(
        *keys,
        "batch_id",
        "rows",
        F.size("kept").alias("n_sent"),
        F.when(F.size("kept") > 0, F.array_join(F.col("kept.text"), K.BATCH_SEPARATOR)).alias(
            "combined"
        ),
    )


def lost_rows(sent: Column, parts: Column) -> Column:
    """Which texts of ``sent`` have no part among fewer ``parts``: their places, ascending.

    Parts and texts keep their order, and the pairing whose lengths differ least in all is chosen; of equal
    ones that which loses later texts. A table over texts and parts, a row at a time. NULL where
    either is NULL, empty where there are parts for all.
    """
    lengths = F.transform(sent, lambda x: F.length(T.strip(x)).cast("bigint"))
    made = F.transform(parts, lambda x: F.length(T.strip(x)).cast("bigint"))
    # The best way to pair the texts so far with the first j parts: its cost and what it loses,
    # places as negative numbers so that the least of equal ones loses the later text.
    state = "struct<cost:bigint,lost:array<int>>"
    nothing = F.struct(F.lit(0).cast("bigint").alias("cost"), F.array().cast("array<int>").alias("lost"))
    start = F.transform(
        F.sequence(F.lit(0), F.size(parts)), lambda j: F.when(j == 0, nothing).otherwise(F.lit(None).cast(state))
    )

    def with_text(best: Column, i: Column) -> Column:
        def with_parts(j: Column) -> Column:
            lose, pair = F.get(best, j), F.get(best, j - 1)
            apart = F.abs(F.get(lengths, i) - F.get(made, j - 1))
            return F.least(
                F.when(lose.isNotNull(), F.struct(lose["cost"].alias("cost"), F.array_append(lose["lost"], -i).alias("lost"))),
                F.when(pair.isNotNull(), F.struct((pair["cost"] + apart).alias("cost"), pair["lost"].alias("lost"))),
            )

        return F.transform(F.sequence(F.lit(0), F.size(parts)), with_parts)

    texts = F.sequence(F.lit(0), F.size(sent) - 1)
    best = F.aggregate(texts, start, with_text, lambda x: F.get(x, F.size(parts)))
    lost = F.transform(best["lost"], lambda i: -i)
    return F.when(F.size(parts) < F.size(sent), lost).when(F.size(sent).isNotNull() & parts.isNotNull(), F.array().cast("array<int>"))


def unpack_batches(batches: DataFrame, keys: list[str], index: str = "row_idx", align: bool = False) -> DataFrame:
    """One result per input row from batches with their ``response`` and ``error``.

    The i-th part of a response belongs to the i-th non-blank row. Parts that are missing give
    empty text and count as success, told apart by ``missing_part``; surplus parts are ignored.
    Blank rows succeed with empty text. A failed call (NULL response to a non-empty request)
    fails every row of its batch.

    With ``align`` two more columns say what a response with too few parts is likelier to mean:
    ``lost`` marks the rows whose lengths fit none of the parts, in order, and ``aligned`` is the text that
    the others get.
    """
    parts = T.split_literal(F.col("response"), K.BATCH_SEPARATOR)
    failed = F.col("combined").isNotNull() & F.col("response").isNull()
    sent_rows = F.filter("rows", lambda r: ~r["blank"])
    kept = F.transform(sent_rows, lambda r: r["row_idx"])
    texts = F.transform(sent_rows, lambda r: r["text"])
    opened = batches.withColumn("_parts", parts)
    if align:
        opened = opened.withColumn("_lost", F.when(F.col("combined").isNotNull(), lost_rows(texts, F.col("_parts"))))
    rows = opened.select(
        *keys,
        "batch_id",
        "_parts",
        *["_lost"][: int(align)],
        failed.alias("_failed"),
        kept.alias("_kept"),
        "error",
        F.explode("rows").alias("r"),
    )
    place = F.array_position("_kept", F.col("r.row_idx")).cast("int") - 1
    part = F.get("_parts", place)
    sent = ~F.col("_failed") & ~F.col("r.blank")
    more = []
    if align:
        lost = F.coalesce(F.array_contains("_lost", place), F.lit(False))
        earlier = F.size(F.filter("_lost", lambda x: x < place))
        found = F.coalesce(T.strip(F.get("_parts", place - earlier)), F.lit(""))
        more = [F.when(sent & ~lost, found).otherwise("").alias("aligned"), (sent & lost).alias("lost")]
    return rows.select(
        *keys,
        F.col("r.row_idx").alias(index),
        "batch_id",
        F.col("r.text").alias("original"),
        F.when(sent, F.coalesce(T.strip(part), F.lit(""))).otherwise("").alias("translated"),
        (~F.col("_failed")).alias("success"),
        F.when(F.col("_failed"), F.coalesce("error", F.lit(K.NO_RESULT_ERROR)))
        .otherwise("")
        .alias("error"),
        (sent & part.isNull()).alias("missing_part"),
        *more,
    )


def complete_results(
    rows: DataFrame, results: DataFrame, keys: list[str], text: str = "text"
) -> DataFrame:
    """Exactly one result per input row; rows without one fail as such."""
    found = results.select(
        *keys, "translated", "success", "error", F.lit(True).alias("_found")
    )
    joined = rows.join(found, keys, "left")
    return joined.select(
        *keys,
        F.col(text).alias("original"),
        F.coalesce("translated", F.lit("")).alias("translated"),
        F.coalesce("success", F.lit(False)).alias("success"),
        F.when(F.col("_found").isNull(), K.NO_RESULT_ERROR)
        .otherwise(F.coalesce("error", F.lit("")))
        .alias("error"),
    )
