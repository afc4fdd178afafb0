"""Documents larger than a cell: packing of paragraph rows, and layout JSON in parts.

The results equal those of the operators on whole documents (``chunk_rows``, ``parse_layout`` with
``raw_elements``); a document's rows are spread over any number of tasks.
"""

from __future__ import annotations

import re
from dataclasses import dataclass, field

import pyarrow as pa
from pyspark.sql import DataFrame
from pyspark.sql import functions as F

from foliospark import constants as K
from foliospark.functions.text import without_bom
from foliospark.operators import elements as E
from foliospark.operators.calls import BATCH_CHARS
from foliospark.operators.carry import handed_states
from foliospark.operators.skew import join_one_per_key
from foliospark.session import shared_path

# Paragraphs of one block.
BLOCK = 4096


# Greedy packing.


@dataclass(frozen=True)
class Packing:
    """Carries the length of the open chunk and the number of chunks begun.

    A block's table: its length, then for every paragraph at which its first new chunk may begin: the sum of
    lengths up to it, the length of the chunk open at the block's end, and the chunks begun. A chunk begins
    at the first paragraph whose sum is over what the open chunk has left.
    """

    max_chars: int
    # No chunk is open: whatever comes first is over the limit.
    start: list[int] = field(default_factory=list)

    def first(self, table: list[int], length: int) -> int:
        """Where in the table the new chunk stands, or its end."""
        left = self.max_chars - length
        low, high = 0, (len(table) - 1) // 3
        while low < high:
            middle = (low + high) // 2
            if table[1 + 3 * middle] > left:
                high = middle
            else:
                low = middle + 1
        return 1 + 3 * low

    def apply(self, table: list[int], state: list[int]) -> list[int]:
        at = self.first(table, state[0])
        if at == len(table):
            return [state[0] + table[0], state[1]]
        return [table[at + 1], state[1] + table[at + 2]]

    def compose(self, first: list[int], second: list[int]) -> list[int]:
        out = [first[0] + second[0]]
        for i in range(1, len(first), 3):
            out += [first[i], *self.apply(second, [first[i + 1], first[i + 2]])]
        # The first block is added to the open chunk; of the second, sums beyond the limit are reached once.
        for i in range(1, len(second), 3):
            if len(out) > 1 and out[-3] > self.max_chars:
                break
            if len(out) == 1 or first[0] + second[i] > out[-3]:
                out += [first[0] + second[i], second[i + 1], second[i + 2]]
        return out


def next_starts(lengths, max_chars: int):
    """For each paragraph, where the next chunk begins when one begins there; also the sums before it."""
    import numpy as np

    sums = np.concatenate([[0], np.cumsum(lengths)])
    over = np.searchsorted(sums, sums[:-1] + max_chars, side="right") - 1
    return np.maximum(over, np.arange(1, len(lengths) + 1)), sums


def _block_table(max_chars: int, key: str):
    """A block's paragraphs to its table, kept with their places and lengths for the way back."""

    def run(table: pa.Table) -> pa.Table:
        import numpy as np

        order = np.argsort(table["place"].to_numpy(), kind="stable")
        places, lengths = table["place"].to_numpy()[order], table["length"].to_numpy()[order]
        jump, sums = next_starts(lengths, max_chars)
        n = len(jump)
        open_at_end, begun = [0] * n, [1] * n
        for i in range(n - 1, -1, -1):
            j = int(jump[i])
            open_at_end[i] = int(sums[n] - sums[i]) if j >= n else open_at_end[j]
            begun[i] = 1 if j >= n else 1 + begun[j]
        made, before = [int(sums[n])], -1
        for i, total in enumerate(sums[1:].tolist()):
            if before > max_chars:
                break
            if total > before:
                made += [total, open_at_end[i], begun[i]]
                before = total
        return pa.table(
            {
                key: table[key].slice(0, 1),
                "number": table["block"].slice(0, 1),
                "table": pa.array([made], pa.list_(pa.int64())),
                "places": pa.array([places], pa.list_(pa.int64())),
                "lengths": pa.array([lengths], pa.list_(pa.int64())),
            }
        )

    return run


def _block_chunks(max_chars: int, key: str):
    """``mapInArrow``: blocks with what they are handed to the chunk of each place in the block."""

    def run(batches):
        import numpy as np

        for batch in batches:
            for row in range(batch.num_rows):
                block = batch["number"][row].as_py()
                places, lengths = (batch[c][row].values.to_numpy() for c in ("places", "lengths"))
                length, chunks = batch["state"][row].as_py()
                jump, sums = next_starts(lengths, max_chars)
                begins = np.zeros(len(places), np.int64)
                i = int(np.searchsorted(sums[1:], max_chars - length, side="right"))
                while i < len(places):
                    begins[i] = 1
                    i = int(jump[i])
                chunk_of = np.full(int(places[-1] % BLOCK) + 1, -1, np.int64)
                chunk_of[places % BLOCK] = chunks - 1 + np.cumsum(begins)
                yield pa.RecordBatch.from_arrays(
                    [
                        batch[key].slice(row, 1),
                        pa.array([block], pa.int64()),
                        pa.array([chunk_of], pa.list_(pa.int32())),
                    ],
                    [key, "block", "chunk_of"],
                )

    return run


def chunk_paragraph_rows(
    paragraphs: DataFrame,
    key: str,
    separator: str = K.PARAGRAPH_SEPARATOR,
    max_chars: int = K.MAX_CHARS,
) -> DataFrame:
    """One row per chunk (``key``, ``chunk_idx``, ``chunk``) from one row per paragraph.

    ``paragraphs`` has ``key``, ``para_idx`` (from 0, a place once in a document) and ``paragraph``; null
    paragraphs are empty ones. The same chunks as ``chunk_rows`` makes of whole documents. Blocks of consecutive
    paragraphs work out for themselves how they would go on from any open chunk, and then learn from
    which they do. Groups are blocks and chunks, never documents. Lengths alone go through Python.

    Eager: the blocks are written to the shared folder; ``paragraphs`` is read twice.
    """
    spark = paragraphs.sparkSession
    work = shared_path(spark, "paragraphs")
    kind = paragraphs.schema[key].dataType.simpleString()
    rows = paragraphs.select(
        key,
        F.floor(F.col("para_idx") / BLOCK).cast("bigint").alias("block"),
        F.col("para_idx").cast("bigint").alias("place"),
        F.coalesce("paragraph", F.lit("")).alias("paragraph"),
    )
    lengths = rows.select(key, "block", "place", F.length("paragraph").cast("bigint").alias("length"))
    blocks = lengths.groupBy(key, "block").applyInArrow(
        _block_table(max_chars, key),
        f"`{key}` {kind}, number bigint, table array<bigint>, places array<bigint>, lengths array<bigint>",
    )
    blocks.write.parquet(f"{work}/blocks")
    blocks = spark.read.schema(blocks.schema).parquet(f"{work}/blocks")
    carry = Packing(max_chars, [max_chars + 1, 0])
    states = handed_states(blocks, key, carry, f"{work}/states")
    placed = blocks.select(key, "number", "places", "lengths").join(states, [key, "number"])
    placed = placed.mapInArrow(_block_chunks(max_chars, key), f"`{key}` {kind}, block bigint, chunk_of array<int>")
    joined = rows.join(placed, [key, "block"])
    chunk = F.get("chunk_of", (F.col("place") % BLOCK).cast("int"))
    pairs = F.array_sort(F.collect_list(F.struct("place", "paragraph")))
    grouped = joined.groupBy(key, chunk.alias("chunk_idx")).agg(pairs.alias("pairs"))
    return grouped.select(key, "chunk_idx", F.array_join("pairs.paragraph", separator).alias("chunk"))


# Layout JSON.

# What follows inside a string up to its closing quote; whole strings and structure outside of them.
_INSIDE = re.compile(r'(?:[^"\\]++|\\.)*+', re.DOTALL)
_OUTSIDE = re.compile(r'"(?:[^"\\]++|\\.)*+("|\\|)|[\[\]{},]', re.DOTALL)
OUTSIDE, INSIDE, ESCAPED = 0, 1, 2
_BLANK = " \t\r\n"


def structure(text: str, mode: int) -> tuple[list[tuple[int, str]], int]:
    """Brackets and commas outside of strings with their places, and the mode at the end of ``text``."""
    at = 0
    if mode == ESCAPED:
        if not text:
            return [], ESCAPED
        at, mode = 1, INSIDE
    if mode == INSIDE:
        at = _INSIDE.match(text, at).end()
        if at == len(text):
            return [], INSIDE
        if text[at] == "\\":
            return [], ESCAPED
        at += 1
    found, mode = [], OUTSIDE
    for m in _OUTSIDE.finditer(text, at):
        if m.group(1) is None:
            found.append((m.start(), m.group()))
        elif m.group(1) != '"':
            mode = ESCAPED if m.group(1) else INSIDE
    return found, mode


class Nesting:
    """Carries the mode, the depth of brackets, and the borders of elements so far: the opening of the
    outermost array and the commas right in it.

    A part's table holds for each mode: its length, the mode and depth it leaves, and how many of its
    commas and opening square brackets stand at (lead to) each depth, as seen from where it starts.
    """

    start = [OUTSIDE, 0, 0]

    @staticmethod
    def table(text: str) -> list[int]:
        out: list[int] = []
        for mode in (OUTSIDE, INSIDE, ESCAPED):
            marks, left = structure(text, mode)
            depth, borders = 0, {}
            for _, c in marks:
                depth += (c in "[{") - (c in "]}")
                if c in "[,":
                    borders[depth] = borders.get(depth, 0) + 1
            out += Nesting.entry(left, depth, borders)
        return out

    @staticmethod
    def entry(mode: int, depth: int, borders: dict[int, int]) -> list[int]:
        return [2 + 2 * len(borders), mode, depth, *[x for pair in sorted(borders.items()) for x in pair]]

    @staticmethod
    def entries(table: list[int]) -> list[tuple[int, int, dict[int, int]]]:
        out, at = [], 0
        while at < len(table):
            values = table[at + 1 : at + 1 + table[at]]
            out.append((values[0], values[1], dict(zip(values[2::2], values[3::2], strict=True))))
            at += 1 + table[at]
        return out

    def apply(self, table: list[int], state: list[int]) -> list[int]:
        mode, depth, borders = self.entries(table)[state[0]]
        return [mode, state[1] + depth, state[2] + borders.get(1 - state[1], 0)]

    def compose(self, first: list[int], second: list[int]) -> list[int]:
        out, later = [], self.entries(second)
        for mode, depth, borders in self.entries(first):
            left, more, others = later[mode]
            both = dict(borders)
            for d, n in others.items():
                both[depth + d] = both.get(depth + d, 0) + n
            out += self.entry(left, depth + more, both)
        return out


def _part_tables(key: str):
    def run(batches):
        for batch in batches:
            tables = [Nesting.table(t.as_py() or "") for t in batch["piece"]]
            yield pa.RecordBatch.from_arrays(
                [batch[key], batch["number"], pa.array(tables, pa.list_(pa.int64()))], [key, "number", "table"]
            )

    return run


def cut_elements(text: str, state: list[int]):
    """The pieces of elements in a part as (element, text, begins here, ends here), and how often the
    outermost array opens and closes and what else stands outside of it."""
    mode, depth, borders = state
    marks, _ = structure(text, mode)
    pieces, opens, closes, junk = [], 0, 0, 0
    at, begins = 0, False
    for place, c in marks:
        if depth <= 0:
            junk += bool(text[at:place].strip(_BLANK))
            at = place + 1
            if c == "[" and depth == 0:
                opens, borders, begins = opens + 1, borders + 1, True
            else:
                junk += 1
        elif depth == 1 and c in ",]}":
            pieces.append((borders - 1, text[at:place], begins, True))
            at, begins = place + 1, True
            borders += c == ","
            closes += c == "]"
            junk += c == "}"
        depth += (c in "[{") - (c in "]}")
    if depth > 0:
        pieces.append((borders - 1, text[at:], begins, False))
    else:
        junk += bool(text[at:].strip(_BLANK))
    return pieces, opens, closes, junk


def _part_elements(key: str):
    names = [key, "number", "element", "text", "whole", "opens", "closes", "junk", "lost"]
    kinds = [pa.int64(), pa.int64(), pa.string(), pa.bool_(), pa.int64(), pa.int64(), pa.int64(), pa.int64()]

    def run(batches):
        for batch in batches:
            owners, rows, held = [], [], 0
            for row in range(batch.num_rows):
                number, piece, state = (batch[c][row].as_py() for c in ("number", "piece", "state"))
                pieces, *counts = cut_elements(piece or "", state)
                # A row for the part itself, then one for each piece.
                rows.append((number, None, None, None, *counts, int(piece is None)))
                rows += [(number, e, t, begins and ends, None, None, None, None) for e, t, begins, ends in pieces]
                owners += [row] * (len(pieces) + 1)
                held += len(piece or "")
                if held >= BATCH_CHARS or row + 1 == batch.num_rows:
                    columns = [pa.array(c, kind) for c, kind in zip(zip(*rows), kinds)]
                    yield pa.RecordBatch.from_arrays([batch[key].take(pa.array(owners)), *columns], names)
                    owners, rows, held = [], [], 0

    return run


def layout_elements_of_parts(parts: DataFrame, key: str) -> DataFrame:
    """Raw elements of layout JSON that comes in parts: what ``parse_layout`` and ``raw_elements`` give
    with ``outer`` for whole texts, with ``success`` and ``error``.

    ``parts`` has ``key``, ``number`` (from 0) and ``piece``, pieces of the text cut anywhere between characters; a
    null piece is a lost one and fails its document. An automaton for strings and brackets says of every part
    how deep it starts, so that the array is cut at the borders of its elements; elements within a part stay
    where they are, others are put together from theirs. A group is one element, which has to fit into a
    cell; a document need not.

    Eager: tables of the parts and opened elements are written to the shared folder; ``parts`` is read twice.
    """
    spark = parts.sparkSession
    work = shared_path(spark, "layout-parts")
    kind = parts.schema[key].dataType.simpleString()

    def written(df: DataFrame, name: str) -> DataFrame:
        df.write.parquet(f"{work}/{name}")
        return spark.read.schema(df.schema).parquet(f"{work}/{name}")

    number = F.col("number").cast("bigint")
    piece = F.when(number == 0, without_bom(F.col("piece"))).otherwise(F.col("piece"))
    rows = parts.select(key, number.alias("number"), piece.alias("piece"))
    tables = written(rows.mapInArrow(_part_tables(key), f"`{key}` {kind}, number bigint, table array<bigint>"), "tables")
    states = handed_states(tables, key, Nesting(), f"{work}/states")
    cut = rows.join(states, [key, "number"]).mapInArrow(
        _part_elements(key),
        f"`{key}` {kind}, number bigint, element bigint, text string, whole boolean, opens bigint, closes bigint, junk bigint, "
        "lost bigint",
    )
    cut = written(cut, "cut")

    split = cut.filter("not whole").groupBy(key, "element").agg(
        F.array_sort(F.collect_list(F.struct("number", "text"))).alias("pieces")
    )
    texts = cut.filter("whole").select(key, "element", "text").unionByName(
        split.select(key, "element", F.array_join("pieces.text", "").alias("text"))
    )
    blank = F.ltrim("text", F.lit(_BLANK)) == ""
    json = F.when(~blank, F.concat(F.lit("["), "text", F.lit("]")))
    opened = E.parse_layout(texts.select(key, "element", blank.alias("blank"), json.alias("layout_json")))
    opened = opened.withColumn("ok", F.col("success"))
    raw = written(E.raw_elements(opened, [key, "element", "blank", "ok"], outer=True).drop("elem_idx"), "raw")

    # What the parts and the elements say of their document. One blank element is an empty array.
    of_parts = cut.filter("element is null").groupBy(key).agg(
        *[F.sum(c).alias(c) for c in ("opens", "closes", "junk", "lost")], F.count(F.lit(1)).alias("n_parts")
    )
    of_elements = raw.groupBy(key).agg(
        F.count_if(~F.col("ok")).alias("bad"), F.count_if("blank").alias("blanks"), F.count(F.lit(1)).alias("n")
    )
    documents = of_parts.join(of_elements, key, "left")
    fine = (F.col("bad") == 0) | ((F.col("n") == 1) & (F.col("blanks") == 1))
    framed = (F.col("opens") == 1) & (F.col("closes") == 1) & (F.col("junk") == 0)
    success = framed & (F.col("lost") == 0) & F.coalesce(fine, F.lit(False))
    documents = documents.select(
        key,
        success.alias("success"),
        F.when(success, "")
        .when((F.col("lost") > 0) & (F.col("n_parts") == 1), E.NO_LAYOUT)
        .otherwise(E.BAD_LAYOUT)
        .alias("error"),
        (F.coalesce("n", F.lit(0)) - F.coalesce("blanks", F.lit(0))).alias("n"),
    )
    documents = written(documents, "documents")
    filled = raw.filter("not blank").drop("blank", "ok")
    found = join_one_per_key(filled, documents.drop("n"), key, [key, "element"]).filter("success")
    fields = [c for c in filled.columns if c not in (key, "element")]
    types = {f.name: f.dataType for f in filled.schema.fields}
    alone = documents.filter(~F.col("success") | (F.col("n") == 0)).select(
        key, "success", "error", F.lit(None).cast("int").alias("elem_idx"),
        *[F.lit(None).cast(types[c]).alias(c) for c in fields],
    )
    alone = alone.withColumn("n_bad_fields", F.lit(0))
    return found.select(key, "success", "error", F.col("element").cast("int").alias("elem_idx"), *fields).unionByName(alone)


def text_in_parts(docs: DataFrame, key: str, text: str, size: int) -> DataFrame:
    """``text`` cut into parts of ``size`` characters, as the operators above take them."""
    n = F.greatest(F.ceil(F.length(text) / size), F.lit(1)).cast("int")
    starts = F.sequence(F.lit(0), F.coalesce(n, F.lit(1)) - 1)
    pieces = F.transform(starts, lambda i: F.substr(F.col(text), i * size + 1, F.lit(size)))
    return docs.select(key, F.posexplode(pieces).alias("number", "piece"))
