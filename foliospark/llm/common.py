"""Words, struct-valued text operators and other small helpers of this package."""

from __future__ import annotations

import re
from collections.abc import Callable, Iterator

import pyarrow as pa
from pyspark.sql import Column, DataFrame
from pyspark.sql import functions as F
from pyspark.sql import types as T
from pyspark.sql.pandas.types import to_arrow_type

# Words of a text whose A-Z are lower-cased: everything but ASCII other than 0-9 and a-z.
WORD = r"[^\x00-\x2F\x3A-\x60\x7B-\x7F]+"
# Rows handed on at a time, so that the results of a batch are not all held twice.
ROWS = 512


def lower_ascii(text: str) -> str:
    """A-Z in lower case, every other character as it is."""
    return text.encode("utf-8", "surrogatepass").lower().decode("utf-8", "surrogatepass")


def words_column(text: Column) -> Column:
    """The words of a text as a Spark expression; null has none."""
    lower = F.translate(
        F.coalesce(text, F.lit("")), "ABCDEFGHIJKLMNOPQRSTUVWXYZ", "abcdefghijklmnopqrstuvwxyz"
    )
    return F.regexp_extract_all(lower, F.lit(WORD), F.lit(0))


def word_finder() -> Callable[[str], list[str]]:
    find = re.compile(WORD).findall
    return lambda text: find(lower_ascii(text))


def struct_udf(setup: Callable[[], Callable[..., tuple]], schema: str):
    """An Arrow function over columns whose result is one struct per row.

    ``setup`` runs once per task and returns the function of one row's values. Rows are handed
    over one by one, so a batch never exists a second time as Python objects. Spark must not
    compute the function twice for one row, hence the mark as non-deterministic.
    """
    kind = T._parse_datatype_string(schema)
    arrow = to_arrow_type(kind)

    def run(batches: Iterator) -> Iterator[pa.Array]:
        one = setup()
        for batch in batches:
            columns = batch if isinstance(batch, tuple) else (batch,)
            parts = []
            for start in range(0, len(columns[0]), ROWS):
                rows = [c.slice(start, ROWS) for c in columns]
                made = [one(*(v.as_py() for v in row)) for row in zip(*rows, strict=True)]
                parts.append(
                    pa.array(
                        [dict(zip(kind.names, x, strict=True)) for x in made], type=arrow
                    )
                )
            joined = pa.chunked_array(parts, type=arrow).combine_chunks() if parts else None
            if isinstance(joined, pa.ChunkedArray):
                joined = pa.concat_arrays(joined.chunks)
            yield joined if joined is not None else pa.array([], type=arrow)

    # Spark reads the kind of function off these hints; single columns come as plain arrays.
    def single(batches: Iterator[pa.Array]) -> Iterator[pa.Array]:
        yield from run(batches)

    def several(batches: Iterator[tuple[pa.Array, ...]]) -> Iterator[pa.Array]:
        yield from run(batches)

    single.__annotations__ = {"batches": Iterator[pa.Array], "return": Iterator[pa.Array]}
    several.__annotations__ = {
        "batches": Iterator[tuple[pa.Array, ...]],
        "return": Iterator[pa.Array],
    }
    one_column = F.arrow_udf(single, kind).asNondeterministic()
    more_columns = F.arrow_udf(several, kind).asNondeterministic()
    return lambda *columns: (one_column if len(columns) == 1 else more_columns)(*columns)


def fresh(df: DataFrame, name: str) -> str:
    """``name``, lengthened until it clashes with no column of ``df``."""
    taken = {c.lower() for c in df.columns}
    while name.lower() in taken:
        name += "_"
    return name


def id_and_text(df: DataFrame, id_col: str, text_col: str) -> DataFrame:
    """Key and text alone, under fixed names, whatever else the table holds."""
    return df.select(F.col(id_col).alias("doc_id"), F.col(text_col).alias("text"))


# ASCII bytes that end a word become spaces, A-Z become a-z; bytes beyond ASCII stay.
_WORD_BYTES = bytes(
    b + 32 if 0x41 <= b <= 0x5A else b if b >= 0x80 or chr(b).isalnum() else 0x20 for b in range(256)
)


def byte_words(raw: bytes) -> list[bytes]:
    """The words of :func:`word_finder` from UTF-8 bytes, as UTF-8 bytes."""
    return raw.translate(_WORD_BYTES).split()


class Ids(dict):
    """Numbers keys from 0 as they are first looked up; ``names`` are the keys in that order."""

    def __init__(self):
        self.names: list = []

    def __missing__(self, key):
        n = self[key] = len(self.names)
        self.names.append(key)
        return n


def numbered(df: DataFrame, path: str, into: str = "row_no", order: tuple[Column, ...] = ()) -> DataFrame:
    """``df`` written to ``path`` and read back, its rows numbered 0, 1, 2... in ``order``.

    No task sees more than its own rows: every task numbers the rows it writes, and the number of
    rows of each earlier task is added on reading. The driver holds one count per task of the
    write.
    """
    spark = df.sparkSession
    shift = 33  # of Spark's ids: the task above, its rows below
    at, task = fresh(df, "_at"), fresh(df, "_task")
    sorted_rows = df.orderBy(*order) if order else df
    sorted_rows.withColumn(at, F.monotonically_increasing_id()).write.parquet(path)
    schema = T.StructType([*df.schema.fields, T.StructField(at, T.LongType())])
    rows = spark.read.schema(schema).parquet(path).withColumn(task, F.shiftright(at, shift))
    offsets, before = [], 0
    for found in sorted(tuple(r) for r in rows.groupBy(task).count().collect()):
        offsets.append((found[0], before - (found[0] << shift)))
        before += found[1]
    shifts = spark.createDataFrame(offsets, f"{task} bigint, `{into}` bigint")
    joined = rows.join(F.broadcast(shifts), task)
    return joined.select(*df.columns, (F.col(into) + F.col(at)).alias(into))
