"""What one part of a document hands to the next, found without reading parts one after the other.

A document too large for one task comes in numbered parts. Where the reading of a part depends on
all that stands before it, each part first gives a table of what it would hand on for what it may be
handed; such tables can be put together. Runs of parts are put together until a document is one run; then each
run, from the top down, tells its parts what they are handed. A group is a run of ``FAN`` parts, so a document
may hold any share of the table.
"""

from __future__ import annotations

from typing import Protocol

import pyarrow as pa
from pyspark.sql import DataFrame
from pyspark.sql import functions as F

FAN = 1024


class Carry(Protocol):
    """States and tables are lists of integers."""

    start: list[int]

    def apply(self, table: list[int], state: list[int]) -> list[int]:
        """What a part with this table hands on when it is handed ``state``."""

    def compose(self, first: list[int], second: list[int]) -> list[int]:
        """The table of two parts in a row."""


def _run_up(carry: Carry, key: str):
    """``mapInArrow``: sorted parts to one table for each of their runs."""

    def run(batches):
        place, whole = None, None
        kind = None

        def made(done):
            keys, parents, tables = zip(*done)
            return pa.RecordBatch.from_arrays(
                [pa.array(keys, kind), pa.array(parents, pa.int64()), pa.array(tables, pa.list_(pa.int64()))],
                [key, "number", "table"],
            )

        for batch in batches:
            kind, done = batch.schema.field(key).type, []
            for row, at in enumerate(zip(batch[key].to_pylist(), batch["parent"].to_pylist())):
                table = batch["table"][row].as_py()
                if at == place:
                    whole = carry.compose(whole, table)
                    continue
                if place is not None:
                    done.append((*place, whole))
                place, whole = at, table
            if done:
                yield made(done)
        if place is not None:
            yield made([(*place, whole)])

    return run


def _run_down(carry: Carry, key: str):
    """``mapInArrow``: sorted parts to the state that each is handed in its run."""

    def run(batches):
        place, state = None, None
        for batch in batches:
            states = []
            for row, at in enumerate(zip(batch[key].to_pylist(), batch["parent"].to_pylist())):
                if at != place:
                    place, state = at, batch["handed"][row].as_py()
                states.append(state)
                state = carry.apply(batch["table"][row].as_py(), state)
            yield pa.RecordBatch.from_arrays(
                [batch[key], batch["number"], pa.array(states, pa.list_(pa.int64()))], [key, "number", "state"]
            )

    return run


def handed_states(parts: DataFrame, key: str, carry: Carry, work: str, fan: int = FAN) -> DataFrame:
    """(key, number, state): what each part of a document is handed.

    ``parts`` is a written table of ``key``, ``number`` (ascending in a document, gaps do no harm) and ``table``. Every
    level is written below ``work``; documents of up to ``fan`` parts need one. Runs are sorted within the tasks and
    go through them in batches of many, as most documents are a run of a few parts.
    """
    spark = parts.sparkSession
    kind = parts.schema[key].dataType.simpleString()

    def written(df: DataFrame, name: str) -> DataFrame:
        df.write.parquet(f"{work}/{name}")
        return spark.read.schema(df.schema).parquet(f"{work}/{name}")

    def with_parent(rows: DataFrame) -> DataFrame:
        return rows.withColumn("parent", F.floor(F.col("number") / fan).cast("bigint"))

    def in_runs(rows: DataFrame) -> DataFrame:
        return rows.repartition(key, "parent").sortWithinPartitions(key, "parent", "number")

    levels, last = [parts.select(key, F.col("number").cast("bigint").alias("number"), "table")], 0
    last = parts.agg(F.max("number")).first()[0] or 0
    while last >= fan:
        up = in_runs(with_parent(levels[-1]))
        up = up.mapInArrow(_run_up(carry, key), f"`{key}` {kind}, number bigint, table array<bigint>")
        levels.append(written(up, f"up-{len(levels)}"))
        last //= fan
    states = None
    for n, level in reversed(list(enumerate(levels))):
        rows = with_parent(level)
        if states is None:
            start = F.array(*[F.lit(x).cast("bigint") for x in carry.start])
            rows = rows.withColumn("handed", start)
        else:
            above = states.select(key, F.col("number").alias("parent"), F.col("state").alias("handed"))
            rows = rows.join(above, [key, "parent"])
        down = in_runs(rows).mapInArrow(
            _run_down(carry, key), f"`{key}` {kind}, number bigint, state array<bigint>"
        )
        states = written(down, f"down-{n}")
    return states
