"""Joining many rows to one row per key when a few keys hold most of the rows."""

from __future__ import annotations

from pyspark.sql import DataFrame
from pyspark.sql import functions as F

# Parts that the rows of one key are dealt to.
SALTS = 256


def join_one_per_key(
    many: DataFrame, one: DataFrame, key: str, row_key: list[str], salts: int = SALTS
) -> DataFrame:
    """Left join of ``many`` to ``one``, which has one row per ``key``.

    Every key's rows are dealt to ``salts`` parts by a hash of ``row_key``, and ``one`` is repeated
    for just those parts that occur: as often as a key has rows at the most. No key is singled
    out, so nothing is counted, listed or broadcast.
    """
    salted = many.withColumn("_salt", F.pmod(F.xxhash64(*row_key), F.lit(salts)).cast("int"))
    parts = salted.select(key, "_salt").distinct().join(one, key)
    return salted.join(parts, [key, "_salt"], "left").drop("_salt")
