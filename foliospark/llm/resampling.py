"""Importance resampling towards the distribution of a target table, on hashed word features.

Features are words and pairs of adjacent words; the CRC-32 of a feature's bytes picks its bucket.
Checksums are computed for many features at once: the distinct features of some texts are put
into matrices of bytes, one matrix for each length, a feature per column, and all checksums of a
matrix advance by one byte position at a time. The buckets are then scattered back to the places
of the features.

Two passes over the texts: one counts buckets, with a partial sum for each task; one gives each text the mean
gain of its features. Counts of ``buckets`` numbers are all that the driver ever holds.
"""

from __future__ import annotations

import math
import zlib
from collections.abc import Iterator
from dataclasses import dataclass

import pyarrow as pa
from pyspark.sql import Column, DataFrame
from pyspark.sql import functions as F

from foliospark.llm.common import Ids, byte_words, id_and_text, numbered
from foliospark.session import shared_path


@dataclass(frozen=True)
class Settings:
    """Of the texts with at least ``least_words`` words, ``percent`` in a hundred are drawn."""

    buckets: int = 10_000
    least_words: int = 20
    percent: int = 25
    seed: int = 7


# Words of the texts that are hashed together, and bytes of one matrix.
WORDS, MATRIX = 1 << 19, 1 << 22


def crc_table():
    """CRC-32 of a byte, as one step of the register: the reflected polynomial 0xEDB88320."""
    import numpy as np

    table = np.arange(256, dtype=np.uint32)
    for _ in range(8):
        table = np.where(table & 1, (table >> 1) ^ np.uint32(0xEDB88320), table >> 1)
    return table


class FeatureBuckets:
    """Buckets of the features of several texts at a time."""

    def __init__(self, buckets: int):
        self.buckets, self.table = buckets, crc_table()

    def crcs(self, data, first, first_size, second, size):
        """CRC-32 of strings that are ``first_size`` bytes of ``data`` from ``first`` on and then
        bytes from ``second`` on, ``size`` in all."""
        import numpy as np

        out = np.empty(len(size), np.uint32)
        order = np.argsort(size, kind="stable")
        lengths, starts = np.unique(size[order], return_index=True)
        for length, group in zip(lengths.tolist(), np.split(order, starts[1:]), strict=True):
            step = max(1, MATRIX // length)
            for at in range(0, len(group), step):
                some = group[at : at + step]
                column = np.arange(length)[:, None]
                mine = column < first_size[some]
                places = np.where(mine, first[some], second[some] - first_size[some]) + column
                out[some] = self.of_matrix(data[places])
        return out

    def of_matrix(self, matrix):
        """CRC-32 of each column of a matrix of bytes. A few long strings are not worth a step of
        numpy for each byte position."""
        import numpy as np

        length, n = matrix.shape
        if length > 64 * n:
            return np.array([zlib.crc32(matrix[:, i].tobytes()) for i in range(n)], np.uint32)
        crc = np.full(n, 0xFFFFFFFF, np.uint32)
        for row in matrix:
            crc = self.table[(crc ^ row) & 0xFF] ^ (crc >> 8)
        return crc ^ np.uint32(0xFFFFFFFF)

    def __call__(self, texts: list[list[bytes]]):
        """(start and end of each text's words, buckets of all words, buckets of all pairs, mask of
        the pairs that stand in one text); pair i is of words i and i + 1."""
        import numpy as np

        ids = Ids()
        sizes = np.array([len(words) for words in texts], np.int64)
        ends = np.cumsum(sizes)
        total = int(ends[-1]) if len(ends) else 0
        every = (w for words in texts for w in words)
        word = np.fromiter(map(ids.__getitem__, every), np.int64, total)
        if not total:
            none = np.empty(0, np.int64)
            return ends - sizes, ends, none, none, np.empty(0, bool)
        data = np.frombuffer(b" ".join([*ids.names, b""]), np.uint8)  # each word with a space
        length = np.array(list(map(len, ids.names)), np.int64)
        start = np.cumsum(length + 1) - length - 1
        of_word = self.crcs(data, start, length, start, length) % self.buckets
        inside = np.ones(max(0, total - 1), bool)
        inside[ends[(ends > 0) & (ends < total)] - 1] = False
        pair, at = np.unique(word[:-1] * len(length) + word[1:], return_inverse=True)
        a, b = np.divmod(pair, len(length))
        of_pair = self.crcs(data, start[a], length[a] + 1, start[b], length[a] + 1 + length[b])
        of_pair %= self.buckets
        return ends - sizes, ends, of_word[word].astype(np.int64), of_pair[at].astype(np.int64), inside


def some_texts(texts: pa.Array) -> Iterator[tuple[int, list[list[bytes]]]]:
    """(position of the first, words of each) of consecutive texts with about ``WORDS`` words."""
    first, held, n = 0, [], 0
    for i, text in enumerate(texts.cast(pa.binary())):
        held.append(byte_words(text.as_py() or b""))
        n += len(held[-1])
        if n >= WORDS:
            yield first, held
            first, held, n = i + 1, [], 0
    if held:
        yield first, held


def bucket_counter(buckets: int):
    """``mapInArrow`` function from texts to the number of features in each bucket."""

    def run(batches):
        import numpy as np

        hashed, counts = FeatureBuckets(buckets), np.zeros(buckets, np.int64)
        for batch in batches:
            for _, texts in some_texts(batch.column(0)):
                _, _, words, pairs, inside = hashed(texts)
                counts += np.bincount(words, minlength=buckets)
                counts += np.bincount(pairs[inside], minlength=buckets)
        found = np.flatnonzero(counts)
        yield pa.RecordBatch.from_pydict({"bucket": found.astype(np.int32), "n": counts[found]})

    return run


def weigher(gains: list[int], buckets: int):
    """``mapInArrow`` function from (id, text) to (id, words, features, weight)."""

    def run(batches):
        import numpy as np

        hashed, gain = FeatureBuckets(buckets), np.array(gains, np.int64)
        names = ["doc_id", "n_words", "n_features", "weight"]
        for batch in batches:
            for first, texts in some_texts(batch.column(1)):
                start, end, words, pairs, inside = hashed(texts)
                n = end - start
                sums = np.concatenate([[0], np.cumsum(gain[words])])
                both = np.concatenate([[0], np.cumsum(np.where(inside, gain[pairs], 0)), [0]])
                last = np.maximum(start, end - 1)
                total = sums[end] - sums[start] + np.where(n > 1, both[last] - both[start], 0)
                features = n + np.maximum(n - 1, 0)
                weight = np.where(features > 0, total // np.maximum(features, 1), 0)
                ids = batch.column(0).slice(first, len(texts))
                yield pa.RecordBatch.from_arrays([ids, *map(pa.array, (n, features, weight))], names)

    return run


def feature_counts(docs: DataFrame, text_col: str = "text", settings: Settings = Settings()) -> list[int]:
    """Features of all texts in each bucket. A task gives one row for each bucket, Spark sums."""
    rows = docs.select(F.col(text_col).alias("text"))
    parts = rows.mapInArrow(bucket_counter(settings.buckets), "bucket int, n bigint")
    counts = [0] * settings.buckets
    for bucket, n in parts.groupBy("bucket").agg(F.sum("n")).collect():
        counts[bucket] = n
    return counts


def bucket_gains(source: list[int], target: list[int]) -> list[int]:
    """Thousandths of the logarithm of target over source frequency, one added to each count."""
    s_all, t_all = float(sum(source) + len(source)), float(sum(target) + len(target))
    return [
        math.floor(1000 * math.log(((t + 1) * s_all) / ((s + 1) * t_all)))
        for s, t in zip(source, target, strict=True)
    ]


def noise(doc_id: Column, seed: int) -> Column:
    """Thousandths of a Gumbel variable that depends on the seed and the id alone."""
    name = F.concat(F.lit(f"{seed}:"), F.coalesce(doc_id.cast("string"), F.lit("")))
    h = F.conv(F.substring(F.sha2(name, 256), 1, 8), 16, 10).cast("double")
    return F.floor(F.lit(-1000.0) * F.log(-F.log((h + 0.5) / 4294967296.0)))


def resample(
    docs: DataFrame,
    target: DataFrame,
    id_col: str = "doc_id",
    text_col: str = "text",
    target_text: str = "text",
    settings: Settings = Settings(),
) -> DataFrame:
    """(doc_id, n_words, n_features, weight, score, rank), one row per row of ``docs``.

    ``weight`` is the floored mean gain of the text's features and ``score`` adds noise to it, so that
    the highest scores are a draw without replacement in proportion to the weights. ``rank`` is 1, 2, 3... of the
    drawn rows by score, equal scores by id (null ids last), else null.

    A null or empty text has no features and weight 0, and is never drawn unless ``least_words`` is 0.
    Repeated rows are rows of their own with equal scores; which of them gets which rank is open. An
    empty target counts one for each bucket, as does an empty ``docs``. Other columns are not looked
    at. A text's words are held by one task; the texts are not written and not shuffled.

    Eager: weights and ranks are written to the shared folder. Ranks come from a range-partitioned
    sort, so a single task never sees all rows.
    """
    work = shared_path(docs.sparkSession, "resample")
    rows = id_and_text(docs, id_col, text_col)
    kind = rows.schema["doc_id"].dataType.simpleString()
    gains = bucket_gains(
        feature_counts(rows, "text", settings), feature_counts(target, target_text, settings)
    )
    weighed = rows.mapInArrow(
        weigher(gains, settings.buckets), f"doc_id {kind}, n_words bigint, n_features bigint, weight bigint"
    )
    weighed.write.parquet(f"{work}/weights")
    weighed = docs.sparkSession.read.schema(weighed.schema).parquet(f"{work}/weights")
    scored = weighed.withColumn("score", F.col("weight") + noise(F.col("doc_id"), settings.seed))
    enough = F.col("n_words") >= settings.least_words
    eligible = scored.filter(enough)
    drawn = eligible.count() * settings.percent // 100
    order = (F.col("score").desc(), F.col("doc_id").asc_nulls_last())
    ranked = numbered(eligible, f"{work}/ranked", "rank", order)
    ranked = ranked.withColumn("rank", F.when(F.col("rank") < drawn, F.col("rank") + 1))
    return ranked.unionByName(scored.filter(~enough).withColumn("rank", F.lit(None).cast("bigint")))
