"""Phrases of two to five words that stand together more often than their parts would by chance.

Exact counts come level by level: words, then pairs, then longer phrases, each from places where
both shorter phrases are frequent, so what is rare is left out before it is counted. No
vocabulary need fit into a task:

* Texts are cut into blocks of about half a million words. A block becomes a sequence of its own
  word numbers and the list of its words, which Spark sums and joins to the frequent ones (by
  broadcast while those are small). Frequent words of all languages are numbered from 0, and
  blocks get the numbers of theirs.
* On each level a block makes a counting quotient filter of its phrases. The words' numbers are
  packed into integers of fixed width, an invertible permutation spreads them evenly, the upper
  bits are the quotient and the lower ones the remainder, kept in full: nothing is approximate,
  and the permutation undone gives the phrase. The first bits name the shard.
* The filters of a shard are sorted lists with counters and are merged by sorting; each block is
  told in a bit per phrase which of its phrases were frequent, and goes on with those places.

No phrase can be a hot key, since a block sends each phrase once.
"""

from __future__ import annotations

import struct
from dataclasses import dataclass

import pyarrow as pa
from pyspark.sql import DataFrame, Window
from pyspark.sql import functions as F

from foliospark.llm.common import numbered
from foliospark.operators.skew import join_one_per_key
from foliospark.session import shared_path
from foliospark.sources.tables import small_broadcast


@dataclass(frozen=True)
class Settings:
    """Phrases of 2 to ``longest`` words that occur ``least`` times; those inside a longer
    one that has ``inside_percent`` of their count go; ``first`` of each language are returned."""

    longest: int = 5
    least: int = 100
    inside_percent: int = 100
    first: int = 2000


# Words of a block, bytes of its list of words, and entries of a shard, about.
BLOCK_WORDS, BLOCK_BYTES, SHARD = 1 << 19, 1 << 25, 1 << 19

# A byte that UTF-8 never has stands for the end of a piece; A-Z become a-z.
BREAK = b"\xff"
ENDS = b".,;:!?\n\x0b\x0c\r"
TABLE = bytes.maketrans(
    bytes(range(0x41, 0x5B)) + ENDS, bytes(range(0x61, 0x7B)) + BREAK * len(ENDS)
)


def piece_words(raw: bytes) -> list[bytes]:
    """The words of a text, a break between its pieces and at its end."""
    return (raw + BREAK).translate(TABLE).replace(BREAK, b" \xff ").split()


def packed(values) -> bytes:
    """An array's bytes, compressed: word numbers hold a third of what they take."""
    import zstandard

    return zstandard.compress(values.tobytes())


def unpacked(raw: bytes, kind):
    import numpy as np
    import zstandard

    return np.frombuffer(zstandard.decompress(raw), kind)


class Block:
    """Words of several texts, numbered from 1 by language and word; 0 is a break."""

    def __init__(self):
        self.names: list[tuple[str, bytes]] = []
        self.of_lang: dict[str, Numbers] = {}
        self.parts, self.size, self.bytes = [], 0, 0

    def add(self, lang: str, raw: bytes) -> None:
        import numpy as np

        if lang not in self.of_lang:
            self.of_lang[lang] = Numbers(self, lang)
        words = piece_words(raw)
        number = self.of_lang[lang].__getitem__
        self.parts.append(np.fromiter(map(number, words), np.int32, len(words)))
        self.size += len(words)

    def rows(self, block: int):
        """One row with the numbers of all words in order, then one per word with its count."""
        import numpy as np

        stream = np.concatenate(self.parts)
        counts = np.bincount(stream, minlength=len(self.names) + 1)[1:]
        yield pa.RecordBatch.from_arrays(
            [
                pa.array([block]), pa.array([packed(stream)], pa.binary()), pa.nulls(1, pa.string()),
                pa.nulls(1, pa.string()), pa.nulls(1, pa.int32()), pa.nulls(1, pa.int64()),
            ],
            ROWS,
        )
        for start in range(0, len(self.names), 1 << 16):
            some = self.names[start : start + (1 << 16)]
            n = len(some)
            yield pa.RecordBatch.from_arrays(
                [
                    pa.array([block] * n), pa.nulls(n, pa.binary()), pa.array([x[0] for x in some], pa.string()),
                    pa.array([x[1] for x in some], pa.binary()).cast(pa.string()),
                    pa.array(np.arange(start + 1, start + n + 1, dtype=np.int32)),
                    pa.array(counts[start : start + n]),
                ],
                ROWS,
            )


class Numbers(dict):
    def __init__(self, block: Block, lang: str):
        self.block, self.lang = block, lang
        self[BREAK] = 0

    def __missing__(self, word: bytes) -> int:
        self.block.names.append((self.lang, word))
        self.block.bytes += len(word) + 64
        n = self[word] = len(self.block.names)
        return n


ROWS = ["block", "stream", "lang", "word", "local", "n"]
ROWS_SCHEMA = "block bigint, stream binary, lang string, word string, local int, n bigint"


def blocks_of_texts(batches):
    """``mapInArrow`` function from (lang, text) to the rows of blocks."""
    from pyspark import TaskContext

    block, made = Block(), TaskContext.get().partitionId() << 32
    batch = langs = texts = None
    for batch in batches:
        langs, texts = batch.column(0), batch.column(1).cast(pa.binary())
        for lang, text in zip(langs, texts, strict=True):
            block.add(lang.as_py(), text.as_py() or b"")
            if block.size >= BLOCK_WORDS or block.bytes >= BLOCK_BYTES:
                yield from block.rows(made)
                block, made = Block(), made + 1
    if block.size:
        yield from block.rows(made)
    # The worker waits for its next task without this one's buffers.
    del block, batch, langs, texts
    pa.default_memory_pool().release_unused()


def compact(words, keep):
    """Words with 0 wherever ``keep`` is not set, runs of 0 as one, 0 at both ends."""
    import numpy as np

    kept = np.where(keep, words, 0)
    use = np.ones(len(kept), bool)
    use[1:] = (kept[1:] != 0) | (kept[:-1] != 0)
    return np.concatenate([[0], kept[use], [0]]).astype(np.uint32)


def global_words(batches):
    """(block, stream, pairs of local and global number) to (block, words, open): words numbered from 1
    over all blocks, 0 for breaks and rare words; ``open`` marks the places of frequent words."""
    import numpy as np

    for batch in batches:
        for i in range(batch.num_rows):
            local = unpacked(batch.column(1)[i].as_py(), np.int32)
            pairs = batch.column(2)[i].values
            number = np.zeros(int(local.max(initial=0)) + 1, np.int64)
            pairs = pairs.to_numpy()
            number[pairs >> 32] = (pairs & 0xFFFFFFFF) + 1
            words = number[local]
            words = compact(words, words > 0)
            yield state_row(batch.column(0)[i].as_py(), words, words > 0)


STATE = "block bigint, words binary, open binary"


def state_row(block: int, words, open_places):
    import numpy as np

    bits = np.packbits(open_places).tobytes()
    return pa.RecordBatch.from_arrays(
        [pa.array([block]), pa.array([packed(words)], pa.binary()), pa.array([bits], pa.binary())],
        ["block", "words", "open"],
    )


class Packing:
    """Phrases of ``n`` words of ``width`` bits each as permuted integers.

    As many words as fit go into an integer of 64 bits, further ones into more of them. The permutation
    mixes each integer in itself and adds to it, in turn, a hash of the others; every step can be undone.
    """

    def __init__(self, n: int, width: int):
        per = 64 // width
        self.width = width
        self.sizes = [min(per, n - i) for i in range(0, n, per)]  # words of each integer
        self.bits = [width * k for k in self.sizes]

    def mask(self, bits: int):
        import numpy as np

        return np.uint64((1 << bits) - 1)

    def mixed(self, x, bits: int, back: bool):
        """A bijection of integers of ``bits`` bits: products with odd numbers and shifted sums."""
        import numpy as np

        mask, half = self.mask(bits), np.uint64((bits + 1) // 2)
        odd = [0x9E3779B97F4A7C15, 0xD6E8FEB86659FD93]
        if back:
            for m in reversed(odd):
                x = x ^ (x >> half)  # undoes itself, as two halves reach beyond the end
                x = (x * np.uint64(pow(m, -1, 1 << 64))) & mask
            return x
        for m in odd:
            x = (x * np.uint64(m)) & mask
            x = x ^ (x >> half)
        return x

    def hashed(self, others, salt: int):
        import numpy as np

        h = np.uint64(salt)
        for x in others:
            h = (x + h) * np.uint64(0xFF51AFD7ED558CCD)
            h = h ^ (h >> np.uint64(32))
        return h

    def steps(self):
        return [(r, i) for r in range(2) for i in range(len(self.bits)) if len(self.bits) > 1]

    def permuted(self, words, at) -> list:
        """The integers of the phrases that begin at the places ``at``."""
        import numpy as np

        out, word = [], 0
        for size, bits in zip(self.sizes, self.bits, strict=True):
            x = np.zeros(len(at), np.uint64)
            for _ in range(size):
                x = (x << np.uint64(self.width)) | (words[at + word] - np.uint32(1)).astype(np.uint64)
                word += 1
            out.append(self.mixed(x, bits, False))
        for r, i in self.steps():
            others = out[:i] + out[i + 1 :]
            out[i] = out[i] ^ (self.hashed(others, 7 * r + i + 1) & self.mask(self.bits[i]))
        return out

    def phrases(self, keys: list):
        """The words' numbers of permuted integers, a row per phrase."""
        import numpy as np

        keys = list(keys)
        for r, i in reversed(self.steps()):
            others = keys[:i] + keys[i + 1 :]
            keys[i] = keys[i] ^ (self.hashed(others, 7 * r + i + 1) & self.mask(self.bits[i]))
        columns = []
        for x, size, bits in zip(keys, self.sizes, self.bits, strict=True):
            x = self.mixed(x, bits, True)
            for k in range(size - 1, -1, -1):
                columns.append((x >> np.uint64(k * self.width)) & self.mask(self.width))
        return np.stack(columns, axis=1).astype(np.int64)


def distinct(keys: list):
    """(distinct keys in order, place of each input among them)."""
    import numpy as np

    if len(keys) == 1:
        found, inverse = np.unique(keys[0], return_inverse=True)
        return [found], inverse
    order = np.lexsort(keys[::-1])
    new = np.zeros(len(order), bool)
    new[:1] = True
    for k in keys:
        s = k[order]
        new[1:] |= s[1:] != s[:-1]
    inverse = np.empty(len(order), np.int64)
    inverse[order] = np.cumsum(new) - 1
    return [k[order][new] for k in keys], inverse


def as_bytes(values, bits: int) -> bytes:
    """Integers in as many bytes each as ``bits`` need."""
    import numpy as np

    size = -(-bits // 8)
    return values.astype("<u8").view(np.uint8).reshape(-1, 8)[:, :size].tobytes()


def from_bytes(raw, n: int, bits: int):
    import numpy as np

    size = -(-bits // 8)
    wide = np.zeros((n, 8), np.uint8)
    wide[:, :size] = np.frombuffer(raw[: n * size], np.uint8).reshape(n, size)
    return wide.view("<u8").reshape(n).astype(np.uint64), raw[n * size :]


class QuotientFilter:
    """Counters of sorted permuted phrases of one shard, in about as many bits as they need.

    The first integer's bits: those of the shard, which are not stored; the quotient, of which a
    row of bits says how many entries each has (a 1 for each entry, a 0 behind each quotient); the
    remainder, in full. Further integers are remainder too. Counters are bytes, 255 for those that stand
    at the end in full.
    """

    def __init__(self, packing: Packing, shard_bits: int):
        self.packing, self.low = packing, packing.bits[0] - shard_bits

    def quotient_bits(self, n: int) -> int:
        """The split of the first integer that takes the fewest bytes for ``n`` entries: about as many
        quotients as entries, or a few times as many where remainders lose a byte by that."""

        def size(q: int) -> int:
            return (n + (1 << q)) // 8 + n * -(-(self.low - q) // 8)

        least = min(self.low, n.bit_length() - 1)
        return min(range(least, min(self.low, least + 3) + 1), key=size)

    def pack(self, keys: list, counts) -> bytes:
        import numpy as np

        n = len(counts)
        q = self.quotient_bits(n)
        low = keys[0] & self.packing.mask(self.low)
        rest = self.low - q
        quotient = (low >> np.uint64(rest)).astype(np.int64)
        runs = np.zeros(n + (1 << q), np.uint8)
        runs[quotient + np.arange(n)] = 1
        out = [struct.pack("<IB", n, q), np.packbits(runs).tobytes()]
        out.append(as_bytes(low & self.packing.mask(rest), rest))
        out += [as_bytes(k, b) for k, b in zip(keys[1:], self.packing.bits[1:], strict=True)]
        out.append(np.minimum(counts, 255).astype(np.uint8).tobytes())
        out.append(counts[counts >= 255].astype("<u8").tobytes())
        return b"".join(out)

    def unpack(self, raw: bytes, shard: int):
        import numpy as np

        n, q = struct.unpack_from("<IB", raw)
        raw = memoryview(raw)[5:]
        slots = n + (1 << q)
        runs = np.unpackbits(np.frombuffer(raw[: -(-slots // 8)], np.uint8), count=slots)
        raw = raw[-(-slots // 8) :]
        quotient = (np.flatnonzero(runs) - np.arange(n)).astype(np.uint64)
        rest = self.low - q
        low, raw = from_bytes(raw, n, rest)
        top = np.uint64(shard << self.low) if self.low < 64 else np.uint64(0)
        first = top | low if not q else top | (quotient << np.uint64(rest)) | low
        keys = [first]
        for bits in self.packing.bits[1:]:
            k, raw = from_bytes(raw, n, bits)
            keys.append(k)
        counts = np.frombuffer(raw[:n], np.uint8).astype(np.int64)
        full = counts == 255
        counts[full] = np.frombuffer(raw[n:], "<u8")
        return keys, counts


class Level:
    """Phrases of ``n`` words: what a block sends, how shards are merged, what a block is told."""

    def __init__(self, n: int, width: int, shard_bits: int, least: int):
        self.n, self.least = n, least
        self.packing = Packing(n, width)
        self.shard_bits = min(shard_bits, self.packing.bits[0])
        self.filter = QuotientFilter(self.packing, self.shard_bits)

    def entries(self, words: bytes, open_places: bytes):
        """Places, distinct phrases in order, and the phrase of each place."""
        import numpy as np

        words = unpacked(words, np.uint32)
        bits = np.unpackbits(np.frombuffer(open_places, np.uint8), count=len(words)).astype(bool)
        at = np.flatnonzero(bits[:-1] & bits[1:])
        keys, phrase = distinct(self.packing.permuted(words, at))
        return words, at, keys, phrase

    def shards(self, keys: list):
        """(shard, its first entry, its end) for the shards that occur."""
        import numpy as np

        if not len(keys[0]):
            return []
        if not self.shard_bits:
            return [(0, 0, len(keys[0]))]
        shard = (keys[0] >> np.uint64(self.filter.low)).astype(np.int64)
        starts = np.flatnonzero(np.concatenate([[True], shard[1:] != shard[:-1]]))
        ends = [*starts[1:].tolist(), len(shard)]
        return list(zip(shard[starts].tolist(), starts.tolist(), ends, strict=True))

    def send(self, batches):
        """``mapInArrow``: state to (shard, block, filter)."""
        import numpy as np

        for batch in batches:
            for i in range(batch.num_rows):
                block, words, open_places = (c[i].as_py() for c in batch.columns)
                _, _, keys, phrase = self.entries(words, open_places)
                counts = np.bincount(phrase, minlength=len(keys[0]))
                found = self.shards(keys)
                for start in range(0, len(found), 256):
                    some = found[start : start + 256]
                    made = [self.filter.pack([k[a:e] for k in keys], counts[a:e]) for _, a, e in some]
                    yield pa.RecordBatch.from_arrays(
                        [
                            pa.array([x[0] for x in some], pa.int64()),
                            pa.array([block] * len(some), pa.int64()),
                            pa.array(made, pa.binary()),
                        ],
                        ["shard", "block", "filter"],
                    )

    def merge(self, table: pa.Table) -> pa.Table:
        """The filters of one shard to its frequent phrases (phrase, f), and for each block a bit
        per entry of its filter (block, shard, frequent)."""
        import numpy as np

        shard, blocks = table["shard"][0].as_py(), table["block"].to_pylist()
        keys, counts, sizes = [], [], []
        for raw in table["filter"]:
            k, c = self.filter.unpack(raw.as_py(), shard)
            keys.append(k)
            counts.append(c)
            sizes.append(len(c))
        every = [np.concatenate(k) for k in zip(*keys, strict=True)]
        found, entry = distinct(every)
        total = np.zeros(len(found[0]), np.int64)
        np.add.at(total, entry, np.concatenate(counts))
        often = total >= self.least
        phrases = self.packing.phrases([k[often] for k in found])
        out = [(None, None, None, p, f) for p, f in zip(phrases.tolist(), total[often].tolist(), strict=True)]
        told = np.split(often[entry], np.cumsum(sizes)[:-1])
        out += [
            (block, shard, np.packbits(t).tobytes(), None, None)
            for block, t in zip(blocks, told, strict=True)
            if t.any()
        ]
        columns = list(zip(*out, strict=True)) or [[]] * 5
        return pa.table([pa.array(c, k) for c, k in zip(columns, MERGED_TYPES, strict=True)], MERGED_NAMES)

    def narrowed(self, batches):
        """``mapInArrow``: state and the bits of its shards to the next level's state."""
        import numpy as np

        for batch in batches:
            for i in range(batch.num_rows):
                block, words, open_places, told = (c[i].as_py() for c in batch.columns)
                words, at, keys, phrase = self.entries(words, open_places)
                often = np.zeros(len(keys[0]), bool)
                bits = {x["shard"]: x["frequent"] for x in told}
                for shard, start, end in self.shards(keys):
                    if shard in bits:
                        raw = np.frombuffer(bits[shard], np.uint8)
                        often[start:end] = np.unpackbits(raw, count=end - start)
                begins = np.zeros(len(words), bool)
                begins[at[often[phrase]]] = True
                covered = begins.copy()
                for k in range(1, self.n):
                    covered[k:] |= begins[:-k]
                # Where a phrase begins goes through the same narrowing as the words.
                marked = compact(np.arange(1, len(words) + 1), covered)
                source = marked.astype(np.int64) - 1
                kept = np.where(source >= 0, words[source], 0).astype(np.uint32)
                yield state_row(block, kept, (source >= 0) & begins[source])


def merger(level: Level):
    """Spark counts the arguments of a grouped function, so it gets a plain one."""
    return lambda table: level.merge(table)


MERGED = "block bigint, shard bigint, frequent binary, phrase array<bigint>, f bigint"
MERGED_NAMES = ["block", "shard", "frequent", "phrase", "f"]
MERGED_TYPES = [pa.int64(), pa.int64(), pa.binary(), pa.list_(pa.int64()), pa.int64()]


def shard_bits(entries: int) -> int:
    """Bits of the shard's name, so that a shard has about ``SHARD`` entries at the most."""
    return max(0, (entries // SHARD).bit_length())


def frequent_phrases(
    docs: DataFrame, lang_col: str = "lang", text_col: str = "text", settings: Settings = Settings()
) -> tuple[DataFrame, DataFrame, DataFrame]:
    """(words, phrases, totals) with exact counts over all texts.

    ``words``: lang, word, f and its number ``gid`` of words that occur ``least`` times;
    ``phrases``: array of such numbers and f for 2 to ``longest`` words; ``totals``: lang and n,
    all its words. Written to the shared folder; the driver sees counts of rows only.
    """
    spark = docs.sparkSession
    work = shared_path(spark, "collocations")

    def written(df: DataFrame, name: str) -> DataFrame:
        df.write.parquet(f"{work}/{name}")
        return spark.read.schema(df.schema).parquet(f"{work}/{name}")

    texts = docs.select(F.coalesce(lang_col, F.lit("und")).alias("lang"), F.col(text_col).alias("text"))
    made = written(texts.mapInArrow(blocks_of_texts, ROWS_SCHEMA), "blocks")
    occurring = made.filter("word is not null").select("block", "lang", "word", "local", "n")
    totals = written(occurring.groupBy("lang").agg(F.sum("n").alias("n")), "totals")
    often = occurring.groupBy("lang", "word").agg(F.sum("n").alias("f")).filter(F.col("f") >= settings.least)
    words = numbered(often, f"{work}/words", "gid")
    n_words, occurrences = words.agg(F.count(F.lit(1)), F.coalesce(F.sum("f"), F.lit(0))).first()
    width = max(1, (n_words - 1).bit_length()) if n_words else 1

    # A left join: every block comes back, with the numbers of those of its words that have one.
    # Both numbers of a word in one: the block's own above, that of all blocks below.
    pair = F.shiftleft(F.col("local").cast("bigint"), 32).bitwiseOR(F.col("gid"))
    numbers = small_broadcast(words.drop("f"))
    pairs = occurring.join(numbers, ["lang", "word"], "left").groupBy("block")
    pairs = pairs.agg(F.collect_list(pair).alias("pairs"))
    streams = made.filter("stream is not null").select("block", "stream").join(pairs, "block")
    state = written(streams.mapInArrow(global_words, STATE), "state-1")

    found = []
    for n in range(2, settings.longest + 1):
        level = Level(n, width, shard_bits(occurrences), settings.least)
        sent = state.mapInArrow(level.send, "shard bigint, block bigint, filter binary")
        merged = written(sent.groupBy("shard").applyInArrow(merger(level), MERGED), f"merged-{n}")
        phrases = merged.filter("phrase is not null").select("phrase", "f")
        found.append(phrases)
        occurrences = phrases.agg(F.coalesce(F.sum("f"), F.lit(0))).first()[0]
        if n < settings.longest:
            told = merged.filter("block is not null").groupBy("block")
            told = written(told.agg(F.collect_list(F.struct("shard", "frequent")).alias("told")), f"told-{n}")
            state = state.join(small_broadcast(told), "block").select("block", "words", "open", "told")
            state = written(state.mapInArrow(level.narrowed, STATE), f"state-{n}")
    phrases = found[0]
    for more in found[1:]:
        phrases = phrases.unionByName(more)
    return words, written(phrases, "phrases"), totals


def lowest_cuts(words: DataFrame, phrases: DataFrame, totals: DataFrame) -> DataFrame:
    """(gids, lang, phrase, a, l, r, n, score) of each phrase by its lowest-scoring cut.

    Products are decimals of 38 digits: a thousand times the square of 10^17 words still fits. Every
    join's result is written, since each of them reads its rows twice.
    """
    spark = phrases.sparkSession
    work = shared_path(spark, "collocation-cuts")

    def written(df: DataFrame, name: str) -> DataFrame:
        df.write.parquet(f"{work}/{name}")
        return spark.read.schema(df.schema).parquet(f"{work}/{name}")

    parts = words.select(F.array("gid").alias("part"), F.col("f").alias("part_f"))
    parts = parts.unionByName(phrases.select(F.col("phrase").alias("part"), F.col("f").alias("part_f")))
    spelt = phrases.select(F.col("phrase").alias("gids"), F.posexplode("phrase").alias("pos", "gid"))
    spelt = join_one_per_key(spelt, words.select("gid", "lang", "word"), "gid", ["gids", "pos"])
    spelt = spelt.groupBy("gids").agg(
        F.first("lang").alias("lang"),
        F.array_join(F.array_sort(F.collect_list(F.struct("pos", "word")))["word"], " ").alias("phrase"),
    )
    size = F.size("phrase")
    cuts = phrases.select(
        F.col("phrase").alias("gids"),
        F.col("f").alias("a"),
        F.explode(F.sequence(F.lit(1), size - 1)).alias("k"),
    )
    cuts = cuts.withColumns(
        {
            "left": F.slice("gids", F.lit(1), F.col("k")),
            "right": F.slice("gids", F.col("k") + 1, F.size("gids") - F.col("k")),
        }
    )
    for side, into in (("left", "l"), ("right", "r")):
        side_f = parts.select(F.col("part").alias(side), F.col("part_f").alias(into))
        cuts = written(join_one_per_key(cuts, side_f, side, ["gids", "k"]), into)
    cuts = written(cuts.join(spelt, "gids").drop("left", "right"), "spelt")
    cuts = join_one_per_key(cuts, totals, "lang", ["gids", "k"])

    def wide(column: str):
        return F.col(column).cast("decimal(18,0)")

    cuts = cuts.withColumn("above", F.lit(1000).cast("decimal(4,0)") * (wide("a") * wide("n")).cast("decimal(34,0)"))
    cuts = cuts.withColumn("below", wide("l") * wide("r")).withColumn("score", F.expr("above div below"))
    columns = ["lang", "phrase", "a", "l", "r", "n", "score"]
    lowest = F.min(F.struct("score", "k", "lang", "phrase", "a", "l", "r", "n")).alias("c")
    return cuts.groupBy("gids").agg(lowest).select("gids", *[f"c.{c}" for c in columns])


def without_inside(scored: DataFrame, percent: int) -> DataFrame:
    """Phrases that no longer phrase holds with ``percent`` of their count.

    Phrases of one word more are enough to ask: between a phrase and a longer one that holds it
    stands one of those, at least as frequent as the longer one.
    """
    n = F.size("gids")
    inner = F.array(F.slice("gids", F.lit(1), n - 1), F.slice("gids", F.lit(2), n - 1))
    longer = scored.filter(n > 2).select(F.explode(inner).alias("gids"), F.col("a").alias("longer"))
    longer = longer.groupBy("gids").agg(F.max("longer").alias("longer"))
    joined = scored.join(longer, "gids", "left")
    inside = F.coalesce(F.col("longer") * 100 >= F.col("a") * percent, F.lit(False))
    return joined.filter(~inside).drop("longer")


def collocations(
    docs: DataFrame, lang_col: str = "lang", text_col: str = "text", settings: Settings = Settings()
) -> DataFrame:
    """(lang, rank, phrase, a, l, r, n, score): each language's first phrases.

    Words and pieces: A-Z are lower-cased, ``.,;:!?`` and line breaks end a piece, spaces and tabs part
    words. Scores are floored thousandths of a n / (l r) at the phrase's lowest-scoring cut, equal ones at
    the first. Ranks are by score, count, and phrase in the order of its UTF-8 bytes, so there are no ties.

    A null language counts as ``und``, together with texts labelled so; null and empty texts have
    no words. Repeated rows count as often as they occur. An empty table, or one without frequent phrases,
    gives no rows. A text's words are held by one task. Other columns are not looked at.

    Eager: blocks, filters and states are written to the shared folder, the texts' words once as
    numbers. Each language's last sort gets at most ``first`` rows from every task.
    """
    words, phrases, totals = frequent_phrases(docs, lang_col, text_col, settings)
    scored = lowest_cuts(words, phrases, totals)
    path = shared_path(docs.sparkSession, "collocations-scored")
    scored.write.parquet(path)
    scored = docs.sparkSession.read.schema(scored.schema).parquet(path)
    kept = without_inside(scored, settings.inside_percent)
    order = Window.partitionBy("lang").orderBy(F.col("score").desc(), F.col("a").desc(), "phrase")
    ranked = kept.withColumn("rank", F.row_number().over(order).cast("bigint"))
    ranked = ranked.filter(F.col("rank") <= settings.first)
    return ranked.select("lang", "rank", "phrase", "a", "l", "r", "n", "score")
