"""Near-duplicates by Order MinHash, verified by banded alignment.

A text is the sequence of its five-word shingles, each labelled with how often it has occurred
before. A sketch holds the few shingles that are smallest under one hash, in the order in which they stand in
the text, so it depends on content and order and texts with a small edit distance share many.
Texts that share a sketch are candidates; their sequences of words are aligned in a band as wide
as the wanted similarity allows, so one changed word costs one word and not the five shingles around it.

Exact copies become one node before anything else. Nodes that share a sketch are first compared with
one centre per sketch only, the member with the most company, which settles groups of any size in
linear work. Where members of a sketch are then still of several classes, all pairs between classes are
compared: by a join where those are few for each member, else (documents around a passage that
many share) in blocks, whose words are matched exactly inside the tasks, so that only pairs
that reach the similarity ever become rows.
"""

from __future__ import annotations

from dataclasses import dataclass

from pyspark.sql import DataFrame, SparkSession
from pyspark.sql import functions as F

from foliospark.llm.common import id_and_text, struct_udf, word_finder
from foliospark.session import shared_path


@dataclass(frozen=True)
class Settings:
    """Sketches of shingles of ``shingle`` words; pairs at ``similarity`` or above are linked.

    Similarity is the words two texts share in one order over all their words: 0.9 where one word in
    19 was replaced, 0.8 where one in nine was. Spread over the text, such edits leave the
    texts 0.62 and 0.38 of all their shingles in common. Sketches of ``picks`` shingles agree
    with that share to the power of ``picks``, so two long texts share none of 24 in 0.2 % of
    cases at similarity 0.9, 5 % at 0.85 and 25 % at 0.8, and edits that stand together cost less. Texts of up to
    ``short`` shingles also have ``short_sketches`` of two. Any one shared sketch makes a pair a candidate.
    """

    shingle: int = 5
    similarity: float = 0.8
    sketches: int = 24
    picks: int = 3
    short: int = 32
    short_sketches: int = 12
    joined_pairs: int = 16  # a sketch with up to so many pairs per member is compared by a join
    block: int = 512  # documents of a block of those with more, on average at most
    block_words: int = 1 << 20  # and words of a block


MASK = (1 << 64) - 1


def mix(x):
    """A bijection of unsigned 64-bit numpy integers."""
    import numpy as np

    x = (x ^ (x >> np.uint64(33))) * np.uint64(0xFF51AFD7ED558CCD)
    x = (x ^ (x >> np.uint64(33))) * np.uint64(0xC4CEB9FE1A85EC53)
    return x ^ (x >> np.uint64(33))


class Shingler:
    """Texts to arrays of hashed shingles; words' hashes are kept for a while."""

    KEPT = 300_000

    def __init__(self, size: int):
        self.size, self.words, self.seen = size, word_finder(), {}

    def __call__(self, text: str):
        import numpy as np
        import xxhash

        words, seen = self.words(text), self.seen
        if len(seen) > self.KEPT:
            seen.clear()
        for w in set(words):
            if w not in seen:
                seen[w] = xxhash.xxh3_64_intdigest(w)
        a = np.fromiter((seen[w] for w in words), np.uint64, len(words))
        if not len(a):
            return len(a), a
        size = min(self.size, len(a))
        h = np.zeros(len(a) - size + 1, np.uint64)
        for i in range(size):
            h = h * np.uint64(0x9E3779B97F4A7C15) + a[i : len(a) - size + 1 + i]
        return len(a), mix(h)


def labelled(h):
    """Every shingle together with the number of its earlier occurrences in the text."""
    import numpy as np

    order = np.argsort(h, kind="stable")
    same = h[order[1:]] == h[order[:-1]]
    if not same.any():
        return h
    at = np.arange(len(h))
    first = np.concatenate([[True], ~same])
    nth = np.empty(len(h), np.int64)
    nth[order] = at - np.maximum.accumulate(np.where(first, at, 0))
    return np.where(nth > 0, mix(h + nth.astype(np.uint64) * np.uint64(0xD6E8FEB86659FD93)), h)


def sketcher(settings: Settings):
    import numpy as np

    shingles = Shingler(settings.shingle)
    every = settings.sketches + settings.short_sketches
    seeds = mix(np.arange(1, every + 1, dtype=np.uint64) * np.uint64(0xA24BAED4963EE407))
    odd = mix(seeds) | np.uint64(1)

    def sketches(x, first: int, last: int, picks: int) -> list[int]:
        picks = min(picks, len(x))
        out = []
        # A few hash functions at a time for long texts.
        step = max(1, min(settings.sketches, (1 << 20) // len(x)))
        for s in range(first, last, step):
            now, by = seeds[s : min(s + step, last)], odd[s : min(s + step, last)]
            v = (x[None, :] ^ now[:, None]) * by[:, None]
            v ^= v >> np.uint64(32)
            v *= np.uint64(0xC4CEB9FE1A85EC53)
            least = np.argpartition(v, picks - 1, axis=1)[:, :picks]
            chosen = x[np.sort(least, axis=1)]  # in the order of the text
            made = now.copy()
            for i in range(picks):
                made = mix(made * np.uint64(0x9E3779B97F4A7C15) + chosen[:, i])
            out += made.view(np.int64).tolist()
        return out

    def one(text: str | None) -> tuple:
        n, h = shingles(text or "")
        if not n:
            return 0, []
        x = labelled(h)
        out = sketches(x, 0, settings.sketches, settings.picks)
        if len(x) <= settings.short:
            out += sketches(x, settings.sketches, every, 2)
        return n, out

    return one


def common_in_order(a: list[int], b: list[int], band: int) -> int:
    """The length of the longest common subsequence of ``a`` and ``b`` among alignments that stay
    within ``band`` of the diagonal; exact where an alignment with at most ``band`` gaps exists.

    One bit per position of ``a``, a row per element of ``b``; a clear bit is where the length
    grows by one. Rows go in blocks, each over the part of ``a`` that the band lets it reach.
    """
    rows = max(256, band)
    low = high = done = 0
    bits = 0  # of positions low..high-1
    for start in range(0, len(b), rows):
        stop = min(len(b), start + rows)
        new_low, new_high = min(len(a), max(0, start - band)), min(len(a), stop + band)
        if new_low > low:
            gone = min(new_low, high) - low
            done += gone - (bits & ((1 << gone) - 1)).bit_count()
            bits >>= gone
            low = new_low
            high = max(high, low)
        if new_high > high:
            bits |= ((1 << (new_high - high)) - 1) << (high - low)
            high = new_high
        full = (1 << (high - low)) - 1
        at: dict[int, int] = {}
        for i in range(low, high):
            at[a[i]] = at.get(a[i], 0) | 1 << (i - low)
        for x in b[start:stop]:
            m = at.get(x, 0)
            if m:
                u = bits & m
                bits = ((bits + u) | (bits - u)) & full
    return done + (high - low) - bits.bit_count()


def similarity(a: list[int], b: list[int], least: float) -> float:
    """Shared elements in order over all elements; below ``least`` an underestimate."""
    if not a or not b or min(len(a), len(b)) < least * max(len(a), len(b)):
        return 0.0
    total = len(a) + len(b)
    # shared / (total - shared) >= least leaves so many elements without a partner.
    band = int(total * (1 - least) / (1 + least)) + 1
    start = 0
    while start < min(len(a), len(b)) and a[start] == b[start]:
        start += 1
    end = 0
    while end < min(len(a), len(b)) - start and a[-1 - end] == b[-1 - end]:
        end += 1
    inner = common_in_order(a[start : len(a) - end], b[start : len(b) - end], band)
    shared = start + end + inner
    return shared / (total - shared)


def verifier(settings: Settings):
    words = Shingler(1)
    last: dict[str, list[int]] = {}

    def sequence(text: str) -> list[int]:
        if text not in last:
            if len(last) > 8:  # centres come again and again
                last.clear()
            last[text] = words(text)[1].tolist()
        return last[text]

    def one(left: str | None, right: str | None) -> tuple:
        a, b = sequence(left or ""), sequence(right or "")
        return (similarity(a, b, settings.similarity),)

    return one


def components(spark: SparkSession, links: DataFrame, work: str) -> DataFrame:
    """(node, label): the smallest node that each node of ``links`` (a, b) is connected with.

    Alternates two steps until nothing changes: every node ties its larger neighbours to its smallest
    one, then its smaller ones. Each round is a written table, so no plan grows and a lost executor
    costs one round; only its row count and a checksum come to the driver.
    """

    def state(df: DataFrame) -> tuple:
        row = df.agg(F.count(F.lit(1)), F.sum(F.xxhash64("a", "b") % 1_000_003)).first()
        return tuple(row)

    def tied(pairs: DataFrame, both: bool) -> DataFrame:
        """Pairs (a > b). Every node's neighbours, itself included, get its smallest neighbour."""
        out = pairs.select(F.col("a").alias("u"), F.col("b").alias("v"))
        if both:
            out = out.unionByName(pairs.select(F.col("b").alias("u"), F.col("a").alias("v")))
        least = out.groupBy("u").agg(F.min("v").alias("m"))
        least = least.withColumn("m", F.least("u", "m"))
        joined = out.join(least, "u")
        if both:
            joined = joined.filter("v > u").select(F.col("v").alias("a"), F.col("m").alias("b"))
        else:
            own = least.select(F.col("u").alias("a"), F.col("m").alias("b"))
            joined = joined.select(F.col("v").alias("a"), F.col("m").alias("b")).unionByName(own)
        return joined.filter("a > b").distinct()

    current = links.select(F.greatest("a", "b").alias("a"), F.least("a", "b").alias("b"))
    before, n = None, 0
    while True:
        current = tied(tied(current, True), False)
        path = f"{work}/round-{n}"
        current.write.parquet(path)
        current = spark.read.parquet(path)
        now = state(current)
        if now == before:
            break
        before, n = now, n + 1
    roots = current.select(F.col("b").alias("node"), F.col("b").alias("label")).distinct()
    return current.select(F.col("a").alias("node"), F.col("b").alias("label")).unionByName(roots)


def near_groups(
    docs: DataFrame, id_col: str = "doc_id", text_col: str = "text", settings: Settings = Settings()
) -> DataFrame:
    """(doc_id, class_id, copy_of, n_words), one row per row of ``docs``.

    ``class_id`` is the smallest id of the class: documents with equal texts, and those connected
    through pairs of the given similarity. ``copy_of`` is the smallest id with the same text.
    Null texts are no copies of anything: their class is their own id. Texts without words,
    the empty one too, are grouped with equal texts only. Rows without an id get the class of
    their text; a class without any id has none. Repeated rows are copies of each other.

    Eager: sketches, nodes, pairs and links are written to the shared folder, texts are not.
    """
    spark = docs.sparkSession
    work = shared_path(spark, "near-dedup")

    def written(df: DataFrame, name: str) -> DataFrame:
        df.write.parquet(f"{work}/{name}")
        return spark.read.parquet(f"{work}/{name}")

    rows = id_and_text(docs, id_col, text_col)
    keyed = rows.withColumn("key", F.unhex(F.md5("text")))
    sketch = struct_udf(lambda: sketcher(settings), "n int, sketch array<bigint>")
    signed = written(
        keyed.withColumn("s", sketch("text")).select("doc_id", "key", "s.n", "s.sketch"), "signed"
    )
    nodes = written(
        signed.filter("key is not null")
        .groupBy("key")
        .agg(F.min("doc_id").alias("first_id"), F.first("n").alias("n"), F.first("sketch").alias("sketch"))
        .withColumn("node", F.monotonically_increasing_id()),
        "nodes",
    )
    buckets = nodes.select("node", "n", F.explode("sketch").alias("bucket"))
    sizes = buckets.groupBy("bucket").agg(F.count(F.lit(1)).alias("size")).filter("size > 1")
    members = written(buckets.join(sizes, "bucket"), "members")

    # The centre of a sketch: the member that shares its sketches with the most others.
    company = members.groupBy("node").agg(F.sum("size").alias("company"))
    # Written, so that the join below has no aggregation in its stage and AQE can split it.
    centres = written(
        members.join(company, "node")
        .groupBy("bucket")
        .agg(F.max(F.struct("company", "node", "n")).alias("c"))
        .select("bucket", F.col("c.node").alias("centre"), F.col("c.n").alias("centre_n")),
        "centres",
    )
    # Fewer words than this share of the other's cannot be similar.
    def comparable(x: str, y: str):
        return F.least(x, y) >= settings.similarity * F.greatest(x, y)

    first = written(
        members.join(centres, "bucket")
        .filter(F.col("node") != F.col("centre"))
        .filter(comparable("n", "centre_n"))
        .select(F.greatest("node", "centre").alias("a"), F.least("node", "centre").alias("b"))
        .distinct(),
        "first-pairs",
    )
    links = written(_verified(keyed, nodes, first, settings), "first-links")
    classes = written(components(spark, links, f"{work}/first"), "first-classes")

    # Sketches with members of several classes.
    known = members.join(classes, "node", "left").withColumn("label", F.coalesce("label", "node"))
    pairs = (F.sum("n") * F.sum("n") - F.sum(F.col("n") * F.col("n"))) / 2
    mixed = written(
        known.groupBy("bucket", "label")
        .agg(F.count(F.lit(1)).alias("n"))
        .groupBy("bucket")
        .agg(F.count(F.lit(1)).alias("classes"), (pairs <= settings.joined_pairs * F.sum("n")).alias("few"))
        .filter("classes > 1"),
        "mixed",
    )
    several = written(known.join(mixed, "bucket").select("bucket", "node", "n", "label", "few"), "several")

    # Few pairs: all of them. Members meet by sketch and class, so a class of any size is never
    # paired with itself.
    few = several.filter("few")
    labels = few.groupBy("bucket").agg(F.collect_set("label").alias("labels"))
    left = few.join(labels, "bucket").select(
        "bucket",
        F.col("node").alias("a"),
        F.col("n").alias("an"),
        F.explode(F.filter("labels", lambda x: x < F.col("label"))).alias("other"),
    )
    right = few.select("bucket", F.col("label").alias("other"), F.col("node").alias("b"), F.col("n").alias("bn"))
    joined = (
        left.join(right, ["bucket", "other"])
        .filter(comparable("an", "bn"))
        .select(F.greatest("a", "b").alias("a"), F.least("a", "b").alias("b"))
        .distinct()
    )
    # Many pairs: everything that such sketches connect is one cluster, compared in blocks.
    many = several.filter("not few")
    rest = joined
    if not many.isEmpty():
        rest = joined.unionByName(_pairs_in_blocks(keyed, nodes, many, settings, work)).distinct()
    rest = written(rest.join(first, ["a", "b"], "left_anti"), "rest-pairs")
    more = written(_verified(keyed, nodes, rest, settings), "rest-links")
    if not more.isEmpty():
        classes = components(spark, links.unionByName(more), f"{work}/rest")

    labelled_nodes = nodes.join(classes, "node", "left").select(
        "key", "first_id", F.coalesce("label", "node").alias("label")
    )
    smallest = labelled_nodes.groupBy("label").agg(F.min("first_id").alias("class_id"))
    of_key = labelled_nodes.join(smallest, "label").select("key", "first_id", "class_id")
    return signed.join(of_key, "key", "left").select(
        "doc_id",
        F.when(F.col("key").isNull(), F.col("doc_id")).otherwise(F.col("class_id")).alias("class_id"),
        F.when(F.col("key").isNull(), F.col("doc_id")).otherwise(F.col("first_id")).alias("copy_of"),
        F.col("n").cast("long").alias("n_words"),
    )


def sequencer():
    words = Shingler(1)
    return lambda text: (labelled(words(text or "")[1]).view("int64").tolist(),)


def block_pairs(similarity: float):
    """Pairs of one group of rows (side, node, label, items) whose shared items reach the
    similarity: side 0 with side 1, or side 0 with itself where there is no other.

    Counts come from products of 0/1 matrices over the items that occur twice, some thousand
    columns at a time, so memory does not grow with the texts.
    """
    columns = 4096

    def run(table):
        import numpy as np
        import pyarrow as pa

        side = table["side"].to_numpy()
        node, label = table["node"].to_numpy(), table["label"].to_numpy()
        items = table["items"].combine_chunks()
        if isinstance(items, pa.ChunkedArray):
            items = pa.concat_arrays(items.chunks)
        sizes = np.diff(items.offsets.to_numpy())
        owner = np.repeat(np.arange(len(sizes)), sizes)
        values, at, times = np.unique(
            items.flatten().to_numpy(), return_inverse=True, return_counts=True
        )
        again = np.cumsum(times > 1) - 1
        keep = times[at] > 1
        owner, at = owner[keep], again[at[keep]]
        order = np.argsort(at, kind="stable")
        owner, at = owner[order], at[order]
        rows = np.flatnonzero(side == 0)
        others = np.flatnonzero(side == 1) if (side == 1).any() else rows
        shared = np.zeros((len(rows), len(others)), np.float32)
        for start in range(0, int(at[-1]) + 1 if len(at) else 0, columns):
            a, b = np.searchsorted(at, [start, start + columns])
            held = np.zeros((len(sizes), columns), np.float32)
            held[owner[a:b], at[a:b] - start] = 1
            shared += held[rows] @ held[others].T
        total = sizes[rows][:, None] + sizes[others][None, :] - shared
        good = (shared >= similarity * total - 1e-3) & (label[rows][:, None] != label[others][None, :])
        i, j = np.nonzero(good)
        x, y = node[rows[i]], node[others[j]]
        return pa.table({"a": np.maximum(x, y), "b": np.minimum(x, y)})

    return run


def _pairs_in_blocks(
    keyed: DataFrame, nodes: DataFrame, many: DataFrame, settings: Settings, work: str
) -> DataFrame:
    """Pairs (a, b) of different classes, among the documents that share the sketches of ``many``,
    whose sets of labelled words reach the similarity. An alignment never shares more.

    A cluster's documents are cut into blocks by hash, more of them where texts are long; each task
    gets two blocks.
    """
    spark = keyed.sparkSession
    anchors = many.groupBy("bucket").agg(F.min("node").alias("b"))
    edges = many.join(anchors, "bucket").filter("node != b").select(F.col("node").alias("a"), "b").distinct()
    clusters = components(spark, edges, f"{work}/clusters").withColumnRenamed("label", "cluster")
    docs = many.select("node", "label", "n").distinct().join(clusters, "node")
    needed = F.greatest(F.count(F.lit(1)) / settings.block, F.sum("n") / settings.block_words)
    blocks = docs.groupBy("cluster").agg(F.ceil(needed).cast("int").alias("blocks"))
    docs = docs.join(blocks, "cluster").withColumn("block", F.pmod(F.hash("node"), "blocks"))
    texts = keyed.select("key", "text").join(docs.join(nodes.select("node", "key"), "node"), "key")
    texts = texts.groupBy("node").agg(
        *(F.first(c).alias(c) for c in ("text", "label", "cluster", "block", "blocks"))
    )
    items = struct_udf(sequencer, "items array<bigint>")
    sequences = texts.withColumn("s", items("text")).select(
        "node", "label", "cluster", "block", "blocks", "s.items"
    )
    sequences.write.parquet(f"{work}/sequences")
    sequences = spark.read.schema(sequences.schema).parquet(f"{work}/sequences")
    pairs = sequences.withColumn("other", F.explode(F.sequence(F.lit(0), F.col("blocks") - 1)))
    sides = pairs.select(
        "cluster",
        F.least("block", "other").alias("low"),
        F.greatest("block", "other").alias("high"),
        F.when(F.col("block") <= F.col("other"), 0).otherwise(1).alias("side"),
        "node",
        "label",
        "items",
    )
    return (
        sides.groupBy("cluster", "low", "high")
        .applyInArrow(block_pairs(settings.similarity), "a bigint, b bigint")
        .filter("a != b")
        .distinct()
    )


def _verified(keyed: DataFrame, nodes: DataFrame, pairs: DataFrame, settings: Settings) -> DataFrame:
    """Those of ``pairs`` (a, b) whose texts are similar enough, each text read once."""
    needed = (
        pairs.select(F.explode(F.array("a", "b")).alias("node"))
        .distinct()
        .join(nodes.select("node", "key"), "node")
    )
    texts = (
        keyed.select("key", "text").join(needed, "key").groupBy("node").agg(F.first("text").alias("text"))
    )
    similar = struct_udf(lambda: verifier(settings), "s double")
    return (
        pairs.join(texts.select(F.col("node").alias("a"), F.col("text").alias("ta")), "a")
        .join(texts.select(F.col("node").alias("b"), F.col("text").alias("tb")), "b")
        .withColumn("v", similar("ta", "tb"))
        .filter(F.col("v.s") >= settings.similarity)
        .select("a", "b")
    )


def one_of_each(
    docs: DataFrame, id_col: str = "doc_id", text_col: str = "text", settings: Settings = Settings()
) -> DataFrame:
    """The rows of ``docs`` that stay if one document of each class does: that with the smallest id.

    Null ids and null texts: such rows stay. Rows that repeat the id and text of the one
    that stays go too, but for one of them. All columns come back as they were.
    """
    from foliospark.llm.common import fresh

    groups = near_groups(docs, id_col, text_col, settings)
    stay = (
        groups.filter("doc_id is not null and doc_id = class_id")
        .groupBy("doc_id")
        .agg(F.count(F.lit(1)).alias("rows"))
    )
    key, rows = fresh(docs, "kept_id"), fresh(docs, "kept_rows")
    stay = stay.select(F.col("doc_id").alias(key), F.col("rows").alias(rows))
    joined = docs.join(stay, F.col(id_col).eqNullSafe(F.col(key)), "left")
    alone = joined.filter(F.col(id_col).isNull() | (F.col(rows) == 1))
    # Only ids that stand in several rows are compared by text.
    again = joined.filter(F.col(rows) > 1).dropDuplicates([id_col, text_col])
    return alone.drop(key, rows).unionByName(again.drop(key, rows))
