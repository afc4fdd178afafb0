"""Benchmark decontamination: one Aho-Corasick automaton over the words of all windows.

Texts are normalised to words; each distinct word of the benchmark is one symbol, so an automaton
over symbol sequences finds every window of every item in one pass over a document, overlapping
ones too. Word positions map back to places in the original text.
"""

from __future__ import annotations

import re

from pyspark.sql import Column, DataFrame
from pyspark.sql import functions as F

from foliospark.llm.common import fresh, struct_udf, word_finder, words_column
from foliospark.session import shared_path

# (item, window) pairs that one automaton holds: some hundred bytes each for driver and worker.
WINDOWS_PER_AUTOMATON = 100_000

SPANS = "array<struct<start:int,end:int>>"
SCHEMA = f"n_words bigint, n_hit bigint, items array<string>, words {SPANS}, spans {SPANS}"


def item_windows(benchmark: DataFrame, item_col: str, text_col: str, window: int) -> DataFrame:
    """(item, words) for each distinct window: ``window`` consecutive words, or the whole of a
    shorter item. Items without words have none; a null item id counts as the empty string."""
    words = words_column(F.col(text_col))
    last = F.greatest(F.size("w") - window, F.lit(0))
    each = F.transform(
        F.sequence(F.lit(0), last), lambda i: F.array_join(F.slice("w", i + 1, window), " ")
    )
    return (
        benchmark.select(
            F.coalesce(F.col(item_col).cast("string"), F.lit("")).alias("item"), words.alias("w")
        )
        .filter(F.size("w") > 0)
        .select("item", F.explode(each).alias("words"))
        .distinct()
    )


def merge(spans: list[tuple[int, int]]) -> list[tuple[int, int]]:
    out: list[tuple[int, int]] = []
    for a, b in sorted(spans):
        if out and a <= out[-1][1]:
            out[-1] = (out[-1][0], max(b, out[-1][1]))
        else:
            out.append((a, b))
    return out


def as_spans(spans: list[tuple[int, int]]) -> list[dict[str, int]]:
    return [{"start": a, "end": b} for a, b in spans]


def scanner(windows: list[tuple[str, str]]):
    """The function of one text, with the automaton over ``windows`` built."""
    import ahocorasick

    symbols: dict[str, int] = {}
    items: dict[str, list[str]] = {}
    for item, words in windows:
        items.setdefault(words, []).append(item)
    automaton = ahocorasick.Automaton(ahocorasick.STORE_ANY, ahocorasick.KEY_SEQUENCE)
    for words, owners in items.items():
        key = tuple(symbols.setdefault(w, len(symbols) + 1) for w in words.split(" "))
        automaton.add_word(key, (len(key), owners))
    if items:
        automaton.make_automaton()
    find_words = word_finder()
    each_word = re.compile(r"[^\x00-\x2F\x3A-\x40\x5B-\x60\x7B-\x7F]+")

    def one(text: str | None) -> tuple:
        words = find_words(text or "")
        hits, owners = [], set()
        if items and words:
            for end, (size, found) in automaton.iter(tuple([symbols.get(w, 0) for w in words])):
                hits.append((end + 1 - size, end + 1))
                owners.update(found)
        if not hits:
            return len(words), 0, [], [], []
        hits = merge(hits)
        where = [m.span() for m in each_word.finditer(text)]
        return (
            len(words),
            sum(b - a for a, b in hits),
            sorted(owners),
            as_spans(hits),
            as_spans([(where[a][0], where[b - 1][1]) for a, b in hits]),
        )

    return one


def uniter():
    """Unites what the automata of several blocks found in one text."""

    def one(n_words: int, items: list, words: list, spans: list) -> tuple:
        hits = merge([(x["start"], x["end"]) for x in words or []])
        return (
            n_words,
            sum(b - a for a, b in hits),
            sorted(set(items or [])),
            as_spans(hits),
            as_spans(merge([(x["start"], x["end"]) for x in spans or []])),
        )

    return one


def find_contamination(
    docs: DataFrame,
    benchmark: DataFrame,
    text_col: str = "text",
    into: str = "contamination",
    item_col: str = "item_id",
    item_text_col: str = "text",
    window: int = 10,
    windows_per_automaton: int = WINDOWS_PER_AUTOMATON,
) -> DataFrame:
    """``docs`` with a struct column ``into``: what ``SCHEMA`` lists, for each row.

    ``words`` and ``spans`` are the hit stretches in words and in code points of the original.
    A null text has no words; items without words are never found; an empty benchmark finds
    nothing; repeated items and rows count as often as they stand there, items once per document.

    The benchmark's windows are counted first. Up to ``windows_per_automaton`` of them make one
    automaton and the scan is narrow. More are written once, cut by hash into blocks of that size. One
    block after the other is opened, scans all documents and has its hits written, and only rows
    with hits are brought together, so neither driver nor worker ever holds more than one block.
    """
    windows = item_windows(benchmark, item_col, item_text_col, window)
    blocks = max(1, -(-windows.count() // windows_per_automaton))

    def scan(held: DataFrame, text: Column) -> Column:
        pairs = [(r["item"], r["words"]) for r in held.select("item", "words").collect()]
        return struct_udf(lambda: scanner(pairs), SCHEMA)(text)

    if blocks == 1:
        return docs.withColumn(into, scan(windows, F.col(text_col)))
    spark, work = docs.sparkSession, shared_path(docs.sparkSession, "contamination")
    cut = windows.withColumn("block", F.pmod(F.xxhash64("words"), F.lit(blocks)).cast("int"))
    cut.write.partitionBy("block").parquet(f"{work}/windows")
    cut = spark.read.schema(cut.schema).parquet(f"{work}/windows")
    # Rows meet by their text: equal texts have equal hits.
    key, hit = fresh(docs, "text_key"), fresh(docs, "found")
    keyed = docs.withColumn(key, F.md5(F.coalesce(F.col(text_col), F.lit(""))))
    texts = keyed.select(F.col(key).alias("k"), F.col(text_col).alias("text"))
    for i in range(blocks):
        rows = texts.select("k", scan(cut.filter(F.col("block") == i), F.col("text")).alias("f"))
        # Copies of one text agree: one row for each task and text is enough.
        rows = rows.filter("f.n_hit > 0").groupBy("k").agg(F.first("f").alias("f"))
        rows.write.parquet(f"{work}/hits/block={i}")
    found = spark.read.schema(rows.schema).parquet(f"{work}/hits")
    united = found.groupBy("k").agg(
        F.first("f.n_words").alias("n"),
        *(F.flatten(F.collect_list(f"f.{c}")).alias(c) for c in ("items", "words", "spans")),
    )
    unite = struct_udf(uniter, SCHEMA)
    united = united.select(
        F.col("k").alias(key), unite("n", "items", "words", "spans").alias(hit)
    )
    none = F.struct(
        F.size(words_column(F.col(text_col))).cast("long").alias("n_words"),
        F.lit(0).cast("long").alias("n_hit"),
        F.array().cast("array<string>").alias("items"),
        F.array().cast(SPANS).alias("words"),
        F.array().cast(SPANS).alias("spans"),
    )
    joined = keyed.join(united, key, "left").withColumn(into, F.coalesce(F.col(hit), none))
    return joined.drop(key, hit)
