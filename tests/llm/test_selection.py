"""Resampling, packing and collocations against plain versions, on odd rows and on made-up data."""

import hashlib
import math
import random
import re
import struct
import zlib
from collections import Counter, defaultdict

import numpy as np
import pytest
from pyspark.sql import functions as F
from tokenizers import Tokenizer

from foliospark.llm import collocations, packing, resampling
from foliospark.llm import queries as Q
from foliospark.llm.oracle import ORACLE_SQL
from tests.compare import connect, difference
from tests.llm.test_contracts import LONG, ODD, SMALL

WORDS = re.compile(r"[^\x00-\x2F\x3A-\x60\x7B-\x7F]+").findall


def lower(text):
    return re.sub("[A-Z]+", lambda m: m.group().lower(), text or "")


# Resampling.


def features(text):
    w = WORDS(lower(text))
    return len(w), [zlib.crc32(x.encode()) % 10_000 for x in [*w, *map(" ".join, zip(w, w[1:]))]]


def plain_resample(docs, target):
    made = [(i, *features(t)) for i, t in docs]
    s = Counter(x for _, _, f in made for x in f)
    t = Counter(x for text in target for x in features(text)[1])
    s_all, t_all = sum(s.values()) + 10_000, sum(t.values()) + 10_000
    gain = [math.floor(1000 * math.log((t[b] + 1) * s_all / ((s[b] + 1) * t_all))) for b in range(10_000)]
    rows = []
    for i, n, f in made:
        h = int(hashlib.sha256(f"7:{'' if i is None else i}".encode()).hexdigest()[:8], 16)
        weight = sum(gain[x] for x in f) // len(f) if f else 0
        rows.append((i, n, len(f), weight, weight + math.floor(-1000 * math.log(-math.log((h + 0.5) / 2**32)))))
    enough = sorted((r for r in rows if r[1] >= 20), key=lambda r: (-r[4], r[0] is None, r[0] or 0))
    drawn = len(enough) * 25 // 100
    ranked = Counter((r[0], *r[2:], k + 1 if k < drawn else None) for k, r in enumerate(enough))
    return ranked + Counter((r[0], *r[2:], None) for r in rows if r[1] < 20)


@pytest.fixture(scope="module")
def odd_rows():
    rows = [(i, t) for i, t in enumerate([*ODD, *LONG])]
    return [*rows, rows[5], rows[5], (None, "x y " * 20), (None, "mit license " * 20), (3, "z " * 30)]


@pytest.fixture(scope="module")
def odd(spark, odd_rows):
    df = spark.createDataFrame(odd_rows, "doc_id bigint, text string")
    clashing = {c: F.lit("x") for c in ("rank", "score", "n_words", "lang", "ids", "start")}
    return df.withColumns(clashing).repartition(3)


def test_resampling_of_odd_texts(spark, odd, odd_rows):
    target = ["the MIT license", None, "", "x y x y"]
    frame = spark.createDataFrame([(t,) for t in target], "text string")
    rows = resampling.resample(odd, frame).collect()
    got = Counter((r.doc_id, r.n_features, r.weight, r.score, r["rank"]) for r in rows)
    assert got == plain_resample(odd_rows, target)


def test_resampling_of_empty_tables(spark, odd, odd_rows):
    none = odd.limit(0)
    assert resampling.resample(none, odd).collect() == []
    rows = resampling.resample(odd, none).collect()
    got = Counter((r.doc_id, r.n_features, r.weight, r.score, r["rank"]) for r in rows)
    assert got == plain_resample(odd_rows, [])


def test_checksums_of_matrices():
    data = np.frombuffer(random.Random(1).randbytes(5_000), np.uint8)
    first = np.array([0, 10, 3, 700, 0, 0, 20], np.int64)
    size1 = np.array([1, 4, 4, 64, 4_000, 7, 1], np.int64)
    second = np.array([9, 80, 11, 1, 100, 0, 30], np.int64)
    size = size1 + [0, 3, 3, 3, 900, 0, 0]
    made = resampling.FeatureBuckets(10).crcs(data, first, size1, second, size)
    for a, n, b, total, crc in zip(first, size1, second, size, made):
        assert crc == zlib.crc32(data[a : a + n].tobytes() + data[b : b + total - n].tobytes())


# Packing.


@pytest.fixture(scope="module")
def tokenizer():
    made = Tokenizer.from_file(Q.vocabulary_path(Q.WORD_VOCABULARY))
    made.no_truncation()
    made.no_padding()
    return made


HARD = [
    "J̌oe J̌, İstanbul İ Été, l'été d'accord don't DON'T 'S ''s it's, x,'s á, á.b <|ENDOFTEXT|>",
    "<|endoftext|>x <|startoftext|> <|EndOfText|> <|endoftext|",
    "日本語、テスト。 ½² a\x1cb\x85c d　e\x00f ΑΣ ΟΔΟΣ, ß ẞ ﬁ K Å ̸ ≮ ́",
    "word,word.word!? 12,3 a1b2 1a,b é́, é;'ll é's ᾳ' ŉ T̈| H̱, ≠ ≮",
]


def test_ids_of_mixed_characters(tokenizer):
    """Letters with and without marks, in every neighbourhood, against the library."""
    r = random.Random(3)
    encoder = packing.Encoder(Q.vocabulary_path(Q.WORD_VOCABULARY))
    odd = "abcABC ÀÉßøÿ÷×ªºµŉİıſ'’.,!?|0½²éèêâôûñäöǘ\u0308\u0307\u0958日本 \t\n\x1c\x85\xa0x<|>"
    plain = "abeAEÀÉßøÿéèêâñäöüÄÖÜÑ,. "
    texts = ["".join(r.choices(k, k=r.randrange(1, 40))) for k in (odd, plain) for _ in range(8_000)]
    for text, e in zip(texts, tokenizer.encode_batch(texts, add_special_tokens=False), strict=True):
        assert encoder.encode(text.encode()) == struct.pack(f"<{len(e.ids)}I", *e.ids), text


def test_packing_of_odd_texts(spark, tokenizer, odd_rows):
    rows = [*odd_rows, *[(100 + i, t) for i, t in enumerate(HARD)], (200, "word " * 4095), (201, "a " * 9000)]
    docs = spark.createDataFrame(rows, "doc_id bigint, text string").withColumn("ids", F.lit(1)).repartition(3)
    pieces = packing.decompose(docs, Q.vocabulary_path(Q.WORD_VOCABULARY)).collect()
    assert len({p.sequence_id for p in pieces}) == len(pieces)
    whole = defaultdict(list)
    for p in pieces:
        assert p.length & (p.length - 1) == 0 and p.length <= 4096 and p.offset == 0
        assert len(p.ids) == 4 * p.length and p.sequence_id >> 56 == p.length.bit_length() - 1
        whole[p.doc_id, p.doc_tokens].append((p.start, p.ids))
    got = Counter()
    for (doc_id, n), parts in whole.items():
        starts = defaultdict(list)
        for start, ids in parts:
            starts[start].append(ids)
        # Repeated rows have the same pieces.
        times = len(starts[0])
        assert all(len(x) == times for x in starts.values()) or doc_id is None
        if doc_id is not None:
            ids = b"".join(starts[s][0] for s in sorted(starts))
            assert len(ids) == 4 * n
            got[doc_id, ids] += times
    want = Counter()
    for doc_id, text in rows:
        if doc_id is not None:
            ids = [*tokenizer.encode(text or "", add_special_tokens=False).ids, 2]
            want[doc_id, struct.pack(f"<{len(ids)}I", *ids)] += 1
    assert got == want


def test_packing_of_the_table(spark, tokenizer):
    pieces = defaultdict(list)
    for p in Q.op12_packing(spark, SMALL).collect():
        pieces[p.doc_id].append(p)
    docs = Q.read(spark, SMALL, "documents").select("doc_id", "text").collect()
    assert set(pieces) == {d.doc_id for d in docs}
    for d in docs:
        ids = [*tokenizer.encode(d.text or "", add_special_tokens=False).ids, 2]
        at = 0
        for p in sorted(pieces[d.doc_id], key=lambda p: p.start):
            part = ids[at : at + p.length]
            assert (p.start, p.doc_tokens, p.offset) == (at, len(ids), 0)
            assert p.ids_crc32 == zlib.crc32(struct.pack(f"<{p.length}I", *part))
            at += p.length
        assert at == len(ids)


def test_buckets_of_sequences(spark, odd, tmp_path):
    path = Q.vocabulary_path(Q.WORD_VOCABULARY)
    pieces = packing.decompose(odd, path)
    back = packing.write_buckets(pieces, f"{tmp_path}/buckets")
    assert back.columns == pieces.columns and back.count() == pieces.count()
    assert {int(p.name.split("=")[1]) for p in tmp_path.glob("buckets/length=*")} == {
        r.length for r in pieces.select("length").distinct().collect()
    }
    assert packing.decompose(odd.limit(0), path).count() == 0
    with pytest.raises(ValueError):
        packing.decompose(odd, path, settings=packing.Settings(longest=1000))


def test_lengths():
    for total in [*range(1, 70), 4095, 4096, 4097, 12_345]:
        made = packing.lengths(total, 16)
        assert sum(made) == total and made == sorted(made, reverse=True)
        rest = [x for x in made if x < 16]
        assert len(set(rest)) == len(rest) and all(x & (x - 1) == 0 for x in made)


# Collocations.


def plain_collocations(docs, least, first=2000, longest=5):
    counts, totals = defaultdict(Counter), Counter()
    for lang, text in docs:
        lang = "und" if lang is None else lang
        for piece in re.split(r"[.,;:!?\x0A-\x0D]", lower(text)):
            w = re.findall(r"[^\x20\x09]+", piece)
            totals[lang] += len(w)
            for n in range(1, longest + 1):
                counts[lang].update(tuple(w[i : i + n]) for i in range(len(w) - n + 1))
    rows = []
    for lang, f in counts.items():
        held = {g: a for g, a in f.items() if len(g) > 1 and a >= least}
        made = []
        for g, a in held.items():
            if any(
                b >= a and any(h[i : i + len(g)] == g for i in range(len(h) - len(g) + 1))
                for h, b in held.items() if len(h) > len(g)
            ):
                continue
            score, k = min((1000 * a * totals[lang] // (f[g[:k]] * f[g[k:]]), k) for k in range(1, len(g)))
            made.append((-score, -a, " ".join(g).encode(), a, f[g[:k]], f[g[k:]], totals[lang], score))
        for rank, (_, _, phrase, *rest) in enumerate(sorted(made)[:first], 1):
            rows.append((lang, rank, phrase.decode(), *rest))
    return sorted(rows)


def collected(df):
    return sorted(map(tuple, df.collect()))


@pytest.mark.parametrize("least, first", [(3, 2000), (2, 5)])
def test_collocations_of_odd_texts(spark, least, first):
    r = random.Random(5)
    vocabulary = ["of", "the", "The", "été", "x\x1cy", "日本", "a b", "'s", "z" * 300, *map(str, range(30))]
    weights = [30, 30, 5, *[3] * (len(vocabulary) - 3)]
    ends = [" ", " ", " ", " ", "\t", ". ", ",", "\n", "\x0c", " ! "]
    rows = []
    for i in range(150):
        n = r.choice([0, 1, 5, 60])
        text = "".join(w + r.choice(ends) for w in r.choices(vocabulary, weights, k=n))
        rows.append((r.choice(["en", "fr", None, "und", ""]), text))
    rows += [("en", None), (None, None), ("de", ""), ("de", " \t.,"), ("one", "a a a a a a a a a")]
    rows += rows[:40]  # repeated rows
    docs = spark.createDataFrame(rows, "lang string, text string")
    docs = docs.withColumns({c: F.lit(1) for c in ("word", "block", "rank", "n")}).repartition(4)
    settings = collocations.Settings(least=least, first=first)
    got = collected(collocations.collocations(docs, settings=settings))
    assert got == plain_collocations(rows, least, first)
    assert len(got) > 20


def test_collocations_of_empty_tables(spark):
    docs = spark.createDataFrame([], "lang string, text string")
    assert collocations.collocations(docs).collect() == []
    docs = spark.createDataFrame([("en", "a b c")], "lang string, text string")
    assert collocations.collocations(docs).collect() == []


def test_many_blocks_and_shards(spark, monkeypatch):
    rows = [(x.lang, x.text) for x in Q.read(spark, SMALL, "documents").select("lang", "text").collect()]
    docs = spark.createDataFrame(rows, "lang string, text string").repartition(6)
    # Workers get the module by reference, so only what the driver decides can be changed here.
    monkeypatch.setattr(collocations, "SHARD", 300)
    settings = collocations.Settings(least=8)
    assert collected(collocations.collocations(docs, settings=settings)) == plain_collocations(rows, 8)


@pytest.mark.parametrize("n", [2, 3, 4, 5])
@pytest.mark.parametrize("width", [1, 2, 7, 9, 13, 16, 17, 21, 22, 31, 32])
def test_permuted_phrases_come_back(n, width):
    r = np.random.default_rng(n * 100 + width)
    high = min(1 << width, (1 << 32) - 1)
    words = r.integers(1, high, 500, endpoint=True).astype(np.uint32)
    pack = collocations.Packing(n, width)
    at = np.arange(len(words) - n + 1)
    keys = pack.permuted(words, at)
    for x, bits in zip(keys, pack.bits):
        assert bits <= 64 and (bits == 64 or int(x.max()) < 1 << bits)
    want = np.stack([words[at + k].astype(np.int64) - 1 for k in range(n)], axis=1)
    assert (pack.phrases(keys) == want).all()
    found, _ = collocations.distinct(keys)
    assert len(found[0]) == len(np.unique(want, axis=0))


@pytest.mark.parametrize("bits", [0, 1, 3, 8])
@pytest.mark.parametrize("n, width", [(2, 2), (2, 13), (2, 32), (3, 22), (5, 17)])
def test_filters_keep_every_counter(n, width, bits):
    r = np.random.default_rng(bits)
    level = collocations.Level(n, width, bits, 1)
    words = r.integers(1, 1 << min(width, 12), 3_000).astype(np.uint32)
    keys, phrase = collocations.distinct(level.packing.permuted(words, np.arange(len(words) - n + 1)))
    counts = np.bincount(phrase)
    counts[::7] += 254
    counts[::11] += 1 << 40
    seen = 0
    for shard, start, end in level.shards(keys):
        raw = level.filter.pack([k[start:end] for k in keys], counts[start:end])
        back, found = level.filter.unpack(raw, shard)
        assert (found == counts[start:end]).all()
        assert all((a == k[start:end]).all() for a, k in zip(back, keys, strict=True))
        seen += end - start
    assert seen == len(counts)


@pytest.mark.parametrize("name", ["op11_resampling", "op13_collocations"])
def test_against_sql(spark, name):
    folder = SMALL if name == "op11_resampling" else "/root/testdata/sf0.01"
    assert difference(Q.QUERIES[name](spark, folder), connect(folder), ORACLE_SQL[name]) is None


def test_scores_beyond_64_bits(spark):
    a, n, left, right = 3 * 10**11, 9 * 10**16, 4 * 10**11, 7 * 10**11
    words = spark.createDataFrame(
        [("en", "x", left, 0), ("en", "y", right, 1)], "lang string, word string, f bigint, gid bigint"
    )
    phrases = spark.createDataFrame([([0, 1], a)], "phrase array<bigint>, f bigint")
    totals = spark.createDataFrame([("en", n)], "lang string, n bigint")
    row = collocations.lowest_cuts(words, phrases, totals).first()
    assert row.score == 1000 * a * n // (left * right) and (row.a, row.l, row.r) == (a, left, right)
