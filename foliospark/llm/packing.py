"""Packing by power-of-two decomposition.

A text's ids, the end mark included, are cut into as many pieces of the full length as fit and then
into the powers of two of the rest, largest first. Every piece is a sequence of its own, and
sequences of one length make up a bucket, from which batches of equal shape can be drawn. So no
sequence crosses texts and none is padded.

Encoding goes by fragments between ASCII white space, at which the vocabulary's own splitting
always cuts; fragments repeat far more than texts, so most come from a memo. Words of Latin
letters go to the vocabulary's merges at once, all else through the whole tokenizer.
"""

from __future__ import annotations

import functools
import os
import re
import struct
import unicodedata
from dataclasses import dataclass

import pyarrow as pa
from pyspark.sql import DataFrame
from pyspark.sql import functions as F

from foliospark.llm.bpe import byte_of_character
from foliospark.llm.common import id_and_text

# Entries of each memo of a worker and the longest one kept: about 250 MB together at the most.
MEMO_SIZE, MEMO_BYTES = 600_000, 48
# Ids handed on at a time.
IDS = 1 << 20
LETTERS = re.compile(rb"[A-Za-z]+|[^A-Za-z]+")
PUNCTUATION = ".,;:!?|"
# Latin letters: one word for the vocabulary's splitting, and normalised but for their case.
LATIN = re.compile("[A-Za-z\u00c0-\u00d6\u00d8-\u00f6\u00f8-\u00ff]+")


@dataclass(frozen=True)
class Settings:
    """``longest`` is the length of a full sequence, a power of two; ``end`` closes each text."""

    longest: int = 4096
    end: int = 2


def parts_of(fragment: bytes) -> list[bytes]:
    """Cuts a fragment where letters meet other characters, as the vocabulary's splitting does.

    ASCII letters are in lower case then. An apostrophe may begin a contraction, and beyond ASCII only
    punctuation behind a letter is surely apart, as marks may join a letter.
    """
    if fragment.isascii():
        return [fragment] if b"'" in fragment else LETTERS.findall(fragment.lower())
    text = fragment.decode()
    core = text.rstrip(PUNCTUATION)
    # Normalised, a letter may end with a mark.
    if core == text or not unicodedata.normalize("NFC", core[-1:]).lower()[-1:].isalpha():
        return [fragment]
    return [core.encode(), text[len(core) :].encode()]


class Encoder:
    """Ids of texts by one vocabulary file, as the tokenizers library gives them."""

    def __init__(self, path: str):
        from tokenizers import Tokenizer

        # Spark has a worker on every core already.
        os.environ.setdefault("TOKENIZERS_PARALLELISM", "false")
        self.tokenizer = Tokenizer.from_file(path)
        self.tokenizer.no_truncation()
        self.tokenizer.no_padding()
        self.model = self.tokenizer.model
        self.character = {b: c for c, b in byte_of_character().items()}
        self.added = [t.content.lower().encode() for t in self.tokenizer.get_added_tokens_decoder().values()]
        self.fragments: dict[bytes, bytes] = {}
        self.parts: dict[bytes, bytes] = {}

    def encode(self, raw: bytes) -> bytes:
        """The ids as little-endian unsigned 32-bit integers."""
        lower = raw.lower()
        if any(t in lower for t in self.added):
            return self.batch([raw])[0]
        found, memo = raw.split(), self.fragments
        if not memo.keys() >= (new := set(found)):
            self.learn([f for f in new if f not in memo])
        ids = b"".join(map(memo.__getitem__, found))
        if len(memo) > MEMO_SIZE:
            memo.clear()
        return ids

    def batch(self, texts: list[bytes]) -> list[bytes]:
        encoded = self.tokenizer.encode_batch_fast([t.decode() for t in texts], add_special_tokens=False)
        return [struct.pack(f"<{len(e.ids)}I", *e.ids) for e in encoded]

    def word(self, text: str) -> bytes:
        """The ids of Latin letters: no more is left to do than merging the bytes of the word."""
        raw = text.lower().encode()
        if not raw.isascii():
            return self.merged(raw.decode("latin-1").translate(self.character))
        return self.merged(raw.decode())

    def merged(self, characters: str) -> bytes:
        ids = [t.id for t in self.model.tokenize(characters)]
        return struct.pack(f"<{len(ids)}I", *ids)

    def learn(self, fragments: list[bytes]) -> None:
        cut = [parts_of(f) for f in fragments]
        new, rest = list({p for parts in cut for p in parts if p not in self.parts}), []
        for p in new:
            text = p.decode()
            if LATIN.fullmatch(text):
                self.parts[p] = self.word(text)
            else:
                rest.append(p)
        for start in range(0, len(rest), 1024):
            some = rest[start : start + 1024]
            self.parts.update(zip(some, self.batch(some), strict=True))
        for f, parts in zip(fragments, cut, strict=True):
            self.fragments[f] = b"".join([self.parts[p] for p in parts])
        for p in new:
            if len(p) > MEMO_BYTES:
                del self.parts[p]
        if len(self.parts) > MEMO_SIZE:
            self.parts.clear()


@functools.cache
def worker_encoder(path: str) -> Encoder:
    """One encoder for each worker process, kept from task to task."""
    return Encoder(path)


def lengths(total: int, longest: int) -> list[int]:
    """The pieces of ``total`` ids: full ones, then the powers of two of the rest."""
    full, rest = divmod(total, longest)
    powers = [1 << k for k in range(rest.bit_length() - 1, -1, -1) if rest >> k & 1]
    return [longest] * full + powers


def decomposer(path: str, settings: Settings):
    """``mapInArrow`` function from (id, text) to pieces; ``made`` counts a task's pieces of a length."""
    names = ["doc_id", "start", "length", "ids", "doc_tokens", "sequence_id", "offset"]

    def run(batches):
        from pyspark import TaskContext

        encoder = worker_encoder(path)
        task, made = TaskContext.get().partitionId(), {}
        end = struct.pack("<I", settings.end)
        for batch in batches:
            texts = batch.column(1).cast(pa.binary())
            kinds = (pa.int64(), pa.int64(), pa.int64(), pa.binary(), pa.int64(), pa.int64(), pa.int64())
            rows: list[tuple] = []
            held = 0

            def flush():
                at, *values = zip(*rows, strict=True)
                columns = [pa.array(v, k) for v, k in zip(values, kinds[1:], strict=True)]
                return pa.RecordBatch.from_arrays([batch.column(0).take(pa.array(at)), *columns], names)

            for i, text in enumerate(texts):
                ids = encoder.encode(text.as_py() or b"") + end
                total, start = len(ids) // 4, 0
                for n in lengths(total, settings.longest):
                    made[n] = made.get(n, -1) + 1
                    # Bucket, task, place in the task's share of the bucket.
                    sequence = (n.bit_length() - 1) << 56 | task << 32 | made[n]
                    rows.append((i, start, n, ids[4 * start : 4 * (start + n)], total, sequence, 0))
                    start += n
                held += total
                if held >= IDS:
                    yield flush()
                    rows, held = [], 0
            if rows:
                yield flush()

    return run


def decompose(
    docs: DataFrame,
    path: str,
    id_col: str = "doc_id",
    text_col: str = "text",
    settings: Settings = Settings(),
) -> DataFrame:
    """(doc_id, start, length, ids, doc_tokens, sequence_id, offset), one row per piece.

    ``ids`` are little-endian unsigned 32-bit integers in binary, ``start`` is the number of the
    text's ids before the piece and ``doc_tokens`` all of them with the end mark. A piece fills its
    sequence, so ``offset`` is 0. Sequence ids sort by length, and are unique as long as the
    table's files are read in the same splits; write the result once to keep them.

    A null or empty text has the end mark alone, one sequence of one id. Repeated rows, and rows
    with equal or null ids, are texts of their own. An empty table gives no pieces. A text's
    ids are held by one task, whatever its length. Columns besides id and text are not looked at.
    Narrow: nothing is shuffled.
    """
    if settings.longest & (settings.longest - 1):
        raise ValueError("the longest sequence must be a power of two")
    rows = id_and_text(docs, id_col, text_col)
    kind = rows.schema["doc_id"].dataType.simpleString()
    columns = (
        f"doc_id {kind}, start bigint, length bigint, ids binary, doc_tokens bigint, "
        "sequence_id bigint, offset bigint"
    )
    return rows.mapInArrow(decomposer(path, settings), columns)


def write_buckets(pieces: DataFrame, out: str) -> DataFrame:
    """The pieces of :func:`decompose` written with a folder for each length, and read back.

    Every task adds its own file to each folder, so no length passes through one task.
    """
    pieces.write.partitionBy("length").parquet(out)
    back = pieces.sparkSession.read.schema(pieces.schema).parquet(out)
    return back.select(*pieces.columns)


def with_checksums(pieces: DataFrame) -> DataFrame:
    """Pieces with the CRC-32 of their ids in place of the ids."""
    return pieces.withColumn("ids_crc32", F.crc32("ids")).drop("ids")
