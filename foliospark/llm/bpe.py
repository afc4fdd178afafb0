"""BPE encoding and decoding with forced-boundary splitting.

A pair of bytes that stands inside no token of the vocabulary can never be merged, so the place
between them is a certain cut. Texts are cut there, each fragment is encoded by itself and the ids
are put together. Words repeat far more than texts, so most fragments come from a memo.

Two rules keep the fragments' own splitting into words the same as the whole text's: no cut after
white space, where the expression looks ahead, and none before an apostrophe, where a contraction
could begin. Added tokens are taken out first, as the tokenizers library does.
"""

from __future__ import annotations

import hashlib
import json
import os
import re
import struct

from pyspark.sql import DataFrame
from pyspark.sql import functions as F

from foliospark.llm.common import struct_udf

# Fragments kept per worker, and the longest one kept: 100 to 200 MB at the most.
MEMO_SIZE, MEMO_BYTES = 600_000, 48

ENCODED = "n_tokens bigint, ids binary"
ROUND_TRIP = "n_tokens bigint, ids_sha256 string, decoded_sha256 string"


def byte_of_character() -> dict[str, int]:
    """The byte that each character of a byte-level vocabulary stands for: printable Latin-1
    characters stand for themselves, the other bytes in order for those from U+0100."""
    plain = [*range(0x21, 0x7F), *range(0xA1, 0xAD), *range(0xAE, 0x100)]
    rest = [b for b in range(256) if b not in set(plain)]
    return {chr(b): b for b in plain} | {chr(0x100 + i): b for i, b in enumerate(rest)}


class Codec:
    """Encoder and decoder of one vocabulary file; built once per task."""

    def __init__(self, path: str):
        import numpy as np
        from tokenizers import Tokenizer

        # Spark has a worker on every core already.
        os.environ.setdefault("TOKENIZERS_PARALLELISM", "false")
        with open(path, encoding="utf-8") as file:
            spec = json.load(file)
        to_byte = byte_of_character()
        self.tokenizer = Tokenizer.from_file(path)
        self.tokenizer.no_truncation()
        self.tokenizer.no_padding()
        self.bytes_of = {
            i: bytes(to_byte[c] for c in token) for token, i in spec["model"]["vocab"].items()
        }
        self.added = {x["content"]: x["id"] for x in spec["added_tokens"]}
        self.bytes_of |= {i: token.encode() for token, i in self.added.items()}
        longest_first = sorted(self.added, key=len, reverse=True)
        self.split = (
            re.compile("(" + "|".join(map(re.escape, longest_first)) + ")").split
            if self.added
            else lambda text: [text]
        )
        self.cut = self.cut_table(np)
        self.memo: dict[bytes, bytes] = {}

    def cut_table(self, np):
        """cut[a, b]: bytes a and b may be parted for certain, as far as these two tell."""
        inside = np.zeros((256, 256), bool)
        for token in self.bytes_of.values():
            if len(token) > 1:
                t = np.frombuffer(token, np.uint8)
                inside[t[:-1], t[1:]] = True
        cut = ~inside
        cut[[*range(0x09, 0x0E), *range(0x1C, 0x21)], :] = False  # white space
        cut[:, 0x27] = False  # apostrophe
        cut[:, 0x80:0xC0] = False  # the inside of a character
        return cut

    def fragments(self, raw: bytes) -> list[bytes]:
        import numpy as np

        if len(raw) < 2:
            return [raw] if raw else []
        b = np.frombuffer(raw, np.uint8)
        at = self.cut[b[:-1], b[1:]]
        # After a character beyond ASCII only if it has two bytes from C3 on: never white space.
        lead = np.empty(len(b) - 1, np.uint8)
        lead[0], lead[1:] = 0, b[:-2]
        at &= (b[:-1] < 0x80) | ((lead >= 0xC3) & (lead < 0xE0))
        ends = (np.flatnonzero(at) + 1).tolist()
        return [raw[a:e] for a, e in zip([0, *ends], [*ends, len(raw)], strict=True)]

    def encode(self, text: str) -> bytes:
        """The ids as little-endian unsigned 32-bit integers."""
        out: list[bytes] = []
        for part in self.split(text):
            if part in self.added:
                out.append(self.packed([self.added[part]]))
            elif part:
                out += self.encode_plain(part.encode())
        return b"".join(out)

    def encode_plain(self, raw: bytes) -> list[bytes]:
        fragments, memo = self.fragments(raw), self.memo
        missing = [f for f in set(fragments) if f not in memo]
        if missing and len(memo) + len(missing) > MEMO_SIZE:
            memo.clear()
            missing = list(set(fragments))
        for start in range(0, len(missing), 1024):
            some = missing[start : start + 1024]
            texts = [f.decode() for f in some]
            encoded = self.tokenizer.encode_batch_fast(texts, add_special_tokens=False)
            memo.update((f, self.packed(e.ids)) for f, e in zip(some, encoded, strict=True))
        out = list(map(memo.__getitem__, fragments))
        for f in missing:
            if len(f) > MEMO_BYTES:
                del memo[f]
        return out

    @staticmethod
    def packed(ids: list[int]) -> bytes:
        return struct.pack(f"<{len(ids)}I", *ids)

    def decode(self, ids: bytes) -> str:
        """The text of the ids, added tokens included; broken UTF-8 becomes U+FFFD, and ids
        outside the vocabulary are passed over."""
        values = struct.unpack(f"<{len(ids) // 4}I", ids)
        table = self.bytes_of
        return b"".join([table.get(i, b"") for i in values]).decode("utf-8", "replace")


def encoder(path: str):
    codec = Codec(path)

    def one(text: str | None) -> tuple:
        ids = codec.encode(text or "")
        return len(ids) // 4, ids

    return one


def decoder(path: str):
    codec = Codec(path)
    return lambda ids: (codec.decode(ids or b""),)


def round_tripper(path: str):
    codec = Codec(path)

    def one(text: str | None) -> tuple:
        ids = codec.encode(text or "")
        decoded = codec.decode(ids).encode("utf-8")
        return len(ids) // 4, hashlib.sha256(ids).hexdigest(), hashlib.sha256(decoded).hexdigest()

    return one


def encode(docs: DataFrame, path: str, text_col: str = "text", into: str = "bpe") -> DataFrame:
    """``docs`` with a struct column ``into`` of ``n_tokens`` and ``ids`` (little-endian unsigned
    32-bit integers in binary) for each row. ``path`` names the vocabulary file, which each
    worker opens for itself. A null text is encoded as the empty one: no tokens."""
    return docs.withColumn(into, struct_udf(lambda: encoder(path), ENCODED)(F.col(text_col)))


def decode(rows: DataFrame, path: str, ids_col: str = "ids", into: str = "decoded") -> DataFrame:
    """``rows`` with the text of ``ids_col`` in a struct column ``into``; null ids give ''."""
    return rows.withColumn(into, struct_udf(lambda: decoder(path), "text string")(F.col(ids_col)))


def round_trip(docs: DataFrame, path: str, text_col: str = "text", into: str = "bpe") -> DataFrame:
    """``docs`` with a struct column ``into``: number of tokens and digests of the ids and of what
    they decode to, for each row, without moving ids between processes."""
    return docs.withColumn(
        into, struct_udf(lambda: round_tripper(path), ROUND_TRIP)(F.col(text_col))
    )
