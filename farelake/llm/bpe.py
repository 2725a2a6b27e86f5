"""Byte-pair encoding and decoding with forced boundaries.

A pair of bytes that is next to each other inside no vocabulary token can never be merged across, so a cut between
such bytes is certain. Texts are split by the pre-tokenizer's pattern, the pieces are cut at the certain places, the
fragments are encoded on their own and the ids put one after the other. What follows a space up to the next one is
encoded once per worker and remembered as packed ids.
"""

from __future__ import annotations

import heapq
import json
import struct
from collections.abc import Callable, Iterator
from functools import lru_cache
from hashlib import sha256

import numpy as np
import public_tokenizers
import pyarrow as pa
import regex
from pyspark.sql import DataFrame

from farelake.llm.common import bounded_batches

_PATTERN = regex.compile(public_tokenizers.PATTERN)
_REMEMBERED = 500_000  # parts, and as many pieces, that a worker remembers; about 200 bytes each
_SHORT = 32  # bytes; up to here a list is searched faster than a heap is kept
_NONE = 1 << 60
_LONGEST_REMEMBERED = 64  # characters


def byte_characters() -> list[str]:
    """The printable character that stands for each byte in the vocabulary file (a fixed public rule)."""
    shown = [*range(0x21, 0x7F), *range(0xA1, 0xAD), *range(0xAE, 0x100)]
    others = iter(range(0x100, 0x200))
    return [chr(b) if b in shown else chr(next(others)) for b in range(256)]


class Merges:
    """Merges of a vocabulary, as (left id, right id) -> (rank, merged id)."""

    def __init__(self, merges: dict[tuple[int, int], tuple[int, int]]):
        self.table = {a << 20 | b: rank << 20 | merged for (a, b), (rank, merged) in merges.items()}

    def apply(self, ids: list[int]) -> list[int]:
        """Apply the merges in order of rank, leftmost first."""
        return self._apply_short(ids) if len(ids) <= _SHORT else self._apply_long(ids)

    def _apply_short(self, ids: list[int]) -> list[int]:
        look = self.table.get
        found = [look(a << 20 | b, _NONE) for a, b in zip(ids, ids[1:])]  # noqa: B905
        while found and (best := min(found)) != _NONE:
            i = found.index(best)
            ids[i] = merged = best & 0xFFFFF
            del ids[i + 1], found[i]
            if i < len(found):
                found[i] = look(merged << 20 | ids[i + 1], _NONE)
            if i:
                found[i - 1] = look(ids[i - 1] << 20 | merged, _NONE)
        return ids

    def _apply_long(self, given: list[int]) -> list[int]:
        """With a heap, in n log n steps."""
        look = self.table.get
        ids: list[int | None] = list(given)
        n = len(ids)
        after, before = list(range(1, n + 1)), list(range(-1, n - 1))
        heap = [(m, i) for i in range(n - 1) if (m := look(ids[i] << 20 | ids[i + 1], _NONE)) != _NONE]
        heapq.heapify(heap)
        while heap:
            best, i = heapq.heappop(heap)
            j = after[i]
            if ids[i] is None or j >= n or look(ids[i] << 20 | ids[j], _NONE) != best:
                continue  # one of the two has been merged meanwhile
            ids[i], ids[j] = best & 0xFFFFF, None
            after[i] = after[j]
            if after[i] < n:
                before[after[i]] = i
                if (m := look(ids[i] << 20 | ids[after[i]], _NONE)) != _NONE:
                    heapq.heappush(heap, (m, i))
            if before[i] >= 0 and (m := look(ids[before[i]] << 20 | ids[i], _NONE)) != _NONE:
                heapq.heappush(heap, (m, before[i]))
        return [i for i in ids if i is not None]


class Remembered(dict):
    """What a function gives for a short text, remembered. When it is full, the older half goes."""

    def __init__(self, function: Callable[[str], bytes | None], size: int):
        super().__init__()
        self.function, self.half, self.older = function, size // 2, {}

    def __missing__(self, text: str) -> bytes:
        value = self.older.get(text)
        if value is None:
            value = self.function(text)
        if len(text) <= _LONGEST_REMEMBERED:
            if len(self) >= self.half:
                self.older = dict(self)
                self.clear()
            self[text] = value
        return value


class ByteBPE:
    """Encodes and decodes as the tokenizer file says."""

    def __init__(self, path: str):
        with open(path, encoding="utf-8") as file:
            spec = json.load(file)
        model = spec["model"]
        byte_of = {c: b for b, c in enumerate(byte_characters())}
        self.tokens: dict[int, bytes] = {i: bytes(byte_of[c] for c in t) for t, i in model["vocab"].items()}
        ids = {t: i for i, t in self.tokens.items()}
        self.special = {t["content"]: t["id"] for t in spec["added_tokens"]}
        self.tokens.update({i: t.encode() for t, i in self.special.items()})
        self.byte_id = [ids[bytes([b])] for b in range(256)]
        merges: dict[tuple[int, int], tuple[int, int]] = {}
        for rank, merge in enumerate(model["merges"]):
            left, right = merge if isinstance(merge, list) else merge.split(" ")
            a, b = bytes(byte_of[c] for c in left), bytes(byte_of[c] for c in right)
            merges.setdefault((ids[a], ids[b]), (rank, ids[a + b]))
        self._merges = Merges(merges)
        together = {t[i : i + 2] for t in ids for i in range(len(t) - 1)}
        self._inside = np.zeros(1 << 16, bool)
        self._inside[[t[0] << 8 | t[1] for t in together]] = True
        self._together = together
        self._special = regex.compile("(" + "|".join(regex.escape(t) for t in self.special) + ")") if self.special else None
        self._pieces = Remembered(self._encode_piece, _REMEMBERED)
        self._packed = Remembered(self._encode_part, _REMEMBERED)
        self._decoded = [self.tokens.get(i, b"") for i in range(max(self.tokens) + 1)]

    def fragments(self, piece: bytes) -> list[bytes]:
        """The piece, cut wherever no token has the two bytes next to each other."""
        if len(piece) <= _SHORT:
            cuts = [i for i in range(1, len(piece)) if piece[i - 1 : i + 1] not in self._together]
            if not cuts:
                return [piece]
            return [piece[a:b] for a, b in zip([0, *cuts], [*cuts, len(piece)], strict=True)]
        codes = np.frombuffer(piece, np.uint8).astype(np.int32)
        cuts = (np.flatnonzero(~self._inside[codes[:-1] << 8 | codes[1:]]) + 1).tolist()
        return [piece[a:b] for a, b in zip([0, *cuts], [*cuts, len(piece)], strict=True)]

    def _encode_piece(self, piece: str) -> bytes:
        ids = [i for f in self.fragments(piece.encode()) for i in self._merges.apply([self.byte_id[b] for b in f])]
        return struct.pack(f"<{len(ids)}I", *ids)

    def encode_packed(self, text: str) -> bytes:
        """The ids of a text as little-endian unsigned 32-bit integers."""
        if not any(t in text for t in self.special):
            return self._encode_plain(text)
        parts = self._special.split(text)
        return b"".join(np.uint32(self.special[p]).tobytes() if p in self.special else self._encode_plain(p) for p in parts)

    def _encode_plain(self, text: str) -> bytes:
        # The pattern starts a piece at every space but in runs of white space that hold a second one, or end the text.
        first, *others = text.split(" ")
        try:
            return self._encode_spaced(first) + b"".join(map(self._packed.__getitem__, others))
        except TypeError:  # a part that starts with white space, or is empty, has no ids of its own
            return self._encode_spaced(text)

    def _encode_part(self, part: str) -> bytes | None:
        return None if not part or part[0].isspace() else self._encode_spaced(" " + part)

    def _encode_spaced(self, text: str) -> bytes:
        return b"".join(map(self._pieces.__getitem__, _PATTERN.findall(text)))

    def decode_packed(self, packed: bytes) -> str:
        ids = np.frombuffer(packed, "<u4").tolist()
        return b"".join(map(self._decoded.__getitem__, ids)).decode("utf-8", "replace")


@lru_cache(maxsize=2)
def load(path: str) -> ByteBPE:
    return ByteBPE(path)


_ENCODED = "doc_id long, n_tokens long, ids binary"
_CHECKED = "doc_id long, n_tokens long, ids_sha256 string, decoded_sha256 string"


def _texts(batch: pa.RecordBatch) -> Iterator[str]:
    return (x.as_py() or "" for x in batch.column("text"))


def _rows(docs: DataFrame) -> DataFrame:
    bounded_batches(docs.sparkSession)
    return docs.select(docs["doc_id"].cast("long").alias("doc_id"), "text")


def encode(docs: DataFrame, path: str) -> DataFrame:
    """doc_id, n_tokens and the packed ids of every whole text.

    A null text is the empty text and has no ids; strings of special tokens in a text become their ids; a null doc_id
    is kept; repeated rows are encoded one by one; an empty table gives no rows; other columns are ignored.
    """

    def each(batches: Iterator[pa.RecordBatch]) -> Iterator[pa.RecordBatch]:
        coder = load(path)
        for batch in batches:
            ids = [coder.encode_packed(t) for t in _texts(batch)]
            sizes = pa.array([len(x) // 4 for x in ids], pa.int64())
            yield pa.RecordBatch.from_arrays([batch.column("doc_id"), sizes, pa.array(ids, pa.binary())], ["doc_id", "n_tokens", "ids"])

    return _rows(docs).mapInArrow(each, _ENCODED)


def decode(encoded: DataFrame, path: str) -> DataFrame:
    """doc_id and the text of packed ids; special tokens are written out. Null ids give the empty text."""

    def each(batches: Iterator[pa.RecordBatch]) -> Iterator[pa.RecordBatch]:
        coder = load(path)
        for batch in batches:
            texts = [coder.decode_packed(x.as_py() or b"") for x in batch.column("ids")]
            yield pa.RecordBatch.from_arrays([batch.column("doc_id"), pa.array(texts, pa.string())], ["doc_id", "text"])

    return encoded.select("doc_id", "ids").mapInArrow(each, "doc_id long, text string")


def round_trip(docs: DataFrame, path: str) -> DataFrame:
    """Encode and decode in one pass: doc_id, n_tokens and SHA-256 digests of the packed ids and the decoded text."""

    def each(batches: Iterator[pa.RecordBatch]) -> Iterator[pa.RecordBatch]:
        coder = load(path)
        for batch in batches:
            sizes, ids_digests, text_digests = [], [], []
            for text in _texts(batch):
                packed = coder.encode_packed(text)
                sizes.append(len(packed) // 4)
                ids_digests.append(sha256(packed).hexdigest())
                text_digests.append(sha256(coder.decode_packed(packed).encode()).hexdigest())
            arrays = [batch.column("doc_id"), pa.array(sizes, pa.int64()), pa.array(ids_digests), pa.array(text_digests)]
            yield pa.RecordBatch.from_arrays(arrays, ["doc_id", "n_tokens", "ids_sha256", "decoded_sha256"])

    return _rows(docs).mapInArrow(each, _CHECKED)


def op1_bpe(spark, sf_dir: str) -> DataFrame:
    return round_trip(spark.read.parquet(f"{sf_dir}/documents.parquet"), public_tokenizers.path("byte_bpe_50k.json"))
