"""Best-fit-decreasing packing of tokenized documents into sequences.

Best-fit decreasing depends on the lengths only, and there are at most ``capacity`` different ones. So the packing of
the whole corpus is worked out over a histogram of lengths: runs of equal pieces go, from long to short, into the open
sequences with the tightest room, which a segment tree over the remaining capacities finds in logarithmic time. That
gives exactly the sequences that placing the pieces one by one would give. The plan says which places a run of equal
pieces takes; every piece then finds its own by its rank among the pieces of its length.

A run splits at most two ranges of equal sequences and opens at most two, so there are at most four ranges per length,
and a range is filled once per different length in a sequence, of which 4,096 tokens hold fewer than 91. So the plan
has less than 1.5 million steps of 40 bytes for any corpus; it goes to the tasks as a broadcast variable.
"""

from __future__ import annotations

import json
import re
from collections.abc import Iterator
from functools import lru_cache
from itertools import chain
from zlib import crc32

import numpy as np
import public_tokenizers
import pyarrow as pa
from pyspark.sql import DataFrame
from pyspark.sql import functions as F
from tokenizers import Tokenizer

from farelake.llm.bpe import Merges, byte_characters
from farelake.llm.common import bounded_batches, without_cycles
from farelake.operators.numbering import global_row_number
from farelake.session import materialize

#: What a worker remembers of white-space separated parts, and of the words in them.
_REMEMBERED_BYTES = 96 << 20
_ENTRY_BYTES = 200  # of a short text, its ids and their places in two tables
_SLICE_BYTES = 2 << 20
_LONGEST_TOGETHER = 32  # bytes of a word that is merged with others
_NONE = 1 << 60
_SLOT_BITS = 18

_LETTER = "a-z\xaa\xb5\xba\xdf-\xf6\xf8-\xff"
_NUMBER = "0-9\xb2\xb3\xb9\xbc-\xbe"


class _Pairs:
    """Merges by (left id, right id), looked up for many pairs at once; open addressing in a fixed number of slots."""

    def __init__(self, table: dict[int, int]):
        slots = 1 << max(_SLOT_BITS, (4 * len(table)).bit_length())
        self.shift = np.uint64(64 - slots.bit_length() + 1)
        self.keys, self.values = np.full(slots, -1, np.int64), np.full(slots, _NONE, np.int64)
        key, value = (np.fromiter(x, np.int64, len(table)) for x in (table.keys(), table.values()))
        slot = self._slot(key)
        while len(key):
            free = self.keys[slot] < 0
            _, first = np.unique(slot[free], return_index=True)
            taken = np.flatnonzero(free)[first]
            self.keys[slot[taken]], self.values[slot[taken]] = key[taken], value[taken]
            rest = np.setdiff1d(np.arange(len(key)), taken, assume_unique=True)
            key, value, slot = key[rest], value[rest], (slot[rest] + 1) % slots

    def _slot(self, key: np.ndarray) -> np.ndarray:
        return ((key.astype(np.uint64) * np.uint64(0x9E3779B97F4A7C15)) >> self.shift).astype(np.int64)

    def look(self, left: np.ndarray, right: np.ndarray) -> np.ndarray:
        """The merge of each pair; none for a pair with an id below 0."""
        key = left << 20 | right
        slot = self._slot(key)
        found, open_ = np.full(len(key), _NONE, np.int64), np.flatnonzero((left >= 0) & (right >= 0))
        while len(open_):
            here = self.keys[slot[open_]]
            hit = here == key[open_]
            found[open_[hit]] = self.values[slot[open_[hit]]]
            open_ = open_[~hit & (here >= 0)]
            slot[open_] = (slot[open_] + 1) % len(self.keys)
        return found

    def merged(self, ids: np.ndarray) -> list[bytes]:
        """Each row's ids (padded by -1) after all merges, as packed integers. In each round every row that is left
        takes its merge of lowest rank, leftmost first, and so gets shorter by one."""
        result: list[bytes] = [b""] * len(ids)
        row, width = np.arange(len(ids)), ids.shape[1]
        ranks = self.look(ids[:, :-1].ravel(), ids[:, 1:].ravel()).reshape(len(ids), width - 1)
        while len(row):
            at = ranks.argmin(axis=1) if width > 1 else np.zeros(len(row), np.int64)
            best = ranks[np.arange(len(row)), at] if width > 1 else np.full(len(row), _NONE)
            done = best == _NONE
            if done.any():
                ended = ids[done]
                sizes = (ended >= 0).sum(axis=1).tolist()
                packed = ended.astype("<u4")
                for r, n, values in zip(row[done].tolist(), sizes, packed, strict=True):
                    result[r] = values[:n].tobytes()
                going = ~done
                row, ids, ranks, at, best = row[going], ids[going], ranks[going], at[going], best[going]
                if not len(row):
                    break
            every, column = np.arange(len(row)), np.arange(width - 1)
            ids = np.take_along_axis(ids, column + (column > at[:, None]), axis=1)
            ids[every, at] = best & 0xFFFFF
            width -= 1
            column = np.arange(width - 1)
            ranks = np.take_along_axis(ranks, column + (column >= at[:, None]), axis=1) if width > 1 else ranks[:, :0]
            for shift in (0, 1):  # the pairs that the merged id begins and ends
                place = at - shift
                some = np.flatnonzero((place >= 0) & (place < width - 1))
                left, right = ids[some, place[some]], ids[some, place[some] + 1]
                ranks[some, place[some]] = self.look(left, right)
        return result


class _Recent:
    """Values by text: those used lately, in about ``budget`` bytes."""

    def __init__(self, budget: int):
        self.now: dict[str, bytes] = {}
        self.older: dict[str, bytes] = {}
        self.half, self.used = budget // 2, 0

    def settle(self, wanted: set[str], make) -> dict[str, bytes]:
        """A table that has all the wanted texts; ``make`` gives the values of a list of new ones."""
        if self.used > self.half:
            self.older, self.now, self.used = self.now, {}, 0
        fresh = wanted.difference(self.now)
        if self.older:
            again = {text: self.older[text] for text in fresh & self.older.keys()}
            self._keep(again)
            fresh.difference_update(again)
        new = list(fresh)
        self._keep(dict(zip(new, make(new), strict=True)))
        return self.now

    def _keep(self, values: dict[str, bytes]) -> None:
        self.now.update(values)
        self.used += _ENTRY_BYTES * len(values) + sum(map(len, values)) + sum(map(len, values.values()))


class WordIds:
    """Packed ids of texts.

    Texts of plain Latin characters are lowered and split here; the distinct words of some texts that are not remembered
    are merged together. All other texts go to the tokenizers library whole. Both ways give the same ids (tests/llm).
    """

    #: What the tokenizer's own pre-tokenizer keeps (a fixed pattern of the vocabulary file), for Latin-1 text.
    _WORD = re.compile(rf"'s|'t|'re|'ve|'m|'ll|'d|[{_LETTER}]+|[{_NUMBER}]|[^\s{_LETTER}{_NUMBER}]+")
    #: White space to Python only, or perhaps a special token.
    _APART = ("\x1c", "\x1d", "\x1e", "\x1f", "<|")

    def __init__(self, path: str):
        self.tokenizer = Tokenizer.from_file(path)
        self.tokenizer.no_truncation()
        self.tokenizer.no_padding()
        with open(path, encoding="utf-8") as file:
            model = json.load(file)["model"]
        vocabulary, shown = model["vocab"], byte_characters()
        self._inner = np.array([vocabulary[c] for c in shown], np.int64)
        self._last = np.array([vocabulary[c + model["end_of_word_suffix"]] for c in shown], np.int64)
        merges: dict[tuple[int, int], tuple[int, int]] = {}
        for rank, merge in enumerate(model["merges"]):
            left, right = merge if isinstance(merge, list) else merge.split(" ")
            merges.setdefault((vocabulary[left], vocabulary[right]), (rank, vocabulary[left + right]))
        self._merges = Merges(merges)
        self._pairs = _Pairs(self._merges.table)
        self._words, self._parts = _Recent(_REMEMBERED_BYTES), _Recent(_REMEMBERED_BYTES)

    def _encode_words(self, words: list[str]) -> list[bytes]:
        result: list[bytes] = [b""] * len(words)
        raw = [w.encode() for w in words]
        sizes = np.fromiter(map(len, raw), np.int64, len(raw))
        low = 0
        for high in (6, 9, 12, 16, 24, _LONGEST_TOGETHER):
            mine = np.flatnonzero((sizes > low) & (sizes <= high))
            low = high
            for at in range(0, len(mine), 20_000):
                some = mine[at : at + 20_000]
                n = sizes[some]
                joined = np.frombuffer(b"".join(raw[i].ljust(high) for i in some.tolist()), np.uint8).reshape(-1, high)
                ids = self._inner[joined]
                ids[np.arange(len(some)), n - 1] = self._last[joined[np.arange(len(some)), n - 1]]
                ids[np.arange(high) >= n[:, None]] = -1
                for i, packed in zip(some.tolist(), self._pairs.merged(ids), strict=True):
                    result[i] = packed
        for i in np.flatnonzero(sizes > _LONGEST_TOGETHER).tolist():
            given = np.frombuffer(raw[i], np.uint8)
            ids = [*self._inner[given[:-1]].tolist(), int(self._last[given[-1]])]
            result[i] = np.array(self._merges.apply(ids), "<u4").tobytes()
        return result

    def _encode_parts(self, parts: list[str]) -> list[bytes]:
        # Most parts are a word; the others are split.
        split = {part: self._WORD.findall(part) for part in parts if not part.isalpha()}
        wanted = set(chain.from_iterable(split.values()))
        wanted.update(part for part in parts if part not in split)
        words = self._words.settle(wanted, self._encode_words)
        return [words[part] if part not in split else b"".join([words[w] for w in split[part]]) for part in parts]

    def _plain(self, text: str) -> bool:
        try:
            text.encode("latin-1")
        except UnicodeEncodeError:
            return False
        return not any(x in text for x in self._APART)

    def packed(self, texts: list[str]) -> list[bytes]:
        """The ids of some texts as little-endian unsigned 32-bit integers."""
        split = [text.lower().split() if self._plain(text) else None for text in texts]
        known = self._parts.settle(set(chain.from_iterable(filter(None, split))), self._encode_parts)
        whole = self.tokenizer
        return [
            np.array(whole.encode(text, add_special_tokens=False).ids, "<u4").tobytes()
            if parts is None
            else b"".join([known[p] for p in parts])
            for text, parts in zip(texts, split, strict=True)
        ]


def _together(texts: list[str]) -> Iterator[list[str]]:
    """Stretches of at most about 2 MB of text, or one text."""
    some: list[str] = []
    size = 0
    for text in texts:
        if some and size + len(text) > _SLICE_BYTES:
            yield some
            some, size = [], 0
        some.append(text)
        size += len(text)
    if some:
        yield some


@lru_cache(maxsize=2)
def load(path: str) -> WordIds:
    return WordIds(path)


_PIECES = "doc_id long, piece int, start long, length long, ids_crc32 long"


def tokenized_pieces(docs: DataFrame, path: str, capacity: int, end_id: int) -> DataFrame:
    """Each document's ids and the end id, cut into pieces of ``capacity`` if there are more."""

    def each(batches: Iterator[pa.RecordBatch]) -> Iterator[pa.RecordBatch]:
        words = load(path)
        with without_cycles():
            yield from cut(words, batches)

    def cut(words: WordIds, batches: Iterator[pa.RecordBatch]) -> Iterator[pa.RecordBatch]:
        end = np.uint32(end_id).tobytes()
        for batch in batches:
            rows: tuple[list, ...] = ([], [], [], [], [])
            texts = [text or "" for text in batch.column("text").to_pylist()]
            packed = chain.from_iterable(map(words.packed, _together(texts)))
            for doc_id, ids in zip(batch.column("doc_id").to_pylist(), packed, strict=True):
                ids += end
                for piece, at in enumerate(range(0, len(ids), 4 * capacity)):
                    part = ids[at : at + 4 * capacity]
                    for column, value in zip(rows, (doc_id, piece, at // 4, len(part) // 4, crc32(part)), strict=True):
                        column.append(value)
            kinds = (pa.int64(), pa.int32(), pa.int64(), pa.int64(), pa.int64())
            arrays = [pa.array(column, kind) for column, kind in zip(rows, kinds, strict=True)]
            yield pa.RecordBatch.from_arrays(arrays, ["doc_id", "piece", "start", "length", "ids_crc32"])

    bounded_batches(docs.sparkSession)
    return docs.select(F.col("doc_id").cast("long").alias("doc_id"), "text").mapInArrow(each, _PIECES)


class _Room:
    """A segment tree over remaining capacities that finds the smallest one in use that is large enough."""

    def __init__(self, capacity: int):
        self.size = 1 << capacity.bit_length()
        self.used = [False] * (2 * self.size)

    def mark(self, room: int, used: bool) -> None:
        node = room + self.size
        while node and self.used[node] != used:
            self.used[node] = used
            node //= 2
            used = self.used[2 * node] or self.used[2 * node + 1]

    def tightest(self, least: int) -> int | None:
        node = least + self.size
        if self.used[node]:
            return least
        while node > 1:  # up to the first subtree to the right that is in use, then down to its leftmost leaf
            if node % 2 == 0 and self.used[node + 1]:
                node += 1
                while node < self.size:
                    node = 2 * node if self.used[2 * node] else 2 * node + 1
                return node - self.size
            node //= 2
        return None


def best_fit_decreasing(counts: dict[int, int], capacity: int) -> tuple[np.ndarray, int]:
    """The plan for so many pieces of each length, and the number of sequences.

    A row of the plan: length, rank of its first piece among the pieces of that length, first sequence, pieces that
    go into each sequence, offset of the first piece there.
    """
    room = _Room(capacity)
    open_ranges: dict[int, list[tuple[int, int]]] = {}  # by remaining capacity: (first sequence, how many)
    plan: list[tuple[int, int, int, int, int]] = []
    opened = 0

    def keep(left: int, first: int, n: int) -> None:
        if left and n:
            open_ranges.setdefault(left, []).append((first, n))
            room.mark(left, True)

    for length in sorted(counts, reverse=True):
        count, rank = counts[length], 0
        while rank < count:
            left = room.tightest(length)
            if left is None:
                left, first = capacity, opened
                each = left // length
                n = -(-(count - rank) // each)
                opened += n
            else:
                each = left // length
                first, n = open_ranges[left].pop()
                if not open_ranges[left]:
                    room.mark(left, False)
            # As the tightest sequence stays the tightest while it is filled, each is filled before the next.
            full = min(n, (count - rank) // each)
            if full:
                plan.append((length, rank, first, each, capacity - left))
                rank += full * each
                keep(left - each * length, first, full)
            over = min(each, count - rank) if full < n else 0
            if over:
                plan.append((length, rank, first + full, over, capacity - left))
                rank += over
                keep(left - over * length, first + full, 1)
            rest = n - full - (over > 0)
            keep(left, first + n - rest, rest)
    return np.array(plan, np.int64).reshape(-1, 5), opened


def pack(docs: DataFrame, path: str, capacity: int = 4096, end_id: int = 1) -> DataFrame:
    """Pack all documents into sequences of at most ``capacity`` tokens.

    Returns per piece: doc_id, piece, start, length, ids_crc32, sequence_id (from 0), offset. A null or empty text is
    the end id alone; a null doc_id is kept; repeated rows are packed one by one; an empty table gives no rows; other
    columns are ignored. Pieces of equal length are taken in the order of doc_id and piece.
    """
    spark = docs.sparkSession
    pieces = materialize(tokenized_pieces(docs, path, capacity, end_id), "pieces")
    lengths = pieces.groupBy("length").agg(F.count(F.lit(1)).alias("n")).collect()  # at most ``capacity`` rows
    counts = {r["length"]: r["n"] for r in lengths}
    before: dict[int, int] = {}
    total = 0
    for length in sorted(counts):
        before[length] = total
        total += counts[length]
    plan, _ = best_fit_decreasing(counts, capacity)
    # Steps by the number of their first piece in the order of (length, rank).
    starts = plan[:, 1] + np.array([before[x] for x in plan[:, 0].tolist()], np.int64)
    order = np.argsort(starts)
    shared = spark.sparkContext.broadcast((starts[order], plan[order]))

    def place(batches: Iterator[pa.RecordBatch]) -> Iterator[pa.RecordBatch]:
        first_row, steps = shared.value
        for batch in batches:
            row = batch.column("_row").to_numpy() - 1
            at = np.searchsorted(first_row, row, "right") - 1
            step, index = steps[at], row - first_row[at]
            sequence = step[:, 2] + index // step[:, 3]
            offset = step[:, 4] + index % step[:, 3] * step[:, 0]
            columns = [batch.column(c) for c in ("doc_id", "piece", "start", "length", "ids_crc32")]
            names = ["doc_id", "piece", "start", "length", "ids_crc32", "sequence_id", "offset"]
            yield pa.RecordBatch.from_arrays([*columns, pa.array(sequence), pa.array(offset)], names)

    numbered = global_row_number(pieces, ["length", "doc_id", "piece"], name="_row")
    return numbered.mapInArrow(place, _PIECES + ", sequence_id long, offset long")


def op10_packing(spark, sf_dir: str) -> DataFrame:
    return pack(spark.read.parquet(f"{sf_dir}/documents.parquet"), public_tokenizers.path("word_bpe_49k.json"))
