"""Document fingerprints from Lempel-Ziv phrases.

A text is parsed into dictionary phrases (LZ78: each phrase is the longest one seen before and one byte more), so texts
that compress alike share phrases. The set of phrases is hashed, and a minimum-hash signature of one permutation, cut
into ``SLOTS`` slots, stands for it; the share of equal slots estimates the Jaccard likeness of two phrase sets.
"""

from __future__ import annotations

import math
from collections.abc import Iterator
from hashlib import sha256

import numpy as np
import pyarrow as pa
from pyspark.sql import Column, DataFrame
from pyspark.sql import functions as F

from farelake.llm.common import _CODES, bounded_batches, bucket_count, mix, segment_hashes

SLOTS = 64
_EMPTY = np.uint64(2**64 - 1)


class Parser:
    """An LZ78 parse that can be continued in several ways from the same place."""

    def __init__(self):
        self.children: dict[int, int] = {}  # (phrase << 8 | byte) -> phrase; phrase 0 is the empty one
        self.node = 0
        self.cuts: list[int] = []  # ends of the phrases
        self.length = 0

    def feed(self, data: bytes) -> None:
        children, node, cuts = self.children, self.node, self.cuts
        get = children.get
        for place, byte in enumerate(data, self.length + 1):
            key = node << 8 | byte
            found = get(key)
            if found is None:
                children[key] = len(children) + 1
                cuts.append(place)
                node = 0
            else:
                node = found
        self.node, self.length = node, self.length + len(data)

    def mark(self) -> tuple[int, int, int]:
        return len(self.cuts), self.node, self.length

    def back_to(self, mark: tuple[int, int, int]) -> None:
        """Forget what was fed after the mark."""
        phrases, self.node, self.length = mark
        while len(self.children) > phrases:
            self.children.popitem()  # the last added first
        del self.cuts[phrases:]

    def phrase_hashes(self, data: bytes) -> np.ndarray:
        """Distinct phrases of the parsed ``data``; what is left at its end counts as one."""
        ends = np.array(self.cuts + ([self.length] if self.node else []), np.int64)
        starts = np.concatenate([np.zeros(min(1, len(ends)), np.int64), ends[:-1]])
        return np.unique(segment_hashes(np.frombuffer(data, np.uint8), starts, ends, _CODES))


def signature(phrases: np.ndarray) -> np.ndarray:
    """The smallest hash of each slot; an empty slot borrows from the next full one, by a hash of the distance."""
    slots = np.full(SLOTS, _EMPTY, np.uint64)
    if not len(phrases):
        return slots
    slot = (phrases >> np.uint64(58)).astype(np.int64)  # sorted, as the phrases are
    first = np.flatnonzero(np.diff(slot, prepend=-1))
    slots[slot[first]] = phrases[first]
    full = np.zeros(SLOTS, bool)
    full[slot[first]] = True
    if not full.all():
        places = np.flatnonzero(full)
        empty = np.flatnonzero(~full)
        ahead = np.searchsorted(places, empty)
        donor = places[ahead % len(places)]
        distance = ((donor - empty) % SLOTS).astype(np.uint64)
        slots[empty] = mix(slots[donor] + distance * np.uint64(0x9E3779B97F4A7C15))
    return slots


def _written(slots: np.ndarray) -> str:
    return (mix(slots) & np.uint64(0xFFFF)).astype(">u2").tobytes().hex()


def likeness(a: str, b: str) -> float:
    """The share of equal slots of two fingerprints."""
    return sum(a[i : i + 4] == b[i : i + 4] for i in range(0, 4 * SLOTS, 4)) / SLOTS


def fingerprint(text: str | None) -> str:
    """``SLOTS`` numbers of 16 bits in hexadecimal; equal texts have equal fingerprints, the empty text its own."""
    return fingerprints(text or "", None)[0]


def fingerprints(text: str, edited_tail: tuple[int, str] | None) -> tuple[str, str | None]:
    """Of a text, and of the text whose characters from a place on are replaced; what they share is parsed once."""
    parser = Parser()
    kept = text if edited_tail is None else text[: edited_tail[0]]
    shared = kept.encode()
    parser.feed(shared)
    mark = parser.mark()
    tail = text[len(kept) :].encode()
    parser.feed(tail)
    own = _written(signature(parser.phrase_hashes(shared + tail)))
    if edited_tail is None:
        return own, None
    other = edited_tail[1].encode()
    if other == tail:
        return own, own
    parser.back_to(mark)
    parser.feed(other)
    return own, _written(signature(parser.phrase_hashes(shared + other)))


_COMPARED = (
    "doc_id long, n_chars long, edited_sha256 string, fingerprint string, edited_fingerprint string, "
    "near_edited double, near_next double"
)


def _range_of(value: Column, cuts: list[int]) -> Column:
    """How many of the sorted cuts are at most the value; found in two steps of about the root of their number."""
    if not cuts:
        return F.lit(0)
    step = math.isqrt(len(cuts)) + 1

    def upto(bounds: Column) -> Column:
        return F.size(F.filter(bounds, lambda c: c <= value))

    def literal(values: list[int]) -> Column:
        return F.array(*[F.lit(v).cast("long") for v in values]) if values else F.array().cast("array<long>")

    whole = upto(literal(cuts[step - 1 :: step])) * step
    return F.when(value.isNull(), 0).otherwise(whole + upto(F.slice(literal(cuts), whole + 1, step)))


def in_order(docs: DataFrame) -> DataFrame:
    """(_part, doc_id, text, _ahead): ranges of ascending doc_id, each with a copy of the document that comes next.

    The ranges hold about as many documents each. A null id comes first. The copy (``_ahead``) of a range's last
    successor is that of the first document of the next range, and of the very first for the last. Only the ids
    of the ranges' first documents come to the driver.
    """
    spark = docs.sparkSession
    rows = docs.select(F.col("doc_id").cast("long").alias("doc_id"), F.coalesce("text", F.lit("")).alias("text"))
    parts = bucket_count(docs)
    share = [i / parts for i in range(1, parts)]
    cuts = rows.agg(F.percentile_approx("doc_id", share, 10 * parts)).first()[0] or []
    cuts = sorted(set(cuts))  # one value for each range
    part = _range_of(F.col("doc_id"), cuts)
    heads = rows.select(part.alias("part"), "doc_id").groupBy("part").agg(F.min(F.coalesce("doc_id", F.lit(-(2**63)))).alias("id"))
    first = sorted((r["part"], r["id"]) for r in heads.collect())  # one row for each range
    ahead = {part_id: first[i - 1][0] for i, (_, part_id) in enumerate(first)}  # its copy goes to the range before
    dealt = rows.withColumn("_part", part)
    if not ahead:
        return dealt.withColumn("_ahead", F.lit(False))
    table = spark.createDataFrame([(k, v) for k, v in ahead.items()], "_head long, _before int")
    joined = dealt.join(F.broadcast(table), F.coalesce("doc_id", F.lit(-(2**63))) == F.col("_head"), "left")
    own = F.struct(F.col("_part").alias("_part"), F.lit(False).alias("_ahead"))
    copy = F.struct(F.col("_before").alias("_part"), F.lit(True).alias("_ahead"))
    places = F.filter(F.array(own, F.when(F.col("_before").isNotNull(), copy)), lambda x: x.isNotNull())
    return joined.select("doc_id", "text", F.explode(places).alias("_p")).select("_p._part", "doc_id", "text", "_p._ahead")


def compare_edited(docs: DataFrame) -> DataFrame:
    """Fingerprint every text and its edited text (its last quarter replaced by the start of the next document).

    Returns doc_id, n_chars, edited_sha256, fingerprint, edited_fingerprint, near_edited, near_next. A null text is the
    empty one; a null doc_id comes first; rows of equal doc_id follow one another in the order of their texts; a single
    document is its own next; an empty table gives no rows; other columns are ignored.
    """
    bounded_batches(docs.sparkSession)
    parts = bucket_count(docs)
    dealt = in_order(docs).repartition(parts, "_part").sortWithinPartitions("_part", "_ahead", "doc_id", "text")

    def each(batches: Iterator[pa.RecordBatch]) -> Iterator[pa.RecordBatch]:
        held: tuple | None = None  # the document whose successor is awaited
        waiting: tuple | None = None  # the result before it, which lacks only the likeness to it
        out: list[tuple] = []
        for batch in batches:
            for part, doc_id, text, ahead in zip(*[batch.column(c).to_pylist() for c in _DEALT], strict=True):
                if held is not None and held[0] == part:
                    result = _edited(held[1], held[2], text)
                    if waiting is not None:
                        out.append((*waiting, likeness(waiting[3], result[3])))
                    waiting = result
                    if ahead:
                        out.append((*waiting, likeness(waiting[3], fingerprint(text))))
                        waiting = None
                held = None if ahead else (part, doc_id, text)
                if len(out) >= 256:
                    yield _batch(out)
                    out = []
        if out:
            yield _batch(out)

    return dealt.select(*_DEALT).mapInArrow(each, _COMPARED)


_DEALT = ("_part", "doc_id", "text", "_ahead")


def _edited(doc_id: int | None, text: str, following: str) -> tuple:
    """All columns but the last."""
    kept = len(text) - len(text) // 4
    tail = following[: len(text) // 4]
    own, edited = fingerprints(text, (kept, tail))
    digest = sha256((text[:kept] + tail).encode()).hexdigest()
    return doc_id, len(text), digest, own, edited, likeness(own, edited)


def _batch(rows: list[tuple]) -> pa.RecordBatch:
    kinds = [pa.int64(), pa.int64(), pa.string(), pa.string(), pa.string(), pa.float64(), pa.float64()]
    names = ["doc_id", "n_chars", "edited_sha256", "fingerprint", "edited_fingerprint", "near_edited", "near_next"]
    return pa.RecordBatch.from_arrays([pa.array([r[i] for r in rows], k) for i, k in enumerate(kinds)], names)


def op4_fingerprints(spark, sf_dir: str) -> DataFrame:
    return compare_edited(spark.read.parquet(f"{sf_dir}/documents.parquet"))
