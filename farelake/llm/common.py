"""Helpers of the training-data operators: partition sizing, text hashing in numpy, and the packed hash exchange.

Documents are dealt into *buckets* by a hash of their id, a few MB of text each. What buckets have to tell each
other about hashed items (anchors, n-grams, shingles) travels as sorted arrays: one row per (bucket, hash partition)
holds all its items of that partition, so a hash partition meets every item once per bucket, however often it occurs.
"""

from __future__ import annotations

import ctypes
import gc
from collections.abc import Callable, Iterator
from contextlib import contextmanager
from functools import cached_property

import numpy as np
import pyarrow as pa
from pyspark.sql import Column, DataFrame, SparkSession
from pyspark.sql import functions as F

_LEAST_BUCKETS = 64
_BUCKET_BYTES = 12 << 20

NO_ID = -(2**63)  # stands for a null doc_id where ids are compared: it sorts before every other id


def documents(spark: SparkSession, sf_dir: str) -> DataFrame:
    return spark.read.parquet(f"{sf_dir}/documents.parquet")


def plan_bytes(df: DataFrame) -> int:
    """The optimizer's estimate of a table's size; for a Parquet scan, the size of its files."""
    return int(df._jdf.queryExecution().optimizedPlan().stats().sizeInBytes())


def text_bytes(docs: DataFrame) -> int:
    """The bytes of all texts: one pass that moves nothing. A table's files say little: texts compress well."""
    return docs.agg(F.coalesce(F.sum(F.octet_length("text")), F.lit(0))).first()[0]


def bucket_count(docs: DataFrame, bytes_per_bucket: int = _BUCKET_BYTES, least: int = _LEAST_BUCKETS) -> int:
    """So many buckets that each holds about ``bytes_per_bucket`` of text (of a table without texts: of its files);
    grows with the table."""
    size = text_bytes(docs) if "text" in docs.columns else plan_bytes(docs)
    return max(least, -(-size // bytes_per_bucket))


def remainder(doc_id: Column, modulus: int) -> Column:
    """crc32 of the id written as text, modulo ``modulus``; a null id counts as the empty text."""
    return F.crc32(F.coalesce(doc_id.cast("string"), F.lit("")).cast("binary")) % F.lit(modulus)


@contextmanager
def without_cycles() -> Iterator[None]:
    """No search for reference cycles meanwhile: work that makes many small objects, but no cycles, need not wait for it.
    At its end, memory that is free goes back to the system, so that a worker does not keep it for the next stage."""
    searching = gc.isenabled()
    gc.disable()
    try:
        yield
    finally:
        if searching:
            gc.enable()
        release_memory()


def release_memory() -> None:
    """Give free memory of Arrow and of the C library back to the system, where they can."""
    pa.default_memory_pool().release_unused()
    trim = getattr(ctypes.CDLL(None), "malloc_trim", None)
    if trim is not None:
        trim(0)


_BATCH_ROWS = "spark.sql.execution.arrow.maxRecordsPerBatch"


def bounded_batches(spark: SparkSession) -> None:
    """Send texts to Python in batches of 500 rows instead of the default 10,000, which a session may overrule.

    Documents are thousands of characters long, and a batch is held several times over: by the JVM and by Python, on
    its way in and out.
    """
    if spark.conf.get(_BATCH_ROWS) == "10000":
        spark.conf.set(_BATCH_ROWS, "500")


def string_buffer(column: pa.Array | pa.ChunkedArray) -> tuple[np.ndarray, np.ndarray]:
    """The UTF-8 bytes of a text column one after the other, and the offsets of its texts (null: empty)."""
    array = column.combine_chunks() if isinstance(column, pa.ChunkedArray) else column
    if isinstance(array, pa.ChunkedArray):
        array = pa.concat_arrays(array.chunks) if array.num_chunks else pa.array([], pa.large_string())
    array = array.cast(pa.large_string())
    if array.null_count:
        array = array.fill_null("")
    if not len(array):
        return np.empty(0, np.uint8), np.zeros(1, np.int64)
    _, offsets, data = array.buffers()
    at = np.frombuffer(offsets, np.int64)[array.offset : array.offset + len(array) + 1]
    raw = np.frombuffer(data, np.uint8) if data is not None else np.empty(0, np.uint8)
    return raw[at[0] : at[-1]], at - at[0]


def mix(values: np.ndarray) -> np.ndarray:
    """A bijective finalizer of 64-bit hashes (the public splitmix64 one)."""
    values = values ^ (values >> np.uint64(30))
    values = values * np.uint64(0xBF58476D1CE4E5B9)
    values ^= values >> np.uint64(27)
    values = values * np.uint64(0x94D049BB133111EB)
    return values ^ (values >> np.uint64(31))


_BASE = 0x9E3779B97F4A7C15  # odd, so that it has an inverse modulo 2**64
_INVERSE = pow(_BASE, -1, 1 << 64)
_CHUNK = 1 << 19
_powers: tuple[np.ndarray, np.ndarray] | None = None


def _power_tables(n: int) -> tuple[np.ndarray, np.ndarray]:
    """The first ``n`` powers of the base and of its inverse."""
    global _powers
    if _powers is None or len(_powers[0]) < n:
        n = max(n, _CHUNK + 4096)
        tables = []
        for base in (_BASE, _INVERSE):
            steps = np.full(n, base, np.uint64)
            steps[0] = 1
            tables.append(np.cumprod(steps, dtype=np.uint64))
        if n > 4 * _CHUNK:
            return tables[0], tables[1]  # for one very long word; not kept
        _powers = tables[0], tables[1]
    return _powers


def segment_hashes(raw: np.ndarray, starts: np.ndarray, ends: np.ndarray, table: np.ndarray) -> np.ndarray:
    """64-bit hashes of the byte ranges [start, end) of ``raw``, which follow one another without overlap."""
    result = np.empty(len(starts), np.uint64)
    done = 0
    while done < len(starts):
        low = int(starts[done])
        upto = max(done + 1, int(np.searchsorted(ends, low + _CHUNK, "right")))
        high = int(ends[upto - 1])
        power, inverse = _power_tables(high - low + 1)
        sums = np.zeros(high - low + 1, np.uint64)
        np.cumsum(table[raw[low:high]] * power[: high - low], out=sums[1:])
        first, last = starts[done:upto] - low, ends[done:upto] - low
        result[done:upto] = (sums[last] - sums[first]) * inverse[first] + (last - first).astype(np.uint64)
        done = upto
    return mix(result)


_CODES = mix(np.arange(1, 257, dtype=np.uint64) * np.uint64(0xD1342543DE82EF95))
_LOWERED = _CODES.copy()
_LOWERED[65:91] = _CODES[97:123]
_SPACE = np.zeros(256, bool)
_SPACE[[0x20, *range(0x09, 0x0E)]] = True


class Words:
    """The words ``[^\\x20\\x09-\\x0D]+`` of a column of texts, by their 64-bit hashes."""

    def __init__(self, column, lower: bool = False):
        self.raw, self.offsets = raw, offsets = string_buffer(column)
        word = ~_SPACE[raw]
        starts, ends = word.copy(), word.copy()
        if len(raw):
            starts[1:] &= ~word[:-1]
            ends[:-1] &= ~word[1:]
            inner = offsets[(offsets > 0) & (offsets < len(raw))]
            starts[inner] = word[inner]
            ends[inner - 1] = word[inner - 1]
        self.starts = np.flatnonzero(starts)
        self.ends = np.flatnonzero(ends) + 1
        self._lower = lower
        self.at = np.searchsorted(self.starts, offsets)  # the words of text i are at[i] to at[i + 1]
        self.doc = np.repeat(np.arange(len(offsets) - 1, dtype=np.int32), np.diff(self.at))

    @cached_property
    def hashes(self) -> np.ndarray:
        return segment_hashes(self.raw, self.starts, self.ends, _LOWERED if self._lower else _CODES)

    def grams(self, n: int) -> tuple[np.ndarray, np.ndarray]:
        """For each place where ``n`` words of one text follow one another: the place, and their hash."""
        if len(self.hashes) < n:
            return np.empty(0, np.int64), np.empty(0, np.uint64)
        count = len(self.hashes) - n + 1
        places = np.flatnonzero(self.doc[:count] == self.doc[n - 1 :])
        value = self.hashes[:count].copy()
        for j in range(1, n):
            value *= np.uint64(0x9FB21C651E98DF25)
            value += self.hashes[j : j + count]
        return places, mix(value[places] + np.uint64(n))


def ids_of(column: pa.ChunkedArray) -> np.ndarray:
    """Document ids as int64, null as ``NO_ID``."""
    return column.cast(pa.int64()).fill_null(NO_ID).to_numpy()


# --- the packed exchange -----------------------------------------------------------------------------------


def partition_bounds(parts: int) -> np.ndarray:
    """Hash partition p holds the hashes from bounds[p] on, below bounds[p + 1]."""
    return np.array([(p << 64) // parts for p in range(1, parts)], np.uint64)


def pack(bucket: int, parts: int, hashes: np.ndarray, *columns: np.ndarray) -> pa.Table:
    """Rows (bucket, part, hashes, columns...) of sorted ``hashes`` and what goes with each, cut by partition."""
    cuts = np.concatenate([[0], np.searchsorted(hashes, partition_bounds(parts)), [len(hashes)]])
    full = np.flatnonzero(np.diff(cuts))
    data = {"_bucket": pa.array([bucket] * len(full), pa.int32()), "_part": pa.array(full, pa.int32())}
    for i, column in enumerate((hashes, *columns)):
        data[f"_c{i}"] = pa.array([column[cuts[p] : cuts[p + 1]].tobytes() for p in full], pa.binary())
    return pa.table(data)


def packed_schema(columns: int) -> str:
    return "_bucket int, _part int, " + ", ".join(f"_c{i} binary" for i in range(columns))


def unpack(table: pa.Table, name: str, kind: str) -> np.ndarray:
    """The values of all blobs of a column, one after the other."""
    blobs = [x for x in table.column(name).to_pylist() if x]
    return np.frombuffer(b"".join(blobs), kind)


def unpack_rows(table: pa.Table, name: str, kind: str) -> tuple[np.ndarray, np.ndarray]:
    """As ``unpack``, and for each value the row that it comes from."""
    blobs = [x or b"" for x in table.column(name).to_pylist()]
    sizes = np.array([len(x) for x in blobs], np.int64) // np.dtype(kind).itemsize
    return np.frombuffer(b"".join(blobs), kind), np.repeat(np.arange(len(blobs)), sizes)


def recurring(items: DataFrame) -> DataFrame:
    """Which of the hashes (packed with a flag: in several texts of the bucket) are in several texts at all.

    Answers every bucket with those of its own hashes, as (bucket, part, hashes).
    """

    def answer(table: pa.Table) -> pa.Table:
        hashes, row = unpack_rows(table, "_c0", "<u8")
        several = unpack(table, "_c1", "u1").astype(bool)
        distinct, inverse, counts = np.unique(hashes, return_inverse=True, return_counts=True)
        again = counts > 1
        again[inverse[several]] = True
        keep = again[inverse]
        cuts = np.searchsorted(row[keep], np.arange(table.num_rows + 1))
        kept = hashes[keep]
        blobs = [kept[a:b].tobytes() for a, b in zip(cuts[:-1], cuts[1:], strict=True)]
        found = pa.table({"_bucket": table.column("_bucket"), "_part": table.column("_part"), "_c0": pa.array(blobs, pa.binary())})
        return found.filter(pa.array(np.diff(cuts) > 0))

    return items.groupBy("_part").applyInArrow(answer, packed_schema(1))


def within(sizes: list[int], budget: int) -> list[bool]:
    """Which documents to take, in their order, so that their bytes stay within the budget.

    One that does not fit is passed over, and those of more than a hundredth of the budget wait for the others, so that
    a long one early in the order does not leave a sample of almost nothing.
    """
    taken, used = [False] * len(sizes), 0
    for i in sorted(range(len(sizes)), key=lambda i: sizes[i] > budget // 100):
        if used + sizes[i] <= budget:
            taken[i] = True
            used += sizes[i]
    return taken


def in_sorted(values: np.ndarray, among: np.ndarray) -> np.ndarray:
    """For each value, whether it is in the sorted array ``among``."""
    if not len(among):
        return np.zeros(len(values), bool)
    place = np.searchsorted(among, values)
    place[place == len(among)] = 0
    return among[place] == values


def bucketed(docs: DataFrame, buckets: int) -> DataFrame:
    """(bucket, doc_id, text, row): the documents with the number of their bucket; ``row`` holds all their columns."""
    return docs.select(
        F.pmod(F.xxhash64("doc_id", "text"), F.lit(buckets)).cast("int").alias("_bucket"),
        F.col("doc_id").cast("long").alias("_id"),
        F.col("text").alias("_text"),
        F.struct(*[F.col(f"`{c}`") for c in docs.columns]).alias("_row"),
    )


def map_batches(df: DataFrame, function: Callable[[pa.RecordBatch], pa.RecordBatch], schema) -> DataFrame:
    """Apply a function batch by batch."""

    def each(batches: Iterator[pa.RecordBatch]) -> Iterator[pa.RecordBatch]:
        for batch in batches:
            yield function(batch)

    return df.mapInArrow(each, schema)
