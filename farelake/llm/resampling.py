"""Importance resampling of documents towards a target distribution of hashed word features.

Features of a text are its words and its pairs of neighbouring words; a feature's bucket is the CRC-32 of its bytes,
modulo a fixed number of buckets. How often each bucket occurs in the corpus and in the target texts gives the gain of a
feature; the mean gain of a document's features is its weight, and the documents with the highest weights plus a Gumbel
noise, drawn from their id, are a sample in proportion to the weights, without replacement.

Buckets are computed for a slice of texts at a time. Its words are written one after the other, a space after each, so
that every feature is a stretch of bytes. Features of equal length are the rows of a uint8 matrix; the distinct rows are
found, their CRCs are updated column by column, and the buckets are scattered back to all occurrences.
"""

from __future__ import annotations

import math
from collections.abc import Iterator
from zlib import crc32

import numpy as np
import pandas as pd
import pyarrow as pa
import pyarrow.compute as pc
from pyspark.sql import Column, DataFrame
from pyspark.sql import functions as F

from farelake.llm.common import bounded_batches, documents, mix, string_buffer
from farelake.operators.numbering import global_row_number
from farelake.session import materialize

BUCKETS = 10_000
LEAST_WORDS = 20
DRAWN_PERCENT = 25
SEED = 7

_SLICE_BYTES = 2 << 20
_MATRIX_BYTES = 4 << 20
#: Longer features are too rare to fill a matrix; each takes one call.
_LONGEST_IN_MATRIX = 64
_SPACE = 0x20


def _crc_table() -> np.ndarray:
    """What one byte does to a CRC-32 (the reflected polynomial of zlib)."""
    table = np.arange(256, dtype=np.uint32)
    for _ in range(8):
        table = np.where(table & 1, (table >> 1) ^ np.uint32(0xEDB88320), table >> 1).astype(np.uint32)
    return table


_CRC = _crc_table()
_IN_WORD = np.zeros(256, bool)
_IN_WORD[[*range(0x30, 0x3A), *range(0x61, 0x7B), *range(0x80, 0x100)]] = True
_LOWER = np.arange(256, dtype=np.uint8)
_LOWER[0x41:0x5B] += 0x20


def _matrix_crcs(matrix: np.ndarray) -> np.ndarray:
    """The CRC-32 of each row, all rows updated together column by column."""
    crc = np.full(len(matrix), 0xFFFFFFFF, np.uint32)
    for column in np.ascontiguousarray(matrix.T):
        crc = _CRC[(crc ^ column) & 0xFF] ^ (crc >> np.uint32(8))
    return ~crc


def _distinct(matrix: np.ndarray) -> tuple[np.ndarray, np.ndarray]:
    """Rows that stand for all, and for each row which of them it equals.

    Rows meet by a 64-bit key, which for up to eight bytes is the row itself. A longer row whose key is that of another
    one by chance stands for itself.
    """
    rows, length = matrix.shape
    padded = np.zeros((rows, -(-length // 8) * 8), np.uint8)
    padded[:, :length] = matrix
    parts = padded.view("<u8")
    key = parts[:, 0]
    for i in range(1, parts.shape[1]):
        key = mix(key) + parts[:, i]
    code, values = pd.factorize(key)
    first = np.empty(len(values), np.int64)
    first[code[::-1]] = np.arange(rows - 1, -1, -1)
    if parts.shape[1] > 1:
        odd = np.flatnonzero((parts != parts[first[code]]).any(axis=1))
        if len(odd):
            code[odd] = len(first) + np.arange(len(odd))
            first = np.concatenate([first, odd])
    return first, code


def range_crcs(raw: np.ndarray, starts: np.ndarray, ends: np.ndarray) -> np.ndarray:
    """The CRC-32 of each byte range [start, end) of ``raw``."""
    result = np.empty(len(starts), np.uint32)
    lengths = ends - starts
    order = np.argsort(lengths, kind="stable")
    sizes, at = np.unique(lengths[order], return_index=True)
    for length, low, high in zip(sizes.tolist(), at, [*at[1:], len(order)], strict=True):
        if length > _LONGEST_IN_MATRIX:
            for i in order[low:high].tolist():
                result[i] = crc32(raw[starts[i] : ends[i]])
            continue
        step = max(1, _MATRIX_BYTES // max(length, 1))
        for part in range(low, high, step):
            mine = order[part : min(part + step, high)]
            matrix = raw[starts[mine][:, None] + np.arange(length)]
            first, code = _distinct(matrix)
            result[mine] = _matrix_crcs(matrix[first])[code]
    return result


def _words(texts: pa.Array) -> tuple[np.ndarray, np.ndarray, np.ndarray, np.ndarray]:
    """The lower-cased words of the texts with a space after each, where they start and end, and the first word of
    each text (and the end of the last)."""
    raw, offsets = string_buffer(texts)
    raw = _LOWER[raw]
    inside = _IN_WORD[raw]
    starts, ends = inside.copy(), inside.copy()  # at the first and at the last byte of each word
    if len(raw):
        starts[1:] &= ~inside[:-1]
        ends[:-1] &= ~inside[1:]
        inner = offsets[(offsets > 0) & (offsets < len(raw))]
        starts[inner] = inside[inner]
        ends[inner - 1] = inside[inner - 1]
    begin, stop = np.flatnonzero(starts), np.flatnonzero(ends) + 1
    lengths = stop - begin
    end = np.cumsum(lengths + 1) - 1
    # The bytes of the words in order, with a gap of one after each.
    line = np.full(int(end[-1]) + 1 if len(end) else 0, _SPACE, np.uint8)
    place = np.ones(len(line), bool)
    place[end] = False
    line[place] = raw[inside]
    return line, end - lengths, end, np.searchsorted(begin, offsets)


def text_buckets(texts: pa.Array, buckets: int) -> tuple[np.ndarray, np.ndarray, np.ndarray]:
    """The buckets of all features of the texts, the text of each feature, and the number of words of each text."""
    line, starts, ends, at = _words(texts)
    owner = np.repeat(np.arange(len(at) - 1), np.diff(at))
    pair = np.flatnonzero(owner[:-1] == owner[1:])
    crcs = range_crcs(line, np.concatenate([starts, starts[pair]]), np.concatenate([ends, ends[pair + 1]]))
    return crcs % np.uint32(buckets), np.concatenate([owner, owner[pair]]), np.diff(at)


def _slices(texts: pa.Array) -> Iterator[tuple[int, int]]:
    """Stretches (first, number) of at most 2 MB of text, or one text."""
    ends = np.cumsum(pc.fill_null(pc.binary_length(texts), 0).to_numpy().astype(np.int64))
    at = 0
    while at < len(texts):
        low = int(ends[at - 1]) if at else 0
        upto = max(at + 1, int(np.searchsorted(ends, low + _SLICE_BYTES, "right")))
        yield at, upto - at
        at = upto


def bucket_counts(texts: DataFrame, buckets: int = BUCKETS) -> np.ndarray:
    """How many features of the column ``text`` are in each bucket. Each task adds up its own; the driver gets one
    number per bucket."""

    def each(batches: Iterator[pa.RecordBatch]) -> Iterator[pa.RecordBatch]:
        total = np.zeros(buckets, np.int64)
        for batch in batches:
            column = batch.column(0)
            for at, n in _slices(column):
                total += np.bincount(text_buckets(column.slice(at, n), buckets)[0], minlength=buckets)
        full = np.flatnonzero(total)
        yield pa.RecordBatch.from_arrays([pa.array(full, pa.int64()), pa.array(total[full])], ["bucket", "n"])

    bounded_batches(texts.sparkSession)
    parts = texts.select("text").mapInArrow(each, "bucket long, n long")
    counts = np.zeros(buckets, np.int64)
    for row in parts.groupBy("bucket").agg(F.sum("n").alias("n")).collect():
        counts[row["bucket"]] = row["n"]
    return counts


def bucket_gains(corpus: np.ndarray, target: np.ndarray) -> np.ndarray:
    """Thousandths of the logarithm of how much likelier a bucket is in the target, with add-one smoothing."""
    buckets = len(corpus)
    s_all, t_all = float(corpus.sum() + buckets), float(target.sum() + buckets)
    pairs = zip(corpus.tolist(), target.tolist(), strict=True)
    gains = [math.floor(1000 * math.log((t + 1.0) * s_all / ((s + 1.0) * t_all))) for s, t in pairs]
    return np.array(gains, np.int64)


def weigh(docs: DataFrame, gains: np.ndarray) -> DataFrame:
    """doc_id, n_words, n_features and weight: the floored mean of the gains of a document's features (none: 0)."""
    shared = docs.sparkSession.sparkContext.broadcast(gains)  # one number per bucket

    def each(batches: Iterator[pa.RecordBatch]) -> Iterator[pa.RecordBatch]:
        table = shared.value
        for batch in batches:
            texts, ids = batch.column("text"), batch.column("doc_id")
            for at, n in _slices(texts):
                bucket, owner, words = text_buckets(texts.slice(at, n), len(table))
                features = np.bincount(owner, minlength=n)
                sums = np.zeros(n, np.int64)
                np.add.at(sums, owner, table[bucket])
                weight = np.floor_divide(sums, np.maximum(features, 1))
                columns = [ids.slice(at, n), *(pa.array(x, pa.int64()) for x in (words, features, weight))]
                yield pa.RecordBatch.from_arrays(columns, names)

    bounded_batches(docs.sparkSession)
    names = ["doc_id", "n_words", "n_features", "weight"]
    narrow = docs.select(F.col("doc_id").cast("long").alias("doc_id"), F.col("text").alias("text"))
    return narrow.mapInArrow(each, "doc_id long, n_words long, n_features long, weight long")


def gumbel(doc_id: Column, seed: int) -> Column:
    """A document's noise in thousandths, from the first eight hex digits of sha256 of ``seed:doc_id``."""
    digest = F.sha2(F.concat(F.lit(f"{seed}:"), F.coalesce(doc_id.cast("string"), F.lit(""))), 256)
    h = F.conv(F.substring(digest, 1, 8), 16, 10).cast("double")
    return F.floor(-1000 * F.log(-F.log((h + 0.5) / 4294967296.0))).cast("long")


def resample(
    docs: DataFrame,
    target: DataFrame,
    buckets: int = BUCKETS,
    least_words: int = LEAST_WORDS,
    percent: int = DRAWN_PERCENT,
    seed: int = SEED,
) -> DataFrame:
    """doc_id, n_words, n_features, weight, score and rank of every document; ``rank`` is 1, 2, ... for those drawn.

    Of the documents with at least ``least_words`` words, ``percent`` of a hundred (floored) are drawn, those with the
    highest scores; ties go to the smaller id (a null id is the smallest), and rows that agree in all that is returned
    are interchangeable. A null or empty text, or one without a word, has no feature, weight 0, and is not drawn. Words
    may be as long as the text. Repeated rows are counted and ranked one by one; with an empty target table every count
    there is 0; an empty ``docs`` gives no rows. Columns other than ``doc_id`` and ``text`` are ignored.

    Two passes over the texts; between them only one number per bucket is kept. The ranking range-partitions narrow
    rows, so that no task sorts all of them.
    """
    gains = bucket_gains(bucket_counts(docs, buckets), bucket_counts(target, buckets))
    score = F.col("weight") + gumbel(F.col("doc_id"), seed)
    scored = materialize(weigh(docs, gains).withColumn("score", score), "weights")
    able = F.col("n_words") >= least_words
    drawn = percent * scored.where(able).count() // 100
    keyed = scored.withColumns({"_after": (~able).cast("int"), "_down": -F.col("score")})
    ranked = global_row_number(keyed, ["_after", "_down", "doc_id"], name="_rank")
    return ranked.select(*scored.columns, F.when(F.col("_rank") <= drawn, F.col("_rank")).alias("rank"))


def op12_resampling(spark, sf_dir: str) -> DataFrame:
    benchmark = spark.read.parquet(f"{sf_dir}/benchmark.parquet")
    drawn = resample(documents(spark, sf_dir), benchmark)
    return drawn.select("doc_id", "n_features", "weight", "score", "rank")


#: The CRC table by the rule above, and a fold over the bytes of each distinct feature.
OP12_SQL = r"""
with recursive steps(i, c, k) as (
    select i, i::bigint, 0 from range(256) t(i)
    union all
    select i, case when c & 1 = 1 then xor(c >> 1, 3988292384) else c >> 1 end, k + 1 from steps where k < 8),
crc_table as (select list(c order by i) as crc from steps where k = 8),
texts as (
    select 0 as kind, doc_id, text from documents
    union all
    select 1, item_id, text from benchmark),
split as (
    select kind, doc_id, regexp_extract_all(
        translate(coalesce(text, ''), 'ABCDEFGHIJKLMNOPQRSTUVWXYZ', 'abcdefghijklmnopqrstuvwxyz'),
        '[^\x00-\x2F\x3A-\x60\x7B-\x7F]+') as words
    from texts),
features as (
    select kind, doc_id, unnest(words || list_transform(range(1, len(words)), lambda i: words[i] || ' ' || words[i + 1]))
           as feature
    from split),
bytes as (
    select feature, list_transform(range(0, octet_length(encode(feature))),
        lambda i: ('0x' || hex(encode(feature))[2 * i + 1:2 * i + 2])::bigint) as b
    from (select distinct feature from features)),
crcs as (
    select feature, xor(list_reduce([4294967295::bigint] || b,
        lambda c, x: xor(crc[(xor(c, x) & 255) + 1], c >> 8)), 4294967295) % 10000 as bucket
    from bytes, crc_table),
counts as (
    select bucket, count(*) filter (kind = 0) as s, count(*) filter (kind = 1) as t
    from features join crcs using (feature) group by bucket),
totals as (select sum(s)::bigint as s_all, sum(t)::bigint as t_all from counts),
gains as (
    select bucket, floor(1000 * ln((t + 1)::double * (s_all + 10000)::double / ((s + 1)::double * (t_all + 10000)::double)))
           ::bigint as gain
    from counts, totals),
summed as (
    select doc_id, count(*) as n, sum(gain) as total
    from features join crcs using (feature) join gains using (bucket) where kind = 0 group by doc_id),
weighed as (
    select doc_id, len(words) as n_words, coalesce(n, 0) as n_features,
           coalesce(floor(total::double / n), 0)::bigint as weight,
           coalesce(floor(total::double / n), 0)::bigint
               + floor(-1000 * ln(-ln((('0x' || sha256('7:' || doc_id)[1:8])::bigint + 0.5::double) / 4294967296)))::bigint
               as score
    from split left join summed using (doc_id) where kind = 0),
ranked as (
    select *, row_number() over (partition by n_words >= 20 order by score desc, doc_id) as place,
           25 * count(*) over (partition by n_words >= 20) // 100 as drawn
    from weighed)
select doc_id, n_features::bigint as n_features, weight, score,
       case when n_words >= 20 and place <= drawn then place end as rank
from ranked"""
