"""Stupid-backoff language-model scores of documents against the counts of all other documents.

The relation is (n-gram, document) joined to (n-gram, count over the corpus) and summed per document. Its rows travel
packed: a bucket of documents explodes its texts to n-grams and sends each distinct one once, with its count, to the
hash partition that holds the n-gram's row of the count table. That adds up what all buckets send, and answers every
bucket with the totals of its own n-grams, which it joins to its documents' n-grams. So counts are whole, the tables
are partitioned by hash at every size, and an n-gram that is in every document costs one entry per bucket.

Words and word pairs travel first. An n-gram of three words or more can be in another document only if the two n-grams
that it has one word less of are, so each further order sends those alone; the others have a count of 0 elsewhere.
"""

from __future__ import annotations

import numpy as np
import pyarrow as pa
import pyarrow.compute as pc
from pyspark.sql import DataFrame
from pyspark.sql import functions as F

from farelake.llm import common
from farelake.llm.common import Words, packed_schema, partition_bounds

ORDER = 3
BACKOFF = 0.4
_ALL_WORDS = np.uint64(0)  # the entry that counts words altogether

_SCORED = "doc_id long, n_words long, log_score double"


def _planes(values: np.ndarray) -> bytes:
    """The lowest bytes of all values, then the next ones, compressed: the upper ones are small or zero."""
    size = np.uint32(len(values)).tobytes()
    return size + pa.compress(values.view(np.uint8).reshape(-1, 8).T.tobytes(), codec="zstd", asbytes=True)


def _from_planes(blob: bytes) -> np.ndarray:
    size = int(np.frombuffer(blob, "<u4", 1)[0])
    raw = pa.decompress(blob[4:], decompressed_size=8 * size, codec="zstd", asbytes=True)
    return np.ascontiguousarray(np.frombuffer(raw, np.uint8).reshape(8, -1).T).view("<u8").ravel()


def _asked(bucket: int, parts: int, hashes: np.ndarray, counts: np.ndarray) -> pa.Table:
    """Rows (bucket, part, steps from one sorted hash to the next, counts)."""
    cuts = np.concatenate([[0], np.searchsorted(hashes, partition_bounds(parts)), [len(hashes)]])
    full = np.flatnonzero(np.diff(cuts))
    ranges = [slice(cuts[p], cuts[p + 1]) for p in full]
    steps = [_planes(np.diff(hashes[r], prepend=np.uint64(0))) for r in ranges]
    data = {"_bucket": pa.array([bucket] * len(full), pa.int32()), "_part": pa.array(full, pa.int32())}
    data |= {"_c0": pa.array(steps, pa.binary()), "_c1": pa.array([_planes(counts[r]) for r in ranges], pa.binary())}
    return pa.table(data)


def _added_up(table: pa.Table, level: int) -> pa.Table:
    """Answers each row of a hash partition with its n-grams' totals."""
    hashes = [np.cumsum(_from_planes(x), dtype=np.uint64) for x in table.column("_c0").to_pylist()]
    counts = np.concatenate([_from_planes(x) for x in table.column("_c1").to_pylist()]).astype(np.int64)
    distinct, inverse = np.unique(np.concatenate(hashes), return_inverse=True)
    sums = np.zeros(len(distinct), np.int64)
    np.add.at(sums, inverse, counts)
    answer = sums[inverse]
    cuts = np.cumsum([0, *map(len, hashes)]).tolist()
    blobs = [_planes(answer[a:b]) for a, b in zip(cuts[:-1], cuts[1:], strict=True)]
    columns = {"_bucket": table.column("_bucket"), "_part": table.column("_part"), "_c0": pa.array(blobs, pa.binary())}
    return pa.table(columns | {"_level": pa.array([level] * len(blobs), pa.int32())})


class _Bucket:
    """The words of a bucket's documents and, for each order, how often the others have the n-gram that ends at a word."""

    def __init__(self, column, levels: list[list[int]], answers: pa.Table | None):
        """``levels``: the orders that were asked for together, as far as there are answers."""
        self.words = Words(column)
        self.without: list[np.ndarray] = []
        self.others = np.zeros(0, np.int64)  # words of all other documents
        for level, orders in enumerate(levels):
            answer = answers.filter(pc.equal(answers.column("_level"), level)).sort_by("_part")
            totals = [_from_planes(x) for x in answer.column("_c0").to_pylist()]
            self._told(orders, np.concatenate([np.empty(0, np.uint64), *totals]).astype(np.int64))

    def _grams(self, n: int) -> tuple[np.ndarray, np.ndarray]:
        """Where the n-grams end that other documents may have, and their hashes."""
        places, hashes = self.words.grams(n)
        ends = places + n - 1
        if n > 2:
            known = self.without[n - 2] > 0
            kept = known[ends] & known[ends - 1]
            ends, hashes = ends[kept], hashes[kept]
        return ends, hashes

    def asks(self, orders: list[int]) -> tuple[np.ndarray, np.ndarray]:
        """The distinct n-grams to count, and how often the bucket has each."""
        distinct, found = np.unique(np.concatenate([self._grams(n)[1] for n in orders]), return_counts=True)
        if 1 in orders:
            distinct = np.concatenate([[_ALL_WORDS], distinct])
            found = np.concatenate([[len(self.words.hashes)], found])
        return distinct, found.astype(np.int64)

    def _told(self, orders: list[int], totals: np.ndarray) -> None:
        documents = len(self.words.at) - 1
        if 1 in orders:
            self.others = (totals[0] if len(totals) else 0) - np.diff(self.words.at)
            totals = totals[1:]
        ends, hashes = zip(*map(self._grams, orders), strict=True)
        distinct, inverse = np.unique(np.concatenate(hashes), return_inverse=True)
        if len(distinct) != len(totals):
            raise RuntimeError("the count tables do not fit the bucket's n-grams")
        sizes = np.cumsum([0, *map(len, hashes)])
        for k, end in enumerate(ends):
            gram = inverse[sizes[k] : sizes[k + 1]]
            _, own, counts = np.unique(gram * documents + self.words.doc[end], return_inverse=True, return_counts=True)
            without = np.zeros(len(self.words.hashes), np.int64)
            without[end] = totals[gram] - counts[own]
            self.without.append(without)


def score_documents(docs: DataFrame, order: int = ORDER, backoff: float = BACKOFF) -> DataFrame:
    """doc_id, n_words, log_score: the sum over a document's words of log10 S(word | up to ``order - 1`` words before).

    Counts are those of all documents but the scored one. S is count(n-gram) / count(context) for the longest n-gram
    that others have, times ``backoff`` for each word dropped from the context; a word that no other document has gets
    1 / (words of the others + 1) in place of its relative frequency. Words are ``[^\\x20\\x09-\\x0D]+``, unchanged. A null
    or empty text has no words and scores 0; rows that repeat an id are documents of their own; a null id is kept; an
    empty table gives no rows; other columns are ignored.
    """
    common.bounded_batches(docs.sparkSession)
    buckets = common.bucket_count(docs)
    parts = max(64, buckets // 4)
    texts = common.bucketed(docs.select("doc_id", "text"), buckets).select("_bucket", "_id", "_text")
    levels = [list(range(1, min(order, 2) + 1)), *([n] for n in range(3, order + 1))]

    def ask(table: pa.Table, answers: pa.Table | None, level: int) -> pa.Table:
        bucket = _Bucket(table.column("_text"), levels[:level], answers)
        return _asked(table.column("_bucket")[0].as_py(), parts, *bucket.asks(levels[level]))

    def first(table: pa.Table) -> pa.Table:
        return ask(table, None, 0)

    def further(level: int):
        return lambda table, answers: ask(table, answers, level)

    def total(level: int):
        return lambda table: _added_up(table, level)

    def score(table: pa.Table, answers: pa.Table) -> pa.Table:
        bucket = _Bucket(table.column("_text"), levels, answers)
        words, without, others = bucket.words, bucket.without, bucket.others
        value = np.zeros(len(words.hashes))
        settled = np.zeros(len(words.hashes), bool)
        in_document = np.arange(len(words.hashes)) - words.at[words.doc]
        for n in range(order - 1, -1, -1):
            here = np.flatnonzero((without[n] > 0) & ~settled)
            context = others[words.doc[here]] if n == 0 else without[n - 1][here - 1]
            dropped = np.minimum(in_document[here], order - 1) - n
            value[here] = without[n][here] / context * backoff**dropped
            settled[here] = True
        unseen = np.flatnonzero(~settled)
        value[unseen] = backoff ** np.minimum(in_document[unseen], order - 1) / (others[words.doc[unseen]] + 1)
        sums = np.bincount(words.doc, np.log10(value), table.num_rows).astype(np.float64)
        return pa.table({"doc_id": table.column("_id"), "n_words": np.diff(words.at), "log_score": sums})

    # Every answer is dealt by bucket once: the next order reads it, and so does the scoring.
    dealt = int(docs.sparkSession.conf.get("spark.sql.shuffle.partitions"))
    answers = None
    for level in range(len(levels)):
        if answers is None:
            asked = texts.groupBy("_bucket").applyInArrow(first, packed_schema(2))
        else:
            both = texts.groupBy("_bucket").cogroup(answers.groupBy("_bucket"))
            asked = both.applyInArrow(further(level), packed_schema(2))
        told = asked.groupBy("_part").applyInArrow(total(level), packed_schema(1) + ", _level int")
        told = told.repartition(dealt, "_bucket") if len(levels) > 1 else told
        answers = told if answers is None else answers.unionByName(told)
    return texts.groupBy("_bucket").cogroup(answers.groupBy("_bucket")).applyInArrow(score, _SCORED)


def op3_lm_scoring(spark, sf_dir: str) -> DataFrame:
    scored = score_documents(spark.read.parquet(f"{sf_dir}/documents.parquet"))
    return scored.select("doc_id", "n_words", F.round("log_score", 4).alias("log_score"))


def op3_lm_scoring_bigrams(spark, sf_dir: str) -> DataFrame:
    scored = score_documents(spark.read.parquet(f"{sf_dir}/documents.parquet"), order=2)
    return scored.select("doc_id", "n_words", F.round("log_score", 4).alias("log_score"))


OP3_BIGRAMS_SQL = r"""
WITH split AS (
  SELECT row_number() OVER () AS row_id, doc_id, regexp_extract_all(coalesce(text, ''), '[^ \t\n\x0B\x0C\r]+') AS ws FROM documents
), words AS (
  SELECT row_id, unnest(ws) AS w, generate_subscripts(ws, 1) AS i FROM split
), pairs AS (
  SELECT b.row_id, a.w AS u, b.w AS w, b.i FROM words b LEFT JOIN words a ON a.row_id = b.row_id AND a.i = b.i - 1
), uni AS (SELECT w, count(*) AS c FROM words GROUP BY w),
uni_own AS (SELECT row_id, w, count(*) AS c FROM words GROUP BY ALL),
bi AS (SELECT u, w, count(*) AS c FROM pairs WHERE i > 1 GROUP BY ALL),
bi_own AS (SELECT row_id, u, w, count(*) AS c FROM pairs WHERE i > 1 GROUP BY ALL),
size AS (SELECT row_id, len(ws) AS n, (SELECT count(*) FROM words) - len(ws) AS others FROM split),
scored AS (
  SELECT p.row_id, CASE
      WHEN p.i > 1 AND bi.c > bi_own.c THEN CAST(bi.c - bi_own.c AS DOUBLE) / (cu.c - cu_own.c)
      WHEN uw.c > uw_own.c THEN CAST(uw.c - uw_own.c AS DOUBLE) / s.others * CASE WHEN p.i > 1 THEN 0.4::DOUBLE ELSE 1::DOUBLE END
      ELSE CASE WHEN p.i > 1 THEN 0.4::DOUBLE ELSE 1::DOUBLE END / (s.others + 1) END AS v
  FROM pairs p
  JOIN size s ON s.row_id = p.row_id
  JOIN uni uw ON uw.w = p.w
  JOIN uni_own uw_own ON uw_own.row_id = p.row_id AND uw_own.w = p.w
  LEFT JOIN uni cu ON cu.w = p.u
  LEFT JOIN uni_own cu_own ON cu_own.row_id = p.row_id AND cu_own.w = p.u
  LEFT JOIN bi ON bi.u = p.u AND bi.w = p.w
  LEFT JOIN bi_own ON bi_own.row_id = p.row_id AND bi_own.u = p.u AND bi_own.w = p.w
)
SELECT s.doc_id, CAST(len(s.ws) AS BIGINT) AS n_words, round(coalesce(sum(log10(v)), 0), 4) AS log_score
FROM split s LEFT JOIN scored USING (row_id) GROUP BY s.row_id, s.doc_id, len(s.ws)
"""

OP3_SQL = r"""
WITH split AS (
  SELECT row_number() OVER () AS row_id, doc_id, regexp_extract_all(coalesce(text, ''), '[^ \t\n\x0B\x0C\r]+') AS ws FROM documents
), words AS (
  SELECT row_id, unnest(ws) AS w, generate_subscripts(ws, 1) AS i FROM split
), grams AS (
  SELECT c.row_id, a.w AS t, b.w AS u, c.w AS w, c.i FROM words c
  LEFT JOIN words b ON b.row_id = c.row_id AND b.i = c.i - 1
  LEFT JOIN words a ON a.row_id = c.row_id AND a.i = c.i - 2
), uni AS (SELECT w, count(*) AS c FROM words GROUP BY w),
uni_own AS (SELECT row_id, w, count(*) AS c FROM words GROUP BY ALL),
bi AS (SELECT u, w, count(*) AS c FROM grams WHERE i > 1 GROUP BY ALL),
bi_own AS (SELECT row_id, u, w, count(*) AS c FROM grams WHERE i > 1 GROUP BY ALL),
tri AS (SELECT t, u, w, count(*) AS c FROM grams WHERE i > 2 GROUP BY ALL),
tri_own AS (SELECT row_id, t, u, w, count(*) AS c FROM grams WHERE i > 2 GROUP BY ALL),
size AS (SELECT row_id, len(ws) AS n, (SELECT count(*) FROM words) - len(ws) AS others FROM split),
scored AS (
  SELECT g.row_id, CASE
      WHEN g.i > 2 AND tri.c > tri_own.c THEN CAST(tri.c - tri_own.c AS DOUBLE) / (cb.c - cb_own.c)
      WHEN g.i > 1 AND bi.c > bi_own.c THEN CAST(bi.c - bi_own.c AS DOUBLE) / (cu.c - cu_own.c) * CASE WHEN g.i > 2 THEN 0.4::DOUBLE ELSE 1::DOUBLE END
      WHEN uw.c > uw_own.c THEN CAST(uw.c - uw_own.c AS DOUBLE) / s.others * pow(0.4::DOUBLE, least(g.i - 1, 2))
      ELSE pow(0.4::DOUBLE, least(g.i - 1, 2)) / (s.others + 1) END AS v
  FROM grams g
  JOIN size s ON s.row_id = g.row_id
  JOIN uni uw ON uw.w = g.w
  JOIN uni_own uw_own ON uw_own.row_id = g.row_id AND uw_own.w = g.w
  LEFT JOIN uni cu ON cu.w = g.u
  LEFT JOIN uni_own cu_own ON cu_own.row_id = g.row_id AND cu_own.w = g.u
  LEFT JOIN bi ON bi.u = g.u AND bi.w = g.w
  LEFT JOIN bi_own ON bi_own.row_id = g.row_id AND bi_own.u = g.u AND bi_own.w = g.w
  LEFT JOIN bi cb ON cb.u = g.t AND cb.w = g.u
  LEFT JOIN bi_own cb_own ON cb_own.row_id = g.row_id AND cb_own.u = g.t AND cb_own.w = g.u
  LEFT JOIN tri ON tri.t = g.t AND tri.u = g.u AND tri.w = g.w
  LEFT JOIN tri_own ON tri_own.row_id = g.row_id AND tri_own.t = g.t AND tri_own.u = g.u AND tri_own.w = g.w
)
SELECT s.doc_id, CAST(len(s.ws) AS BIGINT) AS n_words, round(coalesce(sum(log10(v)), 0), 4) AS log_score
FROM split s LEFT JOIN scored USING (row_id) GROUP BY s.row_id, s.doc_id, len(s.ws)
"""
