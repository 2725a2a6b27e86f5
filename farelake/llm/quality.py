"""Document quality by a small byte-level convolutional network in numpy.

The input is the bytes of a text, each with one bit more: whether its word equals the word before. Learned filters
over ``WIDTH`` neighbouring symbols are rectified and averaged over overlapping chunks that cover the whole document,
the chunks are max-pooled, and the pooled filters are combined into one probability. Memory is bounded: however long
a text is, it is worked off in slices.

The network is fitted on a bounded sample of labelled rows: the first ``SAMPLE_DOCUMENTS`` in the order of a hash of
their id that are in the table, without those that overflow ``SAMPLE_BYTES``. Scoring reads every whole text.
"""

from __future__ import annotations

import pickle
from collections.abc import Iterator

import numpy as np
import pyarrow as pa
import pyarrow.compute as pc
from pyspark.sql import DataFrame
from pyspark.sql import functions as F
from pyspark.sql import types as T

from farelake.llm.common import Words, bounded_batches, remainder, within

SAMPLE_DOCUMENTS = 3000
SAMPLE_BYTES = 16 << 20
FILTERS = 16
WIDTH = 4
_HALF = 64  # bytes; a chunk is two halves, and the next chunk starts one half later
_PAD = 512
_SLICE = 1024  # halves worked off at once
_EPOCHS = 14
_LEAST_STEPS = 500  # a small sample is gone through more often
_BATCH = 48
_RATE = 0.02


class _Symbols:
    """The texts of a column as symbols, each padded to whole halves."""

    def __init__(self, column):
        words = Words(column)
        repeated = np.zeros(len(words.hashes), bool)
        repeated[1:] = (words.hashes[1:] == words.hashes[:-1]) & (words.doc[1:] == words.doc[:-1])
        change = np.zeros(len(words.raw) + 1, np.int8)
        change[words.starts[repeated]] += 1
        change[words.ends[repeated]] -= 1
        codes = words.raw.astype(np.int16) + 256 * np.cumsum(change[:-1], dtype=np.int16)
        sizes = np.diff(words.offsets)
        self.halves = np.where(sizes > 0, (sizes + WIDTH - 1 + _HALF - 1) // _HALF, 0)
        self.first = np.concatenate([[0], np.cumsum(self.halves)])
        self.codes = np.full(self.first[-1] * _HALF + WIDTH, _PAD, np.int16)
        shift = np.repeat(self.first[:-1] * _HALF - words.offsets[:-1], sizes)
        self.codes[np.arange(len(codes)) + shift] = codes


class Network:
    def __init__(self, seed: int = 7):
        draw = np.random.default_rng(seed)
        self.table = draw.normal(0, 0.5, (WIDTH, _PAD + 1, FILTERS)).astype(np.float32)
        self.shift = np.full(FILTERS, 0.1, np.float32)
        self.weight = draw.normal(0, 0.5, FILTERS).astype(np.float32)
        self.bias = np.zeros(1, np.float32)
        self.learned = False

    def _activations(self, codes: np.ndarray) -> np.ndarray:
        """Rectified filters at all places but the last ``WIDTH - 1``."""
        n = len(codes) - WIDTH + 1
        total = self.table[0][codes[:n]] + self.shift
        for k in range(1, WIDTH):
            total += self.table[k][codes[k : k + n]]
        return np.maximum(total, 0, out=total)

    def chunks(self, symbols: _Symbols) -> tuple[np.ndarray, np.ndarray]:
        """Mean activation of each chunk, that of half i being the one that starts there; and the bytes of each."""
        count = int(symbols.first[-1])
        sums, sizes = np.empty((count, FILTERS), np.float32), np.empty(count, np.float32)
        for low in range(0, count, _SLICE):
            high = min(low + _SLICE, count)
            codes = symbols.codes[low * _HALF : high * _HALF + WIDTH - 1]
            real = codes[: (high - low) * _HALF] != _PAD
            active = self._activations(codes)
            active[~real] = 0
            sums[low:high] = active.reshape(-1, _HALF, FILTERS).sum(axis=1)
            sizes[low:high] = real.reshape(-1, _HALF).sum(axis=1)
        last = np.zeros(count + 1, bool)
        last[symbols.first[1:] - 1] = True  # the last half of a text has no half after it
        follows = ~last[: count - 1]
        both, bytes_ = sums.copy(), sizes.copy()
        both[:-1][follows] += sums[1:][follows]
        bytes_[:-1][follows] += sizes[1:][follows]
        return both / np.maximum(bytes_, 1)[:, None], bytes_

    def pooled(self, symbols: _Symbols) -> tuple[np.ndarray, np.ndarray, np.ndarray]:
        """The largest chunk of each text and filter (0 without any), the chunks themselves and their bytes."""
        means, sizes = self.chunks(symbols)
        result = np.zeros((len(symbols.halves), FILTERS), np.float32)
        full = np.flatnonzero(symbols.halves)
        if len(full):
            result[full] = np.maximum.reduceat(means, symbols.first[:-1][full], axis=0)
        return result, means, sizes

    def probability(self, pooled: np.ndarray) -> np.ndarray:
        return 1 / (1 + np.exp(-np.clip(pooled @ self.weight + self.bias, -30, 30).astype(np.float64)))

    def fit(self, texts: list[str], labels: np.ndarray) -> None:
        """Minimise the log-loss with Adam; gradients flow through the chunk that won the pooling."""
        self.learned = True
        draw = np.random.default_rng(11)
        parameters = [self.table, self.shift, self.weight, self.bias]
        first, second, step = [np.zeros_like(p) for p in parameters], [np.zeros_like(p) for p in parameters], 0
        batches = []
        order = np.argsort([len(t) for t in texts], kind="stable")  # batches of like sizes
        for at in range(0, len(order), _BATCH):
            rows = order[at : at + _BATCH]
            batches.append((_Symbols(pa.array([texts[i] for i in rows], pa.large_string())), labels[rows]))
        epochs = max(_EPOCHS, -(-_LEAST_STEPS // len(batches)))
        for epoch in range(epochs):
            rate = _RATE * (1 if epoch < 0.7 * epochs else 0.2)
            for i in draw.permutation(len(batches)):
                gradients = self._gradients(*batches[i])
                step += 1
                for p, g, m, v in zip(parameters, gradients, first, second, strict=True):
                    m += 0.1 * (g - m)
                    v += 0.001 * (g * g - v)
                    p -= rate * (m / (1 - 0.9**step)) / (np.sqrt(v / (1 - 0.999**step)) + 1e-8)

    def _gradients(self, symbols: _Symbols, labels: np.ndarray) -> list[np.ndarray]:
        pooled, means, sizes = self.pooled(symbols)
        error = ((self.probability(pooled) - labels) / len(labels)).astype(np.float32)
        table = np.zeros(self.table.size, np.float64)
        shift = np.zeros(FILTERS)
        for d in np.flatnonzero(symbols.halves):
            low, high = symbols.first[d], symbols.first[d + 1]
            winners = low + means[low:high].argmax(axis=0)
            for chunk in np.unique(winners):
                mine = np.flatnonzero(winners == chunk)
                start, end = chunk * _HALF, min(chunk + 2, high) * _HALF
                codes = symbols.codes[start : end + WIDTH - 1]
                active = self._activations(codes)[:, mine] > 0
                active &= (codes[: end - start] != _PAD)[:, None]
                flow = active * (error[d] * self.weight[mine] / max(sizes[chunk], 1))
                shift[mine] += flow.sum(axis=0)
                for k in range(WIDTH):
                    cell = (k * (_PAD + 1) + codes[k : k + end - start].astype(np.int64))[:, None] * FILTERS + mine
                    np.add.at(table, cell.ravel(), flow.ravel())
        return [table.reshape(self.table.shape).astype(np.float32), shift.astype(np.float32), pooled.T @ error, error.sum(keepdims=True)]


def learn(docs: DataFrame, labels: DataFrame, learnable) -> Network:
    """Fit on the rows of ``docs`` (doc_id, text) that ``labels`` (doc_id, quality) marks and ``learnable`` admits."""
    spark = docs.sparkSession
    marked = labels.where(F.col("quality").isNotNull()).groupBy(F.col("doc_id").alias("id")).agg(F.max("quality").alias("quality"))
    marked = marked.where(learnable(F.col("id")) & F.col("id").isNotNull())
    # The sample is of labelled documents that are there; rows that repeat an id are taken or left together.
    there = docs.select(F.col("doc_id").alias("id"), F.coalesce(F.octet_length("text"), F.lit(0)).alias("n"))
    there = there.where(learnable(F.col("id")) & F.col("id").isNotNull()).groupBy("id").agg(F.sum("n").alias("n"))
    chosen = marked.join(there, "id").orderBy(F.xxhash64("id"), "id").limit(SAMPLE_DOCUMENTS).collect()  # bounded by the parameter
    chosen = [r for r, taken in zip(chosen, within([r["n"] for r in chosen], SAMPLE_BYTES), strict=True) if taken]
    if not chosen:
        return Network()
    ids = spark.createDataFrame([(r["id"], int(r["quality"])) for r in chosen], "id long, quality int")
    sample = docs.join(F.broadcast(ids), F.col("doc_id") == F.col("id")).select("id", "quality", F.coalesce("text", F.lit("")).alias("text"))

    def fit(table: pa.Table) -> pa.Table:
        network = Network()
        order = np.argsort(table.column("id").to_numpy(), kind="stable")
        texts, marks = table.column("text").to_pylist(), table.column("quality").to_numpy()
        network.fit([texts[i] for i in order], marks[order].astype(np.float32))
        return pa.table({"network": pa.array([pickle.dumps(network)], pa.binary())})

    rows = sample.withColumn("one", F.lit(1)).groupBy("one").applyInArrow(fit, "network binary").collect()
    return pickle.loads(rows[0]["network"]) if rows else Network()


def score(docs: DataFrame, network: Network) -> DataFrame:
    """The documents' columns in ``_row``, and ``score``: the probability of label 1.

    A null or empty text has no chunk and gets the network's constant; repeated rows are scored one by one; an empty
    table gives no rows. Without labels the network is the untrained one.
    """
    shared = docs.sparkSession.sparkContext.broadcast(network)
    bounded_batches(docs.sparkSession)
    given = docs.select(F.struct(*[F.col(f"`{c}`") for c in docs.columns]).alias("_row"))
    place = docs.columns.index("text")

    def each(batches: Iterator[pa.RecordBatch]) -> Iterator[pa.RecordBatch]:
        model = shared.value
        for batch in batches:
            for at in range(0, batch.num_rows, 256):
                part = batch.slice(at, 256)
                pooled, _, _ = model.pooled(_Symbols(pc.struct_field(part.column("_row"), [place])))
                yield pa.RecordBatch.from_arrays([part.column("_row"), pa.array(model.probability(pooled))], ["_row", "score"])

    return given.mapInArrow(each, T.StructType([given.schema["_row"], T.StructField("score", T.DoubleType())]))


def op2_quality(spark, sf_dir: str) -> DataFrame:
    docs = spark.read.parquet(f"{sf_dir}/documents.parquet").select(F.col("doc_id").cast("long").alias("doc_id"), "text")
    labels = spark.read.parquet(f"{sf_dir}/labels.parquet").select("doc_id", "quality")
    network = learn(docs, labels, lambda doc_id: remainder(doc_id, 5) != 0)
    held_out = (remainder(F.col("_row.doc_id"), 5) == 0).alias("held_out")
    predicted = F.when(F.col("score") >= 0.3, 1).otherwise(0).alias("predicted")
    return score(docs, network).select("_row.doc_id", held_out, "score", predicted)
