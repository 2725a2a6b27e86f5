"""Mixing sources to target weights, in blocks of words that are dealt to output shards.

1. *Targets.* Every source has a weight and gets that share of all words, up to ``MOST_TIMES`` its own size; what it
   cannot take is shared by the others, by weight, until none is above. The share a unit of weight gets is found by a few
   aggregations over the sources.
2. *Blocks.* The words of a source, its documents in the order of their ids, are packed into blocks of a fixed number of
   words; only a source's last block may be shorter. A block is known by its index, and a document by the blocks it lies in.
3. *Slots.* A source has as many slots as it needs blocks to reach its target to the word. A multinomial draw per source
   deals their number to the output shards, all equally likely; so each shard holds the sources in the proportion of the
   mix, up to chance. Slot numbers go through pseudorandom permutations of the source's block indices, one for each time
   that the source is passed through. So no block is taken twice before all are taken once.
4. *Join.* Slots meet the pieces of blocks by source and block index. A block is in at most ``MOST_TIMES`` slots, rounded
   up, so the keys are spread evenly however large a source is.

Everything is drawn from the seed and the data, so reruns agree. Nothing but sums over all sources comes to the driver.
"""

from __future__ import annotations

import re
from collections.abc import Iterator

import numpy as np
import pandas as pd
from pyspark.sql import DataFrame, Window
from pyspark.sql import functions as F

from farelake.llm.common import bounded_batches, documents, mix
from farelake.operators.numbering import global_row_number
from farelake.session import materialize

#: Weights of the sources in the order of their names, over and over.
WEIGHTS = (5, 2, 1)
MOST_TIMES = 3
BLOCK_WORDS = 128
SHARD_SLOTS = 1 << 15
SEED = 13

_WORD = r"[^\x20\x09-\x0D]+"
_WORDS = re.compile(_WORD)
_STRETCH = 4_000  # documents whose sizes one task adds up
_ROUNDS = 4


# --- sizes and targets -------------------------------------------------------------------------------------


def sized(docs: DataFrame) -> DataFrame:
    """doc_id, source, size (words; null text: 0) of every document."""
    size = F.coalesce(F.regexp_count("text", F.lit(_WORD)), F.lit(0)).cast("long")
    return docs.select(F.col("doc_id").cast("long").alias("doc_id"), F.col("source").cast("string").alias("source"), size.alias("size"))


def weighted_sources(sizes: DataFrame, weights: tuple[int, ...]) -> DataFrame:
    """source, size, number (from 0, by code point, null last) and weight of every source."""
    totals = sizes.groupBy("source").agg(F.sum("size").alias("size"))
    totals = totals.withColumn("_null", F.col("source").isNull().cast("int"))
    numbered = global_row_number(totals, ["_null", "source"], name="_n")
    number = F.col("_n") - 1
    weight = F.get(F.array(*map(F.lit, weights)), (number % len(weights)).cast("int"))
    return materialize(numbered.select("source", "size", number.alias("number"), weight.cast("long").alias("weight")), "sources")


def unit_share(sources: DataFrame, most_times: int) -> float:
    """Words per unit of weight, so that the targets, each at most ``most_times`` its size, add up to all words.

    Starting from an equal share, the sources above their bound are set to it and what is left is shared by the others
    again. The share only grows, and with it the set of sources at their bound, so it ends when none joins them.
    """
    at_bound, share = -1, 0.0
    while True:
        bound = most_times * F.col("size") <= F.lit(share) * F.col("weight")
        row = sources.agg(
            F.sum("size").alias("total"),
            F.count_if(bound).alias("bound"),
            F.sum(F.when(bound, most_times * F.col("size")).otherwise(0)).alias("taken"),
            F.sum(F.when(bound, 0).otherwise(F.col("weight"))).alias("weight"),
        ).first()
        if row["bound"] == at_bound or not row["weight"]:
            return share
        at_bound, share = row["bound"], (row["total"] - row["taken"]) / row["weight"]


def targeted(sources: DataFrame, most_times: int) -> DataFrame:
    """The sources with ``target``, the words that the mix should take of each."""
    share = unit_share(sources, most_times)
    most = (most_times * F.col("size")).cast("double")
    return sources.withColumn("target", F.least(most, F.lit(share) * F.col("weight")))


# --- blocks ------------------------------------------------------------------------------------------------


def placed(sizes: DataFrame, sources: DataFrame) -> DataFrame:
    """Every document with its row number, its source's number, and ``start``, the words of its source before it.

    Sizes are added up in stretches of rows in the order of source and id, then over the stretches of a source.
    """
    columns = sizes.columns
    keyed = sizes.withColumn("_null", F.col("source").isNull().cast("int"))
    rows = global_row_number(keyed, ["_null", "source", "doc_id", "size"], name="row").select("row", *columns)
    named = sources.select(F.col("source").alias("_source"), "number", F.col("size").alias("source_size"), "target")
    rows = rows.join(named, F.col("source").eqNullSafe(F.col("_source"))).drop("_source")
    rows = rows.withColumn("stretch", F.floor(F.col("row") / _STRETCH))
    sums = rows.groupBy("number", "stretch").agg(F.sum("size").alias("words"))
    earlier = Window.partitionBy("number").orderBy("stretch").rowsBetween(Window.unboundedPreceding, -1)
    offsets = sums.select("number", "stretch", F.coalesce(F.sum("words").over(earlier), F.lit(0)).alias("offset"))
    within = Window.partitionBy("number", "stretch").orderBy("row").rowsBetween(Window.unboundedPreceding, -1)
    before = F.coalesce(F.sum("size").over(within), F.lit(0))
    return rows.withColumn("before", before).join(offsets, ["number", "stretch"]).select(
        "row", *columns, "number", "source_size", "target", (F.col("offset") + F.col("before")).alias("start")
    )


def block_pieces(rows: DataFrame, block_words: int) -> DataFrame:
    """What of which document lies in each block: number, block, at (in the block), row, first_word, words."""
    width = F.lit(block_words)
    start, end = F.col("start"), F.col("start") + F.col("size")
    blocks = F.sequence(F.expr(f"start div {block_words}"), F.expr(f"(start + size - 1) div {block_words}"))
    cut = rows.where("size > 0").select("row", "doc_id", "number", start, end.alias("end"), F.explode(blocks).alias("block"))
    first = F.greatest(F.col("start"), F.col("block") * width)
    last = F.least(F.col("end"), (F.col("block") + 1) * width)
    return cut.select(
        *("number", "block", (first - F.col("block") * width).alias("at"), "row", "doc_id"),
        *((first - F.col("start")).alias("first_word"), (last - first).alias("words")),
    )


# --- slots -------------------------------------------------------------------------------------------------


def _seeded(*parts: np.ndarray | int) -> np.ndarray:
    """A 64-bit key of some integers."""
    key = np.uint64(0)
    with np.errstate(over="ignore"):
        for part in parts:
            key = mix(np.atleast_1d(key + np.asarray(part, np.int64).astype(np.uint64) + np.uint64(0x9E3779B97F4A7C15)))
    return key


def permuted(index: np.ndarray, sizes: np.ndarray, keys: np.ndarray, backwards: bool = False) -> np.ndarray:
    """Where a pseudorandom permutation of 0 to size - 1, chosen by the key, takes each index (or brings it from).

    A Feistel network over the next power of four, walked until the result is in range.
    """
    bits = np.array([max(1, (int(n - 1).bit_length() + 1) // 2) for n in np.unique(sizes)], np.uint64)
    half = bits[np.searchsorted(np.unique(sizes), sizes)]
    low_mask = (np.uint64(1) << half) - np.uint64(1)
    value = index.astype(np.uint64)
    open_ = np.arange(len(value))
    order = range(_ROUNDS - 1, -1, -1) if backwards else range(_ROUNDS)
    while len(open_):
        shift, mask, key = half[open_], low_mask[open_], keys[open_]
        left, right = value[open_] >> shift, value[open_] & mask
        for step in order:
            if backwards:
                left, right = right ^ (mix(left + key + np.uint64(step)) & mask), left
            else:
                left, right = right, left ^ (mix(right + key + np.uint64(step)) & mask)
        value[open_] = (left << shift) | right
        open_ = open_[value[open_] >= sizes[open_].astype(np.uint64)]
    return value.astype(np.int64)


def _passes(number: np.ndarray, blocks: np.ndarray, turn: np.ndarray, seed: int) -> np.ndarray:
    return _seeded(np.full(len(number), seed), number, turn)


def slot_counts(sizes: np.ndarray, quota: np.ndarray, numbers: np.ndarray, block_words: int, seed: int) -> np.ndarray:
    """The slots that each source needs to reach ``quota`` words.

    Whole passes take every block; in the last pass the short block counts for less, wherever it comes.
    """
    blocks = -(-sizes // block_words)
    turns, rest = quota // sizes, quota % sizes
    short = sizes - (blocks - 1) * block_words
    at = permuted(blocks - 1, blocks, _passes(numbers, blocks, turns, seed), backwards=True)
    plain = -(-rest // block_words)
    after_short = np.where(rest <= at * block_words + short, at + 1, -(-(rest + block_words - short) // block_words))
    return turns * blocks + np.where(rest <= at * block_words, plain, after_short)


def dealt(sources: DataFrame, most_times: int, block_words: int, shard_slots: int, seed: int) -> DataFrame:
    """number, shard, first, slots: which of a source's slots each output shard gets, by a multinomial draw per source."""
    schema = "number long, source_size long, quota long, slots long"
    quota = F.least(F.round("target"), F.col("size") * most_times).cast("long")
    given = sources.where("size > 0").select("number", F.col("size").alias("source_size"), quota.alias("quota")).where("quota > 0")

    def counted(batches: Iterator[pd.DataFrame]) -> Iterator[pd.DataFrame]:
        for part in batches:
            yield part.assign(slots=slot_counts(*(part[c].to_numpy() for c in ("source_size", "quota", "number")), block_words, seed))

    needed = given.mapInPandas(counted, schema)
    total = needed.agg(F.coalesce(F.sum("slots"), F.lit(0))).first()[0]
    shards = max(1, -(-total // shard_slots))

    def draw(batches: Iterator[pd.DataFrame]) -> Iterator[pd.DataFrame]:
        for part in batches:
            for row in part.itertuples(index=False):
                rng = np.random.Generator(np.random.Philox(key=[seed, row.number]))
                if row.slots < shards:
                    shard, n = np.unique(rng.integers(shards, size=row.slots), return_counts=True)
                else:
                    n = rng.multinomial(row.slots, np.full(shards, 1 / shards))
                    shard = np.flatnonzero(n)
                    n = n[shard]
                ends = np.cumsum(n)
                for low in range(0, len(n), 100_000):
                    cut = slice(low, low + 100_000)
                    base = {"number": row.number, "source_size": row.source_size, "quota": row.quota}
                    yield pd.DataFrame({**base, "shard": shard[cut], "first": (ends - n)[cut], "slots": n[cut]})

    return needed.mapInPandas(draw, "number long, source_size long, quota long, shard long, first long, slots long")


def slots_of(ranges: DataFrame, block_words: int, seed: int) -> DataFrame:
    """number, shard, slot, block, take: the block that each slot holds, and how many words of it are taken."""

    def expand(batches: Iterator[pd.DataFrame]) -> Iterator[pd.DataFrame]:
        for part in batches:
            for at in range(0, len(part), 16):
                few = part.iloc[at : at + 16]
                n = few["slots"].to_numpy()
                each = few.iloc[np.repeat(np.arange(len(few)), n)]
                number, size, quota = (each[c].to_numpy() for c in ("number", "source_size", "quota"))
                slot = each["first"].to_numpy() + np.arange(n.sum()) - np.repeat(np.cumsum(n) - n, n)
                blocks = -(-size // block_words)
                turn, index = slot // blocks, slot % blocks
                keys = _passes(number, blocks, turn, seed)
                block = permuted(index, blocks, keys)
                short = size - (blocks - 1) * block_words
                length = np.where(block == blocks - 1, short, block_words)
                # Words of the source before this slot: the short block has come before or not.
                short_at = permuted(blocks - 1, blocks, keys, backwards=True)
                before = turn * size + index * block_words - np.where(short_at < index, block_words - short, 0)
                take = np.clip(quota - before, 0, length)
                yield pd.DataFrame({"number": number, "shard": each["shard"].to_numpy(), "slot": slot, "block": block, "take": take})

    spread = ranges.repartition("number", "shard")
    return spread.mapInPandas(expand, "number long, shard long, slot long, block long, take long")


# --- the mix -----------------------------------------------------------------------------------------------


class Mix:
    """Documents mixed to target weights: ``documents`` (one row each, placed in their source) and ``pieces`` (what of
    which document stands in which slot of which output shard)."""

    def __init__(self, documents: DataFrame, pieces: DataFrame):
        self.documents = documents
        self.pieces = pieces

    def taken(self) -> DataFrame:
        """doc_id, source, size, source_size, target and taken (words, repeats counted) of every document."""
        sums = self.pieces.groupBy("row").agg(F.sum("words").alias("_taken")).hint("merge")
        taken = F.coalesce("_taken", F.lit(0)).alias("taken")
        return self.documents.join(sums, "row", "left").select("doc_id", "source", "size", "source_size", "target", taken)

    def texts(self, docs: DataFrame) -> DataFrame:
        """shard, number (of the source), slot and the words of each slot, joined by spaces.

        ``docs`` are the documents that were mixed, with distinct ids: the words are fetched by id, once for each
        document, whose pieces are then cut together.
        """
        where = F.struct("shard", "number", "slot", "at", "first_word", "words")
        wanted = self.pieces.groupBy("doc_id").agg(F.collect_list(where).alias("pieces")).hint("merge")
        found = docs.select(F.col("doc_id").cast("long").alias("doc_id"), F.col("text").alias("text")).join(wanted, "doc_id")

        def cut(batches: Iterator[pd.DataFrame]) -> Iterator[pd.DataFrame]:
            for part in batches:
                for text, pieces in zip(part["text"], part["pieces"], strict=True):
                    words = _WORDS.findall(text)
                    rows = [
                        (p["shard"], p["number"], p["slot"], p["at"], " ".join(words[p["first_word"] : p["first_word"] + p["words"]]))
                        for p in pieces
                    ]
                    yield pd.DataFrame(rows, columns=["shard", "number", "slot", "at", "part"])

        bounded_batches(docs.sparkSession)
        parts = found.select("text", "pieces").mapInPandas(cut, "shard long, number long, slot long, at long, part string")
        ordered = F.sort_array(F.collect_list(F.struct("at", "part")))
        return parts.groupBy("shard", "number", "slot").agg(F.array_join(ordered["part"], " ").alias("text"))


def mixed(
    docs: DataFrame,
    weights: tuple[int, ...] = WEIGHTS,
    most_times: int = MOST_TIMES,
    block_words: int = BLOCK_WORDS,
    shard_slots: int = SHARD_SLOTS,
    seed: int = SEED,
) -> Mix:
    """Mix the documents (doc_id, text, source) to the weights of their sources.

    Of every source exactly its target is taken, rounded to words; no word more than ``most_times`` times, rounded up,
    and the passes over a source are whole but for the last. A null source is a source, the last one. A null or empty
    text, or one without words, has size 0 and gives nothing; a source of such texts has target 0. Null ids come first in
    a source; rows that repeat are mixed one by one, and those that agree in id, source and size are interchangeable.
    Other columns are ignored. An empty table gives no rows.
    """
    sizes = materialize(sized(docs), "sizes")
    sources = targeted(weighted_sources(sizes, weights), most_times)
    rows = materialize(placed(sizes, sources), "placed")
    slots = slots_of(dealt(sources, most_times, block_words, shard_slots, seed), block_words, seed)
    pieces = block_pieces(rows, block_words)
    words = F.least(F.col("words"), F.col("take") - F.col("at"))
    # The optimizer takes slots for as few as the sources that they are made of, and would broadcast them.
    joined = slots.hint("merge").join(pieces, ["number", "block"]).withColumn("words", words).where("words > 0")
    return Mix(rows, joined.select("shard", "number", "slot", "at", "row", "doc_id", "first_word", "words"))


def op13_mixing(spark, sf_dir: str) -> DataFrame:
    mix_of = mixed(documents(spark, sf_dir).select("doc_id", "text", "source"))
    return mix_of.taken().select("doc_id", "size", "source_size", "target", "taken")
