"""Sharding by a minimax contiguous partition.

Texts that are equal form an atomic group. Groups are ordered by a hash of their text, and the shards are contiguous
ranges of that order: the smallest capacity for which the groups fit into the given number of shards is found by
binary search with a greedy check, and the cuts are placed below it, each as near to an even share of what is left
as the capacity allows.

The order never comes to the driver. It knows the sizes of hash ranges only (4,096 at first); wherever the search has
to look inside a range, that range is split 256 times finer by one aggregation over the groups, and the search starts
again, until it has met single groups only. So the driver holds a bounded number of ranges at a time, and the result
is the exact optimum over single groups.
"""

from __future__ import annotations

import bisect
from itertools import accumulate

from pyspark.sql import Column, DataFrame
from pyspark.sql import functions as F

from farelake.operators.numbering import global_row_number
from farelake.session import materialize

_KEY_BITS = 62
_FIRST_BITS = 12
_STEP_BITS = 8


def text_key(text: Column) -> Column:
    """The place of a text in the order: 62 bits of its SHA-256. Texts whose keys collide share a group."""
    digest = F.sha2(F.coalesce(text, F.lit("")).cast("binary"), 256)
    return F.shiftrightunsigned(F.conv(F.substring(digest, 1, 16), 16, -10).cast("long"), 64 - _KEY_BITS)


class _Order:
    """What the driver knows of the ordered groups: ranges of keys as (bits, prefix, bytes, groups)."""

    def __init__(self, ranges: list[tuple[int, int, int, int]]):
        self.ranges = sorted(ranges, key=lambda r: r[1] << (_KEY_BITS - r[0]))
        self.ends = list(accumulate(r[2] for r in self.ranges))
        self.total = self.ends[-1] if self.ends else 0
        self.unclear: set[int] = set()

    def cut_below(self, limit: int) -> int:
        """The largest boundary between groups that has at most ``limit`` bytes before it (a number of bytes)."""
        place = bisect.bisect_right(self.ends, limit)
        start = self.ends[place - 1] if place else 0
        if start < limit and place < len(self.ranges) and self.ranges[place][3] > 1:
            self.unclear.add(place)  # the boundary may be inside this range
        return start

    def cut_from(self, limit: int) -> int:
        """The smallest boundary with at least ``limit`` bytes before it."""
        if limit <= 0:
            return 0
        place = min(bisect.bisect_left(self.ends, limit), len(self.ends) - 1)
        if self.ends[place] != limit and self.ranges[place][3] > 1:
            self.unclear.add(place)
        return self.ends[place]

    def fits(self, capacity: int, shards: int) -> bool:
        at = 0
        for _ in range(shards):
            at = self.cut_below(at + capacity)
            if at >= self.total:
                return True
        return False

    def key_from(self, position: int) -> int:
        """The first key of the range that starts at a boundary."""
        place = bisect.bisect_right(self.ends, position)
        if place >= len(self.ranges):
            return 1 << _KEY_BITS
        bits, prefix, _, _ = self.ranges[place]
        return prefix << (_KEY_BITS - bits)


def smallest_capacity(order: _Order, shards: int, largest: int) -> int:
    """Binary search for the smallest capacity with which the greedy filling needs at most ``shards`` shards."""
    low = max(largest, -(-order.total // shards))
    high = low + largest  # a shard is only closed when the next group does not fit, so this always suffices
    while low < high:
        middle = (low + high) // 2
        if order.fits(middle, shards):
            high = middle
        else:
            low = middle + 1
    return low


def place_cuts(order: _Order, shards: int, capacity: int) -> list[int]:
    """Boundaries before shards 1 to ``shards - 1``: none above the capacity, each as even as possible."""
    latest_start = [order.total]  # the first boundary from which the remaining shards suffice
    for _ in range(shards - 1):
        latest_start.append(order.cut_from(latest_start[-1] - capacity))
    cuts = []
    at = 0
    for left in range(shards, 1, -1):
        lowest, highest = max(at, latest_start[left - 1]), order.cut_below(at + capacity)
        even = at + -(-(order.total - at) // left)
        below, above = order.cut_below(even), order.cut_from(even)
        best = below if below > at and even - below <= above - even else above
        at = min(max(best, lowest), highest)
        cuts.append(at)
    return cuts


def contiguous_cuts(groups: DataFrame, shards: int) -> list[int]:
    """Keys at which shards 1 to ``shards - 1`` begin. ``groups``: (_key, _bytes), one row per group."""
    key = F.col("_key")

    def split(bits: int, prefix: Column, rows: DataFrame) -> list[tuple[int, int, int, int]]:
        found = rows.groupBy(prefix.alias("prefix")).agg(F.sum("_bytes").alias("b"), F.count(F.lit(1)).alias("n"))
        return [(bits, r.prefix, r.b, r.n) for r in found.collect()]  # at most 256 for each range asked for

    ranges = split(_FIRST_BITS, F.shiftright(key, _KEY_BITS - _FIRST_BITS), groups)
    if not ranges:
        return [0] * (shards - 1)
    largest = groups.agg(F.max("_bytes")).first()[0]
    while True:
        order = _Order(ranges)
        cuts = place_cuts(order, shards, smallest_capacity(order, shards, largest))
        unclear = {order.ranges[i] for i in order.unclear}
        if not unclear:
            return [order.key_from(cut) for cut in cuts]
        finer = []
        for bits in sorted({r[0] for r in unclear}):
            prefixes = [r[1] for r in unclear if r[0] == bits]
            more = min(bits + _STEP_BITS, _KEY_BITS)
            inside = groups.where(F.shiftright(key, _KEY_BITS - bits).isin(prefixes))
            finer += split(more, F.shiftright(key, _KEY_BITS - more), inside)
        ranges = [r for r in order.ranges if r not in unclear] + finer


def shard_documents(docs: DataFrame, shards: int = 16) -> DataFrame:
    """Put documents into shards of nearly equal bytes; equal texts stay together.

    Returns doc_id, size (UTF-8 bytes plus 1), text_crc32, shard, slot (place in the shard, from 0). The largest shard
    is as small as any contiguous cutting of the ordered groups allows. A null text counts as the empty text; a null
    doc_id is kept; repeated rows each take a slot; an empty table gives no rows; other columns are ignored. Fewer
    groups than shards leave shards empty.
    """
    raw = F.coalesce(F.col("text"), F.lit("")).cast("binary")
    sized = materialize(
        docs.select(
            F.col("doc_id").cast("long").alias("doc_id"),
            (F.octet_length(raw).cast("long") + 1).alias("size"),
            F.crc32(raw).alias("text_crc32"),
            text_key(F.col("text")).alias("_key"),
        ),
        "shard-sizes",
    )
    groups = sized.groupBy("_key").agg(F.sum("size").alias("_bytes"))
    cuts = contiguous_cuts(groups, shards)
    # The smallest shard number whose end lies above the key.
    shard = F.lit(0)
    for cut in cuts:
        shard = shard + F.when(F.col("_key") >= F.lit(cut), 1).otherwise(0)
    placed = sized.withColumn("shard", shard.cast("int"))
    first = placed.groupBy("shard").agg(F.count(F.lit(1)).alias("_n"))
    counts = {r["shard"]: r["_n"] for r in first.collect()}  # one row per shard
    starts = list(accumulate((counts.get(i, 0) for i in range(shards)), initial=0))
    numbered = global_row_number(placed, ["_key", "doc_id"], name="_row")
    start = F.element_at(F.array(*[F.lit(x) for x in starts]), F.col("shard") + 1)
    return numbered.select("doc_id", "size", "text_crc32", "shard", (F.col("_row") - 1 - start).cast("long").alias("slot"))


def op5_sharding(spark, sf_dir: str) -> DataFrame:
    placed = shard_documents(spark.read.parquet(f"{sf_dir}/documents.parquet"))
    return placed.select(
        "doc_id", "size", "text_crc32", F.lit("bytes").alias("law"), "shard", "slot", F.lit(None).cast("int").alias("grown_shard")
    )
