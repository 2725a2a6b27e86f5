"""Gap-free row numbers over a whole table."""

from __future__ import annotations

from collections.abc import Sequence

from pyspark.sql import DataFrame, Window
from pyspark.sql import functions as F

from farelake.functions.numeric import rows
from farelake.session import materialize, sized_partitions

# monotonically_increasing_id() holds the partition in its upper bits and the row's position in the lower 33.
_POSITION_BITS = 33


def global_row_number(
    df: DataFrame,
    order_by: Sequence[str],
    name: str = "row_num",
    partitions: int | None = None,
    after: int = 0,
    keep: Sequence[str] | None = None,
) -> DataFrame:
    """Number all rows from ``after + 1`` in the order of ``order_by``, without moving them through one task.

    A window without partitions would sort the whole table in a single task. Here the rows are range
    partitioned and sorted, each gets its position in its own partition, and the positions are shifted by
    the number of rows in the partitions before. Ties in ``order_by`` are broken by all other columns, so the
    result is repeatable. Rows that are equal in every column are interchangeable; they are spread by the
    input partition they come from and by chance, so that a large group of copies is not sorted by one task either.

    The sorted rows are written once to shared scratch: the sizes and the numbers must come from the
    same placement, and range boundaries differ between runs. Only the columns in ``keep`` are written (default: all).
    """
    columns = df.columns if keep is None else list(keep)
    order = [*order_by, *(c for c in df.columns if c not in order_by)]
    # The count is given so that adaptive execution leaves the partitions alone: it merges small ones by their
    # compressed size, and copies compress so well that it would put a large group of them back together.
    count = partitions or sized_partitions(df)
    tagged = df.withColumns({"_origin": F.spark_partition_id(), "_spread": F.pmod(F.monotonically_increasing_id(), F.lit(64))})
    placed = tagged.repartitionByRange(count, *order, "_origin", "_spread").sortWithinPartitions(*order)
    stored = materialize(
        placed.select(
            *columns,
            F.spark_partition_id().alias("_part"),
            F.monotonically_increasing_id().bitwiseAND(F.lit((1 << _POSITION_BITS) - 1)).alias("_position"),
        ),
        "row-number",
    )
    # One row per range partition, which is what bounds both this window and the broadcast.
    before = Window.orderBy("_part").rowsBetween(Window.unboundedPreceding, -1)
    sizes = stored.groupBy("_part").agg(rows().alias("_size"), F.max("_position").alias("_last"))
    # Positions that have wrapped around no longer match the count.
    checked = F.when(F.col("_last") + 1 == F.col("_size"), F.col("_size")).otherwise(
        F.raise_error(F.lit("a range partition has more rows than can be numbered; give more partitions")).cast("bigint")
    )
    offsets = sizes.withColumn("_size", checked).select(
        "_part", F.coalesce(F.sum("_size").over(before), F.lit(0)).alias("_offset")
    )
    return stored.join(F.broadcast(offsets), "_part").select(
        *columns, (F.col("_offset") + F.col("_position") + F.lit(after + 1)).alias(name)
    )
