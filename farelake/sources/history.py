"""A stored type-2 history of a dimension, brought forward snapshot by snapshot.

The rows that are current are a table of their own, and so are those that each snapshot has closed. The next snapshot
meets the current rows only; closed ones are never read or written again, however long the history grows.
"""

from __future__ import annotations

from pyspark.sql import Column, DataFrame
from pyspark.sql import functions as F
from pyspark.sql.types import DateType, StructField, StructType

from farelake.session import materialize
from farelake.sources.versions import MONTH, WHOLE, Versions

_FROM = StructField("valid_from", DateType())


def _current(name: str) -> str:
    return f"{name}_current"


def _closed(name: str) -> str:
    return f"{name}_closed"


def apply_snapshot(store: Versions, name: str, snapshot: DataFrame, key: str, day: str) -> None:
    """Bring the history up to a snapshot, which says how the members are from ``day`` on.

    Members as before stay as they are; those that changed or are gone are closed at ``day``, and changed and new ones
    begin then. A member that comes back begins anew. Nulls compare equal; the key is unique and not null. The columns
    are those of the first snapshot. Both tables switch in one commit. A day that is not after the last is refused.
    """
    known = store.parts(_current(name)).get(WHOLE)
    if known and str(known["day"]) >= day:
        raise ValueError(f"the history has been brought up to {known['day']} already")
    attributes = [c for c in snapshot.columns if c != key]
    whole = StructType([*snapshot.schema.fields, _FROM])
    before = store.read(_current(name), whole) if known else store.spark.createDataFrame([], whole)
    old = before.select(key, F.struct(*map(F.col, attributes)).alias("_old"), F.col("valid_from").alias("_since"))
    new = snapshot.select(key, F.struct(*map(F.col, attributes)).alias("_new"))
    joined = old.join(new, key, "full_outer")
    same = F.col("_old").eqNullSafe(F.col("_new"))
    # A member without a row on a side is null there as a whole, which equals no row with null attributes.
    same = same & F.col("_old").isNotNull() & F.col("_new").isNotNull()
    compared = materialize(joined.withColumn("_same", same), "history")

    def rows(values: str, *more: Column) -> list[Column]:
        return [F.col(key), *(F.col(f"{values}.{c}").alias(c) for c in attributes), *more]

    began = F.when(F.col("_same"), F.col("_since")).otherwise(F.lit(day).cast("date")).alias("valid_from")
    current = compared.where(F.col("_new").isNotNull()).select(*rows("_new", began))
    ended = compared.where(F.col("_old").isNotNull() & ~F.col("_same"))
    closing = F.lit(day).cast("date").alias(MONTH)
    closed = ended.select(*rows("_old", F.col("_since").alias("valid_from"), closing))
    parts = store.parts(_closed(name))
    if not closed.isEmpty():
        parts = {**parts, day: {"version": store.write(_closed(name), closed, monthly=True)}}
    fresh = {WHOLE: {"version": store.write(_current(name), current), "day": day}}
    store.commit({_current(name): fresh, _closed(name): parts})


def history(store: Versions, name: str, schema: StructType) -> DataFrame:
    """All versions of all members (``schema``: that of the snapshots), with ``valid_from``, ``valid_to`` (null while
    current) and ``is_current``."""
    whole = StructType([*schema.fields, _FROM])
    current = store.read(_current(name), whole).withColumn("valid_to", F.lit(None).cast("date"))
    ends = store.parts(_closed(name))
    closed = store.read(_closed(name), whole) if ends else current.limit(0).withColumnRenamed("valid_to", MONTH)
    versions = current.unionByName(closed.withColumnRenamed(MONTH, "valid_to").select(*current.columns))
    return versions.withColumn("is_current", F.col("valid_to").isNull())
