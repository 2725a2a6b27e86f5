"""The stored fact: month partitions, clustered files, pruned reads."""

from __future__ import annotations

from collections.abc import Callable, Iterable, Mapping

from pyspark.sql import Column, DataFrame, Observation
from pyspark.sql import functions as F

from farelake.functions.calendar import month_start
from farelake.schemas import FACT
from farelake.sources.versions import MONTH, Parts, Versions

FACT_TABLE = "fact_trips"
CLUSTER_KEYS = ("pickup_location_id", "payment_type_id", "rate_code_id")


def clustered(fact: DataFrame, partitions: int | None = None) -> DataFrame:
    """Rows placed so that each task writes one stretch of (month, cluster keys).

    The placement goes on through the pickup time and the unique trip id, so neither a busy month nor a busy
    zone is bound to one task, and every month is spread over as many files as its size asks for. Rows that have no
    ``trip_id`` yet have the row number it is made of.
    """
    keys = [MONTH, *CLUSTER_KEYS, "pickup_at", "trip_id" if "trip_id" in fact.columns else "row_num"]
    count = [] if partitions is None else [partitions]
    return (
        fact.withColumn(MONTH, month_start(F.to_date("pickup_at")))
        .repartitionByRange(*count, *keys)
        .sortWithinPartitions(*keys)
    )


def stage_fact(
    store: Versions,
    fact: DataFrame,
    partitions: int | None = None,
    metrics: Mapping[str, Column] | None = None,
    finish: Callable[[DataFrame], DataFrame] | None = None,
) -> tuple[Parts, dict[str, int]]:
    """Write a version of the fact's months that occur in ``fact``, to be committed; and what the ``metrics``
    (aggregates by name) came to, which are observed as the rows pass to the files.

    They are observed behind the last shuffle, where a task that runs again counts once. ``finish``, a projection,
    makes fact rows of what is placed and keeps ``month_start``: so only what they are made of is shuffled and sorted.
    """
    placed, seen = clustered(fact, partitions), Observation()
    if finish:
        placed = finish(placed)
    if metrics:
        placed = placed.observe(seen, *metrics.values())
    version = store.write(FACT_TABLE, placed, monthly=True)
    found = store.months_of(FACT_TABLE, version, FACT)
    return {month: {"version": version, **counts} for month, counts in found.items()}, dict(seen.get) if metrics else {}


def write_fact(
    store: Versions, fact: DataFrame, partitions: int | None = None, finish: Callable[[DataFrame], DataFrame] | None = None
) -> None:
    """Full refresh of the stored fact. A failed write leaves it as it was."""
    store.commit({FACT_TABLE: stage_fact(store, fact, partitions, finish=finish)[0]})


def replace_months(store: Versions, fact: DataFrame, months: Iterable[str], partitions: int | None = None) -> None:
    """Incremental load: ``months`` are replaced by the rows of ``fact``, which has no others, in one step. A month
    without rows is gone; the files of other months stay as they are."""
    fresh, _ = stage_fact(store, fact, partitions)
    if outside := fresh.keys() - set(months):
        raise ValueError(f"trips outside of the months that are replaced: {', '.join(sorted(outside))}")
    kept = {m: part for m, part in store.parts(FACT_TABLE).items() if m not in set(months)}
    store.commit({FACT_TABLE: {**kept, **fresh}})


def read_fact(store: Versions, start: str | None = None, end: str | None = None, months: Iterable[str] | None = None) -> DataFrame:
    """The stored fact, for pickup dates from ``start`` up to, not including, ``end``, or of some months only.

    Spark prunes partitions only by the partition column, so the months that a date range implies are
    tested as well.
    """
    fact = store.read(FACT_TABLE, FACT, months)
    if start is not None:
        first = F.lit(start).cast("date")
        fact = fact.where((F.col("pickup_date") >= first) & (F.col(MONTH) >= month_start(first)))
    if end is not None:
        stop = F.lit(end).cast("date")
        last_month = month_start(F.date_sub(stop, 1))
        fact = fact.where((F.col("pickup_date") < stop) & (F.col(MONTH) <= last_month))
    return fact.select(*FACT.names)
