"""Loading the landing table: range extract, repeatable sample, sync columns, full and monthly refresh, load summary."""

from __future__ import annotations

from collections.abc import Iterable, Sequence

from pyspark.sql import DataFrame
from pyspark.sql import functions as F

from farelake import schemas
from farelake.functions.calendar import instant, month_start
from farelake.functions.numeric import rows, total
from farelake.sources.versions import MONTH, Versions

#: The landing table's name in its store.
LANDING = "landing"
_HASH_DIGITS = 8


def extract_range(source: DataFrame, start: str, end: str) -> DataFrame:
    """The source columns of trips picked up from ``start`` up to, not including, ``end``."""
    at = F.col("pickup_datetime")
    return source.select(*schemas.SOURCE_TRIPS.names).where((at >= instant(start)) & (at < instant(end)))


def add_sync_columns(trips: DataFrame, synced_at: str) -> DataFrame:
    return trips.withColumns({"_synced": instant(synced_at), "_deleted": F.lit(False)})


def sample_share(df: DataFrame, share: float, keys: Sequence[str]) -> DataFrame:
    """About this share of the rows: those whose key hashes below it.

    The choice rests on the content alone, so it is the same on every run and for every partitioning, spread over
    the whole table, and one filter at any size. Rows that are equal in the keys stay or go together.
    """
    if not 0 <= share <= 1:
        raise ValueError("a share is between 0 and 1")
    texts = [F.coalesce(F.col(k).cast("string"), F.lit("")) for k in keys]
    digits = F.substring(F.md5(F.concat_ws("|", *texts)), 1, _HASH_DIGITS)
    return df.where(digits < F.lit(share_bound(share)))


def share_bound(share: float) -> str:
    """The hash digits below which a sample of this share lies."""
    return f"{round(share * 16**_HASH_DIGITS):0{_HASH_DIGITS}x}" if share < 1 else "g"


def load(store: Versions, trips: DataFrame, months: Iterable[str] | None = None) -> None:
    """Refresh the landing table, by pickup month: whole, or only these ``months`` (their first days).

    The rows of a refreshed month become exactly those of ``trips``, which may be derived from them; a month without
    rows is gone. Months are remembered with their numbers of rows and of live rows, so that later steps number the
    trips of one month without reading those before. Readers see the former state until all is written, and a failed
    load changes nothing.
    """
    at = F.col("pickup_datetime")
    dated = trips.select(*schemas.RAW_TRIPS.names, month_start(F.to_date(at)).alias(MONTH))
    # Each task writes one stretch of time, however many rows a month has.
    placed = dated.repartitionByRange(MONTH, at, "dropoff_datetime", "pickup_location_id")
    version = store.write(LANDING, placed, monthly=True)
    live = F.count_if(~F.col("_deleted")).alias("live")
    found = store.months_of(LANDING, version, schemas.RAW_TRIPS, live)
    kept = {}
    if months is not None:
        wanted = set(months)
        if outside := found.keys() - wanted:
            raise ValueError(f"trips outside of the months that are loaded: {', '.join(sorted(outside))}")
        kept = {m: part for m, part in store.parts(LANDING).items() if m not in wanted}
    store.commit({LANDING: {**kept, **{m: {"version": version, **counts} for m, counts in found.items()}}})


def read_landing(store: Versions, months: Iterable[str] | None = None) -> DataFrame:
    """The landing rows, of some months only if these are given."""
    return store.read(LANDING, schemas.RAW_TRIPS, months).select(*schemas.RAW_TRIPS.names)


def load_summary(landing: DataFrame) -> DataFrame:
    return landing.agg(
        rows().alias("total_rows"),
        F.min("pickup_datetime").alias("min_pickup"),
        F.max("pickup_datetime").alias("max_pickup"),
        F.countDistinct("vendor_id").alias("vendors"),
        total("total_amount").alias("total_revenue"),
    )
