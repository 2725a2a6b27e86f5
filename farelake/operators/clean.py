"""From landing rows to typed, valid trips."""

from __future__ import annotations

from collections.abc import Sequence

from pyspark.sql import Column, DataFrame
from pyspark.sql import functions as F

from farelake.functions.keys import surrogate_key
from farelake.operators.numbering import global_row_number

ROW_ORDER = ("pickup_datetime", "dropoff_datetime", "pickup_location_id")

# Fixed value: the rate code that stands for an unknown one.
UNKNOWN_RATE_CODE = 99

# Raw column -> (clean column, type), in output order.
_TYPED = {
    "vendor_id": ("vendor_id", "bigint"),
    "pickup_location_id": ("pickup_location_id", "bigint"),
    "dropoff_location_id": ("dropoff_location_id", "bigint"),
    "pickup_datetime": ("pickup_at", "timestamp_ntz"),
    "dropoff_datetime": ("dropoff_at", "timestamp_ntz"),
    "passenger_count": ("passenger_count", "bigint"),
    "trip_distance": ("trip_distance_miles", "double"),
    "rate_code": ("rate_code_id", "bigint"),
    "payment_type": ("payment_type_id", "bigint"),
    "store_and_fwd_flag": ("store_and_fwd_flag", "string"),
    "fare_amount": ("fare_amount", "double"),
    "extra": ("extra_charges", "double"),
    "mta_tax": ("mta_tax", "double"),
    "tip_amount": ("tip_amount", "double"),
    "tolls_amount": ("tolls_amount", "double"),
    "imp_surcharge": ("improvement_surcharge", "double"),
    "total_amount": ("total_amount", "double"),
    "_synced": ("synced_at", "timestamp_ntz"),
}


def live_rows(raw: DataFrame) -> DataFrame:
    """Rows that are not soft-deleted. A null flag counts as deleted."""
    return raw.where(~F.col("_deleted"))


#: What the validity rules read.
RULED = ("pickup_datetime", "dropoff_datetime", "trip_distance", "total_amount", "fare_amount")


def number_trips(
    raw: DataFrame, partitions: int | None = None, after: int = 0, keep: Sequence[str] | None = None
) -> DataFrame:
    """Live rows with ``row_num``: numbered after the soft-delete filter and before any validity rule,
    so the numbers of valid trips have gaps. A later batch goes on ``after`` the live rows before it. The sorted
    copy holds the columns ``keep`` only (default: all)."""
    return global_row_number(live_rows(raw), ROW_ORDER, partitions=partitions, after=after, keep=keep)


def rate_code_or_unknown(code: Column) -> Column:
    """Text that is not an integer, and null, become the unknown code."""
    return F.coalesce(code.try_cast("bigint"), F.lit(UNKNOWN_RATE_CODE).cast("bigint"))


def trip_key() -> Column:
    return surrogate_key(F.col("row_num")).alias("trip_id")


def standardize(raw: DataFrame, keyed: bool = True) -> DataFrame:
    """Rename and cast the columns that are there. All casts but the rate code's are strict: malformed text fails the job (ANSI mode).
    Numbered rows get their ``trip_id``, or if not ``keyed`` keep the shorter ``row_num``."""
    out = []
    if "row_num" in raw.columns:
        out.append(trip_key() if keyed else F.col("row_num"))
    for source, (name, kind) in _TYPED.items():
        if source not in raw.columns:
            continue
        column = F.col(source)
        typed = rate_code_or_unknown(column) if source == "rate_code" else column.cast(kind)
        out.append(typed.alias(name))
    return raw.select(*out)


def valid_trips(trips: DataFrame) -> DataFrame:
    """Trips that pass every validity rule; a null in any tested column fails."""
    miles, total = F.col("trip_distance_miles"), F.col("total_amount")
    return trips.where(
        F.col("pickup_at").isNotNull()
        & F.col("dropoff_at").isNotNull()
        & (F.col("dropoff_at") > F.col("pickup_at"))
        & (miles > 0)
        & (miles < 500)
        & (total > 0)
        & (total < 10000)
        & (F.col("fare_amount") >= 0)
    )


def clean_trips(
    raw: DataFrame,
    keyed: bool = True,
    partitions: int | None = None,
    after: int = 0,
    keep: Sequence[str] | None = None,
) -> DataFrame:
    """Typed valid trips. ``keyed=False`` leaves out ``trip_id``, and with it the sort of the whole table;
    no report needs the key. Keyed trips can be narrowed to ``keep``, which must include what the rules read."""
    live = number_trips(raw, partitions, after, keep) if keyed else live_rows(raw)
    return valid_trips(standardize(live))
