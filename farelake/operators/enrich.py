"""Calendar parts, category labels and measures of a trip."""

from __future__ import annotations

from pyspark.sql import Column, DataFrame
from pyspark.sql import functions as F

from farelake.functions import buckets, calendar
from farelake.functions.numeric import ratio


def calendar_parts(at: Column, prefix: str = "pickup_") -> list[Column]:
    number = calendar.day_of_week(at)
    return [
        F.to_date(at).alias(f"{prefix}date"),
        calendar.year(at).alias(f"{prefix}year"),
        calendar.month(at).alias(f"{prefix}month"),
        calendar.day(at).alias(f"{prefix}day"),
        calendar.hour(at).alias(f"{prefix}hour"),
        number.alias(f"{prefix}day_of_week"),
        calendar.name_of_day(number).alias(f"{prefix}day_name"),
        calendar.sunday_week(at).alias(f"{prefix}week"),
        calendar.is_weekend_day(number).alias("is_weekend"),
    ]


def category_labels() -> list[Column]:
    """Labels of trips that carry their duration in whole seconds."""
    minutes = calendar.whole_minutes(F.col("trip_duration_seconds"))
    return [
        buckets.time_of_day(calendar.hour(F.col("pickup_at"))).alias("time_of_day_bucket"),
        buckets.distance(F.col("trip_distance_miles")).alias("trip_distance_category"),
        buckets.duration(minutes).alias("trip_duration_category"),
        buckets.party(F.col("passenger_count")).alias("passenger_category"),
    ]


def measures(*wanted: str) -> list[Column]:
    """Durations and ratios (default: all) of trips that carry their duration in whole seconds; a zero divisor gives
    null."""
    seconds = F.col("trip_duration_seconds")
    hours = seconds / 3600.0
    surcharges = F.col("extra_charges") + F.col("mta_tax") + F.col("improvement_surcharge")
    every = {
        "trip_duration_seconds": seconds,
        "trip_duration_minutes": calendar.whole_minutes(seconds),
        "fare_per_mile": ratio(F.col("fare_amount"), F.col("trip_distance_miles")),
        "tip_percentage": ratio(F.col("tip_amount"), F.col("fare_amount")) * 100.0,
        "avg_speed_mph": ratio(F.col("trip_distance_miles"), hours),
        "total_surcharges": surcharges,
        "revenue_per_hour": ratio(F.col("total_amount"), hours),
    }
    return [every[name].alias(name) for name in wanted or every]


def timed(trips: DataFrame) -> DataFrame:
    """Trips with ``trip_duration_seconds``, which labels and measures share."""
    return trips.withColumn("trip_duration_seconds", calendar.elapsed_seconds(F.col("pickup_at"), F.col("dropoff_at")))


def enrich_trips(trips: DataFrame) -> DataFrame:
    """Clean trips with 8 calendar parts, the weekend flag, 4 labels and 7 measures added. A projection only."""
    return timed(trips).select(
        *trips.columns, *calendar_parts(F.col("pickup_at")), *category_labels(), *measures()
    )
