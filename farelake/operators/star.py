"""Dimensions, the calendar and the wide fact."""

from __future__ import annotations

from collections.abc import Sequence

from pyspark.sql import Column, DataFrame, SparkSession
from pyspark.sql import functions as F

from farelake.functions import buckets, calendar
from farelake.functions.calendar import instant
from farelake.schemas import FACT


def vendor_dim(vendors: DataFrame) -> DataFrame:
    return vendors.select("vendor_id", "vendor_name")


def payment_type_dim(payment_types: DataFrame) -> DataFrame:
    return payment_types.select("payment_type_id", "payment_type_name", "is_electronic")


def rate_code_dim(rate_codes: DataFrame) -> DataFrame:
    airport = F.col("rate_category").isin("airport")
    return rate_codes.select("rate_code_id", "rate_code_name", "rate_category", airport.alias("is_airport_rate"))


def location_dim(zones: DataFrame) -> DataFrame:
    category = buckets.zone_category(F.col("borough"), F.col("service_zone"))
    return zones.select("location_id", "zone_name", "borough", "service_zone", category.alias("zone_category"))


def date_spine(spark: SparkSession, start: str, end: str) -> DataFrame:
    """One row per day from ``start`` to the day before ``end``."""
    bounds = spark.range(1).select(F.lit(start).cast("date").alias("first"), F.lit(end).cast("date").alias("stop"))
    return _days(bounds)


def spine_of(trips: DataFrame, at: str = "pickup_at") -> DataFrame:
    """One row per day from the first to the last day on which ``at`` falls, busy or not."""
    day = F.to_date(F.col(at))
    return _days(trips.agg(F.min(day).alias("first"), F.date_add(F.max(day), 1).alias("stop")))


def _days(bounds: DataFrame) -> DataFrame:
    days = F.sequence(F.col("first"), F.date_sub(F.col("stop"), 1))
    return bounds.where(F.col("first") < F.col("stop")).select(F.explode(days).alias("date_day"))


def date_dim(spine: DataFrame) -> DataFrame:
    at = F.col("date_day")
    number = calendar.day_of_week(at)
    return spine.select(
        "date_day",
        calendar.year(at).alias("year"),
        calendar.quarter(at).alias("quarter"),
        calendar.month(at).alias("month"),
        calendar.sunday_week(at).alias("week_of_year"),
        number.alias("day_of_week"),
        calendar.name_of_day(number).alias("day_name"),
        calendar.is_weekend_day(number).alias("is_weekend"),
        calendar.year_month(at).alias("year_month"),
        calendar.iso_year_week(at).alias("year_week"),
    )


def named(trips: DataFrame, vendors: DataFrame, payment_types: DataFrame, rate_codes: DataFrame) -> DataFrame:
    """Trips with vendor, payment and rate names. Unknown codes keep null names.

    The lookups are joined without a hint; Spark broadcasts them because their known size is below its
    threshold, and would shuffle one that is not.
    """
    return (
        trips.join(vendors.select("vendor_id", "vendor_name"), "vendor_id", "left")
        .join(payment_types.select("payment_type_id", "payment_type_name"), "payment_type_id", "left")
        .join(rate_codes.select("rate_code_id", "rate_code_name"), "rate_code_id", "left")
    )


def fact_rows(enriched: DataFrame, as_of: str, keep: Sequence[str] = ()) -> DataFrame:
    """The 43-column fact of enriched trips with names, and columns to ``keep``. A projection only."""
    return enriched.withColumn("updated_at", instant(as_of)).select(*FACT.names, *keep)


def build_fact(
    trips: DataFrame, vendors: DataFrame, payment_types: DataFrame, rate_codes: DataFrame, as_of: str
) -> DataFrame:
    """The fact of enriched trips and the lookups of their names."""
    return fact_rows(named(trips, vendors, payment_types, rate_codes), as_of)


def zone_classes(trips: DataFrame, locations: DataFrame) -> DataFrame:
    """Zones with trips, their borough, and a class by how many trips they have had."""
    counts = trips.groupBy(F.col("pickup_location_id").alias("location_id")).agg(F.count(F.lit(1)).alias("n"))
    label = F.when(F.col("n") >= 200, "high").when(F.col("n") >= 20, "medium").otherwise("low")
    return counts.join(locations, "location_id").select("location_id", "zone_name", "borough", label.alias("demand_class"))


def type_two_history(before: DataFrame, after: DataFrame, key: str, first: str, second: str) -> DataFrame:
    """The history of a dimension from two snapshots with the same columns.

    A member that is in both and has not changed has one row, valid from ``first`` on. One that has changed has its old
    row closed at ``second`` and a new one from there on; one that is gone has its row closed, and a new one begins at
    ``second``. ``valid_to`` is null while a row is current. Nulls compare equal. One shuffle of each snapshot by key.
    """
    attributes = [c for c in before.columns if c != key]
    old = before.select(key, F.struct(*attributes).alias("_old"))
    new = after.select(key, F.struct(*attributes).alias("_new"))
    since, then = (F.lit(day).cast("date") for day in (first, second))
    nothing, same = F.lit(None).cast("date"), F.col("_old").eqNullSafe(F.col("_new"))

    def version(values: str, valid_from: Column, valid_to: Column) -> Column:
        row = [F.col(f"{values}.{c}").alias(c) for c in attributes]
        current = valid_to.isNull().alias("is_current")
        return F.struct(*row, valid_from.alias("valid_from"), valid_to.alias("valid_to"), current)

    versions = F.array(
        F.when(F.col("_old").isNotNull(), version("_old", since, F.when(same, nothing).otherwise(then))),
        F.when(F.col("_new").isNotNull() & ~same, version("_new", then, nothing)),
    )
    joined = old.join(new, key, "full_outer")
    return joined.select(key, F.inline(F.filter(versions, lambda v: v.isNotNull())))
