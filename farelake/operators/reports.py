"""Summary reports over the fact.

They aggregate first, on as few and as narrow keys as determine the group, and attach names and dependent
calendar parts to the small result. Every grouping is partially aggregated before its shuffle, so a key that
holds a large share of the rows reaches the shuffle as one row per task.

``trips`` may be the stored fact or the enriched trips; no report reads ``trip_id``.
"""

from __future__ import annotations

from pyspark.sql import Column, DataFrame, Window
from pyspark.sql import functions as F

from farelake.functions import buckets, calendar
from farelake.functions.calendar import instant
from farelake.functions.numeric import LARGE_AMOUNT, mean, money_mean, percent, round_to, rows, total
from farelake.operators import partials as p
from farelake.operators.partials import Report

_ZONE_COLUMNS = ("zone_name", "borough", "service_zone", "zone_category")


def _rank_down(*columns: str) -> Column:
    """Rank from high to low; the window is global, over one row per zone."""
    return F.rank().over(Window.orderBy(*(F.col(c).desc() for c in columns))).cast("bigint")


# --- what each report counts ---------------------------------------------------------------------------------

def locations_stats() -> Report:
    """Per pickup zone."""
    revenue, revenue_exact = p.exact_total("total_amount")
    return Report(
        {"location_id": F.col("pickup_location_id")},
        {
            "total_trips": p.trips(),
            "active_days": p.distinct_days("pickup_date"),
            "revenue": revenue,
            "revenue_exact": revenue_exact,
            "total_revenue": p.total("total_amount"),
            "avg_trip_revenue": p.money_mean("total_amount"),
            "total_tips": p.total("tip_amount"),
            "avg_trip_distance_miles": p.mean("trip_distance_miles", 2),
            "avg_trip_duration_minutes": p.mean("trip_duration_minutes", 1),
            "avg_passengers": p.mean("passenger_count", 1),
            "weekend_trips": p.count_of("weekend", F.col("is_weekend")),
            "weekday_trips": p.count_of("weekday", ~F.col("is_weekend")),
            "weekend_trip_pct": p.percent(p.count_of("weekend", F.col("is_weekend")), p.trips()),
            "credit_card_trips": p.count_of("card", F.col("payment_type_id") == 1),
            "cash_trips": p.count_of("cash", F.col("payment_type_id") == 2),
            "credit_card_pct": p.percent(p.count_of("card", F.col("payment_type_id") == 1), p.trips()),
            "avg_tip_percentage": p.mean("tip_percentage", 1),
            "avg_fare_per_mile": p.mean("fare_per_mile", 2),
        },
    )


def zones_stats() -> Report:
    """Per zone and side of the trip."""
    return Report(
        {},
        {
            "trip_count": p.trips(),
            "total_revenue": p.total("total_amount"),
            "avg_revenue": p.money_mean("total_amount"),
            "avg_distance": p.mean("trip_distance_miles", 2),
            "avg_duration_minutes": p.mean("trip_duration_minutes", 1),
            "avg_speed_mph": p.mean("avg_speed_mph", 1),
            "avg_revenue_per_hour": p.mean("revenue_per_hour", 2),
            "avg_tip_pct": p.mean("tip_percentage", 1),
            "avg_fare_per_mile": p.mean("fare_per_mile", 2),
        },
        sides={"pickup": "pickup_location_id", "dropoff": "dropoff_location_id"},
    )


def patterns_stats() -> Report:
    """Per day of week, hour, distance and party size."""
    return Report(
        {c: F.col(c) for c in ("pickup_day_of_week", "pickup_hour", "trip_distance_category", "passenger_category")},
        {name: measure for name, measure in zones_stats().measures.items() if name != "avg_fare_per_mile"},
    )


def days_stats() -> Report:
    """Per pickup day."""
    return Report(
        {"pickup_date": F.col("pickup_date")},
        {
            "trip_count": p.trips(),
            "total_base_fare": p.total("fare_amount"),
            "total_tips": p.total("tip_amount"),
            "total_tolls": p.total("tolls_amount"),
            "total_surcharges": p.total("total_surcharges"),
            "total_revenue": p.total("total_amount"),
            "avg_trip_revenue": p.money_mean("total_amount"),
            "avg_fare_per_mile": p.mean("fare_per_mile", 2),
            "avg_tip_pct": p.mean("tip_percentage", 1),
            "avg_revenue_per_hour": p.mean("revenue_per_hour", 2),
        },
    )


def tipping_stats() -> Report:
    """Per payment type, time of day, weekend, distance and tip size."""
    return Report(
        {
            **{c: F.col(c) for c in ("payment_type_id", "time_of_day_bucket", "is_weekend", "trip_distance_category")},
            "tip_bucket": buckets.tip(F.col("tip_percentage")),
        },
        {
            "trip_count": p.trips(),
            "total_revenue": p.total("total_amount"),
            "avg_trip_value": p.money_mean("total_amount"),
            "total_tips": p.total("tip_amount"),
            "avg_tip_pct": p.mean("tip_percentage", 1),
        },
    )


def service_stats() -> Report:
    """Per rate code, peak and weekend."""
    return Report(
        {
            "rate_code_id": F.col("rate_code_id"),
            "peak_category": buckets.peak(F.col("time_of_day_bucket")),
            "is_weekend": F.col("is_weekend"),
        },
        {
            "trip_count": p.trips(),
            "total_revenue": p.total("total_amount"),
            "avg_fare": p.money_mean("total_amount"),
            "avg_distance": p.mean("trip_distance_miles", 2),
            "avg_duration_minutes": p.mean("trip_duration_minutes", 1),
            "avg_speed_mph": p.mean("avg_speed_mph", 1),
            "avg_tip_pct": p.mean("tip_percentage", 1),
            "avg_revenue_per_hour": p.mean("revenue_per_hour", 2),
            # A trip without a speed counts in the divisor only.
            "congestion_pct": p.percent(p.count_of("slow", F.col("avg_speed_mph") < 10), p.trips()),
        },
    )


#: The reports by the name of their states; the two location reports have the same.
REPORTS = {
    "locations": locations_stats,
    "zones": zones_stats,
    "patterns": patterns_stats,
    "days": days_stats,
    "tipping": tipping_stats,
    "service": service_stats,
}


# --- reports straight from trips -----------------------------------------------------------------------------


def location_stats(trips: DataFrame, locations: DataFrame | None = None, as_of: str | None = None) -> DataFrame:
    """Statistics per pickup zone, ranked by exact revenue (before rounding) and by volume.

    Without ``locations`` the zone attributes are left out. ``as_of`` adds the time of the refresh.
    """
    return location_report(locations_stats().of(trips), locations, as_of)


def zone_performance(trips: DataFrame, locations: DataFrame) -> DataFrame:
    """Performance per zone, once as the pickup and once as the dropoff side of its trips.

    Both directions come from one scan and one shuffle: two grouping sets in place of a union of two
    aggregations over the same trips. The zone attributes are joined to the result.
    """
    return zone_report(zones_stats().of(trips), locations)


def trip_patterns(trips: DataFrame) -> DataFrame:
    """Demand by day of week, hour, distance and party size, in calendar order."""
    return pattern_report(patterns_stats().of(trips))


def daily_revenue(trips: DataFrame, ordered: bool = True) -> DataFrame:
    """Revenue per pickup day and the share of each component, by date unless ``ordered`` is off.

    The shares divide the rounded sums, so the four need not add up to 100.
    """
    return day_report(days_stats().of(trips), ordered)


def payment_tipping(trips: DataFrame, payment_types: DataFrame) -> DataFrame:
    """Tipping by payment type, time of day, weekend and distance, with each segment's share of the trips
    paid the same way."""
    return tipping_report(tipping_stats().of(trips), payment_types)


def service_analysis(trips: DataFrame, rate_codes: DataFrame) -> DataFrame:
    """Service by rate code, peak and weekend. Congestion is the share of all trips below 10 mph; a trip
    without a speed counts in the divisor only."""
    return service_report(service_stats().of(trips), rate_codes)


# --- from finished measures to what is shown -----------------------------------------------------------------


def location_report(stats: DataFrame, locations: DataFrame | None = None, as_of: str | None = None) -> DataFrame:
    ranked = stats.withColumns(
        {
            "revenue_rank": _rank_down("revenue", "revenue_exact"),
            "trip_volume_rank": _rank_down("total_trips"),
        }
    )
    zone_columns: tuple[str, ...] = ()
    if locations is not None:
        ranked = ranked.join(locations, "location_id", "left")
        zone_columns = _ZONE_COLUMNS
    refreshed = [] if as_of is None else [instant(as_of).alias("updated_at")]
    return ranked.select(
        "location_id",
        *zone_columns,
        *(c for c in stats.columns if c not in ("location_id", "revenue", "revenue_exact")),
        "revenue_rank",
        "trip_volume_rank",
        *refreshed,
    )


def zone_report(stats: DataFrame, locations: DataFrame) -> DataFrame:
    sided = stats.withColumnsRenamed({"key": "location_id", "side": "direction"})
    return sided.join(locations, "location_id", "left").select(
        "location_id", "direction", *_ZONE_COLUMNS, *stats.columns[2:]
    )


def pattern_report(stats: DataFrame) -> DataFrame:
    number = F.col("pickup_day_of_week")
    return stats.select(
        "pickup_day_of_week",
        calendar.name_of_day(number).alias("pickup_day_name"),
        "pickup_hour",
        buckets.time_of_day(F.col("pickup_hour")).alias("time_of_day_bucket"),
        calendar.is_weekend_day(number).alias("is_weekend"),
        "trip_distance_category",
        "passenger_category",
        *stats.columns[4:],
    ).orderBy("pickup_day_of_week", "pickup_hour")


def day_report(stats: DataFrame, ordered: bool = True) -> DataFrame:
    """One row per day, with calendar parts and component shares added."""
    at = F.col("pickup_date")
    days = stats.select(
        "pickup_date",
        calendar.year(at).alias("pickup_year"),
        calendar.month(at).alias("pickup_month"),
        calendar.sunday_week(at).alias("pickup_week"),
        calendar.day_name(at).alias("pickup_day_name"),
        calendar.is_weekend_day(calendar.day_of_week(at)).alias("is_weekend"),
        *stats.columns[1:],
        *_composition("total_revenue"),
    )
    return days.orderBy("pickup_date") if ordered else days


def _composition(whole: str) -> list[Column]:
    parts = {
        "base_fare_pct": "total_base_fare",
        "tip_pct": "total_tips",
        "tolls_pct": "total_tolls",
        "surcharges_pct": "total_surcharges",
    }
    return [percent(F.col(part), F.col(whole)).alias(name) for name, part in parts.items()]


def tipping_report(stats: DataFrame, payment_types: DataFrame) -> DataFrame:
    of_type = F.sum("trip_count").over(Window.partitionBy("payment_type_id"))
    return (
        stats.withColumn("pct_within_payment_type", round_to(F.col("trip_count") * 100.0 / of_type, 1))
        .join(payment_types.select("payment_type_id", "payment_type_name"), "payment_type_id", "left")
        .select("payment_type_id", "payment_type_name", *stats.columns[1:], "pct_within_payment_type")
        .orderBy("payment_type_id", "time_of_day_bucket", "is_weekend")
    )


def service_report(stats: DataFrame, rate_codes: DataFrame) -> DataFrame:
    return (
        stats.join(rate_codes.select("rate_code_id", "rate_code_name"), "rate_code_id", "left")
        .select("rate_code_id", "rate_code_name", *stats.columns[1:])
        .orderBy("rate_code_id", "peak_category", "is_weekend")
    )


def day_revenue(trips: DataFrame) -> DataFrame:
    """Per pickup day, the unrounded revenue as a decimal (null where it does not fit)."""
    _, exact = p.exact_total("total_amount")
    return Report(days_stats().keys, {"total_revenue": exact}).of(trips)


# --- further queries -----------------------------------------------------------------------------------------


def kpi_summary(trips: DataFrame) -> DataFrame:
    """The headline numbers over all trips."""
    return trips.agg(
        rows().alias("total_trips"),
        total("total_amount").alias("total_revenue"),
        money_mean("fare_amount").alias("avg_fare"),
        mean("tip_percentage", 1).alias("avg_tip_pct"),
    )


def top_zones(performance: DataFrame, k: int, direction: str = "pickup") -> DataFrame:
    """The ``k`` zones with the highest revenue in the zone report; ties go to the lower id."""
    return (
        performance.where(F.col("direction") == direction)
        .select("location_id", *_ZONE_COLUMNS, "trip_count", "total_revenue")
        .orderBy(F.col("total_revenue").desc(), F.col("location_id"))
        .limit(k)
    )


def weekly_revenue(daily: DataFrame) -> DataFrame:
    """The daily report rolled up to calendar weeks (which start on Sunday and end with the year)."""
    weeks = daily.groupBy("pickup_year", "pickup_week").agg(
        rows().alias("days"),
        F.sum("trip_count").alias("trip_count"),
        *(total(c).alias(c) for c in ("total_base_fare", "total_tips", "total_tolls", "total_surcharges")),
        total("total_revenue").alias("total_revenue"),
    )
    average = round_to(F.col("total_revenue") / F.col("trip_count"), 2)
    return weeks.select("*", average.alias("avg_trip_revenue"), *_composition("total_revenue")).orderBy(
        "pickup_year", "pickup_week"
    )


def payment_share(trips: DataFrame, payment_types: DataFrame) -> DataFrame:
    """Each payment type's share of all trips."""
    counts = trips.groupBy("payment_type_id").agg(rows().alias("trip_count"))
    everything = F.sum("trip_count").over(Window.partitionBy())
    return (
        counts.withColumn("trip_pct", round_to(F.col("trip_count") * 100.0 / everything, 1))
        .join(payment_types.select("payment_type_id", "payment_type_name"), "payment_type_id", "left")
        .select("payment_type_id", "payment_type_name", "trip_count", "trip_pct")
        .orderBy("payment_type_id")
    )


def route_revenue(trips: DataFrame, locations: DataFrame) -> DataFrame:
    """Trips and revenue per pair of pickup and dropoff zones that has occurred. Aggregated on the two ids; the zone
    names are attached to the result."""
    stats = trips.groupBy("pickup_location_id", "dropoff_location_id").agg(
        rows().alias("trip_count"),
        total("total_amount").alias("total_revenue"),
        money_mean("total_amount").alias("avg_revenue"),
        mean("trip_distance_miles", 2).alias("avg_distance"),
    )

    def side(name: str) -> DataFrame:
        return locations.select(
            F.col("location_id").alias(f"{name}_location_id"),
            F.col("zone_name").alias(f"{name}_zone"),
            F.col("borough").alias(f"{name}_borough"),
        )

    named = stats.join(side("pickup"), "pickup_location_id", "left").join(side("dropoff"), "dropoff_location_id", "left")
    return named.select(
        *("pickup_location_id", "pickup_zone", "pickup_borough", "dropoff_location_id", "dropoff_zone"),
        *("dropoff_borough", *stats.columns[2:]),
    )


def daily_anomalies(revenue: DataFrame, days: int = 28, deviations: int = 3) -> DataFrame:
    """Days whose revenue is more than ``deviations`` standard deviations away from the mean of the ``days`` days with
    trips before them.

    ``revenue`` has one row per day (``day_revenue``), which bounds the window. Sums of cents and of their squares are
    exact decimals, so the flag does not depend on rounding: it compares squares. Fewer than two days before give none.
    A revenue of a billion or more, or none that fits, is always flagged, and left out of the days before others.
    """
    whole = "decimal(38,0)"
    sane = F.abs("total_revenue") < LARGE_AMOUNT
    cents = F.when(sane, F.round(F.col("total_revenue") * 100)).cast(whole)
    before = Window.orderBy("pickup_date").rowsBetween(-days, -1)
    summed = revenue.select("pickup_date", F.round("total_revenue", 2).cast("double").alias("total_revenue"), cents.alias("x"))
    summed = summed.withColumns(
        {
            "n": F.count("x").over(before),
            "s": F.sum("x").over(before).cast(whole),
            "q": F.sum((F.col("x") * F.col("x")).cast(whole)).over(before).cast(whole),
        }
    )
    n, s, q, x = (F.col(c).cast(whole) for c in ("n", "s", "q", "x"))
    spread = (n * q).cast(whole) - (s * s).cast(whole)
    off = ((n * x).cast(whole) - s).cast(whole)
    far = (off * off).cast(whole) * (n - 1) > F.lit(deviations * deviations) * n * spread
    enough = F.col("n") >= 2
    variance = spread.cast("double") / (n * (n - 1)).cast("double")
    return summed.select(
        "pickup_date",
        "total_revenue",
        F.col("n").alias("days_before"),
        F.when(enough, round_to(s.cast("double") / n.cast("double") / 100.0, 2)).alias("mean_before"),
        F.when(enough, round_to(F.sqrt(variance) / 100.0, 2)).alias("deviation_before"),
        (x.isNull() | (enough & far)).alias("is_anomaly"),
    )
