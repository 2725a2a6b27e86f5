"""The declared checks of the warehouse: 75, of which 11 only warn."""

from __future__ import annotations

from farelake.functions import buckets
from farelake.operators.quality import (
    Check,
    accepted_values,
    grain,
    no_rows,
    no_whole_minute,
    not_null,
    over_four_hours,
    over_speed_limit,
    relationship,
    total_below_fare,
    unique,
)
from farelake.sources import lookups


def _key(table: str, column: str) -> list[Check]:
    return [unique(table, column), *not_null(table, column)]


def lookup_checks() -> list[Check]:
    return [
        *_key("vendors", "vendor_id"),
        *_key("rate_codes", "rate_code_id"),
        *_key("payment_types", "payment_type_id"),
        *_key("zones", "location_id"),
    ]


def clean_checks() -> list[Check]:
    table, codes = "trips_clean", lookups.accepted_codes()
    return [
        *_key(table, "trip_id"),
        *not_null(table, "vendor_id", "pickup_location_id", "dropoff_location_id", "pickup_at", "dropoff_at"),
        *not_null(table, "payment_type_id", "rate_code_id", "total_amount"),
        accepted_values(table, "vendor_id", codes["vendor_id"], "warn"),
        accepted_values(table, "payment_type_id", codes["payment_type_id"], "warn"),
        accepted_values(table, "rate_code_id", codes["rate_code_id"]),
        accepted_values(table, "store_and_fwd_flag", codes["store_and_fwd_flag"], "warn"),
    ]


def enriched_checks() -> list[Check]:
    table = "trips_enriched"
    return [
        *_key(table, "trip_id"),
        accepted_values(table, "trip_distance_category", buckets.DISTANCES),
        accepted_values(table, "trip_duration_category", buckets.DURATIONS),
        accepted_values(table, "passenger_category", buckets.PARTIES),
        accepted_values(table, "time_of_day_bucket", buckets.TIMES_OF_DAY),
    ]


def star_checks() -> list[Check]:
    fact = "fact_trips"
    return [
        *_key(fact, "trip_id"),
        *not_null(fact, "pickup_date", "total_amount", "vendor_id", "pickup_location_id", "dropoff_location_id"),
        *not_null(fact, "payment_type_id", "rate_code_id"),
        *not_null(fact, "trip_distance_category", "trip_duration_category", "passenger_category"),
        relationship(fact, "vendor_id", "dim_vendor", "vendor_id"),
        relationship(fact, "pickup_location_id", "dim_location", "location_id"),
        relationship(fact, "dropoff_location_id", "dim_location", "location_id"),
        relationship(fact, "payment_type_id", "dim_payment_type", "payment_type_id"),
        relationship(fact, "rate_code_id", "dim_rate_code", "rate_code_id"),
        *_key("dim_vendor", "vendor_id"),
        *_key("dim_rate_code", "rate_code_id"),
        accepted_values("dim_rate_code", "rate_category", ("standard", "airport", "negotiated", "group")),
        *_key("dim_payment_type", "payment_type_id"),
        *_key("dim_location", "location_id"),
        accepted_values("dim_location", "zone_category", buckets.ZONE_CATEGORIES),
        *_key("dim_date", "date_day"),
    ]


def report_checks() -> list[Check]:
    return [
        *_key("location_stats", "location_id"),
        *not_null("location_stats", "total_trips"),
        *not_null("zone_performance", "location_id"),
        accepted_values("zone_performance", "direction", ("pickup", "dropoff")),
        *not_null("trip_patterns", "trip_count"),
        *_key("daily_revenue", "pickup_date"),
        *not_null("daily_revenue", "total_revenue"),
        *not_null("payment_tipping", "payment_type_id"),
        accepted_values("payment_tipping", "tip_bucket", buckets.TIPS),
        *not_null("service_analysis", "rate_code_id"),
        accepted_values("service_analysis", "peak_category", buckets.PEAKS),
    ]


def rule_checks() -> list[Check]:
    fact = "fact_trips"
    return [
        grain("fact_grain_unique", fact, "trip_id"),
        no_rows("revenue_consistency", fact, total_below_fare),
        no_rows("positive_duration", fact, no_whole_minute, "warn"),
        no_rows("duration_range", fact, over_four_hours, "warn"),
        no_rows("speed", fact, over_speed_limit, "warn"),
    ]


def all_checks() -> list[Check]:
    return [
        *lookup_checks(),
        *clean_checks(),
        *enriched_checks(),
        *star_checks(),
        *report_checks(),
        *rule_checks(),
    ]
