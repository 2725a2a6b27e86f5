"""The derived trips against the counts stated in FIXTURES.md for scale 0.01."""

from __future__ import annotations

import pytest
from pyspark.sql import functions as F

from farelake.functions import buckets
from farelake.operators import clean, enrich, quality, reports
from farelake.plans import fixture

TABLES = "/root/testdata/sf0.01"


@pytest.fixture(scope="module")
def raw(spark):
    rows = fixture.raw_trips(spark, TABLES).persist()
    yield rows
    rows.unpersist()


@pytest.fixture(scope="module")
def trips(raw):
    rows = enrich.enrich_trips(clean.clean_trips(raw, keyed=False)).persist()
    yield rows
    rows.unpersist()


def test_rejects(raw):
    miles, total = F.col("trip_distance"), F.col("total_amount")
    counts = raw.agg(
        F.count(F.lit(1)),
        F.count_if("_deleted"),
        F.count_if(F.col("dropoff_datetime") <= F.col("pickup_datetime")),
        F.count_if(miles == 0),
        F.count_if(miles >= 500),
        F.count_if(F.col("fare_amount") < 0),
        F.count_if(total <= 0),
    ).first()
    assert tuple(counts) == (60_000, 207, 422, 603, 103, 413, 411)
    assert clean.live_rows(raw).count() == 59_793


@pytest.mark.parametrize(
    "label, expected",
    [
        (
            "time_of_day_bucket",
            {"Evening Rush": 9499, "Late Night": 14607, "Midday": 14820, "Morning Rush": 9721, "Night": 9627},
        ),
        ("trip_distance_category", {"Short": 5845, "Medium": 25729, "Long": 26700}),
        ("trip_duration_category", {"Quick": 8358, "Average": 17634, "Extended": 25036, "Long Haul": 7246}),
        ("passenger_category", {"Solo": 9188, "Small Group": 16359, "Large Group": 16332, "Unknown": 16395}),
        ("rate_code_id", {1: 9413, 2: 9163, 3: 9192, 4: 9444, 5: 9261, 6: 9433, 99: 2368}),
        ("payment_type_id", {1: 11430, 2: 11672, 3: 11809, 4: 11672, 5: 11691}),
        ("store_and_fwd_flag", {None: 19460, "N": 19351, "Y": 19463}),
    ],
)
def test_groups(trips, label, expected):
    assert {r[label]: r["count"] for r in trips.groupBy(label).count().collect()} == expected


def test_tips(trips):
    counts = trips.groupBy(buckets.tip(F.col("tip_percentage")).alias("tip")).count().collect()
    assert {r.tip: r["count"] for r in counts} == {
        "Zero Tip": 47297, "Low (<10%)": 3604, "Standard (10-20%)": 3702, "Generous (>20%)": 3671,
    }


def test_violations(trips):
    counts = trips.agg(
        F.count(F.lit(1)),
        F.count_if(F.col("pickup_location_id") > 263),
        F.count_if(F.col("vendor_id") == 5),
        F.count_if(quality.over_speed_limit()),
        F.count_if(quality.over_four_hours()),
        F.count_if(quality.no_whole_minute()),
        F.count_if(quality.total_below_fare()),
    ).first()
    assert tuple(counts) == (58_274, 400, 597, 5828, 260, 796, 0)
    assert reports.daily_revenue(trips).count() == 2499
