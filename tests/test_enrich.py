from __future__ import annotations

import datetime as dt
import math
import random
from decimal import ROUND_HALF_UP, Decimal

import pytest
from pyspark.sql import functions as F

from farelake.functions import buckets, calendar
from farelake.functions.keys import NULL_PART, surrogate_key
from farelake.functions.numeric import money_mean, percent, ratio, round_to, total
from farelake.operators.clean import clean_trips
from farelake.operators.enrich import enrich_trips

AT = dt.datetime(2022, 1, 3, 12, 0)


def enriched(raw, column, values):
    rows = raw(*({column: value, "pickup_location_id": i} for i, value in enumerate(values)))
    return enrich_trips(clean_trips(rows, keyed=False)).orderBy("pickup_location_id").collect()


def test_duration_labels_truncate_to_minutes(raw):
    elapsed = [59, 599, 600, 1859, 1860, 3659, 3660]
    rows = enriched(raw, "dropoff_datetime", [AT + dt.timedelta(seconds=s) for s in elapsed])
    assert [r.trip_duration_category for r in rows] == [
        "Quick", "Quick", "Average", "Average", "Extended", "Extended", "Long Haul",
    ]
    assert [r.trip_duration_minutes for r in rows] == [0, 9, 10, 30, 31, 60, 61]
    assert [r.trip_duration_seconds for r in rows] == elapsed


def test_sub_second_trip_has_no_speed(raw):
    (row,) = enriched(raw, "dropoff_datetime", [AT + dt.timedelta(milliseconds=400)])
    assert (row.trip_duration_seconds, row.avg_speed_mph, row.revenue_per_hour) == (0, None, None)


def test_distance_labels(raw):
    rows = enriched(raw, "trip_distance", [1.99, 2.0, 10.0, 10.01])
    assert [r.trip_distance_category for r in rows] == ["Short", "Medium", "Medium", "Long"]


def test_party_labels(raw):
    rows = enriched(raw, "passenger_count", [0, 1, 2, 3, 4, None, -1])
    assert [r.passenger_category for r in rows] == [
        "Unknown", "Solo", "Small Group", "Small Group", "Large Group", "Unknown", "Unknown",
    ]


def test_time_of_day_labels(raw):
    hours = [0, 5, 6, 9, 10, 15, 16, 19, 20, 23]
    rows = raw(
        *(
            {"pickup_datetime": AT.replace(hour=h), "dropoff_datetime": AT.replace(hour=h, minute=59),
             "pickup_location_id": i}
            for i, h in enumerate(hours)
        )
    )
    out = enrich_trips(clean_trips(rows, keyed=False)).orderBy("pickup_location_id").collect()
    assert [r.time_of_day_bucket for r in out] == [
        "Late Night", "Late Night", "Morning Rush", "Morning Rush", "Midday", "Midday",
        "Evening Rush", "Evening Rush", "Night", "Night",
    ]


def test_measures(raw):
    (row,) = enriched(raw, "fare_amount", [10.0])
    assert row.fare_per_mile == 2.0
    assert row.tip_percentage == 20.0
    assert row.avg_speed_mph == pytest.approx(15.0)
    assert row.revenue_per_hour == pytest.approx(39.9)
    assert row.total_surcharges == pytest.approx(1.3)


def test_zero_fare_has_no_tip_percentage(raw):
    assert enriched(raw, "fare_amount", [0.0])[0].tip_percentage is None


def test_surcharge_sum_is_null_if_a_part_is(raw):
    assert enriched(raw, "mta_tax", [None])[0].total_surcharges is None


def test_shape(raw):
    out = enrich_trips(clean_trips(raw({})))
    assert len(out.columns) == 39


def test_tip_labels(spark):
    values = [None, 0.0, 9.99, 10.0, 20.0, 20.01, -5.0]
    df = spark.createDataFrame([(i, v) for i, v in enumerate(values)], "i int, p double")
    out = [r[0] for r in df.orderBy("i").select(buckets.tip(F.col("p"))).collect()]
    assert out == [
        "Zero Tip", "Zero Tip", "Low (<10%)", "Standard (10-20%)", "Standard (10-20%)",
        "Generous (>20%)", "Generous (>20%)",
    ]


def test_calendar_against_python(spark):
    days = [dt.date(1995, 1, 1) + dt.timedelta(days=i) for i in range(0, 11_688)]
    df = spark.createDataFrame([(d,) for d in days], "d date")
    at = F.col("d")
    rows = df.select(
        "d",
        calendar.day_of_week(at).alias("number"),
        calendar.day_name(at).alias("name"),
        calendar.sunday_week(at).alias("week"),
        calendar.iso_year_week(at).alias("iso"),
        calendar.year_month(at).alias("month"),
        calendar.is_weekend_day(calendar.day_of_week(at)).alias("weekend"),
    ).collect()
    for r in rows:
        assert r.number == r.d.isoweekday() % 7 + 1
        assert r.name == r.d.strftime("%A")
        assert r.week == int(r.d.strftime("%U"))
        assert r.iso == r.d.strftime("%G-W%V")
        assert r.month == r.d.strftime("%Y-%m")
        assert r.weekend == (r.d.isoweekday() >= 6)


def test_known_weeks(spark):
    df = spark.createDataFrame([(dt.date(2022, 1, 1),), (dt.date(2022, 3, 31),)], "d date")
    at = F.col("d")
    out = df.orderBy("d").select(calendar.sunday_week(at), calendar.iso_year_week(at)).collect()
    assert [tuple(r) for r in out] == [(0, "2021-W52"), (13, "2022-W13")]


def test_rounding(spark):
    values = [1.005, 2.675, -1.005, 0.1 + 0.2, float("inf"), float("nan"), 1e300, None]
    df = spark.createDataFrame([(i, v) for i, v in enumerate(values)], "i int, x double")
    out = [r[0] for r in df.orderBy("i").select(round_to(F.col("x"), 2)).collect()]
    assert out[:5] == [1.01, 2.68, -1.01, 0.3, float("inf")]
    assert out[5] != out[5] and out[6] == 1e300 and out[7] is None


def test_rounding_against_decimals(spark):
    rng = random.Random(7)
    values = [rng.uniform(-1e6, 1e6) for _ in range(2000)] + [k / 200 for k in range(-400, 400)]
    df = spark.createDataFrame([(v,) for v in values], "x double")
    twelve, two = Decimal("0.000000000001"), Decimal("0.01")
    for value, rounded in df.select("x", round_to(F.col("x"), 2)).collect():
        exact = Decimal(repr(value)).quantize(twelve, ROUND_HALF_UP).quantize(two, ROUND_HALF_UP)
        assert rounded == float(exact)


def test_rounding_happens_once(spark):
    df = spark.createDataFrame([(1.0049996,), (2.3449997,)], "x double")
    assert [r[0] for r in df.select(round_to(F.col("x"), 2)).collect()] == [1.0, 2.34]


def test_large_totals_are_exact(spark):
    df = spark.range(1_500_000).selectExpr("cast(1000000 + (id % 100) / 100D as double) as x")
    sums = {df.repartition(n).agg(total("x")).first()[0] for n in (1, 3, 8)}
    assert sums == {1_500_000 * 1_000_000 + 15_000 * 49.5}


def test_sums_do_not_depend_on_the_order(spark):
    df = spark.range(20_000).selectExpr("(id * 7919 % 100003) / 100D as x")
    sums = {df.repartition(n, (F.col("x") * n).cast("int")).agg(total("x")).first()[0] for n in (1, 2, 5, 9, 16)}
    assert len(sums) == 1


def test_elapsed_time_is_truncated_toward_zero(spark):
    df = spark.createDataFrame([(i, ms) for i, ms in enumerate([400, -400, 59_999, 60_000, -90_400])], "i int, ms int")
    start = F.lit("2022-03-13 01:59:30").cast("timestamp_ntz")
    seconds = calendar.elapsed_seconds(start, start + F.make_dt_interval(secs=F.col("ms") / 1000))
    out = df.orderBy("i").select(seconds, calendar.whole_minutes(seconds)).collect()
    assert [tuple(r) for r in out] == [(0, 0), (0, 0), (59, 0), (60, 1), (-90, -1)]


def test_ratio_and_percent(spark):
    df = spark.createDataFrame([(1.0, 0.0), (1.0, 3.0), (None, 3.0)], "a double, b double")
    out = df.select(ratio(F.col("a"), F.col("b")), percent(F.col("a"), F.col("b"))).collect()
    assert [r[1] for r in out] == [None, 33.3, None]
    assert out[0][0] is None and out[1][0] == 1.0 / 3.0


def test_surrogate_key(spark):
    import hashlib

    row = spark.sql("select 7L as n, cast(null as string) as s").select(
        surrogate_key(F.col("n")), surrogate_key(F.col("n"), F.col("s"))
    ).first()
    assert row[0] == hashlib.md5(b"7").hexdigest()
    assert row[1] == hashlib.md5(f"7-{NULL_PART}".encode()).hexdigest()


def test_labels_need_a_rule_each():
    with pytest.raises(ValueError):
        buckets.label([], ("a", "b"))


LARGE = [13.25, 1e12, 1e13, -2.5e12, 1e300, float("nan"), float("inf"), -1e300, 1e31, 1e9, 999_999_999.99, None]


@pytest.mark.parametrize("n", range(2, len(LARGE) + 1))
def test_large_amounts_neither_fail_nor_get_lost(spark, n):
    """Up to 1e25 and more, a sum of doubles of whole dollars is exact enough to compare with."""
    values = LARGE[:n]
    df = spark.createDataFrame([(v, i % 3) for i, v in enumerate(values)], "x double, k int").repartition(3)
    row = df.agg(total("x").alias("t"), money_mean("x").alias("m")).first()
    known = [v for v in values if v is not None]
    expected = math.fsum(known) if all(map(math.isfinite, known)) else sum(known)
    assert row["t"] == pytest.approx(expected, nan_ok=True, rel=1e-12)
    assert row["m"] == pytest.approx(expected / len(known), nan_ok=True, rel=1e-12)


def test_no_amounts_have_no_total(spark):
    df = spark.createDataFrame([(None, 1), (0.0, 2)], "x double, k int")
    assert sorted(map(tuple, df.groupBy("k").agg(total("x"), money_mean("x")).collect())) == [(1, None, None), (2, 0.0, 0.0)]
