from __future__ import annotations

import datetime as dt
import random
import statistics
from collections import defaultdict

import pytest
from pyspark.sql import functions as F

from farelake.operators import clean, enrich, reports, star
from farelake.plans import catalog, fixture
from farelake.sources import lookups

AT = dt.datetime(2022, 1, 3, 12, 0)


@pytest.fixture(scope="module")
def small(spark, small_tables):
    """Enriched trips of the smallest tables, and the same as Python rows."""
    trips = enrich.enrich_trips(clean.clean_trips(fixture.raw_trips(spark, small_tables), keyed=False)).persist()
    yield trips, trips.collect()
    trips.unpersist()


@pytest.fixture(scope="module")
def locations(spark):
    return star.location_dim(fixture.zones(spark))


def trips_of(raw, *changes):
    return enrich.enrich_trips(clean.clean_trips(raw(*changes), keyed=False))


def avg(values, digits):
    values = [v for v in values if v is not None]
    return pytest.approx(sum(values) / len(values), abs=0.51 * 10**-digits) if values else None


def test_location_stats_by_hand(small, locations):
    trips, rows = small
    by_zone = defaultdict(list)
    for r in rows:
        by_zone[r.pickup_location_id].append(r)
    out = {r.location_id: r for r in reports.location_stats(trips, locations, "2022-01-01 00:00:00").collect()}
    assert out.keys() == by_zone.keys()
    for zone, group in by_zone.items():
        r = out[zone]
        assert r.total_trips == len(group)
        assert r.active_days == len({g.pickup_date for g in group})
        assert r.total_revenue == pytest.approx(sum(g.total_amount for g in group), abs=0.006)
        assert r.avg_passengers == avg([g.passenger_count for g in group], 1)
        assert r.avg_tip_percentage == avg([g.tip_percentage for g in group], 1)
        assert r.weekend_trips + r.weekday_trips == r.total_trips
        assert r.credit_card_trips == sum(g.payment_type_id == 1 for g in group)
        assert r.weekend_trip_pct == pytest.approx(100 * r.weekend_trips / r.total_trips, abs=0.051)
    revenue = {z: sum(g.total_amount for g in group) for z, group in by_zone.items()}
    for zone, r in out.items():
        assert r.trip_volume_rank == 1 + sum(len(g) > r.total_trips for g in by_zone.values())
        assert abs(r.revenue_rank - 1 - sum(v > revenue[zone] + 1e-9 for v in revenue.values())) == 0
    assert len(next(iter(out.values()))) == 24


def test_plain_location_stats_lack_only_the_zone_columns(small, locations):
    trips, _ = small
    full = reports.location_stats(trips, locations, "2022-01-01 00:00:00")
    plain = reports.location_stats(trips, as_of="2022-01-01 00:00:00")
    assert len(plain.columns) == 20
    assert sorted(full.select(plain.columns).collect()) == sorted(plain.collect())


def test_equal_revenue_shares_a_rank(raw):
    trips = trips_of(raw, *({"pickup_location_id": z, "total_amount": t} for z, t in ((1, 20.0), (2, 20.0), (3, 5.0))))
    ranks = {r.location_id: r.revenue_rank for r in reports.location_stats(trips).collect()}
    assert ranks == {1: 1, 2: 1, 3: 3}


def test_rank_does_not_depend_on_the_order_of_trips(raw):
    amounts = [(1, x) for x in (0.1, 0.2, 0.3)] + [(2, x) for x in (0.3, 0.2, 0.1)]
    trips = trips_of(raw, *({"pickup_location_id": z, "total_amount": t, "fare_amount": 0.05} for z, t in amounts))
    assert {r.revenue_rank for r in reports.location_stats(trips).collect()} == {1}


def test_zone_performance_halves(small, locations):
    trips, rows = small
    out = reports.zone_performance(trips, locations).collect()
    for direction in ("pickup", "dropoff"):
        counted = {r.location_id: r.trip_count for r in out if r.direction == direction}
        expected = defaultdict(int)
        for r in rows:
            expected[r[f"{direction}_location_id"]] += 1
        assert counted == dict(expected)
    assert len(out[0]) == 15


def test_zone_performance_keeps_null_and_orphan_zones(raw, locations):
    trips = trips_of(raw, {"pickup_location_id": None, "dropoff_location_id": 999}, {"dropoff_location_id": None})
    out = {(r.direction, r.location_id): r for r in reports.zone_performance(trips, locations).collect()}
    assert {k: r.trip_count for k, r in out.items()} == {
        ("pickup", None): 1, ("pickup", 10): 1, ("dropoff", 999): 1, ("dropoff", None): 1,
    }
    assert out["dropoff", 999].zone_category is None and out["pickup", 10].zone_name == "Zone 10"


def test_daily_revenue_shares_come_from_rounded_sums(raw):
    trips = trips_of(
        raw, *({"fare_amount": 3.333, "tip_amount": 0.004, "tolls_amount": 0.0, "total_amount": 10.0} for _ in range(3))
    )
    (row,) = reports.daily_revenue(trips).collect()
    assert (row.total_base_fare, row.total_tips, row.total_surcharges) == (10.0, 0.01, 3.9)
    assert (row.base_fare_pct, row.tip_pct, row.tolls_pct, row.surcharges_pct) == (33.3, 0.0, 0.0, 13.0)
    assert (row.pickup_date, row.pickup_week, row.pickup_day_name) == (dt.date(2022, 1, 3), 1, "Monday")
    assert len(row) == 20


def test_trip_patterns_dependent_keys(small):
    trips, rows = small
    out = reports.trip_patterns(trips).collect()
    expected = defaultdict(int)
    for r in rows:
        expected[
            r.pickup_day_of_week, r.pickup_day_name, r.pickup_hour, r.time_of_day_bucket, r.is_weekend,
            r.trip_distance_category, r.passenger_category,
        ] += 1
    assert {tuple(r)[:7]: r.trip_count for r in out} == dict(expected)
    assert [(r.pickup_day_of_week, r.pickup_hour) for r in out] == sorted(
        (r.pickup_day_of_week, r.pickup_hour) for r in out
    )
    assert len(out[0]) == 15


def test_payment_tipping(spark, small):
    trips, rows = small
    out = reports.payment_tipping(trips, lookups.payment_types(spark)).collect()
    assert len(out[0]) == 12
    shares, counts = defaultdict(float), defaultdict(int)
    for r in out:
        shares[r.payment_type_id] += r.pct_within_payment_type
        counts[r.payment_type_id] += r.trip_count
    segments = len(out) / len(shares)
    assert all(share == pytest.approx(100, abs=0.05 * segments) for share in shares.values())
    assert sum(counts.values()) == len(rows)
    assert {r.tip_bucket for r in out} == {"Zero Tip", "Low (<10%)", "Standard (10-20%)", "Generous (>20%)"}
    order = [(r.payment_type_id, r.time_of_day_bucket, r.is_weekend) for r in out]
    assert order == sorted(order)


def test_congestion_counts_trips_without_speed_in_the_divisor_only(spark, raw):
    end = [AT + dt.timedelta(milliseconds=400), AT + dt.timedelta(hours=1), AT + dt.timedelta(minutes=20)]
    trips = trips_of(raw, *({"dropoff_datetime": e} for e in end))
    (row,) = reports.service_analysis(trips, lookups.rate_codes(spark)).collect()
    # Speeds: none, 5 mph, 15 mph.
    assert (row.trip_count, row.congestion_pct, row.avg_speed_mph) == (3, 33.3, 10.0)
    assert (row.rate_code_name, row.peak_category, row.is_weekend) == ("Standard rate", "Off-Peak", False)
    assert len(row) == 13


def test_kpis_and_shares(spark, small):
    trips, rows = small
    kpi = reports.kpi_summary(trips).first()
    assert kpi.total_trips == len(rows)
    assert kpi.avg_fare == avg([r.fare_amount for r in rows], 2)
    share = reports.payment_share(trips, lookups.payment_types(spark)).collect()
    assert sum(r.trip_count for r in share) == len(rows)
    assert sum(r.trip_pct for r in share) == pytest.approx(100, abs=0.3)


def test_weekly_revenue_adds_up_days(small):
    trips, _ = small
    days = reports.daily_revenue(trips)
    weeks = reports.weekly_revenue(days).collect()
    daily = days.collect()
    assert sum(w.days for w in weeks) == len(daily) and all(w.days <= 7 for w in weeks)
    assert sum(w.trip_count for w in weeks) == sum(d.trip_count for d in daily)
    assert sum(w.total_revenue for w in weeks) == pytest.approx(sum(d.total_revenue for d in daily))


def test_top_zones(small, locations):
    trips, _ = small
    report = reports.zone_performance(trips, locations)
    top = [(r.location_id, r.total_revenue) for r in reports.top_zones(report, 5).collect()]
    best = sorted(((-r.total_revenue, r.location_id) for r in report.where("direction = 'pickup'").collect()))[:5]
    assert top == [(zone, -revenue) for revenue, zone in best]


def test_reports_from_an_empty_fact(spark, raw, locations):
    none = trips_of(raw, {"_deleted": True})
    assert reports.zone_performance(none, locations).count() == 0
    assert reports.location_stats(none, locations).count() == 0
    assert reports.kpi_summary(none).first().total_trips == 0


def test_stand_in_zones_reach_every_category(locations):
    counts = {r.zone_category: r["count"] for r in locations.groupBy("zone_category").count().collect()}
    assert set(counts) == {"Airport", "Manhattan Core", "Manhattan Other", "Outer Borough", "Other"}
    assert sum(counts.values()) == 263 and counts["Airport"] == 3 and counts["Other"] == 6


def test_entry_runs(spark):
    import __spark_entry__

    out = __spark_entry__.entry(spark)
    assert out.columns == catalog.zone_performance(spark, "/root/testdata/sf0.001").columns and out.count() > 0


def test_daily_anomalies_against_statistics(spark):
    rng = random.Random(3)
    amounts = [round(rng.uniform(900, 1100), 2) for _ in range(60)]
    amounts[40] = 5000.0
    rows = [(dt.date(2022, 1, 1) + dt.timedelta(days=i), a) for i, a in enumerate(amounts)]
    partials = spark.createDataFrame(rows, "pickup_date date, total_revenue double")
    partials = partials.withColumn("total_revenue", F.col("total_revenue").cast("decimal(28,6)"))
    out = reports.daily_anomalies(partials).orderBy("pickup_date").collect()
    for i, row in enumerate(out):
        before = amounts[max(0, i - 28) : i]
        assert row.days_before == len(before)
        if len(before) < 2:
            assert row.mean_before is None and not row.is_anomaly
            continue
        mean, deviation = statistics.mean(before), statistics.stdev(before)
        assert abs(row.mean_before - mean) < 0.011 and abs(row.deviation_before - deviation) < 0.011
        assert row.is_anomaly == (abs(amounts[i] - mean) > 3 * deviation)
    assert out[40].is_anomaly


def test_routes_add_up(small, locations):
    trips, rows = small
    out = reports.route_revenue(trips, locations).collect()
    assert sum(r.trip_count for r in out) == len(rows)
    assert len(out) == len({(r.pickup_location_id, r.dropoff_location_id) for r in rows})
