from __future__ import annotations

import datetime as dt

import pytest
from conftest import plan_of
from test_star import make_fact

from farelake.operators import clean, enrich, quality
from farelake.plans import catalog, checks, fixture, warehouse
from farelake.sources import lookups

AT = dt.datetime(2022, 1, 3, 12, 0)
AS_OF = "2022-04-02 00:00:00"


def minutes(n):
    return AT + dt.timedelta(minutes=n)


def test_duplicates_ignore_null(spark):
    df = spark.sql("select * from values (1), (1), (1), (2), (null), (null) as t(k)")
    assert [tuple(r) for r in quality.duplicates(df, "k").collect()] == [(1, 3)]


def test_null_counts(spark):
    df = spark.sql("select * from values (1, null), (null, null), (3, 'x') as t(a, b)")
    assert {tuple(r) for r in quality.null_counts(df, ["a", "b"]).collect()} == {("a", 1), ("b", 2)}


def test_unaccepted_values_pass_null(spark):
    df = spark.sql("select * from values (1), (5), (5), (null) as t(k)")
    assert [tuple(r) for r in quality.unaccepted_values(df, {"k": (1, 2)}).collect()] == [("k", "5", 2)]


def test_orphans_ignore_null(spark):
    child = spark.sql("select * from values (1, 2), (9, 2), (9, 2), (null, 1) as t(fk, other)")
    parent = spark.sql("select * from values (1), (2) as t(id)")
    found = quality.orphans(child, {"fk": (parent, "id"), "other": (parent.where("id = 1"), "id")})
    assert sorted(tuple(r) for r in found.collect()) == [("fk", "9", 2), ("other", "2", 3)]


@pytest.mark.parametrize(
    "hours, status", [(0, "pass"), (24, "pass"), (24.5, "warn"), (48, "warn"), (48.01, "error"), (None, "error")]
)
def test_freshness(spark, raw, hours, status):
    as_of = dt.datetime.fromisoformat(AS_OF)
    rows = raw({"_synced": None if hours is None else as_of - dt.timedelta(hours=hours)}, {"_synced": None})
    row = quality.freshness(rows, AS_OF).first()
    assert row.status == status
    assert row.age_seconds == (None if hours is None else round(hours * 3600))


def test_suite_is_complete():
    suite = checks.all_checks()
    assert len(suite) == 75
    by_name = {}
    for check in suite:
        by_name[check.name] = by_name.get(check.name, 0) + 1
    assert (by_name["unique"], by_name["not_null"], by_name["accepted_values"], by_name["relationships"]) == (
        14, 38, 13, 5,
    )
    assert sum(c.severity == "warn" for c in suite) == 11
    sizes = [len(f()) for f in (checks.lookup_checks, checks.clean_checks, checks.enriched_checks,
                                checks.star_checks, checks.report_checks, checks.rule_checks)]
    assert sizes == [8, 14, 6, 29, 13, 5]


def report_of(spark, rows, zones=None):
    known = warehouse.Lookups.with_zones(spark, fixture.zones(spark) if zones is None else zones)
    enriched = enrich.enrich_trips(clean.clean_trips(rows))
    fact = make_fact(spark, rows)
    dims = warehouse.dimensions(known, fact)
    made = warehouse.all_reports(fact, known, AS_OF)
    tables = warehouse.check_tables(enriched, fact, known, dims, made)
    report = quality.run_checks(spark, tables, checks.all_checks()).collect()
    assert len(report) == 75
    return {(r.check_name, r.table_name, r.column_name): (r.violations, r.status) for r in report if r.violations}


def test_clean_trips_pass_everything(spark, raw):
    assert report_of(spark, raw({}, {"rate_code": None, "payment_type": "2"})) == {}


def test_every_violation_is_found(spark, raw):
    rows = raw(
        {"vendor_id": "5"},
        {"vendor_id": "5"},
        {"vendor_id": "6"},
        {"vendor_id": None},
        {"payment_type": "7"},
        {"rate_code": "42"},
        {"store_and_fwd_flag": "Q"},
        {"store_and_fwd_flag": None},
        {"pickup_location_id": 500},
        {"pickup_location_id": None},
        {"dropoff_location_id": 501},
        {"fare_amount": 50.0},
        {"dropoff_datetime": AT + dt.timedelta(seconds=30), "trip_distance": 0.1},
        {"dropoff_datetime": minutes(241)},
        {"dropoff_datetime": minutes(1), "trip_distance": 2.0},
    )
    fact = "fact_trips"
    assert report_of(spark, rows) == {
        ("not_null", "trips_clean", "vendor_id"): (1, "fail"),
        ("not_null", "trips_clean", "pickup_location_id"): (1, "fail"),
        ("accepted_values", "trips_clean", "vendor_id"): (2, "warn"),
        ("accepted_values", "trips_clean", "payment_type_id"): (1, "warn"),
        ("accepted_values", "trips_clean", "rate_code_id"): (1, "fail"),
        ("accepted_values", "trips_clean", "store_and_fwd_flag"): (1, "warn"),
        ("not_null", fact, "vendor_id"): (1, "fail"),
        ("not_null", fact, "pickup_location_id"): (1, "fail"),
        ("relationships", fact, "vendor_id"): (3, "warn"),
        ("relationships", fact, "payment_type_id"): (1, "warn"),
        ("relationships", fact, "rate_code_id"): (1, "warn"),
        ("relationships", fact, "pickup_location_id"): (1, "warn"),
        ("relationships", fact, "dropoff_location_id"): (1, "warn"),
        ("not_null", "location_stats", "location_id"): (1, "fail"),
        ("not_null", "zone_performance", "location_id"): (1, "fail"),
        ("revenue_consistency", fact, ""): (1, "fail"),
        ("positive_duration", fact, ""): (1, "warn"),
        ("duration_range", fact, ""): (1, "warn"),
        ("speed", fact, ""): (1, "warn"),
    }


def test_repeated_keys_fail(spark):
    df = spark.sql("select * from values ('a'), ('a'), ('b'), (null), (null) as t(trip_id)")
    suite = [quality.unique("t", "trip_id"), quality.grain("grain", "t", "trip_id"), *quality.not_null("t", "trip_id")]
    out = {r.check_name: (r.violations, r.status) for r in quality.run_checks(spark, {"t": df}, suite).collect()}
    assert out == {"unique": (1, "fail"), "grain": (2, "fail"), "not_null": (2, "fail")}


def test_repeated_lookup_key_fails(spark):
    rows = lookups.vendors(spark).unionByName(lookups.vendors(spark).where("vendor_id = 1"))
    out = quality.run_checks(spark, {"vendors": rows}, [quality.unique("vendors", "vendor_id")]).first()
    assert (out.violations, out.status) == (1, "fail")


def test_checks_of_an_empty_table_pass(spark):
    df = spark.sql("select cast(1 as bigint) as k where false")
    suite = [
        quality.unique("t", "k"),
        *quality.not_null("t", "k"),
        quality.accepted_values("t", "k", (1,)),
        quality.relationship("t", "k", "t", "k"),
    ]
    assert {r.status for r in quality.run_checks(spark, {"t": df}, suite).collect()} == {"pass"}


def test_fixture_violations(spark, small_tables):
    """Counts at the smallest scale, from the fixture's own formulas."""
    rows = fixture.raw_trips(spark, small_tables)
    found = report_of(spark, rows)
    assert found["relationships", "fact_trips", "vendor_id"] == (52, "warn")
    assert found["accepted_values", "trips_clean", "vendor_id"] == (1, "warn")
    assert ("unique", "fact_trips", "trip_id") not in found


def test_orphans_of_a_parent_too_large_to_list(spark):
    child = spark.createDataFrame([(1, 7), (1, 7), (2, None), (None, 8), (3, 9)], "fk long, other long")
    parents = {"fk": (spark.createDataFrame([(1,), (1,), (None,)], "id long"), "id"), "other": (spark.range(7, 9), "id")}
    expected = [("fk", "2", 1), ("fk", "3", 1), ("other", "9", 1)]
    for listed in (0, 2, 3, 100):
        assert sorted(tuple(r) for r in quality.orphans(child, parents, listed).collect()) == expected
    empty = {"fk": (spark.range(0), "id")}
    assert sorted(tuple(r) for r in quality.orphans(child, empty).collect()) == [("fk", "1", 2), ("fk", "2", 1), ("fk", "3", 1)]


def test_checks_of_values_and_parents_neither_expand_nor_filter_arrays(spark, small_tables):
    for name in ("dq_accepted_values", "dq_relationships"):
        plan = plan_of(catalog.all_queries()[name](spark, small_tables))
        assert "Expand" not in plan and "lambda" not in plan
        assert plan.count("Scan parquet") == 2  # lines and orders, once
