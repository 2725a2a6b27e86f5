"""Reports that are merged from the states of several sets of trips."""

from __future__ import annotations

import pytest
from pyspark.sql import functions as F

from farelake.operators import clean, enrich, reports
from farelake.plans import fixture


@pytest.fixture(scope="module")
def trips(spark, small_tables):
    found = enrich.enrich_trips(clean.clean_trips(fixture.raw_trips(spark, small_tables), keyed=False)).persist()
    yield found
    found.unpersist()


def rows_of(df):
    return sorted(map(repr, df.collect()))


@pytest.mark.parametrize("name", sorted(reports.REPORTS))
def test_merged_states_equal_the_whole(spark, trips, name):
    report = reports.REPORTS[name]()
    whole = rows_of(report.of(trips))
    monthly = report.state(trips)
    assert rows_of(report.finish(report.merge(monthly))) == whole
    # Any division: by year, and rows of one month in different parts.
    parts = [report.state(trips.where(f"pmod(hash(pickup_at, total_amount), 3) = {i}")) for i in range(3)]
    united = parts[0].unionByName(parts[1]).unionByName(parts[2])
    assert rows_of(report.finish(report.merge(united))) == whole


@pytest.mark.parametrize("name", sorted(reports.REPORTS))
def test_states_of_no_trips(trips, name):
    report = reports.REPORTS[name]()
    nothing = report.state(trips.where("false"))
    assert report.finish(report.merge(nothing)).collect() == []


def test_distinct_days_over_months_and_zones(trips):
    report = reports.locations_stats()
    found = {r.location_id: r.active_days for r in report.finish(report.merge(report.state(trips))).collect()}
    counted = trips.groupBy("pickup_location_id").agg(F.countDistinct("pickup_date").alias("n")).collect()
    assert found == {r.pickup_location_id: r.n for r in counted}


def test_a_hot_key_reaches_the_shuffle_as_one_row_per_task(trips):
    plan = reports.locations_stats().of(trips)._jdf.queryExecution().executedPlan().toString()
    assert plan.count("Expand") == 0 and "partial_bit_or" in plan


def test_large_amounts_in_a_report(raw):
    """An unchecked tip of 1e13, and one that is no number, change their own zone's sums only."""
    changes = [{"tip_amount": 1e13}, {"tip_amount": 2.0}, {"tip_amount": float("nan"), "pickup_location_id": 11}, {"pickup_location_id": 12}]
    found = {r.location_id: r for r in reports.location_stats(enrich.enrich_trips(clean.clean_trips(raw(*changes), keyed=False))).collect()}
    assert found[10].total_tips == 1e13 + 2 and found[10].total_revenue == 26.6
    assert found[11].total_tips != found[11].total_tips and found[11].total_revenue == 13.3
    assert found[12].total_tips == 2.0
