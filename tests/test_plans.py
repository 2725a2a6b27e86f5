"""What the physical plans must and must not contain, over a landing table."""

from __future__ import annotations

import re

import pytest
from conftest import plan_of

from farelake.operators import clean, enrich, star
from farelake.plans import fixture, warehouse
from farelake.schemas import RAW_TRIPS
from farelake.sources import lookups


@pytest.fixture(scope="module")
def landed(spark, small_tables, tmp_path_factory):
    path = str(tmp_path_factory.mktemp("landing") / "trips")
    fixture.raw_trips(spark, small_tables).write.parquet(path)
    return spark.read.schema(RAW_TRIPS).parquet(path)


@pytest.fixture(scope="module")
def made(spark, landed):
    trips = enrich.enrich_trips(clean.clean_trips(landed, keyed=False))
    return warehouse.all_reports(trips, warehouse.Lookups.with_zones(spark, fixture.zones(spark)), fixture.AS_OF)


REPORTS = (
    "location_stats location_stats_plain zone_performance trip_patterns daily_revenue payment_tipping service_analysis"
).split()


@pytest.mark.parametrize("name", REPORTS)
def test_reports_aggregate_before_they_shuffle(made, name):
    plan = plan_of(made[name])
    assert "partial_count" in plan
    assert plan.count("FileScan parquet") == 1
    for unwanted in ("SortMergeJoin", "CartesianProduct", "BroadcastNestedLoopJoin", "Python", "ObjectHashAggregate"):
        assert unwanted not in plan
    # Below the first shuffle there is only the scan, projections, filters and the partial aggregation.
    lowest = plan[plan.rindex("Exchange hashpartitioning"):]
    assert "partial_count" in lowest and "Join" not in lowest[: lowest.index("FileScan")]


@pytest.mark.parametrize("name", REPORTS)
def test_filters_reach_the_scan(made, name):
    pushed = re.search(r"PushedFilters: \[(.*?)\], ReadSchema", plan_of(made[name])).group(1)
    for part in ("EqualTo(_deleted,false)", "GreaterThan(trip_distance,0.0)", "LessThan(total_amount,10000.0)"):
        assert part in pushed or part.replace("EqualTo(_deleted,false)", "Not(EqualTo(_deleted,true))") in pushed


def test_unused_columns_are_not_read(made):
    schema = re.search(r"ReadSchema: struct<(.*?)>", plan_of(made["service_analysis"])).group(1)
    assert "vendor_id" not in schema and "mta_tax" not in schema and "store_and_fwd_flag" not in schema


def test_fact_joins_broadcast_known_small_lookups(spark, landed):
    fact = star.build_fact(
        enrich.enrich_trips(clean.clean_trips(landed)),
        lookups.vendors(spark), lookups.payment_types(spark), lookups.rate_codes(spark), fixture.AS_OF,
    )
    plan = plan_of(fact)
    assert plan.count("BroadcastHashJoin") == 4 and "SortMergeJoin" not in plan
    # The only single-partition exchange is over one row per range partition.
    for place in [m.start() for m in re.finditer("Exchange SinglePartition", plan)]:
        assert "HashAggregate(keys=[_part" in "".join(plan[place:].split("\n")[1:3])


def test_a_large_lookup_is_not_broadcast(spark, landed):
    trips = enrich.enrich_trips(clean.clean_trips(landed, keyed=False)).withColumnRenamed("synced_at", "trip_id")
    trips = trips.withColumn("synced_at", trips["pickup_at"])
    vendors = spark.range(5_000_000).selectExpr("id as vendor_id", "cast(id as string) as vendor_name")
    fact = star.build_fact(trips, vendors, lookups.payment_types(spark), lookups.rate_codes(spark), fixture.AS_OF)
    assert "SortMergeJoin" in plan_of(fact)


def method_sizes(spark, df):
    """Bytecode sizes of the largest generated methods, one per stage."""
    debug = spark._jvm.java.lang.Class.forName("org.apache.spark.sql.execution.debug.package$")
    stages = debug.getField("MODULE$").get(None).codegenStringSeq(df._jdf.queryExecution().executedPlan())
    return [stages.apply(i)._3().maxMethodCodeSize() for i in range(stages.size())]


def test_generated_methods_stay_compilable(spark, landed):
    """The JVM does not compile methods beyond 8000 bytes, and an interpreted one is many times slower."""
    spark.conf.set("spark.sql.adaptive.enabled", "false")  # shows the whole plan up front
    try:
        known = warehouse.Lookups.with_zones(spark, fixture.zones(spark))
        trips = enrich.enrich_trips(clean.clean_trips(landed, keyed=False))
        keyed = enrich.enrich_trips(clean.clean_trips(landed))
        fact = star.build_fact(keyed, known.vendors, known.payment_types, known.rate_codes, fixture.AS_OF)
        for df in (trips, keyed, fact, *warehouse.all_reports(trips, known, fixture.AS_OF).values()):
            assert max(method_sizes(spark, df)) < 8000
    finally:
        spark.conf.set("spark.sql.adaptive.enabled", "true")
