"""Every registered query: (session, table folder) -> DataFrame."""

from __future__ import annotations

import datetime as dt
import uuid
from collections.abc import Callable
from functools import reduce

from pyspark.sql import DataFrame, SparkSession
from pyspark.sql import functions as F

from farelake.functions import buckets
from farelake.functions.calendar import instant
from farelake.functions.keys import surrogate_key
from farelake.functions.numeric import rows
from farelake.operators import clean, enrich, quality, reports, star
from farelake.plans import fixture, warehouse
from farelake.plans.checks import all_checks
from farelake.plans.settings import (
    CORRECTED_MONTH,
    EXTRACT_END,
    EXTRACT_START,
    HISTORY_FIRST,
    HISTORY_SECOND,
    LAST_MONTH,
    LATE_MONTH,
    MISTAKEN_FROM,
    SAMPLE_KEYS,
    SAMPLE_SHARE,
    SCAN_END,
    SCAN_START,
    SNAPSHOT_DAYS,
    TOP_ZONES,
)
from farelake.schemas import RAW_TRIPS
from farelake.session import materialize, scratch_path, sized_partitions
from farelake.sources import history, landing, lookups, store
from farelake.sources.versions import Versions
from farelake.streaming import daily

Query = Callable[[SparkSession, str], DataFrame]
_NATURAL = ("pickup_at", "dropoff_at", "pickup_location_id")
_registry: dict[str, Query] = {}

#: Of the order lines that the trips of a landed file come from; as trips they are about four times as large.
_LANDED_FILE_BYTES = 32 << 20


def _query(function: Query) -> Query:
    """Register under the function's name; a trailing underscore keeps clear of an import."""
    _registry[function.__name__.rstrip("_")] = function
    return function


def all_queries() -> dict[str, Query]:
    return dict(_registry)


def _trips(spark: SparkSession, sf_dir: str, keyed: bool = False) -> DataFrame:
    """Enriched trips. Only queries that show ``trip_id`` pay for the numbering."""
    return enrich.enrich_trips(clean.clean_trips(fixture.raw_trips(spark, sf_dir), keyed=keyed))


def _fact(spark: SparkSession, sf_dir: str) -> DataFrame:
    known = _known(spark)
    trips = _trips(spark, sf_dir, keyed=True)
    return star.build_fact(trips, known.vendors, known.payment_types, known.rate_codes, fixture.AS_OF)


def _keyed(spark: SparkSession, sf_dir: str, *wanted: str) -> DataFrame:
    """Valid trips with their key and the wanted money, distance and measure columns. The sorted copy that numbers
    them holds only what these and the validity rules read, and no lookup is joined."""
    raw = fixture.raw_trips(spark, sf_dir)
    trips = enrich.timed(clean.clean_trips(raw, keep=clean.RULED))
    made = [name for name in wanted if name not in trips.columns]
    return trips.select("trip_id", *(c for c in wanted if c in trips.columns), *(enrich.measures(*made) if made else []))


def _known(spark: SparkSession) -> warehouse.Lookups:
    return warehouse.Lookups.with_zones(spark, fixture.zones(spark))


def _locations(spark: SparkSession) -> DataFrame:
    return star.location_dim(fixture.zones(spark))


# --- ingest ----------------------------------------------------------------------------------------------


@_query
def range_extract(spark, sf_dir):
    trips = landing.extract_range(fixture.sourced_only(spark, sf_dir), EXTRACT_START, EXTRACT_END)
    return landing.add_sync_columns(trips, fixture.SYNCED_AT)


@_query
def deterministic_sample(spark, sf_dir):
    return landing.sample_share(fixture.sourced_only(spark, sf_dir), SAMPLE_SHARE, SAMPLE_KEYS)


@_query
def load_summary(spark, sf_dir):
    return landing.load_summary(fixture.raw_trips(spark, sf_dir))


# --- clean and enrich ------------------------------------------------------------------------------------


@_query
def clean_trips(spark, sf_dir):
    return clean.clean_trips(fixture.raw_trips(spark, sf_dir))


@_query
def tolerant_cast(spark, sf_dir):
    counts = fixture.raw_trips(spark, sf_dir).groupBy("rate_code").agg(rows().alias("row_count"))
    return counts.withColumn("rate_code_id", clean.rate_code_or_unknown(F.col("rate_code")))


@_query
def global_row_number(spark, sf_dir):
    return clean.number_trips(fixture.raw_trips(spark, sf_dir), keep=clean.ROW_ORDER).select("row_num", *clean.ROW_ORDER)


@_query
def surrogate_key_(spark, sf_dir):
    parts = ("rate_code", "store_and_fwd_flag")
    return clean.number_trips(fixture.raw_trips(spark, sf_dir), keep=parts).select(
        "row_num",
        surrogate_key(F.col("row_num")).alias("trip_id"),
        surrogate_key(F.col("rate_code"), F.col("store_and_fwd_flag")).alias("code_key"),
    )


@_query
def calendar_parts(spark, sf_dir):
    trips = clean.clean_trips(fixture.raw_trips(spark, sf_dir), keyed=False)
    return trips.select(*_NATURAL, *enrich.calendar_parts(F.col("pickup_at")))


@_query
def bucketize(spark, sf_dir):
    trips = clean.clean_trips(fixture.raw_trips(spark, sf_dir), keyed=False)
    return enrich.timed(trips).select(*_NATURAL, *enrich.category_labels())


@_query
def derived_measures(spark, sf_dir):
    trips = clean.clean_trips(fixture.raw_trips(spark, sf_dir), keyed=False)
    return enrich.timed(trips).select(*_NATURAL, *enrich.measures())


# --- star schema -----------------------------------------------------------------------------------------


def _with_usage(dim: DataFrame, key: str, trips: DataFrame, foreign_key: str | None = None) -> DataFrame:
    """A dimension with the number of trips of each member."""
    counts = trips.groupBy(F.col(foreign_key or key).alias(key)).agg(rows().alias("n"))
    return dim.join(counts, key, "left").select(*dim.columns, F.coalesce("n", F.lit(0)).alias("trip_count"))


@_query
def fact_wide(spark, sf_dir):
    return _fact(spark, sf_dir)


@_query
def dim_vendor(spark, sf_dir):
    return _with_usage(star.vendor_dim(lookups.vendors(spark)), "vendor_id", _trips(spark, sf_dir))


@_query
def dim_payment_type(spark, sf_dir):
    dim = star.payment_type_dim(lookups.payment_types(spark))
    return _with_usage(dim, "payment_type_id", _trips(spark, sf_dir))


@_query
def dim_rate_code(spark, sf_dir):
    return _with_usage(star.rate_code_dim(lookups.rate_codes(spark)), "rate_code_id", _trips(spark, sf_dir))


@_query
def dim_location(spark, sf_dir):
    return _with_usage(_locations(spark), "location_id", _trips(spark, sf_dir), "pickup_location_id")


@_query
def date_spine(spark, sf_dir):
    return star.spine_of(_trips(spark, sf_dir))


@_query
def dim_date(spark, sf_dir):
    return star.date_dim(star.spine_of(_trips(spark, sf_dir)))


@_query
def partitioned_fact_scan(spark, sf_dir):
    stored = Versions(spark, scratch_path(spark, "fact"))
    numbered = clean.number_trips(fixture.raw_trips(spark, sf_dir))
    trips = clean.valid_trips(clean.standardize(numbered, keyed=False))
    placed, finish = warehouse.stored_form(trips, _known(spark), fixture.AS_OF)
    store.write_fact(stored, placed, finish=finish)
    return store.read_fact(stored, SCAN_START, SCAN_END)


@_query
def incremental_fact(spark, sf_dir):
    """The fact after a second load: one month was corrected, one arrived by mistake and is gone, and the last were not
    there yet. Only these, and months whose ids have moved, are made again."""
    raw = fixture.raw_trips(spark, sf_dir)
    at = F.col("pickup_datetime")
    landed, out = (Versions(spark, scratch_path(spark, name)) for name in ("landing", "warehouse"))
    corrected = (at >= instant(f"{CORRECTED_MONTH} 00:00:00")) & (at < F.lit(CORRECTED_MONTH).cast("date") + F.expr("interval 1 month"))
    early = raw.where((at < instant(f"{LATE_MONTH} 00:00:00")) & ~(corrected & (F.col("passenger_count") == 2)))
    moved = F.expr("interval 30 years")
    mistaken = raw.where(corrected).withColumns({"pickup_datetime": at + moved, "dropoff_datetime": F.col("dropoff_datetime") + moved})
    landing.load(landed, early.unionByName(mistaken))
    warehouse.refresh_fact(landed, out, _known(spark), fixture.AS_OF)
    wrong = [m for m in landed.parts(landing.LANDING) if m >= MISTAKEN_FROM]
    months = [CORRECTED_MONTH, *_months(LATE_MONTH, LAST_MONTH), *wrong]
    landing.load(landed, raw.where(corrected | (at >= instant(f"{LATE_MONTH} 00:00:00"))), months)
    warehouse.refresh_fact(landed, out, _known(spark), fixture.AS_OF)
    return store.read_fact(out)


def _months(first: str, last: str) -> list[str]:
    start, stop = (dt.date.fromisoformat(m) for m in (first, last))
    count = (stop.year - start.year) * 12 + stop.month - start.month + 1
    return [f"{start.year + (start.month - 1 + i) // 12}-{(start.month - 1 + i) % 12 + 1:02d}-01" for i in range(count)]


@_query
def landing_round_trip(spark, sf_dir):
    """The landing table under its name: part of the trips is loaded and published, then all of them."""
    raw = fixture.raw_trips(spark, sf_dir)
    landed = Versions(spark, scratch_path(spark, "landing"))
    namespace = f"landing_{uuid.uuid4().hex}"
    for trips in (raw.where(F.col("_deleted")), raw):
        landing.load(landed, trips)
        landed.publish(namespace)
    return spark.table(f"{namespace}.{landing.LANDING}").select(*RAW_TRIPS.names)


# --- reports ---------------------------------------------------------------------------------------------


@_query
def location_stats(spark, sf_dir):
    return reports.location_stats(_trips(spark, sf_dir), _locations(spark), fixture.AS_OF)


@_query
def location_stats_plain(spark, sf_dir):
    return reports.location_stats(_trips(spark, sf_dir), as_of=fixture.AS_OF)


@_query
def zone_performance(spark, sf_dir):
    return reports.zone_performance(_trips(spark, sf_dir), _locations(spark))


@_query
def trip_patterns(spark, sf_dir):
    return reports.trip_patterns(_trips(spark, sf_dir))


@_query
def daily_revenue(spark, sf_dir):
    return reports.daily_revenue(_trips(spark, sf_dir))


@_query
def payment_tipping(spark, sf_dir):
    return reports.payment_tipping(_trips(spark, sf_dir), lookups.payment_types(spark))


@_query
def service_analysis(spark, sf_dir):
    return reports.service_analysis(_trips(spark, sf_dir), lookups.rate_codes(spark))


@_query
def kpi_summary(spark, sf_dir):
    return reports.kpi_summary(_trips(spark, sf_dir))


@_query
def top_zones(spark, sf_dir):
    return reports.top_zones(reports.zone_performance(_trips(spark, sf_dir), _locations(spark)), TOP_ZONES)


@_query
def weekly_revenue(spark, sf_dir):
    return reports.weekly_revenue(reports.daily_revenue(_trips(spark, sf_dir), ordered=False))


@_query
def payment_share(spark, sf_dir):
    return reports.payment_share(_trips(spark, sf_dir), lookups.payment_types(spark))


@_query
def daily_revenue_stream(spark, sf_dir):
    """The daily report computed by a stream over the landed trips, which come in several micro-batches of files that
    are not in the order of time, run until it has caught up."""
    source, log, state = (scratch_path(spark, name) for name in ("landing", "days", "state"))
    raw = fixture.raw_trips(spark, sf_dir)
    parts = max(8, sized_partitions(raw, _LANDED_FILE_BYTES))
    raw.repartition(parts, "dropoff_location_id", "pickup_datetime", "dropoff_datetime").write.parquet(source)
    files = len(spark.read.schema(RAW_TRIPS).parquet(source).inputFiles())
    arriving = daily.stream_landing(spark, source, files_per_batch=-(-files // 3))
    daily.keep_current(arriving, log, state).awaitTermination()
    daily.compact(spark, log, state)
    return daily.current_report(spark, log)


@_query
def route_revenue(spark, sf_dir):
    return reports.route_revenue(_trips(spark, sf_dir), _locations(spark))


@_query
def daily_anomalies(spark, sf_dir):
    return reports.daily_anomalies(reports.day_revenue(_trips(spark, sf_dir)))


@_query
def zone_history(spark, sf_dir):
    """How the zones' class changed between the trips before a date and all trips."""
    trips = _trips(spark, sf_dir)
    earlier = star.zone_classes(trips.where(F.col("pickup_date") < F.lit(HISTORY_FIRST).cast("date")), _locations(spark))
    later = star.zone_classes(trips, _locations(spark))
    return star.type_two_history(earlier, later, "location_id", HISTORY_FIRST, HISTORY_SECOND)


@_query
def stored_zone_history(spark, sf_dir):
    """The zones' history kept in a store, over a row of snapshots of the trips before each day."""
    trips = _trips(spark, sf_dir).select("pickup_location_id", "pickup_date").persist()
    stored = Versions(spark, scratch_path(spark, "history"))
    for day in SNAPSHOT_DAYS:
        snapshot = star.zone_classes(trips.where(F.col("pickup_date") < F.lit(day).cast("date")), _locations(spark))
        history.apply_snapshot(stored, "zones", snapshot, "location_id", day)
    trips.unpersist()
    return history.history(stored, "zones", snapshot.schema)


# --- data checks -----------------------------------------------------------------------------------------


@_query
def dq_unique(spark, sf_dir):
    """The key has no duplicates; the pickup time, which is no key, has many."""
    found = {
        "trip_id": quality.duplicates(_keyed(spark, sf_dir), "trip_id"),
        "pickup_at": quality.duplicates(_trips(spark, sf_dir), "pickup_at"),
    }
    parts = [
        df.select(F.lit(key).alias("key_name"), F.col(key).cast("string").alias("key_value"), "row_count")
        for key, df in found.items()
    ]
    return reduce(DataFrame.unionByName, parts)


@_query
def dq_not_null(spark, sf_dir):
    columns = (
        "vendor_id pickup_location_id dropoff_location_id pickup_at dropoff_at passenger_count payment_type_id "
        "rate_code_id store_and_fwd_flag total_amount tip_percentage avg_speed_mph"
    ).split()
    return quality.null_counts(_trips(spark, sf_dir), columns)


@_query
def dq_accepted_values(spark, sf_dir):
    accepted = {
        **lookups.accepted_codes(),
        "passenger_category": buckets.PARTIES,
    }
    return quality.unaccepted_values(_trips(spark, sf_dir), accepted)


@_query
def dq_relationships(spark, sf_dir):
    known = _known(spark)
    parents = {
        "vendor_id": (known.vendors, "vendor_id"),
        "pickup_location_id": (known.zones, "location_id"),
        "dropoff_location_id": (known.zones, "location_id"),
        "payment_type_id": (known.payment_types, "payment_type_id"),
        "rate_code_id": (known.rate_codes, "rate_code_id"),
    }
    return quality.orphans(_trips(spark, sf_dir), parents)


@_query
def dq_revenue_consistency(spark, sf_dir):
    return _keyed(spark, sf_dir, "fare_amount", "total_amount").where(quality.total_below_fare())


@_query
def dq_positive_duration(spark, sf_dir):
    return _keyed(spark, sf_dir, "trip_duration_minutes").where(quality.no_whole_minute())


@_query
def dq_duration_range(spark, sf_dir):
    return _keyed(spark, sf_dir, "trip_duration_minutes").where(quality.over_four_hours())


@_query
def dq_speed(spark, sf_dir):
    wanted = "avg_speed_mph", "trip_distance_miles", "trip_duration_minutes"
    return _keyed(spark, sf_dir, *wanted).where(quality.over_speed_limit())


@_query
def dq_freshness(spark, sf_dir):
    return quality.freshness(fixture.raw_trips(spark, sf_dir), fixture.AS_OF)


@_query
def dq_report(spark, sf_dir):
    """All declared checks. The numbered trips are stored once and read back pruned, and so are relations with several
    checks that are costly to derive. A fact row is made of its trip where it is read, which costs less than to store
    its other columns. It has all columns of the enriched trips, so the checks on these share its passes."""
    known = _known(spark)
    numbered = clean.number_trips(fixture.raw_trips(spark, sf_dir))
    trips = materialize(clean.valid_trips(clean.standardize(numbered, keyed=False)), "trips")
    enriched = enrich.enrich_trips(trips.withColumn("trip_id", clean.trip_key()))
    fact = star.build_fact(enriched, known.vendors, known.payment_types, known.rate_codes, fixture.AS_OF)
    dims = warehouse.dimensions(known, enriched)
    made = warehouse.all_reports(enriched, known, fixture.AS_OF)
    for tables, name in ((dims, "dim_date"), (made, "location_stats"), (made, "daily_revenue")):
        tables[name] = materialize(tables[name], name)
    return quality.run_checks(spark, warehouse.check_tables(fact, fact, known, dims, made), all_checks())
