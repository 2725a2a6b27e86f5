from __future__ import annotations

import datetime as dt
import os
import re

import pytest
from conftest import plan_of
from pyspark.sql import functions as F

from farelake.operators import clean, enrich, quality, reports
from farelake.plans import catalog, fixture, warehouse
from farelake.plans.checks import all_checks
from farelake.schemas import RAW_TRIPS
from farelake.sources import history, landing, store
from farelake.sources.versions import Versions
from farelake.streaming import daily


@pytest.fixture(scope="module")
def known(spark):
    return warehouse.Lookups.with_zones(spark, fixture.zones(spark))


@pytest.fixture(scope="module")
def landed(spark, small_tables, tmp_path_factory):
    store_ = Versions(spark, str(tmp_path_factory.mktemp("landing")))
    landing.load(store_, fixture.raw_trips(spark, small_tables))
    return store_


@pytest.fixture(scope="module")
def built(spark, known, landed, tmp_path_factory):
    out = Versions(spark, str(tmp_path_factory.mktemp("warehouse")))
    report = warehouse.build(landed, out, known, fixture.AS_OF)
    return out, {(r.check_name, r.table_name, r.column_name): r for r in report.collect()}


def current(out):
    found = {"fact_trips": sorted(map(repr, store.read_fact(out).collect()))}
    for name in out.tables:
        if name != "fact_trips" and not name.startswith("state_"):
            version = out.parts(name)[""]["version"]
            found[name] = sorted(map(repr, out.spark.read.parquet(f"{out.folder}/{name}/version={version}").collect()))
    return found


def test_every_table_is_stored(spark, built):
    out, _ = built
    assert sorted(t for t in out.tables if not t.startswith("state_")) == [
        "daily_revenue", "dim_date", "dim_location", "dim_payment_type", "dim_rate_code", "dim_vendor", "fact_trips",
        "location_stats", "location_stats_plain", "payment_tipping", "service_analysis", "trip_patterns",
        "zone_performance",
    ]
    assert store.read_fact(out).count() == 5825
    out.publish("mart")
    assert spark.table("mart.dim_location").count() == 263 and spark.table("mart.fact_trips").count() == 5825


def test_only_warnings_are_raised(built):
    _, report = built
    assert len(report) == 75
    assert {r.status for r in report.values()} == {"pass", "warn"}


def test_stored_reports_equal_those_from_raw_trips(spark, small_tables, known, built):
    out, _ = built
    trips = enrich.enrich_trips(clean.clean_trips(fixture.raw_trips(spark, small_tables), keyed=False))
    stored = current(out)
    for name, df in warehouse.all_reports(trips, known, fixture.AS_OF).items():
        assert stored[name] == sorted(map(repr, df.collect())), name


def test_the_stored_fact_has_the_ids_of_the_whole(spark, small_tables, built):
    out, _ = built
    whole = clean.clean_trips(fixture.raw_trips(spark, small_tables)).select("trip_id", "pickup_at", "total_amount")
    assert sorted(store.read_fact(out).select(*whole.columns).collect()) == sorted(whole.collect())


def test_refresh_equals_a_full_build(spark, small_tables, known, built, tmp_path):
    raw = fixture.raw_trips(spark, small_tables)
    month = "pickup_datetime >= timestamp_ntz'1997-02-01' and pickup_datetime < timestamp_ntz'1997-03-01'"
    landed, out = Versions(spark, str(tmp_path / "landing")), Versions(spark, str(tmp_path / "warehouse"))
    extra = raw.where(month).withColumn("pickup_datetime", F.expr("pickup_datetime + interval 20 years"))
    landing.load(landed, raw.where(f"pickup_datetime < timestamp_ntz'1999-05-20 12:00:00' and not ({month} and passenger_count = 2)").unionByName(extra))
    warehouse.refresh(landed, out, known, fixture.AS_OF)
    months = sorted({*(m for m in landed.parts("landing") if m >= "1999-05-01"), "1997-02-01"})
    later = [f"{y}-{m:02d}-01" for y in range(1999, 2002) for m in range(1, 13) if (y, m) >= (1999, 5)]
    landing.load(landed, raw.where(f"({month}) or pickup_datetime >= timestamp_ntz'1999-05-01'"), [*months, *later])
    assert "2017-02-01" not in landed.parts("landing") and "2017-02-01" in out.parts("fact_trips")
    report = warehouse.refresh(landed, out, known, fixture.AS_OF)
    assert {r.status for r in report.collect()} == {"pass", "warn"}
    assert current(out) == current(built[0])


def test_refresh_touches_stale_months_only(spark, raw, known, tmp_path):
    def on(month, day, **more):
        at = dt.datetime(2022, month, day, 12)
        return {"pickup_datetime": at, "dropoff_datetime": at + dt.timedelta(hours=1), **more}

    landed, out = Versions(spark, str(tmp_path / "landing")), Versions(spark, str(tmp_path / "warehouse"))
    landing.load(landed, raw(on(1, 3), on(2, 3), on(3, 3), on(4, 3, total_amount=0.0), {"pickup_datetime": None}))
    stale = warehouse.stale_months(landed, out)
    assert stale.months == {"2022-01-01": 1, "2022-02-01": 2, "2022-03-01": 3, "2022-04-01": 4} and stale.gone == []
    warehouse.refresh(landed, out, known, fixture.AS_OF)
    assert warehouse.stale_months(landed, out) == warehouse.Stale({}, [])
    first = {name: dict(parts) for name, parts in out.tables.items()}

    # As many rows as before: the months after it keep their ids, and their files.
    landing.load(landed, raw(on(2, 9)), ["2022-02-01"])
    assert warehouse.stale_months(landed, out).months == {"2022-02-01": 2}
    warehouse.refresh(landed, out, known, fixture.AS_OF)
    for table in ("fact_trips", "state_days", "state_locations"):
        changed = {m for m, part in out.parts(table).items() if part != first[table].get(m)}
        assert changed == {"2022-02-01"}
    assert [str(r.pickup_date) for r in store.read_fact(out).orderBy("pickup_at").collect()] == ["2022-01-03", "2022-02-09", "2022-03-03"]

    # One row fewer, and a month without rows: later ids move.
    landing.load(landed, raw(on(3, 3)), ["2022-01-01", "2022-03-01"])
    stale = warehouse.stale_months(landed, out)
    assert stale.months == {"2022-02-01": 1, "2022-03-01": 2, "2022-04-01": 3} and stale.gone == ["2022-01-01"]
    warehouse.refresh(landed, out, known, fixture.AS_OF)
    days = spark.read.parquet(f"{out.folder}/daily_revenue/version={out.parts('daily_revenue')['']['version']}")
    assert [str(r.pickup_date) for r in days.collect()] == ["2022-02-09", "2022-03-03"]
    ids = clean.clean_trips(landing.read_landing(landed)).select("trip_id").collect()
    assert sorted(ids) == sorted(store.read_fact(out).select("trip_id").collect())


def test_a_pruned_landing_scan(spark, landed):
    some = landing.read_landing(landed, ["1997-02-01"])
    assert all("month_start=1997-02-01" in f for f in some.inputFiles())
    since = landed.read("landing", RAW_TRIPS).where("month_start >= date'1999-05-01'")
    filters = re.search(r"PartitionFilters: \[(.*?)\], PushedFilters", plan_of(since)).group(1)
    assert ">= 1999-05-01" in filters


def test_a_failed_refresh_changes_nothing(spark, raw, known, tmp_path, monkeypatch):
    landed, out = Versions(spark, str(tmp_path / "landing")), Versions(spark, str(tmp_path / "warehouse"))
    landing.load(landed, raw({}))
    warehouse.refresh(landed, out, known, fixture.AS_OF)
    before = current(out)
    landing.load(landed, raw({}, {}))
    monkeypatch.setattr(warehouse.reports, "tipping_report", lambda *_: 1 / 0)
    with pytest.raises(ZeroDivisionError):
        warehouse.refresh(landed, out, known, fixture.AS_OF)
    assert current(Versions(spark, str(tmp_path / "warehouse"))) == before


def test_views(spark, raw):
    warehouse.register_views({"landed_trips": raw({}, {})})
    assert spark.sql("select count(*) from landed_trips").first()[0] == 2


def test_streamed_days_equal_the_batch_report(spark, small_tables, tmp_path):
    source, log, state = (str(tmp_path / n) for n in ("landing", "log", "state"))
    trips = fixture.raw_trips(spark, small_tables)
    first, second = trips.randomSplit([0.5, 0.5], seed=1)
    first.repartition(2).write.parquet(source)
    arriving = daily.stream_landing(spark, source, files_per_batch=1)

    daily.keep_current(arriving, log, state).awaitTermination()
    early = daily.current_report(spark, log)
    halfway = enrich.enrich_trips(clean.clean_trips(spark.read.schema(RAW_TRIPS).parquet(source), keyed=False))
    assert sorted(early.collect()) == sorted(reports.daily_revenue(halfway).collect())

    second.write.mode("append").parquet(source)
    daily.keep_current(arriving, log, state).awaitTermination()
    complete = enrich.enrich_trips(clean.clean_trips(spark.read.schema(RAW_TRIPS).parquet(source), keyed=False))
    assert complete.count() == 5825
    final = daily.current_report(spark, log)
    assert sorted(final.collect()) == sorted(reports.daily_revenue(complete).collect())
    assert len(os.listdir(log)) >= 3


def test_late_trips_are_counted(spark, raw, tmp_path):
    def on(day):
        return {"pickup_datetime": dt.datetime(2022, 1, day, 12), "dropoff_datetime": dt.datetime(2022, 1, day, 13)}

    source, log, state = (str(tmp_path / n) for n in ("landing", "log", "state"))
    for batch in ([on(1), on(20)], [on(1), on(19)], [on(20)]):
        raw(*batch).coalesce(1).write.mode("append").parquet(source)
        daily.keep_current(daily.stream_landing(spark, source), log, state).awaitTermination()
    counts = {r.pickup_date.day: r.trip_count for r in daily.current_report(spark, log).collect()}
    assert counts == {1: 2, 19: 1, 20: 2}


def test_folding_the_log_leaves_the_report(spark, raw, tmp_path, monkeypatch):
    """Before, while and after entries are folded, and after a crash at each step; and the log stays small."""

    def on(day):
        return {"pickup_datetime": dt.datetime(2022, 1, day, 12), "dropoff_datetime": dt.datetime(2022, 1, day, 13)}

    source, log, state = (str(tmp_path / n) for n in ("landing", "log", "state"))

    def arrive(*days):
        raw(*map(on, days)).coalesce(1).write.mode("append").parquet(source)
        daily.keep_current(daily.stream_landing(spark, source), log, state).awaitTermination()

    def counts():
        return {r.pickup_date.day: r.trip_count for r in daily.current_report(spark, log).collect()}

    arrive(1, 20)
    arrive(1, 19)
    assert counts() == {1: 2, 19: 1, 20: 1}
    for step in ("write", "commit"):
        with monkeypatch.context() as patch:
            patch.setattr(Versions, step, lambda *_, **__: 1 / 0)
            with pytest.raises(ZeroDivisionError):
                daily.compact(spark, log, state)
        assert counts() == {1: 2, 19: 1, 20: 1}
    assert daily.compact(spark, log, state) == 1 == daily.compact(spark, log, state)
    assert counts() == {1: 2, 19: 1, 20: 1} and not [f for f in os.listdir(log) if f.startswith("batch_id")]
    for i in range(3):
        arrive(20)
        during = daily.current_report(spark, log)  # planned before the folding, read after it
        daily.compact(spark, log, state)
        assert {r.pickup_date.day: r.trip_count for r in during.collect()} == counts() == {1: 2, 19: 1, 20: 2 + i}
        assert len([f for f in os.listdir(log) if f.startswith("batch_id")]) <= 1


def test_an_unfinished_batch_is_not_folded(spark, raw, tmp_path):
    source, log, state = (str(tmp_path / n) for n in ("landing", "log", "state"))
    raw({}).write.parquet(source)
    daily.keep_current(daily.stream_landing(spark, source), log, state).awaitTermination()
    for f in os.listdir(f"{state}/commits"):
        os.remove(f"{state}/commits/{f}")
    assert daily.compact(spark, log, state) == -1
    daily.keep_current(daily.stream_landing(spark, source), log, state).awaitTermination()  # runs batch 0 again
    daily.compact(spark, log, state)
    assert [r.trip_count for r in daily.current_report(spark, log).collect()] == [1]


def test_history_of_several_snapshots(spark, tmp_path):
    snapshots = {
        "2020-01-01": [(1, "a", None), (2, "b", "x"), (3, None, None)],
        "2020-02-01": [(1, "a", None), (2, "c", "x"), (4, "d", "y")],
        "2020-03-01": [(1, "a", "z"), (3, "e", None), (4, "d", "y")],
        "2020-04-01": [],
    }
    schema = "k long, name string, _old string"
    stored, expected = Versions(spark, str(tmp_path)), []
    for day, rows in snapshots.items():
        snapshot = spark.createDataFrame(rows, schema)
        closed = dict(stored.parts("d_closed"))
        history.apply_snapshot(stored, "d", snapshot, "k", day)
        assert closed.items() <= stored.parts("d_closed").items()  # what was closed is not written again
        with pytest.raises(ValueError):
            history.apply_snapshot(stored, "d", snapshot, "k", day)
        now = {r[0]: r for r in rows}
        for version in [v for v in expected if v[4] is None]:
            if now.get(version[0]) != version[:3]:
                expected[expected.index(version)] = (*version[:4], day)
        going_on = {v[:3] for v in expected if v[4] is None}
        expected += [(*r, day, None) for r in rows if r not in going_on]
        found = history.history(Versions(spark, str(tmp_path)), "d", snapshot.schema).collect()
        assert all(r.is_current == (r.valid_to is None) for r in found)
        text = [(r.k, r.name, r._old, str(r.valid_from), str(r.valid_to) if r.valid_to else None) for r in found]
        assert sorted(text, key=repr) == sorted(expected, key=repr)


def test_checks_counted_while_writing_equal_those_of_a_pass(spark, known, built, raw, tmp_path):
    """Of the built tables, and of trips that violate checks of every kind."""
    landed, out = Versions(spark, str(tmp_path / "landing")), Versions(spark, str(tmp_path / "warehouse"))
    odd = [{"vendor_id": v} for v in ("7", "7", "8")] + [{"store_and_fwd_flag": "?"}, {"fare_amount": 50.0}, {"trip_distance": 90.0}]
    odd += [{"vendor_id": None}, {"dropoff_datetime": dt.datetime(2022, 1, 3, 12, 0, 30)}, {"dropoff_datetime": dt.datetime(2022, 1, 4)}]
    landing.load(landed, raw(*odd))
    mine = warehouse.refresh(landed, out, known, fixture.AS_OF).collect()
    for store_, report in ((out, mine), (built[0], built[1].values())):
        fact = store.read_fact(store_)
        tables = {n: spark.read.parquet(f"{store_.folder}/{n}/version={p['']['version']}") for n, p in store_.tables.items() if "" in p}
        checked = warehouse.check_tables(fact, fact, known, {}, tables)
        assert sorted(map(tuple, report)) == sorted(map(tuple, quality.run_checks(spark, checked, all_checks()).collect()))
    found = {(r.check_name, r.table_name, r.column_name): r.violations for r in mine}
    assert found["accepted_values", "trips_clean", "vendor_id"] == 2 and found["revenue_consistency", "fact_trips", ""] == 1
    assert found["not_null", "trips_clean", "vendor_id"] == 1 and found["speed", "fact_trips", ""] == 2


def test_observed_checks_spare_a_pass(spark, raw, known, tmp_path, monkeypatch):
    landed, out = Versions(spark, str(tmp_path / "landing")), Versions(spark, str(tmp_path / "warehouse"))
    landing.load(landed, raw({}, {}))
    scanned = []
    monkeypatch.setattr(quality, "_row_checks", lambda df, checks, f=quality._row_checks: [f(df, checks), scanned.extend(checks)][0])
    warehouse.refresh(landed, out, known, fixture.AS_OF)
    assert scanned and not {c.table for _, c in scanned} & {"trips_clean", "trips_enriched", "fact_trips"}


def test_the_streamed_files_grow_in_number_with_the_table(spark, small_tables, monkeypatch):
    landed = []

    def stream(spark_, path, files_per_batch):
        landed.append([r[0] for r in spark_.read.parquet(path).groupBy(F.input_file_name()).count().select("count").collect()])
        return daily_stream(spark_, path, files_per_batch)

    daily_stream = daily.stream_landing
    monkeypatch.setattr(daily, "stream_landing", stream)
    monkeypatch.setattr(catalog, "_LANDED_FILE_BYTES", 4 << 10)
    catalog.daily_revenue_stream(spark, small_tables)
    assert len(landed[0]) > 16 and max(landed[0]) < 2 * sum(landed[0]) / len(landed[0])


def test_checks_of_enriched_trips_share_the_passes_over_the_fact(spark, small_tables, monkeypatch):
    seen = {}
    monkeypatch.setattr(quality, "run_checks", lambda spark_, tables, checks: seen.update(tables))
    catalog.dq_report(spark, small_tables)
    assert seen["trips_clean"] is seen["trips_enriched"] is seen["fact_trips"]
