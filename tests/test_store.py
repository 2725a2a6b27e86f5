from __future__ import annotations

import datetime as dt
import os
import re
import types

import pytest
from conftest import plan_of
from pyspark.sql import functions as F
from test_star import make_fact

from farelake.operators import clean, enrich, star
from farelake.plans import fixture, warehouse
from farelake.schemas import SOURCE_TRIPS
from farelake.session import scratch_path
from farelake.sources import landing, store
from farelake.sources.versions import Versions


def trips_on(raw, *days):
    return raw(
        *(
            {"pickup_datetime": dt.datetime(*d, 12), "dropoff_datetime": dt.datetime(*d, 13), "pickup_location_id": i}
            for i, d in enumerate(days)
        )
    )


DAYS = [(2022, 1, 31), (2022, 2, 1), (2022, 2, 28), (2022, 3, 1), (2022, 3, 2)]


def test_fact_round_trip_and_pruning(spark, raw, tmp_path):
    stored = Versions(spark, str(tmp_path))
    fact = make_fact(spark, trips_on(raw, *DAYS))
    store.write_fact(stored, fact)
    assert sorted(stored.parts("fact_trips")) == ["2022-01-01", "2022-02-01", "2022-03-01"]
    back = store.read_fact(stored)
    assert back.columns == fact.columns
    assert sorted(map(tuple, back.collect()), key=str) == sorted(map(tuple, fact.collect()), key=str)

    some = store.read_fact(stored, "2022-02-01", "2022-03-01")
    assert sorted(r.pickup_date for r in some.collect()) == [dt.date(2022, 2, 1), dt.date(2022, 2, 28)]
    filters = re.search(r"PartitionFilters: \[(.*?)\], PushedFilters", plan_of(some)).group(1)
    assert ">= 2022-02-01" in filters and "<= 2022-02-01" in filters


def test_scan_reads_only_the_columns_it_needs(spark, raw, tmp_path):
    stored = Versions(spark, str(tmp_path))
    store.write_fact(stored, make_fact(spark, trips_on(raw, *DAYS)))
    plan = plan_of(store.read_fact(stored).groupBy("payment_type_id").sum("total_amount"))
    assert re.search(r"ReadSchema: struct<payment_type_id:bigint,total_amount:double>", plan)


def test_a_hot_month_is_spread_over_tasks(spark, raw, tmp_path):
    stored = Versions(spark, str(tmp_path))
    store.write_fact(stored, make_fact(spark, trips_on(raw, *[(2022, 1, 5)] * 400)), partitions=4)
    assert len(store.read_fact(stored).inputFiles()) == 4


def test_replacing_months_leaves_the_others(spark, raw, tmp_path):
    stored = Versions(spark, str(tmp_path))
    store.write_fact(stored, make_fact(spark, trips_on(raw, *DAYS)))
    changed = make_fact(spark, trips_on(raw, (2022, 3, 9), (2022, 4, 1)))
    with pytest.raises(ValueError):
        store.replace_months(stored, changed, ["2022-03-01"])
    store.replace_months(stored, changed, ["2022-02-01", "2022-03-01", "2022-04-01"])
    days = sorted(str(r.pickup_date) for r in store.read_fact(stored).collect())
    assert days == ["2022-01-31", "2022-03-09", "2022-04-01"]


def test_extract_is_half_open_and_stamped(spark, raw):
    source = trips_on(raw, *DAYS).drop("_synced", "_deleted")
    out = landing.extract_range(source, "2022-02-01 12:00:00", "2022-03-02 12:00:00")
    assert sorted(r.pickup_location_id for r in out.collect()) == [1, 2, 3]
    stamped = landing.add_sync_columns(out, "2022-04-01 06:00:00")
    assert stamped.columns == [*SOURCE_TRIPS.names, "_synced", "_deleted"]
    assert {(r._synced, r._deleted) for r in stamped.collect()} == {(dt.datetime(2022, 4, 1, 6), False)}


def test_extract_reaches_the_scan(spark, raw, tmp_path):
    path = str(tmp_path / "source")
    trips_on(raw, *DAYS).write.parquet(path)
    plan = plan_of(landing.extract_range(spark.read.parquet(path), "2022-02-01", "2022-03-01"))
    assert "GreaterThanOrEqual(pickup_datetime" in plan and "LessThan(pickup_datetime" in plan


def test_full_and_monthly_loads(spark, raw, tmp_path):
    landed = Versions(spark, str(tmp_path))
    landing.load(landed, trips_on(raw, *DAYS))
    assert {m: p["rows"] for m, p in landed.parts("landing").items()} == {"2022-01-01": 1, "2022-02-01": 2, "2022-03-01": 2}
    with pytest.raises(ValueError):
        landing.load(landed, trips_on(raw, *DAYS), ["2022-02-01"])
    landing.load(landed, trips_on(raw, (2022, 2, 3)), ["2022-02-01", "2022-03-01"])
    assert sorted(r.pickup_datetime.day for r in landing.read_landing(landed).collect()) == [3, 31]
    landing.load(landed, trips_on(raw, DAYS[0]))
    assert landing.read_landing(Versions(spark, str(tmp_path))).count() == 1


def test_a_named_table_is_whole_between_any_two_steps(spark, raw, tmp_path, monkeypatch):
    """A reader by name and one by folder look after every step of a refresh, and see what was or what will be."""
    landed = Versions(spark, str(tmp_path))
    landing.load(landed, trips_on(raw, *DAYS))
    landed.publish("landing_zone")
    seen = []

    def look(*_):
        by_name = spark.table("landing_zone.landing").count()
        seen.append((by_name, landing.read_landing(Versions(spark, str(tmp_path))).count()))

    steps = {name: getattr(landed, name) for name in ("write", "months_of", "commit")}
    for name, step in steps.items():
        monkeypatch.setattr(landed, name, lambda *a, step=step, **k: [step(*a, **k), look()][0])
    look()
    landing.load(landed, trips_on(raw, DAYS[0], DAYS[1]))
    landed.publish("landing_zone")
    look()
    assert seen == [(5, 5), (5, 5), (5, 5), (5, 2), (2, 2)]
    assert "landing_zone" in [r.namespace for r in spark.sql("show schemas").collect()]
    before = spark.table("landing_zone.landing")
    landing.load(landed, trips_on(raw, DAYS[0]))
    assert before.count() == 2 and landed.vacuum() == 2


def test_a_commit_after_another_writers_fails(spark, tmp_path):
    first, second = (Versions(spark, str(tmp_path)) for _ in range(2))
    first.replace({"t": spark.range(3)})
    with pytest.raises(RuntimeError):
        second.replace({"t": spark.range(4)})
    assert Versions(spark, str(tmp_path)).read("t", spark.range(1).schema).count() == 3
    Versions(spark, str(tmp_path)).replace({"t": spark.range(5)})
    assert first.read("t", spark.range(1).schema).count() == 3


def test_load_summary(raw):
    row = landing.load_summary(trips_on(raw, *DAYS)).first()
    assert tuple(row) == (5, dt.datetime(2022, 1, 31, 12), dt.datetime(2022, 3, 2, 12), 1, 66.5)


@pytest.mark.parametrize("share", [0.0, 0.25, 0.9, 1.0])
def test_sample_is_repeatable_and_near_its_share(spark, small_tables, share):
    source = fixture.sourced_only(spark, small_tables)
    keys = ["pickup_datetime", "dropoff_datetime", "pickup_location_id"]
    first = landing.sample_share(source, share, keys)
    assert first.columns == source.columns
    rows = sorted(first.select(keys).collect())
    assert abs(len(rows) - share * 6000) <= 200
    assert rows == sorted(landing.sample_share(source.repartition(3), share, keys).select(keys).collect())


def test_samples_are_nested_and_need_no_shuffle(spark):
    df = spark.range(0, 3000, 1, 6).selectExpr("id", "cast(if(id % 3 = 0, id, 5) as bigint) as k")
    small, large = (landing.sample_share(df, share, ["k"]) for share in (0.3, 0.6))
    assert {r.id for r in small.collect()} <= {r.id for r in large.collect()}
    assert "Exchange" not in plan_of(small)
    with pytest.raises(ValueError):
        landing.sample_share(df, 1.5, ["k"])


def test_a_failed_load_leaves_the_table(spark, raw, tmp_path):
    landed = Versions(spark, str(tmp_path))
    landing.load(landed, raw({}, {}))
    broken = raw({}).withColumn("vendor_id", F.raise_error(F.lit("broken")).cast("string"))
    with pytest.raises(Exception, match="broken"):
        landing.load(landed, broken)
    assert landing.read_landing(landed).count() == 2 == landing.read_landing(Versions(spark, str(tmp_path))).count()
    landing.load(landed, landing.read_landing(landed).limit(1))
    assert landing.read_landing(landed).count() == 1


class FakeSession:
    """What the scratch folder looks at."""

    def __init__(self, master, folder=None):
        self.conf = {"spark.checkpoint.dir": folder} if folder else {}
        self.sparkContext = types.SimpleNamespace(master=master, applicationId="app-1")


def test_scratch_follows_the_session():
    path = scratch_path(FakeSession("spark://cluster", "hdfs://shared/checkpoints/"), "x")
    assert path.startswith("hdfs://shared/checkpoints/farelake/app-1/x-")


def test_no_machine_local_scratch_on_a_cluster():
    with pytest.raises(RuntimeError):
        scratch_path(FakeSession("yarn"), "x")
    assert os.path.isabs(scratch_path(FakeSession("local[2]"), "x"))


def test_only_what_the_fact_is_made_of_is_placed(spark, raw, tmp_path):
    """Derived columns and keys come after the shuffle, and the writer does not sort the placed rows again."""
    known = warehouse.Lookups.with_zones(spark, fixture.zones(spark))
    days = [DAYS[i * 7 % 5] for i in range(60)]
    trips = clean.valid_trips(clean.standardize(clean.number_trips(trips_on(raw, *days)), keyed=False))
    placed, finish = warehouse.stored_form(trips, known, fixture.AS_OF)
    derived = {"trip_id", "pickup_year", "pickup_day_name", "time_of_day_bucket", "avg_speed_mph", "updated_at"}
    assert not derived & set(store.clustered(placed).columns)

    stored = Versions(spark, str(tmp_path))
    store.write_fact(stored, placed, finish=finish)
    wide = star.build_fact(
        enrich.enrich_trips(clean.clean_trips(trips_on(raw, *days))),
        known.vendors, known.payment_types, known.rate_codes, fixture.AS_OF,
    )
    back = store.read_fact(stored)
    assert back.columns == wide.columns
    assert sorted(map(repr, back.collect())) == sorted(map(repr, wide.collect()))
    for path in back.inputFiles():
        keys = [tuple(r) for r in spark.read.parquet(path).select(*store.CLUSTER_KEYS, "pickup_at").collect()]
        assert keys == sorted(keys)
