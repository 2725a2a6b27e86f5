from __future__ import annotations

import os

import pytest

from farelake.__main__ import main, outcome
from farelake.plans import fixture
from farelake.sources import landing, store
from farelake.sources.versions import Versions


@pytest.fixture(scope="module")
def inputs(spark, small_tables, tmp_path_factory):
    base = tmp_path_factory.mktemp("cli")
    fixture.sourced_only(spark, small_tables).write.parquet(str(base / "source"))
    rows = fixture.zones(spark).collect()
    lines = ["location_id,zone_name,borough,service_zone", *(",".join(map(str, r)) for r in rows)]
    (base / "zones.csv").write_text("\r\n".join(lines) + "\r\n")
    return base


def run(base, command, *rest):
    return main([command, "--landing", str(base / "landing"), "--as-of", fixture.AS_OF, *rest])


def test_ingest_build_refresh(spark, inputs, capfd):
    def landed():
        return landing.read_landing(Versions(spark, str(inputs / "landing"))).count()

    def fact():
        return store.read_fact(Versions(spark, str(inputs / "out"))).count()

    source = ("--source", str(inputs / "source"), "--start", "1999-01-01")
    assert run(inputs, "ingest", *source, "--end", "2000-01-01", "--share", "0.5") == 0
    assert 0 < landed() < 600

    assert run(inputs, "ingest", *source, "--end", "2000-01-01") == 0
    tables = ("--zones", str(inputs / "zones.csv"), "--out", str(inputs / "out"))
    assert run(inputs, "build", *tables) == 0
    before = landed(), fact()

    source = ("--source", str(inputs / "source"), "--start", "2000-01-01")
    assert run(inputs, "ingest", *source, "--end", "2000-03-01", "--months", "2000-01-01", "2000-02-01") == 0
    assert run(inputs, "refresh", *tables, "--partitions", "2") == 0
    assert landed() > before[0] > 0 and fact() > before[1] > 0
    printed = capfd.readouterr().out
    assert printed.count("pass  unique") == 28 and "warn  speed" in printed


def test_a_failed_check_sets_the_exit_code(spark, capfd):
    columns = "check_name string, table_name string, column_name string, severity string, violations long, status string"
    rows = [("unique", "t", "k", "error", 0, "pass"), ("speed", "t", "", "warn", 3, "warn")]
    assert outcome(spark.createDataFrame(rows, columns)) == 0
    assert outcome(spark.createDataFrame([*rows, ("not_null", "t", "k", "error", 1, "fail")], columns)) == 1
    assert capfd.readouterr().out.splitlines()[-3].startswith("fail  not_null")


def test_scratch_is_released(spark):
    base = spark.conf.get("spark.checkpoint.dir", None)
    if base is None:
        pytest.skip("no shared folder set")
    folder = os.path.join(base, "farelake", spark.sparkContext.applicationId)
    assert not os.path.exists(folder) or not os.listdir(folder)
