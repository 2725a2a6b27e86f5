from __future__ import annotations

import datetime as dt

import pytest

from farelake.operators import clean, enrich, star
from farelake.schemas import FACT, ZONES
from farelake.sources import lookups


def make_fact(spark, rows):
    trips = enrich.enrich_trips(clean.clean_trips(rows))
    return star.build_fact(
        trips, lookups.vendors(spark), lookups.payment_types(spark), lookups.rate_codes(spark), "2022-04-02 00:00:00"
    )


def test_fact_columns_and_types(spark, raw):
    fact = make_fact(spark, raw({}))
    assert len(fact.columns) == 43
    assert [(f.name, f.dataType) for f in fact.schema] == [(f.name, f.dataType) for f in FACT]


def test_unknown_codes_keep_null_names(spark, raw):
    rows = make_fact(spark, raw({"vendor_id": "1"}, {"vendor_id": "9", "payment_type": "8", "rate_code": "50"}))
    known, unknown = sorted(rows.collect(), key=lambda r: r.vendor_id)
    assert (known.vendor_name, known.payment_type_name, known.rate_code_name) == (
        "Creative Mobile Technologies", "Credit Card", "Standard rate",
    )
    assert (unknown.vendor_name, unknown.payment_type_name, unknown.rate_code_name) == (None, None, None)


def test_rate_code_dim(spark):
    rows = {r.rate_code_id: r for r in star.rate_code_dim(lookups.rate_codes(spark)).collect()}
    assert len(rows) == 7
    assert [i for i, r in sorted(rows.items()) if r.is_airport_rate] == [2, 3]
    assert (rows[99].rate_category, rows[4].rate_category) == ("standard", "negotiated")


def test_small_dims(spark):
    assert star.vendor_dim(lookups.vendors(spark)).count() == 2
    electronic = star.payment_type_dim(lookups.payment_types(spark)).where("is_electronic").collect()
    assert [r.payment_type_id for r in electronic] == [1]


@pytest.mark.parametrize(
    "borough, service_zone, category",
    [
        ("EWR", "EWR", "Airport"),
        ("Queens", "Airports", "Airport"),
        ("Manhattan", "Yellow Zone", "Manhattan Core"),
        ("Manhattan", "Boro Zone", "Manhattan Other"),
        ("Staten Island", "Boro Zone", "Outer Borough"),
        ("N/A", "N/A", "Other"),
        ("Manhattan", "N/A", "Other"),
        (None, None, "Other"),
    ],
)
def test_zone_category(spark, borough, service_zone, category):
    zone = lookups.from_rows(spark, ZONES, [(1, "Z", borough, service_zone)])
    assert star.location_dim(zone).first().zone_category == category


def test_zone_file_with_either_line_end(spark, tmp_path):
    path = tmp_path / "zones.csv"
    path.write_bytes(
        b"location_id,zone_name,borough,service_zone\r\n1,Newark Airport,EWR,EWR\r\n258,NV,N/A,N/A\r\n"
        b'7,"Bay, East",Queens,Boro Zone\r\n'
    )
    rows = {r.location_id: r for r in lookups.read_csv(spark, str(path), ZONES).collect()}
    assert rows[258].service_zone == "N/A" and rows[1].service_zone == "EWR" and rows[7].zone_name == "Bay, East"


def test_lookups_have_a_known_size(spark):
    stats = lookups.rate_codes(spark)._jdf.queryExecution().optimizedPlan().stats()
    assert stats.sizeInBytes() < 10_000


def test_date_spine(spark):
    days = [r.date_day for r in star.date_spine(spark, "2022-01-01", "2022-04-01").orderBy("date_day").collect()]
    assert len(days) == 90 and days[0] == dt.date(2022, 1, 1) and days[-1] == dt.date(2022, 3, 31)
    assert star.date_spine(spark, "2022-01-01", "2022-01-01").count() == 0
    assert star.date_spine(spark, "2022-01-02", "2022-01-01").count() == 0


def test_spine_covers_idle_days(spark):
    trips = spark.sql("select cast(t as timestamp_ntz) as pickup_at from values ('2022-01-01 23:59:59'),"
                      " ('2022-01-04 00:00:00') as v(t)")
    assert star.spine_of(trips).count() == 4
    assert star.spine_of(trips.where("false")).count() == 0


def test_date_dim(spark):
    first = star.date_dim(star.date_spine(spark, "2022-01-01", "2022-01-02")).first()
    assert tuple(first) == (
        dt.date(2022, 1, 1), 2022, 1, 1, 0, 7, "Saturday", True, "2022-01", "2021-W52",
    )


def test_history_of_two_snapshots(spark):
    schema = "k int, a string, b int"
    before = spark.createDataFrame([(1, "x", 1), (2, "x", None), (3, "y", 3), (4, None, 4)], schema)
    after = spark.createDataFrame([(1, "x", 1), (2, "z", None), (4, None, 4), (5, "n", 5)], schema)
    out = star.type_two_history(before, after, "k", "2020-01-01", "2021-01-01").collect()
    first, second = dt.date(2020, 1, 1), dt.date(2021, 1, 1)
    assert sorted(map(repr, map(tuple, out))) == sorted(
        map(
            repr,
            [
                (1, "x", 1, first, None, True),
                (2, "x", None, first, second, False),
                (2, "z", None, second, None, True),
                (3, "y", 3, first, second, False),
                (4, None, 4, first, None, True),
                (5, "n", 5, second, None, True),
            ],
        )
    )
