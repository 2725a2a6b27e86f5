from __future__ import annotations

import pytest
from pyspark.sql import Window
from pyspark.sql import functions as F

from conftest import plan_of

from farelake.operators import numbering
from farelake.operators.clean import ROW_ORDER, live_rows, number_trips
from farelake.operators.numbering import global_row_number
from farelake.plans import fixture
from farelake.session import sized_partitions


def numbers(df, name="row_num"):
    return sorted(r[name] for r in df.select(name).collect())


def test_equals_the_plain_window(spark, small_tables):
    live = live_rows(fixture.raw_trips(spark, small_tables))
    plain = live.withColumn("row_num", F.row_number().over(Window.orderBy(*ROW_ORDER)))
    mine = number_trips(fixture.raw_trips(spark, small_tables))
    columns = ["row_num", *ROW_ORDER]
    assert sorted(mine.select(columns).collect()) == sorted(plain.select(columns).collect())


def test_ties_are_broken_by_the_other_columns(spark):
    df = spark.range(1000).select((F.col("id") % 3).alias("k"), (F.col("id") * 7919 % 1000).alias("v"))
    first = {(r.k, r.v): r.row_num for r in global_row_number(df, ["k"], partitions=7).collect()}
    second = {(r.k, r.v): r.row_num for r in global_row_number(df.repartition(5), ["k"], partitions=3).collect()}
    assert first == second
    assert [key for key, _ in sorted(first.items(), key=lambda item: item[1])] == sorted(first)


def test_a_hot_key_and_a_group_of_copies(spark):
    """A third of the rows share the first key and another third are exact copies."""
    kind = F.when(F.col("id") % 3 == 0, F.col("id")).when(F.col("id") % 3 == 1, F.lit(-1)).otherwise(F.lit(-2))
    value = F.when(F.col("id") % 3 == 2, F.lit(0)).otherwise(F.col("id"))
    df = spark.range(0, 30_000, 1, 12).select(kind.alias("k"), value.alias("v"))
    out = global_row_number(df, ["k"], partitions=12)
    assert numbers(out) == list(range(1, 30_001))
    ordered = [(r.k, r.v) for r in out.orderBy("row_num").collect()]
    assert ordered == sorted(ordered)


def test_copies_do_not_land_in_one_partition(spark, monkeypatch):
    from farelake.operators import numbering

    stored = {}
    materialize = numbering.materialize

    def spy(df, label):
        stored["placed"] = materialize(df, label)
        return stored["placed"]

    monkeypatch.setattr(numbering, "materialize", spy)
    df = spark.range(0, 30_000, 1, 12).select(F.when(F.col("id") % 3 == 0, F.col("id")).otherwise(F.lit(7)).alias("k"))
    assert numbers(global_row_number(df, ["k"], partitions=12)) == list(range(1, 30_001))
    sizes = [r["count"] for r in stored["placed"].groupBy("_part").count().collect()]
    assert len(sizes) > 8 and max(sizes) < 30_000 / 4


@pytest.mark.parametrize("after", [0, 100])
def test_start_and_empty(spark, after):
    df = spark.range(5).withColumnRenamed("id", "k")
    assert numbers(global_row_number(df, ["k"], after=after)) == [after + i for i in range(1, 6)]
    assert global_row_number(df.where("k > 9"), ["k"], after=after).count() == 0


def test_nulls_sort_first(spark):
    df = spark.sql("select * from values (2), (null), (1) as t(k)")
    assert [r.k for r in global_row_number(df, ["k"]).orderBy("row_num").collect()] == [None, 1, 2]


def test_only_wanted_columns_are_written(spark):
    df = spark.range(500).selectExpr("id % 7 as a", "id as b", "cast(id as string) as c")
    out = global_row_number(df, ["a"], keep=["b"])
    assert out.columns == ["b", "row_num"]
    expected = [r.id for r in spark.range(500).orderBy("id").collect()]
    ranked = sorted(expected, key=lambda i: (i % 7, i))
    assert [r.b for r in out.orderBy("row_num").collect()] == ranked
    assert "a#" not in plan_of(out) and "c:string" not in plan_of(out)


def test_partitions_follow_the_size(spark, tmp_path):
    spark.range(4000).write.parquet(str(tmp_path / "t"))
    stored = spark.read.parquet(str(tmp_path / "t"))
    configured = int(spark.conf.get("spark.sql.shuffle.partitions"))
    assert sized_partitions(stored) == configured
    assert sized_partitions(stored, bytes_per_part=100) > configured
    both = stored.crossJoin(stored.withColumnRenamed("id", "other"))
    assert sized_partitions(both, 100) < 3 * sized_partitions(stored, 100)


def test_a_wrapped_position_fails(spark, monkeypatch):
    monkeypatch.setattr(numbering, "_POSITION_BITS", 3)
    with pytest.raises(Exception, match="more partitions"):
        global_row_number(spark.range(100), ["id"], partitions=2).collect()
