"""Raw trips derived from the test tables, and a rule-built stand-in for the zone lookup.

The driver has no trip data. Lines joined to their orders are turned into trips by integer arithmetic that any
SQL engine evaluates alike, with rare branches for everything the cleaning rules reject or repair.
"""

from __future__ import annotations

from pyspark.sql import DataFrame, SparkSession
from pyspark.sql import functions as F

from farelake.functions.calendar import instant
from farelake.schemas import RAW_TRIPS, SOURCE_TRIPS

SYNCED_AT = "2001-11-29 18:00:00"
AS_OF = "2001-12-01 00:00:00"


def source_trips(spark: SparkSession, sf_dir: str) -> DataFrame:
    """Trips as a source would deliver them, plus ``_deleted``.

    The join has no hint: Spark broadcasts the orders while they are small and shuffles them beyond that, where
    adaptive execution splits an order that holds a large share of the lines.
    """
    lines = spark.read.parquet(f"{sf_dir}/lineitem.parquet")
    orders = spark.read.parquet(f"{sf_dir}/orders.parquet").selectExpr("o_orderkey", "substr(o_orderpriority, 1, 1) AS payment_type")
    seeded = lines.join(orders, lines["l_orderkey"] == orders["o_orderkey"]).selectExpr(
        "l_partkey",
        "l_suppkey",
        "l_linenumber",
        "l_quantity",
        "l_returnflag",
        "l_shipdate",
        "l_orderkey * 31 + l_partkey * 17 + l_suppkey * 7 + l_linenumber AS h",
        "cast(floor(l_extendedprice) AS bigint) % 6000 + 250 AS base",
        "payment_type",
    )
    priced = seeded.selectExpr(
        "*",
        "CASE WHEN h % 151 = 0 THEN -base WHEN h % 83 = 0 THEN 0L ELSE base END AS fare",
        "CASE WHEN payment_type = '1' AND h % 151 <> 0 AND h % 83 <> 0"
        " THEN base * (h % 31) div 100 ELSE 0L END AS tip",
        "CASE WHEN h % 19 = 0 THEN 655L ELSE 0L END AS toll",
        "timestampadd(SECOND, h * 37 % 86400, l_shipdate) AS pickup_datetime",
    )
    derived = priced.selectExpr(
        "CASE WHEN h % 97 = 0 THEN '5' ELSE cast(1 + h % 2 AS string) END AS vendor_id",
        "pickup_datetime",
        "timestampadd(SECOND, CASE WHEN h % 211 = 0 THEN 15000 + h % 3600 ELSE h % 4200 - 30 END, pickup_datetime)"
        " AS dropoff_datetime",
        "nullif(cast(l_quantity AS bigint) % 7, 6L) AS passenger_count",
        "CASE WHEN h % 101 = 0 THEN 0D WHEN h % 499 = 0 THEN 500 + l_quantity ELSE l_quantity * 0.37D END"
        " AS trip_distance",
        "1 + l_partkey % 265 AS pickup_location_id",
        "1 + (l_suppkey * 13 + l_linenumber * 29) % 265 AS dropoff_location_id",
        "CASE WHEN h % 50 = 0 THEN NULL WHEN h % 50 = 1 THEN 'x' ELSE cast(1 + h % 50 % 6 AS string) END AS rate_code",
        "CASE l_returnflag WHEN 'A' THEN 'Y' WHEN 'N' THEN 'N' END AS store_and_fwd_flag",
        "payment_type",
        "fare / 100D AS fare_amount",
        "h % 3 * 0.5D AS extra",
        "0.5D AS mta_tax",
        "tip / 100D AS tip_amount",
        "toll / 100D AS tolls_amount",
        "0.3D AS imp_surcharge",
        "(fare + h % 3 * 50 + 50 + tip + toll + 30) / 100D AS total_amount",
        "h % 307 = 0 AS _deleted",
    )
    # One row in, one row out. Without it the optimizer would copy these formulas into every filter on their
    # results, and the generated method would grow past the size that the JVM compiles.
    names = ", ".join(derived.columns)
    return derived.selectExpr(f"stack(1, {names}) AS ({names})")


def raw_trips(spark: SparkSession, sf_dir: str) -> DataFrame:
    """The landing table of those trips."""
    return source_trips(spark, sf_dir).withColumn("_synced", instant(SYNCED_AT)).select(*RAW_TRIPS.names)


def sourced_only(spark: SparkSession, sf_dir: str) -> DataFrame:
    return source_trips(spark, sf_dir).select(*SOURCE_TRIPS.names)


def zones(spark: SparkSession) -> DataFrame:
    """263 zones by rule. Real runs read the public zone lookup instead (``lookups.read_csv``)."""
    i = F.col("location_id")
    unknown, newark, airport = i >= 258, i == 1, i.isin(130, 136)
    borough = (
        F.when(unknown, "N/A")
        .when(newark, "EWR")
        .when(airport, "Queens")
        .when(i % 5 == 0, "Manhattan")
        .when(i % 5 == 1, "Brooklyn")
        .when(i % 5 == 2, "Queens")
        .when(i % 5 == 3, "Bronx")
        .otherwise("Staten Island")
    )
    service = (
        F.when(unknown, "N/A")
        .when(newark, "EWR")
        .when(airport, "Airports")
        .when((i % 5 == 0) & (i % 3 != 0), "Yellow Zone")
        .otherwise("Boro Zone")
    )
    name = F.when(unknown, "NV").otherwise(F.concat(F.lit("Zone "), i.cast("string")))
    return (
        spark.range(1, 264)
        .withColumnRenamed("id", "location_id")
        .select("location_id", name.alias("zone_name"), borough.alias("borough"), service.alias("service_zone"))
    )
