"""Small lookup tables."""

from __future__ import annotations

from collections.abc import Iterable

import pyarrow as pa
from pyspark.sql import DataFrame, SparkSession
from pyspark.sql.pandas.types import to_arrow_schema
from pyspark.sql.types import StructType

from farelake import schemas

# Vendor codes.
VENDOR_ROWS = (
    (1, "Creative Mobile Technologies"),
    (2, "VeriFone Inc"),
)

# Payment codes; only a card is electronic.
PAYMENT_TYPE_ROWS = (
    (1, "Credit Card", True),
    (2, "Cash", False),
    (3, "No Charge", False),
    (4, "Dispute", False),
    (5, "Unknown", False),
    (6, "Voided", False),
)

# Rate codes and their category.
RATE_CODE_ROWS = (
    (1, "Standard rate", "standard"),
    (2, "JFK", "airport"),
    (3, "Newark", "airport"),
    (4, "Nassau or Westchester", "negotiated"),
    (5, "Negotiated fare", "negotiated"),
    (6, "Group ride", "group"),
    (99, "Unknown", "standard"),
)

# Whether a trip was stored on the vehicle before it was sent.
FORWARD_FLAGS = ("Y", "N")


def accepted_codes() -> dict[str, tuple]:
    """The codes that each coded column of a trip may hold."""
    return {
        "vendor_id": tuple(row[0] for row in VENDOR_ROWS),
        "payment_type_id": tuple(row[0] for row in PAYMENT_TYPE_ROWS),
        "rate_code_id": tuple(row[0] for row in RATE_CODE_ROWS),
        "store_and_fwd_flag": FORWARD_FLAGS,
    }


def from_rows(spark: SparkSession, schema: StructType, rows: Iterable[tuple]) -> DataFrame:
    """A local relation. Unlike a frame made from Python rows, its size is known to the planner,
    so joins with it are broadcast because the size check passes, not because of a hint."""
    columns = list(zip(*rows)) or [[] for _ in schema.fields]
    table = pa.Table.from_arrays(
        [pa.array(column, field.type) for column, field in zip(columns, to_arrow_schema(schema))],
        names=schema.names,
    )
    return spark.createDataFrame(table, schema)


def read_csv(spark: SparkSession, path: str, schema: StructType) -> DataFrame:
    """A lookup file with a header row. The zone lookup, for one, is the public taxi zone CSV read with
    ``schemas.ZONES``. Either kind of line end works; ``N/A`` stays text."""
    return spark.read.schema(schema).option("header", True).option("mode", "FAILFAST").csv(path)


def vendors(spark: SparkSession) -> DataFrame:
    return from_rows(spark, schemas.VENDORS, VENDOR_ROWS)


def payment_types(spark: SparkSession) -> DataFrame:
    return from_rows(spark, schemas.PAYMENT_TYPES, PAYMENT_TYPE_ROWS)


def rate_codes(spark: SparkSession) -> DataFrame:
    return from_rows(spark, schemas.RATE_CODES, RATE_CODE_ROWS)
