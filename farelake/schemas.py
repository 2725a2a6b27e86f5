"""Declared schemas. Nothing in this package infers a schema from data."""

from __future__ import annotations

from pyspark.sql.types import (
    BooleanType,
    DateType,
    DoubleType,
    LongType,
    StringType,
    StructField,
    StructType,
    TimestampNTZType,
)


def _struct(**fields) -> StructType:
    return StructType([StructField(name, kind, True) for name, kind in fields.items()])


_text, _int, _float, _bool = StringType(), LongType(), DoubleType(), BooleanType()
_date, _ts = DateType(), TimestampNTZType()

# What a trip source delivers. Codes arrive as text and are cast while cleaning.
SOURCE_TRIPS = _struct(
    vendor_id=_text,
    pickup_datetime=_ts,
    dropoff_datetime=_ts,
    passenger_count=_int,
    trip_distance=_float,
    pickup_location_id=_int,
    dropoff_location_id=_int,
    rate_code=_text,
    store_and_fwd_flag=_text,
    payment_type=_text,
    fare_amount=_float,
    extra=_float,
    mta_tax=_float,
    tip_amount=_float,
    tolls_amount=_float,
    imp_surcharge=_float,
    total_amount=_float,
)

# The landing table: the source plus what the sync adds.
RAW_TRIPS = StructType([*SOURCE_TRIPS.fields, StructField("_synced", _ts, True), StructField("_deleted", _bool, True)])

VENDORS = _struct(vendor_id=_int, vendor_name=_text)
PAYMENT_TYPES = _struct(payment_type_id=_int, payment_type_name=_text, is_electronic=_bool)
RATE_CODES = _struct(rate_code_id=_int, rate_code_name=_text, rate_category=_text)
ZONES = _struct(location_id=_int, zone_name=_text, borough=_text, service_zone=_text)

# The wide fact.
FACT = _struct(
    trip_id=_text,
    pickup_location_id=_int,
    dropoff_location_id=_int,
    vendor_id=_int,
    payment_type_id=_int,
    rate_code_id=_int,
    store_and_fwd_flag=_text,
    pickup_date=_date,
    pickup_year=_int,
    pickup_month=_int,
    pickup_day=_int,
    pickup_hour=_int,
    pickup_day_of_week=_int,
    pickup_day_name=_text,
    pickup_week=_int,
    is_weekend=_bool,
    time_of_day_bucket=_text,
    trip_distance_category=_text,
    trip_duration_category=_text,
    passenger_category=_text,
    pickup_at=_ts,
    dropoff_at=_ts,
    passenger_count=_int,
    trip_distance_miles=_float,
    trip_duration_seconds=_int,
    trip_duration_minutes=_int,
    fare_amount=_float,
    extra_charges=_float,
    mta_tax=_float,
    tip_amount=_float,
    tolls_amount=_float,
    improvement_surcharge=_float,
    total_surcharges=_float,
    total_amount=_float,
    fare_per_mile=_float,
    tip_percentage=_float,
    avg_speed_mph=_float,
    revenue_per_hour=_float,
    vendor_name=_text,
    payment_type_name=_text,
    rate_code_name=_text,
    synced_at=_ts,
    updated_at=_ts,
)

# The fact as stored, with its partition column last.
STORED_FACT = StructType([*FACT.fields, StructField("month_start", _date, True)])
