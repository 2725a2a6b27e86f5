from __future__ import annotations

import datetime as dt

import pytest
from pyspark.errors import NumberFormatException

from farelake.operators.clean import clean_trips, live_rows, number_trips

AT = dt.datetime(2022, 1, 3, 12, 0)
SECOND = dt.timedelta(seconds=1)


def kept(raw, column, values):
    """Which of the values survive cleaning, told apart by the pickup zone."""
    rows = raw(*({column: value, "pickup_location_id": i} for i, value in enumerate(values)))
    kept_rows = clean_trips(rows, keyed=False).orderBy("pickup_location_id").collect()
    return [values[r.pickup_location_id] for r in kept_rows]


@pytest.mark.parametrize(
    "column, values, expected",
    [
        ("trip_distance", [0.0, 0.01, 499.99, 500.0, None], [0.01, 499.99]),
        ("total_amount", [0.0, 0.01, 9999.99, 10000.0, None], [0.01, 9999.99]),
        ("fare_amount", [-0.01, 0.0, None, 1.0], [0.0, 1.0]),
        ("_deleted", [True, False, None], [False]),
        ("dropoff_datetime", [AT, AT - SECOND, AT + SECOND, None], [AT + SECOND]),
        ("pickup_datetime", [None, AT], [AT]),
        ("passenger_count", [None, 0, 1], [None, 0, 1]),
        ("store_and_fwd_flag", [None, "Y"], [None, "Y"]),
    ],
)
def test_validity_bounds(raw, column, values, expected):
    assert kept(raw, column, values) == expected


def test_sub_second_trip_is_kept(raw):
    assert clean_trips(raw({"dropoff_datetime": AT + dt.timedelta(milliseconds=400)}), keyed=False).count() == 1


def test_nan_amounts_are_dropped(raw):
    nan = float("nan")
    rows = raw({"trip_distance": nan}, {"total_amount": nan})
    assert clean_trips(rows, keyed=False).count() == 0


def test_rate_code_is_cast_tolerantly(raw):
    codes = ["3", "x", None, "1.0", "99", ""]
    rows = clean_trips(raw(*({"rate_code": c, "pickup_location_id": i} for i, c in enumerate(codes))), keyed=False)
    assert [r.rate_code_id for r in rows.orderBy("pickup_location_id").collect()] == [3, 99, 99, 99, 99, 99]


@pytest.mark.parametrize("column", ["vendor_id", "payment_type"])
def test_other_codes_are_cast_strictly(raw, column):
    with pytest.raises(NumberFormatException):
        clean_trips(raw({column: "abc"}), keyed=False).collect()


def test_numbers_come_after_deletion_and_before_validity(raw):
    rows = raw(
        {"pickup_location_id": 1, "_deleted": True},
        {"pickup_location_id": 2},
        {"pickup_location_id": 3, "fare_amount": -1.0},
        {"pickup_location_id": 4},
    )
    assert live_rows(rows).count() == 3
    numbers = {r.pickup_location_id: r.row_num for r in number_trips(rows).collect()}
    assert numbers == {2: 1, 3: 2, 4: 3}
    ids = {r.pickup_location_id: r.trip_id for r in clean_trips(rows).collect()}
    # MD5 of "1" and of "3": the rejected trip has used up number 2.
    assert ids == {2: "c4ca4238a0b923820dcc509a6f75849b", 4: "eccbc87e4b5ce2fe28308fd9f2a7baf3"}


def test_columns(raw):
    keyed, plain = clean_trips(raw({})), clean_trips(raw({}), keyed=False)
    assert len(keyed.columns) == 19 and keyed.columns[0] == "trip_id"
    assert plain.columns == keyed.columns[1:]
    assert "_deleted" not in keyed.columns
