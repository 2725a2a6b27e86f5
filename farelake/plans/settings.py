"""Parameters of the registered queries, shared with their SQL counterparts."""

EXTRACT_START = "1996-03-15 00:00:00"
EXTRACT_END = "2001-03-15 00:00:00"

SAMPLE_SHARE = 0.4
SAMPLE_KEYS = ("pickup_datetime", "dropoff_datetime", "pickup_location_id")

SCAN_START = "1997-02-10"
SCAN_END = "2000-08-20"

TOP_ZONES = 10

HISTORY_FIRST = "1998-06-01"
HISTORY_SECOND = "2001-12-01"

#: The days of the snapshots of a stored history.
SNAPSHOT_DAYS = ("1996-01-01", "1997-01-01", "1999-06-01", "2001-12-01")

#: What the second load of the fact's months changes; no trip is picked up after LAST_MONTH.
CORRECTED_MONTH = "1995-03-01"
LATE_MONTH = "1999-05-01"
LAST_MONTH = "2001-12-01"
MISTAKEN_FROM = "2020-01-01"
