"""Category labels for trips. In every chain the first matching rule wins."""

from __future__ import annotations

from pyspark.sql import Column
from pyspark.sql import functions as F

# The labels each rule can produce, in the order the rules are tried.
TIMES_OF_DAY = ("Morning Rush", "Midday", "Evening Rush", "Night", "Late Night")
RUSH_TIMES = ("Morning Rush", "Evening Rush")
DISTANCES = ("Short", "Medium", "Long")
DURATIONS = ("Quick", "Average", "Extended", "Long Haul")
PARTIES = ("Solo", "Small Group", "Large Group", "Unknown")
TIPS = ("Zero Tip", "Low (<10%)", "Standard (10-20%)", "Generous (>20%)")
PEAKS = ("Peak", "Off-Peak")
ZONE_CATEGORIES = ("Airport", "Manhattan Core", "Manhattan Other", "Outer Borough", "Other")
OUTER_BOROUGHS = ("Brooklyn", "Queens", "Bronx", "Staten Island")


def label(rules: list[Column], names: tuple[str, ...]) -> Column:
    """The name of the first rule that is true; the last name, which has no rule, takes the rest (nulls too)."""
    if len(rules) != len(names) - 1:
        raise ValueError("give one rule for every name but the last")
    out = F.when(rules[0], names[0])
    for rule, name in zip(rules[1:], names[1:-1]):
        out = out.when(rule, name)
    return out.otherwise(names[-1])


def time_of_day(hour: Column) -> Column:
    return label([hour.between(6, 9), hour.between(10, 15), hour.between(16, 19), hour.between(20, 23)], TIMES_OF_DAY)


def distance(miles: Column) -> Column:
    """2 and 10 miles are both Medium."""
    return label([miles < 2, miles.between(2, 10)], DISTANCES)


def duration(whole_minutes: Column) -> Column:
    """Minutes are truncated first, so 30 min 59 s is still Average."""
    return label([whole_minutes < 10, whole_minutes.between(10, 30), whole_minutes.between(31, 60)], DURATIONS)


def party(passengers: Column) -> Column:
    return label([passengers == 1, passengers.between(2, 3), passengers >= 4], PARTIES)


def tip(percentage: Column) -> Column:
    """A null percentage (zero fare) counts as no tip; a negative one falls through to the last label."""
    return label(
        [
            (percentage == 0) | percentage.isNull(),
            (percentage > 0) & (percentage < 10),
            percentage.between(10, 20),
        ],
        TIPS,
    )


def peak(time_bucket: Column) -> Column:
    return label([time_bucket.isin(*RUSH_TIMES)], PEAKS)


def zone_category(borough: Column, service_zone: Column) -> Column:
    """Airports come first, so an airport inside an outer borough is still an airport."""
    in_manhattan = borough == "Manhattan"
    return label(
        [
            service_zone.isin("Airports", "EWR"),
            in_manhattan & (service_zone == "Yellow Zone"),
            in_manhattan & (service_zone == "Boro Zone"),
            borough.isin(*OUTER_BOROUGHS),
        ],
        ZONE_CATEGORIES,
    )
