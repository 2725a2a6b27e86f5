"""Reports as partial aggregates that can be added up.

A report groups trips by its keys and shows measures. Every measure is made of *states*: sums, counts and bit masks that
can be merged over any division of the trips, by month or by batch. ``Report.state`` makes the states of some trips,
``merge`` adds up the states of several sets, ``finish`` turns merged states into the measures. Measures that need the
same state share it.

Distinct days are kept as one bit per day of the month: masks of one month are or-ed, and the bits of different months
are counted and added. So states that hold masks are made and merged by month first.
"""

from __future__ import annotations

from collections.abc import Iterable, Mapping
from dataclasses import dataclass
from functools import reduce

from pyspark.sql import Column, DataFrame
from pyspark.sql import functions as F

from farelake.functions import numeric
from farelake.functions.calendar import month_start
from farelake.functions.numeric import ratio, round_to, rows

MONTH = "month_start"
_MASK = "mask_"


@dataclass(frozen=True)
class Measure:
    """``states``: aggregates of trips by name. ``value``: the measure, over columns of these names."""

    states: Mapping[str, Column]
    value: Column


def trips() -> Measure:
    return Measure({"n": rows()}, F.col("n"))


def _money(column: str) -> tuple[dict[str, Column], tuple[Column, Column]]:
    states = {f"whole_{column}": numeric.millionths(column), f"large_{column}": numeric.large_amounts(column)}
    return states, (F.col(f"whole_{column}"), F.col(f"large_{column}"))


def total(column: str) -> Measure:
    """A sum of money, rounded to cents."""
    states, parts = _money(column)
    return Measure(states, numeric.rounded_amount(*parts))


def exact_total(column: str) -> tuple[Measure, Measure]:
    """Two measures that order sums of money: as doubles, and among equal doubles as decimals."""
    states, (whole, large) = _money(column)
    return Measure(states, numeric.amount(whole, large)), Measure(states, numeric.exact_amount(whole, large))


def money_mean(column: str, digits: int = 2) -> Measure:
    states, (whole, large) = _money(column)
    count = f"n_{column}"
    return Measure({**states, count: F.count(column)}, round_to(ratio(numeric.amount(whole, large), F.col(count)), digits))


def mean(column: str, digits: int) -> Measure:
    states = {f"sum_{column}": F.sum(column), f"n_{column}": F.count(column)}
    return Measure(states, round_to(ratio(F.col(f"sum_{column}"), F.col(f"n_{column}")), digits))


def count_of(name: str, condition: Column) -> Measure:
    """The number of trips for which a condition holds."""
    return Measure({f"if_{name}": F.count_if(condition)}, F.col(f"if_{name}"))


def percent(part: Measure, whole: Measure) -> Measure:
    return Measure({**part.states, **whole.states}, numeric.percent(part.value, whole.value))


def distinct_days(day: str) -> Measure:
    """The number of different days; one bit for each day of the month."""
    bit = F.expr(f"shiftleft(1, dayofmonth({day}) - 1)")
    return Measure({f"{_MASK}{day}": F.bit_or(bit)}, F.col(f"{_MASK}{day}"))


@dataclass(frozen=True)
class Report:
    """Keys by name, over columns of the trips, and measures by name.

    With ``sides``, each trip is counted once for each side: the keys are those columns in turn, under the name
    ``key``, with the side's name in ``side``.
    """

    keys: Mapping[str, Column]
    measures: Mapping[str, Measure]
    sides: Mapping[str, str] | None = None

    @property
    def key_names(self) -> list[str]:
        return ["key", "side"] if self.sides else list(self.keys)

    @property
    def states(self) -> dict[str, Column]:
        return reduce(lambda found, m: {**found, **m.states}, self.measures.values(), {})

    @property
    def _masked(self) -> bool:
        return any(name.startswith(_MASK) for name in self.states)

    def state(self, trips: DataFrame, monthly: bool = True, day: str = "pickup_date") -> DataFrame:
        """The states of these trips by key, and by month unless ``monthly`` is off. Partially aggregated before the
        one shuffle."""
        states = [column.alias(name) for name, column in self.states.items()]
        month = [month_start(F.col(day)).alias(MONTH)] if monthly else []
        if not self.sides:
            return trips.groupBy(*month, *(c.alias(name) for name, c in self.keys.items())).agg(*states)
        # One scan and one shuffle for all sides, by grouping sets.
        columns = [F.col(c) for c in self.sides.values()]
        dated = trips.withColumn(MONTH, month[0]) if monthly else trips
        kept = [F.col(MONTH)] if monthly else []
        marks = [F.grouping(c).alias(f"not_{c}") for c in self.sides.values()]
        sets = dated.groupingSets([[*kept, c] for c in columns], *kept, *columns).agg(*marks, *states)
        chosen = {side: F.col(f"not_{c}") == 0 for side, c in self.sides.items()}
        key = F.coalesce(*(F.when(chosen[side], F.col(c)) for side, c in self.sides.items()))
        side = F.coalesce(*(F.when(mine, F.lit(name)) for name, mine in chosen.items()))
        return sets.select(*kept, key.alias("key"), side.alias("side"), *self.states)

    def merge(self, states: DataFrame) -> DataFrame:
        """One row of states per key, from the states of several sets of trips."""
        if self._masked:
            months = _added(states, [MONTH, *self.key_names])
            states = months.withColumns({c: F.bit_count(c).cast("bigint") for c in self.states if c.startswith(_MASK)})
        return _added(states.select(*self.key_names, *self.states), self.key_names, masks=False)

    def finish(self, merged: DataFrame) -> DataFrame:
        return merged.select(*self.key_names, *(m.value.alias(name) for name, m in self.measures.items()))

    def of(self, trips: DataFrame) -> DataFrame:
        """Keys and measures straight from trips."""
        if self._masked:
            return self.finish(self.merge(self.state(trips)))
        return self.finish(self.state(trips, monthly=False))


def _added(states: DataFrame, keys: Iterable[str], masks: bool = True) -> DataFrame:
    keys = list(keys)
    added = []
    for name, kind in states.dtypes:
        if name not in keys:
            how = F.bit_or(name) if masks and name.startswith(_MASK) else F.sum(name).cast(kind)
            added.append(how.alias(name))
    return states.groupBy(*keys).agg(*added)
