"""Data checks. A check is a query for what violates it; nothing returned means it passed."""

from __future__ import annotations

from collections.abc import Callable, Iterable, Mapping, Sequence
from dataclasses import dataclass
from functools import reduce

from pyspark.sql import Column, DataFrame, SparkSession
from pyspark.sql import functions as F
from pyspark.sql.types import LongType, StringType, StructField, StructType

from farelake.functions.calendar import elapsed_seconds, instant
from farelake.functions.numeric import rows
from farelake.sources.lookups import from_rows

# --- what violates a check -------------------------------------------------------------------------------


def duplicates(df: DataFrame, key: str) -> DataFrame:
    """Values of ``key`` that occur more than once. Partial counts collapse a much-repeated key early."""
    return df.where(F.col(key).isNotNull()).groupBy(key).agg(rows().alias("row_count")).where(F.col("row_count") > 1)


def null_counts(df: DataFrame, columns: Sequence[str]) -> DataFrame:
    """Per column, how many rows have no value; all columns in one pass."""
    counts = df.agg(*(F.count_if(F.col(c).isNull()).alias(c) for c in columns))
    pairs = F.array(*(F.struct(F.lit(c).alias("column_name"), F.col(c).alias("violations")) for c in columns))
    return counts.select(F.inline(pairs))


def _unexpected(column: str, accepted: Iterable) -> Column:
    """The value as text where it is not accepted; null where it is, and for null, which always passes."""
    return F.when(~F.col(column).isin(*accepted), F.col(column).cast("string"))


def unaccepted_values(df: DataFrame, accepted: Mapping[str, Iterable]) -> DataFrame:
    """Values outside the accepted ones of their column, with their number of rows; all columns in one pass."""
    return _found_values(df, {c: _unexpected(c, ok) for c, ok in accepted.items()})


def _found_values(df: DataFrame, wrong: Mapping[str, Column]) -> DataFrame:
    """What is wrong in each column, with its number of rows.

    Rows are grouped by all wrong values together, which are null nearly everywhere: so a task passes on few groups,
    and only these are taken apart by column.
    """
    groups = df.groupBy(*(value.alias(c) for c, value in wrong.items())).agg(rows().alias("n"))
    cells = F.array(*(F.struct(F.lit(c).alias("column_name"), F.col(c).alias("value"), F.col("n")) for c in wrong))
    apart = groups.select(F.inline(cells)).where(F.col("value").isNotNull())
    return apart.groupBy("column_name", "value").agg(F.sum("n").alias("row_count"))


#: Up to so many keys, a parent is a list of values in the filter; a larger one is joined.
LISTED_KEYS = 10_000


def orphans(child: DataFrame, parents: Mapping[str, tuple[DataFrame, str]], listed: int = LISTED_KEYS) -> DataFrame:
    """Non-null keys without a parent, with their number of rows.

    ``parents`` maps a key column to the parent relation and its key. All columns whose parents have at most ``listed``
    keys are tested in one pass against these, and only orphans are taken apart. A larger parent meets one row per
    distinct key.
    """
    wrong, found = {}, []
    for column, (parent, key) in parents.items():
        keys = [r[0] for r in parent.select(key).limit(listed + 1).collect()]
        if len(keys) <= listed:
            known = [k for k in keys if k is not None]
            wrong[column] = _unexpected(column, known) if known else F.col(column).cast("string")
        else:
            counts = child.where(F.col(column).isNotNull()).groupBy(F.col(column).alias("_key")).agg(rows().alias("row_count"))
            lost = counts.join(parent.select(F.col(key).alias("_parent")), F.col("_key") == F.col("_parent"), "left_anti")
            found.append(lost.select(F.lit(column).alias("column_name"), F.col("_key").cast("string").alias("value"), "row_count"))
    return reduce(DataFrame.unionByName, ([_found_values(child, wrong)] if wrong else []) + found)


def total_below_fare() -> Column:
    return (F.col("total_amount") < F.col("fare_amount")) & (F.col("fare_amount") > 0)


def no_whole_minute() -> Column:
    return F.col("trip_duration_minutes") <= 0


def over_four_hours() -> Column:
    return F.col("trip_duration_minutes") > 240


def over_speed_limit() -> Column:
    return F.col("avg_speed_mph") > 80


def freshness(
    df: DataFrame, as_of: str, loaded_at: str = "_synced", warn_hours: int = 24, error_hours: int = 48
) -> DataFrame:
    """How old the newest row was at ``as_of``. A table without rows is an error."""
    age = F.col("age_seconds")
    status = F.when(age <= warn_hours * 3600, "pass").when(age <= error_hours * 3600, "warn").otherwise("error")
    newest = df.agg(F.max(loaded_at).alias("newest"))
    aged = newest.withColumn("age_seconds", elapsed_seconds(F.col("newest"), instant(as_of)))
    return aged.withColumn("status", status)


# --- declared checks and their report --------------------------------------------------------------------


@dataclass(frozen=True)
class Check:
    """One declared check. ``severity`` is what a violation means: ``error`` or ``warn``."""

    kind: str
    name: str
    table: str
    column: str = ""
    severity: str = "error"
    accepted: tuple = ()
    parent: tuple[str, str] = ("", "")
    violates: Callable[[], Column] | None = None


def unique(table: str, column: str) -> Check:
    return Check("unique", "unique", table, column)


def grain(name: str, table: str, column: str) -> Check:
    return Check("grain", name, table, column)


def not_null(table: str, *columns: str) -> list[Check]:
    return [Check("not_null", "not_null", table, column) for column in columns]


def accepted_values(table: str, column: str, values: Iterable, severity: str = "error") -> Check:
    return Check("accepted", "accepted_values", table, column, severity, accepted=tuple(values))


def relationship(table: str, column: str, parent: str, parent_key: str, severity: str = "warn") -> Check:
    return Check("parent", "relationships", table, column, severity, parent=(parent, parent_key))


def no_rows(name: str, table: str, violates: Callable[[], Column], severity: str = "error") -> Check:
    return Check("rows", name, table, "", severity, violates=violates)


_DECLARED = StructType(
    [
        StructField("check_id", LongType()),
        StructField("check_name", StringType()),
        StructField("table_name", StringType()),
        StructField("column_name", StringType()),
        StructField("severity", StringType()),
    ]
)

Numbered = Sequence[tuple[int, Check]]


def _cell(check_id: int, value: Column, violations: Column) -> Column:
    return F.struct(
        F.lit(check_id).cast("bigint").alias("check_id"),
        value.cast("string").alias("value"),
        violations.cast("bigint").alias("violations"),
    )


def _row_checks(df: DataFrame, checks: Numbered) -> DataFrame:
    """All not-null, accepted-value and row checks of a table in one scan and one shuffle.

    Rows are grouped by their unaccepted values, which are null nearly everywhere, so the groups stay few.
    A not-null or row check counts rows; an accepted-values check counts distinct unaccepted values.
    """
    by_value = [(i, c) for i, c in checks if c.kind == "accepted"]
    by_row = [(i, c) for i, c in checks if c.kind != "accepted"]
    counts = [
        F.count_if(c.violates() if c.violates else F.col(c.column).isNull()).alias(f"n{i}") for i, c in by_row
    ]
    groups = df.groupBy(*(_unexpected(c.column, c.accepted).alias(f"v{i}") for i, c in by_value))
    nothing, zero = F.lit(None), F.lit(0)
    cells = [_cell(i, F.col(f"v{i}"), zero) for i, _ in by_value] + [
        _cell(i, nothing, F.col(f"n{i}")) for i, _ in by_row
    ]
    found = groups.agg(*counts, rows().alias("n")).select(F.inline(F.array(*cells)))
    return found.groupBy("check_id").agg((F.sum("violations") + F.countDistinct("value")).alias("violations"))


def row_metrics(tables: Iterable[str], checks: Sequence[Check]) -> dict[str, Column]:
    """For each not-null, accepted-value and row check on these tables, by its number: how many rows violate it. They
    can be observed while the rows are written, without a pass of their own."""
    metrics = {}
    for i, check in enumerate(checks):
        if check.table in tables and check.kind in ("not_null", "accepted", "rows"):
            column = F.col(check.column) if check.column else None
            if check.violates:
                violated = check.violates()
            else:
                violated = ~column.isin(*check.accepted) if check.kind == "accepted" else column.isNull()
            metrics[str(i)] = F.count_if(violated).alias(str(i))
    return metrics


def _settled(checks: Numbered, observed: Mapping[str, int]) -> dict[int, int]:
    """The violations of checks that observed metrics tell. A check of accepted values counts different values, which
    the number of rows tells only where there are none."""
    found = {i: observed[str(i)] for i, _ in checks if str(i) in observed}
    return {i: n for i, n in found.items() if not n or dict(checks)[i].kind != "accepted"}


def _parent_checks(df: DataFrame, checks: Numbered, tables: Mapping[str, DataFrame]) -> DataFrame:
    """All relationship checks of a table in one scan; each orphaned row counts."""
    parents = {c.column: (tables[c.parent[0]], c.parent[1]) for _, c in checks}
    found = orphans(df, parents).groupBy("column_name").agg(F.sum("row_count").alias("violations"))
    ids = F.create_map(*(F.lit(x) for i, c in checks for x in (c.column, i)))
    return found.select(ids[F.col("column_name")].cast("bigint").alias("check_id"), "violations")


def _key_checks(df: DataFrame, column: str, checks: Numbered) -> DataFrame:
    """Repeated keys of one column, counted once for all checks on it. Uniqueness ignores null; a grain
    check does not."""
    key = F.col(column)
    counts = df.groupBy(key).agg(rows().alias("row_count")).where(F.col("row_count") > 1)
    repeated = counts.agg(rows().alias("keys"), F.count(key).alias("values"))
    nothing = F.lit(None)
    cells = [_cell(i, nothing, F.col("keys" if c.kind == "grain" else "values")) for i, c in checks]
    return repeated.select(F.inline(F.array(*cells))).select("check_id", "violations")


_COUNTED = StructType([StructField("check_id", LongType()), StructField("violations", LongType())])


def run_checks(
    spark: SparkSession, tables: Mapping[str, DataFrame], checks: Sequence[Check], observed: Mapping[str, int] | None = None
) -> DataFrame:
    """One row per check: what it found and whether it passed, warned or failed.

    Names that map to the same DataFrame object share their passes over it. ``observed`` are metrics (``row_metrics``)
    that were counted while a table was written; what they tell is not counted again.
    """
    numbered = list(enumerate(checks))
    settled = _settled(numbered, observed or {})
    declared = from_rows(spark, _DECLARED, [(i, c.name, c.table, c.column, c.severity) for i, c in numbered])
    found = [from_rows(spark, _COUNTED, [(i, settled.get(i, 0)) for i, _ in numbered])]
    for df in {id(tables[c.table]): tables[c.table] for c in checks}.values():
        own = [(i, c) for i, c in numbered if tables[c.table] is df]
        keyed = [(i, c) for i, c in own if c.kind in ("unique", "grain")]
        for column in dict.fromkeys(c.column for _, c in keyed):
            found.append(_key_checks(df, column, [(i, c) for i, c in keyed if c.column == column]))
        parented = [(i, c) for i, c in own if c.kind == "parent"]
        if parented:
            found.append(_parent_checks(df, parented, tables))
        per_row = [(i, c) for i, c in own if c.kind in ("not_null", "accepted", "rows") and i not in settled]
        if per_row:
            found.append(_row_checks(df, per_row))
    totals = reduce(DataFrame.unionByName, found).groupBy("check_id").agg(F.sum("violations").alias("violations"))
    status = F.when(F.col("violations") == 0, "pass").when(F.col("severity") == "warn", "warn").otherwise("fail")
    return (
        totals.join(declared, "check_id")
        .withColumn("status", status)
        .select("check_name", "table_name", "column_name", "severity", "violations", "status")
    )
