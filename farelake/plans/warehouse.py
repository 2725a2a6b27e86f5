"""The whole flow: landing rows to dimensions, fact, reports and checks."""

from __future__ import annotations

import datetime as dt
from collections.abc import Callable, Mapping, Sequence
from copy import copy
from dataclasses import dataclass

from pyspark.sql import DataFrame, SparkSession
from pyspark.sql import functions as F
from pyspark.sql.types import DateType, LongType, StructField, StructType

from farelake.functions.calendar import month_start
from farelake.operators import clean, enrich, reports, star
from farelake.operators.quality import Check, row_metrics, run_checks
from farelake.plans.checks import all_checks
from farelake.schemas import FACT
from farelake.session import sized_partitions
from farelake.sources import landing, lookups, store
from farelake.sources.versions import MONTH, WHOLE, Parts, Versions, in_order, without_month


@dataclass(frozen=True)
class Lookups:
    vendors: DataFrame
    payment_types: DataFrame
    rate_codes: DataFrame
    zones: DataFrame

    @classmethod
    def with_zones(cls, spark: SparkSession, zones: DataFrame) -> Lookups:
        """The fixed code tables, and the zone lookup that the caller read."""
        return cls(lookups.vendors(spark), lookups.payment_types(spark), lookups.rate_codes(spark), zones)


def dimensions(known: Lookups, trips: DataFrame, at: str = "pickup_at") -> dict[str, DataFrame]:
    """The five dimensions; the calendar covers the days of ``trips``."""
    return {
        "dim_vendor": star.vendor_dim(known.vendors),
        "dim_payment_type": star.payment_type_dim(known.payment_types),
        "dim_rate_code": star.rate_code_dim(known.rate_codes),
        "dim_location": star.location_dim(known.zones),
        "dim_date": star.date_dim(star.spine_of(trips, at)),
    }


def all_reports(fact: DataFrame, known: Lookups, as_of: str) -> dict[str, DataFrame]:
    """The seven reports straight from trips."""
    return _shown({name: made().of(fact) for name, made in reports.REPORTS.items()}, known, as_of)


def _shown(stats: Mapping[str, DataFrame], known: Lookups, as_of: str) -> dict[str, DataFrame]:
    """The reports as they are shown, from their finished measures."""
    locations = star.location_dim(known.zones)
    return {
        "location_stats": reports.location_report(stats["locations"], locations, as_of),
        "location_stats_plain": reports.location_report(stats["locations"], as_of=as_of),
        "zone_performance": reports.zone_report(stats["zones"], locations),
        "trip_patterns": reports.pattern_report(stats["patterns"]),
        "daily_revenue": reports.day_report(stats["days"]),
        "payment_tipping": reports.tipping_report(stats["tipping"], known.payment_types),
        "service_analysis": reports.service_report(stats["service"], known.rate_codes),
    }


def check_tables(
    enriched: DataFrame, fact: DataFrame, known: Lookups, dims: Mapping[str, DataFrame], made: Mapping[str, DataFrame]
) -> dict[str, DataFrame]:
    """Relations by the names the checks use. Enriching only adds columns, so the checks on clean trips read
    the enriched ones and share their passes."""
    return {
        "vendors": known.vendors,
        "rate_codes": known.rate_codes,
        "payment_types": known.payment_types,
        "zones": known.zones,
        "trips_clean": enriched,
        "trips_enriched": enriched,
        "fact_trips": fact,
        **dims,
        **made,
    }


#: The relations whose checks read the fact's rows.
_TRIP_TABLES = ("trips_clean", "trips_enriched", store.FACT_TABLE)


# --- refresh -------------------------------------------------------------------------------------------------


@dataclass(frozen=True)
class Stale:
    """What a refresh has to do: ``months`` of the landing table whose trips the fact lacks or has in another state,
    with the number of live rows before each, and the months to drop."""

    months: dict[str, int]
    gone: list[str]


def stale_months(landed: Versions, out: Versions) -> Stale:
    """Compare the landing table's months with those that the fact was made of. Both sides are read from the stores'
    manifests; no table is scanned.

    A month is stale if its rows were loaded anew, or if the number of live rows before it has changed: then its ids
    have, too. Rows without a pickup time are no trips, but come first in the numbering.
    """
    parts, fact = landed.parts(landing.LANDING), out.parts(store.FACT_TABLE)
    months, before = {}, 0
    for month in in_order(parts):
        known = fact.get(month, {})
        if not without_month(month) and (known.get("source"), known.get("after")) != (parts[month]["version"], before):
            months[month] = before
        before += int(parts[month]["live"])
    return Stale(months, sorted(m for m in fact if m not in parts))


def numbered_of_months(landed: Versions, months: Mapping[str, int], partitions: int | None = None) -> DataFrame:
    """The valid trips of some months, each given with the number of live rows before it; only these are scanned. They
    have their ``row_num``, of which the key is made.

    The live rows of all of them are numbered together, and each month's numbers are shifted to where they belong, so
    every id is the one that numbering the whole landing table gives.
    """
    raw = landing.read_landing(landed, months)
    numbered = clean.number_trips(raw, partitions or sized_partitions(raw))
    shifts, counted = {}, 0
    for month in in_order(months):
        shifts[month] = months[month] - counted
        counted += int(landed.parts(landing.LANDING)[month]["live"])
    if len(set(shifts.values())) == 1:
        shift = F.lit(next(iter(shifts.values())))
    else:
        schema = StructType([StructField("_month", DateType()), StructField("_shift", LongType())])
        rows = [(dt.date.fromisoformat(m), n) for m, n in shifts.items()]
        month = month_start(F.to_date("pickup_datetime"))
        numbered = numbered.join(lookups.from_rows(raw.sparkSession, schema, rows), month == F.col("_month"))
        shift = F.col("_shift")
    return clean.valid_trips(clean.standardize(numbered.withColumn("row_num", F.col("row_num") + shift), keyed=False))


def refresh_fact(landed: Versions, out: Versions, known: Lookups, as_of: str, partitions: int | None = None) -> Stale:
    """Bring the stored fact up to date with the landing table: stale months are made again, vanished ones dropped."""
    changes, stale, _ = _staged_fact(landed, out, known, as_of, partitions)
    out.commit(changes)
    return stale


def _staged_fact(
    landed: Versions, out: Versions, known: Lookups, as_of: str, partitions: int | None, checks: Sequence[Check] = ()
) -> tuple[dict[str, Parts], Stale, dict[str, int]]:
    """The fact's parts as they will be, what was stale, and the row metrics of ``checks`` on the rows written."""
    stale = stale_months(landed, out)
    kept = {m: part for m, part in out.parts(store.FACT_TABLE).items() if m not in stale.months and m not in stale.gone}
    fresh: Parts = {}
    observed: dict[str, int] = {}
    if stale.months:
        trips, finish = stored_form(numbered_of_months(landed, stale.months, partitions), known, as_of)
        written, observed = store.stage_fact(out, trips, partitions, row_metrics(_TRIP_TABLES, checks), finish)
        version = next(iter(written.values()))["version"] if written else "none"
        for month, before in stale.months.items():
            rows = written.get(month, {}).get("rows", 0)  # a month may have no valid trip
            source = landed.parts(landing.LANDING)[month]["version"]
            fresh[month] = {"version": version, "rows": rows, "source": source, "after": before}
    return {store.FACT_TABLE: {**kept, **fresh}}, stale, observed


def state_table(name: str) -> str:
    """Where the monthly states of a report are kept."""
    return f"state_{name}"


def _staged_states(out: Versions, fact: Parts, stale: Stale) -> dict[str, Parts]:
    """The states of all reports, made anew for the stale months."""
    spark, changes = out.spark, {}
    rows = {m: {store.FACT_TABLE: fact[m]} for m in stale.months if fact[m]["rows"]}
    changed = _as_of(out, {store.FACT_TABLE: {m: fact[m] for m in rows}})
    for name, made in reports.REPORTS.items():
        table = state_table(name)
        kept = {m: part for m, part in out.parts(table).items() if m not in stale.months and m not in stale.gone}
        if rows:
            states = made().state(store.read_fact(changed))
            version = out.write(table, states.repartition(MONTH), monthly=True)
            kept.update({m: {"version": version} for m in rows})
        changes[table] = kept
    return changes


def _as_of(out: Versions, changes: Mapping[str, Parts]) -> Versions:
    """The store as it will be after a commit of these changes."""
    ahead = copy(out)
    ahead.tables = {**out.tables, **changes}
    return ahead


def reports_of_states(out: Versions, known: Lookups, as_of: str) -> dict[str, DataFrame]:
    """The seven reports from the stored monthly states; the fact is not read."""
    stats = {}
    for name, made in reports.REPORTS.items():
        report = made()
        schema = report.state(out.spark.createDataFrame([], FACT)).schema
        stats[name] = report.finish(report.merge(out.read(state_table(name), schema)))
    return _shown(stats, known, as_of)


def refresh(landed: Versions, out: Versions, known: Lookups, as_of: str, partitions: int | None = None) -> DataFrame:
    """Bring all tables up to date with the landing table, and return the check report.

    Only the stale months of the landing table and of the fact are read: their trips are numbered, stored and summed up
    again, and the reports are made of the monthly states, most of which were there. All tables switch in one commit, so
    no reader sees a report of another state than the fact. The checks of trips cover the stale months (ids of different
    months differ, as their numbers do), and those of single rows are counted while these are written.
    """
    spark = out.spark
    checks = all_checks()
    changes, stale, observed = _staged_fact(landed, out, known, as_of, partitions, checks)
    changes |= _staged_states(out, changes[store.FACT_TABLE], stale)
    ahead = _as_of(out, changes)
    days = reports.days_stats().state(spark.createDataFrame([], FACT)).schema
    dims = dimensions(known, ahead.read(state_table("days"), days), "pickup_date")
    made = reports_of_states(ahead, known, as_of)
    for name, df in {**dims, **made}.items():
        changes[name] = {WHOLE: {"version": out.write(name, df)}}
    out.commit(changes)
    stored = {name: out.read(name, df.schema) for name, df in {**dims, **made}.items()}
    fact = store.read_fact(out, months=stale.months)
    checked = check_tables(fact, fact, known, {n: stored[n] for n in dims}, {n: stored[n] for n in made})
    return run_checks(spark, checked, checks, observed)


def build(
    landed: Versions, out: Versions, known: Lookups, as_of: str, partitions: int | None = None
) -> DataFrame:
    """Build every table anew, whatever is stored, and return the check report."""
    empty = copy(out)
    empty.tables = {}
    report = refresh(landed, empty, known, as_of, partitions)
    out.number, out.tables = empty.number, empty.tables
    return report


def register_views(tables: Mapping[str, DataFrame]) -> None:
    """Make relations available to SQL under their names."""
    for name, df in tables.items():
        df.createOrReplaceTempView(name)


def stored_form(trips: DataFrame, known: Lookups, as_of: str) -> tuple[DataFrame, Callable[[DataFrame], DataFrame]]:
    """What of numbered, valid trips has to be placed in a stored fact, and how its rows are made of that.

    The second part is a projection only, so the writer knows that placed rows stay in order; a join would make it sort
    them again, by month alone.
    """

    def finish(placed: DataFrame) -> DataFrame:
        keyed = enrich.enrich_trips(placed.withColumn("trip_id", clean.trip_key()))
        return star.fact_rows(keyed, as_of, keep=[MONTH])

    return star.named(trips, known.vendors, known.payment_types, known.rate_codes), finish
