"""The same results in plain SQL, for an independent engine to check the Spark queries against.

Each relation is a CTE; a query names what it reads and gets those CTEs and whatever they rest on.
"""

from __future__ import annotations

import re

from farelake.functions.keys import NULL_PART
from farelake.plans import fixture
from farelake.plans.settings import (
    EXTRACT_END,
    EXTRACT_START,
    HISTORY_FIRST,
    HISTORY_SECOND,
    SAMPLE_KEYS,
    SAMPLE_SHARE,
    SCAN_END,
    SCAN_START,
    SNAPSHOT_DAYS,
    TOP_ZONES,
)
from farelake.schemas import RAW_TRIPS


def _r(value: str, digits: int) -> str:
    return f"cast(round(cast({value} as decimal(38, 12)), {digits}) as double)"


def _sum(column: str, name: str) -> str:
    return f"cast(round({_exact(column)}, 2) as double) as {name}"


def _exact(column: str) -> str:
    """A sum of money that does not depend on the order."""
    return f"sum(cast({column} as decimal(18, 6)))"


def _money_avg(column: str, name: str) -> str:
    return f"{_r(f'cast({_exact(column)} as double) / count({column})', 2)} as {name}"


def _avg(column: str, digits: int, name: str) -> str:
    return f"{_r(f'avg({column})', digits)} as {name}"


def _pct(part: str, whole: str, name: str) -> str:
    return f"{_r(f'100e0 * cast({part} as double) / nullif({whole}, 0)', 1)} as {name}"


def _share(part: str, whole: str, name: str) -> str:
    """A percentage that multiplies after dividing."""
    return f"{_r(f'cast({part} as double) / nullif({whole}, 0) * 100e0', 1)} as {name}"


_CTES: dict[str, str] = {}

_CTES["seeded"] = """
    select l_partkey, l_suppkey, l_linenumber, l_quantity, l_returnflag, l_shipdate,
           l_orderkey * 31 + l_partkey * 17 + l_suppkey * 7 + l_linenumber as h,
           cast(floor(l_extendedprice) as bigint) % 6000 + 250 as base,
           substr(o_orderpriority, 1, 1) as pay
    from lineitem join orders on o_orderkey = l_orderkey"""

_CTES["priced"] = """
    select *,
           case when h % 151 = 0 then -base when h % 83 = 0 then 0 else base end as fare,
           case when pay = '1' and h % 151 <> 0 and h % 83 <> 0 then base * (h % 31) // 100 else 0 end as tip,
           case when h % 19 = 0 then 655 else 0 end as toll,
           l_shipdate + to_seconds(h * 37 % 86400) as pickup
    from seeded"""

_CTES["raw"] = f"""
    select case when h % 97 = 0 then '5' else cast(1 + h % 2 as varchar) end as vendor_id,
           pickup as pickup_datetime,
           pickup + to_seconds(case when h % 211 = 0 then 15000 + h % 3600 else h % 4200 - 30 end)
               as dropoff_datetime,
           nullif(cast(l_quantity as bigint) % 7, 6) as passenger_count,
           case when h % 101 = 0 then 0e0 when h % 499 = 0 then 500 + l_quantity
                else l_quantity * 0.37e0 end as trip_distance,
           1 + l_partkey % 265 as pickup_location_id,
           cast(1 + (l_suppkey * 13 + l_linenumber * 29) % 265 as bigint) as dropoff_location_id,
           case when h % 50 = 0 then null when h % 50 = 1 then 'x'
                else cast(1 + (h % 50) % 6 as varchar) end as rate_code,
           case l_returnflag when 'A' then 'Y' when 'N' then 'N' end as store_and_fwd_flag,
           pay as payment_type,
           fare / 100e0 as fare_amount,
           (h % 3) * 0.5e0 as extra,
           0.5e0 as mta_tax,
           tip / 100e0 as tip_amount,
           toll / 100e0 as tolls_amount,
           0.3e0 as imp_surcharge,
           (fare + (h % 3) * 50 + 50 + tip + toll + 30) / 100e0 as total_amount,
           timestamp '{fixture.SYNCED_AT}' as _synced,
           h % 307 = 0 as _deleted
    from priced"""

_TIES = ", ".join(f"{c} nulls first" for c in RAW_TRIPS.names)

_CTES["numbered"] = f"""
    select *, row_number() over (order by pickup_datetime nulls first, dropoff_datetime nulls first,
                                          pickup_location_id nulls first, {_TIES}) as row_num
    from raw where not _deleted"""

_CLEAN_COLUMNS = """
           cast(vendor_id as bigint) as vendor_id,
           pickup_location_id, dropoff_location_id,
           pickup_datetime as pickup_at, dropoff_datetime as dropoff_at,
           passenger_count, trip_distance as trip_distance_miles,
           coalesce(try_cast(rate_code as bigint), 99) as rate_code_id,
           cast(payment_type as bigint) as payment_type_id,
           store_and_fwd_flag, fare_amount, extra as extra_charges, mta_tax, tip_amount, tolls_amount,
           imp_surcharge as improvement_surcharge, total_amount, _synced as synced_at"""

_VALID = """pickup_datetime is not null and dropoff_datetime > pickup_datetime
      and trip_distance > 0 and trip_distance < 500
      and total_amount > 0 and total_amount < 10000 and fare_amount >= 0"""

_CTES["clean"] = f"""
    select md5(cast(row_num as varchar)) as trip_id,{_CLEAN_COLUMNS}
    from numbered where {_VALID}"""

_CTES["trips"] = f"""
    select{_CLEAN_COLUMNS}
    from raw where not _deleted and {_VALID}"""

_ENRICHED = """
    select *,
           cast(pickup_at as date) as pickup_date,
           extract(year from pickup_at) as pickup_year,
           extract(month from pickup_at) as pickup_month,
           extract(day from pickup_at) as pickup_day,
           extract(hour from pickup_at) as pickup_hour,
           extract(dow from pickup_at) + 1 as pickup_day_of_week,
           dayname(pickup_at) as pickup_day_name,
           cast(strftime(pickup_at, '%U') as bigint) as pickup_week,
           extract(dow from pickup_at) in (0, 6) as is_weekend,
           case when extract(hour from pickup_at) < 6 then 'Late Night'
                when extract(hour from pickup_at) < 10 then 'Morning Rush'
                when extract(hour from pickup_at) < 16 then 'Midday'
                when extract(hour from pickup_at) < 20 then 'Evening Rush' else 'Night' end as time_of_day_bucket,
           case when trip_distance_miles > 10 then 'Long' when trip_distance_miles >= 2 then 'Medium'
                else 'Short' end as trip_distance_category,
           case when date_sub('minute', pickup_at, dropoff_at) > 60 then 'Long Haul'
                when date_sub('minute', pickup_at, dropoff_at) > 30 then 'Extended'
                when date_sub('minute', pickup_at, dropoff_at) >= 10 then 'Average'
                else 'Quick' end as trip_duration_category,
           case when passenger_count > 3 then 'Large Group' when passenger_count > 1 then 'Small Group'
                when passenger_count = 1 then 'Solo' else 'Unknown' end as passenger_category,
           date_sub('second', pickup_at, dropoff_at) as trip_duration_seconds,
           date_sub('minute', pickup_at, dropoff_at) as trip_duration_minutes,
           fare_amount / nullif(trip_distance_miles, 0) as fare_per_mile,
           tip_amount / nullif(fare_amount, 0) * 100e0 as tip_percentage,
           trip_distance_miles / nullif(date_sub('second', pickup_at, dropoff_at) / 3600e0, 0) as avg_speed_mph,
           extra_charges + mta_tax + improvement_surcharge as total_surcharges,
           total_amount / nullif(date_sub('second', pickup_at, dropoff_at) / 3600e0, 0) as revenue_per_hour
    from """

_CTES["enriched"] = _ENRICHED + "trips"
_CTES["enriched_keyed"] = _ENRICHED + "clean"

# The code lookups, stated again so that this side is independent.
_CTES["vendors"] = """
    select * from (values (cast(1 as bigint), 'Creative Mobile Technologies'), (2, 'VeriFone Inc'))
        as t(vendor_id, vendor_name)"""

_CTES["payment_types"] = """
    select * from (values (cast(1 as bigint), 'Credit Card', true), (2, 'Cash', false), (3, 'No Charge', false),
        (4, 'Dispute', false), (5, 'Unknown', false), (6, 'Voided', false))
        as t(payment_type_id, payment_type_name, is_electronic)"""

_CTES["rate_codes"] = """
    select * from (values (cast(1 as bigint), 'Standard rate', 'standard'), (2, 'JFK', 'airport'),
        (3, 'Newark', 'airport'), (4, 'Nassau or Westchester', 'negotiated'), (5, 'Negotiated fare', 'negotiated'),
        (6, 'Group ride', 'group'), (99, 'Unknown', 'standard'))
        as t(rate_code_id, rate_code_name, rate_category)"""

_CTES["zones"] = """
    select i as location_id,
           case when i >= 258 then 'NV' else 'Zone ' || i end as zone_name,
           case when i >= 258 then 'N/A' when i = 1 then 'EWR' when i in (130, 136) then 'Queens'
                else (['Manhattan', 'Brooklyn', 'Queens', 'Bronx', 'Staten Island'])[i % 5 + 1] end as borough,
           case when i >= 258 then 'N/A' when i = 1 then 'EWR' when i in (130, 136) then 'Airports'
                when i % 5 = 0 and i % 3 <> 0 then 'Yellow Zone' else 'Boro Zone' end as service_zone
    from range(1, 264) as t(i)"""

_CTES["locations"] = """
    select *, case when service_zone in ('Airports', 'EWR') then 'Airport'
                   when borough = 'Manhattan' then
                       case service_zone when 'Yellow Zone' then 'Manhattan Core'
                                         when 'Boro Zone' then 'Manhattan Other' else 'Other' end
                   when borough in ('Bronx', 'Brooklyn', 'Queens', 'Staten Island') then 'Outer Borough'
                   else 'Other' end as zone_category
    from zones"""

_CTES["rates"] = "select *, rate_category = 'airport' as is_airport_rate from rate_codes"

_CTES["spine"] = """
    select cast(day as date) as date_day
    from (select unnest(generate_series(min(pickup_date), max(pickup_date), interval 1 day)) as day from enriched)"""

_CTES["dates"] = """
    select date_day, extract(year from date_day) as year, extract(quarter from date_day) as quarter,
           extract(month from date_day) as month, cast(strftime(date_day, '%U') as bigint) as week_of_year,
           extract(dow from date_day) + 1 as day_of_week, dayname(date_day) as day_name,
           extract(dow from date_day) in (0, 6) as is_weekend, strftime(date_day, '%Y-%m') as year_month,
           strftime(date_day, '%G-W%V') as year_week
    from spine"""

_CTES["fact"] = f"""
    select e.*, vendor_name, payment_type_name, rate_code_name, timestamp '{fixture.AS_OF}' as updated_at
    from enriched_keyed e left join vendors using (vendor_id) left join payment_types using (payment_type_id)
         left join rate_codes using (rate_code_id)"""

_CTES["zone_totals"] = f"""
    select pickup_location_id as location_id, count(*) as total_trips,
           count(distinct pickup_date) as active_days, {_exact('total_amount')} as revenue,
           {_money_avg('total_amount', 'avg_trip_revenue')}, {_sum('tip_amount', 'total_tips')},
           {_avg('trip_distance_miles', 2, 'avg_trip_distance_miles')},
           {_avg('trip_duration_minutes', 1, 'avg_trip_duration_minutes')},
           {_avg('passenger_count', 1, 'avg_passengers')},
           count(*) filter (is_weekend) as weekend_trips, count(*) filter (not is_weekend) as weekday_trips,
           count(*) filter (payment_type_id = 1) as credit_card_trips,
           count(*) filter (payment_type_id = 2) as cash_trips,
           {_avg('tip_percentage', 1, 'avg_tip_percentage')}, {_avg('fare_per_mile', 2, 'avg_fare_per_mile')}
    from enriched group by pickup_location_id"""

_CTES["location_stats_plain"] = f"""
    select * exclude (revenue), cast(round(revenue, 2) as double) as total_revenue,
           {_share('weekend_trips', 'total_trips', 'weekend_trip_pct')},
           {_share('credit_card_trips', 'total_trips', 'credit_card_pct')},
           rank() over (order by revenue desc) as revenue_rank,
           rank() over (order by total_trips desc) as trip_volume_rank,
           timestamp '{fixture.AS_OF}' as updated_at
    from zone_totals"""

_CTES["location_stats"] = """
    select s.*, zone_name, borough, service_zone, zone_category
    from location_stats_plain s left join locations using (location_id)"""

_ZONE_SIDE = f"""
    select t.{{side}}_location_id as location_id, '{{side}}' as direction,
           zone_name, borough, service_zone, zone_category,
           count(*) as trip_count, {_sum('total_amount', 'total_revenue')}, {_money_avg('total_amount', 'avg_revenue')},
           {_avg('trip_distance_miles', 2, 'avg_distance')},
           {_avg('trip_duration_minutes', 1, 'avg_duration_minutes')}, {_avg('t.avg_speed_mph', 1, 'avg_speed_mph')},
           {_avg('revenue_per_hour', 2, 'avg_revenue_per_hour')}, {_avg('tip_percentage', 1, 'avg_tip_pct')},
           {_avg('t.fare_per_mile', 2, 'avg_fare_per_mile')}
    from enriched t left join locations z on z.location_id = t.{{side}}_location_id
    group by all"""

_CTES["zone_performance"] = (
    _ZONE_SIDE.format(side="pickup") + "\n    union all" + _ZONE_SIDE.format(side="dropoff")
)

_CTES["trip_patterns"] = f"""
    select pickup_day_of_week, pickup_day_name, pickup_hour, time_of_day_bucket, is_weekend,
           trip_distance_category, passenger_category,
           count(*) as trip_count, {_sum('total_amount', 'total_revenue')}, {_money_avg('total_amount', 'avg_revenue')},
           {_avg('trip_distance_miles', 2, 'avg_distance')},
           {_avg('trip_duration_minutes', 1, 'avg_duration_minutes')}, {_avg('t.avg_speed_mph', 1, 'avg_speed_mph')},
           {_avg('revenue_per_hour', 2, 'avg_revenue_per_hour')}, {_avg('tip_percentage', 1, 'avg_tip_pct')}
    from enriched t group by all"""

_CTES["days"] = f"""
    select pickup_date, pickup_year, pickup_month, pickup_week, pickup_day_name, is_weekend,
           count(*) as trip_count, {_sum('fare_amount', 'total_base_fare')}, {_sum('tip_amount', 'total_tips')},
           {_sum('tolls_amount', 'total_tolls')}, {_sum('t.total_surcharges', 'total_surcharges')},
           {_sum('total_amount', 'total_revenue')}, {_money_avg('total_amount', 'avg_trip_revenue')},
           {_avg('t.fare_per_mile', 2, 'avg_fare_per_mile')}, {_avg('tip_percentage', 1, 'avg_tip_pct')},
           {_avg('revenue_per_hour', 2, 'avg_revenue_per_hour')}
    from enriched t group by all"""

_COMPOSITION = ", ".join(
    [
        _share("total_base_fare", "total_revenue", "base_fare_pct"),
        _share("total_tips", "total_revenue", "tip_pct"),
        _share("total_tolls", "total_revenue", "tolls_pct"),
        _share("total_surcharges", "total_revenue", "surcharges_pct"),
    ]
)

_CTES["daily_revenue"] = f"select *, {_COMPOSITION} from days"

_CTES["weeks"] = f"""
    select pickup_year, pickup_week, count(*) as days, cast(sum(trip_count) as bigint) as trip_count,
           {_sum('d.total_base_fare', 'total_base_fare')}, {_sum('d.total_tips', 'total_tips')},
           {_sum('d.total_tolls', 'total_tolls')}, {_sum('d.total_surcharges', 'total_surcharges')},
           {_sum('d.total_revenue', 'total_revenue')}
    from daily_revenue d group by pickup_year, pickup_week"""

_CTES["tipped"] = """
    select *, case when coalesce(tip_percentage, 0) = 0 then 'Zero Tip'
                   when tip_percentage between 10 and 20 then 'Standard (10-20%)'
                   when tip_percentage > 0 and tip_percentage < 10 then 'Low (<10%)'
                   else 'Generous (>20%)' end as tip_bucket
    from enriched"""

_CTES["segments"] = f"""
    select payment_type_id, time_of_day_bucket, is_weekend, trip_distance_category, tip_bucket,
           count(*) as trip_count, {_sum('total_amount', 'total_revenue')},
           {_money_avg('total_amount', 'avg_trip_value')}, {_sum('tip_amount', 'total_tips')},
           {_avg('tip_percentage', 1, 'avg_tip_pct')}
    from tipped group by all"""

_CTES["payment_tipping"] = f"""
    select s.*, payment_type_name,
           {_pct('trip_count', 'sum(trip_count) over (partition by s.payment_type_id)', 'pct_within_payment_type')}
    from segments s left join payment_types using (payment_type_id)"""

_CTES["peaks"] = """
    select *, case when time_of_day_bucket like '% Rush' then 'Peak' else 'Off-Peak' end as peak_category
    from enriched"""

_CTES["service_analysis"] = f"""
    select rate_code_id, rate_code_name, peak_category, is_weekend,
           count(*) as trip_count, {_sum('total_amount', 'total_revenue')}, {_money_avg('total_amount', 'avg_fare')},
           {_avg('trip_distance_miles', 2, 'avg_distance')},
           {_avg('trip_duration_minutes', 1, 'avg_duration_minutes')}, {_avg('p.avg_speed_mph', 1, 'avg_speed_mph')},
           {_avg('tip_percentage', 1, 'avg_tip_pct')}, {_avg('revenue_per_hour', 2, 'avg_revenue_per_hour')},
           {_share('count(*) filter (p.avg_speed_mph < 10)', 'count(*)', 'congestion_pct')}
    from peaks p left join rate_codes using (rate_code_id)
    group by all"""


def _with(final: str) -> str:
    """``final`` behind the CTEs it reads, directly or through others."""

    def read_by(text: str) -> set[str]:
        return {name for name in _CTES if re.search(rf"\b(?:from|join)\s+{name}\b", text)}

    needed, todo = set(), read_by(final)
    while todo:
        needed |= todo
        todo = set().union(*(read_by(_CTES[name]) for name in todo)) - needed
    if not needed:
        return final
    # The dictionary lists every CTE after those it rests on.
    return "with " + ",\n".join(f"{name} as ({_CTES[name]})" for name in _CTES if name in needed) + "\n" + final


def _usage(dim: str, columns: str, key: str, foreign: str) -> str:
    return f"""select {columns}, coalesce(n, 0) as trip_count
from {dim} left join (select {foreign} as {key}, count(*) as n from enriched group by 1) using ({key})"""


_NATURAL = "pickup_at, dropoff_at, pickup_location_id"


def _not_null() -> str:
    columns = (
        "vendor_id pickup_location_id dropoff_location_id pickup_at dropoff_at passenger_count payment_type_id "
        "rate_code_id store_and_fwd_flag total_amount tip_percentage avg_speed_mph"
    ).split()
    parts = [
        f"select '{c}' as column_name, count(*) filter ({c} is null) as violations from enriched" for c in columns
    ]
    return " union all ".join(parts)


def _accepted() -> str:
    rules = {
        "vendor_id": "1, 2",
        "payment_type_id": "1, 2, 3, 4, 5, 6",
        "rate_code_id": "1, 2, 3, 4, 5, 6, 99",
        "store_and_fwd_flag": "'Y', 'N'",
        "passenger_category": "'Solo', 'Small Group', 'Large Group', 'Unknown'",
    }
    return " union all ".join(
        f"select '{c}' as column_name, cast({c} as varchar) as value, count(*) as row_count"
        f" from enriched where {c} not in ({v}) group by {c}"
        for c, v in rules.items()
    )


def _orphans() -> str:
    keys = {
        "vendor_id": ("vendors", "vendor_id"),
        "pickup_location_id": ("locations", "location_id"),
        "dropoff_location_id": ("locations", "location_id"),
        "payment_type_id": ("payment_types", "payment_type_id"),
        "rate_code_id": ("rates", "rate_code_id"),
    }
    return " union all ".join(
        f"select '{c}' as column_name, cast({c} as varchar) as value, count(*) as row_count from enriched"
        f" where {c} is not null and {c} not in (select {key} from {parent}) group by {c}"
        for c, (parent, key) in keys.items()
    )


def _history() -> str:
    def snapshot(condition: str) -> str:
        return f"""select location_id, zone_name, borough,
       case when count(*) >= 200 then 'high' when count(*) >= 20 then 'medium' else 'low' end as demand_class
from enriched join locations on location_id = pickup_location_id where {condition} group by all"""

    first, second = f"date '{HISTORY_FIRST}'", f"date '{HISTORY_SECOND}'"
    old, new = f"({snapshot(f'pickup_date < {first}')})", f"({snapshot('true')})"
    same = "o.zone_name = n.zone_name and o.borough = n.borough and o.demand_class = n.demand_class"
    return f"""select o.*, {first} as valid_from, case when {same} then null else {second} end as valid_to,
       coalesce({same}, false) as is_current
from {old} o left join {new} n on n.location_id = o.location_id
union all
select n.*, {second}, null, true from {new} n left join {old} o on n.location_id = o.location_id
where o.location_id is null or not ({same})"""


def _stored_history() -> str:
    """Changes of each zone's class from one snapshot day to the next; a version lasts until the next change."""
    days = ", ".join(f"(date '{day}')" for day in SNAPSHOT_DAYS)
    return f"""select * exclude (before, first, valid_to), valid_to, valid_to is null as is_current
from (select *, lead(valid_from) over (partition by location_id order by valid_from) as valid_to
      from (select location_id, zone_name, borough,
                   case when n >= 200 then 'high' when n >= 20 then 'medium' when n > 0 then 'low' end as demand_class,
                   day as valid_from, lag(demand_class) over (partition by location_id order by day) as before,
                   row_number() over (partition by location_id order by day) = 1 as first
            from (select l.location_id, zone_name, borough, day, count(pickup_date) as n
                  from locations l cross join (values {days}) as d(day)
                       left join enriched on pickup_location_id = l.location_id and pickup_date < day
                  group by all))
      where first or demand_class is distinct from before)
where demand_class is not null"""


def _report() -> str:
    """One select per declared check."""
    out = []

    def add(name, table, relation, column, severity, count):
        status = f"case when n = 0 then 'pass' else '{'warn' if severity == 'warn' else 'fail'}' end"
        out.append(
            f"select '{name}' as check_name, '{table}' as table_name, '{column}' as column_name,"
            f" '{severity}' as severity, n as violations, {status} as status from ({count.format(relation)})"
        )

    def key(table, relation, column):
        add("unique", table, relation, column, "error",
            f"select count(*) as n from (select {column} from {{}} where {column} is not null"
            f" group by {column} having count(*) > 1)")
        filled(table, relation, column)

    def filled(table, relation, *columns):
        for column in columns:
            add("not_null", table, relation, column, "error",
                f"select count(*) as n from {{}} where {column} is null")

    def within(table, relation, column, values, severity="error"):
        add("accepted_values", table, relation, column, severity,
            f"select count(distinct {column}) as n from {{}} where {column} not in ({values})")

    def child(column, parent, parent_key):
        add("relationships", "fact_trips", "fact", column, "warn",
            f"select count(*) as n from {{}} where {column} is not null"
            f" and {column} not in (select {parent_key} from {parent})")

    def rule(name, severity, condition, column=""):
        add(name, "fact_trips", "fact", column, severity, f"select count(*) as n from {{}} where {condition}")

    for table, column in (
        ("vendors", "vendor_id"), ("rate_codes", "rate_code_id"),
        ("payment_types", "payment_type_id"), ("zones", "location_id"),
    ):
        key(table, table, column)
    key("trips_clean", "clean", "trip_id")
    filled("trips_clean", "clean", "vendor_id", "pickup_location_id", "dropoff_location_id", "pickup_at",
           "dropoff_at", "payment_type_id", "rate_code_id", "total_amount")
    within("trips_clean", "clean", "vendor_id", "1, 2", "warn")
    within("trips_clean", "clean", "payment_type_id", "1, 2, 3, 4, 5, 6", "warn")
    within("trips_clean", "clean", "rate_code_id", "1, 2, 3, 4, 5, 6, 99")
    within("trips_clean", "clean", "store_and_fwd_flag", "'Y', 'N'", "warn")
    key("trips_enriched", "enriched_keyed", "trip_id")
    for column, values in (
        ("trip_distance_category", "'Short', 'Medium', 'Long'"),
        ("trip_duration_category", "'Quick', 'Average', 'Extended', 'Long Haul'"),
        ("passenger_category", "'Solo', 'Small Group', 'Large Group', 'Unknown'"),
        ("time_of_day_bucket", "'Morning Rush', 'Midday', 'Evening Rush', 'Night', 'Late Night'"),
    ):
        within("trips_enriched", "enriched_keyed", column, values)
    key("fact_trips", "fact", "trip_id")
    filled("fact_trips", "fact", "pickup_date", "total_amount", "vendor_id", "pickup_location_id",
           "dropoff_location_id", "payment_type_id", "rate_code_id", "trip_distance_category",
           "trip_duration_category", "passenger_category")
    child("vendor_id", "vendors", "vendor_id")
    child("pickup_location_id", "locations", "location_id")
    child("dropoff_location_id", "locations", "location_id")
    child("payment_type_id", "payment_types", "payment_type_id")
    child("rate_code_id", "rates", "rate_code_id")
    key("dim_vendor", "vendors", "vendor_id")
    key("dim_rate_code", "rates", "rate_code_id")
    within("dim_rate_code", "rates", "rate_category", "'standard', 'airport', 'negotiated', 'group'")
    key("dim_payment_type", "payment_types", "payment_type_id")
    key("dim_location", "locations", "location_id")
    within("dim_location", "locations", "zone_category",
           "'Manhattan Core', 'Manhattan Other', 'Outer Borough', 'Airport', 'Other'")
    key("dim_date", "dates", "date_day")
    key("location_stats", "location_stats", "location_id")
    filled("location_stats", "location_stats", "total_trips")
    filled("zone_performance", "zone_performance", "location_id")
    within("zone_performance", "zone_performance", "direction", "'pickup', 'dropoff'")
    filled("trip_patterns", "trip_patterns", "trip_count")
    key("daily_revenue", "daily_revenue", "pickup_date")
    filled("daily_revenue", "daily_revenue", "total_revenue")
    filled("payment_tipping", "payment_tipping", "payment_type_id")
    within("payment_tipping", "payment_tipping", "tip_bucket",
           "'Zero Tip', 'Low (<10%)', 'Standard (10-20%)', 'Generous (>20%)'")
    filled("service_analysis", "service_analysis", "rate_code_id")
    within("service_analysis", "service_analysis", "peak_category", "'Peak', 'Off-Peak'")
    add("fact_grain_unique", "fact_trips", "fact", "trip_id", "error",
        "select count(*) as n from (select trip_id from {} group by trip_id having count(*) > 1)")
    rule("revenue_consistency", "error", "total_amount < fare_amount and fare_amount > 0")
    rule("positive_duration", "warn", "trip_duration_minutes <= 0")
    rule("duration_range", "warn", "trip_duration_minutes > 240")
    rule("speed", "warn", "avg_speed_mph > 80")
    return "\nunion all ".join(out)


def statements() -> dict[str, str]:
    key_text = " || '|' || ".join(f"cast({k} as varchar)" for k in SAMPLE_KEYS)
    source = "* exclude (_synced, _deleted)"
    zone_columns = "zone_name, borough, service_zone, zone_category"
    finals = {
        "range_extract": f"select {source}, _synced, false as _deleted from raw"
        f" where pickup_datetime >= timestamp '{EXTRACT_START}' and pickup_datetime < timestamp '{EXTRACT_END}'",
        "deterministic_sample": f"select {source} from raw where substr(md5({key_text}), 1, 8) < '{round(SAMPLE_SHARE * 16**8):08x}'",
        "load_summary": "select count(*) as total_rows, min(pickup_datetime) as min_pickup,"
        " max(pickup_datetime) as max_pickup, count(distinct vendor_id) as vendors,"
        f" {_sum('total_amount', 'total_revenue')} from raw",
        "clean_trips": "select * from clean",
        "tolerant_cast": "select rate_code, coalesce(try_cast(rate_code as bigint), 99) as rate_code_id,"
        " count(*) as row_count from raw group by 1, 2",
        "global_row_number": "select row_num, pickup_datetime, dropoff_datetime, pickup_location_id from numbered",
        "surrogate_key": "select row_num, md5(cast(row_num as varchar)) as trip_id,"
        f" md5(coalesce(rate_code, '{NULL_PART}') || '-' || coalesce(store_and_fwd_flag, '{NULL_PART}')) as code_key"
        " from numbered",
        "calendar_parts": f"select {_NATURAL}, pickup_date, pickup_year, pickup_month, pickup_day, pickup_hour,"
        " pickup_day_of_week, pickup_day_name, pickup_week, is_weekend from enriched",
        "bucketize": f"select {_NATURAL}, time_of_day_bucket, trip_distance_category, trip_duration_category,"
        " passenger_category from enriched",
        "derived_measures": f"select {_NATURAL}, trip_duration_seconds, trip_duration_minutes, fare_per_mile,"
        " tip_percentage, avg_speed_mph, total_surcharges, revenue_per_hour from enriched",
        "fact_wide": "select * from fact",
        "dim_vendor": _usage("vendors", "vendor_id, vendor_name", "vendor_id", "vendor_id"),
        "dim_payment_type": _usage(
            "payment_types", "payment_type_id, payment_type_name, is_electronic", "payment_type_id", "payment_type_id"
        ),
        "dim_rate_code": _usage(
            "rates", "rate_code_id, rate_code_name, rate_category, is_airport_rate", "rate_code_id", "rate_code_id"
        ),
        "dim_location": _usage(
            "locations", f"location_id, {zone_columns}", "location_id", "pickup_location_id"
        ),
        "date_spine": "select date_day from spine",
        "dim_date": "select * from dates",
        "landing_round_trip": "select * from raw",
        "incremental_fact": "select * from fact",
        "partitioned_fact_scan": "select * from fact"
        f" where pickup_date >= date '{SCAN_START}' and pickup_date < date '{SCAN_END}'",
        "location_stats": "select * from location_stats",
        "location_stats_plain": "select * from location_stats_plain",
        "zone_performance": "select * from zone_performance",
        "trip_patterns": "select * from trip_patterns",
        "daily_revenue": "select * from daily_revenue",
        "daily_revenue_stream": "select * from daily_revenue",
        "payment_tipping": "select * from payment_tipping",
        "service_analysis": "select * from service_analysis",
        "dq_unique": "select 'trip_id' as key_name, trip_id as key_value, count(*) as row_count from fact"
        " group by trip_id having count(*) > 1 union all"
        " select 'pickup_at', cast(pickup_at as varchar), count(*) from enriched group by pickup_at"
        " having count(*) > 1",
        "dq_not_null": _not_null(),
        "dq_accepted_values": _accepted(),
        "dq_relationships": _orphans(),
        "dq_revenue_consistency": "select trip_id, fare_amount, total_amount from fact"
        " where fare_amount > 0 and total_amount < fare_amount",
        "dq_positive_duration": "select trip_id, trip_duration_minutes from fact where trip_duration_minutes < 1",
        "dq_duration_range": "select trip_id, trip_duration_minutes from fact where trip_duration_minutes > 240",
        "dq_speed": "select trip_id, avg_speed_mph, trip_distance_miles, trip_duration_minutes from fact"
        " where avg_speed_mph > 80",
        "dq_freshness": f"""select newest, age_seconds,
       case when age_seconds <= 24 * 3600 then 'pass' when age_seconds <= 48 * 3600 then 'warn'
            else 'error' end as status
from (select max(_synced) as newest, date_sub('second', max(_synced), timestamp '{fixture.AS_OF}') as age_seconds
      from raw)""",
        "dq_report": _report(),
        "kpi_summary": f"select count(*) as total_trips, {_sum('total_amount', 'total_revenue')},"
        f" {_money_avg('fare_amount', 'avg_fare')}, {_avg('tip_percentage', 1, 'avg_tip_pct')} from enriched",
        "top_zones": f"select location_id, {zone_columns}, trip_count, total_revenue from zone_performance"
        f" where direction = 'pickup' order by total_revenue desc, location_id limit {TOP_ZONES}",
        "weekly_revenue": f"select *, {_r('total_revenue / trip_count', 2)} as avg_trip_revenue, {_COMPOSITION}"
        " from weeks",
        "route_revenue": f"""select t.pickup_location_id, p.zone_name as pickup_zone, p.borough as pickup_borough,
       t.dropoff_location_id, d.zone_name as dropoff_zone, d.borough as dropoff_borough, count(*) as trip_count,
       {_sum('total_amount', 'total_revenue')}, {_money_avg('total_amount', 'avg_revenue')},
       {_avg('trip_distance_miles', 2, 'avg_distance')}
from enriched t left join locations p on p.location_id = t.pickup_location_id
     left join locations d on d.location_id = t.dropoff_location_id
group by all""",
        "daily_anomalies": f"""select pickup_date, total_revenue, n as days_before,
       case when n >= 2 then {_r('cast(s as double) / n / 100', 2)} end as mean_before,
       case when n >= 2 then
           {_r('sqrt(cast(n * q - s * s as double) / (n * (n - 1))) / 100', 2)} end as deviation_before,
       coalesce(n >= 2 and (n * x - s) * (n * x - s) * (n - 1) > 9 * n * (n * q - s * s), false) as is_anomaly
from (select pickup_date, total_revenue, x, count(x) over w as n, sum(x) over w as s, sum(x * x) over w as q
      from (select pickup_date, total_revenue, cast(round(total_revenue * 100) as hugeint) as x from days)
      window w as (order by pickup_date rows between 28 preceding and 1 preceding))""",
        "zone_history": _history(),
        "stored_zone_history": _stored_history(),
        "payment_share": "select payment_type_id, payment_type_name, count(*) as trip_count,"
        f" {_pct('count(*)', 'sum(count(*)) over ()', 'trip_pct')}"
        " from enriched left join payment_types using (payment_type_id) group by all",
    }
    return {name: _with(final) for name, final in finals.items()}
