"""Times the headline queries and prints one JSON line.

Every query runs once to warm up and then BENCH_RUNS times (default 5); its time is the median. ``queries`` starts
from the source tables each time. ``stored`` times the same reports over a fact table stored once, as a warehouse
would run them; ``stored_setup`` is what storing it cost.
"""

from __future__ import annotations

import json
import os
import statistics
import sys
import time

sys.path.insert(0, os.path.dirname(os.path.abspath(__file__)))

import pyspark  # noqa: E402

from farelake.plans import catalog, fixture, warehouse  # noqa: E402
from farelake.session import build_session, release_scratch, scratch_path  # noqa: E402
from farelake.sources import landing, store  # noqa: E402
from farelake.sources.versions import Versions  # noqa: E402

HEADLINE = (
    "load_summary",
    "global_row_number",
    "fact_wide",
    "partitioned_fact_scan",
    "location_stats",
    "zone_performance",
    "trip_patterns",
    "daily_revenue",
    "payment_tipping",
    "service_analysis",
    "kpi_summary",
    "top_zones",
    "weekly_revenue",
    "payment_share",
    "dq_not_null",
    "dq_accepted_values",
    "dq_relationships",
    "dq_unique",
    "dq_report",
    "daily_revenue_stream",
    "deterministic_sample",
    "route_revenue",
)


def run(make) -> float:
    start = time.perf_counter()
    make().write.format("noop").mode("overwrite").save()
    return time.perf_counter() - start


def median_of(make, runs: int) -> float:
    run(make)
    return round(statistics.median(run(make) for _ in range(runs)), 3)


def stored_times(spark, sf_dir: str, runs: int) -> tuple[dict[str, float], dict[str, float]]:
    return _stored_times(spark, sf_dir, runs, scratch_path(spark, "bench"))


def _stored_times(spark, sf_dir: str, runs: int, out: str) -> tuple[dict[str, float], dict[str, float]]:
    known = warehouse.Lookups.with_zones(spark, fixture.zones(spark))
    setup = {}

    start = time.perf_counter()
    landed, tables = Versions(spark, f"{out}/landing"), Versions(spark, f"{out}/warehouse")
    landing.load(landed, fixture.raw_trips(spark, sf_dir))
    setup["landing"] = round(time.perf_counter() - start, 3)

    start = time.perf_counter()
    warehouse.refresh_fact(landed, tables, known, fixture.AS_OF)
    setup["fact"] = round(time.perf_counter() - start, 3)

    stored = store.read_fact(tables)
    made = warehouse.all_reports(stored, known, fixture.AS_OF)
    return {name: median_of(lambda df=df: df, runs) for name, df in made.items()}, setup


def main() -> None:
    sf_dir = os.environ.get("BENCH_SF_DIR", "/root/testdata/sf0.1")
    cpus = os.environ.get("BENCH_CPUS", "8")
    runs = int(os.environ.get("BENCH_RUNS", "5"))
    spark = build_session(
        "farelake-bench",
        f"local[{cpus}]",
        **{"spark.sql.shuffle.partitions": cpus, "spark.driver.memory": "16g"},
    )
    spark.sparkContext.setLogLevel("ERROR")
    registered = catalog.all_queries()
    times = {name: median_of(lambda name=name: registered[name](spark, sf_dir), runs) for name in HEADLINE}
    stored, setup = stored_times(spark, sf_dir, runs)
    print(
        json.dumps(
            {
                "metric": "headline_queries_total",
                "value": round(sum(times.values()), 3),
                "unit": "sec",
                "queries": times,
                "sf": os.path.basename(sf_dir.rstrip("/")).removeprefix("sf"),
                "stored": stored,
                "stored_setup": setup,
                "cpus": int(cpus),
                "runs": runs,
                "spark": pyspark.__version__,
            }
        ),
        flush=True,
    )
    release_scratch(spark)
    spark.stop()


if __name__ == "__main__":
    main()
