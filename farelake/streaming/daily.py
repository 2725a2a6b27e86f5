"""The daily revenue report, kept current while trips are still arriving.

Sums and counts of a day can be added up, so a micro-batch needs no state: it appends the partial sums of its own
trips to a log, under its batch number, and the report adds the log up. Nothing is dropped, however late or unordered
trips arrive. A batch that runs again after a failure replaces its own entry, so the log never counts a trip twice.

So that the log does not grow with the age of the stream, finished entries are folded into a base, which a manifest names
together with the last batch in it. A reader takes the base and the entries after that batch; so what it adds up is the
same before, while and after entries are folded.
"""

from __future__ import annotations

from pyspark.sql import DataFrame, SparkSession
from pyspark.sql import functions as F
from pyspark.sql.streaming import StreamingQuery
from pyspark.sql.types import LongType, StructField, StructType

from farelake import schemas
from farelake.operators import clean, enrich, reports
from farelake.sources.versions import WHOLE, Versions

BATCH = "batch_id"
_TABLE = "days"


def stream_landing(spark: SparkSession, path: str, files_per_batch: int | None = None) -> DataFrame:
    """The landing table as a stream of appended files."""
    reader = spark.readStream.schema(schemas.RAW_TRIPS)
    if files_per_batch is not None:
        reader = reader.option("maxFilesPerTrigger", files_per_batch)
    return reader.parquet(path)


def _day_states(raw: DataFrame) -> DataFrame:
    return reports.days_stats().state(enrich.enrich_trips(clean.clean_trips(raw, keyed=False)), monthly=False)


def keep_current(raw: DataFrame, log: str, checkpoint: str) -> StreamingQuery:
    """Start adding the partial sums of streamed landing rows to ``log``; the query stops once everything that has
    arrived is counted."""

    def append(batch: DataFrame, batch_id: int) -> None:
        entry = _day_states(batch).withColumn(BATCH, F.lit(batch_id).cast("bigint"))
        writer = entry.write.mode("overwrite").option("partitionOverwriteMode", "dynamic")
        writer.partitionBy(BATCH).parquet(log)

    return (
        raw.writeStream.option("checkpointLocation", checkpoint).trigger(availableNow=True).foreachBatch(append).start()
    )


def _base(spark: SparkSession, log: str) -> Versions:
    return Versions(spark, f"{log}/_base")  # a hidden name: no entry of the log


def _last_in_base(store: Versions) -> int:
    return int(store.parts(_TABLE).get(WHOLE, {}).get("last", -1))


def _entries(spark: SparkSession, log: str, after: int) -> DataFrame:
    states = _day_states(spark.createDataFrame([], schemas.RAW_TRIPS)).schema
    entries = spark.read.schema(StructType([*states.fields, StructField(BATCH, LongType())])).parquet(log)
    return entries.where(F.col(BATCH) > after)


def _all_states(spark: SparkSession, log: str, store: Versions) -> DataFrame:
    """The base, and the entries that are not in it."""
    entries = _entries(spark, log, _last_in_base(store)).drop(BATCH)
    return entries.unionByName(store.read(_TABLE, entries.schema)) if store.parts(_TABLE) else entries


def compact(spark: SparkSession, log: str, checkpoint: str) -> int:
    """Fold the entries of all batches that the stream has finished into the base; the number of the last of them.

    Only batches that the stream's checkpoint calls committed are taken: these never run again. The new base counts
    from one manifest on. Entries are deleted one folding later, so that readers of the former base still find them. A
    crash at any step leaves a log that adds up to the same, and the next call goes on from there.
    """
    files = spark._jvm.org.apache.hadoop.fs.Path(log).getFileSystem(spark._jsc.hadoopConfiguration())
    path = spark._jvm.org.apache.hadoop.fs.Path
    store = _base(spark, log)
    before = _last_in_base(store)
    for status in files.listStatus(path(log)):
        name = status.getPath().getName()
        if name.startswith(f"{BATCH}=") and int(name.removeprefix(f"{BATCH}=")) <= before:
            files.delete(status.getPath(), True)
    commits = path(f"{checkpoint}/commits")
    names = [s.getPath().getName() for s in files.listStatus(commits)] if files.exists(commits) else []
    last = max((int(n) for n in names if n.isdigit()), default=-1)
    if last > before:
        finished = _entries(spark, log, before).where(F.col(BATCH) <= last).drop(BATCH)
        if store.parts(_TABLE):
            finished = finished.unionByName(store.read(_TABLE, finished.schema))
        merged = reports.days_stats().merge(finished)
        store.commit({_TABLE: {WHOLE: {"version": store.write(_TABLE, merged), "last": last}}})
    return max(last, before)


def current_report(spark: SparkSession, log: str) -> DataFrame:
    """The daily revenue report over all batches of the log."""
    days = reports.days_stats()
    return reports.day_report(days.finish(days.merge(_all_states(spark, log, _base(spark, log)))))
