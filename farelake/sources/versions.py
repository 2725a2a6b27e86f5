"""Stored tables in versions, switched by one commit.

Tables are folders below a common one. A refresh writes what changes into new version folders, which nobody reads yet;
then one small manifest file names the folders that make up each table, and from there on every reader sees the new state
of all tables together. What did not change is named again, not copied. A refresh that fails leaves nothing but folders
that no manifest names; a reader that has planned its scan goes on reading the folders it knows, until ``vacuum``.

A table may be divided by month: then its parts are the months, each in a version of its own.

    <folder>/<table>/version=<v>/part-*.parquet
    <folder>/<table>/version=<v>/month_start=2022-01-01/part-*.parquet
    <folder>/_manifests/00000007.json

One writer at a time: a commit fails if another came between. The file system must rename a file in one step.
"""

from __future__ import annotations

import json
import uuid
from collections.abc import Iterable, Mapping

from pyspark.sql import DataFrame, SparkSession
from pyspark.sql import functions as F
from pyspark.sql.types import DateType, StringType, StructField, StructType

MONTH = "month_start"
_VERSION = "version"
_NO_MONTH = "__HIVE_DEFAULT_PARTITION__"  # Fixed value: how Spark names the folder of a null partition value.
WHOLE = ""  # the only part of a table that is not divided

#: What is known of a part: its version, and what its writer wants to remember of it.
Part = dict[str, str | int]
Parts = dict[str, Part]


class Versions:
    """The tables below ``folder`` as of the manifest that was the last when this object was made or last committed."""

    def __init__(self, spark: SparkSession, folder: str):
        self.spark = spark
        self.folder = folder.rstrip("/")
        self.number, self.tables = self._latest()

    # --- manifests ---------------------------------------------------------------------------------------------

    def _hadoop(self, path: str):
        return self.spark._jvm.org.apache.hadoop.fs.Path(path)

    @property
    def _files(self):
        return self._hadoop(self.folder).getFileSystem(self.spark._jsc.hadoopConfiguration())

    def _manifest(self, number: int) -> str:
        return f"{self.folder}/_manifests/{number:08d}.json"

    def _latest(self) -> tuple[int, dict[str, Parts]]:
        files, folder = self._files, self._hadoop(f"{self.folder}/_manifests")
        if not files.exists(folder):
            return 0, {}
        names = [status.getPath().getName() for status in files.listStatus(folder)]
        numbers = [int(n.removesuffix(".json")) for n in names if n.endswith(".json")]
        if not numbers:
            return 0, {}
        stream = files.open(self._hadoop(self._manifest(max(numbers))))
        try:
            text = bytes(stream.readAllBytes()).decode()
        finally:
            stream.close()
        return max(numbers), json.loads(text)

    def commit(self, changed: Mapping[str, Parts]) -> None:
        """Make these the parts of the named tables, all at once; other tables stay as they are."""
        tables = {**self.tables, **{name: dict(parts) for name, parts in changed.items()}}
        files, target = self._files, self._hadoop(self._manifest(self.number + 1))
        fresh = self._hadoop(f"{self.folder}/_manifests/.{uuid.uuid4().hex}")
        stream = files.create(fresh, False)
        try:
            stream.write(bytearray(json.dumps(tables, sort_keys=True).encode()))
        finally:
            stream.close()
        if files.exists(target) or not files.rename(fresh, target):
            files.delete(fresh, False)
            raise RuntimeError(f"{self.folder} was changed by another writer")
        self.number, self.tables = self.number + 1, tables

    # --- tables ------------------------------------------------------------------------------------------------

    def parts(self, table: str) -> Parts:
        return self.tables.get(table, {})

    def _path(self, table: str, part: str, known: Part) -> str:
        month = "" if part == WHOLE else f"/{MONTH}={part}"
        return f"{self.folder}/{table}/{_VERSION}={known['version']}{month}"

    def write(self, table: str, df: DataFrame, monthly: bool = False) -> str:
        """Write a version of a table, which no reader sees before it is committed. A monthly one has a column
        ``month_start``."""
        version = f"v{uuid.uuid4().hex}"
        writer = df.write.partitionBy(MONTH) if monthly else df.write
        # Keys are hexadecimal text, which only a codec with entropy coding makes shorter.
        writer.option("compression", "zstd").parquet(f"{self.folder}/{table}/{_VERSION}={version}")
        return version

    def months_of(self, table: str, version: str, schema: StructType, *counts) -> dict[str, dict[str, int]]:
        """What a written, not yet committed version has in each month: ``rows`` and further counts."""
        written = self._scan(table, schema, [f"{self.folder}/{table}/{_VERSION}={version}"], monthly=True)
        found = written.groupBy(MONTH).agg(F.count(F.lit(1)).alias("rows"), *counts).collect()  # a row per month
        return {str(r[MONTH]) if r[MONTH] else _NO_MONTH: {k: v for k, v in r.asDict().items() if k != MONTH} for r in found}

    def _scan(self, table: str, schema: StructType, paths: list[str], monthly: bool) -> DataFrame:
        partitions = [StructField(_VERSION, StringType())]
        if monthly:
            partitions.append(StructField(MONTH, DateType()))
        whole = StructType([*[f for f in schema.fields if f.name not in (_VERSION, MONTH)], *partitions])
        if not paths:
            return self.spark.createDataFrame([], whole).drop(_VERSION)
        return self.spark.read.schema(whole).option("basePath", f"{self.folder}/{table}").parquet(*paths).drop(_VERSION)

    def read(self, table: str, schema: StructType, months: Iterable[str] | None = None) -> DataFrame:
        """The current rows of a table; of a monthly one also ``month_start``, and only these months if given."""
        parts = self.parts(table)
        wanted = parts if months is None else {m: parts[m] for m in months if m in parts}
        monthly = WHOLE not in parts
        paths = [self._path(table, part, known) for part, known in wanted.items() if known.get("rows", 1)]
        return self._scan(table, schema, paths, monthly)

    def replace(self, tables: Mapping[str, DataFrame]) -> None:
        """Full refresh of tables that are not divided: all of them change in one step."""
        self.commit({name: {WHOLE: {"version": self.write(name, df)}} for name, df in tables.items()})

    def publish(self, namespace: str, *tables: str) -> None:
        """Make the current state of these tables (default: all) available to SQL as ``namespace.table``. A name changes
        in one step of the catalog, from one whole state to the next."""
        self.spark.sql(f"CREATE SCHEMA IF NOT EXISTS {namespace}")
        for table in tables or self.tables:
            parts = {p: k for p, k in self.parts(table).items() if k.get("rows", 1)}
            by_version: dict[str, list[str]] = {}
            for part, known in parts.items():
                by_version.setdefault(str(known["version"]), []).append(part)
            chosen = " OR ".join(f"({_VERSION} = '{v}'{_in_months(months)})" for v, months in by_version.items()) or "false"
            self.spark.sql(
                f"CREATE OR REPLACE VIEW {namespace}.{table} AS "
                f"SELECT * EXCEPT ({_VERSION}) FROM parquet.`{self.folder}/{table}` WHERE {chosen}"
            )

    def vacuum(self) -> int:
        """Delete the versions that the current state does not name; how many. Readers of older states fail from then on."""
        files, deleted = self._files, 0
        for table, parts in self.tables.items():
            named = {str(known["version"]) for known in parts.values()}
            for status in files.listStatus(self._hadoop(f"{self.folder}/{table}")):
                name = status.getPath().getName()
                if name.startswith(f"{_VERSION}=") and name.removeprefix(f"{_VERSION}=") not in named:
                    files.delete(status.getPath(), True)
                    deleted += 1
        return deleted


def _in_months(months: list[str]) -> str:
    if months == [WHOLE]:
        return ""
    dated = ", ".join(f"DATE'{m}'" for m in months if m != _NO_MONTH)
    tests = ([f"{MONTH} IN ({dated})"] if dated else []) + ([f"{MONTH} IS NULL"] if _NO_MONTH in months else [])
    return f" AND ({' OR '.join(tests)})"


def in_order(months: Iterable[str]) -> list[str]:
    """Months as they sort: that of rows without one first."""
    return sorted(months, key=lambda m: "" if m == _NO_MONTH else m)


def without_month(month: str) -> bool:
    return month == _NO_MONTH
