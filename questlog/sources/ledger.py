"""Loads of a table that take effect once: staged, published and entered in a ledger beside the table.

A load goes through four steps, each of which may be repeated after a failure. Its rows and then
its counts are written under _staged; from the counts on the load is never computed again. The files
are moved into the table under names that hold the load's name, those that are there already
stay; the counts are moved into _ledger, which ends the load. Folders that begin with _ are no part
of the table for its readers. Months of a table in the catalogue are where the catalogue says, so
that loads, rolls and compaction agree.
"""

from __future__ import annotations

from collections.abc import Callable
from typing import Any

from pyspark.sql import DataFrame, SparkSession
from pyspark.sql.types import StructType

from questlog.operators.lifecycle import month_folder
from questlog.sources.archive import existing_months

ENTRY = (
    "query string, batch long, part long, loaded_at timestamp, manifest string, files array<string>, missing array<string>, pointers long, bad_pointers long, repeated_pointers long, "
    "copied long, inserted long, load_errors long, out_of_retention long, true_duplicates long, millis_behind long"
)


class Ledger:
    """The loads of one table, that of a path or, with catalogue, the one of that name."""

    def __init__(self, spark: SparkSession, table: str, catalogue: str | None = None):
        self.spark, self.table, self.catalogue = spark, table.rstrip("/"), catalogue
        self._path = spark.sparkContext._jvm.org.apache.hadoop.fs.Path
        self._fs = self._path(self.table).getFileSystem(spark.sparkContext._jsc.hadoopConfiguration())

    def rows(self, schema: StructType) -> DataFrame:
        """What the table holds."""
        return self.spark.table(self.catalogue) if self.catalogue else existing_months(self.spark, self.table, schema)

    def _month(self, year: str, month: str) -> str:
        """The folder of a month, by the names of its partition's folders."""
        if not self.catalogue:
            return f"{self.table}/{year}/{month}"
        return month_folder(self.spark, self.catalogue, *(int(x.split("=")[1]) for x in (year, month)))

    def _there(self, path: str) -> bool:
        return self._fs.exists(self._path(path))

    def _move(self, old: str, new: str) -> None:
        """One file or folder, unless a try before has moved it."""
        if self._there(new):
            return
        self._fs.mkdirs(self._path(new).getParent())
        if not self._fs.rename(self._path(old), self._path(new)):
            raise OSError(f"{old} could not be moved to {new}")

    def entries(self) -> DataFrame:
        """One row for each load that has ended."""
        folder = f"{self.table}/_ledger"
        if not self._there(folder):
            return self.spark.createDataFrame([], f"load string, {ENTRY}")
        return self.spark.read.schema(f"{ENTRY}, load string").json(folder).select("load", *[c.split()[0] for c in ENTRY.split(", ")])

    def ended(self, load: str) -> bool:
        return self._there(f"{self.table}/_ledger/load={load}")

    def run(self, load: str, rows: Callable[[], tuple[DataFrame, Callable[[DataFrame], DataFrame], Callable[[], dict[str, Any]]]]) -> None:
        """Bring a load to its end, from where it stands. rows gives the rows to be added, by year
        and month, what observes them as they are written, and a function that gives the entry once
        they are; it is called only if nothing has been staged."""
        if self.ended(load):
            return
        staged = f"{self.table}/_staged/{load}"
        if not self._there(f"{staged}/counts/_SUCCESS"):
            added, observed, entry = rows()
            write_by_month(added, f"{staged}/rows", observed)
            self.stage_entry(entry(), f"{staged}/counts")
        self.publish(load, f"{staged}/rows")
        self.enter(load, f"{staged}/counts")
        self._fs.delete(self._path(staged), True)

    def stage_entry(self, entry: dict[str, Any], path: str) -> None:
        schema = StructType.fromDDL(ENTRY)
        row = tuple(entry.get(f.name) for f in schema)
        self.spark.createDataFrame([row], schema).coalesce(1).write.mode("overwrite").json(path)

    def publish(self, load: str, staged: str) -> None:
        """Move a load's files, at most one a task and month, into the partitions of the table."""
        if not self._there(staged):
            return
        files, found = self._fs.listFiles(self._path(staged), True), []
        while files.hasNext():
            path = files.next().getPath()
            if path.getName().startswith("part-"):
                found.append((path.getParent().getParent().getName(), path.getParent().getName(), path))
        folders = {x: self._month(*x) for x in {(y, m) for y, m, _ in found}}
        for y, m, path in found:
            self._move(path.toString(), f"{folders[y, m]}/load-{load}-{path.getName()}")
        if self.catalogue:
            self.spark.catalog.refreshTable(self.catalogue)

    def enter(self, load: str, counts: str) -> None:
        self._move(counts, f"{self.table}/_ledger/load={load}")


def write_by_month(rows: DataFrame, path: str, observed: Callable[[DataFrame], DataFrame] = lambda df: df) -> None:
    """Rows to the partition of their month in place of what a try before has left, sorted by time and type in each file.

    They are observed behind the exchange: an observation before it is taken out of the plan together
    with all else when the exchange turns out to bring no rows.
    """
    dealt = observed(rows.hint("rebalance", "year", "month"))
    dealt.sortWithinPartitions("year", "month", "event_timestamp", "event_type").write.mode("overwrite").partitionBy("year", "month").parquet(path)
