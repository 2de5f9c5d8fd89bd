"""The life of month tables: names, calendar, expiry, union, compaction, statistics."""

from __future__ import annotations

import datetime as dt
import re
import uuid
from functools import reduce

from pyspark.sql import Column, DataFrame, SparkSession
from pyspark.sql import functions as F


def month_table_name(year: Column, month: Column, prefix: str = "events") -> Column:
    return F.format_string(f"{prefix}_%04d_%02d", year.cast("int"), month.cast("int"))


def month_calendar(spark: SparkSession, as_of: dt.date, months: int = 6) -> DataFrame:
    """Months that should have a table: next month back to the one months - 1 ago."""
    this = F.trunc(F.lit(as_of), "month")
    each = F.explode(F.sequence(F.add_months(this, 1 - months), F.add_months(this, 1), F.expr("interval 1 month"))).alias("m")
    return spark.range(1).select(each).select(F.year("m").alias("year"), F.month("m").alias("month"))


def expire_months(rows: DataFrame, as_of: dt.date, months: int = 6) -> DataFrame:
    """Rows of the tables without the month so many months ago and without next month, which is made anew."""
    this = F.trunc(F.lit(as_of), "month")
    month = F.make_date("year", "month", F.lit(1))
    return rows.where((month != F.add_months(this, -months)) & (month != F.add_months(this, 1)))


def list_month_tables(rows: DataFrame, prefix: str = "events") -> DataFrame:
    return rows.select(month_table_name(F.col("year"), F.col("month"), prefix).alias("table_name")).distinct().orderBy("table_name")


def union_months(tables: list[DataFrame]) -> DataFrame:
    """All rows of month tables, repeated ones too."""
    return reduce(DataFrame.unionByName, tables)


def list_month_partitions(spark: SparkSession, path: str) -> DataFrame:
    """Year, month, files and bytes of the month tables under a path, from the listing of their files alone."""
    files = spark.read.format("binaryFile").option("recursiveFileLookup", "true").option("pathGlobFilter", "*.parquet").load(path)
    part = lambda name: F.regexp_extract("path", f"/{name}=([0-9]+)/", 1).cast("int").alias(name)
    return files.select(part("year"), part("month"), "length").groupBy("year", "month").agg(F.count("*").alias("files"), F.sum("length").alias("bytes"))


def _partitions(spark: SparkSession, table: str) -> list[tuple[int, int]]:
    """The months of a catalogued table, from the catalogue."""
    return sorted(tuple(int(p.split("=")[1]) for p in r[0].split("/")) for r in spark.sql(f"SHOW PARTITIONS {table}").collect())


def _described(spark: SparkSession, table: str, month: tuple[int, int] | None = None) -> dict[str, str]:
    """What the catalogue says of a table, or of one of its months, without its columns and what else it says of the table."""
    part = f" PARTITION (year = {month[0]}, month = {month[1]})" if month else ""
    said = [(r["col_name"].strip(), r["data_type"]) for r in spark.sql(f"DESCRIBE EXTENDED {table}{part}").collect()]
    begin = 1 + [k for k, _ in said].index(f"# Detailed {'Partition' if month else 'Table'} Information")
    end = next((i for i in range(begin, len(said)) if not said[i][0] or said[i][0].startswith("#")), len(said))
    return dict(said[begin:end])


def _remove_month(spark: SparkSession, table: str, folder: str) -> None:
    """Remove a folder that was a month's; never one that holds the table."""
    root = _described(spark, table)["Location"].rstrip("/")
    if f"{root}/".startswith(f"{folder.rstrip('/')}/"):
        raise ValueError(f"{folder} holds all of {table}")
    path = spark.sparkContext._jvm.org.apache.hadoop.fs.Path(folder)
    path.getFileSystem(spark.sparkContext._jsc.hadoopConfiguration()).delete(path, True)


def month_location(spark: SparkSession, table: str, year: int, month: int) -> str:
    return _described(spark, table, (year, month))["Location"]


def month_folder(spark: SparkSession, table: str, year: int, month: int) -> str:
    """Where a month of a catalogued table lies; it is made if it is not there. To add one that is
    there would, in some catalogues, put it back to the folder it began with."""
    if (year, month) not in _partitions(spark, table):
        spark.sql(f"ALTER TABLE {table} ADD IF NOT EXISTS PARTITION (year = {year}, month = {month})")
    return month_location(spark, table, year, month)


def refresh_union_view(spark: SparkSession, table: str, view: str) -> None:
    """A view of all months that the table has now, and of no other; each is one partition's scan."""
    columns = ", ".join(c for c in spark.table(table).columns)
    months = " OR ".join(f"(year = {y} AND month = {m})" for y, m in _partitions(spark, table)) or "false"
    spark.sql(f"CREATE OR REPLACE VIEW {view} AS SELECT {columns} FROM {table} WHERE {months}")


def roll_month_tables(spark: SparkSession, table: str, as_of: dt.date, months: int = 6, view: str | None = None) -> dict[str, list[tuple[int, int]]]:
    """One roll of a catalogued table: next month's partition is dropped with what it holds and made
    anew, the month so many months ago is dropped, and the view, if one is named, refreshed.

    Months older than that, which a roll that was left out has not dropped, go with it. The months
    come from the catalogue; no row is read. Their folders are removed, those of tables with a path
    of their own too.
    """
    number = as_of.year * 12 + as_of.month - 1
    following = ((number + 1) // 12, (number + 1) % 12 + 1)
    there = _partitions(spark, table)
    old = [x for x in there if x[0] * 12 + x[1] - 1 <= number - months]
    for y, m in [*old, *([following] if following in there else [])]:
        folder = month_location(spark, table, y, m)
        spark.sql(f"ALTER TABLE {table} DROP IF EXISTS PARTITION (year = {y}, month = {m})")
        _remove_month(spark, table, folder)
    spark.sql(f"ALTER TABLE {table} ADD IF NOT EXISTS PARTITION (year = {following[0]}, month = {following[1]})")
    spark.catalog.refreshTable(table)
    if view:
        refresh_union_view(spark, table, view)
    return {"dropped": old, "made": [following]}


def _compacted(rows: DataFrame, files: int | None, size: int, file_bytes: int) -> DataFrame:
    """Rows in the order of time and type, in files of about so many bytes unless their number is given."""
    n = files or max(1, -(-size // file_bytes))
    return rows.repartitionByRange(n, "event_timestamp", "event_type").sortWithinPartitions("event_timestamp", "event_type")


def compact_month(spark: SparkSession, path: str, year: int, month: int, files: int | None = None, file_bytes: int = 256 << 20) -> str:
    """Rewrite a month's files of a table that is no more than a path, in the order of time and type.
    The rows are written aside; their folder is returned for the caller to swap in."""
    aside = f"{path}/_compacted-{uuid.uuid4().hex}"
    size = 0
    if files is None:
        found = list_month_partitions(spark, path).where((F.col("year") == year) & (F.col("month") == month)).first()
        size = found["bytes"] if found else 0
    rows = spark.read.parquet(path).where((F.col("year") == year) & (F.col("month") == month))
    _compacted(rows, files, size, file_bytes).write.partitionBy("year", "month").parquet(aside)
    return aside


def compact_months(spark: SparkSession, path: str, months: list[tuple[int, int]], files: int | None = None) -> dict[tuple[int, int], str]:
    """Compact month by month; one that fails does not stop the rest. Values: the folder, or the error."""
    done = {}
    for y, m in months:
        try:
            done[y, m] = compact_month(spark, path, y, m, files)
        except Exception as e:  # noqa: BLE001
            done[y, m] = f"failed: {e}"
    return done


def swap_compacted_month(spark: SparkSession, table: str, year: int, month: int, files: int | None = None, file_bytes: int = 256 << 20) -> str:
    """Compact a month of a catalogued table, and publish it: its files are written to a new folder,
    and the partition's location is switched to that in one step of the catalogue.

    The folder of before is left to those who are reading it, and returned; discard_folders removes
    it once they have ended. A failure before the switch leaves the table as it was. A month is to
    be swapped while nothing is added to it; loads of the table are to name it, as by its path alone
    they would go on with the folder of before.
    """
    before = month_location(spark, table, year, month)
    root = _described(spark, table)["Location"]
    rows = spark.table(table).where((F.col("year") == year) & (F.col("month") == month)).drop("year", "month")
    path = spark.sparkContext._jvm.org.apache.hadoop.fs.Path(before)
    size = path.getFileSystem(spark.sparkContext._jsc.hadoopConfiguration()).getContentSummary(path).getLength()
    after = f"{root}/_compacted/{year:04d}-{month:02d}-{uuid.uuid4().hex}"
    _compacted(rows, files, size, file_bytes).write.parquet(after)
    spark.sql(f"ALTER TABLE {table} PARTITION (year = {year}, month = {month}) SET LOCATION '{after}'")
    spark.catalog.refreshTable(table)
    return before


def swap_compacted_months(spark: SparkSession, table: str, months: list[tuple[int, int]] | None = None, files: int | None = None) -> dict[tuple[int, int], str]:
    """Compact and publish month by month, all months if none are named; one that fails stays as it
    was and does not stop the rest. Values: the folder of before, or the error."""
    done = {}
    for y, m in _partitions(spark, table) if months is None else months:
        try:
            done[y, m] = swap_compacted_month(spark, table, y, m, files)
        except Exception as e:  # noqa: BLE001
            done[y, m] = f"failed: {e}"
    return done


def discard_folders(spark: SparkSession, table: str, folders: list[str]) -> None:
    """Remove folders of before a swap, none that a month of the table still lies in."""
    used = {month_location(spark, table, y, m).rstrip("/") for y, m in _partitions(spark, table)}
    for folder in folders:
        if folder.rstrip("/") not in used:
            _remove_month(spark, table, folder)


def analyze_months(spark: SparkSession, table: str, columns: list[str], months: list[tuple[int, int]] | None = None) -> dict[tuple[int, int], str]:
    """Refresh what the planner knows of a catalogued table: rows and bytes of months, all if none are
    named, and of the whole table, and its columns' extremes, nulls, distinct values and lengths. A
    month that fails does not stop the rest. Values: "done" or the error."""
    done = {}
    for y, m in _partitions(spark, table) if months is None else months:
        try:
            spark.sql(f"ANALYZE TABLE {table} PARTITION (year = {y}, month = {m}) COMPUTE STATISTICS")
            done[y, m] = "done"
        except Exception as e:  # noqa: BLE001
            done[y, m] = f"failed: {e}"
    spark.sql(f"ANALYZE TABLE {table} COMPUTE STATISTICS FOR COLUMNS {', '.join(columns)}")
    return done


def catalogue_stats(spark: SparkSession, table: str) -> DataFrame:
    """Rows and bytes of each month as the catalogue has them; null where it was never analysed."""
    rows = []
    for y, m in _partitions(spark, table):  # one entry a month
        said = _described(spark, table, (y, m)).get("Partition Statistics", "")
        found = {unit: int(n) for n, unit in re.findall(r"(\d+) (bytes|rows)", said)}
        rows.append((y, m, found.get("rows"), found.get("bytes")))
    return spark.createDataFrame(rows, "year int, month int, rows long, bytes long")


def catalogue_column_stats(spark: SparkSession, table: str, columns: list[str]) -> DataFrame:
    """Extremes as text, nulls and distinct values of columns as the catalogue has them."""
    rows = []
    for c in columns:
        said = {r["info_name"]: r["info_value"] for r in spark.sql(f"DESCRIBE EXTENDED {table} {c}").collect()}
        number = lambda k: int(said[k]) if said.get(k, "NULL") != "NULL" else None  # noqa: E731, B023
        rows.append((c, number("num_nulls"), number("distinct_count"), *(None if said.get(k, "NULL") == "NULL" else said[k] for k in ("min", "max"))))
    return spark.createDataFrame(rows, "column string, nulls long, distinct long, least string, greatest string")


def table_stats(rows: DataFrame, columns: list[str]) -> DataFrame:
    """Per month and column: rows, nulls, distinct values and the extremes as text."""
    one = [F.struct(F.lit(c).alias("column"), F.count("*").alias("rows"), F.count_if(F.col(c).isNull()).alias("nulls"), F.approx_count_distinct(c, 0.01).alias("distinct"), F.min(c).cast("string").alias("least"), F.max(c).cast("string").alias("greatest")) for c in columns]
    return rows.groupBy("year", "month").agg(F.array(*one).alias("s")).select("year", "month", F.explode("s").alias("s")).select("year", "month", "s.*")
