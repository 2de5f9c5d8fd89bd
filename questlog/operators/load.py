"""Archive lines to month-partitioned tables, without duplicates and inside the retention window."""

from __future__ import annotations

import datetime as dt

from pyspark.sql import Column, DataFrame, Window
from pyspark.sql import functions as F

from questlog.schemas import EVENT_COLUMNS, NOT_NULL, WIDTHS

KEY = ["event_timestamp", "event_id"]
#: What a column that is not text is cast to.
_TYPES = {c: "bigint" if "timestamp" in c else "double" for c in EVENT_COLUMNS if c not in WIDTHS}
#: Milliseconds of a time at most, as a timestamp counts microseconds in 64 bits.
MOST_MS = (2**63 - 1) // 1000
#: Rows of a batch up to which its keys are sent to every task that reads history: some 20 MB.
FEW_KEYS = 200_000


def blank_as_null(column: Column) -> Column:
    return F.when(F.trim(column) != "", column)


def project_event_row(lines: DataFrame, json: str = "value", errors: bool = False) -> DataFrame:
    """JSON lines to the eleven columns: missing keys and blank strings are null, times are timestamps.

    A value that is no number where one belongs is null, and so is a time beyond what a timestamp
    holds (some 292,000 years); with errors, type_errors names such columns, and load_errors counts
    them in.
    """
    parsed = lines.select(F.inline(F.array(F.from_json(json, ", ".join(f"{c} string" for c in EVENT_COLUMNS)))))
    number = lambda c: F.col(c).try_cast(_TYPES[c])
    far = lambda c: ~number(c).between(-MOST_MS, MOST_MS) if "timestamp" in c else F.lit(False)
    error = lambda c, t: F.when(F.col(c).isNotNull() & number(c).isNull(), f"{c} is no {t}").when(far(c), f"{c} is out of range")
    wrong = F.filter(F.array(*[error(c, t) for c, t in _TYPES.items()]), lambda x: x.isNotNull())
    columns = [(blank_as_null(F.col(c)) if c in WIDTHS else F.timestamp_millis(F.when(~far(c), number(c))) if "timestamp" in c else number(c)).alias(c) for c in EVENT_COLUMNS]
    return parsed.select(*columns, *([wrong.alias("type_errors")] if errors else []))


def with_month(rows: DataFrame, column: str = "event_timestamp") -> DataFrame:
    return rows.withColumns({"year": F.year(column), "month": F.month(column)})


def load_errors(rows: DataFrame) -> Column:
    """Names of the rules that a row breaks: types, missing values, widths."""
    rules = [*[F.when(F.col(c).isNull(), f"{c} is null") for c in NOT_NULL], *[F.when(F.length(c) > n, f"{c} is too long") for c, n in WIDTHS.items()]]
    broken = F.filter(F.array(*rules), lambda x: x.isNotNull())
    return F.concat("type_errors", broken) if "type_errors" in rows.columns else broken


def split_load_errors(rows: DataFrame, on_error: str = "fail") -> tuple[DataFrame, DataFrame]:
    """Rows that may be loaded, and the others with their errors. With on_error="fail" one wrong
    row fails the load when it is read; with "quarantine" wrong rows are only kept apart."""
    if on_error not in ("fail", "quarantine"):
        raise ValueError(on_error)
    marked = rows.withColumn("errors", load_errors(rows)).drop("type_errors")
    good = F.size("errors") == 0
    bad = marked.where(~good)
    if on_error == "fail":
        return marked.where(good | F.raise_error(F.concat(F.lit("load error: "), F.array_join("errors", ", "))).cast("boolean")).drop("errors"), bad
    return marked.where(good).drop("errors"), bad


def months_in_batch(rows: DataFrame) -> DataFrame:
    return with_month(rows).select("year", "month").distinct().orderBy("year", "month")


def _window(as_of: dt.date, months: int) -> tuple[Column, Column]:
    this = F.trunc(F.lit(as_of), "month")
    return F.add_months(this, -months).cast("timestamp"), F.add_months(this, 1).cast("timestamp")


def retention_filter(rows: DataFrame, as_of: dt.date, months: int = 6, column: str = "event_timestamp") -> DataFrame:
    """Rows whose month starts no earlier than the month so many months ago and no later than this one."""
    first, end = _window(as_of, months)
    return rows.where((F.col(column) >= first) & (F.col(column) < end))


def month_slice(rows: DataFrame, year: int, month: int) -> DataFrame:
    return rows.where((F.col("year") == year) & (F.col("month") == month))


def distinct_rows(rows: DataFrame) -> DataFrame:
    """Rows equal in every column once; a copy that arrived later is another row."""
    return rows.distinct()


def anti_existing(rows: DataFrame, existing: DataFrame, keys: list[str] = KEY) -> DataFrame:
    """Rows whose key the table does not hold. Only the keys of the table are read; which side is
    small enough to be sent around is left to the planner."""
    return rows.join(existing.select(*keys), keys, "left_anti")


def sorted_insert(rows: DataFrame) -> DataFrame:
    """Rows in the order of the table within each partition, for a write that prunes by time."""
    return rows.sortWithinPartitions("event_timestamp", "event_type")


def strict_key_dedupe(rows: DataFrame, keys: list[str] = KEY, first: str = "server_timestamp") -> DataFrame:
    """One row for each key, the earliest to arrive; the other columns break ties."""
    rest = [c for c in rows.columns if c not in (*keys, first)]
    order = Window.partitionBy(*keys).orderBy(first, *rest)
    return rows.withColumn("_n", F.row_number().over(order)).where("_n = 1").drop("_n")


def prune_history(existing: DataFrame, as_of: dt.date, months: int = 6, batch_months: list[tuple[int, int]] | None = None, span: tuple[int, int] | None = None) -> DataFrame:
    """History cut to the retention window, and to the months and the first and last microsecond of a
    batch where they are known. Of a table partitioned by year and month no other month is listed or read; as its files
    are sorted by time, of those that are read whole parts are passed over by their extremes."""
    if span is not None:
        existing = existing.where(F.col("event_timestamp").between(*[F.timestamp_micros(F.lit(x)) for x in span]))
    if not {"year", "month"} <= set(existing.columns):
        return retention_filter(existing, as_of, months)
    number = F.col("year") * 12 + F.col("month")
    this = as_of.year * 12 + as_of.month
    near = existing.where((number >= this - months) & (number <= this))
    if batch_months is not None:
        near = near.where(number.isin([y * 12 + m for y, m in batch_months]))
    return retention_filter(near, as_of, months)


def matching_history(existing: DataFrame, rows: DataFrame, keys: list[str] = KEY) -> DataFrame:
    """History cut to the keys of a batch of at most FEW_KEYS rows, by a semi-join where it is read,
    so that a small batch never makes history travel. The caller has counted the rows."""
    return existing.join(F.broadcast(rows.select(*keys)), keys, "left_semi")


def batch_profile(rows: DataFrame, as_of: dt.date, months: int = 6) -> DataFrame:
    """What a load has to know of a batch, in one pass: for each month inside the retention window,
    and for all other rows together (year and month null), the rows that arrived, those that break
    a rule, those outside the window, and the first and the last microsecond of those that may be loaded."""
    first, end = _window(as_of, months)
    t = F.col("event_timestamp")
    fine, inside = F.size(load_errors(rows)) == 0, F.coalesce((t >= first) & (t < end), F.lit(False))
    kept = fine & inside
    marked = rows.select(t, fine.alias("fine"), kept.alias("kept"), *[F.when(kept, c).alias(n) for n, c in (("year", F.year(t)), ("month", F.month(t)))])
    return marked.groupBy("year", "month").agg(
        F.count("*").alias("copied"), F.count_if(~F.col("fine")).alias("load_errors"), F.count_if(F.col("fine") & ~F.col("kept")).alias("out_of_retention"),
        F.min(F.when(F.col("kept"), F.unix_micros(t))).alias("first"), F.max(F.when(F.col("kept"), F.unix_micros(t))).alias("last"),
    )


def dedupe_load(
    rows: DataFrame, existing: DataFrame, as_of: dt.date, months: int = 6, on_error: str = "fail",
    batch_months: list[tuple[int, int]] | None = None, span: tuple[int, int] | None = None, batch_rows: int | None = None,
) -> DataFrame:
    """What a load adds to the tables, for all its months at once; nothing when it is run again.

    Rows that break a rule of load_errors fail the load, or are left out with on_error="quarantine";
    so no key is null. Retention comes before the shuffle, so that times of zero never reach it. One
    layout by key serves both the distinct rows and the join against history, which is pruned by
    what is known of the batch; where its number of rows is known and small, also by its keys.
    """
    good, _ = split_load_errors(rows, on_error)
    spread = retention_filter(good, as_of, months).repartition(*KEY)
    history = prune_history(existing, as_of, months, batch_months, span)
    if batch_rows is not None and batch_rows <= FEW_KEYS:
        history = matching_history(history, retention_filter(good, as_of, months))
    return sorted_insert(with_month(anti_existing(distinct_rows(spread), history)))


def load_audit(rows: DataFrame, existing: DataFrame, as_of: dt.date, months: int = 6, files: int | None = None) -> DataFrame:
    """Copied and inserted rows, duplicates ignored as the difference, and how that splits into rows
    that break a rule, rows outside the window and true duplicates; months of all rows; the number
    of files where it is given.

    Rows are read and spread once. Those that may be loaded lie by their keys, equal ones together
    with their number, and meet the keys of history there; of the others only what they are counts
    as travels, from each task to a place of its own.
    """
    columns = [c for c in rows.columns if c != "type_errors"]
    first, end = _window(as_of, months)
    t = F.col("event_timestamp")
    marked = rows.select(*columns, (F.size(load_errors(rows)) > 0).alias("wrong"), F.coalesce((t >= first) & (t < end), F.lit(False)).alias("inside"))
    fine = F.col("inside") & ~F.col("wrong")
    place = F.when(fine, F.lit(-1)).otherwise(F.spark_partition_id()).alias("place")
    spread = marked.select(*[F.when(fine, F.col(c)).alias(c) for c in columns], "wrong", "inside", F.trunc(t, "month").alias("m"), place).repartition(*KEY, "place")
    each = spread.groupBy(*columns, "wrong", "inside", "m", "place").agg(F.count("*").alias("n"))
    # no literal, which the planner would take out of the join and then deal all rows out again
    here = F.when(F.col("event_id").isNotNull(), -1).otherwise(-2).alias("place")
    known = prune_history(existing, as_of, months).select(*KEY, here).repartition(*KEY, "place").groupBy(*KEY, "place").agg(F.lit(True).alias("known"))
    counted = each.join(known, [*KEY, "place"], "left").groupBy("m").agg(
        F.sum("n").alias("copied"), F.sum(F.when(F.col("wrong"), F.col("n"))).alias("load_errors"), F.sum(F.when(~F.col("wrong") & ~F.col("inside"), F.col("n"))).alias("out_of_retention"),
        F.count_if(fine & F.col("known").isNull()).alias("inserted"),
    )
    total = [F.coalesce(F.sum(c), F.lit(0)).alias(c) for c in ("copied", "inserted", "out_of_retention", "load_errors")]
    duplicates = F.col("copied") - F.col("inserted")
    out = counted.agg(*total, F.count("m").alias("months")).select(
        "copied", "inserted", duplicates.alias("duplicates_ignored"), "out_of_retention",
        (duplicates - F.col("out_of_retention") - F.col("load_errors")).alias("true_duplicates"), "load_errors", "months",
    )
    return out if files is None else out.withColumn("files", F.lit(files).cast("long"))
