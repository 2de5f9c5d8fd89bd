"""Places of rows in the order of their group, for groups of any size."""

from __future__ import annotations

from functools import reduce

from pyspark.sql import DataFrame, Window
from pyspark.sql import functions as F

from questlog.session import written


def number_rows(rows: DataFrame, keys: list[str], order: list[str], place: str = "place") -> DataFrame:
    """Add the place of each row in its group, from 0, in the given order.

    Rows are sorted by ranges of keys and order and written once, so a large group is spread over as
    many tasks as it fills. A row's place is its place in its range and the number of the group's
    rows in ranges before, which is summed over one row for each group and range. Nulls come first
    and are a group of their own; rows that are equal in keys and order lie in one range.
    """
    at, low, part, shift = "_at", "_low", "_part", "_shift"
    by = [F.col(c) for c in (*keys, *order)]
    ordered = written(rows.repartitionByRange(*by).sortWithinPartitions(*by).withColumn(at, F.monotonically_increasing_id()))
    ordered = ordered.withColumn(part, F.shiftright(at, 33))
    counts = ordered.groupBy(*keys, part).agg(F.min(at).alias(low), F.count("*").alias("_n"))
    before = Window.partitionBy(*keys).orderBy(part).rowsBetween(Window.unboundedPreceding, -1)
    starts = counts.select(*[F.col(k).alias(f"_{k}") for k in keys], F.col(part).alias("_range"), (F.coalesce(F.sum("_n").over(before), F.lit(0)) - F.col(low)).alias(shift))
    same = reduce(lambda a, b: a & b, (F.col(k).eqNullSafe(F.col(f"_{k}")) for k in keys), F.col(part) == F.col("_range"))
    return ordered.join(starts, same).select(*rows.columns, (F.col(at) + F.col(shift)).alias(place))
