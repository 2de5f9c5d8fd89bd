"""Operational metrics: roll-ups, statistics per period, usage reports."""

from __future__ import annotations

from pyspark.sql import Column, DataFrame
from pyspark.sql import functions as F


def metrics_by_shard(points: DataFrame, shard_level: bool = True) -> DataFrame:
    """Sums of points at [operation, component] and, if asked for, again at [operation, component, shard]."""
    sets = [["operation", "component", "name"]] + ([["operation", "component", "name", "shard_id"]] if shard_level else [])
    columns = ["operation", "component", "name", "shard_id"]
    grouped = points.groupingSets([[F.col(c) for c in s] for s in sets], *columns)
    return grouped.agg(F.sum("value").alias("total"), F.count("*").alias("points"), F.grouping("shard_id").cast("int").alias("all_shards"))


def metric_dimensions(own: Column, common: Column, most: int = 10) -> Column:
    """Own and common dimensions as one map of the first so many keys in order; own ones win."""
    return F.map_from_entries(F.slice(F.sort_array(F.map_entries(F.map_concat(common, own))), 1, most))


def metric_statistics(points: DataFrame, period: str = "1 day", start: str | None = None, end: str | None = None) -> DataFrame:
    """Average, extremes, number and sum per metric and period in [start, end)."""
    if start is not None:
        points = points.where(F.col("ts") >= F.lit(start).cast("timestamp"))
    if end is not None:
        points = points.where(F.col("ts") < F.lit(end).cast("timestamp"))
    return (
        points.groupBy(F.window("ts", period).alias("w"), "namespace", "name", "dimensions")
        .agg(F.avg("value").alias("average"), F.max("value").alias("maximum"), F.min("value").alias("minimum"), F.count("value").alias("sample_count"), F.sum("value").alias("total"))
        .select(F.col("w.start").alias("window_start"), F.col("w.end").alias("window_end"), "namespace", "name", "dimensions", "average", "maximum", "minimum", "sample_count", "total")
    )


def emit_volume(records: DataFrame, by: list[str], data: str = "data") -> DataFrame:
    """Records and bytes of each batch."""
    return records.groupBy(*by).agg(F.count("*").alias("records"), F.coalesce(F.sum(F.octet_length(data)), F.lit(0)).alias("bytes"))


def availability(flags: DataFrame) -> DataFrame:
    """Share of successes per operation."""
    return flags.groupBy("operation").agg(F.avg(F.col("ok").cast("double")).alias("availability"), F.count("*").alias("calls"))


def usage_rows(records: DataFrame, files: DataFrame, day: Column) -> DataFrame:
    """Per day: number of events, their bytes, number of files."""
    events = records.groupBy(day.alias("day")).agg(F.count("*").alias("total_event_count"), F.sum(F.octet_length("data")).alias("total_event_bytes"))
    counted = files.groupBy("day").agg(F.count("*").alias("total_file_count"))
    joined = events.join(counted, "day", "left").withColumn("total_file_count", F.coalesce("total_file_count", F.lit(0)))
    return joined.unpivot("day", ["total_event_count", "total_event_bytes", "total_file_count"], "metric", "total")


def usage_report(rows: DataFrame, solution: str, sent: Column) -> DataFrame:
    """One JSON payload for each day, its statistics by name."""
    data = F.transform(F.sort_array(F.collect_list(F.struct("metric", "total"))), lambda x: F.struct(x["metric"].alias("Metric"), x["total"].alias("Sum")))
    stamp = F.date_format(sent, "yyyyMMdd HHmmss.SSS")
    return rows.groupBy("day").agg(data.alias("d")).select("day", F.to_json(F.struct(F.lit(solution).alias("Solution"), stamp.alias("TimeStamp"), F.col("d").alias("Data"))).alias("payload"))
