"""Deterministic raw records from the table of events, for Spark and for DuckDB by the same rules."""

from __future__ import annotations

from pyspark.sql import DataFrame, SparkSession
from pyspark.sql import functions as F

_DAMAGE = {97: "cut", 89: "no_type", 83: "bad_type", 79: "long_name", 73: "neg_time", 71: "bad_x", 67: "no_x", 61: "null_name", 59: "nested", 43: "no_version"}

_TEXT = """
'{"app_name":' || CASE d WHEN 'long_name' THEN '"' || repeat('S', 70) || '"' WHEN 'null_name' THEN 'null' ELSE '"SampleGame"' END
|| CASE d WHEN 'no_version' THEN '' ELSE ',"app_version":"1.0.' || CAST(i % 3 AS STRING) || '"' END
|| ',"event_version":"1.0","event_id":"e-' || CAST(i AS STRING) || '"'
|| CASE d WHEN 'no_type' THEN '' WHEN 'bad_type' THEN ',"event_type":"' || event_type || '@"' ELSE ',"event_type":"' || event_type || '"' END
|| ',"event_timestamp":' || CASE d WHEN 'neg_time' THEN '-100' ELSE CAST(ms - (i % 10) * 2592000000 AS STRING) END
|| ',"client_id":"c-' || CAST(user_id AS STRING) || '","level_id":"level_' || CAST(user_id % 5 AS STRING) || '"'
|| CASE d WHEN 'bad_x' THEN ',"position_x":"asdf"' WHEN 'no_x' THEN '' ELSE ',"position_x":' || CAST(300 + i * 37 % 400 AS STRING) || '.25' END
|| ',"position_y":' || CAST(550 + i * 53 % 400 AS STRING) || '.5'
|| CASE d WHEN 'nested' THEN ',"extra":{"a":[1,2]}' ELSE '' END || '}'
"""


def adapter_sql(table: str, millis: str) -> str:
    """Rows (i, shard_id, sequence_number, partition_key, arrival_ms, data as text)."""
    damage = "CASE " + " ".join(f"WHEN event_id % {n} = 0 THEN '{d}'" for n, d in _DAMAGE.items()) + " ELSE 'none' END"
    return f"""
SELECT i, 'shard-' || CAST(i % 4 AS STRING) AS shard_id, lpad(CAST(i AS STRING), 20, '0') AS sequence_number,
  'e-' || CAST(i AS STRING) AS partition_key, ms + (i % 7) * 1000 + more AS arrival_ms,
  CASE WHEN d = 'cut' THEN substr(text, 1, 40) ELSE text END AS data
FROM (SELECT *, {_TEXT} AS text FROM (SELECT event_id AS i, user_id, event_type, {millis} AS ms, {damage} AS d FROM {table}) AS a) AS b
CROSS JOIN (SELECT 0 AS copy, 0 AS more UNION ALL SELECT 1, 0 UNION ALL SELECT 2, 1000) AS c
WHERE copy = 0 OR (copy = 1 AND i % 53 = 0) OR (copy = 2 AND i % 47 = 0)
"""


def raw_records(spark: SparkSession, sf_dir: str, where: str = "true") -> DataFrame:
    events = spark.read.parquet(f"{sf_dir}/events.parquet").select("event_id", "user_id", "event_type", "ts")
    cores = spark.sparkContext.defaultParallelism
    if events.rdd.getNumPartitions() < cores:  # a small file is one partition
        events = events.repartition(cores)
    made = spark.sql(adapter_sql("{events}", "unix_millis(cast(ts AS timestamp))").replace("'{\"", "'{{\"").replace(":{\"a\":[1,2]}'", ":{{\"a\":[1,2]}}'").replace("|| '}'", "|| '}}'"), events=events)
    return made.where(where).select("shard_id", "sequence_number", "partition_key", F.timestamp_millis("arrival_ms").alias("arrival_ts"), F.col("data").cast("binary").alias("data"))


RAW_SQL = adapter_sql("events", "epoch_us(ts) // 1000")
