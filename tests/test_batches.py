"""Batches inside a shard, against record by record."""

import datetime as dt

import numpy as np
import pytest
from pyspark.sql import functions as F

from questlog.config import Limits
from questlog.operators import batching
from questlog.operators.ranking import number_rows

AT = dt.datetime(2024, 1, 1)
SCHEMA = "shard_id string, sequence_number string, partition_key string, arrival_ts timestamp, data binary"


def records(spark, shards):
    """(shard, millisecond, bytes) in order; sequence numbers follow it."""
    rows = [(s, f"{i:08d}", "k", AT + dt.timedelta(milliseconds=int(ms)), b"x" * int(n) if n is not None else None) for s in shards for i, (ms, n) in enumerate(shards[s])]
    return spark.createDataFrame(rows, SCHEMA).repartition(5)


def brute(shard, limits):
    out, batch, count, size, began = [], 0, 0, 0, 0
    for ms, n in shard:
        began = ms if not count else began
        count, size = count + 1, size + (n or 0)
        out.append(batch)
        if count >= limits.flush_records or size >= limits.flush_bytes or ms - began >= limits.flush_ms:
            batch, count, size = batch + 1, 0, 0
    return out


def shard(seed, n, late=True):
    rng = np.random.default_rng(seed)
    ms = np.cumsum(rng.integers(0, 20, n))
    if late:  # some arrive out of order
        ms = ms + rng.integers(-200, 200, n)
    return [(int(t), None if rng.random() < 0.1 else int(rng.integers(0, 50))) for t in ms]


LIMITS = [Limits(flush_records=7), Limits(flush_bytes=300), Limits(flush_ms=150), Limits(flush_records=30, flush_bytes=500, flush_ms=200), Limits(flush_records=1), Limits(flush_records=60, flush_bytes=1)]


@pytest.mark.parametrize("limits", LIMITS)
def test_cuts_in_many_blocks_against_record_by_record(spark, monkeypatch, limits):
    monkeypatch.setattr(batching, "LEAST_BLOCK", 8)
    limits = Limits(**(vars(limits) | {"flush_records": min(limits.flush_records, 64)}))
    shards = {"hot": shard(1, 1500), "small": shard(2, 40), "one": shard(3, 1), None: shard(4, 130, late=False)}
    got = {}
    for r in batching.flush_batches(records(spark, shards), limits).collect():
        got.setdefault(r["shard_id"], []).append((r["sequence_number"], r["batch"]))
    assert {s: [b for _, b in sorted(x)] for s, x in got.items()} == {s: brute(x, limits) for s, x in shards.items()}


def test_blocks_agree_with_the_order_of_one_stream(spark, monkeypatch):
    shards = {"a": shard(5, 300), "b": shard(6, 90)}
    limits = Limits(flush_records=50, flush_bytes=600, flush_ms=300)
    blocks = sorted(map(tuple, batching.flush_batches(records(spark, shards), limits).collect()))
    monkeypatch.setattr(batching, "MOST_BLOCK", 10)
    assert sorted(map(tuple, batching.flush_batches(records(spark, shards), limits).collect())) == blocks


def test_no_records(spark):
    none = spark.createDataFrame([], SCHEMA)
    assert batching.flush_batches(none).count() == 0 and batching.batch_by_count(none).count() == 0


def test_a_shard_is_numbered_by_ranges(spark):
    made = records(spark, {"hot": shard(7, 2000), None: shard(8, 30)})
    spark.conf.set("spark.sql.adaptive.coalescePartitions.enabled", "false")
    try:
        numbered = number_rows(made, ["shard_id"], ["sequence_number"])
        assert numbered.where("shard_id is null").count() == 30
        assert numbered.where((F.col("sequence_number").cast("long") != F.col("place")) | F.col("place").isNull()).count() == 0
        batched = batching.batch_by_count(made, 100)
        plan = batched._jdf.queryExecution().executedPlan().toString()
        assert plan.count("Window [") == 1 and "sequence_number" not in plan[plan.index("Window [") :].split("\n")[0]
        assert {(r["batch"], r["n"]) for r in batched.where("shard_id = 'hot'").groupBy("batch").agg(F.count("*").alias("n")).collect()} == {(b, 100) for b in range(20)}
        assert batched.columns == [*made.columns, "batch"]
    finally:
        spark.conf.unset("spark.sql.adaptive.coalescePartitions.enabled")
