"""Batches of ordered records per shard, each shard in as many tasks as it fills."""

from __future__ import annotations

from collections.abc import Iterator

import numpy as np
import pandas as pd
from pyspark.sql import DataFrame, Window
from pyspark.sql import functions as F

from questlog.config import Limits
from questlog.operators.ranking import number_rows
from questlog.session import written

#: Records of a shard that one task cuts; a batch has to end in the block after the one it begins in,
#: so a block holds as many records as a batch at least.
LEAST_BLOCK, MOST_BLOCK = 1 << 16, 1 << 20


def batch_by_count(records: DataFrame, n: int = 100) -> DataFrame:
    """Batches of n records in each shard's order; the last one is short."""
    return number_rows(records, ["shard_id"], ["sequence_number"]).withColumn("batch", F.floor(F.col("place") / n)).drop("place")


def _first_at_least(values: np.ndarray, least: np.ndarray) -> np.ndarray:
    """For each i the first place from i on whose value is at least least[i], and the length where
    there is none. Values need not rise: a tree of maxima is climbed and descended for all at once."""
    n = len(values)
    if n < 2 or (values[1:] >= values[:-1]).all():
        return np.maximum(np.searchsorted(values, least, "left"), np.arange(n))
    size = 1 << (n - 1).bit_length()
    tree = np.full(2 * size, np.iinfo(np.int64).min)
    tree[size : size + n] = values
    for width in (size >> k for k in range(1, size.bit_length())):
        tree[width : 2 * width] = np.maximum(tree[2 * width : 4 * width : 2], tree[2 * width + 1 : 4 * width : 2])
    node = np.arange(n) + size
    climbing = np.nonzero(tree[node] < least)[0]
    while climbing.size:  # to the next subtree on the right, the largest that begins there
        up = node[climbing] + 1
        up //= up & -up
        node[climbing] = up
        climbing = climbing[(up > 1) & (tree[up] < least[climbing])]
    none = node <= 1
    node[none] = 1
    while (inner := np.nonzero((node < size) & ~none)[0]).size:
        left = 2 * node[inner]
        node[inner] = left + (tree[left] < least[inner])
    return np.where(none, n, node - size)


def next_starts(size: np.ndarray, us: np.ndarray, limits: Limits) -> np.ndarray:
    """For a batch that begins at each record, the place at which the next one begins: behind the
    first record with which number, bytes or age reach a limit; beyond the end where none does."""
    n = len(size)
    place = np.arange(n)
    total = np.cumsum(size)
    close = place + max(1, limits.flush_records) - 1
    close = np.minimum(close, np.maximum(place, np.searchsorted(total, total - size + limits.flush_bytes, "left")))
    close = np.minimum(close, _first_at_least(us, us + 1000 * limits.flush_ms) if limits.flush_ms < 1 << 50 else n)
    return np.minimum(close + 1, n + 1)


def _last_starts(following: np.ndarray, own: int) -> np.ndarray:
    """For a batch that begins at each record of a block, the last one that begins in the block after it."""
    at = np.arange(len(following))
    end = np.where(at < own, own, len(following))
    last = np.where(following < end, following, at)
    while True:
        far = last[last]
        if (far == last).all():
            return last
        last = far


def _with_next_block(sized: DataFrame, block: int) -> DataFrame:
    """Each record in its block, and in the one before as what comes after it."""
    own = F.floor(F.col("place") / block)
    return sized.select("shard", "place", "us", "size", F.explode(F.array(own, own - 1)).alias("block")).where("block >= 0")


def _split(part: pd.DataFrame, block: int) -> tuple[pd.DataFrame, int, int]:
    """A block and the next one in order, the block's first place and its number of records."""
    part = part.sort_values("place", kind="stable")
    first = int(part["block"].iloc[0]) * block
    return part, first, int((part["place"] < first + block).sum())


def _begun(part: pd.DataFrame, first: int, own: int, limits: Limits) -> np.ndarray:
    """Where batches begin in a block of so many records, the first of them at a given place."""
    following = next_starts(part["size"].to_numpy(), part["us"].to_numpy(), limits)
    places = []
    while first < own:
        places.append(first)
        first = int(following[first])
    return np.array(places, np.int64)


def flush_batches(records: DataFrame, limits: Limits = Limits()) -> DataFrame:
    """Cut each shard's records when their number, bytes or age since the batch's first reach a limit.

    The cut after a record resets all three, so each batch depends on the one before. A task has one
    block of a shard's records and the next block; for a batch that begins anywhere in its block it
    finds where the next one begins, and so which batch is under way when the block ends. What that
    leads to in the next block is a pointer; pointers are doubled until those that follow from the
    shard's first record are known in every block. Then each block is cut on its own.

    Where all shards fit a block each, they are cut as one block each. Limits of more records than a
    block may hold are cut in each shard's order, as one stream.
    """
    sized = records.select("shard_id", "sequence_number", F.unix_micros("arrival_ts").alias("us"), F.coalesce(F.octet_length("data"), F.lit(0)).cast("long").alias("size"))
    if limits.flush_records > MOST_BLOCK:
        return _shown(_cut_in_order(sized, limits))
    shard = F.coalesce(F.concat(F.lit("="), F.col("shard_id").cast("string")), F.lit(""))  # one that equals itself where the id is null
    sized = sized.withColumn("shard", shard)
    block = max(LEAST_BLOCK, limits.flush_records)
    blocks = -(-(sized.groupBy("shard").count().agg(F.max("count")).first()[0] or 0) // block)
    if blocks <= 1:
        return _shown(_cut_whole_shards(sized, limits))
    numbered = written(number_rows(sized, ["shard"], ["sequence_number", "us"]))
    zero = F.lit(0).cast("long")
    first = numbered.select("shard").distinct().select("shard", zero.alias("block"), zero.alias("start"))
    starts = written(first.unionByName(_block_starts(numbered, limits, block, blocks)))

    def cut(_, parts: pd.DataFrame, begun: pd.DataFrame) -> pd.DataFrame:
        part, at, own = _split(parts, block)
        places = _begun(part, int(begun["start"].iloc[0]) - at if len(begun) else own, own, limits)
        inside = np.searchsorted(places, np.arange(own), "right")
        return part.iloc[:own][["shard", "place", "block"]].assign(inside=inside, begun=len(places))

    key = ["shard", "block"]
    cuts = written(_with_next_block(numbered, block).groupBy(*key).cogroup(starts.groupBy(*key)).applyInPandas(cut, "shard string, place long, block long, inside long, begun long"))
    before = Window.partitionBy("shard").orderBy("block").rowsBetween(Window.unboundedPreceding, -1)
    earlier = cuts.groupBy(*key).agg(F.max("begun").alias("n")).select(*key, (F.coalesce(F.sum("n").over(before), F.lit(0)) - 1).alias("earlier"))
    batches = cuts.join(earlier, key).select("shard", "place", (F.col("earlier") + F.col("inside")).alias("batch"))
    return _shown(numbered.join(batches, ["shard", "place"]))


def _cut_whole_shards(sized: DataFrame, limits: Limits) -> DataFrame:
    def cut(part: pd.DataFrame) -> pd.DataFrame:
        part = part.sort_values(["sequence_number", "us"], kind="stable")
        return part.assign(batch=np.searchsorted(_begun(part, 0, len(part), limits), np.arange(len(part)), "right") - 1)

    return sized.groupBy("shard").applyInPandas(cut, f"{', '.join(f'{f.name} {f.dataType.simpleString()}' for f in sized.schema)}, batch long")


def _shown(cut: DataFrame) -> DataFrame:
    return cut.select("shard_id", "sequence_number", F.timestamp_micros("us").alias("arrival_ts"), "size", "batch")


def _block_starts(numbered: DataFrame, limits: Limits, block: int, blocks: int) -> DataFrame:
    """The first batch that begins in each block but the shards' first ones: (shard, block, start)."""

    def lead(part: pd.DataFrame) -> pd.DataFrame:
        part, at, own = _split(part, block)
        following = next_starts(part["size"].to_numpy(), part["us"].to_numpy(), limits)
        last = _last_starts(following, own)
        under_way = np.unique(last[:own])
        start = following[under_way]
        reached = start < len(part)  # else the shard ends
        under_way, start = under_way[reached], start[reached]
        return pd.DataFrame({"shard": part["shard"].iloc[0], "block": part["block"].iloc[0], "at": under_way + at, "start": start + at, "to": last[start] + at, "root": last[0] + at})

    jumps = written(_with_next_block(numbered, block).groupBy("shard", "block").applyInPandas(lead, "shard string, block long, at long, start long, to long, root long"))
    known = jumps.where("block = 0 and at = root").select("shard", "at")
    jump, steps = jumps.select("shard", "at", "to"), 1
    while steps < blocks:  # known: what follows from the root in fewer than so many steps
        known = written(known.unionByName(known.join(jump, ["shard", "at"]).select("shard", F.col("to").alias("at"))))
        further = jump.select("shard", F.col("to").alias("further"), F.col("at").alias("from"))
        after = jump.select("shard", F.col("at").alias("further"), "to")
        jump, steps = written(further.join(after, ["shard", "further"]).select("shard", F.col("from").alias("at"), "to")), 2 * steps
    return jumps.join(known, ["shard", "at"], "left_semi").select("shard", (F.col("block") + 1).alias("block"), "start")


def _cut_in_order(sized: DataFrame, limits: Limits) -> DataFrame:
    """Each shard is sorted in one partition and read as a stream; only the running state is kept."""
    schema = "shard_id string, sequence_number string, us long, size long, batch long"

    def run(parts: Iterator[pd.DataFrame]) -> Iterator[pd.DataFrame]:
        shard, batch, count, size, began = object(), 0, 0, 0, 0
        for part in parts:
            out = []
            for s, us, n in zip(part["shard_id"], part["us"], part["size"]):
                if s != shard:
                    shard, batch, count, size = s, 0, 0, 0
                if not count:
                    began = us
                count, size = count + 1, size + n
                out.append(batch)
                if count >= limits.flush_records or size >= limits.flush_bytes or us - began >= 1000 * limits.flush_ms:
                    batch, count, size = batch + 1, 0, 0
            yield part.assign(batch=out)

    return sized.repartition("shard_id").sortWithinPartitions("shard_id", "sequence_number", "us").mapInPandas(run, schema)


def batch_summary(batched: DataFrame) -> DataFrame:
    """First and last sequence number, first arrival, records and bytes of each batch."""
    return batched.groupBy("shard_id", "batch").agg(
        F.min("sequence_number").alias("first_sequence"), F.max("sequence_number").alias("last_sequence"),
        F.min_by("arrival_ts", F.struct("sequence_number", "arrival_ts")).alias("first_arrival"), F.count("*").alias("records"), F.sum("size").alias("bytes"),
    )


def archive_key(summary: DataFrame, prefix: str = "events", suffix: str = ".gzip") -> DataFrame:
    """The archive's name for each batch, from the hour in which its first record arrived. Spark's
    readers know compressed text by the suffix .gz, loads that are told so take any."""
    name = F.concat_ws("-", "first_sequence", "last_sequence")
    return summary.withColumn("archive_key", F.concat(F.lit(f"{prefix}/"), F.date_format("first_arrival", "yyyy/MM/dd/HH/"), name, F.lit(suffix)))
