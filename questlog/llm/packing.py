"""Packing: optimal length buckets, and batches of a token budget inside each."""

from __future__ import annotations

import math

import numpy as np
from pyspark.sql import Column, DataFrame, Window
from pyspark.sql import functions as F

#: A token, as a pattern; white space in front of one and at the end of a text goes with it.
TOKEN = r"\S+"
MAX_TOKENS = 4096
BUCKETS = 16
BATCH_TOKENS = 65_536
#: Pieces that are numbered together.
SHARD_ROWS = 1000


def count_tokens(text: Column) -> Column:
    return F.when(text.isNull(), 0).otherwise(F.regexp_count(text, F.lit(TOKEN)))


def cut_pieces(docs: DataFrame, doc_id: str, text: str, max_tokens: int) -> DataFrame:
    """One row (doc_id, piece, n_tokens, text) for each piece of at most max_tokens; pieces joined are the text."""
    counted = docs.select(F.col(doc_id).alias("doc_id"), F.col(text).alias("text"), count_tokens(F.col(text)).alias("n"))
    tokens = F.regexp_extract_all("text", F.lit(rf"\s*{TOKEN}(?:\s+\z)?"), F.lit(0))
    many = F.transform(
        F.sequence(F.lit(0), F.floor((F.col("n") - 1) / max_tokens).cast("int")),
        lambda i: F.struct(i.alias("piece"), F.least(F.lit(max_tokens), F.col("n") - i * max_tokens).alias("n_tokens"), F.lit(None).cast("string").alias("text")),
    )
    slices = F.aggregate(
        F.array(tokens),
        F.array().cast("array<string>"),
        lambda _, t: F.transform(F.sequence(F.lit(0), F.floor((F.size(t) - 1) / max_tokens).cast("int")), lambda i: F.array_join(F.slice(t, i * max_tokens + 1, max_tokens), "")),
    )
    pieces = F.when(
        F.col("n") > max_tokens,
        F.zip_with(many, slices, lambda p, s: F.struct(p["piece"].alias("piece"), p["n_tokens"].alias("n_tokens"), s.alias("text"))),
    ).otherwise(F.array(F.struct(F.lit(0).alias("piece"), F.col("n").alias("n_tokens"), F.col("text").alias("text"))))
    return counted.select("doc_id", F.explode(pieces).alias("p")).select("doc_id", "p.*")


def optimal_bounds(lengths: list[int], counts: list[int], buckets: int) -> list[int]:
    """Upper lengths of at most so many buckets with the least padding in all.

    Dynamic programming over the histogram: the best cost of the first j lengths in k buckets
    tries every place where the last bucket may begin. On a tie the earliest place wins.
    """
    order = np.argsort(np.array(lengths, np.int64))
    size = np.array(lengths, np.int64)[order]
    n = len(size)
    if not n:
        return []
    total = np.concatenate([[0], np.cumsum(np.array(counts, np.int64)[order])])
    cost = size * total[1:]
    back: list[np.ndarray] = []
    for _ in range(1, min(buckets, n)):
        old = np.concatenate([[0], cost])
        cost, at = cost.copy(), np.zeros(n, np.int64)
        for j in range(n):
            tries = old[: j + 1] + size[j] * (total[j + 1] - total[: j + 1])
            at[j] = tries.argmin()
            cost[j] = tries[at[j]]
        back.append(at)
    bounds, j = [], n
    for at in [*reversed(back), None]:
        if j == 0:
            break
        bounds.append(int(size[j - 1]))
        j = int(at[j - 1]) if at is not None else 0
    return bounds[::-1]


def pack(docs: DataFrame, doc_id: str = "doc_id", text: str = "text", max_tokens: int = MAX_TOKENS, buckets: int = BUCKETS, batch_tokens: int = BATCH_TOKENS) -> DataFrame:
    """Pack every document: one row for each piece with bucket, batch and slot.

    doc_id, piece, n_tokens, text, bucket, bucket_tokens (the length it is padded to), batch
    (numbered from 0 in each bucket) and slot in the batch. A batch holds as many pieces as fit
    the budget at the bucket's length, one at least; only the last of a bucket may hold fewer.
    The histogram has max_tokens + 1 rows at most, whatever the input. Null and empty texts, and
    ones of white space only, are pieces of no tokens. Repeated rows are packed each; pieces of a
    bucket are numbered by shards of a hash of id, place and text, so no bucket is ever in one task,
    nor are rows without an id. Only rows that are equal in all three share a shard.
    """
    pieces = cut_pieces(docs, doc_id, text, max_tokens)  # counted anew where it is used: cheaper than texts on disk
    histogram = pieces.groupBy("n_tokens").count().collect()
    counts = {r["n_tokens"]: r["count"] for r in histogram}
    bounds = optimal_bounds(list(counts), list(counts.values()), buckets)
    inside = [sum(c for n, c in counts.items() if lo < n <= hi) for lo, hi in zip([-1, *bounds[:-1]], bounds)]
    bucket = F.lit(0)
    for bound in bounds[:-1]:
        bucket = bucket + (F.col("n_tokens") > bound).cast("int")
    pick = lambda values: F.get(F.array(*[F.lit(int(v)) for v in values or [1]]), F.col("bucket"))
    placed = pieces.withColumn("bucket", bucket).withColumns({
        "bucket_tokens": pick(bounds),
        "mark": F.xxhash64("doc_id", "piece", "text"),
        "shard": F.pmod(F.xxhash64("doc_id", "piece", "text"), pick([max(1, math.ceil(n / SHARD_ROWS)) for n in inside])),
        "room": pick([max(1, batch_tokens // max(1, b)) for b in bounds]),
    })
    sizes = placed.groupBy("bucket", "shard").agg(F.count("*").alias("n"))
    before = Window.partitionBy("bucket").orderBy("shard").rowsBetween(Window.unboundedPreceding, -1)
    offsets = sizes.select("bucket", "shard", F.coalesce(F.sum("n").over(before), F.lit(0)).alias("offset"))
    numbered = placed.withColumn("number", F.row_number().over(Window.partitionBy("bucket", "shard").orderBy("doc_id", "piece", "mark")) - 1).join(offsets, ["bucket", "shard"])
    at = F.col("offset") + F.col("number")
    return numbered.select(
        "doc_id", "piece", "n_tokens", "text", "bucket", "bucket_tokens",
        F.floor(at / F.col("room")).alias("batch"), (at % F.col("room")).cast("int").alias("slot"),
    )
