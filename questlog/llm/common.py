"""What several of the text operators share: tables, splits, written cuts and components."""

from __future__ import annotations

import ctypes
import uuid
from collections.abc import Iterable, Iterator

import pyarrow as pa
from pyspark.sql import Column, DataFrame, SparkSession
from pyspark.sql import functions as F

from questlog.session import shared_folder


def table(spark: SparkSession, sf_dir: str, name: str) -> DataFrame:
    """One of the given tables, by any path that Spark's readers open."""
    return spark.read.parquet(f"{sf_dir}/{name}.parquet")


def crc_is(column: str, modulus: int, remainder: int) -> Column:
    """Whether crc32 of the id as text leaves the remainder; false where the id is null."""
    crc = F.crc32(F.col(column).cast("string").cast("binary"))
    return F.coalesce(crc % modulus == remainder, F.lit(False))


def cut(df: DataFrame, options: dict[str, str] | None = None) -> DataFrame:
    """Write a frame as a table in the shared folder and read it back: a short lineage of known size.

    Tables of one application lie in one folder, which may be deleted once its results are written.
    """
    spark = df.sparkSession
    path = f"{shared_folder(spark)}/questlog-{spark.sparkContext.applicationId}/{uuid.uuid4().hex}"
    df.write.options(**(options or {})).parquet(path)
    return spark.read.schema(df.schema).parquet(path)


def release() -> None:
    """Hand memory that has been freed back to the system, where the C library can."""
    pa.default_memory_pool().release_unused()
    trim = getattr(ctypes.CDLL(None), "malloc_trim", None)
    if trim:
        trim(0)


def by_size(texts: Iterable, limit: int = 1 << 21) -> Iterator[list[str | None]]:
    """Lists of texts of about so many characters, so that what is made of one at a time stays
    small; a longer text comes alone. Missing values are None."""
    part: list[str | None] = []
    size = 0
    for x in texts:
        x = x if isinstance(x, str) else None
        if part and size + len(x or "") > limit:
            yield part
            part, size = [], 0
        part.append(x)
        size += len(x or "")
    if part:
        yield part


def _signature(edges: DataFrame) -> tuple:
    return tuple(edges.agg(F.count("*"), F.sum(F.xxhash64("u", "v") % 1_000_000_007)).first())


def components(edges: DataFrame) -> DataFrame:
    """Connected components of links (a, b): one row (node, component) for each node that has a
    link to another one; component is the smallest node reachable.

    Alternating large and small stars: every round joins edges with one minimum per node, so a
    node with very many links costs rows, never a list in memory. Minima are written before the
    join, so both sides of it are plain shuffles whose large partitions Spark may split.
    """
    e = cut(
        edges.where(F.col("a") != F.col("b"))
        .select(F.greatest("a", "b").alias("u"), F.least("a", "b").alias("v"))
        .distinct()
    )
    before = _signature(e)
    while before[0]:
        both = e.unionByName(e.select(F.col("v").alias("u"), F.col("u").alias("v")))
        low = cut(both.groupBy("u").agg(F.least(F.min("v"), F.col("u")).alias("m")))
        large = cut(
            both.where(F.col("v") > F.col("u"))
            .join(low, "u")
            .select(F.col("v").alias("u"), F.col("m").alias("v"))
            .distinct()
        )
        low = cut(large.groupBy("u").agg(F.min("v").alias("m")))
        linked = large.join(low, "u").where(F.col("v") != F.col("m")).select(F.col("v").alias("u"), F.col("m").alias("v"))
        e = cut(linked.unionByName(low.select("u", F.col("m").alias("v"))).distinct())
        after = _signature(e)
        if after == before:
            break
        before = after
    return e.groupBy(F.col("u").alias("node")).agg(F.min("v").alias("component")).unionByName(
        e.select(F.col("v").alias("node"), F.col("v").alias("component")).distinct()
    )
