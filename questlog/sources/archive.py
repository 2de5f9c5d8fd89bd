"""Sources and sinks: raw streams, archives, file pointers, manifests, month tables."""

from __future__ import annotations

import gzip
import json
import os
import uuid
from collections.abc import Callable, Iterator
from concurrent.futures import ThreadPoolExecutor
from contextlib import suppress
from itertools import groupby
from operator import itemgetter
from urllib.parse import unquote

import pyarrow as pa
from pyspark.sql import Column, DataFrame, SparkSession
from pyspark.sql import functions as F
from pyspark.sql.types import StructType

from questlog.functions.text import is_container
from questlog.operators.once import once
from questlog.schemas import RAW

PARTS = ["year", "month", "day", "hour"]
#: Files that are moved to their names side by side where the driver has that done.
MOVES = 32
#: The name of a file of lines without one.
NO_NAME = "__HIVE_DEFAULT_PARTITION__"


def read_raw_stream(spark: SparkSession, source: str, start: str = "latest", max_per_trigger: int | None = None, servers: str | None = None) -> DataFrame:
    """Raw records as a stream: of a topic if servers are given, else of Parquet files under a path."""
    if servers:
        reader = spark.readStream.format("kafka").option("kafka.bootstrap.servers", servers).option("subscribe", source).option("startingOffsets", start)
        if max_per_trigger:
            reader = reader.option("maxOffsetsPerTrigger", max_per_trigger)
        return reader.load().select(
            F.concat(F.lit("shard-"), "partition").alias("shard_id"), F.lpad(F.col("offset").cast("string"), 20, "0").alias("sequence_number"),
            F.col("key").cast("string").alias("partition_key"), F.col("timestamp").alias("arrival_ts"), F.col("value").alias("data"),
        )
    reader = spark.readStream.schema(RAW)
    if max_per_trigger:
        reader = reader.option("maxFilesPerTrigger", max_per_trigger)
    return reader.parquet(source)


def replay_jsonl(lines: DataFrame, now_ms: Column | int) -> DataFrame:
    """Events of JSON lines with event_timestamp set to now, keyed and spread by event_id.

    One row for each line: a repeated line is replayed each time, one that is no JSON object has a
    null key and a null value.
    """
    fields = F.from_json("value", "map<string,variant>")
    stamp = F.create_map(F.lit("event_timestamp"), F.lit(now_ms).cast("bigint").cast("variant"))
    event = F.to_json(F.map_concat(F.map_filter(fields, lambda k, _: k != "event_timestamp"), stamp))
    return lines.select(F.get_json_object("value", "$.event_id").alias("partition_key"), event.alias("value")).repartition("partition_key")


def hour_parts(ts: str) -> list[Column]:
    return [F.date_format(ts, p).alias(n) for n, p in zip(PARTS, ("yyyy", "MM", "dd", "HH"))]


def write_archive(lines: DataFrame, path: str, mode: str = "append") -> None:
    """Lines (arrival_ts, value) as gzip text by hour of arrival.

    Rows come together by hour; adaptive execution splits a large hour into several files of the
    advisory size and puts small ones into one task.
    """
    shared = lines.select(F.regexp_replace("value", r"\n\z", "").alias("value"), *hour_parts("arrival_ts"))
    shared.hint("rebalance", *PARTS).write.mode(mode).partitionBy(*PARTS).option("compression", "gzip").text(path)


def write_named_archive(lines: DataFrame, path: str, name: str = "archive_key") -> list[str]:
    """Lines (archive_key, sequence_number, value) as one gzip file for each batch, under the name that its key says.

    A batch has a bounded number of records and bytes, so a task writes each on its own, in its
    order. A file is written aside and moved to its name; one that is there already is replaced.
    Under a path of files, which driver and executors share, tasks do both, many side by side and
    again where one fails. In another store Spark writes the files, and the driver has them moved
    to their names MOVES at a time. Returns the names.
    """
    spark = lines.sparkSession
    key = F.coalesce(F.nullif(F.col(name).cast("string"), F.lit("")), F.lit(NO_NAME)).alias("key")
    rows = lines.select(key, "sequence_number", F.regexp_replace("value", r"\n\z", "").alias("value")).repartition("key").sortWithinPartitions("key", "sequence_number", "value")
    to = spark.sparkContext._jvm.org.apache.hadoop.fs.Path
    fs = to(path).getFileSystem(spark.sparkContext._jsc.hadoopConfiguration())
    root, aside = fs.makeQualified(to(path)), f"_named-{uuid.uuid4().hex}"
    try:
        if root.toUri().getScheme() == "file":
            written = rows.select("key", F.col("value").cast("binary").alias("value")).mapInArrow(_named_files(root.toUri().getPath(), aside), "key string")
            return sorted(r["key"] for r in written.collect())
        # where a task is written again its files have the same names, and nobody reads the folder before
        rows.select("key", "value").write.partitionBy("key").option("compression", "gzip").option("mapreduce.fileoutputcommitter.algorithm.version", "2").text(f"{path}/{aside}")
        return _move_to_names(to, fs, path, aside)
    finally:
        fs.delete(to(f"{path}/{aside}"), True)


def _named_files(root: str, aside: str) -> Callable[[Iterator[pa.RecordBatch]], Iterator[pa.RecordBatch]]:
    """What writes sorted lines (key, value) to a file for each key under a root that all tasks see,
    and returns the keys. Hadoop's checksum of a file that is replaced goes with it."""

    def write(parts: Iterator[pa.RecordBatch]) -> Iterator[pa.RecordBatch]:
        keys = []
        os.makedirs(f"{root}/{aside}", exist_ok=True)
        pairs = ((k, v) for part in parts for k, v in zip(part["key"].to_pylist(), part["value"].to_pylist()))
        for key, group in groupby(pairs, itemgetter(0)):
            own, target = f"{root}/{aside}/{uuid.uuid4().hex}", f"{root}/{key}"
            with open(own, "wb") as file, gzip.GzipFile("", "wb", 6, file, 0) as zipped:
                zipped.writelines((v or b"") + b"\n" for _, v in group)
            folder, last = os.path.split(target)
            os.makedirs(folder, exist_ok=True)
            with suppress(FileNotFoundError):
                os.unlink(f"{folder}/.{last}.crc")
            os.replace(own, target)
            keys.append(key)
        yield pa.RecordBatch.from_pydict({"key": pa.array(keys, pa.string())})

    return write


def _move_to_names(to, fs, path: str, aside: str) -> list[str]:
    """Move the one file of each key's folder to the key's name; the keys."""

    def move(folder) -> str:
        (file,) = [f.getPath() for f in fs.listStatus(folder) if f.getPath().getName().startswith("part-")]
        key = unquote(folder.getName().removeprefix("key="))
        target = to(f"{path}/{key}")
        fs.mkdirs(target.getParent())
        fs.delete(target, False)
        if not fs.rename(file, target):
            raise OSError(f"{file} could not be moved to {key}")
        return key

    folders = [f.getPath() for f in fs.listStatus(to(f"{path}/{aside}")) if f.isDirectory()]
    with ThreadPoolExecutor(MOVES) as pool:
        return sorted(pool.map(move, folders))


def written_files(spark: SparkSession, path: str) -> DataFrame:
    """The files under a path, from their listing alone: filename, arrival_ts (when it was written) and length."""
    listed = spark.read.format("binaryFile").option("recursiveFileLookup", "true").option("pathGlobFilter", "part-*").load(path)
    return listed.select(F.col("path").alias("filename"), F.col("modificationTime").alias("arrival_ts"), "length")


def file_pointers(files: DataFrame, name: str = "filename") -> DataFrame:
    """A pointer for each file that rows come from."""
    return files.select(F.col(name).alias("filename")).distinct().select("filename", F.to_json(F.struct("filename")).alias("pointer"))


def parse_file_pointers(pointers: DataFrame, data: str = "pointer") -> DataFrame:
    """File names of pointers. No JSON object with a filename is a parse error; a blank name, an
    object or an array a validation error; a JSON null is the name null."""
    options = {"allowSingleQuotes": "false"}
    read = once(pointers, {"_text": F.from_json(data, "map<string,string>", options), "_kind": F.from_json(data, "map<string,variant>", options)})
    text = F.when(is_container(F.element_at("_kind", "filename")), "").otherwise(F.coalesce(F.element_at("_text", "filename"), F.lit("null")))
    there = F.coalesce(F.map_contains_key("_text", "filename"), F.lit(False))
    outcome = F.when(~there, "parse_error").when(F.trim(text) == "", "validation_error").otherwise("ok")
    return read.withColumns({"outcome": outcome, "filename": F.when(outcome == "ok", F.trim(text))}).drop("_text", "_kind")


def build_manifest(pointers: DataFrame, bucket: str = "", mandatory: bool = True, prefix: str = "manifests") -> DataFrame:
    """Pointers (batch, sequence_number, filename) to one manifest and its path for each batch."""
    files = F.transform(F.sort_array(F.collect_list(F.struct("sequence_number", "filename"))), lambda x: x["filename"])
    entries = F.transform("files", lambda f: F.struct(F.concat(F.lit(bucket), f).alias("url"), F.lit(mandatory).alias("mandatory")))
    last = F.substring_index(F.element_at("files", -1), "/", -1)
    return pointers.groupBy("batch").agg(files.alias("files")).select(
        "batch", F.concat(F.lit(f"{prefix}/"), F.element_at("files", 1), F.lit("-"), last, F.lit(".manifest")).alias("path"), F.to_json(F.struct(entries.alias("entries"))).alias("manifest")
    )


def _exists(spark: SparkSession, url: str) -> bool:
    path = spark.sparkContext._jvm.org.apache.hadoop.fs.Path(url)
    return path.getFileSystem(spark.sparkContext._jsc.hadoopConfiguration()).exists(path)


def manifest_of(files: list[str], mandatory: bool = True) -> str:
    """A manifest of named files, in their order."""
    return json.dumps({"entries": [{"url": f, "mandatory": mandatory} for f in files]})


def write_manifest(spark: SparkSession, manifest: str, path: str) -> None:
    """One manifest as a text of one line, in place of what a try before has left."""
    spark.createDataFrame([(manifest,)], "value string").coalesce(1).write.mode("overwrite").text(path)


def missing_files(spark: SparkSession, files: list[str]) -> list[str]:
    """Of the files of one load, a bounded number, those that are not there."""
    return [f for f in files if not _exists(spark, f)]


def load_from_manifest(spark: SparkSession, manifest: str) -> DataFrame:
    """Lines of exactly the files that a manifest lists, a bounded number; a mandatory one that is
    missing fails the read, another one is passed over."""
    entries = json.loads(manifest)["entries"]
    files = [e["url"] for e in entries if e["mandatory"] or _exists(spark, e["url"])]
    return spark.read.text(files) if files else spark.createDataFrame([], "value string")


def write_month_tables(rows: DataFrame, path: str, mode: str = "append") -> None:
    """Rows to the partition of their month, sorted by time and type in each file; a month that is
    nearly all of a load is split by size."""
    rows.hint("rebalance", "year", "month").sortWithinPartitions("year", "month", "event_timestamp", "event_type").write.mode(mode).partitionBy("year", "month").parquet(path)


def existing_months(spark: SparkSession, path: str, schema: StructType) -> DataFrame:
    """The month tables under a path; no rows where nothing has been written yet."""
    return spark.read.schema(schema).parquet(path) if _exists(spark, path) else spark.createDataFrame([], schema)
