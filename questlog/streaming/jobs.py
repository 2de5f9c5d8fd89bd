"""The same work on streams: each job runs a trigger over what there is, or on and on."""

from __future__ import annotations

import datetime as dt
import time
from collections.abc import Callable

from pyspark.sql import DataFrame, Observation, SparkSession
from pyspark.sql import functions as F
from pyspark.sql.streaming import StreamingQuery

from questlog.config import Limits
from questlog.operators import load, parse
from questlog.sources import archive
from questlog.sources.archive import write_archive
from questlog.sources.ledger import Ledger

#: A date, or what tells the date when a batch is loaded.
Day = dt.date | Callable[[], dt.date]


def today() -> dt.date:
    """The date in UTC."""
    return dt.datetime.now(dt.timezone.utc).date()


def _start(stream: DataFrame, each, checkpoint: str, trigger: str | None, mode: str = "append") -> StreamingQuery:
    writer = stream.writeStream.outputMode(mode).foreachBatch(each).option("checkpointLocation", checkpoint)
    return (writer.trigger(processingTime=trigger) if trigger else writer.trigger(availableNow=True)).start()


def _query_id(spark: SparkSession) -> str:
    """The id of the stream whose batch is run just now; it stays the same as long as its checkpoint."""
    return spark.sparkContext.getLocalProperty("sql.streaming.queryId")


def _now_ms(now_ms: int | None) -> int:
    return int(time.time() * 1000) if now_ms is None else now_ms


def stream_ingest(raw: DataFrame, good_path: str, error_path: str, checkpoint: str, trigger: str | None = None, metrics_path: str | None = None, now_ms: int | None = None) -> StreamingQuery:
    """Classify, split and archive every batch; it is checkpointed after both writes (at least once).

    The batch is parsed once and kept for the two writes; a lost executor parses its part again.
    With metrics_path, records, outcomes, repairs and the lag behind now (or now_ms) are observed
    while the batch is parsed, and written as one row in a folder of the batch, which a batch that
    is run again replaces.
    """

    def each(batch: DataFrame, number: int) -> None:
        seen = Observation(f"ingest-{number}")
        is_ = lambda outcome: F.count_if(F.col("outcome") == outcome)
        done = parse.classify_events(batch).observe(
            seen, F.count(F.lit(1)).alias("records"), is_(parse.OK).alias("ok"), is_(parse.PARSE_ERROR).alias("parse_errors"), is_(parse.VALIDATION_ERROR).alias("validation_errors"),
            F.count_if(F.size("sanitized_fields") > 0).alias("sanitized"), F.max(F.lit(_now_ms(now_ms)) - F.unix_millis("arrival_ts")).alias("millis_behind"),
        ).persist()
        try:
            good, bad = parse.split_good_bad(done)
            write_archive(good.select("arrival_ts", F.col("processed_json").alias("value")), good_path)
            write_archive(parse.error_lines(parse.error_records(bad)), error_path)
            if metrics_path:
                row = {"batch": number} | seen.get
                batch.sparkSession.createDataFrame([tuple(row.values())], ", ".join(f"{c} long" for c in row)).coalesce(1).write.mode("overwrite").parquet(f"{metrics_path}/load={number}")
        finally:
            done.unpersist()

    return _start(raw, each, checkpoint, trigger)


def _load_lines(
    ledger: Ledger, name: str, lines: DataFrame, entry: dict, as_of: Day, months: int, on_error: str, errors_path: str | None, now_ms: int | None,
) -> None:
    """One load, entered in the ledger: lines are parsed once, and what they are is counted as they
    are; the rows that are added are counted as they are written."""

    def rows():
        day = as_of if isinstance(as_of, dt.date) else as_of()
        parsed = load.project_event_row(lines, errors=True).persist()
        try:
            profile = load.batch_profile(parsed, day, months).collect()  # one row a month of the window
            if errors_path:  # in a folder of the load, in place of what a try before has left
                load.split_load_errors(parsed, "quarantine")[1].write.mode("overwrite").parquet(f"{errors_path}/load={name}")
            kept = [r for r in profile if r["year"]]
            total = {c: sum(r[c] for r in profile) for c in ("copied", "load_errors", "out_of_retention")}
            existing = ledger.rows(load.with_month(parsed.drop("type_errors")).schema)
            span = (min(r["first"] for r in kept), max(r["last"] for r in kept)) if kept else None
            fresh = load.dedupe_load(parsed, existing, day, months, on_error, [(r["year"], r["month"]) for r in kept], span, total["copied"])
        except BaseException:
            parsed.unpersist()
            raise
        added = Observation(f"load-{name}")
        observed = lambda df: df.observe(added, F.count(F.lit(1)).alias("inserted"), F.max(F.lit(_now_ms(now_ms)) - F.unix_millis("server_timestamp")).alias("behind"))

        def counts() -> dict:
            parsed.unpersist()
            n = added.get["inserted"]
            repeated = total["copied"] - total["load_errors"] - total["out_of_retention"] - n
            return entry | total | {"inserted": n, "true_duplicates": repeated, "millis_behind": added.get["behind"], "loaded_at": dt.datetime.now(dt.timezone.utc)}

        return fresh, observed, counts

    ledger.run(name, rows)


def _checked(on_error: str, errors_path: str | None) -> None:
    if on_error not in ("fail", "quarantine"):
        raise ValueError(on_error)
    if on_error == "quarantine" and not errors_path:
        raise ValueError("rows that break a rule would be lost: give errors_path, or on_error='fail'")


def stream_load(
    lines: DataFrame, table: str, as_of: Day, checkpoint: str, months: int = 6, trigger: str | None = None, on_error: str = "fail", errors_path: str | None = None,
    now_ms: int | None = None, catalogue: str | None = None,
) -> StreamingQuery:
    """Load archive lines into the month tables batch by batch, against what they hold already.

    as_of, such as today, is asked for the date at every batch, so that the retention window moves
    with the calendar; a date stands still. With catalogue, table is the path of the catalogued
    table of that name, and its months are where the catalogue says (a session that has listed its
    files before is to refresh it). Of the tables only the months and the times that the batch has
    are read, and of those, if the batch is small, only its keys. Rows that break a rule fail the
    batch, or go to errors_path with on_error="quarantine".

    Every batch is one load of the table's ledger, named by stream and batch: run again after a
    failure, it goes on where it stood, and adds its rows, errors and counts once.
    """
    _checked(on_error, errors_path)

    def each(batch: DataFrame, number: int) -> None:
        query = _query_id(batch.sparkSession)
        _load_lines(Ledger(batch.sparkSession, table, catalogue), f"{query}-{number}-0", batch, {"query": query, "batch": number, "part": 0}, as_of, months, on_error, errors_path, now_ms)

    return _start(lines, each, checkpoint, trigger)


def stream_load_pointers(
    pointers: DataFrame, table: str, as_of: Day, checkpoint: str, months: int = 6, trigger: str | None = None, on_error: str = "fail", errors_path: str | None = None,
    data: str = "pointer", bucket: str = "", mandatory: bool = True, limits: Limits = Limits(), now_ms: int | None = None, catalogue: str | None = None,
) -> StreamingQuery:
    """Load the files that a stream of pointers (sequence_number, pointer) names, by manifests.

    Every batch's pointers become manifests of at most limits.load_files files in the order of their
    sequence numbers; each is one load of the ledger. A trigger of ten minutes closes a batch by
    age, as limits.flush_ms asks for. A pointer that cannot be read is counted as bad and passed
    over; a file that an earlier pointer of this batch or of any load of the table has named is
    repeated, and not read again. A file that is missing fails the batch; with mandatory=False it is
    entered as missing, and a later pointer to it may bring it.
    """
    _checked(on_error, errors_path)

    def each(batch: DataFrame, number: int) -> None:
        spark = batch.sparkSession
        query, ledger = _query_id(spark), Ledger(spark, table, catalogue)
        read = archive.parse_file_pointers(batch, data).select("sequence_number", "outcome", F.concat(F.lit(bucket), "filename").alias("filename")).persist()
        try:
            counted = read.agg(F.count("*").alias("pointers"), F.count_if(F.col("outcome") != "ok").alias("bad")).first()
            first = read.where("outcome = 'ok'").groupBy("filename").agg(F.min("sequence_number").alias("sequence_number"))
            own = F.col("query") == query
            loaded = ledger.entries().where(~(own & (F.col("batch") == number))).select(F.explode("files").alias("filename"))
            files = [r["filename"] for r in first.join(loaded, "filename", "left_anti").orderBy("sequence_number", "filename").collect()]  # names of one batch
        finally:
            read.unpersist()
        repeated = counted["pointers"] - counted["bad"] - len(files)
        parts = [files[i : i + limits.load_files] for i in range(0, len(files), limits.load_files)] or [[]]
        for part, named in enumerate(parts):
            name = f"{query}-{number}-{part}"
            if ledger.ended(name):
                continue
            missing = [] if mandatory else archive.missing_files(spark, named)
            there = [f for f in named if f not in set(missing)]
            manifest, path = archive.manifest_of(there, mandatory=True), f"{ledger.table}/_manifests/{name}"
            archive.write_manifest(spark, manifest, path)
            entry = {"query": query, "batch": number, "part": part, "manifest": path, "files": there, "missing": missing}
            entry |= {"pointers": counted["pointers"], "bad_pointers": counted["bad"], "repeated_pointers": repeated} if part == 0 else {"pointers": 0, "bad_pointers": 0, "repeated_pointers": 0}
            _load_lines(ledger, name, archive.load_from_manifest(spark, manifest), entry, as_of, months, on_error, errors_path, now_ms)

    return _start(pointers, each, checkpoint, trigger)


def stream_dedupe(events: DataFrame, keys: list[str], delay: str = "1 hour", time: str = "event_timestamp") -> DataFrame:
    """The first event of each key inside the watermark."""
    return events.withWatermark(time, delay).dropDuplicatesWithinWatermark(keys)


def late_and_future(batch: DataFrame, as_of: dt.date, months: int = 6) -> DataFrame:
    """Counts of what a load takes and refuses: older than the window, inside it, after this month."""
    first, end = load._window(as_of, months)
    place = F.when(F.col("event_timestamp") < first, "too old").when(F.col("event_timestamp") >= end, "future").otherwise("accepted")
    return batch.groupBy(place.alias("place")).agg(F.count("*").alias("events"))


def stream_metrics(events: DataFrame, delay: str = "1 hour", period: str = "1 day", time: str = "arrival_ts") -> DataFrame:
    """Outcomes per shard and tumbling window."""
    return (
        events.withWatermark(time, delay).groupBy(F.window(time, period).alias("w"), "shard_id", "outcome").agg(F.count("*").alias("records"))
        .select(F.col("w.start").alias("window_start"), "shard_id", "outcome", "records")
    )


def stream_metrics_to(counts: DataFrame, path: str, checkpoint: str, trigger: str | None = None) -> StreamingQuery:
    """Write the windows that each batch has changed; latest_metrics reads the last state of each.
    State of windows behind the watermark is dropped."""

    def each(batch: DataFrame, number: int) -> None:
        batch.withColumn("batch", F.lit(number)).write.mode("append").parquet(path)

    return _start(counts, each, checkpoint, trigger, "update")


def latest_metrics(written: DataFrame) -> DataFrame:
    """The last count of each window; a batch that is written twice changes nothing."""
    return written.groupBy("window_start", "shard_id", "outcome").agg(F.max_by("records", "batch").alias("records"))


def stream_lag(batch: DataFrame, now_ms: int) -> DataFrame:
    """Milliseconds that each shard's batch is behind at most."""
    return batch.groupBy("shard_id").agg(F.max(F.lit(now_ms) - F.unix_millis("arrival_ts")).alias("millis_behind"))


def stream_lag_to(raw: DataFrame, path: str, checkpoint: str, trigger: str | None = None, now_ms: int | None = None) -> StreamingQuery:
    """How far each shard of each batch is behind the time at which it is read, or behind now_ms."""

    def each(batch: DataFrame, number: int) -> None:
        now = int(time.time() * 1000) if now_ms is None else now_ms
        stream_lag(batch, now).withColumn("batch", F.lit(number)).write.mode("append").parquet(path)

    return _start(raw, each, checkpoint, trigger)
