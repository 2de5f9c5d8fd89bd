import datetime as dt
import json
from collections import Counter

import pytest
from pyspark.sql import functions as F

from questlog.config import Limits
from questlog.functions.text import hex_decode, hex_encode
from questlog.functions.text import decode_utf8
from questlog.operators import batching, heatmap, lifecycle, load, metrics, parse
from questlog.plans import queries
from questlog.schemas import WIDTHS
from questlog.sources import archive
from questlog.streaming import jobs

GOOD = {"app_name": "SampleGame", "app_version": "1.0.0", "event_version": "1.0", "event_id": "e1", "event_type": "test_event", "event_timestamp": 1508872163135, "client_id": "c1", "level_id": "level_1", "position_x": 556, "position_y": 521}


def classify(spark, *events, **options):
    raw = spark.createDataFrame([("s", str(i), "k", dt.datetime(2024, 1, 1), e if isinstance(e, bytes) else json.dumps(e).encode()) for i, e in enumerate(events)], "shard_id string, sequence_number string, partition_key string, arrival_ts timestamp, data binary")
    return sorted(parse.classify_events(raw, **options).collect(), key=lambda r: int(r["sequence_number"]))


def test_required_and_optional_fields(spark):
    required = ["event_version", "app_name", "client_id", "event_timestamp", "event_type", "event_id"]
    optional = ["app_version", "level_id", "position_x", "position_y"]
    got = classify(spark, GOOD, *[{k: v for k, v in GOOD.items() if k != m} for m in required + optional])
    assert [r["outcome"] for r in got] == ["ok"] + ["validation_error"] * 6 + ["ok"] * 4
    assert got[0]["event_timestamp"] == 1508872163135 and got[0]["position_x"] == 556.0
    assert got[-1]["position_y"] == 0.0 and "position_y" not in json.loads(got[-1]["processed_json"])


def test_character_set(spark):
    bad = [("app_name", 'a"b'), ("app_version", "1.0.0!@#"), ("app_version", "; DROP TABLE x;"), ("event_id", "a:b"), ("event_type", "test@event"), ("client_id", "a#"), ("level_id", "'x'"), ("app_name", "a\n")]
    got = classify(spark, *[GOOD | {k: v} for k, v in bad], GOOD | {"app_name": "Sample Game"}, GOOD | {"app_name": "a[`"})
    assert [r["outcome"] for r in got] == ["validation_error"] * len(bad) + ["ok", "ok"]
    assert classify(spark, GOOD | {"app_name": "a[`"}, strict=True)[0]["outcome"] == "validation_error"


def test_repairs(spark):
    long = GOOD | {k: "x" * (n + 3) for k, n in WIDTHS.items()} | {"event_timestamp": -100, "position_x": "asdf", "position_y": "asdf"}
    r = classify(spark, long)[0]
    assert r["outcome"] == "ok" and set(r["sanitized_fields"]) == set(GOOD)
    line = json.loads(r["processed_json"])
    assert line["event_timestamp"] == 0 and line["position_x"] == 0.0 and len(line["app_name"]) == 64
    assert line["server_timestamp"] == 1704067200000 and r["processed_json"].endswith("\n")


def test_odd_documents(spark):
    got = classify(spark, b"", b"{", b"[1]", b"3", b"\xff\xfe", json.dumps(GOOD).encode() + b" trailing", GOOD | {"app_name": None}, GOOD | {"app_name": {"a": 1}}, GOOD | {"event_timestamp": 1.5}, GOOD | {"event_timestamp": 2**63}, GOOD | {"extra": {"n": [1]}})
    assert [r["outcome"] for r in got] == ["parse_error", "parse_error", "validation_error", "validation_error", "parse_error"] + ["ok"] * 6
    assert got[6]["app_name"] == "null" and got[7]["app_name"] == ""
    assert [r["event_timestamp"] for r in got[8:10]] == [0, 0]
    assert json.loads(got[10]["processed_json"])["extra"] == {"n": [1]}


def test_errors_split(spark):
    raw = spark.createDataFrame([("s", "1", "k", dt.datetime(2024, 1, 1), b"{"), ("s", "2", "k", dt.datetime(2024, 1, 1), json.dumps(GOOD | {"event_timestamp": -1}).encode())], "shard_id string, sequence_number string, partition_key string, arrival_ts timestamp, data binary")
    good, bad = parse.split_good_bad(parse.classify_events(raw))
    assert good.count() == 1 and bad.count() == 2
    lines = sorted(json.loads(r["value"])["reason"] for r in parse.error_lines(parse.error_records(bad)).collect())
    assert lines == ["SanitizationException", "TelemetryEventParseException"]


def test_hex(spark):
    rows = spark.createDataFrame([("54321", "543210"), ("a", "a0"), ("", ""), (None, ""), ("DEADbeef", "deadbeef")], "h string, want string")
    assert all(r["got"] == r["want"] for r in rows.select("want", hex_encode(hex_decode(F.col("h"))).alias("got")).collect())


def test_load_is_idempotent(spark):
    lines = spark.createDataFrame([(json.dumps(GOOD | {"event_id": f"e{i}", "event_timestamp": 1704067200000 + i, "server_timestamp": 1704067200000}),) for i in (1, 2, 2, 3)], "value string")
    rows = load.project_event_row(lines)
    first = load.dedupe_load(rows, load.with_month(rows).limit(0), dt.date(2024, 1, 31))
    assert first.count() == 3
    assert load.dedupe_load(rows, first, dt.date(2024, 1, 31)).count() == 0
    assert load.dedupe_load(rows, first.limit(0), dt.date(2024, 9, 1)).count() == 0


def test_wrong_rows_fail_or_are_kept_apart(spark):
    rows = load.project_event_row(spark.createDataFrame([(json.dumps(GOOD | {"event_id": " ", "server_timestamp": 1}),)], "value string"))
    good, bad = load.split_load_errors(rows, "quarantine")
    assert good.count() == 0 and bad.first()["errors"] == ["event_id is null"]
    with pytest.raises(Exception, match="event_id is null"):
        load.split_load_errors(rows)[0].collect()


def test_flush_limits(spark):
    at = dt.datetime(2024, 1, 1)
    raw = spark.createDataFrame([("s", f"{i:03d}", "k", at + dt.timedelta(seconds=i), b"x" * 10) for i in range(20)], "shard_id string, sequence_number string, partition_key string, arrival_ts timestamp, data binary")
    by = lambda **k: [r["records"] for r in batching.batch_summary(batching.flush_batches(raw, Limits(**k))).orderBy("batch").collect()]
    assert by(flush_records=7) == [7, 7, 6]
    assert by(flush_bytes=35) == [4, 4, 4, 4, 4]
    assert by(flush_ms=4000) == [5, 5, 5, 5]


def test_replay_of_malformed_and_repeated_lines(spark, tmp_path):
    ids = [1, 2, 47, 53, 97, 47 * 53]
    at = dt.datetime(2024, 1, 5)
    spark.createDataFrame([(i, at, 7, "login") for i in ids], "event_id long, ts timestamp, user_id long, event_type string").write.parquet(f"{tmp_path}/events.parquet")
    got = Counter(tuple(r) for r in queries.QUERIES["replay_jsonl"](spark, str(tmp_path)).collect())
    now = 1_700_000_000_000
    assert got == {("e-1", now): 1, ("e-2", now): 1, ("e-47", now): 2, ("e-53", now): 2, (f"e-{47 * 53}", now): 3, (None, None): 1}


def test_hex_of_every_document(spark, tmp_path):
    rows = [(1, "kurz", 4), (2, "länger " * 1000, 7000), (3, "no count", None), (4, "", 0), (5, None, None)]
    spark.createDataFrame(rows, "doc_id long, text string, n_chars long").write.parquet(f"{tmp_path}/documents.parquet")
    got = {r["doc_id"]: r["hex"] for r in queries.QUERIES["hex_encode_text"](spark, str(tmp_path)).collect()}
    assert got == {i: (t or "").encode().hex() for i, t, _ in rows}


def test_blank_looks_at_the_whole_text(spark, tmp_path):
    rows = [(1, " text after a space"), (2, "text"), (3, "   "), (4, ""), (5, None), (6, " " * 5000 + "x")]
    spark.createDataFrame(rows, "doc_id long, text string").write.parquet(f"{tmp_path}/documents.parquet")
    got = {r["doc_id"]: r["filled"] for r in queries.QUERIES["blank_as_null"](spark, str(tmp_path)).collect()}
    assert got == {i: bool((t or "").strip(" ")) for i, t in rows}


AT = dt.datetime(2024, 1, 1)
RAW = "shard_id string, sequence_number string, partition_key string, arrival_ts timestamp, data binary"


def lines_of(spark, *events):
    return spark.createDataFrame([(json.dumps(GOOD | {"server_timestamp": 1704067200000, "event_timestamp": 1704067200000} | e),) for e in events], "value string")


def test_reasons_of_errors(spark):
    events = [b"{", json.dumps(GOOD | {"event_type": "a@b"}).encode(), json.dumps(GOOD | {"event_timestamp": -1}).encode(), b"[1]"]
    raw = spark.createDataFrame([("s", str(i), "k", AT, e) for i, e in enumerate(events)], RAW)
    bad = parse.error_records(parse.split_good_bad(parse.classify_events(raw))[1])
    got = {r["sequence_number"]: (r["reason"], r["hex"] is None, r["fields"]) for r in bad.collect()}
    assert got == {
        "0": ("TelemetryEventParseException", False, None), "1": ("TelemetryEventValidationException", False, None),
        "2": ("SanitizationException", True, ["event_timestamp"]), "3": ("TelemetryEventValidationException", False, None),
    }


def test_bytes_to_text(spark):
    cases = {"k3fj09sdkf2lkj": "k3fj09sdkf2lkj".encode(), "grün €": "grün €".encode(), "a\ufffdb": b"a\xffb", "\ufffd": b"\xe2\x82", "": b""}
    rows = spark.createDataFrame([(w, bytearray(d)) for w, d in cases.items()], "want string, data binary")
    assert all(r["want"] == r["got"] for r in rows.select("want", decode_utf8(F.col("data")).alias("got")).collect())


def test_wrong_types_are_load_errors(spark):
    rows = load.project_event_row(lines_of(spark, {}, {"position_x": "asdf"}, {"server_timestamp": "1e3"}, {"position_y": None}), errors=True)
    got = sorted(tuple(r["errors"]) for r in load.split_load_errors(rows, "quarantine")[1].collect())
    assert got == [("position_x is no double",), ("server_timestamp is no bigint", "server_timestamp is null")]
    good, _ = load.split_load_errors(rows, "quarantine")
    assert good.count() == 2 and "type_errors" not in good.columns
    history = load.with_month(good).limit(0)
    # of several wrong rows any may be the first that is read
    with pytest.raises(Exception, match="load error: (position_x is no double|server_timestamp is no bigint, server_timestamp is null)"):
        load.dedupe_load(rows, history, dt.date(2024, 1, 31)).collect()
    one = load.project_event_row(lines_of(spark, {}, {"position_x": "asdf"}), errors=True)
    with pytest.raises(Exception, match="load error: position_x is no double"):
        load.dedupe_load(one, history, dt.date(2024, 1, 31)).collect()


def test_rows_without_a_key_are_never_loaded(spark, tmp_path):
    rows = load.project_event_row(lines_of(spark, {}, {"event_id": " "}, {"event_id": None}), errors=True)
    path = f"{tmp_path}/t"
    first = load.dedupe_load(rows, archive.existing_months(spark, path, load.with_month(rows.drop("type_errors")).schema), dt.date(2024, 1, 31), on_error="quarantine")
    archive.write_month_tables(first, path)
    assert spark.read.parquet(path).count() == 1
    assert load.dedupe_load(rows, spark.read.parquet(path), dt.date(2024, 1, 31), on_error="quarantine").count() == 0


def test_history_is_pruned_to_the_months_of_the_batch(spark, tmp_path):
    rows = load.project_event_row(lines_of(spark, *[{"event_id": f"e{m}", "event_timestamp": 1704067200000 - m * 31 * 86_400_000} for m in range(5)]))
    archive.write_month_tables(load.with_month(rows), f"{tmp_path}/t")
    there = load.prune_history(spark.read.parquet(f"{tmp_path}/t"), dt.date(2024, 1, 31), 6, [(2024, 1), (2023, 12)])
    assert there.count() == 2
    plan = there._jdf.queryExecution().executedPlan().toString()
    scan = plan[plan.index("PartitionFilters") :].split("PushedFilters")[0]
    assert "year" in scan and "month" in scan
    assert sum(r["files"] for r in lifecycle.list_month_partitions(spark, f"{tmp_path}/t").collect()) >= 5
    assert len(there.inputFiles()) >= 2


def test_load_audit_counts_in_one_pass(spark):
    rows = load.project_event_row(lines_of(spark, {"event_id": "a"}, {"event_id": "a"}, {"event_id": "b"}, {"event_id": "c", "event_timestamp": 0}, {"event_id": None}), errors=True)
    existing = load.with_month(load.project_event_row(lines_of(spark, {"event_id": "b"}, {"event_id": "b", "level_id": "x"})))
    got = load.load_audit(rows, existing, dt.date(2024, 1, 31), files=3).first().asDict()
    assert got == {"copied": 5, "inserted": 1, "duplicates_ignored": 4, "out_of_retention": 1, "true_duplicates": 2, "load_errors": 1, "months": 2, "files": 3}


def test_archive_to_rows_by_manifest(spark, tmp_path):
    lines = lines_of(spark, *[{"event_id": f"e{i}"} for i in range(20)]).withColumn("arrival_ts", F.timestamp_seconds(F.length("value") % 3 * 3600 + 1704067200))
    archive.write_archive(lines, f"{tmp_path}/a")
    files = archive.file_pointers(archive.written_files(spark, f"{tmp_path}/a"))
    names = archive.parse_file_pointers(files)
    assert {r["outcome"] for r in names.collect()} == {"ok"}
    manifest = archive.build_manifest(names.select(F.lit(1).alias("batch"), F.col("filename").alias("sequence_number"), "filename")).first()["manifest"]
    assert load.project_event_row(archive.load_from_manifest(spark, manifest)).count() == 20
    entries = json.loads(manifest)["entries"]
    missing = {"url": f"{tmp_path}/a/none.gz", "mandatory": False}
    assert archive.load_from_manifest(spark, json.dumps({"entries": [*entries, missing]})).count() == 20
    assert archive.load_from_manifest(spark, json.dumps({"entries": [missing]})).count() == 0
    with pytest.raises(Exception, match="PATH_NOT_FOUND"):
        archive.load_from_manifest(spark, json.dumps({"entries": [missing | {"mandatory": True}]})).count()


def test_pointers(spark):
    cases = {'{"filename":"a/b.gz"}': ("ok", "a/b.gz"), '{"filename":null}': ("ok", "null"), '{"filename":{}}': ("validation_error", None), '{"filename":[1]}': ("validation_error", None), '{"filename":" "}': ("validation_error", None), '{"x":1}': ("parse_error", None), "[": ("parse_error", None), '{"filename":5}': ("ok", "5")}
    rows = spark.createDataFrame([(k,) for k in cases], "pointer string")
    assert {r["pointer"]: (r["outcome"], r["filename"]) for r in archive.parse_file_pointers(rows).collect()} == cases


def test_month_tables_roll_and_compact(spark, tmp_path):
    rows = load.with_month(load.project_event_row(lines_of(spark, *[{"event_id": f"e{m}-{i}", "event_timestamp": 1704067200000 - m * 31 * 86_400_000 - i} for m in range(9) for i in range(3)])))
    rows.write.partitionBy("year", "month").option("path", f"{tmp_path}/t").saveAsTable("roll_t")
    done = lifecycle.roll_month_tables(spark, "roll_t", dt.date(2024, 1, 15))
    assert (2024, 2) in done["made"] and all(y * 12 + m <= 2023 * 12 + 7 for y, m in done["dropped"])
    assert {(r["year"], r["month"]) for r in spark.table("roll_t").select("year", "month").distinct().collect()} == {(r["year"], r["month"]) for r in rows.where("event_timestamp >= '2023-08-01'").select("year", "month").distinct().collect()}
    aside = lifecycle.compact_month(spark, f"{tmp_path}/t", 2023, 12)
    assert lifecycle.list_month_partitions(spark, aside).first()["files"] == 1
    assert spark.read.parquet(aside).count() == rows.where("year = 2023 and month = 12").count()
    spark.sql("DROP TABLE roll_t")


def test_streams(spark, tmp_path):
    raw = spark.createDataFrame([("s", f"{i:03d}", f"k{i % 4}", AT + dt.timedelta(hours=i), json.dumps(GOOD | ({"event_type": "@"} if i % 5 == 0 else {})).encode()) for i in range(30)], RAW)
    for k in range(3):
        raw.where(f"cast(sequence_number as int) % 3 = {k}").coalesce(1).write.mode("append").parquet(f"{tmp_path}/raw")
    stream = archive.read_raw_stream(spark, f"{tmp_path}/raw", max_per_trigger=1)
    jobs.stream_metrics_to(jobs.stream_metrics(parse.classify_events(stream), "10 days"), f"{tmp_path}/m", f"{tmp_path}/mc").awaitTermination()
    got = jobs.latest_metrics(spark.read.parquet(f"{tmp_path}/m"))
    assert {(r["outcome"], r["n"]) for r in got.groupBy("outcome").agg(F.sum("records").alias("n")).collect()} == {("ok", 24), ("validation_error", 6)}
    jobs.stream_lag_to(stream, f"{tmp_path}/l", f"{tmp_path}/lc", now_ms=int(AT.timestamp() * 1000)).awaitTermination()
    assert spark.read.parquet(f"{tmp_path}/l").select("batch").distinct().count() == 3
    jobs.stream_ingest(stream, f"{tmp_path}/good", f"{tmp_path}/bad", f"{tmp_path}/ic").awaitTermination()
    assert spark.read.text(f"{tmp_path}/good").count() == 24 and spark.read.text(f"{tmp_path}/bad").count() == 6


def test_stream_load_in_batches(spark, tmp_path):
    for part in ([{"event_id": "a"}, {"event_id": "b"}], [{"event_id": "b"}, {"event_id": "c"}, {"event_id": "d", "event_timestamp": 1}], [{"event_id": "e", "position_x": "wide"}]):
        lines_of(spark, *part).coalesce(1).write.mode("append").text(f"{tmp_path}/lines")
    stream = spark.readStream.schema("value string").option("maxFilesPerTrigger", 1).text(f"{tmp_path}/lines")
    jobs.stream_load(stream, f"{tmp_path}/t", dt.date(2024, 1, 31), f"{tmp_path}/c", on_error="quarantine", errors_path=f"{tmp_path}/e").awaitTermination()
    assert sorted(r["event_id"] for r in spark.read.parquet(f"{tmp_path}/t").collect()) == ["a", "b", "c"]
    assert [r["event_id"] for r in spark.read.parquet(f"{tmp_path}/e").collect()] == ["e"]


def test_heat_map_and_statistics(spark):
    rows = spark.createDataFrame([("l", "click", 300.25, 550.5), ("l", "click", 300.75, 550.0), ("l", "other", 1.0, 1.0), ("l", "click", None, 2.0)], "level_id string, event_type string, position_x double, position_y double")
    bins = {(r["bin_x"], r["bin_y"]): r["events"] for r in heatmap.heatmap_bins(rows, "l", "click").collect()}
    assert bins == {(300, 550): 2, (None, 2): 1}
    points = spark.createDataFrame([("g", "m", "d", float(v), AT + dt.timedelta(hours=v)) for v in range(30)], "namespace string, name string, dimensions string, value double, ts timestamp")
    got = metrics.metric_statistics(points, "1 day", "2024-01-01", "2024-01-03").orderBy("window_start").collect()
    assert [(r["minimum"], r["maximum"], r["sample_count"]) for r in got] == [(0.0, 23.0, 24), (24.0, 29.0, 6)]
