"""Loads: times out of range, audits, the ledger, moving windows, pointers, and the life of month tables."""

import datetime as dt
import gzip
import json
import re

import pytest
from pyspark.sql import functions as F

from questlog.config import Limits
from questlog.operators import lifecycle, load
from questlog.plans import queries
from questlog.sources import archive, ledger
from questlog.streaming import jobs

JAN = 1704067200000  # 2024-01-01
DAY = dt.date(2024, 1, 31)
EVENT = {"app_name": "SampleGame", "app_version": "1.0.0", "event_version": "1.0", "event_type": "move", "event_timestamp": JAN, "server_timestamp": JAN, "client_id": "c1", "level_id": "l", "position_x": 1.5, "position_y": 2}


def lines(spark, *events):
    return spark.createDataFrame([(json.dumps(EVENT | e),) for e in events], "value string")


def rows(spark, *events):
    return load.project_event_row(lines(spark, *events), errors=True)


def plan(df):
    return df._jdf.queryExecution().executedPlan().toString()


def shuffles(df):
    """Exchanges that deal rows out; the one of sums by month is not counted."""
    return len(re.findall(r"Exchange hashpartitioning\((?!m#)", plan(df).split("== Initial Plan ==")[-1]))


def test_times_that_no_timestamp_holds(spark):
    far = [10**17, 2**63 - 1, -(2**63), load.MOST_MS + 1]
    got = rows(spark, {"event_id": "a"}, *[{"event_id": str(t), "event_timestamp": t} for t in far], {"event_id": "s", "server_timestamp": 10**17}, {"event_id": "m", "event_timestamp": load.MOST_MS})
    good, bad = load.split_load_errors(got, "quarantine")
    assert {r["event_id"]: r["errors"] for r in bad.select("event_id", "errors").collect()} == {str(t): ["event_timestamp is out of range", "event_timestamp is null"] for t in far} | {"s": ["server_timestamp is out of range", "server_timestamp is null"]}
    assert {r["event_id"] for r in good.select("event_id").collect()} == {"a", "m"}
    empty = load.with_month(good).limit(0)
    assert [r["event_id"] for r in load.dedupe_load(got, empty, DAY, on_error="quarantine").collect()] == ["a"]
    with pytest.raises(Exception, match="out of range"):
        load.dedupe_load(got, empty, DAY).collect()
    assert load.project_event_row(lines(spark, {"event_id": "x", "event_timestamp": 10**17})).first()["event_timestamp"] is None


def test_audit_tells_errors_from_duplicates(spark):
    none = load.with_month(rows(spark).drop("type_errors"))
    got = load.load_audit(rows(spark, {"event_id": "a"}, {"event_id": "b", "position_x": "wide"}), none, DAY).first().asDict()
    assert got == {"copied": 2, "inserted": 1, "duplicates_ignored": 1, "out_of_retention": 0, "true_duplicates": 0, "load_errors": 1, "months": 1}
    # what breaks a rule counts as that alone, even outside the window or twice
    bad = {"event_id": "c", "position_x": "wide", "event_timestamp": 0}
    got = load.load_audit(rows(spark, bad, bad, {"event_id": "a"}, {"event_id": "a"}, {"event_id": "d", "event_timestamp": 5}), none, DAY).first().asDict()
    assert (got["load_errors"], got["true_duplicates"], got["out_of_retention"], got["inserted"]) == (2, 1, 1, 1)
    empty = load.load_audit(rows(spark), none, DAY).first().asDict()
    assert set(empty.values()) == {0}


def test_audit_spreads_rows_and_history_once(spark, tmp_path):
    archive.write_month_tables(load.with_month(rows(spark, {"event_id": "b"}).drop("type_errors")), f"{tmp_path}/t")
    spark.conf.set("spark.sql.autoBroadcastJoinThreshold", "-1")
    try:
        audit = load.load_audit(rows(spark, {"event_id": "a"}), spark.read.parquet(f"{tmp_path}/t"), DAY)
        assert shuffles(audit) == 2
    finally:
        spark.conf.unset("spark.sql.autoBroadcastJoinThreshold")


def test_small_batches_cut_history_by_their_keys(spark, tmp_path, monkeypatch):
    archive.write_month_tables(load.with_month(rows(spark, *[{"event_id": f"e{i}", "event_timestamp": JAN + i} for i in range(50)]).drop("type_errors")), f"{tmp_path}/t")
    table, batch = spark.read.parquet(f"{tmp_path}/t"), rows(spark, {"event_id": "e7", "event_timestamp": JAN + 7}, {"event_id": "new", "event_timestamp": JAN + 9})
    span = ((JAN + 7) * 1000, (JAN + 9) * 1000)
    for n, joins in ((2, True), (load.FEW_KEYS + 1, False), (None, False)):
        fresh = load.dedupe_load(batch, table, DAY, batch_months=[(2024, 1)], span=span, batch_rows=n)
        assert [r["event_id"] for r in fresh.collect()] == ["new"]
        assert ("LeftSemi" in plan(fresh)) == joins
        assert re.search(r"PushedFilters: .*GreaterThanOrEqual\(event_timestamp", plan(fresh))


def test_rows_of_a_month_file_are_sorted(spark, tmp_path):
    made = rows(spark, *[{"event_id": f"e{i}", "event_timestamp": JAN + i * 7919 % 1000, "event_type": f"t{i % 3}"} for i in range(300)])
    archive.write_month_tables(load.sorted_insert(load.with_month(made.drop("type_errors"))), f"{tmp_path}/t")
    files = spark.read.parquet(f"{tmp_path}/t").select(F.input_file_name().alias("f"), F.unix_millis("event_timestamp").alias("t"), "event_type").collect()
    for name in {r["f"] for r in files}:
        own = [(r["t"], r["event_type"]) for r in files if r["f"] == name]
        assert own == sorted(own)
    pieces = load.sorted_insert(made.repartition(4)).select(F.spark_partition_id().alias("p"), F.unix_millis("event_timestamp").alias("t"), "event_type").collect()
    for p in range(4):
        own = [(r["t"], r["event_type"]) for r in pieces if r["p"] == p]
        assert own and own == sorted(own)


def put(spark, path, *events):
    lines(spark, *events).coalesce(1).write.mode("append").text(path)


def run(spark, path, table, state, **options):
    stream = spark.readStream.schema("value string").option("maxFilesPerTrigger", 1).text(path)
    options = {"as_of": DAY, "on_error": "quarantine", "errors_path": f"{table}-errors"} | options
    return jobs.stream_load(stream, table, checkpoint=state, **options).awaitTermination()


def total(spark, table):
    got = ledger.Ledger(spark, table).entries().agg(*[F.sum(c).alias(c) for c in ("copied", "inserted", "load_errors", "out_of_retention", "true_duplicates")]).first().asDict()
    return {k: v or 0 for k, v in got.items()}


@pytest.mark.parametrize("step", ["stage_entry", "publish", "_move", "enter"])
def test_a_load_that_fails_is_taken_up_where_it_stood(spark, tmp_path, monkeypatch, step):
    path, table, state = f"{tmp_path}/lines", f"{tmp_path}/t", f"{tmp_path}/c"
    put(spark, path, {"event_id": "a"}, {"event_id": "a"}, {"event_id": "b", "event_timestamp": JAN - 40 * 86_400_000}, {"event_id": "x", "position_x": "wide"}, {"event_id": "old", "event_timestamp": 5})
    kept, calls = getattr(ledger.Ledger, step), []

    def fails(self, *args):
        calls.append(args)
        if len(calls) == 1 + (step == "_move"):  # one file of two has been moved
            raise OSError("lost")
        return kept(self, *args)

    monkeypatch.setattr(ledger.Ledger, step, fails)
    with pytest.raises(Exception, match="lost"):
        run(spark, path, table, state)
    assert ledger.Ledger(spark, table).entries().count() == 0
    run(spark, path, table, state)
    assert sorted(r["event_id"] for r in spark.read.parquet(table).select("event_id").collect()) == ["a", "b"]
    assert [r["event_id"] for r in spark.read.parquet(f"{table}-errors").select("event_id").collect()] == ["x"]
    assert total(spark, table) == {"copied": 5, "inserted": 2, "load_errors": 1, "out_of_retention": 1, "true_duplicates": 1}
    run(spark, path, table, state)  # nothing new
    put(spark, path, {"event_id": "a"}, {"event_id": "c"})
    run(spark, path, table, state)
    assert total(spark, table)["inserted"] == 3 and spark.read.parquet(table).count() == 3
    assert not [p for p in tmp_path.glob("t/_staged/*")]


def test_a_batch_that_ended_is_not_loaded_again(spark, tmp_path):
    """The checkpoint has lost the batch's commit; the ledger has it."""
    path, table, state = f"{tmp_path}/lines", f"{tmp_path}/t", f"{tmp_path}/c"
    put(spark, path, {"event_id": "a"}, {"event_id": "x", "position_x": "wide"})
    run(spark, path, table, state)
    for f in (tmp_path / "c" / "commits").glob("*0*"):
        f.unlink()
    run(spark, path, table, state)
    assert total(spark, table) == {"copied": 2, "inserted": 1, "load_errors": 1, "out_of_retention": 0, "true_duplicates": 0}
    assert spark.read.parquet(f"{table}-errors").count() == 1


def test_the_window_moves_with_the_calendar(spark, tmp_path):
    path, table = f"{tmp_path}/lines", f"{tmp_path}/t"
    february = JAN + 31 * 86_400_000
    put(spark, path, {"event_id": "jan"}, {"event_id": "feb", "event_timestamp": february}, {"event_id": "jul", "event_timestamp": JAN - 170 * 86_400_000})
    put(spark, path, {"event_id": "jan2"}, {"event_id": "feb2", "event_timestamp": february}, {"event_id": "jul2", "event_timestamp": JAN - 170 * 86_400_000})
    days = iter([dt.date(2024, 1, 31), dt.date(2024, 2, 1)])
    run(spark, path, table, f"{tmp_path}/c", as_of=lambda: next(days))
    got = {re.sub(r"\d", "", r["event_id"]): r["event_id"] for r in spark.read.parquet(table).select("event_id").collect()}
    ids = {r["event_id"] for r in spark.read.parquet(table).select("event_id").collect()}
    assert len(ids) == 4 and set(got) == {"jan", "feb", "jul"}
    by_batch = {r["batch"]: r["out_of_retention"] for r in ledger.Ledger(spark, table).entries().collect()}
    assert by_batch == {0: 1, 1: 1}  # February before its first day, July after its window
    assert jobs.today() == dt.datetime.now(dt.timezone.utc).date()


def test_errors_are_never_dropped_silently(spark):
    with pytest.raises(ValueError, match="errors_path"):
        jobs.stream_load(None, "t", DAY, "c", on_error="quarantine")
    with pytest.raises(ValueError, match="errors_path"):
        jobs.stream_load_pointers(None, "t", DAY, "c", on_error="quarantine")
    with pytest.raises(ValueError):
        jobs.stream_load(None, "t", DAY, "c", on_error="ignore")


def test_a_batch_of_errors_alone(spark, tmp_path):
    put(spark, f"{tmp_path}/lines", {"event_id": "x", "position_x": "wide"})
    run(spark, f"{tmp_path}/lines", f"{tmp_path}/t", f"{tmp_path}/c", now_ms=JAN)
    put(spark, f"{tmp_path}/lines", {"event_id": "a"})
    run(spark, f"{tmp_path}/lines", f"{tmp_path}/t", f"{tmp_path}/c", now_ms=JAN + 5)
    got = {r["batch"]: (r["inserted"], r["load_errors"], r["millis_behind"]) for r in ledger.Ledger(spark, f"{tmp_path}/t").entries().collect()}
    assert got == {0: (0, 1, None), 1: (1, 0, 5)}


def test_a_large_batch_that_adds_nothing(spark, tmp_path, monkeypatch):
    """It is of more rows than FEW_KEYS and too large for a broadcast; no row of it is left, and the load ends."""
    monkeypatch.setattr(load, "FEW_KEYS", 0)
    spark.conf.set("spark.sql.autoBroadcastJoinThreshold", "-1")
    batches = [{"event_id": "a"}, {"event_id": "b"}, {"event_id": "b"}], [{"event_id": "a"}, {"event_id": "b"}], [{"event_id": "old", "event_timestamp": 5}]
    try:
        for i, batch in enumerate(batches):
            put(spark, f"{tmp_path}/lines", *batch)
            run(spark, f"{tmp_path}/lines", f"{tmp_path}/t", f"{tmp_path}/c", now_ms=JAN + i)
    finally:
        spark.conf.unset("spark.sql.autoBroadcastJoinThreshold")
    got = {r["batch"]: (r["copied"], r["inserted"], r["true_duplicates"], r["millis_behind"]) for r in ledger.Ledger(spark, f"{tmp_path}/t").entries().collect()}
    assert got == {0: (3, 2, 1, 0), 1: (2, 0, 2, None), 2: (1, 0, 0, None)}
    assert sorted(r["event_id"] for r in spark.read.parquet(f"{tmp_path}/t").select("event_id").collect()) == ["a", "b"]


def test_streamed_loads_without_broadcasts_against_sql(spark, monkeypatch):
    """The second run of the query adds nothing; so planned as tables are that are too large for a broadcast."""
    duckdb = pytest.importorskip("duckdb")
    monkeypatch.setattr(load, "FEW_KEYS", 0)
    spark.conf.set("spark.sql.autoBroadcastJoinThreshold", "-1")
    d = "/root/testdata/sf0.001"
    con = duckdb.connect()
    con.execute("SET TimeZone = 'UTC'")
    con.execute(f"CREATE VIEW events AS SELECT * FROM '{d}/events.parquet'")
    try:
        got = queries.QUERIES["stream_load"](spark, d)
        want = con.sql(f"SELECT {', '.join(got.columns)} FROM ({queries.ORACLE_SQL['stream_load']})").fetchall()
        assert sorted(map(repr, map(tuple, got.collect()))) == sorted(map(repr, want))
    finally:
        spark.conf.unset("spark.sql.autoBroadcastJoinThreshold")


def test_rows_of_a_staged_file_are_sorted(spark, tmp_path):
    """They are counted on the way, behind the exchange, and their order in a file stays."""
    put(spark, f"{tmp_path}/lines", *[{"event_id": f"e{i}", "event_timestamp": JAN + i * 7919 % 1000, "event_type": f"t{i % 3}"} for i in range(300)])
    run(spark, f"{tmp_path}/lines", f"{tmp_path}/t", f"{tmp_path}/c")
    files = spark.read.parquet(f"{tmp_path}/t").select(F.input_file_name().alias("f"), F.unix_millis("event_timestamp").alias("t"), "event_type").collect()
    assert len(files) == 300
    for name in {r["f"] for r in files}:
        own = [(r["t"], r["event_type"]) for r in files if r["f"] == name]
        assert own == sorted(own)


def test_pointers_become_manifests(spark, tmp_path):
    path, table, folder = f"{tmp_path}/lines", f"{tmp_path}/t", f"{tmp_path}/p"
    lines(spark, *[{"event_id": f"e{i}"} for i in range(40)]).repartition(7).write.text(path)
    files = sorted(r["filename"] for r in archive.written_files(spark, path).collect())
    gone = f"{path}/part-late.txt"

    def point(*named):
        made = [(f"{i:03d}", n if n.startswith(("{", "[")) else json.dumps({"filename": n})) for i, n in enumerate(named)]
        spark.createDataFrame(made, "sequence_number string, pointer string").coalesce(1).write.mode("append").parquet(folder)

    def go(**options):
        stream = spark.readStream.schema("sequence_number string, pointer string").option("maxFilesPerTrigger", 1).parquet(folder)
        options = {"on_error": "quarantine", "errors_path": f"{tmp_path}/e", "mandatory": False, "limits": Limits(load_files=3)} | options
        jobs.stream_load_pointers(stream, table, DAY, f"{tmp_path}/c", **options).awaitTermination()

    point(*files[:5], "[", '{"filename":" "}', files[0], gone)
    point(*files[3:], files[6])
    go()
    assert spark.read.parquet(table).count() == 40
    parts = [(r["batch"], r["part"], len(r["files"]), len(r["missing"]), r["pointers"], r["bad_pointers"], r["repeated_pointers"]) for r in ledger.Ledger(spark, table).entries().orderBy("batch", "part").collect()]
    # the order of the two files of pointers is the stream's
    assert sorted(p[:2] for p in parts) == sorted({p[:2] for p in parts}) and all(p[2] + p[3] <= 3 for p in parts)
    assert sum(p[2] for p in parts) == 7 and sum(p[3] for p in parts) == 1
    assert [sum(p[i] for p in parts) for i in (4, 5, 6)] == [14, 2, 4]
    for r in ledger.Ledger(spark, table).entries().collect():
        listed = json.loads(spark.read.text(r["manifest"]).first()["value"])["entries"]
        assert [e["url"] for e in listed] == r["files"] and all(e["mandatory"] for e in listed)
    # the missing file comes, and a later pointer brings it
    lines(spark, {"event_id": "late"}).coalesce(1).write.text(f"{tmp_path}/more")
    next((tmp_path / "more").glob("part-*")).rename(gone)
    point(gone)
    go()
    assert spark.read.parquet(table).count() == 41
    # one that must be there fails its batch, until it is there
    point(f"{path}/part-must.txt")
    with pytest.raises(Exception, match="PATH_NOT_FOUND"):
        go(mandatory=True)
    lines(spark, {"event_id": "must"}).coalesce(1).write.text(f"{tmp_path}/must")
    next((tmp_path / "must").glob("part-*")).rename(f"{path}/part-must.txt")
    go(mandatory=True)
    assert spark.read.parquet(table).count() == 42


def test_ingest_is_observed(spark, tmp_path):
    at = dt.datetime(2024, 1, 1)
    events = [json.dumps(EVENT | {"event_id": "a"}), json.dumps(EVENT | {"event_id": "b", "event_timestamp": -1}), "{", json.dumps(EVENT)]
    raw = spark.createDataFrame([("s", str(i), "k", at + dt.timedelta(seconds=i), e.encode()) for i, e in enumerate(events)], "shard_id string, sequence_number string, partition_key string, arrival_ts timestamp, data binary")
    raw.coalesce(1).write.parquet(f"{tmp_path}/raw")
    jobs.stream_ingest(archive.read_raw_stream(spark, f"{tmp_path}/raw"), f"{tmp_path}/g", f"{tmp_path}/b", f"{tmp_path}/c", metrics_path=f"{tmp_path}/m", now_ms=JAN + 10_000).awaitTermination()
    got = spark.read.parquet(f"{tmp_path}/m").first().asDict()
    assert {k: got[k] for k in ("batch", "records", "ok", "parse_errors", "validation_errors", "sanitized", "millis_behind")} == {"batch": 0, "records": 4, "ok": 2, "parse_errors": 1, "validation_errors": 1, "sanitized": 1, "millis_behind": 10_000}


@pytest.fixture
def months(spark, tmp_path):
    """A catalogued table of nine months before February 2024, with a row in February."""
    made = rows(spark, *[{"event_id": f"e{m}-{i}", "event_timestamp": JAN - m * 31 * 86_400_000 - i} for m in range(-1, 9) for i in range(6)])
    load.with_month(made.drop("type_errors")).repartition(3).write.partitionBy("year", "month").option("path", f"{tmp_path}/t").saveAsTable("months_t")
    yield "months_t"
    spark.sql("DROP VIEW IF EXISTS months_v")
    spark.sql("DROP TABLE months_t")


def test_roll_makes_next_month_anew_and_refreshes_the_view(spark, tmp_path, months):
    lifecycle.refresh_union_view(spark, months, "months_v")
    spark.sql(f"ALTER TABLE {months} ADD PARTITION (year = 2024, month = 3)")
    assert spark.table("months_v").count() == spark.table(months).count() == 60
    in_february = spark.table(months).where("year = 2024 and month = 2").count()
    assert in_february > 0
    done = lifecycle.roll_month_tables(spark, months, dt.date(2024, 1, 15), view="months_v")
    assert done["made"] == [(2024, 2)] and all(y * 12 + m <= 2023 * 12 + 7 for y, m in done["dropped"]) and done["dropped"]
    left = spark.table("months_v").select("year", "month").distinct().collect()
    assert {tuple(r) for r in left} <= {(2024, 1), *((2023, m) for m in range(8, 13))}
    assert (2024, 2) in lifecycle._partitions(spark, months) and not (tmp_path / "t/year=2024/month=2").exists() or not list((tmp_path / "t/year=2024/month=2").glob("part-*"))
    assert spark.table("months_v").count() == spark.table(months).count()
    assert lifecycle.roll_month_tables(spark, months, dt.date(2024, 1, 15), view="months_v")["dropped"] == []


def test_compacted_months_are_switched_in(spark, tmp_path, months):
    where = "year = 2023 and month = 12"
    before = sorted(r["event_id"] for r in spark.table(months).where(where).select("event_id").collect())
    reading = spark.table(months).where(where)  # planned before the switch
    reading._jdf.queryExecution().executedPlan()
    done = lifecycle.swap_compacted_months(spark, months, [(2023, 12), (1890, 1), (2023, 11)])
    assert done[1890, 1].startswith("failed") and done[2023, 12].endswith("year=2023/month=12")
    assert sorted(r["event_id"] for r in reading.select("event_id").collect()) == before
    after = spark.table(months).where(where)
    assert sorted(r["event_id"] for r in after.select("event_id").collect()) == before
    assert len(after.inputFiles()) == 1 and "_compacted/2023-12" in after.inputFiles()[0]
    assert spark.table(months).count() == 60
    folders = [done[2023, 12], done[2023, 11]]
    lifecycle.discard_folders(spark, months, [*folders, lifecycle.month_location(spark, months, 2023, 10)])
    assert spark.table(months).count() == 60 and not (tmp_path / "t/year=2023/month=12").exists()
    assert (tmp_path / "t/year=2023/month=10").exists()
    with pytest.raises(ValueError, match="holds all"):
        lifecycle._remove_month(spark, months, f"file:{tmp_path}/t")


def test_loads_rolls_and_compaction_of_one_table(spark, tmp_path):
    path, table, state = f"{tmp_path}/lines", f"{tmp_path}/t", f"{tmp_path}/c"
    schema = load.with_month(rows(spark).drop("type_errors"))
    schema.write.partitionBy("year", "month").option("path", table).saveAsTable("loaded_t")
    try:

        def count():
            spark.catalog.refreshTable("loaded_t")  # a session that has listed the files before lists them anew
            return spark.table("loaded_t").count()

        put(spark, path, {"event_id": "a"}, {"event_id": "b", "event_timestamp": JAN - 40 * 86_400_000})
        run(spark, path, table, state, catalogue="loaded_t")
        assert count() == 2 and lifecycle._partitions(spark, "loaded_t") == [(2023, 11), (2024, 1)]
        assert {(r["year"], r["month"], r["files"]) for r in lifecycle.list_month_partitions(spark, table).collect()} == {(2023, 11, 1), (2024, 1, 1)}
        before = lifecycle.swap_compacted_months(spark, "loaded_t")
        lifecycle.discard_folders(spark, "loaded_t", list(before.values()))
        put(spark, path, {"event_id": "a"}, {"event_id": "c"}, {"event_id": "b", "event_timestamp": JAN - 40 * 86_400_000})
        run(spark, path, table, state, catalogue="loaded_t")  # history lies in the compacted folders
        assert count() == 3 and len(spark.table("loaded_t").where("month = 1").inputFiles()) == 2
        assert total(spark, table)["inserted"] == 3 and total(spark, table)["true_duplicates"] == 2
        lifecycle.roll_month_tables(spark, "loaded_t", dt.date(2024, 5, 2))
        assert {r["event_id"] for r in spark.table("loaded_t").collect()} == {"a", "c"}
    finally:
        spark.sql("DROP TABLE loaded_t")


def test_a_swap_that_fails_leaves_the_month(spark, tmp_path, months, monkeypatch):
    monkeypatch.setattr(lifecycle, "_compacted", lambda *_: (_ for _ in ()).throw(OSError("lost")))
    done = lifecycle.swap_compacted_months(spark, months, [(2023, 12)])
    assert done[2023, 12] == "failed: lost" and spark.table(months).count() == 60
    assert lifecycle.month_location(spark, months, 2023, 12).endswith("t/year=2023/month=12")


def test_statistics_come_back_from_the_catalogue(spark, months):
    assert {r["rows"] for r in lifecycle.catalogue_stats(spark, months).collect()} == {None}
    done = lifecycle.analyze_months(spark, months, ["event_id", "event_timestamp"])
    assert set(done.values()) == {"done"}
    want = {(r["year"], r["month"]): r["count"] for r in spark.table(months).groupBy("year", "month").count().collect()}
    assert {(r["year"], r["month"]): r["rows"] for r in lifecycle.catalogue_stats(spark, months).collect()} == want
    got = {r["column"]: r for r in lifecycle.catalogue_column_stats(spark, months, ["event_id", "event_timestamp"]).collect()}
    assert got["event_id"]["nulls"] == 0 and 55 <= got["event_id"]["distinct"] <= 65
    assert lifecycle.analyze_months(spark, months, ["event_id"], [(1890, 1)])[1890, 1].startswith("failed")


def test_batches_are_written_under_their_names(spark, tmp_path):
    lines = [("events/2024/01/01/00/a-b.gz", i, f"line {i:03d}\n") for i in range(50)] + [("events/2024/01/01/01/c d-e=f.gz", 7, "one"), ("events/2024/01/01/01/c d-e=f.gz", 3, "before")]
    df = spark.createDataFrame(lines, "archive_key string, sequence_number long, value string").repartition(4)
    for _ in range(2):  # a second time replaces them
        assert archive.write_named_archive(df, f"{tmp_path}/a") == sorted({k for k, *_ in lines})
    for name in {k for k, *_ in lines}:
        want = [v.rstrip("\n") for k, _, v in sorted(lines, key=lambda x: x[1]) if k == name]
        with gzip.open(f"{tmp_path}/a/{name}", "rt") as f:
            assert f.read().splitlines() == want
    assert not list(tmp_path.glob("a/_named*"))


def test_tasks_write_the_files_of_their_batches(spark, tmp_path, monkeypatch):
    """Under a shared path the driver moves nothing; a file of before is replaced with its checksum."""
    monkeypatch.setattr(archive, "_move_to_names", None)
    old = spark.createDataFrame([("a",)], "value string").coalesce(1)
    old.write.option("compression", "gzip").text(f"{tmp_path}/old")
    part = next((tmp_path / "old").glob("part-*"))
    (tmp_path / "n/x").mkdir(parents=True)
    part.rename(tmp_path / "n/x/k.gz")
    part.with_name(f".{part.name}.crc").rename(tmp_path / "n/x/.k.gz.crc")
    rows = [("x/k.gz", 2, "zwei"), ("x/k.gz", 1, "ein\n"), ("x/k.gz", 3, None), ("é =%.gz", 1, "ü"), (None, 1, "lost"), ("", 2, "too")]
    df = spark.createDataFrame(rows, "archive_key string, sequence_number long, value string").repartition(3)
    assert archive.write_named_archive(df, f"file://{tmp_path}/n") == sorted(["x/k.gz", "é =%.gz", archive.NO_NAME])
    assert [r["value"] for r in spark.read.text(f"{tmp_path}/n/x/k.gz").collect()] == ["ein", "zwei", ""]
    for key, want in (("é =%.gz", ["ü"]), (archive.NO_NAME, ["lost", "too"])):
        with gzip.open(f"{tmp_path}/n/{key}", "rt") as f:
            assert f.read().splitlines() == want
    assert not list(tmp_path.glob("n/_named*"))
    with pytest.raises(Exception, match="lost"):
        archive.write_named_archive(df.withColumn("value", F.raise_error(F.lit("lost")).cast("string")), f"{tmp_path}/n")
    assert not list(tmp_path.glob("n/_named*"))
    assert archive.write_named_archive(df.limit(0), f"{tmp_path}/n") == []


def test_batches_in_a_store_that_only_spark_reads(spark, tmp_path):
    """Spark writes the files and they are moved to their names; a second time replaces them."""
    (tmp_path / "real").mkdir()
    spark.sparkContext._jsc.hadoopConfiguration().set("fs.viewfs.mounttable.named.link./out", f"file:{tmp_path}/real")
    df = spark.createDataFrame([(f"h{i % 7}/b={i % 3}.gz", i, f"{i:03d}") for i in range(100)], "archive_key string, sequence_number long, value string").repartition(4)
    for _ in range(2):
        assert archive.write_named_archive(df, "viewfs://named/out/a") == sorted({f"h{i % 7}/b={i % 3}.gz" for i in range(100)})
    with gzip.open(tmp_path / "real/a/h2/b=1.gz", "rt") as f:
        assert f.read().splitlines() == [f"{i:03d}" for i in range(100) if i % 7 == 2 and i % 3 == 1]
    assert not list(tmp_path.glob("real/a/_named*"))
