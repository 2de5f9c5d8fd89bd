"""Registered queries over the given tables, and the same results in SQL for DuckDB."""

from __future__ import annotations

import datetime as dt
import uuid
from collections.abc import Callable
from functools import wraps

from pyspark.sql import Column, DataFrame, SparkSession, Window
from pyspark.sql import functions as F

from questlog.config import Limits
from questlog.functions.text import decode_utf8, hex_decode, hex_encode, parse_map
from questlog.operators import batching, heatmap, lifecycle, load, metrics, parse, quality
from questlog.plans.adapter import RAW_SQL, raw_records
from questlog.schemas import CONTRACT_PATTERNS, CONTRACT_REQUIRED, EVENT_COLUMNS, REQUIRED, WIDTHS
from questlog.session import prepare, shared_folder
from questlog.sources import archive
from questlog.sources.ledger import Ledger
from questlog.streaming import jobs

AS_OF = dt.date(2024, 1, 31)
QUERIES: dict[str, Callable[[SparkSession, str], DataFrame]] = {}
ORACLE_SQL: dict[str, str] = {}
STRINGS = list(WIDTHS)


def query(sql: str | None = None):
    def register(f):
        @wraps(f)
        def run(spark: SparkSession, sf_dir: str) -> DataFrame:
            return f(prepare(spark), sf_dir)

        QUERIES[f.__name__] = run
        if sql is not None:
            ORACLE_SQL[f.__name__] = sql
        return f

    return register


def _work(spark: SparkSession) -> str:
    """A new folder for a query that writes, in the shared folder of the session."""
    return f"{shared_folder(spark)}/jobs-{uuid.uuid4().hex}"


def _table(spark: SparkSession, d: str, name: str) -> DataFrame:
    return spark.read.parquet(f"{d}/{name}.parquet")


def _classified(s: SparkSession, d: str, where: str = "true") -> DataFrame:
    return parse.classify_events(raw_records(s, d, where))


def _rows(s: SparkSession, d: str, where: str = "true") -> DataFrame:
    """Event rows as a load sees them: from lines that have been written before."""
    path = _work(s)
    parse.split_good_bad(_classified(s, d, where))[0].select(F.col("processed_json").alias("value")).write.parquet(path)
    return load.project_event_row(s.read.schema("value string").parquet(path))


def _history(s: SparkSession, d: str) -> DataFrame:
    return _rows(s, d, "i % 5 = 0")


def _flat(rows: DataFrame) -> DataFrame:
    """Times as milliseconds, so that every engine shows them alike."""
    return rows.withColumns({c: F.unix_millis(c) for c in rows.columns if c.endswith("_timestamp")})


def _orders(s: SparkSession, d: str) -> DataFrame:
    o = _table(s, d, "orders")
    return load.with_month(o.select("o_orderkey", F.col("o_orderdate").cast("timestamp").alias("event_timestamp"), F.col("o_orderpriority").alias("event_type")))


# SQL shared by the oracles: raw records, checked fields, classified events, rows, history
_KEYS = [*STRINGS, "event_timestamp", "position_x", "position_y"]
_HAS = ", ".join(f"coalesce(json_exists(j, '$.{k}'), false) AS has_{k}, CASE WHEN NOT coalesce(json_exists(j, '$.{k}'), false) THEN NULL WHEN json_type(j, '$.{k}') = 'NULL' THEN 'null' WHEN json_type(j, '$.{k}') IN ('OBJECT', 'ARRAY') THEN '' ELSE json_extract_string(j, '$.{k}') END AS t_{k}" for k in _KEYS)
_WRONG = " OR ".join((f"NOT has_{k}" if k in REQUIRED else "false") + ("" if k == "event_timestamp" else f" OR (has_{k} AND NOT regexp_full_match({k}, '[-a-zA-z0-9_. ]*'))") for k in [*STRINGS, "event_timestamp"])
_CHANGED = ", ".join(f"CASE WHEN {c} THEN '{k}' END" for k, c in [
    *[(k, f"has_{k} AND length(t_{k}) > {WIDTHS[k]}") for k in STRINGS[:5]], ("event_timestamp", "num IS NULL OR num < 0"),
    *[(k, f"has_{k} AND length(t_{k}) > {WIDTHS[k]}") for k in STRINGS[5:]], *[(k, f"has_{k} AND {k}_d IS NULL") for k in ("position_x", "position_y")],
])
BASE_SQL = f"""
raw AS ({RAW_SQL}),
p AS (SELECT *, CASE WHEN json_valid(data) THEN CAST(data AS JSON) END AS j FROM raw),
f AS (SELECT *, {_HAS} FROM p),
v AS (SELECT *, {', '.join(f"coalesce(left(t_{k}, {n}), '') AS {k}" for k, n in WIDTHS.items())},
  CASE WHEN regexp_full_match(t_event_timestamp, '[+-]?[0-9]+') THEN TRY_CAST(t_event_timestamp AS BIGINT) END AS num,
  TRY_CAST(t_position_x AS DOUBLE) AS position_x_d, TRY_CAST(t_position_y AS DOUBLE) AS position_y_d FROM f),
c0 AS (SELECT *, CASE WHEN j IS NULL THEN 'parse_error' WHEN {_WRONG} THEN 'validation_error' ELSE 'ok' END AS outcome FROM v),
c AS (SELECT *, CASE WHEN num IS NULL OR num < 0 THEN 0 ELSE num END AS event_timestamp, coalesce(position_x_d, 0.0) AS position_x, coalesce(position_y_d, 0.0) AS position_y,
  CASE WHEN outcome = 'ok' THEN array_to_string(list_filter([{_CHANGED}], lambda x: x IS NOT NULL), ',') ELSE '' END AS sanitized FROM c0),
e AS (SELECT i, arrival_ms AS server_timestamp, event_timestamp, {', '.join(f"CASE WHEN has_{k} AND json_type(j, '$.{k}') <> 'NULL' AND trim({k}) <> '' THEN {k} END AS {k}" for k in STRINGS)},
  CASE WHEN has_position_x THEN position_x END AS position_x, CASE WHEN has_position_y THEN position_y END AS position_y FROM c WHERE outcome = 'ok'),
rows_ AS (SELECT {', '.join(EVENT_COLUMNS)} FROM e), history AS (SELECT {', '.join(EVENT_COLUMNS)} FROM e WHERE i % 5 = 0),
kept AS (SELECT * FROM rows_ WHERE event_timestamp >= epoch_ms(TIMESTAMP '2023-07-01') AND event_timestamp < epoch_ms(TIMESTAMP '2024-02-01')),
loaded AS (SELECT DISTINCT * FROM kept r WHERE NOT EXISTS (SELECT 1 FROM history h WHERE h.event_timestamp = r.event_timestamp AND h.event_id = r.event_id))
"""


def _with(select: str) -> str:
    return f"WITH {BASE_SQL} {select}"


_MS = "epoch_us(ts) // 1000"
_MONTH = "CAST(year(make_timestamp(event_timestamp * 1000)) AS INT) AS year, CAST(month(make_timestamp(event_timestamp * 1000)) AS INT) AS month"
_COLS = ", ".join(EVENT_COLUMNS)


# --- parse, validate, repair

@query("SELECT doc_id, length(text) AS chars, sha256(text) AS digest FROM documents")
def decode_utf8_text(s, d):
    text = decode_utf8(F.col("text").cast("binary"))
    return _table(s, d, "documents").select("doc_id", F.length(text).cast("long").alias("chars"), F.sha2(text, 256).alias("digest"))


@query("SELECT doc_id, coalesce(lower(hex(encode(text))), '') AS hex FROM documents")
def hex_encode_text(s, d):
    return _table(s, d, "documents").select("doc_id", hex_encode(F.col("text").cast("binary")).alias("hex"))


@query("SELECT event_id, lower(hex(unhex(CAST(event_id AS VARCHAR) || CASE WHEN length(CAST(event_id AS VARCHAR)) % 2 = 1 THEN '0' ELSE '' END))) AS hex FROM events")
def hex_decode_text(s, d):
    return _table(s, d, "events").select("event_id", F.lower(F.hex(hex_decode(F.col("event_id").cast("string")))).alias("hex"))


@query(_with("SELECT sequence_number, arrival_ms, j IS NOT NULL AS parsed, json_extract_string(j, '$.event_id') AS event_id FROM p"))
def parse_json(s, d):
    r = raw_records(s, d)
    m = parse_map(decode_utf8(F.col("data")))
    return r.select("sequence_number", F.unix_millis("arrival_ts").alias("arrival_ms"), m.isNotNull().alias("parsed"), F.element_at(m, "event_id").alias("event_id"))


@query(_with("SELECT sequence_number, arrival_ms, array_to_string(list_filter([" + ", ".join(f"CASE WHEN NOT has_{k} THEN '{k}' END" for k in REQUIRED) + "], lambda x: x IS NOT NULL), ',') AS missing FROM f"))
def check_required(s, d):
    return parse.check_required(parse.parse_json(raw_records(s, d))).select("sequence_number", F.unix_millis("arrival_ts").alias("arrival_ms"), F.array_join("missing", ",").alias("missing"))


@query(_with(f"SELECT sequence_number, arrival_ms, {', '.join(STRINGS)} FROM v"))
def truncate_strings(s, d):
    return parse.truncate_strings(parse.parse_json(raw_records(s, d))).select("sequence_number", F.unix_millis("arrival_ts").alias("arrival_ms"), *STRINGS)


@query(_with(f"SELECT sequence_number, arrival_ms, outcome, sanitized, event_timestamp, position_x, position_y, {', '.join(STRINGS)} FROM c"))
def classify_events(s, d):
    c = _classified(s, d)
    return c.select("sequence_number", F.col("server_timestamp").alias("arrival_ms"), "outcome", F.array_join("sanitized_fields", ",").alias("sanitized"), "event_timestamp", "position_x", "position_y", *STRINGS)


@query(_with("SELECT sequence_number, arrival_ms, event_type FROM c WHERE outcome = 'validation_error' AND NOT regexp_full_match(event_type, '[-a-zA-z0-9_. ]*')"))
def check_charset(s, d):
    c = _classified(s, d).where(~F.col("event_type").rlike(r"\A[-a-zA-z0-9_. ]*\z") & (F.col("outcome") == "validation_error"))
    return c.select("sequence_number", F.col("server_timestamp").alias("arrival_ms"), "event_type")


@query(_with("SELECT sequence_number, arrival_ms, event_timestamp FROM c WHERE outcome = 'ok' AND contains(sanitized, 'event_timestamp')"))
def sanitize_timestamp(s, d):
    return _classified(s, d).where("array_contains(sanitized_fields, 'event_timestamp')").select("sequence_number", F.col("server_timestamp").alias("arrival_ms"), "event_timestamp")


@query(_with("SELECT sequence_number, arrival_ms, position_x, position_y, contains(sanitized, 'position') AS changed FROM c WHERE outcome = 'ok'"))
def sanitize_position(s, d):
    c = _classified(s, d).where("outcome = 'ok'")
    return c.select("sequence_number", F.col("server_timestamp").alias("arrival_ms"), "position_x", "position_y", F.exists("sanitized_fields", lambda x: x.startswith("position")).alias("changed"))


@query(_with("SELECT sanitized, count(*) AS events FROM c WHERE outcome = 'ok' GROUP BY 1"))
def sanitized_fields(s, d):
    return _classified(s, d).where("outcome = 'ok'").groupBy(F.array_join("sanitized_fields", ",").alias("sanitized")).agg(F.count("*").alias("events"))


@query(_with("SELECT sequence_number, arrival_ms AS server_timestamp FROM c WHERE outcome = 'ok'"))
def enrich_server_timestamp(s, d):
    return _classified(s, d).where("outcome = 'ok'").select("sequence_number", "server_timestamp")


@query(_with("SELECT event_id, server_timestamp, event_timestamp, position_x, app_name, CAST(json_extract(j, '$.extra') AS VARCHAR) AS extra, len(json_keys(j)) + CASE WHEN num IS NULL AND NOT has_event_timestamp THEN 1 ELSE 0 END + 1 AS keys FROM (SELECT e.*, c.j, c.num, c.has_event_timestamp FROM e JOIN (SELECT DISTINCT i AS ci, arrival_ms AS ca, * FROM c) AS c ON e.i = c.ci AND e.server_timestamp = c.ca) AS x"))
def processed_json(s, d):
    """The archived line itself, read back key by key, unknown keys too."""
    c = _classified(s, d).where("outcome = 'ok'").select("processed_json")
    read = F.from_json("processed_json", "event_id string, server_timestamp bigint, event_timestamp bigint, position_x double, app_name string, extra string")
    return c.select(read.alias("r"), F.size(F.json_object_keys("processed_json")).cast("long").alias("keys")).select("r.*", "keys")


@query(_with("SELECT 'good' AS branch, count(*) AS events FROM c WHERE outcome = 'ok' UNION ALL SELECT 'bad', count(*) FROM c WHERE outcome <> 'ok' OR sanitized <> ''"))
def split_good_bad(s, d):
    good, bad = parse.split_good_bad(_classified(s, d))
    count = lambda df, name: df.agg(F.count("*").alias("events")).select(F.lit(name).alias("branch"), "events")
    return count(good, "good").unionByName(count(bad, "bad"))


_ERRORS = """SELECT sequence_number, arrival_ms, CASE outcome WHEN 'ok' THEN 'SanitizationException' WHEN 'parse_error' THEN 'TelemetryEventParseException' ELSE 'TelemetryEventValidationException' END AS reason,
 nullif(data, '') AS json, CASE WHEN outcome = 'ok' THEN sanitized END AS fields, CASE WHEN outcome <> 'ok' THEN lower(hex(encode(data))) END AS hex FROM c WHERE outcome <> 'ok' OR sanitized <> ''"""


@query(_with(_ERRORS))
def error_records(s, d):
    _, bad = parse.split_good_bad(_classified(s, d))
    return parse.error_records(bad).select("sequence_number", F.unix_millis("arrival_ts").alias("arrival_ms"), "reason", "json", F.array_join("fields", ",").alias("fields"), "hex")


# --- audits and counts

@query(_with("SELECT field, broken FROM (SELECT " + ", ".join(f"count(*) FILTER (json_extract_string(j, '$.{k}') IS NOT NULL AND NOT regexp_full_match(json_extract_string(j, '$.{k}'), '{p[2:-2]}')) AS {k}" for k, p in CONTRACT_PATTERNS.items()) + f" FROM p) UNPIVOT (broken FOR field IN ({', '.join(CONTRACT_PATTERNS)}))"))
def audit_patterns(s, d):
    return quality.audit_patterns(raw_records(s, d))


@query(_with("SELECT field, missing FROM (SELECT " + ", ".join(f"count(*) FILTER (NOT json_exists(j, '$.{k}')) AS {k}" for k in CONTRACT_REQUIRED["older"]) + f" FROM p WHERE j IS NOT NULL) UNPIVOT (missing FOR field IN ({', '.join(CONTRACT_REQUIRED['older'])}))"))
def audit_required(s, d):
    return quality.audit_required(raw_records(s, d), "older")


@query(_with("SELECT field, kind, count(*) AS records FROM (" + " UNION ALL ".join(
    f"SELECT '{k}' AS field, CASE WHEN json_type(j, '$.{k}') IS NULL THEN 'missing' WHEN json_type(j, '$.{k}') = 'VARCHAR' THEN 'string' WHEN json_type(j, '$.{k}') = 'NULL' THEN 'null' WHEN json_type(j, '$.{k}') IN ('OBJECT', 'ARRAY') THEN lower(json_type(j, '$.{k}')) " + ("WHEN TRY_CAST(json_extract_string(j, '$.event_timestamp') AS DOUBLE) < 0 THEN 'below minimum' " if k == "event_timestamp" else "") + "ELSE 'number' END AS kind FROM p" for k in [*CONTRACT_PATTERNS, "event_timestamp", "position_x", "position_y"]) + ") AS k GROUP BY 1, 2"))
def audit_types(s, d):
    return quality.audit_types(raw_records(s, d))


@query(_with("SELECT shard_id, count(*) FILTER (outcome = 'ok') AS success, count(*) FILTER (outcome = 'parse_error') AS parse_failures, count(*) FILTER (outcome = 'validation_error') AS process_failures FROM c GROUP BY 1"))
def outcome_counts(s, d):
    return quality.outcome_counts(_classified(s, d))


@query(_with(f"SELECT coalesce(reason, 'TotalErrors') AS reason, CASE reason WHEN 'SanitizationException' THEN 'NumSanitizationErrors' WHEN 'TelemetryEventValidationException' THEN 'NumValidationErrors' WHEN 'TelemetryEventParseException' THEN 'NumParseErrors' ELSE 'TotalErrors' END AS metric, count(*) AS errors FROM ({_ERRORS}) AS x GROUP BY ROLLUP (reason)"))
def error_counts(s, d):
    return quality.error_counts(parse.error_records(parse.split_good_bad(_classified(s, d))[1]))


# --- load

@query(_with(f"SELECT {_COLS} FROM rows_"))
def project_event_row(s, d):
    return _flat(_rows(s, d))


@query("SELECT doc_id, coalesce(trim(text) <> '', false) AS filled FROM documents")
def blank_as_null(s, d):
    return _table(s, d, "documents").select("doc_id", load.blank_as_null(F.col("text")).isNotNull().alias("filled"))


@query(f"SELECT event_id, {_MS} AS ms, CAST(day(ts) AS INT) AS day, CAST(hour(ts) AS INT) AS hour FROM events")
def epoch_ms_to_ts(s, d):
    t = F.timestamp_millis(F.unix_millis(F.col("ts").cast("timestamp")))
    return _table(s, d, "events").select("event_id", F.unix_millis(t).alias("ms"), F.dayofmonth(t).alias("day"), F.hour(t).alias("hour"))


_ROUGH = """rough AS (SELECT *, CASE WHEN i % 11 = 0 THEN 'position_x is no double' END AS e1, CASE WHEN i % 13 = 0 THEN 'event_timestamp is no bigint' WHEN i % 19 = 0 THEN 'event_timestamp is out of range' END AS e2,
 CASE WHEN i % 17 = 0 THEN 'event_id is null' END AS e3, CASE WHEN i % 13 = 0 OR i % 19 = 0 THEN 'event_timestamp is null' END AS e4 FROM e),
fine AS (SELECT * FROM rough WHERE coalesce(e1, e2, e3, e4) IS NULL),
fine_kept AS (SELECT * FROM fine WHERE event_timestamp >= epoch_ms(TIMESTAMP '2023-07-01') AND event_timestamp < epoch_ms(TIMESTAMP '2024-02-01'))"""


def _rough_lines(s, d):
    """Archived lines of which some have been spoilt: positions and times that are no numbers, times
    that no timestamp holds, missing ids."""
    path = _work(s)
    parse.split_good_bad(_classified(s, d))[0].select("partition_key", "processed_json").write.parquet(path)
    lines = s.read.schema("partition_key string, processed_json string").parquet(path).withColumn("i", F.substring("partition_key", 3, 20).cast("long"))
    v, i = F.regexp_replace("processed_json", r"\n\z", ""), F.col("i")
    time = lambda x: F.regexp_replace(v, r'"event_timestamp":[0-9]+', f'"event_timestamp":{x}')
    v = F.when(i % 11 == 0, F.regexp_replace(F.regexp_replace(v, r'"position_x":[^,}]*,?', ""), r"^\{", '{"position_x":"asdf",')).otherwise(v)
    v = F.when(i % 13 == 0, time('"1.5e"')).when(i % 38 == 0, time(10**17)).when(i % 19 == 0, time(2**63 - 1)).otherwise(v)
    v = F.when(i % 17 == 0, F.regexp_replace(v, r'"event_id":"[^"]*"', '"event_id":"  "')).otherwise(v)
    return lines.select("partition_key", v.alias("value"))


def _rough(s, d):
    """Rows of spoilt lines, as a load sees them."""
    return load.project_event_row(_rough_lines(s, d).select("value"), errors=True)


@query(f"WITH {BASE_SQL}, {_ROUGH} SELECT error, count(*) AS events FROM (SELECT unnest([e1, e2, e3, e4]) AS error FROM rough) AS x WHERE error IS NOT NULL GROUP BY 1")
def load_errors(s, d):
    _, bad = load.split_load_errors(_rough(s, d), "quarantine")
    return bad.select(F.explode("errors").alias("error")).groupBy("error").agg(F.count("*").alias("events"))


@query(f"WITH {BASE_SQL}, {_ROUGH} SELECT count(*) AS inserted, CAST(0 AS BIGINT) AS inserted_again FROM (SELECT DISTINCT {_COLS} FROM fine_kept) AS x")
def dedupe_load_twice(s, d):
    """Spoilt rows are left out; the second load of the same lines inserts nothing."""
    path, rows = _work(s), _rough(s, d)
    empty = s.createDataFrame([], load.with_month(rows.drop("type_errors")).schema)
    archive.write_month_tables(load.dedupe_load(rows, empty, AS_OF, on_error="quarantine"), path)
    first = s.read.parquet(path)
    again = load.dedupe_load(rows, first, AS_OF, on_error="quarantine")
    return first.agg(F.count("*").alias("inserted")).crossJoin(F.broadcast(again.agg(F.count("*").alias("inserted_again"))))  # one row each


@query("SELECT DISTINCT CAST(year(o_orderdate) AS INT) AS year, CAST(month(o_orderdate) AS INT) AS month FROM orders")
def months_in_batch(s, d):
    return load.months_in_batch(_orders(s, d).select("event_timestamp"))


@query("SELECT o_orderkey FROM orders WHERE o_orderdate >= DATE '1997-12-01' AND o_orderdate < DATE '1998-07-01'")
def retention_filter(s, d):
    return load.retention_filter(_orders(s, d), dt.date(1998, 6, 15)).select("o_orderkey")


@query("SELECT o_orderkey FROM orders WHERE year(o_orderdate) = 1997 AND month(o_orderdate) = 3")
def month_slice(s, d):
    return load.month_slice(_orders(s, d), 1997, 3).select("o_orderkey")


@query(_with(f"SELECT DISTINCT {_COLS} FROM rows_"))
def distinct_rows(s, d):
    return _flat(load.distinct_rows(_rows(s, d)))


@query(_with(f"SELECT {_COLS} FROM rows_ r WHERE NOT EXISTS (SELECT 1 FROM history h WHERE h.event_timestamp = r.event_timestamp AND h.event_id = r.event_id)"))
def anti_existing(s, d):
    return _flat(load.anti_existing(_rows(s, d), _history(s, d)))


@query(_with(f"SELECT {_COLS} FROM kept"))
def sorted_insert(s, d):
    return _flat(load.sorted_insert(load.retention_filter(_rows(s, d), AS_OF)))


@query(_with(f"SELECT {_COLS}, {_MONTH} FROM loaded"))
def dedupe_load(s, d):
    return _flat(load.dedupe_load(_rows(s, d), _history(s, d), AS_OF))


@query(_with(f"SELECT {_COLS} FROM rows_ QUALIFY row_number() OVER (PARTITION BY event_timestamp, event_id ORDER BY server_timestamp, {', '.join(STRINGS)}) = 1"))
def strict_key_dedupe(s, d):
    return _flat(load.strict_key_dedupe(_rows(s, d)))


@query("SELECT l_orderkey, l_linenumber, strftime(l_shipdate, '%Y-%m-%d') AS l_shipdate, l_partkey FROM (SELECT l_orderkey, l_linenumber, CAST(l_shipdate AS DATE) AS l_shipdate, l_partkey, row_number() OVER (PARTITION BY l_orderkey, l_linenumber ORDER BY CAST(l_shipdate AS DATE), l_partkey) AS n FROM lineitem) AS x WHERE n = 1")
def strict_key_dedupe_lineitem(s, d):
    rows = _table(s, d, "lineitem").select("l_orderkey", "l_linenumber", F.col("l_shipdate").cast("date").alias("l_shipdate"), "l_partkey")
    return load.strict_key_dedupe(rows, ["l_orderkey", "l_linenumber"], "l_shipdate").withColumn("l_shipdate", F.date_format("l_shipdate", "yyyy-MM-dd"))


@query(f"""WITH {BASE_SQL}, {_ROUGH}, added AS (SELECT DISTINCT {_COLS} FROM fine_kept r WHERE NOT EXISTS (SELECT 1 FROM history h WHERE h.event_timestamp = r.event_timestamp AND h.event_id = r.event_id)),
 n AS (SELECT (SELECT count(*) FROM rough) AS copied, (SELECT count(*) FROM added) AS inserted, (SELECT count(*) FROM fine) AS fine, (SELECT count(*) FROM fine_kept) AS kept)
 SELECT copied, inserted, copied - inserted AS duplicates_ignored, fine - kept AS out_of_retention, kept - inserted AS true_duplicates, copied - fine AS load_errors,
 (SELECT count(DISTINCT date_trunc('month', make_timestamp(event_timestamp * 1000))) FROM rough WHERE e4 IS NULL) AS months FROM n""")
def load_audit(s, d):
    """Over spoilt rows: what breaks a rule is no duplicate."""
    return load.load_audit(_rough(s, d), _history(s, d), AS_OF)


# --- heat map

_BINS = "SELECT CAST(floor(position_x) AS BIGINT) AS bin_x, CAST(floor(position_y) AS BIGINT) AS bin_y, count(*) AS events FROM (SELECT DISTINCT * FROM rows_) AS r WHERE level_id = 'level_2' AND event_type = 'click' GROUP BY 1, 2"
_MAP = "SELECT CAST(round(bin_x - 247.245239) AS BIGINT) AS map_x, CAST(round(bin_y - 492.971008) AS BIGINT) AS map_y, events FROM bins WHERE bin_x IS NOT NULL AND bin_y IS NOT NULL"


def _bins(s, d):
    return heatmap.heatmap_bins(load.distinct_rows(_rows(s, d)), "level_2", "click")


@query(_with(_BINS))
def heatmap_bins(s, d):
    return _bins(s, d)


@query(f"WITH {BASE_SQL}, bins AS ({_BINS}) {_MAP}")
def heatmap_to_map(s, d):
    return heatmap.heatmap_to_map(_bins(s, d))


@query(f"""WITH {BASE_SQL}, bins AS ({_BINS}), m AS ({_MAP}), x AS (SELECT min(map_x) AS x0, max(map_x) AS x1, min(map_y) AS y0, max(map_y) AS y1 FROM m),
 g AS (SELECT (map_x - x0) / CASE WHEN x1 > x0 THEN (x1 - x0) / 25.0::DOUBLE ELSE 1.0 END AS u, (map_y - y0) / CASE WHEN y1 > y0 THEN (y1 - y0) / 14.0::DOUBLE ELSE 1.0 END AS v, events FROM m, x),
 k AS (SELECT *, round_even(u, 0) AS ua, round_even(v, 0) AS va, floor(u) + 0.5 AS ub, floor(v) + 0.5 AS vb FROM g)
 SELECT CAST(CASE WHEN a THEN ua ELSE ub END AS DOUBLE) AS cell_u, CAST(CASE WHEN a THEN va ELSE vb END AS DOUBLE) AS cell_v, max(events) AS events FROM (SELECT *, (u - ua) * (u - ua) + 3 * ((v - va) * (v - va)) < (u - ub) * (u - ub) + 3 * ((v - vb) * (v - vb)) AS a FROM k) AS z GROUP BY 1, 2""")
def heatmap_hexbin(s, d):
    return heatmap.heatmap_hexbin(heatmap.heatmap_to_map(_bins(s, d)))


# --- metrics

def _points(s, d):
    """Points of a metric for each event: its type is the operation, its value the value."""
    return _table(s, d, "events").select(
        F.col("event_type").alias("operation"), F.concat(F.lit("host"), F.col("user_id") % 3).alias("component"), F.concat(F.lit("shard-"), F.col("event_id") % 4).alias("shard_id"),
        F.lit("latency").alias("name"), F.floor("value").alias("value"), F.col("ts").cast("timestamp").alias("ts"), "event_id", "user_id",
    )


@query("""SELECT operation, component, name, shard_id, CAST(sum(value) AS BIGINT) AS total, count(*) AS points, CAST(grouping(shard_id) AS INT) AS all_shards FROM (SELECT event_type AS operation, 'host' || (user_id % 3) AS component, 'shard-' || (event_id % 4) AS shard_id, 'latency' AS name, CAST(floor(value) AS BIGINT) AS value FROM events) AS p
 GROUP BY GROUPING SETS ((operation, component, name), (operation, component, name, shard_id))""")
def metrics_by_shard(s, d):
    return metrics.metrics_by_shard(_points(s, d)).withColumn("total", F.col("total").cast("long"))


@query("SELECT event_id, 'a=' || event_type || ',b=common,c=' || (user_id % 7) AS dimensions FROM events")
def metric_dimensions(s, d):
    own = F.create_map(F.lit("c"), (F.col("user_id") % 7).cast("string"), F.lit("a"), F.col("event_type"))
    m = metrics.metric_dimensions(own, F.create_map(F.lit("b"), F.lit("common"), F.lit("z"), F.lit("last")), 3)
    return _table(s, d, "events").select("event_id", F.array_join(F.transform(F.map_entries(m), lambda e: F.concat(e["key"], F.lit("="), e["value"])), ",").alias("dimensions"))


@query("SELECT epoch_ms(date_trunc('day', ts)) AS window_start, event_type AS name, round(avg(floor(value)), 6) AS average, max(floor(value)) AS maximum, min(floor(value)) AS minimum, count(*) AS sample_count, sum(floor(value)) AS total FROM events WHERE ts >= TIMESTAMP '2024-01-05' AND ts < TIMESTAMP '2024-01-20' GROUP BY 1, 2")
def metric_statistics(s, d):
    p = _points(s, d).select("ts", F.lit("game").alias("namespace"), F.col("operation").alias("name"), F.lit("none").alias("dimensions"), F.col("value").cast("double").alias("value"))
    r = metrics.metric_statistics(p, "1 day", "2024-01-05", "2024-01-20")
    return r.select(F.unix_millis("window_start").alias("window_start"), "name", F.round("average", 6).alias("average"), "maximum", "minimum", "sample_count", "total")


_USAGE = """x AS (SELECT strftime(make_timestamp(arrival_ms * 1000), '%Y-%m-%d') AS day, strlen(data) AS bytes, shard_id || strftime(make_timestamp(arrival_ms * 1000), '%H') AS file FROM raw),
 u AS (SELECT day, count(*) AS total_event_count, CAST(sum(bytes) AS BIGINT) AS total_event_bytes, count(DISTINCT file) AS total_file_count FROM x GROUP BY 1)"""


def _usage(s, d):
    day = F.date_format("arrival_ts", "yyyy-MM-dd")
    r = raw_records(s, d)
    files = r.select(day.alias("day"), "shard_id", F.hour("arrival_ts").alias("hour")).distinct()
    return metrics.usage_rows(r, files, day)


@query(f"WITH {BASE_SQL}, {_USAGE} SELECT day, metric, total FROM u UNPIVOT (total FOR metric IN (total_event_count, total_event_bytes, total_file_count))")
def usage_rows(s, d):
    return _usage(s, d)


@query(f"""WITH {BASE_SQL}, {_USAGE} SELECT day, '{{"Solution":"game","TimeStamp":"20240131 000000.000","Data":[{{"Metric":"total_event_bytes","Sum":' || total_event_bytes || '}},{{"Metric":"total_event_count","Sum":' || total_event_count || '}},{{"Metric":"total_file_count","Sum":' || total_file_count || '}}]}}' AS payload FROM u""")
def usage_report(s, d):
    return metrics.usage_report(_usage(s, d), "game", F.lit(AS_OF).cast("timestamp"))


@query(_with("SELECT shard_id AS operation, round(avg(CASE WHEN outcome = 'ok' THEN 1.0 ELSE 0.0 END), 9) AS availability, count(*) AS calls FROM c GROUP BY 1"))
def availability(s, d):
    a = metrics.availability(_classified(s, d).select(F.col("shard_id").alias("operation"), (F.col("outcome") == "ok").alias("ok")))
    return a.withColumn("availability", F.round("availability", 9))


@query(_with("SELECT shard_id, count(*) AS records, CAST(sum(strlen(data)) AS BIGINT) AS bytes FROM raw GROUP BY 1"))
def emit_volume(s, d):
    return metrics.emit_volume(raw_records(s, d), ["shard_id"])


# --- batches

@query("SELECT event_id, CAST(floor((row_number() OVER (PARTITION BY event_id % 4 ORDER BY event_id) - 1) / 100) AS BIGINT) AS batch FROM events")
def batch_by_count(s, d):
    e = _table(s, d, "events").select("event_id", F.concat(F.lit("shard-"), F.col("event_id") % 4).alias("shard_id"), F.lpad(F.col("event_id").cast("string"), 20, "0").alias("sequence_number"))
    return batching.batch_by_count(e).select("event_id", "batch")


def _flushed(s, d):
    return batching.flush_batches(raw_records(s, d), Limits(flush_records=100, flush_bytes=1 << 40, flush_ms=1 << 60))


_FLUSH = "b AS (SELECT *, CAST(floor((row_number() OVER (PARTITION BY shard_id ORDER BY sequence_number, arrival_ms) - 1) / 100) AS BIGINT) AS batch FROM raw)"


@query(f"WITH {BASE_SQL}, {_FLUSH} SELECT shard_id, sequence_number, arrival_ms, batch FROM b")
def flush_batches(s, d):
    return _flushed(s, d).select("shard_id", "sequence_number", F.unix_millis("arrival_ts").alias("arrival_ms"), "batch")


_CLOSED = "records >= 500 OR bytes >= 20000 OR arrival_ms - began >= 21600000"
_CUTS = f"""n AS MATERIALIZED (SELECT shard_id, sequence_number, arrival_ms, strlen(data) AS size, row_number() OVER (PARTITION BY shard_id ORDER BY sequence_number, arrival_ms) AS k FROM raw),
 w AS (SELECT shard_id, sequence_number, arrival_ms, size, k, CAST(0 AS BIGINT) AS batch, CAST(1 AS BIGINT) AS records, CAST(size AS BIGINT) AS bytes, arrival_ms AS began FROM n WHERE k = 1
 UNION ALL SELECT n.shard_id, n.sequence_number, n.arrival_ms, n.size, n.k, w.batch + CASE WHEN {_CLOSED.replace('arrival_ms', 'w.arrival_ms')} THEN 1 ELSE 0 END,
 CASE WHEN {_CLOSED.replace('arrival_ms', 'w.arrival_ms')} THEN 1 ELSE records + 1 END, CASE WHEN {_CLOSED.replace('arrival_ms', 'w.arrival_ms')} THEN n.size ELSE bytes + n.size END,
 CASE WHEN {_CLOSED.replace('arrival_ms', 'w.arrival_ms')} THEN n.arrival_ms ELSE began END FROM w JOIN n ON n.shard_id = w.shard_id AND n.k = w.k + 1)"""


@query(f"""WITH RECURSIVE raw AS ({RAW_SQL}), {_CUTS} SELECT shard_id, batch, min(sequence_number) AS first_sequence, max(sequence_number) AS last_sequence, arg_min(arrival_ms, k) AS first_arrival, count(*) AS records, CAST(sum(size) AS BIGINT) AS bytes FROM w GROUP BY 1, 2""")
def flush_batches_by_bytes(s, d):
    """Cuts by bytes and age as well; each depends on the one before."""
    cut = batching.flush_batches(raw_records(s, d), Limits(flush_records=500, flush_bytes=20_000, flush_ms=6 * 3600 * 1000))
    return batching.batch_summary(cut).withColumn("first_arrival", F.unix_millis("first_arrival"))


_SUMMARY = "s AS (SELECT shard_id, batch, min(sequence_number) AS first_sequence, max(sequence_number) AS last_sequence, arg_min(arrival_ms, sequence_number || lpad(CAST(arrival_ms AS VARCHAR), 20, '0')) AS first_arrival, count(*) AS records, CAST(sum(strlen(data)) AS BIGINT) AS bytes FROM b GROUP BY 1, 2)"


@query(f"WITH {BASE_SQL}, {_FLUSH}, {_SUMMARY} SELECT * FROM s")
def batch_summary(s, d):
    return batching.batch_summary(_flushed(s, d)).withColumn("first_arrival", F.unix_millis("first_arrival"))


@query(f"WITH {BASE_SQL}, {_FLUSH}, {_SUMMARY} SELECT shard_id, batch, 'events/' || strftime(make_timestamp(first_arrival * 1000), '%Y/%m/%d/%H/') || first_sequence || '-' || last_sequence || '.gzip' AS archive_key FROM s")
def archive_key(s, d):
    return batching.archive_key(batching.batch_summary(_flushed(s, d))).select("shard_id", "batch", "archive_key")


# --- sources and sinks

@query(_with("SELECT json_extract_string(j, '$.event_id') AS partition_key, CASE WHEN j IS NOT NULL THEN CAST(1700000000000 AS BIGINT) END AS event_timestamp FROM p"))
def replay_jsonl(s, d):
    """All raw records, malformed and repeated ones too."""
    r = archive.replay_jsonl(raw_records(s, d).select(F.col("data").cast("string").alias("value")), 1_700_000_000_000)
    return r.select("partition_key", F.get_json_object("value", "$.event_timestamp").cast("long").alias("event_timestamp"))


_HOUR = "strftime(make_timestamp(arrival_ms * 1000), '%Y%m%d%H') AS hour"


def _hour() -> Column:
    return F.concat("year", *[F.lpad(F.col(c).cast("string"), 2, "0") for c in ("month", "day", "hour")])


@query(_with(f"SELECT {_HOUR}, event_id, server_timestamp, event_timestamp, position_x FROM (SELECT *, server_timestamp AS arrival_ms FROM e) AS x"))
def write_archive(s, d):
    """The lines as they are read back from the folder of their hour."""
    path = _work(s)
    archive.write_archive(parse.split_good_bad(_classified(s, d))[0].select("arrival_ts", F.col("processed_json").alias("value")), path)
    read = F.from_json("value", "event_id string, server_timestamp bigint, event_timestamp bigint, position_x double")
    return s.read.text(path).select(_hour().alias("hour"), read.alias("r")).select("hour", "r.*")


@query(_with(f"SELECT {_HOUR}, reason, json, fields, hex FROM ({_ERRORS}) AS x"))
def write_error_archive(s, d):
    path = _work(s)
    archive.write_archive(parse.error_lines(parse.error_records(parse.split_good_bad(_classified(s, d))[1])), path)
    read = F.from_json("value", "reason string, json string, fields array<string>, hex string")
    return s.read.text(path).select(_hour().alias("hour"), read.alias("r")).select("hour", "r.reason", "r.json", F.array_join("r.fields", ",").alias("fields"), "r.hex")


@query(f"""WITH {BASE_SQL}, {_FLUSH}, {_SUMMARY} SELECT 'events/' || strftime(make_timestamp(first_arrival * 1000), '%Y/%m/%d/%H/') || first_sequence || '-' || last_sequence || '.gz' AS name, records, bytes FROM s""")
def write_named_archive(s, d):
    """Each batch of raw records in a file of its own under its archive key, and what is read back from it."""
    path, records = _work(s), raw_records(s, d)
    batched = batching.flush_batches(records, Limits(flush_records=100, flush_bytes=1 << 40, flush_ms=1 << 60))
    keys = batching.archive_key(batching.batch_summary(batched), suffix=".gz").select("shard_id", "batch", "archive_key")
    # copies of a record may lie on both sides of a cut
    numbered = lambda df: df.withColumn("copy", F.row_number().over(Window.partitionBy("shard_id", "sequence_number", "arrival_ts").orderBy(F.lit(0))))
    named = batched.join(keys, ["shard_id", "batch"]).select("shard_id", "sequence_number", "arrival_ts", "archive_key")  # before the records join, which are large
    rows = numbered(records).join(numbered(named), ["shard_id", "sequence_number", "arrival_ts", "copy"])
    names = archive.write_named_archive(rows.select("archive_key", "sequence_number", F.col("data").cast("string").alias("value")), path)
    lines = s.read.option("recursiveFileLookup", "true").text(path).select(F.regexp_extract(F.input_file_name(), "(events/.*)$", 1).alias("name"), "value")
    # Spark deals out a few files a task, as if each were of megabytes; here a task reads some 500
    read = lines.coalesce(max(s.sparkContext.defaultParallelism, len(names) // 500)).groupBy("name")
    return read.agg(F.count("*").alias("records"), F.sum(F.octet_length("value")).alias("bytes"))


def _pointers(s, d):
    keys = batching.archive_key(batching.batch_summary(_flushed(s, d)))
    return archive.file_pointers(keys, "archive_key").join(keys.select(F.col("archive_key").alias("filename"), "shard_id", "first_sequence"), "filename")


_KEYS_SQL = f"{_FLUSH}, {_SUMMARY}, k AS (SELECT shard_id, batch, first_sequence, 'events/' || strftime(make_timestamp(first_arrival * 1000), '%Y/%m/%d/%H/') || first_sequence || '-' || last_sequence || '.gzip' AS filename FROM s)"


@query(f"""WITH {BASE_SQL}, {_KEYS_SQL} SELECT filename, '{{"filename":"' || filename || '"}}' AS pointer FROM k""")
def file_pointers(s, d):
    return _pointers(s, d).select("filename", "pointer")


@query("""SELECT event_id, CASE WHEN event_id % 5 = 0 THEN 'parse_error' WHEN event_id % 7 = 0 OR event_id % 13 = 0 THEN 'validation_error' ELSE 'ok' END AS outcome,
 CASE WHEN event_id % 5 <> 0 AND event_id % 7 <> 0 AND event_id % 13 <> 0 THEN CASE WHEN event_id % 11 = 0 THEN 'null' ELSE 'f' || event_id END END AS filename FROM events""")
def parse_file_pointers(s, d):
    n = F.col("event_id")
    p = F.when(n % 5 == 0, F.lit('{"file":"x"}')).when(n % 7 == 0, F.lit('{"filename":"  "}')).when(n % 13 == 0, F.lit('{"filename":{"a":1}}')).when(n % 11 == 0, F.lit('{"filename":null}')).otherwise(F.concat(F.lit('{"filename":" f'), F.col("event_id"), F.lit('"}')))
    return archive.parse_file_pointers(_table(s, d, "events").select("event_id", p.alias("pointer"))).select("event_id", "outcome", "filename")


@query(f"""WITH {BASE_SQL}, {_KEYS_SQL} SELECT shard_id AS batch, 'manifests/' || arg_min(filename, first_sequence) || '-' || regexp_extract(arg_max(filename, first_sequence), '[^/]*$') || '.manifest' AS path,
 '{{"entries":[' || string_agg('{{"url":"s3a://b/' || filename || '","mandatory":true}}', ',' ORDER BY first_sequence) || ']}}' AS manifest FROM k GROUP BY 1""")
def build_manifest(s, d):
    return archive.build_manifest(_pointers(s, d).select(F.col("shard_id").alias("batch"), F.col("first_sequence").alias("sequence_number"), "filename"), "s3a://b/")


@query(_with(f"SELECT {_COLS} FROM rows_"))
def load_from_manifest(s, d):
    """Archive, pointers of the files that were written, one manifest of them, and the rows of its files."""
    path = _work(s)
    archive.write_archive(parse.split_good_bad(_classified(s, d))[0].select("arrival_ts", F.col("processed_json").alias("value")), path)
    named = archive.parse_file_pointers(archive.file_pointers(archive.written_files(s, path))).where("outcome = 'ok'")
    batch = named.select(F.lit(1).alias("batch"), F.col("filename").alias("sequence_number"), "filename")
    manifest = archive.build_manifest(batch).first()["manifest"]  # at most as many names as a load takes files
    return _flat(load.project_event_row(archive.load_from_manifest(s, manifest)))


@query(_with(f"SELECT {_COLS}, {_MONTH} FROM loaded"))
def write_month_tables(s, d):
    path = _work(s)
    archive.write_month_tables(load.dedupe_load(_rows(s, d), _history(s, d), AS_OF), path)
    return _flat(s.read.parquet(path))


@query(_with("SELECT sequence_number, partition_key, arrival_ms FROM raw"))
def read_raw_stream(s, d):
    source, out = _work(s), _work(s)
    raw_records(s, d).write.parquet(source)
    q = archive.read_raw_stream(s, source, max_per_trigger=4).writeStream.option("checkpointLocation", f"{out}-c").trigger(availableNow=True).format("parquet").start(out)
    q.awaitTermination()
    return s.read.parquet(out).select("sequence_number", "partition_key", F.unix_millis("arrival_ts").alias("arrival_ms"))


# --- lifecycle

@query("SELECT DISTINCT 'events_' || strftime(o_orderdate, '%Y_%m') AS table_name FROM orders")
def month_table_name(s, d):
    return _orders(s, d).select(lifecycle.month_table_name(F.col("year"), F.col("month")).alias("table_name")).distinct()


@query("SELECT CAST(year(m) AS INT) AS year, CAST(month(m) AS INT) AS month, count(*) FILTER (o_orderdate IS NOT NULL) AS orders FROM range(DATE '1998-01-01', DATE '1998-08-01', INTERVAL 1 MONTH) AS r(m) LEFT JOIN orders ON date_trunc('month', o_orderdate) = m GROUP BY 1, 2")
def month_calendar(s, d):
    c = lifecycle.month_calendar(s, dt.date(1998, 6, 15))
    return c.join(_orders(s, d), ["year", "month"], "left").groupBy("year", "month").agg(F.count("o_orderkey").alias("orders"))


@query("SELECT o_orderkey FROM orders WHERE strftime(o_orderdate, '%Y%m') NOT IN ('199712', '199807')")
def expire_months(s, d):
    return lifecycle.expire_months(_orders(s, d), dt.date(1998, 6, 15)).select("o_orderkey")


@query("SELECT DISTINCT 'orders_' || strftime(o_orderdate, '%Y_%m') AS table_name FROM orders")
def list_month_tables(s, d):
    return lifecycle.list_month_tables(_orders(s, d), "orders")


@query("SELECT o_orderkey FROM orders")
def union_months(s, d):
    """Every month of the table, each a table of its own before."""
    path = _work(s)
    _orders(s, d).write.partitionBy("year", "month").parquet(path)
    months = [(r["year"], r["month"]) for r in lifecycle.list_month_partitions(s, path).select("year", "month").collect()]  # one row a month
    return lifecycle.union_months([load.month_slice(s.read.parquet(path), y, m) for y, m in months]).select("o_orderkey")


@query("SELECT CAST(year(o_orderdate) AS INT) AS year, CAST(month(o_orderdate) AS INT) AS month FROM orders GROUP BY 1, 2")
def list_month_partitions(s, d):
    path = _work(s)
    _orders(s, d).write.partitionBy("year", "month").parquet(path)
    return lifecycle.list_month_partitions(s, path).select("year", "month")


def _catalogued(s, d) -> str:
    """Orders as a catalogued table by month, with a folder of its own."""
    name = f"orders_{uuid.uuid4().hex}"
    _orders(s, d).write.partitionBy("year", "month").option("path", _work(s)).saveAsTable(name)
    return name


def _left(s, name: str, found: DataFrame, *views: str) -> DataFrame:
    """A result that needs the table no more; the table leaves the catalogue."""
    path = _work(s)
    found.write.parquet(path)
    for v in views:
        s.sql(f"DROP VIEW {v}")
    s.sql(f"DROP TABLE {name}")
    return s.read.schema(found.schema).parquet(path)


@query("SELECT CAST(year(o_orderdate) AS INT) AS year, CAST(month(o_orderdate) AS INT) AS month, count(*) AS orders FROM orders WHERE o_orderdate >= DATE '1998-01-01' AND strftime(o_orderdate, '%Y%m') <> '199807' GROUP BY 1, 2")
def roll_month_tables(s, d):
    """Next month holds rows before, and is empty after; months older than the window are dropped.
    The view that the roll refreshes is counted."""
    name = _catalogued(s, d)
    lifecycle.refresh_union_view(s, name, f"all_{name}")
    lifecycle.roll_month_tables(s, name, dt.date(1998, 6, 15), view=f"all_{name}")
    return _left(s, name, s.table(f"all_{name}").groupBy("year", "month").agg(F.count("*").alias("orders")), f"all_{name}")


@query("SELECT o_orderkey, CAST(year(o_orderdate) AS INT) AS year, CAST(month(o_orderdate) AS INT) AS month FROM orders WHERE year(o_orderdate) = 1997 AND month(o_orderdate) IN (1, 2)")
def compact_month(s, d):
    path = _work(s)
    _orders(s, d).write.partitionBy("year", "month").parquet(path)
    done = lifecycle.compact_months(s, path, [(1997, 1), (1997, 2)])
    return lifecycle.union_months([s.read.parquet(p) for p in done.values()]).select("o_orderkey", "year", "month")


@query("SELECT o_orderkey, CAST(year(o_orderdate) AS INT) AS year, CAST(month(o_orderdate) AS INT) AS month FROM orders")
def swap_compacted_months(s, d):
    """The whole table, read after two of its months have been compacted and swapped in, and the
    folders of before removed; a month that is not there fails alone."""
    name = _catalogued(s, d)
    done = lifecycle.swap_compacted_months(s, name, [(1997, 1), (1890, 1), (1997, 2)])
    lifecycle.discard_folders(s, name, [x for x in done.values() if not x.startswith("failed")])
    return _left(s, name, s.table(name).select("o_orderkey", "year", "month"))


@query("SELECT CAST(year(o_orderdate) AS INT) AS year, CAST(month(o_orderdate) AS INT) AS month, count(*) AS rows FROM orders GROUP BY 1, 2")
def analyze_months(s, d):
    """Rows of each month as the catalogue has them after compaction and ANALYZE."""
    name = _catalogued(s, d)
    lifecycle.swap_compacted_months(s, name, [(1997, 1), (1997, 2)])
    lifecycle.analyze_months(s, name, ["o_orderkey", "event_type"])
    return _left(s, name, lifecycle.catalogue_stats(s, name).select("year", "month", "rows"))


@query("SELECT 'o_orderkey' AS \"column\", CAST(0 AS BIGINT) AS nulls, CAST(min(o_orderkey) AS VARCHAR) AS least, CAST(max(o_orderkey) AS VARCHAR) AS greatest FROM orders UNION ALL SELECT 'event_timestamp', 0, strftime(min(o_orderdate), '%Y-%m-%d'), strftime(max(o_orderdate), '%Y-%m-%d') FROM orders")
def analyze_columns(s, d):
    """Extremes and nulls of columns as the catalogue has them."""
    name = _catalogued(s, d)
    lifecycle.analyze_months(s, name, ["o_orderkey", "event_timestamp"], [])
    found = lifecycle.catalogue_column_stats(s, name, ["o_orderkey", "event_timestamp"])
    day = lambda c: F.when(F.col("column") == "event_timestamp", F.left(c, F.lit(10))).otherwise(F.col(c)).alias(c)
    return _left(s, name, found.select("column", "nulls", day("least"), day("greatest")))


@query("SELECT CAST(year(o_orderdate) AS INT) AS year, CAST(month(o_orderdate) AS INT) AS month, 'event_type' AS \"column\", count(*) AS rows, CAST(0 AS BIGINT) AS nulls, count(DISTINCT o_orderpriority) AS \"distinct\", min(o_orderpriority) AS least, max(o_orderpriority) AS greatest FROM orders GROUP BY 1, 2")
def table_stats(s, d):
    return lifecycle.table_stats(_orders(s, d), ["event_type"])


# --- streams: what each leaves behind

def _stream(s, d, max_per_trigger: int | None = None):
    source = _work(s)
    raw_records(s, d).write.parquet(source)
    return archive.read_raw_stream(s, source, max_per_trigger=max_per_trigger)


@query(_with("SELECT 'good' AS branch, count(*) AS events FROM c WHERE outcome = 'ok' UNION ALL SELECT 'bad', count(*) FROM c WHERE outcome <> 'ok' OR sanitized <> ''"))
def stream_ingest(s, d):
    good, bad, state = _work(s), _work(s), _work(s)
    jobs.stream_ingest(_stream(s, d), good, bad, state).awaitTermination()
    count = lambda p, n: s.read.text(p).agg(F.count("*").alias("events")).select(F.lit(n).alias("branch"), "events")
    return count(good, "good").unionByName(count(bad, "bad"))


@query(_with("SELECT count(*) AS records, count(*) FILTER (outcome = 'ok') AS ok, count(*) FILTER (outcome = 'parse_error') AS parse_errors, count(*) FILTER (outcome = 'validation_error') AS validation_errors, count(*) FILTER (sanitized <> '') AS sanitized, max(1706745600000 - arrival_ms) AS millis_behind FROM c"))
def stream_ingest_metrics(s, d):
    """What each batch was observed to hold while it was archived, added up."""
    metrics_path = _work(s)
    jobs.stream_ingest(_stream(s, d, 2), _work(s), _work(s), _work(s), metrics_path=metrics_path, now_ms=1_706_745_600_000).awaitTermination()
    total = [F.sum(c).alias(c) for c in ("records", "ok", "parse_errors", "validation_errors", "sanitized")]
    return s.read.parquet(metrics_path).agg(*total, F.max("millis_behind").alias("millis_behind"))


def _loaded(s, d) -> tuple[str, str]:
    """Two runs of several batches each; the second reads files that repeat all lines, and adds nothing.
    Records of an event stand in one file, since a load takes later copies only together with the first."""
    lines, table, state, errors = _work(s), _work(s), _work(s), _work(s)
    rough = _rough_lines(s, d)
    for _ in range(2):
        rough.repartition(2, "partition_key").select("value").write.mode("append").text(lines)
        stream = s.readStream.schema("value string").option("maxFilesPerTrigger", 1).text(lines)
        jobs.stream_load(stream, table, lambda: AS_OF, state, on_error="quarantine", errors_path=errors).awaitTermination()
    return table, errors


@query(f"WITH {BASE_SQL}, {_ROUGH} SELECT DISTINCT {_COLS}, {_MONTH} FROM fine_kept")
def stream_load(s, d):
    """Of spoilt lines those that break no rule."""
    return _flat(s.read.parquet(_loaded(s, d)[0]))


@query(f"""WITH {BASE_SQL}, {_ROUGH}, n AS (SELECT 2 * (SELECT count(*) FROM rough) AS copied, (SELECT count(*) FROM (SELECT DISTINCT {_COLS} FROM fine_kept)) AS inserted, 2 * (SELECT count(*) FROM fine) AS fine, 2 * (SELECT count(*) FROM fine_kept) AS kept)
 SELECT copied, inserted, copied - fine AS load_errors, fine - kept AS out_of_retention, kept - inserted AS true_duplicates, copied - fine AS quarantined FROM n""")
def load_ledger(s, d):
    """What the loads of a table have entered in its ledger, added up, and the rows kept apart."""
    table, errors = _loaded(s, d)
    total = Ledger(s, table).entries().agg(*[F.sum(c).alias(c) for c in ("copied", "inserted", "load_errors", "out_of_retention", "true_duplicates")])
    return total.crossJoin(F.broadcast(s.read.parquet(errors).agg(F.count("*").alias("quarantined"))))  # one row each


@query(f"WITH {BASE_SQL}, {_ROUGH} SELECT DISTINCT event_timestamp, event_id FROM fine_kept")
def stream_load_pointers(s, d):
    """Lines in twelve files; a stream of their pointers, each twice, a bad one and one of a file that is missing,
    becomes manifests of five files at most. Copies of an event in later files are left out, so keys are compared."""
    lines, pointers, table, errors = _work(s), _work(s), _work(s), _work(s)
    _rough_lines(s, d).repartition(12).select("value").write.text(lines)
    named = archive.file_pointers(archive.written_files(s, lines)).select("filename", "pointer")
    more = s.createDataFrame([("a", '{"file":1}'), (f"{lines}/part-none.txt", f'{{"filename":"{lines}/part-none.txt"}}')], "filename string, pointer string")
    for _ in range(2):
        named.unionByName(more).select(F.col("filename").alias("sequence_number"), "pointer").coalesce(1).write.mode("append").parquet(pointers)
    stream = s.readStream.schema("sequence_number string, pointer string").option("maxFilesPerTrigger", 1).parquet(pointers)
    jobs.stream_load_pointers(stream, table, lambda: AS_OF, _work(s), on_error="quarantine", errors_path=errors, mandatory=False, limits=Limits(load_files=5)).awaitTermination()
    return _flat(s.read.parquet(table).select("event_timestamp", "event_id")).distinct()


@query(_with("SELECT DISTINCT partition_key FROM raw"))
def stream_dedupe(s, d):
    out = _work(s)
    q = jobs.stream_dedupe(_stream(s, d), ["partition_key"], "60 days", "arrival_ts").writeStream.option("checkpointLocation", f"{out}-c").trigger(availableNow=True).format("parquet").start(out)
    q.awaitTermination()
    return s.read.parquet(out).select("partition_key")


@query(_with("SELECT CASE WHEN event_timestamp < epoch_ms(TIMESTAMP '2023-07-01') THEN 'too old' WHEN event_timestamp >= epoch_ms(TIMESTAMP '2024-02-01') THEN 'future' ELSE 'accepted' END AS place, count(*) AS events FROM rows_ GROUP BY 1"))
def late_and_future(s, d):
    return jobs.late_and_future(_rows(s, d), AS_OF)


@query(_with("SELECT epoch_ms(date_trunc('day', make_timestamp(arrival_ms * 1000))) AS window_start, shard_id, outcome, count(*) AS records FROM c GROUP BY 1, 2, 3"))
def stream_metrics(s, d):
    path = _work(s)
    jobs.stream_metrics_to(jobs.stream_metrics(parse.classify_events(_stream(s, d)), "60 days"), path, _work(s)).awaitTermination()
    return jobs.latest_metrics(s.read.parquet(path)).withColumn("window_start", F.unix_millis("window_start"))


@query(_with("SELECT shard_id, max(1706745600000 - arrival_ms) AS millis_behind FROM raw GROUP BY 1"))
def stream_lag(s, d):
    path = _work(s)
    jobs.stream_lag_to(_stream(s, d), path, _work(s), now_ms=1_706_745_600_000).awaitTermination()
    return s.read.parquet(path).groupBy("shard_id").agg(F.max("millis_behind").alias("millis_behind"))
