"""Raw records to classified events: one select of column expressions, no shuffle and no UDF."""

from __future__ import annotations

from functools import reduce

from pyspark.sql import Column, DataFrame
from pyspark.sql import functions as F

from questlog.functions.text import decode_utf8, hex_encode, is_container, parse_map, parse_variants
from questlog.operators.once import once
from questlog.schemas import CHARSET, CHECKED, POSITIONS, REQUIRED, STRICT_CHARSET, WIDTHS

OK, PARSE_ERROR, VALIDATION_ERROR = "ok", "parse_error", "validation_error"


def _has(key: str) -> Column:
    return F.coalesce(F.map_contains_key("fields", key), F.lit(False))


def _text(key: str) -> Column:
    """A value as text: JSON null is the word null, objects and arrays are empty."""
    value = F.element_at("fields", key)
    return F.when(is_container(F.element_at("variants", key)), "").otherwise(F.coalesce(value, F.lit("null")))


def parse_json(raw: DataFrame, kinds: bool = True) -> DataFrame:
    """Decode and parse: adds raw_json, fields (text by key) and, where kinds are asked for,
    variants (values by key). Texts keep numbers as they were written, values keep their kinds."""
    text = once(raw, {"raw_json": decode_utf8(F.col("data"))})
    return once(text, {"fields": parse_map(F.col("raw_json"))} | ({"variants": parse_variants(F.col("raw_json"))} if kinds else {}))


def check_required(parsed: DataFrame) -> DataFrame:
    """Add missing: the required keys that are not there; a JSON null counts as there."""
    return parsed.withColumn("missing", F.filter(F.array(*[F.when(~_has(k), F.lit(k)) for k in REQUIRED]), lambda x: x.isNotNull()))


def truncate_strings(parsed: DataFrame) -> DataFrame:
    """Add the string fields cut to their widths; what is missing is empty."""
    return parsed.withColumns({k: F.when(_has(k), F.substring(_text(k), 1, n)).otherwise("") for k, n in WIDTHS.items()})


def long_value(text: Column) -> Column:
    """A whole number of at most 64 bits with an optional sign, and nothing around it; else null."""
    return F.when(text.rlike(r"\A[+-]?[0-9]+\z"), text.try_cast("bigint"))


def double_value(text: Column) -> Column:
    """A number as Java reads it: NaN and Infinity in that spelling only; else null."""
    plain = F.trim(text).rlike(r"\A[+-]?(NaN|Infinity|[0-9.].*|0[xX].*)\z")
    return F.when(plain, text.try_cast("double"))


def classify_events(raw: DataFrame, strict: bool = False) -> DataFrame:
    """Parse, check, repair and enrich raw records; the first check that fails, in the fields' order, decides.

    Adds the event's fields, server_timestamp, outcome, sanitized_fields, raw_json and
    processed_json (null unless the outcome is ok).
    """
    read = parse_json(raw)
    texts = {f"t_{k}": _text(k) for k in CHECKED} | {f"has_{k}": _has(k) for k in CHECKED}
    parsed = once(once(read, texts), {k: F.when(F.col(f"has_{k}"), F.substring(f"t_{k}", 1, n)).otherwise("") for k, n in WIDTHS.items()})
    charset = STRICT_CHARSET if strict else CHARSET
    there, said = (lambda k: F.col(f"has_{k}")), (lambda k: F.col(f"t_{k}"))
    wrong = [~there(k) if k == "event_timestamp" else (~there(k) | ~F.col(k).rlike(charset) if k in REQUIRED else there(k) & ~F.col(k).rlike(charset)) for k in CHECKED if k not in POSITIONS]
    broken = reduce(lambda a, b: a | b, wrong)
    number = long_value(said("event_timestamp"))
    doubles = {k: double_value(said(k)) for k in POSITIONS}
    changed = {k: there(k) & (F.length(said(k)) > n) for k, n in WIDTHS.items()}
    changed["event_timestamp"] = number.isNull() | (number < 0)
    changed |= {k: there(k) & doubles[k].isNull() for k in POSITIONS}
    values = once(parsed, {
        "outcome": F.when(F.col("raw_json").isNull() | ~(F.col("fields").isNotNull() | F.try_parse_json("raw_json").isNotNull()), PARSE_ERROR).when(F.coalesce(broken, F.lit(True)), VALIDATION_ERROR).otherwise(OK),
        "event_timestamp": F.when(changed["event_timestamp"], F.lit(0).cast("bigint")).otherwise(number),
        **{k: F.coalesce(doubles[k], F.lit(0.0)) for k in POSITIONS},
        "server_timestamp": F.unix_millis("arrival_ts"),
        "sanitized_fields": F.filter(F.array(*[F.when(changed[k], F.lit(k)) for k in CHECKED]), lambda x: x.isNotNull()),
    })
    ok = F.col("outcome") == OK
    fixed = F.map_from_entries(F.filter(
        F.array(
            *[F.when(F.array_contains("sanitized_fields", k), F.struct(F.lit(k).alias("key"), F.col(k).cast("variant").alias("value"))) for k in CHECKED],
            F.struct(F.lit("server_timestamp").alias("key"), F.col("server_timestamp").cast("variant").alias("value")),
        ),
        lambda x: x.isNotNull(),
    ))
    kept = F.map_filter("variants", lambda k, _: (k != "server_timestamp") & ~F.array_contains("sanitized_fields", k))
    return values.withColumns({
        "sanitized_fields": F.when(ok, F.col("sanitized_fields")).otherwise(F.array().cast("array<string>")),
        "processed_json": F.when(ok, F.concat(F.to_json(F.map_concat(kept, fixed)), F.lit("\n"))),
    }).drop("fields", "variants", *texts)


def split_good_bad(classified: DataFrame) -> tuple[DataFrame, DataFrame]:
    """Good events, repaired ones with them; and the errors: failed or repaired."""
    ok = F.col("outcome") == OK
    return classified.where(ok), classified.where(~ok | (F.size("sanitized_fields") > 0))


def error_records(bad: DataFrame) -> DataFrame:
    """The record of each error: reason, json, fields of repaired events, hex of failed ones."""
    ok = F.col("outcome") == OK
    return bad.select(
        "shard_id", "sequence_number", "arrival_ts",
        F.when(ok, "SanitizationException").when(F.col("outcome") == PARSE_ERROR, "TelemetryEventParseException").otherwise("TelemetryEventValidationException").alias("reason"),
        F.nullif("raw_json", F.lit("")).alias("json"),
        F.when(ok, F.col("sanitized_fields")).alias("fields"),
        F.when(~ok, F.nullif(hex_encode(F.col("data")), F.lit(""))).alias("hex"),
    )


def error_lines(errors: DataFrame) -> DataFrame:
    """Error records as JSON; what is empty is left out."""
    return errors.select("arrival_ts", F.to_json(F.struct("reason", "json", "fields", "hex")).alias("value"))
