"""Audits against the producers' contract and counts of outcomes."""

from __future__ import annotations

from pyspark.sql import DataFrame
from pyspark.sql import functions as F

from questlog.operators.parse import parse_json
from questlog.schemas import CONTRACT_PATTERNS, CONTRACT_REQUIRED


def audit_patterns(raw: DataFrame) -> DataFrame:
    """Per field, how many values that are there break the contract's pattern; one pass."""
    value = lambda k: F.element_at("fields", k)
    one = parse_json(raw, kinds=False).agg(*[F.count_if(value(k).isNotNull() & ~value(k).rlike(p)).alias(k) for k, p in CONTRACT_PATTERNS.items()])
    return one.unpivot([], list(CONTRACT_PATTERNS), "field", "broken")


def audit_required(raw: DataFrame, variant: str = "current") -> DataFrame:
    """Per required field, how many JSON objects lack it."""
    keys = list(CONTRACT_REQUIRED[variant])
    one = parse_json(raw, kinds=False).where("fields is not null").agg(*[F.count_if(~F.map_contains_key("fields", k)).alias(k) for k in keys])
    return one.unpivot([], keys, "field", "missing")


def audit_types(raw: DataFrame) -> DataFrame:
    """Per field and kind of JSON value, how many; numbers below the minimum of 0 apart."""
    keys = [*CONTRACT_PATTERNS, "event_timestamp", "position_x", "position_y"]
    pairs = parse_json(raw).select(F.explode(F.array(*[F.struct(F.lit(k).alias("field"), F.element_at("variants", k).alias("value")) for k in keys])).alias("p")).select("p.*")
    kind = F.schema_of_variant("value")
    name = F.when(F.col("value").isNull(), "missing").when(kind == "STRING", "string").when(kind.rlike("^(BIGINT|DECIMAL|DOUBLE|FLOAT)"), "number").when(kind == "VOID", "null").when(kind == "BOOLEAN", "boolean").when(kind.startswith("ARRAY"), "array").otherwise("object")
    below = F.coalesce(F.try_variant_get("value", "$", "double") < 0, F.lit(False)) & (name == "number") & (F.col("field") == "event_timestamp")
    return pairs.select("field", F.when(below, "below minimum").otherwise(name).alias("kind")).groupBy("field", "kind").agg(F.count("*").alias("records"))


def outcome_counts(classified: DataFrame) -> DataFrame:
    """Per shard: records that succeeded, could not be parsed, failed a check."""
    return classified.groupBy("shard_id").agg(*[F.count_if(F.col("outcome") == o).alias(n) for o, n in (("ok", "success"), ("parse_error", "parse_failures"), ("validation_error", "process_failures"))])


#: The name under which errors of a reason are reported.
ERROR_METRICS = {
    "SanitizationException": "NumSanitizationErrors", "TelemetryEventValidationException": "NumValidationErrors",
    "TelemetryEventSerializationException": "NumSerializationErrors", "TelemetryEventParseException": "NumParseErrors",
}
TOTAL = "TotalErrors"


def error_counts(errors: DataFrame) -> DataFrame:
    """Errors by reason with the metric that each is reported as, and their total."""
    total = F.col("g") == 1
    names = F.create_map(*[F.lit(x) for pair in ERROR_METRICS.items() for x in pair])
    counted = errors.rollup("reason").agg(F.count("*").alias("errors"), F.grouping("reason").alias("g"))
    return counted.select(F.when(total, TOTAL).otherwise(F.col("reason")).alias("reason"), F.when(total, TOTAL).otherwise(names[F.col("reason")]).alias("metric"), "errors")
