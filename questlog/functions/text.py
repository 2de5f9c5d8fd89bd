"""Bytes, hex and JSON as column expressions."""

from __future__ import annotations

from pyspark.sql import Column
from pyspark.sql import functions as F

#: A strict reader: double quotes only, no NaN; trailing text is ignored and the last of repeated keys wins.
JSON_OPTIONS = {"allowSingleQuotes": "false", "allowNonNumericNumbers": "false"}


def decode_utf8(data: Column) -> Column:
    """Bytes as text, malformed ones replaced."""
    return F.make_valid_utf8(data.cast("string"))


def hex_encode(data: Column) -> Column:
    """Lower-case hex; empty for null."""
    return F.coalesce(F.lower(F.hex(data)), F.lit(""))


def hex_decode(text: Column) -> Column:
    """Bytes of hex in either case, a 0 put after an odd number of digits; null and empty give no bytes, wrong digits null."""
    padded = F.concat(text, F.when(F.length(text) % 2 == 1, "0").otherwise(""))
    return F.when(text.isNull(), F.lit(b"")).otherwise(F.unhex(padded))


def parse_map(raw: Column) -> Column:
    """Keys and values of a JSON object as text; null if it is no object."""
    return F.from_json(raw, "map<string,string>", JSON_OPTIONS)


def parse_variants(raw: Column) -> Column:
    """Keys and values of a JSON object with their kinds kept."""
    return F.from_json(raw, "map<string,variant>", JSON_OPTIONS)


def is_container(value: Column) -> Column:
    return F.coalesce(F.schema_of_variant(value).rlike("^(OBJECT|ARRAY)"), F.lit(False))
