"""Columns that are worked out once for each row, whatever is built on them."""

from __future__ import annotations

from pyspark.sql import Column, DataFrame
from pyspark.sql import functions as F


def once(df: DataFrame, columns: dict[str, Column]) -> DataFrame:
    """Add columns as one generated row. A filter above is not rewritten in terms of what they are
    made of, so a JSON text that many columns come from is parsed once, not once for each of them."""
    kept = [c for c in df.columns if c not in columns]
    return df.select(*kept, F.inline(F.array(F.struct(*[c.alias(n) for n, c in columns.items()]))))
