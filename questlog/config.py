"""Limits of the jobs; every one is a parameter of the function that uses it."""

from __future__ import annotations

from dataclasses import dataclass


@dataclass(frozen=True)
class Limits:
    """The defaults of a production deployment; DEMO has those of a demonstration."""

    flush_records: int = 500_000
    flush_bytes: int = 104_857_600
    flush_ms: int = 600_000
    load_files: int = 36
    retention_months: int = 6
    producer_batch: int = 100
    metric_dimensions: int = 10
    grid: int = 25


DEMO = Limits(flush_records=5, flush_bytes=1024, flush_ms=10_000, load_files=5)
