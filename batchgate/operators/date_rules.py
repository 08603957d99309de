"""Consistency of set and sample times, and of the time held in the key."""

from __future__ import annotations

from pyspark.sql import DataFrame
from pyspark.sql import functions as F

from batchgate.functions.keys import key_timestamp
from batchgate.operators.violations import Finding, Rule, row_violations


def order_finding(earlier: str, later: str, rule: Rule | None = None) -> Finding:
    """``later`` lies before ``earlier``."""
    return Finding(
        rule or Rule(f"{later}_before_{earlier}"),
        F.col(later) < F.col(earlier),
        later,
        F.col(later),
        {earlier: F.col(earlier)},
    )


def date_part_finding(date: str, timestamp: str, rule: Rule | None = None) -> Finding:
    """``date`` is not the day of ``timestamp``."""
    return Finding(
        rule or Rule(f"{date}_not_{timestamp}"),
        F.col(date) != F.col(timestamp).cast("date"),
        date,
        F.col(date),
        {timestamp: F.col(timestamp)},
    )


def key_time_finding(key: str, timestamp: str, rule: Rule | None = None, position: int = 3) -> Finding:
    """The minute in the key is not the full time, seconds included."""
    return Finding(
        rule or Rule(f"{key}_not_{timestamp}"),
        key_timestamp(F.col(key), position) != F.col(timestamp),
        key,
        F.col(key),
        {timestamp: F.col(timestamp)},
    )


def check_dates(
    df: DataFrame, findings: list[Finding], entity: str | None = None, entry_file: str = "entry_file"
) -> DataFrame:
    """All date tests in one pass."""
    return row_violations(
        df, findings, entity=F.col(entity) if entity else None, entry_file=F.col(entry_file)
    )
