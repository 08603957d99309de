"""Row-wise bounds."""

from __future__ import annotations

from pyspark.sql import Column, DataFrame
from pyspark.sql import functions as F

from batchgate.operators.violations import Finding, Rule, row_violations


def out_of_range(
    c: Column, low: float, high: float, allow_low: bool = False, allow_high: bool = False
) -> Column:
    """True outside (low, high); each end may be allowed.  Nulls pass."""
    below = (c < low) if allow_low else (c <= low)
    above = (c > high) if allow_high else (c >= high)
    return below | above


def range_finding(
    column: str, low: float, high: float, allow_low: bool = False, allow_high: bool = False, rule: Rule | None = None
) -> Finding:
    c = F.col(column)
    return Finding(
        rule or Rule("range_" + column),
        out_of_range(c, low, high, allow_low, allow_high),
        column,
        c,
        {"low": F.lit(low), "high": F.lit(high)},
    )


def check_range(
    df: DataFrame,
    column: str,
    low: float,
    high: float,
    allow_low: bool = False,
    allow_high: bool = False,
    rule: Rule | None = None,
    entity: str | None = None,
    entry_file: str = "entry_file",
) -> DataFrame:
    finding = range_finding(column, low, high, allow_low, allow_high, rule)
    return row_violations(df, [finding], entity=F.col(entity) if entity else None, entry_file=F.col(entry_file))


def positive_finding(column: str, rule: Rule | None = None) -> Finding:
    return Finding(rule or Rule("not_positive_" + column), F.col(column) <= 0, column, F.col(column))


def cap_finding(column: str, cap: float, rule: Rule | None = None) -> Finding:
    return Finding(
        rule or Rule("cap_" + column), F.col(column) >= cap, column, F.col(column), {"cap": F.lit(cap)}
    )


def check_positive(
    df: DataFrame, columns: list[str], rule: Rule | None = None, entity: str | None = None, entry_file: str = "entry_file"
) -> DataFrame:
    """Measures that are zero or negative."""
    return row_violations(
        df,
        [positive_finding(c, rule) for c in columns],
        entity=F.col(entity) if entity else None,
        entry_file=F.col(entry_file),
    )


def check_absolute_cap(
    df: DataFrame, caps: dict[str, float], rule: Rule | None = None, entity: str | None = None, entry_file: str = "entry_file"
) -> DataFrame:
    """Measures at or above a fixed cap."""
    return row_violations(
        df,
        [cap_finding(c, cap, rule) for c, cap in caps.items()],
        entity=F.col(entity) if entity else None,
        entry_file=F.col(entry_file),
    )
