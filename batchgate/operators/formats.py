"""Text formats: shape profiles and pattern tests."""

from __future__ import annotations

from collections.abc import Mapping, Sequence

from pyspark.sql import Column, DataFrame
from pyspark.sql import functions as F

from batchgate.functions.text import shape
from batchgate.operators.violations import Rule, as_violations


def format_profile(df: DataFrame, column: str, distinct: bool = True) -> DataFrame:
    """Shapes of a text column: each with its count, or one per row."""
    shaped = df.select(shape(F.col(column)).alias("format"))
    return shaped.groupBy("format").agg(F.count(F.lit(1)).alias("n")) if distinct else shaped


def check_formats(
    df: DataFrame,
    columns: Mapping[str, str] | Sequence[str],
    pattern: str,
    entity: str,
    rule: Rule | None = None,
    entry_file: str = "entry_file",
) -> DataFrame:
    """Values of the given columns that do not contain ``pattern``.

    ``columns`` may map each column to the label it is reported under.  Nulls pass.
    """
    labels = dict(columns) if isinstance(columns, Mapping) else {c: c for c in columns}
    long = df.select(
        F.col(entity).alias("entity"),
        F.col(entry_file).alias("entry_file"),
        *[F.col(c).cast("string").alias(label) for c, label in labels.items()],
    ).unpivot(["entity", "entry_file"], list(labels.values()), "column", "value")
    bad = long.filter(F.col("value").isNotNull() & ~F.col("value").rlike(pattern))
    return as_violations(
        bad,
        rule or Rule("format_" + "_".join(labels.values())),
        entity=F.col("entity"),
        column=F.col("column"),
        value=F.col("value"),
        entry_file=F.col("entry_file"),
        detail={"pattern": pattern},
    )


def check_conditional_pattern(
    df: DataFrame,
    condition: Column,
    column: str,
    pattern: str,
    rule: Rule | None = None,
    entity: str | None = None,
    entry_file: str = "entry_file",
) -> DataFrame:
    """Rows under ``condition`` whose text misses the pattern; missing text misses it too."""
    c = F.col(column)
    rows = df.filter(condition & ~F.coalesce(c.rlike(pattern), F.lit(False)))
    return as_violations(
        rows,
        rule or Rule("pattern_" + column),
        entity=F.col(entity) if entity else None,
        column=column,
        value=c,
        entry_file=F.col(entry_file),
    )
