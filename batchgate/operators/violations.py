"""The one table every rule writes to."""

from __future__ import annotations

from collections.abc import Iterable, Mapping
from dataclasses import dataclass
from functools import reduce

from pyspark.sql import Column, DataFrame, SparkSession
from pyspark.sql import functions as F
from pyspark.sql import types as T

VIOLATION_SCHEMA = T.StructType(
    [
        T.StructField("rule", T.StringType()),
        T.StructField("rule_order", T.IntegerType()),
        T.StructField("severity", T.StringType()),
        T.StructField("forceable", T.BooleanType()),
        T.StructField("force_keys", T.ArrayType(T.StringType())),
        T.StructField("entity", T.StringType()),
        T.StructField("column", T.StringType()),
        T.StructField("value", T.StringType()),
        T.StructField("entry_file", T.StringType()),
        T.StructField("detail", T.MapType(T.StringType(), T.StringType())),
    ]
)
VIOLATION_COLUMNS = VIOLATION_SCHEMA.fieldNames()


@dataclass(frozen=True)
class Rule:
    """Identity of a rule: its place in the reporting order and what may force it.

    A violation is released only when *all* of ``force_keys`` are forced; without keys it cannot be.
    """

    name: str
    order: int = 0
    severity: str = "error"
    force_keys: tuple[str, ...] = ()


def _text(c: Column | str | None) -> Column:
    if c is None:
        return F.lit(None).cast("string")
    if isinstance(c, str):
        return F.lit(c)
    return c.cast("string")


def rule_columns(rule: Rule) -> list[Column]:
    keys = F.array(*[F.lit(k) for k in rule.force_keys]).cast("array<string>")
    return [
        F.lit(rule.name).alias("rule"),
        F.lit(rule.order).alias("rule_order"),
        F.lit(rule.severity).alias("severity"),
        F.lit(bool(rule.force_keys)).alias("forceable"),
        keys.alias("force_keys"),
    ]


def detail_map(detail: Mapping[str, Column | str] | None) -> Column:
    if not detail:
        return F.lit(None).cast("map<string,string>")
    return F.create_map(*[x for k, v in detail.items() for x in (F.lit(k), _text(v))])


def as_violations(
    df: DataFrame,
    rule: Rule,
    *,
    entity: Column | str | None = None,
    column: Column | str | None = None,
    value: Column | str | None = None,
    entry_file: Column | str | None = None,
    detail: Mapping[str, Column | str] | None = None,
) -> DataFrame:
    """Each row of ``df`` becomes one violation of ``rule``.  Plain strings are literals."""
    return df.select(
        *rule_columns(rule),
        _text(entity).alias("entity"),
        _text(column).alias("column"),
        _text(value).alias("value"),
        _text(entry_file).alias("entry_file"),
        detail_map(detail).alias("detail"),
    )


@dataclass(frozen=True)
class Finding:
    """One row-wise test: the rows where ``when`` holds break ``rule``."""

    rule: Rule
    when: Column
    column: Column | str | None = None
    value: Column | str | None = None
    detail: Mapping[str, Column | str] | None = None


def row_violations(
    df: DataFrame, findings: Iterable[Finding], *, entity: Column | str | None, entry_file: Column | str | None
) -> DataFrame:
    """All row-wise tests in one pass over ``df``: a row yields one violation per test it breaks."""
    structs = [
        F.when(
            f.when,
            F.struct(
                *rule_columns(f.rule),
                _text(entity).alias("entity"),
                _text(f.column).alias("column"),
                _text(f.value).alias("value"),
                _text(entry_file).alias("entry_file"),
                detail_map(f.detail).alias("detail"),
            ),
        )
        for f in findings
    ]
    any_broken = reduce(lambda a, b: a | b, [F.coalesce(f.when, F.lit(False)) for f in findings])
    return (
        df.filter(any_broken)
        .select(F.explode(F.filter(F.array(*structs), lambda s: s.isNotNull())).alias("v"))
        .select("v.*")
    )


def union_violations(spark: SparkSession, parts: Iterable[DataFrame]) -> DataFrame:
    parts = [p.select(*VIOLATION_COLUMNS) for p in parts]
    if not parts:
        return spark.createDataFrame([], VIOLATION_SCHEMA)
    # In pairs: a union is analysed with all that is below it, which part by part would be every part again and again.
    while len(parts) > 1:
        parts = [reduce(DataFrame.unionByName, parts[i : i + 2]) for i in range(0, len(parts), 2)]
    return parts[0]
