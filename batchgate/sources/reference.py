"""Reading reference tables, and profiling them."""

from __future__ import annotations

from collections.abc import Sequence

from pyspark.sql import DataFrame, SparkSession
from pyspark.sql import functions as F

from batchgate.functions.keys import number_text
from batchgate.functions.types import coerce_known_types, normalise_nulls


def read_reference(
    source: DataFrame, lakeID: Sequence[str] | None = None, depthClass: Sequence[str] | None = None, **filters
) -> DataFrame:
    """A reference table: optional value filters (pushed into the scan), known types, nulls.

    ``source`` is any DataFrame: Parquet, JDBC, a catalog table.  Further keyword arguments filter
    other columns the same way.
    """
    wanted = {"lakeID": lakeID, "depthClass": depthClass, **filters}
    for column, values in wanted.items():
        if values is not None:
            source = source.filter(F.col(column).isin(*values))
    return normalise_nulls(coerce_known_types(source))


def reference_table(
    spark: SparkSession, name: str, root: str | None = None, lakeID: Sequence[str] | None = None, **filters
) -> DataFrame:
    """:func:`read_reference` of a table by name: a Parquet folder under ``root``, or a catalog table."""
    source = spark.read.parquet(f"{root.rstrip('/')}/{name}") if root else spark.table(name)
    return read_reference(source, lakeID=lakeID, **filters)


def list_tables(spark: SparkSession, database: str | None = None) -> list[str]:
    """Names of the tables in the catalog."""
    return sorted(t.name for t in spark.catalog.listTables(database))


def profile_columns(df: DataFrame, columns: Sequence[str] = ("lakeID", "depthClass")) -> DataFrame:
    """Type and distinct non-null values, with counts, of each column, sorted, in one pass.

    Rows are expanded and counted map-side; only distinct values are shuffled.  Numbers sort as such.
    """
    typed = coerce_known_types(df)
    kinds = dict(typed.dtypes)
    pairs = [
        F.struct(
            F.lit(c).alias("column"),
            F.lit(kinds[c]).alias("type"),
            (number_text(F.col(c)) if kinds[c] in ("double", "float") else F.col(c).cast("string")).alias("value"),
        )
        for c in columns
    ]
    return (
        typed.select(F.explode(F.array(*pairs)).alias("p"))
        .select("p.*")
        .filter("value is not null")
        .groupBy("column", "type", "value")
        .agg(F.count(F.lit(1)).alias("n"))
        .orderBy("column", F.when(~F.col("type").isin("string", "date"), F.col("value").try_cast("double")), "value")
    )
