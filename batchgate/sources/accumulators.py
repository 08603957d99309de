"""Append-only tables whose batches become visible as a whole.

Each run of a batch is an attempt with folders of its own, ``batch_id=<id>/attempt=<attempt>``, so it
overwrites nothing.  When all its tables are written, one row is added to the table of commits; readers
take only rows of the attempt that a batch committed last.  Until then, and for ever if the run dies, its
rows count for nobody, and running the batch again puts the new attempt in place of the old one at once.
"""

from __future__ import annotations

import uuid
from collections.abc import Iterable, Mapping

from pyspark.errors import AnalysisException
from pyspark.sql import Column, DataFrame, SparkSession
from pyspark.sql import functions as F
from pyspark.sql import types as T

COMMITS, KINDS = "commits", "kinds"
COMMIT_SCHEMA = T.StructType(
    [
        T.StructField("batch_id", T.StringType()),
        T.StructField("attempt", T.StringType()),
        T.StructField("number", T.LongType()),
    ]
)


def table_path(root: str, name: str) -> str:
    return f"{root.rstrip('/')}/{name}"


def _attempt_path(root: str, name: str, batch_id: str, attempt: str) -> str:
    return f"{table_path(root, name)}/batch_id={batch_id}/attempt={attempt}"


def new_attempt() -> str:
    return f"a{uuid.uuid4().hex}"


def _read(spark: SparkSession, path: str, schema: T.StructType, **options: str) -> DataFrame | None:
    try:
        return spark.read.options(**options).schema(schema).parquet(path)
    except AnalysisException as e:
        if e.getCondition() == "PATH_NOT_FOUND":
            return None
        raise


def committed(spark: SparkSession, root: str) -> DataFrame:
    """``batch_id, attempt`` of each batch's last commit; as many rows as there are batches."""
    rows = _read(spark, table_path(root, COMMITS), COMMIT_SCHEMA)
    if rows is None:
        rows = spark.createDataFrame([], COMMIT_SCHEMA)
    last = F.max(F.struct("number", "attempt"))["attempt"]
    return rows.groupBy("batch_id").agg(last.alias("attempt"))


def commit_batch(spark: SparkSession, root: str, batch_id: str, attempt: str) -> None:
    """Make an attempt the one that counts: a single file, which appears at once."""
    path = table_path(root, COMMITS)
    rows = _read(spark, path, COMMIT_SCHEMA)
    earlier = rows.filter(F.col("batch_id") == batch_id).agg(F.max("number")).first()[0] if rows is not None else None
    row = spark.createDataFrame([(batch_id, attempt, (earlier or 0) + 1)], COMMIT_SCHEMA)
    row.coalesce(1).write.mode("append").parquet(path)


def _all_attempts(spark: SparkSession, root: str, name: str, schema: T.StructType) -> DataFrame | None:
    """All rows of a table, or of one kind of the tables that are written together."""
    parts = [T.StructField("batch_id", T.StringType()), T.StructField("attempt", T.StringType())]
    full = T.StructType([*schema.fields, *parts])
    rows = _read(spark, table_path(root, name), full)
    if rows is not None:
        return rows
    rows = _read(spark, table_path(root, KINDS), T.StructType([*full.fields, T.StructField("kind", T.StringType())]))
    return None if rows is None else rows.filter(F.col("kind") == name).drop("kind")


def load_or_init(spark: SparkSession, root: str, name: str, schema: T.StructType) -> DataFrame:
    """The accumulated rows of all committed batches with their ``batch_id``, or an empty table."""
    columns = [*schema.fieldNames(), "batch_id"]
    rows = _all_attempts(spark, root, name, schema)
    if rows is None:
        return spark.createDataFrame([], T.StructType([*schema.fields, T.StructField("batch_id", T.StringType())]))
    return rows.join(committed(spark, root), ["batch_id", "attempt"], "left_semi").select(*columns)


def read_attempt(
    spark: SparkSession, root: str, name: str, schema: T.StructType, batch_id: str, attempt: str
) -> DataFrame:
    """The rows of one attempt, committed or not."""
    rows = spark.read.schema(schema).parquet(_attempt_path(root, name, batch_id, attempt))
    return rows.withColumn("batch_id", F.lit(batch_id))


def _projected(df: DataFrame, schema: T.StructType) -> list[Column]:
    """The columns of a table's schema; those that the rows lack are null."""
    have = set(df.columns)
    return [
        (F.col(f"`{f.name}`") if f.name in have else F.lit(None)).cast(f.dataType).alias(f.name) for f in schema.fields
    ]


def append_batch(
    df: DataFrame, root: str, name: str, batch_id: str, schema: T.StructType, attempt: str, compact: bool = False
) -> None:
    """Write an attempt's rows, projected to the table's schema.

    ``compact`` evens out the files first, for results that are small but spread over many tasks.
    """
    out = df.select(*_projected(df, schema))
    if compact:
        out = out.hint("rebalance")
    out.write.mode("overwrite").parquet(_attempt_path(root, name, batch_id, attempt))


def append_kinds(df: DataFrame, root: str, batch_id: str, schemas: Mapping[str, T.StructType], attempt: str) -> None:
    """Write the rows of several tables in one job: ``kind`` names the table, each has its own columns.

    Afterwards each kind is read by its name like any table.  A column that two tables share has one type.
    """
    fields = {f.name: f for schema in schemas.values() for f in schema.fields}
    out = df.select("kind", *_projected(df, T.StructType(list(fields.values()))))
    out.hint("rebalance", "kind").write.partitionBy("kind").mode("overwrite").parquet(
        _attempt_path(root, KINDS, batch_id, attempt)
    )


def expire_attempts(spark: SparkSession, root: str, names: Iterable[str]) -> int:
    """Delete folders of attempts that no batch counts; returns how many.

    Only for a time when no batch runs, as a running one is not committed yet.
    """
    live = {(r["batch_id"], r["attempt"]) for r in committed(spark, root).collect()}
    gone = 0
    for name in [*names, KINDS]:
        top = spark._jvm.org.apache.hadoop.fs.Path(table_path(root, name))
        files = top.getFileSystem(spark._jsc.hadoopConfiguration())
        found = files.globStatus(spark._jvm.org.apache.hadoop.fs.Path(top, "batch_id=*/attempt=*")) or []
        for status in found:
            path = status.getPath()
            key = path.getParent().getName().removeprefix("batch_id="), path.getName().removeprefix("attempt=")
            if key not in live:
                gone += bool(files.delete(path, True))
    return gone
