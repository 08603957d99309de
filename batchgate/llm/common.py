"""What the corpus operators share: reading tables and staging in the cluster's shared folder."""

from __future__ import annotations

import tempfile
import uuid
import zipfile
from collections.abc import Callable
from functools import cache
from pathlib import Path

from pyspark.sql import Column, DataFrame, SparkSession
from pyspark.sql import functions as F

import batchgate

DOCUMENT_COLUMNS = ("doc_id", "text", "lang", "source", "n_chars")


def table(spark: SparkSession, sf_dir: str, name: str) -> DataFrame:
    return spark.read.parquet(f"{sf_dir}/{name}.parquet")


#: Rows that a Python worker and the JVM hold at once; texts are long, and some are very long.
BATCH_ROWS = 256


def ship(spark: SparkSession) -> SparkSession:
    """Give this library to the session's Python workers, once a session, and small batches to work on."""
    spark.conf.set("spark.sql.execution.arrow.maxRecordsPerBatch", BATCH_ROWS)
    _ship(spark, spark.sparkContext.applicationId)
    return spark


@cache
def _ship(spark: SparkSession, _application: str) -> None:
    top = Path(batchgate.__file__).parent
    archive = Path(_own_folder(), f"{top.name}-{uuid.uuid4().hex}.zip")
    with zipfile.ZipFile(archive, "w") as z:
        for p in top.rglob("*.py"):
            z.write(p, p.relative_to(top.parent))
    spark.sparkContext.addPyFile(str(archive))


@cache
def _own_folder() -> str:
    return tempfile.mkdtemp(prefix="batchgate-llm-")


def shared_path(spark: SparkSession, label: str) -> str:
    """A new path in the folder that driver and executors share.

    Only a local session without ``spark.checkpoint.dir`` gets a folder of its own; on a cluster the
    setting is required, as a machine-local folder would lose rows.
    """
    root = spark.conf.get("spark.checkpoint.dir", None)
    if not root:
        if not spark.sparkContext.master.startswith("local"):
            raise ValueError("set spark.checkpoint.dir to a folder that all executors share")
        root = _own_folder()
    return f"{root.rstrip('/')}/llm-{label}-{uuid.uuid4().hex}"


def stage(df: DataFrame, label: str) -> DataFrame:
    """Write ``df`` to the shared folder and read it back, which cuts the lineage and gives true sizes."""
    path = shared_path(df.sparkSession, label)
    df.write.parquet(path)
    return df.sparkSession.read.schema(df.schema).parquet(path)


#: Rows of ids, 16 bytes each, up to which a side of a join is broadcast.
BROADCAST_ROWS = 1 << 20


def bounded(ids: DataFrame, more: Column | None = None) -> DataFrame:
    """``ids``, staged by the caller, marked for broadcast if it is proven small; else as it is.

    ``more`` is how many times 16 bytes a row has beside its id.
    """
    rows = F.count("*") if more is None else F.coalesce(F.sum(1 + more), F.lit(0))
    return F.broadcast(ids) if ids.agg(rows).first()[0] <= BROADCAST_ROWS else ids


def splittable(left: DataFrame, right: DataFrame, key: str, how: str) -> DataFrame:
    """Join on ``key`` so that a hot key of ``left`` can be split.

    Adaptive execution splits a key's rows only where both sides are shuffled for the join alone.
    ``right`` was mostly just grouped by the key; compared as a struct it is shuffled anew.  Null keys
    match nothing.
    """
    named = F.struct(F.col(key).alias("k"))
    a = left.withColumn("_k", F.when(F.col(key).isNotNull(), named))
    b = right.withColumn("_k", F.when(F.col(key).isNotNull(), named)).drop(key)
    return a.join(b, "_k", how).drop("_k")


def let(value: Column, body: Callable[[Column], Column]) -> Column:
    """``body`` of ``value``, which is computed once however often the body uses it."""
    return F.get(F.transform(F.array(value), body), F.lit(0))
