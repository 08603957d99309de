"""Session settings and the shared scratch folder."""

from __future__ import annotations

import hashlib
from collections.abc import Iterable

from pyspark.sql import DataFrame, SparkSession

# Runtime settings the operators rely on; all may be set on a running session.
SETTINGS = {
    "spark.sql.adaptive.enabled": "true",
    "spark.sql.adaptive.coalescePartitions.enabled": "true",
    "spark.sql.adaptive.skewJoin.enabled": "true",
    # Split a skewed join even when that costs a later shuffle: one hot file or tag must not own a task.
    "spark.sql.adaptive.forceOptimizeSkewedJoin": "true",
    # Sheets hold wall-clock times.
    "spark.sql.parquet.inferTimestampNTZ.enabled": "true",
}


def configure(spark: SparkSession) -> SparkSession:
    for key, value in SETTINGS.items():
        spark.conf.set(key, value)
    return spark


def scratch_root(spark: SparkSession, root: str) -> str:
    """Shared folder for the staged tables of the accumulators at ``root``.

    It lies in the folder the cluster names, apart from that of other accumulators; where none is
    named, next to the accumulators themselves.
    """
    named = spark.conf.get("spark.checkpoint.dir", None)
    if not named:
        return f"{root.rstrip('/')}/_staging"
    return f"{named.rstrip('/')}/batchgate-{hashlib.sha256(root.encode()).hexdigest()[:16]}"


def stage(df: DataFrame, path: str) -> DataFrame:
    """Write a table and read it back.

    This cuts the lineage in storage that outlives executors, lets several consumers share the work,
    and gives Catalyst true sizes to choose joins by.
    """
    df.write.mode("overwrite").parquet(path)
    return df.sparkSession.read.schema(df.schema).parquet(path)


def drop_staged(spark: SparkSession, paths: Iterable[str]) -> None:
    """Delete staged tables that nothing reads any more."""
    for p in paths:
        path = spark._jvm.org.apache.hadoop.fs.Path(p)
        path.getFileSystem(spark._jsc.hadoopConfiguration()).delete(path, True)
