"""The state of all tags, kept in buckets by tag.

A batch that is linked to it, or merged into it, is dealt to the buckets; the state itself is read in
place and never shuffled.  Each merge writes a folder of its own, as the old one is read meanwhile.
"""

from __future__ import annotations

import hashlib
from dataclasses import dataclass

from pyspark.sql import DataFrame, SparkSession

from batchgate.operators.linkage import merge_tag_states, only_asked


@dataclass(frozen=True)
class TagStore:
    """A stored state of tags (:func:`batchgate.operators.linkage.tag_state`) and its number of buckets."""

    state: DataFrame
    buckets: int

    def asked(self, recaptures: DataFrame) -> DataFrame:
        """The state of the recaptured tags."""
        return only_asked(self.state, recaptures, self.buckets)


def _name(path: str) -> str:
    return f"batchgate_tags_{hashlib.sha256(path.encode()).hexdigest()[:16]}"


def _write(state: DataFrame, path: str, buckets: int) -> TagStore:
    writer = state.write.format("parquet").bucketBy(buckets, "tag").sortBy("tag")
    writer.option("path", path).mode("overwrite").saveAsTable(_name(path))
    return TagStore(state.sparkSession.table(_name(path)), buckets)


def save_tags(state: DataFrame, path: str, buckets: int) -> TagStore:
    """Store a state of tags in a folder; each bucket is one file, written by one task."""
    return _write(state.repartition(buckets, "tag"), path, buckets)


def open_tags(spark: SparkSession, path: str, buckets: int) -> TagStore:
    """A stored state, with as many buckets as it was stored in; a session that does not know it learns of it."""
    columns = ", ".join(f"`{f.name}` {f.dataType.simpleString()}" for f in spark.read.parquet(path).schema)
    spark.sql(
        f"CREATE TABLE IF NOT EXISTS {_name(path)} ({columns}) USING parquet "
        f"CLUSTERED BY (tag) SORTED BY (tag) INTO {buckets} BUCKETS LOCATION '{path}'"
    )
    return TagStore(spark.table(_name(path)), buckets)


def merge_tags(kept: TagStore, new: DataFrame, path: str) -> TagStore:
    """Merge a state of more applies into a stored one, and store the result at another path.

    The joined buckets are written as they are, a file each.
    """
    dealt = new.repartition(kept.buckets, "tag")
    return _write(merge_tag_states(kept.state, dealt), path, kept.buckets)
