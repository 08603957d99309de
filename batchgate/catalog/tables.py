"""The given tables, and the columns derived from them that stand in for batches and history."""

from __future__ import annotations

from pyspark.sql import Column, DataFrame, SparkSession
from pyspark.sql import functions as F

from batchgate.functions.keys import build_key, date_text, key_field, time_text
from batchgate.operators.linkage import tags_long

ORDER_CUTOFF = "2001-01-01"
EVENT_CUTOFF = "2024-01-21"


def table(spark: SparkSession, sf_dir: str, name: str) -> DataFrame:
    return spark.read.parquet(f"{sf_dir}/{name}.parquet")


def month(c: Column) -> Column:
    return F.substring(c.cast("string"), 1, 7)


def split_at(df: DataFrame, column: str, cutoff: str) -> tuple[DataFrame, DataFrame]:
    """The batch (on or after the cutoff) and the history (before it): together, the whole table."""
    at = F.lit(cutoff).cast("timestamp_ntz")
    return df.filter(F.col(column) >= at), df.filter(F.col(column) < at)


def orders(spark: SparkSession, sf_dir: str) -> DataFrame:
    return table(spark, sf_dir, "orders").withColumn("entry_file", month(F.col("o_orderdate")))


def lineitem(spark: SparkSession, sf_dir: str) -> DataFrame:
    return table(spark, sf_dir, "lineitem").withColumn("entry_file", month(F.col("l_shipdate")))


def events(spark: SparkSession, sf_dir: str) -> DataFrame:
    return table(spark, sf_dir, "events").withColumn("entry_file", F.substring(F.col("ts").cast("string"), 1, 10))


# Events as mark-recapture records: a signup applies a tag, a purchase recaptures one.
TAGGED_SQL = """
tagged as (
  select *, cast(user_id as varchar) || '-' || right(regexp_extract(props, '([0-9]+)', 1), 1) as tag,
         case when minute(ts) < 30 then 'pit' else 'floy' end as tag_type,
         case when value < 50 then 'A' else 'B' end as species,
         case when hour(ts) < 8 then 'L0' when hour(ts) < 16 then 'L1' else 'L2' end as lake,
         case when hour(ts) < 8 then 'L0' when hour(ts) < 16 then 'L1' else 'L2' end || '_' || user_id || '_'
           || strftime(ts, '%Y%m%d_%H%M') || '_' || event_type || '_' || event_id as fish_id,
         strftime(ts, '%Y-%m-%d') as entry_file
  from events)
"""


def tagged_events(spark: SparkSession, sf_dir: str) -> DataFrame:
    clock = F.substring(F.col("ts").cast("string"), 12, 5)
    k = F.regexp_extract("props", "([0-9]+)", 1)
    tag = F.concat_ws("-", F.col("user_id").cast("string"), F.right(k, F.lit(1)))
    is_pit = F.substring(clock, 4, 2) < "30"
    lake = F.when(clock < "08:00", "L0").when(clock < "16:00", "L1").otherwise("L2")
    applies = F.col("event_type") == "signup"
    recaptures = F.col("event_type") == "purchase"
    e = events(spark, sf_dir).select(
        "event_id",
        "ts",
        "value",
        "entry_file",
        F.when(F.col("value") < 50, "A").otherwise("B").alias("otu"),
        build_key(
            lake, F.col("user_id"), date_text(F.col("ts")), time_text(F.col("ts")), F.col("event_type"), F.col("event_id")
        ).alias("fishID"),
        F.when(applies & is_pit, tag).alias("pitApply"),
        F.when(applies & ~is_pit, tag).alias("floyApply"),
        F.when(recaptures & is_pit, tag).alias("pitRecapture"),
        F.when(recaptures & ~is_pit, tag).alias("floyRecapture"),
    )
    return e


def event_applies(spark: SparkSession, sf_dir: str) -> DataFrame:
    """Tag applies in registry form; events before the cutoff come from history (source 0)."""
    at = F.lit(EVENT_CUTOFF).cast("timestamp_ntz")
    return tags_long(
        tagged_events(spark, sf_dir),
        {
            "apply_id": F.col("fishID"),
            "apply_species": F.col("otu"),
            "apply_lake": key_field(F.col("fishID"), 1),
            "apply_date": F.col("ts").cast("date"),
            "apply_length": F.col("value"),
            "source": F.when(F.col("ts") < at, 0).otherwise(1),
        },
        {"pit": "pitApply", "floy": "floyApply"},
        "apply_type",
        "tag",
    )


def event_recaptures(spark: SparkSession, sf_dir: str) -> DataFrame:
    return tags_long(
        tagged_events(spark, sf_dir),
        {
            "recap_id": F.col("fishID"),
            "recap_species": F.col("otu"),
            "recap_lake": key_field(F.col("fishID"), 1),
            "recap_date": F.col("ts").cast("date"),
            "recap_length": F.col("value"),
            "entry_file": F.col("entry_file"),
        },
        {"pit": "pitRecapture", "floy": "floyRecapture"},
        "recap_type",
        "recap_tag",
    )
