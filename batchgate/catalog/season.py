"""Sheets that arrive as a file stream, judged in rounds, one of which is run again."""

from __future__ import annotations

from pyspark.sql import functions as F

from batchgate.catalog import query
from batchgate.catalog.sheetdata import SEASON_SQL, fresh_folder, season_files
from batchgate.plans import fish
from batchgate.plans.admit import LINE_SCHEMA, QUARANTINE, RECORDS, BatchConfig
from batchgate.session import stage
from batchgate.sources.accumulators import load_or_init
from batchgate.streaming.incremental import run_incremental


def _reference(spark):
    """One earlier sample, whose vocabulary holds, and a dictionary of one code: whatever else is new is forced."""
    empty = {"lakes": "lakeID string", "sites": "siteID string", "records": fish.RECORD_SCHEMA}
    tables = {name: spark.createDataFrame([], schema) for name, schema in empty.items()}
    known = {"useCPUE": "yes", "useSampleMarkRecap": "no"}
    sample = [F.lit(known.get(f.name)).cast(f.dataType).alias(f.name) for f in fish.SAMPLE_SCHEMA.fields]
    tables["samples"] = spark.range(1).select(*sample)
    codes = spark.range(1).select(
        F.lit("largemouth_bass").alias("otu"), F.lit("LMB").alias("abbreviation"), F.lit("fish").alias("grouping")
    )
    return tables | {"otu": codes}


def forget_last_round(spark, checkpoint: str) -> None:
    """Take the last round's entry from a stream's log of finished rounds, as if the run had died before it."""
    path = spark._jvm.org.apache.hadoop.fs.Path(f"{checkpoint}/commits")
    files = path.getFileSystem(spark._jsc.hadoopConfiguration())
    rounds = [int(f.getPath().getName()) for f in files.listStatus(path) if f.getPath().getName().isdigit()]
    if rounds:
        files.delete(spark._jvm.org.apache.hadoop.fs.Path(path, str(max(rounds))), False)


@query(
    "q_stream",
    "with "
    + SEASON_SQL.strip()
    + """
select entry_file, case when refused then 'refused' else 'admitted' end as state, count(*) as n,
  case when not refused then sum(length) end as total,
  count(*) filter (not refused and flag = 'R') as otoliths
from d group by entry_file, refused""",
)
def stream(spark, sf):
    """Two rounds of a stream, the second run twice; records, logs and refused lines are read back."""
    folder = fresh_folder(spark)
    sheets = stage(season_files(spark, sf, f"{folder}/in"), f"{folder}/written").count()
    config = BatchConfig(_reference(spark), f"{folder}/season", force=fish.FORCE_KEYS)
    for _ in range(2):
        run_incremental(spark, f"{folder}/in", config, f"{folder}/seen", max_files=max(1, -(-sheets // 2)))
        forget_last_round(spark, f"{folder}/seen")

    def season(name, schema):
        return load_or_init(spark, config.root, name, schema)

    admitted = season(RECORDS, fish.RECORD_SCHEMA).groupBy("entry_file").agg(
        F.count(F.lit(1)).alias("n"), F.sum("fishLength").alias("total")
    )
    otoliths = season("otolith_log", fish.LOG_SCHEMAS["otolith_log"]).groupBy("entry_file").agg(F.count(F.lit(1)).alias("otoliths"))
    admitted = admitted.join(otoliths, "entry_file", "left")
    refused = season(QUARANTINE, LINE_SCHEMA).filter("line_no > 18").groupBy("entry_file").agg(F.count(F.lit(1)).alias("n"))
    columns = ("entry_file", "state", "n", "total", "otoliths")
    return (
        admitted.withColumn("state", F.lit("admitted"))
        .unionByName(refused.withColumn("state", F.lit("refused")), allowMissingColumns=True)
        .withColumn("otoliths", F.coalesce("otoliths", F.lit(0)))
        .select(*columns)
    )
