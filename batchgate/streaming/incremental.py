"""Admission of sheets as they arrive: a file stream, judged batch by batch.

The stream's checkpoint remembers which files were seen, so a second run over the same folder does
nothing.  A refused sheet counts as seen; its lines are kept in the quarantine table, from where
:func:`replay_quarantine` judges them again under new overrides.
"""

from __future__ import annotations

from dataclasses import replace

from pyspark.sql import DataFrame, SparkSession
from pyspark.sql import functions as F

from batchgate.operators.joins import splittable_on
from batchgate.operators.violations import as_violations
from batchgate.plans import fish
from batchgate.plans.admit import LINE_SCHEMA, QUARANTINE, SAMPLES, BatchConfig, BatchResult, run_batch
from batchgate.session import drop_staged, scratch_root
from batchgate.sources.accumulators import load_or_init
from batchgate.sources.sheets import is_sheet, line_tables, located, number_lines


LISTING_TASKS = "spark.sql.sources.parallelPartitionDiscovery.parallelism"


def sheet_stream(spark: SparkSession, path: str, max_files: int | None = None) -> DataFrame:
    """The folder as a stream of lines that know their file and split; no sheet is ever one value."""
    reader = spark.readStream
    if max_files is not None:
        reader = reader.option("maxFilesPerTrigger", max_files)
    return located(reader.text(path))


def run_incremental(
    spark: SparkSession,
    path: str,
    config: BatchConfig,
    checkpoint: str,
    mode: str = "file",
    max_files: int | None = None,
    prefix: str = "stream",
) -> None:
    """Admit everything new in the folder, each file on its own merits, then stop."""
    config = replace(config, mode=mode, keep_rejected=True)

    def judge(scan: DataFrame, epoch: int) -> None:
        # The epoch names the batch: a retried epoch is a new attempt at the same one.
        batch = f"{prefix}-{epoch:08d}"
        spark = scan.sparkSession
        scratch = f"{scratch_root(spark, config.root)}/{batch}"
        # What is in other files is not kept, but their names are: the scan is not run again for them.
        sheets = number_lines(scan.withColumn("value", F.when(is_sheet(F.col("entry_file")), F.col("value"))), scratch)
        others = as_violations(
            sheets.others,
            fish.RULES["unmatched_file"],
            column="entry_file",
            value=F.col("entry_file"),
            entry_file=F.col("entry_file"),
        )
        run_batch(spark, sheets, config, batch, extra=[others])
        drop_staged(spark, line_tables(scratch))

    stream = (
        sheet_stream(spark, path, max_files)
        .writeStream.option("checkpointLocation", checkpoint)
        .trigger(availableNow=True)
        .foreachBatch(judge)
    )
    # A round's files are listed by tasks, by default one for each up to 10,000: far more work than the listing.
    tasks, old = str(8 * spark.sparkContext.defaultParallelism), spark.conf.get(LISTING_TASKS)
    spark.conf.set(LISTING_TASKS, min(tasks, old, key=int))
    try:
        query = stream.start()
    finally:
        # The stream has taken its settings along.
        spark.conf.set(LISTING_TASKS, old)
    query.awaitTermination()


def replay_quarantine(spark: SparkSession, config: BatchConfig, batch_id: str) -> BatchResult:
    """Judge the quarantined sheets again, leaving out those admitted since."""
    kept = load_or_init(spark, config.root, QUARANTINE, LINE_SCHEMA).filter(F.col("batch_id") != batch_id)
    samples = load_or_init(spark, config.root, SAMPLES, fish.SAMPLE_SCHEMA).filter(F.col("batch_id") != batch_id)
    done = samples.select(F.col("entry_file").alias("done_file")).distinct()
    # A sheet may have been refused more than once, and changed in between: the latest batch counts.
    latest = kept.groupBy(F.col("entry_file").alias("file")).agg(F.max("batch_id").alias("last"))
    lines = kept.join(
        latest, splittable_on([kept["entry_file"], kept["batch_id"]], [latest["file"], latest["last"]]), "left_semi"
    ).select("entry_file", "line_no", "line")
    todo = lines.join(done, splittable_on([lines["entry_file"]], [done["done_file"]]), "left_anti")
    return run_batch(spark, todo, replace(config, keep_rejected=False), batch_id)
