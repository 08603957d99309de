"""Merged statistics, and those that batches leave."""

from __future__ import annotations

import random

from pyspark.sql import functions as F

from batchgate.operators import outliers
from batchgate.plans import fish
from batchgate.plans.admit import BatchConfig, kept_statistics, run_batch
from sheetkit import NAME, fish_row, lines, reference, rules_found, sheet


def _rows(df):
    return {r["stat_group"]: [None if v is None else round(v, 6) for v in r[1:]] for r in df.collect()}


def test_parts_merge_to_the_whole(spark):
    rng = random.Random(8)
    rows = []
    for i in range(400):
        length = rng.choice([None, 0.0, -1.0, *[1e6 + rng.gauss(0, 5) for _ in range(9)]])
        weight = rng.choice([None, 0.0, *[1e7 * rng.lognormvariate(0, 0.1) for _ in range(9)]])
        rows.append((rng.choice(["a", "b", None]), rng.randrange(7), length, weight))
    rows += [("once", 1, 5.0, 2.0), ("twice", 1, 5.0, 2.0), ("twice", 2, 5.0, 3.0), ("never", 3, None, None)]
    df = spark.createDataFrame(rows, "otu string, part int, len double, wt double")
    parts = outliers.group_statistics(df, "otu", "len", "wt", part="part")
    assert parts.count() > 20
    whole = outliers.group_statistics(df, "otu", "len", "wt")
    merged = outliers.merge_statistics(parts.drop("part"))
    assert merged.columns == whole.columns
    assert _rows(merged) == _rows(whole)
    only_lengths = outliers.group_statistics(df, "otu", "len", part="part").drop("part")
    assert outliers.merge_statistics(only_lengths).columns == ["stat_group", "len_n", "len_mean", "len_sd"]


def test_batches_leave_their_moments(spark, tmp_path):
    tables = reference(spark)
    first = BatchConfig(tables, str(tmp_path / "season"))
    run_batch(spark, lines(spark, {NAME: sheet([fish_row(1), fish_row(2, "YWP", 215)])}), first, "b1")
    kept = kept_statistics(spark, first)
    admitted = spark.createDataFrame(
        [("largemouth_bass", 220.0, 106.5), ("yellow_perch", 215.0, 99.4)], "otu string, fishLength double, fishWeight double"
    )
    both = tables["records"].select("otu", "fishLength", "fishWeight").unionByName(admitted)
    assert _rows(kept) == _rows(fish.history_statistics(both))

    # Statistics that are kept take the place of a scan: these know only long fish.
    far = fish.history_statistics(both.withColumn("fishLength", F.col("fishLength") * 10))
    config = BatchConfig(tables, str(tmp_path / "other"), statistics=far)
    result = run_batch(spark, lines(spark, {NAME: sheet([fish_row(1)])}), config, "b1")
    assert "too_short" in rules_found(result.violations)
