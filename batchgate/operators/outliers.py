"""Outliers against the history of the same group: three deviations from the mean, and a regression band.

History is aggregated once per group (counts, means, centred moments: all mergeable, so a group that
holds a third of history is combined map-side), and the batch joins one row per group.
"""

from __future__ import annotations

from pyspark.sql import Column, DataFrame
from pyspark.sql import functions as F

from batchgate.functions.stats import (
    measure_moments,
    merged_measure,
    merged_regression,
    prediction_bounds,
    regression_fit,
    regression_moments,
)
from batchgate.operators.joins import splittable_on
from batchgate.operators.violations import Finding, Rule, row_violations

MIN_HISTORY = 15
DEVIATIONS = 3.0
LEVEL = 0.99


def group_statistics(
    history: DataFrame,
    group: str,
    length: str,
    weight: str | None = None,
    batch: DataFrame | None = None,
    part: str | None = None,
) -> DataFrame:
    """One row per group: moments of positive lengths, and of log weight against log length.

    With ``part`` there is one for each group and value of that column, to be merged later.

    With ``batch`` only its groups are kept; where they are few enough to broadcast, Catalyst applies
    that to the scan of history.
    """
    ln = F.col(length)
    aggs = measure_moments(F.when(ln > 0, ln), "len_")
    if weight is not None:
        both = (ln > 0) & (F.col(weight) > 0)
        x, y = F.when(both, F.log(ln)), F.when(both, F.log(F.col(weight)))
        aggs += regression_moments(x, y, "reg_")
    keys = [F.col(group).alias("stat_group"), *([F.col(part)] if part else [])]
    stats = history.groupBy(*keys).agg(*aggs)
    if batch is None:
        return stats
    asked = batch.select(F.col(group).alias("asked_group")).distinct()
    return stats.join(asked, stats["stat_group"].eqNullSafe(asked["asked_group"]), "left_semi")


def merge_statistics(parts: DataFrame) -> DataFrame:
    """One row per group from rows of :func:`group_statistics` over parts of history that do not overlap.

    As many rows meet in a group as there are parts; the raw history is not read.
    """
    families = [merged_measure("len_")]
    if "reg_n" in parts.columns:
        families.append(merged_regression("reg_"))
    held = parts.groupBy("stat_group").agg(*[f.parts.alias(f.name) for f in families])
    held = held.select("stat_group", *[f.merge(F.col(f.name)).alias(f.name) for f in families])
    return held.select("stat_group", *[c for f in families for c in f.columns(F.col(f.name))])


def regression_table(stats: DataFrame, min_history: int = MIN_HISTORY) -> DataFrame:
    """The fitted line per group that has enough history."""
    fit = regression_fit("reg_")
    return stats.filter(F.col("reg_n") >= min_history).select(
        F.col("stat_group"),
        F.col("reg_n").alias("n"),
        fit["slope"].alias("slope"),
        fit["intercept"].alias("intercept"),
        fit["resid_sd"].alias("resid_sd"),
    )


def with_statistics(batch: DataFrame, stats: DataFrame, group: str) -> DataFrame:
    """Attach the group's statistics; groups without history get nulls.

    The batch is on the left, so a dominant group is a skew that adaptive execution splits.
    """
    return batch.join(stats, splittable_on([batch[group]], [stats["stat_group"]]), "left")


def zscore_findings(length: str, rules: tuple[Rule, Rule] | None = None) -> list[Finding]:
    long_rule, short_rule = rules or (Rule("too_long", 0), Rule("too_short", 1))
    c, mean, sd = F.col(length), F.col("len_mean"), F.col("len_sd")
    enough = F.col("len_n") >= MIN_HISTORY
    detail = {"mean": F.round(mean, 4), "sd": F.round(sd, 4), "n": F.col("len_n")}
    return [
        Finding(long_rule, enough & (c > mean + DEVIATIONS * sd), length, c, detail),
        Finding(short_rule, enough & (c < mean - DEVIATIONS * sd), length, c, detail),
    ]


def weight_bounds(length: str, level: float = LEVEL) -> tuple[Column, Column]:
    """Lower and upper weight the regression band allows; null where it cannot be drawn."""
    x = F.when(F.col(length) > 0, F.log(F.col(length)))
    low, high = prediction_bounds(x, F.col("reg_n"), F.col("reg_mx"), regression_fit("reg_"), level)
    usable = F.col("reg_n") >= MIN_HISTORY
    return F.when(usable, F.exp(low)), F.when(usable, F.exp(high))


def regression_findings(
    length: str, weight: str, rules: tuple[Rule, Rule] | None = None, level: float = LEVEL
) -> list[Finding]:
    heavy, light = rules or (Rule("too_heavy", 0), Rule("too_light", 1))
    low, high = weight_bounds(length, level)
    w = F.col(weight)
    detail = {"length": F.col(length), "low": F.round(low, 4), "high": F.round(high, 4)}
    return [
        Finding(heavy, w > high, weight, w, detail),
        Finding(light, w < low, weight, w, detail),
    ]


def check_zscore(
    batch: DataFrame, history: DataFrame, group: str, value: str, entity: str, entry_file: str = "entry_file"
) -> DataFrame:
    """Values more than three sample deviations from their group's historical mean."""
    joined = with_statistics(batch, group_statistics(history, group, value, batch=batch), group)
    return row_violations(joined, zscore_findings(value), entity=F.col(entity), entry_file=F.col(entry_file))


def check_regression_interval(
    batch: DataFrame,
    history: DataFrame,
    group: str,
    length: str,
    weight: str,
    entity: str,
    entry_file: str = "entry_file",
) -> DataFrame:
    """Weights outside the 99 % prediction band of log weight on log length in the group's history."""
    joined = with_statistics(batch, group_statistics(history, group, length, weight, batch), group)
    return row_violations(
        joined, regression_findings(length, weight), entity=F.col(entity), entry_file=F.col(entry_file)
    )


def min_history_gaps(batch: DataFrame, stats: DataFrame, group: str, count: str = "len_n") -> DataFrame:
    """Groups of the batch with too little history for a rule, with the history they have."""
    groups = batch.select(F.col(group).alias("batch_group")).distinct()
    return (
        groups.join(stats, groups["batch_group"].eqNullSafe(stats["stat_group"]), "left")
        .select("batch_group", F.coalesce(F.col(count), F.lit(0)).alias("n"))
        .filter(F.col("n") < MIN_HISTORY)
    )
