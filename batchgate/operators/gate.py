"""Overrides, the admission gate and the report."""

from __future__ import annotations

from collections.abc import Iterable

from pyspark.sql import DataFrame
from pyspark.sql import functions as F
from pyspark.sql import types as T

from batchgate.operators.joins import splittable_on

# Overrides: a force key (or rule name), the file it is meant for (null: the whole batch), and why.
OVERRIDE_SCHEMA = T.StructType(
    [
        T.StructField("rule", T.StringType()),
        T.StructField("entry_file", T.StringType()),
        T.StructField("reason", T.StringType()),
    ]
)


def apply_overrides(
    violations: DataFrame, overrides: DataFrame | None = None, force: Iterable[str] = ()
) -> DataFrame:
    """Add ``blocking``: an error that is not forced.  A rule with several keys needs all of them.

    ``force`` lists keys forced for the whole run; ``overrides`` may also name single files.
    """
    forced = F.array(*[F.lit(k) for k in sorted(set(force))]).cast("array<string>")
    if overrides is None:
        allowed, out = forced, violations
    else:
        per_file = overrides.groupBy(F.col("entry_file").alias("override_file")).agg(
            F.collect_set("rule").alias("file_keys")
        )
        # The keys forced for the whole batch: one row, of at most as many texts as there are rules.
        everywhere = per_file.filter("override_file is null").select("file_keys").scalar()
        per_file = per_file.filter("override_file is not null")
        out = violations.join(per_file, splittable_on([violations["entry_file"]], [per_file["override_file"]]), "left")
        nothing = F.array().cast("array<string>")
        allowed = F.concat(forced, F.coalesce("file_keys", nothing), F.coalesce(everywhere, nothing))
    covered = F.size(F.array_except("force_keys", allowed)) == 0
    named = F.array_contains(allowed, F.col("rule"))
    released = F.col("forceable") & (covered | named)
    return out.select(
        *[violations[c] for c in violations.columns],
        ((F.col("severity") == "error") & ~released).alias("blocking"),
    )


def blocked_files(judged: DataFrame) -> DataFrame:
    """Files with at least one blocking violation."""
    return judged.filter("blocking").select("entry_file").distinct()


def decisions(files: DataFrame, judged: DataFrame) -> DataFrame:
    """Each file of the batch under both modes: ``mode, entry_file, n_blocking, admitted``.

    ``batch`` rejects all for one blocking violation, ``file`` each file alone.  ``judged`` is read
    twice, by file and as a whole, so it should be staged.
    """
    counts = judged.filter("blocking").groupBy("entry_file").agg(F.count(F.lit(1)).alias("n_blocking"))
    names = files.select("entry_file").distinct()
    per_file = names.join(counts, "entry_file", "left").withColumn("n_blocking", F.coalesce("n_blocking", F.lit(0)))
    # A blocking violation without a file still rejects the batch, so the total is taken over all counts.
    total = F.coalesce(counts.agg(F.sum("n_blocking").alias("n")).scalar(), F.lit(0))
    modes = [
        F.struct(F.lit(mode).alias("mode"), admitted.alias("admitted"))
        for mode, admitted in (("batch", total == 0), ("file", F.col("n_blocking") == 0))
    ]
    return per_file.select("entry_file", "n_blocking", F.inline(F.array(*modes)))


def gate(files: DataFrame, judged: DataFrame, mode: str = "batch") -> DataFrame:
    """The :func:`decisions` of one mode: entry_file, n_blocking, admitted."""
    if mode not in ("batch", "file"):
        raise ValueError(f"unknown gate mode: {mode}")
    return decisions(files, judged).filter(F.col("mode") == mode).select("entry_file", "n_blocking", "admitted")


def quarantine(rows: DataFrame, judged: DataFrame, entry_file: str = "entry_file") -> DataFrame:
    """Rows of files that nothing blocks."""
    blocked = blocked_files(judged).select(F.col("entry_file").alias("blocked_file"))
    return rows.join(blocked, splittable_on([rows[entry_file]], [blocked["blocked_file"]]), "left_anti")


def summary_by_rule(judged: DataFrame) -> DataFrame:
    """The report: how many violations, files and blocking ones each rule found."""
    return judged.groupBy("rule_order", "rule", "severity").agg(
        F.count(F.lit(1)).alias("n_violations"),
        F.count(F.when(F.col("blocking"), 1)).alias("n_blocking"),
        F.count_distinct("entry_file").alias("n_files"),
    )


def first_failure(judged: DataFrame) -> DataFrame:
    """Blocking violations of the first rule that fails: what a fail-fast run would have reported."""
    first = judged.filter("blocking").agg(F.min("rule_order").alias("o")).scalar()
    return judged.filter(F.col("blocking") & (F.col("rule_order") == first))
