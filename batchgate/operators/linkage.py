"""Mark and recapture: each recaptured tag is linked to where, when and on what it was applied."""

from __future__ import annotations

from collections.abc import Mapping
from functools import reduce

from pyspark.sql import Column, DataFrame, Window
from pyspark.sql import functions as F

from batchgate.functions.growth import expected_length
from batchgate.operators.joins import splittable_on
from batchgate.operators.violations import VIOLATION_COLUMNS, Finding, Rule, row_violations


def tags_long(
    df: DataFrame, keep: Mapping[str, Column], tags: Mapping[str, str], type_name: str, tag_name: str
) -> DataFrame:
    """One row per present tag: the kept columns, the tag type and the tag.

    ``tags`` maps the type label to its column.  Missing tags go here, before any shuffle, so they
    never become one huge key; rows without any go before the kept columns are computed.
    """
    tagged = df.filter(reduce(lambda a, b: a | b, [F.col(c).isNotNull() for c in tags.values()]))
    wide = tagged.select(
        *[c.alias(n) for n, c in keep.items()],
        *[F.col(c).cast("string").alias(label) for label, c in tags.items()],
    )
    return wide.unpivot(list(keep), list(tags), type_name, tag_name).filter(F.col(tag_name).isNotNull())


def drop_placeholders(df: DataFrame, column: str, placeholders: tuple[str, ...] = ()) -> DataFrame:
    """Optionally leave out texts that stand for an unreadable tag."""
    return df.filter(~F.col(column).isin(*placeholders)) if placeholders else df


def only_asked(per_tag: DataFrame, recaptures: DataFrame, buckets: int | None = None) -> DataFrame:
    """Rows of a per-tag table (registry, latest applies) whose tag is recaptured.

    Apply it to the grouped table: where the recaptured tags are small enough to broadcast, Catalyst
    moves the semi join below the grouping and history is filtered as it is scanned; where they are
    not, history is still combined per tag before it is shuffled.  A table stored in ``buckets`` by tag
    is read in place: the tags, one row each, are dealt to its buckets.
    """
    asked = recaptures.select(F.col("recap_tag").alias("asked_tag")).distinct()
    if buckets is not None:
        asked = asked.repartition(buckets, "asked_tag")
    return per_tag.join(asked, per_tag["tag"] == asked["asked_tag"], "left_semi")


# Earliest apply: by date (missing dates last), then source, then record, then the rest.
_REGISTRY_ORDER = ("no_date", "apply_date", "source", "apply_id", "apply_type", "apply_species", "apply_lake")


def tag_registry(applies: DataFrame) -> DataFrame:
    """The earliest apply of each tag.

    ``applies`` has tag, apply_date, source (rank of the table, lowest first), apply_id, apply_type,
    apply_species, apply_lake.  The minimum of an ordered struct is combined map-side: a tag applied
    in a third of all rows leaves each task as one row.
    """
    first = (
        applies.withColumn("no_date", F.col("apply_date").isNull())
        .groupBy("tag")
        .agg(F.min(F.struct(*_REGISTRY_ORDER)).alias("a"))
    )
    return first.select(
        "tag", "a.apply_date", "a.source", "a.apply_id", "a.apply_type", "a.apply_species", "a.apply_lake"
    )


def latest_apply(applies: DataFrame) -> DataFrame:
    """The most recent apply of each tag that has a length (missing dates count as latest).

    ``applies`` has tag, apply_date, source, apply_id, apply_length, apply_species.
    """
    last = (
        applies.filter(F.col("apply_length").isNotNull())
        .withColumn("no_date", F.col("apply_date").isNull())
        .groupBy("tag")
        .agg(
            F.max(
                F.struct("no_date", "apply_date", "source", "apply_id", "apply_length", "apply_species")
            ).alias("a")
        )
    )
    return last.select("tag", "a.apply_date", "a.source", "a.apply_id", "a.apply_length", "a.apply_species")


_LATEST_ORDER = ("no_date", "apply_date", "source", "apply_id", "apply_length", "apply_species")


def tag_state(applies: DataFrame) -> DataFrame:
    """``tag, first, last``: what :func:`tag_registry` and :func:`latest_apply` keep of each tag, in one pass.

    States of parts of history merge to that of the whole (:func:`merge_tag_states`).
    """
    last = F.when(F.col("apply_length").isNotNull(), F.struct(*_LATEST_ORDER))
    dated = applies.withColumn("no_date", F.col("apply_date").isNull())
    return dated.groupBy("tag").agg(F.min(F.struct(*_REGISTRY_ORDER)).alias("first"), F.max(last).alias("last"))


def merge_tag_states(kept: DataFrame, new: DataFrame) -> DataFrame:
    """The state of both parts of history; each has one row per tag.

    A full join, so that a kept state that is stored in buckets is not shuffled (:mod:`sources.tagstore`).
    """
    more = new.select(F.col("tag").alias("new_tag"), F.col("first").alias("new_first"), F.col("last").alias("new_last"))
    return kept.join(more, kept["tag"] == more["new_tag"], "full").select(
        F.coalesce("tag", "new_tag").alias("tag"),
        F.least("first", "new_first").alias("first"),
        F.greatest("last", "new_last").alias("last"),
    )


def first_applies(state: DataFrame) -> DataFrame:
    """The first apply of each tag of a state, in the form of applies."""
    return state.select("tag", *[F.col("first")[c].alias(c) for c in _REGISTRY_ORDER if c != "no_date"])


def last_applies(state: DataFrame) -> DataFrame:
    """The last measured apply of each tag of a state that has one, in the form of applies."""
    measured = state.filter(F.col("last").isNotNull())
    return measured.select("tag", *[F.col("last")[c].alias(c) for c in _LATEST_ORDER if c != "no_date"])


# Days of applies and recaptures that have no date: before all others, after all others.
_NO_APPLY_DAY, _NO_RECAP_DAY = "0001-01-01", "9999-12-31"


def asof_applies(recaptures: DataFrame, applies: DataFrame) -> DataFrame:
    """Each recapture with the latest apply of its tag that is not after its day.

    ``applies`` has tag, apply_date, source, apply_id and more; ``recaptures`` has recap_tag, recap_date
    and more.  Of one day the highest source and id counts, and an apply on the day of the recapture is
    not after it.  An apply without a date counts as earlier than all, a recapture without one as later.
    ``tag`` is null where there is no such apply; ``applied`` says whether the tag has any at all.

    Applies are reduced to the last one of each tag and day, map-side first, and recaptures to the days
    they ask for.  The running last value then goes over days, not rows: a tag with a third of all rows
    is a group of at most two rows for each day.  Recaptures join their (tag, day), which can be split.
    """
    detail = [c for c in applies.columns if c not in ("tag", "source", "apply_id")]
    last = F.max(F.struct("source", "apply_id", *detail)).alias("apply")
    day = F.coalesce("apply_date", F.lit(_NO_APPLY_DAY).cast("date"))
    per_day = only_asked(applies.withColumn("day", day).groupBy("tag", "day").agg(last), recaptures)
    dated = recaptures.withColumn("recap_day", F.coalesce("recap_date", F.lit(_NO_RECAP_DAY).cast("date")))
    asked = dated.select(F.col("recap_tag").alias("tag"), F.col("recap_day").alias("day")).distinct()
    nothing = F.lit(None).cast(per_day.schema["apply"].dataType).alias("apply")
    days = per_day.select("tag", "day", F.lit(False).alias("asked"), "apply").unionByName(
        asked.select("tag", "day", F.lit(True).alias("asked"), nothing)
    )
    # Applies of a day come before recaptures of the same day.
    until = Window.partitionBy("tag").orderBy("day", "asked").rowsBetween(Window.unboundedPreceding, Window.currentRow)
    days = days.select(
        F.col("tag").alias("day_tag"),
        "day",
        "asked",
        F.last("apply", ignorenulls=True).over(until).alias("apply"),
        (F.count("apply").over(Window.partitionBy("tag")) > 0).alias("applied"),
    ).filter("asked")
    on = splittable_on([dated["recap_tag"], dated["recap_day"]], [days["day_tag"], days["day"]])
    return dated.join(days, on, "left").select(
        *recaptures.columns,
        F.when(F.col("apply").isNotNull(), F.col("recap_tag")).alias("tag"),
        *[F.col("apply")[c].alias(c) for c in applies.columns if c != "tag"],
        F.coalesce("applied", F.lit(False)).alias("applied"),
    )


def _classified(joined: DataFrame, absent: Column) -> DataFrame:
    """The class of each recapture, ``absent`` where it has no apply, and whether the types differ."""
    same_species = F.col("recap_species").eqNullSafe(F.col("apply_species"))
    same_lake = F.col("recap_lake").eqNullSafe(F.col("apply_lake"))
    problem = (
        F.when(F.col("tag").isNull(), absent)
        .when(same_species & same_lake, "none")
        .when(~same_species & ~same_lake, "wrong species, wrong lake")
        .when(same_lake, "right lake, wrong species")
        .otherwise("right species, wrong lake")
    )
    return joined.withColumn("problem", problem).withColumn(
        "type_differs", F.coalesce(F.col("recap_type") != F.col("apply_type"), F.lit(False))
    )


def link_recaptures(recaptures: DataFrame, registry: DataFrame) -> DataFrame:
    """Each recapture with its registry row, and its class.

    ``recaptures`` has recap_id, recap_type, recap_tag, recap_species, recap_lake, entry_file.
    One left join serves the type test, the classes and their explanation.
    """
    joined = recaptures.join(registry, splittable_on([recaptures["recap_tag"]], [registry["tag"]]), "left")
    return _classified(joined, F.lit("never applied"))


def link_recaptures_asof(recaptures: DataFrame, applies: DataFrame) -> DataFrame:
    """As :func:`link_recaptures`, with the latest apply up to the day of the recapture (:func:`asof_applies`).

    A tag that is only applied later is a class of its own.
    """
    absent = F.when(F.col("applied"), "applied later").otherwise("never applied")
    return _classified(asof_applies(recaptures, applies), absent)


# Which forces release which problem; a tag wrong in both ways needs both.
TAG_RULES = {
    "type": Rule("tag_type", 0, force_keys=("tagRecapType",)),
    "never applied": Rule("tag_never_applied", 1, force_keys=("tagRecap",)),
    "right lake, wrong species": Rule("tag_wrong_species", 2, force_keys=("tagRecapSpecies",)),
    "right species, wrong lake": Rule("tag_wrong_lake", 3, force_keys=("tagRecapLake",)),
    "wrong species, wrong lake": Rule("tag_wrong_both", 4, force_keys=("tagRecapSpecies", "tagRecapLake")),
    "applied later": Rule("tag_applied_later", 5, force_keys=("tagRecap",)),
}


def check_tag_recapture(linked: DataFrame, rules: Mapping[str, Rule] = TAG_RULES) -> DataFrame:
    """Type mismatches and problem classes of :func:`link_recaptures` as violations."""
    tag = F.col("recap_tag")
    original = {
        "applyID": F.col("apply_id"),
        "applyType": F.col("apply_type"),
        "applyOTU": F.col("apply_species"),
        "applyLake": F.col("apply_lake"),
        "recaptureType": F.col("recap_type"),
        "otu": F.col("recap_species"),
        "lakeID": F.col("recap_lake"),
    }
    findings = [Finding(rules["type"], F.col("type_differs"), "tagRecapture", tag, original)]
    findings += [
        Finding(rule, F.col("problem") == name, "tagRecapture", tag, original)
        for name, rule in rules.items()
        if name != "type"
    ]
    return row_violations(
        linked, findings, entity=F.col("recap_id"), entry_file=F.col("entry_file")
    ).select(*VIOLATION_COLUMNS)


def growth_expectation(
    recaptures: DataFrame,
    latest: DataFrame,
    linf: Column,
    k: Column,
    t0: Column,
    start_length_col: str = "apply_length",
) -> DataFrame:
    """Recaptures paired with their latest apply, and the length expected by now.

    ``recaptures`` has recap_tag, recap_date, recap_length.
    """
    paired = recaptures.join(latest, splittable_on([recaptures["recap_tag"]], [latest["tag"]]), "inner")
    return expected_growth(paired, linf, k, t0, start_length_col)


def growth_expectation_asof(
    recaptures: DataFrame,
    applies: DataFrame,
    linf: Column,
    k: Column,
    t0: Column,
    start_length_col: str = "apply_length",
) -> DataFrame:
    """As :func:`growth_expectation`, from the latest measured apply up to the day of the recapture."""
    measured = applies.filter(F.col(start_length_col).isNotNull())
    return expected_growth(asof_applies(recaptures, measured).filter("tag is not null"), linf, k, t0, start_length_col)


def expected_growth(paired: DataFrame, linf: Column, k: Column, t0: Column, start_length_col: str) -> DataFrame:
    """The length expected on recap_date of a fish that had its start length on apply_date."""
    days = F.datediff(F.col("recap_date"), F.col("apply_date")).cast("double")
    return paired.withColumn("expected", expected_length(F.col(start_length_col), days, linf, k, t0))


def check_growth(grown: DataFrame, tolerance: float = 0.1, rule: Rule | None = None) -> DataFrame:
    """Recaptures whose length is off the expectation by more than the tolerance of the observed length."""
    off = F.abs(F.col("expected") - F.col("recap_length")) > tolerance * F.col("recap_length")
    finding = Finding(
        rule or Rule("growth", force_keys=("vonB",)),
        off,
        "fishLength",
        F.col("recap_length"),
        {
            "expected": F.round(F.col("expected"), 4),
            "lengthApply": F.col("apply_length"),
            "tagRecapture": F.col("recap_tag"),
            "otuApply": F.col("apply_species"),
        },
    )
    return row_violations(grown, [finding], entity=F.col("recap_id"), entry_file=F.col("entry_file"))
