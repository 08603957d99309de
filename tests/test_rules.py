"""Operators against brute force on small random tables."""

from __future__ import annotations

import itertools
import random
import statistics
from collections import Counter

import pytest
from pyspark.sql import functions as F

from batchgate.operators import derive, gate, linkage, membership, outliers, ranges
from batchgate.operators.formats import check_formats, format_profile
from batchgate.operators.violations import Rule, union_violations
from batchgate.plans import fish


def _random_rows(seed, n, values, hot="a"):
    """Rows of which a third share one value; some are null."""
    rng = random.Random(seed)
    return [(hot if rng.random() < 1 / 3 else rng.choice([None, *values]), f"f{rng.randrange(4)}") for _ in range(n)]


@pytest.fixture(scope="module", params=[1, 2])
def pair(spark, request):
    new = _random_rows(request.param, 200, list("abcdefgh"))
    old = _random_rows(request.param + 10, 200, list("abcd") if request.param == 1 else ["a", "b"])
    old = old if request.param == 1 else [r for r in old if r[0] is not None]
    schema = "v string, entry_file string"
    return new, old, spark.createDataFrame(new, schema), spark.createDataFrame(old, schema)


def _found(df):
    return sorted(((r["value"], r["entry_file"]) for r in df.collect()), key=str)


@pytest.mark.parametrize("threshold", ["10MB", "-1"])
def test_new_values_and_repeats(spark, pair, threshold):
    """Both join strategies give what brute force gives; together they cover the batch."""
    new, old, batch, history = pair
    spark.conf.set("spark.sql.autoBroadcastJoinThreshold", threshold)
    try:
        known = {v for v, _ in old}
        fresh = membership.check_new_values(batch, history, "v")
        seen = membership.check_repeats(batch, history, "v")
        present = membership.check_repeats(batch, history, "v", skip_nulls=True)
        assert _found(fresh) == sorted({r for r in new if r[0] not in known}, key=str)
        assert _found(seen) == sorted({r for r in new if r[0] in known}, key=str)
        assert _found(present) == sorted({r for r in new if r[0] in known and r[0] is not None}, key=str)
    finally:
        spark.conf.set("spark.sql.autoBroadcastJoinThreshold", "10MB")


def test_numbers_match_across_types(spark):
    batch = spark.createDataFrame([(18.0, "f"), (19.0, "f")], "p double, entry_file string")
    history = spark.createDataFrame([("18",)], "p string")
    assert _found(membership.check_new_values(batch, history, "p")) == [("19", "f")]


def test_keys_are_not_concatenated(spark):
    batch = spark.createDataFrame([("a_b", "c", "f")], "x string, y string, entry_file string")
    history = spark.createDataFrame([("a", "b_c")], "x string, y string")
    assert membership.check_new_combos(batch, history, ["x", "y"]).count() == 1


def test_precedent(spark):
    schema = "lake string, clipApply string, clipRecapture string, entry_file string"
    batch = spark.createDataFrame(
        [("L", "A", None, "f"), ("L", None, "A", "f"), ("L", None, "B", "f"), ("M", None, "A", "f"), (None, None, "C", "f")],
        schema,
    )
    history = spark.createDataFrame([(None, "C", None, "f"), ("L", None, "B", "f")], schema)
    out = membership.check_precedent(batch, history, ["lake"], "clipApply", "clipRecapture")
    assert _found(out) == [("L_B", "f"), ("M_A", "f")]


def test_duplicates(spark, pair):
    new, _, batch, _ = pair
    counts = Counter(v for v, _ in new)
    out = membership.check_duplicate_keys(batch, "v")
    expected = sorted([(v if v is not None else "NA", f) for v, f in new if counts[v] > 1], key=str)
    assert _found(out) == expected


@pytest.mark.parametrize(("low", "high"), list(itertools.product([False, True], repeat=2)))
def test_range_ends(spark, low, high):
    df = spark.createDataFrame([(float(v), "f") for v in (0, 1, 2, 3, 4)] + [(None, "f")], "v double, entry_file string")
    got = {float(r["value"]) for r in ranges.check_range(df, "v", 1, 3, low, high).collect()}
    assert got == {v for v in (0, 1, 2, 3, 4) if v < 1 or v > 3 or (v == 1 and not low) or (v == 3 and not high)}


def test_zscore_by_hand(spark):
    rng = random.Random(3)
    history = [("g", rng.gauss(100, 10)) for _ in range(15)] + [("few", 1.0)] * 14 + [("g", None), ("g", -5.0)]
    values = [v for g, v in history if g == "g" and v is not None and v > 0]
    mean, sd = statistics.mean(values), statistics.stdev(values)
    probes = [mean + 3 * sd - 0.01, mean + 3 * sd + 0.01, mean - 3 * sd - 0.01, mean - 3 * sd + 0.01]
    batch = [("g", p, str(i), "f") for i, p in enumerate(probes)] + [("few", 99.0, "x", "f"), ("none", 1.0, "y", "f")]
    b = spark.createDataFrame(batch, "g string, v double, id string, entry_file string")
    h = spark.createDataFrame(history, "g string, v double")
    out = outliers.check_zscore(b, h, "g", "v", "id")
    assert {(r["entity"], r["rule"]) for r in out.collect()} == {("1", "too_long"), ("2", "too_short")}
    stats = outliers.group_statistics(h, "g", "v")
    gaps = {tuple(r) for r in outliers.min_history_gaps(b, stats, "g").collect()}
    assert gaps == {("few", 14), ("none", 0)}


def _applies(spark, rows):
    return spark.createDataFrame(
        rows,
        """tag string, apply_date date, source int, apply_id string, apply_type string, apply_species string,
        apply_lake string, apply_length double""",
    )


def test_registry_and_latest(spark):
    from datetime import date

    rows = [
        ("T", date(2020, 5, 2), 0, "b", "pit", "S", "L", 10.0),
        ("T", date(2020, 5, 1), 1, "c", "pit", "S", "M", 20.0),
        ("T", date(2020, 5, 1), 0, "d", "floy", "S", "L", 30.0),
        ("T", None, 0, "a", "pit", "S", "L", None),
        ("U", None, 0, "e", "pit", "S", "L", 5.0),
    ]
    for parts in (1, 7):
        applies = _applies(spark, rows).repartition(parts)
        first = {r["tag"]: r["apply_id"] for r in linkage.tag_registry(applies).collect()}
        last = {r["tag"]: r["apply_id"] for r in linkage.latest_apply(applies).collect()}
        assert first == {"T": "d", "U": "e"} and last == {"T": "b", "U": "e"}


def test_every_recapture_has_one_class(spark):
    recaps = [
        (f"{tag}{sp}{lk}", "pit", tag, sp, lk, "f")
        for tag, sp, lk in itertools.product(["T", "X"], ["S", "R", None], ["L", "M", None])
    ]
    df = spark.createDataFrame(
        recaps, "recap_id string, recap_type string, recap_tag string, recap_species string, recap_lake string, entry_file string"
    )
    applies = _applies(spark, [("T", None, 0, "a", "floy", "S", "L", None)])
    linked = linkage.link_recaptures(df, linkage.only_asked(linkage.tag_registry(applies), df)).collect()
    assert len(linked) == len(recaps)
    for r in linked:
        species, lake = r["recap_species"] == "S", r["recap_lake"] == "L"
        if r["recap_tag"] == "X":
            expected = "never applied"
        elif species and lake:
            expected = "none"
        elif not species and not lake:
            expected = "wrong species, wrong lake"
        else:
            expected = "right lake, wrong species" if lake else "right species, wrong lake"
        assert r["problem"] == expected
        assert r["type_differs"] is (r["recap_tag"] == "T")


def test_codes(spark):
    rows = spark.createDataFrame([("minnow",), ("A",), ("B",), (None,)], "otu string")
    dims = spark.createDataFrame(
        [("min", "MNW"), ("zeta", "A"), ("alpha", "A"), ("nameless", None)], "otu string, abbreviation string"
    )
    got = {(r["code"], r["otu"], r["code_known"]) for r in derive.map_codes(rows, dims).collect()}
    assert got == {("MNW", "min", True), ("A", "alpha", True), ("B", "B", False), (None, "nameless", True)}


def test_formats(spark):
    df = spark.createDataFrame([("1", "N1", "x", "f"), ("2", None, "N2", "f")], "id string, a string, b string, entry_file string")
    out = check_formats(df, {"a": "apply", "b": "recapture"}, "^N[0-9]$", "id")
    assert [(r["entity"], r["column"], r["value"]) for r in out.collect()] == [("1", "recapture", "x")]
    assert {tuple(r) for r in format_profile(df, "b").collect()} == {("a", 1), ("A0", 1)}
    assert format_profile(df, "b", distinct=False).count() == 2


def test_overrides_and_gates(spark):
    rules = [Rule("free", 1, force_keys=("k",)), Rule("two", 2, force_keys=("k", "m")), Rule("hard", 3), Rule("soft", 4, "warning")]
    from batchgate.operators.violations import as_violations

    files = spark.createDataFrame([("f",), ("g",), ("h",)], "entry_file string")
    parts = [
        as_violations(files.filter("entry_file <> 'h'"), r, entry_file=F.col("entry_file")) for r in rules if r.name != "hard"
    ]
    found = union_violations(spark, parts)

    def blocking(overrides=None, force=()):
        judged = gate.apply_overrides(found, overrides, force)
        return {(r["rule"], r["entry_file"]) for r in judged.filter("blocking").collect()}

    everything = {(r, f) for r in ("free", "two") for f in "fg"}
    assert blocking() == everything
    assert blocking(force=["k"]) == {("two", "f"), ("two", "g")}
    assert blocking(force=["k", "m"]) == set()
    table = spark.createDataFrame([("k", "f", ""), ("m", None, ""), ("hard", None, "")], gate.OVERRIDE_SCHEMA)
    assert blocking(table) == {("free", "g"), ("two", "g")}
    judged = gate.apply_overrides(found, table)
    by_file = {r["entry_file"]: r["admitted"] for r in gate.gate(files, judged, "file").collect()}
    assert by_file == {"f": True, "g": False, "h": True}
    assert not any(r["admitted"] for r in gate.gate(files, judged, "batch").collect())
    assert {r[0] for r in gate.quarantine(files, judged).collect()} == {"f", "h"}
    assert {r["rule"] for r in gate.first_failure(judged).collect()} == {"free"}
    with pytest.raises(ValueError):
        gate.gate(files, judged, "perhaps")


def test_unforceable_rule_cannot_be_named(spark):
    from batchgate.operators.violations import as_violations

    found = as_violations(spark.createDataFrame([("f",)], "entry_file string"), Rule("hard"), entry_file=F.col("entry_file"))
    table = spark.createDataFrame([("hard", None, "please")], gate.OVERRIDE_SCHEMA)
    assert gate.apply_overrides(found, table).filter("blocking").count() == 1


def test_no_rules(spark):
    assert union_violations(spark, []).count() == 0


@pytest.fixture
def small_skew_limits(spark):
    limits = {
        "spark.sql.autoBroadcastJoinThreshold": "-1",
        "spark.sql.adaptive.autoBroadcastJoinThreshold": "-1",
        "spark.sql.adaptive.skewJoin.skewedPartitionThresholdInBytes": "50KB",
        "spark.sql.adaptive.skewJoin.skewedPartitionFactor": "1.5",
        "spark.sql.adaptive.advisoryPartitionSizeInBytes": "50KB",
        "spark.sql.shuffle.partitions": "16",
    }
    old = {k: spark.conf.get(k, None) for k in limits}
    for k, v in limits.items():
        spark.conf.set(k, v)
    yield
    for k, v in old.items():
        spark.conf.unset(k) if v is None else spark.conf.set(k, v)


@pytest.mark.parametrize("rule", ["zscore", "zscore of the batch", "recapture", "duplicates", "codes", "unseen", "repeated", "both", "rows"])
def test_a_hot_key_is_split(spark, small_skew_limits, rule):
    """A key with a third of all rows does not end up in one task, and nothing is lost."""
    n = 60_000
    ids = spark.range(0, n, numPartitions=8).withColumn("entry_file", F.md5(F.col("id").cast("string")))
    g = F.when(F.col("id") < n // 3, "hot").otherwise(F.concat(F.lit("g"), (F.col("id") % 5000).cast("string")))
    batch = ids.withColumn("g", g).withColumn("id", F.col("id").cast("string"))
    if rule == "zscore":
        stats = outliers.group_statistics(batch.withColumn("v", F.lit(1.0)), "g", "v")
        out, expected = outliers.with_statistics(batch, stats, "g"), n
    elif rule == "zscore of the batch":
        stats = outliers.group_statistics(batch.withColumn("v", F.lit(1.0)), "g", "v", batch=batch)
        out, expected = outliers.with_statistics(batch, stats, "g"), n
    elif rule == "unseen":
        out, expected = membership.check_new_values(batch, batch.filter("g <> 'hot'"), "g"), n // 3
    elif rule == "repeated":
        out, expected = membership.check_repeats(batch, batch, "g"), n
    elif rule == "both":
        rules = [
            membership.KeyRule(Rule("a"), ("g",), {"h": ("g",)}),
            membership.KeyRule(Rule("b"), ("g",), {"h": ("g",)}, unseen=False),
        ]
        out, expected = membership.check_keys(batch, {"h": batch.filter("g <> 'hot'")}, rules), n
    elif rule == "recapture":
        recaps = batch.select(
            F.col("id").alias("recap_id"),
            F.lit("pit").alias("recap_type"),
            F.col("g").alias("recap_tag"),
            F.lit("S").alias("recap_species"),
            F.lit("L").alias("recap_lake"),
            "entry_file",
        )
        applies = batch.select(
            F.col("g").alias("tag"),
            F.lit(None).cast("date").alias("apply_date"),
            F.lit(0).alias("source"),
            F.col("id").alias("apply_id"),
            F.lit("pit").alias("apply_type"),
            F.lit("S").alias("apply_species"),
            F.lit("M").alias("apply_lake"),
        )
        out, expected = linkage.link_recaptures(recaps, linkage.tag_registry(applies)), n
    elif rule == "duplicates":
        out, expected = membership.check_duplicate_keys(batch, "g"), n
    elif rule == "codes":
        dims = batch.select(F.col("g").alias("abbreviation"), F.col("g").alias("otu")).distinct()
        out, expected = derive.map_codes(batch.withColumnRenamed("g", "otu"), dims), n
    else:
        from batchgate.operators import parse

        lines = batch.select(F.col("g").alias("entry_file"), F.lit(19).alias("line_no"), F.concat("id", F.lit(",A,1,2")).alias("line"))
        top = batch.select(F.col("g").alias("entry_file")).distinct().select(
            "entry_file", F.lit(18).alias("line_no"), F.lit("fishNum,species,fishLength,fishWeight").alias("line")
        )
        out, expected = parse.sheet_rows(lines, parse.parse_sheets(top), ["fishNum", "otu"]), n
    assert len(out.collect()) == expected
    assert "skew=true" in out._jdf.queryExecution().executedPlan().toString()


def test_keys_left_out_and_tags_that_are_missing_give_no_rows(spark):
    """Rows without any tag go before the kept columns are computed."""
    rows = [("a", "1", None), ("b", None, None), (None, None, "2"), ("c", "3", "4"), ("c", "3", "4")]
    df = spark.createDataFrame(rows, "id string, pit string, floy string")
    keys = membership.long_keys(df, {0: ("id",), 1: ("pit", "floy")}, 2, needed={1: ("pit", "floy")})
    got = sorted(map(tuple, keys.collect()), key=str)
    assert got == sorted([(0, i, None) for i, _, _ in rows] + [(1, "3", "4")] * 2, key=str)
    tags = linkage.tags_long(df, {"id": F.upper("id")}, {"p": "pit", "f": "floy"}, "kind", "tag")
    assert sorted(map(tuple, tags.collect()), key=str) == sorted(
        [("A", "p", "1"), (None, "f", "2"), *[("C", "p", "3"), ("C", "f", "4")] * 2], key=str
    )
    plan = tags._jdf.queryExecution().optimizedPlan().toString()
    assert plan.index("Expand") < plan.rindex("isnotnull(pit")


def test_keys_compared_by_hash_first_break_the_same_rules(spark, tmp_path):
    """Only repeated record keys are compared as text, and nothing that is repeated is missed."""
    names = ("fishID", "sampleID", "otu", "clipApply", "clipRecapture", "pitApply", "floyApply", "entry_file")
    schema = ", ".join(f"{n} string" for n in names)

    def rows(*items):
        return spark.createDataFrame(items, schema)

    batch = rows(
        *[(f"L_s_{i}", "L_s", "A", None, None, None, None, "f1") for i in range(50)],
        ("L_s_7", "L_s", "A", None, "LV", "P1", None, "f2"),
        ("L_s_7", "L_s", "B", None, "RV", None, "F1", "f2"),
        ("M_t_1", "M_t", "A", "RV", None, None, None, "f2"),
        ("M_t_2", "M_t", None, None, "RV", "P2", None, "f3"),
        (None, None, "A", None, None, None, None, "f3"),
    )
    snapshot = rows(("L_s_3", "L_x", "A", "LV", None, "P1", None, "old"), (None, "L_x", "C", None, None, None, "F9", "old"))
    season = rows(("L_s_5", "L_s", "A", None, None, None, "F1", "s"), ("M_t_2", "M_q", "A", None, None, "P3", None, "s"))
    doubtful = fish.doubtful_records(batch, snapshot, season, str(tmp_path))
    assert doubtful.count() == 5
    got, want = (
        sorted(map(str, found.select("rule", "entity", "value", "entry_file").collect()))
        for found in (
            fish.membership_rules(batch, snapshot, season, doubtful),
            fish.membership_rules(batch, snapshot, season),
        )
    )
    assert got == want and any("season_fishID" in r for r in got) and any("clip_recapture" in r for r in got)
    repeated = membership.doubtful_rows(batch, "fishID", doubtful)
    assert repeated.count() == 7
    counts = [membership.check_duplicate_keys(df, "fishID").count() for df in (repeated, batch)]
    assert counts == [3, 3]
