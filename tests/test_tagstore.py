"""States of tags: merged, stored in buckets, read in place, and used by batches."""

from __future__ import annotations

import random
import re
from datetime import date

import pytest
from pyspark.sql import functions as F

from batchgate.operators import linkage
from batchgate.plans import fish
from batchgate.plans.admit import BatchConfig, kept_tags, run_batch
from batchgate.sources.tagstore import merge_tags, open_tags, save_tags
from sheetkit import NAME, fish_row, lines, reference, rules_found, sheet

APPLIES = (
    "tag string, apply_date date, source int, apply_id string, apply_type string, apply_species string, "
    "apply_lake string, apply_length double"
)


def _applies(spark, n=600):
    rng = random.Random(4)
    rows = []
    for i in range(n):
        day = rng.choice([None, date(2020, 1, 1 + rng.randrange(20))])
        length = rng.choice([None, float(rng.randrange(100, 400))])
        # A third of all rows apply one tag, and some rows come twice.
        tag = "hot" if i % 3 == 0 else f"t{rng.randrange(90)}"
        rows += [(tag, day, rng.randrange(2), f"f{i}", "pit", rng.choice("ab"), rng.choice(["L0", None]), length)] * (1 + i % 2)
    return spark.createDataFrame(rows, APPLIES)


def _rows(df):
    return sorted((tuple(r) for r in df.collect()), key=str)


@pytest.mark.parametrize("buckets", [2, 9])
def test_stored_states_merge_to_the_whole(spark, tmp_path, buckets):
    applies = _applies(spark)
    part = F.crc32("apply_id") % 3
    kept = save_tags(linkage.tag_state(applies.filter(part == 0)), str(tmp_path / "0"), buckets)
    for i in (1, 2):
        new = linkage.tag_state(applies.filter(part == i))
        kept = merge_tags(kept, new, str(tmp_path / str(i)))
    whole = linkage.tag_registry(applies)
    assert _rows(linkage.first_applies(kept.state).select(whole.columns)) == _rows(whole)
    latest = linkage.latest_apply(applies)
    assert _rows(linkage.last_applies(kept.state).select(latest.columns)) == _rows(latest)
    files = list((tmp_path / "2").glob("*.parquet"))
    assert 0 < len(files) <= buckets


def test_a_stored_state_is_not_shuffled(spark, tmp_path):
    applies = _applies(spark)
    recaptures = applies.select(F.col("tag").alias("recap_tag")).filter("recap_tag != 't1'")
    asked = spark.conf.get("spark.sql.autoBroadcastJoinThreshold")
    spark.conf.set("spark.sql.autoBroadcastJoinThreshold", "-1")
    try:
        # Fewer and more buckets than there are shuffle partitions.
        for buckets in (2, 9):
            store = save_tags(linkage.tag_state(applies), str(tmp_path / f"s{buckets}"), buckets)
            merged = linkage.merge_tag_states(store.state, linkage.tag_state(applies).repartition(buckets, "tag"))
            for df in (store.asked(recaptures), merged):
                plan = df._jdf.queryExecution().executedPlan().toString()
                left = re.split(r"\+- Sort \[(?:asked|new)_tag", plan[plan.index("SortMergeJoin") :])[0]
                assert "Bucketed: true" in left and "Exchange" not in left
            assert {r.tag for r in store.asked(recaptures).collect()} == {r.recap_tag for r in recaptures.collect()}
    finally:
        spark.conf.set("spark.sql.autoBroadcastJoinThreshold", asked)


def test_a_session_that_does_not_know_a_state_learns_of_it(spark, tmp_path):
    path = str(tmp_path / "tags")
    store = save_tags(linkage.tag_state(_applies(spark)), path, 4)
    want = _rows(store.state)
    for t in [r.tableName for r in spark.sql("SHOW TABLES").collect() if r.tableName.startswith("batchgate_tags_")]:
        spark.sql(f"DROP TABLE {t}")
    assert _rows(open_tags(spark, path, 4).state) == want
    assert _rows(open_tags(spark, path, 4).state) == want


def test_empty_states(spark, tmp_path):
    none = linkage.tag_state(_applies(spark).limit(0))
    store = merge_tags(save_tags(none, str(tmp_path / "a"), 3), none, str(tmp_path / "b"))
    assert store.state.count() == 0


def test_batches_are_judged_by_a_stored_state(spark, tmp_path):
    tables = reference(spark)
    first = BatchConfig(tables, str(tmp_path / "season"), options=fish.Options(growth=True))
    store = kept_tags(spark, first, str(tmp_path / "tags"), 4)
    recaptured = sheet(
        [
            fish_row(1, pitRecapture="P1"),
            fish_row(2, pitRecapture="P2"),
            fish_row(3, pitRecapture="P9"),
            fish_row(4, length=300, weight="", pitRecapture="P1"),
        ]
    )
    found = []
    for i, tags in enumerate((None, store)):
        config = BatchConfig(tables, str(tmp_path / f"s{i}"), options=fish.Options(growth=True), tags=tags)
        result = run_batch(spark, lines(spark, {NAME: recaptured}), config, "b")
        found.append(_rows(result.violations.select("rule", "entity", "value", "detail")))
        assert {"tag_never_applied", "tag_wrong_species"} <= set(rules_found(result.violations))
    assert found[0] == found[1]

    # What the season applies is merged into the state.
    run_batch(spark, lines(spark, {NAME: sheet([fish_row(1, pitApply="N1")])}), first, "b1")
    kept = BatchConfig(tables, first.root, tags=store)
    merged = kept_tags(spark, kept, str(tmp_path / "merged"), 4)
    tags = {r.tag for r in merged.state.collect()}
    assert tags == {r.tag for r in store.state.collect()} | {"N1"}


def test_a_state_from_the_command_line(spark, tmp_path, capsys):
    from batchgate import cli

    for name, table in reference(spark).items():
        table.write.parquet(str(tmp_path / "reference" / name))
    folder = tmp_path / "sheets"
    folder.mkdir()
    (folder / NAME).write_text(sheet([fish_row(1, pitRecapture="P2")]))
    common = [str(folder), "--reference", str(tmp_path / "reference"), "--tag-buckets", "3"]
    tags = str(tmp_path / "tags")
    refused = [*common, "--root", str(tmp_path / "s1"), "--batch", "b1"]
    assert cli.main([*refused, "--keep-tags", tags]) == 1
    by_records = capsys.readouterr().out
    assert "tag_wrong_species" in by_records
    assert cli.main([*common, "--root", str(tmp_path / "s2"), "--batch", "b1", "--tags", tags]) == 1
    assert capsys.readouterr().out == by_records
