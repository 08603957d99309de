"""The whole job on fixture sheets: one failing and one passing case per rule."""

from __future__ import annotations

import pytest
from pyspark.sql import functions as F

from batchgate.operators.gate import OVERRIDE_SCHEMA, first_failure, summary_by_rule
from batchgate.plans import fish
from batchgate.plans.admit import BatchConfig, admit_folder, run_batch
from batchgate.sources.accumulators import load_or_init
from batchgate.streaming.incremental import replay_quarantine, run_incremental
from sheetkit import COLUMNS, NAME, TRAP_NAME, fish_row, lines, reference, rules_found, sheet

TRAP_HEADER = {
    "gear": "MT",
    "effortUnits": "trap_hours",
    "metadataID": "Trap.20210601",
}


@pytest.fixture(scope="module")
def tables(spark):
    return reference(spark)


@pytest.fixture
def config(tables, tmp_path):
    return BatchConfig(tables, str(tmp_path / "season"))


# Sheets with one thing wrong, and the error rules they break.  They are judged together, each as a
# file of its own: what one sheet does must not show in another.
def other(n, **header):
    """A header for sheet number n: its own minute, so that keys differ."""
    return {"dateTimeSample": f"2021-06-03 12:{n:02d}:00", **header}


CASES = {
    "fine": (sheet([fish_row(1), fish_row(2, "YWP")], other(0)), []),
    "site spelling": (sheet([fish_row(1)], other(1, siteName="deephole")), []),
    "blank key": (sheet([fish_row(1)], {**other(2), " ": "x"}, drop=("comments",)), ["header_blank_key"]),
    "blank gear": (sheet([fish_row(1)], other(3, gear="")), ["gear_missing", "header_required", "new_gear"]),
    "bad unit": (sheet([fish_row(1)], other(4, effortUnits="hours")), ["effort_units", "new_effortUnits"]),
    "bad crew": (sheet([fish_row(1)], other(5, crew="a;b")), ["crew_format"]),
    "bad time": (
        sheet([fish_row(1)], other(6, dateTimeSet="6/3/21 10:00")),
        ["header_required", "timestamp_format"],
    ),
    "no floyApply": (
        sheet([fish_row(1)], other(7), columns=[c for c in COLUMNS if c != "floyApply"]),
        ["tag_columns"],
    ),
    "trap column": (sheet([fish_row(1)], other(8), columns=[*COLUMNS, "trapNumber"]), ["trap_column"]),
    "duplicate column": (sheet([fish_row(1)], other(9), columns=[*COLUMNS, "species"]), ["duplicate_column"]),
    "open quote": (sheet([fish_row(1)], other(10), raw=['2,LMB,220,106.5,"x']), ["cell_quotes"]),
    "no number": (sheet([fish_row("")], other(11)), ["fish_number_missing"]),
    "no species": (sheet([fish_row(1, "")], other(12)), ["new_lake_species", "new_otu", "species_missing"]),
    "unknown species": (
        sheet([fish_row(1, "XYZ")], other(13)),
        ["new_lake_species", "new_otu", "species_code"],
    ),
    "code of another group": (
        sheet([fish_row(1, "DAP")], other(14)),
        ["new_lake_species", "new_otu", "species_code"],
    ),
    "nothing caught": (sheet([fish_row(1, "NFC", "", "")], other(15)), []),
    "empty row": (sheet([fish_row(1), fish_row(2, "", "", "")], other(16)), []),
    "new lake": (
        sheet([fish_row(1)], other(17, lakeID="ZZ")),
        ["new_lakeID", "new_lake_species", "new_siteID"],
    ),
    "new site": (sheet([fish_row(1)], other(18, siteName="Elsewhere")), ["new_siteID"]),
    "new group": (sheet([fish_row(1)], other(19, sampleGroup="zz")), ["new_sampleGroup"]),
    "new metadata": (sheet([fish_row(1)], other(20, metadataID="zz")), ["new_metadataID"]),
    "retired project": (
        sheet([fish_row(1)], other(21, projectID="18")),
        ["new_projectID", "retired_projectID"],
    ),
    "vocabulary": (sheet([fish_row(1)], other(22, useCPUE="maybe")), ["vocab_useCPUE"]),
    "useCPUE blanks": (sheet([fish_row(1)], other(23, useCPUE=" yes ")), []),
    "repeated number": (sheet([fish_row(1), fish_row(1)], other(24)), ["dup_fishID"]),
    "seconds": (sheet([fish_row(1)], {"dateTimeSample": "2021-06-03 13:00:30"}), ["key_timestamp"]),
    "date order": (
        sheet([fish_row(1)], {"dateTimeSet": "2021-06-04 10:00:00", "dateTimeSample": "2021-06-03 13:01:00"}),
        ["date_order", "time_order"],
    ),
    "time order": (
        sheet([fish_row(1)], {"dateTimeSet": "2021-06-03 14:00:00", "dateTimeSample": "2021-06-03 13:02:00"}),
        ["time_order"],
    ),
    "day 91": (
        sheet([fish_row(1)], {"dateTimeSet": "2021-04-01 10:00:00", "dateTimeSample": "2021-04-01 11:00:00"}),
        ["range_dayOfYear"],
    ),
    "day 92": (
        sheet([fish_row(1)], {"dateTimeSet": "2021-04-02 10:00:00", "dateTimeSample": "2021-04-02 11:00:00"}),
        [],
    ),
    "distance 25": (
        sheet([fish_row(1)], other(25, gear="BE", distanceShocked="25")),
        ["new_gear", "range_distanceShocked"],
    ),
    "distance without shocking": (sheet([fish_row(1)], other(26, distanceShocked="99")), []),
    "effort 0": (sheet([fish_row(1)], other(27, effort="0")), []),
    "effort 24": (sheet([fish_row(1)], other(28, effort="24")), ["range_effort"]),
    "zero length": (sheet([fish_row(1, length=0, weight=5)], other(29)), ["not_positive", "too_short"]),
    "too long": (sheet([fish_row(1, length=400)], other(30)), ["too_long"]),
    "too heavy": (sheet([fish_row(1, weight=200)], other(31)), ["too_heavy"]),
    "too light": (sheet([fish_row(1, weight=50)], other(32)), ["too_light"]),
    "cap without history": (sheet([fish_row(1, "WAE", length=1500, weight="")], other(33)), ["absolute_cap"]),
    "below cap without history": (sheet([fish_row(1, "WAE", length=1499, weight="")], other(34)), []),
    "new clip": (sheet([fish_row(1, clipApply="ZZ")], other(35)), ["new_clipApply"]),
    "clip recaptured": (sheet([fish_row(1, clipRecapture="LV")], other(36)), []),
    "clip of another species": (sheet([fish_row(1, "YWP", clipRecapture="LV")], other(37)), ["clip_recapture"]),
    "tag recaptured": (sheet([fish_row(1, pitRecapture="P1")], other(38)), []),
    "tag never applied": (sheet([fish_row(1, pitRecapture="P9")], other(39)), ["tag_never_applied"]),
    "tag type": (sheet([fish_row(1, floyRecapture="P1")], other(40)), ["tag_type"]),
    "tag of another species": (sheet([fish_row(1, pitRecapture="P2")], other(41)), ["tag_wrong_species"]),
    "tag of another lake": (
        sheet([fish_row(1, "WAE", length=310, floyRecapture="F1")], other(42)),
        ["new_lake_species_not", "tag_wrong_lake"],
    ),
    "tag of another lake and species": (sheet([fish_row(1, floyRecapture="F1")], other(43)), ["tag_wrong_both"]),
    "tag applied again": (sheet([fish_row(1, pitApply="P1")], other(44)), ["repeat_pitApply"]),
    "tag applied in the batch": (
        sheet([fish_row(1, pitApply="N1"), fish_row(2, pitRecapture="N1")], other(45)),
        [],
    ),
}
# Walleye were never seen in WL, so such sheets break that rule as well.
for _case in ("cap without history", "below cap without history", "tag of another lake"):
    _text, _rules = CASES[_case]
    CASES[_case] = (_text, sorted({r for r in _rules if not r.endswith("_not")} | {"new_lake_species"}))

FILES = {case: f"{case.replace(' ', '-')}_2021-06-03_1126.csv" for case in CASES}


@pytest.fixture(scope="module")
def judged_cases(spark, tables, tmp_path_factory):
    """All single-fault sheets as one batch in file mode."""
    root = str(tmp_path_factory.mktemp("cases"))
    sheets = {FILES[c]: text for c, (text, _) in CASES.items()}
    result = run_batch(spark, lines(spark, sheets), BatchConfig(tables, root, mode="file"), "b1")
    found = result.violations.filter("severity = 'error'").select("entry_file", "rule").distinct().collect()
    by_file = {}
    for r in found:
        by_file.setdefault(r["entry_file"], set()).add(r["rule"])
    return result, by_file


@pytest.mark.parametrize("case", list(CASES))
def test_case(judged_cases, case):
    # History is null in clipApply too, so a missing clip is a known value; gears, units are not.
    assert sorted(judged_cases[1].get(FILES[case], ())) == CASES[case][1]


def test_file_gate_admits_exactly_the_clean_sheets(judged_cases):
    result, by_file = judged_cases
    admitted = {r["entry_file"] for r in result.admitted.filter("admitted").collect()}
    assert admitted == {FILES[c] for c in CASES if not CASES[c][1]}
    assert {r["entry_file"] for r in result.samples.select("entry_file").collect()} == admitted


def test_few_history_warnings(judged_cases):
    warnings = judged_cases[0].violations.filter("severity = 'warning'")
    few = {(r["rule"], r["value"]) for r in warnings.filter("rule like 'few%'").collect()}
    assert ("few_lengths", "walleye") in few and ("few_weights", "walleye") in few
    assert ("few_lengths", "largemouth_bass") not in few
    assert not warnings.filter("blocking").count()


def test_tag_explanation_and_force_keys(judged_cases):
    v = judged_cases[0].violations
    both = v.filter("rule = 'tag_wrong_both'").first()
    assert both["force_keys"] == ["tagRecapSpecies", "tagRecapLake"]
    assert both["detail"]["applyOTU"] == "walleye" and both["detail"]["applyLake"] == "EL"


def test_all_or_nothing(spark, config):
    good, bad = sheet([fish_row(1)]), sheet([fish_row(1, weight=200)], other(1))
    result = run_batch(spark, lines(spark, {NAME: good, "b_2021-06-03_1201.csv": bad}), config, "b1")
    assert rules_found(result.violations) == ["too_heavy"]
    assert result.admitted.filter("admitted").count() == 0
    assert result.records.count() == 0 and result.samples.count() == 0
    assert first_failure(result.violations).select("rule").distinct().collect()[0][0] == "too_heavy"
    assert summary_by_rule(result.violations).filter("n_blocking > 0").count() == 1


def test_force_key_releases(spark, tables, tmp_path):
    bad = sheet([fish_row(1, weight=200)])
    result = run_batch(
        spark, lines(spark, {NAME: bad}), BatchConfig(tables, str(tmp_path), force=("fishWeight",)), "b1"
    )
    assert rules_found(result.violations) == ["too_heavy"]
    assert result.records.count() == 1


def test_both_flags_needed(spark, tables, tmp_path):
    """A tag wrong in species and lake needs both keys, for the file they are given for."""
    forced = {0: (), 1: ("tagRecapLake",), 2: ("tagRecapSpecies",), 3: ("tagRecapLake", "tagRecapSpecies")}
    sheets = {f"f{n}_2021-06-03_1126.csv": sheet([fish_row(1, floyRecapture="F1")], other(n)) for n in forced}
    given = [(key, f"f{n}_2021-06-03_1126.csv", "seen") for n, keys in forced.items() for key in keys]
    overrides = spark.createDataFrame(given, OVERRIDE_SCHEMA)
    config = BatchConfig(tables, str(tmp_path), mode="file", overrides=overrides)
    result = run_batch(spark, lines(spark, sheets), config, "b1")
    assert [r["entry_file"] for r in result.records.collect()] == ["f3_2021-06-03_1126.csv"]


def test_unknown_force_key():
    with pytest.raises(ValueError):
        BatchConfig({}, "x", force=("everything",))


def test_force_keys_are_complete():
    assert len(fish.FORCE_KEYS) == 26


def test_admitted_tables(spark, config):
    rows = [
        fish_row(1, otolithSample=1, dietSampled=1, clipApply="LV", mortality=0),
        fish_row(2, "YWP", spineSample=1),
        fish_row(3, scaleSample=1),
        fish_row(4, "NFC", "", ""),
    ]
    other_sheet = sheet([fish_row(1)], other(1))
    result = run_batch(
        spark, lines(spark, {NAME: sheet(rows), "b_2021-06-03_1201.csv": other_sheet}), config, "b1"
    )
    assert rules_found(result.violations) == []
    sample = result.samples.filter(F.col("entry_file") == NAME).first()
    assert sample["sampleID"] == "WL_DeepHole_20210603_1126_AN_Angling.20210601"
    assert (sample["dayOfYear"], sample["nAnglers"], sample["siteID"]) == (154, 2, "WL_DeepHole")
    mine = result.records.filter(F.col("entry_file") == NAME)
    assert {(r["fishID"][-2:], r["otu"]) for r in mine.collect()} == {
        ("_1", "largemouth_bass"),
        ("_2", "yellow_perch"),
        ("_3", "largemouth_bass"),
    }

    def log(name):
        return load_or_init(spark, config.root, name, fish.LOG_SCHEMAS[name]).collect()

    # The second sheet has no specimens and adds none.
    assert [(r["fishNum"], r["lengthAtCapture"], r["otolithWeight"]) for r in log("otolith_log")] == [(1.0, 220.0, None)]
    assert [r["fishNum"] for r in log("spine_log")] == [2.0]
    assert [r["fishNum"] for r in log("scale_log")] == [3.0]
    diet = log("diet_log")[0]
    assert (diet["otu"], diet["lakeID"], str(diet["dateSample"])) == ("LMB", "WL", "2021-06-03")


def test_trap_sheet(spark, config):
    rows = [
        {"trapNumber": "MT007", **fish_row(1, "minnow", 50, 1)},
        {"trapNumber": "MT.007", **fish_row(2, "minnow", 51, 1)},
        {"trapNumber": "7", **fish_row(3, "minnow", 52, 1)},
        {"trapNumber": "8", **fish_row("", "NFC", "", "")},
    ]
    result = run_batch(spark, lines(spark, {TRAP_NAME: sheet(rows, TRAP_HEADER, trap=True)}), config, "b1")
    # Minnows and trap 8 are new; nothing else is wrong.
    assert rules_found(result.violations) == ["new_lake_species", "new_otu", "new_siteID"]
    forced = BatchConfig(config.reference, config.root + "2", force=("species", "lakeSpecies", "siteID"))
    result = run_batch(spark, lines(spark, {TRAP_NAME: sheet(rows, TRAP_HEADER, trap=True)}), forced, "b1")
    assert {r["siteID"] for r in result.samples.collect()} == {"WL_MT.007", "WL_MT.008"}
    records = result.records.collect()
    assert {r["sampleID"] for r in records} == {"WL_MT.007_20210603_1126_MT_Trap.20210601"}
    assert {r["otu"] for r in records} == {"minnow_unidentifiable"} and len(records) == 3


def test_bad_trap_code(spark, config):
    rows = [{"trapNumber": "T-9", **fish_row(1, "minnow", 50, 1)}]
    result = run_batch(spark, lines(spark, {TRAP_NAME: sheet(rows, TRAP_HEADER, trap=True)}), config, "b1")
    assert "trap_code" in rules_found(result.violations)


def test_warnings(spark, config):
    text = sheet([fish_row(1)], names=[*COLUMNS, ""], columns=COLUMNS, raw=["2,LMB,220,106.5" + "," * 13 + "stray"])
    unknown = sheet([fish_row(1, color="red")], other(1), columns=[*COLUMNS, "color"])
    result = run_batch(spark, lines(spark, {NAME: text, "b_2021-06-03_1201.csv": unknown}), config, "b1")
    found = {(r["rule"], r["value"]) for r in result.violations.collect()}
    assert ("unnamed_column", None) in found and ("unknown_column", "color") in found
    assert result.records.count() == 3


def test_history_grows_and_reruns_are_idempotent(spark, config):
    text = sheet([fish_row(1, pitApply="N1")])
    for _ in range(2):
        result = run_batch(spark, lines(spark, {NAME: text}), config, "b1")
        assert rules_found(result.violations) == []
        assert load_or_init(spark, config.root, "records", fish.RECORD_SCHEMA).count() == 1
    # The same sheet in a later batch repeats keys and tags of the season.
    again = run_batch(spark, lines(spark, {"c_2021-06-03_1126.csv": text}), config, "b2")
    assert rules_found(again.violations) == [
        "repeat_pitApply",
        "repeat_record_sampleID",
        "repeat_sampleID",
        "season_fishID",
    ]
    # A later sheet may recapture the season's tag.
    later = sheet([fish_row(1, pitRecapture="N1")], other(2))
    assert rules_found(run_batch(spark, lines(spark, {"d_2021-06-03_1202.csv": later}), config, "b3").violations) == []


def test_snapshot_key(spark, tmp_path):
    taken = {"fishID": "WL_DeepHole_20210603_1126_AN_Angling.20210601_1", "otu": "largemouth_bass"}
    config = BatchConfig(reference(spark, [taken]), str(tmp_path))
    result = run_batch(spark, lines(spark, {NAME: sheet([fish_row(1)])}), config, "b1")
    assert rules_found(result.violations) == ["snapshot_fishID"]


def test_optional_rules(spark, tables, tmp_path):
    rows = [fish_row(1, length=300, weight="", pitRecapture="P1")]
    options = fish.Options(growth=True, pit_pattern="^N[0-9]$", tag_placeholders=("unknown",))
    result = run_batch(
        spark, lines(spark, {NAME: sheet(rows)}), BatchConfig(tables, str(tmp_path), options=options), "b1"
    )
    assert rules_found(result.violations) == ["format_pit", "growth", "too_long"]
    blind = sheet([fish_row(1, pitRecapture="unknown")])
    options = fish.Options(tag_placeholders=("unknown",))
    result = run_batch(
        spark, lines(spark, {NAME: blind}), BatchConfig(tables, str(tmp_path / "x"), options=options), "b1"
    )
    assert rules_found(result.violations) == []


def _write(folder, sheets):
    folder.mkdir(exist_ok=True)
    for name, text in sheets.items():
        (folder / name).write_bytes(text.encode())


def test_folder(spark, config, tmp_path):
    folder = tmp_path / "sheets"
    _write(folder, {NAME: sheet([fish_row(1)]), "notes.txt": "hello"})
    first = admit_folder(spark, str(folder), config, "b1")
    assert first.records.count() == 1
    assert [r["value"] for r in first.violations.filter("rule = 'unmatched_file'").collect()] == ["notes.txt"]
    _write(folder, {"new_2021-06-03_1201.csv": sheet([fish_row(1)], other(1))})
    second = admit_folder(spark, str(folder), config, "b2")
    assert [r["entry_file"] for r in second.admitted.collect()] == ["new_2021-06-03_1201.csv"]
    third = admit_folder(spark, str(folder), config, "b3")
    assert third.admitted.count() == 0 and third.records.count() == 0


def test_empty_sheet_is_noticed(spark, config, tmp_path):
    folder = tmp_path / "sheets"
    _write(folder, {NAME: "\r\n\r\n", "short_2021-06-03_1201.csv": "projectID,37\r\n"})
    result = admit_folder(spark, str(folder), config, "b1")
    assert rules_found(result.violations, NAME) == ["empty_sheet"]
    assert "measure_columns" in rules_found(result.violations, "short_2021-06-03_1201.csv")


def test_stream_and_replay(spark, config, tmp_path):
    folder = tmp_path / "sheets"
    _write(folder, {NAME: sheet([fish_row(1)]), "b_2021-06-03_1201.csv": sheet([fish_row(1, weight=200)], other(1))})
    for _ in range(2):
        run_incremental(spark, str(folder), config, str(tmp_path / "checkpoint"))
        records = load_or_init(spark, config.root, "records", fish.RECORD_SCHEMA)
        assert {r["entry_file"] for r in records.collect()} == {NAME}
    _write(folder, {"c_2021-06-03_1202.csv": sheet([fish_row(1)], other(2))})
    run_incremental(spark, str(folder), config, str(tmp_path / "checkpoint"))
    records = load_or_init(spark, config.root, "records", fish.RECORD_SCHEMA)
    assert {r["entry_file"] for r in records.collect()} == {NAME, "c_2021-06-03_1202.csv"}

    forced = BatchConfig(config.reference, config.root, force=("fishWeight",))
    replayed = replay_quarantine(spark, forced, "replay1")
    assert [r["entry_file"] for r in replayed.records.collect()] == ["b_2021-06-03_1201.csv"]
    assert replay_quarantine(spark, forced, "replay2").admitted.count() == 0


def test_command_line(spark, tables, tmp_path, capsys):
    from batchgate import cli

    for name, table in tables.items():
        table.write.parquet(str(tmp_path / "reference" / name))
    folder = tmp_path / "sheets"
    _write(folder, {NAME: sheet([fish_row(1, weight=200)])})
    common = [str(folder), "--reference", str(tmp_path / "reference"), "--root", str(tmp_path / "season")]
    assert cli.main([*common, "--batch", "b1"]) == 1
    assert "too_heavy" in capsys.readouterr().out
    assert cli.main([*common, "--batch", "b2", "--force", "fishWeight"]) == 0
    assert "records of the season: 1" in capsys.readouterr().out
