"""Reading and parsing sheets."""

from __future__ import annotations

import csv
import gzip
import io

import pytest
from hypothesis import HealthCheck, given, settings
from hypothesis import strategies as st
from pyspark.sql import functions as F

from batchgate.operators import parse
from batchgate.sources import sheets as src
from sheetkit import COLUMNS, NAME, fish_row, lines, sheet


@pytest.fixture
def tiny_splits(spark):
    keys = ("spark.sql.files.maxPartitionBytes", "spark.sql.files.openCostInBytes")
    old = {k: spark.conf.get(k) for k in keys}
    spark.conf.set(keys[0], "300")
    spark.conf.set(keys[1], "10")
    yield
    for k, v in old.items():
        spark.conf.set(k, v)


def _folder(tmp_path, sheets):
    for name, text in sheets.items():
        (tmp_path / name).write_bytes(text.encode())
    return str(tmp_path)


def _three(n=200):
    return {
        NAME: sheet([fish_row(i) for i in range(n)]),
        "b_2021-06-03_1127.csv": "\r\n\r\n" + sheet([fish_row(i) for i in range(3)])[1:],
        "minnowtrap1.csv": sheet([{"trapNumber": "MT001", **fish_row(1)}], trap=True),
    }


def _expected(sheets):
    out = set()
    for name, text in sheets.items():
        kept = [x for x in text.removeprefix("﻿").split("\r\n") if x]
        out |= {(name, n, x) for n, x in enumerate(kept, 1)}
    return out


def _read(spark, tmp_path, sheets, **more):
    folder = tmp_path / "in"
    folder.mkdir(exist_ok=True)
    return src.read_sheets(spark, _folder(folder, sheets), str(tmp_path / "scratch"), **more)


def test_lines_of_files(spark, tmp_path):
    sheets = _three()
    got = _read(spark, tmp_path, sheets).lines.select("entry_file", "line_no", "line")
    assert {tuple(r) for r in got.collect()} == _expected(sheets)


@pytest.fixture
def small_chunks(monkeypatch):
    monkeypatch.setattr(src, "CHUNK_LINES", 16)


def test_lines_of_split_files(spark, tmp_path, tiny_splits, small_chunks):
    sheets = _three()
    read = _read(spark, tmp_path, sheets)
    assert spark.read.parquet(str(tmp_path / "scratch/splits")).count() > 10
    assert read.lines.select("entry_file", "chunk").distinct().count() > 10
    assert {tuple(r) for r in read.lines.select("entry_file", "line_no", "line").collect()} == _expected(sheets)


def test_rows_of_split_files(spark, tmp_path, tiny_splits, small_chunks):
    read = _read(spark, tmp_path, _three())
    headers = parse.type_header(parse.parse_sheets(read.lines))
    rows = parse.sheet_rows(read.lines, headers, ["fishNum", "otu", "trapNumber"], ["lakeID"], chunks=read.chunks)
    counts = {r["entry_file"]: r["n"] for r in rows.groupBy("entry_file").agg(F.count("*").alias("n")).collect()}
    assert counts == {NAME: 200, "b_2021-06-03_1127.csv": 3, "minnowtrap1.csv": 1}
    mine = sorted(r["fishNum"] for r in rows.filter(F.col("entry_file") == NAME).collect())
    assert mine == [float(i) for i in range(200)]


def test_files_of_very_unlike_sizes(spark, tmp_path):
    """Default settings cut a large file by what else is scanned; every line must stay, and its number."""
    size = 20_000
    block = "".join(f"{i},LMB,{i % 400},1\r\n" for i in range(size))
    head = sheet([], columns=["fishNum", "species", "fishLength", "fishWeight"])
    sheets = {f"s{k}_2021-06-03_112{k}.csv": head + block * (60 if k == 0 else 5) for k in range(9)}
    read = _read(spark, tmp_path, sheets)
    splits = spark.read.parquet(str(tmp_path / "scratch/splits")).groupBy("entry_file").count()
    assert splits.agg(F.max("count")).first()[0] > 1
    rows = parse.sheet_rows(read.lines, parse.parse_sheets(read.lines), ["fishNum", "otu"], chunks=read.chunks)
    got = rows.groupBy("entry_file").agg(
        F.count("*").alias("n"),
        F.sum("fishNum").alias("total"),
        F.sum((F.col("fishNum") != (F.col("line_no") - 19) % size).cast("int")).alias("misplaced"),
    )
    want = {(f, size * k, size * (size - 1) / 2 * k, 0) for f, k in zip(sorted(sheets), [60] + [5] * 8, strict=True)}
    assert {tuple(r) for r in got.collect()} == want


def test_compressed_sheets(spark, tmp_path, small_chunks):
    (tmp_path / "in").mkdir()
    text = sheet([fish_row(i) for i in range(100)])
    (tmp_path / "in" / f"{NAME}.gz").write_bytes(gzip.compress(text.encode()))
    read = src.read_sheets(spark, str(tmp_path / "in"), str(tmp_path / "scratch"))
    got = {tuple(r) for r in read.lines.select("entry_file", "line_no", "line").collect()}
    assert got == _expected({f"{NAME}.gz": text})
    assert read.lines.select("chunk").distinct().count() > 3


def test_only_sheets_that_are_asked_for_are_staged(spark, tmp_path):
    asked = spark.createDataFrame([(NAME,)], "entry_file string")
    _read(spark, tmp_path, {**_three(5), "notes.txt": "x"}, files=asked)
    staged = spark.read.parquet(str(tmp_path / "scratch/lines"))
    assert {r[0] for r in staged.select("entry_file").distinct().collect()} == {NAME}


def test_one_name_in_two_folders(spark, tmp_path):
    for k in "ab":
        (tmp_path / k).mkdir()
        _folder(tmp_path / k, {NAME: sheet([fish_row(i) for i in range(3)]) + f"only {k}\r\n"})
    read = src.read_sheets(spark, [str(tmp_path / k) for k in "ab"], str(tmp_path / "scratch"))
    assert [tuple(r) for r in read.repeated.collect()] == [(NAME, 2)]
    assert {r["line"] for r in read.lines.filter("line like 'only%'").collect()} == {"only a"}
    assert read.lines.count() == 18 + 4


def test_more_header_lines(spark, tmp_path):
    text = "season,2021\r\n" + sheet([fish_row(1), fish_row(2)])[1:]
    read = _read(spark, tmp_path, {NAME: text})
    headers = parse.parse_sheets(read.lines, header_rows=19)
    assert headers.first()["header"]["season"] == "2021" and len(headers.first()["names"]) == len(COLUMNS)
    rows = parse.sheet_rows(read.lines, headers, ["fishNum"], header_rows=19, chunks=read.chunks)
    assert sorted(r["fishNum"] for r in rows.collect()) == [1.0, 2.0]
    files = spark.createDataFrame([(NAME,)], "entry_file string")
    assert src.discover_sheets(files, header_rows=19).first()["name_line"] == 19


def test_lines_are_cut_once(spark):
    numbered = lines(spark, _three(3))
    parsed = parse.sheet_rows(numbered, parse.parse_sheets(numbered), ["fishNum", "otu", "fishLength"], ["lakeID"][:0])
    plan = parse.drop_empty_rows(parsed)._jdf.queryExecution().optimizedPlan().toString()
    # Once for the lines, twice in the header: its lines and the names.  Texts are cut into lines by another pattern.
    assert 0 < plan.count(f"regexp_extract_all(concat(,, ") == plan.count(parse._CELL) <= 3


def test_content_and_files_agree(spark, tmp_path):
    sheets = _three()
    read = _read(spark, tmp_path, sheets).lines.select("entry_file", "line_no", "line")
    other = lines(spark, sheets)
    assert read.exceptAll(other).count() == 0 and other.exceptAll(read).count() == 0


def test_listing(spark, tmp_path):
    folder = _folder(tmp_path, {**_three(), "notes.txt": "x"})
    files = src.list_files(spark, folder)
    ingested = spark.createDataFrame([(NAME,)], "entry_file string")
    assert {r[0] for r in src.unmatched_files(files, ingested).collect()} == {"notes.txt"}
    pending = {r["entry_file"]: (r["is_trap"], r["name_line"]) for r in src.pending_files(files, ingested).collect()}
    assert pending == {"b_2021-06-03_1127.csv": (False, 18), "minnowtrap1.csv": (True, 17)}


def test_header_repairs(spark):
    header = {
        "projectID": "37",
        "lake ID": "WL",
        "siteName": "wholeshore",
        "dataTimeSet": "2021-06-03 10:00:00",
        "dateTimeSet": None,
        "gear": " FN 12",
        "crew": "a,b,  c",
        "metadataID": "x y",
        "UseCPUE": "yes",
        "distanceShocked": "3",
    }
    text = sheet([], header, drop=("lakeID", "useCPUE", "dateTimeSet"))
    row = parse.type_header(parse.parse_sheets(lines(spark, {NAME: text}))).first()
    assert (row["lakeID"], row["siteName"], row["gear"], row["metadataID"]) == ("WL", "WholeShoreline", "FN", "xy")
    assert str(row["dateTimeSet"]) == "2021-06-03 10:00:00" and str(row["dateSet"]) == "2021-06-03"
    assert (row["crew"], row["useCPUE"], row["distanceShocked"]) == ("a, b,  c", "yes", None)


def test_first_of_duplicates_wins(spark):
    text = "gear,AN\r\n" + sheet([fish_row(1)], columns=[*COLUMNS, "fishNum"], drop=("comments",))[1:]
    sheets = parse.parse_sheets(lines(spark, {NAME: text}))
    row = sheets.first()
    assert row["header"]["gear"] == "AN" and row["duplicate_keys"] == ["gear"]
    assert row["duplicate_names"] == ["fishNum"] and row["positions"]["fishNum"] == 0


def test_short_sheet(spark):
    row = parse.parse_sheets(lines(spark, {NAME: "projectID,37\r\n"})).first()
    assert row["names"] is None and row["header"] == {"projectID": "37"}


_cell = st.text(alphabet=st.sampled_from(list('ab ,"7.NA')), max_size=6)


@settings(max_examples=15, deadline=None, suppress_health_check=[HealthCheck.function_scoped_fixture])
@given(st.lists(st.lists(_cell, min_size=1, max_size=5), min_size=1, max_size=30))
def test_cells_invert_csv(spark, rows):
    texts = []
    for r in rows:
        out = io.StringIO()
        csv.writer(out, lineterminator="").writerow(r)
        texts.append((out.getvalue(),))
    df = spark.createDataFrame(texts, "line string")
    got = [r[0] for r in df.select(parse.cells(F.col("line"))).collect()]
    expected = [[None if c in ("", " ", "NA") else c for c in r] for r in rows]
    assert got == expected


def test_extra_cells(spark):
    text = sheet([], names=["fishNum", "", "species"], raw=["1,x,LMB", "2,,LMB", "3,,LMB,y", "4"])
    numbered = lines(spark, {NAME: text})
    rows = parse.sheet_rows(numbered, parse.parse_sheets(numbered), ["fishNum", "otu"])
    assert {(r["fishNum"], r["otu"], r["extra_data"]) for r in rows.collect()} == {
        (1.0, "LMB", True),
        (2.0, "LMB", False),
        (3.0, "LMB", True),
        (4.0, None, False),
    }
