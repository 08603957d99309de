"""Line breaks inside quoted cells, in files that are read split by split."""

from __future__ import annotations

import csv
import io
import random

import pytest
from pyspark.sql import functions as F

from batchgate.operators import parse
from batchgate.sources import quoted
from batchgate.sources import sheets as src
from sheetkit import NAME, fish_row, lines, sheet


@pytest.fixture
def tiny_splits(spark, monkeypatch):
    keys = {"spark.sql.files.maxPartitionBytes": "300", "spark.sql.files.openCostInBytes": "10"}
    old = {k: spark.conf.get(k) for k in keys}
    for k, v in keys.items():
        spark.conf.set(k, v)
    monkeypatch.setattr(src, "CHUNK_LINES", 16)
    yield
    for k, v in old.items():
        spark.conf.set(k, v)


def _read(spark, tmp_path, sheets):
    folder = tmp_path / "in"
    folder.mkdir()
    for name, text in sheets.items():
        (folder / name).write_bytes(text.encode())
    return src.read_sheets(spark, str(folder), str(tmp_path / "scratch"))


def _records(text):
    """Records as lines, by a walk over all characters; a quote without an end is text."""
    text = text.removeprefix("﻿").replace("\r\n", "\n")
    last = text.rfind('"') if text.count('"') % 2 else -1
    out, now, inside = [], "", False
    for i, c in enumerate(text):
        if c == '"' and i != last:
            inside = not inside
        if c == "\n" and not inside:
            out.append(now)
            now = ""
        else:
            now += c
    return [x for x in [*out, now] if x]


def _expected(sheets):
    return {(name, n, x) for name, text in sheets.items() for n, x in enumerate(_records(text), 1)}


def _got(numbered):
    return {tuple(r) for r in numbered.select("entry_file", "line_no", "line").collect()}


def _commented(n, seed, rate=0.3):
    """A sheet whose comments hold line breaks, blank lines, commas and quotes."""
    rng = random.Random(seed)
    parts = ["a", "b,c", '"', "\n", "\n\n", " ", "\n\n\n", "said"]
    rows = []
    for i in range(n):
        comment = "".join(rng.choice(parts) for _ in range(rng.randint(1, 8))) if rng.random() < rate else ""
        rows.append(fish_row(i, comments=comment))
    columns = ["fishNum", "species", "fishLength", "fishWeight", "comments"]
    text = sheet(rows, {"comments": "first line\n\nthird, and last"}, columns=columns)
    return text, rows


def test_cells_over_many_splits(spark, tmp_path, tiny_splits):
    sheets = {NAME: _commented(150, 1)[0], "b_2021-06-03_1127.csv": _commented(40, 2, 1.0)[0]}
    sheets["c_2021-06-03_1128.csv"] = sheet([fish_row(i) for i in range(60)])
    sheets["d_2021-06-03_1129.csv"] = "\r\n\r\n" + sheet([fish_row(i) for i in range(30)])[1:].replace("\r\n", "\r\n\r\n", 9)
    read = _read(spark, tmp_path, sheets)
    assert spark.read.parquet(str(tmp_path / "scratch/splits")).count() > 20
    assert _got(read.lines) == _expected(sheets)


def test_cells_as_the_csv_module_reads_them(spark, tmp_path, tiny_splits):
    text, rows = _commented(120, 3)
    read = _read(spark, tmp_path, {NAME: text})
    headers = parse.type_header(parse.parse_sheets(read.lines))
    assert headers.first()["comments"] == "first line\n\nthird, and last"
    got = parse.sheet_rows(read.lines, headers, ["fishNum", "comments"], chunks=read.chunks).collect()
    table = list(csv.reader(io.StringIO(text.removeprefix("﻿"), newline="")))
    said = {float(r[0]): r[4] for r in table[18:] if r}
    assert len(got) == len(rows) == len(said)
    for r in got:
        comment = said[r["fishNum"]].replace("\r\n", "\n")
        assert (r["comments"] or "") == ("" if comment == " " else comment)
        assert not r["bad_quotes"] and not r["extra_data"]


def test_a_quote_without_an_end(spark, tmp_path, tiny_splits):
    text = sheet([fish_row(i, clipApply="a\nb" if i == 5 else None) for i in range(40)], raw=['40,LMB,"12'] + ["41,LMB,13"] * 20)
    read = _read(spark, tmp_path, {NAME: text})
    assert _got(read.lines) == _expected({NAME: text})
    headers = parse.parse_sheets(read.lines)
    rows = parse.sheet_rows(read.lines, headers, ["fishNum"], chunks=read.chunks)
    assert [r["fishNum"] for r in rows.filter("bad_quotes").collect()] == [40.0]
    assert rows.filter("fishNum = 41").count() == 20


def test_stray_quotes_far_apart_join_nothing(spark, tmp_path, tiny_splits, monkeypatch):
    monkeypatch.setattr(quoted, "CELL_LINES", 10)
    raw = ['1,LMB,"5', *["2,LMB,6"] * 30, '3,LMB,"7', *["4,LMB,8"] * 5]
    read = _read(spark, tmp_path, {NAME: sheet([fish_row(0, clipApply="x\ny")], raw=raw)})
    rows = parse.sheet_rows(read.lines, parse.parse_sheets(read.lines), ["fishNum", "clipApply"], chunks=read.chunks)
    counts = {r["fishNum"]: (r["n"], r["bad"]) for r in rows.groupBy("fishNum").agg(
        F.count("*").alias("n"), F.sum(F.col("bad_quotes").cast("int")).alias("bad")).collect()}
    assert counts == {0.0: (1, 0), 1.0: (1, 1), 2.0: (30, 0), 3.0: (1, 1), 4.0: (5, 0)}
    assert rows.filter("fishNum = 0").first()["clipApply"] == "x\ny"


def test_content_and_files_agree(spark, tmp_path, tiny_splits):
    sheets = {NAME: _commented(60, 4)[0], "b_2021-06-03_1127.csv": _commented(3, 5)[0] + '9,LMB,"open\r\n10,LMB\r\n'}
    assert _got(_read(spark, tmp_path, sheets).lines) == _got(lines(spark, sheets)) == _expected(sheets)


def test_clean_files_are_not_put_together(spark, tmp_path, tiny_splits):
    """Blank lines at the end are no reason to; lines of clean files beside others are not shuffled for it."""
    clean = sheet([fish_row(i) for i in range(50)]) + "\r\n" * 60
    read = _read(spark, tmp_path, {NAME: clean})
    assert not (tmp_path / "scratch/marked").exists()
    assert _got(read.lines) == _expected({NAME: clean})


def test_lines_after_the_last_break_are_not_put_together(spark, tmp_path, tiny_splits):
    """A comment in the header moves the lines below it up; they need neither a sort nor another table."""
    rows = [fish_row(i) for i in range(300)]
    sheets = {
        NAME: sheet(rows, {"comments": "first line\n\nthird"}) + "\r\n" * 40,
        "b_2021-06-03_1127.csv": sheet(rows, {"comments": "one\ntwo"}).replace("\r\n7,", "\r\n\r\n\r\n7,", 1),
        "c_2021-06-03_1128.csv": sheet(rows) + '300,LMB,"12',
        "d_2021-06-03_1129.csv": sheet(rows),
    }
    read = _read(spark, tmp_path, sheets)
    marked = spark.read.parquet(str(tmp_path / "scratch/marked")).groupBy("entry_file").count().collect()
    counts = {r["entry_file"]: r["count"] for r in marked}
    assert counts[NAME] == 3 and counts["b_2021-06-03_1127.csv"] < 60
    assert counts["c_2021-06-03_1128.csv"] == 1 and "d_2021-06-03_1129.csv" not in counts
    assert _got(read.lines) == _expected(sheets)
    headers = parse.type_header(parse.parse_sheets(read.lines))
    found = parse.sheet_rows(read.lines, headers, ["fishNum"], chunks=read.chunks).groupBy("entry_file").agg(F.sum("fishNum"))
    last = {"c_2021-06-03_1128.csv": 300.0}
    assert {tuple(r) for r in found.collect()} == {(f, 299 * 150.0 + last.get(f, 0)) for f in sheets}


def test_other_files_are_named_by_the_same_scan(spark, tmp_path):
    (tmp_path / "in").mkdir()
    (tmp_path / "in" / NAME).write_text(sheet([fish_row(1)]))
    (tmp_path / "in" / "notes.txt").write_text("x\ny\n")
    scan = src.located(spark.read.text(str(tmp_path / "in")))
    scan = scan.withColumn("value", F.when(src.is_sheet(F.col("entry_file")), F.col("value")))
    read = src.number_lines(scan, str(tmp_path / "scratch"))
    assert [r[0] for r in read.others.collect()] == ["notes.txt"]
    assert {r[0] for r in read.lines.select("entry_file").distinct().collect()} == {NAME}


def test_a_large_sheet_in_several_tasks(spark, tmp_path):
    """40 MB, of which every fifth line holds a cell of two lines."""
    size = 1_000_000
    head = sheet([], columns=["fishNum", "species", "fishLength", "fishWeight", "comments"])
    body = "".join(f'{i},LMB,{i % 400},1,"seen at the dock,\r\nlate"\r\n' if i % 5 == 0 else f"{i},LMB,{i % 400},1,early in the morning\r\n" for i in range(size))
    old = spark.conf.get("spark.sql.files.maxPartitionBytes")
    spark.conf.set("spark.sql.files.maxPartitionBytes", str(4 << 20))
    try:
        read = _read(spark, tmp_path, {NAME: head + body})
        assert spark.read.parquet(str(tmp_path / "scratch/splits")).count() >= 8
        rows = parse.sheet_rows(read.lines, parse.parse_sheets(read.lines), ["fishNum", "comments"], chunks=read.chunks)
        late = F.col("comments") == "seen at the dock,\nlate"
        got = rows.agg(
            F.count("*"),
            F.sum("fishNum"),
            F.sum((F.col("fishNum") != F.col("line_no") - 19).cast("int")),
            F.sum((late != (F.col("fishNum") % 5 == 0)).cast("int")),
        ).first()
    finally:
        spark.conf.set("spark.sql.files.maxPartitionBytes", old)
    assert tuple(got) == (size, size * (size - 1) / 2, 0, 0)
