"""Line numbers of pending sheets when they are joined by a shuffle."""

from __future__ import annotations

import pytest

from batchgate.sources import sheets as src
from sheetkit import NAME, fish_row, sheet


@pytest.fixture
def shuffled_and_spilled(spark):
    """Joins that shuffle and sort, and sorts that spill every few hundred rows."""
    key, force = "spark.sql.autoBroadcastJoinThreshold", "spark.shuffle.spill.numElementsForceSpillThreshold"
    old, env = spark.conf.get(key), spark._jvm.org.apache.spark.SparkEnv.get().conf()
    spark.conf.set(key, "-1")
    env.set(force, "300")
    yield
    spark.conf.set(key, old)
    env.remove(force)


def test_pending_lines_keep_their_numbers_through_a_shuffled_join(spark, tmp_path, shuffled_and_spilled):
    names = [NAME, "b_2021-06-03_1127.csv", "c_2021-06-03_1128.csv"]
    texts = {n: sheet([fish_row(i) for i in range(k)]) for n, k in zip(names, (4000, 50, 700), strict=True)}
    (tmp_path / "in").mkdir()
    for name, text in texts.items():
        (tmp_path / "in" / name).write_bytes(text.encode())
    pending = spark.createDataFrame([(names[0],), (names[2],)], "entry_file string")
    read = src.read_sheets(spark, str(tmp_path / "in"), str(tmp_path / "scratch"), files=pending)
    got = {tuple(r) for r in read.lines.select("entry_file", "line_no", "line").collect()}
    want = set()
    for name in (names[0], names[2]):
        kept = [x for x in texts[name].removeprefix("﻿").split("\r\n") if x]
        want |= {(name, n, x) for n, x in enumerate(kept, 1)}
    assert got == want
