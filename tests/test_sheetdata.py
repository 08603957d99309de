"""Sheets written from orders: how the work is dealt to tasks."""

from __future__ import annotations

import pytest
from pyspark.sql import functions as F

from batchgate.catalog import sheetdata, sheets

ORDERS = 1000


@pytest.fixture
def orders(spark, tmp_path):
    key = F.col("id")
    spark.range(ORDERS).select(
        key.alias("o_orderkey"),
        (key % 7).alias("o_custkey"),
        F.element_at(F.array(*[F.lit(x) for x in "FOP"]), (key % 3 + 1).cast("int")).alias("o_orderstatus"),
        (key * 1000.0).alias("o_totalprice"),
        F.expr("timestamp_ntz'1995-01-01' + make_dt_interval(cast(id as int))").alias("o_orderdate"),
        F.when(key % 5 == 0, "1-URGENT").otherwise("5-LOW").alias("o_orderpriority"),
    ).write.parquet(f"{tmp_path}/orders.parquet")
    return str(tmp_path)


def test_tasks_hold_a_bounded_number_of_orders(spark, orders, monkeypatch):
    monkeypatch.setattr(sheetdata, "TASK_ORDERS", 50, raising=False)
    lines = sheetdata.top_lines(spark, orders)
    held = lines.groupBy(F.spark_partition_id().alias("task")).agg(F.count_distinct("entry_file").alias("n"))
    sizes = [r["n"] for r in held.collect()]
    assert sum(sizes) == ORDERS
    assert max(sizes) < 100


def test_two_rules_parse_the_sheets_once(spark, orders):
    found = sheets.required_columns(spark, orders)
    assert "collect_list" not in found._jdf.queryExecution().optimizedPlan().toString()
    partial = sum(k % 3 == 2 and k % 5 != 0 for k in range(ORDERS))
    dear = sum(k * 1000 > 450000 and k % 5 != 0 for k in range(ORDERS))
    got = {r["name"]: r["count"] for r in found.groupBy("name").count().collect()}
    assert got == {"floyApply": partial, "trapNumber (forbidden)": dear}


def test_heads_of_files_are_made_after_the_sort(spark, orders, tmp_path):
    spark.range(ORDERS).select(
        F.col("id").alias("l_orderkey"), F.lit(1).alias("l_linenumber"), F.lit(2.0).alias("l_quantity"), F.lit("R").alias("l_returnflag")
    ).write.parquet(f"{orders}/lineitem.parquet")
    written = sheetdata.season_files(spark, orders, f"{tmp_path}/in")
    plan = written._jdf.queryExecution().optimizedPlan().toString()
    above, sort, below = plan.partition("Sort [")
    assert sort and "useSampleMarkRecap" in above and "useSampleMarkRecap" not in below
    months = {r["entry_file"]: r["lines"] for r in written.collect()}
    assert len(months) == 33 and sum(months.values()) == ORDERS
    text = (tmp_path / "in" / "s0_1996-05-01_0000.csv").read_bytes().decode()
    assert text.startswith("projectID,37\r\n") and "dateTimeSet,2021-06-03 06:05:00\r\n" in text
    assert text.count("projectID") == 1 and text.count(",LMB,") == months["s0_1996-05-01_0000.csv"]
