"""Row-wise rules: ranges, dates, keys."""

from __future__ import annotations

from pyspark.sql import functions as F

from batchgate.catalog import query
from batchgate.catalog.tables import events, lineitem, orders, table
from batchgate.functions.dates import day_of_year
from batchgate.functions.keys import build_key, date_text, key_date, key_field, key_timestamp, time_text
from batchgate.operators import date_rules, ranges

_LINE_ID = "l_orderkey || '_' || l_linenumber"


def _line_ids(spark, sf):
    return lineitem(spark, sf).withColumn("id", build_key(F.col("l_orderkey"), F.col("l_linenumber")))


def _number(df):
    return df.select("entity", "column", F.col("value").cast("double").alias("value")).withColumnRenamed(
        "column", "column_name"
    )


@query(
    "q_range",
    f"""select {_LINE_ID} as entity, 'l_quantity' as column_name, l_quantity as value from lineitem
where l_quantity <= 1 or l_quantity >= 50""",
)
def range_exclusive(spark, sf):
    return _number(ranges.check_range(_line_ids(spark, sf), "l_quantity", 1, 50, entity="id"))


@query(
    "q_range_inclusive",
    f"""select {_LINE_ID} as entity, 'l_quantity' as column_name, l_quantity as value from lineitem
where l_quantity < 1 or l_quantity >= 50""",
)
def range_inclusive(spark, sf):
    return _number(ranges.check_range(_line_ids(spark, sf), "l_quantity", 1, 50, allow_low=True, entity="id"))


@query(
    "q_non_positive",
    """select cast(c_custkey as varchar) as entity, 'c_acctbal' as column_name, c_acctbal as value
from customer where c_acctbal <= 0""",
)
def non_positive(spark, sf):
    c = table(spark, sf, "customer").withColumn("entry_file", F.col("c_mktsegment"))
    return _number(ranges.check_positive(c, ["c_acctbal"], entity="c_custkey"))


@query(
    "q_absolute_cap",
    """select cast(o_orderkey as varchar) as entity, 'o_totalprice' as column_name, o_totalprice as value
from orders where o_totalprice >= 400000""",
)
def absolute_cap(spark, sf):
    return _number(ranges.check_absolute_cap(orders(spark, sf), {"o_totalprice": 400000.0}, entity="o_orderkey"))


@query(
    "q_date_order",
    f"""select {_LINE_ID} as entity, strftime(l_shipdate, '%Y-%m-%d %H:%M:%S') as value
from lineitem join orders on l_orderkey = o_orderkey where l_shipdate < o_orderdate""",
)
def date_order(spark, sf):
    placed = table(spark, sf, "orders").select("o_orderkey", "o_orderdate")
    lines = _line_ids(spark, sf).join(placed, F.col("l_orderkey") == F.col("o_orderkey"))
    out = date_rules.check_dates(lines, [date_rules.order_finding("o_orderdate", "l_shipdate")], entity="id")
    return out.select("entity", "value")


def _keyed_events(spark, sf):
    """Events with a key holding their minute; purchases carry the wrong date, a day late.

    Clicks and views are timed to the minute, the others keep their seconds.
    """
    ts = F.col("ts")
    at = F.when(F.col("event_type").isin("click", "view"), F.date_trunc("minute", ts).cast("timestamp_ntz")).otherwise(ts)
    day = F.when(F.col("event_type") == "purchase", F.date_add(ts.cast("date"), 1)).otherwise(ts.cast("date"))
    key = build_key(
        F.col("event_type"), F.col("user_id"), date_text(ts), time_text(ts), F.lit(None), F.col("event_id")
    )
    return events(spark, sf).withColumn("day", day).withColumn("at", at).withColumn("key", key)


@query(
    "q_build_keys",
    """select event_id, event_type || '_' || user_id || '_' || strftime(ts, '%Y%m%d_%H%M') || '_NA_' || event_id as key,
       cast(user_id as varchar) as user_field, strftime(ts, '%Y-%m-%d') as key_day, strftime(ts, '%Y-%m-%d %H:%M:00') as key_minute
from events""",
)
def build_keys(spark, sf):
    key = F.col("key")
    return _keyed_events(spark, sf).select(
        "event_id",
        "key",
        key_field(key, 2).alias("user_field"),
        key_date(key).cast("string").alias("key_day"),
        key_timestamp(key).cast("string").alias("key_minute"),
    )


@query(
    "q_key_timestamp",
    """select cast(event_id as varchar) as entity from events
where event_type not in ('click', 'view') and date_trunc('minute', ts) <> ts""",
)
def key_timestamp_mismatch(spark, sf):
    finding = date_rules.key_time_finding("key", "at")
    return date_rules.check_dates(_keyed_events(spark, sf), [finding], entity="event_id").select("entity")


@query(
    "q_date_matches",
    """select cast(event_id as varchar) as entity, strftime(cast(ts as date) + interval 1 day, '%Y-%m-%d') as value
from events where event_type = 'purchase'""",
)
def date_matches(spark, sf):
    finding = date_rules.date_part_finding("day", "ts")
    return date_rules.check_dates(_keyed_events(spark, sf), [finding], entity="event_id").select("entity", "value")


@query("q_day_of_year", "select o_orderkey, cast(dayofyear(o_orderdate) as integer) as day_of_year from orders")
def day_of_year_query(spark, sf):
    return table(spark, sf, "orders").select(
        "o_orderkey", day_of_year(F.col("o_orderdate").cast("date")).alias("day_of_year")
    )
