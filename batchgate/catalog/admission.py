"""Overrides, the gate and the report, on three rules over orders."""

from __future__ import annotations

from pyspark.sql import functions as F

from batchgate.catalog import query
from batchgate.catalog.sheetdata import fresh_folder
from batchgate.catalog.tables import ORDER_CUTOFF, orders, split_at, table
from batchgate.operators import gate as g
from batchgate.operators import membership as m
from batchgate.operators.ranges import check_range
from batchgate.operators.violations import Rule, union_violations
from batchgate.session import stage

_RULES = (
    Rule("new_customer", 1, force_keys=("customer",)),
    Rule("new_combo", 2, force_keys=("customer", "priority")),
    Rule("price", 3),
)

# Each customer is a file.  Customers of one segment may bring new things; new priorities are fine
# everywhere, but a new combination also needs its customer forced.
_JUDGED = f"""
with n as (select *, 'c' || o_custkey as entry_file from orders where o_orderdate >= timestamp '{ORDER_CUTOFF}'),
h as (select * from orders where o_orderdate < timestamp '{ORDER_CUTOFF}'),
forced as (select 'c' || c_custkey as entry_file from customer where c_mktsegment = 'BUILDING'),
v as (
  select distinct 1 as rule_order, 'new_customer' as rule, cast(o_custkey as varchar) as value, entry_file from n
  where o_custkey not in (select o_custkey from h)
  union all
  select distinct 2, 'new_combo', o_custkey || '_' || o_orderpriority, entry_file from n
  where not exists (select 1 from h where h.o_custkey = n.o_custkey and h.o_orderpriority = n.o_orderpriority)
  union all
  select 3, 'price', cast(o_orderkey as varchar), entry_file from n where o_totalprice >= 495000 or o_totalprice <= 1200),
judged as (select v.*, rule_order = 3 or entry_file not in (select entry_file from forced) as blocking from v)
"""


def _judged(spark, sf):
    name = F.concat(F.lit("c"), F.col("o_custkey").cast("string"))
    batch, history = split_at(orders(spark, sf).withColumn("entry_file", name), "o_orderdate", ORDER_CUTOFF)
    names = (("o_custkey",), ("o_custkey", "o_orderpriority"))
    new = [m.KeyRule(rule, key, {"history": key}) for rule, key in zip(_RULES, names, strict=False)]
    found = union_violations(
        spark,
        [
            m.check_keys(batch, {"history": history}, new),
            check_range(batch, "o_totalprice", 1200, 495000, rule=_RULES[2], entity="o_orderkey"),
        ],
    )
    found = found.withColumn("value", F.coalesce("entity", "value"))
    customers = table(spark, sf, "customer")
    per_file = customers.filter(F.col("c_mktsegment") == "BUILDING").select(
        F.lit("customer").alias("rule"),
        F.concat(F.lit("c"), F.col("c_custkey").cast("string")).alias("entry_file"),
        F.lit("checked").alias("reason"),
    )
    everywhere = spark.range(1).select(
        F.lit("priority").alias("rule"), F.lit(None).cast("string").alias("entry_file"), F.lit("fine").alias("reason")
    )
    return batch, g.apply_overrides(found, per_file.unionByName(everywhere))


def _staged(spark, sf):
    """The judged violations as admission has them: a table, which the gate counts by file and as a whole."""
    batch, judged = _judged(spark, sf)
    return batch, stage(judged, f"{fresh_folder(spark)}/judged")


@query("q_overrides", _JUDGED + "select rule, value, entry_file, blocking from judged")
def overrides_query(spark, sf):
    return _judged(spark, sf)[1].select("rule", "value", "entry_file", "blocking")


@query(
    "q_violation_summary",
    _JUDGED
    + """select rule_order, rule, 'error' as severity, count(*) as n_violations, count(*) filter (blocking) as n_blocking,
  count(distinct entry_file) as n_files from judged group by 1, 2""",
)
def violation_summary(spark, sf):
    return g.summary_by_rule(_judged(spark, sf)[1])


@query(
    "q_gate",
    _JUDGED
    + """, files as (select entry_file, (select count(*) from judged j where j.entry_file = f.entry_file and blocking) as n_blocking
  from (select distinct entry_file from n) f)
select 'batch' as mode, entry_file, n_blocking, (select count(*) from judged where blocking) = 0 as admitted from files
union all select 'file', entry_file, n_blocking, n_blocking = 0 from files""",
)
def gate_query(spark, sf):
    batch, judged = _staged(spark, sf)
    return g.decisions(batch.select("entry_file"), judged)


@query(
    "q_quarantine",
    _JUDGED
    + "select o_orderkey, entry_file from n where entry_file not in (select entry_file from judged where blocking)",
)
def quarantine_query(spark, sf):
    batch, judged = _staged(spark, sf)
    return g.quarantine(batch, judged).select("o_orderkey", "entry_file")
