"""Unseen values, repeats, combinations, duplicate keys."""

from __future__ import annotations

from pyspark.sql import functions as F

from batchgate.catalog import query
from batchgate.catalog.tables import ORDER_CUTOFF, lineitem, orders, split_at, table
from batchgate.operators import membership as m
from batchgate.operators.violations import Rule

_ORDERS = f"""
with n as (select *, strftime(o_orderdate, '%Y-%m') as entry_file from orders where o_orderdate >= timestamp '{ORDER_CUTOFF}'),
     h as (select * from orders where o_orderdate < timestamp '{ORDER_CUTOFF}')
"""
_LINES = f"""
with n as (select *, strftime(l_shipdate, '%Y-%m') as entry_file from lineitem where l_shipdate >= timestamp '{ORDER_CUTOFF}'),
     h as (select * from lineitem where l_shipdate < timestamp '{ORDER_CUTOFF}')
"""


def _orders(spark, sf):
    return split_at(orders(spark, sf), "o_orderdate", ORDER_CUTOFF)


def _lines(spark, sf):
    return split_at(lineitem(spark, sf), "l_shipdate", ORDER_CUTOFF)


def _found(df):
    return df.select("rule", F.col("column").alias("column_name"), "value", "entry_file")


@query(
    "q_new_values",
    _ORDERS
    + """select distinct 'new_o_custkey' as rule, 'o_custkey' as column_name, cast(o_custkey as varchar) as value, entry_file
from n where not exists (select 1 from h where h.o_custkey is not distinct from n.o_custkey)""",
)
def new_values(spark, sf):
    return _found(m.check_new_values(*_orders(spark, sf), "o_custkey"))


@query(
    "q_new_values_multi",
    _ORDERS
    + ", ".join(
        [""]
        + [
            f"""x_{c} as (select distinct 'new_{c}' as rule, '{c}' as column_name, cast({c} as varchar) as value, entry_file
from n where not exists (select 1 from h where h.{c} is not distinct from n.{c}))"""
            for c in ("o_custkey", "o_orderkey", "o_orderstatus", "o_orderpriority")
        ]
    )
    + """
select * from x_o_custkey union all select * from x_o_orderkey
union all select * from x_o_orderstatus union all select * from x_o_orderpriority""",
)
def new_values_multi(spark, sf):
    columns = ["o_custkey", "o_orderkey", "o_orderstatus", "o_orderpriority"]
    return _found(m.check_new_values_multi(*_orders(spark, sf), columns))


@query(
    "q_new_combos",
    _ORDERS
    + """select distinct o_custkey || '_' || o_orderpriority as value, entry_file from n
where not exists (select 1 from h where h.o_custkey = n.o_custkey and h.o_orderpriority = n.o_orderpriority)""",
)
def new_combos(spark, sf):
    out = m.check_new_combos(*_orders(spark, sf), ["o_custkey", "o_orderpriority"])
    return out.select("value", "entry_file")


@query(
    "q_combo_precedent",
    _ORDERS
    + """, applied as (
  select o_custkey, o_orderpriority as clip from h where o_orderstatus <> 'P'
  union select o_custkey, o_orderpriority from n where o_orderstatus <> 'P')
select distinct cast(o_orderkey as varchar) as entity, o_custkey || '_' || o_orderpriority as value, entry_file from n
where o_orderstatus = 'P'
  and not exists (select 1 from applied a where a.o_custkey = n.o_custkey and a.clip = n.o_orderpriority)""",
)
def combo_precedent(spark, sf):
    """Partial orders recapture a priority, all others apply it, per customer."""
    partial = F.col("o_orderstatus") == "P"
    marked = (
        orders(spark, sf)
        .withColumn("clipApply", F.when(~partial, F.col("o_orderpriority")))
        .withColumn("clipRecapture", F.when(partial, F.col("o_orderpriority")))
    )
    batch, history = split_at(marked, "o_orderdate", ORDER_CUTOFF)
    out = m.check_precedent(batch, history, ["o_custkey"], "clipApply", "clipRecapture", entity="o_orderkey")
    return out.select("entity", "value", "entry_file")


_SEGMENTS = ("AUTOMOBILE", "BUILDING", "FURNITURE")
_RETIRED = (1, 2, 4, 5, 7, 8, 9, 10, 11, 12, 14, 16)


@query(
    "q_vocab",
    f"""select distinct c_mktsegment as value, cast(c_nationkey as varchar) as entry_file from customer
where c_mktsegment is null or c_mktsegment not in {_SEGMENTS}""",
)
def vocab(spark, sf):
    c = table(spark, sf, "customer").withColumn("entry_file", F.col("c_nationkey").cast("string"))
    return m.check_vocab(c, "c_mktsegment", _SEGMENTS).select("value", "entry_file")


@query(
    "q_retired_values",
    f"select distinct cast(p_size as varchar) as value, p_brand as entry_file from part where p_size in {_RETIRED}",
)
def retired_values(spark, sf):
    p = table(spark, sf, "part").withColumn("entry_file", F.col("p_brand"))
    return m.check_retired(p, "p_size", _RETIRED).select("value", "entry_file")


@query(
    "q_repeats",
    _LINES
    + """select distinct cast(l_orderkey as varchar) as value, entry_file from n
where exists (select 1 from h where h.l_orderkey = n.l_orderkey)""",
)
def repeats(spark, sf):
    out = m.check_repeats(*_lines(spark, sf), "l_orderkey", skip_nulls=True)
    return out.select("value", "entry_file")


@query(
    "q_dup_history",
    _LINES
    + """select distinct l_orderkey || '_' || l_linenumber as value, entry_file from n
where exists (select 1 from h where h.l_orderkey = n.l_orderkey and h.l_linenumber = n.l_linenumber)""",
)
def dup_history(spark, sf):
    out = m.check_repeats(*_lines(spark, sf), ["l_orderkey", "l_linenumber"])
    return out.select("value", "entry_file")


@query(
    "q_dup_internal",
    """select l_orderkey || '_' || l_linenumber as value, strftime(l_shipdate, '%Y-%m') as entry_file from (
  select *, count(*) over (partition by l_orderkey, l_linenumber) as c from lineitem) where c > 1""",
)
def dup_internal(spark, sf):
    out = m.check_duplicate_keys(lineitem(spark, sf), ["l_orderkey", "l_linenumber"])
    return out.select("value", "entry_file")


@query(
    "q_key_rules",
    _LINES
    + """, b as (select * from n where l_returnflag = 'R')
select distinct 'new_part' as rule, null as entity, cast(l_partkey as varchar) as value, entry_file from n
where not exists (select 1 from h where h.l_partkey = n.l_partkey)
union all
select distinct 'repeat_line', null, l_orderkey || '_' || l_linenumber, entry_file from n
where exists (select 1 from h where h.l_orderkey = n.l_orderkey and h.l_linenumber = n.l_linenumber)
union all
select distinct 'new_part_supplier', null, l_partkey || '_' || l_suppkey, entry_file from n
where not exists (select 1 from h where h.l_partkey = n.l_partkey and h.l_suppkey = n.l_suppkey)
union all
select distinct 'returned_before', cast(l_orderkey as varchar), cast(l_partkey as varchar), entry_file from b
where exists (select 1 from h where h.l_partkey = b.l_partkey and h.l_returnflag = 'R')""",
)
def key_rules(spark, sf):
    """Four rules of both kinds, one of them on a nullable key: history is read once for all."""
    returned = F.when(F.col("l_returnflag") == "R", F.col("l_partkey"))
    batch, history = split_at(
        lineitem(spark, sf).withColumn("returned_part", returned), "l_shipdate", ORDER_CUTOFF
    )

    def rule(name, *columns, **more):
        return m.KeyRule(Rule(name), columns, {"history": columns}, **more)

    rules = [
        rule("new_part", "l_partkey"),
        rule("repeat_line", "l_orderkey", "l_linenumber", unseen=False),
        rule("new_part_supplier", "l_partkey", "l_suppkey"),
        rule("returned_before", "returned_part", unseen=False, skip_nulls=True, entity="l_orderkey"),
    ]
    found = m.check_keys(batch, {"history": history}, rules)
    return found.select("rule", "entity", "value", "entry_file")
