"""Outliers against group history."""

from __future__ import annotations

from pyspark.sql import functions as F

from batchgate.catalog import query
from batchgate.catalog.tables import EVENT_CUTOFF, ORDER_CUTOFF, events, lineitem, orders, split_at, table
from batchgate.functions.keys import build_key
from batchgate.operators import outliers as o

_T = "2.5758293035489004"


def t_sql(nu: str) -> str:
    """The same expansion of the 99.5 % t quantile, in SQL."""
    z = float(_T)
    terms = (
        (z**3 + z) / 4,
        (5 * z**5 + 16 * z**3 + 3 * z) / 96,
        (3 * z**7 + 19 * z**5 + 17 * z**3 - 15 * z) / 384,
        (79 * z**9 + 776 * z**7 + 1482 * z**5 - 1920 * z**3 - 945 * z) / 92160,
    )
    return "(" + " + ".join([_T] + [f"{t!r}::double / pow({nu}, {i})" for i, t in enumerate(terms, 1)]) + ")"


@query(
    "q_zscore_outliers",
    f"""with h as (select event_type, count(*) as n, avg(value) as mn, stddev_samp(value) as sd from events
  where ts < timestamp '{EVENT_CUTOFF}' and value > 0 group by 1)
select cast(event_id as varchar) as entity, case when value > mn + 3 * sd then 'too_long' else 'too_short' end as rule, value
from events join h using (event_type)
where ts >= timestamp '{EVENT_CUTOFF}' and n >= 15 and (value > mn + 3 * sd or value < mn - 3 * sd)""",
)
def zscore_outliers(spark, sf):
    batch, history = split_at(events(spark, sf), "ts", EVENT_CUTOFF)
    out = o.check_zscore(batch, history, "event_type", "value", "event_id")
    return out.select("entity", "rule", F.col("value").cast("double").alias("value"))


@query(
    "q_min_history",
    f"""with h as (select o_custkey, count(*) as n from orders
  where o_orderdate < timestamp '{ORDER_CUTOFF}' and o_totalprice > 0 group by 1)
select b.o_custkey, coalesce(n, 0) as n from (select distinct o_custkey from orders where o_orderdate >= timestamp '{ORDER_CUTOFF}') b
left join h on h.o_custkey = b.o_custkey where coalesce(n, 0) < 15""",
)
def min_history(spark, sf):
    batch, history = split_at(orders(spark, sf), "o_orderdate", ORDER_CUTOFF)
    stats = o.group_statistics(history, "o_custkey", "o_totalprice")
    return o.min_history_gaps(batch, stats, "o_custkey").withColumnRenamed("batch_group", "o_custkey")


_BRANDED = f"""
with l as (select *, l_shipdate >= timestamp '{ORDER_CUTOFF}' as is_new from lineitem join part on p_partkey = l_partkey),
fit as (
  select p_brand, count(*) as n, avg(ln(l_quantity)) as mx, regr_slope(ln(l_extendedprice), ln(l_quantity)) as b,
         regr_intercept(ln(l_extendedprice), ln(l_quantity)) as a, regr_sxx(ln(l_extendedprice), ln(l_quantity)) as sxx,
         sqrt((regr_syy(ln(l_extendedprice), ln(l_quantity))
               - pow(regr_sxy(ln(l_extendedprice), ln(l_quantity)), 2) / regr_sxx(ln(l_extendedprice), ln(l_quantity)))
              / (count(*) - 2)) as s
  from l where not is_new and l_quantity > 0 and l_extendedprice > 0 group by 1 having count(*) >= 15)
"""


def _branded(spark, sf):
    part = table(spark, sf, "part").select("p_partkey", "p_brand")
    lines = lineitem(spark, sf).withColumn("id", build_key(F.col("l_orderkey"), F.col("l_linenumber")))
    joined = lines.join(part, F.col("l_partkey") == F.col("p_partkey"))
    return split_at(joined, "l_shipdate", ORDER_CUTOFF)


@query(
    "q_regression_fit",
    _BRANDED + "select p_brand, n, round(b, 4) as slope, round(a, 4) as intercept, round(s, 4) as resid_sd from fit",
)
def regression_fit(spark, sf):
    _, history = _branded(spark, sf)
    fit = o.regression_table(o.group_statistics(history, "p_brand", "l_quantity", "l_extendedprice"))
    return fit.select(
        F.col("stat_group").alias("p_brand"), "n", *[F.round(c, 4).alias(c) for c in ("slope", "intercept", "resid_sd")]
    )


@query(
    "q_statistics_merged",
    _BRANDED
    + """, lengths as (select p_brand, count(*) as len_n, avg(l_quantity) as mn, stddev_samp(l_quantity) as sd
  from l where not is_new and l_quantity > 0 group by 1)
select p_brand, n, round(b, 4) as slope, round(a, 4) as intercept, round(s, 4) as resid_sd, len_n,
  round(mn, 6) as len_mean, round(sd, 6) as len_sd from fit join lengths using (p_brand)""",
)
def statistics_merged(spark, sf):
    """Statistics of each month of history, merged, as admission keeps them by batch."""
    _, history = _branded(spark, sf)
    months = o.group_statistics(history, "p_brand", "l_quantity", "l_extendedprice", part="entry_file")
    merged = o.merge_statistics(months)
    fit = o.regression_table(merged).withColumnRenamed("stat_group", "p_brand")
    lengths = merged.select(F.col("stat_group").alias("p_brand"), "len_n", "len_mean", "len_sd")
    return fit.join(lengths, "p_brand").select(
        "p_brand",
        "n",
        *[F.round(c, 4).alias(c) for c in ("slope", "intercept", "resid_sd")],
        "len_n",
        *[F.round(c, 6).alias(c) for c in ("len_mean", "len_sd")],
    )


@query(
    "q_regression_outliers",
    _BRANDED
    + f""", p as (select *, a + b * ln(l_quantity) as mid,
    {t_sql("(n - 2)")} * s * sqrt(1 + 1.0 / n + pow(ln(l_quantity) - mx, 2) / sxx) as half
  from l join fit using (p_brand) where is_new)
select l_orderkey || '_' || l_linenumber as entity,
       case when l_extendedprice > exp(mid + half) then 'too_heavy' else 'too_light' end as rule, l_extendedprice as value
from p where l_extendedprice > exp(mid + half) or l_extendedprice < exp(mid - half)""",
)
def regression_outliers(spark, sf):
    batch, history = _branded(spark, sf)
    out = o.check_regression_interval(batch, history, "p_brand", "l_quantity", "l_extendedprice", "id")
    return out.select("entity", "rule", F.col("value").cast("double").alias("value"))
