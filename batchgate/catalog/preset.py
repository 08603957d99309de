"""The whole rule groups of the fish preset, with line items as records and orders as samples.

Time splits the tables three ways: the snapshot, the running season, and the new batch.
"""

from __future__ import annotations

from pyspark.sql import functions as F

from batchgate.catalog import query
from batchgate.catalog.outliers import t_sql
from batchgate.catalog.sheetdata import fresh_folder
from batchgate.catalog.tables import ORDER_CUTOFF, month, table
from batchgate.functions.dates import day_of_year
from batchgate.functions.keys import build_key, date_text
from batchgate.operators.membership import check_duplicate_keys
from batchgate.operators.violations import union_violations
from batchgate.plans import fish
from batchgate.session import stage

SEASON_START = "2000-07-01"

_RECORDS = f"""
with r as (
  select l_returnflag as lake, l_returnflag || '_' || l_linestatus || '_2001' || strftime(l_shipdate, '%m%d') || '_0000_AN_m' as sample_id,
    l_returnflag || '_' || l_linestatus || '_2001' || strftime(l_shipdate, '%m%d') || '_0000_AN_m_' || (l_suppkey * 10 + l_linenumber) as fish_id,
    try_strptime('2001' || strftime(l_shipdate, '%m%d'), '%Y%m%d') as key_day,
    case when l_tax = 0.08 and l_discount = 0.1 then 'P' || l_partkey else 'S' || l_suppkey end as otu, l_quantity as len,
    l_extendedprice as wt, 'T' || l_partkey || '-' || left(l_suppkey::varchar, 1) as tag, 'C' || left(l_partkey::varchar, 3) as clip,
    l_linenumber as k, strftime(l_shipdate, '%Y-%m') as entry_file,
    case when l_shipdate >= timestamp '{ORDER_CUTOFF}' then 2 when l_shipdate >= timestamp '{SEASON_START}' then 1 else 0 end as source
  from lineitem),
n as (select * from r where source = 2), h as (select * from r where source < 2), db as (select * from r where source = 0),
fit as (select otu, count(*) as n, avg(len) as mn, stddev_samp(len) as sd, avg(ln(len)) as mx, regr_slope(ln(wt), ln(len)) as b,
    regr_intercept(ln(wt), ln(len)) as a, regr_sxx(ln(wt), ln(len)) as sxx,
    sqrt((regr_syy(ln(wt), ln(len)) - pow(regr_sxy(ln(wt), ln(len)), 2) / regr_sxx(ln(wt), ln(len))) / (count(*) - 2)) as s
  from db where len > 0 and wt > 0 group by 1 having count(*) > 2),
judged as (select n.*, f.n as hist, f.mn, f.sd, a + b * ln(len) as mid,
    {t_sql("(f.n - 2)")} * s * sqrt(1 + 1.0 / f.n + pow(ln(len) - mx, 2) / sxx) as half
  from n join fit f using (otu) where f.n >= 15),
registry as (select * from (select *, case when k = 2 then 'pit' else 'floy' end as kind,
      row_number() over (partition by tag order by key_day nulls last, source, fish_id, k = 2, otu, lake) as rn
    from r where k in (2, 4)) where rn = 1),
linked as (select n.fish_id, n.tag, n.entry_file, case when n.k = 3 then 'pit' else 'floy' end <> g.kind as type_differs,
    case when g.tag is null then 'tag_never_applied' when n.otu = g.otu and n.lake = g.lake then 'none'
      when n.otu <> g.otu and n.lake <> g.lake then 'tag_wrong_both' when n.lake = g.lake then 'tag_wrong_species'
      else 'tag_wrong_lake' end as problem
  from n left join registry g on g.tag = n.tag where n.k in (3, 5))
select distinct 'new_otu' as rule, null as entity, otu as value, entry_file from n where otu not in (select otu from h)
union all select distinct 'snapshot_fishID', null, fish_id, entry_file from n where fish_id in (select fish_id from db)
union all select distinct 'season_fishID', null, fish_id, entry_file from n where fish_id in (select fish_id from r where source = 1)
union all select distinct 'repeat_record_sampleID', null, sample_id, entry_file from n where sample_id in (select sample_id from h)
union all select distinct 'new_clipApply', null, clip, entry_file from n where k = 1 and clip not in (select clip from h where k = 1)
union all select distinct 'repeat_pitApply', null, tag, entry_file from n where k = 2 and tag in (select tag from h where k = 2)
union all select distinct 'repeat_floyApply', null, tag, entry_file from n where k = 4 and tag in (select tag from h where k = 4)
union all select distinct 'new_lake_species', null, lake || '_' || otu, entry_file from n
  where not exists (select 1 from h where h.lake = n.lake and h.otu = n.otu)
union all select distinct 'clip_recapture', fish_id, clip || '_' || lake || '_' || otu, entry_file from n
  where k = 6 and not exists (select 1 from r where r.k = 1 and r.clip = n.clip and r.lake = n.lake and r.otu = n.otu)
union all select 'dup_fishID', fish_id, fish_id, entry_file from (select *, count(*) over (partition by fish_id) as c from n) where c > 1
union all select 'too_long', fish_id, len::varchar, entry_file from judged where len > mn + 3 * sd
union all select 'too_short', fish_id, len::varchar, entry_file from judged where len < mn - 3 * sd
union all select 'too_heavy', fish_id, wt::varchar, entry_file from judged where wt > exp(mid + half)
union all select 'too_light', fish_id, wt::varchar, entry_file from judged where wt < exp(mid - half)
union all select x.rule, null, otu, null from (select distinct otu from n) b cross join (values ('few_lengths'), ('few_weights')) as x(rule)
  where (select count(*) from db where db.otu = b.otu) < 15
union all select 'tag_type', fish_id, tag, entry_file from linked where type_differs
union all select problem, fish_id, tag, entry_file from linked where problem <> 'none'
"""


def _split_three(df, column):
    new, season = (F.lit(d).cast("timestamp_ntz") for d in (ORDER_CUTOFF, SEASON_START))
    at = F.col(column)
    return df.filter(at >= new), df.filter(at < season), df.filter((at >= season) & (at < new))


def line_records(spark, sf_dir):
    """Line items in the shape of records; the key repeats the day of the year in one and the same year."""
    k, part = F.col("l_linenumber"), F.col("l_partkey").cast("string")
    supplier = F.col("l_suppkey").cast("string")
    tag = F.concat(F.lit("T"), part, F.lit("-"), F.left(supplier, F.lit(1)))
    clip = F.concat(F.lit("C"), F.left(part, F.lit(3)))
    rare = (F.col("l_tax") == 0.08) & (F.col("l_discount") == 0.1)
    day = F.concat(F.lit("2001"), F.substring(date_text(F.col("l_shipdate")), 5, 4))
    sample = build_key(
        F.col("l_returnflag"), F.col("l_linestatus"), day, F.lit("0000"), F.lit("AN"), F.lit("m")
    )
    number = F.col("l_suppkey") * 10 + k
    return table(spark, sf_dir, "lineitem").select(
        "l_shipdate",
        sample.alias("sampleID"),
        build_key(sample, number).alias("fishID"),
        F.when(rare, F.concat(F.lit("P"), part)).otherwise(F.concat(F.lit("S"), supplier)).alias("otu"),
        F.col("l_quantity").alias("fishLength"),
        F.col("l_extendedprice").alias("fishWeight"),
        F.when(k == 1, clip).alias("clipApply"),
        F.when(k == 6, clip).alias("clipRecapture"),
        F.when(k == 2, tag).alias("pitApply"),
        F.when(k == 3, tag).alias("pitRecapture"),
        F.when(k == 4, tag).alias("floyApply"),
        F.when(k == 5, tag).alias("floyRecapture"),
        month(F.col("l_shipdate")).alias("entry_file"),
    )


@query("q_record_rules", _RECORDS)
def record_rules(spark, sf_dir):
    """All rules that judge records against history."""
    batch, snapshot, season = _split_three(line_records(spark, sf_dir), "l_shipdate")
    folder = fresh_folder(spark)
    # As in an admission: many rules read the batch, two the statistics.
    batch = stage(batch, f"{folder}/batch")
    statistics = stage(fish.history_statistics(snapshot), f"{folder}/statistics")
    found = union_violations(
        spark,
        [
            fish.membership_rules(batch, snapshot, season),
            check_duplicate_keys(batch, "fishID", fish.RULES["dup_fishID"]),
            *fish.outlier_rules(batch, statistics),
            *fish.linkage_rules(batch, snapshot, season, fish.Options()),
        ],
    )
    return found.select("rule", "entity", "value", "entry_file")


_SAMPLES = f"""
with s as (select *, strftime(o_orderdate, '%Y-%m') as entry_file, o_orderstatus || '_' || o_custkey as site_id,
    o_orderstatus || '_' || o_custkey || '_2001' || strftime(o_orderdate, '%m%d') || '_0000_' || left(o_orderpriority, 1) as sample_id,
    try_strptime('2001' || strftime(o_orderdate, '%m%d'), '%Y%m%d') as key_day,
    case when o_custkey % 40 = 3 then 'u' || o_custkey else o_orderstatus end as cpue,
    case when o_custkey % 40 = 5 then null when o_custkey % 40 = 6 then 'r' || o_custkey else o_orderstatus end as mark,
    o_totalprice / 20000 as effort, case when left(o_orderpriority, 1) = '1' then o_totalprice / 18000 end as distance,
    case when o_orderdate >= timestamp '{ORDER_CUTOFF}' then 2 when o_orderdate >= timestamp '{SEASON_START}' then 1 else 0 end as source
  from orders),
n as (select * from s where source = 2), h as (select * from s where source < 2), db as (select * from s where source = 0)
select distinct 'new_siteID' as rule, null as entity, site_id as value, entry_file from n where site_id not in (select site_id from h)
union all select distinct 'new_metadataID', null, o_custkey::varchar, entry_file from n where o_custkey not in (select o_custkey from h)
union all select distinct 'new_projectID', null, (o_orderkey // 3)::varchar, entry_file from n
  where o_orderkey // 3 not in (select o_orderkey // 3 from h)
union all select distinct 'vocab_useCPUE', null, cpue, entry_file from n where cpue not in (select cpue from db)
union all select distinct 'vocab_useSampleMarkRecap', null, mark, entry_file from n
  where not exists (select 1 from db where db.mark is not distinct from n.mark)
union all select distinct 'retired_projectID', null, (o_orderkey // 3)::varchar, entry_file from n
  where o_orderkey // 3 in ({", ".join(map(str, fish.RETIRED_PROJECTS))})
union all select distinct 'repeat_sampleID', null, sample_id, entry_file from n where sample_id in (select sample_id from h)
union all select 'sample_dup_internal', sample_id, sample_id, entry_file
  from (select *, count(*) over (partition by sample_id) as c from n) where c > 1
union all select 'date_order', sample_id, strftime(o_orderdate, '%Y-%m-%d'), entry_file from n where o_orderstatus = 'P'
union all select 'time_order', sample_id, strftime(o_orderdate, '%Y-%m-%d %H:%M:%S'), entry_file from n where o_orderstatus = 'P'
union all select 'date_set_part', sample_id, strftime(o_orderdate + interval 1 day, '%Y-%m-%d'), entry_file from n where o_orderstatus = 'P'
union all select 'key_timestamp', sample_id, sample_id, entry_file from n where key_day <> o_orderdate
union all select 'range_dayOfYear', sample_id, dayofyear(o_orderdate)::varchar, entry_file from n
  where dayofyear(o_orderdate) <= 91 or dayofyear(o_orderdate) >= 305
union all select 'range_distanceShocked', sample_id, round(distance, 3)::varchar, entry_file from n where distance <= 0 or distance >= 25
union all select 'range_effort', sample_id, round(effort, 3)::varchar, entry_file from n where effort < 0 or effort >= 24
"""


def order_samples(spark, sf_dir):
    """Orders in the shape of samples.  Partial orders are set two days late, their set date a day late."""
    status, gear = F.col("o_orderstatus"), F.left("o_orderpriority", F.lit(1))
    at, customer, some = F.col("o_orderdate"), F.col("o_custkey").cast("string"), F.col("o_custkey") % 40
    set_at = F.when(status == "P", at + F.expr("interval 2 days")).otherwise(at)
    site = build_key(status, F.col("o_custkey"))
    day = F.concat(F.lit("2001"), F.substring(date_text(at), 5, 4))
    return table(spark, sf_dir, "orders").select(
        "o_orderdate",
        F.floor(F.col("o_orderkey") / 3).alias("projectID"),
        status.alias("lakeID"),
        site.alias("siteID"),
        build_key(site, day, F.lit("0000"), gear).alias("sampleID"),
        set_at.alias("dateTimeSet"),
        F.when(status == "P", F.date_add(at.cast("date"), 1)).otherwise(at.cast("date")).alias("dateSet"),
        at.alias("dateTimeSample"),
        at.cast("date").alias("dateSample"),
        day_of_year(at.cast("date")).alias("dayOfYear"),
        gear.alias("gear"),
        F.when(gear == "1", F.col("o_totalprice") / 18000).alias("distanceShocked"),
        (F.col("o_totalprice") / 20000).alias("effort"),
        gear.alias("effortUnits"),
        F.col("o_custkey").alias("metadataID"),
        F.when(some == 3, F.concat(F.lit("u"), customer)).otherwise(status).alias("useCPUE"),
        F.when(some == 6, F.concat(F.lit("r"), customer)).when(some != 5, status).alias("useSampleMarkRecap"),
        status.alias("sampleGroup"),
        month(at).alias("entry_file"),
    )


@query("q_sample_rules", _SAMPLES)
def sample_rules(spark, sf_dir):
    """All rules that judge samples."""
    batch, snapshot, season = _split_three(order_samples(spark, sf_dir), "o_orderdate")
    parts = fish.sample_rules(
        batch, snapshot.select("lakeID"), snapshot.select("siteID"), snapshot, season, fish.Options()
    )
    found = union_violations(spark, parts)
    # Measured values are computed numbers, whose last digits need not print alike.
    measured = F.round(F.col("value").try_cast("double"), 3).cast("string")
    value = F.when(F.col("rule").isin("range_distanceShocked", "range_effort"), measured).otherwise(F.col("value"))
    return found.select("rule", "entity", value.alias("value"), "entry_file")
