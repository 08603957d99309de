"""Mark and recapture on events: signups apply tags, purchases recapture them."""

from __future__ import annotations

from pyspark.sql import functions as F

from batchgate.catalog import query
from batchgate.catalog.sheetdata import fresh_folder
from batchgate.catalog.tables import EVENT_CUTOFF, TAGGED_SQL, event_applies, event_recaptures, table, tagged_events
from batchgate.operators import linkage as k
from batchgate.operators.formats import check_formats
from batchgate.operators.joins import splittable_on
from batchgate.sources import tagstore

_APPLIES = (
    "with "
    + TAGGED_SQL.strip()
    + f""",
applies as (select *, cast(ts as date) as apply_date, case when ts < timestamp '{EVENT_CUTOFF}' then 0 else 1 end as source
  from tagged where event_type = 'signup'),
ranked as (select *, row_number() over (partition by tag order by apply_date, source, fish_id) as rn,
             row_number() over (partition by tag order by apply_date desc, source desc, fish_id desc) as rev from applies),
registry as (select * from ranked where rn = 1), latest as (select * from ranked where rev = 1),
recaps as (select * from tagged where event_type = 'purchase'),
linked as (select r.fish_id, r.tag, r.tag_type, r.species, r.lake, g.tag_type as apply_type, g.species as apply_species,
             g.lake as apply_lake, g.fish_id as apply_id,
             case when g.tag is null then 'never applied'
                  when r.species = g.species and r.lake = g.lake then 'none'
                  when r.species <> g.species and r.lake <> g.lake then 'wrong species, wrong lake'
                  when r.lake = g.lake then 'right lake, wrong species'
                  else 'right species, wrong lake' end as problem
           from recaps r left join registry g on g.tag = r.tag)
"""
)


def _linked(spark, sf):
    recaptures = event_recaptures(spark, sf)
    return k.link_recaptures(recaptures, k.only_asked(k.tag_registry(event_applies(spark, sf)), recaptures))


@query(
    "q_tag_registry",
    _APPLIES
    + """select tag, strftime(apply_date, '%Y-%m-%d') as apply_date, source, fish_id as apply_id, tag_type as apply_type,
       species as apply_species, lake as apply_lake from registry""",
)
def tag_registry(spark, sf):
    out = k.tag_registry(event_applies(spark, sf))
    return out.withColumn("apply_date", F.col("apply_date").cast("string"))


@query(
    "q_latest_apply",
    _APPLIES
    + """select tag, strftime(apply_date, '%Y-%m-%d') as apply_date, source, fish_id as apply_id, value as apply_length,
       species as apply_species from latest""",
)
def latest_apply(spark, sf):
    out = k.latest_apply(event_applies(spark, sf))
    return out.withColumn("apply_date", F.col("apply_date").cast("string"))


@query(
    "q_recaptures_long",
    """select l_orderkey, l_linenumber, 'flag' as kind, l_returnflag as tag from lineitem where l_returnflag <> 'N'
union all
select l_orderkey, l_linenumber, 'status', l_linestatus from lineitem where l_linestatus <> 'O'""",
)
def recaptures_long(spark, sf):
    lines = table(spark, sf, "lineitem").select(
        "l_orderkey",
        "l_linenumber",
        F.nullif("l_returnflag", F.lit("N")).alias("flag"),
        F.nullif("l_linestatus", F.lit("O")).alias("status"),
    )
    keep = {"l_orderkey": F.col("l_orderkey"), "l_linenumber": F.col("l_linenumber")}
    return k.tags_long(lines, keep, {"flag": "flag", "status": "status"}, "kind", "tag")


@query(
    "q_tag_type_mismatch",
    _APPLIES + "select fish_id as recap_id, tag as recap_tag, tag_type as recap_type, apply_type from linked where tag_type <> apply_type",
)
def tag_type_mismatch(spark, sf):
    return _linked(spark, sf).filter("type_differs").select("recap_id", "recap_tag", "recap_type", "apply_type")


@query("q_tag_classes", _APPLIES + "select fish_id as recap_id, tag as recap_tag, problem from linked")
def tag_classes(spark, sf):
    return _linked(spark, sf).select("recap_id", "recap_tag", "problem")


@query(
    "q_tag_explain",
    _APPLIES
    + """, rules as (select * from (values ('never applied', 'tag_never_applied', 'tagRecap'),
    ('right lake, wrong species', 'tag_wrong_species', 'tagRecapSpecies'),
    ('right species, wrong lake', 'tag_wrong_lake', 'tagRecapLake'),
    ('wrong species, wrong lake', 'tag_wrong_both', 'tagRecapSpecies+tagRecapLake')) as x(problem, rule, force_keys))
select fish_id as entity, tag as value, rule, force_keys, apply_species as apply_otu, apply_lake, apply_id
from linked join rules using (problem)
union all
select fish_id, tag, 'tag_type', 'tagRecapType', apply_species, apply_lake, apply_id from linked where tag_type <> apply_type""",
)
def tag_explain(spark, sf):
    detail = F.col("detail")
    return k.check_tag_recapture(_linked(spark, sf)).select(
        "entity",
        "value",
        "rule",
        F.array_join("force_keys", "+").alias("force_keys"),
        detail["applyOTU"].alias("apply_otu"),
        detail["applyLake"].alias("apply_lake"),
        detail["applyID"].alias("apply_id"),
    )


_GROWTH = (
    _APPLIES
    + """, grown as (
  select r.fish_id as recap_id, r.tag as recap_tag, r.value as recap_length, a.value as apply_length, r.entry_file,
         p.linf * (1 - exp(-p.k * (case when a.value < p.linf then ln(1 - a.value / p.linf) end / (-p.k) + p.t0
            + (cast(r.ts as date) - a.apply_date) / 365.0 - p.t0))) as expected
  from recaps r join latest a on a.tag = r.tag
  join (values ('L0', 376.909, 0.32, -0.599), ('L1', 550.0, 0.19, -0.024), ('L2', 550.0, 0.19, -0.024)) as p(lake, linf, k, t0)
    on p.lake = r.lake)
"""
)


def _parameters():
    first = F.col("recap_lake") == "L0"
    return [F.when(first, a).otherwise(b) for a, b in ((376.909, 550.0), (0.32, 0.19), (-0.599, -0.024))]


def _grown(spark, sf):
    recaptures = event_recaptures(spark, sf)
    latest = k.only_asked(k.latest_apply(event_applies(spark, sf)), recaptures)
    return k.growth_expectation(recaptures, latest, *_parameters())


@query("q_growth_expected", _GROWTH + "select recap_id, recap_tag, round(expected, 4) as expected from grown")
def growth_expected(spark, sf):
    return _grown(spark, sf).select("recap_id", "recap_tag", F.round("expected", 4).alias("expected"))


@query(
    "q_growth_check",
    _GROWTH + "select recap_id as entity, recap_length as value from grown where abs(expected - recap_length) > 0.1 * recap_length",
)
def growth_check(spark, sf):
    return k.check_growth(_grown(spark, sf)).select("entity", F.col("value").cast("double").alias("value"))


_ASOF = (
    _APPLIES
    + """, paired as (select r.fish_id as recap_id, r.tag as recap_tag, r.species, r.lake, r.tag_type, r.ts, r.value as recap_length,
    a.fish_id as apply_id, a.apply_date, a.source, a.species as apply_species, a.lake as apply_lake, a.value as apply_length,
    a.tag_type as apply_type, exists (select 1 from applies x where x.tag = r.tag) as applied
  from recaps r left join applies a on a.tag = r.tag and a.apply_date <= cast(r.ts as date)
  qualify row_number() over (partition by r.fish_id order by a.apply_date desc nulls last, a.source desc, a.fish_id desc) = 1)
"""
)


@query(
    "q_tag_asof",
    _ASOF
    + """select recap_id, recap_tag, apply_id, strftime(apply_date, '%Y-%m-%d') as apply_date,
  case when apply_id is null and applied then 'applied later' when apply_id is null then 'never applied'
       when species = apply_species and lake = apply_lake then 'none'
       when species <> apply_species and lake <> apply_lake then 'wrong species, wrong lake'
       when lake = apply_lake then 'right lake, wrong species' else 'right species, wrong lake' end as problem,
  coalesce(tag_type <> apply_type, false) as type_differs from paired""",
)
def tag_asof(spark, sf):
    linked = k.link_recaptures_asof(event_recaptures(spark, sf), event_applies(spark, sf))
    return linked.select(
        "recap_id", "recap_tag", "apply_id", F.col("apply_date").cast("string").alias("apply_date"), "problem", "type_differs"
    )


@query(
    "q_growth_asof",
    _ASOF
    + """select recap_id, recap_tag, apply_id, round(p.linf * (1 - exp(-p.k * (case when apply_length < p.linf
    then ln(1 - apply_length / p.linf) end / (-p.k) + p.t0 + (cast(ts as date) - apply_date) / 365.0 - p.t0))), 4) as expected
from paired join (values ('L0', 376.909, 0.32, -0.599), ('L1', 550.0, 0.19, -0.024), ('L2', 550.0, 0.19, -0.024)) as p(lake, linf, k, t0)
  on p.lake = paired.lake where apply_id is not null""",
)
def growth_asof(spark, sf):
    grown = k.growth_expectation_asof(event_recaptures(spark, sf), event_applies(spark, sf), *_parameters())
    return grown.select("recap_id", "recap_tag", "apply_id", F.round("expected", 4).alias("expected"))


#: Buckets of the query's stored state: at 100 million tags some 150 MB each.
TAG_BUCKETS = 64


@query(
    "q_tag_store",
    _APPLIES
    + """select l.fish_id as recap_id, l.tag as recap_tag, l.problem, l.apply_id, a.fish_id as latest_id, a.value as latest_length
from linked l left join latest a on a.tag = l.tag""",
)
def tag_store(spark, sf):
    """History's tags stored in buckets, the season's merged into them, and recaptures linked to what is stored."""
    folder = fresh_folder(spark)
    applies, recaptures = event_applies(spark, sf), event_recaptures(spark, sf)
    history = tagstore.save_tags(k.tag_state(applies.filter("source = 0")), f"{folder}/history", TAG_BUCKETS)
    merged = tagstore.merge_tags(history, k.tag_state(applies.filter("source = 1")), f"{folder}/merged")
    kept = merged.asked(recaptures)
    linked = k.link_recaptures(recaptures, k.first_applies(kept))
    latest = k.last_applies(kept).select(
        F.col("tag").alias("latest_tag"), F.col("apply_id").alias("latest_id"), F.col("apply_length").alias("latest_length")
    )
    linked = linked.join(latest, splittable_on([linked["recap_tag"]], [latest["latest_tag"]]), "left")
    return linked.select("recap_id", "recap_tag", "problem", "apply_id", "latest_id", "latest_length")


_FORMAT = r"^[0-9]{2}-[0-4]$"


@query(
    "q_format_check",
    "with "
    + TAGGED_SQL.strip()
    + f"""
select fish_id as entity, case when event_type = 'signup' then 'apply' else 'recapture' end as column_name, tag as value
from tagged where event_type in ('signup', 'purchase') and tag_type = 'pit' and not regexp_matches(tag, '{_FORMAT}')""",
)
def format_check(spark, sf):
    out = check_formats(
        tagged_events(spark, sf), {"pitApply": "apply", "pitRecapture": "recapture"}, _FORMAT, "fishID"
    )
    return out.select("entity", F.col("column").alias("column_name"), "value")
