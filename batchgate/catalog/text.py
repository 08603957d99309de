"""Text cleaning, typing, vocabularies, codes, profiles, file names."""

from __future__ import annotations

from pyspark.sql import functions as F

from batchgate.catalog import query
from batchgate.catalog.tables import ORDER_CUTOFF, orders, table
from batchgate.functions import dates, text
from batchgate.functions.types import coerce_known_types, normalise_nulls, stringify
from batchgate.operators import derive
from batchgate.operators.formats import check_conditional_pattern, format_profile
from batchgate.operators.sheet_rules import bad_format
from batchgate.sources import reference, sheets

_PARTS = """with p as (select p_partkey, p_size, p_type, p_name,
  replace(p_name, ' ', ',') as crew, ' ' || p_name || '  ' as padded from part)
"""


def _parts(spark, sf):
    return table(spark, sf, "part").select(
        "p_partkey",
        "p_size",
        "p_type",
        "p_name",
        "p_retailprice",
        F.replace("p_name", F.lit(" "), F.lit(",")).alias("crew"),
        F.concat(F.lit(" "), "p_name", F.lit("  ")).alias("padded"),
    )


@query(
    "q_clean_strings",
    _PARTS
    + """select p_partkey, regexp_replace(regexp_replace(crew || ', x', ',', ', ', 'g'), '\\s\\s', ' ', 'g') as crew,
       regexp_replace(padded, '\\s', '', 'g') as stripped, regexp_replace(regexp_replace(padded, '\\s$', ''), '^\\s', '') as trimmed
from p""",
)
def clean_strings(spark, sf):
    return _parts(spark, sf).select(
        "p_partkey",
        text.clean_list_text(F.concat("crew", F.lit(", x"))).alias("crew"),
        text.strip_whitespace(F.col("padded")).alias("stripped"),
        text.trim_one(F.col("padded")).alias("trimmed"),
    )


@query(
    "q_list_length",
    _PARTS + "select p_partkey, case when p_size > 10 then cast(len(string_split(replace(crew, ',', ', '), ', ')) as varchar) end as n_items from p",
)
def list_length(spark, sf):
    items = text.list_length(text.clean_list_text(F.col("crew")))
    return _parts(spark, sf).select(
        "p_partkey", text.null_unless(items, F.col("p_size") > 10).cast("string").alias("n_items")
    )


@query("q_conditional_null", "select p_partkey, case when p_type = 'ECONOMY' then p_retailprice end as kept from part")
def conditional_null(spark, sf):
    kept = text.null_unless(F.col("p_retailprice"), F.col("p_type") == "ECONOMY")
    return _parts(spark, sf).select("p_partkey", kept.alias("kept"))


@query(
    "q_synonym_map",
    """select p_partkey, case when p_type in ('ECONOMY', 'STANDARD') then 'Basic' when p_type in ('PROMO', 'LARGE') then 'Extra'
       else p_type end as kind, case when regexp_matches(p_brand, 'Brand#1[0-9]+') then 'Brand#1x' else p_brand end as brand
from part""",
)
def synonym_map(spark, sf):
    spellings = {"Basic": ("ECONOMY", "STANDARD"), "Extra": ("PROMO", "LARGE")}
    return table(spark, sf, "part").select(
        "p_partkey",
        text.map_synonyms(F.col("p_type"), spellings).alias("kind"),
        text.collapse_code(F.col("p_brand"), "Brand#1[0-9]+", "Brand#1x").alias("brand"),
    )


@query(
    "q_conditional_pattern",
    """select cast(p_partkey as varchar) as entity, p_name as value from part
where p_type = 'ECONOMY' and not regexp_matches(p_name, '^[a-m]+ [a-z]+$')""",
)
def conditional_pattern(spark, sf):
    p = table(spark, sf, "part").withColumn("entry_file", F.col("p_brand"))
    out = check_conditional_pattern(
        p, F.col("p_type") == "ECONOMY", "p_name", "^[a-m]+ [a-z]+$", entity="p_partkey"
    )
    return out.select("entity", "value")


@query(
    "q_normalise_codes",
    """select p_partkey, 'MT.' || case when length(p_size::varchar) >= 3 then p_size::varchar else lpad(p_size::varchar, 3, '0') end as trap
from part""",
)
def normalise_codes(spark, sf):
    """The same trap written in three ways, by part type."""
    number = F.col("p_size").cast("string")
    padded = text.pad_left(number, 3)
    raw = (
        F.when(F.col("p_type") < "H", F.concat(F.lit("MT"), padded))
        .when(F.col("p_type") < "Q", F.concat(F.lit("MT."), padded))
        .otherwise(number)
    )
    return table(spark, sf, "part").select("p_partkey", text.normalise_code(raw).alias("trap"))


@query(
    "q_drop_sentinel",
    "select l_orderkey, l_linenumber, nullif(l_returnflag, 'A') as code from lineitem where l_returnflag <> 'N'",
)
def drop_sentinel(spark, sf):
    lines = table(spark, sf, "lineitem").select(
        "l_orderkey", "l_linenumber", F.nullif("l_returnflag", F.lit("A")).alias("code")
    )
    return text.drop_sentinel(lines, "code", "N")


@query(
    "q_format_profile",
    """select regexp_replace(regexp_replace(regexp_replace(c_name || c_mktsegment, '[0-9]', '0', 'g'), '[A-Z]', 'A', 'g'), '[a-z]', 'a', 'g')
  as format, count(*) as n from customer group by 1""",
)
def format_profile_query(spark, sf):
    c = table(spark, sf, "customer").select(F.concat("c_name", "c_mktsegment").alias("label"))
    return format_profile(c, "label")


_MIXED = """with m as (select o_orderkey, strftime(o_orderdate, '%Y-%m-%d') as d, strftime(o_orderdate, '%Y-%m-%d %H:%M:%S') as t,
  case o_orderstatus when 'P' then 'NA' when 'F' then '' else o_orderpriority end as note, o_orderstatus, o_totalprice, o_orderpriority
  from orders)
"""


def _mixed(spark, sf):
    """Orders written as text, with damage that depends on status and priority."""
    at, status = F.col("o_orderdate").cast("string"), F.col("o_orderstatus")
    return table(spark, sf, "orders").select(
        "o_orderkey",
        "o_orderstatus",
        "o_orderpriority",
        F.substring(at, 1, 10).alias("dateSample"),
        F.substring(at, 1, 19).alias("dateTimeSample"),
        F.when(status == "P", "NA").when(status == "F", "").otherwise(F.col("o_orderpriority")).alias("note"),
        "o_totalprice",
    )


@query(
    "q_coerce_types",
    _MIXED
    + """select o_orderkey, case when o_orderstatus <> 'P' then d end as "dateSample", case when o_orderstatus <> 'F' then t end as "dateTimeSample",
  case when o_orderstatus = 'O' then o_totalprice end as "fishWeight",
  cast(left(o_orderpriority, 1) as integer) as flag, note as replicate
from m""",
)
def coerce_types(spark, sf):
    status = F.col("o_orderstatus")
    mixed = _mixed(spark, sf).select(
        "o_orderkey",
        F.when(status == "P", "someday").otherwise(F.col("dateSample")).alias("dateSample"),
        F.when(status == "F", F.concat("dateSample", F.lit(" 25:61:00")))
        .otherwise(F.col("dateTimeSample"))
        .alias("dateTimeSample"),
        F.when(status == "O", F.col("o_totalprice").cast("string"))
        .when(status == "F", "heavy")
        .otherwise("12d")
        .alias("fishWeight"),
        F.left("o_orderpriority", F.lit(1)).alias("flag"),
        F.col("note").alias("replicate"),
    )
    typed = coerce_known_types(mixed)
    return typed.withColumns({c: F.col(c).cast("string") for c in ("dateSample", "dateTimeSample")})


@query(
    "q_null_normalise",
    _MIXED + "select o_orderkey, nullif(nullif(note, ''), 'NA') as note, o_orderstatus from m",
)
def null_normalise(spark, sf):
    return normalise_nulls(_mixed(spark, sf).select("o_orderkey", "note", "o_orderstatus"))


@query(
    "q_stringify",
    """select cast(l_orderkey as varchar) as l_orderkey, cast(l_linenumber as varchar) as l_linenumber,
  cast(cast(l_quantity as bigint) as varchar) as l_quantity,
  case when l_discount = 0 then '0' else cast(l_discount as varchar) end as l_discount from lineitem""",
)
def stringify_query(spark, sf):
    return stringify(table(spark, sf, "lineitem").select("l_orderkey", "l_linenumber", "l_quantity", "l_discount"))


@query(
    "q_format_gate",
    _MIXED
    + """select o_orderkey, o_orderstatus = 'P' as bad_time, o_orderstatus in ('P', 'F') as bad_date from m""",
)
def format_gate(spark, sf):
    """Partial orders carry day-first times, and finished ones dates without dashes."""
    status = F.col("o_orderstatus")
    at = F.when(
        status == "P", F.concat(F.substring("dateTimeSample", 9, 2), F.lit("/"), F.substring("dateTimeSample", 1, 4))
    ).otherwise(F.col("dateTimeSample"))
    day = F.when(status != "O", F.replace("dateSample", F.lit("-"), F.lit(""))).otherwise(F.col("dateSample"))
    return _mixed(spark, sf).select(
        "o_orderkey",
        dates.bad_timestamp_text(at).alias("bad_time"),
        bad_format(day, dates.DATE_PATTERN).alias("bad_date"),
    )


@query("q_date_parts", _MIXED + "select o_orderkey, t as at, d as day from m")
def date_parts(spark, sf):
    at = dates.parse_timestamp(F.col("dateTimeSample"))
    return _mixed(spark, sf).select(
        "o_orderkey", at.cast("string").alias("at"), at.cast("date").cast("string").alias("day")
    )


@query(
    "q_ref_filter",
    """select o_orderkey, o_orderstatus, o_orderpriority, o_totalprice from orders
where o_orderstatus in ('F', 'P') and o_orderpriority in ('1-URGENT', '5-LOW')""",
)
def ref_filter(spark, sf):
    source = table(spark, sf, "orders").select("o_orderkey", "o_orderstatus", "o_orderpriority", "o_totalprice")
    return reference.read_reference(source, o_orderstatus=["F", "P"], o_orderpriority=["1-URGENT", "5-LOW"])


@query(
    "q_profile_columns",
    " union all ".join(
        f"select '{c}' as column_name, '{t}' as type, cast({c} as varchar) as value, count(*) as n from part where {c} is not null group by 3"
        for c, t in (("p_brand", "string"), ("p_type", "string"), ("p_size", "int"))
    ),
)
def profile_columns(spark, sf):
    out = reference.profile_columns(table(spark, sf, "part"), ["p_brand", "p_type", "p_size"])
    return out.withColumnRenamed("column", "column_name")


_DIM = """dim as (select n_nationkey as code, min(n_name) as name from nation where n_regionkey < 4 group by 1)"""


def _nations(spark, sf):
    n = table(spark, sf, "nation")
    grouping = F.when(F.col("n_regionkey") < 4, "fish").otherwise("other")
    return derive.filter_dictionary(
        n.select(
            F.col("n_nationkey").cast("string").alias("abbreviation"), F.col("n_name").alias("otu"), grouping.alias("grouping")
        )
    )


@query(
    "q_map_codes",
    f"""with {_DIM} select c_custkey, coalesce(d.name, cast(c_nationkey as varchar)) as otu, d.name is not null as code_known
from customer c left join dim d on d.code = c.c_nationkey""",
)
def map_codes(spark, sf):
    c = table(spark, sf, "customer").select("c_custkey", F.col("c_nationkey").cast("string").alias("otu"))
    return derive.map_codes(c, _nations(spark, sf)).select("c_custkey", "otu", "code_known")


@query(
    "q_unknown_codes",
    f"""with {_DIM} select distinct cast(c_nationkey as varchar) as code, c_mktsegment as entry_file
from customer where c_nationkey not in (select code from dim)""",
)
def unknown_codes(spark, sf):
    c = table(spark, sf, "customer").withColumn("code", F.col("c_nationkey").cast("string"))
    return derive.unknown_codes(c, _nations(spark, sf), "code", "abbreviation", "c_mktsegment")


_NAMES = f"""with f as (select o_orderdate, case o_orderstatus
   when 'F' then 'lake' || o_orderkey || '_' || strftime(o_orderdate, '%Y-%m-%d') || '_1126.csv'
   when 'P' then 'minnowtrap' || o_orderkey || '.csv'
   else 'notes' || o_orderkey || '_' || strftime(o_orderdate, '%Y%m%d') || '.csv' end as entry_file from orders),
done as (select entry_file from f where o_orderdate < timestamp '{ORDER_CUTOFF}')
"""


def _file_names(spark, sf):
    """A file name per order, of three kinds; the files of earlier orders are ingested."""
    o = orders(spark, sf)
    key, day = F.col("o_orderkey").cast("string"), F.substring(F.col("o_orderdate").cast("string"), 1, 10)
    status = F.col("o_orderstatus")
    name = (
        F.when(status == "F", F.concat(F.lit("lake"), key, F.lit("_"), day, F.lit("_1126.csv")))
        .when(status == "P", F.concat(F.lit("minnowtrap"), key, F.lit(".csv")))
        .otherwise(F.concat(F.lit("notes"), key, F.lit("_"), F.replace(day, F.lit("-"), F.lit("")), F.lit(".csv")))
    )
    files = o.withColumn("entry_file", name)
    return files, files.filter(F.col("o_orderdate") < F.lit(ORDER_CUTOFF).cast("timestamp_ntz"))


_MATCH = "regexp_matches(entry_file, '[0-9]{4}-[0-9]{2}-[0-9]{2}_[0-9]{4}\\.csv|minnowtrap')"


@query(
    "q_discover",
    _NAMES
    + f"""select entry_file, contains(entry_file, 'minnowtrap') as is_trap,
  case when contains(entry_file, 'minnowtrap') then 17 else 18 end as name_line from f where {_MATCH}""",
)
def discover(spark, sf):
    return sheets.discover_sheets(_file_names(spark, sf)[0])


@query(
    "q_pending_files",
    _NAMES + f"select entry_file from f where {_MATCH} and entry_file not in (select entry_file from done)",
)
def pending(spark, sf):
    return sheets.pending_files(*_file_names(spark, sf)).select("entry_file")


@query(
    "q_unmatched_files",
    _NAMES + f"select entry_file from f where not {_MATCH} and entry_file not in (select entry_file from done)",
)
def unmatched(spark, sf):
    return sheets.unmatched_files(*_file_names(spark, sf))
