"""A sheet per order, written from the order (header) and its line items (data lines).

Urgent orders become trap sheets.  Damage follows from the data: partial orders lack a tag column,
expensive ones carry a trap column, low-priority ones lack a sample group, and so on.
"""

from __future__ import annotations

import tempfile
import uuid

import pyarrow as pa
import pyarrow.compute as pc
from pyarrow import fs
from pyspark.sql import Column, DataFrame, SparkSession
from pyspark.sql import functions as F

from batchgate.catalog.tables import table
from batchgate.operators.parse import HEADER_KEYS

# The same facts in SQL, for the oracle.
SHEET_SQL = """
s as (select *, o_orderpriority = '1-URGENT' as is_trap,
  case when o_orderpriority = '1-URGENT' then 'minnowtrap' else 'sheet' end || o_orderkey || '_'
    || strftime(o_orderdate, '%Y-%m-%d') || '_0000.csv' as entry_file,
  o_orderpriority <> '1-URGENT' and o_totalprice > 450000 as has_trap_column,
  replace(o_orderpriority, ' ', '') as metadata,
  case o_orderstatus when 'F' then 'FN' when 'O' then 'BE' else 'AN' end as gear
  from orders),
d as (select s.*, l.*, l_discount = 0 as no_length, l_tax = 0 as no_code,
  case when is_trap then 'MT.' || lpad(l_linenumber::varchar, 3, '0') else o_orderpriority end as site
  from lineitem l join s on o_orderkey = l_orderkey)
"""


def sheet_orders(spark: SparkSession, sf_dir: str) -> DataFrame:
    o = table(spark, sf_dir, "orders")
    trap = F.col("o_orderpriority") == "1-URGENT"
    day = F.substring(F.col("o_orderdate").cast("string"), 1, 10)
    return o.select(
        "*",
        trap.alias("is_trap"),
        day.alias("day"),
        F.concat(
            F.when(trap, "minnowtrap").otherwise("sheet"), F.col("o_orderkey").cast("string"), F.lit("_"), day, F.lit("_0000.csv")
        ).alias("entry_file"),
        (~trap & (F.col("o_totalprice") > 450000)).alias("has_trap_column"),
    )


def _header_lines() -> list[Column]:
    status, priority = F.col("o_orderstatus"), F.col("o_orderpriority")
    at = F.concat("day", F.lit(" 00:00:00"))
    text = {
        "projectID": F.col("o_custkey").cast("string"),
        "lakeID": status,
        "siteName": priority,
        "dataTimeSet": F.when(status == "P", F.lit("yesterday")).otherwise(at),
        "dateTimeSample": at,
        "crew": F.when(status == "F", F.lit('"chris,stuart"')).otherwise(F.lit("chris")),
        "gear": F.when(status == "F", F.lit("FN3")).when(status == "O", F.lit("B E")).otherwise(F.lit("AN")),
        "distanceShocked": F.lit("12.5"),
        "effort": F.col("o_totalprice").cast("string"),
        "effortUnits": F.when(status == "F", F.lit("angler_hours")).otherwise(F.lit("trap_hours")),
        "comments": F.concat(F.lit('"said ""'), priority, F.lit('"", then left"')),
        "UseCPUE": F.lit(" yes"),
        "dataRecorder": F.when(status == "P", F.lit("NA")).otherwise(F.lit("c")),
        "dataEnteredBy": F.lit("e"),
        "metadata ID": priority,
        "useSampleMarkRecap": F.lit("no"),
        "sampleGroup": F.when(priority == "5-LOW", F.lit(" ")).otherwise(status),
    }
    lines = []
    for n, (key, value) in enumerate(text.items(), start=1):
        shown = F.when(F.col("o_totalprice") < 10000, "").otherwise(key) if key == "comments" else F.lit(key)
        # Trap sheets have no site line, so later lines move up by one.
        no = F.when(F.col("is_trap") & (n > 3), n - 1).otherwise(n).cast("bigint")
        line = F.struct(no.alias("line_no"), F.concat(shown, F.lit(","), value).alias("line"))
        lines.append(F.when(~F.col("is_trap"), line) if key == "siteName" else line)
    return lines


def _name_line() -> Column:
    partial = F.col("o_orderstatus") == "P"
    tags = F.when(partial, "pitApply,pitRecapture,floyRecapture").otherwise(
        "pitApply,pitRecapture,floyApply,floyRecapture"
    )
    regular = F.concat(
        F.lit("fishNum,species,fishLength,fishWeight,"),
        tags,
        F.lit(",otolithSample"),
        F.when(F.col("has_trap_column"), ",trapNumber").otherwise(""),
        F.lit(","),
    )
    trap = F.lit("trapNumber,fishNum,species,fishLength,fishWeight,spineSampled")
    return F.struct(
        F.when(F.col("is_trap"), 17).otherwise(18).cast("bigint").alias("line_no"),
        F.when(F.col("is_trap"), trap).otherwise(regular).alias("line"),
    )


def data_lines(orders: DataFrame, lineitem: DataFrame) -> DataFrame:
    number = F.col("l_linenumber").cast("string")
    length = F.when(F.col("l_discount") == 0, "").otherwise(F.col("l_quantity").cast("string"))
    code = F.when(F.col("l_tax") == 0, "NA").otherwise(F.col("l_returnflag"))
    weight = F.col("l_extendedprice").cast("string")
    flag = F.when(F.col("l_returnflag") == "R", "1").otherwise("")
    tag = F.concat(F.lit("T"), F.col("l_suppkey").cast("string"))
    tags = F.when(F.col("o_orderstatus") == "P", F.concat(tag, F.lit(",,"))).otherwise(F.concat(tag, F.lit(",,,")))
    extra = F.when(F.col("l_tax") == 0.08, "left over").otherwise("")
    regular = F.concat_ws(
        ",", number, code, length, weight, tags, flag, F.when(F.col("has_trap_column"), F.lit("MT001")), extra
    )
    trap = F.concat_ws(",", F.concat(F.lit("MT"), F.lpad(number, 3, "0")), number, code, length, weight, flag)
    joined = lineitem.join(orders, lineitem["l_orderkey"] == orders["o_orderkey"])
    return joined.select(
        "entry_file",
        (F.when(F.col("is_trap"), 17).otherwise(18) + F.col("l_linenumber")).cast("bigint").alias("line_no"),
        F.when(F.col("is_trap"), trap).otherwise(regular).alias("line"),
    )


#: Orders whose header lines one task writes out, groups and parses: some 100 MB.
TASK_ORDERS = 50_000


def top_lines(spark: SparkSession, sf_dir: str) -> DataFrame:
    """Header and name lines only: all that a sheet's own row is made of.

    Orders are spread by file before they are written out as lines, so parsing need not shuffle those.
    Lines are far larger than their orders, so the orders of a task are counted and not left to adaptive
    execution, which would join partitions by the size of orders.
    """
    lines = F.array(*_header_lines(), _name_line())
    orders = sheet_orders(spark, sf_dir)
    tasks = max(spark.sparkContext.defaultParallelism, -(-orders.count() // TASK_ORDERS))
    orders = orders.repartition(tasks, "entry_file").sortWithinPartitions("entry_file")
    return orders.select("entry_file", F.explode(lines).alias("x")).filter("x is not null").select("entry_file", "x.*")


def sheet_lines(spark: SparkSession, sf_dir: str) -> DataFrame:
    """Every line of every sheet."""
    return top_lines(spark, sf_dir).unionByName(
        data_lines(sheet_orders(spark, sf_dir), table(spark, sf_dir, "lineitem"))
    )


def fresh_folder(spark: SparkSession) -> str:
    """A new folder that all executors share; only a local session may make one of its own."""
    named = spark.conf.get("spark.checkpoint.dir", None)
    if named:
        return f"{named.rstrip('/')}/sheets-{uuid.uuid4().hex}"
    if not spark.sparkContext.master.startswith("local"):
        raise ValueError("set spark.checkpoint.dir to a folder that all executors share")
    return tempfile.mkdtemp(prefix="batchgate-sheets-")


#: Orders, by their keys, whose lines one sheet file may hold: a file is written by one task.
FILLED_ORDERS, MONTH_ORDERS = 50_000, 1_000_000
FILE_SQL = f"""case when o_orderstatus = 'F' then 'filled' || (o_orderkey // {FILLED_ORDERS}) || '_1990-01-01_0000.csv'
    else 'm' || (o_orderkey // {MONTH_ORDERS}) || '_' || strftime(o_orderdate, '%Y-%m') || '-01_0000.csv' end"""


def sheet_files(spark: SparkSession, sf_dir: str, folder: str) -> DataFrame:
    """Write sheet files of filled orders, which have half of all lines, and of each month; ``entry_file, lines``.

    These sheets have 18 lines of keys, and some comments of two or three lines.  A file is written by
    one task, line by line, and holds a bounded number of orders.
    """
    keys = ["season", *HEADER_KEYS]
    head = "".join(f"{k},{k[:3]}\r\n" for k in keys) + "fishNum,species,fishLength,fishWeight,comments\r\n"
    o, l = table(spark, sf_dir, "orders"), table(spark, sf_dir, "lineitem")
    key, month = F.col("o_orderkey"), F.substring(F.col("o_orderdate").cast("string"), 1, 7)
    filled = F.concat(F.lit("filled"), F.expr(f"o_orderkey div {FILLED_ORDERS}"), F.lit("_1990-01-01_0000.csv"))
    other = F.concat(F.lit("m"), F.expr(f"o_orderkey div {MONTH_ORDERS}"), F.lit("_"), month, F.lit("-01_0000.csv"))
    cells = [F.col(c).cast("string") for c in ("l_linenumber", "l_returnflag", "l_quantity", "l_extendedprice")]
    comment = F.when(
        F.col("l_tax") == 0.04, F.concat(F.lit('"kept by\r\n'), F.col("l_suppkey").cast("string"), F.lit(', ""late"""'))
    ).when(F.col("l_tax") == 0.02, F.lit('"first\r\n\r\nthird"'))
    line = F.concat(F.concat_ws(",", *cells, F.coalesce(comment, F.lit(""))), F.lit("\r\n"))
    rows = o.join(l, key == F.col("l_orderkey")).select(
        F.when(F.col("o_orderstatus") == "F", filled).otherwise(other).alias("entry_file"), line.alias("line")
    )
    return _written(rows.withColumn("no", F.lit(0)), F.lit(head), folder)


def _written(rows: DataFrame, head: Column, folder: str) -> DataFrame:
    """Write ``entry_file, no, line`` to files, each begun by its head; ``entry_file, lines`` of each.

    The head is of columns of the rows.  It is made after they are sorted, and read once for each file.
    """

    def write(batches):
        files, root = fs.FileSystem.from_uri(folder)
        files.create_dir(root, recursive=True)
        name, out, n, done = None, None, 0, []

        def close():
            if out is not None:
                out.close()
                files.move(f"{root}/.{name}.part", f"{root}/{name}")
                done.append((name, n))

        for batch in batches:
            names, heads, lines = batch.columns
            runs, begin = pc.run_end_encode(names), 0
            ends = runs.run_ends.to_pylist()
            texts = pc.binary_join(pa.ListArray.from_arrays(pa.array([0, *ends], pa.int32()), lines), "")
            for file, end, text in zip(runs.values.to_pylist(), ends, texts, strict=True):
                if file != name:
                    close()
                    name, n = file, 0
                    out = files.open_output_stream(f"{root}/.{name}.part")
                    out.write(heads[begin].as_py().encode())
                out.write(text.as_buffer())
                n, begin = n + end - begin, end
        close()
        yield pa.RecordBatch.from_pydict(
            {"entry_file": pa.array([d[0] for d in done], pa.string()), "lines": pa.array([d[1] for d in done], pa.int64())}
        )

    by_file = rows.repartition("entry_file").sortWithinPartitions("entry_file", "no")
    return by_file.select("entry_file", head.alias("head"), "line").mapInArrow(write, "entry_file string, lines long")


SEASON_SQL = f"""
d as (select 's' || (o_orderkey // {FILLED_ORDERS}) || '_' || strftime(o_orderdate, '%Y-%m') || '-01_0000.csv' as entry_file,
  strftime(o_orderdate, '%m') = '03' as refused, l_linenumber, sum(l_quantity) as length, max(l_returnflag) as flag
  from orders join lineitem l on o_orderkey = l_orderkey group by o_orderkey, o_orderdate, l_linenumber)
"""


def season_files(spark: SparkSession, sf_dir: str, folder: str) -> DataFrame:
    """Write a sheet in the layout of the fish preset for each month of orders; fish of March lack some numbers.

    A fish is a line number of an order, which some orders have more than once.
    """
    o, l = table(spark, sf_dir, "orders"), table(spark, sf_dir, "lineitem")
    # Whether the greatest flag is R, by numbers: the greatest of texts would be found by sorting all rows.
    flag = F.when(F.col("l_returnflag") > "R", 2).when(F.col("l_returnflag") == "R", 1)
    l = l.groupBy("l_orderkey", "l_linenumber").agg(F.sum("l_quantity").alias("length"), F.max(flag).alias("flag"))
    o = o.select(
        "o_orderkey",
        F.expr(f"o_orderkey div {FILLED_ORDERS}").cast("string").alias("block"),
        F.substring(F.col("o_orderdate").cast("string"), 1, 7).alias("day"),
    )
    block, day = F.col("block"), F.col("day")
    year, month = F.substring(day, 1, 4).cast("int"), F.substring(day, 6, 2)
    clock = F.concat(F.lit("2021-06-03 "), F.lpad((year - 1990).cast("string"), 2, "0"), F.lit(":"), month, F.lit(":00"))
    header = {
        "projectID": F.lit("37"),
        "lakeID": F.lit("WL"),
        "siteName": F.lit("DeepHole"),
        "dateTimeSet": clock,
        "dateTimeSample": clock,
        "crew": F.lit("a"),
        "gear": F.lit("AN"),
        "effort": F.lit("1.5"),
        "effortUnits": F.lit("angler_hours"),
        "comments": F.lit('"line\r\nand line"'),
        "useCPUE": F.lit("yes"),
        "dataRecorder": F.lit("r"),
        "dataEnteredBy": F.lit("e"),
        "metadataID": F.concat(F.lit("m"), block),
        "useSampleMarkRecap": F.lit("no"),
        "sampleGroup": F.lit("g"),
    }
    head = [F.concat(F.lit(f"{k},"), header.get(k, F.lit("")), F.lit("\r\n")) for k in HEADER_KEYS]
    names = "fishNum,species,fishLength,fishWeight,pitApply,pitRecapture,floyApply,floyRecapture,otolithSample\r\n"
    no = F.col("l_orderkey") * 10 + F.col("l_linenumber")
    number = F.when((month == "03") & (F.col("l_linenumber") == 1), "").otherwise(no.cast("string"))
    taken = F.when(F.col("flag") == 1, "1").otherwise("")
    cells = [number, F.lit("LMB"), F.col("length").cast("string"), F.lit(",,,,"), taken]
    rows = o.join(l, F.col("o_orderkey") == F.col("l_orderkey")).select(
        F.concat(F.lit("s"), block, F.lit("_"), day, F.lit("-01_0000.csv")).alias("entry_file"),
        no.alias("no"),
        "block",
        "day",
        F.concat(F.concat_ws(",", *cells), F.lit("\r\n")).alias("line"),
    )
    return _written(rows, F.concat(*head, F.lit(names)), folder)
