"""Records of several lines: line breaks inside quoted cells, and blank lines between records.

A quote that a line opens and does not close goes on until a later line closes it, so a line is inside a
cell if an odd number of the lines before it hold an odd number of quotes.  That number is a prefix sum:
added up by parts of a file of at most ``chunk_lines`` lines, carried from part to part, and counted
within each part.  So no task needs a whole file, wherever it is split.
"""

from __future__ import annotations

from pyspark.sql import Column, DataFrame, Window
from pyspark.sql import functions as F

from batchgate.functions.text import unbalanced_quotes
from batchgate.operators.joins import splittable_on
from batchgate.session import stage

#: A cell of more lines is taken for a stray quote: its lines stay apart, and parsing reports them.
CELL_LINES = 10_000
#: A record of a text: no line break outside quotes; a quote that nothing closes is text.
RECORD = r'((?:[^"\n]++|"[^"]*+"|")++)'


def records_of(text: Column) -> Column:
    """The records of a whole text, without blank lines."""
    one_break = F.regexp_replace(text, r"\r\n?", "\n")
    return F.regexp_extract_all(one_break, F.lit(RECORD), F.lit(1))


def _prefix(by_chunk: DataFrame, count: str, name: str) -> DataFrame:
    """The sum of ``count`` over earlier chunks of the file; one row for each chunk."""
    earlier = Window.partitionBy("entry_file").orderBy("chunk").rowsBetween(Window.unboundedPreceding, -1)
    return by_chunk.withColumn(name, F.coalesce(F.sum(count).over(earlier), F.lit(0)))


def _marked(lines: DataFrame) -> DataFrame:
    """Each line with ``start``, the number of the line that its record begins with."""
    lines = lines.withColumn("odd", unbalanced_quotes(F.col("line")))
    odd_no = F.when(F.col("odd"), F.col("line_no"))
    chunks = lines.groupBy("entry_file", "chunk").agg(F.count(odd_no).alias("n_odd"), F.max(odd_no).alias("last_odd"))
    earlier = Window.partitionBy("entry_file").orderBy("chunk").rowsBetween(Window.unboundedPreceding, -1)
    carried = _prefix(chunks, "n_odd", "odd_before").select(
        "entry_file",
        "chunk",
        "odd_before",
        F.max("last_odd").over(earlier).alias("opener_before"),
        F.sum("n_odd").over(Window.partitionBy("entry_file")).alias("odd_total"),
    )
    # The lines of one chunk.
    above = Window.partitionBy("entry_file", "chunk").orderBy("line_no").rowsBetween(Window.unboundedPreceding, -1)
    before = F.col("odd_before") + F.count(odd_no).over(above)
    # An odd total leaves the last quote without an end; it opens nothing.
    inside = (before % 2 == 1) & (before < F.col("odd_total") - F.col("odd_total") % 2)
    opener = F.coalesce(F.max(odd_no).over(above), "opener_before")
    joined = lines.join(carried, ["entry_file", "chunk"])
    return joined.select(
        "entry_file", "chunk", "line_no", "line", F.when(inside, opener).otherwise(F.col("line_no")).alias("start")
    )


def whole_records(lines: DataFrame, scratch: str, chunk_lines: int) -> tuple[DataFrame, DataFrame]:
    """``entry_file, line_no, line``: numbered records, blank ones left out; and ``entry_file, gone``.

    ``lines`` has consecutive lines of some files, blank ones too, with their numbers in the file: those
    before them are records, and none after them has a quote that the others need.  ``gone`` is the
    number of lines that are blank or part of another's record, by which later lines move up.
    """
    lines = lines.withColumn("chunk", F.floor(F.col("line_no") / chunk_lines))
    marked = stage(_marked(lines), f"{scratch}/marked")

    cells = marked.filter("start <> line_no").groupBy("entry_file", "start").agg(F.count(F.lit(1)).alias("more"))
    cells = cells.filter(F.col("more") < CELL_LINES).select(F.col("entry_file").alias("cell_file"), F.col("start").alias("cell"))
    on = splittable_on([marked["entry_file"], marked["start"]], [cells["cell_file"], cells["cell"]])
    told = marked.join(cells, on, "left").withColumn("held", F.col("cell").isNotNull())
    gone = (F.col("held") & (F.col("start") != F.col("line_no"))) | (~F.col("held") & (F.col("line") == ""))
    told = stage(told.select(*marked.columns, "held", gone.alias("gone")), f"{scratch}/told")

    gone_no = F.when(F.col("gone"), 1)
    counts = told.groupBy("entry_file", "chunk").agg(F.count(gone_no).alias("n_gone"))
    counts = _prefix(counts, "n_gone", "gone_before").drop("n_gone")
    above = Window.partitionBy("entry_file", "chunk").orderBy("line_no").rowsBetween(Window.unboundedPreceding, -1)
    record_no = F.col("line_no") - F.col("gone_before") - F.count(gone_no).over(above)
    records = told.join(counts, ["entry_file", "chunk"]).withColumn("record_no", record_no).filter("not gone")

    # At most CELL_LINES lines for each record.
    parts = F.transform(F.array_sort(F.collect_list(F.struct("line_no", "line"))), lambda x: x["line"])
    texts = told.filter("held").groupBy("entry_file", "start").agg(F.array_join(parts, "\n").alias("text"))
    texts = texts.select(F.col("entry_file").alias("text_file"), F.col("start").alias("text_no"), "text")
    on = splittable_on([records["entry_file"], records["line_no"]], [texts["text_file"], texts["text_no"]])
    whole = records.join(texts, on, "left").select(
        "entry_file", F.col("record_no").alias("line_no"), F.coalesce("text", "line").alias("line")
    )
    gone_lines = told.groupBy("entry_file").agg(F.count(gone_no).alias("gone"))
    return stage(whole, f"{scratch}/whole"), stage(gone_lines, f"{scratch}/gone")
