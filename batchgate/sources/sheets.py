"""Finding sheets and reading them as numbered lines.

A sheet is text: some key/value lines, one line of column names, then data lines.  Everything
downstream takes lines ``(entry_file, line_no, line)``, so files, streams and lines that Spark
derives from other tables share one code path.  A line that holds line breaks, all inside quoted
cells, is still one line there.  File names identify sheets.
"""

from __future__ import annotations

from dataclasses import dataclass

from pyspark.sql import Column, DataFrame, SparkSession, Window
from pyspark.sql import functions as F

from batchgate.functions.text import unbalanced_quotes
from batchgate.session import stage
from batchgate.sources.quoted import records_of, whole_records

# File names of sheets, and the mark of a trap sheet.
SHEET_PATTERN = r"[0-9]{4}-[0-9]{2}-[0-9]{2}_[0-9]{4}\.csv|minnowtrap"
TRAP_MARK = "minnowtrap"
HEADER_ROWS = 18
#: Lines of a sheet that are handled as one group.
CHUNK_LINES = 1 << 18

_BOM = "﻿"


def is_sheet(name: Column) -> Column:
    return name.rlike(SHEET_PATTERN)


def is_trap(name: Column) -> Column:
    return name.contains(TRAP_MARK)


def name_line(name: Column, header_rows: int = HEADER_ROWS) -> Column:
    """Number of the line that holds the column names; trap sheets have one header line less."""
    return F.when(is_trap(name), header_rows - 1).otherwise(header_rows)


def list_files(spark: SparkSession, path: str, modified_after: str | None = None) -> DataFrame:
    """Names of all (non-empty) files in a folder.  Only file metadata is read."""
    reader = spark.read.format("binaryFile")
    if modified_after is not None:
        reader = reader.option("modifiedAfter", modified_after)
    return reader.load(path).select(F.col("_metadata.file_name").alias("entry_file"))


def discover_sheets(files: DataFrame, column: str = "entry_file", header_rows: int = HEADER_ROWS) -> DataFrame:
    """Files whose name says they are sheets, with their kind."""
    name = F.col(column)
    return files.filter(is_sheet(name)).select(
        name.alias("entry_file"), is_trap(name).alias("is_trap"), name_line(name, header_rows).alias("name_line")
    )


def _not_ingested(files: DataFrame, ingested: DataFrame) -> DataFrame:
    done = ingested.select(F.col("entry_file").alias("done_file")).distinct()
    return files.join(done, files["entry_file"] == done["done_file"], "left_anti")


def pending_files(files: DataFrame, ingested: DataFrame, header_rows: int = HEADER_ROWS) -> DataFrame:
    """Sheets that the accumulator does not hold yet."""
    return _not_ingested(discover_sheets(files, header_rows=header_rows), ingested)


def unmatched_files(files: DataFrame, ingested: DataFrame) -> DataFrame:
    """Files that are neither ingested nor named like a sheet."""
    return _not_ingested(files.filter(~is_sheet(F.col("entry_file"))).select("entry_file"), ingested)


@dataclass(frozen=True)
class SheetLines:
    """Numbered lines of many sheets.

    ``lines`` has entry_file, line_no, line; blank lines are left out and not counted, and lines that a
    quoted cell joins are one.  Where ``chunks``
    is given, lines also have a ``chunk``, a part of the sheet of bounded size, and ``chunks``
    (entry_file, chunk) lists all but the first, 0: joins can then use the chunk as a second key, so a
    huge sheet is never one group.  ``repeated`` (entry_file, paths) has the names that several files
    bear; ``lines`` has those of the first of them by path.  ``others`` (entry_file) names files that
    were scanned and are no sheets.
    """

    lines: DataFrame
    chunks: DataFrame | None = None
    repeated: DataFrame | None = None
    others: DataFrame | None = None


def read_sheets(
    spark: SparkSession,
    path: str | list[str],
    scratch: str,
    modified_after: str | None = None,
    files: DataFrame | None = None,
) -> SheetLines:
    """The sheets under ``path``, or those modified after a time; only those are then listed and read.

    ``files`` (entry_file) names the sheets to take: lines of others are dropped before the others are
    staged under ``scratch``.
    """
    reader = spark.read
    if modified_after is not None:
        reader = reader.option("modifiedAfter", modified_after)
    scan = located(reader.text(path)).filter(is_sheet(F.col("entry_file")))
    return number_lines(scan, scratch, files)


def located(text: DataFrame) -> DataFrame:
    """A text scan, batch or stream, with the file and split each line comes from."""
    return text.select(
        "value",
        F.col("_metadata.file_name").alias("entry_file"),
        F.col("_metadata.file_path").alias("path"),
        F.col("_metadata.file_block_start").alias("split"),
    )


def number_lines(scan: DataFrame, scratch: str, files: DataFrame | None = None) -> SheetLines:
    """Number the records of a :func:`located` scan, which must not have shuffled them, and keep those of ``files``.

    Files whose lines are all null are named as ``others``, so that no second scan has to find them.

    Files are read split by split, so a huge sheet is not one task.  Where a file is cut depends on
    what else is scanned and on the cluster at that moment, so the scan runs once and is staged, and
    all that follows sees the same splits.  Each task numbers the lines that it reads; a line's number
    in its split is the difference to the split's first, which is a minimum, so nothing is sorted and
    no split or compressed file has to be one group.

    In most files each line is a record.  Those with line breaks inside quoted cells, or with blank lines
    before others, are found by counting both in each split.  Of such a file only the lines from the first
    of these to the last are put together by :func:`whole_records`; the lines after them move up by as many
    as were joined or blank.
    """
    line = F.rtrim(F.col("value"), F.lit("\r"))
    text = scan.withColumn("line", F.when(F.col("split") == 0, F.ltrim(line, F.lit(_BOM))).otherwise(line))
    text = text.select("entry_file", "path", "split", "line", F.monotonically_increasing_id().alias("read_order"))
    if files is not None:
        # Numbered before, as this join may shuffle and sort; a file's lines stay or go together.
        text = text.join(files.select("entry_file"), "entry_file", "left_semi")
    text = stage(text, f"{scratch}/lines")
    others = text.filter("line is null").select("entry_file").distinct()
    text = text.filter("line is not null")

    filled = F.when(F.col("line") != "", F.col("read_order"))
    blank = F.when(F.col("line") == "", F.col("read_order"))
    odd = F.when(unbalanced_quotes(F.col("line")), F.col("read_order"))
    splits = text.groupBy("entry_file", "path", "split").agg(
        F.min("read_order").alias("first"),
        F.count(F.lit(1)).alias("n"),
        F.count(filled).alias("n_filled"),
        F.max(filled).alias("last_filled"),
        F.min(blank).alias("first_blank"),
        F.max(blank).alias("last_blank"),
        F.min(odd).alias("first_odd"),
        F.max(odd).alias("last_odd"),
    )
    splits = stage(splits, f"{scratch}/splits")
    paths = splits.groupBy("entry_file").agg(F.min("path").alias("path"), F.count_distinct("path").alias("paths"))
    repeated = paths.filter("paths > 1").select("entry_file", "paths")
    splits = splits.join(paths.select("entry_file", "path"), ["entry_file", "path"], "left_semi")
    # The splits of one file.
    file = Window.partitionBy("entry_file").orderBy("split")
    offset = F.coalesce(F.sum("n").over(file.rowsBetween(Window.unboundedPreceding, -1)), F.lit(0))
    filled_later = F.coalesce(F.sum("n_filled").over(file.rowsBetween(1, Window.unboundedFollowing)), F.lit(0)) > 0
    blank_between = F.when(filled_later, F.col("n_filled") < F.col("n")).otherwise(
        F.col("last_filled") - F.col("first") + 1 > F.col("n_filled")
    )
    # Lines of the split between which others may be joined or blank; blank lines at a file's end are none.
    blank_until = F.when(F.col("blank_between"), F.when(filled_later, F.col("last_blank")).otherwise(F.col("last_filled")))
    whole = Window.partitionBy("entry_file")
    bases = (
        splits.withColumn("base", offset + 1 - F.col("first"))
        .withColumn("blank_between", blank_between)
        .withColumn("since", F.least("first_odd", "first_blank") + F.col("base"))
        .withColumn("until", F.greatest("last_odd", blank_until) + F.col("base"))
        .select(
            *("entry_file", "path", "split", "n", "base"),
            F.min("since").over(whole).alias("since"),
            F.max("until").over(whole).alias("until"),
        )
    )
    bases = stage(bases, f"{scratch}/bases")

    columns = ("path", "split", "base", "since", "until")
    line_no = F.col("read_order") + F.col("base")
    if bases.filter("until is not null").isEmpty():
        lines = text.join(bases.select("path", "split", "base"), ["path", "split"]).filter(F.col("line") != "")
        lines = lines.select("entry_file", line_no.alias("line_no"), "line")
    else:
        broken = text.join(bases.filter("until is not null").select(*columns), ["path", "split"])
        broken = broken.select("entry_file", line_no.alias("line_no"), "line", "since", "until")
        broken = broken.filter(F.col("line_no").between(F.col("since"), F.col("until"))).drop("since", "until")
        joined, gone = whole_records(broken, scratch, CHUNK_LINES)
        # One row for each split, so that the other lines need no further join.
        places = stage(bases.join(gone, "entry_file", "left").select(*columns, "gone"), f"{scratch}/places")
        lines = text.join(places, ["path", "split"]).withColumn("line_no", line_no)
        after = F.col("line_no") > F.col("until")
        lines = lines.filter((F.col("line") != "") & (F.col("until").isNull() | after | (F.col("line_no") < F.col("since"))))
        no = F.col("line_no") - F.when(after, F.col("gone")).otherwise(0)
        lines = lines.select("entry_file", no.alias("line_no"), "line").unionByName(joined)
    lines = lines.select("entry_file", F.floor(F.col("line_no") / CHUNK_LINES).alias("chunk"), "line_no", "line")
    # No sheet has more records than lines.
    sizes = bases.groupBy("entry_file").agg(F.floor(F.sum("n") / CHUNK_LINES).alias("last")).filter("last > 0")
    if sizes.isEmpty():
        # Known beforehand, so that Catalyst takes the sheets' rows for as small as they are.
        sizes = sizes.filter(F.lit(False))
    chunks = sizes.select("entry_file", F.explode(F.sequence(F.lit(1).cast("bigint"), "last")).alias("chunk"))
    return SheetLines(lines, chunks, repeated, others)


def line_tables(scratch: str) -> list[str]:
    """What :func:`number_lines` stages."""
    return [f"{scratch}/{name}" for name in ("lines", "splits", "bases", "marked", "told", "whole", "gone", "places")]


def lines_of(contents: DataFrame) -> DataFrame:
    """Numbered records ``(entry_file, line_no, line)`` of a table ``(entry_file, content)`` of sheet texts."""
    kept = records_of(F.ltrim(F.col("content"), F.lit(_BOM)))
    return contents.select("entry_file", F.posexplode(kept).alias("pos", "line")).select(
        "entry_file", (F.col("pos") + 1).cast("bigint").alias("line_no"), "line"
    )
