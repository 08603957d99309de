"""Rules about single sheets: header keys and values, columns, cells."""

from __future__ import annotations

from collections.abc import Mapping, Sequence

from pyspark.sql import Column, DataFrame
from pyspark.sql import functions as F

from batchgate.functions.dates import KEY_DATE_PATTERN, KEY_TIME_PATTERN, bad_timestamp_text
from batchgate.functions.keys import date_text, time_text
from batchgate.operators.parse import HEADER_KEYS, MEASURES
from batchgate.operators.violations import Finding, Rule, as_violations, row_violations

# Vocabularies, patterns and column lists of the sheets.
EFFORT_UNITS = ("angler_hours", "electrofishing_hours", "meters", "trap_hours", "seine_pulls")
CREW_PATTERN = r"^([A-Za-z]+, )+([A-Za-z]+)$|^[A-Za-z]+$"
OPTIONAL_KEYS = ("comments", "distanceShocked")
TAG_COLUMNS = ("pitApply", "pitRecapture", "floyApply", "floyRecapture")
TRAP_COLUMN = "trapNumber"


def bad_format(c: Column, pattern: str) -> Column:
    """Text is present and does not contain the pattern."""
    return c.isNotNull() & ~c.rlike(pattern)


def header_blank_keys(sheets: DataFrame, rule: Rule = Rule("header_blank_key")) -> DataFrame:
    """Header lines without a key; the value is the line number."""
    bad = sheets.select("entry_file", F.explode("blank_keys").alias("n"))
    return as_violations(bad, rule, column="header", value=F.col("n"), entry_file=F.col("entry_file"))


def is_blank(c: Column) -> Column:
    return c.isNull() | (c.cast("string") == "")


def missing_values(
    headers: DataFrame, keys: Sequence[str] = HEADER_KEYS, optional: Sequence[str] = OPTIONAL_KEYS
) -> DataFrame:
    """One row (entry_file, key) per header key that must have a value and has none.

    Every present key needs a value, known or not; site names are not asked of trap sheets.
    """
    tests = []
    for k in keys:
        if k in optional:
            continue
        blank = is_blank(F.col(k))
        if k == "siteName":
            blank = blank & ~F.col("is_trap")
        tests.append(F.when(blank, F.lit(k)))
    known = F.array(*[F.lit(k) for k in (*keys, *optional)])
    others = F.map_keys(
        F.map_filter("header", lambda k, v: ~F.array_contains(known, k) & (v.isNull() | (v == "")))
    )
    missing = F.concat(F.filter(F.array(*tests), lambda k: k.isNotNull()), others)
    return headers.select("entry_file", F.explode(missing).alias("key"))


def required_values(
    headers: DataFrame,
    rule: Rule = Rule("header_required"),
    keys: Sequence[str] = HEADER_KEYS,
    optional: Sequence[str] = OPTIONAL_KEYS,
) -> DataFrame:
    missing = missing_values(headers, keys, optional)
    return as_violations(missing, rule, column=F.col("key"), entry_file=F.col("entry_file"))


def missing_columns(
    sheets: DataFrame, required: Sequence[str], only_regular: bool = False
) -> DataFrame:
    """One row (entry_file, name) per required column that the sheet lacks."""
    if only_regular:
        sheets = sheets.filter(~F.col("is_trap"))
    wanted = F.array(*[F.lit(c) for c in required])
    names = F.coalesce("names", F.array().cast("array<string>"))
    return sheets.select("entry_file", F.explode(F.array_except(wanted, names)).alias("name"))


def require_columns(
    sheets: DataFrame, required: Sequence[str], rule: Rule, only_regular: bool = False
) -> DataFrame:
    bad = missing_columns(sheets, required, only_regular)
    return as_violations(bad, rule, column=F.col("name"), entry_file=F.col("entry_file"))


def forbidden_column_finding(name: str = TRAP_COLUMN, rule: Rule = Rule("trap_column")) -> Finding:
    """A trap column in a sheet that is not named as a trap sheet."""
    return Finding(rule, ~F.col("is_trap") & F.array_contains("names", name), name)


def unnamed_columns(rows: DataFrame, rule: Rule = Rule("unnamed_column", severity="warning")) -> DataFrame:
    """Sheets with data in columns that have no name."""
    bad = rows.filter("extra_data").select("entry_file").distinct()
    return as_violations(bad, rule, column="columns", entry_file=F.col("entry_file"))


def sheet_findings(rules: Mapping[str, Rule]) -> list[Finding]:
    """Tests on a typed header, by rule name."""
    unit, crew = F.col("effortUnits"), F.col("crew")
    at = F.col("dateTimeSample")
    separator = F.col("lakeID").contains("_") | F.coalesce(F.col("siteName").contains("_"), F.lit(False))
    return [
        Finding(rules["header_duplicate_key"], F.size("duplicate_keys") > 0, "header", F.array_join("duplicate_keys", ", ")),
        *[
            Finding(rules["timestamp_format"], bad_timestamp_text(F.col("header")[k]) & F.col(k).isNull(), k, F.col("header")[k])
            for k in ("dateTimeSet", "dateTimeSample")
        ],
        Finding(rules["gear_missing"], is_blank(F.col("gear")), "gear"),
        Finding(rules["effort_units"], unit.isNotNull() & ~unit.isin(*EFFORT_UNITS), "effortUnits", unit),
        Finding(
            rules["crew_format"],
            (unit == "angler_hours") & ~F.coalesce(crew.rlike(CREW_PATTERN), F.lit(False)),
            "crew",
            crew,
        ),
        Finding(rules["duplicate_column"], F.size("duplicate_names") > 0, "columns", F.array_join("duplicate_names", ", ")),
        forbidden_column_finding(rule=rules["trap_column"]),
        Finding(
            rules["key_time"],
            at.isNotNull() & (~date_text(at).rlike(KEY_DATE_PATTERN) | ~time_text(at).rlike(KEY_TIME_PATTERN)),
            "dateTimeSample",
            at,
        ),
        Finding(rules["key_separator"], separator, "siteName", F.concat_ws(" / ", "lakeID", "siteName")),
    ]


def unknown_columns_finding(known: Sequence[str], rule: Rule) -> Finding:
    """Columns that no table keeps."""
    named = F.filter(F.coalesce("names", F.array().cast("array<string>")), lambda n: n.isNotNull())
    extra = F.array_except(named, F.array(*[F.lit(c) for c in known]))
    return Finding(rule, F.size(extra) > 0, "columns", F.array_join(extra, ", "))


def check_sheets(
    headers: DataFrame,
    rules: Mapping[str, Rule],
    known_columns: Sequence[str],
    optional_keys: Sequence[str] = OPTIONAL_KEYS,
) -> list[DataFrame]:
    """All sheet-level rules; the input is one row per sheet."""
    findings = [*sheet_findings(rules), unknown_columns_finding(known_columns, rules["unknown_column"])]
    return [
        header_blank_keys(headers, rules["header_blank_key"]),
        required_values(headers, rules["header_required"], optional=optional_keys),
        require_columns(headers, MEASURES, rules["measure_columns"]),
        require_columns(headers, TAG_COLUMNS, rules["tag_columns"], only_regular=True),
        row_violations(headers, findings, entity=None, entry_file=F.col("entry_file")),
    ]
