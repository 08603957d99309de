"""Composite text keys: ``lake_site_yyyymmdd_hhmm_gear_metadata`` and, with a number, the record key."""

from __future__ import annotations

from pyspark.sql import Column
from pyspark.sql import functions as F


def number_text(c: Column) -> Column:
    """Text of a number, whole numbers without a decimal part."""
    whole = (c == F.floor(c)) & (F.abs(c) < 2.0**63)
    return F.when(whole, c.cast("bigint").cast("string")).otherwise(c.cast("string"))


def build_key(*parts: Column) -> Column:
    """Join the parts by ``_``; a missing part is written ``NA`` so that positions stay fixed."""
    return F.concat_ws("_", *[F.coalesce(p.cast("string"), F.lit("NA")) for p in parts])


def key_field(key: Column, position: int) -> Column:
    """Field of a key, counted from 1; null beyond the last field."""
    return F.get(F.split(key, "_"), position - 1)


def date_text(ts: Column) -> Column:
    """``yyyymmdd`` of a wall-clock time.  Works on its text form, so no session zone takes part."""
    return F.replace(F.substring(ts.cast("string"), 1, 10), F.lit("-"), F.lit(""))


def time_text(ts: Column) -> Column:
    """``hhmm`` of a wall-clock time, zero padded."""
    text = ts.cast("string")
    return F.concat(F.substring(text, 12, 2), F.substring(text, 15, 2))


def key_date(key: Column, position: int = 3) -> Column:
    """Date held in a key field, null when it is none."""
    digits = F.regexp_extract(key, rf"^(?:[^_]*_){{{position - 1}}}([0-9]{{8}})(?:_|\z)", 1)
    return F.regexp_replace(digits, r"^(....)(..)(..)$", "$1-$2-$3").try_cast("date")


def key_timestamp(key: Column, position: int = 3) -> Column:
    """Wall-clock minute held in two neighbouring key fields."""
    digits = F.regexp_extract(key, rf"^(?:[^_]*_){{{position - 1}}}([0-9]{{8}}_[0-9]{{4}})(?:_|\z)", 1)
    return F.regexp_replace(digits, r"^(....)(..)(..)_(..)(..)$", "$1-$2-$3 $4:$5:00").try_cast("timestamp_ntz")
