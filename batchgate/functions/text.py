"""Text cleaning expressions."""

from __future__ import annotations

from collections.abc import Iterable, Mapping

from pyspark.sql import Column, DataFrame
from pyspark.sql import functions as F

# Cell texts that mean "missing".
SHEET_NULLS = ("", " ", "NA")
TABLE_NULLS = ("", "NA")

# Java's \s is ASCII only; \p{Z} adds the Unicode separators (no-break space and friends).
_WS = r"[\s\p{Z}]"
# The same characters one by one, for the cheaper character-wise functions.
_WS_CHARS = "\t\n\v\f\r \u00a0\u1680\u2000\u2001\u2002\u2003\u2004\u2005\u2006\u2007\u2008\u2009\u200a\u2028\u2029\u202f\u205f\u3000"


def null_if(c: Column, nulls: Iterable[str] = TABLE_NULLS, then: Column | None = None) -> Column:
    """Null where the text is one of ``nulls``, else the text or what ``then`` makes of it."""
    return F.when(~c.isin(*nulls), c if then is None else then)


def strip_whitespace(c: Column) -> Column:
    """Remove all whitespace."""
    return F.translate(c, _WS_CHARS, "")


def clean_list_text(c: Column) -> Column:
    """Separate list items by ``, ``: a space after each comma, then each double blank made one."""
    return F.regexp_replace(F.regexp_replace(c, ",", ", "), _WS + _WS, " ")


def trim_one(c: Column) -> Column:
    """Remove at most one blank from each end."""
    return F.regexp_replace(c, rf"^{_WS}|{_WS}\z", "")


def list_length(c: Column) -> Column:
    """Number of ``, ``-separated items; a trailing separator adds none, empty text has none."""
    items = F.size(F.split(F.regexp_replace(c, r", \z", ""), ", "))
    return F.when(c == "", 0).when(c.isNotNull(), items)


def null_unless(c: Column, condition: Column) -> Column:
    """Keep ``c`` where the condition holds, else null."""
    return F.when(condition, c)


def map_synonyms(c: Column, spellings: Mapping[str, Iterable[str]]) -> Column:
    """Replace each known spelling by its canonical text."""
    out = None
    for canonical, variants in spellings.items():
        hit = c.isin(*variants)
        out = F.when(hit, canonical) if out is None else out.when(hit, canonical)
    return c if out is None else out.otherwise(c)


def collapse_code(c: Column, pattern: str, code: str) -> Column:
    """Reduce every text that contains ``pattern`` to one code."""
    return F.when(c.rlike(pattern), F.lit(code)).otherwise(c)


def unbalanced_quotes(line: Column) -> Column:
    """A quote that opens and does not close: part of a cell with line breaks, or damage."""
    return (F.length(line) - F.length(F.replace(line, F.lit('"'), F.lit("")))) % 2 == 1


def pad_left(c: Column, width: int, pad: str = "0") -> Column:
    """Left-pad without ever truncating longer text (``lpad`` alone would cut it)."""
    return F.when(F.length(c) >= width, c).otherwise(F.lpad(c, width, pad))


def normalise_code(c: Column, prefix: str = "MT", width: int = 3) -> Column:
    """Bring ``MT007``, ``MT.007`` and ``7`` to the one spelling ``MT.007``."""
    dotted = F.regexp_replace(c, rf"^(.*?){prefix}", f"$1{prefix}.")
    return (
        F.when(c.contains(prefix) & c.contains("."), c)
        .when(c.contains(prefix), dotted)
        .otherwise(F.concat(F.lit(prefix + "."), F.coalesce(pad_left(c, width), F.lit("NA"))))
    )


_DIGITS = "0123456789"
_UPPER = "ABCDEFGHIJKLMNOPQRSTUVWXYZ"
_LOWER = _UPPER.lower()


def shape(c: Column) -> Column:
    """Format of a text: digits become 0, capitals A, small letters a; the rest stays.

    One ``translate`` pass does what three regular-expression passes would.
    """
    return F.translate(c, _DIGITS + _UPPER + _LOWER, "0" * 10 + "A" * 26 + "a" * 26)


def drop_sentinel(df: DataFrame, column: str, sentinel: str = "NFC") -> DataFrame:
    """Drop "nothing caught" rows, keeping rows whose code is missing."""
    return df.filter(F.col(column).isNull() | (F.col(column) != sentinel))
