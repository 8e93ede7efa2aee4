"""Coercions from text and presentation strings."""

from __future__ import annotations

import re

from pyspark.sql import Column
from pyspark.sql import functions as F

from ratingloom.defaults import DATE_FORMAT, LABEL_SEPARATOR
from ratingloom.functions.measures import ColumnOrName, as_column

# What the whitespace form of trimming strips, and what a display
# label loses at either end.
WHITESPACE = " \t\n\r\x0b\x0c"
LABEL_EDGE = " ~-."


def trimmed(text: ColumnOrName, whitespace: bool = False) -> Column:
    """Trim blanks, or every whitespace character when asked."""
    text = as_column(text)
    return F.btrim(text, F.lit(WHITESPACE)) if whitespace else F.trim(text)


def to_number(text: ColumnOrName, kind: str = "double") -> Column:
    """Number in ``text``, null where it is not one.

    Spark also reads Java's type suffixes ("10f"); those are not numbers here.
    """
    text = as_column(text)
    return F.when(~text.rlike(r"[0-9.][dDfF]\s*$"), text.try_cast(kind))


def to_date(text: ColumnOrName, pattern: str = DATE_FORMAT) -> Column:
    """Date in ``text``, null where it does not fit ``pattern``."""
    return F.try_to_timestamp(as_column(text), F.lit(pattern)).cast("date")


def split_labels(text: ColumnOrName, separator: str = LABEL_SEPARATOR) -> Column:
    """Distinct, trimmed, non-blank labels of a separated string, as an array.

    Blanks around separators go before the split, so that no per-element lambda is
    needed and the whole expression is compiled.
    """
    if not separator or separator != separator.strip():
        raise ValueError("a separator is not empty and has no blank at either end")
    pattern = re.escape(separator)
    literal = separator.replace("\\", "\\\\").replace("$", "\\$")
    tight = F.regexp_replace(F.trim(as_column(text)), f" *{pattern} *", literal)
    return F.array_distinct(F.array_remove(F.split(tight, pattern), ""))


def display_label(text: ColumnOrName, fallback: Column | str | None = None) -> Column:
    """ASCII part of ``text`` without edge marks.

    When nothing is left the label is ``fallback``, by default the text itself
    after the word "App".
    """
    text = as_column(text)
    if fallback is None:
        fallback = F.concat(F.lit("App "), text)
    elif isinstance(fallback, str):
        fallback = F.lit(fallback)
    ascii_only = F.regexp_replace(text, r"[^\x00-\x7F]+", "")
    return F.coalesce(F.nullif(F.btrim(ascii_only, F.lit(LABEL_EDGE)), F.lit("")), fallback)


def title_words(text: ColumnOrName) -> Column:
    """Underscores to blanks, then every run of letters capitalised ("2d" -> "2D")."""
    spaced = F.replace(as_column(text), F.lit("_"), F.lit(" "))
    runs = F.regexp_extract_all(spaced, F.lit(r"(\p{L}+|[^\p{L}]+)"), F.lit(1))
    return F.array_join(F.transform(runs, lambda run: F.initcap(run)), "")


def thousands(value: ColumnOrName, decimals: int = 0) -> Column:
    """Number with thousands separators."""
    return F.format_number(as_column(value), decimals)


def affixed(value: ColumnOrName, prefix: str = "", suffix: str = "", decimals: int = 2) -> Column:
    """Fixed-point number between literal affixes, e.g. ``12.50%`` or ``GBP 3.00``."""
    number = as_column(value).cast("double")
    before, after = (part.replace("%", "%%") for part in (prefix, suffix))
    return F.when(number.isNotNull(), F.format_string(f"{before}%.{decimals}f{after}", number))
