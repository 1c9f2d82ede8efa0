"""Text scalars of the page fields."""

from __future__ import annotations

from pyspark.sql import Column
from pyspark.sql import functions as F

from ._column import as_column

# The characters that count as white space in Unicode text,
# including the four separators U+001C to U+001F, which Java's \s leaves out.
SPACES = (
    "\t\n\x0b\x0c\r\x1c\x1d\x1e\x1f \x85\xa0\u1680"
    "\u2000\u2001\u2002\u2003\u2004\u2005\u2006\u2007\u2008\u2009\u200a"
    "\u2028\u2029\u202f\u205f\u3000"
)
SPACE_CLASS = f"[{SPACES}]"

# Separators and sentence used by the pages.
TITLE_DATE_SEPARATOR = " for "
TIME_DASH = " — "
DURATION_SENTENCE = rf"This program is{SPACE_CLASS}([^\n]*?){SPACE_CLASS}long"


def py_strip(text: Column | str) -> Column:
    """Remove white space of any kind from both ends."""
    return F.btrim(as_column(text), F.lit(SPACES))


def split_title_date(info: Column | str, kind: str) -> tuple[Column, Column]:
    """Title and date of an info line ``<title> for <date>``.

    With several separators the title is the first and the date the last part.
    Without one, a special line gives two empty texts and an evening line has no
    date at all (null).
    """
    if kind not in ("special", "evening"):
        raise ValueError(f"unknown kind of info line: {kind}")
    info = as_column(info)
    parts = F.split(info, TITLE_DATE_SEPARATOR)
    found = F.coalesce(info.contains(TITLE_DATE_SEPARATOR), F.lit(False))
    absent = F.lit("") if kind == "special" else F.lit(None).cast("string")
    title = F.when(found, py_strip(F.get(parts, F.lit(0)))).otherwise(F.lit(""))
    date = F.when(found, py_strip(F.try_element_at(parts, F.lit(-1)))).otherwise(absent)
    return title, date


def headline_title(headline: Column | str) -> Column:
    """Stripped headline up to the first separator; the cut end is not stripped again."""
    text = py_strip(F.coalesce(as_column(headline), F.lit("")))
    return F.get(F.split(text, TITLE_DATE_SEPARATOR), F.lit(0))


def program_duration(text: Column | str) -> Column:
    """Duration named in the duration sentence, else the whole text stripped."""
    text = F.coalesce(as_column(text), F.lit(""))
    return F.when(
        text.rlike(DURATION_SENTENCE), F.regexp_extract(text, DURATION_SENTENCE, 1)
    ).otherwise(py_strip(text))


def time_range(text: Column | str) -> Column:
    """Stripped time range with the spaced long dash turned into ``-``."""
    return F.replace(py_strip(text), F.lit(TIME_DASH), F.lit("-"))


def concat_text(nodes: Column | str) -> Column:
    """Text nodes stripped one by one and joined without a separator."""
    return F.array_join(F.transform(as_column(nodes), py_strip), "")


def or_default(value: Column | str, default: Column | str | int) -> Column:
    """``value``, or ``default`` where extraction gave nothing."""
    return F.coalesce(as_column(value), default if isinstance(default, Column) else F.lit(default))
