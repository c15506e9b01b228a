"""String helpers: templates, title case, truncation, display formats."""

from __future__ import annotations

from pyspark.sql import Column
from pyspark.sql import functions as F

# Everything that counts as white space: Unicode's property and the four separators 1C to 1F.
_BLANK = r"(?U)\A[\s\x1c-\x1f]*\z"


def title_words(c: Column) -> Column:
    """``x.replace('_', ' ').title()`` for the ASCII enum values in use."""
    return F.initcap(F.replace(c, F.lit("_"), F.lit(" ")))


def spaced(c: Column) -> Column:
    """``x.replace('_', ' ')``."""
    return F.replace(c, F.lit("_"), F.lit(" "))


def truncate(c: Column, n: int, ellipsis: str = "…") -> Column:
    """First ``n`` characters, plus an ellipsis when the text was longer."""
    return F.when(F.length(c) > n, F.concat(F.substring(c, 1, n), F.lit(ellipsis))).otherwise(c)


def minute_stamp(ts: Column) -> Column:
    """``str(ts)[:16]`` of a timestamp: ``yyyy-MM-dd HH:mm``."""
    return F.date_format(ts, "yyyy-MM-dd HH:mm")


def second_stamp(ts: Column) -> Column:
    return F.date_format(ts, "yyyy-MM-dd HH:mm:ss")


def is_blank(c: Column) -> Column:
    """NULL or only white space, any of Unicode's (``isna() or strip() == ''``)."""
    return c.isNull() | c.rlike(_BLANK)
