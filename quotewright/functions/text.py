"""Text column helpers."""

from __future__ import annotations

from pyspark.sql import Column
from pyspark.sql import functions as F


# Fixed value: the characters that count as white space when text is stripped.
WHITE_SPACE = (
    " \t\n\r\x0b\x0c\x1c\x1d\x1e\x1f\x85\xa0\u1680\u2000\u2001\u2002\u2003\u2004\u2005"
    "\u2006\u2007\u2008\u2009\u200a\u2028\u2029\u202f\u205f\u3000"
)


def strip(value: Column) -> Column:
    """Remove all leading and trailing white space (``trim`` takes spaces only)."""
    return F.trim(value, F.lit(WHITE_SPACE))


def normal_upper(value: Column) -> Column:
    return F.upper(F.trim(value))


def normal_lower(value: Column) -> Column:
    return F.lower(F.trim(value))
