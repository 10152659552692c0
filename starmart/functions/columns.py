"""Small column helpers shared by the operators."""

from __future__ import annotations

from pyspark.sql import Column
from pyspark.sql import functions as F


def quoted(name: str) -> Column:
    """Column by its exact top-level name, also when it holds blanks or dots."""
    return F.col("`" + name.replace("`", "``") + "`")


# The characters that count as white space in Unicode text.
WHITE_SPACE = (
    "\t\n\x0b\x0c\r\x1c\x1d\x1e\x1f \x85\xa0\u1680"
    "\u2000\u2001\u2002\u2003\u2004\u2005\u2006\u2007\u2008\u2009\u200a"
    "\u2028\u2029\u202f\u205f\u3000"
)


def strip(text: Column) -> Column:
    """Trim any white space on both sides (plain ``trim`` takes blanks only)."""
    return F.btrim(text, F.lit(WHITE_SPACE))


def to_int_or_null(number: Column) -> Column:
    """Floating point to int, fractions cut; NULL where an int cannot hold the number.

    Same result as ``try_cast``, without the exception it raises and catches per such row.
    """
    return F.when((number > -(2.0**31) - 1) & (number < 2.0**31), number.cast("int"))


def count_null(name: str) -> Column:
    return F.count_if(quoted(name).isNull())


def count_non_null(name: str) -> Column:
    return F.count(quoted(name))
