"""Date conversions."""

from __future__ import annotations

from itertools import permutations

from pyspark.sql import Column
from pyspark.sql import functions as F

# Day zero of SAS dates, and the day numbers of 0001-01-01 and 9999-12-31.
SAS_EPOCH = "1960-01-01"
SAS_FIRST_DAY = -715509
SAS_LAST_DAY = 2936549

# What the digits of each field can be, and from that the texts an eight-digit pattern fits.
FIELDS = {"yyyy": "(?!0000)[0-9]{4}", "MM": "(0[1-9]|1[0-2])", "dd": "(0[1-9]|[12][0-9]|3[01])"}
EIGHT_DIGITS = {
    "".join(order): "^" + "".join(FIELDS[field] for field in order) + r"\z"
    for order in permutations(FIELDS)
}


def sas_days_to_date(days: Column) -> Column:
    """Numeric days since 1960-01-01 to a date; fractions cut toward zero.

    NULL, NaN, infinite or out-of-calendar input gives NULL. The range is tested on the
    number itself, because a failing ``try_cast`` raises and catches an exception per row.
    """
    days = days.try_cast("double")
    return F.when(
        (days > SAS_FIRST_DAY - 1) & (days < SAS_LAST_DAY + 1),
        F.date_add(F.lit(SAS_EPOCH).cast("date"), days.cast("int")),
    )


def text_to_date(text: Column, pattern: str) -> Column:
    """Text to a date by pattern; anything that is not exactly such a date gives NULL.

    A pattern of eight digits is cut into year, month and day and cast from there, once
    month and day are in range. ``try_to_date`` gives the same dates, but raises and
    catches an exception for each text that is none.
    """
    if pattern not in EIGHT_DIGITS:
        return F.try_to_date(text, pattern)
    year, month, day = (
        F.substring(text, pattern.index(field) + 1, len(field)) for field in FIELDS
    )
    iso = F.concat_ws("-", year, month, day)
    return F.when(text.rlike(EIGHT_DIGITS[pattern]), iso.try_cast("date"))
