"""Text to value. Nothing here fails: text that cannot be read becomes null."""

from __future__ import annotations

import re

from pyspark.sql import Column
from pyspark.sql import functions as F

INFINITY = float("inf")


def _col(c: Column | str) -> Column:
    return F.col(c) if isinstance(c, str) else c


def trimmed(c: Column | str) -> Column:
    """Without leading and trailing spaces (other white space stays)."""
    return F.trim(_col(c).cast("string"))


def is_blank(c: Column | str) -> Column:
    """Null, empty or only spaces; never null itself."""
    return F.coalesce(F.length(trimmed(c)) == 0, F.lit(True))


def blank_to_null(c: Column | str) -> Column:
    return F.nullif(trimmed(c), F.lit(""))


# Inside `try_*` functions text that cannot be read costs an exception, 5 to 15
# microseconds against 0.1 for text that can. Two comparisons with the trimmed text keep
# blanks and words away: a readable number starts with white space or another control
# code, a sign, a point or a digit, all of them below the colon. The trimmed text stands
# in the condition twice, so Spark computes it once and uses it for the reading as well.


def _before_words(text: Column) -> Column:
    return (text > "") & (text < ":")


def as_double(c: Column | str) -> Column:
    """Any finite number Spark can read. Words, also those for NaN and infinity, are null."""
    text = trimmed(c)
    return F.when(_before_words(text), text.try_cast("double"))


def finite(value: Column) -> Column:
    """The value, or null for NaN and infinities. NaN sorts above infinity."""
    return F.when(F.abs(value) < INFINITY, value)


def to_number(c: Column | str) -> Column:
    return finite(as_double(c))


def to_int(c: Column | str, strict: bool = False) -> Column:
    """32-bit integer. Lenient: `12.0` is 12 and `12.7` truncates to 12; strict: both null."""
    if not strict:
        return as_double(c).try_cast("int")
    text = trimmed(c)  # whole numbers may also have a delete code around them
    return F.when(_before_words(text) | text.startswith("\x7f"), text.try_cast("int"))


def to_date(c: Column | str, pattern: str) -> Column:
    text = trimmed(c)
    date = F.try_to_date(text, pattern)
    if not re.fullmatch(r"(yyyy|MM|dd|[^A-Za-z'])*", pattern):
        return date
    # Fixed width, except that a signed year may have more digits. Five are read; years
    # of six and more would overflow Spark's timestamps and fail the job.
    extra = F.length(text) - len(pattern)
    signed = (text.startswith("+") | text.startswith("-")) & extra.between(1, 2)
    return F.when((extra == 0) | signed, date)
