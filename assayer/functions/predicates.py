"""Row-level violations.

Each function gives a boolean Column that is true for a violating row. NULL input gives NULL (or
false), which neither `count_if`, `when` nor `filter` takes for a violation; only `is_missing` is
about NULLs.
"""

from __future__ import annotations

from collections.abc import Sequence

from pyspark.sql import Column
from pyspark.sql import functions as F


def is_missing(col: Column) -> Column:
    return col.isNull()


def outside_set(col: Column, literals: Sequence[Column]) -> Column:
    return ~col.isin(*literals)


def length_differs(col: Column, value: int, rtrim: bool = False) -> Column:
    """`rtrim` leaves trailing blanks uncounted, as some SQL dialects' length does."""
    text = col.cast("string")
    return F.length(F.rtrim(text) if rtrim else text) != value


def unlike(
    col: Column, pattern: str, ignore_case: bool = False, escape: str | None = None
) -> Column:
    """Without `escape` every character but % and _ stands for itself, a backslash too."""
    like = F.ilike if ignore_case else F.like
    if escape is None:
        escape, pattern = "\\", pattern.replace("\\", "\\\\")
    return ~like(col.cast("string"), F.lit(pattern), F.lit(escape))


def lacks_substring(col: Column, substring: str) -> Column:
    return ~F.contains(col.cast("string"), F.lit(substring))
