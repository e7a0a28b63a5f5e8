"""Join conditions on plain, trimmed and case-folded keys.

Lookups are joined without broadcast hints: Spark broadcasts a side whose
measured size is below its threshold, and otherwise shuffles both sides and
splits a partition that one hot key has made too large.
"""

from __future__ import annotations

from collections.abc import Callable
from functools import reduce

from pyspark.sql import Column, DataFrame
from pyspark.sql import functions as F


def plain(c: Column) -> Column:
    return c


def trimmed(c: Column) -> Column:
    """Key without blanks around it."""
    return F.trim(c)


def folded(c: Column) -> Column:
    """Key in lower case, without blanks around it."""
    return F.lower(F.trim(c))


def same_keys(
    left: str,
    right: str,
    pairs: list[tuple[str, str]],
    null_safe: bool = False,
    left_form: Callable[[Column], Column] = plain,
    right_form: Callable[[Column], Column] = plain,
) -> Column:
    """Equality of key columns of two aliased tables. Plain equality never
    matches NULL; null-safe equality matches NULL with NULL. Both are hash keys."""

    def one(pair: tuple[str, str]) -> Column:
        a = left_form(F.col(f"{left}.{pair[0]}"))
        b = right_form(F.col(f"{right}.{pair[1]}"))
        return a.eqNullSafe(b) if null_safe else a == b

    return reduce(lambda a, b: a & b, map(one, pairs))


def lookup(
    left: DataFrame,
    right: DataFrame,
    pairs: list[tuple[str, str]],
    take: dict[str, str],
    how: str = "inner",
    **forms,
) -> DataFrame:
    """Add columns of a lookup table: `take` maps a column of `right` to its new
    name. All columns of `left` stay."""
    a, b = left.alias("_l"), right.alias("_r")
    return a.join(b, same_keys("_l", "_r", pairs, **forms), how).select(
        "_l.*", *[F.col(f"_r.{c}").alias(n) for c, n in take.items()]
    )
