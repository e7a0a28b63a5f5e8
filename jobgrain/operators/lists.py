"""Lists to rows."""

from __future__ import annotations

from pyspark.sql import Column, DataFrame
from pyspark.sql import functions as F


def explode_keep(df: DataFrame, column: str, into: str) -> DataFrame:
    """One row per element; a NULL or empty list gives one row with NULL."""
    others = [c for c in df.columns if c != column]
    return df.select(*others, F.explode_outer(column).alias(into))


def list_product(df: DataFrame, columns: dict[str, str]) -> DataFrame:
    """Every combination of the elements of several lists of a row; `columns`
    maps a list column to the name of its element."""
    for column, into in columns.items():
        df = explode_keep(df, column, into)
    return df


def explode_parts(df: DataFrame, parts: Column, into: str, keep: list[str]) -> DataFrame:
    """Distinct (kept columns, part) for the filled parts of a text list."""
    return (
        df.select(*keep, F.explode(parts).alias(into))
        .where(F.col(into).isNotNull() & (F.col(into) != ""))
        .distinct()
    )
