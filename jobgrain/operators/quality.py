"""Checks and audits: keys, references, NULLs, row counts."""

from __future__ import annotations

from functools import reduce

from pyspark.sql import DataFrame
from pyspark.sql import functions as F


def duplicate_keys(df: DataFrame, keys: list[str]) -> DataFrame:
    """Keys that occur more than once, with `row_count`."""
    return (
        df.groupBy(*keys).agg(F.count(F.lit(1)).alias("row_count")).where("row_count > 1")
    )


def repeated_keys(new: DataFrame, old: DataFrame, keys: list[str]) -> DataFrame:
    """Keys that occur more than once in the new rows, or there and in the old
    ones, with `row_count` over the new rows. Two NULL key parts are equal."""
    both = new.select(*keys, F.lit(1).alias("_new")).unionByName(
        old.select(*keys, F.lit(0).alias("_new"))
    )
    counted = both.groupBy(*keys).agg(
        F.sum("_new").alias("row_count"), F.count(F.lit(1)).alias("_all")
    )
    return counted.where("row_count > 0 AND _all > 1").drop("_all")


def orphans(child: DataFrame, column: str, parent: DataFrame, parent_column: str) -> DataFrame:
    """Child key values without a parent, with `row_count`; NULL refers to nothing.

    Child rows are counted per key before the join, so a hot key crosses the
    shuffle once per task."""
    used = (
        child.where(F.col(column).isNotNull())
        .groupBy(F.col(column).alias("orphan_key"))
        .agg(F.count(F.lit(1)).alias("row_count"))
    )
    known = parent.select(F.col(parent_column).alias("_known"))
    return used.join(known, F.col("orphan_key") == F.col("_known"), "left_anti")


def null_profile(df: DataFrame) -> DataFrame:
    """`(column_name, null_count)` for every column and the total, in one pass."""
    counts = df.agg(*[F.count_if(F.col(f"`{c}`").isNull()).alias(c) for c in df.columns])
    total = reduce(lambda a, b: a + b, [F.col(f"`{c}`") for c in df.columns])
    pairs = [
        F.struct(F.lit(c).alias("column_name"), F.col(f"`{c}`").alias("null_count"))
        for c in df.columns
    ]
    pairs.append(F.struct(F.lit("(total)").alias("column_name"), total.alias("null_count")))
    return counts.select(F.inline(F.array(*pairs)))


def row_counts(tables: dict[str, DataFrame]) -> DataFrame:
    """`(table_name, row_count)` of several tables as one job. Parquet answers
    the counts from file footers."""
    counts = [
        df.agg(F.count(F.lit(1)).alias("row_count")).select(
            F.lit(name).alias("table_name"), "row_count"
        )
        for name, df in tables.items()
    ]
    return reduce(DataFrame.unionByName, counts)


def violations(checks: dict[str, DataFrame]) -> DataFrame:
    """`(check_name, violations)` of several checks, each a table with one row per
    violation. The rows of all checks are counted together, map-side first."""
    found = reduce(
        DataFrame.unionByName,
        [df.select(F.lit(name).alias("check_name")) for name, df in checks.items()],
    )
    counted = found.groupBy("check_name").agg(F.count(F.lit(1)).alias("found"))
    one = found.sparkSession.range(0, 1, 1, 1)
    names = one.select(F.explode(F.array(*map(F.lit, checks))).alias("check_name"))
    return names.join(counted, "check_name", "left").select(
        "check_name", F.coalesce("found", F.lit(0)).alias("violations")
    )
