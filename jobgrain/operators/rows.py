"""Row selection: first per key, one per key, required columns, blanks to NULL."""

from __future__ import annotations

from pyspark.sql import Column, DataFrame, Observation
from pyspark.sql import functions as F
from pyspark.sql import types as T

from jobgrain.functions.text import blank_to_null, empty_to_null

ORDER = "_input_order"


def with_input_order(df: DataFrame) -> DataFrame:
    """Add the position of each row in the input (file, block, row), to be called
    on a file scan before anything is shuffled."""
    place = F.struct(
        F.col("_metadata.file_path").alias("file"),
        F.col("_metadata.file_block_start").alias("block"),
        F.monotonically_increasing_id().alias("row"),
    )
    return df.withColumn(ORDER, place)


def keep_first(df: DataFrame, keys: list[str], order: Column | str) -> DataFrame:
    """First row per key in the given order (keys may be NULL, NULLs are equal).

    A grouped `min_by`: every task first reduces its own rows to one per key, so
    a key that holds a large share of all rows is no burden on one task, as a
    window over the key would be.
    """
    held = order if isinstance(order, str) and order not in keys else None
    rest = [c for c in df.columns if c not in keys and c != held]
    order = F.col(order) if isinstance(order, str) else order
    found = [F.min_by(F.struct(*rest), order).alias("_first")] if rest else []
    if held:  # beside the other columns, so that it crosses the shuffle once, not twice
        found.append(F.min(held).alias(held))
    return df.groupBy(*keys).agg(*found).select(
        *[F.col(c) if c in keys or c == held else F.col("_first")[c].alias(c) for c in df.columns]
    )


def one_per_key(df: DataFrame, keys: list[str], prefer: str = "min") -> DataFrame:
    """One row per key whatever the input order: the one whose other columns are
    smallest (or largest), compared from left to right."""
    rest = [c for c in df.columns if c not in keys]
    if not rest:
        return df.distinct()
    pick = {"min": F.min, "max": F.max}[prefer]
    return df.groupBy(*keys).agg(pick(F.struct(*rest)).alias("_one")).select(
        *[F.col(c) if c in keys else F.col("_one")[c].alias(c) for c in df.columns]
    )


def latest_per(df: DataFrame, keys: list[str], order: list[str], fields: list[str]) -> DataFrame:
    """Chosen fields of the newest row per key; what a lateral
    `ORDER BY ... DESC LIMIT 1` returns, without a sort per group."""
    newest = F.max_by(F.struct(*fields), F.struct(*order)).alias("_latest")
    return df.groupBy(*keys).agg(newest).select(
        *keys, *[F.col("_latest")[f].alias(f) for f in fields]
    )


def require(df: DataFrame, columns: list[str]) -> DataFrame:
    """Drop rows in which any of the columns is NULL; no columns, no change."""
    return df.dropna(how="any", subset=columns) if columns else df


def blanks_to_null(df: DataFrame) -> DataFrame:
    """Empty text and empty lists become NULL in every column."""
    out = []
    for f in df.schema.fields:
        c = F.col(f"`{f.name}`")
        if isinstance(f.dataType, T.StringType):
            c = blank_to_null(c)
        elif isinstance(f.dataType, (T.ArrayType, T.MapType)):
            c = empty_to_null(c)
        out.append(c.alias(f.name))
    return df.select(*out)


def counted(df: DataFrame, observation: Observation) -> DataFrame:
    """Count the rows that pass here while the job runs, without another pass;
    read the number from `observation.get` after the action."""
    return df.observe(observation, F.count(F.lit(1)).alias("rows"))
