"""Surrogate ids and insert-if-absent."""

from __future__ import annotations

from functools import reduce

from pyspark.sql import Column, DataFrame, Window
from pyspark.sql import functions as F

from jobgrain.operators.rows import one_per_key

ID_BUCKETS = 1 << 20  # five hexadecimal digits of a digest


def key_digest(keys: list[str]) -> Column:
    return F.md5(F.concat_ws("|", *[F.col(k).cast("string") for k in keys]))


def bucket_part(keys: list[str], part: int, parts: int) -> Column:
    """Whether a row is in one of up to 16 parts of the buckets of `with_ids`. Numbering
    these parts one after the other gives the same ids as numbering all rows at once."""
    digits = [d for i, d in enumerate("0123456789abcdef") if i % parts == part]
    return F.substring(key_digest(keys), 1, 1).isin(digits)


def next_after(existing: DataFrame, id_column: str) -> Column:
    """Largest id in a table (0 when it is empty), as a scalar subquery."""
    return existing.agg(F.coalesce(F.max(id_column), F.lit(0))).scalar()


def with_ids(
    df: DataFrame, keys: list[str], id_column: str, after: Column | int = 0
) -> DataFrame:
    """Number rows that are unique on `keys`; ids are above `after` and unique.

    A digest of the key spreads the rows evenly over 2^20 buckets; a row's id
    is its rank inside the bucket times the number of buckets plus the bucket.
    So numbering runs in parallel, needs one shuffle and no second pass, gives
    the same ids when a lost task is repeated, and cannot collide as a hash id
    can. Like those of a database sequence, the ids may have gaps. Of the digest,
    only the bucket and the eight bytes after it are shuffled; the keys settle ties.
    """
    after = F.lit(after) if isinstance(after, int) else after
    digest = key_digest(keys)
    bucket = F.conv(F.substring(digest, 1, 5), 16, 10).cast("bigint")
    order = F.unhex(F.substring(digest, 6, 16))
    rank = F.row_number().over(Window.partitionBy("_bucket").orderBy("_order", *keys))
    numbered = df.withColumns({"_order": order, "_bucket": bucket}).withColumn(
        "_rank", rank
    )
    new_id = after + (F.col("_rank") - 1) * F.lit(ID_BUCKETS) + F.col("_bucket") + 1
    return numbered.select(new_id.cast("bigint").alias(id_column), *df.columns)


def absent_from(
    batch: DataFrame, target: DataFrame, keys: list[str], null_safe: bool = True
) -> DataFrame:
    """Rows of the batch whose key the target does not hold. With `null_safe`
    two NULL key parts are equal; without, such a row is always absent."""
    known = target.select(*[F.col(k).alias(f"_t_{k}") for k in keys])

    def same(k: str) -> Column:
        mine, theirs = F.col(k), F.col(f"_t_{k}")
        return mine.eqNullSafe(theirs) if null_safe else mine == theirs

    return batch.join(known, reduce(lambda a, b: a & b, map(same, keys)), "left_anti")


def insert_if_absent(
    batch: DataFrame,
    target: DataFrame,
    keys: list[str],
    null_safe: bool = True,
    prefer: str = "min",
) -> DataFrame:
    """Rows to append to the target: one per key of the batch, and only keys the
    target lacks. The batch is reduced before the join, so both sides of the join
    hold a key at most once."""
    return absent_from(one_per_key(batch, keys, prefer), target, keys, null_safe)
