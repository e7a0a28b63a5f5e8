"""Incremental insert-if-absent into a table, with the known keys as keyed state."""

from __future__ import annotations

from pyspark.sql import DataFrame
from pyspark.sql import functions as F
from pyspark.sql.streaming import StreamingQuery

from jobgrain.operators.keys import absent_from

STATE_STORE = "org.apache.spark.sql.execution.streaming.state.RocksDBStateStoreProvider"
_STORE = "spark.sql.streaming.stateStore.providerClass"


def insert_new(
    rows: DataFrame,
    table: str,
    checkpoint: str,
    keys: list[str],
    order: list[str],
    known: DataFrame | None = None,
) -> StreamingQuery:
    """Append rows whose key no earlier batch had; of several rows of one batch the
    first in the given order is taken. NULL keys are equal.

    The first row of each key is the state of a streaming aggregate: the least by the
    time of the batch, which all rows of a batch share and which is logged with it, and
    then by the order. A batch looks up the state of its own keys only, in a store on
    disk, and reads nothing of the table, so its cost does not grow with the table. There
    is no watermark: however late a key comes, it is kept, and no state is dropped.
    Rows are reduced before they are shuffled, so a hot key is no burden.

    Each batch writes a folder of its own, named by the batch number. So a batch that is
    run again after a failure replaces what its first try wrote. A table that has rows
    from elsewhere is given as `known` (read by each batch), as the state has the
    stream's own keys only. `rows` must not be an aggregate itself, and the names `_first`,
    `_since` and `_last` are taken.
    """
    rest = [c for c in rows.columns if c not in keys]
    now = F.current_timestamp()
    least = F.struct(F.col("_now"), *[F.col(c) for c in order])
    first = rows.withColumn("_now", now).groupBy(*keys).agg(
        F.min_by(F.struct(*rest), least).alias("_first"),
        F.min("_now").alias("_since"),
        F.max("_now").alias("_last"),
    )

    def write(batch: DataFrame, number: int) -> None:
        new = batch.where("_since = _last")  # of the keys that this batch had, new ones
        new = new.select(
            *[F.col(c) if c in keys else F.col("_first")[c].alias(c) for c in rows.columns]
        )
        if known is not None:
            new = absent_from(new, known, keys)
        new.write.mode("overwrite").parquet(f"{table}/batch={number}")

    spark = rows.sparkSession
    before = spark.conf.get(_STORE)
    spark.conf.set(_STORE, STATE_STORE)  # kept by the query's checkpoint from here on
    try:
        return (
            first.writeStream.foreachBatch(write)
            .outputMode("update")
            .option("checkpointLocation", checkpoint)
            .trigger(availableNow=True)
            .start()
        )
    finally:
        spark.conf.set(_STORE, before)
