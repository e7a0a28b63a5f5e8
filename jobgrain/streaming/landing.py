"""Incremental landing ingest: each new file once, then to the archive."""

from __future__ import annotations

from pyspark.sql import DataFrame, SparkSession
from pyspark.sql.streaming import StreamingQuery

from jobgrain.schemas import LANDING


def landing_stream(
    spark: SparkSession,
    path: str,
    schema: str,
    *,
    source: str = "json",
    files: str | None = None,
    archive: str | None = None,
    json_lines: bool = False,
    files_per_batch: int = 1000,
) -> DataFrame:
    """Stream of the records of new files. A batch takes a bounded number of
    files. A malformed file fails the stream, so none of its batch is stored and it
    does not count as consumed. With `archive`, consumed files are moved there when
    a later batch finishes."""
    reader = (
        spark.readStream.format(source).schema(schema).option("maxFilesPerTrigger", files_per_batch)
    )
    if source == "json":
        reader = reader.option("multiLine", not json_lines).option("mode", "FAILFAST")
    if files:
        reader = reader.option("pathGlobFilter", files)
    if archive:
        reader = reader.option("cleanSource", "archive").option("sourceArchiveDir", archive)
    return reader.load(path)


def ingest(records: DataFrame, table: str, checkpoint: str) -> StreamingQuery:
    """Append all records that are there now to a Parquet table, and stop. The
    checkpoint makes sure that a restart takes no file twice."""
    return (
        records.writeStream.format("parquet")
        .option("path", table)
        .option("checkpointLocation", checkpoint)
        .outputMode("append")
        .trigger(availableNow=True)
        .start()
    )


def ingest_landing(
    spark: SparkSession,
    path: str,
    dataset: str,
    table: str,
    checkpoint: str,
    archive: str | None = None,
    json_lines: bool = False,
) -> StreamingQuery:
    """Ingest new snapshot files of a dataset."""
    records = landing_stream(
        spark, path, LANDING[dataset], archive=archive, json_lines=json_lines
    )
    return ingest(records, table, checkpoint)
