"""Incremental jobs over the event table as a file stream."""

from __future__ import annotations

from pyspark.sql import functions as F

from jobgrain.session import shared_dir
from jobgrain.streaming.insert import insert_new
from jobgrain.streaming.landing import ingest, landing_stream
from workload.common import table

QUERIES, SQL = {}, {}


def query(sql: str | None = None):
    def add(fn):
        QUERIES[fn.__name__] = fn
        if sql:
            SQL[fn.__name__] = sql
        return fn

    return add


def _micros():
    """Time as text, with as many decimals as it has."""
    return F.col("ts").cast("string")


def _events(spark, sf):
    schema = table(spark, sf, "events").schema
    return landing_stream(spark, sf, schema, source="parquet", files="events.parquet"), schema


@query("SELECT event_id, CAST(ts AS VARCHAR) AS ts, user_id, event_type, value, props FROM events")
def stream_ingest(spark, sf):
    events, schema = _events(spark, sf)
    out = shared_dir(spark, "stream_ingest")
    ingest(events, f"{out}/table", f"{out}/checkpoint").awaitTermination()
    stored = spark.read.schema(schema).parquet(f"{out}/table")
    return stored.withColumn("ts", _micros())


@query(
    """SELECT event_id, user_id, event_type, value, props FROM (SELECT *, row_number() OVER (
         PARTITION BY user_id, event_type ORDER BY ts, event_id) AS rn FROM events) WHERE rn = 1"""
)
def stream_insert_new(spark, sf):
    events, schema = _events(spark, sf)
    out = shared_dir(spark, "stream_insert")
    insert_new(
        events, f"{out}/table", f"{out}/checkpoint", ["user_id", "event_type"], ["ts", "event_id"]
    ).awaitTermination()
    stored = spark.read.schema(schema).parquet(f"{out}/table")
    return stored.select("event_id", "user_id", "event_type", "value", "props")


@query(
    """SELECT user_id, event_type, CAST(CAST(ts AS DATE) AS VARCHAR) AS day, min(event_id) AS event_id
       FROM events GROUP BY ALL"""
)
def stream_first_within(spark, sf):
    """First event per user, type and day, from files that come newest first: most
    keys are far older than what came before them."""
    events = table(spark, sf, "events").withColumn("day", F.to_date("ts").cast("string"))
    out = shared_dir(spark, "stream_late")
    later = F.month("ts") * 100 + F.dayofmonth("ts")
    for low, high in ((120, 1300), (110, 120), (0, 110)):
        part = events.where((later >= low) & (later < high)).coalesce(1)
        part.write.mode("append").parquet(f"{out}/in")
    stream = landing_stream(spark, f"{out}/in", events.schema, source="parquet", files_per_batch=1)
    keys = ["user_id", "event_type", "day"]
    insert_new(stream, f"{out}/table", f"{out}/checkpoint", keys, ["event_id"]).awaitTermination()
    return spark.read.schema(events.schema).parquet(f"{out}/table").select(*keys, "event_id")
