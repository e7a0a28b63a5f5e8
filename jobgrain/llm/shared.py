"""Tables kept between steps, in the shared folder of the cluster."""

from __future__ import annotations

import ctypes
import functools
import gc
import os
import tempfile
import uuid

import pyarrow as pa
from pyspark import Broadcast
from pyspark.sql import DataFrame, SparkSession


def shared_path(spark: SparkSession, name: str) -> str:
    """A new path under the folder that `spark.checkpoint.dir` names. Where that
    is unset (tests on one machine) a folder of this machine is set."""
    root = spark.conf.get("spark.checkpoint.dir", None)
    if not root:
        if not spark.sparkContext.master.startswith("local"):
            raise ValueError("set spark.checkpoint.dir to a shared folder")
        root = os.path.join(tempfile.gettempdir(), f"llm-{uuid.uuid4().hex[:12]}")
        spark.conf.set("spark.checkpoint.dir", root)
    return f"{root.rstrip('/')}/{name}-{uuid.uuid4().hex[:12]}"


def written(df: DataFrame, name: str) -> DataFrame:
    """The rows, written once and read back: later steps read files and do not
    repeat the work when an executor is lost."""
    path = shared_path(df.sparkSession, name)
    df.write.parquet(path)
    return df.sparkSession.read.schema(df.schema).parquet(path)


def table(spark: SparkSession, sf_dir: str, name: str) -> DataFrame:
    return spark.read.parquet(f"{sf_dir}/{name}.parquet")


_sent: list[Broadcast] = []


def sent(spark: SparkSession, value) -> Broadcast:
    """A broadcast that a DataFrame needs as long as it may run; `release` ends it."""
    _sent.append(spark.sparkContext.broadcast(value))
    return _sent[-1]


def release() -> None:
    """Destroy what `sent` sent, once the DataFrames that use it are written."""
    while _sent:
        _sent.pop().destroy()


def tidy() -> None:
    """Give memory that this Python worker no longer needs back to the system. Workers
    live on from stage to stage, and would keep the most that any of their tasks had."""
    gc.collect()
    pa.default_memory_pool().release_unused()
    try:
        ctypes.CDLL("libc.so.6").malloc_trim(0)
    except (OSError, AttributeError):  # another C library
        pass


def tidied(run):
    """A task function over batches that tidies up after the last one."""

    @functools.wraps(run)
    def whole(batches):
        yield from run(batches)
        tidy()

    return whole
