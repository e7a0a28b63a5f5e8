"""Session settings the jobs rely on."""

from __future__ import annotations

import uuid
from collections.abc import Iterator
from contextlib import contextmanager

from pyspark.sql import SparkSession

# Settings that may be changed on a running session. The time zone is needed for
# right results (all timestamps are UTC); the others let Spark re-plan from the
# sizes it sees at run time: broadcast only what is measured to be small, and
# split a shuffle partition that one hot key makes too large.
RUNTIME_SETTINGS = {
    "spark.sql.session.timeZone": "UTC",
    "spark.sql.adaptive.enabled": "true",
    "spark.sql.adaptive.coalescePartitions.enabled": "true",
    "spark.sql.adaptive.skewJoin.enabled": "true",
    "spark.sql.adaptive.forceOptimizeSkewedJoin": "true",
}


def tune(spark: SparkSession) -> SparkSession:
    """Apply the runtime settings to a session made elsewhere."""
    for key, value in RUNTIME_SETTINGS.items():
        if spark.conf.get(key, None) != value:
            spark.conf.set(key, value)
    return spark


def build_session(
    app_name: str = "jobgrain",
    master: str | None = None,
    shuffle_partitions: int | None = None,
    **extra: str,
) -> SparkSession:
    """A session with the settings above. On a cluster leave `master` and
    `shuffle_partitions` to the submit command."""
    builder = SparkSession.builder.appName(app_name).config("spark.ui.enabled", "false")
    if master:
        builder = builder.master(master)
    if shuffle_partitions:
        builder = builder.config("spark.sql.shuffle.partitions", str(shuffle_partitions))
    for key, value in {**RUNTIME_SETTINGS, **extra}.items():
        builder = builder.config(key, value)
    return builder.getOrCreate()


def shared_dir(spark: SparkSession, name: str) -> str:
    """A fresh folder path that every executor can reach.

    It lies under the folder the cluster names in `spark.checkpoint.dir`.
    """
    root = spark.conf.get("spark.checkpoint.dir", None)
    if not root:
        raise ValueError("set spark.checkpoint.dir to a shared folder")
    return f"{root.rstrip('/')}/{name}-{uuid.uuid4().hex[:12]}"


RELEASE = "spark.sql.classic.shuffleDependency.fileCleanup.enabled"


@contextmanager
def releasing_shuffles(spark: SparkSession) -> Iterator[None]:
    """Each write inside drops its shuffle files when it ends, instead of whenever the
    driver happens to collect its garbage. For frames that run once, as when a table is
    written and read back: one that runs again makes its shuffles again."""
    old = spark.conf.get(RELEASE, None)
    spark.conf.set(RELEASE, "true")
    try:
        yield
    finally:
        if old is None:
            spark.conf.unset(RELEASE)
        else:
            spark.conf.set(RELEASE, old)
