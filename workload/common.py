"""Table access for the workload."""

from __future__ import annotations

import tempfile

from pyspark.sql import DataFrame, SparkSession
from pyspark.sql import functions as F

from jobgrain.session import tune


# White space as the cleaning rules see it, for SQL regular expressions.
SPACE_CLASS = (
    r"\t-\r\x1c-\x20\x{85}\x{a0}\x{1680}\x{2000}-\x{200a}\x{2028}\x{2029}\x{202f}\x{205f}\x{3000}"
)

_tables: dict[tuple[str, str, str], DataFrame] = {}


def table(spark: SparkSession, sf_dir: str, name: str) -> DataFrame:
    """A given table. Its schema is read from the files once per session."""
    key = (spark.sparkContext.applicationId, sf_dir, name)
    if key not in _tables:
        tune(spark)
        if not spark.conf.get("spark.checkpoint.dir", None) and spark.sparkContext.master.startswith("local"):
            # a trial on one machine; a cluster names its shared folder
            spark.conf.set("spark.checkpoint.dir", tempfile.mkdtemp(prefix="workload-"))
        _tables[key] = spark.read.parquet(f"{sf_dir}/{name}.parquet")
    return _tables[key]


def as_double(df: DataFrame, *columns: str) -> DataFrame:
    return df.withColumns({c: F.col(c).cast("double") for c in columns})
