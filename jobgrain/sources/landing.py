"""Landing snapshots: files that hold one JSON array of nested records each."""

from __future__ import annotations

import re

from pyspark.sql import Column, DataFrame, SparkSession
from pyspark.sql import functions as F

from jobgrain.functions.text import first_name, strip
from jobgrain.operators.rows import ORDER, with_input_order
from jobgrain.schemas import FLAT_FIELDS, LANDING

STAMP_PATTERN = r"_(\d{8}_\d{6})"
_STAMP = re.compile(STAMP_PATTERN)


def _scan(
    spark: SparkSession, path: str | list[str], dataset: str, json_lines: bool
) -> DataFrame:
    return (
        spark.read.schema(LANDING[dataset])
        .option("multiLine", not json_lines)
        .option("mode", "FAILFAST")
        .json(path)
    )


def read_landing(
    spark: SparkSession, path: str | list[str], dataset: str, json_lines: bool = False
) -> DataFrame:
    """All records of all files, with their input order. A malformed file fails
    the job. An array file is read by one task, so write many files of moderate
    size, or JSON lines, which split."""
    return with_input_order(_scan(spark, path, dataset, json_lines))


def read_latest_landing(
    spark: SparkSession, path: str, dataset: str, json_lines: bool = False
) -> DataFrame:
    """Records of the newest stamped file (or snapshot folder) that `path`, which
    may be a glob, holds. The newest stamp comes from the file names, and the
    filter on the file path leaves the other files unread."""
    records = _scan(spark, path, dataset, json_lines)
    stamps = [found.group(1) for found in map(_STAMP.search, records.inputFiles()) if found]
    if not stamps:
        raise FileNotFoundError(f"no stamped {dataset} file under {path}")
    newest = snapshot_stamp(F.col("_metadata.file_path")) == max(stamps)
    return with_input_order(records.where(newest))


def flatten(records: DataFrame, dataset: str) -> DataFrame:
    """Fixed list of nested fields under flat names; for jobs the level is the
    name of the first level, which must be there."""
    out = []
    for source, name in FLAT_FIELDS[dataset]:
        c = first_name(F.col(source), strict=True) if name == "level" else F.col(source)
        out.append(c.alias(name))
    if ORDER in records.columns:
        out.append(F.col(ORDER))
    return records.select(*out)


def snapshot_stamp(name: Column) -> Column:
    """Time stamp `yyyyMMdd_HHmmss` in a file or folder name, NULL without."""
    return F.nullif(F.regexp_extract(name, STAMP_PATTERN, 1), F.lit(""))


def latest_snapshot(df: DataFrame, stamp: Column) -> DataFrame:
    """Rows of the newest snapshot. The newest stamp is a scalar subquery, so the
    rows are filtered as they are scanned. No stamp at all fails the job."""
    newest = df.agg(F.max(stamp).alias("newest"))
    checked = newest.select(
        F.when(F.col("newest").isNull(), F.raise_error(F.lit("no snapshot found")).cast("string"))
        .otherwise(F.col("newest").cast("string"))
    )
    return df.where(stamp.cast("string") == checked.scalar())


def write_snapshot(df: DataFrame, path: str, stamp: str) -> str:
    """Write records as JSON lines into a folder named by the stamp."""
    target = f"{path.rstrip('/')}/snapshot_{stamp}"
    df.write.mode("errorifexists").json(target)
    return target


def tag_origin(df: DataFrame, country: str, company: Column) -> DataFrame:
    """Record which query a fetched record came from."""
    return df.withColumns({"_country": F.lit(country), "_company_query": company})


def company_names(df: DataFrame, name: Column) -> DataFrame:
    """Distinct trimmed names that are not empty, sorted."""
    return (
        df.select(strip(name).alias("company_name"))
        .where(F.col("company_name") != "")
        .distinct()
        .orderBy("company_name")
    )
