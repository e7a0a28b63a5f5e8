"""Queries over the given tables: every operator of the package, each with the
SQL that must give the same rows."""

from __future__ import annotations

from pyspark.sql import functions as F

from workload import cleaning, keys, layers, oldlayers, postings, quality, sources, streams

_PARTS = (postings, cleaning, keys, layers, oldlayers, sources, quality, streams)


# Queries whose results hold dates. They are shown as text, which is the same in
# every engine and client.
_DATES = {
    "surrogate_ids": "day",
    "dim_date": "full_date",
    "dim_date_several_sources": "full_date",
    "star_dim_date": "full_date",
    "old_dim_date": "full_date",
    **dict.fromkeys(
        [
            "raw_companies", "raw_jobs", "raw_salaries", "norm_companies", "norm_jobs", "norm_jobs_locations",
            "star_dim_jobs", "star_fact", "old_companies", "old_jobs", "old_fact", "old_fact_bounds", "processed_csv",
        ],
        "publication_date",
    ),
}


def _as_text(fn, column):
    return lambda spark, sf_dir: fn(spark, sf_dir).withColumn(column, F.col(column).cast("string"))


def all_queries() -> dict:
    found = {name: fn for part in _PARTS for name, fn in part.QUERIES.items()}
    return found | {name: _as_text(found[name], column) for name, column in _DATES.items()}


def all_sql() -> dict[str, str]:
    found = {name: sql for part in _PARTS for name, sql in part.SQL.items()}
    return found | {
        name: f"SELECT * REPLACE (CAST({c} AS VARCHAR) AS {c}) FROM ({found[name]})"
        for name, c in _DATES.items()
    }
