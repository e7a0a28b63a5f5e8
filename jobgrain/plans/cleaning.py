"""From flattened landing records to cleaned tables."""

from __future__ import annotations

from collections.abc import Callable

from pyspark.sql import Column, DataFrame
from pyspark.sql import functions as F

from jobgrain.functions.geo import places_from_area, places_from_names
from jobgrain.functions.text import (
    blank_to_null,
    collapse_spaces,
    first_name,
    lenient_id,
    normalize_title,
    parse_number,
    parse_timestamp,
    strict_id,
    strip,
)
from jobgrain.functions.titles import with_labels
from jobgrain.operators.rows import ORDER, blanks_to_null, keep_first, require

ID_COLUMNS = {
    "jobs": ["job_id", "company_id"],
    "companies": ["company_id"],
    "salaries": ["adz_job_id"],
}


def _typed_ids(df: DataFrame, dataset: str, on_bad: str) -> DataFrame:
    """Ids as 64-bit numbers. A bad id fails the job, or (`on_bad="quarantine"`)
    its row is left out here and returned by `rejected`."""
    if on_bad == "fail":
        return df.withColumns({c: strict_id(F.col(c)) for c in ID_COLUMNS[dataset]})
    if on_bad != "quarantine":
        raise ValueError(f"on_bad must be 'fail' or 'quarantine', not {on_bad!r}")
    return df.withColumns({c: lenient_id(F.col(c)) for c in ID_COLUMNS[dataset]}).dropna(
        how="any", subset=ID_COLUMNS[dataset]
    )


def rejected(df: DataFrame, dataset: str) -> DataFrame:
    """Flattened rows that have a missing or malformed id."""
    bad = F.lit(False)
    for c in ID_COLUMNS[dataset]:
        bad = bad | lenient_id(F.col(c)).isNull()
    return df.where(bad)


def finish(df: DataFrame, required: list[str]) -> DataFrame:
    """Common last step: blanks and empty lists to NULL, required columns."""
    return require(blanks_to_null(df), required)


def clean_jobs(df: DataFrame, on_bad: str = "fail", order: Column | str = ORDER) -> DataFrame:
    """First record per job; first category; places from free text. A job without
    any place is dropped."""
    first = keep_first(_typed_ids(df, "jobs", on_bad), ["job_id"], order)
    cleaned = first.select(
        "job_id",
        "company_id",
        strip(F.col("job_name")).alias("job_name"),
        "level",
        parse_timestamp(F.col("publication_date")).alias("publication_date"),
        places_from_names(F.col("locations")).alias("locations"),
        first_name(F.col("categories")).alias("categories"),
    )
    return finish(cleaned, ["locations"])


def clean_companies(
    df: DataFrame, on_bad: str = "fail", order: Column | str = ORDER
) -> DataFrame:
    """First record per company; description on one line; places from free text."""
    first = keep_first(_typed_ids(df, "companies", on_bad), ["company_id"], order)
    cleaned = first.select(
        "company_id",
        "company_name",
        blank_to_null(collapse_spaces(F.col("description"))).alias("description"),
        parse_timestamp(F.col("publication_date")).alias("publication_date"),
        "size",
        places_from_names(F.col("locations")).alias("locations"),
        "industries",
    )
    return finish(cleaned, [])


def clean_salaries(
    df: DataFrame, on_bad: str = "fail", order: Column | str = ORDER
) -> DataFrame:
    """First record per advertisement; category and level from the title; place
    from the area path. Both salary bounds and the company name are required.
    A missing title gives no category and no level."""
    first = keep_first(_typed_ids(df, "salaries", on_bad), ["adz_job_id"], order)
    titled = first.withColumn("_title", normalize_title(F.col("adz_job_name")))
    cleaned = with_labels(titled, "_title", "categories", "level").select(
        "adz_job_id",
        "company_name",
        "adz_job_name",
        "adz_category",
        parse_timestamp(F.col("publication_date")).alias("publication_date"),
        places_from_area(F.col("locations")).alias("locations"),
        parse_number(F.col("salary_min")).alias("salary_min"),
        parse_number(F.col("salary_max")).alias("salary_max"),
        F.col("salary_is_predicted").try_cast("int").alias("salary_is_predicted"),
        "categories",
        "level",
    )
    return finish(cleaned, ["salary_min", "salary_max", "company_name"])


CLEANERS: dict[str, Callable[..., DataFrame]] = {
    "jobs": clean_jobs,
    "companies": clean_companies,
    "salaries": clean_salaries,
}


def clean(df: DataFrame, dataset: str, on_bad: str = "fail") -> DataFrame:
    """Clean a flattened dataset by its name."""
    if dataset not in CLEANERS:
        raise ValueError(f"unknown dataset {dataset!r}; known: {sorted(CLEANERS)}")
    return CLEANERS[dataset](df, on_bad)
