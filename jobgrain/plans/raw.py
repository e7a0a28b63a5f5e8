"""Raw layer: cleaned tables with one row per list element."""

from __future__ import annotations

from pyspark.sql import Column, DataFrame
from pyspark.sql import functions as F

from jobgrain.functions.text import blank_to_null
from jobgrain.operators.lists import list_product


def _place_columns() -> list[Column]:
    place = F.col("_place")
    return [
        place["city"].alias("location_city"),
        blank_to_null(place["subdivision_code"]).alias("location_state"),
        blank_to_null(place["country_code"]).alias("location_country"),
    ]


def raw_companies(companies: DataFrame) -> DataFrame:
    """One row per place and industry of a company."""
    rows = list_product(companies, {"locations": "_place", "industries": "_industry"})
    return rows.select(
        "company_id",
        "company_name",
        "description",
        "publication_date",
        "size",
        *_place_columns(),
        F.col("_industry")["name"].alias("industry_name"),
    )


def raw_jobs(jobs: DataFrame) -> DataFrame:
    """One row per place of a job."""
    return list_product(jobs, {"locations": "_place"}).select(
        "job_id",
        "company_id",
        "job_name",
        "level",
        "publication_date",
        *_place_columns(),
        "categories",
    )


def raw_salaries(salaries: DataFrame) -> DataFrame:
    """One row per place of an advertisement."""
    return list_product(salaries, {"locations": "_place"}).select(
        "adz_job_id",
        "company_name",
        "adz_job_name",
        "adz_category",
        "publication_date",
        *_place_columns(),
        "salary_min",
        "salary_max",
        "salary_is_predicted",
        "categories",
        "level",
    )


BUILDERS = {"companies": raw_companies, "jobs": raw_jobs, "salaries": raw_salaries}
