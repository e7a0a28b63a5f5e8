"""Normalized layer: entities and bridges.

Each function returns the rows a load has to append; `existing` is the table as
it stands. Loading the same input again appends nothing.

Choices where the source rules leave the result open or depend on arrival order:
of several batch rows with one key the one with the smallest other columns is
taken, and NULL key parts count as equal, so rows with a NULL part are not
inserted again by every run.
"""

from __future__ import annotations

from pyspark.sql import DataFrame
from pyspark.sql import functions as F

from jobgrain.functions.text import has_text
from jobgrain.operators.joins import folded, lookup, trimmed
from jobgrain.operators.keys import insert_if_absent, next_after, with_ids
from jobgrain.operators.rows import one_per_key

PLACE = ["city", "subdivision_code", "country_code"]
PLACE_PAIRS = [
    ("location_city", "city"),
    ("location_state", "subdivision_code"),
    ("location_country", "country_code"),
]


def _numbered(rows: DataFrame, existing: DataFrame, keys: list[str]) -> DataFrame:
    return with_ids(rows, keys, "id", next_after(existing, "id"))


def _names(values: DataFrame, column: str, existing: DataFrame) -> DataFrame:
    new = insert_if_absent(values.distinct(), existing, [column])
    return _numbered(new, existing, [column])


def industries(raw_companies: DataFrame, existing: DataFrame) -> DataFrame:
    """Industry names that hold text, stored as they are written."""
    name = F.col("industry_name")
    return _names(raw_companies.where(has_text(name)).select(name.alias("name")), "name", existing)


def categories(raw_jobs: DataFrame, existing: DataFrame) -> DataFrame:
    """Trimmed category names of jobs (not of salaries)."""
    name = F.col("categories")
    return _names(
        raw_jobs.where(has_text(name)).select(F.trim(name).alias("name")), "name", existing
    )


def levels(raw_jobs: DataFrame, raw_salaries: DataFrame, existing: DataFrame) -> DataFrame:
    """Trimmed level names of jobs and salaries."""
    both = raw_jobs.select("level").unionByName(raw_salaries.select("level"))
    level = F.col("level")
    return _names(both.where(has_text(level)).select(F.trim(level).alias("level")), "level", existing)


def locations(
    raw_companies: DataFrame, raw_jobs: DataFrame, raw_salaries: DataFrame, existing: DataFrame
) -> DataFrame:
    """Distinct places with a city, from all three raw tables."""
    place = [F.col(source).alias(name) for source, name in PLACE_PAIRS]
    every = (
        raw_companies.select(*place)
        .unionByName(raw_jobs.select(*place))
        .unionByName(raw_salaries.select(*place))
    )
    batch = every.where(F.col("city") != "").distinct()
    return _numbered(insert_if_absent(batch, existing, PLACE), existing, PLACE)


def companies(raw_companies: DataFrame, existing: DataFrame) -> DataFrame:
    """One row per company id."""
    batch = raw_companies.select(
        F.col("company_id").alias("id"),
        "description",
        F.col("company_name").alias("name"),
        F.col("publication_date").cast("timestamp_ntz").alias("publication_date"),
        "size",
    )
    return insert_if_absent(batch, existing, ["id"])


def companies_industries(
    raw_companies: DataFrame, industries: DataFrame, existing: DataFrame
) -> DataFrame:
    """Company and industry pairs, reduced to distinct pairs before the join."""
    pairs = raw_companies.select("company_id", "industry_name").where(
        ~F.col("industry_name").isin("", "None")
    )
    linked = lookup(
        pairs.distinct(), industries, [("industry_name", "name")], {"id": "industry_id"}
    )
    keys = ["company_id", "industry_id"]
    return insert_if_absent(linked.select(*keys), existing, keys)


def companies_locations(
    raw_companies: DataFrame,
    companies: DataFrame,
    locations: DataFrame,
    existing: DataFrame,
    null_safe: bool = False,
) -> DataFrame:
    """Company and place pairs. By default a place with no state or no country
    links to nothing; `null_safe` links it."""
    used = raw_companies.select("company_id", *[c for c, _ in PLACE_PAIRS]).distinct()
    known = lookup(used, companies, [("company_id", "id")], {})
    linked = lookup(known, locations, PLACE_PAIRS, {"id": "location_id"}, null_safe=null_safe)
    keys = ["company_id", "location_id"]
    return insert_if_absent(linked.select(*keys), existing, keys)


def jobs(
    raw_jobs: DataFrame,
    companies: DataFrame,
    levels: DataFrame,
    categories: DataFrame,
    existing: DataFrame,
) -> DataFrame:
    """One row per company, job name and time. The company and the level must be
    known; the category may be missing."""
    batch = raw_jobs.select(
        "company_id",
        F.col("job_name").alias("name"),
        "level",
        "categories",
        F.col("publication_date").cast("timestamp_ntz").alias("publication_date"),
    ).distinct()
    known = lookup(batch, companies, [("company_id", "id")], {})
    levelled = lookup(known, levels, [("level", "level")], {"id": "level_id"}, left_form=trimmed)
    filed = lookup(levelled, categories, [("categories", "name")], {"id": "category_id"}, "left")
    rows = filed.select("company_id", "name", "level_id", "category_id", "publication_date")
    keys = ["company_id", "name", "publication_date"]
    new = insert_if_absent(rows, existing, keys)
    return _numbered(new, existing, keys).select(
        "id", "company_id", "name", "level_id", "category_id", "publication_date"
    )


def jobs_locations(
    raw_jobs: DataFrame,
    jobs: DataFrame,
    locations: DataFrame,
    existing: DataFrame,
    null_safe: bool = False,
) -> DataFrame:
    """Job and place pairs; jobs are found by company, name and time. The small
    side, distinct places, is resolved first."""
    used = raw_jobs.where(F.col("location_city") != "").select(
        "company_id",
        "job_name",
        F.col("publication_date").cast("timestamp_ntz").alias("publication_date"),
        *[c for c, _ in PLACE_PAIRS],
    )
    placed = lookup(used, locations, PLACE_PAIRS, {"id": "location_id"}, null_safe=null_safe)
    linked = lookup(
        placed,
        jobs,
        [
            ("company_id", "company_id"),
            ("job_name", "name"),
            ("publication_date", "publication_date"),
        ],
        {"id": "job_id"},
    )
    keys = ["job_id", "location_id"]
    return insert_if_absent(linked.select(*keys), existing, keys)


def salaries(
    raw_salaries: DataFrame,
    companies: DataFrame,
    levels: DataFrame,
    categories: DataFrame,
    locations: DataFrame,
    existing: DataFrame,
    null_safe: bool = False,
) -> DataFrame:
    """Salaries of known companies (found by name, whatever the case) at known
    places; one row per company, place, title, level and category. The salaries are
    reduced to one per such key by folded name before the companies are joined, as all
    companies of one name share them. `load_batch` counts the loads and says which of
    several salaries is newer."""
    match = ["company_name", "title", "level", "categories", *[c for c, _ in PLACE_PAIRS]]
    batch = raw_salaries.where(F.col("location_city") != "").select(
        folded(F.col("company_name")).alias("company_name"),
        F.trim("adz_job_name").alias("title"),
        F.trim("level").alias("level"),
        F.trim("categories").alias("categories"),
        *[c for c, _ in PLACE_PAIRS],
        "salary_min",
        "salary_max",
    )
    one = one_per_key(batch, match)
    placed = lookup(one, locations, PLACE_PAIRS, {"id": "location_id"}, null_safe=null_safe)
    levelled = lookup(placed, levels, [("level", "level")], {"id": "level_id"}, "left")
    filed = lookup(levelled, categories, [("categories", "name")], {"id": "category_id"}, "left")
    owned = lookup(
        filed, companies, [("company_name", "name")], {"id": "company_id"}, right_form=folded
    )
    keys = ["company_id", "location_id", "title", "level_id", "category_id"]
    rows = owned.select(*keys, "salary_min", "salary_max")
    new = insert_if_absent(rows, existing, keys).withColumn(
        "load_batch", next_after(existing, "load_batch") + 1
    )
    return _numbered(new, existing, keys).select(
        "id", "company_id", "location_id", "title", "salary_min", "salary_max",
        "level_id", "category_id", "load_batch",
    )
