"""Explicit schemas. Nothing is inferred from data."""

from __future__ import annotations

# --- landing: one JSON array of nested records per file -----------------------
# Ids and numbers are read as text; the cleaning rules decide what is valid.

NAMED_LIST = "ARRAY<STRUCT<name: STRING>>"

JOBS_LANDING = (
    "id STRING, name STRING, publication_date STRING, "
    "company STRUCT<id: STRING, name: STRING>, "
    f"levels {NAMED_LIST}, locations {NAMED_LIST}, categories {NAMED_LIST}"
)

COMPANIES_LANDING = (
    "id STRING, name STRING, description STRING, publication_date STRING, "
    f"size STRUCT<name: STRING>, locations {NAMED_LIST}, industries {NAMED_LIST}"
)

SALARIES_LANDING = (
    "id STRING, title STRING, created STRING, "
    "company STRUCT<display_name: STRING>, category STRUCT<label: STRING, tag: STRING>, "
    "location STRUCT<display_name: STRING, area: ARRAY<STRING>>, "
    "salary_min STRING, salary_max STRING, salary_is_predicted STRING, "
    "_country STRING, _company_query STRING"
)

LANDING = {
    "jobs": JOBS_LANDING,
    "companies": COMPANIES_LANDING,
    "salaries": SALARIES_LANDING,
}

# --- flattened records: (nested source field, flat column), in output order ----

FLAT_FIELDS = {
    "jobs": [
        ("id", "job_id"),
        ("company.id", "company_id"),
        ("name", "job_name"),
        ("levels", "level"),
        ("publication_date", "publication_date"),
        ("locations", "locations"),
        ("categories", "categories"),
    ],
    "companies": [
        ("id", "company_id"),
        ("name", "company_name"),
        ("description", "description"),
        ("publication_date", "publication_date"),
        ("size.name", "size"),
        ("locations", "locations"),
        ("industries", "industries"),
    ],
    "salaries": [
        ("id", "adz_job_id"),
        ("company.display_name", "company_name"),
        ("title", "adz_job_name"),
        ("category.label", "adz_category"),
        ("created", "publication_date"),
        ("location.area", "locations"),
        ("salary_min", "salary_min"),
        ("salary_max", "salary_max"),
        ("salary_is_predicted", "salary_is_predicted"),
    ],
}

# --- cleaned records -----------------------------------------------------------

PLACE = "STRUCT<country_code: STRING, subdivision_code: STRING, city: STRING>"

CLEANED = {
    "jobs": (
        "job_id BIGINT, company_id BIGINT, job_name STRING, level STRING, "
        f"publication_date TIMESTAMP, locations ARRAY<{PLACE}>, categories STRING"
    ),
    "companies": (
        "company_id BIGINT, company_name STRING, description STRING, "
        f"publication_date TIMESTAMP, size STRING, locations ARRAY<{PLACE}>, "
        f"industries {NAMED_LIST}"
    ),
    "salaries": (
        "adz_job_id BIGINT, company_name STRING, adz_job_name STRING, "
        f"adz_category STRING, publication_date TIMESTAMP, locations ARRAY<{PLACE}>, "
        "salary_min DOUBLE, salary_max DOUBLE, salary_is_predicted INT, "
        "categories STRING, level STRING"
    ),
}

# --- raw layer: one row per exploded list element --------------------------------

RAW = {
    "companies": (
        "company_id BIGINT, company_name STRING, description STRING, "
        "publication_date TIMESTAMP, size STRING, location_city STRING, "
        "location_state STRING, location_country STRING, industry_name STRING"
    ),
    "jobs": (
        "job_id BIGINT, company_id BIGINT, job_name STRING, level STRING, "
        "publication_date TIMESTAMP, location_city STRING, location_state STRING, "
        "location_country STRING, categories STRING"
    ),
    "salaries": (
        "adz_job_id BIGINT, company_name STRING, adz_job_name STRING, "
        "adz_category STRING, publication_date TIMESTAMP, location_city STRING, "
        "location_state STRING, location_country STRING, salary_min DOUBLE, "
        "salary_max DOUBLE, salary_is_predicted INT, categories STRING, level STRING"
    ),
}

# --- normalized layer --------------------------------------------------------------

NORM = {
    "industries": "id BIGINT, name STRING",
    "categories": "id BIGINT, name STRING",
    "levels": "id BIGINT, level STRING",
    "locations": (
        "id BIGINT, city STRING, subdivision_code STRING, country_code STRING"
    ),
    "companies": (
        "id BIGINT, description STRING, name STRING, "
        "publication_date TIMESTAMP_NTZ, size STRING"
    ),
    "companies_industries": "company_id BIGINT, industry_id BIGINT",
    "companies_locations": "company_id BIGINT, location_id BIGINT",
    "jobs": (
        "id BIGINT, company_id BIGINT, name STRING, level_id BIGINT, "
        "category_id BIGINT, publication_date TIMESTAMP_NTZ"
    ),
    "jobs_locations": "job_id BIGINT, location_id BIGINT",
    "salaries": (
        "id BIGINT, company_id BIGINT, location_id BIGINT, title STRING, "
        "salary_min DOUBLE, salary_max DOUBLE, level_id BIGINT, category_id BIGINT, "
        "load_batch BIGINT"
    ),
}

# --- star layer ----------------------------------------------------------------------

STAR = {
    "dim_companies": (
        "company_key BIGINT, company_id BIGINT, name STRING, description STRING, "
        "size STRING, industry STRING"
    ),
    "dim_jobs": "job_key BIGINT, job_id BIGINT, name STRING",
    "dim_levels": "level_key BIGINT, level_id BIGINT, level STRING",
    "dim_categories": "category_key BIGINT, category_id BIGINT, name STRING",
    "dim_locations": (
        "location_key BIGINT, city STRING, state STRING, country STRING"
    ),
    "dim_date": "date_key BIGINT, full_date DATE, day INT, month INT, year INT",
    "fact_job_postings": (
        "fact_id BIGINT, job_key BIGINT, company_key BIGINT, location_key BIGINT, "
        "date_key BIGINT, category_key BIGINT, level_key BIGINT, "
        "salary_min DOUBLE, salary_max DOUBLE, year INT, month INT"
    ),
}

# Keys checked after a load: unique keys and (column, parent table, parent column).

UNIQUE_KEYS = {
    "norm.industries": ["name"],
    "norm.categories": ["name"],
    "norm.levels": ["level"],
    "norm.locations": ["city", "subdivision_code", "country_code"],
    "norm.companies": ["id"],
    "norm.companies_industries": ["company_id", "industry_id"],
    "norm.companies_locations": ["company_id", "location_id"],
    "norm.jobs": ["company_id", "name", "publication_date"],
    "norm.jobs_locations": ["job_id", "location_id"],
    "norm.salaries": ["company_id", "location_id", "title", "level_id", "category_id"],
    "star.dim_companies": ["company_id"],
    "star.dim_jobs": ["job_id"],
    "star.dim_levels": ["level_id"],
    "star.dim_categories": ["category_id"],
    "star.dim_locations": ["city", "state", "country"],
    "star.dim_date": ["full_date"],
}

FOREIGN_KEYS = {
    "norm.companies_industries": [
        ("company_id", "norm.companies", "id"),
        ("industry_id", "norm.industries", "id"),
    ],
    "norm.companies_locations": [
        ("company_id", "norm.companies", "id"),
        ("location_id", "norm.locations", "id"),
    ],
    "norm.jobs": [
        ("company_id", "norm.companies", "id"),
        ("level_id", "norm.levels", "id"),
        ("category_id", "norm.categories", "id"),
    ],
    "norm.jobs_locations": [
        ("job_id", "norm.jobs", "id"),
        ("location_id", "norm.locations", "id"),
    ],
    "norm.salaries": [
        ("company_id", "norm.companies", "id"),
        ("location_id", "norm.locations", "id"),
    ],
    "star.fact_job_postings": [
        ("job_key", "star.dim_jobs", "job_key"),
        ("company_key", "star.dim_companies", "company_key"),
        ("location_key", "star.dim_locations", "location_key"),
        ("date_key", "star.dim_date", "date_key"),
        ("category_key", "star.dim_categories", "category_key"),
        ("level_key", "star.dim_levels", "level_key"),
    ],
}
