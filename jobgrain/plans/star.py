"""Star layer: dimensions and the fact table of job postings."""

from __future__ import annotations

from pyspark.sql import Column, DataFrame
from pyspark.sql import functions as F

from jobgrain.operators.joins import folded, lookup
from jobgrain.operators.keys import insert_if_absent, next_after, with_ids
from jobgrain.operators.rows import latest_per

FACT_KEYS = [
    "job_key", "company_key", "location_key", "date_key", "category_key", "level_key",
]


_PLACE = ["city", "subdivision_code", "country_code"]


def _keyed(rows: DataFrame, existing: DataFrame, keys: list[str], key: str) -> DataFrame:
    new = insert_if_absent(rows, existing, keys)
    return with_ids(new, keys, key, next_after(existing, key)).select(key, *rows.columns)


def dim_companies(
    companies: DataFrame,
    companies_industries: DataFrame,
    industries: DataFrame,
    existing: DataFrame,
) -> DataFrame:
    """One row per company. A company in several industries shows the first by
    name (the source rule keeps any one). The industry is reduced to one per
    company before the companies are joined."""
    named = lookup(
        companies_industries, industries, [("industry_id", "id")], {"name": "industry"}
    )
    one = named.groupBy("company_id").agg(F.min("industry").alias("industry"))
    rows = lookup(
        companies.where("id IS NOT NULL").withColumnRenamed("id", "company_id"),
        one, [("company_id", "company_id")], {"industry": "industry"}, "left",
    ).select("company_id", "name", "description", "size", "industry")
    return _keyed(rows, existing, ["company_id"], "company_key")


def dim_jobs(jobs: DataFrame, existing: DataFrame) -> DataFrame:
    rows = jobs.select(F.col("id").alias("job_id"), "name")
    return _keyed(rows, existing, ["job_id"], "job_key")


def dim_levels(levels: DataFrame, existing: DataFrame) -> DataFrame:
    rows = levels.select(F.col("id").alias("level_id"), "level")
    return _keyed(rows, existing, ["level_id"], "level_key")


def dim_categories(categories: DataFrame, existing: DataFrame) -> DataFrame:
    rows = categories.select(F.col("id").alias("category_id"), "name")
    return _keyed(rows, existing, ["category_id"], "category_key")


def dim_locations(locations: DataFrame, existing: DataFrame) -> DataFrame:
    """Distinct places with a city, told apart by exact text."""
    rows = locations.where("city IS NOT NULL").select(
        "city",
        F.col("subdivision_code").alias("state"),
        F.col("country_code").alias("country"),
    )
    return _keyed(rows, existing, ["city", "state", "country"], "location_key")


def date_parts(moment: Column) -> list[Column]:
    day = F.to_date(moment)
    return [
        day.alias("full_date"),
        F.dayofmonth(day).alias("day"),
        F.month(day).alias("month"),
        F.year(day).alias("year"),
    ]


def dim_date(moments: list[DataFrame], existing: DataFrame) -> DataFrame:
    """Days on which anything was published; `moments` are tables with a
    `publication_date` (jobs alone, or jobs and companies)."""
    every = None
    for df in moments:
        days = df.select(*date_parts(F.col("publication_date"))).where("full_date IS NOT NULL")
        every = days if every is None else every.unionByName(days)
    return _keyed(every.distinct(), existing, ["full_date"], "date_key")


def location_keys(
    locations: DataFrame, dim_locations: DataFrame, null_safe: bool = False
) -> DataFrame:
    """Which dimension rows each place has, compared without regard to case.

    By default a place with a missing part has none. Two dimension rows that
    differ in case only both match, so such a place has two.
    """
    return lookup(
        locations, dim_locations,
        [("city", "city"), ("subdivision_code", "state"), ("country_code", "country")],
        {"location_key": "location_key"},
        left_form=folded, right_form=folded, null_safe=null_safe,
    ).select(F.col("id").alias("location_id"), "location_key")


def newest_salaries(salaries: DataFrame) -> DataFrame:
    """The newest salary per company, place, level and category."""
    match = ["company_id", "location_id", "level_id", "category_id"]
    return latest_per(
        salaries.dropna(how="any", subset=match),
        match, ["load_batch", "title", "id"], ["salary_min", "salary_max"],
    )


def touched_jobs(
    norm: dict[str, DataFrame], added: dict[str, DataFrame], null_safe: bool = False
) -> DataFrame:
    """Jobs that may have new fact rows after a load: new ones, those with a new place,
    and those at a place of which the load brought another spelling."""
    spelled = lookup(
        norm["locations"],
        added["locations"].select(*[F.col(c).alias(f"new_{c}") for c in _PLACE]).distinct(),
        [(c, f"new_{c}") for c in _PLACE],
        {},
        left_form=folded, right_form=folded, null_safe=null_safe,
    ).select("id").distinct()
    there = norm["jobs_locations"].join(spelled, F.col("location_id") == F.col("id"), "left_semi")
    ids = (
        added["jobs"].select("id")
        .union(added["jobs_locations"].select("job_id"))
        .union(there.select("job_id"))
        .distinct()
        .withColumnRenamed("id", "touched")
    )
    return norm["jobs"].join(ids, F.col("id") == F.col("touched"), "left_semi")


def months_of(jobs: DataFrame) -> list[tuple[int, int]]:
    """Years and months in which any of the jobs was published, a few hundred at most."""
    day = F.to_date("publication_date")
    months = jobs.where(day.isNotNull()).select(F.year(day), F.month(day)).distinct()
    return sorted(map(tuple, months.collect()))


def facts_of_months(facts: DataFrame, months: list[tuple[int, int]]) -> DataFrame:
    """Facts of some months. They become a filter on the partitions, so other months are
    not read."""
    listed = [12 * year + month for year, month in months]
    return facts.where((F.col("year") * 12 + F.col("month")).isin(listed))


def maintained_facts(known: DataFrame, new: DataFrame) -> DataFrame:
    """The facts of touched months after a load: the known ones and the new ones, without
    the place-less rows of jobs that have a place by now, as one load of all data would
    give none. (The source rule only appends, so such a row stays for ever and counts for
    an empty place.) `new` is read twice."""
    both = known.unionByName(new)
    placed = both.where("location_key IS NOT NULL").select(F.col("job_key").alias("placed_job"))
    empty = F.col("location_key").isNull() & (F.col("job_key") == F.col("placed_job"))
    return both.join(placed.distinct(), empty, "left_anti")


def fact_job_postings(
    norm: dict[str, DataFrame],
    dims: dict[str, DataFrame],
    existing: DataFrame,
    null_safe: bool = False,
    numbered: DataFrame | None = None,
) -> DataFrame:
    """Fact rows to append: one per job and place, with the newest salary of the
    same company, place, level and category. A job without places has one row.

    A row already there is left as it is, so a salary that comes later does not
    change it. Duplicates inside a load are reduced to one, preferring a row
    that has a salary. `existing` needs to hold the rows that the jobs may already
    have; ids go on after the largest in `numbered` (all rows; `existing` if left out).
    """
    jobs = norm["jobs"].withColumn("full_date", F.to_date("publication_date"))
    for dim, pairs, take in [
        ("dim_levels", [("level_id", "level_id")], {"level_key": "level_key"}),
        ("dim_categories", [("category_id", "category_id")], {"category_key": "category_key"}),
        (
            "dim_date",
            [("full_date", "full_date")],
            {"date_key": "date_key", "year": "year", "month": "month"},
        ),
        ("dim_companies", [("company_id", "company_id")], {"company_key": "company_key"}),
        ("dim_jobs", [("id", "job_id")], {"job_key": "job_key"}),
    ]:
        jobs = lookup(jobs, dims[dim], pairs, take)
    placed = lookup(
        jobs, norm["jobs_locations"], [("id", "job_id")], {"location_id": "location_id"}, "left"
    )
    keyed = lookup(
        placed,
        location_keys(norm["locations"], dims["dim_locations"], null_safe),
        [("location_id", "location_id")], {"location_key": "location_key"}, "left",
    )
    match = ["company_id", "location_id", "level_id", "category_id"]
    # Postings of one large employer may be many rows of one key. Spark splits them
    # only if the other side is not itself grouped by the key, hence the shuffle.
    newest = newest_salaries(norm["salaries"]).hint("rebalance")
    paid = lookup(
        keyed, newest, [(c, c) for c in match],
        {"salary_min": "salary_min", "salary_max": "salary_max"}, "left",
    )
    rows = paid.select(*FACT_KEYS, "salary_min", "salary_max", "year", "month")
    new = insert_if_absent(rows, existing, FACT_KEYS, prefer="max")
    numbered = existing if numbered is None else numbered
    return with_ids(new, FACT_KEYS, "fact_id", next_after(numbered, "fact_id"))
