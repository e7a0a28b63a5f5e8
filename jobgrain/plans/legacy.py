"""The older form of both layers, for raw tables that hold lists as text.

Source ids stay the ids of companies and jobs; places, industries and categories
are read out of text; salaries need a place and one bound but no known company;
the fact holds only postings with a salary.
"""

from __future__ import annotations

from collections.abc import Callable

from pyspark.sql import Column, DataFrame
from pyspark.sql import functions as F

from jobgrain.functions.listtext import (
    location_parts,
    name_parts,
    place_of,
    places_in,
    value_of_key,
)
from jobgrain.operators.joins import folded, lookup
from jobgrain.operators.keys import bucket_part, insert_if_absent, with_ids
from jobgrain.operators.lists import explode_parts
from jobgrain.plans.star import date_parts

PLACE = ["city", "subdivision_code", "country_code"]


def companies(raw: DataFrame) -> DataFrame:
    return raw.select(
        F.col("company_id").alias("id"),
        "description",
        F.col("company_name").alias("name"),
        F.col("publication_date").cast("timestamp_ntz").alias("publication_date"),
        "size",
    ).distinct()


def jobs(raw: DataFrame, companies: DataFrame) -> DataFrame:
    """Jobs of known companies. The ids are shuffled once more, so that Spark can
    split the jobs of one company."""
    batch = raw.select(
        F.col("job_id").alias("id"),
        "company_id",
        F.col("job_name").alias("name"),
        "level",
        F.col("publication_date").cast("timestamp_ntz").alias("publication_date"),
    ).distinct()
    known = companies.select("id").distinct().hint("rebalance")
    return lookup(batch, known, [("company_id", "id")], {})


def names(raw: DataFrame, text: str) -> DataFrame:
    """Distinct names in a text list, with ids."""
    found = raw.select(F.explode(name_parts(F.col(text))).alias("name")).distinct()
    return with_ids(found, ["name"], "id")


def name_bridge(
    raw: DataFrame, text: str, raw_name: str, parents: DataFrame, names: DataFrame,
    parent_id: str, name_id: str,
) -> DataFrame:
    """Parent and name pairs. Parents are found by their own name, so all parents
    of one name share its list. The list is reduced to distinct (parent name,
    list name) pairs before the parents are joined."""
    pairs = explode_parts(raw, name_parts(F.col(text)), "_part", [raw_name])
    known = lookup(pairs, names, [("_part", "name")], {"id": name_id})
    linked = lookup(known, parents, [(raw_name, "name")], {"id": parent_id})
    return linked.select(parent_id, name_id).distinct()


def _places(texts: DataFrame, split: bool) -> DataFrame:
    """The places of distinct location texts, and the other columns. The older rule takes a
    text as one place, of which later parts hide earlier ones; with `split` each of several
    places counts."""
    rest = [c for c in texts.columns if c != "locations"]
    c = F.col("locations")
    if split:
        return texts.select(*rest, F.explode(places_in(c)).alias("_place")).select(*rest, "_place.*")
    parts = texts.select(*rest, "locations", F.explode(location_parts(c)).alias("_part"))
    return parts.select(*rest, *[v.alias(k) for k, v in place_of(c, F.col("_part")).items()])


def locations(raws: list[DataFrame], split: bool = False) -> DataFrame:
    """Distinct places with a city in the location texts of several tables."""
    every = None
    for raw in raws:
        text = raw.select("locations")
        every = text if every is None else every.unionByName(text)
    c = F.col("locations")
    every = every.distinct()
    # Exploded, so that only distinct texts are parsed: a filter on a plain expression
    # would be moved below the distinct and parse every row.
    whole = F.explode(F.array(F.struct(*[v.alias(k) for k, v in place_of(c, c).items()])))
    parsed = _places(every, True) if split else every.select(whole.alias("_place")).select("_place.*")
    return with_ids(parsed.where(F.col("city") != "").distinct(), PLACE, "id")


def location_bridge(
    raw: DataFrame,
    raw_name: str,
    parents: DataFrame,
    locations: DataFrame,
    parent_id: str,
    split: bool = False,
) -> DataFrame:
    """Parent and place pairs; a missing part matches a missing part."""
    parsed = _places(raw.select(raw_name, "locations").distinct(), split)
    used = parsed.where(F.col("city") != "").distinct()
    placed = lookup(
        used, locations, [(c, c) for c in PLACE], {"id": "location_id"}, null_safe=True
    )
    linked = lookup(
        placed.select(raw_name, "location_id"), parents, [(raw_name, "name")], {"id": parent_id}
    )
    return linked.select(parent_id, "location_id").distinct()


def salaries(raw: DataFrame, companies: DataFrame, locations: DataFrame) -> DataFrame:
    """Salaries with a city and at least one bound; company and place may be
    unknown. Salaries and companies are reduced to distinct ones by folded name before
    they meet, as all companies of one name share its salaries."""
    bounds = ["salary_min", "salary_max"]
    batch = (
        raw.where(F.col("salary_min").isNotNull() | F.col("salary_max").isNotNull())
        .select(
            folded(F.col("company_name")).alias("company_name"),
            F.trim("adz_job_name").alias("title"),
            *bounds,
            "locations",
        )
        .distinct()
    )
    c = F.col("locations")
    place = F.struct(*[value_of_key(c, k).alias(k) for k in PLACE])
    # exploded, so that the place is parsed after the distinct
    parsed = batch.select("company_name", "title", *bounds, F.explode(F.array(place)).alias("_place"))
    parsed = parsed.select("company_name", "title", *bounds, "_place.*").where(F.col("city") != "")
    placed = lookup(
        parsed, locations, [(k, k) for k in PLACE], {"id": "location_id"}, "left", null_safe=True
    )
    known = companies.select(folded(F.col("name")).alias("name"), "id").distinct()
    owned = lookup(
        placed.select("company_name", "location_id", "title", *bounds).distinct(),
        known, [("company_name", "name")], {"id": "company_id"}, "left",
    )
    keys = ["company_id", "location_id", "title", "salary_min", "salary_max"]
    return with_ids(owned.select(*keys).distinct(), keys, "id")


def dim_companies(
    companies: DataFrame, companies_industries: DataFrame, industries: DataFrame
) -> DataFrame:
    """One row per company and industry."""
    named = lookup(
        companies_industries, industries, [("industry_id", "id")], {"name": "industry"}, "left"
    )
    rows = (
        lookup(
            companies.where("name IS NOT NULL"), named, [("id", "company_id")],
            {"industry": "industry"}, "left",
        )
        .select(F.col("id").alias("company_id"), "name", "description", "size", "industry")
        .distinct()
    )
    return with_ids(rows, ["company_id", "industry"], "company_key")


def dim_jobs(
    jobs: DataFrame, jobs_categories: DataFrame, categories: DataFrame,
    part: int = 0, parts: int = 1,
) -> DataFrame:
    """One row per job and category. With `parts`, one of so many parts of the rows, which
    can be written one after the other so that less is shuffled at a time."""
    named = lookup(
        jobs_categories, categories, [("category_id", "id")], {"name": "category"}, "left"
    )
    rows = (
        lookup(
            jobs.where("name IS NOT NULL"), named, [("id", "job_id")],
            {"category": "category"}, "left",
        )
        .select(F.col("id").alias("job_id"), "name", "level", "category")
        .distinct()
    )
    keys = ["job_id", "category"]
    if parts > 1:
        rows = rows.where(bucket_part(keys, part, parts))
    return with_ids(rows, keys, "job_key")


def dim_locations(locations: DataFrame) -> DataFrame:
    rows = locations.where("city IS NOT NULL").select(
        "city", F.col("subdivision_code").alias("state"), F.col("country_code").alias("country")
    )
    return with_ids(rows.distinct(), ["city", "state", "country"], "location_key")


def dim_date(jobs: DataFrame, companies: DataFrame) -> DataFrame:
    """Days of jobs and of companies."""
    moments = jobs.select("publication_date").unionByName(companies.select("publication_date"))
    days = moments.select(*date_parts(F.col("publication_date"))).where("full_date IS NOT NULL")
    return with_ids(days.distinct(), ["full_date"], "date_key")


def _mark(key: Column) -> Column:
    """One of 64 bits for a key."""
    bit = F.pmod(F.xxhash64(key), F.lit(64)).cast("int")
    return F.when(key.isNotNull(), F.call_function("shiftleft", F.lit(1).cast("bigint"), bit))


def fact_job_postings(
    norm: dict[str, DataFrame],
    dims: dict[str, DataFrame],
    every_salary: bool = False,
    keep: Callable[[str, DataFrame], DataFrame] | None = None,
) -> DataFrame:
    """Distinct postings with a salary: the lowest and highest bound that the company
    offers at the place of the job, one row per job and place.

    `every_salary` gives the older rule instead: a row for every distinct salary of
    the company there. Its rows grow with jobs times salaries of a company and place,
    so it is for small tables only.

    `keep(name, rows)` stores rows between the steps and reads them back, so that the
    shuffles of a step can go before the next.
    """
    keep = keep or (lambda _, rows: rows)
    jobs = norm["jobs"].withColumn("full_date", F.to_date("publication_date"))
    bounds = ["salary_min", "salary_max"]
    paid = (
        norm["salaries"]
        .where("salary_min IS NOT NULL OR salary_max IS NOT NULL")
        .select("company_id", "location_id", *bounds)
        .distinct()
    )
    # 64 bits of a company tell most of the places where it pays nothing, whatever their
    # number, so few other postings are shuffled to meet its salaries.
    marks = paid.groupBy("company_id").agg(F.bit_or(_mark(F.col("location_id"))).alias("_marks"))
    if not every_salary:
        paid = paid.groupBy("company_id", "location_id").agg(
            F.min("salary_min").alias("salary_min"), F.max("salary_max").alias("salary_max")
        )
    paid, marks = paid.hint("rebalance"), marks.hint("rebalance")  # lets Spark split hot postings
    places = lookup(
        norm["locations"], dims["dim_locations"],
        [("city", "city"), ("subdivision_code", "state"), ("country_code", "country")],
        {"location_key": "location_key"}, "left", left_form=folded, right_form=folded,
    ).select("id", "location_key")
    # A posting without a matching salary is not kept, so the place and the salary
    # must both be there and these joins may be inner ones.
    marked = lookup(
        jobs.select("id", "company_id", "full_date"), marks,
        [("company_id", "company_id")], {"_marks": "_marks"},
    )
    placed = lookup(marked, norm["jobs_locations"], [("id", "job_id")], {"location_id": "location_id"})
    placed = placed.where(F.col("_marks").bitwiseAND(_mark(F.col("location_id"))) != 0)
    priced = lookup(
        placed.drop("_marks"), paid,
        [("company_id", "company_id"), ("location_id", "location_id")], {b: b for b in bounds},
    )
    priced = keep("fact_priced", priced)
    keyed = lookup(priced, places, [("location_id", "id")], {"location_key": "location_key"})
    keyed = lookup(
        keyed, dims["dim_date"], [("full_date", "full_date")], {"date_key": "date_key"}, "left"
    )
    keyed = lookup(
        keyed, dims["dim_companies"], [("company_id", "company_id")], {"company_key": "company_key"}
    )
    keyed = lookup(keyed, dims["dim_jobs"], [("id", "job_id")], {"job_key": "job_key"})
    keys = ["job_key", "company_key", "location_key", "date_key", *bounds]
    # A job key belongs to one job: with its id the rows are as distinct as without, and
    # they lie by id already, so that they are not shuffled again.
    rows = keep("fact_rows", keyed.select("id", *keys).distinct().drop("id"))
    return with_ids(rows, keys, "fact_id")


def append_new(rows: DataFrame, existing: DataFrame, keys: list[str]) -> DataFrame:
    """Rows of any of these tables that the stored table lacks."""
    return insert_if_absent(rows, existing, keys)
