"""Questions over the star tables.

A `PostingModel` is a fact table, its lookup tables and where each attribute
lives. A query joins only the lookups its dimension and filters need. Sums are
taken per dimension key before the dimension is joined, so a key that holds a
large share of the rows reaches the join as one row. Distinct jobs are counted
per value and job first and then per value, both with map-side reduction.
"""

from __future__ import annotations

from collections.abc import Callable
from dataclasses import dataclass, field
from functools import reduce

from pyspark.sql import Column, DataFrame
from pyspark.sql import functions as F

from jobgrain.functions.text import ilike_pattern, round_whole

# What may be asked for, and the filters.
COUNT_DIMENSIONS = [
    "company_name", "company_industry", "company_size", "country", "subdivision", "city",
    "job_category", "entry_level",
]
SALARY_DIMENSIONS = ["company_name", "company_size", "country", "subdivision", "city"]
FILTERS = [
    "country", "subdivision", "city", "entry_level", "company_size", "start_date",
    "end_date", "job_category", "job_title",
]


@dataclass(frozen=True)
class Lookup:
    """A table with one row per key. `outer` keeps fact rows without a match."""

    table: DataFrame
    fact_key: str
    key: str
    outer: bool = False


@dataclass(frozen=True)
class PostingModel:
    """`attributes` maps an attribute to (lookup name or None for the fact, column).

    Attributes used: job_id, job_title, company_name, company_industry,
    company_size, country, subdivision, city, job_category, entry_level, date,
    salary_min, salary_max.
    """

    fact: DataFrame
    lookups: dict[str, Lookup]
    attributes: dict[str, tuple[str | None, str]] = field(default_factory=dict)
    month_partitions: tuple[str, str] | None = None  # year and month columns of the fact

    def view(self, names: list[str]) -> DataFrame:
        """The fact with the named attributes and only the lookups they need."""
        return self.attach(self.fact, names, keep=[])

    def attach(self, rows: DataFrame, names: list[str], keep: list[str]) -> DataFrame:
        """Rows with their `keep` columns and the named attributes."""
        out = rows.alias("_f")
        for name in sorted({self.attributes[n][0] or "" for n in names} - {""}):
            lookup = self.lookups[name]
            same = F.col(f"_f.{lookup.fact_key}") == F.col(f"_{name}.{lookup.key}")
            out = out.join(lookup.table.alias(f"_{name}"), same, "left" if lookup.outer else "inner")
        picked = [F.col(f"_f.{c}") for c in keep]
        for n in names:
            owner, column = self.attributes[n]
            picked.append(F.col(f"_{owner}.{column}" if owner else f"_f.{column}").alias(n))
        return out.select(*picked)


def star_model(tables: dict[str, DataFrame]) -> PostingModel:
    """The model over the star tables (`{"fact_job_postings": ..., "dim_jobs": ...}`)."""
    return PostingModel(
        fact=tables["fact_job_postings"],
        lookups={
            "job": Lookup(tables["dim_jobs"], "job_key", "job_key"),
            "company": Lookup(tables["dim_companies"], "company_key", "company_key"),
            "category": Lookup(tables["dim_categories"], "category_key", "category_key"),
            "level": Lookup(tables["dim_levels"], "level_key", "level_key"),
            "day": Lookup(tables["dim_date"], "date_key", "date_key"),
            "place": Lookup(tables["dim_locations"], "location_key", "location_key", outer=True),
        },
        attributes={
            "job_id": (None, "job_key"),  # one key per job id
            "job_title": ("job", "name"),
            "company_name": ("company", "name"),
            "company_industry": ("company", "industry"),
            "company_size": ("company", "size"),
            "country": ("place", "country"),
            "subdivision": ("place", "state"),
            "city": ("place", "city"),
            "job_category": ("category", "name"),
            "entry_level": ("level", "level"),
            "date": ("day", "full_date"),
            "salary_min": (None, "salary_min"),
            "salary_max": (None, "salary_max"),
        },
        month_partitions=("year", "month"),
    )


# --- filters -----------------------------------------------------------------------


def check_request(dimension: str, allowed: list[str], filters: dict[str, str | None]) -> None:
    """Reject an unknown dimension or filter, and a start after the end."""
    if dimension not in allowed:
        raise ValueError(f"invalid dimension {dimension!r}; allowed: {allowed}")
    unknown = set(filters) - set(FILTERS)
    if unknown:
        raise ValueError(f"unknown filters: {sorted(unknown)}")
    start, end = filters.get("start_date"), filters.get("end_date")
    if start and end and start > end:
        raise ValueError("start_date cannot be after end_date")


def predicates(filters: dict[str, str | None]) -> dict[str, list[Column]]:
    """Conditions per attribute for the filters that are set; empty is not set.
    Text compares without regard to case, dates are inclusive, and the title is a
    substring match."""
    out: dict[str, list[Column]] = {}
    for name, value in filters.items():
        if not value:
            continue
        if name == "start_date":
            out.setdefault("date", []).append(F.col("date") >= F.lit(value).cast("date"))
        elif name == "end_date":
            out.setdefault("date", []).append(F.col("date") <= F.lit(value).cast("date"))
        elif name == "job_title":
            out["job_title"] = [F.col("job_title").ilike(ilike_pattern(value))]
        else:
            out[name] = [F.lower(F.col(name)) == F.lower(F.lit(value))]
    return out


def _months(model: PostingModel, filters: dict[str, str | None]) -> list[Column]:
    """Date filters as conditions on the partition columns of the fact, so that
    only the months in question are read."""
    if not model.month_partitions:
        return []
    year, month = map(F.col, model.month_partitions)
    at = year * 12 + month
    out = []
    for name, compare in (("start_date", at.__ge__), ("end_date", at.__le__)):
        if filters.get(name):
            day = F.lit(filters[name]).cast("date")
            out.append(compare(F.year(day) * 12 + F.month(day)))
    return out


def _filtered(model: PostingModel, keep: list[str], filters: dict[str, str | None]) -> DataFrame:
    """Fact rows that pass the filters. Attributes of the fact itself are tested
    first; then each lookup that has filters is reduced to the keys that pass and
    semi-joined, once."""
    rows = model.fact
    for test in _months(model, filters):
        rows = rows.where(test)
    by_owner: dict[str | None, list[str]] = {}
    tests = predicates(filters)
    for name in tests:
        by_owner.setdefault(model.attributes[name][0], []).append(name)
    for owner, names in sorted(by_owner.items(), key=lambda item: item[0] is not None):
        test = reduce(lambda a, b: a & b, [t for n in names for t in tests[n]])
        columns = {n: F.col(model.attributes[n][1]) for n in names}
        if owner is None:
            rows = rows.withColumns(columns).where(test)
            continue
        lookup = model.lookups[owner]
        chosen = (
            lookup.table.select(
                F.col(lookup.key).alias("_key"), *[c.alias(n) for n, c in columns.items()]
            )
            .where(test)
            .select("_key")
        )
        rows = rows.join(chosen, F.col(lookup.fact_key) == F.col("_key"), "left_semi")
    return rows.select(*dict.fromkeys(keep))


def _dimension_key(model: PostingModel, dimension: str) -> str:
    owner, column = model.attributes[dimension]
    return column if owner is None else model.lookups[owner].fact_key


# --- queries -------------------------------------------------------------------------


def job_count(model: PostingModel, dimension: str, **filters: str | None) -> DataFrame:
    """Distinct jobs per value of a dimension, largest first. NULL is a value of
    its own, and ties are ordered by the value. The postings are reduced to one per
    dimension key and job before the dimension is joined."""
    check_request(dimension, COUNT_DIMENSIONS, filters)
    keep = [_dimension_key(model, dimension), model.attributes["job_id"][1]]
    pairs = _filtered(model, keep, filters).distinct()
    return (
        model.attach(pairs, [dimension, "job_id"], keep=[])
        .groupBy(dimension)
        .agg(F.count_distinct("job_id").alias("job_count"))
        .orderBy(F.desc_nulls_first("job_count"), F.asc_nulls_last(dimension))
    )


def salary_stats(model: PostingModel, dimension: str, **filters: str | None) -> DataFrame:
    """Mean mid-point, lowest and highest salary and row count per value of a
    dimension, over rows with a salary, highest mean first. A row with one bound
    missing does not count towards the mean."""
    check_request(dimension, SALARY_DIMENSIONS, filters)
    key, job = _dimension_key(model, dimension), model.attributes["job_id"][1]
    low, high = F.col("salary_min"), F.col("salary_max")
    paid = _filtered(model, [key, job, "salary_min", "salary_max"], filters).where(
        low.isNotNull() | high.isNotNull()
    )
    middle = (low + high) / 2
    by_key = paid.groupBy(key).agg(
        F.sum(middle).alias("_sum"),
        F.count(middle).alias("_n"),
        F.min(low).alias("_low"),
        F.max(high).alias("_high"),
        F.count(job).alias("_rows"),
    )
    summed = ["_sum", "_n", "_low", "_high", "_rows"]
    mean = F.sum("_sum") / F.nullif(F.sum("_n"), F.lit(0))
    return (
        model.attach(by_key, [dimension], keep=summed)
        .groupBy(dimension)
        .agg(
            round_whole(mean).alias("avg_salary"),
            round_whole(F.min("_low")).alias("min_salary"),
            round_whole(F.max("_high")).alias("max_salary"),
            F.sum("_rows").alias("job_x_location_count"),
        )
        .orderBy(F.desc_nulls_first("avg_salary"), F.asc_nulls_last(dimension))
    )


def distinct_values(df: DataFrame, columns: list[str], present: str) -> DataFrame:
    """Distinct, sorted combinations in which `present` is filled; NULLs last."""
    return (
        df.where(F.col(present).isNotNull())
        .select(*columns)
        .distinct()
        .orderBy(*[F.asc_nulls_last(c) for c in columns])
    )


def salary_range(fact: DataFrame) -> DataFrame:
    """Lowest lower and highest upper salary of all postings."""
    return fact.agg(
        F.min("salary_min").alias("min_salary"), F.max("salary_max").alias("max_salary")
    )


NAMED: dict[str, Callable[[dict[str, DataFrame]], DataFrame]] = {
    "job_categories": lambda t: distinct_values(
        t["dim_categories"].withColumnRenamed("name", "category"), ["category"], "category"
    ),
    "salary_range": lambda t: salary_range(t["fact_job_postings"]),
    "job_locations": lambda t: distinct_values(
        t["dim_locations"], ["country", "state", "city"], "city"
    ),
    "job_entry_level": lambda t: distinct_values(t["dim_levels"], ["level"], "level"),
    "company_size": lambda t: distinct_values(t["dim_companies"], ["size"], "size"),
}


def named_query(name: str, tables: dict[str, DataFrame]) -> DataFrame:
    """One of the named queries over the star tables."""
    if name not in NAMED:
        raise ValueError(f"query {name!r} not found; known: {sorted(NAMED)}")
    return NAMED[name](tables)


def row_count(result: DataFrame, dimension: str, metric: str) -> DataFrame:
    """`(dimension, metric, row_count)` of a result, counted where it lies."""
    return result.agg(F.count(F.lit(1)).alias("row_count")).select(
        F.lit(dimension).alias("dimension"), F.lit(metric).alias("metric"), "row_count"
    )


def answer(
    result: DataFrame, dimension: str, metric: str, **filters: str | None
) -> dict[str, DataFrame]:
    """A result and its description, both as tables: `meta` has one row with the
    dimension, metric, filters in use, row count and kind of aggregation (NULL but
    for counts). Nothing is brought to the driver."""
    used = [F.lit(x) for name, value in filters.items() if value is not None for x in (name, value)]
    none = F.create_map().cast("map<string,string>")
    meta = row_count(result, dimension, metric).select(
        "dimension",
        "metric",
        (F.create_map(*used) if used else none).alias("filters"),
        "row_count",
        F.lit("count_distinct" if metric == "job_count" else None).cast("string").alias("aggregation"),
    )
    return {"meta": meta, "data": result}


# --- views for SQL ---------------------------------------------------------------------

VIEW_ATTRIBUTES = [
    "job_id", "job_title", "company_name", "company_industry", "company_size", "country",
    "subdivision", "city", "job_category", "entry_level", "date",
]


def register_views(model: PostingModel) -> None:
    """`v_job_postings` and `v_job_salaries` (postings with a salary) as temporary
    views for free SQL."""
    model.view(VIEW_ATTRIBUTES).createOrReplaceTempView("v_job_postings")
    model.view(VIEW_ATTRIBUTES + ["salary_min", "salary_max"]).where(
        "salary_min IS NOT NULL OR salary_max IS NOT NULL"
    ).createOrReplaceTempView("v_job_salaries")
