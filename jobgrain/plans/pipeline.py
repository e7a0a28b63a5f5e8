"""The batch job: landing files to published star tables."""

from __future__ import annotations

from collections.abc import Callable
from datetime import datetime, timezone

from pyspark.sql import DataFrame, SparkSession

from jobgrain.operators.rows import ORDER
from jobgrain.operators.quality import (
    duplicate_keys,
    orphans,
    repeated_keys,
    row_counts,
    violations,
)
from jobgrain.plans import cleaning, norm, raw, star
from jobgrain.schemas import FOREIGN_KEYS, NORM, STAR, UNIQUE_KEYS
from jobgrain.session import tune
from jobgrain.sources.commits import CommitConflict
from jobgrain.sources.landing import flatten, read_landing
from jobgrain.sources.warehouse import Warehouse


def load_norm(store: Warehouse, raw_tables: dict[str, DataFrame], null_safe: bool = False) -> None:
    """Append what is new to the normalized tables: lookups and companies, then
    the tables that refer to them, then the places of jobs."""
    rc, rj, rs = (raw_tables[n] for n in ("companies", "jobs", "salaries"))

    def old(name: str) -> DataFrame:
        return store.existing(f"norm.{name}")

    def add(**tables: DataFrame) -> list[DataFrame]:
        return list(store.append_all({f"norm.{n}": t for n, t in tables.items()}).values())

    industries, categories, levels, locations, companies = add(
        industries=norm.industries(rc, old("industries")),
        categories=norm.categories(rj, old("categories")),
        levels=norm.levels(rj, rs, old("levels")),
        locations=norm.locations(rc, rj, rs, old("locations")),
        companies=norm.companies(rc, old("companies")),
    )
    jobs, *_ = add(
        jobs=norm.jobs(rj, companies, levels, categories, old("jobs")),
        companies_industries=norm.companies_industries(
            rc, industries, old("companies_industries")
        ),
        companies_locations=norm.companies_locations(
            rc, companies, locations, old("companies_locations"), null_safe
        ),
        salaries=norm.salaries(
            rs, companies, levels, categories, locations, old("salaries"), null_safe
        ),
    )
    add(
        jobs_locations=norm.jobs_locations(rj, jobs, locations, old("jobs_locations"), null_safe)
    )


def load_star(store: Warehouse, null_safe: bool = False) -> None:
    """Append what is new to the dimensions, then write the touched months of the fact.

    Dimension rows can be new only through rows that this run added to the normalized
    tables, and fact rows only through the jobs that such rows touch, so a load after
    the first reads no more than those, and of the fact only their months. Those months
    are written anew, so the fact is what one load of all data gives, but for salaries:
    one that comes later does not change a row that is there.
    """
    normalized = {name: store.table(f"norm.{name}") for name in NORM}
    added = {name: store.added(f"norm.{name}") for name in NORM}

    def old(name: str) -> DataFrame:
        return store.existing(f"star.{name}")

    new = {
        "dim_companies": star.dim_companies(
            added["companies"], normalized["companies_industries"],
            normalized["industries"], old("dim_companies"),
        ),
        "dim_jobs": star.dim_jobs(added["jobs"], old("dim_jobs")),
        "dim_levels": star.dim_levels(added["levels"], old("dim_levels")),
        "dim_categories": star.dim_categories(added["categories"], old("dim_categories")),
        "dim_locations": star.dim_locations(added["locations"], old("dim_locations")),
        "dim_date": star.dim_date([added["jobs"]], old("dim_date")),
    }
    written = store.append_all({f"star.{name}": rows for name, rows in new.items()})
    dims = {name: written[f"star.{name}"] for name in new}
    name = "star.fact_job_postings"
    if not store.committed():
        store.append(name, star.fact_job_postings(normalized, dims, old("fact_job_postings"), null_safe))
        return

    def staged(step: str, rows: DataFrame) -> DataFrame:
        path = f"{store.root}/_{step}/run_id={store.run_id}"
        rows.write.mode("overwrite").parquet(path)
        return store.spark.read.schema(rows.schema).parquet(path)

    jobs = staged("touched", star.touched_jobs(normalized, added, null_safe))
    months = star.months_of(jobs)
    known = star.facts_of_months(old("fact_job_postings"), months)
    new = star.fact_job_postings(
        normalized | {"jobs": jobs}, dims, known, null_safe, old("fact_job_postings")
    )
    new = staged("new_facts", new)
    store.replace(name, star.maintained_facts(known, new), months)


def check(store: Warehouse, everything: bool = False) -> DataFrame:
    """`(table_name, check_name, violations)` for every declared key: of the rows
    this run added, against all rows, or (`everything`) of all rows."""
    names = [f"norm.{n}" for n in NORM] + [f"star.{n}" for n in STAR]
    tables = {name: store.table(name) for name in names}
    checked = tables if everything else {name: store.added(name) for name in names}
    checks = {}
    for name, keys in UNIQUE_KEYS.items():
        label = f"{name}|unique({', '.join(keys)})"
        if everything:
            checks[label] = duplicate_keys(checked[name], keys)
        else:
            checks[label] = repeated_keys(checked[name], store.untouched(name), keys)
    for name, references in FOREIGN_KEYS.items():
        for column, parent, parent_column in references:
            checks[f"{name}|{column} -> {parent}"] = orphans(
                checked[name], column, tables[parent], parent_column
            )
    return violations(checks).selectExpr(
        "split_part(check_name, '|', 1) AS table_name",
        "split_part(check_name, '|', 2) AS check_name",
        "violations",
    )


def audit(store: Warehouse) -> DataFrame:
    """Row counts of all normalized and star tables."""
    names = [f"norm.{n}" for n in NORM] + [f"star.{n}" for n in STAR]
    return row_counts({name: store.table(name) for name in names})


def load(store: Warehouse, cleaned: dict[str, DataFrame], null_safe: bool = False) -> None:
    """Cleaned tables `{jobs, companies, salaries}` to published layers. Nothing
    is published unless every table is written and all key checks pass."""
    exploded = {f"raw.{n}": build(cleaned[n]) for n, build in raw.BUILDERS.items()}
    written = store.refresh_all(exploded)
    raw_tables = {n: written[f"raw.{n}"] for n in raw.BUILDERS}
    load_norm(store, raw_tables, null_safe)
    load_star(store, null_safe)
    broken = check(store).where("violations > 0").collect()
    if broken:
        raise ValueError(f"key checks failed, nothing published: {broken}")
    store.commit()


def run(
    spark: SparkSession,
    landing: dict[str, str],
    root: str,
    run_id: str | None = None,
    *,
    on_bad: str = "fail",
    null_safe: bool = False,
    json_lines: bool = False,
    attempts: int = 3,
    log: Callable[[str], None] = print,
) -> Warehouse:
    """Landing folders `{jobs, companies, salaries}` to tables under `root`. The
    steps run one after the other and the first failure ends the job. With
    `on_bad="quarantine"` rows with a missing or malformed id are stored aside, as
    they came, and counted with the tables. If another run is published meanwhile, the
    cleaned rows are loaded again upon it, under a run id of their own, up to `attempts`
    times."""
    tune(spark)
    run_id = run_id or datetime.now(timezone.utc).strftime("run_%Y%m%d_%H%M%S_%f")
    store = Warehouse(spark, root, run_id)
    cleaned = {}
    for dataset in raw.BUILDERS:
        records = read_landing(spark, landing[dataset], dataset, json_lines)
        flat = flatten(records, dataset)
        if on_bad == "quarantine":
            store.quarantine(dataset, cleaning.rejected(flat, dataset).drop(ORDER))
        rows = cleaning.clean(flat, dataset, on_bad)
        path = f"{store.root}/processed/{dataset}/run_id={run_id}"
        rows.write.mode("overwrite").parquet(path)
        cleaned[dataset] = spark.read.schema(rows.schema).parquet(path)
        log(f"{dataset}: cleaned")
    first = store
    for attempt in range(1, attempts + 1):
        try:
            load(store, cleaned, null_safe)
            break
        except CommitConflict:
            if attempt == attempts:
                raise
            log(f"{store.run_id}: another run came first, loading again")
            store = Warehouse(spark, root, f"{run_id}_{attempt + 1}")
    counts = audit(store)
    if on_bad == "quarantine":
        set_aside = {f"quarantine.{n}": first.quarantined(n) for n in raw.BUILDERS}
        counts = counts.unionByName(row_counts(set_aside))
    for row in counts.collect():
        log(f"{row.table_name}: {row.row_count} rows")
    return store
