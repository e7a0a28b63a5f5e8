import json

import pytest
from pyspark.errors import PySparkException

from jobgrain.plans import cleaning, norm, pipeline, raw, serving, star
from jobgrain.schemas import NORM, STAR
from jobgrain.sources import landing, processed
from jobgrain.sources.commits import Commit, CommitConflict, CommitLog
from jobgrain.sources.warehouse import Warehouse


def named(*names):
    return [{"name": n} for n in names]


def company(i, name, size, places, industries):
    return {
        "id": i, "name": name, "description": f" about\n {name} ", "size": {"name": size},
        "publication_date": "2025-01-01T00:00:00Z", "locations": named(*places),
        "industries": named(*industries),
    }


def job(i, company_id, name, level, day, places, categories):
    return {
        "id": i, "company": {"id": company_id, "name": " Acme "}, "name": name, "levels": named(level),
        "publication_date": f"{day}T10:00:00Z", "locations": named(*places), "categories": named(*categories),
    }


def salary(i, title, low, high, area=("US", "Texas", "Austin")):
    return {
        "id": str(i), "title": title, "company": {"display_name": " ACME "},
        "created": "2025-01-05T00:00:00Z", "category": {"label": "IT Jobs", "tag": "it-jobs"},
        "location": {"display_name": "x", "area": list(area)}, "salary_min": low, "salary_max": high,
        "salary_is_predicted": "0",
    }


COMPANIES = [
    company(1, "Acme", "Large Size", ["Austin, TX", "Berlin, Germany"], ["Tech", "Health"]),
    company(2, "Zed", "Small Size", [], []),
]
FIRST = job(10, 1, "Senior Data Analyst", "Senior Level", "2025-01-02", ["Austin, TX", "Berlin, Germany"], ["Data and Analytics"])
JOBS = [
    FIRST,
    FIRST,
    job(11, 1, "Support", "Mid Level", "2025-01-03", ["Flexible / Remote"], []),
    job(12, 2, "Dev", "Mid Level", "2025-01-03", [], ["Software Engineering"]),
    job(13, 99, "Intern", "Entry Level", "2025-01-04", ["Austin, TX"], ["Software Engineering"]),
    job(14, 1, "Data Engineer", "Senior Level", "2025-01-03", ["Berlin, Germany"], ["Data and Analytics"]),
]
SALARIES = [salary(500, "Senior Data Analyst", 100000, 120000), salary(501, "Lead Data Analyst", 110000, 130000)]


def land(root, **datasets):
    paths = {}
    for name, records in datasets.items():
        folder = root / name
        folder.mkdir(parents=True, exist_ok=True)
        (folder / f"{name}_20250101_000000.json").write_text(json.dumps(records, indent=1))
        paths[name] = str(folder)
    return paths


def counts(store):
    return {r.table_name: r.row_count for r in pipeline.audit(store).collect()}


FIRST_LOAD = {
    "norm.industries": 2, "norm.categories": 2, "norm.levels": 3, "norm.locations": 3,
    "norm.companies": 2, "norm.companies_industries": 2, "norm.companies_locations": 1,
    "norm.jobs": 3, "norm.jobs_locations": 2, "norm.salaries": 2, "star.dim_companies": 2,
    "star.dim_jobs": 3, "star.dim_levels": 3, "star.dim_categories": 2, "star.dim_locations": 3,
    "star.dim_date": 2, "star.fact_job_postings": 2,
}


@pytest.fixture(scope="module")
def loaded(spark, tmp_path_factory):
    """Three loads of one warehouse: the input, the same again, and a later one."""
    root = tmp_path_factory.mktemp("e2e")
    paths = land(root / "landing", companies=COMPANIES, jobs=JOBS, salaries=SALARIES)
    quiet = {"log": lambda line: None}
    stores = [pipeline.run(spark, paths, str(root / "tables"), f"run_{i}", **quiet) for i in (1, 2)]
    later = land(
        root / "landing3", companies=COMPANIES,
        jobs=JOBS + [job(15, 1, "New Analyst", "Senior Level", "2025-02-01", ["Austin, TX"], ["Data and Analytics"])],
        salaries=[salary(502, "A later analyst manager", 1.0, 2.0)],
    )
    stores.append(pipeline.run(spark, later, str(root / "tables"), "run_3", **quiet))
    return root, stores


def test_first_load(loaded):
    assert counts(loaded[1][0]) == FIRST_LOAD


def test_second_load_adds_nothing(loaded):
    assert counts(loaded[1][1]) == FIRST_LOAD


def test_facts_and_answers(loaded):
    store = loaded[1][0]
    tables = {name: store.table(f"star.{name}") for name in STAR}
    model = serving.star_model(tables)
    by_city = [tuple(r) for r in serving.job_count(model, "city").collect()]
    assert by_city == [("Austin", 1), (None, 1)]
    stats = [tuple(map(str, r)) for r in serving.salary_stats(model, "country").collect()]
    assert stats == [("US", "110000", "100000", "120000", "1")]
    industries = {r.name: r.industry for r in tables["dim_companies"].collect()}
    assert industries == {"Acme": "Health", "Zed": None}
    described = {r.description for r in tables["dim_companies"].collect()}
    assert described == {"about Acme", "about Zed"}


def test_later_load(loaded):
    """A later salary is the newest for a new fact row and leaves the old one."""
    store = loaded[1][2]
    jobs = {r.job_key: r.name for r in store.table("star.dim_jobs").collect()}
    facts = {
        (jobs[r.job_key], r.salary_min) for r in store.table("star.fact_job_postings").collect()
    }
    assert facts == {("Senior Data Analyst", 100000.0), ("Data Engineer", None), ("New Analyst", 1.0)}
    ids = [r.id for r in store.table("norm.salaries").collect()]
    assert len(ids) == len(set(ids)) == 3


def test_only_published_runs_are_seen(spark, loaded):
    root = loaded[0] / "tables"
    before = counts(Warehouse(spark, str(root)))
    unfinished = Warehouse(spark, str(root), "run_4")
    unfinished.append("norm.levels", unfinished.existing("norm.levels").selectExpr("id + 99999 AS id", "'x' AS level").limit(1))
    assert counts(Warehouse(spark, str(root))) == before
    assert unfinished.table("norm.levels").count() == before["norm.levels"] + 1


def test_broken_keys_are_not_published(spark, tmp_path, monkeypatch):
    monkeypatch.setattr(star, "dim_levels", lambda levels, existing: levels.selectExpr("id AS level_key", "1L AS level_id", "level"))
    paths = land(tmp_path / "landing", companies=COMPANIES, jobs=JOBS, salaries=SALARIES)
    with pytest.raises(ValueError, match="dim_levels"):
        pipeline.run(spark, paths, str(tmp_path / "tables"), "run_1", log=lambda line: None)
    assert Warehouse(spark, str(tmp_path / "tables")).committed() == []


def test_a_published_run_is_not_run_again(spark, loaded):
    with pytest.raises(ValueError, match="published"):
        Warehouse(spark, str(loaded[0] / "tables"), "run_1")


def test_raw_is_that_of_the_last_load(spark, loaded):
    store = Warehouse(spark, str(loaded[0] / "tables"))
    assert store.table("raw.jobs").count() == 6
    assert {r.adz_job_id for r in store.table("raw.salaries").collect()} == {502}
    folders = {p.name for p in (loaded[0] / "tables" / "raw.jobs").iterdir() if p.is_dir()}
    assert folders == {"run_id=run_3"}


def test_bad_rows_are_set_aside_and_counted(spark, tmp_path):
    bad = dict(JOBS[4], id="none")
    paths = land(tmp_path / "landing", companies=COMPANIES, jobs=JOBS + [bad], salaries=SALARIES)
    said = []
    store = pipeline.run(spark, paths, str(tmp_path / "tables"), "run_1", on_bad="quarantine", log=said.append)
    assert [(r.job_id, r.job_name) for r in store.quarantined("jobs").collect()] == [("none", "Intern")]
    assert "quarantine.jobs: 1 rows" in said and "quarantine.salaries: 0 rows" in said
    assert counts(store) == FIRST_LOAD


# --- cleaning ---------------------------------------------------------------------------


def flat(spark, tmp_path, dataset, records):
    paths = land(tmp_path, **{dataset: records})
    return landing.flatten(landing.read_landing(spark, paths[dataset], dataset), dataset)


def test_cleaned_jobs(spark, tmp_path):
    cleaned = cleaning.clean(flat(spark, tmp_path, "jobs", JOBS), "jobs").collect()
    assert sorted(r.job_id for r in cleaned) == [10, 11, 13, 14]


def test_first_record_of_the_input_order_wins(spark, tmp_path):
    folder = tmp_path / "jobs"
    folder.mkdir()
    for file, name in (("b_20250102_000000.json", "second"), ("a_20250101_000000.json", "first")):
        records = [job(1, 1, f"{name} {i}", "x", "2025-01-01", ["Canada"], []) for i in range(3)]
        (folder / file).write_text(json.dumps(records))
    records = landing.flatten(landing.read_landing(spark, str(folder), "jobs"), "jobs")
    assert [r.job_name for r in cleaning.clean(records, "jobs").collect()] == ["first 0"]
    latest = landing.read_latest_landing(spark, str(folder), "jobs")
    assert {r.name for r in latest.collect()} == {"second 0", "second 1", "second 2"}
    (folder / "unstamped.json").write_text("[]")
    with pytest.raises(FileNotFoundError):
        landing.read_latest_landing(spark, str(folder / "unstamped.json"), "jobs")


def test_bad_ids_fail_or_are_set_aside(spark, tmp_path):
    records = flat(spark, tmp_path, "jobs", [FIRST, {**FIRST, "id": "abc"}, {**FIRST, "id": None}])
    with pytest.raises(PySparkException):
        cleaning.clean(records, "jobs").collect()
    assert cleaning.clean(records, "jobs", on_bad="quarantine").count() == 1
    assert cleaning.rejected(records, "jobs").count() == 2
    with pytest.raises(ValueError):
        cleaning.clean(records, "jobs", on_bad="ignore")
    with pytest.raises(ValueError):
        cleaning.clean(records, "people")


def test_a_job_without_level_or_a_broken_file_fails(spark, tmp_path):
    with pytest.raises(PySparkException):
        flat(spark, tmp_path, "jobs", [{**FIRST, "levels": []}]).collect()
    (tmp_path / "jobs" / "broken_20250102_000000.json").write_text('[{"id": 1, "name": "x"')
    with pytest.raises(Exception, match="broken_20250102"):
        landing.read_landing(spark, str(tmp_path / "jobs"), "jobs").collect()


def test_cleaned_salaries(spark, tmp_path):
    records = [
        salary(1, "Sr-Data Engineer (m/f)", 1, 2), salary(2, "x", None, 2), salary(3, "x", "n/a", 2),
        {**salary(4, "x", 1, 2), "company": {"display_name": ""}},
        {**salary(5, None, 1, 2), "location": None},
    ]
    rows = {r.adz_job_id: r for r in cleaning.clean(flat(spark, tmp_path, "salaries", records), "salaries").collect()}
    assert sorted(rows) == [1, 5]
    assert (rows[1].categories, rows[1].level, rows[1].salary_is_predicted) == ("Data and Analytics", "Senior Level", 0)
    assert (rows[5].categories, rows[5].level, rows[5].locations) == (None, None, None)


def test_processed_csv_round_trip(spark, tmp_path):
    cleaned = cleaning.clean(flat(spark, tmp_path, "companies", COMPANIES), "companies")
    processed.write_csv(cleaned, str(tmp_path / "csv"))
    back = processed.read_csv(spark, str(tmp_path / "csv"), "companies")
    want = sorted(map(repr, raw.raw_companies(cleaned).collect()))
    assert sorted(map(repr, raw.raw_companies(back).collect())) == want


def test_processed_csv_in_literal_form(spark, tmp_path):
    path = tmp_path / "companies.csv"
    path.write_text(
        "company_id,company_name,description,publication_date,size,locations,industries\n"
        '1,Acme,"line one\nline ""two""",2023-03-07 17:50:06.946388+00:00,Large Size,'
        "\"[{'country': 'Flexible/Remote', 'state': 'Flexible/Remote', 'city': 'Flexible/Remote'}, "
        "{'country_code': 'US', 'subdivision_code': None, 'city': \"\"Coeur d'Alene\"\"}]\",\"[{'name': 'Tech'}]\"\n"
        "2,Zed,,,,,\n"
    )
    rows = raw.raw_companies(processed.read_csv(spark, str(path), "companies"))
    got = {(r.company_id, r.location_city, r.location_state, r.location_country, r.industry_name) for r in rows.collect()}
    assert got == {
        (1, "Flexible/Remote", "Flexible/Remote", "Flexible/Remote", "Tech"),
        (1, "Coeur d'Alene", None, "US", "Tech"),
        (2, None, None, None, None),
    }


# --- consequences of the layer rules -----------------------------------------------------


def test_places_with_a_missing_part_link_only_when_asked(spark):
    raw_rows = spark.createDataFrame([(1, "Berlin", None, "DE")], "company_id bigint, location_city string, location_state string, location_country string")
    companies = spark.createDataFrame([(1,)], "id bigint")
    locations = spark.createDataFrame([(5, "Berlin", None, "DE")], NORM["locations"])
    none = spark.createDataFrame([], NORM["companies_locations"])
    assert norm.companies_locations(raw_rows, companies, locations, none).count() == 0
    assert norm.companies_locations(raw_rows, companies, locations, none, null_safe=True).count() == 1


def test_two_spellings_of_a_city_give_two_keys(spark):
    locations = spark.createDataFrame(
        [(1, "Austin", "US-TX", "US"), (2, "AUSTIN", "US-TX", "US"), (3, "Berlin", None, "DE")], NORM["locations"]
    )
    dims = star.dim_locations(locations, spark.createDataFrame([], STAR["dim_locations"]))
    assert dims.count() == 3
    found = star.location_keys(locations, dims).collect()
    assert sorted(r.location_id for r in found) == [1, 1, 2, 2]
    assert sorted(r.location_id for r in star.location_keys(locations, dims, null_safe=True).collect()) == [1, 1, 2, 2, 3]


def test_salary_match_needs_level_and_category(spark):
    salaries = spark.createDataFrame(
        [(1, 1, 1, "a", 1.0, 2.0, 7, None, 1), (2, 1, 1, "a", 3.0, 4.0, 7, 8, 1), (3, 1, 1, "b", 5.0, 6.0, 7, 8, 1)],
        NORM["salaries"],
    )
    newest = star.newest_salaries(salaries).collect()
    assert [(r.category_id, r.salary_min) for r in newest] == [(8, 5.0)]


def test_wide_plans_have_no_cross_products(spark):
    empty = {f"norm.{n}": spark.createDataFrame([], s) for n, s in NORM.items()}
    tables = {n: empty[f"norm.{n}"] for n in NORM}
    dims = {n: spark.createDataFrame([], s) for n, s in STAR.items()}
    fact = star.fact_job_postings(tables, dims, dims["fact_job_postings"])
    text = fact._jdf.queryExecution().sparkPlan().toString()
    assert "Cartesian" not in text and "NestedLoop" not in text and "Python" not in text


def test_a_later_load_reads_only_its_months(spark, loaded, tmp_path):
    """The months of the jobs that a load touches, not the whole fact."""
    store = loaded[1][2]
    jobs = store.added("norm.jobs")
    assert [r.name for r in jobs.collect()] == ["New Analyst"]
    touched = star.touched_jobs(
        {n: store.table(f"norm.{n}") for n in NORM}, {n: store.added(f"norm.{n}") for n in NORM}
    )
    assert [r.name for r in touched.collect()] == ["New Analyst"]
    months = star.months_of(touched)
    assert months == [(2025, 2)]
    known = star.facts_of_months(store.existing("star.fact_job_postings"), months)
    plan = known._jdf.queryExecution().executedPlan().toString()
    assert "PartitionFilters" in plan and "year" in plan.split("PartitionFilters: [")[1].split("]")[0]
    assert known.count() == 0


def named_facts(store):
    """(job, city) of all facts."""
    jobs = store.table("star.dim_jobs").select("job_key", "name")
    places = store.table("star.dim_locations").select("location_key", "city")
    facts = store.table("star.fact_job_postings").join(jobs, "job_key").join(places, "location_key", "left")
    return sorted((r.name, r.city or "") for r in facts.select("name", "city").collect())


def test_a_place_that_comes_later_takes_the_place_of_none(spark, tmp_path):
    """The same natural key first without a place, then with one, then with another; jobs
    of the same and of other months are left as they are."""
    tables, quiet = str(tmp_path / "tables"), {"log": lambda line: None}

    def load(i, *jobs):
        paths = land(tmp_path / f"in{i}", companies=COMPANIES, jobs=list(jobs), salaries=SALARIES)
        return pipeline.run(spark, paths, tables, f"run_{i}", **quiet)

    def one(i, name, day, *places):
        return job(i, 1, name, "Senior Level", day, places, ["Data and Analytics"])

    bare = one(20, "Late Placed", "2025-01-02", "Berlin, Germany")  # never links: no state
    first = load(1, bare, one(21, "Other", "2025-01-05", "Berlin, Germany"), one(22, "June", "2025-06-05", "Austin, TX"))
    assert named_facts(first) == [("June", "Austin"), ("Late Placed", ""), ("Other", "")]
    ids = {r.fact_id for r in first.table("star.fact_job_postings").where("month = 6").collect()}

    second = load(2, one(30, "Late Placed", "2025-01-02", "Austin, TX"))
    assert named_facts(second) == [("June", "Austin"), ("Late Placed", "Austin"), ("Other", "")]
    assert second.log.read()[-1].replaced == {"star.fact_job_postings": ["2025/1"]}
    third = load(3, one(31, "Late Placed", "2025-01-02", "Flexible / Remote"), bare)
    want = [("June", "Austin"), ("Late Placed", "Austin"), ("Late Placed", "Flexible/Remote"), ("Other", "")]
    assert named_facts(third) == want
    fourth = load(4, bare)
    assert named_facts(fourth) == want and fourth.log.read()[-1].replaced == {"star.fact_job_postings": []}

    # a single load of all records gives the same rows
    every = land(
        tmp_path / "every", companies=COMPANIES, salaries=SALARIES,
        jobs=[bare, one(21, "Other", "2025-01-05", "Berlin, Germany"), one(22, "June", "2025-06-05", "Austin, TX"),
              one(30, "Late Placed", "2025-01-02", "Austin, TX"), one(31, "Late Placed", "2025-01-02", "Flexible / Remote")],
    )
    assert named_facts(pipeline.run(spark, every, str(tmp_path / "once"), "run_1", **quiet)) == want

    facts = fourth.table("star.fact_job_postings").collect()
    assert len({r.fact_id for r in facts}) == len(facts)
    assert {r.fact_id for r in facts if r.month == 6} == ids
    assert pipeline.check(fourth, everything=True).where("violations > 0").count() == 0
    # earlier states stay readable until old partitions are dropped
    old = tmp_path / "tables" / "star.fact_job_postings" / "run_id=run_1" / "year=2025" / "month=1"
    assert old.exists() and named_facts(Warehouse(spark, tables)) == want
    Warehouse(spark, tables).vacuum()
    assert not old.exists() and named_facts(Warehouse(spark, tables)) == want


def test_of_two_writers_one_is_refused_and_loads_again(spark, tmp_path, monkeypatch):
    tables = str(tmp_path / "tables")
    lands = [
        land(tmp_path / f"in{i}", companies=COMPANIES, salaries=SALARIES,
             jobs=[job(40 + i, 1, name, "Senior Level", "2025-01-02", ["Austin, TX"], ["Data and Analytics"])])
        for i, name in enumerate(("One", "Two"))
    ]
    said, publish = [], Warehouse.commit

    def interrupted(store):
        """Another run is published just before the first one."""
        monkeypatch.setattr(Warehouse, "commit", publish)
        pipeline.run(spark, lands[1], tables, f"before_{store.run_id}", log=said.append)
        publish(store)

    monkeypatch.setattr(Warehouse, "commit", interrupted)
    store = pipeline.run(spark, lands[0], tables, "mine", log=said.append)
    assert "mine: another run came first, loading again" in said
    assert Warehouse(spark, tables).committed() == ["before_mine", "mine_2"]
    assert named_facts(store) == [("One", "Austin"), ("Two", "Austin")]
    assert pipeline.check(Warehouse(spark, tables, "reader"), everything=True).where("violations > 0").count() == 0
    assert counts(store)["norm.companies"] == 2

    monkeypatch.setattr(Warehouse, "commit", interrupted)
    lands[1] = land(tmp_path / "in9", companies=COMPANIES, jobs=JOBS, salaries=SALARIES)
    with pytest.raises(CommitConflict):
        pipeline.run(spark, lands[0], tables, "mine_3", attempts=1, log=said.append)


def test_commits_are_numbered_and_compacted(spark, tmp_path):
    log = CommitLog(spark, str(tmp_path), compact_every=4)
    assert log.read() == []
    want = [Commit(n, f"run_{n}", {"t": [f"2025/{n}"]}) for n in range(1, 11)]
    for commit in want:
        log.publish(commit)
        with pytest.raises(CommitConflict):
            log.publish(Commit(commit.number, "other"))
    assert log.read() == want
    names = sorted(p.name for p in (tmp_path / "_commits").iterdir() if not p.name.startswith("."))
    assert names == [f"{n:020d}.json" for n in range(5, 9)][:3] + [
        f"{8:020d}.all.json", f"{8:020d}.json", f"{9:020d}.json", f"{10:020d}.json"
    ]
    with pytest.raises(CommitConflict):  # of a number whose file is gone
        log.publish(Commit(2, "late"))


def test_another_spelling_of_a_place_touches_its_jobs(spark, tmp_path):
    paths = land(tmp_path / "landing", companies=COMPANIES, jobs=JOBS, salaries=SALARIES)
    quiet = {"log": lambda line: None}
    first = pipeline.run(spark, paths, str(tmp_path / "tables"), "run_1", **quiet)
    assert first.table("star.fact_job_postings").count() == 2
    again = land(
        tmp_path / "landing2", companies=COMPANIES, salaries=SALARIES,
        jobs=[job(16, 1, "Late One", "Senior Level", "2025-03-01", ["AUSTIN, TX"], ["Data and Analytics"])],
    )
    second = pipeline.run(spark, again, str(tmp_path / "tables"), "run_2", **quiet)
    jobs = {r.job_key: r.name for r in second.table("star.dim_jobs").collect()}
    names = sorted(jobs[r.job_key] for r in second.table("star.fact_job_postings").collect())
    # both spellings match both places, so the old job has a row for each
    assert names == ["Data Engineer", "Late One", "Late One", "Senior Data Analyst", "Senior Data Analyst"]
    ids = [r.fact_id for r in second.table("star.fact_job_postings").collect()]
    assert len(set(ids)) == len(ids)
