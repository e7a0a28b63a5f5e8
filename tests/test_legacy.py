import random

import pytest
from pyspark.sql import functions as F

from jobgrain.functions.listtext import location_parts, name_parts, place_of, places_in, value_of_key
from jobgrain.plans import legacy


def place(spark, text):
    c = F.col("x")
    found = place_of(c, c)
    row = spark.createDataFrame([(text,)], "x string").select(*[v.alias(k) for k, v in found.items()]).first()
    return tuple(row)


def test_place_of_text(spark):
    assert place(spark, "city: Austin, subdivision_code: US-TX, country_code: US") == ("Austin", "US-TX", "US")
    assert place(spark, "city: Oslo, state: None, country: Norway") == ("Oslo", None, "Norway")
    assert place(spark, "{'city': 'Oslo'}") == (None, None, None)
    assert place(spark, "city: A, subdivision_code: B\n, city: C, subdivision_code: D") == ("C", "D", None)
    assert place(spark, None) == (None, None, None)


def test_value_without_key_is_the_text(spark):
    df = spark.createDataFrame([("remote",)], "x string")
    assert df.select(value_of_key(F.col("x"), "city")).first()[0] == "remote"


def test_the_location_text_stays_whole(spark):
    df = spark.createDataFrame([("[{city: A, country: B}, {city: C, country: D}]",)], "x string")
    assert df.select(location_parts(F.col("x"))).first()[0] == ["city: A, country: B, city: C, country: D"]


def test_name_parts(spark):
    df = spark.createDataFrame([("name: A, name:  B ,, ",), ("",)], "x string")
    assert [r[0] for r in df.select(name_parts(F.col("x"))).collect()] == [["A", "B", ""], []]


def test_parents_of_one_name_share_its_list(spark):
    raw = spark.createDataFrame([("dev", "name: A"), ("dev", "name: B"), ("ops", None)], "job_name string, categories string")
    jobs = spark.createDataFrame([(1, "dev"), (2, "dev"), (3, "ops")], "id bigint, name string")
    names = legacy.names(raw, "categories")
    got = legacy.name_bridge(raw, "categories", "job_name", jobs, names, "job_id", "category_id")
    assert got.count() == 4


def test_several_places_of_one_text(spark):
    texts = {
        "[{'city': 'Austin', 'state': 'US-TX', 'country': 'US'}, {'city': 'Paris', 'state': None}]":
            [("Austin", "US-TX", "US"), ("Paris", None, None)],
        '[{"city": "Washington, D.C.", "country_code": "US"}, {"state": "x"}, {"city": "a}b{c"}]':
            [("Washington, D.C.", None, "US"), ("a}b{c", None, None)],
        "{city: A, subdivision_code: B}, {CITY: C, country: D}": [("A", "B", None), ("C", None, "D")],
        "{'city': \"Coeur d'Alene\", 'meta': {'zip': 1}, 'country': 'US'}": [("Coeur d'Alene", None, "US")],
        "city: Oslo, country_code: NO": [("Oslo", None, "NO")],
        "{city: open": [("open", None, None)],
        "remote": [], "": [], "[]": [], "{city: None}, {velocity: 3}": [], None: None,
    }
    df = spark.createDataFrame([(k, t) for k, t in enumerate(texts)], "k int, x string")
    rows = df.select("k", places_in(F.col("x")).alias("p")).orderBy("k").collect()
    got = [None if r.p is None else [tuple(x) for x in r.p] for r in rows]
    assert got[:-1] == list(texts.values())[:-1] and not got[-1]


def test_split_places_are_linked_one_by_one(spark):
    raw = spark.createDataFrame([("dev", "{city: A}, {city: B, state: S}")], "job_name string, locations string")
    jobs = spark.createDataFrame([(1, "dev"), (2, "dev")], "id bigint, name string")
    whole, split = (legacy.locations([raw], split=x) for x in (False, True))
    assert sorted(r.city for r in split.collect()) == ["A", "B"] and whole.count() == 1
    pairs = legacy.location_bridge(raw, "job_name", jobs, split, "job_id", split=True)
    assert pairs.count() == 4


def test_only_distinct_location_texts_are_parsed(spark):
    raw = spark.createDataFrame([("city: A",)] * 3 + [(None,)], "locations string")
    found = legacy.locations([raw, raw])
    assert [r.city for r in found.collect()] == ["A"]
    plan = found._jdf.queryExecution().optimizedPlan().toString()
    assert "split(" in plan and "split(" not in plan[plan.rindex("Aggregate"):]


def test_salaries_are_reduced_before_companies_of_one_name_join(spark):
    raw = spark.createDataFrame(
        [(name, " Dev", 1.0, None, "city: A, subdivision_code: B, country_code: C") for name in ("Acme", " ACME ", "acme", None) * 3]
        + [("acme", "Dev", 1.0, None, "remote"), ("acme", "Dev", None, None, "city: A"), ("acme", "Dev", 2.0, 3.0, None)],
        "company_name string, adz_job_name string, salary_min double, salary_max double, locations string",
    )
    companies = spark.createDataFrame([(i, "Acme") for i in (1, 2, 2)] + [(3, None)], "id bigint, name string")
    locations = legacy.locations([raw])
    found = legacy.salaries(raw, companies, locations)
    place = locations.first().id
    got = [tuple(r)[1:] for r in found.orderBy("company_id", "location_id").collect()]
    assert got == [
        (None, place, "Dev", 1.0, None), (1, None, "Dev", 1.0, None), (1, place, "Dev", 1.0, None),
        (2, None, "Dev", 1.0, None), (2, place, "Dev", 1.0, None),
    ]
    plan = found._jdf.queryExecution().optimizedPlan().toString()
    assert "Aggregate" in plan.split("Join LeftOuter")[1]  # between it and the join with the places


@pytest.mark.parametrize("every_salary", [True, False])
def test_fact_holds_each_paid_posting_once(spark, tmp_path, every_salary):
    r = random.Random(5)
    places = [(i, f"{'c' if i % 2 else ' C'}{i // 4}", "s", None if i == 7 else "t") for i in range(100)]
    jobs = [(i % 110, r.choice([None, *range(9)]), i % 4 == 0) for i in range(120)]
    linked = [(r.randrange(115), r.randrange(100)) for _ in range(2500)]
    paid = [(r.choice([None, *range(7), 8]), r.choice([None, *range(100)]), r.choice([None, 1.0, 2.0]), r.choice([None, 3.0])) for _ in range(500)]
    paid += [(8, p, 5.0, 6.0) for p in range(100)]  # a company that pays everywhere
    place_keys = {i: (c.strip().lower(), s, t) for i, c, s, t in places}
    dim_places = sorted({(i // 4 * 10, c.strip(), s, t) for i, c, s, t in places if t}, key=str)
    dim_jobs = [(1000 + i, i // 2) for i in range(220)]  # two of each job
    dim_companies = [(10 + i, i) for i in range(9)] + [(30, 0)]
    norm = {
        "jobs": spark.createDataFrame([(j, c, "2024-01-01" if d else None) for j, c, d in jobs], "id long, company_id long, p string")
            .select("id", "company_id", F.col("p").cast("timestamp_ntz").alias("publication_date")),
        "jobs_locations": spark.createDataFrame(linked, "job_id long, location_id long"),
        "salaries": spark.createDataFrame(paid, "company_id long, location_id long, salary_min double, salary_max double"),
        "locations": spark.createDataFrame(places, "id long, city string, subdivision_code string, country_code string"),
    }
    dims = {
        "dim_locations": spark.createDataFrame(dim_places, "location_key long, city string, state string, country string"),
        "dim_date": spark.createDataFrame([(1, "2024-01-01")], "date_key long, d string").select("date_key", F.col("d").cast("date").alias("full_date")),
        "dim_companies": spark.createDataFrame(dim_companies, "company_key long, company_id long"),
        "dim_jobs": spark.createDataFrame(dim_jobs, "job_key long, job_id long"),
    }
    bounds = {}
    for c, p, low, high in paid:
        if c is not None and p is not None and (low, high) != (None, None):
            bounds.setdefault((c, p), set()).add((low, high))
    if not every_salary:
        least = {k: min((x for x, _ in v if x is not None), default=None) for k, v in bounds.items()}
        most = {k: max((x for _, x in v if x is not None), default=None) for k, v in bounds.items()}
        bounds = {k: {(least[k], most[k])} for k in bounds}
    keys_of = {i: {k for k, c, s, t in dim_places if t and (c.lower(), s, t) == place_keys[i]} or {None} for i in place_keys}
    want = {
        (k, ck, lk, 1 if d else None, *b)
        for j, c, d in jobs for x, p in linked if x == j for b in bounds.get((c, p), ())
        for ck, cc in dim_companies if cc == c for k, kj in dim_jobs if kj == j for lk in keys_of[p]
    }
    kept = []

    def keep(name, rows):
        kept.append(name)
        rows.write.parquet(f"{tmp_path}/{name}")
        return spark.read.schema(rows.schema).parquet(f"{tmp_path}/{name}")

    for stored in (None, keep):
        got = legacy.fact_job_postings(norm, dims, every_salary, stored).collect()
        assert len({g.fact_id for g in got}) == len(got)
        assert sorted((tuple(g)[1:] for g in got), key=str) == sorted(want, key=str) and len(want) > 300
    assert kept == ["fact_priced", "fact_rows"]


def test_dim_jobs_in_parts_are_the_same_rows(spark):
    jobs = spark.createDataFrame([(i % 900, f"n{i % 7}", None) for i in range(1000)], "id long, name string, level string")
    linked = spark.createDataFrame([(i, i % 3) for i in range(900)] + [(i, 1) for i in range(900)], "job_id long, category_id long")
    categories = spark.createDataFrame([(0, "a"), (1, "b")], "id long, name string")
    whole = legacy.dim_jobs(jobs, linked, categories)
    parts = [legacy.dim_jobs(jobs, linked, categories, n, 3) for n in range(3)]
    shown = [sorted(map(tuple, d.drop("job_key").collect()), key=str) for d in (whole, *parts)]
    assert all(shown) and sorted(sum(shown[1:], []), key=str) == shown[0]
    ids = [{r.job_key for r in d.select("job_key").collect()} for d in (whole, *parts)]
    assert ids[0] == set().union(*ids[1:]) and len(ids[0]) == len(shown[0])
