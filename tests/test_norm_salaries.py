"""Salaries of companies that share a name."""

from jobgrain.plans import norm
from jobgrain.schemas import NORM


def test_salaries_are_reduced_before_companies_of_one_name_join(spark):
    raw = spark.createDataFrame(
        [(name, " Dev ", 10.0 + n, 20.0, " Mid ", "IT", "A", "S", "C")
         for n in range(4) for name in ("Acme", " ACME ", None)]
        + [("acme", "Dev", 1.0, 2.0, None, "x", "A", "S", "C"), ("acme", "Dev", 0.5, 2.0, "y", None, "A", "S", "C")]
        + [("acme", "Dev", 1.0, 2.0, "Mid", "IT", "", "S", "C"), ("acme", "Dev", 1.0, 2.0, "Mid", "IT", "A", None, "C")],
        "company_name string, adz_job_name string, salary_min double, salary_max double, level string, "
        "categories string, location_city string, location_state string, location_country string",
    )
    companies = spark.createDataFrame(
        [(i, "d", "Acme", None, "s") for i in (1, 2)] + [(3, "d", None, None, "s")], NORM["companies"]
    )
    levels = spark.createDataFrame([(1, "Mid")], NORM["levels"])
    categories = spark.createDataFrame([(1, "IT")], NORM["categories"])
    locations = spark.createDataFrame([(1, "A", "S", "C"), (2, "A", None, "C")], "id bigint, city string, subdivision_code string, country_code string")
    found = norm.salaries(
        raw, companies, levels, categories, locations, spark.createDataFrame([], NORM["salaries"])
    )
    got = {(r.company_id, r.location_id, r.title, r.salary_min, r.salary_max, r.level_id, r.category_id) for r in found.collect()}
    assert got == {
        (c, 1, "Dev", low, high, *labels)
        for c in (1, 2) for low, high, *labels in ((10.0, 20.0, 1, 1), (0.5, 2.0, None, None))
    }
    assert found.count() == 4
    plan = found._jdf.queryExecution().optimizedPlan().toString()
    assert plan.count("min(struct(salary_min") == 2  # below the join by name, and above it
