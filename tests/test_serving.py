import datetime as dt

import pytest

from jobgrain.plans import serving


@pytest.fixture(scope="module")
def tables(spark):
    make = spark.createDataFrame
    day = dt.date
    return {
        "fact_job_postings": make(
            [
                (1, 1, 1, 1, 1, 1, 100.0, 201.0),
                (2, 1, 1, 2, 1, 1, 100.0, None),
                (3, 2, 1, None, 2, 2, None, None),
                (4, 3, 2, 2, 2, 1, 50.0, 60.0),
            ],
            "fact_id int, job_key bigint, company_key bigint, location_key bigint, date_key bigint, "
            "level_key bigint, salary_min double, salary_max double",
        ).selectExpr("*", "level_key AS category_key", "2025 AS year", "CAST(date_key AS INT) AS month"),
        "dim_jobs": make([(1, 11, "Data Dev"), (2, 12, "Support"), (3, 13, "dev_ops")], "job_key bigint, job_id bigint, name string"),
        "dim_companies": make(
            [(1, 1, "Acme", None, "Large Size", "Tech"), (2, 2, "Zed", None, None, None)],
            "company_key bigint, company_id bigint, name string, description string, size string, industry string",
        ),
        "dim_categories": make([(1, 1, "b"), (2, 2, "a"), (3, 3, None)], "category_key bigint, category_id bigint, name string"),
        "dim_levels": make([(1, 1, "Senior Level"), (2, 2, "Mid Level")], "level_key bigint, level_id bigint, level string"),
        "dim_locations": make(
            [(1, "Austin", "US-TX", "US"), (2, "Berlin", None, "DE"), (3, None, "x", "US")],
            "location_key bigint, city string, state string, country string",
        ),
        "dim_date": make(
            [(1, day(2025, 1, 1), 1, 1, 2025), (2, day(2025, 2, 1), 1, 2, 2025)],
            "date_key bigint, full_date date, day int, month int, year int",
        ),
    }


@pytest.fixture(scope="module")
def model(tables):
    return serving.star_model(tables)


def rows(df):
    return [tuple(r) for r in df.collect()]


def test_count_per_city_counts_jobs_once_and_keeps_null(model):
    assert rows(serving.job_count(model, "city")) == [("Berlin", 2), ("Austin", 1), (None, 1)]


def test_ties_are_ordered_by_value_with_null_last(model):
    assert rows(serving.job_count(model, "subdivision")) == [(None, 3), ("US-TX", 1)]
    assert rows(serving.job_count(model, "company_size", city="berlin")) == [("Large Size", 1), (None, 1)]


@pytest.mark.parametrize(
    "filters, want",
    [
        ({"country": "us"}, 1),
        ({"country": "", "city": None}, 3),
        ({"job_title": "DEV"}, 2),
        ({"job_title": "v_o"}, 1),
        ({"start_date": "2025-02-01"}, 2),
        ({"end_date": "2025-01-31", "entry_level": "senior level"}, 1),
        ({"company_size": "large size", "job_category": "A"}, 1),
        ({"subdivision": "us-tx"}, 1),
        ({"job_title": "no such"}, 0),
    ],
)
def test_filters(model, filters, want):
    assert sum(r.job_count for r in serving.job_count(model, "job_category", **filters).collect()) == want


def test_salary_stats(model):
    got = rows(serving.salary_stats(model, "company_name"))
    # the row without a maximum counts, but not for the mean; (100 + 201) / 2 = 150.5
    assert [(n, int(a), int(b), int(c), k) for n, a, b, c, k in got] == [
        ("Acme", 151, 100, 201, 2), ("Zed", 55, 50, 60, 1),
    ]
    only_half = rows(serving.salary_stats(model, "city", company_size="large size", start_date="2025-01-01", city="berlin"))
    assert only_half == [("Berlin", None, 100, None, 1)]


def test_rejected_requests(model):
    for call in (
        lambda: serving.job_count(model, "salary_min"),
        lambda: serving.salary_stats(model, "job_category"),
        lambda: serving.job_count(model, "city", start_date="2025-02-01", end_date="2025-01-01"),
        lambda: serving.job_count(model, "city", planet="earth"),
        lambda: serving.named_query("nothing", {}),
    ):
        with pytest.raises(ValueError):
            call()


def test_named_queries(tables):
    got = {name: rows(serving.named_query(name, tables)) for name in serving.NAMED}
    assert got == {
        "job_categories": [("a",), ("b",)],
        "salary_range": [(50.0, 201.0)],
        "job_locations": [("DE", None, "Berlin"), ("US", "US-TX", "Austin")],
        "job_entry_level": [("Mid Level",), ("Senior Level",)],
        "company_size": [("Large Size",)],
    }


def test_answer(model):
    given = {"country": "us", "city": None}
    answer = serving.answer(serving.job_count(model, "city", **given), "city", "job_count", **given)
    assert [r.asDict() for r in answer["meta"].collect()] == [
        {
            "dimension": "city", "metric": "job_count", "aggregation": "count_distinct",
            "filters": {"country": "us"}, "row_count": 1,
        }
    ]
    assert [r.asDict() for r in answer["data"].collect()] == [{"city": "Austin", "job_count": 1}]


def test_views(spark, model):
    serving.register_views(model)
    assert spark.table("v_job_postings").count() == 4
    assert spark.table("v_job_salaries").count() == 3
    assert spark.table("v_job_postings").columns == serving.VIEW_ATTRIBUTES


def plan(df):
    return df._jdf.queryExecution().executedPlan().toString()


def test_a_query_joins_only_what_it_needs(model):
    text = plan(serving.job_count(model, "entry_level"))
    assert text.count("Join") == 1
    assert "Join" not in plan(serving.named_query("salary_range", {"fact_job_postings": model.fact}))
    filtered = plan(serving.job_count(model, "company_name", company_size="x", country="us"))
    assert filtered.count("LeftSemi") == 2
    assert "NestedLoop" not in filtered and "Cartesian" not in filtered
