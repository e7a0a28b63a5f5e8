"""Plan shapes and behaviour that matter for large and skewed data."""

import pytest
from pyspark.sql import functions as F

from jobgrain.operators import keys, rows
from jobgrain.operators.joins import lookup
from jobgrain.plans import legacy, serving, star
from jobgrain.schemas import STAR
from jobgrain.sources.warehouse import Warehouse

SMALL = {  # as if the data were far beyond every threshold
    "spark.sql.autoBroadcastJoinThreshold": "-1",
    "spark.sql.adaptive.autoBroadcastJoinThreshold": "-1",
    "spark.sql.adaptive.skewJoin.skewedPartitionThresholdInBytes": "100KB",
    "spark.sql.adaptive.advisoryPartitionSizeInBytes": "50KB",
    "spark.sql.shuffle.partitions": "16",
}


@pytest.fixture
def no_broadcast(spark):
    old = {k: spark.conf.get(k, None) for k in SMALL}
    for k, v in SMALL.items():
        spark.conf.set(k, v)
    yield spark
    for k, v in old.items():
        if v is None:
            spark.conf.unset(k)
        else:
            spark.conf.set(k, v)


def hot(spark, n=300_000):
    """A third of all rows share the key 0."""
    i = F.col("id")
    return spark.range(0, n, 1, 8).select(
        F.when(i % 3 == 0, 0).otherwise(i % 20_000).alias("k"),
        F.md5(i.cast("string")).alias("payload"),
    )


def final_plan(df):
    df.collect()
    return df._jdf.queryExecution().executedPlan().toString()


@pytest.mark.parametrize("how", ["inner", "left"])
def test_a_hot_key_is_split_in_lookups(no_broadcast, how):
    spark = no_broadcast
    names = spark.range(20_000).select(F.col("id").alias("key"), F.md5(F.col("id").cast("string")).alias("name"))
    joined = lookup(hot(spark), names, [("k", "key")], {"name": "name"}, how)
    plan = final_plan(joined)
    assert "skew=true" in plan and "Broadcast" not in plan
    assert joined.count() == 300_000


def test_a_hot_key_is_split_before_an_aggregate_on_it(no_broadcast):
    spark = no_broadcast
    names = spark.range(20_000).select(F.col("id").alias("key"), F.lit("x").alias("name"))
    joined = lookup(hot(spark), names, [("k", "key")], {"name": "name"})
    counted = joined.groupBy("k").agg(F.count(F.lit(1)).alias("n"), F.max("payload").alias("p"))
    assert "skew=true" in final_plan(counted)
    assert counted.where("k = 0").first().n == 100_000 + len([i for i in range(300_000) if i % 3 and i % 20_000 == 0])


def test_a_hot_key_is_split_in_the_anti_join(no_broadcast):
    spark = no_broadcast
    known = spark.range(10_000, 20_000).select(F.col("id").alias("k"))
    new = keys.absent_from(hot(spark), known, ["k"])
    assert "skew=true" in final_plan(new)


def test_a_hot_key_is_split_beside_a_grouped_side(no_broadcast):
    spark = no_broadcast
    salaries = spark.range(40_000).selectExpr(
        "id AS id", "id % 20000 AS company_id", "id % 20000 AS location_id", "1L AS level_id",
        "1L AS category_id", "'t' AS title", "1 AS load_batch", "1.0D AS salary_min", "2.0D AS salary_max",
    )
    match = ["company_id", "location_id", "level_id", "category_id"]
    newest = star.newest_salaries(salaries).hint("rebalance")
    posts = hot(spark).selectExpr(
        "k AS company_id", "k AS location_id", "1L AS level_id", "1L AS category_id", "payload"
    )
    paid = lookup(posts, newest, [(c, c) for c in match], {"salary_min": "salary_min"}, "left")
    assert "skew=true" in final_plan(paid)
    raw = hot(spark).selectExpr(
        "monotonically_increasing_id() AS job_id", "k AS company_id", "payload AS job_name", "'x' AS level",
        "TIMESTAMP'2025-01-01' AS publication_date",
    )
    companies = spark.range(20_000).selectExpr("id", "'n' AS name")
    assert "skew=true" in final_plan(legacy.jobs(raw, companies))


def test_counted_postings_are_reduced_before_the_dimension_is_joined(no_broadcast):
    from workload.postings import model

    df = serving.job_count(model(no_broadcast, "/root/testdata/sf0.001"), "company_name")
    plan = df._jdf.queryExecution().optimizedPlan().toString()
    assert plan.rindex("Aggregate") > plan.index("Join")


def test_first_per_key_is_reduced_before_the_shuffle(spark):
    df = rows.keep_first(hot(spark).withColumn("o", F.monotonically_increasing_id()), ["k"], "o")
    plan = df._jdf.queryExecution().sparkPlan().toString()
    assert "partial_min_by" in plan and "Window" not in plan


def test_numbering_is_one_shuffle(spark):
    df = spark.read.parquet("/root/testdata/sf0.001/orders.parquet").select("o_orderkey")
    numbered = keys.with_ids(df, ["o_orderkey"], "id", 7)
    plan = numbered._jdf.queryExecution().executedPlan().toString()
    assert plan.count("Exchange") == 1 and "SinglePartition" not in plan


def test_numbering_shuffles_eight_bytes_of_the_digest(spark):
    df = spark.read.parquet("/root/testdata/sf0.001/orders.parquet").select("o_orderkey")
    sizes = keys.with_ids(df, ["o_orderkey"], "id")._jdf.queryExecution().sparkPlan()
    while "Window" not in sizes.nodeName():
        sizes = sizes.children().apply(0)
    shuffled = sizes.children().apply(0).schema()
    assert [shuffled.apply(i).dataType().simpleString() for i in range(shuffled.size())] == ["bigint", "binary", "bigint"]


def test_postings_of_the_older_fact_are_shuffled_only_where_they_may_be_paid(no_broadcast):
    spark, kept = no_broadcast, {}
    rows = [(i, i % 50, i % 3) for i in range(1000)]
    norm = {
        "jobs": spark.createDataFrame([(j, c, None) for j, c, _ in rows], "id long, company_id long, publication_date timestamp_ntz"),
        "jobs_locations": spark.createDataFrame([(j, p) for j, _, _ in rows for p in range(20)], "job_id long, location_id long"),
        "salaries": spark.createDataFrame([(c, c % 20, 1.0, None) for c in range(50)], "company_id long, location_id long, salary_min double, salary_max double"),
        "locations": spark.createDataFrame([(p, f"c{p}", "s", "t") for p in range(20)], "id long, city string, subdivision_code string, country_code string"),
    }
    dims = {
        "dim_locations": norm["locations"].toDF("location_key", "city", "state", "country"),
        "dim_date": spark.createDataFrame([], "date_key long, full_date date"),
        "dim_companies": spark.range(50).selectExpr("id AS company_key", "id AS company_id"),
        "dim_jobs": spark.range(1000).selectExpr("id AS job_key", "id AS job_id"),
    }

    def keep(name, df):
        kept[name] = df
        return df

    fact = legacy.fact_job_postings(norm, dims, every_salary=True, keep=keep)
    assert fact.count() == 1000
    final = final_plan(kept["fact_rows"])
    assert "hashpartitioning(job_key" not in final  # distinct where the rows lie
    plan = kept["fact_priced"]._jdf.queryExecution().optimizedPlan().toString()
    joins = [line for line in plan.splitlines() if "Join Inner" in line]
    assert len(joins) == 3 and "& " in joins[1] and "shiftleft" in joins[1]  # jobs with their places


def test_the_salary_dimension_is_joined_after_the_sums(no_broadcast):
    from workload.postings import model

    df = serving.salary_stats(model(no_broadcast, "/root/testdata/sf0.001"), "company_name")
    plan = df._jdf.queryExecution().optimizedPlan().toString()
    assert plan.count("Aggregate") == 2
    assert plan.rindex("Aggregate") > plan.index("Join")  # one of them below the join


def test_date_filters_read_only_their_months(spark, tmp_path):
    store = Warehouse(spark, str(tmp_path), "run_1")
    days = spark.sql("SELECT explode(sequence(DATE'2024-01-01', DATE'2025-12-31')) AS publication_date")
    dates = store.append("star.dim_date", star.dim_date([days], spark.createDataFrame([], STAR["dim_date"])))
    fact = dates.selectExpr(
        "date_key AS fact_id", "date_key AS job_key", "1L AS company_key", "1L AS location_key", "date_key",
        "1L AS category_key", "1L AS level_key", "1.0D AS salary_min", "2.0D AS salary_max", "year", "month",
    )
    store.append("star.fact_job_postings", fact)
    level = spark.createDataFrame([(1, 1, "Mid Level")], STAR["dim_levels"])
    store.append("star.dim_levels", level)
    model = serving.star_model({name: store.table(f"star.{name}") for name in STAR})
    spark.conf.set("spark.sql.maxMetadataStringLength", "2000")
    asked = serving.job_count(model, "entry_level", start_date="2024-11-15", end_date="2025-01-31")
    assert [tuple(r) for r in asked.collect()] == [("Mid Level", 16 + 31 + 31)]
    plan = asked._jdf.queryExecution().executedPlan().toString()
    spark.conf.unset("spark.sql.maxMetadataStringLength")
    scan = next(line for line in plan.splitlines() if "FileScan" in line and "job_key" in line)
    pruned = scan.split("PartitionFilters: [")[1].split("]")[0]
    assert "(((year#" in pruned and "<=" in pruned and ">=" in pruned


def test_no_cross_join_or_python_in_the_workload(spark):
    import __spark_entry__ as entry

    python_allowed = {"title_category", "clean_salaries"}
    for name in ("job_count_filtered", "salary_stats_filtered", "free_text_locations", "clean_jobs",
                 "clean_salaries", "title_category", "surrogate_ids", "place_join_null_safe", "lateral_top1",
                 "insert_if_absent", "folded_left_join", "orphans"):
        df = entry.queries()[name](spark, "/root/testdata/sf0.001")
        plan = df._jdf.queryExecution().sparkPlan().toString()
        assert "CartesianProduct" not in plan and "NestedLoop" not in plan, name
        assert ("Python" in plan) == (name in python_allowed), name
