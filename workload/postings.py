"""Serving queries. The roles: a line item is a posting, its part the job, its
supplier the company, and the supplier's nation and region the place."""

from __future__ import annotations

from pyspark.sql import functions as F

from jobgrain.plans import serving
from workload.common import as_double, table


def _size(balance):
    return (
        F.when(balance < 3000, "Small Size").when(balance < 7000, "Medium Size").otherwise("Large Size")
    )


def _companies(spark, sf):
    nation, region = table(spark, sf, "nation"), table(spark, sf, "region")
    k = F.col("n_nationkey")
    return (
        table(spark, sf, "supplier")
        .join(nation, F.col("s_nationkey") == k)
        .join(region, F.col("n_regionkey") == F.col("r_regionkey"))
        .select(
            "s_suppkey",
            F.col("s_name").alias("name"),
            F.concat(F.lit("Industry "), (k % 6).cast("string")).alias("industry"),
            _size(F.col("s_acctbal")).alias("size"),
            F.col("n_name").alias("city"),
            F.when(k % 3 != 0, F.concat(F.lit("S"), (k % 7).cast("string"))).alias("state"),
            F.col("r_name").alias("country"),
        )
    )


def model(spark, sf) -> serving.PostingModel:
    price = F.col("l_extendedprice")
    number = F.col("l_linenumber")
    fact = table(spark, sf, "lineitem").select(
        "l_partkey",
        "l_suppkey",
        F.to_date("l_shipdate").alias("day"),
        F.when(~number.isin(5, 7), price * (1 - F.col("l_discount"))).alias("salary_min"),
        F.when(~number.isin(6, 7), price).alias("salary_max"),
    )
    return serving.PostingModel(
        fact=fact,
        lookups={
            "job": serving.Lookup(table(spark, sf, "part"), "l_partkey", "p_partkey"),
            "company": serving.Lookup(_companies(spark, sf), "l_suppkey", "s_suppkey"),
        },
        attributes={
            "job_id": (None, "l_partkey"),
            "date": (None, "day"),
            "salary_min": (None, "salary_min"),
            "salary_max": (None, "salary_max"),
            "job_title": ("job", "p_name"),
            "job_category": ("job", "p_brand"),
            "entry_level": ("job", "p_type"),
            "company_name": ("company", "name"),
            "company_industry": ("company", "industry"),
            "company_size": ("company", "size"),
            "country": ("company", "country"),
            "subdivision": ("company", "state"),
            "city": ("company", "city"),
        },
    )


SALARY_COLUMNS = ["avg_salary", "min_salary", "max_salary"]


def _count(dimension, **filters):
    return lambda spark, sf: serving.job_count(model(spark, sf), dimension, **filters)


def _stats(dimension, **filters):
    return lambda spark, sf: as_double(
        serving.salary_stats(model(spark, sf), dimension, **filters), *SALARY_COLUMNS
    )


# The same postings as one wide SQL view.
POSTING = """
  SELECT l_partkey AS job_id, p_name AS job_title, p_brand AS job_category,
    p_type AS entry_level, s_name AS company_name,
    'Industry ' || (n_nationkey % 6) AS company_industry,
    CASE WHEN s_acctbal < 3000 THEN 'Small Size' WHEN s_acctbal < 7000 THEN 'Medium Size'
      ELSE 'Large Size' END AS company_size,
    n_name AS city, r_name AS country,
    CASE WHEN n_nationkey % 3 <> 0 THEN 'S' || (n_nationkey % 7) END AS subdivision,
    CAST(l_shipdate AS DATE) AS date,
    CASE WHEN l_linenumber NOT IN (5, 7) THEN l_extendedprice * (1 - l_discount) END AS salary_min,
    CASE WHEN l_linenumber NOT IN (6, 7) THEN l_extendedprice END AS salary_max
  FROM lineitem JOIN part ON l_partkey = p_partkey JOIN supplier ON l_suppkey = s_suppkey
    JOIN nation ON s_nationkey = n_nationkey JOIN region ON n_regionkey = r_regionkey
"""


def _count_sql(dimension, where="TRUE"):
    return (
        f"WITH posting AS ({POSTING}) SELECT {dimension}, count(DISTINCT job_id) AS job_count "
        f"FROM posting WHERE {where} GROUP BY {dimension}"
    )


def _stats_sql(dimension, where="TRUE"):
    return f"""WITH posting AS ({POSTING})
      SELECT {dimension},
        CAST(round(CAST(avg((salary_min + salary_max) / 2) AS DECIMAL(38,6)), 0) AS DOUBLE) AS avg_salary,
        CAST(round(CAST(min(salary_min) AS DECIMAL(38,6)), 0) AS DOUBLE) AS min_salary,
        CAST(round(CAST(max(salary_max) AS DECIMAL(38,6)), 0) AS DOUBLE) AS max_salary,
        count(job_id) AS job_x_location_count
      FROM posting WHERE (salary_min IS NOT NULL OR salary_max IS NOT NULL) AND {where}
      GROUP BY {dimension}"""


QUERIES = {f"job_count_by_{d}": _count(d) for d in serving.COUNT_DIMENSIONS}
SQL = {f"job_count_by_{d}": _count_sql(d) for d in serving.COUNT_DIMENSIONS}
QUERIES |= {f"salary_stats_by_{d}": _stats(d) for d in serving.SALARY_DIMENSIONS}
SQL |= {f"salary_stats_by_{d}": _stats_sql(d) for d in serving.SALARY_DIMENSIONS}

QUERIES["job_count_filtered"] = _count(
    "city",
    country="asia", company_size="medium SIZE", start_date="1996-01-01", end_date="1999-12-31",
    job_category="brand#7", job_title="ring",
)
SQL["job_count_filtered"] = _count_sql(
    "city",
    "lower(country) = lower('asia') AND lower(company_size) = lower('medium SIZE') "
    "AND date >= DATE '1996-01-01' AND date <= DATE '1999-12-31' "
    "AND lower(job_category) = lower('brand#7') AND job_title ILIKE '%ring%'",
)
QUERIES["job_count_place_filters"] = _count(
    "entry_level", subdivision="s4", city="nation_4", entry_level="promo", job_title=""
)
SQL["job_count_place_filters"] = _count_sql(
    "entry_level",
    "lower(subdivision) = 's4' AND lower(city) = 'nation_4' AND lower(entry_level) = 'promo'",
)
QUERIES["job_count_title_wildcards"] = _count("job_category", job_title="L%_ R_d")
SQL["job_count_title_wildcards"] = _count_sql("job_category", "job_title ILIKE '%L%_ R_d%'")
QUERIES["salary_stats_filtered"] = _stats(
    "company_size", country="EUROPE", entry_level="Standard", start_date="1997-06-01"
)
SQL["salary_stats_filtered"] = _stats_sql(
    "company_size",
    "lower(country) = 'europe' AND lower(entry_level) = 'standard' AND date >= DATE '1997-06-01'",
)


def _star_tables(spark, sf):
    """The named queries read these tables."""
    companies = _companies(spark, sf)
    return {
        "fact_job_postings": model(spark, sf).fact,
        "dim_categories": table(spark, sf, "part").select(F.col("p_brand").alias("name")),
        "dim_levels": table(spark, sf, "part").select(F.col("p_type").alias("level")),
        "dim_locations": companies.select("country", "state", "city"),
        "dim_companies": companies.select("size"),
    }


for _name in serving.NAMED:
    QUERIES[f"named_{_name}"] = lambda spark, sf, n=_name: serving.named_query(
        n, _star_tables(spark, sf)
    )
SQL["named_job_categories"] = "SELECT DISTINCT p_brand AS category FROM part ORDER BY 1"
SQL["named_job_entry_level"] = "SELECT DISTINCT p_type AS level FROM part ORDER BY 1"
SQL["named_salary_range"] = (
    f"SELECT min(salary_min) AS min_salary, max(salary_max) AS max_salary FROM ({POSTING})"
)
SQL["named_job_locations"] = """
  SELECT DISTINCT r_name AS country,
    CASE WHEN n_nationkey % 3 <> 0 THEN 'S' || (n_nationkey % 7) END AS state, n_name AS city
  FROM supplier JOIN nation ON s_nationkey = n_nationkey JOIN region ON n_regionkey = r_regionkey
  ORDER BY country NULLS LAST, state NULLS LAST, city NULLS LAST"""
SQL["named_company_size"] = """
  SELECT DISTINCT CASE WHEN s_acctbal < 3000 THEN 'Small Size'
    WHEN s_acctbal < 7000 THEN 'Medium Size' ELSE 'Large Size' END AS size
  FROM supplier ORDER BY 1"""


def sql_over_views(spark, sf):
    """Free SQL over the serving views, with bound parameters."""
    serving.register_views(model(spark, sf))
    return spark.sql(
        """SELECT p.job_category, p.postings, CAST(round(s.total, 2) AS DOUBLE) AS total_salary
           FROM (SELECT job_category, count(*) AS postings FROM v_job_postings
                 WHERE lower(country) = lower(:country) GROUP BY job_category) p
           JOIN (SELECT job_category, sum(CAST(salary_max AS DECIMAL(18,2))) AS total
                 FROM v_job_salaries
                 WHERE lower(country) = lower(:country) GROUP BY job_category) s
             USING (job_category)""",
        args={"country": "Asia"},
    )


QUERIES["sql_over_views"] = sql_over_views
SQL["sql_over_views"] = f"""WITH posting AS ({POSTING})
  SELECT job_category, count(*) AS postings,
    CAST(sum(CAST(salary_max AS DECIMAL(18,2))) AS DOUBLE) AS total_salary
  FROM posting WHERE lower(country) = 'asia' GROUP BY job_category"""


def result_meta(spark, sf):
    """Row count of an answer, per metric, as the answer's description holds it."""
    m = model(spark, sf)
    one = serving.job_count(m, "city", country="asia")
    two = serving.salary_stats(m, "company_name", country="asia")
    return serving.row_count(one, "city", "job_count").unionByName(
        serving.row_count(two, "company_name", "salary metrics")
    )


QUERIES["result_meta"] = result_meta
SQL["result_meta"] = f"""WITH posting AS ({POSTING})
  SELECT 'city' AS dimension, 'job_count' AS metric, count(DISTINCT city) AS row_count
  FROM posting WHERE lower(country) = 'asia'
  UNION ALL
  SELECT 'company_name', 'salary metrics', count(DISTINCT company_name)
  FROM posting WHERE lower(country) = 'asia'
    AND (salary_min IS NOT NULL OR salary_max IS NOT NULL)"""
