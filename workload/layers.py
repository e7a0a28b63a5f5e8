"""The three layers, built through the batch job from tables in the roles of
companies (supplier), jobs (orders) and salaries (line items). Results are shown
with natural keys in place of surrogate ids."""

from __future__ import annotations

from pyspark.sql import functions as F

from jobgrain.operators.joins import lookup
from jobgrain.operators.quality import duplicate_keys, orphans, row_counts, violations
from jobgrain.plans import pipeline, raw, serving
from jobgrain.schemas import FOREIGN_KEYS, NORM, STAR, UNIQUE_KEYS
from jobgrain.session import shared_dir
from jobgrain.sources.warehouse import Warehouse
from workload.common import as_double, table

QUERIES, SQL = {}, {}


def query(sql: str | None = None):
    def add(fn):
        QUERIES[fn.__name__] = fn
        if sql:
            SQL[fn.__name__] = sql
        return fn

    return add


# --- cleaned tables -------------------------------------------------------------------


def _place(key: str, upper: bool = False):
    k = F.expr(key)
    city = F.concat(F.lit("City "), (k % 20).cast("string"))
    if upper:
        city = F.when(k % 10 == 4, F.upper(city)).otherwise(city)
    return F.struct(
        F.concat(F.lit("C"), (k % 5).cast("string")).alias("country_code"),
        F.when(k % 3 != 0, F.concat(F.lit("S"), (k % 7).cast("string"))).alias("subdivision_code"),
        city.alias("city"),
    )



def cleaned_companies(spark, sf):
    remote = F.expr(
        "named_struct('country_code', 'Flexible/Remote', 'subdivision_code', 'Flexible/Remote', "
        "'city', 'Flexible/Remote')"
    )
    k = F.col("s_nationkey")
    here = _place("s_nationkey", upper=True)
    industries = F.expr(
        "array(named_struct('name', 'Ind ' || (s_nationkey % 4)), named_struct('name', "
        "CASE WHEN s_nationkey % 3 = 0 THEN ' ' ELSE 'Ind ' || (s_nationkey % 3) END))"
    )
    return table(spark, sf, "supplier").select(
        F.col("s_suppkey").alias("company_id"),
        F.col("s_name").alias("company_name"),
        F.concat(F.lit("about "), "s_name").alias("description"),
        F.date_add(F.lit("2024-01-01").cast("date"), k).cast("timestamp").alias("publication_date"),
        F.when(F.col("s_acctbal") < 5000, "Small Size").otherwise("Large Size").alias("size"),
        F.when(k % 5 == 0, F.lit(None))
        .when(k % 4 == 1, F.array(here, remote))
        .otherwise(F.array(here))
        .alias("locations"),
        F.when(k % 6 != 0, industries).alias("industries"),
    )


def cleaned_jobs(spark, sf):
    orders = table(spark, sf, "orders")
    customer = table(spark, sf, "customer")
    k = F.col("c_nationkey")
    return orders.join(customer, F.col("o_custkey") == F.col("c_custkey")).select(
        F.col("o_orderkey").alias("job_id"),
        F.floor(F.col("o_custkey") / 12).alias("company_id"),
        F.concat_ws(" ", "o_orderpriority", "o_orderstatus").alias("job_name"),
        F.expr(
            "CASE WHEN o_orderpriority = '5-LOW' THEN NULL WHEN o_orderstatus = 'F' THEN ' Senior Level' "
            "WHEN o_orderstatus = 'O' THEN 'Mid Level' ELSE 'Entry Level ' END"
        ).alias("level"),
        F.col("o_orderdate").cast("timestamp").alias("publication_date"),
        F.when(k % 8 != 0, F.array(_place("c_nationkey"), _place("(c_nationkey + 7) % 25"))).alias(
            "locations"
        ),
        F.expr(
            "CASE o_orderpriority WHEN '1-URGENT' THEN 'Software Engineering' "
            "WHEN '3-MEDIUM' THEN ' Computer and IT ' WHEN '4-NOT SPECIFIED' THEN NULL "
            "ELSE 'Data and Analytics' END"
        ).alias("categories"),
    )


def cleaned_salaries(spark, sf):
    line, supplier = table(spark, sf, "lineitem"), table(spark, sf, "supplier")
    n = F.col("l_linenumber")
    place = _place("(s_nationkey + l_linenumber) % 25")
    return line.join(supplier, F.col("l_suppkey") == F.col("s_suppkey")).select(
        F.col("l_orderkey").alias("adz_job_id"),
        F.when(n % 4 == 0, F.upper("s_name"))
        .when(n % 4 == 1, F.concat(F.lit(" "), "s_name", F.lit(" ")))
        .when(n % 4 == 2, F.col("s_name"))
        .otherwise("Nobody")
        .alias("company_name"),
        F.expr("' Title ' || (l_partkey % 5) || ' '").alias("adz_job_name"),
        F.lit("IT Jobs").alias("adz_category"),
        F.col("l_shipdate").cast("timestamp").alias("publication_date"),
        F.when(n != 7, F.array(place)).alias("locations"),
        F.col("l_extendedprice").alias("salary_min"),
        (F.col("l_extendedprice") + F.col("l_quantity")).alias("salary_max"),
        F.lit(0).alias("salary_is_predicted"),
        F.expr(
            "CASE l_linenumber % 3 WHEN 0 THEN 'Software Engineering ' WHEN 1 THEN 'Data and Analytics' END"
        ).alias("categories"),
        F.expr("CASE l_returnflag WHEN 'A' THEN 'Senior Level' WHEN 'N' THEN 'Mid Level' END").alias(
            "level"
        ),
    )


def load(spark, sf) -> Warehouse:
    """Load the layers into a new warehouse."""
    store = Warehouse(spark, shared_dir(spark, "layers"), "run_1")
    cleaned = {
        "companies": cleaned_companies(spark, sf),
        "jobs": cleaned_jobs(spark, sf),
        "salaries": cleaned_salaries(spark, sf),
    }
    pipeline.load(store, cleaned)
    return store


_built: dict[tuple, Warehouse] = {}


def warehouse(spark, sf) -> Warehouse:
    """The layers for one scale factor, loaded once per session."""
    key = (spark.sparkContext.applicationId, sf)
    if key not in _built:
        _built[key] = load(spark, sf)
    return _built[key]


def loaded_again(spark, sf) -> Warehouse:
    """Three loads of one warehouse: the jobs and salaries of even orders, then
    everything (so jobs with new places, later salaries, known companies), then
    everything once more."""
    key = (spark.sparkContext.applicationId, sf, "again")
    if key not in _built:
        root = shared_dir(spark, "layers_again")
        companies, jobs = cleaned_companies(spark, sf), cleaned_jobs(spark, sf)
        salaries = cleaned_salaries(spark, sf)
        some = {
            "companies": companies.where("company_id % 3 <> 0"),
            "jobs": jobs.where("job_id % 2 = 0"),
            "salaries": salaries.where("adz_job_id % 2 = 0"),
        }
        every = {"companies": companies, "jobs": jobs, "salaries": salaries}
        for run, cleaned in (("run_1", some), ("run_2", every), ("run_3", every)):
            _built[key] = Warehouse(spark, root, run)
            pipeline.load(_built[key], cleaned)
    return _built[key]


# --- the same in SQL ---------------------------------------------------------------------


def _city(k: str) -> str:
    return f"'City ' || (({k}) % 20)"


def _state(k: str) -> str:
    return f"CASE WHEN ({k}) % 3 <> 0 THEN 'S' || (({k}) % 7) END"


def _country(k: str) -> str:
    return f"'C' || (({k}) % 5)"


def _struct(k: str, city: str | None = None) -> str:
    return (
        f"{{'city': {city or _city(k)}, 'state': {_state(k)}, 'country': {_country(k)}}}"
    )


_REMOTE = "{'city': 'Flexible/Remote', 'state': 'Flexible/Remote', 'country': 'Flexible/Remote'}"
_HERE = _struct(
    "s_nationkey",
    f"CASE WHEN s_nationkey % 10 = 4 THEN upper({_city('s_nationkey')}) ELSE {_city('s_nationkey')} END",
)

RAW_SQL = f"""
raw_companies AS (
  SELECT company_id, company_name, description, publication_date, size, p.city AS location_city,
    p.state AS location_state, p.country AS location_country, industry_name FROM (
    SELECT *, unnest(industries) AS industry_name FROM (
      SELECT s_suppkey AS company_id, s_name AS company_name, 'about ' || s_name AS description,
        CAST(DATE '2024-01-01' + s_nationkey AS TIMESTAMP) AS publication_date,
        CASE WHEN s_acctbal < 5000 THEN 'Small Size' ELSE 'Large Size' END AS size,
        unnest(CASE WHEN s_nationkey % 5 = 0 THEN [NULL] WHEN s_nationkey % 4 = 1
          THEN [{_HERE}, {_REMOTE}] ELSE [{_HERE}] END) AS p,
        CASE WHEN s_nationkey % 6 = 0 THEN [NULL] ELSE ['Ind ' || (s_nationkey % 4),
          CASE WHEN s_nationkey % 3 = 0 THEN ' ' ELSE 'Ind ' || (s_nationkey % 3) END] END AS industries
      FROM supplier))),
raw_jobs AS (
  SELECT job_id, company_id, job_name, level, publication_date, p.city AS location_city,
    p.state AS location_state, p.country AS location_country, categories FROM (
    SELECT o_orderkey AS job_id, o_custkey // 12 AS company_id,
      o_orderpriority || ' ' || o_orderstatus AS job_name,
      CASE WHEN o_orderpriority = '5-LOW' THEN NULL WHEN o_orderstatus = 'F' THEN ' Senior Level'
        WHEN o_orderstatus = 'O' THEN 'Mid Level' ELSE 'Entry Level ' END AS level,
      CAST(o_orderdate AS TIMESTAMP) AS publication_date,
      unnest(CASE WHEN c_nationkey % 8 = 0 THEN [NULL]
        ELSE [{_struct('c_nationkey')}, {_struct('(c_nationkey + 7) % 25')}] END) AS p,
      CASE o_orderpriority WHEN '1-URGENT' THEN 'Software Engineering'
        WHEN '3-MEDIUM' THEN ' Computer and IT ' WHEN '4-NOT SPECIFIED' THEN NULL
        ELSE 'Data and Analytics' END AS categories
    FROM orders JOIN customer ON o_custkey = c_custkey)),
raw_salaries AS (
  SELECT *, CASE WHEN n <> 7 THEN {_city('k')} END AS location_city,
    CASE WHEN n <> 7 THEN {_state('k')} END AS location_state,
    CASE WHEN n <> 7 THEN {_country('k')} END AS location_country FROM (
    SELECT l_orderkey AS adz_job_id, (s_nationkey + l_linenumber) % 25 AS k, l_linenumber AS n,
      CASE l_linenumber % 4 WHEN 0 THEN upper(s_name) WHEN 1 THEN ' ' || s_name || ' '
        WHEN 2 THEN s_name ELSE 'Nobody' END AS company_name,
      ' Title ' || (l_partkey % 5) || ' ' AS adz_job_name, l_extendedprice AS salary_min,
      l_extendedprice + l_quantity AS salary_max, l_shipdate AS shipped,
      CASE l_linenumber % 3 WHEN 0 THEN 'Software Engineering ' WHEN 1 THEN 'Data and Analytics' END
        AS categories,
      CASE l_returnflag WHEN 'A' THEN 'Senior Level' WHEN 'N' THEN 'Mid Level' END AS level
    FROM lineitem JOIN supplier ON l_suppkey = s_suppkey))"""

NORM_SQL = f"""{RAW_SQL},
industries AS (SELECT DISTINCT industry_name AS name FROM raw_companies
  WHERE industry_name IS NOT NULL AND trim(industry_name, ' ') NOT IN ('', 'None')),
categories AS (SELECT DISTINCT trim(categories, ' ') AS name FROM raw_jobs
  WHERE categories IS NOT NULL AND trim(categories, ' ') NOT IN ('', 'None')),
levels AS (SELECT DISTINCT trim(level, ' ') AS level FROM (SELECT level FROM raw_jobs
  UNION SELECT level FROM raw_salaries) WHERE level IS NOT NULL AND trim(level, ' ') NOT IN ('', 'None')),
locations AS (SELECT DISTINCT location_city AS city, location_state AS state, location_country AS country
  FROM (SELECT location_city, location_state, location_country FROM raw_companies
    UNION ALL SELECT location_city, location_state, location_country FROM raw_jobs
    UNION ALL SELECT location_city, location_state, location_country FROM raw_salaries)
  WHERE location_city <> ''),
companies AS (SELECT DISTINCT company_id AS id, description, company_name AS name,
  CAST(publication_date AS DATE) AS publication_date, size FROM raw_companies),
companies_industries AS (SELECT DISTINCT company_id, name AS industry FROM raw_companies
  JOIN industries ON name = industry_name),
companies_locations AS (SELECT DISTINCT company_id, city, state, country FROM raw_companies
  JOIN locations ON city = location_city AND state = location_state AND country = location_country),
jobs AS (SELECT DISTINCT r.company_id, r.job_name AS name, l.level, c.name AS category,
    CAST(r.publication_date AS DATE) AS publication_date
  FROM raw_jobs r JOIN companies ON companies.id = r.company_id
    JOIN levels l ON l.level = trim(r.level, ' ') LEFT JOIN categories c ON c.name = r.categories),
jobs_locations AS (SELECT DISTINCT j.company_id, j.name, j.publication_date, city, state, country
  FROM raw_jobs r JOIN jobs j ON j.company_id = r.company_id AND j.name = r.job_name
    AND j.publication_date = CAST(r.publication_date AS DATE)
  JOIN locations ON city = location_city AND state = location_state AND country = location_country),
salaries AS (SELECT * EXCLUDE rn FROM (
  SELECT c.id AS company_id, city, state, country, trim(adz_job_name, ' ') AS title, salary_min,
    salary_max, l.level, k.name AS category, row_number() OVER (PARTITION BY c.id, city, state, country,
      trim(adz_job_name, ' '), l.level, k.name ORDER BY salary_min, salary_max) AS rn
  FROM raw_salaries s JOIN companies c ON lower(trim(c.name, ' ')) = lower(trim(s.company_name, ' '))
    JOIN locations ON city = location_city AND state = location_state AND country = location_country
    LEFT JOIN levels l ON l.level = trim(s.level, ' ')
    LEFT JOIN categories k ON k.name = trim(s.categories, ' ')) WHERE rn = 1)"""

STAR_SQL = f"""{NORM_SQL},
dim_companies AS (SELECT id AS company_id, name, description, size, min(industry) AS industry
  FROM companies LEFT JOIN companies_industries ON company_id = id GROUP BY ALL),
newest AS (SELECT * FROM salaries WHERE level IS NOT NULL AND category IS NOT NULL QUALIFY row_number()
  OVER (PARTITION BY company_id, city, state, country, level, category ORDER BY title DESC) = 1),
fact AS (SELECT * FROM (
  SELECT j.company_id, j.name AS job, j.publication_date, j.category, j.level, d.city, d.state,
    d.country, s.salary_min, s.salary_max
  FROM jobs j LEFT JOIN jobs_locations l ON l.company_id = j.company_id AND l.name = j.name
      AND l.publication_date = j.publication_date
    LEFT JOIN locations d ON lower(d.city) = lower(l.city) AND lower(d.state) = lower(l.state)
      AND lower(d.country) = lower(l.country)
    LEFT JOIN newest s ON s.company_id = j.company_id AND s.city = l.city AND s.state = l.state
      AND s.country = l.country AND s.level = j.level AND s.category = j.category
  WHERE j.category IS NOT NULL) QUALIFY row_number() OVER (PARTITION BY company_id, job,
    publication_date, category, level, city, state, country
    ORDER BY salary_min DESC NULLS LAST, salary_max DESC NULLS LAST) = 1)"""


def _sql(body: str, base: str = NORM_SQL) -> str:
    return f"WITH {base} {body}"


# --- raw -----------------------------------------------------------------------------------


@query(
    _sql(
        """SELECT company_id, company_name, description, CAST(publication_date AS DATE) AS publication_date,
             size, location_city, location_state, location_country, industry_name FROM raw_companies""",
        RAW_SQL,
    )
)
def raw_companies(spark, sf):
    rows = raw.raw_companies(cleaned_companies(spark, sf))
    return rows.withColumn("publication_date", F.to_date("publication_date"))


@query(
    _sql(
        """SELECT job_id, company_id, job_name, level, CAST(publication_date AS DATE) AS publication_date,
             location_city, location_state, location_country, categories FROM raw_jobs""",
        RAW_SQL,
    )
)
def raw_jobs(spark, sf):
    rows = raw.raw_jobs(cleaned_jobs(spark, sf))
    return rows.withColumn("publication_date", F.to_date("publication_date"))


@query(
    _sql(
        """SELECT adz_job_id, company_name, adz_job_name, 'IT Jobs' AS adz_category, CAST(shipped AS DATE)
             AS publication_date, location_city, location_state, location_country, salary_min, salary_max,
             CAST(0 AS INTEGER) AS salary_is_predicted, categories, level FROM raw_salaries""",
        RAW_SQL,
    )
)
def raw_salaries(spark, sf):
    rows = raw.raw_salaries(cleaned_salaries(spark, sf))
    return rows.withColumn("publication_date", F.to_date("publication_date"))


# --- normalized -------------------------------------------------------------------------------

PLACE = {"city": "city", "subdivision_code": "state", "country_code": "country"}


def _norm(spark, sf, name):
    return warehouse(spark, sf).table(f"norm.{name}")


for _name, _columns in {
    "industries": ["name"], "categories": ["name"], "levels": ["level"],
}.items():
    QUERIES[f"norm_{_name}"] = lambda spark, sf, n=_name, c=_columns: _norm(spark, sf, n).select(*c)
    SQL[f"norm_{_name}"] = _sql(f"SELECT {', '.join(_columns)} FROM {_name}")


@query(_sql("SELECT city, state, country FROM locations"))
def norm_locations(spark, sf):
    return _norm(spark, sf, "locations").select(*[F.col(a).alias(b) for a, b in PLACE.items()])


@query(_sql("SELECT id, description, name, publication_date, size FROM companies"))
def norm_companies(spark, sf):
    return _norm(spark, sf, "companies").withColumn("publication_date", F.to_date("publication_date"))


@query(_sql("SELECT company_id, industry FROM companies_industries"))
def norm_companies_industries(spark, sf):
    return lookup(
        _norm(spark, sf, "companies_industries"), _norm(spark, sf, "industries"),
        [("industry_id", "id")], {"name": "industry"},
    ).drop("industry_id")


@query(_sql("SELECT company_id, city, state, country FROM companies_locations"))
def norm_companies_locations(spark, sf):
    return lookup(
        _norm(spark, sf, "companies_locations"), _norm(spark, sf, "locations"),
        [("location_id", "id")], PLACE,
    ).drop("location_id")


def _labels(df, spark, sf):
    """Level and category names in place of their ids."""
    df = lookup(df, _norm(spark, sf, "levels"), [("level_id", "id")], {"level": "level"}, "left")
    df = lookup(df, _norm(spark, sf, "categories"), [("category_id", "id")], {"name": "category"}, "left")
    return df.drop("level_id", "category_id")


@query(_sql("SELECT company_id, name, level, category, publication_date FROM jobs"))
def norm_jobs(spark, sf):
    jobs = _labels(_norm(spark, sf, "jobs").drop("id"), spark, sf)
    return jobs.withColumn("publication_date", F.to_date("publication_date"))


@query(_sql("SELECT company_id, name, publication_date, city, state, country FROM jobs_locations"))
def norm_jobs_locations(spark, sf):
    placed = lookup(
        _norm(spark, sf, "jobs_locations"), _norm(spark, sf, "locations"), [("location_id", "id")], PLACE
    )
    named = lookup(
        placed, _norm(spark, sf, "jobs"), [("job_id", "id")],
        {"company_id": "company_id", "name": "name", "publication_date": "publication_date"},
    )
    return named.drop("job_id", "location_id").withColumn(
        "publication_date", F.to_date("publication_date")
    )


@query(
    _sql(
        """SELECT company_id, city, state, country, title, salary_min, salary_max, level, category
           FROM salaries"""
    )
)
def norm_salaries(spark, sf):
    placed = lookup(
        _norm(spark, sf, "salaries"), _norm(spark, sf, "locations"), [("location_id", "id")], PLACE
    )
    return _labels(placed, spark, sf).drop("id", "location_id", "load_batch")


# --- star ---------------------------------------------------------------------------------------


def _star(spark, sf, name):
    return warehouse(spark, sf).table(f"star.{name}")


@query(_sql("SELECT * FROM dim_companies", STAR_SQL))
def star_dim_companies(spark, sf):
    return _star(spark, sf, "dim_companies").drop("company_key")


@query(_sql("SELECT company_id, name, publication_date FROM jobs"))
def star_dim_jobs(spark, sf):
    jobs = lookup(
        _star(spark, sf, "dim_jobs"), _norm(spark, sf, "jobs"), [("job_id", "id")],
        {"company_id": "company_id", "publication_date": "publication_date"},
    )
    return jobs.select("company_id", "name", F.to_date("publication_date").alias("publication_date"))


@query(_sql("SELECT level FROM levels"))
def star_dim_levels(spark, sf):
    return _star(spark, sf, "dim_levels").select("level")


@query(_sql("SELECT name FROM categories"))
def star_dim_categories(spark, sf):
    return _star(spark, sf, "dim_categories").select("name")


@query(_sql("SELECT city, state, country FROM locations"))
def star_dim_locations(spark, sf):
    return _star(spark, sf, "dim_locations").drop("location_key")


@query(
    _sql(
        """SELECT DISTINCT publication_date AS full_date, CAST(day(publication_date) AS INTEGER) AS day,
             CAST(month(publication_date) AS INTEGER) AS month, CAST(year(publication_date) AS INTEGER)
             AS year FROM jobs"""
    )
)
def star_dim_date(spark, sf):
    return _star(spark, sf, "dim_date").drop("date_key")


def _star_tables(spark, sf):
    return {name: _star(spark, sf, name) for name in STAR}


@query(_sql("SELECT * FROM fact", STAR_SQL))
def star_fact(spark, sf):
    t = _star_tables(spark, sf)
    fact = t["fact_job_postings"]
    for dim, key, take in [
        ("dim_jobs", "job_key", {"name": "job"}),
        ("dim_companies", "company_key", {"company_id": "company_id"}),
        ("dim_date", "date_key", {"full_date": "publication_date"}),
        ("dim_categories", "category_key", {"name": "category"}),
        ("dim_levels", "level_key", {"level": "level"}),
        ("dim_locations", "location_key", {"city": "city", "state": "state", "country": "country"}),
    ]:
        fact = lookup(fact, t[dim], [(key, key)], take, "left")
    return fact.select(
        "company_id", "job", "publication_date", "category", "level", "city", "state", "country",
        "salary_min", "salary_max",
    )


@query(
    _sql(
        """SELECT city, count(DISTINCT (company_id, job, publication_date)) AS job_count FROM fact
           WHERE lower(level) = 'senior level' AND publication_date >= DATE '1996-01-01'
           GROUP BY city""",
        STAR_SQL,
    )
)
def star_job_count(spark, sf):
    model = serving.star_model(_star_tables(spark, sf))
    return serving.job_count(model, "city", entry_level="Senior Level", start_date="1996-01-01")


@query(
    _sql(
        """SELECT size AS company_size,
             CAST(round(CAST(avg((salary_min + salary_max) / 2) AS DECIMAL(38,6)), 0) AS DOUBLE) AS avg_salary,
             CAST(round(CAST(min(salary_min) AS DECIMAL(38,6)), 0) AS DOUBLE) AS min_salary,
             CAST(round(CAST(max(salary_max) AS DECIMAL(38,6)), 0) AS DOUBLE) AS max_salary,
             count(*) AS job_x_location_count
           FROM fact JOIN companies ON company_id = id
           WHERE (salary_min IS NOT NULL OR salary_max IS NOT NULL) AND job ILIKE '%high%'
           GROUP BY size""",
        STAR_SQL,
    )
)
def star_salary_stats(spark, sf):
    model = serving.star_model(_star_tables(spark, sf))
    return as_double(
        serving.salary_stats(model, "company_size", job_title="high"),
        "avg_salary", "min_salary", "max_salary",
    )


# --- audits ----------------------------------------------------------------------------------------

_COUNTED = {
    **{f"norm.{n}": n for n in NORM},
    "star.dim_companies": "dim_companies",
    "star.dim_jobs": "jobs",
    "star.dim_levels": "levels",
    "star.dim_categories": "categories",
    "star.dim_locations": "locations",
    "star.dim_date": "(SELECT DISTINCT publication_date FROM jobs)",
    "star.fact_job_postings": "fact",
}


@query(
    _sql(
        " UNION ALL ".join(
            f"SELECT '{name}' AS table_name, count(*) AS row_count FROM {source}"
            for name, source in _COUNTED.items()
        ),
        STAR_SQL,
    )
)
def layer_row_counts(spark, sf):
    return pipeline.audit(warehouse(spark, sf))


_CHECKS = [(t, f"unique({', '.join(keys)})") for t, keys in UNIQUE_KEYS.items()] + [
    (t, f"{column} -> {parent}")
    for t, references in FOREIGN_KEYS.items()
    for column, parent, _ in references
]


@query(SQL["layer_row_counts"])
def layers_second_load(spark, sf):
    """What a part of the data, all of it and all of it again leave behind."""
    return pipeline.audit(loaded_again(spark, sf))


@query(
    _sql(
        """SELECT 'raw.companies' AS table_name, count(*) AS row_count FROM raw_companies UNION ALL
           SELECT 'raw.jobs', count(*) FROM raw_jobs UNION ALL SELECT 'raw.salaries', count(*) FROM raw_salaries""",
        RAW_SQL,
    )
)
def raw_after_two_loads(spark, sf):
    """The raw tables after several loads are those of the last load alone."""
    store = Warehouse(spark, loaded_again(spark, sf).root)  # as a later reader
    return row_counts({f"raw.{n}": store.table(f"raw.{n}") for n in raw.BUILDERS})


@query(
    """SELECT 'unique' AS check_name, count(*) AS violations FROM (SELECT o_custkey FROM orders GROUP BY 1
         HAVING count(*) > 1) UNION ALL
       SELECT 'reference', count(DISTINCT o_custkey) FROM orders WHERE o_custkey % 3 = 0"""
)
def planted_key_violations(spark, sf):
    """Key checks over orders: customers with several, and those left out of the parent."""
    orders, customer = table(spark, sf, "orders"), table(spark, sf, "customer")
    return violations(
        {
            "unique": duplicate_keys(orders, ["o_custkey"]),
            "reference": orphans(orders, "o_custkey", customer.where("c_custkey % 3 <> 0"), "c_custkey"),
        }
    )


@query(
    "SELECT table_name, check_name, CAST(0 AS BIGINT) AS violations FROM (VALUES "
    + ", ".join(f"('{t}', '{c}')" for t, c in _CHECKS)
    + ") AS v(table_name, check_name)"
)
def layer_key_checks(spark, sf):
    return pipeline.check(warehouse(spark, sf), everything=True)
