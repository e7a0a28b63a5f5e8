"""The older layers over lists stored as text. Roles as in `layers`."""

from __future__ import annotations

from pyspark.sql import functions as F

from jobgrain.functions.listtext import (
    ENTRY,
    key_pattern,
    location_parts,
    name_parts,
    place_of,
    places_in,
)
from jobgrain.operators.joins import lookup
from jobgrain.plans import legacy
from jobgrain.session import releasing_shuffles, shared_dir
from workload.common import table

QUERIES, SQL = {}, {}


def query(sql: str | None = None):
    def add(fn):
        QUERIES[fn.__name__] = fn
        if sql:
            SQL[fn.__name__] = sql
        return fn

    return add


def _location_text(k: str) -> str:
    city, last = f"'City ' || (({k}) % 20)", f"', subdivision_code: S' || (({k}) % 7) || ', country_code: C' || (({k}) % 5)"
    return f"""CASE ({k}) % 6
      WHEN 0 THEN 'city: ' || {city} || ', state: S' || (({k}) % 7) || ', country: C' || (({k}) % 5)
      WHEN 1 THEN 'city: ' || {city} || ', subdivision_code: None, country_code: C' || (({k}) % 5)
      WHEN 2 THEN '[{{city: ' || {city} || {last} || '}}]'
      WHEN 3 THEN 'CITY: ' || {city}
      WHEN 4 THEN 'remote'
      ELSE 'city: A, subdivision_code: S0, country_code: C0' || chr(10) || ', city: ' || {city} || {last} END"""


def _names_text(k: str, word: str) -> str:
    return f"""CASE ({k}) % 6 WHEN 0 THEN 'name: {word} ' || (({k}) % 4) || ', name: {word} ' || (({k}) % 3)
      WHEN 1 THEN NULL WHEN 2 THEN '' WHEN 3 THEN 'name: {word} 1,  ,' ELSE 'name:  {word} ' || (({k}) % 4) || ' ' END"""


COMPANY = f"""SELECT s_suppkey AS company_id, s_name AS company_name, 'about ' || s_name AS description,
    CAST('2000-01-01 00:00:00' AS TIMESTAMP) AS publication_date,
    CASE WHEN s_acctbal < 5000 THEN 'Small Size' ELSE 'Large Size' END AS size,
    {_names_text('s_nationkey', 'Ind')} AS industries, {_location_text('s_nationkey')} AS locations
  FROM supplier"""

JOB = f"""SELECT o_orderkey AS job_id, CAST(floor(o_custkey / 12) AS BIGINT) AS company_id,
    o_orderpriority || ' ' || (o_orderkey % 5000) AS job_name,
    CASE o_orderstatus WHEN 'F' THEN 'Senior Level' ELSE 'Mid Level' END AS level,
    o_orderdate AS publication_date, {_names_text('o_custkey', 'Cat')} AS categories,
    {_location_text('c_nationkey')} AS locations
  FROM orders JOIN customer ON o_custkey = c_custkey"""

SALARY = f"""SELECT CASE l_linenumber % 4 WHEN 0 THEN upper(s_name) WHEN 1 THEN ' ' || s_name || ' '
      WHEN 2 THEN s_name ELSE 'Nobody' END AS company_name, ' Title ' || (l_partkey % 3) AS adz_job_name,
    CASE WHEN l_linenumber <> 5 THEN floor(l_quantity / 20) * 10000.0E0 END AS salary_min,
    CASE WHEN l_linenumber NOT IN (5, 6) THEN floor(l_quantity / 20) * 12000.0E0 END AS salary_max,
    {_location_text('s_nationkey + l_linenumber')} AS locations
  FROM lineitem JOIN supplier ON l_suppkey = s_suppkey"""


def _raw(spark, sf, name):
    parts = {
        "companies": ("supplier", COMPANY),
        "jobs": ("orders customer", JOB),
        "salaries": ("lineitem supplier", SALARY),
    }
    return _text(spark, sf, *parts[name])


def _text(spark, sf, needed, text):
    """The rows of a statement over given tables."""
    frames = {t: table(spark, sf, t) for t in needed.split()}
    text = text.replace("chr(", "char(").replace("{", "{{").replace("}", "}}")
    for t in frames:  # name the tables inside this one statement
        text = text.replace(f"FROM {t}", f"FROM {{{t}}}").replace(f"JOIN {t}", f"JOIN {{{t}}}")
    return spark.sql(text, **frames)


# --- the same in SQL --------------------------------------------------------------------


def _key(c: str, key: str) -> str:
    return f"nullif(trim(regexp_replace({c}, '(?s).*{key}:\\s*([^,]+).*', '\\1'), ' '), 'None')"


def _first_key(guard: str, c: str, *keys: str) -> str:
    return "CASE " + " ".join(f"WHEN {guard} ILIKE '%{k}:%' THEN {_key(c, k)}" for k in keys) + " END"


def _place(guard: str, c: str) -> str:
    return f"""{_first_key(guard, c, 'city')} AS city,
      {_first_key(guard, c, 'subdivision_code', 'state')} AS state,
      {_first_key(guard, c, 'country_code', 'country')} AS country"""


def _parts(c: str) -> str:
    return f"translate({c}, '[]{{}}', '')"


def _names(c: str) -> str:
    return f"unnest(string_split(regexp_replace({c}, 'name:\\s*', '', 'g'), ','))"


BASE = f"""raw_companies AS ({COMPANY}), raw_jobs AS ({JOB}), raw_salaries AS ({SALARY}),
industries AS (SELECT DISTINCT trim(v, ' ') AS name FROM (SELECT {_names('industries')} AS v FROM raw_companies)
  WHERE v <> ''),
categories AS (SELECT DISTINCT trim(v, ' ') AS name FROM (SELECT {_names('categories')} AS v FROM raw_jobs)
  WHERE v <> ''),
locations AS (SELECT DISTINCT city, state, country FROM (SELECT {_place('locations', 'locations')} FROM (
    SELECT locations FROM raw_companies UNION ALL SELECT locations FROM raw_jobs
    UNION ALL SELECT locations FROM raw_salaries)) WHERE city <> ''),
jobs AS (SELECT DISTINCT job_id AS id, company_id, job_name AS name, level,
    CAST(publication_date AS DATE) AS publication_date
  FROM raw_jobs WHERE company_id IN (SELECT company_id FROM raw_companies)),
companies_industries AS (SELECT DISTINCT c.company_id, i.name AS industry FROM (
    SELECT company_name, {_names('industries')} AS v FROM raw_companies) r
  JOIN raw_companies c USING (company_name) JOIN industries i ON i.name = trim(v, ' ') WHERE trim(v, ' ') <> ''),
jobs_categories AS (SELECT DISTINCT j.id AS job_id, k.name AS category FROM (
    SELECT DISTINCT job_name, trim(v, ' ') AS v FROM (SELECT job_name, {_names('categories')} AS v FROM raw_jobs)) r
  JOIN jobs j ON j.name = r.job_name JOIN categories k ON k.name = v WHERE v <> ''),
jobs_locations AS (SELECT DISTINCT j.id AS job_id, l.city, l.state, l.country FROM (
    SELECT DISTINCT job_name, {_place('locations', 'part')} FROM (
      SELECT job_name, locations, {_parts('locations')} AS part FROM raw_jobs)) r
  JOIN jobs j ON j.name = r.job_name JOIN locations l ON l.city = r.city
    AND (l.state = r.state OR (l.state IS NULL AND r.state IS NULL))
    AND (l.country = r.country OR (l.country IS NULL AND r.country IS NULL)) WHERE r.city <> ''),
salaries AS (SELECT DISTINCT c.company_id, l.city, l.state, l.country, trim(adz_job_name, ' ') AS title,
    salary_min, salary_max FROM (SELECT *, {_key('locations', 'city')} AS xcity,
      {_key('locations', 'subdivision_code')} AS xstate, {_key('locations', 'country_code')} AS xcountry
    FROM raw_salaries) s
  LEFT JOIN raw_companies c ON lower(trim(c.company_name, ' ')) = lower(trim(s.company_name, ' '))
  LEFT JOIN locations l ON l.city = xcity AND l.state IS NOT DISTINCT FROM xstate
    AND l.country IS NOT DISTINCT FROM xcountry
  WHERE (salary_min IS NOT NULL OR salary_max IS NOT NULL) AND xcity <> ''),
fact AS (SELECT DISTINCT j.id AS job_id, k.category, j.company_id, i.industry, d.city, d.state, d.country,
    j.publication_date, s.salary_min, s.salary_max
  FROM jobs j LEFT JOIN jobs_categories k ON k.job_id = j.id
    LEFT JOIN companies_industries i ON i.company_id = j.company_id
    JOIN jobs_locations l ON l.job_id = j.id
    JOIN (SELECT DISTINCT company_id, city, state, country, salary_min, salary_max FROM salaries) s
      ON s.company_id = j.company_id AND s.city = l.city AND s.state IS NOT DISTINCT FROM l.state
        AND s.country IS NOT DISTINCT FROM l.country
    LEFT JOIN locations d ON lower(trim(d.city, ' ')) = lower(trim(l.city, ' '))
      AND lower(trim(d.state, ' ')) = lower(trim(l.state, ' '))
      AND lower(trim(d.country, ' ')) = lower(trim(l.country, ' ')))"""


def _sql(body: str) -> str:
    return f"WITH {BASE} {body}"


# --- expressions -------------------------------------------------------------------------


@query(_sql(f"SELECT job_id, {_place('locations', 'locations')} FROM raw_jobs"))
def text_key_values(spark, sf):
    c = F.col("locations")
    found = place_of(c, c)
    return _raw(spark, sf, "jobs").select(
        "job_id",
        found["city"].alias("city"),
        found["subdivision_code"].alias("state"),
        found["country_code"].alias("country"),
    )


@query(
    _sql(
        f"""SELECT job_id, trim(v, ' ') AS name FROM (SELECT job_id, {_names('categories')} AS v FROM raw_jobs)
            WHERE v <> ''"""
    )
)
def text_names(spark, sf):
    return _raw(spark, sf, "jobs").select("job_id", F.explode(name_parts(F.col("categories"))).alias("name"))


# Customers' places as texts with none, one or several, bare and quoted.
SEVERAL = """SELECT c_custkey, translate(CASE c_custkey % 7
    WHEN 0 THEN '[{~city~: ~' || n_name || '~, ~state~: ~S' || (c_custkey % 5) || '~, ~country~: ~' || r_name
      || '~}, {~city~: ~City ' || (c_custkey % 9) || ', North~, ~state~: None, ~country_code~: ~C1~}]'
    WHEN 1 THEN '{city: ' || n_name || ', subdivision_code: S1}, {CITY: B' || (c_custkey % 4) || ', country: ' || r_name || '}'
    WHEN 2 THEN 'city: ' || n_name || ', country_code: C' || (c_custkey % 3)
    WHEN 3 THEN '[{"city": "a}b{' || n_name || '", "meta": {"zip": 1}, "country": "X"}, {"state": "only"}]'
    WHEN 4 THEN NULL WHEN 5 THEN '[]' ELSE n_name END, '~', chr(39)) AS places
  FROM customer JOIN nation ON c_nationkey = n_nationkey JOIN region ON n_regionkey = r_regionkey"""


def _value_sql(*keys: str) -> str:
    found = []
    for key in keys:
        pattern = key_pattern(key).replace("'", "''")
        for group in (1, 2, 3):
            value = f"trim(regexp_extract(entry, '{pattern}', {group}), ' ')"
            found.append(f"CASE WHEN {value} NOT IN ('', 'None') THEN {value} END")
    return f"coalesce({', '.join(found)})"


_ENTRY_SQL = ENTRY.replace("'", "''")


@query(
    f"""WITH t AS ({SEVERAL}), e AS (
      SELECT c_custkey, substr(entry, 2, length(entry) - 2) AS entry
      FROM (SELECT c_custkey, unnest(regexp_extract_all(places, '{_ENTRY_SQL}')) AS entry FROM t)
      UNION ALL SELECT c_custkey, translate(places, '[]{{}}', '') FROM t
      WHERE len(regexp_extract_all(places, '{_ENTRY_SQL}')) = 0)
    SELECT * FROM (SELECT c_custkey, {_value_sql('city')} AS city,
      {_value_sql('subdivision_code', 'state')} AS subdivision_code,
      {_value_sql('country_code', 'country')} AS country_code FROM e) WHERE city IS NOT NULL"""
)
def text_places_split(spark, sf):
    """Each of several places of a text as a row."""
    places = _text(spark, sf, "customer nation region", SEVERAL)
    return places.select("c_custkey", F.explode(places_in(F.col("places"))).alias("p")).select("c_custkey", "p.*")


@query(f"SELECT c_custkey, translate(places, '[]{{}}', '') AS part FROM ({SEVERAL}) WHERE places IS NOT NULL")
def text_places_whole(spark, sf):
    """The older rule: signs go, and the text stays whole."""
    places = _text(spark, sf, "customer nation region", SEVERAL)
    return places.select("c_custkey", F.explode(location_parts(F.col("places"))).alias("part"))


# --- tables, written once and read back ------------------------------------------------------

_built: dict[tuple, dict] = {}

PARTS = {"dim_jobs": 2, "fact_with_jobs": 4}  # of the largest tables, written one after the other


def _stored(spark, path, *parts):
    with releasing_shuffles(spark):
        for n, df in enumerate(parts):
            df.write.mode("append" if n else "overwrite").option("compression", "zstd").parquet(path)
    return spark.read.schema(parts[0].schema).parquet(path)


def tables(spark, sf):
    key = (spark.sparkContext.applicationId, sf)
    if key in _built:
        return _built[key]
    root = shared_dir(spark, "oldlayers")
    done = {}

    def keep(name, *parts):
        done[name] = _stored(spark, f"{root}/{name}", *parts)
        return done[name]

    rc, rj, rs = (_raw(spark, sf, n) for n in ("companies", "jobs", "salaries"))
    companies = keep("companies", legacy.companies(rc))
    jobs = keep("jobs", legacy.jobs(rj, companies))
    industries = keep("industries", legacy.names(rc, "industries"))
    categories = keep("categories", legacy.names(rj, "categories"))
    locations = keep("locations", legacy.locations([rc, rj, rs]))
    ci = keep(
        "companies_industries",
        legacy.name_bridge(
            rc, "industries", "company_name", companies, industries, "company_id", "industry_id"
        ),
    )
    jc = keep(
        "jobs_categories",
        legacy.name_bridge(rj, "categories", "job_name", jobs, categories, "job_id", "category_id"),
    )
    keep("companies_locations", legacy.location_bridge(rc, "company_name", companies, locations, "company_id"))
    keep("jobs_locations", legacy.location_bridge(rj, "job_name", jobs, locations, "job_id"))
    keep("salaries", legacy.salaries(rs, companies, locations))
    keep("dim_companies", legacy.dim_companies(companies, ci, industries))
    parts = PARTS["dim_jobs"]
    keep("dim_jobs", *[legacy.dim_jobs(jobs, jc, categories, n, parts) for n in range(parts)])
    keep("dim_locations", legacy.dim_locations(locations))
    keep("dim_date", legacy.dim_date(jobs, companies))
    _built[key] = done
    return done


PLACE = {"city": "city", "subdivision_code": "state", "country_code": "country"}


@query(
    _sql(
        """SELECT DISTINCT company_id AS id, description, company_name AS name,
             CAST(publication_date AS DATE) AS publication_date, size FROM raw_companies"""
    )
)
def old_companies(spark, sf):
    return tables(spark, sf)["companies"].withColumn("publication_date", F.to_date("publication_date"))


@query(_sql("SELECT id, company_id, name, level, publication_date FROM jobs"))
def old_jobs(spark, sf):
    return tables(spark, sf)["jobs"].withColumn("publication_date", F.to_date("publication_date"))


@query(_sql("SELECT name FROM industries UNION ALL SELECT name FROM categories"))
def old_names(spark, sf):
    t = tables(spark, sf)
    return t["industries"].select("name").unionByName(t["categories"].select("name"))


@query(_sql("SELECT city, state, country FROM locations"))
def old_locations(spark, sf):
    return tables(spark, sf)["locations"].select(*[F.col(a).alias(b) for a, b in PLACE.items()])


@query(_sql("SELECT company_id, industry FROM companies_industries"))
def old_companies_industries(spark, sf):
    t = tables(spark, sf)
    return lookup(
        t["companies_industries"], t["industries"], [("industry_id", "id")], {"name": "industry"}
    ).drop("industry_id")


@query(_sql("SELECT job_id, category FROM jobs_categories"))
def old_jobs_categories(spark, sf):
    t = tables(spark, sf)
    return lookup(
        t["jobs_categories"], t["categories"], [("category_id", "id")], {"name": "category"}
    ).drop("category_id")


@query(
    _sql(
        f"""SELECT DISTINCT company_id, l.city, l.state, l.country FROM (
              SELECT company_name, {_place('locations', 'part')} FROM (
                SELECT company_name, locations, {_parts('locations')} AS part FROM raw_companies)) r
            JOIN raw_companies USING (company_name) JOIN locations l ON l.city = r.city
              AND l.state IS NOT DISTINCT FROM r.state AND l.country IS NOT DISTINCT FROM r.country
            WHERE r.city <> ''"""
    )
)
def old_companies_locations(spark, sf):
    t = tables(spark, sf)
    return lookup(
        t["companies_locations"], t["locations"], [("location_id", "id")], PLACE
    ).drop("location_id")


@query(_sql("SELECT job_id, city, state, country FROM jobs_locations"))
def old_jobs_locations(spark, sf):
    t = tables(spark, sf)
    return lookup(t["jobs_locations"], t["locations"], [("location_id", "id")], PLACE).drop("location_id")


@query(_sql("SELECT company_id, city, state, country, title, salary_min, salary_max FROM salaries"))
def old_salaries(spark, sf):
    t = tables(spark, sf)
    placed = lookup(t["salaries"], t["locations"], [("location_id", "id")], PLACE, "left")
    return placed.drop("id", "location_id")


@query(
    _sql(
        """SELECT c.company_id, company_name AS name, description, size, industry
           FROM raw_companies c LEFT JOIN companies_industries i USING (company_id)"""
    )
)
def old_dim_companies(spark, sf):
    return tables(spark, sf)["dim_companies"].drop("company_key")


@query(
    _sql(
        """SELECT id AS job_id, name, level, category FROM jobs LEFT JOIN jobs_categories ON job_id = id"""
    )
)
def old_dim_jobs(spark, sf):
    return tables(spark, sf)["dim_jobs"].drop("job_key")


@query(
    _sql(
        """SELECT DISTINCT d AS full_date, CAST(day(d) AS INTEGER) AS day, CAST(month(d) AS INTEGER) AS month,
             CAST(year(d) AS INTEGER) AS year FROM (SELECT publication_date AS d FROM jobs
             UNION SELECT CAST(publication_date AS DATE) FROM raw_companies)"""
    )
)
def old_dim_date(spark, sf):
    return tables(spark, sf)["dim_date"].drop("date_key")


@query(_sql("SELECT * FROM fact"))
def old_fact(spark, sf):
    t = tables(spark, sf)
    if "fact" not in t:
        root = shared_dir(spark, "oldfact")

        def keep(name, *parts):
            return _stored(spark, f"{root}/{name}", *parts)

        t["fact"] = _shown(legacy.fact_job_postings(t, t, every_salary=True, keep=keep), t, keep)
    return t["fact"]


@query(
    _sql(
        """SELECT job_id, category, company_id, industry, city, state, country, publication_date,
             min(salary_min) AS salary_min, max(salary_max) AS salary_max FROM fact GROUP BY ALL"""
    )
)
def old_fact_bounds(spark, sf):
    t = tables(spark, sf)
    return _shown(legacy.fact_job_postings(t, t), t)


def _parts(rows, key, parts):
    return [rows.where(F.pmod(F.hash(key), F.lit(parts)) == n) for n in range(parts)]


def _shown(fact, t, keep=None):
    """Names in place of keys. With `keep` the largest lookup is stored in parts by key."""
    for dim, key, take in [
        ("dim_jobs", "job_key", {"job_id": "job_id", "category": "category"}),
        ("dim_companies", "company_key", {"company_id": "company_id", "industry": "industry"}),
        ("dim_locations", "location_key", {"city": "city", "state": "state", "country": "country"}),
        ("dim_date", "date_key", {"full_date": "publication_date"}),
    ]:
        if keep and dim == "dim_jobs":
            name = "fact_with_jobs"
            sides = zip(_parts(fact, key, PARTS[name]), _parts(t[dim], key, PARTS[name]), strict=True)
            found = [lookup(rows, names, [(key, key)], take, "left") for rows, names in sides]
            fact = keep(name, *[rows.drop("fact_id", key) for rows in found])
        else:
            fact = lookup(fact, t[dim], [(key, key)], take, "left")
    return fact.select(
        "job_id", "category", "company_id", "industry", "city", "state", "country",
        "publication_date", "salary_min", "salary_max",
    )
