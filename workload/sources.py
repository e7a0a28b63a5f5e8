"""Readers and writers: what is written from the given tables is read back."""

from __future__ import annotations

from pyspark.sql import functions as F

from jobgrain.functions.text import decode_list
from jobgrain.operators.joins import lookup
from jobgrain.plans import pipeline, raw
from jobgrain.schemas import LANDING
from jobgrain.session import shared_dir
from jobgrain.sources import landing, processed, warehouse
from jobgrain.streaming.landing import ingest_landing
from workload import layers
from workload.common import table

QUERIES, SQL = {}, {}


def query(sql: str | None = None):
    def add(fn):
        QUERIES[fn.__name__] = fn
        if sql:
            SQL[fn.__name__] = sql
        return fn

    return add


# --- landing files ---------------------------------------------------------------------


def _job_records(spark, sf):
    """Orders as nested job records."""
    named = lambda c: F.array(F.struct(c.alias("name")))
    return table(spark, sf, "orders").select(
        F.col("o_orderkey").alias("id"),
        F.col("o_orderstatus").alias("name"),
        F.date_format("o_orderdate", "yyyy-MM-dd'T'HH:mm:ss'Z'").alias("publication_date"),
        F.struct(
            F.col("o_custkey").alias("id"),
            F.concat(F.lit(" Customer "), F.col("o_custkey").cast("string")).alias("name"),
        ).alias("company"),
        named(F.col("o_orderpriority")).alias("levels"),
        named(F.lit("Austin, TX")).alias("locations"),
        named(F.lit("x")).alias("categories"),
    )


def _snapshots(spark, sf):
    """Two snapshots: orders before 1999 and from then on."""
    root = shared_dir(spark, "landing")
    records = _job_records(spark, sf)
    early = F.col("publication_date") < "1999"
    landing.write_snapshot(records.where(early), root, "20250101_000000")
    landing.write_snapshot(records.where(~early), root, "20250301_120000")
    return f"{root}/snapshot_*"


_FLAT = """SELECT CAST(o_orderkey AS VARCHAR) AS job_id, CAST(o_custkey AS VARCHAR) AS company_id,
    o_orderstatus AS job_name, o_orderpriority AS level,
    strftime(o_orderdate, '%Y-%m-%dT%H:%M:%SZ') AS publication_date, 'Austin, TX' AS place FROM orders"""


def _flat(records):
    flat = landing.flatten(records, "jobs")
    return flat.select(
        "job_id", "company_id", "job_name", "level", "publication_date",
        F.get("locations", F.lit(0))["name"].alias("place"),
    )


@query(_FLAT)
def landing_all_snapshots(spark, sf):
    return _flat(landing.read_landing(spark, _snapshots(spark, sf), "jobs", json_lines=True))


@query(f"{_FLAT} WHERE o_orderdate >= DATE '1999-01-01'")
def landing_latest_snapshot(spark, sf):
    return _flat(landing.read_latest_landing(spark, _snapshots(spark, sf), "jobs", json_lines=True))


@query(
    """SELECT DISTINCT 'Customer ' || o_custkey AS company_name FROM orders
       WHERE o_orderdate >= DATE '1999-01-01' ORDER BY 1"""
)
def company_names_of_snapshot(spark, sf):
    records = landing.read_latest_landing(spark, _snapshots(spark, sf), "jobs", json_lines=True)
    return landing.company_names(records, F.col("company.name"))


@query(
    """SELECT event_id, value FROM events WHERE strftime(ts, '%Y%m%d_%H') =
         (SELECT max(strftime(ts, '%Y%m%d_%H')) FROM events)"""
)
def latest_stamp(spark, sf):
    events = table(spark, sf, "events")
    stamp = F.date_format("ts", "yyyyMMdd_HH")
    return landing.latest_snapshot(events, stamp).select("event_id", "value")


@query(
    """SELECT s_suppkey, 'us' AS _country, s_name AS _company_query FROM supplier"""
)
def origin_tags(spark, sf):
    supplier = table(spark, sf, "supplier").select("s_suppkey", "s_name")
    return landing.tag_origin(supplier, "us", F.col("s_name")).drop("s_name")


@query(
    """SELECT DISTINCT trim(name, ' ' || chr(9)) AS company_name FROM (SELECT CASE WHEN c_custkey % 3 = 0
         THEN '  ' WHEN c_custkey % 3 = 1 THEN chr(9) || c_mktsegment || ' ' ELSE c_mktsegment END AS name
         FROM customer UNION ALL SELECT s_name FROM supplier) WHERE trim(name, ' ' || chr(9)) <> ''"""
)
def company_names(spark, sf):
    key = F.col("c_custkey") % 3
    given = F.when(key == 0, "  ").when(
        key == 1, F.concat(F.lit("\t"), "c_mktsegment", F.lit(" "))
    ).otherwise(F.col("c_mktsegment"))
    both = table(spark, sf, "customer").select(given.alias("name")).unionByName(
        table(spark, sf, "supplier").select(F.col("s_name").alias("name"))
    )
    return landing.company_names(both, F.col("name"))


# --- the whole job, from array files ---------------------------------------------------------


def _arrays(spark, records, name: str, root: str) -> str:
    """Records as files that hold one JSON array each: about a thousand files of at least a
    hundred records, and more than that only when a file would hold over 20,000."""
    count = records.count()
    size = min(max(100, count // 1000), 20_000)
    files = records.withColumn("_file", F.floor(F.abs(F.xxhash64("id")) % (1 + count // size)))
    text = F.to_json(F.struct(*records.columns))
    arrays = files.select("_file", text.alias("text")).repartition("_file").groupBy("_file").agg(
        F.array_join(F.sort_array(F.collect_list("text")), ",\n").alias("x")
    )
    arrays = arrays.select("_file", F.concat(F.lit("["), "x", F.lit("]")).alias("value"))
    arrays.write.partitionBy("_file").text(f"{root}/{name}")
    return f"{root}/{name}/_file=*"


def _all_arrays(spark, sf, bad: bool = False):
    """Suppliers, orders and line items as landing records. Even orders are in a known
    place; with `bad` every fifth order has an id that is no number."""
    root = shared_dir(spark, "arrays")
    named = lambda c: F.array(F.struct(c.alias("name")))
    key = F.col("o_orderkey")
    ident = F.when(key % 5 == 0, F.concat(F.lit("x"), key.cast("string"))).otherwise(key.cast("string"))
    jobs = table(spark, sf, "orders").select(
        (ident if bad else key.cast("string")).alias("id"),
        F.concat_ws(" ", "o_orderpriority", "o_orderstatus").alias("name"),
        F.date_format("o_orderdate", "yyyy-MM-dd'T'HH:mm:ss'Z'").alias("publication_date"),
        F.struct(F.expr("CAST(o_custkey DIV 12 AS STRING)").alias("id"), F.lit("x").alias("name")).alias("company"),
        named(F.col("o_orderpriority")).alias("levels"),
        named(F.when(key % 2 == 0, "Austin, TX").otherwise("Berlin, Germany")).alias("locations"),
        named(F.concat(F.lit("Cat "), "o_orderstatus")).alias("categories"),
    )
    companies = table(spark, sf, "supplier").select(
        F.col("s_suppkey").cast("string").alias("id"),
        F.col("s_name").alias("name"),
        F.lit(" about\n it ").alias("description"),
        F.lit("2024-01-01T00:00:00Z").alias("publication_date"),
        F.struct(F.lit("Small Size").alias("name")).alias("size"),
        named(F.lit("Austin, TX")).alias("locations"),
        named(F.lit("Tech")).alias("industries"),
    )
    salaries = table(spark, sf, "supplier").select(
        F.col("s_suppkey").cast("string").alias("id"),
        F.lit("Senior Data Analyst").alias("title"),
        F.lit("2024-02-01T00:00:00Z").alias("created"),
        F.struct(F.concat(F.lit(" "), F.upper("s_name")).alias("display_name")).alias("company"),
        F.struct(F.lit("IT").alias("label"), F.lit("it").alias("tag")).alias("category"),
        F.struct(F.lit("x").alias("display_name"), F.array(*map(F.lit, ("US", "Texas", "Austin"))).alias("area")).alias("location"),
        F.col("s_suppkey").cast("string").alias("salary_min"),
        (F.col("s_suppkey") + 10).cast("string").alias("salary_max"),
        F.lit("0").alias("salary_is_predicted"),
    )
    records = {"jobs": jobs, "companies": companies, "salaries": salaries}
    return root, {name: _arrays(spark, df, name, root) for name, df in records.items()}


_KNOWN_JOBS = """SELECT o_orderpriority AS entry_level, o_orderpriority || ' ' || o_orderstatus AS name,
    bool_or(o_orderkey % 2 = 0) AS placed FROM orders
  WHERE o_custkey // 12 IN (SELECT s_suppkey FROM supplier) {more}
  GROUP BY o_custkey // 12, o_orderpriority, o_orderstatus, o_orderdate"""


@query(
    f"""SELECT CASE WHEN placed THEN 'Austin' END AS city, entry_level, count(*) AS facts
        FROM ({_KNOWN_JOBS.format(more='')}) GROUP BY ALL"""
)
def pipeline_run(spark, sf):
    """Array files through cleaning and all layers to the star tables."""
    root, paths = _all_arrays(spark, sf)
    store = pipeline.run(spark, paths, f"{root}/tables", "run_1", log=lambda line: None)
    fact = store.table("star.fact_job_postings")
    fact = lookup(fact, store.table("star.dim_locations"), [("location_key", "location_key")], {"city": "city"}, "left")
    fact = lookup(fact, store.table("star.dim_levels"), [("level_key", "level_key")], {"level": "entry_level"})
    return fact.groupBy("city", "entry_level").agg(F.count(F.lit(1)).alias("facts"))


@query(
    """SELECT 'x' || o_orderkey AS job_id, CAST(o_custkey // 12 AS VARCHAR) AS company_id FROM orders
       WHERE o_orderkey % 5 = 0"""
)
def quarantined_rows(spark, sf):
    """Rows with a malformed id, set aside by a run that goes on without them."""
    root, paths = _all_arrays(spark, sf, bad=True)
    store = pipeline.run(
        spark, paths, f"{root}/tables", "run_1", on_bad="quarantine", log=lambda line: None
    )
    return store.quarantined("jobs").select("job_id", "company_id")


@query("SELECT CAST(o_orderkey AS VARCHAR) AS id, o_orderpriority || ' ' || o_orderstatus AS name FROM orders")
def landing_archived(spark, sf):
    """Array files taken by the stream, batch by batch, and moved to an archive."""
    root, paths = _all_arrays(spark, sf)
    ingest_landing(
        spark, paths["jobs"], "jobs", f"{root}/stored", f"{root}/checkpoint", archive=f"{root}/archive"
    ).awaitTermination()
    return spark.read.schema(LANDING["jobs"]).parquet(f"{root}/stored").select("id", "name")


# --- processed files -----------------------------------------------------------------------


@query(layers.SQL["raw_companies"])
def processed_csv(spark, sf):
    """Cleaned companies to CSV, read back, exploded."""
    path = shared_dir(spark, "companies_csv")
    processed.write_csv(layers.cleaned_companies(spark, sf), path)
    rows = raw.raw_companies(processed.read_csv(spark, path, "companies", line_breaks=False))
    return rows.withColumn("publication_date", F.to_date("publication_date"))


@query(
    """SELECT c_custkey, CASE c_custkey % 5 WHEN 0 THEN 'Coeur d''Alene ' || c_custkey WHEN 1 THEN
           'say "' || c_mktsegment || '"' WHEN 2 THEN 'é' || c_mktsegment ELSE c_name END AS city,
         CASE WHEN c_custkey % 2 = 0 THEN 'US-' || c_nationkey END AS state
       FROM customer WHERE c_custkey % 5 <> 4
       UNION ALL SELECT c_custkey, NULL, NULL FROM customer WHERE c_custkey % 5 = 4"""
)
def literal_lists(spark, sf):
    """Lists in literal form: mixed quotes, escapes, None; unreadable text is an
    empty list."""
    key = F.col("c_custkey")
    city = F.expr(
        """CASE c_custkey % 5 WHEN 0 THEN '"Coeur d\\'Alene ' || c_custkey || '"'
             WHEN 1 THEN '\\'say "' || c_mktsegment || '"\\''
             WHEN 2 THEN '\\'\\\\xe9' || c_mktsegment || '\\'' ELSE '\\'' || c_name || '\\'' END"""
    )
    state = F.when(key % 2 == 0, F.expr("'\\'US-' || c_nationkey || '\\''")).otherwise("None")
    listed = F.concat(F.lit("[{'subdivision_code': "), state, F.lit(", 'city': "), city, F.lit("}]"))
    written = F.when(key % 10 == 4, "garbage [").when(key % 10 == 9, " ").otherwise(listed)
    decoded = decode_list(written, processed.PLACE_TEXT)
    rows = table(spark, sf, "customer").select("c_custkey", F.explode_outer(decoded).alias("x"))
    return rows.select("c_custkey", F.col("x.city").alias("city"), F.col("x.subdivision_code").alias("state"))


# --- tables ------------------------------------------------------------------------------------


@query(
    """SELECT p_brand, 2 * count(*) AS written FROM part GROUP BY p_brand"""
)
def append_and_replace(spark, sf):
    """Replace a table twice and append to it once."""
    path = shared_dir(spark, "part")
    part = table(spark, sf, "part").select("p_partkey", "p_brand")
    warehouse.replace_rows(part.where("p_brand = 'Brand#1'"), path)
    warehouse.replace_rows(part, path)
    warehouse.append_rows(part, path)
    stored = spark.read.schema(part.schema).parquet(path)
    return stored.groupBy("p_brand").agg(F.count(F.lit(1)).alias("written"))
