"""Keys, joins, set operations and dates over the given tables."""

from __future__ import annotations

from pyspark.sql import functions as F

from jobgrain.functions.text import has_text, round_whole, first_filled
from jobgrain.operators import keys as k
from jobgrain.operators import rows
from jobgrain.operators.joins import folded, lookup, trimmed
from jobgrain.plans import star
from workload.common import table

QUERIES, SQL = {}, {}


def query(sql: str | None = None):
    def add(fn):
        QUERIES[fn.__name__] = fn
        if sql:
            SQL[fn.__name__] = sql
        return fn

    return add


def _id_sql(table_sql: str, columns: list[str], after: str = "0") -> str:
    """The id rule: rank inside a digest bucket, times 2^20, plus the bucket."""
    digest = f"md5(concat_ws('|', {', '.join(f'CAST({c} AS VARCHAR)' for c in columns)}))"
    bucket = f"CAST('0x' || substr({digest}, 1, 5) AS BIGINT)"
    order = ", ".join([digest, *columns])
    return (
        f"SELECT CAST({after} + (row_number() OVER (PARTITION BY {bucket} ORDER BY {order}) - 1)"
        f" * 1048576 + {bucket} + 1 AS BIGINT) AS id, * FROM ({table_sql})"
    )


# --- ids and insert-if-absent -------------------------------------------------------


@query(
    _id_sql(
        """SELECT DISTINCT trim(p_brand, ' ') AS name FROM (SELECT CASE WHEN p_size % 9 = 0 THEN 'None'
             WHEN p_size % 9 = 1 THEN ' ' WHEN p_size % 9 = 2 THEN NULL
             ELSE ' ' || p_brand END AS p_brand FROM part)
           WHERE p_brand IS NOT NULL AND trim(p_brand, ' ') NOT IN ('', 'None')""",
        ["name"],
    )
)
def non_blank_lookup(spark, sf):
    holes = F.expr(
        "CASE p_size % 9 WHEN 0 THEN 'None' WHEN 1 THEN ' ' WHEN 2 THEN NULL ELSE ' ' || p_brand END"
    )
    names = table(spark, sf, "part").select(holes.alias("name")).where(has_text(F.col("name")))
    return k.with_ids(names.select(F.trim("name").alias("name")).distinct(), ["name"], "id")


@query(
    _id_sql(
        "SELECT DISTINCT l_suppkey, l_shipdate FROM lineitem",
        ["l_suppkey", "CAST(l_shipdate AS DATE)"],
        "(SELECT max(o_orderkey) FROM orders)",
    ).replace("AS id, *", "AS id, l_suppkey, CAST(l_shipdate AS DATE) AS day")
)
def surrogate_ids(spark, sf):
    pairs = table(spark, sf, "lineitem").select("l_suppkey", F.to_date("l_shipdate").alias("day"))
    after = k.next_after(table(spark, sf, "orders"), "o_orderkey")
    return k.with_ids(pairs.distinct(), ["l_suppkey", "day"], "id", after)


# The status is missing for some orders, so the key has a part that may be NULL.
_ORDERS = """SELECT o_custkey, CASE WHEN o_orderkey % 5 = 0 THEN NULL ELSE o_orderstatus END AS status,
    o_orderpriority, o_orderkey, o_orderdate FROM orders"""


def _orders(spark, sf):
    return table(spark, sf, "orders").select(
        "o_custkey",
        F.when(F.col("o_orderkey") % 5 != 0, F.col("o_orderstatus")).alias("status"),
        "o_orderpriority",
        "o_orderkey",
        "o_orderdate",
    )


@query(
    f"""WITH o AS ({_ORDERS})
        SELECT o_custkey, status, min(o_orderkey) AS o_orderkey FROM o new
        WHERE o_orderdate >= DATE '1999-01-01' AND NOT EXISTS (SELECT 1 FROM o old
          WHERE old.o_orderdate < DATE '1999-01-01' AND old.o_custkey = new.o_custkey
            AND old.status IS NOT DISTINCT FROM new.status)
        GROUP BY o_custkey, status"""
)
def insert_if_absent(spark, sf):
    df = _orders(spark, sf)
    cut = F.lit("1999-01-01").cast("date")
    new = df.where(F.col("o_orderdate") >= cut).select("o_custkey", "status", "o_orderkey")
    return k.insert_if_absent(new, df.where(F.col("o_orderdate") < cut), ["o_custkey", "status"])


@query(
    f"""WITH o AS ({_ORDERS})
        SELECT o_orderkey FROM o new WHERE o_orderdate >= DATE '1999-01-01' AND NOT EXISTS (
          SELECT 1 FROM o old WHERE old.o_orderdate < DATE '1999-01-01'
            AND old.o_custkey = new.o_custkey AND old.status = new.status)"""
)
def anti_join_plain(spark, sf):
    df = _orders(spark, sf)
    cut = F.lit("1999-01-01").cast("date")
    old = df.where(F.col("o_orderdate") < cut)
    new = df.where(F.col("o_orderdate") >= cut)
    return k.absent_from(new, old, ["o_custkey", "status"], null_safe=False).select("o_orderkey")


@query(
    f"""SELECT o_custkey, status, max(o_orderkey) AS o_orderkey FROM ({_ORDERS})
        GROUP BY o_custkey, status"""
)
def one_per_key(spark, sf):
    df = _orders(spark, sf).select("o_custkey", "status", "o_orderkey")
    return rows.one_per_key(df, ["o_custkey", "status"], prefer="max")


# --- joins ---------------------------------------------------------------------------


@query(
    """SELECT l_orderkey, l_linenumber, l_partkey, l_suppkey, p_brand, s_name
       FROM lineitem JOIN part ON l_partkey = p_partkey JOIN supplier ON l_suppkey = s_suppkey"""
)
def lookup_joins(spark, sf):
    base = table(spark, sf, "lineitem").select("l_orderkey", "l_linenumber", "l_partkey", "l_suppkey")
    part, supplier = table(spark, sf, "part"), table(spark, sf, "supplier")
    both = lookup(base, part, [("l_partkey", "p_partkey")], {"p_brand": "p_brand"})
    return lookup(both, supplier, [("l_suppkey", "s_suppkey")], {"s_name": "s_name"})


_SEGMENTS = "SELECT DISTINCT c_mktsegment AS name FROM customer WHERE c_mktsegment <> 'BUILDING'"


@query(
    f"""SELECT c_custkey, name AS segment FROM customer LEFT JOIN ({_SEGMENTS})
        ON name = trim(CASE WHEN c_custkey % 2 = 0 THEN ' ' || c_mktsegment || '  '
          WHEN c_custkey % 7 = 0 THEN NULL ELSE c_mktsegment END, ' ')"""
)
def trimmed_left_join(spark, sf):
    customer = table(spark, sf, "customer")
    names = customer.where("c_mktsegment <> 'BUILDING'").select(F.col("c_mktsegment").alias("name"))
    written = F.expr(
        "CASE WHEN c_custkey % 2 = 0 THEN ' ' || c_mktsegment || '  ' "
        "WHEN c_custkey % 7 = 0 THEN NULL ELSE c_mktsegment END"
    )
    base = customer.select("c_custkey", written.alias("written"))
    return lookup(
        base, names.distinct(), [("written", "name")], {"name": "segment"}, "left", left_form=trimmed
    ).drop("written")


@query(
    """SELECT l_orderkey, l_linenumber, s_suppkey FROM lineitem LEFT JOIN supplier
       ON lower(trim(s_name, ' ')) = lower(trim(CASE l_linenumber % 4 WHEN 0 THEN upper('Supplier#' ||
         lpad(CAST(l_suppkey AS VARCHAR), 9, '0')) WHEN 1 THEN ' Supplier#' ||
         lpad(CAST(l_suppkey AS VARCHAR), 9, '0') || ' ' WHEN 2 THEN 'unknown' ELSE NULL END, ' '))"""
)
def folded_left_join(spark, sf):
    name = "'Supplier#' || lpad(CAST(l_suppkey AS STRING), 9, '0')"
    written = F.expr(
        f"CASE l_linenumber % 4 WHEN 0 THEN upper({name}) WHEN 1 THEN ' ' || {name} || ' ' "
        "WHEN 2 THEN 'unknown' ELSE NULL END"
    )
    base = table(spark, sf, "lineitem").select("l_orderkey", "l_linenumber", written.alias("written"))
    return lookup(
        base, table(spark, sf, "supplier"), [("written", "s_name")], {"s_suppkey": "s_suppkey"},
        "left", left_form=folded, right_form=folded,
    ).drop("written")


_PLACES = """SELECT n_nationkey, n_name AS city, r_name AS country,
    CASE WHEN n_nationkey % 3 <> 0 THEN 'S' || (n_nationkey % 7) END AS state
  FROM nation JOIN region ON n_regionkey = r_regionkey"""
_USED = f"SELECT c_custkey, city, state, country FROM customer JOIN ({_PLACES}) ON c_nationkey = n_nationkey"


def _places(spark, sf):
    key = F.col("n_nationkey")
    return (
        table(spark, sf, "nation")
        .join(table(spark, sf, "region"), F.col("n_regionkey") == F.col("r_regionkey"))
        .select(
            "n_nationkey",
            F.col("n_name").alias("city"),
            F.col("r_name").alias("country"),
            F.when(key % 3 != 0, F.concat(F.lit("S"), (key % 7).cast("string"))).alias("state"),
        )
    )


def _place_join(null_safe):
    def run(spark, sf):
        places = _places(spark, sf)
        used = lookup(
            table(spark, sf, "customer").select("c_custkey", "c_nationkey"), places,
            [("c_nationkey", "n_nationkey")], {"city": "city", "state": "state", "country": "country"},
        )
        parts = [(c, c) for c in ("city", "state", "country")]
        found = lookup(used, places, parts, {"n_nationkey": "place"}, null_safe=null_safe)
        return found.select("c_custkey", "place")

    return run


QUERIES["place_join_plain"] = _place_join(False)
SQL["place_join_plain"] = f"""SELECT c_custkey, p.n_nationkey AS place FROM ({_USED}) u
  JOIN ({_PLACES}) p ON p.city = u.city AND p.state = u.state AND p.country = u.country"""
QUERIES["place_join_null_safe"] = _place_join(True)
SQL["place_join_null_safe"] = f"""SELECT c_custkey, p.n_nationkey AS place FROM ({_USED}) u
  JOIN ({_PLACES}) p ON p.city = u.city AND (p.state = u.state OR (p.state IS NULL AND u.state IS NULL))
    AND p.country = u.country"""


@query(
    """SELECT p_partkey, s.l_suppkey AS supplier, s.l_extendedprice AS price FROM part LEFT JOIN LATERAL (
         SELECT * FROM lineitem WHERE l_partkey = p_partkey
         ORDER BY l_shipdate DESC, l_orderkey DESC, l_linenumber DESC LIMIT 1) s ON TRUE"""
)
def lateral_top1(spark, sf):
    newest = rows.latest_per(
        table(spark, sf, "lineitem"), ["l_partkey"], ["l_shipdate", "l_orderkey", "l_linenumber"],
        ["l_suppkey", "l_extendedprice"],
    )
    return lookup(
        table(spark, sf, "part").select("p_partkey"), newest, [("p_partkey", "l_partkey")],
        {"l_suppkey": "supplier", "l_extendedprice": "price"}, "left",
    )


# --- set operations ---------------------------------------------------------------------


@query("SELECT p_type AS level FROM part UNION SELECT o_orderpriority FROM orders")
def union_distinct(spark, sf):
    a = table(spark, sf, "part").select(F.col("p_type").alias("level"))
    b = table(spark, sf, "orders").select(F.col("o_orderpriority").alias("level"))
    return a.unionByName(b).distinct()


@query(
    """SELECT c_nationkey AS place, count(*) AS uses FROM (SELECT c_nationkey FROM customer
         UNION ALL SELECT s_nationkey FROM supplier UNION ALL SELECT n_nationkey FROM nation)
       GROUP BY c_nationkey"""
)
def union_all(spark, sf):
    parts = [
        table(spark, sf, name).select(F.col(c).alias("place"))
        for name, c in (("customer", "c_nationkey"), ("supplier", "s_nationkey"), ("nation", "n_nationkey"))
    ]
    every = parts[0].unionByName(parts[1]).unionByName(parts[2])
    return every.groupBy("place").agg(F.count(F.lit(1)).alias("uses"))


# --- dates and numbers --------------------------------------------------------------------

_DAY = """CAST(d AS DATE) AS full_date, CAST(day(d) AS INTEGER) AS day,
    CAST(month(d) AS INTEGER) AS month, CAST(year(d) AS INTEGER) AS year"""


def _no_dates(spark):
    return spark.createDataFrame([], "date_key BIGINT, full_date DATE, day INT, month INT, year INT")


@query(f"SELECT DISTINCT {_DAY} FROM (SELECT o_orderdate AS d FROM orders)")
def dim_date(spark, sf):
    orders = table(spark, sf, "orders").select(F.col("o_orderdate").alias("publication_date"))
    return star.dim_date([orders], _no_dates(spark)).drop("date_key")


@query(
    f"""SELECT DISTINCT {_DAY} FROM (SELECT o_orderdate AS d FROM orders
          UNION SELECT l_shipdate FROM lineitem UNION SELECT ts FROM events)"""
)
def dim_date_several_sources(spark, sf):
    moments = [
        table(spark, sf, name).select(F.col(c).alias("publication_date"))
        for name, c in (("orders", "o_orderdate"), ("lineitem", "l_shipdate"), ("events", "ts"))
    ]
    return star.dim_date(moments, _no_dates(spark)).drop("date_key")


@query(
    """SELECT l_orderkey, l_linenumber, CAST(round(CAST((l_extendedprice + l_tax) / 2 AS DECIMAL(38,6)), 0)
         AS DOUBLE) AS middle, coalesce(nullif(CASE WHEN l_linenumber % 2 = 0 THEN '' ELSE l_returnflag END,
         ''), l_linestatus) AS flag FROM lineitem"""
)
def round_and_fall_through(spark, sf):
    flag = F.when(F.col("l_linenumber") % 2 == 0, "").otherwise(F.col("l_returnflag"))
    return table(spark, sf, "lineitem").select(
        "l_orderkey",
        "l_linenumber",
        round_whole((F.col("l_extendedprice") + F.col("l_tax")) / 2).cast("double").alias("middle"),
        first_filled(flag, F.col("l_linestatus")).alias("flag"),
    )
