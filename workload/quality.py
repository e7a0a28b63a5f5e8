"""Key, reference and count checks over the given tables."""

from __future__ import annotations

from jobgrain.operators import quality
from workload.common import table

QUERIES, SQL = {}, {}

TABLES = [
    "region", "nation", "customer", "supplier", "part", "orders", "lineitem", "events",
    "documents", "embeddings", "pages", "benchmark", "labels", "conversations",
]


def duplicate_keys(spark, sf):
    return quality.duplicate_keys(table(spark, sf, "lineitem"), ["l_orderkey", "l_linenumber"])


def orphans(spark, sf):
    parents = table(spark, sf, "part").where("p_size > 10")
    return quality.orphans(table(spark, sf, "lineitem"), "l_partkey", parents, "p_partkey")


def row_counts(spark, sf):
    return quality.row_counts({name: table(spark, sf, name) for name in TABLES})


QUERIES = {"duplicate_keys": duplicate_keys, "orphans": orphans, "row_counts": row_counts}
SQL = {
    "duplicate_keys": """SELECT l_orderkey, l_linenumber, count(*) AS row_count FROM lineitem
        GROUP BY l_orderkey, l_linenumber HAVING count(*) > 1""",
    "orphans": """SELECT l_partkey AS orphan_key, count(*) AS row_count FROM lineitem
        WHERE l_partkey NOT IN (SELECT p_partkey FROM part WHERE p_size > 10) GROUP BY l_partkey""",
    "row_counts": " UNION ALL ".join(
        f"SELECT '{t}' AS table_name, count(*) AS row_count FROM {t}" for t in TABLES
    ),
}
