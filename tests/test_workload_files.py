"""Files that the workload writes before it reads them."""

import os
import time

from pyspark.sql import functions as F

from jobgrain.sources import landing
from workload import oldlayers
from workload.sources import _arrays


def test_array_files_are_about_a_thousand_however_many_records(spark, tmp_path):
    jobs = spark.range(150_000).select(F.col("id").cast("string").alias("id"), F.lit("n").alias("name"))
    path = _arrays(spark, jobs, "jobs", str(tmp_path))
    folders = [f for f in os.listdir(tmp_path / "jobs") if f.startswith("_file=")]
    assert 900 < len(folders) <= 1001
    read = landing.read_landing(spark, path, "jobs")
    assert read.select("id").distinct().count() == read.count() == 150_000


def test_small_array_files_keep_a_hundred_records(spark, tmp_path):
    jobs = spark.range(950).select(F.col("id").cast("string").alias("id"), F.lit("n").alias("name"))
    path = _arrays(spark, jobs, "jobs", str(tmp_path))
    assert len([f for f in os.listdir(tmp_path / "jobs") if f.startswith("_file=")]) == 10
    assert landing.read_landing(spark, path, "jobs").count() == 950


def test_the_older_fact_keeps_no_shuffle_files_of_its_steps(spark, tmp_path):
    i = F.col("id")
    made = {
        "supplier": spark.range(12).select(
            i.alias("s_suppkey"), F.concat(F.lit("S"), i).alias("s_name"), (i % 25).cast("int").alias("s_nationkey"), (i * 1000.0).alias("s_acctbal")),
        "customer": spark.range(140).select(i.alias("c_custkey"), (i % 25).cast("int").alias("c_nationkey")),
        "orders": spark.range(1500).select(
            (i * 1000).alias("o_orderkey"), (i * 7 % 140).alias("o_custkey"), F.lit("F").alias("o_orderstatus"),
            F.lit("2024-01-01").cast("timestamp_ntz").alias("o_orderdate"), F.lit("1-URGENT").alias("o_orderpriority")),
        "lineitem": spark.range(2000).select(
            (i % 12).alias("l_suppkey"), (i % 7 + 1).cast("int").alias("l_linenumber"), i.alias("l_partkey"), (i % 50 + 0.0).alias("l_quantity")),
    }
    for name, df in made.items():
        df.write.parquet(f"{tmp_path}/{name}.parquet")

    def shuffles():
        files = spark._jvm.org.apache.spark.SparkEnv.get().blockManager().diskBlockManager().getAllFiles()
        names = [files.apply(k).getName() for k in range(files.size())]
        return {x for x in names if x.startswith("shuffle_")}

    before = shuffles()
    fact = oldlayers.old_fact(spark, str(tmp_path))
    for _ in range(50):
        if not (left := shuffles() - before):
            break
        time.sleep(0.1)
    assert not left
    assert fact.count() > 100 and oldlayers.old_fact(spark, str(tmp_path)) is fact
