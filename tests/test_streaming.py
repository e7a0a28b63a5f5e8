import json
import os

import pytest
from pyspark.errors import StreamingQueryException

from jobgrain.schemas import LANDING
from jobgrain.streaming.insert import insert_new
from jobgrain.streaming.landing import ingest, ingest_landing, landing_stream
from tests.test_pipeline import FIRST, JOBS


def drop(folder, stamp, records):
    os.makedirs(folder, exist_ok=True)
    with open(f"{folder}/jobs_{stamp}.json", "w") as f:
        json.dump(records, f)


def test_each_landing_file_is_taken_once_and_archived(spark, tmp_path):
    folder, archive = str(tmp_path / "in"), str(tmp_path / "archive")
    table, checkpoint = str(tmp_path / "table"), str(tmp_path / "cp")

    def run():
        ingest_landing(spark, folder, "jobs", table, checkpoint, archive).awaitTermination()
        return spark.read.schema(LANDING["jobs"]).parquet(table).count()

    drop(folder, "20250101_000000", JOBS)
    assert run() == len(JOBS)
    assert run() == len(JOBS)
    drop(folder, "20250102_000000", [FIRST])
    assert run() == len(JOBS) + 1
    drop(folder, "20250103_000000", [FIRST])
    assert run() == len(JOBS) + 2
    moved = [f for _, _, files in os.walk(archive) for f in files]
    assert "jobs_20250101_000000.json" in moved


def rows(spark, table):
    df = spark.read.schema("k string, v int, batch bigint").parquet(table)
    return sorted((r.k, r.v) for r in df.collect())


def test_insert_new_over_batches(spark, tmp_path):
    source, table, checkpoint = (str(tmp_path / n) for n in ("src", "table", "cp"))
    write = lambda data: spark.createDataFrame(data, "k string, v int").coalesce(1).write.mode("append").parquet(source)

    def run():
        stream = landing_stream(spark, source, "k string, v int", source="parquet", files_per_batch=1)
        insert_new(stream, table, checkpoint, ["k"], ["v"]).awaitTermination()

    write([("a", 2), ("a", 1), ("b", 5)])
    run()
    assert rows(spark, table) == [("a", 1), ("b", 5)]
    write([("a", 0), ("c", 7), ("c", 6)])
    run()
    assert rows(spark, table) == [("a", 1), ("b", 5), ("c", 6)]


def test_a_repeated_batch_replaces_its_first_try(spark, tmp_path):
    source, table = str(tmp_path / "src"), str(tmp_path / "table")
    spark.createDataFrame([("a", 1), ("b", 2)], "k string, v int").write.parquet(source)
    for checkpoint in ("cp1", "cp2"):  # a lost checkpoint makes batch 0 run again
        stream = landing_stream(spark, source, "k string, v int", source="parquet")
        insert_new(stream, table, str(tmp_path / checkpoint), ["k"], ["v"]).awaitTermination()
    assert rows(spark, table) == [("a", 1), ("b", 2)]


def test_a_batch_reads_nothing_of_the_table(spark, tmp_path):
    """Later batches come out right when the stored rows cannot be read, and the state
    has a row for each key, however the batches are cut."""
    source, table, checkpoint = (str(tmp_path / n) for n in ("src", "table", "cp"))
    for k in range(4):
        data = [(f"k{i % (10 * (k + 1))}", 10 * k + i % 7, None if i % 5 else "x") for i in range(60)]
        data += [(None, k, "null key")]
        spark.createDataFrame(data, "k string, v int, w string").coalesce(1).write.mode("append").parquet(source)
        stream = landing_stream(spark, source, "k string, v int, w string", source="parquet", files_per_batch=1)
        query = insert_new(stream, table, checkpoint, ["k"], ["v", "w"])
        query.awaitTermination()
        assert query.lastProgress["stateOperators"][0]["numRowsTotal"] == 10 * (k + 1) + 1
        assert query.lastProgress["stateOperators"][0]["customMetrics"]["rocksdbPutCount"] > 0
        assert len(query.recentProgress) <= 2
        stored = spark.read.schema("k string, v int, w string").parquet(f"{table}/batch={k}").collect()
        assert len(stored) == 10 + (k == 0)
        for part in (tmp_path / "table" / f"batch={k}").glob("*.parquet"):
            part.write_bytes(b"unreadable")


def test_known_rows_of_a_table_are_not_inserted(spark, tmp_path):
    source, table = str(tmp_path / "src"), str(tmp_path / "table")
    spark.createDataFrame([("a", 1), ("b", 2), (None, 3)], "k string, v int").write.parquet(source)
    known = spark.createDataFrame([("b", 9), (None, 9)], "k string, v int")
    stream = landing_stream(spark, source, "k string, v int", source="parquet")
    insert_new(stream, table, str(tmp_path / "cp"), ["k"], ["v"], known).awaitTermination()
    assert rows(spark, table) == [("a", 1)]
    assert "RocksDB" not in spark.conf.get("spark.sql.streaming.stateStore.providerClass")


def test_plain_ingest_keeps_every_row(spark, tmp_path):
    source = str(tmp_path / "src")
    spark.createDataFrame([("a", 1), ("a", 1)], "k string, v int").write.parquet(source)
    stream = landing_stream(spark, source, "k string, v int", source="parquet")
    ingest(stream, str(tmp_path / "table"), str(tmp_path / "cp")).awaitTermination()
    assert spark.read.schema("k string, v int").parquet(str(tmp_path / "table")).count() == 2


def test_a_malformed_file_fails_the_stream_and_stays(spark, tmp_path):
    folder, archive = tmp_path / "in", tmp_path / "archive"
    folder.mkdir()
    (folder / "jobs_20250101_000000.json").write_text('[{"id": "1", "name": "a"}, {broken')
    stream = ingest_landing(
        spark, str(folder), "jobs", str(tmp_path / "table"), str(tmp_path / "cp"), str(archive)
    )
    with pytest.raises(StreamingQueryException):
        stream.awaitTermination()
    assert (folder / "jobs_20250101_000000.json").exists() and not archive.exists()
    drop(str(folder), "20250101_000000", JOBS)  # mended
    ingest_landing(
        spark, str(folder), "jobs", str(tmp_path / "table"), str(tmp_path / "cp"), str(archive)
    ).awaitTermination()
    assert spark.read.schema(LANDING["jobs"]).parquet(str(tmp_path / "table")).count() == len(JOBS)


def test_late_keys_are_kept(spark, tmp_path):
    source, table = str(tmp_path / "src"), str(tmp_path / "table")
    for day, key in (("2025-01-10", "a"), ("2025-01-20", "b"), ("2025-01-02", "late")):
        df = spark.createDataFrame([(key, day)], "k string, day string").coalesce(1)
        df.write.mode("append").parquet(source)
    stream = landing_stream(spark, source, "k string, day string", source="parquet", files_per_batch=1)
    insert_new(stream, table, str(tmp_path / "cp"), ["k"], ["day"]).awaitTermination()
    found = spark.read.schema("k string, day string").parquet(table)
    assert sorted(r.k for r in found.collect()) == ["a", "b", "late"]
