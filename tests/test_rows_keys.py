import hashlib
import random

import pytest
from hypothesis import given, settings
from hypothesis import strategies as st
from pyspark.sql import functions as F

from jobgrain.operators import joins, keys, lists, quality, rows


def test_keep_first_does_not_depend_on_partitions(spark):
    # a third of the rows share one key
    data = [(0 if i % 3 == 0 else i % 50, i, f"v{i}") for i in range(3000)]
    want = {}
    for k, i, v in data:
        want.setdefault(k, (i, v))
    random.Random(1).shuffle(data)
    for parts in (1, 7):
        df = spark.createDataFrame(data, "k int, i int, v string").repartition(parts)
        got = rows.keep_first(df, ["k"], "i").collect()
        assert {r.k: (r.i, r.v) for r in got} == want


def test_keep_first_keeps_null_keys_and_null_values(spark):
    df = spark.createDataFrame([(None, 2, "b"), (None, 1, None), ("a", 1, "x")], "k string, i int, v string")
    got = {r.k: r.v for r in rows.keep_first(df, ["k"], "i").collect()}
    assert got == {None: None, "a": "x"}


def test_latest_per(spark):
    df = spark.createDataFrame([(1, 1, "a"), (1, 3, "c"), (1, 2, "b"), (2, 1, None)], "k int, i int, v string")
    got = {r.k: r.v for r in rows.latest_per(df, ["k"], ["i"], ["v"]).collect()}
    assert got == {1: "c", 2: None}


def test_ids_are_unique_stable_and_above(spark):
    df = spark.range(20_000).select(F.col("id").cast("string").alias("k"))
    first = keys.with_ids(df, ["k"], "n", 100).collect()
    again = keys.with_ids(df.repartition(5), ["k"], "n", 100).collect()
    ids = {r.k: r.n for r in first}
    assert len(set(ids.values())) == 20_000 and min(ids.values()) > 100
    assert ids == {r.k: r.n for r in again}


def test_ids_are_ranks_in_digest_buckets_however_they_are_written(spark):
    df = spark.range(30_000).select(F.col("id").cast("string").alias("k"), F.lit(None).cast("string").alias("v"))
    digests = sorted((hashlib.md5(str(i).encode()).hexdigest(), str(i)) for i in range(30_000))
    want, ranks = {}, {}
    for digest, k in digests:
        ranks[digest[:5]] = ranks.get(digest[:5], 0) + 1
        want[k] = (ranks[digest[:5]] - 1) * (1 << 20) + int(digest[:5], 16) + 1
    assert max(ranks.values()) > 1
    assert {r.k: r.n for r in keys.with_ids(df, ["k", "v"], "n").collect()} == want
    parts = [keys.with_ids(df.where(keys.bucket_part(["k", "v"], i, 3)), ["k", "v"], "n").collect() for i in range(3)]
    assert all(parts) and {r.k: r.n for part in parts for r in part} == want
    assert sum(map(len, parts)) == 30_000


def test_ids_continue_after_a_table(spark):
    table = spark.createDataFrame([(7,), (90_000,)], "id bigint")
    df = spark.createDataFrame([("a",), (None,)], "k string")
    got = keys.with_ids(df, ["k"], "n", keys.next_after(table, "id")).collect()
    assert min(r.n for r in got) > 90_000
    empty = keys.with_ids(df, ["k"], "n", keys.next_after(table.limit(0), "id")).collect()
    assert len({r.n for r in empty}) == 2


KEYS = st.tuples(st.sampled_from([None, "a", "b", ""]), st.sampled_from([None, 1, 2]))


@settings(max_examples=15, deadline=None)
@given(st.lists(KEYS, max_size=12), st.lists(KEYS, max_size=12))
def test_insert_if_absent_is_a_set_difference(spark, batch, target):
    schema = "k string, n int, v int"
    make = lambda ks: spark.createDataFrame([(*k, i) for i, k in enumerate(ks)], schema)
    old = make(target)
    new = keys.insert_if_absent(make(batch), old, ["k", "n"])
    got = sorted(((r.k, r.n, r.v) for r in new.collect()), key=repr)
    want = {k: i for i, k in reversed(list(enumerate(batch))) if k not in target}
    assert got == sorted(((*k, i) for k, i in want.items()), key=repr)


def test_insert_twice_adds_nothing(spark):
    batch = spark.createDataFrame([("a", None, 1), ("a", None, 2), ("b", 1, 3)], "k string, n int, v int")
    first = keys.insert_if_absent(batch, batch.limit(0), ["k", "n"])
    assert first.count() == 2
    assert keys.insert_if_absent(batch, first, ["k", "n"]).count() == 0
    # without null-safe keys the row with a NULL part is new every time
    assert keys.insert_if_absent(batch, first, ["k", "n"], null_safe=False).count() == 1


def test_lookup_null_safety_and_forms(spark):
    left = spark.createDataFrame([(" Ab ", None), ("x", "s")], "a string, b string")
    right = spark.createDataFrame([("aB", None, 1), ("x", "s", 2)], "a string, b string, id int")
    pairs = [("a", "a"), ("b", "b")]
    plain = joins.lookup(left, right, pairs, {"id": "id"}, "left")
    assert sorted((r.id or 0) for r in plain.collect()) == [0, 2]
    safe = joins.lookup(
        left, right, pairs, {"id": "id"}, null_safe=True,
        left_form=joins.folded, right_form=joins.folded,
    )
    assert sorted(r.id for r in safe.collect()) == [1, 2]


def test_list_product_keeps_empty_lists(spark):
    df = spark.createDataFrame([(1, ["a", "b"], [1, 2]), (2, [], None)], "id int, x array<string>, y array<int>")
    got = lists.list_product(df, {"x": "x1", "y": "y1"}).collect()
    assert sorted(((r.id, r.x1, r.y1) for r in got), key=repr) == [
        (1, "a", 1), (1, "a", 2), (1, "b", 1), (1, "b", 2), (2, None, None),
    ]


def test_blanks_and_required(spark):
    df = spark.createDataFrame([("", [], 1), ("a", ["x"], None)], "s string, l array<string>, n int")
    clean = rows.blanks_to_null(df)
    assert [tuple(r) for r in clean.collect()] == [(None, None, 1), ("a", ["x"], None)]
    assert rows.require(clean, ["s"]).count() == 1
    assert rows.require(clean, []).count() == 2
    assert rows.require(clean, ["s", "n"]).count() == 0


def test_quality(spark):
    child = spark.createDataFrame([(1,), (1,), (3,), (None,)], "k int")
    parent = spark.createDataFrame([(1,)], "id int")
    assert [tuple(r) for r in quality.orphans(child, "k", parent, "id").collect()] == [(3, 1)]
    assert [tuple(r) for r in quality.duplicate_keys(child, ["k"]).collect()] == [(1, 2)]
    new = spark.createDataFrame([(1, None), (2, None), (2, None), (3, 1)], "k int, n int")
    old = spark.createDataFrame([(1, None), (9, 1)], "k int, n int")
    repeated = quality.repeated_keys(new, old, ["k", "n"]).collect()
    assert sorted(tuple(r) for r in repeated) == [(1, None, 1), (2, None, 2)]
    profile = {r.column_name: r.null_count for r in quality.null_profile(child).collect()}
    assert profile == {"k": 1, "(total)": 1}


@pytest.mark.parametrize("prefer, want", [("min", 1), ("max", 9)])
def test_one_per_key(spark, prefer, want):
    df = spark.createDataFrame([("a", 9), ("a", 1)], "k string, v int")
    assert rows.one_per_key(df, ["k"], prefer).first().v == want


def test_the_order_of_first_rows_is_shuffled_once(spark):
    df = spark.createDataFrame([(1, "b", 2, 5), (1, "a", 1, 6), (None, "c", None, 7)], "k int, v string, o int, w int")
    first = rows.keep_first(df, ["k"], "o")
    assert first.columns == df.columns
    assert {tuple(r) for r in first.collect()} == {(1, "a", 1, 6), (None, None, None, None)}
    plan = first.drop("o")._jdf.queryExecution().optimizedPlan().toString()
    assert plan.count("o#") <= 3 and "struct(v, v" in plan  # of the scan, and what orders
    assert "struct(v, v" in plan and ", o, o#" not in plan
