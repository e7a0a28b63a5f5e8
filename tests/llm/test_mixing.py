import random
import re

import pytest
from pyspark.sql import functions as F

from jobgrain.llm import mixing, queries
from oracle_check import compare, connect
from tests.llm.helpers import SF, docs_of


def test_query_equals_its_sql(spark):
    got = queries.op4_mix_sources(spark, SF).toArrow()
    assert compare(got, connect(SF).sql(queries.SQL["op4_mix_sources"]).to_arrow_table()).startswith("ok")


def brute_targets(sizes):
    """Targets by sharing again and again what is above the caps."""
    names = sorted(sizes, key=lambda s: (s is None, s or ""))
    weight = {s: (3, 1, 2)[k % 3] for k, s in enumerate(names)}
    left, open_, target = 1.5 * sum(sizes.values()), set(names), {}
    while open_:
        share = {s: left * weight[s] / sum(weight[x] for x in open_) for s in open_}
        full = {s for s in open_ if share[s] > 2 * sizes[s]}
        if not full:
            target |= share
            break
        for s in full:
            target[s] = 2 * sizes[s]
            left -= target[s]
        open_ -= full
    return target


@pytest.mark.parametrize("seed", [1, 2, 3])
def test_targets_and_words_taken(spark, seed):
    r = random.Random(seed)
    rows = [
        (k, " ".join(["w"] * r.randint(0, 30)), r.choice([None, "a", "b", "c", "d", "big", "big", "big"]))
        for k in range(400)
    ] + [(None, None, "null text"), (7, "", "empty"), (9, "x y", "a"), (9, "x y", "a")]
    got = mixing.mix(docs_of(spark, rows).repartition(7))
    got = [r.asDict() for r in got.collect()]
    again = [r.asDict() for r in mixing.mix(docs_of(spark, rows).repartition(3)).collect()]
    assert sorted(map(repr, got)) == sorted(map(repr, again))
    assert len(got) == len(rows)
    sizes = {}
    for _, text, source in rows:
        sizes[source] = sizes.get(source, 0) + len((text or "").split())
    target = brute_targets(sizes)
    for row in got:
        assert row["taken"] in (0, row["size"], 2 * row["size"])
    by_size = {}
    for row in got:
        by_size.setdefault((row["source_size"], round(row["target"], 6)), []).append(row["taken"])
    expected = {(sizes[s], round(target[s], 6)) for s in sizes}
    assert set(by_size) == expected
    assert abs(sum(row["taken"] for row in got) - 1.5 * sum(sizes.values())) <= 60
    for (_, goal), taken in by_size.items():
        assert abs(sum(taken) - goal * (len(taken) > 0)) <= 60 or sum((sizes[s], round(target[s], 6)) == (_, goal) for s in sizes) > 1


def test_words_are_counted_as_stated(spark):
    texts = [None, "", " ", "a", " a b c\x0b\x0cd\x1ce\te\r\nf ", "é " * 1000, "x" * 300_000]
    df = docs_of(spark, list(enumerate(texts)))
    got = dict(df.select("doc_id", mixing.word_count(F.col("text"))).collect())
    assert got == {k: len(re.findall(r"[^\x20\x09-\x0D]+", t or "")) for k, t in enumerate(texts)}


def test_running_totals_over_one_hot_key(spark):
    df = spark.range(1000).select((F.col("id") % 3 == 0).cast("int").alias("k"), F.col("id").alias("v"))
    got = mixing.running_totals(df.repartition(9), ["k", "v"], {"total": F.col("v")}).orderBy("k", "v").collect()
    total = 0
    for row in got:
        total += row.v
        assert row.total == total


def test_no_documents_and_no_words(spark):
    assert mixing.mix(docs_of(spark, [])).collect() == []
    rows = mixing.mix(docs_of(spark, [(1, None), (2, " ")])).collect()
    assert sorted(tuple(r) for r in rows) == [(1, 0, 0, 0.0, 0), (2, 0, 0, 0.0, 0)]
