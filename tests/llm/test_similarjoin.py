import random
from collections import Counter

import numpy as np
import pytest

from jobgrain.llm import components, queries, similarjoin as s
from tests.llm.helpers import SF, classes, docs_of, shingles, similar_pairs


def expected(rows):
    sets = {k: shingles(t) for k, t in rows if shingles(t)}
    pairs = similar_pairs(sets)
    links = Counter(k for pair in pairs for k in pair)
    names = classes([k for k, _ in rows], pairs)
    return {k: (names[k], links[k]) for k, _ in rows}


def corpus(seed, families=6, each=14):
    r = random.Random(seed)
    word = lambda: r.choice("bcdfgl") + r.choice("aeiou") + r.choice("mnrst") + str(r.randint(0, 99))
    common = [word() for _ in range(60)]  # a passage that many share
    rows = []
    for _ in range(families):
        text = [word() for _ in range(r.randint(5, 160))]
        for _ in range(each):
            copy = list(text)
            for _ in range(r.choice([0, 0, 1, 2, 4, 8])):
                copy[r.randrange(len(copy))] = word()
            rows.append(" ".join(copy))
    rows += [" ".join(common + [word() for _ in range(r.randint(1, 80))]) for _ in range(40)]
    rows += ["one two", "One, two!", "three", "", None, "one two"]
    return list(enumerate(rows))


@pytest.mark.parametrize("seed, small", [(1, 512), (2, 6), (3, 3)])
def test_equals_brute_force(spark, monkeypatch, seed, small):
    monkeypatch.setattr(s, "SMALL", small)  # small buckets: pivots and further levels
    monkeypatch.setattr(s, "BLOCK_SETS", 8)
    rows = corpus(seed)
    got = {r.doc_id: (r.class_id, r.n_links) for r in s.similar_documents(docs_of(spark, rows)).collect()}
    assert got == expected(rows)


def test_copies_nulls_and_no_rows(spark):
    text = "a b c d e f g h"
    rows = [(5, text), (5, text), (None, text), (3, text.upper()), (8, None), (None, ""), (9, "z")]
    got = s.similar_documents(docs_of(spark, rows)).collect()
    found = sorted(((r.doc_id, r.class_id, r.n_links, r.n_copies, r.keeps) for r in got), key=repr)
    assert found == sorted(
        [
            (5, 3, 3, 4, False), (5, 3, 3, 4, False), (None, 3, 3, 4, False), (3, 3, 3, 4, True),
            (8, 8, 0, 1, True), (None, None, 0, 1, True), (9, 9, 0, 1, True),
        ],
        key=repr,
    )
    assert s.similar_documents(docs_of(spark, [])).collect() == []


def test_shared_counts_by_blocks():
    r = np.random.default_rng(5)
    sets = [np.unique(r.integers(0, 60, r.integers(1, 50))) for _ in range(80)]
    got = s.shared_counts(sets)
    for i, a in enumerate(sets):
        for j, b in enumerate(sets):
            assert got[i, j] == (len(np.intersect1d(a, b)) if i != j else 0)


def test_components_of_chains(spark):
    edges = [(f"{k:03}", f"{k + 1:03}") for k in range(70) if k != 40] + [("x", "x"), ("q", "r")]
    got = dict(components.components(spark.createDataFrame(edges, "a string, b string")).collect())
    assert got == {f"{k:03}": "000" if k <= 40 else "041" for k in range(71)} | {"q": "q", "r": "q"}


def test_query_on_given_tables(spark):
    rows = [tuple(r) for r in spark.read.parquet(f"{SF}/documents.parquet").select("doc_id", "text").collect()]
    got = {r.doc_id: (r.class_id, r.n_links) for r in queries.op6_jaccard_join(spark, SF).collect()}
    assert got == expected(rows)
