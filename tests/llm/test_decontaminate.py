import random
from collections import defaultdict

import pyarrow as pa
import pytest

from jobgrain.llm import decontaminate as d
from jobgrain.llm import queries, wordhash
from tests.llm.helpers import SF, docs_of, words


def brute(docs, tests, window):
    patterns = defaultdict(set)
    for item, text in tests:
        w = words(text)
        n = min(window, len(w))
        for k in range(len(w) - n + 1 if n else 0):
            patterns[tuple(w[k : k + n])].add(item)
    sizes = {len(p) for p in patterns}
    out = []
    for key, text in docs:
        w = words(text)
        hit, items = set(), set()
        for n in sizes:
            for k in range(len(w) - n + 1):
                if tuple(w[k : k + n]) in patterns:
                    items |= patterns[tuple(w[k : k + n])]
                    hit.update(range(k, k + n))
        out.append((key, len(w), len(hit), sorted(items), bool(hit) and 20 * len(hit) >= len(w)))
    return sorted(out, key=repr)


def found(spark, docs, tests, **options):
    tests = spark.createDataFrame(tests, "item_id long, text string")
    rows = d.find_passages(docs_of(spark, docs), tests, **options)
    r = rows["found"]
    rows = rows.select("doc_id", r["n_words"], d.hit_words(r), r["items"], d.contaminated(r))
    return sorted(((a, b, c, sorted(i), e) for a, b, c, i, e in rows.collect()), key=repr)


@pytest.mark.parametrize("seed, block", [(1, 1 << 20), (2, 60)])
def test_equals_brute_force(spark, seed, block):
    r = random.Random(seed)
    text = lambda n: " ".join(r.choice(["a", "B", "ç", "dd", "e.", "f\n"]) for _ in range(n))
    tests = [(k, text(r.randint(0, 9))) for k in range(12)] + [(3, text(6)), (50, None), (None, "a B")]
    docs = [(k, text(r.choice([0, 1, 3, 8, 40, 700]))) for k in range(40)] + [(None, None), (7, ""), (8, "dd dd")] * 2
    known = [(i, t) for i, t in tests if i is not None]
    assert found(spark, docs, tests, window=4, block_bytes=block) == brute(docs, known, 4)


def test_no_items_and_no_documents(spark):
    assert found(spark, [(1, "a b")], []) == [(1, 2, 0, [], False)]
    assert found(spark, [], [(1, "a b")]) == []


def test_long_text_is_searched_whole(spark):
    passage = " ".join(f"w{k}" for k in range(13))
    long = "filler " * 60_000 + passage + " more" * 60_000
    assert found(spark, [(1, long)], [(9, passage.upper())]) == [(1, 120_013, 13, [9], False)]


def test_words_across_pieces_and_texts(monkeypatch):
    monkeypatch.setattr(wordhash, "PIECE_BYTES", 16)
    texts = ["x" * 50 + " y", None, "", "Éa bÀ", "a b", "c", "one two three four five six seven"]
    for low, high, found_words in wordhash.groups_of(pa.array(texts)):
        for k in range(low, high):
            a, b = found_words.first[k - low : k - low + 2]
            expected = words(texts[k])
            assert b - a == len(expected)
            if expected:
                assert wordhash.word_text(found_words, a, b).decode() == " ".join(expected)


def test_query_on_given_tables(spark):
    got = {r.doc_id: r for r in queries.op1_decontaminate(spark, SF).collect()}
    docs = [tuple(r) for r in spark.read.parquet(f"{SF}/documents.parquet").select("doc_id", "text").collect()]
    tests = [tuple(r) for r in spark.read.parquet(f"{SF}/benchmark.parquet").select("item_id", "text").collect()]
    for key, n, hit, items, bad in brute(docs, tests, 13):
        r = got[key]
        assert (r.n_words, r.n_hit, r.n_items, r.contaminated) == (n, hit, len(items), bad)
