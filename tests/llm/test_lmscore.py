import math
from collections import Counter

import numpy as np

from jobgrain.llm import lmscore, queries
from tests.llm.helpers import SF, docs_of, words


def plain_scores(docs, good, vocabulary, smoothing=lmscore.SMOOTHING):
    """Scores by dictionaries; `vocabulary` are the known words, the rest is one symbol."""
    code = lambda text: [w if w in vocabulary else "" for w in words(text)]
    size = len(vocabulary) + 2

    def counts(texts):
        pairs, before = Counter(), Counter()
        for text in texts:
            last = "<s>"
            for w in code(text):
                pairs[last, w] += 1
                last = w
        return pairs

    background, target = counts(t for _, t in docs), counts(t for k, t in docs if k in good)
    total = sum(target.values()) or 1.0
    if not target:
        target = background

    def model(pairs):
        scale = total / max(sum(pairs.values()), 1)
        word, row = Counter(), Counter()
        for (a, b), n in pairs.items():
            word[b] += n * scale
            row[a] += n * scale
        everything = sum(word.values())

        def log(a, b):
            own = (word[b] + 1) / (everything + size)
            return math.log((pairs[a, b] * scale + smoothing * own) / (row[a] + smoothing))

        return log

    target_log, background_log = model(target), model(background)
    out = {}
    for k, text in docs:
        w = code(text)
        steps = list(zip(["<s>", *w], w))
        if steps:
            out[k] = (
                len(w),
                -sum(target_log(a, b) for a, b in steps) / len(w),
                -sum(background_log(a, b) for a, b in steps) / len(w),
            )
        else:
            out[k] = (0, None, None)
    return out


def check(rows, expected):
    assert len(rows) == len(expected)
    for r in rows:
        n, target, background = expected[r.doc_id]
        assert r.n_words == n
        if n:
            assert np.isclose(r.target_entropy, target, atol=1e-4)
            assert np.isclose(r.background_entropy, background, atol=1e-4)
            assert np.isclose(r.score, background - target, atol=1e-4)
        else:
            assert r.score is None


def test_equals_plain_models(spark):
    docs = [(1, "a b a c"), (2, "a a b, B. d"), (3, "c c c a"), (4, None), (5, ""), (6, "d a b a b")]
    labels = spark.createDataFrame([(1, 1), (6, 1), (6, 0), (2, 0), (None, 1), (3, None)], "doc_id long, quality int")
    rows = lmscore.score_documents(docs_of(spark, docs), labels, words=3).collect()
    counts = Counter(w for _, t in docs for w in words(t)).most_common()
    assert counts[2][1] > counts[3][1]
    check(rows, plain_scores(docs, {1, 6}, {w for w, _ in counts[:3]}))


def test_without_targets_and_without_rows(spark):
    labels = spark.createDataFrame([], "doc_id long, quality int")
    rows = lmscore.score_documents(docs_of(spark, [(1, "a b"), (None, "c")]), labels).collect()
    assert [round(r.score, 9) for r in rows] == [0.0, 0.0]
    assert lmscore.score_documents(docs_of(spark, []), labels).collect() == []


def test_query_equals_plain_models(spark):
    docs = [tuple(r) for r in spark.read.parquet(f"{SF}/documents.parquet").select("doc_id", "text").collect()]
    good = {r.doc_id for r in spark.read.parquet(f"{SF}/labels.parquet").filter("quality = 1").collect()}
    known = lmscore.vocabulary(spark.read.parquet(f"{SF}/documents.parquet"))
    import pyarrow as pa

    from jobgrain.llm import wordhash

    counts = Counter(w for _, t in docs for w in words(t))
    names = list(counts)
    hashes = next(wordhash.groups_of(pa.array([" ".join(names)])))[2].hash
    vocabulary = {n for n, h in zip(names, hashes) if h in set(known)}
    assert len(vocabulary) == len(known) == min(lmscore.WORDS, len(counts))
    least = min(counts[w] for w in vocabulary)
    assert all(w in vocabulary for w, n in counts.items() if n > least)
    check(queries.op5_lm_scores(spark, SF).collect(), plain_scores(docs, good, vocabulary))


def test_words_beyond_any_number_tell_texts_apart(spark):
    rare = [f"w{k}" for k in range(3_000)]  # each twice, none among 2,046 most frequent ones
    docs = [(k, f"{a} {b} common") for k, (a, b) in enumerate(zip(rare, rare[1:] + rare[:1]))]
    good = {k for k, _ in docs if k < 1_500}
    labels = spark.createDataFrame([(k, 1) for k in good], "doc_id long, quality int")
    rows = lmscore.score_documents(docs_of(spark, docs), labels).collect()
    check(rows, plain_scores(docs, good, {*rare, "common"}))
    scores = {r.doc_id: r.score for r in rows}
    assert min(scores[k] for k in range(1, 1_499)) > max(scores[k] for k in range(1_501, 2_999))


def test_blocks_do_not_change_scores(spark, monkeypatch):
    docs = [tuple(r) for r in spark.read.parquet(f"{SF}/documents.parquet").select("doc_id", "text").limit(60).collect()]
    labels = spark.createDataFrame([(k, 1) for k, _ in docs[::3]], "doc_id long, quality int")
    monkeypatch.setattr(lmscore, "BLOCK", 500)
    monkeypatch.setattr(lmscore, "BUCKETS", 2)
    rows = lmscore.score_documents(docs_of(spark, docs), labels).collect()
    everything = {w for _, t in docs for w in words(t)}
    check(rows, plain_scores(docs, {k for k, _ in docs[::3]}, everything))
