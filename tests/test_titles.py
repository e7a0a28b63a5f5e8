import pyarrow as pa
from hypothesis import given, settings
from hypothesis import strategies as st
from pyspark.sql import functions as F

from jobgrain.functions import titles
from jobgrain.functions.text import normalize_title

VECTORS = """
Internship - Software Engineer - Summer 2026 (GEM)|Software Engineering|Internship
AI Senior Consultant|Data and Analytics|Senior Level
SAP BASIS Consultant|Data and Analytics|Mid Level
Senior Technical Security Specialist|Computer and IT|Senior Level
Maintenance Technician|Data and Analytics|Mid Level
BI Developer|Software Engineering|Mid Level
IT Manager|Computer and IT|Senior Level
Junior Data Analyst|Data and Analytics|Entry Level
Sr-Data Engineer|Data and Analytics|Senior Level
Graduate Trainee|Data and Analytics|Internship
Internal Auditor|Software Engineering|Internship
Statistcs|Data and Analytics|Mid Level
Helpdsk|Computer and IT|Mid Level
zzz|Software Engineering|Mid Level
Assistant Chief Engineer - Critical Environments|Data and Analytics|Senior Level
"""


def test_vectors(spark):
    rows = [tuple(line.split("|")) for line in VECTORS.strip().splitlines()] + [(None, None, None)]
    df = spark.createDataFrame(rows, "title string, category string, level string")
    df = df.withColumn("t", normalize_title(F.col("title")))
    got = titles.with_category(df, "t", "c").withColumn("l", titles.level(F.col("t"))).collect()
    assert [(r.title, r.c, r.l) for r in got] == rows


def plain_rank(title, groups):
    return next((k for k, words in enumerate(groups.values()) if any(w in title for w in words)), 9)


KEYWORD_PARTS = st.sampled_from(
    [*[w for g in titles.CATEGORY_KEYWORDS.values() for w in g], *[w for g in titles.LEVEL_KEYWORDS.values() for w in g],
     " ", "x", "a", "i", "it", "dat", "é", "日本", "sr", ".", "-", "\0"]
)


@settings(max_examples=200, deadline=None)
@given(st.lists(st.lists(KEYWORD_PARTS, max_size=4).map("".join), max_size=8))
def test_keywords_equal_substring_tests(batch):
    trie = titles.KeywordTrie(titles.CATEGORY_KEYWORDS, titles.LEVEL_KEYWORDS)
    found = trie.hits(*titles._bytes_of(pa.array(batch, pa.string())))
    want = [[plain_rank(t, g) for g in (titles.CATEGORY_KEYWORDS, titles.LEVEL_KEYWORDS)] for t in batch]
    assert found.tolist() == want


def test_a_keyword_does_not_run_into_the_next_title():
    trie = titles.KeywordTrie({"x": ["abc"], "y": ["bc", "cab"]})
    data, offsets = titles._bytes_of(pa.array(["ab", "cab", None, "", "abc", "b", "c"]).slice(0))
    assert trie.hits(data, offsets).ravel().tolist() == [9, 1, 9, 9, 0, 9, 9]
    part = pa.array(["abc", "ab", "cab"]).slice(1)
    assert trie.hits(*titles._bytes_of(part)).ravel().tolist() == [9, 1]


def test_category_and_level_come_from_one_pass(spark):
    df = spark.range(3).selectExpr("concat('data ', id) AS t", "id AS _settled")
    both = df.select(titles.level(F.col("t")), titles.keyword_category(F.col("t")), "_settled")
    plan = both._jdf.queryExecution().executedPlan().toString()
    assert plan.count("ArrowEvalPython [") == 1 and plan.split("ArrowEvalPython [")[1].split("]")[0].count("_keyword_labels") == 1
    assert titles.with_labels(df, "t", "c", "l").columns == ["t", "_settled", "c", "l"]


def lcs(a, b):
    row = [0] * (len(b) + 1)
    for x in a:
        last = 0
        for j, y in enumerate(b, 1):
            last, row[j] = row[j], last + 1 if x == y else max(row[j], row[j - 1])
    return row[-1]


def brute_score(a, b):
    """Every window of the longer text, also those that hang over its ends."""
    short, long = sorted((a, b), key=len)
    if not short:
        return 100.0 if not long else 0.0

    def one_way(s, t):
        best = 0.0
        for start in range(1 - len(s), len(t)):
            window = t[max(start, 0) : start + len(s)]
            best = max(best, 200.0 * lcs(s, window) / (len(s) + len(window)))
        return best

    best = one_way(short, long)
    return max(best, one_way(long, short)) if len(a) == len(b) else best


def brute_label(title):
    best, label = 0.0, titles.DEFAULT_CATEGORY
    for name, words in titles.CATEGORY_KEYWORDS.items():
        for word in words:
            score = brute_score(title, word)
            if score > best:
                best, label = score, name
    return label if best >= titles.FUZZY_THRESHOLD else titles.DEFAULT_CATEGORY


WORDS = st.text(alphabet="abdehilopst wsé😀", max_size=30)


@settings(max_examples=150, deadline=None)
@given(WORDS, WORDS)
def test_window_score(a, b):
    assert abs(titles.best_window_score(a, b) - brute_score(a, b)) < 1e-9


@settings(max_examples=25, deadline=None)
@given(st.lists(WORDS, min_size=1, max_size=6))
def test_labels_together(batch):
    assert titles.closest_labels(batch) == [brute_label(t) for t in batch]


def test_labels_do_not_depend_on_grouping(monkeypatch):
    batch = ["helpdsk", "statistcs", "", "as", "aws", "infra structure", "x" * 300, "helpd", "sysadm in"]
    whole = titles.closest_labels(batch)
    monkeypatch.setattr(titles, "_CHUNK_CHARS", 5)
    assert titles.closest_labels(batch) == whole == [brute_label(t) for t in batch]


def test_a_long_text_is_scored_whole(spark):
    text = "q " * 50_000 + "helpdsk"
    assert titles.closest_labels([text]) == ["Computer and IT"]
