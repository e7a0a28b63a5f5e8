import random

import numpy as np
import pytest
from pyspark.sql import functions as F

from jobgrain.llm import linededup as d
from tests.llm.helpers import LOWER, docs_of

BLANKS = " \t\n\x0b\x0c\r"


def key(line):
    return line.strip(BLANKS).translate(LOWER)


def plain(rows, least_docs=3, least_chars=20):
    """Kept text, lines and dropped lines of each row of (doc_id, text)."""
    order = lambda i: (i is not None, i or 0)
    having = {}
    for i, text in rows:
        for line in (text or "").split("\n"):
            if len(key(line)) >= least_chars:
                having.setdefault(key(line), set()).add(i)
    out = []
    for i, text in rows:
        lines = (text or "").split("\n")
        kept = [
            x
            for x in lines
            if len(having.get(key(x), ())) < least_docs or max(having[key(x)], key=order) == i
        ]
        out.append((i, "\n".join(kept), len(lines), len(lines) - len(kept)))
    return sorted(out, key=str)


def found(df):
    rows = df.select("doc_id", "lines.*").collect()
    return sorted([(r.doc_id, r.kept, r.n_lines, r.n_dropped) for r in rows], key=str)


LONG = "This line is long enough to count"
EDGES = [
    (1, None), (2, ""), (3, "\n"), (4, LONG), (5, f"  {LONG.upper()}\t\n{LONG}"), (6, f"a\n{LONG}\r\nb\n"),
    (7, f"{LONG}\n{LONG}"), (7, f"{LONG}\n{LONG}"), (None, f"{LONG}\nzwanzig ä Zeichen üü ß"), (None, LONG),
    (8, "zwanzig ä Zeichen üü ß"), (9, "zwanzig ä Zeichen üü ß\nkurz"), (10, "n" * 19), (11, "n" * 19), (12, "n" * 19),
    (13, "É" * 20), (14, "é" * 20), (15, "É" * 20), (16, "É" * 20 + "\n\n\n"),
    (17, "x" * 600_000 + "\nend of a very long line"), (18, "X" * 600_000), (19, " " + "x" * 600_000),
]


def test_nulls_blanks_repeated_rows_and_very_long_lines(spark):
    got = found(d.drop_repeated_lines(docs_of(spark, EDGES)))
    assert got == plain(EDGES)


@pytest.mark.parametrize("batches,fan_out", [(1, 2), (5, 2), (7, 3)])
def test_any_number_of_batches_and_runs_gives_the_same(spark, batches, fan_out):
    draw = random.Random(5)
    lines = [f"sentence number {k} that may be repeated" for k in range(60)] + ["short", ""]
    rows = [(i, "\n".join(draw.choices(lines, k=draw.randint(1, 6)))) for i in range(150)]
    rows += rows[:10]
    got = found(d.drop_repeated_lines(docs_of(spark, rows), batches=batches, fan_out=fan_out))
    assert got == plain(rows)


def test_other_limits(spark):
    rows = [(1, "ab\ncd"), (2, "ab\nef"), (3, "cd")]
    got = found(d.drop_repeated_lines(docs_of(spark, rows), least_docs=2, least_chars=2))
    assert got == plain(rows, 2, 2)


def test_batches_in_any_order_and_twice(spark):
    batches = [
        spark.createDataFrame([(1, 1, 5), (1, 1, 6), (2, 2, 5)], "h long, c long, doc long"),
        spark.createDataFrame([(1, 1, 9), (2, 2, 4), (1, 7, 1)], "h long, c long, doc long"),
        spark.createDataFrame([(1, 1, 1), (2, 2, 8), (1, 1, 7)], "h long, c long, doc long"),
    ]
    for order in ([0, 1, 2], [2, 1, 0], [0, 0, 1, 2, 1], [1, 2, 0, 2, 0, 1, 1]):
        runs = d.LineRuns(spark, fan_out=2)
        for k in order:
            runs.add(batches[k])
        assert sorted(map(tuple, runs.repeated().collect())) == [(1, 1, 9), (2, 2, 8)], order
        assert all(len(level) < 2 for level in runs.levels)
        runs.drop()


def test_known_lines_add_no_rows(spark):
    runs = d.LineRuns(spark)
    lines = spark.range(100, 400).selectExpr("id % 10 AS h", "id % 10 AS c", "id AS doc")
    runs.add(lines)
    runs.add(lines.selectExpr("h", "c", "doc - 90 AS doc").filter("doc < 100"))
    assert [spark.table(name).count() for name in runs.levels[0]] == [30, 0]
    runs.drop()


def test_runs_are_joined_without_shuffling_them(spark):
    runs = d.LineRuns(spark)
    lines = spark.range(50).selectExpr("id % 10 AS h", "id % 10 AS c", "id AS doc")
    runs.add(lines)
    run = spark.table(runs.levels[0][0]).select(F.col("h").alias("_h"), F.col("c").alias("_c"))
    rows = runs._largest(lines).join(run.hint("merge"), F.expr("h = _h AND c = _c"), "left_anti")
    plan = rows._jdf.queryExecution().executedPlan().toString()
    after = plan[plan.index("SortMergeJoin") :]
    assert "Bucketed: true" in after and "Exchange" not in after[after.index("Bucketed: true") - 400 :].split("FileScan")[0]
    runs.drop()


def test_hash_of_a_long_line_is_that_of_its_span():
    data = np.frombuffer(b"abcdefghij" * 60_000, dtype=np.uint8)
    one = d.wordhash.spans_hash(d._OTHER[data], np.array([0]), np.array([len(data)]))[0]
    with np.errstate(over="ignore"):
        assert d._long_hash(data, d._OTHER) == one


def test_empty_table_and_extra_columns(spark):
    assert found(d.drop_repeated_lines(docs_of(spark, []))) == []
    docs = docs_of(spark, EDGES[:9]).withColumn("h", F.lit("x")).withColumn("keeper", F.lit(1)).withColumn("_doc", F.lit(1))
    assert found(d.drop_repeated_lines(docs)) == plain(EDGES[:9])
    with pytest.raises(ValueError):
        d.drop_repeated_lines(docs.withColumn("lines", F.lit(1)))
