import os
import shutil
import subprocess
import sys

from pyspark.sql import functions as F

import corpus_pipeline as c
from jobgrain.llm import decontaminate, toxicity
from jobgrain.llm.shared import written
from tests.llm.helpers import SF, classes, docs_of, shingles, similar_pairs

ROOT = os.path.dirname(os.path.dirname(os.path.dirname(os.path.abspath(__file__))))


def test_stages_are_as_ordered():
    assert [name for name, _ in c.STAGES] == ["toxicity", "near_duplicates", "decontaminate", "secrets", "mixing"]
    assert c.ORACLE_SQL is None


def test_each_stage_does_its_work_on_the_one_before(spark):
    docs = spark.read.parquet(f"{SF}/documents.parquet")
    stages = dict(c.STAGES)

    first = written(stages["toxicity"](spark, docs, SF), "t")
    model = toxicity.train(docs, spark.read.parquet(f"{SF}/labels.parquet"))
    clean = toxicity.score(docs, model).filter("score < 0.5").select("doc_id")
    assert first.columns == docs.columns
    assert {r.doc_id for r in first.collect()} == {r.doc_id for r in clean.collect()}

    second = written(stages["near_duplicates"](spark, first, SF), "t")
    texts = {r.doc_id: r.text for r in first.collect()}
    sets = {k: shingles(t) for k, t in texts.items()}
    names = classes(texts, similar_pairs({k: s for k, s in sets.items() if s}))
    assert second.columns == docs.columns
    assert sorted(r.doc_id for r in second.collect()) == sorted(k for k, name in names.items() if k == name)

    third = written(stages["decontaminate"](spark, second, SF), "t")
    found = decontaminate.find_passages(second, spark.read.parquet(f"{SF}/benchmark.parquet"))
    bad = found.filter(decontaminate.contaminated(F.col("found"))).count()
    assert third.count() == second.count() - bad and third.columns == docs.columns

    fourth = written(stages["secrets"](spark, third, SF), "t")
    before, after = ({r.doc_id: r for r in x.collect()} for x in (third, fourth))
    assert before.keys() == after.keys() and fourth.columns == docs.columns
    for k, r in after.items():
        assert r.n_chars == len(r.text)
        assert (r.text == before[k].text) != ("[secret]" in r.text)

    last = stages["mixing"](spark, fourth, SF)
    rows = last.collect()
    assert len(rows) == fourth.count() and all(r.taken in (0, r.size, 2 * r.size) for r in rows)


def test_odd_documents(spark):
    text = "a b c d e f g h i j k l"
    rows = [(1, text), (1, text), (2, text.upper()), (None, None), (None, None), (None, text), (5, ""), (6, "z" * 200_000)]
    docs = docs_of(spark, rows).withColumns({"found": F.lit(1), "score": F.lit("x"), "_stage": F.lit(None).cast("int")})
    kept = docs
    for name, stage in c.STAGES[:-1]:
        kept = written(stage(spark, kept, SF), "t")
        assert kept.columns == docs.columns, name
    assert sorted(map(repr, [(r.doc_id, r.text and r.text[:9]) for r in kept.collect()])) == sorted(
        map(repr, [(1, text[:9]), (None, None), (None, None), (5, ""), (6, "z" * 9)])
    )
    assert c.mix_sources(spark, kept, SF).count() == 5
    none = docs.limit(0)
    for _, stage in c.STAGES:
        assert stage(spark, none, SF).count() == 0


def test_run(spark):
    rows = c.run(spark, SF).collect()
    assert rows and len({r.doc_id for r in rows}) == len(rows)


def test_the_rest_imports_without_these_folders(tmp_path):
    copy = tmp_path / "repo"
    skip = shutil.ignore_patterns("llm", "corpus_pipeline.py", ".git", "__pycache__", ".pytest_cache")
    shutil.copytree(ROOT, copy, ignore=skip)
    code = "import __spark_entry__ as e; n = e.queries(); assert n and not any(x.startswith('op') for x in n if x[2:3].isdigit()); print(len(n))"
    out = subprocess.run([sys.executable, "-c", code], cwd=copy, capture_output=True, text=True, timeout=100)
    assert out.returncode == 0, out.stderr


def test_registry_has_all_queries():
    import __spark_entry__ as entry

    names = entry.queries()
    assert "pipeline" in names
    for n in range(1, 11):
        assert sum(x.startswith(f"op{n}_") for x in names) == 1
