"""A cleaning pipeline over documents: each stage calls one operator and its result is
written as Parquet and read again as the next stage's documents.

toxicity drops the documents scored 0.5 or more; near_duplicates leaves one document of
each class; decontaminate drops contaminated documents; secrets replaces secrets in the
text (and n_chars with it); mixing returns how many words of each document the mix takes.
A stage sees all that its predecessor kept, and all but the last return the columns of
documents. As a stage begins, its predecessor is written, so what that one had broadcast is
released. Columns that are missing or extra pass through; texts may be null.
"""

from __future__ import annotations

from pyspark.sql import DataFrame, SparkSession
from pyspark.sql import functions as F

from jobgrain.llm import decontaminate, mixing, secretscan, similarjoin, toxicity
from jobgrain.llm.queries import prepared
from jobgrain.llm.shared import release, table, written

# SQL cannot tell the scores of a trained model or the candidates of a randomized join;
# the tests hold the stages against brute force instead.
ORACLE_SQL = None

_OWN = "_stage"  # a name that no column of the documents has


def _own_name(docs: DataFrame) -> str:
    name = _OWN
    while name in docs.columns:
        name += "_"
    return name


def drop_toxic(spark: SparkSession, docs: DataFrame, sf_dir: str) -> DataFrame:
    """Documents scored under 0.5 by a model of the labelled ones outside the held-out fold."""
    own = _own_name(docs)
    labels = table(spark, sf_dir, "labels")
    model = toxicity.train(docs, labels)
    return toxicity.score(docs, model, into=own).filter(F.col(own) < 0.5).select(*docs.columns)


def drop_near_duplicates(spark: SparkSession, docs: DataFrame, sf_dir: str) -> DataFrame:
    """One document of each class: the one with the smallest id. Of equal rows one stays."""
    release()
    found = written(similarjoin.similar_documents(docs), "similar")
    ids = found.select(F.col("doc_id").alias("_id"), F.col("digest").alias("_digest"), "keeps", "n_copies")
    same = F.col("doc_id").eqNullSafe(F.col("_id")) & (F.xxhash64("text") == F.col("_digest"))
    left = docs.join(ids.filter(~F.col("keeps")).select("_id", "_digest").distinct(), same, "left_anti")
    # The same id with the same words several times: they are equal copies, one stays.
    again = ids.filter(F.col("keeps") & (F.col("n_copies") > 1)).groupBy("_id", "_digest")
    again = again.agg(F.count("*").alias("n")).filter("n > 1").select("_id", "_digest")
    if not again.limit(1).count():
        return left
    several = left.join(again, same, "left_semi")
    several = several.groupBy(F.col("doc_id").alias("_id"), F.xxhash64("text").alias("_digest"))
    several = several.agg(F.first(F.struct(*docs.columns)).alias("_row")).select("_row.*")
    return left.join(again, same, "left_anti").unionByName(several)


def drop_contaminated(spark: SparkSession, docs: DataFrame, sf_dir: str) -> DataFrame:
    """Documents of which less than a twentieth lies in passages of the benchmark."""
    release()
    own = _own_name(docs)
    found = decontaminate.find_passages(docs, table(spark, sf_dir, "benchmark"), into=own)
    return found.filter(~decontaminate.contaminated(F.col(own))).select(*docs.columns)


def hide_secrets(spark: SparkSession, docs: DataFrame, sf_dir: str) -> DataFrame:
    """All documents, with secrets in the text replaced and n_chars counted anew."""
    release()
    own = _own_name(docs)
    found = secretscan.find_secrets(docs, into=own)
    clean = F.col(own)["clean"]
    changes = {"text": F.coalesce(clean, F.col("text"))}
    if "n_chars" in docs.columns:
        changes["n_chars"] = F.when(clean.isNotNull(), F.length(clean).cast("long")).otherwise(
            F.col("n_chars")
        )
    return found.withColumns(changes).select(*docs.columns)


def mix_sources(spark: SparkSession, docs: DataFrame, sf_dir: str) -> DataFrame:
    """doc_id, size, source_size, target and words taken of each document."""
    release()
    return mixing.mix(docs)


STAGES = [
    ("toxicity", drop_toxic),
    ("near_duplicates", drop_near_duplicates),
    ("decontaminate", drop_contaminated),
    ("secrets", hide_secrets),
    ("mixing", mix_sources),
]


def run(spark: SparkSession, sf_dir: str) -> DataFrame:
    """All stages over the documents of a folder."""
    prepared(spark)
    docs = table(spark, sf_dir, "documents")
    for k, (name, stage) in enumerate(STAGES):
        docs = stage(spark, docs, sf_dir)
        if k + 1 < len(STAGES):
            docs = written(docs, name)
    return docs
