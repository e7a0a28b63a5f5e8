"""Approximate nearest neighbours: one navigable graph per shard, results merged.

Vectors are dealt to shards of about SHARD_ROWS by the digest of their id, so no shard is
large, whatever the data. Each shard's graph is built in one task and stored as a row of
flat arrays, from the vectors of that shard alone: every vector is indexed, nothing is
sampled. The queries, a stated set, go to every shard in blocks: a task holds one graph and
one batch of queries. Each shard gives its best k for a query, and the best of those are the
result; products are in double precision on the original vectors.

The work is queries times shards, each a search that sees a small part of the shard; a
graph's build looks at all pairs inside its shard, of bounded size. Recall against brute
force is measured in the tests.

Cases: vectors that are null, zero, or hold null or non-finite numbers take no part, nor do
rows without an id. Equal rows count once; an id with several vectors has them all. Vectors
of another length than the query's are not compared. An id is never its own neighbour. With
fewer than k candidates all are given.
"""

from __future__ import annotations

from collections.abc import Iterator

import numpy as np
import pyarrow as pa
from pyspark.sql import Column, DataFrame, Window
from pyspark.sql import functions as F

from jobgrain.llm import hnsw
from jobgrain.llm.shared import written
from jobgrain.llm.similarjoin import _runs

SHARD_ROWS = 16_384
QUERY_ROWS = 1_024  # queries searched side by side
MOST_PARTITIONS = 20_000
INDEX = (
    "size int, shard int, ids binary, first binary, vectors binary, "
    "members array<binary>, links array<binary>"
)
FOUND = "query_id bigint, vec_id bigint, score double"


def _usable(vector: Column) -> Column:
    bad = F.exists(vector, lambda x: x.isNull() | F.isnan(x) | (F.abs(x) == float("inf")))
    return vector.isNotNull() & ~bad & F.exists(vector, lambda x: x != 0)


def usable_vectors(df: DataFrame, key: str = "vec_id", vector: str = "embedding") -> DataFrame:
    """(vec_id, vector) of the rows that take part, each once."""
    rows = df.select(
        F.col(key).cast("long").alias("vec_id"), F.col(vector).cast("array<double>").alias("vector")
    )
    return rows.filter(F.col("vec_id").isNotNull() & _usable(F.col("vector"))).distinct()


def _stacked(column: pa.Array) -> np.ndarray:
    lists = column.combine_chunks() if isinstance(column, pa.ChunkedArray) else column
    return lists.flatten().to_numpy(zero_copy_only=False).reshape(len(lists), -1)


def _builder(batches: Iterator[pa.RecordBatch]) -> Iterator[pa.RecordBatch]:
    for shard in _runs(batches, ["size", "shard"]):
        ids = shard.column("vec_id").to_numpy()
        flat = hnsw.Graph.build(ids, _stacked(shard.column("vector"))).flat()
        yield pa.RecordBatch.from_arrays(
            [
                pa.array([shard.column("size")[0].as_py()], pa.int32()),
                pa.array([shard.column("shard")[0].as_py()], pa.int32()),
                pa.array([flat["ids"]], pa.binary()),
                pa.array([flat["first"]], pa.binary()),
                pa.array([flat["vectors"]], pa.binary()),
                pa.array([flat["members"]], pa.list_(pa.binary())),
                pa.array([flat["links"]], pa.list_(pa.binary())),
            ],
            names=["size", "shard", "ids", "first", "vectors", "members", "links"],
        )


def _shards(vectors: DataFrame, shard_rows: int) -> int:
    return max(1, -(-vectors.count() // shard_rows))


def build_index(vectors: DataFrame, shards: int) -> DataFrame:
    """One row of flat arrays per vector length and shard."""
    rows = vectors.withColumn("size", F.size("vector")).withColumn(
        "shard", F.pmod(F.xxhash64("vec_id"), F.lit(shards)).cast("int")
    )
    return (
        rows.repartition(min(4 * shards, MOST_PARTITIONS), "size", "shard")
        .sortWithinPartitions("size", "shard", "vec_id")
        .mapInArrow(_builder, INDEX)
    )


def _searcher(k: int, width: int):
    def run(batches: Iterator[pa.RecordBatch]) -> Iterator[pa.RecordBatch]:
        graph, at = None, None
        for batch in batches:
            where = list(zip(batch.column("size").to_pylist(), batch.column("shard").to_pylist()))
            is_query = np.array(batch.column("vec_id").is_valid())
            low = 0
            while low < len(where):
                if not is_query[low]:  # the graph of the queries that follow
                    row = batch.slice(low, 1).select(["ids", "first", "vectors", "members", "links"])
                    graph, at = hnsw.Graph.of_flat(row.to_pylist()[0]), where[low]
                    low += 1
                    continue
                high = low
                while high < len(where) and high - low < QUERY_ROWS and is_query[high] and where[high] == where[low]:
                    high += 1
                if at == where[low]:  # else no vector of that length is in the shard
                    ids = batch.column("vec_id").slice(low, high - low).to_numpy(zero_copy_only=False)
                    ids = ids.astype(np.int64)
                    queries = _stacked(batch.column("vector").slice(low, high - low))
                    row, found, score = graph.nearest(ids, queries, k, width)
                    yield pa.RecordBatch.from_arrays(
                        [pa.array(ids[row]), pa.array(found), pa.array(score)],
                        names=["query_id", "vec_id", "score"],
                    )
                low = high

    return run


def search(
    index: DataFrame, queries: DataFrame, shards: int, k: int, width: int = hnsw.WIDTH
) -> DataFrame:
    """(query_id, rank, vec_id, score) of the k nearest found to each (vec_id, vector)."""
    asked = queries.select(
        F.size("vector").alias("size"),
        F.explode(F.sequence(F.lit(0), F.lit(shards - 1))).alias("shard"),
        "vec_id",
        "vector",
    )
    both = index.unionByName(asked, allowMissingColumns=True)  # graphs have no vec_id
    found = (
        both.repartition(min(4 * shards, MOST_PARTITIONS), "size", "shard")
        .sortWithinPartitions("size", "shard", F.col("vec_id").asc_nulls_first())
        .mapInArrow(_searcher(k, width), FOUND)
    )
    order = Window.partitionBy("query_id").orderBy(F.desc("score"), "vec_id")
    return found.withColumn("rank", F.row_number().over(order)).filter(F.col("rank") <= k)


def nearest_neighbours(
    df: DataFrame,
    queries: Column,
    k: int = 20,
    key: str = "vec_id",
    vector: str = "embedding",
    shard_rows: int = SHARD_ROWS,
    width: int = hnsw.WIDTH,
) -> DataFrame:
    """(query_id, rank, vec_id, score): the k nearest found of the rows for which `queries`,
    a condition on vec_id, holds."""
    vectors = written(usable_vectors(df, key, vector), "vectors")
    shards = _shards(vectors, shard_rows)
    index = written(build_index(vectors, shards), "index")
    return search(index, vectors.filter(queries), shards, k, width)
