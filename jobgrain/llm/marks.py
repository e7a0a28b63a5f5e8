"""A bit table of keys, of fixed size, that spares a join most rows it would drop.

The table has MARK_BITS bits, 16 MB whatever the data, so it may be broadcast. A row whose
bit is not set has certainly none of the keys and need not be shuffled; the join after it
decides about the others. With very many keys the table fills up and spares less.
"""

from __future__ import annotations

from collections.abc import Iterator

import numpy as np
import pyarrow as pa
from pyspark.sql import Column, DataFrame, SparkSession
from pyspark.sql import functions as F

from jobgrain.llm.shared import sent, tidied

MARK_BITS = 1 << 27


def _mark(*columns: str) -> Column:
    return F.pmod(F.xxhash64(*columns), F.lit(MARK_BITS))


def bit_table(keys: DataFrame, *columns: str) -> np.ndarray:
    """The table of the keys in some columns, as 64-bit words."""
    bit = F.expr("shiftleft(1L, CAST(pmod(mark, 64) AS INT))")
    words = keys.select(_mark(*columns).alias("mark")).groupBy(F.expr("mark DIV 64").alias("word"))
    words = words.agg(F.bit_or(bit).alias("bits")).toArrow()
    table = np.zeros(MARK_BITS // 64, dtype=np.int64)
    table[words.column("word").to_numpy()] = words.column("bits").to_numpy()
    return table


def may_be(table: np.ndarray, *columns: str) -> Column:
    """False for rows that certainly are not among the table's keys. The columns must have
    the types of the keys'."""
    shared = sent(SparkSession.active(), table.tobytes())

    def run(batches: Iterator[pa.Array]) -> Iterator[pa.Array]:
        table = np.frombuffer(shared.value, dtype=np.uint8)
        for marks in batches:
            mark = marks.to_numpy(zero_copy_only=False)
            yield pa.array((table[mark >> 3] >> (mark & 7).astype(np.uint8)) & 1 == 1)

    return F.arrow_udf(tidied(run), "boolean").asNondeterministic()(_mark(*columns))
