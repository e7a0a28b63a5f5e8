"""Mix sources to target weights by weighted fair queueing.

Every source is a queue of its documents in a shuffled but fixed order (by digest), run
through up to MAX_REPEATS times. The copy of a document that ends after c words of its
queue has the virtual finish time c / target; all copies are sorted by that time, over
all sources, and taken while the words taken stay within the budget. The targets add up
to the budget, so each source is taken up to its own target, but for a document.

Targets: the sources, by code point and null last, weigh 3, 1, 2, and so on; they share
150 % of all words by weight, no source gets more than MAX_REPEATS times its words, and
the rest is shared again among the others.

Running sums over all rows are taken on a range-partitioned table: sums inside each
partition, plus the sums of the partitions before it. No source, however large, lands in
one task, as the ranges go by source and digest. Only two totals reach the driver.

Cases: a null or empty text has size 0 and is taken with 0 words; a source without words
has target 0; a null source is a source of its own, the last; rows that are equal in all
columns used are interchangeable, and each is a document.
"""

from __future__ import annotations

from collections.abc import Iterator

import numpy as np
import pyarrow as pa
from pyspark.sql import Column, DataFrame, Window
from pyspark.sql import functions as F

from jobgrain.llm import wordhash
from jobgrain.llm.shared import tidied, written

WEIGHTS = (3, 1, 2)
SHARE = 1.5  # of all words
MAX_REPEATS = 2


def running_totals(df: DataFrame, order: list[str], sums: dict[str, Column]) -> DataFrame:
    """Add running sums of whole numbers, own row included, over all rows by `order`."""
    parts = written(
        df.repartitionByRange(*order).withColumn("_part", F.spark_partition_id()), "running"
    )
    totals = parts.groupBy("_part").agg(*[F.sum(c).alias(f"_{n}") for n, c in sums.items()])
    earlier = Window.orderBy("_part").rowsBetween(Window.unboundedPreceding, -1)
    before = totals.select(  # one row for each partition
        "_part", *[F.coalesce(F.sum(f"_{n}").over(earlier), F.lit(0)).alias(f"_{n}") for n in sums]
    )
    inside = (
        Window.partitionBy("_part").orderBy(*order).rowsBetween(Window.unboundedPreceding, 0)
    )
    return (
        parts.join(before, "_part")
        .withColumns({n: F.sum(c).over(inside) + F.col(f"_{n}") for n, c in sums.items()})
        .drop("_part", *[f"_{n}" for n in sums])
    )


_SPACE = np.zeros(256, dtype=bool)
_SPACE[[0x20, *range(0x09, 0x0E)]] = True


def _counts(texts: pa.Array) -> pa.Array:
    data, offsets = wordhash.text_bytes(texts)
    out = np.zeros(len(offsets) - 1, dtype=np.int64)
    for low, high in wordhash.groups(offsets):
        part = offsets[low : high + 1]
        inside = ~_SPACE[data[part[0] : part[-1]]]
        begins = inside.copy()
        begins[1:] &= ~inside[:-1]
        first = part[:-1][part[:-1] < part[-1]] - part[0]
        begins[first] = inside[first]  # a text's first byte
        total = np.concatenate(([0], np.cumsum(begins)))
        out[low:high] = np.diff(total[part - part[0]])
    return pa.array(out)


def word_count(text: Column) -> Column:
    """Number of `[^\\x20\\x09-\\x0D]+` in a text; 0 for null."""

    def run(batches: Iterator[pa.Array]) -> Iterator[pa.Array]:
        for texts in batches:
            yield _counts(texts)

    return F.arrow_udf(tidied(run), "bigint").asNondeterministic()(text)


def source_targets(
    sources: DataFrame, weights=WEIGHTS, share: float = SHARE, repeats: int = MAX_REPEATS
) -> DataFrame:
    """Add weight and target to (src, source_size) rows, and the words of the sources
    before. `src` orders the sources."""
    ranked = running_totals(sources, ["src"], {"rank": F.lit(1), "words": F.col("source_size")})
    place = F.pmod(F.col("rank") - 1, F.lit(len(weights))).cast("int")
    weight = F.element_at(F.array(*map(F.lit, weights)), place + 1).cast("long")
    caps = ranked.withColumn("weight", weight).select(
        "src",
        "source_size",
        "weight",
        (F.col("words") - F.col("source_size")).alias("words_before"),
        (repeats * F.col("source_size")).alias("cap"),
        (repeats * F.col("source_size") / F.col("weight")).alias("ratio"),
    )
    caps = running_totals(
        caps, ["ratio", "src"], {"caps": F.col("cap"), "heavy": F.col("weight"), "place": F.lit(1)}
    )
    caps = written(caps, "targets")
    all_words, all_weight = caps.agg(F.sum("source_size"), F.sum("weight")).first()
    # The level at which sources from this one on, by ratio, share what is left.
    level = (share * F.lit(all_words or 0) - (F.col("caps") - F.col("cap"))) / (
        F.lit(all_weight or 0) - (F.col("heavy") - F.col("weight"))
    )
    level = caps.withColumn("level", level).filter("level <= ratio").agg(F.min_by("level", "place"))
    level = level.first()[0]
    target = F.col("cap").cast("double")
    if level is not None:
        target = F.least(target, F.lit(level) * F.col("weight"))
    return caps.select("src", "source_size", "words_before", target.alias("target"))


def mix(
    docs: DataFrame,
    text: str = "text",
    source: str = "source",
    key: str = "doc_id",
    weights=WEIGHTS,
    share: float = SHARE,
    repeats: int = MAX_REPEATS,
) -> DataFrame:
    """Per document: `key`, size, source_size, target (its source's) and taken (words,
    each copy counted)."""
    digest = F.md5(F.concat_ws("|", F.col(key).cast("string"), F.col(text)))
    sized = written(
        docs.select(
            F.col(key).alias("id"),
            F.coalesce(F.concat(F.lit("0"), F.col(source)), F.lit("1")).alias("src"),
            word_count(F.col(text)).alias("size"),
            digest.alias("digest"),
        ),
        "sized",
    )
    sources = sized.groupBy("src").agg(F.sum("size").alias("source_size"))
    targets = written(source_targets(sources, weights, share, repeats), "sources")
    total = targets.agg(F.sum("source_size")).first()[0] or 0
    queued = running_totals(sized, ["src", "digest", "size"], {"words": F.col("size")})
    copies = queued.join(targets, "src").select(
        "id",
        "src",
        "size",
        "digest",
        "source_size",
        "target",
        (F.col("words") - F.col("words_before")).alias("words"),
        F.explode(F.sequence(F.lit(0), F.lit(repeats - 1))).alias("turn"),
    )
    finish = (F.col("words") + F.col("turn") * F.col("source_size")) / F.col("target")
    copies = copies.withColumn("finish", F.when(F.col("target") > 0, finish).otherwise(F.lit(0.0)))
    taken = running_totals(
        copies, ["finish", "src", "digest", "size", "turn"], {"total": F.col("size")}
    )
    taken = taken.withColumn(
        "words_taken", F.when(F.col("total") <= share * F.lit(total), F.col("size")).otherwise(0)
    )
    # A document's copies differ only in their turn: each turn is a row, put together
    # again by what names the document. Equal rows of the input share a group.
    return (
        taken.groupBy("id", "src", "digest", "size", "source_size", "target")
        .agg(
            F.sum("words_taken").alias("words_taken"),
            F.sum(F.when(F.col("turn") == 0, 1).otherwise(0)).alias("rows"),
        )
        .select(
            F.col("id").alias(key),
            "size",
            "source_size",
            "target",
            "words_taken",
            "rows",
            F.explode(F.sequence(F.lit(1), F.col("rows"))).alias("row"),
        )
        .select(
            key,
            "size",
            "source_size",
            "target",
            _of_row(F.col("words_taken"), F.col("size"), F.col("rows"), F.col("row"), repeats).alias(
                "taken"
            ),
        )
    )


def _of_row(words: Column, size: Column, rows: Column, row: Column, repeats: int) -> Column:
    """Words of one of several equal rows: the copies taken are dealt out evenly."""
    copies = F.when(size > 0, F.floor(words / size)).otherwise(F.lit(0))
    each = F.floor(copies / rows)
    return (size * (each + F.when(row <= copies - each * rows, 1).otherwise(0))).cast("long")
