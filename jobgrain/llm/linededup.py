"""Lines that repeat across documents, dropped by way of levelled sorted runs.

A line's key is the line without blanks (`[\\x20\\x09-\\x0D]`) at both ends, A-Z taken as
a-z; two 64-bit hashes of its bytes stand for it. Keys of at least `least_chars` code points
that `least_docs` documents have lose all their lines, but for those of the largest document.

`LineRuns` keeps what is known of the keys in runs: tables bucketed and sorted by key, with
the `least_docs` largest documents of each key, which is all that the rule needs. A batch of
lines is reduced in the same way (each document once, then the largest of a key in the tasks
that have them, so a line that a third of the documents have is a few rows when it is
shuffled), and is merge-anti-joined with every run: a line whose key a run has in enough
documents, none smaller, cannot change anything. What is left is the batch's own run. Runs
are bucketed alike, so these joins shuffle the batch alone and no run. When a level has
`fan_out` runs, they are merged into one of the next level, so n batches leave
fan_out * log n runs and each key is rewritten log n times. A batch added twice changes
nothing, nor does the order of batches; taking large ids first lets a batch drop most.

`drop_repeated_lines` deals documents into batches by ranges of their ids, adds them one
after another, merges all runs, joins the repeated keys with the lines (a hot line is split
by adaptive execution, as neither side is grouped) and gives each document its list, which
is no longer than the document. Runs and lines are written tables; nothing reaches the
driver but the bounds of the ids.

Cases: a null or empty text is one empty line. Rows with one id are one document, also those
with a null id, which is the smallest; equal rows get equal results. Very long lines are
hashed in pieces. An empty table gives no rows. A column named as `into` is refused.
"""

from __future__ import annotations

import uuid
from collections.abc import Iterator

import numpy as np
import pyarrow as pa
from pyspark.sql import DataFrame, SparkSession, Window
from pyspark.sql import functions as F

from jobgrain.llm import wordhash
from jobgrain.llm.shared import shared_path, written

LEAST_DOCS = 3
LEAST_CHARS = 20
BATCHES = 6
FAN_OUT = 3
PIECE = 1 << 18  # bytes that are hashed together

_BLANK = np.zeros(256, dtype=bool)
_BLANK[[0x20, *range(0x09, 0x0E)]] = True
_LOWER = np.arange(1, 257, dtype=np.uint64)
_LOWER[0x41:0x5B] += np.uint64(32)
with np.errstate(over="ignore"):
    _OTHER = wordhash.mix(_LOWER * np.uint64(0xBF58476D1CE4E5B9))


# --- the lines of a column -------------------------------------------------------------------


def lines_of(data: np.ndarray, offsets: np.ndarray) -> tuple[np.ndarray, np.ndarray, np.ndarray]:
    """Number of the text, first byte and end of each line; a text without a line break,
    also an empty one, is one line."""
    breaks = np.flatnonzero(data == 0x0A)
    n = len(offsets) - 1
    start = np.concatenate((offsets[:-1], breaks + 1))
    text = np.concatenate((np.arange(n), np.searchsorted(offsets, breaks, side="right") - 1))
    order = np.lexsort((start, text))
    start, text = start[order], text[order]
    end = np.empty(len(start), dtype=np.int64)
    end[:-1] = start[1:] - 1
    last = np.ones(len(start), dtype=bool)
    last[:-1] = text[1:] != text[:-1]
    end[last] = offsets[1:]
    return text, start, end


def _long_hash(values: np.ndarray, table: np.ndarray) -> np.uint64:
    """What `spans_hash` gives for all of `values`, piece by piece."""
    up, _ = wordhash._powers.to(PIECE + 1)
    total, factor = np.uint64(0), 1
    step = pow(wordhash._BASE, PIECE, 1 << 64)
    for low in range(0, len(values), PIECE):
        part = table[values[low : low + PIECE]]
        total = total + np.sum(part * up[: len(part)], dtype=np.uint64) * np.uint64(factor)
        factor = factor * step % (1 << 64)
    return wordhash.mix(np.array([total + np.uint64(len(values))], dtype=np.uint64))[0]


def line_keys(
    data: np.ndarray, start: np.ndarray, end: np.ndarray
) -> tuple[np.ndarray, np.ndarray, np.ndarray]:
    """Both hashes of each line's key, and its code points. The lines follow each other."""
    first, second = np.zeros(len(start), np.uint64), np.zeros(len(start), np.uint64)
    chars = np.zeros(len(start), np.int64)
    low = 0
    with np.errstate(over="ignore"):
        while low < len(start):
            high = int(np.searchsorted(end, start[low] + PIECE, side="right"))
            high = max(high, low + 1)
            base, piece = int(start[low]), data[start[low] : end[high - 1]]
            seen = np.flatnonzero(~_BLANK[piece])
            a = np.searchsorted(seen, start[low:high] - base)
            b = np.searchsorted(seen, end[low:high] - base)
            some = np.flatnonzero(b > a)
            a, b = seen[a[some]], seen[b[some] - 1] + 1
            if len(piece) > PIECE and len(some):
                part = piece[a[0] : b[0]]
                first[low], second[low] = _long_hash(part, _LOWER), _long_hash(part, _OTHER)
                chars[low] = np.count_nonzero((part & 0xC0) != 0x80)
            elif len(some):
                first[low + some] = wordhash.spans_hash(_LOWER[piece], a, b)
                second[low + some] = wordhash.spans_hash(_OTHER[piece], a, b)
                points = np.concatenate(([0], np.cumsum((piece & 0xC0) != 0x80)))
                chars[low + some] = points[b] - points[a]
            low = high
    return first.view(np.int64), second.view(np.int64), chars


def _key_lister(least_chars: int):
    """Distinct keys of each text: `(doc, digest, batch, h, c)` rows."""

    def run(batches: Iterator[pa.RecordBatch]) -> Iterator[pa.RecordBatch]:
        for batch in batches:
            data, offsets = wordhash.text_bytes(batch.column("text"))
            for low, high in wordhash.groups(offsets):
                part = offsets[low : high + 1] - offsets[low]
                piece = data[offsets[low] : offsets[high]]
                text, start, end = lines_of(piece, part)
                h, c, chars = line_keys(piece, start, end)
                long = chars >= least_chars
                text, h, c = text[long], h[long], c[long]
                order = np.lexsort((c, h, text))
                text, h, c = text[order], h[order], c[order]
                new = np.ones(len(text), dtype=bool)
                new[1:] = (text[1:] != text[:-1]) | (h[1:] != h[:-1]) | (c[1:] != c[:-1])
                rows = batch.select(["doc", "digest", "batch"]).take(pa.array(low + text[new]))
                yield pa.RecordBatch.from_arrays(
                    [*rows.columns, pa.array(h[new]), pa.array(c[new])],
                    names=["doc", "digest", "batch", "h", "c"],
                )

    return run


# --- the runs --------------------------------------------------------------------------------


class LineRuns:
    """Levelled runs of line keys with the `least_docs` largest documents of each."""

    def __init__(self, spark: SparkSession, least_docs: int = LEAST_DOCS, fan_out: int = FAN_OUT):
        self.spark, self.least_docs, self.fan_out = spark, least_docs, fan_out
        self.buckets = int(spark.conf.get("spark.sql.shuffle.partitions"))
        # Off, as a union of three bucketed tables, when it is written, keeps each table's
        # partitions apart but counts as dealt by key (seen in Spark 4.1.2).
        spark.conf.set("spark.sql.unionOutputPartitioning", "false")
        self.levels: list[list[str]] = []

    def add(self, lines: DataFrame) -> None:
        """Add a batch of `(h, c, doc)` lines."""
        rows = self._largest(lines.select("h", "c", "doc")).drop("place")
        for name in sum(self.levels, []):
            run = self.spark.table(name).filter(F.col("place") == self.least_docs)
            run = run.select(F.col("h").alias("_h"), F.col("c").alias("_c"), F.col("doc").alias("_doc"))
            known = (F.col("h") == F.col("_h")) & (F.col("c") == F.col("_c"))
            rows = rows.join(run.hint("merge"), known & (F.col("doc") <= F.col("_doc")), "left_anti")
        self._store(self._placed(rows), 0)
        self._compact()

    def merged(self) -> DataFrame:
        """The `place`-th largest documents of every key, of all runs."""
        names = sum(self.levels, [])
        if len(names) == 1:
            return self.spark.table(names[0])
        return self._largest(self._union(names))

    def repeated(self) -> DataFrame:
        """Keys that enough documents have, and the largest document of each: `(h, c, keeper)`."""
        found = self.merged().groupBy("h", "c").agg(
            F.max("place").alias("n"), F.max_by("doc", -F.col("place")).alias("keeper")
        )
        return found.filter(F.col("n") == self.least_docs).drop("n")

    def drop(self) -> None:
        """Forget the runs. Their files stay in the shared folder."""
        for name in sum(self.levels, []):
            self.spark.sql(f"DROP TABLE IF EXISTS {name}")
        self.levels = []

    def _union(self, names: list[str]) -> DataFrame:
        rows = self.spark.table(names[0])
        for name in names[1:]:
            rows = rows.unionByName(self.spark.table(name))
        return rows.drop("place")

    def _placed(self, rows: DataFrame) -> DataFrame:
        place = F.row_number().over(Window.partitionBy("h", "c").orderBy(F.desc_nulls_last("doc")))
        return rows.withColumn("place", place).filter(F.col("place") <= self.least_docs)

    def _largest(self, rows: DataFrame) -> DataFrame:
        """Each document once for a key, which spreads a hot key over all tasks, and of
        those the largest."""
        return self._placed(rows.distinct())

    def _store(self, rows: DataFrame, level: int) -> None:
        name = f"line_run_{uuid.uuid4().hex}"
        writer = rows.write.format("parquet").option("path", shared_path(self.spark, name))
        writer.bucketBy(self.buckets, "h", "c").sortBy("h", "c").saveAsTable(name)
        while len(self.levels) <= level:
            self.levels.append([])
        self.levels[level].append(name)

    def _compact(self) -> None:
        level = 0
        while level < len(self.levels) and len(self.levels[level]) >= self.fan_out:
            names, self.levels[level] = self.levels[level], []
            self._store(self._largest(self._union(names)), level + 1)
            for name in names:
                self.spark.sql(f"DROP TABLE IF EXISTS {name}")
            level += 1


# --- documents -------------------------------------------------------------------------------


def _keep(batches: Iterator[tuple[pa.Array, ...]]) -> Iterator[pa.Array]:
    """Texts and the keys they lose, to the text kept and the number of lines dropped."""
    for texts, hs, cs in batches:
        kept, dropped = [], []
        hs, cs = (pa.concat_arrays(x.chunks) if isinstance(x, pa.ChunkedArray) else x for x in (hs, cs))
        for k in range(len(texts)):
            if not hs[k].is_valid:
                kept.append(texts[k].as_py())
                dropped.append(0)
                continue
            line = (texts[k].as_py() or "").encode()
            data = np.frombuffer(line, dtype=np.uint8)
            _, start, end = lines_of(data, np.array([0, len(data)]))
            h, c, _ = line_keys(data, start, end)
            lost = _found(h, c, hs[k].values.to_numpy(), cs[k].values.to_numpy())
            stays = [line[a:b] for a, b in zip(start[~lost].tolist(), end[~lost].tolist())]
            kept.append(b"\n".join(stays).decode())
            dropped.append(int(lost.sum()))
        yield pa.StructArray.from_arrays(
            [pa.array(kept, pa.string()), pa.array(dropped, pa.int64())], names=["kept", "n_dropped"]
        )


def _found(h: np.ndarray, c: np.ndarray, some_h: np.ndarray, some_c: np.ndarray) -> np.ndarray:
    """Which (h, c) are among some others."""
    n = len(some_h)
    every_h, every_c = np.concatenate((some_h, h)), np.concatenate((some_c, c))
    order = np.lexsort((np.arange(len(every_h)), every_c, every_h))
    new = np.ones(len(order), dtype=bool)
    new[1:] = (np.diff(every_h[order]) != 0) | (np.diff(every_c[order]) != 0)
    leads = order[np.flatnonzero(new)] < n
    out = np.empty(len(order), dtype=bool)
    out[order] = leads[np.cumsum(new) - 1]
    return out[n:]


def drop_repeated_lines(
    docs: DataFrame,
    text: str = "text",
    key: str = "doc_id",
    into: str = "lines",
    least_docs: int = LEAST_DOCS,
    least_chars: int = LEAST_CHARS,
    batches: int = BATCHES,
    fan_out: int = FAN_OUT,
) -> DataFrame:
    """Add a struct column `into`: kept (the text without repeated lines), n_lines (before)
    and n_dropped. Ids are whole numbers."""
    if into in docs.columns:
        raise ValueError(f"the documents have a column {into!r}; name another with into=")
    spark = docs.sparkSession
    shares = F.lit([k / batches for k in range(1, batches)]).cast("array<double>")
    bounds = docs.agg(F.percentile_approx(key, shares, F.lit(1000))).first()[0] if batches > 1 else []
    number = F.lit(0)
    for bound in bounds or []:
        number = number + (F.col(key) > bound).cast("int")
    digest = F.xxhash64(F.coalesce(F.col(text), F.lit("")))
    rows = docs.select(
        F.col(key).cast("long").alias("doc"),
        digest.alias("digest"),
        F.coalesce(number, F.lit(0)).alias("batch"),
        F.coalesce(F.col(text), F.lit("")).alias("text"),
    )
    lines = rows.mapInArrow(_key_lister(least_chars), "doc long, digest long, batch int, h long, c long")
    path = shared_path(spark, "lines")
    lines.write.partitionBy("batch").parquet(path)
    lines = spark.read.schema("doc long, digest long, h long, c long, batch int").parquet(path)
    runs = LineRuns(spark, least_docs, fan_out)
    for k in reversed(range(len(bounds or []) + 1)):
        runs.add(lines.filter(F.col("batch") == k))
    repeated = written(runs.repeated(), "repeated")
    runs.drop()
    lost = lines.join(repeated, ["h", "c"]).filter(~F.col("doc").eqNullSafe(F.col("keeper")))
    pairs = F.collect_set(F.struct("h", "c")).alias("pairs")
    lost = lost.groupBy(F.col("doc").alias("_doc"), F.col("digest").alias("_digest")).agg(pairs)
    lost = lost.select("_doc", "_digest", F.col("pairs.h").alias("hs"), F.col("pairs.c").alias("cs"))
    found = docs.select(
        F.struct(*[F.col(f"`{c}`") for c in docs.columns]).alias("row"),
        F.col(key).cast("long").alias("doc"),
        digest.alias("digest"),
        F.coalesce(F.col(text), F.lit("")).alias("text"),
    )
    same = F.col("doc").eqNullSafe(F.col("_doc")) & (F.col("digest") == F.col("_digest"))
    found = found.join(lost.hint("rebalance"), same, "left")
    kept = F.arrow_udf(_keep, "struct<kept:string,n_dropped:bigint>").asNondeterministic()
    n_lines = F.length("text") - F.length(F.replace("text", F.lit("\n"), F.lit(""))) + 1
    found = found.withColumn("kept", kept("text", "hs", "cs"))
    value = F.struct(
        F.col("kept.kept").alias("kept"),
        n_lines.cast("long").alias("n_lines"),
        F.col("kept.n_dropped").alias("n_dropped"),
    )
    return found.select("row.*", value.alias(into))
