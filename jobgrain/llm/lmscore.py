"""Cross-entropy difference of two matched bigram models.

The target model is counted over the documents labelled as of good quality, the background
model over all documents. Both share one vocabulary, all words of all documents (or, where
`words` is given, as many of the most frequent, ties by digest, and a symbol for all others),
a symbol for the start of a text, and one smoothing: a bigram's probability is mixed with the
word's own, with the weight of SMOOTHING occurrences. The background counts are scaled to the
size of the target's, so neither model is sharper for having seen more. A document's score is
the mean over its words of log target minus log background probability: the higher, the more
it is like the target.

The models grow with the input, so neither passes through the driver nor is broadcast.
Texts are encoded once into a table of blocks of about BLOCK words, each with its distinct
words and their numbers in the texts. What is counted is named by a 64-bit key: a word (how
often it is there and how often it ends a text) or a bigram. A block counts its own keys
and deals them to buckets by their upper bits; a bucket adds up the counts of all blocks and
returns the sums to each block, in the order in which it asked, and the block scores its
texts. So a key has one place in a block however often it is there, and no key is hot.
There are BUCKETS buckets, or as many as blocks if these are more, so that a bucket stays of
a block's size. Only the totals of words, and the 16 MB bit table of `marks`, reach the
driver.

Cases: a text without words, or null, has n_words 0 and null entropies. Rows without an id
count for the background and are scored. Several labels for an id: any good one makes the
document a target. Without any target document both models are the same and scores are 0.
"""

from __future__ import annotations

import math
from collections.abc import Iterator

import numpy as np
import pyarrow as pa
from pyspark import TaskContext
from pyspark.sql import DataFrame
from pyspark.sql import functions as F

from jobgrain.llm import wordhash
from jobgrain.llm.marks import bit_table, may_be
from jobgrain.llm.shared import written

WORDS = math.inf  # all of them
SMOOTHING = 50.0
BLOCK = 1 << 20  # words that are counted and scored together
BUCKETS = 1 << 10
OTHER, START = np.uint64(0), np.uint64(1)
BLOCKS = (
    "block long, ids array<long>, good array<boolean>, sizes array<long>, words binary, codes binary, "
    "n long, n_good long"
)
CHUNKS = "bucket int, block long, keys binary, counts binary"
SUMS = "bucket int, block long, counts binary, words long"
SCORES = "id long, n_words long, target double, background double"


def _word_counter(batches: Iterator[pa.RecordBatch]) -> Iterator[pa.RecordBatch]:
    for batch in batches:
        for _, _, words in wordhash.groups_of(batch.column("text")):
            word, n = np.unique(words.hash, return_counts=True)
            yield pa.RecordBatch.from_arrays(
                [pa.array(word.view(np.int64)), pa.array(n.astype(np.int64))], names=["word", "n"]
            )


def vocabulary(docs: DataFrame, text: str = "text", words: float = WORDS) -> np.ndarray:
    """Sorted hashes of the most frequent words."""
    counts = docs.select(F.col(text).alias("text")).mapInArrow(_word_counter, "word long, n long")
    counts = counts.groupBy("word").agg(F.sum("n").alias("n"))
    if words != math.inf:
        counts = counts.orderBy(F.desc("n"), "word").limit(words)
    return np.sort(counts.select("word").toArrow().column("word").to_numpy().view(np.uint64))


def _packed(values: np.ndarray) -> bytes:
    """Numbers, byte by byte of their places, compressed."""
    planes = np.ascontiguousarray(values).view(np.uint8).reshape(len(values), values.itemsize).T
    return len(values).to_bytes(8, "little") + pa.compress(planes.tobytes(), codec="zstd", asbytes=True)


def _unpacked(line: bytes, kind) -> np.ndarray:
    n, width = int.from_bytes(line[:8], "little"), np.dtype(kind).itemsize
    planes = pa.decompress(line[8:], n * width, codec="zstd", asbytes=True)
    planes = np.frombuffer(planes, dtype=np.uint8).reshape(width, n)
    return np.ascontiguousarray(planes.T).view(kind).reshape(n)


def _block(number: int, parts: list, known: np.ndarray | None) -> pa.RecordBatch:
    """One row: the texts' ids, kinds and sizes, the distinct words, and each word's number."""
    ids, good, sizes, hashes = zip(*parts)
    ids, good = pa.concat_arrays(ids), pa.concat_arrays(good)
    sizes, hashes = np.concatenate(sizes), np.concatenate(hashes)
    if known is not None:
        hashes = np.where(np.isin(hashes, known), hashes, OTHER)
    words, codes, n = np.unique(hashes, return_inverse=True, return_counts=True)
    order = np.argsort(-n, kind="stable")  # frequent words get small numbers
    rank = np.empty(len(order), dtype=np.int64)
    rank[order] = np.arange(len(order))
    one = lambda values: pa.ListArray.from_arrays(pa.array([0, len(values)], pa.int32()), values)
    columns = [
        pa.array([number]),
        one(ids),
        one(good),
        one(pa.array(sizes, pa.int64())),
        pa.array([words[order].tobytes()], pa.binary()),
        pa.array([_packed(rank[codes].astype(np.uint32))], pa.binary()),
        pa.array([len(codes)]),
        pa.array([int(sizes[good.to_numpy(zero_copy_only=False)].sum())]),
    ]
    return pa.RecordBatch.from_arrays(
        columns, names=["block", "ids", "good", "sizes", "words", "codes", "n", "n_good"]
    )


def _blocks(known, least: int):
    def run(batches: Iterator[pa.RecordBatch]) -> Iterator[pa.RecordBatch]:
        number = TaskContext.get().partitionId() << 32
        words = known.value if known is not None else None
        parts, size = [], 0
        for batch in batches:
            for low, high, found in wordhash.groups_of(batch.column("text")):
                part = (batch.column(k).slice(low, high - low) for k in ("id", "good"))
                parts.append((*part, np.diff(found.first), found.hash))
                size += len(found.hash) + high - low
                if size >= least:
                    yield _block(number, parts, words)
                    number, parts, size = number + 1, [], 0
        if parts:
            yield _block(number, parts, words)

    return run


class Asked:
    """What a block asks for: sorted `keys` (odd ones are words), of which `edges` are the
    bounds of buckets, and where in them each word of its texts finds its counts."""

    def __init__(self, words: bytes, codes: bytes, sizes: np.ndarray, buckets: int):
        words, codes = np.frombuffer(words, dtype=np.uint64), _unpacked(codes, np.uint32).astype(np.int64)
        ends = np.cumsum(sizes)
        self.first, self.last = np.zeros(len(codes), dtype=bool), np.zeros(len(codes), dtype=bool)
        self.first[(ends - sizes)[sizes > 0]] = self.last[ends[sizes > 0] - 1] = True
        before = np.empty_like(codes)
        before[1:] = codes[:-1]
        before[self.first] = len(words)
        pair, at = np.unique(before * len(words) + codes, return_inverse=True)
        befores = np.concatenate((words, [START]))
        with np.errstate(over="ignore"):
            pair, word = pair // max(len(words), 1), pair % max(len(words), 1)
            pair = wordhash.mix(wordhash.mix(befores[pair] + np.uint64(2)) + words[word])
            start = wordhash.mix(befores[-1:])
        odd = np.uint64(1)
        keys = np.concatenate((words | odd, start & ~odd, pair & ~odd))
        order = np.argsort(keys)
        place = np.empty(len(keys), dtype=np.int64)
        place[order] = np.arange(len(keys))
        self.keys, self.shift = keys[order], np.uint64(65 - buckets.bit_length())
        self.edges = np.searchsorted(self.keys >> self.shift, np.arange(buckets + 1, dtype=np.uint64))
        self.word, self.row, self.pair = place[codes], place[before], place[len(words) + 1 + at]

    def counts(self, good: np.ndarray) -> np.ndarray:
        """How often each key is there, and how often as the end of a text: in all texts and
        in good ones."""
        out = []
        for chosen in (np.ones(len(good), dtype=bool), good):
            there = (self.word[chosen], self.pair[chosen], self.row[chosen & self.first])
            for at in (np.concatenate(there), self.word[chosen & self.last]):
                out.append(np.bincount(at, minlength=len(self.keys)).astype(np.uint32))
        return np.stack(out)


def _lists(batch, name: str) -> list[np.ndarray]:
    return [x.values.to_numpy(zero_copy_only=False) for x in batch.column(name)]


def _chunks(buckets: int):
    def run(batches: Iterator[pa.RecordBatch]) -> Iterator[pa.RecordBatch]:
        for batch in batches:
            blocks, words, codes = (batch.column(k).to_pylist() for k in ("block", "words", "codes"))
            sizes, good = _lists(batch, "sizes"), _lists(batch, "good")
            for k, block in enumerate(blocks):
                asked = Asked(words[k], codes[k], sizes[k], buckets)
                counts = asked.counts(np.repeat(good[k].astype(bool), sizes[k]))
                used = np.flatnonzero(np.diff(asked.edges))
                for low in range(0, len(used), 1 << 8):
                    part = used[low : low + (1 << 8)]
                    spans = [(asked.edges[b], asked.edges[b + 1]) for b in part]
                    columns = [
                        pa.array(part.astype(np.int32)),
                        pa.array(np.full(len(part), block)),
                        # the lowest key, then the steps between neighbours
                        pa.array([_packed(np.diff(asked.keys[a:b], prepend=np.uint64(0))) for a, b in spans]),
                        pa.array([_packed(counts[:, a:b].ravel()) for a, b in spans]),
                    ]
                    yield pa.RecordBatch.from_arrays(columns, names=["bucket", "block", "keys", "counts"])

    return run


def _sums(chunks: pa.Table) -> pa.Table:
    """A bucket's counts, added up over the blocks and given to each, and (once) its number
    of words."""
    keys = [np.cumsum(_unpacked(x, np.uint64), dtype=np.uint64) for x in chunks.column("keys").to_pylist()]
    edges = np.cumsum([0, *map(len, keys)])
    keys, at = np.unique(np.concatenate(keys), return_inverse=True)
    counts = [_unpacked(x, np.uint32).reshape(4, -1) for x in chunks.column("counts").to_pylist()]
    counts = np.concatenate(counts, axis=1)
    total = np.stack([np.bincount(at, weights=n, minlength=len(keys)).astype(np.uint64) for n in counts])
    words = np.zeros(len(edges) - 1, dtype=np.int64)
    words[:1] = int((keys & np.uint64(1)).sum())
    columns = [chunks.column("bucket").combine_chunks(), chunks.column("block").combine_chunks()]
    columns.append(pa.array([_packed(total[:, at[a:b]].ravel()) for a, b in zip(edges[:-1], edges[1:])]))
    return pa.table([*columns, pa.array(words)], names=["bucket", "block", "counts", "words"])


def _scorer(buckets: int, n_words: int, n_good: int, size: int, smoothing: float):
    """Scores of a block's texts; the counts of a model are scaled to the target's."""

    def log(asked: Asked, n: np.ndarray, ends: np.ndarray, everything: int) -> np.ndarray:
        scale = (n_good or 1.0) / max(everything, 1)
        own = (n[asked.word] * scale + 1.0) / (everything * scale + size)
        row = (n[asked.row] - ends[asked.row]) * scale
        return np.log((n[asked.pair] * scale + smoothing * own) / (row + smoothing))

    def run(blocks: pa.Table, sums: pa.Table) -> pa.Table:
        out = []
        pieces = list(zip(sums.column("bucket").to_pylist(), sums.column("counts").to_pylist()))
        for batch in blocks.to_batches():
            words, codes = batch.column("words").to_pylist(), batch.column("codes").to_pylist()
            for k, sizes in enumerate(_lists(batch, "sizes")):
                asked = Asked(words[k], codes[k], sizes, buckets)
                n = np.zeros((4, len(asked.keys)))
                for b, piece in pieces:
                    n[:, asked.edges[b] : asked.edges[b + 1]] = _unpacked(piece, np.uint64).reshape(4, -1)
                background = (n[0], n[1], n_words)
                text = np.repeat(np.arange(len(sizes)), sizes)
                columns = [batch.column("ids")[k].values, pa.array(sizes, pa.int64())]
                for model in ((n[2], n[3], n_good) if n_good else background, background):
                    logs = np.bincount(text, weights=log(asked, *model), minlength=len(sizes))
                    columns.append(pa.array(-logs / np.maximum(sizes, 1), mask=sizes == 0))
                out.append(pa.table(columns, names=["id", "n_words", "target", "background"]))
        return pa.concat_tables(out)

    return run


def score_documents(
    docs: DataFrame,
    labels: DataFrame,
    text: str = "text",
    key: str = "doc_id",
    quality: str = "quality",
    words: float = WORDS,
) -> DataFrame:
    """Per document: `key`, n_words, the mean negative log probability of its words under
    the target and background models, and their difference, the score."""
    spark = docs.sparkSession
    known = None if words == math.inf else spark.sparkContext.broadcast(vocabulary(docs, text, words))
    docs = docs.select(F.col(key).cast("long").alias("id"), F.col(text).alias("text"))
    good = labels.filter(F.col(quality) == 1).select(F.col(key).cast("long").alias("id"))
    good = good.filter(F.col("id").isNotNull()).distinct()
    docs = docs.withColumn("maybe", F.col("id").isNotNull() & may_be(bit_table(good, "id"), "id"))
    # Only texts that may be targets are shuffled, to meet their labels.
    targets = docs.filter("maybe").join(good.withColumn("good", F.lit(True)).hint("rebalance"), "id", "left")
    targets = targets.select("id", "text", F.coalesce("good", F.lit(False)).alias("good"))
    others = docs.filter("NOT maybe").select("id", "text", F.lit(False).alias("good"))
    blocks = targets.unionByName(others).mapInArrow(_blocks(known, BLOCK), BLOCKS)
    blocks = written(blocks, "blocks")
    totals = blocks.agg(F.count("*"), F.sum("n"), F.sum("n_good")).first()
    n_blocks, n_words, n_good = (int(x or 0) for x in totals)
    buckets = max(BUCKETS, 1 << (n_blocks - 1).bit_length())
    chunks = blocks.select("block", "words", "codes", "sizes", "good").mapInArrow(_chunks(buckets), CHUNKS)
    sums = written(chunks.groupBy("bucket").applyInArrow(_sums, SUMS), "sums")
    size = sums.agg(F.sum("words")).first()[0] or 0 if known is None else len(known.value)
    asking = blocks.select("block", "ids", "sizes", "words", "codes").groupBy("block")
    scorer = _scorer(buckets, n_words, n_good, size + 2, SMOOTHING)
    found = asking.cogroup(sums.select("bucket", "block", "counts").groupBy("block")).applyInArrow(scorer, SCORES)
    return found.select(
        F.col("id").alias(key),
        "n_words",
        F.col("target").alias("target_entropy"),
        F.col("background").alias("background_entropy"),
        (F.col("background") - F.col("target")).alias("score"),
    )
