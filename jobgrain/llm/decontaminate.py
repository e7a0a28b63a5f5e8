"""Benchmark decontamination by Wu-Manber multi-pattern search over words.

The patterns are the windows of 13 consecutive words of each test item; an item of
fewer words, but not none, is one window. Patterns of one length are searched
together: a shift table, addressed by the hash of a block of words, tells how far a
window can move without passing an occurrence; where it tells zero, the block is the
end of some patterns, found by its hash among the pattern ends, and each of those is
compared with the text, word by word and then byte by byte.

All texts of a group are scanned side by side (one window start per segment), so a
step of the scan is a few array operations. Documents are not shuffled. The compiled
patterns are sent to all tasks while the test texts hold at most BLOCK_BYTES; larger
test sets are split by hash into blocks under that size, and each block is one more
pass over the documents, with a written table in between.

Cases: a null or empty text has no words, no hits, and is clean. A test item with a
null id or no words is left out; equal ids count as one item; equal windows of several
items count for each. Repeated documents give a row each. Texts are scanned whole.
"""

from __future__ import annotations

from collections.abc import Iterator
from dataclasses import dataclass

import numpy as np
import pyarrow as pa
from pyspark.sql import Column, DataFrame
from pyspark.sql import functions as F

from jobgrain.llm import wordhash
from jobgrain.llm.shared import sent, tidied, written

WINDOW = 13
BLOCK_BYTES = 16 << 20  # test text compiled and sent at once
SEGMENT = 256  # window starts that one cursor of the scan passes
FOUND = "struct<n_words:bigint,items:array<bigint>,hits:array<struct<first:int,last:int>>>"


@dataclass
class Patterns:
    """Distinct windows of one length, ordered by the hash of their last block."""

    length: int
    block: int
    bits: int
    shift: np.ndarray  # by block hash
    ends: np.ndarray  # hash of the last block of each pattern
    words: np.ndarray  # word hashes, one row a pattern
    text: list[bytes]
    item_first: np.ndarray  # items of pattern k: item[item_first[k]:item_first[k + 1]]
    item: np.ndarray


def compile_patterns(items: list[tuple[int, str]], window: int = WINDOW) -> list[Patterns]:
    """Search tables for the windows of (id, text) items, by length."""
    found: dict[int, dict[bytes, tuple[np.ndarray, set[int]]]] = {}
    for item, text in items:
        data, offsets = wordhash.text_bytes(pa.array([text], pa.string()))
        words = wordhash.words_of(data, offsets)
        n = len(words.hash)
        if not n:
            continue
        all_words = wordhash.word_text(words, 0, n).split(b" ")
        length = min(window, n)
        of_length = found.setdefault(length, {})
        for k in range(n - length + 1):
            key = b" ".join(all_words[k : k + length])
            of_length.setdefault(key, (words.hash[k : k + length], set()))[1].add(item)
    return [_tables(length, of_length) for length, of_length in sorted(found.items())]


def _tables(length: int, windows: dict[bytes, tuple[np.ndarray, set[int]]]) -> Patterns:
    block = min(3, length)
    text = sorted(windows)
    words = np.stack([windows[t][0] for t in text])
    n, places = len(text), length - block + 1
    blocks = np.stack(
        [
            wordhash.blocks_hash(words[:, k : k + block].ravel(), block)[::block]
            for k in range(places)
        ],
        axis=1,
    )
    bits = int(np.clip(np.ceil(np.log2(16.0 * n * places)), 16, 24))
    shift = np.full(1 << bits, places, dtype=np.int16)
    slot = (blocks >> np.uint64(64 - bits)).astype(np.int64)
    for k in range(places):
        np.minimum.at(shift, slot[:, k], places - 1 - k)
    order = np.argsort(blocks[:, -1], kind="stable")
    owners = [sorted(windows[text[k]][1]) for k in order]
    return Patterns(
        length,
        block,
        bits,
        shift,
        blocks[order, -1],
        words[order],
        [text[k] for k in order],
        np.concatenate(([0], np.cumsum([len(o) for o in owners]))).astype(np.int64),
        np.array([i for o in owners for i in o], dtype=np.int64),
    )


def occurrences(words: wordhash.Words, patterns: Patterns) -> tuple[np.ndarray, np.ndarray]:
    """First word and pattern of every occurrence, in a group of texts."""
    m, b = patterns.length, patterns.block
    starts, ends = words.first[:-1], words.first[1:] - m + 1  # window starts of each text
    count = np.maximum(ends - starts, 0)
    pieces = -(-count // SEGMENT)
    cursor = np.repeat(starts, pieces) + SEGMENT * (
        np.arange(pieces.sum()) - np.repeat(np.cumsum(pieces) - pieces, pieces)
    )
    stop = np.minimum(cursor + SEGMENT, np.repeat(ends, pieces))
    hashes, far = words.hash, np.uint64(64 - patterns.bits)
    at, ends_hash = [], []
    base = np.uint64(wordhash._BASE)
    with np.errstate(over="ignore"):
        while len(cursor):
            value = np.zeros(len(cursor), dtype=np.uint64)
            for k in range(m - b, m):
                value = value * base + hashes[cursor + k]
            value = wordhash.mix(value)
            move = patterns.shift[(value >> far).astype(np.int64)].astype(np.int64)
            zero = move == 0
            if zero.any():
                at.append(cursor[zero])
                ends_hash.append(value[zero])
                move[zero] = 1
            cursor = cursor + move
            on = cursor < stop
            cursor, stop = cursor[on], stop[on]
    if not at:
        return np.empty(0, dtype=np.int64), np.empty(0, dtype=np.int64)
    at, value = np.concatenate(at), np.concatenate(ends_hash)
    low = np.searchsorted(patterns.ends, value, side="left")
    size = np.searchsorted(patterns.ends, value, side="right") - low
    first = np.repeat(at, size)
    pattern = np.repeat(low - (np.cumsum(size) - size), size) + np.arange(size.sum())
    for k in range(m):
        same = hashes[first + k] == patterns.words[pattern, k]
        first, pattern = first[same], pattern[same]
    same = [
        wordhash.word_text(words, f, f + m) == patterns.text[p]
        for f, p in zip(first.tolist(), pattern.tolist())
    ]
    same = np.array(same, dtype=bool)
    return first[same], pattern[same]


def _ranges(counts: np.ndarray) -> pa.Array:
    return pa.array(np.concatenate(([0], np.cumsum(counts))), pa.int32())


def _search_group(words: wordhash.Words, tables: list[Patterns]):
    """Words of each text, (text, item) found, and (text, first, last) spans of hit words."""
    n_texts, n = len(words.first) - 1, len(words.hash)
    edge = np.zeros(n + 1, dtype=np.int64)
    texts, items = [], []
    for patterns in tables:
        first, pattern = occurrences(words, patterns)
        np.add.at(edge, first, 1)
        np.add.at(edge, first + patterns.length, -1)
        size = patterns.item_first[pattern + 1] - patterns.item_first[pattern]
        place = np.repeat(patterns.item_first[pattern] - (np.cumsum(size) - size), size)
        items.append(patterns.item[place + np.arange(size.sum())])
        texts.append(np.repeat(words.text[first], size))
    pairs = np.unique(
        np.stack((np.concatenate(texts), np.concatenate(items)), axis=1), axis=0
    ) if texts else np.empty((0, 2), dtype=np.int64)
    hit = np.zeros(n + 2, dtype=bool)
    hit[1:-1] = np.cumsum(edge)[:n] > 0
    new = np.zeros(n + 1, dtype=bool)
    new[words.first] = True
    low = np.flatnonzero(hit[1:] & (~hit[:-1] | new))
    high = np.flatnonzero(hit[:-1] & (~hit[1:] | new))
    text = words.text[low] if len(low) else low
    begin = words.first[text] if len(low) else low
    return np.diff(words.first), pairs, (text, low - begin, high - begin), n_texts


def search(texts: pa.Array, tables: list[Patterns]) -> pa.Array:
    """Words, items and spans of hit words of each text."""
    parts = []
    for _, _, words in wordhash.groups_of(texts):
        n_words, pairs, (text, low, high), n = _search_group(words, tables)
        items = pa.ListArray.from_arrays(
            _ranges(np.bincount(pairs[:, 0], minlength=n)), pa.array(pairs[:, 1], pa.int64())
        )
        spans = pa.StructArray.from_arrays(
            [pa.array(low, pa.int32()), pa.array(high, pa.int32())], names=["first", "last"]
        )
        hits = pa.ListArray.from_arrays(_ranges(np.bincount(text, minlength=n)), spans)
        parts.append(
            pa.StructArray.from_arrays(
                [pa.array(n_words, pa.int64()), items, hits], names=["n_words", "items", "hits"]
            )
        )
    return pa.concat_arrays(parts) if parts else search(pa.array([""], pa.string()), tables)[:0]


def _searcher(tables):
    def run(batches: Iterator[pa.Array]) -> Iterator[pa.Array]:
        compiled = [Patterns(*fields) for fields in tables.value]
        for texts in batches:
            yield search(texts, compiled)

    return F.arrow_udf(tidied(run), FOUND).asNondeterministic()


def _blocks(tests: DataFrame, limit: int) -> Iterator[list[tuple[int, str]]]:
    """The test items, in blocks of at most `limit` bytes of text (or of one item)."""
    size = F.octet_length("text")
    total = tests.agg(F.sum(size)).first()[0] or 0
    n = 1
    if total > limit:
        n = 2 * -(-total // limit)
    tests = tests.withColumn("_block", F.pmod(F.xxhash64("item", "text"), F.lit(n)))
    while n > 1:
        worst = tests.groupBy("_block").agg(F.sum(size).alias("b"), F.count("*").alias("n"))
        if not worst.filter((F.col("b") > limit) & (F.col("n") > 1)).limit(1).count():
            break
        n *= 2
        tests = tests.withColumn("_block", F.pmod(F.xxhash64("item", "text"), F.lit(n)))
        if n > 64 * (total // limit + 1):  # a few huge items
            break
    for k in range(n):
        rows = tests.filter(F.col("_block") == k).select("item", "text").distinct().collect()
        if rows or n == 1:
            yield [(r.item, r.text) for r in rows]


def _joined(a: Column, b: Column) -> Column:
    """Union of two results on the same text."""
    return F.struct(
        a["n_words"].alias("n_words"),
        F.array_union(a["items"], b["items"]).alias("items"),
        F.array_union(a["hits"], b["hits"]).alias("hits"),
    )


def find_passages(
    docs: DataFrame,
    tests: DataFrame,
    text: str = "text",
    item: str = "item_id",
    item_text: str = "text",
    window: int = WINDOW,
    block_bytes: int = BLOCK_BYTES,
    into: str = "found",
) -> DataFrame:
    """Add a struct column `into` to the documents: n_words, the ids of items with an
    occurring window, and the spans of hit words (first, last exclusive). Spans of
    several blocks of the test set may overlap; `hit_words` counts each word once."""
    spark = docs.sparkSession
    tests = tests.select(
        F.col(item).cast("long").alias("item"), F.col(item_text).alias("text")
    ).filter(F.col("item").isNotNull() & F.col("text").isNotNull())
    for k, block in enumerate(_blocks(tests, block_bytes)):
        compiled = compile_patterns(block, window)
        tables = sent(spark, [tuple(vars(p).values()) for p in compiled])
        found = _searcher(tables)(F.col(text))
        if k == 0:
            docs = docs.withColumn(into, found)
        else:
            docs = written(docs, "decontaminate")
            docs = docs.withColumn("_more", found)
            docs = docs.withColumn(into, _joined(F.col(into), F.col("_more"))).drop("_more")
    return docs


def hit_words(found: Column) -> Column:
    """Number of words inside the spans, each counted once."""
    zero = F.struct(F.lit(0).alias("last"), F.lit(0).cast("long").alias("n"))
    return F.aggregate(
        F.array_sort(found["hits"]),
        zero,
        lambda a, s: F.struct(
            F.greatest(a["last"], s["last"]).alias("last"),
            (
                a["n"] + F.greatest(F.lit(0), s["last"] - F.greatest(a["last"], s["first"]))
            ).alias("n"),
        ),
        lambda a: a["n"],
    )


def contaminated(found: Column) -> Column:
    """At least a twentieth of the words are hit."""
    n = hit_words(found)
    return (n > 0) & (20 * n >= found["n_words"])
