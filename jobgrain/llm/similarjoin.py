"""N-gram Jaccard join by chosen paths.

A document is the set of its five-word shingles (all its words, if it has fewer than five).
Documents with equal sets are copies; the join runs over the distinct sets. A set is
sketched by the minima of SKETCH hash functions, one byte each; two sets agree in a place
about as often as their Jaccard similarity. The recursion starts with ROOTS runs: each
splits all sets by one full minimum, so sets that share the sampled shingle go on together.
A bucket of up to SMALL sets is compared by brute force on the sketches. A larger one is
first compared with one of its own sets, the pivot, to which close sets are tied and then
leave, as a group of near copies would not be split by any shingle; the others are split on
by one more sampled place (with a quarter's chance, by two), until all buckets are small.

A pair of similarity 0.8 stays together with chance 0.8 a level, so over ROOTS = 16 runs it
is missed with a chance of 1e-11 in a bucket that is small at once and 2e-4 after four
levels (RECALL holds the target, 0.999). Pairs found by sketch only tie candidates together.
Each group of tied candidates is then compared exactly, on its full sets, in pairs of blocks
of bounded size, and what is returned are the exact links: how many documents each one is
linked to, and the class, the documents connected by links, named by the smallest id.
Pairs are never written out; each block gives counts and a spanning forest.

A hot bucket or a hot group of copies is one row of a grouped count; joins against hot keys
have a rebalanced right side, so that adaptive execution can split the left one.

Cases: a null or empty text, or one without words, is linked to nothing and is its own
class. A null id takes part and counts; a class without any id has a null name. Repeated
rows are copies of each other.
"""

from __future__ import annotations

import hashlib
from collections.abc import Iterator

import numpy as np
import pyarrow as pa
from pyspark.sql import Column, DataFrame
from pyspark.sql import functions as F

from jobgrain.llm import wordhash
from jobgrain.llm.components import components
from jobgrain.llm.marks import bit_table, may_be
from jobgrain.llm.shared import tidied, written

WIDTH = 5  # words of a shingle
SIMILAR = 0.8
RECALL = 0.999
SKETCH = 128
ROOTS = 16
SMALL = 4096  # sets in a bucket that is compared at once
NEAR = 0.64  # sketch similarity of a candidate: 0.8 less 4.5 standard errors
TIED = 0.28  # of a set tied to a pivot: what a set within 0.8 of one that left must have
LEAVES = 0.80  # of a set that leaves a bucket with its pivot
BLOCK_SETS = 512  # of a block in the exact comparison
BLOCK_SHINGLES = 1 << 21
GROUP = 1 << 20  # bytes of text handled together

SKETCHED = "struct<set:binary,size:int,sketch:binary,paths:array<bigint>>"


def _factors(seed: int, n: int) -> np.ndarray:
    return wordhash.mix(np.arange(1, n + 1, dtype=np.uint64) + np.uint64(seed << 20)) | np.uint64(1)


def shingles_of(words: wordhash.Words, width: int) -> tuple[np.ndarray, np.ndarray]:
    """Shingle hashes of a group of texts, in order, and the first of each text."""
    count = np.diff(words.first)
    hashes = words.hash
    blocks = wordhash.blocks_hash(hashes, width)
    whole = count >= width
    number = np.where(whole, count - width + 1, np.minimum(count, 1))
    first = np.concatenate(([0], np.cumsum(number)))
    at = np.repeat(words.first[:-1] - first[:-1], number) + np.arange(first[-1])
    out = np.zeros(first[-1], dtype=np.uint64)
    long = np.repeat(whole, number)
    out[long] = blocks[at[long]]
    for text in np.flatnonzero(~whole & (count > 0)):
        low = words.first[text]
        n = int(count[text])
        out[first[text]] = wordhash.blocks_hash(hashes[low : low + n], n)[0] + np.uint64(n)
    return out, first


def _sketches(shingles: np.ndarray, first: np.ndarray, roots: int):
    """Byte sketches (texts with shingles x SKETCH) and full minima of the roots."""
    begin = first[:-1][np.diff(first) > 0]
    sketch = np.empty((len(begin), SKETCH), dtype=np.uint8)
    low = (shingles >> np.uint64(32)).astype(np.uint32)
    for k, factor in enumerate(_factors(1, SKETCH)):
        least = np.minimum.reduceat(low * np.uint32(factor >> np.uint64(33) << np.uint64(1) | np.uint64(1)), begin)
        sketch[:, k] = wordhash.mix(least.astype(np.uint64)) >> np.uint64(56)
    paths = np.empty((len(begin), roots), dtype=np.uint64)
    for k, factor in enumerate(_factors(2, roots)):
        least = np.minimum.reduceat(wordhash.mix(shingles * factor), begin)
        paths[:, k] = wordhash.mix(least + np.uint64(k))
    return sketch, paths


def _distinct(shingles: np.ndarray, first: np.ndarray) -> list[np.ndarray]:
    return [np.unique(shingles[a:b]) for a, b in zip(first[:-1].tolist(), first[1:].tolist())]


def _set_id(shingles: np.ndarray) -> bytes:
    return hashlib.md5(shingles.tobytes()).digest()


def _sketcher(width: int, roots: int):
    def run(batches: Iterator[pa.Array]) -> Iterator[pa.Array]:
        for texts in batches:
            ids, sizes, sketches, paths = [], [], [], []
            data, offsets = wordhash.text_bytes(texts)
            with np.errstate(over="ignore"):
                for low, high in wordhash.groups(offsets, GROUP):
                    part = offsets[low : high + 1]
                    words = wordhash.words_of(data[part[0] : part[-1]], part - part[0])
                    shingles, first = shingles_of(words, width)
                    if not len(shingles):
                        empty = [None] * (high - low)
                        ids += empty
                        sizes += [0] * (high - low)
                        sketches += empty
                        paths += empty
                        continue
                    sketch, roots_ = _sketches(shingles, first, roots)
                    roots_ = roots_.view(np.int64)
                    row = 0
                    for own in _distinct(shingles, first):
                        sizes.append(len(own))
                        if not len(own):
                            ids.append(None)
                            sketches.append(None)
                            paths.append(None)
                            continue
                        ids.append(_set_id(own))
                        sketches.append(sketch[row].tobytes())
                        paths.append(roots_[row])
                        row += 1
            yield pa.StructArray.from_arrays(
                [
                    pa.array(ids, pa.binary()),
                    pa.array(sizes, pa.int32()),
                    pa.array(sketches, pa.binary()),
                    pa.array(paths, pa.list_(pa.int64())),
                ],
                names=["set", "size", "sketch", "paths"],
            )

    return F.arrow_udf(tidied(run), SKETCHED).asNondeterministic()


def _shingler(width: int):
    def run(batches: Iterator[pa.Array]) -> Iterator[pa.Array]:
        for texts in batches:
            sets: list[np.ndarray] = []
            data, offsets = wordhash.text_bytes(texts)
            for low, high in wordhash.groups(offsets, GROUP):
                part = offsets[low : high + 1]
                words = wordhash.words_of(data[part[0] : part[-1]], part - part[0])
                sets += _distinct(*shingles_of(words, width))
            ends = np.concatenate(([0], np.cumsum([len(s) for s in sets])))
            flat = np.concatenate(sets) if sets else np.empty(0, dtype=np.uint64)
            yield pa.ListArray.from_arrays(
                pa.array(ends, pa.int32()), pa.array(flat.view(np.int64), pa.int64())
            )

    return F.arrow_udf(tidied(run), "array<bigint>").asNondeterministic()


# --- buckets -----------------------------------------------------------------------------------


def _matrix(values: pa.Array) -> np.ndarray:
    return np.array([np.frombuffer(v, dtype=np.uint8) for v in values.to_pylist()])


def _agree(similarity: float) -> float:
    """Places of a sketch that agree at a similarity; a byte agrees by chance in 1 of 256."""
    return SKETCH * (similarity + (1 - similarity) / 256)


def _forest(linked: np.ndarray) -> np.ndarray:
    """Smallest member reachable from each member of a group, from its link matrix."""
    n = len(linked)
    name = np.arange(n)
    while True:
        following = name.copy()
        for k in range(0, n, 128):  # a few rows at a time: numbers take eight times the links
            near = np.where(linked[k : k + 128], name[None, :], n).min(axis=1)
            following[k : k + 128] = np.minimum(following[k : k + 128], near)
        following = following[following]
        if (following == name).all():
            return name
        name = following


def _runs(batches: Iterator[pa.RecordBatch], keys: list[str]) -> Iterator[pa.Table]:
    """Rows of equal keys, put together from batches that are sorted by the keys."""
    held: list[pa.RecordBatch] = []
    for batch in batches:
        if not batch.num_rows:
            continue
        codes = np.zeros(batch.num_rows, dtype=bool)
        for key in keys:
            column = batch.column(key).to_pylist()
            codes[1:] |= np.array([a != b for a, b in zip(column, column[1:])], dtype=bool)
        if held:
            codes[0] = any(held[0].column(k)[0].as_py() != batch.column(k)[0].as_py() for k in keys)
        cuts = np.flatnonzero(codes).tolist()
        low = 0
        for cut in cuts:
            if cut > low:
                held.append(batch.slice(low, cut - low))
            if held:
                yield pa.Table.from_batches(held)
            held, low = [], cut
        held.append(batch.slice(low))
    if held:
        yield pa.Table.from_batches(held)


def _bucket_ties(batches: Iterator[pa.RecordBatch]) -> Iterator[pa.RecordBatch]:
    """A spanning forest of the close pairs of each bucket."""
    least = _agree(NEAR)
    a: list[bytes] = []
    b: list[bytes] = []

    def out():
        batch = pa.RecordBatch.from_arrays(
            [pa.array(a, pa.binary()), pa.array(b, pa.binary())], names=["a", "b"]
        )
        a.clear()
        b.clear()
        return batch

    for bucket in _runs(batches, ["path"]):
        sketch = _matrix(bucket.column("sketch"))
        n = len(sketch)
        if n < 2:
            continue
        linked = np.empty((n, n), dtype=bool)
        for k in range(0, n, 64):
            linked[k : k + 64] = (sketch[k : k + 64, None, :] == sketch[None, :, :]).sum(axis=2) >= least
        name = _forest(linked)
        tied = np.flatnonzero(name != np.arange(n)).tolist()
        if tied:
            sets = bucket.column("set").to_pylist()
            a += [sets[k] for k in tied]
            b += [sets[name[k]] for k in tied]
        if len(a) > 10_000:
            yield out()
    yield out()


def _pivot_step(path: Column, sketch: Column, pivot: Column) -> Column:
    """How many places agree with the pivot, and the paths of the next level."""

    def run(batches):
        for paths, sketches, pivots in batches:
            own = _matrix(sketches).reshape(len(paths), SKETCH)
            agree = (own == _matrix(pivots).reshape(len(paths), SKETCH)).sum(axis=1)
            with np.errstate(over="ignore"):
                at = paths.to_numpy().view(np.uint64)
                draw = wordhash.mix(at + np.uint64(0x5851F42D))
                following = []
                for turn in (0, 1):
                    place = (wordhash.mix(draw + np.uint64(turn)) % np.uint64(SKETCH)).astype(np.int64)
                    value = own[np.arange(len(own)), place].astype(np.uint64)
                    following.append(wordhash.mix(at * np.uint64(31) + value * np.uint64(2) + np.uint64(turn)))
                second = draw % np.uint64(4) == 0
            lists = [
                [int(x), int(y)] if two else [int(x)]
                for x, y, two in zip(following[0].view(np.int64), following[1].view(np.int64), second)
            ]
            yield pa.StructArray.from_arrays(
                [pa.array(agree, pa.int32()), pa.array(lists, pa.list_(pa.int64()))],
                names=["agree", "paths"],
            )

    kind = "struct<agree:int,paths:array<bigint>>"
    return _typed(run, kind)(path, sketch, pivot)


def _typed(run, kind):
    def typed(batches: Iterator[tuple[pa.Array, pa.Array, pa.Array]]) -> Iterator[pa.Array]:
        return run(batches)

    return F.arrow_udf(typed, kind).asNondeterministic()


def _sized(members: DataFrame) -> DataFrame:
    """Members of buckets with two or more, and how many those have."""
    counts = members.groupBy("path").agg(F.count("*").alias("many")).filter("many > 1")
    return members.join(counts.hint("rebalance"), "path")


def candidate_ties(sets: DataFrame) -> DataFrame:
    """(a, b) ties whose components hold all pairs found similar by sketch, from distinct
    (set, sketch, paths)."""
    members = _sized(sets.select("set", F.explode("paths").alias("path")))
    members = written(members.join(sets.select("set", "sketch"), "set"), "buckets")
    found = []
    while True:
        ties = (
            members.filter(F.col("many") <= SMALL)
            .select("path", "set", "sketch")
            .repartition("path")
            .sortWithinPartitions("path", "set")
            .mapInArrow(tidied(_bucket_ties), "a binary, b binary")
        )
        found.append(written(ties.distinct(), "ties"))
        large = members.filter(F.col("many") > SMALL).select("path", "set", "sketch")
        if not large.limit(1).count():
            break
        pivots = large.groupBy("path").agg(
            F.min("set").alias("pivot"), F.min_by("sketch", "set").alias("pivot_sketch")
        )
        step = large.join(pivots.hint("rebalance"), "path").withColumn(
            "step", _pivot_step(F.col("path"), F.col("sketch"), F.col("pivot_sketch"))
        )
        step = written(step.select("set", "sketch", "pivot", "step.agree", "step.paths"), "pivots")
        tied = step.filter((F.col("agree") >= _agree(TIED)) & (F.col("set") != F.col("pivot")))
        found.append(tied.select(F.col("set").alias("a"), F.col("pivot").alias("b")).distinct())
        rest = step.filter((F.col("agree") < _agree(LEAVES)) & (F.col("set") != F.col("pivot")))
        members = _sized(rest.select("set", "sketch", F.explode("paths").alias("path")))
        members = written(members, "buckets")
    ties = found[0]
    for more in found[1:]:
        ties = ties.union(more)
    return ties


# --- exact comparison -----------------------------------------------------------------------------


def shared_counts(sets: list[np.ndarray]) -> np.ndarray:
    """Number of shared elements of every two sets (sorted arrays)."""
    n = len(sets)
    out = np.zeros((n, n), dtype=np.int64)
    token = np.concatenate(sets)
    owner = np.repeat(np.arange(n), [len(s) for s in sets])
    order = np.argsort(token, kind="stable")
    token, owner = token[order], owner[order]
    first = np.flatnonzero(np.concatenate(([True], token[1:] != token[:-1])))
    size = np.diff(np.concatenate((first, [len(token)])))
    flat = out.ravel()
    for many in range(2, min(8, n) + 1):
        rows = first[size == many]
        if not len(rows):
            continue
        owners = owner[rows[:, None] + np.arange(many)]
        for i in range(many):
            for j in range(i + 1, many):
                flat += np.bincount(owners[:, i] * n + owners[:, j], minlength=n * n) if n <= 64 else 0
                if n > 64:
                    np.add.at(flat, owners[:, i] * n + owners[:, j], 1)
    common = np.flatnonzero(size > 8)
    for low in range(0, len(common), 2048):
        rows = common[low : low + 2048]
        has = np.zeros((len(rows), n), dtype=np.float32)
        at = np.repeat(first[rows] - np.cumsum(size[rows]) + size[rows], size[rows]) + np.arange(size[rows].sum())
        has[np.repeat(np.arange(len(rows)), size[rows]), owner[at]] = 1
        out += np.triu((has.T @ has).astype(np.int64), 1)
    return out + out.T


def _block_links(similar: float):
    def run(batches: Iterator[pa.RecordBatch]) -> Iterator[pa.RecordBatch]:
        """Links of each set in a pair of blocks, and a spanning forest."""
        for group in _runs(batches, ["component", "low", "high"]):
            lists = group.column("shingles").combine_chunks()
            offsets, values = lists.offsets.to_numpy(), lists.values.to_numpy()
            sets = [values[x:y] for x, y in zip(offsets[:-1], offsets[1:])]
            n = len(sets)
            if n < 2:
                continue
            size = np.array([len(s) for s in sets])
            block = group.column("block").to_numpy()
            copies = group.column("copies").to_numpy()
            shared = shared_counts([s.view(np.uint64) for s in sets])
            linked = shared * (1 + similar) >= similar * (size[:, None] + size[None, :]) - 1e-9
            np.fill_diagonal(linked, False)
            if group.column("low")[0].as_py() != group.column("high")[0].as_py():
                linked &= block[:, None] != block[None, :]  # the others are another pair's
            name = _forest(linked)
            ids = group.column("set").to_pylist()
            yield pa.RecordBatch.from_arrays(
                [
                    pa.array(ids, pa.binary()),
                    pa.array((linked * copies[None, :]).sum(axis=1), pa.int64()),
                    pa.array([ids[k] for k in name], pa.binary()),
                    pa.array([group.column("blocks")[0].as_py()] * n, pa.int32()),
                ],
                names=["set", "links", "name", "parts"],
            )

    return run


def exact_links(members: DataFrame, similar: float) -> DataFrame:
    """(set, links, name, parts): for candidate members (component, set, size, copies,
    shingles), how many documents of other sets each set is linked to in a pair of blocks,
    a set that it is connected to there, and the number of blocks of its group."""
    blocks = F.greatest(
        F.ceil(F.count("*") / F.lit(BLOCK_SETS)), F.ceil(F.sum("size") / F.lit(BLOCK_SHINGLES))
    )
    parts = members.groupBy("component").agg(blocks.cast("int").alias("blocks"))
    members = members.join(parts.hint("rebalance"), "component")
    members = members.withColumn("block", F.pmod(F.xxhash64("set"), F.col("blocks")).cast("int"))
    pairs = members.withColumn("other", F.explode(F.sequence(F.lit(0), F.col("blocks") - 1)))
    pairs = pairs.select(
        "component",
        F.least("block", "other").alias("low"),
        F.greatest("block", "other").alias("high"),
        "block",
        "blocks",
        "set",
        "copies",
        "shingles",
    )
    keys = ["component", "low", "high"]
    return (
        pairs.repartition(*keys)
        .sortWithinPartitions(*keys, "set")
        .mapInArrow(tidied(_block_links(similar)), "set binary, links bigint, name binary, parts int")
    )


def similar_documents(
    docs: DataFrame,
    text: str = "text",
    key: str = "doc_id",
    width: int = WIDTH,
    similar: float = SIMILAR,
    roots: int = ROOTS,
) -> DataFrame:
    """Per document: `key`, digest (of its text), class_id, n_links (other documents with
    similarity of at least `similar`, copies included), n_copies (documents with its set,
    itself included) and keeps (true for one text of each class: that of the smallest id)."""
    rows = docs.select(
        F.col(key).alias("id"),
        F.xxhash64(text).alias("digest"),
        _sketcher(width, roots)(F.col(text)).alias("found"),
    )
    rows = written(rows.select("id", "digest", "found.*"), "sketches")
    first = F.min(F.struct(F.col("id").isNull(), "id", "digest")).alias("first")
    one = [F.first(c).alias(c) for c in ("size", "sketch", "paths")]  # equal for equal sets
    sets = rows.filter("set IS NOT NULL").groupBy("set").agg(F.count("*").alias("copies"), first, *one)
    sets = written(sets, "sets")
    classes = sets.select("set", "copies", "size", "first")
    candidates = written(components(candidate_ties(sets)), "candidates")
    members = candidates.select(F.col("node").alias("set"), "component").join(classes, "set")
    members = written(members, "members")
    member = members.select("component", "set", "size", "copies", "first.id", "first.digest")
    bodies = docs.select(
        F.col(key).alias("own"), F.xxhash64(text).alias("own_digest"), F.col(text).alias("body")
    )
    bodies = bodies.filter(may_be(bit_table(member, "id", "digest"), "own", "own_digest"))
    texts = member.join(
        bodies, (F.col("digest") == F.col("own_digest")) & F.col("id").eqNullSafe(F.col("own"))
    ).select("component", "set", "size", "copies", _shingler(width)(F.col("body")).alias("shingles"))
    # The same row may be there several times.
    texts = texts.groupBy("component", "set").agg(
        *[F.first(c).alias(c) for c in ("size", "copies", "shingles")]
    )
    links = written(exact_links(written(texts, "shingles"), similar), "links")
    counts = links.groupBy("set").agg(F.sum("links").alias("links"), F.min("name").alias("name"))
    known = classes.join(counts, "set", "left").select(
        "set", "copies", "links", "first", F.coalesce("name", "set").alias("component")
    )
    if links.filter("parts > 1").limit(1).count():
        # Groups of several blocks: each pair of blocks has named a part.
        names = components(links.filter("parts > 1").select(F.col("set").alias("a"), F.col("name").alias("b")))
        names = names.select(F.col("node").alias("set"), F.col("component").alias("whole"))
        known = known.join(names, "set", "left").select(
            "set", "copies", "links", "first", F.coalesce("whole", "component").alias("component")
        )
    known = written(known, "known")
    smallest = known.groupBy("component").agg(F.min("first").alias("smallest"))
    known = written(known.join(smallest.hint("rebalance"), "component"), "classes")
    known = known.select("set", "copies", "links", "smallest")
    return rows.select("id", "digest", "set").join(known, "set", "left").select(
        F.col("id").alias(key),
        "digest",
        F.when(F.col("set").isNull(), F.col("id")).otherwise(F.col("smallest.id")).alias("class_id"),
        (F.coalesce("links", F.lit(0)) + F.coalesce("copies", F.lit(1)) - 1).alias("n_links"),
        F.coalesce("copies", F.lit(1)).alias("n_copies"),
        F.when(F.col("set").isNull(), F.lit(True))
        .otherwise(
            (F.col("smallest.digest") == F.col("digest")) & F.col("smallest.id").eqNullSafe(F.col("id"))
        )
        .alias("keeps"),
    )
