"""Alignment of two tokenizers' tokens over the same texts.

Tokenizer A is a byte-level BPE, B a sentence-piece BPE with byte fallback; both encode a
blank and the text. Byte offsets where a token of A and one of B end together cut both into
groups, and such a pair of tokens is a link.

The ends of A's and of B's tokens of a group of texts are two rising lists whose merging is
cut by merge paths: for equally spaced diagonals a binary search, all at once, tells how many
of the first d ends in merged order are A's (A first where both are equal). The pieces
between are of equal work and need nothing of each other; each emits its ends that coincide.
Only an A end that is the last of one piece may meet the B end that is the first of the next,
so pieces are stitched there, and the groups are what lies between links.

Two tokens that end together are such that one's bytes end the other's. So the pairs that can
ever be linked are known from the vocabularies alone (`Pairs`, some hundreds of thousands,
none of them depending on the texts): counting links is a bin count, and the counts of all
pairs are a broadcast of that size. The first pass encodes and writes per document its
groups' digest and the numbers of its linked pairs; the counts are summed; the second pass
looks them up. Nothing else is shuffled.

Encoding: a token of A never goes from a character that is not white space to the blank after
it, nor does one of B if no piece has a blank after another character, which is looked up in
the model (together with its normalizer being the identity; else texts are encoded whole). So
texts are cut there and each distinct stretch is encoded once in a while. That the stretches
are equal and that the tokens' bytes give the text again is compared byte by byte.

The vocabulary files are parameters; the driver reads them and their contents travel.

Cases: texts that are null, empty, or whose tokens' bytes differ from the text (a text with
U+2581) have no tokens: zeros and ''. Repeated rows count each time. A very long text is
encoded by stretches and aligned by pieces, but a text is one task's work.
"""

from __future__ import annotations

import hashlib
import json
from collections.abc import Iterator
from itertools import chain

import numpy as np
import pyarrow as pa
from pyspark.sql import DataFrame
from pyspark.sql import functions as F

from jobgrain.llm import wordhash
from jobgrain.llm.shared import sent, tidied, written

BYTE_BPE = "/opt/tokenizers/byte_bpe_50k.json"
PIECE_BPE = "/opt/tokenizers/piece_bpe_32k.model"
GROUP = 1 << 19  # bytes of text handled together
WORK = 1 << 16  # ends in a piece of the merging
STRETCHES = 60_000  # distinct stretches whose tokens a task remembers
ALIGNED = (
    "struct<n_a:bigint,n_b:bigint,n_groups:bigint,n_links:bigint,groups:string,"
    "groups_sha256:string,pairs:array<int>>"
)

# The pattern by which the byte-level tokenizer splits texts.
PATTERN = r"'s|'t|'re|'ve|'m|'ll|'d| ?\p{L}+| ?\p{N}+| ?[^\s\p{L}\p{N}]+|\s+(?!\S)|\s+"


# --- vocabularies ----------------------------------------------------------------------------


def _byte_of_character() -> dict[str, int]:
    """Byte-level pieces show printable bytes as themselves and the others, in order, as the
    characters from U+0100 on."""
    shown = [*range(0x21, 0x7F), *range(0xA1, 0xAD), *range(0xAE, 0x100)]
    hidden = [b for b in range(256) if b not in shown]
    return {chr(b): b for b in shown} | {chr(256 + k): b for k, b in enumerate(hidden)}


def read_byte_bpe(path: str = BYTE_BPE) -> dict[bytes, int]:
    """Pieces and ids, which follow the order of merges, without special tokens."""
    with open(path, encoding="utf-8") as file:
        model = json.load(file)
    special = {t["content"] for t in model.get("added_tokens", [])}
    byte = _byte_of_character()
    vocabulary = model["model"]["vocab"].items()
    return {bytes(byte[c] for c in piece): i for piece, i in vocabulary if piece not in special}


def piece_bytes(piece: str, is_byte: bool) -> bytes:
    return bytes([int(piece[1:-1], 16)]) if is_byte else piece.replace("▁", " ").encode()


class Pairs:
    """Pairs of ids whose tokens can end together, in order, numbered from 0."""

    def __init__(self, a_pieces: list[bytes], b_pieces: list[bytes]):
        of_a, of_b = {}, {}
        for table, pieces in ((of_a, a_pieces), (of_b, b_pieces)):
            for number, piece in enumerate(pieces):
                if piece:
                    table.setdefault(piece, []).append(number)
        self.factor = len(b_pieces)
        codes = set()
        for piece, ids in of_a.items():
            for k in range(len(piece)):
                codes.update(a * self.factor + b for a in ids for b in of_b.get(piece[k:], ()))
        for piece, ids in of_b.items():
            for k in range(1, len(piece)):
                codes.update(a * self.factor + b for b in ids for a in of_a.get(piece[k:], ()))
        self.codes = np.array(sorted(codes), dtype=np.int64)


class Encoder:
    """Both tokenizers of a task, and the stretches that it remembers."""

    def __init__(self, a_vocabulary: dict[bytes, int], b_model: bytes):
        import sentencepiece
        import tiktoken

        self.a = tiktoken.Encoding("a", pat_str=PATTERN, mergeable_ranks=a_vocabulary, special_tokens={})
        self.b = sentencepiece.SentencePieceProcessor(model_proto=b_model)
        size = max(a_vocabulary.values()) + 1
        self.a_pieces = [b""] * size
        for piece, number in a_vocabulary.items():
            self.a_pieces[number] = piece
        pieces = [self.b.id_to_piece(k) for k in range(self.b.get_piece_size())]
        self.b_pieces = [
            b"" if self.b.is_control(k) or self.b.is_unknown(k) else piece_bytes(piece, self.b.is_byte(k))
            for k, piece in enumerate(pieces)
        ]
        self.separable = b"identity" in b_model and not any("▁" in p.lstrip("▁") for p in pieces)
        self.a_sizes = np.array([len(p) for p in self.a_pieces])
        self.b_sizes = np.array([len(p) for p in self.b_pieces])
        self.a_known, self.b_known, self.good, self.place = [], [], [], {}

    def stretches(self, pieces: list[bytes]) -> np.ndarray:
        """Places of the pieces, each of which begins with a blank, among those remembered."""
        new = list(dict.fromkeys(p for p in pieces if p not in self.place))
        if new:
            texts = [p.decode() for p in new]
            found = self.b.encode([t[1:] for t in texts], num_threads=1)
            for piece, text, b in zip(new, texts, found):
                a = self.a.encode_ordinary(text)
                self.place[piece] = len(self.good)
                self.a_known.append(a)
                self.b_known.append(b)
                self.good.append(
                    b"".join([self.a_pieces[k] for k in a]) == piece
                    and b"".join([self.b_pieces[k] for k in b]) == piece
                )
        return np.array([self.place[p] for p in pieces], dtype=np.int64)

    def encode(self, data: np.ndarray, offsets: np.ndarray):
        """Ids and, for each text, the first token, of A and of B, and whether its tokens'
        bytes are the text. Texts lie one after another and begin with a blank."""
        if len(self.place) > STRETCHES:
            self.a_known, self.b_known, self.good, self.place = [], [], [], {}
        n = len(offsets) - 1
        start = np.flatnonzero(_cuts(data, offsets)) if self.separable else offsets[:-1]
        end = np.concatenate((start[1:], [len(data)]))
        with np.errstate(over="ignore"):
            hashes = wordhash.spans_hash(data.astype(np.uint64) + np.uint64(1), start, end)
        _, first, which = np.unique(hashes, return_index=True, return_inverse=True)
        line = data.tobytes()
        place = self.stretches([line[s:e] for s, e in zip(start[first].tolist(), end[first].tolist())])
        # equal hashes are equal bytes, or the text goes as one stretch
        size = end - start
        at = np.repeat(start[first][which] - start, size) + np.arange(len(data))
        text = np.searchsorted(offsets, start, side="right") - 1
        unequal = np.unique(np.searchsorted(offsets, np.flatnonzero(data[at] != data), side="right") - 1)
        if len(unequal):
            keep = ~np.isin(text, unequal)
            own = self.stretches([line[offsets[k] : offsets[k + 1]] for k in unequal.tolist()])
            pieces = [line[s:e] for s, e in zip(start[keep].tolist(), end[keep].tolist())]
            text = np.concatenate((text[keep], unequal))
            order = np.argsort(text, kind="stable")
            place = np.concatenate((self.stretches(pieces), own))[order] if len(pieces) else own
            text, which = text[order], np.arange(len(order))
        good = np.ones(n, dtype=bool)
        flags = np.array([self.good[k] for k in place.tolist()], dtype=bool)
        good[text[~flags[which]]] = False
        out = []
        for known in (self.a_known, self.b_known):
            lists = [known[k] for k in place.tolist()]
            sizes = np.array([len(x) for x in lists], dtype=np.int64)
            flat = np.fromiter(chain.from_iterable(lists), dtype=np.int64, count=int(sizes.sum()))
            begins = np.cumsum(sizes) - sizes
            sizes, begins = sizes[which], begins[which]
            ends = np.cumsum(sizes)
            ids = flat[np.repeat(begins - (ends - sizes), sizes) + np.arange(ends[-1] if len(ends) else 0)]
            firsts = np.concatenate(([0], np.cumsum(np.bincount(text, weights=sizes, minlength=n)))).astype(np.int64)
            out += [ids, firsts]
        return *out, good


def _cuts(data: np.ndarray, offsets: np.ndarray) -> np.ndarray:
    """Where texts begin, and blanks after a character that certainly is not white space."""
    cut = np.zeros(len(data), dtype=bool)
    seen = np.ones(len(data), dtype=bool)
    seen[data <= 0x20] = False
    # white space beyond ASCII begins with these bytes, as do many other signs
    for first, second, size in ((0xC2, None, 2), (0xE1, None, 3), (0xE2, None, 3), (0xE3, 0x80, 3)):
        at = np.flatnonzero(data == first)
        at = at[at + size <= len(data)]
        if second is not None:
            at = at[data[at + 1] == second]
        seen[at + size - 1] = False
    cut[1:] = (data[1:] == 0x20) & seen[:-1]
    cut[offsets[1:] - 1] = False  # a blank alone would be an empty text to B
    cut[offsets[:-1]] = True
    return cut


# --- merging ---------------------------------------------------------------------------------


def merge_path(a: np.ndarray, b: np.ndarray, diagonals: np.ndarray) -> np.ndarray:
    """How many of the first d elements of the merged lists are a's, for each d."""
    low, high = np.maximum(0, diagonals - len(b)), np.minimum(diagonals, len(a))
    while True:
        open_ = low < high
        if not open_.any():
            return low
        mid = (low + high) // 2
        goes = np.zeros(len(mid), dtype=bool)
        goes[open_] = a[mid[open_]] <= b[diagonals[open_] - 1 - mid[open_]]
        low, high = np.where(open_ & goes, mid + 1, low), np.where(open_ & ~goes, mid, high)


def links(a: np.ndarray, b: np.ndarray, work: int = WORK) -> tuple[np.ndarray, np.ndarray]:
    """Places of the equal elements of two rising lists, by pieces of equal work."""
    total = len(a) + len(b)
    diagonals = np.append(np.arange(0, total, work), total)
    of_a = merge_path(a, b, diagonals)
    of_b = diagonals - of_a
    found_a, found_b = [], []
    for p in range(len(diagonals) - 1):
        i, j = of_a[p], of_b[p]
        one, other = a[i : of_a[p + 1]], b[j : of_b[p + 1]]
        if p and i and len(other) and a[i - 1] == other[0]:  # stitched to the piece before
            found_a.append(np.array([i - 1]))
            found_b.append(np.array([j]))
        if len(one) and len(other):
            place = np.searchsorted(one, other)
            place[place == len(one)] = 0
            same = np.flatnonzero(one[place] == other)
            found_a.append(i + place[same])
            found_b.append(j + same)
    if not found_a:
        return np.empty(0, dtype=np.int64), np.empty(0, dtype=np.int64)
    return np.concatenate(found_a), np.concatenate(found_b)


class Writer:
    """Groups as text: `a1,a2|b1;a3|b2,b3`."""

    def __init__(self, most: int):
        width = len(str(most)) + 1
        self.most = most + 1
        lines = [str(k) + sign for sign in ",|;" for k in range(self.most)]
        self.table = np.array([x.encode() for x in lines], dtype=f"S{width}")

    def codes(self, a, b, link_a, link_b) -> np.ndarray:
        """Entries of the table for all tokens, in order of writing."""
        last_a, last_b = np.zeros(len(a), dtype=np.int64), np.zeros(len(b), dtype=np.int64)
        last_a[link_a], last_b[link_b] = 1, 2
        before_b = np.concatenate(([0], link_b + 1))  # of B's tokens, those of earlier groups
        group_a = np.cumsum(last_a) - last_a
        group_b = (np.cumsum(last_b) - last_b) // 2
        at_a = np.arange(len(a)) + before_b[group_a]
        at_b = np.arange(len(b)) + link_a[group_b] + 1
        codes = np.empty(len(a) + len(b), dtype=np.int64)
        codes[at_a] = a + last_a * self.most
        codes[at_b] = b + last_b * self.most
        return codes

    def text(self, codes: np.ndarray) -> bytes:
        return self.table[codes].tobytes().translate(None, b"\0")[:-1]


def _align(parts, with_groups: bool):
    def run(batches: Iterator[pa.Array]) -> Iterator[pa.Array]:
        a_vocabulary, b_model, codes = parts.value
        encoder = Encoder(a_vocabulary, b_model)
        writer = Writer(max(len(encoder.a_pieces), len(encoder.b_pieces)))
        for texts in batches:
            data, offsets = wordhash.text_bytes(texts)
            found = []
            for low, high in wordhash.groups(offsets, GROUP):
                part = offsets[low : high + 1]
                piece = data[part[0] : part[-1]]
                found.append(align_group(piece, part - part[0], encoder, codes, writer, with_groups))
            yield pa.concat_arrays(found)

    return run


def align_group(data, offsets, encoder: Encoder, codes, writer: Writer, with_groups: bool) -> pa.Array:
    """The results of texts that lie one after another."""
    n = len(offsets) - 1
    some = np.flatnonzero(np.diff(offsets) > 0)
    begins = offsets[some]
    data = np.insert(data, begins, 0x20)
    begins = np.append(begins + np.arange(len(some)), len(data))
    counts = np.zeros((4, n), dtype=np.int64)
    groups, digests = [""] * n, [""] * n
    pairs, pair_ends = np.empty(0, dtype=np.int32), np.zeros(n + 1, dtype=np.int32)
    if len(some):
        a, a_first, b, b_first, good = encoder.encode(data, begins)
        good = np.flatnonzero(good)
        n_a, n_b = np.diff(a_first)[good], np.diff(b_first)[good]
        a, b = a[_spans(a_first[good], n_a)], b[_spans(b_first[good], n_b)]
        a_end, b_end = np.cumsum(encoder.a_sizes[a]), np.cumsum(encoder.b_sizes[b])
        link_a, link_b = links(a_end, b_end)
        text_a = np.repeat(np.arange(len(good)), n_a)
        n_links = np.bincount(text_a[link_a], minlength=len(good))
        code = a[link_a] * len(encoder.b_pieces) + b[link_b]
        pairs = np.searchsorted(codes, code).astype(np.int32)
        kept = some[good]
        counts[:, kept] = n_a, n_b, n_links, n_links
        entries = writer.codes(a, b, link_a, link_b)
        ends = np.cumsum(n_a + n_b).tolist()
        low = 0
        for k, high in zip(kept.tolist(), ends):
            line = writer.text(entries[low:high])
            digests[k] = hashlib.sha256(line).hexdigest()
            if with_groups:
                groups[k] = line.decode()
            low = high
        pair_ends[1:] = np.cumsum(counts[3])
    return pa.StructArray.from_arrays(
        [
            *[pa.array(c) for c in counts],
            pa.array(groups if with_groups else [None] * n, pa.string()),
            pa.array(digests, pa.string()),
            pa.ListArray.from_arrays(pa.array(pair_ends), pa.array(pairs)),
        ],
        names=["n_a", "n_b", "n_groups", "n_links", "groups", "groups_sha256", "pairs"],
    )


def _spans(first: np.ndarray, size: np.ndarray) -> np.ndarray:
    ends = np.cumsum(size)
    return np.repeat(first - (ends - size), size) + np.arange(ends[-1] if len(ends) else 0)


# --- the job ---------------------------------------------------------------------------------


def _count_pairs(n: int):
    def run(batches: Iterator[pa.RecordBatch]) -> Iterator[pa.RecordBatch]:
        counts = np.zeros(n, dtype=np.int64)
        for batch in batches:
            counts += np.bincount(batch.column("pairs").flatten().to_numpy(), minlength=n)
        at = np.flatnonzero(counts)
        yield pa.RecordBatch.from_arrays(
            [pa.array(at.astype(np.int32)), pa.array(counts[at])], names=["pair", "n"]
        )

    return run


def best_of(codes: np.ndarray, counts: np.ndarray, factor: int) -> np.ndarray:
    """Whether a pair's count is the highest that its id of B has."""
    most = np.zeros(factor, dtype=np.int64)
    np.maximum.at(most, codes % factor, counts)
    return (counts > 0) & (counts == most[codes % factor])


def align_tokens(
    docs: DataFrame,
    text: str = "text",
    byte_bpe: str = BYTE_BPE,
    piece_bpe: str = PIECE_BPE,
    into: str = "aligned",
    with_groups: bool = False,
) -> DataFrame:
    """Add a struct column `into`: n_a, n_b, n_groups, n_links, n_best (links whose pair's
    count is the highest of its id of B), count_sum (of the counts over links),
    groups_sha256 and, if asked for, groups (`a1,a2|b1;a3|b2,b3`)."""
    if into in docs.columns:
        raise ValueError(f"the documents have a column {into!r}; name another with into=")
    context = docs.sparkSession.sparkContext
    a_vocabulary = read_byte_bpe(byte_bpe)
    with open(piece_bpe, "rb") as file:
        b_model = file.read()
    encoder = Encoder(a_vocabulary, b_model)
    possible = Pairs(encoder.a_pieces, encoder.b_pieces)
    parts = context.broadcast((a_vocabulary, b_model, possible.codes))
    aligned = F.arrow_udf(tidied(_align(parts, with_groups)), ALIGNED).asNondeterministic()
    row = F.struct(*[F.col(f"`{c}`") for c in docs.columns]).alias("row")
    found = written(docs.select(row, aligned(F.col(text)).alias("aligned")), "aligned")
    parts.destroy()
    n = len(possible.codes)
    counts = found.select("aligned.pairs")
    counts = counts.mapInArrow(_count_pairs(n), "pair int, n long").groupBy("pair").agg(F.sum("n").alias("n"))
    counts = counts.toArrow()  # at most a row for each possible pair
    total = np.zeros(n, dtype=np.int64)
    total[counts.column("pair").to_numpy()] = counts.column("n").to_numpy()
    shared = sent(docs.sparkSession, (total, best_of(possible.codes, total, possible.factor)))

    def look_up(batches: Iterator[pa.Array]) -> Iterator[pa.Array]:
        total, best = shared.value
        for lists in batches:
            number = lists.flatten().to_numpy()
            ends = np.concatenate(([0], np.cumsum(lists.value_lengths().to_numpy())))
            sums = [np.concatenate(([0], np.cumsum(x[number]))) for x in (total, best)]
            columns = [pa.array(s[ends[1:]] - s[ends[:-1]]) for s in reversed(sums)]
            yield pa.StructArray.from_arrays(columns, names=["n_best", "count_sum"])

    looked_up = F.arrow_udf(look_up, "struct<n_best:bigint,count_sum:bigint>").asNondeterministic()
    names = ["n_a", "n_b", "n_groups", "n_links", "n_best", "count_sum", "groups_sha256"]
    value = F.struct(
        *[F.col("sums" if c in ("n_best", "count_sum") else "aligned")[c].alias(c) for c in names],
        *([F.col("aligned.groups")] if with_groups else []),
    )
    found = found.withColumn("sums", looked_up("aligned.pairs"))
    return found.select("row.*", value.alias(into))
