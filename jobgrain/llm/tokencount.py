"""Token counts under a unigram vocabulary, by dynamic programming on a trie.

A text is cut into pre-tokens: an optional blank and then a run of letters (or bytes beyond
ASCII), of digits, or of other signs; further white space stands alone. A task takes its
texts in groups and puts the distinct pre-tokens of a group into a trie, level by level: a
node is a distinct beginning. A node's forward score is the best, over the vocabulary pieces
that end there, of the score of the node where the piece begins plus the piece's own; it is
computed once for all pre-tokens that share the beginning, and with it the number of pieces
on the best path. The number at the node where a pre-token ends is its count, and a text's
count is the sum over its pre-tokens. All nodes of a level are array operations.

The vocabulary is a public file (base64 piece and rank in each line; the path is a
parameter), read by the driver and sent to the tasks: its size does not depend on the data.
It has all single bytes, so each text can be cut. Scores follow the rank r: -log(r + 1), and
-log(number of pieces) for a single byte. Of equal scores the shorter last piece wins.

Nothing is shuffled. Cases: a null or empty text has no tokens; repeated rows get a row
each; texts are counted whole, and a long run is one pre-token.
"""

from __future__ import annotations

import base64
from collections.abc import Iterator

import numpy as np
import pyarrow as pa
from pyspark.sql import DataFrame
from pyspark.sql import functions as F

from jobgrain.llm import wordhash

VOCABULARY = "/opt/tokenizers/byte_bpe_50k.tiktoken"
GROUP = 1 << 20  # bytes of text handled together
COUNTED = "struct<n_pretokens:bigint,n_tokens:bigint,score:double>"

_LETTERS, _DIGITS, _SIGNS, _SPACE = 1, 2, 3, 4
_CLASS = np.full(256, _SIGNS, dtype=np.uint8)
_CLASS[[*range(0x41, 0x5B), *range(0x61, 0x7B), *range(0x80, 0x100)]] = _LETTERS
_CLASS[0x30:0x3A] = _DIGITS
_CLASS[[0x20, *range(0x09, 0x0E)]] = _SPACE


def read_vocabulary(path: str = VOCABULARY) -> dict[bytes, float]:
    """Pieces and their scores."""
    with open(path, "rb") as file:
        ranks = {base64.b64decode(piece): int(rank) for piece, rank in map(bytes.split, file)}
    rare = -float(np.log(len(ranks)))
    return {p: rare if len(p) == 1 else -float(np.log(r + 1)) for p, r in ranks.items()}


class Pieces:
    """The vocabulary as sorted hashes with scores."""

    def __init__(self, vocabulary: dict[bytes, float]):
        pieces = list(vocabulary)
        line = np.frombuffer(b"".join(pieces), dtype=np.uint8)
        sizes = np.array([len(p) for p in pieces])
        end = np.cumsum(sizes)
        with np.errstate(over="ignore"):
            hashes = wordhash.spans_hash(line.astype(np.uint64) + np.uint64(1), end - sizes, end)
        order = np.argsort(hashes)
        self.hashes = hashes[order]
        self.scores = np.array([vocabulary[p] for p in pieces])[order]
        self.lengths = sorted(set(sizes.tolist()))
        self.single = np.full(256, -np.inf)
        for piece, score in vocabulary.items():
            if len(piece) == 1:
                self.single[piece[0]] = score
        self.maybe = np.zeros(1 << 22, dtype=bool)
        self.maybe[(self.hashes >> np.uint64(42)).astype(np.int64)] = True

    def find(self, hashes: np.ndarray) -> tuple[np.ndarray, np.ndarray]:
        """Which hashes are pieces, and their scores."""
        at = np.flatnonzero(self.maybe[(hashes >> np.uint64(42)).astype(np.int64)])
        place = np.searchsorted(self.hashes, hashes[at])
        place[place == len(self.hashes)] = 0
        same = self.hashes[place] == hashes[at]
        return at[same], self.scores[place[same]]


def pretokens(data: np.ndarray, offsets: np.ndarray) -> tuple[np.ndarray, np.ndarray]:
    """First byte and end of each pre-token of texts that lie one after another."""
    n = len(data)
    if not n:
        return np.empty(0, dtype=np.int64), np.empty(0, dtype=np.int64)
    kind = _CLASS[data]
    cut = np.zeros(n + 1, dtype=bool)
    cut[1:n] = kind[1:] != kind[:-1]
    new = np.zeros(n + 1, dtype=bool)
    new[offsets] = True
    # a blank goes with what follows it
    joins = np.flatnonzero(cut[1:n] & ~new[1:n] & (data[:-1] == 0x20) & (kind[1:] != _SPACE)) + 1
    cut[joins] = False
    cut[joins - 1] = True
    cut |= new
    cut[0] = cut[n] = True
    at = np.flatnonzero(cut)
    return at[:-1], at[1:]


def count_pieces(data: np.ndarray, start: np.ndarray, end: np.ndarray, pieces: Pieces):
    """Number of pieces on the best path of each [start, end) in `data`, and its score.
    The spans should be distinct and are best given once each."""
    order = np.argsort(start - end, kind="stable")  # longest first
    start, size = start[order], (end - start)[order]
    up, down = wordhash._powers.to(len(data) + 1)
    sums = np.zeros(len(data) + 1, dtype=np.uint64)
    counts = np.zeros(len(start), dtype=np.int64)
    scores = np.zeros(len(start))
    with np.errstate(over="ignore"):
        np.cumsum((data.astype(np.uint64) + np.uint64(1)) * up[: len(data)], out=sums[1:])

        def hashed(first, length):
            value = (sums[first + length] - sums[first]) * down[first]
            return wordhash.mix(value + np.uint64(length))

        nodes = [np.zeros(len(start), dtype=np.int32)]  # by depth: each pre-token's node
        best = [np.zeros(1)]
        number = [np.zeros(1, dtype=np.int32)]
        for depth in range(1, int(size[0]) + 1 if len(size) else 1):
            live = int(np.searchsorted(-size, -depth, side="right"))
            beginnings = (sums[start[:live] + depth] - sums[start[:live]]) * down[start[:live]]
            _, first, node = np.unique(beginnings, return_index=True, return_inverse=True)
            at = start[first]  # one pre-token stands for each node
            before = nodes[depth - 1][first]
            value = best[depth - 1][before] + pieces.single[data[at + depth - 1]]
            steps = number[depth - 1][before] + 1
            for length in pieces.lengths:
                if length == 1:
                    continue
                if length > depth:
                    break
                hit, score = pieces.find(hashed(at + depth - length, length))
                if not len(hit):
                    continue
                before = nodes[depth - length][first[hit]]
                total = best[depth - length][before] + score
                better = total > value[hit]
                hit, before = hit[better], before[better]
                value[hit] = total[better]
                steps[hit] = number[depth - length][before] + 1
            nodes.append(node.astype(np.int32))
            best.append(value)
            number.append(steps)
            if depth > pieces.lengths[-1]:  # out of reach of any piece from here on
                nodes[depth - pieces.lengths[-1] - 1] = best[depth - pieces.lengths[-1] - 1] = None
                number[depth - pieces.lengths[-1] - 1] = None
            done = int(np.searchsorted(-size, -depth, side="left"))
            counts[done:live] = steps[node[done:live]]
            scores[done:live] = value[node[done:live]]
    out, out_scores = np.empty_like(counts), np.empty_like(scores)
    out[order], out_scores[order] = counts, scores
    return out, out_scores


def count_texts(texts: pa.Array, pieces: Pieces) -> pa.Array:
    data, offsets = wordhash.text_bytes(texts)
    n = len(offsets) - 1
    n_pre, n_tokens, score = np.zeros(n, np.int64), np.zeros(n, np.int64), np.zeros(n)
    for low, high in wordhash.groups(offsets, GROUP):
        part = offsets[low : high + 1]
        piece, part = data[part[0] : part[-1]], part - part[0]
        start, end = pretokens(piece, part)
        if not len(start):
            continue
        with np.errstate(over="ignore"):
            hashes = wordhash.spans_hash(piece.astype(np.uint64) + np.uint64(1), start, end)
        _, first, which = np.unique(hashes, return_index=True, return_inverse=True)
        counts, scores = count_pieces(piece, start[first], end[first], pieces)
        text = np.searchsorted(part, start, side="right") - 1
        n_pre[low:high] = np.bincount(text, minlength=high - low)
        n_tokens[low:high] = np.bincount(text, weights=counts[which], minlength=high - low)
        score[low:high] = np.bincount(text, weights=scores[which], minlength=high - low)
    return pa.StructArray.from_arrays(
        [pa.array(n_pre), pa.array(n_tokens), pa.array(score)],
        names=["n_pretokens", "n_tokens", "score"],
    )


def count_tokens(
    docs: DataFrame, text: str = "text", vocabulary: str = VOCABULARY, into: str = "counted"
) -> DataFrame:
    """Add a struct column `into`: n_pretokens, n_tokens and the score of the best cut."""
    shared = docs.sparkSession.sparkContext.broadcast(read_vocabulary(vocabulary))

    def run(batches: Iterator[pa.Array]) -> Iterator[pa.Array]:
        pieces = Pieces(shared.value)
        for texts in batches:
            yield count_texts(texts, pieces)

    return docs.withColumn(into, F.arrow_udf(run, COUNTED).asNondeterministic()(F.col(text)))
