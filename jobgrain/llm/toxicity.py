"""Toxicity by noisy-channel deobfuscation and a linear score of the restored text.

Words that may hide another word are decoded first: a token that mixes letters with
look-alike symbols or has gaps between them, a letter repeated three times or more, three or
more characters spelled out one by one with any gaps between, and two to PIECES pieces with
gaps between that joined would be, or begin like, a word that the classifier knows (others
cannot change a score). Each becomes a lattice of what its characters may stand for (a look-alike for some
letter or for nothing, a repeated letter for one or two, a gap for nothing or a blank), and
the Viterbi path under a character language model, of order four over the bytes of all
texts, is the restored text. All other words stand for themselves. A text is
scored by the words it has after restoring, and by how they begin, both with repeated
letters taken as one, and by whether it has them once, twice or LEVELS times and more: a
logistic model over the features that set toxic texts apart.

What is fitted, and on what: the character model on all texts, labelled or not, repeated
ones as often as they are there. The classifier on the labelled rows outside the held-out
fold, at most about TRAIN_ROWS of them (a fixed choice by digest), each text once: the
FEATURES features with the largest likelihood ratio among those in MIN_TEXTS texts or more,
and the weights. Only the sampled ids and the fitted tables are broadcast, bounded by these
parameters, and the counts of runs of four bytes, as two arrays (there are 37^4 runs of
ASCII letters, digits and the blank, and those of other scripts that the texts have). Every text is scored whole, in the tasks that
read it; nothing else is shuffled.

Cases: a null or empty text gets the score of a text without features. Rows without a
label, or with several (the largest counts), are fine; without any labelled row of both
classes every score is 0. Repeated rows get equal scores. A null id belongs to the fold of
the empty text.
"""

from __future__ import annotations

import math
import re
from collections.abc import Iterator
from functools import lru_cache

import numpy as np
import pyarrow as pa
from pyspark.sql import Column, DataFrame
from pyspark.sql import functions as F

from jobgrain.llm import wordhash
from jobgrain.llm.shared import sent, tidy, written

FOLDS = 5
TRAIN_ROWS = 30_000
FEATURES = 2_000
MIN_TEXTS = 5
BEGINNINGS = (4, 5, 6)  # bytes of a word's beginning that are features
PIECES = 4  # of a word that is split by gaps
LEVELS = 3  # a feature is had at least once, twice, three times
GROUP = 1 << 18  # bytes of text handled together, so few that their arrays stay in the cache

# Symbols and the letters they stand for.
LOOKALIKES = {
    "0": "o", "1": "il", "2": "z", "3": "e", "4": "a", "5": "s", "6": "gb", "7": "t", "8": "b",
    "9": "g", "@": "a", "$": "s", "!": "il", "|": "il", "+": "t", "(": "c", "{": "c",
}
_END = 0xFF
GAPS = " .-_*~,'/\\"
_TRIM = ".,;:?\"')]}>*#%&-_=~^/\\"

# --- the character model ---------------------------------------------------------------------


class CharModel:
    """Log probabilities of the next byte after up to three others, each order mixed with
    the one below in proportion to how many kinds of successors its context has."""

    def __init__(self, orders: list[tuple[np.ndarray, ...]] | tuple[np.ndarray, np.ndarray]):
        """From what `counted` gives, or from what it takes."""
        self.orders = self.counted(*orders) if isinstance(orders, tuple) else orders
        self.log = lru_cache(1 << 16)(self._log)

    @staticmethod
    def counted(codes: np.ndarray, n: np.ndarray) -> list[tuple[np.ndarray, ...]]:
        """What a model looks up, from sorted runs of four bytes as numbers and how often
        each is there. Plain arrays, made once and sent to the tasks."""
        orders = []
        for k in range(4):  # k bytes of context
            run, at = np.unique(codes & ((1 << 8 * (k + 1)) - 1), return_inverse=True)
            times = np.bincount(at, weights=n, minlength=len(run))
            context, at, kinds = np.unique(run >> 8, return_inverse=True, return_counts=True)
            total = np.bincount(at, weights=times, minlength=len(context))
            orders.append((run, times, context, total, kinds))
        return orders

    def logs(self, codes: np.ndarray, size: np.ndarray) -> np.ndarray:
        """Log probabilities of the last byte of each run after the `size` bytes (up to
        three) before it."""
        p = np.full(len(codes), 1 / 256)
        for k, (runs, times, contexts, totals, kinds) in enumerate(self.orders):
            if not len(runs):
                break
            run = codes & ((1 << 8 * (k + 1)) - 1)
            at = np.minimum(np.searchsorted(contexts, run >> 8), len(contexts) - 1)
            known = (contexts[at] == run >> 8) & (size >= k)
            place = np.minimum(np.searchsorted(runs, run), len(runs) - 1)
            n = np.where(runs[place] == run, times[place], 0)
            p = np.where(known, (n + kinds[at] * p) / (totals[at] + kinds[at]), p)
        return np.log(p)

    def _p(self, context: bytes, byte: bytes) -> float:
        lower = self._p(context[1:], byte) if context else 1 / 256
        run, times, contexts, totals, kinds = self.orders[len(context)]
        before = int.from_bytes(context, "big")
        at = contexts.searchsorted(before)
        if at == len(contexts) or contexts[at] != before:
            return lower
        code = before << 8 | byte[0]
        place = run.searchsorted(code)
        n = times[place] if place < len(run) and run[place] == code else 0
        return float((n + kinds[at] * lower) / (totals[at] + kinds[at]))

    def _log(self, context: bytes, byte: bytes) -> float:
        return math.log(self._p(context, byte))


def lattice(token: str) -> list[list[tuple[bytes, float]]]:
    """For each character, or run of a repeated letter, the bytes it may stand for, with
    log weights. A zero byte is a blank."""
    steps = []
    for match in re.finditer(r"([^\W\d_])\1*|.", token, re.S):
        run = match[0]
        if match[1]:
            one = match[1].encode()
            steps.append(
                [(one, 0.0)]
                if len(run) == 1
                else [(one, -0.7), (one + one, -0.7 if len(run) == 2 else -1.5)]
            )
        elif run in LOOKALIKES:
            steps.append([(c.encode(), -0.7) for c in LOOKALIKES[run]] + [(b"", -6.0)])
        elif run in GAPS:
            steps.append([(b"", -0.2), (b"\0", -2.5)])
        else:
            steps.append([(run.encode(), 0.0)] if run.isalnum() else [(b"", -1.0), (b"\0", -1.0)])
    return steps


def restore(token: str, model: CharModel, width: int = 64) -> bytes:
    """The best path through the token's lattice; words are parted by a zero byte.

    A state is the last three bytes, which is all that the model looks at, so with all
    states kept the path is the best one. There are more than `width` of them only where
    many characters in a row may stand for nothing or several letters; then the best
    `width` go on."""
    log = model.log
    states = {b"\0": (0.0, b"")}  # by the last bytes written: score, text
    for options in lattice(token):
        following: dict[bytes, tuple[float, bytes]] = {}
        if len(options) == 1 and len(options[0][0]) == 1:
            piece, weight = options[0]
            for context, (score, text) in states.items():
                total, last = score + weight + log(context, piece), (context + piece)[-3:]
                known = following.get(last)
                if known is None or total > known[0]:
                    following[last] = (total, text + piece)
            states = following
            continue
        for context, (score, text) in states.items():
            for piece, weight in options:
                total, last = score + weight, context
                for k in range(len(piece)):
                    byte = piece[k : k + 1]
                    total += log(last, byte)
                    last = (last + byte)[-3:]
                known = following.get(last)
                if known is None or total > known[0]:
                    following[last] = (total, text + piece)
        if len(following) > width:
            following = dict(sorted(following.items(), key=lambda s: -s[1][0])[:width])
        states = following
    return max(
        (score + model.log(context, b"\0"), text) for context, (score, text) in states.items()
    )[1]


# --- tokens that may hide a word -------------------------------------------------------------

_LETTER = np.zeros(256, dtype=bool)
_LETTER[[*range(0x41, 0x5B), *range(0x61, 0x7B), *range(0x80, 0x100)]] = True
_SYMBOL = np.zeros(256, dtype=bool)
_SYMBOL[[ord(c) for c in LOOKALIKES]] = True
_BLANK = np.zeros(256, dtype=bool)
_BLANK[[0x20, *range(0x09, 0x0E)]] = True
_HIDES = re.compile(r"[^\W\d_]")
_SAME = re.compile(r"([^\w\s])\1\1+$")
_SPLIT = re.compile(r"[^\W_][\s%s]+[^\W_]" % re.escape(GAPS))
_AGAIN = re.compile(r"(\w)\1\1")
_LOOKALIKE = frozenset(LOOKALIKES)
_TRIM_FIRST, _TRIM_LAST = np.zeros(256, dtype=bool), np.zeros(256, dtype=bool)
_TRIM_FIRST[[*map(ord, _TRIM + "(![{<")]] = _TRIM_LAST[[*map(ord, _TRIM + "!")]] = True
# bytes by themselves enough to look at a token's characters
_UNTOLD = _SYMBOL.copy()
_UNTOLD[[ord("_"), *range(0x20), *range(0x7F, 0x100)]] = True
_GAP = np.zeros(256, dtype=bool)
_GAP[[*map(ord, GAPS), *range(0x09, 0x0E)]] = True
_SIGN_GAP = np.zeros(256, dtype=bool)
_SIGN_GAP[[*map(ord, GAPS)]] = True


def _readings() -> list[np.ndarray]:
    """Byte to the letter it may stand for, 0 for none: the first choice of look-alikes, and
    the last one, with signs taken as such."""
    first, last = wordhash.WORD_BYTES.copy(), wordhash.WORD_BYTES.copy()
    for sign, letters in LOOKALIKES.items():
        first[ord(sign)] = ord(letters[0])
        if sign not in "!|+({":
            last[ord(sign)] = ord(letters[-1])
    return [first, last]


_READINGS = _readings()


def _runs(mask: np.ndarray, offsets: np.ndarray) -> tuple[np.ndarray, np.ndarray]:
    """First bytes and ends of the runs of bytes that the mask has, cut between texts."""
    inside = np.zeros(len(mask) + 2, dtype=bool)
    inside[1:-1] = mask
    new = np.zeros(len(mask) + 1, dtype=bool)
    new[offsets] = True
    start = np.flatnonzero(inside[1:] & (~inside[:-1] | new))
    return start, np.flatnonzero(inside[:-1] & (~inside[1:] | new))


def _linked(start: np.ndarray, breaks: np.ndarray, offsets: np.ndarray) -> np.ndarray:
    """Whether each run and the next one are of one text, without a break between them."""
    out = np.ones(max(len(start) - 1, 0), dtype=bool)
    after = np.searchsorted(start, np.concatenate((breaks, offsets)))
    out[after[(after > 0) & (after < len(start))] - 1] = False
    return out


def _spelled(data: np.ndarray, offsets: np.ndarray) -> list[tuple[int, int]]:
    """Spans of three or more single characters with nothing but gaps between."""
    unit = _LETTER[data] | _SYMBOL[data]
    start, end = _runs(unit, offsets)
    size = end - start
    alone = size == 1
    at = np.flatnonzero((size > 1) & (size <= 4))  # one character beyond ASCII
    at = at[data[start[at]] >= 0xC0]
    for k in (1, 2, 3):
        at = at[(size[at] <= k) | ((data[np.minimum(start[at] + k, len(data) - 1)] & 0xC0) == 0x80)]
    alone[at] = True
    at = np.flatnonzero(alone[:-1] & alone[1:])
    if len(at) < 2:
        return []
    joined = np.zeros(len(start) + 1, dtype=bool)
    joined[at + 1] = _linked(start, np.flatnonzero(~unit & ~_GAP[data]), offsets)[at]
    runs = np.flatnonzero(np.diff(joined.astype(np.int8)))
    return [
        (int(start[a]), int(end[b]))
        for a, b in zip(runs[::2].tolist(), runs[1::2].tolist())
        if b - a >= 2 and len(set(data[start[a : b + 1]].tolist())) > 1
    ]


# Bytes of characters that only stand for themselves, in lower case: ASCII letters and, after
# 0xC3, the lower-case letters from U+00DF on.
_PLAIN_SECOND = np.zeros(256, dtype=bool)
_PLAIN_SECOND[[*range(0x9F, 0xB7), *range(0xB8, 0xC0)]] = True


def _plain_bytes(data: np.ndarray) -> tuple[np.ndarray, np.ndarray]:
    """Which bytes are of letters that only stand for themselves, and which repeat the
    letter before them. Of those beyond ASCII a repeated one is left out: its bytes are not
    taken as one by the features."""
    low = wordhash.WORD_BYTES[data]
    plain = (low >= 0x61) & (low <= 0x7A)
    again = np.zeros(len(low), dtype=bool)
    again[1:] = (low[1:] == low[:-1]) & plain[1:]
    at = np.flatnonzero(data == 0xC3)
    at = at[at + 1 < len(data)]
    at = at[_PLAIN_SECOND[data[at + 1]]]
    plain[at] = plain[at + 1] = True
    back = at[at >= 2]
    back = back[(data[back - 2] == 0xC3) & (data[back - 1] == data[back + 1])]
    plain[back] = plain[back + 1] = False
    return plain, again


class _Plain:
    """Decides in arrays what the lattice of plain pieces comes to. Letters stand for
    themselves, a repeated one for one or two, which is the same to the features of a joined
    word. If the pieces between two gaps have three bytes or more, each gap is a matter of its
    own, nothing or a blank, and so it is with either choice for a repeated letter near it."""

    def __init__(self, data: np.ndarray, model: CharModel):
        self.model = model
        # four more bytes, so that what lies after a piece can be looked at
        self.low = np.concatenate((wordhash.WORD_BYTES[data], np.zeros(5, np.uint8))).astype(np.int64)
        plain, self.again = _plain_bytes(data)
        self.again = np.concatenate((self.again, np.zeros(5, dtype=bool)))
        self.plain = np.concatenate(([0], np.cumsum(plain)))
        self.repeats = np.concatenate(([0], np.cumsum(self.again)))
        self.blanks = np.concatenate(([0], np.cumsum(_BLANK[data])))
        # a gap sign costs 2.3 more as a blank than as nothing, other white space does not
        self.cheap = np.concatenate(([0], np.cumsum(_GAP[data] & ~_SIGN_GAP[data])))

    def weigh(self, start: np.ndarray, end: np.ndarray, pieces: np.ndarray) -> None:
        """Find for each gap after one of the pieces what joining gains."""
        self.least, self.most = np.full(len(start), np.nan), np.full(len(start), np.nan)
        after = pieces + 1
        found = self.joining(start[pieces], end[pieces], start[after], end[after])
        self.least[pieces], self.most[pieces] = found

    def decided(
        self, start: np.ndarray, end: np.ndarray, first: np.ndarray, more: int, counts: np.ndarray
    ) -> np.ndarray:
        """Of runs of 1 + `more` pieces whose gaps were weighed, from the pieces `first` on: 0 for those surely
        left apart, with repeated letters at most in pieces that do not count (have no
        chosen feature); 1 for those surely joined to one word; else -1."""
        fits, alike, long = np.ones(len(first), bool), np.ones(len(first), bool), np.zeros(len(first), bool)
        for k in range(more + 1):
            s, e = start[first + k], end[first + k]
            repeats = self.repeats[e] - self.repeats[np.minimum(s + 1, e)]
            fits &= self.plain[e] - self.plain[s] == e - s
            alike &= (repeats == 0) | ~counts[first + k]
            long |= e - s >= 3  # so it is not spelled out
            if 0 < k < more:
                fits &= e - s - repeats >= 3
            if k < more:
                fits &= self.blanks[start[first + k + 1]] > self.blanks[e]  # so it is no token by itself
        out = np.full(len(first), -1)
        at = np.flatnonzero(fits & long)
        least, most = np.full(len(at), np.inf), np.full(len(at), -np.inf)
        for k in range(more):
            one = first[at] + k
            least, most = np.minimum(least, self.least[one]), np.maximum(most, self.most[one])
        out[at[least > 1e-6]] = 1
        out[at[(most < -1e-6) & alike[at]]] = 0
        return out

    def joining(
        self, start: np.ndarray, gap: np.ndarray, after: np.ndarray, end: np.ndarray
    ) -> tuple[np.ndarray, np.ndarray]:
        """How much better plain pieces [start, gap) and [after, end), with gap bytes between,
        are when joined than with a blank: the least and the most over the choices for letters
        that are repeated in the three bytes on each side (minus and plus infinity where there
        are several). The paths differ in the gap and in the three bytes after it only, so the
        rest of the text need not be looked at."""
        n = len(gap)
        before = [(gap - k > start) & self.again[np.maximum(gap - k, 0)] for k in (1, 2, 3)]
        behind = [(after + k < end) & self.again[after + k] for k in (1, 2, 3)]
        several = before[0] & (before[1] | before[2]) | before[1] & before[2]
        several |= behind[0] & (behind[1] | behind[2]) | behind[1] & behind[2]
        least, most = np.full(n, np.inf), np.full(n, -np.inf)
        least[several], most[several] = -np.inf, np.inf
        every = np.ones(n, dtype=bool)
        # the last three bytes before the gap, and the first three after it
        lefts = [(every, (3, 2, 1)), (before[0], (4, 3, 2)), (before[1], (4, 3, 1))]
        rights = [(every, (0, 1, 2)), (behind[0], (0, 2, 3)), (behind[1], (0, 1, 3))]
        rows, left, right = [], [], []
        for has_left, places in lefts:
            for has_right, others in rights:
                rows.append(np.flatnonzero(has_left & has_right & ~several))
                left.append(np.tile(places, (len(rows[-1]), 1)))
                right.append(np.tile(others, (len(rows[-1]), 1)))
        of = np.concatenate(rows)
        left, right = np.concatenate(left).T, np.concatenate(right).T
        gains = self._gain(start[of], gap[of], after[of], end[of], left, right)
        ends = np.cumsum([len(r) for r in rows])
        for row, gain in zip(rows, np.split(gains, ends[:-1])):
            least[row] = np.minimum(least[row], gain)
            most[row] = np.maximum(most[row], gain)
        return least, most

    def _gain(self, start, gap, after, end, left, right) -> np.ndarray:
        """Gains where the rows of `left` and `right` have the places of the bytes before the
        gap and after it."""
        low, logs = self.low, self.model.logs
        before = np.zeros(len(gap), dtype=np.int64)
        for k in left:
            before = before << 8 | np.where(gap - k >= start, low[np.maximum(gap - k, 0)], 0)
        size = np.minimum(gap - start + 1 - (left[0] > 3), 3)
        joined, apart = before, before << 8
        joined_size, apart_size = size, np.minimum(size + 1, 3)
        gain = np.where(self.cheap[after] > self.cheap[gap], 0.0, 2.3) - logs(apart & 0xFFFFFFFF, size)
        for k in right:
            inside = after + k <= end  # the byte at the end is the blank after the word
            byte = np.where(after + k < end, low[after + k], 0)
            joined, apart = (joined << 8 | byte) & 0xFFFFFFFF, (apart << 8 | byte) & 0xFFFFFFFF
            gain += np.where(inside, logs(joined, joined_size) - logs(apart, apart_size), 0)
            joined_size, apart_size = np.minimum(joined_size + 1, 3), np.minimum(apart_size + 1, 3)
        return gain


class _Spans:
    """Hashes of many spans of one array, as `wordhash.spans_hash` gives them."""

    def __init__(self, values: np.ndarray):
        up, self.down = wordhash._powers.to(len(values) + 1)
        self.sums = np.zeros(len(values) + 1, dtype=np.uint64)
        np.cumsum(values * up[: len(values)], out=self.sums[1:])

    def hash(self, start: np.ndarray, end: np.ndarray) -> np.ndarray:
        size = (end - start).astype(np.uint64)
        return wordhash.mix((self.sums[end] - self.sums[start]) * self.down[start] + size)


def _split(
    data: np.ndarray, offsets: np.ndarray, lookup: Lookup, model: CharModel | None = None
) -> tuple[list[tuple[int, int]], np.ndarray]:
    """Spans of two to PIECES pieces with nothing but gaps between, which joined have a
    feature of the lookup that fewer of the pieces do not have. With a model, spans of plain
    pieces that are surely joined to one word come apart from the others, as an array, and
    those surely left as they are do not come."""
    spans, joined = set(), [np.empty((0, 2), dtype=np.int64)]
    plain = _Plain(data, model) if model else None
    signs = np.concatenate(([0], np.cumsum(_SYMBOL[data])))
    for number, reading in enumerate(_READINGS):
        values = reading[data]
        start, end = _runs(values != 0, offsets)
        if len(start) < 2:
            continue
        linked = _linked(start, np.flatnonzero((values == 0) & ~_GAP[data]), offsets)
        letters = np.cumsum(end - start)
        values = values[values != 0]
        keep = np.ones(len(values), dtype=bool)
        keep[1:] = values[1:] != values[:-1]
        moved = np.concatenate(([0], np.cumsum(keep)))
        # a first letter taken as one with the letter before it is that letter
        first, stop = moved[letters - (end - start) + 1] - 1, moved[letters]
        hashes = _Spans(values[keep])
        if number:
            signs_before, signs_after = signs[np.maximum(start - 1, 0)], signs[np.minimum(end + 1, len(data))]
        runs, found = np.arange(len(start)), []
        for more in range(1, PIECES):
            runs = runs[runs + more < len(start)]
            runs = at = runs[linked[runs + more - 1]]
            if number:  # without signs inside or beside it, a span reads as before
                at = at[signs_after[at + more] > signs_before[at]]
            low, high, before = first[at], stop[at + more], stop[at + more - 1]
            has = lookup.has(hashes.hash(low, high))
            for k in BEGINNINGS:
                part = np.flatnonzero((high - low > k) & (before - low <= k))
                has[part] |= lookup.has(hashes.hash(low[part], low[part] + k) + np.uint64(k))
            found.append(at[has])
        if plain:  # pieces of the spans found with a chosen feature of their own
            counts, before_gap = np.zeros(len(start), dtype=bool), np.zeros(len(start), dtype=bool)
            for more, some in enumerate(found, 1):
                for k in range(more + 1):
                    counts[some + k] = True
                    before_gap[some + min(k, more - 1)] = True
            plain.weigh(start, end, np.flatnonzero(before_gap))
            at = np.flatnonzero(counts)
            counts[at] = lookup.has(hashes.hash(first[at], stop[at]))
            for k in BEGINNINGS:
                part = at[stop[at] - first[at] > k]
                counts[part] |= lookup.has(hashes.hash(first[part], first[part] + k) + np.uint64(k))
        for more, some in enumerate(found, 1):
            if plain and len(some):
                what = plain.decided(start, end, some, more, counts)
                sure = some[what == 1]
                joined.append(np.stack((start[sure], end[sure + more]), axis=1))
                some = some[what == -1]
            spans.update(zip(start[some].tolist(), end[some + more].tolist()))
    return sorted(spans), np.unique(np.concatenate(joined), axis=0)


def _may_hide(data: np.ndarray, start: np.ndarray, end: np.ndarray, gapped: np.ndarray) -> np.ndarray:
    """Which tokens may have something to restore once they are trimmed: a symbol, a letter
    three times or a gap (that ends before one of `gapped`), or bytes not told apart here."""
    n = len(data)
    kept_first = np.concatenate((np.flatnonzero(~_TRIM_FIRST[data]), [n]))
    kept_last = np.concatenate(([-1], np.flatnonzero(~_TRIM_LAST[data])))
    start = kept_first[np.searchsorted(kept_first, start)]
    end = kept_last[np.searchsorted(kept_last, end) - 1] + 1
    low = wordhash.WORD_BYTES[data]
    told = _UNTOLD[data]
    told[2:] |= (low[2:] != 0) & (low[2:] == low[1:-1]) & (low[2:] == low[:-2])
    told[gapped] = True
    told = np.flatnonzero(told)
    return np.searchsorted(told, end) > np.searchsorted(told, start)


def hidden_tokens(
    words: wordhash.Words,
    offsets: np.ndarray,
    lookup: Lookup | None = None,
    model: CharModel | None = None,
) -> tuple[list[tuple[int, str]], np.ndarray]:
    """(number of the text, lower-cased token) for tokens that may hide a word; those split
    by blanks into longer pieces only where the lookup has them joined. With a model, spans
    that are surely one word come by themselves."""
    data = words.data
    n = len(data)
    joined = np.empty((0, 2), dtype=np.int64)
    if not n:
        return [], joined
    letter, symbol = _LETTER[data], _SYMBOL[data]
    low = wordhash.WORD_BYTES[data]
    odd = np.zeros(n, dtype=bool)
    odd[:-1] = symbol[:-1] & letter[1:]  # a symbol before a letter
    odd[1:] |= symbol[1:] & letter[:-1]  # or after one
    odd[2:] |= letter[2:] & (low[2:] == low[1:-1]) & (low[2:] == low[:-2])
    blank = _BLANK[data]
    # a gap inside a token: between letters or look-alikes, with other gaps at most
    part = letter | symbol
    after, stop = _runs(part, offsets)
    inner = _linked(after, np.flatnonzero(~part & (blank | ~_GAP[data])), offsets)
    gapped = after[1:][inner & (after[1:] > stop[:-1])]
    odd[gapped] = True
    starts, ends = _runs(~blank, offsets)
    has_odd = np.zeros(len(starts), dtype=bool)
    has_odd[np.searchsorted(starts, np.flatnonzero(odd), side="right") - 1] = True
    token = np.flatnonzero(has_odd)
    token = token[_may_hide(data, starts[token], ends[token], gapped)]
    spans = list(zip(starts[token].tolist(), ends[token].tolist()))
    spans += _spelled(data, offsets)
    if lookup is not None and len(lookup.chosen):
        found, joined = _split(data, offsets, lookup, model)
        spans += found
    spans = sorted(set(spans))
    found = []
    texts = (np.searchsorted(offsets, [s for s, _ in spans], side="right") - 1).tolist() if spans else []
    seen = set()  # spans that differ in what is trimmed only
    sure = set((joined[:, 0] * (n + 1) + joined[:, 1]).tolist())
    for (start, end), text in zip(spans, texts):
        value = data[start:end].tobytes().decode("utf-8", "replace").lower()
        value = _SAME.sub("", value.rstrip(_TRIM)).rstrip(_TRIM + "!")
        start += len(value) - len(value := value.lstrip(_TRIM + "(![{<"))
        if (start, value) in seen or (sure and start * (n + 1) + start + len(value.encode()) in sure):
            continue
        seen.add((start, value))
        if _HIDES.search(value) and (
            not _LOOKALIKE.isdisjoint(value) or _AGAIN.search(value) or _SPLIT.search(value)
        ):
            found.append((text, value))
    return found, joined


# --- features --------------------------------------------------------------------------------


def _word_features(values: np.ndarray, start: np.ndarray, end: np.ndarray) -> list[np.ndarray]:
    """Hashes of the words in lower-cased word bytes, and of their beginnings (0 for a word
    that is no longer), repeated letters taken as one."""
    keep = np.ones(len(values), dtype=bool)
    keep[1:] = (values[1:] != values[:-1]) | (values[1:] == 0)
    keep[start] = True  # the first byte of a word that follows another text's
    moved = np.concatenate(([0], np.cumsum(keep)))
    values, start, end = values[keep], moved[start], moved[end]
    with np.errstate(over="ignore"):
        hashes = _Spans(values)
        out = [hashes.hash(start, end)]
        for k in BEGINNINGS:
            longer = np.flatnonzero(end - start > k)
            part = np.zeros(len(start), dtype=np.uint64)
            part[longer] = hashes.hash(start[longer], start[longer] + k) + np.uint64(k)
            out.append(part)
    return out


def _joined_features(data: np.ndarray, offsets: np.ndarray, spans: np.ndarray) -> list[tuple[np.ndarray, np.ndarray]]:
    """(numbers of texts, feature hashes) of spans, each read as one word."""
    size = spans[:, 1] - spans[:, 0]
    ends = np.cumsum(size + 1)
    of = np.repeat(np.arange(len(spans)), size + 1)
    inner = np.arange(ends[-1]) - np.repeat(ends - size - 1, size + 1)
    last = inner == size[of]
    values = wordhash.WORD_BYTES[data[np.minimum(spans[of, 0] + inner, len(data) - 1)]]
    values = np.where(last, 0, values).astype(np.uint8)
    keep = (values != 0) | last
    values, last = values[keep], np.flatnonzero(last[keep])
    start = np.concatenate(([0], last[:-1] + 1))
    text = np.searchsorted(offsets, spans[:, 0], side="right") - 1
    return [(text, hashes) for hashes in _word_features(values, start, last)]


class Restorer:
    """Features of texts after restoring; remembers what it has restored."""

    def __init__(self, model: CharModel | None, lookup: Lookup | None = None, most: int = 50_000):
        self.model, self.lookup, self.most, self.memo = model, lookup, most, {}

    def words(self, token: str) -> list[bytes]:
        """The restored words, without those that the token shows plainly."""
        if token not in self.memo:
            if len(self.memo) >= self.most:
                self.memo.clear()
            plain = wordhash.WORD_BYTES[np.frombuffer(token.encode(), dtype=np.uint8)].tobytes().split(b"\0")
            found = restore(token, self.model).split(b"\0")
            self.memo[token] = [w for w in found if w and w not in plain]
        return self.memo[token]

    def features(self, texts: pa.Array) -> Iterator[tuple[int, int, list[tuple[np.ndarray, np.ndarray]]]]:
        """For groups of texts: first, end, and (numbers of texts, feature hashes)."""
        data, offsets = wordhash.text_bytes(texts)
        with np.errstate(over="ignore"):
            for low, high in wordhash.groups(offsets, GROUP):
                part = offsets[low : high + 1]
                part, piece = part - part[0], data[part[0] : part[-1]]
                words = wordhash.words_of(piece, part)
                found = [
                    (words.text, hashes)
                    for hashes in _word_features(
                        wordhash.WORD_BYTES[piece], words.start, words.end
                    )
                ]
                if self.model is not None:
                    hidden, joined = hidden_tokens(words, part, self.lookup, self.model)
                    if len(joined):
                        found += _joined_features(piece, part, joined)
                    hidden = [(t, w) for t, token in hidden for w in self.words(token)]
                    if hidden:
                        line = b"\0".join(w for _, w in hidden) + b"\0"
                        sizes = np.array([len(w) for _, w in hidden])
                        end = np.cumsum(sizes + 1) - 1
                        text = np.array([t for t, _ in hidden])
                        values = np.frombuffer(line, dtype=np.uint8)
                        found += [(text, h) for h in _word_features(values, end - sizes, end)]
                yield low, high, found


# --- training --------------------------------------------------------------------------------


def fold(key: Column) -> Column:
    """Remainder of the id's digest; 0 is held out."""
    return F.crc32(F.coalesce(key.cast("string"), F.lit(""))) % FOLDS


def _gram_counter(batches: Iterator[pa.RecordBatch]) -> Iterator[pa.RecordBatch]:
    """Runs of four bytes of each lower-cased text, words parted by one zero byte."""
    found, size = [], 0

    def added() -> tuple[np.ndarray, np.ndarray]:
        gram, at = np.unique(np.concatenate([g for g, _ in found]), return_inverse=True)
        return gram, np.bincount(at, weights=np.concatenate([n for _, n in found]), minlength=len(gram))

    for batch in batches:
        data, offsets = wordhash.text_bytes(batch.column("text"))
        for low, high in wordhash.groups(offsets, 4 * wordhash.GROUP_BYTES):
            part = offsets[low : high + 1] - offsets[low]
            values = wordhash.WORD_BYTES[data[offsets[low] : offsets[high]]]
            # no text has a byte of _END, so no run goes from one text to the next
            values = np.insert(values, np.repeat(part, 3), np.tile([0, _END, 0], len(part)).astype(np.uint8))
            values = values[np.concatenate(([True], (values[1:] != 0) | (values[:-1] != 0)))]
            wide = values.astype(np.uint32)
            codes = (wide[:-3] << 24) | (wide[1:-2] << 16) | (wide[2:-1] << 8) | wide[3:]
            end = values == _END
            codes = codes[~(end[:-3] | end[1:-2] | end[2:-1] | end[3:])]
            gram, n = np.unique(codes, return_counts=True)
            found.append((gram, n))
            size += len(gram)
            if size > 1 << 22 and len(found) > 1:
                found = [added()]
                size = len(found[0][0])
                if size > 1 << 21:  # hand on what would fill the task's memory
                    yield from _gram_batches(*found[0])
                    found, size = [], 0
    if found:
        yield from _gram_batches(*added())


def _gram_batches(gram: np.ndarray, n: np.ndarray) -> Iterator[pa.RecordBatch]:
    for low in range(0, len(gram), 1 << 18):
        part = slice(low, low + (1 << 18))
        yield pa.RecordBatch.from_arrays(
            [pa.array(gram[part].astype(np.int64)), pa.array(n[part].astype(np.int64))], names=["gram", "n"]
        )


def _feature_counter(grams):
    def run(batches: Iterator[pa.RecordBatch]) -> Iterator[pa.RecordBatch]:
        restorer = Restorer(CharModel(grams.value))
        for batch in batches:
            toxic = batch.column("toxic").to_numpy(zero_copy_only=False).astype(bool)
            for low, high, found in restorer.features(batch.column("text")):
                text = np.concatenate([t for t, _ in found])
                hashes = np.concatenate([h for _, h in found])
                text, hashes, times = _times(text[hashes != 0], hashes[hashes != 0])
                for level in range(1, LEVELS + 1):
                    has = times >= level
                    feature, at = np.unique(hashes[has], return_inverse=True)
                    bad = toxic[low:high][text[has]]
                    yield pa.RecordBatch.from_arrays(
                        [
                            pa.array(feature.view(np.int64)),
                            pa.array(np.full(len(feature), level, dtype=np.int32)),
                            pa.array(np.bincount(at[bad], minlength=len(feature)).astype(np.int64)),
                            pa.array(np.bincount(at[~bad], minlength=len(feature)).astype(np.int64)),
                        ],
                        names=["feature", "level", "bad", "good"],
                    )

    return run


def _times(text: np.ndarray, value: np.ndarray) -> tuple[np.ndarray, np.ndarray, np.ndarray]:
    """Distinct (text, value) pairs and how often each is there."""
    order = np.lexsort((value, text))
    text, value = text[order], value[order]
    new = np.ones(len(text), dtype=bool)
    new[1:] = (text[1:] != text[:-1]) | (value[1:] != value[:-1])
    first = np.flatnonzero(new)
    return text[first], value[first], np.diff(np.concatenate((first, [len(text)])))


class Lookup:
    """Which of the chosen features (sorted hashes) the texts of a column have."""

    def __init__(self, chosen: np.ndarray):
        self.chosen = chosen
        self.maybe = np.zeros(1 << 16, dtype=bool)
        self.maybe[(chosen >> np.uint64(48)).astype(np.int64)] = True

    def has(self, hashes: np.ndarray) -> np.ndarray:
        """Which hashes are those of chosen features."""
        out = self.maybe[(hashes >> np.uint64(48)).astype(np.int64)]
        at = np.flatnonzero(out)
        place = np.searchsorted(self.chosen, hashes[at])
        place[place == len(self.chosen)] = 0
        out[at] = self.chosen[place] == hashes[at]
        return out

    def had(self, found: list[tuple[np.ndarray, np.ndarray]]):
        """Texts, numbers of the features they have, and how often (up to LEVELS)."""
        out = []
        for text, hashes in found:
            at = np.flatnonzero(self.maybe[(hashes >> np.uint64(48)).astype(np.int64)])
            place = np.searchsorted(self.chosen, hashes[at])
            place[place == len(self.chosen)] = 0
            same = self.chosen[place] == hashes[at]
            out.append(np.stack((text[at[same]], place[same]), axis=1))
        pairs = np.concatenate(out)
        text, number, times = _times(pairs[:, 0], pairs[:, 1])
        return text, number, np.minimum(times, LEVELS)


def _present(grams, chosen):
    def run(batches: Iterator[pa.RecordBatch]) -> Iterator[pa.RecordBatch]:
        lookup = Lookup(chosen.value)
        restorer = Restorer(CharModel(grams.value), lookup)
        for batch in batches:
            for low, high, found in restorer.features(batch.column("text")):
                text, number, times = lookup.had(found)
                # one column for each feature and level; a level has those below it
                step = np.repeat(times, times) - np.concatenate(
                    [np.arange(n, 0, -1) for n in times.tolist()] or [np.empty(0, dtype=int)]
                )
                column = np.repeat(number, times) * LEVELS + step
                ends = np.cumsum(np.bincount(np.repeat(text, times), minlength=high - low))
                lists = pa.ListArray.from_arrays(
                    pa.array(np.concatenate(([0], ends)), pa.int32()), pa.array(column, pa.int32())
                )
                yield pa.RecordBatch.from_arrays(
                    [batch.column("toxic").slice(low, high - low), lists], names=["toxic", "features"]
                )

    return run


def fit_weights(
    rows: np.ndarray, features: np.ndarray, toxic: np.ndarray, n: int, penalty: float = 1.0
) -> np.ndarray:
    """Weights of a logistic model (last: the constant) over (row, feature) pairs, by
    accelerated gradient steps."""
    size = len(toxic)
    rows = np.concatenate((rows, np.arange(size)))
    features = np.concatenate((features, np.full(size, n)))
    shrink = np.full(n + 1, penalty)
    shrink[n] = 1e-3
    # the curvature of each weight bounds its step
    load = np.bincount(rows, minlength=size).astype(float)
    scale = 0.25 * np.bincount(features, weights=load[rows], minlength=n + 1) + shrink
    weights = previous = np.zeros(n + 1)
    for step in range(1, 1001):
        ahead = weights + (step - 1) / (step + 2) * (weights - previous)
        margin = np.bincount(rows, weights=ahead[features], minlength=size)
        error = 1 / (1 + np.exp(-np.clip(margin, -30, 30))) - toxic
        gradient = np.bincount(features, weights=error[rows], minlength=n + 1) + shrink * ahead
        previous, weights = weights, ahead - gradient / scale
        if np.abs(weights - previous).max() < 1e-4:
            break
    return weights


def train(
    docs: DataFrame,
    labels: DataFrame,
    text: str = "text",
    key: str = "doc_id",
    label: str = "toxic",
    rows: int = TRAIN_ROWS,
):
    """((sorted runs of four bytes, how often each is there) for the character model, sorted hashes
    of the chosen features, their weights by number of times, the constant)."""
    spark = docs.sparkSession
    known = labels.select(F.col(key).alias("id"), F.col(label).cast("int").alias("toxic"))
    known = known.filter(F.col("id").isNotNull() & F.col("toxic").isNotNull() & (fold(F.col("id")) != 0))
    known = known.groupBy("id").agg((F.max("toxic") > 0).cast("int").alias("toxic"))
    count = known.count()
    if count > rows:
        known = known.filter(F.pmod(F.xxhash64("id"), F.lit(1 << 30)) < int(rows / count * (1 << 30)))
    # At most about `rows` pairs of numbers: a bounded broadcast.
    sample = (
        docs.select(F.col(key).alias("id"), F.coalesce(F.col(text), F.lit("")).alias("text"))
        .join(F.broadcast(known), "id")
        .groupBy(F.md5("text").alias("digest"))
        .agg(F.first("text").alias("text"), F.max("toxic").alias("toxic"))
        .select("text", "toxic")
    )
    sample = written(sample, "toxicity")
    grams = docs.select(F.col(text).alias("text")).mapInArrow(_gram_counter, "gram long, n long")
    grams = grams.groupBy("gram").agg(F.sum("n").alias("n")).toArrow()
    codes, n = (grams.column(k).to_numpy() for k in ("gram", "n"))
    order = np.argsort(codes)
    grams = codes[order], n[order]
    shared = spark.sparkContext.broadcast(CharModel.counted(*grams))
    counts = sample.mapInArrow(
        _feature_counter(shared), "feature long, level int, bad long, good long"
    )
    counts = counts.groupBy("feature", "level").agg(F.sum("bad").alias("bad"), F.sum("good").alias("good"))
    totals = sample.agg(F.sum("toxic"), F.count("*")).first()
    bad, good = int(totals[0] or 0), int(totals[1]) - int(totals[0] or 0)
    if not bad or not good:
        shared.destroy()
        return grams, np.empty(0, dtype=np.uint64), np.zeros((0, LEVELS + 1)), -30.0
    p, r = (F.col("bad") + 0.5) / (bad + 1), (F.col("good") + 0.5) / (good + 1)
    ratio = F.col("bad") * F.log(p / r) + F.col("good") * F.log(r / p)
    best = (
        counts.filter(F.col("bad") + F.col("good") >= MIN_TEXTS)
        .orderBy(ratio.desc(), "feature", "level")
        .limit(FEATURES)
        .select("feature", "level")
        .toArrow()
    )
    hashes = best.column("feature").to_numpy().view(np.uint64)
    chosen = np.unique(hashes)
    columns = np.searchsorted(chosen, hashes) * LEVELS + best.column("level").to_numpy() - 1
    shared_chosen = spark.sparkContext.broadcast(chosen)
    present = sample.mapInArrow(_present(shared, shared_chosen), "toxic int, features array<int>")
    present = present.toArrow().combine_chunks()
    shared.destroy()
    shared_chosen.destroy()
    toxic = present.column("toxic").to_numpy().astype(float)
    lists = present.column("features").combine_chunks()
    sizes = np.diff(lists.offsets.to_numpy())
    rows_, had = np.repeat(np.arange(len(toxic)), sizes), lists.flatten().to_numpy()
    number = np.full(len(chosen) * LEVELS, -1)
    number[columns] = np.arange(len(columns))
    used = number[had] >= 0
    fitted = fit_weights(rows_[used], number[had[used]], toxic, len(columns))
    weights = np.zeros(len(chosen) * LEVELS)
    weights[columns] = fitted[:-1]
    # by number of times: none, once, ...; each level counts besides those below it
    table = np.zeros((len(chosen), LEVELS + 1))
    table[:, 1:] = weights.reshape(-1, LEVELS).cumsum(axis=1)
    return grams, chosen, table, float(fitted[-1])


def score(docs: DataFrame, model, text: str = "text", into: str = "score") -> DataFrame:
    """Add a score in 0..1 to every document."""
    # what the character model looks up is made once, not by each worker
    shared = sent(docs.sparkSession, (CharModel.counted(*model[0]), *model[1:]))

    def run(batches: Iterator[pa.Array]) -> Iterator[pa.Array]:
        orders, chosen, table, constant = shared.value
        lookup = Lookup(chosen)
        restorer = Restorer(CharModel(orders), lookup)
        for texts in batches:
            out = np.full(len(texts), constant)
            for low, high, found in restorer.features(texts) if len(chosen) else ():
                text, number, times = lookup.had(found)
                out[low:high] += np.bincount(
                    text, weights=table[number, times], minlength=high - low
                )
            yield pa.array(1 / (1 + np.exp(-np.clip(out, -30, 30))))
        del restorer, lookup
        tidy()

    return docs.withColumn(into, F.arrow_udf(run, "double").asNondeterministic()(F.col(text)))
