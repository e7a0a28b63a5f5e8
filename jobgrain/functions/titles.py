"""Category and seniority level from a normalized job title."""

from __future__ import annotations

import sys
from collections.abc import Iterator

import numpy as np
import pyarrow as pa
from pyspark import cloudpickle
from pyspark.sql import Column, DataFrame
from pyspark.sql import functions as F
from pyspark.sql import types as T

# The scoring functions travel with the plan, so executors need not have this
# package installed.
cloudpickle.register_pickle_by_value(sys.modules[__name__])

# Keyword lists, tested in this order; plain substrings.
SOFTWARE = "Software Engineering"
DATA = "Data and Analytics"
COMPUTER = "Computer and IT"

CATEGORY_KEYWORDS = {
    SOFTWARE: [
        "software engineer", "developer", "development", "programmer",
        "application engineer", "frontend", "network engineer",
        "operations engineer", "backend", "full stack", "embedded engineer",
        "firmware engineer", "devops engineer", "site reliability engineer", "sre",
        "cyber security", "cloud engineer", "solutions engineer",
    ],
    DATA: [
        "data", "analytics", "analysis", "analyst", "machine learning", "ml",
        "artificial intelligence", "ai", "business intelligence", "bi developer",
        "statistics", "scientist", "science", "operations research", "forecasting",
        "etl", "research engineer", "database", "modeler", "warehouse", "value",
        "aws", "azure", "gcp", "google cloud", "ehs", "sap",
    ],
    COMPUTER: [
        " it ", "computer", "support", "helpdesk", "help desk", "infrastracture",
        "administrator", "sysadmin", "security", "technician", "product manager",
        "product owner", "it manager", "it director",
    ],
}
DEFAULT_CATEGORY = SOFTWARE
FUZZY_THRESHOLD = 80.0

LEVEL_KEYWORDS = {
    "Internship": ["intern", "internship", "trainee", "student"],
    "Entry Level": ["junior", "jr", "entry", "graduate", "apprentice"],
    "Senior Level": [
        "senior", "sr ", "sr.", "sr-", "lead", "principal", "head", "director",
        "vice president", "vp", "manager", "chief", "architect", "mgr", "management",
    ],
}
DEFAULT_LEVEL = "Mid Level"


# --- keywords in titles -------------------------------------------------------------------

_NONE = 9  # rank of a title in which no keyword occurs


class KeywordTrie:
    """All keywords of some lists of lists, found in one pass over the bytes of many
    titles: the first two bytes of each position select a node or nothing, and the few
    positions left go down together, a byte a step. Each list gets the rank of its first
    group that has a keyword in the title."""

    def __init__(self, *lists: dict[str, list[str]]):
        nodes: list[dict[int, int]] = [{}]
        ranks = [[_NONE] * len(lists)]
        for k, groups in enumerate(lists):
            for rank, words in enumerate(groups.values()):
                for word in words:
                    node = 0
                    for byte in word.encode():
                        if byte not in nodes[node]:
                            nodes[node][byte] = len(nodes)
                            nodes.append({})
                            ranks.append([_NONE] * len(lists))
                        node = nodes[node][byte]
                    ranks[node][k] = min(rank, ranks[node][k])
        self.next = np.zeros((len(nodes), 256), dtype=np.uint16)
        for node, children in enumerate(nodes):
            for byte, child in children.items():
                self.next[node, byte] = child
        self.ranks = np.array(ranks, dtype=np.uint8)
        self.accepts = (self.ranks < _NONE).any(axis=1)
        if self.accepts[self.next[0]].any():
            raise ValueError("keywords have at least two bytes")
        first = np.arange(1 << 16) >> 8
        self.pairs = self.next[self.next[0, first], np.arange(1 << 16) & 255]
        self.pairs[self.next[0, first] == 0] = 0

    def hits(self, data: np.ndarray, offsets: np.ndarray) -> np.ndarray:
        """Rank of each title (row) in each list (column)."""
        best = np.full((len(offsets) - 1, self.ranks.shape[1]), _NONE, dtype=np.uint8)
        if len(data) < 2:
            return best
        node = self.pairs[(data[:-1].astype(np.uint16) << 8) | data[1:]]
        at = np.flatnonzero(node)
        node, depth = node[at], 2
        while len(at):
            hit = np.flatnonzero(self.accepts[node])
            title = np.searchsorted(offsets, at[hit], side="right") - 1
            whole = at[hit] + depth <= offsets[title + 1]  # not on into the next title
            np.minimum.at(best, title[whole], self.ranks[node[hit[whole]]])
            inside = at + depth < len(data)
            at, node = at[inside], node[inside]
            node = self.next[node, data[at + depth]]
            going = np.flatnonzero(node)
            at, node, depth = at[going], node[going], depth + 1
        return best


def _bytes_of(titles: pa.Array) -> tuple[np.ndarray, np.ndarray]:
    """The bytes of a text column and where each text begins and ends; NULL is empty."""
    titles = titles.fill_null("").cast(pa.large_string())
    _, offsets, data = titles.buffers()
    offsets = np.frombuffer(offsets, dtype=np.int64)[titles.offset : titles.offset + len(titles) + 1]
    data = np.frombuffer(data or b"", dtype=np.uint8)
    return data[offsets[0] : offsets[-1]], offsets - offsets[0]


def _labels(ranks: np.ndarray, names: list[str], default: str | None, valid: np.ndarray) -> pa.Array:
    """Names by rank, `default` where there is none, NULL for NULL titles."""
    place = np.minimum(ranks, len(names))
    return pa.array([*names, default], pa.string()).take(pa.array(place, mask=~valid))


def _keyword_labels(batches: Iterator[pa.Array]) -> Iterator[pa.Array]:
    trie = KeywordTrie(CATEGORY_KEYWORDS, LEVEL_KEYWORDS)
    for titles in batches:
        valid = titles.is_valid().to_numpy(zero_copy_only=False)
        ranks = trie.hits(*_bytes_of(titles))
        yield pa.StructArray.from_arrays(
            [
                _labels(ranks[:, 0], list(CATEGORY_KEYWORDS), None, valid),
                _labels(ranks[:, 1], list(LEVEL_KEYWORDS), DEFAULT_LEVEL, valid),
            ],
            names=["category", "level"],
        )


def _all_labels(batches: Iterator[pa.Array]) -> Iterator[pa.Array]:
    """As by keyword, but with the category of the closest keyword where none occurs;
    each distinct title is scored once while it is remembered."""
    memo: dict[str, str] = {}
    held = 0
    for batch in batches:
        (found,) = _keyword_labels(iter([batch]))
        category, level_ = found.field("category"), found.field("level")
        open_ = batch.is_valid().to_numpy(zero_copy_only=False) & category.is_null().to_numpy(zero_copy_only=False)
        if open_.any():
            at = np.flatnonzero(open_)
            titles = batch.take(pa.array(at)).to_pylist()
            new = [t for t in dict.fromkeys(titles) if t not in memo]
            held += sum(map(len, new))
            if held > _MEMO_CHARS:
                new = list(dict.fromkeys(titles))
                memo, held = {}, sum(map(len, new))
            memo.update(zip(new, closest_labels(new)))
            labels = category.to_numpy(zero_copy_only=False)
            labels[at] = [memo[t] for t in titles]
            category = pa.array(labels, pa.string())
        yield pa.StructArray.from_arrays([category, level_], names=["category", "level"])


_LABELS = T.StructType([T.StructField(n, T.StringType()) for n in ("category", "level")])
keyword_labels = F.arrow_udf(_keyword_labels, _LABELS)
all_labels = F.arrow_udf(_all_labels, _LABELS)


def level(title: Column) -> Column:
    """Seniority level of a lower-case (normalized) title; NULL for a NULL title."""
    return keyword_labels(title)["level"]


def keyword_category(title: Column) -> Column:
    """Category by keyword, NULL when no keyword occurs."""
    return keyword_labels(title)["category"]


def category(title: Column) -> Column:
    """Category of a normalized title: by keyword, else by the closest keyword, else the
    default; NULL for a NULL title.

    Nothing is shuffled, so a title shared by very many rows costs no more than any
    other. Taken together with the level of the same title, both come from one pass.
    """
    return all_labels(title)["category"]


def with_labels(df: DataFrame, title: str, category: str, level: str) -> DataFrame:
    """Add category and level of a normalized title, in one pass over it."""
    labels = all_labels(F.col(title))
    return df.withColumns({category: labels["category"], level: labels["level"]})


def with_category(df: DataFrame, title: str, into: str) -> DataFrame:
    """Add the category of a normalized title."""
    return df.withColumn(into, category(F.col(title)))


# --- closeness of a title to a keyword -------------------------------------------

_KEYWORDS = [(word, label) for label, words in CATEGORY_KEYWORDS.items() for word in words]
_CHUNK_CHARS = 1_000_000  # characters scored together; bounds the memory of a task
_MEMO_CHARS = 20_000_000  # characters of scored titles a task remembers


def _common_subsequence(needle: np.ndarray, hay: np.ndarray) -> np.ndarray:
    """Length of the longest common subsequence of `needle` (at most 62 codes)
    with each window of len(needle) consecutive codes of `hay`, using one bit
    per needle position."""
    m = len(needle)
    codes, place = np.unique(needle, return_inverse=True)
    masks = np.zeros(len(codes) + 1, dtype=np.int64)
    np.bitwise_or.at(masks, place, np.int64(1) << np.arange(m, dtype=np.int64))
    at = np.searchsorted(codes, hay)
    at[at == len(codes)] = 0
    hay_mask = np.where(codes[at] == hay, masks[at], 0)
    full = np.int64((1 << m) - 1)
    state = np.full(len(hay) - m + 1, full, dtype=np.int64)
    for step in range(m):
        hit = state & hay_mask[step : step + len(state)]
        state = ((state + hit) | (state - hit)) & full
    matched = full & ~state
    count = np.zeros(len(state), dtype=np.int64)
    for bit in range(m):
        count += (matched >> bit) & 1
    return count


def _window_scores(needle: np.ndarray, hay: np.ndarray, filled: np.ndarray) -> np.ndarray:
    """Similarity (0-100) of the needle with every window; `filled` marks the
    real characters of `hay` (the rest is padding)."""
    m = len(needle)
    total = np.concatenate(([0], np.cumsum(filled)))
    size = total[m:] - total[:-m]
    return 200.0 * _common_subsequence(needle, hay) / (m + size)


def _codes(text: str) -> np.ndarray:
    return np.frombuffer(text.encode("utf-32-le", "surrogatepass"), dtype=np.int32)


def best_window_score(short: str, long: str) -> float:
    """Best similarity of the shorter text with any window of the longer one,
    where windows may hang over both ends. 100 means it is contained."""
    if len(short) > len(long):
        short, long = long, short
    if not short:
        return 100.0 if not long else 0.0
    if len(short) > 62:
        raise ValueError("the shorter text may have at most 62 characters")
    pad = np.full(len(short) - 1, -1, dtype=np.int32)

    def one_way(a: str, b: str) -> float:
        hay = np.concatenate((pad, _codes(b), pad))
        return float(_window_scores(_codes(a), hay, hay >= 0).max())

    best = one_way(short, long)
    if len(short) == len(long) and best < 100.0:
        best = max(best, one_way(long, short))
    return best


def _score_together(titles: list[str]) -> list[str]:
    """Category of each title by closest keyword."""
    longest = max(len(word) for word, _ in _KEYWORDS)
    pad = np.full(longest, -1, dtype=np.int32)
    parts, starts, at = [pad], [], longest
    for title in titles:
        starts.append(at)
        parts += [_codes(title), pad]
        at += len(title) + longest
    hay = np.concatenate(parts)
    filled = hay >= 0
    first = np.array(starts)
    sizes = np.array([len(t) for t in titles])
    best = np.zeros(len(titles))
    label = np.full(len(titles), DEFAULT_CATEGORY, dtype=object)
    for word, word_label in _KEYWORDS:
        m = len(word)
        by_start = _window_scores(_codes(word), hay, filled)
        # windows that begin up to m - 1 characters before the title
        score = np.maximum.reduceat(
            by_start, np.stack((first - m + 1, first + sizes), axis=1).ravel()
        )[::2]
        for i in np.flatnonzero(sizes <= m):
            score[i] = best_window_score(word, titles[i])
        better = score > best
        best[better] = score[better]
        label[better] = word_label
    label[best < FUZZY_THRESHOLD] = DEFAULT_CATEGORY
    return list(label)


def closest_labels(titles: list[str]) -> list[str]:
    """Category of each title, scored in groups of bounded size."""
    out: list[str] = []
    group: list[str] = []
    chars = 0
    for title in titles:
        if group and chars + len(title) > _CHUNK_CHARS:
            out += _score_together(group)
            group, chars = [], 0
        group.append(title)
        chars += len(title)
    return out + (_score_together(group) if group else [])
