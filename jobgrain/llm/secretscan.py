"""Secret scan with a trigram inverted index.

Each rule is a regular expression. From its parse tree a Boolean query over trigrams
(lower-cased bytes) is derived that every matching text satisfies. A task indexes its
texts in groups: for each trigram that some rule asks for, the sorted list of texts
that hold it. A rule's query intersects and unites these lists; the texts that remain
are its candidates and are searched with the expression itself, over the whole text.
A rule without mandatory trigrams (long hexadecimal runs) searches every text.

Nothing is shuffled. Cases: a null text counts as empty and has no spans; repeated rows
give a row each; spans of different kinds may overlap, those of one kind never do.
Positions are code points, the end is exclusive.
"""

from __future__ import annotations

import re
from collections.abc import Iterator
from itertools import product

import numpy as np
import pyarrow as pa
from pyspark.sql import Column, DataFrame
from pyspark.sql import functions as F

from jobgrain.llm import wordhash
from jobgrain.llm.shared import tidied

# Kind, expression, group whose length counts, least length. Matches are
# taken leftmost and without overlap, and those with a shorter group are dropped after.
BASE_RULES = [
    (
        "assign",
        r"(?i:(password|passwd|secret|token|api_?key))[\"']?\x20*[:=]\x20*[\"']?([A-Za-z0-9+/_.=-]+)",
        2,
        12,
    ),
    ("access", r"AKIA[A-Z0-9]+", 0, 18),
    ("hex", r"[0-9a-f]{16,}", 0, 16),  # a longest run of [0-9a-f] with 16 or more
]
MORE_RULES = [
    (  # to the END line, or else over the lines of base64 that follow
        "private_key",
        r"-----BEGIN [A-Z ]*PRIVATE KEY-----(?:[^-]*(?:-{1,4}[^-]+)*-----END [A-Z ]*PRIVATE KEY-----"
        r"|(?:[\x09-\x0D\x20]*[A-Za-z0-9+/=]{16,})*)",
        0,
        0,
    ),
    ("github", r"gh[pousr]_[A-Za-z0-9]{36,}", 0, 0),
    ("slack", r"xox[abprs]-[A-Za-z0-9-]{10,}", 0, 0),
    ("google", r"AIza[A-Za-z0-9_-]{35}", 0, 0),
    ("jwt", r"eyJ[A-Za-z0-9_-]{8,}\.eyJ[A-Za-z0-9_-]{8,}\.[A-Za-z0-9_-]+", 0, 0),
    ("url_password", r"://[^/\x09-\x0D\x20:@]+:[^/\x09-\x0D\x20:@]+@", 0, 0),
]
RULES = BASE_RULES + MORE_RULES
SPANS = "array<struct<kind:string,start:int,end:int>>"
_SMALL = 48  # string sets up to this size are kept as sets

# --- trigram queries ---------------------------------------------------------------------

ALL = ("all",)


def _and(*parts):
    parts = {p for q in parts for p in (q[1] if q[0] == "and" else [q]) if q != ALL}
    return ALL if not parts else next(iter(parts)) if len(parts) == 1 else ("and", frozenset(parts))


def _or(*parts):
    if any(q == ALL for q in parts):
        return ALL
    parts = {p for q in parts for p in (q[1] if q[0] == "or" else [q])}
    terms = {p: frozenset(p[1]) if p[0] == "and" else frozenset([p]) for p in parts}
    # an option that asks for all that another asks for, and more, adds nothing
    parts = {p for p in parts if not any(terms[q] < terms[p] for q in parts)}
    return next(iter(parts)) if len(parts) == 1 else ("or", frozenset(parts))


def _holds(strings: set[str]):
    """A text that has one of the strings has these trigrams."""
    options = []
    for s in strings:
        code = s.lower().encode()
        if len(code) < 3:
            return ALL
        options.append(_and(*[("gram", code[k : k + 3]) for k in range(len(code) - 2)]))
    return _or(*options) if options else ALL


class _Part:
    """What the matches of a part of an expression look like: the strings themselves
    where they are few, else how they begin and end, and a query they satisfy."""

    def __init__(self, exact=None, begins=frozenset([""]), ends=frozenset([""]), query=ALL):
        self.exact, self.query = exact, query
        self.begins = exact if exact is not None else begins
        self.ends = exact if exact is not None else ends

    def loose(self):
        """The same without the set of whole strings."""
        if self.exact is None:
            return self
        return _Part(
            None,
            frozenset(s[:2] for s in self.exact),
            frozenset(s[-2:] for s in self.exact),
            _and(self.query, _holds(self.exact)),
        )


def _then(a: _Part, b: _Part) -> _Part:
    if a.exact is not None and b.exact is not None and len(a.exact) * len(b.exact) <= _SMALL:
        return _Part(frozenset(x + y for x, y in product(a.exact, b.exact)), query=_and(a.query, b.query))
    middle = ALL
    if len(a.ends) * len(b.begins) <= _SMALL:
        middle = _holds({x + y for x, y in product(a.ends, b.begins)})
    begins, ends = a.begins, b.ends
    if a.exact is not None and len(a.exact) * len(b.begins) <= _SMALL:
        begins = frozenset((x + y)[:2] for x, y in product(a.exact, b.begins))
    if b.exact is not None and len(a.ends) * len(b.exact) <= _SMALL:
        ends = frozenset((x + y)[-2:] for x, y in product(a.ends, b.exact))
    a, b = a.loose(), b.loose()
    return _Part(None, begins, ends, _and(a.query, b.query, middle))


def _either(parts: list[_Part]) -> _Part:
    if all(p.exact is not None for p in parts):
        strings = frozenset().union(*[p.exact for p in parts])
        if len(strings) <= _SMALL:
            return _Part(strings, query=_or(*[p.query for p in parts]))
    parts = [p.loose() for p in parts]
    return _Part(
        None,
        frozenset().union(*[p.begins for p in parts]),
        frozenset().union(*[p.ends for p in parts]),
        _or(*[p.query for p in parts]),
    )


def _class(items) -> _Part:
    chars = set()
    for op, value in items:
        if str(op) == "LITERAL":
            chars.add(chr(value))
        elif str(op) == "RANGE" and value[1] - value[0] < 12:
            chars.update(map(chr, range(value[0], value[1] + 1)))
        else:
            return _Part()
    return _Part(frozenset(c.lower() for c in chars)) if len(chars) <= 12 else _Part()


def _part(tree) -> _Part:
    whole = _Part(frozenset([""]))
    for op, value in tree:
        op = str(op)
        if op == "LITERAL":
            one = _Part(frozenset([chr(value).lower()]))
        elif op == "IN":
            one = _class(value)
        elif op == "SUBPATTERN":
            one = _part(value[3])
        elif op == "BRANCH":
            one = _either([_part(option) for option in value[1]])
        elif op in ("MAX_REPEAT", "MIN_REPEAT", "POSSESSIVE_REPEAT"):
            least, most, inner = value
            one = _part(inner)
            if (least, most) == (0, 1) and one.exact is not None:
                one = _Part(one.exact | {""})
            elif least == 0:
                one = _Part()
            elif (least, most) != (1, 1):
                one = one.loose()
        else:  # any character, anchors and the like
            one = _Part()
        whole = _then(whole, one)
    return whole


def trigram_query(pattern: str):
    """A Boolean query over trigrams of lower-cased bytes that each matching text
    satisfies; ALL where none is mandatory."""
    return _part(re._parser.parse(pattern)).loose().query


def grams_of(query) -> set[bytes]:
    if query[0] == "gram":
        return {query[1]}
    return set().union(*map(grams_of, query[1])) if query != ALL else set()


# --- index and scan ------------------------------------------------------------------------

_LOWER = np.arange(256, dtype=np.uint8)
_LOWER[0x41:0x5B] += 0x20


def index(data: np.ndarray, offsets: np.ndarray, wanted: np.ndarray) -> dict[int, np.ndarray]:
    """Posting lists: trigram code to the sorted numbers of the texts that hold it,
    for the codes marked in `wanted`."""
    n = len(data) - 2
    if n <= 0:
        return {}
    low = _LOWER[data].astype(np.int32)
    codes = (low[:n] << 16) | (low[1 : n + 1] << 8) | low[2:]
    at = np.flatnonzero(wanted[codes])
    text = np.searchsorted(offsets, at, side="right") - 1
    inside = at + 3 <= offsets[text + 1]
    pairs = np.unique((codes[at[inside]].astype(np.int64) << 32) | text[inside])
    code, text = pairs >> 32, pairs & 0xFFFFFFFF
    cut = np.flatnonzero(np.diff(code)) + 1
    return {
        int(c[0]): t for c, t in zip(np.split(code, cut), np.split(text, cut)) if len(c)
    }


def _code(gram: bytes) -> int:
    return (gram[0] << 16) | (gram[1] << 8) | gram[2]


def candidates(query, postings: dict[int, np.ndarray], n: int) -> np.ndarray:
    """Numbers of the texts that satisfy the query."""
    if query == ALL:
        return np.arange(n)
    if query[0] == "gram":
        return postings.get(_code(query[1]), np.empty(0, dtype=np.int64))
    parts = [candidates(q, postings, n) for q in query[1]]
    if query[0] == "and":
        parts.sort(key=len)
        found = parts[0]
        for part in parts[1:]:
            found = np.intersect1d(found, part, assume_unique=True)
        return found
    return np.unique(np.concatenate(parts))


class Scanner:
    """The rules, compiled, with their trigram queries."""

    def __init__(self, rules=RULES):
        self.rules = [
            (kind, re.compile(pattern, re.ASCII), group, least, trigram_query(pattern))
            for kind, pattern, group, least in rules
        ]
        self.wanted = np.zeros(1 << 24, dtype=bool)
        for rule in self.rules:
            for gram in grams_of(rule[4]):
                self.wanted[_code(gram)] = True

    def spans(self, texts: pa.Array) -> list[list[tuple[int, int, int]]]:
        """(start, rule number, end) of the secrets of each text, in order."""
        data, offsets = wordhash.text_bytes(texts)
        found: list[list[tuple[int, int, int]]] = [[] for _ in range(len(texts))]
        for low, high in wordhash.groups(offsets):
            part = offsets[low : high + 1]
            postings = index(data[part[0] : part[-1]], part - part[0], self.wanted)
            strings: dict[int, str] = {}
            for number, (_, pattern, group, least, query) in enumerate(self.rules):
                for k in candidates(query, postings, high - low).tolist():
                    if k not in strings:
                        strings[k] = texts[low + k].as_py() or ""
                    for match in pattern.finditer(strings[k]):
                        if match.end(group) - match.start(group) >= least:
                            found[low + k].append((match.start(), number, match.end()))
        for spans in found:
            spans.sort()
        return found


def redacted(text: str, spans: list[tuple[int, int, int]], mark: str) -> str:
    """The text with each span, or chain of overlapping spans, replaced by `mark`."""
    out, at = [], 0
    for start, _, end in spans:
        if start >= at:
            out += [text[at:start], mark]
        at = max(at, end)
    return "".join(out) + text[at:]


def _scanner(rules, mark):
    kinds = [rule[0] for rule in rules]

    def run(batches: Iterator[pa.Array]) -> Iterator[pa.Array]:
        scanner = Scanner(rules)
        for texts in batches:
            found = scanner.spans(texts)
            flat = [span for spans in found for span in spans]
            values = pa.StructArray.from_arrays(
                [
                    pa.array([kinds[number] for _, number, _ in flat], pa.string()),
                    pa.array([start for start, _, _ in flat], pa.int32()),
                    pa.array([end for _, _, end in flat], pa.int32()),
                ],
                names=["kind", "start", "end"],
            )
            ends = np.concatenate(([0], np.cumsum([len(spans) for spans in found])))
            clean = [
                redacted(texts[k].as_py(), spans, mark) if spans else None
                for k, spans in enumerate(found)
            ]
            yield pa.StructArray.from_arrays(
                [
                    pa.ListArray.from_arrays(pa.array(ends, pa.int32()), values),
                    pa.array(clean, pa.string()),
                ],
                names=["spans", "clean"],
            )

    return F.arrow_udf(tidied(run), f"struct<spans:{SPANS},clean:string>").asNondeterministic()


def find_secrets(
    docs: DataFrame, text: str = "text", rules=RULES, mark: str = "[secret]", into: str = "found"
) -> DataFrame:
    """Add a struct column `into`: `spans` (kind, start, end; by start, then rule order)
    and `clean`, the text with its secrets replaced by `mark` (null without secrets)."""
    return docs.withColumn(into, _scanner(rules, mark)(F.col(text)))


def spans_text(spans: Column) -> Column:
    """kind:start:end of each span, comma-joined."""
    return F.array_join(
        F.transform(spans, lambda s: F.concat_ws(":", s["kind"], s["start"], s["end"])), ","
    )
