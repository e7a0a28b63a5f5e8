"""Plain versions of what the operators compute."""

import re
from collections import Counter, defaultdict

WORD = re.compile(r"[^\x00-\x2F\x3A-\x60\x7B-\x7F]+")
LOWER = {ord(c): c.lower() for c in "ABCDEFGHIJKLMNOPQRSTUVWXYZ"}
SF = "/root/testdata/sf0.001"
DOCS = "doc_id long, text string, lang string, source string, n_chars long"


def words(text):
    return WORD.findall((text or "").translate(LOWER))


def docs_of(spark, rows):
    """Documents from (doc_id, text) or (doc_id, text, source)."""
    full = [
        (r[0], r[1], "en", r[2] if len(r) > 2 else "src", None if r[1] is None else len(r[1])) for r in rows
    ]
    return spark.createDataFrame(full, DOCS)


def shingles(text, width=5):
    w = words(text)
    if not w:
        return frozenset()
    return frozenset(tuple(w[k : k + width]) for k in range(len(w) - width + 1)) or frozenset([tuple(w)])


def similar_pairs(sets, least=0.8):
    """Pairs of keys whose sets are that similar, by an index of all elements."""
    having = defaultdict(list)
    for key, s in sets.items():
        for x in s:
            having[x].append(key)
    shared = Counter()
    for keys in having.values():
        for i, a in enumerate(keys):
            for b in keys[i + 1 :]:
                shared[a, b] += 1
    return [
        (a, b) for (a, b), n in shared.items() if n * (1 + least) >= least * (len(sets[a]) + len(sets[b])) - 1e-9
    ]


def classes(keys, pairs):
    name = {k: k for k in keys}

    def find(k):
        while name[k] != k:
            k = name[k]
        return k

    for a, b in pairs:
        a, b = find(a), find(b)
        name[max(a, b)] = min(a, b)
    return {k: find(k) for k in keys}
