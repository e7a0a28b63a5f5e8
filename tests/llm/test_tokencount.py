import re
from functools import lru_cache

import numpy as np
import pyarrow as pa
import pytest
from pyspark.sql import functions as F

from jobgrain.llm import queries, tokencount as t
from tests.llm.helpers import SF, docs_of

RUN = re.compile(
    rb" ?[A-Za-z\x80-\xff]+| ?[0-9]+| ?[^A-Za-z\x80-\xff0-9 \t-\r]+|[ \t-\r]+"
)


def plain_pretokens(data):
    out, at = [], 0
    while at < len(data):
        token = RUN.match(data, at)[0]
        if len(token) > 1 and not token.strip(b" \t\n\r\v\f") and token.endswith(b" ") and at + len(token) < len(data):
            token = token[:-1]
        out.append(token)
        at += len(token)
    return out


@pytest.fixture(scope="module")
def vocabulary():
    return t.read_vocabulary()


@pytest.fixture(scope="module")
def plain(vocabulary):
    longest = max(map(len, vocabulary))

    @lru_cache(None)
    def count(token):
        best = [(0.0, 0)]
        for end in range(1, len(token) + 1):
            options = [
                (best[end - k][0] + vocabulary[token[end - k : end]], -k, best[end - k][1] + 1)
                for k in range(1, min(end, longest) + 1)
                if token[end - k : end] in vocabulary
            ]
            score, _, n = max(options)
            best.append((score, n))
        return best[-1]

    return count


TEXTS = [None, "", " ", "a", "  a  b\n\n c  ", "x1 2  !!a", "naïve café", "a" * 500 + " b", "-" * 200, "1234567890123456789"]


def test_counts_equal_plain_dynamic_programming(spark, vocabulary, plain):
    texts = TEXTS + [r.text for r in spark.read.parquet(f"{SF}/documents.parquet").limit(60).collect()]
    got = t.count_texts(pa.array(texts, pa.string()), t.Pieces(vocabulary)).to_pylist()
    for text, found in zip(texts, got):
        tokens = plain_pretokens((text or "").encode())
        best = [plain(token) for token in tokens]
        assert (found["n_pretokens"], found["n_tokens"]) == (len(tokens), sum(n for _, n in best)), text
        assert np.isclose(found["score"], sum(s for s, _ in best))


def test_scores_equal_a_public_unigram_model(vocabulary):
    """The same vocabulary in another library, with bytes shown as characters."""
    tokenizers = pytest.importorskip("tokenizers")
    shown = lambda b: "".join(chr(0x100 + x) for x in b)
    pieces = [(shown(p), s) for p, s in vocabulary.items() if len(p) <= 16]
    model = tokenizers.Tokenizer(tokenizers.models.Unigram(pieces, None, False))
    own = t.Pieces({p: s for p, s in vocabulary.items() if len(p) <= 16})
    score = dict(pieces)
    for word in (b"the", b" therefore", b"onstbletion", "élévation".encode(), b" unbelievable", b"zzzzqqq"):
        data = np.frombuffer(word, dtype=np.uint8)
        counts, best = t.count_pieces(data, np.array([0]), np.array([len(word)]), own)
        tokens = model.encode(shown(word)).tokens
        assert counts[0] == len(tokens)
        assert np.isclose(best[0], sum(score[x] for x in tokens))


def test_sharing_in_the_trie_changes_nothing(vocabulary, plain):
    words = [b"the", b"then", b"there", b"thereof", b"x", b"the ", b" the", b"nation", b"national"]
    data = np.frombuffer(b"".join(words), dtype=np.uint8)
    end = np.cumsum([len(w) for w in words])
    counts, _ = t.count_pieces(data, end - [len(w) for w in words], end, t.Pieces(vocabulary))
    assert counts.tolist() == [plain(w)[1] for w in words]


def test_query_and_its_rows(spark):
    rows = queries.op2_token_counts(spark, SF).collect()
    n = spark.read.parquet(f"{SF}/documents.parquet").count()
    assert len(rows) == n and all(r.n_tokens >= r.n_pretokens for r in rows)
    empty = t.count_tokens(docs_of(spark, [])).select(F.col("counted.n_tokens")).collect()
    assert empty == []
