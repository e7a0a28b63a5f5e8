import hashlib
import random
from collections import Counter

import numpy as np
import pyarrow as pa
import pytest
from pyspark.sql import functions as F

from jobgrain.llm import queries, tokenalign as t
from tests.llm.helpers import SF, docs_of

NO_TOKENS = (0, 0, 0, 0, 0, 0, "", "")


@pytest.fixture(scope="module")
def plain():
    """Encodes whole texts with the libraries themselves, and aligns by sets of offsets."""
    tokenizers = pytest.importorskip("tokenizers")
    sentencepiece = pytest.importorskip("sentencepiece")
    a = tokenizers.Tokenizer.from_file(t.BYTE_BPE)
    a.encode_special_tokens = True
    b = sentencepiece.SentencePieceProcessor(model_file=t.PIECE_BPE)
    byte = t._byte_of_character()
    a_bytes = lambda k: bytes(byte[c] for c in a.id_to_token(k))
    b_bytes = lambda k: t.piece_bytes(b.id_to_piece(k), b.is_byte(k))

    def one(text):
        if not text:
            return None
        ids_a, ids_b = a.encode(" " + text, add_special_tokens=False).ids, b.encode(text)
        parts_a, parts_b = list(map(a_bytes, ids_a)), list(map(b_bytes, ids_b))
        whole = (" " + text).encode()
        if b"".join(parts_a) != whole or b"".join(parts_b) != whole:
            return None
        ends_a, ends_b = np.cumsum(list(map(len, parts_a))), np.cumsum(list(map(len, parts_b)))
        both = sorted(set(ends_a.tolist()) & set(ends_b.tolist()))
        links = [(ids_a[ends_a.tolist().index(e)], ids_b[ends_b.tolist().index(e)]) for e in both]
        groups, before = [], 0
        for e in both:
            groups.append([
                [k for k, x in zip(ids, ends) if before < x <= e]
                for ids, ends in ((ids_a, ends_a), (ids_b, ends_b))
            ])
            before = e
        line = ";".join("|".join(",".join(map(str, x)) for x in g) for g in groups)
        return len(ids_a), len(ids_b), links, line

    def every(texts):
        found = [one(x) for x in texts]
        counts = Counter(p for x in found if x for p in x[2])
        most = Counter()
        for (_, k), n in counts.items():
            most[k] = max(most[k], n)
        return [
            NO_TOKENS
            if x is None
            else (
                x[0], x[1], len(x[2]), len(x[2]),
                sum(counts[p] == most[p[1]] for p in x[2]), sum(counts[p] for p in x[2]),
                hashlib.sha256(x[3].encode()).hexdigest(), x[3],
            )
            for x in found
        ]

    return every


def aligned(docs):
    rows = t.align_tokens(docs, with_groups=True).orderBy("doc_id").select("doc_id", "aligned.*").collect()
    names = ("n_a", "n_b", "n_groups", "n_links", "n_best", "count_sum", "groups_sha256", "groups")
    return [tuple(r[x] for x in names) for r in rows]


EDGES = [
    None, "", " ", "  ", "\n", "a", "the the the", " leading", "trailing ", "two  blanks   three", "tab\t x\n\n y \n",
    "naïve café", "日本語 の 文", "🙂 🙂🏽", "a▁b", "▁", "<|endoftext|> <s> </s> <unk> <0x41>", "é   x　 y  z\u0085 w",
    "it's they'll WE'RE 12345 6789", "ﬁ ½ Ⅷ", "\0 \x01\x1c \x7f", "a" * 3000, "word " * 2000, "x" * 5 + "  y", "“quoted” — text…  ",
    "http://a.b/c?d=e&f=%20 {\"k\": [1, 2]}", "\r\n\r\n  indented\r\n",
]


def test_edges_equal_plain_alignment(spark, plain):
    rows = EDGES + EDGES[5:12]
    assert aligned(docs_of(spark, list(enumerate(rows)))) == plain(rows)


def test_documents_equal_plain_alignment(spark, plain):
    docs = spark.read.parquet(f"{SF}/documents.parquet").orderBy("doc_id").limit(40)
    rows = [r.text[:3000] for r in docs.collect()]
    assert aligned(docs_of(spark, list(enumerate(rows)))) == plain(rows)


def test_merge_path_deals_equal_work_and_loses_no_link():
    draw = random.Random(4)
    for n, m, top in ((0, 5, 10), (5, 0, 10), (1, 1, 1), (40, 60, 80), (300, 200, 310), (500, 500, 500)):
        a = np.array(sorted(draw.sample(range(top), min(n, top))), dtype=np.int64)
        b = np.array(sorted(draw.sample(range(top), min(m, top))), dtype=np.int64)
        merged = sorted([(x, 0) for x in a.tolist()] + [(x, 1) for x in b.tolist()])
        d = np.arange(len(merged) + 1)
        want = [sum(side == 0 for _, side in merged[:k]) for k in d.tolist()]
        assert t.merge_path(a, b, d).tolist() == want
        for work in (1, 2, 3, 7, 1000):
            at_a, at_b = t.links(a, b, work)
            assert a[at_a].tolist() == sorted(set(a.tolist()) & set(b.tolist())) == b[at_b].tolist()


def test_pairs_are_those_of_which_one_ends_the_other():
    a, b = [b"ab", b"b", b"", b"cab"], [b"b", b"ab", b"xcab", b"b", b"c"]
    pairs = t.Pairs(a, b)
    want = [i * 5 + j for i, x in enumerate(a) for j, y in enumerate(b) if x and y and (x.endswith(y) or y.endswith(x))]
    assert pairs.codes.tolist() == want


def test_stretches_are_only_cut_where_no_token_goes_across(spark):
    text = "a b  c  d　 e é ü\t f"
    data, offsets = t.wordhash.text_bytes(pa.array([" " + text]))
    pieces = [x.decode() for x in np.split(data, np.flatnonzero(t._cuts(data, offsets))) for x in [x.tobytes()] if x]
    assert "".join(pieces) == " " + text and all(p.startswith(" ") for p in pieces)
    assert " c  d　 e" in "".join(pieces) and not any(p.endswith((" ", "\t")) for p in pieces[:-1])


def test_equal_hashes_of_unequal_stretches_do_no_harm(spark, plain, monkeypatch):
    monkeypatch.setattr(t.wordhash, "spans_hash", lambda v, s, e: (e - s).astype(np.uint64))
    vocabulary = t.read_byte_bpe()
    with open(t.PIECE_BPE, "rb") as file:
        encoder = t.Encoder(vocabulary, file.read())
    rows = ["one two six", "red", "ten two", "red", "日本 x"]
    codes = t.Pairs(encoder.a_pieces, encoder.b_pieces).codes
    data, offsets = t.wordhash.text_bytes(pa.array(rows))
    got = t.align_group(data, offsets, encoder, codes, t.Writer(60_000), True)
    assert got.field("groups").to_pylist() == [x[7] for x in plain(rows)]


def test_query_empty_table_and_clashing_names(spark):
    rows = queries.op11_token_alignment(spark, SF).collect()
    assert len(rows) == spark.read.parquet(f"{SF}/documents.parquet").count()
    assert set(rows[0].asDict()) >= {"doc_id", "n_a", "n_b", "n_groups", "n_links", "n_best", "count_sum", "groups_sha256"}
    assert aligned(docs_of(spark, [])) == []
    docs = docs_of(spark, [(1, "a b")])
    assert t.align_tokens(docs.withColumn("pairs", F.lit(1)).withColumn("_sums", F.lit(1))).count() == 1
    with pytest.raises(ValueError):
        t.align_tokens(docs.withColumn("aligned", F.lit(1)))
