import itertools
import random
from collections import Counter

import numpy as np
import pyarrow as pa
import pytest

from jobgrain.llm import queries, toxicity as t
from tests.llm.helpers import docs_of

SF = "/root/testdata/sf0.1"  # sf0.01 holds out only eight toxic documents


@pytest.fixture(scope="module")
def model(spark):
    read = lambda name: spark.read.parquet(f"{SF}/{name}.parquet")
    return t.train(read("documents"), read("labels"))


def test_held_out_accuracy(spark):
    labels = spark.read.parquet(f"{SF}/labels.parquet").select("doc_id", "toxic")
    rows = queries.op10_toxicity(spark, SF).join(labels, "doc_id").filter("held_out").collect()
    right = sum(r.predicted == r.toxic for r in rows)
    assert len(rows) > 500 and right / len(rows) >= 0.95
    bad = [r.score for r in rows if r.toxic]
    good = [r.score for r in rows if not r.toxic]
    ranked = sum((b > g) + 0.5 * (b == g) for b in bad for g in good) / (len(bad) * len(good))
    assert ranked >= 0.95


@pytest.mark.parametrize(
    "hidden, word",
    [("1d10t", "idiot"), ("m0r0n", "moron"), ("i d i o t", "idiot"), ("s-c-u-m", "scum"), ("looooser", "loser"),
     ("tr@sh", "trash"), ("cl0wn", "clown"), ("p4thetic", "pathetic"), ("5tupid", "stupid")],
)
def test_hidden_words_are_restored(spark, model, hidden, word):
    restored = t.restore(hidden, t.CharModel(model[0])).decode()
    assert restored.replace("\0", "").replace("ss", "s") == word.replace("ss", "s")


def test_hidden_words_raise_the_score(spark, model):
    plain = "the thing and then onthe of it with reer"
    texts = [plain, plain + " you idiot, moron scum", plain + " you 1d10t, m0r0n s c u m", None, "", "  "]
    rows = t.score(docs_of(spark, list(enumerate(texts))), model).collect()
    got = {r.doc_id: r.score for r in rows}
    assert got[0] < 0.1 < 0.5 < got[1]
    assert got[2] > 10 * got[0]
    assert got[3] == got[4] == got[5] and all(0 <= x <= 1 for x in got.values())


def test_hidden_tokens_are_found_in_their_texts():
    import pyarrow as pa

    from jobgrain.llm import wordhash

    texts = ["a 1d10t!!", "word$$$ plain", "x l o s e r y", "sooo", "10.5 2024 f0o", "a a a a a a", "S.C.U.M."]
    data, offsets = wordhash.text_bytes(pa.array(texts))
    found, _ = t.hidden_tokens(wordhash.words_of(data, offsets), offsets)
    assert sorted(found) == [(0, "1d10t"), (2, "x l o s e r y"), (3, "sooo"), (4, "f0o"), (6, "s.c.u.m")]


@pytest.fixture(scope="module")
def small_model():
    """Counts of the runs of four bytes of a few words, and of some beyond ASCII."""
    text = ["the idiot and the loser are at the other bar", "moron scum trash", "élève naïf été où là", "a b c"] * 7
    batch = pa.RecordBatch.from_arrays([pa.array(text)], names=["text"])
    counts = Counter()
    for found in t._gram_counter(iter([batch])):
        counts.update(dict(zip(*(c.to_pylist() for c in found.columns))))
    codes = np.array(sorted(counts))
    return t.CharModel(t.CharModel.counted(codes, np.array([counts[c] for c in codes.tolist()])))


def path_score(model, choice):
    total, context, text = 0.0, b"\0", b""
    for piece, weight in choice:
        total += weight
        for k in range(len(piece)):
            total += model.log(context, piece[k : k + 1])
            context = (context + piece[k : k + 1])[-3:]
        text += piece
    return total + model.log(context, b"\0"), text


def test_restored_is_the_best_of_all_paths(small_model):
    """Every path of the lattice, for all tokens of up to four signs and longer drawn ones."""
    signs = "at 1$-!éo"
    draw = random.Random(3)
    tokens = ["".join(x) for n in (1, 2, 3, 4) for x in itertools.product(signs, repeat=n)]
    tokens += ["".join(draw.choices("theidolsrmn013@$!. -éè", k=draw.randint(5, 9))) for _ in range(300)]
    for token in tokens:
        best = max(path_score(small_model, c)[0] for c in itertools.product(*t.lattice(token)))
        got = t.restore(token, small_model)
        again = max(s for s, text in (path_score(small_model, c) for c in itertools.product(*t.lattice(token))) if text == got)
        assert again > best - 1e-9, token


def test_probabilities_in_arrays_equal_single_ones(small_model):
    draw = random.Random(5)
    runs = ["".join(draw.choices("theidolr\0 é", k=3)).encode()[:4] for _ in range(300)]
    for size in range(4):
        parts = [r[-size - 1 :] for r in runs if len(r) > size]
        codes = np.array([int.from_bytes(p, "big") for p in parts])
        got = small_model.logs(codes, np.full(len(parts), size))
        assert np.allclose(got, [small_model.log(p[:-1], p[-1:]) for p in parts])


def test_what_is_decided_in_arrays_changes_no_feature(small_model):
    """The same chosen features, as often, as with every split token on its lattice."""
    draw = random.Random(11)
    parts = ["id", "iot", "lo", "ser", "the", "mo", "ron", "sc", "um", "a", "tr", "ash", "baar", "lll", "é", "élè", "ve", "éé", "na",
             "1d", "0t", "x!", "$c", "no", "on", "oo", "Id", "IOT", "日", "s"]
    gaps = [" ", " ", " ", "  ", "-", ", ", ". ", "\n", " - ", "! ", "'", ""]
    texts = ["".join(draw.choice(parts) + draw.choice(gaps) for _ in range(draw.randint(1, 40))) for _ in range(250)]
    words = ["idiot", "loser", "moron", "scum", "trash", "theno", "baridiot", "élève", "naon"]
    line = np.frombuffer("\0".join(words).encode() + b"\0", dtype=np.uint8)
    ends = np.flatnonzero(line == 0)
    chosen = np.unique(np.concatenate(t._word_features(line, np.concatenate(([0], ends[:-1] + 1)), ends)))
    lookup = t.Lookup(chosen[chosen != 0])

    def features(restorer):
        out = Counter()
        for low, _, found in restorer.features(pa.array(texts)):
            text, number, times = restorer.lookup.had(found)
            out.update({(low + int(a), int(b)): int(n) for a, b, n in zip(text, number, times)})
        return out

    class Slow(t.Restorer):
        def words(self, token):
            self.asked = getattr(self, "asked", 0) + 1
            return super().words(token)

    fast = Slow(small_model, lookup)
    slow = Slow(small_model, lookup)
    got = features(fast)
    plain, t._Plain.decided = t._Plain.decided, lambda self, start, end, first, more, counts: np.full(len(first), -1)
    try:
        want = features(slow)
    finally:
        t._Plain.decided = plain
    assert got == want and len(want) > 200
    assert fast.asked < slow.asked


def test_without_labels_scores_are_zero(spark):
    docs = docs_of(spark, [(1, "a b"), (None, None)])
    labels = spark.createDataFrame([(1, None), (None, 1)], "doc_id long, toxic int")
    rows = t.score(docs, t.train(docs, labels)).collect()
    assert [round(r.score, 6) for r in rows] == [0.0, 0.0]


def test_fold_of_ids(spark):
    import zlib

    got = spark.range(50).select("id", t.fold(t.F.col("id")).alias("f")).collect()
    assert all(r.f == zlib.crc32(str(r.id).encode()) % 5 for r in got)


def test_weights_separate():
    import numpy as np

    rows, features = np.array([0, 1, 2, 2, 3]), np.array([0, 0, 0, 1, 1])
    w = t.fit_weights(rows, features, np.array([0, 0, 1, 1, 0, 0.0]), 2, penalty=0.1)
    assert w[1] > 1 > w[0] and w[2] < 0


def test_the_character_model_counts_all_texts_once_each(spark):
    from collections import Counter

    texts = {1: "abc  de", 2: "Zürich", 3: "abc", 4: None, 5: "x"}
    docs = docs_of(spark, list(texts.items()))
    labels = spark.createDataFrame([(1, 1), (1, 0)], "doc_id long, toxic int")  # 2 to 5 have no label
    codes, n = t.train(docs, labels, rows=1)[0]
    expected = Counter()
    for line in (b"\0abc\0de\0", "\0zürich\0".encode(), b"\0abc\0", b"\0x\0"):
        expected.update(line[k : k + 4] for k in range(len(line) - 3))
    assert {int(c).to_bytes(4, "big"): int(k) for c, k in zip(codes, n)} == expected


SPELLINGS = [
    "i d i o t", "1 d 1 0 t", "i d i 0 t", "m.0.r.0.n", "s c u m", "i  d  i  o  t", "i - d - i - o - t",
    "idi-ot", "st.upid", "id iot", "id i ot", "s_c_u_m", "id 10t", "st-up1d", "m0 - r0n", "i_d.1 0-t",
]


@pytest.mark.parametrize("hidden", SPELLINGS)
def test_each_spelling_is_found_whole(model, hidden):
    import pyarrow as pa

    from jobgrain.llm import wordhash

    data, offsets = wordhash.text_bytes(pa.array(["plain", f"so {hidden}, then"]))
    found, _ = t.hidden_tokens(wordhash.words_of(data, offsets), offsets, t.Lookup(model[1]))
    assert any(k == 1 and hidden in token for k, token in found)


def test_three_characters_of_any_bytes_are_found():
    import pyarrow as pa

    from jobgrain.llm import wordhash

    data, offsets = wordhash.text_bytes(pa.array(["xx s ü ß yy", "a b", "k", "y z 1"]))
    found, _ = t.hidden_tokens(wordhash.words_of(data, offsets), offsets)
    assert found == [(0, "s ü ß"), (3, "y z 1")]


def test_each_spelling_raises_the_score(spark, model):
    plain = "the thing and then onthe of it with reer"
    texts = [plain] + [f"{plain}. {h}. {h}. {h}" for h in SPELLINGS]
    got = {r.doc_id: r.score for r in t.score(docs_of(spark, list(enumerate(texts))), model).collect()}
    low = [h for k, h in enumerate(SPELLINGS, 1) if got[k] <= 2 * got[0]]
    assert not low, (got, low)


def test_each_gap_is_weighed_once(small_model, monkeypatch):
    """Spans of two, three and four pieces share their gaps, and both readings their work."""
    chosen = []
    for word in ("idiot", "idiotlo", "idiotloser"):
        line = np.frombuffer(word.encode() + b"\0", dtype=np.uint8)
        chosen.append(np.concatenate(t._word_features(line, np.array([0]), np.array([len(word)]))))
    lookup = t.Lookup(np.unique(np.concatenate(chosen))[1:])
    calls, weighed = [], []
    joining = t._Plain.joining

    def counted(self, start, gap, after, end):
        calls.append(len(gap))
        weighed.extend(zip(start.tolist(), end.tolist()))
        return joining(self, start, gap, after, end)

    monkeypatch.setattr(t._Plain, "joining", counted)
    text = "an id iot lo ser or idi ot, los er" * 3
    list(t.Restorer(small_model, lookup).features(pa.array([text, text])))
    assert sum(calls) and len(calls) <= 2 and len(set(weighed)) == len(weighed)


def test_tokens_left_out_in_arrays_hide_nothing():
    """What `_may_hide` refuses, the patterns for tokens refuse too."""
    from jobgrain.llm import wordhash

    draw = random.Random(8)
    signs = list("abB13!$?(.,-_*'\"/:;[<&^\x1d\x85") + ["aaa", "üü", "é", "日", "İ", "!!!", "___", " ", " ", " ", "\n"]
    texts = ["".join(draw.choices(signs, k=draw.randint(0, 60))) for _ in range(400)] + ["word! (so) [it] is, well... 'done'?"]
    data, offsets = wordhash.text_bytes(pa.array(texts))
    start, end = t._runs(~t._BLANK[data], offsets)
    part = t._LETTER[data] | t._SYMBOL[data]
    after, stop = t._runs(part, offsets)
    inner = t._linked(after, np.flatnonzero(~part & (t._BLANK[data] | ~t._GAP[data])), offsets)
    may = t._may_hide(data, start, end, after[1:][inner & (after[1:] > stop[:-1])])
    for a, b, yes in zip(start.tolist(), end.tolist(), may.tolist()):
        value = data[a:b].tobytes().decode().lower()
        value = t._SAME.sub("", value.rstrip(t._TRIM)).rstrip(t._TRIM + "!").lstrip(t._TRIM + "(![{<")
        hides = any(c in t.LOOKALIKES for c in value) or t._AGAIN.search(value) or t._SPLIT.search(value)
        assert yes or not (t._HIDES.search(value) and hides), value
    assert not may[-6:].any() and may[:-6].any()
