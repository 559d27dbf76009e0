import math
import random
import zlib
from collections import Counter, defaultdict

import numpy as np
import pytest

from quire.llm import ppm
from tests.conftest import frame

_rng = random.Random(6)
_VOCAB = ["the", "cat", "sat", "on", "mat", "ünïcode", "a", "bat", "hat", "ran", "to", "and", "then"]
TEXTS = [
    (1, "the cat sat on the mat the end"),
    (2, "The bat and the cat\tran  to the hat"),
    (3, None),
    (4, ""),
    (5, "zebra quux ünïcode the"),
    (6, "the the the the"),
    (7, "x" * 3000 + " the cat"),
    (6, "the the the the"),
    (None, "cat"),
    *((i, " ".join(_rng.choices(_VOCAB, k=30))) for i in range(10, 22)),
]
SCHEMA = "doc_id bigint, text string"


def tokens(t):
    return [*(t or "").encode().lower().split(), b"\n"]


def stream(t):
    return b"\n" * 5 + b"".join(w + b" " for w in tokens(t)[:-1]) + b"\n"


def naive_text(t, counts):
    s, total = stream(t), 0.0
    for i in range(5, len(s)):
        refused = set()
        for k in range(5, -1, -1):
            follow = counts.get(s[i - k : i])
            if follow is None:
                continue
            live = {b: n for b, n in follow.items() if b not in refused}
            whole = sum(live.values()) + len(live)
            if s[i] in live:
                total += math.log10(live[s[i]] / whole)
                break
            if live:
                total += math.log10(len(live) / whole)
            refused |= set(follow)
        else:
            total -= math.log10(256 - len(refused))
    return total


def naive(texts):
    train = [t for i, t in texts if i is not None and zlib.crc32(str(i).encode()) % 5 != 1]
    c = Counter(w for t in train for w in tokens(t))
    counts = defaultdict(Counter)
    for t in train:
        s = stream(t)
        for i in range(5, len(s)):
            for k in range(6):
                counts[s[i - k : i]][s[i]] += 1
    n, v = sum(c.values()), len(c)
    return sorted(
        (
            (i if i is not None else -1, len(tokens(t)), sum(w in c for w in tokens(t)), n),
            sum(math.log10((c[w] + 0.5) / (n + 0.5 * (v + 1))) for w in tokens(t)),
            naive_text(t, counts),
        )
        for i, t in texts
    )


@pytest.mark.parametrize("hot,hot_grams,chunk", [(50_000, 2_000_000, 1 << 20), (2, 7, 50)])
def test_scores_equal_the_definition(spark, monkeypatch, hot, hot_grams, chunk):
    monkeypatch.setattr(ppm, "CHUNK", chunk)
    df = frame(spark, TEXTS, SCHEMA).repartition(3)
    got = ppm.score_texts(df, ppm.bucket_of(df["doc_id"], 5) != 1, hot=hot, hot_grams=hot_grams).collect()
    same = {r["score"] for r in got if r["doc_id"] == 6}
    assert len(same) == 1
    got = sorted(((r["doc_id"] if r["doc_id"] is not None else -1, r["n_tokens"], r["n_known"], r["train_tokens"]), r["base_score"], r["score"]) for r in got)
    for a, b in zip(got, naive(TEXTS), strict=True):
        assert a[0] == b[0]
        assert a[1] == pytest.approx(b[1], rel=1e-9)
        assert a[2] == pytest.approx(b[2], rel=1e-9)


def test_the_order_of_words_matters_and_fluent_text_is_likelier(spark):
    phrase = "one two three four five six seven eight nine ten"
    rows = [(i, phrase) for i in range(40)] + [(1000 + i, x) for i, x in enumerate((phrase, " ".join(reversed(phrase.split()))))]
    df = frame(spark, rows, SCHEMA)
    got = {r["doc_id"]: (r["base_score"], r["score"]) for r in ppm.score_texts(df, df["doc_id"] < 1000).collect()}
    assert got[1000][0] == got[1001][0] and got[1000][1] > got[1001][1] + 5


def test_clashing_columns_empty_table_and_nothing_to_learn_from(spark):
    clash = "row int, id int, k int, c int, key string, rest int"
    assert ppm.language_model_scores(frame(spark, [], f"{SCHEMA}, {clash}")).collect() == []
    df = frame(spark, [(1, "ab", 1, 2, 3, 4, "k", 5)], f"{SCHEMA}, {clash}")
    got = ppm.score_texts(df, df["doc_id"] > 5).first()
    assert got["score"] == pytest.approx(-4 * math.log10(256)) and got["train_tokens"] == 0


def test_probabilities_of_a_context_add_up_to_one(spark):
    g, _ = ppm.grams([ppm.coded(t.split()) for t in (b"abc abd b", b"abc b", b"xb ab")])
    known = Counter(g.tolist())
    rows = list(known.items())
    contexts = [b"\n\n\n\n\n", b"c abd", b"bc ab", b"zzzab", b"zzzzz"]
    for c in contexts:
        rows += [(x, 0) for x in (int.from_bytes(c + bytes([b]), "big") for b in range(256)) if x not in known]
    got = {r["gram"]: r["q"] for r in ppm.gram_values(frame(spark, rows, "gram bigint, c bigint")).collect()}
    for c in contexts:
        assert sum(10 ** (got[int.from_bytes(c + bytes([b]), "big")] / ppm.UNIT) for b in range(256)) == pytest.approx(1.0)
    assert len(got) == len(rows) and np.all(np.array(list(got.values())) <= 0)


def test_pieces_of_long_texts_have_the_grams_of_the_whole(monkeypatch):
    texts = [ppm.coded(t.split()) for t in (b"a long text that is cut into pieces of few bytes", b"", b"short", b"x" * 40)]
    whole, lens = ppm.grams(texts)
    want = sorted(zip(np.repeat(np.arange(len(texts)), lens).tolist(), whole.tolist()))
    for size in (1, 7, 16, 1000):
        monkeypatch.setattr(ppm, "CHUNK", size)
        got = []
        for owners, some in ppm.pieces(texts):
            keys, lens = ppm.grams(some)
            got += zip(np.repeat(owners, lens).tolist(), keys.tolist())
        assert sorted(got) == want
    listed = ppm.entries(3, [[(b"w", 2)], [], []], [(np.array([2, 0]), np.array([65, 0x0102030405FF]), np.array([3, 4]))]).to_pylist()
    assert [[(e["key"], e["k"]) for e in x] for x in listed] == [[(b"w", 2), (b"\n\x01\x02\x03\x04\x05\xff", 4)], [], [(b"\n\0\0\0\0\0A", 3)]]
    assert ppm.entries(1, [[]], []).to_pylist() == [[]]


def test_texts_prepared_at_once_are_those_of_the_definition(monkeypatch):
    texts = [b"", None, b" \t\n ", b"One", b"\n two\x0b\x0cTHREE \r\n", "Ünï ÉTÉ\xa0x\u2028y".encode(), b"z" * 40, b"\xff\n\xff", b"the end", b""]
    own = [(t or b"").lower().split() for t in texts]
    for size in (1, 9, 30, 1 << 20):
        monkeypatch.setattr(ppm, "CHUNK", size)
        codes, words, n_words, firsts = [], [], [], []
        for first, some, w, n in ppm.prepared(texts):
            firsts.append(first == len(codes))
            codes, words, n_words = codes + some, words + w.to_pylist(), n_words + n.tolist()
        assert all(firsts) and codes == [ppm.coded(o) for o in own]
        assert words == [w for o in own for w in o] and n_words == [len(o) for o in own]
    assert list(ppm.prepared([])) == []


def test_counts_hold_across_flushes(spark, monkeypatch):
    df = frame(spark, TEXTS, SCHEMA).repartition(2)
    learn = ppm.bucket_of(df["doc_id"], 5) != 1
    train = [t for i, t in TEXTS if i is not None and zlib.crc32(str(i).encode()) % 5 != 1]
    words = Counter(w for t in train for w in tokens(t))
    streams = {t: stream(t) for _, t in TEXTS}
    cut = lambda t: [int.from_bytes(streams[t][i - 5 : i + 1], "big") for i in range(5, len(streams[t]))]
    grams = Counter(g for t in train for g in cut(t))
    for flush in (1, 5, 400_000):
        monkeypatch.setattr(ppm, "FLUSH", flush)
        monkeypatch.setattr(ppm, "CHUNK", 40 if flush == 5 else 1 << 20)
        assert {r["word"]: r["c"] for r in ppm.count_tokens(df, "doc_id", "text", learn).collect()} == {w: words[w] for _, t in TEXTS for w in tokens(t)}
        assert {r["gram"]: r["c"] for r in ppm.count_grams(df, "text", learn).collect()} == {g: grams[g] for _, t in TEXTS for g in cut(t)}
