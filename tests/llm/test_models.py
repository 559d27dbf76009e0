import math
import random
import zlib
from collections import defaultdict

import numpy as np
import public_tokenizers
import pytest
from hypothesis import given, settings
from hypothesis import strategies as st

from quire.llm import langid as G
from quire.llm import packing as P
from quire.llm import toxicity as T
from tests.conftest import frame

PATH = public_tokenizers.path("word_bpe_49k.json")

# packing ---------------------------------------------------------------------------------------


@settings(max_examples=200, deadline=None)
@given(st.lists(st.one_of(st.text(max_size=12), st.sampled_from(["it's", "'LL", "<|endoftext|>", "<|STARTOFTEXT|>", "é", "́", "İx", "don't,", "Ünï!?", "a.b", "ς", "Σ", " ", "12:30"])), max_size=12), st.sampled_from([" ", "\n", "\t \r\n", ""]))
def test_memoised_ids_are_the_tokenizers_ids(parts, glue):
    text = glue.join(parts).encode("utf-8", "ignore").decode()
    e = P.encoder(PATH)
    assert e.ids([text.encode()])[0] == np.array(e.direct(text), "<u4").tobytes()


@settings(max_examples=60, deadline=None)
@given(st.lists(st.integers(1, 100), max_size=80), st.sampled_from([8, 16, 32]))
def test_packs_hold_every_token_once_without_padding(sizes, window):
    docs = [(i, np.full(n, i, "<u4").tobytes()) for i, n in enumerate(sizes)]
    pieces, fill = defaultdict(list), defaultdict(list)
    for doc, ids, start, length, sequence, offset in P.pack_documents(iter(docs), window):
        assert length > 0 and ids == docs[doc][1]
        pieces[doc].append((start, length))
        fill[sequence].append((offset, length))
    for i, n in enumerate(sizes):
        at = 0
        for start, length in sorted(pieces[i]):
            assert start == at
            at += length
        assert at == n
    for rows in fill.values():
        at = 0
        for offset, length in sorted(rows):
            assert offset == at
            at += length
        assert at == window or at & (at - 1) == 0 and at < window


def test_sum_of_squares_takes_the_cheapest_level():
    rng = random.Random(1)
    packer = P.SumOfSquares(16)
    for _ in range(400):
        size, before = rng.randint(1, 15), packer.count.copy()

        def cost(level, before=before, size=size):
            c = before.copy()
            if level:
                c[level] -= 1
            if level + size < 16:
                c[level + size] += 1
            return int((c[1:16] ** 2).sum())

        options = [0, *(lv for lv in range(1, 16 - size + 1) if before[lv])]
        packer.place(None, size)
        assert int((packer.count[1:16] ** 2).sum()) == min(map(cost, options))


def test_a_small_memory_changes_no_id(monkeypatch):
    monkeypatch.setattr(P, "MEMO", 12)
    encoder = P.Encoder(public_tokenizers.path("word_bpe_49k.json"))
    texts = ["the cat, the dog; The end.", "a Dog! the cat", "x" * 50 + " the 12 cats' ends", "", "é the über, cat dog"] * 3
    assert encoder.ids([t.encode() for t in texts]) == [np.array(encoder.direct(t), "<u4").tobytes() for t in texts]


def test_open_windows_keep_what_was_placed_in_them():
    r = random.Random(6)
    docs = [(i, bytes(4 * r.randint(1, 99))) for i in range(700)]
    packer = P.SumOfSquares(100)
    placed = [full for d, ids in docs if (full := packer.place((d, ids, 0), len(ids) // 4))]
    opened = list(packer.rest())
    sequences = {}
    for doc, _, _, _, sequence, _ in P.pack_documents(iter(docs), 100):
        sequences.setdefault(sequence, []).append(doc)
    got = [set(s) for s in sequences.values()]
    assert all({p[0] for p, _ in held} in got for held in placed)  # as the level array filled them
    kept = sum(any({p[0] for p, _ in held} <= s for s in got) for held in opened)
    tokens = sum(size for held in opened for _, size in held)
    assert kept >= tokens // 100 - 1  # no more are taken apart than their tokens demand


def test_pack_rows(spark):
    rows = [(1, "a small text"), (2, None), (3, ""), (4, "long words " * 3000), (None, "x"), (1, "a small text")]
    df = frame(spark, rows, "doc_id bigint, text string")
    got = P.pack(df.repartition(3), PATH).collect()
    e = P.encoder(PATH)
    ids = {i: np.array([*e.direct(t or ""), 1], "<u4").tobytes() for i, t in rows}
    assert sum(r["length"] for r in got) == sum(len(ids[i]) // 4 for i, _ in rows)
    for r in got:
        own = ids[r["doc_id"]]
        assert r["doc_tokens"] == len(own) // 4
        assert r["ids_crc32"] == zlib.crc32(own[4 * r["start"] : 4 * (r["start"] + r["length"])])
    assert [r["length"] for r in got if r["doc_id"] == 2] == [1]
    assert P.pack(df.limit(0), PATH).collect() == []


# language identification ------------------------------------------------------------------------

SYLLABLES = {"xx": ["ka", "to", "mi", "ra"], "yy": ["sch", "en", "ber", "ung"]}


def made_up(lang, rng, n=60):
    return " ".join("".join(rng.choices(SYLLABLES[lang], k=rng.randint(1, 3))) for _ in range(n))


def test_posteriors_equal_the_sum_over_paths():
    rng = np.random.default_rng(0)
    trans = rng.normal(size=(3, 3))
    seqs = [rng.normal(size=(n, 3)) for n in (4, 1, 3, 0)]
    for e, g in zip(seqs, G.forward_backward(seqs, trans), strict=True):
        want, total = np.zeros_like(e), 0.0
        for path in np.ndindex(*[3] * len(e)) if len(e) else ():
            p = np.exp(sum(e[t, y] for t, y in enumerate(path)) + sum(trans[a, b] for a, b in zip(path, path[1:])))
            total += p
            for t, y in enumerate(path):
                want[t, y] += p
        assert g.shape == e.shape and np.allclose(g, want / total if len(e) else want)


def test_gradients_equal_differences():
    rng = np.random.default_rng(1)
    e, y, trans = rng.normal(size=(2, 4, 3)), rng.integers(0, 3, (2, 4)), rng.normal(size=(3, 3))

    def loss(e, trans):
        total = 0.0
        for s in range(2):
            z = sum(np.exp(sum(e[s, t, k] for t, k in enumerate(p)) + sum(trans[a, b] for a, b in zip(p, p[1:]))) for p in np.ndindex(3, 3, 3, 3))
            total += np.log(z) - sum(e[s, t, k] for t, k in enumerate(y[s])) - sum(trans[a, b] for a, b in zip(y[s], y[s][1:]))
        return total

    de, dt = G._gradients(e, y, trans)
    for grad, x, f in ((de, e, lambda v: loss(v, trans)), (dt, trans, lambda v: loss(e, v))):
        for at in np.ndindex(x.shape):
            up, down = x.copy(), x.copy()
            up[at] += 1e-5
            down[at] -= 1e-5
            assert grad[at] == pytest.approx((f(up) - f(down)) / 2e-5, abs=1e-4)


def test_languages_are_learned(spark):
    rng = random.Random(2)
    rows = [(i, made_up(lang := "xx" if i % 2 else "yy", rng), lang, "s") for i in range(200)]
    rows += [(500, None, "xx", "s"), (501, "123 -- ²", None, "s"), (502, "", "yy", "s"), (None, made_up("xx", rng), None, "s"), (0, rows[0][1], "yy", "s"), (503, "schen" * 20_000, None, "s")]
    df = frame(spark, rows, "doc_id bigint, text string, lang string, score string")
    got = [r for r in G.identify(df).collect()]
    assert len(got) == len(rows)
    by = {r["doc_id"]: r for r in got}
    assert all(by[i]["lang_pred"] == ("xx" if i % 2 else "yy") and by[i]["score"] > 0.9 for i in range(200))
    assert [by[i]["lang_pred"] for i in (500, 501, 502, None, 503)] == ["und", "und", "und", "xx", "yy"]
    assert all(r["held_out"] == (r["doc_id"] is not None and zlib.crc32(str(r["doc_id"]).encode()) % 5 == 0) for r in got)
    mixed = made_up("xx", rng, 20) + " " + made_up("yy", rng, 20)
    words = G.label_words(frame(spark, [(1, mixed)], "doc_id bigint, text string"), G.train(df, df["doc_id"] >= 0), ["doc_id"]).first()["words"]
    assert sum(w["lang"] == ("xx" if i < 20 else "yy") for i, w in enumerate(words)) >= 36
    nothing = G.identify(frame(spark, [(1, "word", None)], "doc_id bigint, text string, lang string")).first()
    assert nothing["lang_pred"] == "und" and nothing["score"] == 0.0
    assert G.identify(df.limit(0)).collect() == []


# toxicity ----------------------------------------------------------------------------------------


def gram_column(gram):
    """The column of one n-gram, byte by byte."""
    h = 1469598103934665603
    for b in gram:
        h = (h ^ b) * 1099511628211 % 2**64
    h = (h ^ h >> 29 ^ len(gram)) * 0x9E3779B97F4A7C15 % 2**64
    return h >> 64 - T.BITS


def grams(text):
    words = {b" " + w + b" " for w in text.lower().split()}
    return {w[i : i + n] for w in words for n in T.SIZES for i in range(len(w) - n + 1)}


def test_features_ratios_and_regression_equal_a_plain_version():
    r = random.Random(8)
    words = ["".join(r.choices("abcdé", k=r.randint(1, 5))) for _ in range(40)]
    texts = [" ".join(r.choices(words[: 25 if i % 3 else 40], k=r.randint(0, 12))).encode() for i in range(60)]
    labels = [int(i % 3 == 0) for i in range(60)]
    columns = [sorted({gram_column(g) for g in grams(t)}) for t in texts]
    assert [x.tolist() for x in T.Features().of_texts(texts)] == columns
    # log-count ratios of columns that more than two texts have
    count = {c: [sum(c in x for x, y in zip(columns, labels) if y == k) for k in (0, 1)] for x in columns for c in x}
    total = [2**T.BITS + sum(n[k] for n in count.values()) for k in (0, 1)]
    ratio = {c: math.log((n[1] + 1) / total[1]) - math.log((n[0] + 1) / total[0]) for c, n in count.items() if sum(n) > 2}
    model = T.fit(texts, labels, rounds=4000)
    assert set(np.flatnonzero(model.weights)) <= set(ratio)
    # at the least penalised loss the gradient vanishes; w is the weight over the ratio
    w = {c: float(model.weights[c]) / v for c, v in ratio.items()}
    score = [1 / (1 + math.exp(-(model.bias + sum(w[c] * ratio[c] for c in x if c in ratio)))) for x in columns]
    assert all(abs(model.score(np.array(x, np.int64)) - p) < 1e-4 for x, p in zip(columns, score))
    error = [p - y for p, y in zip(score, labels)]
    assert abs(sum(error)) < 1e-2
    for c, v in ratio.items():
        assert abs(v * sum(e for e, x in zip(error, columns) if c in x) + w[c]) < 2e-2


def test_toxic_words_are_learned_and_held_out_rows_are_caught(spark):
    rng = random.Random(7)
    plain = ["river", "stone", "walks", "green", "under", "seven", "lights", "paper"]
    bad = ["stupidly", "worthless", "stupid"]
    rows, labels = [], []
    for i in range(400):
        toxic = i % 5 == 0
        words = rng.choices(plain, k=40)
        if toxic:
            words[rng.randrange(40)] = rng.choice(bad)
        rows.append((i, " ".join(words)))
        labels.append((i, int(toxic)))
    rows += [(900, None), (901, ""), (None, "river stupid"), (1, rows[1][1]), (902, "river " * 30_000)]
    labels += [(1, 0), (None, 1), (950, None)]
    docs, marks = frame(spark, rows, "doc_id bigint, text string"), frame(spark, labels, "doc_id bigint, toxic int")
    got = T.toxicity(docs, marks).collect()
    assert len(got) == len(rows)
    by = {r["doc_id"]: r for r in got}
    held = [i for i in range(400) if zlib.crc32(str(i).encode()) % 4 == 2]
    assert all(by[i]["held_out"] for i in held)
    assert np.mean([by[i]["predicted"] == (i % 5 == 0) for i in held]) > 0.97
    assert by[900]["score"] == by[901]["score"] and by[900]["predicted"] == 0 and not by[902]["predicted"] and by[None]["predicted"] == 1
    kept = T.drop_toxic(docs.withColumn("score", docs["doc_id"]), marks)
    assert kept.columns == ["doc_id", "text", "score"] and kept.count() == sum(r["predicted"] == 0 for r in got)
    assert T.toxicity(docs.limit(0), marks).collect() == []
    assert {r["predicted"] for r in T.toxicity(docs, marks.limit(0)).collect()} == {0}


def test_features_do_not_depend_on_the_batch():
    rng = random.Random(3)
    texts = [" ".join("".join(rng.choices("abcé", k=rng.randint(1, 6))) for _ in range(rng.randint(0, 20))).encode() for _ in range(60)]
    together = T.Features().of_texts(texts)
    alone = [T.Features(2).of_texts([t])[0] for t in texts]
    assert all(np.array_equal(a, b) for a, b in zip(together, alone, strict=True))


def test_fit_samples_are_the_same_for_any_order_of_rows_and_take_long_texts(spark):
    from quire.llm import langid, toxicity

    words = {"aa": "uno dos tres casa perro", "bb": "one two three house dog"}
    rows = [(i, " ".join((words[lang] + " ").split() * (30 if i % 3 else 9000)), lang) for i in range(60) for lang in (["aa", "bb"][i % 2],)]
    rows += [(5, "repeated id with another text", "bb")]
    docs = frame(spark, rows, "doc_id bigint, text string, lang string")
    labels = frame(spark, [(i, int(i % 2)) for i in range(60)] + [(5, 0)], "doc_id bigint, toxic int")
    seen = []
    for df in (docs, docs.orderBy("text").repartition(5)):
        learn = toxicity.learnable()
        texts, y, _ = toxicity.training_rows(df, labels, learn, "doc_id", "text", "toxic", 20)
        crf = langid.train(df, langid.bucket_of(df["doc_id"], 5) != 0, sample=10)
        seen.append((texts, y, crf.weights.tobytes() if hasattr(crf, "weights") else crf.transitions.tobytes()))
    assert seen[0] == seen[1]
    assert any(len(t) > 100_000 for t in seen[0][0]) and max(map(len, seen[0][0])) <= toxicity.SAMPLE_CHARS


def test_a_worker_keeps_what_one_operator_remembers_only():
    from quire.llm.common import keep_nothing

    first = T.features()
    assert T.features() is first
    e = P.encoder(PATH)
    assert P.encoder(PATH) is e and T.features() is not first
    keep_nothing()
    assert P.encoder(PATH) is not e


def test_a_kept_text_goes_to_python_once(spark):
    from quire.llm.common import map_texts

    docs = frame(spark, [(1, "a b"), (2, None), (3, "")], "doc_id bigint, text string")
    got = map_texts(docs, ["doc_id", "text"], "text", "n int", lambda: lambda texts: {"n": [-1 if t is None else len(t) for t in texts]})
    assert sorted(map(tuple, got.collect())) == [(1, "a b", 3), (2, None, -1), (3, "", 0)]
    assert "__text" not in got._jdf.queryExecution().analyzed().toString()
