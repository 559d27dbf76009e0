import random
import re
from collections import Counter, defaultdict

import duckdb
import numpy as np
import pytest

from quire.llm import phrases as P


def corpus(seed, n=120):
    r = random.Random(seed)
    words = [*"abcdefgh", "É", "日本", "the", "of", "OF", "a\x00b"]
    weights = [9, 8, 7, 5, 4, 3, 2, 1, 3, 2, 9, 8, 2, 1]
    fixed = ["the end of a", "of the of the of", "X x x x x", "rare pair"]
    rows = []
    for i in range(n):
        parts = [" ".join(r.choices(words, weights, k=r.randint(0, 12))) for _ in range(r.randint(0, 4))] + r.choices(fixed, k=r.randint(0, 2))
        r.shuffle(parts)
        text = "".join(p + r.choice([". ", ",", "\n", " ", "\t \t", ";;", "\x0b", "! "]) for p in parts)
        rows.append((i, r.choice([text] * 6 + [None]), r.choice(["en", "en", "fr", None])))
    return [*rows, (900, "", "xx"), (901, None, "yy")]


def brute(rows, least, top, longest=5):
    n, f = Counter(), defaultdict(Counter)
    for _, text, lang in rows:
        lang = "und" if lang is None else lang
        folded = (text or "").encode().lower() if (text or "").isascii() else "".join(chr(ord(c) + 32) if "A" <= c <= "Z" else c for c in text or "").encode()
        for piece in re.split(rb"[.,;:!?\x0A-\x0D]", folded):
            words = tuple(re.findall(rb"[^\x20\x09]+", piece))
            n[lang] += len(words)
            f[lang].update(words[i : i + k] for k in range(1, longest + 1) for i in range(len(words) - k + 1))
    out = []
    for lang, counts in f.items():
        found = [g for g, a in counts.items() if len(g) > 1 and a >= least]
        inside = {(g[i : i + k], counts[g]) for g in found for k in range(2, len(g)) for i in range(len(g) - k + 1)}
        rows = []
        for g in found:
            a = counts[g]
            if (g, a) not in inside:
                score, _, l, r = min((1000 * a * n[lang] // (counts[g[:k]] * counts[g[k:]]), k, counts[g[:k]], counts[g[k:]]) for k in range(1, len(g)))
                rows.append((-score, -a, b" ".join(g), l, r))
        out += [(lang, k + 1, g.decode(), -a, l, r, n[lang], -score) for k, (score, a, g, l, r) in enumerate(sorted(rows)[:top])]
    return sorted(out)


@pytest.mark.parametrize(("seed", "least", "top"), [(1, 5, 2000), (2, 12, 7)])
def test_agrees_with_the_definition(spark, seed, least, top, monkeypatch):
    if seed == 2:  # many shards, and bitmaps in many ranges
        monkeypatch.setattr(P, "SHARD", 90)
        monkeypatch.setattr(P, "TILES", 3)
        monkeypatch.setattr(P, "SUMMED", 5)
    rows = corpus(seed)
    df = spark.createDataFrame([(*r, 1, "x") for r in rows], "doc_id bigint, text string, lang string, rank int, words string").repartition(3)
    assert sorted(map(tuple, P.mine_phrases(df, min_count=least, top=top).collect())) == brute(rows, least, top)


def test_sql_agrees(spark, tmp_path):
    rows = corpus(3, n=900)
    spark.createDataFrame(rows, "doc_id bigint, text string, lang string").coalesce(1).write.parquet(str(tmp_path / "d"))
    con = duckdb.connect()
    con.execute(f"CREATE VIEW documents AS SELECT * FROM read_parquet('{tmp_path}/d/*.parquet')")
    want = brute(rows, 100, 2000)
    assert want and sorted(con.execute(P.PHRASES_SQL).fetchall()) == want


def test_empty_table(spark):
    assert P.mine_phrases(spark.createDataFrame([], "doc_id bigint, text string, lang string")).collect() == []


def test_shifted_bitmaps_count_neighbours():
    r = np.random.default_rng(5)
    ends = r.integers(0, 6, 5000).astype(np.uint32)
    ends[r.integers(0, 5000, 900)] = P.NONE
    at = np.flatnonzero(ends != P.NONE).astype(np.uint32)
    keys, counts = P.extend(at, ends[at])
    want = Counter((int(a), int(b)) for a, b in zip(ends, ends[1:]) if P.NONE not in (a, b))
    assert {(int(k) >> 32, int(k) & 0xFFFFFFFF): int(n) for k, n in zip(keys, counts)} == want
    places, found = P.next_ends(at, ends[at], keys[:3], np.array([7, 8, 9], np.uint32))
    named = {int(k): v for k, v in zip(keys[:3], (7, 8, 9))}
    after = {i: named.get((int(ends[i - 1]) << 32) | int(ends[i])) for i in range(1, 5000) if P.NONE not in (ends[i - 1], ends[i])}
    assert dict(zip(places.tolist(), found.tolist())) == {i: v for i, v in after.items() if v}


def test_cuts_beyond_64_bits():
    assert P.lowest_cut(10**15, 10**17, [10**16, 10**15], [10**15, 10**16]) == (1000 * 10**15 * 10**17 // 10**32, 10**16, 10**16)
    assert P.lowest_cut(100, 1000, [200, 100], [100, 200]) == (2500, 200, 200)


def test_positions_as_bits():
    for at in ([], [0], [7, 8, 20], list(range(50))):
        assert P.unpacked(P.packed(np.array(at, np.int64))).tolist() == at
