import random
from collections import Counter, defaultdict

import duckdb
import pytest

from quire.llm import source_audit as A


def corpus(seed, n=160):
    r = random.Random(seed)
    words = ["".join(r.choice("abcdéß") for _ in range(r.randint(1, 6))) for _ in range(60)] + ["X" * 300, "Zz", "éÉ", "日本"]
    rows = []
    for i in range(n):
        lang, source = r.choice(["en", "en", "fr", None]), r.choice(["a", "b", "c", "ü", "", None])
        text = r.choice([" ", "-", "1", "\n"]).join(r.choice(words[: 20 if source == "a" else 64]) for _ in range(r.randint(0, 40)))
        rows.append((i, r.choice([text, text, text, None]), lang, source))
    return [*rows, (500, "one two", "xx", "s1"), (501, None, "xx", "s2"), (502, "words", "alone", "s1"), (503, None, None, None), (503, None, None, None)]


def brute(rows, min_docs=10):
    docs, counts, groups = defaultdict(Counter), Counter(), set()
    for _, text, lang, source in rows:
        lang, source = lang or "", source or ""
        groups.add((lang, source))
        terms = [t.decode() for t in A.terms_of((text or "").encode())]
        docs[lang].update(set(terms))
        counts.update((lang, source, t) for t in terms)
    out = []
    for lang in {x for x, _ in groups}:
        kept = sorted((t for t, n in docs[lang].items() if n >= min_docs), key=str.encode)
        sources, v = sorted(s for x, s in groups if x == lang), len(kept)
        p = {}
        for s in [*sources, None]:
            c = {t: sum(counts[lang, x, t] for x in sources if s in (x, None)) for t in kept}
            n = sum(c.values())
            p[s] = {t: 1 + 10**9 * (c[t] + 2) // (n + 2 * v) for t in kept}
        f = lambda a, b: (a - b) ** 2 // (a + b)
        for s in sources:
            pairs = [(sum(f(p[s][t], p[o][t]) for t in kept), o) for o in sources if o != s]
            terms = [(f(p[s][t], p[None][t]), t) for t in kept if counts[lang, s, t] and p[s][t] > p[None][t]]
            for part, found, most in (("pair", pairs, None), ("term", terms, 10)):
                found.sort(key=lambda x: (-x[0], x[1].encode()))
                out += [(lang, s, part, item, value, k + 1) for k, (value, item) in enumerate(found[:most])]
    return sorted(out)


@pytest.mark.parametrize("seed", [1, 2])
def test_agrees_with_the_definition(spark, seed, monkeypatch):
    if seed == 2:  # tries are sent often, and cut deep
        for name, value in (("BUFFER", 30), ("TOKENS", 90), ("RANGE", 3), ("BLOCK", 8)):
            monkeypatch.setattr(A, name, value)
    rows = corpus(seed)
    df = spark.createDataFrame([(*r, 7) for r in rows], "doc_id bigint, text string, lang string, source string, value int").repartition(4)
    assert sorted(map(tuple, A.audit_sources(df).collect())) == brute(rows)


def test_sql_agrees(spark, tmp_path):
    rows = [r for r in corpus(3)]
    df = spark.createDataFrame(rows, "doc_id bigint, text string, lang string, source string")
    df.coalesce(1).write.parquet(str(tmp_path / "d"))
    con = duckdb.connect()
    con.execute(f"CREATE VIEW documents AS SELECT * FROM read_parquet('{tmp_path}/d/*.parquet')")
    assert sorted(con.execute(A.AUDIT_SQL).fetchall()) == brute(rows)


def test_empty_table(spark):
    df = spark.createDataFrame([], "doc_id bigint, text string, lang string, source string")
    assert A.audit_sources(df).collect() == []


def test_merged_tries_hold_all_leaves():
    r = random.Random(4)
    want, tries = Counter(), []
    for k in range(6):
        trie = A.RadixTrie()
        for _ in range(200):
            term = bytes(r.choices(b"ab\xc3", k=r.randint(0, 7)))
            trie.add(term, 1, {f"s{k % 3}": 2})
            want[term, f"s{k % 3}"] += 2
        tries.append(trie)
    whole = A.RadixTrie()
    for trie in tries:
        row = A.encode("l", b"", [(c, t, n.docs, n.counts) for c, t, n in trie])
        whole.merge(A.RadixTrie.of_sorted(A.coded(row)))
    leaves = list(whole)
    terms = [t for _, t, _ in leaves]
    assert terms == sorted({t for t, _ in want})
    assert [c for c, _, _ in leaves] == [A._shared(a, b) for a, b in zip([b"", *terms], terms)]
    assert {(t, s): c for _, t, n in leaves for s, c in n.counts.items()} == want


def test_shares_are_exact_beyond_64_bits():
    import numpy as np

    got = A.shares(np.array([0, 10**12, 3 * 10**12]), 5 * 10**12, 7)
    assert got.tolist() == [1 + 10**9 * (c + 2) // (5 * 10**12 + 14) for c in (0, 10**12, 3 * 10**12)]


def test_common_prefixes_of_long_terms():
    terms = sorted({b"a" * k + x for k in (1, 23, 24, 25, 60) for x in (b"", b"b", b"cc")})
    assert A._common_prefixes(terms) == [A._shared(a, b) for a, b in zip([b"", *terms], terms)]
    assert A._common_prefixes([]) == []
