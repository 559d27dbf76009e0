import random

import xxhash

from quire.llm import simhash as S
from quire.llm.components import connected_components
from tests.conftest import frame


def plain(text, width=3):
    words, word = [], b""
    for c in (text or "").encode() + b" ":
        if c == 32 or 9 <= c <= 13:
            words += [word] if word else []
            word = b""
        else:
            word += bytes([c + 32 if 65 <= c <= 90 else c])
    runs = [b" ".join(words[i : i + width]) for i in range(max(1, len(words) - width + 1))] if words else []
    hs = [xxhash.xxh64_intdigest(r, seed=42) for r in runs]
    return sum(1 << b for b in range(64) if 2 * sum(h >> b & 1 for h in hs) > len(hs))


def plain_components(rows):
    fps = [(i, plain(t)) for i, t in rows]
    parent = list(range(len(fps)))

    def find(x):
        while parent[x] != x:
            x = parent[x]
        return x

    for i in range(len(fps)):
        for j in range(i):
            if (fps[i][1] ^ fps[j][1]).bit_count() <= 2:
                parent[find(i)] = find(j)
    least = {}
    for i, (doc, _) in enumerate(fps):
        if doc is not None:
            least[find(i)] = min(doc, least.get(find(i), doc))
    return sorted(((doc, f"{fp:016x}", least.get(find(i))) for i, (doc, fp) in enumerate(fps)), key=str)


def test_masks_cover_every_pair_of_positions():
    masks = S.covering_masks()
    assert len(masks) == 7
    for i in range(64):
        for j in range(64):
            assert any(not (m >> i & 1) and not (m >> j & 1) for m in masks)


def test_components_equal_brute_force(spark):
    rng = random.Random(5)
    vocab = [f"w{i}" for i in range(300)]
    base = [rng.choices(vocab, k=400) for _ in range(6)]
    rows = [(1000 + i, t) for i, t in enumerate([None, "", " \t\n", "ONE", "one", "one two", "Ünï Ünï", "x" * 50_000])]
    for i in range(150):
        words = list(rng.choice(base))
        for _ in range(rng.randint(0, 3)):
            words[rng.randrange(len(words))] = rng.choice(vocab)
        rows.append((i, " ".join(words)))
    rows += [rows[20], rows[21], (None, rows[20][1]), (None, "nobody else says this line here")]
    rng.shuffle(rows)
    got = S.near_duplicates(frame(spark, rows, "doc_id bigint, text string").repartition(5)).collect()
    want = plain_components(rows)
    assert sorted(((r["doc_id"], r["fingerprint"], r["component_id"]) for r in got), key=str) == want
    assert len({c for _, _, c in want}) < len(rows) - 60  # there was something to link


def test_links_find_all_pairs_in_a_crowded_bucket(spark):
    rng = random.Random(1)
    center = rng.getrandbits(64)
    fps = {center ^ (1 << a) ^ (1 << b) for a in range(0, 64, 3) for b in range(0, 64, 5)} | {rng.getrandbits(64) for _ in range(50)}
    df = frame(spark, [(S.signed(f),) for f in fps], "fp bigint")
    edges = S.links(df)
    roots = {r["node"]: r["root"] for r in connected_components(edges).collect()}
    fps = sorted(map(S.signed, fps))
    parent = {f: f for f in fps}

    def find(x):
        while parent[x] != x:
            x = parent[x]
        return x

    for i, a in enumerate(fps):
        for b in fps[:i]:
            if ((a ^ b) & (2**64 - 1)).bit_count() <= 2:
                parent[max(find(a), find(b))] = min(find(a), find(b))
    assert all(roots.get(f, f) == find(f) for f in fps)


def test_components_of_a_long_chain(spark):
    edges = frame(spark, [(i, i + 1) for i in range(200)] + [(500, 501), (501, 500), (7, 7), (None, 1)], "a bigint, b bigint")
    got = {r["node"]: r["root"] for r in connected_components(edges).collect()}
    assert got == {i: 0 for i in range(1, 201)} | {501: 500}


def test_empty_table(spark):
    assert S.near_duplicates(frame(spark, [], "doc_id bigint, text string")).collect() == []


def test_near_copies_go_and_others_stay(spark):
    rng = random.Random(9)
    vocab = [f"word{i}" for i in range(2000)]
    texts = [" ".join(rng.choices(vocab, k=300)) for _ in range(12)]
    rows = [(i, t, "x") for i, t in enumerate(texts)]
    edited = texts[0].split()
    edited[100] = "changed"
    rows += [(100, texts[0], "x"), (101, " ".join(edited), "x"), (102, texts[1] + " tail", "x"), (None, texts[2], "x"), (3, texts[3], "x"), (200, None, "x"), (201, "", "x")]
    out = S.drop_near_duplicates(frame(spark, rows, "doc_id bigint, text string, t string"))
    assert out.columns == ["doc_id", "text", "t"]
    assert sorted(r["doc_id"] for r in out.collect()) == [*range(12), 200]
    assert S.similarity(S.shingle_set(texts[0].encode()), S.shingle_set(" ".join(edited).encode())) >= 0.8


def test_near_copy_groups_under_a_dissimilar_hub_are_found(spark):
    rng = random.Random(3)
    fresh = iter(range(10**6))

    def words(n):
        return [f"u{next(fresh)}" for _ in range(n)]

    shared = words(100)  # every text is half boilerplate: none is near another for it alone
    rows, groups = [], 40
    for g in range(groups):
        body = words(100)
        for k in range(2):
            own = list(body)
            own[rng.randrange(100)] = f"edit{k}"
            rows.append((2 * g + k, " ".join(shared + own)))
    rows += [(1000 + k, " ".join(shared + words(100))) for k in range(20)]
    got = sorted(r["doc_id"] for r in S.drop_near_duplicates(frame(spark, rows, "doc_id bigint, text string")).collect())
    assert got == [2 * g for g in range(groups)] + [1000 + k for k in range(20)]


def test_replaced_stretches_equal_brute_force_jaccard(spark):
    rng = random.Random(21)
    vocab = [f"v{i}" for i in range(5000)]
    rows = []
    for g in range(40):
        base = rng.choices(vocab, k=400)
        rows.append((3 * g, base))
        stretch = list(base)
        k, at = rng.choice([16, 32, 36, 60]), rng.randrange(300)
        stretch[at : at + k] = rng.choices(vocab, k=k)
        rows.append((3 * g + 1, stretch))
        spread = list(base)
        for i in rng.sample(range(400), rng.choice([6, 8, 12])):
            spread[i] = rng.choice(vocab)
        rows.append((3 * g + 2, spread))
    sets = [{tuple(w[i : i + 5]) for i in range(len(w) - 4)} for _, w in rows]
    root = list(range(len(rows)))
    for i in range(len(rows)):
        for j in range(i):
            if root[i] != root[j] and len(sets[i] & sets[j]) >= 0.8 * len(sets[i] | sets[j]):
                root = [min(root[i], root[j]) if r in (root[i], root[j]) else r for r in root]
    want = sorted({rows[r][0] for r in root})
    assert 45 < len(want) < 110  # both kinds of pairs are there
    got = sorted(r["doc_id"] for r in S.drop_near_duplicates(frame(spark, [(i, " ".join(w)) for i, w in rows], "doc_id bigint, text string")).collect())
    assert got == want


def test_crowded_buckets_are_divided_and_lose_no_group(spark, monkeypatch):
    monkeypatch.setattr(S, "CROWDED", 2)
    rng = random.Random(13)
    fresh = iter(range(10**6))
    words = lambda n: [f"u{next(fresh)}" for _ in range(n)]
    shared, rows = words(150), []  # three quarters are boilerplate, so that texts that aren't near share bands
    for g in range(12):
        body = words(50)
        for k in range(2):
            own = list(body)
            own[rng.randrange(50)] = f"edit{k}"
            rows.append((2 * g + k, " ".join(shared + own)))
    got = sorted(r["doc_id"] for r in S.drop_near_duplicates(frame(spark, rows, "doc_id bigint, text string")).collect())
    assert got == [2 * g for g in range(12)]


def test_pairs_that_share_one_crowded_band_alone_are_found(spark, monkeypatch):
    monkeypatch.setattr(S, "CROWDED", 0)  # every bucket with two groups is crowded, those of single shingles too
    monkeypatch.setattr(S, "BLOCK", 3, raising=False)
    rng = random.Random(17)
    fresh = iter(range(10**6))
    words = lambda n: [f"u{next(fresh)}" for _ in range(n)]
    shared, texts = words(255), []  # texts of different groups have a similarity of about 0.73
    for _ in range(6):
        base = shared + words(45)
        for k in range(2):
            own = list(base)
            at = rng.randrange(10, 200)
            own[at : at + 12] = words(12)
            texts.append(" ".join(own).encode())
    sets = [S.shingle_set(t) for t in texts]
    want = {(i, j) for i in range(len(texts)) for j in range(i) if S.similarity(sets[i], sets[j]) >= 0.8}
    assert want == {(2 * g + 1, 2 * g) for g in range(6)}
    width = 7 + S.BANDS
    keys = [[1000 * i + k for k in range(width - 1)] + [-1] for i in range(len(texts))]
    name = lambda i: bytes([i])
    signed = frame(spark, [(name(i), len(s) // 8, k) for i, (s, k) in enumerate(zip(sets, keys, strict=True))], "t binary, size int, keys array<bigint>")
    edges = S.near_edges(signed, frame(spark, [(name(i), t.decode()) for i, t in enumerate(texts)], "t binary, text string")).collect()
    assert {(max(r["a"][0], r["b"][0]), min(r["a"][0], r["b"][0])) for r in edges} == want


def test_clashing_columns_empty_tables_and_long_texts(spark):
    schema = "doc_id bigint, text string, t int, h int, id int, n int, s string, keys int, least int"
    assert S.drop_near_duplicates(frame(spark, [], schema)).collect() == []
    long = " ".join(f"w{i}" for i in range(60_000))
    rows = [(i, x, 1, 2, 3, 4, "s", 5, 6) for i, x in ((2, long), (1, long + " end"), (3, "x" * 300_000), (4, None), (5, "  "), (4, None))]
    got = S.drop_near_duplicates(frame(spark, rows, schema))
    assert got.columns == [c.split()[0] for c in schema.split(", ")]
    assert sorted(tuple(r)[:1] + tuple(r)[2:] for r in got.collect()) == [(i, 1, 2, 3, 4, "s", 5, 6) for i in (1, 3, 4)]
