import math
import random
import re
import zlib

import numpy as np
import pytest

from quire.llm import decontaminate as D
from quire.llm import license_scan as L
from quire.llm import ogg as O
from quire.llm import secrets as X
from tests.conftest import frame

# decontamination -------------------------------------------------------------------------------


def plain_words(text):
    low = "".join(chr(ord(c) + 32) if "A" <= c <= "Z" else c for c in text or "")
    return re.findall(r"[^\x00-\x2F\x3A-\x60\x7B-\x7F]+", low)


def plain_hits(text, items, window=10):
    words, hit, found = plain_words(text), set(), set()
    for name, item in items:
        ws = plain_words(item)
        m = min(window, len(ws))
        for i in range(len(ws) - m + 1 if m else 0):
            for j in range(len(words) - m + 1):
                if words[j : j + m] == ws[i : i + m]:
                    hit |= set(range(j, j + m))
                    found.add(name)
    return len(words), len(hit), sorted(str(f) for f in found if f is not None)


@pytest.mark.parametrize("shard_bytes", [D.SHARD_BYTES, 60])
def test_hits_equal_brute_force(spark, shard_bytes):
    rng = random.Random(2)
    vocab = ["a", "B", "cé", "d1", "e"]
    items = [(i, " ".join(rng.choices(vocab, k=rng.choice([3, 11, 12])))) for i in range(8)] + [(20, None), (21, "..."), (22, "e"), (None, "z y x w v u t s r q p")]
    docs = [(i, ", ".join(rng.choices(vocab, k=rng.randint(0, 60)))) for i in range(40)]
    docs += [(100, None), (101, ""), (102, "A " + items[1][1] + "! " + items[1][1]), (102, "A"), (None, items[2][1]), (103, "Z y x w v u t s r q p " * 50)]
    got = D.decontaminate(frame(spark, docs, "doc_id bigint, text string"), frame(spark, items, "item_id bigint, text string"), shard_bytes=shard_bytes).collect()
    want = sorted(((i, *plain_hits(t, items)) for i, t in docs), key=str)
    assert sorted(((r["doc_id"], r["n_words"], r["n_hit"], r["items"]) for r in got), key=str) == want
    assert all(r["contaminated"] == (r["n_hit"] > 0) and r["n_items"] == len(r["items"]) for r in got)


def test_no_items_and_no_documents(spark):
    docs, none = frame(spark, [(1, "a b")], "doc_id bigint, text string"), frame(spark, [], "item_id bigint, text string")
    assert [(r["n_words"], r["contaminated"]) for r in D.decontaminate(docs, none).collect()] == [(2, False)]
    assert D.decontaminate(docs.limit(0), frame(spark, [(1, "a")], "item_id bigint, text string")).collect() == []


def test_contaminated_rows_go_and_columns_stay(spark):
    docs = frame(spark, [(1, "one two three", 7, "x"), (2, "four", 8, "y")], "doc_id bigint, text string, hits int, n_words string")
    out = D.drop_contaminated(docs, frame(spark, [(1, "two three")], "item_id bigint, text string"))
    assert out.columns == docs.columns and [tuple(r) for r in out.collect()] == [(2, "four", 8, "y")]


# licences --------------------------------------------------------------------------------------


def plain_scan(text):
    words = plain_words(text)
    places, base = [], set()
    for phrase, label in L.PHRASES:
        p = phrase.split()
        at = [i for i in range(len(words) - len(p) + 1) if words[i : i + len(p)] == p]
        places += at
        base |= {label} if at else set()
    found = {}
    for start in range(0, max(1, len(words) - L.BLOCK // 2), L.BLOCK // 2):
        block = set(words[start : start + L.BLOCK])
        for label, template in L.TEMPLATES:
            tokens = set(template.split())
            part = len(block & tokens) / len(tokens)
            if len(block & tokens) >= L.THRESHOLD * len(tokens) - 1e-9:
                found[label] = max(part, found.get(label, 0))
    score = 1.0 if places else max(found.values(), default=0.0)
    return len(words), len(places), min(places, default=None), max(places, default=None), ",".join(sorted(base)), ",".join(sorted(base | set(found))), score


def test_license_scan_equals_brute_force(spark):
    rng = random.Random(4)
    filler = ["lorem", "ipsum", "the", "of", "license", "copy", "dolor", "über"]

    def pad(k):
        return " ".join(rng.choices(filler, k=k))

    texts = [None, "", "...", "CC BY cc-by, cc  by", "all rights reserved All Rights Reserved", "General public license", "x" * 5000]
    for _, template in L.TEMPLATES:
        words = template.split()
        texts += [pad(rng.randint(0, 150)) + ". " + template.upper() + "; " + pad(40), pad(20) + " " + " ".join(words[1:]) + " " + pad(200), pad(50) + "\n" + "\n".join(words)]
    rows = [(i, t) for i, t in enumerate(texts)] + [(3, texts[3]), (None, texts[4])]
    got = L.scan_licenses(frame(spark, rows, "doc_id bigint, text string")).collect()
    names = ("n_words", "n_base", "first_word", "last_word", "base_labels", "labels", "score")
    assert sorted(((r["doc_id"], *(r[n] for n in names)) for r in got), key=str) == sorted(((i, *plain_scan(t)) for i, t in rows), key=str)
    assert L.scan_licenses(frame(spark, [], "doc_id bigint, text string")).collect() == []


# secrets ---------------------------------------------------------------------------------------


def plain_base(text):
    found = []
    for k, (kind, pattern, group, least) in enumerate(X.BASE):
        found += [(m.start(), k, m.end(), kind) for m in re.finditer(pattern, text or "") if len(m[group]) >= least]
    return [(s, e, kind) for s, _, e, kind in sorted(found)]


def test_base_spans_equal_the_patterns():
    rng = random.Random(8)
    parts = ["secret=token", "token: abcdef", "PASSWORD='hunter22'", "api_key=ab", "ApiKey:=x.y-z_/+=1", "AKIA", "AKIA" + "A1" * 9, "AKIAAKIA" + "0" * 15, "deadbeef" * 3, "0" * 23, "é", " ", "\n", "ſecret=abcdefg", "toKen=longenough"]
    for _ in range(3000):
        text = "".join(rng.choices(parts, k=rng.randint(1, 6)))
        assert X.base_spans(text) == plain_base(text), text


def test_random_keys_are_found_and_words_are_not(spark):
    rng = random.Random(6)
    alnum = "ABCDEFGHIJKLMNOPQRSTUVWXYZabcdefghijklmnopqrstuvwxyz0123456789"
    keys = ["".join(rng.choices(alnum, k=48)) for _ in range(60)]
    text = ["the quick brown fox jumps over the lazy dog and runs away", "internationalization-of-the-standard-2019-edition", "aaaaaaaaaaaaaaaa1111", "12345678901234567890", "example_variable_name_with_number_1"]
    rows = [(i, f"é key {k} end") for i, k in enumerate(keys)] + [(1000 + i, text[i % len(text)]) for i in range(200)] + [(5000, None), (5001, ""), (None, keys[0])]
    got = {r["doc_id"]: r for r in X.find_secrets(frame(spark, rows, "doc_id bigint, text string")).collect()}
    hits = [i for i in range(60) if any((s["start"], s["end"]) == (6, 54) for s in got[i]["spans"])]
    assert len(hits) >= 54
    assert not [i for i in got if i is not None and i >= 1000 and got[i]["spans"]]
    assert X.find_secrets(frame(spark, [], "doc_id bigint, text string")).collect() == []


def benjamini_hochberg(ps, q):
    """The definition: how many of the least chances are kept."""
    ps = sorted(ps)
    return max((k + 1 for k, p in enumerate(ps) if p <= q * (k + 1) / len(ps)), default=0)


def test_few_keys_among_very_many_runs_are_kept():
    # sf tables hold few runs, so the counts are given: a band of a million tested runs, or of 10^8, and ten keys
    for tested in (10**6, 10**8):
        counts = np.zeros(X.BINS + 1)
        keys = [X.bin_of(X.judge(k)[1]) for k in ("q7Rk2ZpX9vLm4TsW8yBn", "Zx81kQw0PvN5rT3mY7uJ", "9fK2Lm8Qw3Xz7Vb1Nc6R", "T4yU8iO2pA6sD0fG3hJ9", "mN5bV1cX7zL3kJ9hG2fD")] * 2
        for k in keys:
            counts[max(k, 150)] += 1
        counts[:30] = tested / 10 ** (np.arange(30) / 10) / 5  # text: as rare as its chance says
        least = X.least_bin(tested, counts, X.Q)
        assert 30 <= least <= 150 and counts[least:].sum() == 10


def test_the_step_equals_its_definition_and_bounds_false_discoveries():
    rng = np.random.default_rng(11)
    shares = []
    for _ in range(150):
        log_p = np.concatenate([np.log(rng.random(4000)), -rng.uniform(9, 90, rng.integers(0, 60))])
        bins = np.array([X.bin_of(v) for v in log_p])
        least = X.least_bin(len(bins), np.bincount(bins, minlength=X.BINS + 1), 0.05)
        assert (bins >= least).sum() == benjamini_hochberg(10.0 ** (-bins / 10), 0.05)
        shares.append((bins[:4000] >= least).sum() / max(1, (bins >= least).sum()))
    assert np.mean(shares) <= 0.05 + 2 * np.std(shares) / len(shares) ** 0.5  # the step holds the mean share of false ones


def test_chances_far_below_a_double_have_an_order():
    assert X.fisher([1e-300] * 3) < X.fisher([1e-300] * 2) < X.fisher([1e-200]) < math.log(1e-199)
    assert X.bin_of(-1e9) == X.BINS and X.bin_of(0.0) == 0 and X.bin_of(math.log(1e-30)) in (299, 300)


def test_recall_and_false_discoveries_by_encoding(spark):
    rng = random.Random(16)
    letters = "ABCDEFGHIJKLMNOPQRSTUVWXYZabcdefghijklmnopqrstuvwxyz"
    alphabets = {"letters": letters, "hexupper": "0123456789ABCDEF", "base32": "ABCDEFGHIJKLMNOPQRSTUVWXYZ234567", "base64": letters + "0123456789+/"}
    shares = [8.2, 1.5, 2.8, 4.3, 12.7, 2.2, 2.0, 6.1, 7.0, 0.2, 0.8, 4.0, 2.4, 6.7, 7.5, 1.9, 0.1, 6.0, 6.3, 9.1, 2.8, 1.0, 2.4, 0.2, 2.0, 0.1]
    prose = ["".join(rng.choices(letters[26:], shares, k=rng.choice([18, 26, 40, 60]))) for _ in range(3000)]
    keys = [(name, "".join(rng.choices(a, k=n))) for name, a in alphabets.items() for n in (48, 64) for _ in range(40)]
    rows = [(i, f"is {k} so") for i, (_, k) in enumerate(keys)] + [(10_000 + i, f"is {w} so") for i, w in enumerate(prose)]
    got = {r["doc_id"]: {(s["start"], s["end"]) for s in r["spans"]} for r in X.find_secrets(frame(spark, rows, "doc_id bigint, text string")).collect()}
    for name in alphabets:
        own = [(3, 3 + len(k)) in got[i] for i, (n, k) in enumerate(keys) if n == name]
        assert sum(own) >= 0.9 * len(own), (name, sum(own))
    false = sum(bool(got[10_000 + i]) for i in range(len(prose)))
    assert false <= 0.05 * len(keys), false


# Ogg -------------------------------------------------------------------------------------------


def slow_crc(data):
    crc = 0
    for byte in data:
        crc ^= byte << 24
        for _ in range(8):
            crc = (crc << 1 ^ (0x04C11DB7 if crc & 0x80000000 else 0)) & 0xFFFFFFFF
    return crc


def test_page_checksum_is_bitwise_right():
    rng = random.Random(3)
    for n in (0, 1, 2, 27, 300):
        data = rng.randbytes(n)
        assert O.page_crc(data) == slow_crc(data)


@pytest.mark.parametrize("n", [64, 4096, 4160, 65_024, 65_088, 300_032])
def test_ogg_round_trip(n):
    payload = random.Random(n).randbytes(n)
    got = O.load(O.store(payload))
    assert got["payload"] == payload and got["marks_ok"] and got["streams"] == 2 and not got["bad_pages"]
    assert got["end_ms"] == n * 1000 // O.RATE


def test_packets_that_span_pages():
    w = O.StreamWriter(9)
    big = random.Random(1).randbytes(200_000)
    data = w.packet(b"head", 0) + w.packet(big, 77) + w.packet(b"", 78) + w.packet(b"x" * 255, 79) + w.flush(last=True)
    s = O.parse(data)[9]
    assert s.packets == [b"head", big, b"", b"x" * 255] and s.ended and s.pages >= 4 and not s.gaps


def test_damaged_pages_are_skipped_and_counted():
    data = bytearray(O.store(b"abc" * 50_000))
    at = data.find(b"OggS", 70_000)
    data[at + 400] ^= 1
    streams = O.parse(bytes(data))
    assert sum(s.bad_pages for s in streams.values()) == 1
    assert O.load(bytes(data))["payload"] != b"abc" * 50_000
    assert O.parse(b"") == {} and O.parse(b"noise OggS") == {}


def test_media_digests(spark):
    rows = [(1, "short"), (2, None), (3, ""), (4, "é" * 70_000), (5, "short"), (None, "x"), (1, "short")]
    got = sorted(O.media_digests(frame(spark, rows, "doc_id bigint, text string")).collect(), key=lambda r: str(r["doc_id"]))
    by = {r["doc_id"]: r for r in got}
    assert len(got) == 7 and by[1][1:] == by[5][1:] and by[2][1:] == by[3][1:]
    assert by[2]["payload_bytes"] == 64 and by[2]["n_bytes"] == 0 and by[2]["tail_crc32"] == zlib.crc32(bytes(64))
    assert by[4]["n_bytes"] == 140_000 and by[4]["payload_bytes"] == 140_032 and "bad=0" in by[4]["feature"]
    assert O.media_digests(frame(spark, [], "doc_id bigint, text string")).collect() == []
    packets = O.read_ogg(O.to_ogg(frame(spark, rows, "doc_id bigint, text string"), ["doc_id"]), ["doc_id"])
    assert packets.where("doc_id = 4 and serial = 1 and packet_no > 0").count() == -(-140_032 // O.PACKET)


def test_a_damaged_page_opens_no_stream_and_clocks_are_the_files_own(spark):
    data = bytearray(O.store(O.payload_of(b"some text " * 40), rate=100))
    at = data.index(b"OggS", 4)
    data[at + 14 : at + 18] = (4711).to_bytes(4, "little")  # the serial of the marks' first page
    streams = O.parse(bytes(data))
    assert 4711 not in streams and streams.bad_pages == 1 and O.load(bytes(data))["bad_pages"] == 1
    df = frame(spark, [(1, bytes(O.store(O.payload_of(b"x" * 200), rate=100))), (2, b"none"), (3, None)], "id int, media binary")
    rows = O.read_ogg(df, ["id"]).where("granule is not null").collect()
    assert rows and all(r["id"] == 1 and r["ms"] == r["granule"] * 10 for r in rows)
    assert O.rates(O.Streams({5: O.Stream(packets=[b"foreign"])})) == {5: None}
