"""Phrases of words that stand together far oftener than by chance, from position bitmaps.

A shard is a stretch of the documents of one language as word numbers by position; between pieces is a
position without a word. Per shard, a phrase is a bitmap of the positions where it ends, compressed to
the bytes that have a bit set. A phrase is extended by shifting its bitmap by one position, carrying
over into the next byte, and AND with the bitmaps of the phrases, equally long, that end one word
later; the popcount is its count in the shard. Counts are summed over shards, and only phrases whose sum
reaches the limit are extended further: a phrase of L words is the overlap of two of L-1 words, so
their numbers name it exactly.

The limit holds for sums over all shards, so all go one word deeper at a time; inside a shard the
extension goes down a range of positions at a time, whose bitmaps alone are held.
"""

from __future__ import annotations

import zlib
from array import array
from collections import defaultdict
from collections.abc import Iterator

import numpy as np
import pyarrow as pa
from pyspark import TaskContext
from pyspark.sql import DataFrame, Window
from pyspark.sql import functions as F

from quire.llm.common import cut_lineage, discard, materialise

MIN_COUNT, WORDS, TOP = 100, 5, 2000
#: Positions of a shard, and bytes of bitmaps that are joined at a time.
SHARD, TILES = 1_000_000, 1 << 13
#: Counts of a shard that are held before they are summed, as long as they are more than the sums.
SUMMED = 500_000
#: Counted phrases that meet in one bucket, about.
BUCKET = 1_000_000

NONE = np.uint32(0xFFFFFFFF)
_FOLD = bytes.maketrans(b".,;:!?\x0a\x0b\x0c\x0d\x09" + bytes(range(65, 91)), b"\n" * 10 + b" " + bytes(range(97, 123)))


def pieces_of(text: bytes | None) -> list[bytes]:
    """Lower-cased words in order, with ``\\n`` between pieces."""
    return list(filter(None, (text or b"").translate(_FOLD).replace(b"\n", b" \n ").split(b" ")))


def packed(at: np.ndarray) -> bytes:
    """Ascending positions as a bit each."""
    bits = np.zeros(int(at[-1]) + 1 if len(at) else 0, bool)
    bits[at] = True
    return np.packbits(bits).tobytes()


def unpacked(bits: bytes) -> np.ndarray:
    return np.flatnonzero(np.unpackbits(np.frombuffer(bits, np.uint8))).astype(np.uint32)


class _Numbers(dict):
    def __missing__(self, word: bytes) -> int:
        self[word] = n = len(self)
        return n


# ---------------------------------------------------------------- bitmaps


def bitmaps(at: np.ndarray, ends: np.ndarray) -> tuple[np.ndarray, np.ndarray, np.ndarray]:
    """(byte, phrase, mask) of the bytes that have a bit set, by byte; ``ends`` has the phrase that ends at each position ``at``."""
    key = (at.astype(np.uint64) >> np.uint64(3) << np.uint64(32)) | ends.astype(np.uint64)
    order = np.argsort(key, kind="stable")
    key = key[order]
    heads = np.flatnonzero(np.append(True, key[1:] != key[:-1])) if len(key) else np.zeros(0, np.int64)
    bit = np.left_shift(np.uint8(1), (at & 7).astype(np.uint8))[order]
    mask = np.bitwise_or.reduceat(bit, heads) if len(heads) else bit
    key = key[heads]
    return (key >> np.uint64(32)).astype(np.int64), (key & np.uint64(NONE)).astype(np.uint32), mask


def extend(at: np.ndarray, ends: np.ndarray) -> tuple[np.ndarray, np.ndarray]:
    """(phrase << 32 | phrase one word later, count) of all extensions of a shard, ascending."""
    byte, phrase, mask = bitmaps(at, ends)
    size = int(byte[-1]) + 2 if len(byte) else 0
    first = np.concatenate(([0], np.cumsum(np.bincount(byte, minlength=size)))) if size else np.zeros(1, np.int64)
    keys, counts = [], []
    for a in range(0, size, TILES):
        mine = slice(*first[[a, min(a + TILES, size)]])
        for step, moved in ((0, mask[mine] << np.uint8(1)), (1, mask[mine] >> np.uint8(7))):
            some = np.flatnonzero(moved)
            there = byte[mine][some] + step
            width = first[there + 1] - first[there]
            left = np.repeat(some, width)
            right = np.arange(len(left)) + np.repeat(first[there] - np.cumsum(width) + width, width)
            both = moved[left] & mask[right]
            hit = np.flatnonzero(both)
            keys.append(phrase[mine][left[hit]].astype(np.uint64) << np.uint64(32) | phrase[right[hit]].astype(np.uint64))
            counts.append(np.bitwise_count(both[hit]).astype(np.int64))
        if sum(map(len, keys[1:])) > max(SUMMED, len(keys[0])):
            keys, counts = ([x] for x in _sum(np.concatenate(keys), np.concatenate(counts)))
    return _sum(np.concatenate(keys), np.concatenate(counts)) if keys else (np.zeros(0, np.uint64), np.zeros(0, np.int64))


def _sum(keys: np.ndarray, counts: np.ndarray) -> tuple[np.ndarray, np.ndarray]:
    order = np.argsort(keys, kind="stable")
    keys = keys[order]
    heads = np.flatnonzero(np.append(True, keys[1:] != keys[:-1])) if len(keys) else np.zeros(0, np.int64)
    return keys[heads], np.add.reduceat(counts[order], heads) if len(heads) else counts


def next_ends(at: np.ndarray, ends: np.ndarray, keys: np.ndarray, numbers: np.ndarray) -> tuple[np.ndarray, np.ndarray]:
    """Where the phrases end that ``keys`` (ascending) name, and their ``numbers``."""
    places, found = [np.zeros(0, np.uint32)], [np.zeros(0, np.uint32)]
    both = np.flatnonzero(at[1:] == at[:-1] + 1) + 1 if len(keys) and len(at) > 1 else np.zeros(0, np.int64)
    for a in range(0, len(both), SUMMED):
        here = both[a : a + SUMMED]
        key = ends[here - 1].astype(np.uint64) << np.uint64(32) | ends[here].astype(np.uint64)
        place = np.minimum(np.searchsorted(keys, key), len(keys) - 1)
        hit = keys[place] == key
        places.append(at[here[hit]])
        found.append(numbers[place[hit]])
    return np.concatenate(places), np.concatenate(found)


# ---------------------------------------------------------------- rows


_KINDS = {"shard": pa.int64(), "lang": pa.string(), "bucket": pa.int64(), "n": pa.int64(), "words": pa.list_(pa.binary())}


def _batch(**columns) -> pa.RecordBatch:
    return pa.RecordBatch.from_arrays([pa.array(v, _KINDS.get(k, pa.binary())) for k, v in columns.items()], names=list(columns))


def _rows(batches: Iterator[pa.RecordBatch]) -> Iterator[dict]:
    for batch in batches:
        for i in range(batch.num_rows):
            yield batch.slice(i, 1).to_pylist()[0]


def _shards(batches: Iterator[pa.RecordBatch]) -> Iterator[pa.RecordBatch]:
    """Texts to shards: ``n`` word occurrences, the different words with their counts, and word numbers by position (0: none)."""
    number = TaskContext.get().partitionId() << 24
    words: dict[str, _Numbers] = {}
    positions: dict[str, array] = {}

    def shard(lang: str) -> pa.RecordBatch:
        nonlocal number
        number += 1
        at, known = np.frombuffer(positions.pop(lang), np.uint32), list(words.pop(lang))
        counts = np.bincount(at, minlength=len(known)).astype(np.int64)
        return _batch(shard=[number], lang=[lang], n=[int(counts[1:].sum())], words=[known[1:]], counts=[counts[1:].tobytes()], at=[at.tobytes()])

    for batch in batches:
        for lang, text in zip(batch.column(0).to_pylist(), batch.column(1)):
            if lang not in words:
                words[lang], positions[lang] = _Numbers({b"\n": 0}), array("I", [0])
            positions[lang].extend(map(words[lang].__getitem__, pieces_of(text.as_py())))
            positions[lang].append(0)
            if len(positions[lang]) >= SHARD:
                yield shard(lang)
    for lang in list(words):
        yield shard(lang)


def _count_words(buckets: int):
    def run(batches):
        for row in _rows(batches):
            counts, split = np.frombuffer(row["counts"], np.int64), defaultdict(list)
            for i, w in enumerate(row["words"]):
                split[zlib.crc32(w) % buckets].append(i)
            keys = list(split)
            idx = [np.array(split[b], np.uint32) for b in keys]
            yield _batch(
                lang=[row["lang"]] * len(keys),
                bucket=keys,
                shard=[row["shard"]] * len(keys),
                words=[[row["words"][i] for i in split[b]] for b in keys],
                idx=[i.tobytes() for i in idx],
                counts=[counts[i].tobytes() for i in idx],
            )

    return run


def _count_phrases(buckets: int):
    """Buckets are ranges of a hash that is one to one, so a key's bucket follows from the key."""
    shift = np.uint64(64 - (buckets - 1).bit_length())

    def run(batches):
        for row in _rows(batches):
            keys, counts = extend(unpacked(row["at"]), np.frombuffer(row["ends"], np.uint32))
            bucket = ((keys ^ keys >> np.uint64(29)) * np.uint64(0x9E3779B97F4A7C15) >> shift).astype(np.int64)
            order = np.argsort(bucket, kind="stable")
            cuts = np.flatnonzero(np.append(True, np.diff(bucket[order]) != 0)) if len(order) else np.zeros(0, np.int64)
            parts = np.split(order, cuts[1:]) if len(cuts) else []
            if parts:
                yield _batch(bucket=[int(bucket[p[0]]) for p in parts], shard=[row["shard"]] * len(parts), keys=[keys[p].tobytes() for p in parts], counts=[counts[p].astype(np.uint32).tobytes() for p in parts])

    return run


def _frequent_words(least: int):
    """For a bucket: a row of the words that occur often enough, and per shard the place of each of them there and here."""

    def merge(table: pa.Table) -> pa.Table:
        rows = table.to_pylist()
        total: dict[bytes, int] = defaultdict(int)
        for r in rows:
            for w, n in zip(r["words"], np.frombuffer(r["counts"], np.int64).tolist()):
                total[w] += n
        often = sorted(w for w, n in total.items() if n >= least)
        rank = {w: i for i, w in enumerate(often)}
        out = {"lang": [rows[0]["lang"]], "bucket": [rows[0]["bucket"]], "shard": [None], "words": [often], "keys": [None], "counts": [np.array([total[w] for w in often], np.int64).tobytes()]}
        for r in rows:
            here = [i for i, w in enumerate(r["words"]) if w in rank]
            if here:
                for k, v in (("lang", r["lang"]), ("bucket", r["bucket"]), ("shard", r["shard"]), ("words", None)):
                    out[k].append(v)
                out["keys"].append(np.frombuffer(r["idx"], np.uint32)[here].astype(np.uint64).tobytes())
                out["counts"].append(np.array([rank[r["words"][i]] for i in here], np.uint32).tobytes())
        return pa.Table.from_batches([_batch(**out)])

    return merge


def _frequent_phrases(least: int):
    def merge(table: pa.Table) -> pa.Table:
        rows = table.to_pylist()
        keys = [np.frombuffer(r["keys"], np.uint64) for r in rows]
        every, total = _sum(np.concatenate(keys), np.concatenate([np.frombuffer(r["counts"], np.uint32).astype(np.int64) for r in rows]))
        often = every[total >= least]
        out = {"bucket": [rows[0]["bucket"]], "shard": [None], "keys": [often.tobytes()], "counts": [total[total >= least].tobytes()]}
        for r, mine in zip(rows, keys):
            place = np.minimum(np.searchsorted(often, mine), max(0, len(often) - 1))
            hit = often[place] == mine if len(often) else np.zeros(len(mine), bool)
            if hit.any():
                for k, v in (("bucket", r["bucket"]), ("shard", r["shard"]), ("keys", mine[hit].tobytes()), ("counts", place[hit].astype(np.uint32).tobytes())):
                    out[k].append(v)
        return pa.Table.from_batches([_batch(**out)])

    return merge


def _start_of(found: DataFrame, by: list[str]) -> dict[tuple, int]:
    """The number of the first phrase of every bucket; the driver gets one row for each."""
    starts, n = {}, 0
    for r in sorted(found.where("shard is null").select(*by, (F.octet_length("counts") / 8).cast("bigint").alias("n")).collect()):
        starts[tuple(r[k] for k in by)] = n
        n += r["n"]
    if n >= int(NONE):
        raise ValueError(f"{n} frequent phrases of one length; their numbers have 32 bits")
    return starts


def _replies(found: DataFrame, *more: str) -> DataFrame:
    return found.where("shard is not null").groupBy("shard").agg(F.collect_list(F.struct(*more, "bucket", "keys", "counts")).alias("replies"))


def _numbered(row: dict, starts: dict[tuple, int], *by: str) -> tuple[np.ndarray, np.ndarray]:
    """A shard's frequent keys, ascending, and their numbers."""
    keys = np.concatenate([np.frombuffer(r["keys"], np.uint64) for r in row["replies"]])
    numbers = np.concatenate([np.frombuffer(r["counts"], np.uint32).astype(np.int64) + starts[tuple(r[k] for k in by)] for r in row["replies"]])
    order = np.argsort(keys)
    return keys[order], numbers[order].astype(np.uint32)


# ---------------------------------------------------------------- Spark


def frequent_phrases(docs: DataFrame, min_count: int = MIN_COUNT, max_words: int = WORDS) -> tuple[DataFrame, DataFrame]:
    """(phrases, totals). Phrases of 1 to ``max_words`` words with ``min_count`` or more occurrences: ``size``, ``id``, ``lang``, ``words``, ``f``,
    the counts of their beginnings (``heads``) and ends (``tails``) by length, and the ids ``a`` and ``b`` of what is left without the last and the first word.
    Totals: ``lang`` and ``n``, all word occurrences.

    ``docs``: ``lang`` and ``text`` (binary).
    """
    shards = materialise(docs.select("lang", "text").mapInArrow(_shards, "shard bigint, lang string, n bigint, words array<binary>, counts binary, at binary"), "zstd")
    totals = cut_lineage(shards.groupBy("lang").agg(F.sum("n").alias("n")))
    all_words = totals.agg(F.sum("n")).first()[0] or 0
    buckets = 1 << max(6, (all_words // BUCKET).bit_length())

    counted = shards.select("shard", "lang", "words", "counts").mapInArrow(_count_words(buckets), "lang string, bucket bigint, shard bigint, words array<binary>, idx binary, counts binary")
    found = materialise(counted.groupBy("lang", "bucket").applyInArrow(_frequent_words(min_count), "lang string, bucket bigint, shard bigint, words array<binary>, keys binary, counts binary"))
    starts = _start_of(found, ["lang", "bucket"])

    def word_ends(batches):
        for row in _rows(batches):
            words = np.frombuffer(row["at"], np.uint32)
            keys, numbers = _numbered(row, starts, "lang", "bucket")
            ids = np.full(int(words.max(initial=0)) + 1, NONE)
            ids[keys.astype(np.int64) + 1] = numbers
            at = np.flatnonzero(ids[words] != NONE)
            yield _batch(shard=[row["shard"]], at=[packed(at)], ends=[ids[words[at]].tobytes()])

    def word_rows(batches):
        for row in _rows(batches):
            first, n = starts[row["lang"], row["bucket"]], np.frombuffer(row["counts"], np.int64)
            yield pa.RecordBatch.from_arrays([pa.array(np.arange(first, first + len(n))), pa.array([row["lang"]] * len(n), pa.string()), pa.array([w.decode() for w in row["words"]], pa.string()), pa.array(n)], names=["id", "lang", "word", "f"])

    counts_none = F.array().cast("array<bigint>")
    words = found.where("shard is null").select("lang", "bucket", "words", "counts").mapInArrow(word_rows, "id bigint, lang string, word string, f bigint")
    level = materialise(words.select(F.lit(1).alias("size"), "id", "lang", F.array("word").alias("words"), "f", counts_none.alias("heads"), counts_none.alias("tails"), F.lit(None).cast("bigint").alias("a"), F.lit(None).cast("bigint").alias("b")))
    state = shards.select("shard", "at").join(_replies(found, "lang"), "shard").mapInArrow(word_ends, "shard bigint, at binary, ends binary")
    levels, used = [level], (shards, found)
    for size in range(2, max_words + 1):
        state = materialise(state, "zstd")
        discard(*used)
        counted = state.mapInArrow(_count_phrases(buckets), "bucket bigint, shard bigint, keys binary, counts binary")
        found = materialise(counted.groupBy("bucket").applyInArrow(_frequent_phrases(min_count), "bucket bigint, shard bigint, keys binary, counts binary"))
        starts = _start_of(found, ["bucket"])
        level = materialise(_name(found, starts, levels[-1], size))
        levels.append(level)
        used = (state, found)
        state = state.join(_replies(found), "shard").mapInArrow(_next_state(starts), "shard bigint, at binary, ends binary")
    discard(*used)
    every = levels[0]
    for level in levels[1:]:
        every = every.unionByName(level)
    return every, totals


def _next_state(starts: dict[tuple, int]):
    def run(batches):
        for row in _rows(batches):
            at, ends = next_ends(unpacked(row["at"]), np.frombuffer(row["ends"], np.uint32), *_numbered(row, starts, "bucket"))
            yield _batch(shard=[row["shard"]], at=[packed(at)], ends=[ends.tobytes()])

    return run


def _name(found: DataFrame, starts: dict[tuple, int], shorter: DataFrame, size: int) -> DataFrame:
    """The frequent phrases of ``size`` words from those that are one word shorter."""

    def run(batches):
        for row in _rows(batches):
            first, keys = starts[(row["bucket"],)], np.frombuffer(row["keys"], np.uint64)
            a, b = (keys >> np.uint64(32)).astype(np.int64), (keys & np.uint64(NONE)).astype(np.int64)
            yield pa.RecordBatch.from_arrays([pa.array(x) for x in (np.arange(first, first + len(keys)), a, b, np.frombuffer(row["counts"], np.int64))], names=["id", "a", "b", "f"])

    rows = found.where("shard is null").select("bucket", "keys", "counts").mapInArrow(run, "id bigint, a bigint, b bigint, f bigint")
    part = lambda k: shorter.select(F.col("id").alias(k), F.col("lang").alias(f"lang_{k}"), F.col("words").alias(f"words_{k}"), F.col("f").alias(f"f_{k}"), F.col("heads" if k == "a" else "tails").alias(f"more_{k}"))
    met = rows.join(part("a"), "a").join(part("b"), "b")
    return met.select(
        F.lit(size).alias("size"),
        "id",
        F.col("lang_a").alias("lang"),
        F.concat("words_a", F.slice("words_b", -1, 1)).alias("words"),
        "f",
        F.concat("more_a", F.array("f_a")).alias("heads"),
        F.concat("more_b", F.array("f_b")).alias("tails"),
        "a",
        "b",
    )


def lowest_cut(a: int, n: int, heads: list[int], tails: list[int]) -> tuple[int, int, int]:
    """(score, l, r) of the cut that scores lowest, the first of equals; whole numbers of any size."""
    size = len(heads) + 1
    cuts = ((heads[k - 1], tails[size - k - 1]) for k in range(1, size))
    score, _, l, r = min((1000 * a * n // (l * r), k, l, r) for k, (l, r) in enumerate(cuts, 1))
    return score, l, r


def mine_phrases(docs: DataFrame, lang_col: str = "lang", text_col: str = "text", min_count: int = MIN_COUNT, max_words: int = WORDS, top: int = TOP) -> DataFrame:
    """``lang``, ``rank``, ``phrase``, ``a``, ``l``, ``r``, ``n``, ``score``: every language's ``top`` phrases by score, count and bytes.

    Words are what blanks and tabs part, A-Z lower-cased, in pieces that ``.,;:!?`` and line ends part;
    a phrase lies in one piece. ``a``: its count, overlaps included; ``l``, ``r``: the counts of both parts
    of its lowest-scoring cut; ``n``: the words of the language. A phrase that has no occurrence outside
    some longer one is left out. Null texts are empty and a null language is ``und``. Repeated rows count
    as often as they come; other columns are ignored; an empty table gives no rows.
    """
    text = docs.select(F.coalesce(F.col(f"`{lang_col}`").cast("string"), F.lit("und")).alias("lang"), F.col(f"`{text_col}`").cast("string").cast("binary").alias("text"))
    phrases, totals = frequent_phrases(text, min_count, max_words)
    longer = phrases.where("size > 2")
    inside = [longer.where(F.col("f") == F.element_at(c, -1)).select((F.col("size") - 1).alias("size"), F.col(k).alias("id")) for c, k in (("heads", "a"), ("tails", "b"))]
    left = phrases.where("size > 1").join(inside[0].unionByName(inside[1]), ["size", "id"], "left_anti").join(totals, "lang")

    def score(batches):
        for batch in batches:
            rows = batch.to_pylist()
            cuts = [lowest_cut(r["f"], r["n"], r["heads"], r["tails"]) for r in rows]
            columns = {"lang": [r["lang"] for r in rows], "phrase": [" ".join(r["words"]) for r in rows], "a": [r["f"] for r in rows], "n": [r["n"] for r in rows]}
            columns |= {k: [c[i] for c in cuts] for i, k in enumerate(("score", "l", "r"))}
            kinds = {"lang": pa.string(), "phrase": pa.string()}
            yield pa.RecordBatch.from_arrays([pa.array(v, kinds.get(k, pa.int64())) for k, v in columns.items()], names=list(columns))

    scored = left.select("lang", "words", "f", "n", "heads", "tails").mapInArrow(score, "lang string, phrase string, a bigint, n bigint, score bigint, l bigint, r bigint")
    rank = F.row_number().over(Window.partitionBy("lang").orderBy(F.desc("score"), F.desc("a"), "phrase"))
    return scored.withColumn("rank", rank).where(F.col("rank") <= top).select("lang", F.col("rank").cast("bigint").alias("rank"), "phrase", "a", "l", "r", "n", "score")


PHRASES_SQL = r"""
WITH d AS (SELECT coalesce(lang, 'und') AS lang, translate(coalesce(text, ''), 'ABCDEFGHIJKLMNOPQRSTUVWXYZ', 'abcdefghijklmnopqrstuvwxyz') AS t FROM documents),
p AS (SELECT lang, unnest(regexp_extract_all(t, '[^.,;:!?\x0A-\x0D]+')) AS piece FROM d),
w AS (SELECT lang, regexp_extract_all(piece, '[^\x20\x09]+') AS w FROM p),
n AS (SELECT lang, CAST(sum(len(w)) AS HUGEINT) AS n FROM w GROUP BY lang),
g AS (SELECT lang, k, w[i:i + k - 1] AS g FROM (SELECT lang, w, k, unnest(range(1, len(w) - k + 2)) AS i FROM w, range(1, 6) AS s(k) WHERE len(w) >= k)),
f AS (SELECT lang, k, g, CAST(count(*) AS HUGEINT) AS f FROM g GROUP BY ALL HAVING count(*) >= 100),
c AS (SELECT a.lang, a.k, a.g, a.f AS a, cut, l.f AS l, r.f AS r, n.n, (1000 * a.f * n.n) // (l.f * r.f) AS score
      FROM (SELECT *, unnest(range(1, k)) AS cut FROM f WHERE k > 1) a
      JOIN f l ON l.lang = a.lang AND l.g = a.g[1:cut] JOIN f r ON r.lang = a.lang AND r.g = a.g[cut + 1:a.k] JOIN n ON n.lang = a.lang),
b AS (SELECT * FROM (SELECT *, row_number() OVER (PARTITION BY lang, g ORDER BY score, cut) AS x FROM c) WHERE x = 1),
inner_ AS (SELECT DISTINCT lang, g[i:i + m - 1] AS g, f FROM (SELECT lang, g, f, m, k, unnest(range(1, k - m + 2)) AS i FROM f, range(2, 5) AS s(m) WHERE k > m)),
o AS (SELECT b.* FROM b WHERE NOT EXISTS (SELECT 1 FROM inner_ i WHERE i.lang = b.lang AND i.g = b.g AND 100 * i.f >= 100 * b.a))
SELECT lang, rank, phrase, CAST(a AS BIGINT) AS a, CAST(l AS BIGINT) AS l, CAST(r AS BIGINT) AS r, CAST(n AS BIGINT) AS n, CAST(score AS BIGINT) AS score
FROM (SELECT *, row_number() OVER (PARTITION BY lang ORDER BY score DESC, a DESC, encode(phrase)) AS rank FROM (SELECT *, array_to_string(g, ' ') AS phrase FROM o)) WHERE rank <= 2000
"""
