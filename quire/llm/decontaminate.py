"""Benchmark decontamination by Wu-Manber multi-pattern search over words.

Symbols are words. Patterns are windows of equal length; a block is two consecutive words (one for
one-word patterns). The shift table tells how far the search may jump when a block ends the current
window; a block that ends some pattern has shift 0 and leads, by its hash, to the bucket of patterns
with that suffix, which are compared with the text directly.
"""

from __future__ import annotations

from collections import defaultdict
from functools import reduce

from pyspark import Broadcast
from pyspark.sql import DataFrame
from pyspark.sql import functions as F

from quire.llm.common import cut_lineage, keep_nothing, map_texts

WINDOW = 10
#: Bytes of pattern text that one broadcast may hold; more patterns are searched in several passes. A worker's tables are about a hundred times as large.
SHARD_BYTES = 2 << 20

_FOLD = bytes(c + 32 if 65 <= c <= 90 else c if 48 <= c <= 57 or 97 <= c <= 122 or c >= 128 else 32 for c in range(256))


def words_of(text: bytes | None) -> list[bytes]:
    """ASCII-lower-cased runs of ASCII letters, digits and non-ASCII bytes."""
    return (text or b"").translate(_FOLD).split()


class WuManber:
    """Patterns of one length, in words."""

    def __init__(self, patterns: dict[tuple[bytes, ...], list[int]]):
        self.m = len(next(iter(patterns)))
        self.block = min(2, self.m)
        self.default = self.m - self.block + 1
        self.shift: dict[tuple[bytes, ...], int] = {}
        self.bucket: dict[tuple[bytes, ...], list[tuple[tuple[bytes, ...], list[int]]]] = defaultdict(list)
        for p, owners in patterns.items():
            for end in range(self.block, self.m + 1):
                key = p[end - self.block : end]
                self.shift[key] = min(self.shift.get(key, self.default), self.m - end)
            self.bucket[p[-self.block :]].append((p, owners))

    def search(self, words: list[bytes]) -> list[tuple[int, list[int]]]:
        """(start, owners) of every occurrence, overlapping ones included."""
        found, m, default = [], self.m, self.default
        shift, bucket, n = self.shift.get, self.bucket, len(words)
        end = m
        if self.block == 2:
            while end <= n:
                key = (words[end - 2], words[end - 1])
                jump = shift(key, default)
                if jump:
                    end += jump
                    continue
                text = tuple(words[end - m : end])
                found += [(end - m, owners) for p, owners in bucket[key] if p == text]
                end += 1
        else:
            found = [(i, owners) for i, w in enumerate(words) for _, owners in bucket.get((w,), ())]
        return found


def patterns_of(items: list[tuple[int, bytes | None]], window: int = WINDOW) -> dict[int, dict[tuple[bytes, ...], list[int]]]:
    """By length in words: the windows of every item and the items they come from."""
    out: dict[int, dict[tuple[bytes, ...], list[int]]] = defaultdict(lambda: defaultdict(list))
    for k, text in items:
        words = words_of(text)
        m = min(window, len(words))
        for i in range(len(words) - m + 1 if m else 0):
            owners = out[m][tuple(words[i : i + m])]
            if not owners or owners[-1] != k:
                owners.append(k)
    return {m: dict(p) for m, p in out.items()}


def scan(text: bytes | None, engines: list[WuManber]) -> tuple[int, list[tuple[int, int]], list[int]]:
    """Words, merged hit ranges [from, to) and the items that occur."""
    words = words_of(text)
    spans, items = [], set()
    for e in engines:
        for start, owners in e.search(words):
            spans.append((start, start + e.m))
            items.update(owners)
    merged: list[list[int]] = []
    for s, t in sorted(spans):
        if merged and s <= merged[-1][1]:
            merged[-1][1] = max(t, merged[-1][1])
        else:
            merged.append([s, t])
    return len(words), [tuple(x) for x in merged], sorted(items)


def item_shards(benchmark: DataFrame, item_col: str, text_col: str, shard_bytes: int):
    """Yield lists of (item id as text, UTF-8 text) of at most ``shard_bytes``, or one item, each."""
    shard, size = [], 0
    rows = benchmark.select(F.col(item_col).cast("string"), F.col(text_col).cast("string")).where(F.col(text_col).isNotNull())
    for item, text in rows.toLocalIterator(prefetchPartitions=False):
        raw = text.encode()
        if shard and size + len(raw) > shard_bytes:
            yield shard
            shard, size = [], 0
        shard.append((item, raw))
        size += len(raw)
    yield shard


def find_hits(docs: DataFrame, benchmark: DataFrame, keep: list[str], text_col: str = "text", item_col: str = "item_id", item_text_col: str = "text", window: int = WINDOW, shard_bytes: int = SHARD_BYTES) -> DataFrame:
    """``keep`` and ``hits``: a struct of ``n_words``, ``spans`` (word ranges of occurrences, by start) and ``items`` (sorted as strings).

    The pattern set is broadcast in shards of bounded size. With several, the documents are read once
    for each and the ranges united, with the same result.
    """
    shards = list(map(docs.sparkSession.sparkContext.broadcast, item_shards(benchmark, item_col, item_text_col, shard_bytes)))
    if len(shards) == 1:
        return _scan_shard(docs, shards[0], keep, text_col, window)
    keyed = cut_lineage(docs.select(*dict.fromkeys([*keep, text_col])).withColumn("__row", F.monotonically_increasing_id()))
    scans = [_scan_shard(keyed, shard, ["__row"], text_col, window) for shard in shards]
    whole = (
        reduce(DataFrame.unionByName, scans)
        .groupBy("__row")
        .agg(
            F.struct(
                F.max("hits.n_words").alias("n_words"),
                F.array_sort(F.flatten(F.collect_list("hits.spans"))).alias("spans"),
                F.array_sort(F.array_distinct(F.flatten(F.collect_list("hits.items")))).alias("items"),
            ).alias("hits")
        )
    )
    return keyed.select(*keep, "__row").join(whole, "__row").drop("__row")


def decontaminate(docs: DataFrame, benchmark: DataFrame, id_col: str = "doc_id", text_col: str = "text", **options) -> DataFrame:
    """Per document: ``n_words``, ``n_hit``, ``n_items``, ``items`` (sorted as strings), ``contaminated``.

    A window is ten consecutive item words, or all of a shorter item; document words inside an
    occurrence are hit. Null and wordless texts have no words and are never contaminated; null items
    match nothing; an item without an id marks words but isn't named. Repeated rows come back as
    given, null ids too; an empty table on either side gives no rows or no hits.
    """
    hits = find_hits(docs, benchmark, [id_col], text_col, **options)
    # ranges go by their start: count the words that no earlier range has reached
    hit = F.aggregate(
        "hits.spans",
        F.struct(F.lit(0).cast("bigint").alias("n"), F.lit(0).cast("bigint").alias("end")),
        lambda acc, s: F.struct(
            (acc["n"] + F.greatest(F.lit(0), s["to"] - F.greatest(acc["end"], s["from"]))).alias("n"), F.greatest(acc["end"], s["to"]).alias("end")
        ),
        lambda acc: acc["n"],
    )
    return hits.select(
        id_col,
        "hits.n_words",
        hit.alias("n_hit"),
        F.size("hits.items").cast("bigint").alias("n_items"),
        "hits.items",
        (F.size("hits.spans") > 0).alias("contaminated"),
    )


def drop_contaminated(docs: DataFrame, benchmark: DataFrame, text_col: str = "text", **options) -> DataFrame:
    """The rows of ``docs`` in which no benchmark window occurs, all columns as they were."""
    names = docs.columns
    slots = docs.toDF(*(f"c{i}" for i in range(len(names))))
    clean = find_hits(slots, benchmark, slots.columns, f"c{names.index(text_col)}", **options).where(F.size("hits.spans") == 0)
    return clean.select(*(F.col(f"c{i}").alias(n) for i, n in enumerate(names)))


def _scan_shard(docs: DataFrame, shard: Broadcast, keep: list[str], text_col: str, window: int) -> DataFrame:
    def make():
        keep_nothing()
        ids = [item for item, _ in shard.value]
        engines = [WuManber(p) for _, p in sorted(patterns_of([(i, t) for i, (_, t) in enumerate(shard.value)], window).items())]

        def apply(texts):
            got = [scan(t, engines) for t in texts]
            return {
                "hits": [
                    {"n_words": n, "spans": [{"from": s, "to": t} for s, t in spans], "items": sorted({ids[i] for i in items if ids[i] is not None})}
                    for n, spans, items in got
                ]
            }

        return apply

    return map_texts(docs, keep, text_col, "hits struct<n_words:bigint,spans:array<struct<from:bigint,to:bigint>>,items:array<string>>", make)
