"""How far the sources of a language differ in their terms, by mergeable radix tries.

Partitions count terms in byte tries whose leaves have a counter per source and the number of
documents. There a trie is an array in preorder: its leaves in byte order, each with the depth at which
it leaves the path of the one before and the bytes from there on. It is cut at prefixes; the tries of a
prefix range become nodes and are merged node by node. What is left, the kept terms, is walked in
UTF-8 order: blocks of terms give sums for every pair of sources, and the candidates of a source in the
order of ties. Before nodes are made, sums of document counts by a hash sort out leaves that can't
reach the least number of documents together.
"""

from __future__ import annotations

from array import array
from collections import defaultdict
from collections.abc import Iterator
from itertools import repeat
from zlib import crc32

import numpy as np
import pyarrow as pa
from pyspark.sql import DataFrame, Window
from pyspark.sql import functions as F

from quire.llm.common import cut_lineage, materialise

MIN_DOCS, TOP, SCALE = 10, 10, 1_000_000_000
#: Different terms, and terms of one language, that a trie is made of at a time.
BUFFER, TOKENS = 400_000, 4_000_000
#: Leading bytes by which a trie is cut; ranges of more leaves are cut deeper.
PREFIX, RANGE = 2, 1_000_000
#: Counters of a block: terms times sources.
BLOCK = 1 << 18

_LETTERS = bytes(c + 32 if 65 <= c <= 90 else c if 97 <= c <= 122 or c >= 128 else 32 for c in range(256))


def terms_of(text: bytes | None) -> list[bytes]:
    """Runs of ASCII letters and bytes beyond ASCII; only A-Z are lower-cased."""
    return (text or b"").translate(_LETTERS).split()


class Node:
    """Bytes on the way here, children by their first byte, and at a leaf the documents and the counts by source."""

    __slots__ = ("label", "children", "docs", "counts")

    def __init__(self, label: bytes, docs: int = 0, counts: dict | None = None):
        self.label, self.children, self.docs, self.counts = label, {}, docs, counts


class RadixTrie:
    """Byte strings with a document count and a counter per source; tries of disjoint documents can be merged."""

    def __init__(self):
        self.root = Node(b"")

    @classmethod
    def of_sorted(cls, leaves: Iterator[tuple[int, bytes, int, dict]]) -> RadixTrie:
        """From ascending leaves as (bytes in common with the one before, the rest, documents, counts): no byte is compared."""
        trie = cls()
        path, depths = [trie.root], [0]
        for common, rest, docs, counts in leaves:
            while depths[-1] > common:
                node = path.pop()
                depths.pop()
                if depths[-1] < common:
                    path.append(_split(path[-1], node, common - depths[-1]))
                    depths.append(common)
            if rest:
                node = Node(rest, docs, counts)
                path[-1].children[rest[0]] = node
                path.append(node)
                depths.append(common + len(rest))
            else:
                path[-1].docs, path[-1].counts = docs, counts
        return trie

    def add(self, term: bytes, docs: int, counts: dict) -> None:
        """Add to the leaf of ``term``, which is made if it isn't there; ``counts`` may be kept."""
        node, rest = self.root, term
        while rest:
            child = node.children.get(rest[0])
            if child is None:
                node.children[rest[0]] = Node(rest, docs, counts)
                return
            label = child.label
            if rest.startswith(label):
                node, rest = child, rest[len(label) :]
            else:
                n = _shared(label, rest)
                node, rest = _split(node, child, n), rest[n:]
        if node.counts is None:
            node.docs, node.counts = docs, counts
        else:
            node.docs += docs
            _add_counts(node.counts, counts)

    def merge(self, other: RadixTrie) -> None:
        """Take in another trie, whose nodes may become part of this one."""
        waiting = [(self.root, other.root)]
        while waiting:
            mine, theirs = waiting.pop()
            if theirs.counts is not None:
                if mine.counts is None:
                    mine.docs, mine.counts = theirs.docs, theirs.counts
                else:
                    mine.docs += theirs.docs
                    _add_counts(mine.counts, theirs.counts)
            for first, b in theirs.children.items():
                a = mine.children.get(first)
                if a is None:
                    mine.children[first] = b
                    continue
                if a.label != b.label:
                    n = _shared(a.label, b.label)
                    if n < len(a.label):
                        a = _split(mine, a, n)
                    if n < len(b.label):
                        b.label, upper = b.label[n:], Node(b.label[:n])
                        upper.children[b.label[0]] = b
                        b = upper
                waiting.append((a, b))

    def __iter__(self) -> Iterator[tuple[int, bytes, Node]]:
        """(bytes in common with the leaf before, bytes, leaf) in byte order, which is the order of their UTF-8 texts."""
        waiting, common = [(self.root, b"")], 0
        while waiting:
            node, path = waiting.pop()
            common = min(common, len(path))
            path += node.label
            if node.counts is not None:
                yield common, path, node
                common = len(path)
            if node.children:
                waiting += [(node.children[b], path) for b in sorted(node.children, reverse=True)]


def _shared(a: bytes, b: bytes) -> int:
    n = 0
    for x, y in zip(a, b):
        if x != y:
            break
        n += 1
    return n


def _split(parent: Node, child: Node, n: int) -> Node:
    """A node for the first ``n`` bytes of the child's label, between it and its parent."""
    upper = Node(child.label[:n])
    child.label = child.label[n:]
    upper.children[child.label[0]] = child
    parent.children[upper.label[0]] = upper
    return upper


def _add_counts(into: dict, counts: dict) -> None:
    for source, n in counts.items():
        into[source] = into.get(source, 0) + n


# ---------------------------------------------------------------- rows


#: A cut trie: leaves in byte order as prefix in common with the one before, length of the rest, the rest; documents, sources of each leaf, then their numbers in ``sources`` and counts; ``check`` has a hash of each leaf.
TRIE = "lang string, prefix binary, n bigint, check binary, common binary, size binary, rest binary, docs binary, width binary, source binary, count binary, sources array<string>"
_KINDS = {"lang": pa.string(), "n": pa.int64(), "sources": pa.list_(pa.string()), "sums": pa.list_(pa.int64())}


def _batch(rows: list[dict]) -> pa.RecordBatch:
    return pa.RecordBatch.from_arrays([pa.array([r[k] for r in rows], _KINDS.get(k, pa.binary())) for k in rows[0]], names=list(rows[0]))


def encode(lang: str, prefix: bytes, leaves: list[tuple[int, bytes, int, dict]]) -> dict:
    """A row of ``TRIE`` for leaves in byte order: (bytes in common with the one before, bytes, documents, counts)."""
    common = [c for c, *_ in leaves]
    common[:1] = [0] * len(common[:1])
    rest = [term[c:] for c, (_, term, _, _) in zip(common, leaves)]
    numbers: dict[str, int] = {}
    source = [numbers.setdefault(s, len(numbers)) for *_, counts in leaves for s in counts]
    u4, i8 = (lambda x: np.array(x, np.uint32).tobytes()), (lambda x: np.array(x, np.int64).tobytes())
    out = {"lang": lang, "prefix": prefix, "n": len(leaves), "check": u4([crc32(term) for _, term, _, _ in leaves]), "common": u4(common), "size": u4(list(map(len, rest))), "rest": b"".join(rest), "docs": i8([d for _, _, d, _ in leaves])}
    return out | {"width": u4([len(c) for *_, c in leaves]), "source": u4(source), "count": i8([n for *_, c in leaves for n in c.values()]), "sources": list(numbers)}


def coded(row: dict, wanted: list[bool] | None = None) -> Iterator[tuple[int, bytes, int, dict | None]]:
    """(bytes in common with the leaf before, the rest, documents, counts) of a row; no counts for leaves that aren't wanted."""
    common, size, width, source = (np.frombuffer(row[k], np.uint32).tolist() for k in ("common", "size", "width", "source"))
    docs, count = (np.frombuffer(row[k], np.int64).tolist() for k in ("docs", "count"))
    names, rest, at, place = row["sources"], row["rest"], 0, 0
    for keep, n, d, w, want in zip(common, size, docs, width, wanted or repeat(True)):
        yield keep, rest[at : at + n], d, {names[source[i]]: count[i] for i in range(place, place + w)} if want else None
        at += n
        place += w


def decode(row: dict) -> Iterator[tuple[int, bytes, int, dict]]:
    """As ``coded``, with the whole bytes."""
    last = b""
    for keep, rest, docs, counts in coded(row):
        last = last[:keep] + rest
        yield keep, last, docs, counts


def _ranges(lang: str, leaves: Iterator[tuple[int, bytes, int, dict]], depth: int) -> Iterator[dict]:
    """Rows of leaves with the same first ``depth`` bytes."""
    prefix, held = None, []
    for leaf in leaves:
        if leaf[1][:depth] != prefix:
            if held:
                yield encode(lang, prefix, held)
            prefix, held = leaf[1][:depth], []
        held.append(leaf)
    if held:
        yield encode(lang, prefix, held)


def _in_batches(rows: Iterator[dict], size: int = 64) -> Iterator[pa.RecordBatch]:
    held: list[dict] = []
    for row in rows:
        held.append(row)
        if len(held) == size:
            yield _batch(held)
            held = []
    if held:
        yield _batch(held)


def _rows(batches: Iterator[pa.RecordBatch]) -> Iterator[dict]:
    for batch in batches:
        for i in range(batch.num_rows):
            yield batch.slice(i, 1).to_pylist()[0]


class _Numbers(dict):
    def __missing__(self, key):
        self[key] = n = len(self)
        return n


class _Texts:
    """Texts of one language until they go into its trie: term numbers in order, and the length and source of every text."""

    def __init__(self):
        self.terms, self.sources, self.ids, self.sizes, self.source = _Numbers(), _Numbers(), array("I"), [], []

    def add(self, source: str, terms: list[bytes]) -> None:
        self.ids.extend(map(self.terms.__getitem__, terms))
        self.sizes.append(len(terms))
        self.source.append(self.sources[source])

    def ranges(self, lang: str) -> Iterator[dict]:
        """The trie of the texts in rows of ``TRIE``, cut where the first ``PREFIX`` bytes change."""
        terms = sorted(self.terms)
        if not terms:
            return
        ids, sizes, names = np.frombuffer(self.ids, np.uint32).astype(np.int64), np.array(self.sizes), list(self.sources)
        pairs, count = np.unique(ids * len(names) + np.repeat(np.array(self.source, np.int64), sizes), return_counts=True)
        docs = np.bincount(np.unique(ids * len(sizes) + np.repeat(np.arange(len(sizes)), sizes)) // len(sizes), minlength=len(terms))
        order = np.fromiter(map(self.terms.__getitem__, terms), np.int64, len(terms))
        ends = np.searchsorted(pairs // len(names), np.arange(len(terms) + 1))
        width = np.diff(ends)[order]
        at = np.repeat(ends[order] - np.cumsum(width) + width, width) + np.arange(len(pairs))
        source, count = pairs[at] % len(names), count[at]

        common, size = np.array(_common_prefixes(terms), np.int64), np.fromiter(map(len, terms), np.int64, len(terms))
        first = np.flatnonzero(common < PREFIX)
        common[first] = 0
        text = np.frombuffer(b"".join(terms), np.uint8)
        depth = np.arange(len(text)) - np.repeat(np.cumsum(size) - size, size)
        rest = text[depth >= np.repeat(common, size)]
        size -= common
        check = np.fromiter(map(crc32, terms), np.uint32, len(terms))
        bytes_at, pair_at = (np.concatenate(([0], np.cumsum(x))) for x in (size, width))
        for a, b in zip(first.tolist(), [*first[1:].tolist(), len(terms)]):
            out = {"lang": lang, "prefix": terms[a][:PREFIX], "n": b - a, "check": check[a:b].tobytes()}
            out |= {k: x[a:b].astype(np.uint32).tobytes() for k, x in (("common", common), ("size", size))} | {"rest": rest[bytes_at[a] : bytes_at[b]].tobytes()}
            out |= {"docs": docs[order[a:b]].astype(np.int64).tobytes(), "width": width[a:b].astype(np.uint32).tobytes()}
            mine = slice(pair_at[a], pair_at[b])
            yield out | {"source": source[mine].astype(np.uint32).tobytes(), "count": count[mine].astype(np.int64).tobytes(), "sources": names}


def _common_prefixes(terms: list[bytes], width: int = 24) -> list[int]:
    """How many bytes each of ascending terms, none of which has a byte 0, has in common with the one before."""
    if not terms:
        return []
    heads = np.array(terms, f"S{width}").view(np.uint8).reshape(len(terms), width)
    same = (heads[1:] == heads[:-1]) & (heads[1:] != 0)
    common = [0, *np.where(same.all(axis=1), width, same.argmin(axis=1)).tolist()]
    for i in np.flatnonzero(same.all(axis=1)) + 1:
        common[i] = _shared(terms[i - 1], terms[i])
    return common


def _count(batches: Iterator[pa.RecordBatch]) -> Iterator[pa.RecordBatch]:
    """Tries of a partition, cut at prefixes."""
    texts: dict[str, _Texts] = defaultdict(_Texts)

    def send():
        for lang in list(texts):
            yield from texts.pop(lang).ranges(lang)

    def run():
        held = 0
        for batch in batches:
            langs, sources = batch.column(0).to_pylist(), batch.column(1).to_pylist()
            for i in range(batch.num_rows):
                here = texts[langs[i]]
                held -= len(here.terms)
                here.add(sources[i], terms_of(batch.column(2)[i].as_py()))
                held += len(here.terms)
                if held >= BUFFER or len(here.ids) >= TOKENS:
                    held = 0
                    yield from send()
        yield from send()

    return _in_batches(run())


def _hopeful(rows: list[dict], min_docs: int) -> Iterator[Iterator[tuple[int, bytes, int, dict]]]:
    """The leaves of every row, as ``coded``, without those whose hash doesn't reach ``min_docs`` in all rows together."""
    checks = [np.frombuffer(r["check"], np.uint32) for r in rows]
    _, number = np.unique(np.concatenate(checks), return_inverse=True)
    docs = np.bincount(number, weights=np.concatenate([np.frombuffer(r["docs"], np.int64) for r in rows]))
    keep, at = docs[number] >= min_docs, 0

    def leaves(row, mine):
        last, common = b"", 0
        for (shared, rest, docs, counts), wanted in zip(coded(row, mine), mine):
            common = min(common, shared)
            last = last[:shared] + rest
            if wanted:
                yield common, last[common:], docs, counts
                common = len(last)

    for row, check in zip(rows, checks):
        mine = keep[at : at + len(check)].tolist()
        at += len(check)
        if any(mine):
            yield leaves(row, mine)


def term_tries(docs: DataFrame, min_docs: int = MIN_DOCS) -> DataFrame:
    """The kept terms of every language as merged tries by prefix range (``TRIE``), with the ``sums`` of the counts by source.

    ``docs``: ``lang``, ``source`` and ``text`` (binary). Two rows with one prefix never are of one language.
    """
    cut = materialise(docs.select("lang", "source", "text").mapInArrow(_count, TRIE))
    large = cut.groupBy("lang", "prefix").agg(F.sum("n").alias("leaves")).where(F.col("leaves") > RANGE)
    depth = F.lit(PREFIX) + F.ceil(F.log(4.0, F.col("leaves") / RANGE)).cast("int")
    deep = cut_lineage(large.select("lang", "prefix", depth.alias("depth")))
    names = [f.split(" ")[0] for f in TRIE.split(", ")]

    def deeper(batches):
        return _in_batches(r for row in _rows(batches) for r in _ranges(row["lang"], decode(row), row["depth"]))

    ranges = cut.join(deep, ["lang", "prefix"], "left_anti").select(*names)
    ranges = ranges.unionByName(cut.join(deep, ["lang", "prefix"]).select(*names, "depth").mapInArrow(deeper, TRIE))

    def merge(table: pa.Table) -> pa.Table:
        trie = RadixTrie()
        for leaves in _hopeful(table.to_pylist(), min_docs):
            trie.merge(RadixTrie.of_sorted(leaves))
        kept, common = [], 0
        for shared, term, node in trie:
            common = min(common, shared)
            if node.docs >= min_docs:
                kept.append((common, term, node.docs, node.counts))
                common = len(term)
        if not kept:
            return pa.Table.from_batches([], schema=_batch([encode("", b"", []) | {"sums": []}]).schema)
        out = encode(table.column("lang")[0].as_py(), table.column("prefix")[0].as_py(), kept)
        sums: dict[str, int] = defaultdict(int)
        for *_, counts in kept:
            _add_counts(sums, counts)
        return pa.Table.from_batches([_batch([out | {"sums": [sums[s] for s in out["sources"]]}])])

    return materialise(ranges.groupBy("lang", "prefix").applyInArrow(merge, f"{TRIE}, sums array<bigint>"))


# ---------------------------------------------------------------- divergence


def shares(count: np.ndarray, n: int, v: int) -> np.ndarray:
    """1 + floor(SCALE * (count + 2) / (n + 2 v)), exact for counts of any size."""
    if count.dtype == object or int(count.max(initial=0)) > (1 << 63) // SCALE - 3 or n + 2 * v >= 1 << 63:
        return np.array([1 + SCALE * (int(c) + 2) // (n + 2 * v) for c in count.ravel()], np.int64).reshape(count.shape)
    return 1 + (SCALE * (count + 2)) // (n + 2 * v)


def _compare(totals: dict[str, tuple[list[str], list[int], int]]):
    """Partial results of a partition of kept terms; ``totals`` by language: sources, their sums, and the number of terms."""

    def run(batches: Iterator[pa.RecordBatch]) -> Iterator[pa.RecordBatch]:
        sums: dict[str, np.ndarray] = {}
        best: dict[tuple[str, int], list[tuple[int, bytes]]] = defaultdict(list)
        for row in _rows(batches):
            names, n, v = totals[row["lang"]]
            number = {s: i for i, s in enumerate(names)}
            if row["lang"] not in sums:
                sums[row["lang"]] = np.zeros((len(names), len(names)), np.int64)
            width = np.frombuffer(row["width"], np.uint32).astype(np.int64)
            source = np.array([number[s] for s in row["sources"]], np.int64)[np.frombuffer(row["source"], np.uint32)]
            count, term = np.frombuffer(row["count"], np.int64), np.repeat(np.arange(len(width)), width)
            texts = [t for _, t, _, _ in decode(row)]
            step = max(1, BLOCK // len(names))
            for a in range(0, len(texts), step):
                b = min(len(texts), a + step)
                mine = slice(*np.searchsorted(term, [a, b]))
                counts = np.zeros((b - a, len(names)), np.int64)
                counts[term[mine] - a, source[mine]] = count[mine]
                p = np.stack([shares(counts[:, i], n[i], v) for i in range(len(names))], 1)
                q = shares(counts.sum(axis=1), sum(n), v)
                for i in range(len(names)):
                    mine_p = p[:, i : i + 1]
                    sums[row["lang"]][i] += ((mine_p - p) ** 2 // (mine_p + p)).sum(axis=0)
                    at = np.flatnonzero((counts[:, i] > 0) & (p[:, i] > q))
                    value = (p[at, i] - q[at]) ** 2 // (p[at, i] + q[at])
                    first = np.argsort(-value, kind="stable")[:TOP]  # the walk is in byte order, so ties are too
                    held = best[row["lang"], i] + [(-int(value[k]), texts[a + int(at[k])]) for k in first]
                    best[row["lang"], i] = sorted(held)[:TOP]
        out = []
        for lang, m in sums.items():
            names = totals[lang][0]
            out += [(lang, names[i], "pair", names[j], int(m[i, j])) for i in range(len(names)) for j in range(len(names)) if i != j]
        out += [(lang, totals[lang][0][i], "term", t.decode("utf-8", "replace"), -value) for (lang, i), held in best.items() for value, t in held]
        for a in range(0, len(out), 10_000):
            columns = zip(*out[a : a + 10_000])
            yield pa.RecordBatch.from_arrays([pa.array(c, k) for c, k in zip(columns, (pa.string(),) * 4 + (pa.int64(),))], names=["lang", "source", "part", "item", "value"])

    return run


def audit_sources(docs: DataFrame, lang_col: str = "lang", source_col: str = "source", text_col: str = "text", min_docs: int = MIN_DOCS) -> DataFrame:
    """``lang``, ``source``, ``part``, ``item``, ``value``, ``rank``: every other source of the language with its divergence, and the ten terms that mark the source most.

    Terms are runs of letters and non-ASCII characters, A-Z lower-cased; a language keeps those of
    ``min_docs`` documents. Null texts, languages and sources are empty strings. Groups without a term
    have all their pairs; a language without kept terms has pairs of value 0 and no term rows. Ties go
    by item in UTF-8 order. Repeated rows count as often as they come; other columns are ignored; an
    empty table gives no rows.

    Of all groups, the driver gets a sum each; the result has a row for every pair of a language's groups.
    """
    text = lambda c: F.coalesce(F.col(f"`{c}`").cast("string"), F.lit(""))
    base = docs.select(text(lang_col).alias("lang"), text(source_col).alias("source"), text(text_col).cast("binary").alias("text"))
    groups = cut_lineage(base.groupBy("lang", "source").agg(F.count("*").alias("rows")).select("lang", "source"))
    kept = term_tries(base, min_docs)
    found = kept.select("lang", F.explode(F.arrays_zip("sources", "sums")).alias("x")).groupBy("lang", F.col("x.sources").alias("source")).agg(F.sum("x.sums").alias("n"))
    sized = kept.groupBy("lang").agg(F.sum("n").alias("v"))
    known = groups.join(found, ["lang", "source"], "left").join(sized, "lang").select("lang", "source", F.coalesce("n", F.lit(0)).alias("n"), "v")
    totals: dict[str, tuple[list[str], list[int], int]] = {}
    for r in sorted(known.collect(), key=lambda r: (r["lang"], r["source"])):
        names, n, _ = totals.setdefault(r["lang"], ([], [], r["v"]))
        names.append(r["source"])
        n.append(r["n"])
    parts = cut_lineage(kept.select(*(f.split(" ")[0] for f in TRIE.split(", "))).mapInArrow(_compare(totals), "lang string, source string, part string, item string, value bigint"))
    sums = parts.where("part = 'pair'").groupBy("lang", "source", "item").agg(F.sum("value").alias("value"))
    other = groups.select("lang", F.col("source").alias("item"))
    pairs = groups.join(other, "lang").where(F.col("source") != F.col("item")).join(sums, ["lang", "source", "item"], "left")
    pairs = pairs.select("lang", "source", F.lit("pair").alias("part"), "item", F.coalesce("value", F.lit(0)).alias("value"))
    terms = parts.where("part = 'term'")
    rank = F.row_number().over(Window.partitionBy("lang", "source", "part").orderBy(F.desc("value"), "item"))
    ranked = pairs.unionByName(terms.select(*pairs.columns)).withColumn("rank", rank)
    return ranked.where((F.col("part") == "pair") | (F.col("rank") <= TOP))


AUDIT_SQL = r"""
WITH d AS (SELECT row_number() OVER () AS r, coalesce(lang, '') AS lang, coalesce(source, '') AS source,
    regexp_extract_all(translate(coalesce(text, ''), 'ABCDEFGHIJKLMNOPQRSTUVWXYZ', 'abcdefghijklmnopqrstuvwxyz'), '[^\x00-\x40\x5B-\x60\x7B-\x7F]+') AS w FROM documents),
g AS (SELECT DISTINCT lang, source FROM d),
t AS (SELECT r, lang, source, unnest(w) AS term FROM d),
k AS (SELECT lang, term FROM t GROUP BY lang, term HAVING count(DISTINCT r) >= 10),
v AS (SELECT lang, CAST(count(*) AS HUGEINT) AS v FROM k GROUP BY lang),
c AS (SELECT t.lang, t.source, t.term, CAST(count(*) AS HUGEINT) AS c FROM t JOIN k ON t.lang = k.lang AND t.term = k.term GROUP BY ALL),
n AS (SELECT g.lang, g.source, coalesce(sum(c.c), 0) AS n FROM g LEFT JOIN c ON c.lang = g.lang AND c.source = g.source GROUP BY ALL),
p AS (SELECT n.lang, n.source, k.term, coalesce(c.c, 0) AS c, 1 + (1000000000 * (coalesce(c.c, 0) + 2)) // (n.n + 2 * v.v) AS p
      FROM n JOIN v ON v.lang = n.lang JOIN k ON k.lang = n.lang LEFT JOIN c ON c.lang = n.lang AND c.source = n.source AND c.term = k.term),
q AS (SELECT x.lang, x.term, 1 + (1000000000 * (x.c + 2)) // (y.n + 2 * v.v) AS q FROM (SELECT lang, term, sum(c) AS c FROM p GROUP BY ALL) x
      JOIN (SELECT lang, sum(n) AS n FROM n GROUP BY lang) y ON y.lang = x.lang JOIN v ON v.lang = x.lang),
s AS (SELECT a.lang, a.source, b.source AS item, sum(((a.p - b.p) * (a.p - b.p)) // (a.p + b.p)) AS value
      FROM p a JOIN p b ON a.lang = b.lang AND a.term = b.term AND a.source <> b.source GROUP BY ALL),
pairs AS (SELECT a.lang, a.source, 'pair' AS part, b.source AS item, CAST(coalesce(s.value, 0) AS BIGINT) AS value
      FROM g a JOIN g b ON a.lang = b.lang AND a.source <> b.source LEFT JOIN s ON s.lang = a.lang AND s.source = a.source AND s.item = b.source),
terms AS (SELECT p.lang, p.source, 'term' AS part, p.term AS item, CAST(((p - q) * (p - q)) // (p + q) AS BIGINT) AS value
      FROM p JOIN q ON q.lang = p.lang AND q.term = p.term WHERE p.c > 0 AND p.p > q.q)
SELECT * FROM (SELECT lang, source, part, item, value, CAST(row_number() OVER (PARTITION BY lang, source, part ORDER BY value DESC, encode(item)) AS INTEGER) AS rank
      FROM (SELECT * FROM pairs UNION ALL SELECT * FROM terms)) WHERE part = 'pair' OR rank <= 10
"""
