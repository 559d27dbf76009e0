"""SimHash fingerprints, linked by covering locality-sensitive hashing.

A position ``i`` of the 64 bits gets the non-zero vector ``1 + i mod (2^(r+1) - 1)`` of r+1 bits.
Table ``v`` keeps the positions whose vector has an odd overlap with ``v``. Any r positions span
at most r dimensions, so some ``v`` is orthogonal to all of them: in that table the two
fingerprints agree on every kept bit. No pair within the radius is missed.

Inside a bucket no pairs are formed. For radius 2, two fingerprints are linked exactly if some
64-bit centre differs from each of them in one bit at most, and in a bucket only the bits that the
table leaves out can differ. So each member of a shared bucket emits its centres over those bits;
a centre has at most 65 different fingerprints around it, and they form a star.
"""

from __future__ import annotations

import math
from itertools import accumulate

import numpy as np
import pyarrow as pa
import xxhash
from pyspark.sql import Column, DataFrame
from pyspark.sql import functions as F

from quire.llm.common import compact, cut_lineage, in_bitmap, keep_nothing, map_texts, materialise
from quire.llm.components import connected_components

BITS = 64
RADIUS = 2


def signed(x: int) -> int:
    return x - (1 << 64) if x >= 1 << 63 else x


def covering_masks(radius: int = RADIUS) -> list[int]:
    """The bits each table compares, one mask for each non-zero vector of radius + 1 bits."""
    top = (1 << (radius + 1)) - 1
    return [sum(1 << i for i in range(BITS) if ((1 + i % top) & v).bit_count() & 1) for v in range(1, top + 1)]


def majority(hashes: np.ndarray) -> int:
    """Bits set in over half of the 64-bit hashes."""
    bits = np.unpackbits(hashes.view(np.uint8).reshape(-1, 8), axis=1, bitorder="little").sum(axis=0, dtype=np.int64)
    return int(np.packbits(bits * 2 > len(hashes), bitorder="little").view(np.int64)[0])


def shingles(text: bytes, width: int) -> list[bytes]:
    """Space-joined runs of ``width`` ASCII-lower-cased words; all words if there are fewer."""
    words = text.lower().split()
    if len(words) <= width:
        return [b" ".join(words)] if words else []
    joined = b" ".join(words)
    ends = list(accumulate((len(w) + 1 for w in words), initial=0))
    return [joined[s : e - 1] for s, e in zip(ends, ends[width:])]


def fingerprint(text: bytes | None, width: int = 3) -> int:
    """Signed 64-bit fingerprint; 0 for a text without words."""
    runs = shingles(text or b"", width)
    if not runs:
        return 0
    h = xxhash.xxh64_intdigest
    return majority(np.fromiter((h(r, 42) for r in runs), dtype=np.uint64, count=len(runs)))


def fingerprints(docs: DataFrame, id_col: str = "doc_id", text_col: str = "text", width: int = 3) -> DataFrame:
    """``id_col`` and ``fp`` (bigint) for every row; a null text has no words."""

    def make():
        return lambda texts: {"fp": [fingerprint(t, width) for t in texts]}

    return map_texts(docs, [id_col], text_col, "fp bigint", make)


def links(fps: DataFrame, fp: str = "fp") -> DataFrame:
    """Edges ``a``, ``b`` that connect all fingerprints with 2 or fewer differing bits.

    Rows stay in proportion to the different fingerprints (7 tables, then at most 29 centres for
    each shared bucket); the edges of a centre form a star, so the edges connect the same
    fingerprints as all pairs would.
    """
    masks = covering_masks()
    flips = [[0, *(signed(1 << i) for i in range(BITS) if not mask >> i & 1)] for mask in masks]
    one = fps.select(F.col(fp).alias("fp")).where("fp is not null").distinct()
    keyed = one.select(
        "fp",
        F.explode(F.array(*(F.struct(F.lit(v).alias("v"), F.col("fp").bitwiseAND(F.lit(signed(m))).alias("key")) for v, m in enumerate(masks)))).alias("t"),
    ).select("fp", "t.v", "t.key")
    shared = keyed.groupBy("v", "key").agg(F.count("*").alias("n")).where("n > 1").drop("n")
    rows = F.array(*(F.array(*(F.lit(x).cast("bigint") for x in row)) for row in flips))
    centres = keyed.join(shared, ["v", "key"]).select("fp", F.explode(F.get(rows, F.col("v"))).alias("flip"))
    around = centres.select(F.col("fp").bitwiseXOR(F.col("flip")).alias("z"), "fp").groupBy("z").agg(F.collect_set("fp").alias("near")).where(F.size("near") > 1)
    return around.select(F.array_min("near").alias("b"), F.explode("near").alias("a")).where("a <> b").distinct()


def near_duplicates(docs: DataFrame, id_col: str = "doc_id", text_col: str = "text", width: int = 3) -> DataFrame:
    """``id_col``, ``fingerprint`` (16 hex digits) and ``component_id`` of every row.

    Rows whose fingerprints differ in 2 or fewer bits are linked; ``component_id`` is the smallest
    id reachable. Equal texts, and all texts without words (fingerprint 0), fall together. A row
    with a null id takes part, but never names a component (null if no row of it has an id).
    Repeated rows come back as often as they were given; an empty table gives an empty result.
    """
    fps = cut_lineage(fingerprints(docs, id_col, text_col, width))
    classes = fps.groupBy("fp").agg(F.min(id_col).alias("least"))
    roots = connected_components(links(classes))
    rooted = classes.join(roots, classes["fp"] == roots["node"], "left").select("fp", F.coalesce("root", "fp").alias("root"), "least")
    named = rooted.groupBy("root").agg(F.min("least").alias("component_id"))
    of_fp = rooted.select("fp", "root").join(named, "root").select("fp", "component_id")
    return fps.join(of_fp, "fp").select(id_col, F.lower(F.lpad(F.hex("fp"), 16, "0")).alias("fingerprint"), "component_id")


#: Words of a shingle and the Jaccard similarity of shingle sets that makes two texts near.
NEAR_WIDTH, NEAR = 5, 0.8
#: Bands beside the covering tables, and least hashes of a band: a pair of similarity NEAR has no band in common once in 14,000 times.
BANDS, DEPTH = 24, 5
#: Pairs of different groups, in proportion to a bucket's texts, up to which a bucket is compared as it is.
CROWDED = 16
#: Bits of the slots by which shingles are counted to put rare ones first, and texts of a block of pairs.
SLOTS, BLOCK = 18, 4096
#: 64-bit words of the parity marks by which most pairs are ruled out, and rows that a worker takes at a time.
MARKS, SLICE = 16, 500

_MULTIPLIERS = np.array([xxhash.xxh64_intdigest(b"band", k) | 1 for k in range(BANDS * DEPTH)], np.uint64)
_MASKS = np.array(covering_masks(), np.uint64)


def _mix(x: np.ndarray) -> np.ndarray:
    x = x * np.uint64(0x9E3779B97F4A7C15)
    return x ^ (x >> np.uint64(29))


def shingle_set(text: bytes | None) -> bytes:
    """Sorted 64-bit hashes of the text's different five-word runs; of all words if there are fewer."""
    words = (text or b"").lower().split()
    if not words:
        return b""
    h = np.fromiter(map(xxhash.xxh64_intdigest, words), np.uint64, len(words))
    width = min(NEAR_WIDTH, len(words))
    n = len(words) - width + 1
    runs = np.full(n, width, np.uint64)
    for k in range(width):
        runs = _mix(runs ^ h[k : k + n])
    return np.unique(runs * np.uint64(0xFF51AFD7ED558CCD)).astype("<u8").tobytes()


def similarity(a: bytes, b: bytes) -> float:
    """Jaccard similarity of two shingle sets; two empty ones are equal."""
    x, y = np.frombuffer(a, "<u8"), np.frombuffer(b, "<u8")
    if not len(x) and not len(y):
        return 1.0
    both = len(np.intersect1d(x, y, assume_unique=True))
    return both / (len(x) + len(y) - both)


def bucket_keys(s: bytes) -> np.ndarray:
    """A set's keys: its fingerprint in each covering table, then its bands of least hashes. A set without shingles has zeros."""
    x = np.frombuffer(s, "<u8")
    if not len(x):
        return np.zeros(len(_MASKS) + BANDS, np.int64)
    tables = np.uint64(majority(x) % (1 << 64)) & _MASKS
    least = np.full(BANDS * DEPTH, (1 << 64) - 1, np.uint64)
    for at in range(0, len(x), 1024):
        np.minimum(least, _mix(x[at : at + 1024, None] * _MULTIPLIERS).min(axis=0), out=least)
    bands = np.zeros(BANDS, np.uint64)
    for column in least.reshape(BANDS, DEPTH).T:
        bands = _mix(bands ^ column)
    return np.concatenate([tables, bands]).view(np.int64)


def marks(s: bytes) -> list[int]:
    """``MARKS`` times 64 bits, each telling if an odd number of shingles falls to it: sets differ in at least as many shingles as bits."""
    odd = np.bincount((np.frombuffer(s, "<u8") & np.uint64(64 * MARKS - 1)).astype(np.int64), minlength=64 * MARKS) & 1
    return np.packbits(odd.astype(np.uint8), bitorder="little").view(np.int64).tolist()


def map_slices(df: DataFrame, keep: list[str], col: str, schema: str, apply) -> DataFrame:
    """``keep`` and the columns that ``apply`` makes of the bytes in ``col``, few rows at a time to spare the workers' memory."""
    whole = ", ".join([*(f"{f.name} {f.dataType.simpleString()}" for f in df.select(*keep).schema), schema])

    def run(batches):
        keep_nothing()
        for batch in batches:
            for at in range(0, batch.num_rows, SLICE):
                part = batch.slice(at, SLICE)
                got = apply(part.column(len(keep)).to_pylist())
                yield pa.RecordBatch.from_arrays([*(part.column(i) for i in range(len(keep))), *got.values()], names=[*keep, *got])

    return df.select(*keep, F.col(col).cast("binary")).mapInArrow(run, whole)


def _signed(texts: list[bytes]) -> dict[str, pa.Array]:
    made = [shingle_set(t) for t in texts]
    return {"size": pa.array([len(s) // 8 for s in made], pa.int32()), "keys": pa.array([bucket_keys(s) for s in made], pa.list_(pa.int64()))}


def _sets(texts: list[bytes]) -> dict[str, pa.Array]:
    made = [shingle_set(t) for t in texts]
    return {"s": pa.array(made, pa.binary()), "size": pa.array([len(s) // 8 for s in made], pa.int32()), "marks": pa.array([marks(s) for s in made], pa.list_(pa.int64()))}


def _not_ruled_out() -> Column:
    """Whether sizes and ``marks`` of the sets ``a`` and ``b`` allow similarity ``NEAR``."""
    apart = sum((F.bit_count(F.get("marks_a", F.lit(i)).bitwiseXOR(F.get("marks_b", F.lit(i)))) for i in range(MARKS)), F.lit(0))
    fits = F.least("size_a", "size_b") >= NEAR * F.greatest("size_a", "size_b") - 1e-6
    return fits & (apart <= (1 - NEAR) / (1 + NEAR) * (F.col("size_a") + F.col("size_b")) + 1e-6)


def _end(sets: DataFrame, x: str) -> DataFrame:
    return sets.select(F.col("t").alias(x), F.col("size").alias(f"size_{x}"), F.col("marks").alias(f"marks_{x}"))


def may_be_near(edges: DataFrame, sets: DataFrame) -> DataFrame:
    """The edges whose sets' sizes and ``marks`` don't rule out similarity ``NEAR``; no set is moved."""
    return edges.join(_end(sets, "a"), "a").join(_end(sets, "b"), "b").where(_not_ruled_out()).select("a", "b")


def verified(edges: DataFrame, sets: DataFrame) -> DataFrame:
    """The edges whose shingle sets (``t``, ``s``, ``size``, ``marks``) have similarity ``NEAR`` or more."""
    edges, _ = compact(may_be_near(edges, sets))
    pairs = edges.join(sets.select(F.col("t").alias("a"), F.col("s").alias("sa")), "a").join(sets.select(F.col("t").alias("b"), F.col("s").alias("sb")), "b")

    def run(batches):
        keep_nothing()
        for batch in batches:
            for at in range(0, batch.num_rows, SLICE):
                part = batch.slice(at, SLICE)
                keep = [similarity(x, y) >= NEAR for x, y in zip(part.column(2).to_pylist(), part.column(3).to_pylist(), strict=True)]
                yield part.select(["a", "b"]).filter(pa.array(keep, pa.bool_()))

    return pairs.select("a", "b", "sa", "sb").mapInArrow(run, "a binary, b binary")


def _shared(rows: DataFrame) -> DataFrame:
    """The rows (``bucket``, ``t``, ...) that aren't alone in their bucket."""
    several, _ = compact(rows.groupBy("bucket").agg(F.count("*").alias("m")).where("m > 1").select("bucket"))
    return in_bitmap(several, "bucket", rows).join(several, "bucket")


def _stars(named: DataFrame) -> DataFrame:
    """Each text of a bucket with the least text of its size class, if their groups differ."""
    sized = named.withColumn("class", F.floor(F.log(F.greatest(F.col("size"), F.lit(1))) / -math.log(NEAR)))
    least = sized.groupBy("bucket", "class").agg(F.min(F.struct("t", "label")).alias("least"))
    return sized.join(least, ["bucket", "class"]).where("label <> least.label").select(F.col("t").alias("a"), F.col("least.t").alias("b")).distinct()


def _pairs(named: DataFrame, mixed: DataFrame) -> DataFrame:
    """All pairs of texts of different groups in the buckets ``mixed``, if their sizes allow them to be near."""
    left = named.join(mixed.select("bucket"), "bucket")
    right = left.select("bucket", *(F.col(c).alias(f"{c}2") for c in ("t", "size", "label")))
    fits = F.least("size", "size2") >= NEAR * F.greatest("size", "size2") - 1e-6
    return left.join(right, "bucket").where("t > t2 and label <> label2").where(fits).select(F.col("t").alias("a"), F.col("t2").alias("b")).distinct()


def _prefixes(sets: DataFrame) -> DataFrame:
    """``bucket``, ``t``, ``size``: each set's first shingles in one order of all shingles, so many that two near sets share one.

    Of sets with similarity ``NEAR``, each has at least ``NEAR`` of its shingles in common with the other,
    so the common one that comes first is within the first ``size - ceil(NEAR size) + 1`` of both. Any
    order will do. Rare shingles come first, as few sets share them: by the count of a slot of ``SLOTS``, then by hash.
    """
    slot = lambda x: (x.view(np.uint64) >> np.uint64(64 - SLOTS)).astype(np.int64)

    def tallied(texts):
        at, m = np.unique(slot(np.frombuffer(b"".join(texts), "<i8")), return_counts=True)
        return {"at": pa.array(at), "m": pa.array(m, pa.int64())}

    counts = np.zeros(1 << SLOTS, np.int64)
    found = map_slices(sets, [], "s", "at bigint, m bigint", tallied).groupBy("at").agg(F.sum("m").alias("m")).toArrow()
    counts[found["at"].to_numpy()] = found["m"].to_numpy()
    order = sets.sparkSession.sparkContext.broadcast(counts)

    def first(s: bytes) -> np.ndarray:
        x = np.frombuffer(s, "<i8")
        return x[np.lexsort((x, order.value[slot(x)]))][: len(x) - math.ceil(NEAR * len(x) - 1e-6) + 1]

    kept = map_slices(sets, ["t", "size"], "s", "first array<bigint>", lambda texts: {"first": pa.array([first(s) for s in texts], pa.list_(pa.int64()))})
    return kept.select(F.explode("first").alias("bucket"), "t", "size")


def _blocks(named: DataFrame, crowded: DataFrame, sets: DataFrame) -> DataFrame:
    """As ``_pairs``, for buckets with any number of texts: these fall into blocks, and every two blocks meet in a task of their own.

    What ``marks`` rule out is left out before it becomes a row.
    """
    parts = F.ceil(F.col("m") / BLOCK).cast("int")
    rows = named.join(crowded.select("bucket", parts.alias("parts")), "bucket").select("bucket", "t", "label", "parts", F.pmod(F.xxhash64(F.lit(2), "t"), "parts").cast("int").alias("own"))
    every = rows.select("*", F.explode(F.sequence(F.lit(0), F.col("parts") - 1)).alias("other"))
    sides = []
    for x, low, high in (("a", "own", "other"), ("b", "other", "own")):
        side = every.where(f"{low} <= {high}").select("bucket", F.col(low).alias("low"), F.col(high).alias("high"), F.col("t").alias(x), F.col("label").alias(f"label_{x}"))
        sides.append(side.join(_end(sets, x), x))
    met = (F.col("low") < F.col("high")) | (F.col("a") > F.col("b"))
    return sides[0].join(sides[1], ["bucket", "low", "high"]).where(met & (F.col("label_a") != F.col("label_b")) & _not_ruled_out()).select("a", "b").distinct()


def near_edges(signed: DataFrame, texts: DataFrame) -> DataFrame:
    """Verified edges ``a``, ``b`` between texts whose shingle sets have similarity ``NEAR`` or more.

    ``signed``: each different text's ``t``, ``size`` and ``keys``; ``texts``: ``t`` and ``text``, each
    once. Candidates share a bucket of a covering table or of a band. Every text of a bucket is first
    compared with one of them, and those found near become groups. Then all pairs of different groups
    are compared, so a pair is left out only if it is connected already. The texts of buckets in which
    that would be more than ``CROWDED`` pairs for each text are joined exactly instead, by the shingles
    that two near sets must share (``_prefixes``); where one of these is crowded as well, all its pairs
    are compared block by block.
    """
    first = signed.select("t", "size", F.posexplode("keys").alias("i", "key")).select(F.xxhash64("i", "key").alias("bucket"), "t", "size")
    rows = materialise(_shared(first))
    wanted, _ = compact(rows.select("t").distinct().withColumn("h", F.xxhash64("t")))
    own = in_bitmap(wanted, "h", texts.withColumn("h", F.xxhash64("t"))).join(wanted.select("t"), "t", "left_semi")
    sets = cut_lineage(map_slices(own, ["t"], "text", "s binary, size int, marks array<bigint>", _sets))
    edges = signed.sparkSession.createDataFrame([], "a binary, b binary")
    groups = connected_components(edges)
    label = F.coalesce("root", "t").alias("label")
    for exact in (False, True):
        named = rows.join(groups, rows["t"] == groups["node"], "left").select("bucket", "t", "size", label)
        stars, _ = compact(_stars(named))
        edges = materialise(edges.unionByName(verified(stars, sets)))
        groups = connected_components(edges)
        named = cut_lineage(rows.join(groups, rows["t"] == groups["node"], "left").select("bucket", "t", "size", label))
        in_group = named.groupBy("bucket", "label").agg(F.count("*").alias("m"))
        mixed = in_group.groupBy("bucket").agg(F.sum("m").alias("m"), F.sum(F.col("m") * F.col("m")).alias("within")).withColumn("cross", (F.col("m") * F.col("m") - F.col("within")) / 2)
        mixed, some = compact(mixed.where("cross > 0").select("bucket", "m", (F.col("cross") > CROWDED * F.col("m")).alias("crowded")))
        if not some:
            return edges
        crowded, full = compact(mixed.where("crowded").select("bucket", "m"))
        pairs = _pairs(named, mixed.where("not crowded"))
        if exact and full:
            pairs = pairs.unionByName(_blocks(named, crowded, sets)).distinct()
        pairs, _ = compact(pairs)
        edges = materialise(edges.unionByName(verified(pairs, sets)))
        if exact or not full:
            return edges
        groups = connected_components(edges)
        rest, _ = compact(named.join(crowded.select("bucket"), "bucket").select("t").distinct())
        rows = materialise(_shared(_prefixes(sets.join(rest, "t", "left_semi"))))
    return edges


def drop_near_duplicates(docs: DataFrame, id_col: str = "doc_id", text_col: str = "text") -> DataFrame:
    """One row of every group of near copies: the one with the smallest id, all columns as they were.

    Groups are connected by equal texts and by the pairs whose five-word shingles have a Jaccard
    similarity of ``NEAR`` or more, as ``near_edges`` finds them. Null and wordless texts are one group.
    Rows with null ids come last, and of rows with equal id and text one stays.
    """
    text = F.coalesce(F.col("text"), F.lit(""))
    slots = docs.toDF(*(f"c{i}" for i in range(len(docs.columns))))
    sid, stext = (F.col(f"c{docs.columns.index(c)}") for c in (id_col, text_col))
    keyed = slots.withColumns({"text": stext.cast("string"), "id": sid}).withColumn("t", F.unhex(F.md5(text))).withColumn("h", F.xxhash64("t"))
    found = map_slices(keyed.select("t", "id", text.alias("text")), ["t", "id"], "text", "size int, keys array<bigint>", _signed)
    least = F.min(F.struct(F.col("id").isNull().alias("none"), "id")).alias("least")
    found = materialise(found.groupBy("t").agg(least, F.any_value("size").alias("size"), F.any_value("keys").alias("keys"), F.count("*").alias("n")))
    # of equal texts the row with the least id stands for all; nothing else of them is moved
    once = keyed.select("t", "h", "id", text.alias("text"))
    copied, _ = compact(found.where("n > 1").select("t", "least.id", F.xxhash64("t").alias("h")))
    alone = in_bitmap(copied, "h", once, within=False)
    maybe = in_bitmap(copied, "h", once)
    one = maybe.join(copied.select("t", F.col("id").alias("id2"), F.lit(True).alias("met")), "t", "left")
    single = one.where(F.col("met").isNull() | F.col("id").eqNullSafe(F.col("id2"))).dropDuplicates(["t"])
    texts = alone.select("t", "text").unionByName(single.select("t", "text"))
    edges = near_edges(found.select("t", "size", "keys"), texts)
    roots = connected_components(edges)
    roots = roots.unionByName(roots.select(F.col("root").alias("node"), "root").distinct())
    rooted = found.select("t", "least", "n").join(roots, found["t"] == roots["node"], "left").select("t", "least", "n", F.coalesce("root", "t").alias("root"), F.col("root").isNotNull().alias("linked"))
    touched = rooted.where("linked or n > 1")
    keep = touched.groupBy("root").agg(F.min(F.struct("least", "t")).alias("k")).select(F.col("k.t").alias("t"), F.col("k.least.id").alias("kept"))
    judged = touched.select("t", F.xxhash64("t").alias("h"), F.lit(True).alias("met")).join(keep.withColumn("keeper", F.lit(True)), "t", "left")
    judged, _ = compact(judged)
    # rows that certainly have no copy are not moved
    whole = in_bitmap(judged, "h", keyed, within=False).select(*slots.columns)
    rest = in_bitmap(judged, "h", keyed).join(judged.drop("h"), "t", "left")
    copies = rest.where("keeper").where(F.col("id").eqNullSafe(F.col("kept"))).dropDuplicates(["t"])
    out = whole.unionByName(rest.where("met is null").select(*slots.columns)).unionByName(copies.select(*slots.columns))
    return out.select(*(F.col(f"c{i}").alias(c) for i, c in enumerate(docs.columns)))
