"""Language-model scoring by prediction by partial matching (PPM) over the bytes of texts.

A text is its lower-cased words, a space behind each, and a newline as the end token. The context of a
byte is the ``ORDER`` bytes before it, across words; in front of a text there are newlines. The trie
holds, for every context of 0..ORDER bytes, how often each byte followed in the training texts. Escapes
are estimated by method C (distinct followers), and bytes already refused by a longer context are
excluded from the shorter ones, down to equal chances for the bytes that no context of order 0 has seen.

A byte's code length depends on its gram, the context and the byte, alone. So grams are counted, each
task adding up its own, and the trie is a table per order, made of the next longer one. Every distinct
gram of the corpus gets its code length by equi-joins with these tables; the trie is never brought
together. Texts meet the values of their grams and words twice: the ``HOT`` most frequent are broadcast
(a bounded table), all others are joined.

Code lengths are whole multiples of 2^-36, so sums don't depend on the order of their parts.
"""

from __future__ import annotations

import math

import numpy as np
import pyarrow as pa
from pyspark.sql import Column, DataFrame
from pyspark.sql import functions as F

from quire.llm.common import bucket_of, map_texts, materialise

ORDER = 5
END = b"\n"
#: Words and grams in the broadcast tables; words and grams counted before a flush; bytes of text taken at a time.
HOT, HOT_GRAMS, FLUSH, CHUNK = 250_000, 2_000_000, 400_000, 1 << 20
#: Texts whose words and bytes a worker holds at a time.
SLICE = 256
UNIT = 1 << 36


def coded(words: list[bytes]) -> bytes:
    """The bytes that stand for a text, with the newlines in front of it: what ``prepared`` makes of many texts at once."""
    return END * ORDER + b"".join([w + b" " for w in words]) + END


#: Lower case, and a space for all that parts words.
_FOLD = bytes(range(256)).lower().translate(bytes(32 if chr(i) in "\t\n\x0b\x0c\r" else i for i in range(256)))


def prepared(texts: list[bytes | None]):
    """(first, coded texts, words, how many each text has) of about ``CHUNK`` bytes of texts at a time; a longer one comes alone.

    ``words``: an array of all their words in order.
    """
    first, held, size = 0, [], 0
    for i, t in enumerate(texts):
        if held and size + len(t or b"") > CHUNK:
            yield first, *_prepared(held)
            first, held, size = i, [], 0
        held.append(t or b"")
        size += len(held[-1])
    if held:
        yield first, *_prepared(held)


def _prepared(texts: list[bytes]) -> tuple[list[bytes], pa.Array, np.ndarray]:
    # in front of a text its newlines, behind it room for the space of its last word and for its end
    whole = END * ORDER + (END * (ORDER + 2)).join(texts) + END * 2
    buf = np.frombuffer(whole.translate(_FOLD), np.uint8).copy()
    ends = np.cumsum(np.fromiter(map(len, texts), np.int64, len(texts)) + ORDER + 2)
    starts = np.r_[0, ends[:-1]]
    solid = buf != 32
    letters = buf[solid]
    stays = solid.copy()
    stays[1:] |= solid[:-1]
    for at in (*(starts + k for k in range(ORDER)), ends - 1):
        buf[at] = END[0]
        stays[at] = True
    out = buf[stays]
    bounds = np.r_[0, np.cumsum(np.add.reduceat(stays, starts, dtype=np.int64))]
    spaces = np.flatnonzero(out == 32)
    n_words = np.diff(np.searchsorted(spaces, bounds))
    # a word ends where its space stands, less the spaces and newlines before
    offsets = np.zeros(len(spaces) + 1, np.int32)
    offsets[1:] = spaces - np.arange(len(spaces)) - ORDER - (ORDER + 1) * np.repeat(np.arange(len(texts)), n_words)
    words = pa.Array.from_buffers(pa.binary(), len(spaces), [None, pa.py_buffer(offsets), pa.py_buffer(letters)])
    line = out.tobytes()
    return [line[a:b] for a, b in zip(bounds[:-1].tolist(), bounds[1:].tolist())], words, n_words


def runs(ordered: np.ndarray) -> tuple[np.ndarray, np.ndarray]:
    """Where each value of a sorted array starts, and how often it stands there."""
    at = np.flatnonzero(np.r_[True, ordered[1:] != ordered[:-1]][: len(ordered)])
    return at, np.diff(np.r_[at, len(ordered)])


def grams(texts: list[bytes]) -> tuple[np.ndarray, np.ndarray]:
    """Of every coded byte of several texts (``coded`` ones): context and byte in one integer, the most
    recent lowest; and how many each text has."""
    buf = np.frombuffer(b"".join(texts), np.uint8).astype(np.int64)
    lens = np.fromiter(map(len, texts), np.int64, len(texts))
    key = buf.copy()
    for k in range(1, ORDER + 1):
        key[k:] |= buf[:-k] << (8 * k)
    whole = np.ones(len(buf), bool)
    for k in range(ORDER):
        whole[np.cumsum(lens) - lens + k] = False
    return key[whole], lens - ORDER


def pieces(texts: list[bytes]):
    """(owners, pieces) of about ``CHUNK`` bytes of coded texts; a longer text is cut, each piece with the context in front of it."""
    owners, held, size = [], [], 0
    for i, t in enumerate(texts):
        for at in range(0, len(t) - ORDER, CHUNK):
            held.append(t[at : at + CHUNK + ORDER])
            owners.append(i)
            size += len(held[-1])
            if size >= CHUNK:
                yield np.array(owners), held
                owners, held, size = [], [], 0
    if held:
        yield np.array(owners), held


def gram_keys(gram: np.ndarray) -> pa.Array:
    """Grams as in ``_key``."""
    raw = np.full((len(gram), ORDER + 2), END[0], np.uint8)
    raw[:, 1:] = gram.astype(">i8").view(np.uint8).reshape(-1, 8)[:, 7 - ORDER :]
    starts = np.arange(len(gram) + 1, dtype=np.int32) * (ORDER + 2)
    return pa.Array.from_buffers(pa.binary(), len(gram), [None, pa.py_buffer(starts), pa.py_buffer(raw)])


def listed(n: int, parts: list[tuple[np.ndarray, pa.Array, np.ndarray]]) -> pa.ListArray:
    """What is joined later, by text, from owners, keys and times."""
    owner, times = (np.concatenate([np.zeros(0, np.int64), *(x[i] for x in parts)]) for i in (0, 2))
    keys = pa.concat_arrays([pa.array([], pa.binary()), *(x[1] for x in parts)])
    by = np.argsort(owner, kind="stable")
    ends = np.searchsorted(owner[by], np.arange(n + 1)).astype(np.int32)
    return pa.ListArray.from_arrays(pa.array(ends), pa.StructArray.from_arrays([keys.take(pa.array(by)), pa.array(times[by])], names=["key", "k"]))


def entries(n: int, words: list[list[tuple[bytes, int]]], cold: list[tuple[np.ndarray, np.ndarray, np.ndarray]]) -> pa.ListArray:
    """``listed`` of the (word, times) by text and, from ``cold``, owners, grams and times."""
    owner = np.repeat(np.arange(n), [len(ws) for ws in words])
    own = (owner, pa.array([w for ws in words for w, _ in ws], pa.binary()), np.array([k for ws in words for _, k in ws], np.int64))
    return listed(n, [own, *((o, gram_keys(g), k) for o, g, k in cold)])


def count_tokens(docs: DataFrame, id_col: str, text_col: str, learn) -> DataFrame:
    """``word`` (binary) and ``c``: how often it stands in rows with ``learn``; words of other rows too, with 0.

    Each task adds up to ``2 FLUSH`` words before it hands them on, so a frequent word costs a row per
    flush, not one per place. The end token counts once per row.
    """
    src = docs.select(F.coalesce(learn, F.lit(False)).alias("learn"), F.col(text_col).cast("string").alias("t"))

    def merged(held):
        whole = pa.concat_arrays([w for w, _ in held]).dictionary_encode()
        c = np.bincount(whole.indices.to_numpy(), np.concatenate([c for _, c in held]), len(whole.dictionary))
        return whole.dictionary, c

    def flush(held):
        word, c = merged(held)
        return pa.RecordBatch.from_arrays([word, pa.array(c.astype(np.int64))], names=["word", "c"])

    def run(batches):
        held, size, least = [], 0, 0
        for batch in batches:
            flags = batch.column(0).to_numpy(zero_copy_only=False).astype(np.float64)
            if len(flags):
                held.append((pa.array([END], pa.binary()), np.array([flags.sum()])))
            for begin in range(0, batch.num_rows, SLICE):  # few texts are held at a time
                part = batch.column(1).slice(begin, SLICE).cast(pa.binary()).to_pylist()
                for first, _, words, n_words in prepared(part):
                    own = words.dictionary_encode()
                    learns = np.repeat(flags[begin + first : begin + first + len(n_words)], n_words)
                    held.append((own.dictionary, np.bincount(own.indices.to_numpy(), learns, len(own.dictionary))))
                    size += len(own.dictionary)
                    if size > least + FLUSH:
                        held = [merged(held)]
                        size = least = len(held[0][0])
                        if size > 2 * FLUSH:
                            yield flush(held)
                            held, size, least = [], 0, 0
        if held:
            yield flush(held)

    return src.mapInArrow(run, "word binary, c bigint").groupBy("word").agg(F.sum("c").alias("c"))


def count_grams(docs: DataFrame, text_col: str, learn: Column) -> DataFrame:
    """``gram`` and ``c``: how often it stands in rows with ``learn``; grams of other rows too, with 0."""
    src = docs.select(F.coalesce(learn, F.lit(False)).alias("learn"), F.col(text_col).cast("string").alias("t"))

    def run(batches):
        held, size, least = [], 0, 0

        def merged():
            g, c = (np.concatenate(x) for x in zip(*held))
            by = np.argsort(g, kind="stable")  # quick, as it merges sorted parts
            g = g[by]
            at, _ = runs(g)
            return g[at], np.add.reduceat(c[by], at)

        for batch in batches:
            flags = batch.column(0).to_numpy(zero_copy_only=False).astype(np.int64)
            for begin in range(0, batch.num_rows, SLICE):  # few texts are held at a time
                part = batch.column(1).slice(begin, SLICE).cast(pa.binary()).to_pylist()
                for first, texts, _, _ in prepared(part):
                    for owners, some in pieces(texts):
                        g, lens = grams(some)
                        # sorting needs no way back to the places, as the flag is the lowest bit
                        both = np.sort(g << 1 | np.repeat(flags[begin + first + owners], lens))
                        at, times = runs(both)
                        held.append((both[at] >> 1, times * (both[at] & 1)))
                        size += len(at)
                        if size > least + 3 * FLUSH:
                            u, c = merged()
                            held = [(u, c)]
                            size = least = len(u)
                            if size > 4 * FLUSH:
                                yield pa.RecordBatch.from_arrays([pa.array(u), pa.array(c)], names=["gram", "c"])
                                held, size, least = [], 0, 0
        if held:
            u, c = merged()
            yield pa.RecordBatch.from_arrays([pa.array(u), pa.array(c)], names=["gram", "c"])

    return src.mapInArrow(run, "gram bigint, c bigint").groupBy("gram").agg(F.sum("c").alias("c"))


def _cut(gram: Column, k: int) -> Column:
    """The last ``k`` context bytes and the byte."""
    return gram.bitwiseAND(F.lit((1 << (8 * (k + 1))) - 1))


def tries(counted: DataFrame) -> list[tuple[DataFrame, DataFrame]]:
    """By order: the counts ``gram``, ``n``, and the contexts ``ctx``, ``total``, ``distinct``, ``refused``.

    ``refused``: what excluding the bytes that follow a context takes from the one that is a byte shorter.
    """
    out, level = [], materialise(counted.where("c > 0").select("gram", F.col("c").alias("n")))
    for k in range(ORDER, -1, -1):
        below = materialise(level.groupBy(_cut(F.col("gram"), k - 1).alias("gram")).agg(F.sum("n").alias("n"))) if k else None
        rows = level.withColumn("shorter", _cut(F.col("gram"), k - 1)) if k else level.withColumn("m", F.lit(0))
        if k:
            rows = rows.join(below.select(F.col("gram").alias("shorter"), F.col("n").alias("m")), "shorter")
        contexts = rows.groupBy(F.shiftright("gram", 8).alias("ctx")).agg(F.sum("n").alias("total"), F.count("*").alias("distinct"), F.sum("m").alias("refused"))
        out.append((level, materialise(contexts)))
        level = below
    return out[::-1]


def unit(x: Column) -> Column:
    return F.round(x * UNIT).cast("bigint")


def gram_values(counted: DataFrame) -> DataFrame:
    """``gram``, ``c`` and ``q``: its code length under the trie of all grams with ``c > 0``, as log10 in units of 2^-36.

    The tables of orders 0 and 1 and the contexts of order 2 have at most 65,536 rows and are broadcast.
    """
    levels = tries(counted)
    seen = counted.where("c > 0").withColumn("ctx", F.shiftright("gram", 8)).join(levels[-1][1], "ctx")
    seen = seen.select("gram", "c", unit(F.log10(F.col("c") / (F.col("total") + F.col("distinct")))).alias("q"))
    zero = F.lit(0)
    state = counted.where("c = 0").select("gram", F.lit(0.0).alias("lp"), F.lit(True).alias("open"), zero.cast("bigint").alias("gone"), zero.cast("bigint").alias("used"))
    for k in range(ORDER, -1, -1):
        counts, contexts = levels[k]
        if k <= 2:
            contexts = F.broadcast(contexts)
        if k <= 1:
            counts = F.broadcast(counts)
        state = state.withColumn("ctx", F.shiftright(_cut(F.col("gram"), k), 8)).join(contexts, "ctx", "left")
        if k < ORDER:  # its own gram was never counted
            state = state.withColumn("cut", _cut(F.col("gram"), k)).join(counts.withColumnRenamed("gram", "cut"), "cut", "left")
        else:
            state = state.withColumn("n", F.lit(None).cast("bigint"))
        known = F.col("open") & F.col("total").isNotNull()
        left, fresh = F.col("total") - F.col("gone"), F.col("distinct") - F.col("used")
        hit, miss = known & F.col("n").isNotNull(), known & F.col("n").isNull()
        step = F.when(hit, F.log10(F.try_divide(F.col("n"), left + fresh))).when(miss & (fresh > 0), F.log10(F.try_divide(fresh, left + fresh))).otherwise(0.0)
        state = state.select(
            "gram",
            (F.col("lp") + step).alias("lp"),
            (F.col("open") & ~hit).alias("open"),
            F.when(miss, F.col("refused")).otherwise(F.col("gone")).alias("gone"),
            F.when(miss, F.col("distinct")).otherwise(F.col("used")).alias("used"),
        )
    # ``used`` is now the number of bytes that order 0 has seen
    rest = F.when(F.col("open"), F.log10(256 - F.col("used"))).otherwise(0.0)
    return seen.unionByName(state.select("gram", F.lit(0).cast("bigint").alias("c"), unit(F.col("lp") - rest).alias("q")))


def frequent_from(words: DataFrame, limit: int) -> int:
    """The least count, by eighths of a doubling, that at most ``limit`` words reach."""
    step = F.floor(F.log2("c") * 8).alias("step")
    sizes = {r["step"]: r["count"] for r in words.where("c > 0").groupBy(step).count().collect()}  # at most 512 rows
    least, total = None, 0
    for k in sorted(sizes, reverse=True):
        total += sizes[k]
        if total > limit:
            break
        least = k
    return 1 << 62 if least is None else math.ceil(2 ** (least / 8) - 1e-9)


def _key(gram: Column) -> Column:
    """A gram among words: no word has a newline."""
    return F.unhex(F.concat(F.lit("0A"), F.lpad(F.hex(gram), 2 * ORDER + 2, "0")))


def score_texts(docs: DataFrame, learn: Column, id_col: str = "doc_id", text_col: str = "text", hot: int = HOT, hot_grams: int = HOT_GRAMS) -> DataFrame:
    """``id_col``, ``n_tokens``, ``n_known``, ``train_tokens``, ``base_score`` and ``score`` of every row.

    ``learn`` marks the rows to learn from (null: not). ``base_score`` is the add-half unigram model's
    log10 probability, ``score`` the PPM model's. A null or empty text is the end token alone. Equal
    texts get equal scores; null ids and repeated rows are kept; an empty table gives an empty result,
    and without any training row both models fall back to equal chances.
    """
    spark = docs.sparkSession
    words = materialise(count_tokens(docs, id_col, text_col, learn))
    n, v = words.agg(F.coalesce(F.sum("c"), F.lit(0)), F.count(F.when(F.col("c") > 0, 1))).first()
    low = math.log10(n + 0.5 * (v + 1))
    words = words.select("word", "c", unit(F.log10(F.col("c") + 0.5) - low).alias("q"))
    values = materialise(gram_values(materialise(count_grams(docs, text_col, learn))))
    top = words.where(F.col("c") >= frequent_from(words, hot)).toArrow()
    frequent = top.column("word").combine_chunks()
    index = spark.sparkContext.broadcast((frequent, top.column("q").to_numpy(), top.column("c").to_numpy() > 0, frequent.index(END).as_py()))
    top = values.where(F.col("c") >= frequent_from(values, hot_grams)).select("gram", "q").toArrow()
    g, q = (top.column(x).to_numpy() for x in ("gram", "q"))
    by = np.argsort(g)
    table = spark.sparkContext.broadcast((g[by], q[by]))

    def make():
        (hot_words, hot_base, hot_known, end), (hot_g, hot_q) = index.value, table.value
        place_of = dict(zip(hot_words.to_pylist(), range(len(hot_words)))).get

        def of_words(words, n_words):
            """Known words and base of each text; owners, words and times of what isn't in the table."""
            n, own = len(n_words), words.dictionary_encode()
            m = max(len(own.dictionary), 1)
            key = np.sort(np.repeat(np.arange(n) * m, n_words) + own.indices.to_numpy())
            at, times = runs(key)
            owner, code = np.divmod(key[at], m)
            place = np.array([place_of(w, -1) for w in own.dictionary.to_pylist()], np.int64)[code]
            hit = place >= 0
            ends = np.searchsorted(owner, np.arange(n + 1))
            per_text = lambda x: np.diff(np.r_[0, np.cumsum(x)][ends])
            seen = per_text(np.where(hit, hot_known[place], 0) * times) if len(hot_words) else np.zeros(n, np.int64)
            base = per_text(np.where(hit, hot_base[place], 0) * times) if len(hot_words) else np.zeros(n, np.int64)
            rest = [(owner[~hit], own.dictionary.take(pa.array(code[~hit])), times[~hit])]
            # the end token is a word of each text
            if end >= 0:
                return seen + hot_known[end], base + hot_base[end], rest
            return seen, base, [*rest, (np.arange(n), pa.array([END] * n, pa.binary()), np.ones(n, np.int64))]

        def of_grams(texts):
            sums, cold = np.zeros(len(texts), np.int64), []
            for owners, some in pieces(texts):
                keys, lens = grams(some)
                # a batch has no more than 2^15 texts, and a gram 48 bits
                both = np.sort(keys << 15 | np.repeat(owners, lens))
                at, times = runs(both)
                both = both[at]
                gram, owner = both >> 15, both & 0x7FFF
                at, many = runs(gram)
                u = gram[at]
                i = np.minimum(np.searchsorted(hot_g, u), max(len(hot_g) - 1, 0))
                hit = hot_g[i] == u if len(hot_g) else np.zeros(len(u), bool)
                value = np.where(hit, hot_q[i], 0) if len(hot_g) else np.zeros(len(u), np.int64)
                np.add.at(sums, owner, np.repeat(value, many) * times)
                if not hit.all():
                    rare = np.repeat(~hit, many)
                    cold.append((owner[rare], gram_keys(gram[rare]), times[rare]))
            return sums, cold

        def apply(texts):
            told, rest = [], []
            for first, codes, words, n_words in prepared(texts):
                seen, base, own = of_words(words, n_words)
                sums, cold = of_grams(codes)
                told.append((n_words + 1, seen, base, sums))
                rest += [(first + owner, key, times) for owner, key, times in (*own, *cold)]
            names = ("n_tokens", "n_hot", "base_hot", "lp_hot")
            return {c: pa.array(np.concatenate([np.zeros(0, np.int64), *x])) for c, x in zip(names, zip(*told))} | {"rest": listed(len(texts), rest)}

        return apply

    keyed = docs.select(F.monotonically_increasing_id().alias("row"), id_col, text_col)
    schema = "n_tokens bigint, n_hot bigint, base_hot bigint, lp_hot bigint, rest array<struct<key:binary,k:bigint>>"
    sums = map_texts(keyed, ["row", id_col], text_col, schema, make)
    head = F.struct(F.col(id_col).alias("id"), "n_tokens", "n_hot", "base_hot", "lp_hot")
    # the first of a row's entries carries its sums, so that they cross the exchange once
    places = sums.select("row", head.alias("head"), F.posexplode_outer("rest").alias("i", "r")).select(
        "row", F.when(F.coalesce("i", F.lit(0)) == 0, F.col("head")).alias("head"), "r.key", "r.k"
    )
    none = F.lit(None).cast("bigint")
    met = words.select(F.col("word").alias("key"), "c", F.col("q").alias("base"), none.alias("lp")).unionByName(
        values.select(_key(F.col("gram")).alias("key"), none.alias("c"), none.alias("base"), F.col("q").alias("lp"))
    )
    whole = places.join(met, "key", "left").groupBy("row").agg(
        F.max("head").alias("h"),
        F.sum(F.when(F.col("c") > 0, F.col("k"))).alias("k"),
        F.sum(F.col("k") * F.col("base")).alias("base"),
        F.sum(F.col("k") * F.col("lp")).alias("lp"),
    )
    zero = F.lit(0)
    return whole.select(
        F.col("h.id").alias(id_col),
        "h.n_tokens",
        (F.col("h.n_hot") + F.coalesce("k", zero)).alias("n_known"),
        F.lit(n).cast("bigint").alias("train_tokens"),
        ((F.col("h.base_hot") + F.coalesce("base", zero)) / UNIT).alias("base_score"),
        ((F.col("h.lp_hot") + F.coalesce("lp", zero)) / UNIT).alias("score"),
    )


def held_out(id_col: str = "doc_id"):
    """Rows that are scored but not learned from: crc32 of the id modulo 5 is 1."""
    return F.coalesce(bucket_of(F.col(id_col), 5) == 1, F.lit(False))


def language_model_scores(docs: DataFrame, id_col: str = "doc_id", text_col: str = "text") -> DataFrame:
    """``score_texts`` learning from the rows whose crc32 modulo 5 is not 1 (not from null ids), and ``held_out``."""
    scored = score_texts(docs, bucket_of(F.col(id_col), 5) != 1, id_col, text_col)
    return scored.select(id_col, held_out(id_col).alias("held_out"), "n_tokens", "n_known", "train_tokens", "base_score", "score")
