"""Toxicity: a linear classifier on character n-grams scaled by naive Bayes log-count ratios.

Features are the distinct character n-grams of the text's distinct lower-cased words, boundaries
included, hashed to ``2^BITS`` columns. Each present feature has the value of its log-count ratio
between labelled toxic and other texts; a logistic regression on these values gives the score.
"""

from __future__ import annotations

from dataclasses import dataclass

import numpy as np
from pyspark.sql import DataFrame
from pyspark.sql import functions as F

from quire.llm.common import bucket_of, kept, map_texts

BITS = 18
SIZES = (3, 4, 5)
#: Labelled rows of either class that the fit may use, and characters of a longer one's passage.
SAMPLE, SAMPLE_CHARS = 2000, 200_000
THRESHOLD = 0.3
#: Words, and bytes of words, whose columns a worker remembers.
MEMO, MEMO_BYTES = 120_000, 4_000_000


class Features:
    """Column ids of texts; n-grams of a word are hashed once per worker, new words of a batch together."""

    def __init__(self, limit: int = MEMO):
        self.memo: dict[bytes, bytes] = {}  # 32-bit columns: an array of its own for every word would take twice the memory
        self.limit, self.held = limit, 0

    def learn(self, words: list[bytes]) -> None:
        """Columns of words: n-grams of the word with a space on either side, none across words."""
        buf = np.frombuffer(b"".join([b" " + w + b" " for w in words]), np.uint8).astype(np.uint64)
        lens = np.fromiter(map(len, words), np.int64, len(words)) + 2
        word = np.repeat(np.arange(len(words), dtype=np.int32), lens)
        cols, owner = [], []
        h = np.full(len(buf), 1469598103934665603, np.uint64)
        for n in range(1, max(SIZES) + 1):
            h = (h[: len(buf) - n + 1] ^ buf[n - 1 :]) * np.uint64(1099511628211)
            if n not in SIZES:
                continue
            inside = word[: len(h)] == word[n - 1 :]
            mixed = (h ^ (h >> np.uint64(29)) ^ np.uint64(n)) * np.uint64(0x9E3779B97F4A7C15)
            cols.append((mixed[inside] >> np.uint64(64 - BITS)).astype(np.int32))
            owner.append(word[: len(h)][inside])
        cols, owner = np.concatenate(cols), np.concatenate(owner)
        cols = cols[np.argsort(owner, kind="stable")]
        ends = np.bincount(owner, minlength=len(words)).cumsum().tolist()
        at = 0
        for w, end in zip(words, ends, strict=True):
            self.memo[w] = cols[at:end].tobytes()
            self.held += len(w)
            at = end

    def of_texts(self, texts: list[bytes | None], chunk: int = 128) -> list[np.ndarray]:
        out, memo = [], self.memo
        for at in range(0, len(texts), chunk):
            words = [set((t or b"").lower().split()) for t in texts[at : at + chunk]]
            new = [w for w in set().union(*words) if w not in memo]
            if len(memo) + len(new) > self.limit or self.held > MEMO_BYTES:
                memo.clear()
                self.held = 0
                new = list(set().union(*words))
            if new:
                self.learn(new)
            out += [unique(np.frombuffer(b"".join([memo[w] for w in own]), np.int32).copy()) if own else np.array([], np.int32) for own in words]
        return out


def unique(x: np.ndarray) -> np.ndarray:
    x.sort()
    return x[np.concatenate(([True], x[1:] != x[:-1]))] if len(x) else x


def features() -> Features:
    """Those of a Python worker."""
    return kept("toxicity", Features)


@dataclass
class Model:
    weights: np.ndarray  # log-count ratio times coefficient, by column
    bias: float

    def score(self, columns: np.ndarray) -> float:
        z = self.bias + float(self.weights[columns].sum())
        return float(1 / (1 + np.exp(-np.clip(z, -60, 60))))


def blocks_of(texts: list[bytes | None], size: int = 250) -> list[tuple[np.ndarray, np.ndarray]]:
    """Columns of ``size`` texts at a time, one after the other, and how many each text has."""
    feats, out = Features(30_000), []
    for at in range(0, len(texts), size):
        rows = feats.of_texts(texts[at : at + size])
        out.append((np.concatenate(rows), np.array([len(r) for r in rows])))
    return out


def sums(x: np.ndarray, lens: np.ndarray) -> np.ndarray:
    """Sums of consecutive stretches, empty ones included."""
    return np.diff(np.concatenate(([0.0], np.cumsum(x, dtype=np.float64)))[np.concatenate(([0], np.cumsum(lens)))])


def fit(texts: list[bytes | None], labels: list[int], prior: float | None = None, rounds: int = 100, l2: float = 1.0, smooth: float = 1.0) -> Model:
    """Fit on labelled texts. ``prior``: the share of toxic rows where scores are used, if the sample's differs.

    The design matrix is kept as column ids by block of rows; values and gradients exist for one block
    at a time, so the fit holds 4 bytes per feature of a text.
    """
    size = 1 << BITS
    y = np.asarray(labels, np.float64)
    if not len(y) or y.min() == y.max():
        p = min(max(y.mean() if len(y) else prior or 0.0, 1e-6), 1 - 1e-6)
        return Model(np.zeros(size, np.float32), float(np.log(p / (1 - p))))
    blocks, at, p, q = blocks_of(texts), 0, np.full(size, smooth), np.full(size, smooth)
    for cols, lens in blocks:
        toxic = np.repeat(y[at : at + len(lens)] > 0, lens)
        p += np.bincount(cols[toxic], minlength=size)
        q += np.bincount(cols[~toxic], minlength=size)
        at += len(lens)
    ratio = np.log(p / p.sum()) - np.log(q / q.sum())
    ratio[(p + q) <= 2 * smooth + 2] = 0.0  # seen once or twice: no evidence
    known = ratio != 0
    blocks = [(cols[known[cols]], sums(known[cols], lens).astype(np.int64)) for cols, lens in blocks]
    # logistic regression by Nesterov's method; the step follows from the largest row norm
    norm = max(float(sums(ratio[cols] ** 2, lens).max(initial=0.0)) for cols, lens in blocks) or 1.0
    step = 4 / (norm * 0.05 + l2)
    w, b, vw, vb = np.zeros(size), float(np.log(y.mean() / (1 - y.mean()))), np.zeros(size), 0.0
    for _ in range(rounds):
        lw, lb, at, total = w + 0.9 * vw, b + 0.9 * vb, 0, 0.0
        scaled, g = lw * ratio, np.zeros(size)
        for cols, lens in blocks:
            z = lb + sums(scaled[cols], lens)
            err = 1 / (1 + np.exp(-np.clip(z, -60, 60))) - y[at : at + len(lens)]
            g += np.bincount(cols, np.repeat(err, lens), minlength=size)
            total += float(err.sum())
            at += len(lens)
        vw = 0.9 * vw - step * (g * ratio + l2 * lw) / len(y)
        vb = 0.9 * vb - 0.5 * total / len(y)
        w, b = w + vw, b + vb
    if prior is not None:
        prior = min(max(prior, 1e-6), 1 - 1e-6)
        b += float(np.log(prior / (1 - prior)) - np.log(y.mean() / (1 - y.mean())))
    return Model((w * ratio).astype(np.float32), b)


def training_rows(docs: DataFrame, labels: DataFrame, learn, id_col: str, text_col: str, label_col: str, sample: int) -> tuple[list, list, float]:
    """Texts, labels and the toxic share: at most about ``sample`` rows of either class, by hash of the id.

    A text of more than ``SAMPLE_CHARS`` characters gives a passage, which starts where a hash of the id says.
    """
    one = labels.where(F.col(label_col).isNotNull() & F.col(id_col).isNotNull() & learn).groupBy(id_col).agg(F.max(label_col).cast("int").alias("y"))
    n = {r["y"]: r["count"] for r in one.groupBy("y").count().collect()}
    if not n:
        return [], [], 0.0
    share = F.xxhash64(F.lit("toxicity"), F.col(id_col).cast("string")).bitwiseAND(F.lit((1 << 30) - 1)) / float(1 << 30)
    wanted = F.when(F.col("y") == 1, F.lit(sample / n.get(1, 1))).otherwise(F.lit(sample / n.get(0, 1)))
    # total orders, so that no run takes other rows; of a repeated id the least text counts
    ids = one.withColumn("share", share).where(F.col("share") < wanted).orderBy("share", id_col).limit(3 * sample).drop("share")
    text = F.col(text_col).cast("string")
    place = F.pmod(F.xxhash64(F.lit("passage"), F.col(id_col).cast("string")), F.greatest(F.length(text) - SAMPLE_CHARS + 1, F.lit(1)))
    passage = F.substr(text, (place + 1).cast("int"), F.lit(SAMPLE_CHARS))
    rows = docs.where(text.isNotNull()).select(id_col, passage.alias("t")).join(F.broadcast(ids), id_col).groupBy(id_col).agg(F.min("t").alias("t"), F.max("y").alias("y")).collect()
    rows.sort(key=lambda r: (r["y"], r["t"]))  # the fit doesn't depend on the order of arrival
    return [r["t"].encode() for r in rows], [r["y"] for r in rows], n.get(1, 0) / sum(n.values())


def train(docs: DataFrame, labels: DataFrame, learn=None, id_col: str = "doc_id", text_col: str = "text", label_col: str = "toxic", sample: int = SAMPLE) -> Model:
    """Fit on a bounded sample (``sample`` rows of either class) of the labelled rows for which ``learn`` holds."""
    texts, y, prior = training_rows(docs, labels, F.lit(True) if learn is None else learn, id_col, text_col, label_col, sample)
    return fit(texts, y, prior)


def score(docs: DataFrame, model: Model, keep: list[str], text_col: str = "text") -> DataFrame:
    """``keep`` and ``score``, the chance of being toxic; empty and null texts get the score of no features."""
    shared = docs.sparkSession.sparkContext.broadcast((model.weights, model.bias))

    def make():
        m, feats = Model(*shared.value), features()
        return lambda texts: {"score": [m.score(x) for x in feats.of_texts(texts)]}

    return map_texts(docs, keep, text_col, "score double", make)


def drop_toxic(docs: DataFrame, labels: DataFrame, id_col: str = "doc_id", text_col: str = "text", threshold: float = THRESHOLD) -> DataFrame:
    """The rows of ``docs`` that score below ``threshold``, all columns as they were.

    A null, empty or blank text has nothing to reject it for and stays, however high the share of toxic labels.
    """
    model = train(docs, labels, learnable(id_col), id_col, text_col)
    names = docs.columns
    slots = docs.toDF(*(f"c{i}" for i in range(len(names))))
    text = f"c{names.index(text_col)}"
    wordless = ~F.coalesce(F.col(text).cast("string"), F.lit("")).rlike(r"[^\x20\x09-\x0D]")
    clean = score(slots, model, slots.columns, text).where((F.col("score") < threshold) | wordless)
    return clean.select(*(F.col(f"c{i}").alias(n) for i, n in enumerate(names)))


def learnable(id_col: str = "doc_id"):
    """Rows whose labels may be used: crc32 of the id modulo 4 is not 2."""
    return bucket_of(F.col(id_col), 4) != 2


def toxicity(docs: DataFrame, labels: DataFrame, id_col: str = "doc_id", text_col: str = "text") -> DataFrame:
    """``id_col``, ``held_out``, ``score`` and ``predicted`` for every row.

    Repeated ids in ``labels`` count as toxic if any row does; null labels and ids are not learned
    from; rows without an id are scored and not held out. Without usable labels every score is the
    prior. Equal texts get equal scores; an empty table gives an empty result.
    """
    model = train(docs, labels, learnable(id_col), id_col, text_col)
    held = F.coalesce(bucket_of(F.col(id_col), 4) == 2, F.lit(False))
    return score(docs, model, [id_col], text_col).select(id_col, held.alias("held_out"), "score", (F.col("score") >= THRESHOLD).cast("int").alias("predicted"))
