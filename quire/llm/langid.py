"""Language identification by a linear-chain conditional random field over words.

A word's features are its byte n-grams of two and three bytes, its affixes of three and four letters,
and its lexicon entry (how the training words are spread over the languages); transitions between the
labels of neighbouring words are learned. Training sequences are stitched together from passages of
different texts, so the model has seen code-switching. Forward-backward gives each word's posterior;
a text's language is the one with the largest expected number of words.
"""

from __future__ import annotations

import re
from dataclasses import dataclass

import numpy as np
from pyspark.sql import DataFrame
from pyspark.sql import functions as F

from quire.llm.common import bucket_of, map_texts

BITS = 16
UNKNOWN = "und"
#: Labelled rows of a language that the fit may use, characters of a longer one's passage, and languages (the most frequent).
SAMPLE, SAMPLE_CHARS, LABELS = 250, 20_000, 256
SEQUENCE, PASSAGE = 40, (4, 24)
MEMO, BATCH_WORDS = 400_000, 150_000

_WORD = re.compile(r"[^\W\d_]+")


def words_of(text: str | None) -> list[str]:
    """Runs of letters, lower-cased."""
    return [w for w in _WORD.findall((text or "").lower()) if w.isalpha() or any(map(str.isalpha, w))]


def columns(words: list[str]) -> tuple[np.ndarray, np.ndarray]:
    """Hashed features of words, one after the other, and how many each word has."""
    raw = [b" " + w.encode() + b" " for w in words]
    buf = np.frombuffer(b"".join(raw), np.uint8).astype(np.uint64)
    lens = np.fromiter(map(len, raw), np.int64, len(raw))
    word = np.repeat(np.arange(len(raw)), lens)
    ends = np.cumsum(lens)
    start, stop = np.repeat(ends - lens, lens), np.repeat(ends, lens)
    at = np.arange(len(buf))
    h = np.full(len(buf), 1469598103934665603, np.uint64)
    cols, owner = [], []
    for n in range(1, 6):
        h = (h[: len(buf) - n + 1] ^ buf[n - 1 :]) * np.uint64(1099511628211)
        if n < 2:
            continue
        begin = at[: len(h)]
        ok = begin + n <= stop[: len(h)]
        if n > 3:  # only what touches a boundary: prefixes and suffixes
            ok &= (begin == start[: len(h)]) | (begin + n == stop[: len(h)])
        mixed = (h ^ (h >> np.uint64(31)) ^ np.uint64(n)) * np.uint64(0x9E3779B97F4A7C15)
        cols.append((mixed[ok] >> np.uint64(64 - BITS)).astype(np.int32))
        owner.append(word[: len(h)][ok])
    cols, owner = np.concatenate(cols), np.concatenate(owner)
    return cols[np.argsort(owner, kind="stable")], np.bincount(owner, minlength=len(raw))


@dataclass
class Crf:
    labels: list[str]
    weights: np.ndarray  # features x labels
    lexicon: dict[str, np.ndarray]  # of frequent training words: share of each label less the even share
    lexicon_weights: np.ndarray  # labels x labels
    bias: np.ndarray
    transitions: np.ndarray

    def emissions(self, words: list[str]) -> np.ndarray:
        cols, counts = columns(words)
        out = np.add.reduceat(self.weights[cols], np.cumsum(counts) - counts, axis=0)
        none = np.zeros(len(self.labels), np.float32)
        lex = np.array([self.lexicon.get(w, none) for w in words], np.float32)
        return out + lex @ self.lexicon_weights + self.bias


def forward_backward(emissions: list[np.ndarray], transitions: np.ndarray) -> list[np.ndarray]:
    """Posteriors of the labels of each sequence's words; all sequences advance together, longest first."""
    order = sorted(range(len(emissions)), key=lambda i: -len(emissions[i]))
    lens = np.array([len(emissions[i]) for i in order])
    if not lens.sum():
        return [np.zeros((0, len(transitions))) for _ in emissions]
    active = (lens[:, None] > np.arange(lens[0])[None, :]).sum(0) if len(lens) * lens[0] < 5_000_000 else np.array([(lens > t).sum() for t in range(lens[0])])
    first = np.concatenate(([0], np.cumsum(active)))
    place = [first[: n] + d for d, n in enumerate(lens)]  # of each word, in order of time
    psi = np.empty((first[-1], len(transitions)))
    for d, i in enumerate(order):
        psi[place[d]] = emissions[i]
    psi = np.exp(psi - psi.max(1, keepdims=True))
    a, alpha, scale = np.exp(transitions), np.empty_like(psi), np.empty(len(psi))
    for t in range(lens[0]):
        lo, hi = first[t], first[t + 1]
        x = psi[lo:hi] if t == 0 else alpha[first[t - 1] : first[t - 1] + hi - lo] @ a * psi[lo:hi]
        s = x.sum(1)
        alpha[lo:hi], scale[lo:hi] = x / s[:, None], s
    beta = np.ones_like(psi)
    at = a.T
    for t in range(lens[0] - 2, -1, -1):
        lo, n, nxt = first[t], active[t + 1], first[t + 1]
        beta[lo : lo + n] = (psi[nxt : nxt + n] * beta[nxt : nxt + n]) @ at / scale[nxt : nxt + n, None]
    gamma = alpha * beta
    gamma /= gamma.sum(1, keepdims=True)
    out: list = [None] * len(emissions)
    for d, i in enumerate(order):
        out[i] = gamma[place[d]]
    return out


def stitch(texts: list[list[str]], labels: list[int], rng) -> tuple[list[str], np.ndarray]:
    """Passages of all texts in random order: words and their labels."""
    passages = []
    for ws, y in zip(texts, labels, strict=True):
        at = 0
        while at < len(ws):
            n = int(rng.integers(*PASSAGE))
            passages.append((ws[at : at + n], y))
            at += n
    rng.shuffle(passages)
    return [w for p, _ in passages for w in p], np.array([y for p, y in passages for _ in p], np.int64)


def fit(texts: list[str], langs: list[str], epochs: int = 4, rate: float = 0.03, l2: float = 1e-6, batch: int = 200, seed: int = 7) -> Crf:
    """Maximum likelihood by Adam over batches of sequences of ``SEQUENCE`` words."""
    labels = sorted(set(langs))
    size, k, rng = 1 << BITS, len(labels), np.random.default_rng(seed)
    if not k:
        return Crf([], np.zeros((size, 0), np.float32), {}, np.zeros((0, 0), np.float32), np.zeros(0, np.float32), np.zeros((0, 0)))
    words, y = stitch([words_of(t) for t in texts], [labels.index(x) for x in langs], rng)
    index: dict[str, int] = {}
    ids = np.array([index.setdefault(w, len(index)) for w in words], np.int64)
    spread = np.zeros((len(index), k))
    np.add.at(spread, (ids, y), 1)
    frequent = np.flatnonzero(spread.sum(1) >= 3)
    share = (spread + 0.5) / (spread.sum(1, keepdims=True) + 0.5 * k) - 1 / k
    names = list(index)
    lexicon = {names[i]: share[i].astype(np.float32) for i in frequent}
    lex = np.zeros((len(index), k), np.float32)
    lex[frequent] = share[frequent]
    crf = Crf(labels, np.zeros((size, k), np.float32), lexicon, np.zeros((k, k), np.float32), np.zeros(k, np.float32), np.zeros((k, k)))
    if k < 2 or not len(ids):
        return crf
    cols, counts = columns(names)
    starts = np.cumsum(counts) - counts
    usable = len(ids) - len(ids) % SEQUENCE if len(ids) >= SEQUENCE else 0
    if not usable:
        ids, y = np.resize(ids, SEQUENCE), np.resize(y, SEQUENCE)
        usable = SEQUENCE
    seqs, ys = ids[:usable].reshape(-1, SEQUENCE), y[:usable].reshape(-1, SEQUENCE)
    params = [crf.weights, crf.lexicon_weights, crf.bias, crf.transitions]
    m, v, step = [np.zeros_like(p) for p in params], [np.zeros_like(p) for p in params], 0
    for _ in range(epochs):
        by = rng.permutation(len(seqs))
        for at in range(0, len(by), batch):
            s, t = seqs[by[at : at + batch]], ys[by[at : at + batch]]
            uniq, inv = np.unique(s, return_inverse=True)
            inv = inv.reshape(s.shape)
            pos = np.repeat(starts[uniq], counts[uniq]) + np.arange(counts[uniq].sum()) - np.repeat(np.cumsum(counts[uniq]) - counts[uniq], counts[uniq])
            feat = cols[pos]
            # half of the time a word goes without its entry, so that affixes and n-grams carry unknown words
            entry = lex[uniq] * (rng.random((len(uniq), 1)) < 0.5)
            e = np.add.reduceat(crf.weights[feat], np.cumsum(counts[uniq]) - counts[uniq], axis=0) + entry @ crf.lexicon_weights + crf.bias
            err, dtrans = _gradients(e[inv], t, crf.transitions)
            n = err.shape[0] * err.shape[1]
            per_word = np.stack([np.bincount(inv.ravel(), err[..., j].ravel(), minlength=len(uniq)) for j in range(k)], 1) / n
            rep = np.repeat(per_word, counts[uniq], axis=0)
            dw = np.stack([np.bincount(feat, rep[:, j], minlength=size) for j in range(k)], 1) + l2 * crf.weights
            step += 1
            for p, g, mm, vv in zip(params, (dw, entry.T @ per_word, per_word.sum(0), dtrans / n), m, v, strict=True):
                mm += 0.1 * (g - mm)
                vv += 0.001 * (g * g - vv)
                p -= rate * (mm / (1 - 0.9**step)) / (np.sqrt(vv / (1 - 0.999**step)) + 1e-8)
    return crf


def _gradients(e: np.ndarray, y: np.ndarray, transitions: np.ndarray) -> tuple[np.ndarray, np.ndarray]:
    """Of the negative log-likelihood: by emission (sequences x words x labels) and by transition."""
    b, n, k = e.shape
    psi, a = np.exp(e - e.max(2, keepdims=True)).astype(np.float64), np.exp(transitions)
    alpha, scale, beta = np.empty_like(psi), np.empty((b, n, 1)), np.ones_like(psi)
    for t in range(n):
        x = psi[:, t] if t == 0 else alpha[:, t - 1] @ a * psi[:, t]
        scale[:, t] = x.sum(1, keepdims=True)
        alpha[:, t] = x / scale[:, t]
    for t in range(n - 2, -1, -1):
        beta[:, t] = (psi[:, t + 1] * beta[:, t + 1] / scale[:, t + 1]) @ a.T
    gamma = alpha * beta
    gamma /= gamma.sum(2, keepdims=True)
    onward = psi[:, 1:] * beta[:, 1:] / scale[:, 1:]
    dtrans = np.einsum("bti,btj->ij", alpha[:, :-1], onward) * a
    gold = np.zeros((k, k))
    np.add.at(gold, (y[:, :-1].ravel(), y[:, 1:].ravel()), 1)
    return gamma - np.eye(k)[y], dtrans - gold


class Labeller:
    """Posteriors of texts; a word's emissions are computed once per task."""

    def __init__(self, crf: Crf):
        self.crf, self.memo = crf, {}
        self.rows = np.zeros((1024, len(crf.labels)), np.float32)

    def _learn(self, words: list[str]) -> None:
        e, at = self.crf.emissions(words), len(self.memo)
        while at + len(words) > len(self.rows):
            self.rows = np.concatenate([self.rows, np.zeros_like(self.rows)])
        self.rows[at : at + len(words)] = e
        self.memo.update(zip(words, range(at, at + len(words)), strict=True))

    def posteriors(self, texts: list[list[str]]) -> list[np.ndarray]:
        out: list = [None] * len(texts)
        order = sorted(range(len(texts)), key=lambda i: len(texts[i]))
        at = 0
        while at < len(order):
            end, total = at, 0
            while end < len(order) and (end == at or total + len(texts[order[end]]) <= BATCH_WORDS):
                total += len(texts[order[end]])
                end += 1
            own = [texts[i] for i in order[at:end]]
            new = {w for ws in own for w in ws if w not in self.memo}
            if len(self.memo) + len(new) > MEMO:
                self.memo.clear()
                new = {w for ws in own for w in ws}
            if new:
                self._learn(list(new))
            memo = self.memo
            got = forward_backward([self.rows[[memo[w] for w in ws]] for ws in own], self.crf.transitions)
            for i, g in zip(order[at:end], got, strict=True):
                out[i] = g
            at = end
        return out


def train(docs: DataFrame, learn, id_col: str = "doc_id", text_col: str = "text", lang_col: str = "lang", sample: int = SAMPLE) -> Crf:
    """Fit on a bounded sample: of each language about ``sample`` rows with ``learn``, by hash of the id.

    Of a text of more than ``SAMPLE_CHARS`` characters the fit takes a passage, which starts where the hash says.
    """
    h = F.xxhash64(F.lit("language"), F.col(id_col).cast("string")).bitwiseAND(F.lit((1 << 30) - 1))
    t = F.col(text_col).cast("string")
    passage = F.substr(t, (F.pmod(h, F.greatest(F.length(t) - SAMPLE_CHARS + 1, F.lit(1))) + 1).cast("int"), F.lit(SAMPLE_CHARS))
    rows = docs.where(F.col(lang_col).isNotNull() & learn & F.col(text_col).isNotNull()).select(h.alias("h"), F.col(lang_col).cast("string").alias("lang"), passage.alias("t"))
    n = {r["lang"]: r["count"] for r in rows.groupBy("lang").count().orderBy(F.desc("count"), "lang").limit(LABELS).collect()}
    if not n:
        return fit([], [])
    wanted = F.try_element_at(F.create_map(*(F.lit(x) for lang, c in n.items() for x in (lang, int(min(1.0, sample / c) * (1 << 30))))), F.col("lang"))
    # a total order, so that no run takes other rows
    got = sorted((r["lang"], r["t"]) for r in rows.where(F.col("h") < wanted).orderBy("h", "lang", "t").limit(2 * sample * len(n)).collect())
    return fit([t for _, t in got], [lang for lang, _ in got])


def label_texts(docs: DataFrame, crf: Crf, keep: list[str], text_col: str = "text") -> DataFrame:
    """``keep``, ``lang_pred``, ``score`` and ``shares``: the expected share of words of each language."""
    shared = docs.sparkSession.sparkContext.broadcast(crf)

    def make():
        labeller = Labeller(shared.value)
        labels = shared.value.labels

        def apply(texts):
            words = [words_of(t.decode()) if t else [] for t in texts]
            pred, score, shares = [], [], []
            for g in labeller.posteriors(words) if labels else [()] * len(words):
                if not len(g):
                    pred.append(UNKNOWN)
                    score.append(0.0)
                    shares.append([])
                    continue
                mean = g.mean(0)
                k = int(mean.argmax())
                pred.append(labels[k])
                score.append(float(min(1.0, mean[k])))
                shares.append([{"lang": lang, "share": float(x)} for lang, x in zip(labels, mean, strict=True)])
            return {"lang_pred": pred, "score": score, "shares": shares}

        return apply

    return map_texts(docs, keep, text_col, "lang_pred string, score double, shares array<struct<lang:string,share:double>>", make)


def label_words(docs: DataFrame, crf: Crf, keep: list[str], text_col: str = "text") -> DataFrame:
    """``keep`` and ``words``: every word of letters with its most likely language and the posterior."""
    shared = docs.sparkSession.sparkContext.broadcast(crf)

    def make():
        labeller, labels = Labeller(shared.value), shared.value.labels

        def apply(texts):
            words = [words_of(t.decode()) if t and labels else [] for t in texts]
            best = [
                [{"word": w, "lang": labels[int(p.argmax())], "p": float(p.max())} for w, p in zip(ws, g, strict=True)] for ws, g in zip(words, labeller.posteriors(words), strict=True)
            ]
            return {"words": best}

        return apply

    return map_texts(docs, keep, text_col, "words array<struct<word:string,lang:string,p:double>>", make)


def identify(docs: DataFrame, id_col: str = "doc_id", text_col: str = "text", lang_col: str = "lang") -> DataFrame:
    """``id_col``, ``held_out``, ``lang_pred`` and ``score`` for every row.

    Learned from rows whose crc32 of the id modulo 5 is not 0 and whose language isn't null. A null
    text, and one without a letter, gets ``und`` and score 0, as does every text when nothing can be
    learned. Null ids are kept and not held out; repeated rows agree; an empty table gives an empty
    result.
    """
    crf = train(docs, bucket_of(F.col(id_col), 5) != 0, id_col, text_col, lang_col)
    held = F.coalesce(bucket_of(F.col(id_col), 5) == 0, F.lit(False))
    return label_texts(docs, crf, [id_col], text_col).select(id_col, held.alias("held_out"), "lang_pred", "score")
