"""Secret scan: fixed patterns, and a battery of randomness tests over token-like runs.

Every run of token characters gets the narrowest encoding that fits it (hex, base32, alphanumeric,
base64) and three statistics over the positions of its characters in that alphabet: chi-squared for
uniformity, runs above and below the alphabet's middle, and lag-1 serial correlation. A random key
scores near 0 on all three. The null hypothesis is ordinary text, whose chi-squared excess grows with
the length: ``p`` is the chance that ordinary text of this length looks as uniform as the run does.
Runs that are not themselves refused as random by the battery are then kept by a Benjamini-Hochberg
step within their length band, over the counts of all documents.
"""

from __future__ import annotations

import math
import re

import numpy as np
from pyspark.sql import DataFrame
from pyspark.sql import functions as F

from quire.llm.common import cut_lineage, map_texts

#: The base patterns (kind, expression, group that must have `least` characters, least).
BASE = (
    ("assign", r"(?ai)(password|passwd|secret|token|api_?key)[\"']?\x20*[:=]\x20*[\"']?([A-Za-z0-9+/_.=-]+)", 2, 6),
    ("access", r"AKIA[A-Z0-9]+", 0, 20),
    ("hex", r"[0-9a-f]+", 0, 24),
)
_ASSIGN = re.compile(BASE[0][1])
# for these two, leftmost runs that are long enough are the long ones of all leftmost runs
_ACCESS, _HEX = re.compile(r"AKIA[A-Z0-9]{16,}"), re.compile(r"[0-9a-f]{24,}")
MIN_LENGTH = 16
_RUN = re.compile(rf"[A-Za-z0-9+/_-]{{{MIN_LENGTH},}}={{0,2}}")
_DIGIT = re.compile(r"[0-9]")

#: Alphabets from narrow to wide.
ENCODINGS = (
    ("hex", "0123456789abcdef"),
    ("hexupper", "0123456789ABCDEF"),
    ("base32", "ABCDEFGHIJKLMNOPQRSTUVWXYZ234567"),
    ("alnumlower", "abcdefghijklmnopqrstuvwxyz0123456789"),
    ("alnum", "ABCDEFGHIJKLMNOPQRSTUVWXYZabcdefghijklmnopqrstuvwxyz0123456789"),
    ("base64", "ABCDEFGHIJKLMNOPQRSTUVWXYZabcdefghijklmnopqrstuvwxyz0123456789+/=-_"),
)
_ALPHABETS = [(name, frozenset(chars), {c: i for i, c in enumerate(chars)}, len(chars)) for name, chars in ENCODINGS]

#: Share of equal letter pairs in ordinary text, and its spread between texts.
COINCIDENCE, SPREAD = 0.068, 0.012
#: Digits among the characters of ordinary text runs; characters of text inside the narrow alphabets.
TEXT_DIGITS = 0.05
TEXT_SHARE = {"hex": 0.35, "hexupper": 0.35}
#: Runs that a random source would give this rarely are refused.
REFUSE = 1e-3
#: Share of false discoveries that the step allows.
Q = 0.05
BANDS = (24, 32, 48, 96)
#: Tenths of a power of ten by which chances are counted, down to 1e-300: the step keeps a secret among any number of runs.
BINS = 3000


def upper_tail(z: float) -> float:
    return 0.5 * math.erfc(z / math.sqrt(2))


def encoding_of(run: str) -> int:
    chars = set(run)
    for k, (_, allowed, _, _) in enumerate(_ALPHABETS):
        if chars <= allowed:
            return k
    return -1


def battery(run: str, encoding: int) -> tuple[float, float, float]:
    """Standard scores of uniformity, runs and serial correlation; each about N(0, 1) for random runs."""
    _, _, index, size = _ALPHABETS[encoding]
    x = np.array([index[c] for c in run], dtype=np.float64)
    n = len(x)
    counts = np.bincount(x.astype(np.int64), minlength=size)
    chi = float((counts.astype(np.float64) ** 2).sum()) * size / n - n
    uniform = (chi - (size - 1)) / math.sqrt(2 * (size - 1) * (n - 1) / n)
    high = x >= size / 2
    ones = int(high.sum())
    zeros = n - ones
    if ones and zeros:
        mean = 2 * ones * zeros / n + 1
        var = (mean - 1) * (mean - 2) / (n - 1)
        runs = (1 + int(np.count_nonzero(high[1:] != high[:-1])) - mean) / math.sqrt(var) if var > 0 else 0.0
    else:
        runs = -math.sqrt(n)
    d = x - x.mean()
    var = float(d @ d)
    serial = float(d[1:] @ d[:-1]) / var * math.sqrt(n) if var else math.sqrt(n)
    return uniform, runs, serial


def fisher(ps: list[float]) -> float:
    """The logarithm of the chance that independent chances are together as small as these (Fisher's method)."""
    half = -sum(math.log(max(1e-300, p)) for p in ps)  # twice this is chi-squared with 2 degrees of freedom for each
    return math.log(sum(half**k / math.factorial(k) for k in range(len(ps)))) - half


def text_p(run: str, encoding: int, uniform: float) -> float:
    """Logarithm of the chance that ordinary text gives a run of this length this uniform, this digit-rich and this narrow.

    The uniformity score of text grows with the length, and its spread is that of the share of equal
    pairs: between letters drawn once, and between texts. The chances are combined by Fisher's method.
    Runs without a digit and runs of a wide alphabet are kinds of their own: they have no chance for
    digits or for the alphabet, and those of their kind aren't combined with any. The chance for digits is
    that among runs which have one.
    """
    _, _, _, size = _ALPHABETS[encoding]
    n = len(run)
    base = math.sqrt(2 * (size - 1) * (n - 1) / n)
    mean = (n - 1) * (size * COINCIDENCE - 1) / base
    spread = size * (n - 1) / base * math.sqrt(0.0076 / n + 0.127 / n**2 + SPREAD**2)
    digits = len(_DIGIT.findall(run))
    mu, sd = n * TEXT_DIGITS, math.sqrt(n * TEXT_DIGITS * (1 - TEXT_DIGITS))
    if n > 400:
        rich = upper_tail((digits - 0.5 - mu) / sd)
    else:
        rich = sum(math.comb(n, k) * TEXT_DIGITS**k * (1 - TEXT_DIGITS) ** (n - k) for k in range(digits, n + 1))
    ps = [upper_tail((mean - uniform) / spread)]
    ps += [rich / (1 - (1 - TEXT_DIGITS) ** n)] if digits else []
    ps += [TEXT_SHARE[name] ** n] if (name := ENCODINGS[encoding][0]) in TEXT_SHARE else []
    return fisher([min(1.0, p) for p in ps])


def judge(run: str) -> tuple[int, float] | None:
    """Encoding and the logarithm of p against ordinary text, or None if the battery refuses the run as random.

    Long runs of one character class without digits, and runs with one or two different characters,
    are refused by uniformity or runs; no length from ``MIN_LENGTH`` on is exempt.
    """
    k = encoding_of(run)
    if k < 0:
        return None
    uniform, runs, serial = battery(run, k)
    if fisher([upper_tail(uniform), math.erfc(abs(runs) / math.sqrt(2)), math.erfc(abs(serial) / math.sqrt(2))]) < math.log(REFUSE):
        return None
    return k, text_p(run, k, uniform)


def bin_of(log_p: float) -> int:
    """The bin of a chance: it is at most 10 to the minus a tenth of it."""
    return min(BINS, max(0, int(-10 * log_p / math.log(10))))


def least_bin(tested: int, counts: np.ndarray, q: float) -> int:
    """The least bin that a Benjamini-Hochberg step at level ``q`` keeps among ``tested`` runs; one beyond all if none."""
    above = counts[::-1].cumsum()[::-1]
    bins = np.arange(len(counts))
    kept = np.flatnonzero((above > 0) & (tested * 10.0 ** (-bins / 10) <= q * above))
    return int(kept[0]) if len(kept) else len(counts)


def base_spans(text: str) -> list[tuple[int, int, str]]:
    """(start, end, kind) of the base patterns, by start, then kind as listed."""
    found = [(m.start(), 0, m.end(), "assign") for m in _ASSIGN.finditer(text) if len(m[2]) >= 6] if "=" in text or ":" in text else []
    if "AKIA" in text:
        found += [(m.start(), 1, m.end(), "access") for m in _ACCESS.finditer(text)]
    found += [(m.start(), 2, m.end(), "hex") for m in _HEX.finditer(text)]
    return [(s, e, kind) for s, _, e, kind in sorted(found)]


def candidates(text: str) -> list[dict]:
    """Runs that pass the battery, with their length band and the bin of -10 log10 p."""
    out = []
    for m in _RUN.finditer(text):
        run = m[0]
        if run.isdigit():
            continue  # the null is text: what it tells of a number is only that it isn't text
        got = judge(run)
        if got:
            out.append({"start": m.start(), "end": m.end(), "enc": ENCODINGS[got[0]][0], "band": sum(len(run) >= b for b in BANDS), "bin": bin_of(got[1])})
    return out


def scan(docs: DataFrame, keep: list[str], text_col: str = "text") -> DataFrame:
    """``keep``, ``base`` spans, ``runs`` that passed the battery and ``tested``: runs looked at by band."""

    def make():
        def one(t):
            text = (t or b"").decode()
            tested = [0] * (len(BANDS) + 1)
            for m in _RUN.finditer(text):
                tested[sum(m.end() - m.start() >= b for b in BANDS)] += 1
            return [{"start": s, "end": e, "kind": k} for s, e, k in base_spans(text)], candidates(text), tested

        def apply(texts):
            got = [one(t) for t in texts]
            return {"base": [g[0] for g in got], "runs": [g[1] for g in got], "tested": [g[2] for g in got]}

        return apply

    span = "array<struct<start:bigint,end:bigint,kind:string>>"
    return map_texts(docs, keep, text_col, f"base {span}, runs array<struct<start:bigint,end:bigint,enc:string,band:int,bin:int>>, tested array<bigint>", make)


def cutoffs(scanned: DataFrame, q: float) -> list[int]:
    """For each length band the least bin that a Benjamini-Hochberg step at level ``q`` keeps."""
    bands = len(BANDS) + 1
    tested = scanned.agg(*(F.sum(F.get("tested", F.lit(b))).alias(f"b{b}") for b in range(bands))).first()
    hist = scanned.select(F.explode("runs").alias("r")).groupBy("r.band", "r.bin").count().collect()  # at most bands x bins rows
    counts = np.zeros((bands, BINS + 1))
    for band, bin_, n in hist:
        counts[band, bin_] = n
    return [least_bin(tested[b] or 0, counts[b], q) for b in range(bands)]


def find_secrets(docs: DataFrame, id_col: str = "doc_id", text_col: str = "text", q: float = Q) -> DataFrame:
    """``id_col``, ``base`` and ``spans``: arrays of (start, end, kind), in code points, end exclusive.

    ``spans`` holds all base spans and the runs that the tests keep (kind ``random-<encoding>``).
    Null and empty texts have none; repeated rows agree; a null id is kept; an empty table gives an
    empty result. The scan's result (spans, no text) is checkpointed, as the cut-offs need all of it.
    """
    scanned = cut_lineage(scan(docs, [id_col], text_col))
    least = F.array(*(F.lit(k) for k in cutoffs(scanned, q)))
    kept = F.filter("runs", lambda r: r["bin"] >= F.get(least, r["band"]))
    named = F.transform(kept, lambda r: F.struct(r["start"].alias("start"), r["end"].alias("end"), F.concat(F.lit("random-"), r["enc"]).alias("kind")))
    return scanned.select(id_col, "base", F.concat("base", named).alias("spans"))
