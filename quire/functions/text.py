"""Column functions on text: white space, normal forms, label folding, decode sanity, edit distances."""

from __future__ import annotations

import unicodedata

import pandas as pd
from pyspark.sql import Column
from pyspark.sql import functions as F
from pyspark.sql.types import IntegerType, StringType

#: White space as Unicode has it, and the four separators that Java's class leaves out.
SPACE = r"(?U)[\s\x1c-\x1f]"
_NON_ASCII = r"[^\x00-\x7F]"


@F.pandas_udf(StringType())
def _nfc(s: pd.Series) -> pd.Series:
    return s.map(lambda x: unicodedata.normalize("NFC", x), na_action="ignore")


@F.pandas_udf(StringType())
def _fold(s: pd.Series) -> pd.Series:
    return s.map(lambda x: unicodedata.normalize("NFC", x).replace(" ", " ").casefold(), na_action="ignore")


def strip_ws(text: Column) -> Column:
    """Without white space at either end, no-break space included."""
    return F.regexp_replace(text, rf"{SPACE}+\z|\A{SPACE}+", "")


def collapse_ws(text: Column) -> Column:
    """Runs of white space become one space; none at the ends."""
    return F.trim(F.regexp_replace(text, f"{SPACE}+", " "))


def nfc(text: Column) -> Column:
    """Unicode normal form C; ASCII text never leaves the JVM."""
    return F.when(text.rlike(_NON_ASCII), _nfc(text)).otherwise(text)


def normalize_text(text: Column, lowercase: bool = False) -> Column:
    out = nfc(text)
    return collapse_ws(F.lower(out) if lowercase else out)


def fold_label(label: Column) -> Column:
    """Key under which labels are the same: NFC, no-break space as space, case-folded, single spaces; null if blank."""
    folded = F.when(label.rlike(_NON_ASCII), _fold(label)).otherwise(F.lower(label))
    return F.nullif(collapse_ws(folded), F.lit(""))


def approx_tokens(text: Column, chars_per_token: int = 4) -> Column:
    """A tokenizer-free estimate, one token at least."""
    return F.greatest(F.lit(1), F.floor(F.length(text) / chars_per_token)).cast("bigint")


def letters(text: Column) -> Column:
    return F.length(F.regexp_replace(text, r"[^\p{L}]", ""))


def alpha_ratio(text: Column) -> Column:
    """Letters among all characters, 0 for an empty text."""
    return F.coalesce(F.try_divide(letters(text), F.length(text)), F.lit(0.0))


def garbled_share(text: Column) -> Column:
    """Replacement, control, format, private and unassigned characters among all non-space ones."""
    solid = F.regexp_replace(text, f"{SPACE}+", "")
    bad = F.length(F.regexp_replace(solid, r"[^\p{Cc}\p{Cf}\p{Co}\p{Cn}\x{FFFD}]", ""))
    return F.coalesce(F.try_divide(bad, F.length(solid)), F.lit(0.0))


def looks_garbled(text: Column, limit: float = 0.15) -> Column:
    return garbled_share(text) > limit


def misread_letters(right: str = "cp1250", wrong: str = "cp1252", language: str = "áčďéěíňóřšťúůýžÁČĎÉĚÍŇÓŘŠŤÚŮÝŽ") -> dict[str, str]:
    """What each letter of a language looks like when its bytes are read in another code page."""
    out = {}
    for c in language:
        try:
            seen = c.encode(right).decode(wrong)
        except UnicodeDecodeError:
            continue
        if seen != c and seen not in language:
            out[seen] = c
    return out


def decode_sanity(text: Column, misread: dict[str, str] | None = None) -> Column:
    """struct(letters, hits, score, garbage): letters that are misreadings of another code page.

    ``score`` is the share of letters that aren't misreadings, 1 without letters; ``garbage`` means
    two hits or more, or a score under 0.90.
    """
    table = "".join(misread if misread is not None else misread_letters())
    hits = F.length(F.regexp_replace(text, f"[^{table}]", ""))
    n = F.length(F.regexp_replace(text, rf"[^\p{{L}}{table}]", ""))
    score = F.coalesce(1 - F.try_divide(hits, n), F.lit(1.0))
    return F.struct(n.alias("letters"), hits.alias("hits"), score.alias("score"), ((hits >= 2) | (score < 0.90)).alias("garbage"))


def recover_misread(text: Column, misread: dict[str, str] | None = None) -> Column:
    """The text with misread letters put right."""
    table = misread if misread is not None else misread_letters()
    return F.translate(text, "".join(table), "".join(table.values()))


# edit distances -------------------------------------------------------------------------------


def cer(ref: Column, hyp: Column) -> Column:
    """Edits per reference character of normalised texts; against an empty reference 0 or 1."""
    return F.when(F.length(ref) == 0, F.when(F.length(hyp) == 0, 0.0).otherwise(1.0)).otherwise(F.levenshtein(ref, hyp) / F.length(ref))


def ned(ref: Column, hyp: Column) -> Column:
    """Edits per character of the longer text; 0 for two empty ones."""
    longest = F.greatest(F.length(ref), F.length(hyp))
    return F.coalesce(F.try_divide(F.levenshtein(ref, hyp), longest), F.lit(0.0))


@F.pandas_udf(IntegerType())
def _word_distance(ref: pd.Series, hyp: pd.Series) -> pd.Series:
    import numpy as np

    def one(a, b):
        a, b = a.split(), b.split()
        if not a or not b:
            return len(a) + len(b)
        ids: dict[str, int] = {}
        x = [ids.setdefault(w, len(ids)) for w in a]
        y = np.array([ids.setdefault(w, len(ids)) for w in b])
        row, steps = np.arange(len(y) + 1), np.arange(len(y) + 1)
        for i, c in enumerate(x, 1):
            best = np.concatenate(([i], np.minimum(row[1:] + 1, row[:-1] + (y != c))))
            row = np.minimum.accumulate(best - steps) + steps  # insertions run along the row
        return int(row[-1])

    return pd.Series([None if a is None or b is None else one(a, b) for a, b in zip(ref, hyp, strict=True)], dtype="Int32")


def word_distance(ref: Column, hyp: Column, packed_words: int = 2000) -> Column:
    """Edits between the words of two texts with single spaces.

    Each different word becomes one character of the basic plane, and the built-in edit distance
    counts these. Longer texts, for which looking words up by position would be quadratic, and more
    different words than that plane has go to an Arrow function.
    """
    r, h = F.split(ref, " "), F.split(hyp, " ")
    r, h = F.array_remove(r, ""), F.array_remove(h, "")
    words = F.array_distinct(F.concat(r, h))
    code = lambda a: F.decode(F.unhex(F.array_join(F.transform(a, lambda w: F.lpad(F.hex(F.array_position(words, w) + 32), 4, "0")), "")), "UTF-16BE")
    short = F.size(r) + F.size(h) <= packed_words
    return F.when(short, F.levenshtein(code(r), code(h))).otherwise(_word_distance(ref, hyp))


def wer(ref: Column, hyp: Column) -> Column:
    """Edits per reference word of normalised texts; against a wordless reference 0 or 1."""
    n = F.size(F.array_remove(F.split(ref, " "), ""))
    m = F.size(F.array_remove(F.split(hyp, " "), ""))
    return F.when(n == 0, F.when(m == 0, 0.0).otherwise(1.0)).otherwise(word_distance(ref, hyp) / n)


# documents ------------------------------------------------------------------------------------

#: Suffixes that belong to a file's kind and not to its document, longest first.
DOCUMENT_SUFFIXES = (".teitok.xml", ".alto.xml", ".document.json", "_enriched.json", ".conllu", ".docx", ".json", ".xml", ".csv", ".pdf", ".txt", ".md")


def canonical_doc_id(path: Column) -> Column:
    """The file name without its longest known suffix, or up to its first dot."""
    name = F.regexp_replace(path, r"\A.*[/\\]", "")
    known = "|".join(s.replace(".", r"\.") for s in DOCUMENT_SUFFIXES)
    return F.when(F.lower(name).rlike(f"(?:{known})$"), F.regexp_replace(name, f"(?i)(?:{known})$", "")).otherwise(F.substring_index(name, ".", 1))


def best_effort_int(value: Column, default: int = 0) -> Column:
    """An integer from text such as ``7`` or ``7.0``; ``default`` for anything else."""
    return F.coalesce(value.try_cast("int"), value.try_cast("double").try_cast("int"), F.lit(default))
