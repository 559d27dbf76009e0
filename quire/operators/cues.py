"""Layout cues: what a page looked like, as comments and inline marks of Markdown. All are column functions.

A cue is ``<!-- NAME: body -->``; an attribute without a value is left out of the body.
"""

from __future__ import annotations

from pyspark.sql import Column, DataFrame
from pyspark.sql import functions as F

# The names of comment cues, and the inline marks.
COMMENTS = (
    "PAGE_BREAK", "DOC_META", "LAYOUT_MARGIN", "LAYOUT_COLUMN", "BBOX", "INDENT", "FONT", "STYLE",
    "HEADER_START", "HEADER_END", "FOOTER_START", "FOOTER_END", "WATERMARK", "NEEDS_OCR", "OCR",
)
MARKS = {"bold": ("**", "**"), "italic": ("*", "*"), "strike": ("~~", "~~"), "underline": ("<u>", "</u>")}


def cue(name: str, body: Column | None = None) -> Column:
    """One comment; a null body gives null."""
    if name not in COMMENTS:
        raise ValueError(f"no such cue: {name}")
    return F.lit(f"<!-- {name} -->") if body is None else F.concat(F.lit(f"<!-- {name}: "), body, F.lit(" -->"))


def number(value: Column) -> Column:
    """Up to six significant digits, without a fraction of zero."""
    value = value.cast("double")
    shift = F.pow(F.lit(10.0), F.lit(5) - F.floor(F.log10(F.abs(value))))
    short = F.regexp_replace((F.round(value * shift) / shift).cast("decimal(38,12)").cast("string"), r"\.?0+$", "")
    return F.when(value == F.floor(value), value.cast("bigint").cast("string")).otherwise(short)


def attributes(**values: Column) -> Column:
    """``key=value`` pairs in the order given, without null and empty values; an underscore in a key stands for a hyphen."""
    pairs = [F.when(v.cast("string") != "", F.concat(F.lit(k.replace("_", "-") + "="), v.cast("string"))) for k, v in values.items()]
    return F.concat_ws(", ", *pairs)


def page_id(label: Column) -> Column:
    """``pg_`` and the label, which may have the prefix already; ``pg_?`` without a label."""
    name = F.trim(F.coalesce(label.cast("string"), F.lit("")))
    return F.when(name == "", "pg_?").when(name.startswith("pg_"), name).otherwise(F.concat(F.lit("pg_"), name))


def page_break(label: Column) -> Column:
    return cue("PAGE_BREAK", page_id(label))


def needs_ocr(label: Column, reason: Column | None = None) -> Column:
    """The page whose text layer can't be used, with the reason."""
    why = F.lit("no extractable text layer") if reason is None else F.coalesce(reason, F.lit("no extractable text layer"))
    return cue("NEEDS_OCR", F.concat(page_id(label), F.lit(" ("), why, F.lit(")")))


def column_of(index: Column, total: Column) -> Column:
    return cue("LAYOUT_COLUMN", F.concat(index.cast("string"), F.lit("_of_"), total.cast("string")))


def box(x0: Column, y0: Column, x1: Column, y1: Column) -> Column:
    """The box in whole numbers, halves to even; null if a corner is."""
    sides = [F.bround(c.cast("double")).cast("bigint").cast("string") for c in (x0, y0, x1, y1)]
    known = x0.isNotNull() & y0.isNotNull() & x1.isNotNull() & y1.isNotNull()
    return F.when(known, cue("BBOX", F.concat(F.lit("["), F.concat_ws(", ", *sides), F.lit("]"))))


def indent(pixels: Column) -> Column:
    return cue("INDENT", F.concat(number(pixels), F.lit("px")))


def described(name: str, **values: Column) -> Column:
    """A cue of attributes; an empty string if none has a value."""
    body = attributes(**values)
    return F.when(body == "", "").otherwise(cue(name, body))


def font(size: Column, weight: Column, family: Column) -> Column:
    quoted = F.when(family != "", F.concat(F.lit('"'), family, F.lit('"')))
    return described("FONT", size=F.concat(number(size), F.lit("pt")), weight=weight, family=quoted)


def watermark(text: Column) -> Column:
    return cue("WATERMARK", F.concat(F.lit('"'), text, F.lit('"')))


def marked(text: Column, mark: str) -> Column:
    """Text between the marks of ``MARKS``; blank text stays as it is."""
    left, right = MARKS[mark]
    return F.when(F.trim(text) == "", text).otherwise(F.concat(F.lit(left), text, F.lit(right)))


def aligned(text: Column, align: Column) -> Column:
    """A block with its alignment; left is the default and leaves no trace."""
    whole = F.concat(F.lit('<div align="'), align, F.lit('">\n'), text, F.lit("\n</div>"))
    return F.when(F.coalesce(align, F.lit("")).isin("", "left"), text).otherwise(whole)


def ocr_paragraphs(words: DataFrame, page: tuple[str, ...] = ("doc_id", "page"), scale: float = 1.0, min_conf: float = 0.0) -> DataFrame:
    """Recognised words to paragraphs: one row per (block_num, par_num) of a page with its text and scaled box.

    Blank words go, and so do those below ``min_conf``, a confidence that can't be read counting as -1.
    ``row_idx`` is the order of words; paragraphs are in order of their first word.
    """
    sure = F.coalesce(F.col("conf").try_cast("double"), F.lit(-1.0)) >= min_conf
    kept = words.withColumn("text", F.trim(F.coalesce("text", F.lit("")))).where((F.col("text") != "") & sure)
    # dealt out before they are grouped: grouping where they are read would sort, and spill, all words of a large file
    kept = kept.select(*page, "block_num", "par_num", "row_idx", "text", "left", "top", "width", "height").repartition(*page, "block_num", "par_num")
    ordered = F.sort_array(F.collect_list(F.struct("row_idx", "text")))
    edge = lambda c: F.bround(c * scale).cast("bigint")
    return kept.groupBy(*page, "block_num", "par_num").agg(
        F.min("row_idx").alias("row_idx"),
        F.array_join(F.transform(ordered, lambda w: w["text"]), " ").alias("text"),
        edge(F.min("left")).alias("x0"),
        edge(F.min("top")).alias("y0"),
        edge(F.max(F.col("left") + F.col("width"))).alias("x1"),
        edge(F.max(F.col("top") + F.col("height"))).alias("y1"),
    )


def cell_lines(cells: DataFrame, lines: DataFrame, cell: tuple[str, ...] = ("table_id", "row", "col")) -> DataFrame:
    """(doc_id, cell keys, row_idx, text): the lines of table cells.

    A cell with ``lines`` (an array of line numbers) has these; otherwise the lines of its
    ``group_id``; with neither it has none.
    """
    texts = lines.select("doc_id", "row_idx", "text")
    listed = cells.where(F.size("lines") > 0).select("doc_id", *cell, F.explode("lines").alias("row_idx")).join(texts, ["doc_id", "row_idx"])
    grouped = cells.where(F.coalesce(F.size("lines"), F.lit(0)) <= 0).select("doc_id", *cell, "group_id").join(lines.select("doc_id", "group_id", "row_idx", "text"), ["doc_id", "group_id"])
    return listed.select("doc_id", *cell, "row_idx", "text").unionByName(grouped.select("doc_id", *cell, "row_idx", "text"))
