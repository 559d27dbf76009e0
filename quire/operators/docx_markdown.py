"""DOCX parts to Markdown: styles, relations and footnotes are joined, runs become paragraphs, paragraphs a text with pages."""

from __future__ import annotations

from pyspark.sql import Column, DataFrame, Window
from pyspark.sql import functions as F

from quire.functions.text import canonical_doc_id
from quire.operators import cues
from quire.operators.layout import markdown_table

FACETS = ("bold", "italic", "strike", "underline", "color", "highlight", "size", "font")
#: Highlight colours that have another name in a word processor's interface.
HIGHLIGHTS = {"green": "bright_green", "cyan": "turquoise", "magenta": "pink", "darkBlue": "dark_blue", "darkCyan": "teal", "darkGreen": "green", "darkMagenta": "violet", "darkRed": "dark_red", "darkYellow": "dark_yellow", "darkGray": "gray_50", "lightGray": "gray_25"}
DEEPEST = 20


def _facet(name: str) -> Column:
    return F.element_at("facets", name)


def _strip(text: Column) -> Column:
    return F.regexp_replace(text, r"(?U)^\s+|\s+$", "")


def style_facets(parts: DataFrame) -> DataFrame:
    """Every style with what it inherits: ``file``, ``style``, ``name``, and ``FACETS``, each from the nearest style on the way up that sets it.

    One join a level, until none has a parent left; a cycle or more than ``DEEPEST`` levels are an error.
    """
    styles = parts.where("kind = 'style'").select("file", F.col("key").alias("style"), _facet("name").alias("name"), _facet("based_on").alias("parent"), *(_facet(f).alias(f) for f in FACETS))
    above = styles.select("file", F.col("style").alias("parent"), F.col("parent").alias("next"), *(F.col(f).alias(f"up_{f}") for f in FACETS))
    for _ in range(DEEPEST):
        if styles.where("parent is not null").isEmpty():
            return styles.drop("parent")
        met = styles.join(above, ["file", "parent"], "left")
        styles = met.select("file", "style", "name", F.col("next").alias("parent"), *(F.coalesce(f, f"up_{f}").alias(f) for f in FACETS))
    raise ValueError(f"styles inherit over more than {DEEPEST} levels")


def document_runs(parts: DataFrame, inherit: bool = False) -> DataFrame:
    """Runs with their look and image: ``file``, ``block``, ``at``, ``text``, ``FACETS``, ``drawing``, ``target``, ``ends_page``.

    With ``inherit`` a facet that a run doesn't set comes from its own style, else from its paragraph's.
    """
    runs = parts.where("kind = 'run'").select("file", "block", "at", F.col("key").alias("style"), "text", *(_facet(f).alias(f) for f in FACETS), _facet("drawing").alias("drawing"), _facet("embed").alias("embed"), (_facet("break") == "1").alias("ends_page"))
    if inherit:
        styles = style_facets(parts)
        under = lambda k: styles.select("file", F.col("style").alias(f"{k}style"), *(F.col(f).alias(f"{k}{f}") for f in FACETS))
        owner = parts.where("kind = 'paragraph'").select("file", "block", F.col("key").alias("p_style"))
        met = runs.withColumnRenamed("style", "r_style").join(under("r_"), ["file", "r_style"], "left").join(owner, ["file", "block"], "left").join(under("p_"), ["file", "p_style"], "left")
        runs = met.select("file", "block", "at", "text", *(F.coalesce(f, f"r_{f}", f"p_{f}").alias(f) for f in FACETS), "drawing", "embed", "ends_page")
    targets = parts.where("kind = 'relation'").select("file", F.col("key").alias("embed"), F.col("text").alias("target"))
    return runs.join(targets, ["file", "embed"], "left").drop("embed", "style")


def merged_runs(runs: DataFrame) -> DataFrame:
    """Neighbouring runs of equal look as one; drawings stay alone."""
    order = Window.partitionBy("file", "block").orderBy("at")
    look = F.struct(*(F.coalesce(F.col(f), F.lit("")).alias(f) for f in FACETS))
    alone = F.col("drawing").isNotNull() | F.lag("drawing").over(order).isNotNull()
    new = F.coalesce(alone | (look != F.lag(look).over(order)), F.lit(True))
    marked = runs.withColumn("piece", F.sum(new.cast("int")).over(order.rowsBetween(Window.unboundedPreceding, 0)))
    text = F.array_join(F.transform(F.array_sort(F.collect_list(F.struct("at", F.coalesce("text", F.lit("")).alias("text")))), lambda r: r["text"]), "")
    first = [F.first(c).alias(c) for c in (*FACETS, "drawing", "target")]
    return marked.groupBy("file", "block", "piece").agg(F.min("at").alias("at"), text.alias("text"), F.bool_or("ends_page").alias("ends_page"), *first).drop("piece")


def run_markdown() -> Column:
    """A run's Markdown: its cues, then its text in marks, with blanks outside of them."""
    raw = F.coalesce("text", F.lit(""))
    core = _strip(raw)
    marked = core
    for facet in ("strike", "underline", "bold", "italic"):
        marked = F.when(F.col(facet) == "1", cues.marked(marked, facet)).otherwise(marked)
    named = F.coalesce(*(F.when(F.col("highlight") == k, v) for k, v in HIGHLIGHTS.items()), "highlight")
    look = F.concat(cues.described("FONT", size=F.concat(cues.number(F.col("size")), F.lit("pt")), family=F.concat(F.lit('"'), F.col("font"), F.lit('"'))), cues.described("STYLE", color=F.col("color"), highlight=named))
    lead, trail = F.regexp_extract(raw, r"(?U)^\s*", 0), F.regexp_extract(raw, r"(?U)\s*$", 0)
    text = F.when(core == "", raw).otherwise(F.concat(look, lead, marked, trail))
    return F.when(F.col("drawing").isNotNull(), F.concat(F.lit("!["), F.col("drawing"), F.lit("]("), F.coalesce("target", F.lit("media/image")), F.lit(")"))).otherwise(text)


def heading_marks(name: Column) -> Column:
    """``#`` signs for the name of a paragraph style; null for none."""
    low = F.lower(F.trim(name))
    digits = F.regexp_replace(low, r"\D", "").try_cast("int")
    return F.when(low == "title", "#").when(low == "subtitle", "##").when(low.startswith("heading"), F.repeat(F.lit("#"), F.greatest(F.lit(1), F.least(F.lit(6), F.coalesce(digits, F.lit(1))))))


def _in_order(*values: str) -> Column:
    return F.array_sort(F.collect_list(F.struct(*values)))


def docx_markdown(parts: DataFrame, inherit: bool = False, merge: bool = False) -> DataFrame:
    """``file`` and ``markdown``: title, page geometry, headers and footers once each, pages with their blocks, footnotes.

    Runs that set nothing leave no mark (with ``inherit``: that nothing is set for); each has its own
    marks unless ``merge``. Hard page breaks start pages, before or after their paragraph. Empty
    paragraphs leave nothing; only footnotes that are referred to are listed. Unreadable files are left out.
    """
    runs = document_runs(parts, inherit)
    runs = (merged_runs(runs) if merge else runs).withColumn("md", run_markdown())
    bodies = runs.groupBy("file", "block").agg(F.array_join(F.transform(_in_order("at", "md"), lambda r: r["md"]), "").alias("body"), F.sum(F.coalesce("ends_page", F.lit(False)).cast("int")).alias("ends"))
    refs = parts.where("kind = 'note_ref'")
    marks = refs.groupBy("file", "block").agg(F.array_join(F.transform(_in_order("at", "key"), lambda r: F.concat(F.lit("[^"), r["key"], F.lit("]"))), "").alias("marks"))
    style = parts.where("kind = 'style'").select("file", F.col("key").alias("style"), _facet("name").alias("style_name"))
    par = parts.where("kind = 'paragraph'").select("file", "block", F.col("key").alias("style"), _facet("align").alias("align"), (_facet("break_before") == "1").alias("before"))
    par = par.join(bodies, ["file", "block"], "left").join(marks, ["file", "block"], "left").join(style, ["file", "style"], "left")
    text = F.concat(_strip(F.coalesce("body", F.lit(""))), F.coalesce("marks", F.lit("")))
    head = heading_marks(F.col("style_name"))
    side = F.when(F.col("align").isin("center", "both"), "center").when(F.col("align").isin("right", "end"), "right")
    whole = cues.aligned(F.when(head.isNotNull(), F.concat(head, F.lit(" "), text)).otherwise(text), side)
    after = F.when(F.coalesce("ends", F.lit(0)) > 0, 1).otherwise(0)
    paragraphs = par.select("file", "block", F.coalesce(F.col("before"), F.lit(False)).cast("int").alias("before"), after.alias("after"), F.when(text != "", whole).alias("md"))

    cells = parts.where("kind = 'cell'").select("file", "block", _facet("row").cast("int").alias("row"), _facet("col").cast("int").alias("col"), "text")
    rows = cells.groupBy("file", "block", "row").agg(F.transform(_in_order("col", "text"), lambda c: c["text"]).alias("cells"))
    tables = rows.groupBy("file", "block").agg(markdown_table(F.transform(_in_order("row", "cells"), lambda r: r["cells"]), F.max(F.size("cells"))).alias("md"))
    blocks = paragraphs.unionByName(tables.select("file", "block", F.lit(0).alias("before"), F.lit(0).alias("after"), "md"))

    order = Window.partitionBy("file").orderBy("block").rowsBetween(Window.unboundedPreceding, 0)
    started = F.sum(F.col("before") + F.col("after")).over(order)
    page = (F.lit(1) + started - F.col("after")).alias("page")
    turn = lambda n: F.concat(cues.page_break(n), F.lit("\n\n## Page "), n.cast("string"), F.lit("\n"))
    placed = blocks.select("file", "block", "before", "after", "md", page)
    piece = F.array_compact(F.array(F.when(F.col("before") == 1, turn(F.col("page"))), F.col("md"), F.when(F.col("after") == 1, turn(F.col("page") + 1))))
    body = placed.select("file", "block", piece.alias("pieces")).groupBy("file").agg(F.flatten(F.transform(_in_order("block", "pieces"), lambda b: b["pieces"])).alias("body"))

    inch = lambda name: F.bround(_facet(name).try_cast("double") / 1440, 2).cast("string")
    sized = F.when(inch("width").isNotNull() & inch("height").isNotNull(), cues.cue("DOC_META", cues.attributes(size=F.concat(inch("width"), F.lit("x"), inch("height"), F.lit("in")), orientation=F.coalesce(_facet("orient"), F.lit("portrait")))))
    margin = cues.described("LAYOUT_MARGIN", **{side: F.concat(inch(side), F.lit("in")) for side in ("top", "bottom", "left", "right")})
    geometry = parts.where("kind = 'section' and at = 0").select("file", F.array_compact(F.array(sized, F.when(margin != "", margin))).alias("geometry"))
    region = F.when(F.col("key") == "header", F.concat(cues.cue("HEADER_START"), F.lit("\n"), F.col("text"), F.lit("\n"), cues.cue("HEADER_END"))).otherwise(F.concat(cues.cue("FOOTER_START"), F.lit("\n"), F.col("text"), F.lit("\n"), cues.cue("FOOTER_END")))
    seen = parts.where("kind = 'region' and text <> ''").select("file", (F.col("at") * 2 + (F.col("key") == "footer").cast("int")).alias("n"), region.alias("md")).groupBy("file", "md").agg(F.min("n").alias("n"))
    regions = seen.groupBy("file").agg(F.transform(_in_order("n", "md"), lambda r: r["md"]).alias("regions"))
    notes = parts.where("kind = 'note' and text <> ''").select("file", "key", "text").join(refs.select("file", "key").distinct(), ["file", "key"])
    listed = notes.groupBy("file").agg(F.array_sort(F.collect_list(F.concat(F.lit("[^"), F.col("key"), F.lit("]: "), F.col("text")))).alias("notes"))

    files = parts.where("kind <> 'error'").select("file").distinct()
    met = files.join(geometry, "file", "left").join(regions, "file", "left").join(body, "file", "left").join(listed, "file", "left")
    none = F.array().cast("array<string>")
    every = F.concat(F.array(F.concat(F.lit("# "), canonical_doc_id(F.col("file")))), F.coalesce("geometry", none), F.coalesce("regions", none), F.array(F.lit("\n## Page 1\n")), F.coalesce("body", none), F.when(F.col("notes").isNotNull(), F.concat(F.array(F.lit("")), F.col("notes"))).otherwise(none))
    return met.select("file", F.concat(_strip(F.array_join(every, "\n")), F.lit("\n")).alias("markdown"))
