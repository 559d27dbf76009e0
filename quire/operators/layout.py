"""Layout: paragraph and block grouping, page quality, boxes, scales, and Markdown."""

from __future__ import annotations

from pyspark.sql import Column, DataFrame, Window
from pyspark.sql import functions as F


def paragraph_groups(lines: DataFrame, page: tuple[str, ...] = ("doc_id", "page"), factor: float = 1.8) -> DataFrame:
    """``group_id`` of positioned lines: a gap above ``factor`` times the page's low gap starts a new one.

    Lines are taken in reading order (``row_idx``), so the columns of a page stay apart; a line that
    stands higher than the one before has no gap. The low gap is the element at a quarter of the sorted positive gaps. Pages with fewer than two
    positioned lines, and lines without a position, have no group.
    """
    keys = list(page)
    order = Window.partitionBy(*keys).orderBy("row_idx")
    placed = lines.where("y0 is not null").withColumn("gap", F.greatest(F.lit(0.0), F.col("y0") - F.lag("y1").over(order)))
    gaps = F.array_sort(F.collect_list(F.when(F.col("gap") > 0, F.col("gap"))))
    base = placed.groupBy(*keys).agg(F.count("*").alias("__n"), gaps.alias("__g")).select(*keys, "__n", F.get("__g", F.expr("cast(size(__g) div 4 as int)")).alias("__low"))
    starts = F.when(F.coalesce(F.col("gap") > factor * F.col("__low"), F.lit(False)), 1).otherwise(0)
    run = F.sum(starts).over(order.rowsBetween(Window.unboundedPreceding, 0))
    grouped = placed.join(base, keys).where("__n >= 2").withColumn("group_id", run)
    return lines.join(grouped.select(*keys, "row_idx", "group_id"), [*keys, "row_idx"], "left")


def text_blocks(lines: DataFrame, page: tuple[str, ...] = ("doc_id", "page"), factor: float = 1.4, floor: float = 3.0, size_step: float = 1.5) -> DataFrame:
    """``block_id``: a new block after a gap above max(factor x median height, floor), or with the font size; in reading order."""
    keys = list(page)
    order = Window.partitionBy(*keys).orderBy("row_idx")
    median = F.median(F.col("y1") - F.col("y0")).over(Window.partitionBy(*keys))
    marked = lines.withColumn("__h", median).withColumn("__gap", F.col("y0") - F.lag("y1").over(order)).withColumn("__ds", F.abs(F.col("size") - F.lag("size").over(order)))
    new = F.coalesce((F.col("__gap") > F.greatest(F.lit(factor) * F.col("__h"), F.lit(floor))) | (F.col("__ds") >= size_step), F.lit(False))
    run = F.sum(F.when(new, 1).otherwise(0)).over(order.rowsBetween(Window.unboundedPreceding, 0))
    return marked.withColumn("block_id", run).drop("__h", "__gap", "__ds")


def box_union(boxes: DataFrame, by: list[str]) -> DataFrame:
    """The smallest box around all boxes of a group."""
    return boxes.groupBy(*by).agg(F.min("x0").alias("x0"), F.min("y0").alias("y0"), F.max("x1").alias("x1"), F.max("y1").alias("y1"))


def outside_tables(lines: DataFrame, tables: DataFrame, page: tuple[str, ...] = ("doc_id", "page")) -> DataFrame:
    """Lines whose vertical middle isn't inside a table of their page that they overlap sideways."""
    keys = list(page)
    t = tables.select(*keys, *(F.col(c).alias(f"t_{c}") for c in ("x0", "y0", "x1", "y1")))
    middle = (F.col("y0") + F.col("y1")) / 2
    inside = (middle >= F.col("t_y0")) & (middle <= F.col("t_y1")) & (F.col("x0") < F.col("t_x1")) & (F.col("x1") > F.col("t_x0"))
    cond = inside
    for k in keys:
        cond = cond & lines[k].eqNullSafe(t[k])
    return lines.join(t, cond, "left_anti")


def page_quality(lines: DataFrame, page: tuple[str, ...] = ("doc_id", "page")) -> DataFrame:
    """Mean score (1 without lines), band, and whether the page needs OCR because a line decoded to garbage."""
    score = F.coalesce(F.bround(F.avg("score"), 4), F.lit(1.0))
    out = lines.groupBy(*page).agg(score.alias("quality_score"), F.count_if(F.col("categ") == "Garbage").alias("n_garbage"), F.count("*").alias("n_lines"))
    band = F.when(F.col("quality_score") >= 0.90, "Clear").when(F.col("quality_score") >= 0.50, "Noisy").otherwise("Trash")
    reason = F.when(F.col("n_garbage") > 0, F.format_string("%d of %d lines decode to garbage", "n_garbage", "n_lines"))
    return out.withColumn("quality_band", band).withColumn("needs_ocr", F.col("n_garbage") > 0).withColumn("needs_ocr_reason", reason)


def dominant(rows: DataFrame, by: list[str], value: str, order: str) -> DataFrame:
    """Per group the most frequent value, the first seen of equally frequent ones."""
    counts = rows.groupBy(*by, value).agg(F.count("*").alias("n"), F.min(order).alias("__first"))
    return counts.groupBy(*by).agg(F.max_by(F.struct(value, "n"), F.struct("n", -F.col("__first"))).alias("m")).select(*by, f"m.{value}", "m.n")


def scaled(value: Column, offset: Column, scale: Column) -> Column:
    """(value - offset) * scale, rounded half to even; null for what isn't a number."""
    return F.bround((value.try_cast("double") - offset) * scale).cast("bigint")


def dpi_scale(unit: Column, dpi: Column, pixel_dpi: Column) -> Column:
    """Pixels per unit of the measurement units of page XML."""
    return F.when(unit == "inch1200", dpi / 1200).when(unit == "mm10", dpi / 254).when(unit == "pixel", dpi / pixel_dpi).otherwise(F.lit(1.0))


def page_scale(image: Column, page: Column, by_dpi: Column) -> Column:
    """Image size over page size, else the scale from the resolution, else 1."""
    return F.coalesce(F.try_divide(image, page), by_dpi, F.lit(1.0))


def box_of(text: Column) -> Column:
    """Four numbers of a box attribute as integers, null if there aren't four."""
    parts = F.transform(F.split(F.trim(text), r"[\s,]+"), lambda p: p.try_cast("double").cast("bigint"))
    return F.when((F.size(parts) == 4) & ~F.exists(parts, lambda p: p.isNull()), parts)


def readable(lines: DataFrame, min_quality: float = 0.0) -> DataFrame:
    """Lines to render: not garbage or mirrored, good enough (no score passes), with text and a page."""
    keep = ~F.coalesce(F.col("categ"), F.lit("")).isin("Garbage", "Inverted") & F.coalesce(F.col("quality_score") >= min_quality, F.lit(True))
    return lines.where(keep & (F.length(F.trim(F.coalesce("text", F.lit("")))) > 0) & F.col("page").isNotNull())


def markdown(lines: DataFrame, doc: str = "doc_id") -> DataFrame:
    """One Markdown text per document: headings marked, page breaks between pages, groups as paragraphs."""
    order = Window.partitionBy(doc).orderBy("row_idx")
    new_page = F.coalesce(~F.col("page").eqNullSafe(F.lag("page").over(order)), F.lit(True))
    new_group = ~F.col("group_id").eqNullSafe(F.lag("group_id").over(order))
    head = F.when(F.col("categ").isin("Header", "Heading"), F.concat(F.lit("## "), F.trim("text"))).otherwise(F.trim("text"))
    body = lines.select(doc, "row_idx", "page", new_page.alias("np"), new_group.alias("ng"), head.alias("t"))
    cue = F.when(F.col("np"), F.concat(F.lit("<!-- page "), F.col("page").cast("string"), F.lit(" -->\n\n"))).when(F.col("ng"), "\n").otherwise("")
    piece = F.array_sort(F.collect_list(F.struct("row_idx", F.concat(cue, F.col("t")).alias("m"))))
    return body.groupBy(doc).agg(F.array_join(F.transform(piece, lambda p: p["m"]), "\n").alias("markdown"))


def escape_cell(text: Column) -> Column:
    """Text for a Markdown table cell."""
    out = F.replace(F.replace(F.coalesce(text, F.lit("")), F.lit("\\"), F.lit("\\\\")), F.lit("|"), F.lit("\\|"))
    return F.trim(F.regexp_replace(out, r"\r?\n", "<br>"))


def markdown_table(rows: Column, width: Column) -> Column:
    """A table from an array of rows, each an array of cells, the first as its head; short rows are filled up."""
    line = lambda cells: F.concat(F.lit("| "), F.array_join(cells, " | "), F.lit(" |"))
    full = F.transform(rows, lambda r: line(F.transform(F.slice(F.concat(r, F.array_repeat(F.lit(""), width)), F.lit(1), width), escape_cell)))
    rule = line(F.array_repeat(F.lit("---"), width))
    return F.array_join(F.concat(F.slice(full, 1, 1), F.array(rule), F.slice(full, F.lit(2), F.greatest(F.lit(0), F.size(full) - 1))), "\n")
