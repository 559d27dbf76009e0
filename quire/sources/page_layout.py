"""Page layout of ALTO and TEITOK files: one scan of each file to rows of parts, and the tables that they hold.

Parts meet by ordinal: the n-th of a kind in its file. A file that breaks off gives the parts before the
break and one of kind ``error``.
"""

from __future__ import annotations

import io
import xml.etree.ElementTree as ET
from collections.abc import Callable, Iterator

import pandas as pd
from pyspark.sql import Column, DataFrame, SparkSession
from pyspark.sql import functions as F

#: ``n`` counts the parts of a kind from 1; ``page`` is the ordinal of the page (ALTO) or its number (TEITOK).
PARTS = "file string, kind string, n bigint, page int, key string, box array<bigint>, facets map<string,string>, text string"
#: Elements that hold graphics, and the facts of a description.
GRAPHICS = ("Illustration", "GraphicalElement")
FACTS = {"fileName": "source_image", "MeasurementUnit": "measurement_unit", "processingDateTime": "ocr_date", "softwareName": "ocr_software", "softwareVersion": "ocr_version"}


def _number(text: str | None) -> float:
    return float(text or 0)


def _alto_box(e: ET.Element) -> list[int] | None:
    """Left, top, right and bottom in whole units; missing sides are 0, and a side that is no number makes no box."""
    try:
        x, y, w, h = (_number(e.get(k)) for k in ("HPOS", "VPOS", "WIDTH", "HEIGHT"))
        return [int(x), int(y), int(x + w), int(y + h)]
    except (ValueError, OverflowError):
        return None


def alto_parts(content: bytes) -> Iterator[tuple]:
    """(kind, page, key, box, facets, text) in document order; attributes are known when an element opens."""
    page, block, line = 0, (None, None), (None, None)
    open_: list[str] = []
    spaced = False
    for event, e in ET.iterparse(io.BytesIO(content), ("start", "end")):
        tag = e.tag.rpartition("}")[2]
        if event == "end":
            if tag in FACTS and "Description" in open_ and (tag in ("fileName", "MeasurementUnit") or "ocrProcessingStep" in open_) and (e.text or "").strip():
                yield "meta", None, FACTS[tag], None, {}, e.text.strip()
            open_.pop()
            e.clear()
            continue
        open_.append(tag)
        if tag == "Page":
            page, spaced = page + 1, False
            yield "page", page, e.get("ID", f"Page{page}"), None, {"width": e.get("WIDTH") or "", "height": e.get("HEIGHT") or ""}, None
        elif tag == "PrintSpace" and page and not spaced:
            spaced = True
            try:
                box = [int(_number(e.get(k))) for k in ("HPOS", "VPOS", "WIDTH", "HEIGHT")]
            except (ValueError, OverflowError):
                box = None
            yield "space", page, None, box, {}, None
        elif tag == "TextBlock" and page:
            block, line = (e.get("ID", ""), _alto_box(e)), (None, None)
            yield "block", page, block[0], block[1], {}, None
        elif tag == "TextLine" and page:
            line = (e.get("ID", ""), _alto_box(e))
            yield "line", page, line[0], line[1], {"block": block[0]}, None
        elif tag == "String" and "TextLine" in open_ and e.get("CONTENT") and (box := _alto_box(e)):
            yield "string", page, None, box, {"block": block[0], "line": line[0], "line_box": None if line[1] is None else " ".join(map(str, line[1]))}, e.get("CONTENT")
        elif tag in GRAPHICS and page and (box := _alto_box(e)):
            yield "graphic", page, e.get("ID", ""), box, {"type": tag}, None


def _box_attr(text: str | None) -> list[int] | None:
    try:
        box = [int(float(v)) for v in (text or "").replace(",", " ").split()]
    except (ValueError, OverflowError):
        return None
    return box if len(box) == 4 else None


def _sentence(e: ET.Element) -> tuple[str, list[int] | None]:
    """A sentence's text, given or put together, and the box around its tokens."""
    tokens = [t for t in e.iter() if t.tag.rpartition("}")[2] == "tok"]
    joined = "".join((t.text or "") + ("" if t.get("join") == "right" or t.get("spaceAfter") == "No" else " ") for t in tokens)
    boxes = [b for t in tokens if (b := _box_attr(t.get("bbox")))]
    around = [f(b[k] for b in boxes) for k, f in enumerate((min, min, max, max))] if boxes else None
    return e.get("text") or joined.strip(), around


def teitok_parts(content: bytes) -> Iterator[tuple]:
    """(kind, page, key, box, facets, text): rows where their sentence begins, page breaks, surfaces and figures."""
    page = line = 1
    begun: list[tuple[int, int]] = []
    for event, e in ET.iterparse(io.BytesIO(content), ("start", "end")):
        tag = e.tag.rpartition("}")[2]
        if event == "end":
            if tag == "s":
                at = begun.pop()
                text, box = _sentence(e)
                if text:
                    yield "row", at[0], None, box, {"line": str(at[1])}, text
                e.clear()
        elif tag == "s":
            begun.append((page, line))
        elif tag == "surface":
            try:
                size = {"width": str(int(float(e.get("lrx") or ""))), "height": str(int(float(e.get("lry") or "")))}
            except (ValueError, OverflowError):
                size = {}
            yield "surface", None, e.get("id"), None, size, None
        elif tag == "pb":
            try:
                page = int(e.get("n", page + 1))
            except ValueError:
                page += 1
            yield "break", page, e.get("n"), None, {}, None
        elif tag == "lb":
            line += 1
        elif tag == "figure" and (box := _box_attr(e.get("bbox"))):
            yield "figure", page, e.get("id"), box, {"type": e.get("type", "")}, None


def _read(spark: SparkSession, path: str, walk: Callable[[bytes], Iterator[tuple]]) -> DataFrame:
    def run(frames: Iterator[pd.DataFrame]) -> Iterator[pd.DataFrame]:
        for frame in frames:
            for file, content in zip(frame["path"], frame["content"], strict=True):
                rows, seen = [], {}
                try:
                    for kind, *rest in walk(content):
                        seen[kind] = seen.get(kind, 0) + 1
                        rows.append((file, kind, seen[kind], *rest))
                except ET.ParseError as e:
                    rows.append((file, "error", 1, None, None, None, {}, str(e)))
                out = pd.DataFrame(rows, columns=["file", "kind", "n", "page", "key", "box", "facets", "text"])
                out["facets"] = [{k: v for k, v in f.items() if v is not None} for f in out["facets"]]
                yield out.astype({"n": "Int64", "page": "Int32"})

    files = spark.read.format("binaryFile").option("recursiveFileLookup", True).load(path).select("path", "content")
    return files.mapInPandas(run, PARTS)


def read_alto_parts(spark: SparkSession, path: str) -> DataFrame:
    return _read(spark, path, alto_parts)


def read_teitok_parts(spark: SparkSession, path: str) -> DataFrame:
    return _read(spark, path, teitok_parts)


def _facet(name: str) -> Column:
    return F.element_at("facets", name)


def alto_strings(parts: DataFrame) -> DataFrame:
    """Words with their boxes and the block and line they stand in; those without text or a box aren't here."""
    sides = [F.get("box", F.lit(k)).alias(c) for k, c in enumerate(("x0", "y0", "x1", "y1"))]
    line_box = F.transform(F.split(_facet("line_box"), " "), lambda v: v.cast("double"))
    return parts.where("kind = 'string'").select("file", F.col("n").alias("seq"), F.col("page").alias("page_num"), F.col("text").alias("content"), *sides, _facet("block").alias("block_id"), _facet("line").alias("line_id"), line_box.alias("line_box"))


def alto_pages(parts: DataFrame) -> DataFrame:
    """Pages by their ordinal, with the size as given and the offset and size of the print space, 0 without one."""
    space = parts.where("kind = 'space'").select("file", "page", F.col("box").alias("s"))
    pages = parts.where("kind = 'page'").select("file", "page", F.col("key").alias("page_id"), _facet("width").alias("width"), _facet("height").alias("height"))
    own = [F.coalesce(F.get("s", F.lit(k)), F.lit(0)).alias(f"space_{c}") for k, c in enumerate(("x", "y", "width", "height"))]
    return pages.join(space, ["file", "page"], "left").select("file", F.col("page").alias("page_num"), "page_id", "width", "height", *own)


def alto_blocks(parts: DataFrame) -> DataFrame:
    """The last box that a block id has in its file."""
    blocks = parts.where("kind = 'block' and box is not null")
    return blocks.groupBy("file", F.col("key").alias("block_id")).agg(F.max_by("box", "n").alias("box"))


def alto_graphics(parts: DataFrame) -> DataFrame:
    return parts.where("kind = 'graphic'").select("file", F.col("page").alias("page_num"), F.col("key").alias("id"), _facet("type").alias("type"), "box")


def alto_meta(parts: DataFrame) -> DataFrame:
    """One row per file: source image, unit (pixel if none is given) and the last processing step."""
    facts = parts.groupBy("file").agg(*(F.max_by(F.when(F.col("key") == f, F.col("text")), F.when((F.col("kind") == "meta") & (F.col("key") == f), F.col("n"))).alias(f) for f in dict.fromkeys(FACTS.values())), F.max(F.when(F.col("kind") == "error", F.col("text"))).alias("error"))
    return facts.withColumn("measurement_unit", F.coalesce("measurement_unit", F.lit("pixel")))


def teitok_rows(parts: DataFrame) -> DataFrame:
    """Sentences in order with page, line and box."""
    return parts.where("kind = 'row'").select("file", F.col("n").alias("row_idx"), F.col("page").alias("page_num"), _facet("line").cast("int").alias("line_num"), "text", F.col("box").alias("bbox"))


def teitok_pages(parts: DataFrame) -> DataFrame:
    """Pages with the canvas of the surface of the same ordinal as their break, and their figures.

    Labels don't count, as they may start anywhere. A file without page breaks has page 1, and a number
    that comes again has the last size that was given for it.
    """
    breaks = parts.where("kind = 'break'").select("file", "n", "page")
    none = parts.where("kind <> 'error'").select("file").distinct().join(breaks.select("file").distinct(), "file", "left_anti").select("file", F.lit(1).cast("bigint").alias("n"), F.lit(1).alias("page"))
    order = breaks.unionByName(none)
    surfaces = parts.where("kind = 'surface'").select("file", "n", _facet("width").cast("int").alias("width"), _facet("height").cast("int").alias("height"), F.lit(True).alias("given"))
    sized = order.join(surfaces, ["file", "n"], "left")
    last = lambda c: F.max_by(c, F.when(F.col("given"), F.col("n"))).alias(c)
    pages = sized.groupBy("file", "page").agg(last("width"), last("height"))
    first = parts.where("kind = 'row' or kind = 'figure'").select("file", "page").distinct()  # what stands before the first break is on page 1
    pages = pages.join(first, ["file", "page"], "full")
    drawn = F.transform(F.array_sort(F.collect_list(F.struct("n", F.struct(_facet("type").alias("type"), "box").alias("f")))), lambda x: x["f"])
    figures = parts.where("kind = 'figure'").groupBy("file", "page").agg(drawn.alias("figures"))
    out = pages.join(figures, ["file", "page"], "left")
    return out.select("file", F.col("page").alias("page_num"), "width", "height", F.coalesce("figures", F.array().cast("array<struct<type:string,box:array<bigint>>>")).alias("figures"))
