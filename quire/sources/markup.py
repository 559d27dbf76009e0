"""Page and token markup: ALTO, CoNLL-U, TEITOK XML, DOCX and image headers."""

from __future__ import annotations

import io
import struct
import xml.etree.ElementTree as ET
import zipfile
from collections.abc import Iterator

import pandas as pd
from pyspark.sql import DataFrame, SparkSession, Window
from pyspark.sql import functions as F

from quire.functions.text import normalize_text

_BOX = "_HPOS DOUBLE, _VPOS DOUBLE, _WIDTH DOUBLE, _HEIGHT DOUBLE"
ALTO_PAGE = f"""_ID STRING, _PHYSICAL_IMG_NR INT, _WIDTH DOUBLE, _HEIGHT DOUBLE, PrintSpace STRUCT<{_BOX.replace(" DOUBLE", ": DOUBLE")},
  TextBlock: ARRAY<STRUCT<_ID: STRING, TextLine: ARRAY<STRUCT<_ID: STRING, {_BOX.replace(" DOUBLE", ": DOUBLE")}, String: ARRAY<STRUCT<_CONTENT: STRING, {_BOX.replace(" DOUBLE", ": DOUBLE")}>>>>>>>"""


def read_alto(spark: SparkSession, path: str) -> DataFrame:
    """One row per string: file, page, block, line and string ordinals, ``content`` and its box.

    The page number is the image's where given, else the page's ordinal in its file. A broken file
    yields the pages that could be read.
    """
    pages = spark.read.format("xml").options(rowTag="Page", mode="PERMISSIVE", ignoreNamespace=True).schema(ALTO_PAGE).load(path)
    pages = pages.select(F.col("_metadata.file_path").alias("file"), F.monotonically_increasing_id().alias("__n"), "*")
    ordinal = F.row_number().over(Window.partitionBy("file").orderBy("__n"))
    pages = pages.select("file", F.coalesce("_PHYSICAL_IMG_NR", ordinal).alias("page_num"), F.col("_WIDTH").alias("page_width"), F.col("_HEIGHT").alias("page_height"), F.col("PrintSpace.TextBlock").alias("blocks"))
    blocks = pages.select("file", "page_num", "page_width", "page_height", F.posexplode("blocks").alias("block", "b"))
    lines = blocks.select("file", "page_num", "page_width", "page_height", "block", F.posexplode("b.TextLine").alias("line", "l"))
    strings = lines.select("file", "page_num", "page_width", "page_height", "block", "line", F.posexplode("l.String").alias("string", "s"))
    box = [F.col("s._HPOS").alias("x0"), F.col("s._VPOS").alias("y0"), (F.col("s._HPOS") + F.col("s._WIDTH")).alias("x1"), (F.col("s._VPOS") + F.col("s._HEIGHT")).alias("y1")]
    return strings.select("file", "page_num", "page_width", "page_height", "block", "line", "string", F.col("s._CONTENT").alias("content"), *box)


def alto_lines(strings: DataFrame) -> DataFrame:
    """Strings to lines: text in order, box around them."""
    entry = F.array_sort(F.collect_list(F.struct("string", "content")))
    return strings.groupBy("file", "page_num", "block", "line").agg(
        F.array_join(F.transform(entry, lambda e: e["content"]), " ").alias("text"), F.min("x0").alias("x0"), F.min("y0").alias("y0"), F.max("x1").alias("x1"), F.max("y1").alias("y1")
    )


def read_conllu(spark: SparkSession, path: str) -> DataFrame:
    """One row per token of CoNLL-U files: ``file``, ``sent``, ``sent_id``, ``sent_text``, ``page_break`` and the ten columns.

    Multi-word and empty nodes and short lines are left out; ``misc`` becomes a map.
    """
    whole = spark.read.option("recursiveFileLookup", True).text(path, wholetext=True)
    sents = whole.select(F.col("_metadata.file_path").alias("file"), F.posexplode(F.split(F.trim(F.regexp_replace("value", "\r", "")), "\n[ \t]*\n+")).alias("sent", "body"))
    lines = F.split("body", "\n")
    head = lambda key: F.nullif(F.regexp_extract("body", rf"(?m)^#\s*{key}\s*=\s*(.*)$", 1), F.lit(""))
    rows = sents.select("file", "sent", head("sent_id").alias("sent_id"), head("text").alias("sent_text"), F.coalesce(head("page_break") == "true", F.lit(False)).alias("page_break"), F.posexplode(F.filter(lines, lambda x: ~x.startswith("#"))).alias("tok", "row"))
    c = F.split("row", "\t")
    cut = rows.where((F.size(c) >= 10) & c[0].rlike(r"^\d+$")).select("file", "sent", "sent_id", "sent_text", "page_break", "tok", *(c[i].alias(n) for i, n in enumerate(("id", "form", "lemma", "upos", "xpos", "feats", "head", "deprel", "deps", "misc"))))
    misc = F.when(F.col("misc") != "_", F.str_to_map("misc", F.lit(r"\|"), F.lit("=")))
    return cut.withColumn("misc", misc).withColumn("space_after", F.coalesce(F.element_at("misc", "SpaceAfter") != "No", F.lit(True)))


def entity_spans(tokens: DataFrame, tag: str = "ner", by: tuple[str, ...] = ("file", "sent"), order: str = "tok") -> DataFrame:
    """Spans of B-/I- tags: a B starts one, following Is go on whatever their type; an I on its own is no entity."""
    w = Window.partitionBy(*by).orderBy(order)
    t = F.coalesce(F.col(tag), F.lit("O"))
    plain = ~(t.startswith("B-") | t.startswith("I-"))
    run = F.sum(F.when(t.startswith("B-") | plain, 1).otherwise(0)).over(w.rowsBetween(Window.unboundedPreceding, 0))
    marked = tokens.withColumn("__run", run).withColumn("__start", F.when(t.startswith("B-"), F.substr(t, F.lit(3))))
    inside = marked.where(~plain)
    words = F.array_sort(F.collect_list(F.struct(order, "form")))
    spans = inside.groupBy(*by, "__run").agg(F.max("__start").alias("type"), F.min(order).alias("first"), F.max(order).alias("last"), F.array_join(F.transform(words, lambda x: x["form"]), " ").alias("text"))
    return spans.where("type is not null").drop("__run")


def _walk_teitok(xml: bytes) -> Iterator[tuple]:
    """(row, page, line, text, tokens) of the sentences in document order."""
    page = line = row = 0
    for e in ET.fromstring(xml).iter():
        tag = e.tag.rpartition("}")[2]
        if tag == "pb":
            n = e.get("n", "")
            page = int(n) if n.isdigit() else page + 1
        elif tag == "lb":
            line += 1
        elif tag == "s":
            tokens = [{"form": "".join(t.itertext()), "lemma": t.get("lemma"), "upos": t.get("upos") or t.get("pos") or t.get("type"), "bbox": t.get("bbox")} for t in e.iter() if t.tag.rpartition("}")[2] == "tok"]
            yield row, max(page, 1), line, e.get("text") or " ".join(t["form"] for t in tokens), tokens
            row += 1


def read_teitok(spark: SparkSession, path: str) -> DataFrame:
    """One row per sentence of TEITOK XML, in document order, with its tokens.

    A page break sets the page (one more if it has no number), a line break counts lines and never
    starts anew. Element order crosses tags, so each file is walked whole. A file that can't be parsed
    gives one row with ``error``.
    """
    schema = "file string, row_idx bigint, page_num int, line_num int, text string, tokens array<struct<form:string,lemma:string,upos:string,bbox:string>>, error string"

    def run(frames: Iterator[pd.DataFrame]) -> Iterator[pd.DataFrame]:
        for frame in frames:
            rows = []
            for file, content in zip(frame["path"], frame["content"], strict=True):
                try:
                    rows += [(file, *r, None) for r in _walk_teitok(content)]
                except ET.ParseError as e:
                    rows.append((file, None, None, None, None, None, str(e)))
            out = pd.DataFrame(rows, columns=["file", "row_idx", "page_num", "line_num", "text", "tokens", "error"])
            yield out.astype({"row_idx": "Int64", "page_num": "Int32", "line_num": "Int32"})

    files = spark.read.format("binaryFile").option("recursiveFileLookup", True).load(path).select("path", "content")
    return files.mapInPandas(run, schema)


_W = "{http://schemas.openxmlformats.org/wordprocessingml/2006/main}"


def _docx_rows(content: bytes) -> Iterator[tuple]:
    """(row, kind, level, text, bold, table, cell row, cell column) of paragraphs and cells, as they come."""
    with zipfile.ZipFile(io.BytesIO(content)) as z:
        body = ET.fromstring(z.read("word/document.xml")).find(f"{_W}body")
    row = table = 0

    def text(p):
        return "".join(t.text or "" for t in p.iter(f"{_W}t"))

    for e in body if body is not None else ():
        if e.tag == f"{_W}p":
            style = e.find(f"{_W}pPr/{_W}pStyle")
            name = (style.get(f"{_W}val") if style is not None else "") or ""
            level = int(name[7:]) if name.lower().startswith("heading") and name[7:].isdigit() else None
            bold = e.find(f"{_W}r/{_W}rPr/{_W}b") is not None
            yield row, "heading" if level else "paragraph", level, text(e), bold, None, None, None
            row += 1
        elif e.tag == f"{_W}tbl":
            for i, tr in enumerate(e.findall(f"{_W}tr")):
                for j, tc in enumerate(tr.findall(f"{_W}tc")):
                    yield row, "cell", None, "\n".join(text(p) for p in tc.iter(f"{_W}p")), False, table, i, j
                    row += 1
            table += 1


def read_docx(spark: SparkSession, path: str) -> DataFrame:
    """Paragraphs, headings and table cells of DOCX files in order; an unreadable file gives one row with ``error``."""
    schema = "file string, row_idx bigint, kind string, level int, text string, bold boolean, table_no int, cell_row int, cell_col int, error string"

    def run(frames):
        for frame in frames:
            rows = []
            for file, content in zip(frame["path"], frame["content"], strict=True):
                try:
                    rows += [(file, *r, None) for r in _docx_rows(content)]
                except (zipfile.BadZipFile, KeyError, ET.ParseError) as e:
                    rows.append((file, *[None] * 8, str(e)))
            out = pd.DataFrame(rows, columns=["file", "row_idx", "kind", "level", "text", "bold", "table_no", "cell_row", "cell_col", "error"])
            yield out.astype({"row_idx": "Int64", "level": "Int32", "table_no": "Int32", "cell_row": "Int32", "cell_col": "Int32", "bold": "boolean"})

    files = spark.read.format("binaryFile").option("recursiveFileLookup", True).load(path).select("path", "content")
    return files.mapInPandas(run, schema)


HTML_ROW = r"(?is)<(?:h[1-6]|p|li)(?: [^>]*)?>.*?</(?:h[1-6]|p|li)>"
_ENTITIES = (("&nbsp;", " "), ("&lt;", "<"), ("&gt;", ">"), ("&quot;", '"'), ("&#39;", "'"), ("&amp;", "&"))


def html_rows(pages: DataFrame, keep: list[str], html_col: str = "html") -> DataFrame:
    """``keep``, ``row_idx``, ``kind`` (heading, paragraph, item), ``level`` and ``text`` of HTML pages, in order.

    A row ends at the next closing tag of these kinds, so an unclosed one takes in what follows.
    Inner tags become spaces, spaces collapse and the common entities are resolved. A null or empty
    page has no rows.
    """
    parts = pages.select(*keep, F.posexplode(F.regexp_extract_all(html_col, F.lit(HTML_ROW), F.lit(0))).alias("row_idx", "part"))
    tag = F.lower(F.regexp_extract("part", r"^<(\w+)", 1))
    text = F.regexp_replace("part", "<[^>]*>", " ")
    for name, sign in _ENTITIES:
        text = F.replace(text, F.lit(name), F.lit(sign))
    kind = F.when(tag == "p", "paragraph").when(tag == "li", "item").otherwise("heading")
    level = F.when(tag.startswith("h"), F.substr(tag, F.lit(2)).try_cast("int"))
    return parts.select(*keep, "row_idx", kind.alias("kind"), level.alias("level"), F.trim(F.regexp_replace(text, r"[ \t\r\n]+", " ")).alias("text"))


def image_size(head: bytes) -> tuple[int, int] | None:
    """Width and height from the header of a PNG, JPEG or TIFF image."""
    if head[:8] == b"\x89PNG\r\n\x1a\n" and len(head) >= 24:
        return struct.unpack(">II", head[16:24])
    if head[:2] == b"\xff\xd8":
        at = 2
        while at + 9 < len(head) and head[at] == 0xFF:
            marker, size = head[at + 1], int.from_bytes(head[at + 2 : at + 4], "big")
            if 0xC0 <= marker <= 0xCF and marker not in (0xC4, 0xC8, 0xCC):
                height, width = struct.unpack(">HH", head[at + 5 : at + 9])
                return width, height
            at += 2 + size
    if head[:4] in (b"II*\0", b"MM\0*"):
        order = "<" if head[:2] == b"II" else ">"
        at = struct.unpack(order + "I", head[4:8])[0]
        found = {}
        for i in range(struct.unpack(order + "H", head[at : at + 2])[0] if at + 2 <= len(head) else 0):
            tag, kind, _ = struct.unpack(order + "HHI", head[at + 2 + 12 * i : at + 10 + 12 * i])
            raw = head[at + 10 + 12 * i : at + 14 + 12 * i]
            found[tag] = struct.unpack(order + ("H" if kind == 3 else "I"), raw[: 2 if kind == 3 else 4])[0]
        if 256 in found and 257 in found:
            return found[256], found[257]
    return None


def read_image_sizes(spark: SparkSession, path: str) -> DataFrame:
    """``path``, ``width``, ``height`` of images; nulls for other files."""

    def run(frames):
        for frame in frames:
            sizes = [image_size(c) or (None, None) for c in frame["content"]]
            yield pd.DataFrame({"path": frame["path"], "width": pd.array([w for w, _ in sizes], "Int32"), "height": pd.array([h for _, h in sizes], "Int32")})

    files = spark.read.format("binaryFile").option("recursiveFileLookup", True).load(path).select("path", "content")
    return files.mapInPandas(run, "path string, width int, height int")


def _stream(df: DataFrame, key: str, text: str) -> DataFrame:
    """``doc``, ``key``, the folded text's characters ``chars`` and the place ``at`` of the first one in its document."""
    folded = F.regexp_replace(normalize_text(F.col(text), lowercase=True), r"\s+", "")
    rows = df.select("doc", key, folded.alias("f")).where("f <> ''").select("doc", key, F.split("f", "").alias("chars"))
    before = Window.partitionBy("doc").orderBy(key).rowsBetween(Window.unboundedPreceding, -1)
    return rows.withColumn("at", F.coalesce(F.sum(F.size("chars")).over(before), F.lit(0)))


def _grams(stream: DataFrame, key: str, width: int, name: str) -> DataFrame:
    """The runs of ``width`` characters that a document has once, and where."""
    whole = stream.groupBy("doc").agg(F.flatten(F.transform(F.array_sort(F.collect_list(F.struct("at", "chars"))), lambda x: x["chars"])).alias("c"))
    starts = F.when(F.size("c") >= width, F.sequence(F.lit(0), F.size("c") - width)).otherwise(F.array().cast("array<int>"))
    gram = whole.select("doc", "c", F.explode(starts).alias(name)).select("doc", name, F.array_join(F.slice("c", F.col(name) + 1, width), "").alias("gram"))
    return gram.groupBy("doc", "gram").agg(F.min(name).alias(name), F.count("*").alias("n")).where("n = 1").drop("n")


def align_tokens(tokens: DataFrame, strings: DataFrame, width: int = 6, drift: int = 40) -> DataFrame:
    """``tokens`` with the page and box of the recognised strings that they stand in; nulls where none is found.

    ``tokens``: doc, tok, form; ``strings``: doc, seq, content, page_num and box. Both sides are read as
    streams of folded characters without spaces. Runs of ``width`` characters that occur once on either
    side of a document are its anchors; one whose shift differs by more than ``drift`` from the median
    of its neighbours is chance. From an anchor to the next of equal shift, characters stand for each
    other place by place, misread ones too. Everything is an equi-join on the document and a place.
    """
    left, right = _stream(tokens, "tok", "form"), _stream(strings, "seq", "content")
    anchors = _grams(left, "tok", width, "pa").join(_grams(right, "seq", width, "pb"), ["doc", "gram"]).select("doc", "pa", (F.col("pb") - F.col("pa")).alias("shift"))
    along = Window.partitionBy("doc").orderBy("pa")
    usual = F.percentile_approx("shift", 0.5).over(along.rowsBetween(-10, 10))
    sound = anchors.withColumn("usual", usual).where(F.abs(F.col("shift") - F.col("usual")) <= drift)
    ends = sound.withColumn("next", F.when(F.lead("shift").over(along) == F.col("shift"), F.lead("pa").over(along)))
    places = F.sequence("pa", F.greatest(F.col("pa") + width, F.coalesce("next", F.lit(0))) - 1)
    met = ends.select("doc", "shift", F.explode(places).alias("p")).select("doc", "p", (F.col("p") + F.col("shift")).alias("q")).distinct()
    own = lambda s, key, name: s.select("doc", key, F.explode(F.sequence(F.col("at"), F.col("at") + F.size("chars") - 1)).alias(name))
    pairs = met.join(own(left, "tok", "p"), ["doc", "p"]).join(own(right, "seq", "q"), ["doc", "q"]).select("doc", "tok", "seq").distinct()
    boxed = pairs.join(strings, ["doc", "seq"]).groupBy("doc", "tok")
    box = boxed.agg(F.min("page_num").alias("page_num"), F.min("x0").alias("x0"), F.min("y0").alias("y0"), F.max("x1").alias("x1"), F.max("y1").alias("y1"))
    return tokens.join(box, ["doc", "tok"], "left")
