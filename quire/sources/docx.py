"""The parts of DOCX packages as rows, as they stand in the package: nothing is inherited or resolved here."""

from __future__ import annotations

import io
import posixpath
import xml.etree.ElementTree as ET
import zipfile
from collections.abc import Iterator

import pandas as pd
from pyspark.sql import DataFrame, SparkSession

W = "{http://schemas.openxmlformats.org/wordprocessingml/2006/main}"
_REL = "{http://schemas.openxmlformats.org/officeDocument/2006/relationships}"
_DRAWN = "{http://schemas.openxmlformats.org/drawingml/2006/main}blip"
_NAMED = "{http://schemas.openxmlformats.org/drawingml/2006/wordprocessingDrawing}docPr"

#: ``kind``: paragraph, run, note_ref, cell, style, relation, note, section, region or error. ``block`` orders what is in the body, ``at`` the rest.
PARTS = "file string, kind string, block bigint, at bigint, key string, facets map<string,string>, text string"


def _value(e: ET.Element | None, name: str = "val") -> str | None:
    return None if e is None else e.get(f"{W}{name}")


def _switch(parent: ET.Element | None, name: str) -> str | None:
    """A property that is there says yes unless its value says no; null if it isn't there."""
    e = None if parent is None else parent.find(f"{W}{name}")
    return None if e is None else ("0" if _value(e) in ("0", "false", "off", "none") else "1")


def _look(rpr: ET.Element | None) -> dict[str, str | None]:
    """The facets that run properties set themselves."""
    get = lambda name, attr="val": None if rpr is None else _value(rpr.find(f"{W}{name}"), attr)
    size, color = get("sz"), get("color")
    return {
        "bold": _switch(rpr, "b"), "italic": _switch(rpr, "i"), "strike": _switch(rpr, "strike"), "underline": _switch(rpr, "u"),
        "color": None if color in (None, "auto") else f"#{color.upper()}", "highlight": None if get("highlight") == "none" else get("highlight"),
        "size": str(int(size) / 2) if size and size.isdigit() else None, "font": get("rFonts", "ascii"),
    }


def _run_text(run: ET.Element) -> str:
    out = []
    for e in run:
        tag = e.tag.removeprefix(W)
        if tag == "t":
            out.append(e.text or "")
        elif tag in ("tab", "ptab"):
            out.append("\t")
        elif tag == "cr" or tag == "br" and _value(e, "type") in (None, "textWrapping"):
            out.append("\n")
        elif tag == "noBreakHyphen":
            out.append("-")
    return "".join(out)


def _plain(paragraph: ET.Element) -> str:
    return "".join(_run_text(r) for r in paragraph.iter(f"{W}r"))


def _cell_rows(table: ET.Element) -> Iterator[tuple[int, int, str]]:
    """(row, column, text) of a table's grid; a cell that spans columns or rows stands in each."""
    above: dict[int, str] = {}
    for i, tr in enumerate(table.findall(f"{W}tr")):
        col = 0
        for tc in tr.findall(f"{W}tc"):
            pr = tc.find(f"{W}tcPr")
            span = _value(None if pr is None else pr.find(f"{W}gridSpan"))
            merge = None if pr is None else pr.find(f"{W}vMerge")
            text = "\n".join(_plain(p) for p in tc.findall(f"{W}p"))
            for _ in range(int(span) if span and span.isdigit() else 1):
                if merge is not None and _value(merge) != "restart":
                    text = above.get(col, text)
                above[col] = text
                yield i, col, text
                col += 1


def _relations(z: zipfile.ZipFile, part: str) -> dict[str, str]:
    folder, name = posixpath.split(part)
    path = f"{folder}/_rels/{name}.rels"
    if path not in z.namelist():
        return {}
    return {r.get("Id"): posixpath.normpath(posixpath.join(folder, r.get("Target"))) if not r.get("Target").startswith("/") else r.get("Target")[1:] for r in ET.fromstring(z.read(path)) if r.get("TargetMode") != "External"}


def package_parts(content: bytes) -> Iterator[tuple]:
    """(kind, block, at, key, facets, text) of one package."""
    with zipfile.ZipFile(io.BytesIO(content)) as z:
        names = set(z.namelist())
        body = ET.fromstring(z.read("word/document.xml")).find(f"{W}body")
        relations = _relations(z, "word/document.xml")
        for k, (rid, target) in enumerate(relations.items()):
            yield "relation", None, k, rid, {}, target
        if "word/styles.xml" in names:
            for k, s in enumerate(ET.fromstring(z.read("word/styles.xml")).findall(f"{W}style")):
                facets = _look(s.find(f"{W}rPr")) | {"name": _value(s.find(f"{W}name")), "based_on": _value(s.find(f"{W}basedOn")), "type": s.get(f"{W}type"), "default": s.get(f"{W}default")}
                yield "style", None, k, s.get(f"{W}styleId"), facets, None
        notes = next((t for t in relations.values() if t.endswith("footnotes.xml") and t in names), None)
        for k, n in enumerate(ET.fromstring(z.read(notes)).findall(f"{W}footnote") if notes else ()):
            if n.get(f"{W}id") not in (None, "-1", "0"):
                yield "note", None, k, n.get(f"{W}id"), {}, "".join(t.text or "" for t in n.iter(f"{W}t")).strip()
        at = 0
        for block, e in enumerate(body if body is not None else ()):
            if e.tag == f"{W}p":
                pr = e.find(f"{W}pPr")
                own = lambda name: None if pr is None else _value(pr.find(f"{W}{name}"))  # noqa: E731, B023
                yield "paragraph", block, 0, own("pStyle"), {"align": own("jc"), "break_before": _switch(pr, "pageBreakBefore")}, None
                for r in e.findall(f"{W}r"):
                    look = _look(r.find(f"{W}rPr"))
                    style = r.find(f"{W}rPr/{W}rStyle")
                    breaks = any(_value(b, "type") == "page" for b in r.findall(f"{W}br"))
                    if r.find(f".//{W}drawing") is not None:
                        name, blip = r.find(f".//{_NAMED}"), r.find(f".//{_DRAWN}")
                        look |= {"drawing": (None if name is None else name.get("name")) or "image", "embed": None if blip is None else blip.get(f"{_REL}embed")}
                    yield "run", block, at, _value(style), look | {"break": "1" if breaks else None}, _run_text(r)
                    at += 1
                for ref in e.iter(f"{W}footnoteReference"):
                    yield "note_ref", block, at, ref.get(f"{W}id"), {}, None
                    at += 1
            elif e.tag == f"{W}tbl":
                for i, j, text in _cell_rows(e):
                    yield "cell", block, at, None, {"row": str(i), "col": str(j)}, text
                    at += 1
        for k, s in enumerate(body.iter(f"{W}sectPr") if body is not None else ()):
            size, margin = s.find(f"{W}pgSz"), s.find(f"{W}pgMar")
            facets = {"width": _value(size, "w"), "height": _value(size, "h"), "orient": _value(size, "orient")} | {side: _value(margin, side) for side in ("top", "bottom", "left", "right")}
            yield "section", None, k, None, facets, None
            for kind in ("header", "footer"):
                for ref in s.findall(f"{W}{kind}Reference"):
                    part = relations.get(ref.get(f"{_REL}id"))
                    if ref.get(f"{W}type") in (None, "default") and part in names:
                        lines = [_plain(p).strip() for p in ET.fromstring(z.read(part)).findall(f"{W}p")]
                        yield "region", None, k, kind, {}, "\n".join(x for x in lines if x)


def read_docx_parts(spark: SparkSession, path: str) -> DataFrame:
    """One row per part (``PARTS``); facets that a part doesn't set are absent. A file that can't be read gives one row of kind ``error``."""

    def run(frames: Iterator[pd.DataFrame]) -> Iterator[pd.DataFrame]:
        for frame in frames:
            for file, content in zip(frame["path"], frame["content"], strict=True):
                try:
                    rows = [(file, *r) for r in package_parts(content)]
                except (zipfile.BadZipFile, KeyError, ET.ParseError) as e:
                    rows = [(file, "error", None, None, None, {}, str(e))]
                out = pd.DataFrame(rows, columns=["file", "kind", "block", "at", "key", "facets", "text"])
                out["facets"] = [{k: v for k, v in f.items() if v is not None} for f in out["facets"]]
                yield out.astype({"block": "Int64", "at": "Int64"})

    files = spark.read.format("binaryFile").option("recursiveFileLookup", True).load(path).select("path", "content")
    return files.mapInPandas(run, PARTS)
