"""Column functions on single values: keys, tags, versions, quoted settings, XML text and coordinate extents."""

from __future__ import annotations

from pyspark.sql import Column
from pyspark.sql import functions as F

# Entity codes by type; any other code is MISC.
ENTITY_TYPES = {
    "PER": ("p", "p_", "P", "pf", "ps", "pm", "ph", "pc", "pd", "pp"),
    "ORG": ("i", "i_", "I", "ia", "if", "io", "ic"),
    "LOC": ("g", "G", "g_", "gu", "gl", "gq", "gr", "gs", "gc", "gt", "gh"),
}


def entity_type(code: Column) -> Column:
    """PER, ORG, LOC or MISC; null for null."""
    out = F.when(code.isNull(), None)
    for kind, codes in ENTITY_TYPES.items():
        out = out.when(code.isin(*codes), kind)
    return out.otherwise("MISC")


def key_text(value: Column, kind: str) -> Column:
    """The text under which equal key values meet, whatever their type: ``kind`` is the column's SQL type.

    Numbers and strings stand as text, whole floating-point numbers as integers, null and booleans as
    in JSON, arrays, maps and structs as JSON. So the page 1, 1.0 and "1" are one key.
    """
    if kind in ("float", "double"):
        whole = (value == F.floor(value)) & (F.abs(value) < F.lit(1e15))
        text = F.when(whole, value.cast("bigint").cast("string")).otherwise(value.cast("string"))
    elif kind.startswith(("array", "map", "struct")):
        text = F.to_json(value, {"ignoreNullFields": "false"})
    else:
        text = value.cast("string")
    return F.coalesce(text, F.lit("null"))


def unquote(setting: Column) -> Column:
    """A setting without white space around it and without one pair of equal quotes."""
    return F.regexp_replace(F.trim(setting), r"""^(["'])([\s\S]*)\1$""", "$2")


def escape_xml(text: Column) -> Column:
    """Text for an XML element or a double-quoted attribute; null is empty."""
    out = F.coalesce(text, F.lit(""))
    for plain, entity in (("&", "&amp;"), ("<", "&lt;"), (">", "&gt;"), ('"', "&quot;")):
        out = F.replace(out, F.lit(plain), F.lit(entity))
    return out


def close_names(xml: Column) -> Column:
    """``</n>``, a broken end tag, as ``</name>``."""
    return F.replace(xml, F.lit("</n>"), F.lit("</name>"))


def source_extent(xml: Column) -> Column:
    """struct(width, height, kind) of a page file's coordinates.

    ``surface``: the first surface element with positive lower right corners; ``bbox-extent``: the
    largest ones of all boxes; all null if there is neither.
    """
    inside = lambda s, name: F.regexp_extract(s, rf"""\b{name}\s*=\s*["']([^"']*)""", 1).try_cast("double")
    surfaces = F.transform(F.regexp_extract_all(xml, F.lit(r"<surface\b([^>]*)>")), lambda s: F.struct(inside(s, "lrx").alias("x"), inside(s, "lry").alias("y")))
    good = F.filter(surfaces, lambda s: (F.bround(s["x"]) > 0) & (F.bround(s["y"]) > 0))
    boxes = F.transform(F.regexp_extract_all(xml, F.lit(r"""\bbbox\s*=\s*["']([^"']*)""")), lambda b: F.transform(F.split(F.trim(b), r"\s+"), lambda v: v.try_cast("double")))
    boxes = F.filter(boxes, lambda b: (F.size(b) == 4) & ~F.exists(b, lambda v: v.isNull()))
    most = lambda k: F.array_max(F.transform(boxes, lambda b: F.get(b, F.lit(k))))
    size = lambda x, y, kind: F.struct(F.bround(x).cast("int").alias("width"), F.bround(y).cast("int").alias("height"), F.lit(kind).alias("kind"))
    first = F.get(good, F.lit(0))
    none = F.struct(F.lit(None).cast("int").alias("width"), F.lit(None).cast("int").alias("height"), F.lit(None).cast("string").alias("kind"))
    return F.when(first.isNotNull(), size(first["x"], first["y"], "surface")).when((most(2) > 0) & (most(3) > 0), size(most(2), most(3), "bbox-extent")).otherwise(none)


def bare_version(text: Column) -> Column:
    """A version without one leading v."""
    return F.regexp_replace(F.trim(text), "^[vV]", "")


def version_conflicts(**versions: Column) -> Column:
    """Names of sources without a version as ``name:missing``, and of pairs that differ as ``a!=b``; empty if all agree."""
    names, bare = list(versions), {n: bare_version(c) for n, c in versions.items()}
    absent = [F.when(F.coalesce(bare[n], F.lit("")) == "", F.lit(f"{n}:missing")) for n in names]
    differ = [F.when((bare[a] != "") & (bare[b] != "") & (bare[a] != bare[b]), F.lit(f"{a}!={b}")) for i, a in enumerate(names) for b in names[i + 1 :]]
    return F.array_compact(F.array(*absent, *differ))


def line_class(inverted: Column, garbage: Column) -> Column:
    """Inverted, else Garbage, else null: mirrored text says nothing on how it was decoded."""
    return F.when(inverted, "Inverted").when(garbage, "Garbage")


def route(path: Column) -> Column:
    """How a file is enriched, by its suffix: lines, document, convert; null if it can't be."""
    low = F.lower(path)
    ends = lambda *s: low.rlike(r"\.(" + "|".join(s) + ")$")
    return F.when(ends("csv"), "lines").when(ends("md", "txt"), "document").when(ends("xml", "json", "pdf", "docx", "docm"), "convert")
