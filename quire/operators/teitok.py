"""TEITOK XML from token rows: milestones for pages and lines, nested blocks, sentences, names and tokens.

What opens and closes at a token follows from its neighbours. Tokens that come as rows have boundaries as
window columns, and the text is put together per sentence and then per document, each an ordered
aggregate. Documents that come whole, as arrays, are written in place: no token is shuffled or sorted.
"""

from __future__ import annotations

from collections.abc import Callable

from pyspark.sql import Column, DataFrame, Window
from pyspark.sql import functions as F
from pyspark.sql.types import StructType

from quire.functions.values import entity_type, escape_xml
from quire.operators.layout import scaled

#: Columns of a token that may be missing, with their types.
TOKEN = {
    "sent_id": "string", "sent_text": "string", "page_break": "boolean", "id": "string", "lemma": "string", "upos": "string", "xpos": "string", "feats": "string", "head": "string", "deprel": "string",
    "space_after": "boolean", "ner": "string", "page_num": "int", "block_id": "string", "line_id": "string", "line_box": "array<double>", "x0": "double", "y0": "double", "x1": "double", "y1": "double",
}
PAGE = {"sx": "double", "sy": "double", "dx": "double", "dy": "double", "width": "int", "height": "int", "extension": "string"}
META = {"title": "string", "lang": "string", "source_image": "string", "generator": "string", "model": "string", "ner_model": "string", "ocr": "string", "ocr_date": "string", "source_file": "string", "date": "string"}


def _complete(df: DataFrame, fields: dict[str, str]) -> DataFrame:
    """``df`` with nulls for the columns of ``fields`` that it doesn't have."""
    return df.withColumns({c: F.lit(None).cast(kind) for c, kind in fields.items() if c not in df.columns})


def _text(*parts: Column | str) -> Column:
    """Texts one after the other; strings that meet become one literal, as each part costs time at each token."""
    out: list[Column | str] = []
    for part in parts:
        if isinstance(part, str) and out and isinstance(out[-1], str):
            out[-1] += part
        elif not isinstance(part, str) or part:
            out.append(part)
    return F.concat(*(F.lit(x) if isinstance(x, str) else x for x in out))


def _attr(name: str, value: Column, empty: Column | None = None) -> Column:
    """`` name="value"``, or nothing for null, empty and ``_``."""
    value = value.cast("string")
    none = F.coalesce(value, F.lit("")).isin("", "_") if empty is None else empty
    return F.when(none, "").otherwise(F.concat(F.lit(f' {name}="'), escape_xml(value), F.lit('"')))


def _box(x0: Column, y0: Column, x1: Column, y1: Column, of: Callable[[str], Column] = F.col) -> Column:
    """A box in image coordinates as text, by the page's scale and offset; null if a side is."""
    sides = [scaled(v, F.coalesce(of(f"d{a}"), F.lit(0.0)), F.coalesce(of(f"s{a}"), F.lit(1.0))) for v, a in ((x0, "x"), (y0, "y"), (x1, "x"), (y1, "y"))]
    return F.concat(*(part for k, s in enumerate(sides) for part in ([F.lit(" ")] if k else []) + [s.cast("string")]))


def _box_attr(box: Column, of: Callable[[str], Column] = F.col) -> Column:
    return F.coalesce(_attr("bbox", _box(*(F.get(box, F.lit(k)) for k in range(4)), of)), F.lit(""))


def _joined(entries: Column, field: str = "xml") -> Column:
    return F.array_join(F.transform(F.sort_array(entries), lambda e: e[field]), "")


def sentence_places(tokens: DataFrame, key: str) -> DataFrame:
    """Per sentence: its number ``n``, ``page``, ``block`` and whether they are new.

    A sentence stands where its first token with a box does. Without one it is on the page before it, or
    on the next if its id is 1 or a page break stands before it, and is a block of its own.
    """
    placed = F.col("page_num").isNotNull()
    first = F.min(F.when(placed, F.struct("tok", "page_num", "block_id")))
    one = lambda c: F.min_by(c, "tok")
    sents = tokens.groupBy(key, "sent").agg(first.alias("at"), one("sent_id").alias("sent_id"), one("sent_text").alias("sent_text"), F.coalesce(F.bool_or("page_break"), F.lit(False)).alias("break"))
    order = Window.partitionBy(key).orderBy("sent")
    upto = order.rowsBetween(Window.unboundedPreceding, 0)
    hint = F.col("at.page_num")
    sents = sents.withColumn("n", F.row_number().over(order)).withColumn("seg", F.count(hint).over(upto)).withColumn("base", F.coalesce(F.last(hint, True).over(upto), F.lit(0)))
    turn = F.when(hint.isNull() & ((F.col("sent_id") == "1") | F.col("break")), 1).otherwise(0)
    inside = Window.partitionBy(key, "seg").orderBy("sent").rowsBetween(Window.unboundedPreceding, 0)
    sents = sents.withColumn("page", (F.col("base") + F.sum(turn).over(inside)).cast("int"))
    sents = sents.withColumn("block", F.coalesce("at.block_id", F.concat(F.lit("block_"), F.col("n").cast("string"))))
    sents = sents.withColumn("new_page", F.col("page") != F.coalesce(F.lag("page").over(order), F.lit(0)))
    return sents.withColumn("new_block", F.col("new_page") | ~F.col("block").eqNullSafe(F.lag("block").over(order))).drop("at", "seg", "base", "break")


def token_boundaries(tokens: DataFrame, key: str) -> DataFrame:
    """``tokens`` with ``new_line``, ``opens`` and ``closes`` (a name).

    A B- tag opens a name, I- tags after it go on, whatever their code; others are no part of one.
    """
    across = Window.partitionBy(key).orderBy("sent", "tok").rowsBetween(Window.unboundedPreceding, -1)
    within = Window.partitionBy(key, "sent").orderBy("tok")
    tag = F.coalesce("ner", F.lit(""))
    t = tokens.withColumn("new_line", F.col("line_id").isNotNull() & ~F.col("line_id").eqNullSafe(F.last("line_id", True).over(across)))
    t = t.withColumn("__b", tag.startswith("B-")).withColumn("__i", tag.startswith("I-"))
    t = t.withColumn("__run", F.sum(F.when(F.col("__i"), 0).otherwise(1)).over(within.rowsBetween(Window.unboundedPreceding, 0)))
    run = Window.partitionBy(key, "sent", "__run").orderBy("tok")
    named = F.max("__b").over(run.rowsBetween(Window.unboundedPreceding, Window.unboundedFollowing))
    t = t.withColumn("__named", F.coalesce(named, F.lit(False)))
    last = F.lead("tok").over(run).isNull()
    return t.withColumn("opens", F.col("__b")).withColumn("closes", F.col("__named") & last).drop("__b", "__i", "__run", "__named")


def _let(value: Column, body: Callable[[Column], Column]) -> Column:
    """``body`` of a value that is computed once."""
    return F.get(F.transform(F.array(value), body), F.lit(0))


def _running(items: Column, start: Column, step: Callable[[Column, Column], Column]) -> Column:
    """The states of a fold over an array, one for each item; ``step`` takes the last state and an item.

    Arrays are copied as they grow, so the states are gathered in pieces as long as the root of the array.
    """
    size = F.greatest(F.ceil(F.sqrt(F.size(items))).cast("int"), F.lit(1))
    pieces = F.transform(F.sequence(F.lit(0), size), lambda k: F.slice(items, k * size + 1, size))
    grown = lambda states, item: F.concat(states, F.array(step(F.element_at(states, -1), item)))
    gathered = F.aggregate(pieces, F.array(F.array(start)), lambda done, piece: F.concat(done, F.array(F.aggregate(piece, F.slice(F.element_at(done, -1), -1, 1), grown))))
    # each piece begins with the last state of the one before
    return F.flatten(F.transform(gathered, lambda states: F.slice(states, F.lit(2), F.size(states))))


def _filled(values: Column, start: Column) -> Column:
    """An array with the value before it for each null, ``start`` for those at its head."""
    return F.when(F.exists(values, lambda v: v.isNull()), _running(values, start, lambda last, v: F.coalesce(v, last))).otherwise(values)


def _header(key: str) -> Column:
    app = lambda ident, label, desc, extra="": F.concat(F.lit(f'        <application ident="{ident}"{extra}><label>'), escape_xml(label), F.lit("</label>"), F.when(desc.isNotNull(), F.concat(F.lit("<desc>Model: "), escape_xml(desc), F.lit("</desc>"))).otherwise(""), F.lit("</application>\n"))
    change = lambda when, who, what: F.concat(F.lit("      <change"), _attr("when", when), _attr("who", who), F.lit(">"), escape_xml(what), F.lit("</change>\n"))
    c = F.col
    nlp = F.coalesce(c("generator"), c("model")).isNotNull()
    source = F.when(c("source_image").isNotNull(), F.concat(F.lit("Source image: "), escape_xml(c("source_image")))).otherwise("Unknown source")
    return F.concat(
        F.lit('<?xml version="1.0" encoding="utf-8"?>\n<TEI xmlnsoff="http://www.tei-c.org/ns/1.0"'), _attr("lang", F.coalesce("lang", F.lit("cs"))), F.lit(">\n  <teiHeader>\n    <fileDesc>\n      <titleStmt><title>"),
        escape_xml(F.coalesce(c("title"), c(key).cast("string"))), F.lit("</title></titleStmt>\n      <publicationStmt><p>Unpublished</p></publicationStmt>\n      <sourceDesc><p>"), source,
        F.lit("</p></sourceDesc>\n    </fileDesc>\n    <encodingDesc>\n      <appInfo>\n"),
        F.when(nlp, app("udpipe", F.coalesce(c("generator"), F.lit("UDPipe")), F.coalesce(c("model"), F.lit("")), ' version="2"')).otherwise(""),
        F.when(c("ner_model").isNotNull(), app("nametag", F.lit("NameTag NER"), c("ner_model"))).otherwise(""),
        F.when(c("ocr").isNotNull(), app("ocr", c("ocr"), F.lit(None).cast("string"))).otherwise(""),
        F.lit("      </appInfo>\n    </encodingDesc>\n    <revisionDesc>\n"),
        F.when(c("source_file").isNotNull(), change(c("date"), F.lit("altoconvert"), F.concat(F.lit("Converted from ALTO file "), c("source_file")))).otherwise(""),
        F.when(c("ocr").isNotNull() & c("ocr_date").isNotNull(), change(c("ocr_date"), c("ocr"), F.lit("OCR processing"))).otherwise(""),
        F.when(c("generator").isNotNull(), change(c("date"), F.lit("udpipe"), F.concat(F.lit("NLP enrichment by "), c("generator")))).otherwise(""),
        F.lit("    </revisionDesc>\n  </teiHeader>\n"),
    )


def _token(of: Callable[[str], Column], given: Callable[[str], bool], scale: Callable[[str], Column], doc: Column, prefix: Column, place: Column, known: Column, new_line: Column | None, named: Column | None, opens: Column | None, closes: Column | None) -> Column:
    """A token with the name and the line that begin at it and the end of a name.

    ``given``: whether there is such a field; ``prefix``: what the ids of its sentence's tokens begin
    with, escaped; ``place``: its id if it has none; ``named``: false if no name opens or closes.
    """
    text = lambda c: of(c).cast("string")
    line = head = ""
    kind: Column | str = ' type="w"'
    own = place
    if new_line is not None:
        line = F.when(new_line, F.concat(F.lit("          <lb"), _attr("id", F.concat(doc, F.lit("."), of("line_id"))), _box_attr(of("line_box"), scale), F.lit("/>\n"))).otherwise("")
    if given("id"):
        own = F.when(text("id").isNotNull(), escape_xml(text("id"))).otherwise(place)
    if given("head"):
        other = text("head") != "0"
        head = F.when(other & known, F.concat(F.lit(' head="'), prefix, escape_xml(text("head")), F.lit('"'))).when(other, _attr("head", text("head"))).otherwise("")
    if given("upos"):
        kind = F.when(of("upos") == "PUNCT", ' type="pc"').otherwise(' type="w"')
    join = F.when(~F.coalesce(of("space_after"), F.lit(True)), ' join="right"').otherwise("") if given("space_after") else ""
    box = F.coalesce(_attr("bbox", _box(*(of(c) for c in ("x0", "y0", "x1", "y1")), scale)), F.lit("")) if given("x0") else ""
    attrs = [_attr(c, of(c)) for c in ("lemma", "upos", "xpos", "feats") if given(c)]
    parts = (line, '            <tok id="', prefix, own, '"', kind, *attrs, head, _attr("deprel", of("deprel")) if given("deprel") else "", join, box, ">", escape_xml(of("form")), "</tok>\n")
    if named is None:
        return _text(*parts)
    begin = lambda code: _text('          <name type="', entity_type(code), '"', _attr("cnec", code, F.lit(False)), ">\n")
    name = F.when(opens, _let(F.substring(F.substring_index(of("ner"), "|", 1), 3, 1 << 20), begin)).otherwise("")
    return F.when(named, _text(name, *parts, F.when(closes, "          </name>\n").otherwise(""))).otherwise(_text(*parts))


def _sentence_id(doc: Column, n: Column) -> Column:
    return F.concat(escape_xml(doc), F.lit(".s"), n.cast("string"))


def _sentence(of: Callable[[str], Column], scale: Callable[[str], Column], doc: Column, inner: Column) -> Column:
    """A sentence around its tokens, with the page and the block that begin at it and the end of the block before."""
    page = of("page").cast("string")
    image = F.concat(doc, F.lit("-"), page, F.coalesce(scale("extension"), F.lit(".png")))
    pb = F.when(of("new_page"), F.concat(F.lit("      <pb"), _attr("n", page), _attr("id", F.concat(doc, F.lit(".pb"), page)), _attr("facs", image), F.lit("/>\n"), F.coalesce(of("drawn"), F.lit("")))).otherwise("")
    div = F.when(of("new_block"), F.concat(F.lit('      <div type="MarginTextZone-P"'), _attr("id", F.concat(doc, F.lit("."), of("block"))), _box_attr(of("box"), scale), F.lit(">\n"))).otherwise("")
    close = F.when(of("new_block") & (of("n") > 1), "      </div>\n").otherwise("")
    return F.concat(close, pb, div, F.lit("        <s"), _attr("id", _sentence_id(doc, of("n"))), _attr("text", of("sent_text")), F.lit(">\n"), inner, F.lit("        </s>\n"))


def _parts(tokens: DataFrame, pages: DataFrame | None, blocks: DataFrame | None, figures: DataFrame | None, meta: DataFrame | None, key: str) -> tuple[DataFrame, ...]:
    """Pages, their ``scale``, what is ``drawn`` on a page, boxes of blocks, meta; empty for what isn't given."""
    # Spark sees that these are empty and plans no join with them
    none = lambda schema: tokens.select(key, *(F.lit(None).cast(f.dataType).alias(f.name) for f in StructType.fromDDL(schema))).where(F.lit(False))
    doc = F.col(key).cast("string")
    pages = _complete(none("page_num int") if pages is None else pages, PAGE)
    scale = pages.select(key, F.col("page_num").alias("page"), "sx", "sy", "dx", "dy", F.coalesce("extension", F.lit(".png")).alias("extension"))
    figures = none("page_num int, id string, type string, box array<double>") if figures is None else figures
    numbered = F.row_number().over(Window.partitionBy(key, "page_num").orderBy("id", "type"))
    figure = F.concat(F.lit("      <figure"), _attr("type", F.col("type")), _attr("id", F.coalesce("id", F.concat(doc, F.lit(".g"), F.col("page").cast("string"), F.lit("-"), F.col("k").cast("string")))), _box_attr(F.col("box")), F.lit("/>\n"))
    drawn = figures.withColumn("k", numbered).withColumnRenamed("page_num", "page").join(scale, [key, "page"], "left").select(key, "page", "k", figure.alias("xml"))
    drawn = drawn.groupBy(key, "page").agg(_joined(F.collect_list(F.struct("k", "xml"))).alias("drawn"))
    boxes = none("block string, box array<double>") if blocks is None else blocks.select(key, F.col("block_id").alias("block"), F.col("box").cast("array<double>").alias("box"))
    return pages, scale, drawn, boxes, _complete(none("title string") if meta is None else meta, META)


def _whole(texts: DataFrame, pages: DataFrame, meta: DataFrame, key: str) -> DataFrame:
    """``key`` and ``xml`` of ``texts``, which have ``body``: header and page images around it."""
    doc = F.col(key).cast("string")
    surface = F.concat(F.lit("    <surface"), _attr("id", F.concat(doc, F.lit(".surface"), F.col("page_num").cast("string"))), _attr("lrx", F.col("width")), _attr("lry", F.col("height")), F.lit(">\n      <graphic"), _attr("url", F.concat(doc, F.lit("-"), F.col("page_num").cast("string"), F.coalesce("extension", F.lit(".png")))), F.lit("/>\n    </surface>\n"))
    faces = pages.select(key, F.struct("page_num", surface.alias("xml")).alias("e")).groupBy(key).agg(F.concat(F.lit("  <facsimile>\n"), _joined(F.collect_list("e")), F.lit("  </facsimile>\n")).alias("faces"))
    known = texts.join(faces, key, "left").join(meta, key, "left")
    return known.select(key, F.concat(_header(key), F.coalesce("faces", F.lit("")), F.lit("  <text>\n    <body>\n"), F.col("body"), F.lit("      </div>\n    </body>\n  </text>\n</TEI>\n")).alias("xml"))


def write_teitok(tokens: DataFrame, pages: DataFrame | None = None, blocks: DataFrame | None = None, figures: DataFrame | None = None, meta: DataFrame | None = None, key: str = "doc") -> DataFrame:
    """One well-formed TEITOK text per document: ``key``, ``xml``.

    ``tokens``: key, ``sent``, ``tok`` (orders), ``form`` and what there is of ``TOKEN``; ``pages``: key,
    ``page_num`` and ``PAGE`` (scale, offset, image size); ``blocks``: key, ``block_id``, ``box`` (four
    numbers); ``figures``: key, ``page_num``, ``id``, ``type``, ``box``; ``meta``: key and ``META``.

    Pages and lines are milestones: a page closes the block it cuts, lines may begin inside names. A
    sentence belongs to the block of its first token with a box. Null forms are empty tokens; keys
    without tokens have no text. Tokens and sentences go through shuffles; documents that are whole
    already go without, by ``write_documents``.
    """
    pages, scale, drawn, boxes, meta = _parts(tokens, pages, blocks, figures, meta, key)
    base = _complete(tokens, TOKEN)
    sents = sentence_places(base, key)
    doc = F.col(key).cast("string")

    here = token_boundaries(base, key).drop("sent_id", "sent_text", "page_break").join(sents.select(key, "sent", "n", "page"), [key, "sent"]).join(scale, [key, "page"], "left")
    heads = base.where(F.col("id").isNotNull()).select(key, "sent", F.col("id").alias("head"), F.lit(True).alias("known")).distinct()
    here = here.join(heads, [key, "sent", "head"], "left")
    prefix = escape_xml(F.concat(_sentence_id(doc, F.col("n")), F.lit(".w")))
    xml = _token(F.col, lambda c: True, F.col, doc, prefix, (F.col("tok") + 1).cast("string"), F.col("known"), F.col("new_line"), F.col("opens") | F.col("closes"), F.col("opens"), F.col("closes"))
    inner = here.select(key, "sent", "tok", xml.alias("xml")).groupBy(key, "sent").agg(_joined(F.collect_list(F.struct("tok", "xml"))).alias("inner"))

    met = sents.join(scale, [key, "page"], "left").join(inner, [key, "sent"]).join(drawn, [key, "page"], "left").join(boxes, [key, "block"], "left")
    texts = met.select(key, "n", _sentence(F.col, F.col, doc, F.col("inner")).alias("xml")).groupBy(key).agg(_joined(F.collect_list(F.struct("n", "xml"))).alias("body"))
    return _whole(texts, pages, meta, key)


def write_documents(docs: DataFrame, pages: DataFrame | None = None, blocks: DataFrame | None = None, figures: DataFrame | None = None, meta: DataFrame | None = None, key: str = "doc") -> DataFrame:
    """``write_teitok`` for documents that come whole, one row each: the same texts, and no token leaves its row.

    ``docs``: key and ``sents``, an array in order, of structs with ``tokens``, an array in order, of
    structs with ``form`` and what there is of ``TOKEN``. ``sent_id``, ``sent_text`` and ``page_break``
    stand in the sentence; so may any other field that is one for all its tokens. Sentences without
    tokens are left out. Of pages, figures and blocks that are there twice the least row holds.
    """
    pages, scale, drawn, boxes, meta = _parts(docs, pages, blocks, figures, meta, key)
    of_sent = docs.schema["sents"].dataType.elementType
    of_tok = set(of_sent["tokens"].dataType.elementType.names)
    ofs = lambda s, t=None: lambda c: t[c] if t is not None and c in of_tok else s[c] if c in of_sent.names else F.lit(None).cast(TOKEN[c])
    given = lambda c: c in of_tok or c in of_sent.names
    doc = F.col(key).cast("string")

    # what belongs to pages and blocks, as maps of the document
    docs = docs.where(F.col(key).isNotNull()).select(key, "sents")
    fields = ["sx", "sy", "dx", "dy", "extension"]
    for name, df, by, value in (("__scale", scale, F.col("page").cast("int"), F.struct(*fields)), ("__drawn", drawn, F.col("page").cast("int"), F.col("drawn")), ("__boxes", boxes, F.col("block").cast("string"), F.col("box"))):
        least = df.where(by.isNotNull()).groupBy(key, by.alias("by")).agg(F.min(value).alias("value"))
        docs = docs.join(least.groupBy(key).agg(F.map_from_entries(F.collect_list(F.struct("by", "value"))).alias(name)), key, "left")

    def summed(s):
        """The page and the block of a sentence's first token with a box, its last line and whether a page begins without a box."""
        tokens = s["tokens"]
        placed = lambda t: ofs(s, t)("page_num").isNotNull()
        first = F.coalesce(F.when(placed(F.get(tokens, F.lit(0))), F.get(tokens, F.lit(0))), F.get(F.filter(tokens, placed), F.lit(0)))
        line = ofs(s)("line_id").cast("string")
        if "line_id" in of_tok:
            line = F.coalesce(F.element_at(tokens, -1)["line_id"], F.try_element_at(F.filter(F.transform(tokens, lambda t: t["line_id"]), lambda v: v.isNotNull()), F.lit(-1))).cast("string")
        turn = F.when((ofs(s)("sent_id").cast("string") == "1") | F.coalesce(ofs(s)("page_break"), F.lit(False)), 1).otherwise(0)
        return _let(first, lambda f: F.struct(ofs(s, f)("page_num").cast("int").alias("hint"), F.when(placed(f), ofs(s, f)("block_id").cast("string")).alias("block"), turn.alias("turn"), line.alias("line")))

    def tokens_of(s, n, line, scaled_by):
        """The tokens of a sentence, one after the other; ``line``: the last line before it."""
        tokens, nothing = s["tokens"], F.lit(None).cast("string")
        tag = lambda t: F.when(ofs(s, t)("ner").startswith("B-"), "B").when(ofs(s, t)("ner").startswith("I-"), "I").otherwise("O")
        tags = F.transform(tokens, tag) if given("ner") else nothing
        lines = F.transform(tokens, lambda t: t["line_id"].cast("string")) if "line_id" in of_tok else nothing
        ids = F.transform(tokens, lambda t: ofs(s, t)("id").cast("string")) if given("id") and given("head") else nothing
        new = ofs(s)("line_id").isNotNull() & ~ofs(s)("line_id").cast("string").eqNullSafe(line)

        def written(a, run, t, j):
            named = opens = closes = new_line = None
            known = F.lit(False)
            if given("ner"):
                mine = F.get(a["tags"], j)
                named, opens = mine != "O", mine == "B"
                # the text of tags up to here, without the I- at its end, ends with what they follow
                goes_on = (mine == "I") & F.rtrim(F.substring(run["tags"], F.lit(1), j + 1), F.lit("I")).endswith("B")
                closes = ~F.coalesce(F.get(a["tags"], j + 1) == "I", F.lit(False)) & (opens | goes_on)
            if "line_id" in of_tok:
                before = F.when(j == 0, line).otherwise(F.get(run["lines"], j - 1))
                new_line = F.get(a["lines"], j).isNotNull() & ~F.get(a["lines"], j).eqNullSafe(before)
            elif given("line_id"):
                new_line = (j == 0) & a["new"]
            if given("id") and given("head"):
                head = ofs(s, t)("head").cast("string")
                known = F.coalesce(F.get(a["ids"], head.try_cast("int") - 1).eqNullSafe(head) | F.array_contains(a["ids"], head), F.lit(False))
            return _token(ofs(s, t), given, scaled_by, doc, a["prefix"], (j + 1).cast("string"), known, new_line, named, opens, closes)

        prefix = escape_xml(F.concat(_sentence_id(doc, n), F.lit(".w")))
        runs = lambda a: F.struct((F.array_join(a["tags"], "") if given("ner") else nothing).alias("tags"), (_filled(a["lines"], line) if "line_id" in of_tok else nothing).alias("lines"))
        joined = lambda a, run: F.array_join(F.transform(tokens, lambda t, j: written(a, run, t, j)), "")
        return _let(F.struct(prefix.alias("prefix"), tags.alias("tags"), lines.alias("lines"), ids.alias("ids"), new.alias("new")), lambda a: _let(runs(a), lambda run: joined(a, run)))

    def sentence(sums, states, s, i):
        state, before, x = F.get(states, i), F.get(states, i - 1), F.get(sums, i)
        block = lambda x, n: F.coalesce(x["block"], F.concat(F.lit("block_"), n.cast("string")))
        new_page = state["page"] != F.coalesce(before["page"], F.lit(0))
        new_block = new_page | (i == 0) | (block(x, i + 1) != block(F.get(sums, i - 1), i))
        at = F.struct(
            (i + 1).alias("n"), state["page"].alias("page"), block(x, i + 1).alias("block"), new_page.alias("new_page"), new_block.alias("new_block"), ofs(s)("sent_text").alias("sent_text"),
            F.element_at("__scale", state["page"]).alias("scale"), F.element_at("__drawn", state["page"]).alias("drawn"), F.element_at("__boxes", block(x, i + 1)).alias("box"),
        )
        scaled_by = lambda m: lambda c: m["scale"][c]
        return _let(at, lambda m: _sentence(lambda c: m[c], scaled_by(m), doc, tokens_of(s, m["n"], before["line"], scaled_by(m))))

    start = F.struct(F.lit(0).alias("page"), F.lit(None).cast("string").alias("line"))
    step = lambda last, x: F.struct(F.coalesce(x["hint"], last["page"] + x["turn"]).alias("page"), F.coalesce(x["line"], last["line"]).alias("line"))
    joined = lambda sents, sums, states: F.array_join(F.transform(sents, lambda s, i: sentence(sums, states, s, i)), "")
    # one expression, so that arrays of tokens aren't copied into rows between its steps
    sents = F.coalesce(F.filter("sents", lambda s: F.size(s["tokens"]) > 0), F.array())
    texts = docs.withColumn("body", _let(sents, lambda sents: _let(F.transform(sents, summed), lambda sums: _let(_running(sums, start, step), lambda states: joined(sents, sums, states)))))
    # a filter would be pushed down and compute all of it twice
    texts = texts.select(key, F.explode(F.filter(F.array("body"), lambda b: b != "")).alias("body"))
    return _whole(texts, pages, meta, key)
