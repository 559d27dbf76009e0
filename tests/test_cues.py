from pyspark.sql import functions as F

from quire.functions import values as V
from quire.operators import cues
from tests.conftest import frame


def test_cues(spark):
    df = frame(spark, [("12", 14.0, 700, "Courier New", 1.5), (" pg_3", None, None, None, -0.25), (None, 10.123456, None, "", 4.0)], "p string, size double, weight int, family string, px double")
    got = df.select(
        cues.page_break(F.col("p")).alias("page"),
        cues.font(F.col("size"), F.col("weight"), F.col("family")).alias("font"),
        cues.indent(F.col("px")).alias("indent"),
        cues.needs_ocr(F.col("p")).alias("ocr"),
    ).collect()
    assert [r["page"] for r in got] == ["<!-- PAGE_BREAK: pg_12 -->", "<!-- PAGE_BREAK: pg_3 -->", "<!-- PAGE_BREAK: pg_? -->"]
    assert [r["font"] for r in got] == ['<!-- FONT: size=14pt, weight=700, family="Courier New" -->', "", "<!-- FONT: size=10.1235pt -->"]
    assert [r["indent"] for r in got] == ["<!-- INDENT: 1.5px -->", "<!-- INDENT: -0.25px -->", "<!-- INDENT: 4px -->"]
    assert got[0]["ocr"] == "<!-- NEEDS_OCR: pg_12 (no extractable text layer) -->"


def test_marks_boxes_and_alignment(spark):
    df = frame(spark, [("a", "center", 1.5, 2.5), (" ", "left", None, 2.0)], "t string, al string, x double, y double")
    t, x, y = F.col("t"), F.col("x"), F.col("y")
    got = df.select(cues.marked(t, "bold").alias("b"), cues.marked(t, "underline").alias("u"), cues.aligned(t, F.col("al")).alias("d"), cues.box(x, y, x, y).alias("box")).collect()
    assert (got[0]["b"], got[0]["u"], got[0]["box"]) == ("**a**", "<u>a</u>", "<!-- BBOX: [2, 2, 2, 2] -->")
    assert got[0]["d"] == '<div align="center">\na\n</div>'
    assert (got[1]["b"], got[1]["u"], got[1]["d"], got[1]["box"]) == (" ", " ", " ", None)


def test_ocr_paragraphs(spark):
    words = [("d", 1, 0, 1, 1, "Hello", "96", 10, 10, 20, 5), ("d", 1, 1, 1, 1, " ", "96", 0, 0, 900, 900), ("d", 1, 2, 1, 1, "there", "x", 40, 11, 20, 6), ("d", 1, 3, 1, 2, "End", "50", 0, 30, 9, 9), ("d", 1, 4, 1, 1, "again", "70", 5, 20, 3, 3)]
    df = frame(spark, words, "doc_id string, page int, row_idx int, block_num int, par_num int, text string, conf string, left int, top int, width int, height int")
    got = cues.ocr_paragraphs(df, scale=0.5).orderBy("row_idx").collect()
    assert [(r["text"], r["x0"], r["y0"], r["x1"], r["y1"]) for r in got] == [("Hello again", 2, 5, 15, 12), ("End", 0, 15, 4, 20)]


def test_words_are_dealt_out_before_they_are_grouped(spark):
    df = frame(spark, [("d", 1, 0, 1, 1, "Hello", "96", 10, 10, 20, 5)], "doc_id string, page int, row_idx int, block_num int, par_num int, text string, conf string, left int, top int, width int, height int")
    plan = cues.ocr_paragraphs(df)._jdf.queryExecution().executedPlan().toString()
    aggregates, exchanges = [i for i, line in enumerate(plan.split("\n")) if "Aggregate" in line], [i for i, line in enumerate(plan.split("\n")) if "Exchange" in line]
    assert len(exchanges) == 1 and max(aggregates) < exchanges[0]


def test_cell_lines(spark):
    lines = frame(spark, [("d", 1, "g", "one"), ("d", 2, "g", "two"), ("d", 3, "h", "three")], "doc_id string, row_idx int, group_id string, text string")
    cells = frame(spark, [("d", 0, 0, 0, "g", None), ("d", 0, 0, 1, "g", [3]), ("d", 0, 1, 0, None, None), ("d", 0, 1, 1, "h", [])], "doc_id string, table_id int, row int, col int, group_id string, lines array<int>")
    got = {(r["row"], r["col"], r["text"]) for r in cues.cell_lines(cells, lines).collect()}
    assert got == {(0, 0, "one"), (0, 0, "two"), (0, 1, "three"), (1, 1, "three")}


def value(spark, column, v, kind="string"):
    return frame(spark, [(v,)], f"v {kind}").select(column.alias("x")).first()["x"]


def test_keys_tags_settings(spark):
    v = F.col("v")
    assert [value(spark, V.key_text(v, k), x, k) for x, k in ((1, "int"), (1.0, "double"), (1.5, "double"), ("1", "string"), (None, "string"), (True, "boolean"), ([1, 2], "array<int>"))] == ["1", "1", "1.5", "1", "null", "true", "[1,2]"]
    assert [value(spark, V.entity_type(v), c) for c in ("pf", "io", "gu", "P", "zz", None)] == ["PER", "ORG", "LOC", "PER", "MISC", None]
    assert [value(spark, V.unquote(v), s) for s in (' "a b" ', "'x'", "\"x'", '""', "plain")] == ["a b", "x", "\"x'", "", "plain"]
    assert value(spark, V.close_names(V.escape_xml(v)), 'a<b & "c"') == "a&lt;b &amp; &quot;c&quot;"
    assert [value(spark, V.route(v), p) for p in ("A.CSV", "x.md", "x.teitok.xml", "x.png")] == ["lines", "document", "convert", None]


def test_source_extent(spark):
    f = lambda s: tuple(value(spark, V.source_extent(F.col("v")), s))
    assert f('<surface lrx="0" lry="5"/><surface lrx="100.4" lry="200"/><tok bbox="1 2 900 900"/>') == (100, 200, "surface")
    assert f('<tok bbox="1 2 30 40"/><tok bbox="1 2 x 99"/><tok bbox="5 5 20 50.0"/>') == (30, 50, "bbox-extent")
    assert f("<TEI/>") == (None, None, None)


def test_versions_and_line_class(spark):
    df = frame(spark, [("v1.2", "1.2", "V1.2"), ("1.2", "1.3", None)], "a string, b string, c string")
    got = df.select(V.version_conflicts(citation=F.col("a"), config=F.col("b"), tag=F.col("c")).alias("x")).collect()
    assert [r["x"] for r in got] == [[], ["tag:missing", "citation!=config"]]
    df = frame(spark, [(True, True), (False, True), (None, None)], "i boolean, g boolean")
    assert [r[0] for r in df.select(V.line_class(F.col("i"), F.col("g"))).collect()] == ["Inverted", "Garbage", None]
