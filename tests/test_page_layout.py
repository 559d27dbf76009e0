from pyspark.sql import functions as F

from quire.operators import teitok
from quire.sources import markup
from quire.sources import page_layout as P

ALTO = """<alto xmlns="http://www.loc.gov/standards/alto/ns-v3#"><Description><MeasurementUnit>mm10</MeasurementUnit><sourceImageInformation><fileName> scan.png </fileName></sourceImageInformation>
<OCRProcessing><ocrProcessingStep><processingDateTime>2020-01-01</processingDateTime><processingSoftware><softwareName>Reader</softwareName><softwareVersion>9</softwareVersion></processingSoftware></ocrProcessingStep></OCRProcessing></Description>
<Layout><Page ID="p1" WIDTH="2000" HEIGHT="3000"><PrintSpace HPOS="10.9" VPOS="20" WIDTH="1900" HEIGHT="2900"><ComposedBlock><TextBlock ID="b1" HPOS="100" VPOS="200" WIDTH="50.5" HEIGHT="20">
<TextLine ID="l1" HPOS="100" VPOS="200" WIDTH="50" HEIGHT="10"><String CONTENT="Old" HPOS="100.7" VPOS="200" WIDTH="20.5" HEIGHT="9"/><SP/><String CONTENT="castle" HPOS="125" VPOS="200" WIDTH="25"/><String CONTENT="" HPOS="1"/><String CONTENT="bad" HPOS="x"/></TextLine>
<TextLine ID="l2" HPOS="no"><String CONTENT="wall" HPOS="100" VPOS="212" WIDTH="20" HEIGHT="9"/></TextLine></TextBlock></ComposedBlock><Illustration ID="g1" HPOS="5" VPOS="6" WIDTH="7" HEIGHT="8"/></PrintSpace></Page>
<Page WIDTH="2000"><TopMargin/><GraphicalElement HPOS="1" VPOS="1" WIDTH="1" HEIGHT="1"/><PrintSpace><TextBlock ID="b2" HPOS="1"><TextLine ID="l3"><String CONTENT="Two"/></TextLine></TextBlock></PrintSpace></Page></Layout></alto>"""


def test_alto_has_five_tables_that_meet_by_ordinal(spark, tmp_path):
    (tmp_path / "a.alto.xml").write_text(ALTO)
    (tmp_path / "broken.alto.xml").write_text(ALTO[: ALTO.index("<TextLine ID=\"l3\"")])
    parts = P.read_alto_parts(spark, str(tmp_path)).where("file like '%a.alto.xml'")
    strings = P.alto_strings(parts).orderBy("seq").collect()
    assert [(r["content"], r["page_num"], r["block_id"], r["line_id"], [r[c] for c in ("x0", "y0", "x1", "y1")], r["line_box"]) for r in strings] == [
        ("Old", 1, "b1", "l1", [100, 200, 121, 209], [100.0, 200.0, 150.0, 210.0]), ("castle", 1, "b1", "l1", [125, 200, 150, 200], [100.0, 200.0, 150.0, 210.0]), ("wall", 1, "b1", "l2", [100, 212, 120, 221], None), ("Two", 2, "b2", "l3", [0, 0, 0, 0], [0.0] * 4),
    ]
    pages = [tuple(r)[1:] for r in P.alto_pages(parts).orderBy("page_num").collect()]
    assert pages == [(1, "p1", "2000", "3000", 10, 20, 1900, 2900), (2, "Page2", "2000", "", 0, 0, 0, 0)]
    assert {r["block_id"]: r["box"] for r in P.alto_blocks(parts).collect()} == {"b1": [100, 200, 150, 220], "b2": [1, 0, 1, 0]}
    assert sorted((r["type"], r["page_num"], r["box"]) for r in P.alto_graphics(parts).collect()) == [("GraphicalElement", 2, [1, 1, 2, 2]), ("Illustration", 1, [5, 6, 12, 14])]
    meta = P.alto_meta(parts).first()
    assert (meta["source_image"], meta["measurement_unit"], meta["ocr_software"], meta["ocr_version"], meta["ocr_date"], meta["error"]) == ("scan.png", "mm10", "Reader", "9", "2020-01-01", None)


def test_a_file_that_breaks_off_gives_what_came_before(spark, tmp_path):
    (tmp_path / "broken.alto.xml").write_text(ALTO[: ALTO.index("<TextLine ID=\"l3\"")])
    (tmp_path / "text.alto.xml").write_text("no xml")
    parts = P.read_alto_parts(spark, str(tmp_path))
    assert P.alto_strings(parts).count() == 3 and P.alto_pages(parts).count() == 2
    errors = {r["file"].rpartition("/")[2]: r["error"] is not None for r in P.alto_meta(parts).collect()}
    assert errors == {"broken.alto.xml": True, "text.alto.xml": True}
    assert P.alto_meta(parts.where("kind <> 'error'")).first()["measurement_unit"] == "mm10"


TEITOK = """<TEI><facsimile><surface lrx="800.6" lry="600"/><surface lrx="x"/><surface lrx="10" lry="20"/></facsimile><text><s text="front"/>
<pb n="iv"/><figure type="image" bbox="1 2 3 4"/><figure bbox="1 2"/><lb/><s><tok bbox="5 6 7 8">a</tok><lb/><tok join="right" bbox="1 9 3 20">b</tok><tok spaceAfter="No" bbox="?">,</tok><tok>c</tok></s><pb n="9"/><s text=""><tok> </tok></s><s text="last"/><pb/></text></TEI>"""


def test_teitok_layout_counts_pages_by_their_order(spark, tmp_path):
    (tmp_path / "a.xml").write_text(TEITOK)
    (tmp_path / "b.xml").write_text('<TEI><surface lrx="3" lry="4"/><s text="only"/></TEI>')
    (tmp_path / "c.xml").write_text('<TEI><pb n="1"/><s text="x"/><s text=')
    parts = P.read_teitok_parts(spark, str(tmp_path))
    rows = {}
    for r in P.teitok_rows(parts).orderBy("row_idx").collect():
        rows.setdefault(r["file"][-5], []).append((r["page_num"], r["line_num"], r["text"], r["bbox"]))
    assert rows == {"a": [(1, 1, "front", None), (2, 2, "a b,c", [1, 6, 7, 20]), (9, 3, "last", None)], "b": [(1, 1, "only", None)], "c": [(1, 1, "x", None)]}
    pages = sorted((r["file"][-5], r["page_num"], r["width"], r["height"], len(r["figures"])) for r in P.teitok_pages(parts).fillna(-1).collect())
    assert pages == [("a", 1, -1, -1, 0), ("a", 2, 800, 600, 1), ("a", 9, -1, -1, 0), ("a", 10, 10, 20, 0), ("b", 1, 3, 4, 0), ("c", 1, -1, -1, 0)]
    assert parts.where("kind = 'error'").count() == 1


def test_alto_boxes_reach_teitok_xml(spark, tmp_path):
    (tmp_path / "in").mkdir()
    (tmp_path / "out").mkdir()
    (tmp_path / "in" / "a.alto.xml").write_text(ALTO.replace("Old", "Oldenburgcastle").replace('"castle"', '"stronghold"').replace('"wall"', '"northernwall"').replace('"Two"', '"secondpage"'))
    parts = P.read_alto_parts(spark, str(tmp_path / "in"))
    strings = P.alto_strings(parts).withColumn("doc", F.lit("d"))
    words = strings.select("doc", (F.col("seq") - 1).cast("int").alias("tok"), F.col("content").alias("form"))
    boxed = markup.align_tokens(words, strings.select("doc", "seq", "content", "page_num", "x0", "y0", "x1", "y1"))
    tokens = boxed.withColumn("sent", F.when(F.col("tok") < 3, 0).otherwise(1)).withColumn("sent_id", F.col("sent").cast("string"))
    scale = P.alto_pages(parts).select(F.lit("d").alias("doc"), "page_num", F.lit(0.5).alias("sx"), F.lit(0.5).alias("sy"), F.col("space_x").alias("dx"), F.col("space_y").alias("dy"))
    (xml,) = [r["xml"] for r in teitok.write_teitok(tokens, scale).collect()]
    (tmp_path / "out" / "d.xml").write_text(xml)
    back = P.teitok_rows(P.read_teitok_parts(spark, str(tmp_path / "out"))).orderBy("row_idx").collect()
    assert [(r["page_num"], r["text"], r["bbox"]) for r in back] == [(1, "Oldenburgcastle stronghold northernwall", [45, 90, 70, 100]), (2, "secondpage", [0, 0, 0, 0])]
