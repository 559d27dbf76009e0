import json
import struct
import zipfile

import pytest
from pyspark.sql import functions as F

from quire.sources import harvest, markup, tables
from quire.streaming import lines as stream
from tests.conftest import frame


def test_alto(spark, tmp_path):
    def string(text, x):
        return f'<String CONTENT="{text}" HPOS="{x}" VPOS="5" WIDTH="10" HEIGHT="4"/>'

    page = lambda nr, *rows: f'<Page ID="p" {nr} WIDTH="100" HEIGHT="50"><PrintSpace><TextBlock>' + "".join(f"<TextLine>{r}</TextLine>" for r in rows) + "</TextBlock></PrintSpace></Page>"
    (tmp_path / "a.xml").write_text("<alto><Layout>" + page('PHYSICAL_IMG_NR="7"', string("Hello", 1) + string("you", 20), string("end", 3)) + page("", string("x", 0)) + "</Layout></alto>")
    strings = markup.read_alto(spark, str(tmp_path))
    got = {(r["page_num"], r["line"]): r for r in markup.alto_lines(strings).collect()}
    assert {k: r["text"] for k, r in got.items()} == {(7, 0): "Hello you", (7, 1): "end", (2, 0): "x"}
    assert [got[7, 0][c] for c in ("x0", "y0", "x1", "y1")] == [1.0, 5.0, 30.0, 9.0]
    assert strings.select("page_width", "page_height").distinct().collect() == [(100.0, 50.0)]


def test_docx(spark, tmp_path):
    w = 'xmlns:w="http://schemas.openxmlformats.org/wordprocessingml/2006/main"'
    p = lambda t, style="", bold="": f"<w:p>{style}<w:r>{bold}<w:t>{t}</w:t></w:r></w:p>"
    body = p("Title", '<w:pPr><w:pStyle w:val="Heading2"/></w:pPr>') + p("text", bold="<w:rPr><w:b/></w:rPr>") + f"<w:tbl><w:tr><w:tc>{p('a')}</w:tc><w:tc>{p('b')}{p('c')}</w:tc></w:tr></w:tbl>"
    with zipfile.ZipFile(tmp_path / "a.docx", "w") as z:
        z.writestr("word/document.xml", f"<w:document {w}><w:body>{body}</w:body></w:document>")
    (tmp_path / "b.docx").write_bytes(b"no zip")
    rows = markup.read_docx(spark, str(tmp_path)).orderBy("file", "row_idx").collect()
    assert [(r["kind"], r["level"], r["text"], r["bold"], r["table_no"], r["cell_row"], r["cell_col"]) for r in rows[:4]] == [
        ("heading", 2, "Title", False, None, None, None),
        ("paragraph", None, "text", True, None, None, None),
        ("cell", None, "a", False, 0, 0, 0),
        ("cell", None, "b\nc", False, 0, 0, 1),
    ]
    assert len(rows) == 5 and rows[4]["error"]


def test_image_headers(spark, tmp_path):
    (tmp_path / "a.png").write_bytes(b"\x89PNG\r\n\x1a\n" + struct.pack(">I4sII", 13, b"IHDR", 640, 480) + b"\0" * 9)
    (tmp_path / "b.jpg").write_bytes(b"\xff\xd8\xff\xe0\x00\x04ab\xff\xc0\x00\x11\x08" + struct.pack(">HH", 30, 40) + b"\0" * 12)
    (tmp_path / "c.tif").write_bytes(b"II*\0" + struct.pack("<I", 8) + struct.pack("<H", 2) + struct.pack("<HHIHH", 256, 3, 1, 70, 0) + struct.pack("<HHII", 257, 4, 1, 80))
    (tmp_path / "d.bin").write_bytes(b"nothing")
    files = spark.read.format("binaryFile").load(str(tmp_path))
    assert files.count() == 4
    got = {r["path"].rpartition("/")[2]: (r["width"], r["height"]) for r in markup.read_image_sizes(spark, str(tmp_path)).collect()}
    assert got == {"a.png": (640, 480), "b.jpg": (40, 30), "c.tif": (70, 80), "d.bin": (None, None)}


def test_oai_pages(spark, tmp_path):
    page = lambda ids, token: "<OAI><ListRecords>" + "".join(f"<record><header><identifier>{i}</identifier></header></record>" for i in ids) + f"<resumptionToken>{token}</resumptionToken></ListRecords></OAI>"
    (tmp_path / "page1.xml").write_text(page(["a", "b"], "t1"))
    (tmp_path / "page2.xml").write_text(page(["b", "c"], "t2"))
    spark.dataSource.register(harvest.OaiSource)
    read = lambda: spark.read.format("oai").option("url", str(tmp_path)).load().collect()
    rows = read()
    assert [r["identifier"] for r in rows] == ["a", "b", "c", None] and "FileNotFoundError" in rows[3]["error"]
    (tmp_path / "page3.xml").write_text(page(["d"], ""))
    assert [(r["page"], r["identifier"], r["error"]) for r in read()] == [(1, "a", None), (1, "b", None), (2, "c", None), (3, "d", None)]
    (tmp_path / "page3.xml").write_text("<!DOCTYPE x>" + page(["d"], ""))
    assert "document type" in read()[-1]["error"]


def test_a_harvest_without_end_says_so(tmp_path, monkeypatch):
    monkeypatch.setattr(harvest, "MAX_PAGES", 2)
    for k in (1, 2, 3):
        (tmp_path / f"page{k}.xml").write_text(f"<OAI><record><identifier>{k}</identifier></record><resumptionToken>t</resumptionToken></OAI>")
    rows = list(harvest.OaiReader({"url": str(tmp_path)}).read(None))
    assert [r[1] for r in rows] == ["1", "2", None] and rows[-1][3] == "more than 2 pages"


def test_page_statistics(spark, tmp_path):
    (tmp_path / "s.csv").write_text("file,page_num,avg_quality_score,Clear\nd,2.0,0.5,7\nd,x,nan,\n")
    rows = tables.read_page_stats(spark, str(tmp_path / "s.csv")).orderBy("page_num").collect()
    assert [(r["page_num"], r["avg_quality_score"], r["Clear"], r["Noisy"]) for r in rows] == [(0, None, 0, 0), (2, 0.5, 7, 0)]
    (tmp_path / "bad.csv").write_text("file,Clear\nd,1\n")
    with pytest.raises(ValueError, match="page_num"):
        tables.read_page_stats(spark, str(tmp_path / "bad.csv"))


def test_vocabulary_and_records(spark, tmp_path):
    (tmp_path / "v.json").write_text(json.dumps({"_meta": {"n": 2}, "terms": [{"cs": "hrad", "en": "castle"}, {"cs": "dům", "en": None}]}))
    assert {(r["cs"], r["en"]) for r in tables.read_vocabulary(spark, str(tmp_path / "v.json")).collect()} == {("hrad", "castle"), ("dům", None)}
    (tmp_path / "d").mkdir()
    (tmp_path / "d" / "a.json").write_text('{"doc_id": "A", "schema_version": "1.9", "unknown": [1]}')
    (tmp_path / "d" / "b.json").write_text('{"doc_id": "B"}')
    read = tables.read_json_documents(spark, str(tmp_path / "d"))
    assert {(r["doc_id"], r["schema_version"]) for r in read.select("doc_id", "schema_version").collect()} == {("A", "1.9"), ("B", "1.0")}
    assert read.where("doc_id = 'A'").select(F.to_json("record").alias("j")).first()["j"].count("unknown") == 1
    (tmp_path / "d" / "c.json").write_text('{"doc_id": "C", "schema_version": "2.0"}')
    with pytest.raises(Exception, match="too new"):
        tables.read_json_documents(spark, str(tmp_path / "d")).collect()


def drained(df, tmp_path, name):
    q = df.writeStream.format("memory").queryName(name).option("checkpointLocation", str(tmp_path / name)).trigger(availableNow=True).start()
    q.awaitTermination(120)
    assert q.exception() is None
    return df.sparkSession.table(name).collect()


def test_stream_of_lines(spark, tmp_path):
    rows = [("d", 0, 1, 1, "Clear", 0.99, "a clear line of text"), ("d", 1, 1, 2, "Empty", 0.0, ""), ("d", 2, 1, 3, "Trash", 0.1, "#%$#")]
    frame(spark, rows, stream.SCHEMA).write.parquet(str(tmp_path / "in"))
    got = drained(stream.stream_filtered(stream.stream_lines(spark, str(tmp_path / "in"))), tmp_path, "kept_lines")
    assert [r["row_idx"] for r in got] == [0]


def test_stream_is_cut_off_after_errors(spark, tmp_path):
    schema = "file string, row_idx bigint, status string"
    statuses = {"d": ["error", "ok", "error", "skip", "error", "ok", "ok"], "e": ["error", "ok", "error"]}
    frame(spark, [(f, i, s) for f, ss in statuses.items() for i, s in enumerate(ss)], schema).write.parquet(str(tmp_path / "in"))
    spark.conf.set("spark.sql.streaming.stateStore.providerClass", "org.apache.spark.sql.execution.streaming.state.RocksDBStateStoreProvider")
    got = drained(stream.stream_cutoff(spark.readStream.schema(schema).parquet(str(tmp_path / "in")), 2), tmp_path, "cut_attempts")
    rows = {f: [(r["row_idx"], r["error_run"]) for r in sorted(got, key=lambda r: r["row_idx"]) if r["file"] == f] for f in "de"}
    assert rows == {"d": [(0, 1), (1, 0), (2, 1), (3, 1), (4, 2)], "e": [(0, 1), (1, 0), (2, 1)]}
