import random
import xml.etree.ElementTree as ET

from pyspark.sql import functions as F

from quire.operators import teitok
from quire.plans import catalogue
from quire.sources import markup
from tests.conftest import frame

TOKENS = "doc string, sent int, tok int, sent_id string, sent_text string, page_break boolean, id string, form string, lemma string, upos string, head string, deprel string, space_after boolean, ner string, page_num int, block_id string, line_id string, line_box array<double>, x0 double, y0 double, x1 double, y1 double"


def token(doc, sent, tok, form, sent_id="1", ner="O", page=None, block=None, line=None, box=(None,) * 4, upos="NOUN", head="0", space=True, brk=False):
    return (doc, sent, tok, sent_id, f"S{sent}", brk, str(tok + 1), form, "_", upos, head, "dep", space, ner, page, block, line, [0.0, 0.0, 10.0, 5.0] if line else None, *box)


def parse(df):
    return {r[0]: ET.fromstring(r["xml"].encode()) for r in df.collect()}


def tags(root):
    return [e.tag for e in root.find("text/body").iter()][1:]


def test_nesting_pages_blocks_lines_and_names(spark):
    box = (100.0, 200.0, 150.0, 220.0)
    rows = [
        token("d", 0, 0, "Jan", ner="B-pf", page=1, block="b1", line="l1", box=box), token("d", 0, 1, "Novák", ner="I-ps", page=1, block="b1", line="l2", box=box, head="1"), token("d", 0, 2, ",", upos="PUNCT", space=False, head="9"),
        token("d", 1, 0, "I", "2", ner="I-gu", page=1, block="b1", line="l2", box=box), token("d", 1, 1, "v", "2", ner="B-gu|B-x", page=1, block="b2", box=box),
        token("d", 2, 0, "<&\">", "3", ner="B-zz", page=2, block="b2", line="l2", box=box), token("d", 2, 1, "x", "3", ner="B-gu"),
    ]
    pages = frame(spark, [("d", 1, 0.5, 0.5, 10.0, 20.0, 800, 600, ".jpg"), ("d", 2, None, None, None, None, None, None, None)], "doc string, page_num int, sx double, sy double, dx double, dy double, width int, height int, extension string")
    blocks = frame(spark, [("d", "b1", [10.0, 20.0, 30.0, 40.0])], "doc string, block_id string, box array<double>")
    figures = frame(spark, [("d", 2, None, "image", [1.0, 2.0, 3.0, 4.0])], "doc string, page_num int, id string, type string, box array<double>")
    root = parse(teitok.write_teitok(frame(spark, rows, TOKENS).repartition(3), pages, blocks, figures))["d"]
    assert tags(root) == ["pb", "div", "s", "name", "lb", "tok", "lb", "tok", "tok", "s", "tok", "name", "tok", "pb", "figure", "div", "s", "name", "tok", "name", "tok"]
    found = root.findall(".//tok")
    assert [t.text for t in found] == ["Jan", "Novák", ",", "I", "v", '<&">', "x"]
    assert found[0].get("bbox") == "45 90 70 100" and found[5].get("bbox") == "100 200 150 220" and found[2].get("bbox") is None
    assert (found[1].get("head"), found[2].get("head"), found[0].get("head")) == ("d.s1.w1", "9", None)
    assert found[2].get("type") == "pc" and found[2].get("join") == "right" and found[0].get("lemma") is None
    names = [(n.get("type"), n.get("cnec")) for n in root.iter("name")]
    assert names == [("PER", "pf"), ("LOC", "gu"), ("MISC", "zz"), ("LOC", "gu")]
    assert [d.get("bbox") for d in root.iter("div")] == ["0 0 10 10", None]
    assert [s.get("lrx") for s in root.iter("surface")] == ["800", None] and [p.get("facs") for p in root.iter("pb")] == ["d-1.jpg", "d-2.png"]


def test_pages_without_boxes(spark):
    rows = [token("a", 0, 0, "p1", "1"), token("a", 1, 0, "p1", "2"), token("a", 2, 0, "p2", "1"), token("a", 3, 0, "p3", "5", brk=True), token("b", 0, 0, "no page", "7"), token("c", 0, 0, None, "1")]
    got = parse(teitok.write_teitok(frame(spark, rows, TOKENS)))
    assert [p.get("n") for p in got["a"].iter("pb")] == ["1", "2", "3"] and len(list(got["a"].iter("div"))) == 4
    assert not list(got["b"].iter("pb")) and got["c"].find(".//tok").text is None
    assert teitok.write_teitok(frame(spark, [], TOKENS)).collect() == []


def test_what_is_not_given_is_not_joined(spark):
    rows = frame(spark, [token("a", 0, 0, "x")], TOKENS).select("doc", "sent", "tok", "form")
    plan = teitok.write_teitok(rows)._jdf.queryExecution().optimizedPlan().toString()
    assert plan.count("Join ") == 2


def whole(tokens):
    """Token rows as documents with arrays."""
    fields = [c for c in tokens.columns if c not in ("doc", "sent", "sent_id", "sent_text", "page_break")]
    toks = tokens.groupBy("doc", "sent").agg(F.sort_array(F.collect_list(F.struct("tok", *fields))).alias("tokens"), *(F.min_by(c, "tok").alias(c) for c in ("sent_id", "sent_text")), F.bool_or("page_break").alias("page_break"))
    return toks.groupBy("doc").agg(F.sort_array(F.collect_list(F.struct("sent", "sent_id", "sent_text", "page_break", "tokens"))).alias("sents"))


def test_whole_documents_read_as_their_tokens(spark):
    draw, rows = random.Random(5), []
    for d in range(12):
        for sent in range(draw.choice([1, 3, 40])):
            page, brk = draw.choice([None, None, 1 + sent // 4]), draw.random() < 0.1
            for tok in range(draw.choice([1, 4, 30])):
                ner = draw.choice(["O", "B-gu", "I-gu", "I-x", "B-pf|B-ps", None])
                box = (1.0, 2.0, 3.0, 4.0) if draw.random() < 0.6 else (None, 1.0, None, 2.0)
                at = page if draw.random() < 0.5 else None
                line = draw.choice([None, f"l{tok // 5}", f"l{sent}"])
                rows.append(token(f"d&{d}" if d % 3 else f"d{d}", sent, tok, draw.choice(["a", "<b>", '"&', "ž", None]), str(draw.choice([1, 2, sent])), ner, at, draw.choice(["b1", "b2", None]) if at else None, line, box, draw.choice(["NOUN", "PUNCT"]), draw.choice(["0", "1", "3", "99", "_"]), draw.random() < 0.5, brk))
    tokens = frame(spark, rows, TOKENS)
    pages = frame(spark, [(f"d{d}", p, 0.5, 2.0, 1.0, 0.0, 800, 600, ".jpg") for d in range(0, 12, 3) for p in (1, 2, 4)], "doc string, page_num int, sx double, sy double, dx double, dy double, width int, height int, extension string")
    blocks = frame(spark, [(f"d{d}", b, [10.0, 20.0, 30.0, 40.0]) for d in range(0, 12, 3) for b in ("b1", "block_2")], "doc string, block_id string, box array<double>")
    figures = frame(spark, [("d3", 2, None, "image", [1.0, 2.0, 3.0, 4.0]), ("d3", 2, "f", "map", None), ("d6", 1, None, "image", None)], "doc string, page_num int, id string, type string, box array<double>")
    meta = frame(spark, [("d0", "T")], "doc string, title string")
    few = tokens.select("doc", "sent", "tok", "form")
    for given in ((pages, blocks, figures, meta), ()):
        rows, docs = ({r["doc"]: r["xml"] for r in df.collect()} for df in (teitok.write_teitok(tokens, *given), teitok.write_documents(whole(tokens), *given)))
        assert len(rows) == 12 and docs == rows
    plain = few.groupBy("doc", "sent").agg(F.sort_array(F.collect_list(F.struct("tok", "form"))).alias("tokens")).groupBy("doc").agg(F.sort_array(F.collect_list(F.struct("sent", "tokens"))).alias("sents"))
    assert {tuple(r) for r in teitok.write_documents(plain).collect()} == {tuple(r) for r in teitok.write_teitok(few).collect()}


def test_whole_documents_stay_where_they_are(spark, tmp_path):
    frame(spark, [(1, "a b\n\n <c> d e f g"), (2, " \n"), (3, None), (4, "x")], "doc_id bigint, text string").write.parquet(str(tmp_path / "documents.parquet"))
    got = catalogue.QUERIES["teitok_documents"](spark, str(tmp_path))
    assert "Exchange" not in got._jdf.queryExecution().executedPlan().toString()
    assert sorted(map(tuple, got.collect())) == [(1, 7, 2, 2, 1, 2, 3, 9), (4, 1, 1, 1, 1, 1, 1, 1)]


def test_long_names_and_lines_with_gaps(spark):
    long = [(f"t{k}", "B-gu" if k == 0 else "I-gu" if k < 40 else "O", f"l{k // 10}" if k % 3 == 0 else None) for k in range(50)]
    docs = frame(spark, [("d", [(long,), ([],), ([("u", "I-gu", "l4"), ("v", None, "l5")],)])], "doc string, sents array<struct<tokens: array<struct<form: string, ner: string, line_id: string>>>>")
    root = parse(teitok.write_documents(docs))["d"]
    assert [len(n.findall("tok")) for n in root.iter("name")] == [40]
    assert [b.get("id") for b in root.iter("lb")] == ["d.l0", "d.l1", "d.l2", "d.l3", "d.l4", "d.l5"]
    assert len(root.findall(".//s")) == 2 and len(root.findall(".//tok")) == 52


def test_conllu_to_teitok_and_back(spark, tmp_path):
    (tmp_path / "in").mkdir()
    (tmp_path / "out").mkdir()
    text = "# sent_id = 1\n# text = Dům stojí.\n1\tDům\tdům\tNOUN\tN\tCase=Nom\t2\tnsubj\t_\t_\n2\tstojí\tstát\tVERB\tV\t_\t0\troot\t_\tSpaceAfter=No\n3\t.\t.\tPUNCT\tZ\t_\t2\tpunct\t_\t_\n\n"
    text += "# sent_id = 2\n# text = V & <Praze>\n1\tV\tv\tADP\tR\t_\t2\tcase\t_\t_\n2\t&\t&\tSYM\t_\t_\t0\troot\t_\tNER=B-gu\n3\t<Praze>\tPraha\tPROPN\tN\t_\t2\tobl\t_\tNER=I-gu\n\n"
    (tmp_path / "in" / "doc.conllu").write_text(text, encoding="utf-8")
    tokens = markup.read_conllu(spark, str(tmp_path / "in")).withColumnRenamed("file", "doc").selectExpr("*", "element_at(misc, 'NER') AS ner")
    meta = tokens.selectExpr("doc", "'T & t' AS title", "'UDPipe 2' AS generator", "'m' AS model", "'2024-01-01' AS date", "'a.xml' AS source_file", "'tess' AS ocr").distinct()
    (xml,) = [r["xml"] for r in teitok.write_teitok(tokens, meta=meta).collect()]
    (tmp_path / "out" / "doc.teitok.xml").write_text(xml, encoding="utf-8")
    back = markup.read_teitok(spark, str(tmp_path / "out")).orderBy("row_idx").collect()
    assert [(r["text"], r["page_num"], [t["form"] for t in r["tokens"]]) for r in back] == [("Dům stojí.", 1, ["Dům", "stojí", "."]), ("V & <Praze>", 1, ["V", "&", "<Praze>"])]
    root = ET.fromstring(xml.encode())
    assert root.find(".//title").text == "T & t" and [a.get("ident") for a in root.iter("application")] == ["udpipe", "ocr"] and len(root.findall(".//change")) == 2
