from pyspark.sql import functions as F

from quire.operators import evaluation, vocabulary
from quire.sources import markup, tables
from tests.conftest import frame


def test_line_csv(spark, tmp_path):
    (tmp_path / "a.csv").write_text('file,page,line,categ,quality_score,text\nd,2,x, Clear ,0.9,"two\nlines, one ""cell"""\nd,,3,Noisy,bad,\n')
    rows = tables.read_line_csv(spark, str(tmp_path / "a.csv")).orderBy("row_idx").collect()
    assert [(r["file"], r["page_num"], r["line_num"], r["categ"], r["quality_score"]) for r in rows] == [("d", 2, 0, "Clear", 0.9), ("d", 0, 3, "Noisy", None)]
    assert rows[0]["text"] == 'two\nlines, one "cell"' and rows[1]["text"] == ""


def test_manifest_and_page_texts(spark, tmp_path):
    (tmp_path / "m.csv").write_text("file,page_num,tier,split\n docA ,1.0,clean,train\ndocB,2,hard,test\n")
    got = tables.read_manifest(spark, str(tmp_path / "m.csv"), "train").collect()
    assert [(r["file"], r["page_num"], r["tier"]) for r in got] == [("docA", 1, "clean")]
    root = tmp_path / "texts"
    (root / "docA").mkdir(parents=True)
    (root / "docA" / "docA-1.txt").write_text("nested")
    (root / "docA-1.txt").write_text("flat")
    (root / "docB-2.txt").write_text("b\n")
    got = {(r["file"], r["page_num"]): r["text"] for r in tables.read_page_texts(spark, str(root)).collect()}
    assert got == {("docA", 1): "nested", ("docB", 2): "b\n"}


def test_entities(spark, tmp_path):
    (tmp_path / "docA-1.entities.tsv").write_text("# types\nPER\tJan\n\nLOC\tPraha\n")
    (tmp_path / "docB-2.entities.tsv").write_text("# none\n")
    got = sorted(((r["file"], r["page_num"], r["type"], r["text"]) for r in tables.read_entities(spark, str(tmp_path)).collect()), key=str)
    assert got == [("docA", 1, "LOC", "Praha"), ("docA", 1, "PER", "Jan"), ("docB", 2, None, None)]


def test_conllu(spark, tmp_path):
    row = lambda i, form, misc="_": f"{i}\t{form}\t{form}\tX\t_\t_\t0\troot\t_\t{misc}"
    (tmp_path / "a.conllu").write_text("\n".join(["# sent_id = s1", "# text = a bc", row("1-2", "abc"), row(1, "a", "SpaceAfter=No|ner=B-PER"), row(2, "bc"), "", "# page_break = true", row(1, "d"), ""]))
    rows = markup.read_conllu(spark, str(tmp_path)).orderBy("sent", "tok").collect()
    assert [(r["sent"], r["sent_id"], r["form"], r["page_break"], r["space_after"]) for r in rows] == [(0, "s1", "a", False, False), (0, "s1", "bc", False, True), (1, None, "d", True, True)]
    assert rows[0]["misc"]["ner"] == "B-PER"


def test_teitok(spark, tmp_path):
    (tmp_path / "a.xml").write_text('<TEI><text><pb n="3"/><lb/><s text="Hi there"><tok bbox="1 2 3 4">Hi</tok><tok>there</tok></s><pb/><lb/><s><tok>End</tok></s></text></TEI>')
    (tmp_path / "b.xml").write_text("<TEI><s>")
    rows = markup.read_teitok(spark, str(tmp_path)).orderBy(F.col("error").isNotNull(), "row_idx").collect()
    assert [(r["page_num"], r["line_num"], r["text"]) for r in rows[:2]] == [(3, 1, "Hi there"), (4, 2, "End")]
    assert rows[0]["tokens"][0]["bbox"] == "1 2 3 4" and rows[2]["error"] and len(rows) == 3


def test_prompt_terms_leave_excluded_themes_out(spark):
    facets = frame(spark, [("A", None), ("B", False), ("_settings", True)], "theme string, in_prompt boolean")
    assert {r[0] for r in vocabulary.excluded_themes(facets).collect()} == {"B", "Other"}
    nested = frame(spark, [(2, 1, "C", None, "c"), (1, 2, "A", "s", "a2"), (1, 1, "A", "s", "a1"), (3, 1, "B", None, "b"), (9, 1, "Other", None, "o")], "theme_ord int, term_ord int, theme string, sub string, label string")
    got = vocabulary.prompt_terms(nested, facets, "none").orderBy("pos").collect()
    assert [(r["pos"], r["label"]) for r in got] == [(1, "none"), (2, "a1"), (3, "a2"), (4, "c")]


def test_subs_and_term_pairs(spark):
    terms = frame(spark, [("t", "1", "Root", "root", 1, "x"), ("t", "10", "Dům", "house", 2, "x"), ("t", "2", "dům ", "home", 2, "y"), ("a", "7", "Hrad", None, 1, None)], "source string, source_id string, label string, label_en string, depth int, sub string")
    pairs, lost = vocabulary.term_pairs(terms, ("t",))
    assert [(r["source_id"], r["label_en"]) for r in pairs.collect()] == [("2", "home")]
    assert [(r["kept_id"], r["dropped_id"]) for r in lost.collect()] == [("2", "10")]
    names = frame(spark, [("x", "Ex")], "sub string, sub_label string")
    got = vocabulary.rename_subs(terms, names)
    assert got.columns == terms.columns and {r["source_id"]: r["sub"] for r in got.collect()} == {"1": "Ex", "10": "Ex", "2": "y", "7": None}


def test_score_csv(spark, tmp_path):
    scores = frame(spark, [("m", 2, 0.12345678, None)], "model string, n_pages int, cer double, wer double")
    evaluation.write_scores(scores, str(tmp_path / "s"), ["model", "wer", "cer", "n_pages"])
    text = "".join(f.read_text() for f in (tmp_path / "s").glob("*.csv"))
    assert text.split() == ["model,wer,cer,n_pages", "m,,0.123457,2"]
