import json

import pytest
from pyspark.sql import functions as F

from quire.operators import records, vocabulary
from quire.plans import enrich
from tests.conftest import frame


def test_a_baseline_names_the_record(spark):
    derived = frame(spark, [("p1", "D-1"), ("p2", "E")], "path string, doc_id string")
    got = {r["path"]: r for r in records.inherit_ids(derived, frame(spark, [("p1", "D"), ("p2", "")], "path string, doc_id string")).collect()}
    assert (got["p1"]["doc_id"], got["p1"]["note"], got["p1"]["had_baseline"]) == ("D", "derived D-1, kept D", True)
    assert (got["p2"]["doc_id"], got["p2"]["note"], got["p2"]["had_baseline"]) == ("E", None, False)


def test_blocks_are_replaced_by_their_owner(spark):
    schema = "doc_id string, block string, body string"
    old = frame(spark, [("d", "pages", "[1]"), ("d", "lines", "[2]"), ("e", "pages", "[3]")], schema)
    own = frame(spark, [("d", "pages", "[9]"), ("d", "forms", "[8]")], schema)
    got, complaints = records.replace_blocks(old, own, {"pages": ("alto",), "lines": ("alto",)}, "forms-tool")
    assert {(r["doc_id"], r["block"], r["body"]) for r in got.collect()} == {("d", "pages", "[9]"), ("d", "lines", "[2]"), ("e", "pages", "[3]"), ("d", "forms", "[8]")}
    assert [(r["block"], r["complaint"]) for r in complaints.collect()] == [("pages", "not owned by forms-tool")]


def test_accretion_and_contributors(spark):
    entries = frame(spark, [("d", "derived_from", "alto", "a", 1), ("d", "derived_from", "alto", "b", 2), ("d", "regenerable", "md", "r", 1)], "doc_id string, kind string, key string, value string, ordinal int")
    assert {(r["key"], r["value"]) for r in records.accrete(entries).collect()} == {("alto", "b"), ("md", "r")}
    stamps = frame(spark, [("d", "p", "r1", "pages", "t1", 1), ("d", "p", "r1", "lines", "t2", 0), ("d", "p", "r1", "pages", "t3", 2)], "doc_id string, program string, run_id string, block string, updated_at string, ordinal int")
    assert [(r["blocks"], r["updated_at"]) for r in records.contributors(stamps).collect()] == [("lines,pages", "t3")]


def test_a_record_keeps_the_order_of_keys(spark):
    rows = [("d", "zz\"new", "1"), ("d", "lines", '[{"page":"1"}]'), ("d", "source", '{"o":"é"}'), ("d", "forms", None), ("d", "record_type", '"document"')]
    text = records.record_json(frame(spark, rows, "doc_id string, block string, body string")).first()["record"]
    assert list(json.loads(text)) == ["record_type", "doc_id", "source", "lines", 'zz"new'] and json.loads(text)["source"] == {"o": "é"}


def test_digital_blocks(spark):
    pages = frame(spark, [("d", "i", 2, 5.0), ("d", "1", 1, None)], "doc_id string, page string, ordinal int, width double")
    lines = frame(spark, [("d", 1, "i", "two"), ("d", 0, "1", "one")], "doc_id string, row_idx int, page string, text string")
    got = {r["block"]: json.loads(r["body"]) for r in records.digital_blocks(pages, lines).collect()}
    assert [p["page"] for p in got["pages"]] == ["1", "i"] and "width" not in got["pages"][0]
    assert got["content"] == {"text": "one\ntwo"} and [r["text"] for r in got["lines"]] == ["one", "two"]


TERMS = "source string, source_id string, label string, label_en string, uri string, scheme string, sub string, broader array<string>, sort int, term_id string"


def terms(spark):
    return frame(
        spark,
        [
            ("thesaurus", "10", "Hrad", "castle", "u", "s", None, ["1", "2"], None, "t10"),
            ("thesaurus", "9", "Dům", None, None, "s", "x", None, 3, "t9"),
            ("authority", "3", "dům", "house", None, "q", None, None, None, "a3"),
            ("authority", "4", "Pole", "", None, "q", None, None, None, "a4"),
        ],
        TERMS,
    )


def test_vocabulary_files(spark):
    rows = vocabulary.flat_rows(terms(spark)).collect()
    assert [(r["source_id"], r["source_lemma"], r["broader"], r["sort"]) for r in rows] == [("3", "dům", "", ""), ("4", "pole", "", ""), ("9", "dům", "", "3"), ("10", "hrad", "1 2", "")]
    assert [tuple(r) for r in vocabulary.glossary(terms(spark)).collect()] == [("dům", "house"), ("hrad", "castle")]
    assert {tuple(r) for r in vocabulary.harvest_meta(terms(spark)).collect()} == {("authority", 2, 1, 1), ("thesaurus", 2, 1, 1)}


def test_build_targets(spark):
    place = lambda df: df.withColumn("theme", F.when((F.col("source") == "thesaurus") & (F.col("source_id") == "9"), "Buildings").otherwise("Other")).withColumn("placed_by", F.lit("x"))
    got = vocabulary.build_targets(terms(spark), place)
    assert {(r["term_id"], r["theme"], r["placed_by"]) for r in got["authority"].collect()} == {("a3", "Buildings", "rescue"), ("a4", "Other", "x")}
    assert {r["term_id"] for r in got["union"].collect()} == {"t9", "t10", "a4"}
    assert {(r["term_id"], r["theme"]) for r in got["thesaurus"].collect()} == {("t9", "Buildings"), ("t10", "Other")}
    with pytest.raises(ValueError, match="authority"):
        vocabulary.build_targets(terms(spark).where("source = 'thesaurus'"), place)


def test_load_guard(spark, tmp_path):
    nested = frame(spark, [("old", "x")], "theme string, label string")
    with pytest.raises(FileNotFoundError):
        vocabulary.load_nested(spark, str(tmp_path / "none"))
    assert vocabulary.load_nested(spark, str(tmp_path / "none"), rebuild=lambda: nested).count() == 1
    nested.write.parquet(str(tmp_path / "v"))
    assert vocabulary.load_nested(spark, str(tmp_path / "v")).first()["label"] == "x"
    with pytest.raises(FileNotFoundError):
        vocabulary.load_nested(spark, str(tmp_path / "v"), ("old",))


def test_system_prompt(spark):
    rows = [(1, None, None, enrich.META), (2, "A", "s", "castle"), (3, "A", "s", "house"), (4, "B", None, "x" * 500)]
    df = frame(spark, rows, "pos int, theme string, sub string, label string")
    text, labels = enrich.system_prompt(df, "Pick a term.", 60, "Done.")
    assert labels == [enrich.META, "castle", "house"] and text.startswith("Pick a term.\n") and "## A / s: castle; house" in text and text.endswith("Done.")
    with pytest.raises(ValueError):
        enrich.system_prompt(df, "Pick a term.", 12)


def replies(prompts):
    for p in prompts:
        item = {"locator": "here", "page": "iv", "keywords": ["k"], "keywords_en": ["e"], "category": "house", "confidence": "0.5"}
        kind = p.removeprefix("DOCUMENT:\n")
        yield {"good": json.dumps({"items": [item, item | {"category": enrich.META}]}), "none": '{"items": []}', "bad": json.dumps({"items": [item, item | {"confidence": 2}]}), "text": "sorry"}[kind]


def test_documents(spark):
    docs = frame(spark, [(t, t) for t in ("good", "none", "bad", "text")], "file string, text string")
    items, status = enrich.enrich_documents(docs, replies, frame(spark, [("house",)], "category string"))
    assert [(r["file"], r["pos"], r["page"], r["keywords"], r["confidence"]) for r in items.orderBy("pos").collect()] == [("good", 0, "iv", ["k"], 0.5), ("good", 1, "iv", [], 0.5)]
    assert {tuple(r) for r in status.collect()} == {("good", 2, 0, False), ("none", 0, 0, False), ("bad", 0, 1, True), ("text", 0, 1, True)}


def test_deep_trees_are_refused_and_cycles_left_out(spark):
    edges = frame(spark, [("1", None, "a"), ("2", "1", "b"), ("3", "2", "c"), ("2", "3", "b")], "id string, parent_id string, label string")
    got = {r["id"]: (r["depth"], r["broader"], r["sub"]) for r in vocabulary.flatten_tree(spark, edges, 3).collect()}
    assert got == {"1": (1, [], None), "2": (2, ["1"], "b"), "3": (3, ["1", "2"], "b")}
    with pytest.raises(ValueError, match="deeper"):
        vocabulary.flatten_tree(spark, edges, 2)
    tree = frame(spark, [('{"id": "1", "children": [{"id": "2", "children": [{"id": "3"}]}]}',)], "value string")
    assert vocabulary.flatten_json(tree, max_depth=3).count() == 3
    with pytest.raises(ValueError, match="deeper"):
        vocabulary.flatten_json(tree, max_depth=2)
