"""Operators that no query reaches: each with its defined results on a few rows."""

import pytest
from pyspark.sql import functions as F

from quire.operators import evaluation, layout, lines, provenance, records, stratify, vocabulary
from quire.plans import enrich
from quire.sources import markup, tables
from tests.conftest import frame


def rows_of(df):
    return sorted(map(tuple, df.collect()), key=str)


def test_line_directory(spark, tmp_path):
    (tmp_path / "a.csv").write_text("file,page_num,categ,quality_score\nd,1,Clear,0.9\nd,x,Noisy,nan\n")
    (tmp_path / "b.csv").write_text("categ,file,quality_score,page_num,extra\nTrash,e,,2.0,z\n")
    (tmp_path / "c.csv").write_text("other\n1\n")
    paths = [str(tmp_path / f"{k}.csv") for k in "abc"]
    assert rows_of(tables.read_line_directory(spark, paths)) == [("d", 0, "Noisy", None), ("d", 1, "Clear", 0.9), ("e", 2, "Trash", None)]
    with pytest.raises(ValueError):
        tables.read_line_directory(spark, paths[2:])


def test_drift_has_both_sides_and_counts_repeats(spark):
    old, new = frame(spark, [("a",), ("a",), ("b",)], "label string"), frame(spark, [("a",), ("c",)], "label string")
    assert rows_of(vocabulary.drift(old, new)) == [("a", "old"), ("b", "old"), ("c", "new")] and vocabulary.drift(old, old).isEmpty()


def test_first_writer_and_dropped_fields(spark):
    df = frame(spark, [("d", 2, "x", "p"), ("d", 1, None, "q"), ("e", 1, None, "r"), ("d", 3, "x", None)], "doc string, ordinal int, a string, b string")
    got = {r["doc"]: (r["a"], r["b"], r["conflicts"]) for r in records.first_writer(df, "doc", ["a", "b"]).collect()}
    assert got == {"d": ("x", "q", ["b"]), "e": (None, "r", [])}
    assert df.select(records.dropped_fields(F.array(F.lit("x"), F.lit("id"), F.lit("own")), ["own"], ["id"])).first()[0] == ["x"]


def test_blocks_and_paragraphs_follow_reading_order_over_columns(spark):
    left = [("d", 1, i, 10.0 * i, 10.0 * i + 8, 10.0) for i in range(4)]
    right = [("d", 1, 4 + i, 10.0 * i + (30 if i > 1 else 0), 10.0 * i + 8 + (30 if i > 1 else 0), 10.0 if i < 3 else 14.0) for i in range(4)]
    df = frame(spark, left + right, "doc_id string, page int, row_idx int, y0 double, y1 double, size double").repartition(3)
    groups = [r["group_id"] for r in layout.paragraph_groups(df).orderBy("row_idx").collect()]
    blocks = [r["block_id"] for r in layout.text_blocks(df).orderBy("row_idx").collect()]
    assert groups == [0, 0, 0, 0, 0, 0, 1, 1] and blocks == [0, 0, 0, 0, 0, 0, 1, 2]


def test_lines_outside_tables(spark):
    text = frame(spark, [(1, 0.0, 0.0, 10.0, 4.0), (1, 0.0, 10.0, 10.0, 14.0), (1, 50.0, 10.0, 60.0, 14.0), (2, 0.0, 10.0, 10.0, 14.0)], "page int, x0 double, y0 double, x1 double, y1 double").withColumn("doc_id", F.lit("d"))
    table = frame(spark, [("d", 1, 0.0, 8.0, 20.0, 20.0)], "doc_id string, page int, x0 double, y0 double, x1 double, y1 double")
    assert rows_of(layout.outside_tables(text, table).select("page", "x0", "y0")) == [(1, 0.0, 0.0), (1, 50.0, 10.0), (2, 0.0, 10.0)]


def test_resume_and_messages(spark):
    work, done = frame(spark, [("a",), ("b",), ("b",)], "file string"), frame(spark, [("b",), ("z",)], "file string")
    assert rows_of(lines.resume(work, done)) == [("a",)]
    sent = frame(spark, [("ctx",)], "context string").select(lines.messages(F.lit("sys"), task="Do.")).first()[0]
    assert [tuple(m) for m in sent] == [("system", "sys"), ("user", "DOCUMENT CONTEXT:\nctx\n\nDo.")]


def test_entity_spans(spark):
    tags = ["B-p", "I-x", "O", "I-p", "B-g", "B-g", None, "I-g"]
    df = frame(spark, [("f", 0, i, f"w{i}", t) for i, t in enumerate(tags)], "file string, sent int, tok int, form string, ner string")
    assert rows_of(markup.entity_spans(df).select("type", "first", "last", "text")) == [("g", 4, 4, "w4"), ("g", 5, 5, "w5"), ("p", 0, 1, "w0 w1")]


def test_compared_extractions(spark):
    a = frame(spark, [("x", 1, 0.0, 5.0), ("y", 1, 0.0, 5.0)], "text string, page int, x0 double, x1 double")
    b = frame(spark, [("x", 1, 0.2, 6.0), ("z", 1, 0.0, 5.0)], "text string, page int, x0 double, x1 double")
    got = {r["text"]: (r["side"], r["max_delta"], r["moved"]) for r in evaluation.compare_extractions(a, b, ["text", "page"], ["x0", "x1"]).collect()}
    assert got == {"x": ("both", 1.0, True), "y": ("only_a", None, None), "z": ("only_b", None, None)}


def test_components_counts_tiers_scales_and_budgets(spark):
    parts = frame(spark, [("r", "t", "MIT", 2), ("r", "t", "mit", 1), ("r", "t", "Apache-2.0", 3)], "run string, name string, license string, ordinal int")
    assert sorted(r["ordinal"] for r in provenance.union_components(parts, "run").collect()) == [1, 3]
    stages = frame(spark, [("p", {"a": 1, "b": 2}), ("p", {"a": 3}), ("q", None)], "pipeline string, counts map<string,int>")
    assert rows_of(provenance.output_counts(stages)) == [("p", "a", 4), ("p", "b", 2)]
    tiers = frame(spark, [("overall",), ("zeta",), ("hard",), ("clean",)], "tier string")
    assert [r[0] for r in tiers.orderBy(stratify.tier_order(), "tier").collect()] == ["clean", "hard", "zeta", "overall"]
    sizes = frame(spark, [(200.0, 100.0, 3.0), (None, 100.0, 3.0), (None, 0.0, None)], "image double, page double, dpi double")
    assert [r[0] for r in sizes.select(layout.page_scale(F.col("image"), F.col("page"), F.col("dpi"))).collect()] == [2.0, 3.0, 1.0]
    prompts = frame(spark, [("x" * 40,), ("x" * 44,)], "p string")
    assert [r[0] for r in prompts.select(enrich.within_budget(F.col("p"), 10)).collect()] == [True, False]


def test_nested_vocabulary_as_json(spark):
    nested = frame(spark, [(2, "B", 1, "b1", None), (1, "A", 2, "a2", "s"), (1, "A", 1, "a1", None)], "theme_ord int, theme string, term_ord int, label string, sub string")
    got = vocabulary.nested_json(nested).collect()
    assert [r["theme"] for r in got] == ["A", "B"] and got[0]["terms"] == '[{"term_ord":1,"label":"a1"},{"term_ord":2,"label":"a2","sub":"s"}]'


def test_retries_wait_and_give_up(monkeypatch):
    waits, calls = [], []
    monkeypatch.setattr(enrich.time, "sleep", waits.append)

    def ask(prompt):
        calls.append(prompt)
        if prompt == "dead" or len(calls) < 3:
            raise OSError("busy")
        return prompt.upper()

    assert list(enrich.RetryingPredictor(ask, attempts=4)(iter(["a"]))) == ["A"] and waits == [1.0, 2.0]
    with pytest.raises(OSError):
        list(enrich.RetryingPredictor(ask, attempts=7, most=8.0)(iter(["dead"])))
    assert waits[2:] == [1.0, 2.0, 4.0, 8.0, 8.0, 8.0]
