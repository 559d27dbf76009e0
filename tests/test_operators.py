import math
import random
import unicodedata

import pytest
from pyspark.sql import functions as F

from quire.functions import text as T
from quire.operators import evaluation, layout, lines, provenance, records, stratify, vocabulary
from tests.conftest import frame


def one(spark, column, **values):
    """The value of a column expression over one row."""
    schema = ", ".join(f"{k} {'string' if isinstance(v, str) or v is None else 'double' if isinstance(v, float) else 'int'}" for k, v in values.items())
    return frame(spark, [tuple(values.values())], schema).select(column.alias("x")).first()["x"]


# text ------------------------------------------------------------------------------------------


def distance(a, b):
    row = list(range(len(b) + 1))
    for i, x in enumerate(a, 1):
        new = [i]
        for j, y in enumerate(b, 1):
            new.append(min(row[j] + 1, new[-1] + 1, row[j - 1] + (x != y)))
        row = new
    return row[-1]


def test_error_rates_match_the_definitions(spark):
    rng = random.Random(3)
    words = ["a", "bb", "ccc", "é", "dd", "e", "žluť"]
    pairs = [("", ""), ("", "x"), ("x", ""), ("abc", "abcde"), ("kitten", "sitting")]
    pairs += [(" ".join(rng.choices(words, k=rng.randint(0, 9))), " ".join(rng.choices(words, k=rng.randint(0, 9)))) for _ in range(60)]
    a, b = F.col("a"), F.col("b")
    rows = frame(spark, pairs, "a string, b string").select("a", "b", T.cer(a, b).alias("cer"), T.ned(a, b).alias("ned"), T.wer(a, b).alias("wer"), T._word_distance(a, b).alias("arrow")).collect()
    for r in rows:
        d, w = distance(r["a"], r["b"]), distance(r["a"].split(), r["b"].split())
        assert r["cer"] == pytest.approx(d / len(r["a"]) if r["a"] else float(bool(r["b"])))
        assert r["ned"] == pytest.approx(d / max(len(r["a"]), len(r["b"])) if r["a"] or r["b"] else 0.0)
        assert r["wer"] == pytest.approx(w / len(r["a"].split()) if r["a"] else float(bool(r["b"])))
        assert r["arrow"] == w


def test_normal_forms(spark):
    decomposed = unicodedata.normalize("NFD", "Příliš  žluťoučký")
    assert one(spark, T.normalize_text(F.col("t")), t=f" {decomposed}\t\x1c") == "Příliš žluťoučký"
    assert one(spark, T.fold_label(F.col("t")), t=" Straße A ") == "strasse a"
    assert one(spark, T.fold_label(F.col("t")), t="   ") is None
    assert one(spark, T.strip_ws(F.col("t")), t=" \tx y\n") == "x y"


@pytest.mark.parametrize("value,want", [("7", 7), ("7.0", 7), ("", 0), ("x", 0), (None, 0), (" 8", 8)])
def test_best_effort_int(spark, value, want):
    assert one(spark, T.best_effort_int(F.col("v")), v=value) == want


@pytest.mark.parametrize("path,want", [("/a/b/CTX1.alto.xml", "CTX1"), ("x.y.teitok.xml", "x.y"), ("name.v2.bin", "name"), ("plain", "plain"), ("/q/D_enriched.json", "D")])
def test_canonical_doc_id(spark, path, want):
    assert one(spark, T.canonical_doc_id(F.col("p")), p=path) == want


def test_decode_sanity_and_recovery(spark):
    table = T.misread_letters()
    broken = "hřeby a ocelová sondě".encode("cp1250").decode("cp1252")
    got = one(spark, T.decode_sanity(F.col("t"), table), t=broken)
    assert got["hits"] >= 2 and got["garbage"]
    assert one(spark, T.recover_misread(F.col("t"), table), t=broken) == "hřeby a ocelová sondě"
    assert not one(spark, T.decode_sanity(F.col("t"), table), t="plain words")["garbage"]
    assert one(spark, T.looks_garbled(F.col("t")), t="ab�") and not one(spark, T.looks_garbled(F.col("t")), t="abcdefg h")


# lines -----------------------------------------------------------------------------------------


def expected_reason(text, categ, q, p):
    c = "Trash" if (q or 0.0) < 0.4 else "Noisy" if (q or 0.0) < 0.7 and categ != "Trash" else categ
    if not text:
        return c, "empty text"
    if c in ("Empty", "Trash"):
        return c, "category"
    if c == "Non-text":
        if len(text) < p.min_chars_non_text:
            return c, "non-text too short"
        return c, "non-text without letters" if sum(ch.isalpha() for ch in text) / len(text) < p.min_alpha_non_text else None
    return c, "too short" if len(text) < p.min_chars else None


def test_quality_filter_matrix(spark):
    p = lines.LineFilter()
    texts = ["", "a", "abc", "1234567", "12345678", "abc12345", "abcd12345x", "ab" * 9]
    rows = [(i, t, c, q) for i, (t, c, q) in enumerate((t, c, q) for t in texts for c in ("Clear", "Noisy", "Trash", "Non-text", "Empty", "Header", "") for q in (0.39, 0.4, 0.69, 0.7, 1.0, None))]
    got = lines.quality_filter(frame(spark, rows, "i int, text string, categ string, quality_score double")).orderBy("i").collect()
    for r, (_, t, c, q) in zip(got, rows, strict=True):
        assert (r["categ_effective"], r["skip_reason"]) == expected_reason(t, c, q, p), (t, c, q)
    kept = lines.quality_filter(frame(spark, [(1, "some text", "Clear", None)], "i int, text string, categ string, quality_score double"), lines.LineFilter(missing_quality="keep")).first()
    assert kept["skip_reason"] is None
    nan = lines.quality_filter(frame(spark, [(1, "some text", "Clear", float("nan"))], "i int, text string, categ string, quality_score double")).first()
    assert nan["categ_effective"] == "Trash"


def test_context_window(spark):
    rows = [("f", i, 1 + i // 4, i % 4 + 1, c, 0.9, t) for i, (c, t) in enumerate([("Heading", "Title"), ("Empty", ""), ("Clear", "one"), ("Clear", "two"), ("Clear", "three"), ("Trash", "#"), ("Clear", "four"), ("Clear", "five")])]
    got = {r["row_idx"]: r["context"] for r in lines.context_windows(frame(spark, rows, "file string, row_idx int, page_num int, line_num int, categ string, quality_score double, text string")).collect()}
    assert got[0] == "--- CURRENT SECTION: Unknown Section ---\n--- LOCAL CONTEXT WINDOW ---\n<target_line> >>> [P1 L1] Title </target_line>\n    [P1 L3] one"
    assert got[4] == "--- CURRENT SECTION: Title ---\n--- LOCAL CONTEXT WINDOW ---\n<target_line> >>> [P2 L1] three </target_line>\n    [P2 L3] four"
    assert got[7].startswith("--- GLOBAL DOCUMENT HEADER ---\n    [P1 L1] Title\n    [P1 L3] one\n--- CURRENT SECTION: Title ---")


@pytest.mark.parametrize("statuses,want", [("e" * 9, (9, False)), ("e" * 10 + "o", (10, True)), ("e" * 9 + "o" + "e" * 9, (19, False)), ("eeeee" + "s" + "eeeee" + "oo", (11, True))])
def test_error_cutoff(spark, statuses, want):
    names = {"e": "error", "o": "ok", "s": "skip"}
    df = frame(spark, [("f", i, names[s]) for i, s in enumerate(statuses)], "file string, row_idx int, status string")
    assert (lines.abort_after_errors(df).count(), lines.run_status(df).first()["aborted"]) == want


# sampling --------------------------------------------------------------------------------------


def test_page_stats_tiers_and_splits(spark):
    rows = [("d", 1, "Clear", 0.9), ("d", 1, "Noisy", 0.6), ("d", 1, "Trash", 0.1), ("d", 2, "Trash", 0.3), ("d", 3, "Clear", float("nan")), ("d", 4, None, 0.9)]
    stats = stratify.page_stats(frame(spark, rows, "file string, page_num int, categ string, quality_score double"))
    got = {r["page_num"]: r for r in stratify.assign_tiers(stats).collect()}
    assert set(got) == {1, 2, 3}
    assert got[1]["avg_quality_score"] == pytest.approx(0.75) and got[1]["num_lines"] == 3 and got[1]["tier"] == "degraded"
    assert got[2]["tier"] == got[3]["tier"] == "text_poor"


@pytest.mark.parametrize("n", [1, 5, 10, 15, 23])
def test_split_sizes_round_half_to_even(spark, n):
    pages = frame(spark, [("f", i, "hard") for i in range(n)], "file string, page_num int, tier string")
    got = {r["split"]: r["count"] for r in stratify.assign_splits(pages).groupBy("split").count().collect()}
    train, dev = round(n * 0.8), round(n * 0.1)
    assert (got.get("train", 0), got.get("dev", 0), got.get("test", 0)) == (train, dev, n - train - dev)


def test_samples_do_not_depend_on_partitioning(spark):
    pages = frame(spark, [(f"f{i % 7}", i, "hard" if i % 3 else "clean") for i in range(100)], "file string, page_num int, tier string")
    draws = {tuple(sorted(map(tuple, stratify.stratified_sample(pages.repartition(k), 20).select("file", "page_num").collect()))) for k in (1, 7, 16)}
    assert len(draws) == 1 and len(next(iter(draws))) == 20


# evaluation ------------------------------------------------------------------------------------


def test_scores_and_idle_models(spark):
    manifest = frame(spark, [("a", 1, "clean"), ("b", 1, "hard")], "file string, page_num int, tier string")
    gold = frame(spark, [("a", 1, "abcdefghi"), ("b", 1, "x y")], "file string, page_num int, text string")
    pred = frame(spark, [("m", "a", 1, "abcdefghX"), ("m", "b", 1, "x y")], "model string, file string, page_num int, text string")
    models = frame(spark, [("m",), ("idle",)], "model string")
    scored = evaluation.score_pages(manifest, gold, pred, models)
    got = {(r["model"], r["tier"]): r for r in evaluation.with_idle_models(evaluation.corpus_scores(scored), models, scored).collect()}
    assert got["m", "clean"]["cer"] == pytest.approx(1 / 9) and got["m", "overall"]["cer"] == pytest.approx(1 / 18)
    assert got["idle", "overall"]["n_pages"] == 0 and got["idle", "overall"]["n_missing"] == 2 and got["m", "overall"]["n_missing"] == 0
    text = evaluation.report([r.asDict() for r in got.values()], ["m", "idle"])
    assert "| **m** | 2 | **5.56** |" in text and "| idle | 0 | – |" in text and "Entity" not in text
    assert "## WER (%) by tier" in text and "| Model | clean | hard | overall |" in text and "| m | 11.11 | 0.00 | 5.56 |" in text and text.endswith("\n> idle: 2 page(s) missing prediction.\n")
    entities = frame(spark, [("m", "overall", 1, 2, 4, 3, 0.25, 0.5, 1 / 3)], "model string, tier string, tp int, n_ref int, n_hyp int, n_entity_pages int, precision double, recall double, f1 double")
    full = evaluation.with_entities(evaluation.with_idle_models(evaluation.corpus_scores(scored), models, scored), entities)
    text = evaluation.report([r.asDict() for r in full.collect()], ["m", "idle"], "m.csv", "test", missing_gold=3)
    assert "| Model | Pages | CER (%) | WER (%) | NED | Entity F1 |" in text and "| **0.33** |" in text and "> 3 page(s) missing gold" in text and "Manifest: `m.csv` · Split: `test`" in text


def test_entity_scores(spark):
    gold = frame(spark, [(1, "PER", "Jan"), (1, "LOC", "Praha"), (2, "PER", "A"), (2, "PER", "A")], "page int, type string, text string")
    hyp = frame(spark, [(1, "PER", "jan "), (1, "LOC", "Brno"), (2, "PER", "A"), (3, "PER", "B")], "page int, type string, text string")
    got = {r["page"]: (r["tp"], r["n_ref"], r["n_hyp"]) for r in evaluation.entity_counts(gold, hyp, ["page"]).collect()}
    assert got == {1: (1, 2, 2), 2: (1, 2, 1)}


# vocabulary, records, provenance, layout -------------------------------------------------------


def test_merge_and_collisions(spark):
    rows = [("b", "1", "Hrob"), ("a", "10", "hrob "), ("a", "2", "HROB"), ("a", "3", "  "), ("c", "x", "Mohyla")]
    out = vocabulary.merge_sources(frame(spark, rows, "source string, source_id string, label string"), ["a", "b"]).collect()
    assert sorted((r["source"], r["source_id"], r["rank"], r["kept_source_id"]) for r in out) == [("a", "10", 2, "2"), ("a", "2", 1, "2"), ("b", "1", 3, "2"), ("c", "x", 1, "x")]


def test_undeclared_facet_is_refused(spark):
    facets = frame(spark, [("A", 1, 1)], "theme string, priority int, tie int")
    vocabulary.check_targets(frame(spark, [("s", "A"), ("t", "__exclude__")], "scheme string, theme string"), facets)
    with pytest.raises(ValueError, match="B"):
        vocabulary.check_targets(frame(spark, [("s", "B")], "scheme string, theme string"), facets)


def test_recursive_json(spark):
    tree = '[{"id":"1","name":{"cz":"a"},"subcategories":[{"id":"2","name":{"cs":"b"},"children":[{"id":"3","name":{"en":"c"}}]}]},{"id":"4","name":{"cz":"d"}}]'
    rows = vocabulary.flatten_json(frame(spark, [(tree,)], "value string"))
    assert sorted((r["id"], r["parent_id"], r["label"]) for r in rows.collect()) == [("1", None, "a"), ("2", "1", "b"), ("3", "2", "c"), ("4", None, "d")]
    flat = {r["id"]: (r["depth"], r["broader"], r["scheme"], r["sub"]) for r in vocabulary.flatten_tree(spark, rows).collect()}
    assert flat["3"] == (3, ["1", "2"], "1", "b") and flat["4"] == (1, [], "4", None)


def test_prompt_prefix_cost(spark):
    terms = frame(spark, [(1, "T", "s", "aa (b)"), (2, "T", "u", "cc (d)"), (3, "T", "s", "ee (f)")], "pos int, theme string, sub string, rendered string")
    costs = [9 + 15, 9 + 15, 9]
    got = [r["total_chars"] for r in vocabulary.prompt_prefix(terms, 1000, head=5).orderBy("pos").collect()]
    assert got == [5 + costs[0], 5 + costs[0] + costs[1], 5 + sum(costs)]
    assert vocabulary.prompt_prefix(terms, (5 + costs[0] + costs[1]) // 4, head=5).count() == 2
    assert vocabulary.prompt_prefix(terms, 1, head=50).count() == 0


def test_merge_fields_null_is_not_absent(spark):
    base = frame(spark, [(1, "a", "x"), (2, "b", "y")], "k int, v string, w string")
    new = frame(spark, [(1, 1, None, "no", ["v"]), (1, 2, "c", "no", []), (3, 1, "n", "no", ["v"]), (2, 1, "q", "no", [])], "k int, ordinal int, v string, w string, present array<string>")
    got = {r["k"]: (r["v"], r["w"], r["change"]) for r in records.merge_fields(base, new, ["k"], ["v"], "present").collect()}
    assert got == {1: (None, "x", "patched"), 2: ("b", "y", "patched"), 3: ("n", None, "added")}


def test_fan_in_ties_go_to_the_lowest_ordinal(spark):
    rows = [("d", "pages", "2024-01-01", 2, "late"), ("d", "pages", "2024-01-01", 1, "first"), ("d", "lines", "2023", 1, "old"), ("d", "lines", "2024", 3, "new")]
    got = {r["block"]: r["payload"] for r in records.fan_in(frame(spark, rows, "doc_id string, block string, updated_at string, ordinal int, payload string")).collect()}
    assert got == {"pages": "first", "lines": "new"}


def test_violations_and_origins(spark):
    schema = records.Schema((records.Rule("page", required=True), records.Rule("q", least=0, most=1), records.Rule("kind", one_of=("a", "b")), records.Rule("box", size=4)))
    df = frame(spark, [("1", 0.5, "a", [1, 2, 3, 4]), (None, 2.0, "z", [1])], "page string, q double, kind string, box array<int>")
    assert [r["v"] for r in df.select(records.violations(schema).alias("v")).collect()] == [[], ["page:required", "q:maximum", "kind:enum", "box:size"]]
    assert one(spark, records.originator(F.col("o")), o="DOCX") == "converter" and one(spark, records.originator(F.col("o")), o="tape") is None


def test_page_ordinals(spark):
    rows = [("a", "10", None, 0), ("a", "2", None, 1), ("b", "iv", 2, 0), ("b", "A-1", 1, 1), ("c", "x", 1, 0), ("c", "y", None, 1)]
    got = {(r["doc_id"], r["page"]): r["ordinal"] for r in records.page_ordinals(frame(spark, rows, "doc_id string, page string, page_index int, first_seen int")).collect()}
    assert got == {("a", "2"): 1, ("a", "10"): 2, ("b", "A-1"): 1, ("b", "iv"): 2, ("c", "x"): 1, ("c", "y"): 2}


def test_effective_license(spark):
    rows = [("t", 1, "x", "MIT"), ("t", 2, "y", "cc-by-nc-4.0"), ("t", 3, "z", "GLM4"), ("u", 1, "x", "homemade"), ("u", 2, "y", "CC BY-NC-SA 4.0"), ("v", 1, "a", "gpl 3.0")]
    parts = frame(spark, rows, "tool string, ordinal int, name string, license string")
    eff = provenance.effective_license(parts, "tool")
    got = {r["tool"]: (r["effective_license"], r["is_non_commercial"], r["is_share_alike"], r["determined_by"], r["unknown"]) for r in eff.collect()}
    assert got["t"] == ("CC BY-NC 4.0", True, False, ["y", "z"], [])
    assert got["u"] == ("homemade", False, False, ["x", "y"], ["homemade"])
    assert got["v"] == ("GPL-3.0", False, True, ["a"], [])
    none = provenance.with_default_license(frame(spark, [("w",)], "tool string"), eff, "tool").first()
    assert (none["effective_license"], none["is_non_commercial"], none["is_share_alike"]) == ("CC BY-NC 4.0", True, False)
    met = {r["tool"]: r["effective_license"] for r in provenance.with_default_license(parts, eff, "tool").collect()}
    assert met == {k: v[0] for k, v in got.items()}


def test_config_layers_and_offload(spark):
    got = {r["key"]: (r["value"], r["source"]) for r in provenance.resolve_config(spark, {"a": 1}, {"a": 2, "b": None}, {"b": 3, "c": 4}).collect()}
    assert got == {"a": ("1", "config"), "b": (None, "model"), "c": ("4", "default")}
    gb = provenance.offload_gb(F.col("f"), F.lit(48.0), F.lit(0.9), F.lit(1.0), F.lit(256.0))
    assert one(spark, gb, f=20.0) == 0 and one(spark, gb, f=140.0) == math.ceil(140 - (48 * 0.9 - 4) + 2) and one(spark, gb, f=900.0) is None


def test_lexical_enrichment_stops_nowhere_and_keeps_the_frame(spark):
    from quire.plans import enrich

    rows = [("f", 0, 1, 1, "Heading", 0.9, "Title"), ("f", 1, 1, 2, "Clear", 0.9, "an old grave mound"), ("f", 2, 1, 3, "Trash", 0.1, "#"), ("f", 3, 1, 4, "Clear", 0.9, "nothing here")]
    df = frame(spark, rows, "file string, row_idx int, page_num int, line_num int, categ string, quality_score double, text string")
    predictor = enrich.LexicalPredictor([("grave", "GRAVE", "Burials"), ("mound", "MOUND", "Burials"), ("old", "OLD", "Other")])
    records_, status = enrich.enrich_lines(df, predictor, enrich.vocabulary_categories(spark, ["grave", "mound", "old"]))
    got = {r["row_idx"]: (r["keywords"], r["category"]) for r in records_.collect()}
    assert got == {0: ([], enrich.META), 1: (["grave", "mound", "old"], "grave"), 3: ([], enrich.META)}
    assert status.first()["skipped"] == 1 and not status.first()["aborted"]
    before = df.columns
    enrich.predict(df, predictor, "text")
    assert df.columns == before


def test_html_rows(spark):
    from quire.sources import markup

    page = "<h2 class='a'>One &amp; <b>two</b></h2>\n<p>x\n y<br>z</p><pre>no</pre><ul><li>item</li></ul>"
    got = [tuple(r) for r in markup.html_rows(frame(spark, [(1, page), (2, None), (3, "")], "page_id int, html string"), ["page_id"]).orderBy("row_idx").collect()]
    assert got == [(1, 0, "heading", 2, "One & two"), (1, 1, "paragraph", None, "x y z"), (1, 2, "item", None, "item")]


def test_markdown_table(spark):
    df = frame(spark, [([["a|b", "c"], ["d"]],)], "rows array<array<string>>")
    assert df.select(layout.markdown_table(F.col("rows"), F.lit(2)).alias("t")).first()["t"] == "| a\\|b | c |\n| --- | --- |\n| d |  |"


def test_scales_round_half_to_even(spark):
    assert one(spark, layout.scaled(F.col("v"), F.lit(0.0), F.lit(0.5)), v="5") == 2 and one(spark, layout.scaled(F.col("v"), F.lit(0.0), F.lit(0.5)), v="x") is None
    assert one(spark, layout.box_of(F.col("b")), b="1 2.5 3 4") == [1, 2, 3, 4] and one(spark, layout.box_of(F.col("b")), b="1 2 3") is None
