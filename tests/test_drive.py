import json
import os

import pytest

from quire.plans import drive, enrich
from tests.conftest import frame


class Counting:
    """Writes a line for each call; fails for prompts with a mark."""

    def __init__(self, path, fail="FAIL", reply=None):
        self.path, self.fail, self.reply = str(path), fail, reply

    def __call__(self, prompts):
        for prompt in prompts:
            with open(self.path, "a") as f:
                f.write(prompt.replace("\n", " ") + "\n")
            if self.fail in prompt.partition("<target_line>")[2].partition("</target_line>")[0]:
                raise OSError("no answer")
            yield self.reply or json.dumps({"keywords": ["k"], "keywords_en": ["e"], "category": "grave", "confidence": "0.7"})

    def calls(self):
        return open(self.path).read().splitlines() if os.path.exists(self.path) else []


def lines(spark, texts):
    rows = [(f, i, 1, i + 1, "Clear", 0.9, t) for f, ts in texts.items() for i, t in enumerate(ts)]
    return frame(spark, rows, "file string, row_idx int, page_num int, line_num int, categ string, quality_score double, text string").repartition(3)


def test_no_call_after_the_cut_off_and_one_for_each_line(spark, tmp_path):
    predictor = Counting(tmp_path / "calls")
    texts = {"bad": ["good line"] + ["FAIL line"] * 3 + [""] + ["FAIL line"] * 9, "fine": ["FAIL line", "FAIL line", "good line", "x", "FAIL line"], "none": [""]}
    found, status = enrich.enrich_lines(lines(spark, texts), predictor, frame(spark, [("grave",)], "category string"), limit=5)
    got = {r["file"]: (r["processed"], r["errors"], r["skipped"], r["aborted"]) for r in status.collect()}
    assert got == {"bad": (1, 5, 1, True), "fine": (1, 3, 1, False), "none": (0, 0, 1, False)}
    assert sorted((r["file"], r["row_idx"], r["keywords"], r["confidence"]) for r in found.collect()) == [("bad", 0, ["k"], 0.7), ("fine", 2, ["k"], 0.7)]
    found.count(), status.count()
    assert len(predictor.calls()) == 6 + 4


def test_prompts_of_a_file_come_in_order(spark, tmp_path):
    predictor = Counting(tmp_path / "calls")
    enrich.enrich_lines(lines(spark, {"f": [f"line number {i:02d}" for i in range(30)]}), predictor, frame(spark, [("grave",)], "category string"))
    seen = [c.partition(">>> ")[2][:32] for c in predictor.calls()]
    assert seen == sorted(seen, key=lambda s: int(s.partition("number ")[2][:2])) and len(seen) == 30


def test_one_call_a_document(spark, tmp_path):
    predictor = Counting(tmp_path / "calls", reply=json.dumps({"items": [{"locator": "p", "page": 3, "keywords": ["a", 1], "category": "grave", "confidence": 1}, {"locator": "q", "category": drive.META, "keywords": ["x"], "confidence": 0}]}))
    docs = frame(spark, [(i, f"text {i}") for i in range(5)] + [(9, None)], "file int, text string")
    items, status = enrich.enrich_documents(docs, predictor, frame(spark, [("grave",)], "category string"))
    assert status.where("not aborted").count() == 6 and items.count() == 12 and items.where("page = '3'").count() == 6
    assert {tuple(r["keywords"]) for r in items.collect()} == {("a", "1"), ()}
    assert len(predictor.calls()) == 6


@pytest.mark.parametrize(
    ("reply", "error"),
    [
        (None, "no valid JSON"), ("[1]", "no valid JSON"), ('{"category": 3}', "no valid JSON"), ('{"category": "grave"}', "no confidence"), ('{"category": "grave", "confidence": "high"}', "no confidence"),
        ('{"category": "grave", "confidence": true}', "no confidence"), ('{"category": "grave", "confidence": "nan"}', "no confidence"), ('{"category": "house", "confidence": 1}', "unknown category"),
    ],
)
def test_unusable_replies(reply, error):
    with pytest.raises(ValueError, match=error):
        drive.read_reply(reply, frozenset({"grave"}))


def test_usable_replies():
    read = lambda **r: drive.read_reply(json.dumps(r), frozenset({"grave"}))
    assert read(category="grave", confidence=7, keywords="x", keywords_en=None) == {"keywords": [], "keywords_en": [], "category": "grave", "confidence": 1.0}
    assert read(category=drive.META, confidence="-1", keywords=["x"])["keywords"] == []
    assert drive.read_reply('{"category": "grave", "confidence": 0.5, "keywords": ["a\nb"]}', frozenset({"grave"}))["keywords"] == ["a\nb"]
    assert drive.read_items('{"items": []}', frozenset()) == []
    with pytest.raises(ValueError, match="no locator"):
        drive.read_items('{"items": [{"category": "grave"}]}', frozenset({"grave"}))


def test_a_predictor_that_ends_early_has_failed():
    def drops(prompts):
        for p in prompts:
            if p != "b":
                yield p

    ask = drive.Asking(drops)
    assert ask("a") == "a"
    with pytest.raises(RuntimeError):
        ask("b")
    assert ask("c") == "c"


def test_a_predictor_that_looks_ahead_is_opened_again():
    ask = drive.Asking(lambda prompts: iter(list(prompts)))
    assert [ask(p) for p in "abc"] == ["a", "b", "c"]


def test_vocabulary_size_is_checked(spark, monkeypatch):
    monkeypatch.setattr(drive, "CATEGORIES", 2)
    with pytest.raises(ValueError):
        drive.category_set(frame(spark, [("a",), ("b",), ("c",)], "category string"))
