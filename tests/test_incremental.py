import os
import shutil

import pytest
from pyspark.sql import functions as F

from quire.operators import vocabulary
from quire.operators.provenance import resolve_config
from quire.sources import converted, settings, thesaurus
from tests.conftest import frame

INI = """; notes
stray = 1
[STRATIFY]
CLEAN_MIN = 0.9
Page_Stats: a=b.csv
text = one
    two
empty =
# no
novalue
[bench]
seed=7
SEED = 8
[STRATIFY]
n = 3
"""
PLAIN = """# plain
MODEL_KEY=m
VOCAB="/a b/c.json"
 SPACED = 'x' y
QUOTE='it''s'
noequals
MODEL_KEY=n
URL=http://x?a=b
"""


def test_both_formats_become_one_table(spark, tmp_path):
    (tmp_path / "a.ini").write_text(INI)
    (tmp_path / "b.txt").write_text(PLAIN)
    (tmp_path / "c.txt").write_text("")
    found = settings.read_settings(spark, str(tmp_path))
    got = {}
    for r in found.collect():
        got.setdefault((r["source"], r["section"]), {})[r["key"]] = r["value"]
    assert got == {
        ("a.ini", "STRATIFY"): {"clean_min": "0.9", "page_stats": "a=b.csv", "text": "one\ntwo", "empty": "", "n": "3"},
        ("a.ini", "bench"): {"seed": "8"},
        ("b.txt", None): {"MODEL_KEY": "n", "VOCAB": "/a b/c.json", "SPACED": "'x' y", "QUOTE": "it''s", "URL": "http://x?a=b"},
    }
    own = settings.setting_values(found.where("source = 'a.ini'"), "bench")
    resolved = {r["key"]: (r["value"], r["source"]) for r in resolve_config(spark, own, {"seed": 1, "model": 2}, {"pages": 200}).collect()}
    assert resolved == {"seed": ("8", "config"), "model": ("2", "model"), "pages": ("200", "default")}


def test_typed_settings(spark):
    df = frame(spark, [("7", "0.5", "Yes"), (None, None, "off")], "i string, d string, b string")
    assert [tuple(r) for r in df.select(settings.typed(F.col("i"), "int"), settings.typed(F.col("d"), "double"), settings.typed(F.col("b"), "boolean")).collect()] == [(7, 0.5, True), (None, None, False)]
    with pytest.raises(Exception, match="no int: seven"):
        frame(spark, [("seven",)], "i string").select(settings.typed(F.col("i"), "int")).collect()


def test_touching_one_file_of_three_converts_one(spark, tmp_path):
    folder, cache, asked = tmp_path / "in", str(tmp_path / "cache"), []
    folder.mkdir()
    for k in "abc":
        (folder / f"{k}.txt").write_text(k)
        os.utime(folder / f"{k}.txt", (1_700_000_000, 1_700_000_000))

    def convert(session, paths):
        asked.append([p[-5] for p in paths])
        return session.read.text(paths, wholetext=True).select(F.regexp_replace("_metadata.file_path", "^file:/+", "file:/").alias("file"), F.upper("value").alias("text"))

    run = lambda: {r["path"][-5]: r["text"] for r in converted.convert_changed(spark, str(folder), cache, convert).collect()}
    assert run() == {"a": "A", "b": "B", "c": "C"} and run() == {"a": "A", "b": "B", "c": "C"}
    assert asked == [["a", "b", "c"]]
    (folder / "b.txt").write_text("bb")
    os.utime(folder / "b.txt", (1_700_000_100, 1_700_000_100))
    os.remove(folder / "c.txt")
    assert run() == {"a": "A", "b": "BB"} and asked == [["a", "b", "c"], ["b"]]

    def broken(session, paths):
        raise OSError("no converter")

    os.utime(folder / "a.txt", (1_700_000_200, 1_700_000_200))
    with pytest.raises(OSError):
        converted.convert_changed(spark, str(folder), cache, broken)
    assert run() == {"a": "A", "b": "BB"} and asked[-1] == ["a"]


def tree(name):
    return '{"id": "%s", "name": {"cz": "%s"}, "subcategories": [{"id": "%s1", "name": {"cs": "child"}}]}' % (name, name, name)


def test_a_refused_address_yields_the_snapshots_rows(spark, tmp_path):
    snap, live = tmp_path / "snap", tmp_path / "live"
    snap.mkdir(), live.mkdir()
    for k in (1, 2, 3):
        (snap / f"import_{k}.json").write_text(tree(f"s{k}"))
    (live / "import_1.json").write_text(tree("new"))
    (live / "import_2.json").write_text("<html>")
    read = lambda **o: {r["name"]: (r["origin"], r["value"][8:10], r["reason"]) for r in thesaurus.read_thesaurus(spark, str(snap), **o).collect()}
    assert read() == {f"import_{k}.json": ("snapshot", f"s{k}", None) for k in (1, 2, 3)}
    got = read(url=f"file://{live}")
    assert got["import_1.json"] == ("live", "ne", None)
    assert got["import_2.json"][:2] == ("snapshot", "s2") and got["import_2.json"][2].startswith("JSONDecodeError")
    assert got["import_3.json"][:2] == ("snapshot", "s3") and got["import_3.json"][2].startswith("URLError")
    refused = read(url="http://127.0.0.1:9", files=["export"], timeout=2)
    assert {k: v[:2] for k, v in refused.items()} == {f"import_{k}.json": ("snapshot", f"s{k}") for k in (1, 2, 3)} and all(v[2].startswith("export: URLError") for v in refused.values())
    (live / "export").write_text("[%s, %s]" % (tree("e"), tree("f")))
    whole = thesaurus.read_thesaurus(spark, str(snap), url=f"file://{live}", files=["export"])
    assert [(r["name"], r["origin"]) for r in whole.collect()] == [("export", "live")]
    labels = {r["label"] for r in vocabulary.flatten_json(whole).collect()}
    assert labels == {"e", "f", "child"}
    shutil.rmtree(live)
