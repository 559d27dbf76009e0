"""Line dedup with a log-template tree, in DataFrame functions.

Units are lines, and beside them the sentences of lines that have several. The tree has a fixed
depth: a line goes by its number of tokens, then by its first ``LEAD`` tokens, tokens with a digit
counting as variable from the start. A line of ``n`` tokens may differ from a template of its leaf at
``d = n - ceil(SIMILAR n)`` positions. So the tokens behind the leading ones are cut into ``d + 1``
segments: lines that differ at ``d`` positions or fewer agree on one of them. Lines that share no
segment with another line of their leaf, and lines of fewer than ``SHORT`` tokens, are templates of
their own; all others form groups, at first one in each leaf:

* A group's template has at every position the token that most lines have (of equals the largest).
* Lines that fit it at ``SIMILAR`` of the positions belong to it; its other positions are fields.
* The rest is split by its token at the position with the fewest different tokens (at least two; of
  equals the first), and every part is a group again, until it is a single line. From round to round
  the positions are twice as many, so the rounds are few: 2 + log2 of the longest line at most.

There is no limit on templates, and a group is never brought together: counting is by (group,
position, token). Sentences take no part in the tree,
as theirs would be as large as the text; they recur as they are, digits aside.

A template that recurs across documents is dropped from all of them but the first (smallest id). So
the corpus keeps one instance of everything it said.
"""

from __future__ import annotations

import functools

from pyspark.sql import Column, DataFrame
from pyspark.sql import functions as F

from quire.llm.common import PARTITIONS, ROWS, compact, cut_lineage, in_bitmap, materialise

LEAD, SIMILAR = 3, 0.85
#: Documents that make a template recurring; lines of fewer than SHORT tokens need more of them, such sentences never go.
MIN_DOCS, SHORT, SHORT_MIN_DOCS = 2, 8, 10
VARIABLE = "<*>"
#: Sentences in one line at most, as places are numbered.
_LINE = 1 << 32


def masked(text: Column) -> Column:
    """The text with single spaces, none at line ends, and a mark for every token that has an ASCII digit.

    What ends a sentence is kept behind a mark, so the masked line has the sentences of the line.
    """
    has = lambda *parts: functools.reduce(lambda a, b: a | b, (F.contains(text, F.lit(p)) for p in parts))
    ragged = has("  ", "\t", "\x0b", "\x0c", "\r", " \n", "\n ") | F.startswith(text, F.lit(" ")) | F.endswith(text, F.lit(" "))
    neat = F.trim(F.regexp_replace(F.regexp_replace(text, r"[\x09\x0B-\x0D\x20]+", " "), " ?\n ?", "\n"))
    # a match starts where a token starts and steps back over its last marks only
    mark = lambda x: F.regexp_replace(x, r"(?<![^ \n])[^ \n0-9]*+[0-9](?:[^ \n]*[^ \n.!?])?+", VARIABLE)
    return F.when(text.rlike("[0-9]"), mark(F.when(ragged, neat).otherwise(text))).when(ragged, neat).otherwise(text)


def sentences(line: Column) -> Column:
    return F.split(line, r"(?<=[.!?])[\x20\x09-\x0D]+")


def row_key(id_col: str, text_col: str) -> list[Column]:
    """128 bits of a row's id and text, so that no plan depends on the order in which rows are read."""
    whole = (F.col(id_col).cast("string"), F.col(text_col).cast("string"))
    return [F.xxhash64(*whole).alias("r1"), F.xxhash64(F.lit(1), *whole).alias("r2")]


def _lines(docs: DataFrame, id_col: str, text_col: str) -> DataFrame:
    """Masked lines, empty ones included, by row and place."""
    text = F.coalesce(F.col(text_col).cast("string"), F.lit(""))
    rows = docs.select(*row_key(id_col, text_col), F.col(id_col).alias("id"), masked(text).alias("text"))
    return rows.select("r1", "r2", "id", F.posexplode(F.split("text", "\n")).alias("i", "line"))


def _described(lines: DataFrame, keep: list[str], leaf: Column) -> DataFrame:
    """``keep``, ``line``, its tokens ``n``, its identity ``s1``, ``s2`` and ``leaf``."""
    n = (F.octet_length("line") - F.octet_length(F.replace(F.col("line"), F.lit(" "), F.lit(""))) + 1).alias("n")
    told = lines.where("line <> ''").select(*keep, "line", n)
    return told.select("*", F.xxhash64("n", "line").alias("s1"), F.xxhash64(F.lit(1), "n", "line").alias("s2"), leaf.alias("leaf"))


def _leaf() -> Column:
    return F.xxhash64("n", F.substring_index("line", " ", LEAD))


def parse(docs: DataFrame, id_col: str, text_col: str) -> DataFrame:
    """One row per unit with a token: ``r1``, ``r2``, ``id``, ``at`` (line, and sentence from 1 or 0 for the line), ``n``, ``leaf``, ``s1``, ``s2``.

    ``leaf`` is null for sentences and for short lines.
    """
    lines, line = _lines(docs, id_col, text_col), F.col("line")
    several = functools.reduce(lambda a, b: a | b, (F.contains(line, F.lit(p)) for p in (". ", "! ", "? ")))
    # a masked line has no line end, so one can stand for where a sentence ends; that is quicker than a pattern that looks back
    ends = functools.reduce(lambda c, p: F.replace(c, F.lit(f"{p} "), F.lit(f"{p}\n")), ".!?", line)
    parts = F.when(several, F.concat(F.array(line), F.split(ends, "\n"))).otherwise(F.array(line))
    units = lines.select("r1", "r2", "id", "i", F.posexplode(parts).alias("j", "line"))
    units = units.select("r1", "r2", "id", (F.col("i").cast("bigint") * _LINE + F.col("j")).alias("at"), (F.col("j") == 0).alias("whole"), "line")
    leaf = F.when(F.col("whole") & (F.col("n") >= SHORT), _leaf())
    return _described(units, ["r1", "r2", "id", "at", "whole"], leaf).where(F.col("whole") | (F.col("n") >= SHORT)).drop("whole", "line")


def texts_at(placed: DataFrame, docs: DataFrame, id_col: str, text_col: str) -> DataFrame:
    """``leaf``, ``s1``, ``s2`` and masked ``line`` of the lines at the places ``r1``, ``r2``, ``at``.

    Masking leaves every line in its place and looks at no other line, so only these are masked.
    """
    text = F.coalesce(F.col(text_col).cast("string"), F.lit("")).alias("text")
    rows = in_bitmap(placed, "r1", docs.select(*row_key(id_col, text_col), text))
    lines = rows.select("r1", "r2", F.posexplode(F.split("text", "\n")).alias("i", "line"))
    lines = lines.select("r1", "r2", (F.col("i").cast("bigint") * _LINE).alias("at"), "line")
    key = F.xxhash64("r1", "at")
    # repeated rows have their lines at the same places
    found = in_bitmap(placed.withColumn("k", key), "k", lines.withColumn("k", key)).drop("k").dropDuplicates(["r1", "r2", "at"])
    return found.join(placed, ["r1", "r2", "at"]).select("leaf", "s1", "s2", masked(F.col("line")).alias("line"))


def with_partner(lines: DataFrame) -> DataFrame:
    """The distinct lines (``leaf``, ``s1``, ``s2``, ``line``) that share a segment with another one of their leaf."""
    tokens = F.split("line", " ")
    n = F.size("t")
    parts = n - F.ceil(SIMILAR * n - 1e-9).cast("int") + 1
    edge = lambda s: LEAD + F.floor(s * (n - LEAD) / F.col("parts")).cast("int")
    node = F.transform(F.sequence(F.lit(0), F.col("parts") - 1), lambda s: F.xxhash64("leaf", s, F.array_join(F.slice("t", edge(s) + 1, edge(s + 1) - edge(s)), " ")))
    nodes = lines.select("leaf", "s1", "s2", tokens.alias("t")).withColumn("parts", parts).select("s1", "s2", F.explode(node).alias("node"))
    shared = nodes.groupBy("node").agg(F.count("*").alias("m")).where("m > 1").select("node")
    met = nodes.join(shared, "node").select("s1", "s2").distinct()
    return lines.join(met, ["s1", "s2"], "left_semi")


def leaf_templates(lines: DataFrame, weights: DataFrame) -> DataFrame:
    """``s1``, ``s2`` and ``template`` of all lines that joined a template of their leaf.

    ``lines``: ``leaf``, ``s1``, ``s2`` and masked ``line``, each once; ``weights``: ``c`` of each.
    """
    left, n = compact(lines.join(weights, ["s1", "s2"]).select("s1", "s2", "line", "c", F.col("leaf").alias("g")))
    out, k = None, 0
    while n:
        few = max(PARTITIONS, n // ROWS)
        votes = left.select("g", "c", F.posexplode(F.split("line", " ")).alias("p", "token")).groupBy("g", "p", "token").agg(F.sum("c").alias("c")).coalesce(4 * few)
        places = votes.groupBy("g", "p").agg(F.max(F.struct("c", "token")).alias("b"), F.count("*").alias("kinds")).coalesce(few)
        mode = F.transform(F.array_sort(F.collect_list(F.struct("p", "b.token"))), lambda x: x["token"]).alias("mode")
        fewest = F.array_sort(F.collect_list(F.when(F.col("kinds") > 1, F.struct("kinds", "p"))))
        at = F.transform(F.slice(fewest, 1, 1 << k), lambda x: x["p"]).alias("at")
        groups = places.groupBy("g").agg(mode, at)
        own = F.split("line", " ")
        same = F.size(F.filter(F.zip_with(own, F.col("mode"), lambda a, b: a == b), lambda x: x))
        fits = (same >= F.ceil(SIMILAR * F.size("mode") - 1e-9)).alias("fits")
        part = F.xxhash64("g", F.transform("at", lambda p: F.get(own, p))).alias("part")
        judged = cut_lineage(left.join(groups, "g").select("s1", "s2", "line", "c", "g", fits, part).coalesce(few))
        got = judged.where("fits").select("s1", "s2", F.xxhash64(F.lit(k), "g").alias("template"))
        out = got if out is None else out.unionByName(got)
        rest = judged.where("not fits")
        several = rest.groupBy("part").agg(F.count("*").alias("m")).where("m > 1").select("part")
        left, n = compact(rest.join(several, "part").select("s1", "s2", "line", "c", F.col("part").alias("g")))
        k += 1
    return out if out is not None else left.select("s1", "s2", F.col("g").alias("template"))


def _spread(df: DataFrame, *by: str) -> DataFrame:
    """Per ``by``: rows ``c``, least and largest id ``lo``, ``hi``, and those of the hashes of rows without one, ``hlo``, ``hhi``."""
    return df.groupBy(*by).agg(
        F.sum("c").alias("c"), F.min("lo").alias("lo"), F.max("hi").alias("hi"), F.min("hlo").alias("hlo"), F.max("hhi").alias("hhi"), F.max("short").alias("short"), F.max("leaf").alias("leaf")
    )


_TWO_DOCUMENTS = "lo <> hi or hlo <> hhi or (lo is not null and hlo is not null)"


def recurring(docs: DataFrame, id_col: str, text_col: str) -> DataFrame:
    """``r1``, ``r2`` and ``dropped``: by line, in order, the units of it that are of recurring templates, outside their first document.

    A unit is the ``line`` itself (0 in ``js``) or a sentence of it (from 1).
    """
    units = materialise(parse(docs, id_col, text_col).withColumn("short", F.col("n") < SHORT).drop("n"))
    nameless = F.when(F.col("id").isNull(), F.col("r1"))
    each = units.select("s1", "s2", "short", "leaf", F.lit(1).alias("c"), F.col("id").alias("lo"), F.col("id").alias("hi"), nameless.alias("hlo"), nameless.alias("hhi"))
    sigs = materialise(_spread(each, "s1", "s2"))
    several, _ = compact(sigs.where("leaf is not null").groupBy("leaf").agg(F.count("*").alias("m")).where("m > 1").select("leaf"))
    # lines are made distinct before they meet the leaves, so a leaf's share of the rows doesn't matter; any place of a line will do
    whole = in_bitmap(several, "leaf", units.where("leaf is not null").select("leaf", "s1", "s2", "r1", "r2", "at"))
    placed = whole.groupBy("leaf", "s1", "s2").agg(F.first(F.struct("r1", "r2", "at")).alias("place"))
    placed, _ = compact(placed.join(several, "leaf").select("leaf", "s1", "s2", "place.*"))
    texts, _ = compact(texts_at(placed, docs, id_col, text_col))
    texts, _ = compact(with_partner(texts))
    weights = in_bitmap(texts, "s1", sigs.select("s1", "s2", "c"))
    joined, _ = compact(leaf_templates(texts, weights))
    # templates of several lines, then units that are their own
    met = in_bitmap(joined, "s1", sigs).join(joined, ["s1", "s2"])
    several_lines = _spread(met, "template").where(_TWO_DOCUMENTS).select("template", "lo", "hlo")
    alone = sigs.where(_TWO_DOCUMENTS).where(f"not short or c >= {SHORT_MIN_DOCS}").join(joined, ["s1", "s2"], "left_anti")
    drop = joined.join(several_lines, "template").select("s1", "s2", "lo", "hlo", F.lit(False).alias("short"))
    drop, _ = compact(drop.unionByName(alone.select("s1", "s2", "lo", "hlo", "short")))
    few = drop.where("short")
    counted = in_bitmap(few, "s1", units.where("short")).join(few.select("s1", "s2"), ["s1", "s2"]).select("s1", "s2", "id", nameless.alias("h")).distinct()
    many = counted.groupBy("s1", "s2").agg(F.count("*").alias("docs")).where(F.col("docs") >= SHORT_MIN_DOCS).select("s1", "s2")
    drop, _ = compact(drop.where("not short").unionByName(few.join(many, ["s1", "s2"])).select("s1", "s2", "lo", "hlo"))
    # a join of its own, so that Spark may split a template that many documents share
    found = in_bitmap(drop, "s1", units.select("r1", "r2", "id", "at", "s1", "s2")).join(drop, ["s1", "s2"])
    later = F.when(F.col("lo").isNotNull(), F.col("id").isNull() | (F.col("id") != F.col("lo"))).otherwise(F.col("r1") != F.col("hlo"))
    line, j = F.floor(F.col("at") / _LINE).alias("line"), F.col("at") % _LINE
    by_line = found.where(later).groupBy("r1", "r2", line).agg(F.collect_set(j).alias("js"))
    return cut_lineage(by_line.groupBy("r1", "r2").agg(F.array_sort(F.collect_list(F.struct("line", "js"))).alias("dropped")))


def dedup_lines(docs: DataFrame, id_col: str = "doc_id", text_col: str = "text", counts: bool = True) -> DataFrame:
    """All columns of ``docs``, the text without its dropped lines and sentences; with ``counts`` also
    ``n_lines`` and ``n_dropped`` (lines that went as a whole or sentence by sentence), ``n_cut`` (sentences
    that went from lines of which something stays).

    Lines end at newline characters; a line without tokens is never dropped. Null texts stay null and
    have no lines; texts without dropped lines stay as they are. Of a line that loses sentences the
    others are joined by a space. Rows of an equal id are one document, rows without an id are one for
    each text; the first document is the one with the smallest id (none: by a hash of the text). A
    template of one line of fewer than ``SHORT`` tokens recurs in ``SHORT_MIN_DOCS`` documents, any other
    in ``MIN_DOCS``. An empty table gives an empty result. No column of ``docs`` is lost: where it has
    one of the three names, the new one gets underscores.
    """
    names = docs.columns
    slots = docs.toDF(*(f"c{i}" for i in range(len(names))))
    sid, text = (f"c{names.index(c)}" for c in (id_col, text_col))
    found = recurring(slots, sid, text)
    r1, r2 = row_key(sid, text)
    rows = slots.withColumns({"r1": r1, "r2": r2})
    # documents that certainly keep all their lines are not moved
    whole = in_bitmap(found, "r1", rows, within=False).withColumn("dropped", F.lit(None).cast(found.schema["dropped"].dataType))
    both = in_bitmap(found, "r1", rows).join(found, ["r1", "r2"], "left").unionByName(whole)
    both = both.withColumn("lines", F.when(F.col("dropped").isNotNull(), F.split(F.col(text), "\n")))

    def edited(line, js):
        cut = F.filter(sentences(F.regexp_replace(line, r"[\x20\x09-\x0D]+$", "")), lambda _, j: ~F.array_contains(js, (j + 1).cast("bigint")))
        # null: nothing stays
        return F.when(~F.array_contains(js, F.lit(0).cast("bigint")) & (F.size(cut) > 0), F.array_join(cut, " "))

    # the stretches of lines between those that lose something are copied, so the work grows with the lines
    number = lambda e: e["line"].cast("int")
    after = lambda e: F.coalesce(number(e) + 1, F.lit(0))
    piece = lambda e, t: F.concat(F.slice("lines", after(F.get("dropped", t - 1)) + 1, number(e) - after(F.get("dropped", t - 1))), F.array(edited(F.get("lines", number(e)), e["js"])))
    last = after(F.element_at("dropped", -1))
    tail = F.slice("lines", last + 1, F.size("lines") - last)
    left = F.when(F.col("dropped").isNotNull(), F.concat(F.flatten(F.transform("dropped", piece)), tail))
    judged = both.withColumn("left", left)
    stays = F.filter("left", lambda x: x.isNotNull())
    out = {text: F.when(F.col("dropped").isNull(), F.col(text)).otherwise(F.array_join(stays, "\n"))}
    if counts:
        n_gone = F.coalesce(F.size("left") - F.size(stays), F.lit(0)).cast("bigint")
        n_cut = F.aggregate("dropped", F.lit(0), lambda n, e: n + F.when(F.get("left", number(e)).isNull(), 0).otherwise(F.size(e["js"])))
        out |= {
            "n_lines": F.when(F.col(text).isNull(), 0).otherwise(F.octet_length(F.col(text)) - F.octet_length(F.replace(F.col(text), F.lit("\n"), F.lit(""))) + 1).cast("bigint"),
            "n_dropped": F.when(F.col("dropped").isNull(), 0).otherwise(n_gone).cast("bigint"),
            "n_cut": F.when(F.col("dropped").isNull(), 0).otherwise(n_cut).cast("bigint"),
        }
    done = judged.withColumns(out)
    new = []
    for c in ("n_lines", "n_dropped", "n_cut") if counts else ():
        name = c
        while name in names:
            name += "_"
        new.append(F.col(c).alias(name))
    return done.select(*(F.col(f"c{i}").alias(c) for i, c in enumerate(names)), *new)
