"""Controlled vocabularies: flattening, merging, placing terms in themes, nesting and prompt budgets."""

from __future__ import annotations

from pyspark.errors import AnalysisException
from pyspark.sql import Column, DataFrame, SparkSession, Window
from pyspark.sql import functions as F

from quire.functions.text import fold_label
from quire.session import cut_lineage


def canonical_order() -> list[Column]:
    """Source, numeric id (others 0), id, label."""
    number = F.when(F.col("source_id").rlike("^[0-9]+$"), F.col("source_id").try_cast("bigint")).otherwise(F.lit(0))
    return [F.col("source"), number, F.col("source_id"), F.col("label")]


def flatten_tree(spark: SparkSession, edges: DataFrame, max_depth: int = 32) -> DataFrame:
    """(id, parent_id, label) rows to ``depth``, ``broader`` (ancestors, root first), ``scheme`` and ``sub``.

    One join per level, until a level is empty. ``scheme`` is the root's id; ``sub`` the label at
    depth 2, inherited below. An id that is reached twice keeps its shallowest place, ties by path; an
    edge back to an ancestor is left out. A tree of more than ``max_depth`` levels is an error.
    """
    level = edges.where("parent_id is null").select("id", "label", F.lit(1).alias("depth"), F.array().cast("array<string>").alias("broader"), F.col("id").cast("string").alias("scheme"), F.lit(None).cast("string").alias("sub"))
    child = edges.where("parent_id is not null").select(F.col("id").alias("c_id"), F.col("label").alias("c_label"), "parent_id")
    out = level
    for depth in range(2, max_depth + 2):
        below = level.join(child, level["id"] == child["parent_id"]).where(~F.array_contains(F.concat("broader", F.array(F.col("id").cast("string"))), F.col("c_id").cast("string")))
        level = below.select(
            F.col("c_id").alias("id"),
            F.col("c_label").alias("label"),
            F.lit(depth).alias("depth"),
            F.concat("broader", F.array(F.col("id").cast("string"))).alias("broader"),
            "scheme",
            (F.col("c_label") if depth == 2 else F.col("sub")).alias("sub"),
        )
        level = cut_lineage(level)  # else each level would run all joins above it again
        if level.isEmpty():
            break
        if depth > max_depth:
            raise ValueError(f"the tree is deeper than {max_depth} levels")
        out = out.unionByName(level)
    best = Window.partitionBy("id").orderBy("depth", F.array_join("broader", "/"))
    return out.withColumn("__r", F.row_number().over(best)).where("__r = 1").drop("__r")


def flatten_json(documents: DataFrame, json_col: str = "value", children: tuple[str, ...] = ("subcategories", "children"), max_depth: int = 16) -> DataFrame:
    """Recursive thesaurus JSON to (id, parent_id, label, ordinal) rows, level by level on VARIANT values."""
    def label(v):
        return F.coalesce(*(F.try_variant_get(v, f"$.name.{k}", "string") for k in ("cz", "cs", "en")), F.try_variant_get(v, "$.name", "string"))

    def below(df, value, parent):
        kids = F.coalesce(*(F.try_variant_get(value, f"$.{k}", "array<variant>") for k in children))
        return df.select(parent.alias("parent_id"), F.posexplode(kids).alias("ordinal", "v"))

    whole = documents.select(F.parse_json(json_col).alias("v"))
    roots = F.coalesce(F.try_variant_get("v", "$", "array<variant>"), F.array("v"))
    level = whole.select(F.lit(None).cast("string").alias("parent_id"), F.posexplode(roots).alias("ordinal", "v"))
    out = None
    for _ in range(max_depth):
        rows = level.select(F.try_variant_get("v", "$.id", "string").alias("id"), "parent_id", label(F.col("v")).alias("label"), "ordinal")
        out = rows if out is None else out.unionByName(rows)
        level = below(level, F.col("v"), F.try_variant_get("v", "$.id", "string"))
        if level.isEmpty():
            break
    else:
        raise ValueError(f"the thesaurus is deeper than {max_depth} levels")
    return out


def merge_sources(records: DataFrame, precedence: list[str]) -> DataFrame:
    """All records with ``norm``, ``rank`` (1: the one that is kept) and ``kept_source_id``.

    Records with the same folded label are one term: the source that comes first in ``precedence``
    wins, then canonical order. Blank labels are dropped. ``rank > 1`` are the collisions.
    """
    order = F.coalesce(F.array_position(F.array(*map(F.lit, precedence)), F.col("source")), F.lit(0))
    order = F.when(order == 0, len(precedence) + 1).otherwise(order)
    keyed = records.withColumn("norm", fold_label(F.col("label"))).where("norm is not null")
    w = Window.partitionBy("norm").orderBy(order, *canonical_order())
    return keyed.withColumn("rank", F.row_number().over(w)).withColumn("kept_source_id", F.first("source_id").over(w))


def theme_order(facets: DataFrame) -> DataFrame:
    """``facets`` with ``theme_ord``: priority down, then place in the tie-break list (``tie``), then name."""
    w = Window.orderBy(F.col("priority").desc(), F.coalesce("tie", F.lit(1 << 30)), "theme")
    return facets.withColumn("theme_ord", F.row_number().over(w))  # a facet table has a handful of rows


def check_targets(maps: DataFrame, facets: DataFrame, exclude: str = "__exclude__") -> None:
    """Raise if a map points at a theme that isn't declared."""
    bad = maps.where(F.col("theme") != exclude).join(facets, "theme", "left_anti").select("theme").distinct().limit(5).collect()
    if bad:
        raise ValueError(f"maps point at undeclared themes: {sorted(r['theme'] for r in bad)}")


def place_terms(terms: DataFrame, facets: DataFrame, scheme_map: DataFrame, branch_map: DataFrame, keywords: DataFrame, scheme_sources: tuple[str, ...] = (), other: str = "Other") -> DataFrame:
    """``terms`` with ``theme`` and ``placed_by``, the first rule that applies.

    scheme: the term's scheme is mapped (only for ``scheme_sources``, if given); branch: the nearest
    mapped one of the term itself and its ancestors; keyword: a facet's keyword is part of the label,
    the facet first in order winning, then the keyword; else ``other``. The maps and keywords are
    dimension tables kept by hand; Spark broadcasts them while they are small.
    """
    ranked = theme_order(facets).select("theme", "theme_ord")
    scheme = scheme_map.select("scheme", F.col("theme").alias("s_theme"))
    out = terms.join(scheme, "scheme", "left")
    if scheme_sources:
        out = out.withColumn("s_theme", F.when(F.col("source").isin(*scheme_sources), F.col("s_theme")))
    # branches: own id, then ancestors from the nearest up
    chain = out.select("term_id", F.posexplode(F.concat(F.array(F.col("source_id")), F.reverse(F.coalesce("broader", F.array().cast("array<string>"))))).alias("dist", "branch"))
    near = chain.join(branch_map.select(F.col("branch"), F.col("theme").alias("b")), "branch").groupBy("term_id").agg(F.min(F.struct("dist", "branch", F.col("b"))).alias("near"))
    out = out.join(near, "term_id", "left")
    # keywords: contained in the label, so no equi-join; the small side is a hand-kept list
    kw = keywords.join(ranked, "theme").select(F.col("theme").alias("k_theme"), "keyword", "theme_ord", F.coalesce("kw_ord", F.lit(0)).alias("kw_ord"))
    rest = out.where("s_theme is null and near is null").select("term_id", F.lower("label").alias("l"))
    hits = rest.join(kw, F.expr("contains(l, lower(keyword))")).groupBy("term_id").agg(F.min(F.struct("theme_ord", "kw_ord", "keyword", "k_theme")).alias("hit"))
    out = out.join(hits, "term_id", "left")
    return out.select(
        *terms.columns,
        F.coalesce("s_theme", "near.b", "hit.k_theme", F.lit(other)).alias("theme"),
        F.when(F.col("s_theme").isNotNull(), F.concat(F.lit("scheme:"), "scheme"))
        .when(F.col("near").isNotNull(), F.concat(F.lit("branch:"), F.col("near.branch")))
        .when(F.col("hit").isNotNull(), F.concat(F.lit("keyword:"), F.col("hit.keyword")))
        .otherwise("other")
        .alias("placed_by"),
    )


def rescue(placed: DataFrame, known: DataFrame, other: str = "Other") -> DataFrame:
    """Unplaced terms take the theme of an equal folded label in ``known`` (label, theme), first in its order."""
    by = known.withColumn("norm", fold_label(F.col("label"))).groupBy("norm").agg(F.min_by("theme", F.struct("label", "theme")).alias("r_theme"))
    out = placed.withColumn("norm", fold_label(F.col("label"))).join(by, "norm", "left")
    hit = (F.col("theme") == other) & F.col("r_theme").isNotNull()
    return out.withColumn("placed_by", F.when(hit, "rescue").otherwise(F.col("placed_by"))).withColumn("theme", F.when(hit, F.col("r_theme")).otherwise(F.col("theme"))).drop("norm", "r_theme")


def theme_histogram(placed: DataFrame) -> DataFrame:
    """Terms by theme with their share of all, and by rule."""
    return placed.groupBy("theme").agg(F.count("*").alias("n")).withColumn("share", F.col("n") / F.sum("n").over(Window.partitionBy(F.lit(1))))


def rule_histogram(placed: DataFrame) -> DataFrame:
    return placed.groupBy(F.substring_index("placed_by", ":", 1).alias("rule")).agg(F.count("*").alias("n"))


def nest(placed: DataFrame, facets: DataFrame, late_words: tuple[str, ...] = (), exclude: str = "__exclude__") -> DataFrame:
    """Ordered (theme_ord, theme, term_ord, label, sub): the nested vocabulary as rows.

    In a theme, terms with one of ``late_words`` come last, then by ``sort`` (missing last), then label.
    """
    late = F.lit(False)
    for w in late_words:
        late = late | F.contains(F.lower("label"), F.lit(w))
    w = Window.partitionBy("theme").orderBy(late, F.coalesce("sort", F.lit(1_000_000_000)), "label", "term_id")
    kept = placed.where(F.col("theme") != exclude).join(theme_order(facets).select("theme", "theme_ord"), "theme", "left")
    return kept.withColumn("term_ord", F.row_number().over(w)).select(F.coalesce("theme_ord", F.lit(1 << 30)).alias("theme_ord"), "theme", "term_ord", "label", "sub")


def nested_json(nested: DataFrame) -> DataFrame:
    """One row per theme, in order: its terms as a JSON array; the sink for a nested vocabulary."""
    term = F.struct("term_ord", "label", "sub")
    return nested.groupBy("theme_ord", "theme").agg(F.to_json(F.array_sort(F.collect_list(term))).alias("terms")).orderBy("theme_ord", "theme")


def prompt_prefix(terms: DataFrame, budget: int, head: int = 0, partition: str | None = None) -> DataFrame:
    """The longest run of terms, in order of ``pos``, whose rendered prompt fits ``budget`` tokens of 4 characters.

    A term costs its text and three characters, and its group's title and ten more at the group's
    first term; ``head`` is what the prompt costs besides. The cost only grows, so it is a running
    sum. With ``partition`` one prompt is fitted per value of that column.
    """
    keys = [partition] if partition else []
    whole = Window.partitionBy(*keys) if keys else Window.partitionBy(F.lit(1))
    first = F.row_number().over(Window.partitionBy(*keys, "theme", "sub").orderBy("pos")) == 1
    cost = F.length("rendered") + 3 + F.when(first, F.length(F.concat_ws(" / ", "theme", "sub")) + 10).otherwise(0)
    total = F.sum("__cost").over(whole.orderBy("pos").rowsBetween(Window.unboundedPreceding, 0)) + head
    out = terms.withColumn("__cost", cost).withColumn("total_chars", total)
    return out.where(F.greatest(F.lit(1), F.floor(F.col("total_chars") / 4)) <= budget).drop("__cost")


def render_prompt(terms: DataFrame) -> DataFrame:
    """One line per (theme, sub) in order of first appearance: the prompt's vocabulary part."""
    entry = F.array_sort(F.collect_list(F.struct("pos", "rendered")))
    lines = terms.groupBy("theme", "sub").agg(F.min("pos").alias("pos"), F.array_join(F.transform(entry, lambda e: e["rendered"]), "; ").alias("body"))
    return lines.select("pos", F.concat(F.lit("## "), F.concat_ws(" / ", "theme", "sub"), F.lit(": "), F.col("body")).alias("line")).orderBy("pos")


def excluded_themes(facets: DataFrame, other: str = "Other") -> DataFrame:
    """Themes that stay out of prompts: ``in_prompt`` is false, null meaning true for all but ``other``.

    Names that start with ``_`` are settings, not themes. ``other`` is left out too if undeclared.
    """
    shown = F.coalesce(F.col("in_prompt"), F.col("theme") != other)
    themes = facets.where(~F.col("theme").startswith("_")).select("theme", shown.alias("shown"))
    implicit = facets.sparkSession.createDataFrame([(other,)], "theme string").join(themes, "theme", "left_anti")
    return themes.where(~F.col("shown")).select("theme").unionByName(implicit)


def prompt_terms(nested: DataFrame, facets: DataFrame, meta: str, other: str = "Other") -> DataFrame:
    """(pos, theme, sub, label) of the terms a prompt may show: ``meta`` first, then themes and terms in order."""
    kept = nested.where(~F.col("theme").startswith("_")).join(excluded_themes(facets, other), "theme", "left_anti")
    first = nested.sparkSession.createDataFrame([(0, 0, None, None, meta)], "theme_ord int, term_ord int, theme string, sub string, label string")
    every = first.unionByName(kept.select("theme_ord", "term_ord", "theme", "sub", "label"))
    pos = F.row_number().over(Window.orderBy("theme_ord", F.coalesce("theme", F.lit("")), "term_ord"))  # a vocabulary has thousands of terms
    return every.select(pos.alias("pos"), "theme", "sub", "label")


def rename_subs(terms: DataFrame, labels: DataFrame) -> DataFrame:
    """``terms`` with ``sub`` renamed by ``labels`` (sub, sub_label), unchanged where there is no label."""
    names = labels.groupBy("sub").agg(F.min("sub_label").alias("__l"))
    return terms.join(names, "sub", "left").withColumn("sub", F.coalesce("__l", "sub")).select(*terms.columns)


def term_pairs(terms: DataFrame, thesaurus: tuple[str, ...] = ()) -> tuple[DataFrame, DataFrame]:
    """(pairs, collisions) of terms with a label (``label``) and its English (``label_en``), one per folded label.

    Roots (depth 1) of sources in ``thesaurus`` are headings and left out. Canonical order decides
    which is kept; the others are reported as (label, kept_id, dropped_id).
    """
    root = F.coalesce(F.col("source").isin(*thesaurus) & (F.col("depth") == 1), F.lit(False))
    usable = terms.withColumn("norm", fold_label(F.col("label"))).where("norm is not null and trim(label_en) <> ''").where(~root)
    w = Window.partitionBy("norm").orderBy(*canonical_order())
    ranked = usable.withColumn("__r", F.row_number().over(w)).withColumn("kept_id", F.first("source_id").over(w))
    return ranked.where("__r = 1").select("label", "label_en", "source", "source_id"), ranked.where("__r > 1").select("label", "kept_id", F.col("source_id").alias("dropped_id"))


def drift(old: DataFrame, new: DataFrame) -> DataFrame:
    """Rows that only one side has, with ``side``; empty if nothing changed."""
    return old.exceptAll(new).withColumn("side", F.lit("old")).unionByName(new.exceptAll(old).withColumn("side", F.lit("new")))


def flat_rows(records: DataFrame) -> DataFrame:
    """The columns of a flat vocabulary file in canonical order: lower-cased label, English, origin, place, sort."""
    text = lambda c: F.coalesce(F.col(c).cast("string"), F.lit(""))
    return records.orderBy(*canonical_order()).select(
        F.lower("label").alias("source_lemma"),
        text("label_en").alias("target_translation"),
        "source",
        "source_id",
        text("uri").alias("uri"),
        text("scheme").alias("scheme"),
        text("sub").alias("sub"),
        F.array_join(F.coalesce("broader", F.array().cast("array<string>")), " ").alias("broader"),
        text("sort").alias("sort"),
    )


def glossary(records: DataFrame) -> DataFrame:
    """(source_lemma, target_translation) of the terms that have an English label, in canonical order."""
    usable = records.where(F.coalesce("label_en", F.lit("")) != "")
    return usable.orderBy(*canonical_order()).select(F.lower("label").alias("source_lemma"), F.col("label_en").alias("target_translation"))


def harvest_meta(records: DataFrame) -> DataFrame:
    """Per source: records, those without an English label, and how many roots they hang from."""
    return records.groupBy("source").agg(
        F.count("*").alias("records"),
        F.count_if(F.coalesce("label_en", F.lit("")) == "").alias("without_en"),
        F.count_distinct("scheme").alias("roots"),
    )


def build_targets(records: DataFrame, place, authority: str = "authority", thesaurus: str = "thesaurus", other: str = "Other") -> dict[str, DataFrame]:
    """Placed terms of three vocabularies: the authority's own, the thesaurus' own, and both.

    ``place`` is a function from terms to placed terms. What the authority's labels leave in ``other``
    is rescued by the thesaurus' themes; the thesaurus itself isn't. In the union the thesaurus'
    term is kept of equal labels. A source without a record is an error, so that a failed harvest
    never replaces a vocabulary.
    """
    have = {r["source"] for r in records.where(F.col("source").isin(authority, thesaurus)).select("source").distinct().collect()}
    if have != {authority, thesaurus}:
        raise ValueError(f"no record of {sorted({authority, thesaurus} - have)}")
    own = {name: place(records.where(F.col("source") == name)) for name in (authority, thesaurus)}
    known = own[thesaurus].where(F.col("theme") != other).select("label", "theme")
    union = merge_sources(records, [thesaurus, authority]).where("rank = 1").drop("norm", "rank", "kept_source_id")
    return {authority: rescue(own[authority], known, other), thesaurus: own[thesaurus], "union": rescue(place(union), known, other)}


def load_nested(spark: SparkSession, path: str, old_themes: tuple[str, ...] = (), rebuild=None) -> DataFrame:
    """A nested vocabulary that was written as Parquet.

    If the path is missing, or holds nothing beside ``old_themes`` (a format given up), ``rebuild()``
    makes it anew; without ``rebuild`` a missing vocabulary is an error, and an old one is too.
    """
    try:
        found = spark.read.parquet(path)
    except AnalysisException as e:
        if e.getCondition() != "PATH_NOT_FOUND":
            raise
    else:
        if not found.where(~F.col("theme").isin(*old_themes) if old_themes else F.lit(True)).isEmpty():
            return found
    if rebuild is None:
        raise FileNotFoundError(f"no usable vocabulary at {path}")
    return rebuild()
