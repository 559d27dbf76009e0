"""Scoring transcriptions and entities against gold, per model and tier."""

from __future__ import annotations

from pyspark.sql import Column, DataFrame
from pyspark.sql import functions as F

from quire.functions.text import cer, ned, normalize_text, wer
from quire.operators.stratify import TIERS


def score_pages(manifest: DataFrame, gold: DataFrame, predictions: DataFrame, models: DataFrame) -> DataFrame:
    """One row per gold page and model with ``cer``, ``wer``, ``ned``, lengths, and ``missing``.

    ``manifest``, ``gold``: (file, page_num, ...); ``predictions`` has ``model`` too; ``models`` is the
    list of models asked for (a handful of rows), so that pages without a prediction show up.
    """
    pages = manifest.join(gold.withColumnRenamed("text", "ref"), ["file", "page_num"])
    pairs = pages.crossJoin(models.select("model")).join(predictions.withColumnRenamed("text", "hyp"), ["model", "file", "page_num"], "left")
    normal = pairs.withColumn("ref", normalize_text(F.col("ref"))).withColumn("hyp", normalize_text(F.col("hyp")))
    return normal.select(
        *(c for c in normal.columns if c not in ("ref", "hyp")),
        F.col("hyp").isNull().alias("missing"),
        cer(F.col("ref"), F.col("hyp")).alias("cer"),
        F.when(F.col("hyp").isNotNull(), wer(F.col("ref"), F.col("hyp"))).alias("wer"),
        F.when(F.col("hyp").isNotNull(), ned(F.col("ref"), F.col("hyp"))).alias("ned"),
        F.length("ref").alias("ref_chars"),
        F.length("hyp").alias("hyp_chars"),
    )


def entity_counts(gold: DataFrame, predicted: DataFrame, keys: list[str]) -> DataFrame:
    """Per page of ``gold``: true positives as a multiset intersection, ``n_ref`` and ``n_hyp``.

    Entities are (type, text) rows. Pages without gold entities don't appear; a missing prediction
    counts as no entities.
    """

    def counted(df, name):
        return df.withColumn("text", normalize_text(F.col("text"), lowercase=True)).groupBy(*keys, "type", "text").agg(F.count("*").alias(name))

    both = counted(gold, "r").join(counted(predicted, "h"), [*keys, "type", "text"], "full")
    per_page = both.groupBy(*keys).agg(
        F.sum(F.coalesce(F.least("r", "h"), F.lit(0)) * F.when(F.col("r").isNotNull() & F.col("h").isNotNull(), 1).otherwise(0)).alias("tp"),
        F.coalesce(F.sum("r"), F.lit(0)).alias("n_ref"),
        F.coalesce(F.sum("h"), F.lit(0)).alias("n_hyp"),
    )
    return per_page.join(gold.select(*keys).distinct(), keys, "left_semi")


def _ratio(a: Column, b: Column) -> Column:
    return F.coalesce(F.try_divide(a, b), F.lit(0.0))


def prf(tp: Column, n_ref: Column, n_hyp: Column) -> list[Column]:
    """Precision, recall and F1, each 0 where undefined."""
    p, r = _ratio(tp, n_hyp), _ratio(tp, n_ref)
    return [p.alias("precision"), r.alias("recall"), _ratio(2 * p * r, p + r).alias("f1")]


def corpus_scores(scored: DataFrame, by: str = "model", tier: str = "tier") -> DataFrame:
    """Macro means of ``cer``, ``wer``, ``ned`` and the number of pages, per tier and overall: one grouping-sets pass."""
    present = scored.where("cer is not null")
    level = F.when(F.grouping(tier) == 1, "overall").otherwise(F.col(tier))
    return (
        present.groupingSets([(by, tier), (by,)], by, tier)
        .agg(level.alias("level"), F.count("*").alias("n_pages"), F.avg("cer").alias("cer"), F.avg("wer").alias("wer"), F.avg("ned").alias("ned"))
        .select(by, F.col("level").alias(tier), "n_pages", "cer", "wer", "ned")
    )


def entity_scores(counts: DataFrame, by: str = "model", tier: str = "tier") -> DataFrame:
    """Micro precision, recall and F1 per tier and overall."""
    level = F.when(F.grouping(tier) == 1, "overall").otherwise(F.col(tier))
    sums = counts.groupingSets([(by, tier), (by,)], by, tier).agg(
        level.alias("level"), F.sum("tp").alias("tp"), F.sum("n_ref").alias("n_ref"), F.sum("n_hyp").alias("n_hyp"), F.count("*").alias("n_entity_pages")
    )
    return sums.select(by, F.col("level").alias(tier), "tp", "n_ref", "n_hyp", "n_entity_pages", *prf(F.col("tp"), F.col("n_ref"), F.col("n_hyp")))


def with_idle_models(scores: DataFrame, models: DataFrame, scored: DataFrame) -> DataFrame:
    """Scores plus an ``overall`` row for models without a scored page, and ``n_missing`` on overall rows."""
    missing = scored.groupBy("model").agg(F.count_if("missing").alias("n_missing"))
    overall = models.select("model", F.lit("overall").alias("tier"))
    both = overall.join(scores, ["model", "tier"], "full").withColumn("n_pages", F.coalesce("n_pages", F.lit(0)))
    return both.join(missing, "model", "left").withColumn("n_missing", F.when(F.col("tier") == "overall", F.coalesce("n_missing", F.lit(0))))


#: Metrics of a report: title, column, factor, decimals, and whether more is better.
METRICS = (("CER (%)", "cer", 100, 2, False), ("WER (%)", "wer", 100, 2, False), ("NED", "ned", 1, 3, False))
ENTITY = ("Entity F1", "entity_f1", 1, 2, True)


def with_entities(scores: DataFrame, entities: DataFrame) -> DataFrame:
    """Scores with the columns ``entity_*`` of ``entity_scores`` of the same model and tier."""
    named = entities.select("model", "tier", *(F.col(c).alias(f"entity_{c}") for c in ("precision", "recall", "f1", "n_ref", "n_hyp")), "n_entity_pages")
    return scores.join(named, ["model", "tier"], "left")


def report(scores: list[dict], models: list[str], manifest: str = "", split: str = "all", missing_gold: int = 0) -> str:
    """The comparison as Markdown: an overall table with the best values bold, a table by tier for each metric, notes on missing pages.

    ``scores``: the rows of ``with_idle_models`` (and ``with_entities``), a collected aggregate of a few
    rows. Tiers come in canonical order; the entity column is there if any model has a value.
    """
    cell_of = {(r["model"], r["tier"]): r for r in scores}
    value = lambda model, tier, key: cell_of.get((model, tier), {}).get(key)
    table = lambda head, rows: [f"| {' | '.join(head)} |", f"| {' | '.join('-' * max(3, len(h)) for h in head)} |", *(f"| {' | '.join(r)} |" for r in rows)]
    shown = [*METRICS, *([ENTITY] if any(value(m, "overall", ENTITY[1]) is not None for m in models) else [])]
    best = {}
    for _, key, _, _, more in shown:
        found = [v for m in models if (v := value(m, "overall", key)) is not None]
        best[key] = (max if more else min)(found) if found else None

    def text(v, factor, digits, top=None):
        out = "–" if v is None else f"{v * factor:.{digits}f}"
        return f"**{out}**" if v is not None and v == top else out

    overall = []
    for m in models:
        leads = value(m, "overall", "cer") is not None and value(m, "overall", "cer") == best["cer"]
        overall.append([f"**{m}**" if leads else m, str(value(m, "overall", "n_pages") or 0), *(text(value(m, "overall", key), factor, digits, best[key]) for _, key, factor, digits, _ in shown)])
    lines = ["# Model comparison", "", f"Manifest: `{manifest}` · Split: `{split}` · Models: {len(models)}", "", "## Overall", "", *table(["Model", "Pages", *(t for t, *_ in shown)], overall)]
    tiers = sorted({r["tier"] for r in scores} - {"overall"}, key=lambda t: (TIERS.index(t) if t in TIERS else len(TIERS), t)) + ["overall"]
    for title, key, factor, digits, _ in METRICS:
        lines += ["", f"## {title} by tier", "", *table(["Model", *tiers], [[m, *(text(value(m, t, key), factor, digits) for t in tiers)] for m in models])]
    notes = [f"> {missing_gold} page(s) missing gold transcription — excluded for all models."] if missing_gold else []
    notes += [f"> {m}: {n} page(s) missing prediction." for m in models if (n := value(m, "overall", "n_missing"))]
    return "\n".join([*lines, *([""] if notes else []), *notes, ""])


def write_scores(scores: DataFrame, path: str, columns: list[str]) -> None:
    """``columns`` in this order as one CSV file with a header, floats rounded to six places; scores are an aggregate of few rows."""
    kinds = dict(scores.dtypes)
    cols = [F.bround(c, 6).alias(c) if kinds[c] in ("double", "float") else F.col(c) for c in columns]
    scores.select(*cols).coalesce(1).write.mode("overwrite").option("header", True).csv(path)


def compare_extractions(a: DataFrame, b: DataFrame, keys: list[str], edges: list[str], limit: float = 0.5) -> DataFrame:
    """Two extractions side by side: where a line is, and how far its box edges are apart at most."""
    left, right = a.select(*keys, *(F.col(e).alias(f"a_{e}") for e in edges), F.lit(True).alias("__a")), b.select(*keys, *(F.col(e).alias(f"b_{e}") for e in edges), F.lit(True).alias("__b"))
    both = left.join(right, keys, "full")
    delta = F.greatest(*(F.abs(F.col(f"a_{e}") - F.col(f"b_{e}")) for e in edges))
    side = F.when(F.col("__a") & F.col("__b"), "both").when(F.col("__a"), "only_a").otherwise("only_b")
    return both.select(*keys, side.alias("side"), delta.alias("max_delta"), (delta > limit).alias("moved"))
