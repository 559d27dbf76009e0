"""Page statistics, difficulty tiers, stratified samples and splits."""

from __future__ import annotations

from pyspark.sql import Column, DataFrame, Window
from pyspark.sql import functions as F

VALID = ("Clear", "Noisy")
CATEGORIES = ("Clear", "Noisy", "Trash", "Non-text", "Empty")
TIERS = ("clean", "degraded", "hard", "text_poor")


def page_stats(lines: DataFrame) -> DataFrame:
    """Lines by category and the mean score of valid lines, per (file, page): one aggregation, no join.

    Lines without a category form no page; ``num_lines`` counts the five known categories; the score
    is null without a valid line, and NaN scores don't count.
    """
    q = F.nanvl(F.col("quality_score"), F.lit(None).cast("double"))
    counts = [F.count_if(F.col("categ") == c).alias(c) for c in CATEGORIES]
    return (
        lines.where("categ is not null and file is not null and page_num is not null")
        .groupBy("file", "page_num")
        .agg(*counts, F.avg(F.when(F.col("categ").isin(*VALID), q)).alias("avg_quality_score"))
        .withColumn("num_lines", sum((F.col(f"`{c}`") for c in CATEGORIES[1:]), F.col(CATEGORIES[0])))
    )


def assign_tiers(pages: DataFrame, clean_min: float = 0.85, degraded_min: float = 0.60, valid_ratio_min: float = 0.50) -> DataFrame:
    """``tier`` and ``valid_line_ratio``; a page without a score is text-poor whatever else it has."""
    score = F.nanvl(F.col("avg_quality_score").cast("double"), F.lit(None).cast("double"))
    total = sum((F.col(f"`{c}`") for c in CATEGORIES[1:]), F.col(CATEGORIES[0]))
    ratio = F.try_divide(F.col("Clear") + F.col("Noisy"), total)
    tier = (
        F.when(score.isNull(), "text_poor")
        .when((score >= clean_min) & (ratio >= valid_ratio_min), "clean")
        .when(score >= degraded_min, "degraded")
        .otherwise("hard")
    )
    return pages.withColumn("tier", tier).withColumn("valid_line_ratio", F.coalesce(F.bround(ratio, 4), F.lit(0.0)))


def _draw(seed: int, keys: list[str]) -> Column:
    """A reproducible order: md5 of seed and key, the key settling ties."""
    return F.md5(F.concat_ws("|", F.lit(str(seed)), *(F.col(k).cast("string") for k in keys)))


def stratified_sample(tiered: DataFrame, n_pages: int = 200, seed: int = 42, keys: tuple[str, ...] = ("file", "page_num")) -> DataFrame:
    """Of every tier present ``max(1, n_pages // tiers)`` pages, or all it has."""
    keys = list(keys)
    tiers = tiered.select("tier").distinct().count()
    share = max(1, n_pages // max(1, tiers))
    # a literal limit, so that Spark cuts every task's rows of a tier before the exchange
    rank = F.row_number().over(Window.partitionBy("tier").orderBy(_draw(seed, keys), *keys))
    return tiered.withColumn("__rank", rank).where(F.col("__rank") <= share).drop("__rank")


def assign_splits(sampled: DataFrame, train: float = 0.8, dev: float = 0.1, seed: int = 42, keys: tuple[str, ...] = ("file", "page_num")) -> DataFrame:
    """``split`` per tier, sizes rounded half to even."""
    keys = list(keys)
    rank = F.row_number().over(Window.partitionBy("tier").orderBy(_draw(seed + 1, keys), *keys))
    n = F.count("*").over(Window.partitionBy("tier"))
    out = sampled.withColumn("__rank", rank).withColumn("__n", n)
    n_train, n_dev = F.bround(F.col("__n") * F.lit(train)), F.bround(F.col("__n") * F.lit(dev))
    split = F.when(F.col("__rank") <= n_train, "train").when(F.col("__rank") <= n_train + n_dev, "dev").otherwise("test")
    return out.withColumn("split", split).drop("__rank", "__n")


def tier_split_counts(manifest: DataFrame) -> DataFrame:
    """Pages by tier and split."""
    counts = [F.count_if(F.col("split") == s).alias(s) for s in ("train", "dev", "test")]
    return manifest.groupBy("tier").agg(*counts)


def tier_order(tier: str = "tier") -> Column:
    """Known tiers in order of difficulty, others after them, ``overall`` last; sort by this, then by name."""
    out = F.when(F.col(tier) == TIERS[0], 0)
    for i, t in enumerate(TIERS[1:], 1):
        out = out.when(F.col(tier) == t, i)
    return out.when(F.col(tier) == "overall", len(TIERS) + 1).otherwise(len(TIERS))
