"""Operators on ordered lines: quality filter, context windows, prompts and the error cut-off.

A line has ``file``, ``row_idx`` (its order in the file), ``page_num``, ``line_num``, ``categ``,
``quality_score`` and ``text``. All windows share one partitioning and order, so Spark plans one
exchange and one sort for them.
"""

from __future__ import annotations

from dataclasses import dataclass

from pyspark.sql import Column, DataFrame, Window
from pyspark.sql import functions as F

from quire.functions.text import alpha_ratio

ALWAYS_SKIP = ("Empty", "Trash")
NOISE = ("Empty", "Trash", "Non-text")
SECTION = ("Header", "Heading")


@dataclass(frozen=True)
class LineFilter:
    """Limits of the quality filter. ``missing_quality``: a line without a score is ``trash`` or ``keep``-able."""

    trash_below: float = 0.40
    noisy_below: float = 0.70
    include_non_text: bool = True
    min_chars: int = 3
    min_chars_non_text: int = 8
    min_alpha_non_text: float = 0.40
    missing_quality: str = "trash"


def effective_category(p: LineFilter = LineFilter(), categ: str = "categ", quality: str = "quality_score") -> Column:
    """The category after the score has had its say; between the limits anything but trash is noisy."""
    q = F.nanvl(F.col(quality), F.lit(None).cast("double"))
    if p.missing_quality == "trash":
        q = F.coalesce(q, F.lit(0.0))
    c = F.coalesce(F.col(categ), F.lit(""))
    return F.when(q < p.trash_below, "Trash").when((q < p.noisy_below) & (c != "Trash"), "Noisy").otherwise(c)


def skip_reason(p: LineFilter = LineFilter(), text: str = "text", effective: str = "categ_effective") -> Column:
    """Why a line is left out; null for a line to keep."""
    t, c = F.coalesce(F.col(text), F.lit("")), F.col(effective)
    n = F.length(t)
    return (
        F.when(n == 0, "empty text")
        .when(c.isin(*ALWAYS_SKIP), "category")
        .when((c == "Non-text") & F.lit(not p.include_non_text), "non-text excluded")
        .when((c == "Non-text") & (n < p.min_chars_non_text), "non-text too short")
        .when((c == "Non-text") & (alpha_ratio(t) < p.min_alpha_non_text), "non-text without letters")
        .when((c != "Non-text") & (n < p.min_chars), "too short")
    )


def quality_filter(lines: DataFrame, p: LineFilter = LineFilter()) -> DataFrame:
    """``lines`` with ``categ_effective`` and ``skip_reason``; the raw category stays."""
    return lines.withColumn("categ_effective", effective_category(p)).withColumn("skip_reason", skip_reason(p))


def _ordered():
    return Window.partitionBy("file").orderBy("row_idx")


def current_section(lines: DataFrame) -> DataFrame:
    """``section``: the text of the nearest heading before the line, else ``Unknown Section``."""
    before = _ordered().rowsBetween(Window.unboundedPreceding, -1)
    heading = F.when(F.col("categ").isin(*SECTION), F.coalesce(F.trim("text"), F.lit("")))
    return lines.withColumn("section", F.coalesce(F.last(heading, ignorenulls=True).over(before), F.lit("Unknown Section")))


def tagged(text: Column) -> Column:
    return F.concat(F.lit("[P"), F.col("page_num").cast("string"), F.lit(" L"), F.col("line_num").cast("string"), F.lit("] "), text)


def is_noise() -> Column:
    return F.trim(F.coalesce("categ", F.lit(""))).isin(*NOISE)


def document_header(lines: DataFrame, n: int = 2) -> DataFrame:
    """``file`` and ``header``: its first ``n`` lines that aren't noise, as an array in order.

    The window ranks only the surviving lines; the aggregate per file holds ``n`` of them at most.
    """
    ranked = lines.where(~is_noise()).withColumn("__rank", F.row_number().over(_ordered())).where(F.col("__rank") <= n)
    entry = F.struct("__rank", tagged(F.trim("text")).alias("t"))
    return ranked.groupBy("file").agg(F.transform(F.array_sort(F.collect_list(entry)), lambda e: e["t"]).alias("header"))


def context_windows(lines: DataFrame, window: int = 2) -> DataFrame:
    """``lines`` with ``context``: header, section and the lines around, the line itself marked.

    Neighbours on other pages and noise are left out after the frame was cut; the line itself always
    stays. The header is shown from line ``window + 3`` of the file on.
    """
    frame = _ordered().rowsBetween(-window, window)
    one = F.struct("row_idx", "page_num", is_noise().alias("noise"), tagged(F.trim(F.coalesce("text", F.lit("")))).alias("t"))
    position = (F.row_number().over(_ordered()) - 1).alias("__i")
    base = current_section(lines).select("*", position, F.collect_list(one).over(frame).alias("__near"))
    base = base.join(document_header(lines), "file", "left")
    kept = F.filter("__near", lambda e: (e["row_idx"] == F.col("row_idx")) | (e["page_num"].eqNullSafe(F.col("page_num")) & ~e["noise"]))
    shown = F.transform(
        kept,
        lambda e: F.when(e["row_idx"] == F.col("row_idx"), F.concat(F.lit("<target_line> >>> "), e["t"], F.lit(" </target_line>"))).otherwise(F.concat(F.lit("    "), e["t"])),
    )
    header = F.when(
        F.col("__i") > window + 2,
        F.concat(F.array(F.lit("--- GLOBAL DOCUMENT HEADER ---")), F.transform(F.coalesce("header", F.array().cast("array<string>")), lambda h: F.concat(F.lit("    "), h))),
    ).otherwise(F.array().cast("array<string>"))
    title = F.array(F.concat(F.lit("--- CURRENT SECTION: "), F.col("section"), F.lit(" ---")), F.lit("--- LOCAL CONTEXT WINDOW ---"))
    return base.withColumn("context", F.array_join(F.concat(header, title, shown), "\n")).drop("__near", "__i", "header")


def messages(system: Column, context: str = "context", task: str = "Classify the marked line.") -> Column:
    """Chat messages of a line: a system prompt, and its context with the task."""
    user = F.concat(F.lit("DOCUMENT CONTEXT:\n"), F.col(context), F.lit("\n\n" + task))
    return F.array(F.struct(F.lit("system").alias("role"), system.alias("content")), F.struct(F.lit("user").alias("role"), user.alias("content")))


def abort_after_errors(attempts: DataFrame, limit: int = 10, key: str = "file", order: tuple[str, ...] = ("row_idx",), status: str = "status") -> DataFrame:
    """``attempts`` up to and with the ``limit``-th error in a row per key, with ``error_run``.

    ``status`` is ``ok``, ``error`` or ``skip``: a success starts a new run, a skip neither counts
    nor interrupts.
    """
    w = Window.partitionBy(key).orderBy(*order)
    upto = w.rowsBetween(Window.unboundedPreceding, 0)
    islands = attempts.withColumn("__island", F.count(F.when(F.col(status) == "ok", 1)).over(upto))
    inside = Window.partitionBy(key, "__island").orderBy(*order).rowsBetween(Window.unboundedPreceding, 0)
    runs = islands.withColumn("error_run", F.count(F.when(F.col(status) == "error", 1)).over(inside))
    hit = F.when((F.col("error_run") == limit) & (F.col(status) == "error"), 1)
    earlier = w.rowsBetween(Window.unboundedPreceding, -1)
    return runs.withColumn("__cut", F.count(hit).over(earlier)).where(F.col("__cut") == 0).drop("__cut", "__island")


def run_status(attempts: DataFrame, limit: int = 10, key: str = "file", order: tuple[str, ...] = ("row_idx",), status: str = "status") -> DataFrame:
    """One row per key: processed, errors, skipped, ``aborted``."""
    kept = abort_after_errors(attempts, limit, key, order, status)
    n = lambda s: F.count(F.when(F.col(status) == s, 1))
    aborted = F.max(F.when((F.col(status) == "error") & (F.col("error_run") >= limit), True).otherwise(False))
    return kept.groupBy(key).agg(n("ok").alias("processed"), n("error").alias("errors"), n("skip").alias("skipped"), aborted.alias("aborted"))


def resume(work: DataFrame, done: DataFrame, key: str = "file") -> DataFrame:
    """What isn't in the output yet."""
    return work.join(done.select(key).distinct(), key, "left_anti")
