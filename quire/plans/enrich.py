"""Line enrichment end to end: filter, context, prediction, validation, error cut-off.

A predictor takes an iterator of pandas frames with a ``messages`` column and yields frames with the
reply as text; it opens its session once per partition and retries inside. ``LexicalPredictor`` needs
no model: it picks the vocabulary terms that a line contains.
"""

from __future__ import annotations

import json
import time
from collections.abc import Callable, Iterator
from typing import Protocol

import pandas as pd
from pyspark.sql import Column, DataFrame, SparkSession
from pyspark.sql import functions as F
from pyspark.sql.types import StringType, StructField, StructType

from quire.functions.text import approx_tokens
from quire.operators import lines as L
from quire.operators.vocabulary import prompt_prefix, render_prompt
from quire.plans.drive import META, category_set, drive_documents, drive_lines


class Predictor(Protocol):
    def __call__(self, prompts: Iterator[str]) -> Iterator[str]: ...


class LexicalPredictor:
    """Deterministic replies from a term list: (term, English term, theme), the longest contained term deciding."""

    def __init__(self, terms: list[tuple[str, str, str]]):
        self.terms = sorted(terms, key=lambda t: (-len(t[0]), t[0]))

    def __call__(self, prompts: Iterator[str]) -> Iterator[str]:
        for prompt in prompts:
            target = prompt.partition("<target_line>")[2].partition("</target_line>")[0].lower()
            hits = [t for t in self.terms if t[0].lower() in target][:5]
            reply = {"keywords": [t[0] for t in hits], "keywords_en": [t[1] for t in hits], "category": hits[0][0] if hits else META, "confidence": min(1.0, 0.5 + 0.1 * len(hits)) if hits else 0.0}
            yield json.dumps(reply, ensure_ascii=False)


class RetryingPredictor:
    """Calls ``ask`` (prompt to reply), waiting 1, 2, 4 ... ``most`` seconds between attempts; the last error is raised."""

    def __init__(self, ask: Callable[[str], str], attempts: int = 5, most: float = 30.0, retry: tuple[type[Exception], ...] = (OSError,)):
        self.ask, self.attempts, self.most, self.retry = ask, attempts, most, retry

    def __call__(self, prompts: Iterator[str]) -> Iterator[str]:
        for prompt in prompts:
            for k in range(self.attempts):
                try:
                    yield self.ask(prompt)
                    break
                except self.retry:
                    if k == self.attempts - 1:
                        raise
                    time.sleep(min(2.0**k, self.most))


def predict(df: DataFrame, predictor: Predictor, prompt: str = "context") -> DataFrame:
    """``df`` with ``reply``; the predictor sees one partition's prompts in order."""
    schema = StructType([*df.schema.fields, StructField("reply", StringType())])  # add() would change df's own schema
    names = [*df.columns, "reply"]

    def run(frames: Iterator[pd.DataFrame]) -> Iterator[pd.DataFrame]:
        for frame in frames:
            frame["reply"] = list(predictor(iter(frame[prompt]))) if len(frame) else pd.Series([], dtype="object")
            yield frame[names]

    return df.mapInPandas(run, schema)


REPLY = "keywords ARRAY<STRING>, keywords_en ARRAY<STRING>, category STRING, confidence STRING"


def validate(df: DataFrame, categories: DataFrame, reply: str = "reply", meta: str = META) -> DataFrame:
    """``df`` with the reply's fields and ``error``: null for a usable reply.

    Confidence may come as a string and is held between 0 and 1; a category outside ``categories``
    (one column, ``category``) and a reply that is no such JSON are errors; the meta category has no
    keywords.
    """
    parsed = df.withColumn("__r", F.from_json(reply, REPLY, {"allowUnquotedControlChars": "true"}))
    known = categories.select(F.col("category").alias("__known")).distinct()
    met = parsed.join(known, parsed["__r.category"] == known["__known"], "left")
    confidence = F.least(F.lit(1.0), F.greatest(F.lit(0.0), F.col("__r.confidence").try_cast("double")))
    is_meta = F.col("__r.category") == meta
    none = F.array().cast("array<string>")
    error = F.when(F.col("__r.category").isNull(), "no valid JSON").when(confidence.isNull(), "no confidence").when(F.col("__known").isNull() & ~is_meta, "unknown category")
    keep = lambda c: F.when(is_meta, none).otherwise(F.coalesce(c, none))
    return met.select(*df.columns, keep(F.col("__r.keywords")).alias("keywords"), keep(F.col("__r.keywords_en")).alias("keywords_en"), F.col("__r.category").alias("category"), confidence.alias("confidence"), error.alias("error"))


def enrich_lines(lines: DataFrame, predictor: Predictor, categories: DataFrame, p: L.LineFilter = L.LineFilter(), limit: int = 10) -> tuple[DataFrame, DataFrame]:
    """(records, status): enriched lines, and per file what was processed, skipped and whether it was cut off.

    The windows see all lines, as lines that aren't kept still are context. Every wanted line is asked
    for once, in the order of its file and not after the cut-off, however often the results are read.
    """
    windowed = L.context_windows(L.quality_filter(lines, p)).withColumn("wanted", F.col("skip_reason").isNull())
    driven = drive_lines(windowed.select("file", "row_idx", "page_num", "line_num", "categ", "quality_score", "text", "context", "wanted"), predictor, category_set(categories), limit)
    status = L.run_status(driven.select("file", "row_idx", "status"), limit)
    return driven.where("status = 'ok'").drop("status", "context", "error", "wanted"), status


def document_prompt(text: Column) -> Column:
    return F.concat(F.lit("DOCUMENT:\n"), text)


def system_prompt(terms: DataFrame, header: str, budget: int, footer: str = "") -> tuple[str, list[str]]:
    """(prompt, labels): the header, as many terms (pos, theme, sub, label) as the budget of tokens takes, the footer.

    A dimension's worth of rows reaches the driver: no more than fit the budget.
    """
    shown = terms.withColumn("rendered", F.col("label"))
    fit = prompt_prefix(shown, budget, len(header) + len(footer))
    labels = [r["label"] for r in fit.orderBy("pos").select("label").collect()]
    if not [t for t in labels if t != META]:
        raise ValueError("no vocabulary term reached the prompt")
    lines = [r["line"] for r in render_prompt(fit).collect()]
    return "\n".join([p for p in (header, *lines, footer) if p]), labels


def enrich_documents(docs: DataFrame, predictor: Predictor, categories: DataFrame, key: str = "file", text: str = "text") -> tuple[DataFrame, DataFrame]:
    """(items, status): one call per document, one row per located passage of its reply, one status row per document.

    A reply that is no such JSON, or has an item without a locator, a known category or a confidence
    between 0 and 1, makes the whole document ``aborted`` without an item. An empty list is a success.
    """
    asked = docs.select(key, document_prompt(F.coalesce(F.col(text), F.lit(""))).alias("prompt"))
    replies = drive_documents(asked, predictor, category_set(categories), key)
    aborted = F.col("error").isNotNull()
    status = replies.select(key, F.size("items").cast("bigint").alias("processed"), aborted.cast("int").alias("errors"), aborted.alias("aborted"))
    return replies.select(key, F.posexplode("items").alias("pos", "i")).select(key, "pos", "i.*"), status


def citation(doc: Column, page: Column) -> Column:
    """``[Source: id, Page n]`` where the page is known."""
    return F.when(page.isNotNull(), F.concat(F.lit("[Source: "), doc, F.lit(", Page "), page.cast("string"), F.lit("]")))


def within_budget(prompt: Column, budget: int) -> Column:
    return approx_tokens(prompt) <= budget


def vocabulary_categories(spark: SparkSession, terms: list[str]) -> DataFrame:
    """Categories for ``validate``; an empty vocabulary is an error, as no reply could be right."""
    if not [t for t in terms if t != META]:
        raise ValueError("no vocabulary term reached the prompt")
    return spark.createDataFrame([(t,) for t in terms], "category string")
