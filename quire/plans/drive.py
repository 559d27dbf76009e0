"""Predictions that are made once and in order, until a file is given up.

A file's prompts go to the predictor one by one in their order, as the answers decide whether to go on:
after ``limit`` failures in a row the rest of the file isn't asked for. Replies cost money and may
differ when asked again, so they are written to the shared folder before anything reads them.
"""

from __future__ import annotations

import json
from collections.abc import Callable, Iterator

import pandas as pd
from pyspark.sql import DataFrame
from pyspark.sql.types import ArrayType, DoubleType, StringType, StructField, StructType

from quire.session import materialise

META = "No category"
#: A prompt holds the whole vocabulary, so it is small; a larger one is an error.
CATEGORIES = 100_000

REPLY_FIELDS = StructType(
    [
        StructField("status", StringType()),
        StructField("keywords", ArrayType(StringType())),
        StructField("keywords_en", ArrayType(StringType())),
        StructField("category", StringType()),
        StructField("confidence", DoubleType()),
        StructField("error", StringType()),
    ]
)


def category_set(categories: DataFrame) -> frozenset[str]:
    """The vocabulary on the driver; its size is checked first."""
    rows = categories.select("category").distinct().limit(CATEGORIES + 1).collect()
    if len(rows) > CATEGORIES:
        raise ValueError(f"more than {CATEGORIES} categories")
    return frozenset(r[0] for r in rows if r[0] is not None)


def _texts(value) -> list[str]:
    return [v if isinstance(v, str) else json.dumps(v, ensure_ascii=False) for v in value if v is not None] if isinstance(value, list) else []


def _number(value) -> float:
    if isinstance(value, bool):
        raise ValueError("no confidence")
    try:
        number = float(value)
    except (TypeError, ValueError):
        raise ValueError("no confidence") from None
    if number != number:
        raise ValueError("no confidence")
    return number


def read_reply(reply: str | None, known: frozenset[str], meta: str = META) -> dict:
    """The fields of a reply to a line; ``ValueError`` names what makes it unusable."""
    try:
        found = json.loads(reply, strict=False)
    except (TypeError, ValueError):
        raise ValueError("no valid JSON") from None
    if not isinstance(found, dict) or not isinstance(found.get("category"), str):
        raise ValueError("no valid JSON")
    confidence = min(1.0, max(0.0, _number(found.get("confidence"))))
    category = found["category"]
    if category != meta and category not in known:
        raise ValueError("unknown category")
    words = {k: [] if category == meta else _texts(found.get(k)) for k in ("keywords", "keywords_en")}
    return {**words, "category": category, "confidence": confidence}


def read_items(reply: str | None, known: frozenset[str], meta: str = META) -> list[dict]:
    """The located passages of a reply to a document; one bad item makes the whole reply unusable."""
    try:
        items = json.loads(reply, strict=False)["items"]
    except (TypeError, ValueError, KeyError):
        raise ValueError("no valid JSON") from None
    if not isinstance(items, list) or not all(isinstance(i, dict) for i in items):
        raise ValueError("no valid JSON")
    out = []
    for item in items:
        if item.get("locator") is None:
            raise ValueError("no locator")
        category, confidence = item.get("category"), _number(item.get("confidence"))
        if category != meta and category not in known:
            raise ValueError("unknown category")
        if not 0 <= confidence <= 1:
            raise ValueError("confidence out of range")
        page = item.get("page")
        words = {k: [] if category == meta else _texts(item.get(k)) for k in ("keywords", "keywords_en")}
        out.append({"locator": _text(item["locator"]), "page": None if page is None else _text(page), **words, "category": category, "confidence": confidence})
    return out


def _text(value) -> str:
    return value if isinstance(value, str) else json.dumps(value, ensure_ascii=False)


class Asking:
    """Prompts one at a time to a predictor, which keeps its session until it fails."""

    def __init__(self, predictor: Callable[[Iterator[str]], Iterator[str]]):
        self.predictor, self.replies, self.waiting = predictor, None, []

    def __call__(self, prompt: str) -> str:
        self.waiting = [prompt]
        try:
            for _ in range(2):
                if self.replies is None:
                    self.replies = iter(self.predictor(iter(self._prompts, None)))
                for reply in self.replies:
                    return reply
                self.replies = None
                if not self.waiting:
                    break  # it took the prompt; if it hadn't, it had ended before and is opened again
            raise RuntimeError("the predictor gave no reply")
        except Exception:
            self.replies = None  # its session is gone: the next prompt opens another
            raise

    def _prompts(self) -> str | None:
        return self.waiting.pop(0) if self.waiting else None


def drive_lines(lines: DataFrame, predictor, known: frozenset[str], limit: int = 10, key: str = "file", order: str = "row_idx", prompt: str = "context", wanted: str = "wanted") -> DataFrame:
    """``lines`` up to where their file is given up, with ``status`` (``ok``, ``error``, ``skip``), the reply's fields and ``error``.

    Rows whose ``wanted`` is false are skipped: they are never asked for, and neither count as failures
    nor end a run of them. A predictor that raises has failed for that line. The rows of one file
    go through one task in order, as they must, but stream through it.
    """
    schema = StructType([*lines.schema.fields, *REPLY_FIELDS.fields])
    names, fields = lines.columns, REPLY_FIELDS.names

    def run(frames: Iterator[pd.DataFrame]) -> Iterator[pd.DataFrame]:
        ask = Asking(predictor)
        file, failures = object(), 0
        for frame in frames:
            keep, new = [], {f: [] for f in fields}
            for i, (this, want, text) in enumerate(zip(frame[key], frame[wanted], frame[prompt])):
                if this != file:
                    file, failures = this, 0
                if failures >= limit:
                    continue
                got = dict.fromkeys(fields)
                if not want:
                    got["status"] = "skip"
                else:
                    try:
                        got |= read_reply(ask(text), known) | {"status": "ok"}
                        failures = 0
                    except Exception as e:
                        got |= {"status": "error", "error": str(e) or type(e).__name__}
                        failures += 1
                keep.append(i)
                for f in fields:
                    new[f].append(got[f])
            yield frame.iloc[keep].assign(**{f: pd.Series(v, index=frame.index[keep], dtype="object") for f, v in new.items()})[[*names, *fields]]

    return materialise(lines.repartition(key).sortWithinPartitions(key, order).mapInPandas(run, schema))


def drive_documents(docs: DataFrame, predictor, known: frozenset[str], key: str, prompt: str = "prompt") -> DataFrame:
    """``key``, ``items`` and ``error``: one call for each document, whatever is read of its reply afterwards."""
    item = "locator: string, page: string, keywords: array<string>, keywords_en: array<string>, category: string, confidence: double"
    schema = f"`{key}` {docs.schema[key].dataType.simpleString()}, items array<struct<{item}>>, error string"

    def run(frames: Iterator[pd.DataFrame]) -> Iterator[pd.DataFrame]:
        ask = Asking(predictor)
        for frame in frames:
            items, errors = [], []
            for text in frame[prompt]:
                try:
                    items.append(read_items(ask(text), known))
                    errors.append(None)
                except Exception as e:
                    items.append([])
                    errors.append(str(e) or type(e).__name__)
            yield pd.DataFrame({key: frame[key], "items": pd.Series(items, index=frame.index, dtype="object"), "error": pd.Series(errors, index=frame.index, dtype="object")})

    return materialise(docs.select(key, prompt).mapInPandas(run, schema))
