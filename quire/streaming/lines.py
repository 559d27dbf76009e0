"""Streaming: new line files as they arrive, filtered, with the error cut-off kept as state per file."""

from __future__ import annotations

from collections.abc import Iterator

import pandas as pd
from pyspark.sql import DataFrame, SparkSession
from pyspark.sql.streaming import StatefulProcessor, StatefulProcessorHandle

from quire.operators.lines import LineFilter, quality_filter

SCHEMA = "file string, row_idx bigint, page_num int, line_num int, categ string, quality_score double, text string"


def stream_lines(spark: SparkSession, path: str, schema: str = SCHEMA) -> DataFrame:
    """A stream over Parquet line tables added to a folder."""
    return spark.readStream.schema(schema).parquet(path)


def stream_filtered(lines: DataFrame, p: LineFilter = LineFilter()) -> DataFrame:
    """Lines to keep; the filter needs no state."""
    return quality_filter(lines, p).where("skip_reason is null")


class ErrorCutoff(StatefulProcessor):
    """Passes the attempts of a key on until ``limit`` errors in a row, then no more."""

    def __init__(self, limit: int = 10):
        self.limit = limit

    def init(self, handle: StatefulProcessorHandle) -> None:
        self.run = handle.getValueState("run", "errors int, closed boolean")

    def handleInputRows(self, key, rows: Iterator[pd.DataFrame], timerValues) -> Iterator[pd.DataFrame]:
        errors, closed = self.run.get() if self.run.exists() else (0, False)
        batch = pd.concat(list(rows)).sort_values("row_idx")
        out = []
        for row_idx, status in zip(batch["row_idx"], batch["status"], strict=True):
            if closed:
                break
            errors = 0 if status == "ok" else errors + (status == "error")
            closed = errors >= self.limit
            out.append((key[0], row_idx, status, errors))
        self.run.update((errors, closed))
        yield pd.DataFrame(out, columns=["file", "row_idx", "status", "error_run"]).astype({"row_idx": "int64", "error_run": "int32"})

    def close(self) -> None:
        pass


def stream_cutoff(attempts: DataFrame, limit: int = 10) -> DataFrame:
    """A stream of (file, row_idx, status) cut off per file after ``limit`` errors in a row.

    Needs the RocksDB state store. Attempts of a file must arrive in order of micro-batches; inside
    one they are ordered here.
    """
    return attempts.groupBy("file").transformWithStateInPandas(ErrorCutoff(limit), "file string, row_idx bigint, status string, error_run int", "Append", "None")
