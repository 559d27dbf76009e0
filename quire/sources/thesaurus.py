"""A thesaurus from its service, file by file, with the pinned snapshot for what the service refuses."""

from __future__ import annotations

import json
import urllib.request
from collections.abc import Iterator

from pyspark.sql import DataFrame, SparkSession
from pyspark.sql import functions as F
from pyspark.sql.datasource import DataSource, DataSourceReader, InputPartition


class OneFile(InputPartition):
    def __init__(self, name: str):
        self.name = name


class JsonFilesReader(DataSourceReader):
    def __init__(self, options: dict[str, str]):
        self.url, self.files, self.timeout = options["url"].rstrip("/"), json.loads(options["files"]), float(options.get("timeout", "60"))

    def partitions(self) -> list[InputPartition]:
        return [OneFile(name) for name in self.files]

    def read(self, partition: OneFile) -> Iterator[tuple]:
        try:
            with urllib.request.urlopen(f"{self.url}/{partition.name}", timeout=self.timeout) as r:
                text = r.read().decode("utf-8-sig")
            if not isinstance(json.loads(text), (dict, list)):
                raise ValueError("neither an object nor an array")
            yield partition.name, text, None
        except (OSError, ValueError) as e:
            yield partition.name, None, f"{type(e).__name__}: {e}"


class JsonFilesSource(DataSource):
    """Rows of ``name``, ``value`` and ``reason``: one partition, and one row, for each of ``files`` (a JSON array of names) under ``url``."""

    @classmethod
    def name(cls) -> str:
        return "json_files"

    def schema(self) -> str:
        return "name string, value string, reason string"

    def reader(self, schema) -> DataSourceReader:
        return JsonFilesReader(dict(self.options))


def read_snapshot(spark: SparkSession, path: str) -> DataFrame:
    return spark.read.text(path, wholetext=True).select(F.col("_metadata.file_name").alias("name"), "value")


def read_thesaurus(spark: SparkSession, snapshot: str, url: str | None = None, files: list[str] | None = None, timeout: float = 60.0) -> DataFrame:
    """``name``, ``value`` (JSON text), ``origin`` (live or snapshot) and ``reason``, why it isn't live.

    Without a ``url`` all rows are the snapshot's. A file that the service refuses or garbles is the
    snapshot's of that name; if the snapshot has none of that name, as when the service has one export
    of everything, the whole snapshot stands in for it and no live file counts. ``files`` defaults to the
    snapshot's names, of which there are few.
    """
    pinned = read_snapshot(spark, snapshot)
    if url is None:
        return pinned.select("name", "value", F.lit("snapshot").alias("origin"), F.lit(None).cast("string").alias("reason"))
    if files is None:
        files = sorted(r["name"] for r in pinned.select("name").collect())
    spark.dataSource.register(JsonFilesSource)
    live = spark.read.format("json_files").options(url=url, files=json.dumps(files), timeout=timeout).load()
    live = live.persist()  # asked for once
    met = live.join(pinned.withColumnRenamed("value", "pinned"), "name", "left")
    lost = met.where("value is null and pinned is null").orderBy("name").first()
    if lost is not None:
        out = pinned.select("name", "value", F.lit("snapshot").alias("origin"), F.lit(f"{lost['name']}: {lost['reason']}").alias("reason"))
    else:
        out = met.select("name", F.coalesce("value", "pinned").alias("value"), F.when(F.col("value").isNull(), "snapshot").otherwise("live").alias("origin"), "reason")
    return out
