"""Incremental conversion: files are converted again only when they have changed since."""

from __future__ import annotations

from collections.abc import Callable
from datetime import datetime, timezone

from pyspark.sql import DataFrame, SparkSession
from pyspark.sql import functions as F

CACHE = "path string, modified timestamp, converted_at timestamp, text string"


def _cached(spark: SparkSession, cache: str) -> DataFrame:
    path = spark._jvm.org.apache.hadoop.fs.Path(cache)
    there = path.getFileSystem(spark._jsc.hadoopConfiguration()).exists(path)
    return spark.read.schema(CACHE).parquet(cache) if there else spark.createDataFrame([], CACHE)


def stale_files(spark: SparkSession, path: str, cache: str) -> DataFrame:
    """``path`` and ``modified`` of the files that no conversion is as new as; contents aren't read."""
    files = spark.read.format("binaryFile").option("recursiveFileLookup", True).load(path).select("path", F.col("modificationTime").alias("modified"))
    known = _cached(spark, cache).groupBy("path").agg(F.max("modified").alias("known"))
    return files.join(known, "path", "left").where(F.col("known").isNull() | (F.col("modified") > F.col("known"))).drop("known")


def convert_changed(spark: SparkSession, path: str, cache: str, convert: Callable[[SparkSession, list[str]], DataFrame]) -> DataFrame:
    """``path`` and ``text`` of all files under ``path``, the changed ones through ``convert`` first.

    ``convert`` gets their paths, which Spark lists on the driver anyway, and returns ``file`` and
    ``text``. What it makes is appended to ``cache`` in one write, so a run that fails leaves the cache as it was, and a file for
    which it makes nothing is tried again next time. The newest conversion of a file counts; files that
    are gone aren't returned.
    """
    stale = {r["path"]: r["modified"] for r in stale_files(spark, path, cache).collect()}
    if stale:
        times = spark.createDataFrame(list(stale.items()), "path string, modified timestamp")
        made = convert(spark, sorted(stale)).select(F.col("file").alias("path"), "text")
        now = datetime.now(tz=timezone.utc).replace(tzinfo=None)
        made.join(times, "path").select("path", "modified", F.lit(now).cast("timestamp").alias("converted_at"), "text").write.mode("append").parquet(cache)
    latest = _cached(spark, cache).groupBy("path").agg(F.max_by("text", F.struct("modified", "converted_at")).alias("text"))
    there = spark.read.format("binaryFile").option("recursiveFileLookup", True).load(path).select("path")
    return latest.join(there, "path", "left_semi")
