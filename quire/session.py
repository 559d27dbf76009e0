"""Session defaults and the shared-storage helpers every multi-pass operator uses."""

from __future__ import annotations

import re
import tempfile
import uuid

from pyspark.sql import DataFrame, SparkSession


def build_session(master: str = "local[*]", shuffle_partitions: int = 8, **conf: str) -> SparkSession:
    """A session with the settings that this library is tuned for.

    Arrow batches are limited by rows, so ``maxRecordsPerBatch`` is kept low enough for
    batches of long documents to fit a Python worker.
    """
    builder = (
        SparkSession.builder.master(master)
        .appName("quire")
        .config("spark.sql.shuffle.partitions", str(shuffle_partitions))
        .config("spark.sql.session.timeZone", "UTC")
        .config("spark.sql.execution.arrow.maxRecordsPerBatch", "5000")
        .config("spark.ui.enabled", "false")
        .config("spark.ui.showConsoleProgress", "false")
    )
    for key, value in conf.items():
        builder = builder.config(key, value)
    return builder.getOrCreate()


def checkpoint_dir(spark: SparkSession) -> str:
    """The shared folder named by the session; a local one is set only where none is configured and all runs in one process."""
    sc = spark.sparkContext
    if not sc.getCheckpointDir():
        shared = spark.conf.get("spark.checkpoint.dir", None)
        if not shared and not re.fullmatch(r"local(\[.*\])?", sc.master):
            raise ValueError("spark.checkpoint.dir must name a folder that the driver and all executors share")
        sc.setCheckpointDir(shared or tempfile.mkdtemp(prefix="quire-checkpoint-"))
    return sc.getCheckpointDir()


def cut_lineage(df: DataFrame) -> DataFrame:
    """Write ``df`` to the shared checkpoint folder and return it without its lineage."""
    checkpoint_dir(df.sparkSession)
    return df.checkpoint(eager=True)


def materialise(df: DataFrame, codec: str = "snappy") -> DataFrame:
    """Write ``df`` as Parquet into the shared checkpoint folder and read it back."""
    path = f"{checkpoint_dir(df.sparkSession).rstrip('/')}/quire-{uuid.uuid4().hex}"
    df.write.option("compression", codec).parquet(path)
    kept = df.sparkSession.read.parquet(path)
    kept.materialised_at = path
    return kept


def discard(*frames: DataFrame) -> None:
    """Delete what ``materialise`` has written for ``frames``, once nothing reads them any more."""
    for df in frames:
        spark = df.sparkSession
        path = spark._jvm.org.apache.hadoop.fs.Path(df.materialised_at)
        path.getFileSystem(spark._jsc.hadoopConfiguration()).delete(path, True)
