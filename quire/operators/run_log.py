"""The log of a run: an append-only table of events, written as the steps are, and summed up when it is read.

A step is one write. What it has produced and left out is counted by ``DataFrame.observe`` while the
write runs, so nothing is computed twice, and its events are appended when the write is done. A run
that is broken off is opened again by its id: finished steps are skipped, the one that was cut is
written anew, and the log reads as that of one run.
"""

from __future__ import annotations

import json
import sys
import uuid
from collections.abc import Callable
from datetime import datetime, timezone

from pyspark.sql import Column, DataFrame, Observation, SparkSession, Window
from pyspark.sql import functions as F
from pyspark.sql.types import _parse_datatype_string

from quire.operators.provenance import effective_license, with_default_license

SCHEMA_VERSION = "2.0"
#: ``kind``: start, component, step, output, skip or end. ``commit`` is one append; a step counts by its last one.
EVENT = "run_id string, commit string, step string, kind string, name string, value string, n bigint, ts timestamp"


def now() -> datetime:
    return datetime.now(tz=timezone.utc).replace(tzinfo=None)


class RunLog:
    """Events of one run under ``folder``; with the ``run_id`` of an earlier run it goes on with that."""

    def __init__(self, spark: SparkSession, folder: str, program: str, config: dict | None = None, version: str = "unknown", components: dict[str, str] | None = None, image: str = "", run_id: str | None = None, clock: Callable[[], datetime] = now):
        self.spark, self.folder, self.program, self.clock = spark, folder.rstrip("/"), program, clock
        self.run_id = run_id or f"{clock():%y%m%d-%H%M%S}-{uuid.uuid4().hex[:6]}"
        if not self._known():
            about = {"program": program, "version": version, "image": image, "python": sys.version, "config": config or {}}
            self._append(None, [("start", "about", json.dumps(about, ensure_ascii=False, default=str), 1)])
        for name, license in (components or {}).items():
            self.component(name, license)

    @property
    def events_path(self) -> str:
        return f"{self.folder}/events"

    def events(self) -> DataFrame:
        """The events of all runs that count: those of a step's last commit, and all outside of steps."""
        every = self.spark.read.schema(EVENT).parquet(self.events_path)
        last = every.where("kind = 'step'").groupBy("run_id", "step").agg(F.max_by("commit", F.struct("ts", "commit")).alias("commit"))
        return every.where("step is null").unionByName(every.join(last, ["run_id", "step", "commit"], "left_semi"))

    def own_events(self) -> DataFrame:
        return self.events().where(F.col("run_id") == self.run_id)

    def _known(self) -> bool:
        path = self.spark._jvm.org.apache.hadoop.fs.Path(self.events_path)
        if not path.getFileSystem(self.spark._jsc.hadoopConfiguration()).exists(path):
            return False
        return not self.spark.read.schema(EVENT).parquet(self.events_path).where((F.col("run_id") == self.run_id) & (F.col("kind") == "start")).isEmpty()

    def _append(self, step: str | None, rows: list[tuple], more: DataFrame | None = None) -> None:
        """One append of (kind, name, value, n); it is seen whole or not at all."""
        commit, ts = uuid.uuid4().hex, self.clock()
        schema = _parse_datatype_string(EVENT)
        df = self.spark.createDataFrame([(self.run_id, commit, step, kind, name, value, n, ts) for kind, name, value, n in rows], schema).coalesce(1)
        if more is not None:
            df = df.unionByName(more.select(F.lit(self.run_id).alias("run_id"), F.lit(commit).alias("commit"), F.lit(step).alias("step"), F.lit("skip").alias("kind"), "name", "value", F.lit(1).cast("bigint").alias("n"), F.lit(ts).alias("ts")))
        df.write.mode("append").parquet(self.events_path)

    def component(self, name: str, license: str | None = None) -> None:
        """A component that the run has used; its last licence counts."""
        self._append(None, [("component", name, license or "UNKNOWN", 1)])

    def skip(self, file: str, reason: str) -> None:
        self._append(None, [("skip", file, reason, 1)])

    def success(self, output: str, n: int = 1) -> None:
        self._append(None, [("output", output, None, n)])

    def done(self, step: str) -> bool:
        return not self.own_events().where((F.col("kind") == "step") & (F.col("step") == step)).isEmpty()

    def write(self, step: str, make: Callable[[], DataFrame], path: str, outputs: dict[str, Column], documents: Column | None = None, skipped: Column | None = None, file: str = "file", reason: Column | None = None) -> DataFrame:
        """The result of a step, written to ``path`` once; if the run has it already, ``make`` isn't called.

        ``outputs``: a condition for each type of output; ``documents``: for what counts as a processed
        document; ``skipped``: for rows that are left out, with their ``file`` and ``reason``. A null
        condition is false. The counts are taken while the rows are written; the skipped ones are read
        from what was written.
        """
        if not self.done(step):
            df, seen = make(), Observation()
            true = lambda c: F.coalesce(c, F.lit(False))
            counts = {f"output:{k}": F.count_if(true(c)) for k, c in outputs.items()} | {"rows": F.count(F.lit(1))}
            if documents is not None:
                counts["documents"] = F.count_if(true(documents))
            marked = df if skipped is None else df.withColumn("__skip", F.when(true(skipped), F.coalesce(reason if reason is not None else F.lit(""), F.lit(""))))
            marked.observe(seen, *(c.alias(k) for k, c in counts.items())).write.mode("overwrite").parquet(path)
            got = seen.get
            rows = [("step", "rows", path, got["rows"])] + [("output", k.removeprefix("output:"), None, n) for k, n in got.items() if k.startswith("output:")]
            rows += [("documents", "documents", None, got["documents"])] if "documents" in got else []
            left = None
            if skipped is not None:
                left = self.spark.read.parquet(path).where("__skip is not null").select(F.col(f"`{file}`").cast("string").alias("name"), F.col("__skip").alias("value"))
            self._append(step, rows, left)
        out = self.spark.read.parquet(path)
        return out.drop("__skip")

    def statistics(self) -> DataFrame:
        return run_totals(self.own_events())

    def finalise(self, input_total: int | None = None, processed_total: int | None = None) -> DataFrame:
        """End the run and write its record as JSON under ``logs``; one that has ended already is an error."""
        if not self.own_events().where("kind = 'end'").isEmpty():
            raise RuntimeError(f"run {self.run_id} has ended")
        totals = {"input_total": input_total, "processed_total": processed_total}
        self._append(None, [("end", k, None, v) for k, v in totals.items() if v is not None] + [("end", "end", None, 1)])
        record = run_records(self.own_events())
        record.select("json").coalesce(1).write.mode("overwrite").text(f"{self.folder}/logs/{self.run_id}_{self.program}")
        return record

    def state(self) -> str:
        """What another process needs to go on with this run."""
        return json.dumps({"run_id": self.run_id, "folder": self.folder, "program": self.program})

    @classmethod
    def of_state(cls, spark: SparkSession, state: str) -> RunLog:
        found = json.loads(state)
        log = cls(spark, found["folder"], found["program"], run_id=found["run_id"])
        return log


def run_totals(events: DataFrame) -> DataFrame:
    """Per run: ``inputs``, ``processed``, ``skipped``, ``outputs`` (count by type), ``per_minute`` by type, ``start``, ``end``, ``seconds``.

    Processed documents are those that were given at the end, else those counted as documents, else the
    most frequent output; inputs are those given at the end, else processed and skipped ones.
    """
    outputs = events.where("kind = 'output'").groupBy("run_id", "name").agg(F.sum("n").alias("n"))
    by_type = outputs.groupBy("run_id").agg(F.array_sort(F.collect_list(F.struct("name", "n"))).alias("o"), F.max("n").alias("most"))
    given = lambda name: F.max(F.when((F.col("kind") == "end") & (F.col("name") == name), F.col("n")))
    total = events.groupBy("run_id").agg(
        F.min("ts").alias("start"), F.max("ts").alias("end"), F.count_if(F.col("kind") == "skip").alias("skipped"), F.sum(F.when(F.col("kind") == "documents", F.col("n"))).alias("documents"),
        given("input_total").alias("input_total"), given("processed_total").alias("processed_total"),
    ).join(by_type, "run_id", "left")
    seconds = (F.unix_micros("end") - F.unix_micros("start")) / 1_000_000
    documents = F.when(F.col("documents") > 0, F.col("documents"))
    total = total.withColumn("seconds", seconds).withColumn("processed", F.coalesce("processed_total", documents, "most", F.lit(0)).cast("bigint"))
    total = total.withColumn("inputs", F.coalesce("input_total", F.col("processed") + F.col("skipped"))).withColumn("o", F.coalesce("o", F.array().cast("array<struct<name:string,n:bigint>>")))
    rate = lambda e: F.struct(e["name"].alias("name"), F.coalesce(F.round(F.try_divide(e["n"], F.col("seconds") / 60), 4), F.lit(0.0)).alias("rate"))
    return total.select("run_id", "inputs", "processed", "skipped", F.map_from_entries("o").alias("outputs"), F.map_from_entries(F.transform("o", rate)).alias("per_minute"), "start", "end", "seconds")


def run_records(events: DataFrame) -> DataFrame:
    """``run_id`` and ``json``: the record of every run, with its statistics, licences and skipped files."""
    about = events.where("kind = 'start'").groupBy("run_id").agg(F.min("value").alias("about"))
    last = Window.partitionBy("run_id", "name").orderBy(F.desc("ts"))
    parts = events.where("kind = 'component'").withColumn("__k", F.row_number().over(last)).where("__k = 1")
    parts = parts.select("run_id", "name", F.col("value").alias("license"), F.row_number().over(Window.partitionBy("run_id").orderBy("ts", "name")).alias("ordinal"))
    licence = with_default_license(about, effective_license(parts, "run_id"), "run_id")
    listed = parts.groupBy("run_id").agg(F.transform(F.array_sort(F.collect_list(F.struct("ordinal", "name", "license"))), lambda c: F.struct(c["name"].alias("name"), c["license"].alias("license"))).alias("components"))
    skips = events.where("kind = 'skip'").groupBy("run_id").agg(F.transform(F.array_sort(F.collect_list(F.struct("ts", "name", "value"))), lambda s: F.struct(s["name"].alias("file"), s["value"].alias("reason"), s["ts"].cast("string").alias("timestamp"))).alias("skipped_files_detail"))
    detail = F.struct(*(F.col(c) for c in licence.columns if c != "run_id"))
    whole = run_totals(events).join(about, "run_id").join(licence.select("run_id", detail.alias("license_detail")), "run_id").join(listed, "run_id", "left").join(skips, "run_id", "left")
    said = lambda key: F.get_json_object("about", f"$.{key}")
    record = F.struct(
        F.lit(SCHEMA_VERSION).alias("schema_version"), said("program").alias("program"), said("version").alias("tool_version"), said("image").alias("docker_image"), said("python").alias("python_version"), "run_id",
        F.col("license_detail.effective_license").alias("license"), "license_detail", F.coalesce("components", F.array().cast("array<struct<name:string,license:string>>")).alias("components"),
        F.col("start").cast("string").alias("start_time"), F.col("end").cast("string").alias("end_time"), F.round("seconds", 3).alias("duration_seconds"), F.parse_json(said("config")).alias("config"),
        F.struct(F.col("inputs").alias("input_files_total"), F.col("processed").alias("successfully_processed"), F.col("skipped").alias("skipped_files"), F.col("outputs").alias("output_counts_by_type"), F.col("per_minute").alias("performance_per_minute")).alias("statistics"),
        F.coalesce("skipped_files_detail", F.array().cast("array<struct<file:string,reason:string,timestamp:string>>")).alias("skipped_files_detail"),
    )
    return whole.select("run_id", F.to_json(record).alias("json"))
