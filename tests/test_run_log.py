import json
from datetime import datetime, timedelta

import pytest
from pyspark.sql import functions as F

from quire.operators import provenance
from quire.operators.run_log import RunLog
from tests.conftest import frame


def clock(step=60):
    at = [datetime(2024, 5, 1, 12)]

    def tick():
        at[0] += timedelta(seconds=step)
        return at[0]

    return tick


def counting(spark, path, rows):
    """Rows whose status is worked out by a function that writes a line for each call."""

    @F.udf("string")
    def work(status):
        with open(path, "a") as f:
            f.write("x\n")
        return status

    return lambda: frame(spark, rows, "file string, s string, why string").repartition(2).withColumn("status", work("s"))


def step(log, name, make, out):
    status = F.col("status")
    return log.write(name, make, str(out / name), {"json": status == "ok", "pages": status.isin("ok", "half")}, documents=status == "ok", skipped=status == "skip", reason=F.col("why"))


def calls(path):
    return len(path.read_text().splitlines()) if path.exists() else 0


A = [("a", "ok", None), ("b", "skip", "too small"), ("c", "half", None), ("d", None, None)]
B = [("e", "ok", None), ("f", "ok", None), ("g", "skip", None)]


def test_a_run_that_is_broken_off_reads_as_one_run(spark, tmp_path):
    log = RunLog(spark, str(tmp_path / "log"), "enrich", {"n": 1, "deep": {"x": [1, None]}}, version="3", components={"tool": "MIT"}, clock=clock())
    step(log, "one", counting(spark, tmp_path / "n1", A), tmp_path)
    with pytest.raises(Exception, match="broken"):
        step(log, "two", lambda: frame(spark, B, "file string, s string, why string").withColumn("status", F.raise_error(F.lit("broken")).cast("string")), tmp_path)
    again = RunLog.of_state(spark, log.state())
    assert again.run_id == log.run_id and again.done("one") and not again.done("two")
    assert step(again, "one", lambda: pytest.fail("made twice"), tmp_path).columns == ["file", "s", "why", "status"]
    assert step(again, "two", counting(spark, tmp_path / "n2", B), tmp_path).count() == 3
    assert (calls(tmp_path / "n1"), calls(tmp_path / "n2")) == (4, 3)  # one pass over each
    got = again.statistics().first()
    assert (got["inputs"], got["processed"], got["skipped"], got["outputs"]) == (5, 3, 2, {"json": 3, "pages": 4})


def test_a_step_that_was_written_but_not_logged_counts_once(spark, tmp_path, monkeypatch):
    log = RunLog(spark, str(tmp_path / "log"), "enrich", clock=clock())
    with monkeypatch.context() as m:
        m.setattr(log, "_append", lambda *a: (_ for _ in ()).throw(RuntimeError("lost")))
        with pytest.raises(RuntimeError):
            step(log, "one", counting(spark, tmp_path / "n", A), tmp_path)
    step(log, "one", counting(spark, tmp_path / "n", A), tmp_path)
    assert log.statistics().first()["outputs"] == {"json": 1, "pages": 2}


def test_the_record(spark, tmp_path):
    log = RunLog(spark, str(tmp_path / "log"), "enrich", {"deep": {"x": [1, None]}}, components={"tool": "MIT", "model": "CC BY-NC 4.0"}, image="img", clock=clock())
    log.skip("z", "no text")
    log.success("csv", 7)
    log.component("tool", "Apache-2.0")
    record = json.loads(log.finalise().first()["json"])
    assert record["license"] == "CC BY-NC 4.0" and record["components"] == [{"name": "model", "license": "CC BY-NC 4.0"}, {"name": "tool", "license": "Apache-2.0"}]
    assert record["config"] == {"deep": {"x": [1, None]}} and record["docker_image"] == "img" and record["schema_version"] == "2.0"
    stats = record["statistics"]
    assert (stats["input_files_total"], stats["successfully_processed"], stats["skipped_files"], stats["output_counts_by_type"]) == (8, 7, 1, {"csv": 7})
    assert stats["performance_per_minute"] == {"csv": round(7 / (record["duration_seconds"] / 60), 4)}
    assert [(s["file"], s["reason"]) for s in record["skipped_files_detail"]] == [("z", "no text")]
    written = spark.read.text(f"{tmp_path}/log/logs/{log.run_id}_enrich").first()[0]
    assert json.loads(written) == record
    with pytest.raises(RuntimeError):
        log.finalise()
    logs = spark.read.json(f"{tmp_path}/log/logs/*")
    assert provenance.migrate_run_logs(logs).first()["schema_version"] == "2.0"


def test_totals_given_at_the_end_win_and_runs_stay_apart(spark, tmp_path):
    one = RunLog(spark, str(tmp_path / "log"), "a", clock=clock())
    two = RunLog(spark, str(tmp_path / "log"), "b", clock=clock())
    one.success("json", 3)
    two.success("json", 5)
    one.finalise(input_total=10, processed_total=4)
    got = {r["run_id"]: (r["inputs"], r["processed"]) for r in one.statistics().collect() + two.statistics().collect()}
    assert got == {one.run_id: (10, 4), two.run_id: (5, 5)}
    empty = RunLog(spark, str(tmp_path / "log2"), "c", clock=clock())
    assert empty.statistics().first()["processed"] == 0
    assert json.loads(empty.finalise().first()["json"])["license"] == "CC BY-NC 4.0"


def test_old_logs_are_read_and_newer_ones_refused(spark):
    old = frame(spark, [("1.0", None), (None, "x")], "schema_version string, docker_image string")
    assert [(r[0], r[1]) for r in provenance.migrate_run_logs(old).collect()] == [("2.0", ""), ("2.0", "x")]
    with pytest.raises(Exception, match="newer"):
        provenance.migrate_run_logs(frame(spark, [("3.1",)], "schema_version string")).collect()
