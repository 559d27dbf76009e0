"""Line, page and entity tables from CSV, TSV and text files."""

from __future__ import annotations

from pyspark.sql import DataFrame, SparkSession, Window
from pyspark.sql import functions as F

from quire.functions.text import best_effort_int
from quire.operators.stratify import CATEGORIES

LINE_COLUMNS = ("file", "page_num", "categ", "quality_score")


def _csv(spark: SparkSession, path: str, **options) -> DataFrame:
    df = spark.read.options(header=True, multiLine=True, escape='"', recursiveFileLookup=True, **options).csv(path)
    return df.toDF(*(c.strip() for c in df.columns))


def read_line_csv(spark: SparkSession, path: str) -> DataFrame:
    """Line rows of CSV files with a header; every value read as text, then typed.

    ``page``/``line`` are taken for ``page_num``/``line_num``; a number that can't be read is 0, a
    score that can't be read null. ``row_idx`` is the row's order in its file (a multi-line file is one
    partition). ``file`` is the row's own, else the file's name.
    """
    df = _csv(spark, path).select("*", F.col("_metadata.file_path").alias("__path"), F.monotonically_increasing_id().alias("__n"))
    has = set(df.columns)
    pick = lambda *names: F.coalesce(*(F.col(n) for n in names if n in has), F.lit(None).cast("string"))
    score = F.nanvl(pick("quality_score").try_cast("double"), F.lit(None).cast("double"))
    name = F.regexp_replace(F.regexp_extract("__path", r"([^/]+)$", 1), r"\.csv$", "")
    return df.select(
        F.coalesce(pick("file", "file_id"), name).alias("file"),
        best_effort_int(pick("page_num", "page")).alias("page_num"),
        best_effort_int(pick("line_num", "line")).alias("line_num"),
        F.row_number().over(Window.partitionBy("__path").orderBy("__n")).cast("bigint").alias("row_idx"),
        F.trim(F.coalesce(pick("categ"), F.lit(""))).alias("categ"),
        score.alias("quality_score"),
        F.coalesce(pick("text"), F.lit("")).alias("text"),
        pick("lang").alias("lang"),
    )


def read_line_directory(spark: SparkSession, paths: list[str]) -> DataFrame:
    """The line tables among the files, joined end to end; files without the four columns are left out.

    Only headers are looked at to choose. Raises if no file is usable.
    """
    usable = [p for p in paths if set(LINE_COLUMNS) <= set(_csv(spark, p).columns)]
    if not usable:
        raise ValueError("no file has the columns " + ", ".join(LINE_COLUMNS))
    out = None
    for p in usable:
        one = _csv(spark, p).select(*LINE_COLUMNS)
        out = one if out is None else out.unionByName(one)
    score = F.nanvl(F.col("quality_score").try_cast("double"), F.lit(None).cast("double"))
    return out.select("file", best_effort_int(F.col("page_num")).alias("page_num"), "categ", score.alias("quality_score"))


def read_page_stats(spark: SparkSession, path: str) -> DataFrame:
    """Page statistics; missing category columns are 0, the three key columns must be there."""
    df = _csv(spark, path)
    missing = {"file", "page_num", "avg_quality_score"} - set(df.columns)
    if missing:
        raise ValueError(f"page statistics lack {sorted(missing)}")
    score = F.nanvl(F.col("avg_quality_score").try_cast("double"), F.lit(None).cast("double"))
    counts = [best_effort_int(F.col(f"`{c}`")).alias(c) if c in df.columns else F.lit(0).alias(c) for c in CATEGORIES]
    return df.select("file", best_effort_int(F.col("page_num")).alias("page_num"), score.alias("avg_quality_score"), *counts)


def read_manifest(spark: SparkSession, path: str, split: str | None = None) -> DataFrame:
    """A sample manifest: trimmed values, integral pages; a tier named ``overall`` is refused when rows are read."""
    df = _csv(spark, path)
    df = df.select(*(F.trim(F.col(f"`{c}`")).alias(c) for c in df.columns))
    checked = F.when(F.col("tier") == "overall", F.raise_error(F.lit("a tier can't be called overall"))).otherwise(F.col("tier"))
    df = df.withColumn("tier", checked).withColumn("page_num", F.col("page_num").cast("double").cast("int"))
    return df.where(F.col("split") == split) if split else df


def read_page_texts(spark: SparkSession, root: str) -> DataFrame:
    """``file``, ``page_num``, ``text`` of ``<file>/<file>-<page>.txt`` or ``<file>-<page>.txt``; the nested one wins."""
    df = spark.read.option("recursiveFileLookup", True).option("pathGlobFilter", "*.txt").text(root, wholetext=True)
    path = F.col("_metadata.file_path")
    parts = df.select(path.alias("path"), F.col("value").alias("text")).select(
        F.regexp_extract("path", r"([^/]+)-\d+\.txt$", 1).alias("file"), F.regexp_extract("path", r"-(\d+)\.txt$", 1).try_cast("int").alias("page_num"), "path", "text"
    )
    w = Window.partitionBy("file", "page_num").orderBy(F.size(F.split("path", "/")).desc(), "path")
    return parts.where("page_num is not null").withColumn("__r", F.row_number().over(w)).where("__r = 1").select("file", "page_num", "text")


def read_entities(spark: SparkSession, root: str, suffix: str = ".entities.tsv") -> DataFrame:
    """``file``, ``page_num``, ``type``, ``text`` of tab-separated entity files; a line without a tab is an error.

    Blank lines and lines that start with ``#`` are comments. Every file with the suffix counts as a
    page, so one without entities gives a row with nulls.
    """
    df = spark.read.option("recursiveFileLookup", True).option("pathGlobFilter", f"*{suffix}").text(root, wholetext=True)
    end = suffix.replace(".", r"\.")
    path = F.col("_metadata.file_path")
    lines = df.select(
        F.regexp_extract(path, rf"([^/]+)-\d+{end}$", 1).alias("file"), F.regexp_extract(path, rf"-(\d+){end}$", 1).try_cast("int").alias("page_num"), F.posexplode(F.split("value", r"\r?\n")).alias("n", "line")
    )
    data = lines.where((F.trim("line") != "") & ~F.col("line").startswith("#"))
    cells = F.split("line", "\t", 2)
    bad = F.raise_error(F.concat(F.lit("no tab in line "), (F.col("n") + 1).cast("string"), F.lit(" of "), F.col("file")))
    rows = data.select("file", "page_num", F.when(F.size(cells) == 2, F.trim(cells[0])).otherwise(bad).alias("type"), F.trim(F.get(cells, F.lit(1))).alias("text"))
    return lines.select("file", "page_num").distinct().join(rows, ["file", "page_num"], "left")


def read_vocabulary(spark: SparkSession, path: str) -> DataFrame:
    """Terms of a flat vocabulary file: a JSON object with ``terms``."""
    return spark.read.option("multiLine", True).json(path).select(F.explode("terms").alias("t")).select("t.*")


def read_json_documents(spark: SparkSession, path: str, newest_major: int = 1) -> DataFrame:
    """Document records as VARIANT with ``doc_id`` and ``schema_version``; a newer major is an error."""
    whole = spark.read.option("recursiveFileLookup", True).text(path, wholetext=True).select(F.parse_json("value").alias("record"), F.col("_metadata.file_path").alias("path"))
    version = F.coalesce(F.try_variant_get("record", "$.schema_version", "string"), F.lit("1.0"))
    major = F.split_part(version, F.lit("."), F.lit(1)).try_cast("int")
    checked = F.when(major > newest_major, F.raise_error(F.concat(F.lit("record version is too new: "), version))).otherwise(version)
    return whole.select(F.try_variant_get("record", "$.doc_id", "string").alias("doc_id"), checked.alias("schema_version"), "record", "path")
