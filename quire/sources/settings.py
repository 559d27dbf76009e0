"""Configuration files as rows: sections carried forward over the lines, then key and value."""

from __future__ import annotations

from pyspark.sql import Column, DataFrame, SparkSession, Window
from pyspark.sql import functions as F

from quire.functions.values import unquote

#: A configuration is small; a file with more settings isn't one.
SETTINGS = 10_000
BOOLEANS = {"true": ("1", "yes", "true", "on"), "false": ("0", "no", "false", "off")}


def read_settings(spark: SparkSession, path: str) -> DataFrame:
    """``file``, ``line``, ``section``, ``key``, ``value``, ``source`` of INI files and of plain KEY=VALUE files.

    A file with a section header is an INI file: keys are folded to lower case, ``=`` and ``:`` part
    key and value, ``;`` and ``#`` begin comments, and indented lines go on with the value before. Any
    other is plain: only ``=`` parts, keys keep their case, one pair of quotes around a value goes and
    section is null. Lines without a separator are no settings. Of a key that comes again in its
    section, the last value counts. ``source`` is the file's name.
    """
    whole = spark.read.text(path, wholetext=True).select(F.col("_metadata.file_path").alias("file"), F.col("_metadata.file_name").alias("source"), "value")
    lines = whole.select("file", "source", F.posexplode(F.split("value", "\r?\n")).alias("line", "raw"))
    bare = F.trim(F.regexp_replace("raw", r"^\s+|\s+$", ""))
    header = F.nullif(F.regexp_extract(bare, r"^\[([^\]]+)\]$", 1), F.lit(""))
    along = Window.partitionBy("file").orderBy("line")
    upto = along.rowsBetween(Window.unboundedPreceding, 0)
    rows = lines.select("*", bare.alias("bare"), header.alias("header"))
    rows = rows.withColumn("ini", F.max(F.col("header").isNotNull()).over(Window.partitionBy("file"))).withColumn("section", F.last("header", True).over(upto))
    comment = (F.col("bare") == "") | F.col("bare").startswith("#") | (F.col("ini") & F.col("bare").startswith(";"))
    rows = rows.where(F.col("header").isNull() & ~comment & (~F.col("ini") | F.col("section").isNotNull()))
    begins = ~F.col("ini") | ~F.col("raw").rlike(r"^\s")
    rows = rows.withColumn("setting", F.sum(begins.cast("int")).over(Window.partitionBy("file", "section").orderBy("line").rowsBetween(Window.unboundedPreceding, 0)))
    text = F.array_join(F.transform(F.array_sort(F.collect_list(F.struct("line", "bare"))), lambda x: x["bare"]), "\n")
    found = rows.groupBy("file", "source", "ini", "section", "setting").agg(F.min("line").alias("line"), text.alias("text"))
    at = F.when(F.col("ini"), F.regexp_instr("text", F.lit("[=:]"))).otherwise(F.locate("=", F.col("text")))
    key, value = F.trim(F.substr("text", F.lit(1), at - 1)), F.regexp_replace(F.substr("text", at + 1), r"^\s+|\s+$", "")
    cut = found.where(at > 0).select("file", "line", "section", F.when(F.col("ini"), F.lower(key)).otherwise(key).alias("key"), F.when(F.col("ini"), value).otherwise(unquote(value)).alias("value"), "source")
    last = Window.partitionBy("file", "section", "key").orderBy(F.desc("line"))
    return cut.withColumn("__r", F.row_number().over(last)).where("__r = 1").drop("__r")


def setting_values(settings: DataFrame, section: str | None = None) -> dict[str, str]:
    """The settings of one section, or of a plain file, on the driver, as ``resolve_config`` takes them."""
    mine = settings.where(F.col("section").eqNullSafe(F.lit(section).cast("string")))
    rows = mine.select("key", "value").limit(SETTINGS + 1).collect()
    if len(rows) > SETTINGS:
        raise ValueError(f"more than {SETTINGS} settings")
    return {r["key"]: r["value"] for r in rows}


def typed(value: Column, kind: str) -> Column:
    """A setting as ``int``, ``double`` or ``boolean`` (1/0, yes/no, true/false, on/off); text that is none raises, a null stays."""
    if kind == "boolean":
        low = F.lower(F.trim(value))
        out = F.when(low.isin(*BOOLEANS["true"]), True).when(low.isin(*BOOLEANS["false"]), False)
    else:
        out = F.trim(value).try_cast("bigint" if kind == "int" else kind)
    return F.when(value.isNotNull() & out.isNull(), F.raise_error(F.concat(F.lit(f"no {kind}: "), value))).otherwise(out)
