"""Run logs, licences and layered configuration."""

from __future__ import annotations

from pyspark.sql import Column, DataFrame, SparkSession, Window
from pyspark.sql import functions as F

#: How restrictive a licence is.
LICENSE_RANK = {
    "Public Domain": 0, "CC0": 0, "MIT": 1, "Apache-2.0": 1, "BSD-3-Clause": 1, "MPL 2.0": 2, "LGPL-3.0": 3, "GPL-3.0": 4, "AGPL-3.0": 4,
    "CC BY 4.0": 1, "CC BY-SA 4.0": 3, "CC BY-NC 4.0": 5, "CC BY-NC-SA 4.0": 6, "glm-4": 5,
}
SHARE_ALIKE = ("CC BY-SA 4.0", "CC BY-NC-SA 4.0", "GPL-3.0", "AGPL-3.0", "LGPL-3.0", "MPL 2.0")
NON_COMMERCIAL = ("CC BY-NC 4.0", "CC BY-NC-SA 4.0", "glm-4")

#: Spellings of licence names, lower-cased.
LICENSE_ALIASES = {
    "apache 2.0": "Apache-2.0", "apache-2.0": "Apache-2.0", "apache license 2.0": "Apache-2.0", "mit": "MIT", "mit license": "MIT",
    "mpl-2.0": "MPL 2.0", "mpl 2.0": "MPL 2.0", "gpl-3.0": "GPL-3.0", "gpl 3.0": "GPL-3.0", "gpl-3.0 license": "GPL-3.0",
    "agpl-3.0": "AGPL-3.0", "agpl 3.0": "AGPL-3.0", "agpl-3.0 license": "AGPL-3.0", "agplv3": "AGPL-3.0", "gnu affero general public license v3.0": "AGPL-3.0",
    "cc0": "CC0", "public domain": "Public Domain", "cc by 4.0": "CC BY 4.0", "cc-by-4.0": "CC BY 4.0", "cc by-sa 4.0": "CC BY-SA 4.0",
    "cc by-nc 4.0": "CC BY-NC 4.0", "cc-by-nc-4.0": "CC BY-NC 4.0", "attribution-noncommercial 4.0 international": "CC BY-NC 4.0",
    "cc by-nc-sa 4.0": "CC BY-NC-SA 4.0", "cc-by-nc-sa-4.0": "CC BY-NC-SA 4.0", "attribution-noncommercial-sharealike 4.0 international": "CC BY-NC-SA 4.0",
    "glm-4": "glm-4", "glm4": "glm-4", "glm-4 license": "glm-4",
}


def normalise_license(name: Column) -> Column:
    """The canonical name; unknown ones as they are, without outer spaces."""
    aliases = F.create_map(*(F.lit(x) for pair in LICENSE_ALIASES.items() for x in pair))
    key = F.trim(F.coalesce(name, F.lit("")))
    return F.coalesce(F.try_element_at(aliases, F.lower(key)), key)


def license_rank(name: Column) -> Column:
    """The rank of a canonical name; an unknown one counts as most restrictive."""
    ranks = F.create_map(*(F.lit(x) for pair in LICENSE_RANK.items() for x in pair))
    return F.coalesce(F.try_element_at(ranks, name), F.lit(max(LICENSE_RANK.values())))


def effective_license(components: DataFrame, by: str, name: str = "name", license: str = "license", ordinal: str = "ordinal") -> DataFrame:
    """Per ``by`` the most restrictive licence of its components, ties going to the first.

    ``determined_by``: all components of that rank, in order; ``unknown``: unrecognised names. For an
    owner without components see ``with_default_license``.
    """
    norm = components.withColumn("__l", normalise_license(F.col(license))).withColumn("__r", license_rank(F.col("__l")))
    known = F.col("__l").isin(*LICENSE_RANK)
    out = norm.groupBy(by).agg(
        F.max_by("__l", F.struct("__r", -F.col(ordinal))).alias("effective_license"),
        F.max("__r").alias("__top"),
        F.array_sort(F.collect_list(F.struct(F.col(ordinal).alias("o"), F.col(name).alias("n"), F.col("__r").alias("r")))).alias("__all"),
        F.array_sort(F.collect_set(F.when(~known, F.col("__l")))).alias("unknown"),
        F.count("*").alias("n_components"),
    )
    return out.select(
        by,
        "effective_license",
        F.col("effective_license").isin(*NON_COMMERCIAL).alias("is_non_commercial"),
        F.col("effective_license").isin(*SHARE_ALIKE).alias("is_share_alike"),
        F.transform(F.filter("__all", lambda c: c["r"] == F.col("__top")), lambda c: c["n"]).alias("determined_by"),
        "unknown",
        "n_components",
    )


def union_components(components: DataFrame, by: str, name: str = "name", license: str = "license", ordinal: str = "ordinal") -> DataFrame:
    """The first of equal (name, licence) components per ``by``."""
    norm = components.withColumn(license, normalise_license(F.col(license)))
    w = Window.partitionBy(by, name, license).orderBy(ordinal)
    return norm.withColumn("__n", F.row_number().over(w)).where("__n = 1").drop("__n")


def with_default_license(owners: DataFrame, effective: DataFrame, by: str, default: str = "CC BY-NC 4.0") -> DataFrame:
    """All owners, those without components under ``default`` and flagged by it."""
    code = F.coalesce("effective_license", F.lit(default))
    flags = {"is_non_commercial": code.isin(*NON_COMMERCIAL), "is_share_alike": code.isin(*SHARE_ALIKE)}
    met = owners.select(by).distinct().join(effective, by, "left").withColumn("__none", F.col("effective_license").isNull())
    met = met.withColumns({c: F.when(F.col("__none"), flags[c]).otherwise(F.col(c)) for c in flags if c in effective.columns} | {"effective_license": code})
    return met.drop("__none")


def run_statistics(events: DataFrame, by: str = "run_id") -> DataFrame:
    """Per run: successes, skips, errors, seconds and successes a minute.

    ``events``: run, ``status`` (ok, skip, error) and ``ts``.
    """
    seconds = (F.unix_micros(F.max("ts").cast("timestamp")) - F.unix_micros(F.min("ts").cast("timestamp"))) / 1_000_000
    n = lambda s: F.count_if(F.col("status") == s)
    out = events.groupBy(by).agg(n("ok").alias("processed"), n("skip").alias("skipped"), n("error").alias("errors"), seconds.alias("seconds"))
    return out.withColumn("per_minute", F.coalesce(F.round(F.try_divide(F.col("processed"), F.col("seconds") / 60), 4), F.lit(0.0)))


def merge_runs(stages: DataFrame, by: str = "pipeline", ordinal: str = "stage") -> DataFrame:
    """Stages of a pipeline as one run: inputs of the first, successes of the last, sums, and the time span."""
    return stages.groupBy(by).agg(
        F.min_by("inputs", ordinal).alias("inputs"),
        F.max_by("processed", ordinal).alias("processed"),
        F.sum("skipped").alias("skipped"),
        F.sum("seconds").alias("seconds"),
        F.min("start_time").alias("start_time"),
        F.max("end_time").alias("end_time"),
        F.min(F.when(F.coalesce("tool_version", F.lit("")) != "", F.struct(F.col(ordinal).alias("o"), F.col("tool_version").alias("v"))))["v"].alias("tool_version"),
        F.count("*").alias("n_stages"),
    )


def output_counts(stages: DataFrame, by: str = "pipeline", counts: str = "counts") -> DataFrame:
    """Outputs by type, summed over stages; ``counts`` is a map column."""
    return stages.select(by, F.explode(counts).alias("type", "n")).groupBy(by, "type").agg(F.sum("n").alias("n"))


def migrate_run_logs(logs: DataFrame) -> DataFrame:
    """Version 1 logs as version 2: an empty image name is added; newer majors are refused."""
    major = F.split_part(F.coalesce("schema_version", F.lit("1.0")), F.lit("."), F.lit(1)).cast("int")
    known = logs.withColumn("schema_version", F.when(major > 2, F.raise_error(F.lit("run log is newer than this reader"))).otherwise(F.lit("2.0")))
    image = F.coalesce("docker_image", F.lit("")) if "docker_image" in logs.columns else F.lit("")
    return known.withColumn("docker_image", image)


def resolve_config(spark: SparkSession, config: dict, model: dict, defaults: dict) -> DataFrame:
    """Parameters with value and source: the configuration's, else the model's (null included), else the default."""
    rows = []
    for key in sorted({*config, *model, *defaults}):
        for source, layer in (("config", config), ("model", model), ("default", defaults)):
            if key in layer:
                rows.append((key, None if layer[key] is None else str(layer[key]), source))
                break
    return spark.createDataFrame(rows, "key string, value string, source string")


def offload_gb(footprint: Column, vram: Column, utilisation: Column, parallel: Column, ram: Column, overhead: float = 4.0, margin: float = 2.0, reserve: float = 24.0) -> Column:
    """Gigabytes of weights that don't fit the cards; 0 if they do, null where they exceed the host's memory too."""
    spill = F.ceil(footprint - (vram * utilisation - overhead) * parallel + margin)
    need = F.when(spill <= 0, F.lit(0)).otherwise(spill)
    return F.when(need <= ram - reserve, need)
