"""The registered queries of this package and their SQL."""

from __future__ import annotations

from pyspark.sql import DataFrame, SparkSession
from pyspark.sql import functions as F

from quire.llm import license_scan
from quire.llm.common import table
from quire.llm.phrases import PHRASES_SQL
from quire.llm.source_audit import AUDIT_SQL


def op1_simhash(spark: SparkSession, sf_dir: str) -> DataFrame:
    from quire.llm.simhash import near_duplicates

    return near_duplicates(table(spark, sf_dir, "documents"))


def op2_license_scan(spark: SparkSession, sf_dir: str) -> DataFrame:
    from quire.llm.license_scan import scan_licenses

    return scan_licenses(table(spark, sf_dir, "documents"))


def op3_line_dedup(spark: SparkSession, sf_dir: str) -> DataFrame:
    from quire.llm.line_templates import dedup_lines

    return dedup_lines(table(spark, sf_dir, "documents").select("doc_id", "text"))


def op4_secrets(spark: SparkSession, sf_dir: str) -> DataFrame:
    from quire.llm.secrets import BASE, find_secrets

    def joined(spans, kinds=None):
        text = lambda s: F.concat_ws(":", s["kind"], s["start"].cast("string"), s["end"].cast("string"))
        return F.array_join(F.transform(spans, text), ",")

    found = find_secrets(table(spark, sf_dir, "documents"))
    count = lambda kind: F.size(F.filter("base", lambda s: s["kind"] == kind)).cast("bigint")
    kinds = F.array(*(F.lit(kind) for kind, *_ in BASE))
    placed = F.transform("spans", lambda s: F.struct(s["start"].alias("start"), ((F.array_position(kinds, s["kind"]) + len(BASE)) % (len(BASE) + 1)).alias("listed"), s["end"].alias("end"), s["kind"].alias("kind")))
    order = F.array_sort(placed)  # by start, then kind as listed, the method's own kinds last
    return found.select(
        "doc_id",
        count("assign").alias("n_assign"),
        count("access").alias("n_access"),
        count("hex").alias("n_hex"),
        F.sha2(joined(F.col("base")), 256).alias("base_sha256"),
        joined(order).alias("spans"),
    )


def op5_packing(spark: SparkSession, sf_dir: str) -> DataFrame:
    import public_tokenizers

    from quire.llm.packing import pack

    return pack(table(spark, sf_dir, "documents"), public_tokenizers.path("word_bpe_49k.json"))


def op6_ppm_scoring(spark: SparkSession, sf_dir: str) -> DataFrame:
    from quire.llm.ppm import language_model_scores

    return language_model_scores(table(spark, sf_dir, "documents"))


def op7_decontamination(spark: SparkSession, sf_dir: str) -> DataFrame:
    from quire.llm.decontaminate import decontaminate

    found = decontaminate(table(spark, sf_dir, "documents"), table(spark, sf_dir, "benchmark"))
    return found.select("doc_id", "n_words", "n_hit", "n_items", F.sha2(F.array_join("items", ","), 256).alias("items_sha256"), "contaminated")


def op8_language_id(spark: SparkSession, sf_dir: str) -> DataFrame:
    from quire.llm.langid import identify

    return identify(table(spark, sf_dir, "documents"))


def op9_ogg(spark: SparkSession, sf_dir: str) -> DataFrame:
    from quire.llm.ogg import media_digests

    return media_digests(table(spark, sf_dir, "documents"))


def op10_toxicity(spark: SparkSession, sf_dir: str) -> DataFrame:
    from quire.llm.toxicity import toxicity

    return toxicity(table(spark, sf_dir, "documents"), table(spark, sf_dir, "labels"))


def op11_suffix_dedup(spark: SparkSession, sf_dir: str) -> DataFrame:
    from quire.llm.suffix_dedup import passage_digests

    return passage_digests(table(spark, sf_dir, "documents"))


def op12_phrases(spark: SparkSession, sf_dir: str) -> DataFrame:
    from quire.llm.phrases import mine_phrases

    return mine_phrases(table(spark, sf_dir, "documents"))


def op13_source_audit(spark: SparkSession, sf_dir: str) -> DataFrame:
    from quire.llm.source_audit import audit_sources

    return audit_sources(table(spark, sf_dir, "documents"))


QUERIES = {
    f.__name__: f
    for f in (
        *(op1_simhash, op2_license_scan, op3_line_dedup, op4_secrets, op5_packing, op6_ppm_scoring, op7_decontamination),
        *(op8_language_id, op9_ogg, op10_toxicity, op11_suffix_dedup, op12_phrases, op13_source_audit),
    )
}

_W = r"[^\x00-\x2F\x3A-\x60\x7B-\x7F]+"

SQL: dict[str, str] = {"op2_license_scan": license_scan.brute_force_sql(), "op12_phrases": PHRASES_SQL, "op13_source_audit": AUDIT_SQL}

SQL["op7_decontamination"] = rf"""
WITH d AS (SELECT row_number() OVER () AS r, doc_id, regexp_extract_all(translate(coalesce(text, ''), 'ABCDEFGHIJKLMNOPQRSTUVWXYZ', 'abcdefghijklmnopqrstuvwxyz'), '{_W}') AS w FROM documents),
b AS (SELECT item_id, regexp_extract_all(translate(coalesce(text, ''), 'ABCDEFGHIJKLMNOPQRSTUVWXYZ', 'abcdefghijklmnopqrstuvwxyz'), '{_W}') AS w FROM benchmark),
p AS (SELECT DISTINCT item_id, least(10, len(w)) AS m, array_to_string(w[i:i + least(10, len(w)) - 1], ' ') AS x
      FROM (SELECT item_id, w, unnest(range(1, len(w) - least(10, len(w)) + 2)) AS i FROM b WHERE len(w) > 0)),
sizes AS (SELECT DISTINCT m FROM p),
win AS (SELECT r, m, i, array_to_string(w[i:i + m - 1], ' ') AS x FROM (SELECT r, w, m, unnest(range(1, len(w) - m + 2)) AS i FROM d, sizes WHERE len(w) >= m)),
occ AS (SELECT r, i, win.m, item_id FROM win JOIN p ON p.m = win.m AND p.x = win.x),
hit AS (SELECT r, count(DISTINCT k) AS n_hit FROM (SELECT r, unnest(range(i, i + m)) AS k FROM occ) GROUP BY r),
it AS (SELECT r, count(*) AS n_items, string_agg(s, ',' ORDER BY s) AS items FROM (SELECT DISTINCT r, CAST(item_id AS VARCHAR) AS s FROM occ) GROUP BY r)
SELECT doc_id, CAST(len(w) AS BIGINT) AS n_words, CAST(coalesce(n_hit, 0) AS BIGINT) AS n_hit, CAST(coalesce(n_items, 0) AS BIGINT) AS n_items,
       sha256(coalesce(items, '')) AS items_sha256, coalesce(n_hit, 0) > 0 AS contaminated
FROM d LEFT JOIN hit USING (r) LEFT JOIN it USING (r)
"""
