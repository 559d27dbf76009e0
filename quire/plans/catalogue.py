"""The library's own registered queries and the SQL each must agree with."""

from __future__ import annotations

import json
import uuid
from collections.abc import Callable

from pyspark.sql import DataFrame, SparkSession, Window
from pyspark.sql import functions as F

from quire.functions import text as T
from quire.functions import values as V
from quire.operators import cues, evaluation, layout, lines, provenance, records, run_log, schema_gate, stratify, teitok, vocabulary
from quire.plans import enrich
from quire.session import checkpoint_dir
from quire.sources import markup

QUERIES: dict[str, Callable[[SparkSession, str], DataFrame]] = {}
SQL: dict[str, str] = {}


def query(sql: str | None = None):
    """Register a query under its function's name, with its SQL."""

    def register(f):
        QUERIES[f.__name__] = f
        if sql:
            SQL[f.__name__] = sql
        return f

    return register


def table(spark: SparkSession, sf_dir: str, name: str) -> DataFrame:
    return spark.read.parquet(f"{sf_dir}/{name}.parquet")


# lines of documents ---------------------------------------------------------------------------


def document_lines(docs: DataFrame) -> DataFrame:
    """Documents as lines: five to a page, scored by their share of letters, categorised by rule."""
    cut = docs.select(F.col("doc_id").alias("file"), F.posexplode(F.split("text", "\n")).alias("row_idx", "text"))
    solid = F.length(F.replace(F.col("text"), F.lit(" "), F.lit("")))
    share = F.coalesce(F.try_divide(T.letters(F.col("text")), solid), F.lit(0.0))
    n = F.length("text")
    categ = F.when(solid == 0, "Empty").when(share < 0.5, "Trash").when(n < 30, "Heading").when(n % 7 == 0, "Non-text").when(share < 0.96, "Noisy").otherwise("Clear")
    return cut.select("file", "row_idx", (F.floor(F.col("row_idx") / 5) + 1).cast("int").alias("page_num"), (F.col("row_idx") + 1).alias("line_num"), categ.alias("categ"), share.alias("quality_score"), "text")


_LINES = r"""
raw AS (SELECT doc_id AS file, unnest(range(0, len(s))) AS row_idx, unnest(s) AS text FROM (SELECT doc_id, string_split(text, chr(10)) AS s FROM documents)),
scored AS (SELECT *, length(replace(text, ' ', '')) AS solid, length(regexp_replace(text, '[^\p{L}]', '', 'g')) AS letters FROM raw),
lines AS (SELECT file, row_idx, CAST(row_idx // 5 + 1 AS INT) AS page_num, row_idx + 1 AS line_num, text,
  coalesce(letters / nullif(solid, 0), 0.0) AS quality_score,
  CASE WHEN solid = 0 THEN 'Empty' WHEN coalesce(letters / nullif(solid, 0), 0.0) < 0.5 THEN 'Trash' WHEN length(text) < 30 THEN 'Heading'
       WHEN length(text) % 7 = 0 THEN 'Non-text' WHEN coalesce(letters / nullif(solid, 0), 0.0) < 0.96 THEN 'Noisy' ELSE 'Clear' END AS categ
  FROM scored)"""


def _lines(spark, sf_dir):
    return document_lines(table(spark, sf_dir, "documents"))


@query(
    f"""WITH {_LINES},
e AS (SELECT *, CASE WHEN quality_score < 0.4 THEN 'Trash' WHEN quality_score < 0.7 AND categ <> 'Trash' THEN 'Noisy' ELSE categ END AS categ_effective FROM lines)
SELECT file, CAST(row_idx AS INT) AS row_idx, categ, categ_effective,
  CASE WHEN length(text) = 0 THEN 'empty text' WHEN categ_effective IN ('Empty', 'Trash') THEN 'category'
       WHEN categ_effective = 'Non-text' AND length(text) < 8 THEN 'non-text too short'
       WHEN categ_effective = 'Non-text' AND length(regexp_replace(text, '[^\\p{{L}}]', '', 'g')) / length(text) < 0.4 THEN 'non-text without letters'
       WHEN categ_effective <> 'Non-text' AND length(text) < 3 THEN 'too short' END AS skip_reason FROM e"""
)
def line_quality_filter(spark, sf_dir):
    return lines.quality_filter(_lines(spark, sf_dir)).select("file", "row_idx", "categ", "categ_effective", "skip_reason")


_STATS = f"""{_LINES},
pages AS (SELECT file, page_num, count(*) FILTER (categ = 'Clear') AS "Clear", count(*) FILTER (categ = 'Noisy') AS "Noisy", count(*) FILTER (categ = 'Trash') AS "Trash",
  count(*) FILTER (categ = 'Non-text') AS "Non-text", count(*) FILTER (categ = 'Empty') AS "Empty", avg(quality_score) FILTER (categ IN ('Clear', 'Noisy')) AS avg_quality_score
  FROM lines GROUP BY file, page_num),
stats AS (SELECT *, "Clear" + "Noisy" + "Trash" + "Non-text" + "Empty" AS num_lines FROM pages)"""


@query(f"""WITH {_STATS} SELECT file, page_num, "Clear", "Noisy", "Trash", "Non-text", "Empty", round(avg_quality_score, 9) AS avg_quality_score, num_lines FROM stats""")
def page_category_stats(spark, sf_dir):
    return stratify.page_stats(_lines(spark, sf_dir)).withColumn("avg_quality_score", F.round("avg_quality_score", 9))


_TIERS = f"""{_STATS},
tiers AS (SELECT file, page_num, avg_quality_score, CASE WHEN avg_quality_score IS NULL THEN 'text_poor'
  WHEN avg_quality_score >= 0.965 AND ("Clear" + "Noisy") / nullif(num_lines, 0) >= 0.5 THEN 'clean' WHEN avg_quality_score >= 0.955 THEN 'degraded' ELSE 'hard' END AS tier,
  coalesce(round_even(("Clear" + "Noisy") / nullif(num_lines, 0), 4), 0.0) AS valid_line_ratio FROM stats)"""


def _tiered(spark, sf_dir):
    return stratify.assign_tiers(stratify.page_stats(_lines(spark, sf_dir)), clean_min=0.965, degraded_min=0.955)


@query(f"WITH {_TIERS} SELECT file, page_num, tier, valid_line_ratio FROM tiers")
def difficulty_tiers(spark, sf_dir):
    return _tiered(spark, sf_dir).select("file", "page_num", "tier", "valid_line_ratio")


_MANIFEST = f"""{_TIERS},
sampled AS (SELECT * FROM (SELECT *, row_number() OVER (PARTITION BY tier ORDER BY md5('42|' || file || '|' || page_num), file, page_num) AS r FROM tiers)
  WHERE r <= greatest(1, 200 // (SELECT count(DISTINCT tier) FROM tiers))),
ranked AS (SELECT *, row_number() OVER (PARTITION BY tier ORDER BY md5('43|' || file || '|' || page_num), file, page_num) AS s, count(*) OVER (PARTITION BY tier) AS n FROM sampled),
manifest AS (SELECT file, page_num, tier, CASE WHEN s <= round_even(n * 0.8, 0) THEN 'train' WHEN s <= round_even(n * 0.8, 0) + round_even(n * 0.1, 0) THEN 'dev' ELSE 'test' END AS split FROM ranked)"""


def _manifest(spark, sf_dir):
    return stratify.assign_splits(stratify.stratified_sample(_tiered(spark, sf_dir)))


@query(f"WITH {_MANIFEST} SELECT file, page_num, tier, split FROM manifest")
def stratified_manifest(spark, sf_dir):
    return _manifest(spark, sf_dir).select("file", "page_num", "tier", "split")


@query(
    f"""WITH {_MANIFEST} SELECT tier, count(*) FILTER (split = 'train') AS train, count(*) FILTER (split = 'dev') AS dev, count(*) FILTER (split = 'test') AS test
FROM manifest GROUP BY tier"""
)
def tier_split_crosstab(spark, sf_dir):
    return stratify.tier_split_counts(_manifest(spark, sf_dir))


_SECTION = f"""{_LINES},
sec AS (SELECT *, coalesce(last_value(CASE WHEN categ IN ('Header', 'Heading') THEN trim(text) END IGNORE NULLS)
  OVER (PARTITION BY file ORDER BY row_idx ROWS BETWEEN UNBOUNDED PRECEDING AND 1 PRECEDING), 'Unknown Section') AS section FROM lines),
hd AS (SELECT file, list('[P' || page_num || ' L' || line_num || '] ' || trim(text) ORDER BY row_idx) AS header FROM
  (SELECT *, row_number() OVER (PARTITION BY file ORDER BY row_idx) AS r FROM lines WHERE categ NOT IN ('Empty', 'Trash', 'Non-text')) WHERE r <= 2 GROUP BY file)"""


@query(f"WITH {_SECTION} SELECT file, CAST(row_idx AS INT) AS row_idx, section FROM sec")
def current_section(spark, sf_dir):
    return lines.current_section(_lines(spark, sf_dir)).select("file", "row_idx", "section")


@query(f"WITH {_SECTION} SELECT file, array_to_string(header, chr(10)) AS header FROM hd")
def document_header(spark, sf_dir):
    return lines.document_header(_lines(spark, sf_dir)).select("file", F.array_join("header", "\n").alias("header"))


@query(
    f"""WITH {_SECTION},
near AS (SELECT s.file, s.row_idx, s.section, list(CASE WHEN n.row_idx = s.row_idx THEN '<target_line> >>> [P' || n.page_num || ' L' || n.line_num || '] ' || trim(n.text) || ' </target_line>'
    ELSE '    [P' || n.page_num || ' L' || n.line_num || '] ' || trim(n.text) END ORDER BY n.row_idx) AS parts
  FROM sec s JOIN lines n ON n.file = s.file AND n.row_idx BETWEEN s.row_idx - 2 AND s.row_idx + 2
  WHERE n.row_idx = s.row_idx OR (n.page_num = s.page_num AND n.categ NOT IN ('Empty', 'Trash', 'Non-text')) GROUP BY ALL)
SELECT file, CAST(row_idx AS INT) AS row_idx, CASE WHEN row_idx > 4 THEN array_to_string(list_concat(['--- GLOBAL DOCUMENT HEADER ---'], list_transform(coalesce(header, []), lambda h: '    ' || h)), chr(10)) || chr(10) ELSE '' END
  || '--- CURRENT SECTION: ' || section || ' ---' || chr(10) || '--- LOCAL CONTEXT WINDOW ---' || chr(10) || array_to_string(parts, chr(10)) AS context
FROM near LEFT JOIN hd USING (file)"""
)
def context_window(spark, sf_dir):
    return lines.context_windows(_lines(spark, sf_dir)).select("file", "row_idx", "context")


@query(
    f"""WITH {_LINES}, d AS (SELECT file, row_idx, text, regexp_replace(text, '[^\\p{{L}}]', '', 'g') AS l FROM lines),
h AS (SELECT file, row_idx, length(l) AS letters, length(regexp_replace(text, '[^ìèøïòùÌÈØÏÒÙ¾¼]', '', 'g')) AS hits,
  length(regexp_replace(text, '[^\\p{{L}}ìèøïòùÌÈØÏÒÙ¾¼]', '', 'g')) AS n FROM d)
SELECT file, CAST(row_idx AS INT) AS row_idx, n AS letters, hits, coalesce(1 - hits / nullif(n, 0), 1.0) AS score, (hits >= 2 OR coalesce(1 - hits / nullif(n, 0), 1.0) < 0.9) AS garbage FROM h"""
)
def decode_sanity(spark, sf_dir):
    table_ = dict(zip("ìèøïòùÌÈØÏÒÙ¾¼", "ěčřďňůĚČŘĎŇŮľĽ", strict=True))
    found = _lines(spark, sf_dir).select("file", "row_idx", T.decode_sanity(F.col("text"), table_).alias("s"))
    return found.select("file", "row_idx", F.col("s.letters").cast("bigint").alias("letters"), F.col("s.hits").cast("bigint").alias("hits"), "s.score", "s.garbage")


@query(
    f"""WITH {_LINES}, g AS (SELECT file, CAST(page_num AS INT) AS page, avg(quality_score) AS q, count(*) FILTER (categ = 'Trash') AS n_garbage, count(*) AS n_lines FROM lines GROUP BY file, page_num)
SELECT file, page, round_even(q, 4) AS quality_score, n_garbage, n_lines, CASE WHEN round_even(q, 4) >= 0.9 THEN 'Clear' WHEN round_even(q, 4) >= 0.5 THEN 'Noisy' ELSE 'Trash' END AS quality_band,
  n_garbage > 0 AS needs_ocr, CASE WHEN n_garbage > 0 THEN n_garbage || ' of ' || n_lines || ' lines decode to garbage' END AS needs_ocr_reason FROM g"""
)
def page_quality(spark, sf_dir):
    rows = _lines(spark, sf_dir).select("file", F.col("page_num").alias("page"), F.col("quality_score").alias("score"), F.when(F.col("categ") == "Trash", "Garbage").alias("categ"))
    return layout.page_quality(rows, ("file", "page"))


@query(
    f"""WITH {_LINES}, r AS (SELECT file, row_idx, page_num, categ, trim(text) AS t FROM lines WHERE quality_score >= 0.4 AND length(trim(text)) > 0),
m AS (SELECT *, lag(page_num) OVER (PARTITION BY file ORDER BY row_idx) IS DISTINCT FROM page_num AS turns FROM r)
SELECT file, string_agg(CASE WHEN turns THEN '<!-- page ' || page_num || ' -->' || chr(10) || chr(10) ELSE '' END || CASE WHEN categ IN ('Header', 'Heading') THEN '## ' ELSE '' END || t, chr(10) ORDER BY row_idx) AS markdown FROM m GROUP BY file"""
)
def markdown_render(spark, sf_dir):
    rows = layout.readable(_lines(spark, sf_dir).withColumnRenamed("page_num", "page").withColumn("group_id", F.lit(0)), 0.4)
    return layout.markdown(rows, "file")


# events, orders and other tables --------------------------------------------------------------


@query(
    """WITH e AS (SELECT *, count(*) FILTER (event_type <> 'error' AND event_type <> 'view') OVER w AS island FROM events WINDOW w AS (PARTITION BY user_id ORDER BY ts, event_id)),
r AS (SELECT *, count(*) FILTER (event_type = 'error') OVER (PARTITION BY user_id, island ORDER BY ts, event_id) AS run FROM e),
c AS (SELECT *, count(*) FILTER (run = 3 AND event_type = 'error') OVER (PARTITION BY user_id ORDER BY ts, event_id ROWS BETWEEN UNBOUNDED PRECEDING AND 1 PRECEDING) AS cut FROM r)
SELECT user_id, count(*) FILTER (event_type NOT IN ('error', 'view')) AS processed, count(*) FILTER (event_type = 'error') AS errors, count(*) FILTER (event_type = 'view') AS skipped,
  bool_or(event_type = 'error' AND run >= 3) AS aborted FROM c WHERE cut = 0 GROUP BY user_id"""
)
def error_streak_abort(spark, sf_dir):
    status = F.when(F.col("event_type") == "error", "error").when(F.col("event_type") == "view", "skip").otherwise("ok")
    attempts = table(spark, sf_dir, "events").select("user_id", "ts", "event_id", status.alias("status"))
    return lines.run_status(attempts, 3, "user_id", ("ts", "event_id"))


@query(
    """WITH s AS (SELECT CAST(ts AS DATE) AS day, count(*) FILTER (event_type NOT IN ('error', 'view')) AS processed, count(*) FILTER (event_type = 'view') AS skipped,
  count(*) FILTER (event_type = 'error') AS errors, epoch(max(ts)) - epoch(min(ts)) AS seconds FROM events GROUP BY 1)
SELECT CAST(day AS VARCHAR) AS day, processed, skipped, errors, round(seconds, 3) AS seconds, coalesce(round(processed / nullif(seconds / 60, 0), 4), 0.0) AS per_minute FROM s"""
)
def run_stats(spark, sf_dir):
    status = F.when(F.col("event_type") == "error", "error").when(F.col("event_type") == "view", "skip").otherwise("ok")
    events = table(spark, sf_dir, "events").select(F.to_date("ts").cast("string").alias("day"), "ts", status.alias("status"))
    return provenance.run_statistics(events, "day").withColumn("seconds", F.round("seconds", 3))


@query(
    """WITH st AS (SELECT user_id, CAST(ts AS DATE) AS stage, count(*) AS inputs, count(*) FILTER (event_type = 'purchase') AS processed, count(*) FILTER (event_type = 'view') AS skipped,
  sum(value) AS seconds, min(ts) AS a, max(ts) AS b, min(event_type) AS v FROM events GROUP BY 1, 2)
SELECT user_id AS pipeline, arg_min(inputs, stage) AS inputs, arg_max(processed, stage) AS processed, CAST(sum(skipped) AS BIGINT) AS skipped, round(sum(seconds), 4) AS seconds,
  min(a) AS start_time, max(b) AS end_time, arg_min(v, stage) AS tool_version, count(*) AS n_stages FROM st GROUP BY user_id"""
)
def run_merge_stats(spark, sf_dir):
    stages = (
        table(spark, sf_dir, "events")
        .groupBy(F.col("user_id").alias("pipeline"), F.to_date("ts").alias("stage"))
        .agg(
            F.count("*").alias("inputs"),
            F.count_if(F.col("event_type") == "purchase").alias("processed"),
            F.count_if(F.col("event_type") == "view").alias("skipped"),
            F.sum("value").alias("seconds"),
            F.min("ts").alias("start_time"),
            F.max("ts").alias("end_time"),
            F.min("event_type").alias("tool_version"),
        )
    )
    return provenance.merge_runs(stages).withColumn("seconds", F.round("seconds", 4))


#: Words of a passage's start by which it is found in documents.
KEY_WORDS = 5


def _matches(spark, sf_dir):
    """Benchmark passages next to as many words of a document, at every place where the passage's first words stand."""
    docs = table(spark, sf_dir, "documents").select("doc_id", F.col("text").alias("d"))
    items = table(spark, sf_dir, "benchmark").select("item_id", F.col("text").alias("ref"))
    items = items.withColumn("n", F.size(F.split("ref", " "))).where(F.col("n") >= KEY_WORDS).withColumn("key", F.substring_index("ref", " ", KEY_WORDS))
    # the first words of a passage stand in its document: an equi-join on runs of words, made within the row
    words = docs.select("doc_id", F.explode(F.array(F.split("d", " "))).alias("ws")).where(F.size("ws") >= KEY_WORDS)
    runs = F.transform(F.sequence(F.lit(1), F.size("ws") - KEY_WORDS + 1), lambda i: F.array_join(F.slice("ws", i, KEY_WORDS), " "))
    hits = words.select("doc_id", F.posexplode(runs).alias("place", "key")).join(items, "key").drop("key")
    found = docs.join(hits, "doc_id")  # texts meet the few hits only
    hyp = F.array_join(F.slice(F.split("d", " "), F.col("place") + 1, F.col("n")), " ")
    return found.select("doc_id", "item_id", "place", T.normalize_text(F.col("ref")).alias("ref"), T.normalize_text(hyp).alias("hyp"))


_MATCH = r"""
k AS (SELECT item_id, text AS b, string_split(text, ' ') AS bw, array_to_string(string_split(text, ' ')[1:5], ' ') AS key FROM benchmark WHERE len(string_split(text, ' ')) >= 5),
g AS (SELECT doc_id, w, unnest(range(1, len(w) - 3)) AS i FROM (SELECT doc_id, string_split(text, ' ') AS w FROM documents)),
m AS (SELECT doc_id, item_id, CAST(i - 1 AS INT) AS place, b AS ref, array_to_string(w[i:i + len(bw) - 1], ' ') AS hyp FROM g JOIN k ON array_to_string(w[i:i + 4], ' ') = key),
n AS (SELECT doc_id, item_id, place, trim(regexp_replace(nfc_normalize(ref), '\s+', ' ', 'g')) AS ref, trim(regexp_replace(nfc_normalize(hyp), '\s+', ' ', 'g')) AS hyp FROM m),
"""
# the edit distance there is one of bytes: every different symbol of a pair becomes a byte
_SYMBOLS = """c AS (SELECT *, list_distinct(list_concat(r, h)) AS v FROM w),
p AS (SELECT doc_id, item_id, place, len(r) AS k, len(h) AS q, array_to_string(list_transform(r, lambda x: chr(CAST(list_position(v, x) AS INT))), '') AS a,
  array_to_string(list_transform(h, lambda x: chr(CAST(list_position(v, x) AS INT))), '') AS b FROM c)"""


@query(
    f"""WITH {_MATCH} w AS (SELECT doc_id, item_id, place, string_split(ref, '') AS r, string_split(hyp, '') AS h FROM n), {_SYMBOLS}
SELECT doc_id, item_id, place, levenshtein(a, b) / k AS cer, levenshtein(a, b) / greatest(k, q) AS ned FROM p"""
)
def cer_ned_pairs(spark, sf_dir):
    ref, hyp = F.col("ref"), F.col("hyp")
    return _matches(spark, sf_dir).select("doc_id", "item_id", "place", T.cer(ref, hyp).alias("cer"), T.ned(ref, hyp).alias("ned"))


@query(
    f"""WITH {_MATCH} w AS (SELECT doc_id, item_id, place, string_split(ref, ' ') AS r, string_split(hyp, ' ') AS h FROM n), {_SYMBOLS}
SELECT doc_id, item_id, place, levenshtein(a, b) / k AS wer FROM p"""
)
def wer_pairs(spark, sf_dir):
    return _matches(spark, sf_dir).select("doc_id", "item_id", "place", T.wer(F.col("ref"), F.col("hyp")).alias("wer"))


@query(
    """WITH s AS (SELECT source AS model, lang AS tier, n_chars % 97 / 97 AS cer, n_chars % 89 / 89 AS wer, n_chars % 83 / 83 AS ned FROM documents)
SELECT model, coalesce(tier, 'overall') AS tier, count(*) AS n_pages, round(avg(cer), 9) AS cer, round(avg(wer), 9) AS wer, round(avg(ned), 9) AS ned FROM s GROUP BY GROUPING SETS ((model, tier), (model))"""
)
def corpus_scores(spark, sf_dir):
    n = F.col("n_chars")
    scored = table(spark, sf_dir, "documents").select(F.col("source").alias("model"), F.col("lang").alias("tier"), (n % 97 / 97).alias("cer"), (n % 89 / 89).alias("wer"), (n % 83 / 83).alias("ned"))
    out = evaluation.corpus_scores(scored)
    return out.select("model", "tier", "n_pages", *(F.round(c, 9).alias(c) for c in ("cer", "wer", "ned")))


@query(
    r"""WITH e AS (SELECT conv_id, turn, role, CAST(length(w) AS VARCHAR) AS type, trim(regexp_replace(lower(nfc_normalize(w)), '\s+', ' ', 'g')) AS t FROM (SELECT conv_id, turn, role, unnest(string_split(text, ' ')) AS w FROM conversations) WHERE w <> ''),
g AS (SELECT conv_id, turn, type, t FROM e WHERE role = 'user'),
h AS (SELECT conv_id, turn - 1 AS turn, type, t FROM e WHERE role = 'assistant'),
gc AS (SELECT conv_id, turn, type, t, count(*) AS r FROM g GROUP BY ALL), hc AS (SELECT conv_id, turn, type, t, count(*) AS h FROM h GROUP BY ALL),
b AS (SELECT conv_id, turn, sum(CASE WHEN r IS NOT NULL AND h IS NOT NULL THEN least(r, h) ELSE 0 END) AS tp, coalesce(sum(r), 0) AS n_ref, coalesce(sum(h), 0) AS n_hyp FROM gc FULL JOIN hc USING (conv_id, turn, type, t) GROUP BY 1, 2),
k AS (SELECT * FROM b SEMI JOIN (SELECT DISTINCT conv_id, turn FROM g) USING (conv_id, turn)),
s AS (SELECT 'assistant' AS model, coalesce('turn ' || turn % 2, 'overall') AS tier, CAST(sum(tp) AS BIGINT) AS tp, CAST(sum(n_ref) AS BIGINT) AS n_ref, CAST(sum(n_hyp) AS BIGINT) AS n_hyp, count(*) AS n_entity_pages
  FROM k GROUP BY GROUPING SETS (('turn ' || turn % 2), ()))
SELECT *, coalesce(tp / nullif(n_hyp, 0), 0.0) AS precision, coalesce(tp / nullif(n_ref, 0), 0.0) AS recall,
  coalesce(2 * (tp / nullif(n_hyp, 0)) * (tp / nullif(n_ref, 0)) / nullif(tp / nullif(n_hyp, 0) + tp / nullif(n_ref, 0), 0), 0.0) AS f1 FROM s"""
)
def entity_prf_micro(spark, sf_dir):
    turns = table(spark, sf_dir, "conversations")

    def words(role, shift):
        w = turns.where(F.col("role") == role).select("conv_id", (F.col("turn") - shift).alias("turn"), F.explode(F.split("text", " ")).alias("text"))
        return w.where("text <> ''").withColumn("type", F.length("text").cast("string"))

    counts = evaluation.entity_counts(words("user", 0), words("assistant", 1), ["conv_id", "turn"])
    paged = counts.select(F.lit("assistant").alias("model"), F.concat(F.lit("turn "), (F.col("turn") % 2).cast("string")).alias("tier"), "tp", "n_ref", "n_hyp")
    return evaluation.entity_scores(paged)


@query(
    """WITH m(model) AS (VALUES ('quality'), ('toxic'), ('absent')),
p AS (SELECT doc_id, source, model, CASE model WHEN 'quality' THEN quality WHEN 'toxic' THEN toxic END AS hyp FROM documents CROSS JOIN m LEFT JOIN labels USING (doc_id))
SELECT model, source, count(*) FILTER (hyp IS NULL) AS n_missing, count(*) FILTER (hyp IS NOT NULL) AS n_pages FROM p GROUP BY model, source"""
)
def missing_predictions(spark, sf_dir):
    labels = table(spark, sf_dir, "labels").select("doc_id", F.expr("stack(2, 'quality', quality, 'toxic', toxic) as (model, hyp)"))
    models = spark.createDataFrame([("quality",), ("toxic",), ("absent",)], "model string")
    pairs = table(spark, sf_dir, "documents").select("doc_id", "source").crossJoin(F.broadcast(models)).join(labels, ["doc_id", "model"], "left")
    return pairs.groupBy("model", "source").agg(F.count_if(F.col("hyp").isNull()).alias("n_missing"), F.count_if(F.col("hyp").isNotNull()).alias("n_pages"))


# vocabularies ---------------------------------------------------------------------------------

_FACETS = [("Places", 80, 1, ["ocean", "sky"]), ("Metals", 90, 2, ["steel", "copper", "tin", "brass", "nickel"]), ("Economy", 90, 1, ["ECONOMY"]), ("Standard", 50, None, ["STANDARD"]), ("Colours", 40, None, ["red", "blue", "green", "lime"])]


def _facets(spark):
    return spark.createDataFrame([f[:3] for f in _FACETS], "theme string, priority int, tie int")


def _keywords(spark):
    return spark.createDataFrame([(t, k, i) for t, _, _, ks in _FACETS for i, k in enumerate(ks)], "theme string, keyword string, kw_ord int")


def _terms(spark, sf_dir):
    """Part names as one source and brands and market segments as others."""
    part = table(spark, sf_dir, "part")
    a = part.select(F.lit("a").alias("source"), F.col("p_partkey").cast("string").alias("source_id"), F.col("p_name").alias("label"), F.col("p_type").alias("scheme"), F.col("p_brand").alias("sub"))
    b = part.select(F.lit("b").alias("source"), F.concat(F.lit("B"), "p_partkey").alias("source_id"), F.upper("p_name").alias("label"), F.lit(None).cast("string").alias("scheme"), F.lit(None).cast("string").alias("sub"))
    c = table(spark, sf_dir, "customer").select(F.lit("c").alias("source"), F.col("c_custkey").cast("string").alias("source_id"), F.col("c_mktsegment").alias("label"), F.lit(None).cast("string").alias("scheme"), F.lit(None).cast("string").alias("sub"))
    return a.unionByName(b).unionByName(c)


_TERMS = """
t AS (SELECT 'a' AS source, CAST(p_partkey AS VARCHAR) AS source_id, p_name AS label, p_type AS scheme, p_brand AS sub FROM part
  UNION ALL SELECT 'b', 'B' || p_partkey, upper(p_name), NULL, NULL FROM part UNION ALL SELECT 'c', CAST(c_custkey AS VARCHAR), c_mktsegment, NULL, NULL FROM customer),
ranked AS (SELECT *, lower(trim(label)) AS norm, row_number() OVER w AS rank, first_value(source_id) OVER w AS kept_source_id FROM t
  WINDOW w AS (PARTITION BY lower(trim(label)) ORDER BY CASE source WHEN 'b' THEN 1 WHEN 'a' THEN 2 ELSE 3 END, source, CASE WHEN regexp_full_match(source_id, '[0-9]+') THEN CAST(source_id AS BIGINT) ELSE 0 END, source_id, label))"""


@query(f"WITH {_TERMS} SELECT source, source_id, label, norm FROM ranked WHERE rank = 1")
def vocab_merge_dedup(spark, sf_dir):
    return vocabulary.merge_sources(_terms(spark, sf_dir), ["b", "a"]).where("rank = 1").select("source", "source_id", "label", "norm")


@query(f"WITH {_TERMS} SELECT source, norm, count(*) AS n, count(DISTINCT kept_source_id) AS kept FROM ranked WHERE rank > 1 GROUP BY source, norm")
def vocab_collisions(spark, sf_dir):
    out = vocabulary.merge_sources(_terms(spark, sf_dir), ["b", "a"]).where("rank > 1")
    return out.groupBy("source", "norm").agg(F.count("*").alias("n"), F.count_distinct("kept_source_id").alias("kept"))


def _tree(spark, sf_dir):
    """Region, nation and supplier or customer as a thesaurus."""
    r = table(spark, sf_dir, "region").select(F.concat(F.lit("r"), "r_regionkey").alias("id"), F.lit(None).cast("string").alias("parent_id"), F.col("r_name").alias("label"))
    n = table(spark, sf_dir, "nation").select(F.concat(F.lit("n"), "n_nationkey").alias("id"), F.concat(F.lit("r"), "n_regionkey").alias("parent_id"), F.col("n_name").alias("label"))
    s = table(spark, sf_dir, "supplier").select(F.concat(F.lit("s"), "s_suppkey").alias("id"), F.concat(F.lit("n"), "s_nationkey").alias("parent_id"), F.col("s_name").alias("label"))
    c = table(spark, sf_dir, "customer").select(F.concat(F.lit("c"), "c_custkey").alias("id"), F.concat(F.lit("n"), "c_nationkey").alias("parent_id"), F.col("c_name").alias("label"))
    return r.unionByName(n).unionByName(s).unionByName(c)


_TREE = """
e AS (SELECT 'r' || r_regionkey AS id, CAST(NULL AS VARCHAR) AS parent_id, r_name AS label FROM region UNION ALL SELECT 'n' || n_nationkey, 'r' || n_regionkey, n_name FROM nation
  UNION ALL SELECT 's' || s_suppkey, 'n' || s_nationkey, s_name FROM supplier UNION ALL SELECT 'c' || c_custkey, 'n' || c_nationkey, c_name FROM customer),
tree AS (SELECT id, label, 1 AS depth, '' AS broader, id AS scheme, CAST(NULL AS VARCHAR) AS sub FROM e WHERE parent_id IS NULL
  UNION ALL SELECT e.id, e.label, depth + 1, CASE WHEN broader = '' THEN tree.id ELSE broader || '/' || tree.id END, scheme, CASE WHEN depth = 1 THEN e.label ELSE sub END FROM tree JOIN e ON e.parent_id = tree.id)"""


@query(f"WITH RECURSIVE {_TREE} SELECT id, label, depth, broader, scheme, sub FROM tree")
def tree_flatten(spark, sf_dir):
    flat = vocabulary.flatten_tree(spark, _tree(spark, sf_dir))
    return flat.select("id", "label", "depth", F.array_join("broader", "/").alias("broader"), "scheme", "sub")


def _placed(spark, sf_dir):
    """Tree nodes below regions and part names, placed by scheme, branch or keyword."""
    nodes = vocabulary.flatten_tree(spark, _tree(spark, sf_dir)).select(F.lit("tree").alias("source"), F.col("id").alias("source_id"), F.col("id").alias("term_id"), "label", "broader", "sub", F.lit(None).cast("string").alias("scheme"))
    parts = table(spark, sf_dir, "part").select(
        F.lit("part").alias("source"), F.col("p_partkey").cast("string").alias("source_id"), F.concat(F.lit("p"), "p_partkey").alias("term_id"), F.col("p_name").alias("label"), F.array().cast("array<string>").alias("broader"), F.col("p_brand").alias("sub"), F.col("p_type").alias("scheme")
    )
    scheme = spark.createDataFrame([("ECONOMY", "Economy"), ("STANDARD", "Standard")], "scheme string, theme string")
    branch = spark.createDataFrame([("r1", "Places"), ("n3", "Metals"), ("n7", "Standard"), ("s5", "Colours")], "branch string, theme string")
    return vocabulary.place_terms(nodes.unionByName(parts), _facets(spark), scheme, branch, _keywords(spark), ("part",))


_PLACED = f"""{_TREE},
f(theme, theme_ord) AS (VALUES ('Economy', 1), ('Metals', 2), ('Places', 3), ('Standard', 4), ('Colours', 5)),
kw(theme, keyword, kw_ord) AS (VALUES {", ".join(f"('{t}', '{k}', {i})" for t, _, _, ks in _FACETS for i, k in enumerate(ks))}),
br(branch, theme) AS (VALUES ('r1', 'Places'), ('n3', 'Metals'), ('n7', 'Standard'), ('s5', 'Colours')),
sm(scheme, theme) AS (VALUES ('ECONOMY', 'Economy'), ('STANDARD', 'Standard')),
term AS (SELECT 'tree' AS source, id AS source_id, id AS term_id, label, CASE WHEN broader = '' THEN CAST([] AS VARCHAR[]) ELSE string_split(broader, '/') END AS broader, CAST(NULL AS VARCHAR) AS scheme FROM tree
  UNION ALL SELECT 'part', CAST(p_partkey AS VARCHAR), 'p' || p_partkey, p_name, CAST([] AS VARCHAR[]), p_type FROM part),
chain AS (SELECT term_id, unnest(range(0, len(c))) AS dist, unnest(c) AS branch FROM (SELECT term_id, list_concat([source_id], list_reverse(broader)) AS c FROM term)),
near AS (SELECT term_id, arg_min(br.theme, dist) AS theme, arg_min(br.branch, dist) AS branch FROM chain JOIN br USING (branch) GROUP BY term_id),
hit AS (SELECT term_id, arg_min(kw.theme, theme_ord * 1000 + kw_ord) AS theme, arg_min(keyword, theme_ord * 1000 + kw_ord) AS keyword FROM term JOIN kw ON contains(lower(label), lower(keyword)) JOIN f USING (theme) GROUP BY term_id),
placed AS (SELECT term_id, label, coalesce(sm.theme, near.theme, hit.theme, 'Other') AS theme,
  CASE WHEN sm.theme IS NOT NULL THEN 'scheme:' || term.scheme WHEN near.theme IS NOT NULL THEN 'branch:' || branch WHEN hit.theme IS NOT NULL THEN 'keyword:' || keyword ELSE 'other' END AS placed_by
  FROM term LEFT JOIN sm ON sm.scheme = term.scheme AND source = 'part' LEFT JOIN near USING (term_id) LEFT JOIN hit USING (term_id))"""


@query(f"WITH RECURSIVE {_PLACED} SELECT term_id, label, theme FROM placed")
def taxonomy_cascade(spark, sf_dir):
    return _placed(spark, sf_dir).select("term_id", "label", "theme")


@query(f"WITH RECURSIVE {_PLACED} SELECT term_id, placed_by FROM placed")
def placement_audit(spark, sf_dir):
    return _placed(spark, sf_dir).select("term_id", "placed_by")


@query(f"WITH RECURSIVE {_PLACED} SELECT theme, count(*) AS n, count(*) / sum(count(*)) OVER () AS share FROM placed GROUP BY theme")
def theme_histogram(spark, sf_dir):
    return vocabulary.theme_histogram(_placed(spark, sf_dir))


@query(f"WITH RECURSIVE {_PLACED} SELECT split_part(placed_by, ':', 1) AS rule, count(*) AS n FROM placed GROUP BY 1")
def rule_histogram(spark, sf_dir):
    return vocabulary.rule_histogram(_placed(spark, sf_dir))


@query(
    """WITH t AS (SELECT p_brand AS theme, p_type AS sub, p_partkey AS pos, p_name || ' (' || p_size || ')' AS rendered FROM part),
c AS (SELECT *, length(rendered) + 3 + CASE WHEN row_number() OVER (PARTITION BY theme, sub ORDER BY pos) = 1 THEN length(theme || ' / ' || sub) + 10 ELSE 0 END AS cost FROM t),
s AS (SELECT *, CAST(sum(cost) OVER (PARTITION BY theme ORDER BY pos ROWS UNBOUNDED PRECEDING) + 100 AS BIGINT) AS total_chars FROM c)
SELECT theme, sub, pos, rendered, total_chars FROM s WHERE greatest(1, total_chars // 4) <= 300"""
)
def prompt_prefix_budget(spark, sf_dir):
    terms = table(spark, sf_dir, "part").select(
        F.col("p_brand").alias("theme"), F.col("p_type").alias("sub"), F.col("p_partkey").alias("pos"), F.concat("p_name", F.lit(" ("), F.col("p_size").cast("string"), F.lit(")")).alias("rendered")
    )
    return vocabulary.prompt_prefix(terms, 300, head=100, partition="theme")


# records, licences and layout -----------------------------------------------------------------


@query(
    """WITH i AS (SELECT l_orderkey AS o_orderkey, CAST(sum(l_quantity) AS DOUBLE) AS o_totalprice, max(l_returnflag) AS o_orderstatus, bool_or(l_discount > 0.05) AS has FROM lineitem GROUP BY 1
  UNION ALL SELECT -1 - c_custkey, c_acctbal, 'X', true FROM customer)
SELECT o_orderkey, CASE WHEN i.o_orderkey IS NOT NULL AND has THEN i.o_orderstatus ELSE o.o_orderstatus END AS o_orderstatus, coalesce(i.o_totalprice, o.o_totalprice) AS o_totalprice, o.o_orderpriority,
  CASE WHEN o.o_orderstatus IS NULL THEN 'added' WHEN i.o_orderstatus IS NOT NULL THEN 'patched' ELSE 'kept' END AS change FROM orders o FULL JOIN i USING (o_orderkey)"""
)
def field_level_merge(spark, sf_dir):
    base = table(spark, sf_dir, "orders").select("o_orderkey", "o_orderstatus", "o_totalprice", "o_orderpriority")
    items = table(spark, sf_dir, "lineitem").groupBy(F.col("l_orderkey").alias("o_orderkey")).agg(F.sum("l_quantity").alias("o_totalprice"), F.max("l_returnflag").alias("o_orderstatus"), F.bool_or(F.col("l_discount") > 0.05).alias("has"))
    new = table(spark, sf_dir, "customer").select((-1 - F.col("c_custkey")).alias("o_orderkey"), F.col("c_acctbal").alias("o_totalprice"), F.lit("X").alias("o_orderstatus"), F.lit(True).alias("has"))
    both = items.unionByName(new).withColumn("present", F.when(F.col("has"), F.array(F.lit("o_orderstatus"), F.lit("o_totalprice"))).otherwise(F.array(F.lit("o_totalprice"))))
    return records.merge_fields(base, both.drop("has"), ["o_orderkey"], ["o_orderstatus", "o_totalprice"], "present")


@query(
    """SELECT user_id AS doc_id, event_type AS block, arg_max(event_id, (strftime(ts, '%Y-%m-%dT%H'), -event_id)) AS ordinal, max(strftime(ts, '%Y-%m-%dT%H')) AS updated_at FROM events GROUP BY 1, 2"""
)
def fan_in_merge(spark, sf_dir):
    blocks = table(spark, sf_dir, "events").select(F.col("user_id").alias("doc_id"), F.col("event_type").alias("block"), F.col("event_id").alias("ordinal"), F.date_format("ts", "yyyy-MM-dd'T'HH").alias("updated_at"))
    return records.fan_in(blocks)


@query(
    """WITH l AS (SELECT source, doc_id, CASE WHEN contains(text, 'Apache License, Version 2.0') THEN 'Apache-2.0' WHEN contains(text, 'GNU General Public License, version 3') THEN 'GPL-3.0'
  WHEN contains(text, 'CC BY-NC 4.0') THEN 'CC BY-NC 4.0' WHEN contains(text, 'MIT License') THEN 'MIT' WHEN contains(text, 'All rights reserved') THEN 'all rights reserved' END AS l FROM documents),
r AS (SELECT *, CASE l WHEN 'Apache-2.0' THEN 1 WHEN 'MIT' THEN 1 WHEN 'GPL-3.0' THEN 4 WHEN 'CC BY-NC 4.0' THEN 5 ELSE 6 END AS rank FROM l WHERE l IS NOT NULL),
e AS (SELECT source, arg_max(l, (rank, -doc_id)) AS effective_license, max(rank) AS top, count(*) AS n_components FROM r GROUP BY source)
SELECT source, effective_license, effective_license = 'CC BY-NC 4.0' AS is_non_commercial, effective_license = 'GPL-3.0' AS is_share_alike, n_components,
  (SELECT string_agg(CAST(doc_id AS VARCHAR), ',' ORDER BY doc_id) FROM r WHERE r.source = e.source AND rank = top) AS determined_by FROM e"""
)
def effective_license(spark, sf_dir):
    t = F.col("text")
    found = (
        F.when(F.contains(t, F.lit("Apache License, Version 2.0")), "Apache License 2.0")
        .when(F.contains(t, F.lit("GNU General Public License, version 3")), " gpl 3.0")
        .when(F.contains(t, F.lit("CC BY-NC 4.0")), "cc-by-nc-4.0")
        .when(F.contains(t, F.lit("MIT License")), "MIT")
        .when(F.contains(t, F.lit("All rights reserved")), "all rights reserved")
    )
    parts = table(spark, sf_dir, "documents").select("source", F.col("doc_id").alias("ordinal"), F.col("doc_id").cast("string").alias("name"), found.alias("license")).where("license is not null")
    out = provenance.effective_license(parts, "source")
    return out.select("source", "effective_license", "is_non_commercial", "is_share_alike", "n_components", F.array_join("determined_by", ",").alias("determined_by"))


_STACK = "PARTITION BY l_orderkey ORDER BY l_linenumber, l_partkey, l_suppkey, l_quantity, l_extendedprice, l_discount, l_tax"


@query(
    f"""WITH l AS (SELECT l_orderkey AS doc_id, row_number() OVER ({_STACK}) AS row_idx, sum(l_quantity) OVER ({_STACK} ROWS UNBOUNDED PRECEDING) AS s, l_quantity, l_tax FROM lineitem),
p AS (SELECT doc_id, row_idx, s - l_quantity + row_idx * 2 - top AS y0, s + row_idx * 2 - l_tax * 100 - top AS y1
  FROM (SELECT *, CASE WHEN row_idx > 3 THEN max(CASE WHEN row_idx = 3 THEN s END) OVER (PARTITION BY doc_id) + 6 ELSE 0 END AS top FROM l)),
g AS (SELECT *, greatest(0.0, y0 - lag(y1) OVER (PARTITION BY doc_id ORDER BY row_idx)) AS gap FROM p),
b AS (SELECT doc_id, count(*) AS n, list_sort(list(gap) FILTER (gap > 0)) AS gs FROM g GROUP BY doc_id),
r AS (SELECT doc_id, row_idx, CAST(sum(CASE WHEN coalesce(gap > 1.8 * gs[len(gs) // 4 + 1], false) THEN 1 ELSE 0 END) OVER (PARTITION BY doc_id ORDER BY row_idx ROWS UNBOUNDED PRECEDING) AS BIGINT) AS group_id FROM g JOIN b USING (doc_id) WHERE n >= 2)
SELECT doc_id, CAST(row_idx AS INT) AS row_idx, group_id FROM p LEFT JOIN r USING (doc_id, row_idx)"""
)
def paragraph_groups(spark, sf_dir):
    w = Window.partitionBy("l_orderkey").orderBy("l_linenumber", "l_partkey", "l_suppkey", "l_quantity", "l_extendedprice", "l_discount", "l_tax")
    total = F.sum("l_quantity").over(w.rowsBetween(Window.unboundedPreceding, 0))
    stacked = table(spark, sf_dir, "lineitem").select(F.col("l_orderkey").alias("doc_id"), F.row_number().over(w).alias("row_idx"), total.alias("s"), "l_quantity", "l_tax")
    # the fourth line of an order and those after it are a second column, which begins at the top again
    third = F.max(F.when(F.col("row_idx") == 3, F.col("s"))).over(Window.partitionBy("doc_id"))
    stacked = stacked.withColumn("top", F.when(F.col("row_idx") > 3, third + 6).otherwise(0))
    rows = stacked.select("doc_id", "row_idx", (F.col("s") - F.col("l_quantity") + F.col("row_idx") * 2 - F.col("top")).alias("y0"), (F.col("s") + F.col("row_idx") * 2 - F.col("l_tax") * 100 - F.col("top")).alias("y1"))
    return layout.paragraph_groups(rows, ("doc_id",)).select("doc_id", "row_idx", "group_id")


@query(
    """SELECT label, min(least(embedding[1], embedding[3])) AS x0, min(least(embedding[2], embedding[4])) AS y0, max(greatest(embedding[1], embedding[3])) AS x1, max(greatest(embedding[2], embedding[4])) AS y1 FROM embeddings GROUP BY label"""
)
def bbox_union(spark, sf_dir):
    e = F.col("embedding")
    boxes = table(spark, sf_dir, "embeddings").select("label", F.least(e[0], e[2]).alias("x0"), F.least(e[1], e[3]).alias("y0"), F.greatest(e[0], e[2]).alias("x1"), F.greatest(e[1], e[3]).alias("y1"))
    return layout.box_union(boxes, ["label"])


@query(
    """SELECT l_orderkey, l_linenumber, CAST(round_even((l_quantity - 2) * CASE l_returnflag WHEN 'A' THEN 300 / 1200.0 WHEN 'N' THEN 300 / 254.0 ELSE 300 / 150.0 END, 0) AS BIGINT) AS x FROM lineitem"""
)
def bbox_scale(spark, sf_dir):
    unit = F.when(F.col("l_returnflag") == "A", "inch1200").when(F.col("l_returnflag") == "N", "mm10").otherwise("pixel")
    scale = layout.dpi_scale(unit, F.lit(300.0), F.lit(150.0))
    return table(spark, sf_dir, "lineitem").select("l_orderkey", "l_linenumber", layout.scaled(F.col("l_quantity").cast("string"), F.lit(2.0), scale).alias("x"))


@query(
    """WITH c AS (SELECT l_suppkey, l_quantity, count(*) AS n, min(l_orderkey * 10 + l_linenumber) AS f FROM lineitem GROUP BY 1, 2)
SELECT l_suppkey, arg_max(l_quantity, (n, -f)) AS l_quantity, max(n) AS n FROM c GROUP BY 1"""
)
def dominant_value(spark, sf_dir):
    rows = table(spark, sf_dir, "lineitem").select("l_suppkey", "l_quantity", (F.col("l_orderkey") * 10 + F.col("l_linenumber")).alias("seq"))
    return layout.dominant(rows, ["l_suppkey"], "l_quantity", "seq")


@query(
    r"""WITH p AS (SELECT page_id, regexp_replace(url, '^.*/', '') || CASE page_id % 4 WHEN 0 THEN '.alto.xml' WHEN 1 THEN '-7.part.txt' WHEN 2 THEN '.other.bin' ELSE '' END AS name FROM pages)
SELECT page_id, CASE WHEN regexp_matches(lower(name), '(\.teitok\.xml|\.alto\.xml|\.document\.json|_enriched\.json|\.conllu|\.docx|\.json|\.xml|\.csv|\.pdf|\.txt|\.md)$')
  THEN regexp_replace(name, '(\.teitok\.xml|\.alto\.xml|\.document\.json|_enriched\.json|\.conllu|\.docx|\.json|\.xml|\.csv|\.pdf|\.txt|\.md)$', '', 'i') ELSE split_part(name, '.', 1) END AS doc FROM p"""
)
def canonical_doc_id(spark, sf_dir):
    suffix = F.when(F.col("page_id") % 4 == 0, ".alto.xml").when(F.col("page_id") % 4 == 1, "-7.part.txt").when(F.col("page_id") % 4 == 2, ".other.bin").otherwise("")
    return table(spark, sf_dir, "pages").select("page_id", T.canonical_doc_id(F.concat("url", suffix)).alias("doc"))


# predictions ----------------------------------------------------------------------------------

_REPLY = """CASE event_type WHEN 'click' THEN '{"keywords":["a' || k || '","b"],"keywords_en":["c"],"category":"Metals","confidence":0.' || k || '}'
  WHEN 'purchase' THEN '{"keywords":["a"],"keywords_en":["b"],"category":"No category","confidence":"1.' || k || '"}' WHEN 'view' THEN '{"keywords":["a"],"category":"Places","confidence":-' || k || '}'
  WHEN 'signup' THEN '{"keywords":[],"category":"Nowhere","confidence":0.5}' ELSE '{"keywords":["a' || k END"""


@query(
    f"""WITH r AS (SELECT event_id, {_REPLY} AS reply FROM (SELECT *, json_extract_string(props, '$.k') AS k FROM events)),
p AS (SELECT event_id, CASE WHEN json_valid(reply) THEN reply END AS j FROM r),
v AS (SELECT event_id, json_extract_string(j, '$.category') AS category, least(1.0, greatest(0.0, TRY_CAST(json_extract_string(j, '$.confidence') AS DOUBLE))) AS confidence,
  CASE WHEN json_extract_string(j, '$.category') = 'No category' THEN '' ELSE coalesce(array_to_string(json_extract_string(j, '$.keywords[*]'), ','), '') END AS keywords FROM p)
SELECT event_id, CASE WHEN category IS NULL THEN 'no valid JSON' WHEN category NOT IN ('Metals', 'Places', 'No category') THEN 'unknown category' END AS error,
  CASE WHEN category IS NOT NULL THEN category END AS category, CASE WHEN category IS NOT NULL THEN round(confidence, 6) END AS confidence, CASE WHEN category IS NOT NULL THEN keywords END AS keywords FROM v"""
)
def lenient_json_validate(spark, sf_dir):
    replies = table(spark, sf_dir, "events").withColumn("k", F.get_json_object("props", "$.k")).select("event_id", F.expr(_REPLY).alias("reply"))
    out = enrich.validate(replies, enrich.vocabulary_categories(spark, ["Metals", "Places"]))
    known = F.col("category").isNotNull()
    return out.select("event_id", "error", "category", F.when(known, F.round("confidence", 6)).alias("confidence"), F.when(known, F.array_join("keywords", ",")).alias("keywords"))


#: Terms of the lexical predictor, with their English forms and themes.
_LEXICON = (("that", "THAT", "Pronouns"), ("with", "WITH", "Particles"), ("this", "THIS", "Pronouns"), ("from", "FROM", "Particles"), ("tion", "TION", "Endings"), ("menton", "MENTON", "Endings"), ("then", "THEN", "Particles"))


@query(
    f"""WITH {_LINES},
e AS (SELECT *, CASE WHEN quality_score < 0.4 THEN 'Trash' WHEN quality_score < 0.7 AND categ <> 'Trash' THEN 'Noisy' ELSE categ END AS c FROM lines),
k AS (SELECT file, row_idx, lower(text) AS t FROM e WHERE length(text) > 0 AND c NOT IN ('Empty', 'Trash') AND (c = 'Non-text' OR length(text) >= 3)
  AND (c <> 'Non-text' OR (length(text) >= 8 AND length(regexp_replace(text, '[^\\p{{L}}]', '', 'g')) / length(text) >= 0.4))),
v(term, en) AS (VALUES {", ".join(f"('{t}', '{e}')" for t, e, _ in _LEXICON)}),
h AS (SELECT file, row_idx, list(term ORDER BY -length(term), term) AS terms, list(en ORDER BY -length(term), term) AS ens FROM k JOIN v ON contains(t, term) GROUP BY file, row_idx)
SELECT file, CAST(row_idx AS INT) AS row_idx, coalesce(array_to_string(terms[1:5], ','), '') AS keywords, coalesce(array_to_string(ens[1:5], ','), '') AS keywords_en, coalesce(terms[1], 'No category') AS category,
  CASE WHEN terms IS NULL THEN 0.0::DOUBLE ELSE round(least(1.0, 0.5 + 0.1 * len(terms[1:5])), 6)::DOUBLE END AS confidence FROM k LEFT JOIN h USING (file, row_idx)"""
)
def enrich_lines_lexical(spark, sf_dir):
    categories = enrich.vocabulary_categories(spark, [t for t, _, _ in _LEXICON])
    found, _ = enrich.enrich_lines(_lines(spark, sf_dir), enrich.LexicalPredictor(list(_LEXICON)), categories)
    return found.select("file", "row_idx", F.array_join("keywords", ",").alias("keywords"), F.array_join("keywords_en", ",").alias("keywords_en"), "category", F.round("confidence", 6).alias("confidence"))


@query(
    r"""WITH b AS (SELECT page_id, regexp_extract_all(html, '(?is)<(?:h[1-6]|p|li)(?: [^>]*)?>.*?</(?:h[1-6]|p|li)>') AS parts FROM pages),
r AS (SELECT page_id, unnest(range(0, len(parts))) AS row_idx, unnest(parts) AS part FROM b),
t AS (SELECT *, lower(regexp_extract(part, '^<(\w+)', 1)) AS tag, regexp_replace(part, '<[^>]*>', ' ', 'g') AS x FROM r)
SELECT page_id, CAST(row_idx AS INT) AS row_idx, CASE WHEN tag = 'p' THEN 'paragraph' WHEN tag = 'li' THEN 'item' ELSE 'heading' END AS kind, CASE WHEN tag LIKE 'h%' THEN CAST(substr(tag, 2) AS INT) END AS level,
  trim(regexp_replace(replace(replace(replace(replace(replace(replace(x, '&nbsp;', ' '), '&lt;', '<'), '&gt;', '>'), '&quot;', '"'), '&#39;', ''''), '&amp;', '&'), '[ \t\r\n]+', ' ', 'g')) AS text FROM t"""
)
def html_rows(spark, sf_dir):
    return markup.html_rows(table(spark, sf_dir, "pages"), ["page_id"])


# cues, keys, records and vocabulary files -------------------------------------------------------


@query(
    r"""SELECT p_partkey, '<!-- PAGE_BREAK: pg_' || p_size || ' -->' AS page,
  '<!-- FONT: size=' || regexp_replace(printf('%.2f', p_size / 4.0), '\.?0+$', '') || 'pt' || CASE WHEN p_size % 3 = 0 THEN ', weight=700' ELSE '' END || ', family="' || p_brand || '" -->' AS font,
  CASE WHEN p_size % 2 = 0 THEN '<div align="center">' || chr(10) || '**' || p_name || '**' || chr(10) || '</div>' ELSE '**' || p_name || '**' END AS title,
  '<!-- LAYOUT_COLUMN: ' || (p_partkey % 2 + 1) || '_of_2 -->' AS col FROM part"""
)
def layout_cues(spark, sf_dir):
    size = F.col("p_size")
    return table(spark, sf_dir, "part").select(
        "p_partkey",
        cues.page_break(size).alias("page"),
        cues.font(size / 4, F.when(size % 3 == 0, 700), F.col("p_brand")).alias("font"),
        cues.aligned(cues.marked(F.col("p_name"), "bold"), F.when(size % 2 == 0, "center").otherwise("left")).alias("title"),
        cues.column_of(F.col("p_partkey") % 2 + 1, F.lit(2)).alias("col"),
    )


@query(
    """WITH w AS (SELECT doc_id, unnest(range(0, len(s))) AS row_idx, unnest(s) AS text FROM (SELECT doc_id, string_split(text, ' ') AS s FROM documents)),
p AS (SELECT doc_id, row_idx, trim(text) AS text, row_idx // 120 AS block_num, row_idx // 40 % 3 AS par_num, row_idx % 10 * 50 AS x, row_idx // 10 * 12 AS y FROM w WHERE trim(text) <> '' AND row_idx % 11 <> 0)
SELECT doc_id, block_num, par_num, string_agg(text, ' ' ORDER BY row_idx) AS text, CAST(round_even(min(x) * 0.24, 0) AS BIGINT) AS x0, CAST(round_even(min(y) * 0.24, 0) AS BIGINT) AS y0,
  CAST(round_even(max(x + 40) * 0.24, 0) AS BIGINT) AS x1, CAST(round_even(max(y + 10) * 0.24, 0) AS BIGINT) AS y1 FROM p GROUP BY doc_id, block_num, par_num"""
)
def ocr_paragraphs(spark, sf_dir):
    i = F.col("row_idx")
    words = table(spark, sf_dir, "documents").select("doc_id", F.posexplode(F.split("text", " ")).alias("row_idx", "text"))
    words = words.select("*", F.floor(i / 120).alias("block_num"), F.floor(i / 40 % 3).alias("par_num"), F.when(i % 11 == 0, "-1").otherwise("90").alias("conf"))
    words = words.select("*", (i % 10 * 50).alias("left"), (F.floor(i / 10) * 12).alias("top"), F.lit(40).alias("width"), F.lit(10).alias("height"))
    return cues.ocr_paragraphs(words, ("doc_id",), 0.24).select("doc_id", "block_num", "par_num", "text", "x0", "y0", "x1", "y1")


@query(
    """SELECT l.l_orderkey, l.l_linenumber, p.p_partkey FROM lineitem l JOIN part p ON CAST(CAST(l.l_quantity AS BIGINT) AS VARCHAR) = CAST(p.p_size AS VARCHAR) AND l.l_partkey = p.p_partkey"""
)
def keys_of_mixed_types(spark, sf_dir):
    """A floating-point column meets an integer one under one key."""
    left = table(spark, sf_dir, "lineitem").select("l_orderkey", "l_linenumber", F.col("l_partkey").alias("p_partkey"), V.key_text(F.col("l_quantity"), "double").alias("k"))
    right = table(spark, sf_dir, "part").select("p_partkey", V.key_text(F.col("p_size"), "int").alias("k"))
    return left.join(right, ["p_partkey", "k"]).select("l_orderkey", "l_linenumber", "p_partkey")


@query(
    """WITH f AS (SELECT user_id AS doc_id, event_type AS program, strftime(ts, '%Y-%m') AS run_id, 'b' || event_id % 5 AS block, min(event_id) AS o, max(strftime(ts, '%Y-%m-%dT%H:%M:%S')) AS u FROM events GROUP BY 1, 2, 3, 4)
SELECT doc_id, program, run_id, string_agg(block, ',' ORDER BY o, block) AS blocks, max(u) AS updated_at FROM f GROUP BY 1, 2, 3"""
)
def record_contributors(spark, sf_dir):
    stamps = table(spark, sf_dir, "events").select(
        F.col("user_id").alias("doc_id"),
        F.col("event_type").alias("program"),
        F.date_format("ts", "yyyy-MM").alias("run_id"),
        F.concat(F.lit("b"), F.col("event_id") % 5).alias("block"),
        F.date_format("ts", "yyyy-MM-dd'T'HH:mm:ss").alias("updated_at"),
        F.col("event_id").alias("ordinal"),
    )
    return records.contributors(stamps)


@query("""SELECT user_id AS doc_id, event_type AS kind, 'k' || event_id % 3 AS key, arg_max(value, event_id) AS value FROM events GROUP BY 1, 2, 3""")
def record_accretion(spark, sf_dir):
    entries = table(spark, sf_dir, "events").select(F.col("user_id").alias("doc_id"), F.col("event_type").alias("kind"), F.concat(F.lit("k"), F.col("event_id") % 3).alias("key"), "value", F.col("event_id").alias("ordinal"))
    return records.accrete(entries)


@query(
    """SELECT o_orderkey AS doc_id, 'pages' AS block, o_orderstatus AS body FROM orders WHERE o_orderkey NOT IN (SELECT l_orderkey FROM lineitem WHERE l_discount > 0.05)
UNION ALL SELECT o_orderkey, 'lines', o_orderpriority FROM orders UNION ALL SELECT l_orderkey, 'pages', max(l_returnflag) FROM lineitem WHERE l_discount > 0.05 GROUP BY 1"""
)
def replace_own_blocks(spark, sf_dir):
    orders, items = table(spark, sf_dir, "orders"), table(spark, sf_dir, "lineitem").where("l_discount > 0.05")
    blocks = orders.select(F.col("o_orderkey").alias("doc_id"), F.explode(F.create_map(F.lit("pages"), "o_orderstatus", F.lit("lines"), "o_orderpriority")).alias("block", "body"))
    own = items.groupBy(F.col("l_orderkey").alias("doc_id")).agg(F.max("l_returnflag").alias("body")).select("doc_id", F.lit("pages").alias("block"), "body")
    return records.replace_blocks(blocks, own, {"pages": ("alto",)}, "alto")[0]


@query(
    """SELECT o_orderkey AS doc_id, '{"doc_id":"' || o_orderkey || '","pages":' || o_shippriority || ',"lines":{"status":"' || o_orderstatus || '"},"extra":"' || o_orderpriority || '"}' AS record
FROM (SELECT *, length(o_orderpriority) AS o_shippriority FROM orders)"""
)
def record_json(spark, sf_dir):
    bodies = F.create_map(F.lit("extra"), F.concat(F.lit('"'), "o_orderpriority", F.lit('"')), F.lit("lines"), F.to_json(F.struct(F.col("o_orderstatus").alias("status"))), F.lit("pages"), F.length("o_orderpriority").cast("string"))
    blocks = table(spark, sf_dir, "orders").select(F.col("o_orderkey").cast("string").alias("doc_id"), F.explode(bodies).alias("block", "body"))
    return records.record_json(blocks).select(F.col("doc_id").cast("bigint").alias("doc_id"), "record")


def _translated(spark, sf_dir):
    """The terms with an English label for parts and none for the others."""
    english = F.when(F.col("source") == "a", F.upper("label"))
    none = F.lit(None).cast("string")
    return _terms(spark, sf_dir).select("*", english.alias("label_en"), none.alias("uri"), F.lit(None).cast("array<string>").alias("broader"), F.lit(None).cast("int").alias("sort"))


@query(f"WITH {_TERMS} SELECT source, count(*) AS records, count(*) FILTER (source <> 'a') AS without_en, count(DISTINCT scheme) AS roots FROM t GROUP BY source")
def harvest_meta(spark, sf_dir):
    return vocabulary.harvest_meta(_translated(spark, sf_dir))


@query(f"WITH {_TERMS} SELECT lower(label) AS source_lemma, upper(label) AS target_translation FROM t WHERE source = 'a'")
def glossary_terms(spark, sf_dir):
    return vocabulary.glossary(_translated(spark, sf_dir))


@query(
    f"""WITH {_TERMS} SELECT lower(label) AS source_lemma, CASE WHEN source = 'a' THEN upper(label) ELSE '' END AS target_translation, source, source_id, '' AS uri, coalesce(scheme, '') AS scheme,
coalesce(sub, '') AS sub, '' AS broader, '' AS sort FROM t"""
)
def flat_vocabulary(spark, sf_dir):
    return vocabulary.flat_rows(_translated(spark, sf_dir))


@query(
    f"""WITH v(term, en) AS (VALUES {", ".join(f"('{t}', '{e}')" for t, e, _ in _LEXICON)}), i AS (SELECT doc_id, unnest(range(0, len(s))) AS pos, unnest(s) AS line FROM (SELECT doc_id, string_split(text, chr(10)) AS s FROM documents)),
h AS (SELECT doc_id, term, min(pos) AS pos FROM i JOIN v ON contains(lower(line), term) GROUP BY doc_id, term)
SELECT doc_id, CAST(row_number() OVER (PARTITION BY doc_id ORDER BY term) - 1 AS INT) AS pos, CAST(h.pos AS VARCHAR) AS page, term AS category, en AS keywords_en, 0.5::DOUBLE AS confidence FROM h JOIN v USING (term)"""
)
def enrich_documents_lexical(spark, sf_dir):
    """One reply per whole document: each term that occurs, with the first line that has it."""
    lexicon = sorted((t, e) for t, e, _ in _LEXICON)

    def reply(prompts):
        for prompt in prompts:
            rows = prompt.removeprefix("DOCUMENT:\n").lower().split("\n")
            first = [(t, e, next((k for k, line in enumerate(rows) if t in line), None)) for t, e in lexicon]
            yield json.dumps({"items": [{"locator": t, "page": str(k), "keywords": [t], "keywords_en": [e], "category": t, "confidence": 0.5} for t, e, k in first if k is not None]})

    categories = enrich.vocabulary_categories(spark, [t for t, _ in lexicon])
    items, _ = enrich.enrich_documents(table(spark, sf_dir, "documents"), reply, categories, "doc_id")
    return items.select("doc_id", "pos", "page", "category", F.array_join("keywords_en", ",").alias("keywords_en"), "confidence")


# records, runs, markup ------------------------------------------------------------------------

_SCHEMA = {
    "type": "object",
    "required": ["doc_id", "text", "summary"],
    "properties": {
        "doc_id": {"type": "string", "pattern": "^[0-9]+$"},
        "lang": {"enum": ["de", "en", "fr"]},
        "source": {"type": "object", "required": ["name"], "properties": {"name": {"type": "string", "pattern": "^src[0-9]$"}}, "additionalProperties": False},
        "n_chars": {"type": "integer", "minimum": 100, "exclusiveMaximum": 9000},
        "lines": {"type": "array", "maxItems": 40, "items": {"$ref": "#/$defs/line"}},
    },
    "$defs": {"line": {"type": "object", "required": ["text"], "properties": {"text": {"type": "string", "minLength": 3}, "n": {"type": "integer", "minimum": 1}}}},
}


@query(
    r"""WITH d AS (SELECT doc_id, text, lang, source, n_chars, string_split(text, chr(10)) AS l FROM documents),
v AS (SELECT doc_id, '$.summary:required' AS violation FROM d
UNION ALL SELECT doc_id, '$.lang:enum' FROM d WHERE lang NOT IN ('de', 'en', 'fr')
UNION ALL SELECT doc_id, '$.source.name:pattern' FROM d WHERE NOT regexp_matches(source, '^src[0-9]$')
UNION ALL SELECT doc_id, '$.source.n:additionalProperties' FROM d WHERE n_chars % 2 = 0
UNION ALL SELECT doc_id, '$.n_chars:minimum' FROM d WHERE n_chars < 100
UNION ALL SELECT doc_id, '$.n_chars:exclusiveMaximum' FROM d WHERE n_chars >= 9000
UNION ALL SELECT doc_id, '$.n_chars:type' FROM d WHERE n_chars % 5 = 0
UNION ALL SELECT doc_id, '$.lines:maxItems' FROM d WHERE len(l) > 40
UNION ALL SELECT doc_id, '$.lines[' || i - 1 || '].text:minLength' FROM (SELECT doc_id, l, unnest(range(1, len(l) + 1)) AS i FROM d) WHERE length(l[i]) < 3
UNION ALL SELECT doc_id, '$.lines[' || i - 1 || '].n:minimum' FROM (SELECT doc_id, l, unnest(range(1, len(l) + 1)) AS i FROM d) WHERE length(l[i]) = 0)
SELECT doc_id, violation FROM v"""
)
def schema_violations(spark, sf_dir):
    """Documents as nested JSON records against a schema with references and nested arrays."""
    docs = table(spark, sf_dir, "documents")
    line = F.transform(F.split("text", "\n"), lambda t: F.struct(t.alias("text"), F.length(t).alias("n")))
    source = F.when(F.col("n_chars") % 2 == 0, F.to_json(F.struct(F.col("source").alias("name"), F.lit(1).alias("n")))).otherwise(F.to_json(F.struct(F.col("source").alias("name"))))
    n = F.when(F.col("n_chars") % 5 == 0, F.concat(F.col("n_chars").cast("string"), F.lit(".5"))).otherwise(F.col("n_chars").cast("string"))
    quoted = F.to_json(F.struct(F.col("doc_id").cast("string").alias("doc_id"), "text", "lang", line.alias("lines")))
    record = F.concat(F.substr(quoted, F.lit(1), F.length(quoted) - 1), F.lit(',"source":'), source, F.lit(',"n_chars":'), n, F.lit("}"))
    broken = schema_gate.schema_violations(_SCHEMA, F.parse_json(record))
    return docs.select("doc_id", F.explode(broken).alias("violation"))


@query(
    """WITH e AS (SELECT 'skip' AS kind, 'short' AS name, count(*) AS n FROM documents WHERE n_chars < 500
UNION ALL SELECT 'output', lang, count(*) FROM documents WHERE n_chars >= 500 GROUP BY lang
UNION ALL SELECT 'output', 'long', count(*) FROM documents WHERE n_chars >= 3000
UNION ALL SELECT 'total', 'processed', count(*) FROM documents WHERE n_chars >= 500
UNION ALL SELECT 'total', 'inputs', count(*) FROM documents)
SELECT kind, name, n FROM e WHERE n > 0"""
)
def run_log_totals(spark, sf_dir):
    """A run of one step for each language, broken off after the second and opened again, summed up from its events."""
    folder = f"{checkpoint_dir(spark).rstrip('/')}/run-{uuid.uuid4().hex}"
    docs = table(spark, sf_dir, "documents")
    long = F.col("n_chars") >= 500
    log = run_log.RunLog(spark, f"{folder}/log", "catalogue", {"least": 500})
    langs = sorted(r[0] for r in docs.select("lang").distinct().collect())
    for k, lang in enumerate(langs):
        log = run_log.RunLog.of_state(spark, log.state()) if k == 2 else log
        for _ in range(1 + (k == 1)):  # the second is asked for twice and written once
            log.write(lang, lambda lang=lang: docs.where(F.col("lang") == lang), f"{folder}/{lang}", {lang: long, "long": F.col("n_chars") >= 3000}, documents=long, skipped=~long, file="doc_id", reason=F.lit("short"))
    events = log.own_events()
    parts = events.where("kind in ('skip', 'output')").groupBy("kind", F.when(F.col("kind") == "skip", F.col("value")).otherwise(F.col("name")).alias("name")).agg(F.sum("n").alias("n"))
    total = log.statistics().select(F.lit("total").alias("kind"), F.inline(F.array(F.struct(F.lit("processed").alias("name"), F.col("processed").alias("n")), F.struct(F.lit("inputs").alias("name"), F.col("inputs").alias("n")))))
    return parts.unionByName(total).where("n > 0")


_TOKENS = r"""l AS (SELECT doc_id, unnest(range(0, len(s))) AS sent, unnest(s) AS line FROM (SELECT doc_id, string_split(text, chr(10)) AS s FROM documents)),
t AS (SELECT doc_id, sent, list_filter(string_split(line, ' '), lambda w: w <> '') AS w FROM l),
s AS (SELECT doc_id, sent, sent // 5 + 1 AS page, 'b' || sent // 2 AS block, w FROM t WHERE len(w) > 0),
o AS (SELECT *, lag(page, 1, 0) OVER (PARTITION BY doc_id ORDER BY sent) AS before, lag(block) OVER (PARTITION BY doc_id ORDER BY sent) AS last FROM s)"""


@query(
    f"""WITH {_TOKENS} SELECT doc_id, CAST(sum(len(w)) AS BIGINT) AS n_tok, count(*) AS n_s, count(*) AS n_lb, count(*) FILTER (page <> before) AS n_pb, count(*) FILTER (page <> before OR block IS DISTINCT FROM last) AS n_div,
  CAST(sum((len(w) + 3) // 4) AS BIGINT) AS n_name, CAST(sum(list_sum([length(x) for x in w])) AS BIGINT) AS n_form_chars FROM o GROUP BY doc_id"""
)
def teitok_documents(spark, sf_dir):
    """Documents written as TEITOK XML and read back: a sentence a line, five to a page, a name of up to two words in every four."""
    words = lambda line: F.filter(F.split(line, " "), lambda w: w != "")
    token = lambda w, k: F.struct(w.alias("form"), F.when(k % 4 == 0, "B-gu").when(k % 4 == 1, "I-gu").otherwise("O").alias("ner"))
    place = lambda i: ((F.floor(i / 5) + 1).cast("int").alias("page_num"), F.concat(F.lit("b"), F.floor(i / 2).cast("string")).alias("block_id"), F.concat(F.lit("l"), i.cast("string")).alias("line_id"))
    sents = F.transform(F.split("text", "\n"), lambda line, i: F.struct(F.transform(words(line), token).alias("tokens"), *place(i)))
    xml = teitok.write_documents(table(spark, sf_dir, "documents").select(F.col("doc_id").alias("doc"), sents.alias("sents")))
    # two passes over a text; every & begins an entity, so forms can be joined before entities are read
    found = lambda pattern: F.regexp_extract_all("xml", F.lit(pattern), F.lit(1))
    read = xml.select(F.col("doc").alias("doc_id"), found("<tok[^>]*>([^<]*)</tok>").alias("forms"), found("<(s|lb|pb|div|name)[ >]").alias("tags"))
    n = lambda tag: F.size(F.filter("tags", lambda t: t == tag)).cast("bigint").alias(f"n_{tag}")
    plain = F.array_join("forms", "")
    for entity, sign in (("&lt;", "<"), ("&gt;", ">"), ("&quot;", '"'), ("&amp;", "&")):
        plain = F.replace(plain, F.lit(entity), F.lit(sign))
    return read.select("doc_id", F.size("forms").cast("bigint").alias("n_tok"), *map(n, ("s", "lb", "pb", "div", "name")), F.length(plain).cast("bigint").alias("n_form_chars"))


@query(
    r"""WITH t AS (SELECT conv_id, turn, role, trim(regexp_replace(regexp_replace(text, '[^\x00-\x7F]', '#', 'g'), '\s+', ' ', 'g')) AS x FROM conversations),
g AS (SELECT conv_id, turn, x AS ref FROM t WHERE role = 'user'), m AS (SELECT unnest(['assistant', 'none']) AS model),
p AS (SELECT 'assistant' AS model, conv_id, turn - 1 AS turn, x AS hyp FROM t WHERE role = 'assistant'),
s AS (SELECT m.model, CASE WHEN g.turn % 4 = 0 THEN 'early' ELSE 'late' END AS tier, ref, hyp FROM g CROSS JOIN m LEFT JOIN p ON p.model = m.model AND p.conv_id = g.conv_id AND p.turn = g.turn),
d AS (SELECT model, tier, hyp IS NULL AS missing, levenshtein(ref, hyp) AS e, length(ref) AS r, length(hyp) AS h FROM s),
c AS (SELECT model, tier, missing, CASE WHEN missing THEN NULL WHEN r = 0 THEN CASE WHEN h = 0 THEN 0.0 ELSE 1.0 END ELSE e / r END AS cer, CASE WHEN missing THEN NULL WHEN greatest(r, h) = 0 THEN 0.0 ELSE e / greatest(r, h) END AS ned FROM d),
a AS (SELECT model, coalesce(tier, 'overall') AS tier, count(*) AS n_pages, avg(cer) AS cer, avg(ned) AS ned FROM c WHERE cer IS NOT NULL GROUP BY GROUPING SETS ((model, tier), (model))),
n AS (SELECT model, count(*) FILTER (missing) AS n_missing FROM c GROUP BY model),
o AS (SELECT model, tier FROM a UNION SELECT model, 'overall' FROM m)
SELECT o.model, o.tier, coalesce(n_pages, 0) AS n_pages, round(cer, 9) AS cer, round(ned, 9) AS ned, CASE WHEN o.tier = 'overall' THEN coalesce(n_missing, 0) END AS n_missing
FROM o LEFT JOIN a ON a.model = o.model AND a.tier = o.tier LEFT JOIN n ON n.model = o.model"""
)
def scored_pages(spark, sf_dir):
    """Pages scored from their texts to the corpus: gold and predicted texts, a model without predictions, missing pages.

    Letters beyond ASCII are one sign here, as the SQL engine counts distances in bytes.
    """
    sign = F.regexp_replace("text", r"[^\x00-\x7F]", "#").alias("text")
    turns = table(spark, sf_dir, "conversations").select(F.col("conv_id").alias("file"), "turn", "role", sign)
    gold = turns.where("role = 'user'").select("file", F.col("turn").alias("page_num"), "text")
    manifest = gold.select("file", "page_num", F.when(F.col("page_num") % 4 == 0, "early").otherwise("late").alias("tier"))
    predicted = turns.where("role = 'assistant'").select(F.lit("assistant").alias("model"), "file", (F.col("turn") - 1).alias("page_num"), "text")
    models = spark.createDataFrame([("assistant",), ("none",)], "model string")
    scored = evaluation.score_pages(manifest, gold, predicted, models)
    out = evaluation.with_idle_models(evaluation.corpus_scores(scored), models, scored)
    return out.select("model", "tier", F.col("n_pages").cast("bigint").alias("n_pages"), F.round("cer", 9).alias("cer"), F.round("ned", 9).alias("ned"), "n_missing")
