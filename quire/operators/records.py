"""Document records as tables: field-level merges, fan-in, ownership, originators and schema checks."""

from __future__ import annotations

from dataclasses import dataclass, field

from pyspark.sql import Column, DataFrame, Window
from pyspark.sql import functions as F


def merge_fields(base: DataFrame, incoming: DataFrame, keys: list[str], owned: list[str], present: str | None = None) -> DataFrame:
    """Upsert ``incoming`` into ``base``: only ``owned`` fields are written, new keys are appended.

    ``present`` names an array column with the fields an incoming row brings (all if None): a field
    that is present and null overwrites, one that is absent doesn't. Repeated incoming keys are
    applied in order of ``ordinal`` where there is one, the last write of each field counting.
    """
    fields = [c for c in owned if c in incoming.columns]
    has = (lambda c: F.array_contains(F.col(present), c)) if present else (lambda c: F.lit(True))
    order = F.col("ordinal") if "ordinal" in incoming.columns else F.lit(0)
    patches = incoming.groupBy(*keys).agg(*(F.max(F.when(has(c), F.struct(order.alias("o"), F.col(c).alias("v")))).alias(f"__{c}") for c in fields), F.lit(True).alias("__in"))
    both = base.withColumn("__old", F.lit(True)).join(patches, keys, "full")
    cols = []
    for c in base.columns:
        if c in keys:
            cols.append(F.col(c))
        elif c in fields:
            cols.append(F.when(F.col(f"__{c}").isNotNull(), F.col(f"__{c}.v")).otherwise(F.col(c)).alias(c))
        else:
            cols.append(F.col(c))
    return both.select(*cols, F.when(F.col("__old").isNull(), "added").when(F.col("__in"), "patched").otherwise("kept").alias("change"))


def dropped_fields(present: Column, owned: list[str], keys: list[str]) -> Column:
    """Fields a writer brought but may not write."""
    return F.array_except(present, F.array(*map(F.lit, [*owned, *keys])))


def fan_in(blocks: DataFrame, by: tuple[str, ...] = ("doc_id", "block"), updated: str = "updated_at", ordinal: str = "ordinal") -> DataFrame:
    """Of every block the newest version, the text of the time stamp deciding, ties going to the lowest ordinal."""
    rest = [c for c in blocks.columns if c not in by]
    newest = F.max_by(F.struct(*rest), F.struct(F.col(updated), -F.col(ordinal)))
    return blocks.groupBy(*by).agg(newest.alias("__b")).select(*by, *(F.col(f"__b.{c}").alias(c) for c in rest))


def first_writer(sources: DataFrame, key: str, fields: list[str], ordinal: str = "ordinal") -> DataFrame:
    """Per key: each field's first non-null value by ordinal, and ``conflicts``: fields with several values."""
    firsts = [F.min(F.when(F.col(c).isNotNull(), F.struct(F.col(ordinal).alias("o"), F.col(c).alias("v")))).alias(f"__{c}") for c in fields]
    several = [F.when(F.count_distinct(c) > 1, F.lit(c)).alias(f"__n_{c}") for c in fields]
    out = sources.groupBy(key).agg(*firsts, *several)
    return out.select(key, *(F.col(f"__{c}.v").alias(c) for c in fields), F.array_compact(F.array(*(F.col(f"__n_{c}") for c in fields))).alias("conflicts"))


#: Which kind of program may originate a document, by prefix of its origin.
ORIGINS = (("ocr:", "ocr"), ("alto", "ocr"), ("digital-born", "converter"), ("docx", "converter"), ("pdf", "converter"))


def originator(origin: Column) -> Column:
    """The originator that an origin authorises, matched by prefix without regard to case; null: no opinion."""
    low = F.lower(origin)
    out = F.when(low.startswith(ORIGINS[0][0]), ORIGINS[0][1])
    for prefix, kind in ORIGINS[1:]:
        out = out.when(low.startswith(prefix), kind)
    return out


def origin_conflicts(stamps: DataFrame, sources: DataFrame, pages: DataFrame, positional: tuple[str, ...] = ("pages", "lines", "content", "tables")) -> DataFrame:
    """Positional blocks written by another originator than the document's origin allows.

    A converted document with a page that needs OCR may be handed over, so it has no conflict.
    """
    handed = pages.groupBy("doc_id").agg(F.coalesce(F.bool_or("needs_ocr"), F.lit(False)).alias("handed"))
    joined = stamps.where(F.col("block").isin(*positional)).join(sources.select("doc_id", originator(F.col("origin")).alias("allowed")), "doc_id").join(handed, "doc_id", "left")
    wrong = F.col("allowed").isNotNull() & (F.col("kind") != F.col("allowed"))
    excused = (F.col("allowed") == "converter") & (F.col("kind") == "ocr") & F.coalesce("handed", F.lit(False))
    return joined.where(wrong & ~excused).select("doc_id", "block", "kind", "allowed")


@dataclass(frozen=True)
class Rule:
    """What a column must satisfy; unset limits don't apply."""

    column: str
    required: bool = False
    one_of: tuple = ()
    least: float | None = None
    most: float | None = None
    pattern: str | None = None
    size: int | None = None


@dataclass(frozen=True)
class Schema:
    rules: tuple[Rule, ...] = field(default_factory=tuple)


def violations(schema: Schema) -> Column:
    """The broken rules of a row, as ``column:rule`` strings; a null passes all but ``required``."""
    checks = []
    for r in schema.rules:
        c = F.col(r.column)
        if r.required:
            checks.append((c.isNull(), f"{r.column}:required"))
        if r.one_of:
            checks.append((c.isNotNull() & ~c.isin(*r.one_of), f"{r.column}:enum"))
        if r.least is not None:
            checks.append((c < r.least, f"{r.column}:minimum"))
        if r.most is not None:
            checks.append((c > r.most, f"{r.column}:maximum"))
        if r.pattern:
            checks.append((~c.rlike(r.pattern), f"{r.column}:pattern"))
        if r.size is not None:
            checks.append((F.size(c) != r.size, f"{r.column}:size"))
    return F.array_compact(F.array(*(F.when(F.coalesce(bad, F.lit(False)), F.lit(name)) for bad, name in checks)))


def page_ordinals(pages: DataFrame) -> DataFrame:
    """``pages`` (doc_id, page label, page_index, first_seen) with ``ordinal``, their order in the document.

    All labels numeric: by number. Else a complete and unique ``page_index``: by that. Else by first
    appearance.
    """
    doc = Window.partitionBy("doc_id")
    n = F.count("*").over(doc)
    numeric = F.min(F.col("page").rlike("^[0-9]+$").cast("int")).over(doc) == 1
    indexed = (F.count("page_index").over(doc) == n) & (F.size(F.collect_set("page_index").over(doc)) == n)
    key = F.when(numeric, F.col("page").try_cast("bigint")).when(indexed, F.col("page_index").cast("bigint")).otherwise(F.col("first_seen").cast("bigint"))
    return pages.withColumn("__key", key).withColumn("ordinal", F.row_number().over(doc.orderBy("__key", "first_seen", "page"))).drop("__key")


def inherit_ids(derived: DataFrame, baseline: DataFrame, key: str = "path") -> DataFrame:
    """Inputs with the id under which their record is kept, and ``note`` where that isn't the derived one.

    ``derived``: (key, doc_id) from file names; ``baseline``: the same from the records handed over. A
    baseline's id wins, as all its blocks are filed under it; without one the derived id counts.
    """
    known = baseline.where(F.coalesce("doc_id", F.lit("")) != "").groupBy(key).agg(F.min("doc_id").alias("__id"))
    kept = F.coalesce("__id", "doc_id")
    note = F.when(F.col("__id") != F.col("doc_id"), F.concat(F.lit("derived "), "doc_id", F.lit(", kept "), "__id"))
    return derived.join(known, key, "left").withColumn("note", note).withColumn("had_baseline", F.col("__id").isNotNull()).withColumn("doc_id", kept).drop("__id")


def replace_blocks(blocks: DataFrame, own: DataFrame, owners: dict[str, tuple[str, ...]], program: str) -> tuple[DataFrame, DataFrame]:
    """(blocks, complaints): ``own`` blocks (doc_id, block, ...) take the place of those of the same name.

    ``owners`` lists the programs that may write a block; others are let through with a complaint, as
    a caller may be strict or not. Blocks without an entry belong to anyone.
    """
    allowed = F.lit(True)
    for block, programs in owners.items():
        allowed = allowed & ((F.col("block") != block) | F.lit(program in programs))
    complaints = own.where(~allowed).select("doc_id", "block", F.concat(F.lit("not owned by "), F.lit(program)).alias("complaint"))
    rest = blocks.join(own.select("doc_id", "block").distinct(), ["doc_id", "block"], "left_anti")
    return rest.unionByName(own, allowMissingColumns=True), complaints


def accrete(entries: DataFrame, by: tuple[str, ...] = ("doc_id", "kind", "key"), value: str = "value", ordinal: str = "ordinal") -> DataFrame:
    """Sources, recipes and licence parts that stages add to a record: of equal keys the last one counts."""
    return entries.groupBy(*by).agg(F.max_by(value, F.struct(ordinal, value)).alias(value))


def contributors(stamps: DataFrame) -> DataFrame:
    """One row per document, program and run with the blocks it wrote, in order of the first write, and its time.

    ``stamps``: (doc_id, program, run_id, block, updated_at, ordinal).
    """
    first = stamps.groupBy("doc_id", "program", "run_id", "block").agg(F.min("ordinal").alias("o"), F.max("updated_at").alias("u"))
    names = F.transform(F.array_sort(F.collect_list(F.struct("o", "block"))), lambda s: s["block"])
    return first.groupBy("doc_id", "program", "run_id").agg(F.array_join(names, ",").alias("blocks"), F.max("u").alias("updated_at"))


# The order of a record's keys; others follow in order of their names.
RECORD_KEYS = (
    "schema_version", "record_type", "doc_id", "source", "derived_from", "regenerable", "provenance", "assembled", "page_categories",
    "pages", "content", "lines", "tables", "entities", "translations", "enrichment", "forms",
)


def record_json(blocks: DataFrame) -> DataFrame:
    """(doc_id, record): every document's blocks (doc_id, block, body as JSON) as one JSON object in the order of keys.

    Blocks whose body is null are left out; unknown ones are kept, last. Write it with ``.write.text``,
    partitioned by ``doc_id``: Spark's committer leaves no half-written file.
    """
    place = F.array_position(F.array(*map(F.lit, RECORD_KEYS)), F.col("block"))
    rank = F.when(place > 0, place).otherwise(len(RECORD_KEYS) + 1)
    text = F.concat(F.to_json(F.array("block")).substr(F.lit(2), F.length(F.to_json(F.array("block"))) - 2), F.lit(":"), F.col("body"))
    body = blocks.where((F.col("block") != "doc_id") & F.col("body").isNotNull()).select("doc_id", rank.alias("r"), "block", text.alias("t"))
    own = F.concat(F.lit('"doc_id":'), F.to_json(F.array("doc_id")).substr(F.lit(2), F.length(F.to_json(F.array("doc_id"))) - 2))
    ids = blocks.select("doc_id").distinct().select("doc_id", F.lit(RECORD_KEYS.index("doc_id") + 1).cast("bigint").alias("r"), F.lit("doc_id").alias("block"), own.alias("t"))
    parts = F.transform(F.array_sort(F.collect_list(F.struct("r", "block", "t"))), lambda p: p["t"])
    return body.unionByName(ids).groupBy("doc_id").agg(F.concat(F.lit("{"), F.array_join(parts, ","), F.lit("}")).alias("record"))


def digital_blocks(pages: DataFrame, lines: DataFrame) -> DataFrame:
    """(doc_id, block, body): pages, lines and the whole text of converted documents as JSON blocks.

    ``pages``: (doc_id, page, ordinal, ...), ``lines``: (doc_id, row_idx, page, text, ...); a block has
    all further columns of its rows, nulls left out. Texts are joined by line breaks.
    """

    def rows(df: DataFrame, order: str, name: str) -> DataFrame:
        row = F.struct(F.col(order).alias("__o"), F.to_json(F.struct(*(c for c in df.columns if c != "doc_id"))).alias("j"))
        listed = F.transform(F.array_sort(F.collect_list(row)), lambda r: r["j"])
        return df.groupBy("doc_id").agg(F.concat(F.lit("["), F.array_join(listed, ","), F.lit("]")).alias("body")).select("doc_id", F.lit(name).alias("block"), "body")

    said = F.transform(F.array_sort(F.collect_list(F.struct("row_idx", "text"))), lambda r: r["text"])
    text = lines.groupBy("doc_id").agg(F.array_join(said, "\n").alias("text")).select("doc_id", F.lit("content").alias("block"), F.to_json(F.struct("text")).alias("body"))
    return rows(pages, "ordinal", "pages").unionByName(rows(lines, "row_idx", "lines")).unionByName(text)
