"""Helpers shared by the training-data operators."""

from __future__ import annotations

from collections.abc import Callable, Hashable, Iterator

import pyarrow as pa
from pyspark.sql import Column, DataFrame, SparkSession
from pyspark.sql import functions as F
from pyspark.sql.types import StringType

from quire.session import cut_lineage, discard, materialise

__all__ = ["bucket_of", "compact", "cut_lineage", "discard", "in_bitmap", "keep_nothing", "kept", "map_texts", "materialise", "table"]

#: Bits of the filters that keep rows without a partner out of an exchange.
BITMAP = 25
#: Texts that a worker takes at a time, whatever the size of an Arrow batch.
TEXTS = 256
#: Rows of a partition of what few lines have left, and the least number of its partitions.
ROWS, PARTITIONS = 5000, 8


#: What a Python worker keeps from one task to the next.
_KEPT: dict[Hashable, object] = {}


def kept(key: Hashable, make: Callable[[], object]) -> object:
    """What ``make`` gives, kept for later tasks of this worker until another operator's tasks come.

    Workers outlive stages: what each operator remembers would stay beside what all later ones need.
    """
    if key not in _KEPT:
        keep_nothing()
        _KEPT[key] = make()
    return _KEPT[key]


def keep_nothing() -> None:
    """For tasks that remember nothing themselves."""
    if _KEPT:
        _KEPT.clear()
        pa.default_memory_pool().release_unused()


def table(spark: SparkSession, sf_dir: str, name: str) -> DataFrame:
    return spark.read.parquet(f"{sf_dir}/{name}.parquet")


def bucket_of(doc_id: Column, n: int) -> Column:
    """crc32 of the id as text, modulo ``n``; null for a null id."""
    return F.crc32(doc_id.cast("string").cast("binary")) % n


def in_bitmap(keys: DataFrame, key: str, rows: DataFrame, within: bool = True) -> DataFrame:
    """The ``rows`` whose ``key`` may be among ``keys``, by a bitmap of ``2^BITMAP`` hash bits; else the ones that can't be.

    The bitmap is at most ``2^(BITMAP-15)`` rows of 4 KB and is broadcast; it lets no wanted row go
    and spares most of the others the exchange of the exact join that follows. With more keys than
    bits it spares fewer, and the exact join gives the same result.
    """
    slot = lambda c: F.col(c).bitwiseAND(F.lit((1 << BITMAP) - 1))
    page, bit = lambda c: F.shiftright(slot(c), 15).cast("int"), lambda c: slot(c).bitwiseAND(F.lit(32767))
    maps = keys.select(F.col(key).alias("__key")).groupBy(page("__key").alias("__page")).agg(F.bitmap_construct_agg(bit("__key")).alias("__bits"))
    byte = F.conv(F.hex(F.substr("__bits", F.shiftright(bit(key), 3).cast("int") + 1, F.lit(1))), 16, 10).cast("int")
    is_set = F.expr("1") == F.getbit(byte.cast("bigint"), bit(key).bitwiseAND(F.lit(7)).cast("int"))
    met = rows.withColumn("__page", page(key)).join(F.broadcast(maps), "__page", "inner" if within else "left")
    return met.where(is_set if within else ~F.coalesce(is_set, F.lit(False))).drop("__page", "__bits")


def compact(df: DataFrame) -> tuple[DataFrame, int]:
    """``df`` without its lineage and its rows; in fewer partitions if it has few rows, so that later exchanges don't have many empty tasks."""
    df = cut_lineage(df)
    rows = df.count()
    return df.coalesce(max(PARTITIONS, rows // ROWS)), rows


def map_texts(df: DataFrame, keep: list[str], text: str, schema: str, make: Callable[[], Callable[[list], dict[str, list]]]) -> DataFrame:
    """Apply a batch function over one text column, keeping the columns ``keep``.

    ``make()`` runs once per task and returns a function from a list of UTF-8 ``bytes``
    (None for null) to columns named in ``schema``. Only ``keep`` and ``text`` reach Python, a text that
    is kept only once, and the
    function gets ``TEXTS`` texts at most, so what it makes of them doesn't grow with the batch.
    """
    fields = [f"`{f.name}` {f.dataType.simpleString()}" for f in df.select(*keep).schema]
    whole = ", ".join([*fields, schema]) if schema else ", ".join(fields)
    own = text in keep and df.schema[text].dataType == StringType()
    src = df.select(*keep) if own else df.select(*keep, F.col(text).cast("string").alias("__text"))
    place = keep.index(text) if own else len(keep)
    new = [part.strip().split(" ")[0] for part in _split_top(schema)]
    kinds = _arrow_kinds(df.sparkSession, schema)

    def run(batches: Iterator[pa.RecordBatch]) -> Iterator[pa.RecordBatch]:
        apply = make()
        for batch in (whole.slice(at, TEXTS) for whole in batches for at in range(0, whole.num_rows, TEXTS)):
            got = apply(batch.column(place).cast(pa.binary()).to_pylist())
            arrays = [batch.column(i) for i in range(len(keep))]
            arrays += [got[n] if isinstance(got[n], (pa.Array, pa.ChunkedArray)) else pa.array(got[n], kinds[n]) for n in new]
            yield pa.RecordBatch.from_arrays(arrays, names=[*keep, *new])

    return src.mapInArrow(run, whole)


def _split_top(schema: str) -> list[str]:
    parts, depth, start = [], 0, 0
    for i, c in enumerate(schema):
        depth += (c in "<(") - (c in ">)")
        if c == "," and not depth:
            parts.append(schema[start:i])
            start = i + 1
    return [*parts, schema[start:]]


def _arrow_kinds(spark: SparkSession, schema: str) -> dict[str, pa.DataType]:
    from pyspark.sql.pandas.types import to_arrow_schema
    from pyspark.sql.types import _parse_datatype_string

    return {f.name: f.type for f in to_arrow_schema(_parse_datatype_string(schema))}
