"""Helpers shared by the training-data operators."""

from __future__ import annotations

import ctypes
import gc
import sys
from collections.abc import Callable, Iterator, Sequence

import pyarrow as pa
from pyspark.sql import Column, DataFrame, SparkSession
from pyspark.sql import functions as F
from pyspark.sql import types as T
from pyspark.sql.window import Window

#: Words of the contracts: runs of anything but ASCII white space.
WORD = r"[^\x20\x09-\x0D]+"
SPACE = r"[\x20\x09-\x0D]+"

#: Keys a group is spread over before it meets its own totals.
SALTS = 1024

Batches = Iterator[pa.RecordBatch]


def table(spark: SparkSession, sf_dir: str, name: str) -> DataFrame:
    return spark.read.parquet(f"{sf_dir}/{name}.parquet")


def fold(remainder: int, of: int = 5) -> Column:
    """True where crc32 of the document's id, as text, leaves the remainder (null id: empty text)."""
    text = F.coalesce(F.col("doc_id").cast("string"), F.lit(""))
    return F.pmod(F.crc32(text.cast("binary")), F.lit(of)) == remainder


def utf8(column: str | Column = "text") -> Column:
    """The text as UTF-8 bytes, null as empty."""
    column = F.col(column) if isinstance(column, str) else column
    return F.coalesce(column.cast("binary"), F.lit(b""))


def map_rows(df: DataFrame, make: Callable[[], Callable], schema: T.StructType | str) -> DataFrame:
    """``mapInArrow`` with a function from a batch's columns (lists by name) to output columns.

    ``make`` runs once per task and returns that function, so models are set up once.
    """
    kind = T._parse_datatype_string(schema) if isinstance(schema, str) else schema
    arrow = to_arrow(kind)

    def run(batches: Batches) -> Batches:
        work = make()
        for batch in batches:
            if batch.num_rows:
                out = work({n: batch.column(n).to_pylist() for n in batch.schema.names})
                yield pa.RecordBatch.from_arrays(
                    [pa.array(out[f.name], f.type) for f in arrow], schema=arrow
                )
                del batch, out
        del work
        give_back()

    return df.mapInArrow(run, kind)


def to_arrow(schema: T.StructType | str) -> pa.Schema:
    from pyspark.sql.pandas.types import to_arrow_schema

    kind = T._parse_datatype_string(schema) if isinstance(schema, str) else schema
    return to_arrow_schema(kind)


def give_back() -> None:
    """Return freed memory to the system: Python workers outlive their tasks beside the JVM."""
    gc.collect()
    pa.default_memory_pool().release_unused()
    if sys.platform == "linux":
        trim = getattr(ctypes.CDLL(None), "malloc_trim", None)
        if trim is not None:
            trim(0)


def same(left: DataFrame, right: DataFrame, names: Sequence[str]) -> Column:
    """Null-safe equality of columns, for joins."""
    out = F.lit(True)
    for n in names:
        out = out & left[n].eqNullSafe(right[n])
    return out


def with_group(
    df: DataFrame, keys: Sequence[str], row_hash: Column, partial: dict[str, Column], total: dict[str, Column]
) -> DataFrame:
    """Attach a group's totals to its rows without ever gathering the group.

    ``partial`` aggregates rows by key and salt, ``total`` the partial rows by key (their
    columns carry the names of ``partial``). Key columns must not be null.
    """
    salted = df.withColumn("_salt", F.pmod(row_hash, F.lit(SALTS)).cast("int"))
    parts = salted.groupBy(*keys, "_salt").agg(*(c.alias(n) for n, c in partial.items()))
    totals = parts.groupBy(*keys).agg(*(c.alias(n) for n, c in total.items()))
    back = parts.select(*keys, "_salt").join(totals, list(keys))
    return salted.join(back, [*keys, "_salt"]).drop("_salt")


def running_total(df: DataFrame, group: str, bin_: str, order: Sequence[str | Column], value: str, out: str,
                  also: DataFrame | None = None) -> DataFrame:
    """Sum of ``value`` over the rows before, in the order of (bin, order), within the group.

    Two levels: sums of bins are accumulated first, then the rows inside each bin, so a
    group is never gathered. ``also`` has further columns of the group to attach.
    """
    bins = df.groupBy(group, bin_).agg(F.sum(value).alias("_sum"))
    before = Window.partitionBy(group).orderBy(bin_).rowsBetween(Window.unboundedPreceding, -1)
    bins = bins.select(group, bin_, F.coalesce(F.sum("_sum").over(before), F.lit(0)).alias("_base"))
    if also is not None:
        bins = bins.join(also, group)
    inside = Window.partitionBy(group, bin_).orderBy(*order).rowsBetween(Window.unboundedPreceding, -1)
    return (
        df.withColumn("_inside", F.coalesce(F.sum(value).over(inside), F.lit(0)))
        .join(bins, [group, bin_])
        .withColumn(out, (F.col("_base") + F.col("_inside")).cast("long"))
        .drop("_base", "_inside")
    )
