"""Measured sizes that decide whether a side may be broadcast."""

from __future__ import annotations

from pyspark.sql import Column, DataFrame
from pyspark.sql import functions as F

from ..config import BROADCAST_BYTES


def measured_bytes(df: DataFrame, row_bytes: Column) -> int:
    """Total of ``row_bytes`` over the table; one aggregate, one row back."""
    return df.agg(F.coalesce(F.sum(row_bytes), F.lit(0)).cast("long")).first()[0]


def query_blocks(
    queries: DataFrame, key: str, row_bytes: Column, limit: int = BROADCAST_BYTES
) -> list[DataFrame]:
    """Cut a query table into blocks that were each measured to fit a broadcast.

    All rows of one key stay together. A set that fits is one block. A larger
    one is hashed into more blocks until the largest fits; each block then
    makes its own pass over the corpus, which costs no more comparisons in all
    than a single pass would.
    """
    total = measured_bytes(queries, row_bytes)
    if total <= limit:
        return [queries]
    n = 2 * -(-total // limit)
    while True:
        block = F.pmod(F.xxhash64(key), F.lit(n))
        largest = (
            queries.groupBy(block.alias("block"))
            .agg(F.sum(row_bytes).cast("long").alias("bytes"))
            .agg(F.max("bytes"))
            .first()[0]
        )
        if largest <= limit:
            return [queries.where(block == b) for b in range(n)]
        heaviest = measured_bytes_of_largest_key(queries, key, row_bytes)
        if heaviest > limit:
            raise ValueError(f"one query alone needs {heaviest} bytes, above the limit of {limit}")
        n *= 2


def measured_bytes_of_largest_key(queries: DataFrame, key: str, row_bytes: Column) -> int:
    sizes = queries.groupBy(key).agg(F.sum(row_bytes).cast("long").alias("bytes"))
    return sizes.agg(F.max("bytes")).first()[0]


def union_all(frames: list[DataFrame]) -> DataFrame:
    """UNION ALL of frames with the same columns."""
    result = frames[0]
    for frame in frames[1:]:
        result = result.unionByName(frame)
    return result
