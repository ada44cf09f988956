"""Corpus-wide look-ups of hashed keys, a chunk of documents at a time.

Documents are dealt into chunks of bounded size. A chunk sends each of its different keys once,
packed into one row per bucket of the key space; a bucket joins what all chunks sent and answers
every row with values in the same order. So a frequent key costs one entry per chunk, no table
is ever whole in one place, and the shuffle moves arrays instead of single keys.
"""

from __future__ import annotations

import zlib
from collections.abc import Callable

import numpy as np
import pyarrow as pa
from pyspark.sql import DataFrame
from pyspark.sql import functions as F

from .common import to_arrow

_K, _M = np.uint64(0x9E3779B97F4A7C15), np.uint64(0xD6E8FEB86659FD93)


def mix(values: np.ndarray) -> np.ndarray:
    """Scramble 64-bit values one to one."""
    values = (values ^ (values >> np.uint64(32))) * _M
    values = (values ^ (values >> np.uint64(32))) * _M
    return values ^ (values >> np.uint64(32))


def chain(first: np.ndarray, second: np.ndarray) -> np.ndarray:
    """A hash of two hashes, in order."""
    return mix(first * _K + second)


def pack(values: np.ndarray) -> bytes:
    """Unsigned values in the narrowest type that holds them, compressed."""
    values = np.asarray(values, np.uint64)
    top = int(values.max(initial=0))
    kind = next(k for k in "BHIQ" if top < 1 << (8 * np.dtype(k).itemsize))
    return kind.encode() + zlib.compress(values.astype(kind).tobytes(), 1)


def unpack(data: bytes) -> np.ndarray:
    return np.frombuffer(zlib.decompress(data[1:]), data[:1].decode()).astype(np.uint64)


def in_chunks(docs: DataFrame, count: int, *columns) -> DataFrame:
    """chunk, doc_id, the columns and the text as bytes (null: empty)."""
    chunk = F.pmod(F.xxhash64("doc_id", "text"), F.lit(count)).alias("chunk")
    return docs.select(chunk, "doc_id", *columns, F.coalesce(F.col("text").cast("binary"), F.lit(b"")).alias("text"))


def text_bytes(docs: DataFrame) -> int:
    return int(docs.agg(F.sum(F.octet_length("text"))).first()[0] or 0)


class Buckets:
    """Splits hashed keys among ``count`` buckets: within a bucket, keys ascend."""

    def __init__(self, hashes: np.ndarray, count: int):
        bucket = (hashes >> np.uint64(40)) % np.uint64(count)
        self.order = np.lexsort((hashes, bucket))
        found, starts = np.unique(bucket[self.order], return_index=True)
        self.parts = dict(zip(found.tolist(), np.split(self.order, starts[1:])))

    def gather(self, rows: dict[int, np.ndarray], size: int) -> np.ndarray:
        """Values in the order of the hashes from the answers by bucket."""
        out = np.zeros(size, np.uint64)
        for bucket, values in rows.items():
            out[self.parts[bucket]] = values
        return out


SENT = "chunk long, kind int, bucket long, keys binary, counts binary"
ANSWERED = "chunk long, kind int, bucket long, answers binary"


def send(chunked: DataFrame, make: Callable, buckets: int) -> DataFrame:
    """Rows of SENT: ``make(table)`` yields (kind, hashes, counts) of a chunk."""
    schema = to_arrow(SENT)

    def run(key, table):
        rows = []
        for kind, hashes, counts in make(table):
            for bucket, at in Buckets(hashes, buckets).parts.items():
                rows.append((key[0].as_py(), kind, bucket, hashes[at].astype("<u8").tobytes(), pack(counts[at])))
        return pa.Table.from_arrays([pa.array(c, f.type) for c, f in zip(zip(*rows) if rows else [()] * 5, schema)], schema=schema)

    return chunked.groupBy("chunk").applyInArrow(run, SENT)


def answer(sent: DataFrame, make: Callable) -> DataFrame:
    """Rows of ANSWERED: ``make(kind, which, counts, row)`` gives a value for each entry of a bucket.

    ``which`` numbers the different keys among all entries, ``row`` the chunk an entry came from.
    """
    schema = to_arrow(ANSWERED)

    def run(key, table):
        kind, bucket = key[0].as_py(), key[1].as_py()
        rows = sorted(zip(table["chunk"].to_pylist(), table["keys"].to_pylist(), table["counts"].to_pylist()))
        keys = [np.frombuffer(k, "<u8") for _, k, _ in rows]
        counts = np.concatenate([unpack(c) for _, _, c in rows])
        lengths = [len(k) for k in keys]
        _, which = np.unique(np.concatenate(keys), return_inverse=True)
        values = make(kind, which, counts, np.repeat(np.arange(len(rows)), lengths))
        parts = np.split(values, np.cumsum(lengths)[:-1])
        columns = ([r[0] for r in rows], [kind] * len(rows), [bucket] * len(rows), [pack(p) for p in parts])
        return pa.Table.from_arrays([pa.array(c, f.type) for c, f in zip(columns, schema)], schema=schema)

    return sent.groupBy("kind", "bucket").applyInArrow(run, ANSWERED)


def answers_by_kind(table: pa.Table) -> dict[int, dict[int, np.ndarray]]:
    out: dict[int, dict[int, np.ndarray]] = {}
    for kind, bucket, data in zip(table["kind"].to_pylist(), table["bucket"].to_pylist(), table["answers"].to_pylist()):
        out.setdefault(kind, {})[bucket] = unpack(data)
    return out
