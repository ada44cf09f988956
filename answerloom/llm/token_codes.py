"""Token ids of documents in files of directly addressable codes.

An id is split into chunks of eight bits, lowest first. Level ``l`` holds the l-th chunk of all
ids that reach it, and a bitmap that tells which of them continue on the next level. A rank
directory holds the number of ones before every 512th bit, so any id is read by one look-up per
level, without decoding its neighbours.

A file is a Parquet table of shards in ascending doc_id order (uncompressed, so that a code is
where it says): part and seq order the shards, ``doc_ids`` and ``ends`` delimit the documents.

Defined results: a null text counts as empty; an empty text has its end id only; repeated ids
stand beside each other; null ids come first; an empty table gives no rows; other columns are
ignored. A document is never split: one longer than a shard is a shard of its own.
"""

from __future__ import annotations

import struct
import zlib
from itertools import chain

import numpy as np
import pyarrow as pa
from pyspark import TaskContext
from pyspark.sql import DataFrame, SparkSession
from pyspark.sql import functions as F

from ..session import new_path
from .common import give_back, map_rows, running_total, table, to_arrow
from .words import blocks, encoder, tokenizer_path

END = 2
TOKENIZER = "word_bpe_49k.json"
#: Ids of a shard, if its documents allow.
SHARD = 1 << 19
_BLOCK = 512  # bits per entry of the rank directory


# The code ----------------------------------------------------------------------


def encode(ids: np.ndarray) -> bytes:
    """Directly addressable codes of unsigned 32-bit ids."""
    ids = np.asarray(ids, np.uint32)
    levels = []
    rest = ids
    while True:
        more = rest > 255
        levels.append((rest.astype(np.uint8).tobytes(), more))
        if not more.any():
            break
        rest = rest[more] >> 8
    out = [struct.pack("<QI", len(ids), len(levels))]
    for chunks, more in levels:
        bits = np.packbits(more, bitorder="little")
        bits = np.concatenate([bits, np.zeros(-len(bits) % (_BLOCK // 8), np.uint8)])
        ones = np.bitwise_count(bits.reshape(-1, _BLOCK // 8)).sum(1, dtype=np.uint32)
        ranks = np.concatenate([np.zeros(1, np.uint32), np.cumsum(ones, dtype=np.uint32)])
        out += [struct.pack("<Q", len(chunks)), chunks, bits.tobytes(), ranks.astype("<u4").tobytes()]
    return b"".join(out)


class Codes:
    """Reads encoded ids: ``codes[i]`` goes straight to one id, ``all()`` returns every id."""

    def __init__(self, data: bytes):
        self.n, count = struct.unpack_from("<QI", data)
        at, self.levels = 12, []
        for _ in range(count):
            (n,) = struct.unpack_from("<Q", data, at)
            at += 8
            blocks = -(-n // _BLOCK)
            chunks = np.frombuffer(data, np.uint8, n, at)
            bits = np.frombuffer(data, np.uint8, blocks * (_BLOCK // 8), at + n)
            ranks = np.frombuffer(data, "<u4", blocks + 1, at + n + len(bits))
            at += n + len(bits) + 4 * len(ranks)
            self.levels.append((chunks, bits, ranks))

    def __len__(self) -> int:
        return self.n

    def __getitem__(self, i: int) -> int:
        if not 0 <= i < self.n:
            raise IndexError(i)
        value = 0
        for level, (chunks, bits, ranks) in enumerate(self.levels):
            value |= int(chunks[i]) << (8 * level)
            if not bits[i >> 3] >> (i & 7) & 1:
                return value
            block = i // _BLOCK
            before = bits[block * (_BLOCK // 8) : i >> 3]
            i = int(ranks[block]) + int(np.bitwise_count(before).sum()) + (int(bits[i >> 3]) & ((1 << (i & 7)) - 1)).bit_count()
        return value

    def all(self) -> np.ndarray:
        value = np.zeros(self.n, np.uint32)
        where = np.arange(self.n)
        for level, (chunks, bits, _) in enumerate(self.levels):
            value[where] |= chunks.astype(np.uint32) << (8 * level)
            where = where[np.unpackbits(bits, count=len(chunks), bitorder="little").view(bool)]
        return value


# The files ---------------------------------------------------------------------

SHARDS = "part int, seq long, doc_ids array<long>, ends array<long>, n_tokens long, codes binary"


def write_ids(docs: DataFrame, path: str, vocabulary: str | None = None, shard: int = SHARD) -> None:
    """Write the documents' ids in ascending doc_id order."""
    # Only a path is resolved here; every worker opens its own copy of the vocabulary.
    schema = to_arrow(SHARDS)

    def run(batches):
        encoded = encoder(vocabulary or tokenizer_path(TOKENIZER)).encode
        part, seq = TaskContext.get().partitionId(), 0
        for batch in batches:
            for first, n in blocks(batch.column(1)):
                ids = batch.column(0).slice(first, n).to_pylist()
                tokens, ends = encoded(batch.column(1).slice(first, n), END)
                at = start = 0
                while at < n:
                    to = max(at + 1, int(np.searchsorted(ends, start + shard, side="right")))
                    own = tokens[start : ends[to - 1]]
                    row = ([part], [seq], [ids[at:to]], [(ends[at:to] - start).tolist()], [len(own)], [encode(own)])
                    yield pa.RecordBatch.from_arrays([pa.array(v, f.type) for v, f in zip(row, schema)], schema=schema)
                    at, start, seq = to, int(ends[to - 1]), seq + 1
        give_back()

    # Rows of one id, as of null, may lie in several ranges.
    rows = docs.select("doc_id", F.coalesce("text", F.lit("")).alias("text"), F.monotonically_increasing_id().alias("row"))
    rows = rows.repartitionByRange("doc_id", "row").sortWithinPartitions("doc_id", "row").drop("row")
    rows.mapInArrow(run, SHARDS).write.option("compression", "uncompressed").parquet(path)


def _documents():
    def work(rows):
        out = {n: [] for n in ("part", "seq", "doc_id", "local", "n_tokens", "ids_crc32")}
        for part, seq, ids, ends, data in zip(*(rows[n] for n in ("part", "seq", "doc_ids", "ends", "codes"))):
            raw = Codes(data).all().astype("<u4").tobytes()
            for doc, low, high in zip(ids, chain([0], ends), ends):
                values = (part, seq, doc, low, high - low, zlib.crc32(raw[4 * low : 4 * high]))
                for name, value in zip(out, values):
                    out[name].append(value)
        return out

    return work


def read_ids(spark: SparkSession, path: str) -> DataFrame:
    """doc_id, start, n_tokens and ids_crc32 of every document in the files at ``path``."""
    shards = spark.read.schema(SHARDS).parquet(path)
    sizes = shards.select("part", "seq", "n_tokens", F.lit(0).alias("all"))
    base = running_total(sizes, "all", "part", ["seq"], "n_tokens", "base").select("part", "seq", "base")
    found = map_rows(
        shards.drop("n_tokens"), _documents,
        "part int, seq long, doc_id long, local long, n_tokens long, ids_crc32 long",
    )
    return found.join(base, ["part", "seq"]).select(
        "doc_id", (F.col("base") + F.col("local")).alias("start"), "n_tokens", "ids_crc32"
    )


def token_files(docs: DataFrame, vocabulary: str | None = None) -> DataFrame:
    """Write the ids to a new folder in the shared work folder and read them back."""
    path = new_path(docs.sparkSession, "token-codes")
    write_ids(docs, path, vocabulary)
    return read_ids(docs.sparkSession, path)


def op8_token_codes(spark, sf_dir):
    return token_files(table(spark, sf_dir, "documents"))
