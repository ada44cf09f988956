"""Best-fit packing of documents into training sequences.

Every document's ids, closed by an end id, are cut into pieces of at most a sequence's size; only
longer documents are cut. Pieces are packed by hierarchical residual packing: each task packs its
own pieces, longest first, each into the sequence that it leaves the least room in. Sequences that
are nearly full are done. The others become items themselves and meet those of neighbouring tasks
in the next, smaller round, which packs them again by best fit, until one task's share is left or
a round no longer helps. A task holds a bounded number of items at a time, so neither the number
of documents nor that of underfull sequences (as when all pieces are over half a sequence) matters.

Defined results: a null text counts as empty; an empty text has its end id only, one piece; repeated
rows are packed each; null ids stay null; an empty table gives no rows; other columns are ignored.
The same input files give the same sequences.
"""

from __future__ import annotations

import math
import zlib

import numpy as np
import pyarrow as pa
from pyspark import TaskContext
from pyspark.sql import DataFrame
from pyspark.sql import functions as F
from pyspark.sql import types as T

from ..session import stored
from .common import give_back, table, to_arrow
from .words import blocks, encoder, tokenizer_path

CAPACITY, END = 4096, 1
TOKENIZER = "word_bpe_49k.json"
#: Room at which a sequence is done, the items and the bytes a task packs together.
NEARLY, ITEMS, BYTES = 4, 1 << 18, 64 << 20
#: A round that leaves more than this share of its sequences is the last.
HELPS = 0.98

PIECES = "doc_id long, piece int, start long, length long, ids_crc32 long"


def best_fit(lengths: np.ndarray, capacity: int) -> tuple[np.ndarray, np.ndarray, np.ndarray]:
    """Per item its bin and its place in it, and per bin what it holds; longest items first."""
    rooms: list[list[int]] = [[] for _ in range(capacity + 1)]
    open_ = 0  # bit r: some bin has room r
    bins, places, fill = [0] * len(lengths), [0] * len(lengths), []
    order = np.argsort(-lengths, kind="stable")
    for i, n in zip(order.tolist(), lengths[order].tolist()):
        fits = open_ >> n
        if fits:
            room = n + (fits & -fits).bit_length() - 1
            b = rooms[room].pop()
            if not rooms[room]:
                open_ ^= 1 << room
        else:
            room, b = capacity, len(fill)
            fill.append(0)
        bins[i], places[i] = b, capacity - room
        room -= n
        fill[b] = capacity - room
        if room:
            rooms[room].append(b)
            open_ |= 1 << room
    return np.array(bins, np.int64), np.array(places, np.int64), np.array(fill, np.int64)


def _packed(items: DataFrame, length: str, capacity: int, limit: int, name) -> DataFrame:
    """The rows with ``bin``, ``place`` and ``fill`` (what the bin holds), packed task by task.

    ``name(table, bins, first)`` gives the bins' ids; ``first`` is each bin's first row.
    """
    schema = T.StructType([*items.schema, *T._parse_datatype_string("bin long, place long, fill long")])
    arrow = to_arrow(schema)

    def pack(rows: pa.Table, done: int) -> tuple[pa.Table, int]:
        lengths = rows[length].to_numpy().astype(np.int64)
        bins, places, fill = best_fit(lengths, capacity)
        first = np.zeros(len(fill), np.int64)
        at = np.flatnonzero(places == 0)
        first[bins[at]] = at
        ids = name(rows, np.arange(done, done + len(fill)), first)
        for values, field in zip((ids[bins], places, fill[bins]), ("bin", "place", "fill")):
            rows = rows.append_column(field, pa.array(values, pa.int64()))
        return rows.cast(arrow), done + len(fill)

    def run(batches):
        held, n, size, done = [], 0, 0, 0
        for batch in batches:
            held.append(batch)
            n, size = n + batch.num_rows, size + batch.nbytes
            if n >= limit or size >= BYTES:
                out, done = pack(pa.Table.from_batches(held), done)
                yield from out.to_batches()
                held, n, size = [], 0, 0
        if n:
            out, done = pack(pa.Table.from_batches(held), done)
            yield from out.to_batches()

    return items.mapInArrow(run, schema)


def _task_ids(rows: pa.Table, bins: np.ndarray, first: np.ndarray) -> np.ndarray:
    return bins + (TaskContext.get().partitionId() << 33)


def _first_ids(rows: pa.Table, bins: np.ndarray, first: np.ndarray) -> np.ndarray:
    return rows["item"].to_numpy()[first]


def pack(items: DataFrame, capacity: int = CAPACITY, nearly: int = NEARLY, limit: int = ITEMS) -> DataFrame:
    """The items, with ``sequence_id`` and ``offset`` (their place in the sequence, gapless from 0).

    ``items`` has a column ``length`` of 1 to ``capacity``; give a written table, whose partitions
    stay the same. Columns named bin, place or fill are not allowed.
    """
    packed = stored(_packed(items, "length", capacity, limit, _task_ids), "packed")
    moves = None  # of the first round's bins: into which sequence, and where
    open_ = packed.filter((F.col("place") == 0) & (F.col("fill") < capacity - nearly)).select(
        F.col("bin").alias("item"), F.col("fill").alias("size"))
    while (count := open_.count()) > 1:
        parts = math.ceil(count / limit)
        dealt = open_.repartitionByRange(parts, "item").sortWithinPartitions("item")
        merged = stored(_packed(dealt, "size", capacity, 2 * limit, _first_ids), "merged")
        step = merged.select(F.col("item").alias("from"), F.col("bin").alias("to"), F.col("place").alias("by"))
        if moves is None:
            moves = step
        else:
            moves = stored(moves.join(step.select(F.col("from").alias("to"), F.col("to").alias("next"), F.col("by").alias("more")), "to", "left").select(
                "from", F.coalesce("next", "to").alias("to"), (F.col("by") + F.coalesce("more", F.lit(0))).alias("by")), "moves")
        bins = merged.filter("place = 0")
        left = bins.count()
        if parts == 1 or left > HELPS * count:
            break
        open_ = bins.filter(F.col("fill") < capacity - nearly).select(F.col("bin").alias("item"), F.col("fill").alias("size"))
    columns = [c for c in items.columns]
    if moves is None:
        return packed.select(*columns, F.col("bin").alias("sequence_id"), F.col("place").alias("offset"))
    return packed.join(moves, packed["bin"] == moves["from"], "left").select(
        *(packed[c] for c in columns), F.coalesce("to", "bin").alias("sequence_id"),
        (F.col("place") + F.coalesce("by", F.lit(0))).alias("offset"))


def pieces(docs: DataFrame, capacity: int = CAPACITY, end: int = END, vocabulary: str | None = None, ids: bool = False) -> DataFrame:
    """PIECES of every document, with ``ids`` (little-endian unsigned 32-bit integers) if asked for."""
    kind = PIECES + ", ids binary" * ids
    schema = to_arrow(kind)

    def run(batches):
        encode = encoder(vocabulary or tokenizer_path(TOKENIZER)).encode
        for batch in batches:
            docs_, texts = batch.column(0), batch.column(1)
            for at, n in blocks(texts):
                flat, ends = encode(texts.slice(at, n), end)
                begins = np.append(0, ends[:-1])
                counts = -(-(ends - begins) // capacity)
                row = np.repeat(np.arange(n), counts)
                piece = np.arange(len(row)) - np.repeat(np.cumsum(counts) - counts, counts)
                first = begins[row] + piece * capacity
                last = np.minimum(first + capacity, ends[row])
                raw = memoryview(flat.astype("<u4").tobytes())
                cut = [raw[4 * a : 4 * b] for a, b in zip(first.tolist(), last.tolist())]
                columns = [docs_.slice(at, n).take(pa.array(row)), piece, piece * capacity, last - first, [zlib.crc32(c) for c in cut]]
                columns += [[bytes(c) for c in cut]] * ids
                arrays = [c if isinstance(c, pa.Array) else pa.array(c, f.type) for c, f in zip(columns, schema)]
                yield pa.RecordBatch.from_arrays(arrays, schema=schema)
        give_back()

    return docs.select("doc_id", F.coalesce("text", F.lit("")).alias("text")).mapInArrow(run, kind)


def packed_documents(docs: DataFrame, capacity: int = CAPACITY, end: int = END, vocabulary: str | None = None, ids: bool = False) -> DataFrame:
    """PIECES (and ``ids``), sequence_id and offset of every piece of the documents."""
    return pack(stored(pieces(docs, capacity, end, vocabulary, ids), "pieces"), capacity)


def sequences(docs: DataFrame, capacity: int = CAPACITY, end: int = END, vocabulary: str | None = None) -> DataFrame:
    """sequence_id, doc_ids (one per piece), ends (of the pieces) and ids (binary) of every sequence."""
    found = packed_documents(docs, capacity, end, vocabulary, ids=True)
    row = F.sort_array(F.collect_list(F.struct("offset", "doc_id", "length", "ids")))  # at most `capacity` pieces
    return found.groupBy("sequence_id").agg(row.alias("rows")).select(
        "sequence_id", F.col("rows.doc_id").alias("doc_ids"),
        F.transform("rows", lambda r: r["offset"] + r["length"]).alias("ends"),
        F.expr("unhex(array_join(transform(rows, r -> hex(r.ids)), ''))").alias("ids"))


def op13_pack(spark, sf_dir):
    return packed_documents(table(spark, sf_dir, "documents"))
