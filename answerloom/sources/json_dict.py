"""Dictionary files, ``{key: value, ...}`` as one JSON object, read by many tasks.

The text source cuts a file into byte ranges at "}" (which no escape holds, so
a piece never starts inside one). Where a range starts, in a string or not and
how deep, follows from the ranges before it: a first pass sums up each range
for both cases, a running sum over these short rows gives every range its start,
and a second pass cuts the ranges at the commas of the outer object. An entry
that lies in several ranges is put together from its parts; all others never
leave their task.
"""

from __future__ import annotations

import re
from collections.abc import Iterator

import pyarrow as pa
from pyspark.sql import DataFrame, SparkSession, Window
from pyspark.sql import functions as F
from pyspark.sql import types as T

from ..session import stored

BLOCK = ["file", "block", "bytes"]
_ESCAPE = re.compile(r"\\.", re.DOTALL)
_NESTING = re.compile(r"[][{}]")
# A string (open at the piece's end, if need be) or a sign outside of strings.
_SIGN = re.compile(r'"(?:[^"\\]++|\\.)*+"?|[][{},]', re.DOTALL)
_STRING_END = re.compile(r'(?:[^"\\]++|\\.)*+"', re.DOTALL)


def _pieces(batches: Iterator[pa.RecordBatch]) -> Iterator[tuple[tuple, str]]:
    """(range, text up to and with the next "}"), in the order of the file."""
    for batch in batches:
        for *block, text in zip(*(batch.column(i).to_pylist() for i in range(batch.num_columns))):
            yield tuple(block), text + "}"


def _depth(signs: str) -> int:
    nested = _NESTING.findall(signs)
    return sum(1 if s in "[{" else -1 for s in nested)


def _summary(batches: Iterator[pa.RecordBatch]) -> Iterator[pa.RecordBatch]:
    """Per range: its quotes modulo 2 and its change of depth if it starts outside or inside a string."""
    totals: dict[tuple, list[int]] = {}
    for block, piece in _pieces(batches):
        total = totals.setdefault(block, [0, 0, 0])
        parts = _ESCAPE.sub("", piece).split('"')
        even, odd = _depth("".join(parts[::2])), _depth("".join(parts[1::2]))
        flipped = total[0]
        total[1] += odd if flipped else even
        total[2] += even if flipped else odd
        total[0] = (flipped + len(parts) - 1) % 2
    rows = [(*block, *total) for block, total in totals.items()]
    yield pa.RecordBatch.from_arrays(
        [pa.array([r[i] for r in rows], t) for i, t in enumerate([pa.string()] + [pa.int64()] * 5)],
        names=[*BLOCK, "quotes", "if_outside", "if_inside"],
    )


_PARTS = pa.schema(
    [("file", pa.string()), ("block", pa.int64()), ("bytes", pa.int64()), ("no", pa.int64()), ("text", pa.string())]
)


def _cut(batches: Iterator[pa.RecordBatch], rows: int = 1024) -> Iterator[pa.RecordBatch]:
    """(range, number, text): what lies between the commas of the outer object, numbered within the range."""
    out: list[tuple] = []
    block, no, depth, inside, held = None, 0, 0, False, []

    def close() -> None:
        nonlocal no, held
        out.append((*block, no, "".join(held)))
        no, held = no + 1, []

    def written() -> pa.RecordBatch:
        made = pa.RecordBatch.from_arrays([pa.array([r[i] for r in out], f.type) for i, f in enumerate(_PARTS)], schema=_PARTS)
        out.clear()
        return made

    for (*here, start_depth, start_inside), piece in _pieces(batches):
        if here != block:
            if block is not None:
                close()
            block, no, depth, inside = here, 0, start_depth, bool(start_inside)
        at = kept = 0
        if inside:
            end = _STRING_END.match(piece)
            if end is None:
                held.append(piece)
                continue
            at, inside = end.end(), False
        for sign in _SIGN.finditer(piece, at):
            s = sign.group()
            if s[0] == '"':
                inside = _STRING_END.match(s, 1) is None
            elif s == ",":
                if depth == 1:
                    held.append(piece[kept : sign.start()])
                    close()
                    kept = sign.end()
            elif s in "{[":
                depth += 1
                if depth == 1:
                    kept = sign.end()  # the outer object begins
            else:
                depth -= 1
                if depth == 0:
                    held.append(piece[kept : sign.start()])
                    kept = sign.end()  # and ends
        if depth > 0:
            held.append(piece[kept:])
        if len(out) >= rows:
            yield written()
    if block is not None:
        close()
    yield written()


def read_dict(spark: SparkSession, path: str | list[str], value: T.DataType) -> DataFrame:
    """``(file, pos, key, value)``, ``pos`` counting a file's entries from 0 in its order.

    Values are read as ``value``; what does not fit it is null. A key written
    twice gives two rows; an empty file or object gives none. One entry must
    fit in a row. Files are UTF-8, of any layout.
    """
    pieces = spark.read.text(path, lineSep="}").select(
        F.col("_metadata.file_path").alias("file"), F.col("_metadata.file_block_start").alias("block"),
        F.col("_metadata.file_block_length").alias("bytes"), "value",
    )
    sums = stored(
        pieces.mapInArrow(_summary, "file string, block long, bytes long, quotes long, if_outside long, if_inside long"),
        "dict-ranges",
    )
    # One short row per range of a file.
    before = Window.partitionBy("file").orderBy("block").rowsBetween(Window.unboundedPreceding, -1)
    inside = F.pmod(F.coalesce(F.sum("quotes").over(before), F.lit(0)), F.lit(2))
    change = F.when(F.col("inside") == 1, F.col("if_inside")).otherwise(F.col("if_outside"))
    starts = sums.withColumn("inside", inside).withColumn("change", change).select(
        *BLOCK, F.coalesce(F.sum("change").over(before), F.lit(0)).alias("depth"), "inside"
    )
    # A range is a hundred bytes here for up to spark.sql.files.maxPartitionBytes of input, and the first
    # one of a file starts at depth 0, so only files of several ranges add to what is broadcast.
    later = F.broadcast(starts.where(F.col("block") > 0))
    known = F.when(F.col("block") == 0, F.lit(0).cast("long")).otherwise(
        F.coalesce(F.col("depth"), F.raise_error(F.lit("the ranges of a file changed between two readings")).cast("long"))
    )
    begun = pieces.join(later, BLOCK, "left").select(
        *BLOCK, known.alias("depth"), F.coalesce("inside", F.lit(0).cast("long")).alias("inside"), "value"
    )
    parts = stored(begun.mapInArrow(_cut, "file string, block long, bytes long, no long, text string"), "dict-parts")
    # The last part of a range goes on in the next one, so it shares its number with that one's first part.
    counts = parts.groupBy(*BLOCK).agg(F.max("no").alias("last"))
    first = counts.select(*BLOCK, "last", F.coalesce(F.sum("last").over(before), F.lit(0)).alias("first"))
    ranges = F.broadcast(first)  # as above
    numbered = parts.join(ranges, BLOCK).withColumn("pos", F.col("first") + F.col("no"))
    open_part = (F.col("no") == F.col("last")) | ((F.col("no") == 0) & (F.col("block") > 0))
    whole = numbered.where(~open_part).select("file", "pos", "text")
    joined = (
        numbered.where(open_part)
        .groupBy("file", "pos")
        .agg(F.sort_array(F.collect_list(F.struct("block", "text"))).alias("p"))
        .select("file", "pos", F.array_join(F.transform("p", lambda x: x["text"]), "").alias("text"))
    )
    entry = F.from_json(F.concat(F.lit("{"), "text", F.lit("}")), T.MapType(T.StringType(), value))
    return whole.unionByName(joined).select("file", "pos", F.explode(entry).alias("key", "value"))


def write_dict(rows: DataFrame, key: str, value: str, path: str) -> None:
    """Write one dictionary file per partition; ``key`` is a string column, ``value`` of any type."""
    entry = F.concat(F.to_json(F.struct(F.col(key).alias("k"))), F.lit("\n"), F.to_json(F.struct(F.col(value).alias("v"))))

    def lines(batches: Iterator[pa.RecordBatch]) -> Iterator[pa.RecordBatch]:
        first = True
        for batch in batches:
            out = []
            for text in batch.column(0).to_pylist():
                k, v = text.split("\n")  # JSON on one line holds no line end
                out.append(("{" if first else ",") + f"{k[5:-1]}: {v[5:-1]}")
                first = False
            yield pa.RecordBatch.from_arrays([pa.array(out, pa.string())], names=["value"])
        yield pa.RecordBatch.from_arrays([pa.array(["{}" if first else "}"])], names=["value"])

    rows.where(F.col(key).isNotNull()).select(entry.alias("value")).mapInArrow(lines, "value string").write.text(path)
