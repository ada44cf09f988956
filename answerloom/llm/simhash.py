"""SimHash near-duplicates by multi-index hashing.

A fingerprint is cut into two segments of 32 bits. Two fingerprints that differ in at most
three bits differ in at most one bit of some segment, so each looks up, in a table per segment,
the Hamming ball of radius one around its own segment: the equal keys, and the keys with one
more bit set (a pair that differs in one bit meets from the side that lacks it). Matches are
verified on all 64 bits.

A key shared by more than ``HOT`` fingerprints would yield all pairs of a group. Its members
enumerate small balls of the other segment instead and are tied to one member at each common
point: a point within one bit of two of them, or within one and two bits, proves at most three
differing bits, and every such pair has one. That is exact, and its rows grow with the members.

Spark sizes a table after an explode as before it, so a side that meets balls, or is one, would be
broadcast with many times the rows it was sized by: these joins are merge joins.

Defined results: a null text and a text without words have fingerprint zero, linked like any
other; fewer words than a shingle give the whole sequence; repeated rows link to each other;
a null id never names a component unless all ids in it are null, and such components stay apart; an empty table gives an empty
table; other columns are kept by ``drop_near_duplicates`` and ignored otherwise.
"""

from __future__ import annotations

import numpy as np
import pyarrow as pa
import xxhash
from pyspark.sql import Column, DataFrame
from pyspark.sql import functions as F
from pyspark.sql import types as T

from ..session import stored
from .common import table, utf8
from .components import components

SHINGLE, SEED = 3, 42
HOT = 32
_PART = 1 << 15


def shingle_hashes(text: bytes, shingle: int = SHINGLE) -> np.ndarray:
    """Hashes of the shingles of UTF-8 bytes, in their order; none without words."""
    words = text.lower().split()
    if not words:
        return np.zeros(0, np.uint64)
    joined = b" ".join(words)
    ends = np.cumsum([len(w) + 1 for w in words]) - 1
    k = min(shingle, len(words))
    starts = np.concatenate([[0], ends[:-1] + 1])[: len(words) - k + 1]
    digest = xxhash.xxh64_intdigest
    return np.fromiter(
        (digest(joined[a:b], SEED) for a, b in zip(starts.tolist(), ends[k - 1 :].tolist())), np.uint64, len(starts)
    )


def simhash(text: bytes, shingle: int = SHINGLE) -> int:
    """The 64-bit fingerprint of UTF-8 bytes."""
    hashes = shingle_hashes(text, shingle)
    counts = np.zeros(64, np.int64)
    for at in range(0, len(hashes), _PART):
        bits = np.unpackbits(hashes[at : at + _PART].byteswap().view(np.uint8)).reshape(-1, 64)
        counts += bits.sum(0, dtype=np.int64)
    return int(np.packbits(counts * 2 > len(hashes)).view(">u8")[0])


@F.arrow_udf(T.LongType())
def _fingerprint(texts: pa.Array) -> pa.Array:
    return pa.array(np.array([simhash(t) for t in texts.to_pylist()], np.uint64).view(np.int64))


def fingerprint(column: str = "text") -> Column:
    """The fingerprint as a signed long."""
    return _fingerprint(utf8(column))


def _half(fp: Column, segment: int) -> Column:
    return F.shiftrightunsigned(fp, 32) if segment == 0 else fp.bitwiseAND(0xFFFFFFFF)


def links(prints: DataFrame) -> DataFrame:
    """Pairs (u, v) of different fingerprints ``fp`` (distinct rows) that connect all at 3 or fewer bits."""
    fp = F.col("fp")
    own = [F.struct(F.lit(s).alias("seg"), _half(fp, s).alias("key"), _half(fp, 1 - s).alias("rest")) for s in (0, 1)]
    entries = prints.select("fp", F.explode(F.array(*own)).alias("e")).select("fp", "e.*")
    one_more = F.filter(
        F.transform(F.sequence(F.lit(0), F.lit(31)), lambda b: F.call_function("shiftleft", F.lit(1).cast("long"), b)),
        lambda bit: F.col("key").bitwiseAND(bit) == 0,
    )
    probes = entries.select("fp", "seg", "rest", F.explode(F.transform(one_more, lambda b: F.col("key").bitwiseOR(b))).alias("key"))
    sizes = entries.groupBy("seg", "key").agg(F.count(F.lit(1)).alias("n"))
    entries = stored(entries.join(sizes.hint("merge"), ["seg", "key"]), "segments")
    hot_keys = entries.filter(F.col("n") > HOT).select("seg", "key").distinct()

    cold = entries.filter(F.col("n") <= HOT).select("seg", "key", F.col("fp").alias("v"))
    single = entries.filter((F.col("n") > 1) & (F.col("n") <= HOT)).select("seg", "key", F.col("fp").alias("u"))
    near = F.bit_count(F.col("u").bitwiseXOR(F.col("v"))) <= 3
    equal = single.join(cold.hint("merge"), ["seg", "key"]).filter("u < v")
    flipped = probes.select("seg", "key", F.col("fp").alias("u")).join(cold.hint("merge"), ["seg", "key"])
    pairs = equal.unionByName(flipped).filter(near).select("u", "v")

    # Keys one bit below a hot key are found from the hot keys, which are few, not from all probes.
    bits = F.filter(
        F.transform(F.sequence(F.lit(0), F.lit(31)), lambda b: F.call_function("shiftleft", F.lit(1).cast("long"), b)),
        lambda bit: F.col("key").bitwiseAND(bit) != 0,
    )
    below = hot_keys.select("seg", F.col("key").alias("hot"), F.explode(F.transform(bits, lambda b: F.col("key").bitwiseXOR(b))).alias("key"))
    members = entries.filter(F.col("n") > HOT).select("fp", "seg", "key", "rest", F.lit(2).alias("reach")).unionByName(
        entries.join(below.hint("merge"), ["seg", "key"]).select("fp", "seg", F.col("hot").alias("key"), "rest", F.lit(1).alias("reach"))
    )
    return pairs.unionByName(_stars(stored(members, "hot-members")))


def _stars(members: DataFrame) -> DataFrame:
    """Links inside hot keys: members of equal key reach two bits of the rest, those one bit off one."""
    bits = F.lit([1 << b for b in range(32)])
    rest = F.col("rest")
    none = F.array(F.struct(F.lit(0).alias("far"), rest.alias("point")))
    single = F.transform(bits, lambda b: F.struct(F.lit(1).alias("far"), rest.bitwiseXOR(b).alias("point")))
    twos = [(1 << a) | (1 << b) for a in range(32) for b in range(a)]
    double = F.transform(F.lit(twos), lambda b: F.struct(F.lit(2).alias("far"), rest.bitwiseXOR(b).alias("point")))
    double = F.when(F.col("reach") == 2, double).otherwise(F.slice(double, 1, 0))
    points = members.select("fp", "seg", "key", "reach", F.explode(F.concat(none, single, double)).alias("p"))
    points = points.select("fp", "seg", "key", "reach", "p.*")
    keys = ["seg", "key", "point"]
    centre = F.min(F.when((F.col("reach") == 2) & (F.col("far") <= 1), F.col("fp")))
    centres = points.groupBy(*keys).agg(centre.alias("v"), F.count(F.lit(1)).alias("n")).filter("n > 1 AND v IS NOT NULL")
    found = points.join(centres.hint("merge"), keys).filter("fp <> v")
    return found.select(F.col("fp").alias("u"), "v").distinct()


def labelled(prints: DataFrame, once: DataFrame, roots: DataFrame) -> DataFrame:
    """Rows (doc_id, row, fp) with component_id and root, from the least id by fp and the linked fps' roots."""
    named = once.join(roots.hint("merge"), once["fp"] == roots["node"], "left").select(
        "fp", "least", F.coalesce("root", "fp").alias("root")
    )
    ids = named.groupBy("root").agg(F.min("least").alias("component_id"))
    labels = named.join(ids, "root").select("fp", "component_id", "root")
    # Rows of one fingerprint may be many: they meet its label over salted keys.
    salted = prints.withColumn("salt", F.pmod(F.xxhash64("doc_id"), F.lit(1024)))
    keys = salted.select("fp", "salt").distinct().join(labels, "fp")
    return salted.join(keys.hint("merge"), ["fp", "salt"]).select("doc_id", "row", "fp", "component_id", "root")


def near_duplicates(docs: DataFrame) -> DataFrame:
    """doc_id, row (a hash of the text), fp (signed), component_id and root (never null) of every row."""
    prints = stored(docs.select("doc_id", F.xxhash64("text").alias("row"), fingerprint().alias("fp")), "simhash")
    once = prints.groupBy("fp").agg(F.min("doc_id").alias("least"))
    return labelled(prints, once, components(links(once.select("fp"))))


def keep_first(docs: DataFrame, found: DataFrame) -> DataFrame:
    """The row with the least id of each component (of repeated rows, one)."""
    first = F.min(F.struct(F.col("doc_id").isNull(), "doc_id", "row"))
    kept = found.groupBy("root", F.pmod(F.xxhash64("doc_id", "row"), F.lit(1024)).alias("salt")).agg(first.alias("f"))
    kept = kept.groupBy("root").agg(F.min("f").alias("f")).select(F.col("f.doc_id").alias("_id"), F.col("f.row").alias("_row"))
    joined = docs.join(kept, docs["doc_id"].eqNullSafe(kept["_id"]) & (F.xxhash64(docs["text"]) == kept["_row"]))
    return joined.dropDuplicates(["_id", "_row"]).select(*(docs[c] for c in docs.columns))


def drop_near_duplicates(docs: DataFrame) -> DataFrame:
    """One row of each component stays: that with the least id (of repeated rows, one)."""
    return keep_first(docs, near_duplicates(docs))


def op5_simhash(spark, sf_dir):
    found = near_duplicates(table(spark, sf_dir, "documents"))
    return found.select("doc_id", F.lower(F.lpad(F.hex("fp"), 16, "0")).alias("fingerprint"), "component_id")
