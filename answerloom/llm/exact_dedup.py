"""Exact deduplication by composable polynomial fingerprints.

A text, white space normalised, is read as the coefficients of a polynomial and evaluated
modulo two primes. Chunks are hashed on their own and combined by length-shifted arithmetic,
``H(ab) = H(a) * x^len(b) + H(b)``, so the parts of a huge text may be hashed by different
tasks. Texts with equal fingerprint and length are then compared with the text that stays,
chunk by chunk; a group in which any chunk differs is grouped anew by SHA-256.

Defined results: a null text counts as empty; empty texts are equal to each other; of rows with
the same smallest id one row (any of them: they are equal) is the one that stays only by that
id, so all rows bearing the id are kept; a null id sorts after all others; an empty table gives
an empty table; other columns are ignored.
"""

from __future__ import annotations

import hashlib
import re
from functools import lru_cache

import numpy as np
from pyspark.sql import DataFrame
from pyspark.sql import functions as F

from ..session import stored
from .common import map_rows, same, utf8, with_group

#: The two moduli, the evaluation points and the chunk length in bytes.
PRIMES = (2147483647, 2147483629)
POINTS = (911382323, 972663749)
CHUNK = 1 << 16
#: Texts of more characters are hashed in pieces of this length by separate tasks.
PIECE = 1 << 20

_SPACES = re.compile(rb"[\x20\x09-\x0D]+")
KEY = ("h1", "h2", "n_bytes")


@lru_cache(maxsize=2)
def _powers(which: int) -> np.ndarray:
    """``x^0 .. x^CHUNK`` modulo the prime, highest last, by doubling."""
    p, x = PRIMES[which], POINTS[which]
    out = np.ones(1, np.uint64)
    step = x
    while len(out) <= CHUNK:
        out = np.concatenate([out, out * np.uint64(step) % np.uint64(p)])
        step = step * step % p
    return out[: CHUNK + 1]


def chunk_hash(data: bytes) -> tuple[int, int]:
    """Both polynomial values of at most ``CHUNK`` bytes."""
    values = np.frombuffer(data, np.uint8).astype(np.uint64) + np.uint64(1)
    return tuple(
        int((values * _powers(w)[: len(values)][::-1]).sum() % np.uint64(p)) for w, p in enumerate(PRIMES)
    )


def combine(parts: list[tuple[tuple[int, int], int]]) -> tuple[int, int]:
    """The hash of a concatenation from (hash, length) of its parts."""
    out = [0, 0]
    for hashes, length in parts:
        for w, p in enumerate(PRIMES):
            out[w] = (out[w] * pow(POINTS[w], length, p) + hashes[w]) % p
    return tuple(out)


def fingerprint(data: bytes) -> tuple[int, int]:
    pieces = [data[i : i + CHUNK] for i in range(0, len(data), CHUNK)]
    return combine([(chunk_hash(p), len(p)) for p in pieces])


def normalise(data: bytes) -> bytes:
    return _SPACES.sub(b" ", data)


def _whole():
    def work(rows):
        texts = [normalise(t) for t in rows["text"]]
        prints = [fingerprint(t) for t in texts]
        return {
            "doc_id": rows["doc_id"],
            "h1": [p[0] for p in prints],
            "h2": [p[1] for p in prints],
            "n_bytes": [len(t) for t in texts],
            "text_sha256": [hashlib.sha256(t).hexdigest() for t in texts],
            "norm": texts,
        }

    return work


def _pieces():
    def work(rows):
        out = {n: [] for n in ("doc_id", "row", "text_sha256", "no", "h1", "h2", "n_bytes", "x1", "x2")}
        for doc, row, sha, no, after, text in zip(*(rows[n] for n in ("doc_id", "row", "text_sha256", "no", "after_space", "text"))):
            text = normalise(text)
            if after and text[:1] == b" ":  # the run began in the piece before
                text = text[1:]
            h = fingerprint(text)
            shift = [pow(x, len(text), p) for x, p in zip(POINTS, PRIMES)]
            for name, value in zip(out, (doc, row, sha, no, *h, len(text), *shift)):
                out[name].append(value)
        return out

    return work


def fingerprints(docs: DataFrame, with_text: bool = False, piece: int = PIECE) -> DataFrame:
    """doc_id, h1, h2, n_bytes, text_sha256 (and norm, the normalised bytes) of each row."""
    text = F.coalesce(F.col("text"), F.lit(""))
    base = docs.select("doc_id", text.alias("text"))
    long = F.length("text") > piece
    schema = "doc_id long, h1 long, h2 long, n_bytes long, text_sha256 string, norm binary"
    names = ["doc_id", *KEY, "text_sha256"] + ["norm"] * with_text
    short = map_rows(base.filter(~long).select("doc_id", utf8().alias("text")), _whole, schema).select(*names)
    norm = F.regexp_replace("text", r"[\x20\x09-\x0D]+", " ")
    huge = base.filter(long).select("doc_id", "text", F.sha2(F.col("text").cast("binary"), 256).alias("row"),
                                    F.sha2(norm.cast("binary"), 256).alias("text_sha256"))
    cut = huge.select(
        "doc_id", "row", "text_sha256", "text",
        F.explode(F.sequence(F.lit(0), F.floor((F.length("text") - 1) / piece).cast("int"))).alias("no"),
    ).select(
        "doc_id", "row", "text_sha256", "no",
        F.substring("text", F.col("no") * piece, F.lit(1)).rlike(r"[\x20\x09-\x0D]").alias("after_space"),
        utf8(F.substring("text", F.col("no") * piece + 1, F.lit(piece))).alias("text"),
    ).withColumn("after_space", F.col("after_space") & (F.col("no") > 0))
    hashed = map_rows(
        cut.repartition("row", "no"), _pieces,
        "doc_id long, row string, text_sha256 string, no int, h1 long, h2 long, n_bytes long, x1 long, x2 long",
    )
    # Rows with the same id and text are equal: they are counted and given out again.
    once = hashed.groupBy("doc_id", "row", "text_sha256", "no").agg(
        F.count(F.lit(1)).alias("copies"), *(F.first(n).alias(n) for n in ("h1", "h2", "n_bytes", "x1", "x2"))
    )
    parts = once.groupBy("doc_id", "row", "text_sha256").agg(
        F.max("copies").alias("copies"), F.sum("n_bytes").alias("n_bytes"),
        F.array_sort(F.collect_list(F.struct("no", "h1", "h2", "x1", "x2"))).alias("parts"),
    )
    def folded(w: int):
        step = lambda a, s: (a * s[f"x{w}"] + s[f"h{w}"]) % PRIMES[w - 1]
        return F.aggregate("parts", F.lit(0).cast("long"), step).alias(f"h{w}")

    whole = parts.select("doc_id", "row", folded(1), folded(2), "n_bytes", "text_sha256", "copies")
    if with_text:
        texts = huge.select("doc_id", "row", norm.cast("binary").alias("norm")).dropDuplicates(["doc_id", "row"])
        whole = whole.join(texts, same(whole, texts, ["doc_id", "row"])).select(whole["*"], "norm")
    whole = whole.select("*", F.explode(F.sequence(F.lit(1).cast("long"), "copies")).alias("_k"))
    return short.unionByName(whole.select(*names))


def exact_dedup(docs: DataFrame, piece: int = PIECE) -> DataFrame:
    """doc_id, keep_id, group_size, kept, text_sha256 of every row.

    Rows meet only the totals of their group, spread over salted keys; a group holding a third
    of all rows is compared with copies of its first text, one for each salt.
    """
    row_hash = F.xxhash64("doc_id", "text_sha256")
    least = {"keep_id": F.min("doc_id"), "group_size": F.count(F.lit(1))}
    totals = {"keep_id": F.min("keep_id"), "group_size": F.sum("group_size")}
    prints = stored(fingerprints(docs, piece=piece), "fingerprints")
    grouped = with_group(prints, KEY, row_hash, least, totals)

    clash = stored(_differing(docs, prints, row_hash, piece), "differing")
    fine = grouped.join(clash, list(KEY), "left_anti")
    again = with_group(
        prints.join(clash, list(KEY), "left_semi"), [*KEY, "text_sha256"], F.xxhash64("doc_id"), least, totals
    )
    out = fine.unionByName(again.select(*fine.columns))
    return out.select(
        "doc_id", "keep_id", F.col("group_size").cast("long").alias("group_size"),
        F.col("doc_id").eqNullSafe(F.col("keep_id")).alias("kept"), "text_sha256",
    )


def _differing(docs: DataFrame, prints: DataFrame, row_hash, piece: int) -> DataFrame:
    """Keys of groups in which a text differs from the group's first, chunk by chunk."""
    salt = F.pmod(row_hash, F.lit(1024)).cast("int").alias("salt")
    parts = prints.select(*KEY, salt, "doc_id").groupBy(*KEY, "salt").agg(
        F.min("doc_id").alias("keep_id"), F.count(F.lit(1)).alias("size")
    )
    totals = parts.groupBy(*KEY).agg(F.min("keep_id").alias("keep_id"), F.sum("size").alias("size")).filter("size > 1")
    salts = parts.select(*KEY, "salt").join(totals, list(KEY))
    texts = fingerprints(docs, True, piece).withColumn("salt", salt)
    # Texts of groups only, written once: both sides of the comparison read them.
    members = stored(texts.join(salts, [*KEY, "salt"]), "members")
    first = F.col("doc_id").eqNullSafe(F.col("keep_id"))
    chunk = F.explode(F.sequence(F.lit(0), F.floor((F.greatest("n_bytes", F.lit(1)) - 1) / CHUNK).cast("int"))).alias("no")
    content = F.substring("norm", F.col("no") * CHUNK + 1, F.lit(CHUNK))
    rest = members.filter(~first).select(*KEY, "salt", "norm", chunk).select(*KEY, "salt", "no", content.alias("part"))
    kept = members.filter(first).groupBy(*KEY).agg(F.min("norm").alias("norm"))
    wanted = salts.select(*KEY, "salt")
    shown = kept.select(*KEY, "norm", chunk).select(*KEY, "no", content.alias("shown")).join(wanted, list(KEY))
    return (
        rest.join(shown, [*KEY, "salt", "no"], "left")
        .filter(~F.col("part").eqNullSafe(F.col("shown")))
        .select(*KEY).distinct()
    )


def op6_exact_dedup(spark, sf_dir):
    return exact_dedup(spark.read.parquet(f"{sf_dir}/documents.parquet"))


ORACLE = r"""
WITH t AS (
  SELECT doc_id, sha256(regexp_replace(coalesce(text, ''), '[\x20\x09-\x0D]+', ' ', 'g')) AS text_sha256 FROM documents
), g AS (SELECT text_sha256, min(doc_id) AS keep_id, count(*) AS group_size FROM t GROUP BY 1)
SELECT doc_id, keep_id, group_size, doc_id = keep_id AS kept, text_sha256 FROM t JOIN g USING (text_sha256)
"""
