"""Near copies by shingle sets: every pair of texts with Jaccard similarity 0.8 or more is linked.

A text is the set of its hashed shingles of ``SHINGLE`` words. Sets are sorted in one order: the
shingles that a sample of the texts finds common come last, the most common at the very end, all
others by hash. Two sets of n and m shingles that reach the similarity share one of the first
n - ceil(0.8 n) + 1 and m - ceil(0.8 m) + 1 (prefix filter), whatever the order is, so texts meet
by these keys and none is missed; the sample only decides how many meet in vain. Pairs whose
shared keys and later shingles together cannot reach the similarity are left out, and the others
are compared by their whole sets.

A key shared by more than ``HOT`` sets would yield all pairs of a group. Its members are compared
with one of them, then with another one, and only members that are still in different
components after that are compared with each other.

Defined results: null texts and texts without words are one empty set; texts of fewer words than
a shingle have the whole sequence as theirs; repeated rows and texts with equal sets are linked;
a null id never names a component unless all ids in it are null, and such components stay
apart; an empty table gives an empty table; other columns are kept by ``drop_near_copies`` and
ignored otherwise.
"""

from __future__ import annotations

import numpy as np
import xxhash
from pyspark.sql import Column, DataFrame
from pyspark.sql import functions as F

from ..session import stored
from .common import map_rows, utf8
from .components import components
from .simhash import keep_first, labelled, shingle_hashes

SHINGLE = 5
#: The similarity, as a fraction.
PART, WHOLE = 4, 5
#: Sets a key may be shared by before its group is taken apart by stars.
HOT = 64
STARS = 2
#: Texts that tell which shingles are common, and how many of these are put last.
SAMPLE, SEEN, COMMON = 20_000, 3, 500_000
_SALTS = 64
#: Of a set: its size, the length and last key of its prefix, and the hot keys in that.
SIDE = ("n", "q", "last", "hot")


def shingles(text: bytes, shingle: int = SHINGLE) -> np.ndarray:
    """The set of a text's shingles as sorted hashes of 62 bits."""
    return np.unique(shingle_hashes(text, shingle) >> np.uint64(2)).astype(np.int64)


def prefix_length(n: int) -> int:
    return n - -(-PART * n // WHOLE) + 1 if n else 0


class Order:
    """Renames common shingles to numbers above all hashes, by their frequency."""

    def __init__(self, common: np.ndarray):
        self.keys = np.sort(common)
        self.place = np.argsort(common).astype(np.int64) + (1 << 62)

    def __call__(self, keys: np.ndarray) -> np.ndarray:
        if not len(self.keys) or not len(keys):
            return keys
        at = np.minimum(np.searchsorted(self.keys, keys), len(self.keys) - 1)
        return np.sort(np.where(self.keys[at] == keys, self.place[at], keys))


def _common(docs: DataFrame, shingle: int) -> np.ndarray:
    """Shingles seen in ``SEEN`` or more different sampled texts, the most frequent last."""

    def make():
        def work(rows):
            return {"keys": [shingles(t, shingle).tolist() for t in rows["text"]]}

        return work

    share = F.lit(int(min(1.0, SAMPLE / max(1, docs.count())) * (1 << 30)))
    drawn = docs.filter(F.pmod(F.xxhash64("text"), F.lit(1 << 30)) < share).select(utf8().alias("text")).distinct()
    keys = map_rows(drawn, make, "keys array<long>").select(F.explode("keys").alias("key"))
    found = keys.groupBy("key").count().filter(F.col("count") >= SEEN)
    # At most COMMON numbers.
    rows = found.orderBy(F.desc("count"), "key").limit(COMMON).select("count", "key").toPandas()
    return rows.sort_values(["count", "key"])["key"].to_numpy(np.int64)


def _sets(docs: DataFrame, order, shingle: int) -> DataFrame:
    """doc_id, row, fp (the hash of the set), n (its size) and the keys of its prefix."""

    def make():
        named = Order(order.value)

        def work(rows):
            out = {"doc_id": rows["doc_id"], "row": rows["row"], "fp": [], "n": [], "prefix": []}
            for text in rows["text"]:
                found = shingles(text, shingle)
                out["fp"].append(np.uint64(xxhash.xxh3_64_intdigest(found.tobytes())).astype(np.int64).item())
                out["n"].append(len(found))
                out["prefix"].append(named(found)[: prefix_length(len(found))].tolist())
            return out

        return work

    source = docs.select("doc_id", F.xxhash64("text").alias("row"), utf8().alias("text"))
    return map_rows(source, make, "doc_id long, row long, fp long, n int, prefix array<long>")


def _bodies(docs: DataFrame, wanted: DataFrame, shingle: int) -> DataFrame:
    """fp and the whole set, of the rows ``wanted`` (fp, first: a row that has the set)."""

    def make():
        def work(rows):
            return {"fp": rows["fp"], "body": [shingles(t, shingle).tolist() for t in rows["text"]]}

        return work

    texts = docs.select(F.col("doc_id").alias("_id"), F.xxhash64("text").alias("_row"), utf8().alias("text"))
    same = (texts["_row"] == F.col("first.row")) & texts["_id"].eqNullSafe(F.col("first.doc_id"))
    rows = texts.join(wanted, same).select("fp", "text")
    return map_rows(rows, make, "fp long, body array<long>").dropDuplicates(["fp"])


def _reaches(common: Column, n: Column, m: Column) -> Column:
    return common * (PART + WHOLE) >= (n + m) * PART


def _sizes_fit(n: str, m: str) -> Column:
    return F.least(n, m) * WHOLE >= F.greatest(n, m) * PART


def _with_body(pairs: DataFrame, side: str, other: str, bodies: DataFrame) -> DataFrame:
    """Attach a side's set; one that many pairs ask for is dealt over salts."""
    salted = pairs.withColumn("salt", F.pmod(F.xxhash64(other), F.lit(_SALTS)))
    bodies = bodies.select(F.col("fp").alias(side), F.col("body").alias(f"{side}_body"))
    asked = salted.select(side, "salt").distinct().join(bodies, side)
    return salted.join(asked, [side, "salt"]).drop("salt")


def _verified(docs: DataFrame, once: DataFrame, pairs: DataFrame, shingle: int) -> DataFrame:
    """The pairs (u, v) whose whole sets reach the similarity."""
    pairs = stored(pairs.select("u", "v"), "candidates")
    asked = pairs.select(F.col("u").alias("fp")).unionByName(pairs.select(F.col("v").alias("fp"))).distinct()
    bodies = stored(_bodies(docs, once.select("fp", "first").join(asked, "fp"), shingle), "shingles")
    both = _with_body(_with_body(pairs, "u", "v", bodies), "v", "u", bodies)
    common = F.size(F.array_intersect("u_body", "v_body"))
    return stored(both.filter(_reaches(common, F.size("u_body"), F.size("v_body"))).select("u", "v"), "links")


def _possible(common: Column) -> Column:
    """Whether a pair may reach the similarity: shared keys, hot keys and all after the shorter prefix."""
    rest = {s: F.col(f"{s}_n") - F.col(f"{s}_q") for s in ("u", "v")}
    after = F.when(F.col("u_last") < F.col("v_last"), rest["u"]).when(F.col("u_last") > F.col("v_last"), rest["v"])
    after = after.otherwise(F.least(rest["u"], rest["v"]))
    return _reaches(common + F.least("u_hot", "v_hot") + after, F.col("u_n"), F.col("v_n"))


def _sides(entries: DataFrame, side: str, *more: str) -> DataFrame:
    kept = (F.col(c).alias(f"{side}_{c}") for c in (*SIDE, *more))
    return entries.select("key", F.col("fp").alias(side), *kept)


def links(docs: DataFrame, once: DataFrame, shingle: int = SHINGLE) -> DataFrame:
    """node and root of every set that reaches the similarity with another one."""
    prefix = F.col("prefix")
    entries = once.select(
        "fp", "n", F.size(prefix).alias("q"), F.element_at(prefix, F.lit(-1)).alias("last"), F.explode(prefix).alias("key")
    )
    sizes = once.select(F.explode(prefix).alias("key")).groupBy("key").agg(F.count(F.lit(1)).alias("m")).filter("m > 1")
    entries = stored(entries.join(sizes, "key"), "prefixes")
    hot_keys = entries.filter(F.col("m") > HOT).groupBy("fp").agg(F.count(F.lit(1)).alias("hot"))
    entries = entries.join(hot_keys, "fp", "left").fillna(0, "hot")
    cold, hot = entries.filter(F.col("m") <= HOT), stored(entries.filter(F.col("m") > HOT), "hot-prefixes")

    met = _sides(cold, "u").join(_sides(cold, "v"), "key").filter("u < v").filter(_sizes_fit("u_n", "v_n"))
    met = met.groupBy("u", "v", *(f"{s}_{c}" for s in ("u", "v") for c in SIDE)).agg(F.count(F.lit(1)).alias("c"))
    pairs = met.filter(_possible(F.col("c"))).select("u", "v")
    found, roots = None, None
    for star in range(STARS + 1):
        if star and hot.isEmpty():
            break
        if star:
            hot_now = hot.join(roots, hot["fp"] == roots["node"], "left").select(hot["*"], F.coalesce("root", "fp").alias("root"))
            parts = hot_now.groupBy("key").agg(F.min("root").alias("a"), F.max("root").alias("b")).filter("a <> b").select("key")
            hot_now = hot_now.join(parts, "key")
        else:
            hot_now = hot.withColumn("root", F.col("fp"))
        if star < STARS:
            # First the most typical member: edited copies have rarer keys, so fewer hot ones.
            typical = -F.col("hot") if star == 0 else F.lit(0)
            drawn = F.struct(typical.alias("t"), F.xxhash64("fp", F.lit(star)).alias("h"), "fp", "n", "root")
            centre = hot_now.groupBy("key").agg(F.min(drawn).alias("c"))
            centre = centre.select("key", F.col("c.fp").alias("v"), F.col("c.n").alias("v_n"), F.col("c.root").alias("v_root"))
            more = hot_now.join(centre, "key").filter("root <> v_root").filter(_sizes_fit("n", "v_n"))
            more = more.select(F.least("fp", "v").alias("u"), F.greatest("fp", "v").alias("v"))
        else:
            left, right = _sides(hot_now, "u", "root"), _sides(hot_now, "v", "root")
            more = left.join(right, "key").filter("u < v AND u_root <> v_root").filter(_sizes_fit("u_n", "v_n"))
            # Pairs with a cold key in common were compared before.
            more = more.filter(_possible(F.lit(0))).select("u", "v")
        pairs = (more if star else pairs.unionByName(more)).distinct()
        new = _verified(docs, once, pairs, shingle)
        if star and new.isEmpty():
            continue
        found = new if found is None else found.unionByName(new)
        roots = components(found)
    return roots


def near_copies(docs: DataFrame, shingle: int = SHINGLE) -> DataFrame:
    """doc_id, row (a hash of the text), fp (a hash of the set), component_id and root of every row."""
    order = docs.sparkSession.sparkContext.broadcast(_common(docs, shingle))
    sets = stored(_sets(docs, order, shingle), "shingle-sets")
    first = F.min(F.struct(F.col("doc_id").isNull(), "doc_id", "row")).alias("first")
    once = sets.groupBy("fp").agg(first, F.min("doc_id").alias("least"), F.min("n").alias("n"), F.first("prefix").alias("prefix"))
    once = stored(once, "different-sets")
    return labelled(sets.select("doc_id", "row", "fp"), once.select("fp", "least"), links(docs, once, shingle))


def drop_near_copies(docs: DataFrame, shingle: int = SHINGLE) -> DataFrame:
    """One row of each component stays: that with the least id (of repeated rows, one)."""
    return keep_first(docs, near_copies(docs, shingle))
