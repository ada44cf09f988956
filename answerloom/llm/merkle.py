"""A Merkle manifest of a data set, with checkpointed levels and proofs by recomputation.

A document's leaf is the hash of its fields. The leaves of a source, in ascending doc_id order,
are the lowest level of the source's tree: while a level has several nodes, every ``FAN``
consecutive ones become one node above. The sources' roots are in turn the leaves of the top
tree, whose root stands for the whole data set.

Only every ``STEP``-th level is stored. A task that holds the stored nodes below one stored node
(an aligned subtree, at most ``FAN ** STEP`` nodes) regenerates the levels between them, takes the
siblings that its nodes' proofs need, and discards the rest. Proofs are made from the top down: an
aligned subtree gets the one proof of its root and extends it, so no level is joined per document.

A proof is ``siblings``, 32 bytes each, left to right and from the leaf's level upwards, and
``shape``, one byte a level: 4 times the siblings on the left plus those on the right.

Defined results: nulls hash as ``-``; null ids come first, rows of equal id by leaf, and equal rows
get proofs of their own; a null source is a source, ordered first; a lone node is its tree's root;
an empty table has no root and no rows; other columns are ignored.
"""

from __future__ import annotations

import hashlib
from dataclasses import dataclass

import pyarrow as pa
from pyspark.sql import Column, DataFrame, SparkSession
from pyspark.sql import functions as F
from pyspark.sql.window import Window

from ..session import new_path
from .common import map_rows, table, to_arrow

FAN, STEP = 3, 5
FIELDS = ("doc_id", "source", "lang", "n_chars", "text")


def digest(*parts: str) -> str:
    """Lowercase hex SHA-256 of the concatenated parts."""
    return hashlib.sha256("".join(parts).encode()).hexdigest()


def field(column: Column) -> Column:
    """``-`` for null, else byte count, colon and value."""
    text = column.cast("string")
    return F.when(column.isNull(), "-").otherwise(F.concat(F.octet_length(text).cast("string"), F.lit(":"), text))


def leaf(columns: dict[str, Column]) -> Column:
    """The leaf of a row, as 32 bytes."""
    return F.unhex(F.sha2(F.concat(*(field(columns[n]) for n in FIELDS)).cast("binary"), 256))


# Trees in tasks ------------------------------------------------------------------


def above(nodes: list[str]) -> list[str]:
    return [digest(*nodes[i : i + FAN]) for i in range(0, len(nodes), FAN)]


def subtree(nodes: list[str], total: int, step: int) -> list[list[str]]:
    """The levels of an aligned subtree, up to ``step`` above or the root of the whole tree.

    ``total`` counts the whole tree's nodes on the lowest level.
    """
    levels = [nodes]
    while total > 1 and len(levels) <= step:
        levels.append(above(levels[-1]))
        total = -(-total // FAN)
    return levels


def siblings(levels: list[list[str]], i: int) -> tuple[str, bytes]:
    """The proof of node ``i`` of the lowest level within the subtree, as hex text and shape."""
    found, shape = [], []
    for nodes in levels[:-1]:
        first = i - i % FAN
        found += nodes[first:i] + nodes[i + 1 : first + FAN]
        shape.append(4 * (i - first) + len(nodes[i + 1 : first + FAN]))
        i //= FAN
    return "".join(found), bytes(shape)


def fold(own: str, found: str, shape: bytes) -> str:
    """The root that a leaf and its proof (as hex text) lead to."""
    at = 0
    for count in shape:
        left, right = at + 64 * (count >> 2), at + 64 * ((count >> 2) + (count & 3))
        own = digest(found[at:left], own, found[left:right])
        at = right
    return own


# Trees as tables -----------------------------------------------------------------

NODES = "tree string, idx long, total long, node binary"


def numbered(rows: DataFrame, order: list[str], at: str) -> DataFrame:
    """``idx``, the row's place in its ``tree`` by ``order``, and ``total``, the tree's rows.

    Rows are range-partitioned by tree and order and counted in place; only the counts of a tree's
    rows by partition are summed in one window. Equal rows may lie in different partitions.
    """
    spread = rows.withColumn("part", F.monotonically_increasing_id()).repartitionByRange("tree", *order, "part")
    spread = spread.sortWithinPartitions("tree", *order, "part").withColumn("part", F.spark_partition_id().cast("long"))
    schema = spread.withColumn("local", F.lit(0).cast("long")).schema
    arrow = to_arrow(schema)

    def count(batches):
        last, n = None, 0
        for batch in batches:
            local = []
            for tree in batch.column("tree").to_pylist():
                n = n + 1 if tree == last else 0
                last = tree
                local.append(n)
            yield pa.RecordBatch.from_arrays([*batch.columns, pa.array(local, pa.int64())], schema=arrow)

    found = written(spread.mapInArrow(count, schema), at)
    sizes = found.groupBy("tree", "part").agg(F.count(F.lit(1)).alias("size"))
    whole = Window.partitionBy("tree")
    before = whole.orderBy("part").rowsBetween(Window.unboundedPreceding, -1)
    sizes = sizes.select("tree", "part", F.sum("size").over(whole).alias("total"), F.coalesce(F.sum("size").over(before), F.lit(0)).alias("base"))
    return found.join(sizes, ["tree", "part"]).withColumn("idx", F.col("base") + F.col("local")).drop("part", "local", "base")


def written(df: DataFrame, path: str) -> DataFrame:
    df.write.parquet(path)
    return df.sparkSession.read.schema(df.schema).parquet(path)


def with_block(nodes: DataFrame, step: int) -> DataFrame:
    return nodes.withColumn("block", F.floor(F.col("idx") / F.lit(FAN**step)).cast("long"))


def next_level(nodes: DataFrame, step: int) -> DataFrame:
    """The stored nodes above those of all trees that have several nodes."""
    schema = to_arrow(NODES)

    def run(key, rows):
        rows = rows.sort_by("idx")
        total = rows["total"][0].as_py()
        levels = subtree([n.hex() for n in rows["node"].to_pylist()], total, step)
        for _ in levels[1:]:
            total = -(-total // FAN)
        values = (key[0].as_py(), key[1].as_py(), total, bytes.fromhex(levels[-1][0]))
        return pa.Table.from_arrays([pa.array([v], f.type) for v, f in zip(values, schema)], schema=schema)

    low = with_block(nodes.filter("total > 1").select("tree", "idx", "total", "node"), step)
    return low.groupBy("tree", "block").applyInArrow(run, NODES)


def levels_above(nodes: DataFrame, step: int, path: str) -> list[DataFrame]:
    """The stored levels over ``nodes``, lowest first, until every tree has its root."""
    levels = [nodes]
    while levels[-1].filter("total > 1").limit(1).count():
        levels.append(written(next_level(levels[-1], step), f"{path}-{len(levels)}"))
    return levels


PROOF = "tree string, idx long, siblings binary, shape binary, subroot binary"


def proofs_below(nodes: DataFrame, proofs: DataFrame, step: int, carry: str) -> DataFrame:
    """PROOF and the carried columns of all nodes, by the proofs of the stored nodes above them."""
    out = f"{PROOF}, node binary" + (f", {carry}" if carry else "")
    schema = to_arrow(out)

    def run(key, rows, upper):
        rows = rows.sort_by("idx")
        found = [n.hex() for n in rows["node"].to_pylist()]
        if not found:
            return schema.empty_table()
        levels = subtree(found, rows["total"][0].as_py(), step)
        more, tops, root = (upper[n][0].as_py() for n in ("siblings", "shape", "subroot"))
        proofs_ = [siblings(levels, i) for i in range(len(found))]
        made = {
            "siblings": pa.array([bytes.fromhex(s) + more for s, _ in proofs_], pa.binary()),
            "shape": pa.array([s + tops for _, s in proofs_], pa.binary()),
            "subroot": pa.array([root] * len(found), pa.binary()),
        }
        return pa.Table.from_arrays([made[f.name] if f.name in made else rows[f.name].cast(f.type) for f in schema], schema=schema)

    low = with_block(nodes, step).groupBy("tree", "block")
    high = proofs.select("tree", F.col("idx").alias("block"), "siblings", "shape", "subroot").groupBy("tree", "block")
    return low.cogroup(high).applyInArrow(run, out)


@dataclass
class Manifest:
    """Stored levels of the sources' trees (``levels[0]``: leaves) and of the top tree, and the root."""

    levels: list[DataFrame]
    top: list[DataFrame]
    root: bytes | None
    step: int


LEAVES = "doc_id long, tampered binary"


def build(docs: DataFrame, tampered: dict[str, Column] | None = None, path: str | None = None, step: int = STEP) -> Manifest:
    """Write a manifest of the documents to ``path`` (default: a new folder in the shared work folder).

    ``tampered`` replaces fields for a second leaf, against which proofs can be tried.
    """
    path = path or new_path(docs.sparkSession, "manifest")
    own = {n: F.col(n) for n in FIELDS}
    tree = F.when(F.col("source").isNull(), "").otherwise(F.concat(F.lit("="), F.col("source"))).alias("tree")
    leaves = docs.select(tree, F.col("doc_id").cast("long").alias("doc_id"), leaf(own).alias("node"), leaf(own | (tampered or {})).alias("tampered"))
    leaves = numbered(written(leaves, f"{path}/hashes"), ["doc_id", "node"], f"{path}/sorted")
    leaves = written(leaves.select("tree", "idx", "total", "node", "doc_id", "tampered"), f"{path}/level-0")
    levels = levels_above(leaves, step, f"{path}/level")
    roots = None
    for level in levels:
        found = level.filter("total = 1").select("tree", "node")
        roots = found if roots is None else roots.unionByName(found)
    # The top tree holds the sources' roots, ordered by source.
    roots = roots.select(F.lit("").alias("tree"), F.col("tree").alias("of"), "node")
    roots = written(numbered(roots, ["of"], f"{path}/roots").select("tree", "idx", "total", "node", "of"), f"{path}/top-0")
    top = levels_above(roots, step, f"{path}/top")
    root = top[-1].filter("total = 1").select("node").first()
    return Manifest(levels, top, bytes(root[0]) if root else None, step)


def load(spark: SparkSession, path: str, step: int = STEP) -> Manifest:
    """The manifest written to ``path``."""

    def levels(name: str) -> list[DataFrame]:
        found = [spark.read.parquet(f"{path}/{name}-0")]
        while found[-1].filter("total > 1").limit(1).count():
            found.append(spark.read.parquet(f"{path}/{name}-{len(found)}"))
        return found

    top = levels("top")
    root = top[-1].filter("total = 1").select("node").first()
    return Manifest(levels("level"), top, bytes(root[0]) if root else None, step)


def proofs(manifest: Manifest, wanted: DataFrame | None = None) -> DataFrame:
    """tree, idx, siblings, shape, subroot, node, doc_id and tampered of every document.

    With ``wanted`` (a column doc_id), only subtrees that hold such a document are recomputed.
    """
    step = manifest.step
    none = F.lit(b"").cast("binary")
    found = manifest.top[-1].filter("total = 1").select("tree", "idx", none.alias("siblings"), none.alias("shape"), "node")
    found = found.withColumn("subroot", F.col("node"))
    for k, level in reversed([*enumerate(manifest.top)]):
        rows = level.filter("total > 1")
        if k == 0:
            below = proofs_below(rows, found, step, "of string") if len(manifest.top) > 1 else found.join(level.select("tree", "idx", "of"), ["tree", "idx"])
            found = below
        elif k < len(manifest.top) - 1:
            found = proofs_below(rows, found, step, "")
    # Of each source: the proof of its root, which is a proof's upper end.
    over = found.select(F.col("of").alias("tree"), F.lit(0).cast("long").alias("idx"), "siblings", "shape", F.col("node").alias("subroot"))
    levels, out = manifest.levels, None
    keep = None
    if wanted is not None:
        keep = levels[0].join(wanted.select("doc_id").distinct(), "doc_id", "left_semi").select("tree", "idx")
    for k in range(len(levels) - 1, -1, -1):
        carry = LEAVES if k == 0 else ""
        names = [n.split()[0] for n in carry.split(", ")] if carry else []
        level = levels[k]
        if keep is not None:
            blocks = keep.select("tree", F.floor(F.col("idx") / F.lit(FAN ** (step * (k + 1)))).cast("long").alias("block")).distinct()
            level = with_block(level, step).join(blocks, ["tree", "block"], "left_semi").drop("block")
        lone = level.filter("total = 1").select("tree", "idx", "node", *names).join(over.drop("idx"), "tree")
        columns = [n.split()[0] for n in PROOF.split(", ")] + ["node", *names]
        lone = lone.select(*columns)
        if out is None:
            out = lone
        else:
            if keep is not None:
                out = out.join(blocks.select("tree", F.col("block").alias("idx")), ["tree", "idx"], "left_semi")
            out = proofs_below(level.filter("total > 1"), out, step, carry).select(*columns).unionByName(lone)
    if keep is not None:
        out = out.join(wanted.select("doc_id").distinct(), "doc_id", "left_semi")
    return out


def without_newlines() -> dict[str, Column]:
    """Where 2 divides the CRC-32 of the decimal doc_id (null: empty), the text loses its newlines."""
    even = F.crc32(F.coalesce(F.col("doc_id").cast("string"), F.lit("")).cast("binary")) % 2 == 0
    return {"text": F.when(even, F.replace(F.col("text"), F.lit("\n"), F.lit(""))).otherwise(F.col("text"))}


def verified(found: DataFrame, root: bytes | None) -> DataFrame:
    """doc_id, leaf, subroot, root, proof_sha256, folded_root and verified from proofs."""
    whole = root.hex() if root else None

    def make():
        def work(rows):
            hexes = [s.hex() for s in rows["siblings"]]
            folded = [fold(t.hex(), s, shape) for t, s, shape in zip(rows["tampered"], hexes, rows["shape"])]
            return {
                "doc_id": rows["doc_id"], "leaf": [n.hex() for n in rows["node"]], "subroot": [n.hex() for n in rows["subroot"]],
                "root": [whole] * len(folded), "proof_sha256": [digest(s) for s in hexes],
                "folded_root": folded, "verified": [f == whole for f in folded],
            }

        return work

    schema = "doc_id long, leaf string, subroot string, root string, proof_sha256 string, folded_root string, verified boolean"
    return map_rows(found.select("doc_id", "node", "tampered", "siblings", "shape", "subroot"), make, schema)


def op11_merkle(spark, sf_dir):
    manifest = build(table(spark, sf_dir, "documents"), without_newlines())
    return verified(proofs(manifest), manifest.root)


ORACLE = r"""
WITH RECURSIVE docs AS (
    SELECT row_number() OVER () AS k, doc_id, source, text,
        CASE WHEN doc_id IS NULL THEN '-' ELSE strlen(doc_id::VARCHAR) || ':' || doc_id END
        || CASE WHEN source IS NULL THEN '-' ELSE strlen(source) || ':' || source END
        || CASE WHEN lang IS NULL THEN '-' ELSE strlen(lang) || ':' || lang END
        || CASE WHEN n_chars IS NULL THEN '-' ELSE strlen(n_chars::VARCHAR) || ':' || n_chars END AS head,
        xor(list_reduce(
            list_prepend(4294967295::BIGINT, list_transform(range(1, strlen(coalesce(doc_id::VARCHAR, '')) + 1),
                lambda i: ascii(substr(doc_id::VARCHAR, i, 1))::BIGINT)),
            lambda c, b: list_reduce([xor(c, b), 0, 0, 0, 0, 0, 0, 0, 0],
                lambda x, y: xor(x >> 1, 3988292384::BIGINT * (x & 1)))), 4294967295::BIGINT) AS crc
    FROM documents
), hashed AS (
    SELECT k, doc_id, CASE WHEN source IS NULL THEN '' ELSE '=' || source END AS tree,
        sha256(head || CASE WHEN text IS NULL THEN '-' ELSE strlen(text) || ':' || text END) AS leaf,
        sha256(head || CASE WHEN text IS NULL THEN '-'
            WHEN crc % 2 = 0 THEN strlen(replace(text, chr(10), '')) || ':' || replace(text, chr(10), '')
            ELSE strlen(text) || ':' || text END) AS tampered
    FROM docs
), leaves AS (
    SELECT *, row_number() OVER (PARTITION BY tree ORDER BY doc_id NULLS FIRST, leaf, k) - 1 AS idx,
        count(*) OVER (PARTITION BY tree) AS total
    FROM hashed
), low AS (
    SELECT tree, 0 AS level, idx, total, leaf AS node FROM leaves
    UNION ALL
    SELECT tree, level + 1, idx // 3, (total + 2) // 3, sha256(string_agg(node, '' ORDER BY idx))
    FROM low WHERE total > 1 GROUP BY tree, level, idx // 3, total
), subroots AS (
    SELECT tree, node, row_number() OVER (ORDER BY tree) - 1 AS idx, count(*) OVER () AS total FROM low WHERE total = 1
), high AS (
    SELECT 0 AS level, idx, total, node FROM subroots
    UNION ALL
    SELECT level + 1, idx // 3, (total + 2) // 3, sha256(string_agg(node, '' ORDER BY idx))
    FROM high WHERE total > 1 GROUP BY level, idx // 3, total
), runs AS (
    SELECT tree, level, idx // 3 AS run, list(node ORDER BY idx) AS nodes FROM low WHERE total > 1 GROUP BY ALL
    UNION ALL
    SELECT NULL, level, idx // 3, list(node ORDER BY idx) FROM high WHERE total > 1 GROUP BY level, idx // 3
), inside AS (
    SELECT k, tree, 0 AS level, idx, total, tampered AS own, '' AS proof FROM leaves
    UNION ALL
    SELECT k, i.tree, i.level + 1, idx // 3, (total + 2) // 3,
        sha256(array_to_string(nodes[1:idx % 3] || [own] || nodes[idx % 3 + 2:], '')),
        proof || array_to_string(nodes[1:idx % 3] || nodes[idx % 3 + 2:], '')
    FROM inside i JOIN runs r ON r.tree = i.tree AND r.level = i.level AND r.run = i.idx // 3 WHERE total > 1
), outside AS (
    SELECT i.k, 0 AS level, s.idx, s.total, i.own, i.proof, s.node AS subroot
    FROM inside i JOIN subroots s USING (tree) WHERE i.total = 1
    UNION ALL
    SELECT k, o.level + 1, idx // 3, (total + 2) // 3,
        sha256(array_to_string(nodes[1:idx % 3] || [own] || nodes[idx % 3 + 2:], '')),
        proof || array_to_string(nodes[1:idx % 3] || nodes[idx % 3 + 2:], ''), subroot
    FROM outside o JOIN runs r ON r.tree IS NULL AND r.level = o.level AND r.run = o.idx // 3 WHERE total > 1
)
SELECT l.doc_id, l.leaf, o.subroot, h.node AS root, sha256(o.proof) AS proof_sha256,
    o.own AS folded_root, o.own = h.node AS verified
FROM outside o JOIN leaves l USING (k) JOIN high h ON h.total = 1
WHERE o.total = 1
"""
