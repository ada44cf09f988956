"""Dense search: exhaustive, clustered (inverted lists) and quantized vectors.

Distances are computed in tasks on Arrow batches with numpy. A task keeps the
best ``k`` rows per query and hands on nothing else, so no table of all pairs
ever exists.

Query sets too large to send to every task are cut into cells of bounded size. A
task holds one cell's queries with their best rows, and the vectors stream past.

The vectors are then grouped too. A group holds the vectors nearest to one pivot,
with its radius. A query first searches the group of its nearest pivot; its k-th
score there then rules out, by the triangle inequality, every group that cannot
hold anything better. A group goes to the cells with a query that needs it. The
result is exact. Lists of any number are found the same way: their centroids are
grouped.
"""

from __future__ import annotations

import math
from collections.abc import Callable, Iterator
from dataclasses import dataclass, replace

import numpy as np
import pandas as pd
import pyarrow as pa
import pyarrow.compute as pc
from pyspark import Broadcast
from pyspark.ml.clustering import KMeans
from pyspark.ml.functions import array_to_vector
from pyspark.sql import DataFrame
from pyspark.sql import functions as F
from pyspark.sql import types as T

from ..config import BROADCAST_BYTES, CELL_BYTES, CELL_PAIRS, CELL_ROWS, FEW_CELLS, NUM_CLUSTERS, PIVOT_BYTES, QUERY_BYTES
from ..session import stored
from .ranking import top_k
from .sizing import measured_bytes

HIT_SCHEMA = "qid long, vec_id long, score double"
# Scores computed at a time; bounds the distance matrix.
BLOCK = 1 << 20
# Vectors of such a block.
BLOCK_VECTORS = 2048
_NO_ID = np.iinfo(np.int64).max


def _matrix(column: pd.Series) -> np.ndarray:
    return np.stack(column.to_numpy()).astype(np.float64)


def _dense(column: pa.Array) -> np.ndarray:
    """Rows of a list column as a matrix."""
    sizes = pc.min_max(pc.list_value_length(column)).as_py()
    if column.null_count or sizes["min"] != sizes["max"]:
        raise ValueError("vectors must all be given and have one length")
    flat = column.flatten().to_numpy(zero_copy_only=False).astype(np.float64)
    return flat.reshape(len(column), sizes["min"] or 0)


Decode = Callable[[pd.Series], np.ndarray]


def _scores(vectors: np.ndarray, queries: np.ndarray, metric: str) -> np.ndarray:
    """Queries x vectors; smaller is better for ``l2``, larger for ``ip``."""
    products = queries @ vectors.T
    if metric == "ip":
        return products
    squares = (queries**2).sum(axis=1)[:, None] + (vectors**2).sum(axis=1)[None, :]
    return np.maximum(squares - 2 * products, 0.0)


def _runs(*columns: np.ndarray) -> Iterator[slice]:
    """Runs of equal rows of the columns."""
    n = len(columns[0])
    changes = np.zeros(max(n - 1, 0), bool)
    for column in columns:
        changes |= column[1:] != column[:-1]
    bounds = [0, *(np.flatnonzero(changes) + 1), n]
    for start, end in zip(bounds[:-1], bounds[1:]):
        if end > start:
            yield slice(int(start), int(end))


class _BestK:
    """Running best ``k`` (score, vec_id) rows of each query row, in arrays of a fixed size.

    ``keys`` are the scores to 9 digits, smaller is better. A row with ``worst``, a score that its
    k-th row need not exceed, never takes rows beyond it.
    """

    def __init__(self, k: int, metric: str, qids: np.ndarray, queries: np.ndarray, worst: np.ndarray | None = None):
        self.k, self.metric, self.qids, self.queries = k, metric, qids, queries
        self.squares = (queries**2).sum(axis=1)
        shape = (len(qids), k)
        self.ids, self.scores = np.full(shape, _NO_ID), np.zeros(shape)
        self.keys, self.counts = np.full(shape, np.inf), np.zeros(len(qids), np.int64)
        self.limits = np.full(len(qids), np.inf)
        if worst is not None:
            given = np.round(-worst if metric == "ip" else worst, 9)
            self.limits = np.where(np.isnan(worst), np.inf, given)

    def add(self, ids: np.ndarray, vectors: np.ndarray, rows: np.ndarray | None = None) -> None:
        """Offer vectors to the query rows ``rows``, or to all."""
        rows = np.arange(len(self.qids)) if rows is None else rows
        for at in range(0, len(ids), BLOCK_VECTORS):
            block = slice(at, at + BLOCK_VECTORS)
            part, part_ids = vectors[block], ids[block]
            squares = (part**2).sum(axis=1)
            step = max(1, BLOCK // len(part_ids))
            for first in range(0, len(rows), step):
                self._offer(rows[first : first + step], part_ids, part, squares)

    def _offer(self, rows: np.ndarray, ids: np.ndarray, vectors: np.ndarray, squares: np.ndarray) -> None:
        products = self.queries[rows] @ vectors.T
        # In products less half the vector's square, larger is better for both metrics.
        if self.metric == "ip":
            worth, least = products, -self.limits[rows]
            slack = 1e-8 * (1 + self.squares[rows] + squares.max())
        else:
            worth, least = products - squares / 2, (self.squares[rows] - self.limits[rows]) / 2
            slack = 1e-8 * (1 + self.squares[rows] + squares.max())
        open_rows = np.flatnonzero(np.isinf(least))
        if len(open_rows) and len(ids) > self.k:
            at = len(ids) - self.k
            least[open_rows] = np.partition(worth[open_rows], at, axis=1)[:, at]
        row, col = np.nonzero(worth >= (least - slack)[:, None])
        if not len(row):
            return
        scores = products[row, col]
        if self.metric == "l2":
            scores = np.maximum(self.squares[rows[row]] + squares[col] - 2 * scores, 0.0)
        keys = np.round(-scores if self.metric == "ip" else scores, 9)
        good = keys <= self.limits[rows[row]]
        self._merge(rows[row[good]], ids[col[good]], scores[good], keys[good])

    def _merge(self, rows: np.ndarray, ids: np.ndarray, scores: np.ndarray, keys: np.ndarray) -> None:
        """Candidates of ascending ``rows``."""
        if not len(rows):
            return
        changed, more = np.unique(rows, return_counts=True)
        rows = np.concatenate([np.repeat(changed, self.k), rows])
        ids = np.concatenate([self.ids[changed].ravel(), ids])
        scores = np.concatenate([self.scores[changed].ravel(), scores])
        keys = np.concatenate([self.keys[changed].ravel(), keys])
        order = np.lexsort((ids, keys, rows))
        ends = np.cumsum(more + self.k)
        kept = order[((ends - more - self.k)[:, None] + np.arange(self.k)).ravel()]
        shape = (len(changed), self.k)
        self.ids[changed], self.scores[changed] = ids[kept].reshape(shape), scores[kept].reshape(shape)
        self.keys[changed] = keys[kept].reshape(shape)
        self.counts[changed] = np.minimum(self.counts[changed] + more, self.k)
        self.limits[changed] = np.minimum(self.limits[changed], self.keys[changed, -1])

    def rows(self) -> dict[str, np.ndarray]:
        filled = np.arange(self.k) < self.counts[:, None]
        return {"qid": np.repeat(self.qids, self.counts), "vec_id": self.ids[filled], "score": self.scores[filled]}


def _best(hits: DataFrame, k: int, metric: str) -> DataFrame:
    best_first = F.desc if metric == "ip" else F.asc
    return top_k(hits, "qid", [best_first(F.round("score", 9)), F.asc("vec_id")], k)


def _row_bytes(vec: str = "vec"):
    return (F.size(vec) * 8 + 32).cast("long")


def _cell_rows(probes: DataFrame, k: int, cell_rows: int | None) -> int:
    """Queries of a cell: as many as given, or as let ``FEW_CELLS`` share the work within ``CELL_ROWS``.

    Their values and best rows take ``CELL_BYTES`` at most.
    """
    if cell_rows is not None:
        return cell_rows
    count, widest = probes.agg(F.count("*"), F.max(_row_bytes())).first()
    fitting = CELL_BYTES // ((widest or 1) + 24 * k)
    return max(1, min(fitting, CELL_ROWS, max(-(-count // FEW_CELLS), CELL_ROWS // FEW_CELLS)))


def _search(
    vectors: DataFrame, probes: DataFrame, k: int, limit: int, cell_rows: int | None, decode: Decode = _matrix
) -> DataFrame:
    """Nearest ``k`` of ``vectors(cluster, vec_id, vec)`` for ``probes(cluster, qid, vec)``.

    Probes measured to be small go to every task and the vectors stay where they
    are. Otherwise both sides are cut into cells of bounded size.
    """
    if measured_bytes(probes, _row_bytes()) <= limit:
        return _best(_search_in_place(vectors, probes, k, "l2", decode), k, "l2")
    return _best(_search_in_cells(vectors, probes, k, "l2", _cell_rows(probes, k, cell_rows), decode), k, "l2")


def _search_in_place(
    vectors: DataFrame, probes: DataFrame, k: int, metric: str, decode: Decode = _matrix
) -> DataFrame:
    sent = probes.select("cluster", "qid", "vec").toPandas()
    wanted = {
        cluster: (rows["qid"].to_numpy(), _matrix(rows["vec"]))
        for cluster, rows in sent.groupby("cluster")
    }
    shared = vectors.sparkSession.sparkContext.broadcast(wanted)

    def run(batches: Iterator[pd.DataFrame]) -> Iterator[pd.DataFrame]:
        best: dict[int, _BestK] = {}
        for batch in batches:
            for cluster, rows in batch.groupby("cluster"):
                if cluster in shared.value:
                    if cluster not in best:
                        best[cluster] = _BestK(k, metric, *shared.value[cluster])
                    best[cluster].add(rows["vec_id"].to_numpy(), decode(rows["vec"]))
        for found in best.values():
            yield pd.DataFrame(found.rows())

    # Lists stored in folders by cluster are only read where probed.
    reached = vectors.select("cluster", "vec_id", "vec").where(
        F.col("cluster").isin(sorted(int(c) for c in wanted))
    )
    return reached.mapInPandas(run, HIT_SCHEMA)


def _search_in_cells(
    vectors: DataFrame, probes: DataFrame, k: int, metric: str, cell_rows: int, decode: Decode = _matrix
) -> DataFrame:
    """Pair up slices of a cluster's queries with its vectors.

    A cluster is sliced by its measured row counts on both sides, so a cluster holding a
    third of all vectors becomes many cells of about ``cell_rows`` queries and as many
    vectors as make ``CELL_PAIRS`` with them.
    """
    counts = vectors.groupBy("cluster").agg(F.count("*").alias("v")).join(
        probes.groupBy("cluster").agg(F.count("*").alias("q")), "cluster")
    # One row per cluster.
    counts = F.broadcast(counts.select(
        "cluster",
        F.ceil(F.col("q") / cell_rows).cast("int").alias("n_q"),
        F.ceil(F.col("v") * F.least("q", F.lit(cell_rows)) / CELL_PAIRS).cast("int").alias("n_v"),
    ))

    def sliced(df: DataFrame, key: str, own: str, other: str) -> DataFrame:
        slice_no = F.pmod(F.xxhash64(key), F.col(f"n_{own}")).cast("int")
        copies = F.explode(F.sequence(F.lit(0), F.col(f"n_{other}") - 1))
        rows = df.join(counts, "cluster").withColumn(f"slice_{own}", slice_no).withColumn(f"slice_{other}", copies)
        return rows.select(F.col("cluster").alias("area"), "slice_q", "slice_v", "cluster", key, "vec")

    asked = sliced(probes, "qid", "q", "v").withColumn("worst", F.lit(None).cast("double"))
    return _stream(sliced(vectors, "vec_id", "v", "q"), asked, k, metric, decode)


def _stream(
    vectors: DataFrame, probes: DataFrame, k: int, metric: str, decode: Decode = _matrix,
    shared: Broadcast | None = None,
) -> DataFrame:
    """Best ``k`` of each cell ``(area, slice_q, slice_v)``.

    ``vectors(*cell, cluster, vec_id, vec)`` and ``probes(*cell, cluster, qid, vec, worst)``. A task
    sorts its cells so that the queries come first, and holds only the queries of one cell. With
    ``shared`` pivots and radii, a query is spared the groups that it can rule out, and its own.
    """
    spark, cell = vectors.sparkSession, ["area", "slice_q", "slice_v"]
    coded = vectors.schema["vec"].dataType == T.BinaryType()
    kind = probes.schema["vec"].dataType
    if not coded and vectors.schema["vec"].dataType != kind:
        kind = T.ArrayType(T.DoubleType())
    empty = F.lit(None).cast(T.BinaryType())
    asked = probes.select(
        *cell, F.lit(0).alias("side"), F.col("cluster").cast("long"), F.col("qid").cast("long").alias("key"), "worst",
        F.col("vec").cast(kind), empty.alias("codes"),
    )
    offered = vectors.select(
        *cell, F.lit(1).alias("side"), F.col("cluster").cast("long"), F.col("vec_id").cast("long").alias("key"),
        F.lit(None).cast("double").alias("worst"),
        (F.lit(None) if coded else F.col("vec")).cast(kind).alias("vec"), (F.col("vec") if coded else empty).alias("codes"),
    )
    cells = int(spark.conf.get("spark.sql.shuffle.partitions"))
    order = [*cell, "side", "cluster"]
    rows = asked.unionByName(offered).repartition(cells, *cell).sortWithinPartitions(*order)

    def run(batches: Iterator[pa.RecordBatch]) -> Iterator[pa.RecordBatch]:
        place, waiting, own, best = None, [], None, None

        def found() -> Iterator[pa.RecordBatch]:
            if best is not None:
                yield pa.RecordBatch.from_pydict(best.rows())

        for batch in batches:
            if not len(batch):
                continue
            columns = {n: batch.column(n).to_numpy(zero_copy_only=False) for n in [*order, "key", "worst"]}
            for at in _runs(*[columns[n] for n in order]):
                here = tuple(columns[n][at.start] for n in cell)
                if here != place:
                    yield from found()
                    place, waiting, best = here, [], None
                part = batch.slice(at.start, at.stop - at.start)
                if columns["side"][at.start] == 0:
                    waiting.append((columns["key"][at], _dense(part.column("vec")), columns["worst"][at].astype(np.float64), columns["cluster"][at]))
                    continue
                if waiting:
                    qids, queries, worst, own = (np.concatenate(c) for c in zip(*waiting))
                    best, waiting = _BestK(k, metric, qids, queries, worst), []
                if best is None:
                    continue
                cluster, needy = columns["cluster"][at.start], None
                if shared is not None:
                    pivots, radius = shared.value
                    signs = -best.limits if metric == "ip" else best.limits
                    needy = _may_hold(best.queries, signs[:, None], pivots[[cluster]], radius[[cluster]], metric)[:, 0]
                    needy = np.flatnonzero(needy & (own != cluster))
                values = decode(part.column("codes").to_pylist()) if coded else _dense(part.column("vec"))
                best.add(columns["key"][at], values, needy)
        yield from found()

    return rows.mapInArrow(run, HIT_SCHEMA)


@dataclass(frozen=True)
class _Groups:
    """``vectors(cluster, vec_id, vec)`` by nearest pivot; pivots, and each one's radius (-1: no vector)."""

    vectors: DataFrame
    shared: Broadcast


def _near_together(pivots: np.ndarray) -> np.ndarray:
    """The pivots, those next to the same one of the first few in a row."""
    few = pivots[: math.isqrt(len(pivots)) or 1]
    if not len(few):
        return pivots
    return pivots[np.argsort(_scores(few, pivots, "l2").argmin(axis=1), kind="stable")]


def _group(vectors: DataFrame) -> _Groups:
    """Group vectors around pivots: as many as the root of their number, at most ``PIVOT_BYTES``.

    Pivots are vectors in the order of a hash.
    """
    spark = vectors.sparkSession
    count, width = vectors.agg(F.count("*"), F.max(F.size("vec"))).first()
    n = min(math.isqrt(max(count - 1, 0)) + 1, max(1, PIVOT_BYTES // (8 * (width or 1))))
    chosen = vectors.orderBy(F.xxhash64("vec_id"), "vec_id").limit(n).toPandas()
    pivots = _near_together(_matrix(chosen["vec"])) if len(chosen) else np.zeros((0, width or 0))
    sent = spark.sparkContext.broadcast(pivots)

    def near(batches: Iterator[pd.DataFrame]) -> Iterator[pd.DataFrame]:
        for batch in _pieces(batches, len(sent.value)):
            squares = _scores(sent.value, _matrix(batch["vec"]), "l2")
            yield batch.assign(cluster=squares.argmin(axis=1), far=np.sqrt(squares.min(axis=1)))

    kind = vectors.select("vec_id", "vec", F.lit(0).alias("cluster"), F.lit(0.0).alias("far")).schema
    grouped = stored(vectors.select("vec_id", "vec").mapInPandas(near, kind), "groups")
    radius = np.full(len(pivots), -1.0)
    # One row per pivot.
    for row in grouped.groupBy("cluster").agg(F.max("far").alias("far")).collect():
        radius[row["cluster"]] = row["far"]
    return _Groups(grouped.select("cluster", "vec_id", "vec"), spark.sparkContext.broadcast((pivots, radius)))


def _pieces(batches: Iterator[pd.DataFrame], width: int) -> Iterator[pd.DataFrame]:
    """Batches cut so that a row of ``width`` scores each makes at most ``BLOCK``."""
    step = max(1, BLOCK // max(1, width))
    for batch in batches:
        for at in range(0, len(batch), step):
            yield batch.iloc[at : at + step]


def _may_hold(queries: np.ndarray, worst: np.ndarray, pivots: np.ndarray, radius: np.ndarray, metric: str) -> np.ndarray:
    """Queries x groups: whether a group may hold a score as good as ``worst`` (queries x 1; not a number: any)."""
    scores = _scores(pivots, queries, metric)
    slack = 1e-6 * (1 + np.abs(worst))
    with np.errstate(invalid="ignore"):
        if metric == "l2":
            # No vector of a group is nearer than the pivot less the radius.
            least = np.maximum(np.sqrt(scores) - radius, 0) ** 2
            return ~(least > worst + slack)
        # A product exceeds the pivot's by the query's length times the radius at most.
        most = scores + np.linalg.norm(queries, axis=1)[:, None] * radius
        return ~(most < worst - slack)


def _reach(groups: _Groups, queries: DataFrame, metric: str, first: bool, by: str = "qid") -> DataFrame:
    """Probes ``(cluster, qid, vec)`` of each query's first group, or ``(cluster, by)`` of all others it must search.

    The others need ``worst``, the k-th score so far (null: fewer than k). Equal ones may repeat.
    """
    shared = groups.shared

    def run(batches: Iterator[pd.DataFrame]) -> Iterator[pd.DataFrame]:
        pivots, radius = shared.value
        there = radius >= 0
        if not there.any():
            return
        for batch in _pieces(batches, len(pivots)):
            queries = _matrix(batch["vec"])
            scores = _scores(pivots, queries, metric)
            nearest = np.where(there, scores if metric == "l2" else -scores, np.inf).argmin(axis=1)
            if first:
                yield pd.DataFrame({"cluster": nearest, "qid": batch["qid"], "vec": batch["vec"]})
                continue
            worst = batch["worst"].to_numpy(dtype=np.float64)[:, None]
            may = _may_hold(queries, worst, pivots, radius, metric) & there
            may[np.arange(len(nearest)), nearest] = False
            for value, rows in batch.reset_index(drop=True).groupby(by, sort=False).groups.items():
                cluster = np.flatnonzero(may[rows].any(axis=0))
                yield pd.DataFrame({"cluster": cluster, by: np.full(len(cluster), value)})

    kind = queries.select(F.lit(0).alias("cluster"), *(["qid", "vec"] if first else [by])).schema
    return queries.mapInPandas(run, kind)


def _slices(own: DataFrame, rows: int) -> DataFrame:
    """``(cluster, first, n)``: the ``n`` slices from ``first`` for the queries of a group, of ``rows`` each or so.

    Groups in a row share a slice while they fit.
    """
    table, slice_no, used = [], 0, 0
    # One row per pivot.
    for cluster, count in sorted(own.groupBy("cluster").agg(F.count("*")).collect()):
        if used and used + count > rows:
            slice_no, used = slice_no + 1, 0
        n = -(-count // rows)
        table.append((cluster, slice_no, n))
        slice_no, used = (slice_no + n, 0) if n > 1 else (slice_no, used + count)
    return own.sparkSession.createDataFrame(table, "cluster int, first int, n int")


def _search_by_pivots(
    vectors: DataFrame, queries: DataFrame, k: int, metric: str, cell_rows: int | None
) -> DataFrame:
    """Exact nearest ``k`` of ``vectors(vec_id, vec)`` for many ``queries(qid, vec)``."""
    rows = _cell_rows(queries, k, cell_rows)
    groups = _group(vectors)
    own = stored(_reach(groups, queries, metric, True), "own")
    near = stored(_best(_search_in_cells(groups.vectors, own, k, metric, rows), k, metric), "near")
    worst = near.where(F.col("rank") == k).select("qid", F.col("score").alias("worst"))
    slice_q = (F.col("first") + F.pmod(F.xxhash64("qid"), F.col("n"))).cast("int")
    asked = own.join(F.broadcast(_slices(own, rows)), "cluster").withColumn("slice_q", slice_q)
    asked = stored(asked.join(worst, "qid", "left").select("cluster", "qid", "vec", "slice_q", "worst"), "asked")
    needed = stored(_reach(groups, asked, metric, False, "slice_q").distinct(), "needed")
    n_v = -(-groups.vectors.count() * rows // CELL_PAIRS) or 1
    area, slice_v = F.lit(0).alias("area"), F.pmod(F.xxhash64("cluster"), F.lit(n_v)).cast("int")
    offered = groups.vectors.join(needed, "cluster").select(area, "slice_q", slice_v.alias("slice_v"), "cluster", "vec_id", "vec")
    copies = F.explode(F.sequence(F.lit(0), F.lit(n_v - 1))).alias("slice_v")
    asked = asked.select(area, "slice_q", copies, "cluster", "qid", "vec", "worst")
    far = _stream(offered, asked, k, metric, shared=groups.shared)
    return _best(near.drop("rank").unionByName(far), k, metric)


def vector_topk(
    vectors: DataFrame,
    queries: DataFrame,
    k: int,
    metric: str = "l2",
    limit: int = QUERY_BYTES,
    cell_rows: int | None = None,
) -> DataFrame:
    """Nearest ``k`` of ``vectors(vec_id, vec)`` for every row of ``queries(qid, vec)``.

    ``score`` is the squared distance for ``l2`` and the inner product for ``ip``.
    """
    if metric not in ("l2", "ip"):
        raise ValueError(f"unknown metric {metric!r}")
    vectors, queries = vectors.select("vec_id", "vec"), queries.select("qid", "vec")
    if measured_bytes(queries, _row_bytes()) > limit:
        return _search_by_pivots(vectors, queries, k, metric, cell_rows)
    everywhere = F.lit(0).alias("cluster")
    hits = _search_in_place(vectors.select(everywhere, "*"), queries.select(everywhere, "*"), k, metric)
    return _best(hits, k, metric)


@dataclass(frozen=True)
class IvfIndex:
    """``centroids(cluster, center)`` and ``vectors(vec_id, vec, cluster)``.

    A quantized index also has ``codes(vec_id, cluster, codes)``, ``bits`` per dimension packed into
    bytes, and their ``bounds``: a list of 4-bit codes takes a sixteenth of its doubles.
    """

    centroids: DataFrame
    vectors: DataFrame
    codes: DataFrame | None = None
    bounds: DataFrame | None = None
    bits: int | None = None


def nearest_clusters(
    df: DataFrame, centroids: DataFrame, n: int, limit: int = BROADCAST_BYTES
) -> DataFrame:
    """Add ``clusters``, the ``n`` nearest centroids of ``df(key, vec)``, nearest first; ties by number.

    Centroids measured to be small travel to the tasks. More of them are grouped around pivots
    among them, and every vector searches only the groups that may hold its nearest.
    """
    size = measured_bytes(centroids, (F.size("center") * 8).cast("long"))
    if size > limit:
        (key,) = [c for c in df.columns if c != "vec"]
        lists = centroids.select(F.col("cluster").cast("long").alias("vec_id"), F.col("center").alias("vec"))
        wide = df.select(F.col(key).alias("qid"), F.col("vec").cast("array<double>").alias("vec"))
        found = _search_by_pivots(lists, wide, n, "l2", None)
        ranked = F.sort_array(F.collect_list(F.struct("rank", F.col("vec_id").cast("int").alias("c"))))
        return df.join(found.groupBy(F.col("qid").alias(key)).agg(ranked.alias("r")), key).select(*df.columns, F.col("r.c").alias("clusters"))
    table = centroids.orderBy("cluster").toPandas()
    numbers = table["cluster"].to_numpy(dtype=np.int32)
    shared = df.sparkSession.sparkContext.broadcast(_matrix(table["center"]))

    def nearest(batches: Iterator[pd.Series]) -> Iterator[pd.Series]:
        for vecs in batches:
            if len(vecs) == 0:
                yield pd.Series([], dtype=object)
                continue
            values, found = _matrix(vecs), []
            step = max(1, BLOCK // max(1, len(numbers)))
            for at in range(0, len(values), step):
                keys = np.round(_scores(shared.value, values[at : at + step], "l2"), 9)
                found.extend(numbers[np.argsort(keys, axis=1, kind="stable")[:, :n]])
            yield pd.Series(found)

    nearest.__annotations__ = {"batches": Iterator[pd.Series], "return": Iterator[pd.Series]}
    return df.withColumn("clusters", F.pandas_udf(nearest, "array<int>")(F.col("vec")))


def train_centroids(
    vectors: DataFrame, n_clusters: int = NUM_CLUSTERS, seed: int = 42, iterations: int = 20
) -> DataFrame:
    """K-means centers as ``centroids(cluster, center)``."""
    features = vectors.select(array_to_vector(F.col("vec").cast("array<double>")).alias("features"))
    model = KMeans(k=n_clusters, seed=seed, maxIter=iterations).fit(features)
    rows = [(i, [float(x) for x in c]) for i, c in enumerate(model.clusterCenters())]
    schema = T.StructType(
        [
            T.StructField("cluster", T.IntegerType(), False),
            T.StructField("center", T.ArrayType(T.DoubleType()), False),
        ]
    )
    return vectors.sparkSession.createDataFrame(rows, schema)


def assign_clusters(vectors: DataFrame, centroids: DataFrame, limit: int = BROADCAST_BYTES) -> IvfIndex:
    """Put every vector into the list of its nearest centroid."""
    listed = nearest_clusters(vectors.select("vec_id", "vec"), centroids, 1, limit)
    return IvfIndex(
        centroids, listed.withColumn("cluster", F.get("clusters", F.lit(0))).drop("clusters")
    )


def build_ivf(
    vectors: DataFrame,
    n_clusters: int = NUM_CLUSTERS,
    seed: int = 42,
    iterations: int = 20,
    bits: int | None = None,
) -> IvfIndex:
    """Train centroids on ``vectors(vec_id, vec)`` and assign every vector.

    With ``bits`` (4 or 8) lists of packed codes are searched and only the best re-ranked exactly.
    """
    index = assign_clusters(vectors, train_centroids(vectors, n_clusters, seed, iterations))
    return index if bits is None else with_codes(index, bits)


def with_codes(index: IvfIndex, bits: int = 4) -> IvfIndex:
    """The index with lists of packed codes beside its vectors."""
    bounds = dimension_bounds(index.vectors)
    return replace(index, codes=pack_codes(quantize(index.vectors, bits, bounds), bits), bounds=bounds, bits=bits)


def pack_codes(coded: DataFrame, bits: int = 4) -> DataFrame:
    """``codes(vec_id, cluster, codes)`` with each row's codes packed, first dimension first."""
    if bits not in (4, 8):
        raise ValueError("codes of 4 or 8 bits are packed")
    digits = F.transform("codes", lambda c: F.lpad(F.hex(c), bits // 4, "0"))
    text = F.array_join(digits, "")
    text = F.concat(text, F.repeat(F.lit("0"), F.length(text) % 2))
    return coded.select("vec_id", "cluster", F.unhex(text).alias("codes"))


def _decoder(bounds: DataFrame, bits: int) -> Decode:
    """A function from packed codes to the values that they stand for."""
    # One row per dimension.
    rows = bounds.orderBy("dim").toPandas()
    lo, hi = rows["lo"].to_numpy(), rows["hi"].to_numpy()
    steps = np.arange(2**bits) / (2**bits - 1)
    values = lo[:, None] + steps[None, :] * (hi - lo)[:, None]  # by dimension and code

    def decode(column: pd.Series) -> np.ndarray:
        raw = np.frombuffer(b"".join(column), np.uint8).reshape(len(column), -1)
        if bits == 4:
            raw = np.stack([raw >> 4, raw & 15], axis=2).reshape(len(column), -1)
        return values[np.arange(len(lo)), raw[:, : len(lo)]]

    return decode


def ivf_topk(
    index: IvfIndex,
    queries: DataFrame,
    k: int,
    nprobe: int = 1,
    limit: int = BROADCAST_BYTES,
    cell_rows: int | None = None,
    refine: int = 4,
) -> DataFrame:
    """Nearest ``k`` vectors among the ``nprobe`` lists nearest to each query.

    Queries whose lists hold fewer than ``k`` vectors get fewer rows. On a quantized index the
    lists' codes give the ``refine * k`` nearest, whose exact vectors are then read and ranked.
    """
    queries = queries.select("qid", "vec")
    probes = nearest_clusters(queries, index.centroids, nprobe, limit).select(
        F.explode("clusters").alias("cluster"), "qid", "vec"
    )
    limit = min(limit, QUERY_BYTES)
    if index.codes is None:
        return _search(index.vectors, probes, k, limit, cell_rows)
    lists = index.codes.withColumnRenamed("codes", "vec")
    near = _search(lists, probes, refine * k, limit, cell_rows, _decoder(index.bounds, index.bits))
    exact = index.vectors.select("vec_id", F.col("vec").alias("v"))
    pairs = near.select("qid", "vec_id").join(exact, "vec_id").join(queries.select("qid", F.col("vec").alias("q")), "qid")
    q, v = (F.col(name).cast("array<double>") for name in ("q", "v"))
    square = F.aggregate(F.zip_with(q, v, lambda a, b: (a - b) * (a - b)), F.lit(0.0), lambda x, y: x + y)
    return _best(pairs.select("qid", "vec_id", square.alias("score")), k, "l2")


def dimension_bounds(vectors: DataFrame) -> DataFrame:
    """Smallest and largest value per dimension, ``(dim, lo, hi)``.

    Every task reduces its rows to one pair of arrays before the shuffle.
    """

    def reduce(batches: Iterator[pd.DataFrame]) -> Iterator[pd.DataFrame]:
        lo = hi = None
        for batch in batches:
            if len(batch):
                values = _matrix(batch["vec"])
                low, high = values.min(axis=0), values.max(axis=0)
                lo = low if lo is None else np.minimum(lo, low)
                hi = high if hi is None else np.maximum(hi, high)
        if lo is not None:
            yield pd.DataFrame({"dim": np.arange(len(lo)), "lo": lo, "hi": hi})

    return (
        vectors.select("vec")
        .mapInPandas(reduce, "dim int, lo double, hi double")
        .groupBy("dim")
        .agg(F.min("lo").alias("lo"), F.max("hi").alias("hi"))
    )


def _bounds_array(bounds: DataFrame):
    """The bounds as one ordered array; one entry per dimension."""
    packed = bounds.agg(F.sort_array(F.collect_list(F.struct("dim", "lo", "hi"))).alias("b"))
    return packed.scalar()


def quantize(vectors: DataFrame, bits: int = 4, bounds: DataFrame | None = None) -> DataFrame:
    """Add ``codes``: every dimension rounded to ``2**bits`` even steps of its range."""
    bounds = dimension_bounds(vectors) if bounds is None else bounds
    levels = 2**bits - 1

    def code(x, b):
        span = b["hi"] - b["lo"]
        step = F.round((x.cast("double") - b["lo"]) / span * levels)
        return F.when(span > 0, step).otherwise(0.0).cast("int")

    with_bounds = vectors.withColumn("__bounds", _bounds_array(bounds))
    return with_bounds.withColumn("codes", F.zip_with("vec", "__bounds", code)).drop("__bounds")


def dequantize(coded: DataFrame, bounds: DataFrame, bits: int = 4) -> DataFrame:
    """Replace ``vec`` by the value each code stands for."""
    levels = 2**bits - 1

    def value(c, b):
        return b["lo"] + c / levels * (b["hi"] - b["lo"])

    with_bounds = coded.withColumn("__bounds", _bounds_array(bounds))
    return with_bounds.withColumn("vec", F.zip_with("codes", "__bounds", value)).drop("__bounds")
