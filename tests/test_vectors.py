import numpy as np
import pytest
from pyspark.sql import functions as F

from answerloom.operators import vectors as V


@pytest.fixture(scope="module")
def data():
    rng = np.random.default_rng(7)
    vecs = rng.normal(size=(300, 8)).astype(np.float32)
    vecs[10] = vecs[20]  # an exact tie
    return vecs


@pytest.fixture(scope="module")
def vectors(spark, data):
    rows = [(i, [float(x) for x in v]) for i, v in enumerate(data)]
    return spark.createDataFrame(rows, "vec_id long, vec array<float>").repartition(5)


@pytest.fixture(scope="module")
def queries(vectors):
    return vectors.where("vec_id % 29 = 10").select(F.col("vec_id").alias("qid"), "vec")


def brute(data, qids, k, metric, allowed=None):
    wide = data.astype(np.float64)
    want = []
    for q in qids:
        if metric == "l2":
            keys = np.round(((wide - wide[q]) ** 2).sum(axis=1), 9)
        else:
            keys = np.round(-(wide @ wide[q]), 9)
        order = [i for i in np.lexsort((np.arange(len(keys)), keys)) if allowed is None or i in allowed[q]]
        want += [(int(q), int(i), r) for r, i in enumerate(order[:k], 1)]
    return sorted(want)


def collected(hits):
    return sorted((r["qid"], r["vec_id"], r["rank"]) for r in hits.collect())


@pytest.mark.parametrize("metric", ["l2", "ip"])
@pytest.mark.parametrize("limit,cell_rows", [(10**9, 1000), (0, 1000), (0, 37), (0, 4)])
def test_exhaustive_search(vectors, queries, data, metric, limit, cell_rows):
    qids = [r["qid"] for r in queries.collect()]
    got = V.vector_topk(vectors, queries, 6, metric, limit, cell_rows)
    assert collected(got) == brute(data, qids, 6, metric)


def test_more_neighbours_than_vectors(vectors, queries):
    got = V.vector_topk(vectors, queries, 1000)
    assert got.count() == 300 * queries.count()


def test_unknown_metric(vectors, queries):
    with pytest.raises(ValueError):
        V.vector_topk(vectors, queries, 1, "cosine")


@pytest.mark.parametrize("limit,cell_rows", [(10**9, 1000), (0, 11)])
def test_lists(vectors, queries, data, limit, cell_rows):
    index = V.build_ivf(vectors, n_clusters=6, seed=3)
    centers = {r["cluster"]: np.array(r["center"]) for r in index.centroids.collect()}
    lists = {r["vec_id"]: r["cluster"] for r in index.vectors.collect()}
    for i, v in enumerate(data.astype(np.float64)):
        nearest = min(((v - c) ** 2).sum() for c in centers.values())
        assert ((v - centers[lists[i]]) ** 2).sum() <= nearest + 1e-9
    qids = [r["qid"] for r in queries.collect()]
    every = V.ivf_topk(index, queries, 5, nprobe=6, limit=limit, cell_rows=cell_rows)
    assert collected(every) == brute(data, qids, 5, "l2")
    one = V.ivf_topk(index, queries, 5, nprobe=1, limit=limit, cell_rows=cell_rows)
    allowed = {q: {i for i, c in lists.items() if c == lists[q]} for q in qids}
    assert collected(one) == brute(data, qids, 5, "l2", allowed)


@pytest.mark.parametrize("n", [1, 3])
def test_any_number_of_lists(spark, vectors, data, n):
    """Above the limit, here 0, centroids are grouped; the nearest stay those of a full comparison."""
    centroids = vectors.where("vec_id < 120").select(F.col("vec_id").cast("int").alias("cluster"), F.col("vec").cast("array<double>").alias("center"))
    for limit in (0, 10**9):
        got = V.nearest_clusters(vectors.select("vec_id", "vec"), centroids, n, limit).collect()
        assert len(got) == 300
        for r in got:
            keys = np.round(((data[:120].astype(np.float64) - data[r["vec_id"]].astype(np.float64)) ** 2).sum(axis=1), 9)
            assert list(r["clusters"]) == np.lexsort((np.arange(120), keys))[:n].tolist()


def test_pivots_rule_groups_out(spark):
    """On clustered data, a query searches far fewer groups than there are; hot vectors stay whole."""
    rng = np.random.default_rng(3)
    rows = [(i, [float(x) for x in rng.normal(size=4) * 0.01 + (i % 20) * 10]) for i in range(400)]
    rows += [(1000 + i, [0.0, 0.0, 0.0, 0.0]) for i in range(200)]
    df = spark.createDataFrame(rows, "vec_id long, vec array<double>")
    queries = df.select(F.col("vec_id").alias("qid"), "vec")
    groups = V._group(df)
    probes = V._reach(groups, queries.withColumn("worst", F.lit(0.01)), "l2", False).count()
    assert probes < 0.2 * 600 * len(groups.shared.value[0])
    got = V.vector_topk(df, queries, 5, limit=0, cell_rows=50)
    want = V.vector_topk(df, queries, 5)
    assert collected(got) == collected(want)


def test_no_vectors(spark, vectors, queries):
    assert V.vector_topk(vectors.limit(0), queries, 3, limit=0).count() == 0
    assert V.vector_topk(vectors, queries.limit(0), 3, limit=-1).count() == 0


@pytest.mark.parametrize("bits,dims", [(4, 8), (8, 8), (4, 7)])
@pytest.mark.parametrize("limit", [0, 10**9])
def test_search_on_packed_codes(spark, data, bits, dims, limit):
    rows = [(i, [float(x) for x in v[:dims]]) for i, v in enumerate(data)]
    vectors = spark.createDataFrame(rows, "vec_id long, vec array<float>")
    index = V.with_codes(V.assign_clusters(vectors, vectors.where("vec_id < 4").select(F.col("vec_id").cast("int").alias("cluster"), F.col("vec").alias("center"))), bits)
    assert {len(r.codes) for r in index.codes.collect()} == {-(-dims * bits // 8)}
    decode = V._decoder(index.bounds, bits)
    back = {r.vec_id: r.vec for r in V.dequantize(V.quantize(vectors, bits, index.bounds), index.bounds, bits).collect()}
    packed = index.codes.toPandas()
    assert np.allclose(decode(packed["codes"]), [back[i] for i in packed["vec_id"]])
    queries = vectors.where("vec_id % 29 = 10").select(F.col("vec_id").alias("qid"), "vec")
    qids = [r["qid"] for r in queries.collect()]
    # Every vector is re-ranked, so the result is exact.
    got = V.ivf_topk(index, queries, 5, nprobe=4, limit=limit, refine=60)
    assert collected(got) == brute(data[:, :dims], qids, 5, "l2")


def test_short_lists_give_fewer_rows(spark, vectors):
    few = vectors.where("vec_id < 3")
    index = V.build_ivf(few, n_clusters=3, seed=1)
    got = V.ivf_topk(index, few.select(F.col("vec_id").alias("qid"), "vec"), 5, nprobe=1)
    assert got.count() == 3


@pytest.mark.parametrize("bits", [4, 8])
def test_quantization_error_is_below_half_a_step(vectors, data, bits):
    bounds = V.dimension_bounds(vectors)
    coded = V.quantize(vectors, bits, bounds)
    rows = coded.select("codes").collect()
    assert max(max(r["codes"]) for r in rows) == 2**bits - 1
    assert min(min(r["codes"]) for r in rows) == 0
    back = {r["vec_id"]: r["vec"] for r in V.dequantize(coded, bounds, bits).collect()}
    step = (data.max(axis=0) - data.min(axis=0)) / (2**bits - 1)
    for i, v in back.items():
        assert (np.abs(np.array(v) - data[i]) <= step / 2 + 1e-6).all()


def test_constant_dimension(spark):
    df = spark.createDataFrame([(0, [1.0, 2.0]), (1, [1.0, 4.0])], "vec_id long, vec array<float>")
    got = {r["vec_id"]: r["codes"] for r in V.quantize(df, 4).collect()}
    assert got == {0: [0, 0], 1: [0, 15]}


def test_lists_of_codes_give_nearly_exact_distances(vectors, queries):
    exact = V.ivf_topk(V.build_ivf(vectors, 4, seed=2), queries, 300, nprobe=4)
    coded = V.ivf_topk(V.build_ivf(vectors, 4, seed=2, bits=8), queries, 300, nprobe=4)
    both = exact.join(coded.withColumnRenamed("score", "near"), ["qid", "vec_id"])
    assert both.count() == exact.count()
    assert both.agg(F.max(F.abs(F.col("score") - F.col("near")))).first()[0] < 0.5


def test_groups_go_to_slices_not_to_queries(spark):
    """Where nothing can be ruled out, a group is asked for once per slice, not once per query."""
    rng = np.random.default_rng(5)
    df = spark.createDataFrame([(i, [float(x) for x in v]) for i, v in enumerate(rng.normal(size=(400, 16)))], "vec_id long, vec array<double>")
    queries = df.select(F.col("vec_id").alias("qid"), "vec")
    groups = V._group(df)
    own = V._reach(groups, queries, "l2", True)
    counts = V._slices(own, 50).collect()
    assert max(r["first"] + r["n"] for r in counts) <= 2 * -(-400 // 50) + 1
    asked = queries.withColumns({"slice_q": (F.col("qid") % 8).cast("int"), "worst": F.lit(None).cast("double")})
    needed = V._reach(groups, asked, "l2", False, "slice_q").distinct().count()
    assert needed <= 8 * len(groups.shared.value[0])


def test_best_rows_take_a_fixed_size():
    """Any number of offered vectors leaves ``k`` per query; equal keys go by id, repeated ones stay."""
    rng = np.random.default_rng(9)
    vecs = np.round(rng.normal(size=(5000, 4)), 1)
    best = V._BestK(3, "ip", np.arange(40), vecs[:40])
    for at in range(0, 5000, 700):
        best.add(np.arange(at, min(at + 700, 5000))[::-1], vecs[at : at + 700][::-1])
    assert best.ids.nbytes + best.scores.nbytes + best.keys.nbytes == 40 * 3 * 24
    keys = np.round(-(vecs[:40] @ vecs.T), 9)
    assert best.ids.tolist() == [np.lexsort((np.arange(5000), k))[:3].tolist() for k in keys]
