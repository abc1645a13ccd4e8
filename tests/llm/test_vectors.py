import numpy as np
import pytest
from pyspark.sql import functions as F

from loomsync.llm import ann, mtree


@pytest.fixture(scope="module")
def vectors():
    rng = np.random.default_rng(8)
    centers = rng.normal(size=(12, 16))
    v = centers[rng.integers(0, 12, 1500)] + 0.6 * rng.normal(size=(1500, 16))
    v[100:400] = v[100]  # a common vector
    return [(i, x.astype(np.float32).tolist()) for i, x in enumerate(v)]


def _frame(spark, vectors):
    bad = [(2000, None), (2020, [float("nan")] * 16), (2040, [None] + [1.0] * 15), (2060, [float("inf")] * 16)]
    return spark.createDataFrame([(i, v, 1) for i, v in vectors + bad], "vec_id long, embedding array<float>, score int")


@pytest.mark.parametrize("tree,block", [(16384, 2048), (200, 5)])
def test_top_k_against_all_products(spark, vectors, tree, block):
    rows = _frame(spark, vectors).where(mtree.usable("embedding")).select("vec_id", mtree.quantized("embedding").alias("vector"))
    got = {}
    for r in mtree.top_k(rows, F.col("vec_id") % 100 == 0, 10, tree, block).collect():
        got.setdefault(r[0], []).append(tuple(r)[1:])
    ids = np.array([i for i, _ in vectors])
    whole = np.floor(np.array([v for _, v in vectors], np.float64) * 1024).astype(np.int64)
    assert sorted(got) == list(range(0, 1500, 100))
    for q, found in got.items():
        score = whole @ whole[q]
        order = [i for i in np.lexsort((ids, -score)) if i != q][:10]
        assert sorted(found) == [(n + 1, i, score[i]) for n, i in enumerate(order)]


@pytest.mark.parametrize("settings", [ann.Settings(list_size=32, lists=24, block=64), ann.Settings(list_size=16, lists=2, scan=1)])
def test_neighbours_recall(spark, vectors, settings):
    df = _frame(spark, vectors + [(1500, [0.0] * 16)])
    found = ann.nearest(df, F.col("vec_id") % 20 == 0, 20, settings=settings).collect()
    whole = np.array([v for _, v in vectors], np.float64)
    got = {}
    for q, rank, i, score in found:
        assert i != q and abs(score - whole[i] @ whole[q]) < 1e-9
        got.setdefault(q, []).append((rank, i, score))
    assert sorted(got) == list(range(0, 1500, 20))
    hits = 0
    for q, rows in got.items():
        rows.sort()
        assert [r[0] for r in rows] == list(range(1, 21))
        assert [(-r[2], r[1]) for r in rows] == sorted((-r[2], r[1]) for r in rows)
        products = (whole * whole[q]).sum(1)
        best = [i for i in np.lexsort((np.arange(1500), -products)) if i != q][:20]
        hits += sum(products[r[1]] >= products[best[-1]] for r in rows)
    assert hits / (20 * len(got)) >= 0.9


def test_recall_without_structure_in_many_lists(spark):
    rng = np.random.default_rng(5)
    v = rng.normal(size=(6000, 48))
    v = (v / np.sqrt((v * v).sum(1, keepdims=True))).astype(np.float32)
    df = spark.createDataFrame([(i, x.tolist()) for i, x in enumerate(v)], "vec_id long, embedding array<float>")
    got = {}
    for q, _, i, _ in ann.nearest(df, F.col("vec_id") % 20 == 0, 20, settings=ann.Settings(list_size=8)).collect():
        got.setdefault(q, set()).add(i)
    products = v.astype(np.float64) @ v.astype(np.float64).T
    np.fill_diagonal(products, -np.inf)
    hits = sum(len(got[q] & set(np.argsort(-products[q])[:20])) for q in range(0, 6000, 20))
    assert hits / (20 * 300) >= 0.9


def test_no_vectors(spark):
    df = spark.createDataFrame([(1, None)], "vec_id long, embedding array<float>")
    assert ann.nearest(df, F.lit(True), 5).count() == 0
    rows = df.where(mtree.usable("embedding")).select("vec_id", mtree.quantized("embedding").alias("vector"))
    assert mtree.top_k(rows, F.lit(True), 5).count() == 0


def test_null_and_repeated_ids(spark):
    """Each row asks and answers for itself, whatever its id."""
    rows = [(0, [1.0, 0.0]), (0, [0.0, 1.0]), (None, [0.9, 0.1]), (None, [0.1, 0.9]), (3, [0.9, 0.1])]
    df = spark.createDataFrame(rows, "vec_id long, embedding array<float>")
    asks = F.coalesce(F.col("vec_id") == 0, F.lit(False))
    quantized = df.select("vec_id", mtree.quantized("embedding").alias("vector"))
    exact = mtree.top_k(quantized, asks, 3).collect()
    near = ann.nearest(df, asks, 3).collect()
    for found in (exact, near):
        assert sorted((r["query_id"], r["rank"]) for r in found) == [(0, 1), (0, 1), (0, 2), (0, 2), (0, 3), (0, 3)]
        lists = {}
        for r in found:
            lists.setdefault(round(r["score"], 3), []).append((r["rank"], r["vec_id"]))
        # For [1, 0]: 3 and a null id share the best score, and the null comes last; then the other null row.
        assert sorted((r["rank"], r["vec_id"] is None, r["vec_id"] or 0) for r in found) == sorted(
            [(1, False, 3), (2, True, 0), (3, True, 0), (1, True, 0), (2, False, 3), (3, True, 0)]
        )
