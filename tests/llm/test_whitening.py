import numpy as np
import pytest

from loomsync.llm import registry, whitening

FIELDS = "vec_id long, embedding array<float>, _whitened string"


def _truth(rows, scale=64):
    x = np.floor(scale * np.array(rows, np.float64)).astype(np.int64)
    distinct = np.unique(x, axis=0)
    n, s = len(distinct), distinct.sum(0)
    centred = distinct - s / n
    e, v = np.linalg.eigh(centred.T @ centred / n)
    return x, n, s, e[::-1], v[:, ::-1]


def _same_up_to_sign(a, b, tolerance=1e-6):
    return min(np.abs(a - b).max(), np.abs(a + b).max()) < tolerance


def test_against_dense_eigenvectors(spark):
    rng = np.random.default_rng(4)
    mixing = rng.normal(size=(24, 24)) * np.linspace(3, 0.2, 24)
    v = (rng.normal(size=(700, 24)) @ mixing).astype(np.float32)
    v[50:300] = v[50]  # copies count once
    rows = [(i, x.tolist(), "x") for i, x in enumerate(v)] + [(7, v[7].tolist(), "again"), (None, v[8].tolist(), None)]
    bad = [(900, None, "x"), (901, [float("nan")] * 24, "x"), (902, [None] + [1.0] * 23, "x"), (903, [float("inf")] * 24, "x"), (904, [], "x"), (905, [1.0, 2.0], "x")]
    df = spark.createDataFrame(rows + bad, FIELDS)
    model = whitening.fit(df)
    x, n, s, e, basis = _truth([r[1] for r in rows])
    assert model.n == n and list(model.sums) == s.tolist()
    assert np.allclose(model.eigenvalues, e[:16], rtol=1e-10)
    assert np.allclose(model.explained, e[:16] / e.sum(), rtol=1e-10)
    assert model.identity_error < 1e-9
    got = whitening.report(whitening.whiten(df, model), model).collect()
    assert len(got) == 16 * len(rows)
    assert {(r["n"], r["identity_error"]) for r in got} == {(n, model.identity_error)}
    by_row = {}
    for r in got:
        by_row.setdefault(r["vec_id"], {}).setdefault(r["component"], []).append((r["whitened"], r["deviation"]))
    assert sorted(by_row, key=lambda i: (i is None, i)) == [*range(700), None]
    deviation = ((n * x - s) ** 2).sum(1)
    assert all(by_row[i][1][0][1] == deviation[i] for i in range(700))
    assert len(by_row[7][1]) == 2
    for c in range(16):
        mine = np.array([by_row[i][c + 1][0][0] for i in range(700)])
        assert _same_up_to_sign(mine, (x[:700] - s / n) @ basis[:, c] / np.sqrt(e[c]))


def test_few_directions_and_no_deviation(spark):
    rng = np.random.default_rng(5)
    flat = np.zeros((80, 6))
    flat[:, :2] = rng.normal(size=(80, 2)) * 5
    model = whitening.fit(spark.createDataFrame([(i, x.tolist()) for i, x in enumerate(flat)], "vec_id long, embedding array<double>"))
    assert model.components.shape == (6, 2) and model.identity_error < 1e-9
    same = spark.createDataFrame([(i, [1.0, 2.0]) for i in range(5)], "vec_id long, embedding array<double>")
    model = whitening.fit(same)
    assert model.n == 1 and whitening.report(whitening.whiten(same, model), model).count() == 0
    none = spark.createDataFrame([(1, None)], "vec_id long, embedding array<float>")
    assert whitening.fit(none) is None
    assert whitening.report(whitening.whiten(none, None), None).count() == 0


def test_huge_entries_do_not_overflow(spark):
    rows = [(0, [1e30, 0.0]), (1, [-1e30, 1.0]), (2, [1.0, 2.0])]
    df = spark.createDataFrame(rows, "vec_id long, embedding array<double>")
    model = whitening.fit(df, components=1)
    assert all(r["_deviation"] is None or r["_deviation"] >= 0 for r in whitening.whiten(df, model).collect())


def test_a_large_dimension_stops_when_the_wanted_ones_are_settled():
    rng = np.random.default_rng(6)
    x = rng.normal(size=(400, 150)) * 0.7 ** np.arange(150)
    x -= x.mean(0)
    steps = []

    def product(r, p):
        w = x @ r
        steps.append(1)
        return w @ w, (x @ p).T @ w, x.T @ w

    values, found = whitening.bidiagonalize(product, 150, 4)
    _, true, rows = np.linalg.svd(x, full_matrices=False)
    assert len(steps) < 100
    assert np.allclose(values[:4], true[:4], rtol=1e-12)
    assert all(_same_up_to_sign(found[:, i], rows[i], 1e-9) for i in range(4))


@pytest.mark.parametrize("folder", ["/root/testdata/sf0.001"])
def test_query(spark, folder):
    got = registry.QUERIES["op11_embedding_whitening"](spark, folder).toPandas()
    rows = spark.read.parquet(f"{folder}/embeddings.parquet").toPandas()
    x, n, s, e, basis = _truth(rows["embedding"].tolist())
    assert len(got) == 16 * len(rows) and set(got["n"]) == {n}
    assert got["identity_error"].max() < 1e-8
    for c in range(1, 17):
        mine = got[got["component"] == c].set_index("vec_id")
        assert np.allclose(mine["explained"], e[c - 1] / e.sum(), rtol=1e-9)
        assert _same_up_to_sign(mine.loc[rows["vec_id"], "whitened"].to_numpy(), (x - s / n) @ basis[:, c - 1] / np.sqrt(e[c - 1]), 1e-5)
