import math
from collections import defaultdict
from fractions import Fraction

import numpy as np
import pytest

from stratalake.llm.common import table
from stratalake.llm.whitening import Spectrum, op12_embedding_whitening, positive_pivots, whiten


def brute(vectors):
    """Counts, exact deviations and eigenpairs of a list of vectors, from fractions and numpy's solver."""
    xs = [[math.floor(1024 * float(c)) + 100000 for c in v] for v in vectors]
    n, d = len(xs), len(xs[0])
    s = [sum(x[k] for x in xs) for k in range(d)]
    deviations = [sum((n * x[k] - s[k]) ** 2 for k in range(d)) for x in xs]
    centred = np.array([[float(Fraction(n * x[k] - s[k], n)) for k in range(d)] for x in xs])
    values, vectors = np.linalg.eigh(centred.T @ centred / n)
    return n, deviations, centred, values[::-1], vectors[:, ::-1]


def check(rows, ids, vectors, components=8):
    n, deviations, centred, values, axes = brute(vectors)
    got = defaultdict(dict)
    for r in rows:
        got[r["vec_id"]][r["component"]] = r
    k = min(components, len(values))
    assert len(rows) == len(vectors) * k and set(got) == set(ids)
    for j in range(k):
        white = np.array([got[i][j + 1]["whitened"] for i in ids])
        wanted = centred @ axes[:, j] / math.sqrt(values[j])
        assert min(abs(white - wanted).max(), abs(white + wanted).max()) < 1e-7
        (explained,) = {r[j + 1]["explained"] for r in got.values()}
        assert explained == pytest.approx(values[j] / values.sum(), rel=1e-10)
    for i, wanted in zip(ids, deviations):
        assert {int(r["deviation"]) for r in got[i].values()} == {wanted} and got[i][1]["n"] == n
    assert len({r["identity_error"] for r in rows}) == 1 and rows[0]["identity_error"] < 1e-9


def test_query_equals_brute_force(spark, sf):
    given = [r for r in table(spark, sf, "embeddings").select("vec_id", "embedding").collect()]
    frame = op12_embedding_whitening(spark, sf)
    assert dict(frame.dtypes) == {"vec_id": "bigint", "component": "int", "n": "bigint", "deviation": "bigint", "whitened": "double",
                                  "explained": "double", "identity_error": "double"}
    check(frame.collect(), [r["vec_id"] for r in given], [r["embedding"] for r in given])


def test_unusable_rows_and_other_columns(spark):
    rng = np.random.default_rng(1)
    good = [[float(c) for c in v] for v in rng.standard_normal((40, 5)) * [5, 4, 3, 2, 1]]
    bad = [None, [], [1.0, None, 0.0, 0.0, 0.0], [math.nan] * 5, [math.inf, 0.0, 0.0, 0.0, 0.0], [1.0, 2.0]]
    rows = [(k, v, k, 0.0) for k, v in enumerate(good + bad)]
    df = spark.createDataFrame(rows, "vec_id long, embedding array<double>, N int, Whitened double")
    check(whiten(df).collect(), list(range(40)), good)
    one_id = whiten(df.selectExpr("CAST(NULL AS long) AS vec_id", "embedding")).collect()
    assert len(one_id) == 200 and {r["vec_id"] for r in one_id} == {None}
    check(whiten(df, components=2).collect(), list(range(40)), good, 2)


def test_no_variance(spark):
    schema = "vec_id long, embedding array<float>"
    for rows in ([], [(1, [1.0, 2.0])], [(1, [1.0, 2.0]), (2, [1.0, 2.0])], [(1, []), (2, [])], [(1, None)]):
        frame = whiten(spark.createDataFrame(rows, schema))
        assert frame.columns[:3] == ["vec_id", "component", "n"] and frame.collect() == []
    flat = [(k, [float(k), 2.0 * k, 0.0]) for k in range(9)]
    assert {r["component"] for r in whiten(spark.createDataFrame(flat, schema)).collect()} == {1}


def test_large_entries_stay_exact(spark):
    rng = np.random.default_rng(5)
    vectors = [[float(c) for c in v] for v in rng.standard_normal((30, 3)) * [1e9, 1e7, 1e3]]
    rows = whiten(spark.createDataFrame(list(enumerate(vectors)), "vec_id long, embedding array<double>")).collect()
    wanted = brute(vectors)[1]
    assert {r["vec_id"]: int(r["deviation"]) for r in rows} == dict(enumerate(wanted))
    huge = [(k, [1e300 * (-1) ** k, float(k)]) for k in range(4)]
    assert len(whiten(spark.createDataFrame(huge, "vec_id long, embedding array<double>")).collect()) >= 4


@pytest.mark.parametrize("size, seed", [(1, 0), (2, 1), (7, 2), (33, 3)])
def test_counts_are_inertia(size, seed):
    rng = np.random.default_rng(seed)
    a = rng.standard_normal((size, size))
    a = a + a.T
    assert positive_pivots(a) == (np.linalg.eigvalsh(a) > 0).sum()
    assert positive_pivots(np.zeros((size, size))) == 0
    if size == 2:
        assert positive_pivots(np.array([[0.0, 1.0], [1.0, 0.0]])) == 1


@pytest.mark.parametrize("values", [
    [9, 5, 5, 5, 1, 0], [4, 4, 4, 4], [1, 1 - 1e-9, 1 - 2e-9, 0.5], [1e12, 1, 1e-3], [3], [2, 0, 0], [1 + 1e-15, 1, 0.1],
])
def test_close_eigenvalues(values):
    rng = np.random.default_rng(3)
    q, _ = np.linalg.qr(rng.standard_normal((len(values), len(values))))
    matrix = (q * np.array(values, dtype=float)) @ q.T
    matrix = (matrix + matrix.T) / 2
    got, axes = Spectrum(matrix).leading(8)
    wanted = [v for v in values if v > 16 * len(values) * np.finfo(float).eps * max(values)]
    assert np.allclose(got, wanted, rtol=0, atol=1e-12 * max(values))
    assert np.allclose(axes.T @ axes, np.eye(len(wanted)), atol=1e-9)
    assert np.abs(matrix @ axes - axes * got).max() < 1e-12 * max(values)
