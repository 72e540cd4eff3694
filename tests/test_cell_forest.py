"""Trees from cell statistics against trees grown on rows."""

import random

import numpy as np
import pytest
from pyspark.sql import functions as F

from stratalake.plans import forest

INPUTS, TARGETS = ("hour", "dow"), ("a", "b")


def brute_tree(x, y, min_leaf):
    """Predictions at the rows themselves of a tree grown on plain rows, trying every input and threshold."""
    def error(rows):
        return ((y[rows] - y[rows].mean(axis=0)) ** 2).sum()

    out = np.empty_like(y)

    def grow(rows):
        best = None
        for k in range(x.shape[1]):
            values = sorted(set(x[rows, k]))
            for low, high in zip(values, values[1:]):
                left, right = rows[x[rows, k] <= (low + high) / 2], rows[x[rows, k] > (low + high) / 2]
                if min(len(left), len(right)) >= min_leaf:
                    gain = error(rows) - error(left) - error(right)
                    if gain > 1e-6 and (best is None or gain > best[0] + 1e-9):
                        best = gain, left, right
        if best is None:
            out[rows] = y[rows].mean(axis=0)
        else:
            grow(best[1]), grow(best[2])

    grow(np.arange(len(x)))
    return out


def walk(nodes, row):
    at = 0
    while nodes[at][0] >= 0:
        at = nodes[at][2] if row[nodes[at][0]] <= nodes[at][1] else nodes[at][3]
    return nodes[at][5]


@pytest.mark.parametrize("seed, min_leaf", [(1, 3), (2, 1), (3, 10)])
def test_tree_of_cells_equals_tree_of_rows(seed, min_leaf):
    rng = np.random.default_rng(seed)
    x = np.column_stack([rng.integers(0, 6, 200), rng.integers(0, 4, 200)]).astype(float)
    y = np.column_stack([x[:, 0] * 10 + rng.normal(0, 3, 200), (x[:, 1] > 1) * 7 + rng.normal(0, 1, 200)])
    cells, place = np.unique(x, axis=0, return_inverse=True)
    n = np.bincount(place).astype(float)
    sums = np.column_stack([np.bincount(place, t) for t in y.T])
    nodes = forest.grow_tree(cells, n, sums, min_leaf)
    assert np.allclose([walk(nodes, r) for r in x], brute_tree(x, y, min_leaf))


def rows(spark, n=3000):
    rng = random.Random(4)
    made = [(k, rng.randrange(24), rng.randrange(7)) for k in range(n)]
    made = [(k, h, d, float(h * 5 + rng.randrange(5)), float(d)) for k, h, d in made]
    return spark.createDataFrame(made, "call_number long, hour int, dow int, a double, b double")


def test_forest_learns_stores_and_repeats(spark, tmp_path):
    df = rows(spark)
    statistics = forest.cell_statistics(df, "call_number", INPUTS, TARGETS)
    grown = forest.grow_forest(statistics, INPUTS, TARGETS, trees=30)
    assert grown.select("tree").distinct().count() == 30
    forest.store_forest(grown, str(tmp_path / "model"))
    where = forest.cells(statistics, INPUTS, TARGETS)
    found = forest.predict_cells(forest.load_forest(spark, str(tmp_path / "model")), where, INPUTS, TARGETS).collect()
    assert sum(r.n for r in found) == 3000
    assert np.mean([abs(r.pred_a - r.actual_a) for r in found]) < 2 and np.mean([abs(r.pred_b - r.actual_b) for r in found]) < 0.5
    again = forest.predict_cells(forest.grow_forest(statistics.repartition(3), INPUTS, TARGETS, trees=30), where, INPUTS, TARGETS)
    assert sorted(tuple(r) for r in again.collect()) == sorted(tuple(r) for r in found)


def test_statistics_are_one_scan_and_bounded(spark, monkeypatch):
    df = rows(spark, 500)
    df.write.mode("overwrite").format("noop").save()
    statistics = forest.cell_statistics(df, "call_number", INPUTS, TARGETS, buckets=4)
    assert statistics.agg(F.sum("n")).first()[0] == 500
    plan = statistics._jdf.queryExecution().executedPlan().toString()
    assert plan.count("Scan ExistingRDD") == 1
    monkeypatch.setattr(forest, "MOST_ROWS", 10)
    with pytest.raises(ValueError, match="more than 10 cells"):
        forest.grow_forest(statistics, INPUTS, TARGETS, trees=2)
    monkeypatch.undo()
    empty = forest.grow_forest(statistics.where("false"), INPUTS, TARGETS, trees=2)
    assert empty.count() == 0
