"""A random forest from sufficient statistics.

A tree needs of its rows only how many there are in each combination of the inputs (a cell), and the sum of each target. One
scan counts both, split once more by a hash of the row, and all trees are grown from these few rows: a tree's bootstrap
draws a Poisson weight for each statistic row. With fewer rows than ``BUCKETS`` in a cell that is the bootstrap of
rows; with more, whole buckets are drawn. All targets share the splits, as in a forest of several outputs.
"""

from __future__ import annotations

from collections.abc import Sequence

import numpy as np
import pyarrow as pa
from pyspark.sql import DataFrame, SparkSession
from pyspark.sql import functions as F
from pyspark.sql import types as T

from stratalake.plans.profile import FEATURES, MIN_LEAF, SEED, TARGETS, TREES
from stratalake.session import materialize

#: Parts of a cell that are drawn or left out together.
BUCKETS = 32
#: Statistic rows that trees are grown from; hour, weekday and month make 2,016 cells at most.
MOST_ROWS = 200_000

_NODE = "tree int, node int, input int, threshold double, left int, right int, n double, means array<double>"


def cell_statistics(features: DataFrame, key: str, inputs: Sequence[str] = FEATURES, targets: Sequence[str] = TARGETS,
                    buckets: int = BUCKETS) -> DataFrame:
    """Rows, sum, least and greatest of each target by cell and bucket of the row's key, in one scan."""
    bucket = F.pmod(F.xxhash64(key, *targets), F.lit(buckets)).cast("int").alias("bucket")
    sums = [f(F.col(t)).alias(f"{name}_{t}") for t in targets for name, f in (("sum", F.sum), ("min", F.min), ("max", F.max))]
    return features.groupBy(*inputs, bucket).agg(F.count(F.lit(1)).alias("n"), *sums)


def cells(statistics: DataFrame, inputs: Sequence[str] = FEATURES, targets: Sequence[str] = TARGETS) -> DataFrame:
    """Rows and actual average of each target by cell."""
    return statistics.groupBy(*inputs).agg(
        F.sum("n").alias("n"), *[(F.sum(f"sum_{t}") / F.sum("n")).alias(f"actual_{t}") for t in targets])


def grow_tree(x: np.ndarray, n: np.ndarray, sums: np.ndarray, min_leaf: float = MIN_LEAF) -> list[tuple]:
    """Nodes (input, threshold, left, right, n, means) of one tree; a leaf has input -1.

    A split makes the sum of squared errors of all targets least; equal ones go to the first input and the lowest threshold.
    """
    nodes: list[list] = []
    found = [np.unique(x[:, k], return_inverse=True) for k in range(x.shape[1])]
    all_columns = np.column_stack([n, sums])
    width = all_columns.shape[1]
    # Where the columns of a row are added, for each input.
    places = [code[:, None] * width + np.arange(width) for _, code in found]

    def add(rows):
        total = all_columns[rows].sum(axis=0)
        nodes.append([-1, 0.0, -1, -1, float(total[0]), (total[1:] / max(total[0], 1e-300)).tolist()])
        return len(nodes) - 1

    waiting = [(add(np.arange(len(x))), np.arange(len(x)))]
    while waiting:
        node, rows = waiting.pop()
        own = all_columns[rows]
        whole, flat = own.sum(axis=0), own.ravel()
        base = (whole[1:] ** 2).sum() / max(whole[0], 1e-300)
        best = (1e-9 * max(1.0, abs(base)), None, None)
        for k, (values, _) in enumerate(found):
            by_value = np.bincount(places[k][rows].ravel(), flat, len(values) * width).reshape(len(values), width)
            there = np.flatnonzero(by_value[:, 0] > 0)
            left = by_value[there].cumsum(axis=0)[:-1]
            right = whole - left
            allowed = (left[:, 0] >= min_leaf) & (right[:, 0] >= min_leaf)
            if not allowed.any():
                continue
            gain = np.where(allowed, (left[:, 1:] ** 2).sum(axis=1) / np.maximum(left[:, 0], 1e-300)
                            + (right[:, 1:] ** 2).sum(axis=1) / np.maximum(right[:, 0], 1e-300) - base, -np.inf)
            at = int(gain.argmax())
            if gain[at] > best[0]:
                best = (gain[at], k, (values[there[at]] + values[there[at + 1]]) / 2)
        if best[1] is None:
            continue
        lower = x[rows, best[1]] <= best[2]
        parts = rows[lower], rows[~lower]
        ends = [add(part) for part in parts]
        nodes[node][:4] = [best[1], float(best[2]), *ends]
        waiting += zip(ends, parts)
    return [tuple(node) for node in nodes]


def grow_forest(statistics: DataFrame, inputs: Sequence[str] = FEATURES, targets: Sequence[str] = TARGETS,
                trees: int = TREES, min_leaf: float = MIN_LEAF, seed: int = SEED) -> DataFrame:
    """The nodes of all trees, grown by the tasks of one job, each from the same statistics."""
    spark = statistics.sparkSession
    rows = statistics.limit(MOST_ROWS + 1).toPandas()
    if len(rows) > MOST_ROWS:
        raise ValueError(f"more than {MOST_ROWS} cells; use train_forest for inputs of so many values")
    rows = rows.sort_values([*inputs, "bucket"], kind="stable")
    x, cell = np.unique(rows[list(inputs)].to_numpy(np.float64), axis=0, return_inverse=True)
    n = rows["n"].to_numpy(np.float64)
    sums = rows[[f"sum_{t}" for t in targets]].to_numpy(np.float64)

    def work(batches):
        for batch in batches:
            out = []
            for tree in batch.column(0).to_pylist():
                weight = np.random.default_rng([seed, tree]).poisson(1.0, len(n)).astype(np.float64)
                by_cell = np.bincount(cell, n * weight, len(x))
                drawn = by_cell > 0
                if drawn.any():
                    totals = np.column_stack([np.bincount(cell, s * weight, len(x)) for s in sums.T])
                    out += [(tree, k, *node) for k, node in enumerate(grow_tree(x[drawn], by_cell[drawn], totals[drawn], min_leaf))]
            columns = list(zip(*out)) or [()] * 8
            kinds = [pa.int32(), pa.int32(), pa.int32(), pa.float64(), pa.int32(), pa.int32(), pa.float64(), pa.list_(pa.float64())]
            yield pa.RecordBatch.from_arrays([pa.array(list(c), k) for c, k in zip(columns, kinds)],
                                             names=["tree", "node", "input", "threshold", "left", "right", "n", "means"])

    tasks = int(spark.conf.get("spark.sql.shuffle.partitions"))
    return materialize(spark.range(trees, numPartitions=min(trees, tasks) or 1).mapInArrow(work, _NODE), "forest")


def predict_cells(forest: DataFrame, where: DataFrame, inputs: Sequence[str] = FEATURES,
                  targets: Sequence[str] = TARGETS) -> DataFrame:
    """``where`` (each cell once) with one prediction for each target, the average of the trees, not below 0."""
    nodes = forest.orderBy("tree", "node").toPandas()
    roots = nodes.index[nodes["node"] == 0].to_numpy()
    base = np.repeat(roots, np.diff(np.append(roots, len(nodes)))) if len(nodes) else roots
    which, threshold = nodes["input"].to_numpy(), nodes["threshold"].to_numpy()
    left, right = nodes["left"].to_numpy() + base, nodes["right"].to_numpy() + base
    means = np.array(nodes["means"].tolist()).reshape(len(nodes), len(targets))
    shared = where.sparkSession.sparkContext.broadcast((roots, which, threshold, left, right, means))
    names = [f"pred_{t}" for t in targets]

    def work(batches):
        tops, split, limit, lower, upper, values = shared.value
        for batch in batches:
            x = np.column_stack([batch.column(batch.schema.get_field_index(c)).to_numpy(zero_copy_only=False).astype(float) for c in inputs])
            total = np.zeros((len(x), len(targets)))
            for top in tops:
                at = np.full(len(x), top)
                while (inner := split[at] >= 0).any():
                    here = at[inner]
                    goes = x[inner, split[here]] <= limit[here]
                    at[inner] = np.where(goes, lower[here], upper[here])
                total += values[at]
            found = np.maximum(total / max(1, len(tops)), 0.0)
            yield pa.RecordBatch.from_arrays([*batch.columns, *[pa.array(c) for c in found.T]], names=[*batch.schema.names, *names])

    schema = T.StructType([*where.schema.fields, *[T.StructField(name, T.DoubleType()) for name in names]])
    return where.mapInArrow(work, schema)


def store_forest(forest: DataFrame, folder: str) -> None:
    forest.write.mode("overwrite").parquet(folder)


def load_forest(spark: SparkSession, folder: str) -> DataFrame:
    return spark.read.schema(_NODE).parquet(folder)
