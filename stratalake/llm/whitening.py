"""Embedding whitening by spectrum slicing.

1. The entries of a vector become whole numbers, x = floor(1024 c) + 100000, so that counts, sums and products of a whole table are exact
   however it is split: tasks send their sums as decimals, and Spark adds them. Products are made of x less the rounded mean.
2. The covariance V has the size of the dimension squared, whatever the table's size, and is worked on by the driver. The number
   of eigenvalues above a shift s is the number of positive pivots of V - sI = L D L' (Sylvester's law of inertia). Bisection on these
   counts isolates each leading eigenvalue.
3. Inverse iteration at the middle of the isolating interval and then Rayleigh quotient iteration find the eigenvector; its
   eigenvalue must lie in the interval, and counts just below and above it certify its number.
4. One more pass over all rows measures the covariance of the whitened rows, and a last one returns them.

Defined results: rows whose vector is null or holds a null or non-finite entry are dropped. If lengths differ, only vectors of the
commonest length (the longest of equals) are used, the others are dropped; empty vectors have no component and no row. x is limited to
2**53 on both sides, beyond which a double is no exact whole number. Rows with a null id and repeated rows are rows like others. Components without variance
(no more than rounding leaves) have no whitened value and are left out, so a table of one vector or of equal vectors, like an empty one, gives no row.
Eigenvalues that are equal to the 13th digit share a space; any orthonormal vectors of it are given, the same for all rows. ``deviation`` is
null where it needs more than 38 digits (in the query: 64 bits).
"""

from __future__ import annotations

import math
from decimal import Decimal

import numpy as np
import pyarrow as pa
from pyspark.sql import DataFrame, SparkSession
from pyspark.sql import functions as F

from stratalake.llm.common import map_batches, table

SCALE = 1024
SHIFT = 100_000
COMPONENTS = 8
_LARGEST = 2.0**53
_BIG = pa.decimal128(38, 0)
_PIVOT = (1 + math.sqrt(17)) / 8


def positive_pivots(matrix: np.ndarray) -> int:
    """Number of positive eigenvalues of a symmetric matrix, from L D L' with complete pivoting in blocks of one and two."""
    a, count = matrix.copy(), 0
    while len(a):
        diagonal = np.abs(a.diagonal())
        p, size = int(diagonal.argmax()), np.abs(a)
        r, s = divmod(int(size.argmax()), len(a))
        if size[r, s] == 0:
            break
        if diagonal[p] >= _PIVOT * size[r, s]:
            pivot, rest = [p], np.delete(np.arange(len(a)), p)
            count += a[p, p] > 0
        else:
            pivot, rest = [r, s], np.delete(np.arange(len(a)), [r, s])
            count += 1  # a block of two has one eigenvalue of each sign
        side = a[np.ix_(rest, pivot)]
        a = a[np.ix_(rest, rest)] - side @ np.linalg.solve(a[np.ix_(pivot, pivot)], side.T)
        a = (a + a.T) / 2
    return count


class Spectrum:
    """Leading eigenpairs of a covariance matrix, numbered by counts."""

    def __init__(self, matrix: np.ndarray):
        self.matrix = matrix
        self.norm = float(np.abs(matrix).sum(axis=1).max(initial=0.0))
        self.least = 1e-13 * self.norm
        self.counts: dict[float, int] = {}

    def above(self, shift: float) -> int:
        if shift not in self.counts:
            self.counts[shift] = int(positive_pivots(self.matrix - shift * np.eye(len(self.matrix))))
        return self.counts[shift]

    def isolate(self, number: int, width: float) -> tuple[float, float]:
        """An interval that holds eigenvalue ``number`` alone, if one of at least the least width does, no wider than ``width``."""
        low = max([s for s, c in self.counts.items() if c >= number], default=-self.norm)
        high = min([s for s, c in self.counts.items() if c < number], default=self.norm * (1 + 1e-9))
        while high - low > self.least and (high - low > width or self.above(low) != number or self.above(high) != number - 1):
            middle = (low + high) / 2
            if self.above(middle) >= number:
                low = middle
            else:
                high = middle
        return low, high

    def _iterate(self, start: np.ndarray, found: np.ndarray, shift: float) -> tuple[float, np.ndarray]:
        """Three steps of inverse iteration, then Rayleigh quotients until the residual stops falling."""
        vector, best = start, (math.inf, 0.0, start)
        for step in range(40):
            off = self.matrix - shift * np.eye(len(self.matrix))
            try:
                vector = np.linalg.solve(off, vector)
            except np.linalg.LinAlgError:
                vector = np.linalg.solve(off + self.least * 1e-2 * np.eye(len(off)), vector)
            for _ in range(2):
                vector = vector / np.linalg.norm(vector)
                vector = vector - found @ (found.T @ vector)
            vector = vector / np.linalg.norm(vector)
            value = float(vector @ self.matrix @ vector)
            residual = float(np.linalg.norm(self.matrix @ vector - value * vector))
            if step >= 3 and residual >= best[0]:
                break
            best = min(best, (residual, value, vector), key=lambda b: b[0])
            if step >= 2:
                shift = value
        return best[1], best[2]

    def leading(self, wanted: int) -> tuple[np.ndarray, np.ndarray]:
        """The largest eigenvalues, falling, and their unit eigenvectors as columns; those that are zero up to rounding are left out."""
        size = len(self.matrix)
        rng = np.random.default_rng(12)
        values, vectors = [], np.empty((size, 0))
        noise = 16 * size * np.finfo(float).eps * self.norm
        for number in range(1, min(wanted, size) + 1):
            width = 2 * self.norm
            while True:
                low, high = self.isolate(number, width)
                if high <= noise or self.above(noise) < number:
                    return np.array(values), vectors
                value, vector = self._iterate(rng.standard_normal(size), vectors, (low + high) / 2)
                slack = self.least + noise
                if low - slack <= value <= high + slack and self.above(value - slack) >= number > self.above(value + slack):
                    break
                if high - low <= self.least:
                    raise ArithmeticError(f"eigenvalue {number} does not pass its certificate")
                width = (high - low) / 16
            values.append(value)
            vectors = np.column_stack([vectors, vector])
        order = np.argsort(-np.array(values), kind="stable")
        return np.array(values)[order], vectors[:, order]


def whole(batch: pa.Array, size: int) -> np.ndarray:
    """x of each entry, a row for each vector."""
    entries = batch.flatten().to_numpy(zero_copy_only=False).reshape(-1, size)
    return np.clip(np.floor(SCALE * entries), -_LARGEST, _LARGEST).astype(np.int64) + SHIFT


def _add_products(total: np.ndarray, y: np.ndarray) -> None:
    """Add y'y exactly; in doubles where every partial sum is below 2**53, else in Python's whole numbers."""
    largest = int(np.abs(y).max(initial=0))
    if largest * largest * len(y) < 2**53:
        f = y.astype(np.float64)
        total += (f.T @ f).astype(np.int64).astype(object)
    else:
        o = y.astype(object)
        total += o.T @ o


def _totals(sums: list[tuple[int, int]]) -> pa.RecordBatch:
    places, values = zip(*sums) if sums else ((), ())
    return pa.RecordBatch.from_arrays([pa.array(places, pa.int64()), pa.array([Decimal(int(v)) for v in values], _BIG)],
                                      names=["place", "total"])


def _first_sums(size: int):
    def work(batches):
        n, total = 0, np.zeros(size, dtype=object)
        for batch in batches:
            x = whole(batch.column(0), size)
            n += len(x)
            total += x.sum(axis=0).astype(object) if len(x) < 256 else x.astype(object).sum(axis=0)
        if n:
            yield _totals([(-1, n), *enumerate(total)])

    return work


def _second_sums(size: int, centre: list[int]):
    middle = np.array(centre, dtype=np.int64)
    upper = np.triu_indices(size)

    def work(batches):
        n, total = 0, np.zeros((size, size), dtype=object)
        for batch in batches:
            y = whole(batch.column(0), size) - middle
            n += len(y)
            _add_products(total, y)
        if n:
            yield _totals([(int(i) * size + int(j), total[i, j]) for i, j in zip(*upper)])

    return work


class Whitening:
    """What is known of a table of vectors: exact sums, the covariance and its leading eigenpairs."""

    def __init__(self, vectors: DataFrame, size: int, components: int):
        """``vectors`` has (vec_id, vector), the vectors all of one size and finite."""
        self.size, only = size, vectors.select("vector")
        sums = _gathered(map_batches(only, _first_sums(size), "place long, total decimal(38,0)"))
        self.n = sums.pop(-1, 0)
        self.sums = [sums.get(k, 0) for k in range(size)]
        self.values, self.vectors, self.trace = np.empty(0), np.empty((size, 0)), 0.0
        if not self.n:
            return
        self.centre = [(2 * s + self.n) // (2 * self.n) for s in self.sums]
        self.rest = [s - self.n * c for s, c in zip(self.sums, self.centre)]
        products = _gathered(map_batches(only, _second_sums(size, self.centre), "place long, total decimal(38,0)"))
        self.covariance = np.zeros((size, size))
        for place, total in products.items():
            i, j = divmod(place, size)
            self.covariance[i, j] = self.covariance[j, i] = (self.n * total - self.rest[i] * self.rest[j]) / (self.n * self.n)
        self.trace = float(self.covariance.trace())
        self.values, self.vectors = Spectrum(self.covariance).leading(components)

    def project(self, x: np.ndarray) -> np.ndarray:
        """x less its mean on each component, in units of its standard deviation."""
        y = (x - np.array(self.centre, dtype=np.int64)).astype(np.float64)
        return (y - np.array([r / self.n for r in self.rest])) @ (self.vectors / np.sqrt(self.values))

    def deviations(self, x: np.ndarray) -> list[int]:
        """Sum over dimensions of (n x - S) squared, exact."""
        y = x - np.array(self.centre, dtype=np.int64)
        far = self.n * (int(np.abs(y).max(initial=0)) + 1)
        kind = np.int64 if far * far * self.size < 2**62 else object
        off = y.astype(kind) * self.n - np.array(self.rest, dtype=kind)
        return (off * off).sum(axis=1).tolist()


def _gathered(parts: DataFrame) -> dict[int, int]:
    """Totals by place: at most the dimension squared, whatever the table holds."""
    return {r["place"]: int(r["total"]) for r in parts.groupBy("place").agg(F.sum("total").alias("total")).toLocalIterator()}


def _identity_error(only: DataFrame, found: Whitening) -> float:
    """Largest absolute entry of the covariance of the whitened rows less the identity, measured over all rows."""
    k = len(found.values)

    def work(batches):
        n, sums, products = 0, np.zeros(k), np.zeros((k, k))
        for batch in batches:
            w = found.project(whole(batch.column(0), found.size))
            n, sums, products = n + len(w), sums + w.sum(axis=0), products + w.T @ w
        if n:
            flat = np.concatenate([sums, products.ravel()])
            yield pa.RecordBatch.from_arrays([pa.array(np.arange(len(flat))), pa.array(flat)], names=["place", "total"])

    parts = map_batches(only, work, "place long, total double").groupBy("place").agg(F.sum("total").alias("total"))
    flat = np.zeros(k + k * k)
    for row in parts.toLocalIterator():
        flat[row["place"]] = row["total"]
    mean = flat[:k] / found.n
    return float(np.abs(flat[k:].reshape(k, k) / found.n - np.outer(mean, mean) - np.eye(k)).max())


def whiten(df: DataFrame, id_column: str = "vec_id", vector: str = "embedding", components: int = COMPONENTS) -> DataFrame:
    """(vec_id, component, n, deviation, whitened, explained, identity_error): a row for each usable vector and component."""
    spark = df.sparkSession
    vectors = df.select(F.col(f"`{id_column}`").alias("vec_id"), F.col(f"`{vector}`").cast("array<double>").alias("vector"))
    finite = F.forall("vector", lambda c: c.isNotNull() & ~F.isnan(c) & (F.abs(c) < float("inf")))
    vectors = vectors.where(F.col("vector").isNotNull() & finite)
    sizes = vectors.groupBy(F.size("vector").alias("size")).count().orderBy(F.desc("count"), F.desc("size")).first()
    kind = vectors.schema["vec_id"].dataType
    schema = f"vec_id {kind.simpleString()}, component int, deviation decimal(38,0), whitened double, explained double"
    found = None
    if sizes and sizes["size"]:
        vectors = vectors.where(F.size("vector") == sizes["size"])
        found = Whitening(vectors, sizes["size"], components)
    if found is None or not len(found.values):
        empty = spark.createDataFrame([], schema)
        return empty.select("vec_id", "component", F.lit(0).cast("long").alias("n"), "deviation", "whitened", "explained",
                            F.lit(0.0).alias("identity_error"))
    error = _identity_error(vectors.select("vector"), found)
    k = len(found.values)
    explained = found.values / found.trace

    def work(batches):
        for batch in batches:
            x = whole(batch.column(1), found.size)
            rows = np.repeat(np.arange(len(x)), k)
            squares = [None if v >= 10**38 else Decimal(v) for v in found.deviations(x)]
            yield pa.RecordBatch.from_arrays(
                [batch.column(0).take(pa.array(rows)), pa.array(np.tile(np.arange(1, k + 1, dtype=np.int32), len(x))),
                 pa.array(squares, _BIG).take(pa.array(rows)), pa.array(found.project(x).ravel()),
                 pa.array(np.tile(explained, len(x)))],
                names=["vec_id", "component", "deviation", "whitened", "explained"])

    out = map_batches(vectors, work, schema)
    return out.select("vec_id", "component", F.lit(found.n).cast("long").alias("n"), "deviation", "whitened", "explained",
                      F.lit(error).alias("identity_error"))


def op12_embedding_whitening(spark: SparkSession, sf_dir: str) -> DataFrame:
    """Whitened embeddings on their eight leading components."""
    found = whiten(table(spark, sf_dir, "embeddings"))
    return found.withColumn("deviation", F.expr("try_cast(deviation AS bigint)"))


QUERIES = {"op12_embedding_whitening": op12_embedding_whitening}
