"""Quality classifier by co-training of a text view and a metadata view.

Two things are judged, whether a document is bad (labelled quality 0) and whether it is toxic. For each there are two
logistic regressions over hashed features that are there or not: the text view sees the words of the whole text, with
and without marks and capitals, and its proportions (marks, capitals, digits, lengths, repeats) in steps; the metadata view sees ``lang``, ``source``, their pair and
the length in steps. Only features that are significantly more frequent in one class count.

The views learn from a documented, bounded sample: at most about ``LABELLED`` labels by a hash of ``doc_id``, each
with one row of its document, and ``UNLABELLED`` other rows by a hash of ``doc_id`` and text, equal rows once. In each of ``ROUNDS`` rounds each view gives the other its most confident labels of other
documents, up to ``SHARE`` of them and in the proportion of the classes. A quarter of the labels is kept apart: on it the two margins are
calibrated together, and the limit is set so that at least ``CLEAN_KEPT`` of the good documents stay. All documents are scored
whole.

Defined results: a null text has no words; null metadata is a value of its own; labels without a document are ignored, and of
contradicting labels of a document the worse counts; without labels of both classes nothing is found bad, with
chance 0; repeated rows are scored row by row.
"""

from __future__ import annotations

import math
import string
from dataclasses import dataclass

import numpy as np
import pyarrow as pa
import xxhash
from pyspark.sql import DataFrame, SparkSession
from pyspark.sql import functions as F

from stratalake.llm.common import add_columns, free_name, map_batches, share, table, word_hashes

LABELLED = 6_000
UNLABELLED = 6_000
ROUNDS = 4
SHARE = 0.05
CLEAN_KEPT = 0.98
BUCKETS = 1 << 18
LEAST_Z = 3.5
LEAST_ROWS = 4
STEPS = 200
SHRINK = 1e-4
TASKS = ("bad", "toxic")

_UPPER = np.zeros(256, dtype=bool)
_UPPER[65:91] = True
_DIGIT = np.zeros(256, dtype=bool)
_DIGIT[48:58] = True
_MARK = np.zeros(256, dtype=bool)
_MARK[[*range(33, 39), *range(40, 44), 47, *range(60, 65), *range(91, 97), *range(123, 127)]] = True
# Words are what stands between white space and ASCII marks.
_PLAIN = bytes(32 if chr(b) in string.punctuation else b for b in range(256))


def _named(*parts: object) -> int:
    return xxhash.xxh3_64_intdigest("\x00".join(map(str, parts)).encode()) % BUCKETS


def text_features(text: str | None) -> np.ndarray:
    """Buckets of the words and proportions of a whole text."""
    raw = (text or "").encode("utf-8", "replace")
    data = np.frombuffer(raw, dtype=np.uint8)
    words = word_hashes(raw.lower().translate(_PLAIN))
    distinct = np.unique(words)
    marked = np.unique(word_hashes(raw) ^ np.uint64(1))
    size = max(1, len(data))
    lines = [x for x in raw.split(b"\n") if x.strip()]
    proportions = (
        _UPPER[data].sum() / size, _DIGIT[data].sum() / size, _MARK[data].sum() / size, len(words) / size,
        1 - len(distinct) / max(1, len(words)), 1 - len(set(lines)) / max(1, len(lines)), len(lines) / max(1, len(words)))
    steps = [_named("part", k, int(20 * math.sqrt(p))) for k, p in enumerate(proportions)]
    steps.append(_named("words", int(2 * math.log2(len(words) + 1))))
    return np.unique(np.concatenate([(np.concatenate([distinct, marked]) % np.uint64(BUCKETS)).astype(np.int64), np.array(steps, dtype=np.int64)]))


def metadata_features(lang: str | None, source: str | None, n_chars: int | None) -> np.ndarray:
    """Buckets of the metadata of a document."""
    length = None if n_chars is None else int(2 * math.log2(max(0, n_chars) + 1))
    return np.unique(np.array([_named("lang", lang), _named("source", source), _named("both", lang, source),
                               _named("length", length), _named("long", lang, length)], dtype=np.int64))


class Examples:
    """Sparse rows of features; those in fewer than ``least`` rows are left out, as none of them can be significant."""

    def __init__(self, items: np.ndarray, lengths: np.ndarray, least: int = 1):
        owner = np.repeat(np.arange(len(lengths), dtype=np.int32), lengths)
        common = (np.bincount(items, minlength=BUCKETS) >= least)[items]
        self.items, self.owner, self.rows = items[common], owner[common], len(lengths)

    def __len__(self) -> int:
        return self.rows

    def margin(self, weights: np.ndarray) -> np.ndarray:
        return np.bincount(self.owner, weights=weights[self.items], minlength=len(self))


def significant(examples: Examples, share: np.ndarray, which: np.ndarray) -> np.ndarray:
    """Features that rows of one class have significantly more often than those of the other."""
    use = np.zeros(len(examples), dtype=bool)
    use[which] = True
    rows = use[examples.owner]
    items, labels = examples.items[rows], share[examples.owner[rows]]
    yes = np.bincount(items, weights=labels, minlength=BUCKETS)
    no = np.bincount(items, minlength=BUCKETS) - yes
    n_yes, n_no = share[which].sum(), (1 - share[which]).sum()
    if not n_yes or not n_no:
        return np.empty(0, np.int64)
    p, q = (yes + 0.5) / (n_yes + 1), (no + 0.5) / (n_no + 1)
    pooled = (yes + no + 1) / (n_yes + n_no + 2)
    z = (p - q) / np.sqrt(pooled * (1 - np.minimum(pooled, 0.999)) * (1 / n_yes + 1 / n_no))
    return np.flatnonzero(np.abs(z) >= LEAST_Z)


def fit_view(examples: Examples, share: np.ndarray, which: np.ndarray) -> np.ndarray:
    """Weights of a logistic regression over the significant features; the intercept is left to calibration."""
    weights = np.zeros(BUCKETS)
    chosen = significant(examples, share, which)
    if not len(chosen):
        return weights
    number = np.full(BUCKETS, -1, dtype=np.int64)
    number[chosen] = np.arange(len(chosen))
    row = np.full(len(examples), -1, dtype=np.int64)
    row[which] = np.arange(len(which))
    item, owner = number[examples.items], row[examples.owner]
    here = (item >= 0) & (owner >= 0)
    item, owner, y = item[here], owner[here], share[which]
    w, base, squares, base_squares = np.zeros(len(chosen)), 0.0, np.full(len(chosen), 1e-6), 1e-6
    for _ in range(STEPS):
        error = (_chance(np.bincount(owner, weights=w[item], minlength=len(y)) + base) - y) / len(y)
        gradient = np.bincount(item, weights=error[owner], minlength=len(w)) + SHRINK * w
        squares += gradient**2
        base_squares += error.sum() ** 2
        w -= 0.3 * gradient / np.sqrt(squares)
        base -= 0.3 * error.sum() / math.sqrt(base_squares)
    weights[chosen] = w
    return weights


def _chance(margin: np.ndarray) -> np.ndarray:
    return 1 / (1 + np.exp(-np.clip(margin, -30, 30)))


def fit_logistic(x: np.ndarray, y: np.ndarray) -> np.ndarray:
    """Coefficients and intercept of a small logistic regression, slightly shrunk."""
    x = np.column_stack([x, np.ones(len(x))])
    w = np.zeros(x.shape[1])
    for _ in range(50):
        p = _chance(x @ w)
        gradient = x.T @ (p - y) + 0.01 * w
        curve = (x * (p * (1 - p))[:, None]).T @ x + 0.01 * np.eye(len(w))
        step = np.linalg.solve(curve, gradient)
        w -= step * min(1.0, 5 / max(1e-9, np.abs(step).max()))
    return w


@dataclass
class Judge:
    """Frozen views of one task, their calibration and the limit."""

    text: np.ndarray
    metadata: np.ndarray
    coefficients: np.ndarray
    limit: float

    def chance(self, text: np.ndarray, metadata: np.ndarray) -> float:
        margin = self.coefficients @ np.array([self.text[text].sum(), self.metadata[metadata].sum(), 1.0])
        return float(_chance(np.array(margin)))


def co_train(text: Examples, metadata: Examples, labels: np.ndarray) -> Judge | None:
    """Train both views; ``labels`` is NaN for documents without one."""
    known = np.flatnonzero(~np.isnan(labels))
    held, fit = known[::4], np.setdiff1d(known, known[::4])
    if any(len(set(labels[part])) < 2 for part in (held, fit)):
        return None
    rate = labels[fit].mean()
    views = (text, metadata)
    given = [np.where(np.isnan(labels), 0.0, labels) for _ in views]
    learned = [fit.copy() for _ in views]
    weights = [np.zeros(BUCKETS)] * 2
    for turn in range(ROUNDS + 1):
        weights = [fit_view(view, given[k], learned[k]) for k, view in enumerate(views)]
        if turn == ROUNDS:
            break
        for k, view in enumerate(views):
            # What this view is sure of becomes a label of the other view.
            other = 1 - k
            open_rows = np.setdiff1d(np.flatnonzero(np.isnan(labels)), learned[other])
            if not len(open_rows):
                continue
            coefficients = fit_logistic(view.margin(weights[k])[held][:, None], labels[held])
            chance = _chance(coefficients[0] * view.margin(weights[k])[open_rows] + coefficients[1])
            order = np.argsort(chance, kind="stable")
            take = max(1, int(SHARE * len(open_rows)))
            low, high = order[: int(take * (1 - rate))], order[::-1][: max(1, int(take * rate))]
            sure_low, sure_high = open_rows[low[chance[low] < 0.05]], open_rows[high[chance[high] > 0.95]]
            given[other][sure_high] = 1.0
            learned[other] = np.concatenate([learned[other], sure_low, np.setdiff1d(sure_high, sure_low)])
    margins = np.column_stack([view.margin(weights[k])[held] for k, view in enumerate(views)])
    coefficients = fit_logistic(margins, labels[held])
    good = np.sort(_chance(np.column_stack([margins, np.ones(len(held))]) @ coefficients)[labels[held] == 0])
    limit = max(0.5, float(good[min(len(good) - 1, math.ceil(CLEAN_KEPT * len(good)) - 1)]))
    return Judge(weights[0], weights[1], coefficients, limit)


def _extract(batches):
    for batch in batches:
        doc_ids, bad, toxic, texts, langs, sources, sizes = (c.to_pylist() for c in batch.columns)
        yield pa.RecordBatch.from_arrays(
            [pa.array(doc_ids, pa.int64()), pa.array(bad, pa.float64()), pa.array(toxic, pa.float64()),
             pa.array([text_features(t) for t in texts], pa.list_(pa.int32())),
             pa.array([metadata_features(*m) for m in zip(langs, sources, sizes)], pa.list_(pa.int32()))],
            names=["doc_id", "bad", "toxic", "text", "metadata"])


def sample(docs: DataFrame, labels: DataFrame) -> DataFrame:
    """The bounded sample: features of labelled and other documents, labels null for the others."""
    spark = docs.sparkSession
    scale = 1 << 40
    known = labels.where(F.col("doc_id").isNotNull()).groupBy("doc_id").agg(
        F.max(1 - F.col("quality")).cast("double").alias("bad"), F.max("toxic").cast("double").alias("toxic"))
    n_labels, n_docs = known.count(), docs.count()
    draw = F.pmod(F.xxhash64("doc_id"), F.lit(scale))
    chosen = known.where(draw < int(min(1, LABELLED / max(1, n_labels)) * scale)).collect()
    marks = F.broadcast(spark.createDataFrame(chosen, "doc_id long, bad double, toxic double"))
    other_draw = F.pmod(F.xxhash64("doc_id", "text", F.lit(1)), F.lit(scale)) < int(min(1, UNLABELLED / max(1, n_docs)) * scale)
    rows = docs.select("doc_id", "text", "lang", "source", "n_chars").join(marks, "doc_id", "left")
    labelled = F.col("bad").isNotNull() | F.col("toxic").isNotNull()
    # A label counts once and so does an equal row, so that repeated ids and rows cannot outgrow the sample.
    own = F.xxhash64("text", "lang", "source", "n_chars")
    rows = (rows.where(labelled | other_draw).groupBy("doc_id", F.when(labelled, F.lit(0)).otherwise(own).alias("part"))
            .agg(F.min_by(F.struct(*rows.columns), own).alias("row")).select("row.*"))
    return map_batches(rows.select("doc_id", "bad", "toxic", "text", "lang", "source", "n_chars"), _extract,
                       "doc_id long, bad double, toxic double, text array<int>, metadata array<int>")


def learn(docs: DataFrame, labels: DataFrame) -> dict[str, Judge | None]:
    """A judge of each task."""
    found = sample(docs, labels).toArrow()
    # Ordered by a hash of the id, so that the labels held out depend neither on ids nor on how rows are dealt to tasks.
    keys = pa.array([xxhash.xxh3_64_intdigest(f"{i} {n}") for i, n in zip(
        found["doc_id"].to_pylist(), found["text"].combine_chunks().value_lengths().to_pylist())], pa.uint64())
    found = found.append_column("key", keys).sort_by("key").combine_chunks()

    def examples(name, least):
        column = found[name].combine_chunks()
        return Examples(column.flatten().to_numpy(), column.value_lengths().to_numpy(), least)

    text, metadata = examples("text", LEAST_ROWS), examples("metadata", 1)
    labels = {task: found[task].to_numpy().astype(float) for task in TASKS}
    del found
    return {task: co_train(text, metadata, labels[task]) for task in TASKS}


FIELDS = {"p_bad": pa.float64(), "p_toxic": pa.float64(), "score": pa.float64(), "kept": pa.bool_()}


def classify(docs: DataFrame, judges: dict[str, Judge | None], keep: list[str] | None = None) -> DataFrame:
    """The frame (or its columns ``keep``) with p_bad, p_toxic, score (chance to be good) and kept."""
    shared = share(docs.sparkSession, judges)

    def work(rows):
        out = []
        for row in rows:
            text, metadata = text_features(row["text"]), metadata_features(row["lang"], row["source"], row["n_chars"])
            chances = [j.chance(text, metadata) if (j := shared.value[t]) else 0.0 for t in TASKS]
            kept = all(shared.value[t] is None or c <= shared.value[t].limit for t, c in zip(TASKS, chances))
            out.append((*chances, (1 - chances[0]) * (1 - chances[1]), kept))
        return [list(c) for c in zip(*out)] or [[], [], [], []]

    row = F.struct("text", "lang", "source", F.col("n_chars").cast("long").alias("n_chars"))
    name = free_name(docs, "_row")
    return add_columns(docs.withColumn(name, row), name, FIELDS, work, docs.columns if keep is None else keep)


def op10_quality_classifier(spark: SparkSession, sf_dir: str) -> DataFrame:
    """Chances and verdict of every document."""
    docs = table(spark, sf_dir, "documents")
    return classify(docs, learn(docs, table(spark, sf_dir, "labels")), keep=["doc_id"])


QUERIES = {"op10_quality_classifier": op10_quality_classifier}
