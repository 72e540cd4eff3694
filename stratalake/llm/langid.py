"""Language identification by prediction by partial matching.

Every language has a context tree over the bytes of lower-cased text: for each context of up to
``ORDER`` bytes, how often each byte followed. A byte seen in its longest known context costs
``-log2(count / (total + distinct))``; one that was not seen there pays for the escape,
``distinct / (total + distinct)``, and is coded one order shorter without the bytes already ruled
out; below order 0 all 256 bytes are equal. A text goes to the language whose frozen tree gives
it the shortest code. Code lengths are whole 1/1024 bits, so sums are exact and repeatable.

The trees are learned from a documented, bounded sample: about ``TRAIN_DOCS`` documents of each
language, chosen by a hash of ``doc_id`` among those whose ``crc32(doc_id as text) mod 3`` is not 1.
Every document is scored as a whole. On the driver are only the trees.

Defined results: a null text, or one without a letter, is ``und`` with score 0, and so is every text
if no language was learned. Ties go to the first language in order. Rows with a null ``doc_id`` are
scored, never learned from and not held out; repeated rows are scored row by row.
"""

from __future__ import annotations

from dataclasses import dataclass

import numpy as np
import pyarrow as pa
import regex
from pyspark.sql import DataFrame, SparkSession
from pyspark.sql import functions as F

from stratalake.llm.common import add_columns, crc32_mod3, free_name, map_batches, share, table

ORDER = 4
TRAIN_DOCS = 200
#: A context seen fewer times than this is left to its shorter context.
LEAST_CONTEXT = 3
#: A text that costs more bits a byte than this in every language is in none of them.
MOST_BITS = 6.0
LEAST_NODES = 1000
UNKNOWN = "und"

_UNIT = 1024
#: Bytes scored at once.
_WINDOW = 1 << 19
_LETTER = regex.compile(r"\p{L}")


@dataclass(frozen=True)
class Model:
    """The trees of all languages, laid over each other.

    ``classes`` maps a byte to its column (0: never seen), ``child`` a node and the next older byte
    to a longer context, ``cost`` a node and a byte to its code length in each language.
    """

    languages: tuple[str, ...]
    classes: np.ndarray
    child: np.ndarray
    cost: np.ndarray

    @property
    def width(self) -> int:
        return int(self.classes.max()) + 1

    @property
    def nodes(self) -> int:
        return len(self.child) // self.width - 1

    def code_lengths(self, texts: list[bytes]) -> np.ndarray:
        """Code length of each text in each language, in 1/1024 bits."""
        total = np.zeros((len(texts), len(self.languages)), dtype=np.int64)
        waiting, size = [], 0
        for i, text in enumerate(texts):
            for low in range(0, len(text), _WINDOW):
                waiting.append((i, text[max(0, low - ORDER) : low], text[low : low + _WINDOW]))
                size += len(waiting[-1][2])
                if size >= _WINDOW:
                    self._add(total, waiting)
                    waiting, size = [], 0
        if waiting:
            self._add(total, waiting)
        return total

    def _add(self, total: np.ndarray, pieces: list[tuple[int, bytes, bytes]]) -> None:
        """Add the code lengths of pieces of texts, each with the few bytes that come before it."""
        data = np.frombuffer(b"".join(lead.rjust(ORDER, b"\0") + body for _, lead, body in pieces), dtype=np.uint8)
        lengths = np.array([len(body) for _, _, body in pieces], dtype=np.int64)
        heads = np.concatenate(([0], np.cumsum(lengths)[:-1]))
        kept = self.classes[data]
        for k, (_, lead, _) in enumerate(pieces):
            first = heads[k] + k * ORDER
            kept[first : first + ORDER - len(lead)] = 0
        at = np.arange(lengths.sum()) + np.repeat(ORDER * np.arange(1, len(pieces) + 1), lengths)
        width, dead = self.width, self.nodes
        node = best = np.zeros(len(at), dtype=np.int32)
        for back in range(1, ORDER + 1):
            node = self.child[node * width + kept[at - back]]
            best = np.where(node == dead, best, node)
        cost = self.cost[best * width + kept[at]]
        sums = np.add.reduceat(cost, heads, axis=0, dtype=np.int64)
        np.add.at(total, [i for i, _, _ in pieces], sums)

    def predict(self, texts: list[str | None]) -> tuple[list[str], list[float], list[float]]:
        """Language, share of the best among all codes, and bits a byte in the best."""
        known = [i for i, t in enumerate(texts) if t is not None and self.languages and _LETTER.search(t)]
        languages, scores, bits = [UNKNOWN] * len(texts), [0.0] * len(texts), [8.0] * len(texts)
        if known:
            raw = [texts[i].lower().encode("utf-8", "replace") for i in known]
            lengths = self.code_lengths(raw)
            best = lengths.argmin(axis=1)
            least = lengths.min(axis=1)
            share = 1 / np.exp2(np.maximum(-60.0, (least[:, None] - lengths) / _UNIT)).sum(axis=1)
            for k, i in enumerate(known):
                languages[i], scores[i] = self.languages[best[k]], float(share[k])
                bits[i] = float(least[k]) / _UNIT / len(raw[k])
        return languages, scores, bits


def compile_model(counts: dict[str, dict[bytes, dict[int, int]]]) -> Model:
    """The model of ``language -> context -> next byte -> count``."""
    languages = tuple(sorted(counts))
    seen = sorted({b for tree in counts.values() for b in tree.get(b"", {})})
    classes = np.zeros(256, dtype=np.int32)
    for k, b in enumerate(seen):
        classes[b] = k + 1
    width = len(seen) + 1
    known = {ctx for tree in counts.values() for ctx, after in tree.items() if sum(after.values()) >= LEAST_CONTEXT}
    contexts = sorted({ctx[k:] for ctx in known for k in range(len(ctx) + 1)} | {b""}, key=lambda c: (len(c), c))
    number = {ctx: k for k, ctx in enumerate(contexts)}
    dead = len(contexts)
    child = np.full((dead + 1, width), dead, dtype=np.int32)
    for ctx, k in number.items():
        if ctx:
            child[number[ctx[1:]], classes[ctx[0]]] = k
    cost = np.zeros((dead, width, len(languages)), dtype=np.int32)
    base = np.full(width, 1 / 256)
    for column, language in enumerate(languages):
        tree = counts[language]
        chance = np.empty((dead, width))
        for k, ctx in enumerate(contexts):
            shorter = chance[number[ctx[1:]]] if ctx else base
            after = tree.get(ctx, {})
            total = sum(after.values())
            if not after or ctx and total < LEAST_CONTEXT:
                chance[k] = shorter
                continue
            here = np.zeros(width)
            for b, n in after.items():
                here[classes[b]] = n
            old = here > 0
            left = max(1e-9, 1 - shorter[old].sum())
            whole = total + len(after)
            chance[k] = np.where(old, here / whole, len(after) / whole * np.minimum(1, shorter / left))
        cost[:, :, column] = np.rint(-np.log2(np.maximum(chance, 2.0**-40)) * _UNIT)
    return Model(languages, classes, child.reshape(-1), cost.reshape(dead * width, len(languages)))


def count_contexts(batches):
    """Counts of (language, context, next byte) in a partition of the sample."""
    for batch in batches:
        found: dict[tuple[str, bytes, int], int] = {}
        for language, text in zip(batch.column(0).to_pylist(), batch.column(1).to_pylist()):
            raw = text.lower().encode("utf-8", "replace")
            for size in range(ORDER + 1):
                for i in range(size, len(raw)):
                    key = language, raw[i - size : i], raw[i]
                    found[key] = found.get(key, 0) + 1
        keys = list(found)
        yield pa.RecordBatch.from_arrays(
            [pa.array([k[0] for k in keys], pa.string()), pa.array([k[1] for k in keys], pa.binary()),
             pa.array([k[2] for k in keys], pa.int32()), pa.array(list(found.values()), pa.int64())],
            names=["lang", "context", "after", "n"])


def learn(docs: DataFrame, train_docs: int = TRAIN_DOCS) -> Model:
    """Trees of the languages of the documents that are not held out."""
    usable = docs.select("doc_id", "lang", "text").where(
        F.col("text").isNotNull() & F.col("lang").isNotNull() & (crc32_mod3() != 1))
    sizes = {r["lang"]: r["count"] for r in usable.groupBy("lang").count().collect()}
    if not sizes:
        return Model((), np.zeros(256, dtype=np.int32), np.zeros(1, dtype=np.int32), np.zeros((1, 0), dtype=np.int32))
    scale = 1 << 40
    cut = F.create_map(*[F.lit(x) for lang, n in sizes.items() for x in (lang, int(min(1, train_docs / n) * scale))])
    sample = usable.where(F.pmod(F.xxhash64("doc_id"), F.lit(scale)) < cut[F.col("lang")]).select("lang", "text")
    counted = (map_batches(sample, count_contexts, "lang string, context binary, after int, n long")
               .groupBy("lang", "context", "after").agg(F.sum("n").alias("n"))
               .groupBy("lang", "context").agg(F.collect_list(F.struct("after", "n")).alias("found"), F.sum("n").alias("whole"))
               .where((F.col("whole") >= LEAST_CONTEXT) | (F.octet_length("context") == 0)).drop("whole"))
    counts: dict[str, dict[bytes, dict[int, int]]] = {lang: {} for lang in sizes}
    for batch in counted.toArrow().to_batches():
        for lang, context, found in zip(*[c.to_pylist() for c in batch.columns]):
            counts[lang][context] = {x["after"]: x["n"] for x in found}
    return compile_model({lang: tree for lang, tree in counts.items() if tree})


FIELDS = {"lang_pred": pa.string(), "score": pa.float64(), "bits_per_byte": pa.float64()}


def identify(df: DataFrame, model: Model, text: str = "text", keep: list[str] | None = None) -> DataFrame:
    """The frame (or its columns ``keep``) with ``lang_pred``, ``score`` and ``bits_per_byte``."""
    shared = share(df.sparkSession, model)
    return add_columns(df, text, FIELDS, lambda texts: shared.value.predict(texts), keep)


def accepted_documents(df: DataFrame, model: Model, text: str = "text") -> DataFrame:
    """The documents in one of the learned languages, with their columns.

    Rejected are those without a letter, and, once the trees know at least ``LEAST_NODES`` contexts,
    those that cost more than ``MOST_BITS`` a byte in every language.
    """
    grown = model.nodes >= LEAST_NODES
    shared = share(df.sparkSession, model)
    name = free_name(df, "_accepted")

    def accept(texts):
        bits = shared.value.predict(texts)[2] if grown else [0.0] * len(texts)
        return [[t is not None and _LETTER.search(t) is not None and b <= MOST_BITS for t, b in zip(texts, bits)]]

    return add_columns(df, text, {name: pa.bool_()}, accept).where(F.col(name)).drop(name)


def op9_language_id(spark: SparkSession, sf_dir: str) -> DataFrame:
    """The language of every document."""
    docs = table(spark, sf_dir, "documents")
    model = learn(docs)
    rows = docs.select("doc_id", F.coalesce(crc32_mod3() == 1, F.lit(False)).alias("held_out"), "text")
    return identify(rows, model, keep=["doc_id", "held_out"])


QUERIES = {"op9_language_id": op9_language_id}
