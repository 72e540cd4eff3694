"""Packing of token ids by best-fit decreasing.

Every document becomes the ids of its text and an end id. Documents of at least a window are first cut into
full windows, each a sequence of its own; what is left over is dealt by a hash of its row into groups of about
``GROUP`` pieces, and each group is packed by best-fit decreasing: longest first, into the open sequence with the
least room that still takes it, else into a new one. A segment tree over the room, 0 to the window, finds that sequence. A
group leaves at most a few sequences half filled, so padding does not grow with the number of groups.

Only lengths are packed. ``pack(keep_ids=True)`` carries the ids along and ``sequences`` puts the
padded sequences together.

Defined results: a null or empty text is the end id alone; rows with a null ``doc_id`` and repeated rows are packed
row by row; an empty table gives no sequence. The tokenizer file is a parameter and must be readable where
tasks run.
"""

from __future__ import annotations

import zlib

import numpy as np
import pyarrow as pa
from pyspark.sql import DataFrame, SparkSession
from pyspark.sql import functions as F

from stratalake.llm.common import Scratch, map_batches, table
from stratalake.llm.encoding import encoder

WINDOW = 1024
END = 0
GROUP = 2048


def vocabulary(name: str) -> str:
    import public_tokenizers

    return public_tokenizers.path(name)


class Rooms:
    """Open sequences by room, with the least sufficient room found in a segment tree."""

    def __init__(self, window: int):
        self.size = 1
        while self.size <= window:
            self.size *= 2
        self.count = [0] * (2 * self.size)
        self.open: list[list[int]] = [[] for _ in range(window + 1)]

    def _change(self, room: int, by: int) -> None:
        node = self.size + room
        while node:
            self.count[node] += by
            node //= 2

    def put(self, room: int, sequence: int) -> None:
        self.open[room].append(sequence)
        self._change(room, 1)

    def take(self, least: int) -> tuple[int, int] | None:
        """A sequence with the least room of at least ``least``, and that room."""
        node = self.size + least
        if not self.count[node]:
            while node > 1 and (node % 2 or not self.count[node + 1]):
                node //= 2
            if node == 1:
                return None
            node += 1
            while node < self.size:
                node *= 2
                if not self.count[node]:
                    node += 1
        room = node - self.size
        self._change(room, -1)
        return self.open[room].pop(), room


def best_fit(lengths: np.ndarray, window: int = WINDOW) -> tuple[np.ndarray, np.ndarray]:
    """Sequence and offset of each piece."""
    sequence, offset = np.zeros(len(lengths), np.int64), np.zeros(len(lengths), np.int64)
    rooms, opened = Rooms(window), 0
    for k in np.argsort(-lengths, kind="stable"):
        length = int(lengths[k])
        found = rooms.take(length)
        if found is None:
            found = opened, window
            opened += 1
        sequence[k], offset[k] = found[0], window - found[1]
        rooms.put(found[1] - length, found[0])
    return sequence, offset


def _cut(path: str, window: int, end: int, keep_ids: bool):
    def work(batches):
        for batch in batches:
            ids = encoder(path, True).encode(batch.column(1).to_pylist())
            rows, starts, lengths, sums, totals, pieces = [], [], [], [], [], []
            for k, own in enumerate(ids):
                own = np.append(own, np.uint32(end)).astype("<u4")
                for low in range(0, len(own), window):
                    piece = own[low : low + window]
                    rows.append(k)
                    starts.append(low)
                    lengths.append(len(piece))
                    sums.append(zlib.crc32(piece.tobytes()))
                    totals.append(len(own))
                    if keep_ids:
                        pieces.append(piece.astype(np.int32))
            arrays = [batch.column(0).take(pa.array(rows, pa.int64())), *[pa.array(x, pa.int64()) for x in (starts, lengths, sums, totals)]]
            names = ["doc_id", "start", "length", "ids_crc32", "doc_tokens"]
            if keep_ids:
                arrays.append(pa.array(pieces, pa.list_(pa.int32())))
                names.append("ids")
            yield pa.RecordBatch.from_arrays(arrays, names=names)

    return work


def _fit(window: int):
    def work(group: pa.Table) -> pa.Table:
        # Sorted by row number, so that a repeated task packs alike whatever order its rows come in.
        group = group.sort_by("uid")
        sequence, offset = best_fit(group.column("length").to_numpy(), window)
        numbers = (group.column("g").to_numpy() * 2**32 + sequence) * 2 + 1
        return pa.table({"uid": group.column("uid"), "sequence_id": pa.array(numbers, pa.int64()),
                         "offset": pa.array(offset, pa.int64())})

    return work


def pack(docs: DataFrame, path: str, window: int = WINDOW, end: int = END, keep_ids: bool = False) -> DataFrame:
    """A row per piece: doc_id, start, length, ids_crc32, doc_tokens, sequence_id, offset (and ids)."""
    scratch = Scratch(docs.sparkSession)
    schema = "doc_id long, start long, length long, ids_crc32 long, doc_tokens long" + (", ids array<int>" if keep_ids else "")
    cut = map_batches(docs.select("doc_id", "text"), _cut(path, window, end, keep_ids), schema)
    pieces = scratch.write(cut.withColumn("uid", F.monotonically_increasing_id()), "pieces")
    full = pieces.where(F.col("length") == window).withColumns(
        {"sequence_id": F.col("uid") * 2, "offset": F.lit(0).cast("long")}).drop("uid")
    rest = pieces.where(F.col("length") < window)
    groups = max(1, -(-rest.count() // GROUP))
    dealt = rest.select("uid", "length", F.pmod(F.xxhash64("uid"), F.lit(groups)).alias("g"))
    placed = dealt.groupBy("g").applyInArrow(_fit(window), "uid long, sequence_id long, offset long")
    return full.union(rest.join(placed, "uid").drop("uid"))


def sequences(packed: DataFrame, window: int = WINDOW, pad: int = END) -> DataFrame:
    """``sequence_id``, ``n_tokens`` and the ``ids`` of each sequence, padded unless a power of two long."""
    parts = F.array_sort(F.collect_list(F.struct("offset", "ids")))
    ids = F.flatten(F.transform(parts, lambda p: p["ids"]))
    joined = packed.groupBy("sequence_id").agg(ids.alias("ids")).withColumn("n_tokens", F.size("ids"))
    power = F.col("n_tokens").bitwiseAND(F.col("n_tokens") - 1) == 0
    padded = F.concat("ids", F.array_repeat(F.lit(pad), F.lit(window) - F.col("n_tokens")))
    return joined.select("sequence_id", "n_tokens", F.when(power, F.col("ids")).otherwise(padded).alias("ids"))


def op7_packing(spark: SparkSession, sf_dir: str) -> DataFrame:
    """All documents packed into sequences of at most 1024 tokens."""
    return pack(table(spark, sf_dir, "documents"), vocabulary("byte_bpe_50k.json"))


QUERIES = {"op7_packing": op7_packing}
