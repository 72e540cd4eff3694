"""Token-id files: static range asymmetric numeral systems over interleaved lanes.

A file is a row of segments in ascending ``doc_id`` order (one Parquet row each, so that Spark moves and splits
them). A segment holds whole documents of about ``SEGMENT`` ids and is made of

    header    magic ``TIDS``, version, blocks, documents, ids, length and CRC-32 of the tables that follow
    tables    the ids that occur, as gaps, and their frequencies out of ``2 ** PRECISION``; documents' lengths
    blocks    for each: ids, words, checkpoints, CRC-32 of its ids, lane states, checkpoints, words

The frequency table is frozen per segment and shared by its blocks. Each block is coded on its own over ``LANES``
interleaved lanes: id ``i`` belongs to lane ``i mod LANES``, each lane has a 64-bit state, and a lane that runs low takes the
next 32-bit word, in lane order. Every ``CHECKPOINT`` steps the states and the place in the words are kept, so
a block can be read from several places at once; the checksum tells whether the ids are those written.

Defined results: a null or empty text is the end id alone; null ids come first; repeated rows are written one
after the other; an empty table gives no segment. Texts of any length fit; a document is never split over segments.
"""

from __future__ import annotations

import struct
import zlib

import numpy as np
import pyarrow as pa
from pyspark import TaskContext
from pyspark.sql import DataFrame, SparkSession
from pyspark.sql import functions as F

from stratalake.llm.common import Scratch, map_batches, partitions, table
from stratalake.llm.encoding import GROUP_CHARS, encoder
from stratalake.llm.packing import vocabulary

END = 1
SEGMENT = 1 << 20
BLOCK = 1 << 19
LANES = 1024
CHECKPOINT = 256
PRECISION = 18

_MAGIC = b"TIDS"
_HEADER = struct.Struct("<4sHHIQII")
_BLOCK = struct.Struct("<IIII")
_LOW = np.uint64(1 << 31)
_P = np.uint64(PRECISION)
_MASK = np.uint64((1 << PRECISION) - 1)
_WORD = np.uint64(32)


class CorruptFile(ValueError):
    """A checksum or a header does not fit."""


def frequencies(counts: np.ndarray) -> np.ndarray:
    """Counts scaled to a sum of ``2 ** PRECISION``, each at least 1."""
    whole = 1 << PRECISION
    scaled = np.maximum(1, counts * whole // counts.sum()).astype(np.int64)
    spare = whole - int(scaled.sum())
    order = np.argsort(-scaled, kind="stable")
    if spare >= 0:
        scaled[order[0]] += spare
        return scaled
    for k in order:  # too many were raised to 1; the most frequent give it back
        give = min(-spare, int(scaled[k]) - 1)
        scaled[k] -= give
        spare += give
        if not spare:
            break
    return scaled


class Code:
    """A frozen frequency table of a segment."""

    def __init__(self, symbols: np.ndarray, freq: np.ndarray):
        self.symbols = symbols.astype(np.uint32)
        self.freq = freq.astype(np.uint64)
        self.start = np.concatenate(([0], np.cumsum(freq)[:-1])).astype(np.uint64)
        self._slots: np.ndarray | None = None
        self._place: np.ndarray | None = None

    @property
    def place(self) -> np.ndarray:
        """The place in the table of each id that occurs."""
        if self._place is None:
            self._place = np.zeros(int(self.symbols.max(initial=0)) + 1, dtype=np.int64)
            self._place[self.symbols] = np.arange(len(self.symbols))
        return self._place

    @property
    def slots(self) -> np.ndarray:
        """The symbol of each slot of the range."""
        if self._slots is None:
            self._slots = np.repeat(np.arange(len(self.freq), dtype=np.uint32), self.freq.astype(np.int64))
        return self._slots

    def encode(self, ids: np.ndarray) -> bytes:
        """One block: coded backwards, so that it is read forwards."""
        which = self.place[ids]
        steps = -(-len(ids) // LANES)
        state = np.full(LANES, _LOW, dtype=np.uint64)
        words, marks = [], []
        for step in range(steps - 1, -1, -1):
            own = which[step * LANES : (step + 1) * LANES]
            freq, start = self.freq[own], self.start[own]
            now = state[: len(own)]
            full = now >= freq << np.uint64(63 - PRECISION)
            words.append((now[full] & np.uint64(0xFFFFFFFF)).astype("<u4"))
            now = np.where(full, now >> _WORD, now)
            whole, rest = np.divmod(now, freq)
            state[: len(own)] = (whole << _P) + rest + start
            if step and step % CHECKPOINT == 0:
                marks.append((step, state.copy()))
        words.reverse()
        before = np.concatenate(([0], np.cumsum([len(w) for w in words]))) if words else np.zeros(1, np.int64)
        marks.reverse()
        kept = b"".join(struct.pack("<I", before[step]) + states.astype("<u8").tobytes() for step, states in marks)
        stream = np.concatenate(words) if words else np.empty(0, "<u4")
        head = _BLOCK.pack(len(ids), len(stream), len(marks), zlib.crc32(ids.astype("<u4").tobytes()))
        return head + state.astype("<u8").tobytes() + kept + stream.tobytes()

    def read_steps(self, state: np.ndarray, words: np.ndarray, at: int, count: int, first: int, last: int) -> np.ndarray:
        """Ids of the steps from ``first`` to ``last`` of a block of ``count`` ids."""
        out = np.empty(min(count, last * LANES) - first * LANES, dtype=np.uint32)
        state, slots = state.astype(np.uint64), self.slots
        for step in range(first, last):
            width = min(LANES, count - step * LANES)
            now = state[:width]
            slot = now & _MASK
            which = slots[slot]
            low = (step - first) * LANES
            out[low : low + width] = which
            now = self.freq[which] * (now >> _P) + slot - self.start[which]
            short = np.flatnonzero(now < _LOW)
            if len(short):
                now[short] = (now[short] << _WORD) | words[at : at + len(short)]
                at += len(short)
            state[:width] = now
        return self.symbols[out]


def _numbers(values: np.ndarray) -> bytes:
    packed = zlib.compress(values.astype("<u4").tobytes(), 1)
    return struct.pack("<I", len(packed)) + packed


def _read_numbers(raw: memoryview, at: int) -> tuple[np.ndarray, int]:
    (size,) = struct.unpack_from("<I", raw, at)
    return np.frombuffer(zlib.decompress(raw[at + 4 : at + 4 + size]), dtype="<u4").astype(np.int64), at + 4 + size


def write_segment(documents: list[np.ndarray]) -> bytes:
    """A segment of whole documents, each the ids of one."""
    ids = np.concatenate(documents).astype(np.uint32) if documents else np.empty(0, np.uint32)
    counts = np.bincount(ids)
    symbols = np.flatnonzero(counts)
    freq = frequencies(counts[symbols]) if len(ids) else symbols
    code = Code(symbols, freq)
    blocks = [code.encode(ids[low : low + BLOCK]) for low in range(0, len(ids), BLOCK)]
    tables = (_numbers(np.diff(symbols, prepend=0)) + _numbers(freq)
              + _numbers(np.array([len(d) for d in documents], dtype=np.uint32)))
    head = _HEADER.pack(_MAGIC, 1, len(blocks), len(documents), len(ids), len(tables), zlib.crc32(tables))
    return head + tables + b"".join(struct.pack("<I", len(b)) + b for b in blocks)


class Segment:
    """A segment that is read; its blocks can be decoded in any order."""

    def __init__(self, raw: bytes):
        self.raw = memoryview(raw)
        if len(raw) < _HEADER.size:
            raise CorruptFile("too short for a header")
        magic, version, blocks, self.documents, self.count, size, crc = _HEADER.unpack_from(self.raw)
        at = _HEADER.size
        if magic != _MAGIC or version != 1 or zlib.crc32(self.raw[at : at + size]) != crc:
            raise CorruptFile("header or tables differ from those written")
        gaps, place = _read_numbers(self.raw, at)
        freq, place = _read_numbers(self.raw, place)
        self.lengths, _ = _read_numbers(self.raw, place)
        self.code = Code(np.cumsum(gaps), freq)
        self.places, at = [], at + size
        for _ in range(blocks):
            (size,) = struct.unpack_from("<I", self.raw, at)
            self.places.append(at + 4)
            at += 4 + size

    def block(self, number: int, first: int = 0, last: int | None = None) -> np.ndarray:
        """The ids of a block, or those between two of its checkpoints (0 is its start)."""
        at = self.places[number]
        count, n_words, marks, crc = _BLOCK.unpack_from(self.raw, at)
        at += _BLOCK.size
        state, place = np.frombuffer(self.raw, "<u8", LANES, at), 0
        at += 8 * LANES
        size = 4 + 8 * LANES
        if first:
            mark = at + (first - 1) * size
            (place,) = struct.unpack_from("<I", self.raw, mark)
            state = np.frombuffer(self.raw, "<u8", LANES, mark + 4)
        words = np.frombuffer(self.raw, "<u4", n_words, at + marks * size)
        steps = -(-count // LANES)
        end = steps if last is None or last > marks else last * CHECKPOINT
        ids = self.code.read_steps(state, words, place, count, first * CHECKPOINT, end)
        if not first and end == steps and zlib.crc32(ids.astype("<u4").tobytes()) != crc:
            raise CorruptFile(f"block {number} differs from the one written")
        return ids

    def ids(self) -> np.ndarray:
        """All ids of the segment."""
        return np.concatenate([self.block(k) for k in range(len(self.places))] or [np.empty(0, np.uint32)])


SEGMENTS = "file int, segment int, before long, n_tokens long, doc_ids array<long>, content binary"


def _together(batches):
    """Ids and texts of several batches, so that a piece is looked up and encoded once for all of them."""
    doc_ids, texts, size = [], [], 0
    for batch in batches:
        doc_ids += batch.column(0).to_pylist()
        texts += batch.column(1).to_pylist()
        size += batch.column(1).nbytes
        if size >= GROUP_CHARS:
            yield doc_ids, texts
            doc_ids, texts, size = [], [], 0
    if doc_ids:
        yield doc_ids, texts


def _write(path: str, end: int):
    def work(batches):
        file = TaskContext.get().partitionId()
        waiting: list[np.ndarray] = []
        names: list[int | None] = []
        size, number, before = 0, 0, 0

        def flush():
            nonlocal waiting, names, size, number, before
            row = pa.RecordBatch.from_arrays(
                [pa.array([file], pa.int32()), pa.array([number], pa.int32()), pa.array([before], pa.int64()),
                 pa.array([size], pa.int64()), pa.array([names], pa.list_(pa.int64())),
                 pa.array([write_segment(waiting)], pa.binary())],
                names=["file", "segment", "before", "n_tokens", "doc_ids", "content"])
            number, before = number + 1, before + size
            waiting, names, size = [], [], 0
            return row

        for doc_ids, texts in _together(batches):
            for doc_id, ids in zip(doc_ids, encoder(path, False).encode(texts)):
                waiting.append(np.append(ids, np.uint32(end)))
                names.append(doc_id)
                size += len(waiting[-1])
                if size >= SEGMENT:
                    yield flush()
        if waiting:
            yield flush()

    return work


def write_tokens(docs: DataFrame, tokenizer: str, folder: str, end: int = END) -> None:
    """Write the ids of all documents to files in ascending ``doc_id`` order, one file a range of ids.

    Equal ids are told apart by the row's number, so that one id in very many rows is dealt to
    several files.
    """
    rows = docs.select("doc_id", "text").withColumn("row", F.monotonically_increasing_id())
    ordered = rows.repartitionByRange(partitions(docs), "doc_id", "row").sortWithinPartitions("doc_id", "row")
    map_batches(ordered.select("doc_id", "text"), _write(tokenizer, end), SEGMENTS).write.parquet(folder)


def _read(batches):
    for batch in batches:
        files, ids, starts, counts, sums = [], [], [], [], []
        for file, before, names, content in zip(*[batch.column(k).to_pylist() for k in range(4)]):
            segment = Segment(content)
            tokens = segment.ids().astype("<u4")
            edges = np.concatenate(([0], np.cumsum(segment.lengths)))
            files += [file] * len(names)
            ids += names
            starts += (before + edges[:-1]).tolist()
            counts += segment.lengths.tolist()
            sums += [zlib.crc32(tokens[edges[k] : edges[k + 1]].tobytes()) for k in range(len(names))]
        yield pa.RecordBatch.from_arrays(
            [pa.array(files, pa.int32()), *[pa.array(x, pa.int64()) for x in (ids, starts, counts, sums)]],
            names=["file", "doc_id", "start", "n_tokens", "ids_crc32"])


def read_tokens(spark: SparkSession, folder: str) -> DataFrame:
    """A row per document from the files: doc_id, start (ids before it), n_tokens, ids_crc32."""
    segments = spark.read.schema(SEGMENTS).parquet(folder)
    # One number a file comes to the driver; files are as many as the partitions that wrote them.
    sizes = sorted((r["file"], r["n"]) for r in segments.groupBy("file").agg(F.sum("n_tokens").alias("n")).collect())
    bases, before = [], 0
    for file, n in sizes:
        bases.append((file, before))
        before += n
    base = F.broadcast(spark.createDataFrame(bases, "file int, base long"))
    docs = map_batches(segments.select("file", "before", "doc_ids", "content"), _read,
                       "file int, doc_id long, start long, n_tokens long, ids_crc32 long")
    return docs.join(base, "file").select("doc_id", (F.col("base") + F.col("start")).alias("start"), "n_tokens", "ids_crc32")


def op8_token_files(spark: SparkSession, sf_dir: str) -> DataFrame:
    """The documents as read back from the token files of the whole table."""
    scratch = Scratch(spark)
    folder = scratch.path("token-files")
    write_tokens(table(spark, sf_dir, "documents"), vocabulary("word_bpe_49k.json"), folder)
    return read_tokens(spark, folder)


QUERIES = {"op8_token_files": op8_token_files}
