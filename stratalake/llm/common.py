"""Helpers the corpus operators share: Arrow batches of bounded size, word hashes, scratch tables."""

from __future__ import annotations

import ctypes
import gc
import tempfile
import zipfile
from collections.abc import Callable, Iterator
from contextlib import contextmanager
from pathlib import Path

import numpy as np
import pyarrow as pa
from pyspark.sql import DataFrame, SparkSession
from pyspark.sql import functions as F
from pyspark.sql import types as T
from pyspark.sql.pandas.types import from_arrow_type

from stratalake.session import scratch_path

# Bounds of one Arrow batch. A batch holds whole texts, so it is bounded in rows and in bytes.
BATCH_ROWS = 256
BATCH_BYTES = "16m"

_PAIR = np.uint64(0xFF51AFD7ED558CCD)
_SECOND = np.uint64(0xC4CEB9FE1A85EC53)
_SHIFT = np.uint64(33)


def bounded_batches(spark: SparkSession) -> None:
    """Keep Arrow batches of whole texts small in this session (two settings of the session)."""
    spark.conf.set("spark.sql.execution.arrow.maxRecordsPerBatch", str(BATCH_ROWS))
    spark.conf.set("spark.sql.execution.arrow.maxBytesPerBatch", BATCH_BYTES)


_shipped: set[str] = set()


def ship(spark: SparkSession) -> None:
    """Send this package to the Python workers, which may run where it is not installed; once an application."""
    context = spark.sparkContext
    if context.applicationId not in _shipped:
        root = Path(__file__).resolve().parents[1]
        archive = Path(tempfile.mkdtemp(prefix="stratalake-ship-")) / "stratalake.zip"
        with zipfile.ZipFile(archive, "w", zipfile.ZIP_DEFLATED) as out:
            for path in sorted(root.rglob("*.py")):
                out.write(path, path.relative_to(root.parent))
        context.addPyFile(str(archive))
        _shipped.add(context.applicationId)


def release_memory() -> None:
    """Give what a finished task has freed back to the system, so that a reused worker does not grow from stage to stage."""
    pa.default_memory_pool().release_unused()
    try:
        ctypes.CDLL(None).malloc_trim(0)
    except (OSError, AttributeError):
        pass


_kept: dict = {"label": None, "things": {}}


def begin_task(label: str) -> None:
    """Drop what tasks of another kind have left in this worker."""
    if _kept["label"] != label:
        _kept["label"], things = label, _kept.pop("things")
        _kept["things"] = {}
        if things:
            del things
            release_memory()


def kept(key, make: Callable):
    """What ``make`` returns, kept in this worker for the next tasks of the same kind and dropped before any other."""
    things = _kept["things"]
    if key not in things:
        things[key] = make()
    return things[key]


def map_batches(df: DataFrame, work: Callable[[Iterator[pa.RecordBatch]], Iterator[pa.RecordBatch]],
                schema: str | T.StructType) -> DataFrame:
    """``mapInArrow`` with bounded batches.

    What ``work`` holds is its task's own and is given back when the task ends; what is to stay for the next one goes through ``kept``.
    """
    bounded_batches(df.sparkSession)
    ship(df.sparkSession)
    label = f"{work.__module__}.{work.__qualname__}"

    def run(batches):
        begin_task(label)
        try:
            yield from work(batches)
        finally:
            release_memory()

    return df.mapInArrow(run, schema)


_shared: list = []
_scopes: list = []


def share(spark: SparkSession, value):
    """A broadcast variable that ``shared_within`` releases; outside of it only frames hold it, so Spark releases it with the last one.

    What the driver needed to make its value is given back to the system.
    """
    made = spark.sparkContext.broadcast(value)
    if _scopes:
        _shared.append(made)
    gc.collect()
    release_memory()
    return made


@contextmanager
def shared_within():
    """Release the broadcast variables made inside, whose frames must be stored by then."""
    before = len(_shared)
    _scopes.append(before)
    try:
        yield
    finally:
        _scopes.pop()
        for made in _shared[before:]:
            made.destroy()
        del _shared[before:]
        # What the driver learned from samples is let go as well, before the next stage begins.
        gc.collect()
        release_memory()


def free_name(df: DataFrame, wanted: str) -> str:
    """A column name that the frame does not have yet, in any letter case."""
    taken = {name.lower() for name in df.columns}
    name = wanted
    while name.lower() in taken:
        name = "_" + name
    return name


def free_prefix(df: DataFrame, wanted: str) -> str:
    """A prefix that no column of the frame begins with, in any letter case."""
    prefix = wanted
    while any(name.lower().startswith(prefix.lower()) for name in df.columns):
        prefix = "_" + prefix
    return prefix


def table(spark: SparkSession, sf_dir: str, name: str) -> DataFrame:
    return spark.read.parquet(f"{sf_dir}/{name}.parquet")


def partitions(df: DataFrame) -> int:
    return int(df.sparkSession.conf.get("spark.sql.shuffle.partitions"))


def add_columns(df: DataFrame, source: str, fields: dict[str, pa.DataType],
                compute: Callable, keep: list[str] | None = None, per_task: bool = False) -> DataFrame:
    """``keep`` (all columns by default) and new ``fields`` that ``compute`` makes from ``source``.

    ``compute`` takes the values of one bounded batch and returns one list or array a field. With ``per_task`` it takes
    nothing and returns such a function, which lives as long as its task. Kept columns named like a field, in any letter
    case, are replaced by it.
    """
    new = {name.lower() for name in fields}
    kept = [c for c in (df.columns if keep is None else keep) if c.lower() not in new]
    # The source goes in once more under a name of its own, so it may be kept or replaced as well.
    sent = df.select(*[F.col(f"`{c}`") for c in kept], F.col(f"`{source}`").alias(free_name(df, "_source")))
    names = kept + list(fields)

    def work(batches):
        use = compute() if per_task else compute
        for batch in batches:
            made = use(batch.column(len(kept)).to_pylist())
            arrays = [batch.column(k) for k in range(len(kept))]
            arrays += [pa.array(values, kind) for values, kind in zip(made, fields.values())]
            yield pa.RecordBatch.from_arrays(arrays, names=names)

    types = [df.schema[c].dataType for c in kept] + [from_arrow_type(kind) for kind in fields.values()]
    schema = T.StructType([T.StructField(name, kind) for name, kind in zip(names, types)])
    return map_batches(sent, work, schema)


class Scratch:
    """Intermediate tables in the shared scratch folder, removed as soon as nothing reads them."""

    def __init__(self, spark: SparkSession):
        self.spark = spark
        self.paths: dict[str, str] = {}

    def write(self, df: DataFrame, label: str) -> DataFrame:
        """Write a frame once and read it back; a lost executor repeats only its own part."""
        path = self.path(label)
        df.write.parquet(path)
        return self.spark.read.schema(df.schema).parquet(path)

    def path(self, label: str) -> str:
        """A new folder with this label."""
        path = scratch_path(self.spark, label)
        self.paths[path] = label
        return path

    def drop(self, *labels: str) -> None:
        """Remove the tables with these labels."""
        jvm = self.spark._jvm
        conf = self.spark._jsc.hadoopConfiguration()
        for path in [p for p, label in self.paths.items() if label in labels]:
            place = jvm.org.apache.hadoop.fs.Path(path)
            place.getFileSystem(conf).delete(place, True)
            del self.paths[path]


def text_bytes(column: pa.Array) -> list[bytes | None]:
    """The UTF-8 bytes of each text."""
    return column.cast(pa.binary()).to_pylist()


def crc32_mod3(doc_id: str = "doc_id"):
    return F.crc32(F.col(doc_id).cast("string").cast("binary")) % 3


def mix(values: np.ndarray) -> np.ndarray:
    """A 64-bit finaliser: close inputs get unrelated outputs."""
    out = values ^ (values >> _SHIFT)
    out = out * _PAIR
    out ^= out >> _SHIFT
    out *= _SECOND
    out ^= out >> _SHIFT
    return out


_rng = np.random.default_rng(20240229)
_BYTE_CODE = _rng.integers(0, 2**63, 256, dtype=np.uint64) * np.uint64(2) + np.uint64(1)
_STEP = np.uint64(0x9E3779B97F4A7C15)
_SPACE = np.zeros(256, dtype=bool)
_SPACE[[9, 10, 11, 12, 13, 32]] = True
_INVERSE = np.uint64(pow(int(_STEP), -1, 2**64))
#: Bytes or words hashed at once; the tables of powers are no longer, unless one word is.
BLOCK = 1 << 16


def _series(step: np.uint64, n: int) -> np.ndarray:
    """Powers 0 to n - 1 modulo 2**64 of an odd number; odd, so each has an inverse."""
    steps = np.full(n, step, dtype=np.uint64)
    steps[:1] = 1
    return np.multiply.accumulate(steps)


_POWERS, _INVERSES = _series(_STEP, BLOCK), _series(_INVERSE, BLOCK)


def _powers_to(n: int) -> tuple[np.ndarray, np.ndarray]:
    """Powers and their inverses; beyond a block made anew and not kept."""
    return (_POWERS, _INVERSES) if n <= BLOCK else (_series(_STEP, n), _series(_INVERSE, n))


def word_bounds(data: np.ndarray) -> tuple[np.ndarray, np.ndarray]:
    """Starts and ends of the runs without white space ``[\\x20\\x09-\\x0D]``."""
    inside = np.empty(len(data) + 2, dtype=bool)
    inside[0] = inside[-1] = False
    np.logical_not(_SPACE[data], out=inside[1:-1])
    edges = np.flatnonzero(inside[1:] != inside[:-1])
    return edges[0::2], edges[1::2]


def word_hashes(raw: bytes) -> np.ndarray:
    """A 64-bit hash of each word of a text, equal words having equal hashes.

    The bytes form one polynomial; a word is a difference of two prefix sums brought back to
    exponent zero, so no word is cut out of the text. Long texts are hashed in blocks of whole words.
    """
    data = np.frombuffer(raw, dtype=np.uint8)
    starts, ends = word_bounds(data)
    out = np.empty(len(starts), dtype=np.uint64)
    low = 0
    while low < len(starts):
        first = starts[low]
        high = max(low + 1, int(np.searchsorted(ends, first + BLOCK, side="right")))
        own = data[first : ends[high - 1]]
        powers, inverses = _powers_to(len(own))
        sums = np.zeros(len(own) + 1, dtype=np.uint64)
        np.cumsum(_BYTE_CODE[own] * powers[: len(own)], out=sums[1:])
        here, there = starts[low:high] - first, ends[low:high] - first
        out[low:high] = mix((sums[there] - sums[here]) * inverses[here] ^ (there - here).astype(np.uint64))
        low = high
    return out


_PLACE = _rng.integers(0, 2**63, 64, dtype=np.uint64) * np.uint64(2) + np.uint64(1)


def shingle_hashes(words: np.ndarray, size: int) -> np.ndarray:
    """Hashes of the runs of ``size`` words; a shorter text is one shingle, one without words none."""
    if not len(words):
        return words
    size = min(size, len(words))
    n = len(words) - size + 1
    total = np.full(n, np.uint64(size), dtype=np.uint64)
    for k in range(size):
        total = mix(total + words[k : k + n] * _PLACE[k])
    return total


def run_hashes(words: np.ndarray, size: int) -> np.ndarray:
    """Hashes of all runs of ``size`` words, from prefix sums: the cost does not depend on the size."""
    out = np.empty(max(0, len(words) - size + 1), dtype=np.uint64)
    step = max(1, BLOCK - size)
    for low in range(0, len(out), step):
        own = words[low : low + step + size - 1]
        powers, inverses = _powers_to(len(own))
        sums = np.zeros(len(own) + 1, dtype=np.uint64)
        np.cumsum(own * powers[: len(own)], out=sums[1:])
        out[low : low + step] = mix((sums[size:] - sums[:-size]) * inverses[: len(own) - size + 1])
    return out
