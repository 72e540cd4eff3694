"""Session settings and shared scratch space."""

from __future__ import annotations

import gc
import tempfile
import uuid
from collections.abc import Callable, Iterable, Iterator
from concurrent.futures import ThreadPoolExecutor

import pyarrow as pa
from pyspark import inheritable_thread_target
from pyspark.sql import Column, DataFrame, SparkSession
from pyspark.sql import functions as F
from pyspark.sql import types as T
from pyspark.sql.pandas.types import to_arrow_schema

# Settings every job of this library relies on; all can be changed at run time.
RUNTIME_CONF = {
    "spark.sql.session.timeZone": "UTC",
    "spark.sql.adaptive.enabled": "true",
    "spark.sql.adaptive.coalescePartitions.enabled": "true",
    "spark.sql.adaptive.skewJoin.enabled": "true",
    "spark.sql.parquet.filterPushdown": "true",
}

# How stored tables are compressed; a third smaller than Spark's default for these tables.
COMPRESSION = "zstd"

# Settings that a session may have chosen itself. Rows that are joined and sorted take ten times their compressed
# size, so tasks of Spark's default size would spill.
DEFAULT_CONF = {"spark.sql.adaptive.advisoryPartitionSizeInBytes": "16m"}

_local_scratch: dict[str, str] = {}


def configure(spark: SparkSession) -> SparkSession:
    """Apply the run-time settings the library needs to an existing session."""
    for key, value in RUNTIME_CONF.items():
        spark.conf.set(key, value)
    for key, value in DEFAULT_CONF.items():
        if spark.conf.get(key, None) is None:
            spark.conf.set(key, value)
    return spark


def local_session(cores: int | str = "*", memory: str = "8g", app: str = "stratalake") -> SparkSession:
    """A local session for tests and benchmarks."""
    partitions = str(cores) if str(cores).isdigit() else "8"
    builder = (
        SparkSession.builder.master(f"local[{cores}]")
        .appName(app)
        .config("spark.ui.enabled", "false")
        .config("spark.driver.memory", memory)
        .config("spark.sql.shuffle.partitions", partitions)
        .config("spark.sql.execution.arrow.pyspark.enabled", "true")
    )
    spark = builder.getOrCreate()
    spark.sparkContext.setLogLevel("ERROR")
    return configure(spark)


def scratch_root(spark: SparkSession) -> str:
    """Shared folder for intermediate tables.

    A cluster names it in ``spark.checkpoint.dir``. Only a local master may fall back to a
    folder of this machine, since its executors run on it.
    """
    configured = spark.conf.get("spark.checkpoint.dir", None)
    if configured:
        return configured.rstrip("/")
    context = spark.sparkContext
    if not context.master.startswith("local"):
        raise RuntimeError("set spark.checkpoint.dir to a folder that every executor can reach")
    app = context.applicationId
    if app not in _local_scratch:
        _local_scratch[app] = tempfile.mkdtemp(prefix="stratalake-", dir="/tmp")
    return _local_scratch[app]


def _own_scratch(spark: SparkSession) -> str:
    return f"{scratch_root(spark)}/stratalake-{spark.sparkContext.applicationId}"


def scratch_path(spark: SparkSession, label: str) -> str:
    """A new path under this application's scratch folder that no other job uses."""
    return f"{_own_scratch(spark)}/{label}-{uuid.uuid4().hex}"


def remove_scratch(spark: SparkSession) -> None:
    """Delete everything this application has put in the scratch folder; call it when no result is needed any more."""
    remove_path(spark, _own_scratch(spark))


def remove_path(spark: SparkSession, path: str) -> None:
    """Delete a file or folder, if it is there."""
    place = spark._jvm.org.apache.hadoop.fs.Path(path)
    place.getFileSystem(spark._jsc.hadoopConfiguration()).delete(place, True)


def release_shuffles(spark: SparkSession) -> None:
    """Let Spark delete the shuffle files of frames that nothing refers to any more.

    Spark does so when the driver collects its garbage, which a driver with room to spare hardly ever does.
    """
    gc.collect()
    spark._jvm.java.lang.System.gc()


def one_by_one(frames: DataFrame | Iterable[DataFrame]) -> Iterator[DataFrame]:
    """Frames to be stored one after the other; the shuffle files of each are released before the next is made.

    Neither the maker nor the taker of a frame may keep it.
    """
    if isinstance(frames, DataFrame):
        yield frames
        return
    left = iter(frames)
    while (frame := next(left, None)) is not None:
        spark = frame.sparkSession
        yield frame
        del frame
        release_shuffles(spark)


def materialize(df: DataFrame | Iterable[DataFrame], label: str, path: str | None = None) -> DataFrame:
    """Write a frame once as Parquet and read it back.

    This cuts the lineage and freezes values that a second evaluation could produce
    differently, such as range bounds taken from a sample. The copy is columnar, so later
    reads still prune columns, and its row count comes from the file footers. Who names the ``path`` may
    remove the copy as soon as nothing reads it. Several frames of the same columns are written one after the other, and the
    shuffle files of each are released before the next.
    """
    for frame in one_by_one(df):
        spark, schema = frame.sparkSession, frame.schema
        path = path or scratch_path(spark, label)
        frame.write.mode("append").option("compression", COMPRESSION).parquet(path)
        del frame
    return spark.read.schema(schema).parquet(path)


def small_frame(spark: SparkSession, rows: Iterable[tuple], schema: str) -> DataFrame:
    """A frame of a few driver-made rows, without a Python worker to unpickle them."""
    struct = T.StructType.fromDDL(schema)
    arrow = to_arrow_schema(struct)
    columns = list(zip(*rows)) or [()] * len(struct)
    arrays = [pa.array(list(c), type=f.type) for c, f in zip(columns, arrow)]
    return spark.createDataFrame(pa.Table.from_arrays(arrays, schema=arrow), struct)


#: Rows from which a step that shuffles takes a table in slices, and how many there are at most.
SLICE_ROWS, SLICES = 1_000_000, 8


def slice_count(rows: int) -> int:
    return max(1, min(SLICES, -(-rows // SLICE_ROWS)))


def in_slice(key: Column, number: int, of: int) -> Column:
    """Whether a row lies in one of some slices of about equal size by a hash of its key; NULL is a key like any other."""
    return F.pmod(F.xxhash64(key), F.lit(of)) == F.lit(number)


def side_by_side(*steps: Callable[[], object]) -> list:
    """Run steps that do not depend on each other at the same time; results in their order.

    Small jobs leave most of a cluster idle, so several may share it.
    """
    inherit = inheritable_thread_target(SparkSession.active())
    with ThreadPoolExecutor(max_workers=len(steps)) as pool:
        running = [pool.submit(inherit(step)) for step in steps]
        return [step.result() for step in running]
