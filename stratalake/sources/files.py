"""Listing and fingerprinting of dropped files."""

from __future__ import annotations

import csv
import gzip
import hashlib
import io
import re
import sys
from collections.abc import Iterator, Sequence

import numpy as np
import pandas as pd
from pyspark import cloudpickle
from pyspark.errors import AnalysisException
from pyspark.sql import Column, DataFrame, SparkSession
from pyspark.sql import functions as F

from stratalake.session import small_frame

# The functions below travel with the task, so executors need no copy of this package.
cloudpickle.register_pickle_by_value(sys.modules[__name__])

LISTING = "file_path string, file_name string, file_size_bytes bigint, file_mtime_utc timestamp_ntz"
FINGERPRINT = f"{LISTING}, file_sha256 string, header array<string>, quoted_breaks boolean, error_message string"

#: Files of a drop: CSV, plain or compressed. Readers of the text tell them apart by the suffix.
PATTERN = "*.{csv,csv.gz}"

_CHUNK = 8 * 1024 * 1024
#: Longest header of a file; a longer one is an error of that file.
HEADER_LIMIT = 1 << 20


def source_path() -> Column:
    """Path of the file a row comes from, with the escapes of the metadata column undone."""
    return F.url_decode(F.replace(F.col("_metadata.file_path"), F.lit("+"), F.lit("%2B")))


def literal_path(path: str) -> str:
    """A path that readers take as it is, even with characters that usually match many."""
    return re.sub(r"([\\\[\]{}*?])", r"\\\1", path)


def existing(spark: SparkSession, paths: Sequence[str]) -> list[str]:
    """Those of some paths that are there."""
    if not paths:
        return []
    hadoop = spark._jvm.org.apache.hadoop.fs
    store = hadoop.Path(paths[0]).getFileSystem(spark._jsc.hadoopConfiguration())
    return [path for path in paths if store.exists(hadoop.Path(path))]


def _listing_columns(files: DataFrame) -> DataFrame:
    return files.select(
        source_path().alias("file_path"),
        F.element_at(F.split(source_path(), "/"), -1).alias("file_name"),
        F.col("length").alias("file_size_bytes"),
        F.col("modificationTime").cast("timestamp_ntz").alias("file_mtime_utc"),
    )


def list_drop(spark: SparkSession, directory: str, pattern: str = PATTERN) -> DataFrame:
    """Files of one directory, not of its sub-directories; empty when there is none.

    The content column is never selected, so no file is opened. The rows keep the partitions
    of the scan, which balance the file sizes; sort by ``file_path`` for display.
    """
    try:
        files = spark.read.format("binaryFile").option("pathGlobFilter", pattern).load(directory)
    except AnalysisException as error:
        if error.getCondition() != "PATH_NOT_FOUND":
            raise
        return small_frame(spark, [], LISTING)
    return _listing_columns(files)


def stream_drop(spark: SparkSession, directory: str, pattern: str = PATTERN,
                max_files: int | None = None) -> DataFrame:
    """The same listing as a stream: each new file arrives once."""
    reader = (
        spark.readStream.format("binaryFile")
        .schema("path string, modificationTime timestamp, length bigint, content binary")
        .option("pathGlobFilter", pattern)
    )
    if max_files is not None:
        reader = reader.option("maxFilesPerTrigger", max_files)
    return _listing_columns(reader.load(directory))


def _open(path: str):
    """A readable stream of the text of a file."""
    stream = _open_bytes(path)
    return gzip.GzipFile(fileobj=stream) if path.endswith(".gz") else stream


def _open_bytes(path: str):
    """A readable stream on a local path or any store that Arrow knows."""
    if path.startswith(("/", "file:")):
        return open("/" + path.removeprefix("file:").lstrip("/"), "rb")
    from pyarrow import fs

    store, inner = fs.FileSystem.from_uri(path)
    return store.open_input_stream(inner, compression=None)


def _read_header(first_bytes: bytes) -> list[str]:
    text = first_bytes.decode("utf-8-sig", errors="replace")
    return next(csv.reader(io.StringIO(text)), [])


class _FirstRecord:
    """The bytes up to the first line break outside quotes, taken in chunk by chunk; each byte is looked at once."""

    def __init__(self):
        self.data, self.complete, self._inside = b"", False, False

    def add(self, chunk: bytes) -> None:
        data = np.frombuffer(chunk[: HEADER_LIMIT + 1], dtype=np.uint8)
        outside = (np.cumsum(data == 0x22) + self._inside) % 2 == 0
        ends = np.flatnonzero(outside & (data == 0x0A))
        self.complete = len(ends) > 0
        self.data += chunk[: ends[0] + 1] if self.complete else chunk[: HEADER_LIMIT + 1]
        if not self.complete:
            self._inside = bool(len(outside)) and not bool(outside[-1])
            if len(self.data) > HEADER_LIMIT:
                raise ValueError(f"the header has no end within {HEADER_LIMIT} bytes; a quote may never be closed")


def _breaks_in_quotes(chunk: bytes, inside: bool) -> tuple[bool, bool]:
    """Whether a line break stands inside quotes in a chunk, and whether the chunk ends inside quotes."""
    data = np.frombuffer(chunk, dtype=np.uint8)
    odd = (np.cumsum(data == 0x22) + inside) % 2 == 1
    return bool((odd & (data == 0x0A)).any()), bool(odd[-1]) if len(data) else inside


def fingerprint_file(path: str) -> tuple[str, list[str], bool]:
    """SHA-256 of the content, read in chunks, the raw header fields, and whether quotes hold line breaks.

    The content of a compressed file is its text, so that it is known with and without compression.
    """
    digest = hashlib.sha256()
    first, inside, breaks = _FirstRecord(), False, False
    with _open(path) as stream:
        while chunk := stream.read(_CHUNK):
            digest.update(chunk)
            found, inside = _breaks_in_quotes(chunk, inside)
            breaks = breaks or found
            if not first.complete:
                first.add(chunk)
    return digest.hexdigest(), _read_header(first.data), breaks


def _fingerprint_batches(batches: Iterator[pd.DataFrame]) -> Iterator[pd.DataFrame]:
    for batch in batches:
        hashes, headers, quoted, errors = [], [], [], []
        for path in batch["file_path"]:
            try:
                sha, fields, breaks = fingerprint_file(path)
                error = None
            except Exception as problem:  # one bad file must not stop the others
                sha, fields, breaks, error = "", [], False, str(problem)
            hashes.append(sha)
            headers.append(fields)
            quoted.append(breaks)
            errors.append(error)
        yield batch.assign(file_sha256=hashes, header=headers, quoted_breaks=quoted, error_message=errors)


def fingerprint(files: DataFrame) -> DataFrame:
    """Hash and header of each listed file, on the executors.

    The listing scan packs files into tasks by size, and one file is one unit of work. A
    file that cannot be read gets an empty hash and its error message.
    """
    return files.mapInPandas(_fingerprint_batches, FINGERPRINT)
