"""Records of CSV files whose quotes hold line breaks, read by as many tasks as the file has splits.

Whether a line ends inside quotes depends on whether it began inside, so a line is a function of one bit, and so is
a split: the composition of its lines. One pass over two bits a line gives the function of every split; composed over the
splits of a file, they say how each split begins. A second pass cuts the lines of each split to whole records and the
pieces at its edges, and the pieces, at most two a split, are put together.
"""

from __future__ import annotations

from collections.abc import Sequence

import pyarrow as pa
from pyspark.sql import Column, DataFrame, SparkSession, Window
from pyspark.sql import functions as F

from stratalake.session import materialize, small_frame
from stratalake.sources.files import literal_path, source_path

#: Splits of one job; it bounds the table of how splits begin. A file beyond it makes a job of its own.
SPLITS_PER_JOB = 100_000
#: Characters of one record; beyond that a quote of the file was never closed.
RECORD_LIMIT = 64 * 1024 * 1024

# A line that begins outside quotes and ends inside: fields, quoted or not, and then an opened quote. Possessive, so that it never goes back.
_FIELD = r'(?:"[^"]*+(?:""[^"]*+)*+"[^,"]*+|[^,"][^,]*+)?+'
_OPENS = rf'^(?:{_FIELD},)*+"[^"]*+(?:""[^"]*+)*+$'

_WHOLE, _HEAD, _REST = 0, 1, 2
#: Place of the first record of a file, its header.
_HEADER = -1


def opens(line: Column) -> Column:
    """Whether a line that begins outside quotes ends inside."""
    return F.contains(line, F.lit('"')) & line.rlike(_OPENS)


def stays_open(line: Column) -> Column:
    """Whether a line that begins inside quotes ends inside: the same as if it began with its opening quote."""
    return ~F.contains(line, F.lit('"')) | F.concat(F.lit('"'), line).rlike(_OPENS)


def text_lines(spark: SparkSession, paths: Sequence[str]) -> DataFrame:
    """(file, block, line) of files, compressed ones by their suffix; a carriage return before the break stays."""
    lines = spark.read.option("lineSep", "\n").text(list(paths))
    return lines.select(source_path().alias("file"), F.col("_metadata.file_block_start").alias("block"), F.col("value").alias("line"))


def _compose(batches):
    """The function of each split: where it leads from outside and from inside quotes."""
    key, outside, inside = None, False, True
    for batch in batches:
        found = []
        for file, block, opened, open_still in zip(*[c.to_pylist() for c in batch.columns]):
            if (file, block) != key:
                if key is not None:
                    found.append((*key, outside, inside))
                key, outside, inside = (file, block), False, True
            outside = open_still if outside else opened
            inside = open_still if inside else opened
        yield _batch(found)
    if key is not None:
        yield _batch([(*key, outside, inside)])


def _batch(rows: list[tuple]) -> pa.RecordBatch:
    columns = list(zip(*rows)) or [()] * 4
    kinds = [pa.string(), pa.int64(), pa.bool_(), pa.bool_()]
    return pa.RecordBatch.from_arrays([pa.array(list(c), k) for c, k in zip(columns, kinds)], names=["file", "block", "outside", "inside"])


def _starts(spark: SparkSession, lines: DataFrame) -> DataFrame:
    """(file, block, inside): how each split begins, from the functions of those before it; a row a split."""
    splits = lines.select("file", "block", opens(F.col("line")).alias("opened"), stays_open(F.col("line")).alias("still"))
    found = splits.mapInArrow(_compose, "file string, block bigint, outside boolean, inside boolean").collect()
    rows, file, state = [], None, False
    for row in sorted(found, key=lambda r: (r["file"], r["block"])):
        if row["file"] != file:
            file, state = row["file"], False
        rows.append((file, row["block"], state))
        state = row["inside"] if state else row["outside"]
    return small_frame(spark, rows, "file string, block bigint, begins_inside boolean")


def _cut(limit: int):
    """Whole records of each split, and the pieces at its edges."""
    def work(batches):
        key, state, place, parts, size, kind, header = None, False, 0, [], 0, _WHOLE, False
        for batch in batches:
            out: list[tuple] = []

            def give(this_kind):
                nonlocal place, header
                text = "\n".join(parts)
                if this_kind == _WHOLE:
                    text = text.removesuffix("\r")
                if text or this_kind != _WHOLE:
                    out.append((*key, _HEADER if header else place, this_kind, text))
                    header = False
                place += 1
                parts.clear()

            for file, block, line, opened, still, begins in zip(*[c.to_pylist() for c in batch.columns]):
                if (file, block) != key:
                    if key is not None and parts:
                        give(_HEAD if kind == _WHOLE else _REST)
                    if begins is None:
                        raise RuntimeError(f"the splits of {file} changed while it was read; read it again")
                    key, state, place, size, header = (file, block), begins, 0, 0, block == 0
                    kind = _REST if begins else _WHOLE
                parts.append(line)
                size += len(line)
                if size > limit:
                    raise ValueError(f"{file}: a quote before byte {block} or after it is never closed")
                state = still if state else opened
                if not state:
                    give(kind)
                    kind, size = _WHOLE, 0
            yield _records(out)
        if key is not None and parts:
            yield _records([(*key, _HEADER if header else place, _HEAD if kind == _WHOLE else _REST, "\n".join(parts))])

    return work


def _records(rows: list[tuple]) -> pa.RecordBatch:
    columns = list(zip(*rows)) or [()] * 5
    kinds = [pa.string(), pa.int64(), pa.int64(), pa.int32(), pa.string()]
    return pa.RecordBatch.from_arrays([pa.array(list(c), k) for c, k in zip(columns, kinds)], names=["file", "block", "place", "kind", "record"])


def read_records(spark: SparkSession, files: Sequence[str], limit: int = RECORD_LIMIT) -> DataFrame:
    """(file, block, place, record): the records of CSV files after their header, numbered by where they begin."""
    lines = text_lines(spark, [literal_path(f) for f in files])
    # The sides are split alike, since both read the same files; a split that the table lacks stops the job.
    starts = F.broadcast(_starts(spark, lines))
    bits = lines.select("file", "block", "line", opens(F.col("line")).alias("opened"), stays_open(F.col("line")).alias("still"))
    cut = bits.join(starts, ["file", "block"], "left").select("file", "block", "line", "opened", "still", "begins_inside")
    cut = materialize(cut.mapInArrow(_cut(limit), "file string, block bigint, place bigint, kind int, record string"), "records")
    in_file = Window.partitionBy("file").orderBy("block", "place")
    pieces = cut.where(F.col("kind") != _WHOLE).withColumn("number", F.sum((F.col("kind") == _HEAD).cast("int")).over(in_file))
    joined = pieces.groupBy("file", "number").agg(
        F.min(F.struct("block", "place")).alias("at"), F.sort_array(F.collect_list(F.struct("block", "place", "record"))).alias("parts"))
    joined = joined.select("file", "at.block", "at.place", F.array_join(F.transform("parts", lambda p: p["record"]), "\n").alias("record"))
    joined = joined.withColumn("record", F.regexp_replace("record", r"\r\z", ""))
    return cut.where(F.col("kind") == _WHOLE).drop("kind").union(joined).where(F.col("place") != _HEADER)
