"""CSV files with line breaks in quotes, read in many splits; compressed files; types that keep every value."""

import csv as python_csv
import gzip
import io
import random
import time

import pytest

from stratalake.sources import csv, files
from stratalake.sources.records import opens, read_records, stays_open, text_lines


@pytest.fixture
def small_splits(spark):
    keys = {"spark.sql.files.maxPartitionBytes": "200", "spark.sql.files.openCostInBytes": "1"}
    before = {k: spark.conf.get(k) for k in keys}
    for k, v in keys.items():
        spark.conf.set(k, v)
    yield
    for k, v in before.items():
        spark.conf.set(k, v)


def written(rows, end="\n"):
    out = io.StringIO()
    python_csv.writer(out, lineterminator=end).writerows(rows)
    return out.getvalue()


@pytest.mark.parametrize("seed, end", [(1, "\n"), (2, "\r\n"), (3, "\n")])
def test_splits_equal_the_whole_file(spark, small_splits, tmp_path, seed, end):
    rng = random.Random(seed)
    cells = ["a", 'say "x"', "line\nbreak", ",", "\n\n", '"', "ü" * 30, "w " * 60 + "\n" + "v " * 150, '","', "x\r\ny"]
    rows = [[f"{k}", *[rng.choice(cells) for _ in range(2)]] for k in range(300)]
    path = tmp_path / "many.csv"
    path.write_bytes(written([["id", "p q", "r"], *rows], end).encode())
    assert text_lines(spark, [str(path)]).select("block").distinct().count() > 50
    got = csv.read_text(spark, str(path))
    assert got.columns == ["id", "p q", "r"]
    assert sorted(map(tuple, got.collect())) == sorted(tuple(r) for r in rows)
    places = read_records(spark, [str(path)]).select("block", "place", "record").collect()
    assert [r.record.split(",")[0] for r in sorted(places)] == [r[0] for r in rows]


def test_lines_as_functions(spark):
    """Both bits of a line against a walk over its characters."""
    def walk(line, inside):
        state = "quoted" if inside else "start"
        k = 0
        while k < len(line):
            c = line[k]
            if state == "quoted":
                if c == '"' and line[k + 1 : k + 2] == '"':
                    k += 1
                elif c == '"':
                    state = "after"
            elif c == ",":
                state = "start"
            elif c == '"' and state == "start":
                state = "quoted"
            else:
                state = "plain" if state != "after" else "after"
            k += 1
        return state == "quoted"

    rng = random.Random(5)
    lines = {"".join(rng.choice('",a\r') for _ in range(rng.randrange(9))) for _ in range(1500)}
    # A quote after a closed quote is no CSV; both readings are allowed there.
    lines = [x for x in lines if not any(bad in f',{p}{x}' for p in ("", '"') for bad in ('"a"', '"\r"'))]
    df = spark.createDataFrame([(x,) for x in lines] + [('"' + 'b""' * 50_000,), ("x," * 20_000 + '"y',)], "line string")
    for r in df.select("line", opens(df.line).alias("o"), stays_open(df.line).alias("s")).collect():
        assert (r.o, r.s) == (walk(r.line, False), walk(r.line, True)), r.line


def test_stray_quotes_and_unclosed_ones(spark, small_splits, tmp_path):
    path = tmp_path / "stray.csv"
    path.write_text('a,b\n1,6" pipe\n2,"two\nlines"\n3,5" and 7"\n' + "".join(f"{k},x\n" for k in range(4, 90)))
    got = {r.a: r.b for r in csv.read_text(spark, str(path)).collect()}
    assert len(got) == 89 and got["1"] == '6" pipe' and got["2"] == "two\nlines" and got["3"] == '5" and 7"'
    (tmp_path / "open.csv").write_text('a,b\n1,"never\n' + "2,x\n" * 2000)
    with pytest.raises(Exception, match="never closed"):
        read_records(spark, [str(tmp_path / "open.csv")], limit=100).collect()


def test_folders_of_compressed_and_plain_files(spark, tmp_path):
    folder = tmp_path / "in"
    folder.mkdir()
    (folder / "a.csv.gz").write_bytes(gzip.compress(b"box,k\n12D,1\n"))
    (folder / "b.csv").write_text("k,box\n2,7F\n")
    (folder / "c.csv.gz").write_bytes(gzip.compress(b'box,k\n"two\nlines",3\n'))
    (folder / "empty.csv").write_text("")
    (folder / "only_header.csv").write_text("﻿box,k\n")
    got = csv.read_text(spark, str(folder))
    assert sorted((r.box, r.k) for r in got.collect()) == [("12D", "1"), ("7F", "2"), ("two\nlines", "3")]
    (tmp_path / "broken header.csv").write_text('"a\nb",c\n1,2\n')
    got = csv.read_text(spark, str(tmp_path / "broken header.csv"))
    assert got.columns == ["a\nb", "c"] and [tuple(r) for r in got.collect()] == [("1", "2")]


def test_types_keep_every_value(spark, tmp_path):
    columns = {
        "suffix": ["12D", "7F"], "long_code": ["12345678901234567891", "1"], "digits": ["12345678901234.123456", "1.5"],
        "nan": ["NaN", "1.5"], "inf": ["Infinity", "2"], "price": ["1.10", "2.5"], "plus": ["+5", "6"], "minus_zero": ["-0", "1"],
        "exp": ["1e5", "2"], "title": ["TRUE", "false"], "hex": ["0x1F", "1"],
        "n": ["9223372036854775807", "-5"], "d": ["0.25", "-1234.5"], "mixed": ["5", "5.5"], "flag": ["true", "false"], "none": ["None", ""],
    }
    path = tmp_path / "codes.csv"
    path.write_text(written([list(columns), *zip(*columns.values())]))
    found = csv.read_inferred(spark, str(path))
    kinds = dict(found.dtypes)
    assert {k for k, v in kinds.items() if v != "string"} == {"n", "d", "mixed", "flag"}
    assert (kinds["n"], kinds["d"], kinds["mixed"], kinds["flag"]) == ("bigint", "double", "double", "boolean")
    got = found.collect()
    for name, values in columns.items():
        if kinds[name] == "string" and name != "none":
            assert [r[name] for r in got] == values


def test_header_scan_is_linear_and_limited(tmp_path):
    path = tmp_path / "stray.csv"
    path.write_bytes(b'a,"b\n' + b"1,2\n" * 2_000_000)
    started = time.time()
    with pytest.raises(ValueError, match="header has no end"):
        files.fingerprint_file(str(path))
    assert time.time() - started < 5
    path.write_bytes(b'"a\nb",c\n' + b"1,2\n" * 3_000_000)
    assert files.fingerprint_file(str(path))[1:] == (["a\nb", "c"], True)
