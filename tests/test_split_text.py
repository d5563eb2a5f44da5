"""Delimited files read by many tasks give what one task gives."""

from __future__ import annotations

import os
import random
import tempfile

import pytest
from pyspark.sql import functions as F
from pyspark.sql import types as T

from circulation.session import scratch_path
from circulation.sinks import write_delimited
from circulation.sources import read_delimited, read_split_delimited
from conftest import plan_text, rows

SCHEMA = T.StructType([T.StructField("n", T.LongType()), T.StructField("s", T.StringType()), T.StructField("t", T.StringType())])


def _file(text: str) -> str:
    path = os.path.join(tempfile.mkdtemp(prefix="circ-split-"), "part.csv")
    with open(path, "w", newline="") as f:
        f.write(text)
    return path


@pytest.fixture
def small_splits(spark):
    names = ("spark.sql.files.maxPartitionBytes", "spark.sql.files.openCostInBytes")
    old = [spark.conf.get(n) for n in names]
    spark.conf.set(names[0], "700")
    spark.conf.set(names[1], "1")
    yield
    for n, v in zip(names, old):
        spark.conf.set(n, v)


def _awkward(n: int) -> list[tuple]:
    rng = random.Random(n)
    bits = ["a", "|", '"', '""', "\n", "\r\n", "\\", " ", "é", "word", "\n\n", ",", '"\n"']
    out = [(i, "".join(rng.choice(bits) for _ in range(rng.randrange(12))), rng.choice(["x", " y ", "", None])) for i in range(n)]
    return out + [(n, "line\n" * 900 + '"', "over many splits"), (n + 1, None, None), (None, "", "end\n")]


def test_one_file_is_read_by_many_tasks_and_gives_the_same_rows(spark, small_splits):
    data = _awkward(700)
    path = scratch_path(spark, "split")
    write_delimited(spark.createDataFrame(data, SCHEMA).coalesce(1), path)
    lines = spark.read.option("lineSep", "\n").text(path)
    assert lines.rdd.getNumPartitions() > 20
    got = rows(read_split_delimited(spark, path, SCHEMA))
    assert got == rows(read_delimited(spark, path, SCHEMA))
    assert got == sorted(((n, s or "", t or "") for n, s, t in data), key=repr)


@pytest.mark.parametrize("size", [64, 1000])
def test_split_ends_at_any_place(spark, small_splits, size):
    # Quotes, line ends and separators fall on, before and after the ends of splits.
    data = [(i, ("q\"\n" if i % 3 else "|") * (i % 7), "z" * (i % 5)) for i in range(size)]
    text = "n|s|t\n" + "".join(f'{n}|"{s.replace(chr(34), chr(34) * 2)}"|{t}\n' for n, s, t in data)
    path = _file(text)
    for part in (61, 97, 128):
        spark.conf.set("spark.sql.files.maxPartitionBytes", str(part))
        assert rows(read_split_delimited(spark, path, SCHEMA)) == sorted(data, key=repr)


def test_line_ends_headers_and_empty_files(spark, small_splits):
    crlf = _file('n|s|t\r\n1|"a\r\nb"|c\r\n\r\n2|d|e')
    assert rows(read_split_delimited(spark, crlf, SCHEMA)) == [(1, "a\r\nb", "c"), (2, "d", "e")]
    long_header = _file('n|"s\nin two lines"|t\n3|f|g\n')
    both = rows(read_split_delimited(spark, [crlf, long_header], SCHEMA))
    assert both == [(1, "a\r\nb", "c"), (2, "d", "e"), (3, "f", "g")]
    assert rows(read_split_delimited(spark, [_file(""), _file("n|s|t\n"), _file("n|s|t")], SCHEMA)) == []


def test_bad_files_fail(spark, small_splits):
    with pytest.raises(Exception, match="quotes are not balanced in .*part.csv"):
        read_split_delimited(spark, _file('n|s|t\n1|"open|x\n2|a|b\n'), SCHEMA).collect()
    with pytest.raises(Exception, match="(?i)malformed"):
        read_split_delimited(spark, _file("n|s|t\nnot a number|a|b\n"), SCHEMA).collect()


def test_plan_shuffles_the_lines_once(spark, small_splits):
    path = scratch_path(spark, "split-plan")
    write_delimited(spark.createDataFrame(_awkward(50), SCHEMA).coalesce(1), path)
    df = read_split_delimited(spark, path, SCHEMA)
    df.collect()
    plan = plan_text(df).split("Initial Plan")[0]
    # The text is scanned for its lines and for the counts of its splits; the lines' exchange is used again.
    assert plan.count("FileScan text") == 2 and "ReusedExchange" in plan
    assert "BatchEvalPython" not in plan and "ArrowEvalPython" not in plan and "CartesianProduct" not in plan
    assert df.agg(F.count("n")).first()[0] == 52
