"""Quoted CSV in many splits against the reader that takes a file in one task."""

import random
from collections import Counter

import pytest

from hiresight.sources.feeds import RAW_SCHEMA, read_raw_csv, scratch_path, to_raw_record, write_raw_csv
from hiresight.sources.split_csv import csv_records, read_quoted_csv, split_lines
from pyspark.sql import types as T

SCHEMA = T.StructType([T.StructField(c, T.StringType()) for c in ("a", "b b", "c")])


def quoted(rng, n, newline="\n"):
    cell = lambda: "".join(rng.choice(["x", "é", "漢", '""', "\n", ",", " ", '""""', "\n\n", "y,"]) for _ in range(rng.randrange(7)))
    rows = [",".join(f'"{cell()}"' if rng.random() < 0.8 else rng.choice(["plain", "", "1"]) for _ in range(3)) for _ in range(n)]
    return newline.join(['"a","b b","c"', *(r for r in rows if r.strip(', "'))]) + newline


def plain_read(spark, path, header=True):
    return spark.read.schema(SCHEMA).option("header", header).option("multiLine", True).option("quote", '"').option("escape", '"').csv(path)


@pytest.fixture
def split_size(spark):
    old = {k: spark.conf.get(k) for k in ("spark.sql.files.maxPartitionBytes", "spark.sql.files.openCostInBytes")}

    def set_(n):
        spark.conf.set("spark.sql.files.maxPartitionBytes", n)
        spark.conf.set("spark.sql.files.openCostInBytes", 1)

    yield set_
    for k, v in old.items():
        spark.conf.set(k, v)


@pytest.mark.parametrize("size", [7, 8, 9, 16, 61, 100_000])
def test_any_split_equals_the_single_task_read(spark, tmp_path, split_size, size):
    rng = random.Random(size)
    for k in range(2):
        (tmp_path / f"f{k}.csv").write_text(quoted(rng, 25), encoding="utf-8", newline="")
    want = Counter(map(tuple, plain_read(spark, str(tmp_path)).collect()))
    split_size(size)
    got = read_quoted_csv(spark, str(tmp_path), SCHEMA)
    if size < 20:
        assert split_lines(spark, str(tmp_path)).rdd.getNumPartitions() > 20
    assert Counter(map(tuple, got.collect())) == want and sum(want.values()) > 30


def test_every_cut_of_one_record(spark, tmp_path, split_size):
    """Line breaks and doubled quotes at every cut, records over many splits."""
    text = '"h","h","h"\n"one ""quoted""\n\nline","two\n""\n","three"\n"a","b","c"\n'
    (tmp_path / "f.csv").write_text(text, newline="")
    want = [("one \"quoted\"\n\nline", 'two\n"\n', "three"), ("a", "b", "c")]
    for size in range(1, len(text) + 2, 3):
        split_size(size)
        assert sorted(map(tuple, read_quoted_csv(spark, str(tmp_path), SCHEMA).collect())) == sorted(want), size


def test_edges(spark, tmp_path, split_size):
    (tmp_path / "crlf.csv").write_text('\ufeff"h","h","h"\r\n"1","2","3"\r\n\r\n"4","5","6"', encoding="utf-8", newline="")
    (tmp_path / "empty.csv").write_text("")
    (tmp_path / "header.csv").write_text('"h","h","h"\n')
    (tmp_path / "open.csv").write_text('"h","h","h"\n"7","8","never closed\n')
    for size in (6, 1000):
        split_size(size)
        got = [r.value for r in csv_records(spark, str(tmp_path)).collect()]
        assert sorted(got) == ['"1","2","3"', '"4","5","6"', '"7","8","never closed']
        assert len(csv_records(spark, str(tmp_path), header=False).collect()) == 6


def test_feeds_with_and_without_splits(spark, split_size):
    df = spark.createDataFrame([(i, f'Title "{i}"', f"line\nbreak {i}" * (i % 4), "City, or not") for i in range(60)],
                               "post_id int, title string, job_description string, city_raw string")
    path = scratch_path(spark, "feed")
    write_raw_csv(df.repartition(2), path)
    want = Counter(tuple(v or "" for v in r) for r in to_raw_record(df).collect())
    for size in (50, 1 << 20):
        split_size(size)
        got = read_raw_csv(spark, path)
        assert got.schema == RAW_SCHEMA and Counter(tuple(v or "" for v in r) for r in got.collect()) == want
