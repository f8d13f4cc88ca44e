"""Quoted CSV with line breaks inside fields, read in parallel.

A multi-line CSV reader takes a file in one task, since a line break may lie
inside quotes.  Here files are read as lines, in splits of any size.  A first pass
counts the quotes of each split; whether a split begins inside quotes is the
parity of all quotes before it, a prefix sum over one number a split.  With that
known, every split finds its first true record end by itself: it passes on the
records that lie in it, and the pieces of records at its two ends, which are put
together over as many splits as a record spans.
"""

from __future__ import annotations

import sys
from collections.abc import Iterator

import pyarrow as pa
from pyspark import cloudpickle
from pyspark.sql import DataFrame, SparkSession, Window
from pyspark.sql import functions as F
from pyspark.sql import types as T

# executors need not have this package: its functions travel with the tasks
cloudpickle.register_pickle_by_value(sys.modules[__name__])

#: kinds of pieces: a whole record, the end of one, its beginning, its middle
WHOLE, END, BEGIN, MIDDLE = range(4)
PIECE_DDL = "file string, block long, kind int, first boolean, value string"


def split_lines(spark: SparkSession, path: str) -> DataFrame:
    """(file, block, value): the lines of the files; ``block`` is where the split of a line begins.

    Inside a partition the lines of a split are adjacent and in order."""
    return spark.read.option("lineSep", "\n").text(path).select(
        F.col("_metadata.file_path").alias("file"), F.col("_metadata.file_block_start").alias("block"), "value")


def open_splits(lines: DataFrame) -> set[tuple[str, int]]:
    """(file, block) of the splits that begin inside quotes: one bit a split, as many as the driver plans tasks for."""
    quotes = F.length("value") - F.length(F.replace(F.col("value"), F.lit('"'), F.lit("")))
    odd = lines.groupBy("file", "block").agg((F.sum(quotes) % 2).alias("odd"))
    before = Window.partitionBy("file").orderBy("block").rowsBetween(Window.unboundedPreceding, -1)
    return {(r["file"], r["block"]) for r in odd.withColumn("open", F.sum("odd").over(before) % 2).where("open = 1").select("file", "block").collect()}


class Pieces:
    """Cuts the lines of one split after another into records and pieces of records."""

    def __init__(self, opened: set[tuple[str, int]]):
        self.opened, self.split, self.held, self.inside, self.begun, self.first = opened, None, [], False, True, False

    def end(self) -> Iterator[tuple]:
        """The piece that is left when a split ends."""
        if self.held and self.split:
            kind = BEGIN if self.begun else MIDDLE
            yield (*self.split, kind, self.first and self.begun, "\n".join(self.held))
        self.held = []

    def feed(self, file: str, block: int, line: str) -> Iterator[tuple]:
        if (file, block) != self.split:
            yield from self.end()
            self.split, self.inside = (file, block), (file, block) in self.opened
            self.begun, self.first = not self.inside, block == 0
        odd = line.count('"') % 2
        if not self.inside and not odd:
            if not self.held:  # most lines: a record of one line
                yield (file, block, WHOLE, self.first, line)
                self.first = False
                return
        self.held.append(line)
        self.inside ^= bool(odd)
        if not self.inside:
            yield (file, block, WHOLE if self.begun else END, self.first and self.begun, "\n".join(self.held))
            self.first = self.first and not self.begun
            self.held, self.begun = [], True


def _cut(opened: set[tuple[str, int]], whole: bool):
    schema = pa.schema([("file", pa.string()), ("block", pa.int64()), ("kind", pa.int32()), ("first", pa.bool_()), ("value", pa.string())])

    def run(batches: Iterator[pa.RecordBatch]) -> Iterator[pa.RecordBatch]:
        pieces = Pieces(opened)

        def batch(rows: list[tuple]) -> pa.RecordBatch:
            return pa.RecordBatch.from_arrays([pa.array(c, f.type) for c, f in zip(zip(*rows), schema)], schema=schema)

        for b in batches:
            rows = [p for line in zip(*(c.to_pylist() for c in b.columns)) for p in pieces.feed(*line) if (p[2] == WHOLE) == whole]
            if rows:
                yield batch(rows)
        rows = [p for p in pieces.end() if (p[2] == WHOLE) == whole]
        if rows:
            yield batch(rows)

    return run


def csv_records(spark: SparkSession, path: str, header: bool = True) -> DataFrame:
    """(value): the text of each record; files are cut at their true record ends.

    Quotes stand around fields or doubled inside them.  With ``header`` the first
    record of each file is left out; blank records are, too.  A record that is
    still open where its file ends is returned as it is."""
    lines = split_lines(spark, path)
    opened = open_splits(lines)
    whole = lines.mapInArrow(_cut(opened, True), PIECE_DDL)
    ends = lines.mapInArrow(_cut(opened, False), PIECE_DDL)  # two pieces a split at most
    order = Window.partitionBy("file").orderBy("block", F.when(F.col("kind") == END, 0).otherwise(1))
    joined = (ends.withColumn("number", F.sum(F.when(F.col("kind") == BEGIN, 1).otherwise(0)).over(order))
              .groupBy("file", "number").agg(F.max("first").alias("first"), F.array_join(F.transform(
                  F.array_sort(F.collect_list(F.struct("block", "value"))), lambda p: p["value"]), "\n").alias("value")))
    found = whole.select("first", "value").unionByName(joined.select("first", "value"))
    if header:
        found = found.where(~F.col("first"))
    value = F.regexp_replace(F.regexp_replace("value", "\r$", ""), "^\ufeff", "")
    return found.select(value.alias("value")).where(~F.col("value").rlike("^[ \t]*$"))


def read_quoted_csv(spark: SparkSession, path: str, schema: T.StructType, header: bool = True) -> DataFrame:
    """The records of a folder or file of quoted CSV as columns of string type, in as many tasks as there are splits."""
    parsed = F.from_csv("value", _ddl(schema), {"quote": '"', "escape": '"', "mode": "PERMISSIVE"})
    return csv_records(spark, path, header).select(parsed.alias("r")).select("r.*")


def _ddl(schema: T.StructType) -> str:
    return ", ".join(f"`{f.name}` {f.dataType.simpleString()}" for f in schema.fields)
