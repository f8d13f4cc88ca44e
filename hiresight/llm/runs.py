"""First row of every run of equal keys, over range-partitioned, sorted rows.

``first_of_run`` deals (k1, k2, doc, tie) rows by ranges of (k1, k2, doc), so a
hot key spans as many partitions as its rows need, sorts within partitions, and
streams: each row learns the first row of its run in this partition.  Only the
first row of a partition's first run is open (its run may have begun in an
earlier partition); it is settled from summary rows, two a partition at most.
"""

from __future__ import annotations

from collections.abc import Iterator

import numpy as np
import pyarrow as pa
from pyspark.sql import DataFrame
from pyspark.sql import functions as F

from hiresight.llm.common import arrow_schema, batch, session_of, stage

SETTLED, SUMMARY = 0, 1
COLUMNS = ["k1", "k2", "doc", "tie", "payload"]


def _stream(batches: Iterator[pa.RecordBatch]) -> Iterator[pa.RecordBatch]:
    """All rows but the first of each run, and the first rows of the first and the last run as SUMMARY."""
    schema = arrow_schema({"kind": pa.int32()} | {c: pa.int64() for c in COLUMNS} | {"first_doc": pa.int64(), "first_tie": pa.int64()})
    names = [f.name for f in schema]
    key = first = opening = None  # of the last row seen; first row of the first run
    runs = 0
    for b in batches:
        n = b.num_rows
        if not n:
            continue
        cols = [b.column(i).to_numpy() for i in range(5)]
        k1, k2, doc, tie, _ = cols
        new = np.ones(n, bool)
        new[1:] = (k1[1:] != k1[:-1]) | (k2[1:] != k2[:-1])
        new[0] = key is None or (int(k1[0]), int(k2[0])) != key
        at = np.flatnonzero(new)
        starts = np.concatenate([[-1], at])[np.cumsum(new)]  # -1: goes on from the last batch
        f_doc, f_tie = doc[starts], tie[starts]
        if starts[0] < 0:
            f_doc, f_tie = np.where(starts < 0, first[2], f_doc), np.where(starts < 0, first[3], f_tie)
        keep = ~new
        if keep.any():
            yield batch(schema, kind=np.zeros(keep.sum(), np.int32), **dict(zip(COLUMNS, (c[keep] for c in cols))),
                        first_doc=f_doc[keep], first_tie=f_tie[keep])
        runs += len(at)
        if len(at):
            first = [int(c[at[-1]]) for c in cols]
            if opening is None:
                opening = [int(c[at[0]]) for c in cols]
        key = (int(k1[-1]), int(k2[-1]))
    if runs:
        ends = [opening] if runs == 1 else [opening, first]
        yield batch(schema, **{c: [r[i] for r in ends] for i, c in enumerate(COLUMNS)},
                    **{names[0]: [SUMMARY] * len(ends), "first_doc": [r[2] for r in ends], "first_tie": [r[3] for r in ends]})


def first_of_run(rows: DataFrame, name: str) -> tuple[DataFrame, DataFrame]:
    """Rows (k1, k2, doc, tie, payload: longs, no nulls) that aren't the first of
    their key by (doc, tie), with (first_doc, first_tie) of an earlier row: the
    earliest in their range partition, or the earliest of all.

    And, as (doc, first_doc), the docs that stand first in a partition but not
    of all, for the few keys that span partitions."""
    session_of(rows)
    order = ["k1", "k2", "doc"]
    ddl = "kind int, " + ", ".join(f"{c} long" for c in [*COLUMNS, "first_doc", "first_tie"])
    runs = stage(rows.select(COLUMNS).repartitionByRange(*order).sortWithinPartitions(*order, "tie").mapInArrow(_stream, ddl), name)
    ends = runs.where(F.col("kind") == SUMMARY).drop("kind", "first_doc", "first_tie")  # at most two rows a partition
    first = (ends.groupBy("k1", "k2").agg(F.min(F.struct("doc", "tie")).alias("f"))
             .select("k1", "k2", F.col("f.doc").alias("first_doc"), F.col("f.tie").alias("first_tie")))
    later = stage(ends.join(first, ["k1", "k2"]).where((F.col("doc") != F.col("first_doc")) | (F.col("tie") != F.col("first_tie"))), f"{name}-later")
    settled = runs.where(F.col("kind") == SETTLED).drop("kind")
    return settled.unionByName(later), later.select("doc", "first_doc").where("doc <> first_doc").distinct()
