"""Line dedup by range-partitioned hashes and streamed first occurrences.

Lines become (128-bit key, document, position) rows; the text itself is not
sorted.  The rows are range-partitioned by (key, document) and sorted by key,
then document (largest first) and position, so a task streams over the runs of
equal keys and sees the occurrence that stays first.  A hot line's run spans as
many partitions as its rows need: a partition's first and last run are settled
from a small table of run summaries.  The result is a compressed bitmap of kept
lines per document that loses a line; texts are rewritten from it.
"""

from __future__ import annotations

import hashlib
import zlib
from collections.abc import Iterator

import numpy as np
import pyarrow as pa
from pyspark.sql import DataFrame
from pyspark.sql import functions as F

from hiresight.llm.common import arrow_schema, batch, session_of, stage, wider

SPACE = b" \t\n\x0b\x0c\r"
LINE = {"k1": pa.int64(), "k2": pa.int64(), "doc": pa.int64(), "text_key": pa.int64(), "pos": pa.int32(), "n_lines": pa.int32()}
LINE_DDL = "k1 long, k2 long, doc long, text_key long, pos int, n_lines int"
DROP, OPEN, SUMMARY = 0, 1, 2


def line_key(line: bytes) -> bytes:
    """The line without white space at both ends and with A-Z lower-cased."""
    return line.strip(SPACE).lower()


def code_points(s: bytes) -> int:
    return len(s) if s.isascii() else len(s.decode("utf-8"))


def _lines(min_chars: int):
    schema = arrow_schema(LINE)

    def run(batches: Iterator[pa.RecordBatch]) -> Iterator[pa.RecordBatch]:
        for b in batches:
            out: dict[str, list] = {n: [] for n in LINE}
            digests = []
            for doc, raw, tkey in zip(*(b.column(i).to_pylist() for i in range(3))):
                lines = raw.split(b"\n")
                for pos, line in enumerate(lines):
                    if len(line) < min_chars or len(key := line_key(line)) < min_chars or code_points(key) < min_chars:
                        continue
                    digests.append(hashlib.blake2b(key, digest_size=16).digest())
                    out["doc"].append(doc)
                    out["text_key"].append(tkey)
                    out["pos"].append(pos)
                    out["n_lines"].append(len(lines))
            if digests:
                k = np.frombuffer(b"".join(digests), "<i8").reshape(-1, 2)
                out["k1"], out["k2"] = k[:, 0], k[:, 1]
                yield batch(schema, **out)

    return run


def _runs(min_docs: int):
    """Stream over sorted rows; see DROP (settled), OPEN (a run that may go on
    in another partition) and SUMMARY (documents and largest id of such a run)."""
    names = ["kind", "k1", "k2", "doc", "text_key", "pos", "n_lines", "n_docs"]
    schema = arrow_schema({"kind": pa.int32()} | LINE | {"n_docs": pa.int64()})

    def run(batches: Iterator[pa.RecordBatch]) -> Iterator[pa.RecordBatch]:
        out: dict[str, list] = {n: [] for n in names}

        def emit(kind, key, doc, tkey, pos, n_lines, n_docs=None):
            for n, v in zip(names, (kind, *key, doc, tkey, pos, n_lines, n_docs)):
                out[n].append(v)

        key = last = top = None
        runs, docs, held = 0, 0, []
        for b in batches:
            for k1, k2, doc, tkey, pos, n_lines in zip(*(b.column(i).to_pylist() for i in range(6))):
                if (k1, k2) != key:
                    if runs == 1:  # the first run may have begun in an earlier partition
                        emit(SUMMARY, key, top, None, None, None, docs)
                    key, top, last, runs, docs, held = (k1, k2), doc, doc, runs + 1, 1, []
                elif doc != last:
                    last, docs = doc, docs + 1
                row = (key, doc, tkey, pos, n_lines)
                if runs == 1:
                    emit(OPEN, *row)
                elif docs >= min_docs:
                    for x in held:
                        emit(DROP, *x)
                    held = []
                    if docs > 1:
                        emit(DROP, *row)
                elif docs > 1:
                    held.append(row)
            if len(out["kind"]) >= 4096:
                yield batch(schema, **out)
                out = {n: [] for n in names}
        if runs:  # the last run may go on in a later partition
            for x in held:
                emit(OPEN, *x)
            emit(SUMMARY, key, top, None, None, None, docs)
        if out["kind"]:
            yield batch(schema, **out)

    return run


def _bitmap(batches: Iterator[pa.RecordBatch]) -> Iterator[pa.RecordBatch]:
    schema = arrow_schema({"doc": pa.int64(), "text_key": pa.int64(), "n_lines": pa.int32(), "keep_bitmap": pa.binary()})
    for b in batches:
        packed = []
        for n, dropped in zip(b.column(2).to_pylist(), b.column(3).to_pylist()):
            keep = np.ones(n, bool)
            keep[dropped] = False
            packed.append(zlib.compress(np.packbits(keep).tobytes()))
        if packed:
            yield batch(schema, doc=b.column(0), text_key=b.column(1), n_lines=b.column(2), keep_bitmap=packed)


def line_keep_bitmaps(docs: DataFrame, id_col: str = "doc_id", text_col: str = "text",
                      min_chars: int = 40, min_docs: int = 5) -> DataFrame:
    """(doc, text_key, n_lines, keep_bitmap) of every document that loses a line.

    A key of at least ``min_chars`` code points that occurs in at least
    ``min_docs`` documents loses its lines in all of them but the one with the
    largest id.  ``keep_bitmap``: zlib of one bit a line (numpy.packbits), set
    for lines that stay; ``text_key`` is xxhash64 of the text, so that rows
    with the same id and different texts have bitmaps of their own.

    Rows with the same id count as one document; rows with a null id together
    as one with the smallest id.  Null text is one empty line.
    """
    session_of(docs)
    text = F.coalesce(F.col(text_col), F.lit(""))
    order = ["k1", "k2", F.col("doc").desc_nulls_last()]
    lines = (docs.select(F.col(id_col).cast("long").alias("doc"), text.cast("binary").alias("raw"), F.xxhash64(text).alias("text_key"))
             .mapInArrow(_lines(min_chars), LINE_DDL))
    runs = stage(lines.repartitionByRange(*order).sortWithinPartitions(*order, "text_key", "pos")
                 .mapInArrow(_runs(min_docs), f"kind int, {LINE_DDL}, n_docs long"), "line-runs")
    # at most two rows a partition
    whole = (runs.where(F.col("kind") == SUMMARY).groupBy("k1", "k2")
             .agg(F.sum("n_docs").alias("total"), F.max("doc").alias("top")).where(F.col("total") >= min_docs))
    settled = runs.where(F.col("kind") == DROP).select("doc", "text_key", "pos", "n_lines")
    # broadcast, so that the open rows of a hot line stay where they are
    opened = (runs.where(F.col("kind") == OPEN).join(F.broadcast(whole), ["k1", "k2"]).where(~F.col("doc").eqNullSafe(F.col("top")))
              .select("doc", "text_key", "pos", "n_lines"))
    return (settled.unionByName(opened).groupBy("doc", "text_key")
            .agg(F.max("n_lines").alias("n_lines"), F.collect_set("pos").alias("dropped"))
            .mapInArrow(_bitmap, "doc long, text_key long, n_lines int, keep_bitmap binary"))


def _apply(text_at: int):
    def run(batches: Iterator[pa.RecordBatch]) -> Iterator[pa.RecordBatch]:
        for b in batches:
            t = pa.Table.from_batches([b])
            texts, total, gone = [], [], []
            for text, bitmap in zip(t.column(text_at).to_pylist(), t.column("__keep_bitmap").to_pylist()):
                lines = (text or "").split("\n")
                if bitmap is None:
                    texts.append(text)
                    gone.append(0)
                else:
                    keep = np.unpackbits(np.frombuffer(zlib.decompress(bitmap), np.uint8), count=len(lines))
                    kept = [x for x, k in zip(lines, keep) if k]
                    texts.append("\n".join(kept))
                    gone.append(len(lines) - len(kept))
                total.append(len(lines))
            t = t.set_column(text_at, t.schema.field(text_at).name, pa.array(texts, pa.string())).drop_columns(["__keep_bitmap"])
            t = t.append_column("__n_lines", pa.array(total, pa.int64())).append_column("__n_dropped", pa.array(gone, pa.int64()))
            yield from t.to_batches()

    return run


def apply_keep_bitmaps(docs: DataFrame, bitmaps: DataFrame, id_col: str = "doc_id", text_col: str = "text") -> DataFrame:
    """All rows and columns of ``docs`` with the dropped lines gone from the
    text, and ``__n_lines`` (before), ``__n_dropped``.  Null text stays null.

    The bitmaps are the build side: texts are streamed, never sorted."""
    b = bitmaps.select(F.col("doc").alias("__doc"), F.col("text_key").alias("__text_key"), F.col("keep_bitmap").alias("__keep_bitmap"))
    on = (F.col(id_col).cast("long").eqNullSafe(F.col("__doc"))
          & (F.xxhash64(F.coalesce(F.col(text_col), F.lit(""))) == F.col("__text_key")))
    joined = docs.join(b.hint("shuffle_hash"), on, "left").select(*docs.columns, "__keep_bitmap")
    out = wider(docs.schema, __n_lines="long", __n_dropped="long")
    return joined.mapInArrow(_apply(docs.columns.index(text_col)), out)
