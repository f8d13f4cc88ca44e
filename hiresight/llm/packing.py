"""Sequence packing by non-negative least squares on the length histogram.

A document's ids (and an end id) are cut into full windows and one tail.  The
histogram of tail lengths is bounded by the window, so planning takes the same
time at any scale: all combinations of up to three lengths that fill a window
exactly are enumerated, their repeat counts solved by non-negative least
squares, rounded down to what the histogram holds, and the residual lengths
packed greedily (best fit); what a greedy combination would leave too empty is
laid end to end and cut at the window.  Pieces find their place by rank within
their length: no piece list, only counts, reaches the driver.
"""

from __future__ import annotations

import zlib
from collections.abc import Iterator

import numpy as np
import pyarrow as pa
from pyspark.sql import DataFrame, Window
from pyspark.sql import functions as F

from hiresight.llm.common import arrow_schema, batch, session_of, stage, task_id
from hiresight.llm.tokens import encoder

PIECE = {"uid": pa.int64(), "part": pa.int64(), "local_rank": pa.int64(), "doc_id": pa.int64(), "start": pa.int64(),
         "length": pa.int32(), "doc_tokens": pa.int64(), "ids_crc32": pa.int64(), "ids": pa.binary()}
PIECE_DDL = "uid long, part long, local_rank long, doc_id long, start long, length int, doc_tokens long, ids_crc32 long, ids binary"
PLACED_DDL = "uid long, doc_id long, start long, length long, doc_tokens long, ids_crc32 long, sequence_id long, offset long, cut int"
END_ID = 0


def _cut(path: str, window: int):
    schema = arrow_schema(PIECE)

    def run(batches: Iterator[pa.RecordBatch]) -> Iterator[pa.RecordBatch]:
        enc, part = encoder(path, False), task_id()
        rank, n = [0] * (window + 1), 0
        end = END_ID.to_bytes(4, "little")
        for b in batches:
            out: dict[str, list] = {k: [] for k in PIECE}
            for doc, text in zip(b.column(0).to_pylist(), b.column(1).to_pylist()):
                ids = enc.encode(text) + end
                total = len(ids) // 4
                for start in range(0, total, window):
                    piece = ids[4 * start:4 * (start + window)]
                    size = len(piece) // 4
                    row = (part << 40 | n, part, rank[size], doc, start, size, total, zlib.crc32(piece), piece if size < window else None)
                    rank[size] += 1
                    n += 1
                    for k, v in zip(PIECE, row):
                        out[k].append(v)
            if out["uid"]:
                yield batch(schema, **out)

    return run


def combinations(lengths: np.ndarray, window: int, depth: int = 3) -> np.ndarray:
    """All multisets of up to ``depth`` (at most 3) lengths that sum to ``window``, as rows padded with 0."""
    have = np.zeros(window + 1, bool)
    have[lengths] = True
    rows = []
    if have[window]:
        rows.append(np.array([[window, 0, 0]]))
    ls = np.sort(lengths[lengths < window])
    if depth >= 2 and len(ls):
        a = ls[2 * ls >= window]
        a = a[have[window - a]]
        rows.append(np.stack([a, window - a, 0 * a], 1))
    if depth >= 3 and len(ls):
        a, b = (x.ravel() for x in np.meshgrid(ls, ls, indexing="ij"))
        c = window - a - b
        ok = (a >= b) & (c > 0) & (b >= c)
        a, b, c = a[ok], b[ok], c[ok]
        ok = have[c]
        rows.append(np.stack([a[ok], b[ok], c[ok]], 1))
    return np.concatenate(rows) if rows else np.zeros((0, 3), int)


def nnls(combos: np.ndarray, counts: np.ndarray, steps: int = 400) -> np.ndarray:
    """Repeat counts x >= 0 minimising |A x - counts|^2, A[l, s] = times length l is in combination s.

    Accelerated projected gradient; A has at most three entries a column and is never built."""
    n, scale = len(counts), max(1.0, float(counts.max(initial=1)))
    h, x = counts / scale, np.zeros(len(combos))
    if not len(combos):
        return x
    real = combos > 0

    def forward(v):
        return sum(np.bincount(combos[:, j], v * real[:, j], n) for j in range(combos.shape[1]))

    def backward(r):
        return sum(r[combos[:, j]] * real[:, j] for j in range(combos.shape[1]))

    v = np.ones(len(combos))
    for _ in range(30):  # largest eigenvalue of A'A
        v = backward(forward(v))
        top = np.linalg.norm(v)
        v /= top
    y, t = x.copy(), 1.0
    for _ in range(steps):
        new = np.maximum(0, y - backward(forward(y) - h) / (1.02 * top))
        t, old = (1 + np.sqrt(1 + 4 * t * t)) / 2, t
        y, x = new + (old - 1) / t * (new - x), new
    return x * scale


def plan(histogram: dict[int, int], window: int, least_fill: float = 0.99) -> tuple[list[tuple[tuple[int, ...], int]], dict[int, int]]:
    """((lengths of a sequence), repeats) and, per length, how many pieces go to the tape."""
    left = np.zeros(window + 1, np.int64)
    for size, n in histogram.items():
        left[size] = n
    found: list[tuple[tuple[int, ...], int]] = []

    def take(combo: tuple[int, ...], most: int) -> int:
        n = min(most, *(left[c] // combo.count(c) for c in set(combo)))
        if n > 0:
            for c in combo:
                left[c] -= n
            found.append((combo, int(n)))
        return n

    take((window,), int(left[window]))
    combos = combinations(np.flatnonzero(left), window)
    repeats = np.floor(nnls(combos, left.astype(float)) + 1e-9).astype(np.int64)
    for s in np.argsort(-repeats, kind="stable"):
        if repeats[s] <= 0:
            break
        take(tuple(int(c) for c in combos[s] if c), int(repeats[s]))
    tape: dict[int, int] = {}
    while left.any():  # best fit: longest first, filled with the longest that still fit
        rest, space, combo = left.copy(), window, []
        while space and (fits := np.flatnonzero(rest[:space + 1])).size:
            size = int(fits[-1])
            n = int(min(rest[size], space // size)) if len(combo) else 1
            combo += [size] * n
            rest[size] -= n
            space -= size * n
        if window - space >= least_fill * window:
            take(tuple(combo), int(left.max()))
        else:  # its longest length can't be filled well with what is left
            tape[combo[0]] = tape.get(combo[0], 0) + int(left[combo[0]])
            left[combo[0]] = 0
    return found, tape


def slots(found, tape, window: int) -> dict[int, tuple[np.ndarray, np.ndarray, np.ndarray, np.ndarray]]:
    """Per length: first rank, first sequence (or tape position), offset, and 1 for the tape, by rank range."""
    table: dict[int, list] = {}
    used: dict[int, int] = {}
    seq = 0
    for combo, n in found:
        offset = 0
        for size in combo:
            table.setdefault(size, []).append((used.get(size, 0), seq, offset, 0))
            used[size] = used.get(size, 0) + n
            offset += size
        seq += n
    at = seq * window
    for size in sorted(tape, reverse=True):
        table.setdefault(size, []).append((used.get(size, 0), at, 0, 1))
        at += size * tape[size]
    return {k: tuple(np.array(c, np.int64) for c in zip(*v)) for k, v in table.items()}


def _place(table, window: int):
    schema = arrow_schema({"uid": pa.int64(), "doc_id": pa.int64(), "start": pa.int64(), "length": pa.int64(), "doc_tokens": pa.int64(),
                           "ids_crc32": pa.int64(), "sequence_id": pa.int64(), "offset": pa.int64(), "cut": pa.int32()})

    def run(batches: Iterator[pa.RecordBatch]) -> Iterator[pa.RecordBatch]:
        for b in batches:
            size, rank = b.column("length").to_numpy(), b.column("rank").to_numpy()
            seq, offset = np.empty(len(rank), np.int64), np.empty(len(rank), np.int64)
            for s in np.unique(size):
                m = size == s
                first, base, off, on_tape = table[int(s)]
                k = np.searchsorted(first, rank[m], side="right") - 1
                step = rank[m] - first[k]
                at = base[k] + step * s
                seq[m] = np.where(on_tape[k] == 1, at // window, base[k] + step)
                offset[m] = np.where(on_tape[k] == 1, at % window, off[k])
            cut = np.where(offset + size > window, window - offset, 0)
            yield batch(schema, **{c: b.column(c) for c in ("uid", "doc_id", "start", "doc_tokens", "ids_crc32")},
                        length=size.astype(np.int64), sequence_id=seq, offset=offset, cut=cut.astype(np.int32))

    return run


def _split(batches: Iterator[pa.RecordBatch]) -> Iterator[pa.RecordBatch]:
    """Pieces that cross the end of a window, as two pieces."""
    names = ("doc_id", "start", "length", "ids_crc32", "doc_tokens", "sequence_id", "offset")
    schema = arrow_schema({n: pa.int64() for n in names})
    for b in batches:
        out: dict[str, list] = {n: [] for n in names}
        for r in b.to_pylist():
            a, z = r["ids"][:4 * r["cut"]], r["ids"][4 * r["cut"]:]
            for start, ids, seq, offset in ((r["start"], a, r["sequence_id"], r["offset"]), (r["start"] + r["cut"], z, r["sequence_id"] + 1, 0)):
                for n, v in zip(names, (r["doc_id"], start, len(ids) // 4, zlib.crc32(ids), r["doc_tokens"], seq, offset)):
                    out[n].append(v)
        if out["doc_id"]:
            yield batch(schema, **out)


def pack(docs: DataFrame, tokenizer_path: str, window: int = 1024, id_col: str = "doc_id", text_col: str = "text") -> DataFrame:
    """One row per piece: doc_id, start, length, ids_crc32, doc_tokens, sequence_id, offset.

    Every id (the text's ids and the end id) lies in exactly one piece; a
    sequence's pieces lie gapless from offset 0 and never exceed ``window``.
    Sequences that aren't cut from the tape are filled to ``least_fill`` of
    ``plan`` at least.  Null or empty text is the end id alone.  Null or
    repeated ids are packed like any other row; an empty table gives an empty
    result; other columns are ignored.

    The pieces are written once to the shared folder with their ids, which are
    read again only for pieces that the tape cuts.
    """
    session_of(docs)
    pieces = stage(docs.select(F.col(id_col).cast("long").alias("doc_id"), F.coalesce(F.col(text_col), F.lit("")).alias("text"))
                   .mapInArrow(_cut(tokenizer_path, window), PIECE_DDL), "pieces")
    counts = pieces.groupBy("part", "length").agg(F.count("*").alias("n"))
    histogram = {r[0]: r[1] for r in pieces.groupBy("length").count().collect()}  # at most ``window`` rows
    table = slots(*plan(histogram, window), window)
    before = Window.partitionBy("length").orderBy("part").rowsBetween(Window.unboundedPreceding, -1)
    ranks = counts.select("part", "length", F.coalesce(F.sum("n").over(before), F.lit(0)).alias("before"))
    placed = (pieces.drop("ids").join(ranks, ["part", "length"]).withColumn("rank", F.col("before") + F.col("local_rank"))
              .mapInArrow(_place(table, window), PLACED_DDL))
    columns = ["doc_id", "start", "length", "ids_crc32", "doc_tokens", "sequence_id", "offset"]
    cut = (placed.where("cut > 0").select("uid", "doc_id", "start", "doc_tokens", "sequence_id", "offset", "cut")
           .join(pieces.select("uid", "ids"), "uid").mapInArrow(_split, ", ".join(f"{c} long" for c in columns)))
    return placed.where("cut = 0").select(columns).unionByName(cut)
