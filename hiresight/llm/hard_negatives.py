"""Hard negatives by Fagin's threshold algorithm.

Anchors meet all vectors in a grid of blocks: a cell holds one block of
candidates and one block of anchors, both of bounded size, and is one group of a
cogroup.  In a cell every dimension has its list of candidates sorted by
component.  For an anchor the lists are read from the end that its sign in the
dimension favours; rows met are scored by random access, in integers, and reading
stops once the threshold (the score of a row with the last components read) lies
strictly below the kth score of each of the anchor's windows.

The first grid finds each anchor's positives (one window without bounds over the
rows of its label); the second finds, for each positive, the best rows of other
labels inside the window that the positive's score opens.  Blocks return their k
best; the k best of those are the k best of all.
"""

from __future__ import annotations

import math

import numpy as np
import pyarrow as pa
from pyspark.sql import DataFrame, Window
from pyspark.sql import functions as F

from hiresight.llm.common import arrow_schema, session_of, stage

#: rows of a candidate block and of an anchor block, on average
BLOCK_ROWS = 16384
LONG = 2**63 - 1


class SortedLists:
    """One block of candidates with a sorted list for each dimension.

    Rows are in order of id, so that among equal scores the first row comes first.
    """

    def __init__(self, ids: np.ndarray, labels: np.ndarray, rows: np.ndarray):
        by_id = np.argsort(ids, kind="stable")
        self.ids, self.labels, self.rows = ids[by_id], labels[by_id], rows[by_id]
        self.order = np.ascontiguousarray(np.argsort(self.rows, axis=0, kind="stable").T.astype(np.int32))
        self.most = max((abs(int(f())) for f in (rows.max, rows.min)), default=0) if rows.size else 0

    def exact(self, anchors_most: int) -> np.ndarray:
        """The rows in a type whose inner products with the anchors are exact."""
        bound = self.rows.shape[1] * max(1, self.most) * max(1, anchors_most)
        return self.rows.astype(np.float32 if bound < 2**24 else np.float64 if bound < 2**53 else object)

    def search(self, rows: np.ndarray, anchor: np.ndarray, eligible, windows: list[tuple[float, float]], k: int) -> list[list[tuple[int, int]]]:
        """For each window (lowest, highest score) its k best (score, row) among
        the rows that ``eligible`` (rows -> mask) lets in, best first."""
        many = len(self.ids)
        up, down = np.flatnonzero(anchor > 0), np.flatnonzero(anchor < 0)
        dims, exact = np.concatenate([up, down]), anchor.astype(rows.dtype)
        seen = np.zeros(many, bool)
        found: list[list[tuple[int, int]]] = [[] for _ in windows]
        depth, step = 0, max(16, many // 64)
        while depth < many:
            upto = min(many, depth + step)
            met = np.zeros(many, bool)
            met[self.order[up, many - upto:many - depth]] = True
            met[self.order[down, depth:upto]] = True
            if not len(dims):  # an anchor of zeros: all rows score 0
                met[:] = True
            new = np.flatnonzero(met & ~seen)
            seen |= met
            new = new[eligible(new)]
            if len(new):
                scores = rows[new] @ exact
                for w, (low, high) in enumerate(windows):
                    inside = np.flatnonzero((scores >= low) & (scores <= high))
                    if len(inside) > k:  # rows below the kth best score can't enter
                        s = scores[inside]
                        inside = inside[s >= (np.partition(s, len(s) - k)[-k] if s.dtype != object else sorted(s)[-k])]
                    more = [(int(scores[i]), int(new[i])) for i in inside]
                    found[w] = sorted(found[w] + more, key=lambda x: (-x[0], x[1]))[:k]
            depth, step = upto, 2 * step
            if seen.all():
                break
            last = np.concatenate([self.order[up, many - depth], self.order[down, depth - 1]])
            threshold = sum(int(a) * int(x) for a, x in zip(anchor[dims], self.rows[last, dims]))
            if all(threshold < (f[-1][0] if len(f) == k else low) for f, (low, _) in zip(found, windows)):
                break
        return found


def _matrix(column: pa.ChunkedArray, dims: int) -> np.ndarray:
    """Lists of integers as rows of a matrix; shorter ones end in zeros."""
    lists = column.combine_chunks() if isinstance(column, pa.ChunkedArray) else column
    out = np.zeros((len(lists), dims), np.int64)
    sizes = lists.value_lengths().to_numpy(zero_copy_only=False)
    at = np.repeat(np.arange(len(lists)), sizes), np.arange(sizes.sum()) - np.repeat(np.cumsum(sizes) - sizes, sizes)
    out[at] = lists.flatten().to_numpy(zero_copy_only=False)
    return out


def _lists(table: pa.Table, dims: int) -> SortedLists:
    return SortedLists(table["id"].to_numpy(), table["label"].to_numpy(), _matrix(table["vector"], dims))


def _table(schema: pa.Schema, out: list[tuple]) -> pa.Table:
    columns = list(zip(*out)) or [()] * len(schema)
    clamp = lambda c: [max(-LONG - 1, min(LONG, int(v))) for v in c]
    return pa.table([pa.array(clamp(c), f.type) for c, f in zip(columns, schema)], schema=schema)


def _positives(dims: int, k: int):
    schema = arrow_schema({"anchor_id": pa.int64(), "positive_id": pa.int64(), "positive_score": pa.int64()})

    def run(candidates: pa.Table, anchors: pa.Table) -> pa.Table:
        out: list[tuple] = []
        if len(candidates) and len(anchors):
            lists, vectors = _lists(candidates, dims), _matrix(anchors["vector"], dims)
            rows = lists.exact(int(np.abs(vectors).max(initial=0)))
            for anchor, label, vector in zip(anchors["id"].to_pylist(), anchors["label"].to_pylist(), vectors):
                mine = lambda new, a=anchor, lab=label: (lists.labels[new] == lab) & (lists.ids[new] != a)
                found = lists.search(rows, vector, mine, [(-math.inf, math.inf)], k)[0]
                out.extend((anchor, lists.ids[i], s) for s, i in found)
        return _table(schema, out)

    return run


def _negatives(dims: int, k: int, low: int, high: int):
    schema = arrow_schema({n: pa.int64() for n in ("anchor_id", "positive_id", "positive_score", "negative_id", "negative_score")})

    def run(candidates: pa.Table, anchors: pa.Table) -> pa.Table:
        out: list[tuple] = []
        if len(candidates) and len(anchors):
            lists, vectors = _lists(candidates, dims), _matrix(anchors["vector"], dims)
            rows = lists.exact(int(np.abs(vectors).max(initial=0)))
            for anchor, label, vector, own in zip(anchors["id"].to_pylist(), anchors["label"].to_pylist(), vectors, anchors["positives"].to_pylist()):
                windows = {s: (-((-low * s) // 100), (high * s) // 100) for s in sorted({p["positive_score"] for p in own})}
                windows = {s: w for s, w in windows.items() if w[0] <= w[1]}
                other = lambda new, lab=label: lists.labels[new] != lab
                found = dict(zip(windows, lists.search(rows, vector, other, list(windows.values()), k))) if windows else {}
                out.extend((anchor, p["positive_id"], p["positive_score"], lists.ids[i], s)
                           for p in own for s, i in found.get(p["positive_score"], ()))
        return _table(schema, out)

    return run


def _grid(points: DataFrame, anchors: DataFrame, rows: int, asked: int, block_rows: int, f, ddl: str) -> DataFrame:
    """``f`` on every cell of candidate blocks x anchor blocks."""
    across, down = max(1, math.ceil(rows / block_rows)), max(1, math.ceil(asked / block_rows))
    block = lambda n, salt: F.pmod(F.xxhash64("id", F.lit(salt)), F.lit(n)).cast("int")
    every = lambda n: F.explode(F.sequence(F.lit(0), F.lit(n - 1)))
    left = points.select("id", "label", "vector", block(across, 1).alias("c")).select("*", every(down).alias("a"))
    right = anchors.select("*", block(down, 2).alias("a")).select("*", every(across).alias("c"))
    return left.groupBy("c", "a").cogroup(right.groupBy("c", "a")).applyInArrow(f, ddl)


def hard_negatives(vectors: DataFrame, anchor: str = "vec_id % 50 = 0", id_col: str = "vec_id", vector_col: str = "embedding",
                   label_col: str = "label", scale: int = 256, positives: int = 5, negatives: int = 3, low: int = 50, high: int = 95,
                   block_rows: int = BLOCK_ROWS) -> DataFrame:
    """anchor_id, positive_id, rank, negative_id, positive_score, negative_score.

    anchor: SQL condition on id_col that marks the anchors.  An anchor's positives
    are its first ``positives`` other rows of the same label; for each, the first
    ``negatives`` rows of other labels whose score lies in ``low`` to ``high``
    percent of the positive's score.  Scores are inner products of
    floor(scale * component); higher ones come first, ties by smaller id.

    Rows with a null id, label, vector or component, or with a component that is
    not finite, take no part.  Of rows that repeat an id one takes part: the one
    with the smallest label, then the smallest vector.  Vectors of other lengths
    end in zeros.  Components and scores outside of 64 bits count as the nearest
    64-bit number.  Anchors without positives, positives without negatives and
    empty tables give no rows.  Other columns are not looked at.
    """
    session_of(vectors)
    x = F.col(vector_col).cast("array<double>")
    finite = F.forall(x, lambda v: v.isNotNull() & (F.abs(v) < F.lit(math.inf)))
    taken = vectors.select(F.col(id_col).cast("long").alias("id"), F.col(label_col).cast("long").alias("label"), x.alias("x"),
                           F.coalesce(finite, F.lit(False)).alias("ok")).where("id is not null and label is not null and ok")
    points = stage(taken.select("id", F.struct("label", F.transform("x", lambda v: F.floor(v * scale)).alias("vector")).alias("p"))
                   .groupBy("id").agg(F.min("p").alias("p")).select("id", "p.label", "p.vector"), "vectors")
    anchors = points.where(anchor.replace(id_col, "id"))
    size = points.agg(F.count(F.lit(1)), F.max(F.size("vector")), F.count(F.when(F.expr(anchor.replace(id_col, "id")), 1))).first()
    rows, dims, asked = size[0], size[1] or 0, size[2]

    first = lambda n, *by: (lambda w: lambda d: d.withColumn("rank", F.row_number().over(w)).where(F.col("rank") <= n))(
        Window.partitionBy(*by[:-2]).orderBy(F.desc(by[-1]), F.asc(by[-2])))
    near = _grid(points, anchors, rows, asked, block_rows, _positives(dims, positives), "anchor_id long, positive_id long, positive_score long")
    near = first(positives, "anchor_id", "positive_id", "positive_score")(near)
    own = near.groupBy("anchor_id").agg(F.collect_list(F.struct("positive_id", "positive_score")).alias("positives"))  # at most ``positives`` an anchor
    opened = stage(anchors.join(own, F.col("id") == F.col("anchor_id")).select("id", "label", "vector", "positives"), "windows")
    far = _grid(points, opened, rows, asked, block_rows, _negatives(dims, negatives, low, high),
                "anchor_id long, positive_id long, positive_score long, negative_id long, negative_score long")
    return first(negatives, "anchor_id", "positive_id", "negative_id", "negative_score")(far).select(
        "anchor_id", "positive_id", "rank", "negative_id", "positive_score", "negative_score")
