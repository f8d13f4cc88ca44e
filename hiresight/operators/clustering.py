"""K-means with k-means++ seeding by weighted hash draws, all restarts side by side.

A uniform draw is the row with the smallest hash number u; a draw in proportion to
weights w is the row with the smallest -ln(1 - u) / w.  So seeds are aggregates of
one pass each.  A Lloyd step sums points by (restart, nearest centre) in each task
and adds the sums: nothing depends on how rows are split, and another engine
recomputes the same labels.  Only centres (restarts x k x features numbers) are fetched.
"""

from __future__ import annotations

import sys
from collections.abc import Iterator
from functools import reduce

import numpy as np
import pyarrow as pa
from pyspark import cloudpickle
from pyspark.sql import Column, DataFrame
from pyspark.sql import functions as F

from .sampling import hash_uniform

# executors need not have this package: its functions travel with the tasks
cloudpickle.register_pickle_by_value(sys.modules[__name__])

#: centres that move less than this have converged
TOLERANCE, MOST_STEPS = 1e-9, 300


def _distance(z: list[Column], centre) -> Column:
    return reduce(lambda a, b: a + b, [(x - F.lit(float(v))) * (x - F.lit(float(v))) for x, v in zip(z, centre)])


def _nearest(z: list[Column], centres) -> Column:
    """struct(d, c): squared distance and number of the nearest centre, the first among equals."""
    return F.array_min(F.array(*[F.struct(_distance(z, c).alias("d"), F.lit(i).alias("c")) for i, c in enumerate(centres)]))


def seeds(points: DataFrame, z: list[str], k: int, restarts: list[int], id_col: str) -> dict[int, list[tuple]]:
    """k-means++ centres of each restart.  With fewer different points than ``k`` there are fewer centres."""
    cols = [F.col(c) for c in z]
    chosen: dict[int, list[tuple]] = {r: [] for r in restarts}
    for s in range(k):
        alive = restarts if s == 0 else [r for r in restarts if chosen[r]]
        aggs = []
        for r in alive:
            u = hash_uniform(F.concat_ws(":", F.col(id_col).cast("string"), F.lit(r), F.lit(s)))
            if s == 0:
                key = u
            else:
                d = _nearest(cols, chosen[r])["d"]
                key = F.when(d > 0, -F.log(1 - u) / d)
            aggs.append(F.min(F.when(key.isNotNull(), F.struct(key.alias("key"), F.col(id_col).alias("id"), *cols))).alias(f"r{r}"))
        if not aggs:
            break
        row = points.agg(*aggs).first()  # a struct a restart
        for r in alive:
            if row[f"r{r}"] is not None:
                chosen[r].append(tuple(row[f"r{r}"][c] for c in z))
    return chosen


def _sums(centres: dict[int, list[tuple]], features: int):
    """Rows, coordinate sums and cost of each (restart, nearest centre) of a task's points."""
    schema = pa.schema([("r", pa.int64()), ("c", pa.int64()), ("n", pa.float64()), ("d", pa.float64()), *[(f"s{i}", pa.float64()) for i in range(features)]])

    def run(batches: Iterator[pa.RecordBatch]) -> Iterator[pa.RecordBatch]:
        total = {r: np.zeros((len(c), 2 + features)) for r, c in centres.items()}
        for b in batches:
            x = np.stack([col.to_numpy(zero_copy_only=False) for col in b.columns], axis=1)
            for r, c in centres.items():
                d = ((x[:, None, :] - np.array(c)[None, :, :]) ** 2).sum(2)
                near = d.argmin(1)
                for i, column in enumerate([np.ones(len(x)), d[np.arange(len(x)), near], *x.T]):
                    total[r][:, i] += np.bincount(near, column, len(c))
        rows = [(r, i, *t) for r, ts in total.items() for i, t in enumerate(ts.tolist()) if t[0]]
        if rows:
            yield pa.RecordBatch.from_arrays([pa.array(v, f.type) for v, f in zip(zip(*rows), schema)], schema=schema)

    return run


def kmeans(points: DataFrame, z: list[str], k: int, restarts: list[int], id_col: str = "post_id") -> tuple[list[tuple], float] | None:
    """(centres, cost) of the restart with the least cost, the first among equals; None without rows.

    ``points`` is read once for each seed and step: pass a stored or persisted table."""
    centres = {r: c for r, c in seeds(points, z, k, restarts, id_col).items() if c}
    if not centres:
        return None
    narrow, sums = points.select(*[F.col(c).cast("double") for c in z]), [f"s{i}" for i in range(len(z))]
    ddl = "r long, c long, n double, d double, " + ", ".join(f"{s} double" for s in sums)
    cost: dict[int, float] = {}
    moving = list(centres)
    for _ in range(MOST_STEPS):
        parts = narrow.mapInArrow(_sums({r: centres[r] for r in moving}, len(z)), ddl)
        found = {(x["r"], x["c"]): x for x in parts.groupBy("r", "c").agg(*[F.sum(c).alias(c) for c in ("n", "d", *sums)]).collect()}  # a row a centre
        still = []
        for r in moving:
            new = [tuple(found[r, i][s] / found[r, i]["n"] for s in sums) if (r, i) in found else old for i, old in enumerate(centres[r])]
            cost[r] = sum(x["d"] for (q, _), x in found.items() if q == r)
            if max(abs(a - b) for x, y in zip(new, centres[r]) for a, b in zip(x, y)) > TOLERANCE:
                still.append(r)
            centres[r] = new
        moving = still
        if not moving:
            break
    best = min(centres, key=lambda r: (round(cost[r], 6), r))
    return centres[best], cost[best]


def label(z: list[str], centres: list[tuple]) -> Column:
    """The number of the nearest centre."""
    return _nearest([F.col(c) for c in z], centres)["c"]
