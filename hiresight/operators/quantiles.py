"""Exact quantiles by range refinement.

An exact percentile aggregate keeps a map of all distinct values, which ends up in
one task.  Here each wanted rank has an open range of values that holds it.  A
mergeable sketch proposes two values around the rank, one pass counts exactly the
rows below, at and between them, and the range shrinks to what lies between, a
few ten-thousandths of its rows; a rank that falls on a proposed value is found.
Ranges with few rows are fetched and sorted.  Nothing holds more than a sketch of
fixed size, or ``LIMIT`` values.
"""

from __future__ import annotations

import math
from dataclasses import dataclass

import numpy as np
from pyspark.sql import Column, DataFrame
from pyspark.sql import functions as F

#: values of one range that may be fetched, and the sketch's accuracy (its rank error is a share of 1 / ACCURACY)
LIMIT, ACCURACY = 65536, 10_000


@dataclass
class Rank:
    """A wanted rank, the open range that holds it, and the rows below and inside the range."""

    rank: int
    below: int
    inside: int
    low: float | None = None
    high: float | None = None
    value: float | None = None

    def holds(self, x: Column) -> Column:
        test = F.lit(True)
        if self.low is not None:
            test = test & (x > F.lit(self.low))
        if self.high is not None:
            test = test & (x < F.lit(self.high))
        return test

    def shares(self) -> list[float]:
        """The ranks, as shares of the rows inside, that a sketch is asked for."""
        at, slack = (self.rank - self.below) / max(1, self.inside - 1), 2 / ACCURACY
        return [max(0.0, at - slack), min(1.0, at + slack)]

    def narrow(self, low: float, high: float, counts: list[int]) -> None:
        """counts: rows inside that are < low, <= low, < high, <= high."""
        under, to_low, under_high, to_high = (self.below + c for c in counts)
        if self.rank < under:
            self.inside, self.high = under - self.below, low
        elif self.rank < to_low:
            self.value = low
        elif self.rank >= to_high:
            self.inside, self.below, self.low = self.inside - (to_high - self.below), to_high, high
        elif self.rank >= under_high:
            self.value = high
        else:
            self.below, self.inside, self.low, self.high = to_low, under_high - to_low, low, high


def order_statistics(df: DataFrame, col: str, n: int, ranks: list[int], limit: int = LIMIT) -> dict[int, float]:
    """The values at the given ranks (from 0) among the ``n`` non-null values of the column."""
    x = F.col("x")
    values = df.select(F.col(f"`{col}`").cast("double").alias("x")).where("x is not null")
    todo = [Rank(r, 0, n) for r in sorted(set(ranks))]
    found: dict[int, float] = {}
    while todo:
        wide = [r for r in todo if r.inside > limit]
        if wide:
            at = values.agg(*[F.percentile_approx(F.when(r.holds(x), x), r.shares(), ACCURACY).alias(f"q{i}") for i, r in enumerate(wide)]).first()
            tests = [test for i, r in enumerate(wide) for test in (x < at[i][0], x <= at[i][0], x < at[i][1], x <= at[i][1])]
            counts = values.agg(*[F.count_if(wide[i // 4].holds(x) & t).alias(f"c{i}") for i, t in enumerate(tests)]).first()
            for i, r in enumerate(wide):
                r.narrow(float(at[i][0]), float(at[i][1]), list(counts[4 * i:4 * i + 4]))
        for r in [r for r in todo if r.value is None and r.inside <= limit]:
            inside = np.sort(np.array([v[0] for v in values.where(r.holds(x)).collect()], np.float64))  # ``limit`` values at most
            for other in todo:
                if other.value is None and (other.low, other.high) == (r.low, r.high):
                    other.value = float(inside[other.rank - other.below])
        found |= {r.rank: r.value for r in todo if r.value is not None}
        todo = [r for r in todo if r.value is None]
    return found


def exact_quantiles(df: DataFrame, col: str, shares: list[float], limit: int = LIMIT) -> list[float | None]:
    """Linearly interpolated quantiles of a column; None for each if it has no values.

    Nulls are left out; NaN counts as the largest value.  Jobs run at once and read
    the column three times or more, so ``df`` should be a stored table.
    """
    n = df.select(F.count(f"`{col}`")).first()[0]
    if not n:
        return [None] * len(shares)
    places = [s * (n - 1) for s in shares]
    found = order_statistics(df, col, n, [f(p) for p in places for f in (math.floor, math.ceil)], limit)
    out = []
    for p in places:
        i, j = math.floor(p), math.ceil(p)
        same = i == j or found[i] == found[j]
        out.append(found[i] if same else (j - p) * found[i] + (p - i) * found[j])
    return out
