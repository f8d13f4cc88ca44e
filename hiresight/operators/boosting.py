"""Second-order gradient boosting on histograms, depth-wise or leaf-wise.

Features are cut into bins once (all values of a feature with few of them, else
quantiles of a mergeable sketch).  Rows stay in blocks on the executors; a pass
sums the gradients and counts of the wanted tree nodes per (node, feature, bin)
in every block and combines the sums as a tree of tasks, so the driver receives
one table of histograms whose size depends on nodes and bins, not on rows.  Of
two siblings the smaller one is summed, the other is its parent minus that.

A split's gain is  G_l^2 / (H_l + lambda) + G_r^2 / (H_r + lambda) - G^2 / (H + lambda),
halved, less gamma; a leaf's value is -G / (H + lambda).  For squared error the
gradient of a row is its margin minus its label and the hessian is 1.

Depth-wise growth splits every node of a level.  Leaf-wise growth always splits
the leaf of the largest gain until there are ``leaves`` of them: since a node's
gain does not depend on the order of splits, all leaves that the queue would take
with what is known are evaluated in one pass, and the queue is run again.
"""

from __future__ import annotations

import heapq
import sys
from collections.abc import Callable
from dataclasses import dataclass, field

import numpy as np
from pyspark import RDD, StorageLevel, cloudpickle
from pyspark.ml.functions import vector_to_array
from pyspark.sql import DataFrame, SparkSession
from pyspark.sql import functions as F

from ..session import ensure_checkpoint_dir, materialise

#: rows of a block, and rounds after which margins are written down and lineage is cut
BLOCK_ROWS, ROUNDS_KEPT = 65536, 25
#: gains that differ by less than this share count as equal: the order of sums must not decide
EQUAL = 1e-11

# executors need not have this package: its functions travel with the tasks
cloudpickle.register_pickle_by_value(sys.modules[__name__])


@dataclass(frozen=True)
class Spec:
    """Settings of a fit.  leaves None: depth-wise, else leaf-wise with so many leaves at most.

    min_hessian and min_rows hold for both children of a split.  subsample: share
    of rows a round (by hash of the row's number), columns: share of features a
    tree.  importance: ``gain`` (mean gain of a feature's splits) or ``split``
    (their number).
    """

    rounds: int = 200
    depth: int = 7
    rate: float = 0.05
    leaves: int | None = None
    l2: float = 1.0
    gamma: float = 0.0
    min_hessian: float = 1.0
    min_rows: int = 1
    subsample: float = 1.0
    columns: float = 1.0
    bins: int = 256
    importance: str = "gain"
    seed: int = 42


@dataclass
class Node:
    """A node while its tree grows; ``split`` is (gain, feature, bin) or None, ``kids`` its two children."""

    depth: int
    gradient: float
    hessian: float
    hist: np.ndarray | None = None
    split: tuple[float, int, int] | None = None
    kids: tuple[int, int] | None = None
    halves: tuple = ()


@dataclass
class Tree:
    """Nodes in arrays; feature -1 marks a leaf.  A row goes left if its bin is <= ``at`` (its value <= ``cut``)."""

    feature: np.ndarray
    at: np.ndarray
    cut: np.ndarray
    left: np.ndarray
    right: np.ndarray
    value: np.ndarray
    gain: np.ndarray
    order: list[int] = field(default_factory=list)

    def plain(self, limit: str) -> tuple:
        """What a task needs: arrays only, so that no class travels with it."""
        return self.feature, getattr(self, limit), self.left, self.right, self.value


def leaf_of(tree: tuple, rows: np.ndarray) -> np.ndarray:
    """Leaf of each row of bins or values, for a tree of the same kind (``Tree.plain``)."""
    feature, limit, left, right, _ = tree
    node, at = np.zeros(len(rows), np.int64), np.arange(len(rows))
    while True:
        f = feature[node]
        inner = f >= 0
        if not inner.any():
            return node
        goes = rows[at, np.maximum(f, 0)] <= limit[node]
        node = np.where(inner, np.where(goes, left[node], right[node]), node)


def mix(keys: np.ndarray, salt: int) -> np.ndarray:
    """A hash of row numbers, as numbers in [0, 1)."""
    x = keys.astype(np.uint64) + np.uint64((salt * 0x9E3779B97F4A7C15) % 2**64)
    for shift, by in ((30, 0xBF58476D1CE4E5B9), (27, 0x94D049BB133111EB)):
        x = (x ^ (x >> np.uint64(shift))) * np.uint64(by)
    return ((x ^ (x >> np.uint64(31))) >> np.uint64(11)).astype(np.float64) / 2**53


# ------------------------------------------------------------------ bins
def bin_cuts(df: DataFrame, features: int, bins: int = 256, column: str = "x") -> list[np.ndarray]:
    """Ascending cuts of each element of the array column: all its values but the
    largest if there are at most ``bins``, else quantiles of a sketch."""
    x = [F.col(column)[i] for i in range(features)]
    few = df.agg(*[F.approx_count_distinct(c).alias(f"c{i}") for i, c in enumerate(x)]).first()
    probes = [p / bins for p in range(1, bins)]
    some = lambda i: few[f"c{i}"] <= 0.9 * bins
    row = df.agg(*[(F.array_sort(F.collect_set(c)) if some(i) else F.percentile_approx(c, probes, 10_000)).alias(f"c{i}")
                   for i, c in enumerate(x)], *[F.max(c).alias(f"m{i}") for i, c in enumerate(x)]).first()
    out = []
    for i in range(features):
        cuts = np.unique(np.array(row[f"c{i}"] or [], np.float64))
        out.append(cuts[cuts < row[f"m{i}"]] if len(cuts) else cuts)
    return out


def _blocks(df: DataFrame, cuts: list[np.ndarray]) -> RDD:
    """(row numbers, labels, bins, margins) in blocks of bounded size."""
    kind = np.uint8 if max((len(c) for c in cuts), default=0) < 256 else np.uint16

    def run(rows):
        part: list = []

        def block():
            values = np.array([r[2] for r in part], np.float64).reshape(len(part), len(cuts))
            bins = np.stack([np.searchsorted(c, values[:, i], "left") for i, c in enumerate(cuts)], axis=1) if cuts else values
            return (np.array([r[0] for r in part], np.int64), np.array([r[1] for r in part], np.float64), bins.astype(kind), np.zeros(len(part)))

        for r in rows:
            part.append(r)
            if len(part) == BLOCK_ROWS:
                yield block()
                part = []
        if part:
            yield block()

    return df.select("row", "label", "x").rdd.mapPartitions(run)


# ------------------------------------------------------------------ one tree
@dataclass(frozen=True)
class Layout:
    """Where the bins of each feature lie in a histogram row; the last place of ``grid`` is a bin that is always empty."""

    begins: np.ndarray
    cuts: list[np.ndarray]

    @staticmethod
    def of(cuts: list[np.ndarray]) -> "Layout":
        return Layout(np.cumsum([0, *[len(c) + 1 for c in cuts]]), cuts)

    def grid(self) -> np.ndarray:
        """[feature, bin] -> place; bins that a feature doesn't have point to the place after the last."""
        size = np.diff(self.begins)
        b = np.arange(size.max(initial=1))[None, :]
        return np.where(b < size[:, None], self.begins[:-1, None] + b, self.begins[-1])


def best_split(hist: np.ndarray, layout: Layout, allowed: np.ndarray, node: Node, spec: Spec) -> tuple | None:
    """(gain, feature, bin, gradient and hessian of the left side), or None; of equal gains the first feature and bin."""
    if node.depth >= spec.depth or not len(allowed):
        return None
    score = lambda g, h: np.divide(g * g, h + spec.l2, out=np.zeros_like(g), where=h + spec.l2 > 0)
    padded = np.concatenate([hist, np.zeros((2, 1))], axis=1)
    left = np.cumsum(padded[:, layout.grid()[allowed]], axis=2)
    gl, hl = left[0], left[1]
    gr, hr = node.gradient - gl, node.hessian - hl
    last = np.diff(layout.begins)[allowed][:, None] - 1
    ok = (np.arange(gl.shape[1])[None, :] < last) & (np.minimum(hl, hr) >= max(spec.min_hessian, spec.min_rows, 1))
    if not ok.any():
        return None
    own = float(score(np.array([node.gradient]), np.array([node.hessian]))[0])
    gain = np.where(ok, 0.5 * (score(gl, hl) + score(gr, hr) - own) - spec.gamma, -np.inf)
    step = EQUAL * (own + abs(float(gain.max())) + 1e-300)
    f, at = np.unravel_index(int(np.argmax(np.round(gain / step))), gain.shape)
    if gain[f, at] <= max(step, 1e-12):
        return None
    return float(gain[f, at]), int(allowed[f]), int(at), float(gl[f, at]), float(hl[f, at])


def queue(nodes: list[Node], leaves: int | None) -> tuple[list[int], list[int]]:
    """(nodes in the order they are split, those among them without children yet).

    Depth-wise: every node that has a split.  Leaf-wise: the largest gain first
    (the older node among equals), until there are ``leaves`` leaves.
    """
    if leaves is None:
        order = [i for i, n in enumerate(nodes) if n.split]
        return order, [i for i in order if nodes[i].kids is None]
    key = lambda i: (-nodes[i].split[0], i)
    heap, order, count = [key(0)] if nodes[0].split else [], [], 1
    while heap and count < leaves:
        _, i = heapq.heappop(heap)
        order.append(i)
        count += 1
        for k in nodes[i].kids or ():
            if nodes[k].split:
                heapq.heappush(heap, key(k))
    return order, [i for i in order if nodes[i].kids is None]


def grow(sums: Callable[[Tree, list[int]], np.ndarray], layout: Layout, allowed: np.ndarray, spec: Spec) -> Tree:
    """One tree.  sums(tree so far, leaves of it): [leaf, 2, bins] of gradients and hessians."""
    def evaluate(node: Node, hist: np.ndarray) -> None:
        found = best_split(hist, layout, allowed, node, spec)
        node.hist, node.split, node.halves = hist, found and found[:3], found[3:] if found else ()

    cuts = layout.cuts
    first = sums(as_tree([Node(0, 0.0, 0.0)], [], cuts, spec), [0])[0]
    total = first[:, :layout.begins[1]].sum(axis=1)  # every row has one bin of the first feature
    nodes = [Node(0, float(total[0]), float(total[1]))]
    evaluate(nodes[0], first)
    while True:
        order, open_ = queue(nodes, spec.leaves)
        if not open_:
            return as_tree(nodes, order, cuts, spec)
        for i in open_:
            n = nodes[i]
            gl, hl = n.halves
            n.kids = (len(nodes), len(nodes) + 1)
            nodes += [Node(n.depth + 1, gl, hl), Node(n.depth + 1, n.gradient - gl, n.hessian - hl)]
        pairs = [nodes[i].kids for i in open_ if nodes[i].depth + 1 < spec.depth]
        small = [a if nodes[a].hessian <= nodes[b].hessian else b for a, b in pairs]
        if small:
            expanded = [i for i, n in enumerate(nodes) if n.kids]
            found = dict(zip(small, sums(as_tree(nodes, expanded, cuts, spec), small)))
            for i in open_:
                a, b = nodes[i].kids
                hist = found.get(a, found.get(b))
                if hist is not None:
                    other = nodes[i].hist - hist
                    evaluate(nodes[a], hist if a in found else other)
                    evaluate(nodes[b], other if a in found else hist)
        for i in open_:
            nodes[i].hist = None


def as_tree(nodes: list[Node], order: list[int], cuts: list[np.ndarray], spec: Spec) -> Tree:
    """Arrays over all nodes; only those in ``order`` are inner ones."""
    many, inner = len(nodes), set(order)
    tree = Tree(np.full(many, -1), np.zeros(many, np.int64), np.zeros(many), np.zeros(many, np.int64), np.zeros(many, np.int64),
                np.zeros(many), np.zeros(many), list(order))
    for i, n in enumerate(nodes):
        if i in inner:
            tree.gain[i], tree.feature[i], tree.at[i] = n.split
            tree.cut[i] = cuts[n.split[1]][n.split[2]]
            tree.left[i], tree.right[i] = n.kids
        tree.value[i] = -spec.rate * n.gradient / (n.hessian + spec.l2) if n.hessian + spec.l2 > 0 else 0.0
    return tree


def reached(tree: Tree) -> list[int]:
    """Nodes that rows can reach."""
    found, todo = [], [0]
    while todo:
        i = todo.pop()
        found.append(i)
        if tree.feature[i] >= 0:
            todo += [int(tree.left[i]), int(tree.right[i])]
    return sorted(found)


# ------------------------------------------------------------------ fit
def margins(block: tuple, trees: list[tuple]) -> np.ndarray:
    out = block[3].copy()
    for t in trees:
        out += t[4][leaf_of(t, block[2])]
    return out


def block_sums(block: tuple, recent: list[tuple], tree: tuple, leaves: list[int], begins: np.ndarray, base: float, subsample: float, salt: int) -> np.ndarray:
    """[leaf, 2, bins]: gradients and hessians of the rows of a block in the given leaves."""
    keys, label, bins, _ = block
    total = int(begins[-1])
    slot = np.full(len(tree[0]), -1)
    slot[leaves] = np.arange(len(leaves))
    at = slot[leaf_of(tree, bins)]
    use = at >= 0
    if subsample < 1:
        use &= mix(keys, salt) < subsample
    gradient = (base + margins(block, recent) - label)[use]
    place = (at[use] * total)[:, None] + begins[:-1][None, :] + bins[use]
    size = len(leaves) * total
    g = np.bincount(place.ravel(), np.repeat(gradient, bins.shape[1]), size)
    h = np.bincount(place.ravel(), minlength=size)
    return np.stack([g.reshape(len(leaves), total), h.reshape(len(leaves), total)], axis=1)


def fit(train: DataFrame, spec: Spec = Spec(), features_col: str = "features", label_col: str = "label") -> "Boosted":
    """Fit on a vector (or array) column and a label; rows with a null label take no part.

    Without rows every prediction is 0.  The same rows and settings give the same
    trees: row samples are hashes of row numbers that are written with the rows.
    """
    x = F.col(features_col)
    x = x if train.schema[features_col].dataType.typeName() == "array" else vector_to_array(x)
    data = materialise(train.where(F.col(label_col).isNotNull())
                       .select(F.monotonically_increasing_id().alias("row"), F.col(label_col).cast("double").alias("label"), x.alias("x")))
    stats = data.agg(F.avg("label"), F.max(F.size("x"))).first()
    if stats[0] is None:
        return Boosted(0.0, [], 0, spec.importance)
    base, width = float(stats[0]), int(stats[1])
    if not width:
        return Boosted(base, [], 0, spec.importance)
    cuts = bin_cuts(data, width, spec.bins)
    layout = Layout.of(cuts)
    begins = layout.begins
    ensure_checkpoint_dir(train.sparkSession)
    blocks, trees, recent = _blocks(data, cuts).persist(StorageLevel.MEMORY_AND_DISK), [], []
    picks = max(1, round(spec.columns * width))
    try:
        for r in range(spec.rounds):
            allowed = np.sort(np.argsort(mix(np.arange(width), spec.seed * 7_919 + r), kind="stable")[:picks])

            def sums(tree: Tree, leaves: list[int], before=tuple(t.plain("at") for t in recent), salt=spec.seed * 1_000_003 + r) -> np.ndarray:
                now, share = tree.plain("at"), spec.subsample
                return blocks.map(lambda b: block_sums(b, before, now, leaves, begins, base, share, salt)).treeReduce(np.add, 2)

            tree = grow(sums, layout, allowed, spec)
            trees.append(tree)
            recent.append(tree)
            if len(tree.order) == 0 and spec.subsample >= 1 and spec.columns >= 1:
                break  # nothing left to split; further rounds would repeat this one
            if len(recent) == ROUNDS_KEPT and r + 1 < spec.rounds:
                done = tuple(t.plain("at") for t in recent)
                ahead = blocks.map(lambda b: (b[0], b[1], b[2], margins(b, done))).persist(StorageLevel.MEMORY_AND_DISK)
                ahead.checkpoint()
                ahead.count()
                blocks.unpersist()
                blocks, recent = ahead, []
    finally:
        blocks.unpersist()
    return Boosted(base, [compact(t) for t in trees], width, spec.importance)


def compact(tree: Tree) -> Tree:
    """Without nodes that no row reaches, numbered from 0 in order of making."""
    keep = reached(tree)
    new = np.zeros(len(tree.feature), np.int64)
    new[keep] = np.arange(len(keep))
    inner = tree.feature[keep] >= 0
    return Tree(tree.feature[keep], tree.at[keep], tree.cut[keep], np.where(inner, new[tree.left[keep]], 0),
                np.where(inner, new[tree.right[keep]], 0), tree.value[keep], tree.gain[keep], [int(new[i]) for i in tree.order])


NODE_DDL = "tree int, node int, feature int, at long, cut double, left long, right long, value double, gain double, step int"


class Boosted:
    """Fitted trees: base + the sum of the trees' leaf values."""

    def __init__(self, base: float, trees: list[Tree], width: int, importance: str = "gain"):
        self.base, self.trees, self.width, self.importance = base, trees, width, importance

    def values(self, rows: np.ndarray) -> np.ndarray:
        out = np.full(len(rows), self.base)
        for t in self.trees:
            out += t.value[leaf_of(t.plain("cut"), rows)]
        return out

    def transform(self, df: DataFrame, features_col: str = "features", prediction: str = "prediction") -> DataFrame:
        """Adds the prediction, in Arrow batches."""
        x = F.col(features_col)
        x = x if df.schema[features_col].dataType.typeName() == "array" else vector_to_array(x)
        shared, width = df.sparkSession.sparkContext.broadcast((self.base, [t.plain("cut") for t in self.trees])), self.width

        @F.pandas_udf("double")
        def predict(x):
            import pandas as pd

            base, trees = shared.value
            rows = np.stack(x.to_numpy()) if len(x) else np.zeros((0, width))
            out = np.full(len(rows), base)
            for t in trees:
                out += t[4][leaf_of(t, rows)]
            return pd.Series(out)

        return df.withColumn(prediction, predict(x))

    @property
    def importances(self) -> np.ndarray:
        """Shares of the features: by mean gain of their splits, or by number of splits."""
        gain, splits = np.zeros(self.width), np.zeros(self.width)
        for t in self.trees:
            inner = t.feature >= 0
            np.add.at(gain, t.feature[inner], t.gain[inner])
            np.add.at(splits, t.feature[inner], 1)
        found = splits if self.importance == "split" else np.divide(gain, splits, out=np.zeros(self.width), where=splits > 0)
        return found / (found.sum() or 1.0)

    def rows(self) -> list[tuple]:
        step = [{n: s for s, n in enumerate(t.order)} for t in self.trees]
        return [(k, i, int(t.feature[i]), int(t.at[i]), float(t.cut[i]), int(t.left[i]), int(t.right[i]), float(t.value[i]), float(t.gain[i]),
                 step[k].get(i)) for k, t in enumerate(self.trees) for i in range(len(t.feature))]

    def nodes(self, spark: SparkSession) -> DataFrame:
        """One row a node of every tree; step: when the node was split, from 0 (null for leaves)."""
        return spark.createDataFrame(self.rows(), NODE_DDL)

    def save(self, path: str) -> None:
        spark = SparkSession.getActiveSession()
        self.nodes(spark).coalesce(1).write.mode("overwrite").parquet(f"{path}/nodes")
        spark.createDataFrame([(self.base, self.width, self.importance)], "base double, width int, importance string") \
            .coalesce(1).write.mode("overwrite").parquet(f"{path}/model")

    @staticmethod
    def load(spark: SparkSession, path: str) -> "Boosted":
        found: dict[int, list] = {}
        for r in spark.read.parquet(f"{path}/nodes").orderBy("tree", "node").collect():  # one row a node
            found.setdefault(r["tree"], []).append(r)
        col = lambda rows, name: np.array([r[name] for r in rows])
        trees = [Tree(*[col(rows, c) for c in ("feature", "at", "cut", "left", "right", "value", "gain")],
                      [r["node"] for r in sorted((r for r in rows if r["step"] is not None), key=lambda r: r["step"])]) for _, rows in sorted(found.items())]
        head = spark.read.parquet(f"{path}/model").first()
        return Boosted(head["base"], trees, head["width"], head["importance"])
