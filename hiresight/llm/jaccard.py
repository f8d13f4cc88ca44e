"""Jaccard join of word n-gram sets with signature trees.

Sets are collapsed by digest.  An exact prefix filter finds who must meet: under
any global order of shingles, two sets with Jaccard similarity t share at least
l of their first n - ceil(t n) + l shingles.  It is used twice.  First (l = 1)
with an order that begins with the shingles of a hash range that no other set
has: a set with enough of those has a prefix of its own and is like no other.
Then, among the sets left, with the rarest shingles first (by a fixed-size count
sketch) and l a twentieth of the set: sets with fewer shared prefix shingles
drop out, too.  Among the others the smallest member of each shared shingle is
the pivot of a star; a star holds everyone who shares a prefix shingle with
anyone else under that pivot, so every similar pair meets in some star.

Within a star, members sit in a signature tree: nodes hold the OR and the AND of
their members' token bitmaps and the range of set sizes.  A dual traversal drops
pairs of nodes whose greatest possible overlap can't reach the threshold and
pairs that are already connected; the pairs left are decided on whole sets.

Large stars (a hot group of near copies) never meet in one task: chunks of
members are joined together with the pivot, and only members that this doesn't
connect to it are joined with all others, chunk by chunk, tree against tree.
"""

from __future__ import annotations

import hashlib
import math
from collections.abc import Iterator

import numpy as np
import pyarrow as pa
from pyspark.sql import DataFrame
from pyspark.sql import functions as F

from hiresight.llm.common import arrow_schema, batch, session_of, stage, task_id
from hiresight.llm.components import connected_components
from hiresight.llm.runs import first_of_run

SKETCH_BITS = 18
#: members of a star that one task joins; larger stars go by chunks
STAR, CHUNK = 256, 2048
BUCKET, FANOUT = 32, 8
#: bits of a shingle that the counts of the first step leave out (of 64); where two shingles then
#: look alike neither counts as a set's own, so their sets stay in and nothing is lost
DROPPED = 16
#: share of the hash range whose shingles are counted for all sets; must leave
#: a set of its own more such shingles than the first prefix takes
COUNTED = 0.3
#: at most so many rows of two longs are sent to every executor
BROADCAST_ROWS = 1_000_000
TEXT_CHUNK = 1 << 20
U = np.uint64


def mix(x: np.ndarray) -> np.ndarray:
    x = (x ^ (x >> U(30))) * U(0xBF58476D1CE4E5B9)
    x = (x ^ (x >> U(27))) * U(0x94D049BB133111EB)
    return x ^ (x >> U(31))


class Shingler:
    """Sorted distinct 64-bit hashes of the word n-grams of whole texts.

    Words are ``[^\\x20\\x09-\\x0D]+`` after lower-casing A-Z; a text of fewer
    than ``size`` words has one shingle, its whole sequence; none without words."""

    def __init__(self, size: int):
        self.size = size
        base = np.arange(1, 300 + size, dtype=np.uint64) * U(0x9E3779B97F4A7C15)
        keys = mix(base)
        self.byte, self.place, self.short = keys[:256], keys[256:256 + size] | U(1), keys[256 + size:257 + size]
        self.space = np.zeros(256, bool)
        self.space[[32, 9, 10, 11, 12, 13]] = True
        self.powers = np.ones(1, np.uint64)

    def words(self, data: np.ndarray) -> tuple[np.ndarray, np.ndarray]:
        """Start and hash of every word of a byte array."""
        at = np.flatnonzero(~self.space[data])
        if not len(at):
            return at, np.zeros(0, np.uint64)
        first = np.flatnonzero(np.concatenate([[True], np.diff(at) > 1]))
        length = np.diff(np.concatenate([first, [len(at)]]))
        if length.max() > len(self.powers):
            self.powers = np.multiply.accumulate(np.concatenate([[U(1)], np.full(length.max(), U(0x9E3779B97F4A7C15))]))
        pos = np.arange(len(at)) - np.repeat(first, length)
        h = np.add.reduceat(self.byte[data[at]] * self.powers[pos], first)
        return at[first], mix(h + length.astype(np.uint64) * U(0xD6E8FEB86659FD93))

    def sets(self, raws: list[bytes]) -> Iterator[np.ndarray]:
        i = 0
        while i < len(raws):
            j, n = i, 0
            while j < len(raws) and (j == i or n + len(raws[j]) < TEXT_CHUNK):
                n += len(raws[j])
                j += 1
            part = raws[i:j]
            begins = np.concatenate([[0], np.cumsum([len(r) + 1 for r in part])])
            at, h = self.words(np.frombuffer(b"\n".join(part).lower(), np.uint8))
            cut = np.searchsorted(at, begins)
            k = self.size
            grams = np.zeros(0, np.uint64)
            if len(h) >= k:
                grams = mix(sum(h[x:len(h) - k + 1 + x] * self.place[x] for x in range(k)))
            for a, b in zip(cut[:-1], cut[1:]):
                if b - a >= k:
                    yield np.unique(grams[a:b - k + 1])
                elif b > a:
                    yield mix((h[a:b] * self.place[:b - a]).sum(keepdims=True) + self.short * np.array([b - a], np.uint64))
                else:
                    yield np.zeros(0, np.uint64)
            i = j


def _sketch(size: int):
    schema = arrow_schema({"counts": pa.binary()})

    def run(batches: Iterator[pa.RecordBatch]) -> Iterator[pa.RecordBatch]:
        shingler, total = Shingler(size), np.zeros(1 << SKETCH_BITS, np.int64)
        for b in batches:
            for s in shingler.sets(b.column(0).to_pylist()):
                total += np.bincount((s >> U(64 - SKETCH_BITS)).astype(np.int64), minlength=len(total)) if len(s) > 20_000 else 0
                if len(s) <= 20_000:
                    np.add.at(total, (s >> U(64 - SKETCH_BITS)).astype(np.int64), 1)
        yield batch(schema, counts=[total.tobytes()])

    return run


def _add(batches: Iterator[pa.RecordBatch]) -> Iterator[pa.RecordBatch]:
    schema, total = arrow_schema({"counts": pa.binary()}), np.zeros(1 << SKETCH_BITS, np.int64)
    for b in batches:
        for x in b.column(0).to_pylist():
            total += np.frombuffer(x, np.int64)
    yield batch(schema, counts=[total.tobytes()])


def frequency_ranks(raws: DataFrame, size: int) -> np.ndarray:
    """A small rank for each hash range: quarter powers of two of how often its
    shingles occur.  Any order is exact; this one keeps frequent shingles out
    of the prefixes.  Two megabytes reach the driver, whatever the input."""
    groups = max(1, math.isqrt(raws.rdd.getNumPartitions()))
    counts = np.frombuffer(raws.mapInArrow(_sketch(size), "counts binary").repartition(groups).mapInArrow(_add, "counts binary")
                           .repartition(1).mapInArrow(_add, "counts binary").collect()[0][0], np.int64)
    return np.floor(4 * np.log2(counts + 1)).astype(np.uint8)


def needed_overlap(n: int, percent: int) -> int:
    """Overlap that a set of n needs with any similar set."""
    return (percent * n + 99) // 100


def shared_shingles(n: int, percent: int) -> int:
    """l of a set of n: prefix shingles that it shares with any similar set."""
    return min(needed_overlap(n, percent), max(8, -(-n // 20)))


SETS = {"is_rep": pa.bool_(), "rid": pa.int64(), "doc_id": pa.int64(), "n": pa.int64(), "text_key": pa.int64(),
        "c1": pa.int64(), "c2": pa.int64(), "counted": pa.list_(pa.int64())}
SETS_DDL = "is_rep boolean, rid long, doc_id long, n long, text_key long, c1 long, c2 long, counted array<long>"


def _sets(size: int):
    """A row for each document (doc_id, rid of its set in this split, n), and a
    row for each distinct set of the split with its digest and counted shingles."""
    schema = arrow_schema(SETS)

    def run(batches: Iterator[pa.RecordBatch]) -> Iterator[pa.RecordBatch]:
        shingler, rids, base = Shingler(size), {}, task_id() << 40
        limit = U(int(COUNTED * 2**64))
        for b in batches:
            out: dict[str, list] = {n: [] for n in SETS}

            def add(*row):
                for n, v in zip(SETS, row):
                    out[n].append(v)

            for doc, tkey, s in zip(b.column(0).to_pylist(), b.column(2).to_pylist(), shingler.sets(b.column(1).to_pylist())):
                if not len(s):
                    add(False, None, doc, 0, None, None, None, None)
                    continue
                digest = hashlib.blake2b(s, digest_size=16).digest()
                rid = rids.get(digest)
                if rid is None:
                    rid = rids[digest] = base + len(rids)
                    c1, c2 = np.frombuffer(digest, "<i8").tolist()
                    add(True, rid, doc, len(s), tkey, c1, c2, (s[:np.searchsorted(s, limit)] >> U(DROPPED)).view(np.int64))
                add(False, rid, doc, len(s), None, None, None, None)
            if out["rid"]:
                yield batch(schema, **out)

    return run


def _prefixes(size: int, percent: int, ranks: np.ndarray):
    """(rid, n, prefix) of whole texts: the rarest shingles by the sketch, then by hash."""
    schema = arrow_schema({"rid": pa.int64(), "n": pa.int64(), "prefix": pa.list_(pa.int64())})

    def run(batches: Iterator[pa.RecordBatch]) -> Iterator[pa.RecordBatch]:
        shingler = Shingler(size)
        for b in batches:
            n, prefixes = [], []
            for s in shingler.sets(b.column(1).to_pylist()):
                keep = len(s) - needed_overlap(len(s), percent) + shared_shingles(len(s), percent)
                order = np.lexsort((s, ranks[(s >> U(64 - SKETCH_BITS)).astype(np.int64)]))[:keep]
                n.append(len(s))
                prefixes.append(s[order].view(np.int64))
            if n:
                yield batch(schema, rid=b.column(0), n=n, prefix=prefixes)

    return run


class Groups:
    """Union-find over small integers."""

    def __init__(self, labels: list):
        first: dict = {}
        self.up = [first.setdefault(x, i) for i, x in enumerate(labels)]

    def find(self, x: int) -> int:
        while self.up[x] != x:
            self.up[x] = self.up[self.up[x]]
            x = self.up[x]
        return x

    def union(self, a: int, b: int) -> None:
        self.up[self.find(a)] = self.find(b)


def similar(a: np.ndarray, b: np.ndarray, percent: int) -> bool:
    n, m = len(a), len(b)
    if 100 * min(n, m) < percent * max(n, m):
        return False
    common = len(np.intersect1d(a, b, assume_unique=True))
    return 100 * common >= percent * (n + m - common)


class SignatureTree:
    """Levels of nodes over members sorted by size: [low, high) members, OR and AND bitmaps, size range."""

    def __init__(self, sets: list[np.ndarray], members: list[int], width: int):
        self.members = sorted(members, key=lambda i: (len(sets[i]), int(sets[i][0])))
        bits = np.zeros((len(members), width), bool)
        for k, i in enumerate(self.members):
            bits[k, (sets[i] % U(width)).astype(np.int64)] = True
        self.bits = np.packbits(bits, axis=1).view(np.uint64)
        self.n = np.array([len(sets[i]) for i in self.members])
        cuts = list(range(0, len(members), BUCKET))
        level = [(a, min(a + BUCKET, len(members))) for a in cuts]
        self.levels = []
        while True:
            self.levels.append([(a, b, np.bitwise_or.reduce(self.bits[a:b]), np.bitwise_and.reduce(self.bits[a:b]),
                                 int(self.n[a:b].min()), int(self.n[a:b].max())) for a, b in level])
            if len(level) <= 1:
                break
            level = [(level[i][0], level[min(i + FANOUT, len(level)) - 1][1]) for i in range(0, len(level), FANOUT)]

    def below(self, level: int, i: int) -> list[tuple[int, int]]:
        return [(level - 1, k) for k in range(i * FANOUT, min((i + 1) * FANOUT, len(self.levels[level - 1])))]


def _ones(x: np.ndarray) -> int:
    return int(np.bitwise_count(x).sum())


def tree_links(sets: list[np.ndarray], left: list[int], right: list[int], groups: Groups, percent: int) -> list[tuple[int, int]]:
    """Links that connect, with what ``groups`` has already, all similar pairs of left x right."""
    links: list[tuple[int, int]] = []
    if not left or not right:
        return links

    def check(i: int, j: int) -> None:
        if groups.find(i) != groups.find(j) and similar(sets[i], sets[j], percent):
            groups.union(i, j)
            links.append((i, j))

    width = 1 << min(13, max(8, int(2 * np.median([len(sets[i]) for i in {*left, *right}])).bit_length()))
    same = left == right
    p = SignatureTree(sets, left, width)
    q = p if same else SignatureTree(sets, right, width)
    todo = [((len(p.levels) - 1, 0), (len(q.levels) - 1, 0))]
    while todo:
        x, y = todo.pop()
        if same and (x[0] == y[0] and x[1] > y[1]):
            continue
        a1, b1, or1, and1, low1, high1 = p.levels[x[0]][x[1]]
        a2, b2, or2, and2, low2, high2 = q.levels[y[0]][y[1]]
        if same and a1 >= b2:  # the mirrored pair is visited
            continue
        if 100 * high1 < percent * low2 or 100 * high2 < percent * low1:
            continue
        overlap = min(high1 - _ones(and1 & ~or2), high2 - _ones(and2 & ~or1))
        if (100 + percent) * overlap < percent * (low1 + low2):
            continue
        if len({groups.find(i) for i in p.members[a1:b1]} | {groups.find(i) for i in q.members[a2:b2]}) == 1:
            continue
        if x[0] and (x[0] >= y[0]):
            todo.extend((c, y) for c in p.below(*x))
        elif y[0]:
            todo.extend((x, c) for c in q.below(*y))
        else:  # two buckets: greatest possible overlap of every pair of members
            s1, s2, n1, n2 = p.bits[a1:b1, None], q.bits[None, a2:b2], p.n[a1:b1, None], q.n[None, a2:b2]
            most = np.minimum(n1 - np.bitwise_count(s1 & ~s2).sum(2), n2 - np.bitwise_count(s2 & ~s1).sum(2))
            ok = ((100 + percent) * most >= percent * (n1 + n2)) & (100 * np.minimum(n1, n2) >= percent * np.maximum(n1, n2))
            for i, j in np.argwhere(ok):
                if p.members[a1 + i] != q.members[a2 + j]:
                    check(p.members[a1 + i], q.members[a2 + j])
    return links


LINK_DDL = "a long, b long"


def _join_groups(size: int, percent: int):
    """Rows (key, rid, label, side, raw), sorted by key: side 0 left, 1 right, 2 both."""
    schema = arrow_schema({"a": pa.int64(), "b": pa.int64()})

    def run(batches: Iterator[pa.RecordBatch]) -> Iterator[pa.RecordBatch]:
        shingler, key, rows = Shingler(size), None, {}

        def links():
            rids = sorted(rows)
            sets = list(shingler.sets([rows[r][2] for r in rids]))
            groups = Groups([rows[r][0] for r in rids])
            left = [i for i, r in enumerate(rids) if rows[r][1] != 1]
            right = [i for i, r in enumerate(rids) if rows[r][1] != 0]
            found = []
            if left == right:  # a whole star: its pivot is the smallest and most are like it
                for i in range(1, len(rids)):
                    if groups.find(0) != groups.find(i) and similar(sets[0], sets[i], percent):
                        groups.union(0, i)
                        found.append((0, i))
            found += tree_links(sets, left, right, groups, percent)
            if found:
                yield batch(schema, a=[rids[i] for i, _ in found], b=[rids[j] for _, j in found])

        for b in batches:
            for k, rid, label, side, raw in zip(*(b.column(i).to_pylist() for i in range(5))):
                if k != key:
                    if len(rows) > 1:
                        yield from links()
                    key, rows = k, {}
                rows[rid] = (label, side, raw)
        if len(rows) > 1:
            yield from links()

    return run


def jaccard_components(docs: DataFrame, id_col: str = "doc_id", text_col: str = "text", size: int = 4, percent: int = 85,
                       star: int = STAR, chunk: int = CHUNK) -> DataFrame:
    """One row per input row: doc_id, n_shingles, component_id.

    Two rows are linked when 100 * intersection >= percent * union of their
    shingle sets; component_id is the smallest id reachable by links, itself
    included.  Null texts and texts without words have no shingles and no
    links.  Repeated rows are linked like other equal sets; null ids are never
    the smallest (null only where all ids of a component are).  Other columns
    are ignored; an empty table gives an empty result.
    """
    session_of(docs)
    text = F.coalesce(F.col(text_col), F.lit(""))
    rows = docs.select(F.col(id_col).cast("long").alias("doc_id"), text.cast("binary").alias("raw"), F.xxhash64(text).alias("text_key"))
    sets = stage(rows.mapInArrow(_sets(size), SETS_DDL), "shingle-sets")
    reps = sets.where("is_rep")

    # equal sets of different splits: all but the smallest rid stand for it
    classes = reps.groupBy("c1", "c2").agg(F.min("rid").alias("root"), F.count("*").alias("k")).where("k > 1").drop("k")
    twins = stage(reps.select("c1", "c2", "rid").join(classes, ["c1", "c2"]).where("rid <> root").select("rid", "root"), "set-twins")

    long = lambda c: F.lit(c).cast("long")
    runs = lambda m, name: first_of_run(m.select("k1", long(0).alias("k2"), F.col("rid").alias("doc"), long(0).alias("tie"),
                                                 long(0).alias("payload")), name)
    overlap = lambda n: F.ceil(n * percent / F.lit(100))
    own = (reps.select(F.explode("counted").alias("k1"), "rid").groupBy("k1").agg(F.count("*").alias("k"), F.min("rid").alias("rid"))
           .where("k = 1").groupBy("rid").agg(F.count("*").alias("own")))
    left = (reps.select("rid", "n", "doc_id", "text_key").join(own, "rid", "left")
            .where(F.coalesce("own", long(0)) < F.col("n") - overlap(F.col("n")) + 1))
    left = stage(left.select("rid", F.col("doc_id").alias("__doc"), F.col("text_key").alias("__key")), "sets-left")
    few = left.limit(BROADCAST_ROWS + 1).count() <= BROADCAST_ROWS
    left = F.broadcast(left) if few else left.hint("shuffle_hash")
    on = F.col("doc_id").eqNullSafe(F.col("__doc")) & (F.col("text_key") == F.col("__key"))
    texts = stage(rows.join(left, on).select("rid", "raw"), "texts-left")
    ranks = frequency_ranks(texts.select("raw"), size)
    prefixes = stage(texts.mapInArrow(_prefixes(size, percent, ranks), "rid long, n long, prefix array<long>")
                     .dropDuplicates(["rid"]), "prefixes")

    shared, _ = runs(prefixes.select(F.explode("prefix").alias("k1"), "rid"), "prefix-runs")
    members = (shared.select("k1", F.col("doc").alias("rid"))
               .unionByName(shared.select("k1", F.col("first_doc").alias("rid")).distinct()))
    # the smallest set that may be similar to a set of n has ceil(t n) shingles
    m = overlap(F.col("n"))
    least = F.least(overlap(m), F.greatest(long(8), F.ceil(m / 20)))
    enough = (members.groupBy("rid").agg(F.count("*").alias("blocks")).join(prefixes.select("rid", "n"), "rid")
              .where(F.col("blocks") >= least).select("rid"))
    shared, moved = runs(members.join(stage(enough, "prefix-members"), "rid"), "star-runs")
    stars = shared.select(F.col("first_doc").alias("pivot"), F.col("doc").alias("rid")).distinct()
    # a shingle that spans partitions has a pivot in each: one star takes them all
    pivots = connected_components(moved.select(F.col("doc").alias("a"), F.col("first_doc").alias("b")))
    for c, t in (("pivot", pivots.select("node", "root")), ("pivot", twins.select(F.col("rid").alias("node"), "root")),
                 ("rid", twins.select(F.col("rid").alias("node"), "root"))):
        t = t.select(F.col("node").alias("__r"), F.col("root").alias("__root"))
        stars = stars.join(t, F.col(c) == F.col("__r"), "left").withColumn(c, F.coalesce("__root", c)).drop("__r", "__root")
    stars = stage(stars.where("pivot <> rid").distinct(), "stars")
    sizes = stars.groupBy("pivot").agg(F.count("*").alias("members"))

    def joined(members: DataFrame) -> DataFrame:  # (key..., rid, label, side), grouped by key
        keys = [c for c in members.columns if c not in ("rid", "label", "side")]
        key = F.struct(*keys) if len(keys) > 1 else F.col(keys[0])
        m = members.join(texts, "rid").select(F.xxhash64(key).alias("h"), key.cast("string").alias("key"), "rid", "label", "side", "raw")
        return (m.repartition("h").sortWithinPartitions("h", "key").select("key", "rid", "label", "side", "raw")
                .mapInArrow(_join_groups(size, percent), LINK_DDL))

    # stars, or chunks of them, each with the pivot
    chunks = F.ceil(F.col("members") / star)
    parts = (stars.join(sizes, "pivot").select("pivot", F.pmod(F.xxhash64("rid"), chunks).alias("c"), "rid")
             .unionByName(sizes.select("pivot", F.explode(F.sequence(long(0), chunks - 1)).alias("c"), F.col("pivot").alias("rid"))))
    links = stage(joined(parts.select("pivot", "c", "rid", F.col("rid").alias("label"), F.lit(2).alias("side"))), "links")
    large = sizes.where(F.col("members") > star).select("pivot")
    if large.limit(1).count():
        big = stars.join(large, "pivot")
        links = links.unionByName(stage(_rest_of_large(big, links, joined, chunk), "more-links"))
    labels = connected_components(links)

    label = F.coalesce("root", "rid")
    smallest = sets.where("not is_rep and rid is not null").groupBy("rid").agg(F.min("doc_id").alias("low"))
    of_set = (smallest.join(twins.select("rid", F.col("root").alias("twin")), "rid", "left").withColumn("rep", F.coalesce("twin", "rid"))
              .join(labels.select(F.col("node").alias("rep"), "root"), "rep", "left")
              .select("rid", "low", F.coalesce("root", "rep").alias("label")))
    lows = of_set.groupBy("label").agg(F.min("low").alias("component_id"))
    components = of_set.select("rid", "label").join(lows, "label").select("rid", "component_id")
    return (sets.where("not is_rep").select("rid", "doc_id", F.col("n").alias("n_shingles")).join(components, "rid", "left")
            .select("doc_id", "n_shingles", F.when(F.col("rid").isNull(), F.col("doc_id")).otherwise(F.col("component_id")).alias("component_id")))


def _rest_of_large(big: DataFrame, links: DataFrame, joined, chunk: int) -> DataFrame:
    """Links of large stars that their chunks don't give: members outside the
    pivot's component (side B) against all others, by chunks (B, i) x (A, j)
    and (B, i) x (B, j), i <= j."""
    labels = connected_components(links)
    of = lambda c: labels.select(F.col("node").alias(c), F.col("root").alias(f"{c}_label"))
    m = (big.select("pivot", "rid").join(of("rid"), "rid", "left").join(of("pivot"), "pivot", "left")
         .select("pivot", "rid", F.coalesce("rid_label", "rid").alias("label"), F.coalesce("pivot_label", "pivot").alias("pivot_label"))
         .withColumn("outside", F.col("label") != F.col("pivot_label")))
    sizes = (m.groupBy("pivot").agg(F.sum(F.when(F.col("outside"), 1).otherwise(0)).alias("nb"), F.count("*").alias("n"))
             .where("nb > 0").select("pivot", F.ceil(F.col("nb") / chunk).alias("cb"), F.ceil((F.col("n") - F.col("nb")) / chunk).alias("ca")))
    m = stage(m.join(sizes, "pivot").withColumn("c", F.pmod(F.xxhash64("rid"), F.when(F.col("outside"), F.col("cb")).otherwise(F.col("ca")))), "large-members")
    b, a = m.where("outside"), m.where("not outside")
    tasks = (b.select("pivot", "rid", "label", F.lit(0).alias("side"), F.col("c").alias("i"), F.explode(F.sequence(F.lit(1), F.col("ca"))).alias("j"))
             .unionByName(a.select("pivot", "rid", "label", F.lit(1).alias("side"), F.explode(F.sequence(F.lit(0), F.col("cb") - 1)).alias("i"), (F.col("c") + 1).alias("j"))))
    # B with B: j is -1 - (the other chunk); a chunk with itself is both sides
    pairs = b.select("pivot", "rid", "label", "c", F.explode(F.sequence(F.lit(0), F.col("cb") - 1)).alias("o"))
    pairs = pairs.select("pivot", "rid", "label", F.when(F.col("c") == F.col("o"), 2).when(F.col("c") < F.col("o"), 0).otherwise(1).alias("side"),
                         F.least("c", "o").alias("i"), (-1 - F.greatest("c", "o")).alias("j"))
    return joined(tasks.unionByName(pairs))
