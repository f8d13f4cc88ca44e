"""Log-bilinear language model trained with noise-contrastive estimation.

Counts of all training words make the base distribution.  The neural model has
levels, each a softmax of its own: the shortlist of frequent words, the end and
one class for all other words; the hash group of such a word; its cell in the
group.  Inside a cell a word has its share in the base distribution, and a word
that training lacks its base probability's share of the other words, so token
probabilities sum to one.  Sizes of all levels grow with the vocabulary.  As
contexts, words outside the shortlist stand for their groups.  The score of
class w after c1, c2 is (r[c1] C1 + r[c2] C2) . q[w] + b[w], hence two matrix
products give the scores of every (context word, class) pair, and one more the
normaliser of every context; cells, whose shares differ by group, are
normalised for the tokens that occur.

Training is data-parallel: in each round every task runs Adagrad steps over all
its tokens from the same parameters, and a two-level sum averages the tasks'
parameters by their token counts.
"""

from __future__ import annotations

import math
import zlib
from collections import Counter
from collections.abc import Callable, Iterator
from dataclasses import dataclass
from itertools import repeat

import numpy as np
import pyarrow as pa
from pyspark.sql import DataFrame
from pyspark.sql import functions as F

from hiresight.llm.common import arrow_schema, batch, id_bucket, session_of, stage, task_id

#: stands for the end of a text; no word contains white space
END = b"\n"
FLUSH_WORDS = 400_000


@dataclass
class Config:
    shortlist: int | None = None  # classes: 0 other words, 1.. frequent words, the last one the end; None: by vocabulary
    head: int = 262_144  # most frequent words whose counts travel with the tasks
    size: int = 16
    noise: int = 5
    minibatch: int = 65_536
    rounds: int = 2
    rate: float = 0.15
    seed: int = 11
    slice_bytes: int = 2 << 20  # text that is turned into arrays at once (a longer text alone)


def words(raw: bytes) -> list[bytes]:
    """Words ``[^\\x20\\x09-\\x0D]+`` of the text with A-Z lower-cased."""
    return raw.lower().split()


def _count(batches: Iterator[pa.RecordBatch]) -> Iterator[pa.RecordBatch]:
    schema, counts = arrow_schema({"word": pa.binary(), "c": pa.int64()}), Counter()

    def flush():
        items = list(counts.items())
        for i in range(0, len(items), 16384):
            part = items[i:i + 16384]
            yield batch(schema, word=[x[0] for x in part], c=[x[1] for x in part])

    for b in batches:
        for raw in b.column(0).to_pylist():
            counts.update(words(raw))
        counts[END] += b.num_rows
        if len(counts) >= FLUSH_WORDS:
            yield from flush()
            counts.clear()
    yield from flush()


def word_counts(texts: DataFrame) -> DataFrame:
    """(word, c) over all rows of a one-column frame of binary texts; splits combine first."""
    return texts.mapInArrow(_count, "word binary, c long").groupBy("word").agg(F.sum("c").alias("c"))


class Vocabulary:
    """Head words by falling count, the shortlist's classes and base log10 probabilities."""

    def __init__(self, head: list[tuple[bytes, int]], n: int, v: int, ends: int, cfg: Config):
        self.head = len(head)
        self.place = {w: i for i, (w, _) in enumerate(head)} | {END: self.head}
        self.n, self.v, self.denominator = n, v, n + 0.1 * (v + 1)
        self.short = min((cfg.shortlist or max(512, int(v ** 0.42))) - 2, len(head))  # listed words
        self.end, self.start, self.classes = self.short + 1, self.short + 2, self.short + 2
        self.groups, self.cells = max(2, int(v ** 0.4)), max(2, int(v ** 0.3))
        self.contexts = self.start + 1 + self.groups  # classes, the start, groups
        self.set_masses(np.zeros((self.groups, self.cells)))
        self.group_of, self.cell_of = self.hashes([w for w, _ in head])
        p = (np.array([c for _, c in head], float) + 0.1) / self.denominator
        # one entry more for the end, which has no place in the index
        self.base = np.log10(np.append(p, (ends + 0.1) / self.denominator))
        self.ends = ends
        listed = np.append(p[:self.short], (ends + 0.1) / self.denominator)
        self.other_mass = max(1 - listed.sum(), 0.1 / self.denominator)
        self.class_p = np.concatenate([[self.other_mass], listed])
        self.class_p /= self.class_p.sum()

    def hashes(self, ws: list[bytes]) -> tuple[np.ndarray, np.ndarray]:
        h = np.array([zlib.crc32(w) for w in ws], np.int64)
        return h % self.groups, h // self.groups % self.cells

    def set_masses(self, masses: np.ndarray) -> None:
        """Base probabilities of the words outside the shortlist, summed by group and cell."""
        tiny = 1e-12 * max(masses.sum(), 1e-12)
        masses = masses + tiny * (masses.sum(1, keepdims=True) == 0)  # a group without words
        self.group_mass = masses.sum(1)
        self.cell_p = masses / self.group_mass[:, None]
        self.group_p = self.group_mass / self.group_mass.sum()

    def levels(self) -> list["Level"]:
        return [Level(self.classes, self.contexts, self.class_p), Level(self.groups, self.contexts, self.group_p),
                Level(self.cells, self.contexts, np.ones(self.cells))]  # cells: shares of the group come on top

    def classes_of(self, places: np.ndarray) -> np.ndarray:
        """Head places (-1: not in the head) to classes."""
        return np.where((places >= 0) & (places < self.short), places + 1, 0)


@dataclass
class Level:
    classes: int
    contexts: int
    class_p: np.ndarray


def slices(raws: list[bytes], limit: int) -> Iterator[slice]:
    """Runs of texts of at most ``limit`` bytes together; a longer text is a run of its own."""
    begin = size = 0
    for i, raw in enumerate(raws):
        if i > begin and size + len(raw) > limit:
            yield slice(begin, i)
            begin, size = i, 0
        size += len(raw) + 1
    if begin < len(raws):
        yield slice(begin, len(raws))


def alias_tables(p: np.ndarray) -> tuple[np.ndarray, np.ndarray]:
    """For each row of probabilities: how likely a column stands for itself, and which one it stands for otherwise."""
    keep, other = np.ones(p.shape), np.tile(np.arange(p.shape[1]), (len(p), 1))
    for g, row in enumerate(p * p.shape[1] / p.sum(1, keepdims=True)):
        row = row.tolist()
        low, high = [i for i, x in enumerate(row) if x < 1], [i for i, x in enumerate(row) if x >= 1]
        while low and high:
            i, j = low.pop(), high[-1]
            keep[g, i], other[g, i] = row[i], j
            row[j] -= 1 - row[i]
            if row[j] < 1:
                low.append(high.pop())
    return keep, other


def picks(class_p: np.ndarray) -> np.ndarray:
    """Noise classes, repeated by their probabilities."""
    return np.repeat(np.arange(len(class_p)), np.maximum(1, (class_p * (1 << 18)).astype(int)))


def contexts(w: np.ndarray, ends: np.ndarray, start: int) -> tuple[np.ndarray, np.ndarray]:
    """The word before and the one before that; ``ends``: where texts end in ``w`` (exclusive)."""
    c1, c2 = np.empty_like(w), np.empty_like(w)
    c1[1:], c1[:1], c2[2:], c2[:2] = w[:-1], start, w[:-2], start
    begins = np.concatenate([[0], ends[:-1]]).astype(np.int64)
    c1[begins] = start
    c2[begins] = start
    second = begins + 1
    c2[second[second < ends]] = start
    return c1, c2


class Model:
    """Parameters r, C1, C2, q, b as one flat array of doubles."""

    def __init__(self, level: "Vocabulary | Level", cfg: Config):
        k, d, n = level.classes, cfg.size, level.contexts
        self.shapes = [(n, d), (d, d), (d, d), (k, d), (k,)]
        rng = np.random.default_rng(cfg.seed)
        eye = np.eye(d)
        self.parts = [rng.normal(0, 0.1, (n, d)), eye.copy(), 0.5 * eye, rng.normal(0, 0.1, (k, d)), np.log(level.class_p)]

    def flat(self) -> np.ndarray:
        return np.concatenate([x.ravel() for x in self.parts])

    def load(self, flat: np.ndarray) -> "Model":
        at, parts = 0, []
        for s in self.shapes:
            n = math.prod(s)
            parts.append(flat[at:at + n].reshape(s).copy())
            at += n
        self.parts = parts
        return self

    def tables(self) -> tuple[np.ndarray, np.ndarray]:
        """Scores by (word before, word), b included, and by (word before that, word)."""
        r, m1, m2, q, b = self.parts
        return (r @ m1) @ q.T + b, (r @ m2) @ q.T

    def log_probabilities(self) -> tuple[np.ndarray, np.ndarray, np.ndarray]:
        """The two tables and the log normaliser of every context (c1, c2)."""
        s1, s2 = self.tables()
        top1, top2 = s1.max(1, keepdims=True), s2.max(1, keepdims=True)
        z = np.exp(s1 - top1) @ np.exp(s2 - top2).T  # sum over w of exp(s1[c1, w] + s2[c2, w])
        z = np.log(np.maximum(z, 1e-300, out=z), out=z)
        z += top1
        z += top2.T
        return s1, s2, z

    def train(self, w: np.ndarray, c1: np.ndarray, c2: np.ndarray, memory: list[np.ndarray], log_noise: np.ndarray,
              pick: "np.ndarray | Callable[[int, int], np.ndarray]", cfg: Config, rng: np.random.Generator) -> None:
        """One Adagrad step on each minibatch, every token against ``cfg.noise`` noise words
        (``pick``: an array to draw from, or a function that draws for tokens i to j)."""
        k, m = len(log_noise), len(self.parts[0])
        for i in range(0, len(w), cfg.minibatch):
            x, a1, a2 = w[i:i + cfg.minibatch], c1[i:i + cfg.minibatch], c2[i:i + cfg.minibatch]
            s1, s2 = self.tables()
            n = len(x)
            f1, f2, errs = [], [], []
            for j in range(cfg.noise + 1):
                y = x if j == 0 else pick(i, i + n) if callable(pick) else pick[rng.integers(0, len(pick), n)]
                f1.append(a1 * k + y)
                f2.append(a2 * k + y)
                delta = s1.ravel()[f1[-1]] + s2.ravel()[f2[-1]] - math.log(cfg.noise) - log_noise[y]
                errs.append((1.0 if j == 0 else 0.0) - 1 / (1 + np.exp(-delta)))
            err = np.concatenate(errs)
            g1 = np.bincount(np.concatenate(f1), err, m * k).reshape(m, k) / n
            g2 = np.bincount(np.concatenate(f2), err, m * k).reshape(m, k) / n
            r, m1, m2, q, b = self.parts
            u1, u2 = g1 @ q, g2 @ q
            grads = [u1 @ m1.T + u2 @ m2.T, r.T @ u1, r.T @ u2, g1.T @ (r @ m1) + g2.T @ (r @ m2), g1.sum(0)]
            for p, g, a in zip(self.parts, grads, memory):
                a += g * g
                p += cfg.rate * g / np.sqrt(a + 1e-8)


class Levels:
    """The models of all levels, with their parameters as one flat array."""

    def __init__(self, vocabulary: Vocabulary, cfg: Config):
        self.vocabulary, self.cfg = vocabulary, cfg
        self.models = [Model(level, cfg) for level in vocabulary.levels()]

    def flat(self) -> np.ndarray:
        return np.concatenate([m.flat() for m in self.models])

    def load(self, flat: np.ndarray) -> "Levels":
        at = 0
        for m in self.models:
            n = sum(math.prod(s) for s in m.shapes)
            m.load(flat[at:at + n])
            at += n
        return self

    def ready_to_train(self, rng: np.random.Generator) -> None:
        v = self.vocabulary
        self.rng = rng
        self.memory = [[np.full(s, 1e-6) for s in m.shapes] for m in self.models]
        self.noise = [np.log(v.class_p), np.log(v.group_p), np.zeros(v.cells)]  # the shares of cells cancel
        self.picks = [picks(v.class_p), picks(v.group_p)]
        self.keep, self.other = (x.ravel() for x in alias_tables(v.cell_p))

    def train(self, w: np.ndarray, group: np.ndarray, cell: np.ndarray, c1: np.ndarray, c2: np.ndarray) -> None:
        """One pass over tokens: classes, groups and cells (for class 0 only), contexts."""
        v, rng = self.vocabulary, self.rng
        top, middle, low = self.models
        top.train(w, c1, c2, self.memory[0], self.noise[0], self.picks[0], self.cfg, rng)
        at = np.flatnonzero(w == 0)
        group, cell, c1, c2 = group[at], cell[at], c1[at], c2[at]

        def draw(i: int, j: int) -> np.ndarray:
            column = rng.integers(0, v.cells, j - i)
            at = group[i:j] * v.cells + column
            return np.where(rng.random(j - i) < self.keep[at], column, self.other[at])

        middle.train(group, c1, c2, self.memory[1], self.noise[1], self.picks[1], self.cfg, rng)
        low.train(cell, c1, c2, self.memory[2], self.noise[2], draw, self.cfg, rng)

    def ready_to_score(self) -> None:
        self.top, self.middle = (m.log_probabilities() for m in self.models[:2])
        self.t1, self.t2 = self.models[2].tables()
        v = self.vocabulary
        top = self.t1.max(1, keepdims=True), self.t2.max(1, keepdims=True)
        self.e1, self.e2, self.share = (x.astype(np.float32) for x in (np.exp(self.t1 - top[0]), np.exp(self.t2 - top[1]), v.cell_p))
        self.t1, self.t2 = self.t1 - top[0], self.t2 - top[1]  # what a row has in common cancels
        self.unknown = 0.1 / v.denominator / v.other_mass

    def log_class(self, w: np.ndarray, c1: np.ndarray, c2: np.ndarray) -> np.ndarray:
        s1, s2, z = self.top
        return s1[c1, w] + s2[c2, w] - z[c1, c2]

    def log_cell(self, group: np.ndarray, cell: np.ndarray, c1: np.ndarray, c2: np.ndarray) -> np.ndarray:
        """Log probability of group and cell among the other words that training has, over the cell's base probability."""
        s1, s2, z = self.middle
        v, out = self.vocabulary, np.empty(len(group))
        for i in range(0, len(group), 8_192):
            g, h, a1, a2 = group[i:i + 8_192], cell[i:i + 8_192], c1[i:i + 8_192], c2[i:i + 8_192]
            total = np.einsum("ij,ij,ij->i", self.e1[a1], self.e2[a2], self.share[g]).astype(np.float64)
            out[i:i + 8_192] = (s1[a1, g] + s2[a2, g] - z[a1, a2] - np.log(v.group_mass[g])
                                 + self.t1[a1, h] + self.t2[a2, h] - np.log(np.maximum(total, 1e-300)))
        return out + math.log(max(1 - self.unknown, 1e-12))


def _ids(raws: list[bytes], vocabulary: Vocabulary):
    """All tokens of some texts as words; their head places (end: len of head), classes, groups, cells and
    both contexts; where texts end."""
    flat: list[bytes] = []
    ends = []
    for raw in raws:
        flat += words(raw)
        flat.append(END)
        ends.append(len(flat))
    place = np.fromiter(map(vocabulary.place.get, flat, repeat(-1)), np.int64, len(flat))
    ends, end = np.array(ends, np.int64), vocabulary.head
    w = np.where(place == end, vocabulary.end, vocabulary.classes_of(place))
    group, cell = np.append(vocabulary.group_of, 0)[place], np.append(vocabulary.cell_of, 0)[place]
    rare = np.flatnonzero(place < 0)
    group[rare], cell[rare] = vocabulary.hashes([flat[i] for i in rare])
    c1, c2 = contexts(np.where(w == 0, vocabulary.start + 1 + group, w), ends, vocabulary.start)
    return flat, place, w, group, cell, c1, c2, ends


PARAMETERS_DDL = "weight double, parameters binary"


def _train(vocabulary: Vocabulary, flat: np.ndarray, round_no: int, cfg: Config):
    schema = arrow_schema({"weight": pa.float64(), "parameters": pa.binary()})

    def run(batches: Iterator[pa.RecordBatch]) -> Iterator[pa.RecordBatch]:
        model, seen = Levels(vocabulary, cfg).load(flat), 0
        model.ready_to_train(np.random.default_rng([cfg.seed, round_no, task_id()]))
        for b in batches:
            raws = b.column(0).to_pylist()
            for part in slices(raws, cfg.slice_bytes):
                _, _, w, group, cell, c1, c2, _ = _ids(raws[part], vocabulary)
                model.train(w, group, cell, c1, c2)
                seen += len(w)
        if seen:
            yield batch(schema, weight=[float(seen)], parameters=[(model.flat() * seen).tobytes()])

    return run


def _sum(batches: Iterator[pa.RecordBatch]) -> Iterator[pa.RecordBatch]:
    schema = arrow_schema({"weight": pa.float64(), "parameters": pa.binary()})
    weight, total = 0.0, None
    for b in batches:
        for w, p in zip(b.column(0).to_pylist(), b.column(1).to_pylist()):
            p = np.frombuffer(p)
            weight, total = weight + w, p.copy() if total is None else total + p
    if total is not None:
        yield batch(schema, weight=[weight], parameters=[total.tobytes()])


def fit(texts: DataFrame, vocabulary: Vocabulary, cfg: Config) -> Levels:
    """Train over every row of ``texts`` (one binary column) in each round."""
    model = Levels(vocabulary, cfg)
    groups = max(1, math.isqrt(texts.rdd.getNumPartitions()))
    for k in range(cfg.rounds):
        parts = texts.mapInArrow(_train(vocabulary, model.flat(), k, cfg), PARAMETERS_DDL)
        rows = (parts.repartition(groups).mapInArrow(_sum, PARAMETERS_DDL)
                .repartition(1).mapInArrow(_sum, PARAMETERS_DDL).collect())  # one row of parameters
        if rows:
            model.load(np.frombuffer(rows[0]["parameters"]) / rows[0]["weight"])
    return model


SCORED = {"row": pa.int64(), "doc_id": pa.int64(), "held_out": pa.bool_(), "n_tokens": pa.int64(), "n_known": pa.int64(),
          "base_score": pa.float64(), "score": pa.float64(), "tail": pa.list_(pa.struct([("word", pa.binary()), ("tf", pa.int32()), ("gain", pa.float64())]))}
SCORED_DDL = ("row long, doc_id long, held_out boolean, n_tokens long, n_known long, base_score double, score double, "
              "tail array<struct<word: binary, tf: int, gain: double>>")


def _score(vocabulary: Vocabulary, flat: np.ndarray, cfg: Config):
    schema = arrow_schema(SCORED)

    def run(batches: Iterator[pa.RecordBatch]) -> Iterator[pa.RecordBatch]:
        model = Levels(vocabulary, cfg).load(flat)
        model.ready_to_score()
        row, ln10 = task_id() << 40, math.log(10)
        other = math.log10(vocabulary.other_mass)
        for b in batches:
            raws = b.column(2).to_pylist()
            for part in slices(raws, cfg.slice_bytes):
                tokens, place, w, group, cell, c1, c2, ends = _ids(raws[part], vocabulary)
                lp = model.log_class(w, c1, c2) / ln10
                known = place >= 0
                base = np.where(known, vocabulary.base[place], 0.0)  # words outside the head are added by their counts
                at = np.flatnonzero(w == 0)
                # over the word's base share of the other words, which holds for words that training lacks
                gain = np.zeros(len(w))
                gain[at] = model.log_cell(group[at], cell[at], c1[at], c2[at]) / ln10 + other
                lp += np.where(w == 0, base - other, 0.0) + np.where(known, gain, 0.0)
                begins = np.concatenate([[0], ends[:-1]])
                counted = known & ((place < vocabulary.head) | (vocabulary.ends > 0))
                tails: list[dict] = [{} for _ in ends]
                rare = np.flatnonzero(~known)
                for k, text, g in zip(rare.tolist(), np.searchsorted(ends, rare, "right").tolist(), gain[rare].tolist()):
                    f = tails[text].setdefault(tokens[k], [0, 0.0])
                    f[0] += 1
                    f[1] += g
                yield batch(schema, row=np.arange(row, row + len(ends)), doc_id=b.column(0)[part], held_out=b.column(1)[part],
                            n_tokens=ends - begins, n_known=np.add.reduceat(counted.astype(np.int64), begins),
                            base_score=np.add.reduceat(base, begins), score=np.add.reduceat(lp, begins),
                            tail=[[{"word": x, "tf": f[0], "gain": f[1]} for x, f in t.items()] for t in tails])
                row += len(ends)

    return run


def most_frequent(counts: DataFrame, most: int, shards: int = 4096) -> list[tuple[bytes, int]]:
    """At most ``most`` words by falling count, then by word; only they are fetched.

    A histogram of counts (16 steps an octave) gives the least count whose words
    all fit; of the words one step lower, those in the first hash shards that fit,
    so that many words of one count don't leave the list empty."""
    step, shard = F.floor(F.log2("c") * 16).cast("int"), F.pmod(F.xxhash64("word"), F.lit(shards)).cast("int")
    sizes = sorted(((r[0], r[1]) for r in counts.groupBy(step.alias("s")).count().collect()), reverse=True)  # 1024 rows at most
    least, left = None, most
    for s, n in sizes:
        if n > left:
            break
        least, left = s, left - n
    else:
        s = None
    fits = F.lit(False) if least is None else step >= least
    if s is not None:
        edge = sorted(tuple(r) for r in counts.where(step == s).groupBy(shard.alias("h")).count().collect())  # a row a shard
        upto = 0
        for h, n in edge:
            if n > left:
                break
            upto, left = h + 1, left - n
        fits = fits | ((step == s) & (shard < upto))
    return sorted(((bytes(r[0]), r[1]) for r in counts.where(fits).select("word", "c").collect()), key=lambda x: (-x[1], x[0]))


def _masses(counts: DataFrame, vocabulary: Vocabulary) -> np.ndarray:
    """Base probabilities of all words outside the shortlist by group and cell (far fewer than words)."""
    h, g = F.crc32("word"), F.lit(vocabulary.groups)
    masses = np.zeros((vocabulary.groups, vocabulary.cells))
    rows = (counts.where(F.col("word") != F.lit(END)).groupBy((h % g).alias("g"), (F.floor(h / g) % vocabulary.cells).alias("h"))
            .agg(F.sum("c").alias("c"), F.count("*").alias("n")).toArrow())
    g, h, c, n = (rows.column(i).to_numpy() for i in range(4))
    masses[g, h] = c + 0.1 * n
    short = vocabulary.short
    place = (vocabulary.group_of[:short], vocabulary.cell_of[:short])
    np.subtract.at(masses, place, 10 ** vocabulary.base[:short] * vocabulary.denominator)
    return np.where(masses > 0.5, masses, 0.0) / vocabulary.denominator  # a word counts 1.1 at least


def lm_scores(docs: DataFrame, id_col: str = "doc_id", text_col: str = "text", modulus: int = 10, cfg: Config | None = None) -> DataFrame:
    """One row per input row: doc_id, held_out, n_tokens, n_known, train_tokens, base_score, score.

    Rows whose crc32(id as text) is divisible by ``modulus`` are held out; all
    others are training texts, whole.  Tokens are the words and one end; scores
    are log10 probabilities of the whole text.  Null text is empty (one end
    token); a null id counts as ''.  Repeated rows count as often as they
    occur.  With no training rows every word is unknown and the model stays at
    the base distribution.  Other columns are ignored.

    Counts of at most ``cfg.head`` words, the most frequent (a fixed bound),
    travel with the tasks, which also keeps hot words out of the join; all other words are
    joined with the whole table of counts.
    """
    spark = session_of(docs)
    cfg = cfg or Config()
    held_out = (id_bucket(modulus, id_col) == 0)
    raw = F.coalesce(F.col(text_col), F.lit("")).cast("binary")
    base = docs.select(F.col(id_col).cast("long").alias("doc_id"), held_out.alias("held_out"), raw.alias("raw"))
    training = docs.where(~held_out).select(raw.alias("raw"))
    counts = stage(word_counts(training), "word-counts")
    end = F.lit(END)
    n, v, ends = counts.agg(F.coalesce(F.sum("c"), F.lit(0)), F.count("*"),
                            F.coalesce(F.max(F.when(F.col("word") == end, F.col("c"))), F.lit(0))).first()
    head = most_frequent(counts.where(F.col("word") != end), cfg.head)
    vocabulary = Vocabulary(head, n, v, ends, cfg)
    vocabulary.set_masses(_masses(counts, vocabulary))
    model = fit(training, vocabulary, cfg)
    scored = stage(base.mapInArrow(_score(vocabulary, model.flat(), cfg), SCORED_DDL), "lm-scores")
    tail = scored.select("row", F.explode("tail").alias("t")).select("row", F.col("t.word").alias("word"), F.col("t.tf").alias("tf"), F.col("t.gain").alias("gain"))
    p = F.log10((F.coalesce(F.col("c"), F.lit(0)) + F.lit(0.1)) / F.lit(vocabulary.denominator))
    extra = (tail.join(counts.hint("shuffle_hash"), "word", "left")
             .groupBy("row").agg(F.sum(F.col("tf") * p).alias("tail_base"), F.sum("tf").alias("tail_n"),
                                 F.sum(F.when(F.col("c") > 0, F.col("gain")).otherwise(0.0)).alias("tail_gain"),
                                 F.sum(F.when(F.col("c") > 0, F.col("tf")).otherwise(0)).alias("tail_known")))
    zero = F.lit(0)
    return (scored.drop("tail").join(extra, "row", "left").select(
        "doc_id", "held_out", "n_tokens", (F.col("n_known") + F.coalesce("tail_known", zero)).alias("n_known"),
        F.lit(n).cast("long").alias("train_tokens"),
        (F.col("base_score") + F.coalesce("tail_base", zero)).alias("base_score"),
        (F.col("score") + F.coalesce("tail_base", zero) + F.coalesce("tail_gain", zero) - F.coalesce("tail_n", zero) * math.log10(vocabulary.other_mass)).alias("score")))
