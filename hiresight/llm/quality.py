"""Quality by nearest-neighbour voting among labelled latent-semantic vectors.

A document's terms are its words without punctuation, the punctuation before and
after them, the shape of their letters, and whether and how often a word repeats
the one before it; they are hashed to ``WIDTH`` columns and weighted by (1 + log tf) * idf, with
document frequencies counted over all documents.  A truncated singular value
decomposition of a bounded sample of labelled documents gives the latent space.
The sample's vectors are broadcast (their size is fixed by the parameters); every
document gets its exact cosine with all of them, in blocks of documents, and the
nearest vote with their label, weighted by similarity.
"""

from __future__ import annotations

import re
from collections import Counter
from collections.abc import Iterator
from itertools import chain, islice, repeat
from operator import eq
from zlib import crc32

import numpy as np
import pyarrow as pa
from pyspark.sql import DataFrame
from pyspark.sql import functions as F

from hiresight.llm.common import arrow_schema, batch, id_bucket, session_of, text_or_empty, worker_state

WIDTH, RANK = 8192, 32
#: labelled rows of each label that may be fitted on, and neighbours that vote
PER_LABEL, NEIGHBOURS = 1024, 7
LEAST = 0.3
MEMO_WORDS, MEMO_LENGTH = 400_000, 40

WORD = re.compile(r"[^\W_](?:.*[^\W_])?", re.DOTALL)


def column(term: str) -> int:
    return crc32(term.encode("utf-8", "surrogatepass")) % WIDTH


def shape(core: str) -> str:
    if core.islower():
        return "lower"
    if core.isupper():
        return "upper" if len(core) > 1 else "title"
    return "title" if core[:1].isupper() and core[1:].islower() else "digit" if core.isdigit() else "mixed"


SHAPES = {s: column(f"s {s}") for s in ("lower", "upper", "title", "digit", "mixed")}


def word_terms(word: str) -> tuple[int, ...]:
    """Columns of a word: the word itself, its shape, and what stands before and after it."""
    if word.isalpha():
        return column(f"w {word.lower()}"), SHAPES[shape(word)]
    found = WORD.search(word)
    if not found:
        return (column(f"b {word}"),)
    core, before, after = found.group(), word[:found.start()], word[found.end():]
    return (column(f"w {core.lower()}"), SHAPES[shape(core)], *([column(f"b {before}")] if before else ()),
            *([column(f"e {after}")] if after else ()))


class Terms(dict):
    """word -> its columns; emptied when it holds too many, and long words are not held."""

    def __missing__(self, word):
        found = word_terms(word)
        if len(word) <= MEMO_LENGTH:
            if len(self) >= MEMO_WORDS:
                self.clear()
            self[word] = found
        return found


def columns(text: str, memo: Terms) -> tuple[np.ndarray, np.ndarray]:
    """(columns, term counts) of a text; columns are distinct and ascending."""
    words = text.split()
    count = Counter(words)
    found = list(map(memo.__getitem__, count))
    ids = list(chain.from_iterable(found))
    counts = list(chain.from_iterable(map(repeat, count.values(), map(len, found))))
    again = sum(map(eq, words, islice(words, 1, None)))
    if again:  # and its share of the words, in tenths
        ids += [REPEAT, column(f"r {10 * again // len(words)}")]
        counts += [again, again]
    total = np.bincount(ids, counts, WIDTH) if ids else np.zeros(WIDTH)
    at = np.flatnonzero(total)
    return at, total[at]


REPEAT = column("repeat")


def _memo() -> Terms:
    return worker_state().setdefault("quality-words", Terms())


def _frequencies():
    schema = arrow_schema({"term": pa.int64(), "n": pa.int64()})

    def run(batches: Iterator[pa.RecordBatch]) -> Iterator[pa.RecordBatch]:
        held, docs = np.zeros(WIDTH, np.int64), 0
        for b in batches:
            for text in b.column(0).to_pylist():
                held[columns(text, _memo())[0]] += 1
                docs += 1
        if docs:
            t = np.flatnonzero(held)
            yield batch(schema, term=[-1, *t.tolist()], n=[docs, *held[t].tolist()])

    return run


def _labelled():
    schema = arrow_schema({"doc_id": pa.int64(), "label": pa.int64(), "at": pa.list_(pa.int64()), "n": pa.list_(pa.float64())})

    def run(batches: Iterator[pa.RecordBatch]) -> Iterator[pa.RecordBatch]:
        for b in batches:
            found = [columns(t, _memo()) for t in b.column("text").to_pylist()]
            yield batch(schema, doc_id=b.column("doc_id").to_pylist(), label=b.column("label").to_pylist(),
                        at=[a.tolist() for a, _ in found], n=[n.tolist() for _, n in found])

    return run


def unit(x: np.ndarray) -> np.ndarray:
    """Rows of length 1; a row of zeros stays."""
    size = np.linalg.norm(x, axis=1, keepdims=True)
    return np.divide(x, size, out=np.zeros_like(x), where=size > 1e-9)


def weigh(at: np.ndarray, n: np.ndarray, idf: np.ndarray) -> np.ndarray:
    w = (1 + np.log(n)) * idf[at]
    size = np.sqrt((w * w).sum())
    return (w / size if size > 0 else w).astype(np.float32)


def decompose(x: np.ndarray, rank: int, rounds: int = 6) -> np.ndarray:
    """The first right singular vectors, by subspace iteration from fixed random directions."""
    q = np.random.default_rng(11).standard_normal((x.shape[1], min(rank + 16, *x.shape))).astype(np.float32)
    for _ in range(rounds):
        q, _ = np.linalg.qr(x.T @ (x @ q))
    _, _, right = np.linalg.svd(x @ q, full_matrices=False)
    return np.ascontiguousarray(q @ right[:rank].T, np.float32)


def learn(idf: np.ndarray, rows: list[tuple[np.ndarray, np.ndarray]], labels: np.ndarray, rank: int, prior: float) -> tuple:
    """(idf, latent space, labelled vectors in it, labels, score of what has no neighbour): plain arrays, to be broadcast."""
    x = np.zeros((len(rows), WIDTH), np.float32)
    for i, (at, n) in enumerate(rows):
        x[i, at] = weigh(at, n, idf)
    space = decompose(x, min(rank, *x.shape)) if len(rows) else np.zeros((WIDTH, 0), np.float32)
    return idf, space, unit(x @ space), labels.astype(np.float64), prior


def vote(model: tuple, found: list[tuple[np.ndarray, np.ndarray]], neighbours: int) -> np.ndarray:
    """Share of label 1 among the nearest, weighted by cosine; all that are as near as the last one vote, too."""
    idf, space, vectors, labels, prior = model
    out = np.full(len(found), prior)
    if not len(labels) or not found:
        return out
    latent = np.zeros((len(found), space.shape[1]), np.float32)
    for i, (at, n) in enumerate(found):
        latent[i] = weigh(at, n, idf) @ space[at]
    cosine = unit(latent) @ vectors.T
    k = min(neighbours, len(labels))
    least = np.partition(cosine, -k, axis=1)[:, -k:].min(axis=1, keepdims=True)
    weight = np.where((cosine >= least) & (cosine > 0), cosine, 0).astype(np.float64)
    total = weight.sum(axis=1)
    np.divide(weight @ labels, total, out=out, where=total > 0)
    return np.clip(out, 0.0, 1.0)


def fit(docs: DataFrame, labels: DataFrame, id_col: str = "doc_id", text_col: str = "text", label_col: str = "quality",
        folds: int = 5, per_label: int = PER_LABEL, rank: int = RANK) -> tuple:
    """Model of at most ``per_label`` labelled documents of each label, those first in order of a hash of the id.

    Rows of a fold other than 0 teach.  An id's label is the smallest it has; of
    documents that repeat an id the smallest text teaches.
    """
    session_of(docs)
    texts = docs.select(F.col(id_col).cast("long").alias("doc_id"), text_or_empty(text_col).alias("text"))
    n = {r[0]: r[1] for r in texts.select("text").mapInArrow(_frequencies(), "term long, n long")
         .groupBy("term").agg(F.sum("n")).collect()}  # a row a column, WIDTH at most
    idf = np.log((1 + n.get(-1, 0)) / (1 + np.array([n.get(t, 0) for t in range(WIDTH)]))) + 1
    marked = (labels.select(F.col(id_col).cast("long").alias("doc_id"), F.col(label_col).cast("long").alias("label"))
              .where("doc_id is not null and label in (0, 1)").where(id_bucket(folds) != 0).groupBy("doc_id").agg(F.min("label").alias("label")))
    share = marked.agg(F.avg("label")).first()[0]
    known = texts.join(marked, "doc_id", "left_semi").select("doc_id").distinct().join(marked, "doc_id")
    first = [known.where(F.col("label") == y).orderBy(F.xxhash64("doc_id"), "doc_id").limit(per_label) for y in (0, 1)]
    sample = first[0].unionByName(first[1])
    taught = (texts.join(F.broadcast(sample), "doc_id")  # 2 * per_label rows
              .groupBy("doc_id", "label").agg(F.min("text").alias("text")))
    rows = taught.mapInArrow(_labelled(), "doc_id long, label long, at array<long>, n array<double>").collect()  # 2 * per_label rows
    rows.sort(key=lambda r: r["doc_id"])
    return learn(idf, [(np.array(r["at"], np.int64), np.array(r["n"])) for r in rows], np.array([r["label"] for r in rows]), rank,
                 0.5 if share is None else float(share))


def _score(shared, neighbours: int):
    schema = arrow_schema({"doc_id": pa.int64(), "held_out": pa.bool_(), "score": pa.float64(), "predicted": pa.int32()})

    def run(batches: Iterator[pa.RecordBatch]) -> Iterator[pa.RecordBatch]:
        model = shared.value
        for b in batches:
            texts, scores = b.column("text").to_pylist(), []
            for i in range(0, len(texts), 512):
                scores += vote(model, [columns(t, _memo()) for t in texts[i:i + 512]], neighbours).tolist()
            yield batch(schema, doc_id=b.column("doc_id"), held_out=b.column("held_out"), score=scores,
                        predicted=[int(s >= LEAST) for s in scores])

    return run


def quality_scores(docs: DataFrame, labels: DataFrame, id_col: str = "doc_id", text_col: str = "text", label_col: str = "quality",
                   folds: int = 5, per_label: int = PER_LABEL, rank: int = RANK, neighbours: int = NEIGHBOURS) -> DataFrame:
    """doc_id, held_out (crc32 of the id as text modulo ``folds`` is 0), score (0 to 1), predicted (score of at least 0.3).

    A text without words or without a neighbour (null, empty, nothing in common
    with the sample) gets the share of label 1 among the labels that teach, or
    0.5 without any.  A null id stays null and counts as '' for its fold; repeated
    rows are scored each; empty tables give empty results.  Only ids and texts
    are read of ``docs``, only ids and labels of ``labels``.
    """
    spark = session_of(docs)
    model = spark.sparkContext.broadcast(fit(docs, labels, id_col, text_col, label_col, folds, per_label, rank))
    rows = docs.select(F.col(id_col).cast("long").alias("doc_id"), text_or_empty(text_col).alias("text"))
    return rows.select("doc_id", "text", (id_bucket(folds) == 0).alias("held_out")).mapInArrow(
        _score(model, neighbours), "doc_id long, held_out boolean, score double, predicted int")
