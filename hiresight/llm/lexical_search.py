"""Ranked lexical search: an Aho-Corasick automaton of all item terms scans the documents.

There is no document index.  The automaton holds every distinct item term
between guards (a space on both sides); a document's text, with each run of
separators replaced by spaces, is scanned once per pass, and every match is one
occurrence of one whole term.  An automaton output is a term number, which maps
to the items that have the term.

The first pass counts documents (N), terms (L) and, per item term, the documents
that hold it.  The second pass scores: a task keeps the best of each item in a
heap, so it returns at most ``k`` rows an item.  Items travel in blocks of bounded
size (``BLOCK_BYTES`` of text, one item at least), each with its own two passes.
"""

from __future__ import annotations

import heapq
import math
from collections import Counter
from collections.abc import Iterator

import numpy as np
import pyarrow as pa
from pyspark.sql import DataFrame, Window
from pyspark.sql import functions as F

from hiresight.llm.common import arrow_schema, batch, session_of, text_or_empty, worker_state

BLOCK_BYTES = 2 << 20
K = 20
#: parameters of the score, in hundredths: the share of length normalisation, and the saturation of counts
LENGTH, SATURATION = 25, 12
LONG = 1 << 63

#: byte -> byte: A-Z lower-cased, other ASCII letters and digits and all bytes of
#: longer characters stay, everything else separates
FOLD = bytes(b + 32 if 65 <= b <= 90 else b if b >= 128 or 48 <= b <= 57 or 97 <= b <= 122 else 32 for b in range(256))


def folded(text: str) -> bytes:
    """The text's UTF-8 bytes with separators as spaces, guarded at both ends."""
    return b" " + text.encode("utf-8", "surrogatepass").translate(FOLD) + b" "


def terms(text: str) -> list[bytes]:
    return folded(text).split()


def postings(items: list[tuple[int | None, str]]) -> tuple:
    """(item ids, distinct terms, where each term's items begin, items, their repeats of the term)."""
    own = [Counter(terms(t)) for _, t in items]
    found = sorted(set().union(*own))
    place = {t: n for n, t in enumerate(found)}
    where: list[list[tuple[int, int]]] = [[] for _ in found]
    for k, c in enumerate(own):
        for t, n in c.items():
            where[place[t]].append((k, n))
    flat = [x for w in where for x in w]
    return ([i for i, _ in items], found, np.cumsum([0, *map(len, where)]),
            np.array([k for k, _ in flat], np.int64), np.array([n for _, n in flat], np.int64))


class Items:
    """Items of one block, made in the task from what was broadcast (``postings``: plain lists and arrays)."""

    def __init__(self, shared: tuple):
        self.ids, self.terms, self.begin, self.item, self.times = shared

    def automaton(self):
        """Guarded terms -> term number; built once a worker and block."""
        import ahocorasick

        memo, key = worker_state(), ("lexical-search", tuple(self.ids[:64]), len(self.ids), hash(tuple(self.terms)))
        if key not in memo:
            for old in [k for k in memo if isinstance(k, tuple) and k[0] == "lexical-search"]:
                del memo[old]
            found = ahocorasick.Automaton()
            for n, t in enumerate(self.terms):
                found.add_word(f" {t.decode('latin-1')} ", n)
            found.make_automaton()
            memo[key] = found
        return memo[key]

    def scan(self, automaton, text: str) -> tuple[int, dict[int, int]]:
        """(number of terms, item term -> occurrences) of a text."""
        guarded = folded(text)
        return len(guarded.split()), Counter([n for _, n in automaton.iter(guarded.decode("latin-1"))])

    def scores(self, tf: dict[int, int], weights: np.ndarray, m: int) -> np.ndarray:
        """Score of a document for each item, from its counts of item terms."""
        out = np.zeros(len(self.ids), np.int64)
        t = np.fromiter(tf, np.int64, len(tf))
        n = np.fromiter(tf.values(), np.int64, len(tf))
        gain = weights[t] * ((1_000_000_000 * n) // (1000 * n + SATURATION * m))
        first, many = self.begin[t], self.begin[t + 1] - self.begin[t]
        at = np.repeat(first - (np.cumsum(many) - many), many) + np.arange(many.sum())
        np.add.at(out, self.item[at], np.repeat(gain, many) * self.times[at])
        return out


#: numbers that stand for no term in the first pass: documents with a term, and all their terms
DOCUMENTS, TERMS = -1, -2


def _count(shared):
    schema = arrow_schema({"term": pa.int64(), "n": pa.int64()})

    def run(batches: Iterator[pa.RecordBatch]) -> Iterator[pa.RecordBatch]:
        items, automaton = Items(shared.value), None
        held, docs, total = np.zeros(len(items.terms), np.int64), 0, 0
        for b in batches:
            automaton = automaton or items.automaton()
            for text in b.column(0).to_pylist():
                n, tf = items.scan(automaton, text)
                docs, total = docs + (n > 0), total + n
                held[list(tf)] += 1
        if docs:
            t = np.flatnonzero(held)
            yield batch(schema, term=[DOCUMENTS, TERMS, *t.tolist()], n=[docs, total, *held[t].tolist()])

    return run


FOUND = {"item": pa.int64(), "doc_id": pa.int64(), "score": pa.int64()}
FOUND_DDL = "item long, doc_id long, score long"


def _rank(shared, weights: np.ndarray, docs: int, total: int, k: int):
    schema = arrow_schema(FOUND)

    def run(batches: Iterator[pa.RecordBatch]) -> Iterator[pa.RecordBatch]:
        items, automaton = Items(shared.value), None
        best: list[list] = [[] for _ in items.ids]
        floor = np.ones(len(items.ids), np.int64)  # the least score that may still enter
        for b in batches:
            automaton = automaton or items.automaton()
            for doc, text in zip(b.column(0).to_pylist(), b.column(1).to_pylist()):
                n, tf = items.scan(automaton, text)
                if not tf:
                    continue
                scores = items.scores(tf, weights, 100 - LENGTH + LENGTH * n * docs // total)
                # smaller ids first among equals, a null id after all others
                order = -LONG if doc is None else -doc
                for i in np.flatnonzero(scores >= floor).tolist():
                    heap, entry = best[i], (int(scores[i]), order, doc)
                    if len(heap) < k:
                        heapq.heappush(heap, entry[:2])
                    else:
                        heapq.heappushpop(heap, entry[:2])
                    if len(heap) == k:
                        floor[i] = heap[0][0]
        rows = [(i, None if order == -LONG else -order, score) for i, heap in enumerate(best) for score, order in heap]
        if rows:
            yield batch(schema, item=[r[0] for r in rows], doc_id=[r[1] for r in rows], score=[r[2] for r in rows])

    return run


def item_blocks(items: DataFrame, block_bytes: int) -> Iterator[tuple]:
    """Postings of blocks of distinct items (id i, text t); a block's texts take about ``block_bytes``."""
    items = items.distinct()
    blocks = max(1, math.ceil(items.agg(F.coalesce(F.sum(F.octet_length("t")), F.lit(0))).first()[0] / block_bytes))
    for b in range(blocks):
        rows = items.where(F.pmod(F.xxhash64("i", "t"), F.lit(blocks)) == b).collect()
        block = postings(sorted(((r[0], r[1]) for r in rows), key=lambda r: (r[0] is None, r[0] or 0, r[1])))
        if block[1]:
            yield block


def ranked_search(docs: DataFrame, items: DataFrame, id_col: str = "doc_id", text_col: str = "text", item_col: str = "item_id",
                  item_text_col: str = "text", k: int = K, block_bytes: int = BLOCK_BYTES) -> DataFrame:
    """The ``k`` best documents of each item: item_id, rank (from 1), doc_id, score.

    Only scores above 0 are returned; equal scores come by ascending doc_id, a
    null doc_id last.  Null texts have no terms; items without terms and empty
    tables give no rows.  Each document row counts on its own, also when it
    repeats an id.  Item rows that are equal in id and text count once; rows that
    share an id, but not the text, are ranked each on its own.  A null item id
    stays null.  Other columns are not looked at.
    """
    spark = session_of(docs)
    texts = docs.select(F.col(id_col).cast("long").alias("doc_id"), text_or_empty(text_col).alias("text"))
    asked = items.select(F.col(item_col).cast("long").alias("i"), F.col(item_text_col).alias("t")).where("t is not null")
    out, before = None, 0
    for block in item_blocks(asked, block_bytes):
        ids, words = block[0], block[1]
        shared = spark.sparkContext.broadcast(block)  # bounded by block_bytes
        counts = texts.select("text").mapInArrow(_count(shared), "term long, n long").groupBy("term").agg(F.sum("n").alias("n"))
        n = {r["term"]: r["n"] for r in counts.collect()}  # one row a term of the block
        if n:
            weights = np.array([math.floor(1000 * math.log((2 * n[DOCUMENTS] + 2) / (2 * n.get(t, 0) + 1))) for t in range(len(words))], np.int64)
            named = spark.createDataFrame(list(enumerate(ids)), "item long, item_id long")  # one row an item of the block
            found = (texts.mapInArrow(_rank(shared, weights, n[DOCUMENTS], n[TERMS], k), FOUND_DDL).join(F.broadcast(named), "item")
                     .withColumn("item", F.col("item") + before))
            out = found if out is None else out.unionByName(found)
        before += len(ids)
    if out is None:
        return spark.createDataFrame([], "item_id long, rank int, doc_id long, score long")
    order = Window.partitionBy("item").orderBy(F.desc("score"), F.asc_nulls_last("doc_id"))
    return out.withColumn("rank", F.row_number().over(order)).where(F.col("rank") <= k).select("item_id", "rank", "doc_id", "score")
