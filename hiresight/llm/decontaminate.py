"""Benchmark decontamination: rare n-gram seeds, then Smith-Waterman.

A first pass counts, over all documents, how many hold each n-gram of the test
items; an item's seeds are the rarer three quarters of its n-grams (every item
keeps some, however often it was copied).  A second pass joins the documents'
n-grams with the seeds and aligns the item with the passage around its hits by
word-level Smith-Waterman, which scores edited copies as well as exact ones.

The items travel with the tasks in blocks of bounded size; a benchmark of many
blocks is handled in as many passes, each over all documents.
"""

from __future__ import annotations

import math
import re
from collections import Counter, defaultdict
from collections.abc import Iterator

import numpy as np
import pyarrow as pa
from pyspark.sql import DataFrame
from pyspark.sql import functions as F

from hiresight.llm.common import arrow_schema, batch, session_of

WORD = re.compile(r"\w+")
GRAM = 4
BLOCK_BYTES = 8 << 20


class Items:
    """Test items of one block: word ids and their n-grams."""

    def __init__(self, items: list[tuple[int, str]]):
        self.vocabulary: dict[str, int] = {}
        self.words: list[np.ndarray] = []
        self.ids: list[int] = []
        self.grams: dict[tuple, list[tuple[int, int]]] = defaultdict(list)
        for item_id, text in items:
            ws = [self.vocabulary.setdefault(w, len(self.vocabulary) + 1) for w in WORD.findall(text.lower())]
            if not ws:
                continue
            k = len(self.ids)
            self.ids.append(item_id)
            self.words.append(np.array(ws))
            n = min(GRAM, len(ws))
            for i in range(len(ws) - n + 1):
                self.grams[tuple(ws[i:i + n])].append((k, i))
        self.sizes = sorted({len(g) for g in self.grams})

    def ids_of(self, text: str) -> np.ndarray:
        """Word ids of a text, 0 for words that no item has."""
        get = self.vocabulary.get
        return np.array([get(w, 0) for w in WORD.findall(text.lower())], np.int64)

    def hits(self, ids: np.ndarray, grams) -> Iterator[tuple[int, tuple]]:
        """(position, n-gram) of the item n-grams in a text."""
        known = ids > 0
        for n in self.sizes:
            if len(ids) < n:
                continue
            run = known[:len(ids) - n + 1].copy()
            for j in range(1, n):
                run &= known[j:len(ids) - n + 1 + j]
            for i in np.flatnonzero(run):
                g = tuple(ids[i:i + n].tolist())
                if g in grams:
                    yield int(i), g


def smith_waterman(item: np.ndarray, passage: np.ndarray, mismatch: int = 1, gap: int = 1) -> tuple[int, int, int]:
    """(score, start, end) of the best local alignment, match 1; positions in the passage."""

    def forward(a, b):
        steps = gap * np.arange(len(b) + 1)
        row, best, at = np.zeros(len(b) + 1, np.int64), 0, (0, 0)
        for i, x in enumerate(a):
            new = np.maximum(row - gap, 0)
            new[1:] = np.maximum(new[1:], row[:-1] + np.where(b == x, 1, -mismatch))
            row = np.maximum.accumulate(new + steps) - steps  # gaps in the item
            j = int(row.argmax())
            if row[j] > best:
                best, at = int(row[j]), (i + 1, j)
        return best, at

    score, (i, j) = forward(item, passage)
    if not score:
        return 0, 0, 0
    _, (_, back) = forward(item[:i][::-1], passage[:j][::-1])
    return score, j - back, j


def _count(items: Items):
    schema = arrow_schema({"gram": pa.int64(), "n": pa.int64()})

    def run(batches: Iterator[pa.RecordBatch]) -> Iterator[pa.RecordBatch]:
        place, counts = {g: i for i, g in enumerate(items.grams)}, Counter()
        for b in batches:
            for text in b.column(0).to_pylist():
                counts.update({place[g] for _, g in items.hits(items.ids_of(text), place)})
        if counts:
            yield batch(schema, gram=list(counts), n=list(counts.values()))

    return run


def seeds(items: Items, df: dict[int, int]) -> set[tuple]:
    """The rarer three quarters of each item's n-grams, ties included."""
    place, own = {g: i for i, g in enumerate(items.grams)}, defaultdict(list)
    for g, where in items.grams.items():
        for k in {k for k, _ in where}:
            own[k].append((df.get(place[g], 0), g))
    found = set()
    for gs in own.values():
        gs.sort(key=lambda x: x[0])
        most = gs[math.ceil(0.75 * len(gs)) - 1][0]
        found.update(g for n, g in gs if n <= most)
    return found


LEAK = {"doc_id": pa.int64(), "item_id": pa.int64(), "score": pa.float64(), "start": pa.int64(), "end": pa.int64()}
LEAK_DDL = "doc_id long, item_id long, score double, start long, end long"


def leaks(text: str, items: Items, rare: set[tuple], least: float) -> list[tuple[int, float, int, int]]:
    """(item id, score, start, end in code points) of the passages of a text that align with an item."""
    ids = items.ids_of(text)
    near: dict[int, list[int]] = defaultdict(list)
    for i, g in items.hits(ids, rare):
        for k, at in items.grams[g]:
            near[k].append(i - at)
    found, spans = [], None
    for k, begins in near.items():
        item = items.words[k]
        begins.sort()
        slack, a = len(item) // 2 + 2, 0
        for b in range(1, len(begins) + 1):
            if b < len(begins) and begins[b] - begins[b - 1] <= slack:
                continue
            lo = max(0, begins[a] - slack)
            score, i, j = smith_waterman(item, ids[lo:begins[b - 1] + len(item) + slack])
            if score >= least * len(item):
                spans = spans or _spans(text)
                found.append((items.ids[k], score / len(item), spans[lo + i][0], spans[lo + j - 1][1]))
            a = b
    return found


def _spans(text: str) -> list[tuple[int, int]]:
    """Spans of the words of the lower-cased text, in code points of the text
    itself (lower-casing may lengthen a character)."""
    lowered = text.lower()
    if len(lowered) == len(text):
        return [m.span() for m in WORD.finditer(lowered)]
    origin = [i for i, c in enumerate(text) for _ in c.lower()] + [len(text)]
    origin += [len(text)] * (len(lowered) + 1 - len(origin))
    return [(origin[m.start()], origin[m.end() - 1] + 1) for m in WORD.finditer(lowered)]


def _find(items: Items, rare: set[tuple], least: float):
    schema = arrow_schema(LEAK)

    def run(batches: Iterator[pa.RecordBatch]) -> Iterator[pa.RecordBatch]:
        for b in batches:
            out: dict[str, list] = {n: [] for n in LEAK}
            for doc, text in zip(b.column(0).to_pylist(), b.column(1).to_pylist()):
                for row in leaks(text, items, rare, least):
                    for n, v in zip(LEAK, (doc, *row)):
                        out[n].append(v)
            if out["doc_id"]:
                yield batch(schema, **out)

    return run


def _mark(items: Items, rare: set[tuple], least: float, text_col: str):
    def run(batches: Iterator[pa.RecordBatch]) -> Iterator[pa.RecordBatch]:
        for b in batches:
            clean = [not leaks(t or "", items, rare, least) for t in b.column(text_col).to_pylist()]
            yield b.filter(pa.array(clean, pa.bool_()))

    return run


def item_blocks(docs: DataFrame, benchmark: DataFrame, text_col: str, item_col: str, item_text_col: str,
                block_bytes: int = BLOCK_BYTES) -> Iterator[tuple[Items, set[tuple]]]:
    """Blocks of items with their seeds; a block's texts take about ``block_bytes``."""
    session_of(docs)
    items = benchmark.select(F.col(item_col).cast("long").alias("i"), F.col(item_text_col).alias("t")).where("i is not null and t is not null").distinct()
    total = items.agg(F.coalesce(F.sum(F.octet_length("t")), F.lit(0))).first()[0]
    blocks = max(1, math.ceil(total / block_bytes))
    texts = docs.select(F.coalesce(F.col(text_col), F.lit("")).alias("text"))
    for k in range(blocks):
        block = Items(sorted((r[0], r[1]) for r in items.where(F.pmod(F.xxhash64("i", "t"), F.lit(blocks)) == k).collect()))
        if block.ids:
            df = {r[0]: r[1] for r in texts.mapInArrow(_count(block), "gram long, n long").groupBy("gram").agg(F.sum("n")).collect()}
            yield block, seeds(block, df)


def contaminated_passages(docs: DataFrame, benchmark: DataFrame, id_col: str = "doc_id", text_col: str = "text", item_col: str = "item_id",
                          item_text_col: str = "text", least: float = 0.5) -> DataFrame:
    """One row per passage that aligns with a test item: doc_id, item_id, score,
    start, end (code points of the text, end exclusive).

    score: Smith-Waterman score (match 1, mismatch and gap -1, in words) over
    the item's words; rows have at least ``least``.  Items of fewer than four
    words seed as a whole; items without words and null items are ignored.  Null
    texts are empty; a null id stays null; repeated rows give repeated results.
    """
    out = None
    for block, rare in item_blocks(docs, benchmark, text_col, item_col, item_text_col):
        rows = (docs.select(F.col(id_col).cast("long").alias("doc_id"), F.coalesce(F.col(text_col), F.lit("")).alias("text"))
                .mapInArrow(_find(block, rare, least), LEAK_DDL))
        out = rows if out is None else out.unionByName(rows)
    return out if out is not None else docs.sparkSession.createDataFrame([], LEAK_DDL)


def drop_contaminated(docs: DataFrame, benchmark: DataFrame, text_col: str = "text", item_col: str = "item_id",
                      item_text_col: str = "text", least: float = 0.5) -> DataFrame:
    """The rows of ``docs`` without a passage that aligns with a test item, all columns unchanged."""
    out = docs
    for block, rare in item_blocks(docs, benchmark, text_col, item_col, item_text_col):
        out = out.mapInArrow(_mark(block, rare, least, text_col), docs.schema)
    return out
