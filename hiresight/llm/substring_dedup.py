"""Substring dedup by hashing lines, long lines in content-defined units.

A unit is a run of at most ``WINDOW`` words within one line.  Lines end units;
inside a line a unit also ends after a word whose hash, with the word before it,
is the least of some ``WINDOW`` neighbouring ones.  That choice depends on the
words around it alone, so a passage is cut the same way wherever it was pasted,
but for 2 * WINDOW words at its ends (a plain line hash sees only whole lines).
Units are normalised, their 128-bit digests grouped over all documents, and
every occurrence but the earliest, by (document, position), is a repeat.
Repeats that follow each other in a document make a run.  A run's two ends are
then compared, word by word, with the text around the first occurrence of its
outermost units (of those that occur first in step with others of the run; short
units may stand anywhere): no common stretch goes on for more than 2 * WINDOW
words past the run, or the next unit would be common, too.  Spans of at least ``min_words`` words are
removed, with their offsets in the original text.
"""

from __future__ import annotations

import hashlib
import zlib
from collections.abc import Iterator

import numpy as np
import pyarrow as pa
from pyspark.sql import DataFrame
from pyspark.sql import functions as F

from hiresight.llm.common import arrow_schema, batch, session_of, stage
from hiresight.llm.runs import first_of_run

WINDOW = 8
#: passages of so many words have a run of units of at least SURE - 4 * WINDOW + 2 words
SURE = 51
REACH = 2 * WINDOW
#: texts are cut together up to so many characters
SLICE = 1 << 20
#: the words around a first occurrence are copied so often, since many runs may ask for the same ones
SALTS = 8
LEFT, RIGHT = 0, 1
NO_ID = -(1 << 63)
SPACES = np.array([chr(c).isspace() for c in range(0x3001)])
#: odd multipliers, one a word of a unit and half of the digest
ODD = np.frombuffer(b"".join(hashlib.blake2b(bytes([i]), digest_size=16).digest() for i in range(WINDOW)), "<u8").reshape(-1, 2) | np.uint64(1)
PAIR = np.uint64(0x9E3779B97F4A7C15)


class Hashes(dict):
    """word -> its 128-bit digest."""

    def __missing__(self, word: str) -> bytes:
        if len(self) > 300_000:
            self.clear()
        v = self[word] = hashlib.blake2b(word.encode(), digest_size=16).digest()
        return v


class Words:
    """The words of some texts, end to end: digests, offsets in their text, text and line numbers."""

    def __init__(self, texts: list[str], hashes: Hashes):
        starts, ends, lines, owners, digests, line = [], [], [], [], [], 0
        for k, text in enumerate(texts):
            points = np.frombuffer(text.encode("utf-32-le"), "<u4")
            word = ~(SPACES[np.minimum(points, 0x3000)] & (points <= 0x3000))
            edge = np.diff(np.concatenate([[False], word, [False]]).astype(np.int8))
            at = np.flatnonzero(edge == 1)
            starts.append(at)
            ends.append(np.flatnonzero(edge == -1))
            breaks = np.cumsum(points == 10)
            lines.append(breaks[at] + line)
            line += (int(breaks[-1]) if len(breaks) else 0) + 1
            owners.append(np.full(len(at), k))
            digests.append(b"".join(map(hashes.__getitem__, text.lower().split())))
        self.start, self.end, self.line, self.owner = (np.concatenate(x) for x in (starts, ends, lines, owners))
        self.digest = np.frombuffer(b"".join(digests), "<u8").reshape(-1, 2)

    def units(self) -> tuple[np.ndarray, np.ndarray]:
        """First words of the units and, one longer, where each ends."""
        n = len(self.line)
        last = np.ones(n, bool)
        last[:-1] = self.line[1:] != self.line[:-1]
        if n >= WINDOW:
            before = np.concatenate([[0], self.digest[:-1, 1]]).astype(np.uint64)
            before[1:][last[:-1]] = 0
            key = (self.digest[:, 0] ^ before) * PAIR
            key ^= key >> np.uint64(29)
            m = n - WINDOW + 1
            least, at = key[:m].copy(), np.arange(m)
            for d in range(1, WINDOW):
                v = key[d:d + m]
                lower = v <= least
                least[lower] = v[lower]
                at[lower] = np.flatnonzero(lower) + d
            last[at[self.line[:m] == self.line[WINDOW - 1:]]] = True
        cut = np.flatnonzero(last) + 1
        return np.concatenate([[0], cut[:-1]]).astype(np.int64)[:len(cut)], cut

    def digests(self, first: np.ndarray, length: np.ndarray) -> np.ndarray:
        """128 bits a unit: sums of its words' digests, multiplied by their place in it."""
        if not len(first):
            return np.zeros((0, 2), np.uint64)
        place = np.arange(len(self.line)) - np.repeat(first, length)
        sums = np.add.reduceat(self.digest * ODD[place], first, axis=0)
        sums ^= sums >> np.uint64(32)
        return sums + length[:, None].astype(np.uint64) * PAIR


def slices(texts: list[str]) -> Iterator[slice]:
    """Texts that are cut together, one at least."""
    i = size = 0
    for j, t in enumerate(texts):
        if j > i and size + len(t) > SLICE:
            yield slice(i, j)
            i, size = j, 0
        size += len(t)
    if i < len(texts):
        yield slice(i, len(texts))


def _units(batches: Iterator[pa.RecordBatch]) -> Iterator[pa.RecordBatch]:
    """tie: text hash (32 bits), position (27), words (5); payload: start and end."""
    schema, hashes = arrow_schema({c: pa.int64() for c in ("k1", "k2", "doc", "tie", "payload")}), Hashes()
    for b in batches:
        docs, every = b.column(0).to_numpy(), b.column(1).to_pylist()
        for part in slices(every):
            texts = every[part]
            w = Words(texts, hashes)
            first, cut = w.units()
            if not len(first):
                continue
            high = np.array([(zlib.crc32(t.encode()) >> 1) << 32 for t in texts], np.int64)
            owner, length = w.owner[first], cut - first
            begin = np.searchsorted(owner, np.arange(len(texts)))
            digest = w.digests(first, length).view(np.int64)
            yield batch(schema, k1=digest[:, 0], k2=digest[:, 1], doc=docs[part][owner],
                        tie=high[owner] | (np.arange(len(first)) - begin[owner]) << 5 | length, payload=w.start[first] << 32 | w.end[cut - 1])


END = {"doc": pa.int64(), "text_hash": pa.int64(), "side": pa.int32(), "unit": pa.int64(), "gap": pa.int64(), "run": pa.int64(), "n_units": pa.int64(),
       "firsts": pa.list_(pa.int64()), "a_doc": pa.int64(), "a_hash": pa.int64(), "a_unit": pa.int64()}
END_DDL = "doc long, text_hash long, side int, unit long, gap long, run long, n_units long, firsts array<long>, a_doc long, a_hash long, a_unit long"


def _place(tie: np.ndarray) -> np.ndarray:
    return tie >> 5 & 0x7FFFFFF


def _run_ends(doc: np.ndarray, tie: np.ndarray, first_doc: np.ndarray, first_tie: np.ndarray, least: int) -> dict[str, pa.Array] | None:
    """The two ends of every run of ``least`` words or more among the units of some documents, sorted and all different."""
    new = np.ones(len(tie), bool)
    new[1:] = (doc[1:] != doc[:-1]) | (tie[1:] >> 5 != (tie[:-1] >> 5) + 1)
    size = np.diff(np.append(np.flatnonzero(new), len(tie)))
    enough = np.repeat(np.add.reduceat(tie & 31, np.flatnonzero(new)) >= least, size)
    if not enough.any():
        return None
    doc, tie, first_doc, first_tie, new = (x[enough] for x in (doc, tie, first_doc, first_tie, new))
    starts, run, n = np.flatnonzero(new), np.cumsum(new) - 1, len(tie)
    stops = np.append(starts[1:], n)
    # words of the units of a run that occur first in step with each other
    step = (_place(first_tie) - _place(tie), first_tie >> 32, first_doc, run)
    order = np.lexsort(step)
    other = np.ones(n, bool)
    other[1:] = np.logical_or.reduce([x[order][1:] != x[order][:-1] for x in step])
    group = np.empty(n, np.int64)
    group[order] = np.cumsum(other) - 1
    words = np.bincount(group, tie & 31).astype(np.int64)[group]
    good = words >= np.minimum(2 * WINDOW, np.maximum.reduceat(words, starts))[run]
    at = np.arange(n)
    sums = np.concatenate([[0], np.cumsum(tie & 31)])
    left, right = np.minimum.reduceat(np.where(good, at, n), starts), np.maximum.reduceat(np.where(good, at, -1), starts)
    k = np.concatenate([left, right])
    # the different first documents of a run, ascending
    order = np.lexsort((first_doc, run))
    value, of = first_doc[order], run[order]
    one = np.ones(n, bool)
    one[1:] = (value[1:] != value[:-1]) | (of[1:] != of[:-1])
    many, values = np.bincount(of[one], minlength=len(starts)), value[one]
    firsts = pa.ListArray.from_arrays(pa.array(np.concatenate([[0], np.cumsum(np.tile(many, 2))]), pa.int32()), pa.array(np.tile(values, 2)))
    return {"doc": doc[k], "text_hash": tie[k] >> 32, "side": np.repeat([LEFT, RIGHT], len(starts)).astype(np.int32), "unit": _place(tie[k]),
            "gap": np.concatenate([sums[left] - sums[starts], sums[stops] - sums[right + 1]]), "run": np.tile(_place(tie[starts]), 2),
            "n_units": np.tile(stops - starts, 2), "firsts": firsts, "a_doc": first_doc[k], "a_hash": first_tie[k] >> 32, "a_unit": _place(first_tie[k])}


def _ends(least: int):
    """Two rows a run of repeated units of ``least`` words or more: the unit that its
    left or right end is compared from, ``gap`` words inside, and where that occurs first."""
    schema = arrow_schema(END)

    def run(batches: Iterator[pa.RecordBatch]) -> Iterator[pa.RecordBatch]:
        for b in batches:
            found = b.column(1)
            units = found.flatten()  # of all rows, end to end
            row = np.repeat(np.arange(b.num_rows), found.value_lengths().fill_null(0).to_numpy(zero_copy_only=False))
            tie, first_doc, first_tie = (x.to_numpy(zero_copy_only=False) for x in units.flatten())
            order = np.lexsort((first_tie, first_doc, tie, row))
            cols = [x[order] for x in (row, tie, first_doc, first_tie)]
            new = np.ones(len(order), bool)
            new[1:] = np.logical_or.reduce([x[1:] != x[:-1] for x in cols])  # repeated rows are alike
            row, *cols = (x[new] for x in cols)
            if len(row):
                # rows are told apart by their number: two texts of one id are two rows
                out = _run_ends(row, *cols, least)
                if out:
                    yield batch(schema, **(out | {"doc": b.column(0).to_numpy()[out["doc"]]}))

    return run


AROUND = END | {"own": pa.bool_(), "word": pa.int64(), "words": pa.list_(pa.int64()), "offsets": pa.list_(pa.int64())}
AROUND_DDL = f"{END_DDL}, own boolean, word long, words array<long>, offsets array<long>"


def _around(batches: Iterator[pa.RecordBatch]) -> Iterator[pa.RecordBatch]:
    """The words outside of the units that are asked for, nearest first, with the
    offsets that a span has if it takes in none, one, two ... of them."""
    schema, hashes = arrow_schema(AROUND), Hashes()
    for b in batches:
        out: dict[str, list] = {n: [] for n in AROUND}
        for doc, text_hash, text, asked in zip(*(b.column(i).to_pylist() for i in range(4))):
            w = Words([text], hashes)
            first, cut = w.units()
            value = w.digest[:, 0].view(np.int64)
            for r in asked:
                if r["unit"] >= len(first):
                    continue  # another text of this id with the same checksum
                if r["side"] == LEFT:
                    edge = int(first[r["unit"]])
                    low = max(edge - REACH - r["gap"], 0)
                    words, offsets = value[low:edge][::-1], w.start[low:edge + 1][::-1]
                else:
                    edge = int(cut[r["unit"]])
                    high = edge + REACH + r["gap"]
                    words, offsets = value[edge:high], w.end[edge - 1:high]
                for n, v in (r | {"doc": doc, "text_hash": text_hash, "word": edge, "words": words, "offsets": offsets if r["own"] else []}).items():
                    out[n].append(v)
            if len(out["doc"]) >= 4096:
                yield batch(schema, **out)
                out = {n: [] for n in AROUND}
        if out["doc"]:
            yield batch(schema, **out)


SPAN = {"doc_id": pa.int64(), "start": pa.int64(), "end": pa.int64(), "n_words": pa.int64(), "n_units": pa.int64(), "first_doc_ids": pa.list_(pa.int64())}
SPAN_DDL = "doc_id long, start long, end long, n_words long, n_units long, first_doc_ids array<long>"


def _spans(min_words: int):
    """Both ends of the runs of a document put together; spans that meet are one."""
    schema = arrow_schema(SPAN)

    def run(batches: Iterator[pa.RecordBatch]) -> Iterator[pa.RecordBatch]:
        for b in batches:
            out: dict[str, list] = {n: [] for n in SPAN}
            for doc, ends in zip(b.column(0).to_pylist(), b.column(1).to_pylist()):
                runs: dict[int, dict] = {}
                for e in ends:
                    runs.setdefault(e["run"], {})[e["side"]] = e
                spans: list[list] = []  # first word, past the last word, start, end, units, first documents
                for _, r in sorted(runs.items()):
                    a, z = r[LEFT], r[RIGHT]
                    firsts = set(a["firsts"])
                    if spans and a["word"] <= spans[-1][1]:
                        s = spans[-1]
                        if z["word"] > s[1]:
                            s[1], s[3] = z["word"], z["offset"]
                        s[4], s[5] = s[4] + a["n_units"], s[5] | firsts
                    else:
                        spans.append([a["word"], z["word"], a["offset"], z["offset"], a["n_units"], firsts])
                for low, high, start, end, units, firsts in spans:
                    if high - low >= min_words:
                        for n, v in zip(SPAN, (None if doc == NO_ID else doc, start, end, high - low, units, sorted(firsts - {NO_ID}))):
                            out[n].append(v)
            if out["doc_id"]:
                yield batch(schema, **out)

    return run


def repeated_spans(docs: DataFrame, id_col: str = "doc_id", text_col: str = "text", min_words: int = 28) -> DataFrame:
    """One row per span to remove: doc_id, start, end (code points of the original
    text, end exclusive), n_words, n_units (repeated whole), first_doc_ids (earlier
    documents that hold the units; the earliest ones but for units that span partitions).

    A copy of 51 words or more always has a span, which covers it whole where its
    units occur first in the text it was copied from;
    shorter ones have a span if the repeated units in them have 21 words together.
    Documents without repeats have no row.  Of repeated rows with one id the
    first by text hash keeps its text and the others are repeats; rows with a
    null id rank before all others.  Null or empty text has no units.  Other
    columns are ignored; an empty table gives an empty result.
    """
    session_of(docs)
    texts = docs.select(F.coalesce(F.col(id_col).cast("long"), F.lit(NO_ID)).alias("doc"), F.coalesce(F.col(text_col), F.lit("")).alias("text"))
    rows = texts.mapInArrow(_units, "k1 long, k2 long, doc long, tie long, payload long")
    repeats, _ = first_of_run(rows, "substring-runs")
    ends = stage(repeats.groupBy("doc", F.shiftright("tie", 32).alias("text_hash"))
                 .agg(F.collect_list(F.struct("tie", "first_doc", "first_tie")).alias("found"))
                 .select("doc", "found").mapInArrow(_ends(min(min_words, SURE - 4 * WINDOW + 2)), END_DDL), "substring-ends")
    blank = {f.name: F.lit(None).cast(f.dataType).alias(f.name) for f in ends.schema}
    fields = [c for c in ends.columns if c not in ("doc", "text_hash")]
    others = ends.groupBy("a_doc", "a_hash", "side", "a_unit").agg(F.max("gap").alias("gap")).select(
        F.col("a_doc").alias("doc"), F.col("a_hash").alias("text_hash"), "side", F.col("a_unit").alias("unit"), "gap",
        *[blank[c] for c in fields if c not in ("side", "unit", "gap")])
    ends = ends.withColumn("own", F.lit(True)).unionByName(others.withColumn("own", F.lit(False))).select("doc", "text_hash", F.struct(*fields, "own").alias("ask"))
    asked = ends.groupBy("doc", "text_hash").agg(F.collect_set("ask").alias("asked"))
    # the questions are the build side: texts are streamed, never sorted
    keyed = texts.select("doc", F.shiftright(F.crc32("text"), 1).alias("text_hash"), "text")
    around = stage(keyed.join(asked.hint("shuffle_hash"), ["doc", "text_hash"]).select("doc", "text_hash", "text", "asked").mapInArrow(_around, AROUND_DDL),
                   "substring-around")
    mine = around.where("own").withColumn("salt", F.pmod(F.xxhash64("doc", "text_hash", "unit"), F.lit(SALTS)).cast("int"))
    theirs = (around.where("NOT own").groupBy(F.col("doc").alias("a_doc"), F.col("text_hash").alias("a_hash"), F.col("unit").alias("a_unit"), "side")
              .agg(F.first("words").alias("there"))  # alike in repeated rows
              .withColumn("salt", F.explode(F.sequence(F.lit(0), F.lit(SALTS - 1)))))
    differ = F.array_position(F.zip_with("words", "there", lambda a, b: a.eqNullSafe(b)), F.lit(False))
    same = F.when(F.col("there").isNull(), 0).when(differ == 0, F.size("words")).otherwise(differ - 1)
    more = F.greatest(same, "gap").cast("int")
    joined = mine.join(theirs, ["a_doc", "a_hash", "a_unit", "side", "salt"], "left").withColumn("more", more)
    return (joined.groupBy("doc", "text_hash")
            .agg(F.collect_set(F.struct("run", "side", "n_units", "firsts", F.when(F.col("side") == LEFT, F.col("word") - F.col("more"))
                                        .otherwise(F.col("word") + F.col("more")).alias("word"),
                                        F.get("offsets", "more").alias("offset"))).alias("ends"))
            .select("doc", "ends").mapInArrow(_spans(min_words), SPAN_DDL))
