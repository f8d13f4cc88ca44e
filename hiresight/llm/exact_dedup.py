"""Exact dedup with Patricia-trie owners.

Texts are normalised (A-Z lower-cased).  Every input split first combines its
own equal texts, so a group of copies that holds a third of all rows leaves
each split as one row.  The combined rows are dealt by (length, content hash);
each task inserts the full byte strings into a compressed radix trie whose
terminals hold the owner.  Nothing is decided by a hash: it only deals rows.
When a trie outgrows its memory bound, its heaviest subtree is spilled to an
anonymous temporary file and rebuilt on its own when the partition has ended.
"""

from __future__ import annotations

import hashlib
import pickle
import tempfile
from collections.abc import Iterator

import pyarrow as pa
from pyspark.sql import DataFrame
from pyspark.sql import functions as F

from hiresight.llm.common import arrow_schema, batch, session_of, shared_path, task_id

COMBINED = {
    "is_text": pa.bool_(), "gid": pa.int64(), "row_id": pa.int64(), "doc_id": pa.int64(),
    "n_rows": pa.int64(), "n_bytes": pa.int64(), "content_hash": pa.int64(), "sha256": pa.string(), "body": pa.binary(),
}
OWNER = {"gid": pa.int64(), "keep_id": pa.int64(), "keep_row": pa.int64(), "group_size": pa.int64(), "text_sha256": pa.string()}


#: taken for a node besides its label
NODE_BYTES = 200


class Node:
    __slots__ = ("label", "children", "terminal", "spill", "size")

    def __init__(self, label: bytes):
        self.label, self.children, self.terminal, self.spill, self.size = label, {}, None, None, len(label) + NODE_BYTES


def _common(a: bytes, at: int, label: bytes) -> int:
    """Length of the common prefix of ``a[at:]`` and ``label`` (by halving)."""
    if a.startswith(label, at):
        return len(label)
    lo, hi = 0, min(len(label), len(a) - at)
    while lo < hi:
        mid = (lo + hi + 1) // 2
        if a.startswith(label[lo:mid], at + lo):
            lo = mid
        else:
            hi = mid - 1
    return lo


def _read(spill) -> Iterator[tuple[bytes, object]]:
    spill.seek(0)
    with spill:
        while True:
            try:
                yield pickle.load(spill)
            except EOFError:
                return


class PatriciaTrie:
    """Compressed radix trie over byte strings.

    ``insert(key, payload)`` merges payloads of equal keys with ``merge``;
    ``items()`` yields the payload of every distinct key, once.  Above
    ``max_bytes`` of labels the heaviest child of the topmost branching node is
    written to a temporary file; keys that belong below it follow it there.
    """

    def __init__(self, merge, max_bytes: int):
        self.root, self.merge, self.max_bytes, self.bytes, self.spills = Node(b""), merge, max_bytes, 0, 0

    def insert(self, key: bytes, payload) -> None:
        self._insert(key, payload)
        if self.bytes > self.max_bytes:
            self._spill()

    def _insert(self, key: bytes, payload) -> None:
        node, at, path = self.root, 0, []
        while True:
            path.append(node)
            if node.spill is not None:
                pickle.dump((key, payload), node.spill)
                return
            if at == len(key):
                node.terminal = payload if node.terminal is None else self.merge(node.terminal, payload)
                return
            child = node.children.get(key[at])
            if child is None:
                leaf = node.children[key[at]] = Node(key[at:])
                leaf.terminal = payload
                self._grow(path, leaf.size)
                return
            n = _common(key, at, child.label)
            if n < len(child.label):  # split the edge
                upper = Node(child.label[:n])
                child.label = child.label[n:]
                upper.children[child.label[0]] = child
                upper.size = child.size + NODE_BYTES
                node.children[key[at]] = upper
                self._grow(path, NODE_BYTES)
                child = upper
            node, at = child, at + n

    def _grow(self, path: list[Node], n: int) -> None:
        self.bytes += n
        for x in path:
            x.size += n

    def _spill(self) -> None:
        node, prefix = self.root, b""
        while len(node.children) == 1 and node.terminal is None and node.spill is None:
            node = next(iter(node.children.values()))
            prefix += node.label
        live = [c for c in node.children.values() if c.spill is None]
        if not live:
            return
        heavy = max(live, key=lambda c: c.size)
        out = tempfile.TemporaryFile()
        for key, payload in self._walk(heavy, prefix):
            pickle.dump((key, payload), out)
        self.bytes -= heavy.size
        heavy.children, heavy.terminal, heavy.spill, heavy.size = {}, None, out, 0
        self.spills += 1

    def _walk(self, node: Node, prefix: bytes):
        todo = [(node, prefix)]
        while todo:
            x, p = todo.pop()
            key = p + x.label
            if x.terminal is not None:
                yield key, x.terminal
            if x.spill is not None:  # spilled when it stood higher up
                yield from _read(x.spill)
            todo.extend((c, key) for c in x.children.values())

    def items(self):
        todo = [self.root]
        while todo:
            x = todo.pop()
            if x.terminal is not None:
                yield x.terminal
            if x.spill is not None:
                sub = PatriciaTrie(self.merge, self.max_bytes)
                for key, payload in _read(x.spill):
                    sub.insert(key, payload)
                yield from sub.items()
            todo.extend(x.children.values())


def _better(a: tuple, b: tuple, largest: bool) -> tuple:
    """Of two (doc_id, row_id); a null id loses, rows break ties by row_id."""
    ka, kb = (a[0] is not None, a[0] or 0), (b[0] is not None, b[0] or 0)
    if ka != kb:
        if ka[0] != kb[0]:
            return max(a, b, key=lambda x: x[0] is not None)
        return a if (ka > kb) == largest else b
    return min(a, b, key=lambda x: x[1])


def _combine(largest: bool, max_bytes: int):
    schema = arrow_schema(COMBINED)

    def run(batches: Iterator[pa.RecordBatch]) -> Iterator[pa.RecordBatch]:
        base, rows, gids, groups, held = task_id() << 40, 0, 0, {}, 0

        def flush():
            texts = list(groups)
            for i in range(0, len(texts), 256):
                part = texts[i:i + 256]
                found = [groups[t] for t in part]
                digests = [hashlib.sha256(t).digest() for t in part]
                yield batch(schema, is_text=[True] * len(part), gid=[g[0] for g in found], n_rows=[g[1] for g in found],
                            doc_id=[g[2][0] for g in found], row_id=[g[2][1] for g in found], n_bytes=[len(t) for t in part],
                            content_hash=[int.from_bytes(d[:8], "little", signed=True) for d in digests],
                            sha256=[d.hex() for d in digests], body=part)

        for b in batches:
            ids, out = b.column(0).to_pylist(), []
            for doc, raw in zip(ids, b.column(1).to_pylist()):
                text, row = raw.lower(), base + rows
                rows += 1
                g = groups.get(text)
                if g is None:
                    g = groups[text] = [base + gids, 1, (doc, row)]
                    gids += 1
                    held += len(text) + 300
                else:
                    g[1] += 1
                    g[2] = _better(g[2], (doc, row), largest)
                out.append((g[0], row))
            if ids:
                yield batch(schema, is_text=[False] * len(ids), gid=[x[0] for x in out], row_id=[x[1] for x in out], doc_id=ids)
            if held > max_bytes:
                yield from flush()
                groups, held = {}, 0
        yield from flush()

    return run


def _own(largest: bool, max_bytes: int):
    schema = arrow_schema(OWNER)

    def merge(a: list, b: list) -> list:
        a[0] = _better(a[0], b[0], largest)
        a[1] += b[1]
        a[3].extend(b[3])
        return a

    def run(batches: Iterator[pa.RecordBatch]) -> Iterator[pa.RecordBatch]:
        trie = PatriciaTrie(merge, max_bytes)
        for b in batches:
            c = {n: b.column(i).to_pylist() for i, n in enumerate(b.schema.names)}
            for i, body in enumerate(c["body"]):
                trie.insert(body, [(c["doc_id"][i], c["row_id"][i]), c["n_rows"][i], c["sha256"][i], [c["gid"][i]]])
        out: dict[str, list] = {n: [] for n in OWNER}
        for (keep, row), n, sha, gids in trie.items():
            for g in gids:
                for name, v in zip(OWNER, (g, keep, row, n, sha)):
                    out[name].append(v)
            if len(out["gid"]) >= 4096:
                yield batch(schema, **out)
                out = {n: [] for n in OWNER}
        if out["gid"]:
            yield batch(schema, **out)

    return run


def exact_dedup(docs: DataFrame, id_col: str = "doc_id", text_col: str = "text", keep: str = "largest",
                combine_bytes: int = 32 << 20, trie_bytes: int = 96 << 20) -> DataFrame:
    """One row per input row: doc_id, keep_id, group_size, kept, text_sha256.

    Of equal normalised texts the row with the largest (or ``smallest``) id is
    kept.  Null text counts as empty; empty texts are equal to each other.  A
    null id loses against any id; of rows with the same id and text exactly one
    is kept.  An empty table gives an empty result; other columns are ignored.

    The combined texts are written once to the shared folder, so the ids given
    to rows there are the same for both readers and survive lost executors.
    """
    spark = session_of(docs)
    largest = {"largest": True, "smallest": False}[keep]
    path = shared_path(spark, "exact-dedup")
    ddl = "is_text boolean, gid long, row_id long, doc_id long, n_rows long, n_bytes long, content_hash long, sha256 string, body binary"
    (docs.select(F.col(id_col).cast("long").alias("doc_id"), F.coalesce(F.col(text_col), F.lit("")).cast("binary").alias("body"))
     .mapInArrow(_combine(largest, combine_bytes), ddl).write.option("compression", "zstd").parquet(path))
    combined = spark.read.schema(ddl).parquet(path)
    owners = (combined.where("is_text").select("gid", "row_id", "doc_id", "n_rows", "sha256", "body", "n_bytes", "content_hash")
              .repartition("n_bytes", "content_hash")
              .mapInArrow(_own(largest, trie_bytes), "gid long, keep_id long, keep_row long, group_size long, text_sha256 string"))
    return (combined.where("not is_text").select("gid", "row_id", "doc_id").join(owners, "gid")
            .select("doc_id", "keep_id", "group_size", (F.col("row_id") == F.col("keep_row")).alias("kept"), "text_sha256"))
