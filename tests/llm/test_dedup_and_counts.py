import hashlib
import random
from collections import Counter, defaultdict

import public_tokenizers
import pytest
from tokenizers import Tokenizer

from hiresight.llm import tokens
from hiresight.llm.common import shared_path
from hiresight.llm.components import connected_components
from hiresight.llm.exact_dedup import PatriciaTrie, exact_dedup
from hiresight.llm.line_dedup import apply_keep_bitmaps, line_keep_bitmaps
from hiresight.llm.runs import first_of_run
from hiresight.llm.token_counts import open_cache, token_counts

from . import helpers

BPE = public_tokenizers.path("byte_bpe_50k.json")


@pytest.mark.parametrize("max_bytes", [1 << 30, 3000, 300])
def test_trie_holds_every_key_once(max_bytes):
    rng = random.Random(1)
    keys = [bytes(rng.choice(b"ab\x00\xff") for _ in range(rng.randrange(0, 12))) for _ in range(500)] + [b"", b"x" * 5000, b"x" * 5001]
    trie = PatriciaTrie(lambda a, b: (a[0], a[1] + b[1]), max_bytes)
    for k in keys:
        trie.insert(k, (k, 1))
    got = list(trie.items())
    assert dict(got) == Counter(keys) and len(got) == len(set(keys))
    assert (trie.spills > 0) == (max_bytes < 1 << 20)


@pytest.mark.parametrize("keep,bounds", [("largest", {}), ("smallest", {"combine_bytes": 500, "trie_bytes": 2000})])
def test_exact_dedup(spark, keep, bounds):
    got = exact_dedup(helpers.edge_docs(spark), keep=keep, **bounds).collect()
    rows = [(r[0], helpers.lower(r[1] or "")) for r in helpers.edge_rows()]
    groups = defaultdict(list)
    for i, t in rows:
        groups[t].append(i)
    best = {t: (max if keep == "largest" else min)((i for i in v if i is not None), default=None) for t, v in groups.items()}
    sha = lambda t: hashlib.sha256(t.encode()).hexdigest()
    assert Counter((r.doc_id, r.keep_id, r.group_size, r.text_sha256) for r in got) == Counter((i, best[t], len(groups[t]), sha(t)) for i, t in rows)
    kept = Counter((r.text_sha256, r.doc_id) for r in got if r.kept)
    assert kept == Counter((sha(t), best[t]) for t in groups)  # one row a text
    assert exact_dedup(helpers.empty_docs(spark)).collect() == []


def test_word_memo_gives_the_library_ids():
    lib, enc = Tokenizer.from_file(BPE), tokens.Encoder(BPE, False)
    texts = ["", " ", "a", " a", "a ", "a  b", "a   b", "a \nb", "a\n b", "a\n\nb", "a\tb", "it's we'll I'd 12ab !?x", "x y", "x y z",
             "é è ñ ß", "漢字 かな", "🙂 🙂", "<|endoftext|>", "a <|endoftext|> b", "a<|endoftext|", "\r\na\r\n", "a\x1cb", "a\n", "\na", helpers.LONG]
    rng = random.Random(2)
    texts += ["".join(rng.choice("ab '\n.1é 🙂\t") for _ in range(rng.randrange(40))) for _ in range(800)]
    import numpy as np
    for t in texts:
        assert np.frombuffer(enc.encode(t), "<u4").tolist() == lib.encode(t, add_special_tokens=False).ids, repr(t)


def test_token_counts_and_cache(spark):
    lib, docs = Tokenizer.from_file(BPE), helpers.edge_docs(spark)
    cache = shared_path(spark, "test-cache")
    want = Counter((r[0], len((r[1] or "").encode()), len(lib.encode(r[1] or "", add_special_tokens=False).ids)) for r in helpers.edge_rows())
    distinct = len({r[1] or "" for r in helpers.edge_rows()})
    for _ in range(2):  # the second call encodes nothing
        got = token_counts(docs, BPE, cache).collect()
        assert Counter((r.doc_id, r.n_bytes, r.n_tokens) for r in got) == want
        assert open_cache(spark, cache).count() == distinct
    more = spark.createDataFrame([(1, "one"), (2, "a new text")], "doc_id long, text string")
    assert token_counts(more, BPE, cache).count() == 2 and open_cache(spark, cache).count() == distinct + 1
    other = public_tokenizers.path("word_bpe_49k.json")  # another tokenizer has entries of its own
    n = len(Tokenizer.from_file(other).encode("a new text", add_special_tokens=False).ids)
    assert {r.doc_id: r.n_tokens for r in token_counts(more, other, cache).collect()}[2] == n
    assert token_counts(helpers.empty_docs(spark), BPE, cache).collect() == []


def test_line_dedup(spark):
    for docs, rows in ((helpers.edge_docs(spark), [(r[0], r[1]) for r in helpers.edge_rows()]), (helpers.empty_docs(spark), [])):
        got = apply_keep_bitmaps(docs, line_keep_bitmaps(docs)).collect()
        assert Counter((r.doc_id, r["__n_lines"], r["__n_dropped"], r.text or "") for r in got) == Counter(helpers.line_dedup(rows))
        assert all(r.kind == "k" and r.k1 == 2 for r in got)


def test_hot_line_over_many_partitions(spark):
    hot = "the hottest line of them all, in every single document here"
    rows = [(i, f"{hot}\nown line of document number {i} which nobody else has\n{hot}") for i in range(400)]
    rows += [(1000 + i, "four documents only have this long line, which is too few") for i in range(4)]
    docs = spark.createDataFrame(rows, "doc_id long, text string").repartition(8)
    spark.conf.set("spark.sql.adaptive.coalescePartitions.enabled", "false")
    try:
        got = apply_keep_bitmaps(docs, line_keep_bitmaps(docs)).collect()
    finally:
        spark.conf.set("spark.sql.adaptive.coalescePartitions.enabled", "true")
    assert Counter((r.doc_id, r["__n_lines"], r["__n_dropped"], r.text) for r in got) == Counter(helpers.line_dedup(rows))


def test_first_of_run(spark):
    rng = random.Random(4)
    rows = [(1 if rng.random() < 0.4 else rng.randrange(200), 0, rng.randrange(3000), i, i) for i in range(4000)]
    df = spark.createDataFrame(rows, "k1 long, k2 long, doc long, tie long, payload long").repartition(7)
    spark.conf.set("spark.sql.adaptive.coalescePartitions.enabled", "false")
    try:
        repeats, moved = first_of_run(df, "test-runs")
        got, moved = repeats.collect(), {tuple(r) for r in moved.collect()}
    finally:
        spark.conf.set("spark.sql.adaptive.coalescePartitions.enabled", "true")
    first = {}
    for k, _, d, t, _ in rows:
        first[k] = min(first.get(k, (d, t)), (d, t))
    assert Counter((r.k1, r.doc, r.tie, r.payload) for r in got) == Counter((k, d, t, t) for k, _, d, t, _ in rows if (d, t) != first[k])
    known = {(k, d, t) for k, _, d, t, _ in rows}
    for r in got:  # an earlier row of the key; one that isn't the first of all leads there
        assert (r.k1, r.first_doc, r.first_tie) in known and (r.first_doc, r.first_tie) < (r.doc, r.tie)
        assert (r.first_doc, r.first_tie) == first[r.k1] or r.first_doc == first[r.k1][0] or (r.first_doc, first[r.k1][0]) in moved
    assert moved  # the hot key spans partitions


def test_components(spark):
    rng = random.Random(6)
    edges = [(i, i + 1) for i in range(100)] + [(1000, 2000 + i) for i in range(50)] + [(rng.randrange(5000, 5400), rng.randrange(5000, 5400)) for _ in range(250)]
    up = {}

    def find(x):
        while up.setdefault(x, x) != x:
            x = up[x]
        return x

    for a, b in edges:
        x, y = find(a), find(b)
        up[max(x, y)] = min(x, y)
    got = {r.node: r.root for r in connected_components(spark.createDataFrame(edges, "a long, b long")).collect()}
    assert got == {x: find(x) for e in edges if e[0] != e[1] for x in e}
    assert connected_components(spark.createDataFrame([], "a long, b long")).collect() == []
