import random
import re
from collections import Counter, defaultdict

import pytest

from hiresight.llm import decontaminate as dc
from hiresight.llm import substring_dedup as sd
from hiresight.llm.jaccard import Groups, Shingler, jaccard_components, similar, tree_links

from . import helpers


@pytest.mark.parametrize("size,percent,bounds", [(4, 85, {}), (5, 80, {}), (2, 60, {"star": 3, "chunk": 2}), (4, 85, {"star": 2, "chunk": 3})])
def test_jaccard_components(spark, size, percent, bounds):
    rows = [(r[0], r[1]) for r in helpers.edge_rows()]
    got = jaccard_components(helpers.edge_docs(spark), size=size, percent=percent, **bounds).collect()
    assert Counter((r.doc_id, r.n_shingles, r.component_id) for r in got) == helpers.jaccard_components(rows, size, percent)


@pytest.mark.parametrize("bounds", [{}, {"star": 4, "chunk": 5}])
def test_jaccard_near_copies_of_near_copies(spark, bounds):
    """Chains: neighbours are linked, the ends are not; large stars with members that aren't like the pivot."""
    rng = random.Random(8)
    rows = []
    for g in range(6):
        words = [f"w{rng.randrange(4000)}" for _ in range(80)]
        for i in range(14):
            rows.append((len(rows), " ".join(words)))
            words = list(words)
            words[rng.randrange(80)] = f"new{rng.randrange(10**6)}"
            if i % 5 == 4:
                words = words[:40] + [f"w{rng.randrange(4000)}" for _ in range(40)]
    rng.shuffle(rows)
    docs = spark.createDataFrame(rows, "doc_id long, text string").repartition(4)
    got = jaccard_components(docs, **bounds).collect()
    assert Counter((r.doc_id, r.n_shingles, r.component_id) for r in got) == helpers.jaccard_components(rows, 4, 85)


def test_jaccard_where_counted_shingles_look_alike(spark, monkeypatch):
    import pyarrow as pa

    from hiresight.llm import jaccard as J
    docs = helpers.edge_docs(spark)
    want = sorted(map(tuple, jaccard_components(docs).collect()), key=str)
    text = " ".join(f"w{i}" for i in range(200))
    with monkeypatch.context() as m:
        m.setattr(J, "task_id", lambda: 0)
        out = next(J._sets(4)(iter([pa.RecordBatch.from_arrays([pa.array([1]), pa.array([text.encode()]), pa.array([2])], ["d", "raw", "k"])])))
    counted = out.column("counted").to_pylist()[0]
    assert counted and max(counted) < 1 << (64 - J.DROPPED) <= 1 << 48
    monkeypatch.setattr(J, "DROPPED", 61)  # no shingle is a set's own
    assert sorted(map(tuple, jaccard_components(docs).collect()), key=str) == want


def test_jaccard_empty(spark):
    assert jaccard_components(helpers.empty_docs(spark)).collect() == []


def test_shingles_are_whole_and_distinct():
    texts = [r[1] or "" for r in helpers.edge_rows()]
    for size in (1, 4, 5):
        sets = list(Shingler(size).sets([t.encode() for t in texts]))
        assert [len(s) for s in sets] == [len(helpers.shingles(t, size)) for t in texts]
        for a, s in zip(texts, sets):
            for b, r in zip(texts, sets):
                assert len(set(s.tolist()) & set(r.tolist())) == len(helpers.shingles(a, size) & helpers.shingles(b, size))


def test_tree_finds_what_all_pairs_find():
    import numpy as np
    rng = np.random.default_rng(3)
    sets = []
    for _ in range(60):
        base = rng.integers(0, 2**63, 50, dtype=np.uint64)
        for _ in range(rng.integers(1, 6)):
            s = base.copy()
            s[rng.integers(0, 50, rng.integers(0, 9))] = rng.integers(0, 2**63, dtype=np.uint64)
            sets.append(np.unique(s[:rng.integers(40, 51)]))
    n = len(sets)
    groups, want = Groups(range(n)), Groups(range(n))
    tree_links(sets, list(range(n)), list(range(n)), groups, 80)
    for i in range(n):
        for j in range(i):
            if similar(sets[i], sets[j], 80):
                want.union(i, j)
    same = lambda g: {frozenset(i for i in range(n) if g.find(i) == g.find(k)) for k in range(n)}
    assert same(groups) == same(want)
    left, right = list(range(0, n, 2)), list(range(1, n, 2))
    groups = Groups(range(n))
    links = tree_links(sets, left, right, groups, 80)
    assert all(similar(sets[i], sets[j], 80) for i, j in links)
    assert all(groups.find(i) == groups.find(j) for i in left for j in right if similar(sets[i], sets[j], 80))


def brute_spans(rows, least):
    """Word by word, without units: stretches of ``least`` words that stand earlier, too, as offsets; those that meet are one."""
    seen, out = set(), set()
    for doc, text in sorted(rows):
        ws = [(m.start(), m.end(), m[0].lower()) for m in re.finditer(r"\S+", text or "")]
        covered = set()
        for i in range(len(ws) - least + 1):
            gram = tuple(w[2] for w in ws[i:i + least])
            if gram in seen:
                covered |= set(range(i, i + least))
            seen.add(gram)
        for i in covered:
            if i - 1 not in covered:
                j = i
                while j + 1 in covered:
                    j += 1
                out.add((doc, ws[i][0], ws[j][1], j - i + 1))
    return out


def test_copies_of_51_words_are_found_and_covered_whole(spark):
    rng = random.Random(51)
    few, many = ["".join(rng.choice("abcdefgh") for _ in range(rng.randrange(1, 8))) for _ in range(60)], [f"w{i}" for i in range(5000)]
    rows = []
    for k in range(300):
        words, joint = (few, many)[k % 2], (" ", " ", " ", "  ", "\n")[:1 + k % 5]
        text = lambda n: "".join(rng.choice(words) + rng.choice(joint) for _ in range(n))
        passage = text(rng.randrange(51, 70))
        rows += [(10 * k + i, text(rng.randrange(80)) + f"x{k}{i} " + passage + f"y{k}{i} " + text(rng.randrange(80))) for i in (2, 5, 9)]
    got = sd.repeated_spans(spark.createDataFrame(rows, "doc_id long, text string").repartition(7)).collect()
    want = brute_spans(rows, 51)
    assert len(want) == 600
    assert {(r.doc_id, r.start, r.end, r.n_words) for r in got} == want
    assert all(r.doc_id // 10 * 10 + 2 in r.first_doc_ids for r in got)  # short units may stand earlier elsewhere


def test_ends_of_runs_are_what_a_walk_over_the_units_finds():
    import numpy as np
    rng = random.Random(53)
    for _ in range(200):
        units, place = [], 0
        for _ in range(rng.randrange(1, 50)):
            place += rng.choice((1, 1, 1, 1, 2))
            units.append((7 << 32 | place << 5 | rng.randrange(1, 17), rng.choice((1, 2, 2)), rng.randrange(2) << 32 | place + rng.choice((5, 5, 9)) << 5 | 3))
        runs = [[units[0]]]
        for u in units[1:]:
            runs[-1].append(u) if u[0] >> 5 == (runs[-1][-1][0] >> 5) + 1 else runs.append([u])
        want = []
        for run in runs:
            if sum(t & 31 for t, _, _ in run) < 21:
                continue
            step = [(d, f >> 32, (f >> 5 & 0x7FFFFFF) - (t >> 5 & 0x7FFFFFF)) for t, d, f in run]
            words = {s: sum(u[0] & 31 for u, x in zip(run, step) if x == s) for s in step}
            good = [i for i, s in enumerate(step) if words[s] >= min(16, max(words.values()))]
            for side, k, outside in ((0, good[0], run[:good[0]]), (1, good[-1], run[good[-1] + 1:])):
                want.append((side, run[k][0] >> 5 & 0x7FFFFFF, sum(u[0] & 31 for u in outside), run[0][0] >> 5 & 0x7FFFFFF, len(run), sorted({u[1] for u in run}), run[k][1]))
        got = sd._run_ends(np.zeros(len(units), np.int64), *np.array(units, np.int64).T, 21)
        rows = [] if got is None else zip(*[np.asarray(got[c]).tolist() if c != "firsts" else got[c].to_pylist()
                                            for c in ("side", "unit", "gap", "run", "n_units", "firsts", "a_doc")])
        assert sorted(want) == sorted(rows)


def test_cuts_depend_on_the_words_around_alone():
    rng = random.Random(52)
    hashes = sd.Hashes()
    for k in range(300):
        passage = [rng.choice("ab" if k % 3 else "abcdefghijklmnop") for _ in range(51)]
        cut = []
        for _ in range(2):
            before, after = ([rng.choice("abcxyz") for _ in range(rng.randrange(30))] for _ in range(2))
            w = sd.Words([" ".join(before + passage + after)], hashes)
            first, end = w.units()
            assert (end - first).max() <= sd.WINDOW and list(first[1:]) == list(end[:-1]) and end[-1] == len(w.line)
            cut.append({i - len(before) for i in end if 2 * sd.WINDOW <= i - len(before) <= 51 - 2 * sd.WINDOW + 2})
        assert cut[0] == cut[1] and cut[0]


def test_substring_dedup(spark):
    rng = random.Random(9)
    word = lambda: "".join(rng.choice("abcdefgh") for _ in range(rng.randrange(2, 9)))
    text = lambda n: " ".join(word() + rng.choice(["", "", "", ".", ",\n"]) for _ in range(n))
    passage = text(56)
    rows = [(i, text(rng.randrange(0, 300))) for i in range(60)]
    planted = [3, 17, 29, 44]
    for i in planted:
        w = rows[i][1].split(" ")
        k = rng.randrange(len(w) + 1)
        rows[i] = (i, " ".join(w[:k] + [passage] + w[k:]))
    rows += [(100, rows[5][1] + " more"), (101, None), (102, "")]
    got = sd.repeated_spans(spark.createDataFrame(rows, "doc_id long, text string").repartition(5)).collect()
    assert {(r.doc_id, r.start, r.end, r.n_words) for r in got} == brute_spans(rows, 28)
    assert {r.doc_id for r in got if r.doc_id < 100} == set(planted[1:])
    texts = dict(rows)
    for r in got:  # offsets are those of the original text
        assert " ".join(texts[r.doc_id][r.start:r.end].split()).lower() in " ".join(" ".join(texts[d] for d in texts if d < r.doc_id and texts[d]).split()).lower()
        assert r.first_doc_ids and all(d < r.doc_id for d in r.first_doc_ids)


def test_substring_dedup_edges(spark):
    rows = [(r[0], r[1]) for r in helpers.edge_rows()]
    got = sd.repeated_spans(helpers.edge_docs(spark)).collect()
    assert {13, 14, 5, 6} <= {r.doc_id for r in got} and not {7, 8, 9, 15, 2**62} & {r.doc_id for r in got}
    assert all(r.n_words >= 28 and r.start < r.end for r in got) and len(rows) > 0
    assert sd.repeated_spans(helpers.empty_docs(spark)).collect() == []


def test_smith_waterman_against_plain_dynamic_programming():
    import numpy as np
    rng = random.Random(10)
    for _ in range(200):
        a, b = ([rng.randrange(1, 5) for _ in range(rng.randrange(1, 12))] for _ in range(2))
        h = [[0] * (len(b) + 1) for _ in range(len(a) + 1)]
        for i in range(1, len(a) + 1):
            for j in range(1, len(b) + 1):
                h[i][j] = max(0, h[i - 1][j - 1] + (1 if a[i - 1] == b[j - 1] else -1), h[i - 1][j] - 1, h[i][j - 1] - 1)
        score, start, end = dc.smith_waterman(np.array(a), np.array(b))
        assert score == max(map(max, h)) and (not score or dc.smith_waterman(np.array(a), np.array(b[start:end]))[0] == score)


def test_decontamination(spark):
    rng = random.Random(12)
    word = lambda: "".join(rng.choice("abcdefghij") for _ in range(rng.randrange(2, 6)))
    items = [(i, " ".join(word() for _ in range(rng.randrange(15, 40)))) for i in range(12)] + [(90, None), (None, "x y z w"), (91, "..."), (92, "zzz yyy")]
    rows = [(i, " ".join(word() for _ in range(rng.randrange(20, 200)))) for i in range(120)]
    planted = set()

    def plant(doc, item, edit):
        w = items[item][1].split()
        for k in range(4, len(w), edit or 10**6):
            w[k] = "edited"
        t = rows[doc][1].split()
        at = rng.randrange(len(t))
        rows[doc] = (doc, " ".join(t[:at] + [", ".join([" ".join(w[:5]).upper(), " ".join(w[5:])])] + t[at:]))
        planted.add((doc, item))

    for doc in range(0, 60):
        plant(doc, 0, 0)  # one item in a third of all documents
    for k, doc in enumerate(range(60, 80)):
        plant(doc, 1 + k % 11, (0, 9, 7)[k % 3])
    rows += [(500, None), (501, ""), (None, items[2][1]), (502, "so zzz yyy so")]
    docs = spark.createDataFrame(rows, "doc_id long, text string").withColumn("item_id", __import__("pyspark").sql.functions.lit("clash")).repartition(4)
    bench = spark.createDataFrame(items, "item_id long, text string")
    got = dc.contaminated_passages(docs, bench).collect()
    want = planted | {(None, 2), (502, 92)}
    assert {(r.doc_id, r.item_id) for r in got} == want
    # brute force: every item against every whole document
    block = dc.Items([x for x in items if x[0] is not None and x[1]])
    brute = {(d, block.ids[k]) for d, t in rows for k, w in enumerate(block.words)
             if len(ids := block.ids_of(t or "")) and dc.smith_waterman(w, ids)[0] >= 0.5 * len(w)}
    assert brute == want
    texts = dict(rows)
    for r in got:
        passage = dc.WORD.findall(texts[r.doc_id][r.start:r.end].lower())
        assert {*passage} & {*dc.WORD.findall(dict((i, t) for i, t in items)[r.item_id].lower())}
    clean = dc.drop_contaminated(docs, bench)
    assert {r.doc_id for r in clean.collect()} == {d for d, _ in rows} - {d for d, _ in want} and clean.columns == docs.columns
    assert dc.contaminated_passages(helpers.empty_docs(spark), bench).collect() == []
    assert dc.contaminated_passages(docs, bench.limit(0)).collect() == []


def test_decontamination_in_blocks(spark, monkeypatch):
    items = [(i, f"w{i}a w{i}b w{i}c w{i}d w{i}e w{i}f w{i}g") for i in range(9)]
    docs = spark.createDataFrame([(i, f"x y {t} z") for i, t in items], "doc_id long, text string")
    bench = spark.createDataFrame(items, "item_id long, text string")
    blocks = list(dc.item_blocks(docs, bench, "text", "item_id", "text", block_bytes=60))
    assert len(blocks) > 2 and sorted(i for b, _ in blocks for i in b.ids) == list(range(9))


def test_offsets_when_lower_case_is_longer():
    text = "İİ alpha beta gamma delta epsilon zeta"
    block = dc.Items([(1, "alpha beta gamma delta epsilon zeta")])
    (row,) = dc.leaks(text, block, set(block.grams), 0.5)
    assert text[row[2]:row[3]] == "alpha beta gamma delta epsilon zeta"
