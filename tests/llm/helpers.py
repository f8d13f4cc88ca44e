"""Small tables with every awkward row, and plain-Python versions of the operators."""

import random
import zlib
from collections import Counter, defaultdict

LONG = ("lorem ipsum dolor sit amet " * 40 + "\n") * 60
DDL = "doc_id long, text string, lang string, source string, n_chars long, rid long, kind string, k1 long, row long, pos int, digest string, gid long"


def edge_rows():
    words = "alpha beta gamma delta epsilon zeta eta theta iota kappa lambda mu nu xi omicron pi rho sigma tau upsilon".split()
    rng = random.Random(5)
    text = lambda n: " ".join(rng.choice(words) for _ in range(n))
    base = [text(60) for _ in range(6)]
    line = "This very line is repeated in many of the documents of this table"
    rows = [
        (1, None, None), (2, "", "en"), (3, "", None), (None, None, "en"), (None, "orphan text without id", None),
        (4, base[0], "en"), (5, base[0].upper(), "en"), (5, base[0].upper(), "en"), (6, base[0], None),
        (7, "one", "en"), (8, "one two", "en"), (9, "ONE two", "en"), (10, "  \t\n ", "en"), (11, "1234 5678", "en"),
        (12, LONG, "en"), (13, LONG + "x", "en"), (-3, base[1] + " extra", "en"), (14, base[1], "en"),
        (15, "Ünïcödé ÄÖÜ 漢字 🙂 <|endoftext|> end x", "de"), (16, "\n\n" + line + "\n\n", "en"), (2**62, base[2], "en"),
    ]
    rows += [(20 + i, text(8) + "\n  " + line.upper() + " \t\n" + text(5), "en") for i in range(7)]
    rows += [(40 + i, " ".join(w if k != 7 * i else "changed" for k, w in enumerate(base[3].split())), "en") for i in range(9)]
    rows += [(60, base[4], "en"), (60, base[5], "en"), (61, base[5], "en")]
    return [(i, t, lang, "src", None if t is None else len(t), 1, "k", 2, 3, 4, "d", 5) for i, t, lang in rows]


def edge_docs(spark):
    return spark.createDataFrame(edge_rows(), DDL).repartition(3)


def empty_docs(spark):
    return spark.createDataFrame([], DDL)


def lower(s):
    return "".join(chr(ord(c) + 32) if "A" <= c <= "Z" else c for c in s)


def fold(i, modulus):
    return zlib.crc32(("" if i is None else str(i)).encode()) % modulus


def shingles(text, size):
    w = (text or "").encode().lower().split()
    if len(w) < size:
        return frozenset([tuple(w)]) if w else frozenset()
    return frozenset(tuple(w[i:i + size]) for i in range(len(w) - size + 1))


def jaccard_components(rows, size, percent):
    """[(id, size of set, smallest id of the component)] by all pairs."""
    sets = [shingles(t, size) for _, t in rows]
    up = list(range(len(rows)))

    def find(x):
        while up[x] != x:
            x = up[x]
        return x

    for a in range(len(rows)):
        for b in range(a):
            x, y = sets[a], sets[b]
            if x and y and 100 * len(x & y) >= percent * len(x | y):
                up[find(a)] = find(b)
    low = defaultdict(list)
    for i, (doc, _) in enumerate(rows):
        if doc is not None:
            low[find(i)].append(doc)
    return Counter((doc, len(sets[i]), min(low[find(i)], default=None) if sets[i] else doc) for i, (doc, _) in enumerate(rows))


def line_dedup(rows, min_chars=40, min_docs=5):
    """[(id, lines, dropped, kept text)]."""
    space = " \t\n\x0b\x0c\r"
    key = lambda x: lower(x.strip(space))
    order = lambda i: (i is not None, i or 0)
    found = defaultdict(set)
    for i, t in rows:
        for x in (t or "").split("\n"):
            if len(key(x)) >= min_chars:
                found[key(x)].add(i)
    keep = {k: max(v, key=order) for k, v in found.items() if len(v) >= min_docs}
    out = []
    for i, t in rows:
        lines = (t or "").split("\n")
        kept = [x for x in lines if keep.get(key(x), i) == i]
        out.append((i, len(lines), len(lines) - len(kept), "\n".join(kept)))
    return out
