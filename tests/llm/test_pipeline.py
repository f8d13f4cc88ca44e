"""The pipeline's stages against plain-Python versions, each on its own input."""

from collections import Counter

import corpus_pipeline as cp
from hiresight.llm import decontaminate, langid
from hiresight.llm.common import stage

from . import helpers
from .test_text_and_models import check_packing

COLUMNS = cp.COLUMNS
SF = "/root/testdata/sf0.001"


def rows_of(df):
    return Counter(tuple(r) for r in df.collect())


def test_stages(spark):
    assert [n for n, _ in cp.STAGES] == ["language_id", "line_dedup", "jaccard_join", "decontamination", "packing"]
    docs = spark.read.parquet(f"{SF}/documents.parquet")
    extra = spark.createDataFrame([(10**6, None, None, "s", 0), (10**6 + 1, "12 34 !", None, "s", 7), (10**6 + 2, "", "en", None, None)], docs.schema)
    docs = stage(docs.unionByName(extra), "test-docs")
    functions = dict(cp.STAGES)

    got = stage(functions["language_id"](spark, docs, SF), "test-1")
    assert got.columns == COLUMNS
    assert rows_of(got) == Counter(r for r in map(tuple, docs.collect()) if langid.has_letter(r[1]))

    before = got.collect()
    got = stage(functions["line_dedup"](spark, got, SF), "test-2")
    want = {i: t for i, _, _, t in helpers.line_dedup([(r.doc_id, r.text) for r in before])}
    assert rows_of(got) == Counter((r.doc_id, want[r.doc_id], r.lang, r.source, len(want[r.doc_id])) for r in before)

    before = [tuple(r) for r in got.collect()]
    got = stage(functions["jaccard_join"](spark, got, SF), "test-3")
    keep = {i for i, _, low in helpers.jaccard_components([(r[0], r[1]) for r in before], 5, 80) if i == low}
    assert rows_of(got) == Counter(r for r in before if r[0] in keep) and len(keep) < len(before)

    before = [tuple(r) for r in got.collect()]
    got = stage(functions["decontamination"](spark, got, SF), "test-4")
    items = decontaminate.Items([tuple(r) for r in spark.read.parquet(f"{SF}/benchmark.parquet").select("item_id", "text").collect()])
    clean = []
    for r in before:
        ids = items.ids_of(r[1])
        # Smith-Waterman can't score more than the item words that the text has
        if not any(sum(min(a, b) for a, b in ((n, (ids == w).sum()) for w, n in Counter(x.tolist()).items())) >= 0.5 * len(x)
                   and decontaminate.smith_waterman(x, ids)[0] >= 0.5 * len(x) for x in items.words):
            clean.append(r)
    assert rows_of(got) == Counter(clean) and len(clean) < len(before)

    packed = functions["packing"](spark, got, SF).collect()
    assert check_packing([(r[0], r[1]) for r in clean], packed, 1024) > 0.97


def test_empty_table(spark):
    docs = spark.read.parquet(f"{SF}/documents.parquet").limit(0)
    for _, f in cp.STAGES:
        docs = stage(f(spark, docs, SF), "test-empty")
    assert docs.count() == 0


def test_queries_are_registered():
    import __spark_entry__ as e
    names = e.queries().keys()
    assert "pipeline" in names and all(sum(x.startswith(f"op{n}_") for x in names) == 1 for n in range(1, 14))
    assert set(e.oracle_sql()) <= set(names)


def test_near_duplicates_tell_rows_by_id_and_text(spark):
    """Unrelated texts under one id all stay; of equal rows one does."""
    a, b, c = (" ".join(f"{x}{i}" for i in range(40)) for x in "abc")
    near = c.replace("c39", "other")
    rows = [(60, a), (60, b), (59, b), (1, c), (1, c), (7, near), (None, a), (None, "nothing like the others at all here"), (8, None), (8, None), (9, ""), (9, "  ")]
    docs = spark.createDataFrame([(i, t, "en", "s", 1) for i, t in rows], "doc_id long, text string, lang string, source string, n_chars long").repartition(3)
    got = sorted(((r.doc_id, r.text) for r in dict(cp.STAGES)["jaccard_join"](spark, docs, SF).collect()), key=repr)
    want = [(60, a), (59, b), (1, c), (None, "nothing like the others at all here"), (8, None), (9, ""), (9, "  ")]
    assert got == sorted(want, key=repr)
