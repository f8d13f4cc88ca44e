"""The node table against the standard parser, and its rules on hand-made pages."""

import random
import time
from html.parser import HTMLParser
from urllib.parse import urljoin

import pytest
from pyspark.sql import functions as F

from hiresight.functions import html as H
from hiresight.operators import nodes as N


class Plain(HTMLParser):
    """Elements and texts of well-formed pages: (tag, depth, texts inside)."""

    def __init__(self):
        super().__init__()
        self.stack, self.found = [], []

    def handle_starttag(self, tag, attrs):
        node = [tag, len(self.stack), dict(attrs).get("class"), []]
        self.found.append(node)
        if tag not in N.VOID:
            self.stack.append(node)

    def handle_startendtag(self, tag, attrs):
        self.handle_starttag(tag, attrs)

    def handle_endtag(self, tag):
        self.stack.pop()

    def handle_data(self, data):
        for line in data.split("\n"):
            if line.split():
                for n in self.stack:
                    n[3].append(" ".join(line.split()))


def random_page(rng, depth=0):
    out = []
    for _ in range(rng.randrange(1, 5)):
        tag = rng.choice(["div", "span", "section", "b", "i", "br", "img"])
        if tag in N.VOID or depth > 6:
            out.append(rng.choice(["<br>", "<img class='a>b'/>", "text ", "more\n &amp; text", "<!-- <div> -->"]))
        else:
            out.append(f'<{tag} class="c{rng.randrange(9)}" data-x=\'">\'>{random_page(rng, depth + 1)}</{tag}>')
    return "".join(out)


def test_fold_equals_the_standard_parser():
    rng = random.Random(4)
    for _ in range(200):
        page = random_page(rng)
        plain = Plain()
        plain.feed(page)
        plain.close()
        nodes, lines = N.fold(page)
        assert [(n[5], n[4], n[6], lines[n[8]:n[9]]) for n in nodes] == [tuple(x) for x in plain.found]
        for i, n in enumerate(nodes):  # intervals nest; parents and places agree with them
            assert n[0] == i and i <= n[1]
            above = [m for m in nodes if m[0] < i <= m[1]]
            assert n[2] == (above[-1][0] if above else -1) and n[4] == len(above)
            assert n[3] == (sum(m[2] == n[2] and m[0] <= i for m in nodes) if above else 0)


def test_fold_of_malformed_pages():
    nodes, lines = N.fold("<ul><li>a<li>b<b>c</ul><p>d<p>e<div>f</span></div></b> tail <table><tr><td>1<td>2<tr><td>3</table><")
    inside = lambda tag: [lines[n[8]:n[9]] for n in nodes if n[5] == tag]
    assert inside("li") == [["a"], ["b", "c"]] and inside("p") == [["d"], ["e"]] and inside("div") == [["f"]]
    assert inside("tr") == [["1", "2"], ["3"]] and inside("td") == [["1"], ["2"], ["3"]] and lines[-1] == "<"
    assert N.fold("") == ([], []) and N.fold("a < b")[1] == ["a", "<", "b"]
    assert N.fold("<script>var x = '<p>no</p>'</script >yes<style>p{}")[1] == ["yes"]
    assert N.fold("<a href='x>two")[0] == []


@pytest.mark.parametrize("piece", ["<p ", "<a href=\"", "<div>", "</div>", "<li>", "<!-", "<!--", "<a 'b ", "<", "&", "<script>", "<p>x"])
def test_fold_is_linear(piece):
    began = time.time()
    N.fold(piece * (1_000_000 // len(piece)) if piece not in ("<div>", "<li>", "<p>x") else piece * 100_000)
    assert time.time() - began < 8


def test_resolve_like_urljoin(spark):
    pages = ["https://h.example/a/b/list?page=2", "https://h.example", "http://h.example/a/b/", "https://h.example/x#top"]
    hrefs = ["/detail-jobs/1?x=1#y", "detail/1", "../up/1", "../../../up", "./here/./2", "https://other.example/z;p?q", "//cdn.example/w", "?page=3", "#f", "", "a/../b", "/a/b/../c/", ".."]
    df = spark.createDataFrame([(p, h) for p in pages for h in hrefs], "p string, h string")
    for r in df.select("p", "h", H.resolve(F.col("p"), F.col("h")).alias("u")).collect():
        want = urljoin(r.p, r.h).split("#")[0].split("?")[0]
        want = want.rsplit("/", 1)[0] + "/" + want.rsplit("/", 1)[1].split(";")[0] if want.count("/") > 2 else want
        assert r.u.rstrip("/") == want.rstrip("/"), (r.p, r.h, r.u, want)


FILLER = "words that fill the card so that it has more than fifty characters"


def list_frame(spark, *pages):
    return spark.createDataFrame([(i, f"https://h.example/list/{i}", p, "t") for i, p in enumerate(pages)], "page_id int, url string, html string, text string")


def test_cards_with_nested_containers_and_ten_levels(spark):
    def deep(levels, form):
        return f"<article>USD {FILLER} <span>{form}</span>{'<div>' * levels}<a href='/detail-jobs/{levels}'>Job {levels}</a>{'</div>' * levels}</article>"

    nested = (f"<div class='rounded-xl'><span>Remote</span>{FILLER}<div class='rounded-xl'>{FILLER}<a href=\"/detail-jobs/in\">Inner</a><span>Hybrid</span></div>"
              f"<a href='/detail-jobs/out'>Outer</a></div>")
    grid = (f"<div class='rounded-xl'><a href='../detail-jobs/g'>Grid</a>{FILLER}<span>Contract</span><div class='grid grid-cols-2'><p><span>Remote</span></p>"
            f"<span>Onsite and</span><span>Parttime</span></div></div>")
    other = "<a href='/detail-jobs/out'>Again</a><a href='/company/1'>Company</a><a href='/detail-jobs/x'> Apply  now </a><a href='/detail-jobs/e'></a><p>USD <a href='/detail-jobs/p'>P</a></p>"
    got = {r.source_url.rsplit("/", 1)[1]: (r.title, r.first_page, r.working_form)
           for r in N.cards(list_frame(spark, deep(9, "Fulltime") + deep(10, "Fulltime"), nested + grid, None, other)).collect()}
    assert got == {"9": ("Job 9", 0, "Fulltime"), "10": ("Job 10", 0, ""), "in": ("Inner", 1, "Hybrid"), "out": ("Outer", 1, "Remote"),
                   "g": ("Grid", 1, "Parttime"), "p": ("P", 3, "")}


def test_labelled_values_of_siblings_and_parents(spark):
    pages = ["<div><label>Field</label><em></em><b>Apply now</b><b>Industry</b><i>Bank<i>ing</i></i></div>",  # fourth sibling
             "<div><span>Field</span><b></b><b></b><b></b><b></b><b>Too far</b></div>",  # the parent has it
             "<div><p>Industry : Retail</p></div>", "<p>Industry: <b>Game</b> studio</p>", "<p>Industrial field</p>", None, "",
             "<p>before</p><div>Industry</div><div>Next</div>", "<label>Company</label><span>INDUSTRY</span> <span>Upper</span>",
             "<td>Field</td><td>Line value</td>"]
    got = {r.page_id: r.value for r in N.labelled_values(list_frame(spark, *pages), ["Industry", "Field"]).collect()}
    assert got == {0: "Bank ing", 1: "Too far", 2: "Retail", 3: "Game studio", 4: "", 5: "", 6: "", 7: "Next", 8: "Upper", 9: "Line value"}


def test_header_fields_stay_in_the_header(spark):
    related = "<div><a href='/detail-jobs/9'>Other</a><p>9 USD</p><p>x</p><p>y</p><p>z</p></div>"
    own = "<div><h2><a href='/detail-jobs/0'>Job <b>0</b></a></h2><p>1 USD</p><p>Hanoi</p><p>Save this job</p><p>Job 0</p><p>Senior</p><p>3 years</p><p>Benefits</p><p>no</p></div>"
    df = spark.createDataFrame([(0, "https://h.example/detail-jobs/0?x", related + own), (1, "https://h.example/a", own), (2, "https://h.example/b", "<h1>T</h1><p>a</p>"),
                                (3, "https://h.example/c", None)], "page_id int, url string, html string")
    got = {r.page_id: tuple(r)[1:] for r in N.header_fields(df).collect()}
    assert got[0] == got[1] == ("Job 0", "1 USD", "Hanoi", "Senior", "3 years")
    assert got[2] == ("T", "", "", "", "") and got[3] == ("",) * 5


def test_no_pages(spark):
    empty = list_frame(spark, "x").limit(0)
    assert N.cards(empty).collect() == [] and N.labelled_values(empty, ["Field"]).collect() == [] and N.header_fields(empty).collect() == []


def test_links_of_any_quotes_and_steps(spark):
    page = ("<a class=x href='/detail-jobs/1?a=1'>a</a><A HREF=\"../detail-jobs/2#t\">b</A><a href=/detail-jobs/3>c</a><a href='https://h.example/detail-jobs/1'>a</a>"
            "<a href='https://other.example/detail-jobs/9'>o</a><a href='mailto:x@y'>m</a><a data-href='/no' title='x'>n</a><a href='/about'>z</a><script><a href='/s'></script>")
    df = spark.createDataFrame([("https://h.example/list/p", page)], "u string, h string")
    (r,) = df.select(H.html_links("h", "u").alias("all"), H.html_links("h", "u", "^/detail-jobs/").alias("jobs")).collect()
    assert r.jobs == [f"https://h.example/detail-jobs/{i}" for i in (1, 2, 3)] and r.all == ["https://h.example/about", *r.jobs]


def test_node_joins_are_dealt_out_by_page(spark):
    n = N.node_table(list_frame(spark, "<div><a href='/detail-jobs/1'>Job</a></div>", "<h1>T</h1>"), keep=("url",))
    for df in (n.with_texts(n.elements), n.above(n.elements, 3), n.inside(n.elements, ["a"]), N.by_key(n.elements, n.pages, "page_id", "left_anti")):
        plan = df._jdf.queryExecution().sparkPlan().toString()
        assert "SortMergeJoin" in plan and "Broadcast" not in plan


def test_pages_that_share_a_key_or_have_none(spark):
    page = "<div><span>Field</span><b>Bank</b></div>"
    df = spark.createDataFrame([(1, page), (1, page), (None, page), (2, "<p>Field: Retail</p>")], "page_id int, html string")
    got = sorted((r.page_id or 0, r.value) for r in N.labelled_values(df, ["Field"]).collect())
    # texts of pages that share a key run together ("Field Field" is no label), so these are read by lines
    assert got == [(0, "Bank"), (1, "Bank"), (1, "Bank"), (2, "Retail")]


def test_elements_by_column_equal_the_fold(spark):
    pages = ["<p class=a>x<b>y</b></p>z", "", None, "<a href='/q'>t</a>"]
    rows = N.node_table(list_frame(spark, *pages)).elements.orderBy("page_id", "node").collect()
    assert [tuple(r) for r in rows] == [(i, *n) for i, p in enumerate(pages) for n in N.fold(p or "")[0]]


def test_rules_read_pages_where_they_are_folded(spark):
    pages = list_frame(spark, "<div class='rounded-xl'>" + FILLER + "<a href='/detail-jobs/1'>Job</a></div>", "<h1>T</h1><p>Field: x</p>")
    for df, exchanges in ((N.labelled_values(pages, ["Field"]), 0), (N.header_fields(pages), 0), (N.cards(pages), 1)):
        plan = df._jdf.queryExecution().executedPlan().toString()
        assert "MapInArrow" in plan and "Join" not in plan and plan.split("Initial Plan")[0].count("Exchange") == exchanges


HREFS = ["/detail-jobs/1", "/detail-jobs/2?x#y", "../detail-jobs/3", "detail-jobs/4;a", "//h.example/detail-jobs/5", "javascript:x", "", "?q", "/detail-jobs/8/..", "/detail-jobs/9?a\nb", "HTTP://h.example/detail-jobs/7"]
LINES = ["Industry", "Field:", "Industry: Bank", "Lĩnh vực", "LĨNH VỰC: Y", "Apply now", "Remote", "hybrid", "10 USD", "5 triệu", "Negotiable", "Hanoi", "Senior", "Benefits", "Job", FILLER, "VND", "x" * 200, "a &amp;\nb"]


def random_rule_page(rng, depth=0):
    out = []
    for _ in range(rng.randrange(1, 5)):
        r, tag = rng.random(), rng.choice(["div", "article", "span", "span", "p", "label", "b", "h1"])
        if r < 0.4 or depth > 5:
            out.append(rng.choice(LINES))
        elif r < 0.55:
            out.append(f"<a href='{rng.choice(HREFS)}'>{rng.choice(LINES)}</a>")
        else:
            out.append(f"<{tag}{rng.choice(['', '', ' class=rounded-xl', ' class=\"grid grid-cols-3\"'])}>{random_rule_page(rng, depth + 1)}</{tag}>")
    return "".join(out)


def test_rules_by_page_equal_rules_by_joins(spark):
    rng = random.Random(11)
    urls = ["https://h.example/detail-jobs/1?x", "https://h.example/list/a", "https://h.example", None]
    rows = [(i, rng.choice(urls), random_rule_page(rng) if i % 50 else None) for i in range(400)]
    df, labels = spark.createDataFrame(rows, "page_id int, url string, html string"), ["Industry", "Field", "Lĩnh vực"]
    of = lambda d: sorted(map(str, d.select(*sorted(d.columns)).collect()))
    links = of(N.card_links(df, "page_id", "html", "url", "^/detail-jobs/", 3))
    assert len(links) > 50 and links == of(N._shared_card_links(df, "page_id", "html", "url", "^/detail-jobs/", 3))
    assert of(N.labelled_values(df, labels)) == of(N._shared_labelled_values(df, labels, "page_id", "html", 160, 4))
    assert of(N.header_fields(df)) == of(N._shared_header_fields(df, "page_id", "html", "url", "^/detail-jobs/", 12))


def test_links_and_salary_lines_of_a_page_equal_the_columns(spark):
    urls = ["https://h.example/a/b/list?page=2", "https://h.example", "http://h.example/a/b/#t", "h.example", "https:/x", None]
    hrefs = [*HREFS, "/a/.\n", "a;b\n/c", "x?y\r\n", " /z ", "\t/z", "..", "./", "/a?b c", "HTTPS://x/y;z?q", "//w/;p"]
    df = spark.createDataFrame([(u, h) for u in urls for h in hrefs], "u string, h string")
    for r in df.select("u", "h", H.resolve(F.col("u"), F.col("h")).alias("link"), H.path_of(H.resolve(F.col("u"), F.col("h"))).alias("path")).collect():
        link = N.resolver(r.u)(r.h)
        assert link == r.link and (link is None or N._path(link) == r.path), (r.u, r.h)
    lines = [*(" ".join(s.split()) for s in LINES), "THOẢ THUẬN", "usd", "1 vnd" + "x" * 115, "1 vnd" + "x" * 116, "٣ usd", "Login to view salary"]
    for r in spark.createDataFrame([(s,) for s in lines], "s string").select("s", H.line_is_salary(F.col("s")).alias("is")).collect():
        assert N.line_is_salary(r.s) == r["is"], r.s


def test_cards_and_headers_of_pages_that_share_a_key(spark):
    one, two = "<h1>T</h1><p>5 USD</p>", "<div><a href='/detail-jobs/1'>Job</a><span>Remote</span></div>"
    df = spark.createDataFrame([(1, "https://h.example/l", one), (1, "https://h.example/l", one), (2, "https://h.example/l", two), (None, "https://h.example/l", two)],
                               "page_id int, url string, html string")
    # their texts run together; a page without a key has no elements
    assert sorted((r.page_id or 0, r.job_title) for r in N.header_fields(df).collect()) == [(0, ""), (1, "T T"), (1, "T T"), (2, "Job")]
    assert [tuple(r) for r in N.cards(df).collect()] == [("https://h.example/detail-jobs/1", "Job", 2, "Remote")]


def test_fold_goes_on_after_silent_elements():
    nodes, lines = N.fold("a<script>'<p>'</script><b>c</b><style>x</style>d<noscript><i></noscript >e<template>")
    assert [n[5] for n in nodes] == ["script", "b", "style", "noscript", "template"] and lines == ["a", "c", "d", "e"]
