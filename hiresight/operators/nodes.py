"""Pages as interval-numbered nodes.

One fold over a page's tags gives a row for each element: ``node`` (its number in
page order), ``last`` (the number of the last element inside it), ``parent``,
``place`` (its position among its parent's elements), ``depth``, ``tag``,
``class``, ``href``, and ``t0``/``t1``: the lines of text inside it are those
numbered t0 to t1 - 1.  Lines of text are rows of their own (``ord``, ``text``),
so no text is stored twice.  An element lies inside another when its number lies
in the other's interval: container walks, children, siblings and texts are joins
on the page and on numbers.

The rules need one page at a time, so they read a page right after its fold, in
the task that folded it, and no element leaves it.  Only pages that share their
key are one page to the rules: their elements meet as tables, by joins.
"""

from __future__ import annotations

import html as _html
import itertools
import re
import sys
from collections.abc import Callable, Iterator
from dataclasses import dataclass

import pyarrow as pa
from pyspark import cloudpickle
from pyspark.sql import Column, DataFrame, Window
from pyspark.sql import functions as F
from pyspark.sql import types as T

from ..functions import html as H
from ..functions.constants import NOISE_LINES, SALARY_HEADER_EXACT, SALARY_HEADER_UNITS, SECTION_STOP_WORDS
from ..functions.text import text_clean
from ..session import materialise

# executors need not have this package: its functions travel with the tasks
cloudpickle.register_pickle_by_value(sys.modules[__name__])

# --- FIXED VALUES: elements without content, elements whose content isn't text, and what a start tag ends.
VOID = frozenset("area base br col embed hr img input link meta source track wbr".split())
SILENT = ("script", "style", "template", "noscript")
ENDS = {"li": ("li", ("ul", "ol")), "dt": ("dt dd", ("dl",)), "dd": ("dt dd", ("dl",)), "tr": ("tr td th", ("table",)),
        "td": ("td th", ("tr", "table")), "th": ("td th", ("tr", "table")), "option": ("option", ("select",))}
BLOCKS = frozenset("address article aside div dl fieldset footer form h1 h2 h3 h4 h5 h6 header hr main nav ol p pre section table ul".split())

#: a tag without quotes, a run of text, a comment, a tag (an attribute's unquoted part holds no '<'), or a lone '<'
TOKEN = re.compile(r"""</?[a-zA-Z][^<>"']*+>|[^<]++|<!--.*?(?:-->|\Z)|<[!?/]?[a-zA-Z](?:[^<>"']++|"[^"]*+"|'[^']*+')*+>|<""", re.DOTALL)
NAME = re.compile(r"</?([a-zA-Z][^\s/>]*)")
ATTRIBUTE = {a: re.compile(rf"""[\s"']{a}\s*=\s*(?:"([^"]*)"|'([^']*)'|([^\s>"']+))""", re.IGNORECASE) for a in ("class", "href")}
SILENT_END = {t: re.compile(rf"</{t}[\s>]", re.IGNORECASE) for t in SILENT}

FIELDS = ("node", "last", "parent", "place", "depth", "tag", "class", "href", "t0", "t1")


SKIPPED, END, PLAIN, MORE = range(4)
#: what short tags say: pages are made of few different ones
_TAGS: dict[str, tuple] = {}


def _tag(piece: str) -> tuple:
    """What a tag or comment says: (SKIPPED, END, PLAIN for a start tag, or MORE for one that ends others or stays empty; name, class, href)."""
    name = NAME.match(piece)
    tag, kind, values = name.group(1).lower() if name else "", SKIPPED, (None, None)
    if name and piece[1] == "/":
        kind = END
    elif name:
        kind = MORE if tag in ENDS or tag in BLOCKS or tag in VOID or tag in SILENT else PLAIN
        if "=" in piece:
            values = tuple(next((_html.unescape(g) for g in m.groups() if g is not None), "") if (m := r.search(piece)) else None for r in ATTRIBUTE.values())
    if len(piece) <= 64:
        if len(_TAGS) >= 4096:
            _TAGS.clear()
        _TAGS[piece] = (kind, tag, *values)
    return (kind, tag, *values)


def fold(page: str) -> tuple[list[list], list[str]]:
    """(elements, lines of text) of a page, in page order.

    Unclosed elements end with what holds them, or where HTML ends them (list
    items, table cells, options, paragraphs); end tags without a start are skipped.
    """
    nodes: list[list] = []
    lines: list[str] = []
    stack: list[list] = []  # the open elements
    open_: dict[str, int] = {}
    kids: list[int] = []
    number = 0

    def close(down_to: int) -> None:
        while len(stack) > down_to:
            n = stack.pop()
            n[1], n[9] = number - 1, len(lines)
            open_[n[5]] -= 1

    def end_of(names: str, inside: tuple[str, ...]) -> None:
        down_to = len(stack)
        for i in range(len(stack) - 1, -1, -1):
            tag = stack[i][5]
            if tag in inside:
                break
            if tag in names.split():
                down_to = i
        close(down_to)

    def pieces(at: int) -> Iterator[str]:
        nonlocal end
        for token in TOKEN.finditer(page, at):
            end = token.end()
            yield token.group()

    end, left = -1, iter(TOKEN.findall(page))  # all at once, and one by one after the first silent element
    while left:
        for piece in left:
            if piece[0] != "<" or piece == "<":
                for line in (_html.unescape(piece) if "&" in piece else piece).splitlines():
                    if words := line.split():
                        lines.append(" ".join(words))
                continue
            kind, tag, class_, href = _TAGS.get(piece) or _tag(piece)
            if kind == END:
                if stack and stack[-1][5] == tag:
                    n = stack.pop()
                    n[1], n[9] = number - 1, len(lines)
                    open_[tag] -= 1
                elif open_.get(tag):
                    i = len(stack) - 1
                    while stack[i][5] != tag:
                        i -= 1
                    close(i)
                continue
            if kind == SKIPPED:
                continue
            if kind == MORE:
                if tag in ENDS:
                    end_of(*ENDS[tag])
                elif open_.get("p") and tag in BLOCKS:
                    end_of("p", ("div", "li", "td", "th", "article", "section", "button"))
            text = len(lines)
            if stack:
                parent = stack[-1][0]
                place = kids[parent] = kids[parent] + 1
                node = [number, number, parent, place, len(stack), tag, class_, href, text, text]
            else:
                node = [number, number, -1, 0, 0, tag, class_, href, text, text]
            nodes.append(node)
            kids.append(0)
            number += 1
            if kind == MORE:
                if tag in SILENT:
                    end = len(page) - sum(map(len, left)) if end < 0 else end  # pieces leave nothing out
                    m = SILENT_END[tag].search(page, end)
                    left = pieces(page.find(">", m.start()) + 1 or len(page)) if m else None
                    break
                if tag in VOID:
                    continue
            stack.append(node)
            open_[tag] = open_.get(tag, 0) + 1
        else:
            break
    close(0)
    return nodes, lines


ELEMENT = T.StructType([T.StructField(n, T.StringType() if n in ("tag", "class", "href") else T.IntegerType()) for n in FIELDS])


def by_key(left: DataFrame, right: DataFrame, on, how: str = "inner") -> DataFrame:
    """A join dealt out by its key.  Node tables compress so well as files that their
    size on disk says nothing about a broadcast's size in memory, so none is broadcast."""
    return left.join(right.hint("merge"), on, how)


@dataclass
class Nodes:
    """The elements of pages, keyed by the page; ``pages``: the page with its lines of text
    (and its other kept columns) as an array; ``whole``: a row for each key with all its
    elements and numbered lines as arrays."""

    elements: DataFrame
    lines: DataFrame
    pages: DataFrame
    whole: DataFrame
    key: str

    def _held(self, rows: DataFrame, part: str) -> DataFrame:
        """(page, ``part`` of the page, row): rows meet their page once a page, not once a row."""
        k = self.key
        each = rows.groupBy(k).agg(F.collect_list(F.struct(*[F.col(c) for c in rows.columns if c != k])).alias("__rows"))
        return by_key(self.whole.select(k, F.col(part).alias("__part")), each, k)

    def with_texts(self, rows: DataFrame, lines: bool = False) -> DataFrame:
        """Rows of elements with ``text``: the lines inside joined by a blank, '' if
        there are none; or with ``lines``: their array."""
        k, rest = self.key, [c for c in rows.columns if c != self.key]
        texts = lambda r: F.transform(F.filter("__part", lambda l: (l["ord"] >= r["t0"]) & (l["ord"] < r["t1"])), lambda l: l["text"])
        own = lambda r: texts(r).alias("lines") if lines else F.array_join(texts(r), " ").alias("text")
        found = self._held(rows, "lines").select(k, F.explode(F.transform("__rows", lambda r: F.struct(r.alias("r"), own(r)))).alias("__x"))
        return found.select(k, *[F.col(f"__x.r.{c}").alias(c) for c in rest], "__x.lines" if lines else "__x.text")

    def _pairs(self, rows: DataFrame, fits, extra) -> DataFrame:
        """The elements of a row's page that ``fits(row, element)``, with the columns ``extra(row, element)``."""
        k = self.key
        of = lambda r: F.transform(F.filter("__part", lambda e: fits(r, e)), lambda e: F.struct(e.alias("e"), *extra(r, e)))
        found = self._held(rows, "elements").select(k, F.explode(F.flatten(F.transform("__rows", of))).alias("__x"))
        return found.select(k, "__x.e.*", "__x.*").drop("e")

    def above(self, rows: DataFrame, levels: int, own: bool = False) -> DataFrame:
        """(page, below, level, element) of the ancestors of elements, ``level`` steps up (1 is the parent; 0 the element itself, if ``own``)."""
        low = rows.select(self.key, F.col("node").alias("below"), "depth").distinct()
        level = lambda r, e: r["depth"] - e["depth"]
        held = lambda r, e: (e["node"] <= r["below"]) & (r["below"] <= e["last"]) & level(r, e).between(0 if own else 1, levels)
        return self._pairs(low, held, lambda r, e: [r["below"].alias("below"), level(r, e).alias("level")])

    def inside(self, rows: DataFrame, tags: list[str]) -> DataFrame:
        """(page, holder, element) of the elements with one of the tags that lie inside the given ones."""
        high = rows.select(self.key, F.col("node").alias("holder"), "last").distinct()
        held = lambda r, e: (e["node"] > r["holder"]) & (e["node"] <= r["last"]) & e["tag"].isin(tags)
        return self._pairs(high, held, lambda r, e: [r["holder"].alias("holder")])


def _elements(pages: list[list[list]], kind: pa.DataType) -> pa.Array:
    """The elements of pages as an array of structs for each page, built column by column."""
    columns = [*zip(*(n for nodes in pages for n in nodes))] or [()] * len(FIELDS)
    fields = [kind.value_type.field(i) for i in range(len(FIELDS))]
    flat = pa.StructArray.from_arrays([pa.array(c, f.type) for c, f in zip(columns, fields)], fields=fields)
    offsets = pa.array([0, *itertools.accumulate(map(len, pages))], pa.int32())
    return pa.ListArray.from_arrays(offsets, flat, type=kind)


def node_table(pages: DataFrame, key: str = "page_id", html: str = "html", keep: tuple[str, ...] = ()) -> Nodes:
    """Elements and lines of all pages, each written once, with the columns ``keep`` of the page.

    A null page has neither.  Pages that repeat a key are one page after the other
    only if the key names them apart, so keys must be unique."""
    schema = T.StructType([*[pages.schema[c] for c in (key, *keep)],
                           T.StructField("elements", T.ArrayType(ELEMENT)), T.StructField("lines", T.ArrayType(T.StringType()))])

    def run(batches: Iterator[pa.RecordBatch]) -> Iterator[pa.RecordBatch]:
        from pyspark.sql.pandas.types import to_arrow_schema

        out = to_arrow_schema(schema)
        for b in batches:
            found = [fold(p or "") for p in b.column(b.num_columns - 1).to_pylist()]
            yield pa.RecordBatch.from_arrays([
                *[b.column(i).cast(out.field(i).type) for i in range(b.num_columns - 1)],
                _elements([nodes for nodes, _ in found], out.field(b.num_columns - 1).type),
                pa.array([lines for _, lines in found], out.field(b.num_columns).type)], schema=out)

    folded = materialise(pages.select(key, *keep, html).mapInArrow(run, schema))
    numbered = F.transform("lines", lambda t, i: F.struct(i.alias("ord"), t.alias("text")))
    whole = folded.groupBy(key).agg(F.flatten(F.collect_list("elements")).alias("elements"),
                                    F.array_sort(F.flatten(F.collect_list(numbered))).alias("lines"))
    return Nodes(folded.select(key, F.explode("elements").alias("e")).select(key, "e.*"),
                 folded.select(key, F.posexplode("lines").alias("ord", "text")), folded.select(key, *keep, "lines"),
                 materialise(whole), key)


# ------------------------------------------------------------------ rules on nodes
# --- FIXED VALUES: link texts that are no titles, words of a card, its class.
NO_TITLES = ["apply now", "ứng tuyển ngay"]
CARD_WORDS = ["Fulltime", "Parttime", "Negotiable", "VND", "USD"]
CARD_CLASS = "rounded-xl"


def detail_links(nodes: Nodes, detail: str, url: str = "url") -> DataFrame:
    """Links to detail pages (path that matches ``detail``) with their ``text`` and ``link``, without empty ones and buttons."""
    a = nodes.elements.where((F.col("tag") == "a") & F.col("href").isNotNull() & ~F.col("href").rlike("(?i)^\\s*(javascript|mailto|tel|data):"))
    a = by_key(a, nodes.pages.select(nodes.key, F.col(url).alias("__url")), nodes.key).withColumn("link", H.resolve(F.col("__url"), F.col("href")))
    found = nodes.with_texts(a.where(H.path_of(F.col("link")).rlike(detail)))
    return found.where((F.col("text") != "") & ~F.lower("text").isin(NO_TITLES))


# --- addresses, as ``functions.html`` has them (resolve, path_of, url_normalise): a '$' of its patterns also stands before a last line end
_END = r"(?=(?:\r\n|[\n\r\x85\u2028\u2029])?\Z)"
_QUERY = re.compile(rf"[?#][^\n\r\x85\u2028\u2029]*{_END}")
_BASE = re.compile(r"(https?:)//[^/?#]+")
_FOLDER = re.compile(r"https?://[^/]+(/(?:[^/]*/)*)")
_PATH = re.compile(r"https?://[^/?#]+([^;?#]*)")
_OPEN_TAIL = re.compile(rf"(?:\A|/)(?:\.{{1,2}})?{_END}")
_FULL = re.compile("https?://", re.IGNORECASE | re.ASCII)
_NO_PAGE = re.compile(r"\s*(?:javascript|mailto|tel|data):", re.IGNORECASE | re.ASCII)


def _normalised(url: str) -> str:
    if "?" in url or "#" in url:
        url = _QUERY.sub("", url)
    return re.sub(r";[^/]*\Z", "", url) if ";" in url else url


def _path(url: str) -> str:
    m = _PATH.match(url)
    return m.group(1) if m else ""


def resolver(page_url: str | None) -> Callable[[str], str | None]:
    """href -> the absolute URL of a link on the page (None for a relative one on a page without URL)."""
    url = page_url or ""
    own = _QUERY.sub("", url)
    base, folder = _BASE.match(url), _FOLDER.match(own)
    host, scheme = (base.group(), base.group(1)) if base else ("", (re.match("https?:", url) or [""])[0])

    def resolve(href: str) -> str | None:
        h = href.strip(" ")
        if "?" in h or "#" in h:
            h = _QUERY.sub("", h)
        if h and _FULL.match(h):
            return _normalised(h)
        if page_url is None:
            return None
        if not h:
            return _normalised(own)
        if h.startswith("//"):
            return _normalised(scheme + h)
        path = h if h[0] == "/" else (folder.group(1) if folder else "/") + h
        steps, parts = [], [p for p in path.split("/") if p and p != "."]
        for p in parts:
            if p != "..":
                steps.append(p)
            elif steps:
                steps.pop()
        return _normalised(f"{host}/{'/'.join(steps)}{'/' if steps and _OPEN_TAIL.search(path) else ''}")

    return resolve


def page_links(nodes: list[list], lines: list[str], url: str | None, detail: re.Pattern) -> Iterator[tuple[list, str, str]]:
    """(element, link, text) of a page's links to detail pages, without empty ones and buttons."""
    resolve = None
    for n in nodes:
        if n[5] == "a" and n[7] is not None and n[8] < n[9] and not _NO_PAGE.match(n[7]):
            resolve = resolve or resolver(url)
            link = resolve(n[7])
            if link is not None and detail.search(_path(link)):
                text = " ".join(lines[n[8]:n[9]])
                if text.lower() not in NO_TITLES:
                    yield n, link, text


def by_page(pages: DataFrame, columns: list[str], kept: int, rule: Callable, schema: T.StructType, many: bool = False) -> DataFrame:
    """``rule(*columns, elements, lines)`` of every page, right after its fold; the last of ``columns`` is
    the page.  The first ``kept`` columns stand before what the rule returns: a row, or ``many`` (a list of rows)."""
    schema = T.StructType([*[pages.schema[c] for c in columns[:kept]], *schema.fields])

    def run(batches: Iterator[pa.RecordBatch]) -> Iterator[pa.RecordBatch]:
        from pyspark.sql.pandas.types import to_arrow_schema

        out = to_arrow_schema(schema)
        for b in batches:
            found, of = [], []
            for i, row in enumerate(zip(*(c.to_pylist() for c in b.columns))):
                got = rule(*row[:-1], *fold(row[-1] or ""))
                if many:
                    found.extend(got)
                    of.extend([i] * len(got))
                else:
                    found.append(got)
            same = [b.column(i).take(pa.array(of, pa.int32())) if many else b.column(i) for i in range(kept)]
            columns_ = [*zip(*found)] or [()] * (len(out) - kept)
            yield pa.RecordBatch.from_arrays([*[c.cast(out.field(i).type) for i, c in enumerate(same)],
                                              *[pa.array(c, out.field(kept + i).type) for i, c in enumerate(columns_)]], schema=out)

    return pages.select(*columns).mapInArrow(run, schema)


def apart(pages: DataFrame, key: str) -> tuple[DataFrame, DataFrame | None]:
    """(pages, None) if every key names one page; else the pages that have their key alone (or none), and the others."""
    again = materialise(pages.where(F.col(key).isNotNull()).groupBy(key).count().where("count > 1").select(key))
    if again.isEmpty():
        return pages, None
    return by_key(pages, again, key, "left_anti"), by_key(pages, again, key, "left_semi")


def cards(pages: DataFrame, key: str = "page_id", html: str = "html", url: str = "url", detail: str = "^/detail-jobs/", levels: int = 10) -> DataFrame:
    """One row a detail page that list pages link to: source_url, title, first_page, working_form.

    A link's card is the nearest div or article within ``levels`` steps up that has
    more than 50 characters and a card's words or class, else the link's parent.
    The working form is the first span of a grid inside the card, else the first
    span of the card, that is one ('' if none is).  The first link in order of
    (page, place on the page) counts.
    """
    alone, shared = apart(pages, key)
    all_ = card_links(alone.where(F.col(key).isNotNull()), key, html, url, detail, levels)
    if shared is not None:
        all_ = all_.unionByName(_shared_card_links(shared, key, html, url, detail, levels))
    first = all_.groupBy(F.col("link").alias("source_url")).agg(F.min(F.struct(F.col(key), F.col("node"), F.col("text"), F.col("form"))).alias("c"))
    return first.select("source_url", F.col("c.text").alias("title"), F.col(f"c.{key}").alias("first_page"),
                        H.working_form(F.array(F.coalesce(F.col("c.form"), F.lit("")))).alias("working_form"))


def card_links(pages: DataFrame, key: str, html: str, url: str, detail: str, levels: int) -> DataFrame:
    """(page, link, node, text, form) of the detail links of pages that have their key alone."""
    wanted, forms = re.compile(detail, re.ASCII), frozenset(k for k, _ in H.WORKING_FORMS)

    def rule(_key, address: str | None, nodes: list[list], lines: list[str]) -> list[tuple]:
        found, shown, form_of, spans = [], {}, {}, None

        def is_card(n: list) -> bool:
            if n[0] not in shown:
                text = " ".join(lines[n[8]:n[9]])
                shown[n[0]] = len(text) > 50 and (CARD_CLASS in (n[6] or "") or any(w in text for w in CARD_WORDS))
            return shown[n[0]]

        for n, link, text in page_links(nodes, lines, address, wanted):
            card, at = n[2], n[2]
            for _ in range(levels):
                if at < 0:
                    break
                up = nodes[at]
                if up[5] in ("div", "article") and is_card(up):
                    card = at
                    break
                at = up[2]
            if card not in form_of:
                if spans is None:  # the page's spans that name a form: (in a grid, element, text)
                    spans = [(s[2] >= 0 and nodes[s[2]][5] == "div" and "grid" in (nodes[s[2]][6] or "") and "grid-cols" in nodes[s[2]][6], s, t) for s in nodes
                             if s[5] == "span" and s[8] < s[9] and len(t := " ".join(lines[s[8]:s[9]])) <= 30 and t.lower() in forms]
                inside = [(0, s[2], s[0], t) if grid and s[2] > card else (1, -1, s[0], t) for grid, s, t in spans if card < s[0] <= nodes[card][1]] if card >= 0 else []
                form_of[card] = min(inside)[3] if inside else None
            found.append((link, n[0], text, form_of[card]))
        return found

    return by_page(pages, [key, url, html], 1, rule, T.StructType.fromDDL("link string, node int, text string, form string"), many=True)


def _shared_card_links(pages: DataFrame, key: str, html: str, url: str, detail: str, levels: int) -> DataFrame:
    """``card_links`` of pages that share their key."""
    n = node_table(pages, key, html, keep=(url,))
    links = materialise(detail_links(n, detail, url).select(key, "node", "depth", "parent", "link", "text"))
    text, up = F.col("text"), n.with_texts(n.above(links, levels).where(F.col("tag").isin("div", "article")))
    shown = F.array_max(F.array(*[F.contains(text, F.lit(w)) for w in CARD_WORDS]))
    is_card = (F.length("text") > 50) & (shown | F.coalesce(F.contains(F.col("class"), F.lit(CARD_CLASS)), F.lit(False)))
    near = up.where(is_card).groupBy(key, "below").agg(F.min_by("node", "level").alias("card"))
    link = by_key(links, near.withColumnRenamed("below", "node"), [key, "node"], "left").withColumn("card", F.coalesce("card", "parent"))
    held = by_key(n.elements.select(key, F.col("node").alias("card"), F.col("last")), link.select(key, "card").distinct(), [key, "card"])
    spans = n.with_texts(n.inside(held.withColumnRenamed("card", "node"), ["span"]))
    spans = spans.where((F.length("text") <= 30) & F.lower("text").isin([k for k, _ in H.WORKING_FORMS]))
    grids = n.elements.where((F.col("tag") == "div") & F.contains(F.col("class"), F.lit("grid")) & F.contains(F.col("class"), F.lit("grid-cols")))
    spans = by_key(spans, grids.select(key, F.col("node").alias("parent"), F.lit(True).alias("grid")), [key, "parent"], "left")
    in_grid = F.coalesce(F.col("grid") & (F.col("parent") > F.col("holder")), F.lit(False))
    form = spans.groupBy(key, F.col("holder").alias("card")).agg(
        F.min(F.struct(F.when(in_grid, 0).otherwise(1).alias("rank"), F.when(in_grid, F.col("parent")).alias("g"), F.col("node"), "text")).alias("f"))
    return by_key(link, form, [key, "card"], "left").select(key, "link", "node", "text", F.col("f.text").alias("form"))


def labelled_values(pages: DataFrame, labels: list[str], key: str = "page_id", html: str = "html", max_len: int = 160, siblings: int = 4) -> DataFrame:
    """(page, value) of the first labelled element that has a value, for every page.

    A div, span, p or label element is a label when its text is one, or one and a
    colon and more.  Its value is, in this order: the rest of its own text, one of
    the next ``siblings`` sibling elements, its parent's text without the label;
    the first that isn't empty, a label, noise or longer than ``max_len``.  Pages
    without such an element are read by lines (``functions.html.labelled_value``).
    """
    alone, shared = apart(pages, key)
    low = [x.lower() for x in labels]
    leads = tuple(x.split()[0] for x in low)
    hits = [(low_, low_ + ":", re.compile(re.escape(x) + r"\s*:?\s*", re.IGNORECASE | re.ASCII)) for x, low_ in zip(labels, low)]
    barred = frozenset([*low, *NOISE_LINES])

    def valued(text: str) -> str | None:
        text = " ".join(text.split())
        return text if text and len(text) <= max_len and text.lower() not in barred else None

    def rule(page, nodes: list[list], lines: list[str]) -> tuple:
        kids: dict[tuple[int, int], list] = {}
        text_of = lambda n: " ".join(lines[n[8]:n[9]])
        for n in nodes if page is not None else ():
            if n[5] not in ("div", "span", "p", "label") or n[8] == n[9] or not lines[n[8]].lower().startswith(leads):
                continue
            text = text_of(n)
            lowered = text.lower()
            label = next((word for is_, with_colon, word in hits if lowered == is_ or lowered.startswith(with_colon)), None)
            if label is None:
                continue
            m = label.match(text)
            value = valued(text[m.end():] if m else text)
            if value is None and n[2] >= 0:
                kids = kids or {(k[2], k[3]): k for k in nodes}
                near = (valued(text_of(kids[n[2], place])) for place in range(n[3] + 1, n[3] + siblings + 1) if (n[2], place) in kids)
                value = next((v for v in near if v is not None), None)
                if value is None:
                    text = text_of(nodes[n[2]])
                    m = label.search(text)
                    value = valued(text[:m.start()] + text[m.end():] if m else text)
            if value is not None:
                return value, None
        return None, lines

    read = by_page(alone, [key, html], 1, rule, T.StructType.fromDDL("value string, lines array<string>"))
    by_line = H.labelled_value(F.col("lines"), labels, max_len=max_len)
    found = read.select(key, F.when(F.col("value").isNull(), by_line).otherwise(F.col("value")).alias("value"))
    return found if shared is None else found.unionByName(_shared_labelled_values(shared, labels, key, html, max_len, siblings))


def _shared_labelled_values(pages: DataFrame, labels: list[str], key: str, html: str, max_len: int, siblings: int) -> DataFrame:
    """``labelled_values`` of pages that share their key."""
    n = node_table(pages, key, html)
    low = [x.lower() for x in labels]
    starts = lambda c, word: F.startswith(F.lower(c), F.lit(word))
    any_of = lambda cs: F.coalesce(F.array_max(F.array(*cs)), F.lit(False))
    # the first line inside decides whether the whole text is worth joining
    lead = n.lines.select(F.col(key), F.col("ord").alias("t0"), F.col("text").alias("__lead"))
    own = n.elements.where(F.col("tag").isin("div", "span", "p", "label") & (F.col("t0") < F.col("t1")))
    own = by_key(own, lead, [key, "t0"]).where(any_of([starts(F.col("__lead"), x.split()[0]) for x in low])).drop("__lead")
    own = n.with_texts(own)
    hit = [(F.lower("text") == x) | starts(F.col("text"), x + ":") for x in low]
    label = F.coalesce(*[F.when(h, F.lit(x)) for h, x in zip(hit, labels)])
    own = materialise(own.withColumn("label", label).where("label is not null").select(key, "node", "parent", "place", "t0", "t1", "label"))

    asked = own.select(key, F.col("node").alias("at"), "label", F.lit(0).alias("rank"), "node", "t0", "t1")
    places = n.elements.select(key, "parent", "place", "node", "t0", "t1")
    next_ = (own.where("parent >= 0").select(key, F.col("node").alias("at"), "label", "parent", F.col("place").alias("__p"),
                                             F.explode(F.sequence(F.lit(1), F.lit(siblings))).alias("rank"))
             .withColumn("place", F.col("__p") + F.col("rank")))
    next_ = by_key(next_, places, [key, "parent", "place"]).select(*asked.columns)
    parent = (own.select(key, F.col("node").alias("at"), "label", F.lit(siblings + 1).alias("rank"), F.col("parent").alias("node")))
    parent = by_key(parent, n.elements.select(key, "node", "t0", "t1"), [key, "node"]).select(*asked.columns)
    found = n.with_texts(asked.unionByName(next_).unionByName(parent).distinct())
    quoted = F.concat(F.lit("\\Q"), F.col("label"), F.lit("\\E\\s*:?\\s*"))
    rest = F.regexp_replace("text", F.concat(F.lit("(?i)^"), quoted), F.lit(""))
    around = F.concat(F.lit("(?is)^(.*?)"), quoted, F.lit("(.*)$"))
    part = lambda i: F.call_function("regexp_extract", F.col("text"), around, F.lit(i))
    without = F.when(F.regexp_like("text", around), F.concat(part(1), part(2))).otherwise(F.col("text"))
    value = text_clean(F.when(F.col("rank") == 0, rest).when(F.col("rank") == siblings + 1, without).otherwise(F.col("text")))
    found = found.withColumn("value", value).where((F.col("value") != "") & ~F.lower("value").isin(low) & (F.length("value") <= max_len)
                                                   & ~H.line_is_noise(F.col("value")))
    best = found.groupBy(key).agg(F.min(F.struct("at", "rank", "value")).alias("v")).select(key, F.col("v.value").alias("value"))
    rest_ = by_key(n.pages, best, key, "left_anti").select(key, H.labelled_value(F.col("lines"), labels, max_len=max_len).alias("value"))
    return best.unionByName(rest_)


def header_fields(pages: DataFrame, key: str = "page_id", html: str = "html", url: str = "url", detail: str = "^/detail-jobs/", levels: int = 12) -> DataFrame:
    """(page, job_title, salary_raw, location, level, experience) of every page.

    The title is the link to the page itself, else the first detail link, else the
    first h1.  The header is the nearest element, from the title up to
    ``levels`` - 1 steps, with the title, a salary line and four different lines
    or more, else the title's parent; its lines after the salary, without title,
    salary and noise, are location, level and experience, up to a section word.
    """
    alone, shared = apart(pages, key)
    wanted, stops, noise = re.compile(detail, re.ASCII), frozenset(SECTION_STOP_WORDS), frozenset(NOISE_LINES)
    names = ("job_title", "salary_raw", "location", "level", "experience")

    def rule(page, address: str | None, nodes: list[list], lines: list[str]) -> tuple:
        nothing = ("",) * len(names)
        if page is None:
            return nothing
        here, title, of, is_salary = None if address is None else _path(address), None, None, {}
        for n, link, text in page_links(nodes, lines, address, wanted):
            own = here is not None and _path(link) == here
            if own or of is None:
                title, of = text, n
            if own:
                break
        if of is None:
            of = next((n for n in nodes if n[5] == "h1"), None)
            if of is None:
                return nothing
            title = " ".join(lines[of[8]:of[9]])

        def salary(line: str) -> bool:
            if line not in is_salary:
                is_salary[line] = line_is_salary(line)
            return is_salary[line]

        head, at = None, of
        for _ in range(levels):
            inside = list(dict.fromkeys(lines[at[8]:at[9]]))
            if len(inside) >= 4 and title in " ".join(inside) and any(map(salary, inside)):
                head = inside
                break
            if at[2] < 0:
                break
            at = nodes[at[2]]
        if head is None:
            if of[2] < 0:
                return (title, *nothing[1:])
            head = list(dict.fromkeys(lines[nodes[of[2]][8]:nodes[of[2]][9]]))
        kept = [s for s in head if s != title or salary(s)]
        at = next((i for i, s in enumerate(kept) if salary(s)), None)
        if at is None:
            return (title, *nothing[1:])
        meta = [s for s in itertools.takewhile(lambda s: s.lower() not in stops, kept[at + 1:]) if len(s) <= 140 and s.lower() not in noise]
        return (title, kept[at], *(meta + ["", "", ""])[:3])

    found = by_page(alone, [key, url, html], 1, rule, T.StructType([T.StructField(c, T.StringType()) for c in names]))
    return found if shared is None else found.unionByName(_shared_header_fields(shared, key, html, url, detail, levels))


_DIGIT, _UNITS, _EXACT = re.compile("[0-9]"), tuple(SALARY_HEADER_UNITS), frozenset(SALARY_HEADER_EXACT)


def line_is_salary(line: str) -> bool:
    """``functions.html.line_is_salary`` of a line of ``fold``."""
    low = line.lower()
    return low in _EXACT or (len(line) <= 120 and _DIGIT.search(line) is not None and any(u in low for u in _UNITS))


def _shared_header_fields(pages: DataFrame, key: str, html: str, url: str, detail: str, levels: int) -> DataFrame:
    """``header_fields`` of pages that share their key."""
    n = node_table(pages, key, html, keep=(url,))
    links = detail_links(n, detail, url)
    h1 = n.with_texts(n.elements.where(F.col("tag") == "h1"))
    cols = [key, "node", "depth", "parent", "text"]
    own = F.when(H.path_of(F.col("link")) == F.regexp_extract("__url", "^https?://[^/?#]+([^;?#]*)", 1), 0).otherwise(1)
    all_ = links.select(*cols, own.alias("rank")).unionByName(h1.select(*cols, F.lit(2).alias("rank")))
    title = materialise(all_.groupBy(key).agg(F.min(F.struct("rank", "node", "depth", "parent", "text")).alias("t")).select(key, "t.*"))
    up = n.above(title, levels - 1, own=True)
    lines = n.with_texts(up.select(key, "below", "level", "node", "t0", "t1"), lines=True).withColumn("lines", F.array_distinct("lines"))
    lines = by_key(lines, title.select(key, F.col("text").alias("title"), "parent"), key)
    fits = (F.contains(F.array_join("lines", " "), F.col("title")) & F.exists("lines", lambda s: H.line_is_salary(s)) & (F.size("lines") >= 4))
    order = Window.partitionBy(key).orderBy(F.when(fits, F.col("level")).otherwise(F.lit(1000)), F.when(F.col("node") == F.col("parent"), 0).otherwise(1))
    head = lines.withColumn("__r", F.row_number().over(order)).where((F.col("__r") == 1) & (fits | (F.col("node") == F.col("parent"))))
    salary = F.coalesce(F.try_element_at(F.filter("lines", lambda s: H.line_is_salary(s)), F.lit(1)), F.lit(""))
    kept = F.filter("lines", lambda s: (s != F.col("title")) | H.line_is_salary(s))
    f = H.header_fields(kept)
    fields = head.select(key, salary.alias("salary_raw"), f["location"].alias("location"), f["level"].alias("level"), f["experience"].alias("experience"))
    names = ("salary_raw", "location", "level", "experience")
    titled = by_key(n.pages.select(key), title.select(key, F.col("text").alias("job_title")), key, "left")
    return by_key(titled, fields, key, "left").select(
        key, *[F.coalesce(c, F.lit("")).alias(c) for c in ("job_title", *names)])
