"""Main text of web pages from wrappers inferred per host.

A wrapper is a union-free regular expression over a page's tag stream: tags in
sequence, optional groups, repeated groups and text slots.  It starts as one
page's stream and is aligned with the next page of the host, again and again:
text that differs makes a slot, a group that one side lacks becomes optional,
adjacent equal groups become one repeated group.  Aligning two wrappers works
the same way, so the pages of a host are dealt by their digests into buckets,
aligned in digest order inside each, and the buckets' wrappers are aligned in
turn: copies count once and the result doesn't depend on the input splits.

A page is read through its host's wrapper: text outside the content elements
that the wrapper knows as constant beside many different main texts is template
text, not content.  What
remains is taken from the article elements, else the main element, else an
element named as content, else the body, without navigation, page headers and
footers, sidebars, notices, adverts, forms and comments.
"""

from __future__ import annotations

import hashlib
import html as html_lib
import json
import re
import zlib
from collections import Counter
from collections.abc import Iterator

import pyarrow as pa
from pyspark.sql import DataFrame
from pyspark.sql import functions as F

from hiresight.llm.common import arrow_schema, batch, session_of

#: the part of a tag outside of quotes holds no '<', and nothing is tried twice: linear on any page
TOKEN = re.compile(r"<!--.*?(?:-->|\Z)|<!\[CDATA\[.*?(?:\]\]>|\Z)|<[!?][^>]*(?:>|\Z)|<(/?)([a-zA-Z][^\s/><]*+)((?:[^<>\"']++|\"[^\"]*+\"|'[^']*+')*+)>|[^<]++|<", re.S)
ATTRIBUTE = re.compile(r"([a-zA-Z_:][-\w:.]*)(?:\s*=\s*(\"[^\"]*\"|'[^']*'|[^\s\"'>]+))?")
SPACES = re.compile(r"\s+")
WORD = re.compile(r"[a-z]+")

#: elements whose content is no text of the page
RAW = ("script", "style", "noscript", "template", "textarea", "title", "iframe", "svg", "math", "object", "canvas", "select", "button")
RAW_END = {tag: re.compile(rf"</{tag}(?=[\s/>])[^>]*>", re.I) for tag in RAW}
VOID = frozenset("area base br col embed hr img input link meta param source track wbr".split())
BLOCK = frozenset("""address article aside blockquote body center dd details dialog dir div dl dt fieldset figcaption figure footer
form frameset h1 h2 h3 h4 h5 h6 header hgroup hr html legend li main menu nav ol optgroup option p pre search section summary
table tbody tfoot thead tr caption ul video audio""".split())
CELL = frozenset(("td", "th", "br", "wbr"))
#: elements ended by the next element of the same group
ENDED = {"p": frozenset(("p",)), "li": frozenset(("li", "p")), "dt": frozenset(("dt", "dd", "p")), "dd": frozenset(("dt", "dd", "p")),
         "tr": frozenset(("tr", "p")), "option": frozenset(("option",))}
ASIDE = frozenset("nav aside form footer menu dialog fieldset search".split())
ASIDE_ROLE = frozenset("navigation banner contentinfo complementary search form dialog alert alertdialog menu menubar toolbar".split())
#: words of class and id attributes of what is not content
ASIDE_WORD = frozenset("""ad ads adbox adslot adsense advert adverts advertisement advertisements advertising sponsor sponsored promo promos
promotion banner nav navbar navigation menu menus topbar breadcrumb breadcrumbs sidebar sidebars sidenav aside widget widgets footer
masthead cookie cookies consent gdpr notice notices alert popup modal overlay newsletter subscribe subscription signup login signin
share sharing social related recommended recommendations comment comments commentlist disqus reply replies respond discussion
pagination pager toolbar copyright skip hidden""".split())
CONTENT_WORD = frozenset("article content post entry story main".split())
#: parts a name may have besides words of ASIDE_WORD (site-footer, sidebar-left)
NEUTRAL = frozenset("""area bar block bottom box button buttons container global group inner item items left link links list outer page
primary right secondary section site slot title top unit wrap wrapper posts articles stories news user users reader readers""".split())
#: an article or main with such a name, besides neutral parts, holds reader comments
COMMENT_WORD = frozenset("comment comments commentlist disqus reply replies respond responses discussion".split())
COMMENT_NEUTRAL = NEUTRAL | {"body", "content", "thread"}
#: content elements with a smaller share of the page's text are not all of the content
SHARE = 0.25
#: deeper elements are read, but not aligned
DEPTH = 64
#: a constant slot is template text when so many pages with different main texts have it
TEMPLATE_PAGES = 5
BUCKETS = 32


class Element:
    """tag, key (tag and class words, for alignment), flags, children: elements or text blocks."""

    __slots__ = ("tag", "key", "aside", "content", "children")

    def __init__(self, tag: str, key: str = "", aside: bool = False, content: bool = False):
        self.tag, self.key, self.aside, self.content, self.children = tag, key or tag, aside, content, []


def _named(names: list[str]) -> tuple[bool, bool]:
    """Whether whole names say aside (all parts do, or are neutral; numbers and
    single letters are no parts), and content (a part does, and none says aside)."""
    aside = content = False
    for name in names:
        parts = {w for w in WORD.findall(name) if len(w) > 1}
        whole = "".join(WORD.findall(name)) in ASIDE_WORD  # side-bar
        found = whole or not ASIDE_WORD.isdisjoint(parts)
        aside = aside or whole or found and parts <= ASIDE_WORD | NEUTRAL
        content = content or not found and not CONTENT_WORD.isdisjoint(parts)
    return aside, content


def _comment(names: list[str]) -> bool:
    """Whether a whole name says that readers wrote it."""
    return any(not COMMENT_WORD.isdisjoint(parts) and parts <= COMMENT_WORD | COMMENT_NEUTRAL for parts in (set(WORD.findall(n)) for n in names))


def _element(tag: str, attributes: str) -> Element:
    if not attributes.strip():
        return Element(tag, tag, tag in ASIDE)
    a = {k.lower(): html_lib.unescape((v or "").strip("\"'")) for k, v in ATTRIBUTE.findall(attributes)}
    names = (a.get("class", "") + " " + a.get("id", "")).lower().split()
    named_aside, content = _named(names)
    role = a.get("role", "").lower()
    aside = (tag in ASIDE or role in ASIDE_ROLE or "hidden" in a or a.get("aria-hidden") == "true"
             or "display:none" in a.get("style", "").replace(" ", "").lower())
    content = tag not in ("html", "body") and (content or role == "main" or a.get("itemprop") == "articleBody")
    if tag in ("main", "article"):
        aside = aside or not content and _comment(names)
    elif tag not in ("html", "body") and not content:
        aside = aside or named_aside
    return Element(tag, ".".join([tag, *sorted(set(WORD.findall(" ".join(names))))]), aside, content)


def parse(page: str) -> Element:
    """Tree of block elements; text directly inside one is a block of its own,
    with character references decoded and white space as single spaces."""
    root = Element("#root")
    stack, text = [root], []
    open_tags: Counter = Counter()

    def pop():
        open_tags[stack.pop().tag] -= 1

    def flush():
        if text:
            block = SPACES.sub(" ", html_lib.unescape("".join(text))).strip()
            text.clear()
            if block:
                stack[-1].children.append(block)

    at = 0
    while at < len(page):
        m = TOKEN.match(page, at)
        at = m.end()
        close, tag, attributes = m.groups()
        if tag is None:
            if not m[0].startswith(("<!", "<?")):
                text.append(m[0])
            continue
        tag = tag.lower()
        if tag in RAW:
            if not close and not attributes.endswith("/"):
                end = RAW_END[tag].search(page, at)
                at = end.end() if end else len(page)
        elif tag in BLOCK:
            flush()
            if close:
                if open_tags[tag]:
                    while stack[-1].tag != tag:
                        pop()
                    pop()
                continue
            if tag in ENDED:
                while stack[-1].tag in ENDED[tag]:
                    pop()
            elif stack[-1].tag == "p":
                pop()
            if tag not in VOID:
                e = _element(tag, attributes)
                stack[-1].children.append(e)
                stack.append(e)
                open_tags[tag] += 1
        elif tag in CELL:
            text.append(" ")
    flush()
    return root


# A wrapper node: [key, children, repeated, optional, constant text (in wrappers of hosts its digest) or None,
# the smallest TEMPLATE_PAGES digests of the main texts beside the constant].
KEY, CHILDREN, REPEATED, OPTIONAL, CONSTANT, PAGES = range(6)
TEXT = "#text"


def expression(e: Element, depth: int = 0) -> list:
    """One page's tag stream as an expression to a depth of DEPTH, with repeated groups folded."""
    inner = e.children if depth < DEPTH else []
    children = [[TEXT, [], False, False, c, []] if isinstance(c, str) else expression(c, depth + 1) for c in inner]
    return [e.key, fold(children), False, False, None, []]


def text_digest(text: str) -> int:
    return int.from_bytes(hashlib.blake2b(text.encode("utf-8", "surrogatepass"), digest_size=7).digest(), "little")


def signed(w: list, e: Element) -> list:
    """The page's expression with digests for its constants, each beside the
    page's longest other block that is no aside.  Near copies share that block,
    so however many there are, they count as one page; text longer than all the
    others together is what the page is about."""
    longest: list[str] = []
    chars = 0
    todo: list = [e]
    while todo:
        x = todo.pop()
        for c in x.children:
            if not isinstance(c, str):
                if not c.aside:
                    todo.append(c)
            else:
                chars += len(c)
                if c not in longest:
                    longest = sorted([*longest, c], key=lambda t: (-len(t), t))[:2]
    beside = [(c, text_digest(c)) for c in longest]
    nodes = [w]
    while nodes:
        x = nodes.pop()
        nodes.extend(x[CHILDREN])
        if x[CONSTANT] is not None:
            x[PAGES] = [d for c, d in beside if c != x[CONSTANT]][:1] if 2 * len(x[CONSTANT]) <= chars else []
            x[CONSTANT] = text_digest(x[CONSTANT])
    return w


def fold(children: list[list]) -> list[list]:
    """Adjacent equal groups of up to three elements become one repeated group."""
    for width in (1, 2, 3):
        i = 0
        while i + 2 * width <= len(children):
            a, b = children[i:i + width], children[i + width:i + 2 * width]
            if [x[KEY] for x in a] == [x[KEY] for x in b] and (width == 1 or any(x[KEY] != a[0][KEY] for x in a)):
                for x, y in zip(a, b):
                    both = merge(x, y, same_page=True)
                    both[REPEATED] = True
                    x[:] = both
                del children[i + width:i + 2 * width]
            else:
                i += 1
    return children


def merge(a: list, b: list, same_page: bool = False) -> list:
    """Align two expressions with the same key."""
    constant = a[CONSTANT] if a[CONSTANT] == b[CONSTANT] else None
    pages = [] if constant is None else sorted({*a[PAGES], *b[PAGES]})[:TEMPLATE_PAGES]
    return [a[KEY], align(a[CHILDREN], b[CHILDREN], same_page), a[REPEATED] or b[REPEATED], a[OPTIONAL] or b[OPTIONAL], constant, pages]


def pairs(a: list, b: list) -> list[tuple[int | None, int | None]]:
    """Longest common subsequence of two key lists, with the gaps."""
    if a == b:
        return [(i, i) for i in range(len(a))]
    m, n = len(a), len(b)
    if m * n > 40_000:  # long sequences: next equal key, instead of the longest subsequence
        out, j = [], 0
        later: dict[str, list[int]] = {}
        for k in range(n - 1, -1, -1):
            later.setdefault(b[k], []).append(k)
        for i, key in enumerate(a):
            at = later.get(key, [])
            while at and at[-1] < j:
                at.pop()
            if at and at[-1] - j <= 64:
                out.extend((None, k) for k in range(j, at[-1]))
                out.append((i, at[-1]))
                j = at[-1] + 1
            else:
                out.append((i, None))
        return out + [(None, k) for k in range(j, n)]
    best = [[0] * (n + 1) for _ in range(m + 1)]
    for i in range(m - 1, -1, -1):
        for j in range(n - 1, -1, -1):
            best[i][j] = best[i + 1][j + 1] + 1 if a[i] == b[j] else max(best[i + 1][j], best[i][j + 1])
    i = j = 0
    out = []
    while i < m or j < n:
        if i < m and j < n and a[i] == b[j]:
            out.append((i, j))
            i, j = i + 1, j + 1
        elif j == n or i < m and best[i + 1][j] >= best[i][j + 1]:
            out.append((i, None))
            i += 1
        else:
            out.append((None, j))
            j += 1
    return out


def align(a: list[list], b: list[list], same_page: bool = False) -> list[list]:
    out = []
    for i, j in pairs([x[KEY] for x in a], [x[KEY] for x in b]):
        if i is None or j is None:  # only one side has it
            x = a[i] if j is None else b[j]
            x = [*x]
            x[OPTIONAL] = True
            out.append(x)
        else:
            out.append(merge(a[i], b[j], same_page))
    return fold(out)


def template_texts(e: Element, wrapper: list | None) -> set[int]:
    """ids() of (element, position) whose text is constant in the wrapper."""
    found: set = set()
    if wrapper is None:
        return found
    todo = [(e, wrapper)]
    while todo:
        x, w = todo.pop()
        keys = [TEXT if isinstance(c, str) else c.key for c in x.children]
        at = 0
        slots = w[CHILDREN]
        for k, c in enumerate(x.children):
            p = next((q for q in range(at, len(slots)) if slots[q][KEY] == keys[k]), None)
            if p is None:
                p = next((q for q in range(len(slots)) if slots[q][KEY] == keys[k]), None)
                if p is None:
                    continue
            at = p  # a repeated group may take the next one too
            s = slots[p]
            if isinstance(c, str):
                if len(s[PAGES]) >= TEMPLATE_PAGES and s[CONSTANT] == text_digest(c):
                    found.add((id(x), k))
            else:
                todo.append((c, s))
    return found


def blocks(e: Element, template: set, in_article: bool = False) -> list[str]:
    """Blocks of an element that are no aside; template text goes outside of content only."""
    todo: list = [(e, in_article, False)]
    order: list = []
    while todo:  # depth first, in page order
        x, inside, header = todo.pop()
        if isinstance(x, str):
            order.append(x)
            continue
        if x.aside and x is not e:
            continue
        inside = inside or x.content or x.tag in ("article", "main")
        if x.tag == "header" and x is not e:
            if not inside:
                continue
            header = True
        for k in range(len(x.children) - 1, -1, -1):
            c = x.children[k]
            if isinstance(c, str):
                if (inside or (id(x), k) not in template) and (not header or re.fullmatch("h[1-6]", x.tag)):
                    todo.append((c, inside, header))
            else:
                todo.append((c, inside, header))
    return order


def _outermost(root: Element, wanted) -> list[Element]:
    found, todo = [], [root]
    while todo:
        x = todo.pop()
        if x.aside:
            continue
        if wanted(x):
            found.append(x)
        else:
            todo.extend(c for c in reversed(x.children) if not isinstance(c, str))
    return found


def main_text(page: str, wrapper: list | None = None) -> str:
    """Text of all articles, else all main elements, else all elements named as
    content, else the body: the first of them with SHARE of the body's text."""
    root = parse(page)
    template = template_texts(root, wrapper)
    whole = blocks(root, template)
    chars = sum(map(len, whole))
    for wanted in (lambda x: x.tag == "article", lambda x: x.tag == "main", lambda x: x.content):
        found = [b for r in _outermost(root, wanted) for b in blocks(r, template, True)]
        if found and sum(map(len, found)) >= SHARE * chars:
            return "\n\n".join(found)
    return "\n\n".join(whole)


HOST = r"^[a-zA-Z][a-zA-Z0-9+.-]*://(?:[^/?#@]*@)?([^/?#:]*)"


WIRE = {"host": pa.string(), "bucket": pa.int32(), "digest": pa.binary(), "wrapper": pa.binary()}
WIRE_DDL = "host string, bucket int, digest binary, wrapper binary"


def _infer(batches: Iterator[pa.RecordBatch]) -> Iterator[pa.RecordBatch]:
    """Expressions of this split's pages, one for all copies in the split."""
    schema = arrow_schema(WIRE)
    seen: set[tuple[str, bytes]] = set()
    for b in batches:
        rows = []
        for host, page in zip(b.column(0).to_pylist(), b.column(1).to_pylist()):
            digest = hashlib.blake2b(page.encode("utf-8", "surrogatepass"), digest_size=16).digest()
            if (host, digest) in seen:
                continue
            seen.add((host, digest))
            e = parse(page)
            rows.append((host, digest[0] % BUCKETS, digest, _to_bytes(signed(expression(e), e))))
        if rows:
            yield batch(schema, **dict(zip(WIRE, zip(*rows))))


def _to_bytes(wrapper: list) -> bytes:
    return zlib.compress(json.dumps(wrapper, separators=(",", ":")).encode(), 1)


def _join_wrappers(by: int):
    """Aligns rows sorted by host, bucket and digest, one wrapper for each value of the
    first ``by`` columns; all copies of a page are neighbours and count once."""
    schema = arrow_schema(WIRE)

    def run(batches: Iterator[pa.RecordBatch]) -> Iterator[pa.RecordBatch]:
        last = wrapper = None
        for b in batches:
            for row in zip(*(b.column(i).to_pylist() for i in range(4))):
                if last is not None and row[:3] == last[:3]:
                    continue
                e = json.loads(zlib.decompress(row[3]))
                if last is None or row[:by] == last[:by]:
                    wrapper = e if last is None else merge(wrapper, e)
                else:
                    yield batch(schema, host=[last[0]], bucket=[last[1]], digest=[b""], wrapper=[_to_bytes(wrapper)])
                    wrapper = e
                last = row
        if last is not None:
            yield batch(schema, host=[last[0]], bucket=[last[1]], digest=[b""], wrapper=[_to_bytes(wrapper)])

    return run


def _extract(batches: Iterator[pa.RecordBatch]) -> Iterator[pa.RecordBatch]:
    schema = arrow_schema({"page_id": pa.int64(), "url": pa.string(), "text": pa.string()})
    known: dict[str, list] = {}
    for b in batches:
        texts = []
        for page, w in zip(b.column(2).to_pylist(), b.column(3).to_pylist()):
            if w not in known:
                if len(known) >= 256:
                    known.clear()
                known[w] = json.loads(zlib.decompress(w)) if w else None
            texts.append(main_text(page, known[w]))
        if texts:
            yield batch(schema, page_id=b.column(0), url=b.column(1), text=texts)


def host_of(url_col: str):
    return F.lower(F.regexp_extract(F.coalesce(F.col(url_col), F.lit("")), HOST, 1))


def infer_wrappers(pages: DataFrame, url_col: str = "url", html_col: str = "html") -> DataFrame:
    """(host, wrapper).  Pages are aligned within (host, digest modulo 32), then
    by host, so that a host with a third of all pages never brings more than 32
    wrappers to one task; a page with many copies brings one a split."""
    session_of(pages)
    order = ["host", "bucket", "digest"]
    first = (pages.select(host_of(url_col).alias("host"), F.coalesce(F.col(html_col), F.lit("")).alias("html"))
             .mapInArrow(_infer, WIRE_DDL))
    parts = first.repartition("host", "bucket").sortWithinPartitions(*order).mapInArrow(_join_wrappers(2), WIRE_DDL)
    return (parts.repartition("host").sortWithinPartitions(*order).mapInArrow(_join_wrappers(1), WIRE_DDL)
            .select("host", "wrapper"))


def extract_main_text(pages: DataFrame, id_col: str = "page_id", url_col: str = "url", html_col: str = "html") -> DataFrame:
    """One row per input row: page_id, url, text.

    Blocks in page order joined by two line breaks; '' if there is none.  Null
    html is empty, a null url belongs to the host ''.  Repeated rows give equal
    rows; an empty table an empty result; other columns are ignored.
    """
    wrappers = infer_wrappers(pages, url_col, html_col).withColumnRenamed("host", "__host")
    rows = pages.select(F.col(id_col).cast("long").alias("page_id"), F.col(url_col).alias("url"),
                        F.coalesce(F.col(html_col), F.lit("")).alias("html"), host_of(url_col).alias("__h"))
    return (rows.join(wrappers.hint("shuffle_hash"), F.col("__h") == F.col("__host"), "left")
            .select("page_id", "url", "html", "wrapper").mapInArrow(_extract, "page_id long, url string, text string"))
