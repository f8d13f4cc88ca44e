"""Page field extraction as Column expressions over raw HTML text.

Site-specific CSS selectors become regular expressions over the page text,
so extraction is a per-row projection (no Python worker, no shuffle).  Block
structure is approximated by splitting at block-level tags.
"""

from __future__ import annotations

from pyspark.sql import Column
from pyspark.sql import functions as F

from .constants import (COMPANY_LEGAL_WORDS, NOISE_LINES, SALARY_HEADER_EXACT, SALARY_HEADER_UNITS,
                        SECTION_STOP_WORDS, WORKING_FORMS)
from .salary import parse_salary_text_b
from .text import contains_any, let, literal_regex, text_clean

# --- FIXED VALUES: HTML entities decoded (``&amp;`` last so it is decoded once).
ENTITIES = [("&lt;", "<"), ("&gt;", ">"), ("&quot;", '"'), ("&#39;", "'"), ("&nbsp;", " "),
            ("&copy;", "©"), ("&middot;", "·"), ("&amp;", "&")]

INVISIBLE = "(?is)<script[^>]*>.*?</script>|<style[^>]*>.*?</style>|<!--.*?-->"
BLOCK_TAGS = "(?i)<br\\s*/?>|</?(p|li|div|ul|ol|h[1-6]|article|section|nav|footer|header|title|tr|td)(\\s[^>]*)?>"


def _c(c) -> Column:
    return F.col(c) if isinstance(c, str) else c


def unescape(c) -> Column:
    x = _c(c)
    for ent, ch in ENTITIES:
        x = F.replace(x, F.lit(ent), F.lit(ch))
    return x


def strip_tags(c) -> Column:
    """Tags -> ' ', entities decoded, whitespace collapsed."""
    return text_clean(unescape(F.regexp_replace(_c(c), "<[^>]*>", " ")))


def visible(html) -> Column:
    """HTML without script, style and comments."""
    return F.regexp_replace(_c(html), INVISIBLE, " ")


def first_element_text(html, tag: str) -> Column:
    """Text of the first <tag>...</tag> ('' when absent)."""
    inner = F.regexp_extract(_c(html), f"(?is)<{tag}(\\s[^>]*)?>(.*?)</{tag}>", 2)
    return strip_tags(inner)


def html_title(html) -> Column:
    """First h1 text, else the <title> text."""
    h1 = first_element_text(html, "h1")
    return F.when(h1 != "", h1).otherwise(first_element_text(html, "title"))


def anchors(html) -> Column:
    """(href, text) of every link, in page order; single or double quotes."""
    pat = "(?is)<a\\s[^>]*href=[\"']([^\"']*)[\"'][^>]*>(.*?)</a>"
    v = visible(html)
    return F.zip_with(F.regexp_extract_all(v, F.lit(pat), 1), F.regexp_extract_all(v, F.lit(pat), 2),
                      lambda h, t: F.struct(h.alias("href"), strip_tags(t).alias("text")))


def url_path(url) -> Column:
    return F.regexp_extract(_c(url), "^(?:https?://[^/?#]+)?([^;?#]*)", 1)


def detail_title(html, url) -> Column:
    """First h1 text, else the text of the page's link to itself, else the <title> text."""
    h1 = first_element_text(html, "h1")
    own = F.filter(anchors(html), lambda a: (a["text"] != "") & (url_path(a["href"]) == url_path(url)))
    return F.when(h1 != "", h1).otherwise(F.coalesce(F.try_element_at(own, F.lit(1))["text"], first_element_text(html, "title")))


def heading_sections(html) -> Column:
    """(heading, body) pairs: an h2, h3 or b heading opens a section that runs to the next one."""
    pieces = F.split(visible(html), "(?i)<(?:h2|h3|b)(?:\\s[^>]*)?>")
    end = "(?is)^(.*?)(?:</(?:h2|h3|b)>|<br\\s*/?>)"
    return F.transform(F.slice(pieces, F.lit(2), F.size(pieces)), lambda s: F.struct(
        strip_tags(F.regexp_extract(s, end, 1)).alias("heading"), strip_tags(F.regexp_replace(s, end, "")).alias("body")))


def section_of(secs: Column, keywords, max_heading: int = 120) -> Column:
    """Body of the first section whose heading (<= 120 chars) contains a keyword, else ''."""
    hit = F.filter(secs, lambda s: (F.length(s["heading"]) <= max_heading) & contains_any(F.lower(s["heading"]), [k.lower() for k in keywords]))
    return F.coalesce(F.try_element_at(hit, F.lit(1))["body"], F.lit(""))


def info_fields(lines) -> Column:
    """(label, value) of every 'label: value' line; the label has 1 to 40 characters."""
    pat = "^([^:]{1,40}):\\s*(\\S.*)$"
    return F.transform(F.filter(_c(lines), lambda s: s.rlike(pat)),
                       lambda s: F.struct(F.trim(F.regexp_extract(s, pat, 1)).alias("label"), F.trim(F.regexp_extract(s, pat, 2)).alias("value")))


# --- FIXED VALUES: section keywords and labels of a detail page.
ROLE_WORDS = ["your role", "responsibilities", "mô tả công việc", "trách nhiệm"]
SKILL_WORDS = ["your skills", "qualifications", "requirements", "yêu cầu", "kỹ năng"]
BENEFIT_WORDS = ["benefits", "quyền lợi", "phúc lợi", "why you'll love", "why you will love"]
SIZE_LABELS = ["Size", "Company size", "Quy mô", "Quy mô công ty"]
INDUSTRY_LABELS = ["Industry", "Lĩnh vực", "Field", "Business field", "Ngành nghề"]
PLACE_LABELS = ["Địa điểm làm việc", "Working location"]


def page_record(html, url, source: str, crawl_date: str) -> list:
    """The 18 fields of a raw record from a detail page, as columns.

    Lines and sections are taken from the page once and shared by the fields."""
    lines, secs, blocks = F.col("_lines"), F.col("_secs"), F.col("_blocks")
    head = header_fields(lines)
    salary = F.coalesce(F.try_element_at(F.filter(lines, lambda s: line_is_salary(s)), F.lit(1)), F.lit(""))
    pay = parse_salary_text_b(salary)

    def section(words, i):
        s = section_of(secs, words)
        return F.when(s != "", s).otherwise(F.coalesce(F.try_element_at(blocks, F.lit(i)), F.lit("")))

    size = labelled_value(lines, SIZE_LABELS, max_len=80)
    fields = {
        "job_title": detail_title(html, url), "salary_min": pay["salary_min"], "salarry_max": pay["salary_max"],
        "location": head["location"], "experience": head["experience"], "job_description": section(ROLE_WORDS, 1),
        "qualifications": section(SKILL_WORDS, 2), "benefit": section(BENEFIT_WORDS, 3),
        "job_location": labelled_value(lines, PLACE_LABELS), "company": company_from_lines(lines),
        "size": F.when(size != "", size).otherwise(size_fallback(strip_tags(html))),
        "industry": labelled_value(lines, INDUSTRY_LABELS, max_len=100), "level": head["level"],
        "working form": working_form(lines), "salary_raw": salary, "crawl_date": F.lit(crawl_date),
        "source_url": url_normalise(url), "source": F.lit(source)}
    return [c.alias(n) for n, c in fields.items()]


def page_records(pages, source: str, crawl_date: str, html: str = "html", url: str = "url", keep=()):
    """``keep`` columns and the raw record of every page of a DataFrame: ``page_record``, read in one pass over a page."""
    import pyarrow as pa
    from pyspark.sql import types as T

    from . import page_text

    record, names, columns = page_text.record, page_text.FIELDS, [*keep, url]
    schema = T.StructType([*[T.StructField(f"_{i}", pages.schema[c].dataType) for i, c in enumerate(columns)], *[T.StructField(n, T.StringType()) for n in names]])

    def run(batches):
        from pyspark.sql.pandas.types import to_arrow_schema

        out = to_arrow_schema(schema)
        for b in batches:
            rows = [*zip(*map(record, b.column(len(columns)).to_pylist(), b.column(len(columns) - 1).to_pylist()))] or [()] * len(names)
            yield pa.RecordBatch.from_arrays([*[b.column(i).cast(out.field(i).type) for i in range(len(columns))],
                                              *[pa.array(r, out.field(len(columns) + i).type) for i, r in enumerate(rows)]], schema=out)

    read = pages.select(*columns, html).mapInArrow(run, schema)
    last = {"size": F.when(F.col("_text").isNotNull(), size_fallback("_text")).otherwise(F.col("size")), "crawl_date": F.lit(crawl_date),
            "source_url": url_normalise(f"_{len(keep)}"), "source": F.lit(source)}
    order = [*names[:-1], "crawl_date", "source_url", "source"]
    return read.select(*[F.col(f"_{i}").alias(c) for i, c in enumerate(keep)], *[last.get(n, F.col(f"`{n}`")).alias(n) for n in order])


def html_lines(html) -> Column:
    """Visible text as trimmed non-empty lines (block tags and <br> end a line)."""
    v = F.regexp_replace(visible(html), BLOCK_TAGS, "\n")
    # strip_tags of every line, by passes over the whole page that stop at line ends
    v = F.regexp_replace(unescape(F.regexp_replace(v, "<[^>\n]*>", " ")), "(?U)[\\s&&[^\n]]+", " ")
    return F.filter(F.transform(F.split(v, "\n"), lambda p: F.trim(p)), lambda s: s != "")


def html_blocks(html, container: str = "article") -> Column:
    """Block texts of the container (p / li / div boundaries), first occurrence
    kept, joined by newlines; the whole container text when it has no blocks."""
    inner = F.regexp_extract(visible(html), f"(?is)<{container}(\\s[^>]*)?>(.*)</{container}>", 2)
    parts = F.filter(F.transform(F.split(inner, BLOCK_TAGS), lambda p: strip_tags(p)), lambda s: s != "")
    return F.when(F.size(parts) > 0, F.array_join(F.array_distinct(parts), "\n")).otherwise(strip_tags(inner))


def prose_blocks(html, container: str = "article") -> Column:
    inner = F.regexp_extract(visible(html), f"(?is)<{container}(\\s[^>]*)?>(.*)</{container}>", 2)
    return F.array_distinct(F.filter(F.transform(F.split(inner, BLOCK_TAGS), lambda p: strip_tags(p)),
                                     lambda s: s != ""))


def sections(html) -> Column:
    """(heading, body) pairs: a <b> heading opens a section running to the next one."""
    art = F.regexp_extract(visible(html), "(?is)<article(\\s[^>]*)?>(.*)</article>", 2)
    pieces = F.split(art, "(?i)<b(\\s[^>]*)?>")
    tail = F.slice(pieces, F.lit(2), F.size(pieces))
    return F.transform(tail, lambda s: F.struct(
        strip_tags(F.regexp_extract(s, "(?is)^(.*?)(</b>|<br\\s*/?>)", 1)).alias("heading"),
        strip_tags(F.regexp_replace(s, "(?is)^(.*?)(</b>|<br\\s*/?>)", "")).alias("body")))


def section_by_heading(html, keywords, max_heading: int = 120) -> Column:
    """Body of the first section whose heading (<= 120 chars) contains a keyword."""
    kws = [k.lower() for k in keywords]
    hit = F.filter(sections(html), lambda s: (F.length(s["heading"]) <= max_heading)
                   & contains_any(F.lower(s["heading"]), kws))
    return F.coalesce(F.try_element_at(hit, F.lit(1))["body"], F.lit(""))


def html_links(html, page_url, path_pattern: str | None = None) -> Column:
    """Same-site links (quoted either way or not): resolved against the page, query/fragment dropped, distinct, sorted;
    with ``path_pattern`` only those whose path matches it."""
    u = _c(page_url)
    base = F.regexp_extract(u, "^(https?://[^/?#]+)", 1)
    quoted = F.regexp_extract_all(visible(html), F.lit("(?is)<a\\s(?:[^>]*\\s)?href\\s*=\\s*(\"[^\"]*\"|'[^']*'|[^\\s>\"']+)"), 1)
    hrefs = F.filter(F.transform(quoted, lambda h: unescape(F.regexp_replace(h, "^[\"']|[\"']$", ""))), lambda h: ~h.rlike("(?i)^\\s*(javascript|mailto|tel|data):"))
    same = F.filter(F.transform(hrefs, lambda h: resolve(u, h)), lambda x: F.regexp_extract(x, "^(https?://[^/?#]+)", 1) == base)
    if path_pattern:
        same = F.filter(same, lambda x: path_of(x).rlike(path_pattern))
    return F.array_sort(F.array_distinct(same))


def resolve(page_url: Column, href: Column) -> Column:
    """Absolute URL of a link: full, host-relative, page-relative (with ./ and ../ steps), without ?, # and ;."""
    base = F.regexp_extract(page_url, "^(https?://[^/?#]+)", 1)
    scheme = F.regexp_extract(page_url, "^(https?:)", 1)
    folder = F.regexp_extract(F.regexp_replace(page_url, "[?#].*$", ""), "^https?://[^/]+(/(?:[^/]*/)*)", 1)
    h = F.regexp_replace(F.trim(href), "[?#].*$", "")
    path = F.when(h.startswith("/"), h).otherwise(F.concat(F.when(folder == "", F.lit("/")).otherwise(folder), h))
    parts = F.filter(F.split(path, "/"), lambda p: (p != "") & (p != "."))
    steps = F.aggregate(parts, F.array().cast("array<string>"),
                        lambda acc, p: F.when(p == "..", F.slice(acc, 1, F.greatest(F.size(acc) - 1, F.lit(0)))).otherwise(F.array_append(acc, p)))
    tail = F.when((F.size(parts) > 0) & path.rlike("(^|/)(\\.{1,2})?$"), F.lit("/")).otherwise(F.lit(""))
    local = F.concat(base, F.lit("/"), F.array_join(steps, "/"), F.when(F.size(steps) > 0, tail).otherwise(F.lit("")))
    own = F.regexp_replace(page_url, "[?#].*$", "")
    return url_normalise(F.when(h == "", own).when(h.rlike("(?i)^https?://"), h).when(h.startswith("//"), F.concat(scheme, h)).otherwise(local))


def path_of(url: Column) -> Column:
    return F.regexp_extract(url, "^https?://[^/?#]+([^;?#]*)", 1)


def url_normalise(url) -> Column:
    """Drop ?query, #fragment and the ;params of the last path segment, keep scheme://host/path."""
    return F.regexp_replace(F.regexp_replace(_c(url), "[?#].*$", ""), ";[^/]*$", "")


def url_with_page(url, page) -> Column:
    """Set or replace the ``page`` query parameter, keep the others (blank ones dropped)."""
    u = _c(url)
    base = F.regexp_replace(u, "[?#].*$", "")
    query = F.regexp_extract(u, "\\?([^#]*)", 1)
    params = F.filter(F.split(query, "&"), lambda p: p.rlike("^[^=]+=.+$"))
    has_page = F.exists(params, lambda p: p.startswith("page="))
    pv = F.concat(F.lit("page="), F.lit(page).cast("string") if not isinstance(page, Column) else page.cast("string"))
    replaced = F.transform(params, lambda p: F.when(p.startswith("page="), pv).otherwise(p))
    final = F.when(has_page, replaced).otherwise(F.concat(params, F.array(pv)))
    return F.concat(base, F.lit("?"), F.array_join(final, "&"))


def line_is_salary(line) -> Column:
    """Negotiable words, or <= 120 chars with a digit and a currency word."""
    return let(text_clean(line), lambda s: F.lower(s).isin(SALARY_HEADER_EXACT) | (
        (F.length(s) <= 120) & s.rlike("[0-9]") & contains_any(F.lower(s), SALARY_HEADER_UNITS)))


def line_is_noise(line) -> Column:
    return F.lower(F.trim(_c(line))).isin(NOISE_LINES)


def labelled_value(lines, labels, max_lookahead: int = 6, max_len: int = 160) -> Column:
    """Value of the first line that is / starts with a label: the rest of that line,
    else the first following line (<= ``max_lookahead``) that is not noise or a label."""
    lab = [x.lower() for x in labels]
    # one test a line: the line is a label, or a blank or colon follows the label
    starts = f"\\A(?:{literal_regex(lab)})(?:[ :]|\\z)"

    def value(arr, first):
        rest = F.try_element_at(arr, first)
        for x in labels:
            rest = F.regexp_replace(rest, f"(?i)^{x}\\s*:?\\s*", "")
        ok = lambda c: (c != "") & (F.length(c) <= max_len) & ~line_is_noise(c) & ~F.lower(c).isin(lab)
        nxt = F.filter(F.slice(arr, first + 1, max_lookahead), ok)
        return let(F.trim(rest), lambda own: F.when(ok(own), own).otherwise(F.coalesce(F.try_element_at(nxt, F.lit(1)), F.lit(""))))

    return let(_c(lines), lambda arr: let(
        F.array_position(F.transform(arr, lambda s: F.lower(s).rlike(starts)), True).cast("int"),
        lambda first: F.when(first > 0, value(arr, first)).otherwise(F.lit(""))))


def header_fields(lines) -> Column:
    """Lines after the first salary line up to a section word (<= 140 chars, noise dropped):
    positions 1/2/3 -> location, level, experience."""
    none = F.array().cast("array<string>")
    after = lambda arr: let(F.array_position(F.transform(arr, lambda s: line_is_salary(s)), True),
                            lambda pos: F.when(pos > 0, F.slice(arr, pos + 1, F.size(arr))).otherwise(none))
    upto = lambda a: let(F.array_position(F.transform(a, lambda s: F.lower(s).isin(SECTION_STOP_WORDS)), True),
                         lambda stop: F.when(stop > 0, F.slice(a, 1, F.greatest(stop - 1, F.lit(0)))).otherwise(a))
    meta = F.filter(let(let(_c(lines), after), upto), lambda s: (F.length(s) <= 140) & ~line_is_noise(s))
    at = lambda m, i: F.coalesce(F.try_element_at(m, F.lit(i)), F.lit(""))
    return let(meta, lambda m: F.struct(at(m, 1).alias("location"), at(m, 2).alias("level"), at(m, 3).alias("experience")))


def company_from_lines(lines) -> Column:
    """First line of <= 120 chars naming a legal form (company, ltd, jsc, ...)."""
    hit = F.filter(_c(lines), lambda s: (F.length(s) <= 120) & contains_any(F.lower(s), COMPANY_LEGAL_WORDS))
    return F.coalesce(F.try_element_at(hit, F.lit(1)), F.lit(""))


def size_fallback(text) -> Column:
    return F.regexp_extract(_c(text), "(?i)\\b\\d[\\d.,]*\\s*-\\s*\\d[\\d.,]*\\s*(employees|nhân viên)", 0)


def working_form(texts) -> Column:
    """First short text (<= 30 chars) equal to a known working form, canonical spelling."""
    m = F.create_map(*[x for k, v in WORKING_FORMS for x in (F.lit(k), F.lit(v))])
    hits = F.filter(_c(texts), lambda s: (F.length(s) <= 30) & F.lower(s).isin([k for k, _ in WORKING_FORMS]))
    return F.coalesce(F.element_at(m, F.lower(F.try_element_at(hits, F.lit(1)))), F.lit(""))
