"""Queries: page extraction over ``pages(page_id, url, html)`` and URL helpers."""

from __future__ import annotations

from pyspark.sql import functions as F

from ..functions import html as H
from ..functions.constants import (COMPANY_LEGAL_WORDS, NOISE_LINES, SALARY_HEADER_EXACT, SALARY_HEADER_UNITS,
                                   SECTION_STOP_WORDS, WORKING_FORMS)
from ..functions.text import text_clean
from ..operators import nodes as N
from ..sources.tables import table
from . import clean as C
from . import node_pages as NP
from . import oracle as O
from .catalog import register
from .posting_pages import POSTING_PAGES_SQL, posting_pages

W = O.with_ctes
POSTING = O.posting_ctes()


def pages(spark, sf):
    return table(spark, sf, "pages")


#: the pages built around postings, and their lines
PAGES_CTE = POSTING + f",\npp AS ({POSTING_PAGES_SQL})"


def with_lines(spark, sf):
    return posting_pages(spark, sf).select("post_id", "url", "html", H.html_lines("html").alias("_lines"))


# ---------------------------------------------------------------- SQL helpers
def unescape_sql(x: str) -> str:
    for ent, ch in H.ENTITIES:
        x = f"replace({x}, {O.q(ent)}, {O.q(ch)})"
    return x


def strip_sql(x: str) -> str:
    return f"trim(regexp_replace({unescape_sql(f'regexp_replace({x}, {O.q(chr(60) + '[^>]*>')}, {O.q(' ')}, {O.q('g')})')}, '\\s+', ' ', 'g'))"


def visible_sql(x: str) -> str:
    return f"regexp_replace({x}, {O.q(H.INVISIBLE)}, ' ', 'g')"


def first_elem_sql(x: str, tag: str) -> str:
    return strip_sql(f"regexp_extract({x}, {O.q(f'(?is)<{tag}(' + chr(92) + 's[^>]*)?>(.*?)</' + tag + '>')}, 2)")


def lines_sql(x: str) -> str:
    v = f"regexp_replace({visible_sql(x)}, {O.q(H.BLOCK_TAGS)}, chr(10), 'g')"
    return f"list_filter(list_transform(string_split({v}, chr(10)), lambda p: {strip_sql('p')}), lambda s: s <> '')"


def keep_first_sql(lst: str) -> str:
    return f"list_filter({lst}, lambda x, i: NOT list_contains({lst}[1:i - 1], x))"


def blocks_list_sql(x: str) -> str:
    inner = f"regexp_extract({visible_sql(x)}, {O.q('(?is)<article(' + chr(92) + 's[^>]*)?>(.*)</article>')}, 2)"
    parts = (f"list_filter(list_transform(regexp_split_to_array({inner}, {O.q(H.BLOCK_TAGS)}), "
             f"lambda p: {strip_sql('p')}), lambda s: s <> '')")
    return parts, inner


def any_instr_lower(expr, words):
    return O.any_instr(f"lower({expr})", words)


# ---------------------------------------------------------------- title, lines, blocks
register("html_title", f"""
SELECT page_id, CASE WHEN {first_elem_sql('html', 'h1')} <> '' THEN {first_elem_sql('html', 'h1')}
       ELSE {first_elem_sql('html', 'title')} END AS title FROM pages""")(
    lambda spark, sf: pages(spark, sf).select("page_id", H.html_title("html").alias("title")))

register("html_lines", f"SELECT page_id, array_to_string({lines_sql('html')}, chr(10)) AS lines FROM pages")(
    lambda spark, sf: pages(spark, sf).select("page_id", F.array_join(H.html_lines("html"), "\n").alias("lines")))

_bl, _inner = blocks_list_sql("html")
register("html_blocks", f"""SELECT page_id, CASE WHEN len({_bl}) > 0 THEN array_to_string({keep_first_sql(_bl)}, chr(10))
    ELSE {strip_sql(_inner)} END AS blocks FROM pages""")(
    lambda spark, sf: pages(spark, sf).select("page_id", H.html_blocks("html").alias("blocks")))

register("html_prose_blocks", f"""SELECT page_id, coalesce({keep_first_sql(_bl)}[1], '') AS job_description,
    coalesce({keep_first_sql(_bl)}[2], '') AS qualifications, coalesce({keep_first_sql(_bl)}[3], '') AS benefit
    FROM pages""")(
    lambda spark, sf: pages(spark, sf).select(
        "page_id", *[F.coalesce(F.try_element_at(H.prose_blocks("html"), F.lit(i + 1)), F.lit("")).alias(n)
                     for i, n in enumerate(["job_description", "qualifications", "benefit"])]))

# sections under <b> headings
_art = f"regexp_extract({visible_sql('html')}, {O.q('(?is)<article(' + chr(92) + 's[^>]*)?>(.*)</article>')}, 2)"
_secs = (f"list_transform(regexp_split_to_array({_art}, {O.q('(?i)<b(' + chr(92) + 's[^>]*)?>')})[2:], lambda s: "
         f"{{'heading': {strip_sql(chr(40) + 'regexp_extract(s, ' + O.q('(?is)^(.*?)(</b>|<br' + chr(92) + 's*/?>)') + ', 1)' + chr(41))}, "
         f"'body': {strip_sql(chr(40) + 'regexp_replace(s, ' + O.q('(?is)^(.*?)(</b>|<br' + chr(92) + 's*/?>)') + ', ' + O.q('') + ')' + chr(41))}}})")
register("html_sections", f"SELECT page_id, CAST(len({_secs}) AS INTEGER) AS n_sections FROM pages")(
    lambda spark, sf: pages(spark, sf).select("page_id", F.size(H.sections("html")).alias("n_sections")))


# ---------------------------------------------------------------- links and URLs
def _links_sql(x: str, url: str) -> str:
    base = f"regexp_extract({url}, '^(https?://[^/?#]+)', 1)"
    hrefs = f"regexp_extract_all({visible_sql(x)}, {O.q('(?i)<a' + chr(92) + 's[^>]*href=' + chr(34) + '([^' + chr(34) + ']*)' + chr(34))}, 1)"
    res = (f"list_transform({hrefs}, lambda h: regexp_replace(CASE WHEN regexp_matches(h, '^https?://') THEN h "
           f"WHEN starts_with(h, '/') THEN {base} || h ELSE {base} || '/' || h END, '[;?#].*$', ''))")
    return f"list_filter({res}, lambda u: regexp_extract(u, '^(https?://[^/?#]+)', 1) = {base})"


register("html_links", f"""SELECT page_id, array_to_string(list_sort(list_distinct({_links_sql('html', 'url')})), ' ')
    AS links FROM pages""")(
    lambda spark, sf: pages(spark, sf).select("page_id", F.array_join(H.html_links("html", "url"), " ").alias("links")))

register("url_normalise", "SELECT page_id, regexp_replace(url, '[;?#].*$', '') AS url FROM pages")(
    lambda spark, sf: pages(spark, sf).select("page_id", H.url_normalise("url").alias("url")))
register("url_with_page", W(POSTING, """SELECT post_id, regexp_replace(source_url, '[?#].*$', '') || '?' || array_to_string(
    CASE WHEN list_bool_or(list_transform(ps, lambda p: starts_with(p, 'page=')))
         THEN list_transform(ps, lambda p: CASE WHEN starts_with(p, 'page=') THEN 'page=7' ELSE p END)
         ELSE list_concat(ps, ['page=7']) END, '&') AS url
    FROM (SELECT post_id, source_url, list_filter(string_split(regexp_extract(source_url, '\\?([^#]*)', 1), '&'),
          lambda p: regexp_matches(p, '^[^=]+=.+$')) AS ps FROM raw)"""))(
    lambda spark, sf: C.postings(spark, sf).select("post_id", H.url_with_page(F.col("source_url"), 7).alias("url")))


@register("first_seen_urls", f"""
WITH l AS (SELECT page_id, unnest({_links_sql('html', 'url')}) AS u, generate_subscripts({_links_sql('html', 'url')}, 1) AS pos
           FROM pages)
SELECT u AS url, min({{'p': page_id, 'q': pos}}).p AS first_page, CAST(min({{'p': page_id, 'q': pos}}).q AS INTEGER) AS first_pos,
       count(*) AS seen FROM l GROUP BY u""")
def q_first_seen(spark, sf):
    p = pages(spark, sf)
    base = F.regexp_extract("url", "^(https?://[^/?#]+)", 1)
    hrefs = F.regexp_extract_all(H.visible("html"), F.lit("(?i)<a\\s[^>]*href=\"([^\"]*)\""), 1)
    res = F.transform(hrefs, lambda h: H.url_normalise(F.when(h.rlike("^https?://"), h)
                                                       .when(h.startswith("/"), F.concat(base, h))
                                                       .otherwise(F.concat(base, F.lit("/"), h))))
    same = F.filter(res, lambda u: F.regexp_extract(u, "^(https?://[^/?#]+)", 1) == base)
    ex = p.select("page_id", F.posexplode(same).alias("pos0", "url"))
    first = ex.groupBy("url").agg(F.min(F.struct("page_id", (F.col("pos0") + 1).alias("pos"))).alias("f"),
                                  F.count(F.lit(1)).alias("seen"))
    return first.select("url", F.col("f.page_id").alias("first_page"), F.col("f.pos").alias("first_pos"), "seen")


@register("html_list_links", """
WITH li AS (SELECT page_id, unnest(regexp_extract_all(html, '(?is)<li[^>]*>(.*?)</li>', 1)) AS card,
                   generate_subscripts(regexp_extract_all(html, '(?is)<li[^>]*>(.*?)</li>', 1), 1) AS pos, url FROM pages),
c AS (SELECT page_id, pos, regexp_extract(url, '^(https?://[^/?#]+)', 1) || regexp_extract(card, '(?i)href="(/[^"]*)"', 1)
             AS detail, trim(regexp_replace(regexp_replace(card, '<[^>]*>', ' ', 'g'), '\\s+', ' ', 'g')) AS title
      FROM li WHERE regexp_extract(card, '(?i)href="(/[^"]*)"', 1) <> ''),
c2 AS (SELECT * FROM c WHERE title <> '' AND lower(title) NOT IN ('apply now', 'ứng tuyển ngay'))
SELECT regexp_replace(detail, '[;?#].*$', '') AS url, min({'p': page_id, 'q': pos, 't': title}).t AS title,
       min({'p': page_id, 'q': pos, 't': title}).p AS first_page FROM c2 GROUP BY regexp_replace(detail, '[;?#].*$', '')""")
def q_list_links(spark, sf):
    p = pages(spark, sf)
    cards = F.regexp_extract_all("html", F.lit("(?is)<li[^>]*>(.*?)</li>"), 1)
    ex = p.select("page_id", "url", F.posexplode(cards).alias("pos0", "card"))
    href = F.regexp_extract("card", "(?i)href=\"(/[^\"]*)\"", 1)
    c = ex.where(href != "").select(
        "page_id", (F.col("pos0") + 1).alias("pos"),
        H.url_normalise(F.concat(F.regexp_extract("url", "^(https?://[^/?#]+)", 1), href)).alias("url"),
        F.trim(F.regexp_replace(F.regexp_replace("card", "<[^>]*>", " "), "\\s+", " ")).alias("title"))
    c = c.where((F.col("title") != "") & ~F.lower("title").isin("apply now", "ứng tuyển ngay"))
    first = c.groupBy("url").agg(F.min(F.struct("page_id", "pos", "title")).alias("f"))
    return first.select("url", F.col("f.title").alias("title"), F.col("f.page_id").alias("first_page"))


# ---------------------------------------------------------------- line predicates / labelled values
register("line_is_salary", W(POSTING, f"""SELECT post_id, lower(trim(regexp_replace(coalesce(salary_raw, ''), '\\s+', ' ', 'g')))
    IN ({', '.join(O.q(x) for x in SALARY_HEADER_EXACT)}) OR (length(trim(regexp_replace(coalesce(salary_raw, ''), '\\s+', ' ', 'g'))) <= 120
    AND regexp_matches(salary_raw, '[0-9]') AND {any_instr_lower('salary_raw', SALARY_HEADER_UNITS)}) AS is_salary FROM raw"""))(
    lambda spark, sf: __import__("hiresight.sources.postings", fromlist=["x"]).raw_postings(spark, sf).select(
        "post_id", H.line_is_salary(F.col("salary_raw")).alias("is_salary")))

LINES_CTE = PAGES_CTE + f""",
ln AS (SELECT post_id, url, html, {lines_sql('html')} AS ls FROM pp)"""
NOISE_SQL = ", ".join(O.q(x) for x in NOISE_LINES)
register("line_is_noise", W(LINES_CTE, f"""SELECT post_id, CAST(len(list_filter(ls, lambda s: lower(trim(s)) IN ({NOISE_SQL}))) AS INTEGER)
    AS noise_lines FROM ln"""))(
    lambda spark, sf: with_lines(spark, sf).select("post_id", F.size(F.filter("_lines", lambda s: H.line_is_noise(s))).alias("noise_lines")))


def label_sql(labels, max_len: int) -> str:
    """Oracle of labelled_value over ``ls``: same-line rest, else the next acceptable line (6 ahead at most)."""
    labs = [x.lower() for x in labels]
    starts = " OR ".join(f"lower(ls[i]) = {O.q(x)} OR starts_with(lower(ls[i]), {O.q(x + ' ')}) OR starts_with(lower(ls[i]), {O.q(x + ':')})" for x in labs)
    i = f"list_filter(generate_series(1, len(ls)), lambda i: {starts})[1]"
    rest = f"ls[{i}]"
    for x in labels:
        rest = f"regexp_replace({rest}, {O.q('(?i)^' + x + chr(92) + 's*:?' + chr(92) + 's*')}, '')"
    rest, labl = f"trim({rest})", ", ".join(O.q(x) for x in labs)
    ok = lambda c: f"{c} <> '' AND length({c}) <= {max_len} AND lower(trim({c})) NOT IN ({NOISE_SQL}) AND lower({c}) NOT IN ({labl})"
    return (f"(CASE WHEN {i} IS NULL THEN '' WHEN {ok(rest)} THEN {rest} "
            f"ELSE coalesce(list_filter(ls[{i} + 1:{i} + 6], lambda c: {ok('c')})[1], '') END)")


ANY_LABELS = ["Working location", "Industry", "Company size"]
register("html_labelled_line", W(LINES_CTE, f"SELECT post_id, {label_sql(ANY_LABELS, 160)} AS value FROM ln"))(
    lambda spark, sf: with_lines(spark, sf).select("post_id", H.labelled_value(F.col("_lines"), ANY_LABELS).alias("value")))
register("html_industry", W(LINES_CTE, f"SELECT post_id, {label_sql(H.INDUSTRY_LABELS, 100)} AS industry FROM ln"))(
    lambda spark, sf: with_lines(spark, sf).select("post_id", H.labelled_value(F.col("_lines"), H.INDUSTRY_LABELS, max_len=100).alias("industry")))
register("html_location", W(LINES_CTE, f"SELECT post_id, {label_sql(H.PLACE_LABELS, 160)} AS location FROM ln"))(
    lambda spark, sf: with_lines(spark, sf).select("post_id", H.labelled_value(F.col("_lines"), H.PLACE_LABELS).alias("location")))
register("html_info_fields", W(LINES_CTE, """SELECT post_id, array_to_string(list_transform(list_filter(ls, lambda s:
    regexp_matches(s, '^[^:]{1,40}:\\s*\\S.*$')), lambda s: trim(regexp_extract(s, '^([^:]{1,40}):', 1)) || '=' ||
    trim(regexp_extract(s, '^[^:]{1,40}:\\s*(\\S.*)$', 1))), '|') AS fields FROM ln"""))(
    lambda spark, sf: with_lines(spark, sf).select("post_id", F.array_join(F.transform(
        H.info_fields(F.col("_lines")), lambda p: F.concat(p["label"], F.lit("="), p["value"])), "|").alias("fields")))


def _posting_lines():
    return F.filter(F.array(F.col("title"), F.coalesce(F.col("salary_raw"), F.lit("")), F.col("city_raw"),
                            F.col("exp_raw"), F.lit("your role"), F.col("description")), lambda s: s != "")


@register("html_header_lines", W(POSTING, f"""
, pl AS (SELECT r.post_id, list_filter([p.title, coalesce(r.salary_raw, ''), p.city_raw, p.exp_raw, 'your role', p.description],
                                       lambda s: s <> '') AS ls FROM raw r JOIN posting p ON r.post_id = p.post_id),
pos AS (SELECT post_id, ls, list_position(list_transform(ls, lambda s: lower(trim(regexp_replace(s, '\\s+', ' ', 'g'))) IN
          ({', '.join(O.q(x) for x in SALARY_HEADER_EXACT)}) OR (length(trim(regexp_replace(s, '\\s+', ' ', 'g'))) <= 120
          AND regexp_matches(s, '[0-9]') AND {any_instr_lower('s', SALARY_HEADER_UNITS)})), true) AS sp FROM pl),
aft AS (SELECT post_id, CASE WHEN sp > 0 THEN ls[sp + 1:] ELSE []::VARCHAR[] END AS a FROM pos),
upto AS (SELECT post_id, CASE WHEN list_position(list_transform(a, lambda s: lower(s) IN
          ({', '.join(O.q(x) for x in SECTION_STOP_WORDS)})), true) > 0 THEN a[1:list_position(list_transform(a, lambda s: lower(s) IN
          ({', '.join(O.q(x) for x in SECTION_STOP_WORDS)})), true) - 1] ELSE a END AS u FROM aft),
meta AS (SELECT post_id, list_filter(u, lambda s: length(s) <= 140 AND lower(trim(s)) NOT IN ({', '.join(O.q(x) for x in NOISE_LINES)})) AS m FROM upto)
SELECT post_id, coalesce(m[1], '') AS location, coalesce(m[2], '') AS level, coalesce(m[3], '') AS experience FROM meta"""
    .replace("\n, pl AS", ",\npl AS", 1)))
def q_header(spark, sf):
    from ..sources.postings import raw_postings
    r = raw_postings(spark, sf).select("post_id", "salary_raw")
    p = C.postings(spark, sf).join(r, "post_id")
    h = H.header_fields(_posting_lines())
    return p.select("post_id", h["location"].alias("location"), h["level"].alias("level"),
                    h["experience"].alias("experience"))


COMPANY_SQL = f"coalesce(list_filter(ls, lambda s: length(s) <= 120 AND {any_instr_lower('s', COMPANY_LEGAL_WORDS)})[1], '')"
SIZE_PATTERN_SQL = f"regexp_extract({strip_sql('html')}, '(?i)\\b\\d[\\d.,]*\\s*-\\s*\\d[\\d.,]*\\s*(employees|nhân viên)', 0)"
SIZE_SQL = f"coalesce(nullif({label_sql(H.SIZE_LABELS, 80)}, ''), {SIZE_PATTERN_SQL})"
register("html_company", W(LINES_CTE, f"SELECT post_id, {COMPANY_SQL} AS company FROM ln"))(
    lambda spark, sf: with_lines(spark, sf).select("post_id", H.company_from_lines(F.col("_lines")).alias("company")))


@register("html_size", W(LINES_CTE, f"SELECT post_id, {SIZE_SQL} AS size FROM ln"))
def q_size(spark, sf):
    size = H.labelled_value(F.col("_lines"), H.SIZE_LABELS, max_len=80)
    return with_lines(spark, sf).select("post_id", F.when(size != "", size).otherwise(H.size_fallback(H.strip_tags("html"))).alias("size"))


register("html_working_form_text", W(POSTING, f"""SELECT post_id, coalesce(CASE lower(trim(regexp_replace(working_form, '\\s+', ' ', 'g')))
    {' '.join(f"WHEN {O.q(k)} THEN {O.q(v)}" for k, v in WORKING_FORMS)} END, '') AS working_form FROM posting"""))(
    lambda spark, sf: C.postings(spark, sf).select(
        "post_id", H.working_form(F.array(text_clean(F.col("working_form")))).alias("working_form")))


def _sections_cte() -> str:
    none, split, end = "''", "(?i)<(?:h2|h3|b)(?:\\s[^>]*)?>", "(?is)^(.*?)(?:</(?:h2|h3|b)>|<br\\s*/?>)"
    return (f"sec AS (SELECT post_id, list_transform(regexp_split_to_array({visible_sql('html')}, {O.q(split)})[2:], lambda s: "
            f"{{'heading': {strip_sql(f'regexp_extract(s, {O.q(end)}, 1)')}, 'body': {strip_sql(f'regexp_replace(s, {O.q(end)}, {none})')}}}) AS secs FROM pp)")


def section_sql(words) -> str:
    return f"coalesce(list_filter(secs, lambda s: length(s.heading) <= 120 AND {any_instr_lower('s.heading', [w for w in words])})[1].body, '')"


HEADINGS_CTE = LINES_CTE + ",\n" + _sections_cte()
register("html_section_by_heading", W(HEADINGS_CTE, f"""SELECT post_id, {section_sql(H.ROLE_WORDS)} AS job_description,
    {section_sql(H.SKILL_WORDS)} AS qualifications, {section_sql(H.BENEFIT_WORDS)} AS benefit FROM sec"""))(
    lambda spark, sf: posting_pages(spark, sf).select("post_id", H.heading_sections("html").alias("s")).select(
        "post_id", H.section_of(F.col("s"), H.ROLE_WORDS).alias("job_description"),
        H.section_of(F.col("s"), H.SKILL_WORDS).alias("qualifications"), H.section_of(F.col("s"), H.BENEFIT_WORDS).alias("benefit")))

_A = "(?is)<a\\s[^>]*href=[\"'']([^\"'']*)[\"''][^>]*>(.*?)</a>"
TITLE_SQL = f"""(CASE WHEN {first_elem_sql('html', 'h1')} <> '' THEN {first_elem_sql('html', 'h1')} ELSE coalesce(list_filter(list_transform(
    list_zip(regexp_extract_all({visible_sql('html')}, '{_A}', 1), regexp_extract_all({visible_sql('html')}, '{_A}', 2)),
    lambda a: {{'p': regexp_extract(a[1], '^(?:https?://[^/?#]+)?([^;?#]*)', 1), 't': {strip_sql('a[2]')}}}),
    lambda a: a.t <> '' AND a.p = regexp_extract(url, '^(?:https?://[^/?#]+)?([^;?#]*)', 1))[1].t, {first_elem_sql('html', 'title')}) END)"""
register("html_detail_title", W(PAGES_CTE, f"SELECT post_id, {TITLE_SQL} AS title FROM pp"))(
    lambda spark, sf: posting_pages(spark, sf).select("post_id", H.detail_title("html", "url").alias("title")))

_sal_lo, _sal_hi = O.salary_text_b_sql("sal")
_IS_SALARY = (f"(lower(trim(regexp_replace(s, '\\s+', ' ', 'g'))) IN ({', '.join(O.q(x) for x in SALARY_HEADER_EXACT)}) OR "
              f"(length(trim(regexp_replace(s, '\\s+', ' ', 'g'))) <= 120 AND regexp_matches(s, '[0-9]') AND {any_instr_lower('s', SALARY_HEADER_UNITS)}))")
_STOP = ", ".join(O.q(x) for x in SECTION_STOP_WORDS)


@register("page_to_record", W(HEADINGS_CTE + f""",
hd AS (SELECT *, list_filter(ls, lambda s: {_IS_SALARY})[1] AS sal0, list_position(list_transform(ls, lambda s: {_IS_SALARY}), true) AS sp FROM ln),
af AS (SELECT *, CASE WHEN sp > 0 THEN ls[sp + 1:] ELSE []::VARCHAR[] END AS aft FROM hd),
st AS (SELECT *, coalesce(list_position(list_transform(aft, lambda s: lower(s) IN ({_STOP})), true), 0) AS stop FROM af),
mt AS (SELECT *, coalesce(sal0, '') AS sal, list_filter(CASE WHEN stop > 0 THEN aft[1:stop - 1] ELSE aft END,
              lambda s: length(s) <= 140 AND lower(trim(s)) NOT IN ({NOISE_SQL})) AS m FROM st)""", f"""
SELECT post_id, {TITLE_SQL} AS job_title, {_sal_lo} AS salary_min, {_sal_hi} AS salarry_max, coalesce(m[1], '') AS location,
    coalesce(m[3], '') AS experience, {section_sql(H.ROLE_WORDS)} AS job_description, {section_sql(H.SKILL_WORDS)} AS qualifications,
    {section_sql(H.BENEFIT_WORDS)} AS benefit, {label_sql(H.PLACE_LABELS, 160)} AS job_location, {COMPANY_SQL} AS company,
    {SIZE_SQL} AS size, {label_sql(H.INDUSTRY_LABELS, 100)} AS industry, coalesce(m[2], '') AS level,
    coalesce(list_filter(list_transform(list_filter(ls, lambda s: length(s) <= 30), lambda s: CASE lower(s)
      {' '.join(f"WHEN {O.q(k)} THEN {O.q(v)}" for k, v in WORKING_FORMS)} END), lambda s: s IS NOT NULL)[1], '') AS "working form",
    sal AS salary_raw, '2026-01-01' AS crawl_date, regexp_replace(url, '[;?#].*$', '') AS source_url, 'pages' AS source
FROM mt JOIN sec USING (post_id)"""))
def q_page_to_record(spark, sf):
    """The whole 18-field record of every detail page."""
    return H.page_records(posting_pages(spark, sf), "pages", "2026-01-01", keep=["post_id"])


# ---------------------------------------------------------------- rules on nodes (answers known from the postings)
FORM_SQL = NP.FORM.format(div="//")


@register("html_cards", W(POSTING, f"""SELECT '{NP.HOST}/detail-jobs/' || CAST(post_id % 3000 AS VARCHAR) AS source_url,
    arg_min(trim(title || ' ' || CAST(post_id AS VARCHAR)), post_id) AS title, min(post_id) // 10 AS first_page FROM raw GROUP BY post_id % 3000"""))
def q_cards(spark, sf):
    return N.cards(NP.list_pages(spark, sf)).select("source_url", "title", "first_page")


@register("html_working_form", W(POSTING, f"""SELECT '{NP.HOST}/detail-jobs/' || CAST(post_id % 3000 AS VARCHAR) AS source_url,
    arg_min(CASE WHEN post_id % 6 = 3 THEN '' ELSE {FORM_SQL} END, post_id) AS working_form FROM raw GROUP BY post_id % 3000"""))
def q_card_form(spark, sf):
    return N.cards(NP.list_pages(spark, sf)).select("source_url", "working_form")


@register("html_labelled_value", W(POSTING, "SELECT post_id, CASE WHEN post_id % 6 = 4 THEN '' ELSE 'Field ' || CAST(post_id % 50 AS VARCHAR) END AS value FROM raw"))
def q_labelled(spark, sf):
    return N.labelled_values(NP.label_pages(spark, sf), H.INDUSTRY_LABELS, key="post_id")


@register("html_header_fields", W(POSTING, f"""SELECT post_id, t AS job_title,
    CASE post_id % 5 WHEN 0 THEN '10 triệu' WHEN 1 THEN 'Thoả thuận' WHEN 3 THEN '900 USD' ELSE '' END AS salary_raw,
    CASE WHEN post_id % 5 IN (0, 1, 3) THEN c ELSE '' END AS location, CASE WHEN post_id % 5 IN (0, 1, 3) THEN l ELSE '' END AS level,
    CASE WHEN post_id % 5 IN (0, 3) THEN e ELSE '' END AS experience FROM (SELECT post_id, {NP.HEADER_PARTS} FROM raw)"""))
def q_header_nodes(spark, sf):
    return N.header_fields(NP.header_pages(spark, sf), key="post_id")
