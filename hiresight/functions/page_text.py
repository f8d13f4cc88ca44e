"""Fields of a whole page in plain Python, for tasks that read pages in Arrow batches.

Each function gives what the Column function of the same name in ``html`` (and
``salary``) gives: there a field runs its patterns over the page again, here the
page's lines and sections are taken once.  ``tests/test_parsers.py`` holds both
against each other.
"""

from __future__ import annotations

import re
import sys
import unicodedata
from collections.abc import Callable, Iterable

from pyspark import cloudpickle

from . import html as H
from .constants import (COMPANY_LEGAL_WORDS, FROM_WORDS_B, MILLION_WORDS, NEGOTIABLE_WORDS_B, NOISE_LINES, SALARY_HEADER_EXACT,
                        SALARY_HEADER_UNITS, SECTION_STOP_WORDS, THOUSAND_WORDS, UP_TO_WORDS_B, WORKING_FORMS)

# executors need not have this package: its functions travel with the tasks
cloudpickle.register_pickle_by_value(sys.modules[__name__])

# patterns of the Column functions: Java's \s, \d and (?i) know ASCII only
_java = lambda pattern: re.compile(pattern, re.ASCII)
INVISIBLE, BLOCK, TAG = _java(H.INVISIBLE), _java(H.BLOCK_TAGS.replace("(p|", "(?:p|").replace("(\\s", "(?:\\s")), _java("<[^>]*>")
TAG_OF_LINE, HEADING, HEADING_END = _java("<[^>\n]*>"), _java("(?i)<(?:h2|h3|b)(?:\\s[^>]*)?>"), _java("(?i)</(?:h2|h3|b)>|<br\\s*/?>")
ARTICLE, ANCHOR = _java("(?is)<article(?:\\s[^>]*)?>(.*)</article>"), _java("(?is)<a\\s[^>]*href=[\"']([^\"']*)[\"'][^>]*>(.*?)</a>")
FIRST = {tag: _java(f"(?is)<{tag}(?:\\s[^>]*)?>(.*?)</{tag}>") for tag in ("h1", "title")}
URL_PATH = _java("(?:https?://[^/?#]+)?([^;?#]*)")
#: a size_fallback holds one of the words, and its text this pattern
SIZE_WORDS, SIZE = ("employees", "viên"), _java("(?i)\\d[\\d.,]*\\s*-\\s*\\d[\\d.,]*\\s*(?:employees|nhân viên)")
NUMBER, GROUPED, DIGIT = _java("\\d[\\d.,]*"), _java("[.,][0-9]{3}\\Z"), _java("[0-9]")
#: white space of Java's Unicode class; ``str.split`` takes four separators more
SPACE = re.compile("[\t-\r \x85\xa0  -     　]+")
ENTITIES, FORMS, NOISE, STOPS, EXACT = H.ENTITIES, dict(WORKING_FORMS), frozenset(NOISE_LINES), frozenset(SECTION_STOP_WORDS), frozenset(SALARY_HEADER_EXACT)
MOST = 2**63 - 1


def text_clean(text: str) -> str:
    if "\x1c" in text or "\x1d" in text or "\x1e" in text or "\x1f" in text:
        return SPACE.sub(" ", text).strip(" ")
    return " ".join(text.split())


def unescape(text: str) -> str:
    if "&" in text:
        for entity, ch in ENTITIES:
            text = text.replace(entity, ch)
    return text


def strip_tags(text: str) -> str:
    return text_clean(unescape(TAG.sub(" ", text) if "<" in text else text))


def contains_any(text: str, words: Iterable[str]) -> bool:
    for w in words:
        if w in text:
            return True
    return False


def html_lines(visible: str) -> list[str]:
    """Lines of a page's ``visible`` text."""
    found, clean = [], text_clean if any(c in visible for c in "\x1c\x1d\x1e\x1f") else None
    for piece in BLOCK.split(visible):  # neither a tag inside a line nor an entity reaches over a block tag
        if not piece:
            continue
        if "<" in piece:
            piece = TAG_OF_LINE.sub(" ", piece)
        if "&" in piece:
            piece = unescape(piece)
        if clean or "\n" in piece:
            found.extend(t for p in piece.split("\n") if (t := text_clean(p)))
        elif words := piece.split():
            found.append(" ".join(words))
    return found


def section_of(sections: list[list], words: list[str]) -> str:
    """Body of the first section whose heading has one of the words; ``sections``: [heading, lowered, body or None, source]."""
    for s in sections:
        if len(s[0]) <= 120 and contains_any(s[1], words):
            if s[2] is None:
                s[2] = strip_tags(s[3])
            return s[2]
    return ""


def heading_sections(visible: str) -> list[list]:
    found = []
    for piece in HEADING.split(visible)[1:]:
        end = HEADING_END.search(piece)
        heading = strip_tags(piece[:end.start()]) if end else ""
        found.append([heading, heading.lower(), None, piece[end.end():] if end else piece])
    return found


def prose_blocks(visible: str) -> list[str]:
    inner = ARTICLE.search(visible)
    return list(dict.fromkeys(t for p in BLOCK.split(inner.group(1)) if (t := strip_tags(p)))) if inner else []


def first_element_text(page: str, tag: str) -> str:
    found = FIRST[tag].search(page)
    return strip_tags(found.group(1)) if found else ""


def detail_title(page: str, visible: str, url: str | None) -> str:
    h1 = first_element_text(page, "h1")
    if h1:
        return h1
    here = None if url is None else URL_PATH.match(url).group(1)
    for a in ANCHOR.finditer(visible) if here is not None else ():
        if URL_PATH.match(a.group(1)).group(1) == here and (text := strip_tags(a.group(2))):
            return text
    return first_element_text(page, "title")


def line_is_salary(line: str, low: str) -> bool:
    """Whether a line without runs of blanks is one of salary; ``low``: the line in lower case."""
    return low in EXACT or (len(line) <= 120 and contains_any(low, SALARY_HEADER_UNITS) and DIGIT.search(line) is not None)


def header_fields(lines: list[str], lows: list[str], salary: int) -> tuple[str, str, str]:
    """(location, level, experience) from the lines after the salary's, the one at ``salary`` (-1: there is none)."""
    found: list[str] = []
    for i in range(salary + 1, len(lines) if salary >= 0 else 0):
        if lows[i] in STOPS or len(found) == 3:
            break
        if len(lines[i]) <= 140 and lows[i] not in NOISE:
            found.append(lines[i])
    return (*found, "", "", "")[:3]


def company_from_lines(lines: list[str], lows: list[str]) -> str:
    page = "\n".join(lows)  # no word reaches over a line's end
    at = min((i for w in COMPANY_LEGAL_WORDS if (i := page.find(w)) >= 0), default=None)
    first = len(lines) if at is None else page.count("\n", 0, at)
    return next((lines[i] for i in range(first, len(lines)) if len(lines[i]) <= 120 and contains_any(lows[i], COMPANY_LEGAL_WORDS)), "")


def value_finder(labels: list[str], max_len: int = 160, max_lookahead: int = 6) -> Callable[[list[str], list[str], list[int]], str]:
    """``labelled_value`` of a page's lines, their lower-case forms and the numbers of those that may start with a label."""
    own = [_java(f"(?i)^{x}\\s*:?\\s*") for x in labels]
    low = [x.lower() for x in labels]
    barred = frozenset([*low, *NOISE])

    def ok(line: str, lowered: str) -> bool:
        return line != "" and len(line) <= max_len and lowered not in barred

    def find(lines: list[str], lows: list[str], labelled: list[int]) -> str:
        for i in labelled:
            s = lows[i]
            if any(s.startswith(x) and (len(s) == len(x) or s[len(x)] in " :") for x in low):
                rest = lines[i]
                for pattern in own:
                    rest = pattern.sub("", rest, count=1)
                rest = rest.strip(" ")
                if ok(rest, rest.lower()):
                    return rest
                return next((lines[j] for j in range(i + 1, min(i + 1 + max_lookahead, len(lines))) if ok(lines[j], lows[j])), "")
        return ""

    return find


def _amount(token: str, unit: int) -> int | None:
    if GROUPED.search(token):
        n = int(token.replace(".", "").replace(",", "")) if len(token) < 4000 else MOST + 1
    else:
        try:
            d = float(token.replace(",", "."))
        except ValueError:
            return None
        n = MOST + 1 if d > 2.0**63 else min(int(d), MOST)
    return n * unit if n <= MOST and n * unit <= MOST else None


def parse_salary_text_b(raw: str) -> tuple[str, str]:
    text = text_clean(raw.lower().replace("\xa0", " "))
    if raw == "" or contains_any(text, NEGOTIABLE_WORDS_B):
        return "", ""
    word = lambda i: 0 <= i < len(text) and (text[i] == "_" or unicodedata.category(text[i])[0] in "LN")
    alone = lambda: any(not word(m.start() - 1) and not word(m.end()) for m in re.finditer("k", text))
    unit = 1_000_000 if contains_any(text, MILLION_WORDS) else 1_000 if contains_any(text, THOUSAND_WORDS) or alone() else 1
    values = [str(v) for t in NUMBER.findall(text) if (v := _amount(t, unit)) is not None][:2]
    if len(values) != 1:
        return (values[0], values[1]) if values else ("", "")
    if contains_any(text, UP_TO_WORDS_B):
        return "", values[0]
    return values[0], "" if contains_any(text, FROM_WORDS_B) else values[0]


#: what ``record`` returns of a page and its url, in this order; ``_text``: the page's whole text if a size may be read from it
FIELDS = ("job_title", "salary_min", "salarry_max", "location", "experience", "job_description", "qualifications", "benefit",
          "job_location", "company", "size", "industry", "level", "working form", "salary_raw", "_text")
_place, _size, _industry = value_finder(H.PLACE_LABELS), value_finder(H.SIZE_LABELS, 80), value_finder(H.INDUSTRY_LABELS, 100)
_LABELS = tuple(x.lower() for x in [*H.PLACE_LABELS, *H.SIZE_LABELS, *H.INDUSTRY_LABELS])
_WORDS = [[w.lower() for w in words] for words in (H.ROLE_WORDS, H.SKILL_WORDS, H.BENEFIT_WORDS)]


def record(page: str | None, url: str | None) -> tuple:
    if page is None:
        return NULL_PAGE
    visible = INVISIBLE.sub(" ", page)
    lines = html_lines(visible)
    lows = [s.lower() for s in lines]
    at = next((i for i, low in enumerate(lows) if line_is_salary(lines[i], low)), -1)
    salary = lines[at] if at >= 0 else ""
    location, level, experience = header_fields(lines, lows, at)
    sections, blocks, parts = heading_sections(visible), None, []
    for i, words in enumerate(_WORDS):
        part = section_of(sections, words)
        if not part:
            blocks = prose_blocks(visible) if blocks is None else blocks
            part = blocks[i] if i < len(blocks) else ""
        parts.append(part)
    labelled = [i for i, low in enumerate(lows) if low.startswith(_LABELS)]
    size, text = _size(lines, lows, labelled), None
    if not size and contains_any(page.lower(), SIZE_WORDS):
        text = strip_tags(page)
        text = text if SIZE.search(text) else None
    form = next((FORMS[low] for i, low in enumerate(lows) if low in FORMS and len(lines[i]) <= 30), "")
    return (detail_title(page, visible, url), *parse_salary_text_b(salary), location, experience, *parts, _place(lines, lows, labelled), company_from_lines(lines, lows), size,
            _industry(lines, lows, labelled), level, form, salary, text)


NULL_PAGE = ("",) * (len(FIELDS) - 1) + (None,)
