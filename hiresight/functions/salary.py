"""Salary parsing: free-text salary lines and min/max midpoints."""

from __future__ import annotations

from pyspark.sql import Column
from pyspark.sql import functions as F

from .constants import (FROM_WORDS_A, FROM_WORDS_B, MILLION_WORDS, NEGOTIABLE_WORDS_A,
                        NEGOTIABLE_WORDS_B, THOUSAND_WORDS, UP_TO_WORDS_A, UP_TO_WORDS_B)
from .text import WORD_CLASS, contains_any, let


def _c(c) -> Column:
    return F.col(c) if isinstance(c, str) else c


def safe_numeric(c) -> Column:
    """String/number -> double, bad values -> null (NaN counts as missing too)."""
    x = _c(c).try_cast("double")
    return F.when(F.isnan(x), F.lit(None).cast("double")).otherwise(x)


def salary_midpoint(min_c, max_c) -> Column:
    """Million VND from a (min, max) pair in VND.

    both > 0 -> mean; else min > 0 -> min; else max > 0 -> max; else null; rounded to 1 dp.
    """
    lo, hi = safe_numeric(min_c), safe_numeric(max_c)
    return (F.when((lo > 0) & (hi > 0), F.round((lo + hi) / 2 / 1_000_000, 1))
            .when(lo > 0, F.round(lo / 1_000_000, 1))
            .when(hi > 0, F.round(hi / 1_000_000, 1)))


def _pair(values: Column, text: Column, up_to, from_words) -> Column:
    """struct(salary_min, salary_max) as strings from the numbers of a text, '' when missing."""
    empty = F.lit("")

    def pick(v):
        first, second = F.try_element_at(v, F.lit(1)).cast("string"), F.try_element_at(v, F.lit(2)).cast("string")
        n = F.size(v)
        up, from_ = contains_any(text, up_to), contains_any(text, from_words)
        lo = F.when(n == 0, empty).when(n >= 2, first).when(up, empty).otherwise(first)
        hi = F.when(n == 0, empty).when(n >= 2, second).when(up, first).when(from_, empty).otherwise(first)
        return F.struct(lo.alias("salary_min"), hi.alias("salary_max"))

    return let(values, pick)


def _parse(raw: Column, text: Column, negotiable, parse) -> Column:
    """Empty strings for a blank or negotiable text, else ``parse(text)``; the text is prepared once."""
    none = F.struct(F.lit("").alias("salary_min"), F.lit("").alias("salary_max"))
    blank = F.coalesce(raw, F.lit("")) == ""
    return F.when(blank, none).otherwise(let(text, lambda t: F.when(contains_any(t, negotiable), none).otherwise(parse(t))))


def parse_salary_text_a(raw) -> Column:
    """First feed's parser -> struct(salary_min string, salary_max string).

    lower, ',' -> '.', negotiable -> empty; unit triệu = 1e6, else thousand words
    or any 'k' = 1e3; numbers d+(.d+)? times unit, truncated; 2+ numbers -> first two;
    one number -> max for 'up to' words, min for 'from' words, else both.  A
    number beyond bigint counts as none.
    """
    r = _c(raw)
    text = F.trim(F.regexp_replace(F.replace(F.lower(r), F.lit(","), F.lit(".")), "(?U)\\s+", " "))

    def parse(t):
        mult = (F.when(contains_any(t, MILLION_WORDS), F.lit(1_000_000.0))
                .when(contains_any(t, THOUSAND_WORDS + ["k"]), F.lit(1_000.0)).otherwise(F.lit(1.0)))
        nums = F.regexp_extract_all(t, F.lit("\\d+(?:\\.\\d+)?"), 0)
        values = F.array_compact(let(mult, lambda m: F.transform(nums, lambda n: (n.cast("double") * m).try_cast("bigint"))))
        return _pair(values, t, UP_TO_WORDS_A, FROM_WORDS_A)

    return _parse(r, text, NEGOTIABLE_WORDS_A, parse)


def normalise_salary_number(tok: Column) -> Column:
    """'40.000.000' -> 40000000 (thousand groups); '12,5' -> 12 (truncated); bad -> null."""
    grouped = tok.rlike("[.,][0-9]{3}$")
    return F.when(grouped, F.regexp_replace(tok, "[.,]", "").try_cast("bigint")).otherwise(
        F.replace(tok, F.lit(","), F.lit(".")).try_cast("double").try_cast("bigint"))


def parse_salary_text_b(raw) -> Column:
    """Second feed's parser -> struct(salary_min string, salary_max string).

    Like A, but the thousand unit needs a standalone 'k', tokens are d[d.,]* and
    thousand separators are removed; other tokens are truncated before scaling.
    """
    r = _c(raw)
    text = F.trim(F.regexp_replace(F.replace(F.lower(r), F.lit("\u00a0"), F.lit(" ")), "(?U)\\s+", " "))

    def parse(t):
        standalone_k = t.rlike(f"(^|[^{WORD_CLASS}])k($|[^{WORD_CLASS}])")
        mult = (F.when(contains_any(t, MILLION_WORDS), F.lit(1_000_000))
                .when(contains_any(t, THOUSAND_WORDS) | standalone_k, F.lit(1_000)).otherwise(F.lit(1))).cast("bigint")
        toks = F.regexp_extract_all(t, F.lit("\\d[\\d.,]*"), 0)
        values = F.array_compact(let(mult, lambda m: F.transform(toks, lambda n: F.try_multiply(normalise_salary_number(n), m))))
        return _pair(values, t, UP_TO_WORDS_B, FROM_WORDS_B)

    return _parse(r, text, NEGOTIABLE_WORDS_B, parse)
