"""Experience years, seniority, city names and interval binning."""

from __future__ import annotations

from pyspark.sql import Column
from pyspark.sql import functions as F

from .constants import (CITY_KEYS, CITY_KEYS_ADVANCED, CITY_REJECT_WORDS, DEFAULT_YEARS,
                        EXPERIENCE_LEVEL_WORDS, SENIORITY_BANDS, SENIORITY_TOP)
from .text import contains_any, let, python_title


def _c(c) -> Column:
    return F.col(c) if isinstance(c, str) else c


def parse_years(c) -> Column:
    """Years of experience from free text.

    null/'' -> 2.0; first level word contained (in declaration order) -> its value;
    else mean of the first two numbers, the single number, or 2.0.
    """
    raw = _c(c)

    def of_numbers(nums):
        return (F.when(F.size(nums) >= 2, (F.try_element_at(nums, F.lit(1)) + F.try_element_at(nums, F.lit(2))) / 2)
                .when(F.size(nums) == 1, F.try_element_at(nums, F.lit(1)))
                .otherwise(F.lit(DEFAULT_YEARS)))

    def of_text(s):
        nums = F.transform(F.regexp_extract_all(s, F.lit("(\\d+(?:\\.\\d+)?)"), 1), lambda n: n.cast("double"))
        levels = F.lit(None).cast("double")
        for word, val in reversed(EXPERIENCE_LEVEL_WORDS):
            levels = F.when(F.instr(s, word) > 0, F.lit(float(val))).otherwise(levels)
        return F.coalesce(levels, let(nums, of_numbers))

    # the text is lowered once a row, and the numbers are taken once, where no word decides
    return F.when(raw.isNull() | (raw == ""), F.lit(DEFAULT_YEARS)).otherwise(let(F.lower(F.trim(raw)), of_text))


def seniority_level(years) -> Column:
    """<1 Fresher, <3 Junior, <5 Middle, <8 Senior, else Expert."""
    y = _c(years)
    expr = None
    for bound, label in SENIORITY_BANDS:
        expr = F.when(y < bound, F.lit(label)) if expr is None else expr.when(y < bound, F.lit(label))
    return expr.otherwise(F.lit(SENIORITY_TOP))


def _city_chain(s: Column, keys) -> Column:
    expr = None
    for key, city in keys:
        cond = F.instr(s, key) > 0
        expr = F.when(cond, F.lit(city)) if expr is None else expr.when(cond, F.lit(city))
    return expr


def clean_city(c) -> Column:
    """Canonical city: null/'' -> Other; first key contained (declaration order);
    else title case of the lowered, stripped text ('' -> Other)."""
    raw = _c(c)

    def of_text(s):
        return F.coalesce(_city_chain(s, CITY_KEYS), F.when(s == "", F.lit("Other")).otherwise(python_title(s)))

    # the text is lowered once a row, not once a key
    return F.when(raw.isNull() | (raw == ""), F.lit("Other")).otherwise(let(F.lower(F.trim(raw)), of_text))


def clean_city_advanced(c) -> Column:
    """Province-aware variant: salary-looking or digit-led text -> Other; 60+ keys;
    else title case only for <= 3 words without digits, otherwise Other."""
    raw = _c(c)
    s = F.lower(F.trim(raw))
    n_words = F.size(F.filter(F.split(s, " "), lambda w: w != ""))
    fallback = F.when((n_words <= 3) & ~s.rlike("[0-9]"), python_title(s)).otherwise(F.lit("Other"))
    return (F.when(raw.isNull() | (raw == ""), F.lit("Other"))
            .when(contains_any(s, CITY_REJECT_WORDS), F.lit("Other"))
            .when(s.rlike("^[0-9]"), F.lit("Other"))
            .otherwise(F.coalesce(_city_chain(s, CITY_KEYS_ADVANCED), fallback)))


def bin_right_closed(c, bands) -> Column:
    """Label of the right-closed band (lo, hi] containing x; outside -> null.

    ``bands`` is [(lo, hi_or_None, label), ...]; hi None means +infinity.
    """
    x = _c(c)
    expr = None
    for lo, hi, label in bands:
        cond = (x > lo) if hi is None else ((x > lo) & (x <= hi))
        expr = F.when(cond, F.lit(label)) if expr is None else expr.when(cond, F.lit(label))
    return expr


def bin_ordinal(c, bands) -> Column:
    """0-based ordinal of the band (same rule as ``bin_right_closed``)."""
    x = _c(c)
    expr = None
    for i, (lo, hi, _label) in enumerate(bands):
        cond = (x > lo) if hi is None else ((x > lo) & (x <= hi))
        expr = F.when(cond, F.lit(i)) if expr is None else expr.when(cond, F.lit(i))
    return expr
