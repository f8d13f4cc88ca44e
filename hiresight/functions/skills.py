"""Skill lexicon and skill extraction as Column expressions.

The lexicon is a small, fixed dimension (164 skills, ~500 patterns).  It is
embedded in the plan as a literal array of (pattern, skill) structs, so the
extraction is a per-row expression: no join, no shuffle, no Python worker.
"""

from __future__ import annotations

import functools
import itertools
import os
import zlib

from pyspark.sql import Column, DataFrame, SparkSession
from pyspark.sql import functions as F
from pyspark.sql import types as T

from .constants import ABBREVIATIONS, SKILL_VARIATIONS, VALID_IT_SKILLS
from .fuzzy import fuzzy_hits
from .text import WORD_CLASS, let, normalise_for_skills, normalise_words_only, trie_regex, words

_LEXICON_PATH = os.path.join(os.path.dirname(__file__), "..", "data", "skill_lexicon.tsv")


@functools.lru_cache(maxsize=1)
def lexicon_entries() -> tuple:
    """(skill, category, weight, aliases tuple) in declaration order."""
    out = []
    with open(_LEXICON_PATH, encoding="utf-8") as fh:
        for line in fh:
            line = line.rstrip("\n")
            if not line or line.startswith("#"):
                continue
            skill, category, weight, aliases = line.split("\t")
            out.append((skill, category, float(weight), tuple(a for a in aliases.split("|") if a)))
    return tuple(out)


@functools.lru_cache(maxsize=1)
def alias_map() -> dict:
    """alias -> skill; a skill maps to itself; later declarations win."""
    m: dict = {}
    for skill, _cat, _w, aliases in lexicon_entries():
        m[skill] = skill
        for a in aliases:
            m[a] = skill
    return m


def pattern_pairs(whitelist=None) -> list:
    """(pattern, skill) pairs whose substring presence yields the skill.

    Skill names match themselves; every alias that still points at another
    skill after resolution matches that skill.  Optionally restricted to a
    whitelist of skills (pruning patterns that could only yield dropped skills).
    """
    pairs = [(s, s) for s, _c, _w, _a in lexicon_entries()]
    pairs += [(a, s) for a, s in alias_map().items() if a != s]
    seen, out = set(), []
    for p in pairs:
        if p in seen:
            continue
        if whitelist is not None and p[1] not in whitelist:
            continue
        seen.add(p)
        out.append(p)
    return out


def word_only_abbreviations(whitelist=None) -> list:
    """Whole-word abbreviations that add a skill not already implied by substrings."""
    implied = {p for p, s in pattern_pairs()}
    out = []
    for abbr, full in ABBREVIATIONS:
        if abbr in implied and alias_map().get(abbr) == full:
            continue
        if whitelist is not None and full not in whitelist:
            continue
        out.append((abbr, full))
    return out


def _is_word_char(ch: str) -> bool:
    return ch.isalnum() or ch == "_"


@functools.lru_cache(maxsize=8)
def _matcher_plan(whitelist_key, word: bool = False):
    """(regex, {longest match -> skills of the patterns found with it}).

    Substring mode: a match p stands for every pattern that is a prefix of p.
    Word mode: the match must end at a word boundary (and start at one), and
    a prefix q of p counts only if p continues with a non-word character.
    """
    whitelist = set(whitelist_key) if whitelist_key is not None else None
    by_pattern: dict = {}
    for p, s in pattern_pairs(whitelist):
        by_pattern.setdefault(p, []).append(s)
    expand = {}
    for p in by_pattern:
        skills = []
        for q, ss in by_pattern.items():
            if p.startswith(q) and (not word or len(q) == len(p) or not _is_word_char(p[len(q)])):
                skills += ss
        expand[p] = sorted(set(skills))
    trie = trie_regex(sorted(by_pattern))
    if word:
        nw = f"[{WORD_CLASS}]"
        return f"(?<!{nw})(?=((?:{trie})(?!{nw})))", expand
    # zero-width lookahead: every start position is tried, overlaps included
    return "(?=(" + trie + "))", expand


def slot_lookup(values: dict):
    """key column -> array of strings, for keys of ``values`` only.

    A literal map is searched from its first entry at every lookup.  Here the
    arrays lie in a literal array of as many slots as it takes for the CRC-32 of
    the keys to differ, so a lookup is one index."""
    crc = {k: zlib.crc32(k.encode()) for k in values}
    n = next(n for n in itertools.count(max(1, len(crc))) if len({c % n for c in crc.values()}) == len(crc))
    slots = [[] for _ in range(n)]
    for k, c in crc.items():
        slots[c % n] = list(values[k])
    quoted = lambda v: "'" + v.replace("\\", "\\\\").replace("'", "\\'") + "'"
    # one parsed text: a call for each of thousands of literals takes half a minute
    table = F.expr("array(" + ", ".join("array(" + ", ".join(map(quoted, s)) + ")" for s in slots) + ")").cast("array<array<string>>")
    return lambda key: F.get(table, F.crc32(key) % n)


def skill_extract(text, whitelist=None, match: str = "substring") -> Column:
    """Sorted distinct skills found in a free text.

    ``match='substring'`` reproduces the reference semantics (a pattern anywhere
    in the normalised text, so 'es' or 'rn' fire inside words); it is one
    regex pass per row: at each position the longest lexicon pattern is
    captured and expanded to all patterns that are its prefixes (exactly the
    patterns occurring at that position).  ``match='word'`` requires word
    boundaries on both sides.
    """
    t = F.col(text) if isinstance(text, str) else text
    norm = normalise_for_skills(t)
    if match not in ("substring", "word"):
        raise ValueError(match)
    key = tuple(sorted(whitelist)) if whitelist is not None else None
    regex, expand = _matcher_plan(key, match == "word")
    skills_of = slot_lookup(expand)
    abbreviations = word_only_abbreviations(whitelist)
    empty = F.array().cast("array<string>")

    def extract(n):
        hits = F.array_distinct(F.regexp_extract_all(n, F.lit(regex), 1))
        found = F.flatten(F.transform(hits, skills_of))
        if abbreviations:
            short = F.create_map(*[F.lit(x) for pair in abbreviations for x in pair])
            tokens = F.array_intersect(F.split(n, " "), F.array(*[F.lit(a) for a, _ in abbreviations]))
            found = F.concat(found, F.transform(tokens, lambda t: F.element_at(short, t)))
        return F.sort_array(F.array_distinct(found))  # no nulls; array_sort compares by an interpreted lambda

    # the normalised text is prepared once per row
    return F.when(t.isNull() | (t == ""), empty).otherwise(let(norm, extract))


def names_in(text: Column, names) -> Column:
    """The given names that occur in a lower-cased text with a word boundary at both ends.

    One trie-regex pass: at each position the longest name that ends at a
    boundary, and with it every shorter name that ends at a boundary inside it."""
    names = list(dict.fromkeys(names))

    def at_boundary(p: str, n: int) -> bool:
        return n == len(p) or _is_word_char(p[n - 1]) != _is_word_char(p[n])

    inside = {p: [q for q in names if p.startswith(q) and at_boundary(p, len(q))] for p in names}
    lookup = F.create_map(*[x for p, qs in inside.items() for x in (F.lit(p), F.array(*[F.lit(q) for q in qs]))])
    hits = F.array_distinct(F.regexp_extract_all(text, F.lit("(?U)(?=\\b((?:" + trie_regex(names) + ")\\b))"), 1))
    return F.array_distinct(F.flatten(F.transform(hits, lambda h: F.element_at(lookup, h))))


def skill_extract_names(text: Column, names) -> Column:
    """Sorted names of the caller's list (no aliases) that stand as words in the lower-cased text."""
    empty = F.array().cast("array<string>")
    return F.when(text.isNull() | (text == ""), empty).otherwise(let(F.lower(text), lambda t: F.array_sort(names_in(t, names))))


def skill_extract_advanced(text: Column, names, targets, cutoff: float = 0.8) -> Column:
    """Sorted skills by four strategies over the text without punctuation: names as
    words, fixed spelling variations as words, names of several words as
    substrings, and ``targets`` with a close word."""
    names = [n.lower() for n in dict.fromkeys(names)]
    variations = F.create_map(*[F.lit(x) for pair in SKILL_VARIATIONS for x in pair])
    several = F.array(*[F.lit(n) for n in names if " " in n])
    empty = F.array().cast("array<string>")

    def extract(t):
        exact = names_in(t, names)
        varied = F.transform(names_in(t, [v for v, _ in SKILL_VARIATIONS]), lambda v: F.element_at(variations, v))
        found = F.concat(exact, varied, F.filter(several, lambda n: F.contains(t, n)),
                         let(words(t), lambda w: fuzzy_hits(w, targets, cutoff)))
        return F.array_sort(F.array_distinct(found))

    return F.when(text.isNull() | (text == ""), empty).otherwise(let(normalise_words_only(text), extract))


def patterns_found(norm_text: Column, patterns) -> Column:
    """Distinct patterns occurring (as substrings) in an already normalised text:
    one trie-regex pass, each longest match expanded to its prefix patterns."""
    pats = sorted(set(patterns))
    regex = "(?=(" + trie_regex(pats) + "))"
    expand = {p: sorted(q for q in pats if p.startswith(q)) for p in pats}
    lookup = F.create_map(*[x for p, qs in expand.items() for x in (F.lit(p), F.array(*[F.lit(q) for q in qs]))])
    hits = F.array_distinct(F.regexp_extract_all(norm_text, F.lit(regex), 1))
    return F.array_distinct(F.flatten(F.transform(hits, lambda h: F.element_at(lookup, h))))


def skill_extract_valid(text) -> Column:
    """Extraction restricted to the whitelist of valid IT skills."""
    return skill_extract(text, whitelist=set(VALID_IT_SKILLS))


def skill_one_hot(skills_col, vocabulary) -> list:
    """0/1 flag columns ``skill_<name>`` for a vocabulary (one select, no scans)."""
    s = F.col(skills_col) if isinstance(skills_col, str) else skills_col
    return [F.array_contains(s, v).cast("int").alias(f"skill_{v}") for v in vocabulary]


def lexicon_df(spark: SparkSession) -> DataFrame:
    """skill_lexicon(skill, alias, category, weight, seq) as a small DataFrame."""
    rows, seq = [], 0
    for skill, cat, w, aliases in lexicon_entries():
        for a in (skill,) + aliases:
            rows.append((skill, a, cat, w, seq))
            seq += 1
    schema = T.StructType([T.StructField("skill", T.StringType()), T.StructField("alias", T.StringType()),
                           T.StructField("category", T.StringType()), T.StructField("weight", T.DoubleType()),
                           T.StructField("seq", T.IntegerType())])
    return spark.createDataFrame(rows, schema)


def skill_attr_map(attr: str) -> Column:
    """Literal map skill -> category / weight (bounded, 164 entries)."""
    idx = {"category": 1, "weight": 2}[attr]
    kv = []
    for e in lexicon_entries():
        kv += [F.lit(e[0]), F.lit(e[idx])]
    return F.create_map(*kv)
