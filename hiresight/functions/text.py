"""Text normalisation as Column expressions (JVM-side, codegen friendly)."""

from __future__ import annotations

from pyspark.sql import Column
from pyspark.sql import functions as F

from .constants import ENGLISH_PATTERN, REMOTE_PATTERN

# Python's \w is Unicode; Spark's \w is ASCII.  Spell the classes out.
WORD_CLASS = "\\p{L}\\p{N}_"


def _c(c) -> Column:
    return F.col(c) if isinstance(c, str) else c


def text_clean(c, nbsp: bool = False) -> Column:
    """Collapse whitespace runs to one space and strip; null -> ''.

    ``nbsp`` replaces no-break spaces first (second feed); the Unicode class
    below already treats them as whitespace, so both variants agree.
    """
    x = F.coalesce(_c(c), F.lit(""))
    if nbsp:
        x = F.regexp_replace(x, "\u00a0", " ")
    return F.trim(F.regexp_replace(x, "(?U)\\s+", " "))


def normalise_for_skills(c) -> Column:
    """lower; every char that is not a word char, whitespace or '-' -> ' '; collapse spaces.

    Leading/trailing spaces are kept (substring tests do not care).  White space
    is outside the class, too, so one pattern takes whole runs of both.
    """
    return F.regexp_replace(F.lower(_c(c)), f"[^{WORD_CLASS}-]+", " ")


def normalise_words_only(c) -> Column:
    """Variant without '-' kept (the alternative extractor's cleaning)."""
    return F.regexp_replace(F.lower(_c(c)), f"[^{WORD_CLASS}]+", " ")


def words(c) -> Column:
    """Whitespace tokens of a normalised text (no empty tokens)."""
    return F.filter(F.split(F.trim(_c(c)), " "), lambda w: w != "")


def word_ngrams(words_col, n: int) -> Column:
    """All n-grams of a words array, joined by one space, in order."""
    w = _c(words_col)
    return F.when(F.size(w) < n, F.array().cast("array<string>")).otherwise(
        F.transform(F.sequence(F.lit(1), F.size(w) - n + 1),
                    lambda i: F.array_join(F.slice(w, i, n), " ")))


def detect_remote(c) -> Column:
    """1 if the lowered text mentions remote / wfh / hybrid work, else 0 (null -> 0)."""
    return F.coalesce(F.lower(_c(c)).rlike(REMOTE_PATTERN), F.lit(False)).cast("int")


def detect_english(c) -> Column:
    """1 if the lowered text asks for English (or a test score), else 0 (null -> 0)."""
    return F.coalesce(F.lower(_c(c)).rlike(ENGLISH_PATTERN), F.lit(False)).cast("int")


def python_title(c) -> Column:
    """Title case as Spark's initcap: first letter after whitespace upper, rest lower."""
    return F.initcap(_c(c))


def literal_regex(needles) -> str:
    """A pattern that finds any of the given strings, taken literally."""
    return "|".join("".join("\\" + ch if ch in "\\.^$|?*+()[]{}#- " else ch for ch in n) for n in needles)


def _regex_escape(p: str) -> str:
    out = []
    for ch in p:
        out.append("\\" + ch if ch in "\\.^$|?*+()[]{}#- " else ch)
    return "".join(out)


def trie_regex(patterns) -> str:
    """One regex matching the longest pattern starting at a position.

    Patterns are arranged as a trie, so at every text position the engine
    follows at most one branch per character (no per-pattern rescans); an end
    of a pattern inside the trie is an optional (greedy) continuation.
    """
    trie: dict = {}
    for w in patterns:
        node = trie
        for ch in w:
            node = node.setdefault(ch, {})
        node[""] = {}

    def emit(node) -> str:
        alts = [_regex_escape(ch) + emit(node[ch]) for ch in sorted(k for k in node if k != "")]
        if not alts:
            return ""
        body = alts[0] if len(alts) == 1 else "(?:" + "|".join(alts) + ")"
        return "(?:" + body + ")?" if "" in node else body

    return emit(trie)


def contains_any(text: Column, needles) -> Column:
    """Whether the text contains any of the strings.

    One compiled pattern: the text expression stands (and runs) once, not once
    per string.  The strings form a trie, so a position of the text is left at
    the first character that no string goes on with."""
    needles = list(needles)
    if "" in needles:
        return text.rlike("")
    shortest = [n for n in dict.fromkeys(needles) if not any(n != m and n.startswith(m) for m in needles)]
    return text.rlike(trie_regex(shortest)) if needles else F.lit(False)


def let(value: Column, f) -> Column:
    """``f(value)`` with ``value`` evaluated once, however often ``f`` uses it."""
    return F.transform(F.array(value), f)[0]
