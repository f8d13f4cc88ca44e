"""Near-miss word matching (typos) as Column expressions.

Two words are as similar as their matching blocks: the longest common block
(the first of the first word, then of the second, among equally long ones), and
in the same way what lies left and right of it.  The ratio is twice the matched
characters over all characters.  Before any block is looked for, the characters
that the words share in number bound the ratio from above.
"""

from __future__ import annotations

from pyspark.sql import Column
from pyspark.sql import functions as F

from .text import let

PARTS = "array<struct<a:string,b:string>>"


def shared_bound(word: Column, target: str) -> Column:
    """Upper bound of the ratio: characters that both have, with repeats."""
    count = lambda c: F.length(word) - F.length(F.replace(word, F.lit(c), F.lit("")))
    shared = sum((F.least(count(c), F.lit(target.count(c))) for c in dict.fromkeys(target)), F.lit(0))
    return _share(shared, F.length(word) + len(target))


def _share(matched: Column, total: Column) -> Column:
    return F.when(total == 0, F.lit(1.0)).otherwise(2.0 * matched / total)


def _longest_block(a: Column, b: Column) -> Column:
    """struct(l, pa, pb): length of the longest common block and its negative positions (from -1); null without one."""
    spans = F.flatten(F.transform(F.sequence(F.lit(1), F.length(b)), lambda i: F.transform(
        F.sequence(F.lit(1), F.length(b) - i + 1),
        lambda l: F.struct(l.alias("l"), (-F.call_function("instr", a, F.substr(b, i, l))).alias("pa"), (-i).alias("pb")))))
    return F.array_max(F.filter(spans, lambda s: s["pa"] < 0))


def matched_characters(a: Column, b: Column) -> Column:
    """Characters in matching blocks; parts still to be compared wait in a list."""
    def step(acc, _):
        def split(part):
            def parts(block):
                pa, pb, l = -block["pa"], -block["pb"], block["l"]
                rest = F.array(F.struct(F.substr(part["a"], F.lit(1), pa - 1).alias("a"), F.substr(part["b"], F.lit(1), pb - 1).alias("b")),
                               F.struct(F.substr(part["a"], pa + l).alias("a"), F.substr(part["b"], pb + l).alias("b")))
                return F.when(block.isNull(), F.struct(F.slice(acc["todo"], 2, 1 << 20).alias("todo"), acc["m"].alias("m"))).otherwise(F.struct(
                    F.concat(F.slice(acc["todo"], 2, 1 << 20), F.filter(rest, lambda p: (p["a"] != "") & (p["b"] != ""))).alias("todo"), (acc["m"] + l).alias("m")))

            return let(_longest_block(part["a"], part["b"]), parts)

        return F.when(F.size(acc["todo"]) == 0, acc).otherwise(let(F.element_at(acc["todo"], 1), split))

    first = F.when((a == "") | (b == ""), F.array().cast(PARTS)).otherwise(F.array(F.struct(a.alias("a"), b.alias("b"))).cast(PARTS))
    start = F.struct(first.alias("todo"), F.lit(0).alias("m"))
    # a part has a block, or ends; every block leaves two parts at most
    steps = F.sequence(F.lit(1), 2 * F.least(F.length(a), F.length(b)) + 1)
    return F.aggregate(steps, start, step, lambda acc: acc["m"])


def ratio(a: Column, b: Column) -> Column:
    """Similarity of two words by matching blocks, 0 to 1 (1 for two empty words)."""
    return _share(matched_characters(a, b), F.length(a) + F.length(b))


def close(word: Column, target: str, cutoff: float) -> Column:
    """The ratio of a word and a target if it is ``cutoff`` or more, else null."""
    return F.when(shared_bound(word, target) >= cutoff, let(ratio(word, F.lit(target)), lambda r: F.when(r >= cutoff, r)))


def fuzzy_hits(words: Column, targets, cutoff: float = 0.8) -> Column:
    """Targets that have at least one word with a ratio >= cutoff (per row, no shuffle)."""
    return F.array_compact(F.array(*[F.when(F.exists(words, lambda w: close(w, t, cutoff).isNotNull()), F.lit(t)) for t in targets]))


def best_close_word(words: Column, target: str, cutoff: float = 0.8) -> Column:
    """The word with the largest ratio to ``target``, cutoff or more (ties: the last word in order of characters), else null."""
    scored = F.transform(words, lambda w: F.struct(close(w, target, cutoff).alias("s"), w.alias("w")))
    return F.array_max(F.filter(scored, lambda x: x["s"].isNotNull()))["w"]
