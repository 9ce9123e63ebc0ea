"""Suffix reduction: a caller's table of rules, compiled to one expression per step."""

from __future__ import annotations

from collections.abc import Sequence
from dataclasses import dataclass

from pyspark.sql import Column, DataFrame, functions as F

#: A rule may leave this sign behind for the next step, which takes it away again.
MARK = "~"


@dataclass(frozen=True)
class Rule:
    """Replace ``suffix`` by ``replacement`` where the stem before it meets all conditions.

    ``least`` is the smallest number of vowel-consonant changes of the stem and
    ``exact`` the only one allowed; ``vowel`` asks for a vowel in it, ``ends``
    for one of these last letters, ``cvc`` for (True) or against (False) an end
    consonant, vowel, consonant other than w, x, y, and ``double`` for an end of
    two equal consonants other than l, s, z. ``drop`` letters of the stem go too.
    """

    suffix: str
    replacement: str = ""
    least: int = 0
    exact: int | None = None
    vowel: bool = False
    ends: str = ""
    cvc: bool | None = None
    double: bool = False
    drop: int = 0


def _all(table: str, least: int) -> list[Rule]:
    return [Rule(*(pair.split(":") + [""])[:2], least=least) for pair in table.split()]


# The published suffix table for English of 1980, step by step.
PORTER: tuple[tuple[Rule, ...], ...] = (
    (Rule("sses", "ss"), Rule("ies", "i"), Rule("ss", "ss"), Rule("s")),
    (Rule("eed", "ee", least=1), Rule("ed", MARK, vowel=True), Rule("ing", MARK, vowel=True)),
    (Rule("at" + MARK, "ate"), Rule("bl" + MARK, "ble"), Rule("iz" + MARK, "ize"), Rule(MARK, double=True, drop=1), Rule(MARK, "e", exact=1, cvc=True), Rule(MARK)),
    (Rule("y", "i", vowel=True),),
    tuple(_all(
        "ational:ate tional:tion enci:ence anci:ance izer:ize abli:able alli:al entli:ent eli:e ousli:ous ization:ize ation:ate ator:ate "
        "alism:al iveness:ive fulness:ful ousness:ous aliti:al iviti:ive biliti:ble", 1)),
    tuple(_all("icate:ic ative alize:al iciti:ic ical:ic ful ness", 1)),
    tuple([*_all("al ance ence er ic able ible ant ement ment ent ou ism ate iti ous ive ize", 2), Rule("ion", least=2, ends="st")]),
    (Rule("e", least=2), Rule("e", exact=1, cvc=False)),
    (Rule("l", least=2, ends="l"),),
)


def vowel_form(word: Column) -> Column:
    """``v`` for a, e, i, o, u and for y after a consonant, ``c`` for every other letter."""
    shown = F.regexp_replace(word, "([^aeiou])y", "$1i")
    return F.regexp_replace(F.regexp_replace(shown, "[^aeiou]", "c"), "[aeiou]", "v")


def _meets(rule: Rule, stem: Column, form: Column) -> Column:
    changes = F.regexp_count(form, F.lit("vc"))
    last, one_before = F.right(stem, F.lit(1)), F.left(F.right(stem, F.lit(2)), F.lit(1))
    cvc = form.endswith("cvc") & ~last.isin("w", "x", "y")
    tests = [
        (rule.least > 0, changes >= rule.least), (rule.exact is not None, changes == rule.exact), (rule.vowel, form.contains("v")),
        (bool(rule.ends), last.isin(*rule.ends)), (rule.cvc is not None, cvc == F.lit(rule.cvc)),
        (rule.double, (F.length(stem) > 1) & (last == one_before) & form.endswith("c") & ~last.isin("l", "s", "z")),
    ]
    out = F.lit(True)
    for asked, test in tests:
        out = out & test if asked else out
    return out


def step(word: Column, form: Column, rules: Sequence[Rule]) -> Column:
    """The word after one step: its longest suffix of the table decides, and the first rule for it that fits."""
    by_suffix: dict[str, list[Rule]] = {}
    for rule in rules:
        by_suffix.setdefault(rule.suffix, []).append(rule)
    out = None
    for suffix in sorted(by_suffix, key=lambda s: (-len(s), s)):
        size = F.length(word) - len(suffix)
        stem, done = F.left(word, size), None
        for rule in by_suffix[suffix]:
            kept = F.left(word, size - rule.drop) if rule.drop else stem
            fits, new = _meets(rule, stem, F.left(form, size)), F.concat(kept, F.lit(rule.replacement))
            done = F.when(fits, new) if done is None else done.when(fits, new)
        branch = done.otherwise(word)
        out = F.when(word.endswith(suffix), branch) if out is None else out.when(word.endswith(suffix), branch)
    return out.otherwise(word)


def stem(word: Column, steps: Sequence[Sequence[Rule]] = PORTER, min_len: int = 3) -> Column:
    """The word after all steps, one expression each; words shorter than ``min_len`` stay as they are.

    Each step binds its word once, in a lambda, so that the whole stays linear in
    the rules however often a plan moves it.
    """
    out = word
    for rules in steps:
        both = F.transform(F.array(out), lambda w: F.struct(w.alias("w"), vowel_form(w).alias("f")))
        out = F.transform(both, lambda x: step(x["w"], x["f"], rules))[0]
    return F.when(F.length(word) < min_len, word).otherwise(out)


def stems(words: DataFrame, word: str, steps: Sequence[Sequence[Rule]] = PORTER, min_len: int = 3) -> DataFrame:
    """(form, canonical): each distinct word and its stem. Null words are left out."""
    distinct = words.where(F.col(word).isNotNull()).select(F.col(word).alias("form")).distinct()
    return distinct.withColumn("canonical", stem(F.col("form"), steps, min_len))
