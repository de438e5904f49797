"""Sentiment and category of a text, from word lists.

All of it is one expression per row: no shuffle, whatever the size or the skew of the table.
"""

from __future__ import annotations

import re
from collections.abc import Iterable, Mapping, Sequence
from functools import reduce

from pyspark.sql import Column
from pyspark.sql import functions as F

# The label set.
POSITIVE, NEGATIVE, NEUTRAL, MIXED = "positive", "negative", "neutral", "mixed"

# Common words of praise and of complaint; a stem stands for all its forms.
POSITIVE_TERMS = (
    "嬉し", "楽し", "快適", "素晴らし", "満足", "安心", "便利", "親切", "丁寧", "感謝", "助か",
    "信頼", "迅速", "優れ", "見やす", "使いやす", "良い", "良か", "良く", "納得", "最高", "好感",
)
NEGATIVE_TERMS = (
    "不便", "不満", "不安", "残念", "遅い", "遅く", "遅か", "悪い", "悪く", "悪か", "困", "怒", "面倒", "失礼",
    "最悪", "苦痛", "心配", "複雑", "間違", "迷惑", "嫌", "腹が立", "待たされ", "狭", "雑な", "使いにく", "見にく",
)
# Words that hold a term by chance.
OTHER_WORDS = ("狭山", "狭間", "困難", "貧困", "機嫌", "喜怒", "不安定")
# What turns a term into its opposite: right before it, or after it in the same clause, up to the next term. Twice turns back.
NEGATION_BEFORE = "[不非未無]"
NEGATION_STEMS = ("ない", "なく", "なか", "ません", "とは言え", "とはいえ")
NEGATION_AFTER = "とは[言い]え(?:ません|ない|なかった)?|ません|ない|なく|なか"
# Says something else though it looks like a negation: must, and adjectives that end alike.
NO_NEGATION = "(?:なければ|なくては|ないと)(?:なら|いけ)(?:ない|ません)|危ない|切ない|情けない|仕方ない|つまらない|とんでもない"
CLAUSE_END = "。、，！？!?\\n"

# Kinds of comment, by substrings: Japanese has no spaces to split on.
COMMENT_CATEGORIES = {
    "app": ("アプリ", "ログイン", "サイト", "パスワード"),
    "staff": ("職員", "受付", "スタッフ", "係員"),
    "waiting": ("待ち", "待た", "行列", "混雑"),
    "procedure": ("手続", "書類", "申込", "振込"),
}

# Frequent short words of four languages, for texts with spaces.
LANGUAGE_WORDS = {
    "de": ("der", "die", "das", "und", "ist", "nicht", "ein", "eine", "von", "zu", "mit", "auf"),
    "en": ("the", "of", "and", "to", "in", "is", "was", "that", "for", "it", "with", "as"),
    "es": ("el", "los", "las", "del", "que", "en", "por", "con", "para", "una", "se", "no"),
    "fr": ("le", "la", "les", "des", "et", "est", "un", "une", "que", "dans", "pour", "avec"),
}

WORD_SEPARATOR = r"[^\p{L}]+"


def _any(terms: Sequence[str]) -> str:
    return "(?:" + "|".join(map(re.escape, sorted(terms, key=lambda term: (-len(term), term)))) + ")"


def token_pattern(terms: Sequence[str]) -> str:
    """The tokens that decide on a label, as group 1: terms, negations, ends of clauses. Other words and phrases are taken first and stay out."""
    tokens = f"{NEGATION_BEFORE}?{_any(terms)}|{NEGATION_AFTER}|[{CLAUSE_END}]"
    others = f"{'|'.join(OTHER_WORDS)}|{NO_NEGATION}"
    first = {word[0] for word in (*terms, *OTHER_WORDS, *NEGATION_STEMS)} | set(NEGATION_BEFORE.strip("[]")) | set("な危切情仕つと")
    letters = "".join(sorted(re.escape(letter) for letter in first))
    return f"(?=[{letters}{CLAUSE_END}])(?:{others}|({tokens}))"  # the first letter spares most places the list


def side_patterns(positive: Sequence[str], negative: Sequence[str]) -> tuple[str, str]:
    """What makes a row of tokens good, and what bad: a term of that side negated an even number of times, or one of the other an odd number."""
    mark = f" +(?:{NEGATION_AFTER})"

    def side(own: str, other: str) -> str:
        even, odd = (f"(?:{plain}|{NEGATION_BEFORE}{turned})(?= |$)" for plain, turned in ((own, other), (other, own)))
        return f"(?:^| )(?:{even}|{odd}{mark})(?:{mark}{mark})*+(?!{mark})"

    return side(_any(positive), _any(negative)), side(_any(negative), _any(positive))


def _overlaps(left: Sequence[str], right: Sequence[str]) -> set[str]:
    """What a text holds if terms of both share letters in it: one inside the other, or one's end being the other's beginning."""
    found = set()
    for a, b in ((a, b) for x in left for y in right for a, b in ((x, y), (y, x))):
        if b in a:
            found.add(a)
        found |= {a + b[n:] for n in range(1, min(len(a), len(b))) if a.endswith(b[:n])}
    return found


def _holds(text: Column, parts: Iterable[str]) -> Column:
    return reduce(lambda left, right: left | right, (text.contains(part) for part in sorted(parts)), F.lit(False))


def sentiment(
    text: Column,
    positive: Sequence[str] = POSITIVE_TERMS,
    negative: Sequence[str] = NEGATIVE_TERMS,
) -> Column:
    """positive, negative, mixed (both occur) or neutral (neither does); NULL for NULL text.

    A negated term counts for the other side, one negated twice for its own. A text with anything that may turn or hide a term is gone through once for its
    tokens, and the label is read off these; in any other a term is its label, and a plain search gives the same.
    """
    terms = [*positive, *negative]
    good, bad = side_patterns(positive, negative)
    tokens = F.array_join(F.regexp_extract_all(text, F.lit(token_pattern(terms)), F.lit(1)), " ")

    def label(is_good: Column, is_bad: Column) -> Column:
        return (
            F.when(is_good, F.when(is_bad, F.lit(MIXED)).otherwise(F.lit(POSITIVE)))
            .when(is_bad, F.lit(NEGATIVE))
            .otherwise(F.lit(NEUTRAL))
        )

    # A lambda, so that the tokens are found once.
    by_tokens = F.element_at(F.transform(F.array(tokens), lambda found: label(found.rlike(good), found.rlike(bad))), 1)
    before = _holds(text, NEGATION_BEFORE.strip("[]")) & text.rlike(NEGATION_BEFORE + _any(terms))
    turns = _holds(text, NEGATION_STEMS) | _holds(text, {*OTHER_WORDS, *_overlaps(positive, negative)}) | before
    return F.when(text.isNotNull(), F.when(turns, by_tokens).otherwise(label(_holds(text, positive), _holds(text, negative))))


def substring_hits(text: Column, terms: Sequence[str]) -> Column:
    """How often the terms occur in the text, each term counted on its own."""

    def hits(term: str) -> Column:
        removed = F.length(text) - F.length(F.replace(text, F.lit(term)))
        return F.when(text.contains(term), (removed / len(term)).cast("int")).otherwise(0)

    return reduce(lambda left, right: left + right, (hits(term) for term in terms))


def words(text: Column) -> Column:
    return F.split(F.lower(text), WORD_SEPARATOR)


def words_among(text: Column, terms: Sequence[str]) -> Column:
    """The words of the text that are among the terms, with repetitions."""
    return F.filter(words(text), lambda word: word.isin(*terms))


def word_hits(tokens: Column, terms: Sequence[str]) -> Column:
    """How many of the words are among the terms."""
    return F.size(F.filter(tokens, lambda token: token.isin(*terms)))


def best_category(hits: Mapping[str, Column], fallback: str = "other") -> Column:
    """The category with most hits; ties go to the first name, no hit at all to ``fallback``."""
    names = sorted(hits)
    most = F.greatest(*(hits[name] for name in names)) if len(names) > 1 else hits[names[0]]
    picked = F.when(most == 0, F.lit(fallback))
    for name in names:
        picked = picked.when(hits[name] == most, F.lit(name))
    return picked
