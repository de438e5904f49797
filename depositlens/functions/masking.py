"""Masking of phone numbers and of personal data in free text."""

from __future__ import annotations

from collections.abc import Sequence
from dataclasses import dataclass

from pyspark.sql import Column
from pyspark.sql import functions as F


def mask_phone(phone: Column) -> Column:
    """Every decimal digit of any script becomes ``*``; the punctuation stays. NULL stays NULL."""
    return F.regexp_replace(phone, r"\p{Nd}", "*")


@dataclass(frozen=True)
class MaskRule:
    """One kind of personal data: how it is written, what stands for it, and for ``card`` that its digits are checked."""

    pattern: str
    replacement: str
    card: bool = False


_D, _S, _WIDE = "[0-9０-９]", "[ －-]", "０１２３４５６７８９"
# Letters and digits of the Latin script end a number, other scripts write words right next to it.
_FREE, _ENDS = "(?<![0-9A-Za-z０-９_/])", "(?![0-9A-Za-z０-９_])"
_OCTET = "(?:25[0-5]|2[0-4][0-9]|1[0-9]{2}|[1-9]?[0-9])"
_HEX = "[0-9A-Fa-f]{1,4}"
_PHONES = (
    rf"\+{_D}{{1,3}}{_S}?(?:[(（]{_D}{{1,4}}[)）]|{_D}{{1,4}})(?:{_S}?{_D}{{2,4}}){{2,3}}",
    rf"[(（]{_D}{{2,4}}[)）]{_S}?{_D}{{2,4}}{_S}{_D}{{3,4}}",
    rf"[0０]{_D}{{1,4}}[－-]{_D}{{1,4}}[－-]{_D}{{4}}",
    rf"[0０]{_D}{{1,3}} {_D}{{2,4}} {_D}{{4}}",
    rf"{_D}{{3}}[－-]{_D}{{3}}[－-]{_D}{{4}}",
    rf"{_D}{{3}}\.{_D}{{3}}\.{_D}{{4}}",
    rf"[0０]{_D}{{9,10}}",
)
_KEYWORD = r"\"?(?i:token|secret|password|passwd|api_key|apikey)\"?"
_VERSION = "(?<!(?i:version|release|ver|v)[. ]{0,2})"

# In this order: of two that begin at one place the first stands.
PERSONAL_DATA_RULES = (
    MaskRule(r"[A-Za-z0-9._%+-]+@[A-Za-z0-9-]+(?:\.[A-Za-z0-9-]+)+", "[EMAIL]"),
    MaskRule(_KEYWORD + r""" ?[:=] ?(?:"[^"]*"|'[^']*'|[^\s"',;]+)""", "[SECRET]"),
    MaskRule(
        rf"(?<![0-9A-Za-z_:.])(?=[0-9A-Fa-f:]*[0-9])(?:(?:{_HEX}:){{7}}{_HEX}|(?:{_HEX}(?::{_HEX}){{0,5}})?::(?:{_HEX}(?::{_HEX}){{0,5}})?)(?![0-9A-Za-z_:])",
        "[IP]",
    ),
    MaskRule(rf"{_FREE}[0-9]{{3}}-[0-9]{{2}}-[0-9]{{4}}{_ENDS}", "[ID]"),
    MaskRule(rf"{_FREE}(?:{_D}{{4}}(?:{_S}{_D}{{4}}){{3}}|{_D}{{4}}{_S}{_D}{{6}}{_S}{_D}{{5}}|{_D}{{13,19}}){_ENDS}", "[CARD]", card=True),
    MaskRule(rf"{_FREE}(?:{'|'.join(_PHONES)}){_ENDS}", "[PHONE]"),
    MaskRule(rf"(?<![0-9A-Za-z_.]){_VERSION}(?:{_OCTET}\.){{3}}{_OCTET}(?![0-9A-Za-z_]|\.[0-9])", "[IP]"),
)
# What a number and an assigned secret or a long address hold; the others hold a plain string.
_NUMBER, _ASSIGNED = rf"{_D}[0-9０-９ ()（）.－-]{{5}}", rf"(?i:token|secret|passw|api_?key)|:{_HEX}:"


def _may_hold(text: Column) -> Column:
    """Whether there may be anything to mask, by searches that are cheaper than going through the text."""
    assigned = (text.contains(":") | text.contains("=")) & text.rlike(_ASSIGNED)
    return text.contains("@") | text.contains("::") | text.rlike(_NUMBER) | assigned


def candidate_pattern(rules: Sequence[MaskRule] = PERSONAL_DATA_RULES) -> str:
    return "|".join(f"(?:{rule.pattern})" for rule in rules)


def _is_card(found: Column) -> Column:
    """Fifteen or sixteen digits, or other lengths with a right check digit that are no book number."""
    digits = F.regexp_replace(F.translate(found, _WIDE, "0123456789"), "[^0-9]", "")
    size = F.length(digits)

    def add(total: Column, place: Column) -> Column:
        digit = F.substring(digits, place, 1).cast("int")
        twice = digit * 2 - F.when(digit > 4, 9).otherwise(0)
        return total + F.when((size - place) % 2 == 0, digit).otherwise(twice)

    right = F.aggregate(F.sequence(F.lit(1), size), F.lit(0), add) % 10 == 0
    return size.isin(15, 16) | (right & ~((size == 13) & digits.rlike("^97[89]")))


def mask_text(text: Column, rules: Sequence[MaskRule] = PERSONAL_DATA_RULES) -> Column:
    """Personal data in the whole text replaced by its kind. The text is gone through once for what may be such; each find is then judged by itself."""
    pattern = candidate_pattern(rules)

    def judged(rest: Column, found: Column) -> Column:
        kind = F.when(found.isNull(), F.lit(""))
        for rule in rules:
            shown = F.when(_is_card(found), F.lit(rule.replacement)).otherwise(found) if rule.card else F.lit(rule.replacement)
            kind = kind.when(found.rlike(f"^(?:{rule.pattern})$"), shown)
        return F.concat(rest, kind.otherwise(found))

    parts = F.zip_with(F.split(text, pattern, -1), F.regexp_extract_all(text, F.lit(pattern), F.lit(0)), judged)
    masked = F.array_join(parts, "")
    return F.when(_may_hold(text), masked).otherwise(text) if rules is PERSONAL_DATA_RULES else masked


def mask_sql(name: str, rules: Sequence[MaskRule] = PERSONAL_DATA_RULES) -> str:
    """The same as SQL text, for the string ``name``."""
    text = lambda value: "'" + value.replace("\\", "\\\\").replace("'", "\\'") + "'"
    digits = f"regexp_replace(translate(f, '{_WIDE}', '0123456789'), '[^0-9]', '')"
    digit = "int(substring(d, p, 1))"
    total = f"aggregate(sequence(1, length(d)), 0, (t, p) -> t + CASE WHEN (length(d) - p) % 2 = 0 THEN {digit} ELSE {digit} * 2 - IF({digit} > 4, 9, 0) END)"
    card = f"exists(array({digits}), d -> length(d) IN (15, 16) OR ({total} % 10 = 0 AND NOT (length(d) = 13 AND d RLIKE '^97[89]')))"
    cases = " ".join(
        f"WHEN f RLIKE {text(f'^(?:{rule.pattern})$')} THEN " + (f"IF({card}, {text(rule.replacement)}, f)" if rule.card else text(rule.replacement))
        for rule in rules
    )
    pattern = text(candidate_pattern(rules))
    kind = f"CASE WHEN f IS NULL THEN '' {cases} ELSE f END"
    return f"array_join(zip_with(split({name}, {pattern}, -1), regexp_extract_all({name}, {pattern}, 0), (r, f) -> concat(r, {kind})), '')"
