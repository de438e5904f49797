"""Personal data and secrets replaced by keyed surrogates of the same type.

A surrogate is a keyed permutation of the values of the same kind and format, so equal entities get equal surrogates in every
document (coreference), different ones get different surrogates (distinctness), and nothing has to be looked up,
joined or remembered. Each permutation is one cycle over its domain, so no value is its own surrogate:

* digits stay digits of their script, letters stay vowels or consonants of their script and keep their case, all
  other characters stay;
* card numbers keep their first digit and whether their check digit is right, addresses keep their network class,
  phone numbers their country code or leading zero, mail addresses their top-level domain and a reserved example domain;
* a given name of the list becomes one of the same gender and script, any other name one that is not in the list.

Each document's entities are compared with their surrogates: should two share one, one goes on along its cycle. A name found once is
replaced throughout its document.
"""

from __future__ import annotations

import hashlib
import ipaddress
import re
import unicodedata
from collections.abc import Callable, Iterator
from functools import cache, lru_cache
from typing import NamedTuple

import pyarrow as pa
from pyspark.sql import DataFrame
from pyspark.sql import functions as F
from pyspark.sql import types as T

from depositlens.llm.common import pieces

KEY = "depositlens"
ROUNDS = 6
CACHED = 1 << 14
LONGEST = 60
PIECE = 4 << 20

# Given names by gender and script.
GIVEN_NAMES = {
    ("f", "latin"): "Anna Maria Laura Sofia Julia Emma Elena Clara Marie Sarah Lucia Alice Carmen Isabel Sabine Monika Petra Ursula Camille Chloé Élodie Amélie Margaret Susan Linda Karen Nancy Emily Olivia Hannah".split(),
    ("m", "latin"): "John James Robert Michael William David Thomas Daniel Peter Paul Hans Jürgen Klaus Stefan Wolfgang Pierre Jean Michel François Étienne José Carlos Miguel Javier Pablo Andrés Henry George Edward Lukas".split(),
    ("f", "cyrillic"): "Анна Мария Елена Ольга Наталья Татьяна Ирина Светлана Екатерина Людмила".split(),
    ("m", "cyrillic"): "Иван Сергей Андрей Дмитрий Алексей Николай Владимир Михаил Павел Юрий".split(),
}
# Titles before a name; those of one gender only tell nothing more than the name has to keep.
TITLES = "Mr Mrs Ms Miss Dr Prof Herr Frau Monsieur Madame Mme Mlle Señor Señora Sr Sra Don Doña Господин Госпожа".split()
# Words before a value that make it a secret.
SECRETS = "token secret password passwd passphrase pwd api_key apikey api-key access_key access-key private_key auth bearer credential".split()
# Letters that replace each other.
LETTERS = ["aeiou", "bcdfghjklmnpqrstvwxyz", "àáâãäåèéêëìíîïòóôõöùúûü", "çñ", "аеиоуыэюя", "бвгджзклмнпрстфхцчшщ", "αεηιουω", "βγδζθκλμνξπρστφχψ"]
HEX = "0123456789abcdef"
HEX_ONLY = re.compile(r"[0-9a-f]+")
# How issued keys begin; they keep that.
PREFIXES = ("AKIA", "ASIA", "ghp_", "gho_", "ghu_", "ghs_", "ghr_", "github_pat_", "glpat-", "sk_live_", "sk_test_", "rk_live_", "pk_live_", "xoxb-", "xoxp-", "eyJ")
# Classes of IPv6 addresses, the narrow ones first: loopback and none, mapped, documentation, link-local, local, multicast, others.
NETWORKS6 = [
    (int(ipaddress.IPv6Address(prefix)), bits)
    for prefix, bits in (("::", 127), ("::ffff:0:0", 96), ("2001:db8::", 32), ("fe80::", 64), ("fe80::", 10), ("fc00::", 7), ("ff00::", 8), ("2000::", 3), ("::", 0))
]

CLASS_OF = {letter: letters for letters in LETTERS for letter in letters}
NAME = r"[^\W\d_]+(?:['’-][^\W\d_]+)*"
LISTED = {name: (gender, script) for (gender, script), names in GIVEN_NAMES.items() for name in names}


class Entity(NamedTuple):
    kind: str
    start: int
    end: int
    text: str


# --- keyed permutations ------------------------------------------------------------------------------


class Permutation:
    """Keyed one-cycle permutations of 0 .. size - 1: a Feistel network, walked until it ends inside the range."""

    def __init__(self, key: str):
        self.key = hashlib.blake2b(key.encode(), digest_size=32).digest()

    def _round(self, half: int, turn: int, label: bytes, bits: int) -> int:
        octets = (bits + 7) // 8
        data = turn.to_bytes(1, "big") + octets.to_bytes(4, "big") + half.to_bytes(octets, "big") + label
        out = hashlib.shake_128(self.key + data).digest(octets)
        return int.from_bytes(out, "big") & ((1 << bits) - 1)

    def _feistel(self, value: int, bits: int, label: bytes, turns: range) -> int:
        mask = (1 << bits) - 1
        left, right = value >> bits, value & mask
        forward = turns.step > 0
        for turn in turns:
            if forward:
                left, right = right, left ^ self._round(right, turn, label, bits)
            else:
                left, right = right ^ self._round(left, turn, label, bits), left
        return left << bits | right

    def next(self, value: int, size: int, label: str) -> int:
        """The successor of ``value`` on the key's cycle; another value if ``size`` is over 1."""
        if size < 2:
            return value
        bits = max(1, ((size - 1).bit_length() + 1) // 2)
        tag = f"{label}/{size}".encode()
        place = self._feistel(value, bits, tag, range(ROUNDS - 1, -1, -1))
        while place >= size:
            place = self._feistel(place, bits, tag, range(ROUNDS - 1, -1, -1))
        place = (place + 1) % size
        value = self._feistel(place, bits, tag, range(ROUNDS))
        while value >= size:
            value = self._feistel(value, bits, tag, range(ROUNDS))
        return value


def _alphabet(character: str) -> str:
    """The characters that may replace this one; empty if it stays."""
    if character.isdecimal():
        zero = ord(character) - unicodedata.decimal(character)
        return "".join(chr(zero + n) for n in range(10))
    letters = CLASS_OF.get(character, "")
    if not letters and (small := CLASS_OF.get(character.lower(), "")):
        letters = small.upper()
    return letters if character in letters else ""


def permuted(mix: Permutation, text: str, label: str, alphabet: Callable[[str], str] = _alphabet, case: bool = True) -> str:
    """``text`` with each replaceable character replaced by one of its class; the same for any case if ``case``.

    Case is folded only where it can be brought back: the Kelvin or Angstrom sign, which lower like K and Å, are characters of their own.
    """
    plain = "".join(c.lower() if c.lower().upper() == c else c for c in text) if case else text
    classes = [alphabet(c) for c in plain]
    size, rank = 1, 0
    for c, letters in zip(plain, classes, strict=True):
        if letters:
            size, rank = size * len(letters), rank * len(letters) + letters.index(c)
    shape = "".join(letters[0] if letters else c for c, letters in zip(plain, classes, strict=True))
    rank = mix.next(rank, size, f"{label}/{shape}")
    out = []
    for c, own, letters in zip(reversed(plain), reversed(text), reversed(classes), strict=True):
        if letters:
            rank, n = divmod(rank, len(letters))
            c = letters[n]
        out.append(c.upper() if own != c and own.isupper() and len(c.upper()) == 1 else c)
    return "".join(reversed(out))


# --- surrogates by kind ------------------------------------------------------------------------------


def _digits(text: str) -> list[int]:
    return [unicodedata.decimal(c) for c in text if c.isdecimal()]


def check_digit(digits: list[int]) -> int:
    """Luhn's check digit for the digits before it."""
    doubled = [d if n % 2 else (2 * d - 9 if d > 4 else 2 * d) for n, d in enumerate(reversed(digits))]
    return -sum(doubled) % 10


def _write_digits(shape: str, digits: list[int]) -> str:
    """``shape`` with its digits replaced, each in its own script."""
    left = iter(digits)
    return "".join(chr(ord(c) - unicodedata.decimal(c) + next(left)) if c.isdecimal() else c for c in shape)


def _next_digits(mix: Permutation, digits: list[int], label: str) -> list[int]:
    size = len(digits)
    number = mix.next(int("".join(map(str, digits)) or "0"), 10**size, label)
    return [int(c) for c in str(number).zfill(size)][-size:] if size else []


def card_surrogate(mix: Permutation, text: str) -> str:
    digits = _digits(text)
    off = (digits[-1] - check_digit(digits[:-1])) % 10
    new = digits[:1] + _next_digits(mix, digits[1:-1], f"card/{digits[0]}/{off}")
    return _write_digits(text, [*new, (check_digit(new) + off) % 10])


def phone_surrogate(mix: Permutation, text: str) -> str:
    country = re.match(r"\s*\+\s?\d{1,3}(?=[\s(.-])", text)
    start = country.end() if country else 0
    head = text[:start]
    digits = _digits(text[start:])
    lead = int(not country and digits[0] == 0)  # the digit that begins a number within the country
    new = _next_digits(mix, digits[lead:], f"phone/{_digits(head)}/{lead}")
    while not country and not lead and new[0] == 0:
        new = _next_digits(mix, new, f"phone/{_digits(head)}/{lead}")
    return head + _write_digits(text[start:], digits[:lead] + new)


def _network(octets: list[int]) -> tuple[str, int]:
    """The class of an address and how many leading octets are fixed by it."""
    a, b = octets[:2]
    if a in (0, 10, 127):
        return f"{a}", 1
    if (a, b) in ((192, 168), (169, 254)):
        return f"{a}.{b}", 2
    if a == 172 and 16 <= b < 32:
        return "172.16", 1
    return ("multicast", 0) if a >= 224 else ("public", 0)


def address_surrogate(mix: Permutation, text: str) -> str:
    octets = [int(part) for part in text.split(".")]
    network, fixed = _network(octets)
    size = 256 ** (4 - fixed)
    value = int.from_bytes(bytes(octets[fixed:]), "big")
    while True:  # along the cycle to the next address of the same class
        value = mix.next(value, size, f"address/{network}")
        new = octets[:fixed] + list(value.to_bytes(4 - fixed, "big"))
        if _network(new)[0] == network:
            return ".".join(map(str, new))


def _network6(value: int) -> int:
    """The place of an IPv6 address's class in ``NETWORKS6``."""
    return next(n for n, (prefix, bits) in enumerate(NETWORKS6) if value >> (128 - bits) == prefix >> (128 - bits))


def address6_surrogate(mix: Permutation, text: str) -> str:
    value = int(ipaddress.IPv6Address(text))
    network = _network6(value)
    prefix, bits = NETWORKS6[network]
    size = 1 << (128 - bits)
    while True:  # along the cycle to the next address of the same class
        value = prefix + mix.next(value - prefix, size, f"address6/{network}")
        if _network6(value) == network:
            return str(ipaddress.IPv6Address(value))


def mail_surrogate(mix: Permutation, text: str) -> str:
    local, _, domain = text.rpartition("@")
    host, dot, top = domain.rpartition(".")
    reserved = re.search(r"(?:^|\.)example$", host, re.I)
    keep = host[reserved.start() :] if reserved else ""
    own = host[: reserved.start()] if reserved else host
    whole = permuted(mix, f"{local}@{own}", f"mail/{keep}.{top}".lower())
    return f"{whole}{keep}{dot}{top}"


def secret_surrogate(mix: Permutation, text: str) -> str:
    if HEX_ONLY.fullmatch(text):
        return permuted(mix, text, "secret", lambda c: HEX, case=False)
    known = next((own for own in PREFIXES if text.startswith(own)), "")
    new = known + permuted(mix, text[len(known) :], f"secret/{known}", case=False)
    while HEX_ONLY.fullmatch(new):  # along the cycle to one that no secret of hex digits can get
        new = known + permuted(mix, new[len(known) :], f"secret/{known}", case=False)
    return new


def given_surrogate(mix: Permutation, text: str) -> str:
    names = GIVEN_NAMES[LISTED[text]]
    return names[mix.next(names.index(text), len(names), "given/" + "/".join(LISTED[text]))]


def name_surrogate(mix: Permutation, text: str) -> str:
    new = permuted(mix, text, "name")
    while new in LISTED:
        new = permuted(mix, new, "name")
    return new


SURROGATES = {
    "mail": mail_surrogate, "phone": phone_surrogate, "card": card_surrogate, "ip": address_surrogate, "ip6": address6_surrogate,
    "secret": secret_surrogate, "given": given_surrogate, "name": name_surrogate, "number": lambda mix, text: permuted(mix, text, "number"),
}

# --- detection ---------------------------------------------------------------------------------------

DOMAIN = re.compile(r"(?:[^\W_](?:[\w-]{0,61}[^\W_])?\.)+[^\W\d_]{2,}")
LOCAL = re.compile(r"[\w.+%-]{1,64}\Z")
RUN = re.compile(r"\+?[(（]?\d(?:[ \t.()/（）－‐–-]{0,2}\d)+")
ADDRESS = re.compile(r"(?<![\d.])(?:(?:25[0-5]|2[0-4]\d|1\d\d|[1-9]?\d)\.){3}(?:25[0-5]|2[0-4]\d|1\d\d|[1-9]?\d)(?![\d]|\.\d)", re.ASCII)
VERSION = re.compile(r"\b(?:v|ver|version|release)\.?\s*\Z", re.I)
ADDRESS6 = re.compile(r"[0-9A-Fa-f]{0,4}:[0-9A-Fa-f]{0,4}:[0-9A-Fa-f:]*(?:(?:\.\d{1,3}){3})?", re.ASCII)
# Latin letters, and digits: what a number, an account or an address may not touch. Other scripts write words next to numbers.
LATIN = "A-Za-zªºÀ-ÖØ-öø-ɏḀ-ỿＡ-Ｚａ-ｚ"
TOUCHING = re.compile(rf"[\d{LATIN}]")
ASSIGNED = re.compile(r"(?:=>?|:)[ \t]*[\"'“”]?(?:(?i:bearer|basic|token|apikey|negotiate)[ \t]+(?!\w+=[\"'\w]))?([^\s\"'“”<>,;|]{6,})")
ISSUED = re.compile(
    r"(?<![\w-])(?:A[KS]IA[0-9A-Z]{16}|gh[pousr]_[A-Za-z0-9]{30,255}|github_pat_\w{30,255}|glpat-[\w-]{20,64}|[srp]k_(?:live|test)_[A-Za-z0-9]{16,255}"
    r"|xox[bp]-[\w-]{20,255}|eyJ[\w-]{8,}\.[\w-]{8,}\.[\w-]{8,})(?![\w-])",
    re.ASCII,
)
PEM = re.compile(r"-----BEGIN ([A-Z ]{0,40}PRIVATE KEY)-----\s+([A-Za-z0-9+/=\s]{32,}?)\s+-----END \1-----")
SAID = re.compile(r"\b(?:password|passwd|passphrase|pwd)[ \t]+(?:is|was)[ \t]+[\"'“”]?(?=[^\s\"'“”<>,;|]*\d)([^\s\"'“”<>,;|]{6,})", re.I)
KEYWORD = re.compile(r"(?:" + "|".join(SECRETS) + r")[\w-]{0,24}[\"']?[ \t]*\Z", re.I)
SOCIAL = re.compile(r"\d{3}-\d{2}-\d{4}")
ACCOUNT = re.compile(r"[A-Z]{2}\d{2}(?: ?[A-Z0-9]{4}){2,7}(?: ?[A-Z0-9]{1,3})?" + rf"(?![\d_{LATIN}])")
PHONE = re.compile(r"\+\d{1,3}[ \t.(/（－‐–-].*|[(（]\d{2,4}[)）][ \t./-]?.*|[0０]\d{1,4}[ \t./－‐–-]\d.*|\d{3}[ .-]\d{3}[ .-]\d{4}|\+\d{8,15}|[0０]\d{9,10}")
WORDS = re.compile(NAME)
TITLED = re.compile(r"(?:" + "|".join(TITLES) + rf")\.?[ \t]+({NAME}(?:[ \t]+{NAME})?)")
GIVEN = re.compile(r"(?:" + "|".join(sorted(LISTED, key=len, reverse=True)) + rf")(?!\w)(?:[ \t]+({NAME}))?")


def _mails(text: str) -> Iterator[Entity]:
    at = text.find("@")
    while at >= 0:
        local = LOCAL.search(text, max(0, at - 64), at)
        domain = DOMAIN.match(text, at + 1)
        if local and domain:
            start = local.start() + len(local[0]) - len(local[0].lstrip(".-"))
            if start < at:
                yield Entity("mail", start, domain.end(), text[start : domain.end()])
        at = text.find("@", at + 1)


def _secrets(text: str) -> Iterator[Entity]:
    if "=" in text or ":" in text:
        for found in ASSIGNED.finditer(text):
            if KEYWORD.search(text, max(0, found.start() - 48), found.start()):
                yield Entity("secret", *found.span(1), found[1])
    for found in ISSUED.finditer(text):
        yield Entity("secret", *found.span(), found[0])
    if "-----BEGIN " in text:
        for found in PEM.finditer(text):
            yield Entity("secret", *found.span(2), found[2])
    if " is " in text or " was " in text:
        for found in SAID.finditer(text):
            value = found[1].rstrip(".!?:)")
            if len(value) >= 6:
                yield Entity("secret", found.start(1), found.start(1) + len(value), value)


def _numbers(text: str) -> Iterator[Entity]:
    for run in RUN.finditer(text):
        start, end = run.span()
        before = text[max(0, start - 2) : start]
        if TOUCHING.match(before[-1:]) and run[0][0] not in "+(" or re.search(r"\d[.,]\Z", before) or TOUCHING.match(text, end):
            continue
        place = start
        for found in ADDRESS.finditer(text, start, end):
            yield from _number_kinds(text[place : found.start()], place)
            if not VERSION.search(text, max(0, found.start() - 12), found.start()):
                yield Entity("ip", *found.span(), found[0])
            place = found.end()
        yield from _number_kinds(text[place:end], place)


def _kind(number: str) -> str | None:
    size = len(_digits(number))
    if SOCIAL.fullmatch(number):
        return "number"
    if 9 <= size <= 15 and PHONE.fullmatch(number):
        return "phone"
    if 13 <= size <= 19 and re.fullmatch(r"\d+|\d{4}(?:[ -]\d{4}){2,3}(?:[ -]\d{1,4})?|\d{4}[ -]\d{6}[ -]\d{4,5}", number):
        return "card"
    return None


def _number_kinds(run: str, start: int) -> Iterator[Entity]:
    """The numbers in a run of digits and separators: at each word the longest that is of a kind, else go to the next."""
    words = [word.span() for word in re.finditer(r"[^ \t]+", run)]
    n = 0
    while n < len(words):
        left = words[n][0]
        last = n
        while last + 1 < len(words) and words[last + 1][1] - left <= LONGEST:
            last += 1
        while last >= n:
            number = run[left : words[last][1]]
            number = number.rstrip("./（()-－‐–")
            if kind := _kind(number):
                yield Entity(kind, start + left, start + left + len(number), number)
                break
            last -= 1
        n = max(n, last) + 1


def _accounts(text: str) -> Iterator[Entity]:
    for found in ACCOUNT.finditer(text):
        if not (found.start() and TOUCHING.match(text, found.start() - 1)):
            yield Entity("number", *found.span(), found[0])


def _addresses6(text: str) -> Iterator[Entity]:
    """IPv6 addresses, in their shortest form whatever the notation; not the loopback address."""
    if text.count(":") < 2:
        return
    for found in ADDRESS6.finditer(text):
        start, end = found.span()
        if text[end - 1] == ":" and text[end - 2] != ":":
            end -= 1
        if start and (text[start - 1] in "_:" or TOUCHING.match(text, start - 1)) or TOUCHING.match(text, end) or not re.search(r"\d", text[start:end]):
            continue
        try:
            value = ipaddress.IPv6Address(text[start:end])
        except ValueError:
            continue
        if int(value) > 1:
            yield Entity("ip6", start, end, str(value))


def _names(text: str) -> Iterator[Entity]:
    for found in TITLED.finditer(text):
        if found.start() and text[found.start() - 1].isalnum():
            continue
        for word in re.finditer(NAME, found[1]):
            if not word[0][0].isupper():
                break
            start = found.start(1) + word.start()
            yield Entity("given" if word[0] in LISTED else "name", start, start + len(word[0]), word[0])
    for found in GIVEN.finditer(text):
        last = found[1]
        if found.start() and text[found.start() - 1].isalnum() or not last or not last[0].isupper() or last in TITLES:
            continue
        first = re.match(NAME, found[0])[0]
        if first in LISTED:
            yield Entity("given", found.start(), found.start() + len(first), first)
            yield Entity("given" if last in LISTED else "name", *found.span(1), last)


def entities(text: str) -> list[Entity]:
    """What is replaced in ``text``, in order, without overlap; of overlapping finds the earlier kind stays."""
    found: list[Entity] = []
    for kind in (_mails, _secrets, _accounts, _addresses6, _numbers, _names):
        new = list(kind(text))
        if new and found:
            new = [e for e in new if not any(e.start < old.end and old.start < e.end for old in found)]
        ends = -1
        for entity in sorted(new, key=lambda e: e.start):
            if entity.start >= ends:
                found.append(entity)
                ends = entity.end
    return sorted([*found, *_again(text, found)], key=lambda e: e.start)


def _again(text: str, found: list[Entity]) -> Iterator[Entity]:
    """Further mentions of the names found, written alike, as words of their own."""
    known = {entity.text: entity.kind for entity in found if entity.kind in ("given", "name") and len(entity.text) > 1}
    if not known:
        return
    taken = sorted((entity.start, entity.end) for entity in found)
    place = 0
    for word in WORDS.finditer(text):
        if word[0] not in known:
            continue
        while place < len(taken) and taken[place][1] <= word.start():
            place += 1
        if place == len(taken) or taken[place][0] >= word.end():
            yield Entity(known[word[0]], *word.span(), word[0])


class Replacer:
    """Replaces entities under one key; remembers recent ones."""

    def __init__(self, key: str):
        mix = Permutation(key)
        self.surrogate = lru_cache(CACHED)(lambda kind, text: SURROGATES[kind](mix, text))

    def __call__(self, text: str | None) -> tuple[str | None, list[Entity], list[str]]:
        found = entities(text) if text else []
        own_of = self._distinct({(entity.kind, entity.text) for entity in found})
        new = [own_of[entity.kind, entity.text] for entity in found]
        parts, last = [], 0
        for entity, own in zip(found, new, strict=True):
            parts += [text[last : entity.start], own]
            last = entity.end
        return ("".join([*parts, text[last:]]) if found else text), found, new

    def _distinct(self, found: set[tuple[str, str]]) -> dict[tuple[str, str], str]:
        """The surrogate of each entity. Should two of a kind share one, the later in order goes on along the cycle."""
        own_of, taken = {}, set()
        for kind, text in sorted(found):
            own = self.surrogate(kind, text)
            while (kind, own) in taken:
                own = self.surrogate(kind, own)
            own_of[kind, text] = own
            taken.add((kind, own))
        return own_of


@cache
def replacer(key: str) -> Replacer:
    return Replacer(key)


def replace_personal_data(docs: DataFrame, key: str = KEY, text_col: str = "text", spans: str | None = None) -> DataFrame:
    """``docs`` with surrogates in the text column.

    With ``spans`` also an array column of that name: kind, start (code points, in the original), original and
    surrogate of each entity; the original of an IPv6 address is in its shortest form. It takes the place of a column of that name in any case. A NULL text stays NULL and has no entities, an empty one stays empty. Repeated rows are
    replaced alike; an empty table gives no rows; other columns stay.
    """
    docs = docs.drop(*(c for c in docs.columns if spans and c.lower() == spans.lower() and c.lower() != text_col.lower()))
    span = T.StructType([T.StructField("kind", T.StringType()), T.StructField("start", T.IntegerType()), T.StructField("original", T.StringType()), T.StructField("surrogate", T.StringType())])
    place = [c.lower() for c in docs.columns].index(text_col.lower())
    name = docs.columns[place]
    arrow_span = pa.list_(pa.struct([("kind", pa.string()), ("start", pa.int32()), ("original", pa.string()), ("surrogate", pa.string())]))

    def work(batches: Iterator[pa.RecordBatch]) -> Iterator[pa.RecordBatch]:
        replace = replacer(key)
        for batch in pieces(batches, name, PIECE):
            done = [replace(text) for text in batch.column(place).to_pylist()]
            columns = list(batch.columns)
            columns[place] = pa.array([text for text, _, _ in done], pa.string())
            names = list(batch.schema.names)
            if spans:
                rows = [[(e.kind, e.start, e.text, s) for e, s in zip(found, new, strict=True)] for _, found, new in done]
                columns.append(pa.array([[dict(zip(("kind", "start", "original", "surrogate"), row, strict=True)) for row in own] for own in rows], arrow_span))
                names.append(spans)
            yield pa.RecordBatch.from_arrays(columns, names)

    fields = [*docs.schema.fields, *([T.StructField(spans, T.ArrayType(span))] if spans else [])]
    return docs.mapInArrow(work, T.StructType(fields))


def collisions(docs: DataFrame, key: str = KEY, text_col: str = "text") -> DataFrame:
    """(kind, surrogate, originals) of surrogates that several entities of the whole table share: none, by construction."""
    found = replace_personal_data(docs.select(F.col(f"`{text_col}`").alias("text")), key, "text", "spans")
    pairs = found.select(F.explode("spans").alias("e")).select("e.kind", "e.surrogate", "e.original").distinct()
    return pairs.groupBy("kind", "surrogate").agg(F.count("*").alias("originals")).where("originals > 1")
