"""Format-preserving pseudonyms for personal numbers, dates and mail addresses.

A value is found by its pattern, validated (Luhn, mod 97, calendar, octets, number ranges), turned into a number within its
format's domain and permuted there by a keyed Feistel network with cycle walking, then written back in the
same layout with its check digits computed anew. The permutation depends on the key, the kind and the
format only, so equal values get equal pseudonyms in every document, whatever their separators, and different values
never share one. Nothing is looked up or joined: each row is rewritten where it lies.

A pattern takes as much as it can, so a value may be followed, or a card preceded, by digits or capitals of its own: where the
whole match isn't valid, its parts between separators are tried (a country's IBAN length and usual card layouts first, then the
longest; a card only in groups of three digits or more, lest lists of small numbers pass by chance), then the other kinds, and the
search resumes right after the accepted value.

Phones are North American layouts and international ones with a plus sign; national layouts of other countries (without a plus sign)
are out of scope: nothing validates them.

Defined results: null text stays null with no finds; values that fail validation stay as they are; overlapping candidates: the first
kind in the order of KINDS that is valid at a place wins; repeated rows get equal results; empty tables work; further columns are ignored.
"""

from __future__ import annotations

import hmac
import re
from collections.abc import Iterator
from datetime import date
from functools import lru_cache
from hashlib import sha256
from math import isqrt

import pandas as pd
from pyspark.sql import DataFrame
from pyspark.sql import functions as F

ROUNDS = 10
FIRST_DAY, DAYS = date(1900, 1, 1).toordinal(), date(2100, 1, 1).toordinal() - date(1900, 1, 1).toordinal()
#: kinds in the order in which they are tried at a place, with their patterns
KINDS = {
    "email": r"[A-Za-z0-9._%+\-À-ɏ]+@(?:[A-Za-z0-9\-]+\.)+[A-Za-z]{2,}",
    "iban": r"(?<![A-Za-z0-9])[A-Z]{2}\d{2}(?: ?[A-Z0-9]{4}){2,7}(?: ?[A-Z0-9]{1,3})?(?![A-Za-z0-9])",
    "date": r"(?<![\d.\-/])(?:\d{4}-\d{2}-\d{2}|\d{1,2}/\d{1,2}/\d{4}|\d{1,2}\.\d{1,2}\.\d{4})(?![\d\-/]|\.\d)",
    "ip": r"(?<![\d.])(?:\d{1,3}\.){3}\d{1,3}(?!\d|\.\d)",
    "phone": r"(?<![\w+])(?:(?:\+?1[ .\-]?)?(?:\(\d{3}\) ?|\d{3}[ .\-])\d{3}[ .\-]\d{4}(?![\w\-])|\+[1-9](?:[ .\-/]?(?:\(\d{1,4}\)|\d)){6,14}(?!\w))",
    "ssn": r"(?<![\w\-])\d{3}-\d{2}-\d{4}(?![\w\-])",
    "card": r"(?<![\w\-.])\d(?:[ \-]?\d){12,18}(?![\w\-])",
}
#: a search tries an address only at the start of a run of its characters: from inside it the same @ would be found or missed again, which would
#: cost the square of the run's length. Behind an accepted value ``HERE`` tries it at that very place.
START = {"email": r"(?<![A-Za-z0-9._%+\-À-ɏ])"}
PATTERN = re.compile("|".join(f"(?P<{k}>{START.get(k, '')}{p})" for k, p in KINDS.items()))
HERE = re.compile(f"(?P<email>{KINDS['email']})")
EACH = {k: re.compile(p) for k, p in KINDS.items()}
#: characters of a country's IBAN
IBAN_LENGTH = {c: int(n) for n, cs in {
    "15": "NO", "16": "BE", "18": "DK FI FO GL NL SD", "19": "MK SI", "20": "AT BA EE KZ LT LU MN XK", "21": "CH HR LI LV", "22": "BG BH CR DE GB GE IE ME RS VA",
    "23": "AE GI IL IQ OM SO TL", "24": "AD CZ ES MD PK RO SA SE SK TN VG", "25": "LY PT ST", "26": "IS TR", "27": "BI DJ FR GR IT MC MR SM",
    "28": "AL AZ BY CY DO EG GT HU LB NI PL SV", "29": "BR PS QA UA", "30": "JO KW MU YE", "31": "MT SC", "32": "LC", "33": "RU"}.items() for c in cs.split()}
#: calling codes of one and two digits (all others have three); national digits where a country has one length
CODES = re.compile("[17]|20|27|3[0123469]|4[013456789]|5[1-8]|6[0-6]|8[1246]|9[0-58]|" + r"\d{3}")
NATIONAL = {"1": 10, "7": 10, "31": 9, "33": 9, "34": 9, "41": 9, "45": 8, "48": 9, "351": 9}
CARD_LAYOUT = re.compile(r"\d{13,19}|\d{4}(?:[ \-]\d{4}){3}(?:[ \-]\d{3})?|\d{4}[ \-]\d{6}[ \-]\d{4,5}")


class Permutation:
    """Keyed permutation of 0 .. n-1: a Feistel network on pairs (left < a, right < a), a * a >= n, with cycle walking."""

    def __init__(self, key: bytes, tweak: str, n: int):
        self.n, self.a = n, isqrt(n - 1) + 1
        self.key = hmac.new(key, tweak.encode(), sha256).digest()

    def _round(self, i: int, x: int) -> int:
        return int.from_bytes(hmac.digest(self.key, b"%d:%d" % (i, x), "sha256"), "big") % self.a

    def __call__(self, x: int) -> int:
        while True:
            left, right = divmod(x, self.a)
            for i in range(ROUNDS):
                left, right = right, (left + self._round(i, right)) % self.a
            x = left * self.a + right
            if x < self.n:
                return x

    def inverse(self, x: int) -> int:
        while True:
            left, right = divmod(x, self.a)
            for i in reversed(range(ROUNDS)):
                left, right = (right - self._round(i, left)) % self.a, left
            x = left * self.a + right
            if x < self.n:
                return x


@lru_cache(4096)
def permutation(key: bytes, tweak: str, n: int) -> Permutation:
    return Permutation(key, tweak, n)


def luhn_digit(body: str) -> str:
    total = 0
    for i, c in enumerate(reversed(body)):
        d = int(c) * (2 if i % 2 == 0 else 1)
        total += d - 9 if d > 9 else d
    return str(-total % 10)


def iban_rest(country: str, check: str, body: str) -> int:
    return int("".join(str(int(c, 36)) for c in body + country + check)) % 97


def _fill(layout: str, digits: str, kind=str.isdigit) -> str:
    """``layout`` with its digits replaced in order."""
    it = iter(digits)
    return "".join(next(it) if kind(c) else c for c in layout)


def _characters(key: bytes, tweak: str, text: str) -> str:
    """Letters and digits permuted as one number, each place within its own class; other characters stay."""
    classes = [("0123456789" if c.isdigit() else "abcdefghijklmnopqrstuvwxyz" if c.islower() else "ABCDEFGHIJKLMNOPQRSTUVWXYZ") if c.isascii() and c.isalnum() else c
               for c in text]
    x, n = 0, 1
    for c, k in zip(text, classes):
        x, n = x * len(k) + k.index(c), n * len(k)
    if n < 2:
        return text
    x = permutation(key, f"{tweak}:{''.join(k[0] for k in classes)}", n)(x)
    out = []
    for k in reversed(classes):
        x, i = divmod(x, len(k))
        out.append(k[i])
    return "".join(reversed(out))


def _walk(p: Permutation, x: int, valid) -> int:
    """Apply ``p`` until the result is valid again: a permutation of the valid values."""
    x = p(x)
    while not valid(x):
        x = p(x)
    return x


def _ssn_ok(x: int) -> bool:
    area, group, serial = x // 1_000_000, x // 10_000 % 100, x % 10_000
    return 0 < area < 900 and area != 666 and group > 0 and serial > 0


def _ip_ok(x: int) -> bool:
    """Public unicast or multicast-range address; private, loopback, link-local and this-network addresses name nobody."""
    a, b = x >> 24, x >> 16 & 255
    return not (a in (0, 10, 127) or (a, b) in ((192, 168), (169, 254)) or a == 172 and 16 <= b < 32 or x == 0xFFFFFFFF)


def pseudonym(kind: str, value: str, key: bytes) -> str | None:
    """The value's pseudonym in the same layout; None if it isn't valid."""
    digits = re.sub(r"[^0-9]", "", value)
    if kind == "card":
        if luhn_digit(digits[:-1]) != digits[-1] or len(set(digits)) == 1:
            return None
        body = digits[:-1]
        lead = body[0] != "0"
        p = permutation(key, f"card:{len(digits)}", 10 ** len(body))
        new = str(_walk(p, int(body), lambda x: (x >= 10 ** (len(body) - 1)) == lead)).zfill(len(body))
        return _fill(value, new + luhn_digit(new))
    if kind == "ssn":
        x = int(digits)
        return _fill(value, str(_walk(permutation(key, "ssn", 10 ** 9), x, _ssn_ok)).zfill(9)) if _ssn_ok(x) else None
    if kind == "phone":
        code = CODES.match(digits)[0] if value[0] == "+" else "1"
        if code != "1":
            national = digits[len(code):]
            if not 8 <= len(digits) <= 15 or len(national) < 4:
                return None
            p, lead = permutation(key, f"phone:+{code}:{len(national)}", 10 ** len(national)), national[0] == "0"
            new = _walk(p, int(national), lambda x: (x < 10 ** (len(national) - 1)) == lead)
            return _fill(value, code + str(new).zfill(len(national)))
        if len(digits) not in (10, 11):
            return None
        national = digits[-10:]
        return _fill(value, digits[:-10] + str(permutation(key, "phone:10", 10 ** 10)(int(national))).zfill(10))
    if kind == "ip":
        parts = [int(x) for x in value.split(".")]
        if max(parts) > 255 or any(len(a) > 1 and a[0] == "0" for a in value.split(".")):
            return None
        x = int.from_bytes(bytes(parts), "big")
        return ".".join(map(str, _walk(permutation(key, "ip", 1 << 32), x, _ip_ok).to_bytes(4, "big"))) if _ip_ok(x) else None
    if kind == "date":
        sep = "-" if "-" in value else "/" if "/" in value else "."
        a, b, c = value.split(sep)
        y, m, d = (a, b, c) if sep == "-" else (c, a, b) if sep == "/" and int(a) <= 12 else (c, b, a)
        try:
            x = date(int(y), int(m), int(d)).toordinal() - FIRST_DAY
        except ValueError:
            return None
        if not 0 <= x < DAYS:
            return None
        us = sep == "/" and int(a) <= 12
        # month first with a day over 12 would read as day first: each reading is permuted within itself
        ok = (lambda i: True) if sep != "/" else (lambda i: (date.fromordinal(FIRST_DAY + i).day <= 12) == (int(d) <= 12)) if us else (lambda i: date.fromordinal(FIRST_DAY + i).day > 12)
        new = date.fromordinal(FIRST_DAY + _walk(permutation(key, "date", DAYS), x, ok))
        pad = lambda v, like: str(v).zfill(2) if len(like) == 2 else str(v)
        if sep == "-":
            return new.isoformat()
        return sep.join([pad(new.month if us else new.day, a), pad(new.day if us else new.month, b), f"{new.year:04d}"])
    if kind == "iban":
        flat = value.replace(" ", "")
        country, check, body = flat[:2], flat[2:4], flat[4:]
        if not 15 <= len(flat) <= 34 or iban_rest(country, check, body) != 1:
            return None
        new = _characters(key, f"iban:{country}", body)
        full = country + f"{98 - iban_rest(country, '00', new):02d}" + new
        return _fill(value, full, lambda c: c != " ")
    local, _, domain = value.partition("@")
    return f"{_characters(key, 'email', local)}@{domain}"


def candidates(kind: str, text: str, start: int, stop: int) -> Iterator[tuple[int, int]]:
    """Places inside a match where a value of the kind may stand, in the order in which they are tried; the whole match is among them."""
    if kind not in ("card", "iban", "phone"):
        yield start, stop
        return
    value = text[start:stop]
    size = lambda a, b: sum(c.isalnum() for c in text[a:b])
    edges = [i for i in range(start + 1, stop) if not text[i].isalnum() and text[i - 1].isalnum()] + [stop]
    if kind == "card":
        begins = [start] + [i for i in range(start + 1, stop) if text[i].isdigit() and not text[i - 1].isdigit()]
        spots = [(a, b) for a in begins for b in reversed(edges) if 13 <= size(a, b) <= 19 and ((a, b) == (start, stop) or min(map(len, re.split("[ -]", text[a:b]))) > 2)]
        yield from sorted(spots, key=lambda s: (s != (start, stop), CARD_LAYOUT.fullmatch(text[s[0]:s[1]]) is None))
        return
    ends = edges[::-1]
    if kind == "iban":
        want, flat = IBAN_LENGTH.get(value[:2], 0), [i + 1 for i in range(start, stop) if text[i].isalnum()]
        ends = ([flat[want - 1]] if 0 < want <= len(flat) else []) + ends
    elif value[0] == "+":
        code = CODES.match(re.sub(r"\D", "", value))[0]
        want = len(code) + NATIONAL.get(code, 99)
        ends.sort(key=lambda e: size(start, e) != want)
    yield from ((start, e) for e in dict.fromkeys(ends))


def find(text: str, place: int, key: bytes, kinds: list[str]) -> tuple[str, int, int, str] | None:
    """The first valid value of ``kinds`` (tried in order) at a place, or inside what a card's pattern takes there."""
    for kind in kinds:
        m = EACH[kind].match(text, place)
        if m:
            for start, stop in candidates(kind, text, m.start(), m.end()):
                new = pseudonym(kind, text[start:stop], key)
                if new is not None:
                    return kind, start, stop, new
    return None


def rewrite(text: str, key: bytes, kinds: frozenset[str]) -> tuple[str, list[tuple[str, int, int, str]]]:
    """Text with pseudonyms, and (kind, start, end, pseudonym) of each find in the original."""
    finds: list[tuple[str, int, int, str]] = []
    out, done, at, inside = [], 0, 0, False
    order = list(KINDS)
    while m := (inside and HERE.match(text, at)) or PATTERN.search(text, at):
        got = find(text, m.start(), key, order[order.index(m.lastgroup):])
        inside = got is not None or m.lastgroup == "email"
        if got is None:
            at = m.start() + 1
            if m.lastgroup == "iban" and len(m.group().replace(" ", "")) == IBAN_LENGTH.get(m.group()[:2]):
                at, inside = m.end(), True                         # mistyped: its digits are no card
            continue
        kind, start, stop, new = got
        at = stop
        if kind in kinds:
            finds.append(got)
            out += [text[done:start], new]
            done = stop
    return "".join([*out, text[done:]]), finds


_FINDS = "array<struct<kind: string, start: int, stop: int, pseudonym: string>>"


def pseudonymise(docs: DataFrame, key: bytes, kinds: list[str] | None = None, id_col: str = "doc_id", text_col: str = "text") -> DataFrame:
    """One row per document: ``id, finds`` (kind, code point range in the original, pseudonym) and ``masked_text``."""
    use = frozenset(kinds or KINDS)
    signs = re.compile(r"[0-9@]")

    def run(batches: Iterator[pd.DataFrame]) -> Iterator[pd.DataFrame]:
        for b in batches:
            done = [rewrite(t, key, use) if isinstance(t, str) and signs.search(t) else (t, []) for t in b["text"]]
            finds = [[dict(zip(("kind", "start", "stop", "pseudonym"), f)) for f in x[1]] for x in done]
            yield pd.DataFrame({"id": b["id"], "finds": pd.Series(finds, dtype=object), "masked_text": pd.Series([x[0] for x in done], dtype=object)})

    rows = docs.select(F.col(id_col).cast("string").alias("id"), F.col(text_col).cast("string").alias("text"))
    got = rows.mapInPandas(run, f"id string, finds {_FINDS}, masked_text string")
    return got.select(F.col("id").cast(docs.schema[id_col].dataType).alias("id"), "finds", "masked_text")
