"""Format-preserving pseudonyms for personal data (operator 6).

A detected value is validated (check digits, ranges, calendar), turned into
its number within the set of all values of its format, permuted there by a
keyed Feistel network and written back in the same layout.  The permutation
depends on the key and the format alone, so equal values get equal pseudonyms
in every document, different values never the same one, and the key's owner
can undo it.  Texts keep their length.
"""

from __future__ import annotations

import datetime
import functools
import hashlib
import re
from collections.abc import Callable, Iterator
from typing import NamedTuple

import pyarrow as pa
from pyspark.sql import DataFrame

from ledgerline.llm import words as W
from ledgerline.operators.membership import fresh_name

ROUNDS = 8
DIGITS, LOWER, UPPER = "0123456789", "abcdefghijklmnopqrstuvwxyz", "ABCDEFGHIJKLMNOPQRSTUVWXYZ"
FIRST_DAY, LAST_DAY = datetime.date(1900, 1, 1).toordinal(), datetime.date(2099, 12, 31).toordinal()


class Span(NamedTuple):
    """A value found in a text: place, kind and its pseudonym."""

    start: int
    end: int
    kind: str
    pseudonym: str


class Permutation:
    """A keyed permutation of the numbers below ``size``: alternating Feistel rounds, walked until inside."""

    def __init__(self, key: bytes, tweak: str, size: int):
        self.size = size
        self.a = max(1, int(size**0.5))
        while self.a * self.a < size:
            self.a += 1
        self.b = -(-size // self.a)
        self.key, self.tweak = key, tweak.encode()

    def _f(self, i: int, half: int) -> int:
        h = hashlib.blake2b(b"%s|%d|%d|%d" % (self.tweak, self.size, i, half), key=self.key, digest_size=16)
        return int.from_bytes(h.digest(), "big")

    def _once(self, x: int, forward: bool) -> int:
        left, right = divmod(x, self.b)
        for i in range(ROUNDS) if forward else reversed(range(ROUNDS)):
            sign = 1 if forward else -1
            if i % 2:
                left = (left + sign * self._f(i, right)) % self.a
            else:
                right = (right + sign * self._f(i, left)) % self.b
        return left * self.b + right

    def __call__(self, x: int, forward: bool = True, valid: Callable[[int], bool] = lambda x: True) -> int:
        """The image of x among the valid numbers (x is one of them)."""
        while True:
            x = self._once(x, forward)
            if x < self.size and valid(x):
                return x


class Pseudonyms:
    """Pseudonyms under one key; ``forward`` False gives the values back."""

    def __init__(self, key: bytes, forward: bool = True):
        self.key, self.forward = hashlib.blake2b(key, digest_size=32).digest(), forward
        self.letters = functools.lru_cache(1 << 14)(self._letters)
        self.permutation = functools.lru_cache(1 << 10)(lambda tweak, size: Permutation(self.key, tweak, size))

    def _letters(self, kind: str, value: str, alphabets: tuple[str, ...]) -> str:
        """value with each character replaced within its alphabet, as one number in mixed radix."""
        x = size = 0
        for c, a in zip(value, alphabets, strict=True):
            x = x * len(a) + a.index(c)
            size = (size or 1) * len(a)
        if size < 2:
            return value
        x = self.permutation(f"{kind}:{'/'.join(alphabets) if len(set(alphabets)) > 1 else alphabets[0]}", size)(x, self.forward)
        out = []
        for a in reversed(alphabets):
            x, r = divmod(x, len(a))
            out.append(a[r])
        return "".join(reversed(out))

    # one method a kind: the pseudonym of a whole match, or None where it does not validate

    def email(self, text: str) -> str | None:
        """Letters and digits of the local part, each within its class; the domain stays."""
        local, domain = text.rsplit("@", 1)
        return _fill(local, self._alnum("email@" + domain.lower(), local)) + "@" + domain

    def _alnum(self, kind: str, text: str) -> str:
        chars = [c for c in text if c.isalnum()]
        return self.letters(kind, "".join(chars), tuple(DIGITS if c in DIGITS else LOWER if c in LOWER else UPPER for c in chars))

    def phone(self, text: str) -> str | None:
        """North American numbers by their ten digits; others by country prefix and length."""
        digits = "".join(c for c in text if c in DIGITS)
        plus = text.lstrip("(").startswith("+")
        national = digits[1:] if len(digits) == 11 and digits[0] == "1" else digits
        if len(national) == 10 and (not plus or len(digits) == 11) and national[0] in "23456789" and national[3] in "23456789":
            sets = tuple("23456789" if i in (0, 3) else DIGITS for i in range(10))
            return _fill(text, digits[:len(digits) - 10] + self.letters("phone", national, sets), DIGITS)
        if plus and 8 <= len(digits) <= 15 and digits[0] != "0":
            return _fill(text, digits[:2] + self.letters("phone+" + digits[:2], digits[2:], (DIGITS,) * (len(digits) - 2)), DIGITS)
        return None

    def card(self, text: str) -> str | None:
        """13 to 19 digits with a valid Luhn sum: the first and the check digit follow from the format."""
        digits = "".join(c for c in text if c in DIGITS)
        if not 13 <= len(digits) <= 19 or luhn(digits) or len(set(digits)) == 1:
            return None
        body = digits[0] + self.letters("card" + digits[0], digits[1:-1], (DIGITS,) * (len(digits) - 2))
        return _fill(text, body + str(-luhn(body + "0") % 10), DIGITS)

    def iban(self, text: str) -> str | None:
        """Country, check digits by modulus 97 and an account part, permuted by character class."""
        flat = text.replace(" ", "")
        if not 15 <= len(flat) <= 34 or _mod97(flat) != 1:
            return None
        body = self._alnum("iban" + flat[:2], flat[4:])
        return _fill(text, f"{flat[:2]}{98 - _mod97(flat[:2] + '00' + body):02d}{body}")

    def ssn(self, text: str) -> str | None:
        area, group, serial = map(int, text.split("-"))
        if area in (0, 666) or area >= 900 or not group or not serial:
            return None
        x = ((area - 1) * 99 + group - 1) * 9999 + serial - 1
        x = self.permutation("ssn", 899 * 99 * 9999)(x, self.forward, lambda x: x // (99 * 9999) != 665)
        return f"{x // (99 * 9999) + 1:03d}-{x // 9999 % 99 + 1:02d}-{x % 9999 + 1:04d}"

    def ip(self, text: str) -> str | None:
        """An IPv4 address of a host; every octet keeps its number of digits."""
        parts = text.split(".")
        if any(int(p) > 255 or str(int(p)) != p for p in parts) or not 1 <= int(parts[0]) <= 223:
            return None
        tops = [(1, 9), (10, 99), (100, 223)], [(0, 9), (10, 99), (100, 255)]
        ranges = [tops[i > 0][len(p) - 1] for i, p in enumerate(parts)]
        x = size = 0
        for p, (low, high) in zip(parts, ranges, strict=True):
            x, size = x * (high - low + 1) + int(p) - low, (size or 1) * (high - low + 1)
        x = self.permutation("ip" + "".join(str(len(p)) for p in parts), size)(x, self.forward)
        out = []
        for low, high in reversed(ranges):
            x, r = divmod(x, high - low + 1)
            out.append(str(low + r))
        return ".".join(reversed(out))

    def date(self, text: str) -> str | None:
        """A day of the calendar from 1900 to 2099, in a numeric layout that keeps its width."""
        sep = next(c for c in text if c not in DIGITS)
        parts = text.split(sep)
        layouts = ["ymd"] if len(parts[0]) == 4 else ["dmy"] if sep in ".-" else ["mdy", "dmy"]
        for layout in layouts:
            if (day := _day(parts, layout)) is not None:
                widths = [len(p) for p in parts]

                def write(x: int, layout=layout, widths=widths) -> list[str]:
                    d = datetime.date.fromordinal(FIRST_DAY + x)
                    return [str({"y": d.year, "m": d.month, "d": d.day}[c]).zfill(w) for c, w in zip(layout, widths, strict=True)]

                def valid(x: int, layout=layout, widths=widths) -> bool:
                    out = write(x)
                    # the layout that was read stays the one that will be read
                    return [len(p) for p in out] == widths and all(_day(out, o) is None for o in layouts[:layouts.index(layout)])

                x = self.permutation(f"date{layout}{widths}", LAST_DAY - FIRST_DAY + 1)(day - FIRST_DAY, self.forward, valid)
                return sep.join(write(x))
        return None

    def secret(self, text: str) -> str | None:
        """A named password, token or key: every letter and digit of its value within its class."""
        name, value = SECRET_VALUE.fullmatch(text).groups()
        hexed = all(c in "0123456789abcdef" for c in value)
        return name + (self.letters("hex", value, ("0123456789abcdef",) * len(value)) if hexed else _fill(value, self._alnum("secret", value)))

    def access_key(self, text: str) -> str | None:
        return text[:4] + self.letters("key", text[4:], (UPPER + DIGITS,) * (len(text) - 4))


def _fill(layout: str, chars: str, kinds: str = "") -> str:
    """layout with its letters and digits (or the characters in kinds) replaced by chars in order."""
    it = iter(chars)
    return "".join(next(it) if (c in kinds if kinds else c.isalnum()) else c for c in layout)


def luhn(digits: str) -> int:
    """The Luhn sum modulo 10; 0 for a valid number."""
    odd = digits[-1::-2]
    even = digits[-2::-2]
    return (sum(map(int, odd)) + sum(sum(divmod(2 * int(d), 10)) for d in even)) % 10


def _mod97(iban: str) -> int:
    return int("".join(str(int(c, 36)) for c in iban[4:] + iban[:4])) % 97


def _day(parts: list[str], layout: str) -> int | None:
    v = dict(zip(layout, map(int, parts), strict=True))
    try:
        day = datetime.date(v["y"], v["m"], v["d"]).toordinal()
    except ValueError:
        return None
    return day if FIRST_DAY <= day <= LAST_DAY else None


SECRET_VALUE = re.compile(r"(.*?[=:]\s?[\"']?)([A-Za-z0-9+/_.~-]{8,})", re.S)

#: Kinds and the layouts they are found by, in order of precedence where matches overlap.
LAYOUTS = {
    "email": r"(?<![A-Za-z0-9._%+-])[A-Za-z0-9][A-Za-z0-9._%+-]{0,63}@[A-Za-z0-9](?:[A-Za-z0-9-]{0,62}\.)+[A-Za-z]{2,24}(?![A-Za-z0-9])",
    "secret": r"(?i:\b(?:password|passwd|pwd|token|secret|api_?key|access_?key))\s?[=:]\s?[\"']?[A-Za-z0-9+/_.~-]{8,}",
    "access_key": r"(?<![A-Za-z0-9])A[KS]IA[A-Z0-9]{16}(?![A-Za-z0-9])",
    "iban": r"(?<![A-Za-z0-9])[A-Z]{2}\d{2}(?: ?[A-Z0-9]{4}){2,7}(?: ?[A-Z0-9]{1,3})?(?![A-Za-z0-9])",
    "ip": r"(?<![\w.])\d{1,3}(?:\.\d{1,3}){3}(?![\d]|\.\d)",
    "date": r"(?<![\d./-])(?:\d{4}([/.-])\d{1,2}\1\d{1,2}|\d{1,2}([/.-])\d{1,2}\2\d{4})(?![\d]|[/.-]\d)",
    "ssn": r"(?<![\d-])\d{3}-\d{2}-\d{4}(?![\d]|-\d)",
    "card": r"(?<![\d])\d(?:[ -]?\d){12,18}(?![\d])",
    "phone": r"(?<![\d.])(?:\+\d{1,3}[ .-]?)?(?:\(\d{2,4}\)[ .-]?)?\d{2,4}(?:[ .-]\d{2,4}){1,4}(?![\d])|(?<![\d.])\+\d{8,15}(?![\d])",
}
FIND = {kind: re.compile(pattern) for kind, pattern in LAYOUTS.items()}
#: A text without any of these holds none of the layouts.
HINT = re.compile(r"[0-9@=:]|A[KS]IA")


#: Kinds whose greedy match may take in what stands beside the value: shorter ends are tried too.
RETRIED = {"card", "phone", "iban"}
#: Usual layouts, preferred to longer matches at the same start.  They look at digits that pseudonyms keep in place.
USUAL = {
    "card": re.compile(r"\d{13,19}|\d{4}([ -])\d{4}\1\d{4}\1\d{4}|\d{4}([ -])\d{6}\2\d{5}"),
    "phone": re.compile(r"(?:\+?1[ .-]?)?(?:\([2-9]\d\d\)[ .-]?|[2-9]\d\d[ .-])[2-9]\d\d[ .-]\d{4}"),
}
#: Cards of other layouts than the usual do not touch a number of this shape, the usual ones none with another separator.
PHONE_SHAPE = re.compile(r"(?<!\d)(?:\(\d{3}\)[ .-]?\d{3}[ .-]|\d{3}([ .-])\d{3}\1)\d{4}(?!\d)")


def _ends(kind: str, text: str, m: re.Match, high: int) -> list[int]:
    """Ends of the layout from the match's start: usual layouts first, then the longest."""
    if kind not in RETRIED:
        return [m.end()]
    inner = str.isalnum if kind == "iban" else str.isdecimal
    out = [m.end()] + [e for e in range(m.end() - 1, m.start() + 7, -1) if inner(text[e - 1]) and not inner(text[e]) and FIND[kind].fullmatch(text, m.start(), e)]
    usual = USUAL.get(kind)
    if kind == "card":
        shapes = list(PHONE_SHAPE.finditer(text, max(0, m.start() - 20), min(high, m.end() + 20)))
        out = [e for e in out if not any(p.start() < e and p.end() > m.start() and not (usual.fullmatch(text, m.start(), e) and p.group()[-5] == text[m.start() + 4]) for p in shapes)]
    return sorted(out, key=lambda e: (not usual.fullmatch(text, m.start(), e), -e)) if usual else out


def _inside(kind: str, text: str, low: int, high: int, names: Pseudonyms) -> Iterator[Span]:
    """Validated values of a kind between two places; a match that does not validate gives way to shorter ends, then later starts."""
    while m := FIND[kind].search(text, low, high):
        low = m.start() + 1
        for end in _ends(kind, text, m, high):
            if (value := getattr(names, kind)(text[m.start():end])) is not None:
                yield Span(m.start(), end, kind, value)
                low = end
                break


def spans(text: str, names: Pseudonyms) -> list[Span]:
    """Validated values of a text in order, none overlapping another.

    Each kind is looked for in the stretches that the kinds before it left free.
    """
    if not HINT.search(text):
        return []
    found: list[Span] = []
    digit = re.search(r"\d", text) is not None
    for kind in FIND:
        if not ("@" in text if kind == "email" else "=" in text or ":" in text if kind == "secret" else "IA" in text if kind == "access_key" else digit):
            continue
        edges = zip([0, *(s.end for s in found)], [*(s.start for s in found), len(text)], strict=True)
        new = [s for low, high in edges for s in _inside(kind, text, low, high, names)]
        found = sorted(found + new)
    return found


def replaced(text: str, found: list[Span]) -> str:
    out, at = [], 0
    for s in found:
        out += [text[at:s.start], s.pseudonym]
        at = s.end
    return "".join([*out, text[at:]])


def undone(text: str, places: list[tuple[int, int, str]], key: bytes) -> str:
    """The text before pseudonyms were put at the (start, end, kind) of its spans."""
    names = _names(key, False)
    return replaced(text, [Span(start, end, kind, getattr(names, kind)(text[start:end])) for start, end, kind in places])


@functools.lru_cache(4)
def _names(key: bytes, forward: bool) -> Pseudonyms:
    return Pseudonyms(key, forward)


def pseudonymised(docs: DataFrame, key: bytes, text_col: str = "text", spans_col: str | None = "pii_spans", forward: bool = True) -> DataFrame:
    """docs with every validated value in ``text_col`` replaced by its pseudonym.

    All columns stay, rows pass one by one (repeats too).  ``spans_col`` (left
    out if None; where docs has a column of that name, with ``_`` behind it)
    lists start, end and kind of the replaced values in code points.  Null text
    stays null with no spans; empty texts stay empty; a very long text is
    searched whole; an empty table gives no rows.  ``forward`` False undoes the pseudonyms under the key, of
    the values it finds in the text.  Digits beside a value may then be read
    otherwise; ``undone`` at the listed places is exact.
    """
    W.small_batches(docs.sparkSession)
    at = docs.columns.index(text_col)
    spans_col = fresh_name(docs, spans_col) if spans_col else None

    def run(batches: Iterator[pa.RecordBatch]) -> Iterator[pa.RecordBatch]:
        names = _names(key, forward)
        for batch in batches:
            for rows in W.slices([batch], at):
                texts = rows.column(at).to_pylist()
                found = [spans(t, names) if t else [] for t in texts]
                columns = list(rows.columns)
                columns[at] = pa.array([replaced(t, f) if f else t for t, f in zip(texts, found, strict=True)], pa.string())
                if spans_col:
                    listed = [[{"start": s.start, "end": s.end, "kind": s.kind} for s in f] for f in found]
                    columns.append(pa.array(listed, pa.list_(pa.struct([("start", pa.int32()), ("end", pa.int32()), ("kind", pa.string())]))))
                yield pa.RecordBatch.from_arrays(columns, names=[*rows.schema.names, *([spans_col] if spans_col else [])])

    fields = [f"`{f.name}` {f.dataType.simpleString()}" for f in docs.schema.fields]
    if spans_col:
        fields.append(f"`{spans_col}` array<struct<start:int,end:int,kind:string>>")
    return docs.mapInArrow(run, ", ".join(fields))
