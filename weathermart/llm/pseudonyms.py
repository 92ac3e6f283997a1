"""Format-preserving pseudonyms for personal data.

Validated numbers (cards, IBANs, phones, social security numbers, IPv4 addresses),
dates and e-mail names are replaced by other values of the same format. A value is
read as a number below the size of its format; a keyed Feistel network permutes
those numbers, and the result is written back in the original's layout. So equal
values get equal pseudonyms in every document, in every layout of the digits, and
whoever holds the key can undo them. Each row is rewritten where it is: no shuffle,
no table of values.
"""

from __future__ import annotations

import datetime as dt
import hashlib
import re
from collections.abc import Callable, Iterator
from dataclasses import dataclass

import pyarrow as pa
from pyspark.sql import DataFrame
from pyspark.sql import functions as F

from weathermart.llm.common import slices

ROUNDS = 10


def _round(key: bytes, tweak: bytes, number: int, half: int, bits: int) -> int:
    data = tweak + number.to_bytes(1, "big") + half.to_bytes((bits + 7) // 8 or 1, "big")
    return int.from_bytes(hashlib.blake2b(data, key=key).digest(), "big") & ((1 << bits) - 1)


def permute(value: int, size: int, key: bytes, tweak: bytes, back: bool = False) -> int:
    """Keyed permutation of 0 .. size - 1; ``back`` undoes it.

    A balanced Feistel network on the next even number of bits, repeated until the
    value is in range again (cycle walking), which takes four turns on average at most.
    """
    bits = max(1, ((size - 1).bit_length() + 1) // 2)
    mask = (1 << bits) - 1
    tweak = tweak + size.to_bytes(64, "big")
    while True:
        a, b = value >> bits, value & mask
        for number in reversed(range(ROUNDS)) if back else range(ROUNDS):
            if back:
                a, b = b ^ _round(key, tweak, number, a, bits), a
            else:
                a, b = b, a ^ _round(key, tweak, number, b, bits)
        value = a << bits | b
        if value < size:
            return value


def luhn(digits: str) -> bool:
    return _luhn_sum(digits) % 10 == 0


def _luhn_sum(digits: str) -> int:
    doubled = (int(d) * 2 if i % 2 else int(d) for i, d in enumerate(reversed(digits)))
    return sum(d - 9 if d > 9 else d for d in doubled)


def _put(layout: str, characters: str, fits: Callable[[str], bool]) -> str:
    """``layout`` with the characters that fit replaced, in order, by ``characters``."""
    rest = iter(characters)
    return "".join(next(rest) if fits(c) else c for c in layout)


def _digits(text: str) -> str:
    return "".join(c for c in text if "0" <= c <= "9")


def _is_digit(c: str) -> bool:
    return "0" <= c <= "9"


def _shift(digits: str, key: bytes, tweak: str, back: bool) -> str:
    size = 10 ** len(digits)
    return str(permute(int(digits), size, key, tweak.encode(), back)).zfill(len(digits))


def card(text: str, key: bytes, back: bool = False) -> str | None:
    """13 to 19 digits that pass the Luhn check; the pseudonym passes it too."""
    digits = _digits(text)
    if not 13 <= len(digits) <= 19 or not luhn(digits):
        return None
    body = _shift(digits[:-1], key, "card", back)
    return _put(text, body + str(-_luhn_sum(body + "0") % 10), _is_digit)


def iban(text: str, key: bytes, back: bool = False) -> str | None:
    """A valid IBAN; country and layout of letters stay, the check digits fit again."""
    plain = text.replace(" ", "")
    if len(plain) < 15:
        return None

    def rest(country: str, check: str, account: str) -> int:
        return int("".join(str(int(c, 36)) for c in account + country + check)) % 97

    country, check, account = plain[:2], plain[2:4], plain[4:]
    if rest(country, check, account) != 1:
        return None
    account = _mixed(account, key, "iban" + country, back)
    check = f"{98 - rest(country, '00', account):02d}"
    return _put(text, country + check + account, lambda c: c != " ")


def _mixed(text: str, key: bytes, tweak: str, back: bool) -> str:
    """Letters stay letters of their case and digits digits; other characters stay."""
    bases = [
        ("0", 10) if _is_digit(c) else ("a", 26) if "a" <= c <= "z" else ("A", 26) if "A" <= c <= "Z" else None
        for c in text
    ]
    value, size = 0, 1
    for c, base in zip(text, bases, strict=True):
        if base:
            value, size = value * base[1] + ord(c) - ord(base[0]), size * base[1]
    if size == 1:
        return text
    shape = "".join(base[0] if base else "." for base in bases)
    value = permute(value, size, key, f"{tweak}{shape}".encode(), back)
    out = []
    for c, base in zip(reversed(text), reversed(bases), strict=True):
        if base:
            value, digit = divmod(value, base[1])
            c = chr(ord(base[0]) + digit)
        out.append(c)
    return "".join(reversed(out))


def phone(text: str, key: bytes, back: bool = False) -> str | None:
    """International or bracketed numbers of 7 to 15 digits; a country code stays."""
    code = re.match(r"\+\d{1,3}", text)
    start = code.end() if code else 0
    digits = _digits(text[start:])
    if not 7 <= len(digits) <= 15:
        return None
    return text[:start] + _put(text[start:], _shift(digits, key, "phone", back), _is_digit)


def ssn(text: str, key: bytes, back: bool = False) -> str | None:
    """Area, group and number in the ranges that are given out, and again so afterwards."""
    area, group, number = (int(p) for p in text.split("-"))
    areas = [a for a in range(1, 900) if a != 666]
    if area not in areas or not group or not number:
        return None
    value = (areas.index(area) * 99 + group - 1) * 9999 + number - 1
    value = permute(value, len(areas) * 99 * 9999, key, b"ssn", back)
    value, number = divmod(value, 9999)
    area, group = divmod(value, 99)
    return f"{areas[area]:03d}-{group + 1:02d}-{number + 1:04d}"


def ipv4(text: str, key: bytes, back: bool = False) -> str | None:
    octets = [int(p) for p in text.split(".")]
    if max(octets) > 255:
        return None
    value = permute(int.from_bytes(bytes(octets), "big"), 1 << 32, key, b"ipv4", back)
    return ".".join(map(str, value.to_bytes(4, "big")))


_FIRST, _LAST = dt.date(1900, 1, 1).toordinal(), dt.date(2099, 12, 31).toordinal()


def date(text: str, key: bytes, back: bool = False) -> str | None:
    """A real day from 1900 to 2099 as Y-M-D or Y/M/D, D.M.Y, or M/D/Y, zeros as given."""
    parts = re.split(r"[-./]", text)
    order = (0, 1, 2) if len(parts[0]) == 4 else (2, 1, 0) if "." in text else (2, 0, 1)
    try:
        day = dt.date(*(int(parts[i]) for i in order)).toordinal()
    except ValueError:
        return None
    if not _FIRST <= day <= _LAST:
        return None
    to = dt.date.fromordinal(_FIRST + permute(day - _FIRST, _LAST - _FIRST + 1, key, b"date", back))
    fields = dict(zip(order, (f"{to.year:04d}", f"{to.month:02d}", f"{to.day:02d}"), strict=True))
    marks = re.findall(r"[-./]", text)
    return fields[0] + marks[0] + fields[1] + marks[1] + fields[2]


def email(text: str, key: bytes, back: bool = False) -> str | None:
    """Name and domain keep their layout; so does the last part of the domain."""
    name, _, domain = text.rpartition("@")
    host, _, top = domain.rpartition(".")
    return f"{_mixed(name, key, 'name', back)}@{_mixed(host, key, 'host', back)}.{top}"


def _whole(match: str) -> list[int]:
    return [len(match)]


def _prefixes(match: str) -> list[int]:
    """The match and its prefixes that end before a separator, longest first."""
    return [len(match), *(m.start() for m in reversed(list(re.finditer(r"[ -]", match))))]


_CARD_LAYOUT = re.compile(r"(?:[0-9]{13,19}|[0-9]{4}([ -])[0-9]{4}\1[0-9]{4}\1[0-9]{4}|[0-9]{4}([ -])[0-9]{6}\2[0-9]{5})(?![0-9])")


def card_lengths(match: str) -> list[int]:
    """What of a run of digits to read as a card: a usual layout first, then the longest."""
    usual = _CARD_LAYOUT.match(match)
    return list(dict.fromkeys([*([usual.end()] if usual else []), *_prefixes(match)]))


# Characters of an IBAN by country.
IBAN_LENGTHS = {
    code: int(length)
    for length, codes in {
        "15": "NO", "16": "BE", "18": "DK FI FK FO GL NL SD", "19": "MK SI",
        "20": "AT BA EE KZ LT LU MN XK", "21": "CH HR LI LV", "22": "BG BH CR DE GB GE IE ME RS VA",
        "23": "AE GI IL IQ OM SO TL", "24": "AD CZ ES MD PK RO SA SE SK TN VG", "25": "LY PT ST",
        "26": "IS TR", "27": "BI DJ FR GR IT MC MR SM", "28": "AL AZ BY CY DO GT HU LB NI PL SV",
        "29": "BR EG PS QA UA", "30": "JO KW MU YE", "31": "MT SC", "32": "LC", "33": "RU",
    }.items()
    for code in codes.split()
}


def iban_lengths(match: str) -> list[int]:
    """What of a run of capitals and digits to read as an IBAN: the country's length first."""
    ends = _prefixes(match)
    own = [e for e in ends if len(match[:e].replace(" ", "")) == IBAN_LENGTHS.get(match[:2])]
    return list(dict.fromkeys(own + ends))


@dataclass(frozen=True)
class Kind:
    name: str
    pattern: str
    replace: Callable[[str, bytes, bool], str | None]
    # Lengths of a match's prefixes, in the order in which they are tried.
    lengths: Callable[[str], list[int]] = _whole


def _alone(pattern: str) -> str:
    return rf"(?<![0-9A-Za-z])(?:{pattern})(?![0-9A-Za-z])"


# Where two kinds match at one place the first that validates wins.
KINDS = (
    Kind("email", r"[^\s@<>\"',;:()\[\]]+@[A-Za-z0-9-]+(?:\.[A-Za-z0-9-]+)*\.[A-Za-z]{2,}", email),
    Kind("iban", _alone(r"[A-Z]{2}[0-9]{2}(?: ?[A-Z0-9]){11,30}"), iban, iban_lengths),
    Kind(
        "phone",
        r"(?<![0-9A-Za-z])\+(?:[0-9]{1,3} ?\([0-9]{2,4}\) ?[0-9]{3,4}[-. ]?[0-9]{3,4}"
        r"|[0-9]{1,3}([-. ])[0-9]{2,4}(?:\1[0-9]{2,4}){1,3}|[0-9]{7,15})(?![0-9A-Za-z]|\.[0-9])",
        phone,
    ),
    Kind("phone", r"\([0-9]{3}\) ?[0-9]{3}[-. ][0-9]{4}(?![0-9A-Za-z])", phone),
    Kind("card", _alone(r"[0-9](?:[ -]?[0-9]){12,18}"), card, card_lengths),
    Kind("ipv4", r"(?<![0-9A-Za-z.])[0-9]{1,3}(?:\.[0-9]{1,3}){3}(?![0-9A-Za-z]|\.[0-9])", ipv4),
    Kind("ssn", _alone(r"[0-9]{3}-[0-9]{2}-[0-9]{4}"), ssn),
    Kind(
        "date",
        _alone(
            r"[0-9]{4}-[0-9]{2}-[0-9]{2}|[0-9]{4}/[0-9]{2}/[0-9]{2}"
            r"|[0-9]{2}\.[0-9]{2}\.[0-9]{4}|[0-9]{2}/[0-9]{2}/[0-9]{4}"
        ),
        date,
    ),
)
NAMES = tuple(dict.fromkeys(k.name for k in KINDS))


def rewrite(text: str, key: bytes, back: bool = False) -> tuple[str, dict[str, int]]:
    """The text with every validated value replaced, and how many there were of each kind.

    A replacement is not looked at again: kinds claim spans of the original first. Cards
    and IBANs are also looked for in what a longer match that is not valid begins with, and
    the search goes on behind a rejected start (a card before its expiry date, an IBAN
    before its BIC). Where a pseudonym would make a span valid that was rejected before it,
    the next one is taken, so that the key undoes it.
    """
    counts: dict[str, int] = {}
    if not ("@" in text or _HAS_DIGIT.search(text)):
        return text, counts
    taken: list[tuple[int, int, str]] = []
    for kind, expression in zip(KINDS, _COMPILED, strict=True):
        if kind.name == "email" and "@" not in text:
            continue
        failed: list[tuple[int, int]] = []
        m = expression.search(text)
        while m:
            start, then = m.start(), m.start() + 1
            for length in kind.lengths(m[0]):
                end = start + length
                if any(a < end and start < b for a, b, _ in taken):
                    continue
                new = kind.replace(text[start:end], key, back)
                if new is None:
                    failed.append((start, end))
                    continue
                while _reads_otherwise(kind, text, failed, start, end, new, key):
                    new = kind.replace(new, key, back)
                taken.append((start, end, new))
                counts[kind.name] = counts.get(kind.name, 0) + 1
                then = end
                break
            m = expression.search(text, then)
            failed = [span for span in failed if m and span[1] > m.start()]
    out, at = [], 0
    for a, b, new in sorted(taken):
        out += [text[at:a], new]
        at = b
    return "".join([*out, text[at:]]), counts


def _reads_otherwise(
    kind: Kind, text: str, failed: list[tuple[int, int]], start: int, end: int, new: str, key: bytes
) -> bool:
    """Whether ``new`` makes a span valid that was tried before it, so that it could not be undone."""
    return any(
        kind.replace(text[a : max(a, start)] + new[max(a - start, 0) : b - start] + text[end:b], key, False)
        is not None
        for a, b in failed
        if a < end and start < b
    )


_HAS_DIGIT = re.compile("[0-9]")
_COMPILED = [re.compile(k.pattern) for k in KINDS]


def pseudonymise(docs: DataFrame, key: bytes) -> DataFrame:
    """doc_id, text and the number of replaced values of each kind (n_email, ...) of every row.

    Values that fail their validation stay as they are. A null text stays null, an
    empty one empty. Repeated rows come out equal. An empty table gives no rows.
    Columns other than doc_id and text are ignored, whatever their names.
    """

    def run(batches: Iterator[pa.RecordBatch]) -> Iterator[pa.RecordBatch]:
        for batch in slices(batches):
            texts = batch.column("text").to_pylist()
            done = [(None, {}) if t is None else rewrite(t, key) for t in texts]
            yield pa.RecordBatch.from_arrays(
                [batch.column("doc_id"), pa.array([t for t, _ in done], pa.string())]
                + [pa.array([c.get(n, 0) for _, c in done], pa.int64()) for n in NAMES],
                ["doc_id", "text", *[f"n_{n}" for n in NAMES]],
            )

    columns = ", ".join(f"n_{n} long" for n in NAMES)
    return docs.select(F.col("doc_id").cast("long").alias("doc_id"), "text").mapInArrow(
        run, f"doc_id long, text string, {columns}"
    )
