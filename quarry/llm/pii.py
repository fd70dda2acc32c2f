"""Format-preserving pseudonyms for personal data in texts.

Values are found by pattern, validated (check digits, number plan, calendar,
octets), and replaced by another valid value of the same format through a
keyed permutation: a Feistel network over the format's value numbers with
cycle walking. A pseudonym depends on the value and the key alone, never on
what stands beside it: equal values get equal pseudonyms in every document, and
different ones of a kind never the same.

Where a pseudonym stands in the new text is kept beside it (``spans``), so the
key's holder can undo every one of them: read anew, the pseudonym of a card
could by chance be valid together with digits behind it.
"""

from __future__ import annotations

import hashlib
import re
from collections import Counter
from collections.abc import Callable, Iterator
from datetime import date, timedelta
from functools import lru_cache

import pyarrow as pa
from pyspark.sql import DataFrame
from pyspark.sql import functions as F

ROUNDS = 10
KINDS = ("email", "iban", "card", "ssn", "phone", "date", "ip")


def permute(x: int, n: int, key: bytes, tweak: str, undo: bool = False) -> int:
    """A keyed permutation of 0..n-1: balanced Feistel over the next even power of two, walked until inside."""
    if n < 2:
        return x
    half = ((n - 1).bit_length() + 1) // 2
    mask, size = (1 << half) - 1, (half + 7) // 8
    order = range(ROUNDS)[::-1] if undo else range(ROUNDS)

    def f(i: int, v: int) -> int:
        h = hashlib.shake_256(key + f"|{tweak}|{n}|{i}|".encode() + v.to_bytes(size, "big"))
        return int.from_bytes(h.digest(size), "big") & mask

    while True:
        left, right = x >> half, x & mask
        for i in order:
            if undo:
                left, right = right ^ f(i, left), left
            else:
                left, right = right, left ^ f(i, right)
        x = left << half | right
        if x < n:
            return x


def luhn_digit(digits: str) -> str:
    """The check digit that makes ``digits`` plus it valid."""
    total = 0
    for i, c in enumerate(reversed(digits)):
        d = int(c) * (2 if i % 2 == 0 else 1)
        total += d - 9 if d > 9 else d
    return str(-total % 10)


def _refill(shape: str, values: str) -> str:
    """``shape`` with its letters and digits replaced by ``values`` in order."""
    it = iter(values)
    return "".join(next(it) if c.isalnum() else c for c in shape)


def _digits(s: str) -> str:
    return "".join(c for c in s if c.isdigit())


def _mixed(s: str, key: bytes, tweak: str, undo: bool) -> str:
    """Letters stay letters of their case, digits digits, all permuted together."""
    bases = [10 if c.isdigit() else 26 for c in s]
    zero = [ord("0") if c.isdigit() else ord("A") if c.isupper() else ord("a") for c in s]
    x, n = 0, 1
    for c, b, z in zip(s, bases, zero):
        x, n = x * b + ord(c) - z, n * b
    x = permute(x, n, key, tweak, undo)
    out = []
    for b, z in zip(reversed(bases), reversed(zero)):
        out.append(chr(z + x % b))
        x //= b
    return "".join(reversed(out))


def _email(s: str, key: bytes, undo: bool) -> str | None:
    local, _, domain = s.partition("@")
    core = "".join(c for c in local if c.isalnum())
    if not core or local[0] == "." or local[-1] == "." or ".." in s:
        return None
    kinds = "".join("9" if c.isdigit() else "A" if c.isupper() else "a" if c.isalpha() else c for c in local)
    return _refill(local, _mixed(core, key, f"email|{kinds}|{domain}", undo)) + "@" + domain


def _card(s: str, key: bytes, undo: bool) -> str | None:
    d = _digits(s)
    if not 13 <= len(d) <= 19 or luhn_digit(d[:-1]) != d[-1] or len(set(d)) == 1:
        return None
    n = len(d) - 1
    x = int(d[:-1])
    while True:                                     # same-digit numbers are no cards
        x = permute(x, 10 ** n, key, "card", undo)
        body = f"{x:0{n}d}"
        if len(set(out := body + luhn_digit(body))) > 1:
            return _refill(s, out)


def _ssn_ok(d: str) -> bool:
    return d[:3] not in ("000", "666") and d[0] != "9" and d[3:5] != "00" and d[5:] != "0000"


def _ssn(s: str, key: bytes, undo: bool) -> str | None:
    d = _digits(s)
    if not _ssn_ok(d):
        return None
    while True:
        d = f"{permute(int(d), 10 ** 9, key, 'ssn', undo):09d}"
        if _ssn_ok(d):
            return _refill(s, d)


def _phone(s: str, key: bytes, undo: bool) -> str | None:
    d = _digits(s)
    lead, d = d[:-10], d[-10:]
    if lead not in ("", "1") or d[0] < "2":
        return None
    wide = d[3] >= "2"                              # exchange codes from 200 stay from 200
    area, exchange, line = int(d[:3]) - 200, int(d[3:6]) - (200 if wide else 0), int(d[6:])
    room = 800 if wide else 200
    x = permute((area * room + exchange) * 10_000 + line, 800 * room * 10_000, key, f"phone|{wide}", undo)
    area, exchange, line = x // 10_000 // room + 200, x // 10_000 % room + (200 if wide else 0), x % 10_000
    return _refill(s, f"{lead}{area:03d}{exchange:03d}{line:04d}")


def _ip(s: str, key: bytes, undo: bool) -> str | None:
    parts = [int(p) for p in s.split(".")]
    if max(parts) > 255 or parts[0] == 0 or any(len(p) > 1 and p[0] == "0" for p in s.split(".")):
        return None
    x = int.from_bytes(bytes(parts), "big")
    while True:
        x = permute(x, 1 << 32, key, "ip", undo)
        if x >> 24:
            return ".".join(str(b) for b in x.to_bytes(4, "big"))


_FIRST, _DAYS = date(1900, 1, 1), (date(2100, 1, 1) - date(1900, 1, 1)).days


def _date(s: str, key: bytes, undo: bool) -> str | None:
    sep = next(c for c in s if not c.isdigit())
    a, b, c = s.split(sep)
    for name, y, m, d in (("ymd", a, b, c),) if len(a) == 4 else (("dmy", c, b, a), ("mdy", c, a, b)):
        try:
            x = (date(int(y), int(m), int(d)) - _FIRST).days
        except ValueError:
            continue
        if not 0 <= x < _DAYS:
            return None
        # day-first and month-first readings stay apart: a day-first value stays one that reads so first
        ambiguous = name == "mdy"
        while True:
            x = permute(x, _DAYS, key, f"date|{name}", undo)
            t = _FIRST + timedelta(days=x)
            if not ambiguous or t.day > 12:
                break
        y, m, d = f"{t.year:04d}", f"{t.month:02d}", f"{t.day:02d}"
        return sep.join({"ymd": (y, m, d), "dmy": (d, m, y), "mdy": (m, d, y)}[name])
    return None


def _iban_check(country: str, bban: str) -> str:
    number = "".join(str(int(c, 36)) for c in bban + country + "00")
    return f"{98 - int(number) % 97:02d}"


def _iban(s: str, key: bytes, undo: bool) -> str | None:
    v = s.replace(" ", "")
    if not 15 <= len(v) <= 34 or _iban_check(v[:2], v[4:]) != v[2:4]:
        return None
    kinds = "".join("9" if c.isdigit() else "A" for c in v[4:])
    bban = _mixed(v[4:], key, f"iban|{v[:2]}|{kinds}", undo)
    return _refill(s, v[:2] + _iban_check(v[:2], bban) + bban)


_AT = re.compile(r"(?<![A-Za-z0-9._%+-])[A-Za-z0-9._%+-]{1,64}@[A-Za-z0-9](?:[A-Za-z0-9-]*[A-Za-z0-9])?"
                 r"(?:\.[A-Za-z0-9](?:[A-Za-z0-9-]*[A-Za-z0-9])?)*\.[A-Za-z]{2,24}(?![A-Za-z0-9])")
# each starts at a digit (or what may stand before a phone number's first digit)
_NUMBERS = re.compile(
    r"(?P<iban>(?<![A-Za-z0-9])[A-Z]{2}[0-9]{2}(?: ?[A-Z0-9]){11,30}(?![A-Za-z0-9]))"
    r"|(?P<ip>(?<![0-9.])[0-9]{1,3}(?:\.[0-9]{1,3}){3}(?![0-9]|\.[0-9]))"
    r"|(?P<date>(?<![0-9/.-])(?:[0-9]{4}(?P<s1>[-/.])[0-9]{2}(?P=s1)[0-9]{2}|[0-9]{2}(?P<s2>[-/.])[0-9]{2}(?P=s2)[0-9]{4})(?![0-9]|[-/.][0-9]))"
    r"|(?P<ssn>(?<![0-9-])[0-9]{3}-[0-9]{2}-[0-9]{4}(?![0-9]|-[0-9]))"
    r"|(?P<phone>(?<![0-9A-Za-z])(?:\+?1[ .-]?)?(?:\([0-9]{3}\) ?|[0-9]{3}[ .-])[0-9]{3}[ .-][0-9]{4}(?![0-9]))"
    r"|(?P<card>(?<![0-9A-Za-z])[0-9](?:[ -]?[0-9]){12,18}(?![0-9A-Za-z]))")
_FIND = re.compile(r"[0-9]")
_BY_KIND: dict[str, Callable[[str, bytes, bool], str | None]] = {
    "email": _email, "iban": _iban, "card": _card, "ssn": _ssn, "phone": _phone, "date": _date, "ip": _ip}


# Characters of an IBAN by country; others may have any length.
_IBAN_LENGTH = {
    "AD": 24, "AE": 23, "AL": 28, "AT": 20, "AZ": 28, "BA": 20, "BE": 16, "BG": 22, "BH": 22, "BR": 29, "BY": 28, "CH": 21, "CR": 22,
    "CY": 28, "CZ": 24, "DE": 22, "DK": 18, "DO": 28, "EE": 20, "EG": 29, "ES": 24, "FI": 18, "FO": 18, "FR": 27, "GB": 22, "GE": 22,
    "GI": 23, "GL": 18, "GR": 27, "GT": 28, "HR": 21, "HU": 28, "IE": 22, "IL": 23, "IQ": 23, "IS": 26, "IT": 27, "JO": 30, "KW": 30,
    "KZ": 20, "LB": 28, "LC": 32, "LI": 21, "LT": 20, "LU": 20, "LV": 21, "LY": 25, "MC": 27, "MD": 24, "ME": 22, "MK": 19, "MR": 27,
    "MT": 31, "MU": 30, "NL": 18, "NO": 15, "PK": 24, "PL": 28, "PS": 29, "PT": 25, "QA": 29, "RO": 24, "RS": 22, "SA": 24, "SC": 31,
    "SE": 24, "SI": 19, "SK": 24, "SM": 27, "SN": 28, "ST": 25, "SV": 28, "TL": 23, "TN": 24, "TR": 26, "UA": 29, "VA": 22, "VG": 24,
    "XK": 20,
}
Span = tuple[int, int, str]                         # start, length, kind


def _card_groups(value: str) -> bool:
    *groups, last = map(len, re.split("[ -]", value))
    return (groups, last) in (([4, 6], 5), ([4, 6], 4)) or len({*groups}) < 2 and last <= max(groups, default=last)


def _ends(kind: str, value: str) -> list[int]:
    """Where a value that starts like the match may end, the likeliest first: at group borders, an IBAN by its country
    or else the longest, a card the shortest (what follows a card is rather its code than its end).

    A card's groups are of one size but for a shorter last one (or 4-6-5 and 4-6-4), with one kind of separator before
    the match's end: other groups are numbers beside it.
    """
    if kind not in ("iban", "card"):
        return [len(value)]
    least = 15 if kind == "iban" else 13
    ends, n = [], 0
    for i, c in enumerate(value):
        n += c.isalnum()
        if c.isalnum() and n >= least and not value[i + 1:i + 2].isalnum():
            ends.append((i + 1, n))
    if kind == "card":
        return [i for i, _ in ends if _card_groups(value[:i]) and (i == len(value) or len(set(value[:i]) & {" ", "-"}) < 2)]
    long = _IBAN_LENGTH.get(value[:2])
    if long is None:
        return [i for i, _ in reversed(ends)]
    return list(dict.fromkeys([i for i, n in ends if n == long] + [len(value)]))


def _next(text: str, at: int, key: bytes) -> tuple[int, int, str, str] | None:
    """``(start, end, kind, pseudonym)`` of the first value from ``at`` on."""
    while m := _NUMBERS.search(text, at):
        kind = m.lastgroup if m.lastgroup in _BY_KIND else "date"
        for n in _ends(kind, m[0]):
            new = _pseudonym(kind, m[0][:n], key, False)
            if new is not None:
                return m.start(), m.start() + n, kind, new
        at = m.start() + 1
    return None


@lru_cache(maxsize=1 << 16)
def _pseudonym(kind: str, value: str, key: bytes, undo: bool) -> str | None:
    return _BY_KIND[kind](value, key, undo)


def pseudonymise(text: str, key: bytes) -> tuple[str, list[Span]]:
    """The text with every validated value replaced, and where the pseudonyms are in it."""
    out: list[str] = []
    spans: list[Span] = []
    length = 0

    def put(part: str, kind: str | None = None) -> None:
        nonlocal length
        if kind:
            spans.append((length, len(part), kind))
        out.append(part)
        length += len(part)

    def numbers(part: str) -> None:
        at = 0
        while found := _FIND.search(part) and _next(part, at, key):
            start, at_end, kind, new = found
            put(part[at:start])
            put(new, kind)
            at = at_end
        put(part[at:])

    at = 0
    for m in _AT.finditer(text) if "@" in text else ():     # what an address holds is not looked at again
        numbers(text[at:m.start()])
        new = _pseudonym("email", m[0], key, False)
        put(m[0] if new is None else new, new and "email")
        at = m.end()
    numbers(text[at:])
    return "".join(out), spans


def restore(text: str, spans: list[Span], key: bytes) -> str:
    """The text before its values were replaced. Pseudonyms are as long as their values, so places stay."""
    out, at = [], 0
    for start, length, kind in spans:
        out += [text[at:start], _pseudonym(kind, text[start:start + length], key, True)]
        at = start + length
    return "".join([*out, text[at:]])


_SPANS = "spans array<struct<start:int,length:int,kind:string>>"


def pseudonymised(docs: DataFrame, key: bytes, id_col: str = "doc_id", text_col: str = "text") -> DataFrame:
    """One row per document row: id, text with pseudonyms, ``n_<kind>`` found of each kind, and their ``spans``.

    Values that fail their validation stay as they are, wherever they stand. A
    value followed or preceded by other digits is the first that validates, by
    the places where one may end (``_ends``). Null texts stay null with zero
    counts and no spans, empty ones empty; repeated rows and equal values get
    equal results; an empty table gives no rows; other columns are not read.
    One scan without a shuffle.
    """

    def run(batches: Iterator[pa.RecordBatch]) -> Iterator[pa.RecordBatch]:
        kept = pa.list_(pa.struct([("start", pa.int32()), ("length", pa.int32()), ("kind", pa.string())]))
        for batch in batches:
            done = [(None, []) if t is None else pseudonymise(t, key) for t in batch.column(1).to_pylist()]
            count = [Counter(k for _, _, k in spans) for _, spans in done]
            yield pa.RecordBatch.from_arrays(
                [batch.column(0), pa.array([t for t, _ in done], pa.string()),
                 *[pa.array([c[k] for c in count], pa.int32()) for k in KINDS],
                 pa.array([[dict(zip(("start", "length", "kind"), x)) for x in spans] for _, spans in done], kept)],
                names=[id_col, "text", *[f"n_{k}" for k in KINDS], "spans"])

    src = docs.select(F.col(id_col), F.col(text_col).cast("string"))
    kind = src.schema[0].dataType.simpleString()
    return src.mapInArrow(run, f"`{id_col}` {kind}, text string, " + ", ".join(f"n_{k} int" for k in KINDS) + f", {_SPANS}")


def restored(docs: DataFrame, key: bytes, id_col: str = "doc_id") -> DataFrame:
    """Ids and texts as they were, from what ``pseudonymised`` gave."""

    def run(batches: Iterator[pa.RecordBatch]) -> Iterator[pa.RecordBatch]:
        for batch in batches:
            texts = [None if t is None else restore(t, [(x["start"], x["length"], x["kind"]) for x in spans], key)
                     for t, spans in zip(batch.column(1).to_pylist(), batch.column(2).to_pylist())]
            yield pa.RecordBatch.from_arrays([batch.column(0), pa.array(texts, pa.string())], names=[id_col, "text"])

    src = docs.select(F.col(id_col), "text", "spans")
    return src.mapInArrow(run, f"`{id_col}` {src.schema[0].dataType.simpleString()}, text string")
