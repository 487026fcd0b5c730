"""PII: format-preserving Feistel pseudonyms.

Validated values (payment cards and IBANs by check digits, social security numbers by their ranges, phone numbers,
IPv4 addresses, calendar dates) and personal strings (e-mail addresses, credentials) are replaced by a keyed
permutation of their own format: digits stay digits, check digits stay right, dates stay dates, separators stay in
place. Equal values get equal pseudonyms in all documents, whatever their separators; different values get different
ones. With the key the permutation can be undone (``reverse=True``), and a pseudonym is found by the same patterns.

Where a match reaches into digits or capitals that follow a value and its check fails, its parts between separators are
tried (an IBAN has the length of its country, cards the longest first), then the other kinds at the same place. A
pseudonym there that would read as another value with what stands around it is permuted again until it does not, so
that the way back finds it; only such values may lose the link to equal ones elsewhere. After ``MOST_WALKS`` attempts
the first pseudonym stays: the value is hidden, but the way back need not find it (long runs of single digits before a
card, for example).

The permutation numbers the values of a format from 0 to N - 1 and applies a balanced Feistel network of keyed BLAKE2b
rounds, walking the cycle until the result lies in the range again.
"""

from __future__ import annotations

import datetime as dt
import re
from collections.abc import Callable, Iterator
from hashlib import blake2b

import numpy as np
import pyarrow as pa
from pyspark.sql import DataFrame
from pyspark.sql import functions as F
from pyspark.sql.types import StructType

from tidemark.llm.common import out_batch, small

ROUNDS = 8


class Feistel:
    """Keyed permutations of ``range(size)``, one per kind of value and size."""

    def __init__(self, key: bytes, reverse: bool = False):
        if not 16 <= len(key) <= 64:
            raise ValueError("the key must have 16 to 64 bytes")
        self.key, self.reverse = key, reverse

    def _round(self, kind: str, size: int, number: int, half: int, bits: int) -> int:
        data = f"{kind}/{size}/{number}/{half:x}".encode()
        out, more = b"", 0
        while len(out) * 8 < bits:
            out += blake2b(data + b"/%d" % more, key=self.key).digest()
            more += 1
        return int.from_bytes(out, "big") & ((1 << bits) - 1)

    def permute(self, kind: str, value: int, size: int) -> int:
        if size < 2:
            return value
        bits = max(1, ((size - 1).bit_length() + 1) // 2)
        mask = (1 << bits) - 1
        numbers = range(ROUNDS - 1, -1, -1) if self.reverse else range(ROUNDS)
        while True:
            left, right = value >> bits, value & mask
            for n in numbers:
                if self.reverse:
                    left, right = right ^ self._round(kind, size, n, left, bits), left
                else:
                    left, right = right, left ^ self._round(kind, size, n, right, bits)
            value = left << bits | right
            if value < size:
                return value


# ---- formats: a validated match to its pseudonym, or None if it is no such value ------------

def _refill(pattern: str, symbols: str, is_symbol: Callable[[str], bool]) -> str:
    """``pattern`` with its symbols replaced one by one; separators stay."""
    new = iter(symbols)
    return "".join(next(new) if is_symbol(c) else c for c in pattern)


def _digits(text: str) -> str:
    return "".join(c for c in text if c.isdigit())


def _permute_digits(f: Feistel, kind: str, digits: str) -> str:
    return str(f.permute(kind, int(digits), 10 ** len(digits))).zfill(len(digits))


def luhn_digit(payload: str) -> str:
    total = 0
    for k, c in enumerate(reversed(payload)):
        d = int(c) * (1 if k % 2 else 2)
        total += d - 9 * (d > 9)
    return str(-total % 10)


def card(f: Feistel, text: str) -> str | None:
    digits = _digits(text)
    if not 13 <= len(digits) <= 19 or luhn_digit(digits[:-1]) != digits[-1]:
        return None
    payload = _permute_digits(f, "card", digits[:-1])
    return _refill(text, payload + luhn_digit(payload), str.isdigit)


def _iban_check(country: str, account: str) -> str:
    number = "".join(str(int(c, 36)) for c in account + country + "00")
    return f"{98 - int(number) % 97:02d}"


# Characters of an IBAN by country.
IBAN_LENGTHS = {x[:2]: int(x[2:]) for x in (
    "AD24 AE23 AL28 AT20 AZ28 BA20 BE16 BG22 BH22 BI27 BR29 BY28 CH21 CR22 CY28 CZ24 DE22 DJ27 DK18 DO28 EE20 EG29 ES24 "
    "FI18 FK18 FO18 FR27 GB22 GE22 GI23 GL18 GR27 GT28 HN28 HR21 HU28 IE22 IL23 IQ23 IS26 IT27 JO30 KW30 KZ20 LB28 LC32 "
    "LI21 LT20 LU20 LV21 LY25 MC27 MD24 ME22 MK19 MN20 MR27 MT31 MU30 NI28 NL18 NO15 OM23 PK24 PL28 PS29 PT25 QA29 RO24 "
    "RS22 RU33 SA24 SC31 SD18 SE24 SI19 SK24 SM27 SO23 ST25 SV28 TL23 TN24 TR26 UA29 VA22 VG24 XK20 YE30").split()}


def iban(f: Feistel, text: str) -> str | None:
    plain = text.replace(" ", "")
    country, check, account = plain[:2], plain[2:4], plain[4:]
    if not 15 <= len(plain) <= 34 or _iban_check(country, account) != check:
        return None
    new = permute_string(f, "iban", account)
    return _refill(text, country + _iban_check(country, new) + new, lambda c: c != " ")


def phone(f: Feistel, text: str) -> str | None:
    digits = _digits(text)
    if not 8 <= len(digits) <= 15:
        return None
    country = len(re.match(r"\+?(\d*)", text)[1]) if text.startswith("+") else 0
    country = min(country, 3) if country < len(digits) - 6 else 0
    return _refill(text, digits[:country] + _permute_digits(f, "phone", digits[country:]),
                   str.isdigit)


def social(f: Feistel, text: str) -> str | None:
    area, group, serial = int(text[:3]), int(text[4:6]), int(text[7:])
    if area in (0, 666) or area >= 900 or not group or not serial:
        return None
    number = ((area - 1 - (area > 666)) * 99 + group - 1) * 9999 + serial - 1
    number = f.permute("social", number, 898 * 99 * 9999)
    area, rest = divmod(number, 99 * 9999)
    group, serial = divmod(rest, 9999)
    area += 1 + (area + 1 >= 666)
    return f"{area:03d}{text[3]}{group + 1:02d}{text[6]}{serial + 1:04d}"


def address(f: Feistel, text: str) -> str | None:
    parts = text.split(".")
    if any(int(p) > 255 or (len(p) > 1 and p[0] == "0") for p in parts):
        return None
    number = f.permute("ipv4", int.from_bytes(bytes(map(int, parts)), "big"), 1 << 32)
    return ".".join(map(str, number.to_bytes(4, "big")))


_FIRST_DAY, _LAST_DAY = dt.date(1900, 1, 1).toordinal(), dt.date(2099, 12, 31).toordinal()
_DATE = re.compile(r"(\d{1,4})([-/.])(\d{1,2})\2(\d{2,4})")


def date(f: Feistel, text: str) -> str | None:
    """Year-month-day, or day and month before a four-digit year (day first, unless only month first is a date)."""
    m = _DATE.fullmatch(text)
    a, sep, b, c = m.groups()
    if len(a) == 4 and len(b) == 2 and len(c) == 2:
        orders = ("ymd",)
    elif len(a) == 2 and len(b) == 2 and len(c) == 4:
        orders = ("dmy", "mdy")
    else:
        return None
    for order in orders:
        at = dict(zip(order, (a, b, c)))
        try:
            day = dt.date(int(at["y"]), int(at["m"]), int(at["d"])).toordinal()
        except ValueError:
            continue
        if not _FIRST_DAY <= day <= _LAST_DAY:
            return None
        new = dt.date.fromordinal(_FIRST_DAY + f.permute("date", day - _FIRST_DAY, _LAST_DAY - _FIRST_DAY + 1))
        if order == "mdy" and new.day <= 12:
            # reads as day first: such texts are not month-first dates, so walk on to one that is
            while new.day <= 12:
                day = new.toordinal()
                new = dt.date.fromordinal(_FIRST_DAY + f.permute("date", day - _FIRST_DAY, _LAST_DAY - _FIRST_DAY + 1))
        out = {"y": f"{new.year:04d}", "m": f"{new.month:02d}", "d": f"{new.day:02d}"}
        return sep.join(out[k] for k in order)
    return None


# Symbol classes of strings; other characters stay as they are.
_CLASSES = ("0123456789", "abcdefghijklmnopqrstuvwxyz", "ABCDEFGHIJKLMNOPQRSTUVWXYZ")
_CLASS_OF = {c: k for k, x in enumerate(_CLASSES) for c in x}


def permute_string(f: Feistel, kind: str, text: str) -> str:
    """Digits, small and capital letters permuted together, each within its class."""
    kinds = [_CLASS_OF.get(c) for c in text]
    value, size = 0, 1
    for c, k in zip(text, kinds):
        if k is not None:
            value, size = value * len(_CLASSES[k]) + _CLASSES[k].index(c), size * len(_CLASSES[k])
    shape = "".join("." if k is None else str(k) for k in kinds)
    value = f.permute(f"{kind}/{shape}", value, size)
    out = list(text)
    for at in range(len(text) - 1, -1, -1):
        if (k := kinds[at]) is not None:
            value, symbol = divmod(value, len(_CLASSES[k]))
            out[at] = _CLASSES[k][symbol]
    return "".join(out)


def email(f: Feistel, text: str) -> str | None:
    """Local part and every label of the domain but the last, each a string of its own."""
    local, _, domain = text.rpartition("@")
    *labels, last = domain.split(".")
    return permute_string(f, "local", local) + "@" + ".".join([permute_string(f, "label", x) for x in labels] + [last])


_HEX = re.compile(r"[0-9a-f]{16,}|[0-9A-F]{16,}")


def credential(f: Feistel, text: str) -> str | None:
    """Hexadecimal strings stay hexadecimal; others keep their symbol classes."""
    if not _HEX.fullmatch(text) or text.isdigit():
        return permute_string(f, "credential", text)
    size, value = 16 ** len(text), int(text, 16)
    while True:
        value = f.permute(f"hex{len(text)}", value, size)
        new = f"{value:0{len(text)}x}"
        if not new.isdigit():  # digits alone would be read as another kind: walk on
            return new.upper() if text.upper() == text else new


# Patterns in order of precedence; the group "v" (or the whole match) is the value.
KINDS: tuple[tuple[str, str, Callable[[Feistel, str], str | None]], ...] = (
    ("email", r"(?<![\w.+%-])[\w+%-][\w.+%-]*@(?:[A-Za-z0-9](?:[A-Za-z0-9-]*[A-Za-z0-9])?\.)+[A-Za-z]{2,}(?![\w-])", email),
    ("credential", r"(?i:\b(?:token|secret|password|passwd|pwd|api[_-]?key|access[_-]?key)[\"']?\s*[:=]\s*[\"']?)"
                   r"(?P<v_credential>[A-Za-z0-9+/_-]{8,})", credential),
    ("access key", r"(?<![A-Za-z0-9])(?:AKIA|ASIA)(?P<v_access_key>[A-Z0-9]{16})(?![A-Za-z0-9])", credential),
    ("iban", r"(?<!\w)[A-Z]{2}\d{2}(?: ?[A-Z0-9]{4}){2,7}(?: ?[A-Z0-9]{1,3})?(?!\w)", iban),
    ("ipv4", r"(?<![\w.])\d{1,3}(?:\.\d{1,3}){3}(?![\w]|\.\d)", address),
    ("date", r"(?<![\w/.-])(?:\d{4}([-/.])\d{2}\g<SEP>\d{2}|\d{2}([-/.])\d{2}\g<SEP2>\d{4})(?!(?!T\d)\w|[-/.]\d)", date),
    ("social", r"(?<![\w-])\d{3}-\d{2}-\d{4}(?!\w|-\d)", social),
    ("card", r"(?<![\w.+-])\d(?:[ -]?\d){12,18}(?!\w|[.-]\d)", card),
    ("phone", r"(?<![\w+(])(?:\+\d{1,3}[ .-]?)(?:\(\d{2,4}\)[ .-]?|\d{2,4}[ .-]?)\d{3,4}[ .-]?\d{3,4}(?!\w|[-.]\d)"
              r"|(?<![\w+(])\(\d{3}\)[ .-]?\d{3}[ .-]?\d{4}(?!\w|[-.]\d)"
              r"|(?<![\w+.-])\d{3}[.-]\d{3}[.-]\d{4}(?!\w|[-.]\d)", phone),
)


def _patterns() -> dict[str, str]:
    parts = {}
    for name, pattern, _ in KINDS:
        group = name.replace(" ", "_")
        pattern = pattern.replace(r"([-/.])\d{2}\g<SEP>", r"(?P<sep>[-/.])\d{2}(?P=sep)").replace(
            r"([-/.])\d{2}\g<SEP2>", r"(?P<sep2>[-/.])\d{2}(?P=sep2)")
        parts[group] = f"(?P<{group}>{pattern})"
    return parts


_FIND = re.compile("|".join(_patterns().values()))
_AT = {group: re.compile(pattern) for group, pattern in _patterns().items()}
_REST = re.compile("|".join(pattern for group, pattern in _patterns().items() if group != "card"))
_FORMATS = {name.replace(" ", "_"): make for name, _, make in KINDS}
# Every kind holds a digit, an at sign or an assignment; texts without any are left at once.
_ANY = re.compile(r"[0-9@=:]")


def _parts(kind: str, text: str, start: int, end: int) -> Iterator[tuple[int, int]]:
    """The spans of a match that may be the value, in order of precedence."""
    if kind == "iban":
        length = IBAN_LENGTHS.get(text[start:start + 2])
        for e in [end, *(k for k in range(end - 1, start, -1) if text[k] == " ")]:
            if length in (None, e - start - text.count(" ", start, e)):
                yield start, e
    elif kind == "card":
        yield start, end
        before = [0]  # digits before each character
        for k in range(start, end):
            before.append(before[-1] + text[k].isdigit())
        starts = [start, *(k + 1 for k in range(start, end) if text[k] == " ")]
        ends = [*(k for k in range(start, end) if not text[k].isdigit()), end]
        sized = [(before[a - start] - before[e - start], a, e) for a in starts if before[-1] - before[a - start] >= 13
                 for e in ends if before[e - start] - before[a - start] >= 13 and (a, e) != (start, end)]
        yield from ((a, e) for n, a, e in sorted(sized) if -n <= 19)
    else:
        yield start, end


def _value_at(f: Feistel, text: str, at: int) -> tuple[int, str, int, int, str] | None:
    """The first valid value of a match at ``at``: its place among the candidates, kind, start, end and pseudonym."""
    number = 0
    for kind, pattern in _AT.items():
        if m := pattern.match(text, at):
            for start, end in _parts(kind, text, *m.span(f"v_{kind}" if f"v_{kind}" in pattern.groupindex else kind)):
                if (new := _FORMATS[kind](f, text[start:end])) is not None:
                    return number, kind, start, end, new
                number += 1
    return None


_DIGIT_RUN = re.compile(r"\d(?:[ -]?\d)*")
# Characters from which a run of digits is long, and of a run that are looked at together.
_LONG_RUN = 64
_RUN_CHARS = 1 << 16


def _next_card(text: str, at: int) -> tuple[int, int]:
    """The first place from ``at`` on in its run of digits where a card match may hold a valid card, and the run's end.

    The check sums of all parts of 13 to 19 digits between separators come from running sums over the run, so that a
    long run without a card is passed once, not once per digit.
    """
    run = _DIGIT_RUN.match(text, at, at + _RUN_CHARS).group()
    end = at + len(run)
    chars = np.array([ord(c) for c in run])
    place = np.flatnonzero((chars != 32) & (chars != 45))
    digit = np.array([int(run[k]) for k in place])
    double = digit * 2 - 9 * (digit > 4)
    even = np.arange(len(place)) % 2 == 0
    sums = [np.concatenate(([0], np.cumsum(np.where(plain, digit, double)))) for plain in (~even, even)]
    starts = np.concatenate(([True], chars[place[1:] - 1] == 32))
    ends = np.concatenate((np.diff(place) > 1, [True]))
    first = len(place)
    for n in range(13, 20):
        if n <= len(place):
            last = np.arange(n - 1, len(place))
            total = np.where(last % 2 == 1, sums[0][n:] - sums[0][:-n], sums[1][n:] - sums[1][:-n])
            valid = np.flatnonzero(starts[:len(last)] & ends[n - 1:] & (total % 10 == 0))
            first = min([first, *valid[:1]])
    if first == len(place) and len(run) < _RUN_CHARS - 1:
        return end, end
    # a match has at most 19 digits, so one that holds the part starts at most 6 digits before it; a run that goes on
    # is looked at again from where its next part of 13 digits may start
    return at + int(place[max(0, min(first, len(place) - 20) - 6)]), end


# Pseudonyms that are tried where digits around a value form other numbers with them.
MOST_WALKS = 64
# Characters behind a match that may belong to a longer one at the same place.
_REACH = 64


def _search(text: str, at: int, no_card: int) -> re.Match | None:
    """The next match from ``at`` on; before ``no_card`` there is no card."""
    if at < no_card:
        m = _REST.search(text, at)
        if m is not None and m.start() < no_card:
            return m
        at = no_card
    return _FIND.search(text, at)


def _next_value(f: Feistel, text: str, at: int) -> tuple[str, int, int, str, int | None] | None:
    """Kind, start, end and pseudonym of the first value from ``at`` on, and where a match that failed reaches into it."""
    failed, reach, no_card = None, 0, 0
    while m := _search(text, at, no_card):
        found = _value_at(f, text, m.start())
        if failed is None or reach <= m.start():
            failed = m.start()
        if found is not None:
            number, kind, start, end, new = found
            return kind, start, end, new, failed if number or failed < m.start() else None
        reach = max(reach, m.end() + _REACH)
        if m.start() >= no_card and (run := _DIGIT_RUN.match(text, m.start(), m.start() + _LONG_RUN)) and (
                run.end() >= m.start() + _LONG_RUN - 1):
            no_card, end = _next_card(text, m.start())
            reach = max(reach, min(no_card + 40, end) + _REACH)
        at = m.start() + 1
        # no value here: look again behind its first run of word characters
        while at < m.end() and text[at].isalnum() and text[at - 1].isalnum():
            at += 1
    return None


def pseudonymise(text: str, f: Feistel) -> tuple[str, list[tuple[str, int, int]]]:
    """The text with pseudonyms, and the replaced spans (kind, start, length) in code points of the input."""
    if not _ANY.search(text):
        return text, []
    out, found, done = [], [], 0
    while value := _next_value(f, text, done):
        kind, start, end, new, failed = value
        if failed is not None:  # with some pseudonyms another value would be found here: walk on to one that is found
            low, high, first = max(done, failed - 2), end + 2 * _REACH, new
            for _ in range(MOST_WALKS):
                again = _next_value(f, text[low:start] + new + text[end:high], failed - low)
                if again is not None and again[:3] == (kind, start - low, end - low):
                    break
                new = _FORMATS[kind](f, new)
            else:  # among digits in which nearly every pseudonym forms other numbers: hidden, but the way back may differ
                new = first
        out += [text[done:start], new]
        found.append((kind, start, end - start))
        done = end
    return "".join(out) + text[done:], found


SPANS = "array<struct<kind:string,start:int,length:int>>"


def replace_private(docs: DataFrame, key: bytes, *, id_col: str = "doc_id", text_col: str = "text",
                    reverse: bool = False) -> DataFrame:
    """All columns of ``docs`` with pseudonyms in ``text_col``, and ``private``: the spans that were replaced.

    One pass without a shuffle. Null texts stay null with no spans, empty texts stay empty; repeated rows get equal
    results; a column named ``private`` is replaced. ``reverse=True`` with the same key restores the texts.
    """
    others = [c for c in docs.columns if c not in (text_col, "private")]
    rest = F.struct(*[F.col(f"`{c}`") for c in others]) if others else F.struct(F.lit(0).alias("x"))
    shaped = docs.select(F.col(f"`{text_col}`").cast("string").alias("text"), rest.alias("rest"))
    schema = StructType([*shaped.select("text", F.lit(None).cast(SPANS).alias("private"), "rest").schema])
    arrow_spans = pa.list_(pa.struct([("kind", pa.string()), ("start", pa.int32()), ("length", pa.int32())]))

    def run(batches: Iterator[pa.RecordBatch]) -> Iterator[pa.RecordBatch]:
        f = Feistel(key, reverse)
        for batch in small(batches):
            texts, spans = [], []
            for text in batch.column(0).to_pylist():
                new, found = (None, []) if text is None else pseudonymise(text, f)
                texts.append(new)
                spans.append([dict(zip(("kind", "start", "length"), x)) for x in found])
            yield out_batch(pa.schema([("text", pa.string()), ("private", arrow_spans),
                                       ("rest", batch.column(1).type)]), [texts, spans, batch.column(1)])

    done = shaped.mapInArrow(run, schema)
    order = [F.col("text").alias(c) if c == text_col else F.col(f"rest.`{c}`").alias(c)
             for c in docs.columns if c != "private"]
    return done.select(*order, "private")
