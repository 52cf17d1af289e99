"""Format-preserving pseudonyms for personal data.

Values are found by pattern and then validated: card numbers by issuer prefix
with its lengths, grouping and check digit, account numbers by their country's
length and remainder, addresses by their octets, dates by the calendar, social
security numbers by their reserved ranges.  A value that validates is permuted
within its format by a keyed Feistel network, check digits are set anew,
separators and letter case stay: the pseudonym has the same form and length,
and equal values get equal pseudonyms in all documents, a day in all its
notations.  The holder of the key can invert it (``reveal=True``): issuer,
country and grouping stay, so a pseudonym is found where its value was.
Card-like numbers that fail their check stay as they are.

Numbers may stand beside others.  A card is a group of digits without blanks,
or groups as cards print them (4-4-4-4, 4-6-5, 4-6-4) under one separator; more
than four groups of four are cards only if they are as a whole, one card after
the other, as rows of numbers are not.  Of account numbers that overlap, the
one that starts last counts.

Cases: NULL text stays NULL with no spans, an empty text stays empty; other
columns pass through, one named like the spans is replaced; rows that repeat
are treated alike; an empty table gives an empty one.
"""

from __future__ import annotations

import datetime as dt
import functools
import hashlib
import math
import re
from bisect import bisect_left
from collections.abc import Callable, Iterator

import pyarrow as pa
from pyspark.sql import DataFrame
from pyspark.sql import functions as F
from pyspark.sql.functions import arrow_udf

from regiocast.llm.common import small_batches

ROUNDS = 10
#: Dates are permuted among the days of these years.
FIRST_DAY, LAST_DAY = dt.date(1900, 1, 1), dt.date(2099, 12, 31)

_LOWER, _UPPER, _DIGITS, _HEX = "abcdefghijklmnopqrstuvwxyz", "ABCDEFGHIJKLMNOPQRSTUVWXYZ", "0123456789", "0123456789abcdef"


class Feistel:
    """Keyed permutation of the integers below n: alternating Feistel network on a grid, walked until below n."""

    def __init__(self, key: bytes):
        self.key = hashlib.sha256(key).digest()

    def _round(self, label: str, n: int, j: int, half: int, modulus: int) -> int:
        message = f"{label}|{n}|{j}|{half}".encode()
        out = hashlib.blake2b(message, key=self.key, digest_size=64).digest()
        return int.from_bytes(out, "big") % modulus

    def permute(self, label: str, n: int, x: int, back: bool = False) -> int:
        if n < 2:
            return x
        a = math.isqrt(n - 1) + 1
        b = -(-n // a)
        while True:
            left, right = divmod(x, b)
            for j in reversed(range(ROUNDS)) if back else range(ROUNDS):
                sign = -1 if back else 1
                if j % 2 == 0:
                    left = (left + sign * self._round(label, n, j, right, a)) % a
                else:
                    right = (right + sign * self._round(label, n, j, left, b)) % b
            x = left * b + right
            if x < n:
                return x

    def symbols(self, label: str, value: str, alphabets: list[str], back: bool = False) -> str:
        """Permutes a string whose characters each come from their own alphabet."""
        n, x = 1, 0
        for c, alphabet in zip(value, alphabets, strict=True):
            n, x = n * len(alphabet), x * len(alphabet) + alphabet.index(c)
        x, out = self.permute(label, n, x, back), []
        for alphabet in reversed(alphabets):
            x, k = divmod(x, len(alphabet))
            out.append(alphabet[k])
        return "".join(reversed(out))


def _fill(shape: str, symbols: str, accept: Callable[[str], bool] = str.isalnum) -> str:
    """``shape`` with its accepted characters replaced in turn, upper case where it was."""
    source = iter(symbols)
    return "".join((next(source).upper() if c.isupper() else next(source)) if accept(c) else c for c in shape)


def luhn_digit(payload: str) -> str:
    total = 0
    for j, c in enumerate(reversed(payload)):
        d = int(c) * (2 if j % 2 == 0 else 1)
        total += d - 9 if d > 9 else d
    return str(-total % 10)


#: Digits that card numbers of the issuers' networks start with, and their lengths.
ISSUERS = {
    "4": (13, 16, 19),
    **{str(n): (16,) for n in (*range(51, 56), *range(2221, 2721))},
    **{str(n): (15,) for n in (34, 37)},
    **{str(n): (14,) for n in (*range(300, 306), 36, 38, 39)},
    **{str(n): (16, 17, 18, 19) for n in (6011, *range(644, 650), 65, 62, *range(3528, 3590), *range(2200, 2205))},
    **{str(n): tuple(range(13, 20)) for n in (50, 56, 57, 58, 6304, 6759, 6761, 6762, 6763)},
}


def _issuer(digits: str) -> str | None:
    """The issuer's prefix of a valid card number."""
    prefix = next((digits[:n] for n in range(1, 5) if digits[:n] in ISSUERS), None)
    return prefix if prefix and len(digits) in ISSUERS[prefix] and luhn_digit(digits[:-1]) == digits[-1] else None


def _card(f: Feistel, value: str, back: bool) -> str:
    """Of a valid card number; the issuer's prefix stays."""
    digits = re.sub(r"\D", "", value)
    prefix = _issuer(digits)
    rest = digits[len(prefix) : -1]
    payload = prefix + f.symbols(f"card{prefix}", rest, [_DIGITS] * len(rest), back)
    return _fill(value, payload + luhn_digit(payload))


def _iban_check(country: str, account: str) -> str:
    return f"{98 - int(''.join(str(int(c, 36)) for c in account + country + '00')) % 97:02d}"


def _iban(f: Feistel, value: str, back: bool) -> str:
    """Of a valid account number; the country stays."""
    plain = value.replace(" ", "")
    account = f.symbols("iban" + plain[:2], plain[4:], [_DIGITS if c.isdigit() else _UPPER for c in plain[4:]], back)
    return _fill(value, plain[:2] + _iban_check(plain[:2], account) + account)


def _ip(f: Feistel, value: str, back: bool) -> str | None:
    octets = [int(x) for x in value.split(".")]
    if max(octets) > 255 or any(len(x) > 1 and x[0] == "0" for x in value.split(".")):
        return None
    y = f.permute("ip", 1 << 32, int.from_bytes(bytes(octets), "big"), back)
    return ".".join(str(x) for x in y.to_bytes(4, "big"))


def _ssn(f: Feistel, value: str, back: bool) -> str | None:
    def number(digits: str) -> int | None:
        area, group, serial = int(digits[:3]), int(digits[3:5]), int(digits[5:])
        if not 1 <= area <= 899 or area == 666 or not group or not serial:
            return None
        return ((area - 1 - (area > 666)) * 99 + group - 1) * 9999 + serial - 1

    if (x := number(value.replace("-", ""))) is None:
        return None
    rest, serial = divmod(f.permute("ssn", 898 * 99 * 9999, x, back), 9999)
    area, group = divmod(rest, 99)
    return f"{area + 1 + (area + 1 >= 666):03d}-{group + 1:02d}-{serial + 1:04d}"


@functools.cache
def _days(late: bool) -> list[int]:
    """Days of the month up to the twelfth, or ``late`` ones, which the month-first form can write."""
    return [d for d in range(FIRST_DAY.toordinal(), LAST_DAY.toordinal() + 1) if (dt.date.fromordinal(d).day > 12) == late]


def _date(f: Feistel, value: str, back: bool) -> str | None:
    """Year first, or day and month in the order that the value itself allows (day first if both do).

    A day after the twelfth stays one, in all notations by one permutation, so
    a month-first date can be written that way and is linked to the others.
    """
    parts, mark = re.split(r"[-/.]", value), re.search(r"[-/.]", value)[0]
    order = "ymd" if len(parts[0]) == 4 else "mdy" if int(parts[1]) > 12 else "dmy"
    field = dict(zip(order, map(int, parts), strict=True))
    try:
        day = dt.date(field["y"], field["m"], field["d"])
    except ValueError:
        return None
    if not FIRST_DAY <= day <= LAST_DAY:
        return None
    days = _days(day.day > 12)
    new = dt.date.fromordinal(days[f.permute(f"date{day.day > 12}", len(days), bisect_left(days, day.toordinal()), back)])
    text = {"y": f"{new.year:04d}", "m": f"{new.month:02d}", "d": f"{new.day:02d}"}
    return mark.join(text[c] for c in order)


def _phone(f: Feistel, value: str, back: bool) -> str | None:
    """The country code stays; the national number is permuted digit for digit."""
    code = re.match(r"\+\d{1,3}(?=\D)", value)
    head = code[0] if code else ""
    digits = re.sub(r"\D", "", value[len(head) :])
    if not 7 <= len(digits) <= 12:
        return None
    return head + _fill(value[len(head) :], f.symbols("phone", digits, [_DIGITS] * len(digits), back))


def _email(f: Feistel, value: str, back: bool) -> str | None:
    head, dot, top = value.rpartition(".")
    accept = lambda c: c.isascii() and c.isalnum()
    plain = [c for c in head.lower() if accept(c)]
    return _fill(head, f.symbols("email", "".join(plain), [_DIGITS if c.isdigit() else _LOWER for c in plain], back), accept) + dot + top


def _secret(f: Feistel, value: str, back: bool) -> str | None:
    """Access keys and hexadecimal tokens; the prefix that names the kind of key stays."""
    if value[:4] in ("AKIA", "ASIA"):
        return value[:4] + f.symbols("key", value[4:], [_UPPER + _DIGITS] * len(value[4:]), back)
    if value[:4] in ("ghp_", "gho_", "ghs_") or value[:3] == "sk-":
        at = 4 if value[3] == "_" else 3
        return value[:at] + f.symbols("key", value[at:], [_UPPER + _LOWER + _DIGITS + "_-"] * len(value[at:]), back)
    if not (value.islower() or value.isupper()) or not any(c.isdigit() for c in value):
        return None
    out = f.symbols("hex", value.lower(), [_HEX] * len(value), back)
    return out.upper() if value.isupper() else out


#: Length of an account number by country (public registry).
IBAN_LENGTHS = {
    country: int(n)
    for n, countries in (
        part.split(":")
        for part in (
            "15:NO 16:BE 18:DK,FI,FK,FO,GL,NL,SD 19:MK,SI 20:AT,BA,EE,KZ,LT,LU,MN,XK 21:CH,CR,HR,LI,LV 22:BG,BH,DE,GB,GE,IE,ME,RS,VA 23:AE,GI,IL,IQ,OM,SO,TL "
            "24:AD,CZ,DZ,ES,MD,PK,RO,SA,SE,SK,TN,VG 25:LY,PT,ST 26:IS,TR 27:BI,DJ,FR,GR,IT,MC,MR,SM 28:AL,AZ,BY,CY,DO,GT,HU,LB,NI,PL,SV 29:BR,EG,PS,QA,UA 30:JO,KW,MU,YE 31:MT,SC 32:LC 33:RU"
        ).split()
    )
    for country in countries.split(",")
}
_RUN = re.compile(r"\d+(?:[ -]\d+)*", re.ASCII)
_DIGIT_GROUP = re.compile(r"\d+", re.ASCII)
_BEFORE, _BEHIND = re.compile(r"[\w.-]", re.ASCII), re.compile(r"[\w-]|\.\d", re.ASCII)
_IBAN_START = re.compile(r"(?<![A-Za-z0-9])([A-Z]{2})\d{2}(?= ?[A-Z0-9])", re.ASCII)
_IBAN_FORMS = {n: re.compile(rf"[A-Z]{{2}}\d{{2}}(?: ?[A-Z0-9]){{{n - 4}}}(?![A-Za-z0-9])", re.ASCII) for n in set(IBAN_LENGTHS.values())}


def _card_places(run: str, first: int, last: int) -> Iterator[tuple[int, int]]:
    """Places of the cards among the groups of a run of digits; whether one is there depends on no other's digits."""
    groups = [m.span() for m in _DIGIT_GROUP.finditer(run)][first : last or None]
    sizes = [b - a for a, b in groups]

    def valid(i: int, j: int) -> bool:
        place = run[groups[i][0] : groups[j - 1][1]]
        return not (" " in place and "-" in place) and _issuer(re.sub(r"\D", "", place)) is not None

    i = 0
    while i < len(groups):
        end = i + 1
        if sizes[i] == 4:
            mark = run[groups[i][1]] if i + 1 < len(groups) else ""
            while end < len(groups) and sizes[end] == 4 and run[groups[end][0] - 1] == mark:
                end += 1
            if (end - i) % 4 == 0 and all(valid(k, k + 4) for k in range(i, end, 4)):
                yield from ((groups[k][0], groups[k + 3][1]) for k in range(i, end, 4))
                i = end
                continue
            if end == i + 1 and sizes[i + 1 : i + 3] in ([6, 5], [6, 4]) and valid(i, i + 3):
                end = i + 3
                yield groups[i][0], groups[end - 1][1]
        elif 13 <= sizes[i] <= 19 and valid(i, end):
            yield groups[i]
        i = end


def _cards(f: Feistel, line: str, back: bool) -> list[tuple[int, int, str]]:
    out = []
    for m in _RUN.finditer(line):
        if m.end() - m.start() < 13:
            continue
        # a group that goes on as a word or a number with a point is none
        first = int(m.start() > 0 and _BEFORE.match(line, m.start() - 1) is not None)
        last = -int(_BEHIND.match(line, m.end()) is not None)
        out += [(m.start() + a, m.start() + b, _card(f, m[0][a:b], back)) for a, b in _card_places(m[0], first, last)]
    return out


def _iban_places(line: str) -> list[tuple[int, int]]:
    """Places of the account numbers: of those that overlap the one that starts last, but none within another."""
    valid = []
    for m in _IBAN_START.finditer(line):
        n = IBAN_LENGTHS.get(m[1])
        whole = _IBAN_FORMS[n].match(line, m.start()) if n else None
        plain = whole[0].replace(" ", "") if whole else ""
        if plain and _iban_check(plain[:2], plain[4:]) == plain[2:4]:
            valid.append(whole.span())
    out, reach = [], -1
    for a, b in valid:  # by start
        if b <= reach:
            continue  # within an earlier one
        while out and out[-1][1] > a:
            out.pop()
        out.append((a, b))
        reach = b
    return out


def _ibans(f: Feistel, line: str, back: bool) -> list[tuple[int, int, str]]:
    places = _iban_places(line)
    if not places:
        return []
    while True:
        found = [(a, b, _iban(f, line[a:b], back)) for a, b in places]
        line = _replaced(line, found)
        # an invalid form around a valid one could become valid with it (one in 97 of such forms): once more
        if _iban_places(line) == places:
            return found


def _replaced(line: str, found: list[tuple[int, int, str]]) -> str:
    parts, last = [], 0
    for a, b, new in found:
        parts += [line[last:a], new]
        last = b
    return "".join([*parts, line[last:]])


#: Fixed patterns, tried in this order at each place; what fails its validation is left to the next kind.  Without a pattern, a search of the line.
KINDS: list[tuple[str, str | None, Callable]] = [
    ("email", r"(?<![\w.%+-])[A-Za-z0-9][A-Za-z0-9._%+-]*@(?:[A-Za-z0-9-]+\.)+[A-Za-z]{2,}", _email),
    ("secret", r"(?<![A-Za-z0-9])(?:(?:AKIA|ASIA)[A-Z0-9]{16}|gh[pos]_[A-Za-z0-9]{36}|sk-[A-Za-z0-9_-]{20,}|[0-9a-f]{64}|[0-9a-f]{40}|[0-9a-f]{32}|[0-9A-F]{64}|[0-9A-F]{40}|[0-9A-F]{32})(?![A-Za-z0-9])", _secret),
    ("iban", None, _ibans),
    ("ip", r"(?<![\w.])\d{1,3}\.\d{1,3}\.\d{1,3}\.\d{1,3}(?![\w]|\.\d)", _ip),
    ("date", r"(?<![\w./-])(?:\d{4}-\d{2}-\d{2}|\d{4}/\d{2}/\d{2}|\d{2}/\d{2}/\d{4}|\d{2}\.\d{2}\.\d{4}|\d{2}-\d{2}-\d{4})(?![\w/-]|\.\d)", _date),
    ("ssn", r"(?<![\w-])\d{3}-\d{2}-\d{4}(?![\w-])", _ssn),
    ("phone", r"(?<![\w+])(?:\+\d{1,3}[ .-]?(?:\(\d{2,4}\)|\d{2,4})[ .-]?\d{3,4}[ .-]?\d{3,4}|\(\d{3}\)[ .-]?\d{3}[ .-]\d{4}|\d{3}[.-]\d{3}[.-]\d{4})(?![\w-])", _phone),
    ("card", None, _cards),
]
_ANY = [(kind, pattern and re.compile(pattern, re.ASCII), permute) for kind, pattern, permute in KINDS]
_SIGN = re.compile(r"[0-9@]")
_KEY_SIGN = re.compile(r"AKIA|ASIA|gh[pos]_|sk-")


def pseudonymise(text: str, feistel: Feistel, back: bool = False) -> tuple[str, list[tuple[str, int, int]]]:
    """The text with its values permuted, and (kind, start, end) of each in the new text."""
    if not (_SIGN.search(text) or _KEY_SIGN.search(text)):
        return text, []
    out, spans, at = [], [], 0
    for line in text.splitlines(keepends=True):
        if _SIGN.search(line) or _KEY_SIGN.search(line):
            found: list[tuple[int, int, str, str]] = []
            taken = bytearray(len(line))  # what is found is no part of another value
            for kind, pattern, permute in _ANY:
                if pattern is None:
                    rest = _replaced(line, [(a, b, "x" * (b - a)) for a, b, _, _ in sorted(found)]) if found else line
                    new = [(a, b, kind, value) for a, b, value in permute(feistel, rest, back)]
                else:
                    new = []
                    for m in pattern.finditer(line):
                        if taken.find(1, m.start(), m.end()) < 0 and (value := permute(feistel, m[0], back)) is not None:
                            new.append((m.start(), m.end(), kind, value))
                for a, b, _, _ in new:
                    taken[a:b] = b"\1" * (b - a)
                found += new
            parts, last, begin = [], 0, at
            for start, end, kind, new in sorted(found):
                begin += start - last
                spans.append((kind, begin, begin + len(new)))
                parts += [line[last:start], new]
                begin += len(new)
                last = end
            line = "".join(parts) + line[last:]
        out.append(line)
        at += len(line)
    return "".join(out), spans


SPANS = "array<struct<kind:string,start:int,end:int>>"
_SPAN_TYPE = pa.list_(pa.struct([("kind", pa.string()), ("start", pa.int32()), ("end", pa.int32())]))


def protect(docs: DataFrame, key: bytes, text_col: str = "text", spans_col: str = "pii", reveal: bool = False) -> DataFrame:
    """``docs`` with pseudonyms in ``text_col`` and their places in ``spans_col``; ``reveal`` inverts it."""
    small_batches(docs.sparkSession)

    @arrow_udf(f"struct<t:string,s:{SPANS}>")
    def replace(batches: Iterator[pa.Array]) -> Iterator[pa.Array]:
        feistel = Feistel(key)
        for batch in batches:
            pairs = [(None, []) if v is None else pseudonymise(v, feistel, reveal) for v in batch.to_pylist()]
            texts = pa.array([p[0] for p in pairs], pa.string())
            spans = pa.array([[{"kind": k, "start": a, "end": b} for k, a, b in p[1]] for p in pairs], _SPAN_TYPE)
            yield pa.StructArray.from_arrays([texts, spans], names=["t", "s"])

    columns = [F.col("__llm_new.t").alias(c) if c == text_col else F.col(f"`{c}`") for c in docs.columns if c != spans_col]
    return docs.withColumn("__llm_new", replace(F.col(text_col))).select(*columns, F.col("__llm_new.s").alias(spans_col))
