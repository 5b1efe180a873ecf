"""Personal data in texts, replaced by format-preserving pseudonyms.

Addresses, numbers and dates are found by pattern and validated (check digits, ranges,
calendar). A value's free part is read as a number below the count of valid values of
its format, permuted by a keyed Feistel network with cycle walking, and written back
in the same format with new check digits. The permutation depends on key, kind and
format only, so equal values get equal pseudonyms in all documents, different values
different ones, and ``restore=True`` with the same key brings the values back.

A number is looked for at every place outside the numbers accepted before it: one that
fails its validation is tried with shorter ends and as the other kinds, and then hides
nothing that starts inside it.

What is kept: separators, letter case by position, an address's last domain label, a
telephone number's country code, a card's first digit, an IBAN's country.

Results by case: a null text stays null and counts nothing; an empty text stays empty;
no rows give no rows; repeated rows are treated one by one; a null identifier is kept;
other columns are not read.
"""

from __future__ import annotations

import datetime
import hashlib
import re
from collections.abc import Callable, Iterator
from dataclasses import dataclass

import pyarrow as pa
from pyspark.sql import DataFrame, functions as F

ROUNDS = 8
KINDS = ("email", "ip", "iban", "ssn", "date", "phone", "card")

# The formats. A number never touches a letter or another digit.
_EDGE, _END = r"(?<![A-Za-z0-9])", r"(?![A-Za-z0-9])"
EMAIL = re.compile(r"[A-Za-z0-9][A-Za-z0-9._%+-]{0,127}@[A-Za-z0-9](?:[A-Za-z0-9-]{0,62})(?:\.[A-Za-z0-9](?:[A-Za-z0-9-]{0,62})){0,8}\.[A-Za-z]{2,24}(?![A-Za-z0-9])")
_KIND = {
    "iban": rf"{_EDGE}[A-Z]{{2}}[0-9]{{2}}(?: ?[A-Z0-9]{{4}}){{2,7}}(?: ?[A-Z0-9]{{1,3}})?{_END}",
    "ip": r"(?<![A-Za-z0-9.])[0-9]{1,3}(?:\.[0-9]{1,3}){3}(?!\.?[0-9])(?![A-Za-z])",
    "ssn": rf"{_EDGE}(?<![0-9]-)[0-9]{{3}}-[0-9]{{2}}-[0-9]{{4}}{_END}(?!-[0-9])",
    "date": rf"{_EDGE}(?<![0-9][-./])(?:[0-9]{{4}}-[0-9]{{2}}-[0-9]{{2}}|[0-9]{{2}}(?P<d>[./])[0-9]{{2}}(?P=d)[0-9]{{4}}){_END}(?![-/][0-9])",
    "phone": rf"(?<![A-Za-z0-9+])\+[0-9]{{1,3}}[ .-]?(?:\([0-9]{{1,4}}\)|[0-9]{{1,4}})(?:[ .-]?[0-9]{{2,4}}){{1,4}}{_END}"
    rf"|{_EDGE}\([0-9]{{3}}\) ?[0-9]{{3}}[ .-][0-9]{{4}}{_END}|{_EDGE}[0-9]{{3}}(?P<p>[.-])[0-9]{{3}}(?P=p)[0-9]{{4}}{_END}",
    "card": rf"{_EDGE}(?:[0-9]{{13,19}}|[0-9]{{4}}(?P<c>[ -])[0-9]{{4}}(?P=c)[0-9]{{4}}(?P=c)[0-9]{{1,7}}|3[0-9]{{3}}[ -][0-9]{{6}}[ -][0-9]{{5}}){_END}",
}
NUMBERS = re.compile("|".join(f"(?:{x})" for x in _KIND.values()))
_KIND = {k: re.compile(x) for k, x in _KIND.items()}
_REACH = 64  # no number is longer
# Lengths of the IBAN registry: at the end of an IBAN a word may follow that looks like a part of it.
_IBAN_LENGTH = {
    x[:2]: int(x[2:]) for x in """
    AD24 AE23 AL28 AT20 AZ28 BA20 BE16 BG22 BH22 BR29 BY28 CH21 CR22 CY28 CZ24 DE22 DK18 DO28 EE20 EG29 ES24 FI18 FO18 FR27 GB22 GE22 GI23
    GL18 GR27 GT28 HR21 HU28 IE22 IL23 IQ23 IS26 IT27 JO30 KW30 KZ20 LB28 LC32 LI21 LT20 LU20 LV21 MC27 MD24 ME22 MK19 MR27 MT31 MU30 NL18
    NO15 PK24 PL28 PS29 PT25 QA29 RO24 RS22 SA24 SC31 SE24 SI19 SK24 SM27 ST25 SV28 TL23 TN24 TR26 UA29 VA22 VG24 XK20
    """.split()
}
_DIGIT = re.compile("[0-9]")
_LETTER_OR_DIGIT = re.compile("[A-Za-z0-9]")

_FIRST_DAY, _LAST_DAY = datetime.date(1900, 1, 1).toordinal(), datetime.date(2099, 12, 31).toordinal()


@dataclass(frozen=True)
class Feistel:
    """Keyed permutation of the numbers below any size."""

    key: bytes
    restore: bool = False

    def _round(self, tweak: bytes, k: int, half: int, bits: int) -> int:
        data = b"%d|%s|%x" % (k, tweak, half)
        size = (bits + 7) // 8
        if size <= 64:
            raw = hashlib.blake2b(data, key=self.key[:64], digest_size=size).digest()
        else:
            raw = hashlib.shake_256(self.key + b"|" + data).digest(size)
        return int.from_bytes(raw, "big") & ((1 << bits) - 1)

    def __call__(self, value: int, size: int, tweak: bytes) -> int:
        """Image of ``value``; walks on until it is below ``size`` (four steps at most on average)."""
        if size < 2:
            return value
        bits = max(1, ((size - 1).bit_length() + 1) // 2)
        mask = (1 << bits) - 1
        while True:
            left, right = value >> bits, value & mask
            if self.restore:
                for k in reversed(range(ROUNDS)):
                    left, right = right ^ self._round(tweak, k, left, bits), left
            else:
                for k in range(ROUNDS):
                    left, right = right, left ^ self._round(tweak, k, right, bits)
            value = left << bits | right
            if value < size:
                return value


def _permute_classes(text: str, tweak: str, f: Feistel) -> str:
    """Letters and digits of a text permuted together; each stays a letter of its case or a digit, the rest stays."""
    value, size, shape = 0, 1, []
    for c in text:
        base = 26 if c.isalpha() else 10 if c.isdigit() else 1
        digit = ord(c.lower()) - 97 if base == 26 else int(c) if base == 10 else 0
        value, size = value * base + digit, size * base
        shape.append("A" if base == 26 else "0" if base == 10 else c)
    value = f(value, size, f"{tweak}|{''.join(shape)}".encode())
    out = []
    for c in reversed(text):
        base = 26 if c.isalpha() else 10 if c.isdigit() else 1
        value, digit = divmod(value, base)
        out.append((chr(97 + digit).upper() if c.isupper() else chr(97 + digit)) if base == 26 else str(digit) if base == 10 else c)
    return "".join(reversed(out))


def _email(s: str, f: Feistel) -> str:
    local, domain = s.rsplit("@", 1)
    labels, last = domain.rsplit(".", 1)
    return f"{_permute_classes(local, 'local', f)}@{_permute_classes(labels, 'domain', f)}.{last}"


def _ip(s: str, f: Feistel) -> str | None:
    octets = [int(x) for x in s.split(".")]
    if max(octets) > 255:
        return None
    value = f(int.from_bytes(bytes(octets), "big"), 1 << 32, b"ip")
    return ".".join(map(str, value.to_bytes(4, "big")))


def _refill(shape: str, digits: str) -> str:
    """The digits put in the places of the digits of ``shape``."""
    source = iter(digits)
    return "".join(next(source) if c.isdigit() else c for c in shape)


def luhn_digit(digits: str) -> str:
    """Check digit to append to a card number's other digits."""
    total = sum(sum(divmod(int(c) * (2 - k % 2), 10)) for k, c in enumerate(reversed(digits)))
    return str(-total % 10)


def _card(s: str, f: Feistel) -> str | None:
    digits = "".join(c for c in s if c.isdigit())
    if luhn_digit(digits[:-1]) != digits[-1] or not 13 <= len(digits) <= 19 or len(set(digits)) == 1:
        return None
    free = digits[1:-1]
    new = digits[0] + str(f(int(free), 10 ** len(free), b"card%d" % len(digits))).zfill(len(free))
    return _refill(s, new + luhn_digit(new))


def _ssn(s: str, f: Feistel) -> str | None:
    area, group, serial = map(int, s.split("-"))
    if area in (0, 666) or area >= 900 or not group or not serial:
        return None
    place = area - 1 - (area > 666)  # 898 areas
    value = f((place * 99 + group - 1) * 9999 + serial - 1, 898 * 99 * 9999, b"ssn")
    value, serial = divmod(value, 9999)
    place, group = divmod(value, 99)
    return f"{place + 1 + (place >= 665):03d}-{group + 1:02d}-{serial + 1:04d}"


def _date(s: str, f: Feistel) -> str | None:
    iso = "-" in s
    a, b, c = (int(x) for x in re.split("[-./]", s))
    month_first = not iso and "/" in s and b > 12  # 05/31/1990
    try:
        day = datetime.date(a, b, c) if iso else datetime.date(c, a, b) if month_first else datetime.date(c, b, a)
    except ValueError:
        return None
    low, high = (_FIRST_DAY, _LAST_DAY) if _FIRST_DAY <= day.toordinal() <= _LAST_DAY else (1, datetime.date.max.toordinal())
    # dates written month first keep a day above 12, so that they are read alike again
    at, size = day.toordinal() - low, high - low + 1
    while True:
        at = f(at, size, b"date")
        new = datetime.date.fromordinal(low + at)
        inside = low > 1 or not _FIRST_DAY <= new.toordinal() <= _LAST_DAY
        if inside and (not month_first or new.day > 12):
            break
    sep = next(x for x in s if not x.isdigit())
    parts = (f"{new.year:04d}", f"{new.month:02d}", f"{new.day:02d}") if iso else ((f"{new.month:02d}", f"{new.day:02d}") if month_first else (f"{new.day:02d}", f"{new.month:02d}")) + (f"{new.year:04d}",)
    return sep.join(parts)


def _phone(s: str, f: Feistel) -> str | None:
    digits = "".join(c for c in s if c.isdigit())
    if not 7 <= len(digits) <= 15:
        return None
    head = re.match(r"\+([0-9]{1,3})(?=[ .(-])", s)
    code = (head[1] if head else digits[:2]) if s.startswith("+") else ""
    own = digits[len(code):]
    if code in ("", "1") and len(own) == 10:  # valid area and exchange codes start with 2 to 9
        if own[0] < "2" or own[3] < "2":
            if code == "" and "(" not in s:
                return None
            new = str(f(int(own), 10**10, b"phone-odd")).zfill(10)
            while new[0] >= "2" and new[3] >= "2":  # an odd number stays odd, so that it is told apart
                new = str(f(int(new), 10**10, b"phone-odd")).zfill(10)
            return _refill(s, code + new)
        value = ((int(own[0]) - 2) * 100 + int(own[1:3])) * 800 + (int(own[3]) - 2) * 100 + int(own[4:6])
        value = f(value * 10_000 + int(own[6:]), 800 * 800 * 10_000, b"phone")
        value, line = divmod(value, 10_000)
        area, exchange = divmod(value, 800)
        return _refill(s, f"{code}{area + 200:03d}{exchange + 200:03d}{line:04d}")
    if len(own) < 5:
        return None
    return _refill(s, code + str(f(int(own), 10 ** len(own), f"phone{code}|{len(own)}".encode())).zfill(len(own)))


def _iban_check(country: str, account: str) -> str:
    number = int("".join(str(int(c, 36)) for c in f"{account}{country}00"))
    return f"{98 - number % 97:02d}"


def _iban(s: str, f: Feistel) -> str | None:
    flat = s.replace(" ", "")
    country, check, account = flat[:2], flat[2:4], flat[4:]
    if not 15 <= len(flat) <= 34 or _iban_check(country, account) != check:
        return None
    new = _permute_classes(account, f"iban{country}", f)
    source = iter(country + _iban_check(country, new) + new)
    return "".join(c if c == " " else next(source) for c in s)


_REWRITE: dict[str, Callable[[str, Feistel], str | None]] = {"ip": _ip, "iban": _iban, "ssn": _ssn, "date": _date, "phone": _phone, "card": _card}


def _ends(kind: str, text: str, start: int) -> list[int]:
    """Ends that a number of a kind may have, the most likely first; IBANs and international telephone numbers may have several.

    The order for telephone numbers is: ten digits after +1; then the longest that holds
    no other number; then the longest that holds others whole. One that would cut another
    number is no telephone number. Other numbers count by their shape, as a pseudonym
    keeps it; groups of four digits only where they are a card number.
    """
    m = _KIND[kind].match(text, start)
    if not m:
        return []
    if kind != "iban" and text[start] != "+":
        return [m.end()]
    ends = [m.end()] + [e for e in range(m.end() - 1, start, -1) if not _LETTER_OR_DIGIT.match(text, e) and _KIND[kind].fullmatch(text, start, e)]
    if kind == "iban":
        return sorted(ends, key=lambda e: len(text[start:e].replace(" ", "")) != _IBAN_LENGTH.get(text[start:start + 2]))
    at = [i for i in range(start + 1, m.end()) if text[i - 1] == " "]
    others = [(i, o.end()) for i in at for k in ("ip", "ssn", "date", "phone") if (o := _KIND[k].match(text, i))]
    cards = [(i, o.end()) for i in at if (o := _KIND["card"].match(text, i)) and _card(o[0], _SAME)]
    others += cards[-1:]  # four groups that end inside the last card are so by chance
    ends = [e for e in ends if not any(i < e < end for i, end in others)]
    ten = text.startswith(("+1 ", "+1.", "+1-", "+1("), start)
    return sorted(ends, key=lambda e: (not (ten and len(_DIGIT.findall(text, start, e)) == 11), any(i < e for i, _ in others)))


def _find(text: str, at: int) -> tuple[int, int, str] | None:
    """(start, end, kind) of the first valid number that starts at ``at`` or later."""
    while m := NUMBERS.search(text, at):
        for kind in _KIND:
            for end in _ends(kind, text, m.start()):
                if _REWRITE[kind](text[m.start():end], _SAME) is not None:
                    return m.start(), end, kind
        at = m.start() + 1  # a valid number may start inside an invalid one
    return None


def _SAME(value: int, size: int, tweak: bytes) -> int:
    return value


def pseudonymise(text: str, f: Feistel) -> tuple[str, dict[str, int]]:
    """A text with its personal data replaced, and the replacements by kind."""
    counts = dict.fromkeys(KINDS, 0)

    def email(m: re.Match) -> str:
        counts["email"] += 1
        return _email(m[0], f)

    def numbers(part: str) -> str:
        if not _DIGIT.search(part):
            return part
        out, at = [], 0
        last = None  # the number before, as written
        while found := _find(part, at):
            start, end, kind = found
            if last and start - at < _REACH:
                left, place, known = last[0] + part[at:start], 0, [last]
            else:
                left, known = part[max(0, start - 2 * _REACH):start], []
                place = len(left) - min(start - at, _REACH)

            def fits(new: str) -> bool:
                near, p = left + new + part[end:end + _REACH], place
                for number in [*known, (new, kind)]:
                    got = _find(near, p)
                    if got is None or (near[got[0]:got[1]], got[2]) != number:
                        return False
                    p = got[1]
                return True

            # walk on where the numbers would not be found at their places, so that they can be restored
            walk = fits(part[start:end])
            new = _REWRITE[kind](part[start:end], f)
            while walk and not fits(new):
                new = _REWRITE[kind](new, f)
            counts[kind] += 1
            out += [part[at:start], new]
            at, last = end, (new, kind)
        out.append(part[at:])
        return "".join(out)

    if "@" not in text:
        return numbers(text), counts
    out, at = [], 0
    for m in EMAIL.finditer(text):
        out += [numbers(text[at:m.start()]), email(m)]
        at = m.end()
    out.append(numbers(text[at:]))
    return "".join(out), counts


def pseudonyms(docs: DataFrame, key: bytes, id_col: str = "doc_id", text_col: str = "text", restore: bool = False) -> DataFrame:
    """One row per row of ``docs``: id, text with pseudonyms, and the number of replaced values by kind."""

    def run(batches: Iterator[pa.RecordBatch]) -> Iterator[pa.RecordBatch]:
        f = Feistel(key, restore)
        for b in batches:
            done = [(None, dict.fromkeys(KINDS, 0)) if t is None else pseudonymise(t, f) for t in b.column(1).to_pylist()]
            yield pa.RecordBatch.from_arrays(
                [b.column(0), pa.array([t for t, _ in done], pa.string()), *(pa.array([c[k] for _, c in done], pa.int64()) for k in KINDS)],
                names=["id", "text", *(f"n_{k}" for k in KINDS)],
            )

    rows = docs.select(F.col(id_col).cast("long").alias("id"), F.col(text_col).cast("string").alias("text"))
    return rows.mapInArrow(run, "id long, text string, " + ", ".join(f"n_{k} long" for k in KINDS))
