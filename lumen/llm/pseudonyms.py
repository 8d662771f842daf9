"""Format-preserving pseudonyms for personal data.

Validated values are permuted within their format by a keyed Feistel network,
so the same value has the same pseudonym in every document and table that uses
the key, and the pseudonym is again a valid value of the kind:

* ``card``   13 to 19 digits with a right Luhn digit: all digits but the check
             digit are permuted, the check digit is set anew
* ``iban``   country letters stay, the letters and digits of the account are
             permuted, class by class, and the check digits set anew
* ``ssn``    AAA-GG-SSSS with an issued area: permuted among issued numbers
* ``phone``  +C (AAA) BBB-DDDD and similar: the national digits are permuted, the
             calling code stays, however the number is spaced
* ``ip``     four octets: permuted among all addresses (not after "version" or "v")
* ``date``   valid calendar dates from 1900 to 2099 (Y-m-d, d.m.Y, d/m/Y or
             m/d/Y): permuted among those days, written in the same format
* ``email``  letters and digits of the part before the @ are permuted, class by
             class; the domain stays

A number that fails its check (Luhn digit, mod 97, calendar, octets) stays.

Values beside other numbers.  An IBAN ends at its country's length (for countries
without one here at any length that passes, with digits alone), a +1 number after
ten national digits, other phone numbers at the longest end with at most 13 that
does not cut into a date, SSN or address.  Cards are sought after all other kinds,
in runs of digit groups, at group borders: first the usual groupings, then others
of up to ``CARD_GROUPS`` groups (without groups of one or two digits if possible),
then the longest start of what is left.

The permutation of 0..N-1 is a balanced Feistel network of eight rounds over the
next power of four with BLAKE2b round functions keyed by the secret and the
kind, walked until the value is below N.

Defined results: null text is empty; matches of one rule are leftmost and no two
overlap; repeated rows give repeated results; an empty table gives an empty result;
extra columns are ignored.
"""

from __future__ import annotations

import datetime as dt
import hashlib
import re
from bisect import bisect_left, bisect_right
from itertools import takewhile

from pyspark.sql import DataFrame
from pyspark.sql import functions as F

from lumen.llm.common import arrow_map, schema_of, texts_of

KINDS = ("card", "iban", "ssn", "phone", "ip", "date", "email")
ROUNDS = 8
FIRST_DAY, LAST_DAY = dt.date(1900, 1, 1), dt.date(2099, 12, 31)

NUMERIC = re.compile(
    r"(?P<iban>(?<![A-Za-z0-9])[A-Z]{2}\d{2}(?: ?[A-Z0-9]){11,30})"
    r"|(?P<phone>\+\d{1,3}[ .-]?(?:\(\d{2,4}\)|\d{2,4})(?:[ .-]?\d{2,4}){2,3}(?!\d)"
    r"|(?<![\d(])\(\d{3}\) ?\d{3}-\d{4}(?!\d))"
    r"|(?P<date>(?<![\d./-])(?:\d{4}-\d{2}-\d{2}|\d{1,2}\.\d{1,2}\.\d{4}|\d{1,2}/\d{1,2}/\d{4})(?![\d/-]|\.\d))"
    r"|(?P<ssn>(?<![\d-])\d{3}-\d{2}-\d{4}(?![\d-]))"
    r"|(?P<ip>(?<![\d.])\d{1,3}(?:\.\d{1,3}){3}(?!\d|\.\d))", re.A)
PHONE = re.compile(r"\+\d{1,3}[ .-]?(?:\(\d{2,4}\)|\d{2,4})(?:[ .-]?\d{2,4}){2,3}", re.A)
CARD_RUN = re.compile(r"(?<![\w.])\d(?:[ -]?\d){12,}", re.A)
CARD_STOP = re.compile(r"[\w-]", re.A)
GROUP = re.compile(r"\d+", re.A)
CARD_SHAPES = ((4, 4, 4, 4), (4, 6, 5), (4, 6, 4), (4, 4, 4, 4, 3), (4, 4, 4, 1))  # and 13 to 19 digits in one
CARD_GROUPS = 6
IBAN_LENGTH = {k: int(n) for n, ks in (x.split(":") for x in (
    "15:NO 16:BE 18:DK,FI,FK,FO,GL,NL,SD 19:MK,SI 20:AT,BA,EE,KZ,LT,LU,MN,XK 21:CH,HR,LI,LV "
    "22:BG,BH,CR,DE,GB,GE,IE,ME,RS,VA 23:AE,GI,IL,IQ,OM,SO,TL 24:AD,CZ,ES,MD,PK,RO,SA,SE,SK,TN,VG "
    "25:LY,PT,ST 26:IS,TR 27:BI,DJ,FR,GR,IT,MC,MR,SM 28:AL,AZ,BY,CY,DO,GT,HN,HU,LB,NI,PL,SV "
    "29:BR,EG,PS,QA,UA 30:JO,KW,MU,YE 31:MT,SC 32:LC 33:RU").split()) for k in ks.split(",")}
# Calling codes of one and two digits; all others have three.
CALLING_CODES = ("1 7 20 27 30 31 32 33 34 36 39 40 41 43 44 45 46 47 48 49 51 52 53 54 55 56 57 58 "
                 "60 61 62 63 64 65 66 81 82 84 86 90 91 92 93 94 95 98").split()
VERSION = re.compile(r"(?:\bv|\bver|\bversion|\brelease|\bbuild)\.?[ :=]?\Z", re.I)
EMAIL = re.compile(r"(?<![A-Za-z0-9._%+-])([A-Za-z0-9._%+-]+)@((?:[A-Za-z0-9-]+\.)+[A-Za-z]{2,})")
HAS_DIGIT_PAIR = re.compile(r"\d[\d.)/ -]?\d", re.A)


def permute(x: int, n: int, key: bytes, kind: str) -> int:
    """The keyed permutation of 0..n-1 at ``x``."""
    if n < 2:
        return x
    half = max(1, ((n - 1).bit_length() + 1) // 2)
    size, mask = (half + 7) // 8, (1 << half) - 1
    person = f"{kind}:{n % 10**9}".encode()[:16]
    while True:
        left, right = x >> half, x & mask
        for r in range(ROUNDS):
            mixed = hashlib.blake2b(bytes([r]) + right.to_bytes(size, "big"), key=key, person=person,
                                    digest_size=max(8, size)).digest()
            left, right = right, left ^ (int.from_bytes(mixed, "big") & mask)
        x = (left << half) | right
        if x < n:
            return x


def luhn_digit(body: str) -> str:
    """The digit that makes ``body`` plus it pass the Luhn check."""
    total = 0
    for k, c in enumerate(reversed(body)):
        d = int(c) * (2 if k % 2 == 0 else 1)
        total += d - 9 if d > 9 else d
    return str(-total % 10)


def _iban_check(country: str, account: str) -> str:
    digits = "".join(str(int(c, 36)) for c in account + country) + "00"
    return f"{98 - int(digits) % 97:02d}"


def _refill(shape: str, chars: str) -> str:
    """``shape`` with its letters and digits replaced in order."""
    it = iter(chars)
    return "".join(next(it) if c.isalnum() else c for c in shape)


def _by_class(value: str, key: bytes, kind: str) -> str:
    """``value`` with its letters and digits permuted, class by class."""
    sizes = [26 if c.isalpha() else 10 if c.isdigit() else 1 for c in value]
    x, n = 0, 1
    for c, s in zip(value, sizes):
        v = (ord(c.lower()) - 97) if s == 26 else int(c) if s == 10 else 0
        x, n = x * s + v, n * s
    x = permute(x, n, key, kind)
    out = []
    for c, s in zip(reversed(value), reversed(sizes)):
        x, v = divmod(x, s)
        out.append(c if s == 1 else str(v) if s == 10 else chr(v + (65 if c.isupper() else 97)))
    return "".join(reversed(out))


def _card(v: str, key: bytes) -> str | None:
    d = re.sub(r"\D", "", v)
    if luhn_digit(d[:-1]) != d[-1] or len(set(d)) == 1:
        return None
    body = f"{permute(int(d[:-1]), 10 ** (len(d) - 1), key, 'card'):0{len(d) - 1}d}"
    return _refill(v, body + luhn_digit(body))


def _iban(v: str, key: bytes) -> str | None:
    flat = v.replace(" ", "")
    country, check, account = flat[:2], flat[2:4], flat[4:]
    if not 15 <= len(flat) <= 34 or _iban_check(country, account) != check:
        return None
    new = _by_class(account, key, "iban" + country)
    return country + _refill(v[2:], _iban_check(country, new) + new)


def _ssn(v: str, key: bytes) -> str | None:
    area, group, serial = int(v[:3]), int(v[4:6]), int(v[7:])
    areas = 898  # 001-899 without 666
    if not 1 <= area <= 899 or area == 666 or not group or not serial:
        return None
    rank = area - 1 - (area > 666)
    x = permute((rank * 99 + group - 1) * 9999 + serial - 1, areas * 99 * 9999, key, "ssn")
    rank, group, serial = x // (99 * 9999), x // 9999 % 99 + 1, x % 9999 + 1
    area = rank + 1 + (rank + 1 >= 666)
    return f"{area:03d}-{group:02d}-{serial:04d}"


def _phone(v: str, key: bytes) -> str | None:
    start = 0
    if v.startswith("+"):
        digits = [i for i, c in enumerate(v) if c.isdigit()]
        lead = "".join(v[i] for i in digits[:2])
        n = 1 if lead[:1] in CALLING_CODES else 2 if lead in CALLING_CODES else 3
        start = digits[n - 1] + 1
    d = re.sub(r"\D", "", v[start:])
    if not 7 <= len(d) <= 13:
        return None
    return v[:start] + _refill(v[start:], f"{permute(int(d), 10 ** len(d), key, 'phone'):0{len(d)}d}")


def _ip(v: str, key: bytes) -> str | None:
    octets = [int(o) for o in v.split(".")]
    if max(octets) > 255 or any(len(o) > 1 and o[0] == "0" for o in v.split(".")):
        return None
    x = permute(int.from_bytes(bytes(octets), "big"), 1 << 32, key, "ip")
    return ".".join(map(str, x.to_bytes(4, "big")))


def _date(v: str, key: bytes) -> str | None:
    a, sep, b, _, c = re.split(r"([-./])", v)
    try:
        if sep == "-":
            order, day = "ymd", dt.date(int(a), int(b), int(c))
        else:
            order, day = "dmy", dt.date(int(c), int(b), int(a))
    except ValueError:
        if sep != "/":
            return None
        try:
            order, day = "mdy", dt.date(int(c), int(a), int(b))
        except ValueError:
            return None
    if not FIRST_DAY <= day <= LAST_DAY:
        return None
    n = (LAST_DAY - FIRST_DAY).days + 1
    new = FIRST_DAY + dt.timedelta(permute((day - FIRST_DAY).days, n, key, "date"))
    if sep == "-":
        return new.isoformat()
    one, two = (new.day, new.month) if order == "dmy" else (new.month, new.day)
    pad = 2 if len(a) == 2 and len(b) == 2 else 1
    return f"{one:0{pad}d}{sep}{two:0{pad}d}{sep}{new.year}"


def _email(local: str, key: bytes) -> str:
    return _by_class(local, key, "email" + "".join("a" if c.isalpha() else "9" if c.isdigit() else "." for c in local))


MAKERS = {"iban": _iban, "ssn": _ssn, "phone": _phone, "ip": _ip, "date": _date}


def _ends(text: str, m: re.Match) -> list[int]:
    """The ends at which the value of a match may stop, the likeliest first."""
    s, e, kind = m.start(), m.end(), m.lastgroup
    if kind == "iban":
        at = [i + 1 for i in range(s, e) if text[i] != " "]
        n = IBAN_LENGTH.get(text[s:s + 2])
        if not n:  # capitals after any two others and two digits are too often no account
            at = at[:4] + list(takewhile(lambda i: text[i - 1].isdigit(), at[4:]))
        ends = at[n - 1:n] if n else at[:13:-1]
        return [i for i in ends if not (text[i:i + 1].isascii() and text[i:i + 1].isalnum())]
    if kind != "phone" or text[s] != "+":
        return [e]
    ends = []
    for i in range(e, s, -1):
        if text[i - 1].isdigit() and not text[i:i + 1].isdigit() and PHONE.fullmatch(text, s, i):
            last = max(text.rfind(c, s, i) for c in "+ .-()") + 1
            other = NUMERIC.match(text, last)
            if not (other and other.end() > i and MAKERS[other.lastgroup](other.group(), b"") is not None):
                ends.append(i)
    if text[s + 1] == "1":
        ends.sort(key=lambda i: sum(map(str.isdigit, text[s:i])) != 11)
    return ends


def _card_windows(sizes: list[int], valid) -> list[tuple[int, int]]:
    """(first, end) of the groups of digits that make a card."""
    found: list[tuple[int, int]] = []
    free = [True] * len(sizes)

    def usual(i):
        if 13 <= sizes[i] <= 19:
            yield i + 1
        yield from (i + len(x) for x in CARD_SHAPES if tuple(sizes[i:i + len(x)]) == x)

    def fitting(i, most, least):
        ends, n = [], 0
        for j in range(i, min(len(sizes), i + most)):
            n += sizes[j]
            if n > 19 or sizes[j] < least or not free[j]:
                break
            if n >= 13:
                ends.append(j + 1)
        return ends[::-1]

    def take(i, ends):
        for j in ends:
            if all(free[i:j]) and valid(i, j):
                found.append((i, j))
                free[i:j] = [False] * (j - i)
                return j
        return 0

    for ends in (usual, lambda i: fitting(i, CARD_GROUPS, 3), lambda i: fitting(i, CARD_GROUPS, 1)):
        i = 0
        while i < len(sizes):
            i = take(i, ends(i)) or i + 1
    i = 0
    while i < len(sizes):  # many short groups: one try each, or tables of small numbers would be full of cards
        longest = fitting(i, 19, 1)[:1]
        i = take(i, longest) or (longest[0] if longest else i + 1)
    return found


def _cards(text: str, taken: list[tuple[int, int, str, str]], key: bytes) -> list[tuple[int, int, str, str]]:
    out = []
    starts = [t[0] for t in taken]
    for run in CARD_RUN.finditer(text):
        stretch: list[tuple[int, int]] = []
        stretches = [stretch]
        for g in GROUP.finditer(text, run.start(), run.end()):
            k = bisect_left(starts, g.end())
            if k and taken[k - 1][1] > g.start() or g.end() == run.end() and CARD_STOP.match(text, g.end()):
                stretches.append(stretch := [])
            else:
                stretch.append(g.span())
        for groups in stretches:
            def value(i, j, groups=groups):
                return _card(text[groups[i][0]:groups[j - 1][1]], key)

            for i, j in _card_windows([e - s for s, e in groups], lambda i, j: value(i, j) is not None):
                out.append((groups[i][0], groups[j - 1][1], "card", value(i, j)))
    return out


def find(text: str, key: bytes) -> list[tuple[int, int, str, str]]:
    """(start, end, kind, pseudonym) of every validated value, in order."""
    out = []
    if "@" in text:
        for m in EMAIL.finditer(text):
            if any(c.isalnum() for c in m.group(1)):
                out.append((m.start(), m.end(), "email", f"{_email(m.group(1), key)}@{m.group(2)}"))
    if HAS_DIGIT_PAIR.search(text):
        emails, at = list(out), 0
        starts = [t[0] for t in emails]
        while m := NUMERIC.search(text, at):
            s, at = m.start(), m.start() + 1  # a match without a value leaves its text to later starts
            k = bisect_right(starts, s)
            if k and emails[k - 1][1] > s:
                at = emails[k - 1][1]
                continue
            limit = emails[k][0] if k < len(emails) else len(text)
            if m.lastgroup == "ip" and VERSION.search(text, max(0, s - 10), s):
                at = m.end()
                continue
            for e in _ends(text, m):
                new = MAKERS[m.lastgroup](text[s:e], key) if e <= limit else None
                if new is not None:
                    out.append((s, e, m.lastgroup, new))
                    at = e
                    break
        out.sort()
        out += _cards(text, out, key)
    return sorted(out)


def pseudonymise(docs: DataFrame, key: bytes, id_col: str = "doc_id", text_col: str = "text") -> DataFrame:
    """Per row: the id, the text with its values replaced, ``n_<kind>`` counts and
    ``spans`` (kind:start:end in the original text, code points, end exclusive)."""
    if not 16 <= len(key) <= 64:
        raise ValueError("the key has 16 to 64 bytes")
    kind = docs.schema[id_col].dataType.simpleString()

    def run(cols):
        texts, spans, counts = [], [], {k: [] for k in KINDS}
        for text in texts_of(cols["text"]):
            found, at, parts = find(text, key), 0, []
            for s, e, _, new in found:
                parts += [text[at:s], new]
                at = e
            texts.append("".join([*parts, text[at:]]))
            spans.append(",".join(f"{k}:{s}:{e}" for s, e, k, _ in found))
            for k in KINDS:
                counts[k].append(sum(f[2] == k for f in found))
        return {id_col: cols["id"], "text": texts, "spans": spans} | {f"n_{k}": counts[k] for k in KINDS}

    ddl = ", ".join(f"n_{k} int" for k in KINDS)
    return arrow_map(docs.select(F.col(id_col).alias("id"), F.col(text_col).alias("text")), run,
                     schema_of(f"`{id_col}` {kind}, {ddl}, spans string, text string"))
