"""PII (operator 8): format-preserving Feistel pseudonyms.

Values are found by pattern, validated (checksums, calendar, ranges), turned
into a number below the count of valid values of their format, sent through a
keyed Feistel permutation of that range, and written back in the same format.
A permutation is one-to-one, so equal values stay equal across documents and
different ones stay different; without the key it can't be undone.
"""

from __future__ import annotations

import datetime as dt
import hashlib
import ipaddress
import math
import re
import string
import unicodedata
from collections.abc import Callable, Iterable, Iterator
from functools import lru_cache

import pyarrow as pa
from pyspark.sql import DataFrame
from pyspark.sql import functions as F

from .common import binary_values, byte_slices, id_and_text

ROUNDS = 10
KINDS = ("email", "phone", "card", "iban", "ssn", "ip", "date", "secret")


class Feistel:
    """Keyed permutations of 0..n-1."""

    def __init__(self, key: bytes):
        self.key = hashlib.blake2b(key, digest_size=32).digest()

    def _mix(self, tweak: bytes, n: int, round_: int, half: int, modulus: int) -> int:
        size = (half.bit_length() + 7) // 8 or 1
        data = b"%d|%d|%s|" % (n, round_, tweak) + half.to_bytes(size, "big")
        width = (modulus.bit_length() + 7) // 8 + 8  # far wider than the modulus: no bias to speak of
        return int.from_bytes(hashlib.shake_256(self.key + data).digest(width), "big") % modulus

    def permute(self, value: int, n: int, tweak: bytes, valid: Callable[[int], bool] = lambda x: True) -> int:
        """Image of ``value`` among the valid numbers below ``n``: walk the cycle
        until one comes up (``value`` itself is valid, so one does)."""
        a = math.isqrt(n - 1) + 1 if n > 1 else 1
        b = -(-n // a)
        while True:
            left, right = divmod(value, b)
            for r in range(ROUNDS):
                if r % 2 == 0:
                    left = (left + self._mix(tweak, n, r, right, a)) % a
                else:
                    right = (right + self._mix(tweak, n, r, left, b)) % b
            value = left * b + right
            if value < n and valid(value):
                return value


# -- formats ------------------------------------------------------------------

_ALPHABETS = (string.digits, string.ascii_lowercase, string.ascii_uppercase)
_FIRST_DAY, _LAST_DAY = dt.date(1900, 1, 1), dt.date(2099, 12, 31)


@lru_cache(maxsize=4096)
def _letters_beside(c: str) -> str:
    """The letters of ``c``'s category among the 128 code points around it, for a
    letter outside ASCII; nothing for other characters."""
    if c.isascii() or not c.isalpha():
        return ""
    kind, first = unicodedata.category(c), ord(c) & ~127
    return "".join(x for x in map(chr, range(first, first + 128)) if unicodedata.category(x) == kind)


def _by_character(cipher: Feistel, tweak: bytes, text: str, alphabets: Iterable[str] = _ALPHABETS) -> str:
    """Permute a string character class by class: digits stay digits, small
    letters small, letters outside ASCII among their like, and other characters
    stay."""
    alphabet = [next((a for a in alphabets if c in a), "") or _letters_beside(c) for c in text]
    value, n = 0, 1
    for c, a in zip(text, alphabet):
        if a:
            value, n = value * len(a) + a.index(c), n * len(a)
    shape = "".join(a[0] if a else c for c, a in zip(text, alphabet)).encode()
    if n == 1:
        return text
    value = cipher.permute(value, n, tweak + shape)
    out = []
    for c, a in zip(reversed(text), reversed(alphabet)):
        if a:
            value, digit = divmod(value, len(a))
            c = a[digit]
        out.append(c)
    return "".join(reversed(out))


def luhn_digit(payload: str) -> str:
    total = 0
    for i, c in enumerate(reversed(payload)):
        d = int(c) * (2 if i % 2 == 0 else 1)
        total += d - 9 if d > 9 else d
    return str(-total % 10)


def _refill(shape: str, digits: str) -> str:
    """``shape`` with its digits replaced in order."""
    it = iter(digits)
    return "".join(next(it) if c.isdigit() else c for c in shape)


def _card(cipher: Feistel, m: re.Match) -> str | None:
    text = m[0]
    digits = re.sub(r"\D", "", text)
    if not 13 <= len(digits) <= 19 or luhn_digit(digits[:-1]) != digits[-1] or digits.strip("0") == "":
        return None
    middle = digits[1:-1]  # the first digit names the kind of card
    new = cipher.permute(int(middle), 10 ** len(middle), b"card" + digits[:1].encode())
    payload = digits[0] + str(new).zfill(len(middle))
    return _refill(text, payload + luhn_digit(payload))


def _iban_ok(text: str) -> bool:
    moved = text[4:] + text[:4]
    return int("".join(str(int(c, 36)) for c in moved)) % 97 == 1


def _iban(cipher: Feistel, m: re.Match) -> str | None:
    text, rest = m[0], ""
    while True:
        plain = text.replace(" ", "").upper()
        if 15 <= len(plain) <= 34 and _iban_ok(plain):
            break
        text, space, word = text.rpartition(" ")  # a group without digits may be the next word of the text
        if not text or not word.isalpha():
            return None
        rest = space + word + rest
    account = _by_character(cipher, b"iban" + plain[:2].encode(), plain[4:])
    check = 98 - int("".join(str(int(c, 36)) for c in account + plain[:2] + "00")) % 97
    new = iter(f"{plain[:2]}{check:02d}{account}")
    new = "".join(c if c == " " else next(new) for c in text)
    return (new.lower() if text[:2].islower() else new) + rest


#: Country codes of one and two digits; all others have three.
_SHORT_CODES = frozenset("1 7 20 27 30 31 32 33 34 36 39 40 41 43 44 45 46 47 48 49 51 52 53 54 55 56 57 58 "
                         "60 61 62 63 64 65 66 81 82 84 86 90 91 92 93 94 95 98".split())


def _phone(cipher: Feistel, m: re.Match) -> str | None:
    """North American numbers (area and exchange begin with 2 to 9), and numbers
    with + and another country code, which stays."""
    if m["abroad"]:
        return _phone_abroad(cipher, m)
    digits = re.sub(r"\D", "", m["number"])
    if len(digits) != 10:
        return None
    ok = lambda s: s[0] in "23456789" and s[3] in "23456789"
    same = ok(digits)  # numbers outside the plan are permuted among themselves
    if not same and (m["number"].isdigit() or m["number"][3] == " " and m.start("number") == m.start()):
        return None  # a number of ten digits, three numbers in a row
    new = cipher.permute(int(digits), 10 ** 10, b"phone", lambda v: ok(str(v).zfill(10)) == same)
    at = m.start("number") - m.start()
    return m[0][:at] + _refill(m["number"], str(new).zfill(10)) + m[0][at + len(m["number"]):]


def _phone_abroad(cipher: Feistel, m: re.Match) -> str | None:
    """Eight to fifteen digits in all (E.164); a trunk zero in brackets stays."""
    text = m[0]
    plain = re.sub(r"\(0\)", lambda z: "(o)", text)
    digits = re.sub(r"\D", "", plain)
    code = next((digits[:n] for n in (1, 2) if digits[:n] in _SHORT_CODES), digits[:3])
    own = digits[len(code):]
    if not 8 <= len(digits) <= 15 or code[0] == "0" or re.fullmatch(r"\+\d+\.\d+", text):  # a number with a sign
        return None
    if code == "1":
        ok = lambda s: s[0] in "23456789" and s[3] in "23456789"
        if len(own) != 10:
            return None
        same = ok(own)
        new = cipher.permute(int(own), 10 ** 10, b"phone", lambda v: ok(str(v).zfill(10)) == same)
    else:
        zero = own[0] == "0"
        new = cipher.permute(int(own), 10 ** len(own), b"phone+" + code.encode(),
                             lambda v: (str(v).zfill(len(own))[0] == "0") == zero)
    return _refill(plain, code + str(new).zfill(len(own))).replace("(o)", "(0)")


def _ssn(cipher: Feistel, m: re.Match) -> str | None:
    ok = lambda s: s[:3] not in ("000", "666") and s[0] != "9" and s[3:5] != "00" and s[5:] != "0000"
    digits = re.sub("[ -]", "", m[0])
    if not ok(digits):
        return None
    new = cipher.permute(int(digits), 10 ** 9, b"ssn", lambda v: ok(str(v).zfill(9)))
    return _refill(m[0], str(new).zfill(9))


def _ip6(cipher: Feistel, text: str) -> str | None:
    """An address has the same pseudonym in any notation, written with eight
    groups where it was, else in the short form; ``::`` and ``::1`` stay."""
    try:
        value = int(ipaddress.IPv6Address(text))
    except ValueError:
        return None
    if value < 2 or not any(c.isdigit() for c in text):
        return None
    new = ipaddress.IPv6Address(cipher.permute(value, 1 << 128, b"ip6", lambda v: v > 1))
    out = new.exploded if len(text) == 39 else str(new)
    return out.upper() if text.upper() == text else out


def _ip(cipher: Feistel, m: re.Match) -> str | None:
    if m["v6"]:
        return _ip6(cipher, m[0])
    parts = m[0].split(".")
    if any(int(p) > 255 or str(int(p)) != p for p in parts):
        return None
    value = int.from_bytes(bytes(map(int, parts)), "big")
    return ".".join(map(str, cipher.permute(value, 1 << 32, b"ip").to_bytes(4, "big")))


def _date(cipher: Feistel, m: re.Match) -> str | None:
    """Years 1900 to 2099, as year-month-day, day/month/year or, where that is no
    date, month/day/year. A date has the same pseudonym in any format; days above
    12 are permuted among themselves, so that it is read in the same order. Days
    and months of one digit are written without zeros again."""
    year = m["y1"] or m["y2"]
    month, day = (m["m1"], m["d1"]) if m["y1"] else (m["m2"], m["d2"])
    bare = min(len(month), len(day)) == 1
    if bare and m["y1"] and "." in m[0]:
        return None  # a version
    swapped = not m["y1"] and int(month) > 12
    if swapped:
        month, day = day, month
    try:
        date = dt.date(int(year), int(month), int(day))
    except ValueError:
        return None
    if not _FIRST_DAY <= date <= _LAST_DAY:
        return None
    n = (_LAST_DAY - _FIRST_DAY).days + 1
    late = date.day > 12
    new = _FIRST_DAY + dt.timedelta(cipher.permute(
        (date - _FIRST_DAY).days, n, b"date", lambda v: ((_FIRST_DAY + dt.timedelta(v)).day > 12) == late))
    year, month, day = (str(x).zfill(w) for x, w in ((new.year, 4), (new.month, 2 - bare), (new.day, 2 - bare)))
    parts = (year, month, day) if m["y1"] else (month, day, year) if swapped else (day, month, year)
    return (m["s1"] or m["s2"]).join(parts)


def _email(cipher: Feistel, m: re.Match) -> str:
    return _by_character(cipher, b"email@" + m["host"].lower().encode(), m["local"]) + "@" + m["host"]


#: What a provider puts before a key says whose it is; it stays.
_KEY_PREFIX = r"(?:gh[opsur]_|github_pat_|(?:sk|pk|rk)_(?:live|test)_|glpat-|xox[abprs]-|AIza)"
_KEPT = re.compile(rf"(?:AKIA|ASIA)(?=[A-Z0-9]{{16}}$)|{_KEY_PREFIX}")
#: A longer secret is permuted in parts of so many characters.
_SECRET_PART = 512


def _hidden(cipher: Feistel, value: str) -> str:
    kept = m[0] if (m := _KEPT.match(value)) else ""
    alphabets = next(((a,) for a in ("0123456789abcdef", "0123456789ABCDEF") if set(value) <= set(a)), _ALPHABETS)
    parts = (value[i:i + _SECRET_PART] for i in range(len(kept), len(value), _SECRET_PART))
    return kept + "".join(_by_character(cipher, b"secret", part, alphabets) for part in parts)


def _secret(cipher: Feistel, m: re.Match) -> str:
    group = next(g for g in ("aws", "prefixed", "pem", "quoted", "single", "plain", "bearer") if m[g])
    value = m[group]
    if group == "pem":  # line by line; what names a value and the line ends stay
        lines = re.split(r"(\\[nr]|\s+)", value) if ":" not in value else re.split(r"(\\[nr]|\n)", value)
        new = "".join(line if i % 2 or ":" in line else _hidden(cipher, line) for i, line in enumerate(lines))
    else:
        new = _hidden(cipher, value)
    at = m.start(group) - m.start()
    return m[0][:at] + new + m[0][at + len(value):]


_ANNOUNCED = r"(?i:token|password|passwd|secret|api_?key)[\"']?\s*[=:]"
_LOCAL = "A-Za-z0-9\u00c0-\u00d6\u00d8-\u00f6\u00f8-\u024f\u0370-\u04ff_.%+-"  # Latin, Greek, Cyrillic
_FORMATS: dict[str, tuple[str, Callable[[Feistel, re.Match], str | None]]] = {
    "email": (rf"(?<![{_LOCAL}])(?P<local>[{_LOCAL}]+)@(?P<host>(?u:[\w-]+(?:\.[\w-]+)*\.[^\W\d_]{{2,}}))", _email),
    "secret": (r"(?<!\w)(?P<aws>(?:AKIA|ASIA)[A-Z0-9]{16})(?!\w)"
               rf"|(?<![A-Za-z0-9])(?P<prefixed>{_KEY_PREFIX}[A-Za-z0-9_-]{{16,}})"
               r"|-----BEGIN [A-Z ]{0,40}PRIVATE KEY-----(?P<pem>(?:[^-]|-(?!----))+)-----END"
               rf"|{_ANNOUNCED}\s*(?:(?i:bearer|basic)\s+)?"
               r"(?:\"(?P<quoted>[^\"\n]{6,})\"|'(?P<single>[^'\n]{6,})'|(?P<plain>[^\s\"'][^\s\"]{5,}))"
               r"|(?<!\w)(?i:bearer|authorization:\s*basic)\s+(?P<bearer>(?=[A-Za-z._~+/=-]*\d)[A-Za-z0-9._~+/=-]{16,})",
               _secret),
    "iban": (r"(?<!\w)(?:[A-Z]{2}\d{2}(?: ?[A-Z0-9]{4}){2,7}(?: ?[A-Z0-9]{1,3})?"
             r"|[a-z]{2}\d{2}(?: ?[a-z0-9]{4}){2,7}(?: ?[a-z0-9]{1,3})?)(?!\w)", _iban),
    "phone": (r"(?<![\w+])(?:(?:\+?1[ .-]?)?(?P<number>\(\d{3}\) ?\d{3}[ .-]\d{4}|\d{3}[ .-]\d{3}[ .-]\d{4}"
              r"|(?<![.,/-])\d{10}(?![.,/]\d))"
              r"|(?P<abroad>\+\d(?:[ .-]?(?:\(\d{1,4}\)|\d)){7,15})(?!\.\d))(?![\w-])", _phone),
    "ssn": (r"(?<![\w-])(?:\d{3}-\d{2}-\d{4}|(?<!\d )\d{3} \d{2} \d{4}(?! \d))(?![\w-])", _ssn),
    "date": (r"(?<![\w./-])(?:(?P<y1>\d{4})(?P<s1>[-/.])(?P<m1>\d\d?)(?P=s1)(?P<d1>\d\d?)(?=T\d\d|(?![\w/-]|\.\d))"
             r"|(?P<d2>\d\d?)(?P<s2>[-/.])(?P<m2>\d\d?)(?P=s2)(?P<y2>\d{4})(?![\w/-]|\.\d))", _date),
    "ip": (r"(?<![\w.])\d{1,3}(?:\.\d{1,3}){3}(?!\w|\.\d)"
           r"|(?<![\w:.])(?P<v6>(?:[0-9A-Fa-f]{1,4}:|:(?=:)){1,7}(?::|(?::?[0-9A-Fa-f]{1,4}){1,7}))(?![\w:]|\.\d)", _ip),
    "card": (r"(?<![\w-])\d(?:[ -]?\d){12,18}(?![\w-]|\.\d)", _card),
}
_PATTERNS = {kind: (re.compile(pattern, re.ASCII), write) for kind, (pattern, write) in _FORMATS.items()}
#: Every format holds a digit, an @, the word that announces a secret or its fixed beginning.
_MAYBE = re.compile(rb"[0-9@]|PRIVATE KEY-----|" + f"{_ANNOUNCED}|{_KEY_PREFIX}".encode())


def pseudonymise(text: str, cipher: Feistel) -> tuple[str, dict[str, int]]:
    """The text with pseudonyms, and how many of each kind. Formats are looked
    for in the order above; a match that one has replaced is not read again."""
    found: dict[str, int] = {}
    pieces: list[tuple[str, bool]] = [(text, False)]  # (text, done)
    for kind, (pattern, write) in _PATTERNS.items():
        if not any(not done and pattern.search(t) for t, done in pieces):
            continue
        out: list[tuple[str, bool]] = []
        for t, done in pieces:
            if done:
                out.append((t, True))
                continue
            last = 0
            for m in pattern.finditer(t):
                new = write(cipher, m)
                if new is not None:
                    out += [(t[last:m.start()], False), (new, True)]
                    last = m.end()
                    found[kind] = found.get(kind, 0) + 1
            out.append((t[last:], False))
        pieces = out
    return "".join(t for t, _ in pieces), found


@lru_cache(maxsize=2)
def _cipher(key: bytes) -> Feistel:
    return Feistel(key)


def pseudonyms(docs: DataFrame, key: bytes, id_col: str = "doc_id", text_col: str = "text") -> DataFrame:
    """(doc_id, text, n_replaced, n_<kind> for each kind), one row per input row.

    Validated card numbers, IBANs (in capitals or small letters), telephone and
    social security numbers, IPv4 and IPv6 addresses and dates, the local parts of
    e-mail addresses, and secrets are replaced by keyed pseudonyms of the same
    format. What looks like one but fails its check stays. Secrets are values of
    six characters or more after a word that announces one (quoted ones may hold
    spaces), bearer tokens, keys with a provider's prefix, which stays, and PEM
    private keys. Telephone numbers are found in the North American formats (ten
    digits alone if the plan allows them) and, with + and a country code, in any
    grouping; local formats of other countries are not. A date that can be read as
    day/month/year is; dates without separators or with named months, an IPv4
    address inside an IPv6 one (read as IPv4) and secrets that nothing announces
    are limits. Null texts stay null, empty ones empty; null ids and
    repeated rows are kept, and equal rows get equal results. Other columns are
    ignored; an empty table gives no rows. A text is handled whole.
    """
    slim = docs.select(*id_and_text(docs, id_col, text_col))
    kind_of_id = slim.schema["id"].dataType.simpleString()

    def replace(batches: Iterable[pa.RecordBatch]) -> Iterator[pa.RecordBatch]:
        cipher = _cipher(key)
        for part in byte_slices(batches):
            valid = part.column("text").is_valid().to_pylist()
            texts, counts = [], {k: [0] * part.num_rows for k in KINDS}
            for i, (data, ok) in enumerate(zip(binary_values(part.column("text")), valid)):
                if ok and _MAYBE.search(data):
                    new, found = pseudonymise(data.decode("utf-8", "replace"), cipher)
                    data = new.encode() if found else data
                    for k, n in found.items():
                        counts[k][i] = n
                texts.append(data if ok else None)
            totals = [sum(x) for x in zip(*counts.values())]
            yield pa.RecordBatch.from_arrays(
                [part.column("id"), pa.array(texts, pa.binary()).cast(pa.string()), pa.array(totals, pa.int64()),
                 *(pa.array(c, pa.int64()) for c in counts.values())],
                ["id", "text", "n_replaced", *(f"n_{k}" for k in KINDS)])

    counts = ", ".join(f"n_{k} long" for k in KINDS)
    out = slim.mapInArrow(replace, f"id {kind_of_id}, text string, n_replaced long, {counts}")
    return out.withColumnsRenamed({"id": id_col, "text": text_col})
