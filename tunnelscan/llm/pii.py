"""Format-preserving pseudonyms for personal data.

Numbers and dates are found by pattern, checked (Luhn, mod 97, octets, calendar,
area rules) and replaced by another value of the same format.  The value's
number within its format is permuted by a keyed Feistel network with
cycle-walking, so equal values get equal pseudonyms in all documents, different
values different ones, and the holder of the key can invert them.

==========  =======================================================  ================
kind        what is found                                            what stays
==========  =======================================================  ================
email       local part @ domain                                      case, signs, domain
iban        country, check digits and account, plain or in groups    country, groups
            of four, mod 97
card        13 to 19 digits, plain or in groups, Luhn                first digit, groups
ssn         three groups of a valid area                             groups
ip          four octets up to 255                                    dots
date        yyyy-mm-dd, dd.mm.yyyy, mm/dd/yyyy, dd/mm/yyyy           order, separators
phone       + country code, or 10 digits in the usual groups         country code, signs
secret      16 or more characters after token, key, secret ...       character classes
==========  =======================================================  ================

Edge cases: a NULL text stays NULL, an empty one empty, with no findings; where
two patterns meet, the one that starts first wins, then the order of the table;
numbers that fail their check stay as they are, and a value that starts within
one is still found (the number around it may pass its check once the value is
replaced: such a value is inverted alone, by its place); digits are
ASCII ones: numbers in other digits are left as they are; repeated rows and texts
of any length are treated alike; a value of more than ``BLOCK`` characters is
permuted in blocks, in time linear in its length; other columns pass through.
"""

from __future__ import annotations

import datetime
import hashlib
import re

import pyarrow as pa
from pyspark.sql import Column, DataFrame
from pyspark.sql import functions as F

from tunnelscan.llm.common import give_back

ROUNDS = 8
# Characters permuted as one number.
BLOCK = 128
# The key of the registered query; a deployment passes its own secret.
DEMO_KEY = b"replace this key in production"

_FIRST_DAY, _LAST_DAY = datetime.date(1900, 1, 1).toordinal(), datetime.date(2099, 12, 31).toordinal()

_NUMBERS = re.compile(r"""
    (?P<card>(?<![\d.])(?:\d{13,19}|\d{4}(?P<sep>[ -])\d{4}(?P=sep)\d{4}(?P=sep)\d{1,7}|\d{4}[ -]\d{6}[ -]\d{5})(?![\d]))
  | (?P<ssn>(?<![\d-])\d{3}-\d{2}-\d{4}(?![\d-]))
  | (?P<ip>(?<![\d.])\d{1,3}\.\d{1,3}\.\d{1,3}\.\d{1,3}(?!\.?\d))
  | (?P<date>(?<![\d/.-])(?:\d{4}-\d{2}-\d{2}|\d{1,2}\.\d{1,2}\.\d{4}|\d{1,2}/\d{1,2}/\d{4})(?![\d/-]))
  | (?P<phone>\+\d{1,3}[ .-]?\(?\d{1,4}\)?(?:[ .-]?\d{2,4}){1,4}(?!\d)|(?<!\d)\(\d{3}\)[ ]?\d{3}-\d{4}(?!\d)
      |(?<![\d.-])\d{3}(?P<dot>[.-])\d{3}(?P=dot)\d{4}(?!\d))
""", re.X | re.A)
# Runs of the signs that the numbers above are made of.
_RUN = re.compile(r"[\d+(][\d ().+/-]{6,}", re.A)
_GROUP = re.compile(r"[+(]|\d+", re.A)
_LOCAL = re.compile(r"[A-Za-z0-9._%+-]{1,64}\Z")
_DOMAIN = re.compile(r"(?:[A-Za-z0-9-]{1,63}\.)+[A-Za-z]{2,24}")
_IBAN = re.compile(r"(?<![A-Za-z0-9])[A-Z]{2}\d{2}[A-Z0-9]{11,30}(?![A-Za-z0-9])", re.A)
# In groups of four, the last one shorter.
_IBAN_START = re.compile(r"(?<![A-Za-z0-9])([A-Z]{2})(?=\d{2} [A-Z0-9]{4} )", re.A)
_IBAN_GROUPS = re.compile(r"[A-Z]{2}\d{2}(?: [A-Z0-9]{4}){2,7}(?: [A-Z0-9]{1,3}(?![A-Za-z0-9]))?", re.A)
# Characters of an IBAN by country; others end where their groups do.
_IBAN_SIZES = {country: size for size, countries in {
    15: "NO", 16: "BE", 18: "DK FI FO GL NL", 19: "MK SI", 20: "AT BA EE KZ LT LU XK", 21: "CH HR LI LV",
    22: "BG BH CR DE GB GE IE ME RS VA", 23: "AE GI IL IQ TL", 24: "AD CZ ES MD PK RO SA SE SK TN VG", 25: "LY PT ST",
    26: "IS TR", 27: "FR GR IT MC MR SM", 28: "AL AZ BY CY DO GT HU LB PL SV", 29: "BR EG PS QA UA", 30: "JO KW MU",
    31: "MT SC", 32: "LC"}.items() for country in countries.split()}
_SECRET = re.compile(r"""(?:token|key|secret|password|passwd)["']?[ \t]*[:=][ \t]*["']?([0-9A-Za-z+/_-]{16,})""", re.I)
_SECRET_WORDS = ("token", "key", "secret", "passw", "TOKEN", "KEY", "SECRET", "PASSW", "Token", "Key", "Secret", "Passw")
_ORDER = ("email", "iban", "card", "ssn", "ip", "date", "phone", "secret")


class Permutation:
    """Keyed permutations of 0 .. size - 1, one for each kind and size."""

    def __init__(self, key: bytes):
        self.key = hashlib.blake2b(key, digest_size=32).digest()

    def _round(self, kind: str, size: int, k: int, half: int, value: int) -> int:
        n = (half + 7) // 8
        out = b""
        while len(out) < n:
            tag = f"{kind}|{size}|{k}|{len(out)}|{value}".encode()
            out += hashlib.blake2b(tag, key=self.key, digest_size=64).digest()
        return int.from_bytes(out[:n], "big") & ((1 << half) - 1)

    def _network(self, kind: str, size: int, value: int, inverse: bool) -> int:
        half = max(1, ((size - 1).bit_length() + 1) // 2)
        left, right = value >> half, value & ((1 << half) - 1)
        for k in range(ROUNDS):
            if inverse:
                left, right = right ^ self._round(kind, size, ROUNDS - 1 - k, half, left), left
            else:
                left, right = right, left ^ self._round(kind, size, k, half, right)
        return left << half | right

    def move(self, kind: str, size: int, value: int, inverse: bool = False, valid=lambda x: True) -> int:
        """The image of ``value``; walks on along the cycle until the image is
        below ``size`` and ``valid`` (which must hold for ``value``)."""
        while True:
            value = self._network(kind, size, value, inverse)
            if value < size and valid(value):
                return value


def luhn(digits: str) -> int:
    """Check digit that completes ``digits``."""
    total = 0
    for k, c in enumerate(reversed(digits)):
        x = int(c) * (2 if k % 2 == 0 else 1)
        total += x - 9 if x > 9 else x
    return -total % 10


def _put(shape: str, digits: str) -> str:
    """``shape`` with its digits replaced in order."""
    it = iter(digits)
    return "".join(next(it) if c.isdigit() else c for c in shape)


_DIGITS, _LOWER, _UPPER = "0123456789", "abcdefghijklmnopqrstuvwxyz", "ABCDEFGHIJKLMNOPQRSTUVWXYZ"
_CLASS = {c: of for of in (_DIGITS, _LOWER, _UPPER) for c in of}
_HEX = {case: "".join(case(c) for c in _DIGITS + "abcdef") for case in (str.lower, str.upper)}


def _by_class(p: Permutation, kind: str, text: str, inverse: bool) -> str:
    """Permutes the texts of the same sequence of character classes."""
    return _in_blocks(p, kind, text, inverse, lambda part: [_CLASS.get(c, c) for c in part])


def _in_hex(p: Permutation, kind: str, text: str, inverse: bool) -> str:
    """Permutes the hex strings of one letter case.  A part with a letter keeps one
    and a part without stays without, so the image is read as hex again."""
    of = _HEX[str.lower if text.lower() == text else str.upper]
    return _in_blocks(p, kind, text, inverse, lambda part: [_DIGITS if part.isdigit() else of] * len(part),
                      lambda part, image: part.isdigit() or not image.isdigit())


def _in_blocks(p: Permutation, kind: str, text: str, inverse: bool, classes, valid=None) -> str:
    """Permutes a short text as one number.  A long one is permuted block by block,
    each under the digests of all others: of the images of those before it and of
    the values of those after it, both of which the inverse has as well."""
    if len(text) <= BLOCK:
        return _block(p, kind, text, classes(text), inverse, valid)
    blocks = [text[k:k + BLOCK] for k in range(0, len(text), BLOCK)]
    digest = lambda k, block: int.from_bytes(hashlib.blake2b(
        f"{k}|{block}".encode(), key=p.key, digest_size=16).digest(), "big")
    others = 0
    for k, block in enumerate(blocks):
        others ^= digest(k, block)
    for k in reversed(range(len(blocks))) if inverse else range(len(blocks)):
        others ^= digest(k, blocks[k])
        blocks[k] = _block(p, f"{kind}|{len(text)}|{k}|{others:x}", blocks[k], classes(blocks[k]), inverse, valid)
        others ^= digest(k, blocks[k])
    return "".join(blocks)


def _number(text: str, classes: list[str]) -> tuple[int, int]:
    """The text's number among those of its classes, and how many these are."""
    value, size = 0, 1
    for c, of in zip(text, classes):
        value = value * len(of) + of.index(c)
        size *= len(of)
    return value, size


def _spelled(x: int, classes: list[str]) -> str:
    out = []
    for of in reversed(classes):
        x, r = divmod(x, len(of))
        out.append(of[r])
    return "".join(reversed(out))


def _block(p: Permutation, kind: str, text: str, classes: list[str], inverse: bool, valid) -> str:
    # Hex strings of one case are the numbers that Python reads them as.
    case = next((c for c, of in _HEX.items() if classes and classes.count(of) == len(classes)), None)
    value, size = (int(text, 16), 16 ** len(text)) if case else _number(text, classes)
    if size == 1:
        return text

    def spelled(x: int) -> str:
        return case(f"{x:0{len(text)}x}") if case else _spelled(x, classes)

    tag = kind + "|" + "".join(of[0] if len(of) > 1 else "=" + of for of in classes)
    stays = (lambda x: valid(text, spelled(x))) if valid else (lambda x: True)
    return spelled(p.move(tag, size, value, inverse, stays))


def _email(p, s, inverse):
    local, _, domain = s.partition("@")
    return _by_class(p, "email|" + domain.lower(), local, inverse) + "@" + domain


def _iban_check(country: str, account: str) -> str:
    number = "".join(str(int(c, 36)) for c in account + country + "00")
    return f"{98 - int(number) % 97:02d}"


def _iban(p, s, inverse):
    flat = s.replace(" ", "")
    if _iban_check(flat[:2], flat[4:]) != flat[2:4]:
        return None
    account = _by_class(p, "iban|" + flat[:2], flat[4:], inverse)
    new = flat[:2] + _iban_check(flat[:2], account) + account
    return " ".join(new[k:k + 4] for k in range(0, len(new), 4)) if " " in s else new


def _card(p, s, inverse):
    d = re.sub(r"[^0-9]", "", s)
    if not 13 <= len(d) <= 19 or luhn(d[:-1]) != int(d[-1]) or not d.strip("0"):
        return None
    n = len(d) - 2
    body = d[0] + f"{p.move('card' + d[0], 10 ** n, int(d[1:-1]), inverse, lambda x: x or d[0] != '0'):0{n}d}"
    return _put(s, body + str(luhn(body)))


def _ssn_valid(x: int) -> bool:
    area, group, serial = x // 1_000_000, x // 10_000 % 100, x % 10_000
    return 0 < area < 900 and area != 666 and group > 0 and serial > 0


def _ssn(p, s, inverse):
    x = int(s.replace("-", ""))
    return _put(s, f"{p.move('ssn', 10 ** 9, x, inverse, _ssn_valid):09d}") if _ssn_valid(x) else None


def _ip(p, s, inverse):
    parts = s.split(".")
    # Leading zeros would not come back from the number.
    if any(int(x) > 255 or x != str(int(x)) for x in parts):
        return None
    x = p.move("ip", 1 << 32, int.from_bytes(bytes(map(int, parts)), "big"), inverse)
    return ".".join(map(str, x.to_bytes(4, "big")))


def _date(p, s, inverse):
    sep = re.search(r"[^0-9]", s).group()
    a, b, c = s.split(sep)
    day_first = sep == "." or (sep == "/" and int(a) > 12)
    y, m, d = (a, b, c) if sep == "-" else (c, b, a) if day_first else (c, a, b)
    try:
        day = datetime.date(int(y), int(m), int(d)).toordinal()
    except ValueError:
        return None
    wide = len(m) == 2 and len(d) == 2

    def valid(x: int) -> bool:
        new = datetime.date.fromordinal(x + _FIRST_DAY)
        # The image is read the same way round and is as wide.
        return ((sep != "/" or not day_first or new.day > 12)
                and (wide or len(str(new.month)) == len(m) and len(str(new.day)) == len(d)))

    if not _FIRST_DAY <= day <= _LAST_DAY or not valid(day - _FIRST_DAY):
        return None
    kind = f"date|{sep}|{day_first}|{wide or (len(m), len(d))}"
    new = datetime.date.fromordinal(p.move(kind, _LAST_DAY - _FIRST_DAY + 1, day - _FIRST_DAY, inverse, valid) + _FIRST_DAY)
    y, m, d = f"{new.year:04d}", f"{new.month:0{len(m)}d}", f"{new.day:0{len(d)}d}"
    return sep.join((y, m, d) if sep == "-" else (d, m, y) if day_first else (m, d, y))


def _phone(p, s, inverse):
    code = re.match(r"\+[0-9]{1,3}", s)
    head = code.group() if code else ""
    d = re.sub(r"[^0-9]", "", s[len(head):])
    total = len(d) + max(0, len(head) - 1)
    if not (8 <= total <= 15 if code else total == 10) or len(d) < 5:
        return None
    return head + _put(s[len(head):], f"{p.move('phone' + head, 10 ** len(d), int(d), inverse):0{len(d)}d}")


def _secret(p, s, inverse):
    hex_digits = bool(re.fullmatch(r"[0-9a-f]+|[0-9A-F]+", s)) and not s.isdigit()
    return (_in_hex if hex_digits else _by_class)(p, "secret", s, inverse)


_MAKERS = {"email": _email, "iban": _iban, "card": _card, "ssn": _ssn, "ip": _ip, "date": _date, "phone": _phone,
           "secret": _secret}


def _candidates(text: str):
    """(start, rank, end, kind) of everything that looks like a value."""
    if "@" in text:
        # From each sign to both sides, so that no long word is tried twice.
        at = text.find("@")
        while at >= 0:
            local = _LOCAL.search(text, max(0, at - 64), at)
            domain = _DOMAIN.match(text, at + 1)
            if local and domain:
                yield local.start(), 0, domain.end(), "email"
            at = text.find("@", at + 1)
    for run in _RUN.finditer(text):
        at = run.start()
        while m := _NUMBERS.search(text, at, run.end()):
            # On from the next group of digits: where this fails its check, a value within may pass.
            at = _GROUP.match(text, m.start()).end()
            kind = next(k for k in ("card", "ssn", "ip", "date", "phone") if m.group(k))
            end = m.end()
            if end < len(text) and text[end].isalnum() or m.start() and text[m.start() - 1].isalnum():
                continue
            yield m.start(), _ORDER.index(kind), end, kind
    if any(w in text for w in _SECRET_WORDS):
        for m in _SECRET.finditer(text):
            yield m.start(1), _ORDER.index("secret"), m.end(1), "secret"
    if any(c.isdigit() for c in text):
        for m in _IBAN.finditer(text):
            yield m.start(), 1, m.end(), "iban"
        for m in _IBAN_START.finditer(text):
            n = _IBAN_SIZES.get(m.group(1))
            # The country tells where it ends, as words in capitals may follow.
            whole = _IBAN_GROUPS.match(text, m.start(), m.start() + n + (n - 1) // 4) if n else _IBAN_GROUPS.match(text, m.start())
            if whole and (not n or len(whole.group().replace(" ", "")) == n) and not text[whole.end():whole.end() + 1].isalnum():
                yield whole.start(), 1, whole.end(), "iban"


def pseudonyms(text: str, p: Permutation, inverse: bool = False) -> tuple[str, list]:
    """The text with its values replaced, and (kind, start, end) of each in the
    original text."""
    out, found, done = [], [], 0
    for start, _, end, kind in sorted(_candidates(text)):
        if start < done:
            continue
        new = _MAKERS[kind](p, text[start:end], inverse)
        if new is not None:
            out += [text[done:start], new]
            found.append((kind, start, end))
            done = end
    return ("".join(out) + text[done:] if found else text), found


_KIND = "struct<text:string,kinds:array<string>,starts:array<int>,ends:array<int>>"
_ARROW = pa.struct([("text", pa.string()), ("kinds", pa.list_(pa.string())), ("starts", pa.list_(pa.int32())),
                    ("ends", pa.list_(pa.int32()))])


def pseudonymised(text: Column, key: bytes, inverse: bool = False) -> Column:
    """A struct: the new text, and the kind and place of every value found."""
    def replaced(col: pa.Array) -> pa.Array:
        p = Permutation(key)
        rows = []
        for s in col.to_pylist():
            new, found = (None, []) if s is None else pseudonyms(s, p, inverse)
            rows.append({"text": new, "kinds": [f[0] for f in found], "starts": [f[1] for f in found],
                         "ends": [f[2] for f in found]})
        out = pa.array(rows, _ARROW)
        rows.clear()
        give_back()
        return out

    replaced.__annotations__ = {"col": pa.Array, "return": pa.Array}
    return F.arrow_udf(replaced, _KIND)(text)


def pseudonymise(documents: DataFrame, key: bytes, text_col: str = "text", found_col: str | None = None) -> DataFrame:
    """The documents with ``text_col`` replaced; all other columns pass through.
    With ``found_col`` the findings are added as a struct under that name."""
    quoted = [F.col(f"`{c}`") for c in documents.columns]
    held = documents.select(F.struct(*quoted).alias("row"),
                            pseudonymised(F.col(f"`{text_col}`").cast("string"), key).alias("new"))
    out = [F.col("new.text").alias(c) if c == text_col else F.col(f"row.`{c}`").alias(c) for c in documents.columns]
    return held.select(*out, *([F.col("new").dropFields("text").alias(found_col)] if found_col else []))


def op7_pii(documents: DataFrame, key: bytes = DEMO_KEY) -> DataFrame:
    docs = documents.select(F.col("doc_id").cast("long").alias("doc_id"), "text")
    out = pseudonymise(docs, key, found_col="found")
    return out.select("doc_id", F.size("found.kinds").cast("long").alias("n_found"),
                      F.array_join(F.array_sort("found.kinds"), ",").alias("kinds"), "text")
