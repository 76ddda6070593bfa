"""Format-preserving pseudonyms: values that are validated as personal are permuted within their format by a key."""

from __future__ import annotations

import datetime
import hashlib
import re
from collections.abc import Callable, Iterator
from functools import lru_cache

import pandas as pd
from pyspark.sql import DataFrame
from pyspark.sql import functions as F

from promolens.llm.common import fresh

ROUNDS = 8
_LOWER, _UPPER, _DIGIT = "abcdefghijklmnopqrstuvwxyz", "ABCDEFGHIJKLMNOPQRSTUVWXYZ", "0123456789"
_FIRST, _LAST = datetime.date(1900, 1, 1).toordinal(), datetime.date(2099, 12, 31).toordinal()

#: What is looked for; a match counts only if its validator agrees. Letters beyond ASCII may stand next to a value, as in
#: scripts written without blanks.
_KINDS = {
    # Begins where a run of its characters does, so that a run is read once however long it is.
    "email": r"(?<![A-Za-z0-9_.%+-])%*[A-Za-z0-9][A-Za-z0-9._%+-]*@(?:[A-Za-z0-9-]+\.)+[A-Za-z]{2,}(?![A-Za-z0-9_-])",
    "secret": r"(?<![A-Za-z0-9_])(?:AKIA[A-Z0-9]{16}|(?i:password|passwd|secret|token|api_?key)\s{0,2}[=:]\s{0,2}[\"']?[A-Za-z0-9_-]{8,})(?![A-Za-z0-9_])",
    "iban": r"(?<![A-Za-z0-9_])[A-Z]{2}[0-9]{2}(?: ?[A-Z0-9]{4}){2,7}(?: ?[A-Z0-9]{1,3})?(?![A-Za-z0-9_])",
    "ip": r"(?<![A-Za-z0-9_.])[0-9]{1,3}(?:\.[0-9]{1,3}){3}(?![A-Za-z0-9_]|\.[0-9])",
    "date": r"(?<![A-Za-z0-9_/.-])(?:[0-9]{4}-[0-9]{2}-[0-9]{2}|[0-9]{2}/[0-9]{2}/[0-9]{4}|[0-9]{2}\.[0-9]{2}\.[0-9]{4})(?!(?![Tt][0-9])[A-Za-z0-9_/-]|\.[0-9])",
    "ssn": r"(?<![A-Za-z0-9_-])[0-9]{3}-[0-9]{2}-[0-9]{4}(?![A-Za-z0-9_-])",
    "card": r"(?<![A-Za-z0-9_-])(?:[0-9]{13,19}|[0-9]{4}(?P<s>[ -])[0-9]{4}(?P=s)[0-9]{4}(?P=s)[0-9]{1,7}|[0-9]{4}(?P<t>[ -])[0-9]{6}(?P=t)[0-9]{4,5})(?![A-Za-z0-9_-])",
    "phone": r"(?<![A-Za-z0-9_+.-])(?:\+1[ .-]?\(?[0-9]{3}\)?[ .-]?[0-9]{3}[ .-]?[0-9]{4}|\+[0-9]{1,3}[ .-]?(?:\([0-9]{1,4}\)[ .-]?)?[0-9]{2,4}(?:[ .-]?[0-9]{2,4}){1,4}|\([0-9]{3}\)[ .-]?[0-9]{3}[ .-][0-9]{4}|[0-9]{3}(?P<u>[ .-])[0-9]{3}(?P=u)[0-9]{4})(?![A-Za-z0-9_-]|\.[0-9])",
}
_PATTERN = re.compile("|".join(f"(?P<{kind}>{pattern})" for kind, pattern in _KINDS.items()))
_ALONE = {kind: re.compile(pattern) for kind, pattern in _KINDS.items()}
#: Characters of an IBAN by country.
_IBAN_LENGTHS = {country: length for length, countries in {
    15: "NO", 16: "BE", 18: "DK FI FO GL NL", 19: "MK SI", 20: "AT BA EE KZ LT LU XK", 21: "CH HR LI LV",
    22: "BG BH CR DE GB GE IE ME RS VA", 23: "AE GI IL IQ TL", 24: "AD CZ ES MD PK RO SA SE SK TN VG", 25: "LY PT ST",
    26: "IS TR", 27: "FR GR IT MC MR SM", 28: "AL AZ BY CY DO GT HU LB PL SV", 29: "BR EG PS QA UA", 30: "JO KW MU", 31: "MT SC", 32: "LC",
}.items() for country in countries.split()}
#: A text without any of these holds no match.
_HINT = re.compile(r"[0-9@]|AKIA|(?i:passw|secret|token|api_?key)")


class Feistel:
    """Keyed permutations of integer ranges: a balanced Feistel network over enough bits, walked until within the range."""

    def __init__(self, key: bytes) -> None:
        self.key = hashlib.blake2b(key, digest_size=32).digest()

    def permute(self, value: int, size: int, tweak: str) -> int:
        if size < 2:
            return value
        half = ((size - 1).bit_length() + 1) // 2
        mask = (1 << half) - 1
        length = (half + 7) // 8
        while True:
            left, right = value >> half, value & mask
            for number in range(ROUNDS):
                digest = hashlib.blake2b(f"{tweak}|{size}|{number}|{right}".encode(), key=self.key, digest_size=min(64, length + 8)).digest()
                while len(digest) < length + 8:
                    digest += hashlib.blake2b(digest, key=self.key).digest()
                left, right = right, left ^ (int.from_bytes(digest, "little") & mask)
            value = left << half | right
            if value < size:
                return value

    def characters(self, value: str, tweak: str) -> str:
        """Permute letters and digits among the values that have the same kinds of characters in the same places."""
        sets = [next((s for s in (_LOWER, _UPPER, _DIGIT) if c in s), c) for c in value]
        number, size = 0, 1
        for c, s in zip(value, sets, strict=True):
            number, size = number * len(s) + s.index(c), size * len(s)
        shape = "".join(s[0] if len(s) > 1 else s for s in sets)
        number = self.permute(number, size, f"{tweak}|{shape}")
        out = []
        for s in reversed(sets):
            number, place = divmod(number, len(s))
            out.append(s[place])
        return "".join(reversed(out))


def luhn_digit(payload: str) -> str:
    """The check digit that makes payload and digit valid."""
    total = sum(sum(divmod(int(c) * (2 if k % 2 == 0 else 1), 10)) for k, c in enumerate(reversed(payload)))
    return str(-total % 10)


def _refill(shape: str, characters: str) -> str:
    """Put ``characters`` where ``shape`` has letters or digits."""
    rest = iter(characters)
    return "".join(next(rest) if c.isalnum() else c for c in shape)


def _email(cipher: Feistel, value: str) -> str:
    name, dot, top = value.rpartition(".")
    return cipher.characters(name, "email") + dot + top


def _secret(cipher: Feistel, value: str) -> str:
    if value.startswith("AKIA") and len(value) == 20:
        return "AKIA" + cipher.characters(value[4:], "secret")
    name, body = re.fullmatch(r"(?s)(.*?[=:]\s*[\"']?)(.*)", value).groups()
    return name + cipher.characters(body, "secret")


def _iban(cipher: Feistel, value: str) -> str:
    def check(country: str, account: str) -> int:
        return int("".join(str(int(c, 36)) for c in account + country + "00")) % 97

    plain = value.replace(" ", "")
    country, account = plain[:2], plain[4:]
    if not 15 <= len(plain) <= 34 or int(plain[2:4]) != 98 - check(country, account):
        return value
    account = cipher.characters(account, f"iban|{country}")
    return _refill(value, f"{country}{98 - check(country, account):02d}{account}")


def _ip(cipher: Feistel, value: str) -> str:
    parts = [int(x) for x in value.split(".")]
    if max(parts) > 255 or any(len(x) > 1 and x[0] == "0" for x in value.split(".")):
        return value
    moved = cipher.permute(int.from_bytes(bytes(parts), "big"), 1 << 32, "ip")
    return ".".join(map(str, moved.to_bytes(4, "big")))


def _date(cipher: Feistel, value: str) -> str:
    sign = next(c for c in value if not c.isdigit())

    def read(text: str) -> tuple[str, int] | None:
        a, b, c = map(int, text.split(sign))
        for order, parts in (("ymd", (a, b, c)),) if sign == "-" else (("dmy", (c, b, a)), ("mdy", (c, a, b))):
            try:
                day = datetime.date(*parts).toordinal()
            except ValueError:
                continue
            return (order, day) if _FIRST <= day <= _LAST else None
        return None

    found = read(value)
    if found is None:
        return value
    order, day = found
    while True:  # walked on until the new date reads the same way
        day = _FIRST + cipher.permute(day - _FIRST, _LAST - _FIRST + 1, f"date|{order}")
        moved = datetime.date.fromordinal(day)
        parts = {"y": f"{moved.year:04d}", "m": f"{moved.month:02d}", "d": f"{moved.day:02d}"}
        text = sign.join(parts[c] for c in order)
        if read(text) == (order, day):
            return text


def _ssn(cipher: Feistel, value: str) -> str:
    area, group, serial = map(int, value.split("-"))
    areas = [x for x in range(1, 900) if x != 666]
    if area not in areas or not group or not serial:
        return value
    number = cipher.permute((areas.index(area) * 99 + group - 1) * 9999 + serial - 1, len(areas) * 99 * 9999, "ssn")
    number, serial = divmod(number, 9999)
    area, group = divmod(number, 99)
    return f"{areas[area]:03d}-{group + 1:02d}-{serial + 1:04d}"


def _card(cipher: Feistel, value: str) -> str:
    digits = "".join(c for c in value if c.isdigit())
    if not 13 <= len(digits) <= 19 or luhn_digit(digits[:-1]) != digits[-1]:
        return value
    payload = cipher.characters(digits[:-1], "card")
    return _refill(value, payload + luhn_digit(payload))


def _phone(cipher: Feistel, value: str) -> str:
    country = re.match(r"\+[0-9]{1,3}(?=[ .(-])", value)
    head = country.group() if country else "+" if value[0] == "+" else ""
    digits = "".join(c for c in value[len(head) :] if c.isdigit())
    if not 7 <= len(digits) <= 15:
        return value
    return head + _refill(value[len(head) :], cipher.characters(digits, f"phone|{head}"))


_MASKS: dict[str, Callable[[Feistel, str], str]] = {
    "email": _email, "secret": _secret, "iban": _iban, "ip": _ip, "date": _date, "ssn": _ssn, "card": _card, "phone": _phone,
}


_ORDER = list(_KINDS)


def _ends(kind: str, match: re.Match) -> Iterator[int]:
    """Ends that a value may have: an IBAN's by its country, then the whole match, then before each blank in it."""
    text, start, end = match.string, match.start(), match.end()
    cuts = [end, *(k for k in range(end - 1, start, -1) if text[k] == " ")]
    if kind == "iban":
        size = _IBAN_LENGTHS.get(text[start : start + 2])
        cuts.sort(key=lambda k: len(text[start:k].replace(" ", "")) != size)
    for cut in cuts:
        if cut == end or _ALONE[kind].fullmatch(text, start, cut):
            yield cut


@lru_cache(maxsize=2)
def masker(key: bytes) -> Callable[[str], tuple[str, list[str]]]:
    """A function from a text to the text with pseudonyms and the kinds found, one entry per value."""
    cipher = Feistel(key)

    @lru_cache(maxsize=100_000)
    def pseudonym(kind: str, value: str) -> str:
        return _MASKS[kind](cipher, value)

    def mask(text: str) -> tuple[str, list[str]]:
        if not _HINT.search(text):
            return text, []
        kinds: list[str] = []
        out: list[str] = []
        done = at = 0
        while match := _PATTERN.search(text, at):
            found = replaced(match)
            if found is None:  # another value may begin within this one
                at = match.start() + 1
                continue
            kind, end, moved = found
            kinds.append(kind)
            out += [text[done : match.start()], moved]
            done = at = end
        return "".join([*out, text[done:]]), kinds

    def replaced(match: re.Match) -> tuple[str, int, str] | None:
        """The first kind of value, and the end of it, that is valid where the match begins."""
        text, start = match.string, match.start()
        for kind in _ORDER[_ORDER.index(match.lastgroup) :]:
            own = match if kind == match.lastgroup else _ALONE[kind].match(text, start)
            for end in _ends(kind, own) if own else ():
                moved = pseudonym(kind, text[start:end])
                if moved != text[start:end]:
                    return kind, end, moved
        return None

    return mask


def pseudonymise(docs: DataFrame, key: bytes, text: str = "text", kinds: str = "pii_kinds", count: str = "n_pii") -> DataFrame:
    """All columns of ``docs`` with the text's personal values replaced, plus the kinds found and their number.

    Cards (Luhn), IBANs (mod 97), social security numbers, IPv4 addresses, phone numbers, dates from 1900 to 2099,
    e-mail addresses and secrets are validated, then permuted by the key among the values of the same format and
    validity: equal values stay equal across documents, different ones stay different, and the key's holder can
    undo it. What fails validation stays. A null text stays null with no kinds; a text without such values is
    returned unchanged. Columns named like ``kinds`` and ``count`` are replaced.
    """

    def run(texts: pd.Series) -> pd.DataFrame:
        mask = masker(key)
        rows = [(None, []) if value is None else mask(value) for value in texts]
        names = [",".join(sorted(set(found))) for _, found in rows]
        return pd.DataFrame({"text": [new for new, _ in rows], "kinds": names, "count": [len(found) for _, found in rows]})

    new = fresh(docs, "masked")
    done = docs.withColumn(new, F.pandas_udf(run, "text string, kinds string, count int")(F.col(text)))
    columns = {text: F.col(f"{new}.text"), kinds: F.col(f"{new}.kinds"), count: F.col(f"{new}.count")}
    return done.withColumns(columns).drop(new)
