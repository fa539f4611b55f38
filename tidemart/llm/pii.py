"""Personal data replaced by format-preserving Feistel pseudonyms."""

from __future__ import annotations

import datetime as dt
import functools
import hashlib
import ipaddress
import re
import unicodedata
from collections.abc import Callable, Iterator

import pyarrow as pa
import pyarrow.compute as pc
from pyspark.sql import DataFrame, SparkSession
from pyspark.sql import functions as F

from tidemart.llm import resident
from tidemart.llm.rows import slices

SLICE_BYTES = 4 << 20
ROUNDS = 10
FIRST_DAY = dt.date(1900, 1, 1).toordinal()
DAYS = dt.date(2100, 1, 1).toordinal() - FIRST_DAY


class Feistel:
    """Keyed permutations of the numbers below any size, one for each tweak.

    The numbers are cut in two halves of as many bits as are needed; a result outside the range
    is permuted again until it is inside, which keeps the whole a permutation.
    """

    def __init__(self, key: bytes, rounds: int = ROUNDS):
        self.key, self.rounds = hashlib.blake2b(key, digest_size=32).digest(), rounds

    def _round(self, tweak: bytes, number: int, half: int, bits: int) -> int:
        data = b"%b|%d|%d" % (tweak, number, half)
        digest = hashlib.blake2b(data, key=self.key, digest_size=min(64, bits // 8 + 1)).digest()
        return int.from_bytes(digest, "big") & ((1 << bits) - 1)

    def _once(self, value: int, bits: int, tweak: bytes, back: bool) -> int:
        mask = (1 << bits) - 1
        left, right = value >> bits, value & mask
        for number in range(self.rounds):
            if back:
                number = self.rounds - 1 - number
                left, right = right ^ self._round(tweak, number, left, bits), left
            else:
                left, right = right, left ^ self._round(tweak, number, right, bits)
        return left << bits | right

    def permute(self, value: int, size: int, tweak: bytes, back: bool = False) -> int:
        if size < 2:
            return value
        bits = max(1, ((size - 1).bit_length() + 1) // 2)
        value = self._once(value, bits, tweak, back)
        while value >= size:
            value = self._once(value, bits, tweak, back)
        return value

    def characters(self, text: str, tweak: bytes) -> str:
        """Digits become digits, and letters letters of their case, in their script; others stay."""
        classes = [_class(c) for c in text]
        value = size = 0
        for char, (first, count) in zip(text, classes):
            if count:
                value = value * count + ord(char) - first
                size = max(size, 1) * count
        shape = "".join(chr(first) if count else char for char, (first, count) in zip(text, classes))
        value = self.permute(value, size, tweak + b"|" + shape.encode())
        out = list(text)
        for at in range(len(text) - 1, -1, -1):
            first, count = classes[at]
            if count:
                value, digit = divmod(value, count)
                out[at] = chr(first + digit)
        return "".join(out)


@functools.lru_cache(4096)
def _class(char: str) -> tuple[int, int]:
    """First code point and size of the run of like letters or digits that a character is in.
    Beyond ASCII a run is of one general category and ends at multiples of 32."""
    if "0" <= char <= "9":
        return 48, 10
    if "a" <= char <= "z":
        return 97, 26
    if "A" <= char <= "Z":
        return 65, 26
    kind = unicodedata.category(char)
    if char < "\x80" or kind not in ("Lu", "Ll", "Lo", "Nd"):
        return 0, 0
    if kind == "Nd":
        return ord(char) - unicodedata.digit(char), 10
    first = last = ord(char)
    while first % 32 and unicodedata.category(chr(first - 1)) == kind:
        first -= 1
    while (last + 1) % 32 and unicodedata.category(chr(last + 1)) == kind:
        last += 1
    return first, last - first + 1


def _digits(text: str) -> str:
    """The digits of any script as 0-9."""
    return "".join(str(unicodedata.digit(c)) for c in text if c.isdecimal())


def luhn_digit(digits: str) -> str:
    """The check digit that makes ``digits`` with it a valid card number."""
    total = 0
    for at, char in enumerate(reversed(digits)):
        number = int(char) * (2 if at % 2 == 0 else 1)
        total += number - 9 if number > 9 else number
    return str(-total % 10)


def _refill(shape: str, digits: str) -> str:
    """The digits of ``shape`` replaced one by one, each by one of its script."""
    fresh = iter(digits)
    return re.sub(
        r"\d", lambda old: chr(ord(old[0]) - unicodedata.digit(old[0]) + int(next(fresh))), shape
    )


def _number(feistel: Feistel, digits: str, kind: bytes) -> str:
    value = feistel.permute(int(digits), 10 ** len(digits), b"%b%d" % (kind, len(digits)))
    return str(value).zfill(len(digits))


# Fixed: how the numbers of card issuers begin, with their lengths.
_ISSUERS = re.compile(
    r"4(?=\d{12}$|\d{15}$|\d{18}$)|5[1-5](?=\d{14}$)|2(?:22[1-9]|2[3-9]\d|[3-6]\d\d|7[01]\d|720)(?=\d{12}$)"
    r"|3[47](?=\d{13}$)|(?:6011|64[4-9]|65)(?=\d{12,14}$)|35(?:2[89]|[3-8]\d)(?=\d{12}$)"
    r"|(?:30[0-5]|3[689])(?=\d{11,14}$)|62(?=\d{14,17}$)"
)


def _card(feistel: Feistel, found: re.Match) -> str | None:
    """What names the issuer stays, so that a pseudonym is the number of a card as well."""
    digits = _digits(found.group())
    issuer = _ISSUERS.match(digits)
    if not issuer or luhn_digit(digits[:-1]) != digits[-1]:
        return None
    body = issuer[0] + _number(feistel, digits[issuer.end() : -1], b"card" + issuer[0].encode())
    return _refill(found.group(), body + luhn_digit(body))


# Fixed: country codes have one digit, two, or three; none begins another.
_COUNTRY = re.compile(r"[17]|2[07]|3[0-469]|4[013-9]|5[1-8]|6[0-6]|8[1246]|9[0-58]|\d{3}")


def _phone(feistel: Feistel, found: re.Match) -> str | None:
    """The country code stays, and the zero in brackets that is not dialled from abroad."""
    whole = found.group()
    digits = _digits(whole)
    if not 7 <= len(digits) <= 17:
        return None
    head = 0
    if whole[0] == "+":
        head = _COUNTRY.match(digits).end()
        head += re.match(r"\+(?:\D*\d){%d}\D*\(0\)" % head, whole) is not None
    return _refill(whole, digits[:head] + _number(feistel, digits[head:], b"phone"))


def _address(feistel: Feistel, found: re.Match) -> str | None:
    parts = found.group().split(".")
    if any(int(part) > 255 or part != str(int(part)) for part in parts):
        return None
    value = int.from_bytes(bytes(map(int, parts)), "big")
    value = feistel.permute(value, 1 << 32, b"ipv4")
    return ".".join(map(str, value.to_bytes(4, "big")))


def _date(feistel: Feistel, found: re.Match) -> str | None:
    """Year first, or day first; month first where only that is a date."""
    first, gap, second, third = re.fullmatch(r"(\d+)([-/.])(\d+)[-/.](\d+)", found.group()).groups()
    orders = ["ymd"] if len(first) == 4 else ["dmy", "mdy"]
    for order in orders:
        part = dict(zip(order, (first, second, third)))
        try:
            day = dt.date(int(part["y"]), int(part["m"]), int(part["d"])).toordinal() - FIRST_DAY
        except ValueError:
            continue
        if not 0 <= day < DAYS:
            return None
        fresh = dt.date.fromordinal(feistel.permute(day, DAYS, b"date") + FIRST_DAY)
        new = {"y": f"{fresh.year:04d}", "m": f"{fresh.month:02d}", "d": f"{fresh.day:02d}"}
        return gap.join(new[name] for name in order)
    return None


def _address6(feistel: Feistel, found: re.Match) -> str | None:
    """Any spelling of an address has one pseudonym, in full; those below 2**16 are no machine's."""
    try:
        value = int(ipaddress.IPv6Address(found.group()))
    except ValueError:
        return None
    if value < 1 << 16:
        return None
    return ipaddress.IPv6Address(feistel.permute(value, 1 << 128, b"ipv6")).exploded


# Fixed: names of the months in English, German, French and Spanish, and English short forms.
_MONTHS = [
    text.split()
    for text in (
        "january february march april may june july august september october november december",
        "januar februar märz april mai juni juli august september oktober november dezember",
        "janvier février mars avril mai juin juillet août septembre octobre novembre décembre",
        "enero febrero marzo abril mayo junio julio agosto septiembre octubre noviembre diciembre",
        "jan feb mar apr may jun jul aug sep oct nov dec",
    )
]
_MONTH = "|".join(sorted({name for names in _MONTHS for name in names}, key=lambda x: (-len(x), x)))


def _named_date(feistel: Feistel, found: re.Match) -> str | None:
    """The same day as in numbers has the same pseudonym; the month's name stays in its language."""
    name = found.group("m1") or found.group("m2")
    day, year = (found.group(k + "1") or found.group(k + "2") for k in "dy")
    names = next(names for names in _MONTHS if name.lower() in names)
    try:
        at = dt.date(int(year), names.index(name.lower()) + 1, int(day)).toordinal() - FIRST_DAY
    except ValueError:
        return None
    if not 0 <= at < DAYS:
        return None
    fresh = dt.date.fromordinal(feistel.permute(at, DAYS, b"date") + FIRST_DAY)
    month = names[fresh.month - 1]
    month = month.upper() if name.isupper() else month.capitalize() if name[0].isupper() else month
    out, last = [], 0
    new = {"d": str(fresh.day), "m": month, "y": f"{fresh.year:04d}"}
    for group in sorted((g for g in found.groupdict() if found.group(g)), key=found.start):
        out += [found.string[max(last, found.start()) : found.start(group)], new[group[0]]]
        last = found.end(group)
    return "".join(out)


def _iban(feistel: Feistel, found: re.Match) -> str | None:
    whole = found.group()
    plain = whole.replace(" ", "")

    def rest(text: str) -> int:
        return int("".join(str(int(c, 36)) for c in text[4:] + text[:4])) % 97

    if not 15 <= len(plain) <= 34 or rest(plain) != 1:
        return None
    body = feistel.characters(plain[4:], b"iban" + plain[:2].encode())
    check = 98 - rest(plain[:2] + "00" + body)
    fresh = iter(f"{plain[:2]}{check:02d}{body}")
    return "".join(c if c == " " else next(fresh) for c in whole)


def _social(feistel: Feistel, found: re.Match) -> str | None:
    area, group, serial = found.group().split("-")
    if area in ("000", "666") or area[0] == "9" or group == "00" or serial == "0000":
        return None
    return _refill(found.group(), _number(feistel, area + group + serial, b"social"))


def _email(feistel: Feistel, found: re.Match) -> str | None:
    local, _, domain = found.group().partition("@")
    return f"{feistel.characters(local, b'email' + domain.lower().encode())}@{domain}"


def _secret(feistel: Feistel, found: re.Match) -> str | None:
    """A value of hexadecimal digits stays one; full stops and the like at its end are no part."""
    head = next(text for name, text in found.groupdict().items() if name[0] == "h" and text is not None)
    whole = next(text for name, text in found.groupdict().items() if name[0] == "v" and text is not None)
    value = whole.rstrip(".!?:")
    tail = whole[len(value) :]
    if len(value) < 8 or (found.groupdict().get("v2") and len(value) < 12 and value.isalpha()):
        return None
    for digits in ("0-9a-f", "0-9A-F"):
        if re.fullmatch(f"[{digits}]+", value):
            size = 16 ** len(value)
            fresh = feistel.permute(int(value, 16), size, b"hex%d" % len(value))
            text = f"{fresh:0{len(value)}x}"
            return head + (text.upper() if "F" in digits else text) + tail
    return head + feistel.characters(value, b"secret") + tail


# The formats, and the check that a match has to pass.
KINDS: dict[str, tuple[str, Callable[[Feistel, re.Match], str | None]]] = {
    "email": (r"(?<![\w.+-])[\w.+%-]+@[A-Za-z0-9-]+(?:\.[A-Za-z0-9-]+)*\.[A-Za-z]{2,}", _email),
    "secret": (
        r"(?P<h1>\bAKIA)(?P<v1>[A-Z0-9]{16})\b"
        r"|(?P<h2>\b(?i:pass(?:word|wd|phrase)?|pwd|token|secret|(?:api|access|secret|private)[_-]?key)\b[\"']?"
        r"\s*[=:]\s*[\"']?(?:(?i:bearer)\s+)?)(?P<v2>[^\s\"'<>,;()\[\]{}|]{8,})"
        r"|(?P<h3>\b(?i:bearer)\s+)(?P<v3>[A-Za-z0-9._~+/=-]{16,})"
        r"|(?P<h4>\b(?:gh[pousr]_|github_pat_|glpat-|xox[abposr]-|sk-|sk_live_|rk_live_))(?P<v4>[A-Za-z0-9_-]{16,})"
        r"|(?P<h5>\beyJ)(?P<v5>[A-Za-z0-9_-]{8,}\.[A-Za-z0-9_-]+(?:\.[A-Za-z0-9_-]+)?)",
        _secret,
    ),
    "iban": (r"\b[A-Z]{2}\d{2}(?: ?[A-Z0-9]{4}){2,7}(?: ?[A-Z0-9]{1,4})?\b", _iban),
    "date": (r"(?<![\d./-])(?:\d{4}-\d{1,2}-\d{1,2}|\d{4}/\d{1,2}/\d{1,2}|\d{1,2}/\d{1,2}/\d{4}"
             r"|\d{1,2}\.\d{1,2}\.\d{4}|\d{1,2}-\d{1,2}-\d{4})(?![\d/-]|\.\d)", _date),
    "named_date": (
        rf"\b(?i:(?P<m1>{_MONTH})\.?\s+(?P<d1>\d{{1,2}})(?:st|nd|rd|th)?,?\s+(?P<y1>\d{{4}})"
        rf"|(?P<d2>\d{{1,2}})(?:st|nd|rd|th|\.)?\s+(?:de\s+)?(?P<m2>{_MONTH})\.?,?\s+(?:de\s+)?(?P<y2>\d{{4}}))\b",
        _named_date,
    ),
    "address6": (r"(?<![\w:.])(?:[0-9A-Fa-f]{0,4}:){2,7}[0-9A-Fa-f]{0,4}(?![\w:])", _address6),
    "address": (r"(?<![\d.])\d{1,3}(?:\.\d{1,3}){3}(?!\d|\.\d)", _address),
    "social": (r"(?<![\d-])\d{3}-\d{2}-\d{4}(?![\d-])", _social),
    "card": (r"(?<![\d+-])\d(?:[ -]?\d){12,18}(?![\d-])", _card),
    "phone": (r"\+\d{1,3}[ .-]?(?:\(\d{1,4}\)[ .-]?)?\d{2,4}(?:[ .-]\d{2,4}){1,4}(?!\d)"
              r"|\+\d{7,17}(?!\d)|(?<![\d(])\(\d{3}\) ?\d{3}-\d{4}(?!\d)"
              r"|(?<![\d-])\d{3}[-.]\d{3}[-.]\d{4}(?![\d-])", _phone),
}
_PATTERNS = {kind: re.compile(pattern) for kind, (pattern, _) in KINDS.items()}
# Every match holds a digit of some script, an @, two colons or a word that secrets begin with.
_HINT = (
    r"[\p{Nd}@]|::|AKIA|eyJ|gh[pousr]_|github_pat_|glpat-|xox|sk-|_live_"
    r"|(?i:pass|pwd|token|secret|key|bearer)"
)


def pseudonymise(text: str, feistel: Feistel) -> tuple[str, list[str]]:
    """The text with pseudonyms, and the kinds of what was replaced, in order of kind.

    Kinds are looked for in turn, and not inside what an earlier one has replaced.
    """
    parts, kinds = [(text, True)], []
    for kind, (_, change) in KINDS.items():
        fresh = []
        for part, open_ in parts:
            at = 0
            for found in _PATTERNS[kind].finditer(part) if open_ else ():
                new = change(feistel, found)
                if new is not None and new != found.group():
                    fresh += [(part[at : found.start()], True), (new, False)]
                    at = found.end()
                    kinds.append(kind)
            fresh.append((part[at:], open_))
        parts = fresh
    return "".join(part for part, _ in parts), kinds


def _run(key: bytes) -> Callable[[Iterator[pa.RecordBatch]], Iterator[pa.RecordBatch]]:
    def run(batches: Iterator[pa.RecordBatch]) -> Iterator[pa.RecordBatch]:
        resident.let_go()
        feistel = Feistel(key)
        for batch in batches:
            for part in slices(batch, "text", SLICE_BYTES):
                hints = pc.fill_null(pc.match_substring_regex(part.column("text"), _HINT), False)
                texts = part.column("text").to_pylist()
                kinds: list[list[str]] = [[]] * len(texts)
                for at in hints.to_numpy(zero_copy_only=False).nonzero()[0].tolist():
                    texts[at], kinds[at] = pseudonymise(texts[at], feistel)
                yield pa.RecordBatch.from_arrays(
                    [
                        part.column("doc_id"),
                        pa.array(texts, pa.string()),
                        pa.array(list(map(len, kinds)), pa.int64()),
                        pa.array(kinds, pa.list_(pa.string())),
                    ],
                    names=["doc_id", "text", "n_replaced", "kinds"],
                )

    return run


def pseudonyms(docs: DataFrame, key: bytes) -> DataFrame:
    """``doc_id``, ``text`` with pseudonyms, ``n_replaced`` and ``kinds`` of every row.

    With the same key, equal values become equal pseudonyms in all texts, however they are
    punctuated. A pseudonym has the length, punctuation and check digits of its format (IPv6
    addresses are written in full, and days and months by name as long as they are); values
    that fail their check are left alone, and what is left as it was is not counted. Null stays null, empty stays empty; equal texts stay
    equal; no row gives no row. Nothing is shuffled.
    """
    texts = docs.select(
        F.col("doc_id").cast("bigint").alias("doc_id"), F.col("text").cast("string").alias("text")
    )
    schema = "doc_id bigint, text string, n_replaced bigint, kinds array<string>"
    return texts.mapInArrow(_run(key), schema)


def op7_pii(spark: SparkSession, sf_dir: str, key: bytes = b"replace by a key of your own") -> DataFrame:
    """All documents with pseudonyms for personal data."""
    return pseudonyms(spark.read.parquet(f"{sf_dir}/documents.parquet"), key)
