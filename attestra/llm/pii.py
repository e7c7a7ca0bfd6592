"""Format-preserving Feistel pseudonyms for personal numbers, dates and addresses (operator 4).

A match is validated first (check digits, ranges, calendar); then its digits or letters are permuted under a key within their own format, so
the same value has the same pseudonym in every document and no table of values is kept. Check digits are made anew.
"""

from __future__ import annotations

import datetime
import hashlib
import re
import unicodedata
from collections.abc import Callable, Iterator

import pyarrow as pa
from pyspark.sql import DataFrame, SparkSession
from pyspark.sql import functions as F
from pyspark.sql.types import IntegerType, MapType, StringType, StructField, StructType

from attestra.llm.common import query, table

ROUNDS = 8
FIRST_DAY, LAST_DAY = datetime.date(1900, 1, 1).toordinal(), datetime.date(2099, 12, 31).toordinal()
#: What a document is searched for, in this order at each place.
PATTERNS = {
    "secret": r"(?i:\b(?:token|secret|api[_-]?key|password|passwd)\b)\s*[=:]\s*[\"'][A-Za-z0-9_\-+/=.]{8,}[\"']",
    "email": r"(?<![\w.%+-])[\w.%+-]+@[A-Za-z0-9-]+(?:\.[A-Za-z0-9-]+)*\.[A-Za-z]{2,}",
    "ip": r"(?<![\w.])(?:\d{1,3}\.){3}\d{1,3}(?!\w|\.\d)",
    "date": r"(?<![\w.-])(?:\d{4}(?P<d1>[-/.])\d{1,2}(?P=d1)\d{1,2}|\d{1,2}(?P<d2>[-/.])\d{1,2}(?P=d2)\d{4})(?![\w-]|\.\d)",
    "ssn": r"(?<![\w-])\d{3}-\d{2}-\d{4}(?![\w-])",
    "phone": r"(?<![\w+])(?:\+\d{1,3}[ .-]?(?:\(\d{1,4}\)|\d{1,4})(?:[ .-]?\d{2,4}){2,4}|\(\d{3}\) ?\d{3}[ .-]\d{4}|\d{3}[.-]\d{3}[.-]\d{4})(?!\w)",
    "card": r"(?<![\w-])(?:\d{13,19}|\d{4}(?P<c1>[ -])\d{4}(?P=c1)\d{4}(?P=c1)\d{1,7}|\d{4}(?P<c2>[ -])\d{6}(?P=c2)\d{5})(?!\w)",
    "iban": r"(?<!\w)[A-Z]{2}\d{2}(?: ?[A-Z0-9]{4}){2,7}(?: ?[A-Z0-9]{1,4})?(?!\w)",
}
#: A text without any of these holds nothing of the above.
HINT = re.compile(r"@|\d{2}|\d\.\d|[=:]\s*[\"']")
FOUND = re.compile("|".join(f"(?P<{k}>{v})" for k, v in PATTERNS.items()))


class Permuter:
    """Keyed permutations of 0 .. n-1 for any n: a balanced Feistel network over the next even number of bits, walked until it falls below n."""

    def __init__(self, key: bytes):
        self.key = hashlib.blake2b(key, digest_size=32).digest()

    def _round(self, tweak: bytes, i: int, half: int, width: int) -> int:
        got = hashlib.blake2b(tweak + bytes([i]) + half.to_bytes(32, "big"), key=self.key, digest_size=32).digest()
        return int.from_bytes(got, "big") & ((1 << width) - 1)

    def permute(self, value: int, n: int, tweak: str) -> int:
        width = max(1, ((n - 1).bit_length() + 1) // 2)
        mask, mark = (1 << width) - 1, f"{tweak}/{n}".encode()
        while True:
            a, b = value >> width, value & mask
            for i in range(ROUNDS):
                a, b = b, a ^ self._round(mark, i, b, width)
            value = a << width | b
            if value < n:
                return value

    def digits(self, text: str, tweak: str) -> str:
        """Permutes the digits of a text as one number; everything else stays in its place."""
        found = [c for c in text if c in "0123456789"]
        if not found:
            return text
        new = iter(str(self.permute(int("".join(found)), 10 ** len(found), tweak)).zfill(len(found)))
        return "".join(next(new) if c in "0123456789" else c for c in text)

    def characters(self, text: str, tweak: str) -> str:
        """Permutes letters and digits as one number of mixed base; ASCII case and digits stay of their kind, other characters stay."""
        kinds = ["0123456789", "abcdefghijklmnopqrstuvwxyz", "ABCDEFGHIJKLMNOPQRSTUVWXYZ"]
        out, chunk = list(text), []
        for i, c in enumerate(text):
            kind = next((k for k in kinds if c in k), None)
            if kind:
                chunk.append((i, kind))
            if chunk and (len(chunk) == 40 or i == len(text) - 1):
                value, n = 0, 1
                for j, kind_j in chunk:
                    value, n = value * len(kind_j) + kind_j.index(text[j]), n * len(kind_j)
                value = self.permute(value, n, f"{tweak}/{''.join('dla'[kinds.index(k)] for _, k in chunk)}")
                for j, kind_j in reversed(chunk):
                    value, at = divmod(value, len(kind_j))
                    out[j] = kind_j[at]
                chunk = []
        return "".join(out)


def luhn_digit(head: str) -> str:
    """The digit that makes head a valid number."""
    total = sum(d if i % 2 else (2 * d - 9 if d > 4 else 2 * d) for i, d in enumerate(map(int, reversed(head))))
    return str(-total % 10)


def mod97(text: str) -> int:
    return int("".join(str(int(c, 36)) for c in text)) % 97


def refill(shape: str, digits: str) -> str:
    new = iter(digits)
    return "".join(next(new) if c.isdigit() else c for c in shape)


def ascii_digits(s: str) -> str:
    """Decimal digits of every script, which the patterns match too, as 0-9."""
    return s if s.isascii() else "".join(str(unicodedata.decimal(c)) if c.isdecimal() else c for c in s)


def as_written(s: str, new: str) -> str:
    """new with its digits in the scripts of those of s, one after the other; the last script goes on where new has more."""
    zeros = [ord(c) - unicodedata.decimal(c) for c in s if c.isdecimal()]
    at = iter(range(len(new)))
    return "".join(chr(zeros[min(next(at), len(zeros) - 1)] + int(c)) if c.isdecimal() else c for c in new)


def email(p: Permuter, s: str) -> str | None:
    """ASCII letters and digits of the local part within their kind; a local part with other letters becomes a keyed name."""
    local, _, host = s.partition("@")
    if local.isascii() and any(c.isalnum() for c in local):
        return f"{p.characters(local, 'email')}@{host}"
    return f"{hashlib.blake2b(local.encode('utf-8', 'surrogatepass'), key=p.key, digest_size=8).hexdigest()}@{host}"


def secret(p: Permuter, s: str) -> str | None:
    quote = s[-1]
    head, _, value = s[:-1].partition(quote)
    if set(value) <= set("0123456789abcdef"):  # a hexadecimal key stays one
        return f"{head}{quote}{p.permute(int(value, 16), 16 ** len(value), 'hex'):0{len(value)}x}{quote}"
    return f"{head}{quote}{p.characters(value, 'secret')}{quote}"


def ip(p: Permuter, s: str) -> str | None:
    parts = [int(x) for x in s.split(".")]
    if max(parts) > 255 or any(len(x) > 1 and x[0] == "0" for x in s.split(".")):
        return None
    new = p.permute(int.from_bytes(bytes(parts), "big"), 1 << 32, "ip")
    return ".".join(map(str, new.to_bytes(4, "big")))


def date(p: Permuter, s: str) -> str | None:
    """Days of 1900 to 2099 among themselves; year first, else day before month unless only month before day is a date. Field widths stay where they can."""
    sep = next(c for c in s if not c.isdigit())
    f = s.split(sep)
    for order in ((0, 1, 2),) if len(f[0]) == 4 else ((2, 1, 0), (2, 0, 1)):
        try:
            day = datetime.date(*(int(f[i]) for i in order))
        except ValueError:
            continue
        if not FIRST_DAY <= day.toordinal() <= LAST_DAY:
            return None
        new = datetime.date.fromordinal(FIRST_DAY + p.permute(day.toordinal() - FIRST_DAY, LAST_DAY - FIRST_DAY + 1, "date"))
        out = ["", "", ""]
        for i, v in zip(order, (new.year, new.month, new.day), strict=True):
            out[i] = str(v).zfill(len(f[i]))
        return sep.join(out)
    return None


def ssn(p: Permuter, s: str) -> str | None:
    good = lambda d: d[:3] not in ("000", "666") and d[0] != "9" and d[3:5] != "00" and d[5:] != "0000"
    d = s.replace("-", "")
    if not good(d):
        return None
    while True:  # walks until the number is valid again
        d = str(p.permute(int(d), 10**9, "ssn")).zfill(9)
        if good(d):
            return f"{d[:3]}-{d[3:5]}-{d[5:]}"


def phone(p: Permuter, s: str) -> str | None:
    if not 8 <= sum(c.isdigit() for c in s) <= 15:
        return None
    m = re.match(r"\+\d{1,3}(?=[ .(-])", s)  # the country code stays
    lead = m[0] if m else ""
    return lead + p.digits(s[len(lead):], f"phone{lead}")


def card(p: Permuter, s: str) -> str | None:
    d = "".join(c for c in s if c.isdigit())
    if luhn_digit(d[:-1]) != d[-1] or len(set(d)) == 1:
        return None
    head = p.digits(d[:-1], "card")
    return refill(s, head + luhn_digit(head))


def iban(p: Permuter, s: str) -> str | None:
    flat = s.replace(" ", "")
    if not 15 <= len(flat) <= 34 or mod97(flat[4:] + flat[:4]) != 1:
        return None
    body = p.characters(flat[4:], "iban")
    new = iter(flat[:2] + str(98 - mod97(body + flat[:2] + "00")).zfill(2) + body)
    return "".join(c if c == " " else next(new) for c in s)


RULES: dict[str, Callable[[Permuter, str], str | None]] = {"secret": secret, "email": email, "ip": ip, "date": date, "ssn": ssn, "phone": phone, "card": card, "iban": iban}


def hide(text: str, p: Permuter) -> tuple[str, list[str]]:
    """The text with every valid value replaced, and the kinds found in order. An invalid match is passed over by one sign, so a value inside it is still found."""
    if not HINT.search(text):
        return text, []
    out, kinds, done, at = [], [], 0, 0
    while m := FOUND.search(text, at):
        kind = next(k for k in RULES if m[k] is not None)
        if kind in ("secret", "email") or m[0].isascii():
            new = RULES[kind](p, m[0])
        elif new := RULES[kind](p, ascii_digits(m[0])):
            new = as_written(m[0], new)
        if new is None:
            at = next((i for i in range(m.start() + 1, m.end()) if not text[i].isdigit() or not text[i - 1].isdigit()), m.end())
            continue
        out += [text[done:m.start()], new]
        kinds.append(kind)
        done = at = m.end()
    return "".join([*out, text[done:]]) if kinds else text, kinds


def pseudonymised(docs: DataFrame, text: str = "text", key: str = "documents", found: str | None = "found") -> DataFrame:
    """All rows and columns with pseudonyms in ``text``; ``found`` adds how many values of each kind were replaced (map, replaces a column of that name).

    Null texts stay null and empty ones empty; every row is treated by itself, so repeated rows stay equal; no rows give no rows. Texts are
    searched whole. The key is the secret: who has it can undo the pseudonyms.
    """
    docs = docs.drop(found) if found else docs
    at, names, secret_key = docs.columns.index(text), [*docs.columns, *([found] if found else [])], key.encode()
    kind = pa.map_(pa.string(), pa.int32())

    def run(batches: Iterator[pa.RecordBatch]) -> Iterator[pa.RecordBatch]:
        p = Permuter(secret_key)
        for b in batches:
            got = [(None, []) if t is None else hide(t, p) for t in b.column(at).to_pylist()]
            columns = list(b.columns)
            columns[at] = pa.array([t for t, _ in got], pa.string())
            if found:
                columns.append(pa.array([sorted((k, ks.count(k)) for k in set(ks)) for _, ks in got], kind))
            yield pa.record_batch(columns, names)

    schema = StructType([*docs.schema.fields, StructField(found, MapType(StringType(), IntegerType()))]) if found else docs.schema
    return docs.mapInArrow(run, schema)


@query("op4_feistel_pseudonyms")
def op4_feistel_pseudonyms(spark: SparkSession, sf_dir: str) -> DataFrame:
    got = pseudonymised(table(spark, sf_dir, "documents").select("doc_id", "text"))
    counts = [F.coalesce(F.col("found")[k], F.lit(0)).cast("long").alias(f"n_{k}") for k in RULES]
    return got.select("doc_id", "text", *counts)
