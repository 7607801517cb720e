"""Personal data replaced by format-preserving pseudonyms.

Values are found by their form, checked (Luhn and mod-97 digits, number ranges, the calendar)
and replaced through a keyed permutation of their own format: a card number stays a valid card
number, a date a date. Equal values get equal pseudonyms in all documents, different values of a
format different ones, none keeps its value, and whoever has the key can go back.

Covered: e-mail addresses, payment cards, IBANs, telephone and US social security numbers, IPv4
addresses, dates from 1900 to 2099, keys of a known form (AKIA, gh?_, sk-), and the values that
``:`` or ``=`` assigns to a name ending in password, passwd, pwd, token, secret, api key or access
key. Such a value goes up to its closing quote on the line, or to white space; its ASCII letters
and digits are moved, all other characters stay in place.

Not covered: values without a name, after another name, on another line or more than three blanks
away; what follows white space in an unquoted value; letters outside ASCII; an unquoted word of
fewer than six lower-case letters; after ``:`` and a name other than a password's, an unquoted
plain word of letters ("the secret: everything").
"""

from __future__ import annotations

import datetime as dt
import re
import secrets
from functools import lru_cache

import pyarrow as pa
from pyspark.sql import DataFrame, SparkSession
from pyspark.sql import functions as F
from pyspark.sql import types as T

from fieldpulse.llm.feistel import DAYS, FIRST_DAY, Mixed, Permutation, alphabet, iban_value, luhn_sum
from fieldpulse.llm.memo import Memo
from fieldpulse.llm.tables import pieces, table

PIECE = 1 << 21
KEY_SETTING = "spark.fieldpulse.pseudonym.key"
DIGITS = "0123456789"
HEX = "0123456789abcdef"
LONG = 128

_LEFT = re.compile(r"[A-Za-z0-9](?:[A-Za-z0-9._%+-]{0,62}[A-Za-z0-9_%+-])?$")
_RIGHT = re.compile(r"[A-Za-z0-9](?:[A-Za-z0-9-]*[A-Za-z0-9])?(?:\.[A-Za-z0-9](?:[A-Za-z0-9-]*[A-Za-z0-9])?)+")
_IBAN = re.compile(r"(?<![A-Za-z0-9])[A-Z]{2}\d{2}(?: ?[A-Z0-9]{4}){2,7}(?: ?[A-Z0-9]{1,4})?(?![A-Za-z0-9])")
_CARD = re.compile(r"(?<![\d+])(?:\d{13,19}|\d{4}([ -])\d{4}\1\d{4}\1\d{1,7}|\d{4}([ -])\d{6}\2\d{5})(?!\d)")
_IP = re.compile(r"(?<![\d.])\d{1,3}\.\d{1,3}\.\d{1,3}\.\d{1,3}(?!\.?\d)")
_DATE = re.compile(r"(?<!\d)(?:\d{4}([-/.])\d{1,2}\1\d{1,2}|\d{1,2}([-/.])\d{1,2}\2\d{4})(?!\d)")
_SSN = re.compile(r"(?<![\d-])\d{3}-\d{2}-\d{4}(?![\d-])")
_NANP = re.compile(r"(?<![\w+])(?:\+?1[ .-]?)?(?:\(\d{3}\)[ .-]?|\d{3}[ .-])\d{3}[ .-]?\d{4}(?!\d)")
_PHONE = re.compile(r"(?<![\w+])\+\d{1,15}(?:[ .-]\d{1,14}|[ .-]?\(\d{1,5}\)){0,6}(?!\d)")
_NAMED = re.compile(r"(?i)(?:(password|passwd|pwd)|token|secret|api[_-]?key|access[_-]?key)(?:\\?[\"'])?[ \t]{0,3}\Z")
_SIGN = re.compile(r":=|=>|={1,3}|:")
_QUOTED = re.compile(
    r"""[ \t]{0,3}(?:"((?:[^"\\\r\n]|\\[^\r\n])*)"|'((?:[^'\\\r\n]|\\[^\r\n])*)'|\\"((?:(?!\\")[^\r\n])*)\\"|\\'((?:(?!\\')[^\r\n])*)\\')"""
)
_OPEN = re.compile(r"[ \t]{0,3}(\S+)")
_WORD = re.compile(r"[A-Za-z]+(?:['’-][A-Za-z]+)*")
_ALNUM = re.compile(r"[A-Za-z0-9]")
_SHORT = 6
_BARE_KEY = re.compile(r"(?<![A-Za-z0-9])(?:AKIA[0-9A-Z]{16}|gh[pousr]_[A-Za-z0-9]{36}|sk-[A-Za-z0-9]{20,})(?![A-Za-z0-9])")


class Pseudonyms:
    def __init__(self, key: bytes, step: int = 1):
        self.key, self.step = key, step
        self.permutation = lru_cache(maxsize=2048)(lambda context, n: Permutation(key, context, n))
        self.memo = Memo(lambda item: getattr(self, f"_{item[0]}")(item[1]), 50_000)

    def _moved(self, context: str, mixed: Mixed, text: str) -> str:
        return mixed.text(self.permutation(context, mixed.n).move(mixed.number(text), self.step))

    def _shaped(self, context: str, text: str) -> str:
        """Letters and digits moved within their kinds; all else stays."""
        at = [i for i, c in enumerate(text) if c.isascii() and c.isalnum()]
        own = [text[i] for i in at]
        mixed = Mixed([alphabet(c) for c in own])
        out = list(text)
        shape = "".join(map(len_name, mixed.alphabets))
        for i, c in zip(at, self._moved(f"{context}|{shape}", mixed, own), strict=True):
            out[i] = c
        return "".join(out)

    @staticmethod
    def _refilled(text: str, digits: str) -> str:
        rest = iter(digits)
        return "".join(next(rest) if c in DIGITS else c for c in text)

    # One rule per kind: the pseudonym, or None where the value is not valid.

    def _email(self, text: str) -> str | None:
        name, _, host = text.rpartition("@")
        return f"{self._shaped(f'email|{host.lower()}', name)}@{host}"

    def _iban(self, text: str) -> str | None:
        plain = text.replace(" ", "")
        if not 15 <= len(plain) <= 34 or iban_value(plain) % 97 != 1:
            return None
        body = self._shaped(f"iban|{plain[:2]}", plain[4:])
        check = 98 - iban_value(f"{plain[:2]}00{body}") % 97
        rest = iter(f"{plain[:2]}{check:02d}{body}")
        return "".join(c if c == " " else next(rest) for c in text)

    def _card(self, text: str) -> str | None:
        digits = "".join(c for c in text if c in DIGITS)
        if not 13 <= len(digits) <= 19 or luhn_sum(digits) % 10 or len(set(digits)) == 1:
            return None
        inner = self._moved(f"card|{digits[0]}", Mixed([DIGITS] * (len(digits) - 2)), digits[1:-1])
        check = -luhn_sum(f"{digits[0]}{inner}0") % 10
        return self._refilled(text, f"{digits[0]}{inner}{check}")

    def _ip(self, text: str) -> str | None:
        parts = text.split(".")
        if any(int(p) > 255 or (len(p) > 1 and p[0] == "0") for p in parts) or parts[0] == "0":
            return None
        x = 0
        for p, base in zip(parts, (255, 256, 256, 256), strict=True):
            x = x * base + int(p) - (base == 255)
        x = self.permutation("ip", 255 << 24).move(x, self.step)
        return f"{(x >> 24) + 1}.{x >> 16 & 255}.{x >> 8 & 255}.{x & 255}"

    def _date(self, text: str) -> str | None:
        mark = next(c for c in text if c not in DIGITS)
        a, b, c = (text.split(mark))
        if len(a) == 4:
            order = "ymd"
        elif int(b) > 12:
            order = "mdy"
        else:
            order = "mdy" if mark == "/" and int(a) <= 12 else "dmy"
        part = dict(zip(order, (a, b, c), strict=True))
        try:
            day = dt.date(int(part["y"]), int(part["m"]), int(part["d"])).toordinal() - FIRST_DAY
        except ValueError:
            return None
        if not 0 <= day < DAYS:
            return None
        padded = not any(len(part[x]) == 1 for x in "md")
        late = order == ("dmy" if mark == "/" else "mdy")  # told from the usual order by a day above 12
        move = self.permutation(f"date|{order}{mark}", DAYS).move
        while True:  # walks on within the dates that are read in the same way
            day = move(day, self.step)
            new = dt.date.fromordinal(FIRST_DAY + day)
            if (not late or new.day > 12) and (padded or min(new.day, new.month) < 10):
                break
        made = {"y": f"{new.year:04d}", "m": f"{new.month:02d}" if padded else str(new.month),
                "d": f"{new.day:02d}" if padded else str(new.day)}
        return mark.join(made[x] for x in order)

    def _ssn(self, text: str) -> str | None:
        area, group, serial = (int(x) for x in text.split("-"))
        if area in (0, 666) or area >= 900 or not group or not serial:
            return None
        areas = [a for a in range(1, 900) if a != 666]
        x = (areas.index(area) * 99 + group - 1) * 9999 + serial - 1
        x = self.permutation("ssn", len(areas) * 99 * 9999).move(x, self.step)
        x, serial = divmod(x, 9999)
        area, group = divmod(x, 99)
        return f"{areas[area]:03d}-{group + 1:02d}-{serial + 1:04d}"

    def _nanp(self, text: str) -> str | None:
        digits = "".join(c for c in text if c in DIGITS)
        lead, own = digits[:-10], digits[-10:]
        if own[0] in "01" or own[3] in "01":
            return None
        mixed = Mixed([DIGITS[2:], DIGITS, DIGITS, DIGITS[2:], *[DIGITS] * 6])
        return self._refilled(text, lead + self._moved("nanp", mixed, own))

    def _phone(self, text: str) -> str | None:
        digits = "".join(c for c in text if c in DIGITS)
        if not 8 <= len(digits) <= 15:
            return None
        lead = len(re.match(r"\+(\d{1,3})", text)[1])
        lead = min(lead, 2) if len(digits) - lead < 6 else lead
        mixed = Mixed([DIGITS] * (len(digits) - lead))
        return self._refilled(text, digits[:lead] + self._moved(f"phone|{digits[:lead]}", mixed, digits[lead:]))

    def _secret(self, text: str) -> str | None:
        if len(text) > LONG:  # a piece of its own context each, so that time follows the length
            return "".join(self._secret(text[i : i + LONG]) for i in range(0, len(text), LONG))
        if not _ALNUM.search(text):
            return text
        if not _is_hex(text):
            new = self._shaped("secret", text)
            while _is_hex(new):  # walks on, so that the way back takes the same rule
                new = self._shaped("secret", new)
            return new
        mixed, new = Mixed([HEX] * len(text)), text
        while new == text or not _is_hex(new):  # walks on within the values of letters and digits
            new = self._moved("hex", mixed, new)
        return new

    # ---- texts

    @staticmethod
    def _assigned(text: str):
        """(start, end) of the values assigned to names of secrets, from first to last letter or digit."""
        at = last = 0
        while sign := _SIGN.search(text, at):
            at = sign.end()
            named = _NAMED.search(text, max(last, sign.start() - 24), sign.start())
            if not named:
                continue
            quoted = _QUOTED.match(text, at)
            found = quoted or _OPEN.match(text, at)
            if not found:
                continue
            start, end = found.span(found.lastindex)
            bare = not quoted and text[start] not in "\"'\\"
            while start < end and not _ALNUM.match(text[start]):
                start += 1
            while start < end and not _ALNUM.match(text[end - 1]):
                end -= 1
            if start == end:
                continue
            if bare and _WORD.fullmatch(text, start, end):
                if not (named[1] or "=" in sign[0]) or (end - start < _SHORT and text[start:end].islower()):
                    continue
            yield start, end
            at = last = end

    def _found(self, text: str):
        """(start, end, kind), the more specific kinds first; an assigned secret is taken whole."""
        for start, end in self._assigned(text):
            yield start, end, "secret"
        at = text.find("@")
        while at >= 0:
            left, right = _LEFT.search(text, max(0, at - 64), at), _RIGHT.match(text, at + 1)
            if left and right:
                yield left.start(), right.end(), "email"
            at = text.find("@", at + 1)
        for kind, pattern in (
            ("iban", _IBAN), ("card", _CARD), ("ip", _IP), ("date", _DATE), ("ssn", _SSN), ("nanp", _NANP),
            ("phone", _PHONE), ("secret", _BARE_KEY),
        ):
            for m in pattern.finditer(text):
                yield m.start(), m.end(), kind
    def replace(self, text: str) -> tuple[str, list[tuple[int, int, str]]]:
        """The text with pseudonyms, and the (start, end, kind) of what was replaced."""
        taken: list[tuple[int, int, str, str]] = []
        for start, end, kind in self._found(text):
            new = self.memo[kind, text[start:end]]
            if new is not None and new != text[start:end]:
                taken.append((start, end, kind, new))
        if not taken:
            return text, []
        out, spans, last = [], [], 0
        rank = {id(x): i for i, x in enumerate(taken)}
        chosen: list[tuple[int, int, str, str]] = []
        for item in sorted(taken, key=lambda x: (x[0], rank[id(x)])):
            if chosen and item[0] < chosen[-1][1]:  # of overlapping values, the more specific kind
                if rank[id(item)] >= rank[id(chosen[-1])]:
                    continue
                chosen.pop()
            chosen.append(item)
        for start, end, kind, new in chosen:
            out += [text[last:start], new]
            spans.append((start, end, kind))
            last = end
        return "".join([*out, text[last:]]), spans


def _is_hex(text: str) -> bool:
    return len(text) >= 8 and all(c in HEX for c in text) and not text.isdigit() and not text.isalpha()


def len_name(alphabet_: str) -> str:
    return "9" if len(alphabet_) == 10 else alphabet_[0]


def pseudonymised(
    docs: DataFrame, key: bytes, text: str = "text", spans: str | None = None, step: int = 1
) -> DataFrame:
    """``docs`` with pseudonyms in the text; null texts stay null.

    ``spans``: name of a further column for what was replaced, (start, end, kind) in characters
    of the source. ``step=-1`` with the same key restores the values.
    """
    if spans in docs.columns:
        raise ValueError(f"the column {spans} exists already; name another")
    at = docs.columns.index(text)
    fields = list(docs.schema.fields)
    fields[at] = T.StructField(text, T.StringType())
    kind = T.ArrayType(T.StructType.fromDDL("start int, end int, kind string"))
    if spans:
        fields.append(T.StructField(spans, kind))
    arrow = pa.list_(pa.struct([("start", pa.int32()), ("end", pa.int32()), ("kind", pa.string())]))

    def run(batches):
        own = Pseudonyms(key, step)
        for batch in pieces(batches, PIECE, text):
            done = [(None, []) if t is None else own.replace(t) for t in batch.column(at).to_pylist()]
            columns = list(batch.columns)
            columns[at] = pa.array([d[0] for d in done], pa.string())
            if spans:
                columns.append(pa.array([[dict(zip(("start", "end", "kind"), s, strict=True)) for s in d[1]] for d in done], arrow))
            yield pa.RecordBatch.from_arrays(columns, names=[f.name for f in fields])

    return docs.mapInArrow(run, T.StructType(fields))


def session_key(spark: SparkSession) -> bytes:
    """The key that the session names. Where it names none, a new random key for this call: equal
    values stay linked within its result, and nobody can undo or continue it afterwards."""
    named = spark.conf.get(KEY_SETTING, "")
    return named.encode() if named else secrets.token_bytes(32)


def op2_feistel_pseudonyms(spark: SparkSession, sf_dir: str) -> DataFrame:
    docs = table(spark, sf_dir, "documents").select("doc_id", "text")
    found = pseudonymised(docs, session_key(spark), spans="replaced")
    return found.select("doc_id", "text", F.size("replaced").cast("long").alias("n_replaced"))
