"""Keyed permutations of whole numbers and of the formats that map to them."""

from __future__ import annotations

import datetime as dt
import string
from hashlib import blake2b

ROUNDS = 8


class Permutation:
    """A keyed permutation of 0 … n-1 that leaves no value in place (for n above 1).

    A Feistel network permutes the next power of four; values beyond n walk on until they fall
    below it. A value moves to its successor in that secret order.
    """

    def __init__(self, key: bytes, context: str, n: int):
        self.n = n
        self.half = max(1, ((n - 1).bit_length() + 1) // 2)
        self.mask = (1 << self.half) - 1
        self.size = (self.half + 7) // 8
        self.prefix = [
            blake2b(f"{context}|{n}|{r}".encode(), key=blake2b(key).digest(), digest_size=32).digest() for r in range(ROUNDS)
        ]

    def _round(self, r: int, x: int) -> int:
        out, count = b"", 0
        while len(out) < self.size:
            out += blake2b(x.to_bytes(self.size, "big") + bytes([count % 256]), key=self.prefix[r]).digest()
            count += 1
        return int.from_bytes(out[: self.size], "big") & self.mask

    def _once(self, x: int, rounds: range, inverse: bool) -> int:
        a, b = x >> self.half, x & self.mask
        for r in rounds:
            if inverse:
                a, b = b ^ self._round(r, a), a
            else:
                a, b = b, a ^ self._round(r, b)
        return a << self.half | b

    def _walk(self, x: int, inverse: bool) -> int:
        order = range(ROUNDS - 1, -1, -1) if inverse else range(ROUNDS)
        while True:
            x = self._once(x, order, inverse)
            if x < self.n:
                return x

    def move(self, x: int, step: int = 1) -> int:
        """The value that takes the place of ``x``; ``step=-1`` undoes it."""
        return self._walk((self._walk(x, False) + step) % self.n, True)


class Mixed:
    """Numbers whose digits each have their own alphabet."""

    def __init__(self, alphabets: list[str]):
        self.alphabets = alphabets
        self.n = 1
        for a in alphabets:
            self.n *= len(a)

    def number(self, text) -> int:
        x = 0
        for c, a in zip(text, self.alphabets, strict=True):
            x = x * len(a) + a.index(c)
        return x

    def text(self, x: int) -> str:
        out = []
        for a in reversed(self.alphabets):
            x, i = divmod(x, len(a))
            out.append(a[i])
        return "".join(reversed(out))


def alphabet(c: str) -> str:
    for a in (string.digits, string.ascii_lowercase, string.ascii_uppercase):
        if c in a:
            return a
    return c


def luhn_sum(digits: str) -> int:
    """The Luhn sum of a whole number, check digit included."""
    total = 0
    for i, c in enumerate(reversed(digits)):
        d = int(c) * (1 + i % 2)
        total += d - 9 if d > 9 else d
    return total


def iban_value(iban: str) -> int:
    return int("".join(str(int(c, 36)) for c in iban[4:] + iban[:4]))


FIRST_DAY = dt.date(1900, 1, 1).toordinal()
DAYS = dt.date(2099, 12, 31).toordinal() - FIRST_DAY + 1
