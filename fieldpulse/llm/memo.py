"""Answers kept by unit of text."""

from __future__ import annotations


class Memo(dict):
    """Answers by unit, kept for the most recent ``2 * size`` units and computed again otherwise."""

    def __init__(self, compute, size: int = 300_000):
        self.compute, self.size, self.old = compute, size, {}

    def __missing__(self, unit):
        value = self.old.get(unit)
        if value is None:
            value = self.compute(unit)
        if len(unit) <= 64:
            if len(self) >= self.size:
                self.old = dict(self)
                self.clear()
            self[unit] = value
        return value
