"""Comparisons that are false, not null and not true, for missing or NaN operands.

Spark orders NaN above every number, so a bare ``value >= limit`` would flag NaN as an
exceedance. Detectors and rules here treat NaN and null as "cannot tell".
"""

from __future__ import annotations

from pyspark.sql import Column
from pyspark.sql import functions as F


def _usable(value: Column) -> Column:
    return value.isNotNull() & ~F.isnan(value)


def _guard(value: Column, test: Column) -> Column:
    return F.coalesce(test & ~F.isnan(value), F.lit(False))


def at_least(value: Column, bound) -> Column:
    return _guard(value, value >= bound)


def at_most(value: Column, bound) -> Column:
    return _guard(value, value <= bound)


def above(value: Column, bound) -> Column:
    return _guard(value, value > bound)


def below(value: Column, bound) -> Column:
    return _guard(value, value < bound)


def is_filled(value: Column) -> Column:
    """True when a text field holds something other than blanks."""
    return F.coalesce(F.length(F.trim(value.cast("string"))) > 0, F.lit(False))


def clamp(value: Column, low, high) -> Column:
    """Value limited to the physical range; NaN and null pass through unchanged."""
    low, high = _lit(low), _lit(high)
    return F.when(_usable(value), F.greatest(low, F.least(high, value))).otherwise(value)


def _lit(bound) -> Column:
    return bound if isinstance(bound, Column) else F.lit(float(bound))
