"""Banding and display labels."""

from __future__ import annotations

from collections.abc import Mapping, Sequence

from pyspark.sql import Column
from pyspark.sql import functions as F

# Colour steps of the dashboard panels. The first step has no lower bound.
BANDS: dict[str, list[tuple[float | None, str]]] = {
    "active_platforms": [(None, "red"), (1, "yellow"), (5, "green")],
    "sensors_online": [(None, "red"), (10, "yellow"), (50, "green")],
    "active_alerts": [(None, "green"), (5, "yellow"), (15, "orange"), (30, "red")],
    "critical_alerts": [(None, "green"), (1, "red")],
    "readings_per_sec": [(None, "red"), (10, "yellow"), (50, "green")],
    "platform_alerts": [(None, "green"), (3, "yellow"), (10, "orange"), (20, "red")],
    "platform_sensors": [(None, "red"), (1, "yellow"), (5, "green")],
    "resolution_minutes": [(None, "green"), (30, "yellow"), (60, "orange"), (120, "red")],
    "sensor_alerts": [(None, "green"), (5, "yellow"), (10, "orange"), (20, "red")],
    "value_gauge": [(None, "green"), (70, "yellow"), (90, "red")],
    "time_spread": [(None, "green"), (5, "yellow"), (15, "orange"), (30, "red")],
    "consumer_lag": [(None, "green"), (100, "yellow"), (1000, "orange"), (10000, "red")],
    "queue_depth": [(None, "green"), (100, "yellow"), (1000, "red")],
    "readings_last_minute": [(None, "red"), (100, "yellow"), (500, "green")],
    "component_queue": [(None, "green"), (50, "yellow"), (200, "orange"), (500, "red")],
    "component_rate": [(None, "red"), (1, "yellow"), (10, "green")],
}

# How a resolved flag is shown.
RESOLVED_LABELS = {"false": "OPEN", "true": "RESOLVED"}


def band(value: Column, steps: str | Sequence[tuple[float | None, str]]) -> Column:
    """Name of the highest step whose lower bound the value reaches; null stays null."""
    ordered = sorted(
        BANDS[steps] if isinstance(steps, str) else steps,
        key=lambda step: float("-inf") if step[0] is None else step[0],
        reverse=True,
    )
    chosen = None
    for bound, name in ordered:
        test = value.isNotNull() if bound is None else value >= bound
        chosen = F.when(test, name) if chosen is None else chosen.when(test, name)
    return chosen


def label_map(value: Column, mapping: Mapping[str, str]) -> Column:
    """Display text of a boolean or enum; values without a label show as they are."""
    text = value.cast("string")
    chosen = None
    for raw, label in mapping.items():
        chosen = F.when(text == raw, label) if chosen is None else chosen.when(text == raw, label)
    return text if chosen is None else chosen.otherwise(text)
