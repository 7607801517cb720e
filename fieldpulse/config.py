"""Detector settings per environment."""

from __future__ import annotations

from dataclasses import dataclass, replace


@dataclass(frozen=True)
class DetectorConfig:
    """Limits and window sizes of the three detectors (defaults are fixed values)."""

    critical_high: float = 120.0
    warning_high: float = 100.0
    critical_low: float = 5.0
    warning_low: float = 10.0
    window_size: int = 50
    deviation_threshold: float = 3.0
    max_rate: float = 10.0
    rate_window_s: int = 60

    def __post_init__(self) -> None:
        if self.window_size < 1:
            raise ValueError("window_size must be at least 1")
        if self.deviation_threshold <= 0 or self.max_rate <= 0 or self.rate_window_s <= 0:
            raise ValueError("deviation_threshold, max_rate and rate_window_s must be positive")

    def with_(self, **changes) -> DetectorConfig:
        return replace(self, **changes)


DEV = DetectorConfig()
STAGING = DetectorConfig(window_size=100)
PROD = DetectorConfig(window_size=200, deviation_threshold=3.5)
PRESETS = {"dev": DEV, "staging": STAGING, "prod": PROD}
