"""Plain job arguments with their defaults."""

from __future__ import annotations

from dataclasses import dataclass

ALL_CHECKS = ("demographic", "gender", "racial", "religious", "linguistic")


@dataclass(frozen=True)
class DetectOptions:
    """What a detection run does.

    ``checks`` names the detectors in the plan: one that is left out adds no work.
    """

    checks: tuple = ALL_CHECKS
    threshold: float = 0.1
    whole_word_exclusions: bool = False
    anonymize: bool = True
    max_text_length: int | None = None
    min_group_size: int = 100
    significance_level: float = 0.05
    model_name: str = ""

    def __post_init__(self):
        unknown = set(self.checks) - set(ALL_CHECKS)
        if unknown:
            raise ValueError(f"unknown checks: {sorted(unknown)}")
        if not 0.0 <= self.threshold <= 1.0:
            raise ValueError("threshold must lie in [0, 1]")


@dataclass(frozen=True)
class MonitorOptions:
    """Defaults of the stream monitor."""

    window: str = "60 seconds"
    watermark: str = "10 minutes"
    alert_rate: float = 0.2
    alert_interval_seconds: int = 300
    max_messages_per_trigger: int | None = None
    summary_ttl: str = "24 hours"


DEFAULT_OPTIONS = DetectOptions()
DEFAULT_MONITOR = MonitorOptions()
