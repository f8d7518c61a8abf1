"""Tunables of the batch and streaming jobs."""

from __future__ import annotations

from dataclasses import dataclass, field

# Business constants that results depend on.
IN_STOCK_LEVEL = 200
TARGET_STOCK = 200
REORDER_THRESHOLD = 50
SUPPLIER_EMAIL = "supplier@example.com"
SURGE_PROBABILITY = 0.5
MIN_WINDOW_BASELINE = 0.01
SECONDS_PER_DAY = 86400.0
HISTORY_STEPS = 50
HISTORY_FEATURES = 4
TOP_SKUS = 30
TICKER_EVENTS = 1000
MESSAGE_CHARS = 80


@dataclass(frozen=True)
class PricingConfig:
    """How far a surge may move a price."""

    # The published defaults, on which results depend.
    elasticity_coeff: float = 0.35
    max_uplift_pct: float = 0.25
    surge_threshold: float = 2.0


@dataclass(frozen=True)
class DisplayConfig:
    """How a computed price is shown."""

    # The published defaults, on which results depend.
    enabled: bool = True
    charm_ending: float = 0.99
    floor_pct: float = 0.0


@dataclass(frozen=True)
class SpeedConfig:
    """The streaming job: window length, lateness, history lifetime, back-pressure."""

    window_seconds: int = 60
    watermark: str = "2 minutes"
    history_ttl_seconds: int = 2 * 60 * 60
    max_records_per_trigger: int = 10_000
    max_files_per_trigger: int = 16
    deduplicate: bool = False  # drop events that arrive again within the watermark
    pricing: PricingConfig = field(default_factory=PricingConfig)
    display: DisplayConfig = field(default_factory=DisplayConfig)
    reorder_threshold: int = REORDER_THRESHOLD
