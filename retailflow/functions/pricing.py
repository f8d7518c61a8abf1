"""Price decision as column expressions: baseline scaling, surge test, uplift, presentation."""

from __future__ import annotations

from pyspark.sql import Column
from pyspark.sql import functions as F

from retailflow.config import (
    MIN_WINDOW_BASELINE,
    SECONDS_PER_DAY,
    SURGE_PROBABILITY,
    DisplayConfig,
    PricingConfig,
)
from retailflow.functions.numeric import round2


def window_baseline(daily: Column, window_seconds: int) -> Column:
    """Daily demand scaled to one window; 0 where there is no positive forecast."""
    scaled = daily * F.lit(window_seconds / SECONDS_PER_DAY)
    return F.when(daily > 0, F.greatest(scaled, F.lit(MIN_WINDOW_BASELINE))).otherwise(F.lit(0.0))


def demand_ratio(velocity: Column, baseline: Column) -> Column:
    """Velocity over baseline, NULL without a baseline."""
    return velocity / F.nullif(baseline, F.lit(0.0))


def surge_flag(prob: Column, velocity: Column, baseline: Column, cfg: PricingConfig = PricingConfig()) -> Column:
    """Surge needs the classifier, a baseline and a ratio above the threshold."""
    return F.coalesce(
        (prob >= SURGE_PROBABILITY)
        & (baseline > 0)
        & (demand_ratio(velocity, baseline) > cfg.surge_threshold),
        F.lit(False),
    )


def uplift(
    velocity: Column,
    baseline: Column,
    elasticity: Column,
    is_surge: Column,
    cfg: PricingConfig = PricingConfig(),
) -> Column:
    """Relative price increase; 0 unless a surge is above the threshold."""
    ratio = demand_ratio(velocity, baseline)
    independence = F.lit(1.0) - F.least(F.greatest(elasticity, F.lit(0.0)), F.lit(1.0))
    raw = F.lit(cfg.elasticity_coeff) * (ratio - F.lit(cfg.surge_threshold)) * independence
    active = is_surge & (baseline > 0) & (ratio > cfg.surge_threshold)
    return F.when(active, F.least(raw, F.lit(cfg.max_uplift_pct))).otherwise(F.lit(0.0))


def economic_price(base: Column, lift: Column) -> Column:
    return round2(base * (F.lit(1.0) + lift))


def dynamic_price(
    base: Column,
    velocity: Column,
    baseline: Column,
    elasticity: Column,
    is_surge: Column,
    cfg: PricingConfig = PricingConfig(),
) -> Column:
    return economic_price(base, uplift(velocity, baseline, elasticity, is_surge, cfg))


def charm_price(price: Column, ending: float = 0.99) -> Column:
    """Largest price with the given ending that does not exceed the input, never negative."""
    whole = F.floor(price).cast("double")
    same_unit = whole + F.lit(ending)
    below = (whole - F.lit(1.0)) + F.lit(ending)
    return round2(F.greatest(F.when(same_unit > price, below).otherwise(same_unit), F.lit(0.0)))


def pct_change(new: Column, base: Column) -> Column:
    return F.when(base != 0, round2((new - base) / F.nullif(base, F.lit(0.0)) * 100)).otherwise(F.lit(0.0))


def present_price(new: Column, base: Column, cfg: DisplayConfig = DisplayConfig()) -> Column:
    """struct(display_price, anchor_price, pct_change, note)."""
    if not cfg.enabled:
        return F.struct(
            round2(new).alias("display_price"),
            F.lit(None).cast("double").alias("anchor_price"),
            pct_change(new, base).alias("pct_change"),
            F.lit("raw").alias("note"),
        )
    guarded = F.greatest(new, base * F.lit(1 + cfg.floor_pct))
    moved = F.abs(guarded - base) >= 0.01
    shown = charm_price(guarded, cfg.charm_ending)
    return F.struct(
        shown.alias("display_price"),
        F.when(moved, round2(base)).alias("anchor_price"),
        pct_change(shown, base).alias("pct_change"),
        F.when(moved & (guarded > base), "surge-premium")
        .when(moved, "adjusted")
        .otherwise("baseline")
        .alias("note"),
    )


def reason_text(prob: Column, note: Column, anchor: Column) -> Column:
    """Fixed format of the decision explanation; an absent anchor reads 'None'."""
    return F.format_string(
        "surge_prob=%.2f note=%s anchor=%s",
        F.bround(prob, 2),
        note,
        F.coalesce(anchor.cast("string"), F.lit("None")),
    )
