"""Price carry-over between windows, vectorised where rows are independent."""

from __future__ import annotations

import numpy as np

from retailflow.config import MIN_WINDOW_BASELINE, SECONDS_PER_DAY, DisplayConfig, SpeedConfig


def _cents(x):
    return np.floor(x * 100 + 0.5) / 100.0


def surge_uplift(velocity, daily, elasticity, cfg: SpeedConfig = SpeedConfig()):
    """(whether demand surges, uplift if it does) of windows; the same arithmetic as the column expressions."""
    scaled = np.maximum(daily * (cfg.window_seconds / SECONDS_PER_DAY), MIN_WINDOW_BASELINE)
    baseline = np.where(daily > 0, scaled, 0.0)
    ratio = np.divide(velocity, baseline, out=np.zeros(len(baseline)), where=baseline > 0)
    surging = (baseline > 0) & (ratio > cfg.pricing.surge_threshold)
    independence = 1.0 - np.minimum(np.maximum(elasticity, 0.0), 1.0)
    raw = cfg.pricing.elasticity_coeff * (ratio - cfg.pricing.surge_threshold) * independence
    return surging, np.where(surging, np.minimum(raw, cfg.pricing.max_uplift_pct), 0.0)


def shown_price(base, lift, cfg: DisplayConfig = DisplayConfig()):
    """Displayed price of a window; the same arithmetic as the column expressions."""
    new = _cents(base * (1.0 + lift))
    if not cfg.enabled:
        return _cents(new)
    guarded = np.maximum(new, base * (1 + cfg.floor_pct))
    whole = np.floor(guarded)
    same_unit = whole + cfg.charm_ending
    candidate = np.where(same_unit > guarded, (whole - 1.0) + cfg.charm_ending, same_unit)
    return _cents(np.maximum(candidate, 0.0))


def carry_base_prices(items, live, stored, lift, cfg: DisplayConfig = DisplayConfig(), carried=None):
    """Base and shown price per row for rows sorted by (item, window).

    A live price sets the base. Without one the base is the price shown in the item's previous
    window, then the stored price, then 0. ``carried`` is (item, shown price) of the row before the
    first one; the pair for the next chunk is returned with the result.

    Rows from a known base to the next are a stretch, and stretches are independent. A price that is
    shown again unchanged where nothing lifts it holds until the next lifted row, so a round prices
    one row of every stretch and fills the rows up to its next change.
    """
    n = len(items)
    base, shown = np.empty(n), np.empty(n)
    if not n:
        return base, shown, carried
    known = ~np.isnan(live)
    opens = np.append(True, items[1:] != items[:-1])
    start = np.where(known, live, np.where(np.isnan(stored), 0.0, stored))
    if carried is not None and carried[0] == items[0] and not known[0]:
        start[0] = carried[1]
    row = np.flatnonzero(known | opens)
    end = np.append(row[1:], n)
    price = start[row]
    lifted = np.append(np.where(lift != 0, np.arange(n), n), n)
    next_lifted = np.minimum.accumulate(lifted[::-1])[::-1]
    while len(row):
        new = shown_price(price, lift[row], cfg)
        base[row], shown[row] = price, new
        holds = shown_price(new, 0.0, cfg) == new
        change = np.minimum(np.where(holds, next_lifted[row + 1], row + 1), end)
        held = change - row - 1
        place = np.arange(held.sum()) - np.repeat(np.cumsum(held) - held, held) + np.repeat(row + 1, held)
        base[place] = shown[place] = np.repeat(new, held)
        open_still = change < end
        row, end, price = change[open_still], end[open_still], new[open_still]
    return base, shown, (items[-1], shown[-1])


def closing_price(price: float, lifts, runs, cfg: DisplayConfig = DisplayConfig()) -> float:
    """Shown price of the last row of rows without a live price, the first of which opens with ``price``.

    ``runs`` counts the rows without a lift before each lifted row, and after the last one. A price that is
    shown again unchanged holds for the rest of a run.
    """
    for k, run in enumerate(runs):
        for _ in range(int(run)):
            new = float(shown_price(price, 0.0, cfg))
            if new == price:
                break
            price = new
        if k < len(lifts):
            price = float(shown_price(price, lifts[k], cfg))
    return price


class PieceSummary:
    """What consecutive rows of an item do to the price that they open with."""

    def __init__(self, name: tuple[int, int], stored: float):
        self.name, self.stored, self.closing = name, stored, np.nan
        self.lifts: list[float] = []
        self.runs: list[int] = [0]

    def take(self, live: np.ndarray, lift: np.ndarray, cfg: DisplayConfig) -> None:
        """The next rows of the piece."""
        known = np.flatnonzero(~np.isnan(live))
        if len(known):
            # Nothing before the last live price matters any more.
            self.closing, self.lifts, self.runs = float(live[known[-1]]), [], [0]
            lift = lift[known[-1] :]
        places = np.flatnonzero(lift)
        gaps = np.diff(np.concatenate([[-1], places, [len(lift)]])) - 1
        self.runs[-1] += int(gaps[0])
        self.runs += gaps[1:].tolist()
        self.lifts += lift[places].tolist()
        if not np.isnan(self.closing):
            self.closing = closing_price(self.closing, self.lifts, self.runs, cfg)
            self.lifts, self.runs = [], [0]

    def row(self) -> tuple:
        return (*self.name, self.stored, self.closing, self.lifts, self.runs)
