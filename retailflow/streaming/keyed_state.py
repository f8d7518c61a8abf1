"""State of the pricing stream: feature history and current price of an item, serving values of a part of the items."""

from __future__ import annotations

from collections.abc import Iterator

import numpy as np
import pandas as pd
from pyspark.sql import types as T
from pyspark.sql.streaming.stateful_processor import StatefulProcessor, StatefulProcessorHandle

from retailflow.config import (
    HISTORY_FEATURES,
    HISTORY_STEPS,
    SURGE_PROBABILITY,
    SpeedConfig,
)
from retailflow.functions.pricefold import carry_base_prices, surge_uplift
from retailflow.functions.surgenet import surge_probabilities

DECISION = T.StructType(
    [
        T.StructField("item_id", T.LongType()),
        T.StructField("window_start", T.TimestampType()),
        T.StructField("window_end", T.TimestampType()),
        T.StructField("velocity", T.LongType()),
        T.StructField("base_price", T.DoubleType()),
        T.StructField("baseline", T.DoubleType()),
        T.StructField("surge_prob", T.DoubleType()),
        T.StructField("is_surge", T.BooleanType()),
        T.StructField("uplift", T.DoubleType()),
        T.StructField("stock", T.IntegerType()),
    ]
)

_HISTORY = T.StructType(
    [T.StructField("last_start", T.LongType()), T.StructField("steps", T.ArrayType(T.DoubleType()))]
)
_PRICE = T.StructType([T.StructField("shown", T.DoubleType())])
#: Windows whose histories are laid out and scored at once.
SCORED_AT_ONCE = 2_048


def history_rows(begins: np.ndarray) -> np.ndarray:
    """Row numbers of the steps of each history: the newest 50 up to the row, none before ``begins``.

    A shorter history repeats its oldest step in front.
    """
    ends = np.arange(len(begins))
    back = np.arange(1 - HISTORY_STEPS, 1)
    return np.maximum(ends[:, None] + back, np.maximum(begins, ends + back[0])[:, None])


#: Columns of closed windows that the state needs, and of serving rows.
WINDOW_NUMBERS = ("velocity", "view_count", "addtocart_count", "last_price")
LOOKED_UP = ("stored_price", "forecast_demand", "max_elasticity", "stock")
_SERVED = T.StructType([T.StructField("number", T.LongType()), *[T.StructField(c, T.DoubleType()) for c in LOOKED_UP]])

#: Parts that the items are dealt into, each with the serving values of its items in one state value. Fixed for
#: a running job: the part is the key of the state.
ITEM_PARTS = 1_024
_SERVED_PART = T.StructType(
    [
        T.StructField("item", T.ArrayType(T.LongType())),
        T.StructField("number", T.ArrayType(T.LongType())),
        *[T.StructField(c, T.ArrayType(T.DoubleType())) for c in LOOKED_UP],
    ]
)
#: Windows with what the serving values say about them; ``named`` is false where the item is null.
LOOKED_UP_WINDOW = T.StructType(
    [
        T.StructField("item", T.LongType()),
        T.StructField("named", T.BooleanType()),
        T.StructField("window_start", T.TimestampType()),
        T.StructField("window_end", T.TimestampType()),
        *[T.StructField(c, T.LongType()) for c in ("velocity", "view_count", "addtocart_count")],
        *[T.StructField(c, T.DoubleType()) for c in ("last_price", "stored_price", "baseline")],
        T.StructField("can_surge", T.BooleanType()),
        *[T.StructField(c, T.DoubleType()) for c in ("surge_uplift", "stock")],
    ]
)


def priced_values(velocity: np.ndarray, served: dict[str, np.ndarray], cfg: SpeedConfig) -> dict[str, np.ndarray]:
    """What serving values, NaN where absent, say about windows: price, baseline, surge, uplift, stock."""
    known = lambda c: np.where(np.isnan(served[c]), 0.0, served[c])
    baseline = known("forecast_demand")
    can, lift = surge_uplift(velocity, baseline, known("max_elasticity"), cfg)
    return {
        "stored_price": served["stored_price"], "baseline": baseline, "can_surge": can, "surge_uplift": lift,
        "stock": served["stock"],
    }


class ServedValues(StatefulProcessor):
    """Keeps the serving values of a part of the items and looks up those of its closed windows.

    The input are windows and rows of published serving versions (those with a ``number`` and no window). Windows
    get the values of the newest version that a batch before has read. Versions are merged item by item: an
    item that a newer one does not hold keeps its values. All items of a part are handled at once, so a version
    costs a few calls a part, however many items it has; in exchange a part with windows is read whole.
    """

    def __init__(self, cfg: SpeedConfig):
        self.cfg = cfg

    def init(self, handle: StatefulProcessorHandle) -> None:
        self.served = handle.getValueState("served", _SERVED_PART)

    def handleInputRows(self, key, rows: Iterator[pd.DataFrame], timerValues) -> Iterator[pd.DataFrame]:
        kept = self._kept()
        fresh = [kept]
        for frame in rows:
            published = frame["number"].notna().to_numpy()
            if published.any():
                fresh.append(self._numbers(frame[published]))
            if not published.all():
                yield self._looked_up(frame[~published], kept)
        if len(fresh) > 1:
            joined = {c: np.concatenate([f[c] for f in fresh]) for c in kept}
            order = np.lexsort((-joined["number"], joined["item"]))  # of equal numbers the one that came first
            newest = order[np.diff(joined["item"][order], prepend=joined["item"][order[0]] - 1) != 0]
            self.served.update(tuple(joined[c][newest].tolist() for c in kept))

    def _kept(self) -> dict[str, np.ndarray]:
        """The values in the state, by ascending item."""
        values = self.served.get() if self.served.exists() else ((),) * len(_SERVED_PART.names)
        kinds = ("int64", "int64", *["float64"] * len(LOOKED_UP))
        return {c: np.asarray(v, dtype=k) for c, v, k in zip(_SERVED_PART.names, values, kinds, strict=True)}

    @staticmethod
    def _numbers(frame: pd.DataFrame) -> dict[str, np.ndarray]:
        whole = {c: frame[c].to_numpy(dtype="int64") for c in ("item", "number")}
        return whole | {c: frame[c].to_numpy(dtype="float64", na_value=np.nan) for c in LOOKED_UP}

    def _looked_up(self, windows: pd.DataFrame, kept: dict[str, np.ndarray]) -> pd.DataFrame:
        item, velocity = windows["item"].to_numpy(dtype="int64"), windows["velocity"].to_numpy(dtype="float64")
        at = np.searchsorted(kept["item"], item)
        found = windows["named"].to_numpy(dtype=bool) & (at < len(kept["item"]))
        found[found] = kept["item"][at[found]] == item[found]
        served = {c: np.full(len(item), np.nan) for c in LOOKED_UP}
        for c in LOOKED_UP:
            served[c][found] = kept[c][at[found]]
        counts = {c: windows[c].to_numpy(dtype="int64") for c in ("velocity", "view_count", "addtocart_count")}
        return windows.assign(**counts, **priced_values(velocity, served, self.cfg))[LOOKED_UP_WINDOW.names]

    def close(self) -> None:
        pass


class ItemPricing(StatefulProcessor):
    """Walks the closed windows of one item in time order.

    With ``keeps_serving`` the input also has rows of published serving versions (those with a ``number`` and
    no window). The newest version that a batch before has read is the one that windows are priced with, so
    a version takes effect with the batch after it appears, and the job need not start again. A call for every
    item of a version costs milliseconds each, so the job looks the values up by ``ServedValues`` instead.

    A backlog of any length is held as a few numbers a window and handled in pieces of ``SCORED_AT_ONCE``,
    each of which carries history and price on to the next.
    """

    def __init__(self, weights: dict | None, cfg: SpeedConfig, keeps_serving: bool = False):
        self.weights = weights
        self.cfg = cfg
        self.keeps_serving = keeps_serving

    def init(self, handle: StatefulProcessorHandle) -> None:
        self.handle = handle
        self.history = handle.getValueState("history", _HISTORY)
        self.price = handle.getValueState("price", _PRICE)
        if self.keeps_serving:
            self.served = handle.getValueState("served", _SERVED)

    def handleInputRows(self, key, rows: Iterator[pd.DataFrame], timerValues) -> Iterator[pd.DataFrame]:
        parts, newest = [], None
        for frame in rows:
            if self.keeps_serving:
                versions = frame[frame["number"].notna()]
                if len(versions):
                    row = versions.loc[versions["number"].idxmax()]
                    if newest is None or row["number"] > newest[0]:
                        newest = (int(row["number"]), *[None if pd.isna(row[c]) else float(row[c]) for c in LOOKED_UP])
                frame = frame[frame["number"].isna()]
            if len(frame):
                parts.append(self._compact(frame))
        if parts:
            yield from self._priced(key[0], {c: np.concatenate([p[c] for p in parts]) for c in parts[0]})
        if newest is not None and (not self.served.exists() or self.served.get()[0] < newest[0]):
            self.served.update(newest)

    def _compact(self, frame: pd.DataFrame) -> dict[str, np.ndarray]:
        """The numbers of a frame's windows."""
        number = lambda c: frame[c].to_numpy(dtype="float64", na_value=np.nan)
        out = {c: number(c) for c in WINDOW_NUMBERS}
        for c in ("window_start", "window_end"):
            out[c] = frame[c].to_numpy(dtype="datetime64[us]")
        if self.keeps_serving:
            return out
        for c in ("stored_price", "baseline", "surge_uplift", "stock"):
            out[c] = number(c)
        out["can_surge"] = frame["can_surge"].to_numpy(dtype=bool)
        return out

    def _looked_up(self, windows: dict[str, np.ndarray]) -> dict[str, np.ndarray]:
        """What the serving values in the state say about each window."""
        values = self.served.get()[1:] if self.served.exists() else (None,) * len(LOOKED_UP)
        same = lambda v: np.full(len(windows["velocity"]), np.nan if v is None else v)
        return priced_values(windows["velocity"], dict(zip(LOOKED_UP, map(same, values), strict=True)), self.cfg)

    def _priced(self, item: int, windows: dict[str, np.ndarray]) -> Iterator[pd.DataFrame]:
        """Decisions of all windows, in time order; history and price are kept for the next batch."""
        if self.keeps_serving:
            windows |= self._looked_up(windows)
        order = np.argsort(windows["window_start"], kind="stable")
        known, last_start = np.zeros((0, HISTORY_FEATURES)), None
        if self.history.exists():
            last_start, flat = self.history.get()
            known = np.asarray(flat, dtype="float64").reshape(-1, HISTORY_FEATURES)
            self.handle.deleteTimer(self._expiry_ms(last_start))
        shown = self.price.get()[0] if self.price.exists() else None
        for low in range(0, len(order), SCORED_AT_ONCE):
            part = {c: v[order[low : low + SCORED_AT_ONCE]] for c, v in windows.items()}
            prob, known, last_start = self._score(part, known, last_start)
            surging = (prob >= SURGE_PROBABILITY) & part["can_surge"]
            lift = np.where(surging, part["surge_uplift"], 0.0)
            items = np.full(len(prob), item)
            carried = None if shown is None else (item, shown)
            base, prices, _ = carry_base_prices(items, part["last_price"], part["stored_price"], lift, self.cfg.display, carried)
            shown = float(prices[-1])
            yield pd.DataFrame(
                {
                    "item_id": items,
                    "window_start": part["window_start"],
                    "window_end": part["window_end"],
                    "velocity": part["velocity"].astype("int64"),
                    "base_price": base,
                    "baseline": part["baseline"],
                    "surge_prob": prob,
                    "is_surge": surging,
                    "uplift": lift,
                    "stock": pd.array(part["stock"], dtype="Float64").astype("Int32"),
                }
            )
        self.price.update((shown,))
        self.history.update((last_start, known.ravel().tolist()))
        self.handle.registerTimer(self._expiry_ms(last_start))

    def _expiry_ms(self, last_start: int) -> int:
        """Once the watermark is here, every later window starts after the history's lifetime."""
        return (last_start + self.cfg.history_ttl_seconds + self.cfg.window_seconds) * 1000

    def handleExpiredTimer(self, key, timerValues, expiredTimerInfo) -> Iterator[pd.DataFrame]:
        """Forget the history of a silent item; its price stays."""
        self.history.clear()
        return iter(())

    def _score(self, windows: dict, known: np.ndarray, last_start: int | None) -> tuple[np.ndarray, np.ndarray, int]:
        """Surge probability of each window from the history before it; the history after them, and its end."""
        counts = np.stack([windows[c] for c in ("velocity", "view_count", "addtocart_count")], axis=1)
        steps = np.vstack([known, np.pad(counts, ((0, 0), (0, HISTORY_FEATURES - counts.shape[1])))])
        starts = windows["window_start"].astype("datetime64[s]").astype("int64")
        silence = np.diff(starts, prepend=starts[0] if last_start is None else last_start)
        old = len(known)
        fresh = np.where(silence > self.cfg.history_ttl_seconds, np.arange(old, len(steps)), 0)
        begins = np.concatenate([np.zeros(old, dtype="int64"), np.maximum.accumulate(fresh)])
        flat = steps[history_rows(begins)[old:]].reshape(len(starts), -1)
        kept = steps[max(begins[-1], len(steps) - HISTORY_STEPS) :]
        return surge_probabilities(self.weights, flat), kept, int(starts[-1])

    def close(self) -> None:
        pass
