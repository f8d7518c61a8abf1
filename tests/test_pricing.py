"""Price arithmetic, the price walk, histories and the surge network."""

from __future__ import annotations

import math
import random
import tracemalloc
from datetime import datetime, timezone

import numpy as np
import pandas as pd
import pytest
from pyspark.sql import functions as F

from retailflow.config import DisplayConfig, SpeedConfig
from retailflow.functions import pricing
from retailflow.functions.pricefold import carry_base_prices, shown_price, surge_uplift
from retailflow.functions.surgenet import surge_probabilities
from retailflow.operators import decisions
from retailflow.operators.decisions import replay_prices
from retailflow.operators.velocity import feature_history
from retailflow.plans.catalogue import fixed_weights
from retailflow.session import prepare, written
from retailflow.streaming.keyed_state import LOOKED_UP, ItemPricing, ServedValues, history_rows


def value(spark, column):
    return spark.range(1).select(column.alias("x")).first()["x"]


def test_formula(spark):
    price = lambda *a: value(spark, pricing.dynamic_price(*map(F.lit, a)))
    assert 100 < price(100.0, 500.0, 100.0, 0.8, True) <= 125
    assert price(100.0, 1e6, 1.0, 0.0, True) == 125.0
    assert price(100.0, 500.0, 100.0, 0.8, False) == price(100.0, 150.0, 100.0, 0.8, True) == price(100.0, 5.0, 0.0, 0.8, True) == 100.0


@pytest.mark.parametrize(("price", "ending", "shown"), [(121.0, 0.99, 120.99), (100.0, 0.99, 99.99), (121.99, 0.99, 121.99), (121.37, 0.0, 121.0), (0.5, 0.99, 0.0)])
def test_charm(spark, price, ending, shown):
    assert value(spark, pricing.charm_price(F.lit(price), ending)) == shown
    assert shown_price(np.array([price]), np.array([0.0]), DisplayConfig(charm_ending=ending))[0] == shown


def walk(items, live, stored, lift, cfg, carried):
    base, shown = [], []
    for k, item in enumerate(items):
        if not math.isnan(live[k]):
            price = live[k]
        elif k and items[k - 1] == item:
            price = shown[-1]
        elif not k and carried is not None and carried[0] == item:
            price = carried[1]
        else:
            price = 0.0 if math.isnan(stored[k]) else stored[k]
        base.append(price)
        shown.append(float(shown_price(np.array([price]), np.array([lift[k]]), cfg)[0]))
    return base, shown


@pytest.mark.parametrize("cfg", [DisplayConfig(), DisplayConfig(charm_ending=0.0), DisplayConfig(floor_pct=0.03), DisplayConfig(enabled=False)])
def test_price_walk_equals_a_row_loop(cfg):
    r = random.Random(4)
    for _ in range(200):
        n = r.randrange(0, 40)
        items = np.sort([r.randrange(4) for _ in range(n)]).astype("int64")
        live = np.array([r.uniform(1, 50) if r.random() < 0.15 else np.nan for _ in range(n)])
        stored = np.array([r.uniform(1, 50) if r.random() < 0.8 else np.nan for _ in range(n)])
        lift = np.array([r.choice([0.0, 0.0, 0.0, 0.1, 0.25]) for _ in range(n)])
        carried = r.choice([None, (0, 7.77)])
        base, shown, last = carry_base_prices(items, live, stored, lift, cfg, carried)
        want = walk(items, live, stored, lift, cfg, carried)
        assert (base.tolist(), shown.tolist()) == want
        assert last == ((items[-1], shown[-1]) if n else carried)
        if n > 2:  # the same rows in two chunks
            cut = n // 2
            first = carry_base_prices(items[:cut], live[:cut], stored[:cut], lift[:cut], cfg, carried)
            second = carry_base_prices(items[cut:], live[cut:], stored[cut:], lift[cut:], cfg, first[2])
            assert [*first[1], *second[1]] == want[1]


def test_history_rows_pad_with_the_oldest_step():
    begins = np.array([0, 0, 0, 3, 3])
    rows = history_rows(begins)
    assert rows.shape == (5, 50)
    assert set(rows[2][:48]) == {0} and list(rows[2][-3:]) == [0, 1, 2]
    assert set(rows[3]) == {3} and list(rows[4][-2:]) == [3, 4]
    long = history_rows(np.zeros(60, dtype=int))
    assert list(long[59]) == list(range(10, 60))


def test_surge_network_against_a_scalar_version():
    weights = fixed_weights(3)
    r = np.random.default_rng(2)
    history = r.uniform(0, 2, (2, 50, 4))
    got = surge_probabilities(weights, history.reshape(2, -1))
    sig = lambda x: 1 / (1 + math.exp(-x))
    for steps, p in zip(history, got, strict=True):
        h, c = [0.0] * 3, [0.0] * 3
        for step in steps:
            gate = [
                sum(weights["w_input"][g][k] * step[k] for k in range(4)) + sum(weights["w_hidden"][g][k] * h[k] for k in range(3))
                + weights["b_input"][g] + weights["b_hidden"][g]
                for g in range(12)
            ]
            c = [sig(gate[3 + u]) * c[u] + sig(gate[u]) * math.tanh(gate[6 + u]) for u in range(3)]
            h = [sig(gate[9 + u]) * math.tanh(c[u]) for u in range(3)]
        assert p == pytest.approx(sig(sum(weights["w_head"][0][u] * h[u] for u in range(3)) + weights["b_head"][0]), abs=1e-5)
    assert surge_probabilities(None, history.reshape(2, -1)).tolist() == [0.0, 0.0]


def long_windows(r, items=3, n=160):
    """Windows of a few items with gaps, live prices, lifts and stored prices."""
    rows = []
    for item in range(items):
        start, stored = 0, r.choice([None, 20.0, 99.5])
        for _ in range(n):
            start += r.choice((60, 60, 60, 120, 600, 9_000))
            live = r.uniform(5, 50) if r.random() < (0.0, 0.03, 0.2)[item % 3] else None
            rows.append((item, datetime.fromtimestamp(start, timezone.utc), r.randrange(9), r.randrange(9), r.randrange(9), live, stored, r.choice((0.0, 0.0, 0.0, 0.1, 0.25))))
    return rows


WINDOW_ROW = (
    "item_id long, window_start timestamp, velocity long, view_count long, addtocart_count long, "
    "last_price double, stored_price double, uplift double"
)


@pytest.mark.parametrize("block", [60, 1_800, 20_000, 10**9])
def test_histories_do_not_depend_on_blocks(spark, block):
    rows = long_windows(random.Random(8))
    table = spark.createDataFrame(rows, WINDOW_ROW)
    found = feature_history(table.select("item_id", "window_start", "velocity", "view_count", "addtocart_count"), 7_200, block)
    got = {(r["item_id"], r["window_start"].timestamp()): r["sequence"] for r in found.collect()}
    assert len(got) == len(rows)
    steps, last, key = [], None, None
    for item, start, *counts, _, _, _ in rows:
        at = start.timestamp()
        if item != key or at - last > 7_200:
            steps = []
        key, last = item, at
        steps = [*steps, [*map(float, counts), 0.0]][-50:]
        want = [steps[0]] * (50 - len(steps)) + steps
        assert got[item, at] == [x for step in want for x in step]


@pytest.mark.parametrize("cfg", [DisplayConfig(), DisplayConfig(floor_pct=0.03), DisplayConfig(enabled=False)])
@pytest.mark.parametrize("block", [60, 420, 20_000, 10**9])
def test_price_walk_does_not_depend_on_pieces(spark, block, cfg):
    rows = long_windows(random.Random(9), items=6)
    table = spark.createDataFrame(rows, WINDOW_ROW)
    found = replay_prices(table, cfg, block).collect()
    got = {(r["item_id"], r["window_start"].timestamp()): (r["base_price"], r["new_price"]) for r in found}
    nan = lambda k: np.array([np.nan if r[k] is None else r[k] for r in rows])
    base, shown, _ = carry_base_prices(np.array([r[0] for r in rows]), nan(5), nan(6), nan(7), cfg)
    assert len(got) == len(rows)
    for r, b, s in zip(rows, base, shown, strict=True):
        assert got[r[0], r[1].timestamp()] == (b, s)


def test_surge_arithmetic_is_that_of_the_columns(spark):
    r = random.Random(11)
    rows = [(float(r.randrange(40)), r.choice((0.0, 1.0, 300.0, 9_000.0, r.uniform(0, 5_000))), r.choice((0.0, 0.4, 1.7))) for _ in range(400)]
    table = spark.createDataFrame(rows, "velocity double, forecast_demand double, max_elasticity double")
    want = decisions.with_surge(table, F.lit(1.0), 60).collect()
    for row, (v, d, e) in zip(want, rows, strict=True):
        surging, lift = surge_uplift(np.array([v]), np.array([d]), e)
        assert (surging[0], lift[0]) == (row["is_surge"], row["uplift"])


class Kept:
    """A state value, or the handle that gives them, in memory."""

    def __init__(self):
        self.value, self.values = None, {}

    def getValueState(self, name, schema):
        return self.values.setdefault(name, Kept())

    def exists(self):
        return self.value is not None

    def get(self):
        return self.value

    def update(self, value):
        self.value = value

    def clear(self):
        self.value = None

    def registerTimer(self, at):
        pass

    def deleteTimer(self, at):
        pass


def windows_of(n, r):
    start = np.datetime64("2024-01-01", "us") + np.cumsum(r.choice([60, 60, 60, 9_000], n)).astype("timedelta64[s]")
    number = lambda low, high: r.integers(low, high, n)
    return pd.DataFrame(
        {
            "window_start": start, "window_end": start + np.timedelta64(60, "s"), "velocity": number(0, 90),
            "view_count": number(0, 9), "addtocart_count": number(0, 9), "baseline": 5.0, "stock": 7.0, "can_surge": r.random(n) < 0.2,
            "surge_uplift": 0.1, "stored_price": 20.0, "last_price": np.where(r.random(n) < 0.01, r.uniform(5, 50, n), np.nan),
        }
    )


def test_a_backlog_needs_the_memory_of_its_numbers():
    """200,000 windows of one item, in any order, priced as in small batches; decisions leave in pieces."""
    r, weights = np.random.default_rng(3), fixed_weights(units=2)
    whole = windows_of(200_000, r)
    frames = lambda table: iter([table.iloc[k : k + 10_000] for k in range(0, len(table), 10_000)])

    def run(batches):
        processor, out = ItemPricing(weights, SpeedConfig()), []
        processor.init(Kept())
        for batch in batches:
            for piece in processor.handleInputRows((1,), batch, None):
                assert len(piece) <= 2_048
                out.append(piece[["window_start", "base_price", "surge_prob", "is_surge"]])
        return pd.concat(out).reset_index(drop=True)

    want = run(iter([whole.iloc[k : k + 1_500]]) for k in range(0, len(whole), 1_500))
    mixed = whole.sample(frac=1.0, random_state=1)
    got = run([frames(mixed)])
    assert got["window_start"].equals(want["window_start"]) and got["base_price"].equals(want["base_price"])
    assert np.allclose(got["surge_prob"], want["surge_prob"], atol=1e-6)
    processor = ItemPricing(None, SpeedConfig())
    processor.init(Kept())
    tracemalloc.start()
    for _ in processor.handleInputRows((1,), frames(mixed), None):
        pass
    peak = tracemalloc.get_traced_memory()[1]
    tracemalloc.stop()
    assert peak < 200_000 * 8 * 11 * 3.5  # the numbers, once in parts, once joined, and a piece


def test_versions_take_effect_with_the_next_batch():
    processor, r = ItemPricing(None, SpeedConfig(), keeps_serving=True), np.random.default_rng(4)
    processor.init(Kept())
    table = windows_of(30, r)[["window_start", "window_end", "velocity", "view_count", "addtocart_count"]].assign(last_price=np.nan)
    serving = lambda *rows: pd.DataFrame(rows, columns=["number", *LOOKED_UP])
    batch = lambda *frames: pd.concat(processor.handleInputRows((1,), iter(frames), None))
    assert not list(processor.handleInputRows((1,), iter([serving((1, 20.0, 5.0, None, 3.0))]), None))
    one = batch(pd.concat([table[:10].assign(number=None), serving((3, 90.0, 7.0, 0.5, None), (2, 1.0, 1.0, 1.0, 1.0))]))
    assert set(one["baseline"]) == {5.0} and one["base_price"].iloc[0] == 20.0 and set(one["stock"]) == {3}
    two = batch(table[10:20].assign(number=None), serving((2, 1.0, 1.0, 1.0, 1.0)))
    assert set(two["baseline"]) == {7.0} and two["base_price"].iloc[0] == one["base_price"].iloc[-1] and two["stock"].isna().all()
    assert set(batch(table[20:].assign(number=None))["baseline"]) == {7.0}


def test_parts_look_up_what_each_item_keeps_for_itself():
    """Versions in any order and with gaps: a part of many items prices windows as states of single items do."""
    r, cfg, items = np.random.default_rng(5), SpeedConfig(), range(12)
    part, whole, single = (ServedValues(cfg), *[{k: make() for k in items} for make in (lambda: ItemPricing(None, cfg), lambda: ItemPricing(None, cfg, True))])
    for processor in (part, *whole.values(), *single.values()):
        processor.init(Kept())
    columns = ["window_start", "window_end", "velocity", "view_count", "addtocart_count", "last_price"]
    tables = {k: windows_of(30, r)[columns].assign(item=k, number=None) for k in items}
    versions = pd.DataFrame([(k, n, *np.where(r.random(4) < 0.2, None, r.uniform(0, 9_000, 4))) for n in (2, 1, 4, 3, 4) for k in items if r.random() < 0.7], columns=["item", "number", *LOOKED_UP])
    versions["stock"] = versions["stock"].astype("float64") // 1
    versions = versions.drop_duplicates(["item", "number"])
    order = {k: n for n, k in enumerate((2, 1, 4, 3))}
    for step in range(5):
        rows = pd.concat([t[step * 6 : step * 6 + 6] for t in tables.values()] + [versions[versions["number"].map(order) == step]])
        rows = rows.assign(named=True)
        frames = [rows[0::2], rows[1::2]]
        looked_up = list(part.handleInputRows((0,), iter(frames), None))
        for k in items:
            got = pd.concat(whole[k].handleInputRows((k,), iter([f[f["item"] == k] for f in looked_up]), None))
            want = pd.concat(single[k].handleInputRows((k,), iter([f[f["item"] == k] for f in frames]), None))
            pd.testing.assert_frame_equal(got.reset_index(drop=True), want.reset_index(drop=True))


def test_large_serving_tables_are_not_broadcast(spark):
    """A file of a few megabytes holds very many packed rows: they do not pass through the driver."""
    prepare(spark)
    rows = spark.range(600_000).selectExpr(
        "id AS item_id", "pmod(id, 20000) / 100 AS price", "1D AS forecast_demand", "0.5D AS max_elasticity", "200 AS stock"
    )
    windows = written(spark.range(600_000).selectExpr("id AS item_id", "xxhash64(id, 1) AS x", "xxhash64(id, 2) AS y"), "many")
    plan = decisions.with_lookups(windows, written(rows, "serving"))._jdf.queryExecution().executedPlan().toString()
    assert "SortMergeJoin" in plan and "Broadcast" not in plan
