"""Cleaning, gates, splits, features, inventory and forecast on small hand-made tables."""

from __future__ import annotations

import datetime as dt
import random

import numpy as np
import pytest
from pyspark.sql import functions as F

from retailflow.functions.surgenet import surge_probabilities
from retailflow.operators import demand, events, monitoring, serving
from retailflow.plans.catalogue import fixed_weights
from retailflow.schemas import SERVING
from retailflow.sources import models

BRONZE = "event_time long, visitor_id long, event string, item_id long, price double"


def test_clean_events_drops_copies_unknown_and_bad_items(spark):
    rows = [(1000, 1, "view", 10, 5.0), (1000, 1, "view", 10, 5.0), (1000, 1, "bogus", 10, 5.0), (1000, 1, "view", 0, 5.0)]
    out = events.clean_events(spark.createDataFrame(rows, BRONZE))
    assert out.count() == 1 and dict(out.dtypes)["event_time"] == "timestamp"


def test_normalize_reasons(spark):
    rows = [
        ("1", "2", "view", "3", ""), ("1", "2", "view", "3", "4.5"), ("1", "2", "bogus", "3", None),
        ("x", "2", "view", "3", None), ("1", "x", "view", "3", None), ("1", "2", "view", "x", None), ("1", "2", "view", "3", "x"),
    ]
    raw = spark.createDataFrame(rows, "timestamp string, visitorid string, event string, itemid string, price string")
    out = events.normalize_events(raw).collect()
    assert [r["reject_reason"] for r in out] == [None, None, "unknown_event", "bad_timestamp", "bad_visitor", "bad_item", "bad_price"]
    assert [r["price"] for r in out[:2]] == [None, 4.5]


def test_gate_raises(spark):
    bad = spark.createDataFrame([(None, 1, "nope", -10, None)], "event_time timestamp, visitor_id long, event string, item_id long, price double")
    with pytest.raises(ValueError, match="event_time_not_null"):
        events.validate_silver(bad)
    good = spark.createDataFrame([(dt.datetime(2024, 1, 1), 1, "view", 10, None)], bad.schema)
    assert events.validate_silver(good)


@pytest.mark.parametrize(("n", "want"), [(10, 8), (7, 5), (0, 0)])
def test_chrono_split_sizes(spark, n, want):
    rows = [(i // 2, i) for i in range(n)]
    train, test = events.chrono_split(spark.createDataFrame(rows, "timestamp long, event_id long"))
    assert (train.count(), test.count()) == (want, n - want)
    assert {r["event_id"] for r in train.collect()} == set(range(want))


def test_chrono_split_keeps_rows_without_time(spark):
    rows = [(1, 1), (None, 2), (3, 3), (4, None)]
    train, test = events.chrono_split(spark.createDataFrame(rows, "timestamp long, event_id long"), 0.75)
    assert train.count() == 2 and test.count() == 2
    train, test = events.chrono_split(spark.createDataFrame([(None, 1)], "timestamp long, event_id long"))
    assert train.count() + test.count() == 1


def test_campaigns_first_listed_wins(spark):
    windows = [events.CampaignWindow("2024-01-01T00:00:00", "2024-01-02T00:00:00", 5.0), events.CampaignWindow("2024-01-01T12:00:00", "2024-01-03T00:00:00", 2.0)]
    rows = [(dt.datetime(2024, 1, 1, 13),), (dt.datetime(2024, 1, 2, 13),), (dt.datetime(2024, 2, 1),)]
    out = spark.createDataFrame(rows, "t timestamp").select(events.campaign_multiplier(F.col("t"), windows).alias("m")).collect()
    assert [r["m"] for r in out] == [5.0, 2.0, 1.0]


@pytest.mark.parametrize("bin_seconds", [60, 3_600, 10**8])
def test_campaign_windows_of_a_table(spark, bin_seconds):
    """Overlapping, touching, empty and endless-looking windows; the first listed one wins."""
    r, start = random.Random(4), dt.datetime(2024, 1, 1)
    at = lambda minutes: start + dt.timedelta(minutes=minutes)
    windows = [(k, at(a := r.randrange(3_000)), at(a + r.choice((-30, 0, 1, 45, 700))), float(k + 2)) for k in range(40)]
    windows += [(40, at(10), at(20), 50.0), (41, at(20), at(30), 60.0), (42, None, at(5), 70.0), (43, at(5), None, 80.0)]
    r.shuffle(windows)
    times = [at(r.randrange(3_800)) for _ in range(400)] + [at(20), at(10), at(30), None]
    table = spark.createDataFrame(windows, "ordinal long, start timestamp, end timestamp, multiplier double")
    rows = spark.createDataFrame(list(enumerate(times)), "event_id long, t timestamp")
    found = {x["event_id"]: x["multiplier"] for x in events.with_campaigns(rows, table, F.col("t"), bin_seconds).collect()}
    assert len(found) == len(times)
    for k, t in enumerate(times):
        holding = [w for w in windows if t and w[1] and w[2] and w[1] <= t <= w[2]]
        assert found[k] == (min(holding)[3] if holding else 1.0)
    assert events.with_campaigns(rows, table.limit(0), F.col("t")).where("multiplier = 1").count() == len(times)


def test_overlapping_windows_are_resolved_once(spark):
    """A bin has no more stretches than ends of windows, however many windows overlap; one holds each moment."""
    start = dt.datetime(2024, 1, 1)
    windows = [(k, start + dt.timedelta(minutes=k % 7), start + dt.timedelta(minutes=30 + k % 11), float(k)) for k in range(500)]
    table = spark.createDataFrame(windows, "ordinal long, start timestamp, end timestamp, multiplier double")
    found = events.first_windows(table, 3_600_000_000).orderBy("since").collect()
    assert len(found) <= 7 + 11
    assert all(a["until"] <= b["since"] for a, b in zip(found, found[1:]))
    rows = [(start + dt.timedelta(seconds=20 * k),) for k in range(150)]
    out = events.with_campaigns(spark.createDataFrame(rows, "t timestamp"), table, F.col("t")).collect()
    assert len(out) == 150
    for r in out:
        assert r["multiplier"] == next((m for _, a, b, m in windows if a <= r["t"] <= b), 1.0)


def silver(spark, days):
    rows = [(dt.datetime(2024, 1, 1) + dt.timedelta(days=d, seconds=k), k, "transaction", 10, 1.0) for d, n in days for k in range(n)]
    return spark.createDataFrame(rows, "event_time timestamp, visitor_id long, event string, item_id long, price double")


def test_rolling_means(spark):
    last = demand.rolling_features(silver(spark, [(d - 1, d) for d in range(1, 41)])).where("label IS NULL").first()
    assert (last["velocity_7d"], last["velocity_30d"]) == (37.0, 25.5)
    only = demand.rolling_features(silver(spark, [(0, 2)])).first()
    assert (only["velocity_7d"], only["velocity_30d"]) == (2.0, 2.0)


def test_inventory_takes_the_latest(spark):
    rows = [("1", "1", "available", "1"), ("2", "1", "available", "0"), ("1", "2", "available", "0"), ("2", "2", "available", "1"), ("1", "3", "790", "n5.000")]
    properties = spark.createDataFrame(rows, "timestamp string, itemid string, property string, value string")
    assert {r["item_id"]: r["stock"] for r in demand.build_inventory(properties).collect()} == {1: 0, 2: 200}
    assert {r["item_id"]: r["catalog_price"] for r in demand.build_catalog_price(properties).collect()} == {3: 5.0}


def test_parts_of_the_window_grow_with_the_days(spark, monkeypatch):
    monkeypatch.setattr(demand, "DAYS_A_PART", 10)
    sales = silver(spark, [(d, 1) for d in range(45)])
    assert demand.rolling_features(sales).rdd.getNumPartitions() == 5


def test_equal_rows_are_learned_once(spark):
    """Few weighted rows stand for many equal ones, and every row counts once."""
    rows = [(1.0 + i % 2, 2.0, 1 + i % 3, float(i % 2)) for i in range(600)]
    out = demand.weighted_rows(spark.createDataFrame(rows, "velocity_7d double, velocity_30d double, dow int, label double")).collect()
    assert len(out) <= 6 * demand.FOLDS and sum(r["n"] for r in out) == 600
    assert {r["fold"] for r in out} == set(range(demand.FOLDS))


def test_forecast_scores_the_newest_day(spark, tmp_path):
    rows = [(i, float(i), float(i), 1 + i % 7, float(i)) for i in range(1, 9)] + [(99, 3.0, 3.0, 2, None)]
    features = spark.createDataFrame(rows, "item_id long, velocity_7d double, velocity_30d double, dow int, label double")
    features = features.withColumns({"ds": F.lit("2024-01-01").cast("date"), "is_weekend": F.lit(False)})
    path = str(tmp_path / "model")
    scored = demand.train_forecast(features, path)[1].collect()
    assert [r["item_id"] for r in scored] == [99] and scored[0]["forecast_demand"] >= 0
    again = demand.score_forecast(models.load_forecast(path), demand.forecast_split(features)[1]).collect()
    assert again == scored


def test_weights_are_read_against_their_signature(spark, tmp_path):
    good, path = fixed_weights(), str(tmp_path / "weights")
    state = lambda report: {r["part"]: r["state"] for r in report.collect()}
    models.save_weights(spark, good, path)
    loaded, report = models.load_weights(spark, path)
    assert all((loaded[n] == good[n]).all() for n in good) and set(state(report).values()) == {"ok", "in use"}
    history = np.random.default_rng(0).random((5, 200))
    assert (surge_probabilities(loaded, history) == surge_probabilities(good, history)).all()
    wrong = {
        "w_head": good | {"w_head": good["w_head"].T},
        "b_input": {n: a for n, a in good.items() if n != "b_input"},
        "w_input": good | {"w_input": good["w_input"][:, :3]},
        "b_head": good | {"b_head": np.array([np.nan])},
    }
    for part, weights in wrong.items():
        models.save_weights(spark, weights, path)
        loaded, report = models.load_weights(spark, path)
        found = state(report)
        assert loaded is None and found["all"] == "fallback 0" and found[part] != "ok"
        assert (surge_probabilities(loaded, history) == 0).all()
    assert state(models.load_weights(spark, str(tmp_path / "absent"))[1])["w_input"] == "missing"


def test_order_violations_count_every_row(spark):
    rows = [(1, 1, 10), (1, 1, 10), (1, 2, 5), (1, 3, 7), (2, 1, 1)]
    table = spark.createDataFrame(rows, "item_id long, event_id long, event_time long")
    for block in (1, 2, 100):
        out = {r["item_id"]: (r["n_events"], r["violations"]) for r in monitoring.order_violations(table, block=block).collect()}
        assert out == {1: (4, 1), 2: (1, 0)}


def test_tail_pages_lose_nothing(spark):
    rows = [(t, i, 1.0) for t in range(5) for i in range(7)]
    updates = spark.createDataFrame(rows, "event_time long, item_id long, new_price double")
    cursor, seen = (-1, -1), []
    while page := [(r["event_time"], r["item_id"]) for r in serving.tail_updates(updates, *cursor, n=4).collect()]:
        seen += page
        cursor = page[-1]
    assert seen == [(t, i) for t, i, _ in rows]


def test_merge_keeps_live_prices_and_old_values(spark):
    old = spark.createDataFrame([(1, 5.0, 0.1, 7, 3, 9.99, 4.0, "60s"), (2, 1.0, None, None, 1, 2.0, None, None)], SERVING)
    new = spark.createDataFrame([(1, 6.0, None, 8, 0, 1.0, None, None), (3, 2.0, None, None, None, 4.0, None, None)], SERVING)
    out = {r["item_id"]: tuple(r)[1:] for r in serving.merge_serving(old, new).collect()}
    assert out[1] == (6.0, 0.1, 8, 0, 9.99, 4.0, "60s")
    assert out[2][0] == 1.0 and out[3][4] == 4.0


def test_merge_and_upsert_views(spark):
    live = spark.createDataFrame([(1, 3.0, 2.0, "60s"), (9, 1.0, 1.0, "60s")], "item_id long, price double, velocity double, velocity_window string")
    table = spark.createDataFrame([(1, 5.0, 0.1, 7, 3, 9.99, None, None)], SERVING)
    out = {r["item_id"]: r["price"] for r in serving.upsert_live(table, live).collect()}
    assert out == {1: 3.0, 9: 1.0}
