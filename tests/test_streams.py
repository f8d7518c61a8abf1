"""Wire decoding, the pricing stream against the batch form, restart, rejects, published versions."""

from __future__ import annotations

from dataclasses import replace
from datetime import datetime

import pytest
from pyspark.sql import functions as F

from retailflow import session
from retailflow.config import SpeedConfig
from retailflow.operators import decisions, velocity
from retailflow.paths import Lake
from retailflow.plans import nightly
from retailflow.plans.catalogue import fixed_weights
from retailflow.schemas import ORDER, PRICE_UPDATE, SERVING, TRAFFIC_RECORD
from retailflow.sources import wire
from retailflow.streaming import commits, feeds, keyed_state, metrics, pricing_job

CFG = SpeedConfig()


def records(spark, rows):
    return wire.encode_records(spark.createDataFrame(rows, TRAFFIC_RECORD)).coalesce(1)


def test_bad_records_keep_bytes_and_reason(spark):
    good = records(spark, [(1000, 1, "view", 10, None)])
    bad = spark.createDataFrame([("k", bytearray(b"\x00")), ("k", bytearray(b"\x00\x00\x00\x00\x00{oops")), ("k", None), ("k", bytearray(b"\x00\x00\x00\x00\x00null"))], "key string, value binary")
    out = wire.decode_records(good.unionByName(bad)).collect()
    assert [r["reject_reason"] for r in out] == [None, "short_frame", "bad_payload", "short_frame", "bad_payload"]
    assert out[0]["item_id"] == 10 and bytes(out[1]["value"]) == b"\x00"
    assert wire.parse_events(good.unionByName(bad)).count() == 1


def test_bounded_read_of_staged_records(spark, tmp_path):
    """The bounded read and a drained stream of the same files give the same events."""
    path = str(tmp_path / "wire")
    for k in range(3):
        records(spark, [(1_000 * k + i, i, "view", 10 + i, None) for i in range(5)]).write.mode("append").parquet(path)
    bounded = wire.parse_events(wire.read_wire(spark, path))
    running = (
        wire.parse_events(wire.stream_wire(spark, path, max_files=1))
        .writeStream.format("memory").queryName("drained").trigger(availableNow=True).start()
    )
    pricing_job.drain(running)
    assert running.recentProgress and sum(p["numInputRows"] > 0 for p in running.recentProgress) == 3
    assert sorted_rows(bounded) == sorted_rows(spark.table("drained")) and bounded.count() == 15


@pytest.fixture(scope="module")
def serving_rows(spark):
    rows = [(10, 5.0, 0.2, None, 5, 20.0, None, None), (20, 500.0, None, None, 500, 30.0, None, None)]
    return spark.createDataFrame(rows, SERVING)


def burst(start, n, item=10):
    return [((start + k % 50) * 1000, k, "transaction", item, None) for k in range(n)]


ROWS = [
    *burst(0, 50), *burst(120, 70), *burst(300, 3, item=20), (330_000, 1, "view", 10, 21.5), *burst(400, 40),
    (700_000, 1, "view", 77, None), (20_000_000, 1, "view", 10, None), (20_300_000, 1, "view", 10, None),
]


def poll(spark, root, tmp_path, output, schema):
    out, seen = str(tmp_path / output), str(tmp_path / f"{output}-reader")
    pricing_job.drain(feeds.follow(spark, root, output, schema, out, seen, once=True))


def run_once(spark, serving_rows, source, root, cfg=CFG):
    live = pricing_job.accepted_events(wire.stream_wire(spark, source, max_files=1))
    pricing_job.drain(pricing_job.start_pricing(live, serving_rows, root, None, cfg, once=True))


def sorted_rows(df):
    return sorted(map(tuple, df.collect()), key=repr)


@pytest.mark.parametrize("where", ["between two outputs", "after the commit"])
def test_a_batch_that_fails_is_delivered_once(spark, serving_rows, tmp_path, monkeypatch, where):
    """The batch is tried again; a reader that polls in between finds every update, alert and order exactly once."""
    source, clean, root = str(tmp_path / "wire"), str(tmp_path / "clean"), str(tmp_path / "out")
    for part in (ROWS[:100], ROWS[100:]):
        records(spark, part).write.mode("append").parquet(source)
    run_once(spark, serving_rows, source, clean)
    failures = []
    if where == "after the commit":
        plain = commits.CommitLog.commit

        def commit(log, batch_id, staged):
            plain(log, batch_id, staged)
            if batch_id == 1 and not failures:
                failures.append(batch_id)
                raise RuntimeError("lost after the commit")

        monkeypatch.setattr(commits.CommitLog, "commit", commit)
    else:
        plain = pricing_job.reorders

        def orders(alerts):
            if not failures and alerts.count():
                failures.append(1)
                raise RuntimeError("lost between two outputs")
            return plain(alerts)

        monkeypatch.setattr(pricing_job, "reorders", orders)
    with pytest.raises(Exception, match="lost"):
        run_once(spark, serving_rows, source, root)
    for output, schema in (("updates", PRICE_UPDATE), ("orders", ORDER)):
        poll(spark, root, tmp_path, output, schema)
    run_once(spark, serving_rows, source, root)
    assert failures
    for output, schema in (("updates", PRICE_UPDATE), ("orders", ORDER)):
        poll(spark, root, tmp_path, output, schema)
        want = sorted_rows(pricing_job.committed(spark, clean, output))
        assert want and sorted_rows(pricing_job.committed(spark, root, output)) == want
        assert sorted_rows(feeds.followed(spark, str(tmp_path / output), schema)) == want
    assert sorted_rows(pricing_job.current_live(spark, root)) == sorted_rows(pricing_job.current_live(spark, clean))


def test_live_values_come_from_a_snapshot_and_its_tail(spark, tmp_path):
    """The files that a reader of live values opens do not grow with the batches."""
    root, schema = str(tmp_path / "out"), "item_id long, window_start timestamp, window_end timestamp, base_price double, new_price double, velocity double, baseline double, surge_prob double, is_surge boolean, stock int, reason string"
    write = pricing_job.write_batch(root, CFG, compact_every=4)
    files = []
    for batch in range(11):
        start = datetime(2024, 1, 1, batch)
        rows = [(item, start, start, 1.0, float(batch), 2.0, 0.0, 0.0, False, 90, "") for item in (batch % 3, 50)]
        write(spark.createDataFrame(rows, schema), batch)
        log = commits.CommitLog(spark, root)
        last = log.newest("snapshot")
        files.append(len(log.paths("live", -1 if last is None else last)) + (last is not None))
        live = {r["item_id"]: r["price"] for r in pricing_job.current_live(spark, root).collect()}
        assert live == {item: float(max(b for b in range(batch + 1) if item in (b % 3, 50))) for item in {50} | {b % 3 for b in range(batch + 1)}}
    assert max(files) <= 4 and files[-1] == 4


def test_events_that_arrive_again_count_once(spark, serving_rows, tmp_path):
    once, twice = str(tmp_path / "once"), str(tmp_path / "twice")
    later = [(r[0] + 1_200_000_000, *r[1:]) for r in ROWS]  # an event at time zero is late from the start
    for part in (later[:100], later[100:]):
        records(spark, part).write.mode("append").parquet(once)
        records(spark, [r for row in part for r in (row, row)]).write.mode("append").parquet(twice)
    run_once(spark, serving_rows, once, str(tmp_path / "a"))
    run_once(spark, serving_rows, twice, str(tmp_path / "b"), replace(CFG, deduplicate=True))
    first, second = (sorted_rows(pricing_job.committed(spark, str(tmp_path / x), "updates")) for x in "ab")
    assert first and first == second


def test_counters_of_a_running_job_are_kept(spark, serving_rows, tmp_path):
    source, root = str(tmp_path / "wire"), str(tmp_path / "out")
    bad = spark.createDataFrame([("k", bytearray(b"\x00\x01"))], "key string, value binary")
    records(spark, ROWS).unionByName(bad).coalesce(1).write.parquet(source)
    sink = metrics.MetricsSink(spark, str(tmp_path / "metrics"))
    spark.streams.addListener(sink)
    live = pricing_job.accepted_events(wire.stream_wire(spark, source))
    query = pricing_job.start_pricing(live, serving_rows, root, None, CFG, once=True)
    pricing_job.drain(query)
    assert sink.settled(query)
    spark.streams.removeListener(sink)
    found = {(r["component"], r["metric"]): r["value"] for r in metrics.stream_metrics(spark, sink.path).collect()}
    assert found["ingest", "records_processed"] == len(ROWS) and found["ingest", "errors"] == 1
    assert found["pricing", "records_processed"] == pricing_job.committed(spark, root, "updates").count() > 0
    assert found["pricing", "low_stock_alerts"] == pricing_job.committed(spark, root, "alerts").count() > 0


def test_stream_equals_batch_and_restarts(spark, serving_rows, tmp_path):
    """Two runs from one checkpoint, with records arriving between them, price what the batch form prices."""
    source, root, weights = str(tmp_path / "wire"), str(tmp_path / "out"), fixed_weights()
    for part in (ROWS[:100], ROWS[100:]):
        records(spark, part).write.mode("append").parquet(source)
        live = pricing_job.accepted_events(wire.stream_wire(spark, source))
        pricing_job.drain(pricing_job.start_pricing(live, serving_rows, root, weights, CFG, once=True))
    streamed = pricing_job.committed(spark, root, "updates").toPandas().sort_values(["event_time", "item_id"])

    windows = velocity.windowed_velocity(spark.createDataFrame(ROWS, TRAFFIC_RECORD), 60)
    scored = velocity.surge_score(velocity.feature_history(windows), weights)
    batch = decisions.update_records(
        decisions.decide_prices(scored, serving_rows, F.col("surge_prob"), 60), F.unix_millis("window_end")
    )
    closed = batch.where(F.col("event_time") <= 20_300_000 - 120_000).toPandas().sort_values(["event_time", "item_id"])
    assert len(streamed) == len(closed) >= 5
    for column in ("event_time", "item_id", "base_price", "new_price", "velocity", "baseline"):
        assert streamed[column].tolist() == closed[column].tolist(), column
    assert streamed["surge_prob"].tolist() == pytest.approx(closed["surge_prob"].tolist(), abs=1e-5)
    alerts, orders = (pricing_job.committed(spark, root, name) for name in ("alerts", "orders"))
    assert alerts.count() == orders.count() > 0 and orders.select("event_time", "sku").distinct().count() == orders.count()
    for _ in range(2):  # a reader that starts again delivers nothing twice
        poll(spark, root, tmp_path, "updates", PRICE_UPDATE)
    assert feeds.followed(spark, str(tmp_path / "updates"), PRICE_UPDATE).count() == len(streamed)
    now = {r["item_id"]: r["price"] for r in pricing_job.current_live(spark, root).collect()}
    last = closed.groupby("item_id")["new_price"].last().to_dict()
    assert now == last


def test_a_version_costs_calls_for_parts_not_for_items(spark, tmp_path):
    """A running job keeps two versions of very many items in one state value a part, and prices windows with the newest."""
    lake, source, root = Lake(str(tmp_path / "lake")), str(tmp_path / "wire"), str(tmp_path / "out")
    far, start = 2**53 + 1, 1_700_000_000_000 // 60_000 * 60_000
    some = spark.createDataFrame([(far, 3.0, 30.0), (far - 1, 9.0, 90.0), (None, 8.0, 80.0)], "item_id long, forecast_demand double, price double")
    many = spark.range(5_000).selectExpr("id AS item_id", "2D AS forecast_demand", "20D AS price").unionByName(some)
    newer = spark.createDataFrame([(7, 4.0, 40.0), (0, None, 10.0)], some.schema)
    wide = lambda rows: rows.select(*[(F.col(f.name) if f.name in rows.columns else F.lit(None).cast(f.dataType)).alias(f.name) for f in SERVING.fields])
    at = lambda minute, *items: [(start + minute * 60_000, 1, "transaction", item, None) for item in items]
    sent = (0, 7, far, 123_456, None)
    nightly.publish_version(wide(many), lake)
    records(spark, at(0, *sent) + at(10, 7)).write.mode("append").parquet(source)
    live = pricing_job.accepted_events(wire.stream_wire(spark, source))
    versions = pricing_job.published_serving(spark, lake.serving("changes"))
    running = pricing_job.start_pricing(live, versions, root, None, CFG, every="1 second")
    try:
        running.processAllAvailable()
        nightly.publish_version(wide(newer), lake)
        records(spark, at(20, *sent) + at(40, 7)).write.mode("append").parquet(source)
        running.processAllAvailable()
        kept = [[o["numRowsTotal"] for o in p["stateOperators"]] for p in running.recentProgress if p["stateOperators"]]
    finally:
        running.stop()
    found = {(int(w.timestamp() * 1000 - start) // 60_000, i): b for w, i, b in commits.CommitLog(spark, root).read("decisions", keyed_state.DECISION).select("window_start", "item_id", "baseline").collect()}
    assert found == {
        (0, 0): 2.0, (0, 7): 2.0, (0, far): 3.0, (0, 123_456): 0.0, (0, None): 0.0, (10, 7): 4.0,
        (20, 0): 0.0, (20, 7): 4.0, (20, far): 3.0, (20, 123_456): 0.0, (20, None): 0.0,
    }
    assert 0 < max(map(max, kept)) <= keyed_state.ITEM_PARTS


def test_a_sure_classifier_raises_prices(spark, serving_rows):
    windows = velocity.windowed_velocity(spark.createDataFrame(burst(0, 50), TRAFFIC_RECORD), 60)
    row = decisions.decide_prices(windows, serving_rows, F.lit(0.9), 60).first()
    assert row["is_surge"] and row["new_price"] > row["base_price"] == 20.0


def test_rejects_are_routed_and_counted(spark, tmp_path):
    source, root = str(tmp_path / "wire"), str(tmp_path / "out")
    bad = spark.createDataFrame([("k", bytearray(b"\x00\x01"))], "key string, value binary")
    records(spark, [(1, 1, "view", 10, None), (1, 1, "bogus", 10, None)]).unionByName(bad).coalesce(1).write.parquet(source)
    query = pricing_job.start_rejects(wire.stream_wire(spark, source), root, once=True)
    pricing_job.drain(query)
    out = spark.read.parquet(pricing_job.StreamPaths(root).rejects)
    assert sorted(r["reject_reason"] for r in out.collect()) == ["short_frame", "unknown_event"]
    counts = query.lastProgress["observedMetrics"]["rejects"]
    assert (counts["accepted"], counts["rejected"]) == (1, 2)


def test_versions_stay_beside_each_other(spark, serving_rows, tmp_path):
    lake = Lake(str(tmp_path))
    assert nightly.current_serving(spark, lake) is None
    first = nightly.publish_version(serving_rows, lake)
    nightly.publish_version(serving_rows.where("item_id = 10"), lake)
    assert first.count() == 2 and nightly.current_serving(spark, lake).count() == 1


def test_shared_folder_is_required_on_a_cluster():
    class Conf:
        def get(self, key, default):
            return default

    class Context:
        master = "spark://host:7077"

        def getCheckpointDir(self):
            return None

    class Session:
        conf, sparkContext = Conf(), Context()

    with pytest.raises(ValueError, match="spark.checkpoint.dir"):
        session.shared_dir(Session())
