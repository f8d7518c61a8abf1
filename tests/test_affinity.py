"""Pair counts, graph algorithms and lists against brute force."""

from __future__ import annotations

import itertools
import json
import random
from collections import Counter

import pytest

from retailflow import session
from retailflow.operators import affinity
from retailflow.sources.tables import Tables


@pytest.fixture(scope="module")
def baskets():
    r = random.Random(1)
    rows = [(v, r.randrange(30)) for v in range(40) for _ in range(r.randrange(1, 9))]
    return rows + [(99, i) for i in range(25)]


@pytest.mark.parametrize("basket_slice", [2_000, 3])
def test_pair_counts(spark, baskets, basket_slice):
    """Slices of three make most baskets hot."""
    out = affinity.pair_counts(spark.createDataFrame(baskets, "visitor_id long, item_id long"), basket_slice)
    want = Counter()
    for _, group in itertools.groupby(sorted(baskets), key=lambda x: x[0]):
        items = [i for _, i in group]
        want.update((a, b) for a, b in itertools.product(items, items) if a < b)
    assert {(r["src"], r["dst"]): r["co_count"] for r in out.collect()} == want


@pytest.mark.parametrize("item_slice", [50_000, 2])
def test_pairs_travel_as_bytes(spark, monkeypatch, item_slice):
    """Rows of an item and its later ones are shuffled, not pairs; negative and far items, large numbers and folded pieces count right."""
    monkeypatch.setattr(affinity, "MOST_HELD", 5)
    monkeypatch.setattr(affinity, "PAIRS_A_PART", 7)
    rows = [(v, i) for v in range(6) for i in (-(1 << 40), 3, 70_000 + v % 2, 1 << 41)] + [(1, 3)] * 400 + [(None, 3), (2, None), (7, 5)]
    frame = spark.createDataFrame(rows, "visitor_id long, item_id long")
    pairs = affinity.pair_counts(frame, item_slice=item_slice)
    plan = pairs._jdf.queryExecution().executedPlan().toString()
    assert "substring(others" in plan and "REPARTITION_BY_NUM" in plan
    want = Counter()
    for v in range(6):
        items = Counter(i for u, i in rows if u == v and i is not None)
        want.update({(a, b): items[a] * items[b] for a in items for b in items if a < b})
    assert {(r["src"], r["dst"]): r["co_count"] for r in pairs.collect()} == want
    assert affinity.co_purchase(frame.limit(0)).count() == 0


def test_pairs_are_joined_once(spark, baskets):
    """The weights read the written counts, so no join is left in the plan."""
    edges = affinity.co_purchase(spark.createDataFrame(baskets, "visitor_id long, item_id long"))
    assert "Join" not in edges._jdf.queryExecution().executedPlan().toString()
    assert edges.agg({"elasticity_weight": "max"}).first()[0] == 1.0


def test_orders_are_not_broadcast(spark, tmp_path):
    """However small their file is, the orders reach their lines by shuffle, not by way of the driver."""
    spark.createDataFrame([(1, 7), (2, 8), (3, 7)], "o_orderkey long, o_custkey long").write.parquet(f"{tmp_path}/orders.parquet")
    lines = [(1, 4), (1, 5), (2, 4), (3, 9), (9, 9)]
    spark.createDataFrame(lines, "l_orderkey long, l_partkey long").write.parquet(f"{tmp_path}/lineitem.parquet")
    baskets = Tables(spark, str(tmp_path)).customer_baskets()
    assert "Broadcast" not in baskets._jdf.queryExecution().executedPlan().toString()
    assert sorted(tuple(r) for r in baskets.collect()) == [(7, 5), (7, 6), (7, 10), (8, 5)]


@pytest.mark.parametrize("slice_size", [100_000, 2])
def test_page_rank_and_communities(spark, slice_size):
    pairs = [(10, 20), (10, 30), (20, 30), (40, 50)]
    edges = spark.createDataFrame([(a, b, 1.0) for a, b in pairs], "item_id long, related_item_id long, elasticity_weight double")
    nodes = sorted({x for p in pairs for x in p})
    rank, labels = dict.fromkeys(nodes, 1.0), {n: n for n in nodes}
    out = Counter(a for a, _ in pairs)
    for _ in range(affinity.ROUNDS):
        rank = {n: 0.15 + 0.85 * sum(rank[a] / out[a] for a, b in pairs if b == n) for n in nodes}
        votes = {n: Counter([labels[b] for a, b in pairs if a == n] + [labels[a] for a, b in pairs if b == n]) for n in nodes}
        labels = {n: min(c, key=lambda k: (-c[k], k)) for n, c in votes.items()}
    scale = len(nodes) / sum(rank.values())
    got = {r["id"]: r["pagerank"] for r in affinity.page_rank(edges, slice_size=slice_size).collect()}
    assert got == pytest.approx({n: v * scale for n, v in rank.items()})
    assert {r["id"]: r["label"] for r in affinity.communities(edges, slice_size=slice_size).collect()} == labels


def test_links_are_dealt_once(spark, monkeypatch):
    """The links stand in buckets of their join keys, as many as they need, so a round does not shuffle them."""
    monkeypatch.setattr(affinity, "LINKS_A_BUCKET", 30)
    edges = spark.createDataFrame([(k, k + 7, 1.0) for k in range(150)], "item_id long, related_item_id long, elasticity_weight double")
    links, _ = affinity.sliced_links(edges)
    keys = links.select("src", "slice").distinct()
    plan = links.join(keys.hint("merge"), ["src", "slice"])._jdf.queryExecution().executedPlan().toString()
    assert "Bucketed: true" in plan and "SelectedBucketsCount: 10 out of 10" in plan
    assert links.count() == 300


def test_lists_are_cut_by_related_id(spark):
    graph = spark.createDataFrame([(1, 5, 0.5), (1, 25, 0.25), (1, 3, 1.0), (2, 7, 0.1)], "item_id long, related_item_id long, elasticity_weight double")
    out = {(r["item_id"], r["list_part"]): [x["related"] for x in json.loads(r["elasticity"])] for r in affinity.elasticity_lists(graph, 10).collect()}
    assert out == {(1, 0): [3, 5], (1, 2): [25], (2, 0): [7]}


@pytest.mark.parametrize("slice_size", [100_000, 3])
def test_rounds_in_passes(spark, monkeypatch, tmp_path, slice_size):
    """Links, ranks and labels made in several passes are those made in one, and the files of the rounds are gone."""
    r = random.Random(4)
    pairs = sorted({(a, b) for a, b in ((r.randrange(40), r.randrange(40)) for _ in range(150)) if a < b})
    edges = spark.createDataFrame([(a, b, 1.0) for a, b in pairs], "item_id long, related_item_id long, elasticity_weight double")
    read = lambda df: sorted((x[0], round(x[1], 9)) for x in df.collect())
    want = read(affinity.page_rank(edges, slice_size=slice_size)), read(affinity.communities(edges, slice_size=slice_size))
    monkeypatch.setattr(affinity, "LINKS_A_BUCKET", 25)
    for module in (affinity, session):
        monkeypatch.setattr(module, "BUCKETS_A_PASS", 4)
    monkeypatch.setattr(session, "shared_dir", lambda _: str(tmp_path))
    got = read(affinity.page_rank(edges, slice_size=slice_size)), read(affinity.communities(edges, slice_size=slice_size))
    assert got == want
    left = Counter(p.name.rsplit("-", 1)[0] for p in tmp_path.iterdir())
    assert left["labels"] == left["ranks"] > 1 and not left["links"] and not left["vertices"]
    links = affinity.sliced_links(edges, slice_size)[0]
    assert sorted((x["src"], x["dst"]) for x in links.collect()) == sorted(pairs + [(b, a) for a, b in pairs])
