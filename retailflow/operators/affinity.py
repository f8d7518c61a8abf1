"""Co-purchase affinity: weighted item pairs, PageRank and communities."""

from __future__ import annotations

from collections.abc import Iterator
from functools import reduce
from typing import NamedTuple

import numpy as np
import pyarrow as pa
from pyspark.sql import Column, DataFrame
from pyspark.sql import functions as F

from retailflow.operators.skew import every_slice, hot_keys, slice_of, tag_slices
from retailflow.session import BUCKETS_A_PASS, MOST_PASSES, bucketed, dropped, written

# Graph parameters.
RESET_PROBABILITY = 0.15
ROUNDS = 5

BASKET_SLICE = 2_000  # distinct items of one basket that meet in one join key
ITEM_SLICE = 50_000  # baskets of one item whose pairs are counted in one place
PAIRS_A_PART = 1_000_000  # pairs that one task counts
MOST_HELD = 8_000_000  # pairs that a task holds before it folds equal ones
ROWS_OUT = 50_000  # pairs that a task hands on at once
VERTEX_SLICE = 100_000  # edges of one vertex that meet in one join key
LINKS_A_BUCKET = 500_000  # links that one task of a round holds
LIST_PART = 10_000  # related ids that one list row covers


def pair_counts(transactions: DataFrame, basket_slice: int = BASKET_SLICE, item_slice: int = ITEM_SLICE) -> DataFrame:
    """[src, dst, co_count] for src < dst bought by the same visitor; repeats multiply.

    Repeats are folded to one row per (visitor, item). The items of a basket are gathered in one sorted list by one
    shuffle, and the lists are written once. Each item is then sent, as one row, with the items after it as packed bytes, a
    few a pair, to the place where the pairs of this item are counted; pairs are rows only from there on. A basket
    of very many items is cut into lists that also meet pairwise under separate keys, and the rows of an item in very
    many baskets are spread over several places, so no task grows with either.
    """
    folded = transactions.where("visitor_id IS NOT NULL AND item_id IS NOT NULL")
    bought = written(folded.groupBy("visitor_id", "item_id").agg(F.count(F.lit(1)).alias("n")), "baskets")
    sizes = bought.groupBy("visitor_id").agg(F.count(F.lit(1)).cast("double").alias("m"))
    n_pairs = sizes.agg(F.coalesce(F.sum(F.expr("m * (m - 1) / 2")), F.lit(0.0))).first()[0]
    parts = max(1, -(-int(n_pairs) // PAIRS_A_PART))
    least, most, n_most = bought.agg(F.min("item_id"), F.max("item_id"), F.max("n")).first()
    code = ItemCode(least or 0, _bytes_of((most or 0) - (least or 0)), _bytes_of(n_most) if (n_most or 1) > 1 else 0)
    hot = hot_keys(bought, "visitor_id", basket_slice)
    hot_items = hot_keys(bought, "item_id", item_slice)
    spread = tag_slices(bought, "item_id", hot_items).withColumnRenamed("slices", "spread")
    sliced = tag_slices(spread, "visitor_id", hot)
    gathered = sliced.groupBy("visitor_id", slice_of("item_id").alias("own"), "slices").agg(
        F.sort_array(F.collect_list(F.struct("item_id", "n", "spread"))).alias("items")
    )
    lists = written(gathered.select("*", *code.packed("items")), "lists")
    met = (
        lists.where(F.size("items") > 1)
        .select("visitor_id", "others", "numbers", F.posexplode("items").alias("at", "one"))
        .select("visitor_id", "one", *[F.expr(f"substring({c}, (at + 1) * {w} + 1)").alias(c) for c, w in code.widths()])
        .where(F.length("others") > 0)
    )
    if not hot.isEmpty():
        met = met.unionAll(_met_across(lists.where("slices > 1")))
    place = F.pmod(F.hash("visitor_id"), F.col("one.spread")).alias("place")
    rows = met.select(F.col("one.item_id").alias("src"), F.col("one.n").alias("n"), "others", "numbers", place, F.col("one.spread").alias("spread"))
    dropped(bought)
    counted = lambda some: _counted(some.drop("spread").repartition(parts, "src", "place"), code)
    if hot_items.isEmpty():
        return counted(rows)
    apart = counted(rows.where("spread > 1")).groupBy("src", "dst").agg(F.sum("co_count").alias("co_count"))
    return counted(rows.where("spread = 1")).unionAll(apart)


def _bytes_of(number: int) -> int:
    return max(1, -(-int(number).bit_length() // 8))


class ItemCode(NamedTuple):
    """Lists of items and of their numbers as bytes: every item less the least in ``width`` bytes, numbers in ``number_width``."""

    least: int
    width: int
    number_width: int  # 0 where all numbers are 1

    def widths(self) -> tuple[tuple[str, int], tuple[str, int]]:
        return ("others", self.width), ("numbers", self.number_width)

    def packed(self, items: str) -> list[Column]:
        """[others, numbers] of an array of (item_id, n)."""

        def bytes_of(value, width: int) -> Column:
            if not width:
                return F.unhex(F.lit(""))
            digits = F.transform(items, lambda x: F.lpad(F.hex(value(x)), 2 * width, "0"))
            return F.unhex(F.array_join(digits, ""))

        less = lambda x: x["item_id"] - F.lit(self.least)
        return [bytes_of(less, self.width).alias("others"), bytes_of(lambda x: x["n"], self.number_width).alias("numbers")]

    def unpacked(self, column: pa.Array, width: int) -> tuple[np.ndarray, np.ndarray]:
        """(all numbers, how many each row has)."""
        ends = np.frombuffer(column.buffers()[1], np.int32)[column.offset : column.offset + len(column) + 1]
        raw = np.frombuffer(column.buffers()[2], np.uint8)[ends[0] : ends[-1]] if ends[-1] > ends[0] else np.empty(0, np.uint8)
        out = np.zeros(len(raw) // width, np.int64)
        for k in range(width):
            out = out << 8 | raw[k::width]
        return out, np.diff(ends) // width


def _counted(rows: DataFrame, code: ItemCode) -> DataFrame:
    """[src, dst, co_count] of rows [src, n, others, numbers] that lie together by src; items that are not after src do not count."""

    def folded(held: list[tuple]) -> tuple:
        src, dst, n = (np.concatenate(x) for x in zip(*held, strict=True))
        order = np.lexsort((dst, src))
        src, dst, n = src[order], dst[order], n[order]
        first = np.flatnonzero(np.append(True, (src[1:] != src[:-1]) | (dst[1:] != dst[:-1]))) if len(src) else np.empty(0, np.int64)
        return src[first], dst[first], np.add.reduceat(n, first) if len(first) else n

    def run(batches: Iterator[pa.RecordBatch]) -> Iterator[pa.RecordBatch]:
        held, size = [], 0
        for batch in batches:
            if not batch.num_rows:
                continue
            src, n = (batch.column(k).to_numpy() for k in (0, 1))
            dst, many = code.unpacked(batch.column(2), code.width)
            src, n, dst = np.repeat(src, many), np.repeat(n, many), dst + code.least
            if code.number_width:
                n = n * code.unpacked(batch.column(3), code.number_width)[0]
            after = dst > src
            held.append((src, dst, n) if after.all() else (src[after], dst[after], n[after]))
            size += len(held[-1][0])
            if size > MOST_HELD and len(held) > 1:
                held = [folded(held)]
                size = len(held[0][0]) // 2  # what is folded already may take as much again
        if held:
            src, dst, n = folded(held)
            for at in range(0, len(src), ROWS_OUT):
                part = slice(at, at + ROWS_OUT)
                yield pa.RecordBatch.from_arrays([pa.array(x[part]) for x in (src, dst, n)], ["src", "dst", "co_count"])

    return rows.select("src", "n", "others", "numbers").mapInArrow(run, "src long, dst long, co_count long")


def _met_across(lists: DataFrame) -> DataFrame:
    """[visitor_id, one, others, numbers] of items of one basket with the items of its other lists."""
    ones = lists.select("visitor_id", F.col("own").alias("a"), every_slice().alias("b"), F.explode("items").alias("one"))
    others = lists.select("visitor_id", F.col("own").alias("b"), "others", "numbers")
    return ones.where("a != b").join(others, ["visitor_id", "b"]).select("visitor_id", "one", "others", "numbers")


def co_purchase(transactions: DataFrame, basket_slice: int = BASKET_SLICE) -> DataFrame:
    """[item_id, related_item_id, elasticity_weight]: pair counts over the largest pair count.

    The pairs of large tables are many times the input, so they are counted for the largest count and again for the weights, from
    the lists of the baskets, and never written.
    """
    pairs = pair_counts(transactions, basket_slice)
    top = pairs.agg(F.coalesce(F.max("co_count"), F.lit(1))).first()[0]
    return pairs.selectExpr("src AS item_id", "dst AS related_item_id", f"co_count / {top}D AS elasticity_weight")


def affinity_vertices(edges: DataFrame) -> DataFrame:
    """Distinct ids of both edge ends, from one scan of the edges."""
    return edges.select(F.explode(F.array("item_id", "related_item_id")).alias("id")).distinct()


def sliced_links(edges: DataFrame, slice_size: int = VERTEX_SLICE) -> tuple[DataFrame, DataFrame]:
    """(links, hot vertices): edges in both directions [src, dst, forward, slice, spread], for the rounds of both loops.

    Links of a hot vertex are spread over several join keys, and ``spread`` says over how many keys the votes for ``dst``
    are. The table is written once in buckets of its join keys, a number that grows with the links, so no round computes,
    shuffles or sorts it again and a lost executor costs no more than the round it is in.
    """
    pairs = edges.select(F.col("item_id").alias("a"), F.col("related_item_id").alias("b"))
    ways = [F.struct(F.col(x).alias("src"), F.col(y).alias("dst"), F.lit(on).alias("forward")) for x, y, on in (("a", "b", True), ("b", "a", False))]
    both = written(pairs, "ends").select(F.inline(F.array(*ways)))
    hot = hot_keys(both, "src", slice_size)
    tagged = tag_slices(both, "src", hot).select("src", "dst", "forward", slice_of("dst").alias("slice"))
    spread = tag_slices(tagged, "dst", hot.withColumnRenamed("src", "dst")).withColumnRenamed("slices", "spread")
    return bucketed(spread.select("src", "dst", "forward", "slice", "spread"), "links", link_parts(both), "src", "slice"), hot


def link_parts(links: DataFrame) -> int:
    """Buckets of ``LINKS_A_BUCKET`` rows; the rows are counted from the file."""
    return max(1, -(-links.count() // LINKS_A_BUCKET))


def _rounds_by_passes(parts: int, key: str) -> list[Column]:
    """Conditions on ``key`` that split what a round sends into parts of ``BUCKETS_A_PASS`` buckets or so, taken one after the other."""
    n = min(MOST_PASSES, -(-parts // BUCKETS_A_PASS))
    return [F.pmod(F.xxhash64(F.lit("pass"), F.col(key)), F.lit(n)) == k for k in range(n)]


def _union(tables: list[DataFrame]) -> DataFrame:
    return reduce(DataFrame.unionAll, tables)


def page_rank(
    edges: DataFrame, rounds: int = ROUNDS, slice_size: int = VERTEX_SLICE, links: tuple[DataFrame, DataFrame] | None = None
) -> DataFrame:
    """[id, pagerank]: unweighted ranks from 1.0, 0.15 + 0.85 * sum, rescaled to the vertex count.

    A round is one join and one partially aggregated shuffle: the zero rows of the vertices travel
    with the messages, so sources without incoming links need no outer join. Its ranks are written, in passes over parts of the
    vertices where there are very many links, so that the disks hold the messages of one pass. ``links`` are the ``sliced_links``
    where they are there already.
    """
    both, hot = links or sliced_links(edges, slice_size)
    out = both.where("forward").select("src", "dst", "slice")
    no_message = F.lit(0.0).alias("message")
    passes = _rounds_by_passes(link_parts(both), "id")
    # out-degree and slices per vertex, from the links of both directions, which lie together by source; sinks keep degree 0
    vertices = both.groupBy(F.col("src").alias("id")).agg(F.count_if("forward").alias("degree"))
    vertices = written(tag_slices(vertices, "id", hot.withColumnRenamed("src", "id")), "vertices")
    states = [vertices.withColumn("rank", F.lit(1.0))]
    for done in range(rounds):
        # The ranks are the smaller side by far: they are looked up bucket by bucket, and the links are not sorted.
        sending = _union(states).where(F.col("degree") > 0).select(
            F.col("id").alias("src"), every_slice().alias("slice"), (F.col("rank") / F.col("degree")).alias("message")
        ).hint("shuffle_hash")
        messages = out.join(sending, ["src", "slice"]).select(
            F.col("dst").alias("id"), "message", F.lit(None).cast("bigint").alias("degree"),
            F.lit(None).cast("int").alias("slices"),
        )
        every = messages.unionAll(vertices.select("id", no_message, "degree", "slices"))
        before, states = states, []
        for now in passes:
            state = (
                every.where(now)
                .groupBy("id")
                .agg(
                    (F.lit(RESET_PROBABILITY) + F.lit(1 - RESET_PROBABILITY) * F.sum("message")).alias("rank"),
                    F.max("degree").alias("degree"),
                    F.max("slices").alias("slices"),
                )
            )
            states.append(written(state, "ranks"))
        if done:
            dropped(*before)
    dropped(vertices, *([] if links else [both]))
    ranked = _union(states).select("id", "rank")
    scale = ranked.agg((F.count(F.lit(1)) / F.sum("rank")).alias("scale")).scalar()
    return ranked.select("id", (F.col("rank") * scale).alias("pagerank"))


def communities(
    edges: DataFrame, rounds: int = ROUNDS, slice_size: int = VERTEX_SLICE, links: tuple[DataFrame, DataFrame] | None = None
) -> DataFrame:
    """[id, label]: synchronous label propagation over undirected links; ties take the smallest label.

    The labels of a round are written, in passes as the ranks of ``page_rank`` are.
    """
    both, hot = links or sliced_links(edges, slice_size)
    parts = link_parts(both)
    passes = _rounds_by_passes(parts, "dst")
    hot = hot.withColumnRenamed("src", "id")
    labels = [written(both.select(F.col("src").alias("id")).distinct().withColumn("label", F.col("id")), "labels")]
    for _ in range(rounds):
        sending = tag_slices(_union(labels), "id", hot).select(
            F.col("id").alias("src"), every_slice().alias("slice"), "label"
        ).hint("shuffle_hash")
        before, labels = labels, []
        for now in passes:
            # One shuffle by vertex serves the counts and the choice; the votes for a hot vertex are spread by label.
            sent = both.select("src", "dst", "slice", "spread").where(now).join(sending, ["src", "slice"]).select(
                F.col("dst").alias("id"), F.pmod(F.hash("label"), F.col("spread")).alias("part"), "label"
            )
            dealt = sent.repartition(max(1, -(-parts // len(passes))), "id", "part")
            votes = dealt.groupBy("id", "part", "label").agg(F.count(F.lit(1)).alias("votes"))
            best = votes.groupBy("id", "part").agg(F.max(F.struct("votes", -F.col("label"), "label")).alias("best"))
            labels.append(written(best.groupBy("id").agg(F.max("best")["label"].alias("label")), "labels"))
        dropped(*before)
    if not links:
        dropped(both)
    return _union(labels)


def affinity_graph(edges: DataFrame) -> DataFrame:
    """Edges with community and rank of the source item."""
    edges = written(edges, "edges")
    links = sliced_links(edges)
    traits = communities(edges, links=links).join(page_rank(edges, links=links), "id").select(
        F.col("id").alias("item_id"), F.col("label").alias("community"), "pagerank"
    )
    traits = written(traits, "traits")
    dropped(links[0])
    return edges.join(traits, "item_id", "left")


def elasticity_lists(graph: DataFrame, list_part: int = LIST_PART) -> DataFrame:
    """[item_id, list_part, elasticity]: JSON lists of related items by related id.

    A list row holds the related items of one range of ``list_part`` ids, so it is bounded for every
    item, and which row holds a related item depends on nothing but its id.
    """
    entry = F.struct(F.col("related_item_id").alias("related"), F.col("elasticity_weight").alias("weight"))
    part = F.floor(F.col("related_item_id") / list_part).cast("int").alias("list_part")
    return (
        graph.groupBy("item_id", part)
        .agg(F.sort_array(F.collect_list(entry)).alias("related"))
        .select("item_id", "list_part", F.to_json("related").alias("elasticity"))
    )


def max_elasticity(graph: DataFrame) -> DataFrame:
    """Strongest edge per source item."""
    return graph.groupBy("item_id").agg(F.max("elasticity_weight").alias("max_elasticity"))
