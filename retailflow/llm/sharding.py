"""Uniform shuffle into shards of exact size by a hypergeometric communication matrix.

Rows fall into blocks by a keyed hash. How many rows of each block go to each shard is drawn as in a
uniform shuffle: block after block, the counts follow the multivariate hypergeometric law of the
places still free. Inside a block, rows are permuted by a second keyed hash and dealt out in that
order; inside a shard they are permuted again by a third. Shard sizes differ by one row at most, and
every shuffle is as likely as any other up to the quality of the hashes.

The driver sees one count a block and draws the matrix; blocks number 64 to 16,384, so the matrix has a
proven bound and is broadcast. Rows meet in their block and in slices of their shard, never all in one
task: the slots of a slice begin where the slices before it end.

Hashes come from document id and text, so a rerun, or a task run again after its executor is lost,
deals the same rows to the same places. Rows that repeat both are ordered by nothing else and are
interchangeable. Null ids and texts are values like any other; a null text has 8 bytes and the
checksum of no bytes. An empty table has no rows in any shard.
"""

from __future__ import annotations

import random
from collections.abc import Iterator
from math import exp, lgamma

from pyspark.sql import DataFrame, Window
from pyspark.sql import functions as F

from retailflow.llm.common import stored

ROWS_A_BLOCK = 2_048
LEAST_BLOCKS, MOST_BLOCKS = 64, 16_384
#: Rows of a slice of a shard, on average, until ``MOST_SLICES`` is reached.
ROWS_A_SLICE = 2_048
MOST_SLICES = 4_096


def _log_choose(n: int, k: int) -> float:
    return lgamma(n + 1) - lgamma(k + 1) - lgamma(n - k + 1)


def hypergeometric(rng: random.Random, good: int, bad: int, draws: int) -> int:
    """Good ones among ``draws`` without replacement: inversion outward from the mode."""
    low, high = max(0, draws - bad), min(good, draws)
    if low == high:
        return low
    mode = min(high, max(low, (draws + 1) * (good + 1) // (good + bad + 2)))
    chance = exp(_log_choose(good, mode) + _log_choose(bad, draws - mode) - _log_choose(good + bad, draws))
    left = rng.random() - chance
    down, up, down_chance, up_chance = mode, mode, chance, chance
    while left > 0 and (down > low or up < high):
        if up < high:
            up_chance *= (good - up) * (draws - up) / ((up + 1) * (bad - draws + up + 1))
            up += 1
            left -= up_chance
            if left <= 0:
                return up
        if down > low:
            down_chance *= down * (bad - draws + down) / ((good - down + 1) * (draws - down + 1))
            down -= 1
            left -= down_chance
            if left <= 0:
                return down
    return mode


def communication_matrix(counts: list[int], shards: int, seed: int) -> Iterator[list[int]]:
    """Rows of each block that go to each shard; shards hold equal counts but for one row."""
    rng = random.Random(seed)
    total = sum(counts)
    free = [total // shards + (k < total % shards) for k in range(shards)]
    for count in counts:
        places, row = sum(free), []
        for k, capacity in enumerate(free):
            places -= capacity
            n = hypergeometric(rng, capacity, places, count)
            row.append(n)
            free[k] -= n
            count -= n
        yield row


def keyed(docs: DataFrame, seed: int) -> DataFrame:
    """[doc_id, size, text_crc32, k1, k2, k3] of every row: bytes and three hashes of id and text."""
    text = F.coalesce(F.col("text").cast("string"), F.lit(""))
    digest = F.xxhash64("doc_id", F.col("text").isNull(), F.xxhash64(text))
    rows = docs.select(
        "doc_id",
        (F.octet_length(text).cast("long") + 8).alias("size"),
        F.crc32(text.cast("binary")).alias("text_crc32"),
        digest.alias("digest"),
    )
    keys = {f"k{n}": F.xxhash64(F.lit(seed + n), "digest") for n in (1, 2, 3)}
    return rows.withColumns(keys).drop("digest")


def shuffle_into_shards(docs: DataFrame, shards: int = 24, seed: int = 7) -> DataFrame:
    """[doc_id, size, text_crc32, shard, slot] of every row."""
    spark = docs.sparkSession
    plain = stored(keyed(docs, seed), "keyed")
    n = plain.count()
    blocks = min(MOST_BLOCKS, max(LEAST_BLOCKS, n // ROWS_A_BLOCK))
    slices = min(MOST_SLICES, max(1, n // (shards * ROWS_A_SLICE)))
    rows = plain.withColumn("block", F.pmod("k1", F.lit(blocks)).cast("int"))

    counts = [0] * blocks
    for block, count in rows.groupBy("block").count().collect():
        counts[block] = count
    # A block's rows up to upto[k], in their order, go to shards 0 to k.
    matrix = []
    for block, drawn in enumerate(communication_matrix(counts, shards, seed)):
        upto = [sum(drawn[: k + 1]) for k in range(shards)]
        matrix.append((block, upto))
    matrix_rows = spark.createDataFrame(matrix, "block int, upto array<long>")

    order = [F.col(c) for c in ("doc_id", "text_crc32", "size")]
    ranked = rows.withColumn("rank", F.row_number().over(Window.partitionBy("block").orderBy("k2", *order)))
    dealt = ranked.join(F.broadcast(matrix_rows), "block").select(
        "doc_id",
        "size",
        "text_crc32",
        "k3",
        F.size(F.filter("upto", lambda x: x < F.col("rank"))).alias("shard"),
    )
    # The order of a shard is that of k3: slices are equal ranges of it.
    part = F.least(F.floor((F.shiftright("k3", 1) / float(1 << 63) + 0.5) * slices), F.lit(slices - 1)).cast("int")
    sliced = stored(dealt.withColumn("slice", part), "dealt")
    sizes = sliced.groupBy("shard", "slice").agg(F.count(F.lit(1)).alias("n"))
    ahead = Window.partitionBy("shard").orderBy("slice").rowsBetween(Window.unboundedPreceding, -1)
    begins = sizes.select("shard", "slice", F.coalesce(F.sum("n").over(ahead), F.lit(0)).alias("begin"))
    inside = F.row_number().over(Window.partitionBy("shard", "slice").orderBy("k3", *order))
    # At most shards * MOST_SLICES rows.
    return (
        sliced.withColumn("at", inside)
        .join(F.broadcast(stored(begins, "begins")), ["shard", "slice"])
        .select("doc_id", "size", "text_crc32", "shard", (F.col("begin") + F.col("at") - 1).alias("slot"))
    )
