"""SimHash near-duplicates found by Golay-code keys.

A fingerprint has 64 bits: bit b is 1 where more than half of the shingle hashes of the text have
it. Two fingerprints are linked when they differ in at most two bits. They are cut into three
segments of 22, 21 and 21 bits; two errors leave one segment free of errors, and the following
segment then has at most two. So a pair shares, for one of the three segments, its exact value
together with a Golay key of the segment after it. Each distinct fingerprint gets these keys (three
to eighteen), equal keys make buckets, and the pairs of a bucket are verified by counting bits.

A bucket of more than ``BUCKET`` distinct fingerprints would cost the square of its size. Its members
are linked exactly in another way: each is sent to itself and its 64 one-bit neighbours; two members
meet at such a place exactly if they differ in at most two bits, at most 65 meet anywhere, and one
link to the smallest of them joins them all. Either way the components are those of all pairs.

Copies have one fingerprint and are never expanded into pairs. Null and empty texts, and texts of
blanks only, have fingerprint zero and are linked like any other. Null document ids are passed over
when the smallest of a component is taken, unless a component has no other. Repeated rows each get a
row. Further columns of the input, whatever their names, are not read.
"""

from __future__ import annotations

from collections.abc import Iterator
from itertools import accumulate

import numpy as np
import pyarrow as pa
import xxhash
from pyspark.sql import DataFrame
from pyspark.sql import functions as F

from retailflow.llm import golay
from retailflow.llm.common import map_rows, stored
from retailflow.llm.graph import components

SEED = 42
MAX_DISTANCE = 2
SEGMENTS = ((0, 22), (22, 21), (43, 21))  # lowest bit and width
BUCKET = 64
#: Shingle hashes whose bits are counted at once.
BLOCK = 65_536


def shingle_hashes(text: str, width: int) -> np.ndarray:
    """XXH64 of each run of ``width`` words, A-Z lower-cased; of all words where there are fewer."""
    words = text.encode().lower().split()  # bytes: ASCII letters and the six ASCII blanks only
    if not words:
        return np.zeros(0, np.uint64)
    joined = b" ".join(words)
    starts = [0, *accumulate(len(word) + 1 for word in words)]
    if len(words) <= width:
        starts, width = [0, starts[-1]], 1
    hashed = (xxhash.xxh64_intdigest(joined[a : b - 1], SEED) for a, b in zip(starts, starts[width:]))
    return np.fromiter(hashed, np.uint64, len(starts) - width)


def majority_bits(hashes: np.ndarray) -> int:
    """The number whose bit is 1 where more than half of the hashes have it."""
    counts = np.zeros(64, np.int64)
    for begin in range(0, len(hashes), BLOCK):
        block = np.ascontiguousarray(hashes[begin : begin + BLOCK], dtype="<u8").view(np.uint8)
        counts += np.unpackbits(block, bitorder="little").reshape(-1, 64).sum(axis=0, dtype=np.int64)
    return int(np.packbits(2 * counts > len(hashes), bitorder="little").view("<u8")[0])


def simhash(text: str, width: int = 3) -> int:
    return majority_bits(shingle_hashes(text, width))


def _signed(value: int) -> int:
    return value - (1 << 64) if value >> 63 else value


def fingerprints(docs: DataFrame, width: int = 3) -> DataFrame:
    """[doc_id, text_hash, fp] of every row; ``fp`` is the fingerprint as a signed number."""
    rows = docs.select("doc_id", "text", F.xxhash64(F.coalesce("text", F.lit(""))).alias("text_hash"))
    start = lambda: lambda texts: [(_signed(simhash(text, width)),) for text in texts]
    return map_rows(rows, "text", (("fp", "long"),), start, ["doc_id", "text_hash"])


def golay_keys(classes: DataFrame) -> DataFrame:
    """[key, fp]: the keys of each fingerprint, each once."""

    def run(batches: Iterator[pa.RecordBatch]) -> Iterator[pa.RecordBatch]:
        for batch in batches:
            fp = batch.column(0).to_numpy(zero_copy_only=False)
            bits = fp.astype(np.int64).view(np.uint64)
            parts = [(bits >> np.uint64(low)) & np.uint64((1 << width) - 1) for low, width in SEGMENTS]
            for k, exact in enumerate(parts):
                after = (k + 1) % len(parts)
                near = golay.keys(parts[after], SEGMENTS[after][1])
                row, place = np.nonzero(np.diff(near, axis=1, prepend=np.uint32(1 << 12)))
                key = np.uint64(k) << np.uint64(34) | exact[row] << np.uint64(12) | near[row, place].astype(np.uint64)
                yield pa.RecordBatch.from_arrays([pa.array(key.astype(np.int64)), pa.array(fp[row])], ["key", "fp"])

    return classes.select("fp").mapInArrow(run, "key long, fp long")


def near_links(classes: DataFrame) -> DataFrame:
    """[a, b]: links whose components are those of all pairs of distinct ``fp`` within two bits."""
    keyed = stored(golay_keys(classes), "keys")
    sizes = stored(keyed.groupBy("key").agg(F.count(F.lit(1)).alias("n")).where("n > 1"), "sizes")
    sized = stored(keyed.join(sizes, "key"), "sized")
    near = F.filter("fps", lambda b: (b > F.col("a")) & (F.bit_count(b.bitwiseXOR(F.col("a"))) <= MAX_DISTANCE))
    verified = (
        sized.where(F.col("n") <= BUCKET)
        .groupBy("key")
        .agg(F.collect_list("fp").alias("fps"))
        .select("fps", F.explode("fps").alias("a"))
        .select("a", F.explode(near).alias("b"))
    )
    flips = F.expr("transform(sequence(0, 63), bit -> fp ^ shiftleft(1L, bit))")
    met = (
        sized.where(F.col("n") > BUCKET)
        .select("fp")
        .distinct()
        .select("fp", F.explode(F.array_append(flips, F.col("fp"))).alias("place"))
        .groupBy("place")
        .agg(F.collect_list("fp").alias("fps"))
        .where(F.size("fps") > 1)
        .select(F.array_min("fps").alias("a"), F.explode("fps").alias("b"))
        .where("a != b")
    )
    return verified.unionByName(met).distinct()


def near_groups(docs: DataFrame, width: int = 3) -> DataFrame:
    """[doc_id, text_hash, fp, group_fp, component_id] of every row.

    ``group_fp`` names the component by its smallest fingerprint, ``component_id`` by its smallest
    document id.
    """
    rows = stored(fingerprints(docs, width), "fingerprints")
    classes = stored(rows.groupBy("fp").agg(F.min("doc_id").alias("first_doc")), "classes")
    roots = stored(components(near_links(classes)), "roots")
    linked = classes.join(roots.withColumnRenamed("node", "fp"), "fp")
    smallest = stored(linked.groupBy("root").agg(F.min("first_doc").alias("component_id")), "smallest")
    named = stored(roots.join(smallest, "root").withColumnRenamed("node", "fp"), "named")
    every = classes.join(named, "fp", "left").select(
        "fp",
        F.coalesce("root", "fp").alias("group_fp"),
        F.when(F.col("root").isNull(), F.col("first_doc")).otherwise(F.col("component_id")).alias("component_id"),
    )
    return rows.join(stored(every, "every"), "fp").select("doc_id", "text_hash", "fp", "group_fp", "component_id")


def fingerprint_hex(fp):
    return F.lpad(F.lower(F.hex(fp)), 16, "0")
