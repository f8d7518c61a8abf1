"""Near copies by SimHash and Golay codes: five-word shingles, and a verified similarity of at least 0.8.

The similarity of two texts is the share of their distinct five-word shingles that both have. Texts
without words have none and are alike. A text's shingle hashes are mixed into independent 64-bit
fingerprints, of which a similarity of 0.8 leaves about 15% of the bits different. Their bits are cut
into segments of 23; a segment is decoded to the indices of the Golay codewords that are nearest to it or to a
string one flip away (one index or six), and each index is a key, together with some exact bits that follow the segment.
Two segments at 15% share an index with a chance of 0.61. By the pigeonhole of errors over segments, some
segment has few: ``layout`` takes as many exact bits as keep a bucket at about ``OCCUPANCY`` texts, so the
keys grow with the logarithm of the table, and as many segments as bring the chance of a common key at similarity 0.8 to ``RECALL``.

What meets in a bucket is compared by one fingerprint that is part of no key, then by all bits of both texts, and what is
left is verified by its shingles exactly. Groups are the components of verified pairs. First, each
text is verified against the nearest text it met and one more; ``ROUNDS`` times over, with texts of other components than its
own. Then the other near pairs follow that are not in one component yet. A bucket with very many near pairs gives only links to its first rows at first; afterwards its rows
outside its largest component are compared with all its rows, in pieces. So a large group costs time in
proportion to its size, and no pair of different components is left out.
"""

from __future__ import annotations

import math
from collections.abc import Iterator
from dataclasses import dataclass

import numpy as np
import pyarrow as pa
from pyspark.sql import Column, DataFrame
from pyspark.sql import functions as F

from retailflow.llm import golay
from retailflow.llm.common import broadcast_up_to, map_rows, stored
from retailflow.llm.graph import components
from retailflow.llm.simhash import BLOCK, shingle_hashes
from retailflow.llm.verify import FEW, text_id, verified

WIDTH, PERCENT = 5, 80
#: Share of bits that differ at similarity 0.8, and the chance that two such segments share a Golay key.
DIFFERING, SHARED_KEY, KEYS = 0.1515, 0.605, 5.3
RECALL, OCCUPANCY = 0.985, 256
RADIUS = 20
#: Near pairs a row, beside a few, above which a bucket gives links to its first rows only, and the number of these.
DENSE, FEW_PAIRS, LEADS = 2, 16, 32
#: Rounds in which each text is verified against two texts of other components before all other pairs are.
ROUNDS = 2
#: Words of 64 bits of the bitmap of a set.
BIT_WORDS = 64
#: Rows of a bucket that a task holds; a longer one is read in parts.
HELD = 16_384
#: Comparisons of a bucket that are made in one place.
PIECE = 20_000_000


@dataclass(frozen=True)
class Layout:
    segments: int
    exact: int

    @property
    def prints(self) -> int:
        """Fingerprints that the segments and their exact bits take, and the one for comparing."""
        return -(-self.segments * (golay.LENGTH + self.exact) // 64) + 1

    @property
    def most_bits(self) -> int:
        """Differing bits of all fingerprints that about one pair of similarity 0.8 in 30,000 exceeds."""
        bits = 64 * self.prints
        return int(bits * DIFFERING + 4 * math.sqrt(bits * DIFFERING * (1 - DIFFERING)))


def layout(texts: int) -> Layout:
    """Segments and exact bits for a number of distinct texts."""
    codewords = 1 << golay.LENGTH - golay.CHECK_BITS
    exact = max(0, math.ceil(math.log2(max(1, KEYS * texts) / (codewords * OCCUPANCY))))
    chance = SHARED_KEY * (1 - DIFFERING) ** exact
    return Layout(math.ceil(math.log(1 - RECALL) / math.log(1 - chance)), exact)


def _majority(words: np.ndarray) -> np.ndarray:
    """For each column of 64-bit words the number whose bit is 1 where more than half of the rows have it."""
    half, planes = len(words) // 2, []
    while len(words):
        # Full adders: three words of a weight become one of that weight and one of the next.
        carries = []
        while len(words) > 1:
            third = len(words) // 3 or 1
            a, b = words[:third], words[third : 2 * third]
            c = words[2 * third : 3 * third] if len(words) > 2 else np.zeros_like(a)
            either = a ^ b
            carries.append(a & b | either & c)
            words = np.concatenate([either ^ c, words[3 * third :]])
        planes.append(words[0])
        words = np.concatenate(carries) if carries else words[:0]
    more = np.zeros_like(planes[0])
    equal = ~more
    for place in reversed(range(len(planes))):
        if half >> place & 1:
            equal &= planes[place]
        else:
            more |= equal & planes[place]
            equal &= ~planes[place]
    return more


def _mixed(hashes: np.ndarray, first: int, end: int) -> np.ndarray:
    """Independent hashes number ``first`` to ``end`` of each hash, one column each."""
    x = hashes[:, None] + np.arange(first + 1, end + 1, dtype=np.uint64) * np.uint64(0x9E3779B97F4A7C15)
    x = (x ^ x >> np.uint64(30)) * np.uint64(0xBF58476D1CE4E5B9)
    x = (x ^ x >> np.uint64(27)) * np.uint64(0x94D049BB133111EB)
    return x ^ x >> np.uint64(31)


def prints(hashes: np.ndarray, number: int) -> np.ndarray:
    """``number`` fingerprints of distinct shingle hashes."""
    out = np.zeros(number, np.uint64)
    if len(hashes):
        step = max(1, BLOCK // len(hashes))
        for k in range(0, number, step):
            end = min(number, k + step)
            out[k:end] = _majority(_mixed(hashes, k, end))
    return out


def shingle_set(text: str) -> np.ndarray:
    return np.unique(shingle_hashes(text, WIDTH))


def bitmap(hashes: np.ndarray) -> np.ndarray:
    """The bits that the hashes of a set fall on."""
    bits = np.zeros(64 * BIT_WORDS, np.uint8)
    bits[(hashes >> np.uint64(40)).astype(np.int64) % len(bits)] = 1
    return np.packbits(bits, bitorder="little").view("<i8")


def _may_be_alike(left: str, right: str) -> Column:
    """Whether the bitmaps allow the similarity.

    Common shingles lie on common bits, and those that share a bit with another one of their own set are ``extra``:
    the common bits and the lesser extra bound the intersection from above.
    """
    common = " + ".join(f"bit_count({left}.bits[{k}] & {right}.bits[{k}])" for k in range(BIT_WORDS))
    most = f"least({common} + least({left}.extra, {right}.extra), {left}.n, {right}.n)"
    return F.expr(f"{100 + PERCENT} * {most} >= {PERCENT} * ({left}.n + {right}.n)")


def printed(docs: DataFrame, plan: Layout) -> DataFrame:
    """[id, prints, n, bits] of each distinct text of ``docs`` [id, text]: fingerprints, number of shingles and bitmap."""
    number = plan.prints

    def described(text: str) -> tuple:
        hashes = shingle_set(text)
        return prints(hashes, number).view(np.int64).tolist(), len(hashes), bitmap(hashes).tolist()

    start = lambda: lambda texts: [described(text) for text in texts]
    fields = (("prints", "array<long>"), ("n", "int"), ("bits", "array<long>"))
    made = map_rows(docs, "text", fields, start, ["id"])
    return made.groupBy("id").agg(*[F.max(c).alias(c) for c in ("prints", "n", "bits")])


def segment_keys(words: np.ndarray, plan: Layout) -> tuple[np.ndarray, np.ndarray]:
    """Row numbers and keys of fingerprint rows, each key of a row once."""
    bits = np.unpackbits(np.ascontiguousarray(words, "<u8").view(np.uint8), axis=1, bitorder="little")
    row, key = [], []
    for k in range(plan.segments):
        low = k * (golay.LENGTH + plan.exact)
        segment = bits[:, low : low + golay.LENGTH] @ (np.int64(1) << np.arange(golay.LENGTH))
        exact = bits[:, low + golay.LENGTH : low + golay.LENGTH + plan.exact] @ (np.int64(1) << np.arange(plan.exact))
        near = golay.keys(segment, golay.LENGTH)
        own, place = np.nonzero(np.diff(near, axis=1, prepend=np.uint32(1 << golay.LENGTH)))
        row.append(own)
        key.append((np.int64(k) << plan.exact | exact[own]) << 12 | near[own, place])
    return np.concatenate(row), np.concatenate(key)


def keyed(classes: DataFrame, plan: Layout) -> DataFrame:
    """[key, id, fp, n]: every class under each of its keys."""

    def run(batches: Iterator[pa.RecordBatch]) -> Iterator[pa.RecordBatch]:
        for whole in batches:
            for low in range(0, whole.num_rows, 1_000):
                batch = whole.slice(low, 1_000)
                words = batch.column(1).flatten().to_numpy(zero_copy_only=False).reshape(batch.num_rows, -1)
                row, key = segment_keys(words[:, :-1].astype(np.int64).view(np.uint64), plan)
                place = pa.array(row)
                fp = pa.array(np.ascontiguousarray(words[:, -1]).astype(np.int64)).take(place)
                yield pa.RecordBatch.from_arrays(
                    [pa.array(key), batch.column(0).take(place), fp, batch.column(2).take(place)], ["key", "id", "fp", "n"]
                )

    return classes.select("id", "prints", "n").mapInArrow(run, "key long, id long, fp long, n int")


def _near(fp, n, left, right) -> np.ndarray:
    alike = np.bitwise_count(fp[left] ^ fp[right]) <= RADIUS
    return alike & (100 * np.minimum(n[left], n[right]) >= PERCENT * np.maximum(n[left], n[right]))


def bucket_pairs(key, fp, n) -> tuple[np.ndarray, np.ndarray, np.ndarray]:
    """Row numbers of near pairs of whole buckets of sorted rows, and the keys of dense buckets.

    Of a dense bucket each row comes with the first of the ``LEADS`` that is near it.
    """
    new = np.r_[True, key[1:] != key[:-1]]
    bucket = np.cumsum(new) - 1
    first = np.flatnonzero(new)
    start, most = first[bucket], DENSE * np.diff(np.r_[first, len(key)]) + FEW_PAIRS
    rows = np.flatnonzero(np.arange(len(key)) > start)
    found = np.zeros(len(first), np.int64)
    left, right, place = [], [], 0
    while len(rows):
        lead = start[rows] + place
        near = _near(fp, n, lead, rows)
        left.append(lead[near])
        right.append(rows[near])
        place += 1
        stay = rows > start[rows] + place
        if near.any():
            found += np.bincount(bucket[rows[near]], minlength=len(found))
            if place >= LEADS:
                stay &= (found <= most)[bucket[rows]]
        rows = rows[stay]
    left, right = (np.concatenate(x or [rows]) for x in (left, right))
    dense = found > most
    in_dense = dense[bucket[left]]
    # Pairs come in order of the left row, so the first of a row is that of its first near lead.
    leads = np.flatnonzero(in_dense & (left - start[left] < LEADS))
    leads = leads[np.unique(right[leads], return_index=True)[1]]
    chosen = np.concatenate([np.flatnonzero(~in_dense), leads])
    return left[chosen], right[chosen], key[first[dense]]


def bucket_links(rows: DataFrame) -> DataFrame:
    """[a, b, key]: near pairs of ``rows`` (of ``keyed``) that share a bucket, a < b; rows with a key name dense buckets."""

    def out(ids, left, right, dense):
        a, b = np.minimum(ids[left], ids[right]), np.maximum(ids[left], ids[right])
        pairs = np.unique(np.stack([a, b]), axis=1)
        ends = [pa.concat_arrays([pa.array(x), pa.nulls(len(dense), pa.int64())]) for x in pairs]
        keys = pa.concat_arrays([pa.nulls(pairs.shape[1], pa.int64()), pa.array(np.asarray(dense, np.int64))])
        return pa.RecordBatch.from_arrays([*ends, keys], ["a", "b", "key"])

    def run(batches: Iterator[pa.RecordBatch]) -> Iterator[pa.RecordBatch]:
        held = [np.zeros(0, np.int64)] * 4  # key, id, fp, n of rows that wait for the end of their bucket
        long_bucket = None  # the key of a bucket that did not fit, of which only the first rows are held
        for batch in batches:
            fresh = [c.to_numpy(zero_copy_only=False).astype(np.int64) for c in batch.columns]
            held = [np.concatenate(x) for x in zip(held, fresh, strict=True)]
            while len(held[0]):
                cut = int(np.searchsorted(held[0], held[0][-1]))
                if long_bucket is not None and held[0][0] == long_bucket:
                    stop = int(np.searchsorted(held[0], long_bucket, "right"))
                    lead, rest = np.arange(min(LEADS, stop)), np.arange(min(LEADS, stop), stop)
                    left, right = (x.ravel() for x in np.meshgrid(lead, rest, indexing="ij"))
                    near = _near(held[2].view(np.uint64), held[3], left, right)
                    left, right = left[near], right[near]
                    once = np.unique(right, return_index=True)[1]
                    yield out(held[1], left[once], right[once], [])
                    if stop == len(held[0]):
                        held = [x[:LEADS] for x in held]
                        break
                    held, long_bucket = [x[stop:] for x in held], None
                elif cut:
                    done = [x[:cut] for x in held]
                    left, right, dense = bucket_pairs(done[0], done[2].view(np.uint64), done[3])
                    yield out(done[1], left, right, dense)
                    held = [x[cut:] for x in held]
                elif len(held[0]) > HELD:
                    long_bucket = held[0][0]
                    yield out(held[1], np.zeros(0, int), np.zeros(0, int), [long_bucket])
                else:
                    break
        if len(held[0]) and (long_bucket is None or held[0][0] != long_bucket):
            left, right, dense = bucket_pairs(held[0], held[2].view(np.uint64), held[3])
            yield out(held[1], left, right, dense)

    ordered = rows.repartition("key").sortWithinPartitions("key", "id")
    return ordered.select("key", "id", "fp", "n").mapInArrow(run, "a long, b long, key long")


def _distance(left: str, right: str, plan: Layout) -> Column:
    """Differing bits of all fingerprints."""
    return F.expr(" + ".join(f"bit_count({left}[{k}] ^ {right}[{k}])" for k in range(plan.prints)))


def _near_pairs(pairs: DataFrame, classes: DataFrame, plan: Layout) -> DataFrame:
    """[a, b, d]: the ``pairs`` [a, b] whose fingerprints are near as a whole, with the differing bits."""
    sides = [classes.select(F.col("id").alias(c), F.col("prints").alias(f"p_{c}")) for c in ("a", "b")]
    both = pairs.join(sides[0], "a").join(sides[1], "b").select("a", "b", _distance("p_a", "p_b", plan).alias("d"))
    return both.where(F.col("d") <= plan.most_bits)


def first_tries(near: DataFrame) -> DataFrame:
    """[a, b]: of the ``near`` pairs [a, b, d] the nearest of every text, and another one picked by a hash."""
    ends = F.explode(F.array(F.struct(F.col("a").alias("id"), F.col("b").alias("other")), F.struct(F.col("b").alias("id"), F.col("a").alias("other"))))
    each = near.select(ends.alias("e"), "d").select("e.*", "d")
    best = each.groupBy("id").agg(
        F.min_by("other", F.struct("d", "other")).alias("nearest"), F.min_by("other", F.xxhash64("id", "other")).alias("another")
    )
    tries = best.select("id", F.explode(F.array("nearest", "another")).alias("other"))
    return tries.select(F.least("id", "other").alias("a"), F.greatest("id", "other").alias("b")).distinct()


def outsider_pairs(rows: DataFrame, classes: DataFrame, roots: DataFrame, plan: Layout) -> DataFrame:
    """[a, b]: near pairs of different components in the buckets of ``rows`` [key, id, n].

    Of such a pair one text at least is outside the largest component of the bucket: these are compared
    with all rows of the bucket, in pieces, by all bits of both and by bitmaps of their sets.
    """
    extra = F.expr("n - aggregate(bits, 0, (s, x) -> s + bit_count(x))").alias("extra")
    sides = classes.select("id", "prints", "bits", extra)
    known = rows.select("key", "id", "n").join(sides, "id").join(roots, "id", "left").withColumn("root", F.coalesce("root", "id"))
    known = stored(known, "dense_rows")
    cells = known.groupBy("key", "root").agg(F.count(F.lit(1)).alias("c"))
    sizes = cells.groupBy("key").agg(F.sum("c").alias("size"), F.max(F.struct("c", "root")).alias("most"))
    outside = F.col("size") - F.col("most.c")
    pieces = F.greatest(F.ceil(outside * F.col("size") / PIECE), F.lit(1)).cast("int")
    mixed = stored(
        sizes.where(outside > 0).select("key", F.col("most.root").alias("largest"), pieces.alias("pieces")), "mixed"
    )
    placed = stored(known.join(mixed, "key"), "placed")
    left = placed.where("root != largest").withColumn("piece", F.pmod(F.xxhash64("id"), F.col("pieces")).cast("int"))
    right = placed.withColumn("piece", F.explode(F.sequence(F.lit(0), F.col("pieces") - 1)))
    once = (F.col("r.root") == F.col("r.largest")) | (F.col("l.id") < F.col("r.id"))
    near = F.expr(f"100 * least(l.n, r.n) >= {PERCENT} * greatest(l.n, r.n)")
    near = near & (_distance("l.prints", "r.prints", plan) <= plan.most_bits) & _may_be_alike("l", "r")
    same = (F.col("l.key") == F.col("r.key")) & (F.col("l.piece") == F.col("r.piece"))
    met = left.alias("l").join(right.alias("r"), same & (F.col("l.root") != F.col("r.root")) & once & near)
    return met.select(F.least("l.id", "r.id").alias("a"), F.greatest("l.id", "r.id").alias("b")).distinct()


def _apart(near: DataFrame, tried: DataFrame, roots: DataFrame) -> DataFrame:
    """The ``near`` pairs [a, b, d] of different components that were not tried."""
    sides = [roots.select(F.col("id").alias(c), F.col("root").alias(f"root_{c}")) for c in ("a", "b")]
    both = near.join(sides[0], "a", "left").join(sides[1], "b", "left")
    return both.where("NOT coalesce(root_a, a) = coalesce(root_b, b)").select("a", "b", "d").join(tried, ["a", "b"], "left_anti")


def _roots(links: DataFrame, name: str) -> DataFrame:
    return stored(components(links).withColumnRenamed("node", "id"), name)


def near_copies(docs: DataFrame) -> DataFrame:
    """[text_hash, group] of every distinct text that has near copies; the group is the smallest hash in it."""
    rows = docs.select(text_id(F.col("text")).alias("id"), "text")
    plan = layout(rows.agg(F.approx_count_distinct("id", 0.01)).first()[0])
    classes = stored(printed(rows, plan), "classes")
    met = stored(bucket_links(keyed(classes, plan)), "met")
    pairs = met.where("key IS NULL").select("a", "b").distinct()
    near = stored(_near_pairs(pairs, classes, plan), "near")
    links, tried = None, None
    for number in range(ROUNDS):
        tries = first_tries(near if links is None else _apart(near, tried, roots))
        tries = stored(tries, f"tries{number}")
        if links is not None and tries.isEmpty():
            break
        good = stored(verified(tries, rows, shingle_set, PERCENT), f"links{number}")
        links, tried = (good, tries) if links is None else (links.unionByName(good), tried.unionByName(tries))
        roots = _roots(links, "roots")
    apart = _apart(near, tried, roots).select("a", "b")
    dense = stored(met.where("key IS NOT NULL").select("key").distinct(), "dense")
    if not dense.isEmpty():
        again = keyed(classes, plan).join(broadcast_up_to(dense, FEW), "key", "left_semi")
        apart = apart.unionByName(outsider_pairs(again, classes, roots, plan)).distinct()
    rest = stored(apart.join(tried, ["a", "b"], "left_anti"), "rest")
    found = _roots(links.unionByName(stored(verified(rest, rows, shingle_set, PERCENT), "more")), "groups")
    return found.select(F.col("id").alias("text_hash"), F.col("root").alias("group"))
