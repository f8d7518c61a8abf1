"""Threshold-scaled sketches of documents: every shingle hash below a fixed fraction is kept.

A shingle is five words, and its hash is kept if it is among the lowest ``1 / SCALE`` of all 64-bit
numbers. Which hashes are kept does not depend on the document, so sketches of parts merge by union
and the share of kept hashes that two sketches have in common estimates containment even between a
paragraph and a book. Text that keeps no hash has only its smallest hash, which is marked by being
above the threshold; the resemblance of two texts of which one is such is that of their smallest hashes,
whose equality is as likely as their resemblance, and how much of it another text contains cannot be said (null)
unless those are equal. A merge keeps the smallest hash as long as it has none below the threshold.

A sketch is a string of hexadecimal groups in ascending order, one per hash. Null and empty texts
have the empty sketch; two empty sketches are alike (1), an empty and another are not (0). Equal
texts have equal sketches.

``edited_pairs`` compares each document with the one after it and with a text edited from both. Rows
are ordered by document id, nulls last, then by text. Row ranges are made by quantiles of the ids,
each range is one group of a shuffle, and the first row of a range is sent a second time to the range
before it, so that text is shuffled once and no task sees more than its ranges. Repeated rows follow
each other; a single row is followed by itself.
"""

from __future__ import annotations

import bisect
from collections.abc import Iterator

import numpy as np
import pandas as pd
import pyarrow as pa
from pyspark.sql import Column, DataFrame
from pyspark.sql import functions as F

from retailflow.llm.common import sha256_hex, stored
from retailflow.llm.simhash import shingle_hashes

WIDTH = 5
SCALE = 4
DIGITS = 12  # hexadecimal digits kept of a hash: 48 bits
#: Rows of one range; the number of ranges grows with the table up to ``MOST_RANGES``.
RANGE_ROWS = 1_000
MOST_RANGES = 10_000

_SHIFT = np.uint64(64 - 4 * DIGITS)
THRESHOLD = (1 << 4 * DIGITS) // SCALE


def sketch(text: str) -> np.ndarray:
    """Ascending distinct 48-bit shingle hashes below the threshold, else the smallest of all."""
    hashes = np.unique(shingle_hashes(text, WIDTH) >> _SHIFT)
    kept = hashes[: np.searchsorted(hashes, THRESHOLD)]
    return kept if len(kept) else hashes[:1]


def merge(a: np.ndarray, b: np.ndarray) -> np.ndarray:
    """Sketch of both texts together (without shingles across the join)."""
    hashes = np.union1d(a, b)
    kept = hashes[: np.searchsorted(hashes, THRESHOLD)]
    return kept if len(kept) else hashes[:1]


def compare(a: np.ndarray, b: np.ndarray) -> tuple[float, float | None, float | None]:
    """Resemblance of two sketches, and how much of the first and of the second the other contains."""
    if not len(a) or not len(b):
        same = float(len(a) == len(b))
        return same, same, same
    if a[0] >= THRESHOLD or b[0] >= THRESHOLD:
        if a[0] == b[0]:
            return 1.0, 1.0, 1.0
        # What keeps hashes is not contained in what keeps none.
        return 0.0, *(None if own[0] >= THRESHOLD else 0.0 for own in (a, b))
    common = len(np.intersect1d(a, b, assume_unique=True))
    return common / (len(a) + len(b) - common), common / len(a), common / len(b)


def as_text(hashes: np.ndarray) -> str:
    return hashes.astype(">u8").view(np.uint8).reshape(-1, 8)[:, 8 - DIGITS // 2 :].tobytes().hex()


def from_text(value: str) -> np.ndarray:
    return np.array([int(value[i : i + DIGITS], 16) for i in range(0, len(value), DIGITS)], dtype=np.uint64)


def sketches(docs: DataFrame, text: str = "text") -> DataFrame:
    """``docs`` with the sketch of each text as ``sketch``."""

    @F.pandas_udf("string")
    def sketch_text(values: pd.Series) -> pd.Series:
        return values.map(lambda x: as_text(sketch(x or "")))

    return docs.withColumn("sketch", sketch_text(F.col(text)))


def containment(left: Column, right: Column) -> Column:
    """Share of the first sketch's text that the second's contains; null where a sketch is null or says nothing."""

    @F.pandas_udf("double")
    def share(a: pd.Series, b: pd.Series) -> pd.Series:
        rows = zip(a, b, strict=True)
        found = [None if x is None or y is None else compare(from_text(x), from_text(y))[1] for x, y in rows]
        return pd.Series(found, dtype="float64")

    return share(left, right)


def edit(text: str, after: str) -> str:
    """The last half of a text replaced by as much of the text after it, or all of that."""
    half = len(text) // 2
    return text[: len(text) - half] + after[:half]


FIELDS = (
    "doc_id long, n_chars long, edited_sha256 string, fingerprint string, edited_fingerprint string, "
    "near_edited double, near_next double, contained_in_edited double, contained_in_next double"
)


def _describe(rows: list[tuple]) -> pd.DataFrame:
    """Result rows of (id, text, sketch, text after, sketch after)."""
    out = []
    for doc_id, text, own, after, following in rows:
        edited = edit(text, after)
        changed = own if edited == text else following if edited == after else sketch(edited)
        near_edited, in_edited, _ = compare(own, changed)
        near_next, in_next, _ = compare(own, following)
        digest = sha256_hex(edited.encode())
        out.append((doc_id, len(text), digest, as_text(own), as_text(changed), near_edited, near_next, in_edited, in_next))
    columns = [x.split()[0] for x in FIELDS.split(", ")]
    types = {"doc_id": "Int64", "contained_in_edited": "float64", "contained_in_next": "float64"}
    return pd.DataFrame(out, columns=columns).astype(types)


def range_starts(docs: DataFrame) -> list[int | None]:
    """Smallest id of every range that has rows, ascending; None stands for null ids and comes last."""
    n = docs.count()
    cuts = min(MOST_RANGES, max(1, n // RANGE_ROWS))
    steps = [k / cuts for k in range(1, cuts)]
    bounds = docs.agg(F.percentile_approx("doc_id", F.array(*map(F.lit, steps)), 10 * cuts)).first()[0] if steps else []
    bounds = sorted(set(bounds or []))
    starts = stored(_ranged(docs.select("doc_id"), bounds).groupBy("part").agg(F.min("doc_id").alias("first")), "starts")
    found = [row["first"] for row in starts.collect()]
    return sorted(x for x in found if x is not None) + [None] * (None in found)


def _ranged(ids: DataFrame, bounds: list[int]) -> DataFrame:
    def run(frames: Iterator[pa.RecordBatch]) -> Iterator[pa.RecordBatch]:
        for batch in frames:
            ids = batch.column(0).to_pandas(integer_object_nulls=True)
            part = [len(bounds) + 1 if x is None else bisect.bisect_right(bounds, x) for x in ids]
            yield pa.RecordBatch.from_arrays([batch.column(0), pa.array(part, pa.int32())], ["doc_id", "part"])

    return ids.mapInArrow(run, "doc_id long, part int")


def edited_pairs(docs: DataFrame) -> DataFrame:
    """Each document's sketch, that of its edited text, and its likeness to that and to the next document."""
    rows = docs.select(F.col("doc_id").cast("long"), F.coalesce("text", F.lit("")).alias("text"))
    starts = range_starts(rows)
    if not starts:
        return docs.sparkSession.createDataFrame([], FIELDS)
    numbers = [x for x in starts if x is not None]
    ranges = len(starts)

    def deal(batches: Iterator[pa.RecordBatch]) -> Iterator[pa.RecordBatch]:
        """Range of each row, and the first rows of each range once more for the range before."""
        first = {x: k for k, x in enumerate(starts)}
        for batch in batches:
            ids = batch.column(0).to_pylist()
            part = [ranges - 1 if x is None else bisect.bisect_right(numbers, x) - 1 for x in ids]
            again = [i for i, x in enumerate(ids) if x in first]
            copies = batch.take(pa.array(again, pa.int64()))
            part += [(first[ids[i]] - 1) % ranges for i in again]
            kind = [0] * len(ids) + [1] * len(again)
            for piece, low, high in ((batch, 0, len(ids)), (copies, len(ids), len(part))):
                extra = [pa.array(part[low:high], pa.int32()), pa.array(kind[low:high], pa.int32())]
                yield pa.RecordBatch.from_arrays([*piece.columns, *extra], ["doc_id", "text", "part", "borrowed"])

    def follow(frames: Iterator[pd.DataFrame]) -> Iterator[pd.DataFrame]:
        """Rows in order; each is described when the row after it is known."""
        held, part, done = None, None, True
        for frame in frames:
            out = []
            ids = frame["doc_id"].astype(object).where(frame["doc_id"].notna(), None)
            for doc_id, text, here, borrowed in zip(ids, frame["text"], frame["part"], frame["borrowed"], strict=True):
                if here != part:
                    held, part, done = None, here, False
                if done:
                    continue
                own = held[2] if held and held[1] == text else sketch(text)
                if held:
                    out.append((*held, text, own))
                held, done = (None if doc_id is None else int(doc_id), text, own), bool(borrowed)
            yield _describe(out)

    dealt = rows.mapInArrow(deal, "doc_id long, text string, part int, borrowed int")
    nulls_last = F.col("doc_id").asc_nulls_last()
    ordered = dealt.repartition("part").sortWithinPartitions("part", "borrowed", nulls_last, "text")
    return ordered.mapInPandas(follow, FIELDS)
