"""Mixing of sources to target weights by thresholds on a hash histogram.

Every source gets a target number of words. A document is taken ``floor(target / source size)`` times,
and once more if its hash lies below the threshold of its source. Thresholds are found without
sorting: words are summed by source and hash bucket, the bucket in which the running sum passes the
budget is the boundary, and only its documents are summed again by the next bits of the hash. After
``LEVELS`` levels the boundary bucket is one part in 2^36: one document, or rows that repeat it. Its rows
are taken one by one, smaller ones first, as long as more than half of the next one is due, so a source
ends within half a document of its budget. Only these rows are counted and numbered. Hashes do not depend on
budgets, so the documents of a smaller budget are among those of a larger one.

The hash is the MD5 digest of the document id and text, so equal inputs give equal mixes on every
run; which of the rows that repeat both are taken makes no difference. Null ids, sources and texts
are values like any other; a null text has size 0. An empty table gives an empty mix. Sources without
words have target 0 and documents without words follow their source's thresholds.

Text is read once, for sizes and hashes; all that follows moves narrow rows. The sources' table is
broadcast only where it is counted to be small; else Spark joins by shuffle and splits hot sources.
"""

from __future__ import annotations

from collections.abc import Sequence

from pyspark.sql import Column, DataFrame, Window
from pyspark.sql import functions as F
from pyspark.sql import types as T

from retailflow.llm.common import broadcast_up_to, stored, word_count

WEIGHTS = (5, 2, 1)
TOTAL_SHARE = 1.5
MOST_TIMES = 2
BITS, LEVELS = 12, 3
#: Sources above this number are joined by shuffle.
FEW_SOURCES = 10_000


def hash36(doc_id: Column, text: Column) -> Column:
    """36 bits of the MD5 digest of id and text."""
    known = F.concat_ws(":", F.coalesce(doc_id.cast("string"), F.lit("-")), F.md5(F.coalesce(text, F.lit("")).cast("binary")))
    return F.conv(F.substring(F.md5(known.cast("binary")), 1, BITS * LEVELS // 4), 16, 10).cast("long")


def sized(docs: DataFrame) -> DataFrame:
    """[doc_id, source, size, place] of every row: words and hash."""
    return docs.select(
        "doc_id",
        F.col("source").cast("string").alias("source"),
        word_count(F.col("text")).alias("size"),
        hash36(F.col("doc_id"), F.col("text")).alias("place"),
    )


def source_targets(rows: DataFrame, weights: Sequence[float] = WEIGHTS, total_share: float = TOTAL_SHARE) -> DataFrame:
    """[source, source_size, target]: one row a source.

    Weights go round the sources in code point order, null last. The share of a weight rises until
    all of ``total_share`` is dealt, while no target passes ``MOST_TIMES`` the source's size: with
    sources in order of size by weight, those up to some place are full and the rest split what is
    left by weight. The windows without partition run over one row per source.
    """
    sums = rows.groupBy("source").agg(F.sum("size").cast("double").alias("source_size"))
    by_name = Window.orderBy(F.col("source").asc_nulls_last())
    turn = F.pmod(F.row_number().over(by_name) - 1, F.lit(len(weights))) + 1
    weighed = sums.select(
        "source",
        "source_size",
        F.element_at(F.array(*[F.lit(float(w)) for w in weights]), turn).alias("weight"),
        (F.col("source_size") * MOST_TIMES).alias("most"),
    )
    everything = Window.orderBy(F.lit(0)).rowsBetween(Window.unboundedPreceding, Window.unboundedFollowing)
    by_level = Window.orderBy(F.col("most") / F.col("weight"), F.col("source").asc_nulls_last())
    before = by_level.rowsBetween(Window.unboundedPreceding, -1)
    full = weighed.withColumns(
        {
            "budget": F.sum("source_size").over(everything) * total_share - F.coalesce(F.sum("most").over(before), F.lit(0.0)),
            "sharing": F.sum("weight").over(everything) - F.coalesce(F.sum("weight").over(before), F.lit(0.0)),
        }
    ).withColumn("level", F.col("budget") / F.col("sharing"))
    # The first source that the rest of the budget does not fill sets the level for itself and all after it.
    level = F.min(F.when(F.col("most") >= F.col("level") * F.col("weight"), F.struct(F.col("most") / F.col("weight"), "level")))
    share = level.over(everything)["level"] * F.col("weight")
    return full.select(
        "source",
        F.col("source_size").cast("long").alias("source_size"),
        F.round(F.coalesce(F.least("most", share), F.col("most")), 6).alias("target"),
    )


def _cell(level: int) -> Column:
    """Bucket of a hash at a level, coarse to fine."""
    return F.shiftright(F.col("place"), BITS * (LEVELS - 1 - level))


def thresholds(rows: DataFrame, targets: DataFrame) -> DataFrame:
    """[source, source_size, target, times, below, due]: whole passes, the hash below which one more is taken, and
    the words that are still due there."""
    size = F.greatest(F.col("source_size"), F.lit(1))
    plan = targets.withColumn("times", F.floor(F.col("target") / size))
    plan = plan.withColumns({"due": F.col("target") - F.col("times") * F.col("source_size"), "bucket": F.lit(0).cast("long")})
    for level in range(LEVELS):
        known = stored(plan, f"plan{level}")
        side = broadcast_up_to(known.select(F.col("source").alias("s"), "bucket"), FEW_SOURCES)
        same = F.col("source").eqNullSafe(F.col("s"))
        open_rows = rows if level == 0 else rows.join(side, same & (_cell(level - 1) == F.col("bucket"))).drop("s", "bucket")
        sums = open_rows.groupBy("source", _cell(level).alias("cell")).agg(F.sum("size").alias("words"))
        upto = F.sum("words").over(Window.partitionBy("source").orderBy("cell"))
        running = sums.withColumn("upto", upto).withColumnRenamed("source", "s")
        due = known.select("source", "due")
        # The boundary is the first cell whose running sum passes what is due; the cells below it are taken.
        passed = due.join(running, F.col("source").eqNullSafe(F.col("s"))).where(F.col("upto") > F.col("due"))
        first = passed.groupBy("source").agg(F.min(F.struct("cell", "words", "upto")).alias("edge"))
        first = first.withColumnRenamed("source", "s")
        taken = F.col("edge.upto") - F.col("edge.words")
        plan = known.join(first, F.col("source").eqNullSafe(F.col("s")), "left").select(
            "source",
            "source_size",
            "target",
            "times",
            F.when(F.col("edge").isNull(), F.lit(0.0)).otherwise(F.col("due") - taken).alias("due"),
            # Without a boundary nothing is left over: the bucket after the last.
            F.coalesce("edge.cell", F.lit(1 << BITS * (level + 1)).cast("long")).alias("bucket"),
            F.col("edge.words").alias("words"),
        )
    return plan.select("source", "source_size", "target", "times", F.col("bucket").alias("below"), "due")


def edge_groups(edge: DataFrame, keys: list[str], first: list[str]) -> DataFrame:
    """Rows at the boundary of their source, counted, with the part of each group that is taken once more.

    ``edge`` has [source, due, size] and the columns named. Rows with equal ``keys`` that one task reads are a group [keys...,
    first..., n, more]: ``n`` rows, of which ``more`` are taken. Groups are small enough for one task and
    their order does not need the columns ``first``.
    """
    counted = edge.withColumn("__part", F.spark_partition_id()).groupBy(*keys, "source", "due", "size", "__part")
    groups = counted.agg(F.count(F.lit(1)).alias("n"), *[F.first(c).alias(c) for c in first])
    groups = stored(groups.withColumn("__group", F.monotonically_increasing_id()), "edge")
    words = F.col("n") * F.col("size")
    order = Window.partitionBy("source").orderBy("size", *[k for k in keys if k == "doc_id"], "__group")
    before = F.sum(words).over(order) - words
    # A row is taken where more than half of it is due; a row without words where anything or nothing is left over.
    left = F.col("due") - before
    more = F.when(F.col("size") == 0, F.when(left >= 0, F.col("n")).otherwise(0)).otherwise(
        F.least(F.greatest(F.ceil(left / F.greatest("size", F.lit(1)) - 0.5), F.lit(0)), F.col("n"))
    )
    taken = groups.select("__group", "source", "due", "size", "n", *[k for k in keys if k == "doc_id"]).select("__group", more.cast("long").alias("more"))
    return groups.join(taken, "__group").drop("__group", "__part", "due")


def _planned(rows: DataFrame, **law) -> DataFrame:
    """[s, source_size, target, times, below, due] by source, ready to join."""
    plan = stored(thresholds(rows, source_targets(rows, **law)), "thresholds")
    return broadcast_up_to(plan.withColumnRenamed("source", "s"), FEW_SOURCES)


def mixed(rows: DataFrame, **law) -> DataFrame:
    """``rows`` (of ``sized``, stored) with [source_size, target, copies]."""
    joined = rows.join(_planned(rows, **law), F.col("source").eqNullSafe(F.col("s")))
    out = ["doc_id", "source", "size", "place", "source_size", "target", "copies"]
    copies = F.col("times") + (F.col("place") < F.col("below")).cast("long")
    inner = joined.where("place != below").withColumn("copies", copies).select(out)
    edge = edge_groups(joined.where("place = below"), ["doc_id", "place", "source_size", "target", "times"], [])
    number = F.explode(F.sequence(F.lit(1).cast("long"), F.col("n"))).alias("number")
    edge = edge.select("*", number).withColumn("copies", F.col("times") + (F.col("number") <= F.col("more")).cast("long"))
    return inner.unionByName(edge.select(out))


def mix_report(docs: DataFrame) -> DataFrame:
    """[doc_id, size, source_size, target, taken] of every row."""
    out = mixed(stored(sized(docs), "sized"))
    return out.select("doc_id", "size", "source_size", "target", (F.col("size") * F.col("copies")).alias("taken"))


def mix_documents(docs: DataFrame) -> DataFrame:
    """The documents of the mix, each as often as it is taken, with the columns of ``docs``.

    Thresholds join the documents as they are read, so text is not shuffled, but for one text of each group at
    the boundary of a source. Rows of such a group that differ in other columns stay apart.
    """
    plan = _planned(stored(sized(docs), "sized"))
    plan = plan.select(*[F.col(c).alias(f"__{c}") for c in ("s", "times", "below", "due")])
    place = hash36(F.col("doc_id"), F.col("text"))
    joined = docs.join(plan, docs["source"].cast("string").eqNullSafe(F.col("__s"))).withColumn("__place", place)
    copies = F.col("__times") + (F.col("__place") < F.col("__below")).cast("long")
    inner = joined.where("__place != __below")
    inner = inner.withColumn("__copy", F.explode(F.sequence(F.lit(1), F.col("__times") + 1))).where(F.col("__copy") <= copies)
    # Names of their own keep the columns of the documents apart from those of the groups.
    plain = {f"__c{k}": c for k, c in enumerate(docs.columns)}
    simple = [k for k, c in plain.items() if c not in ("doc_id", "text") and isinstance(docs.schema[c].dataType, T.AtomicType)]
    others = [k for k, c in plain.items() if k not in simple and c != "doc_id"]
    named = joined.where("__place = __below").select(
        *[docs[c].alias(k) for k, c in plain.items()],
        docs["doc_id"].alias("doc_id"),
        F.xxhash64("text").alias("__hash"),
        F.col("__s").alias("source"),
        F.col("__due").alias("due"),
        F.col("__times").alias("times"),
        word_count(docs["text"]).alias("size"),
    )
    own = [k for k, c in plain.items() if c == "doc_id"]
    edge = edge_groups(named, [*own, *simple, "doc_id", "__hash", "times"], others)
    every = F.col("n") * F.col("times") + F.col("more")
    edge = edge.where(every > 0).withColumn("__copy", F.explode(F.sequence(F.lit(1).cast("long"), every)))
    edge = edge.select(*[F.col(k).alias(c) for k, c in plain.items()])
    return inner.select(*[docs[c] for c in docs.columns]).unionByName(edge)
