"""Splitting of hot keys.

A key with more rows than one task should hold is cut into slices. The hot keys are found with a
partial aggregation and written to a table, whose rows are counted from the file: up to
``FEW_HOT_KEYS`` of them are broadcast to the rows they tag, more are joined by shuffle, where Spark
splits the skewed side.
"""

from __future__ import annotations

from pyspark.sql import Column, DataFrame
from pyspark.sql import functions as F

from retailflow.session import written

#: Hot keys up to this number are broadcast; at two numbers a key that is a few megabytes.
FEW_HOT_KEYS = 100_000


def hot_keys(rows: DataFrame, key: str, rows_per_slice: int) -> DataFrame:
    """[key, slices] of every key above ``rows_per_slice`` rows."""
    hot = (
        rows.groupBy(key)
        .agg(F.count(F.lit(1)).alias("n"))
        .where(F.col("n") > rows_per_slice)
        .select(key, F.ceil(F.col("n") / rows_per_slice).cast("int").alias("slices"))
    )
    return written(hot, "hot")


def tag_slices(rows: DataFrame, key: str, hot: DataFrame) -> DataFrame:
    """Rows with the slice count of their key, 1 where the key is not hot."""
    few = hot.count() <= FEW_HOT_KEYS
    side = F.broadcast(hot) if few else hot
    return rows.join(side, key, "left").withColumn("slices", F.coalesce("slices", F.lit(1)))


def slice_of(value: str) -> Column:
    """Slice that a row belongs to."""
    return F.pmod(F.hash(value), F.col("slices"))


def every_slice() -> Column:
    """One row per slice, for the side that must meet all slices."""
    return F.explode(F.sequence(F.lit(0), F.col("slices") - 1))
