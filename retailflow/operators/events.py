"""Event preparation: typing, rejection, cleaning, quality, chronological split."""

from __future__ import annotations

from collections.abc import Sequence
from dataclasses import dataclass

from pyspark.sql import Column, DataFrame, Window
from pyspark.sql import functions as F
from pyspark.sql import types as T

from retailflow.functions.numeric import as_double, as_long
from retailflow.schemas import EVENT_TYPES, SILVER_COLUMNS
from retailflow.session import written


def event_timestamp(df: DataFrame, name: str = "event_time") -> Column:
    """Timestamp column as it is; whole numbers are epoch milliseconds."""
    kind = df.schema[name].dataType
    if isinstance(kind, T.TimestampType):
        return F.col(name)
    if isinstance(kind, T.TimestampNTZType):
        return F.col(name).cast("timestamp")
    return F.timestamp_millis(F.col(name).try_cast("bigint"))


def normalize_events(raw: DataFrame) -> DataFrame:
    """Typed traffic records plus ``reject_reason``, NULL for rows that meet the contract."""
    price = F.nullif(F.col("price").cast("string"), F.lit("")) if "price" in raw.columns else F.lit(None)
    typed = raw.select(
        as_long("timestamp").alias("event_time"),
        as_long("visitorid").alias("visitor_id"),
        F.col("event").cast("string").alias("event"),
        as_long("itemid").alias("item_id"),
        price.cast("string").alias("price_text"),
    ).withColumn("price", as_double("price_text"))
    reason = (
        F.when(F.col("event").isNull() | ~F.col("event").isin(*EVENT_TYPES), "unknown_event")
        .when(F.col("event_time").isNull(), "bad_timestamp")
        .when(F.col("visitor_id").isNull(), "bad_visitor")
        .when(F.col("item_id").isNull(), "bad_item")
        .when(F.col("price_text").isNotNull() & F.col("price").isNull(), "bad_price")
    )
    return typed.withColumn("reject_reason", reason).drop("price_text")


def accepted(normalized: DataFrame) -> DataFrame:
    return normalized.where(F.col("reject_reason").isNull()).drop("reject_reason")


def reject_counts(normalized: DataFrame) -> DataFrame:
    """Rows per outcome; 'ok' stands for accepted rows."""
    return normalized.groupBy(F.coalesce("reject_reason", F.lit("ok")).alias("outcome")).agg(
        F.count(F.lit(1)).alias("n_rows")
    )


def clean_events(bronze: DataFrame) -> DataFrame:
    """Silver events: known event types, positive item ids, a valid time, no exact duplicates."""
    price = F.col("price").try_cast("double") if "price" in bronze.columns else F.lit(None).cast("double")
    silver = bronze.select(
        event_timestamp(bronze).alias("event_time"),
        "visitor_id",
        "event",
        "item_id",
        price.alias("price"),
    )
    return silver.where(
        F.col("event").isin(*EVENT_TYPES) & (F.col("item_id") > 0) & F.col("event_time").isNotNull()
    ).dropDuplicates(list(SILVER_COLUMNS))


_QUALITY_RULES = (
    # check name, condition that marks a violation (NULLs only count in the first rule)
    ("event_time_not_null", "event_time IS NULL"),
    ("item_id_at_least_1", "item_id < 1"),
    ("event_in_set", "event NOT IN ({})".format(", ".join(f"'{e}'" for e in EVENT_TYPES))),
)


def silver_violations(events: DataFrame) -> DataFrame:
    """[check, violations] for all rules in one pass."""
    counted = events.agg(*[F.count_if(F.expr(rule)).alias(name) for name, rule in _QUALITY_RULES])
    return counted.unpivot([], [name for name, _ in _QUALITY_RULES], "check", "violations")


def validate_silver(events: DataFrame) -> bool:
    """Raise on the first broken rule."""
    for row in silver_violations(events).collect():
        if row["violations"]:
            raise ValueError(f"silver check {row['check']} failed for {row['violations']} rows")
    return True


def first_events(events: DataFrame, n: int) -> DataFrame:
    """The earliest n events of a feed."""
    return events.orderBy("event_time", "event_id").limit(n)


@dataclass(frozen=True)
class CampaignWindow:
    start: str
    end: str
    multiplier: float


def campaign_multiplier(ts: Column, windows: Sequence[CampaignWindow]) -> Column:
    """Multiplier of the first listed window that holds the time, both ends included, else 1.

    The windows are a short configured list, so the lookup is one CASE expression without a join.
    """
    choice = None
    for w in windows:
        inside = ts.between(F.lit(w.start).cast("timestamp"), F.lit(w.end).cast("timestamp"))
        choice = F.when(inside, w.multiplier) if choice is None else choice.when(inside, w.multiplier)
    return F.lit(1.0) if choice is None else choice.otherwise(F.lit(1.0))


#: Length of the bins that meet times and windows: a day.
CAMPAIGN_BIN_SECONDS = 24 * 60 * 60
#: Bins that are broadcast, and stretches of all lists that are.
FEW_BINS = 100_000
#: Stretches that a list holds on average at most, where they are spread evenly over the bin.
LISTED = 32


def with_campaigns(
    events: DataFrame, windows: DataFrame, moment: Column, bin_seconds: int = CAMPAIGN_BIN_SECONDS
) -> DataFrame:
    """Adds ``multiplier``: that of the first window, by ``ordinal``, that holds the moment, both ends included, else 1.

    ``windows`` [ordinal, start, end, multiplier] is a table of any size. In each bin of time the windows are resolved
    to stretches without overlap (``first_windows``), at most one more than the ends of windows in the bin. A bin is cut
    into cells by their number, each cell lists its stretches in order, and an event meets the list of its cell: two
    equi-joins that never multiply events, and a search by halves. Windows that end before they start, or lack an end,
    hold nothing; events without a moment get 1. A window reaches each bin that it meets.
    """
    width = bin_seconds * 1_000_000
    bin_of = lambda micros: F.floor(micros / F.lit(width))
    cell_of = lambda micros: F.floor((micros - F.col("_bin") * width) / F.col("_wide"))
    stretches = written(first_windows(windows, width), "stretches")
    cells = written(
        stretches.groupBy("_bin").agg(F.ceil(F.lit(width) / F.ceil(F.count(F.lit(1)) / LISTED)).alias("_wide")), "cells"
    )
    cells = F.broadcast(cells) if cells.count() <= FEW_BINS else cells
    each = stretches.join(cells, "_bin").withColumn(
        "_cell", F.explode(F.sequence(cell_of(F.col("since")), cell_of(F.col("until") - 1)))
    )
    listed = F.sort_array(F.collect_list(F.struct("since", "until", "multiplier"))).alias("_listed")
    lists = written(each.groupBy("_bin", "_cell").agg(listed), "lists")
    if stretches.count() <= FEW_BINS and lists.count() <= FEW_BINS:
        lists = F.broadcast(lists)
    placed = events.withColumn("_moment", F.unix_micros(moment)).withColumn("_bin", bin_of(F.col("_moment")))
    joined = placed.join(cells, "_bin", "left").withColumn("_cell", cell_of(F.col("_moment"))).join(lists, ["_bin", "_cell"], "left")
    # How many stretches of the list begin at or before the moment: falling powers of two are added while that holds.
    before = F.expr(
        """aggregate(transform(sequence(length(bin(size(_listed))) - 1, 0, -1), k -> shiftleft(1, k)), 0, (n, p) ->
        if(n + p <= size(_listed) AND element_at(_listed, least(n + p, size(_listed))).since <= _moment, n + p, n))"""
    )
    found = joined.withColumn("_before", F.when(F.col("_listed").isNotNull(), before))
    last = F.when(F.col("_before") > 0, F.try_element_at("_listed", "_before"))
    first = F.when(F.col("_moment") < last["until"], last["multiplier"])
    return found.withColumn("multiplier", F.coalesce(first, F.lit(1.0))).select(*events.columns, "multiplier")


def first_windows(windows: DataFrame, width: int) -> DataFrame:
    """[_bin, since, until, multiplier]: stretches of time, in microseconds, with the first window that holds all of each.

    The ends of windows in a bin are numbered in order. A window of many stretches is two overlapping runs of a power
    of two of them; runs are resolved from the longest down, each handed to its two halves, so the work is the number
    of ends times the logarithm of it, however many windows overlap.
    """
    edge = lambda k: (F.col("_bin") + k) * width
    since, until = F.unix_micros("start"), F.unix_micros("end") + 1
    reached = F.sequence(F.floor(since / F.lit(width)), F.floor((until - 1) / F.lit(width)))
    pieces = (
        windows.where(F.col("start") <= F.col("end"))
        .select(F.struct("ordinal", "start", "end", "multiplier").alias("window"), since.alias("s"), until.alias("u"), F.explode(reached).alias("_bin"))
        .groupBy("_bin", F.greatest("s", edge(0)).alias("since"), F.least("u", edge(1)).alias("until"))
        .agg(F.min("window").alias("window"))
    )
    pieces = written(pieces, "pieces")
    ends = pieces.select("_bin", F.explode(F.array("since", "until")).alias("since")).distinct()
    in_order = Window.partitionBy("_bin").orderBy("since")
    ends = written(ends.select("*", F.row_number().over(in_order).alias("at"), F.lead("since").over(in_order).alias("until")), "ends")
    opens = ends.select("_bin", "since", F.col("at").alias("i"))
    closes = ends.select("_bin", F.col("since").alias("until"), F.col("at").alias("j"))
    ranged = pieces.join(opens, ["_bin", "since"]).join(closes, ["_bin", "until"])
    ranged = ranged.withColumn("level", F.length(F.bin(F.col("j") - F.col("i"))) - 1)
    starts = F.array_distinct(F.array(F.col("i"), F.expr("j - shiftleft(1, level)")))
    runs = written(ranged.select("_bin", "level", F.explode(starts).alias("at"), "window"), "runs")
    halves = None
    for level in range(runs.agg(F.coalesce(F.max("level"), F.lit(0))).first()[0], -1, -1):
        here = runs.where(F.col("level") == level).select("_bin", "at", "window")
        here = here if halves is None else here.unionAll(halves)
        here = here.groupBy("_bin", "at").agg(F.min("window").alias("window"))
        both = F.explode(F.array(F.col("at"), F.col("at") + (1 << level >> 1)))
        halves = here.select("_bin", both.alias("at"), "window") if level else here
    return ends.join(halves, ["_bin", "at"]).select("_bin", "since", "until", F.col("window.multiplier").alias("multiplier"))


# ---------------------------------------------------------------- chronological split

_RADIX_BUCKETS = 1 << 16


def kth_smallest(rows: DataFrame, column: str, k: int) -> tuple[int, int] | None:
    """(value, rank inside that value) of the k-th smallest whole number, k counted from 1.

    Each pass counts at most 65,536 equal ranges of the current interval, so what is aggregated and
    what reaches the driver is bounded whatever the row count; the next pass reads one range only.
    """
    bounds = rows.agg(F.min(column), F.max(column)).first()
    lo, hi = bounds[0], bounds[1]
    if lo is None or k < 1:
        return None
    while True:
        width = (hi - lo) // _RADIX_BUCKETS + 1
        if width > 1:
            bucket = F.expr(f"(`{column}` - {lo}L) div {width}L")
        else:
            bucket = F.col(column) - F.lit(lo)
        counts = (
            rows.where(F.col(column).between(lo, hi))
            .groupBy(bucket.alias("bucket"))
            .agg(F.count(F.lit(1)).alias("n"))
        )
        for found in counts.orderBy("bucket").collect():
            if k <= found["n"]:
                break
            k -= found["n"]
        lo = lo + found["bucket"] * width
        hi = min(hi, lo + width - 1)
        if width == 1:
            return lo, k


def chrono_cut(events: DataFrame, train_fraction: float, order: str, tie: str) -> Column:
    """Predicate that marks the earliest floor(n * fraction) rows by (order, tie).

    Rows without an order or tie value come last: they count, and are not among the earliest.
    """
    known = events.where(F.col(order).isNotNull() & F.col(tie).isNotNull())
    totals = events.agg(
        F.count(F.lit(1)).alias("n"), F.count_if(F.col(order).isNotNull() & F.col(tie).isNotNull()).alias("known")
    ).first()
    take = int(totals["n"] * train_fraction)
    complete = F.col(order).isNotNull() & F.col(tie).isNotNull()
    if take >= totals["known"]:
        return complete
    at = kth_smallest(known, order, take)
    if at is None:
        return F.lit(False)
    cut, rank = at
    tied = known.where(F.col(order) == cut)
    last = kth_smallest(tied, tie, rank)[0]
    early = (F.col(order) < cut) | ((F.col(order) == cut) & (F.col(tie) <= last))
    return complete & F.coalesce(early, F.lit(False))


def chrono_split(
    events: DataFrame, train_fraction: float = 0.8, order: str = "timestamp", tie: str = "event_id"
) -> tuple[DataFrame, DataFrame]:
    """(train, test) by time without sorting or moving the data: two filters on a cut point."""
    in_train = chrono_cut(events, train_fraction, order, tie)
    return events.where(in_train), events.where(~in_train)  # the predicate is never null
