"""Quality rules with risk-controlled thresholds.

Every rule rejects documents whose measure lies above a cutoff. Cutoffs are chosen by stratum from
labelled documents so that, with confidence ``1 - DELTA`` for all strata and rules together, at most
``ALPHA`` of the good documents of a stratum are rejected. For one rule in one stratum the cutoffs of
a fixed grid are tested from the loosest to the strictest: a cutoff holds if the exact binomial bound
on its rate of false rejections, given how many good holdout documents it rejects, does not exceed the
rule's share of ``ALPHA``; testing ends at the first cutoff that fails, so the grid itself needs no
correction. The shares of ``ALPHA`` and ``DELTA`` are equal for all rules (and strata, for ``DELTA``),
which corrects for testing many. Of the cutoffs that hold, a rule takes the one with the most gain,
the share of bad documents it rejects less ``PRICE`` times the share of good ones, and the loosest of
equals; a rule for which none holds or none gains is not used there.

Strata are languages. A stratum without enough labelled documents gets no cutoffs and
loses no document to them. Labels count once a document; of repeated labels the lowest counts. Null
texts and texts without words have measures 0, and fail the base rule. Null languages are a stratum.
Measures are taken of whole texts; repeated rows each get their row.
"""

from __future__ import annotations

import math
import re
from collections import Counter

from pyspark.sql import Column, DataFrame, Window
from pyspark.sql import functions as F

from retailflow.llm.common import broadcast_up_to, map_rows, stored

ALPHA, DELTA = 0.02, 0.05
GRID = 100  # cutoffs are k / GRID
PRICE = 10
REPEATED = 5  # words in a window

# Measures, each from 0 to 1 and worse above.
RULES = {
    "symbols": ("n_symbols", "word_chars"),
    "dup_lines": ("n_dup_lines", "n_lines"),
    "repeats": ("n_repeat_words", "n_words"),
    "short_words": ("n_short_words", "n_words"),
}

_SYMBOLS = re.compile(r"[#*$%&|<>]")
#: Cutoffs above this number of rows are joined by shuffle.
FEW_CUTOFFS = 10_000


def repeated_words(words: list[bytes], width: int = REPEATED) -> int:
    """Words inside windows of ``width`` words that the text has twice or more."""
    windows = list(zip(*(words[k:] for k in range(width))))
    seen = Counter(windows)
    if len(seen) == len(windows):
        return 0
    total = reached = 0
    for at, window in enumerate(windows):
        if seen[window] > 1:
            total += at + width - max(at, reached)
            reached = at + width
    return total


def measures(text: str) -> tuple[int, ...]:
    """n_words, word_chars, n_symbols, n_dup_lines, n_repeat_words, n_lines, n_short_words of a text."""
    # Bytes split at the six ASCII blanks only. Code points are bytes that do not continue one.
    words = text.encode().split()
    joined = b"".join(words)
    chars = len(joined.decode())
    lines = [line for line in text.split("\n") if line.encode().split()]
    short = sum(len(w) == 1 for w in words)
    return (
        len(words),
        chars,
        len(_SYMBOLS.findall(text)),
        len(lines) - len(set(lines)),
        repeated_words(words),
        len(lines),
        short,
    )


FIELDS = tuple(
    (name, "long")
    for name in ("n_words", "word_chars", "n_symbols", "n_dup_lines", "n_repeat_words", "n_lines", "n_short_words")
)


def measured(docs: DataFrame) -> DataFrame:
    """[doc_id, lang, ...FIELDS] of every row."""
    rows = docs.select("doc_id", F.col("lang").cast("string").alias("lang"), "text")
    return map_rows(rows, "text", FIELDS, lambda: lambda texts: list(map(measures, texts)), ["doc_id", "lang"])


def base_failed() -> Column:
    """The fixed base rule."""
    return (F.col("n_words") < 10) | (100 * F.col("n_repeat_words") > 20 * F.col("n_words"))


def with_strata(rows: DataFrame) -> DataFrame:
    """Rows with ``stratum`` and, for each rule, the grid step its measure reaches."""
    steps = {
        f"step_{rule}": F.least(F.ceil(F.col(part) * GRID / F.greatest(F.col(whole), F.lit(1))), F.lit(GRID)).cast("int")
        for rule, (part, whole) in RULES.items()
    }
    return rows.withColumns({"stratum": F.coalesce(F.concat(F.lit("="), F.col("lang")), F.lit("")), **steps})


def binomial_bound_holds(rejected: int, n: int, rate: float, delta: float) -> bool:
    """Whether ``rejected`` of n puts the exact upper bound of the rate, at confidence 1 - delta, at ``rate`` or less.

    The bound is the rate at which so few or fewer have a chance of delta.
    """
    if rejected >= n:
        return False
    if rejected >= rate * n:
        return False  # the bound lies above the observed share
    log_rate, log_rest = math.log(rate), math.log1p(-rate)
    chance = 0.0
    for k in range(rejected, -1, -1):
        log_choose = math.lgamma(n + 1) - math.lgamma(k + 1) - math.lgamma(n - k + 1)
        term = math.exp(log_choose + k * log_rate + (n - k) * log_rest)
        chance += term
        if chance > delta:
            return False
        if term < chance * 1e-16:
            break  # terms fall from here on
    return True


def most_rejected(n: int, rate: float, delta: float) -> int:
    """The largest number of rejections of n for which the bound holds, or -1."""
    low, high = -1, max(0, math.ceil(rate * n))
    while high - low > 1:
        middle = (low + high) // 2
        low, high = (middle, high) if binomial_bound_holds(middle, n, rate, delta) else (low, middle)
    return low


def cutoffs(rows: DataFrame, labels: DataFrame, alpha: float = ALPHA, delta: float = DELTA) -> DataFrame:
    """[stratum, cut_<rule>...]: documents whose step lies above the cut are rejected; null: rule not used.

    ``rows`` are strata rows. Labelled documents that the base rule keeps are counted by stratum, rule
    and step, so what is gathered is at most the grid for each stratum and rule.
    """
    known = labels.where(F.col("quality").isNotNull()).groupBy("doc_id").agg(F.min(F.col("quality").cast("int")).alias("good"))
    tested = stored(rows.where(~base_failed()), "tested").join(known, "doc_id")
    steps = F.explode(F.array(*[F.struct(F.lit(r).alias("rule"), F.col(f"step_{r}").alias("step")) for r in RULES])).alias("s")
    counts = tested.select("stratum", "good", steps).groupBy("stratum", "s.rule", "s.step").agg(
        F.sum(F.when(F.col("good") > 0, 1).otherwise(0)).alias("good"),
        F.sum(F.when(F.col("good") > 0, 0).otherwise(1)).alias("bad"),
    )
    counts = stored(counts, "counts")
    strata = max(1, counts.select("stratum").distinct().count())
    rate, error = alpha / len(RULES), delta / (len(RULES) * strata)

    @F.udf("long")
    def allowed(n):
        return most_rejected(n, rate, error)

    # A cut just below a step rejects that step and all above it.
    above = Window.partitionBy("stratum", "rule").orderBy(F.col("step").desc())
    whole = Window.partitionBy("stratum", "rule")
    summed = counts.withColumns(
        {
            "n": F.sum("good").over(whole),
            "n_bad": F.sum("bad").over(whole),
            "good_above": F.sum("good").over(above),
            "bad_above": F.sum("bad").over(above),
        }
    )
    sizes = stored(summed.select("n").distinct(), "sizes").withColumn("allowed", allowed("n"))
    held = summed.join(sizes, "n").where("good_above <= allowed AND step > 0")
    share = lambda part, all_: F.col(part) / F.greatest(F.col(all_), F.lit(1))
    gain = F.round(share("bad_above", "n_bad") - PRICE * share("good_above", "n"), 9)
    useful = held.withColumn("gain", gain).where("gain > 0")
    cut = useful.groupBy("stratum", "rule").agg((F.max(F.struct("gain", "step"))["step"] - 1).alias("cut"))
    return cut.groupBy("stratum").agg(*[F.max(F.when(F.col("rule") == r, F.col("cut"))).alias(f"cut_{r}") for r in RULES])


def judged(docs: DataFrame, labels: DataFrame, **risk) -> DataFrame:
    """[doc_id, lang, ...FIELDS, base_failed, kept] of every row."""
    rows = stored(with_strata(measured(docs)), "measured")
    cuts = broadcast_up_to(stored(cutoffs(rows, labels, **risk), "cutoffs"), FEW_CUTOFFS)
    rejected = F.lit(False)
    for rule in RULES:
        rejected = rejected | F.coalesce(F.col(f"step_{rule}") > F.col(f"cut_{rule}"), F.lit(False))
    out = rows.join(cuts, "stratum", "left").withColumn("base_failed", base_failed())
    return out.withColumn("kept", ~F.col("base_failed") & ~rejected).select(
        "doc_id", "lang", *[name for name, _ in FIELDS], "base_failed", "kept"
    )
