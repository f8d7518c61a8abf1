"""Toxicity classifier regularised by counterfactual sentences.

The score of a text is a logistic function of the features it has. The model is fitted to labelled
texts by gradient steps on three terms: the log loss; an absolute penalty that leaves most words
without weight; and, for each labelled text with an identity term, the squared change of the raw
score when its identity terms are swapped for others. The last term pulls the weights of group names
together, so a neutral mention of a group is not a reason to reject. A text without an identity term
contributes a neutral mention: itself with one term added, which must not change the score either.

Features are the words of a text, runs of letters, lower-cased, and the families of words that begin
alike: for beginnings of three to eight letters, whether one, two or three longer words have it, which
finds stems with endings. Identity terms count as words only. The vocabulary is the features of most
mutual information with the label among the training texts, up to ``VOCABULARY``, seen in
``LEAST_TEXTS`` texts at least; the counts are made by Spark. Training takes all labelled rows up to ``MOST_TRAINED``; of more, those with
the lowest hash of the document id, which is a bound on what the driver holds and nothing else.

Null and empty texts have no words and the score of the intercept. A training set with one label only
gives that label's smoothed share as every score; without labels all scores are 0. Of repeated labels
of a document the highest counts. Language, source, id and labels are no inputs of a score.
"""

from __future__ import annotations

import re
from collections import Counter
from collections.abc import Iterator
from dataclasses import dataclass

import numpy as np
import pandas as pd
import pyarrow as pa
from pyspark.sql import DataFrame
from pyspark.sql import functions as F

from retailflow.llm.common import map_rows, stored, text_parts

MOST_TRAINED = 12_000
VOCABULARY = 1_024
LEAST_TEXTS = 5
CHOOSING_STEPS, FITTING_STEPS = 300, 1_500
ABSOLUTE, SQUARE, COUNTERFACTUAL = 4e-3, 1e-5, 1.0
HELD_OUT = 5
SHORTEST, LONGEST, MOST_ALIKE = 3, 8, 3  # lengths of beginnings, and words counted

# Names of groups, which are swapped for each other within a row.
IDENTITY_TERMS = (
    ("women", "men", "girls", "boys"),
    ("woman", "man", "girl", "boy"),
    ("muslim", "christian", "jewish", "hindu", "buddhist", "atheist"),
    ("muslims", "christians", "jews", "hindus", "buddhists", "atheists"),
    ("black", "white", "asian", "latino"),
    ("gay", "straight", "lesbian", "bisexual", "transgender"),
    ("immigrant", "native", "refugee", "foreigner"),
    ("immigrants", "natives", "refugees", "foreigners"),
    ("old", "young", "elderly"),
    ("deaf", "blind", "disabled", "able"),
    ("african", "european", "american", "mexican", "chinese", "indian"),
)
SWAPS = {term: tuple(x for x in row if x != term) for row in IDENTITY_TERMS for term in row}

_WORD = re.compile(r"[^\W\d_]+")


def features_of(text: str) -> set[str]:
    """Words, and ``beginning*n`` where at least n longer words share the beginning."""
    words = set(_WORD.findall(text.lower()))
    families = Counter(w[:k] for w in words if w not in SWAPS for k in range(SHORTEST, min(len(w), LONGEST + 1)))
    return words.union(f"{start}*{n}" for start, seen in families.items() for n in range(1, min(seen, MOST_ALIKE) + 1))


@dataclass(frozen=True)
class ToxicityModel:
    intercept: float
    weights: dict[str, float]

    def raw(self, text: str) -> float:
        weights = self.weights
        return self.intercept + sum(weights[w] for w in sorted(features_of(text) & weights.keys()))

    def score(self, text: str) -> float:
        return float(1 / (1 + np.exp(-np.clip(self.raw(text), -30, 30))))


def swapped(words: set[str], turn: int) -> set[str]:
    """The words with each identity term replaced by another of its row."""
    return {SWAPS[w][turn % len(SWAPS[w])] if w in SWAPS else w for w in words}


class _Sparse:
    """A table of zeros and ones, by row and column numbers."""

    def __init__(self, sets: list[set[str]], names: list[str]):
        number = {name: k for k, name in enumerate(names)}
        cells = [(k, number[w]) for k, words in enumerate(sets) for w in sorted(words) if w in number]
        self.rows, self.columns = (np.array(x, np.int64) for x in (zip(*cells, strict=True) if cells else ((), ())))
        self.shape = (len(sets), len(names))

    def times(self, w: np.ndarray) -> np.ndarray:
        return np.bincount(self.rows, w[self.columns], minlength=self.shape[0])

    def back(self, v: np.ndarray) -> np.ndarray:
        return np.bincount(self.columns, v[self.rows], minlength=self.shape[1])


def _descend(sets, changed, names, y, weight, absolute, square, steps) -> tuple[np.ndarray, float]:
    """Weights and intercept by accelerated proximal steps.

    The loss of each text counts ``weight``; ``changed`` are the counterfactual texts.
    """
    own, other, n = _Sparse(sets, names), _Sparse(changed, names), len(sets)
    pulled = 2 * COUNTERFACTUAL / n

    def slopes(w, bias, outer):
        """Gradient where ``outer`` gives the slope of the loss in the raw score."""
        slope, pull = weight * outer(own.times(w) + bias), pulled * (own.times(w) - other.times(w))
        return own.back(slope + pull) - other.back(pull) + square * w, slope.sum()

    # The largest curvature, by power iteration, bounds the step.
    w, bias, curvature = np.ones(len(names)), 1.0, 1.0
    for _ in range(30):
        curvature = np.sqrt(w @ w + bias * bias)
        w, bias = slopes(w / curvature, bias / curvature, lambda raw: raw / 4)
    step = 1 / (1.1 * max(1e-6, np.sqrt(w @ w + bias * bias)))
    w, bias, speed = np.zeros(len(names)), 0.0, 1.0
    ahead, ahead_bias = w, bias
    for _ in range(steps):
        gradient, gradient_bias = slopes(ahead, ahead_bias, lambda raw: 1 / (1 + np.exp(-np.clip(raw, -30, 30))) - y)
        moved = ahead - step * gradient
        new, new_bias = np.sign(moved) * np.maximum(np.abs(moved) - step * absolute, 0.0), ahead_bias - step * gradient_bias
        faster = (1 + np.sqrt(1 + 4 * speed * speed)) / 2
        ahead = new + (speed - 1) / faster * (new - w)
        ahead_bias = new_bias + (speed - 1) / faster * (new_bias - bias)
        w, bias, speed = new, new_bias, faster
    return w, bias


def fit(sets: list[set[str]], labels: list[int], vocabulary: list[str]) -> ToxicityModel:
    """The model of feature sets and their labels.

    The absolute penalty chooses features, with both labels weighing the same; the chosen ones are then
    fitted anew without it, each text weighing the same, so that scores are shares.
    """
    n = len(sets)
    if not n:
        return ToxicityModel(-30.0, {})
    y = np.array(labels, float)
    if not 0 < y.sum() < n:
        return ToxicityModel(float(np.log((y.sum() + 0.5) / (n - y.sum() + 0.5))), {})
    terms = sorted(SWAPS)
    changed = [swapped(s, k) if s & SWAPS.keys() else s | {terms[k % len(terms)]} for k, s in enumerate(sets)]
    names = [*vocabulary, *sorted(SWAPS.keys() - set(vocabulary))]
    weight = np.where(y == 1, 0.5 / y.sum(), 0.5 / (n - y.sum()))
    w, _ = _descend(sets, changed, names, y, weight, ABSOLUTE, 0.0, CHOOSING_STEPS)
    # A group stays together, chosen or not.
    names = [name for name, v in zip(names, w, strict=True) if v or name in SWAPS]
    w, bias = _descend(sets, changed, names, y, np.full(n, 1 / n), 0.0, SQUARE, FITTING_STEPS)
    return ToxicityModel(float(bias), dict(zip(names, map(float, w), strict=True)))


def held_out(doc_id):
    """Whether a document takes no part in training."""
    return F.coalesce(F.pmod(F.crc32(doc_id.cast("string").cast("binary")), F.lit(HELD_OUT)) == 0, F.lit(False))


def training_rows(docs: DataFrame, labels: DataFrame, most: int = MOST_TRAINED) -> DataFrame:
    """[words, label] of the labelled documents outside the held-out fold, at most about ``most``.

    The labels chosen are a bounded table and are broadcast, so only texts of these documents are shuffled.
    An id that repeats gives one text, the one of smallest hash, so it weighs no more than others and the
    rows are no more than the labels.
    """
    known = labels.where(F.col("toxic").isNotNull() & F.col("doc_id").isNotNull() & ~held_out(F.col("doc_id")))
    known = known.groupBy("doc_id").agg(F.max((F.col("toxic") > 0).cast("int")).alias("label"))
    known = stored(known.withColumn("place", F.pmod(F.xxhash64("doc_id"), F.lit(1 << 30))), "labels")
    share = min(1.0, most / max(1, known.count()))
    chosen = F.broadcast(known.where(F.col("place") < int(share * (1 << 30))).select("doc_id", "label"))
    rows = docs.select("doc_id", "text").join(chosen, "doc_id").groupBy("doc_id").agg(
        F.min_by("text", F.xxhash64("text")).alias("text"), F.first("label").alias("label")
    )
    start = lambda: lambda texts: [(sorted(features_of(text)),) for text in texts]
    return map_rows(rows, "text", (("words", "array<string>"),), start, ["label"])


def vocabulary_of(rows: DataFrame, size: int = VOCABULARY) -> list[str]:
    """Words that tell most about the label."""
    total = rows.agg(F.count(F.lit(1)).alias("n"), F.sum("label").alias("yes")).first()
    n, yes = float(total["n"]), float(total["yes"] or 0)
    counts = rows.select("label", F.explode("words").alias("word")).groupBy("word")
    counts = counts.agg(F.sum("label").alias("a"), F.count(F.lit(1)).alias("seen")).where(F.col("seen") >= LEAST_TEXTS)
    if not 0 < yes < n:
        return []

    def part(cell, row, column):
        return F.when(cell > 0, cell / n * F.log(cell * n / (row * column))).otherwise(0.0)

    a, seen = F.col("a"), F.col("seen")
    gain = part(a, seen, F.lit(yes)) + part(seen - a, seen, F.lit(n - yes))
    gain = gain + part(yes - a, n - seen, F.lit(yes)) + part(n - yes - seen + a, n - seen, F.lit(n - yes))
    # Of beginnings that occur in the same texts, as far as counts tell, the longest speaks for all.
    longest = F.max_by("word", F.struct(~F.col("word").contains("*"), F.length("word"), "word")).alias("word")
    counts = counts.groupBy("a", "seen", F.substring("word", 1, SHORTEST)).agg(longest)
    best = counts.orderBy(F.round(gain, 12).desc(), "word").limit(size)
    return [row["word"] for row in best.select("word").collect()]


def train(docs: DataFrame, labels: DataFrame, most: int = MOST_TRAINED) -> ToxicityModel:
    rows = stored(training_rows(docs, labels, most), "training")
    vocabulary = vocabulary_of(rows)
    wanted = F.array(*map(F.lit, [*vocabulary, *SWAPS])) if vocabulary else F.array(*map(F.lit, SWAPS))
    kept = rows.select("label", F.array_intersect("words", wanted).alias("words")).toPandas()
    # Order decides which term is swapped in, so it must not depend on the order of tasks.
    order = sorted(range(len(kept)), key=lambda k: (kept["label"][k], list(kept["words"][k])))
    return fit([set(kept["words"][k]) for k in order], [int(kept["label"][k]) for k in order], vocabulary)


def score_documents(docs: DataFrame, model: ToxicityModel) -> DataFrame:
    """[doc_id, held_out, score, predicted] of every row."""
    start = lambda: lambda texts: [(model.score(text),) for text in texts]
    scored = map_rows(docs.select("doc_id", "text"), "text", (("score", "double"),), start, ["doc_id"])
    return scored.select(
        "doc_id", held_out(F.col("doc_id")).alias("held_out"), "score", (F.col("score") >= 0.5).cast("int").alias("predicted")
    )


def without_toxic(docs: DataFrame, model: ToxicityModel) -> DataFrame:
    """The documents with a score below one half, unchanged."""

    def run(batches: Iterator[pa.RecordBatch]) -> Iterator[pa.RecordBatch]:
        for part, texts in text_parts(batches, "text"):
            yield part.filter(pa.array([model.score(text or "") < 0.5 for text in texts], pa.bool_()))

    return docs.mapInArrow(run, docs.schema)


def held_out_quality(docs: DataFrame, labels: DataFrame, model: ToxicityModel) -> pd.DataFrame:
    """Counts by label and prediction over the held-out labelled documents."""
    scored = score_documents(docs, model).where("held_out")
    known = labels.where(F.col("toxic").isNotNull()).groupBy("doc_id").agg(F.max("toxic").alias("label"))
    return scored.join(known, "doc_id").groupBy("label", "predicted").count().toPandas()
