"""Secret scan by character Markov models of random strings and of ordinary identifiers.

Three fixed rules find secrets with a telling form. Beyond them, every token of twelve characters or more
that stands alone is scored by two first-order character models, one of random strings and one of
ordinary identifiers; a token whose log-likelihood ratio, summed over its characters, exceeds the
bound is a secret of kind ``random``. Under the ordinary model a ratio of r is exceeded with a chance
of at most 1/r, so the bound log(1 / false share) holds at every length. The models are
trained from labelled samples: any table of (sample, is_secret) will do. ``samples_of`` labels a
corpus by the rules: what a rule found is a random string, and tokens around it are ordinary if they are made of
letters, of digits, or of letters and then digits, joined by signs: words, names, dates, paths. What
mixes letters and digits otherwise is neither. ``UNIFORM`` adds what strings drawn evenly from the usual
alphabets would count, so that secrets of a kind that no rule knows are not strange to the model.
Transitions are counted over all documents; the counts are bounded by the square of the alphabet, so
only they reach the driver.

Null and empty texts have no spans. Long texts are scanned whole. A table without samples of one
class trains a flat model of it. Spans are code points with the end exclusive; spans of the method
never overlap those of the rules.
"""

from __future__ import annotations

import re
from collections.abc import Iterator
from dataclasses import dataclass
from itertools import chain

import numpy as np
import pyarrow as pa
from pyspark.sql import DataFrame
from pyspark.sql import functions as F

from retailflow.llm.common import map_rows, sha256_hex, text_parts

# Fixed patterns of the rules; values shorter than the number beside them are dropped.
ASSIGN = re.compile(
    r"""(?:password|passwd|secret|token|api_?key)["']?\x20*[:=]\x20*["']?([A-Za-z0-9+/_.=-]+)""", re.ASCII | re.IGNORECASE
)
ASSIGN_VALUE = 6
ACCESS = re.compile(r"AKIA[A-Z0-9]+")
ACCESS_LENGTH = 20
HEX = re.compile(r"[0-9a-f]{24,}")  # a run of 24 starts where the whole run does
KINDS = ("assign", "access", "hex", "random")

#: Tokens that the models judge: letters, digits and signs of encodings, with no other letter beside them.
TOKEN = re.compile(r"(?<![\w+/=-])[A-Za-z0-9+/_=-]{12,}(?![\w+/=-])")
#: Tokens that may stand for ordinary identifiers when a corpus labels itself, and what they are made of.
SAMPLE = re.compile(r"(?<![\w+/=-])[A-Za-z0-9+/_=-]{6,}(?![\w+/=-])")
_PART = r"(?:[A-Za-z]+[0-9]*|[0-9]+)"
ORDINARY = re.compile(rf"[-_/+=]*{_PART}(?:[-_/+=]+{_PART})*[-_/+=]*")

#: Alphabets of random strings, and how many characters, in strings of 32, each of them adds.
UNIFORM = (
    "0123456789abcdef",
    "0123456789ABCDEF",
    "ABCDEFGHIJKLMNOPQRSTUVWXYZ234567",
    "0123456789abcdefghijklmnopqrstuvwxyz",
    "0123456789abcdefghijklmnopqrstuvwxyzABCDEFGHIJKLMNOPQRSTUVWXYZ",
    "0123456789abcdefghijklmnopqrstuvwxyzABCDEFGHIJKLMNOPQRSTUVWXYZ-_",
)
UNIFORM_CHARACTERS, UNIFORM_LENGTH = 50_000, 32

#: How often ordinary identifiers go on in each class of characters, whatever the words: rows and columns
#: are digits, lower case, upper case, signs, edge. The share of it in the ordinary model keeps words that
#: the samples lack from looking random.
CHANGES = np.array(
    [
        [0.70, 0.04, 0.02, 0.12, 0.12],
        [0.03, 0.85, 0.02, 0.05, 0.05],
        [0.03, 0.45, 0.44, 0.04, 0.04],
        [0.12, 0.40, 0.18, 0.25, 0.05],
        [0.12, 0.55, 0.25, 0.08, 0.00],
    ]
)
CHANGES_SHARE = 0.3

# Symbols of the models: digits, letters by case, some signs; 64 stands for all else, 65 for the edge.
_SYMBOLS = "0123456789abcdefghijklmnopqrstuvwxyzABCDEFGHIJKLMNOPQRSTUVWXYZ_-"
EDGE = 65
SIZE = 66
_CODE = np.full(256, 64, np.uint8)
for _number, _symbol in enumerate(_SYMBOLS):
    _CODE[ord(_symbol)] = _number


def encoded(token: str) -> np.ndarray:
    """Symbol numbers of a token, between two edges."""
    inner = _CODE[np.frombuffer(token.encode("latin-1", "replace"), np.uint8)]
    return np.concatenate(([EDGE], inner, [EDGE])).astype(np.int64)


def transitions(samples: list[str]) -> np.ndarray:
    """Counts of symbol pairs, flat."""
    counts = np.zeros(SIZE * SIZE, np.int64)
    if samples:
        symbols = encoded("\n".join(samples))  # the line end is an edge as well
        text = np.frombuffer("\n".join(samples).encode("latin-1", "replace"), np.uint8)
        symbols[1:-1][text == 10] = EDGE
        counts += np.bincount(symbols[:-1] * SIZE + symbols[1:], minlength=SIZE * SIZE)
    return counts


@dataclass(frozen=True)
class RandomnessModel:
    """Log-likelihood ratio of random strings to identifiers, by symbol pair."""

    ratio: np.ndarray
    bound: float

    def score(self, token: str) -> float:
        """Log-likelihood ratio of the whole token."""
        symbols = encoded(token)
        return float(self.ratio[symbols[:-1] * SIZE + symbols[1:]].sum())


def uniform_counts() -> np.ndarray:
    """Expected transitions of the strings of ``UNIFORM``, flat."""
    counts = np.zeros((SIZE, SIZE))
    for alphabet in UNIFORM:
        own = _CODE[np.frombuffer(alphabet.encode(), np.uint8)]
        strings = UNIFORM_CHARACTERS / UNIFORM_LENGTH
        counts[np.ix_(own, own)] += strings * (UNIFORM_LENGTH - 1) / len(own) ** 2
        counts[EDGE, own] += strings / len(own)
        counts[own, EDGE] += strings / len(own)
    return counts.ravel()


def _probabilities(counts: np.ndarray, smoothing: float) -> np.ndarray:
    """Transitions backed off to symbol frequencies, those to equal chances."""
    square = counts.reshape(SIZE, SIZE).astype(float)
    single = square.sum(axis=0) + smoothing
    single /= single.sum()
    return (square + smoothing * single * SIZE) / (square.sum(axis=1, keepdims=True) + smoothing * SIZE)


def _changes() -> np.ndarray:
    """Transitions of ``CHANGES``, even inside a class."""
    kind = np.repeat([0, 1, 2, 3, 4], [10, 26, 26, 3, 1])
    return CHANGES[kind[:, None], kind[None, :]] / np.bincount(kind)[kind][None, :]


def train(counts: dict[bool, np.ndarray], smoothing: float = 0.5, false_share: float = 1e-6) -> RandomnessModel:
    """The model of transition counts of random (True) and ordinary (False) samples.

    The bound is such that an ordinary token passes with a chance of at most ``false_share`` under its model.
    """
    empty = np.zeros(SIZE * SIZE)
    random = _probabilities(counts.get(True, empty) + uniform_counts(), smoothing)
    ordinary = (1 - CHANGES_SHARE) * _probabilities(counts.get(False, empty), smoothing) + CHANGES_SHARE * _changes()
    ordinary[EDGE, EDGE] = random[EDGE, EDGE]  # no token is empty
    return RandomnessModel(np.log(random / ordinary).ravel(), -np.log(false_share))


def base_spans(text: str) -> list[tuple[int, int, int]]:
    """(start, number of the kind, end) of every match of the rules, ascending."""
    found = [(m.start(), 0, m.end()) for m in ASSIGN.finditer(text) if m.end() - m.start(1) >= ASSIGN_VALUE]
    found += [(m.start(), 1, m.end()) for m in ACCESS.finditer(text) if m.end() - m.start() >= ACCESS_LENGTH]
    found += [(m.start(), 2, m.end()) for m in HEX.finditer(text)]
    return sorted(found)


def random_spans(text: str, base: list[tuple[int, int, int]], model: RandomnessModel) -> list[tuple[int, int, int]]:
    """Spans that the models add, clear of ``base``; tokens and spans are walked together."""
    out, at, covered = [], 0, -1
    for m in TOKEN.finditer(text):
        start, end = m.span()
        while at < len(base) and base[at][0] < end:
            covered = max(covered, base[at][2])
            at += 1
        if covered <= start and model.score(m[0]) > model.bound:
            out.append((start, 3, end))
    return out


def spans_text(spans: list[tuple[int, int, int]]) -> str:
    return ",".join(f"{KINDS[kind]}:{start}:{end}" for start, kind, end in spans)


def samples_of(text: str) -> Iterator[tuple[str, bool]]:
    """Samples that a text gives when the rules label it."""
    base = base_spans(text)
    plain, at = [], 0
    for start, kind, end in base:
        value = text[start:end]
        if kind == 0:
            value = ASSIGN.match(value)[1]
        yield value, True
        plain.append(text[at:start])
        at = max(at, end)
    plain.append(text[at:])
    for token in SAMPLE.findall(" ".join(plain)):
        if ORDINARY.fullmatch(token):
            yield token, False


def corpus_counts(docs: DataFrame, text: str = "text") -> dict[bool, np.ndarray]:
    """Transition counts of both classes over all documents."""

    def run(batches: Iterator[pa.RecordBatch]) -> Iterator[pa.RecordBatch]:
        total = np.zeros((2, SIZE * SIZE), np.int64)
        for _, texts in text_parts(batches, text):
            samples: dict[bool, list[str]] = {True: [], False: []}
            for sample, secret in chain.from_iterable(samples_of(value or "") for value in texts):
                samples[secret].append(sample)
            for secret, found in samples.items():
                total[int(secret)] += transitions(found)
        secret, pair = np.nonzero(total)
        columns = [pa.array(secret == 1), pa.array(pair, pa.int32()), pa.array(total[secret, pair])]
        yield pa.RecordBatch.from_arrays(columns, ["secret", "pair", "n"])

    counted = docs.select(text).mapInArrow(run, "secret boolean, pair int, n long")
    return _gathered(counted.groupBy("secret", "pair").agg(F.sum("n").alias("n")))


def sample_counts(samples: DataFrame) -> dict[bool, np.ndarray]:
    """Transition counts of a labelled table [sample, is_secret]; rows with a null are passed over."""

    def run(batches: Iterator[pa.RecordBatch]) -> Iterator[pa.RecordBatch]:
        for batch in batches:
            for secret in (True, False):
                own = [s for s, y in zip(*(c.to_pylist() for c in batch.columns), strict=True) if y == secret]
                counts = transitions(own)
                (pair,) = np.nonzero(counts)
                columns = [pa.array([secret] * len(pair), pa.bool_()), pa.array(pair, pa.int32()), pa.array(counts[pair])]
                yield pa.RecordBatch.from_arrays(columns, ["secret", "pair", "n"])

    rows = samples.select("sample", F.col("is_secret").cast("boolean")).dropna()
    counted = rows.mapInArrow(run, "secret boolean, pair int, n long")
    return _gathered(counted.groupBy("secret", "pair").agg(F.sum("n").alias("n")))


def _gathered(counted: DataFrame) -> dict[bool, np.ndarray]:
    """At most two squares of the alphabet come to the driver."""
    out = {kind: np.zeros(SIZE * SIZE, np.int64) for kind in (True, False)}
    for row in counted.collect():
        out[row["secret"]][row["pair"]] = row["n"]
    return out


def all_spans(text: str, model: RandomnessModel) -> tuple[list, list]:
    base = base_spans(text)
    return base, sorted(base + random_spans(text, base, model))


def find_secrets(docs: DataFrame, model: RandomnessModel) -> DataFrame:
    """[doc_id, n_assign, n_access, n_hex, base_sha256, spans] of every row."""

    def row(text: str) -> tuple:
        base, every = all_spans(text, model)
        counts = [sum(kind == k for _, kind, _ in base) for k in range(3)]
        return *counts, sha256_hex(spans_text(base).encode()), spans_text(every)

    names = [(name, "long") for name in ("n_assign", "n_access", "n_hex")]
    fields = (*names, ("base_sha256", "string"), ("spans", "string"))
    return map_rows(docs.select("doc_id", "text"), "text", fields, lambda: lambda texts: list(map(row, texts)), ["doc_id"])


MASK = "[secret]"


def masked(text: str, model: RandomnessModel) -> str:
    """The text with each span, and spans that overlap together, replaced by one mask."""
    _, spans = all_spans(text, model)
    out, at = [], 0
    for start, _, end in spans:
        if start >= at:
            out += [text[at:start], MASK]
        at = max(at, end)
    return "".join(out) + text[at:] if out else text


def mask_secrets(docs: DataFrame, model: RandomnessModel) -> DataFrame:
    """The documents with secrets masked and ``n_chars`` counted anew; null texts stay null."""

    def run(batches: Iterator[pa.RecordBatch]) -> Iterator[pa.RecordBatch]:
        for part, texts in text_parts(batches, "text"):
            at = part.schema.get_field_index("text")
            clean = [None if x is None else masked(x, model) for x in texts]
            yield part.set_column(at, "text", pa.array(clean, part.schema.field(at).type))

    clean = docs.mapInArrow(run, docs.schema)
    return clean.withColumn("n_chars", F.length("text").cast("long")) if "n_chars" in docs.columns else clean
