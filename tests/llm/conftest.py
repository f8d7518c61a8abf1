"""Awkward documents that every operator and stage must take."""

from __future__ import annotations

import pytest

SCHEMA = (
    "doc_id long, text string, lang string, source string, n_chars long, "
    "size long, fp string, target string, ids string, score string, shard string, place string, root string, words string"
)


def _row(doc_id, text, lang="en", source="a"):
    return (doc_id, text, lang, source, len(text or ""), 9, "x", "y", "z", "s", "t", "u", "v", "w")


PROSE = (
    "the quick brown fox jumps over the lazy dog while seven wizards brew a strong potion of ginger and mint "
    "near an old stone bridge where travellers rest before crossing into the valley of the sleeping giants"
)


@pytest.fixture(scope="session")
def odd_rows():
    rows = [
        _row(1, PROSE),
        _row(2, PROSE),  # exact copy
        _row(3, PROSE.replace("ginger", "pepper")),
        _row(4, None),
        _row(5, ""),
        _row(6, " \t\n\x0b\x0c\r "),
        _row(7, "word " * 20_000),
        _row(8, "x" * 50_000),
        _row(9, "naïve café 𝒳𝒴 \u2028 end", None, None),
        _row(10, 'token = "f3ef4d6b2755a36d7d9c25bd72c4d5f67e061fda" mail a@b.co +1 (017) 555-7713', "fr", "b"),
        _row(11, "You stupid idiot worthless clown", "en", ""),
        _row(None, "a row without an id", "en", None),
        _row(None, None, None, None),
        _row(12, "repeated row with a few words", "de", "c"),
        _row(12, "repeated row with a few words", "de", "c"),
        _row(-3, "line one\nline one\n\nline two # * $ % & | < >", "en", "a"),
    ]
    return rows


@pytest.fixture(scope="session")
def odd_docs(spark, odd_rows):
    return spark.createDataFrame(odd_rows, SCHEMA)


@pytest.fixture(scope="session")
def no_docs(spark):
    return spark.createDataFrame([], SCHEMA)


@pytest.fixture(scope="session")
def labels(spark):
    rows = [(1, 1, 0), (2, 1, 0), (11, 0, 1), (None, 1, 1), (5, None, None), (12, 0, 0), (12, 1, 0), (99, 1, 1)]
    return spark.createDataFrame(rows, "doc_id long, quality int, toxic int")


@pytest.fixture(scope="session")
def no_labels(spark):
    return spark.createDataFrame([], "doc_id long, quality int, toxic int")
