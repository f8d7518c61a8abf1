"""Ranked search against a plain scan of all documents for each item."""

from __future__ import annotations

import math
import random
import re
from collections import Counter

import pytest

from retailflow.llm import ranking

TERM = re.compile("[^\x00-\x2f\x3a-\x40\x5b-\x60\x7b-\x7f]+")


def plain_terms(text):
    return TERM.findall(re.sub("[A-Z]", lambda m: m[0].lower(), text or ""))


def brute(docs, items):
    """[(item number, rank, doc_id, score)] by the formula, document by document."""
    bags = [(doc_id, Counter(plain_terms(text))) for doc_id, text in docs]
    n_docs = sum(bool(b) for _, b in bags)
    words = sum(b.total() for _, b in bags)
    df = Counter(t for _, b in bags for t in b)
    out = []
    for number, (_, text) in enumerate(items):
        scored = []
        for place, (doc_id, bag) in enumerate(bags):
            score = 0
            for t, q in Counter(plain_terms(text)).items():
                if tf := bag[t]:
                    w = math.floor(1000 * math.log((2 * n_docs + 2) / (2 * df[t] + 1)))
                    m = 100 - 75 + (75 * bag.total() * n_docs) // words
                    score += q * w * ((1_000_000_000 * tf) // (1000 * tf + 8 * m))
            if score > 0:
                scored.append((-score, doc_id is None, doc_id or 0, place, doc_id))
        for rank, (score, *_, doc_id) in enumerate(sorted(scored)[:10], 1):
            out.append((number, rank, doc_id, -score))
    return out


def test_terms():
    for text in ("", "One two-THREE four's 5", "naïve CAFÉ ÀÉ ß İ 𝒳 \x85\xa0x y", "a_b`c{d}~\x7f\x1ce"):
        assert [t.decode() for t in ranking.terms_of(text)] == plain_terms(text)


@pytest.mark.parametrize("small", [False, True])
def test_best_documents_of_all(spark, monkeypatch, small):
    if small:
        for name, value in (("SLICE", 7), ("BUNDLE", 3), ("MOST_TERMS", 60)):
            monkeypatch.setattr(ranking, name, value)
    r = random.Random(3)
    vocabulary = [f"t{k}" for k in range(400)]
    words = lambda n: " ".join(vocabulary[int(r.paretovariate(0.6)) % 400] for _ in range(n))
    docs = [(k, words(r.choice((1, 5, 30, 200)))) for k in range(300)]
    docs += [(k + 1_000, docs[k][1]) for k in range(40)]  # equal scores
    docs += [(2_000, None), (2_001, ""), (2_002, "- / -"), (2_003, "of " * 5_000)]
    items = [(k, words(r.choice((1, 3, 20, 60)))) for k in range(20)]
    items += [(20, docs[5][1]), (21, "unknown words only"), (22, ""), (23, None), (24, "of OF t1 T1")]
    found = ranking.ranked(
        spark.createDataFrame(docs, "doc_id long, text string"), spark.createDataFrame(items, "item_id long, text string")
    ).collect()
    assert sorted(tuple(x) for x in found) == brute(docs, items)


def test_accumulators_that_cannot_win_are_dropped(spark, monkeypatch, tmp_path):
    """Later stages carry fewer documents than hold a term."""
    r = random.Random(5)
    docs = [(k, " ".join(["common"] * r.randrange(1, 4) + [f"w{r.randrange(300)}" for _ in range(20)])) for k in range(600)]
    docs += [(1_000 + k, "rare find " + docs[k][1]) for k in range(12)]
    items = [(1, "rare find common w1 w2"), (2, "rare find common common")]
    carried = {}
    plain = ranking.stored

    def watched(df, name):
        out = plain(df, name)
        if name.startswith("carried"):
            carried[name] = out.selectExpr("sum(size(rows))").first()[0]
        return out

    monkeypatch.setattr(ranking, "stored", watched)
    found = ranking.ranked(
        spark.createDataFrame(docs, "doc_id long, text string"), spark.createDataFrame(items, "item_id long, text string")
    )
    want = brute(docs, items)
    assert sorted(tuple(x) for x in found.collect()) == [(n + 1, *rest) for n, *rest in want]
    assert max(v or 0 for v in carried.values()) < 300


def test_odd_rows(spark, odd_docs, odd_rows, no_docs):
    docs = [(x[0], x[1]) for x in odd_rows]
    asked = [(1, "the lazy dog"), (1, "REPEATED row"), (None, "naïve word café"), (4, None), (5, " ")]
    items = spark.createDataFrame([(*x, "clash") for x in asked], "item_id long, text string, row string")
    found = sorted((tuple(x) for x in ranking.ranked(odd_docs, items).collect()), key=repr)
    want = sorted(((asked[n][0], *rest) for n, *rest in brute(docs, asked)), key=repr)
    assert found == want
    assert ranking.ranked(no_docs, items).count() == 0
    assert ranking.ranked(odd_docs, items.limit(0)).count() == 0
