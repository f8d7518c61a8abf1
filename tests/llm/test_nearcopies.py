"""Near copies with one to several changed words leave the corpus."""

from __future__ import annotations

import random

import corpus_pipeline
import numpy as np
import pytest
from pyspark.sql import functions as F

from retailflow.llm import golay, nearcopies, simhash


def brute_groups(texts):
    """Components of pairs of a shingle similarity of 0.8 or more, by comparing all."""
    sets = [set(nearcopies.shingle_set(t).tolist()) for t in texts]
    group = list(range(len(texts)))
    for i, a in enumerate(sets):
        for j, b in enumerate(sets[:i]):
            if (not a and not b) or len(a & b) >= 0.8 * len(a | b):
                old, new = group[i], group[j]
                group = [new if g == old else g for g in group]
    return group


def test_prints_are_majorities():
    r = np.random.default_rng(1)
    for n in (1, 2, 3, 4, 7, 64, 1001):
        hashes = r.integers(0, 1 << 63, n).astype(np.uint64)
        mixed = nearcopies._mixed(hashes, 0, 6)
        assert [simhash.majority_bits(c) for c in mixed.T] == nearcopies.prints(hashes, 6).tolist()


def test_layout_grows_with_the_logarithm_of_the_table():
    plans = [nearcopies.layout(10**k) for k in range(12)]
    assert plans[0].exact == 0 and all(0 <= b.exact - a.exact <= 4 for a, b in zip(plans, plans[1:]))
    for k, plan in enumerate(plans):
        bucket = nearcopies.KEYS * 10**k / 4096 / 2**plan.exact
        assert bucket <= nearcopies.OCCUPANCY
        assert 64 * (plan.prints - 1) >= plan.segments * (golay.LENGTH + plan.exact)


@pytest.mark.parametrize("texts", [1_000, 1_000_000])
def test_pairs_of_similarity_08_share_a_key(texts):
    """At the differing bits of similarity 0.8, in fingerprints of real sets, at least 0.95 of pairs meet."""
    r, plan = np.random.default_rng(3), nearcopies.layout(texts)
    met, differing = 0, []
    for _ in range(300):
        hashes = r.integers(0, 1 << 63, 450).astype(np.uint64)
        a, b = (nearcopies.prints(x, plan.prints) for x in (hashes[:405], hashes[45:]))  # 360 of 450 shared
        differing.append(np.bitwise_count(a ^ b).sum())
        row, key = nearcopies.segment_keys(np.stack([a, b])[:, :-1], plan)
        met += bool(set(key[row == 0].tolist()) & set(key[row == 1].tolist()))
    assert met >= 0.95 * 300
    assert max(differing) <= plan.most_bits
    assert abs(np.mean(differing) / (64 * plan.prints) - nearcopies.DIFFERING) < 0.01


def test_pairs_of_buckets(monkeypatch):
    monkeypatch.setattr(nearcopies, "DENSE", 1)
    monkeypatch.setattr(nearcopies, "FEW_PAIRS", 0)
    monkeypatch.setattr(nearcopies, "LEADS", 2)
    key = np.array([1, 1, 1, 2, 3, 3, 3, 3, 3])
    fp, n = np.zeros(9, np.uint64), np.full(9, 10)
    fp[1] = ~np.uint64(0)
    a, b, dense = nearcopies.bucket_pairs(key, fp, n)
    got = set(zip(a.tolist(), b.tolist(), strict=True))
    assert got == {(0, 2), (4, 5), (4, 6), (4, 7), (4, 8)} and dense.tolist() == [3]


def edited_texts():
    r = random.Random(4)
    word = lambda: f"w{r.randrange(10**6)}"
    texts = []
    for _ in range(60):
        base = [word() for _ in range(r.choice((60, 100, 300)))]
        texts.append(" ".join(base))
        for changes in (1, 2, 3, 6):
            copy = list(base)
            for place in r.sample(range(len(copy)), changes):
                copy[place] = word()
            texts.append(" ".join(copy))
    base = [word() for _ in range(120)]  # a large group
    texts += [" ".join([*base[:k], word(), *base[k + 1 :]]) for k in range(120) for _ in range(2)]
    return texts + ["", " ", "\n"]


@pytest.mark.parametrize("law", ["plain", "dense", "long"])
def test_copies_with_changed_words_go(spark, monkeypatch, law):
    if law == "dense":  # all buckets give links to their first rows at first
        for name, value in (("DENSE", 0), ("FEW_PAIRS", 0), ("LEADS", 2), ("PIECE", 50)):
            monkeypatch.setattr(nearcopies, name, value)
    if law == "long":  # buckets do not fit
        for name, value in (("HELD", 4), ("LEADS", 2)):
            monkeypatch.setattr(nearcopies, name, value)
    texts = edited_texts()
    docs = spark.createDataFrame(list(enumerate(texts)), "doc_id long, text string")
    found = {x["text_hash"]: x["group"] for x in nearcopies.near_copies(docs).collect()}
    hashes = {x["doc_id"]: x["h"] for x in docs.select("doc_id", F.xxhash64("text").alias("h")).collect()}
    got = [found.get(hashes[k], hashes[k]) for k in range(len(texts))]
    want = brute_groups(texts)
    pairs = [(i, j) for i in range(len(texts)) for j in range(i) if want[i] == want[j]]
    missed = sum(got[i] != got[j] for i, j in pairs)
    assert all(want[i] == want[j] for i in range(len(texts)) for j in range(i) if got[i] == got[j])
    assert missed <= 0.02 * len(pairs)


def test_repeated_rows_and_copies_leave_one(spark, odd_docs, odd_rows, no_docs, tmp_path):
    kept = corpus_pipeline.drop_near_copies(spark, odd_docs, str(tmp_path)).collect()
    rows = [(r[0], r[1] or "") for r in odd_rows]
    groups = brute_groups([t for _, t in rows])
    order = lambda k: (rows[k][0] is None, rows[k][0] or 0)
    want = [rows[min((k for k, g in enumerate(groups) if g == x), key=order)] for x in set(groups)]
    assert sorted(((r["doc_id"], r["text"] or "") for r in kept), key=repr) == sorted(want, key=repr)
    assert kept[0].__fields__ == odd_docs.columns
    assert corpus_pipeline.drop_near_copies(spark, no_docs, str(tmp_path)).count() == 0
