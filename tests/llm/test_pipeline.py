"""The pipeline's stages on awkward tables, and the queries registered."""

from __future__ import annotations

import base64
import hashlib
import itertools
import math
import re
from collections import Counter

import corpus_pipeline
import public_tokenizers
import pytest
import tiktoken
import xxhash

import __spark_entry__ as entry
from retailflow.llm import secrets, toxicity


@pytest.fixture(scope="module")
def folder(spark, odd_docs, labels, tmp_path_factory):
    path = str(tmp_path_factory.mktemp("tables"))
    odd_docs.write.parquet(f"{path}/documents.parquet")
    labels.write.parquet(f"{path}/labels.parquet")
    return path


def test_stages_keep_columns(spark, folder, odd_docs, no_docs):
    for docs in (odd_docs, no_docs):
        columns = docs.columns
        for number, (_, stage) in enumerate(corpus_pipeline.STAGES):
            before, docs = docs, stage(spark, docs, folder)
            if number < len(corpus_pipeline.STAGES) - 1:
                assert docs.columns == columns
            assert docs.count() <= 2 * before.count()
        assert {"ids", "n_tokens"} <= set(docs.columns)


def test_whole_run(spark, folder):
    assert corpus_pipeline.run(spark, folder).count() > 0


def brute_mix(rows):
    """Copies of each (id, text, source) by sorting hashes, with shares dealt out round by round."""
    size = lambda text: len(re.findall(r"[^\x20\x09-\x0D]+", text or ""))
    md5 = lambda text: hashlib.md5(text.encode()).hexdigest()
    place = lambda i, t: int(md5(f"{'-' if i is None else i}:{md5(t or '')}")[:9], 16)
    sources = sorted({r[2] for r in rows}, key=lambda x: (x is None, (x or "").encode()))
    weight = dict(zip(sources, itertools.cycle((5, 2, 1)), strict=False))
    total = {s: sum(size(r[1]) for r in rows if r[2] == s) for s in sources}
    target, budget = {}, 1.5 * sum(total.values())
    while free := [s for s in sources if s not in target]:
        level = (budget - sum(target.values())) / sum(weight[s] for s in free)
        full = [s for s in free if level * weight[s] >= 2 * total[s]]
        target |= {s: 2.0 * total[s] for s in full} if full else {s: level * weight[s] for s in free}
    out = Counter()
    for s in sources:
        times = math.floor(target[s] / max(1, total[s]))
        due = target[s] - times * total[s]
        before = 0
        own = [r for r in rows if r[2] == s]
        for row in sorted(own, key=lambda r: (place(r[0], r[1]), size(r[1]))):
            words = size(row[1])
            more = before + words <= due or (before <= due and 2 * (due - before) > words)
            before += words
            out[row[:2]] += times + more
    return +out


def five_words(text):
    words = re.findall(r"[^\x20\x09-\x0D]+", re.sub("[A-Z]", lambda m: m[0].lower(), text or ""))
    return {tuple(words[k : k + 5]) for k in range(max(1, len(words) - 4))} if words else set()


def test_run_equals_brute_force(spark, folder, odd_docs, labels):
    rows = [(r["doc_id"], r["text"], r["source"]) for r in odd_docs.collect()]
    model = toxicity.train(odd_docs, labels)
    rows = [r for r in rows if model.score(r[1] or "") < 0.5]
    groups = []  # of row numbers
    sets = [five_words(r[1]) for r in rows]
    alike = lambda a, b: 100 * len(a & b) >= 80 * len(a | b)
    for k in range(len(rows)):
        near = [g for g in groups if any(alike(sets[k], sets[j]) for j in g)]
        groups = [g for g in groups if g not in near] + [[k, *itertools.chain.from_iterable(near)]]
    signed = lambda x: x - (1 << 64) if x >> 63 else x
    order = lambda r: (r[0] is None, r[0] or 0, signed(xxhash.xxh64_intdigest((r[1] or "").encode(), 42)))
    rows = [min((rows[k] for k in g), key=order) for g in groups]
    table = spark.createDataFrame([(*r, 0) for r in rows], "doc_id long, text string, source string, n_chars long")
    known = secrets.train(secrets.corpus_counts(table))
    rows = [(i, None if t is None else secrets.masked(t, known), s) for i, t, s in rows]
    with open(public_tokenizers.path("byte_bpe_50k.tiktoken"), "rb") as lines:
        ranks = {base64.b64decode(a): int(b) for a, b in map(bytes.split, lines)}
    coder = tiktoken.Encoding("own", pat_str=public_tokenizers.PATTERN, mergeable_ranks=ranks, special_tokens={})
    want = Counter()
    for (doc_id, text), copies in brute_mix(rows).items():
        want[doc_id, tuple(coder.encode_ordinary(text or ""))] += copies
    got = Counter((r["doc_id"], tuple(r["ids"])) for r in corpus_pipeline.run(spark, folder).collect())
    assert got == want


def test_registered():
    names = entry.queries().keys()
    assert "pipeline" in names
    assert [sum(n.startswith(f"op{k}_") for n in names) for k in range(1, 14)] == [1] * 13
    assert entry.oracle_sql().keys() <= names
