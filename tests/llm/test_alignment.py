"""Alignment of two tokenizers against whole texts tokenised at once and pairs counted in memory."""

from __future__ import annotations

import hashlib
import random
from collections import Counter

import numpy as np
import pytest

from tokenizers import Tokenizer

from retailflow.llm import alignment
from retailflow.llm.queries import tokenizer_files

PLAIN = Tokenizer.from_file(tokenizer_files()[0])
PLAIN.encode_special_tokens = True


@pytest.fixture(scope="module")
def tools():
    return alignment.Aligner(*tokenizer_files())


def whole(tools, text):
    """(a ids, b ids, groups) of a text without any cut; None where bytes differ."""
    a = PLAIN.encode(" " + text, add_special_tokens=False).ids
    b = tools.b.encode(text)
    a_parts, b_parts = [tools.a_bytes.get(i, b"") for i in a], [tools.b_bytes[i] for i in b]
    data = b" " + text.encode()
    if not text or b"".join(a_parts) != data or b"".join(b_parts) != data:
        return None
    ends = [np.cumsum([len(x) for x in parts]).tolist() for parts in (a_parts, b_parts)]
    groups, i, j = [], 0, 0
    for end in sorted(set(ends[0]) & set(ends[1])):
        x, y = ends[0].index(end) + 1, ends[1].index(end) + 1
        groups.append((a[i:x], b[j:y]))
        i, j = x, y
    return a, b, groups


def shown(groups):
    return ";".join(",".join(map(str, a)) + "|" + ",".join(map(str, b)) for a, b in groups)


def odd_texts():
    r = random.Random(2)
    signs = ["word", "Straße", "naïve", "don't", "<|endoftext|>", "<s>", "</s>", "<unk>", "<0x41>", "▁", "日本", "𝒳", "é", "123", "12.50", "\x1c"]
    blanks = [" ", " ", " ", "  ", "   ", "\n", " \n", "\n ", "\t", " ", "   ", " ", "\r\n", "", "\x85", "\x00"]
    texts = ["".join(r.choice(signs) + r.choice(blanks) for _ in range(r.randrange(1, 25))) for _ in range(1_500)]
    return texts + [" ", "  ", "\n", " a", "a ", "  a  ", "a", "", " x" * 3_000, "z" * 3_000]


def test_cut_texts_come_out_as_whole_ones(tools):
    texts = odd_texts()
    for text, row in zip(texts, tools.align(texts), strict=True):
        known = whole(tools, text)
        if known is None:
            assert row[:5] == (0, 0, 0, 0, "") and not row[5]
            continue
        a, b, groups = known
        assert row[:5] == (len(a), len(b), len(groups), len(groups), shown(groups))
        links = Counter(y[-1] << alignment.A_BITS | x[-1] for x, y in groups)
        assert dict(zip(row[5], row[6], strict=True)) == links


def test_both_encoders_agree(tools):
    merges = alignment.Aligner._by_merges(tokenizer_files()[0])
    assert tools.encode_a.__name__ == "encode_ordinary"
    assert all(merges(" " + t) == tools.encode_a(" " + t) for t in odd_texts())


def test_forgotten_pieces_are_learnt_again(monkeypatch):
    monkeypatch.setattr(alignment, "REMEMBERED", 5)
    tools, texts = alignment.Aligner(*tokenizer_files()), odd_texts()[:60]
    rows = tools.align(texts)
    assert [tools.align([t])[0] for t in texts] == rows
    assert len(tools.known) < 200


def brute(tools, rows):
    found = [whole(tools, text or "") for _, text in rows]
    links = [[(x[-1], y[-1]) for x, y in f[2]] if f else [] for f in found]
    count = Counter(p for own in links for p in own)
    best = Counter()
    for (_, b), n in count.items():
        best[b] = max(best[b], n)
    return [
        (
            doc_id,
            *((len(f[0]), len(f[1]), len(f[2]), len(f[2])) if f else (0, 0, 0, 0)),
            sum(count[p] == best[p[1]] for p in own),
            sum(count[p] for p in own),
            hashlib.sha256(shown(f[2]).encode()).hexdigest() if f else "",
        )
        for (doc_id, _), f, own in zip(rows, found, links, strict=True)
    ]


@pytest.mark.parametrize("small", [False, True])
def test_counts_of_the_whole_corpus(spark, monkeypatch, tools, small):
    if small:  # many runs, blocks and slices
        for name, value in (("SPILL", 500), ("BLOCK", 7), ("SLICE", 300), ("FEW_PAIRS", 0)):
            monkeypatch.setattr(alignment, name, value)
    rows = list(enumerate(odd_texts()[:400])) + [(5, "twice the same row")] * 2
    docs = spark.createDataFrame(rows, "doc_id long, text string")
    found = alignment.alignment_report(docs, *tokenizer_files()).collect()
    assert sorted(map(tuple, found)) == sorted(brute(tools, rows))


def test_odd_rows(spark, odd_docs, odd_rows, no_docs, tools):
    rows = [(r[0], r[1]) for r in odd_rows]
    found = alignment.alignment_report(odd_docs, *tokenizer_files()).collect()
    assert sorted(map(tuple, found), key=repr) == sorted(brute(tools, rows), key=repr)
    assert alignment.alignment_report(no_docs, *tokenizer_files()).count() == 0
    shown_groups = alignment.aligned_documents(odd_docs, *tokenizer_files(), groups=True).select("groups_sha256", "groups").collect()
    assert all(d == (hashlib.sha256(g.encode()).hexdigest() if g else "") for d, g in shown_groups)


def test_merge_of_runs(monkeypatch):
    """Pairs come in order of B with the counts of all runs, records with them, in rows of bounded size."""
    monkeypatch.setattr(alignment, "ROW", 40)
    r = np.random.default_rng(1)
    runs, want = [], Counter()
    for k in range(5):
        codes = np.sort(r.integers(0, 6, 300) << alignment.A_BITS | r.integers(0, 4, 300)).astype(np.int32)
        rows, times = np.arange(300) + 1_000 * k, r.integers(1, 5, 300).astype(np.int32)
        for c, d, t in zip(codes.tolist(), rows.tolist(), times.tolist(), strict=True):
            want[c, d] += t
        runs.append([alignment._packed(codes[i : i + 17], rows[i : i + 17], times[i : i + 17]) for i in range(0, 300, 17)])
    found, order = Counter(), []
    for b, others, counts, lengths, data in alignment.merged(runs):
        _, rows, times = alignment._unpacked(data)
        codes = np.repeat([b << alignment.A_BITS | a for a in others], lengths)
        for c, d, t in zip(codes.tolist(), rows.tolist(), times.tolist(), strict=True):
            found[c, d] += t
        assert counts == [sum(n for (c, _), n in want.items() if c == b << alignment.A_BITS | a) for a in others]
        order += [(b, a) for a in others]
    assert found == want and order == sorted(order)
