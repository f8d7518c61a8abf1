"""Operators over whole tables, against brute-force versions."""

from __future__ import annotations

import hashlib
import itertools
import random
import re
import zlib
from math import comb

import numpy as np
import pytest
import xxhash
from pyspark.sql import functions as F

from retailflow.llm import golay, graph, mixing, sharding, simhash, sketch, urls
from retailflow.llm.queries import URL_RULES


def test_golay_keys_meet_within_two_flips():
    r = np.random.default_rng(0)
    for width in (21, 22):
        values = r.integers(0, 1 << width, 300).astype(np.uint32)
        own = [set(row) for row in golay.keys(values, width)]
        assert {len(s) for s in own} <= {1, 6} | set(range(1, 7))
        for a, b in itertools.combinations_with_replacement(range(width), 2):
            other = golay.keys(values ^ np.uint32(1 << a) ^ np.uint32(0 if a == b else 1 << b), width)
            assert all(s & set(o) for s, o in zip(own, other, strict=True))


def brute_simhash(text, width=3):
    words = re.findall(r"[^\x20\x09-\x0D]+", re.sub("[A-Z]", lambda m: chr(ord(m[0]) + 32), text))
    if not words:
        return 0
    shingles = [" ".join(words[i : i + width]) for i in range(len(words) - width + 1)] or [" ".join(words)]
    counts = [0] * 64
    for s in shingles:
        h = xxhash.xxh64_intdigest(s.encode(), 42)
        for bit in range(64):
            counts[bit] += h >> bit & 1
    return sum(1 << bit for bit in range(64) if 2 * counts[bit] > len(shingles))


def test_simhash_fingerprints(odd_rows, monkeypatch):
    texts = [r[1] or "" for r in odd_rows] + ["One", "one two", "ÉA b\x1cc d"]
    assert [simhash.simhash(t) for t in texts] == [brute_simhash(t) for t in texts]
    monkeypatch.setattr(simhash, "BLOCK", 7)
    assert simhash.simhash(texts[0]) == brute_simhash(texts[0])


def brute_components(values):
    parent = {v: v for v in values}

    def root(v):
        while parent[v] != v:
            v = parent[v]
        return v

    for a, b in itertools.combinations(sorted(values), 2):
        if ((a ^ b) & ((1 << 64) - 1)).bit_count() <= 2:
            parent[max(root(a), root(b))] = min(root(a), root(b))
    return {v: root(v) for v in values}


@pytest.mark.parametrize("bucket", [64, 2])
def test_links_join_all_near_fingerprints(spark, monkeypatch, bucket):
    """With buckets of two nearly all links go the way of large buckets."""
    monkeypatch.setattr(simhash, "BUCKET", bucket)
    r = random.Random(3)
    values = {r.getrandbits(64) for _ in range(150)}
    for v in list(values):
        for _ in range(4):
            v ^= (1 << r.randrange(64)) | (1 << r.randrange(64))
            values.add(v)
    signed = {v - (1 << 64) if v >> 63 else v for v in values}
    classes = spark.createDataFrame([(v,) for v in signed], "fp long")
    found = {row["node"]: row["root"] for row in graph.components(simhash.near_links(classes)).collect()}
    want = brute_components(signed)
    assert {v: found.get(v, v) for v in signed} == want


def test_components_of_long_paths(spark):
    links = [(i, i + 1) for i in range(60)] + [(100, 100), (7, 3), (200, 201)]
    out = {r["node"]: r["root"] for r in graph.components(spark.createDataFrame(links, "a long, b long")).collect()}
    assert out == {**dict.fromkeys(range(61), 0), 200: 200, 201: 200}
    assert graph.components(spark.createDataFrame([], "a long, b long")).count() == 0


def test_near_groups(odd_docs, no_docs, odd_rows):
    out = simhash.near_groups(odd_docs).toPandas()
    assert len(out) == len(odd_rows)
    by_id = out.dropna(subset=["doc_id"]).drop_duplicates("doc_id").set_index("doc_id")["component_id"]
    assert by_id[2] == 1 and by_id[5] == by_id[6] == 4
    assert simhash.near_groups(no_docs).count() == 0


def test_sketch_law():
    r = random.Random(5)
    words = [f"w{r.randrange(10**6)}" for _ in range(6000)]
    book, part = " ".join(words), " ".join(words[1000:1400])
    a, b = sketch.sketch(part), sketch.sketch(book)
    assert sketch.compare(a, b)[1] == 1.0 and 0.03 < sketch.compare(a, b)[2] < 0.12
    assert abs(len(b) - 6000 / sketch.SCALE) < 200
    short = next(s for s in (" ".join(words[k : k + 5]) for k in range(100)) if sketch.sketch(s)[0] >= sketch.THRESHOLD)
    assert sketch.compare(sketch.sketch(short), b) == (0.0, None, 0.0)  # the book holds it, the sketch cannot say so
    assert sketch.compare(sketch.sketch(short), sketch.sketch(short)) == (1.0, 1.0, 1.0)
    halves = sketch.merge(sketch.sketch(" ".join(words[:3000])), sketch.sketch(" ".join(words[2996:])))
    assert np.array_equal(halves, b)
    assert np.array_equal(sketch.from_text(sketch.as_text(b)), b)
    empty = sketch.sketch("")
    assert sketch.as_text(empty) == "" and sketch.compare(empty, empty)[0] == 1.0 and sketch.compare(empty, b)[0] == 0.0


@pytest.mark.parametrize("rows_of_range", [1000, 2])
def test_edited_pairs(spark, monkeypatch, odd_docs, odd_rows, no_docs, rows_of_range):
    monkeypatch.setattr(sketch, "RANGE_ROWS", rows_of_range)
    order = sorted(((r[0], r[1] or "") for r in odd_rows), key=lambda x: (x[0] is None, x[0] or 0, x[1]))
    want = []
    for (doc_id, text), (_, after) in zip(order, order[1:] + order[:1], strict=True):
        edited = text[: len(text) - len(text) // 2] + after[: len(text) // 2]
        digest = hashlib.sha256(edited.encode()).hexdigest()
        want.append((doc_id, len(text), digest, sketch.as_text(sketch.sketch(text)), sketch.as_text(sketch.sketch(edited))))
    got = [tuple(r)[:5] for r in sketch.edited_pairs(odd_docs).collect()]
    assert sorted(got, key=str) == sorted(want, key=str)
    assert sketch.edited_pairs(no_docs).count() == 0
    one = spark.createDataFrame([(1, "only one text here")], "doc_id long, text string")
    assert sketch.edited_pairs(one).first()["near_next"] == 1.0


def test_mix_targets_and_takes(spark, odd_docs, no_docs):
    r = random.Random(2)
    rows = [(i, "w " * r.randrange(1, 60), None if i % 7 == 0 else f"s{(i % 3) * (i % 5 > 0)}") for i in range(3000)]
    docs = spark.createDataFrame(rows, "doc_id long, text string, source string")
    out = mixing.mix_report(docs).toPandas()
    source = {i: s for i, _, s in rows}
    out["source"] = [source[i] or "~null" for i in out["doc_id"]]
    sizes = out.groupby("source")["size"].sum()
    weights = dict(zip(sorted(sizes.index), itertools.cycle((5, 2, 1)), strict=False))
    target, budget = {}, 1.5 * sizes.sum()
    while True:  # deal out, cap, and deal the excess again
        free = [s for s in sizes.index if s not in target]
        share = (budget - sum(target.values())) / sum(weights[s] for s in free) if free else 0
        full = [s for s in free if share * weights[s] > 2 * sizes[s]]
        target |= {s: 2.0 * sizes[s] for s in full}
        if not full:
            target |= {s: share * weights[s] for s in free}
            break
    for s, part in out.groupby("source"):
        assert part["target"].iloc[0] == pytest.approx(target[s])
        assert abs(part["taken"].sum() - target[s]) <= part["size"].max()
    assert (out["taken"] <= 2 * out["size"]).all()
    again = mixing.mix_report(docs.repartition(5)).toPandas()
    assert sorted(zip(again["doc_id"], again["taken"], strict=True)) == sorted(zip(out["doc_id"], out["taken"], strict=True))
    copies = mixing.mix_documents(docs).groupBy("doc_id").count().toPandas().set_index("doc_id")["count"]
    assert all(copies.get(d, 0) * s == t for d, s, t in zip(out["doc_id"], out["size"], out["taken"], strict=True))
    assert mixing.mix_report(odd_docs).count() == odd_docs.count() and mixing.mix_report(no_docs).count() == 0
    assert mixing.mix_documents(odd_docs).columns == odd_docs.columns and mixing.mix_documents(no_docs).count() == 0


@pytest.mark.parametrize("repeats", [1_500, 1])
def test_mix_meets_its_target_where_rows_repeat(spark, repeats):
    """One document in three repeats: each source ends within half a document of its target, copies as well."""
    r = random.Random(3)
    rows = [(i, "w " * r.randrange(1, 60), f"s{i % 3}", i) for i in range(3_000)]
    rows += [(5, "v " * 50, "s0", k % 4) for k in range(repeats)] + [(6, "", "s0", 0)] * repeats + [(7, None, "s1", 0)] * 3
    docs = spark.createDataFrame(rows, "doc_id long, text string, source string, extra int")
    out = mixing.mix_report(docs).toPandas()
    assert len(out) == len(rows)
    by_size = out.groupby("source_size")
    for _, part in by_size:
        assert abs(part["taken"].sum() - part["target"].iloc[0]) <= 0.5 * part["size"].max()
    assert (out["taken"] <= 2 * out["size"]).all()
    mixed = mixing.mix_documents(docs)
    assert mixed.columns == docs.columns
    words = {k: v for k, v in mixed.groupBy("doc_id").agg(F.sum(F.size(F.split(F.trim("text"), " +")))).collect()}
    taken = out.groupby("doc_id")["taken"].sum()
    assert all(words.get(d, 0) == t for d, t in taken.items() if d not in (6, 7))


def test_smaller_budget_is_nested(spark):
    docs = spark.createDataFrame([(i, "w " * (i % 40 + 1), "s") for i in range(2000)], "doc_id long, text string, source string")
    rows = mixing.sized(docs)
    taken = [
        {r["doc_id"] for r in mixing.mixed(rows, total_share=share).where("copies > 0").collect()} for share in (0.2, 0.5)
    ]
    assert taken[0] < taken[1]


def test_hypergeometric_law():
    r, n = random.Random(3), 40_000
    draws = [sharding.hypergeometric(r, 7, 11, 6) for _ in range(n)]
    for k in range(7):
        assert abs(draws.count(k) / n - comb(7, k) * comb(11, 6 - k) / comb(18, 6)) < 0.012
    huge = [sharding.hypergeometric(r, 10**10, 3 * 10**10, 10**6) for _ in range(200)]
    assert abs(np.mean(huge) - 250_000) < 150


def test_shards(spark, odd_docs, no_docs, odd_rows):
    docs = spark.createDataFrame([(i, f"text {i % 50}") for i in range(5000)], "doc_id long, text string")
    out = sharding.shuffle_into_shards(docs, shards=24).toPandas()
    sizes = out.groupby("shard").size()
    assert len(out) == 5000 and len(sizes) == 24 and sizes.max() - sizes.min() <= 1
    assert all(sorted(part) == list(range(len(part))) for _, part in out.groupby("shard")["slot"])
    assert all(c == zlib.crc32(f"text {i % 50}".encode()) for i, c in zip(out["doc_id"], out["text_crc32"], strict=True))
    assert abs(np.corrcoef(out["doc_id"], out["shard"] * 1000 + out["slot"])[0, 1]) < 0.05
    again = sharding.shuffle_into_shards(docs.repartition(7), shards=24).toPandas()
    assert sorted(map(tuple, again.values.tolist())) == sorted(map(tuple, out.values.tolist()))
    few = sharding.shuffle_into_shards(odd_docs, shards=24).toPandas()
    assert len(few) == len(odd_rows) and few.groupby("shard").size().max() == 1
    assert sharding.shuffle_into_shards(no_docs).count() == 0


def test_url_rules_and_parts(spark):
    cases = [
        ("http://A.Example.ORG/es/1?x", "a.example.org", "/es/1", "example.org/es/", "block"),
        ("https://example.org/en/12#t", "example.org", "/en/12", "example.org/en/1", "block"),
        ("https://example.org/en/2", "example.org", "/en/2", "org/", "allow"),
        ("x://notexample.org/es/", "notexample.org", "/es/", "org/", "allow"),
        ("http://b.com/fr/x", "b.com", "/fr/x", "com/fr/", "allow"),
        ("http://b.com/de/x", "b.com", "/de/x", "com/de/", "block"),
        ("http://b.org", "b.org", "", None, None),
        ("b.org/path", "", "", None, None),
        (None, "", "", None, None),
        ("http://É.com/a://b", "É.com", "/a://b", None, None),
    ]
    pages = spark.createDataFrame([(i, c[0], "h") for i, c in enumerate(cases)], "page_id long, url string, html string")
    got = {r["page_id"]: r for r in urls.judge(pages, URL_RULES).collect()}
    assert len(got) == len(cases)
    for i, (_, host, path, rule, verdict) in enumerate(cases):
        assert (got[i]["host"], got[i]["path"], got[i]["rule"]) == (host, path, rule)
        assert got[i]["verdict"] == verdict or (verdict is None and got[i]["verdict"] in ("allow", "block"))
    assert urls.judge(pages.where("page_id < 0"), URL_RULES).count() == 0
    assert urls.judge(pages, []).where("verdict = 'allow'").count() == len(cases)


def test_url_models_tell_hosts_apart(spark):
    r = random.Random(6)
    good, bad = ["garden", "museum", "library"], ["cheap-pills", "casino-win", "spam-farm"]
    name = lambda part: f"http://{r.choice(part)}{r.randrange(99)}"
    rows = [(i, name(good) + ".com/fr/a" if i % 2 else name(bad) + ".com/de/a") for i in range(600)]
    rows += [(1000 + i, name(good) + ".net/x") for i in range(50)] + [(2000 + i, name(bad) + ".net/x") for i in range(50)]
    out = urls.judge(spark.createDataFrame(rows, "page_id long, url string"), URL_RULES).where(F.col("rule").isNull()).toPandas()
    unwanted = out["page_id"] >= 2000
    assert (out.loc[unwanted, "verdict"] == "block").mean() >= 0.95
    assert out.loc[~unwanted, "score"].min() > out.loc[unwanted, "score"].median()
