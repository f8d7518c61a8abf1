"""Operators that work text by text, against brute-force versions."""

from __future__ import annotations

import base64
import hashlib
import random
import re
import time
from collections import Counter

import numpy as np
import public_tokenizers
import pytest
import tiktoken
from pyspark.sql import functions as F

from retailflow.llm import bpe, pii, quality, secrets, toxicity
from retailflow.llm.common import WORD

RANKS, PATTERN = public_tokenizers.path("byte_bpe_50k.tiktoken"), public_tokenizers.PATTERN


def sha(text):
    return hashlib.sha256(text.encode()).hexdigest()


@pytest.fixture(scope="module")
def reference_coder():
    with open(RANKS, "rb") as lines:
        ranks = {base64.b64decode(a): int(b) for a, b in map(bytes.split, lines)}
    return tiktoken.Encoding("own", pat_str=PATTERN, mergeable_ranks=ranks, special_tokens={})


def odd_strings(n, seed=5):
    r = random.Random(seed)
    pick = [lambda: chr(r.randrange(32, 127)), lambda: chr(r.randrange(160, 0x3000)), lambda: " ", lambda: "\n", lambda: "\x1c\x85\xa0"]
    return ["".join(r.choice(pick)() for _ in range(r.randrange(50))) for _ in range(n)]


def test_bpe_equals_tiktoken_and_decodes(reference_coder):
    coder = bpe.ByteBpe(RANKS, PATTERN)
    texts = [*odd_strings(1500), "", "<|endoftext|>", "a" * 5000, "word  two   spaces \n\n end ", "▁▁ ▁", "𝒳é"]
    ids = coder.encode_all(texts)
    assert ids == [reference_coder.encode_ordinary(t) for t in texts]
    assert all(coder.decode(i) == t.encode() for i, t in zip(ids, texts, strict=True))


def test_bpe_forgets_pieces_without_changing_ids(monkeypatch, reference_coder):
    monkeypatch.setattr(bpe, "REMEMBERED", 5)
    coder = bpe.ByteBpe(RANKS, PATTERN)
    texts = odd_strings(200, seed=6)
    assert [coder.encode(t) for t in texts] == [reference_coder.encode_ordinary(t) for t in texts]


def test_bpe_rows(odd_docs, odd_rows, no_docs, reference_coder):
    got = sorted(tuple(r) for r in bpe.token_digests(odd_docs.where("doc_id IS NOT NULL"), RANKS, PATTERN).collect())
    want = []
    for row in odd_rows:
        if row[0] is not None:
            ids = reference_coder.encode_ordinary(row[1] or "")
            want.append((row[0], len(ids), sha(" ".join(map(str, ids))), sha(row[1] or "")))
    assert got == sorted(want)
    assert bpe.token_digests(no_docs, RANKS, PATTERN).count() == 0
    encoded = bpe.encode_documents(odd_docs, RANKS, PATTERN)
    decoded = bpe.decode_ids(encoded, RANKS, PATTERN).select("text", "decoded").collect()
    assert all(bytes(r["decoded"]) == (r["text"] or "").encode() for r in decoded)


def brute_measures(text):
    words = re.findall(WORD, text)
    windows = Counter(tuple(words[i : i + 5]) for i in range(len(words) - 4))
    covered = {i + k for i in range(len(words) - 4) for k in range(5) if windows[tuple(words[i : i + 5])] > 1}
    seen, copies = set(), 0
    for line in text.split("\n"):
        if re.search(WORD, line):
            copies += line in seen
            seen.add(line)
    return len(words), sum(map(len, words)), len(re.findall(r"[#*$%&|<>]", text)), copies, len(covered)


def test_quality_measures(odd_rows):
    r = random.Random(1)
    texts = [row[1] or "" for row in odd_rows]
    texts += [" ".join(r.choice("abc") for _ in range(r.randrange(30))) + r.choice(["\n", " "]) for _ in range(300)]
    for text in texts:
        assert quality.measures(text)[:5] == brute_measures(text)


def test_quality_bound_is_exact():
    """The bound holds for k of n exactly if so few have a chance of at most delta at that rate."""
    r, (n, rate, delta) = np.random.default_rng(3), (400, 0.02, 0.05)
    most = quality.most_rejected(n, rate, delta)
    draws = r.binomial(n, rate, 200_000)
    assert (draws <= most).mean() <= delta + 0.003 < (draws <= most + 1).mean() + 0.003
    assert quality.most_rejected(10, rate, delta) == -1
    assert quality.most_rejected(0, rate, delta) == -1


def test_quality_cutoffs_limit_false_rejection(spark):
    rows, known = [], []
    for i in range(4000):
        bad = i % 10 == 0
        text = " ".join(f"w{i}x{k}" + ("#" if bad or (i % 97 == 0 and k == 0) else "") for k in range(20))
        rows.append((i, text, "en" if i % 2 else None, "s", len(text)))
        known.append((i, int(not bad), 0))
    docs = spark.createDataFrame(rows, "doc_id long, text string, lang string, source string, n_chars long")
    out = quality.judged(docs, spark.createDataFrame(known, "doc_id long, quality int, toxic int")).toPandas()
    bad = out["doc_id"] % 10 == 0
    assert not out.loc[bad, "kept"].any()
    assert (~out.loc[~bad, "kept"]).mean() <= quality.ALPHA


def test_quality_odd_rows(odd_docs, no_docs, labels, no_labels, odd_rows):
    out = quality.judged(odd_docs, labels).toPandas()
    assert len(out) == len(odd_rows)
    assert (out["kept"] == ~out["base_failed"]).all()  # too few labels for any cutoff
    assert quality.judged(no_docs, labels).count() == 0
    assert quality.judged(odd_docs, no_labels).count() == len(odd_rows)


def brute_secrets(text):
    lower = text.translate({c: c + 32 for c in range(65, 91)})
    out = []
    assign = re.compile(r"""(password|passwd|secret|token|api_?key)["']?\x20*[:=]\x20*["']?([A-Za-z0-9+/_.=-]+)""")
    out += [(m.start(), 0, m.end()) for m in assign.finditer(lower) if len(m[2]) >= 6]
    out += [(m.start(), 1, m.end()) for m in re.finditer(r"AKIA[A-Z0-9]+", text) if len(m[0]) >= 20]
    out += [(m.start(), 2, m.end()) for m in re.finditer(r"[0-9a-f]+", text) if len(m[0]) >= 24]
    return sorted(out)


def test_secret_rules():
    r = random.Random(2)
    parts = ["token", "SECRET", "api_key", "ApiKey", " = ", ":", '"', "abcdef0123456789abcdef0123", "AKIA", "ABCDEFGH12345678", "x", " ", "ſecret=abcdefgh", "é"]
    for text in ["".join(r.choice(parts) for _ in range(12)) for _ in range(2000)]:
        assert secrets.base_spans(text) == brute_secrets(text)


def test_secret_models(spark, odd_docs, no_docs):
    r = random.Random(4)
    random_strings = ["".join(r.choice("abcdefghijklmnopqrstuvwxyzABCDEFGHIJKLMNOPQRSTUVWXYZ0123456789") for _ in range(32)) for _ in range(400)]
    words = "customer order total amount index value record window price update list threshold".split()
    names = ["_".join(r.choice(words) for _ in range(4)) for _ in range(400)]
    table = spark.createDataFrame([(s, True) for s in random_strings[:300]] + [(s, False) for s in names[:300]] + [(None, True), ("x", None)], "sample string, is_secret boolean")
    model = secrets.train(secrets.sample_counts(table))
    assert sum(model.score(s) > model.bound for s in random_strings[300:]) >= 98
    assert sum(model.score(s) > model.bound for s in names[300:]) == 0
    text = f"use {random_strings[300]} and {names[300]} or token = {random_strings[301]}"
    base, every = secrets.all_spans(text, model)
    assert [k for _, k, _ in base] == [0] and [k for _, k, _ in every] == [3, 0]
    assert secrets.masked(text, model) == f"use [secret] and {names[300]} or [secret]"
    for docs in (odd_docs, no_docs):
        flat = secrets.train(secrets.corpus_counts(docs))
        assert secrets.find_secrets(docs, flat).count() == docs.count()
        clean = secrets.mask_secrets(docs, flat)
        assert clean.columns == docs.columns and clean.where("text IS NULL").count() == docs.where("text IS NULL").count()
        assert clean.where("text LIKE '%f3ef4d6b%'").count() == 0


def test_random_strings_are_found_at_every_length(spark):
    """Models trained on a corpus that labels itself: recall by length, and ordinary tokens left alone."""
    r = random.Random(6)
    words = "customer order total amount index value record window price update list threshold between without question".split()
    hexed = lambda n: "".join(r.choice("0123456789abcdef") for _ in range(n))
    rows = [(k, " ".join(r.choice(words) for _ in range(40)) + (f" token = {hexed(40)}" if k % 5 == 0 else "")) for k in range(300)]
    model = secrets.train(secrets.corpus_counts(spark.createDataFrame(rows, "doc_id long, text string")))
    alphabets = {n: a for n, a in zip(("hex", "base32", "base62", "url"), (secrets.UNIFORM[k] for k in (0, 2, 4, 5)), strict=True)}
    for name, alphabet in alphabets.items():
        for length, least in ((12, 0.4), (16, 0.8), (20, 0.9), (32, 0.98), (64, 1.0)):
            found = sum(model.score("".join(r.choice(alphabet) for _ in range(length))) > model.bound for _ in range(300))
            assert found >= least * 300, (name, length)
    ordinary = ["-".join(r.choices(words, k=4)) for _ in range(500)] + ["/".join(r.choices(words, k=5)) for _ in range(500)]
    ordinary += [f"{r.choice(words)}_{r.choice(words)}_{r.randrange(10**6)}" for _ in range(500)]
    assert sum(model.score(t) > model.bound for t in ordinary) <= 1


def test_secret_spans_of_a_long_text_in_linear_time():
    model = secrets.train({False: secrets.transitions(["customer", "order", "total", "amount", "between"] * 200)})
    part = "token = abcdef0123456789 word 0123456789abcdef0123456789abcdef x9Kf2LqP8vTz4RwYc1Bn "
    times = []
    for n in (2_000, 16_000):
        started = time.perf_counter()
        base, every = secrets.all_spans(part * n, model)
        times.append(time.perf_counter() - started)
        assert len(base) == 2 * n and len(every) >= 3 * n - 1
    assert len(part) * 16_000 > 1_000_000 and times[1] < 8 * 3 * times[0]


def brute_pii(text):
    luhn = lambda d: sum((x if i % 2 == 0 else 2 * x - 9 * (x > 4)) for i, x in enumerate(map(int, reversed(d)))) % 10 == 0
    only = lambda s: re.sub("[^0-9]", "", s)
    out = [("email", *m.span()) for m in re.finditer(r"[A-Za-z0-9._%+-]+@[A-Za-z0-9-]+(\.[A-Za-z0-9-]+)+", text)]
    ips = re.finditer(r"[0-9]+(\.[0-9]+)(\.[0-9]+)(\.[0-9]+)", text)
    out += [("ip", *m.span()) for m in ips if all(int(x) <= 255 for x in m[0].split("."))]
    cards = re.finditer(r"[0-9]([\x20-]?[0-9])+", text)
    out += [("card", *m.span()) for m in cards if 16 <= len(only(m[0])) <= 19 and luhn(only(m[0]))]
    phones = re.finditer(r"\+[0-9][\x20().0-9-]+[0-9]", text)
    return out + [("phone", *m.span()) for m in phones if 8 <= len(only(m[0])) <= 15]


def test_personal_data_rules(spark, odd_docs, no_docs, odd_rows):
    r = random.Random(1)
    texts = ["".join(r.choice("ab.@+-19 0().%_é𝒳25") for _ in range(r.randrange(80))) for _ in range(1500)]
    texts += ["1." * 2000, "a@" + "b." * 2000, "4111 1111 1111 1111", "0255.1.1.1 256.1.1.1 a@b@c.d", None]
    docs = spark.createDataFrame(list(enumerate(texts)), "doc_id long, text string")
    got = {row["doc_id"]: row for row in pii.find_personal_data(docs).collect()}
    for i, text in enumerate(texts):
        want = brute_pii(text or "")
        assert got[i]["base_sha256"] == sha(",".join(":".join(map(str, x)) for x in want)), text
        assert got[i]["n_email"] == sum(k == "email" for k, *_ in want)
    assert pii.find_personal_data(odd_docs).count() == len(odd_rows)
    assert pii.find_personal_data(no_docs).count() == 0


def test_personal_data_trees_add_spans(spark):
    """Numbers shaped like the ones that rules accept are added; plain numbers are not."""
    r = random.Random(9)
    digits = lambda n: "".join(str(r.randrange(10)) for _ in range(n))
    rows = [(i, f"call +1 ({digits(3)}) {digits(3)}-{digits(4)} now" if i % 2 else f"item {digits(8)} sold") for i in range(400)]
    rows.append((1000, "call 1 (555) 123-4567 now"))
    out = pii.find_personal_data(spark.createDataFrame(rows, "doc_id long, text string")).toPandas().set_index("doc_id")
    assert out.loc[1000, "spans"].startswith("number:")
    assert (out.loc[[i for i in range(0, 400, 2)], "spans"] == "").all()
    text = pii.redacted(spark.createDataFrame([(1, "é mail a@b.co or +1 (017) 555-7713 x")], "doc_id long, text string"))
    assert text.first()["text"] == "é mail [private] or [private] x"


def planted_personal_data(r):
    """(texts that teach, texts with one planted span each and its generator, texts without personal data)."""
    digits = lambda n: "".join(str(r.randrange(10)) for _ in range(n))
    name = lambda: r.choice(["anna", "bert", "carla", "dmitri", "eve"]) + r.choice([".", "_"]) + r.choice(["berg", "kovac", "lima"])
    mac = lambda: ":".join(f"{r.randrange(256):02x}" for _ in range(6))
    phone = lambda: f"({digits(3)}) {digits(3)}-{digits(4)}"
    teach = []
    for _ in range(150):
        teach += [f"{r.choice(['please call', 'try', 'it was'])} +1 {phone()} today", f"write to {name()}@mail{digits(1)}.org please", f"follow user @{name()} there", f"the device {mac()} is on"]
    planted = []
    for _ in range(20):
        planted += [
            ("number", f"she said 1 {phone()} twice"),
            ("address", f"so {name()} (at) mail{digits(1)}.org it is"),
            ("handle", f"then @{name()} laughed"),
            ("device", f"seen {mac()} nearby"),
        ]
    clean = [f"order {digits(9)} shipped" for _ in range(150)] + [f"scores {r.randrange(9)}:{r.randrange(9)}:{r.randrange(9)}:{r.randrange(9)} at half time" for _ in range(150)]
    return teach, planted, clean


def test_planted_personal_data_is_added(spark):
    """Spans without the mark that rules ask for, and of kinds without a rule: recall by generator, clean texts left alone."""
    teach, planted, clean = planted_personal_data(random.Random(12))
    texts = teach + clean + [t for _, t in planted]
    docs = spark.createDataFrame(list(enumerate(texts)), "doc_id long, text string")
    spans = {r["doc_id"]: r["spans"] for r in pii.find_personal_data(docs).collect()}
    first = len(teach) + len(clean)
    found = Counter(kind for k, (kind, _) in enumerate(planted) if spans[first + k].startswith(kind + ":"))
    assert all(found[kind] >= 0.9 * 20 for kind in pii.GENERATORS), found
    assert not any(spans[k] for k in range(len(teach), first))


def test_personal_data_of_a_long_text_in_linear_time(spark):
    part = "mail a.b@c.org or +1 (017) 555-7713 then 12345678 or @name_1 and 1:2:3:4:5 12.13.14.15 "
    times = []
    for n in (500, 3_000, 12_000):
        docs = spark.createDataFrame([(1, part * n)], "doc_id long, text string")
        started = time.perf_counter()
        row = pii.find_personal_data(docs).first()
        times.append(time.perf_counter() - started)
        assert (row["n_email"], row["n_phone"], row["n_ip"]) == (n, n, n)
    assert len(part) * 12_000 > 1_000_000 and times[2] < 3 * 4 * times[1]


def test_spans_that_meet(spark):
    r = random.Random(15)
    spans = [(row, s, s + r.randrange(1, 12), r.randrange(-1, 3)) for row in range(40) for s in r.sample(range(60), 12)]
    table = spark.createDataFrame([(*x, k) for k, x in enumerate(spans)], "row long, start int, end int, kind int, number int")
    found = table.withColumn("met", pii._meets(F.col("kind") == -1)).collect()
    for x in found:
        others = [y for k, y in enumerate(spans) if k != x["number"] and y[0] == x["row"] and y[3] == -1]
        assert x["met"] == any(a < x["end"] and x["start"] < b for _, a, b, _ in others)


def test_toxicity_held_out_accuracy(spark):
    r = random.Random(8)
    plain = ["river", "stone", "cloud", "garden", "letter", "market", "winter", "music", "bread", "silver"]
    bad = ["loser", "idiot", "scum"]
    rows, known = [], []
    for i in range(1500):
        toxic = i % 6 == 0
        words = [r.choice(plain) + r.choice("abcde") for _ in range(15)] + ([r.choice(bad)] if toxic else [])
        words += ["muslim"] if r.random() < (0.5 if toxic else 0.02) else []
        r.shuffle(words)
        rows.append((i, " ".join(words), "en"))
        known.append((i, int(toxic)))
    docs = spark.createDataFrame(rows, "doc_id long, text string, lang string")
    marks = spark.createDataFrame(known, "doc_id long, toxic int")
    model = toxicity.train(docs, marks)
    counts = toxicity.held_out_quality(docs, marks, model)
    right = counts.loc[counts["label"] == counts["predicted"], "count"].sum()
    assert right >= 0.98 * counts["count"].sum()
    mention = "silvera rivera the muslim garden stonee"
    assert model.score(mention) < 0.5
    assert abs(model.raw(mention) - model.raw(mention.replace("muslim", "christian"))) < 0.5


def test_toxicity_odd_rows(odd_docs, no_docs, labels, no_labels, odd_rows):
    for marks in (labels, no_labels):
        model = toxicity.train(odd_docs, marks)
        out = toxicity.score_documents(odd_docs, model).toPandas()
        assert len(out) == len(odd_rows) and out["score"].between(0, 1).all()
        assert toxicity.score_documents(no_docs, model).count() == 0
        assert toxicity.without_toxic(odd_docs, model).columns == odd_docs.columns
    assert toxicity.train(no_docs, labels).weights == {}
