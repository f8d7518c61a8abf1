"""Registered queries of the operators, each over its whole table."""

from __future__ import annotations

import os
from collections.abc import Callable

from pyspark.sql import DataFrame, SparkSession
from pyspark.sql import functions as F

from retailflow.llm import alignment, bpe, mixing, pii, quality, ranking, secrets, setjoin, sharding, simhash, sketch, toxicity, urls
from retailflow.llm.common import table

Query = Callable[[SparkSession, str], DataFrame]
_QUERIES: dict[str, Query] = {}


def query(build: Query) -> Query:
    """Register a query under its function name."""
    _QUERIES[build.__name__] = build
    return build


def registered() -> dict[str, Query]:
    return dict(_QUERIES)


def rank_file() -> tuple[str, str]:
    """Path of the rank file and pre-token pattern; ``BYTE_BPE_RANKS`` names another file."""
    import public_tokenizers

    named = os.environ.get("BYTE_BPE_RANKS")
    return named or public_tokenizers.path("byte_bpe_50k.tiktoken"), public_tokenizers.PATTERN


@query
def op10_byte_bpe(spark: SparkSession, folder: str) -> DataFrame:
    """Token ids of every document and the bytes they decode to, as digests."""
    return bpe.token_digests(table(spark, folder, "documents"), *rank_file())


@query
def op2_simhash_groups(spark: SparkSession, folder: str) -> DataFrame:
    """Fingerprint and near-duplicate component of every document."""
    groups = simhash.near_groups(table(spark, folder, "documents"))
    return groups.select(
        "doc_id",
        simhash.fingerprint_hex("fp").alias("fingerprint"),
        "component_id",
        simhash.fingerprint_hex("group_fp").alias("group_fingerprint"),
    )


@query
def op3_threshold_sketch(spark: SparkSession, folder: str) -> DataFrame:
    """Sketch of every document and of its edited text, and likeness to that and to the next document."""
    return sketch.edited_pairs(table(spark, folder, "documents"))


@query
def op7_secret_scan(spark: SparkSession, folder: str) -> DataFrame:
    """Secrets of every document: by the rules, and random strings by the character models."""
    docs = table(spark, folder, "documents")
    model = secrets.train(secrets.corpus_counts(docs))
    return secrets.find_secrets(docs, model)


@query
def op4_source_mix(spark: SparkSession, folder: str) -> DataFrame:
    """How many words of every document the mix of sources takes."""
    return mixing.mix_report(table(spark, folder, "documents"))


@query
def op5_uniform_shards(spark: SparkSession, folder: str) -> DataFrame:
    """Shard and slot of every document in a uniform shuffle with exact row counts."""
    dealt = sharding.shuffle_into_shards(table(spark, folder, "documents"), shards=24)
    return dealt.select(
        "doc_id",
        "size",
        "text_crc32",
        F.lit("rows").alias("law"),
        "shard",
        "slot",
        F.lit(None).cast("int").alias("grown_shard"),
    )


URL_RULES = [
    urls.Rule("allow", "org", "/"),
    urls.Rule("block", "example.org", "/es/"),
    urls.Rule("block", "example.org", "/en/1"),
    urls.Rule("allow", "com", "/fr/"),
    urls.Rule("block", "com", "/de/"),
]


@query
def op8_url_verdicts(spark: SparkSession, folder: str) -> DataFrame:
    """Verdict on the URL of every page, by rule or by the character models."""
    return urls.judge(table(spark, folder, "pages"), URL_RULES)


@query
def op9_personal_data(spark: SparkSession, folder: str) -> DataFrame:
    """Personal data in every document: by the rules, and candidates that the boosted trees select."""
    return pii.find_personal_data(table(spark, folder, "documents"))


@query
def op6_toxicity_scores(spark: SparkSession, folder: str) -> DataFrame:
    """Toxicity of every document by the counterfactual-regularised classifier."""
    docs, labels = table(spark, folder, "documents"), table(spark, folder, "labels")
    return toxicity.score_documents(docs, toxicity.train(docs, labels))


@query
def op1_quality_rules(spark: SparkSession, folder: str) -> DataFrame:
    """Measures of every document, the base rule, and the verdict of the risk-controlled rules."""
    out = quality.judged(table(spark, folder, "documents"), table(spark, folder, "labels"))
    counts = ("n_words", "word_chars", "n_symbols", "n_dup_lines", "n_repeat_words")
    return out.select("doc_id", *counts, "base_failed", "kept")


@query
def op11_set_similarity(spark: SparkSession, folder: str) -> DataFrame:
    """Near-duplicate component of every document by the chosen-path join."""
    return setjoin.similar_documents(table(spark, folder, "documents"))


@query
def op13_ranked_search(spark: SparkSession, folder: str) -> DataFrame:
    """The ten best documents for every benchmark item."""
    return ranking.ranked(table(spark, folder, "documents"), table(spark, folder, "benchmark"))


def tokenizer_files() -> tuple[str, str]:
    """Paths of the byte-level vocabulary and the sentencepiece model of the alignment; ``ALIGNED_A`` and ``ALIGNED_B`` name other files."""
    import public_tokenizers

    names = {"ALIGNED_A": "byte_bpe_50k.json", "ALIGNED_B": "piece_bpe_32k.model"}
    return tuple(os.environ.get(key) or public_tokenizers.path(name) for key, name in names.items())


@query
def op12_token_alignment(spark: SparkSession, folder: str) -> DataFrame:
    """Groups and links of both tokenizers' tokens in every document, with corpus-wide counts of the links."""
    return alignment.alignment_report(table(spark, folder, "documents"), *tokenizer_files())
