"""Document pipeline: each stage keeps or changes documents and hands the rest to the next.

Every stage returns the columns of ``documents``, but for the last, which has token ids in place of
the text. Null texts are empty for decisions and pass unchanged; an empty table passes every stage.
Extra columns ride along.
"""

from __future__ import annotations

from pyspark.sql import DataFrame, SparkSession
from pyspark.sql import functions as F

from retailflow.llm import bpe, mixing, nearcopies, secrets, toxicity
from retailflow.llm.common import stored, table
from retailflow.llm.queries import rank_file


def drop_toxic(spark: SparkSession, docs: DataFrame, sf_dir: str) -> DataFrame:
    """Documents that the classifier, trained on the labels of ``sf_dir``, does not find toxic."""
    return toxicity.without_toxic(docs, toxicity.train(docs, table(spark, sf_dir, "labels")))


def drop_near_copies(spark: SparkSession, docs: DataFrame, sf_dir: str) -> DataFrame:
    """One document of each near-duplicate group: that of the smallest id, then of the smallest text hash.

    Groups are the components of texts whose five-word shingles are alike by 0.8 or more, found by Golay keys
    of SimHash fingerprints. Documents meet the chosen ids by id and text hash, so a group of any size is
    spread over all tasks. Of rows that repeat both one stays: only such rows are aggregated, all others
    pass as they are read.
    """
    marked = docs.withColumn("__hash", F.xxhash64(F.coalesce("text", F.lit(""))))
    ids = marked.groupBy("doc_id", F.col("__hash").alias("text_hash")).agg(F.count(F.lit(1)).alias("n"))
    groups = stored(nearcopies.near_copies(docs), "groups")
    grouped = stored(ids, "ids").join(groups, "text_hash", "left")
    order = F.struct(F.col("doc_id").isNull(), "doc_id", "text_hash")
    chosen = grouped.groupBy(F.coalesce("group", "text_hash").alias("group")).agg(F.min_by(F.struct("doc_id", "text_hash", "n"), order).alias("first"))
    chosen = stored(chosen.select(F.col("first.doc_id").alias("__id"), F.col("first.text_hash").alias("__text"), F.col("first.n").alias("__n")), "chosen")
    same = F.col("doc_id").eqNullSafe(F.col("__id")) & (F.col("__hash") == F.col("__text"))
    columns = [marked[c] for c in docs.columns]
    kept = marked.join(chosen.where("__n = 1"), same, "left_semi").select(*columns)
    repeated = chosen.where("__n > 1")
    if repeated.isEmpty():
        return kept
    row = F.struct(*[marked[c] for c in docs.columns])
    rows = marked.join(repeated, same, "left_semi").select("doc_id", "__hash", row.alias("__row"))
    one = rows.groupBy("doc_id", "__hash").agg(F.first("__row").alias("__row"))
    return kept.unionByName(one.select("__row.*"))


def mask_secrets(spark: SparkSession, docs: DataFrame, sf_dir: str) -> DataFrame:
    """Documents with the secrets that rules and character models find replaced by a mask."""
    return secrets.mask_secrets(docs, secrets.train(secrets.corpus_counts(docs)))


def mix_sources(spark: SparkSession, docs: DataFrame, sf_dir: str) -> DataFrame:
    """Documents as often as the mix of sources takes them."""
    return mixing.mix_documents(docs)


def encode_tokens(spark: SparkSession, docs: DataFrame, sf_dir: str) -> DataFrame:
    """Token ids in place of the text; the ids decode to the text byte by byte."""
    return bpe.encode_documents(docs, *rank_file()).drop("text")


STAGES = [
    ("toxicity", drop_toxic),
    ("SimHash near-dedup", drop_near_copies),
    ("secret scans", mask_secrets),
    ("mixing sources to target weights", mix_sources),
    ("byte-level BPE encoding and decoding", encode_tokens),
]

#: SQL has neither the classifier nor the merges; the stages are tested against brute-force versions.
ORACLE_SQL = None


def run(spark: SparkSession, sf_dir: str) -> DataFrame:
    """All stages over ``documents``; what a stage returns is written and read again by the next."""
    docs = table(spark, sf_dir, "documents")
    for number, (_, stage) in enumerate(STAGES):
        docs = stored(stage(spark, docs, sf_dir), f"stage{number}")
    return docs
