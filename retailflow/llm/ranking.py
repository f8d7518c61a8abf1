"""Ranked lexical search by pipelined term partitioning.

Every query item is ranked against all documents. Terms belong to owners by document frequency, the
rarest to the first owner. Items travel in bundles through the owners' stages, one after the other: a
bundle carries a sparse accumulator for each item (documents and their scores so far), and a stage
cogroups it with the owner's postings by slice of documents, adds the contributions of the owner's
terms in 64-bit integers, and hands the bundle on. The last stage selects the best of each slice, and
the best of those are the answer.

An accumulator is dropped as soon as it cannot win: a document stays only if its score so far and the
most that later owners could still add (the sum over the item's remaining terms of the largest contribution
in any posting) reach the item's tenth-highest score so far. Scores only grow, so what is dropped is
never among the best, and ties stay. Rare terms come first, because they raise that score with the
fewest documents.

Documents are dealt to slices by hash, so that a slice holds about ``SLICE`` documents and postings to
match, and a bundle has at most ``BUNDLE`` items: a task holds one bundle's items against one slice,
whatever term or document is frequent. Items whose terms are more than ``MOST_TERMS`` together are
ranked in blocks; the terms of a block are the only thing that is broadcast.

Null and empty texts have no terms: such items have no rows and such documents are in no answer. Repeated
documents are ranked one by one, repeated items get rows each; a null document id comes last among
equal scores. An empty table on either side gives an empty answer. Further columns are not read.
"""

from __future__ import annotations

from collections import Counter

import numpy as np
import pyarrow as pa
from pyspark.sql import Column, DataFrame, Window
from pyspark.sql import functions as F
from pyspark.sql import types as T

from retailflow.llm.common import map_rows, stored

#: A term is a run of characters other than these ASCII ranges; only A-Z are lower-cased.
NO_TERM = [*range(0x00, 0x30), *range(0x3A, 0x41), *range(0x5B, 0x61), *range(0x7B, 0x80)]
_CLEAR = bytes(32 if b in NO_TERM else b for b in range(128)).lower() + bytes(range(128, 256))

BEST = 10
#: Owners: a term belongs to the owner with as many of these shares of all documents below its frequency.
OWNER_SHARES = (1 / 512, 1 / 64, 1 / 8)
BUNDLE = 256
SLICE, SLICE_POSTINGS = 4_096, 2_000_000
MOST_TERMS = 300_000

_RESULT = "item_id long, rank int, doc_id long, score long"
_CARRIED = "bundle int, slice int, item long, rows array<long>, doc_ids array<long>, scores array<long>"


def terms_of(text: str) -> list[bytes]:
    """All terms of a text in order, as UTF-8."""
    return text.encode().translate(_CLEAR).split()


def item_terms(items: DataFrame) -> DataFrame:
    """[item, item_id, block, bundle, term, q]: the terms of each row of ``items`` [item_id, text] with their counts."""

    def counted(text: str) -> tuple:
        found = Counter(terms_of(text))
        return [t.decode() for t in found], list(found.values())

    start = lambda: lambda texts: list(map(counted, texts))
    rows = map_rows(items, "text", (("terms", "array<string>"), ("counts", "array<int>")), start, ["item_id"])
    rows = stored(rows.where(F.size("terms") > 0).withColumn("item", F.monotonically_increasing_id()), "items")
    # One narrow row an item; a block's terms are at most the sum of its items' terms.
    order = Window.orderBy("item")
    upto = F.sum(F.size("terms").cast("long")).over(order)
    placed = rows.select(
        "item",
        F.floor((upto - 1) / MOST_TERMS).cast("int").alias("block"),
        F.floor((F.row_number().over(order) - 1) / BUNDLE).cast("int").alias("bundle"),
    )
    pairs = F.explode(F.arrays_zip("terms", "counts")).alias("t")
    every = rows.join(placed, "item").select("item", "item_id", "block", "bundle", pairs)
    every = every.select("item", "item_id", "block", "bundle", F.col("t.terms").alias("term"), F.col("t.counts").alias("q"))
    return stored(every, "item_terms")


def counted_documents(docs: DataFrame, vocabulary: list[str]) -> DataFrame:
    """[row, doc_id, n, terms, tfs] of every row of ``docs``: its number of terms and its counts of those of the vocabulary."""
    known = docs.sparkSession.sparkContext.broadcast({t.encode(): k for k, t in enumerate(vocabulary)})

    def start():
        number = known.value.get

        def counted(text: str) -> tuple:
            words = terms_of(text)
            found = [(k, c) for t, c in Counter(words).items() if (k := number(t)) is not None]
            return len(words), [k for k, _ in found], [c for _, c in found]

        return lambda texts: list(map(counted, texts))

    fields = (("n", "long"), ("terms", "array<int>"), ("tfs", "array<int>"))
    rows = map_rows(docs.select("doc_id", "text"), "text", fields, start, ["doc_id"])
    return rows.withColumn("row", F.monotonically_increasing_id())


def _factor() -> Column:
    return F.expr("(1000000000L * tf) div (1000L * tf + 8L * m)")


def term_weights(rows: DataFrame, n_docs: int) -> DataFrame:
    """[term, w, most, owner]: weight of each term that occurs, its largest contribution, and its owner."""
    each = rows.select("m", F.explode(F.arrays_zip("terms", "tfs")).alias("t"))
    each = each.select(F.col("t.terms").alias("term"), F.col("t.tfs").cast("long").alias("tf"), "m")
    seen = each.groupBy("term").agg(F.count(F.lit(1)).alias("df"), F.max(_factor()).alias("factor"))
    weight = F.floor(1000 * F.log(F.lit(float(2 * n_docs + 2)) / (2 * F.col("df") + 1))).cast("long")
    owner = sum((F.col("df") > share * n_docs).cast("int") for share in OWNER_SHARES)
    return seen.select("term", weight.alias("w"), (weight * F.col("factor")).alias("most"), owner.alias("owner"))


def owned_postings(rows: DataFrame, owners: np.ndarray) -> DataFrame:
    """[owner, row, doc_id, m, terms, tfs]: the terms of each document by owner; ``owners`` gives that of each term."""
    known = rows.sparkSession.sparkContext.broadcast(owners)
    names = ["owner", "row", "doc_id", "m", "terms", "tfs"]

    def run(batches):
        for batch in batches:
            terms, tfs = batch.column(3), batch.column(4)
            flat = terms.flatten().to_numpy(zero_copy_only=False)
            counts = tfs.flatten().to_numpy(zero_copy_only=False)
            sizes = np.diff(terms.offsets.to_numpy())
            row = np.repeat(np.arange(len(sizes)), sizes)
            owner = known.value[flat]
            for k in range(len(OWNER_SHARES) + 1):
                own = owner == k
                size = np.bincount(row[own], minlength=len(sizes))
                has = np.flatnonzero(size)
                offsets = pa.array(np.r_[0, np.cumsum(size[has])].astype(np.int32))
                lists = [pa.ListArray.from_arrays(offsets, pa.array(x[own])) for x in (flat, counts)]
                first = [batch.column(c).take(pa.array(has)) for c in range(3)]
                yield pa.RecordBatch.from_arrays([pa.array(np.full(len(has), k, np.int32)), *first, *lists], names)

    narrow = rows.where(F.size("terms") > 0).select("row", "doc_id", "m", "terms", "tfs")
    return narrow.mapInArrow(run, "owner int, row long, doc_id long, m long, terms array<int>, tfs array<int>")


def _flat(table: pa.Table, name: str) -> pa.Array:
    column = table.column(name).combine_chunks()
    return column.flatten() if not isinstance(column, pa.ChunkedArray) else pa.array([], column.type.value_type)


def add_contributions(last: bool):
    """One stage for one bundle and slice: accumulators and own terms against the owner's postings."""
    names = [f.name for f in T.StructType.fromDDL(_CARRIED)]

    def run(key, bundle: pa.Table, postings: pa.Table) -> pa.Table:
        held = bundle.filter(pa.compute.is_valid(bundle["rows"]))
        asked = bundle.filter(pa.compute.is_null(bundle["rows"]))
        # Documents of this slice that have a score or a posting, by number.
        old_rows, old_ids = _flat(held, "rows"), _flat(held, "doc_ids")
        new_rows, new_ids = postings["row"].combine_chunks(), postings["doc_id"].combine_chunks()
        rows, at, place = np.unique(
            np.concatenate([old_rows.to_numpy(zero_copy_only=False), new_rows.to_numpy(zero_copy_only=False)]).astype(np.int64),
            return_index=True,
            return_inverse=True,
        )
        ids = pa.concat_arrays([x.cast(pa.int64()) for x in (old_ids, *(new_ids.chunks if hasattr(new_ids, "chunks") else [new_ids]))])
        ids = ids.take(pa.array(at))
        n_old = len(old_rows)
        # Postings by term, with their part of the contribution.
        terms = _flat(postings, "terms").to_numpy(zero_copy_only=False)
        tf = _flat(postings, "tfs").to_numpy(zero_copy_only=False).astype(np.int64)
        sizes = np.asarray(pa.compute.list_value_length(postings["terms"])).astype(np.int64)
        m = np.repeat(np.asarray(postings["m"]).astype(np.int64), sizes)
        where = np.repeat(place[n_old:], sizes)
        order = np.argsort(terms, kind="stable")
        factor = (1_000_000_000 * tf // (1_000 * tf + 8 * m))[order] if len(tf) else tf
        where, terms = where[order], terms[order]
        # What each item brings.
        began = np.r_[0, np.cumsum(np.asarray(pa.compute.list_value_length(held["rows"])).astype(np.int64))]
        old_scores = _flat(held, "scores").to_numpy(zero_copy_only=False)
        old_of = {item: slice(a, b) for item, a, b in zip(held["item"].to_pylist(), began, began[1:])}
        no_id = np.asarray(ids.is_null())
        by_id = ids.fill_null(0).to_numpy(zero_copy_only=False)
        out = []
        for item, need, own_terms, weights in zip(*(asked[c].to_pylist() for c in ("item", "need", "terms", "weights"))):
            score = np.zeros(len(rows), np.int64)
            if item in old_of:
                score[place[:n_old][old_of[item]]] = old_scores[old_of[item]]
            low = np.searchsorted(terms, own_terms, "left")
            high = np.searchsorted(terms, own_terms, "right")
            for a, b, w in zip(low, high, weights):
                score[where[a:b]] += w * factor[a:b]  # a document has one posting of a term
            keep = np.flatnonzero((score > 0) & (score >= need))
            if last and len(keep):
                best = np.lexsort((rows[keep], by_id[keep], no_id[keep], -score[keep]))[:BEST]
                keep = keep[best]
            if len(keep):
                out.append((item, rows[keep], ids.take(pa.array(keep)), score[keep]))
        lists = pa.list_(pa.int64())
        return pa.table(
            [
                pa.array([key[0].as_py()] * len(out), pa.int32()),
                pa.array([key[1].as_py()] * len(out), pa.int32()),
                pa.array([x[0] for x in out], pa.int64()),
                *[pa.array([x[k] for x in out], lists) for k in (1, 2, 3)],
            ],
            names=names,
        )

    return run


def _tenth_scores(carried: DataFrame) -> DataFrame:
    """[item, tenth]: the tenth-highest score so far of each item that has ten."""
    top = carried.select("item", F.explode(F.slice(F.sort_array("scores", False), 1, BEST)).alias("score"))
    turn = F.row_number().over(Window.partitionBy("item").orderBy(F.desc("score")))
    return top.withColumn("turn", turn).where(F.col("turn") <= BEST).where(F.col("turn") == BEST).select(
        "item", F.col("score").alias("tenth")
    )


def _ranked_block(docs: DataFrame, asked: DataFrame) -> DataFrame:
    """[item, doc_id, row, score]: the best documents of every slice for the items of ``asked``."""
    spark = docs.sparkSession
    vocabulary = sorted(r["term"] for r in asked.select("term").distinct().collect())  # at most MOST_TERMS and one item's
    rows = stored(counted_documents(docs, vocabulary), "counted")
    n_rows, n_docs, n_words, n_postings = rows.agg(
        F.count(F.lit(1)), F.count_if(F.col("n") > 0), F.sum("n"), F.sum(F.size("terms"))
    ).first()
    if not n_docs:
        return spark.createDataFrame([], "item long, doc_id long, row long, score long")
    rows = rows.withColumn("m", F.expr(f"25L + (75L * n * {n_docs}L) div {n_words}L"))
    weights = stored(term_weights(rows, n_docs), "weights")
    owners = np.zeros(len(vocabulary), np.int8)
    for r in weights.select("term", "owner").collect():  # the block's terms again
        owners[r["term"]] = r["owner"]
    slices = max(-(-n_rows // SLICE), -(-n_postings // SLICE_POSTINGS), 1)
    postings = stored(
        owned_postings(rows, owners).withColumn("slice", F.pmod(F.xxhash64("row"), F.lit(slices)).cast("int")), "postings"
    )
    numbered = spark.createDataFrame(list(enumerate(vocabulary)), "number int, name string")
    named = weights.join(numbered, weights["term"] == F.col("number")).select("name", F.col("term").alias("number"), "w", "most", "owner")
    own = stored(
        asked.join(named, asked["term"] == F.col("name")).select(
            "item", "bundle", "owner", "number", (F.col("q") * F.col("w")).alias("weight"), (F.col("q") * F.col("most")).alias("most")
        ),
        "own_terms",
    )
    bundles = asked.agg(F.min("bundle"), F.max("bundle")).first()
    every = F.explode(F.sequence(F.lit(0), F.lit(slices - 1))).alias("slice")
    carried = spark.createDataFrame([], _CARRIED)
    for owner in range(len(OWNER_SHARES) + 1):
        last = owner == len(OWNER_SHARES)
        mine = F.col("owner") == owner
        after = F.coalesce(F.sum(F.when(F.col("owner") > owner, F.col("most"))), F.lit(0))
        pairs = F.sort_array(F.collect_list(F.when(mine, F.struct("number", "weight"))))
        stage = own.groupBy("bundle", "item").agg(pairs.alias("p"), after.alias("after"))
        need = F.greatest(F.coalesce("tenth", F.lit(0)) - F.col("after"), F.lit(0)).alias("need")
        stage = stage.join(_tenth_scores(carried), "item", "left").select(
            "bundle", "item", need, F.col("p.number").alias("terms"), F.col("p.weight").alias("weights")
        )
        stage = stored(stage, f"stage{owner}")
        left = stage.select("*", every).unionByName(carried, allowMissingColumns=True)
        right = postings.where(mine).select(
            "slice", "row", "doc_id", "m", "terms", "tfs",
            F.explode(F.sequence(F.lit(bundles[0]), F.lit(bundles[1]))).alias("bundle"),
        )
        met = left.groupBy("bundle", "slice").cogroup(right.groupBy("bundle", "slice"))
        carried = stored(met.applyInArrow(add_contributions(last), _CARRIED), f"carried{owner}")
    each = carried.select("item", F.explode(F.arrays_zip("rows", "doc_ids", "scores")).alias("d"))
    return each.select("item", F.col("d.doc_ids").alias("doc_id"), F.col("d.rows").alias("row"), F.col("d.scores").alias("score"))


def ranked(docs: DataFrame, items: DataFrame) -> DataFrame:
    """[item_id, rank, doc_id, score]: the ``BEST`` documents of ``docs`` [doc_id, text] for each of ``items`` [item_id, text]."""
    asked = item_terms(items)
    blocks = asked.agg(F.max("block")).first()[0]
    if blocks is None:
        return docs.sparkSession.createDataFrame([], _RESULT)
    found = _ranked_block(docs, asked.where("block = 0"))
    for block in range(1, blocks + 1):
        found = found.unionByName(_ranked_block(docs, asked.where(F.col("block") == block)))
    order = Window.partitionBy("item").orderBy(F.desc("score"), F.col("doc_id").asc_nulls_last(), "row")
    best = found.withColumn("rank", F.row_number().over(order)).where(F.col("rank") <= BEST)
    names = asked.select("item", "item_id").distinct()
    return best.join(names, "item").select("item_id", "rank", "doc_id", "score")
