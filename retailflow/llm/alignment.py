"""Cross-tokenizer alignment with corpus-wide pair counts by external spill counting.

Two tokenizers cut the same bytes, a blank and the text: A is a byte-level BPE, B a sentencepiece model that
adds the blank itself. Byte offsets at which tokens of both end cut them into groups; the last tokens of a
group are linked. A text whose joined token bytes differ from its own under either tokenizer has no tokens.

A text may be cut before every blank that stands alone between two characters other than white space: no
pre-token of A runs across such a place, and no piece of B that holds one exists (this is checked when the
model is read; with other models texts stay whole). The pieces are tokenised and aligned once for as long
as a worker remembers them.

How often a pair of ids is linked in the whole corpus is counted outside memory. Records (pair, document,
times) are radix-partitioned by the id of B and sorted into runs of ``SPILL`` records, compressed by zstd.
The runs of a radix are dealt to as many slices as its size asks for, so a frequent id is spread over many
tasks, and the runs of a slice are merged by a k-way heap. The merged records come in order of B's id
(side-major), pair by pair: each pair's count is known when its records end. Slices' counts are summed, the
highest of each id of B is its maximum, and a second pass over the merged records streams the contributions
of each pair back to its documents: counts, and whether they are the maximum. A run holds neighbouring documents,
so one document has at most one partial sum for each radix.

Null and empty texts have no tokens: zeros, and an empty string for the groups. Texts of any length are taken
whole. Repeated rows each count and each get a row, whatever their ids. An empty table gives an empty table.
Further columns are not read.
"""

from __future__ import annotations

import heapq
import json
import os
import re
from collections import Counter
from collections.abc import Iterable, Iterator
from functools import lru_cache
from itertools import chain, groupby
from operator import itemgetter

import numpy as np
import pyarrow as pa
import zstandard
from pyspark.sql import DataFrame
from pyspark.sql import functions as F

from retailflow.llm.common import map_rows, sha256_hex, stored

# The blank of sentencepiece, and its pieces for single bytes.
BLANK = "▁"
BYTE_PIECE = re.compile(r"<0x([0-9A-F]{2})>")

RADIXES = 16
#: Records of a run, of a compressed block of it, and of a slice of runs that one task merges.
SPILL, BLOCK, SLICE = 1_000_000, 65_536, 4_000_000
#: Records of one id of B in one row.
ROW = 500_000
#: Pairs whose counts are broadcast, at most 16 bytes each.
FEW_PAIRS = 2_000_000
#: Pieces of text after which a worker starts to forget those that it has not seen since the last time.
REMEMBERED = 150_000
A_BITS = 16
#: Fixed value: the pre-token pattern of a byte-level vocabulary.
PRE_TOKEN = r"'s|'t|'re|'ve|'m|'ll|'d| ?\p{L}+| ?\p{N}+| ?[^\s\p{L}\p{N}]+|\s+(?!\S)|\s+"


def byte_characters() -> dict[str, int]:
    """The byte that each character of a byte-level vocabulary stands for: printable ones stand for themselves."""
    plain = [*range(0x21, 0x7F), *range(0xA1, 0xAD), *range(0xAE, 0x100)]
    others = [b for b in range(256) if b not in plain]
    return {chr(b): b for b in plain} | {chr(0x100 + k): b for k, b in enumerate(others)}


class Aligner:
    """Both tokenizers of a worker and the pieces it remembers.

    ``known`` has for each piece the numbers of tokens of A and B, the groups as text, and the links as
    numbers ``b << A_BITS | a``; None stands for a piece that does not come out as its own bytes. A
    vocabulary whose ids are the order of its merges is a list of ranks, and is encoded as such.
    """

    def __init__(self, path_a: str, path_b: str):
        os.environ["TOKENIZERS_PARALLELISM"] = "false"
        import sentencepiece

        of = byte_characters()
        with open(path_a, encoding="utf-8") as lines:
            read = json.load(lines)
        added = {x["id"] for x in read["added_tokens"]}
        vocabulary = {token: number for token, number in read["model"]["vocab"].items() if number not in added}
        self.a_bytes = {number: bytes(of[c] for c in token) for token, number in vocabulary.items()}
        self.encode_a = self._by_rank(read, vocabulary) or self._by_merges(path_a)
        self.b = sentencepiece.SentencePieceProcessor(model_file=path_b)
        pieces = [self.b.id_to_piece(k) for k in range(self.b.vocab_size())]
        self.b_bytes = [self._piece_bytes(p) for p in pieces]
        if max(max(self.a_bytes) >> A_BITS, len(pieces) >> 31 - A_BITS):
            raise ValueError("too many ids")
        self.a_length = {number: len(token) for number, token in self.a_bytes.items()}
        self.b_length = [len(p) for p in self.b_bytes]
        whole = any(re.search(f"[^{BLANK}]{BLANK}", p) for p in pieces)
        self.cut = (lambda text: [text]) if whole else re.compile(r" (?<=\S )(?=\S)").split
        self.known: dict[str, tuple[int, int, str, tuple[int, ...]] | None] = {}
        self.older: dict = {}

    def _by_rank(self, read: dict, vocabulary: dict[str, int]):
        """The encoder of a plain byte-level file whose ids are ranks; None for any other."""
        before, model = read["pre_tokenizer"] or {}, read["model"]
        merges = [m if isinstance(m, list) else m.split(" ") for m in model["merges"]]
        plain = before.get("type") == "ByteLevel" and before.get("use_regex") and not before.get("add_prefix_space")
        plain = plain and not read["normalizer"] and not model.get("dropout") and not model.get("ignore_merges")
        if not plain or any(vocabulary.get("".join(m)) != 256 + k for k, m in enumerate(merges)):
            return None
        import tiktoken

        ranks = {token: number for number, token in self.a_bytes.items()}
        return tiktoken.Encoding("a", pat_str=PRE_TOKEN, mergeable_ranks=ranks, special_tokens={}).encode_ordinary

    @staticmethod
    def _by_merges(path: str):
        from tokenizers import Tokenizer

        tokenizer = Tokenizer.from_file(path)
        tokenizer.encode_special_tokens = True
        return lambda text: tokenizer.encode(text, add_special_tokens=False).ids

    @staticmethod
    def _piece_bytes(piece: str) -> bytes:
        byte = BYTE_PIECE.fullmatch(piece)
        return bytes([int(byte[1], 16)]) if byte else piece.replace(BLANK, " ").encode()

    def _aligned(self, piece: str, a_ids: list[int], b_ids: list[int]):
        data = b" " + piece.encode()
        if b"".join([self.b_bytes[i] for i in b_ids]) != data or b"".join([self.a_bytes[i] for i in a_ids]) != data:
            return None
        a_length, b_length = self.a_length, self.b_length
        groups, links = [], []
        j = a_end = b_end = from_a = from_b = 0
        for i, a in enumerate(a_ids, 1):
            a_end += a_length[a]
            while b_end < a_end:
                b = b_ids[j]
                b_end += b_length[b]
                j += 1
            if a_end == b_end:
                if i - from_a == 1 and j - from_b == 1:
                    groups.append(f"{a}|{b}")
                else:
                    groups.append(f"{','.join(map(str, a_ids[from_a:i]))}|{','.join(map(str, b_ids[from_b:j]))}")
                links.append(b << A_BITS | a)
                from_a, from_b = i, j
        return len(a_ids), len(b_ids), ";".join(groups), tuple(links)

    def learn(self, pieces: set[str]) -> None:
        """Align the pieces that are not known."""
        known, older = self.known, self.older
        if len(known) > REMEMBERED:
            self.known, self.older = known, older = {}, known
        missing = []
        for p in pieces:
            if p not in known:
                if p in older:
                    known[p] = older[p]
                else:
                    missing.append(p)
        encode = self.encode_a
        for p, b_ids in zip(missing, self.b.encode(missing, num_threads=1) if missing else [], strict=True):
            known[p] = self._aligned(p, encode(" " + p), b_ids)

    def align(self, texts: list[str]) -> list[tuple]:
        """(n_a, n_b, n_groups, n_links, groups, pairs, times) of each text."""
        cut = [self.cut(text) if text else [] for text in texts]
        self.learn(set(chain.from_iterable(cut)))
        known = self.known
        return [self._row([known[p] for p in pieces]) for pieces in cut]

    @staticmethod
    def _row(parts: list) -> tuple:
        if not parts or None in parts:
            return 0, 0, 0, 0, "", [], []
        n_a, n_b, groups, links = zip(*parts, strict=True)
        pairs = Counter(chain.from_iterable(links))
        n = pairs.total()  # every group ends with one link
        return sum(n_a), sum(n_b), n, n, ";".join(groups), list(pairs), list(pairs.values())


@lru_cache(maxsize=1)
def aligner(path_a: str, path_b: str) -> Aligner:
    """The tokenizers of this Python worker, set up once."""
    return Aligner(path_a, path_b)


def aligned_documents(docs: DataFrame, path_a: str, path_b: str, groups: bool = False) -> DataFrame:
    """[doc_id, n_a, n_b, n_groups, n_links, groups_sha256, pairs, times, row] of every row of ``docs``.

    ``groups`` adds the groups themselves.
    """

    def start():
        align = aligner(path_a, path_b).align

        def described(texts: list[str]) -> list[tuple]:
            rows = align(texts)
            digests = [sha256_hex(r[4].encode()) if r[4] else "" for r in rows]
            return [(*r[:4], d, *r[5:], *([r[4]] if groups else [])) for r, d in zip(rows, digests, strict=True)]

        return described

    counts = [(name, "long") for name in ("n_a", "n_b", "n_groups", "n_links")]
    fields = (*counts, ("groups_sha256", "string"), ("pairs", "array<int>"), ("times", "array<int>"))
    fields += (("groups", "string"),) if groups else ()
    rows = map_rows(docs.select("doc_id", "text"), "text", fields, start, ["doc_id"])
    return rows.withColumn("row", F.monotonically_increasing_id())


def _packed(codes: np.ndarray, rows: np.ndarray, times: np.ndarray) -> bytes:
    """A block of records, row numbers as differences, compressed."""
    steps = np.diff(rows, prepend=0)
    return zstandard.compress(codes.astype("<i4").tobytes() + steps.astype("<i8").tobytes() + times.astype("<i4").tobytes(), 3)


def _unpacked(block: bytes) -> tuple[np.ndarray, np.ndarray, np.ndarray]:
    data = zstandard.decompress(block)
    n = len(data) // 16
    codes, steps = np.frombuffer(data, "<i4", n), np.frombuffer(data, "<i8", n, 4 * n)
    return codes, np.cumsum(steps), np.frombuffer(data, "<i4", n, 12 * n)


def spilled_runs(aligned: DataFrame) -> DataFrame:
    """[radix, run, block, n, data]: sorted runs of the records of ``aligned``, in compressed blocks."""
    names = ["radix", "run", "block", "n", "data"]

    def spill(parts: list[tuple]) -> Iterator[pa.RecordBatch]:
        codes, rows, times = (np.concatenate(x) for x in zip(*parts, strict=True))
        if not len(codes):
            return
        run, radix = int(rows[0]), (codes >> A_BITS) % RADIXES
        order = np.argsort(radix.astype(np.int64) << 32 | codes, kind="stable")  # rows ascend already
        codes, rows, times, radix = codes[order], rows[order], times[order], radix[order]
        edges = np.searchsorted(radix, np.arange(RADIXES + 1))
        for k in range(RADIXES):
            for block, low in enumerate(range(edges[k], edges[k + 1], BLOCK)):
                part = slice(low, min(low + BLOCK, edges[k + 1]))
                values = [k, run, block, part.stop - low, _packed(codes[part], rows[part], times[part])]
                types = [pa.int32(), pa.int64(), pa.int32(), pa.int64(), pa.binary()]
                yield pa.RecordBatch.from_arrays([pa.array([v], t) for v, t in zip(values, types, strict=True)], names)

    def run(batches: Iterator[pa.RecordBatch]) -> Iterator[pa.RecordBatch]:
        held, size = [], 0
        for whole in batches:
            for low in range(0, whole.num_rows, 1_000):
                batch = whole.slice(low, 1_000)
                pairs, times = batch.column(1), batch.column(2)
                lengths = np.diff(pairs.offsets.to_numpy())
                rows = np.repeat(batch.column(0).to_numpy(zero_copy_only=False), lengths)
                codes, counts = (x.flatten().to_numpy(zero_copy_only=False) for x in (pairs, times))
                held.append((codes, rows, counts))
                size += len(rows)
                if size >= SPILL:
                    yield from spill(held)
                    held, size = [], 0
        if held:
            yield from spill(held)

    rows = aligned.where(F.size("pairs") > 0).select("row", "pairs", "times")
    return rows.mapInArrow(run, "radix int, run long, block int, n long, data binary")


def _records(blocks: Iterable[bytes]) -> Iterator[tuple[int, np.ndarray, np.ndarray]]:
    """(pair, rows, times) of one run, ascending; one block is unpacked at a time."""
    for block in blocks:
        codes, rows, times = _unpacked(block)
        edges = np.flatnonzero(np.diff(codes, prepend=-1, append=-1))
        for a, b in zip(edges, edges[1:]):
            yield int(codes[a]), rows[a:b], times[a:b]


def merged(runs: list[list[bytes]]) -> Iterator[tuple[int, list[int], list[int], list[int], bytes]]:
    """(b, its a's, their counts, numbers of records, records) by k-way heap merge, in order of b."""
    by_pair = groupby(heapq.merge(*map(_records, runs), key=itemgetter(0)), key=itemgetter(0))
    for b, pairs in groupby(((code, list(parts)) for code, parts in by_pair), key=lambda x: x[0] >> A_BITS):
        others, counts, lengths, rows, times = [], [], [], [], []
        for code, parts in pairs:
            others.append(code & (1 << A_BITS) - 1)
            rows += [p[1] for p in parts]
            times += [p[2] for p in parts]
            lengths.append(sum(len(p[1]) for p in parts))
            counts.append(int(sum(p[2].sum(dtype=np.int64) for p in parts)))
            if sum(lengths) >= ROW:
                yield b, others, counts, lengths, _records_packed(rows, times)
                others, counts, lengths, rows, times = [], [], [], [], []
        if others:
            yield b, others, counts, lengths, _records_packed(rows, times)


def _records_packed(rows: list[np.ndarray], times: list[np.ndarray]) -> bytes:
    every = np.concatenate(rows)
    return _packed(np.zeros(len(every), np.int32), every, np.concatenate(times))


def merged_records(runs: DataFrame) -> DataFrame:
    """[b, others, counts, lengths, data] from stored ``runs``: counts are those of one slice."""
    sizes = runs.groupBy("radix").agg(F.ceil(F.sum("n") / SLICE).cast("int").alias("slices"))  # RADIXES rows
    dealt = runs.join(F.broadcast(sizes), "radix").withColumn("slice", F.pmod(F.xxhash64("run"), F.col("slices")).cast("int"))
    ordered = dealt.repartition("radix", "slice").sortWithinPartitions("radix", "slice", "run", "block")
    schema = "b int, others array<int>, counts array<long>, lengths array<int>, data binary"

    def rows_of(batches: Iterator[pa.RecordBatch]) -> Iterator[tuple]:
        for batch in batches:
            yield from zip(*(c.to_pylist() for c in batch.columns), strict=True)

    def run(batches: Iterator[pa.RecordBatch]) -> Iterator[pa.RecordBatch]:
        types = [pa.int32(), pa.list_(pa.int32()), pa.list_(pa.int64()), pa.list_(pa.int32()), pa.binary()]
        names = ["b", "others", "counts", "lengths", "data"]
        for _, group in groupby(rows_of(batches), key=itemgetter(0, 1)):
            held = [[x[3] for x in blocks] for _, blocks in groupby(group, key=itemgetter(2))]
            rows, size = [], 0
            for row in merged(held):
                rows.append(row)
                size += sum(row[3])
                if size >= ROW or len(rows) >= 1_000:
                    yield pa.RecordBatch.from_arrays([pa.array(v, t) for v, t in zip(zip(*rows), types, strict=True)], names)
                    rows, size = [], 0
            if rows:
                yield pa.RecordBatch.from_arrays([pa.array(v, t) for v, t in zip(zip(*rows), types, strict=True)], names)

    return ordered.select("radix", "slice", "run", "data").mapInArrow(run, schema)


def pair_counts(records: DataFrame) -> DataFrame:
    """[b, a, n, best] of every linked pair of ids; ``best`` is the highest ``n`` of the same ``b``."""
    each = records.select("b", F.explode(F.arrays_zip("others", "counts")).alias("p"))
    counted = each.groupBy("b", F.col("p.others").alias("a")).agg(F.sum("p.counts").alias("n"))
    return counted.join(counted.groupBy("b").agg(F.max("n").alias("best")), "b")


def contributions(records: DataFrame, counts: DataFrame) -> DataFrame:
    """[row, n_best, count_sum] of every document with links."""
    by_b = counts.groupBy("b").agg(
        F.sort_array(F.collect_list(F.struct("a", "n"))).alias("pairs"), F.first("best").alias("best")
    )  # an id of B has at most as many pairs as A has ids
    by_b = stored(by_b.select("b", F.col("pairs.a").alias("a"), F.col("pairs.n").alias("n"), "best"), "by_b")
    few = (by_b.agg(F.sum(F.size("a"))).first()[0] or 0) <= FEW_PAIRS
    joined = records.join(F.broadcast(by_b) if few else by_b, "b").select("others", "lengths", "data", "a", "n", "best")

    names = ["row", "n_best", "count_sum"]

    def summed(parts: list[tuple]) -> tuple:
        """One row a document of all parts."""
        rows, *values = (np.concatenate(x) for x in zip(*parts, strict=True))
        own, place = np.unique(rows, return_inverse=True)
        sums = [np.zeros(len(own), np.int64) for _ in values]
        for out, each in zip(sums, values, strict=True):
            np.add.at(out, place, each)
        return own, *sums

    def run(batches: Iterator[pa.RecordBatch]) -> Iterator[pa.RecordBatch]:
        held, size = [], 0
        for batch in batches:
            columns = [batch.column(k) for k in range(6)]
            for others, lengths, data, a, n, best in zip(*columns, strict=True):
                _, rows, times = _unpacked(data.as_buffer().to_pybytes())
                own = np.searchsorted(a.values.to_numpy(), others.values.to_numpy())
                count = n.values.to_numpy()[own]
                each = np.repeat(count, lengths.values.to_numpy())
                held.append((rows, np.where(each == best.as_py(), times, 0).astype(np.int64), each * times))
                size += len(rows)
                if size >= SPILL:
                    # Neighbouring documents fill a slice, so their sums stay while its records pass by.
                    held = [summed(held)]
                    size = len(held[0][0])
                    if size >= SPILL // 2:
                        yield pa.RecordBatch.from_arrays(list(map(pa.array, held[0])), names)
                        held, size = [], 0
        if held:
            yield pa.RecordBatch.from_arrays(list(map(pa.array, summed(held))), names)

    partial = joined.mapInArrow(run, "row long, n_best long, count_sum long")
    return partial.groupBy("row").agg(F.sum("n_best").alias("n_best"), F.sum("count_sum").alias("count_sum"))


def alignment_report(docs: DataFrame, path_a: str, path_b: str) -> DataFrame:
    """[doc_id, n_a, n_b, n_groups, n_links, n_best, count_sum, groups_sha256] of every row of ``docs`` [doc_id, text]."""
    aligned = stored(aligned_documents(docs, path_a, path_b), "aligned")
    records = stored(merged_records(stored(spilled_runs(aligned), "runs")), "merged")
    sums = contributions(records, stored(pair_counts(records), "pairs"))
    zero = F.lit(0).cast("long")
    return aligned.join(stored(sums, "sums"), "row", "left").select(
        "doc_id", "n_a", "n_b", "n_groups", "n_links",
        F.coalesce("n_best", zero).alias("n_best"), F.coalesce("count_sum", zero).alias("count_sum"), "groups_sha256",
    )
