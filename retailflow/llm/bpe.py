"""Byte-level BPE encoding and decoding by a sentencepiece model made from a rank file.

The rank file lists byte strings with ranks. Each byte string becomes a piece whose characters stand
for its bytes, and its score is the negative rank, so the merge that sentencepiece prefers is the
merge of the lowest rank. Normalisation is the identity. The model is written as the protocol-buffer
message that sentencepiece loads; nothing is trained. Text is split into pre-tokens first, each is
encoded alone, and ids are decoded by the inverse mapping from id to bytes.

Nulls are empty texts; an empty text has no tokens. Text of any length is encoded whole, and equal
texts give equal ids. Lone surrogates cannot occur: Spark strings are UTF-8.
"""

from __future__ import annotations

import base64
import re
import struct
from collections.abc import Iterator
from functools import lru_cache
from itertools import chain

import regex
import sentencepiece
from pyspark.sql import DataFrame
from pyspark.sql import functions as F
from pyspark.sql import types as T

from retailflow.llm.common import map_rows, sha256_hex

# Fixed values of the sentencepiece model format: field numbers and enumeration values.
PIECES, TRAINER_SPEC, NORMALIZER_SPEC = 1, 2, 3
PIECE_TEXT, PIECE_SCORE, PIECE_TYPE = 1, 2, 3
NORMAL, UNKNOWN = 1, 2
TRAINER_MODEL_TYPE, TRAINER_VOCAB_SIZE, TRAINER_UNK_ID = 3, 4, 40
TRAINER_BOS_ID, TRAINER_EOS_ID, TRAINER_PAD_ID = 41, 42, 43
MODEL_TYPE_BPE = 2
NORMALIZER_NAME, NORMALIZER_DUMMY_PREFIX, NORMALIZER_EXTRA_SPACES, NORMALIZER_ESCAPE_SPACES = 1, 3, 4, 5
NO_ID = (1 << 64) - 1  # -1 as a varint

#: First of the 256 code points that stand for bytes; letters, and never the blank of sentencepiece.
BYTE_BASE = 0x0100
#: Pieces whose ids a worker remembers; the memory is emptied when it is full.
REMEMBERED = 200_000


def read_ranks(path: str) -> list[bytes]:
    """Byte strings in order of rank, which must run from 0 without gaps."""
    pairs = []
    with open(path, "rb") as lines:
        for line in lines:
            if line.strip():
                token, rank = line.split()
                pairs.append((int(rank), base64.b64decode(token)))
    pairs.sort()
    if [rank for rank, _ in pairs] != list(range(len(pairs))):
        raise ValueError("ranks must run from 0 without gaps")
    return [token for _, token in pairs]


def as_characters(data: bytes) -> str:
    """One character for each byte."""
    return data.decode("latin-1").translate(_BYTE_CHARACTERS)


_BYTE_CHARACTERS = {b: chr(BYTE_BASE + b) for b in range(256)}


def _varint(n: int) -> bytes:
    out = bytearray()
    while n > 127:
        out.append(n & 127 | 128)
        n >>= 7
    out.append(n)
    return bytes(out)


def _number(field: int, value: int) -> bytes:
    return _varint(field << 3) + _varint(value)


def _bytes(field: int, value: bytes) -> bytes:
    return _varint(field << 3 | 2) + _varint(len(value)) + value


def _piece(text: str, score: float, kind: int) -> bytes:
    score_field = _varint(PIECE_SCORE << 3 | 5) + struct.pack("<f", score)
    return _bytes(PIECES, _bytes(PIECE_TEXT, text.encode()) + score_field + _number(PIECE_TYPE, kind))


def serialise_model(tokens: list[bytes]) -> bytes:
    """The sentencepiece model of the rank list; piece ids are ranks, the unknown piece comes last."""
    unknown = len(tokens)
    pieces = [_piece(as_characters(token), -float(rank), NORMAL) for rank, token in enumerate(tokens)]
    pieces.append(_piece("<unk>", 0.0, UNKNOWN))
    trainer = (
        _number(TRAINER_MODEL_TYPE, MODEL_TYPE_BPE)
        + _number(TRAINER_VOCAB_SIZE, unknown + 1)
        + _number(TRAINER_UNK_ID, unknown)
        + b"".join(_number(field, NO_ID) for field in (TRAINER_BOS_ID, TRAINER_EOS_ID, TRAINER_PAD_ID))
    )
    normalizer = _bytes(NORMALIZER_NAME, b"identity") + b"".join(
        _number(field, 0) for field in (NORMALIZER_DUMMY_PREFIX, NORMALIZER_EXTRA_SPACES, NORMALIZER_ESCAPE_SPACES)
    )
    return b"".join(pieces) + _bytes(TRAINER_SPEC, trainer) + _bytes(NORMALIZER_SPEC, normalizer)


class ByteBpe:
    """Encoder and decoder of one rank file and pre-token pattern.

    No pre-token runs from a character other than white space into a blank, and none looks back. So
    a text may be cut before every blank that stands alone between two such characters, and the
    pieces are encoded apart, each once for as long as it is remembered. A pattern that does look
    back, or that keeps blanks at the end of a pre-token, needs ``cut=False``.
    """

    def __init__(self, path: str, pattern: str, cut: bool = True):
        self.tokens = read_ranks(path)
        self.whole = {token: rank for rank, token in enumerate(self.tokens)}
        self.model = sentencepiece.SentencePieceProcessor(model_proto=serialise_model(self.tokens))
        self.pre_tokens = regex.compile(pattern).findall
        self.cut = re.compile(r" (?<=\S )(?=\S)").split if cut else lambda text: [text]
        self.known: dict[str, tuple[int, ...]] = {}

    def encode(self, text: str) -> list[int]:
        return self.encode_all([text])[0]

    def encode_all(self, texts: list[str]) -> list[list[int]]:
        """Ids of each whole text, pre-token by pre-token; new pieces of all texts go to the model together."""
        cut = [self.cut(text) for text in texts]
        known = self.known
        if len(known) > REMEMBERED:
            known.clear()
        for pieces in cut:
            pieces[1:] = [" " + x for x in pieces[1:]]
        self._learn(list({x for pieces in cut for x in pieces if x not in known}))
        return [[*chain.from_iterable(map(known.__getitem__, pieces))] for pieces in cut]

    def _learn(self, pieces: list[str]) -> None:
        """Remember the ids of pieces; a pre-token that is a token as it stands is that token."""
        split = list(map(self.pre_tokens, pieces))
        whole = self.whole
        ids = {x: whole.get(x.encode()) for x in set(chain.from_iterable(split))}
        merged = [x for x, rank in ids.items() if rank is None]
        made = self.model.encode([as_characters(x.encode()) for x in merged], num_threads=1) if merged else []
        ids = {x: (rank,) for x, rank in ids.items()} | dict(zip(merged, made, strict=True))
        self.known.update((x, (*chain.from_iterable(map(ids.__getitem__, parts)),)) for x, parts in zip(pieces, split, strict=True))

    def decode(self, ids: list[int]) -> bytes:
        tokens = self.tokens
        return b"".join([tokens[i] for i in ids])


@lru_cache(maxsize=2)
def coder(path: str, pattern: str) -> ByteBpe:
    """The coder of this Python worker, made once."""
    return ByteBpe(path, pattern)


def encode_documents(docs: DataFrame, path: str, pattern: str, text: str = "text") -> DataFrame:
    """``docs`` with the token ids of ``text`` as ``ids`` and their count as ``n_tokens``."""

    def start():
        bpe = coder(path, pattern)

        return lambda texts: [(len(ids), ids) for ids in bpe.encode_all(texts)]

    keep = [c for c in docs.columns if c.lower() not in ("ids", "n_tokens")]
    return map_rows(docs, f"`{text}`", (("n_tokens", "long"), ("ids", "array<int>")), start, keep)


def decode_ids(rows: DataFrame, path: str, pattern: str, ids: str = "ids") -> DataFrame:
    """``rows`` with the bytes that ``ids`` stand for as ``decoded``; null ids give null bytes."""

    def run(frames: Iterator):
        bpe = coder(path, pattern)
        for frame in frames:
            frame["decoded"] = [None if x is None else bpe.decode(x) for x in frame[ids]]
            yield frame

    plain = rows.drop("decoded")
    return plain.mapInPandas(run, T.StructType([*plain.schema.fields, T.StructField("decoded", T.BinaryType())]))


def token_digests(docs: DataFrame, path: str, pattern: str) -> DataFrame:
    """[doc_id, n_tokens, ids_sha256, decoded_sha256]: ids and decoded bytes of every text, hashed.

    Both directions run in one pass over the rows, so the ids never leave the worker.
    """

    def start():
        bpe = coder(path, pattern)
        decimal = [str(i) for i in range(len(bpe.tokens))]

        def row(ids: list[int]) -> tuple:
            listed = " ".join([decimal[i] for i in ids])
            return len(ids), sha256_hex(listed.encode()), sha256_hex(bpe.decode(ids))

        return lambda texts: list(map(row, bpe.encode_all(texts)))

    fields = (("n_tokens", "long"), ("ids_sha256", "string"), ("decoded_sha256", "string"))
    return map_rows(docs.select(F.col("doc_id"), F.col("text")), "text", fields, start, ["doc_id"])
