"""Shared pieces: words, scratch tables, size-checked broadcasts and Arrow row mappers."""

from __future__ import annotations

import hashlib
from collections.abc import Callable, Iterable, Iterator

import pyarrow as pa
import pyarrow.compute as pc
from pyspark.sql import Column, DataFrame, SparkSession
from pyspark.sql import functions as F
from pyspark.sql import types as T
from pyspark.sql.pandas.types import to_arrow_schema

from retailflow.session import RUNTIME_SETTINGS, written

#: Fixed value: a word is a run of characters other than the six ASCII blanks.
WORD = r"[^\x20\x09-\x0D]+"

SHUFFLE_CLEANUP = "spark.sql.classic.shuffleDependency.fileCleanup.enabled"

#: Parts of a table, at most, that steps work on one after the other to keep what they move off the disks.
MOST_PASSES = 6
#: Bytes of text that a text function gets at once.
CHUNK = 1_000_000
#: Rows that Spark hands to Python at once; texts can be long.
ROWS_AT_ONCE = 1_000


def table(spark: SparkSession, folder: str, name: str) -> DataFrame:
    """A table of the folder. The session then passes rows to Python in batches that hold few texts, and clears up its shuffles."""
    spark.conf.set("spark.sql.execution.arrow.maxRecordsPerBatch", str(ROWS_AT_ONCE))
    spark.conf.set(SHUFFLE_CLEANUP, RUNTIME_SETTINGS[SHUFFLE_CLEANUP])
    return spark.read.parquet(f"{folder.rstrip('/')}/{name}.parquet")


def word_count(text: Column) -> Column:
    """Words of a text; 0 for null."""
    return F.coalesce(F.regexp_count(text, F.lit(WORD)), F.lit(0)).cast("long")


def stored(df: DataFrame, name: str) -> DataFrame:
    """The rows written once to the shared folder and read back.

    The file cuts the lineage, survives lost executors and has a true size for the planner.
    """
    return written(df, name)


def broadcast_up_to(df: DataFrame, rows: int) -> DataFrame:
    """A broadcast hint where ``df`` was counted to have at most ``rows`` rows.

    Above that the frame is returned plain and Spark joins by shuffle, splitting hot keys.
    """
    return F.broadcast(df) if df.count() <= rows else df


def passes(rows: DataFrame, key: str, rows_a_pass: int) -> list[Column]:
    """Conditions on ``key`` that split rows into parts, to be worked on one after the other; the rows are counted."""
    n = min(MOST_PASSES, max(1, -(-rows.count() // rows_a_pass)))
    return [F.pmod(F.xxhash64(F.lit("pass"), F.col(key)), F.lit(n)) == k for k in range(n)]


def sha256_hex(data: bytes) -> str:
    return hashlib.sha256(data).hexdigest()


def _chunks(texts: pa.Array) -> Iterator[tuple[int, int]]:
    """Ranges of rows, in order, of at most ``CHUNK`` bytes of text or one row."""
    begin = held = 0
    for row, size in enumerate(pc.binary_length(texts).fill_null(0).to_pylist()):
        if row > begin and held + size > CHUNK:
            yield begin, row
            begin, held = row, 0
        held += size
    yield begin, len(texts)


def text_parts(batches: Iterable[pa.RecordBatch], column: str) -> Iterator[tuple[pa.RecordBatch, list[str | None]]]:
    """The rows of the batches in small parts, of ``CHUNK`` bytes of text or one text, with their texts."""
    for batch in batches:
        if batch.num_rows:
            texts = batch.column(batch.schema.get_field_index(column))
            for begin, end in _chunks(texts):
                yield batch.slice(begin, end - begin), texts.slice(begin, end - begin).to_pylist()


def map_rows(
    df: DataFrame,
    column: str,
    fields: tuple[tuple[str, str], ...],
    start: Callable[[], Callable[[list[str]], list[tuple]]],
    keep: Iterable[str],
) -> DataFrame:
    """``keep`` columns plus ``fields`` that a function makes of the text of each row.

    ``start`` runs once a task and returns the function, so a model or vocabulary is set up once. The
    function gets texts in small lists, of ``CHUNK`` bytes or one text, and returns a tuple for each; no
    more results than those of one list are held. Null texts reach it as empty ones. Rows stream through in Arrow batches; other columns are
    passed on untouched.
    """
    inputs = df.select(*[F.col(f"`{c}`") for c in keep], F.coalesce(F.col(column), F.lit("")).alias("__text"))
    made = T.StructType.fromDDL(", ".join(f"{name} {kind}" for name, kind in fields))
    schema = T.StructType([*inputs.schema.fields[:-1], *made.fields])
    made_arrow = to_arrow_schema(made)
    width = len(schema.fields) - len(fields)

    def run(batches: Iterator[pa.RecordBatch]) -> Iterator[pa.RecordBatch]:
        function = start()
        for part, texts in text_parts(batches, "__text"):
            columns = [pa.array(x, f.type) for x, f in zip(zip(*function(texts), strict=True), made_arrow, strict=True)]
            yield pa.RecordBatch.from_arrays([*part.columns[:width], *columns], [f.name for f in schema.fields])

    return inputs.mapInArrow(run, schema)
