"""Commit log: outputs of a batch become visible together, once, whatever fails in between.

Every attempt at a batch writes its outputs to folders of its own. When all are there, one entry names
them; what no entry names does not exist for readers. A batch that is tried again after its entry was written
is passed over, one that failed before it is written anew, so no reader sees a row twice or a half batch.
"""

from __future__ import annotations

import uuid
from collections.abc import Mapping

from pyspark.errors import AnalysisException
from pyspark.sql import DataFrame, SparkSession
from pyspark.sql import functions as F
from pyspark.sql import types as T

ENTRY = T.StructType(
    [
        T.StructField("output", T.StringType()),
        T.StructField("path", T.StringType()),
        T.StructField("batch_id", T.LongType()),
    ]
)


class CommitLog:
    """The committed outputs below a root folder that all executors reach."""

    def __init__(self, spark: SparkSession, root: str):
        self.spark = spark
        self.root = root.rstrip("/")

    @property
    def folder(self) -> str:
        return f"{self.root}/commits"

    def _read(self, path: str) -> DataFrame | None:
        try:
            return self.spark.read.schema(ENTRY).option("basePath", self.folder).json(path)
        except AnalysisException as missing:
            if missing.getCondition() != "PATH_NOT_FOUND":
                raise
            return None

    def entries(self) -> DataFrame:
        """[output, path, batch_id] of all committed outputs; paths are below the root."""
        known = self._read(self.folder)
        return self.spark.createDataFrame([], ENTRY) if known is None else known

    def is_committed(self, batch_id: int) -> bool:
        """Only the entry of this batch is looked at, however many there are."""
        known = self._read(f"{self.folder}/batch_id={batch_id}")
        return known is not None and not known.isEmpty()

    def stage(self, output: str, rows: DataFrame, batch_id: int) -> tuple[str, DataFrame]:
        """Write rows to a fresh folder; its path below the root, and the rows read back."""
        path = f"{output}/{batch_id:012d}-{uuid.uuid4().hex}"
        rows.write.parquet(f"{self.root}/{path}")
        return path, self.spark.read.schema(rows.schema).parquet(f"{self.root}/{path}")

    def commit(self, batch_id: int, staged: Mapping[str, str]) -> None:
        """Name the staged outputs of a batch in one file, which appears by a rename."""
        entry = self.spark.createDataFrame(sorted(staged.items()), "output string, path string")
        entry.coalesce(1).write.mode("append").json(f"{self.folder}/batch_id={batch_id}")

    def publish(self, batch_id: int, outputs: Mapping[str, DataFrame]) -> None:
        """Stage and commit the outputs, unless the batch is there already."""
        if not self.is_committed(batch_id):
            self.commit(batch_id, {name: self.stage(name, rows, batch_id)[0] for name, rows in outputs.items()})

    def paths(self, output: str, after: int = -1) -> list[str]:
        """Folders of one output, by batch, of batches later than ``after``: one for each batch."""
        chosen = self.entries().where((F.col("output") == output) & (F.col("batch_id") > after)).orderBy("batch_id")
        return [f"{self.root}/{row['path']}" for row in chosen.select("path").collect()]

    def read(self, output: str, schema: T.StructType, after: int = -1) -> DataFrame:
        """All committed rows of one output."""
        paths = self.paths(output, after)
        return self.spark.read.schema(schema).parquet(*paths) if paths else self.spark.createDataFrame([], schema)

    def newest(self, output: str) -> int | None:
        """The last batch that committed this output."""
        return self.entries().where(F.col("output") == output).agg(F.max("batch_id")).first()[0]
