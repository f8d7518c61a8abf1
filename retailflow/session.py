"""Session settings, shared scratch space and lineage cuts."""

from __future__ import annotations

import tempfile
import uuid

from pyspark.sql import DataFrame, SparkSession
from pyspark.sql import functions as F

#: Buckets that are written at once, where these are not more than ``MOST_PASSES`` parts of all.
BUCKETS_A_PASS = 200
MOST_PASSES = 8

RUNTIME_SETTINGS = {
    "spark.sql.session.timeZone": "UTC",
    "spark.sql.adaptive.enabled": "true",
    "spark.sql.adaptive.coalescePartitions.enabled": "true",
    "spark.sql.adaptive.skewJoin.enabled": "true",
    # Small shuffled rows are several times as large in a task's memory.
    "spark.sql.adaptive.advisoryPartitionSizeInBytes": "16m",
    "spark.sql.autoBroadcastJoinThreshold": str(4 * 1024 * 1024),
    # A packed file of 1,200,000 serving rows stayed below 4 MB after pruning and took 144 in the driver that broadcast it.
    "spark.sql.sources.fileCompressionFactor": "30",
    "spark.sql.execution.arrow.pyspark.enabled": "true",
    # Shuffled rows leave the disks with the action that made them, not when the driver next collects garbage.
    "spark.sql.classic.shuffleDependency.fileCleanup.enabled": "true",
    "spark.sql.streaming.stateStore.providerClass": (
        "org.apache.spark.sql.execution.streaming.state.RocksDBStateStoreProvider"
    ),
}


def build_session(app_name: str = "retailflow", master: str | None = None, **extra: str) -> SparkSession:
    """A session with the settings the operators rely on; cluster sizes stay with spark-submit."""
    builder = SparkSession.builder.appName(app_name)
    if master:
        builder = builder.master(master)
    for key, value in {**RUNTIME_SETTINGS, **extra}.items():
        builder = builder.config(key, value)
    return (
        builder.config("spark.cleaner.referenceTracking.cleanCheckpoints", "true")
        .config("spark.python.unix.domain.socket.enabled", "true")
        .getOrCreate()
    )


def prepare(spark: SparkSession) -> SparkSession:
    """Apply the runtime settings to a session somebody else made."""
    for key, value in RUNTIME_SETTINGS.items():
        spark.conf.set(key, value)
    return spark


def shared_dir(spark: SparkSession) -> str:
    """The folder every executor can reach, as ``spark.checkpoint.dir`` names it.

    Only where driver and executors are one process may the folder be made here; on a cluster a
    missing setting is an error, since executors would not see a folder of the driver's machine.
    """
    sc = spark.sparkContext
    named = spark.conf.get("spark.checkpoint.dir", None) or sc.getCheckpointDir()
    if not named:
        if not sc.master.startswith("local") or sc.master.startswith("local-cluster"):
            raise ValueError("set spark.checkpoint.dir to a folder that the driver and all executors share")
        named = tempfile.mkdtemp(prefix="retailflow-")
    if not sc.getCheckpointDir():
        sc.setCheckpointDir(named)
    return named


def scratch(spark: SparkSession, name: str) -> str:
    """A fresh path below the shared folder."""
    return f"{shared_dir(spark).rstrip('/')}/{name}-{uuid.uuid4().hex}"


def written(df: DataFrame, name: str) -> DataFrame:
    """The rows written once as Parquet below the shared folder and read back, with their true size."""
    path = scratch(df.sparkSession, name)
    df.write.option("compression", "zstd").parquet(path)
    found = df.sparkSession.read.schema(df.schema).parquet(path)
    found.written_at = path
    return found


def dropped(*tables: DataFrame) -> None:
    """Delete the files of ``written`` tables that nothing reads any more; frames over them must not be used again."""
    for table in tables:
        spark = table.sparkSession
        path = spark._jvm.org.apache.hadoop.fs.Path(table.written_at)
        path.getFileSystem(spark._jsparkSession.sessionState().newHadoopConf()).delete(path, True)


def bucketed(df: DataFrame, name: str, buckets: int, *keys: str) -> DataFrame:
    """The rows written once, one file for each bucket of the keys: joins by these keys read them without a shuffle."""
    table = f"{name}_{uuid.uuid4().hex}"
    path = scratch(df.sparkSession, name)
    # Buckets are written in passes of a part of them, so that only a part of the rows is on its way at once.
    bucket, parts = F.pmod(F.hash(*keys), F.lit(buckets)), min(MOST_PASSES, -(-buckets // BUCKETS_A_PASS))
    for k in range(parts):
        dealt = df.where(bucket % parts == k) if parts > 1 else df
        dealt = dealt.repartition(buckets, *keys).write.format("parquet").option("compression", "zstd").bucketBy(buckets, *keys)
        dealt.option("path", path).mode("append").saveAsTable(table)
    found = df.sparkSession.table(table)
    found.written_at = path
    return found


def cut_lineage(df: DataFrame) -> DataFrame:
    """Reliable checkpoint: survives executor loss and fixes the value of an iteration."""
    shared_dir(df.sparkSession)
    return df.checkpoint(eager=True)
