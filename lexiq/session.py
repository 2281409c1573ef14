"""Session helpers: local session for tests/bench, shared scratch folder, bounded broadcast."""

from __future__ import annotations

import tempfile
import uuid

from pyspark.sql import DataFrame, SparkSession
from pyspark.sql import functions as F
from pyspark.sql.types import ArrayType, StringType


def scratch_root(spark: SparkSession) -> str:
    """Shared folder for materialized tables: the session's ``spark.checkpoint.dir``.

    A cluster names a shared folder there; only when it is unset (local tests) do we
    choose one under the system temp directory and record it on the session.
    """
    conf = spark.conf.get("spark.checkpoint.dir", None)
    if not conf:
        conf = spark.sparkContext.getCheckpointDir()
    if not conf:
        if not spark.sparkContext.master.startswith("local"):
            # a machine-local folder would not survive the loss of an executor
            raise RuntimeError("set spark.checkpoint.dir to a folder shared by the cluster")
        conf = tempfile.mkdtemp(prefix="lexiq-ckpt-")
        spark.conf.set("spark.checkpoint.dir", conf)
    if spark.sparkContext.getCheckpointDir() is None:
        spark.sparkContext.setCheckpointDir(conf)
    return conf.rstrip("/")


def new_table_path(spark: SparkSession, kind: str) -> str:
    return f"{scratch_root(spark)}/{kind}-{uuid.uuid4().hex[:12]}"


def materialize(df: DataFrame) -> DataFrame:
    """Cut lineage of a small intermediate by a reliable checkpoint in the shared folder."""
    scratch_root(df.sparkSession)
    return df.checkpoint(eager=True)


def stored(df: DataFrame, kind: str) -> DataFrame:
    """Write a small table into the shared folder and read it back, so that its size is known."""
    path = new_table_path(df.sparkSession, kind)
    df.coalesce(df.sparkSession.sparkContext.defaultParallelism).write.parquet(path)
    return df.sparkSession.read.schema(df.schema).parquet(path)


#: What a broadcast table may hold, in bytes of its values.
BROADCAST_BYTES = 64 << 20


def bounded_broadcast(df: DataFrame, max_rows: int = 2_000_000) -> DataFrame:
    """Broadcast ``df`` only after proving its size: its rows are counted and the bytes of their values
    summed, and compared with ``max_rows`` and ``BROADCAST_BYTES``.

    Beyond the bounds the plain DataFrame is returned and the planner falls back to a
    shuffle join (with AQE skew handling).
    """
    width = F.lit(0)
    for f in df.schema.fields:
        c = F.col(f"`{f.name}`")
        width = width + (F.coalesce(F.octet_length(c), F.lit(0)) if isinstance(f.dataType, StringType)
                         else 8 * F.greatest(F.coalesce(F.size(c), F.lit(0)), F.lit(1)) if isinstance(f.dataType, ArrayType)
                         else F.lit(8))
    seen = df.agg(F.count(F.lit(1)).alias("n"), F.sum(width).alias("bytes")).first()
    small = seen["n"] <= max_rows and (seen["bytes"] or 0) <= BROADCAST_BYTES
    return F.broadcast(df) if small else df


def spread(df: DataFrame) -> DataFrame:
    """Round-robin the rows over the cluster's cores when the scan yields fewer partitions
    than cores (e.g. one large row group); CPU-heavy tokenization then uses every core.
    With many input files (the normal case at scale) this is a no-op."""
    target = df.sparkSession.sparkContext.defaultParallelism
    return df.repartition(target) if df.rdd.getNumPartitions() < target else df


def modified_at(spark: SparkSession, path: str) -> int | None:
    """When the newest file below ``path`` was written, by the file system that Spark reads; None if
    there is no such path."""
    if not path_exists(spark, path):
        return None
    p = spark._jvm.org.apache.hadoop.fs.Path(path)
    fs = p.getFileSystem(spark._jsc.hadoopConfiguration())
    return max([fs.getFileStatus(p).getModificationTime()] + [s.getModificationTime() for s in fs.listStatus(p)])


def path_exists(spark: SparkSession, path: str) -> bool:
    jvm = spark._jvm
    p = jvm.org.apache.hadoop.fs.Path(path)
    fs = p.getFileSystem(spark._jsc.hadoopConfiguration())
    return bool(fs.exists(p))


def is_folder(spark: SparkSession, path: str) -> bool:
    p = spark._jvm.org.apache.hadoop.fs.Path(path)
    fs = p.getFileSystem(spark._jsc.hadoopConfiguration())
    return bool(fs.getFileStatus(p).isDirectory())
