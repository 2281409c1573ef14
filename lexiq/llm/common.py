"""Small helpers shared by the operators of this subpackage."""

from __future__ import annotations

from pyspark.sql import DataFrame, SparkSession
from pyspark.sql import functions as F

from ..session import new_table_path

#: A broadcast table of one or two numbers a row stays under 64 MB up to here.
SMALL_ROWS = 2_000_000
#: Bytes of an Arrow batch of whole texts, and of a row group of a stored table of them.
BATCH_BYTES, GROUP_BYTES = 8 << 20, 16 << 20


def lean(spark: SparkSession) -> None:
    """Let Spark hand whole texts to Python in batches of BATCH_BYTES at most, not by a number of rows:
    several batches of very long documents are held at once by a task and its worker."""
    key = "spark.sql.execution.arrow.maxBytesPerBatch"
    now = str(spark.conf.get(key, "67108864b")).rstrip("b")
    if not now.isdigit() or not 0 < int(now) <= BATCH_BYTES:
        spark.conf.set(key, str(BATCH_BYTES))


def documents(spark: SparkSession, sf_dir: str) -> DataFrame:
    lean(spark)
    return spark.read.parquet(f"{sf_dir}/documents.parquet")


def few(df: DataFrame, per_core: int = 2) -> DataFrame:
    """``df`` in at most ``per_core`` partitions per core of the cluster, without a shuffle."""
    return df.coalesce(per_core * df.sparkSession.sparkContext.defaultParallelism)


def stored(df: DataFrame, kind: str, per_core: int | None = 2) -> DataFrame:
    """Write ``df`` as Parquet into the shared folder and read it back: the lineage ends there, the
    table survives lost executors and the planner knows its true size.

    At most ``per_core`` files per core of the cluster are written, so that narrow tables do not
    become thousands of tiny files after a shuffle; None keeps the partitions (whole texts)."""
    spark, path = df.sparkSession, new_table_path(df.sparkSession, kind)
    (few(df, per_core) if per_core else df).write.option("parquet.block.size", GROUP_BYTES).parquet(path)
    return spark.read.schema(df.schema).parquet(path)


def small(df: DataFrame, max_rows: int = SMALL_ROWS) -> DataFrame:
    """Broadcast a stored table of fixed-width columns if its counted rows are few; else leave the
    join to a shuffle."""
    return F.broadcast(df) if df.count() <= max_rows else df


def without(df: DataFrame, names: list[str]) -> DataFrame:
    """Drop input columns that an operator is about to add itself (any case)."""
    taken = {n.lower() for n in names}
    return df.select(*[F.col(f"`{c}`") for c in df.columns if c.lower() not in taken])
