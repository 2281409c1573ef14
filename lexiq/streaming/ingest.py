"""Continuous ingest (M7): a Structured Streaming source of changes drives versioned commits.

Each micro-batch becomes one commit, applied through ``foreachBatch``; the commit log records the
stream and its batch number, so a replayed batch (after a failure) is skipped and a second stream
into the same index is not. Batch numbers belong to a checkpoint, which therefore names the stream.

Change rows may carry ``op`` ('add' / 'delete'), ``field`` and ``term`` for deletes. With a key
field and a time column, changes are resolved by time: of the changes of one key in a batch the
last one counts (a delete before an add at the same time), it replaces the key's document, and a
change that is not later than the last known change of its key is dropped. A change without a time is
older than any other: it counts only while nothing else is known of its key.
"""

from __future__ import annotations

from typing import Callable

from pyspark.sql import DataFrame, SparkSession, Window
from pyspark.sql import functions as F

from ..operators.maintain import VersionedIndex
from ..session import is_folder, new_table_path, stored


def _resolved(vindex: VersionedIndex, batch: DataFrame, key: str, time: str) -> DataFrame:
    """The last change of every key that is later than what the index knows of it."""
    if "op" not in batch.columns:
        batch = batch.withColumn("op", F.lit("add"))
    last = Window.partitionBy(key).orderBy(F.col(time).desc_nulls_last(), F.col("op"))
    rows = stored(batch.withColumn("_nth", F.row_number().over(last)).filter("_nth = 1").drop("_nth"), "batch")
    known = vindex.last_changes(rows.select(F.col(key).cast("string").alias("key")))
    if known is not None:
        known = known.select(F.col("key").alias("_key"), F.col("ts").alias("_ts"))
        rows = (rows.join(known, F.col(key).cast("string") == F.col("_key"), "left")
                .filter(F.col("_key").isNull() | (F.col(time).isNotNull() & (F.col("_ts").isNull() | (F.col(time) > F.col("_ts")))))
                .drop("_key", "_ts"))
    return stored(rows, "changes")


def apply_batch(vindex: VersionedIndex, to_adds: Callable[[DataFrame], DataFrame] | None = None,
                stream_id: str = "", key_field: str | None = None, time: str | None = None):
    def run(batch: DataFrame, batch_id: int) -> None:
        if vindex.has_batch(batch_id, stream_id):
            return
        changes = None
        if key_field is not None and time is not None:
            batch = _resolved(vindex, batch, key_field, time)
            key = F.col(key_field).cast("string")
            changes = batch.select(key.alias("key"), F.col(time).alias("ts"))
            adds = batch.filter(F.col("op") == "add")
            adds = adds.drop("op", "field", "term", *([] if time in vindex.extra + tuple(vindex.schema.names) else [time]))
            dels = batch.select(F.lit(key_field).alias("field"), key.alias("term"))
        elif "op" in batch.columns:
            adds = batch.filter(F.col("op") == "add").drop("op", "field", "term")
            dels = batch.filter(F.col("op") == "delete").select("field", "term")
        else:
            adds, dels = batch, None
        if to_adds is not None:
            adds = to_adds(adds)
        vindex.commit(adds=adds, deletes=dels, batch_id=batch_id, stream_id=stream_id, changes=changes)
    return run


def ingest_stream(changes: DataFrame, vindex: VersionedIndex, checkpoint: str,
                  to_adds: Callable[[DataFrame], DataFrame] | None = None,
                  event_time: str | None = None, watermark: str = "1 hour", key_cols: list[str] | None = None,
                  available_now: bool = True, key_field: str | None = None, time: str | None = None):
    """Start the ingest query; ``available_now`` processes what is there and stops."""
    s = changes
    if event_time is not None:
        s = s.withWatermark(event_time, watermark)
        if key_cols:
            s = s.dropDuplicatesWithinWatermark(key_cols)
    run = apply_batch(vindex, to_adds, checkpoint, key_field, time)
    w = s.writeStream.foreachBatch(run).option("checkpointLocation", checkpoint)
    w = w.trigger(availableNow=True) if available_now else w.trigger(processingTime="10 seconds")
    return w.start()


def ingest_files(spark: SparkSession, vindex: VersionedIndex, path: str, schema: str, glob: str = "*.parquet",
                 to_adds: Callable[[DataFrame], DataFrame] | None = None, max_files_per_trigger: int = 1,
                 key_field: str | None = None, time: str | None = None) -> None:
    """Stream the Parquet files of ``path``, a folder or one file, matching ``glob`` into ``vindex`` and wait."""
    if not is_folder(spark, path):  # a stream reads folders
        path, glob = path.rsplit("/", 1)
    src = (spark.readStream.schema(schema).option("pathGlobFilter", glob)
           .option("maxFilesPerTrigger", max_files_per_trigger).parquet(path))
    q = ingest_stream(src, vindex, new_table_path(spark, "stream-ckpt"), to_adds,
                      key_field=key_field, time=time)
    q.awaitTermination()
