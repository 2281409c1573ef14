"""Token-ID output: Parquet files with one row per document and its ids as a list column.

Documents are range-partitioned by id, so the files in order hold ascending ids; the text is
shuffled, not the longer id lists. ``ids`` is dictionary-encoded (a vocabulary fits a
dictionary page), the counters are delta-encoded, row groups hold about ``ROW_GROUP`` bytes and
pages ``PAGE`` bytes with page indexes, so a reader can fetch counters alone, or the ids of a
range of documents, without the rest of a file.

``part`` numbers the range partitions; ``start_in_part`` counts the ids before a document in its
partition. Global starts need one number per part: a running sum over the parts.

Null and empty texts give the end id alone. Equal ids follow each other by text; a null id comes
first. An empty table gives files without rows. Extra columns are not written.
"""

from __future__ import annotations

import zlib
from collections.abc import Iterator

import numpy as np
import pyarrow as pa
from pyspark import TaskContext
from pyspark.sql import DataFrame, SparkSession, Window
from pyspark.sql import functions as F

from ..session import new_table_path
from . import words as W
from .common import documents, small, stored
from .tokens import encoder, lists

END_ID = 1
ROW_GROUP, PAGE, DICTIONARY = 32 << 20, 64 << 10, 1 << 20
SCHEMA = "doc_id long, part int, start_in_part long, n_tokens long, ids array<int>"


def encode(docs: DataFrame, tokenizer_path: str, end_id: int = END_ID) -> DataFrame:
    """Rows of SCHEMA in ascending doc_id order."""
    def run(batches: Iterator[pa.RecordBatch]) -> Iterator[pa.RecordBatch]:
        part, start = TaskContext.get().partitionId(), 0
        for batch in batches:
            for w in W.slices(batch.column("text")):
                ids, n = encoder(tokenizer_path).encode(w, end_id)
                starts = start + np.cumsum(n) - n
                start += int(n.sum())
                yield pa.RecordBatch.from_arrays(
                    [batch.column("doc_id").slice(w.row, w.n_docs), pa.array(np.full(w.n_docs, part, np.int32)),
                     pa.array(starts), pa.array(n), lists(ids, n)],
                    names=["doc_id", "part", "start_in_part", "n_tokens", "ids"])

    ordered = (docs.select(F.col("doc_id").cast("long").alias("doc_id"), "text")
               .repartitionByRange("doc_id").sortWithinPartitions("doc_id", "text"))
    return ordered.mapInArrow(run, SCHEMA)


def write(encoded: DataFrame, path: str) -> None:
    options = {"parquet.block.size": ROW_GROUP, "parquet.page.size": PAGE, "parquet.dictionary.page.size": DICTIONARY,
               "parquet.writer.version": "PARQUET_2_0", "parquet.enable.dictionary": "false",
               "parquet.enable.dictionary#ids.list.element": "true", "compression": "zstd"}
    encoded.write.options(**{k: str(v) for k, v in options.items()}).parquet(path)


def read(spark: SparkSession, path: str) -> DataFrame:
    """The written rows with ``start``, the number of ids of all documents before each."""
    rows = spark.read.schema(SCHEMA).parquet(path)
    parts = rows.groupBy("part").agg(F.sum("n_tokens").alias("n"))  # reads two counters, no ids
    before = Window.orderBy("part").rowsBetween(Window.unboundedPreceding, -1)  # one row per part
    offsets = stored(parts.select("part", F.coalesce(F.sum("n").over(before), F.lit(0)).alias("offset")), "parts")
    return (rows.join(small(offsets), "part")
            .select("doc_id", (F.col("offset") + F.col("start_in_part")).alias("start"), "n_tokens", "ids"))


def digests(rows: DataFrame) -> DataFrame:
    """(doc_id, start, n_tokens, ids_crc32) of rows that hold ``ids``."""
    def run(batches: Iterator[pa.RecordBatch]) -> Iterator[pa.RecordBatch]:
        for batch in batches:
            ids = batch.column("ids")
            data = memoryview(np.ascontiguousarray(ids.values.to_numpy(), "<i4")).cast("B")
            at = ids.offsets.to_numpy()
            crc = np.fromiter((zlib.crc32(data[4 * a:4 * b]) for a, b in zip(at[:-1], at[1:])), np.int64, len(ids))
            yield pa.RecordBatch.from_arrays(
                [*(batch.column(c) for c in ("doc_id", "start", "n_tokens")), pa.array(crc)],
                names=["doc_id", "start", "n_tokens", "ids_crc32"])

    return rows.mapInArrow(run, "doc_id long, start long, n_tokens long, ids_crc32 long")


def token_files(docs: DataFrame, tokenizer_path: str, path: str | None = None) -> str:
    """Write ``docs`` as token files and return their folder."""
    path = path or new_table_path(docs.sparkSession, "tokens")
    write(encode(docs, tokenizer_path), path)
    return path


def op7_token_files(spark: SparkSession, sf_dir: str) -> DataFrame:
    import public_tokenizers
    path = token_files(documents(spark, sf_dir), public_tokenizers.path("word_bpe_49k.json"))
    return digests(read(spark, path))
