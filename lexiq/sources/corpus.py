"""Corpus and judgement sources (S1-S3), UTF-8 repair."""

from __future__ import annotations

from collections.abc import Iterator

import pyarrow as pa
from pyspark.sql import DataFrame, SparkSession, Window
from pyspark.sql import functions as F
from pyspark.sql import types as T

from ..session import stored

CORPUS_JSON_SCHEMA = T.StructType([T.StructField("id", T.StringType()), T.StructField("title", T.StringType()),
                                   T.StructField("body", T.StringType())])
CORPUS_TSV_SCHEMA = T.StructType([T.StructField("docid", T.StringType()), T.StructField("title", T.StringType()),
                                  T.StructField("text", T.StringType())])
TOPICS_SCHEMA = T.StructType([T.StructField("query_id", T.StringType()), T.StructField("query_text", T.StringType())])
JUDGEMENTS_SCHEMA = T.StructType([T.StructField("query_id", T.StringType()), T.StructField("iteration", T.StringType()),
                                  T.StructField("doc_id", T.StringType()), T.StructField("grade", T.StringType())])
QUERIES_JSON_SCHEMA = T.StructType([T.StructField("query", T.StringType()),
                                    T.StructField("relevant_docs", T.ArrayType(T.StringType()))])


def read_corpus_json(spark: SparkSession, path: str, multiline: bool = False) -> DataFrame:
    """Documents ``{id, title, body}`` (a JSON array file with ``multiline=True``)."""
    return spark.read.schema(CORPUS_JSON_SCHEMA).option("multiLine", multiline).json(path)


def _closes(line: str, quoted: bool) -> bool:
    """Whether a quoted field is open at the end of a line, if one was (``quoted``) or wasn't at its start. A quote opens
    a field only as its first character, and two are one of the text."""
    if '"' not in line:
        return quoted
    at = 0
    while True:
        if quoted:
            at = line.find('"', at)
            if at < 0:
                return True
            if line.startswith('""', at):
                at += 2
                continue
            quoted, at = False, line.find("\t", at)
        elif line.startswith('"', at):
            quoted, at = True, at + 1
            continue
        else:
            at = line.find("\t", at)
        if at < 0:
            return False
        at += 1


def _block_ends(batches: Iterator[pa.RecordBatch]) -> Iterator[pa.RecordBatch]:
    """(file, block, end0, end1): the state at the end of a block for either state at its start."""
    key, ends = None, [False, True]

    def drawn() -> pa.RecordBatch:
        rows = [] if key is None else [(*key, *ends)]
        kinds = (pa.string(), pa.int64(), pa.bool_(), pa.bool_())
        return pa.RecordBatch.from_arrays([pa.array([r[i] for r in rows], k) for i, k in enumerate(kinds)],
                                          names=["file", "block", "end0", "end1"])

    for batch in batches:
        for file, block, line in zip(*(batch.column(c).to_pylist() for c in ("file", "block", "value"))):
            if (file, block) != key:
                yield drawn()
                key, ends = (file, block), [False, True]
            ends = [_closes(line, e) for e in ends]
    yield drawn()


#: What a piece of a record is: a whole one, the end of one begun in an earlier block, one that goes on in the next.
WHOLE, END, BEGIN = 0, 1, 2
#: Blocks that start inside a quoted field; a small row each, broadcast. 64 TB of such blocks of 128 MB.
MAX_STARTS = 500_000


def _records(header: bool):
    """(file, seq, kind, text): the records and, at the edges of blocks, pieces of records; seq orders the pieces."""
    def run(batches: Iterator[pa.RecordBatch]) -> Iterator[pa.RecordBatch]:
        key, quoted, lines, kind, skip = None, False, [], WHOLE, False
        out: list[tuple] = []

        def close(kind_: int) -> None:
            nonlocal skip
            text = "\n".join(lines)
            text = text[:-1] if kind_ != BEGIN and text.endswith("\r") else text
            if skip and kind_ != BEGIN:
                skip = False
            elif kind_ != WHOLE or text:  # empty lines are no records
                out.append((key[0], 2 * key[1] + (kind_ == BEGIN), kind_, text))

        def drawn() -> pa.RecordBatch:
            kinds = (pa.string(), pa.int64(), pa.int32(), pa.string())
            batch = pa.RecordBatch.from_arrays([pa.array([r[i] for r in out], k) for i, k in enumerate(kinds)],
                                               names=["file", "seq", "kind", "text"])
            out.clear()
            return batch

        for batch in batches:
            columns = (batch.column(c).to_pylist() for c in ("file", "block", "quoted", "value"))
            for file, block, start, line in zip(*columns):
                if (file, block) != key:
                    if lines:
                        close(END if kind == END else BEGIN)
                    key, quoted, lines, skip = (file, block), start, [], header and block == 0
                    kind = END if start else WHOLE
                lines.append(line)
                quoted = _closes(line, quoted)
                if not quoted:
                    close(kind)
                    lines, kind = [], WHOLE
            yield drawn()
        if lines:
            close(END if kind == END else BEGIN)
        yield drawn()
    return run


def _tsv(spark: SparkSession, path: str, schema: T.StructType, header: bool) -> DataFrame:
    """Tab-separated records whose quoted fields may hold tabs, quotes and line ends, of files that many tasks read.

    One pass over the lines gives, for every block of a file that Spark reads as a split, whether a quoted field is open
    at its end, for both cases at its start; chained over a file's blocks (one small row each) that tells how every
    block starts. The second pass cuts records; pieces at the edges of blocks, two a block at most, are put together."""
    lines = spark.read.option("lineSep", "\n").text(path).select(
        F.col("_metadata.file_path").alias("file"), F.col("_metadata.file_block_start").alias("block"), "value")
    ends = stored(lines.mapInArrow(_block_ends, "file string, block long, end0 boolean, end1 boolean"), "tsv-blocks")
    start = F.struct(F.lit(False).alias("now"), F.array().cast("array<struct<block:bigint,quoted:boolean>>").alias("starts"))
    chained = F.aggregate("blocks", start, lambda a, b: F.struct(
        F.when(a["now"], b["end1"]).otherwise(b["end0"]).alias("now"),
        F.concat(a["starts"], F.array(F.struct(b["block"].alias("block"), a["now"].alias("quoted")))).alias("starts")),
        lambda a: a["starts"])
    starts = stored(ends.groupBy("file").agg(F.sort_array(F.collect_list(F.struct("block", "end0", "end1"))).alias("blocks"))
                    .select("file", F.inline(chained)).filter("quoted"), "tsv-starts")  # blocks that start inside a field
    if starts.count() > MAX_STARTS:  # a shuffle join would not keep the order of lines
        raise ValueError(f"more than {MAX_STARTS} blocks start inside a quoted field")
    marked = lines.join(F.broadcast(starts), ["file", "block"], "left").select(
        "file", "block", F.coalesce("quoted", F.lit(False)).alias("quoted"), "value")
    pieces = marked.mapInArrow(_records(header), "file string, seq long, kind int, text string")
    edges = stored(pieces.filter(F.col("kind") != WHOLE), "tsv-edges")
    number = F.sum(F.when(F.col("kind") == BEGIN, 1).otherwise(0)).over(Window.partitionBy("file").orderBy("seq"))
    joined = (edges.withColumn("number", number).groupBy("file", "number")
              .agg(F.sort_array(F.collect_list(F.struct("seq", "text"))).alias("parts"))
              .select(F.array_join(F.transform("parts", lambda x: x["text"]), "\n").alias("text")))
    records = pieces.filter(F.col("kind") == WHOLE).select("text").unionByName(joined)
    columns = ", ".join(f"{f.name} {f.dataType.simpleString()}" for f in schema.fields)
    options = {"sep": "\t", "quote": '"', "escape": '"'}
    return records.select(F.from_csv("text", columns, options).alias("r")).select("r.*")


def read_corpus_tsv(spark: SparkSession, path: str) -> DataFrame:
    """Header + ``docid, title, text``, tab-delimited."""
    return _tsv(spark, path, CORPUS_TSV_SCHEMA, True)


def write_corpus_tsv(df: DataFrame, path: str) -> None:
    (df.write.option("sep", "\t").option("header", True).option("quote", '"').option("escape", '"')
     .mode("overwrite").csv(path))


def read_topics(spark: SparkSession, path: str) -> DataFrame:
    """S3: header-less ``query_id, query_text``."""
    return _tsv(spark, path, TOPICS_SCHEMA, False).select(F.col("query_id").alias("qid"),
                                                          F.col("query_text").alias("text"))


def read_judgements(spark: SparkSession, path: str) -> DataFrame:
    """S3: header-less ``query_id, _, doc_id, grade``."""
    return _tsv(spark, path, JUDGEMENTS_SCHEMA, False).select(F.col("query_id").alias("qid"), "doc_id", "grade")


def read_judged_queries(spark: SparkSession, path: str) -> DataFrame:
    """Judged queries ``{query, relevant_docs[]}`` as (qid, text, relevant_docs)."""
    q = spark.read.schema(QUERIES_JSON_SCHEMA).option("multiLine", True).json(path)
    return q.select(F.xxhash64("query").alias("qid"), F.col("query").alias("text"), "relevant_docs")


def repair_utf8(df: DataFrame, bytes_col: str, out: str, strict: bool = False) -> DataFrame:
    """Lenient mode replaces invalid sequences with U+FFFD; strict mode raises."""
    fn = F.validate_utf8 if strict else F.make_valid_utf8
    return df.withColumn(out, fn(F.col(bytes_col)).cast("string"))


def is_valid_utf8(df: DataFrame, bytes_col: str, out: str = "valid") -> DataFrame:
    return df.withColumn(out, F.is_valid_utf8(F.col(bytes_col)))
