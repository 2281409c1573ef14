"""Results: fetch (R6), projection (R7), fast-field search (R8), JSON (S8), typed (S9), size."""

from __future__ import annotations

from typing import Callable

from pyspark.sql import DataFrame
from pyspark.sql import functions as F
from pyspark.sql.types import ArrayType, StructType

from ..session import bounded_broadcast, materialize
from .index import TextIndex

RESULT_BROADCAST_ROWS = 5_000_000


def fetch(index: TextIndex, results: DataFrame, fields: list[str]) -> DataFrame:
    """Late materialization -- rank first, then join the (bounded) result rows to the
    stored documents and keep only the requested fields (Catalyst prunes the scan)."""
    if not fields:
        raise ValueError("fields to include must not be empty")
    for f in fields:
        if not index.schema.field(f).stored:
            raise ValueError(f"field is not stored: {f}")
    return _with_values(index, results, fields)


def _with_values(index: TextIndex, results: DataFrame, fields: list[str]) -> DataFrame:
    r = materialize(results.select("qid", "rank", "doc_id", "score"))
    docs = index.docs().select("doc_id", *fields)
    return (docs.join(bounded_broadcast(r, RESULT_BROADCAST_ROWS), "doc_id")
            .select("qid", "rank", "doc_id", "score", *fields))


def fast_field(index: TextIndex, results: DataFrame, field: str) -> DataFrame:
    """(qid, rank, value, score); missing/empty -> '', first value when repeated."""
    names = [f.name for f in index.schema.fields if f.fast]
    if field not in names:
        raise ValueError("fast field not found in schema")
    docs = index.docs().select("doc_id", field)
    dtype = docs.schema[field].dataType
    val = F.element_at(F.col(field), 1) if isinstance(dtype, ArrayType) else F.col(field)
    return _with_values(index, results, [field]).select("qid", "rank", F.coalesce(val, F.lit("")).alias("value"), "score")


def result_size(results: DataFrame) -> DataFrame:
    """Number of returned rows per query (at most the limit)."""
    return results.groupBy("qid").agg(F.count(F.lit(1)).alias("size"))


def to_json_documents(index: TextIndex, results: DataFrame, fields: list[str],
                      highlights: DataFrame | None = None) -> DataFrame:
    """One JSON object per hit with score, highlights and the requested fields; the last
    value of a repeated field wins."""
    rows = fetch(index, results, fields)
    cols = []
    for f in fields:
        dtype = rows.schema[f].dataType
        cols.append((F.element_at(F.col(f), -1) if isinstance(dtype, ArrayType) else F.col(f)).alias(f))
    if highlights is not None:
        rows = rows.join(highlights, ["qid", "doc_id"], "left")
        hl = F.coalesce(F.col("highlights"), F.array().cast(highlights.schema["highlights"].dataType))
    else:
        hl = F.array().cast("array<struct<field_name:string,fragment:struct<t:string,r:array<array<int>>>>>")
    return rows.select("qid", "rank", "doc_id",
                       F.to_json(F.struct(F.col("score").alias("score"), hl.alias("highlights"), *cols)).alias("json"))


def typed_results(json_rows: DataFrame, schema: StructType,
                  fn: Callable | None = None, out_schema: StructType | str | None = None) -> DataFrame:
    """Parse each JSON document into a typed struct; an optional callback runs per
    Arrow batch (``mapInPandas``) for logic that built-in functions cannot express."""
    parsed = json_rows.select("qid", "rank", F.from_json("json", schema).alias("doc")).select("qid", "rank", "doc.*")
    if fn is None:
        return parsed
    return parsed.mapInPandas(fn, out_schema)
