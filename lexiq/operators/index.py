"""Index build (A1-A6, S7): corpus DataFrame -> postings, vocabulary, statistics, stored docs.

Layout written to ``path``:

* ``postings/field=<f>/tb=<b>/``  (term, doc_id, tf, len, positions), a table bucketed by doc_id
  into document shards, rows sorted by term
* ``vocab/field=<f>/tb=<b>/``     (term, df)
* ``stats/``                      (field, n_docs, total_tokens, avg_len)  -- one row per field
* ``docs/``                       (doc_id, stored fields)
* ``ids/``                        (doc_id, place), in the order of doc_id

``tb`` is a hash bucket of the term. A query batch joins its (small) analyzed terms on
``(field, tb, term)``, so dynamic partition pruning reads only the buckets it needs.

All postings of a document lie in one document shard, and the scan says so to the planner:
whatever is grouped or joined by document (leaf scores, phrase candidates, the boolean
fold, a shard's top k) needs no exchange. The documents are dealt to their shards before
they are tokenized, so the build moves texts once and postings never (a very frequent term is
spread over all shards). Postings for fields without stemming are made of batches of token
arrays, whose tokens are sorted by term and row and cut into runs; what a simple analyzer does
to a word is done to the distinct words of a batch.
"""

from __future__ import annotations

import hashlib
from collections.abc import Iterator
from dataclasses import dataclass

import numpy as np
import pyarrow as pa
import pyarrow.compute as pc
from pyspark.sql import Column, DataFrame, SparkSession, Window
from pyspark.sql import functions as F
from pyspark.sql.types import ArrayType, StringType

from ..functions.analyzers import WORD_PATTERN
from ..functions.folding import fold_map
from ..functions.stem import apply_stems, stem_dictionary
from ..plans.schema import RECORD_POSITIONS, Schema
from ..session import bounded_broadcast, new_table_path, stored

ALL_FIELD = "_all"  # every document holds the empty term here: the list of all documents, for the statistics
DEFAULT_TERM_BUCKETS, MAX_TERM_BUCKETS, FILE_BYTES = 4, 8192, 64 << 20
#: A document shard is one task of a search: of about SHARD_BYTES in a large corpus, so that the hits of some hundred
#: queries in all its documents fit the memory of a task; a small one is dealt to a few shards per core, but to no
#: shards under SMALL_SHARD_BYTES.
MAX_DOC_SHARDS, SHARD_BYTES, SMALL_SHARD_BYTES, SHARDS_PER_CORE, UNKNOWN_BYTES = 1 << 16, 4 << 20, 256 << 10, 4, 1 << 60
STEM_BROADCAST_ROWS = 5_000_000
#: Rows of a part of a stem dictionary.
STEM_ROWS = 1 << 20
#: Files that a task of the build keeps open: those of its shard by term bucket, if these are no more, else one at a time.
OPEN_FILES = 128


def term_bucket(term: Column, buckets: int) -> Column:
    return F.pmod(F.xxhash64(term), F.lit(buckets)).cast("int")


def field_tokens(docs: DataFrame, schema: Schema, name: str, id_col: str = "doc_id") -> DataFrame:
    """(doc_id, toks array<struct<pos,term>>) for one field; multi-valued fields continue
    positions across values."""
    an = schema.analyzer_of(name)
    dtype = docs.schema[name].dataType
    if an.kind == "lexicon":
        from ..functions.lexicon import segment
        if isinstance(dtype, ArrayType):
            docs = docs.withColumn(name, F.array_join(name, "\n"))
        return segment(docs, id_col, name, schema.lexicon_of(name), an.max_word_len, an.limit, an.lower)
    if isinstance(dtype, ArrayType):
        per_value = F.transform(F.coalesce(F.col(name), F.array().cast("array<string>")), lambda v: an.expr(v))
        init = F.struct(F.array().cast("array<struct<pos:int,term:string>>").alias("out"),
                        F.lit(0).alias("base"))

        def step(acc, toks):
            shifted = F.transform(toks, lambda t: F.struct((t["pos"] + acc["base"]).cast("int").alias("pos"),
                                                           t["term"].alias("term")))
            nxt = acc["base"] + F.coalesce(F.array_max(F.transform(toks, lambda t: t["pos"])) + 1, F.lit(0))
            return F.struct(F.concat(acc["out"], shifted).alias("out"), nxt.cast("int").alias("base"))

        toks = F.aggregate(per_value, init, step, lambda a: a["out"])
    else:
        toks = an.expr(F.col(name))
    return docs.select(F.col(id_col).alias("doc_id"), toks.alias("toks"))


#: Rows of a batch of postings that a task hands on at a time.
BATCH_ROWS = 1 << 16
_POSTINGS = "term string, doc_id {}, tf int, len int, positions array<int>"


def _batch_postings(rows_at_a_time: int = BATCH_ROWS):
    """Postings of Arrow batches of (doc_id, toks): the tokens of every row grouped by term, their positions
    ascending. Rows stay apart, also those of one id. The function is a closure: workers need no lexiq."""
    def group(batches: Iterator[pa.RecordBatch]) -> Iterator[pa.RecordBatch]:
        for batch in batches:
            lists = batch.column("toks")
            lens = pc.fill_null(pc.list_value_length(lists), 0).to_numpy(zero_copy_only=False)
            pos, terms = lists.flatten().flatten()
            words = terms.dictionary_encode(null_encoding="encode")
            code, pos = words.indices.to_numpy(zero_copy_only=False), pos.to_numpy(zero_copy_only=False)
            row = np.repeat(np.arange(batch.num_rows), lens)
            key = row * (len(words.dictionary) + 1) + code
            order = np.lexsort((pos, key))
            key = key[order]
            first = np.flatnonzero(np.r_[True, key[1:] != key[:-1]]) if len(key) else np.zeros(0, "int64")
            ends, rows = np.r_[first, len(key)], row[order[first]]
            out = pa.RecordBatch.from_arrays([
                words.dictionary.take(pa.array(code[order[first]])), batch.column("doc_id").take(pa.array(rows)),
                pa.array(np.diff(ends).astype("int32")), pa.array(lens[rows].astype("int32")),
                pa.ListArray.from_arrays(pa.array(ends.astype("int32")), pa.array(pos[order].astype("int32")))],
                ["term", "doc_id", "tf", "len", "positions"])
            for start in range(0, out.num_rows, rows_at_a_time):
                yield out.slice(start, rows_at_a_time)

    return group


def _word_postings(limit: int, lower: bool, folds: dict[int, str] | None, rows_at_a_time: int = BATCH_ROWS, stems: list | None = None):
    """Postings of Arrow batches of (doc_id, words), the words as ``Analyzer.expr`` has them before it drops long ones,
    lower-cases and folds (``folds``, by code point): each distinct word of a batch once. In the order of term and
    document. Rows stay apart, also those of one id. With ``stems``, the broadcast parts of ``stem_parts``, terms become
    their stems, and the rows of an id, which must follow each other, are one document. The function is a closure: workers
    need no lexiq."""
    def whole_ids(batches: Iterator[pa.RecordBatch]) -> Iterator[pa.RecordBatch]:
        held = None
        for batch in batches:
            rows = pa.Table.from_batches([batch] if held is None else [*held.to_batches(), batch])
            ids = rows["doc_id"].combine_chunks().dictionary_encode(null_encoding="encode").indices.to_numpy(zero_copy_only=False)
            other = np.flatnonzero(ids != ids[-1]) if len(ids) else ids
            cut = int(other[-1]) + 1 if len(other) else 0
            yield from rows.slice(0, cut).combine_chunks().to_batches()
            held = rows.slice(cut)
        if held is not None:
            yield from held.combine_chunks().to_batches()

    def stemmed(terms: pa.Array) -> pa.Array:
        """Their stems; a part of the dictionary is in memory at a time."""
        place, found, n = np.arange(len(terms)), [terms], len(terms)
        for part in stems:
            at = pc.index_in(part.value["term"].cast(terms.type), value_set=terms).fill_null(-1).to_numpy(zero_copy_only=False)
            hit = np.flatnonzero(at >= 0)
            place[at[hit]] = n + np.arange(len(hit))
            found.append(part.value["stem"].cast(terms.type).take(pa.array(hit)))
            n += len(hit)
            if len(stems) > 1:
                del part._value
        return pa.concat_arrays(found).take(pa.array(place))

    def group(batches: Iterator[pa.RecordBatch]) -> Iterator[pa.RecordBatch]:
        for batch in batches if stems is None else whole_ids(batches):
            lists, ids = batch.column("words"), batch.column("doc_id")
            lens = pc.list_value_length(lists).to_numpy(zero_copy_only=False).astype("int64")
            words = lists.flatten().dictionary_encode()
            plain = pc.string_is_ascii(words.dictionary)
            other = words.dictionary.filter(pc.invert(plain)).to_pylist()
            if lower:
                other = [w.lower() for w in other]
            if folds:
                other = [w.translate(folds) for w in other]
            terms = pc.ascii_lower(words.dictionary) if lower else words.dictionary
            terms = pc.replace_with_mask(terms, pc.invert(plain), pa.array(other, terms.type)).dictionary_encode()
            term_of = terms.indices.to_numpy(zero_copy_only=False)
            if stems is not None:
                terms = stemmed(terms.dictionary).dictionary_encode()
                term_of = terms.indices.to_numpy(zero_copy_only=False)[term_of]
            in_order = pc.array_sort_indices(terms.dictionary)  # by bytes, as Spark sorts
            ordered, rank = terms.dictionary.take(in_order), np.empty(len(in_order), "int64")
            rank[in_order.to_numpy(zero_copy_only=False)] = np.arange(len(in_order))
            short = pc.less(pc.binary_length(words.dictionary), limit).to_numpy(zero_copy_only=False)
            code = np.where(short, rank[term_of], -1)[words.indices.to_numpy(zero_copy_only=False)]
            by_id = pc.array_sort_indices(ids).to_numpy(zero_copy_only=False).astype("int64")
            place = np.empty(len(by_id), "int64")
            place[by_id] = np.arange(len(by_id))
            if stems is not None:  # rows of one id have one place
                of = ids.dictionary_encode(null_encoding="encode").indices.to_numpy(zero_copy_only=False)[by_id]
                place[by_id] = np.cumsum(np.r_[False, of[1:] != of[:-1]][:len(of)])
            row = np.repeat(np.arange(batch.num_rows), lens)
            pos = np.arange(len(row)) - np.repeat(np.cumsum(lens) - lens, lens)
            kept = np.flatnonzero(code >= 0)
            count = np.bincount(row[kept], minlength=batch.num_rows)
            key = code[kept] * batch.num_rows + place[row[kept]]
            if stems is None:
                order = np.argsort(key, kind="stable")  # positions stay ascending
            else:
                order = np.lexsort((pos[kept], key))
            key = key[order]
            first = np.flatnonzero(np.r_[True, key[1:] != key[:-1]]) if len(key) else np.zeros(0, "int64")
            ends, rows = np.r_[first, len(key)], row[kept][order[first]]
            out = pa.RecordBatch.from_arrays([
                ordered.take(pa.array(key[first] // max(batch.num_rows, 1))), ids.take(pa.array(rows)),
                pa.array(np.diff(ends).astype("int32")), pa.array(count[rows].astype("int32")),
                pa.ListArray.from_arrays(pa.array(ends.astype("int32")), pa.array(pos[kept][order].astype("int32")))],
                ["term", "doc_id", "tf", "len", "positions"])
            for start in range(0, out.num_rows, rows_at_a_time):
                yield out.slice(start, rows_at_a_time)

    return group


def stem_parts(dictionary: DataFrame) -> list:
    """The terms of a stored (term, stem) table that have another stem, as broadcast parts of STEM_ROWS rows on average."""
    spark, d = dictionary.sparkSession, dictionary.filter("stem <> term")
    n = max(1, -(-d.count() // STEM_ROWS))
    parts = (d.filter(F.pmod(F.xxhash64("term"), F.lit(n)) == i).toArrow().combine_chunks() for i in range(n))
    return [spark.sparkContext.broadcast({"term": t["term"].combine_chunks(), "stem": t["stem"].combine_chunks()}) for t in parts]


def stems_in_batches(docs: DataFrame, schema: Schema, name: str) -> bool:
    """Whether the terms of a field become stems where its postings are made."""
    an = schema.analyzer_of(name)
    return an.kind == "simple" and an.lang is not None and isinstance(docs.schema[name].dataType, StringType)


def field_postings(docs: DataFrame, schema: Schema, name: str, id_col: str = "doc_id",
                   stem_dict: DataFrame | None = None, corpus: DataFrame | None = None) -> DataFrame:
    """(field, term, doc_id, tf, len, positions) for one field. ``corpus``: the same documents before they were dealt to
    their shards; if not given, they weren't."""
    spec = schema.field(name)
    an = schema.analyzer_of(name)
    ft = field_tokens(docs, schema, name, id_col)
    if an.kind == "raw" and an.lang is None and not isinstance(docs.schema[name].dataType, ArrayType):
        # one token: the value itself
        out = docs.filter(F.col(name).isNotNull()).select(
            F.lit(name).alias("field"), F.col(name).alias("term"), F.col(id_col).alias("doc_id"), F.lit(1).alias("tf"),
            F.lit(1).alias("len"), F.array(F.lit(0)).alias("positions"))
    elif an.kind == "simple" and an.lang is None and isinstance(docs.schema[name].dataType, StringType):
        words = docs.select(F.col(id_col).alias("doc_id"), F.regexp_extract_all(
            F.coalesce(F.col(name), F.lit("")), F.lit(WORD_PATTERN), 0).alias("words"))
        rows = words.mapInArrow(_word_postings(an.limit, an.lower, fold_map() if an.fold else None), _POSTINGS.format(
            words.schema["doc_id"].dataType.simpleString()))
        out = rows.select(F.lit(name).alias("field"), "term", "doc_id", "tf", "len", "positions")
    elif stems_in_batches(docs, schema, name):
        # the dictionary goes to the documents: their tokens aren't moved, however large it is
        d = stem_dict
        if d is None:
            terms = field_tokens(docs if corpus is None else corpus, schema, name, id_col).select(F.inline("toks"))
            d = stem_dictionary(terms, an.lang, schema.stems_of(name))
        parts = stem_parts(stored(d, "stems"))
        words = (docs.repartition(id_col) if corpus is None else docs).select(F.col(id_col).alias("doc_id"), F.regexp_extract_all(
            F.coalesce(F.col(name), F.lit("")), F.lit(WORD_PATTERN), 0).alias("words")).sortWithinPartitions("doc_id")
        rows = words.mapInArrow(_word_postings(an.limit, an.lower, fold_map() if an.fold else None, stems=parts), _POSTINGS.format(
            words.schema["doc_id"].dataType.simpleString()))
        out = rows.select(F.lit(name).alias("field"), "term", "doc_id", "tf", "len", "positions")
    elif an.lang is None:
        rows = ft.select("doc_id", F.col("toks").cast("array<struct<pos:int,term:string>>").alias("toks")).mapInArrow(
            _batch_postings(), _POSTINGS.format(ft.schema["doc_id"].dataType.simpleString()))
        out = rows.select(F.lit(name).alias("field"), "term", "doc_id", "tf", "len", "positions")
    else:
        # stemmed field: explode, map terms through the stem dictionary, regroup per (term, doc)
        toks = ft.select("doc_id", F.size("toks").cast("int").alias("len"),
                         F.inline("toks"))
        d = stem_dict if stem_dict is not None else stem_dictionary(toks, an.lang, schema.stems_of(name))
        d = stored(d, "stems")  # tokenizes once; the count below then reads the written dictionary
        toks = apply_stems(toks, bounded_broadcast(d, STEM_BROADCAST_ROWS))
        out = (toks.groupBy("term", "doc_id")
               .agg(F.count(F.lit(1)).cast("int").alias("tf"), F.first("len").alias("len"),
                    F.sort_array(F.collect_list("pos")).alias("positions"))
               .select(F.lit(name).alias("field"), "term", "doc_id", "tf", "len", "positions"))
    if spec.record < RECORD_POSITIONS:
        out = out.withColumn("positions", F.lit(None).cast("array<int>"))
    return out


def universal_postings(docs: DataFrame, id_col: str = "doc_id") -> DataFrame:
    return docs.select(F.lit(ALL_FIELD).alias("field"), F.lit("").alias("term"),
                       F.col(id_col).alias("doc_id"), F.lit(1).alias("tf"), F.lit(1).alias("len"),
                       F.array(F.lit(0)).alias("positions"))


def corpus_postings(docs: DataFrame, schema: Schema, id_col: str = "doc_id",
                    stem_dicts: dict | None = None, include_all: bool = True, shards: int | None = None) -> DataFrame:
    """All postings of a corpus, one row per (field, term, doc). With ``shards``, documents are dealt to
    their shards first and every task's rows are of one shard."""
    corpus = None
    if shards:
        corpus, docs = docs, docs.repartition(shards, id_col)
    parts = []
    for f in schema.names:
        part = field_postings(docs, schema, f, id_col, (stem_dicts or {}).get(f), corpus)
        an = schema.analyzer_of(f)
        if shards and (an.lang is not None or an.kind == "lexicon") and not stems_in_batches(docs, schema, f):
            part = part.repartition(shards, "doc_id")  # joined by term on the way
        parts.append(part)
    if include_all:
        parts.append(universal_postings(docs, id_col))
    out = parts[0]
    for p in parts[1:]:
        out = out.unionByName(p)
    return out


def shard_table(spark: SparkSession, path: str, schema: str, shards: int) -> DataFrame:
    """The table below ``path``, read with what it knows of its document shards. A session registers an
    external table for it; the files hold all rows, dropping the table leaves them."""
    # joins and aggregates by (document, ...) may use the shards although these are dealt by the document alone
    spark.conf.set("spark.sql.requireAllClusterKeysForCoPartition", "false")
    name = table_name(path)
    if not spark.catalog.tableExists(name):
        spark.sql(f"CREATE TABLE IF NOT EXISTS {name} ({schema}, field STRING, tb INT) USING parquet PARTITIONED BY (field, tb) "
                  f"CLUSTERED BY (doc_id) SORTED BY (term) INTO {shards} BUCKETS LOCATION '{path}'")
        if spark.conf.get("spark.sql.catalogImplementation") == "hive":
            spark.catalog.recoverPartitions(name)
    return spark.table(name)


def table_name(path: str) -> str:
    return "lexiq_" + hashlib.sha256(path.encode()).hexdigest()[:20]


@dataclass
class TextIndex:
    spark: SparkSession
    path: str
    schema: Schema
    term_buckets: int = DEFAULT_TERM_BUCKETS
    doc_shards: int = 1
    id_type: str = "bigint"

    def postings(self) -> DataFrame:
        return shard_table(self.spark, f"{self.path}/postings", f"term STRING, doc_id {self.id_type}, tf INT, len INT, "
                                                                "positions ARRAY<INT>", self.doc_shards)

    def vocab(self) -> DataFrame:
        return self.spark.read.parquet(f"{self.path}/vocab")

    def stats(self) -> DataFrame:
        return self.spark.read.parquet(f"{self.path}/stats")

    def docs(self) -> DataFrame:
        return self.spark.read.parquet(f"{self.path}/docs")

    def ids(self) -> DataFrame:
        """(doc_id, ord): the documents numbered from 0 in the order of their ids."""
        return numbered_ids(self.spark.read.parquet(f"{self.path}/ids"))

    def num_docs(self) -> DataFrame:
        """A5 as a one-row DataFrame."""
        return self.docs().agg(F.count(F.lit(1)).alias("num_docs"))

    def bucket(self, term: Column) -> Column:
        return term_bucket(term, self.term_buckets)


def write_postings(postings: DataFrame, path: str, buckets: int, shards: int) -> None:
    """``postings`` in tasks of one shard each, as files of (field, term bucket, shard) in the order of term and document."""
    spark, name = postings.sparkSession, table_name(path)
    spark.sql(f"DROP TABLE IF EXISTS {name}")
    rows = postings.select("term", "doc_id", "tf", "len", "positions", "field", term_bucket(F.col("term"), buckets).alias("tb"))

    def write(df: DataFrame, *sort: str) -> None:
        w = df.write.mode("overwrite").format("parquet").option("path", path).partitionBy("field", "tb").bucketBy(shards, "doc_id")
        (w.sortBy(*sort) if sort else w).saveAsTable(name)

    if buckets > OPEN_FILES:
        return write(rows, "term", "doc_id")
    # The sort that a writer of one file at a time asks for compares field, bucket and shard before the term. With a
    # file open for every bucket, rows that are in order, as most tasks have them, stay so.
    key = "spark.sql.maxConcurrentOutputFileWriters"
    before = spark.conf.get(key)
    spark.conf.set(key, str(OPEN_FILES))
    try:
        write(rows.sortWithinPartitions("term", "doc_id"))
    finally:
        spark.conf.set(key, before)


def write_vocab(postings: DataFrame, path: str) -> None:
    (postings.groupBy("field", "tb", "term").agg(F.count(F.lit(1)).alias("df"))
     .hint("rebalance", "field", "tb")
     .sortWithinPartitions("field", "tb", "term")
     .write.mode("overwrite").partitionBy("field", "tb").parquet(path))


def write_ids(docs: DataFrame, path: str, id_col: str = "doc_id") -> None:
    """(doc_id, place): ids in ascending order over the files and in every file."""
    (docs.select(F.col(id_col).alias("doc_id")).repartitionByRange("doc_id").sortWithinPartitions("doc_id")
     .withColumn("place", F.monotonically_increasing_id()).write.mode("overwrite").parquet(path))


def numbered_ids(ids: DataFrame) -> DataFrame:
    """(doc_id, ord) of a table of ``write_ids``: a file's first number is the rows of all files before it."""
    placed = ids.withColumn("_part", F.shiftright("place", 33))
    before = Window.orderBy("_part").rowsBetween(Window.unboundedPreceding, -1)
    # one row per file
    offsets = placed.groupBy("_part").agg(F.count(F.lit(1)).alias("_n")).select(
        "_part", F.coalesce(F.sum("_n").over(before), F.lit(0)).alias("_off"))
    return placed.join(bounded_broadcast(stored(offsets, "offsets")), "_part").select(
        "doc_id", (F.col("_off") + F.col("place") - F.shiftleft("_part", 33)).alias("ord"))


def compute_stats(postings: DataFrame, names: list[str]) -> DataFrame:
    """A4: N = all documents (from the universal posting list), avg_len = tokens / N,
    documents with an empty field and fields without any token included."""
    per_field = postings.groupBy("field").agg(F.sum("tf").cast("long").alias("total_tokens"),
                                              F.count(F.lit(1)).alias("n_rows"))
    return stats_of(per_field, names)


def stats_of(per_field: DataFrame, names: list[str]) -> DataFrame:
    """Statistics from (field, total_tokens, n_rows); ``n_rows`` of the universal list counts the documents."""
    fields = per_field.sparkSession.range(1).select(F.explode(F.array(*[F.lit(n) for n in [*names, ALL_FIELD]])).alias("field"))
    per_field = fields.join(per_field, "field", "left").fillna(0, ["total_tokens", "n_rows"])
    # one row per field: the window over all of them is bounded by the number of fields
    n_docs = F.max(F.when(F.col("field") == ALL_FIELD, F.col("n_rows"))).over(Window.partitionBy())
    return (per_field.withColumn("n_docs", F.coalesce(n_docs, F.lit(0)).cast("long"))
            .withColumn("avg_len", F.col("total_tokens") / F.nullif(F.col("n_docs"), F.lit(0)))
            .select("field", "n_docs", "total_tokens", "avg_len"))


def _power_of_two(wanted: int) -> int:
    return 1 << max(0, int(wanted).bit_length() - 1)


def layout_for(docs: DataFrame) -> tuple[int, int]:
    """(term buckets, document shards) of a corpus, powers of two, from the size that the planner estimates
    for it: a shard is a task's work, and a file of a shard and a term bucket has about FILE_BYTES."""
    cores = docs.sparkSession.sparkContext.defaultParallelism
    size = int(docs._jdf.queryExecution().optimizedPlan().stats().sizeInBytes())
    if size >= UNKNOWN_BYTES:  # the planner can't tell (rows of an RDD): a shard per core
        return DEFAULT_TERM_BUCKETS, _power_of_two(cores)
    few = min(SHARDS_PER_CORE * cores, size // SMALL_SHARD_BYTES)
    shards = _power_of_two(min(MAX_DOC_SHARDS, max(1, few, size // SHARD_BYTES)))
    return _power_of_two(min(MAX_TERM_BUCKETS, max(DEFAULT_TERM_BUCKETS, size // shards // FILE_BYTES))), shards


def build_index(spark: SparkSession, docs: DataFrame, schema: Schema, id_col: str = "doc_id",
                path: str | None = None, term_buckets: int | None = None,
                stem_dicts: dict | None = None, doc_shards: int | None = None) -> TextIndex:
    """Tokenize every field, write postings/vocab/stats/docs, return the index handle."""
    path = path or new_table_path(spark, "index")
    for name in schema.names:
        if name not in docs.columns:
            raise ValueError(f"missing column for field: {name}")
    layout = layout_for(docs)
    index = TextIndex(spark, path, schema, term_buckets or layout[0], doc_shards or layout[1],
                      docs.schema[id_col].dataType.simpleString())
    write_postings(corpus_postings(docs, schema, id_col, stem_dicts, shards=index.doc_shards), f"{path}/postings",
                   index.term_buckets, index.doc_shards)
    write_tables(index, docs.select(F.col(id_col).alias("doc_id"), *[F.col(c) for c in schema.kept if c != "doc_id"]))
    return index


def write_tables(index: TextIndex, docs: DataFrame) -> None:
    """Vocabulary, statistics, stored documents and their order, once the postings are written."""
    p = index.postings()
    write_vocab(p, f"{index.path}/vocab")
    compute_stats(p, index.schema.names).coalesce(1).write.mode("overwrite").parquet(f"{index.path}/stats")
    docs.write.mode("overwrite").parquet(f"{index.path}/docs")
    write_ids(index.docs(), f"{index.path}/ids")
