"""Table maintenance (M1-M6): versioned add / delete-by-term / replace batches.

Layout under ``path`` (Parquet only; a commit writes new folders):

* ``adds/version=<v>/attempt=<a>/``       documents added by commit v, with an internal ``doc_id``
* ``postings/version=<v>/attempt=<a>/``   their postings (partitioned further by field and term bucket)
* ``vocab/version=<v>/attempt=<a>/``      by how much commit v changes the document frequency of a term
* ``stats/version=<v>/attempt=<a>/``      by how much it changes a field's tokens and documents
* ``tombstones/version=<v>/attempt=<a>/`` internal ids deleted by commit v
* ``latest/version=<v>/attempt=<a>/kb=<b>/`` last change of the keys of bucket b (streams with keys and times)
* ``commits/version=<v>/``                one row per commit (attempt, adds, deletes, stream, batch, buckets)

A commit's row is written last and names its attempt, so what a failed attempt left behind is
never read. A snapshot ``as_of(v)`` keeps adds with version <= v minus tombstones with version
<= v. Deletes of a commit are resolved against postings of *earlier* versions only, so they never
touch documents added by the same batch.

``view`` searches these tables as they are: postings of the versions less tombstones, and the sums of the
deltas as vocabulary and statistics, which are those of an index built anew over the live documents. So a
search after a commit writes no postings; ``snapshot`` compacts a version when it pays.
"""

from __future__ import annotations

import uuid
from dataclasses import dataclass

from pyspark.sql import Column, DataFrame, SparkSession, Window
from pyspark.sql import functions as F

from ..plans.schema import Schema
from ..session import bounded_broadcast, new_table_path, path_exists, spread, stored
from .index import (ALL_FIELD, TextIndex, corpus_postings, layout_for, numbered_ids, stats_of, term_bucket, write_ids,
                    write_postings, write_tables)

#: Hash buckets of the latest-change table; a batch reads and rewrites those that its keys fall into.
KEY_BUCKETS = 256
COMMIT_SCHEMA = ("attempt string, n_adds long, n_deletes long, stream_id string, batch_id long, term_buckets int, "
                 "key_buckets array<int>")


def dense_ids(df: DataFrame, start: int) -> DataFrame:
    """Consecutive internal ids ``start, start+1, ...`` without a single-task sort.

    The rows are written first, each with its place (file number and position), so that nothing is
    evaluated twice: counts per file become offsets, and an id is the file's offset plus the
    position. One small row per file is broadcast, after a check of their number."""
    path = new_table_path(df.sparkSession, "numbered")
    df.withColumn("_place", F.monotonically_increasing_id()).write.parquet(path)
    placed = df.sparkSession.read.parquet(path).withColumn("_part", F.shiftright("_place", 33))
    counts = placed.groupBy("_part").agg(F.count(F.lit(1)).alias("_n"))
    before = Window.orderBy("_part").rowsBetween(Window.unboundedPreceding, -1)
    offsets = counts.select("_part", F.coalesce(F.sum("_n").over(before), F.lit(0)).alias("_off"))
    position = F.col("_place") - F.shiftleft("_part", 33)
    return (placed.join(bounded_broadcast(offsets), "_part")
            .withColumn("doc_id", (F.lit(start) + F.col("_off") + position).cast("long"))
            .drop("_part", "_place", "_off"))


@dataclass
class VersionedIndex:
    """``extra`` names the columns of added documents that are kept with them but are no fields. The number
    of term buckets follows the first documents if it isn't given."""

    spark: SparkSession
    path: str
    schema: Schema
    term_buckets: int | None = None
    extra: tuple[str, ...] = ()

    @classmethod
    def create(cls, spark: SparkSession, schema: Schema, path: str | None = None,
               term_buckets: int | None = None, extra: tuple[str, ...] = ()) -> "VersionedIndex":
        return cls(spark, path or new_table_path(spark, "vindex"), schema, term_buckets, extra)

    # -- log readers -------------------------------------------------------------------
    def commits(self) -> DataFrame | None:
        p = f"{self.path}/commits"
        return self.spark.read.schema(f"{COMMIT_SCHEMA}, version int").parquet(p) if path_exists(self.spark, p) else None

    def _read(self, part: str) -> DataFrame | None:
        """The rows of a table that committed attempts wrote."""
        p, commits = f"{self.path}/{part}", self.commits()
        if commits is None or not path_exists(self.spark, p):
            return None
        done = bounded_broadcast(commits.select("version", "attempt"))
        return self.spark.read.parquet(p).join(done, ["version", "attempt"], "left_semi").drop("attempt")

    def last_version(self) -> int:
        """M5: the stamp of the last non-empty commit (0 when none)."""
        c = self.commits()
        return 0 if c is None else int(c.agg(F.max("version")).first()[0] or 0)

    def _buckets(self, adds: DataFrame | None) -> int:
        """The number of term buckets, the same for all versions."""
        if self.term_buckets is None:
            c = self.commits()
            first = None if c is None else c.orderBy("version").select("term_buckets").first()
            self.term_buckets = first[0] if first else layout_for(adds)[0] if adds is not None else 1
        return self.term_buckets

    def _total_adds(self) -> int:
        c = self.commits()
        return 0 if c is None else int(c.agg(F.sum("n_adds")).first()[0] or 0)

    def has_batch(self, batch_id: int, stream_id: str = "") -> bool:
        c = self.commits()
        return c is not None and c.filter((F.col("batch_id") == batch_id) & (F.col("stream_id") == stream_id)) \
            .limit(1).count() > 0

    # -- commit --------------------------------------------------------------------------
    def commit(self, adds: DataFrame | None = None, deletes: DataFrame | None = None,
               batch_id: int | None = None, stream_id: str = "", changes: DataFrame | None = None) -> int:
        """M1-M4: one version for a batch of deletes (``field``, ``term``) and adds."""
        if adds is not None:
            unknown = [c for c in adds.columns if c not in self.schema.names and c not in self.extra]
            if unknown:
                raise ValueError(f"field not found in schema: {', '.join(unknown)}")
        if deletes is not None:
            bad = deletes.select("field").distinct().filter(~F.col("field").isin(self.schema.names))
            if bad.limit(1).count() > 0:
                raise ValueError("field not found in schema")
        # a letter first: Spark reads the folder's name as a string, whatever the digits
        attempt, v = f"a-{uuid.uuid4().hex[:12]}", self.last_version() + 1
        buckets = self._buckets(adds)
        folder = lambda part: f"{self.path}/{part}/version={v}/attempt={attempt}"
        n_add = 0
        if adds is not None:
            dense_ids(adds, self._total_adds()).write.parquet(folder("adds"))
            written = self.spark.read.parquet(folder("adds"))
            n_add = written.count()
        n_del = deletes.count() if deletes is not None else 0
        if n_add == 0 and n_del == 0:
            return 0
        deltas = []
        if n_del:
            live = self._postings_upto(v - 1)
            if live is not None:
                d = stored(deletes.select("field", "term").distinct().withColumn("tb", term_bucket(F.col("term"), buckets)), "deletes")
                ids = live.join(bounded_broadcast(d), ["field", "tb", "term"], "left_semi").select("doc_id").distinct()
                ids.write.parquet(folder("tombstones"))
                # what the deleted documents held is found by analyzing them again, not in all postings
                ids = self.spark.read.schema("doc_id long").parquet(folder("tombstones"))
                gone = self.live_docs(v - 1).join(bounded_broadcast(ids), "doc_id", "left_semi")
                deltas.append(corpus_postings(gone, self.schema, "doc_id").select(
                    "field", "term", (-F.col("tf")).alias("tf"), F.lit(-1).alias("n")))
        if n_add:
            p = corpus_postings(spread(written), self.schema, "doc_id")
            (p.withColumn("tb", term_bucket(F.col("term"), buckets))
             .hint("rebalance", "field", "tb").sortWithinPartitions("field", "tb", "term", "doc_id")
             .write.partitionBy("field", "tb").parquet(folder("postings")))
            deltas.append(self.spark.read.parquet(folder("postings")).select("field", "term", "tf", F.lit(1).alias("n")))
        if deltas:
            both = deltas[0] if len(deltas) == 1 else deltas[0].unionByName(deltas[1])
            terms = stored(both.groupBy("field", "term").agg(F.sum("n").cast("long").alias("df"), F.sum("tf").cast("long").alias("tf")),
                           "deltas")
            (terms.filter("df <> 0").select("field", "term", "df", term_bucket(F.col("term"), buckets).alias("tb"))
             .write.partitionBy("tb").parquet(folder("vocab")))
            terms.groupBy("field").agg(F.sum("tf").alias("tf"), F.sum("df").alias("n")).coalesce(1).write.parquet(folder("stats"))
        touched = self._merge_changes(changes, folder("latest")) if changes is not None else None
        row = self.spark.createDataFrame([(attempt, n_add, n_del, stream_id, batch_id, buckets, touched)], COMMIT_SCHEMA)
        row.coalesce(1).write.parquet(f"{self.path}/commits/version={v}")
        return v

    # -- last changes per key --------------------------------------------------------------
    def _merge_changes(self, changes: DataFrame, folder: str) -> list[int]:
        """Write the buckets that ``changes`` (key, ts) fall into, each merged with what is known of it."""
        new = stored(changes.select("key", "ts", key_bucket(F.col("key")).alias("kb")), "changes")
        touched = [r["kb"] for r in new.select("kb").distinct().collect()]  # KEY_BUCKETS numbers at most
        if touched:
            known = self._latest(touched)
            rows = new if known is None else new.unionByName(known)
            (rows.groupBy("kb", "key").agg(F.max("ts").alias("ts")).repartition("kb").write.partitionBy("kb").parquet(folder))
        return sorted(touched)

    def _latest(self, buckets: list[int]) -> DataFrame | None:
        """(key, ts, kb) of the given buckets: of each, the folder of the last commit that wrote it."""
        c = self.commits()
        if c is None or not buckets:
            return None
        wrote = c.select("version", "attempt", F.explode("key_buckets").alias("kb")).filter(F.col("kb").isin(buckets))
        last = wrote.groupBy("kb").agg(F.max(F.struct("version", "attempt")).alias("w")).collect()
        paths = [f"{self.path}/latest/version={r['w']['version']}/attempt={r['w']['attempt']}/kb={r['kb']}" for r in last]
        if not paths:
            return None
        return self.spark.read.option("basePath", f"{self.path}/latest").parquet(*paths).select("key", "ts", F.col("kb").cast("int"))

    def last_changes(self, keys: DataFrame | None = None) -> DataFrame | None:
        """(key, ts): the last known change of every key, deletes included. With ``keys`` (key), only the
        buckets that these fall into are read."""
        buckets = list(range(KEY_BUCKETS)) if keys is None else [
            r["kb"] for r in keys.select(key_bucket(F.col("key")).alias("kb")).distinct().collect()]
        found = self._latest(buckets)
        return None if found is None else found.select("key", "ts")

    def replace(self, adds: DataFrame, key_field: str, key_col: str | None = None) -> int:
        """M3 convenience: delete every doc holding the added docs' key token, then add them."""
        key_col = key_col or key_field
        deletes = adds.select(F.lit(key_field).alias("field"), F.col(key_col).cast("string").alias("term"))
        return self.commit(adds, deletes)

    # -- snapshots -----------------------------------------------------------------------
    def _postings_upto(self, v: int) -> DataFrame | None:
        p = self._read("postings")
        if p is None:
            return None
        p = p.filter(F.col("version") <= v)
        t = self._tombstones_upto(v)
        return p if t is None else p.join(t, "doc_id", "left_anti")

    def _tombstones_upto(self, v: int) -> DataFrame | None:
        t = self._read("tombstones")
        # ids alone: broadcast within the bound, so that neither postings nor texts move to lose the deleted ones
        return None if t is None else bounded_broadcast(t.filter(F.col("version") <= v).select("doc_id").distinct())

    def live_docs(self, as_of: int | None = None) -> DataFrame:
        """M6: documents visible at version ``as_of`` (default: last)."""
        v = self.last_version() if as_of is None else as_of
        a = self._read("adds")
        if a is None:
            raise ValueError("empty index")
        a = a.filter(F.col("version") <= v)
        t = self._tombstones_upto(v)
        return a if t is None else a.join(t, "doc_id", "left_anti")

    def num_docs(self, as_of: int | None = None) -> DataFrame:
        """A5 over live documents."""
        return self.live_docs(as_of).agg(F.count(F.lit(1)).alias("num_docs"))

    def view(self, as_of: int | None = None) -> "VersionView":
        """The state at ``as_of``, searched as it lies."""
        return VersionView(self, self.last_version() if as_of is None else as_of)

    def snapshot(self, as_of: int | None = None, path: str | None = None) -> TextIndex:
        """Compact the live state at ``as_of`` into a plain index (statistics over live docs)."""
        v = self.last_version() if as_of is None else as_of
        docs = self.live_docs(v)
        index = TextIndex(self.spark, path or new_table_path(self.spark, "snapshot"), self.schema, self._buckets(None),
                          layout_for(docs)[1], "bigint")
        write_postings(self._postings_upto(v).repartition(index.doc_shards, "doc_id"), f"{index.path}/postings",
                       index.term_buckets, index.doc_shards)
        write_tables(index, docs.select("doc_id", *self.schema.kept, *self.extra))
        return index


@dataclass
class VersionView:
    """A version of a ``VersionedIndex`` with the reading side of a ``TextIndex``: merged on read."""

    log: VersionedIndex
    version: int

    @property
    def spark(self) -> SparkSession:
        return self.log.spark

    @property
    def schema(self) -> Schema:
        return self.log.schema

    @property
    def term_buckets(self) -> int:
        return self.log._buckets(None)

    def _deltas(self, part: str) -> DataFrame:
        rows = self.log._read(part)
        if rows is None:
            raise ValueError("empty index")
        return rows.filter(F.col("version") <= self.version)

    def postings(self) -> DataFrame:
        self._deltas("vocab")
        return self.log._postings_upto(self.version)

    def vocab(self) -> DataFrame:
        return (self._deltas("vocab").groupBy("field", "tb", "term").agg(F.sum("df").alias("df")).filter("df > 0"))

    def stats(self) -> DataFrame:
        per_field = self._deltas("stats").groupBy("field").agg(F.sum("tf").alias("total_tokens"), F.sum("n").alias("n_rows"))
        return stats_of(per_field, self.schema.names)

    def docs(self) -> DataFrame:
        return self.log.live_docs(self.version)

    def num_docs(self) -> DataFrame:
        return self.log.num_docs(self.version)

    def ids(self) -> DataFrame:
        path = new_table_path(self.spark, "ids")
        write_ids(self.docs(), path)
        return numbered_ids(self.spark.read.parquet(path))


def key_bucket(key: Column) -> Column:
    return F.pmod(F.xxhash64(key), F.lit(KEY_BUCKETS)).cast("int")


def delete_by_term(index: TextIndex, field: str, term: str) -> DataFrame:
    """M2 on a plain index: the documents left after removing every doc whose ``field``
    holds the exact (unanalyzed) token ``term``."""
    index.schema.field(field)
    p = index.postings().filter((F.col("field") == field) &
                                (F.col("tb") == F.pmod(F.xxhash64(F.lit(term)), F.lit(index.term_buckets)))
                                & (F.col("term") == term))
    return index.docs().join(p.select("doc_id"), "doc_id", "left_anti")


__all__ = ["VersionedIndex", "VersionView", "delete_by_term", "ALL_FIELD"]
