"""Query validation (P11) as joins over the clause table: one bad query never fails a batch."""

from __future__ import annotations

from pyspark.sql import DataFrame
from pyspark.sql import functions as F
from pyspark.sql import Window

from ..plans.schema import RECORD_POSITIONS
from ..session import materialize
from .index import TextIndex
from .search import slot_counts


def query_rejects(index: TextIndex, flat: DataFrame, specs: DataFrame | None = None) -> DataFrame:
    """rejects(qid, reason) for flattened specs (``clauses.flatten_specs``).

    A clause that can't be read (missing or invalid modifier, type, subqueries, boost) rejects
    its spec before anything else, as does a tree deeper than the parser's limit. Then the first
    error in depth-first clause order wins, as in a recursive conversion: field index, text index,
    field name, and a phrase on a field that keeps no positions.
    A query without errors whose top level keeps no usable clause is rejected with
    ``No usable clauses in query`` (empty Should/MustNot leaves and groups are dropped,
    empty Must clauses stay as match-nothing clauses).
    """
    names = index.schema.names
    flat = flat0 = materialize(flat)  # small, and read many times below
    # checked first: a spec without fields or texts is only valid with a match-all somewhere
    per_q = flat.groupBy("qid").agg(F.min(F.least("n_fields", "n_texts")).alias("m"),
                                    F.max((F.col("kind") == "all").cast("int")).alias("has_all"))
    w = Window.partitionBy("qid").orderBy("path")
    unread = (flat.filter(F.col("error").isNotNull() & ~F.col("error").isin("Invalid field index", "Invalid text index"))
              .withColumn("_r", F.row_number().over(w)).filter("_r = 1").select("qid", F.col("error").alias("reason")))
    flat = flat.join(unread.select("qid"), "qid", "left_anti")
    empty = (per_q.join(unread.select("qid"), "qid", "left_anti").filter((F.col("m") <= 0) & (F.col("has_all") == 0))
             .select("qid", F.lit("Fields or texts cannot be empty").alias("reason")))
    flat = flat.join(empty.select("qid"), "qid", "left_anti").drop("n_fields", "n_texts")
    leaf = ~F.col("kind").isin("bool", "all")
    flat = flat.join(slot_counts(index, flat.filter(F.col("error").isNull())).withColumnRenamed("n_slots", "n"),
                     ["qid", "clause_id"], "left")
    bare = [f.name for f in index.schema.fields if f.record < RECORD_POSITIONS]
    no_positions = F.col("kind").isin("phrase", "phrase_prefix") & F.col("field").isin(bare) & (F.col("n") > 1) \
        if bare else F.lit(False)
    errs = flat.withColumn("error", F.coalesce(
        F.col("error"),
        F.when(leaf & F.col("field").isNotNull() & ~F.col("field").isin(names), F.lit("Invalid field name"))
        .when(no_positions, F.lit("Field does not have positions indexed")))).drop("n")
    flat = flat.drop("n")
    first = (errs.filter(F.col("error").isNotNull())
             .withColumn("_r", F.row_number().over(w)).filter(F.col("_r") == 1)
             .select("qid", F.col("error").alias("reason")))
    ok = materialize(flat.join(first.select("qid"), "qid", "left_anti").drop("error", "path"))
    # usable clauses, bottom-up
    counts = slot_counts(index, ok)
    nodes = ok.join(counts, ["qid", "clause_id"], "left").fillna(0, ["n_slots"])
    usable = nodes.withColumn("usable", (F.col("kind") == "all") | (F.col("modifier") == "must") |
                              ((F.col("kind") != "bool") & (F.col("n_slots") > 0)))
    # the clauses of a query in one row, the deepest first: a usable one makes its group usable
    node = F.struct((-F.col("depth")).alias("order"), F.col("clause_id").alias("id"), F.col("parent_id").alias("p"),
                    "usable", (F.col("kind") == "bool").alias("group"))

    def step(acc, n):
        good = n["usable"] | (n["group"] & F.array_contains(acc, n["id"]))
        return F.when(good, F.array_union(acc, F.array(n["p"]))).otherwise(acc)

    useful = F.aggregate("nodes", F.array().cast("array<int>"), step)
    top = (usable.groupBy("qid").agg(F.sort_array(F.collect_list(node)).alias("nodes"))
           .select("qid", F.array_contains(useful, 0).cast("int").alias("u")))
    none = (ok.select("qid").distinct().join(top, "qid", "left")
            .filter(F.coalesce(F.col("u"), F.lit(0)) == 0)
            .select("qid", F.lit("No usable clauses in query").alias("reason")))
    out = unread.unionByName(empty).unionByName(first).unionByName(none)
    if specs is not None:  # specs whose tree has no clause at all, or was too deep to be read
        rest = specs.join(flat0.select(F.col("qid").alias("_q")).distinct(), F.col("qid") == F.col("_q"), "left_anti")
        deep = F.col("too_deep") if "too_deep" in specs.columns else F.lit(False)
        out = out.unionByName(rest.select(F.col("qid").cast("long").alias("qid"), F.when(
            deep, F.lit("Query nested too deeply")).otherwise(F.lit("No usable clauses in query")).alias("reason")))
    return out
