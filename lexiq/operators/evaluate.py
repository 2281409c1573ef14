"""Retrieval evaluation (E1-E7) as joins and aggregates over results and judgements."""

from __future__ import annotations

from pyspark.sql import DataFrame
from pyspark.sql import functions as F


def judged_pairs(topics: DataFrame, judgements: DataFrame, min_grade: float | None = None) -> DataFrame:
    """E6 as rows (qid, doc_id): the judgements of the given topics, repeats kept."""
    j = judgements
    if min_grade is not None:
        j = j.filter(F.col("grade").cast("double") >= F.lit(min_grade))
    return j.join(topics.select("qid").distinct(), "qid", "left_semi").select("qid", "doc_id")


def judged_set(topics: DataFrame, judgements: DataFrame, min_grade: float | None = None) -> DataFrame:
    """topics(qid, text) JOIN judgements(qid, doc_id[, grade]); unjudged topics dropped;
    the grade is ignored unless ``min_grade`` is given."""
    j = judgements
    if min_grade is not None:
        j = j.filter(F.col("grade").cast("double") >= F.lit(min_grade))
    rel = j.groupBy("qid").agg(F.collect_list("doc_id").alias("relevant_docs"))
    return topics.join(rel, "qid", "inner").select("qid", "text", "relevant_docs")


def qrels_of(judged: DataFrame) -> DataFrame:
    return judged.select("qid", F.explode("relevant_docs").alias("doc_id"))


def ideal_dcg(n_rel, k: int):
    """sum_{i=1..min(k, n_rel)} 1/log2(i+1)."""
    return F.when(n_rel > 0, F.aggregate(
        F.sequence(F.lit(1), F.least(F.lit(k), n_rel).cast("int")), F.lit(0.0),
        lambda acc, i: acc + F.lit(1.0) / F.log2(i + 1))).otherwise(F.lit(0.0))


def per_query_metrics(queries: DataFrame, results: DataFrame, qrels: DataFrame, k: int,
                      nan_compat: bool = False) -> DataFrame:
    """E1-E4 for every query in ``queries(qid)``.

    precision = hits in the first k' / k', k' = min(k, retrieved) (NULL when nothing was
    retrieved, NaN with ``nan_compat``); recall = hits / |relevant| counting duplicates (0
    when none); DCG with binary gain 1/log2(rank+1); nDCG = DCG / ideal DCG (0 when ideal 0).
    """
    rel_set = qrels.select("qid", "doc_id").distinct().withColumn("rel", F.lit(1))
    n_rel = qrels.groupBy("qid").agg(F.count(F.lit(1)).alias("n_rel"))
    top = results.filter(F.col("rank") <= k).select("qid", "rank", "doc_id")
    scored = top.join(rel_set, ["qid", "doc_id"], "left").fillna(0, ["rel"])
    per = scored.groupBy("qid").agg(
        F.count(F.lit(1)).alias("retrieved"), F.sum("rel").alias("hits"),
        F.sum(F.col("rel") / F.log2(F.col("rank") + 1)).alias("dcg"))
    base = queries.select("qid").distinct().join(per, "qid", "left").join(n_rel, "qid", "left") \
        .fillna(0, ["retrieved", "hits", "n_rel"]).fillna(0.0, ["dcg"])
    empty = F.lit(float("nan")) if nan_compat else F.lit(None).cast("double")
    precision = F.when(F.col("retrieved") > 0, F.col("hits") / F.col("retrieved")).otherwise(empty)
    recall = F.when(F.col("n_rel") > 0, F.col("hits") / F.col("n_rel")).otherwise(F.lit(0.0))
    idcg = ideal_dcg(F.col("n_rel"), k)
    return base.select("qid", precision.alias("precision"), recall.alias("recall"), F.col("dcg"),
                       F.when(idcg > 0, F.col("dcg") / idcg).otherwise(F.lit(0.0)).alias("ndcg"))


def mean_metrics(per_query: DataFrame) -> DataFrame:
    """E5: arithmetic means over all queries; a query without results adds no precision but counts."""
    return per_query.agg((F.coalesce(F.sum("precision"), F.lit(0.0)) / F.count(F.lit(1))).alias("mean_precision"),
                         F.avg("recall").alias("mean_recall"),
                         F.avg("dcg").alias("mean_dcg"), F.avg("ndcg").alias("mean_ndcg"))


def compare_methods(queries: DataFrame, runs: dict[str, DataFrame], qrels: DataFrame, k: int) -> DataFrame:
    """The same metrics for several retrieval methods, one row per method."""
    out = None
    for name, res in runs.items():
        m = mean_metrics(per_query_metrics(queries, res, qrels, k)).withColumn("method", F.lit(name))
        out = m if out is None else out.unionByName(m)
    return out.select("method", "mean_precision", "mean_recall", "mean_dcg", "mean_ndcg")
