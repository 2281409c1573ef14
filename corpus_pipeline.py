"""Corpus pipeline: the stages of STAGES, applied to ``documents`` in order.

Every stage takes (spark, docs, sf_dir) and returns a DataFrame; ``run`` writes it as Parquet into
the shared folder and reads it back as the next stage's ``docs``. All but the last return the
columns of ``documents``; the last returns the digests of the token files that it wrote.

Null and empty texts fail the quality rules, so no later stage sees them (alone, the later stages keep
them: they link with nothing, hold no item and are drawn by no mix). A null id is kept as it is and
counts as larger than any other. Rows that repeat are rows of their own until the join keeps one of
them. An empty table gives an empty result in every stage. A stage selects the columns of ``documents``;
other columns of its input, also those named like a column that an operator adds, are dropped.
"""

from __future__ import annotations

from collections.abc import Callable

from pyspark.sql import DataFrame, SparkSession
from pyspark.sql import functions as F

from lexiq.llm.common import documents, lean, stored
from lexiq.llm.decontaminate import without_leaks
from lexiq.llm.mixing import mixed_documents
from lexiq.llm.ngram_join import one_of_each
from lexiq.llm.quality import quality_rules, trusted_ids
from lexiq.llm.token_files import digests, read, token_files

COLUMNS = ["doc_id", "text", "lang", "source", "n_chars"]


Stage = Callable[[SparkSession, DataFrame, str], DataFrame]


def bounded(stage: Stage) -> Stage:
    """The stage on the columns of documents, its texts in small batches."""
    def run_stage(spark: SparkSession, docs: DataFrame, sf_dir: str) -> DataFrame:
        lean(spark)
        return stage(spark, docs.select(*COLUMNS), sf_dir)

    return run_stage


def keep_good(spark: SparkSession, docs: DataFrame, sf_dir: str) -> DataFrame:
    """Quality rules: rejected documents go."""
    return quality_rules(docs, trusted_ids(spark, sf_dir)).filter("kept").select(*COLUMNS)


def drop_near_copies(spark: SparkSession, docs: DataFrame, sf_dir: str) -> DataFrame:
    """N-gram Jaccard join: the document with the smallest id of each component stays."""
    return one_of_each(docs).select(*COLUMNS)


def drop_leaks(spark: SparkSession, docs: DataFrame, sf_dir: str) -> DataFrame:
    """Decontamination: documents that hold a benchmark item go."""
    return without_leaks(docs, spark.read.parquet(f"{sf_dir}/benchmark.parquet")).select(*COLUMNS)


def mix_sources(spark: SparkSession, docs: DataFrame, sf_dir: str) -> DataFrame:
    """Mixing: a row for every time the mix takes a document, cut where it takes a part."""
    return mixed_documents(docs).withColumn("n_chars", F.length("text").cast("long")).select(*COLUMNS)


def write_tokens(spark: SparkSession, docs: DataFrame, sf_dir: str) -> DataFrame:
    """Token output: token files of the mix, read back as one row of digests per document."""
    import public_tokenizers
    return digests(read(spark, token_files(docs, public_tokenizers.path("word_bpe_49k.json"))))


STAGES: list[tuple[str, Stage]] = [
    ("quality_rules", bounded(keep_good)),
    ("ngram_jaccard_join", bounded(drop_near_copies)),
    ("benchmark_decontamination", bounded(drop_leaks)),
    ("mixing", bounded(mix_sources)),
    ("token_output", bounded(write_tokens)),
]

#: The stages hash, fit and draw; SQL can't express them. Tests compare them with brute force.
ORACLE_SQL: str | None = None


def run(spark: SparkSession, sf_dir: str) -> DataFrame:
    docs = documents(spark, sf_dir)
    for name, stage in STAGES:
        docs = stored(stage(spark, docs, sf_dir), name, None)
    return docs
