"""The registered queries of this subpackage and their DuckDB SQL."""

from __future__ import annotations

from collections.abc import Callable

from pyspark.sql import DataFrame, SparkSession

from .centroids import OP12_SQL, op12_centroid_clustering
from .chat import OP1_SQL, op1_chat_formatting
from .decontaminate import op6_decontamination
from .mixing import op3_mixing
from .ngram_join import op2_ngram_jaccard_join
from .quality import op5_quality_rules
from .repeats import op10_substring_dedup
from .sharding import op9_sharding
from .simhash import op11_simhash_dedup
from .token_counts import op4_token_counts
from .token_files import op7_token_files
from .toxicity import op8_toxicity
from .whitening import op13_embedding_whitening

QUERIES: dict[str, Callable[[SparkSession, str], DataFrame]] = {
    "op1_chat_formatting": op1_chat_formatting,
    "op2_ngram_jaccard_join": op2_ngram_jaccard_join,
    "op3_mixing": op3_mixing,
    "op4_token_counts": op4_token_counts,
    "op5_quality_rules": op5_quality_rules,
    "op6_decontamination": op6_decontamination,
    "op7_token_files": op7_token_files,
    "op8_toxicity": op8_toxicity,
    "op9_sharding": op9_sharding,
    "op10_substring_dedup": op10_substring_dedup,
    "op11_simhash_dedup": op11_simhash_dedup,
    "op12_centroid_clustering": op12_centroid_clustering,
    "op13_embedding_whitening": op13_embedding_whitening,
}
ORACLE_SQL: dict[str, str] = {
    "op1_chat_formatting": OP1_SQL,
    "op12_centroid_clustering": OP12_SQL,
}
