"""The queries of this subpackage and their SQL."""

from __future__ import annotations

import os
from collections.abc import Callable
from functools import wraps

from pyspark.sql import DataFrame, SparkSession

from shelfspark.llm.alignment import op12_token_alignment
from shelfspark.llm.bpe import op5_bpe
from shelfspark.llm.contamination import OP13_SQL, op13_decontamination
from shelfspark.llm.isolation import op7_isolation_forest
from shelfspark.llm.languages import op3_language_id, op3_language_id_pages
from shelfspark.llm.licenses import op2_license_scan
from shelfspark.llm.ngram_join import OP1_SQL, op1_ngram_jaccard
from shelfspark.llm.packing import op8_best_fit_packing
from shelfspark.llm.prefix_trie import op11_prefix_trie
from shelfspark.llm.ranking import op4_quality_ranking
from shelfspark.llm.repeats import OP9_SQL, op9_substring_dedup
from shelfspark.llm.vectors import OP10_SQL, op10_embedding_dedup
from shelfspark.llm.warc import op6_warc_derivatives

ROOT = os.path.dirname(os.path.dirname(os.path.dirname(os.path.abspath(__file__))))


def _found(build: Callable[[SparkSession, str], DataFrame]) -> Callable[[SparkSession, str], DataFrame]:
    """Lets Python workers on this machine import the package where nothing else names its place."""

    @wraps(build)
    def run(spark: SparkSession, sf_dir: str) -> DataFrame:
        spark.sparkContext.environment.setdefault("PYTHONPATH", ROOT)
        return build(spark, sf_dir)

    return run


QUERIES = {
    "op1_ngram_jaccard": op1_ngram_jaccard,
    "op2_license_scan": op2_license_scan,
    "op3_language_id": op3_language_id,
    "op4_quality_ranking": op4_quality_ranking,
    "op5_bpe": op5_bpe,
    "op6_warc_derivatives": op6_warc_derivatives,
    "op7_isolation_forest": op7_isolation_forest,
    "op8_best_fit_packing": op8_best_fit_packing,
    "op9_substring_dedup": op9_substring_dedup,
    "op10_embedding_dedup": op10_embedding_dedup,
    "op11_prefix_trie": op11_prefix_trie,
    "op12_token_alignment": op12_token_alignment,
    "op13_decontamination": op13_decontamination,
}
QUERIES = {name: _found(build) for name, build in QUERIES.items()}
# Further queries of an operator, on other tables.
FURTHER = {"op3_language_id_pages": _found(op3_language_id_pages)}

SQL: dict[str, str] = {
    "op1_ngram_jaccard": OP1_SQL,
    "op9_substring_dedup": OP9_SQL,
    "op10_embedding_dedup": OP10_SQL,
    "op13_decontamination": OP13_SQL,
}
