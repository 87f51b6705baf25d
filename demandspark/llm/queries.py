"""Registered queries of the corpus operators, and SQL where it can express them."""

from __future__ import annotations

from collections.abc import Callable

from pyspark.sql import DataFrame, SparkSession

from demandspark.llm.bpe import op7_byte_bpe
from demandspark.llm.exact import OP9_SQL, op9_exact_dedup
from demandspark.llm.imatch import op8_imatch_fingerprints
from demandspark.llm.isolation import op12_quality_rules
from demandspark.llm.jaccard import op5_jaccard_join
from demandspark.llm.langid import op10_language_id
from demandspark.llm.merkle import OP13_SQL, op13_merkle_manifest
from demandspark.llm.orchard import OP11_SQL, op11_centroid_clustering
from demandspark.llm.packing import op4_best_fit_packing
from demandspark.llm.sharding import op6_sharding
from demandspark.llm.suffixes import op3_suffix_dedup
from demandspark.llm.toxicity import op1_toxicity
from demandspark.llm.warc import op2_warc

QUERIES: dict[str, Callable[[SparkSession, str], DataFrame]] = {
    "op1_toxicity": op1_toxicity,
    "op2_warc": op2_warc,
    "op3_suffix_dedup": op3_suffix_dedup,
    "op4_best_fit_packing": op4_best_fit_packing,
    "op5_jaccard_join": op5_jaccard_join,
    "op6_sharding": op6_sharding,
    "op7_byte_bpe": op7_byte_bpe,
    "op8_imatch_fingerprints": op8_imatch_fingerprints,
    "op9_exact_dedup": op9_exact_dedup,
    "op10_language_id": op10_language_id,
    "op11_centroid_clustering": op11_centroid_clustering,
    "op12_quality_rules": op12_quality_rules,
    "op13_merkle_manifest": op13_merkle_manifest,
}

SQL: dict[str, str] = {"op9_exact_dedup": OP9_SQL, "op11_centroid_clustering": OP11_SQL,
                       "op13_merkle_manifest": OP13_SQL}
