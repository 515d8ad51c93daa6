"""Registered queries of the training-data operators and their SQL."""

from __future__ import annotations

import os
from collections.abc import Callable

from pyspark.sql import DataFrame, SparkSession

from strata.llm import ann, decontamination, html, jaccard, language, lines, manifest, packing, pii, prefix_trie, sharding, suffix, toxicity

ROOT = os.path.dirname(os.path.dirname(os.path.dirname(os.path.abspath(__file__))))


def workers_import(spark: SparkSession) -> None:
    """Let Python workers of a local session import this package wherever the driver was started.

    On a cluster the package is shipped with the job (``--py-files``) or installed.
    """
    paths = [p for p in spark.sparkContext.environment.get("PYTHONPATH", "").split(os.pathsep) if p]
    if ROOT not in paths:
        spark.sparkContext.environment["PYTHONPATH"] = os.pathsep.join([ROOT, *paths])


def _ready(query: Callable[[SparkSession, str], DataFrame]) -> Callable[[SparkSession, str], DataFrame]:
    def run(spark: SparkSession, sf_dir: str) -> DataFrame:
        workers_import(spark)
        return query(spark, sf_dir)

    return run


def registry() -> dict[str, Callable[[SparkSession, str], DataFrame]]:
    """The queries opN_<name>, by name."""
    queries = {
        "op1_benchmark_decontamination": decontamination.op1_benchmark_decontamination,
        "op2_ngram_jaccard_join": jaccard.op2_ngram_jaccard_join,
        "op3_html_extraction": html.op3_html_extraction,
        "op4_nearest_neighbours": ann.op4_nearest_neighbours,
        "op5_toxicity": toxicity.op5_toxicity,
        "op6_suffix_array_dedup": suffix.op6_suffix_array_dedup,
        "op7_sharding": sharding.op7_sharding,
        "op8_best_fit_packing": packing.op8_best_fit_packing,
        "op9_line_dedup": lines.op9_line_dedup,
        "op10_pii": pii.op10_pii,
        "op11_merkle_manifest": manifest.op11_merkle_manifest,
        "op12_prefix_trie": prefix_trie.op12_prefix_trie,
        "op13_language": language.op13_language,
    }
    return {name: _ready(q) for name, q in queries.items()}


def oracle() -> dict[str, str]:
    """DuckDB SQL of the queries that SQL can express."""
    return {"op1_benchmark_decontamination": decontamination.ORACLE_SQL, "op11_merkle_manifest": manifest.ORACLE_SQL,
            "op12_prefix_trie": prefix_trie.ORACLE_SQL}
