"""Operators for training-data corpora: classification, search, near-duplicates, packing, tokens, licences, language models.

Nothing else in the library imports this subpackage.
"""

from __future__ import annotations

from collections.abc import Callable

from pyspark.sql import DataFrame, SparkSession

from . import katz, kmtree, language_id, lattice, licenses, minhash, packing, quality, sentencepieces, toxicity


def queries() -> dict[str, Callable[[SparkSession, str], DataFrame]]:
    """The operators over their whole tables, with production parameters."""
    return {
        "op1_language_id": language_id.query,
        "op2_kmeans_tree": kmtree.query,
        "op3_sentencepiece": sentencepieces.query,
        "op4_toxicity": toxicity.query,
        "op5_lattice": lattice.query,
        "op6_minhash": minhash.query,
        "op7_packing": packing.query,
        "op8_quality": quality.query,
        "op9_licenses": licenses.query,
        "op10_katz": katz.query,
    }


def oracle_sql() -> dict[str, str]:
    """DuckDB SQL of those that SQL can express."""
    return {"op5_lattice": lattice.SQL, "op6_minhash": minhash.SQL}
