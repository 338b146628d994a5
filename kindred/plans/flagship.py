"""Flagship query: which documents have near copies in their block, and how close.

documents -> block (lang, source) -> P3 normalisation of the whole text -> SimHash
-> LSH bands -> Hamming gate -> exact edit-distance score >= 75 -> per document
the number of near copies and the best one.
"""

from __future__ import annotations

from pyspark.sql import DataFrame, SparkSession

from kindred.operators.report import match_summary
from kindred.operators.simjoin import near_duplicates_lsh
from kindred.plans.fixtures import fx_docs

THRESHOLD = 75.0
BITS, BANDS = 64, 16


def near_copy_summary(spark: SparkSession, sf_dir: str) -> DataFrame:
    rows = fx_docs(spark, sf_dir)
    summary = match_summary(near_duplicates_lsh(rows, THRESHOLD, BITS, BANDS))
    return summary.join(rows.select("kind", "id", "check_admin"), ["kind", "id"]).select(
        "kind", "id", "check_admin", "n_matches", "best_sim_id", "best_score")
