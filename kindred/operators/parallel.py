"""Parallelism helpers for CPU-heavy stages.

AQE sizes shuffle partitions by bytes, which is right for scans and joins but
wrong for stages whose cost is per-row CPU (shingle hashing, edit distances on
long text): a few MB of candidate pairs can hold minutes of work.  These helpers
pin an explicit partition count (``repartition(n, cols)`` is never coalesced by
AQE) computed from the session, so the same code fans out on a laptop and on a
1000-executor cluster.
"""

from __future__ import annotations

from pyspark.sql import DataFrame


def target_partitions(df: DataFrame) -> int:
    spark = df.sparkSession
    conf = int(spark.conf.get("spark.sql.shuffle.partitions", "200"))
    return max(conf, spark.sparkContext.defaultParallelism)


def spread(df: DataFrame, *cols: str) -> DataFrame:
    """Hash-partition ``df`` by ``cols`` over what the cluster can run at once,
    so that a small input read as one split still uses all cores."""
    return df.repartition(target_partitions(df), *cols)


def balance(df: DataFrame, *cols: str, tasks_per_core: int = 4) -> DataFrame:
    """Always hash-partition by unique ``cols`` so a CPU-heavy projection that
    follows is evenly spread whatever AQE decided for the shuffles before it.
    Per-row costs are heavy-tailed (edit distance grows with the product of the
    lengths), so there are several partitions per core: the scheduler hands the
    next partition to whichever core is free and stragglers even out."""
    spark = df.sparkSession
    n = max(target_partitions(df), tasks_per_core * spark.sparkContext.defaultParallelism)
    return df.repartition(n, *cols)
