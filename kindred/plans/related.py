"""The related-ID pipeline as one job.

reviewed rows --W1 forward fill--> edges (kind, id, similar id) --G1--> groups
--A4/A5 summary--> --G2 drop largest--> --O6 flat list--> --P16 exclusions-->
"""

from __future__ import annotations

from pyspark.sql import DataFrame
from pyspark.sql import functions as F

from kindred.operators.fill import forward_fill, sequential_ids
from kindred.operators.graph import connected_components, drop_largest

FILL_COLS = ("id", "value", "kind", "check_admin")


def fill_reviewed(rows: DataFrame, pos: str = "pos") -> DataFrame:
    return forward_fill(rows, FILL_COLS, pos=pos)


def filled_counts(filled: DataFrame) -> DataFrame:
    """Number of filled values per field."""
    return filled.agg(*[F.sum(F.col(f"filled_{c}").cast("long")).alias(f"filled_{c}") for c in FILL_COLS])


def related_groups(filled: DataFrame, sim_col: str = "sim_id") -> DataFrame:
    """G1 over the reviewed rows: edges ``id -- sim_id`` inside each kind."""
    edges = filled.select("kind", F.col("id").alias("src"), F.col(sim_col).alias("dst"))
    return connected_components(edges)


def group_summary(filled: DataFrame, comps: DataFrame) -> DataFrame:
    """A4: per kind (every kind of the input) groups and ids; the row with a
    null kind is the total over all kinds (``rollup``)."""
    per = comps.groupBy("kind").agg(F.count_distinct("component").alias("related_groups"),
                                    F.count(F.lit(1)).alias("total_related_ids"))
    kinds = filled.filter(F.col("kind").isNotNull()).select("kind").distinct()
    full = kinds.join(per, "kind", "left").na.fill(0, ["related_groups", "total_related_ids"])
    return full.rollup("kind").agg(F.sum("related_groups").cast("long").alias("related_groups"),
                                   F.sum("total_related_ids").cast("long").alias("total_related_ids"),
                                   F.count(F.lit(1)).cast("long").alias("kinds"))


def top_kinds(filled: DataFrame, comps: DataFrame, k: int = 5) -> DataFrame:
    """A5: the ``k`` kinds with most groups; ties keep first-appearance order;
    kinds without groups are not listed."""
    first = filled.filter(F.col("kind").isNotNull()).groupBy("kind").agg(F.min("pos").alias("first_pos"))
    per = comps.groupBy("kind").agg(F.count_distinct("component").alias("related_groups"))
    j = per.join(first, "kind").filter(F.col("related_groups") > 0)
    return j.orderBy(F.desc("related_groups"), "first_pos").limit(k).select("kind", "related_groups")


def exclude_ids(df: DataFrame, exceptions: DataFrame, col: str = "id") -> DataFrame:
    """Drop rows whose id is on the exception list (anti join; AQE turns it
    into a broadcast only when the list is measured small)."""
    ex = exceptions.select(F.col(exceptions.columns[0]).cast("long").alias(col)).distinct()
    return df.join(ex, col, "left_anti")


def flat_ids(kept: DataFrame, filled: DataFrame) -> DataFrame:
    """Kept ids ``(kind, component, id)`` as one flat list with ``position``
    from 0: kinds in first-appearance order, groups by smallest id, ids ascending."""
    first = filled.filter(F.col("kind").isNotNull()).groupBy("kind").agg(F.min("pos").alias("kind_pos"))
    return sequential_ids(kept.join(first, "kind"), ["kind_pos", "component", "id"], 0,
                          out="position").drop("kind_pos")


def related_pipeline(rows: DataFrame, exceptions: DataFrame) -> DataFrame:
    """Reviewed rows -> kept ids ``(kind, component, id, position)``."""
    filled = fill_reviewed(rows)
    comps = related_groups(filled)
    kept = drop_largest(comps)
    return flat_ids(exclude_ids(kept, exceptions), filled)
