"""Connected components of ID edges inside each kind, and the
"drop the largest id of every group" dedup decision.

Components use the alternating large-star / small-star rounds of Kiveris et
al., "Connected Components in MapReduce and Beyond" (SoCC 2014): every round is
one aggregation (minimum neighbour per node) and one join, the edge count never
grows, and the number of rounds is logarithmic in the component size.  Edges
are stored directed from the larger to the smaller id, so the per-node minimum
is a plain ``groupBy(kind, src).min(dst)`` - no adjacency list is ever
collected, and a node with a huge degree is just a skewed join key that AQE
splits.  The edge table is written to the reliable checkpoint folder after each
round so the lineage stays one round deep and survives executor loss.
"""

from __future__ import annotations

from pyspark.sql import DataFrame
from pyspark.sql import functions as F

from kindred.session import cut_lineage


def _normalise(edges: DataFrame) -> DataFrame:
    """``(kind, src, dst)`` with ``src > dst``; falsy ids, self loops and rows
    without kind dropped; duplicates removed."""
    e = edges.select("kind", F.col("src").cast("long").alias("a"), F.col("dst").cast("long").alias("b"))
    e = e.filter(F.col("kind").isNotNull() & (F.coalesce(F.col("a"), F.lit(0)) != 0)
                 & (F.coalesce(F.col("b"), F.lit(0)) != 0) & (F.col("a") != F.col("b")))
    return e.select("kind", F.greatest("a", "b").alias("src"), F.least("a", "b").alias("dst")).distinct()


def _min_neighbour(e: DataFrame) -> DataFrame:
    return e.groupBy("kind", "src").agg(F.min("dst").alias("m"))


def _large_star(e: DataFrame) -> DataFrame:
    # each edge is handled at its smaller end y: connect x to m(y) = min(y, N<(y))
    m = _min_neighbour(e).withColumnRenamed("src", "dst")
    j = e.join(m, ["kind", "dst"], "left")
    return j.select("kind", "src", F.coalesce(F.col("m"), F.col("dst")).alias("dst")).distinct()


def _small_star(e: DataFrame) -> DataFrame:
    # at every node x: connect x and its smaller neighbours to the smallest one
    m = _min_neighbour(e)
    j = e.join(m, ["kind", "src"])
    out = j.select("kind", F.when(F.col("dst") == F.col("m"), F.col("src")).otherwise(F.col("dst")).alias("src"),
                   F.col("m").alias("dst"))
    return out.filter(F.col("src") != F.col("dst")).distinct()


def _is_star_forest(e: DataFrame) -> bool:
    """True when every source has one target and no target is a source: then
    each component is a star around its minimum id."""
    multi = e.groupBy("kind", "src").agg(F.count(F.lit(1)).alias("n")).filter("n > 1").limit(1).count()
    if multi:
        return False
    targets = e.select("kind", F.col("dst").alias("src")).distinct()
    return targets.join(e.select("kind", "src"), ["kind", "src"], "left_semi").limit(1).count() == 0


def connected_components(edges: DataFrame) -> DataFrame:
    """``edges(kind, src, dst)`` -> ``(kind, id, component)`` where component is
    the smallest id of the connected group; only ids with at least one edge."""
    e = cut_lineage(_normalise(edges))
    while True:  # every round shrinks the forest's depth; ends with stars
        e = cut_lineage(_small_star(_large_star(e)))
        if _is_star_forest(e):
            break
    members = e.select("kind", F.col("src").alias("id"), F.col("dst").alias("component"))
    roots = e.select("kind", F.col("dst").alias("id"), F.col("dst").alias("component")).distinct()
    return members.unionByName(roots)


def drop_largest(components: DataFrame) -> DataFrame:
    """In every group of more than one id remove (all copies of) the largest
    id; singleton groups stay."""
    stats = components.groupBy("kind", "component").agg(
        F.max("id").alias("_max"), F.count_distinct("id").alias("_n"))
    j = components.join(stats, ["kind", "component"])
    return j.filter((F.col("id") != F.col("_max")) | (F.col("_n") == 1)).drop("_max", "_n")
