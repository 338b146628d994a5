"""Near-dedup of embeddings: spherical k-means cells, blocked cosine products.

Centroids are fitted on a bounded sample; every vector belongs to its nearest
cell and also visits the cells whose border it is close to, so pairs that a
border separates are found.  A cell is dealt over tiles of bounded size, and a
task multiplies two tiles.  It returns, per vector, the number of links and a
spanning forest of the linked pairs, not the pairs.  A pair that two cells see
is counted in one of them.  Exact copies are collapsed before, with their
number as a weight.
"""

from __future__ import annotations

import numpy as np
import pandas as pd
from pyspark.sql import Column, DataFrame
from pyspark.sql import functions as F

from kindred.llm.common import components, materialise, union_find

#: Vectors of which the centroids are fitted; vectors a cell; largest number of cells.
SAMPLE, CELL, MAX_CELLS = 50_000, 1024, 4096
TILE = 2048
#: How far apart, in standard deviations of a pair at the threshold, the two
#: vectors may lie across a border; either of them needs to come within half.  The
#: deviation towards a neighbour cell follows from the spread of the sample inside its
#: cells, so vectors that fill few of their dimensions reach as far as they must; no
#: pair can lie farther apart than its own distance, which bounds the slack.
BORDER = 3.5
ROUNDS = 8


def spherical_kmeans(x: np.ndarray, k: int, seed: int = 5) -> np.ndarray:
    """Unit centroids of unit vectors by Lloyd's rounds on cosines."""
    rng = np.random.default_rng(seed)
    c = x[rng.choice(len(x), size=k, replace=False)]
    for _ in range(ROUNDS):
        at = np.concatenate([np.argmax(x[i:i + 8192] @ c.T, axis=1) for i in range(0, len(x), 8192)])
        sums = np.zeros_like(c)
        np.add.at(sums, at, x)
        norm = np.linalg.norm(sums, axis=1, keepdims=True)
        c = np.where(norm > 0, sums / np.maximum(norm, 1e-300), c)
    return c


def is_valid(vector: str = "embedding") -> Column:
    """A vec_id, and finite components of which one is not zero."""
    fine = F.forall(vector, lambda e: e.isNotNull() & ~F.isnan(e) & (F.abs(e) < float("inf"))) & F.exists(vector, lambda e: e != 0)
    return F.col("vec_id").isNotNull() & F.col(vector).isNotNull() & F.coalesce(fine, F.lit(False))


def _unit(column: pd.Series) -> np.ndarray:
    x = np.array(column.tolist(), dtype=np.float64)
    x = x / np.abs(x).max(axis=1, keepdims=True)
    return x / np.linalg.norm(x, axis=1, keepdims=True)


def inner_spread(x: np.ndarray, c: np.ndarray) -> np.ndarray:
    """Covariance of the vectors about their centroids, as shares of its trace."""
    d = x.shape[1]
    total = np.zeros((d, d))
    for lo in range(0, len(x), 8192):
        part = x[lo:lo + 8192]
        rest = part - c[np.argmax(part @ c.T, axis=1)]
        total += rest.T @ rest
    trace = np.trace(total)
    return total / trace if trace > 0 else np.eye(d) / d


def border_slack(c: np.ndarray, spread: np.ndarray, threshold: float) -> np.ndarray:
    """How much nearer to its own centroid i than to centroid j a vector may be when it
    has to visit cell j, for all i and j."""
    def between(m):
        q = np.einsum("id,de,ie->i", c, m, c)
        return np.sqrt(np.maximum(0, q[:, None] + q - 2 * c @ m @ c.T))

    reach = np.sqrt(2 - 2 * threshold) / 2
    return reach * np.minimum(BORDER * between(spread), between(np.eye(c.shape[1])))


def _assign(shared, threshold):
    def run(batches):
        for pdf in batches:
            centroids, slack = shared.value
            owner = -pdf["dim"].to_numpy(dtype=np.int64)
            visits = [[] for _ in range(len(pdf))]
            rows = np.flatnonzero(pdf["dim"].to_numpy() == centroids.shape[1]) if len(centroids) else []
            if len(rows):
                x = _unit(pdf["v"].iloc[rows])
                for lo in range(0, len(rows), 1024):
                    s = x[lo:lo + 1024] @ centroids.T
                    best = s.argmax(axis=1)
                    gap = s[np.arange(len(s)), best][:, None] - s
                    near = gap <= slack[best]
                    near[np.arange(len(s)), best] = False
                    for i in range(len(s)):
                        owner[rows[lo + i]] = best[i]
                        visits[rows[lo + i]] = np.flatnonzero(near[i]).tolist()
            yield pd.DataFrame({"id": pdf["id"], "copies": pdf["copies"], "v": pdf["v"], "owner": owner, "visits": visits})
    return run


def _compare(threshold: float):
    """One tile pair of one cell -> (a, b, n): n > 0 counts links of a; b is a forest edge."""

    def run(pdf: pd.DataFrame) -> pd.DataFrame:
        cell, ti, tj = (int(pdf[c].iloc[0]) for c in ("cell", "ti", "tj"))
        x = _unit(pdf["v"])
        ids, copies = pdf["id"].to_numpy(), pdf["copies"].to_numpy()
        owner, tile = pdf["owner"].to_numpy(), pdf["tile"].to_numpy()
        width = max(1, pdf["visits"].map(len).max())
        visits = np.full((len(pdf), width), -1, dtype=np.int64)
        for i, v in enumerate(pdf["visits"]):
            visits[i, :len(v)] = v
        links = np.zeros(len(pdf), dtype=np.int64)
        left, right = [], []
        rows = np.flatnonzero(tile == ti)
        cols = np.flatnonzero(tile == tj)
        for lo in range(0, len(rows), 512):
            r = rows[lo:lo + 512]
            i, j = np.nonzero(x[r] @ x[cols].T >= threshold)
            i, j = r[i], cols[j]
            if ti == tj:
                i, j = i[i < j], j[i < j]
            oi, oj = owner[i], owner[j]
            # both at home; or one at home, and the other's cell does not see the pair first
            home_i, home_j = oi == cell, oj == cell
            seen = np.where(home_i, (visits[i] == oj[:, None]).any(axis=1), (visits[j] == oi[:, None]).any(axis=1))
            other = np.where(home_i, oj, oi)
            ok = (home_i & home_j) | ((home_i | home_j) & ((cell < other) | ~seen))
            i, j = i[ok], j[ok]
            np.add.at(links, i, copies[j])
            np.add.at(links, j, copies[i])
            if len(i):
                root = union_find(len(pdf), i, j)
                child = np.flatnonzero(root != np.arange(len(pdf)))
                left.append(child)
                right.append(root[child])
        some = np.flatnonzero(links)
        out = [pd.DataFrame({"a": ids[some], "b": ids[some], "n": links[some]})]
        if left:
            left, right = np.concatenate(left), np.concatenate(right)
            root = union_find(len(pdf), left, right)
            child = np.flatnonzero(root != np.arange(len(pdf)))
            out.append(pd.DataFrame({"a": ids[child], "b": ids[root[child]], "n": 0}))
        return pd.concat(out)

    return run


def near_duplicate_vectors(vectors: DataFrame, threshold: float = 0.9) -> DataFrame:
    """``embeddings(vec_id, embedding)`` -> one row each: vec_id, n_links,
    component_id, kept.

    A vector that is null, zero or holds a null or non-finite component links
    with nothing and is its own component; so does one with a null vec_id;
    vectors of another dimension than the sample's most frequent one are compared
    among their own; repeated vectors are linked copies (cosine 1); a vec_id that
    repeats with other vectors is a row each time, in the class of its vector; an empty
    table gives no rows; labels and other columns are not read."""
    spark = vectors.sparkSession
    good = vectors.filter(is_valid()).select("vec_id", F.col("embedding").alias("v"))
    good = good.withColumns({"k1": F.xxhash64("v"), "k2": F.xxhash64(F.lit(9), "v")})
    # a class of equal vectors is known by its hash: an id may repeat with another vector
    reps = materialise(good.groupBy(F.col("k1").alias("id"), "k2").agg(
        F.min("vec_id").alias("first"), F.count(F.lit(1)).alias("copies"), F.any_value("v").alias("v")).withColumn("dim", F.size("v")), "vectors")
    n = reps.count()
    dims = reps.groupBy("dim").count().orderBy(F.desc("count"), "dim").limit(1).collect()
    centroids, slack = np.zeros((0, 0)), np.zeros((0, 0))
    if dims:
        sample = reps.filter(F.col("dim") == dims[0].dim).orderBy(F.xxhash64("id")).limit(SAMPLE).select("v").toPandas()
        k = max(1, min(MAX_CELLS, n // CELL, len(sample)))
        x = _unit(sample["v"])
        centroids = spherical_kmeans(x, k)
        slack = border_slack(centroids, inner_spread(x, centroids), threshold)
    shared = spark.sparkContext.broadcast((centroids, slack))  # MAX_CELLS rows at most
    placed = reps.repartition(int(spark.conf.get("spark.sql.shuffle.partitions"))).mapInPandas(
        _assign(shared, threshold), f"id long, copies long, v {dict(reps.dtypes)['v']}, owner long, visits array<int>")
    placed = materialise(placed, "cells")
    at = placed.select("*", F.explode(F.concat(F.array("owner"), F.col("visits").cast("array<long>"))).alias("cell"))
    sizes = at.groupBy("cell").agg(F.ceil(F.count(F.lit(1)) / TILE).alias("tiles"))  # at most MAX_CELLS rows and one a dimension
    at = at.join(F.broadcast(sizes), "cell").withColumn("tile", F.pmod(F.xxhash64("id"), F.col("tiles")))
    pair = F.transform(F.sequence(F.lit(0).cast("long"), F.col("tiles") - 1), lambda t: F.struct(
        F.least(t, "tile").alias("ti"), F.greatest(t, "tile").alias("tj")))
    dealt = at.withColumn("p", F.explode(pair)).select("cell", "p.ti", "p.tj", "tile", "id", "copies", "v", "owner", "visits")
    found = dealt.groupBy("cell", "ti", "tj").applyInPandas(_compare(threshold), "a long, b long, n long")
    found = materialise(found, "cosines")
    links = found.filter("n > 0").groupBy(F.col("a").alias("id")).agg(F.sum("n").alias("links"))
    groups = components(found.filter("n = 0").select("a", "b"))
    info = materialise(reps.select("id", "k2", "first", "copies").join(links, "id", "left").join(groups, "id", "left").select(
        F.col("id").alias("k1"), "k2", "first", (F.coalesce("links", F.lit(0)) + F.col("copies") - 1).alias("n_links"),
        F.coalesce("component", "id").alias("component")), "classes")
    lowest = info.groupBy("component").agg(F.min("first").alias("component_id"))
    members = (good.select("vec_id", "k1", "k2").join(info.join(lowest, "component"), ["k1", "k2"])
               .select("vec_id", "n_links", "component_id"))
    bad = vectors.filter(~is_valid()).select("vec_id", F.lit(0).cast("long").alias("n_links"), F.col("vec_id").alias("component_id"))
    out = members.unionByName(bad)
    return out.withColumn("kept", F.coalesce(F.col("vec_id") == F.col("component_id"), F.lit(True)))
