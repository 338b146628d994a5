"""Mixing sources to target weights by cube-method balanced sampling.

Every document of a source has the same expected number of copies f = target /
source size.  floor(f) copies are certain; the fractional part is an inclusion
probability.  The flight phase moves these probabilities inside the null space
of two constraints (words and documents taken) until at most two per block are
fractional.  Blocks hold a bounded number of documents, so a hot source is
simply many blocks; the survivors of all blocks of a source meet in fewer
blocks on the next level, and the last one is a landing problem of at most two
documents, solved exactly.
"""

from __future__ import annotations

import math

import numpy as np
import pandas as pd
from pyspark.sql import Column, DataFrame
from pyspark.sql import functions as F

from kindred.llm.common import broadcast_if_small, materialise, row_keys

WORD = r"[^\x20\x09-\x0D]+"
WEIGHTS = (5, 2, 1)
BLOCK = 4096
EPS = 1e-9


def size_of(text: str = "text") -> Column:
    return F.regexp_count(F.coalesce(F.col(text), F.lit("")), F.lit(WORD)).cast("long")


def source_targets(units: DataFrame, weights=WEIGHTS, cap: float = 3.0) -> DataFrame:
    """(source, source_size, n, rank, target) with one row a source.

    Sources are ranked by code point, null last, by a distributed sort.  The
    shares are filled up in rounds: sources whose share exceeds ``cap`` times
    their size stop there, the rest shares what is left; each round needs two
    sums of the source table."""
    spark = units.sparkSession
    sources = units.groupBy("source").agg(F.sum("size").alias("source_size"), F.count(F.lit(1)).alias("n"))
    ordered = materialise(sources, "sources").orderBy(F.col("source").isNull(), "source")
    ranked = spark.createDataFrame(
        ordered.rdd.zipWithIndex().map(lambda x: (*x[0], x[1])), "source string, source_size long, n long, rank long")
    weight = F.element_at(F.array(*[F.lit(w) for w in weights]), (F.col("rank") % len(weights) + 1).cast("int"))
    ranked = materialise(ranked.withColumn("weight", weight.cast("long")), "ranked")
    total = ranked.agg(F.sum("source_size")).first()[0] or 0
    level, full = 0.0, F.lit(False)
    seen = -1
    while True:
        row = ranked.agg(F.sum(F.when(full, F.col("source_size"))).alias("s"), F.sum(F.when(~full, F.col("weight"))).alias("w"),
                         F.count(F.when(full, 1)).alias("k")).first()
        if row.k == seen or not row.w:
            break
        seen = row.k
        level = max(0.0, (total - cap * (row.s or 0)) / row.w)
        full = cap * F.col("source_size") < F.lit(level) * F.col("weight")
    return ranked.withColumn("target", F.least(cap * F.col("source_size").cast("double"), F.lit(level) * F.col("weight")))


def flight(x: list[float], p: list[float], u: list[float]) -> list[float]:
    """Move ``p`` in the null space of (sum of p, sum of x*p) until at most two
    entries are fractional; ``u`` holds a uniform number for every step."""
    p = list(p)
    active: list[int] = []
    todo = [i for i, v in enumerate(p) if EPS < v < 1 - EPS]
    at, step = 0, 0
    while True:
        while len(active) < 3 and at < len(todo):
            active.append(todo[at])
            at += 1
        if len(active) < 3:
            return p
        i, j, k = active
        d = (x[k] - x[j], x[i] - x[k], x[j] - x[i])
        if d == (0, 0, 0):
            d = (1.0, -1.0, 0.0)
        up = down = math.inf
        for a, v in zip(active, d):
            if v > 0:
                up, down = min(up, (1 - p[a]) / v), min(down, p[a] / v)
            elif v < 0:
                up, down = min(up, p[a] / -v), min(down, (1 - p[a]) / -v)
        move = up if u[step] * (up + down) < down else -down
        step += 1
        rest = []
        for a, v in zip(active, d):
            q = p[a] + move * v
            p[a] = 0.0 if q <= EPS else 1.0 if q >= 1 - EPS else q
            if 0.0 < p[a] < 1.0:
                rest.append(a)
        active = rest


def land(x: list[float], p: list[float]) -> list[float]:
    """Round the at most two fractional entries to the least error in words,
    then in documents, then to fewer documents."""
    open_ = [i for i, v in enumerate(p) if EPS < v < 1 - EPS]
    best = None
    for code in range(1 << len(open_)):
        pick = [(code >> b) & 1 for b in range(len(open_))]
        err = (abs(sum(x[i] * (s - p[i]) for i, s in zip(open_, pick))), abs(sum(s - p[i] for i, s in zip(open_, pick))), code)
        if best is None or err < best[0]:
            best = (err, pick)
    p = list(p)
    for i, s in zip(open_, best[1] if best else []):
        p[i] = float(s)
    return p


def _balance(last_blocks: int):
    def run(pdf: pd.DataFrame) -> pd.DataFrame:
        # long documents first: what stays fractional to the end is short
        pdf = pdf.sort_values(["size", "h", "did"], ascending=[False, True, True], kind="stable", ignore_index=True)
        x, p = pdf["size"].astype(float).tolist(), pdf["pi"].tolist()
        u = (pdf["h"].to_numpy().view(np.uint64) >> np.uint64(11)) / float(1 << 53)
        p = flight(x, p, u.tolist())
        if pdf["blocks"].iloc[0] <= last_blocks:
            p = land(x, p)
        return pdf.assign(pi=p)
    return run


def mix_sources(docs: DataFrame, weights=WEIGHTS, cap: float = 3.0, seed: int = 17, block: int = BLOCK) -> DataFrame:
    """``documents`` -> one row each: doc_id, source, size, source_size, target,
    copies, taken (= copies * size), and the row key ``_did``, ``_th``.

    Whole documents are taken 0 to ``cap`` times.  Texts that are null or have no
    word have size 0 and take nothing; null sources form one source; repeated
    rows are separate documents; an empty table gives no rows; only doc_id, text
    and source are read.  The draw depends on ids, sizes and ``seed`` alone."""
    units = materialise(row_keys(docs).select(
        "doc_id", "source", size_of().alias("size"), "_did", "_th"), "units")
    sources = source_targets(units, weights, cap)
    n_sources = sources.count()
    most = sources.agg(F.max("n")).first()[0] or 0
    src = broadcast_if_small(sources.select(F.col("source").alias("_s"), "source_size", "target", "rank", "n"), n_sources)
    f = F.when(F.col("source_size") > 0, F.col("target") / F.col("source_size")).otherwise(0.0)
    rows = (units.join(src, F.col("source").eqNullSafe(F.col("_s"))).drop("_s")
            .withColumn("f", f).withColumn("copies", F.floor("f").cast("long"))
            .withColumn("pi", F.col("f") - F.col("copies"))
            .withColumn("pi", F.when(F.col("size") == 0, 0.0).otherwise(F.col("pi")))
            .withColumn("blocks", F.ceil(F.col("n") / block)).withColumn("did", F.col("_did"))
            .withColumn("h", F.xxhash64(F.lit(seed), "_did", "_th", "size")).drop("f", "n"))
    out, blocks = None, math.ceil(most / block)
    level = 0
    while True:
        dealt = rows.withColumn("block", F.pmod(F.xxhash64("h", F.lit(level)), F.col("blocks")))
        done = materialise(dealt.groupBy("rank", "block").applyInPandas(_balance(1), dealt.schema), f"flight{level}").drop("block")
        whole = done.filter((F.col("pi") == 0) | (F.col("pi") == 1))
        out = whole if out is None else out.unionByName(whole)
        if blocks <= 1:
            break
        blocks, level = math.ceil(2 * blocks / block), level + 1
        rows = done.filter((F.col("pi") > 0) & (F.col("pi") < 1)).withColumn("blocks", F.ceil(2 * F.col("blocks") / block))
    copies = (F.col("copies") + F.col("pi").cast("long")).alias("copies")
    return out.select("doc_id", "source", "size", "source_size", "target", copies, "_did", "_th").withColumn(
        "taken", F.col("copies") * F.col("size"))


def mixed_documents(docs: DataFrame, **params) -> DataFrame:
    """The documents the mix takes, with ``copies`` = how often.  Identical rows
    (same id and text) share the largest number drawn for them."""
    taken = mix_sources(docs, **params).groupBy("_did", "_th").agg(F.max("copies").alias("_copies")).filter("_copies > 0")
    keyed = row_keys(docs).join(taken.hint("shuffle_hash"), ["_did", "_th"])
    return keyed.select(*docs.columns, F.col("_copies").alias("copies"))
