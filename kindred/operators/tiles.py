"""All pairs of a kind in tiles of bounded size.

Where a key of a few signature bits tells rows hardly apart (4-bit bands, length ratios),
an equi-join on it meets most pairs of a kind anyway, row by row, and the texts of the
pairs it leaves travel once per pair.  Here rows travel once per tile instead: the rows of
a kind are dealt into slices of about ``tile`` rows, two slices meet in one tile, and a
task compares a tile with numpy and refines what is left with the texts it holds.  What
moves and what a task holds depends on rows and tiles, never on the number of candidates.
"""

from __future__ import annotations

import math
from collections.abc import Iterator

import numpy as np
from pyspark.sql import Column, DataFrame
from pyspark.sql import functions as F
from pyspark.sql.types import IntegerType, StructField, StructType

from kindred.functions.editbatch import certainly_apart
from kindred.functions.editdistance import GRAM_TEXT, Grams, edit_distance
from kindred.operators.parallel import balance

TILE_KEY = ["kind", "_tb", "_ts", "_tu", "_tt"]
#: Rows of either side that a tile compares at a time, and characters of their texts.
STEP, STEP_CHARS = 256, 1_000_000
#: Characters of the texts of a slice.
TILE_CHARS = 4_000_000
#: Pairs that a task gives back at a time.
OUT_ROWS = 20_000


def dealt(rows: DataFrame, bucket: Column, tile: int, chars: int | None = None) -> DataFrame:
    """``rows`` once for every tile they belong to, with ``TILE_KEY`` and ``_left``.

    A pair of rows of one kind whose buckets are equal or neighbours meets in one tile;
    rows without kind or id pair with nothing.  A bucket of n rows is dealt by hash into
    ceil(n / tile) slices, or more where its texts (``len``) have over ``chars`` characters a slice."""
    own = rows.filter(F.col("kind").isNotNull() & F.col("id").isNotNull()).withColumn("_b", bucket.cast("int"))
    n = F.ceil(F.count(F.lit(1)) / F.lit(tile))
    if chars:
        n = F.greatest(n, F.ceil(F.sum(F.col("len").cast("long")) / F.lit(chars)))
    g = own.groupBy("kind", "_b").agg(n.cast("int").alias("_g"))
    up = g.select("kind", (F.col("_b") - 1).alias("_b"), F.col("_g").alias("_gu"))
    down = g.select("kind", (F.col("_b") + 1).alias("_b"), F.col("_g").alias("_gd"))
    sizes = g.join(up, ["kind", "_b"], "left").join(down, ["kind", "_b"], "left")
    own = own.join(sizes, ["kind", "_b"]).withColumn("_s", F.pmod(F.xxhash64("id"), F.col("_g")).cast("int"))

    def slices(n):
        n = F.coalesce(F.col(n), F.lit(0))
        return F.filter(F.sequence(F.lit(0), F.greatest(n - 1, F.lit(0))), lambda t: t < n)

    def tiles(of, b, s, u, t, left):
        return F.transform(of, lambda x: F.struct(b.alias("_tb"), s(x).alias("_ts"), F.lit(u).alias("_tu"), t(x).alias("_tt"),
                                                  F.lit(left).alias("_left")))

    b, s = F.col("_b"), F.col("_s")
    met = F.concat(
        tiles(F.filter(slices("_g"), lambda x: x >= s), b, lambda x: s, 0, lambda x: x, True),
        tiles(F.filter(slices("_g"), lambda x: x < s), b, lambda x: x, 0, lambda x: s, False),
        tiles(slices("_gu"), b, lambda x: s, 1, lambda x: x, True),
        tiles(slices("_gd"), b - 1, lambda x: x, 1, lambda x: s, False))
    return own.select(*rows.columns, F.inline(met))


def gathered(batches) -> Iterator:
    """Arrow tables of whole tiles from batches in tile order."""
    import pyarrow as pa

    held, key = [], None
    for batch in batches:
        keys = list(zip(*[batch.column(batch.schema.get_field_index(c)).to_pylist() for c in TILE_KEY]))
        start = 0
        for i in range(len(keys)):
            if keys[i] != key:
                if i > start:
                    held.append(batch.slice(start, i - start))
                if held:
                    yield key, pa.Table.from_batches(held)
                held, key, start = [], keys[i], i
        if start < len(keys):
            held.append(batch.slice(start))
    if held:
        yield key, pa.Table.from_batches(held)


def steps(order: np.ndarray, size: np.ndarray, most: int, chars: int | None) -> list[np.ndarray]:
    """``order``, whose texts get longer, in parts of at most ``most`` rows and, from 16 rows
    on, ``chars`` characters."""
    out, start = [], 0
    while start < len(order):
        end = min(start + most, len(order))
        while chars and end - start > 16 and (end - start) * int(size[order[end - 1]]) > chars:
            end = start + max((end - start) // 2, 16)
        out.append(order[start:end])
        start = end
    return out


def bounded_distance(a: str, b: str, most: int, grams: Grams) -> int:
    """``edit_distance`` within ``most``; near copies are found inside a narrow band first."""
    found = edit_distance(a, b, most // 8, grams)
    return found if found >= 0 else edit_distance(a, b, most, grams)


def shares_band(x: np.ndarray, masks: list[int]) -> np.ndarray:
    out = np.zeros(x.shape, dtype=bool)
    for m in masks:
        out |= (x & np.uint64(m)) == 0
    return out


def comparer(max_hamming: int | None, masks: list[int] | None, ratio: float, threshold: float | None, above: int):
    """mapInArrow function over dealt rows: pairs within ``max_hamming`` bits that share a
    band of ``masks``, have a length ratio of ``ratio`` and a longer text of more than
    ``above`` characters; with a ``threshold`` those whose edit distance can reach it,
    ``_d``, else their ``hamming``."""

    def run(batches):
        import pyarrow as pa

        kind_type = None
        out: list[tuple] = []

        def flush():
            cols = [np.concatenate(c) for c in zip(*[o[1:] for o in out])]
            kinds = pa.concat_arrays([pa.array([o[0]] * len(o[1]), type=kind_type) for o in out])
            out.clear()
            return pa.RecordBatch.from_arrays([kinds, *[pa.array(c) for c in cols]],
                                              names=["kind", "id", "sim_id", "_ll", "_rl", "hamming" if threshold is None else "_d"])

        for key, table in gathered(batches):
            kind_type = table.schema.field("kind").type
            left = np.asarray(table.column("_left"))
            ids = np.asarray(table.column("id"))
            size = np.asarray(table.column("len")).astype(np.int64)
            h = None if max_hamming is None else np.asarray(table.column("h")).view(np.uint64)
            texts = None if threshold is None else table.column("value")
            same = key[3] == 0 and key[2] == key[4]
            a = np.flatnonzero(left)
            a = a[np.argsort(size[a], kind="stable")]
            b = a if same else np.flatnonzero(~left)
            b = b[np.argsort(size[b], kind="stable")]
            held, grams = 0, Grams()
            chars = None if threshold is None else STEP_CHARS
            right_steps = steps(b, size, STEP, chars)
            for i, p in enumerate(steps(a, size, STEP, chars)):
                for j, q in enumerate(right_steps):
                    if same and j < i:
                        continue
                    lp, lq = size[p][:, None], size[q][None, :]
                    hi = np.maximum(lp, lq)
                    ok = (ids[p][:, None] != ids[q][None, :]) & ((hi == 0) | (np.minimum(lp, lq) >= hi * ratio)) & (hi > above)
                    if same and i == j:
                        ok &= np.arange(len(p))[:, None] < np.arange(len(q))[None, :]
                    if h is not None:
                        x = h[p][:, None] ^ h[q][None, :]
                        ok &= np.bitwise_count(x) <= max_hamming
                    x0, y0 = np.nonzero(ok)
                    if h is not None and masks is not None and len(x0):
                        banded = shares_band(x[x0, y0], masks)
                        x0, y0 = x0[banded], y0[banded]
                    if not len(x0):
                        continue
                    l, r = p[x0], q[y0]
                    if threshold is None:
                        value = np.bitwise_count(h[l] ^ h[r]).astype(np.int32)
                    else:
                        most = np.floor(np.maximum(size[l], size[r]) * ((100.0 - threshold + 0.005) / 100.0)).astype(np.int64) + 1
                        pu, pi = np.unique(l, return_inverse=True)
                        qu, qi = np.unique(r, return_inverse=True)
                        lt, rt = ([texts[int(k)].as_py() for k in u] for u in (pu, qu))
                        near = np.flatnonzero(~certainly_apart(lt, rt, pi, qi, most))
                        l, r, pi, qi, most = l[near], r[near], pi[near], qi[near], most[near]
                        held += sum(len(lt[k]) for k in np.unique(pi)) + sum(len(rt[k]) for k in np.unique(qi))
                        if held > GRAM_TEXT:
                            held, grams = 0, Grams()
                        value = np.array([bounded_distance(lt[u], rt[v], k, grams) for u, v, k in zip(pi.tolist(), qi.tolist(), most.tolist())],
                                         dtype=np.int32)
                        found = value >= 0
                        l, r, value = l[found], r[found], value[found]
                    lo, hi_ = np.minimum(ids[l], ids[r]), np.maximum(ids[l], ids[r])
                    for at in range(0, len(l), OUT_ROWS):
                        part = slice(at, at + OUT_ROWS)
                        out.append((key[0], lo[part], hi_[part], size[l[part]].astype(np.int32), size[r[part]].astype(np.int32), value[part]))
                        if sum(len(o[1]) for o in out) >= OUT_ROWS or len(out) > 1000:
                            yield flush()
        if out:
            yield flush()

    return run


def tiled_pairs(rows: DataFrame, tile: int, max_hamming: int | None = None, masks: list[int] | None = None,
                ratio: float = 0.0, threshold: float | None = None, above: int = -1) -> DataFrame:
    """``rows(kind, id, len[, h][, value])`` -> pairs ``(kind, id, sim_id, _ll, _rl)`` and
    ``hamming``, or ``_d`` with a threshold; see :func:`comparer`.  A length ratio makes
    slices of near lengths, so that tiles of hopeless lengths do not arise."""
    if ratio > 0:
        width = math.log(1.0 / max(ratio - 1e-9, 1e-9))
        bucket = F.floor(F.log(F.greatest("len", F.lit(1)).cast("double")) / F.lit(width))
    else:
        bucket = F.lit(0)
    # a tile of long texts costs many times one of short texts: small tasks even that out
    met = dealt(rows, bucket, tile, None if threshold is None else TILE_CHARS)
    spread = balance(met, *TILE_KEY, tasks_per_core=16).sortWithinPartitions(*TILE_KEY)
    fields = {f.name: f for f in rows.schema.fields}
    schema = StructType([StructField("kind", fields["kind"].dataType), StructField("id", fields["id"].dataType),
                         StructField("sim_id", fields["id"].dataType), StructField("_ll", IntegerType()),
                         StructField("_rl", IntegerType()), StructField("hamming" if threshold is None else "_d", IntegerType())])
    return spread.mapInArrow(comparer(max_hamming, masks, ratio, threshold, above), schema)


import sys as _sys  # noqa: E402

from kindred._shipping import ship_by_value  # noqa: E402

ship_by_value(_sys.modules[__name__])
