"""Near-dedup of documents by ProbMinHash over weighted five-word shingles.

A shingle of weight w (1 + log of its count in the text) arrives at the components of a
signature as a Poisson process: the arrivals of one shingle visit all
components in a pseudo-random order, the i-th after another Exp(1) * M / (M-i)
/ w, and the earliest arrival keeps the component.  A shingle stops as soon as
its clock passes the latest first arrival of its text, so most shingles of a
long text are drawn once.  Two signatures agree in a component with probability
J_P, the probability Jaccard similarity.  Candidates are verified by the Jaccard
similarity of the sets, which repeated passages part from J_P; so a text with a
repeated shingle has a second signature with all weights 1, whose J_P is exactly
that similarity.  Without repeats both signatures are the same.

Signatures are banded (32 bands of 6), both kinds in the same buckets.  Exact copies (same word sequence) are
collapsed first.  In every band bucket each member is verified against two
leaders of the bucket, never against all.  Members of buckets that still hold
more than one component after that go through an exact prefix search for the
pairs that can reach the threshold, so no link that a bucket shows is lost.  A pair is a link when the exact
Jaccard similarity of the two sets of shingles reaches the threshold.
"""

from __future__ import annotations

import numpy as np
from pyspark.sql import DataFrame, Window
from pyspark.sql import functions as F

from kindred.llm.common import broadcast_if_small, components, list_arrays, materialise, mix, row_keys, shingles, text_chunks, word_hashes

BANDS, ROWS = 32, 6
M = BANDS * ROWS
LOW48 = np.uint64((1 << 48) - 1)


def weighted(sh: np.ndarray, offsets: np.ndarray) -> tuple[np.ndarray, np.ndarray, np.ndarray]:
    """Row, 48-bit key and count of every distinct shingle, by row and key."""
    row = np.repeat(np.arange(len(offsets) - 1, dtype=np.uint64), np.diff(offsets))
    packed = np.sort((row << np.uint64(48)) | (sh >> np.uint64(16)))
    first = np.concatenate(([True], packed[1:] != packed[:-1])) if len(packed) else np.zeros(0, dtype=bool)
    at = np.flatnonzero(first)
    count = np.diff(np.concatenate((at, [len(packed)])))
    packed = packed[at]
    return (packed >> np.uint64(48)).astype(np.int64), packed & LOW48, count


def exponential(key: np.ndarray, step: int) -> np.ndarray:
    bits = mix(key + np.uint64((step + 1) * 0x9E3779B97F4A7C15 & 0xFFFFFFFFFFFFFFFF)) >> np.uint64(11)
    return -np.log((bits.astype(np.float64) + 0.5) / float(1 << 53))


def signatures(row: np.ndarray, key: np.ndarray, weight: np.ndarray, n: int) -> np.ndarray:
    """``n`` x M array of the shingle that arrived first at every component."""
    first = np.full(n * M, np.inf)
    sig = np.zeros(n * M, dtype=np.uint64)
    start = (mix(key ^ np.uint64(0xA5A5A5A5)) % np.uint64(M)).astype(np.int64)
    stride = (mix(key ^ np.uint64(0x5C5C5C5C)) % np.uint64(M // 6)).astype(np.int64) * 6 + 1  # coprime with M = 192
    clock = np.zeros(len(key))
    for step in range(M):
        clock = clock + exponential(key, step) * (M / (M - step)) / weight
        at = row * M + (start + stride * step) % M
        np.minimum.at(first, at, clock)
        won = first[at] == clock
        sig[at[won]] = key[won]
        latest = first.reshape(n, M).max(axis=1)
        alive = clock < latest[row]
        if not alive.any():
            break
        row, key, weight, clock, start, stride = (a[alive] for a in (row, key, weight, clock, start, stride))
    return sig.reshape(n, M)


def band_keys(sig: np.ndarray) -> np.ndarray:
    """64-bit key of every band of every row."""
    parts = sig.reshape(len(sig), BANDS, ROWS)
    h = np.broadcast_to(np.arange(1, BANDS + 1, dtype=np.uint64), parts.shape[:2]).copy()
    for j in range(ROWS):
        h = mix(h * np.uint64(0x9E3779B97F4A7C15) + parts[:, :, j])
    return h


def _sign(batches):
    import pyarrow as pa

    for batch in batches:
        did, th = np.asarray(batch.column("_did")), np.asarray(batch.column("_th"))
        w1, w2 = np.asarray(batch.column("w1")), np.asarray(batch.column("w2"))
        for start, stop, words, offsets in text_chunks(batch.column("words")):
            n = stop - start
            sh, off = shingles(words, offsets)
            row, key, count = weighted(sh, off)
            keys = band_keys(signatures(row, key, 1 + np.log(count), n))
            # texts with a repeated shingle also get the bands of weight 1
            twice = np.zeros(n, dtype=bool)
            twice[row[count > 1]] = True
            plain = np.zeros_like(keys)
            if twice.any():
                own = twice[row]
                at = (np.cumsum(twice) - 1)[row[own]]
                plain[twice] = band_keys(signatures(at, key[own], np.ones(len(at)), int(twice.sum())))
            full = np.diff(off) > 0
            lens = np.concatenate(([0], np.cumsum(np.where(full, BANDS * (1 + twice), 0)))).astype(np.int32)
            keys = np.hstack((keys, plain)).view(np.int64)
            keys = keys[np.hstack((np.repeat(full[:, None], BANDS, axis=1), np.repeat(twice[:, None], BANDS, axis=1)))]
            yield pa.RecordBatch.from_arrays(
                [pa.array(a[start:stop]) for a in (did, th, w1, w2)]
                + [pa.ListArray.from_arrays(pa.array(lens), pa.array(keys))],
                names=["did", "th", "w1", "w2", "bands"])


def _sets(batches):
    import pyarrow as pa

    for batch in batches:
        ids = np.asarray(batch.column("id"))
        for start, stop, words, offsets in text_chunks(batch.column("words")):
            sh, off = shingles(words, offsets)
            row, key, _ = weighted(sh, off)
            lens = np.searchsorted(row, np.arange(stop - start + 1)).astype(np.int32)
            yield pa.RecordBatch.from_arrays(
                [pa.array(ids[start:stop]), pa.ListArray.from_arrays(pa.array(lens), pa.array(key.view(np.int64)))],
                names=["id", "keys"])


def similarity(a: np.ndarray, b: np.ndarray) -> float:
    """Exact Jaccard similarity of two sorted sets of shingles."""
    common = len(np.intersect1d(a, b, assume_unique=True))
    return common / max(1, len(a) + len(b) - common)


def _verify(threshold: float):
    def run(batches):
        import pyarrow as pa

        for batch in batches:
            (left, lo), (right, ro) = list_arrays(batch.column("ka")), list_arrays(batch.column("kb"))
            ok = [similarity(left[lo[i]:lo[i + 1]], right[ro[i]:ro[i + 1]]) >= threshold for i in range(batch.num_rows)]
            yield batch.select(["a", "b"]).filter(pa.array(ok, type=pa.bool_()))

    return run


def shingle_sets(docs: DataFrame, reps: DataFrame, ids: DataFrame) -> DataFrame:
    """(id, keys) with the sorted shingles of the texts that share a bucket."""
    wanted = materialise(reps.join(ids, "id", "left_semi").select(
        "id", F.col("did").alias("_did"), F.col("th").alias("_th")).distinct(), "set-ids")
    wanted = broadcast_if_small(wanted, wanted.count())
    found = row_keys(docs.select("doc_id", "text")).join(wanted, ["_did", "_th"]).select("id", word_hashes().alias("words"))
    return materialise(found.mapInArrow(_sets, "id long, keys array<long>").dropDuplicates(["id"]), "sets")


def verified(pairs: DataFrame, sets: DataFrame, threshold: float) -> DataFrame:
    """The pairs (a, b) of class ids whose similarity reaches the threshold."""
    left = sets.withColumnsRenamed({"id": "a", "keys": "ka"})
    right = sets.withColumnsRenamed({"id": "b", "keys": "kb"})
    full = pairs.join(left, "a").join(right, "b").select("a", "b", "ka", "kb")
    return materialise(full.mapInArrow(_verify(threshold), "a long, b long"), "links")


def prefix_pairs(nodes: DataFrame, sets: DataFrame, threshold: float) -> DataFrame:
    """Pairs (a, b) of ``nodes(id, comp)`` in different components that can reach
    the threshold: an exact candidate search by prefix and position.

    With the shingles of a text ordered from rare to frequent, two texts of
    n and m shingles and similarity t overlap in at least t / (1 + t) * (n + m)
    of them; so their first common shingle stands so early that enough follow
    it on either side.  Texts whose own edits fill that prefix with shingles
    that nobody else has drop out, however large their group is."""
    t = threshold
    rows = nodes.join(sets, "id").select("id", "comp", F.size("keys").alias("n"), F.explode("keys").alias("key"))
    often = rows.groupBy("key").agg(F.count(F.lit(1)).alias("df")).filter("df > 1")
    own = Window.partitionBy("id")
    rows = (rows.join(often, "key")
            .withColumn("pos", F.col("n") - F.count(F.lit(1)).over(own) + F.row_number().over(own.orderBy("df", "key")))
            .filter(F.col("pos") <= F.col("n") - F.ceil(t * F.col("n")) + 1).drop("df"))
    rows = materialise(rows, "prefixes")
    a, b = rows.alias("a"), rows.alias("b")
    need = F.ceil(t / (1 + t) * (F.col("a.n") + F.col("b.n")) - 1e-9)
    left = F.least(F.col("a.n") - F.col("a.pos"), F.col("b.n") - F.col("b.pos")) + 1
    on = ((F.col("a.key") == F.col("b.key")) & (F.col("a.id") > F.col("b.id")) & (F.col("a.comp") != F.col("b.comp"))
          & (left >= need))
    return a.join(b, on).select(F.col("a.id").alias("a"), F.col("b.id").alias("b")).distinct()


def near_duplicates(docs: DataFrame, threshold: float = 0.8) -> DataFrame:
    """``documents`` -> one row each: did, th, class_id (smallest did among texts
    with the same words), component_id (smallest did reachable by copies and
    links) and kept (the one document of the component with that id).

    A null doc_id is replaced by the hash of its text; texts of one to four
    words are one shingle; texts without a word (null and empty ones included)
    are copies of each other and link with nothing else; repeated rows are
    copies, and all rows of a kept id with its text are kept; an empty table
    gives no rows; only doc_id and text are read."""
    words = row_keys(docs.select("doc_id", "text")).select("_did", "_th", word_hashes().alias("words"))
    words = words.withColumn("words", F.filter("words", lambda w: w != F.xxhash64(F.lit(""))))
    keyed = words.select("_did", "_th", F.xxhash64("words").alias("w1"), F.xxhash64(F.lit(3), "words").alias("w2"), "words")
    signed = materialise(keyed.mapInArrow(_sign, "did long, th long, w1 long, w2 long, bands array<long>"), "signed")
    same = signed.groupBy("w1", "w2").agg(F.min(F.struct("did", "th")).alias("first"))
    same = same.select("w1", "w2", F.col("first.did").alias("id"), F.col("first.th").alias("first_th"))
    members = materialise(signed.join(same, ["w1", "w2"]).select("did", "th", "id", "first_th", "bands"), "members")
    reps = members.filter((F.col("did") == F.col("id")) & (F.col("th") == F.col("first_th")))
    buckets = reps.select("id", F.explode(F.array_distinct("bands")).alias("band")).distinct().repartition("band")
    full = buckets.groupBy("band").agg(F.count(F.lit(1)).alias("n")).filter("n > 1")
    shared = materialise(buckets.join(full, "band"), "buckets")
    # leaders of a bucket: its smallest id, and the member that meets most others, which is the most central
    centre = shared.groupBy("id").agg(F.sum("n").alias("score"))
    leaders = shared.join(centre, "id").groupBy("band").agg(
        F.min("id").alias("l1"), F.max(F.struct("score", (-F.col("id")).alias("m"))).alias("c"))
    leaders = leaders.select("band", F.array_distinct(F.array("l1", -F.col("c.m"))).alias("leaders"))
    stars = (shared.join(leaders, "band").select("id", F.explode("leaders").alias("l")).filter("id <> l")
             .select(F.greatest("id", "l").alias("a"), F.least("id", "l").alias("b")).distinct())
    sets = shingle_sets(docs, reps, shared.select("id").distinct())
    links = verified(materialise(stars, "stars"), sets, threshold)
    groups = components(links)
    # what a bucket still holds apart
    apart = shared.select("band", "id").join(groups, "id", "left").select(
        "band", "id", F.coalesce("component", "id").alias("comp"))
    open_ = apart.groupBy("band").agg(F.min("comp").alias("lo"), F.max("comp").alias("hi")).filter("lo <> hi").select("band")
    nodes = materialise(apart.join(open_, "band", "left_semi").select("id", "comp").distinct(), "apart")
    more = verified(materialise(prefix_pairs(nodes, sets, threshold), "rest"), sets, threshold)
    groups = materialise(components(links.unionByName(more)), "groups")
    out = members.join(groups, "id", "left").withColumn("component_id", F.coalesce("component", "id"))
    kept = (F.col("did") == F.col("component_id")) & (F.col("th") == F.col("first_th")) & (F.col("id") == F.col("component_id"))
    return out.select("did", "th", F.col("id").alias("class_id"), "component_id", kept.alias("kept"))


def keep_one(docs: DataFrame, threshold: float = 0.8) -> DataFrame:
    """``docs`` with one document of every group of near-duplicates."""
    kept = materialise(near_duplicates(docs, threshold).filter("kept").select(
        F.col("did").alias("_did"), F.col("th").alias("_th")).distinct(), "kept")
    out = row_keys(docs).join(kept, ["_did", "_th"], "left_semi")
    return out.dropDuplicates(["_did", "_th"]).select(*docs.columns)
