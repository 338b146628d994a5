"""Line dedup by range-partitioned hashes with a secondary sort.

Lines (128-bit hash of their key, document, position) are range-partitioned and
sorted by all of these, so a frequent line may span many partitions.  Each task
streams its sorted rows and holds only the rows of one run until
``min_docs`` documents of it were seen.  A run cut by a partition border and
still undecided there (fewer than ``min_docs`` documents on that side) is
settled by a small second aggregation.  What leaves the pass are positions,
packed into 64-bit words by document; texts never enter that shuffle.  Lines are then
dropped by built-in expressions, so texts never enter a Python worker.
"""

from __future__ import annotations

import zlib

import numpy as np
from pyspark.sql import DataFrame
from pyspark.sql import functions as F

from kindred.llm.common import SPACES, ascii_lower, materialise, row_keys

DROP, PENDING, MARK = 0, 1, 2
LINE_SCHEMA = "h1 long, h2 long, did long, th long, pos int"


def lines_of(docs: DataFrame, min_chars: int) -> DataFrame:
    """One row per line whose key has at least ``min_chars`` code points."""
    parts = row_keys(docs).select("_did", "_th", F.posexplode(
        F.split(F.coalesce(F.col("text"), F.lit("")), "\n", -1)).alias("pos", "line"))
    key = ascii_lower(F.btrim(F.col("line"), F.lit(SPACES)))
    return (parts.select("_did", "_th", "pos", key.alias("key"))
            .filter(F.length("key") >= min_chars)
            .select(F.xxhash64("key").alias("h1"), F.xxhash64(F.lit(7), "key").alias("h2"),
                    F.col("_did").alias("did"), F.col("_th").alias("th"), "pos"))


def stream_runs(min_docs: int):
    """mapInArrow function over rows sorted by (h1, h2, did, th, pos)."""

    def emit(cols, state):
        import pyarrow as pa

        n = len(cols[0])
        return pa.RecordBatch.from_arrays(
            [pa.array(c) for c in cols] + [pa.array(np.full(n, state, dtype=np.int32))],
            names=["h1", "h2", "did", "th", "pos", "state"])

    def run(batches):
        carry = None        # rows of the open run while it is undecided
        decided = None      # (h1, h2) of the open run once it is frequent
        first = None        # key of the partition's first run
        for batch in batches:
            cols = [np.asarray(batch.column(i)) for i in range(5)]
            if not len(cols[0]):
                continue
            if first is None:
                first = (cols[0][0], cols[1][0])
            if carry is not None:
                cols = [np.concatenate((a, b)) for a, b in zip(carry, cols)]
                carry = None
            h1, h2, did = cols[0], cols[1], cols[2]
            new_run = np.concatenate(([True], (h1[1:] != h1[:-1]) | (h2[1:] != h2[:-1])))
            new_doc = new_run | np.concatenate(([True], did[1:] != did[:-1]))
            starts = np.flatnonzero(new_run)
            ends = np.concatenate((starts[1:], [len(h1)]))
            docs = np.add.reduceat(new_doc.astype(np.int64), starts)
            frequent = docs >= min_docs
            if decided is not None and decided == (h1[0], h2[0]):
                frequent[0] = True
            decided = None
            last = len(starts) - 1
            if frequent[last]:
                decided = (h1[-1], h2[-1])
            elif last > 0 or not frequent[0]:
                carry = [c[starts[last]:] for c in cols]
            row = np.repeat(frequent, ends - starts)
            if row.any():
                yield emit([c[row] for c in cols], DROP)
            edge = [r for r in {0, last} if frequent[r] and (r == last or (h1[0], h2[0]) == first)]
            for r in edge:
                yield emit([c[starts[r]:starts[r] + 1] for c in cols], MARK)
            if last > 0 and not frequent[0] and (h1[0], h2[0]) == first:
                yield emit([c[:ends[0]] for c in cols], PENDING)
        if carry is not None:
            yield emit(carry, PENDING)

    return run


def dropped_positions(docs: DataFrame, min_docs: int, min_chars: int) -> DataFrame:
    """(did, th, pos) of every line to drop."""
    rows = lines_of(docs, min_chars)
    order = ["h1", "h2", "did", "th", "pos"]
    runs = (rows.repartitionByRange(*order).sortWithinPartitions(*order)
            .mapInArrow(stream_runs(min_docs), LINE_SCHEMA + ", state int"))
    runs = materialise(runs, "line-runs")
    border = runs.filter(F.col("state") != DROP)
    late = (border.groupBy("h1", "h2")
            .agg(F.count_distinct("did").alias("n"), F.max((F.col("state") == MARK).cast("int")).alias("marked"))
            .filter((F.col("n") >= min_docs) | (F.col("marked") == 1)).select("h1", "h2"))
    pending = runs.filter(F.col("state") == PENDING).join(late, ["h1", "h2"], "left_semi")
    return runs.filter(F.col("state") == DROP).select("did", "th", "pos").unionByName(pending.select("did", "th", "pos"))


def pack(positions) -> bytes:
    """Compressed bitmap with a 1 for every dropped line."""
    pos = np.asarray(positions, dtype=np.int64)
    bits = np.zeros(int(pos.max()) + 1, dtype=np.uint8)
    bits[pos] = 1
    return zlib.compress(np.packbits(bits).tobytes(), 1)


def unpack(bitmap: bytes, n: int) -> np.ndarray:
    """Boolean keep mask of ``n`` lines."""
    bits = np.unpackbits(np.frombuffer(zlib.decompress(bitmap), dtype=np.uint8))[:n]
    keep = np.ones(n, dtype=bool)
    keep[:len(bits)] = bits == 0
    return keep


def drop_words(docs: DataFrame, min_docs: int = 10, min_chars: int = 1) -> DataFrame:
    """``documents`` -> ``(did, th, words)`` for every document that loses a line: a map from
    the number of each run of 64 lines to a bit for every line dropped in it.

    ``did`` is doc_id (the text's hash where it is null) and ``th`` the text's
    hash; documents that are absent keep all lines.  A repeated row is one
    document and gets one map; a null or empty text is one empty line; an
    empty table gives no rows; other columns are not read."""
    bit = F.expr("shiftleft(1L, pos % 64)")
    runs = (dropped_positions(docs, min_docs, min_chars).groupBy("did", "th", F.shiftright("pos", 6).alias("w"))
            .agg(F.bit_or(bit).alias("bits")))
    return runs.groupBy("did", "th").agg(F.map_from_entries(F.collect_list(F.struct("w", "bits"))).alias("words"))


def with_lines(docs: DataFrame, **params) -> DataFrame:
    """``docs`` with its ``_words`` (null: nothing dropped), its ``_lines`` and those ``_kept``."""
    maps = drop_words(docs, **params).select(
        F.col("did").alias("_did"), F.col("th").alias("_th"), F.col("words").alias("_words"))
    rows = row_keys(docs).join(maps.hint("shuffle_hash"), ["_did", "_th"], "left")
    lines = F.split(F.coalesce(F.col("text"), F.lit("")), "\n", -1)
    kept = F.expr("filter(_lines, (x, i) -> (shiftrightunsigned(coalesce(element_at(_words, shiftright(i, 6)), 0L), i % 64) & 1L) = 0)")
    return rows.withColumn("_lines", lines).withColumn("_kept", F.when(F.col("_words").isNull(), F.col("_lines")).otherwise(kept))


def dedup_lines(docs: DataFrame, min_docs: int = 10, min_chars: int = 1) -> DataFrame:
    """``docs`` with every frequent line gone from ``text`` and ``n_chars``, where
    there is such a column, brought up to date.  Rows and other columns stay; a
    null text becomes empty only if the row had lines to drop (it has none)."""
    out = with_lines(docs, min_docs=min_docs, min_chars=min_chars)
    out = out.withColumn("text", F.when(F.col("_words").isNull(), F.col("text")).otherwise(F.array_join("_kept", "\n")))
    if "n_chars" in docs.columns:
        out = out.withColumn("n_chars", F.length("text").cast("long"))
    return out.select(*docs.columns)


def dedup_digest(docs: DataFrame, min_docs: int = 10, min_chars: int = 1) -> DataFrame:
    """Per row: doc_id, n_lines, n_dropped, kept_sha256."""
    rows = with_lines(docs, min_docs=min_docs, min_chars=min_chars)
    n = F.size("_lines").cast("long")
    return rows.select("doc_id", n.alias("n_lines"), (n - F.size("_kept")).alias("n_dropped"),
                       F.sha2(F.array_join("_kept", "\n"), 256).alias("kept_sha256"))
