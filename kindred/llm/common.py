"""Helpers shared by the operators: intermediate tables, row keys, size-checked
broadcasts, and five-word shingles as numpy arrays."""

from __future__ import annotations

import pickle
import uuid

import numpy as np
from pyspark.sql import Column, DataFrame, SparkSession
from pyspark.sql import functions as F

from kindred.session import ensure_checkpoint_dir, read_table

__all__ = ["read_table"]

#: Characters stripped and counted as white space by the contracts: x20, x09-x0D.
SPACES = " \t\n\x0b\x0c\r"
UPPER, LOWER = "ABCDEFGHIJKLMNOPQRSTUVWXYZ", "abcdefghijklmnopqrstuvwxyz"
#: Rows up to which a side may be broadcast after it was counted.
BROADCAST_ROWS = 1_000_000
#: xxhash64 of the empty string with Spark's seed 42 (fixed value).
EMPTY_WORD = np.uint64(11002672306508523268)
SHINGLE = 5
#: Rows sent to a Python worker at a time while a table is written.
BATCH_CONF, BATCH_ROWS = "spark.sql.execution.arrow.maxRecordsPerBatch", "1000"
#: Shingles handled at a time by the numpy passes, which bounds a task's memory.
CHUNK = 200_000


def materialise(df: DataFrame, name: str) -> DataFrame:
    """Write ``df`` once as Parquet below the shared checkpoint folder and read
    it back: cuts the lineage, survives lost executors, and removes the files
    when the driver's JVM ends."""
    spark = df.sparkSession
    path = f"{ensure_checkpoint_dir(spark)}/llm-{name}-{uuid.uuid4().hex}"
    before = spark.conf.get(BATCH_CONF)
    spark.conf.set(BATCH_CONF, BATCH_ROWS)
    try:
        df.write.parquet(path)
    finally:
        spark.conf.set(BATCH_CONF, before)
    jvm = spark.sparkContext._jvm
    hpath = jvm.org.apache.hadoop.fs.Path(path)
    hpath.getFileSystem(spark.sparkContext._jsc.hadoopConfiguration()).deleteOnExit(hpath)
    return spark.read.schema(df.schema).parquet(path)


def broadcast_if_small(df: DataFrame, rows: int, limit: int = BROADCAST_ROWS) -> DataFrame:
    """Broadcast a side of counted size; beyond ``limit`` rows it is shuffled."""
    return F.broadcast(df) if rows <= limit else df


def shipped(spark: SparkSession, value):
    """A driver object for UDFs: a function that gives it inside a task, and its
    broadcast.  It travels as bytes in which the classes of this subpackage are pickled
    by value (a plain broadcast names them by module), so executors need no copy of
    the package; a task unpickles it once."""
    from pyspark import cloudpickle

    blob = spark.sparkContext.broadcast(cloudpickle.dumps(value))
    held: list = []

    def get():
        if not held:
            held.append(pickle.loads(blob.value))
        return held[0]

    return get, blob


def text_key(text: str = "text") -> Column:
    return F.xxhash64(F.coalesce(F.col(text), F.lit("")))


def row_keys(df: DataFrame) -> DataFrame:
    """Add ``_did`` (doc_id, or the text's hash where it is null) and ``_th``
    (hash of the text): rows that agree in both are repeated rows."""
    return df.withColumns({"_th": text_key(), "_did": F.coalesce(F.col("doc_id"), text_key())})


def ascii_lower(c: Column) -> Column:
    return F.translate(c, UPPER, LOWER)


def word_hashes(text: str = "text") -> Column:
    """Hash of every word (run of letters and digits, lower-cased) of a text.

    A text that starts or ends with something else yields the hash of the empty
    string at that end; ``shingles`` drops it."""
    words = F.split(F.lower(F.coalesce(F.col(text), F.lit(""))), r"[^\p{L}\p{N}]+")
    return F.transform(words, lambda w: F.xxhash64(w))


def mix(x: np.ndarray) -> np.ndarray:
    """splitmix64 finaliser over uint64."""
    x = x ^ (x >> np.uint64(30))
    x = x * np.uint64(0xBF58476D1CE4E5B9)
    x = x ^ (x >> np.uint64(27))
    x = x * np.uint64(0x94D049BB133111EB)
    return x ^ (x >> np.uint64(31))


def list_arrays(column) -> tuple[np.ndarray, np.ndarray]:
    """Flat uint64 values and offsets of an Arrow list<int64> column."""
    import pyarrow as pa

    a = column.combine_chunks() if isinstance(column, pa.ChunkedArray) else column
    if a.null_count:
        a = a.fill_null([])
    offsets = np.asarray(a.offsets, dtype=np.int64)
    values = np.asarray(a.values)[offsets[0]:offsets[-1]].astype(np.int64).view(np.uint64)
    return values, offsets - offsets[0]


def shingles(words: np.ndarray, offsets: np.ndarray, k: int = SHINGLE) -> tuple[np.ndarray, np.ndarray]:
    """Hashes of all ``k``-word shingles of each text, in text order, with their
    offsets.  A text of 1 to k-1 words has one shingle, all its words; a text
    without words has none."""
    keep = words != EMPTY_WORD
    kept = np.concatenate(([0], np.cumsum(keep)))
    words, offsets = words[keep], kept[offsets]
    lens = np.diff(offsets)
    counts = np.where(lens >= k, lens - k + 1, np.minimum(lens, 1))
    out = np.concatenate(([0], np.cumsum(counts)))
    at = np.arange(out[-1]) + np.repeat(offsets[:-1] - out[:-1], counts)
    short = np.repeat(lens < k, counts)
    end = np.repeat(offsets[1:], counts)
    padded = np.concatenate((words, np.zeros(k, dtype=np.uint64)))
    h = np.zeros(len(at), dtype=np.uint64)
    for j in range(k):
        w = padded[at + j]
        if short.any():
            w[short & (at + j >= end)] = 0
        h = h * np.uint64(0x9E3779B97F4A7C15) + w
    return mix(h), out


def text_chunks(column, limit: int = CHUNK):
    """Split an Arrow list column into runs of texts with about ``limit`` words;
    yields (first row, row after the last, flat words, offsets)."""
    words, offsets = list_arrays(column)
    start = 0
    while start < len(offsets) - 1:
        stop = int(np.searchsorted(offsets, offsets[start] + limit, side="right")) - 1
        stop = min(max(stop, start + 1), start + 60_000, len(offsets) - 1)
        yield start, stop, words[offsets[start]:offsets[stop]], offsets[start:stop + 1] - offsets[start]
        start = stop


def union_find(n: int, left: np.ndarray, right: np.ndarray) -> np.ndarray:
    """Smallest index of the component of each of ``n`` nodes."""
    root = np.arange(n)
    while True:
        low = np.minimum(root[left], root[right])
        new = root.copy()
        np.minimum.at(new, root[left], low)
        np.minimum.at(new, root[right], low)
        new = new[new]
        if (new == root).all():
            return root
        root = new


def components(edges: DataFrame) -> DataFrame:
    """``edges(a, b)`` -> ``(id, component)`` with the smallest id reachable,
    only for ids with an edge.  Min-label hooking with pointer jumping on
    written tables: logarithmic rounds in practice, edges never grow, hub ids
    are only skewed join keys."""
    e = edges.select(F.greatest("a", "b").alias("a"), F.least("a", "b").alias("b")).filter("a <> b").distinct()
    e = materialise(e, "edges")
    while True:
        # large star: neighbours above a node go to the smallest of its neighbourhood
        low = e.groupBy(F.col("a").alias("n")).agg(F.min("b").alias("m"))
        large = (e.join(low.withColumnRenamed("n", "b"), "b", "left")
                 .select("a", F.coalesce("m", "b").alias("b")).distinct())
        low2 = large.groupBy("a").agg(F.min("b").alias("m"))
        small = (large.join(low2, "a")
                 .select(F.when(F.col("b") == F.col("m"), F.col("a")).otherwise(F.col("b")).alias("a"), F.col("m").alias("b"))
                 .filter("a <> b").distinct())
        e = materialise(small, "edges")
        targets = e.select(F.col("b").alias("a")).distinct()
        done = (e.groupBy("a").count().filter("count > 1").limit(1).count() == 0
                and e.join(targets, "a", "left_semi").limit(1).count() == 0)
        if done:
            break
    stars = e.select(F.col("a").alias("id"), F.col("b").alias("component"))
    return stars.unionByName(e.select(F.col("b").alias("id"), F.col("b").alias("component")).distinct())


def hash_sample(df: DataFrame, rows: int) -> DataFrame:
    """The ``rows`` rows whose doc_id has the smallest hash: the bounded sample
    on which classifiers are fitted.  Ids are ranked alone; the other columns
    are read only for the rows that stay."""
    h = F.xxhash64(F.col("doc_id"))
    last = df.select(h.alias("h")).orderBy("h").limit(rows).agg(F.max("h")).first()[0]
    return df.filter(h <= F.lit(last if last is not None else 0)).limit(rows)


def spread(df: DataFrame, spark: SparkSession) -> DataFrame:
    """Deal small rows evenly over the session's shuffle partitions."""
    return df.repartition(int(spark.conf.get("spark.sql.shuffle.partitions")))
