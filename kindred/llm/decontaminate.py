"""Benchmark decontamination by exact containment search.

An item is its set of shingles.  The documents are read once; a Bloom filter of
fixed size (the items' shingles) keeps shingles that occur in no item from
leaving that pass, and a filter that fills up lets more through but loses
nothing.  The shingles that pass are joined with the items' and counted, so the
containment of every item in every whole document is exact, wherever in the
document its shingles lie and however short the item is.
"""

from __future__ import annotations

import numpy as np
from pyspark.sql import DataFrame
from pyspark.sql import functions as F

from kindred.llm.common import list_arrays, materialise, row_keys, shingles, spread, text_chunks, word_hashes

#: Bits of the Bloom filter: 1 MB, the proven bound of what is broadcast.
BLOOM_BITS = 1 << 23


def in_bloom(bits: np.ndarray, keys: np.ndarray) -> np.ndarray:
    size = np.uint64(BLOOM_BITS - 1)
    hit = np.ones(len(keys), dtype=bool)
    for shift in (0, 32):
        at = (keys >> np.uint64(shift)) & size
        hit &= (bits[at >> np.uint64(3)] >> (at & np.uint64(7)).astype(np.uint8)) & 1 == 1
    return hit


def item_index(items: DataFrame) -> DataFrame:
    """(item_id, n, shingles array<long>) for items with a shingle."""

    def run(batches):
        import pyarrow as pa

        for batch in batches:
            values, offsets = list_arrays(batch.column("words"))
            sh, off = shingles(values, offsets)
            ids = batch.column("item_id").to_pylist()
            rows = []
            for i, item in enumerate(ids):
                own = np.unique(sh[off[i]:off[i + 1]])
                if not len(own):
                    continue
                rows.append((item, len(own), own.view(np.int64).tolist()))
            yield pa.RecordBatch.from_pylist(
                [dict(zip(("item_id", "n", "shingles"), r)) for r in rows],
                schema=pa.schema([("item_id", pa.int64()), ("n", pa.int64()), ("shingles", pa.list_(pa.int64()))]))

    words = items.select(F.col("item_id").cast("long").alias("item_id"), word_hashes().alias("words"))
    return materialise(spread(words, items.sparkSession).mapInArrow(
        run, "item_id long, n long, shingles array<long>"), "items")


def bloom(values: DataFrame) -> np.ndarray:
    """Bloom filter of the column ``v`` as BLOOM_BITS / 8 bytes.  Set bits are
    or-ed by Spark; at most BLOOM_BITS / 64 words come back, whatever the input."""
    at = F.explode(F.array(F.col("v").bitwiseAND(BLOOM_BITS - 1), F.shiftrightunsigned("v", 32).bitwiseAND(BLOOM_BITS - 1)))
    words = (values.select(at.alias("at")).groupBy(F.shiftright("at", 6).alias("w"))
             .agg(F.bit_or(F.expr("shiftleft(1L, cast(at & 63 as int))")).alias("b")))
    bits = np.zeros(BLOOM_BITS // 64, dtype=np.int64)
    table = words.toPandas()
    bits[table["w"].to_numpy(dtype=np.int64)] = table["b"].to_numpy(dtype=np.int64)
    return bits.view(np.uint8)


def document_hits(docs: DataFrame, shingle_bits: np.ndarray) -> DataFrame:
    """One scan of the documents: (did, th, v) with the distinct shingles that pass
    the Bloom filter."""
    shared = docs.sparkSession.sparkContext.broadcast(shingle_bits)

    def run(batches):
        import pyarrow as pa

        for batch in batches:
            did, th = np.asarray(batch.column("_did")), np.asarray(batch.column("_th"))
            for start, stop, words, offsets in text_chunks(batch.column("words")):
                sh, off = shingles(words, offsets)
                hit = in_bloom(shared.value, sh)
                rec = np.unique(np.rec.fromarrays((np.repeat(np.arange(stop - start), np.diff(off))[hit], sh[hit]), names="r,v"))
                if len(rec):
                    at = rec.r + start
                    yield pa.RecordBatch.from_arrays(
                        [pa.array(did[at]), pa.array(th[at]), pa.array(rec.v.view(np.int64))], names=["did", "th", "v"])

    words = row_keys(docs).select("_did", "_th", word_hashes().alias("words"))
    return materialise(words.mapInArrow(run, "did long, th long, v long"), "hits")


def contamination(docs: DataFrame, items: DataFrame, threshold: float = 0.8) -> DataFrame:
    """Leaks: (doc_id as ``did``, ``th``, item_id, containment) for every item of
    which at least ``threshold`` of the distinct five-word shingles occur in the
    document; other documents do not appear.

    Items without a word match nothing; an item of one to four words is one
    shingle and matches only a text of exactly these words.  Null ids of
    documents are replaced by the text's hash; repeated rows give one leak; null
    and empty texts and empty tables give none."""
    own = item_index(items).select("item_id", "n", F.explode("shingles").alias("v"))
    hits = document_hits(docs, bloom(own.select("v").distinct()))
    found = (hits.join(own, "v").groupBy("did", "th", "item_id", "n")
             .agg(F.count_distinct("v").alias("m")).filter(F.col("m") >= threshold * F.col("n")))
    return found.select("did", "th", "item_id", (F.col("m") / F.col("n")).alias("containment"))


def clean_documents(docs: DataFrame, items: DataFrame, threshold: float = 0.8) -> DataFrame:
    """``docs`` without the documents that hold a benchmark item."""
    leaks = contamination(docs, items, threshold).select(F.col("did").alias("_did"), F.col("th").alias("_th")).distinct()
    leaks = materialise(leaks, "leaks")
    return row_keys(docs).join(leaks, ["_did", "_th"], "left_anti").select(*docs.columns)
