"""Source divergence audit: how far each source of a language departs from the rest.

Terms are found by a token-start pointer sort.  A shard is a run of documents' text
buffers as Arrow holds them: every byte that starts a term is a pointer.  The pointers
are ordered by multikey quicksort over letters of eight bytes: a pass sorts the open
slices by their next letter, and a slice of equal letters goes on with the following
one until its terms end.  Runs of equal terms then give, per (lang, source) group,
the occurrences and the documents that hold the term.  Shards are folded to one row per
term and group before anything is shuffled, so a hot source or a very frequent term is
one row a shard.

The arithmetic is exact: 1e9 * (count + 5) and its quotient are decimals of 38 digits,
divided as integers.  Distances of all pairs of a language's sources are summed from
blocks of terms (each term's vector of p over the sources) and never join sources with
each other per term.

Defined results: null text, lang and source count as ''; repeated rows are documents
of their own; a language without kept terms gives distances of 0 and no terms; a
language of one source gives no pairs; other columns are not read; an empty table
gives an empty one.
"""

from __future__ import annotations

import numpy as np
from pyspark.sql import Column, DataFrame
from pyspark.sql import functions as F
from pyspark.sql.window import Window

from kindred.llm.common import broadcast_if_small, materialise

MIN_DOCS, SMOOTH, SCALE, TOP = 30, 5, 1_000_000_000, 50
#: Bytes of text in one shard (one document at least); bounds a task's memory.
SHARD = 8_000_000
#: Cells of one block of terms times sources.
CELLS = 2_000_000


def term_pointers(data: np.ndarray, offsets: np.ndarray) -> tuple[np.ndarray, np.ndarray, np.ndarray]:
    """Start, length and document of every term in a text buffer: runs of ASCII
    letters and of bytes of characters beyond ASCII, never across documents."""
    low = data | 0x20
    inside = ((low >= 0x61) & (low <= 0x7A)) | (data >= 0x80)
    edge = np.zeros(len(data) + 1, dtype=bool)
    edge[offsets] = True
    before = np.concatenate(([False], inside[:-1])) if len(data) else inside
    starts = np.flatnonzero(inside & (~before | edge[:-1]))
    after = np.concatenate((inside[1:], [False])) if len(data) else inside
    ends = np.flatnonzero(inside & (~after | edge[1:])) + 1
    return starts, ends - starts, np.searchsorted(offsets, starts, side="right") - 1


def letters_at(data: np.ndarray, at: np.ndarray, left: np.ndarray) -> np.ndarray:
    """The eight bytes at each pointer as one big-endian number, zero after the term's end."""
    key = np.zeros(len(at), dtype=np.uint64)
    for j in range(8):
        byte = np.where(left > j, data[np.minimum(at + j, len(data) - 1)], 0).astype(np.uint64)
        key |= byte << np.uint64(56 - 8 * j)
    return key


def pointer_sort(data: np.ndarray, starts: np.ndarray, sizes: np.ndarray) -> tuple[np.ndarray, np.ndarray]:
    """Order of the pointers by the terms they start, and the run of equal terms that
    each place of that order belongs to.

    Terms hold no zero byte, so equal letters that are padded end at the same place."""
    order = np.arange(len(starts))
    run = np.zeros(len(starts), dtype=np.int64)
    open_ = np.arange(len(starts))
    depth = 0
    while len(open_):
        p = order[open_]
        key = letters_at(data, starts[p] + depth, sizes[p] - depth)
        more = sizes[p] > depth + 8          # a term comes before those that go on after it
        by = np.lexsort((more, key, run[open_]))
        order[open_], key, slice_, more = p[by], key[by], run[open_][by], more[by]
        fresh = np.ones(len(open_), dtype=bool)
        fresh[1:] = (key[1:] != key[:-1]) | (slice_[1:] != slice_[:-1]) | (more[1:] != more[:-1])
        # a run is named by its first place, so names keep the order of slices
        run[open_] = open_[np.maximum.accumulate(np.where(fresh, np.arange(len(open_)), 0))]
        depth += 8
        open_ = open_[more]
    return order, run


def shard_counts(data: np.ndarray, offsets: np.ndarray, group: np.ndarray):
    """Terms of a shard as (start, length, group, occurrences, documents) per term and group."""
    folded = np.where((data >= 0x41) & (data <= 0x5A), data | 0x20, data)
    starts, sizes, doc = term_pointers(folded, offsets)
    order, run = pointer_sort(folded, starts, sizes)
    doc, first = doc[order], order[run]          # any pointer of the run shows its term
    by = np.lexsort((doc, group[doc], run))
    doc, run, first = doc[by], run[by], first[by]
    grp = group[doc]
    fresh = np.ones(len(doc), dtype=bool)
    fresh[1:] = (run[1:] != run[:-1]) | (grp[1:] != grp[:-1])
    new_doc = fresh.copy()
    new_doc[1:] |= doc[1:] != doc[:-1]
    at = np.flatnonzero(fresh)
    count = np.diff(np.append(at, len(doc)))
    docs = np.add.reduceat(new_doc.astype(np.int64), at) if len(at) else at
    return folded, starts[first[at]], sizes[first[at]], grp[at], count, docs


def term_counts(docs: DataFrame) -> DataFrame:
    """Shard by shard ``(lang, source, term, n, docs)``: occurrences and documents per
    term and group, plus a row with an empty term for every group, so that one
    without terms stays."""
    own = docs.select(*(F.coalesce(F.col(c), F.lit("")).alias(c) for c in ("lang", "source", "text")))

    def run(batches):
        import pyarrow as pa

        held, size = [], 0
        for batch in batches:
            for lo, hi in _cuts(batch.column(2)):
                held.append(batch.slice(lo, hi - lo))
                size += _buffer(held[-1].column(2))[0].size
                if size >= SHARD:
                    yield shard(held, pa)
                    held, size = [], 0
        if held:
            yield shard(held, pa)

    def shard(held, pa):
        t = pa.Table.from_batches(held).combine_chunks()
        lang, source = (t.column(c).combine_chunks().dictionary_encode() for c in (0, 1))
        both = np.asarray(lang.indices).astype(np.int64) * len(source.dictionary) + np.asarray(source.indices)
        _, keep, group = np.unique(both, return_index=True, return_inverse=True)
        data, offsets = _buffer(t.column(2).combine_chunks())
        folded, starts, sizes, grp, count, held_by = shard_counts(data, offsets, group)
        raw = folded.tobytes()
        terms = [raw[s:s + n].decode() for s, n in zip(starts.tolist(), sizes.tolist())]
        rep = np.concatenate((keep[grp], keep)).astype(np.int64)
        none = np.zeros(len(keep), dtype=np.int64)
        return pa.RecordBatch.from_arrays(
            [t.column(0).combine_chunks().take(pa.array(rep)), t.column(1).combine_chunks().take(pa.array(rep)),
             pa.array([*terms, *[""] * len(keep)], type=pa.string()),
             pa.array(np.concatenate((count, none))), pa.array(np.concatenate((held_by, none)))],
            names=["lang", "source", "term", "n", "docs"])

    return own.mapInArrow(run, "lang string, source string, term string, n long, docs long")


def _buffer(text) -> tuple[np.ndarray, np.ndarray]:
    """Bytes and document offsets of an Arrow string array, without copying."""
    import pyarrow as pa

    kind = np.int64 if pa.types.is_large_string(text.type) else np.int32
    if not len(text):
        return np.empty(0, dtype=np.uint8), np.zeros(1, dtype=np.int64)
    _, offsets, data = text.buffers()
    offsets = np.frombuffer(offsets, dtype=kind)[text.offset:text.offset + len(text) + 1].astype(np.int64)
    data = np.frombuffer(data, dtype=np.uint8) if data is not None else np.empty(0, dtype=np.uint8)
    return data[offsets[0]:offsets[-1]], offsets - offsets[0]


def _cuts(text):
    """Row ranges of a batch with about a shard of text each, one row at least."""
    offsets = _buffer(text)[1]
    start = 0
    while start < len(offsets) - 1:
        stop = int(np.searchsorted(offsets, offsets[start] + SHARD, side="right")) - 1
        stop = min(max(stop, start + 1), len(offsets) - 1)
        yield start, stop
        start = stop


def kept_terms(docs: DataFrame, min_docs: int = MIN_DOCS) -> DataFrame:
    """``(lang, term, n, held)`` of the terms in at least ``min_docs`` documents of the
    language, ``held`` being (source, n) of the sources that have it; and one row with an
    empty term per language, whose ``held`` names all its sources.

    Shards are dealt by (lang, term) once, which serves both sums."""
    per = (term_counts(docs).repartition("lang", "term").groupBy("lang", "source", "term")
           .agg(F.sum("n").alias("n"), F.sum("docs").alias("docs")))
    return (per.groupBy("lang", "term")
            .agg(F.sum("n").alias("n"), F.sum("docs").alias("docs"), F.collect_list(F.struct("source", "n")).alias("held"))
            .filter((F.col("docs") >= min_docs) | (F.col("term") == "")).drop("docs"))


def _p(count: Column, total: Column, kept: Column) -> Column:
    """1 + floor(1e9 (count + 5) / (N + 5 V)), exact; a language without terms has no use for it."""
    wide = "decimal(38,0)"
    top = ((count + SMOOTH).cast("decimal(28,0)") * F.lit(SCALE).cast("decimal(10,0)")).cast(wide)
    return (F.lit(1) + F.call_function("div", top, F.greatest(total + SMOOTH * kept, F.lit(1)).cast(wide))).cast("long")


def source_groups(kept: DataFrame) -> DataFrame:
    """One row per (lang, source): ``total`` its occurrences of kept terms, ``lang_total``
    the language's, ``v`` kept terms, ``k`` its place among the language's sources."""
    own = kept.select("lang", "term", F.inline("held"))
    per = own.groupBy("lang", "source").agg(F.sum("n").alias("total"))
    lang = kept.groupBy("lang").agg(F.sum("n").alias("lang_total"), F.count(F.when(F.col("term") != "", 1)).alias("v"))
    k = F.row_number().over(Window.partitionBy("lang").orderBy("source")) - 1
    return per.join(lang, "lang").withColumn("k", k)


def _distances(batches):
    """Sums of |p - q| for all pairs of a language's sources, over the task's terms."""
    import pyarrow as pa

    sums: dict[str, np.ndarray] = {}
    for batch in batches:
        langs, terms = batch.column("lang").to_pylist(), batch.column("term").to_pylist()
        rows: dict[str, list[int]] = {}
        for i, lang in enumerate(langs):
            rows.setdefault(lang, []).append(i)
        for lang, own in rows.items():
            base = np.asarray(batch.column("base")[own[0]].values, dtype=np.int64)
            total = sums.setdefault(lang, np.zeros((len(base), len(base)), dtype=np.int64))
            own = [i for i in own if terms[i]]
            step = max(CELLS // len(base), 1)
            for s in range(0, len(own), step):
                part = own[s:s + step]
                p = np.tile(base, (len(part), 1))
                for row, i in zip(p, part):
                    row[np.asarray(batch.column("ks")[i].values)] = np.asarray(batch.column("ps")[i].values)
                for j in range(len(base)):
                    total[j] += np.abs(p - p[:, j:j + 1]).sum(axis=0)
    for lang, total in sums.items():
        a, b = np.nonzero(~np.eye(len(total), dtype=bool))
        yield pa.RecordBatch.from_arrays([pa.array([lang] * len(a), type=pa.string()), pa.array(a), pa.array(b), pa.array(total[a, b])],
                                         names=["lang", "a", "b", "value"])


def audit_sources(docs: DataFrame, min_docs: int = MIN_DOCS, top: int = TOP) -> DataFrame:
    """``lang, source, part, item, value, rank``: part ``pair`` has the distance to
    every other source of the language, part ``term`` the ``top`` terms that the source
    has more of than its language."""
    kept = materialise(kept_terms(docs, min_docs), "terms")
    groups = materialise(source_groups(kept), "groups")
    n_groups = groups.count()
    small = lambda df: broadcast_if_small(df, n_groups)
    sums = groups.select("lang", "source", "total", "lang_total", "v", "k")
    cells = (kept.select("lang", "term", F.col("n").alias("lang_n"), F.inline("held")).join(small(sums), ["lang", "source"])
             .select("lang", "source", "term", "k", "n", _p(F.col("n"), F.col("total"), F.col("v")).alias("p"),
                     _p(F.col("lang_n"), F.col("lang_total"), F.col("v")).alias("q")))

    more = cells.filter((F.col("term") != "") & (F.col("n") > 0) & (F.col("p") > F.col("q"))).select(
        "lang", "source", F.lit("term").alias("part"), F.col("term").alias("item"), (F.col("p") - F.col("q")).alias("value"))
    by = Window.partitionBy("lang", "source").orderBy(F.col("value").desc(), "item")
    terms = more.withColumn("rank", F.row_number().over(by)).filter(F.col("rank") <= top)

    bases = groups.groupBy("lang").agg(F.sort_array(F.collect_list(F.struct(
        "k", _p(F.lit(0), F.col("total"), F.col("v")).alias("p")))).getField("p").alias("base"))
    vectors = (cells.groupBy("lang", "term").agg(F.collect_list("k").alias("ks"), F.collect_list("p").alias("ps"))
               .join(small(bases), "lang").select("lang", "term", "ks", "ps", "base"))
    sums = (vectors.mapInArrow(_distances, "lang string, a long, b long, value long")
            .groupBy("lang", "a", "b").agg(F.sum("value").alias("value")))
    name = lambda k, c: small(groups.select("lang", F.col("k").cast("long").alias(k), F.col("source").alias(c)))
    pairs = (sums.join(name("a", "source"), ["lang", "a"]).join(name("b", "item"), ["lang", "b"])
             .select("lang", "source", F.lit("pair").alias("part"), "item", "value").withColumn("rank", F.row_number().over(by)))
    return pairs.unionByName(terms)
