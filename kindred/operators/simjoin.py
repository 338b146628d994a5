"""Near-duplicate self-joins inside a blocking key.

Input rows carry ``kind`` (the block), ``id`` and ``value`` (normalised text).
Rows of a kind with one text are a class, its smallest id the representative.
Joins work on classes and return them factorised, as *links*
``(kind, id, sim_id, score, link)``: one row ``near`` per pair of classes that are
similar (representatives, ``id < sim_id``) and one row ``copy`` per member that is
not the representative (``id`` = representative, score 100).  A group of c copies is
c - 1 rows, never c * c / 2; empty texts are a class like any other.  Reports compute
what they need from class sizes (:mod:`kindred.operators.report`).  :func:`row_pairs` and
its users give every pair of rows: classes are compared once and expanded in tiles.

Every join is an *equi*-join on ``kind`` plus a derived key (length bucket, prefix,
segment, SimHash band, Hamming block or tile), never a cross join.  Buckets beyond
``TILE`` rows are split into tiles, so that a hot bucket is many bounded joins.  Where the
key hardly tells rows apart (lengths, bands of a few bits), rows are dealt into tiles
(:mod:`kindred.operators.tiles`): signatures are compared and texts refined inside a
tile, so a text travels once per tile and not once per candidate pair.
"""

from __future__ import annotations

import math
from collections.abc import Sequence
from itertools import combinations

from pyspark.sql import Column, DataFrame
from pyspark.sql import functions as F

from kindred.functions import similarity as S
from kindred.functions.editdistance import fast_levenshtein
from kindred.operators.parallel import balance, spread
from kindred.operators.signature import simhash
from kindred.operators.tiles import TILE_KEY, dealt, tiled_pairs
from kindred.session import cut_lineage, write_once

LINK_COLS = ["kind", "id", "sim_id", "score", "link"]
NEAR, COPY = "near", "copy"
#: Rows of a bucket that one tile joins with each other.
TILE = 1000
#: Rows of a slice whose signatures, and whose texts, are compared with another slice's.
SIG_TILE, TEXT_TILE = 8000, 1000
#: Bits of a band from which its buckets are selective enough for an equi-join.
SELECTIVE_BITS = 8
#: Values that a row may look up in an exact Hamming join.
MAX_PROBES = 2000
#: Longer texts of a pair up to this length meet by segments, others by length.
SEGMENT_MAX = 64


def mirror(pairs: DataFrame) -> DataFrame:
    """Both directions of links ``(id, sim_id)``."""
    other = [F.col("sim_id").alias("id"), F.col("id").alias("sim_id")]
    rest = [c for c in pairs.columns if c not in ("id", "sim_id")]
    return pairs.unionByName(pairs.select(*other, *rest))


# --- classes of equal texts ------------------------------------------------

def text_classes(df: DataFrame) -> tuple[DataFrame, DataFrame]:
    """``(reps(kind, id, value), copies(kind, id, sim_id, score, link))``: the smallest
    id of every text of a kind, and a link to it from each other row with that
    text.  A null text counts as empty.  Texts are written once; members find their
    class by the SHA-256 of the text, so texts move in one shuffle."""
    value = F.coalesce("value", F.lit(""))
    texts = df.select("kind", "id", value.alias("value"), F.sha2(value, 256).alias("_d"))
    reps = cut_lineage(texts.groupBy("kind", "_d", "value").agg(F.min("id").alias("rep")))
    copies = (texts.select("kind", "id", "_d").join(reps.select("kind", "_d", "rep"), ["kind", "_d"])
              .filter(F.col("id") != F.col("rep"))
              .select("kind", F.col("rep").alias("id"), F.col("id").alias("sim_id"),
                      F.lit(100.0).alias("score"), F.lit(COPY).alias("link")))
    return reps.select("kind", F.col("rep").alias("id"), "value"), copies


def row_classes(df: DataFrame) -> tuple[DataFrame, DataFrame]:
    """``(reps(kind, id, value), members(kind, cls, id))``: the texts of a kind under a number,
    and every row with the number of its text.  A text of one row has its id (not
    negative) as number, others a negative one of their own.  Ids may repeat,
    also with different texts; rows without kind or id pair with nothing."""
    rows = df.filter(F.col("kind").isNotNull() & F.col("id").isNotNull())
    value = F.coalesce("value", F.lit(""))
    texts = rows.select("kind", "id", value.alias("value"), F.sha2(value, 256).alias("_d"))
    one = F.when((F.col("_n") == 1) & (F.col("_id") >= 0), F.col("_id").cast("long"))
    reps = write_once(texts.groupBy("kind", "_d", "value").agg(F.count(F.lit(1)).alias("_n"), F.min("id").alias("_id"))
                      .withColumn("_own", -1 - F.monotonically_increasing_id())
                      .select("kind", "_d", "value", F.coalesce(one, "_own").alias("cls")), "texts")
    members = texts.select("kind", "id", "_d").join(reps.select("kind", "_d", "cls"), ["kind", "_d"])
    return reps.select("kind", F.col("cls").alias("id"), "value"), members.select("kind", "cls", "id")


def row_pairs(near: DataFrame, members: DataFrame, carry: dict[str, Column], tile: int | None = None, once: bool = True) -> DataFrame:
    """Every pair of rows that ``near(kind, id, sim_id, ...)`` pairs of classes stand for, and
    every pair of rows of one class: ``(kind, id, sim_id)`` with ``id < sim_id`` and the
    columns ``carry``, whose values are those of copies.

    A pair of two texts of one row each is given as it is and moves no more.  A class of n
    rows is dealt into ceil(n / tile) slices, and a pair of classes is joined
    slice by slice, so no key has more than about ``tile`` rows on a side.  ``near`` is
    written, as it is read twice, unless ``once`` is off: cheap pairs that are many."""
    tile = tile or TILE
    near = write_once(near, "near") if once else near
    plain = (F.col("id") >= 0) & (F.col("sim_id") >= 0)
    kept_type = members.schema["id"].dataType
    direct = near.filter(plain).select("kind", F.least("id", "sim_id").cast(kept_type).alias("id"),
                                       F.greatest("id", "sim_id").cast(kept_type).alias("sim_id"), *carry)
    near = near.filter(~plain)
    members = cut_lineage(members)
    # texts of one row with the same id are one partner here: their pairs are rows of ``near`` of their own
    members = members.filter(F.col("cls") < 0).unionByName(members.filter(F.col("cls") >= 0).distinct())
    sizes = members.groupBy("kind", "cls").agg(F.count(F.lit(1)).alias("_n"))
    slices = sizes.select("kind", "cls", "_n", F.ceil(F.col("_n") / F.lit(tile)).cast("int").alias("_g"))
    own = members.join(slices, ["kind", "cls"]).select(
        "kind", "cls", "id", "_n", F.pmod(F.xxhash64("id"), F.col("_g")).cast("int").alias("_s"))
    g = slices.select("kind", "cls", "_g")
    met = (near.join(g.select("kind", F.col("cls").alias("id"), F.col("_g").alias("_gl")), ["kind", "id"])
           .join(g.select("kind", F.col("cls").alias("sim_id"), F.col("_g").alias("_gr")), ["kind", "sim_id"])
           .select("kind", F.col("id").alias("_l"), F.col("sim_id").alias("_r"), *carry, "_gr",
                   F.explode(F.sequence(F.lit(0), F.col("_gl") - 1)).alias("_i"))
           .select("kind", "_l", "_r", *carry, "_i", F.explode(F.sequence(F.lit(0), F.col("_gr") - 1)).alias("_j")))
    left = own.select("kind", F.col("cls").alias("_l"), F.col("_s").alias("_i"), "id")
    right = own.select("kind", F.col("cls").alias("_r"), F.col("_s").alias("_j"), F.col("id").alias("sim_id"))
    across = met.join(left, ["kind", "_l", "_i"]).join(right, ["kind", "_r", "_j"]).filter(F.col("id") != F.col("sim_id"))
    ends = ["kind", F.least("id", "sim_id").alias("id"), F.greatest("id", "sim_id").alias("sim_id")]
    within = tiled_self_join(own.filter(F.col("_n") > 1).select("kind", "cls", "id"), ["kind", "cls"], [], tile)
    return direct.unionByName(across.select(*ends, *carry)).unionByName(within.select(*ends, *[v.alias(c) for c, v in carry.items()]))


def links(scored: DataFrame, copies: DataFrame) -> DataFrame:
    """Scored pairs of representatives and the copies as one table of links."""
    near = scored.select("kind", "id", "sim_id", "score", F.lit(NEAR).alias("link"))
    return near.unionByName(copies.select(*LINK_COLS))


def class_sizes(found: DataFrame) -> DataFrame:
    """``(kind, id, size, second)`` of the classes with copies: how many rows they
    have, and the smallest id beside the representative."""
    return (found.filter(F.col("link") == COPY).groupBy("kind", "id")
            .agg((F.count(F.lit(1)) + 1).alias("size"), F.min("sim_id").alias("second")))


def weighted_links(found: DataFrame) -> DataFrame:
    """Links by class, ``(kind, id, sim_id, pairs)``: how many pairs of rows each stands
    for.  ``id = sim_id`` is a class with itself, its copies."""
    sizes = class_sizes(found)
    size = F.coalesce(F.col("size"), F.lit(1).cast("long"))
    near = (found.filter(F.col("link") == NEAR).select("kind", "id", "sim_id")
            .join(sizes.select("kind", "id", size.alias("_l")), ["kind", "id"], "left")
            .join(sizes.select("kind", F.col("id").alias("sim_id"), size.alias("_r")), ["kind", "sim_id"], "left"))
    one = F.lit(1).cast("long")
    own = sizes.select("kind", "id", F.col("id").alias("sim_id"), (F.col("size") * (F.col("size") - 1) / 2).cast("long").alias("pairs"))
    return near.select("kind", "id", "sim_id", (F.coalesce("_l", one) * F.coalesce("_r", one)).alias("pairs")).unionByName(own)


# --- bounded buckets ---------------------------------------------------------

def tiled_self_join(rows: DataFrame, keys: Sequence[str], carry: Sequence[str], tile: int = TILE) -> DataFrame:
    """Every pair of rows that agree in ``keys``, once: columns ``keys``, ``id`` and
    ``sim_id``, and ``carry`` plain for the one and with ``_r`` for the other side.

    A histogram finds the buckets beyond ``tile`` rows.  Such a bucket of n rows is
    dealt by hash into g = ceil(n / tile) slices; slices i <= j meet in tile (i, j),
    so no key of the join has more than about ``tile`` rows on a side."""
    heavy = (rows.groupBy(*keys).agg(F.count(F.lit(1)).alias("_n")).filter(F.col("_n") > tile)
             .select(*keys, F.ceil(F.col("_n") / F.lit(tile)).cast("int").alias("_g")))
    g = F.coalesce(F.col("_g"), F.lit(1))
    own = rows.join(heavy, list(keys), "left").withColumn("_g", g).withColumn(
        "_s", F.pmod(F.xxhash64("id"), F.col("_g")).cast("int"))
    left = own.select(*keys, "id", *carry, F.col("_s").alias("_i"),
                      F.explode(F.sequence(F.col("_s"), F.col("_g") - 1)).alias("_j"))
    right = own.select(*keys, F.col("id").alias("sim_id"), *[F.col(c).alias(f"{c}_r") for c in carry],
                       F.explode(F.sequence(F.lit(0), F.col("_s"))).alias("_i"), F.col("_s").alias("_j"))
    return (left.join(right, [*keys, "_i", "_j"])
            .filter((F.col("_i") < F.col("_j")) | (F.col("id") < F.col("sim_id"))).drop("_i", "_j"))


def near_length_pairs(texts: DataFrame, min_similarity: float, tile: int | None = None) -> DataFrame:
    """Pairs of ``texts(kind, id, value)`` whose length ratio is at least ``min_similarity``
    percent, each once: ``(kind, id, sim_id, _lv, _rv)``.  A bucket of near lengths is
    joined in tiles, so a hot length is many bounded joins."""
    r = min_similarity / 100.0
    rows = texts.select("kind", "id", "value", F.length("value").alias("len")).filter(F.col("len") > 0)
    met = dealt(rows, S.log_bucket(F.col("len"), max(r - 1e-9, 1e-9)), tile or TILE)
    same = (F.col("_tu") == 0) & (F.col("_ts") == F.col("_tt"))
    left = met.filter("_left").select(*TILE_KEY, "id", F.col("len").alias("_ll"), F.col("value").alias("_lv"))
    right = met.filter(~F.col("_left") | same).select(
        *TILE_KEY, F.col("id").alias("sim_id"), F.col("len").alias("_rl"), F.col("value").alias("_rv"))
    lo, hi = F.least("_ll", "_rl").cast("double"), F.greatest("_ll", "_rl")
    return left.join(right, TILE_KEY).filter((~same | (F.col("id") < F.col("sim_id"))) & (lo / hi >= F.lit(r))).select(
        "kind", "id", "sim_id", "_lv", "_rv")


def detailed_pairs(df: DataFrame, min_similarity: float) -> DataFrame:
    """F4 for every pair of non-empty rows of near length, ``(kind, id, sim_id, distance,
    similarity, percentage)``: computed once per pair of texts, then expanded to rows."""
    reps, members = row_classes(df.filter(F.length("value") > 0))
    found = near_length_pairs(reps, min_similarity).select("kind", "id", "sim_id", S.pair_detail("_lv", "_rv").alias("p"))
    found = found.select("kind", "id", "sim_id", "p.distance", "p.similarity", "p.percentage")
    return row_pairs(found, members, {"distance": F.lit(0), "similarity": F.lit(1.0), "percentage": F.lit("100.0%")})


def _ordered(j: DataFrame) -> DataFrame:
    return j.select("kind", F.least("id", "sim_id").alias("id"), F.greatest("id", "sim_id").alias("sim_id"))


# --- J12: refinement ------------------------------------------------------------

def score_pairs(cands: DataFrame, texts: DataFrame, threshold: float,
                engine: str = "bitparallel") -> DataFrame:
    """Exact score of candidate pairs ``(kind, id, sim_id)``, kept when >= T.

    Texts are joined back by ``(kind, id)`` twice, the pairs are spread evenly
    over the cluster (the cost is CPU, not bytes), the lossless length bound
    drops hopeless pairs, and the edit distance runs with the largest distance
    that can still pass as early-exit bound; q-gram counts bound what the rest of a
    pair must cost, which ends most pairs after a fraction of their text.  All
    lengths take the same plan; ``engine='builtin'`` uses Spark's ``levenshtein``
    and gives the same value."""
    l = texts.select("kind", "id", F.col("value").alias("_lv"))
    r = texts.select("kind", F.col("id").alias("sim_id"), F.col("value").alias("_rv"))
    joined = cands.select("kind", "id", "sim_id").join(l, ["kind", "id"]).join(r, ["kind", "sim_id"])
    spread_pairs = balance(joined, "id", "sim_id")
    if engine == "builtin":
        scored = spread_pairs.select(
            "kind", "id", "sim_id", S.thresholded_score("_lv", "_rv", threshold).alias("score"))
    else:
        la, lb = F.length("_lv"), F.length("_rv")
        m = F.greatest(la, lb)
        live = spread_pairs.filter(S.length_ratio_ok(la, lb, threshold))
        with_d = live.select("kind", "id", "sim_id", m.alias("_m"),
                             fast_levenshtein(F.col("_lv"), F.col("_rv"),
                                              S.distance_bound(m, threshold)).alias("_d"))
        sim = F.when(F.col("_m") == 0, F.lit(1.0)).otherwise(
            (F.col("_m") - F.col("_d")).cast("double") / F.col("_m"))
        scored = with_d.select("kind", "id", "sim_id",
                               F.when(F.col("_d") < 0, F.lit(None).cast("double"))
                               .otherwise(S.score_pct(sim)).alias("score"))
    return scored.filter(F.col("score") >= F.lit(float(threshold))).select("kind", "id", "sim_id", "score")


# --- J4 / J6: length ranges -----------------------------------------------------

def length_histogram(df: DataFrame) -> DataFrame:
    """``(kind, len, n)``; a null text has length 0."""
    size = F.length(F.coalesce("value", F.lit("")))
    return df.select("kind", size.alias("len")).groupBy("kind", "len").agg(F.count(F.lit(1)).alias("n"))


def rows_up_to(hist: DataFrame, asked: DataFrame) -> DataFrame:
    """``asked(kind, at)`` with ``upto``, the rows of the kind no longer than ``at``.

    One ordered prefix sum per kind over the lengths that occur and those asked for;
    its rows are lengths, not texts."""
    from pyspark.sql import Window

    points = hist.select("kind", F.col("len").cast("long").alias("at"), "n", F.lit(0).alias("_q")).unionByName(
        asked.select("kind", F.col("at").cast("long").alias("at"), F.lit(0).cast("long").alias("n"), F.lit(1).alias("_q")).distinct())
    upto = F.sum("n").over(Window.partitionBy("kind").orderBy("at", "_q"))
    return points.withColumn("upto", upto).filter(F.col("_q") == 1).select("kind", "at", "upto")


def _counted(hist: DataFrame, low: Column, high: Column) -> DataFrame:
    """Histogram rows with ``_in``: rows whose length lies in [low, high]."""
    h = hist.select("*", (low - 1).cast("long").alias("_lo"), high.cast("long").alias("_hi"))
    sums = rows_up_to(hist, h.select("kind", F.col("_lo").alias("at")).unionByName(h.select("kind", F.col("_hi").alias("at"))))
    sums = cut_lineage(sums)
    return (h.join(sums.select("kind", F.col("at").alias("_lo"), F.col("upto").alias("_a")), ["kind", "_lo"])
            .join(sums.select("kind", F.col("at").alias("_hi"), F.col("upto").alias("_b")), ["kind", "_hi"])
            .withColumn("_in", F.col("_b") - F.col("_a")))


def length_ratio_classes(df: DataFrame, min_similarity: float) -> DataFrame:
    """J4 as classes ``(kind, len, n, n_links)``: each of the ``n`` rows of a length pairs
    with ``n_links`` others, those whose length ratio ``min/max`` is at least
    ``min_similarity/100``.  Empty texts pair with nothing and have no class."""
    r = F.lit(min_similarity / 100.0)
    hist = cut_lineage(length_histogram(df).filter(F.col("len") > 0))
    # the integer borders of the ratio test as doubles compute it
    ln = F.col("len").cast("double")
    lo, hi = F.ceil(ln * r), F.floor(ln / r)
    lo = F.when((lo - 1) / ln >= r, lo - 1).when(lo / ln < r, lo + 1).otherwise(lo)
    hi = F.when(ln / (hi + 1) >= r, hi + 1).when(ln / hi < r, hi - 1).otherwise(hi)
    return _counted(hist, lo, hi).select("kind", "len", "n", (F.col("_in") - 1).alias("n_links"))


def length_window_classes(df: DataFrame, threshold: float = 0.7) -> DataFrame:
    """J6 as classes ``(kind, len, n, n_longer, pairs)``: in (length, pos) order each of
    the ``n`` rows of a length meets the later rows of its own length and ``n_longer``
    rows of greater length, at most ``int(len / threshold)``; ``pairs`` counts both."""
    hist = cut_lineage(length_histogram(df))
    out = _counted(hist, F.col("len") + 1, F.greatest(F.floor(F.col("len") / F.lit(threshold)), F.col("len")))
    n = F.col("n")
    return out.select("kind", "len", "n", F.col("_in").alias("n_longer"),
                      (n * F.col("_in") + (n * (n - 1) / 2).cast("long")).alias("pairs"))


def with_length_class(df: DataFrame, classes: DataFrame) -> DataFrame:
    """Every row of ``df`` with its class of equal length: ``class_id``, the smallest id
    there, and the columns of ``classes(kind, len, ...)``."""
    rows = df.select("kind", "id", F.length(F.coalesce("value", F.lit(""))).alias("len"))
    first = rows.groupBy("kind", "len").agg(F.min("id").alias("class_id"))
    return rows.join(classes.join(first, ["kind", "len"]), ["kind", "len"])


def _length_band_join(df: DataFrame, ratio: float) -> DataFrame:
    """Pairs ``(a, b)`` with ``(len_a, id_a) < (len_b, id_b)`` and ``len_a/len_b``
    possibly >= ``ratio``: bucket ``floor(ln len / ln(1/ratio))``, the shorter
    side probes its bucket and the next one, equi-join on ``(kind, bucket)``."""
    width = max(ratio - 1e-9, 1e-9)
    base = df.select("kind", "id", "len", S.log_bucket(F.col("len"), width).alias("_b"))
    left = base.select("kind", F.col("id").alias("id"), F.col("len").alias("_ll"),
                       F.explode(F.array(F.col("_b"), F.col("_b") + 1)).alias("_b"))
    right = base.select("kind", F.col("id").alias("sim_id"), F.col("len").alias("_rl"), "_b")
    j = left.join(right, ["kind", "_b"])
    return j.filter((F.col("_ll") < F.col("_rl")) |
                    ((F.col("_ll") == F.col("_rl")) & (F.col("id") < F.col("sim_id"))))


def length_ratio_pairs(df: DataFrame, min_similarity: float) -> DataFrame:
    """J4 as a list: unordered pairs whose length ratio ``min/max >= min_similarity/100``;
    empty texts never pair.  Returns ``(kind, id, sim_id)`` with ``id < sim_id``.  As
    many rows as pairs: for small kinds; :func:`length_ratio_classes` counts them."""
    r = min_similarity / 100.0
    base = df.select("kind", "id", F.length("value").alias("len")).filter(F.col("len") > 0)
    j = _length_band_join(base, r)
    j = j.filter(F.col("_ll").cast("double") / F.col("_rl") >= F.lit(r))
    return _ordered(j)


def length_window_pairs(df: DataFrame, threshold: float = 0.7, pos: str = "id") -> DataFrame:
    """J6 as a list: sort by (length, pos); pair each row with later rows whose length
    is at most ``int(len / threshold)``.  Returns ``(kind, id, sim_id)``, shorter first."""
    base = df.select("kind", "id", F.col(pos).alias("_pos"), F.length("value").alias("len"))
    width = max(threshold - 1e-9, 1e-9)
    b = base.withColumn("_b", S.log_bucket(F.col("len"), width))
    left = b.select("kind", "id", F.col("_pos").alias("_lp"), F.col("len").alias("_ll"),
                    F.explode(F.array(F.col("_b"), F.col("_b") + 1)).alias("_b"))
    right = b.select("kind", F.col("id").alias("sim_id"), F.col("_pos").alias("_rp"),
                     F.col("len").alias("_rl"), "_b")
    j = left.join(right, ["kind", "_b"]).filter(
        ((F.col("_ll") < F.col("_rl")) | ((F.col("_ll") == F.col("_rl")) & (F.col("_lp") < F.col("_rp"))))
        & (F.col("_rl") <= F.floor(F.col("_ll") / F.lit(threshold)))
        & (F.col("_rl") >= F.floor(F.col("_ll") * F.lit(threshold))))
    return j.select("kind", "id", "sim_id")


# --- J5: shared prefixes -----------------------------------------------------------

def prefix_classes(df: DataFrame, min_similarity: float) -> DataFrame:
    """J5 as classes: rows that share the first ``int(r * shortest non-empty length of the
    kind)`` characters.  One row per text, ``(kind, id, class_id, n_links)``: the smallest
    id of its class and the number of others in it.

    Where the prefix has length 0 (a kind with a very short text) all non-empty texts of
    the kind are one class; empty texts have none."""
    r = min_similarity / 100.0
    t = df.select("kind", "id", "value").filter(F.length("value") > 0)
    k = t.groupBy("kind").agg(F.floor(F.min(F.length("value")) * F.lit(r)).cast("int").alias("_k"))
    keyed = t.join(k, "kind").select("kind", "id", F.xxhash64(F.expr("substring(value, 1, _k)")).alias("_h"),
                                     F.expr("substring(value, 1, _k)").alias("_pfx"))
    classes = keyed.groupBy("kind", "_pfx").agg(F.min("id").alias("class_id"), (F.count(F.lit(1)) - 1).alias("n_links"))
    return keyed.join(classes, ["kind", "_pfx"]).select("kind", "id", "class_id", "n_links")


def prefix_pairs(df: DataFrame, min_similarity: float, tile: int | None = None) -> DataFrame:
    """Pairs ``(kind, id, sim_id)`` that share the prefix of :func:`prefix_classes`,
    ``id < sim_id``.  The rows of a long bucket meet in tiles."""
    r = min_similarity / 100.0
    t = df.select("kind", "id", "value").filter((F.length("value") > 0) & F.col("kind").isNotNull() & F.col("id").isNotNull())
    k = t.groupBy("kind").agg(F.floor(F.min(F.length("value")) * F.lit(r)).cast("int").alias("_k"))
    keyed = cut_lineage(t.join(k, "kind").select("kind", "id", F.expr("substring(value, 1, _k)").alias("_pfx")))
    return _ordered(tiled_self_join(keyed, ["kind", "_pfx"], [], tile or TILE))


# --- J3: exact threshold join ------------------------------------------------

def _most_edits(m: Column, threshold: float) -> Column:
    """Edits that a pair whose longer text has ``m`` characters may differ by."""
    return F.floor(m * F.lit((100.0 - threshold + 0.005) / 100.0)).cast("int")


def segment_pairs(texts: DataFrame, threshold: float, longest: int = SEGMENT_MAX) -> DataFrame:
    """Candidates among short texts: all pairs within the edits that ``threshold`` allows
    whose longer text has at most ``longest`` characters.  Lossless for T >= 75.

    With at most k edits, one of k + 1 segments of the shorter text stands unchanged in
    the longer one.  Segment i can have moved by at most i places, counted from the left,
    and by k - i counted from the right, which leaves few substrings to look up."""
    if threshold < 75:
        raise ValueError("segments need a threshold of 75 or more")
    base = texts.select("kind", "id", "value", F.length("value").alias("len")).filter(
        (F.col("len") > 0) & (F.col("len") <= longest))
    ratio = (threshold - 0.005) / 100.0
    # start of segment i of k + 1 in a text of n characters, from 0
    cut = "cast(floor({n} * {i} / ({k} + 1)) as int)".format

    # the shorter side, for every k that a longer partner can have
    most = _most_edits(F.floor(F.col("len") / F.lit(ratio)), threshold)
    short = base.withColumn("k", F.explode(F.sequence(_most_edits(F.col("len"), threshold), most)))
    short = short.select("kind", "id", "len", "k", F.explode(F.expr("sequence(0, k)")).alias("i"), "value")
    a, b = cut(n="len", i="i", k="k"), cut(n="len", i="(i + 1)", k="k")
    short = short.select("kind", "id", "len", "k", "i", F.expr(f"substring(value, {a} + 1, {b} - {a})").alias("seg"))

    # the longer side, for every length that a shorter partner can have
    long = base.select("kind", F.col("id").alias("sim_id"), F.col("len").alias("m"), "value",
                       _most_edits(F.col("len"), threshold).alias("k"),
                       F.explode(F.sequence(F.ceil(F.col("len") * F.lit(ratio)).cast("int"), F.col("len"))).alias("len"))
    long = long.select("*", F.explode(F.expr("sequence(0, k)")).alias("i"))
    long = long.select("*", F.expr(a).alias("p"), F.expr(f"{b} - {a}").alias("w"))
    lo = "greatest(p - i, p + (m - len) - (k - i), 0)"
    hi = "least(p + i, p + (m - len) + (k - i), m - w)"
    long = long.filter(F.expr(f"{lo} <= {hi}")).select("*", F.explode(F.expr(f"sequence({lo}, {hi})")).alias("q"))
    long = long.select("kind", "sim_id", "m", "len", "k", "i", F.expr("substring(value, q + 1, w)").alias("seg"))

    met = short.join(long, ["kind", "len", "k", "i", "seg"]).filter(
        (F.col("len") < F.col("m")) | (F.col("id") < F.col("sim_id")))
    return _ordered(met).distinct()


def exact_candidates(texts: DataFrame, threshold: float) -> DataFrame:
    """Pairs of texts that the lossless filters of J3 leave: segments where both are
    short, length ratio elsewhere."""
    lens = texts.select("kind", "id", F.length("value").alias("len"))
    by_length = _length_band_join(lens, (threshold - 0.005) / 100.0).filter(
        S.length_ratio_ok(F.col("_ll"), F.col("_rl"), threshold))
    if threshold < 75:
        return _ordered(by_length)
    return _ordered(by_length.filter(F.col("_rl") > SEGMENT_MAX)).unionByName(segment_pairs(texts, threshold))


def near_duplicates_exact(df: DataFrame, threshold: float = 75) -> DataFrame:
    """Links of all texts of one kind whose rounded score is >= ``threshold``: short
    texts by segments, pairs with a longer text in tiles of near lengths."""
    reps, copies = text_classes(df)
    return links(exact_scored(reps, threshold), copies)


def exact_scored(reps: DataFrame, threshold: float) -> DataFrame:
    """J3 over texts that differ: ``(kind, id, sim_id, score)``."""
    above = SEGMENT_MAX if threshold >= 75 else 0
    ratio = (threshold - 0.005) / 100.0
    rows = reps.select("kind", "id", "value", F.length("value").alias("len")).filter(F.col("len") >= F.floor((above + 1) * F.lit(ratio)))
    found = refined_tiles(rows, threshold, above=above)
    if above:
        found = found.unionByName(score_pairs(segment_pairs(reps, threshold), reps, threshold))
    return found


# --- J7 / J8 / J9: SimHash paths ----------------------------------------------

def signatures(df: DataFrame, bits: int = 64, materialize: bool = True) -> DataFrame:
    """``(kind, id, len, h)`` for every row (empty text -> 0).

    The signature table is small (four columns per text) and feeds both sides
    of the band self-join, so by default it is written once to the reliable
    checkpoint folder instead of being recomputed per side."""
    sig = simhash(spread(df.select("kind", "id", "value"), "kind", "id"), "value", ("kind", "id"), bits)
    return cut_lineage(sig) if materialize else sig


def _signed(x: int) -> int:
    return x - (1 << 64) if x >= 1 << 63 else x


def _met(sig_pairs: DataFrame, x: Column, first: Column, max_hamming: int) -> DataFrame:
    """Pairs found by a block join that are kept: by the first block that finds them,
    so no ``distinct`` shuffle follows, and within ``max_hamming`` bits."""
    return sig_pairs.filter((first == F.col("blk")) & (F.bit_count(x) <= F.lit(max_hamming))).select(
        "kind", F.least("id", "sim_id").alias("id"), F.greatest("id", "sim_id").alias("sim_id"),
        F.col("len").alias("_ll"), F.col("len_r").alias("_rl"), F.bit_count(x).cast("int").alias("hamming"))


def _blocks_join(sig: DataFrame, masks: Sequence[int], max_hamming: int) -> DataFrame:
    """Tiled join on ``(kind, block, block bits)``; a block is a mask of bits."""
    keys = F.array(*[F.struct(F.lit(i).alias("blk"), F.col("h").bitwiseAND(F.lit(_signed(m))).alias("key"))
                     for i, m in enumerate(masks)])
    exploded = sig.select("kind", "id", "len", "h", F.inline(keys))
    x = F.col("h").bitwiseXOR(F.col("h_r"))
    first = F.lit(-1)
    for i in reversed(range(len(masks))):
        first = F.when(x.bitwiseAND(F.lit(_signed(masks[i]))) == 0, F.lit(i)).otherwise(first)
    return _met(tiled_self_join(exploded, ["kind", "blk", "key"], ["len", "h"]), x, first, max_hamming)


def block_plan(ones: Sequence[float], max_hamming: int, sizes: Sequence[int]) -> list[tuple[int, int]]:
    """Blocks ``(mask, radius)`` for an exact Hamming join by the pigeonhole principle: with
    ``sum(radius + 1) = max_hamming + 1`` every pair within ``max_hamming`` bits is within
    ``radius`` on some block.

    ``ones`` is each bit's share of ones, ``sizes`` the rows per kind.  Bits are dealt by
    entropy so that blocks tell rows apart equally well.  Few blocks are selective but
    need every value within the radius looked up; many blocks need few look-ups but
    meet most rows.  The number of blocks with the least rows made and pairs met wins."""
    bits = len(ones)
    same = [p * p + (1 - p) * (1 - p) for p in ones]          # chance that two rows agree on a bit
    order = sorted(range(bits), key=lambda i: same[i])
    best = None
    for m in range(1, min(max_hamming + 1, bits) + 1):
        blocks = [[] for _ in range(m)]
        for n, bit in enumerate(order):                        # dealt to and fro
            blocks[n % m if (n // m) % 2 == 0 else m - 1 - n % m].append(bit)
        radius = [(max_hamming + 1) // m - 1 + (i < (max_hamming + 1) % m) for i in range(m)]
        probes, met = 0, 0.0
        for own, r in zip(blocks, radius):
            probes += sum(math.comb(len(own), j) for j in range(r + 1))
            # chance of at most r differences, bit by bit
            chance = [1.0] + [0.0] * r
            for bit in own:
                chance = [chance[j] * same[bit] + (chance[j - 1] * (1 - same[bit]) if j else 0.0) for j in range(r + 1)]
            met += sum(chance)
        if probes > MAX_PROBES:
            continue
        cost = sum(n * (probes + m) + n * n / 2 * met for n in sizes)
        if best is None or cost < best[0]:
            best = (cost, [(sum(1 << b for b in own), r) for own, r in zip(blocks, radius)])
    return best[1]


def _flips(mask: int, radius: int) -> list[int]:
    """All values that differ from 0 by at most ``radius`` bits of ``mask``."""
    own = [1 << b for b in range(64) if mask >> b & 1]
    return [sum(c) for r in range(radius + 1) for c in combinations(own, r)]


def hamming_pairs(sig: DataFrame, max_hamming: int, bits: int = 64) -> DataFrame:
    """Exact Hamming join by the pigeonhole principle (:func:`block_plan`): one side shows
    its bits of every block, the other looks up all values within the block's radius."""
    shares = [F.avg(F.shiftrightunsigned("h", i).bitwiseAND(F.lit(1))).alias(f"b{i}") for i in range(bits)]
    ones = [p or 0.0 for p in sig.agg(*shares).first()]
    # kinds by size class, so that many kinds are few numbers
    sizes = [(r.n, r.k) for r in sig.groupBy("kind").count().groupBy(F.floor(F.log2("count")).alias("c")).agg(
        F.max("count").alias("n"), F.count(F.lit(1)).alias("k")).collect()]
    plan = block_plan(ones, max_hamming, [n for n, k in sizes for _ in range(min(k, 1000))] or [1])
    if all(r == 0 for _, r in plan):
        return _blocks_join(sig, [m for m, _ in plan], max_hamming)
    shown = F.array(*[F.struct(F.lit(i).alias("blk"), F.col("h").bitwiseAND(F.lit(_signed(m))).alias("key"))
                      for i, (m, _) in enumerate(plan)])
    looked = F.expr("array(" + ", ".join(f"struct({i} AS blk, {_signed(m)}L AS m, {_signed(f)}L AS f)"
                                        for i, (m, r) in enumerate(plan) for f in _flips(m, r)).replace("-9223372036854775808L", "(-9223372036854775807L - 1L)") + ")")
    left = sig.select("kind", "id", "len", "h", F.inline(shown))
    right = sig.select("kind", F.col("id").alias("sim_id"), F.col("len").alias("len_r"), F.col("h").alias("h_r"), F.inline(looked)).select(
        "kind", "sim_id", "len_r", "h_r", "blk", F.col("h_r").bitwiseAND(F.col("m")).bitwiseXOR(F.col("f")).alias("key"))
    x = F.col("h").bitwiseXOR(F.col("h_r"))
    first = F.lit(-1)
    for i, (m, r) in reversed(list(enumerate(plan))):
        first = F.when(F.bit_count(x.bitwiseAND(F.lit(_signed(m)))) <= r, F.lit(i)).otherwise(first)
    # a pair is met from either side; the one with the smaller id shows, the other looks up
    return _met(left.join(right, ["kind", "blk", "key"]).filter(F.col("id") < F.col("sim_id")), x, first, max_hamming)


def band_masks(bits: int, bands: int) -> list[int]:
    """The bits of every LSH band (``bits // bands`` each, remainder ignored)."""
    rows = bits // bands
    return [((1 << rows) - 1) << (b * rows) for b in range(bands)]


def lsh_pairs(sig: DataFrame, max_hamming: int, bits: int = 64, bands: int = 16) -> DataFrame:
    """Pairs sharing at least one LSH band and within ``max_hamming`` bits.

    Bands of a few bits put most pairs of a kind into some common bucket: they are compared
    in tiles.  Buckets of longer bands are joined."""
    masks = band_masks(bits, bands)
    if bits // bands >= SELECTIVE_BITS:
        return _blocks_join(sig, masks, max_hamming)
    return tiled_pairs(sig.select("kind", "id", "len", "h"), SIG_TILE, max_hamming, masks)


def candidate_links(df: DataFrame, threshold: float = 75, bits: int = 64, bands: int = 16) -> DataFrame:
    """J8 as links ``(kind, id, sim_id, hamming, simhash_similarity, link)`` of the
    candidate pairs of classes, and the copies with distance 0."""
    reps, copies = text_classes(df)
    near = lsh_pairs(signatures(reps, bits), S.hamming_threshold(threshold, bits), bits, bands)
    both = near.select("kind", "id", "sim_id", "hamming", F.lit(NEAR).alias("link")).unionByName(
        copies.select("kind", "id", "sim_id", F.lit(0).alias("hamming"), "link"))
    return both.select("kind", "id", "sim_id", "hamming",
                       (F.lit(1.0) - F.col("hamming") / F.lit(float(bits))).alias("simhash_similarity"), "link")


def candidate_pairs(df: DataFrame, threshold: float = 75, bits: int = 64, bands: int = 16) -> DataFrame:
    """J8 as all pairs of rows ``(kind, id, sim_id, hamming, simhash_similarity)``."""
    reps, members = row_classes(df)
    near = lsh_pairs(signatures(reps, bits), S.hamming_threshold(threshold, bits), bits, bands)
    found = row_pairs(near.select("kind", "id", "sim_id", "hamming"), members, {"hamming": F.lit(0)}, once=False)
    return found.select("*", (F.lit(1.0) - F.col("hamming") / F.lit(float(bits))).alias("simhash_similarity"))


def refined_tiles(rows: DataFrame, threshold: float, max_hamming: int | None = None,
                  masks: list[int] | None = None, above: int = 0) -> DataFrame:
    """Scored pairs ``(kind, id, sim_id, score)`` of ``rows(kind, id, len, value[, h])`` that
    pass the gates of :func:`kindred.operators.tiles.comparer` and score >= T (J12)."""
    pairs = tiled_pairs(rows, TEXT_TILE, max_hamming, masks, (threshold - 0.005) / 100.0, threshold, above)
    m = F.greatest("_ll", "_rl")
    scored = pairs.select("kind", "id", "sim_id", S.score_pct((m - F.col("_d")).cast("double") / m).alias("score"))
    return scored.filter(F.col("score") >= F.lit(float(threshold)))


def _signed_texts(reps: DataFrame, bits: int) -> DataFrame:
    """``(kind, id, value, len, h)`` of the texts that can pair: an empty one is alone."""
    texts = reps.select("kind", "id", "value").filter(F.length("value") > 0)
    # texts in as many parts as there are cores stay where they are
    if texts.rdd.getNumPartitions() < texts.sparkSession.sparkContext.defaultParallelism:
        texts = spread(texts, "kind", "id")
    return simhash(texts, "value", ("kind", "id", "value"), bits)


def near_duplicates_simhash(df: DataFrame, threshold: float = 75, bits: int = 64) -> DataFrame:
    """Hamming distance <= ``int((1-T/100)*bits)``, then exact score >= T."""
    reps, copies = text_classes(df)
    return links(simhash_scored(reps, threshold, bits), copies)


def simhash_scored(reps: DataFrame, threshold: float, bits: int = 64) -> DataFrame:
    """J7 over texts that differ: ``(kind, id, sim_id, score)``."""
    return refined_tiles(_signed_texts(reps, bits), threshold, S.hamming_threshold(threshold, bits))


def near_duplicates_lsh(df: DataFrame, threshold: float = 75, bits: int = 64, bands: int = 16) -> DataFrame:
    """J9 (flagship): SimHash -> LSH bands -> Hamming gate -> exact score >= T."""
    reps, copies = text_classes(df)
    return links(lsh_scored(reps, threshold, bits, bands), copies)


def lsh_scored(reps: DataFrame, threshold: float, bits: int = 64, bands: int = 16) -> DataFrame:
    """J9 over texts that differ: ``(kind, id, sim_id, score)``."""
    most = S.hamming_threshold(threshold, bits)
    if bits // bands < SELECTIVE_BITS:
        return refined_tiles(_signed_texts(reps, bits), threshold, most, band_masks(bits, bands))
    cands = lsh_pairs(signatures(reps, bits), most, bits, bands)
    cands = cands.filter(S.length_ratio_ok(F.col("_ll"), F.col("_rl"), threshold))
    return score_pairs(cands, reps, threshold)


def near_duplicates(df: DataFrame, threshold: float = 50, method: str = "lsh", bits: int = 64,
                    bands: int = 16, small_kind: int = 10) -> DataFrame:
    """Method dispatch: ``exact`` (J3), ``simhash`` (J7) or ``lsh``.

    ``auto`` is the reference's own rule and must be asked for: SimHash for kinds
    of at most ``small_kind`` rows, LSH for larger ones, in one job; which pairs
    it finds depends on the size of a kind."""
    if method == "exact":
        return near_duplicates_exact(df, threshold)
    if method == "simhash":
        return near_duplicates_simhash(df, threshold, bits)
    if method == "lsh":
        return near_duplicates_lsh(df, threshold, bits, bands)
    if method != "auto":
        raise ValueError(f"unknown method {method!r}")
    sizes = df.groupBy("kind").agg(F.count(F.lit(1)).alias("_n"))
    tagged = df.join(sizes, "kind")
    small = tagged.filter(F.col("_n") <= small_kind).drop("_n")
    large = tagged.filter(F.col("_n") > small_kind).drop("_n")
    return near_duplicates_simhash(small, threshold, bits).unionByName(
        near_duplicates_lsh(large, threshold, bits, bands))


def duplicate_pairs(df: DataFrame, threshold: float, method: str, bits: int = 64, bands: int = 16,
                    small_kind: int = 10) -> DataFrame:
    """The same as all pairs of rows ``(kind, id, sim_id, score)``, copies with score 100."""
    reps, members = row_classes(df)
    if method == "auto":
        sizes = df.groupBy("kind").agg(F.count(F.lit(1)).alias("_n"))
        tagged = reps.join(sizes, "kind")
        near = simhash_scored(tagged.filter(F.col("_n") <= small_kind).drop("_n"), threshold, bits).unionByName(
            lsh_scored(tagged.filter(F.col("_n") > small_kind).drop("_n"), threshold, bits, bands))
    else:
        near = {"exact": lambda: exact_scored(reps, threshold), "simhash": lambda: simhash_scored(reps, threshold, bits),
                "lsh": lambda: lsh_scored(reps, threshold, bits, bands)}[method]()
    return row_pairs(near, members, {"score": F.lit(100.0)})
