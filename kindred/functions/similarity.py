"""Column-level similarity functions.

Scores follow the reference: ``(max_len - d) / max_len`` (1.0 when both texts
are empty), shown in percent rounded half-even to two decimals (``bround``).
"""

from __future__ import annotations

import math

from pyspark.sql import Column
from pyspark.sql import functions as F


def _c(c) -> Column:
    return F.col(c) if isinstance(c, str) else c


def levenshtein(a, b, max_distance: Column | None = None) -> Column:
    """unit-cost edit distance over code points; with ``max_distance`` the
    banded form returns -1 as soon as the distance exceeds the bound."""
    if max_distance is None:
        return F.levenshtein(_c(a), _c(b))
    # SQL form: the bound may be a per-row expression
    return F.call_function("levenshtein", _c(a), _c(b), max_distance)


def max_len(a, b) -> Column:
    return F.greatest(F.length(_c(a)), F.length(_c(b)))


def similarity(a, b, distance: Column | None = None) -> Column:
    """F2: ``(m - d) / m`` in [0, 1]; 1.0 for two empty strings."""
    m = max_len(a, b)
    d = levenshtein(a, b) if distance is None else distance
    return F.when(m == 0, F.lit(1.0)).otherwise((m - d).cast("double") / m)


def score_pct(sim: Column) -> Column:
    """percent with two decimals, half-even like Python's ``round``."""
    return F.bround(sim * 100.0, 2)


def distance_bound(m: Column, threshold: float) -> Column:
    """Largest distance that can still round to a score >= ``threshold``.

    ``bround((m-d)/m*100, 2) >= T`` needs ``d <= m*(100-T+0.005)/100``; one more
    unit of slack keeps the banded distance exact up to the residual filter."""
    return (F.floor(m * F.lit((100.0 - threshold + 0.005) / 100.0)) + 1).cast("int")


def length_ratio_ok(len_a: Column, len_b: Column, threshold: float) -> Column:
    """Lossless length prefilter: ``d >= |la-lb|`` so the score is at most min/max."""
    lo, hi = F.least(len_a, len_b), F.greatest(len_a, len_b)
    return (hi == 0) | (lo.cast("double") >= hi * F.lit((threshold - 0.005) / 100.0))


def thresholded_score(a, b, threshold: float, len_a: Column | None = None,
                      len_b: Column | None = None) -> Column:
    """Score of a pair when it can reach ``threshold``, else null.

    The length bound is evaluated before the distance inside one ``when`` chain
    (conjunct order in a join residual is not guaranteed), and equal strings
    skip the dynamic programme."""
    la = F.length(_c(a)) if len_a is None else len_a
    lb = F.length(_c(b)) if len_b is None else len_b
    m = F.greatest(la, lb)
    d = levenshtein(a, b, distance_bound(m, threshold))
    sim = F.when(m == 0, F.lit(1.0)).otherwise((m - d).cast("double") / m)
    return (F.when(~length_ratio_ok(la, lb, threshold), F.lit(None).cast("double"))
            .when(_c(a) == _c(b), F.lit(100.0))
            .when(d < 0, F.lit(None).cast("double"))
            .otherwise(score_pct(sim)))


def pair_detail(a, b) -> Column:
    """similarity, percentage text, distance, both strings and lengths."""
    d = levenshtein(a, b)
    sim = similarity(a, b, d)
    return F.struct(sim.alias("similarity"),
                    F.concat(score_pct(sim).cast("string"), F.lit("%")).alias("percentage"),
                    d.alias("distance"),
                    F.struct(_c(a).alias("string1"), _c(b).alias("string2"),
                             F.length(_c(a)).alias("length1"),
                             F.length(_c(b)).alias("length2")).alias("details"))


def hamming(h1, h2) -> Column:
    """number of differing bits of two 64-bit signatures."""
    return F.bit_count(_c(h1).bitwiseXOR(_c(h2))).cast("int")


def simhash_similarity(h1, h2, bits: int = 64) -> Column:
    """``1 - hamming / bits``."""
    return F.lit(1.0) - hamming(h1, h2) / F.lit(float(bits))


def hamming_threshold(threshold: float, bits: int = 64) -> int:
    """``int((1 - T/100) * bits)`` as in the reference."""
    return int((1 - threshold / 100) * bits)


def band_keys(h, bits: int = 64, bands: int = 16) -> Column:
    """F8: array of ``struct(band, key)``; ``bits // bands`` bits per band,
    remainder bits ignored.  Unsigned shift so negative signatures band right."""
    rows = bits // bands
    mask = _mask(rows)
    return F.transform(F.sequence(F.lit(0), F.lit(bands - 1)), lambda i: F.struct(
        i.alias("band"), _shr(_c(h), i * rows).bitwiseAND(mask).alias("key")))


def _mask(rows: int) -> Column:
    return F.lit((1 << rows) - 1 if rows < 64 else -1).cast("long")


def _shr(h: Column, n: Column) -> Column:
    # the SQL function accepts an expression as shift count (needed in lambdas)
    return F.call_function("shiftrightunsigned", h, n)


def log_bucket(length: Column, ratio: float) -> Column:
    """J4 helper: ``floor(ln(len) / ln(1/ratio))``; a pair with
    ``min/max >= ratio`` lies in the same or adjacent buckets."""
    if ratio >= 1.0:
        return length.cast("long")
    return F.floor(F.log(F.greatest(length, F.lit(1)).cast("double")) / F.lit(math.log(1.0 / ratio)))
