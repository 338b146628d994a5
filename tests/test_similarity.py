import random

import pytest
from pyspark.sql import functions as F

from kindred.functions import similarity as S
from kindred.functions.editdistance import Grams, banded_distance, edit_distance, fast_levenshtein


def dp(a, b):
    prev = list(range(len(b) + 1))
    for i, ca in enumerate(a, 1):
        cur = [i] + [0] * len(b)
        for j, cb in enumerate(b, 1):
            cur[j] = min(prev[j] + 1, cur[j - 1] + 1, prev[j - 1] + (ca != cb))
        prev = cur
    return prev[-1]


def test_bitparallel_matches_dp():
    rnd = random.Random(7)
    for _ in range(2000):
        a = "".join(rnd.choice("ab你c") for _ in range(rnd.randint(0, 40)))
        b = "".join(rnd.choice("ab你c") for _ in range(rnd.randint(0, 40)))
        d = dp(a, b)
        assert edit_distance(a, b) == d
        k = rnd.randint(0, 25)
        assert edit_distance(a, b, k) == (d if d <= k else -1)


def test_long_strings_cross_word_boundary():
    rnd = random.Random(3)
    a = "".join(rnd.choice("xyz") for _ in range(150))
    b = "".join(rnd.choice("xyz") for _ in range(170))
    assert edit_distance(a, b) == dp(a, b)


def test_udf_equals_builtin(spark):
    rnd = random.Random(11)
    rows = [("".join(rnd.choice("abcd") for _ in range(rnd.randint(0, 60))),
             "".join(rnd.choice("abcd") for _ in range(rnd.randint(0, 60)))) for _ in range(300)]
    df = spark.createDataFrame(rows, "a string, b string")
    out = df.select(fast_levenshtein(F.col("a"), F.col("b")).alias("u"), F.levenshtein("a", "b").alias("s")).collect()
    assert all(r.u == r.s for r in out)


@pytest.mark.parametrize("m,d,expected", [(32, 3, 90.62), (32, 7, 78.12), (32, 11, 65.62), (4, 1, 75.0), (5, 1, 80.0)])
def test_score_half_even(spark, m, d, expected):
    r = spark.range(1).select(S.score_pct(F.lit((m - d) / m)).alias("s")).first()
    assert r.s == expected


def test_similarity_edge_cases(spark):
    df = spark.createDataFrame([("", ""), ("", "abc"), ("abc", "abcd"), ("hello", "helo")], "a string, b string")
    got = [r.s for r in df.select(S.score_pct(S.similarity("a", "b")).alias("s")).collect()]
    assert got == [100.0, 0.0, 75.0, 80.0]


def test_thresholded_score_is_exact_at_boundary(spark):
    # 3 edits on 12 characters = 75.0 exactly: scored at T=75; at T=90 the
    # banded distance stops at its bound (2) and gives no score
    df = spark.createDataFrame([("abcdefghijkl", "abcdefghixyz")], "a string, b string")
    assert df.select(S.thresholded_score("a", "b", 75).alias("s")).first().s == 75.0
    assert df.select(S.thresholded_score("a", "b", 90).alias("s")).first().s is None


def test_hamming_and_bands(spark):
    df = spark.createDataFrame([(0b1011, 0b0001)], "a long, b long")
    r = df.select(S.hamming("a", "b").alias("h"), S.simhash_similarity("a", "b").alias("s")).first()
    assert r.h == 2 and r.s == 1 - 2 / 64
    keys = df.select(S.band_keys(F.lit(-1).cast("long"), 64, 16).alias("k")).first().k
    assert len(keys) == 16 and all(k.key == 15 for k in keys)


def test_banded_distance_matches_dp():
    rnd = random.Random(2)
    for _ in range(3000):
        size = rnd.choice([5, 20, 60, 150])
        a = "".join(rnd.choice("abc") for _ in range(rnd.randint(0, size)))
        if rnd.random() < 0.5:
            b = list(a)
            for _ in range(rnd.randint(0, 12)):
                if b and rnd.random() < 0.5:
                    b.pop(rnd.randrange(len(b)))
                else:
                    b.insert(rnd.randint(0, len(b)), rnd.choice("abcd"))
            b = "".join(b)
        else:
            b = "".join(rnd.choice("abc") for _ in range(rnd.randint(0, size)))
        if len(a) < len(b):
            a, b = b, a
        d = dp(a, b)
        k = rnd.randint(0, max(1, size))
        if not b or k >= len(b):
            continue
        assert banded_distance(a, b, k) == (d if d <= k else -1)
        rest = Grams().rest_cost(a, b)
        assert rest[0] <= d and banded_distance(a, b, k, rest) == (d if d <= k else -1)
