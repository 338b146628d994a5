import random

import pytest
from pyspark.sql import functions as F

from kindred.functions.editdistance import edit_distance
from kindred.operators import simjoin as J
from kindred.operators import tiles as T


def _texts(seed, n=90):
    rng = random.Random(seed)
    base = ["".join(rng.choice("abcd") for _ in range(rng.randrange(1, 160))) for _ in range(n // 3)]
    out = []
    for t in base * 3:
        cs = list(t)
        for _ in range(rng.randrange(0, max(len(cs) // 3, 1))):
            cs[rng.randrange(len(cs))] = rng.choice("abcd")
        out.append("".join(cs))
    return out


def test_tiles_give_every_pair_of_a_kind_once(spark):
    hs = [random.Random(i).getrandbits(64) for i in range(150)]
    rows = [("k" if i % 5 else "m", i, 10 + i, J._signed(h)) for i, h in enumerate(hs)] + [(None, 900, 3, 0), ("k", None, 3, 0)]
    sig = spark.createDataFrame(rows, "kind string, id long, len int, h long")
    masks = J.band_masks(64, 16)
    want = {(a[0], a[1], b[1], bin(hs[a[1]] ^ hs[b[1]]).count("1")) for a in rows[:150] for b in rows[:150] if a[0] == b[0] and a[1] < b[1]
            and bin(hs[a[1]] ^ hs[b[1]]).count("1") <= 30 and any((hs[a[1]] ^ hs[b[1]]) & m == 0 for m in masks)}
    for tile in (7, 40, 1000):
        got = [(r.kind, r.id, r.sim_id, r.hamming) for r in T.tiled_pairs(sig, tile, 30, masks).collect()]
        assert len(got) == len(set(got)) and set(got) == want


@pytest.mark.parametrize("threshold", [50.0, 75.0])
def test_texts_refined_in_tiles_equal_brute_force(spark, monkeypatch, threshold):
    texts = _texts(int(threshold))
    df = spark.createDataFrame([("k" if i % 4 else "m", i, t) for i, t in enumerate(texts)], "kind string, id long, value string")
    first = {}
    for i, t in enumerate(texts):
        first.setdefault(("k" if i % 4 else "m", t), i)
    want = set()
    for (k, a), i in first.items():
        for (k2, b), j in first.items():
            if k == k2 and i < j:
                m = max(len(a), len(b))
                if round((m - edit_distance(a, b)) / m * 100, 2) >= threshold:
                    want.add((k, i, j))
    monkeypatch.setattr(J, "TEXT_TILE", 6)
    got = [(r.kind, r.id, r.sim_id) for r in J.near_duplicates_exact(df, threshold).filter("link = 'near'").collect()]
    assert len(got) == len(set(got)) and set(got) == want


def test_texts_travel_by_tile_not_by_pair(spark):
    """All 400 texts are candidates of each other: 79,800 pairs, but 400 rows in one tile."""
    rows = spark.range(400).select(F.lit("k").alias("kind"), "id", F.lit(100).alias("len"))
    assert T.dealt(rows, F.lit(0), 1000).count() == 400
    assert T.dealt(rows, F.lit(0), 100).count() <= 400 * 7
    for q in (J.near_duplicates_simhash, J.near_duplicates_lsh):
        plan = q(rows.withColumn("value", F.repeat(F.col("id").cast("string"), 60)))._jdf.queryExecution().toString()
        assert "MapInArrow" in plan and "levenshtein" not in plan
