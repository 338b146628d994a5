"""Near-duplicate joins against brute force on the small fixture (whole texts)."""

import random

import pytest
from pyspark.sql import functions as F

from kindred.functions.similarity import hamming_threshold
from kindred.operators import report as R
from kindred.operators import simjoin as J
from kindred.plans.fixtures import fx_docs, fx_short
from tests.test_similarity import dp


def _rows(df):
    return [(r.kind, r.id, r.value) for r in df.select("kind", "id", "value").collect()]


def expand(found):
    """All pairs of rows that links stand for, by the class each row is in."""
    found = [r.asDict() for r in found]
    members = {}
    for r in found:
        if r["link"] == "copy":
            members.setdefault((r["kind"], r["id"]), [r["id"]]).append(r["sim_id"])
    of = lambda k, i: members.get((k, i), [i])
    out = {(k, min(x, y), max(x, y)): 100.0 for (k, _), own in members.items() for x in own for y in own if x < y}
    for r in found:
        if r["link"] == "near":
            for x in of(r["kind"], r["id"]):
                for y in of(r["kind"], r["sim_id"]):
                    out[r["kind"], min(x, y), max(x, y)] = r["score"]
    return out


def _brute(rows, t):
    out = {}
    by = {}
    for k, i, v in rows:
        by.setdefault(k, []).append((i, v))
    for k, items in by.items():
        for x in range(len(items)):
            for y in range(x + 1, len(items)):
                (i, a), (j, b) = items[x], items[y]
                m = max(len(a), len(b))
                s = round((m - dp(a, b)) / m * 100, 2) if m else 100.0
                if s >= t:
                    out[(k, min(i, j), max(i, j))] = s
    return out


@pytest.fixture(scope="module")
def short_rows(spark, sf):
    return fx_short(spark, sf)


def test_exact_join_equals_brute_force(spark, short_rows):
    assert expand(J.near_duplicates_exact(short_rows, 75).collect()) == _brute(_rows(short_rows), 75)


def test_builtin_and_bitparallel_engines_agree(spark, short_rows):
    t, _ = J.text_classes(short_rows)
    lens = t.select("kind", "id", F.length("value").alias("len"))
    cands = J._ordered(J._length_band_join(lens, 0.5))
    a = {tuple(r) for r in J.score_pairs(cands, t, 60, engine="bitparallel").collect()}
    b = {tuple(r) for r in J.score_pairs(cands, t, 60, engine="builtin").collect()}
    assert a == b and a


def test_lsh_subset_of_hamming_subset_of_exact(spark, short_rows):
    lsh = {(r.kind, r.id, r.sim_id) for r in J.near_duplicates_lsh(short_rows, 75).collect()}
    ham = {(r.kind, r.id, r.sim_id) for r in J.near_duplicates_simhash(short_rows, 75).collect()}
    exact = {(r.kind, r.id, r.sim_id) for r in J.near_duplicates_exact(short_rows, 75).collect()}
    assert lsh <= ham <= exact


def _within(rows, t):
    return {(k1, i, j) for k1, i, h1 in rows for k2, j, h2 in rows
            if k1 == k2 and i < j and bin((h1 ^ h2) & ((1 << 64) - 1)).count("1") <= t}


def test_pigeonhole_hamming_join_is_complete(spark, short_rows):
    sig = J.signatures(short_rows, materialize=False)
    t = hamming_threshold(75)
    got = [(r.kind, r.id, r.sim_id) for r in J.hamming_pairs(sig, t).collect()]
    assert len(got) == len(set(got)) and set(got) == _within([(r.kind, r.id, r.h) for r in sig.collect()], t)


@pytest.mark.parametrize("t", [3, 8, 16])
def test_few_blocks_with_radius_find_every_pair_once(spark, monkeypatch, t):
    rng = random.Random(t)
    base = [rng.getrandbits(64) | 0xFF00 for _ in range(40)]       # eight bits are constant
    hs = base + [h ^ sum(1 << b for b in rng.sample(range(64), rng.randrange(0, 24))) for h in base * 3]
    rows = [("k" if i % 5 else "m", i, 10, J._signed(h)) for i, h in enumerate(hs)]
    sig = spark.createDataFrame(rows, "kind string, id long, len int, h long")
    want = _within([(k, i, h) for k, i, _, h in rows], t)
    for size in (10, 1_000_000):     # a large kind is worth few selective blocks
        plan = J.block_plan([0.5] * 56 + [1.0] * 8, t, [size])
        assert sum(r + 1 for _, r in plan) == t + 1 and sum(m for m, _ in plan) == (1 << 64) - 1
        assert (len(plan) < t + 1) == (size > 10)
        monkeypatch.setattr(J, "block_plan", lambda *_, plan=plan: plan)
        got = [(r.kind, r.id, r.sim_id) for r in J.hamming_pairs(sig, t).collect()]
        monkeypatch.undo()
        assert len(got) == len(set(got)) and set(got) == want


def test_length_ratio_pairs_equal_brute_force(spark, sf):
    docs = fx_docs(spark, sf)
    got = {(r.kind, r.id, r.sim_id) for r in J.length_ratio_pairs(docs, 52.5).collect()}
    rows = [(k, i, len(v)) for k, i, v in _rows(docs)]
    want = {(k, min(i, j), max(i, j)) for k, i, a in rows for k2, j, b in rows
            if k == k2 and i != j and a > 0 and b > 0 and min(a, b) / max(a, b) >= 0.525}
    assert got == want


def test_no_cross_join_in_plans(spark, short_rows):
    for df in (J.near_duplicates_exact(short_rows, 75), J.near_duplicates_lsh(short_rows, 75),
               J.near_duplicates_simhash(short_rows, 75)):
        plan = df._jdf.queryExecution().executedPlan().toString()
        assert "CartesianProduct" not in plan and "BroadcastNestedLoopJoin" not in plan


def test_mirror_gives_both_directions(spark, short_rows):
    p = J.near_duplicates_exact(short_rows, 90)
    m = J.mirror(p)
    assert m.count() == 2 * p.count()


def test_documents_hold_no_other_letters_than_the_oracle_maps(spark, sf):
    from kindred.plans.oracle import NON_ASCII, STAND_IN
    chars = fx_docs(spark, sf).select(F.explode(F.split("value", "")).alias("c")).distinct()
    assert {r.c for r in chars.collect() if r.c and ord(r.c) > 127} <= set(NON_ASCII)
    assert len(NON_ASCII) == len(STAND_IN) == 11
    assert not {r.c for r in chars.collect()} & set(STAND_IN)


def test_copies_are_links_to_their_representative(spark):
    rows = spark.createDataFrame([("k", 1, "hello"), ("k", 2, "hello"), ("k", 3, "helo"), ("m", 4, "hello"),
                                  ("k", 7, ""), ("k", 8, None), ("k", 9, "")], "kind string, id long, value string")
    for found in (J.near_duplicates_exact(rows, 75), J.near_duplicates(rows, 75, "simhash"), J.near_duplicates(rows, 50, "auto")):
        got = {(r.id, r.sim_id, r.link) for r in found.collect()}
        assert {(1, 2, "copy"), (7, 8, "copy"), (7, 9, "copy")} <= got <= {
            (1, 2, "copy"), (7, 8, "copy"), (7, 9, "copy"), (1, 3, "near")}
    assert expand(J.near_duplicates_exact(rows, 75).collect()) == {
        ("k", 1, 2): 100.0, ("k", 1, 3): 80.0, ("k", 2, 3): 80.0, ("k", 7, 8): 100.0, ("k", 7, 9): 100.0, ("k", 8, 9): 100.0}


def test_ten_thousand_copies_make_as_many_rows(spark):
    rows = spark.range(10_000).select(F.lit("k").alias("kind"), "id", F.lit("the same question").alias("value")).unionByName(
        spark.createDataFrame([("k", 20_000, "the same questions")], "kind string, id long, value string"))
    found = J.near_duplicates_lsh(rows, 75)
    assert found.count() <= 10_000
    sizes = J.weighted_links(J.near_duplicates_exact(rows, 75)).agg(F.sum("pairs")).first()[0]
    assert sizes == 10_001 * 10_000 // 2
    summary = {r.id: tuple(r)[2:] for r in R.match_summary(J.near_duplicates_exact(rows, 75)).filter("id IN (0, 5, 20000)").collect()}
    assert summary == {0: (10_000, 100.0, 1), 5: (10_000, 100.0, 0), 20_000: (10_000, 94.44, 0)}


def test_summary_equals_pairs(spark, short_rows):
    found = J.near_duplicates_exact(short_rows, 75).collect()
    want = {}
    for (k, i, j), s in expand(found).items():
        for x, y in ((i, j), (j, i)):
            want.setdefault((k, x), []).append((-s, y))
    got = {(r.kind, r.id): (r.n_matches, r.best_score, r.best_sim_id) for r in R.match_summary(spark.createDataFrame(found)).collect()}
    assert got == {k: (len(v), -min(v)[0], min(v)[1]) for k, v in want.items()}


@pytest.mark.parametrize("tile", [1, 3, 1000])
def test_tiles_hold_every_pair_once_and_stay_bounded(spark, tile):
    # one bucket of half the rows, buckets of one to nine rows beside it
    rows = spark.range(120).select("id", F.when(F.col("id") < 60, 0).otherwise(F.col("id") % 7 + 1).alias("b"))
    got = J.tiled_self_join(rows, ["b"], [], tile).select("b", F.least("id", "sim_id").alias("x"), F.greatest("id", "sim_id").alias("y")).collect()
    by = {}
    for r in rows.collect():
        by.setdefault(r.b, []).append(r.id)
    want = sorted((b, x, y) for b, ids in by.items() for x in ids for y in ids if x < y)
    assert sorted(map(tuple, got)) == want


def test_no_tile_of_a_hot_bucket_is_far_above_the_rest(spark):
    rows = spark.range(20_000).select("id", F.when(F.col("id") % 2 == 0, 0).otherwise(F.col("id")).alias("b"))
    g = 10_000 // J.TILE
    slices = rows.filter("b = 0").groupBy(F.pmod(F.xxhash64("id"), F.lit(g))).count().toPandas()["count"]
    assert len(slices) == g and slices.max() < 2 * slices.median()


def test_segments_lose_no_pair(spark):
    rng = random.Random(2)
    words = ["".join(rng.choice("abcd") for _ in range(rng.randrange(1, 40))) for _ in range(60)]
    for w in list(words):
        v = list(w)
        for _ in range(rng.randrange(1, 6)):
            at = rng.randrange(len(v) + 1)
            rng.choice([lambda: v.insert(at, rng.choice("abcd")), lambda: v.pop(at) if at < len(v) else None])()
        words.append("".join(v))
    words = sorted(set(words) - {""})
    rows = spark.createDataFrame([("k", i, w) for i, w in enumerate(words)], "kind string, id long, value string")
    for t in (75, 90):
        cands = {(r.id, r.sim_id) for r in J.segment_pairs(rows, t).collect()}
        want = {(i, j) for _, i, j in _brute([("k", i, w) for i, w in enumerate(words)], t)}
        assert want <= cands and len(cands) < len(words) * (len(words) - 1) // 4


def test_length_classes_equal_pairs(spark, sf):
    docs = fx_docs(spark, sf)
    lens = {(r.kind, r.id): len(r.value or "") for r in docs.collect()}
    for classes, pairs in ((J.length_ratio_classes(docs, 52.5), J.length_ratio_pairs(docs, 52.5)),
                           (J.length_window_classes(docs), J.length_window_pairs(docs))):
        want = {}
        for r in pairs.collect():
            for i in (r.id, r.sim_id) if "n_links" in classes.columns else (r.id,):
                want[r.kind, lens[r.kind, i]] = want.get((r.kind, lens[r.kind, i]), 0) + 1
        got = {(r.kind, r.len): r.n * r.n_links if "n_links" in classes.columns else r.pairs for r in classes.collect()}
        assert {k: v for k, v in got.items() if v} == want


def test_prefix_classes(spark):
    rows = spark.createDataFrame([("k", 1, "abcdef"), ("k", 2, "abcxyz"), ("k", 3, "abXdef"), ("k", 4, ""), ("m", 5, "a"), ("m", 6, "zz"), ("m", 7, "y")],
                                 "kind string, id long, value string")
    got = {r.id: (r.class_id, r.n_links) for r in J.prefix_classes(rows, 50).collect()}
    # kind m: the shortest text has one character, the prefix none, so all are one class
    assert got == {1: (1, 1), 2: (1, 1), 3: (3, 0), 5: (5, 2), 6: (5, 2), 7: (5, 2)}


def test_length_classes_name_every_row(spark):
    """J4 and J6 gave one row per length and did not say which rows it stands for."""
    rows = [("k", 5, "abcd"), ("k", 2, "wxyz"), ("k", 9, "abcde"), ("k", 7, ""), ("k", 8, None), ("m", 1, "abcd")]
    df = spark.createDataFrame(rows, "kind string, id long, value string")
    got = {(r.kind, r.id): (r.class_id, r.n, r.n_links) for r in
           J.with_length_class(df.filter(F.length("value") > 0), J.length_ratio_classes(df, 52.5)).collect()}
    assert got == {("k", 5): (2, 2, 2), ("k", 2): (2, 2, 2), ("k", 9): (9, 1, 2), ("m", 1): (1, 1, 0)}
    got = {(r.kind, r.id): (r.class_id, r.n, r.n_longer, r.pairs) for r in
           J.with_length_class(df, J.length_window_classes(df, 0.7)).collect()}
    assert got == {("k", 5): (2, 2, 1, 3), ("k", 2): (2, 2, 1, 3), ("k", 9): (9, 1, 0, 0),
                   ("k", 7): (7, 2, 0, 1), ("k", 8): (7, 2, 0, 1), ("m", 1): (1, 1, 0, 0)}
