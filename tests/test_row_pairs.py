"""Pairs of rows: classes of equal texts are compared once and expanded to every row."""

import duckdb
import pytest
from pyspark.sql import functions as F

import __spark_entry__ as entry
from kindred.functions.editdistance import edit_distance
from kindred.operators import simjoin as J
from kindred.plans.registry import BANDS, BITS

WORDS = "the quick brown fox jumps over a lazy dog and runs far away from here"
RESTORED = ["J9", "J7", "J3", "J10", "J8", "J5", "J9S", "J3S", "R1", "O5", "F4"]


def _rows():
    """Copies in a group larger than a tile, a near copy of them, empty and null texts,
    an id that occurs twice with one text and twice with different texts."""
    rows = [("k", i, WORDS) for i in range(1, 8)] + [("k", 20, WORDS + "x"), ("k", 21, WORDS + "x"), ("k", 3, WORDS)]
    rows += [("k", 30, ""), ("k", 31, None), ("k", 32, ""), ("m", 1, WORDS), ("m", 2, WORDS), ("k", 5, "another text of its own"),
                                                                                     ("k", 50, "one text of an id"), ("k", 50, "one text of an ID"),
                                                                                     ("k", 60, "one text of an iD"), ("k", -7, "another text of its owns")]
    return rows + [(None, 40, WORDS), ("k", None, WORDS)]


def _want(score):
    out = []
    for k, i, a in _rows():
        for k2, j, b in _rows():
            if None not in (k, k2, i, j) and k == k2 and i < j and (s := score(a or "", b or "")) is not None:
                out.append((k, i, j, s))
    return sorted(out)


def _near(a, b, least):
    m = max(len(a), len(b))
    s = round((m - edit_distance(a, b)) / m * 100, 2) if m else 100.0
    return s if s >= least else None


@pytest.fixture(scope="module")
def rows(spark):
    return spark.createDataFrame(_rows(), "kind string, id long, value string")


@pytest.mark.parametrize("method", ["exact", "simhash", "lsh", "auto"])
@pytest.mark.parametrize("tile", [2, 1000])
def test_every_pair_of_rows_is_given(rows, monkeypatch, method, tile):
    monkeypatch.setattr(J, "TILE", tile)
    got = sorted(map(tuple, J.duplicate_pairs(rows, 75, method, BITS, BANDS).collect()))
    assert got == _want(lambda a, b: _near(a, b, 75))


@pytest.mark.parametrize("tile", [2, 1000])
def test_candidates_prefixes_and_details_are_pairs_of_rows(rows, monkeypatch, tile):
    monkeypatch.setattr(J, "TILE", tile)
    got = {(r.kind, r.id, r.sim_id): r.hamming for r in J.candidate_pairs(rows, 75, BITS, BANDS).collect()}
    copies = {t[:3] for t in _want(lambda a, b: 0 if a == b else None)}
    assert copies <= set(got) and all(got[c] == 0 for c in copies if 3 not in c and 5 not in c)
    got = sorted(map(tuple, J.prefix_pairs(rows, 50).collect()))
    k = {kind: min(len(v) for x, _, v in _rows() if x == kind and v) // 2 for kind in ("k", "m")}
    assert got == sorted((x, i, j) for x, i, a in _rows() for y, j, b in _rows() if x == y and x and i and j and i < j and a and b
                         and a[:k[x]] == b[:k[x]])
    got = sorted((r.kind, r.id, r.sim_id, r.distance) for r in J.detailed_pairs(rows, 90).collect())
    assert got == _want(lambda a, b: edit_distance(a, b) if a and b and min(len(a), len(b)) / max(len(a), len(b)) >= 0.9 else None)


def test_a_large_class_is_expanded(spark):
    """300 copies beside a near text: every pair of rows."""
    rows = spark.range(300).select(F.lit("k").alias("kind"), "id", F.lit(WORDS).alias("value")).unionByName(
        spark.createDataFrame([("k", 900, WORDS + "x")], "kind string, id long, value string"))
    assert J.duplicate_pairs(rows, 75, "exact").count() == 301 * 300 // 2


@pytest.mark.parametrize("name", RESTORED)
def test_queries_give_pairs_of_rows_like_their_sql(spark, sf, name):
    con = duckdb.connect()
    for t in ("documents", "part"):
        con.execute(f"CREATE VIEW {t} AS SELECT * FROM read_parquet('{sf}/{t}.parquet')")
    found = entry.queries()[name](spark, sf)
    want = con.execute(entry.oracle_sql()[name])
    cols = sorted(c[0] for c in want.description)
    assert sorted(found.columns) == cols
    assert not {"link", "class_id"} & set(cols)
    key = lambda r: tuple(round(x, 6) if isinstance(x, float) else x for x in r)
    assert sorted(map(key, found.select(*cols).collect()), key=repr) == sorted(
        map(key, con.execute(f"SELECT {', '.join(cols)} FROM ({entry.oracle_sql()[name]})").fetchall()), key=repr)
