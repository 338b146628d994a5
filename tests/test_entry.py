"""Driver contract and a DuckDB cross-check of cheap queries on sf0.001."""

import duckdb
import pandas as pd
import pytest

import __spark_entry__ as entry

TABLES = ("region nation customer supplier part orders lineitem events documents embeddings "
          "pages benchmark labels conversations").split()
CHEAP = ["P1", "P3", "P7", "P11", "T8", "T14", "A3", "W1", "A6", "G1", "G2", "G3", "A4", "E3", "E4", "E6", "W2",
         "E9", "E12", "W3", "J3S", "A1", "O1", "R1"]


def test_entry_runs(spark):
    df = entry.entry(spark)
    assert df.columns == ["kind", "id", "check_admin", "n_matches", "best_sim_id", "best_score"]
    assert df.count() >= 0


def test_every_oracle_has_a_query():
    assert set(entry.oracle_sql()) <= set(entry.queries())


@pytest.fixture(scope="module")
def con(sf):
    c = duckdb.connect()
    for t in TABLES:
        c.execute(f"CREATE VIEW {t} AS SELECT * FROM read_parquet('{sf}/{t}.parquet')")
    return c


def _norm(v):
    if v is None or v is pd.NA or (isinstance(v, float) and v != v):
        return None
    if hasattr(v, "item"):
        v = v.item()
    if isinstance(v, float):
        return int(v) if v.is_integer() else round(v, 6)
    return v


@pytest.mark.parametrize("name", CHEAP)
def test_query_matches_oracle(spark, sf, con, name):
    s = entry.queries()[name](spark, sf).toPandas()
    o = con.execute(entry.oracle_sql()[name]).fetchdf()
    cols = sorted(s.columns)
    assert cols == sorted(o.columns)
    rs = sorted((tuple(_norm(x) for x in r) for r in s[cols].itertuples(index=False)), key=repr)
    ro = sorted((tuple(_norm(x) for x in r) for r in o[cols].itertuples(index=False)), key=repr)
    assert rs == ro
