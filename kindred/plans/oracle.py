"""DuckDB SQL fragments shared by the oracle queries.

These strings are test oracles: they restate each operator in plain SQL on the
pre-registered tables so the Spark result can be compared value by value.
"""

from __future__ import annotations

DOCS_CTE = """docs AS (
  SELECT doc_id AS id, lang || '_' || source AS kind, CAST(doc_id % 5 AS INTEGER) AS check_admin,
         lower(regexp_replace(text, '[^\\p{L}\\p{N}]', '', 'g')) AS value
  FROM documents)"""

SHORT_CTE = """docs AS (
  SELECT p_partkey AS id, p_brand AS kind, CAST(p_partkey % 5 AS INTEGER) AS check_admin,
         lower(regexp_replace(p_name, '[^a-zA-Z0-9]', '', 'g')) AS value
  FROM part)"""


def simhash_ctes(src: str = "t", bits: int = 64) -> str:
    """CTEs ``sh``, ``agg``, ``sig(kind, id, len, h UBIGINT)`` over ``src(kind, id, value)``."""
    sums = ",\n    ".join(f"sum((hv >> {i}) & 1) AS b{i}" for i in range(bits))
    ors = "\n    | ".join(f"(CASE WHEN 2 * b{i} > n THEN (1::UBIGINT << {i}) ELSE 0::UBIGINT END)"
                         for i in range(bits))
    return f"""sh0 AS (
  SELECT kind, id, value, unnest(range(1, greatest(length(value) - 2, 1) + 1)) AS p FROM {src} WHERE length(value) > 0),
sh AS (
  SELECT kind, id, ('0x' || substr(md5(substr(value, p, 3)), 17, 16))::UBIGINT AS hv FROM sh0),
agg AS (
  SELECT kind, id, count(*) AS n,
    {sums}
  FROM sh GROUP BY kind, id),
sig AS (
  SELECT a.kind, a.id, length(t2.value) AS len, (0::UBIGINT
    | {ors}) AS h
  FROM agg a JOIN {src} t2 ON a.kind = t2.kind AND a.id = t2.id
  UNION ALL
  SELECT kind, id, 0 AS len, 0::UBIGINT AS h FROM {src} WHERE length(value) = 0)"""


def signed(expr: str) -> str:
    """UBIGINT -> two's complement BIGINT (Spark's representation)."""
    return f"(CASE WHEN {expr} >= 9223372036854775808::UBIGINT THEN -CAST(~({expr}) AS BIGINT) - 1 ELSE CAST({expr} AS BIGINT) END)"


def band_any(x: str, bits: int, bands: int) -> str:
    rows = bits // bands
    mask = (1 << rows) - 1
    return "(" + " OR ".join(f"(({x} >> {b * rows}) & {mask}::UBIGINT) = 0" for b in range(bands)) + ")"


#: The letters outside ASCII that normalised documents hold, and unused ASCII
#: characters to stand for them: DuckDB's levenshtein counts bytes.
NON_ASCII, STAND_IN = "éßèíñçäóêöü", "!#$%&()*+,-"


def score_expr(a: str, b: str) -> str:
    la, lb = (f"translate({x}, '{NON_ASCII}', '{STAND_IN}')" for x in (a, b))
    m = f"greatest(length({a}), length({b}))"
    return (f"(CASE WHEN {m} = 0 THEN 100.0 ELSE round_even(({m} - levenshtein({la}, {lb}))::DOUBLE / {m} * 100, 2) END)")


REVIEWED_CTE = """rv AS (
  SELECT event_id AS pos,
         CASE WHEN event_id % 3 = 1 THEN user_id END AS id,
         CASE WHEN event_id % 4 = 0 THEN CAST(value AS VARCHAR) WHEN event_id % 4 = 1 THEN '' END AS value,
         CASE WHEN event_id % 3 = 0 THEN event_type END AS kind,
         CASE WHEN event_id % 2 = 0 THEN CAST(event_id % 5 AS INTEGER) END AS check_admin,
         CASE WHEN event_id % 3 = 2 THEN user_id END AS sim_id
  FROM events),
fl0 AS (
  SELECT *,
    last_value(CASE WHEN id IS NOT NULL AND id <> 0 THEN id END IGNORE NULLS) OVER w AS l_id,
    last_value(CASE WHEN value IS NOT NULL AND value <> '' THEN value END IGNORE NULLS) OVER w AS l_value,
    last_value(CASE WHEN kind IS NOT NULL AND kind <> '' THEN kind END IGNORE NULLS) OVER w AS l_kind,
    last_value(CASE WHEN check_admin IS NOT NULL AND check_admin <> 0 THEN check_admin END IGNORE NULLS) OVER w AS l_ca
  FROM rv WINDOW w AS (ORDER BY pos ROWS BETWEEN UNBOUNDED PRECEDING AND CURRENT ROW)),
filled AS (
  SELECT pos,
    CASE WHEN (id IS NULL OR id = 0) AND l_id IS NOT NULL THEN l_id ELSE id END AS id,
    CASE WHEN (value IS NULL OR value = '') AND l_value IS NOT NULL THEN l_value ELSE value END AS value,
    CASE WHEN (kind IS NULL OR kind = '') AND l_kind IS NOT NULL THEN l_kind ELSE kind END AS kind,
    CASE WHEN (check_admin IS NULL OR check_admin = 0) AND l_ca IS NOT NULL THEN l_ca ELSE check_admin END AS check_admin,
    sim_id,
    (id IS NULL OR id = 0) AND l_id IS NOT NULL AS filled_id,
    (value IS NULL OR value = '') AND l_value IS NOT NULL AS filled_value,
    (kind IS NULL OR kind = '') AND l_kind IS NOT NULL AS filled_kind,
    (check_admin IS NULL OR check_admin = 0) AND l_ca IS NOT NULL AS filled_check_admin
  FROM fl0)"""


def components_ctes(edges: str) -> str:
    """``comp(kind, id, component)`` from ``edges(kind, src, dst)`` by recursive reachability."""
    return f"""e0 AS (
  SELECT DISTINCT kind, CAST(src AS BIGINT) AS a, CAST(dst AS BIGINT) AS b FROM {edges}
  WHERE kind IS NOT NULL AND coalesce(src, 0) <> 0 AND coalesce(dst, 0) <> 0 AND src <> dst),
e AS (SELECT kind, a, b FROM e0 UNION SELECT kind, b, a FROM e0),
reach AS (
  WITH RECURSIVE r(kind, node, lbl) AS (
    SELECT kind, a, a FROM e
    UNION
    SELECT r.kind, e.b, r.lbl FROM r JOIN e ON r.kind = e.kind AND r.node = e.a)
  SELECT kind, node, min(lbl) AS lbl FROM r GROUP BY kind, node),
comp AS (SELECT kind, node AS id, lbl AS component FROM reach)"""
