"""Registered queries: one Spark plan per operator id of the survey, each with
the DuckDB oracle SQL that states the same result (when SQL can state it).

Every query reads whole tables of the given scale-factor directory.
"""

from __future__ import annotations

from collections.abc import Callable

from pyspark.sql import DataFrame, SparkSession
from pyspark.sql import functions as F

from kindred.operators.report import KIND_ORDER
from kindred.plans import fixtures as fx
from kindred.plans import oracle as O

QUERIES: dict[str, Callable[[SparkSession, str], DataFrame]] = {}
ORACLE: dict[str, str] = {}


def register(name: str, sql: str | None = None):
    def deco(fn):
        QUERIES[name] = fn
        if sql is not None:
            ORACLE[name] = sql
        return fn
    return deco


# ---------------------------------------------------------------------------
# Similarity joins on documents (whole texts)
# ---------------------------------------------------------------------------
T_DOCS = 75.0      # default threshold of the reference's join functions
BITS, BANDS = 64, 16


#: Classes of equal texts by their smallest id; null counts as empty.
CLASSES = "t AS (SELECT kind, min(id) AS id, coalesce(value, '') AS value FROM docs GROUP BY ALL)"
COPIES = """SELECT d.kind, t.id, d.id AS sim_id, {cols}, 'copy' AS link
FROM docs d JOIN t ON t.kind = d.kind AND t.value = coalesce(d.value, '') WHERE d.id <> t.id"""


def _ratio(threshold: float) -> str:
    return (f"least(length(l.value), length(r.value)) >= greatest(length(l.value), length(r.value)) * {(threshold - 0.005) / 100}")


def _scored(cand_where: str, threshold: float, kind_cte: str = "") -> str:
    """CTE ``s``: scores of the rows of ``t`` that pass the signature gate."""
    return f"""{O.simhash_ctes('t', BITS)},{kind_cte}
c AS (
  SELECT a.kind, a.id, b.id AS sim_id, xor(a.h, b.h) AS x
  FROM sig a JOIN sig b ON a.kind = b.kind AND a.id < b.id),
s AS (
  SELECT c.kind, c.id, c.sim_id, {O.score_expr('l.value', 'r.value')} AS score
  FROM c JOIN t l ON l.kind = c.kind AND l.id = c.id JOIN t r ON r.kind = c.kind AND r.id = c.sim_id
  WHERE {cand_where} AND {_ratio(threshold)})"""


def _links_sql(cand_where: str, threshold: float, cte: str = O.DOCS_CTE, kind_cte: str = "") -> str:
    """Links of a signature join: similar classes, and members to their representative."""
    return f"""WITH {cte}, {CLASSES},
{_scored(cand_where, threshold, kind_cte)}
SELECT kind, id, sim_id, score, 'near' AS link FROM s WHERE score >= {threshold}
UNION ALL {COPIES.format(cols='100.0 AS score')}"""


def _pairs_sql(cand_where: str, threshold: float, cte: str = O.DOCS_CTE, kind_cte: str = "") -> str:
    """All pairs of rows of a signature join."""
    return f"""WITH {cte}, t AS (SELECT kind, id, coalesce(value, '') AS value FROM docs),
{_scored(cand_where, threshold, kind_cte)}
SELECT kind, id, sim_id, score FROM s WHERE score >= {threshold}"""


def _exact_pairs_sql(threshold: float, cte: str = O.DOCS_CTE) -> str:
    """All pairs of rows whose score is at least ``threshold``."""
    return f"""WITH {cte}, t AS (SELECT kind, id, coalesce(value, '') AS value FROM docs),
s AS (
  SELECT l.kind, l.id, r.id AS sim_id, {O.score_expr('l.value', 'r.value')} AS score
  FROM t l JOIN t r ON l.kind = r.kind AND l.id < r.id WHERE {_ratio(threshold)})
SELECT kind, id, sim_id, score FROM s WHERE score >= {threshold}"""


def _ham(threshold: float) -> int:
    return int((1 - threshold / 100) * BITS)


@register("J9", _pairs_sql(f"bit_count(c.x) <= {_ham(T_DOCS)} AND {O.band_any('c.x', BITS, BANDS)}", T_DOCS))
def q_j9(spark: SparkSession, d: str) -> DataFrame:
    from kindred.operators.simjoin import duplicate_pairs
    return duplicate_pairs(fx.fx_docs(spark, d), T_DOCS, "lsh", BITS, BANDS)


@register("J7", _pairs_sql(f"bit_count(c.x) <= {_ham(T_DOCS)}", T_DOCS))
def q_j7(spark: SparkSession, d: str) -> DataFrame:
    from kindred.operators.simjoin import duplicate_pairs
    return duplicate_pairs(fx.fx_docs(spark, d), T_DOCS, "simhash", BITS)


@register("J3", _exact_pairs_sql(T_DOCS))
def q_j3(spark: SparkSession, d: str) -> DataFrame:
    from kindred.operators.simjoin import duplicate_pairs
    return duplicate_pairs(fx.fx_docs(spark, d), T_DOCS, "exact")


def _sig_sql(cte: str) -> str:
    return f"""WITH {cte},
t AS (SELECT * FROM docs),
{O.simhash_ctes('t', BITS)}"""


@register("F5", _sig_sql(O.DOCS_CTE) + f"\nSELECT kind, id, CAST(len AS INTEGER) AS len, {O.signed('h')} AS h FROM sig")
def q_f5(spark, d):
    from kindred.operators.simjoin import signatures
    return signatures(fx.fx_docs(spark, d), BITS, materialize=False)


@register("F8", _sig_sql(O.DOCS_CTE) + f"""
SELECT kind, id, CAST(b AS INTEGER) AS band, CAST((h >> (b * {BITS // BANDS})) & {(1 << (BITS // BANDS)) - 1} AS BIGINT) AS key
FROM sig, (SELECT unnest(range({BANDS})) AS b) bands""")
def q_f8(spark, d):
    from kindred.functions.similarity import band_keys
    from kindred.operators.simjoin import signatures
    sig = signatures(fx.fx_docs(spark, d), BITS, materialize=False)
    return sig.select("kind", "id", F.explode(band_keys("h", BITS, BANDS)).alias("b")).select(
        "kind", "id", F.col("b.band").alias("band"), F.col("b.key").alias("key"))


@register("J8", f"""WITH {O.DOCS_CTE}, t AS (SELECT kind, id, coalesce(value, '') AS value FROM docs),
{O.simhash_ctes('t', BITS)},
c AS (SELECT a.kind, a.id, b.id AS sim_id, xor(a.h, b.h) AS x FROM sig a JOIN sig b ON a.kind = b.kind AND a.id < b.id)
SELECT kind, id, sim_id, CAST(bit_count(x) AS INTEGER) AS hamming, 1.0 - bit_count(x) / {float(BITS)} AS simhash_similarity
FROM c WHERE bit_count(x) <= {_ham(T_DOCS)} AND {O.band_any('x', BITS, BANDS)}""")
def q_j8(spark, d):
    from kindred.operators.simjoin import candidate_pairs
    return candidate_pairs(fx.fx_docs(spark, d), T_DOCS, BITS, BANDS)


PREFILTER = 0.7 * T_DOCS   # the reference prefilters at 70 % of the threshold


@register("J4", f"""WITH {O.DOCS_CTE},
t AS (SELECT kind, id, length(value) AS len FROM docs WHERE length(value) > 0),
h AS (SELECT kind, len, min(id) AS class_id, count(*) AS n FROM t GROUP BY ALL),
c AS (SELECT a.kind, a.len, a.class_id, a.n, CAST(sum(b.n) - 1 AS BIGINT) AS n_links FROM h a JOIN h b ON a.kind = b.kind
  AND least(a.len, b.len) / greatest(a.len, b.len) >= {PREFILTER / 100} GROUP BY ALL)
SELECT t.kind, t.id, c.class_id, CAST(c.len AS INTEGER) AS len, c.n, c.n_links FROM t JOIN c ON c.kind = t.kind AND c.len = t.len""")
def q_j4(spark, d):
    # one row per document: its class of equal length and how many documents it pairs with
    from kindred.operators.simjoin import length_ratio_classes, with_length_class
    docs = fx.fx_docs(spark, d)
    found = with_length_class(docs.filter(F.length("value") > 0), length_ratio_classes(docs, PREFILTER))
    return found.select("kind", "id", "class_id", "len", "n", "n_links")


@register("J5", f"""WITH {O.DOCS_CTE}, t AS (SELECT * FROM docs WHERE length(value) > 0),
k AS (SELECT kind, CAST(floor(min(length(value)) * {PREFILTER / 100}) AS INTEGER) AS k FROM t GROUP BY kind),
p AS (SELECT t.kind, t.id, substr(t.value, 1, k.k) AS pfx FROM t JOIN k USING (kind))
SELECT a.kind, a.id, b.id AS sim_id FROM p a JOIN p b ON a.kind = b.kind AND a.pfx = b.pfx AND a.id < b.id""")
def q_j5(spark, d):
    from kindred.operators.simjoin import prefix_pairs
    return prefix_pairs(fx.fx_docs(spark, d), PREFILTER)


@register("J6", f"""WITH {O.DOCS_CTE}, t AS (SELECT kind, id, length(coalesce(value, '')) AS len FROM docs),
p AS (SELECT a.kind, a.len, count(*) AS pairs, count(*) FILTER (WHERE b.len > a.len) AS longer FROM t a JOIN t b ON a.kind = b.kind
  AND (a.len < b.len OR (a.len = b.len AND a.id < b.id))
  AND b.len <= floor(a.len / 0.7) AND b.len >= floor(a.len * 0.7) GROUP BY ALL),
c AS (SELECT t.kind, t.len, min(t.id) AS class_id, count(*) AS n, CAST(coalesce(any_value(longer), 0) / count(*) AS BIGINT) AS n_longer,
        coalesce(any_value(pairs), 0) AS pairs
      FROM t LEFT JOIN p ON p.kind = t.kind AND p.len = t.len GROUP BY t.kind, t.len)
SELECT t.kind, t.id, c.class_id, CAST(c.len AS INTEGER) AS len, c.n, c.n_longer, c.pairs FROM t JOIN c ON c.kind = t.kind AND c.len = t.len""")
def q_j6(spark, d):
    # one row per document, its class of equal length with the pairs of that class
    from kindred.operators.simjoin import length_window_classes, with_length_class
    docs = fx.fx_docs(spark, d)
    return with_length_class(docs, length_window_classes(docs, 0.7)).select("kind", "id", "class_id", "len", "n", "n_longer", "pairs")


# --- short names from part: exact copies, hot buckets -----------------------
T_SHORT = 75.0


SHORT_GATE = f"bit_count(c.x) <= {_ham(T_SHORT)} AND {O.band_any('c.x', BITS, BANDS)}"
J9S_SQL = _pairs_sql(SHORT_GATE, T_SHORT, O.SHORT_CTE)
J3S_SQL = f"""WITH {O.SHORT_CTE},
t AS (SELECT kind, id, coalesce(value, '') AS value FROM docs),
s AS (
  SELECT l.kind, l.id, r.id AS sim_id, {O.score_expr('l.value', 'r.value')} AS score
  FROM t l JOIN t r ON l.kind = r.kind AND l.id < r.id)
SELECT kind, id, sim_id, score FROM s WHERE score >= {T_SHORT}"""
# links of classes, which A2N nests
J9S_LINKS = _links_sql(SHORT_GATE, T_SHORT, O.SHORT_CTE)


def links_j9s(spark: SparkSession, d: str) -> DataFrame:
    """J9S as links of classes, from which reports count pairs of rows by class sizes."""
    from kindred.operators.simjoin import near_duplicates_lsh
    return near_duplicates_lsh(fx.fx_short(spark, d), T_SHORT, BITS, BANDS)


def links_j3s(spark: SparkSession, d: str) -> DataFrame:
    """J3S as links of classes."""
    from kindred.operators.simjoin import near_duplicates_exact
    return near_duplicates_exact(fx.fx_short(spark, d), T_SHORT)


@register("J9S", J9S_SQL)
def q_j9s(spark, d):
    from kindred.operators.simjoin import duplicate_pairs
    return duplicate_pairs(fx.fx_short(spark, d), T_SHORT, "lsh", BITS, BANDS)


@register("J3S", J3S_SQL)
def q_j3s(spark, d):
    from kindred.operators.simjoin import duplicate_pairs
    return duplicate_pairs(fx.fx_short(spark, d), T_SHORT, "exact")


@register("J10", _pairs_sql(
    f"bit_count(c.x) <= {_ham(50)} AND (sz.kind_rows <= 10 OR {O.band_any('c.x', BITS, BANDS)})", 50.0,
    kind_cte="\nsz AS (SELECT kind, count(*) AS kind_rows FROM docs GROUP BY kind),").replace(
        "FROM c JOIN t l", "FROM c JOIN sz ON sz.kind = c.kind JOIN t l"))
def q_j10(spark, d):
    from kindred.operators.simjoin import duplicate_pairs
    return duplicate_pairs(fx.fx_docs(spark, d), 50.0, "auto", BITS, BANDS)


@register("A7", f"""WITH a AS ({J9S_SQL}), b AS ({J3S_SQL}),
cnt AS (SELECT (SELECT count(*) FROM a) AS pa, (SELECT count(*) FROM b) AS pb,
               (SELECT count(*) FROM a JOIN b USING (kind, id, sim_id)) AS common)
SELECT CAST(pa AS BIGINT) AS pairs_a, CAST(pb AS BIGINT) AS pairs_b, CAST(common AS BIGINT) AS common,
       CASE WHEN pa = 0 THEN 0.0 ELSE common / pa END AS precision,
       CASE WHEN pb = 0 THEN 0.0 ELSE common / pb END AS recall,
       CASE WHEN common = 0 THEN 0.0 ELSE 2.0 * (common / pa) * (common / pb) / ((common / pa) + (common / pb)) END AS f1
FROM cnt""")
def q_a7(spark, d):
    from kindred.operators.report import pair_agreement
    return pair_agreement(links_j9s(spark, d), links_j3s(spark, d))


@register("A8", f"""WITH p AS ({J9S_SQL}),
m AS (SELECT kind, id FROM p UNION SELECT kind, sim_id FROM p),
tot AS (SELECT p_brand AS kind, count(*) AS total FROM part GROUP BY p_brand),
mt AS (SELECT kind, count(DISTINCT id) AS matched FROM m GROUP BY kind)
SELECT tot.kind, CAST(total AS BIGINT) AS total, CAST(coalesce(matched, 0) AS BIGINT) AS matched,
       coalesce(matched, 0) / total AS match_rate
FROM tot LEFT JOIN mt USING (kind)""")
def q_a8(spark, d):
    from kindred.operators.report import match_rate
    return match_rate(fx.fx_short(spark, d), links_j9s(spark, d))


@register("A9", f"""WITH {O.SHORT_CTE},
t AS (SELECT kind, id, coalesce(value, '') AS value FROM docs),
{O.simhash_ctes('t', BITS)},
c AS (SELECT a.kind, xor(a.h, b.h) AS x FROM sig a JOIN sig b ON a.kind = b.kind AND a.id < b.id),
cand AS (SELECT kind, count(*) AS candidates FROM c WHERE bit_count(x) <= {_ham(T_SHORT)} AND {O.band_any('x', BITS, BANDS)} GROUP BY kind),
n AS (SELECT kind, count(*) AS n FROM t GROUP BY kind)
SELECT n.kind, CAST(n.n AS BIGINT) AS n, CAST(coalesce(candidates, 0) AS BIGINT) AS candidates,
       CAST(n.n * (n.n - 1) / 2 AS BIGINT) AS all_pairs,
       CASE WHEN n.n < 2 THEN 0.0 ELSE coalesce(candidates, 0) / (n.n * (n.n - 1) / 2) END AS candidate_ratio
FROM n LEFT JOIN cand USING (kind)""")
def q_a9(spark, d):
    from kindred.operators.report import candidate_reduction
    from kindred.operators.simjoin import candidate_links
    rows = fx.fx_short(spark, d)
    return candidate_reduction(rows, candidate_links(rows, T_SHORT, BITS, BANDS))


@register("A2", f"""WITH p0 AS ({J9S_SQL}),
p AS (SELECT kind, id, sim_id, score FROM p0 UNION ALL SELECT kind, sim_id, id, score FROM p0)
SELECT kind, id, CAST(count(*) AS BIGINT) AS n_matches, max(score) AS best_score,
       min(sim_id) FILTER (WHERE score = best) AS best_sim_id
FROM (SELECT *, max(score) OVER (PARTITION BY kind, id) AS best FROM p) GROUP BY kind, id""")
def q_a2(spark, d):
    from kindred.operators.report import match_summary
    return match_summary(links_j9s(spark, d))


@register("A2N", f"""WITH p0 AS ({J9S_LINKS}), {O.SHORT_CTE},
p AS (SELECT kind, id, sim_id, score FROM p0 UNION ALL SELECT kind, sim_id, id, score FROM p0)
SELECT p.kind, p.id, p.sim_id, p.score, o.value AS sim_value, o.check_admin AS sim_check_admin
FROM p JOIN docs o ON o.kind = p.kind AND o.id = p.sim_id""")
def q_a2n(spark, d):
    # nested matches per row, hubs in parts of about twenty; flat again for the comparison
    from kindred.operators.report import nest_matches
    from kindred.operators.simjoin import mirror
    nested = nest_matches(fx.fx_short(spark, d), mirror(links_j9s(spark, d)), limit=20)
    return nested.select("kind", "id", F.explode("similarities").alias("sim_id", "m")).select(
        "kind", "id", "sim_id", "m.score", F.col("m.value").alias("sim_value"), F.col("m.check_admin").alias("sim_check_admin"))


@register("R3", """WITH i AS (SELECT lang AS kind, doc_id // 3 AS id, doc_id AS pos, text AS value, CAST(doc_id % 5 AS INTEGER) AS check_admin FROM documents)
SELECT kind, id, min(pos) AS pos, arg_min(value, pos) AS value, arg_min(check_admin, pos) AS check_admin FROM i GROUP BY kind, id""")
def q_r3(spark, d):
    # up to three documents with one key: the first of them is the base
    from kindred.operators.report import merge_items
    from kindred.session import read_table
    docs = read_table(spark, d, "documents")
    return merge_items(docs.select(F.col("lang").alias("kind"), F.floor(F.col("doc_id") / 3).alias("id"), F.col("doc_id").alias("pos"),
                                   F.col("text").alias("value"), (F.col("doc_id") % 5).cast("int").alias("check_admin")))


@register("P15", f"""WITH {O.SHORT_CTE}, p AS ({J9S_SQL})
SELECT id, kind, check_admin FROM docs WHERE id IN (SELECT id FROM p UNION SELECT sim_id FROM p)""")
def q_p15(spark, d):
    from kindred.operators.simjoin import mirror
    rows = fx.fx_short(spark, d)
    m = mirror(links_j9s(spark, d)).select("id").distinct()
    return rows.join(m, "id", "left_semi").select("id", "kind", "check_admin")


@register("P1", """SELECT doc_id AS id, lang || '_' || source AS kind FROM documents
WHERE lang || '_' || source IN ('en_src1', 'fr_src2', 'de_src3')""")
def q_p1(spark, d):
    from kindred.operators.report import kind_filter
    return kind_filter(fx.fx_docs(spark, d), ["en_src1", "fr_src2", "de_src3"]).select("id", "kind")


@register("P17", """WITH w AS (SELECT DISTINCT p_brand AS word FROM part UNION ALL SELECT 'Brand#00'),
f AS (SELECT p_brand AS word, min(p_partkey) AS pk FROM part GROUP BY p_brand)
SELECT w.word, f.pk AS p_partkey, p.p_name FROM w LEFT JOIN f USING (word) LEFT JOIN part p ON p.p_partkey = f.pk""")
def q_p17(spark, d):
    from kindred.operators.report import lookup_first
    from kindred.session import read_table
    part = read_table(spark, d, "part")
    words = part.select(F.col("p_brand").alias("word")).distinct().unionByName(
        spark.range(1).select(F.lit("Brand#00").alias("word")))
    data = part.select(F.col("p_brand").alias("word"), "p_partkey", "p_name")
    return lookup_first(words, data, "word", "p_partkey")


# ---------------------------------------------------------------------------
# Reports and orderings
# ---------------------------------------------------------------------------

@register("A3", f"""WITH {O.DOCS_CTE}
SELECT kind, CAST(count(*) FILTER (WHERE check_admin IN (0, 1, 2, 3, 4)) AS BIGINT) AS total_questions,
""" + ",\n".join(f"CAST(count(*) FILTER (WHERE check_admin = {c}) AS BIGINT) AS check_admin_{c}" for c in range(5))
          + "\nFROM docs GROUP BY kind")
def q_a3(spark, d):
    from kindred.operators.report import status_counts
    return status_counts(fx.fx_docs(spark, d))


BLUEPRINT_CTE = """bp AS (SELECT CAST(p_size % 7 + 1 AS INTEGER) AS level, p_type AS section, p_brand AS kind,
                      p_retailprice AS score, CAST(p_size % 5 + 1 AS BIGINT) AS count_question,
                      CAST(p_size % 3 + p_partkey % 4 AS BIGINT) AS sub_count, CAST(p_size AS BIGINT) AS time FROM part)"""


@register("A10", f"""WITH {BLUEPRINT_CTE}
SELECT level, section, CAST(sum(count_question) AS BIGINT) AS questions, CAST(sum(sub_count) AS BIGINT) AS sub_questions,
       sum(score) AS score, CAST(sum(time) AS BIGINT) AS time FROM bp GROUP BY level, section""")
def q_a10(spark, d):
    from kindred.operators.report import blueprint_totals
    return blueprint_totals(fx.fx_blueprint(spark, d))


@register("A10D", f"""WITH {BLUEPRINT_CTE}, {O.SHORT_CTE},
dm AS (SELECT kind, CAST(sum(count_question) AS BIGINT) AS demand FROM bp GROUP BY kind),
st AS (SELECT kind, count(*) FILTER (WHERE check_admin = 1) AS stock FROM docs GROUP BY kind)
SELECT dm.kind, demand, CAST(coalesce(stock, 0) AS BIGINT) AS stock,
       CAST(greatest(demand - coalesce(stock, 0), 0) AS BIGINT) AS shortfall FROM dm LEFT JOIN st USING (kind)""")
def q_a10d(spark, d):
    from kindred.operators.report import status_counts, stock_vs_demand
    return stock_vs_demand(fx.fx_blueprint(spark, d), status_counts(fx.fx_short(spark, d)))


@register("R1", f"""WITH p0 AS ({J9S_SQL}), {O.SHORT_CTE},
p AS (SELECT kind, id, sim_id, score FROM p0 UNION ALL SELECT kind, sim_id, id, score FROM p0),
items AS (SELECT kind, id, id AS pos, value, check_admin FROM docs),
m AS (SELECT p.kind, p.id, p.sim_id, p.score, o.value AS sim_value, o.check_admin AS sim_check_admin
      FROM p LEFT JOIN items o ON o.kind = p.kind AND o.id = p.sim_id),
j AS (SELECT i.kind, i.id, i.pos, i.value, i.check_admin, m.sim_id, m.score, m.sim_value, m.sim_check_admin
      FROM items i LEFT JOIN m ON m.kind = i.kind AND m.id = i.id),
s AS (SELECT *, row_number() OVER (PARTITION BY kind, id ORDER BY sim_id NULLS FIRST) AS seq FROM j),
r AS (SELECT *, row_number() OVER (PARTITION BY kind ORDER BY pos, seq) AS rw FROM s),
sp AS (SELECT kind, id, min(rw) AS first_row, max(rw) AS last_row FROM r GROUP BY kind, id)
SELECT r.kind, r.id AS item_id, CAST(seq AS INTEGER) AS seq, CAST(rw AS BIGINT) AS row,
       CAST(first_row AS BIGINT) AS first_row, CAST(last_row AS BIGINT) AS last_row,
       CASE WHEN seq = 1 THEN CAST(r.id AS VARCHAR) ELSE '' END AS id,
       CASE WHEN seq = 1 THEN r.value ELSE '' END AS value,
       CASE WHEN seq = 1 THEN CAST(r.check_admin AS VARCHAR) ELSE '' END AS check_admin,
       coalesce(CAST(sim_id AS VARCHAR), '') AS sim_id, coalesce(sim_value, '') AS sim_value,
       CASE WHEN score IS NULL OR isnan(score) OR isinf(score) THEN '' ELSE CAST(score AS VARCHAR) || '%' END AS score_text,
       coalesce(CAST(sim_check_admin AS VARCHAR), '') AS sim_check_admin, '' AS confirm
FROM r JOIN sp ON sp.kind = r.kind AND sp.id = r.id""")
def q_r1(spark, d):
    from kindred.operators.report import report_rows
    from kindred.operators.simjoin import mirror
    items = fx.fx_short(spark, d).withColumn("pos", F.col("id"))
    return report_rows(items, mirror(q_j9s(spark, d)))


LISTED = ", ".join(f"('{k}', {i})" for i, k in enumerate(KIND_ORDER))


@register("O1", f"""WITH l AS (SELECT * FROM (VALUES {LISTED}) v(kind, listed)),
k AS (SELECT DISTINCT coalesce(l.kind, 'extra_' || (p_size % 7)) AS kind, listed FROM part LEFT JOIN l ON l.listed = 2 * (p_partkey % 40))
SELECT kind, CAST(coalesce(listed, {len(KIND_ORDER)} + dense_rank() OVER (PARTITION BY listed IS NULL ORDER BY kind) - 1) AS INTEGER) AS sheet_pos FROM k""")
def q_o1(spark, d):
    # every second kind of the list occurs, beside kinds that are not on it
    from kindred.operators.report import kind_order
    from kindred.session import read_table
    at = 2 * (F.col("p_partkey") % 40)
    listed = F.get(F.array(*[F.lit(k) for k in KIND_ORDER]), at.cast("int"))
    part = read_table(spark, d, "part")
    return kind_order(part.select(F.coalesce(listed, F.concat(F.lit("extra_"), F.col("p_size") % 7)).alias("kind")))


@register("O3", f"""WITH {O.DOCS_CTE}
SELECT id, kind, check_admin FROM docs WHERE check_admin = 1 UNION ALL
SELECT id, kind, check_admin FROM docs WHERE check_admin = 2 UNION ALL
SELECT id, kind, check_admin FROM docs WHERE check_admin = 3 UNION ALL
SELECT id, kind, check_admin FROM docs WHERE check_admin = 4""")
def q_o3(spark, d):
    from kindred.sources.io import union_inputs
    docs = fx.fx_docs(spark, d).select("id", "kind", "check_admin")
    return union_inputs([docs.filter(F.col("check_admin") == c) for c in (1, 2, 3, 4)])


@register("O5", f"""SELECT kind, id, sim_id FROM ({J9S_SQL}) INTERSECT SELECT kind, id, sim_id FROM ({J3S_SQL})""")
def q_o5(spark, d):
    return q_j9s(spark, d).select("kind", "id", "sim_id").intersect(q_j3s(spark, d).select("kind", "id", "sim_id"))


def _sheet_sql(name: str, col: str, pos: str) -> str:
    return (f"SELECT '{name}' AS sheet, '{col}' AS column_name, CASE WHEN {pos} % 7 = 0 THEN NULL "
            f"ELSE CAST({col} AS VARCHAR) END AS v, {pos} AS pos FROM {name}")


@register("A1", f"""WITH u AS (
  {_sheet_sql('events', 'event_id', 'event_id')} UNION ALL
  {_sheet_sql('documents', 'doc_id', 'doc_id')} UNION ALL
  {_sheet_sql('embeddings', 'vec_id', 'vec_id')} UNION ALL
  SELECT 'region', 'r_regionkey', CAST(r_regionkey AS VARCHAR), r_regionkey FROM region UNION ALL
  {_sheet_sql('part', 'p_partkey', 'p_partkey')}),
c AS (SELECT sheet, column_name, CAST(count(v) AS BIGINT) AS total_ids, CAST(count(DISTINCT v) AS BIGINT) AS unique_ids
      FROM u GROUP BY sheet, column_name),
f AS (SELECT sheet, v, min(pos) AS first_pos FROM u WHERE v IS NOT NULL GROUP BY sheet, v),
t AS (SELECT *, row_number() OVER (PARTITION BY sheet ORDER BY first_pos, v) AS rn FROM f),
sm AS (SELECT sheet, string_agg(v, ',' ORDER BY rn) AS sample_ids FROM t WHERE rn <= 5 GROUP BY sheet)
SELECT c.sheet, column_name, total_ids, unique_ids, coalesce(sample_ids, '') AS sample_ids FROM c LEFT JOIN sm USING (sheet)""")
def q_a1(spark, d):
    from kindred.operators.report import id_audit
    from kindred.plans.source_queries import folder
    from kindred.sources.io import read_sheet_frames, write_sheets
    sheets = fx.fx_sheets(spark, d)
    blank = sheets.pop("_blank")
    pos = {"events": "event_id", "documents": "doc_id", "embeddings": "vec_id", "part": "p_partkey"}
    path = folder(spark, "sheets")
    write_sheets({k: (blank(v, pos[k]) if k in pos else v) for k, v in sheets.items()}, path)
    return id_audit(read_sheet_frames(spark, path), pos_cols={**{k: "_pos" for k in pos}, "region": "r_regionkey"})


# ---------------------------------------------------------------------------
# Related-ID pipeline
# ---------------------------------------------------------------------------

def _filled(spark, d):
    from kindred.plans.related import fill_reviewed
    return fill_reviewed(fx.fx_reviewed(spark, d))


@register("W1", f"""WITH {O.REVIEWED_CTE}
SELECT pos, id, value, kind, check_admin, sim_id FROM filled""")
def q_w1(spark, d):
    return _filled(spark, d).select("pos", "id", "value", "kind", "check_admin", "sim_id")


@register("A6", f"""WITH {O.REVIEWED_CTE}
SELECT sum(CAST(filled_id AS BIGINT)) AS filled_id, sum(CAST(filled_value AS BIGINT)) AS filled_value,
       sum(CAST(filled_kind AS BIGINT)) AS filled_kind, sum(CAST(filled_check_admin AS BIGINT)) AS filled_check_admin
FROM filled""")
def q_a6(spark, d):
    from kindred.plans.related import filled_counts
    return filled_counts(_filled(spark, d))


CHAINS_SQL = """chains AS (SELECT CAST(floor((c_custkey - 1) / 100) AS BIGINT) AS kind, c_custkey AS src,
                          c_custkey + 1 AS dst FROM customer)"""


@register("G1", f"""WITH {CHAINS_SQL}, {O.components_ctes('chains')}
SELECT kind, id, component FROM comp""")
def q_g1(spark, d):
    from kindred.operators.graph import connected_components
    return connected_components(fx.fx_chains(spark, d))


@register("G2", f"""WITH {CHAINS_SQL}, {O.components_ctes('chains')},
st AS (SELECT kind, component, max(id) AS mx, count(DISTINCT id) AS n FROM comp GROUP BY kind, component)
SELECT c.kind, c.component, c.id FROM comp c JOIN st USING (kind, component) WHERE c.id <> st.mx OR st.n = 1""")
def q_g2(spark, d):
    from kindred.operators.graph import connected_components, drop_largest
    return drop_largest(connected_components(fx.fx_chains(spark, d))).select("kind", "component", "id")


REVIEWED_COMP = f"""{O.REVIEWED_CTE},
redges AS (SELECT kind, id AS src, sim_id AS dst FROM filled),
{O.components_ctes('redges')}"""


@register("G3", f"""WITH {REVIEWED_COMP},
st AS (SELECT kind, component, max(id) AS mx, count(DISTINCT id) AS n FROM comp GROUP BY kind, component),
kept AS (SELECT c.kind, c.component, c.id FROM comp c JOIN st USING (kind, component) WHERE c.id <> st.mx OR st.n = 1),
first_ AS (SELECT kind, min(pos) AS kind_pos FROM filled WHERE kind IS NOT NULL GROUP BY kind)
SELECT kind, component, id, CAST(row_number() OVER (ORDER BY kind_pos, component, id) - 1 AS BIGINT) AS position
FROM kept JOIN first_ USING (kind) WHERE id NOT IN (SELECT doc_id FROM labels WHERE toxic = 1)""")
def q_g3(spark, d):
    from kindred.plans.related import related_pipeline
    from kindred.session import read_table
    ex = read_table(spark, d, "labels").filter("toxic = 1").select("doc_id")
    return related_pipeline(fx.fx_reviewed(spark, d), ex).select("kind", "component", "id", "position")


@register("O6", f"""WITH {REVIEWED_COMP},
first_ AS (SELECT kind, min(pos) AS kind_pos FROM filled WHERE kind IS NOT NULL GROUP BY kind)
SELECT kind, id, CAST(row_number() OVER (ORDER BY kind_pos, component, id) - 1 AS BIGINT) AS position
FROM comp JOIN first_ USING (kind)""")
def q_o6(spark, d):
    from kindred.plans.related import flat_ids, related_groups
    filled = _filled(spark, d)
    return flat_ids(related_groups(filled), filled).select("kind", "id", "position")


@register("A4", f"""WITH {REVIEWED_COMP},
per AS (SELECT kind, count(DISTINCT component) AS g, count(*) AS n FROM comp GROUP BY kind),
kinds AS (SELECT DISTINCT kind FROM filled WHERE kind IS NOT NULL),
full_ AS (SELECT k.kind, coalesce(p.g, 0) AS g, coalesce(p.n, 0) AS n FROM kinds k LEFT JOIN per p USING (kind))
SELECT kind, CAST(sum(g) AS BIGINT) AS related_groups, CAST(sum(n) AS BIGINT) AS total_related_ids,
       CAST(count(*) AS BIGINT) AS kinds
FROM full_ GROUP BY ROLLUP (kind)""")
def q_a4(spark, d):
    from kindred.plans.related import group_summary, related_groups
    filled = _filled(spark, d)
    return group_summary(filled, related_groups(filled))


@register("A5", f"""WITH {REVIEWED_COMP},
per AS (SELECT kind, count(DISTINCT component) AS related_groups FROM comp GROUP BY kind),
first_ AS (SELECT kind, min(pos) AS first_pos FROM filled WHERE kind IS NOT NULL GROUP BY kind)
SELECT kind, related_groups FROM per JOIN first_ USING (kind) WHERE related_groups > 0
ORDER BY related_groups DESC, first_pos LIMIT 5""")
def q_a5(spark, d):
    from kindred.plans.related import related_groups, top_kinds
    filled = _filled(spark, d)
    return top_kinds(filled, related_groups(filled))


@register("P16", """SELECT doc_id AS id FROM documents WHERE doc_id NOT IN (SELECT doc_id FROM labels WHERE toxic = 1)""")
def q_p16(spark, d):
    from kindred.plans.related import exclude_ids
    from kindred.session import read_table
    docs = read_table(spark, d, "documents").select(F.col("doc_id").alias("id"))
    return exclude_ids(docs, read_table(spark, d, "labels").filter("toxic = 1").select("doc_id"))


def queries() -> dict[str, Callable[[SparkSession, str], DataFrame]]:
    return dict(QUERIES)


def oracle_sql() -> dict[str, str]:
    return dict(ORACLE)


# query modules that register themselves
from kindred.plans import text_queries  # noqa: E402,F401
from kindred.plans import exam_queries  # noqa: E402,F401
from kindred.plans import misc_queries  # noqa: E402,F401
from kindred.plans import source_queries  # noqa: E402,F401
