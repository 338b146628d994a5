"""Registered exam-assembly queries (E1-E12, W2, W3) with flat outputs."""

from __future__ import annotations

from pyspark.sql import functions as F

from kindred.operators import exams as E
from kindred.operators.fill import sequential_ids
from kindred.operators.parallel import spread
from kindred.plans import fixtures as fx
from kindred.plans.registry import register
from kindred.session import write_once


def TN(t: str) -> str:
    """SQL form of E1."""
    return (f"coalesce(TRY_CAST(nullif(regexp_extract(trim({t}), '(\\d+)$', 1), '') AS BIGINT), "
            f"TRY_CAST(nullif(regexp_extract(trim({t}), '^(\\d+)\\s+번', 1), '') AS BIGINT))")


def KO(t: str) -> str:
    return f"TRY_CAST(nullif(regexp_extract({t}, '^(\\d+)\\s+번', 1), '') AS BIGINT)"


INC = "(CASE WHEN level <= 2 THEN 40 ELSE 15 END)"
SUFFIX_VALUES = ", ".join(f"('{s}', '{lg}', '{t}')" for s, per in E.SKILL_SUFFIX.items() for lg, t in per.items())
LANG_LIST = "['vi', 'en', 'ko', 'ja', 'fr', 'ru']"

EXAMS_CTE = f"""ex AS (SELECT o_orderkey AS id, CAST(o_orderkey % 6 + 1 AS INTEGER) AS level,
                   'Test ' || (o_orderkey % 90 + 1) AS title, o_orderkey % 90 + 1 AS test FROM orders),
tl AS (SELECT e.id, e.level, lang, CASE lang WHEN 'vi' THEN 'Đề thi ' || n WHEN 'en' THEN 'Test ' || n
                WHEN 'ko' THEN n || ' 번 시험지' WHEN 'ja' THEN 'テスト ' || n WHEN 'fr' THEN 'Test ' || n
                ELSE 'Тест ' || n END AS text
       FROM (SELECT id, level, CAST(test AS VARCHAR) AS n FROM ex) e, (SELECT unnest({LANG_LIST}) AS lang) l),
pt AS (SELECT l_orderkey AS id,
         CAST(row_number() OVER (PARTITION BY l_orderkey ORDER BY l_linenumber, l_partkey, l_suppkey, l_extendedprice) - 1
              AS INTEGER) AS part_pos,
         CASE l_linenumber % 4 WHEN 0 THEN 'Listening' WHEN 1 THEN 'Reading' WHEN 2 THEN 'Writing' ELSE 'Translation' END AS name,
         CAST(l_quantity AS INTEGER) AS time, l_linenumber FROM lineitem),
sfx AS (SELECT * FROM (VALUES {SUFFIX_VALUES}) v(skill, lang, suffix))"""


def _exams(spark, d):
    return fx.fx_exams(spark, d)


@register("E1", f"""WITH {EXAMS_CTE}
SELECT id, 'title' AS lang, {TN('title')} AS number FROM ex
UNION ALL SELECT id, lang, {TN('text')} FROM tl""")
def q_e1(spark, d):
    x = _exams(spark, d)
    a = x.select("id", F.lit("title").alias("lang"), E.title_number("title").alias("number"))
    b = x.select("id", F.explode("title_lang").alias("lang", "text")).select(
        "id", "lang", E.title_number("text").alias("number"))
    return a.unionByName(b)


@register("E2", f"""WITH {EXAMS_CTE}, names AS (SELECT DISTINCT name FROM pt)
SELECT n.name AS skill, l.lang, coalesce(s.suffix, n.name) AS suffix
FROM names n, (SELECT unnest({LANG_LIST}) AS lang) l LEFT JOIN sfx s ON s.skill = n.name AND s.lang = l.lang""")
def q_e2(spark, d):
    names = _exams(spark, d).select(F.explode("parts.name").alias("skill")).distinct()
    langs = F.explode(F.array(*[F.lit(x) for x in E.LANGS])).alias("lang")
    return names.select("skill", langs).select("skill", "lang", E.skill_suffix("skill", "lang").alias("suffix"))


@register("E3", f"""WITH {EXAMS_CTE}
SELECT id, CASE WHEN {TN('title')} IS NOT NULL THEN 'Test ' || ({TN('title')} + {INC}) ELSE title END AS title,
       0 AS active, 4 AS type FROM ex""")
def q_e3(spark, d):
    return E.renumber_regular(_exams(spark, d)).select("id", "title", "active", "type")


@register("E4", f"""WITH {EXAMS_CTE}
SELECT id, lang, CASE WHEN lang = 'ko' THEN (CASE WHEN {KO('text')} IS NOT NULL THEN ({KO('text')} + {INC}) || ' 번 시험지' ELSE text END)
  WHEN {TN('text')} IS NOT NULL THEN replace(text, CAST({TN('text')} AS VARCHAR), CAST({TN('text')} + {INC} AS VARCHAR))
  ELSE text END AS title FROM tl""")
def q_e4(spark, d):
    r = E.renumber_regular(_exams(spark, d))
    return r.select("id", F.explode("title_lang").alias("lang", "title"))


SKILL_ROWS = f"""sk AS (SELECT ex.id AS exam_id, pt.part_pos, ex.level, ex.test, ex.title, pt.name, pt.time, {INC} AS inc
       FROM ex JOIN pt ON pt.id = ex.id
       WHERE {TN('ex.title')} IS NOT NULL AND pt.name IN ('Listening', 'Reading', 'Writing'))"""


@register("E5", f"""WITH {EXAMS_CTE}, {SKILL_ROWS}
SELECT exam_id, part_pos, level, 'Test ' || ({TN('title')} + inc) || ' - ' || name AS title, time,
       100 AS score, 0 AS active, 5 AS type, 0 AS sequence FROM sk""")
def q_e5(spark, d):
    return E.split_skills(_exams(spark, d)).select("exam_id", "part_pos", "level", "title", "time", "score",
                                                  "active", "type", "sequence")


@register("E6", f"""WITH {EXAMS_CTE}, {SKILL_ROWS}
SELECT sk.exam_id, sk.part_pos, tl.lang,
  CASE WHEN tl.lang = 'ko' AND {KO('tl.text')} IS NOT NULL
       THEN ({TN('tl.text')} + sk.inc) || ' 번 시험지 - ' || coalesce(s.suffix, sk.name)
       ELSE replace(tl.text, CAST({TN('tl.text')} AS VARCHAR), CAST({TN('tl.text')} + sk.inc AS VARCHAR)) || ' - ' || coalesce(s.suffix, sk.name)
  END AS title
FROM sk JOIN tl ON tl.id = sk.exam_id LEFT JOIN sfx s ON s.skill = sk.name AND s.lang = tl.lang
WHERE {TN('tl.text')} IS NOT NULL""")
def q_e6(spark, d):
    s = E.split_skills(_exams(spark, d))
    return s.select("exam_id", "part_pos", F.explode("title_lang").alias("lang", "title"))


@register("W2", f"""WITH {EXAMS_CTE}, {SKILL_ROWS},
u AS (SELECT 0 AS src, level, test, id AS exam_id, -1 AS part_pos FROM ex
      UNION ALL SELECT 1, level, test, exam_id, part_pos FROM sk)
SELECT CAST(src AS INTEGER) AS src, exam_id, CAST(part_pos AS INTEGER) AS part_pos,
       CAST({E.REGULAR_FIRST_ID} + row_number() OVER (ORDER BY src, level, test, exam_id, part_pos) - 1 AS BIGINT) AS new_id
FROM u""")
def q_w2(spark, d):
    x = _exams(spark, d)
    reg = x.select(F.lit(0).alias("src"), "level", "test", F.col("id").alias("exam_id"),
                   F.lit(-1).alias("part_pos"))
    sk = E.split_skills(x).join(x.select(F.col("id").alias("exam_id"), "test"), "exam_id").select(
        F.lit(1).alias("src"), "level", "test", "exam_id", "part_pos")
    u = reg.unionByName(sk)
    out = sequential_ids(u, ["src", "level", "test", "exam_id", "part_pos"], E.REGULAR_FIRST_ID, out="new_id")
    return out.select("src", "exam_id", "part_pos", "new_id")


# --- AI exams --------------------------------------------------------------------

def DEC(t: str) -> str:
    """SQL form of E9."""
    def n(p):
        return f"TRY_CAST(regexp_extract({t}, '{p}', 1) AS BIGINT)"
    cases = []
    for prefix in E.DECREMENT_PREFIXES:
        if prefix is None:
            p = "^(\\d+)\\s+번"
            cases.append(f"WHEN regexp_matches({t}, '{p}') THEN replace({t}, {n(p)} || ' 번', greatest({n(p)} - 60, 1) || ' 번')")
        else:
            p = prefix + "(\\d+)"
            cases.append(f"WHEN regexp_matches({t}, '{p}') THEN replace({t}, '{prefix}' || {n(p)}, '{prefix}' || greatest({n(p)} - 60, 1))")
    return "(CASE " + " ".join(cases) + f" ELSE {t} END)"


AI_CTE = f"""ai0 AS (SELECT o_orderkey AS id,
    CASE WHEN o_orderkey % 5 <> 0 THEN CAST(o_orderkey % 6 + 1 AS INTEGER) END AS level0,
    CASE WHEN o_orderkey % 4 <> 0 THEN 'Test ' || (o_orderkey % 90 + 61) ELSE 'Exam ' || (o_orderkey % 90 + 1) END AS title0,
    CASE WHEN o_orderkey % 7 <> 0 THEN 1 END AS active0 FROM orders),
ai1 AS (SELECT id, coalesce(level0, 0) AS level, coalesce(active0, 0) AS active, 5 AS type, 100.0 AS score, 30 AS time,
    0 AS sequence, CASE WHEN title0 LIKE 'Test %' THEN title0 ELSE 'Test ' || id END AS title FROM ai0),
ai AS (SELECT *, CASE WHEN {TN('title')} IS NULL OR {TN('title')} = 0 THEN id ELSE {TN('title')} END AS num FROM ai1),
atl0 AS (SELECT id, 'en' AS lang, 'Test ' || (id % 90 + 61) AS text FROM ai WHERE id % 3 = 0
         UNION ALL SELECT id, 'ko', (id % 90 + 61) || ' 번 시험지' FROM ai WHERE id % 3 = 0),
atl AS (SELECT * FROM atl0 UNION ALL
        SELECT a.id, l.lang, CASE l.lang WHEN 'vi' THEN 'Đề thi ' || a.num WHEN 'en' THEN 'Test ' || a.num
               WHEN 'ko' THEN a.num || ' 번 시험지' WHEN 'ja' THEN 'テスト ' || a.num WHEN 'fr' THEN 'Test ' || a.num
               ELSE 'Тест ' || a.num END
        FROM ai a, (SELECT unnest({LANG_LIST}) AS lang) l
        WHERE NOT EXISTS (SELECT 1 FROM atl0 WHERE atl0.id = a.id AND atl0.lang = l.lang)),
apt AS (SELECT id, part_pos, CASE WHEN l_linenumber <> 2 THEN name ELSE 'Part ' || (part_pos + 1) END AS name,
               CASE WHEN l_linenumber <> 3 THEN time ELSE 15 END AS time FROM pt)"""


def _ai(spark, d):
    return E.exam_defaults(fx.fx_exams_ai(spark, d), 0)


@register("E11", f"""WITH {EXAMS_CTE}, {AI_CTE}
SELECT id, CAST(active AS INTEGER) AS active, CAST(type AS INTEGER) AS type, CAST(level AS INTEGER) AS level, score,
       CAST(time AS INTEGER) AS time, CAST(sequence AS INTEGER) AS sequence, title FROM ai""")
def q_e11(spark, d):
    return _ai(spark, d).select("id", "active", "type", "level", "score", "time", "sequence", "title")


@register("E11P", f"""WITH {EXAMS_CTE}, {AI_CTE}
SELECT id, part_pos, name, time FROM apt""")
def q_e11p(spark, d):
    return _ai(spark, d).select("id", F.posexplode("parts").alias("part_pos", "p")).select(
        "id", "part_pos", F.col("p.name").alias("name"), F.col("p.time").alias("time"))


@register("E9", f"""WITH {EXAMS_CTE}, {AI_CTE}
SELECT id, 'title' AS lang, {DEC('title')} AS title FROM ai
UNION ALL SELECT id, lang, {DEC('text')} FROM atl""")
def q_e9(spark, d):
    a = _ai(spark, d)
    t = a.select("id", F.lit("title").alias("lang"), E.decrement_title("title").alias("title"))
    tl = a.select("id", F.explode("title_lang").alias("lang", "v")).select(
        "id", "lang", E.decrement_title("v").alias("title"))
    return t.unionByName(tl)


AI_SKILLS = f"""aid AS (SELECT id, level, {DEC('title')} AS title FROM ai),
atld AS (SELECT id, lang, {DEC('text')} AS text FROM atl),
ask AS (SELECT aid.id AS exam_id, apt.part_pos, aid.level, aid.title, apt.name, apt.time FROM aid JOIN apt ON apt.id = aid.id
        WHERE {TN('aid.title')} IS NOT NULL AND apt.name IN ('Listening', 'Reading', 'Writing'))"""


@register("E12", f"""WITH {EXAMS_CTE}, {AI_CTE}, {AI_SKILLS},
t AS (SELECT *, 'Test ' || {TN('title')} || ' - ' || name AS t0 FROM ask)
SELECT exam_id, part_pos, level, {DEC('t0')} AS title, time FROM t""")
def q_e12(spark, d):
    s = E.ai_skill_split(_ai(spark, d), first_decrement=True)
    return s.select("exam_id", "part_pos", "level", "title", "time")


@register("E12L", f"""WITH {EXAMS_CTE}, {AI_CTE}, {AI_SKILLS},
x AS (SELECT ask.exam_id, ask.part_pos, atld.lang,
        CASE WHEN atld.lang = 'ko' AND {KO('atld.text')} IS NOT NULL
             THEN {TN('atld.text')} || ' 번 시험지 - ' || coalesce(s.suffix, ask.name)
             ELSE atld.text || ' - ' || coalesce(s.suffix, ask.name) END AS t0
      FROM ask JOIN atld ON atld.id = ask.exam_id LEFT JOIN sfx s ON s.skill = ask.name AND s.lang = atld.lang
      WHERE {TN('atld.text')} IS NOT NULL)
SELECT exam_id, part_pos, lang, {DEC('t0')} AS title FROM x""")
def q_e12l(spark, d):
    s = E.ai_skill_split(_ai(spark, d), first_decrement=True)
    return s.select("exam_id", "part_pos", F.explode("title_lang").alias("lang", "title"))


@register("W3", f"""WITH {EXAMS_CTE}, {AI_CTE}, {AI_SKILLS}
SELECT exam_id, part_pos, CAST({E.AI_SKILL_FIRST_ID} + row_number() OVER (ORDER BY exam_id, part_pos) - 1 AS BIGINT) AS new_id
FROM ask""")
def q_w3(spark, d):
    # titles cost CPU, not bytes, so they are spread; written before they are numbered, as the
    # range partitioning samples its input
    s = write_once(E.ai_skill_split(spread(_ai(spark, d), "id"), first_decrement=True), "skills")
    out = sequential_ids(s, ["exam_id", "part_pos"], E.AI_SKILL_FIRST_ID, out="new_id")
    return out.select("exam_id", "part_pos", "new_id")
