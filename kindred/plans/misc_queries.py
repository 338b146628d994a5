"""Registered queries for translations, nested JSON parsing and validation
(E7, E8, E10, S9, T17, T18)."""

from __future__ import annotations

from pyspark.sql import functions as F

from kindred.operators import exams as E
from kindred.operators.validate import error_counts, flatten_json_list, validation_report
from kindred.plans import fixtures as fx
from kindred.plans import oracle as O
from kindred.plans.registry import ORACLE, register

FILL = "('ko', 'ja', 'fr', 'ru')"


@register("E7", f"""WITH c AS (SELECT conv_id * 1000 + turn AS id, role, turn, text FROM conversations),
ent AS (SELECT id, 'en' AS lang, text FROM c WHERE role = 'user'
        UNION ALL SELECT id, 'vi', text FROM c WHERE role <> 'system'
        UNION ALL SELECT id, 'ko', '' FROM c WHERE turn % 3 = 0
        UNION ALL SELECT id, 'fr', 'fr:' || text FROM c WHERE role = 'system'),
tm AS (SELECT c.id,
         CASE WHEN max(CASE WHEN ent.lang = 'en' THEN ent.text END) <> '' THEN max(CASE WHEN ent.lang = 'en' THEN ent.text END)
              WHEN max(CASE WHEN ent.lang = 'vi' THEN ent.text END) <> ''
              THEN '[Translated from vi] ' || max(CASE WHEN ent.lang = 'vi' THEN ent.text END)
         END AS tmpl
       FROM c LEFT JOIN ent USING (id) GROUP BY c.id),
kept AS (SELECT ent.id, lang, text FROM ent JOIN tm USING (id)
         WHERE NOT (lang IN {FILL} AND text = '' AND tmpl IS NOT NULL)),
added AS (SELECT tm.id, l.lang, tm.tmpl AS text FROM tm, (SELECT unnest(['ko', 'ja', 'fr', 'ru']) AS lang) l
          WHERE tm.tmpl IS NOT NULL AND NOT EXISTS (SELECT 1 FROM kept WHERE kept.id = tm.id AND kept.lang = l.lang))
SELECT id, lang, text FROM kept UNION ALL SELECT id, lang, text FROM added""")
def q_e7(spark, d):
    t = fx.fx_translations(spark, d)
    return t.select("id", F.explode(E.fill_translations("translate")).alias("lang", "text"))


E8_SQL = f"""WITH tr AS ({ORACLE['E7']}),
base AS (SELECT DISTINCT id FROM ({{ids}})),
q AS (SELECT id, id // 1000 AS conv, row_number() OVER (PARTITION BY id // 1000 ORDER BY id) - 1 AS qpos FROM base)
SELECT q.conv AS id, CAST(q.qpos AS INTEGER) AS qpos, f.field, tr.lang, tr.text
FROM q JOIN tr ON tr.id = q.id, (SELECT unnest(['text', 'audio', 'explain']) AS field) f"""


@register("E8", E8_SQL.format(ids="SELECT conv_id * 1000 + turn AS id FROM conversations"))
def q_e8(spark, d):
    # translations inside parts -> content -> Questions -> general / content.explain, questions in turn order
    t = fx.fx_translations(spark, d).withColumn("conv", (F.col("id") / 1000).cast("long"))
    q = F.struct("id", F.struct(F.struct(F.col("translate").alias("G_text_translate"),
                                         F.col("translate").alias("G_text_audio_translate")).alias("general"),
                                F.array(F.struct(F.col("translate").alias("explain"))).alias("content")).alias("q"))
    per = t.groupBy("conv").agg(F.transform(F.array_sort(F.collect_list(q), lambda a, b: F.when(
        a["id"] < b["id"], -1).when(a["id"] > b["id"], 1).otherwise(0)), lambda x: x["q"]).alias("Questions"))
    exams = per.select(F.col("conv").alias("id"),
                       F.array(F.struct(F.array(F.struct("Questions")).alias("content"))).alias("parts"))
    filled = exams.select("id", E.fill_exam_translations("parts").alias("parts"))
    qs = filled.select("id", F.explode("parts").alias("p")).select("id", F.explode("p.content").alias("g")).select(
        "id", F.posexplode("g.Questions").alias("qpos", "q"))
    fields = F.create_map(F.lit("text"), F.col("q.general.G_text_translate"), F.lit("audio"), F.col("q.general.G_text_audio_translate"),
                          F.lit("explain"), F.get("q.content", 0)["explain"])
    return qs.select("id", "qpos", F.explode(fields).alias("field", "t")).select(
        "id", "qpos", "field", F.explode("t").alias("lang", "text"))


# groups of an exam: part i (from 0) is the number i + 1, or for odd i the list [i + 1, time]; every 13th text is cut
GROUPS_SQL = """WITH pt AS (SELECT l_orderkey AS id, CAST(l_quantity AS INTEGER) AS time,
    row_number() OVER (PARTITION BY l_orderkey ORDER BY l_linenumber, l_partkey, l_suppkey, l_extendedprice) - 1 AS i
  FROM lineitem WHERE l_orderkey IN (SELECT o_orderkey FROM orders)),
it AS (SELECT id, i, 0 AS j, CAST(i + 1 AS VARCHAR) AS item FROM pt
       UNION ALL SELECT id, i, 1, CAST(time AS VARCHAR) FROM pt WHERE i % 2 = 1)
SELECT id, CAST(row_number() OVER (PARTITION BY id ORDER BY i, j) - 1 AS INTEGER) AS pos, item FROM it WHERE id % 13 <> 0"""


@register("E10", GROUPS_SQL)
def q_e10(spark, d):
    j = fx.fx_exam_json(spark, d)
    return j.select("id", F.posexplode(E.flatten_groups_json("groups")).alias("pos", "item"))


@register("S9", """WITH pt AS (SELECT l_orderkey AS id, CAST(l_quantity AS INTEGER) AS time,
    row_number() OVER (PARTITION BY l_orderkey ORDER BY l_linenumber, l_partkey, l_suppkey, l_extendedprice) - 1 AS i FROM lineitem),
g AS (SELECT id, count(*) AS n, string_agg(CASE WHEN i % 2 = 1 THEN '[' || (i + 1) || ',' || time || ']' ELSE CAST(i + 1 AS VARCHAR) END,
                                           ',' ORDER BY i) AS txt FROM pt GROUP BY id)
SELECT o_orderkey AS id, CAST(coalesce(n, 0) AS INTEGER) AS n_parts, 6 AS n_langs,
       CASE WHEN o_orderkey % 13 = 0 THEN '[]' ELSE '[' || coalesce(txt, '') || ']' END AS groups
FROM orders LEFT JOIN g ON g.id = o_orderkey WHERE o_orderkey % 11 <> 0""")
def q_s9(spark, d):
    j = fx.fx_exam_json(spark, d)
    parsed = E.parse_exam_json(j, "array<struct<name:string,time:int>>")
    return parsed.select("id", F.size("parts").alias("n_parts"), F.size("title_lang").alias("n_langs"), "groups")


@register("T17", """WITH r AS (SELECT DISTINCT conv_id FROM conversations),
e AS (SELECT CASE conv_id % 6
    WHEN 1 THEN 'Field ''id'' expected <class ''int''>, got <class ''str''>'
    WHEN 2 THEN 'Missing field: kind'
    WHEN 3 THEN 'Field ''general'' expected a nested object, got <class ''list''>'
    WHEN 4 THEN 'Missing field: ru'
    WHEN 5 THEN 'Items in field ''scores'' expected <class ''float''>, got <class ''str''>' END AS first_error FROM r)
SELECT first_error, count(*) AS n FROM e WHERE first_error IS NOT NULL GROUP BY first_error""")
def q_t17(spark, d):
    # question records with a different field broken by id
    q = fx.fx_questions(spark, d)
    k = F.col("id") % 6
    lang = F.concat(F.lit('{"vi":"","en":"","ko":"","fr":"","ja":""'), F.when(k == 4, F.lit("}")).otherwise(F.lit(',"ru":""}')))
    general = F.concat(F.lit('{"G_text":'), F.to_json("general.G_text"), F.lit(',"G_text_translate":'), lang,
                       F.lit(',"G_text_audio":"","G_text_audio_translate":'), lang, F.lit(',"G_audio":[],"G_image":[]}'))
    rec = F.concat(
        F.lit('{"id":'), F.when(k == 1, F.concat(F.lit('"'), F.col("id"), F.lit('"'))).otherwise(F.col("id").cast("string")),
        F.when(k == 2, F.lit("")).otherwise(F.lit(',"kind":"conversation"')),
        F.lit(',"general":'), F.when(k == 3, F.to_json("general.G_text")).otherwise(general),
        F.lit(',"content":'), F.to_json("content"), F.lit(',"scores":'), F.when(k == 5, F.lit('["a"]')).otherwise(F.lit("[1.5]")), F.lit("}"))
    return error_counts(validation_report(q.select("id", rec.alias("record")), "record", "id"))


@register("T18", GROUPS_SQL)
def q_t18(spark, d):
    j = fx.fx_exam_json(spark, d)
    return j.select("id", F.posexplode(flatten_json_list(F.col("groups"))).alias("pos", "item"))


@register("F4", """WITH d AS (SELECT p_partkey AS id, p_brand AS kind,
                         lower(regexp_replace(p_name, '[^a-zA-Z0-9]', '', 'g')) AS value FROM part),
p AS (SELECT a.kind, a.id, b.id AS sim_id, a.value AS s1, b.value AS s2 FROM d a JOIN d b
      ON a.kind = b.kind AND a.id < b.id
      WHERE length(a.value) > 0 AND least(length(a.value), length(b.value)) / greatest(length(a.value), length(b.value)) >= 0.9)
SELECT kind, id, sim_id, CAST(levenshtein(s1, s2) AS INTEGER) AS distance,
       (greatest(length(s1), length(s2)) - levenshtein(s1, s2)) / greatest(length(s1), length(s2)) AS similarity,
       CAST(round_even((greatest(length(s1), length(s2)) - levenshtein(s1, s2)) / greatest(length(s1), length(s2)) * 100, 2)
            AS VARCHAR) || '%' AS percentage
FROM p""")
def q_f4(spark, d):
    # F1-F4 on the length-compatible pairs of part names: distance, similarity, percent text
    from kindred.operators.simjoin import detailed_pairs
    return detailed_pairs(fx.fx_short(spark, d), 90.0)


@register("P8", """WITH s AS (SELECT conv_id, row_number() OVER (PARTITION BY conv_id ORDER BY turn) - 1 AS pos, text
                  FROM conversations WHERE role = 'system')
SELECT conv_id AS id, CAST(pos AS INTEGER) AS pos,
       trim(regexp_replace(lower(regexp_replace(text, '[-&;''"<>]', ' ', 'g')), '\\s+', ' ', 'g')) AS clean FROM s""")
def q_p8(spark, d):
    from kindred.functions.text import clean_a_array
    q = fx.fx_questions(spark, d)
    return q.select("id", F.posexplode(clean_a_array(F.col("general.G_text"))).alias("pos", "clean"))


@register("O2", """WITH ai AS (SELECT o_orderkey AS id,
    CASE WHEN o_orderkey % 4 <> 0 THEN 'Test ' || (o_orderkey % 90 + 61) ELSE 'Exam ' || (o_orderkey % 90 + 1) END AS title
  FROM orders),
k AS (SELECT id, coalesce(TRY_CAST(nullif(regexp_extract(trim(title), '(\\d+)$', 1), '') AS BIGINT),
                          TRY_CAST(nullif(regexp_extract(trim(title), '^(\\d+)\\s+번', 1), '') AS BIGINT)) AS num FROM ai)
SELECT id, CASE WHEN num IS NULL OR num = 0 THEN 0 ELSE num END AS sort_key,
       CAST(row_number() OVER (ORDER BY CASE WHEN num IS NULL OR num = 0 THEN 0 ELSE num END, id) AS BIGINT) AS sort_rank
FROM k""")
def q_o2(spark, d):
    # exams ordered by the number in their raw title (none -> 0), stable by id
    from kindred.operators.fill import sequential_ids
    ex = fx.fx_exams_ai(spark, d)
    n = E.title_number("title")
    keyed = ex.select("id", F.when(n.isNull() | (n == 0), F.lit(0)).otherwise(n).cast("long").alias("sort_key"))
    out = sequential_ids(keyed, ["sort_key", "id"], 1, out="sort_rank")
    return out.select("id", "sort_key", "sort_rank")
