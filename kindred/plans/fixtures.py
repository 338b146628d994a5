"""Adapters from the driver's test tables to the shapes the operators consume.

Each adapter is a plain projection over a whole table (no row subsets); the
same expressions appear in the oracle SQL of :mod:`kindred.plans.registry`.
"""

from __future__ import annotations

from pyspark.sql import DataFrame, SparkSession
from pyspark.sql import functions as F

from kindred.functions.text import alnum_lower, ascii_alnum_lower
from kindred.session import read_table


def fx_docs(spark: SparkSession, sf_dir: str) -> DataFrame:
    """Compare rows from ``documents``: block = (lang, source), whole text in the
    reference's form (P3: all Unicode letters and digits, lower-cased)."""
    d = read_table(spark, sf_dir, "documents")
    return d.select(F.col("doc_id").alias("id"),
                    F.concat(F.col("lang"), F.lit("_"), F.col("source")).alias("kind"),
                    (F.col("doc_id") % 5).cast("int").alias("check_admin"),
                    alnum_lower(F.col("text")).alias("value"),
                    F.col("text").alias("value_original"))


def fx_short(spark: SparkSession, sf_dir: str) -> DataFrame:
    """Short names from ``part`` with many exact copies (hot buckets)."""
    p = read_table(spark, sf_dir, "part")
    return p.select(F.col("p_partkey").alias("id"), F.col("p_brand").alias("kind"),
                    ascii_alnum_lower(F.col("p_name")).alias("value"),
                    (F.col("p_partkey") % 5).cast("int").alias("check_admin"))


def fx_reviewed(spark: SparkSession, sf_dir: str) -> DataFrame:
    """Reviewed report rows with gaps, built from ``events``: ``pos`` is the file
    order, ``id``/``kind``/``value``/``check_admin`` are present only on some
    rows (empty text and zeros included) and ``sim_id`` ("similar to id") links
    the row to another user id."""
    e = read_table(spark, sf_dir, "events")
    eid = F.col("event_id")
    return e.select(
        eid.alias("pos"),
        F.when(eid % 3 == 1, F.col("user_id")).alias("id"),
        F.when(eid % 4 == 0, F.col("value").cast("string")).when(eid % 4 == 1, F.lit("")).alias("value"),
        F.when(eid % 3 == 0, F.col("event_type")).alias("kind"),
        F.when(eid % 2 == 0, (eid % 5).cast("int")).alias("check_admin"),
        F.when(eid % 3 == 2, F.col("user_id")).alias("sim_id"))


def fx_chains(spark: SparkSession, sf_dir: str) -> DataFrame:
    """Edges ``c -> c + 1`` over all customers, kind = block of 100 keys: one
    chain of 101 ids per kind (many star rounds)."""
    c = read_table(spark, sf_dir, "customer")
    return c.select(F.floor((F.col("c_custkey") - 1) / 100).cast("long").alias("kind"),
                    F.col("c_custkey").alias("src"), (F.col("c_custkey") + 1).alias("dst"))


def fx_blueprint(spark: SparkSession, sf_dir: str) -> DataFrame:
    """Exam blueprint rows from ``part``: level, section, kind, score, counts."""
    p = read_table(spark, sf_dir, "part")
    return p.select(((F.col("p_size") % 7) + 1).cast("int").alias("level"), F.col("p_type").alias("section"),
                    F.col("p_brand").alias("kind"), F.col("p_retailprice").alias("score"),
                    (F.col("p_size") % 5 + 1).cast("long").alias("count_question"),
                    F.array((F.col("p_size") % 3).cast("long"), (F.col("p_partkey") % 4).cast("long")).alias("sub_count_question"),
                    F.col("p_size").cast("long").alias("time"))


def fx_sheets(spark: SparkSession, sf_dir: str) -> dict[str, DataFrame]:
    """Review-workbook sheets from five tables; every 7th value is blank."""
    def blank(df: DataFrame, pos: str) -> DataFrame:
        # the row position survives in ``_pos``; every column value is blanked
        return df.select(*[F.when(F.col(pos) % 7 == 0, F.lit(None)).otherwise(F.col(c)).alias(c)
                           for c in df.columns], F.col(pos).alias("_pos"))
    ev = read_table(spark, sf_dir, "events").select("event_id", "user_id", "event_type")
    docs = read_table(spark, sf_dir, "documents").select("doc_id", "lang", "source")
    emb = read_table(spark, sf_dir, "embeddings").select("vec_id", "label")
    reg = read_table(spark, sf_dir, "region")
    part = read_table(spark, sf_dir, "part").select("p_partkey", "p_name", "p_brand")
    return {"events": ev, "documents": docs, "embeddings": emb, "region": reg, "part": part,
            "_blank": blank}


def fx_questions(spark: SparkSession, sf_dir: str) -> DataFrame:
    """Nested questions from ``conversations``: system turns are the general
    text, each user turn is a content item answered by the next turn when that
    turn is the assistant's.  Arrays are built per conversation (bounded)."""
    from pyspark.sql import Window
    c = read_table(spark, sf_dir, "conversations")
    w = Window.partitionBy("conv_id").orderBy("turn")
    c = c.select("conv_id", "turn", "role", "text", F.lead("role").over(w).alias("nrole"),
                 F.lead("text").over(w).alias("ntext"))
    item = F.struct(F.col("turn"), F.col("text").alias("Q_text"),
                    F.when(F.col("nrole") == "assistant", F.array(F.col("ntext")))
                    .otherwise(F.array().cast("array<string>")).alias("A_text"))
    g = c.groupBy("conv_id").agg(
        F.array_sort(F.collect_list(F.when(F.col("role") == "system", F.struct("turn", "text")))).alias("_sys"),
        F.array_sort(F.collect_list(F.when(F.col("role") == "user", item))).alias("_items"))
    general = F.struct(F.transform("_sys", lambda x: x["text"]).alias("G_text"), F.lit("").alias("G_text_audio"))
    content = F.transform("_items", lambda x: F.struct(x["Q_text"].alias("Q_text"), x["A_text"].alias("A_text")))
    return g.select(F.col("conv_id").alias("id"), general.alias("general"), content.alias("content"))


SKILL_BY_LINE = ["Listening", "Reading", "Writing", "Translation"]   # by l_linenumber % 4


def _exam_parts(spark: SparkSession, sf_dir: str) -> DataFrame:
    from pyspark.sql import Window
    li = read_table(spark, sf_dir, "lineitem")
    w = Window.partitionBy("l_orderkey").orderBy("l_linenumber", "l_partkey", "l_suppkey", "l_extendedprice")
    name = F.element_at(F.array(*[F.lit(x) for x in SKILL_BY_LINE]), (F.col("l_linenumber") % 4 + 1).cast("int"))
    rows = li.select("l_orderkey", F.row_number().over(w).alias("rn"), name.alias("name"),
                     F.col("l_quantity").cast("int").alias("time"), "l_linenumber", "l_partkey", "l_suppkey")
    return rows


def fx_exams(spark: SparkSession, sf_dir: str) -> DataFrame:
    """Exams from ``orders`` with their ``lineitem`` rows as parts (at most seven
    per order, so the per-order arrays are bounded)."""
    rows = _exam_parts(spark, sf_dir)
    parts = rows.groupBy("l_orderkey").agg(F.array_sort(F.collect_list(F.struct("rn", "name", "time"))).alias("_p"))
    o = read_table(spark, sf_dir, "orders").select("o_orderkey")
    n = (F.col("o_orderkey") % 90 + 1).cast("string")
    tl = F.create_map(F.lit("vi"), F.concat(F.lit("Đề thi "), n), F.lit("en"), F.concat(F.lit("Test "), n),
                      F.lit("ko"), F.concat(n, F.lit(" 번 시험지")), F.lit("ja"), F.concat(F.lit("テスト "), n),
                      F.lit("fr"), F.concat(F.lit("Test "), n), F.lit("ru"), F.concat(F.lit("Тест "), n))
    j = o.join(parts, o.o_orderkey == parts.l_orderkey, "left")
    return j.select(F.col("o_orderkey").alias("id"), ((F.col("o_orderkey") % 6) + 1).cast("int").alias("level"),
                    F.concat(F.lit("Test "), n).alias("title"), tl.alias("title_lang"),
                    F.coalesce(F.transform("_p", lambda x: F.struct(x["name"].alias("name"), x["time"].alias("time"))),
                               F.array().cast("array<struct<name:string,time:int>>")).alias("parts"),
                    (F.col("o_orderkey") % 90 + 1).cast("long").alias("test"), F.col("o_orderkey").alias("pos"))


def fx_exams_ai(spark: SparkSession, sf_dir: str) -> DataFrame:
    """AI exams: fields partly missing, titles partly not ``Test n``, parts
    with missing time/name, only some languages present."""
    rows = _exam_parts(spark, sf_dir)
    part = F.struct(F.col("rn"), F.when(F.col("l_linenumber") != 2, F.col("name")).alias("name"),
                    F.when(F.col("l_linenumber") != 3, F.col("time")).alias("time"))
    parts = rows.groupBy("l_orderkey").agg(F.array_sort(F.collect_list(part)).alias("_p"))
    o = read_table(spark, sf_dir, "orders").select("o_orderkey")
    k = F.col("o_orderkey")
    n = (k % 90 + 1).cast("string")
    title = F.when(k % 4 != 0, F.concat(F.lit("Test "), (k % 90 + 61).cast("string"))).otherwise(
        F.concat(F.lit("Exam "), n))
    tl = F.when(k % 3 == 0, F.create_map(F.lit("en"), F.concat(F.lit("Test "), (k % 90 + 61).cast("string")),
                                         F.lit("ko"), F.concat((k % 90 + 61).cast("string"), F.lit(" 번 시험지"))))
    j = o.join(parts, o.o_orderkey == parts.l_orderkey, "left")
    return j.select(
        k.alias("id"), F.when(k % 5 != 0, ((k % 6) + 1).cast("int")).alias("level"), title.alias("title"),
        tl.alias("title_lang"),
        F.coalesce(F.transform("_p", lambda x: F.struct(x["name"].alias("name"), x["time"].alias("time"))),
                   F.array().cast("array<struct<name:string,time:int>>")).alias("parts"),
        F.when(k % 7 != 0, F.lit(1)).alias("active"), F.lit(None).cast("int").alias("type"),
        F.lit(None).cast("double").alias("score"), F.lit(None).cast("int").alias("time"),
        F.lit(None).cast("int").alias("sequence"), k.alias("pos"))


def fx_translations(spark: SparkSession, sf_dir: str) -> DataFrame:
    """Translation maps from ``conversations``: ``en`` on user turns, ``vi`` on
    every non-system turn, an empty ``ko`` on every third turn, ``fr`` on system turns."""
    c = read_table(spark, sf_dir, "conversations")
    ent = F.array(
        F.struct(F.lit("en").alias("k"), F.when(F.col("role") == "user", F.col("text")).alias("v")),
        F.struct(F.lit("vi").alias("k"), F.when(F.col("role") != "system", F.col("text")).alias("v")),
        F.struct(F.lit("ko").alias("k"), F.when(F.col("turn") % 3 == 0, F.lit("")).alias("v")),
        F.struct(F.lit("fr").alias("k"), F.when(F.col("role") == "system", F.concat(F.lit("fr:"), F.col("text")))
                 .alias("v")))
    m = F.map_from_entries(F.filter(ent, lambda e: e["v"].isNotNull()))
    return c.select((F.col("conv_id") * 1000 + F.col("turn")).alias("id"), m.alias("translate"))


def fx_exam_json(spark: SparkSession, sf_dir: str) -> DataFrame:
    """AI exams as delivered: ``parts``/``groups``/``title_lang`` as JSON text;
    every 11th order has its ``parts`` text cut short (invalid), every 13th its
    ``groups``; ``groups`` is ragged (lines with an even number are nested)."""
    ex = fx_exams(spark, sf_dir)
    k = F.col("id")
    parts_txt = F.to_json("parts")
    parts_txt = F.when(k % 11 == 0, F.expr("substring(to_json(parts), 1, greatest(length(to_json(parts)) - 2, 1))")
                       ).otherwise(parts_txt)
    groups = F.concat(F.lit("["), F.array_join(F.transform("parts", lambda p, i: F.when(
        i % 2 == 1, F.concat(F.lit("["), (i + 1).cast("string"), F.lit(","), p["time"].cast("string"), F.lit("]")))
        .otherwise((i + 1).cast("string"))), ","), F.lit("]"))
    groups = F.when(k % 13 == 0, F.lit("[1, [2")).otherwise(groups)
    return ex.select("id", "level", "title", parts_txt.alias("parts"), groups.alias("groups"),
                     F.to_json("title_lang").alias("title_lang"))
