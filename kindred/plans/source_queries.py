"""Sources and sinks as jobs: a given table goes through a sink into a folder of
the shared checkpoint location and comes back through the source (S1-S8, S10-S13).
The files are removed when the driver's JVM ends."""

from __future__ import annotations

import uuid

from pyspark.sql import SparkSession
from pyspark.sql import functions as F

from kindred.operators.exams import REGULAR_FIRST_ID, assign_regular_ids, renumber_regular
from kindred.operators.fill import sequential_ids
from kindred.plans import fixtures as fx
from kindred.plans.registry import register
from kindred.session import ensure_checkpoint_dir, read_table
from kindred.sources import io
from kindred.sources.exam_files import write_exam_files


def folder(spark: SparkSession, name: str) -> str:
    path = f"{ensure_checkpoint_dir(spark)}/io-{name}-{uuid.uuid4().hex}"
    hpath = spark.sparkContext._jvm.org.apache.hadoop.fs.Path(path)
    hpath.getFileSystem(spark.sparkContext._jsc.hadoopConfiguration()).deleteOnExit(hpath)
    return path


@register("S1", "SELECT c_custkey AS id, c_name AS name FROM customer")
def q_s1(spark, d):
    # one JSON array file for every hundred customers
    path = folder(spark, "arrays")
    c = read_table(spark, d, "customer").withColumn("part", F.floor(F.col("c_custkey") / 100))
    arrays = c.groupBy("part").agg(F.to_json(F.collect_list(F.struct(F.col("c_custkey").alias("id"), F.col("c_name").alias("name")))).alias("value"))
    arrays.write.partitionBy("part").text(path)
    return io.read_json_array(spark, path, "id long, name string").select("id", "name")


@register("S2", "SELECT doc_id, text, lang FROM documents")
def q_s2(spark, d):
    path = folder(spark, "json")
    io.write_json(read_table(spark, d, "documents").select("doc_id", "text", "lang"), path)
    return spark.read.schema("doc_id long, text string, lang string").json(path)


@register("S3", """SELECT p_brand AS kind, p_partkey AS id, p_name AS similar FROM part WHERE p_partkey % 3 <> 0""")
def q_s3(spark, d):
    # per-kind folders; rows without a match are not written
    path = folder(spark, "kinds")
    p = read_table(spark, d, "part")
    none = F.array().cast("array<string>")
    rows = p.select(F.col("p_brand").alias("kind"), F.col("p_partkey").alias("id"),
                    F.when(F.col("p_partkey") % 3 != 0, F.array("p_name")).otherwise(none).alias("similarities"))
    io.write_per_kind(rows, path)
    back = spark.read.schema("id long, similarities array<string>, kind string").json(path)
    return back.select("kind", "id", F.explode("similarities").alias("similar"))


def _csv(spark, d):
    path = folder(spark, "csv")
    (read_table(spark, d, "documents").select("doc_id", "text", "lang").write.option("header", True)
     .option("quote", '"').option("escape", '"').csv(path))
    return path


@register("S4", "SELECT CAST(doc_id AS VARCHAR) AS doc_id, text, lang FROM documents")
def q_s4(spark, d):
    return io.read_csv_text(spark, _csv(spark, d))


@register("S4J", "SELECT CAST(doc_id AS VARCHAR) AS doc_id, text, lang FROM documents")
def q_s4j(spark, d):
    path = folder(spark, "csv-json")
    io.csv_to_json(spark, _csv(spark, d), path)
    return spark.read.schema("doc_id string, text string, lang string").json(path)


# Exams of ``orders`` as files: level = id % 6 + 1, test = id % 90 + 1, items by id.
FILES_SQL = """f AS (SELECT o_orderkey AS id, CAST(o_orderkey % 6 + 1 AS INTEGER) AS level, CAST(o_orderkey % 90 + 1 AS INTEGER) AS test,
  CAST(row_number() OVER (PARTITION BY o_orderkey % 6, o_orderkey % 90 ORDER BY o_orderkey) - 1 AS INTEGER) AS pos,
  'Level_' || (o_orderkey % 6 + 1) || '_Test_' || (o_orderkey % 90 + 1) || '.json' AS file_name FROM orders)"""


def _exam_folder(spark, d, name=None, ext: str = ".json"):
    path = folder(spark, "exams")
    ex = fx.fx_exams(spark, d)
    if name is None:
        name = F.concat(F.lit("Level_"), F.col("level").cast("string"), F.lit("_Test_"), F.col("test").cast("string"), F.lit(ext))
    item = F.to_json(F.struct("id", "level", "title", "title_lang", "parts"))
    write_exam_files(ex.select(name.alias("file_name"), "pos", item.alias("item")), path)
    return path


@register("S5", f"""WITH {FILES_SQL} SELECT file_name, CAST(level AS BIGINT) AS number,
  CAST(row_number() OVER (ORDER BY level, file_name) AS BIGINT) AS place FROM (SELECT DISTINCT file_name, level FROM f)""")
def q_s5(spark, d):
    files = io.list_files(spark, _exam_folder(spark, d))
    return sequential_ids(files, ["number", "file_name"], 1, out="place")


@register("S6", f"""WITH {FILES_SQL} SELECT DISTINCT replace(file_name, '.json', '.exam') AS file_name, CAST(level AS BIGINT) AS number FROM f""")
def q_s6(spark, d):
    # two extensions in one folder: only the asked one is listed
    path = _exam_folder(spark, d, ext=".exam")
    write_exam_files(spark.range(3).select(F.concat(F.lit("note_"), F.col("id"), F.lit(".json")).alias("file_name"),
                                           F.lit(0).alias("pos"), F.lit("{}").alias("item")), path)
    return io.list_files(spark, path, ".exam")


EXAM_ITEM = "id long, level int, title string, title_lang map<string,string>, parts array<struct<name:string,time:int>>"


@register("S7", f"WITH {FILES_SQL} SELECT file_name, level AS file_level, test AS file_test, pos, id FROM f")
def q_s7(spark, d):
    return io.read_exam_files(spark, _exam_folder(spark, d), EXAM_ITEM).select("file_name", "file_level", "file_test", "pos", "id")


@register("S7J", f"""WITH {FILES_SQL} SELECT id, CAST({REGULAR_FIRST_ID} + row_number() OVER (ORDER BY level, test, pos) - 1 AS BIGINT) AS new_id,
  'Test ' || (id % 90 + 1 + CASE WHEN level <= 2 THEN 40 ELSE 15 END) AS title FROM f""")
def q_s7j(spark, d):
    # the regular-exam job from files: read in (level, test, item) order, renumber, assign ids
    items = io.read_exam_files(spark, _exam_folder(spark, d), EXAM_ITEM).drop("level").withColumnsRenamed(
        {"file_level": "level", "file_test": "test"})
    return assign_regular_ids(renumber_regular(items)).select("id", "new_id", "title")


AI_NAMES = "CASE WHEN o_orderkey % 4 = 0 THEN 'extra_' || (o_orderkey % 9) ELSE 'AI_LEVEL_' || (o_orderkey % 6 + 1) || '_set' || (o_orderkey % 5) END"


@register("S8", f"""SELECT file_name, CASE WHEN file_name LIKE 'AI%' THEN CAST(regexp_extract(file_name, 'LEVEL_([0-9]+)', 1) AS INTEGER) ELSE 0 END AS file_level,
  CAST(row_number() OVER (PARTITION BY file_name ORDER BY id) - 1 AS INTEGER) AS pos, id
FROM (SELECT o_orderkey AS id, {AI_NAMES} || '.json' AS file_name FROM orders)""")
def q_s8(spark, d):
    k = F.col("id")
    name = F.when(k % 4 == 0, F.concat(F.lit("extra_"), k % 9)).otherwise(
        F.concat(F.lit("AI_LEVEL_"), k % 6 + 1, F.lit("_set"), k % 5))
    files = io.read_ai_exam_files(spark, _exam_folder(spark, d, F.concat(name, F.lit(".json"))), EXAM_ITEM)
    return files.select("file_name", "file_level", "pos", "id")


REPORT = "SELECT p_brand AS {sheet}, p_partkey AS id, p_name AS value FROM part"


def _report(spark, d, path):
    rows = read_table(spark, d, "part").select(
        F.col("p_brand").alias("kind"), F.col("p_partkey").alias("id"), F.col("p_name").alias("value"))
    io.report_sink(rows.filter("id % 2 = 0"), path)
    io.report_sink(rows.filter("id % 2 = 1"), path, mode="append")


@register("S10", REPORT.format(sheet="kind"))
def q_s10(spark, d):
    # The second half of the report is appended
    path = folder(spark, "report")
    _report(spark, d, path)
    return spark.read.schema("id long, value string, kind string").parquet(path).select("kind", "id", "value")


@register("S12", REPORT.format(sheet="sheet"))
def q_s12(spark, d):
    path = folder(spark, "sheets")
    _report(spark, d, path)
    return io.read_sheets(spark, path).select("sheet", "id", "value")


@register("S13", "SELECT doc_id AS id FROM documents")
def q_s13(spark, d):
    # lines of up to a hundred comma-separated ids
    path = folder(spark, "ids")
    docs = read_table(spark, d, "documents").withColumn("line", F.floor(F.col("doc_id") / 100))
    docs.groupBy("line").agg(F.array_join(F.collect_list(F.col("doc_id").cast("string")), ",").alias("value")).select("value").write.text(path)
    return io.read_id_list(spark, path)
