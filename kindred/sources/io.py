"""Sources and sinks (S1-S13): JSON arrays, CSV, ordered file listings, ID
lists, partitioned report sinks.  Schemas are explicit; nothing is inferred."""

from __future__ import annotations

from collections.abc import Sequence

from pyspark.sql import DataFrame, SparkSession
from pyspark.sql import functions as F
from pyspark.sql.types import StructType

from kindred.sources.exam_files import read_named_files


def read_json_array(spark: SparkSession, path: str, schema: StructType | str) -> DataFrame:
    """A file holding one JSON array (or one object) of records."""
    return spark.read.schema(schema).option("multiLine", True).json(path)


def write_json(df: DataFrame, path: str, mode: str = "overwrite") -> None:
    """UTF-8 JSON lines, non-ASCII kept as is."""
    df.write.mode(mode).option("ignoreNullFields", False).json(path)


def write_per_kind(df: DataFrame, path: str, match_col: str = "similarities", mode: str = "overwrite") -> None:
    """S3: one output folder per kind; rows without matches are dropped."""
    df.filter(F.size(F.col(match_col)) > 0).write.mode(mode).partitionBy("kind").json(path)


def read_csv_text(spark: SparkSession, path: str) -> DataFrame:
    """Header CSV, every field a string, quoted multi-line fields of any
    length, UTF-8 with or without BOM."""
    df = (spark.read.option("header", True).option("inferSchema", False).option("multiLine", True)
          .option("quote", '"').option("escape", '"').option("maxCharsPerColumn", -1)
          .option("encoding", "UTF-8").csv(path))
    first = df.columns[0] if df.columns else None
    if first is not None and first.startswith("﻿"):
        df = df.withColumnRenamed(first, first.lstrip("﻿"))
    return df


def csv_to_json(spark: SparkSession, csv_path: str, json_path: str) -> DataFrame:
    """S4 as a job: a header CSV rewritten as JSON lines; returns the rows."""
    df = read_csv_text(spark, csv_path)
    write_json(df, json_path)
    return df


def list_files(spark: SparkSession, directory: str, ext: str = ".json") -> DataFrame:
    """Files of a folder with the extension, ordered by the first number
    in the name (0 when none).  Returns ``(file_name, number)``; the listing is
    a distributed scan of file metadata, not a driver loop."""
    df = (spark.read.format("binaryFile").option("pathGlobFilter", "*" + ext)
          .option("recursiveFileLookup", False).load(directory).select("path"))
    name = F.regexp_extract("path", r"([^/]+)$", 1)
    num = F.coalesce(F.regexp_extract(name, r"(\d+)", 1).try_cast("long"), F.lit(0))
    return df.select(name.alias("file_name"), num.alias("number")).orderBy("number", "file_name")


def exam_file_keys(name_col: str = "file_name") -> dict:
    """``Level_(l)_Test_(t).json`` -> level, test (null when not matching)."""
    pat = r"^Level_(\d+)_Test_(\d+)\.json$"
    n = F.col(name_col)
    ok = n.rlike(pat)
    return {"level": F.when(ok, F.regexp_extract(n, pat, 1).cast("int")),
            "test": F.when(ok, F.regexp_extract(n, pat, 2).cast("int"))}


def ai_exam_level(name_col: str = "file_name"):
    """Level from ``level_(n)`` in the lower-cased name, else 0."""
    low = F.lower(F.col(name_col))
    return F.coalesce(F.regexp_extract(low, r"level_(\d+)", 1).try_cast("int"), F.lit(0))


def _items(spark: SparkSession, directory: str, schema: StructType | str) -> DataFrame:
    """Items of the JSON files of a folder as ``schema``, with ``file_name`` and their
    position ``pos`` in the file; an item that is no record is dropped."""
    record = StructType.fromDDL(schema) if isinstance(schema, str) else schema
    files = read_named_files(spark, directory)
    return (files.withColumn("_r", F.from_json("item", record)).filter(F.col("item").startswith("{"))
            .select("_r.*", "file_name", "pos"))


def read_exam_files(spark: SparkSession, directory: str, schema: StructType | str) -> DataFrame:
    """Every exam file of a folder with its level and test from the name and
    the item order in the file as ``pos``; files with other names are left out."""
    keys = exam_file_keys()
    return _items(spark, directory, schema).withColumns({"file_level": keys["level"], "file_test": keys["test"]}).filter(
        F.col("file_level").isNotNull())


def read_ai_exam_files(spark: SparkSession, directory: str, schema: StructType | str) -> DataFrame:
    """Every ``.json`` file of a folder, its level from the name (else 0) and
    the item order in the file as ``pos``."""
    return _items(spark, directory, schema).withColumn("file_level", ai_exam_level())


def write_sheets(frames: dict[str, DataFrame], path: str) -> None:
    """S10 for sheets with columns of their own: one folder ``sheet=<name>`` each."""
    for name, df in frames.items():
        df.write.mode("overwrite").parquet(f"{path}/sheet={name}")


def read_sheet_frames(spark: SparkSession, path: str) -> dict[str, DataFrame]:
    """S12 for such a folder: every sheet by its name, with its own columns."""
    hpath = spark.sparkContext._jvm.org.apache.hadoop.fs.Path(path)
    found = hpath.getFileSystem(spark.sparkContext._jsc.hadoopConfiguration()).listStatus(hpath)
    names = sorted(f.getPath().getName() for f in found)
    return {n.removeprefix("sheet="): spark.read.parquet(f"{path}/{n}") for n in names if n.startswith("sheet=")}


def report_sink(df: DataFrame, path: str, fmt: str = "parquet", mode: str = "overwrite",
                sheet_col: str = "kind") -> None:
    """The long report table partitioned by sheet (kind); ``append``
    adds sheets."""
    df.write.mode(mode).partitionBy(sheet_col).format(fmt).save(path)


def read_sheets(spark: SparkSession, path: str, fmt: str = "parquet", sheet_col: str = "kind") -> DataFrame:
    """Every sheet of a partitioned report, with its sheet column."""
    return spark.read.format(fmt).load(path).withColumnRenamed(sheet_col, "sheet")


def read_id_list(spark: SparkSession, path: str) -> DataFrame:
    """ID list files - comma separated lines or JSON integer arrays - as ``id``."""
    lines = spark.read.text(path)
    tokens = F.explode(F.split(F.regexp_replace(F.col("value"), r"[\[\]\s]", ""), ","))
    return lines.select(tokens.alias("t")).filter(F.col("t") != "").select(F.col("t").cast("long").alias("id"))


def union_inputs(frames: Sequence[DataFrame]) -> DataFrame:
    """O3: concatenate inputs with the same columns, duplicates kept."""
    out = frames[0]
    for f in frames[1:]:
        out = out.unionByName(f)
    return out
