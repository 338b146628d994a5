import pytest
from pyspark.sql import functions as F

from kindred.operators import exams as E


def col1(spark, expr, value):
    return spark.createDataFrame([(value,)], "t string").select(expr(F.col("t")).alias("r")).first().r


@pytest.mark.parametrize("title,n", [("Test 1", 1), ("Đề thi 45", 45), ("45 번 시험지", 45), ("テスト 45", 45),
                                     ("Тест 65", 65), ("No number", None), ("", None), (" Test 7 ", 7)])
def test_title_number(spark, title, n):
    assert col1(spark, E.title_number, title) == n


def test_decrement_twice(spark):
    once = col1(spark, E.decrement_title, "Test 65")
    assert once == "Test 5"
    assert col1(spark, E.decrement_title, once) == "Test 1"
    assert col1(spark, E.decrement_title, "65 번 시험지") == "5 번 시험지"
    assert col1(spark, E.decrement_title, "Nothing") == "Nothing"


def test_renumber_replaces_every_occurrence(spark):
    df = spark.createDataFrame([(1, 1, "HSK 1 Test 1", {"en": "HSK 1 Test 1", "ko": "1 번 시험지"})],
                               "id long, level int, title string, title_lang map<string,string>")
    r = E.renumber_regular(df).first()
    assert r.title == "Test 41"
    assert r.title_lang == {"en": "HSK 41 Test 41", "ko": "41 번 시험지"}


@pytest.mark.parametrize("m,want", [
    ({"en": "Hi", "vi": "Chao"}, {"en": "Hi", "vi": "Chao", "ko": "Hi", "ja": "Hi", "fr": "Hi", "ru": "Hi"}),
    ({"vi": "Chao"}, {"vi": "Chao", **{k: "[Translated from vi] Chao" for k in ["ko", "ja", "fr", "ru"]}}),
    ({"de": "x"}, {"de": "x"}),
    ({"en": "Hi", "ko": ""}, {"en": "Hi", "ko": "Hi", "ja": "Hi", "fr": "Hi", "ru": "Hi"}),
    ({"ko": ""}, {"ko": ""}),
])
def test_fill_translations(spark, m, want):
    df = spark.createDataFrame([(m,)], "m map<string,string>")
    assert df.select(E.fill_translations("m").alias("r")).first().r == want


def test_split_skills_and_titles(spark):
    df = spark.createDataFrame(
        [(7, 3, "Test 5", {"en": "Test 5", "ko": "5 번 시험지", "ja": "無題"},
          [("Listening", 20), ("Translation", 10), ("Writing", 15)])],
        "id long, level int, title string, title_lang map<string,string>, parts array<struct<name:string,time:int>>")
    rows = sorted(E.split_skills(df).collect(), key=lambda r: r.part_pos)
    assert [r.title for r in rows] == ["Test 20 - Listening", "Test 20 - Writing"]
    assert rows[0].title_lang == {"en": "Test 20 - Listening", "ko": "20 번 시험지 - 듣기"}
    assert [r.time for r in rows] == [20, 15]


def test_flatten_groups(spark):
    df = spark.createDataFrame([('[1, [2, 3], "a", [[4]]]',), ("not json",)], "g string")
    got = [r.r for r in df.select(E.flatten_groups_json("g").alias("r")).collect()]
    assert got == [["1", "2", "3", '"a"', "[4]"], []]


def test_exams_of_one_id_keep_their_own_titles(spark):
    schema = "id long, level int, title string, title_lang map<string,string>, parts array<struct<name:string,time:int>>"
    part = [("Reading", 10)]
    df = spark.createDataFrame([(1, 1, "Test 65", {"en": "Test 65"}, part), (1, 1, "Test 70", {"en": "Test 70", "ru": None}, part),
                                (2, 1, "Test 65", None, part), (3, 1, "Nothing", {"en": "Test 9"}, part)], schema)
    got = sorted(((r.title, r.title_lang.get("en")) for r in E.split_skills(df).collect()), key=str)
    assert got == [("Test 105 - Reading", "Test 105 - Reading"), ("Test 105 - Reading", None), ("Test 110 - Reading", "Test 110 - Reading")]
    twice = sorted(((r.title, r.title_lang.get("en")) for r in E.ai_skill_split(df, first_decrement=True).collect()), key=str)
    assert twice == [("Test 1 - Reading", "Test 1 - Reading"), ("Test 1 - Reading", "Test 1 - Reading"), ("Test 1 - Reading", None)]


def test_skill_titles_need_no_shuffle(spark):
    schema = "id long, level int, title string, title_lang map<string,string>, parts array<struct<name:string,time:int>>"
    df = spark.createDataFrame([(1, 1, "Test 65", {"en": "Test 65", "ko": "65 번 시험지", "vi": "none"}, [("Reading", 10)])], schema)
    for found in (E.split_skills(df), E.ai_skill_split(df, first_decrement=True)):
        plan = found._jdf.queryExecution().executedPlan().toString()
        assert "Exchange" not in plan and "Join" not in plan
    assert E.ai_skill_split(df, first_decrement=True).first().title_lang == {"en": "Test 1 - Reading", "ko": "1 번 시험지 - 읽기"}


def test_exams_are_numbered_from_written_columns(spark):
    rows = [(i * 7919 % 500, None if i % 3 else {"a": "x"}, [i]) for i in range(500)]
    df = spark.createDataFrame(rows, "id long, m map<string,string>, l array<long>")
    from kindred.operators.fill import in_order, sequential_ids
    plan = in_order(df, ["id"], 8).select("id")._jdf.queryExecution().executedPlan().toString()
    assert "FileScan parquet" in plan and "ReadSchema: struct<id:bigint>" in plan
    got = {r.id: (r.n, r.m, r.l) for r in sequential_ids(df, ["id"], 5, out="n", chunks=8).collect()}
    assert got == {i: (i + 5, m, l) for i, m, l in rows}
