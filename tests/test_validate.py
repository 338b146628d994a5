import json

from pyspark.sql import functions as F

from kindred.operators.validate import GENERAL_MODEL, QUESTION_MODEL, first_error, flatten_json_list

GOOD_GENERAL = {"G_text": [], "G_text_translate": {k: "" for k in ["vi", "en", "ko", "fr", "ja", "ru"]},
                "G_text_audio": "", "G_text_audio_translate": {k: "" for k in ["vi", "en", "ko", "fr", "ja", "ru"]},
                "G_audio": [], "G_image": ["a.png"]}


def check(spark, rec, model=QUESTION_MODEL):
    df = spark.createDataFrame([(json.dumps(rec),)], "j string")
    return df.select(first_error(F.col("j"), model).alias("e")).first().e


def test_valid_record(spark):
    rec = {"id": 1, "kind": "k", "general": GOOD_GENERAL, "content": [{"x": 1}], "scores": [1.5, 2.0]}
    assert check(spark, rec) is None


def test_first_error_wins(spark):
    assert check(spark, {"kind": "k"}) == "Missing field: id"
    assert check(spark, {"id": "1", "kind": 2}) == "Field 'id' expected <class 'int'>, got <class 'str'>"
    rec = {"id": 1, "kind": "k", "general": {**GOOD_GENERAL, "G_text_translate": {"vi": ""}}}
    assert check(spark, rec) == "Missing field: en"
    rec = {"id": 1, "kind": "k", "general": GOOD_GENERAL, "content": [{"x": 1}, 3], "scores": []}
    assert check(spark, rec) == (
        "Items in field 'content' expected {'Q_text': <class 'str'>, 'Q_audio': <class 'str'>, 'Q_image': <class 'str'>, "
        "'A_text': [<class 'str'>], 'A_audio': <class 'list'>, 'A_image': <class 'list'>, 'A_correct': [<class 'str'>], "
        "'explain': {'vi': <class 'str'>, 'en': <class 'str'>, 'ko': <class 'str'>, 'fr': <class 'str'>, 'ja': <class 'str'>, "
        "'ru': <class 'str'>}, 'A_more_correct': [<class 'str'>], 'advance_explain': {'vi': <class 'str'>, 'en': <class 'str'>}, "
        "'langExplainAdvance': [<class 'str'>]}, got <class 'int'>")
    rec = {"id": 1, "kind": "k", "general": GOOD_GENERAL, "content": [], "scores": [1]}
    assert check(spark, rec) == "Items in field 'scores' expected <class 'float'>, got <class 'int'>"
    assert check(spark, {**GOOD_GENERAL, "G_image": "x"}, GENERAL_MODEL) == \
        "Field 'G_image' expected a list, got <class 'str'>"


def test_flatten_json_list(spark):
    df = spark.createDataFrame([("[1, [2, [3, [4]]], []]",)], "j string")
    assert df.select(flatten_json_list(F.col("j")).alias("r")).first().r == ["1", "2", "3", "4"]


def test_flatten_json_list_any_depth(spark):
    deep = "[" * 30 + "7" + "]" * 30
    texts = [deep, '[[], "a,,[b]", {"k": [1, {"m": []}, 2]}, [], [[null]]]', "[]", "5", "{}", "[1, [2", None]
    df = spark.createDataFrame([(i, t) for i, t in enumerate(texts)], "i int, j string")
    got = {r.i: r.r for r in df.select("i", flatten_json_list(F.col("j")).alias("r")).collect()}
    assert got[0] == ["7"] and got[1] == ['"a,,[b]"', '{"k":[1,{"m":[]},2]}', "null"]
    assert all(not got[i] for i in range(2, 7))
