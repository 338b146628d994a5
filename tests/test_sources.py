import json
import os
import tempfile

import pytest
from pyspark.sql import functions as F

from kindred.sources import exam_files, io


def test_csv_with_bom_and_quotes(spark):
    d = tempfile.mkdtemp(prefix="kindred-csv-")
    p = os.path.join(d, "a.csv")
    with open(p, "w", encoding="utf-8-sig") as f:
        f.write('id,text\n1,"he said ""hi""\nbye"\n2,plain\n')
    df = io.read_csv_text(spark, p)
    assert df.columns == ["id", "text"]
    rows = sorted((r.id, r.text) for r in df.collect())
    assert rows == [("1", 'he said "hi"\nbye'), ("2", "plain")]


def test_list_files_orders_by_first_number(spark):
    d = tempfile.mkdtemp(prefix="kindred-ls-")
    for name in ["b10.json", "a2.json", "none.json", "x.txt"]:
        with open(os.path.join(d, name), "w") as f:
            f.write("[]")
    got = [r.file_name for r in io.list_files(spark, d, ".json").collect()]
    assert got == ["none.json", "a2.json", "b10.json"]


def test_exam_files_and_json_arrays(spark):
    d = tempfile.mkdtemp(prefix="kindred-exam-")
    with open(os.path.join(d, "Level_2_Test_3.json"), "w") as f:
        json.dump([{"id": 1, "title": "Test 1"}, {"id": 2, "title": "Test 2"}], f)
    with open(os.path.join(d, "Level_1_Test_9.json"), "w") as f:
        json.dump({"id": 3, "title": "Test 3"}, f)
    with open(os.path.join(d, "notes.json"), "w") as f:
        json.dump([{"id": 4, "title": "x"}], f)
    df = io.read_exam_files(spark, d, "id long, title string")
    got = sorted((r.file_level, r.file_test, r.pos, r.id) for r in df.collect())
    assert got == [(1, 9, 0, 3), (2, 3, 0, 1), (2, 3, 1, 2)]
    ai = io.read_ai_exam_files(spark, d, "id long, title string")
    assert sorted((r.file_level, r.pos, r.id) for r in ai.collect()) == [(0, 0, 4), (1, 0, 3), (2, 0, 1), (2, 1, 2)]


def test_id_list(spark):
    d = tempfile.mkdtemp(prefix="kindred-ids-")
    with open(os.path.join(d, "ids.txt"), "w") as f:
        f.write("5,6,7\n")
    with open(os.path.join(d, "ids.json"), "w") as f:
        f.write("[8, 9]")
    got = sorted(r.id for r in io.read_id_list(spark, d).collect())
    assert got == [5, 6, 7, 8, 9]


def test_named_files_round_trip(spark):
    d = tempfile.mkdtemp(prefix="kindred-named-")
    rows = spark.range(60).select(F.concat(F.lit("Level_"), F.col("id") % 3, F.lit("_Test_"), F.col("id") % 4, F.lit(".json")).alias("file_name"),
                                  (F.lit(100) - F.col("id")).alias("pos"), F.concat(F.lit('{"id":'), F.col("id"), F.lit(',"t":"é\\n\\""}')).alias("item"))
    exam_files.write_exam_files(rows, d)
    assert len(os.listdir(d)) == 12 and not [n for n in os.listdir(d) if n.startswith("_")]
    with open(os.path.join(d, "Level_1_Test_2.json"), encoding="utf-8") as f:
        assert [x["id"] for x in json.load(f)] == [58, 46, 34, 22, 10]
    for tasks in (1, 5):
        spark.conf.set("spark.sql.shuffle.partitions", tasks)
        back = exam_files.read_named_files(spark, d)
        assert back.rdd.getNumPartitions() <= 5
        got = {(r.file_name, r.pos): json.loads(r.item)["id"] for r in back.collect()}
        spark.conf.set("spark.sql.shuffle.partitions", 8)
        assert len(got) == 60 and got["Level_1_Test_2.json", 0] == 58


def test_file_of_two_tasks_is_refused_and_leaves_nothing(spark):
    d = tempfile.mkdtemp(prefix="kindred-named-")
    exam_files.register_source(spark)
    rows = spark.range(4).repartition(4).selectExpr("'a.json' AS file_name", "0L AS number", "cast(id AS int) AS pos", "'{}' AS item")
    with pytest.raises(Exception, match="several tasks"):
        rows.write.format("exam_files").mode("append").save(d)
    assert os.listdir(d) == []


def test_sheets_keep_their_columns(spark):
    d = tempfile.mkdtemp(prefix="kindred-sheets-")
    io.write_sheets({"one": spark.range(2), "two": spark.range(3).withColumnRenamed("id", "x")}, d)
    back = io.read_sheet_frames(spark, d)
    assert {k: (v.columns, v.count()) for k, v in back.items()} == {"one": (["id"], 2), "two": (["x"], 3)}


@pytest.mark.parametrize("chunk", [1, 2, 7, 64, 1 << 20])
def test_items_are_parsed_as_they_arrive(chunk):
    import io as streams
    import json

    from kindred.sources.exam_files import stream_items
    items = [{"a": "Đề, ]thi[", "b": [1, {"c": None}]}, 12345, "x\"y", [], {}, -1.5e3, True]
    for data in (items, [], items[0], 17, "s"):
        for raw in (json.dumps(data, ensure_ascii=False, indent=1), json.dumps(data)):
            got = list(stream_items(streams.BytesIO(b"\xef\xbb\xbf " + raw.encode("utf-8") + b"\n"), chunk))
            assert got == (data if isinstance(data, list) else [data])
    for bad in ("", "[1, 2", "[1 2]", "[1] 2", "[1,]", "{"):
        with pytest.raises(json.JSONDecodeError):
            list(stream_items(streams.BytesIO(bad.encode()), chunk))


def test_a_large_file_is_not_held_whole():
    import io as streams

    from kindred.sources.exam_files import stream_items

    class Counted(streams.BytesIO):
        most = 0

        def read(self, n=-1):
            assert 0 <= n <= 1 << 16
            return super().read(n)
    raw = b"[" + b",\n".join(b'{"id": %d}' % i for i in range(200_000)) + b"]"
    assert sum(x["id"] for x in stream_items(Counted(raw), 1 << 12)) == 199_999 * 100_000
