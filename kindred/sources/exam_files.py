"""Named exam files as a Spark data source (S5-S8): ``format("exam_files")``.

A folder holds JSON files, each an array of items (or one object).  Written rows
``(file_name, pos, item)`` become files of exactly these names with their items in
``pos`` order; read rows are the same three columns plus ``number``, the first number in the
file name (0 when none).

Reading: input partitions are runs of files, planned from a listing; a file is parsed by
the task that reads it.  Writing: a task writes each of its files under a hidden name next to
its place and reports the names in its commit message; the driver's commit renames
them, so a folder never shows a half-written file and a task that runs twice leaves one
result.  Files are reached through ``pyarrow.fs``, so the folder may be any URI that it
knows (``file``, ``hdfs``, ``s3``, ``gs``) or a plain path.
"""

from __future__ import annotations

import codecs
import json
import re
from collections.abc import Iterator
from dataclasses import dataclass, field

from pyspark.sql import DataFrame, SparkSession
from pyspark.sql import functions as F
from pyspark.sql.datasource import DataSource, DataSourceReader, DataSourceWriter, InputPartition, WriterCommitMessage

SCHEMA = "file_name string, number long, pos int, item string"
#: Bytes of a file that a reading task decodes at a time.
CHUNK = 1 << 20
HIDDEN = "_writing-"
_BLANK = re.compile(r"[ \t\n\r]*")


def file_number(name: str) -> int:
    """The first number in a file name, 0 when none."""
    found = re.search(r"\d+", name)
    return int(found.group()) if found else 0


def open_folder(path: str):
    """File system and folder of a URI or path."""
    from pyarrow import fs

    if "://" not in path and path.startswith("file:"):
        path = path[5:]
    return fs.FileSystem.from_uri(path) if "://" in path else (fs.LocalFileSystem(), path)


def stream_items(stream, chunk: int = CHUNK) -> Iterator:
    """The elements of a JSON array, or one other value, parsed as the bytes arrive: only
    the element at hand and one chunk are held, whatever the size of the file."""
    text, decode = codecs.getincrementaldecoder("utf-8-sig")(), json.JSONDecoder().raw_decode
    held, at, ended = "", 0, False

    def more() -> None:
        nonlocal held, at, ended
        got = stream.read(max(chunk, len(held) - at))     # a long element doubles what is held
        held, at, ended = held[at:] + text.decode(got, not got), 0, not got

    def char() -> str:
        """The next character that is no white space, '' at the end."""
        nonlocal at
        while True:
            at = _BLANK.match(held, at).end()
            if at < len(held):
                return held[at]
            if ended:
                return ""
            more()

    def value():
        nonlocal at
        while True:
            try:
                out, end = decode(held, at)
            except json.JSONDecodeError:
                if ended:
                    raise
            else:
                # a number may go on in the next chunk
                if ended or end < len(held) and held[end] not in ".eE":
                    at = end
                    return out
            more()

    if char() != "[":
        yield value()
    else:
        at += 1
        if char() == "]":
            at += 1
        else:
            while True:
                char()
                yield value()
                after = char()
                if after not in (",", "]"):
                    raise json.JSONDecodeError("Expecting ',' delimiter", held, at)
                at += 1
                if after == "]":
                    break
    if char():
        raise json.JSONDecodeError("Extra data", held, at)


class ExamFiles(InputPartition):
    """Consecutive files of the listing that one task reads."""

    def __init__(self, names: list[str]):
        self.names = names


class ExamFilesReader(DataSourceReader):
    def __init__(self, options: dict):
        self.path, self.ext = options["path"], options.get("ext", ".json")
        self.tasks = int(options.get("tasks", "200"))

    def partitions(self) -> list[ExamFiles]:
        """Files directly in the folder with the extension, by (number, name),
        in at most ``tasks`` runs."""
        from pyarrow import fs

        store, folder = open_folder(self.path)
        names = [f.base_name for f in store.get_file_info(fs.FileSelector(folder))
                 if f.type == fs.FileType.File and f.base_name.endswith(self.ext) and not f.base_name.startswith(("_", "."))]
        names.sort(key=lambda n: (file_number(n), n))
        size = max(-(-len(names) // self.tasks), 1)
        return [ExamFiles(names[i:i + size]) for i in range(0, len(names), size)]

    def read(self, part: ExamFiles) -> Iterator[tuple]:
        store, folder = open_folder(self.path)
        for name in part.names:
            with store.open_input_stream(f"{folder}/{name}") as f:
                number = file_number(name)
                for pos, item in enumerate(stream_items(f)):
                    yield name, number, pos, json.dumps(item, ensure_ascii=False)


@dataclass
class Written(WriterCommitMessage):
    """Files of one task: hidden name and final name."""

    files: list = field(default_factory=list)


class ExamFilesWriter(DataSourceWriter):
    def __init__(self, options: dict, overwrite: bool):
        self.path, self.overwrite = options["path"], overwrite

    def write(self, rows) -> Written:
        """Rows come sorted by (file_name, pos), all rows of a file in one task."""
        import uuid

        store, folder = open_folder(self.path)
        store.create_dir(folder, recursive=True)
        done, name, out, first = Written(), None, None, True
        try:
            for row in rows:
                if row.file_name != name:
                    if out is not None:
                        out.write(b"]")
                        out.close()
                    name, first = row.file_name, True
                    if not name or "/" in name or name.startswith(("_", ".")):
                        raise ValueError(f"not a file name: {name!r}")
                    hidden = f"{HIDDEN}{uuid.uuid4().hex}"
                    done.files.append((hidden, name))
                    out = store.open_output_stream(f"{folder}/{hidden}")
                    out.write(b"[")
                out.write((b"" if first else b",\n") + row.item.encode("utf-8"))
                first = False
            if out is not None:
                out.write(b"]")
        finally:
            if out is not None:
                out.close()
        return done

    def commit(self, messages: list) -> None:
        store, folder = open_folder(self.path)
        store.create_dir(folder, recursive=True)
        files = [f for m in messages if m is not None for f in m.files]
        names = [n for _, n in files]
        if len(set(names)) != len(names):
            self.abort(messages)
            raise ValueError("rows of one file came from several tasks: repartition by file_name")
        for hidden, name in files:
            store.move(f"{folder}/{hidden}", f"{folder}/{name}")

    def abort(self, messages: list) -> None:
        store, folder = open_folder(self.path)
        for m in messages:
            for hidden, _ in m.files if m is not None else ():
                store.delete_file(f"{folder}/{hidden}")


class ExamFilesDataSource(DataSource):
    @classmethod
    def name(cls) -> str:
        return "exam_files"

    def schema(self) -> str:
        return SCHEMA

    def reader(self, schema) -> ExamFilesReader:
        return ExamFilesReader(self.options)

    def writer(self, schema, overwrite: bool) -> ExamFilesWriter:
        return ExamFilesWriter(self.options, overwrite)


def register_source(spark: SparkSession) -> None:
    spark.dataSource.register(ExamFilesDataSource)


def write_exam_files(df: DataFrame, path: str, name: str = "file_name", pos: str = "pos", item: str = "item") -> None:
    """Write items (JSON text) into the files named by their rows; a file is written by
    one task, so it is bounded by what one file may hold."""
    register_source(df.sparkSession)
    rows = df.select(F.col(name).cast("string").alias("file_name"), F.lit(0).cast("long").alias("number"),
                     F.col(pos).cast("int").alias("pos"), F.col(item).cast("string").alias("item"))
    (rows.repartition("file_name").sortWithinPartitions("file_name", "pos")
     .write.format("exam_files").mode("append").save(path))


def read_named_files(spark: SparkSession, path: str, ext: str = ".json") -> DataFrame:
    """Items of all files of a folder with the extension: ``SCHEMA``."""
    register_source(spark)
    return (spark.read.format("exam_files").option("ext", ext)
            .option("tasks", str(spark.conf.get("spark.sql.shuffle.partitions"))).load(path))


import sys as _sys  # noqa: E402

from kindred._shipping import ship_by_value  # noqa: E402

ship_by_value(_sys.modules[__name__])
