"""One folder of text files per document, written, listed and read by the tasks.

Spark's writer and reader take such folders through the driver one by one: it moves each file when a job commits, and keeps
each path to plan a scan. Here a task puts its files where they belong, and a reading task lists the folders it was dealt.
Names are those of Spark's partitioned output, so any reader of it reads these folders too. A file gets its name when
it is whole; what a lost attempt leaves behind has a hidden name. File systems are those that Arrow opens.
"""

from __future__ import annotations

import re
import uuid
from collections.abc import Iterator
from itertools import groupby
from operator import itemgetter

import pyarrow as pa
from pyspark.sql import DataFrame, SparkSession
from pyspark.sql import functions as F

from termloom.sources.listing import _entries, _folders, _hidden, _roots

# What Spark writes in place of an empty or null value, and the characters it escapes.
NO_VALUE = "__HIVE_DEFAULT_PARTITION__"
_ESCAPED = re.compile(r"[\x01-\x1f\"#%'*/:=?\\\x7f{\[\]^]")

# Bytes of text handed over at a time, and read at a time.
PIECE = 1 << 22


def _folder(column: str, value: str | None) -> str:
    return f"{column}=" + (_ESCAPED.sub(lambda m: f"%{ord(m[0]):02X}", value) if value else NO_VALUE)


def _value(folder: str) -> str | None:
    stored = folder.partition("=")[2]
    return None if stored == NO_VALUE else re.sub("%([0-9A-Fa-f]{2})", lambda m: chr(int(m[1], 16)), stored)


def _system(uri: str):
    """File system and path of a URI whose path is taken as it is."""
    from pyarrow.fs import FileSystem

    scheme, _, rest = uri.partition(":")
    authority = rest[2:].partition("/")[0] if rest.startswith("//") else ""
    return FileSystem.from_uri(f"{scheme}://{authority}/")[0], rest[2 + len(authority) :] if rest.startswith("//") else rest


def _path(spark: SparkSession, path: str):
    """Hadoop's file system, and the path with scheme and authority."""
    context = spark.sparkContext
    given = context._jvm.org.apache.hadoop.fs.Path(path)
    system = given.getFileSystem(context._jsc.hadoopConfiguration())
    return system, system.makeQualified(given)


def opens(spark: SparkSession, path: str) -> bool:
    """Whether Arrow knows the file system of a path."""
    try:
        _system(_path(spark, path)[1].toString())
    except (pa.ArrowException, OSError):
        return False
    return True


def _writer(root: str):
    """A task function that writes rows ``(class, doc_name, part, value)``, those of a file behind each other."""

    def write(batches: Iterator[pa.RecordBatch]) -> Iterator[pa.RecordBatch]:
        system, top = _system(root)
        key, stream, hidden, name = None, None, "", ""

        def finish() -> None:
            if stream is not None:
                stream.close()
                system.move(hidden, name)

        for batch in batches:
            rows = zip(*(column.to_pylist() for column in batch.columns))
            for of, lines in groupby(rows, itemgetter(0, 1, 2)):
                if of != key or stream is None:
                    finish()
                    key = of
                    folder = f"{top}/{_folder('class', of[0])}/{_folder('doc_name', of[1])}"
                    system.create_dir(folder, recursive=True)
                    hidden, name = f"{folder}/_{uuid.uuid4().hex}", f"{folder}/part-{of[2]:05d}.txt"
                    stream = system.open_output_stream(hidden, compression=None)
                stream.write("".join([f"{line[3]}\n" for line in lines]).encode())
        finish()
        yield from ()

    return write


def write(rows: DataFrame, path: str) -> None:
    """``(class, doc_name, part, value)`` as a file per part; the rows of one lie in one partition."""
    spark = rows.sparkSession
    names = ["class", "doc_name"]
    # An empty output makes the folder, and is an error where there is one.
    empty = spark.createDataFrame([], "class string, doc_name string, value string")
    empty.write.option("mapreduce.fileoutputcommitter.marksuccessfuljobs", "false").partitionBy(*names).text(path)
    system, root = _path(spark, path)
    placed = rows.select(*names, "part", "value").sortWithinPartitions(*names, "part")
    placed.mapInArrow(_writer(root.toString()), "files bigint").write.format("noop").mode("overwrite").save()
    system.create(spark.sparkContext._jvm.org.apache.hadoop.fs.Path(root, "_SUCCESS")).close()


def _pieces(system, path: str) -> Iterator[str]:
    """The lines of a file in texts of bounded size, without the last line's end."""
    rest = b""
    with system.open_input_stream(path, compression=None) as stream:
        while piece := stream.read(PIECE):
            whole, end, rest = (rest + piece).rpartition(b"\n")
            if end:
                yield whole.decode()
    if rest:
        yield rest.decode()


def _read(batches: Iterator[pa.RecordBatch]) -> Iterator[pa.RecordBatch]:
    names, texts, size = [], [], 0

    def found() -> pa.RecordBatch:
        return pa.RecordBatch.from_arrays([pa.array(names, pa.string()), pa.array(texts, pa.string())], ["doc_name", "value"])

    for batch in batches:
        for folder in batch.column(0).to_pylist():
            system, path = _system(folder)
            for entry in _entries(folder)[1]:
                if not entry.is_file or _hidden(entry.base_name):
                    continue
                for text in _pieces(system, entry.path):
                    names.append(_value(path.rpartition("/")[2]))
                    texts.append(text)
                    size += len(text)
                    if size >= PIECE:
                        yield found()
                        names, texts, size = [], [], 0
    if texts:
        yield found()


def read(spark: SparkSession, path: str) -> DataFrame:
    """``(doc_name, value)``: every line of the files of all documents."""
    tasks = int(spark.conf.get("spark.sql.shuffle.partitions"))
    below = spark.createDataFrame([(r,) for r in _roots(spark, path.rstrip("/") or "/")], "folder string")
    for column in ("class", "doc_name"):
        listed = below.mapInPandas(_folders, "folder string")
        below = listed.where(F.substring_index("folder", "/", -1).startswith(f"{column}=")).repartition(tasks, "folder")
    files = below.mapInArrow(_read, "doc_name string, value string")
    return files.select("doc_name", F.explode(F.split("value", "\n")).alias("value"))
