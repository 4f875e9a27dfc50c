"""Which files a corpus has, listed by the executors.

The root is listed by one task and each folder in it by a task of its own; what a task finds goes into a table in small
batches. No list of names passes through the driver. File systems are those that Arrow opens in the tasks. A listing
has the files that a scan of the same folders reads, those in folders below a class folder included and hidden ones not,
and beside them the files of zero length.
"""

from __future__ import annotations

from collections.abc import Iterator

import pandas as pd
from pyspark.sql import DataFrame, SparkSession

# Rows handed over at a time.
BATCH = 10_000

MANIFEST = "path string, size bigint, modified timestamp"


def _roots(spark: SparkSession, root: str) -> list[str]:
    """The folders ``root`` names, one or those that its pattern matches, with scheme and authority."""
    context = spark.sparkContext
    path = context._jvm.org.apache.hadoop.fs.Path(root)
    matches = path.getFileSystem(context._jsc.hadoopConfiguration()).globStatus(path)
    if not matches:
        raise FileNotFoundError(root)
    return [match.getPath().toString() for match in matches]


def _entries(uri: str):
    """``(prefix, entries)`` of a folder: what stands before paths in URIs, and the files and folders it holds."""
    from pyarrow.fs import FileSelector, FileSystem

    scheme, _, rest = uri.partition(":")
    authority = rest[2:].partition("/")[0] if rest.startswith("//") else ""
    # What is in a path is taken as it is: a path is no URI, and may hold blanks and percent signs.
    system = FileSystem.from_uri(f"{scheme}://{authority}/")[0]
    path = rest[2 + len(authority) :] if rest.startswith("//") else rest
    return f"{scheme}://{authority}", system.get_file_info(FileSelector(path))


def _hidden(name: str) -> bool:
    """What a scan passes over."""
    return name.startswith(".") or (name.startswith("_") and "=" not in name) or name.endswith("._COPYING_")


def _folders(batches: Iterator[pd.DataFrame]) -> Iterator[pd.DataFrame]:
    for batch in batches:
        for uri in batch["folder"]:
            prefix, entries = _entries(uri)
            names = [f"{prefix}{e.path}" for e in entries if not e.is_file]
            for at in range(0, len(names), BATCH):
                yield pd.DataFrame({"folder": pd.Series(names[at : at + BATCH], dtype=object)})


def _files(batches: Iterator[pd.DataFrame]) -> Iterator[pd.DataFrame]:
    for batch in batches:
        for top in batch["folder"]:
            waiting = [top]
            while waiting:
                prefix, entries = _entries(uri := waiting.pop())
                # A pattern of two levels names the folders in a class folder, whatever they are called.
                waiting += [f"{prefix}{e.path}" for e in entries if not e.is_file and (uri == top or not _hidden(e.base_name))]
                files = [(f"{prefix}{e.path}", e.size, e.mtime) for e in entries if e.is_file and not _hidden(e.base_name)]
                for at in range(0, len(files), BATCH):
                    rows = pd.DataFrame(files[at : at + BATCH], columns=["path", "size", "modified"])
                    yield rows.astype({"path": object, "size": "int64"})


def manifest(spark: SparkSession, root: str) -> DataFrame:
    """``(path, size, modified)`` of every file of the class folders below ``root``; paths as those of a scan, unescaped."""
    top = spark.createDataFrame([(r,) for r in _roots(spark, root.rstrip("/") or "/")], "folder string")
    tasks = int(spark.conf.get("spark.sql.shuffle.partitions"))
    folders = top.mapInPandas(_folders, "folder string").repartition(tasks, "folder")
    return folders.mapInPandas(_files, MANIFEST)


def new_files(now: DataFrame, before: DataFrame) -> DataFrame:
    """Rows of a manifest that an older one does not have: files that came or changed in size or time."""
    same = ["path", "size", "modified"]
    return now.join(before.select(*same), same, "left_anti")


def gone_files(now: DataFrame, before: DataFrame) -> DataFrame:
    """Rows of an older manifest whose file is no longer there as it was."""
    return new_files(before, now)
