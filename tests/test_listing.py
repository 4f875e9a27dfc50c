"""Listing by executors, and texts that are read once."""

import os
import pathlib
import re

import pytest
from pyspark.sql import functions as F

from termloom.sources import triples as S
from termloom.sources.corpus import corpus_inventory, count_corpus_files, read_corpus
from termloom.sources.listing import gone_files, manifest, new_files


def put(path: pathlib.Path, data: bytes = b"") -> None:
    path.parent.mkdir(parents=True, exist_ok=True)
    path.write_bytes(data)


@pytest.fixture
def root(tmp_path):
    top = tmp_path / "my corpus %41+b"
    for name in ("a/1.txt", "a/2.txt", "a/deep/3.txt", "a/deep/_x/1.txt", "a/_top/4.txt", "b c/1 é%20.txt", "b c/.hidden", "b c/_SUCCESS", "_tmp/1.txt", "beside.txt"):
        put(top / name, name.encode())
    put(top / "a" / "empty.txt")
    (top / "none").mkdir()
    return top


def names(df, root):
    return sorted(os.path.relpath(r["path"], f"file://{root}") for r in df.select("path").collect())


def test_every_file_with_size_and_time(spark, root):
    found = manifest(spark, str(root))
    assert found.columns == ["path", "size", "modified"]
    assert names(found, root) == ["_tmp/1.txt", "a/1.txt", "a/2.txt", "a/_top/4.txt", "a/deep/3.txt", "a/empty.txt", "b c/1 é%20.txt"]
    for r in found.collect():
        stat = os.stat(r["path"].removeprefix("file://"))
        assert r["size"] == stat.st_size and abs(r["modified"].timestamp() - stat.st_mtime) < 1
    assert count_corpus_files(spark, str(root) + "/").first()["n_docs"] == 7


def test_paths_are_those_of_a_scan(spark, root):
    scanned = {r["src_id"] for r in read_corpus(spark, str(root)).select("src_id").distinct().collect()}
    listed = {r["path"] for r in manifest(spark, str(root)).where("size > 0").collect()}
    assert {os.path.normpath(x.split(":", 1)[1]) for x in scanned} == {os.path.normpath(x.split(":", 1)[1]) for x in listed}


def test_files_that_came_changed_and_went(spark, root):
    before = manifest(spark, str(root)).cache()
    assert before.count() == 7 and new_files(before, before).isEmpty()
    put(root / "b c" / "new.txt")
    put(root / "a" / "1.txt", b"longer than before")
    os.remove(root / "a" / "2.txt")
    now = manifest(spark, str(root))
    assert names(new_files(now, before), root) == ["a/1.txt", "b c/new.txt"]
    assert names(gone_files(now, before), root) == ["a/1.txt", "a/2.txt"]


def test_patterns_and_missing_roots(spark, root):
    assert manifest(spark, str(root.parent / "my*")).count() == 7
    with pytest.raises(FileNotFoundError):
        manifest(spark, str(root / "no such folder"))


def test_many_files_stay_off_the_driver(spark, tmp_path):
    for folder in range(5):
        (tmp_path / "c" / f"f{folder}").mkdir(parents=True)
        for i in range(4000):
            (tmp_path / "c" / f"f{folder}" / f"{i}.txt").touch()
    found = manifest(spark, str(tmp_path / "c"))
    plan = found._jdf.queryExecution().executedPlan().toString()
    # What the driver plans is the root alone, and folders are dealt to tasks.
    assert "f0" not in plan and len(re.findall("MapInPandas", plan)) == 2 and "Exchange" in plan
    assert count_corpus_files(spark, str(tmp_path / "c")).first()["n_docs"] == 20_000
    assert corpus_inventory(spark, str(tmp_path / "c")).groupBy("class").count().where("count <> 4000").isEmpty()


LINES = ["1\t2\t3", "10 20 30 ", "", " 1 2 3", "1 2", "1 2 x", "1 2 3 4", "7\t8\t+9", "x y z w"]


@pytest.mark.parametrize("strict", [True, False])
def test_rows_and_rejects_from_one_pass(spark, tmp_path, strict):
    put(tmp_path / "m" / "part-0", "\n".join(LINES).encode())
    put(tmp_path / "m" / "part-1", b"5 6 7\n")
    lines = S.read_lines(spark, str(tmp_path / "m"))
    rows, rejects = (S.parse_strict if strict else S.parse_lenient)(lines, S.COUNTS)
    once = S.parse_once(lines, S.COUNTS, strict)
    assert sorted(map(tuple, once.rows.collect())) == sorted(map(tuple, rows.collect()))
    assert sorted(r[0] for r in once.rejects.collect()) == sorted(r[0] for r in rejects.collect())
    assert (once.n_rows, once.n_rejects) == (rows.count(), rejects.count())
    for part in (once.rows, once.rejects):
        plan = part._jdf.queryExecution().executedPlan().toString()
        # The text is not read again, and of the table only the files of one tag.
        assert "FileScan text" not in plan and "PartitionFilters: [isnotnull(good" in plan
    assert once.rows.dtypes == rows.dtypes


def test_a_text_without_lines(spark, tmp_path):
    put(tmp_path / "m" / "part-0")
    once = S.parse_once(S.read_lines(spark, str(tmp_path / "m")), S.WEIGHTS, False)
    assert (once.n_rows, once.n_rejects) == (0, 0) and once.rows.isEmpty() and once.rejects.isEmpty()
    assert once.rows.withColumn("more", F.lit(1)).count() == 0
