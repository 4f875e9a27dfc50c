"""Whole licence texts and notices in usual wordings."""

import re
from pathlib import Path

import pytest

from termloom.llm import license_scan as L
from termloom.llm import license_texts as T

FILES = sorted((Path(T.__file__).parent / "licenses").glob("*.txt"))


def found(spark, texts):
    docs = spark.createDataFrame(list(enumerate(texts)), "doc_id int, text string")
    rows = {r["doc_id"]: r for r in L.scan(docs, L.known_licenses(spark)).collect()}
    return [rows[i] for i in range(len(texts))]


def test_whole_texts_are_found(spark):
    texts = [f.read_text() for f in FILES]
    flowing = ["\n".join(" ".join(p.split()) for p in re.split(r"\n\s*\n", t)) for t in texts]
    names = [f.stem for f in FILES]
    assert {"Apache-2.0", "GPL-2.0", "GPL-3.0", "LGPL-2.1", "LGPL-3.0", "MPL-2.0", "CC0-1.0", "Unlicense"} <= set(names)
    assert [r["license_id"] for r in found(spark, texts + flowing)] == names + names
    body = next(t for t, n in zip(texts, names) if n == "Apache-2.0").split("APPENDIX")[0]
    assert found(spark, [body])[0]["license_id"] == "Apache-2.0"


@pytest.mark.parametrize(
    "line, name",
    [
        ("This project is licensed under the GPL-2.0 license.", "GPL-2.0"),
        ("Distributed under the GNU General Public License, version 2", "GPL-2.0"),
        ("Released under the GNU Lesser General Public License v2.1 or later", "LGPL-2.1-or-later"),
        ("SPDX-License-Identifier: GPL-3.0-only", "GPL-3.0"),
        ("This work is licensed under a Creative Commons Attribution 4.0 International License.", "CC-BY-4.0"),
        ("License: EPL-2.0", "EPL-2.0"),
    ],
)
def test_notices_in_usual_wordings(spark, line, name):
    assert found(spark, [f"text\n  {line}\nmore"])[0]["notices"] == name


def test_each_form_has_one_id():
    forms = [T._plain(t) for _, t in T.LICENSES]
    assert len(forms) == len(set(forms))


def test_texts_are_found_in_a_zip_file(tmp_path):
    import os
    import shutil
    import subprocess
    import sys

    package = Path(T.__file__).parents[1]
    archive = shutil.make_archive(str(tmp_path / "termloom"), "zip", package.parent, package.name)
    code = "from termloom.llm import license_texts as t; print(t.__file__); print(len(t.whole_texts()), len(t.LICENSES))"
    env = {**os.environ, "PYTHONPATH": os.pathsep.join([archive, *[p for p in sys.path if p and Path(p) != package.parent]])}
    done = subprocess.run([sys.executable, "-c", code], env=env, cwd=tmp_path, capture_output=True, text=True, check=True)
    where, numbers = done.stdout.splitlines()
    assert where.startswith(archive)
    assert numbers == f"{len(T.whole_texts())} {len(T.LICENSES)}"
