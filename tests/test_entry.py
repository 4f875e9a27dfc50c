"""The entry module without the optional subpackage."""

import os
import subprocess
import sys

ROOT = os.path.dirname(os.path.dirname(os.path.abspath(__file__)))

WITHOUT = """
import sys

class Blocked:
    def find_spec(self, name, path=None, target=None):
        if name in BLOCKED:
            raise ModuleNotFoundError(f"No module named {name!r}", name=name)

sys.meta_path.insert(0, Blocked())
import __spark_entry__ as entry
from catalog.queries import QUERIES
print(sorted(entry.queries()) == sorted(QUERIES), set(entry.oracle_sql()) <= set(entry.queries()))
"""


def _without(*blocked: str) -> list[str]:
    done = subprocess.run(
        [sys.executable, "-c", f"BLOCKED = {blocked!r}\n{WITHOUT}"], cwd=ROOT, capture_output=True, text=True, timeout=120
    )
    assert done.returncode == 0, done.stderr
    return done.stdout.split()


def test_imports_without_the_subpackage():
    assert _without("termloom.llm") == ["True", "True"]


def test_imports_without_subpackage_and_pipeline():
    assert _without("termloom.llm", "corpus_pipeline") == ["True", "True"]
