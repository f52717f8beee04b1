"""The entry without the corpus operators."""

import os
import subprocess
import sys

import pytest

ROOT = os.path.dirname(os.path.dirname(os.path.abspath(__file__)))
HIDDEN = """
import importlib.abc, importlib.util, sys

class Absent(importlib.abc.MetaPathFinder):
    def find_spec(self, name, path=None, target=None):
        if name in {hidden} or name.startswith("assayer.llm."):
            raise ModuleNotFoundError(f"No module named {{name!r}}", name=name)

find = importlib.util.find_spec
importlib.util.find_spec = lambda name, package=None: None if name in {hidden} else find(name, package)
sys.meta_path.insert(0, Absent())
import __spark_entry__ as entry
names = entry.queries().keys()
assert "scorecard_lineitem" in names or len(names) > 50, names
assert not [n for n in names if n.startswith("op") and n[2:3].isdigit()] and "pipeline" not in names, names
assert entry.oracle_sql().keys() <= names
"""


@pytest.mark.parametrize("hidden", [{"assayer.llm"}, {"assayer.llm", "corpus_pipeline"}])
def test_entry_without_the_corpus_operators(hidden):
    run = subprocess.run([sys.executable, "-B", "-c", HIDDEN.format(hidden=hidden)], cwd=ROOT, capture_output=True, text=True)
    assert run.returncode == 0, run.stderr
