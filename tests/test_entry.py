"""The driver contract on the smallest data, and the optional subpackage."""

import os
import subprocess
import sys

import pytest

import __spark_entry__ as entry

DATA = "/root/testdata/sf0.001"


def test_names_and_sql():
    q, s = entry.queries(), entry.oracle_sql()
    assert set(s) <= set(q) and len(q) > 50


@pytest.mark.skipif(not os.path.isdir(DATA), reason="no test data")
def test_entry_runs(spark):
    assert entry.entry(spark).count() > 0


def test_rest_works_without_the_subpackage(tmp_path):
    code = "import sys, importlib.abc\nclass No(importlib.abc.MetaPathFinder):\n    def find_spec(self, name, path, target=None):\n        if name.startswith('panelwright.llm'):\n            raise ImportError(name)\nsys.meta_path.insert(0, No())\nimport __spark_entry__ as e\nassert not any(k.startswith(('p6', 'p7', 'p8')) for k in e.queries())\nassert 'p5_found' in e.queries()\n"
    root = os.path.dirname(os.path.dirname(os.path.abspath(__file__)))
    subprocess.run([sys.executable, "-c", code], cwd=root, check=True)
