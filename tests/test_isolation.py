"""The library without the training-data package, in a copy of the tree."""

import os
import shutil
import subprocess
import sys
from pathlib import Path

import pytest

ROOT = Path(__file__).resolve().parents[1]
PROGRAM = """
import __spark_entry__ as entry
from tallyflow.catalog.registry import registered
names, sql = set(entry.queries()), set(entry.oracle_sql())
assert names == sql == set(registered()), names ^ sql
import tests.test_queries, tests.test_plans, tests.test_operators, tests.test_tables, tests.test_streams, bench
"""


@pytest.mark.parametrize("kept", [(), ("corpus_pipeline.py",)])
def test_everything_else_works_without_the_package(tmp_path, kept):
    gone = {"llm", "corpus_pipeline.py", ".git", "__pycache__"} - set(kept)
    shutil.copytree(ROOT, tmp_path / "tree", ignore=lambda folder, names: [n for n in names if n in gone])
    env = {**os.environ, "PYTHONPATH": os.pathsep.join([str(tmp_path / "tree"), *[p for p in os.environ.get("PYTHONPATH", "").split(os.pathsep) if p and Path(p).resolve() != ROOT]])}
    done = subprocess.run([sys.executable, "-c", PROGRAM], cwd=tmp_path / "tree", env=env, capture_output=True, text=True, timeout=120)
    assert done.returncode == 0, done.stderr
