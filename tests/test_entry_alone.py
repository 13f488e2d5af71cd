"""The entry without the parts that may be taken out."""

from __future__ import annotations

import os
import shutil
import subprocess
import sys
from pathlib import Path

import pytest

ROOT = Path(__file__).resolve().parents[1]
RUN = """
import __spark_entry__ as entry
assert not [name for name in entry.queries() if name.startswith("op") or name == "pipeline"]
assert set(entry.oracle_sql()) <= set(entry.queries()) and entry.queries()
from pyspark.sql import SparkSession
spark = SparkSession.builder.master("local[2]").config("spark.ui.enabled", "false").getOrCreate()
assert entry.entry(spark).count() > 0
"""


@pytest.mark.parametrize("taken", [["flarebook/llm", "tests/llm"], ["flarebook/llm", "tests/llm", "corpus_pipeline.py"]])
def test_without_the_corpus_operators(tmp_path, taken):
    copy = tmp_path / "copy"
    shutil.copytree(ROOT, copy, ignore=shutil.ignore_patterns(".git", "__pycache__", "llm", *map(os.path.basename, taken)))
    # A folder that only holds compiled files is still a package to Python.
    (copy / "flarebook/llm/__pycache__").mkdir(parents=True)
    environment = {**os.environ, "PYTHONPATH": str(copy), "PYTHONDONTWRITEBYTECODE": "1"}
    done = subprocess.run([sys.executable, "-c", RUN], cwd=copy, env=environment, capture_output=True, text=True, timeout=300)
    assert done.returncode == 0, done.stderr[-2000:]


def test_a_fault_inside_them_is_raised(tmp_path):
    copy = tmp_path / "copy"
    shutil.copytree(ROOT, copy, ignore=shutil.ignore_patterns(".git", "__pycache__", "llm"))
    (copy / "flarebook/llm").mkdir()
    (copy / "flarebook/llm/queries.py").write_text("import no_such_module_anywhere\n")
    environment = {**os.environ, "PYTHONPATH": str(copy), "PYTHONDONTWRITEBYTECODE": "1"}
    done = subprocess.run([sys.executable, "-c", "import __spark_entry__"], cwd=copy, env=environment, capture_output=True)
    assert b"no_such_module_anywhere" in done.stderr
