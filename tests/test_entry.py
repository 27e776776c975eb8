"""The entry module with and without the training-data subpackage."""

from __future__ import annotations

import os
import shutil
import subprocess
import sys

ROOT = os.path.dirname(os.path.dirname(os.path.abspath(__file__)))


def names(folder):
    code = "import __spark_entry__ as e; print(*e.queries()); print(set(e.oracle_sql()) - set(e.queries()))"
    said = subprocess.run([sys.executable, "-c", code], cwd=folder, capture_output=True, text=True, check=True,
                          env={k: v for k, v in os.environ.items() if k != "PYTHONPATH"})
    first, rest = said.stdout.strip().splitlines()
    assert rest == "set()"
    return set(first.split())


def test_queries_without_the_subpackage(tmp_path):
    shutil.copytree(os.path.join(ROOT, "folioloom"), tmp_path / "folioloom", ignore=shutil.ignore_patterns("llm", "__pycache__"))
    shutil.copy(os.path.join(ROOT, "__spark_entry__.py"), tmp_path)
    without = names(tmp_path)
    assert {"crawl_cycle", "state_fold"} <= without
    assert not any(n.startswith("op") or n == "pipeline" for n in without)
