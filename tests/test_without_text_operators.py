"""The text operators are a subpackage that may be absent."""

from __future__ import annotations

import os
import shutil
import subprocess
import sys

import pytest
from conftest import ROOT

LIST = "import __spark_entry__ as e; print(*e.queries(), *e.oracle_sql())"


@pytest.mark.parametrize("gone", [("corpus_pipeline.py",), (), ("__init__.py",)])
def test_the_rest_imports_and_collects(tmp_path, gone):
    """Without both folders, with or without the pipeline, or with an empty folder left."""
    skip = shutil.ignore_patterns("llm", "__pycache__", ".git", *[g for g in gone if g == "corpus_pipeline.py"])
    shutil.copytree(ROOT, tmp_path / "copy", ignore=skip)
    if "__init__.py" in gone:
        (tmp_path / "copy/casewright/llm/__pycache__").mkdir(parents=True)
    env = {**os.environ, "PYTHONPATH": "", "PYTHONDONTWRITEBYTECODE": "1"}
    out = subprocess.run([sys.executable, "-c", LIST], cwd=tmp_path / "copy", env=env, capture_output=True, text=True)
    assert out.returncode == 0, out.stderr
    names = out.stdout.split()
    assert "anomalies_all" in names and "bm25_topk" in names
    assert not any(n.startswith("op") or n == "pipeline" for n in names)


def test_errors_inside_the_text_operators_are_not_hidden(tmp_path):
    shutil.copytree(ROOT, tmp_path / "copy", ignore=shutil.ignore_patterns("__pycache__", ".git"))
    queries = tmp_path / "copy/casewright/llm/queries.py"
    if not queries.exists():
        pytest.skip("the text operators are absent")
    queries.write_text("import no_such_module\n")
    env = {**os.environ, "PYTHONPATH": ""}
    out = subprocess.run([sys.executable, "-c", LIST], cwd=tmp_path / "copy", env=env, capture_output=True, text=True)
    assert out.returncode and "no_such_module" in out.stderr
