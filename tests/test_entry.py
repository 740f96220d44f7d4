"""The entry module without the optional subpackage, with and without the pipeline built on it."""

from __future__ import annotations

import os
import shutil
import subprocess
import sys

import pytest

REPO = os.path.dirname(os.path.dirname(os.path.abspath(__file__)))
SCRIPT = "import __spark_entry__ as e; q = e.queries(); print(len(q), len(e.oracle_sql()), any(n.startswith('op') or n == 'pipeline' for n in q))"


@pytest.mark.parametrize("with_pipeline", [True, False])
def test_entry_imports_without_the_subpackage(tmp_path, with_pipeline):
    copy = tmp_path / "copy"
    ignored = shutil.ignore_patterns("llm", ".git", "__pycache__", "tests", *([] if with_pipeline else ["corpus_pipeline.py"]))
    shutil.copytree(REPO, copy, ignore=ignored)
    env = {k: v for k, v in os.environ.items() if k != "PYTHONPATH"}
    done = subprocess.run([sys.executable, "-c", SCRIPT], cwd=copy, env=env, capture_output=True, text=True, timeout=120)
    assert done.returncode == 0, done.stderr[-2000:]
    assert done.stdout.split() == ["61", "61", "False"]
