"""The library works without the subpackage of corpus operators."""

import shutil
import subprocess
import sys
from pathlib import Path

import pytest

ROOT = Path(__file__).resolve().parent.parent


@pytest.mark.parametrize("with_pipeline", [True, False])
def test_a_copy_without_corpus_operators(tmp_path, with_pipeline):
    copy = tmp_path / "copy"
    gone = shutil.ignore_patterns("llm", ".git", "__pycache__", *([] if with_pipeline else ["corpus_pipeline.py"]))
    shutil.copytree(ROOT, copy, ignore=gone)
    code = "import __spark_entry__ as e; q = e.queries(); assert set(q) == set(e.oracle_sql()) and 'pipeline' not in q; print(len(q))"
    done = subprocess.run([sys.executable, "-c", code], cwd=copy, capture_output=True, text=True)
    assert done.returncode == 0 and int(done.stdout) > 70, done.stderr
    done = subprocess.run([sys.executable, "-m", "pytest", "tests", "-q", "--collect-only"], cwd=copy, capture_output=True, text=True)
    assert done.returncode == 0, done.stdout[-2000:]
