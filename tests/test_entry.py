"""The entry with and without the modules that may be absent."""

from __future__ import annotations

import shutil
import subprocess
import sys
from pathlib import Path

import pytest

ROOT = Path(__file__).resolve().parents[1]
CODE = "import __spark_entry__ as e; print(len(e.queries()), len(e.oracle_sql()), any(n.startswith('op') for n in e.queries()))"


@pytest.mark.parametrize("left_out", [["llm"], ["llm", "corpus_pipeline.py"]])
def test_imports_without_training_data_operators(tmp_path, left_out):
    copy = tmp_path / "copy"
    shutil.copytree(ROOT, copy, ignore=shutil.ignore_patterns(".git", "__pycache__", *left_out))
    done = subprocess.run([sys.executable, "-c", CODE], cwd=copy, capture_output=True, text=True, env={"PATH": "/usr/bin:/bin"})
    assert done.returncode == 0, done.stderr
    queries, counterparts, added = done.stdout.split()
    assert queries == counterparts and added == "False"


def test_another_missing_module_is_an_error(tmp_path):
    copy = tmp_path / "copy"
    shutil.copytree(ROOT, copy, ignore=shutil.ignore_patterns(".git", "__pycache__"))
    (copy / "corpus_pipeline.py").write_text("import no_such_module_at_all\n")
    done = subprocess.run([sys.executable, "-c", CODE], cwd=copy, capture_output=True, text=True, env={"PATH": "/usr/bin:/bin"})
    assert done.returncode != 0 and "no_such_module_at_all" in done.stderr
