"""The entry point stands without the optional subpackage, and without the pipeline."""

from __future__ import annotations

import os
import shutil
import subprocess
import sys

import pytest

ROOT = os.path.dirname(os.path.dirname(os.path.abspath(__file__)))
NAMES = "import __spark_entry__ as e; print(*sorted(e.queries())); print(*sorted(e.oracle_sql()))"


@pytest.mark.parametrize("without", [("tenderlake/llm", "corpus_pipeline.py"), ("tenderlake/llm",), ("corpus_pipeline.py",)])
def test_entry_imports_without_optional_parts(tmp_path, without):
    shutil.copytree(os.path.join(ROOT, "tenderlake"), tmp_path / "tenderlake", ignore=shutil.ignore_patterns("__pycache__"))
    for f in ("__spark_entry__.py", "corpus_pipeline.py"):
        if os.path.exists(os.path.join(ROOT, f)):
            shutil.copy(os.path.join(ROOT, f), tmp_path)
    for name in without:
        path = tmp_path / name
        if path.is_dir():
            shutil.rmtree(path)
        elif path.exists():
            path.unlink()
    env = {k: v for k, v in os.environ.items() if k != "PYTHONPATH"}
    done = subprocess.run([sys.executable, "-c", NAMES], cwd=tmp_path, env=env, capture_output=True, text=True, timeout=120)
    assert done.returncode == 0, done.stderr
    assert "country_master" in done.stdout and "pipeline" not in done.stdout
    assert ("op7_exact_dedup" in done.stdout) == ("tenderlake/llm" not in without and os.path.isdir(os.path.join(ROOT, "tenderlake/llm")))
