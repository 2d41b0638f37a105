"""The entry module where the folders of the corpus operators, and their pipeline, are not there."""

import os
import shutil
import subprocess
import sys

import pytest

ROOT = os.path.dirname(os.path.dirname(os.path.abspath(__file__)))
ASK = "import __spark_entry__ as e; print(*sorted(e.queries())); assert set(e.oracle_sql()) <= set(e.queries())"


@pytest.mark.parametrize("pipeline", [True, False])
def test_queries_without_the_corpus_folders(tmp_path, pipeline):
    own = tmp_path / "copy"
    shutil.copytree(ROOT, own, ignore=shutil.ignore_patterns(".git", "__pycache__", "llm"))
    assert not (own / "oreloom" / "llm").exists()
    if not pipeline:
        (own / "corpus_pipeline.py").unlink(missing_ok=True)
    env = {**os.environ, "PYTHONPATH": ""}
    out = subprocess.run([sys.executable, "-c", ASK], cwd=own, env=env, capture_output=True, text=True, timeout=120)
    assert out.returncode == 0, out.stderr
    names = out.stdout.split()
    assert "canonical_merge" in names and not [n for n in names if n.startswith("op") or n == "pipeline"]
