"""The engine works without its optional folder, and nothing but that folder and the pipeline imports it."""

import re
import shutil
import subprocess
import sys
from pathlib import Path

ROOT = Path(__file__).resolve().parent.parent


def test_entry_without_the_optional_folder(tmp_path):
    ignore = shutil.ignore_patterns(".git", "__pycache__", "llm", "corpus_pipeline.py", "spark-warehouse", "metastore_db")
    shutil.copytree(ROOT, tmp_path / "repo", ignore=ignore)
    code = "import __spark_entry__ as e; q = e.queries(); assert 'pipeline' not in q and len(q) > 40 and set(e.oracle_sql()) <= set(q); print(len(q))"
    run = subprocess.run([sys.executable, "-c", code], cwd=tmp_path / "repo", capture_output=True, text=True, timeout=120)
    assert run.returncode == 0, run.stderr


def test_nothing_else_imports_it():
    for f in (ROOT / "corpusloom").rglob("*.py"):
        if "llm" not in f.parts:
            assert not re.search(r"(from|import)\s+[\w.]*\bllm\b", f.read_text()), f
