"""The driver's entry module with and without the training-data operators."""

import shutil
import subprocess
import sys
from pathlib import Path

import pytest

ROOT = Path(__file__).resolve().parents[1]
TRY = "import __spark_entry__ as e; q, o = e.queries(), e.oracle_sql(); assert set(o) <= set(q); print(len(q), [n for n in q if n[:2] == 'op' and n[2].isdigit() or n == 'pipeline'])"


@pytest.mark.parametrize("gone", [["quirework/llm", "tests/llm"], ["quirework/llm", "tests/llm", "corpus_pipeline.py"]])
def test_imports_without_the_operators(tmp_path, gone):
    shutil.copytree(ROOT, tmp_path / "r", ignore=shutil.ignore_patterns(".git", "__pycache__"))
    for name in gone:
        path = tmp_path / "r" / name
        shutil.rmtree(path) if path.is_dir() else path.unlink(missing_ok=True)
    done = subprocess.run([sys.executable, "-c", TRY], cwd=tmp_path / "r", capture_output=True, text=True)
    assert done.returncode == 0, done.stderr
    assert done.stdout.rstrip().endswith(" []")


def test_every_twin_has_a_query():
    import __spark_entry__

    assert set(__spark_entry__.oracle_sql()) <= set(__spark_entry__.queries())


def test_the_rest_passes_without_the_operators(tmp_path):
    """Some of the other tests, run where both folders and the pipeline are gone."""
    shutil.copytree(ROOT, tmp_path / "r", ignore=shutil.ignore_patterns(".git", "__pycache__"))
    for name in ("quirework/llm", "tests/llm"):
        shutil.rmtree(tmp_path / "r" / name, ignore_errors=True)
    (tmp_path / "r" / "corpus_pipeline.py").unlink(missing_ok=True)
    some = ["tests/test_rules.py", "tests/test_registry.py", "tests/test_entry.py::test_every_twin_has_a_query"]
    done = subprocess.run([sys.executable, "-m", "pytest", "-q", "-x", *some], cwd=tmp_path / "r", capture_output=True, text=True)
    assert done.returncode == 0, done.stdout[-2000:]
