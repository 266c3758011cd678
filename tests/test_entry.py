"""The entry module without the optional operators."""

import shutil
import subprocess
import sys
from pathlib import Path

import pytest

ROOT = Path(__file__).resolve().parents[1]


@pytest.mark.parametrize("left", [None, "farelake/llm/__pycache__"])
def test_entry_without_the_optional_package(tmp_path, left):
    shutil.copy(ROOT / "__spark_entry__.py", tmp_path)
    shutil.copytree(ROOT / "farelake", tmp_path / "farelake", ignore=shutil.ignore_patterns("llm", "__pycache__"))
    if left:
        (tmp_path / left).mkdir(parents=True)
        (tmp_path / left / "queries.cpython-313.pyc").write_bytes(b"")
    code = "import __spark_entry__ as e; print(len(e.queries()), 'pipeline' in e.queries())"
    run = subprocess.run([sys.executable, "-c", code], cwd=tmp_path, capture_output=True, text=True, timeout=120)
    assert run.returncode == 0, run.stderr
    count, pipeline = run.stdout.split()
    assert int(count) >= 44 and pipeline == "False"
