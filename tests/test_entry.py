"""The library without the folders of the training-data operators."""

import shutil
import subprocess
import sys
from pathlib import Path

import pytest

ROOT = Path(__file__).resolve().parents[1]
SCRIPT = """
import __spark_entry__ as e
from evalloom.plans import ORACLE, QUERIES
assert e.queries().keys() == QUERIES.keys() and e.oracle_sql().keys() == ORACLE.keys(), sorted(e.queries())
print(len(e.queries()))
"""


@pytest.mark.parametrize("pipeline", [True, False])
def test_without_the_training_data_operators(tmp_path, pipeline):
    """Every other query is there, whether the pipeline that needs the operators is still there or gone with them."""
    copy = tmp_path / "copy"
    shutil.copytree(ROOT / "evalloom", copy / "evalloom", ignore=shutil.ignore_patterns("llm", "__pycache__"))
    for name in ["__spark_entry__.py", *(["corpus_pipeline.py"] if pipeline else [])]:
        if (ROOT / name).exists():
            shutil.copy(ROOT / name, copy)
    done = subprocess.run([sys.executable, "-c", SCRIPT], cwd=copy, capture_output=True, text=True, timeout=120)
    assert done.returncode == 0, done.stderr
    assert int(done.stdout) >= 124


def test_other_missing_modules_are_errors(tmp_path):
    copy = tmp_path / "copy"
    shutil.copytree(ROOT / "evalloom", copy / "evalloom", ignore=shutil.ignore_patterns("llm", "__pycache__"))
    shutil.copy(ROOT / "__spark_entry__.py", copy)
    (copy / "corpus_pipeline.py").write_text("import some_other_module\n")
    done = subprocess.run([sys.executable, "-c", SCRIPT], cwd=copy, capture_output=True, text=True, timeout=120)
    assert done.returncode != 0 and "some_other_module" in done.stderr
