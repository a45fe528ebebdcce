"""The entry points with and without the parts that may be absent."""

import os
import shutil
import subprocess
import sys

import pytest

from workload.queries import QUERIES

ROOT = os.path.dirname(os.path.dirname(os.path.abspath(__file__)))


def names_in(folder, before=""):
    """Names of all queries that a fresh interpreter finds in a copy of the repository, and what it logs."""
    code = f"{before}\nimport __spark_entry__ as e; print('\\n'.join(e.queries())); assert set(e.oracle_sql()) <= set(e.queries())"
    env = {k: v for k, v in os.environ.items() if k != "PYTHONPATH"}
    done = subprocess.run([sys.executable, "-c", code], cwd=folder, env=env, capture_output=True, text=True, check=False)
    assert done.returncode == 0, done.stderr
    return set(done.stdout.split()), done.stderr


@pytest.mark.parametrize("pipeline", [True, False])
def test_without_the_optional_folders(tmp_path, pipeline):
    left_out = shutil.ignore_patterns("llm", "__pycache__", ".git", *([] if pipeline else ["corpus_pipeline.py"]))
    shutil.copytree(ROOT, tmp_path / "copy", ignore=left_out)
    found, log = names_in(tmp_path / "copy")
    assert found == set(QUERIES)
    assert "left out cityloom.llm.queries" in log


def test_without_a_package_that_the_optional_part_needs(tmp_path):
    shutil.copytree(ROOT, tmp_path / "copy", ignore=shutil.ignore_patterns("__pycache__", ".git"))
    if not os.path.isdir(tmp_path / "copy/cityloom/llm"):
        pytest.skip("the optional part is absent")
    found, log = names_in(tmp_path / "copy", "import sys; sys.modules['xxhash'] = None")
    assert found == set(QUERIES) and "xxhash" in log


def test_queries_of_the_rest_come_first():
    found, _ = names_in(ROOT)
    assert set(QUERIES) <= found
