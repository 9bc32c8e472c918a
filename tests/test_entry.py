"""The entry without the training-data part: the sales queries must stand alone."""

import os
import shutil
import subprocess
import sys

REPO = os.path.dirname(os.path.dirname(os.path.abspath(__file__)))

PROBE = """
import sys
sys.path.insert(0, ".")
import __spark_entry__ as E
found = set(E.queries())
assert found == set(E.oracle_sql()) == set(E.QUERIES), found ^ set(E.oracle_sql())
assert len(found) >= 40 and "pipeline" not in found
print("stands alone")
"""


def run_without(tmp_path, *gone):
    copy = tmp_path / "repo"
    shutil.copytree(REPO, copy, ignore=lambda at, names: [n for n in names if n in (".git", "__pycache__")
                                                          or os.path.relpath(os.path.join(at, n), REPO) in gone])
    out = subprocess.run([sys.executable, "-c", PROBE], cwd=copy, capture_output=True, text=True)
    assert out.stdout.strip() == "stands alone", out.stderr


def test_without_the_subpackage_and_pipeline(tmp_path):
    run_without(tmp_path, "ledgerline/llm", "tests/llm", "corpus_pipeline.py")


def test_without_the_subpackage_alone(tmp_path):
    run_without(tmp_path, "ledgerline/llm", "tests/llm")


def test_without_the_pipeline_alone(tmp_path):
    run_without(tmp_path, "corpus_pipeline.py")
