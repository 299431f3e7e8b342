"""The warehouse stands without the optional subpackage and the pipeline made of it."""

import os
import shutil
import subprocess
import sys

import pytest

ROOT = os.path.dirname(os.path.dirname(os.path.abspath(__file__)))
LIST_AND_RUN = """
import __spark_entry__ as e
from orderloom.session import local_session
names = sorted(e.queries())
assert "brand_topn" in names and not [n for n in names if n.startswith("op") or n == "pipeline"], names
assert set(e.oracle_sql()) <= set(names)
spark = local_session(2, "export")
print("ROWS", e.queries()["dim_latest"](spark, "/root/testdata/sf0.001").count(), len(names))
"""


@pytest.mark.parametrize("gone", [(), ("corpus_pipeline.py",)])
def test_without_llm(tmp_path, gone):
    left_out = shutil.ignore_patterns(".git", "llm", "__pycache__", ".pytest_cache", *gone)
    shutil.copytree(ROOT, tmp_path / "export", ignore=left_out)
    env = os.environ | {"PYTHONPATH": "", "SPARK_LOCAL_IP": "127.0.0.1"}
    done = subprocess.run([sys.executable, "-c", LIST_AND_RUN], cwd=tmp_path / "export", env=env, capture_output=True, text=True)
    assert done.returncode == 0, done.stderr[-2000:]
    rows, names = done.stdout.split("ROWS")[1].split()
    assert int(rows) > 0 and int(names) > 40
