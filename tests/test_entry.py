"""The driver's entry in a copy of the repository that lacks the training-data operators."""

import shutil
import subprocess
import sys
from pathlib import Path

import pytest

ROOT = Path(__file__).resolve().parents[1]
RUN = """
import __spark_entry__ as entry
from faultline.session import local_session

assert not [q for q in entry.queries() if q.startswith("op") or q == "pipeline"]
assert set(entry.oracle_sql()) <= set(entry.queries())
spark = local_session("2", partitions=2)
print(entry.entry(spark).count())
"""


@pytest.mark.parametrize("gone", [["llm"], ["llm", "corpus_pipeline.py"]])
def test_entry_without_the_subpackage(tmp_path, gone):
    shutil.copytree(ROOT / "faultline", tmp_path / "faultline", ignore=shutil.ignore_patterns("llm", "__pycache__"))
    for file in ("__spark_entry__.py", "corpus_pipeline.py"):
        if file not in gone and (ROOT / file).exists():
            shutil.copy(ROOT / file, tmp_path)
    done = subprocess.run([sys.executable, "-c", RUN], cwd=tmp_path, capture_output=True, text=True, timeout=300)
    assert done.returncode == 0 and int(done.stdout.split()[-1]) > 0, done.stderr[-2000:]
