"""Functions reach workers that don't have the package."""

import os
import subprocess
import sys
from pathlib import Path

import pytest

REPO = str(Path(__file__).resolve().parents[2])
RUN = """
import sys
sys.path.insert(0, {repo!r})
import __spark_entry__ as entry
from harborline.session import get_session
spark = get_session("workers", "local[4]", **{{"spark.sql.shuffle.partitions": "4", "spark.ui.showConsoleProgress": "false"}})
print("rows", entry.queries()[{name!r}](spark, "/root/testdata/sf0.001").count())
"""


@pytest.mark.parametrize("name", ["p2_found", "p2_masked", "p8_found", "p9_shares", "p10_found"])
def test_without_the_package(name, tmp_path):
    env = {k: v for k, v in os.environ.items() if k != "PYTHONPATH"}
    done = subprocess.run([sys.executable, "-c", RUN.format(repo=REPO, name=name)], cwd=tmp_path, env=env, capture_output=True, text=True, timeout=300)
    assert "rows" in done.stdout, done.stderr[-2000:]
