"""The entry module in a copy of the repository without the corpus operators."""

from __future__ import annotations

import shutil
import subprocess
import sys
from pathlib import Path

import pytest

ROOT = Path(__file__).resolve().parents[1]

LOAD = """
import __spark_entry__ as entry
names = entry.queries()
assert "high_low_metric_full" in names and not [n for n in names if n.startswith("op") and n[2:3].isdigit()], sorted(names)
assert "pipeline" not in names
assert set(entry.oracle_sql()) <= set(names)
"""

RUN = LOAD + """
from streakline.session import build_session
spark = build_session("local[2]", "entry", **{"spark.ui.enabled": "false", "spark.sql.shuffle.partitions": "2"})
assert names["dim_high_low"](spark, "/root/testdata/sf0.001").count() == 5
"""


@pytest.mark.parametrize("with_pipeline, script", [(True, RUN), (False, LOAD)])
def test_entry_without_the_corpus_operators(tmp_path, with_pipeline, script):
    for name in ("streakline", "catalog"):
        shutil.copytree(ROOT / name, tmp_path / name, ignore=shutil.ignore_patterns("llm", "__pycache__"))
    files = ["__spark_entry__.py"] + ["corpus_pipeline.py"] * (with_pipeline and (ROOT / "corpus_pipeline.py").exists())
    for name in files:
        shutil.copy(ROOT / name, tmp_path / name)
    done = subprocess.run([sys.executable, "-c", script], cwd=tmp_path, capture_output=True, text=True, timeout=180)
    assert done.returncode == 0, done.stderr[-2000:]
