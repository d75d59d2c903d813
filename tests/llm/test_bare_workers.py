"""Operators on executors that can't import the package."""

from __future__ import annotations

import os
import subprocess
import sys
from pathlib import Path

ROOT = Path(__file__).resolve().parents[2]

SCRIPT = """
import sys
sys.path.insert(0, {root!r})  # of the driver alone: workers don't see it
from tallyloom.session import build_session
from tallyloom.llm import registered
spark = build_session("bare", "local[2]", **{{"spark.sql.shuffle.partitions": 2, "spark.ui.enabled": "false"}})

def missing(parts):
    try:
        import tallyloom
    except ModuleNotFoundError:
        return iter([1])
    return iter([0])

assert spark.sparkContext.parallelize([0], 1).mapPartitions(missing).collect() == [1]
for name in ("op1_language_id", "op8_quality", "op11_spelling_variants", "op12_whitening", "op13_pieces"):
    assert registered.queries()[name](spark, "/root/testdata/sf0.001").count() > 0, name
print("all ran")
"""


def test_models_travel_with_their_classes(tmp_path):
    script = tmp_path / "bare.py"
    script.write_text(SCRIPT.format(root=str(ROOT)))
    env = {k: v for k, v in os.environ.items() if k != "PYTHONPATH"}
    done = subprocess.run([sys.executable, str(script)], cwd=tmp_path, env=env, capture_output=True, text=True, timeout=600)
    assert "all ran" in done.stdout, done.stderr[-2000:]
