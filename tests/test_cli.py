"""The command line runs the whole pipeline in its own Spark application."""

from __future__ import annotations

import os
import subprocess
import sys

from tests.conftest import ROOT


def test_cli_run_and_waterfall(raw_small, tmp_path):
    from tillroll.sources.sinks import write_raw_csv

    raw = str(tmp_path / "raw")
    write_raw_csv(raw_small, raw)
    env = dict(os.environ, PYTHONPATH=ROOT, PYSPARK_SUBMIT_ARGS="--master local[2] pyspark-shell")
    run = subprocess.run(
        [sys.executable, "-m", "tillroll", "run", "--raw", raw, "--cleaned", str(tmp_path / "clean"),
         "--results", str(tmp_path / "res"), "--result-format", "parquet"],
        env=env, cwd=ROOT, capture_output=True, text=True, timeout=600,
    )
    assert run.returncode == 0, run.stderr[-2000:]
    assert os.path.exists(tmp_path / "res" / "rfm_segments" / "_SUCCESS")
    wf = subprocess.run(
        [sys.executable, "-m", "tillroll", "waterfall", "--raw", raw, "--out", str(tmp_path / "wf")],
        env=env, cwd=ROOT, capture_output=True, text=True, timeout=600,
    )
    assert wf.returncode == 0, wf.stderr[-2000:]
    bad = subprocess.run(
        [sys.executable, "-m", "tillroll", "run", "--raw", str(tmp_path / "missing"),
         "--cleaned", str(tmp_path / "c2"), "--results", str(tmp_path / "r2")],
        env=env, cwd=ROOT, capture_output=True, text=True, timeout=600,
    )
    assert bad.returncode == 1
