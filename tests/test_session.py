"""Scratch tables of overlapping runs and of standalone calls."""

from __future__ import annotations

import os
import subprocess
import sys
import threading

from tests.conftest import ROOT
from tillroll.session import materialize, scratch_scope


def test_overlapping_scopes_keep_their_own_tables(spark):
    opened, closed = threading.Event(), threading.Event()
    seen = {}

    def first():
        with scratch_scope(spark) as paths:
            table = materialize(spark.range(5), "first")
            opened.set()
            closed.wait(60)
            late = materialize(spark.range(7), "first")
            seen["rows"] = (table.count(), late.count())
            seen["first"] = list(paths)

    worker = threading.Thread(target=first)
    worker.start()
    opened.wait(60)
    with scratch_scope(spark) as paths:
        materialize(spark.range(3), "second")
        second = list(paths)
    closed.set()
    worker.join()
    assert seen["rows"] == (5, 7)
    assert len(second) == 1 and len(seen["first"]) == 2
    assert not any(os.path.exists(p.removeprefix("file:")) for p in second + seen["first"])


def test_standalone_tables_go_with_the_application(tmp_path):
    code = (
        "from tillroll.session import build_session, materialize\n"
        "s = build_session(master='local[1]', extra_conf={'spark.ui.enabled': 'false'})\n"
        f"s.sparkContext.setCheckpointDir({str(tmp_path)!r})\n"
        "print(materialize(s.range(3), 't').inputFiles()[0])\n"
        "s.stop()\n"
    )
    run = subprocess.run([sys.executable, "-c", code], cwd=ROOT, env=dict(os.environ, PYTHONPATH=ROOT),
                         capture_output=True, text=True, timeout=300)
    assert run.returncode == 0, run.stderr[-2000:]
    left = [f for _, _, files in os.walk(tmp_path) for f in files]
    assert left == []
