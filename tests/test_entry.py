from __future__ import annotations

import os
import shutil
import subprocess
import sys

ROOT = os.path.dirname(os.path.dirname(os.path.abspath(__file__)))
LIST = "import __spark_entry__ as e; print(*sorted(e.queries())); assert set(e.oracle_sql()) <= set(e.queries())"


def listed(root: str) -> set[str]:
    out = subprocess.run([sys.executable, "-c", LIST], cwd=root, env={**os.environ, "PYTHONPATH": root}, capture_output=True, text=True, check=True)
    return set(out.stdout.split())


def test_entry_without_the_text_operators(tmp_path):
    """The entry lists the core's queries whichever of the optional parts are there."""
    core = {q for q in listed(ROOT) if q != "pipeline" and not (q.startswith("op") and q[2].isdigit())}
    for k, gone in enumerate((("tillroll/llm",), ("tillroll/llm", "corpus_pipeline.py"))):
        copy = str(tmp_path / str(k))
        shutil.copytree(ROOT, copy, ignore=lambda folder, names: [n for n in names if n in (".git", "__pycache__") or os.path.relpath(os.path.join(folder, n), ROOT) in gone])
        assert listed(copy) == core
