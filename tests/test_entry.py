"""The entry module works without the training-data folders."""

import os
import shutil
import subprocess
import sys

ROOT = os.path.dirname(os.path.dirname(os.path.abspath(__file__)))


def test_entry_without_training_data(tmp_root):
    copy = f"{tmp_root}/repo"
    shutil.copytree(ROOT, copy, ignore=lambda d, names: {n for n in names if n in ("llm", "corpus_pipeline.py", ".git", "__pycache__")})
    code = "import __spark_entry__ as e; q, s = e.queries(), e.oracle_sql(); assert set(s) == set(q) and 'fact_sales' in q; print(len(q))"
    for leftover in (False, True):
        if leftover:
            os.makedirs(f"{copy}/martforge/llm/__pycache__")
        run = subprocess.run([sys.executable, "-B", "-c", code], cwd=copy, capture_output=True, text=True, timeout=120,
                             env={k: v for k, v in os.environ.items() if k != "PYTHONPATH"})
        assert run.returncode == 0, run.stderr[-800:]
