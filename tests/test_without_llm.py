"""The library without its optional parts."""

import os
import shutil
import subprocess
import sys

ROOT = os.path.dirname(os.path.dirname(os.path.abspath(__file__)))


def test_queries_without_the_training_data_operators(tmp_path):
    """A copy without those folders, with and without the pipeline's file beside it."""
    copy = tmp_path / "copy"
    shutil.copytree(ROOT, copy, ignore=shutil.ignore_patterns(".git", "llm", "__pycache__", "tests"))
    code = "import __spark_entry__ as e; print(len(e.queries()), len(e.oracle_sql()), [n for n in e.queries() if n.startswith('op') and n != 'output_size'])"
    for present in (True, False):
        if not present:
            (copy / "corpus_pipeline.py").unlink(missing_ok=True)
        done = subprocess.run([sys.executable, "-c", code], cwd=copy, capture_output=True, text=True, timeout=120)
        assert done.returncode == 0, done.stderr
        assert done.stdout.strip() == "39 39 []"
