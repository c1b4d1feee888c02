"""The entry works in a copy that has neither the training-data folders nor their pipeline."""

import os
import shutil
import subprocess
import sys

ROOT = os.path.dirname(os.path.dirname(os.path.abspath(__file__)))


def _imported(folder):
    code = "import __spark_entry__ as e; print(len(e.queries()), len(e.oracle_sql()), any(n.startswith('op') for n in e.queries()))"
    env = {k: v for k, v in os.environ.items() if k != "PYTHONPATH"}
    out = subprocess.run([sys.executable, "-c", code], cwd=folder, env=env, capture_output=True, text=True, check=True)
    return out.stdout.split()


def test_entry_without_the_training_data_folders(tmp_path):
    copy = tmp_path / "copy"
    skip = shutil.ignore_patterns("llm", ".git", "__pycache__", ".pytest_cache", ".hypothesis")
    shutil.copytree(ROOT, copy, ignore=skip)
    with_pipeline = _imported(copy)  # the pipeline's file alone is not enough
    assert with_pipeline[0] == with_pipeline[1] and int(with_pipeline[0]) >= 56 and with_pipeline[2] == "False"
    bare = tmp_path / "bare"
    shutil.copytree(copy, bare, ignore=shutil.ignore_patterns("corpus_pipeline.py", "__pycache__"))
    assert _imported(bare) == with_pipeline
