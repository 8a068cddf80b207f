"""The driver's contract without the optional parts."""

import os
import shutil
import subprocess
import sys

ROOT = os.path.dirname(os.path.dirname(os.path.abspath(__file__)))
TELL = "import __spark_entry__ as e; print('NAMES', *sorted(e.queries())); print('SQL', len(e.oracle_sql()))"


def names(folder):
    said = subprocess.run([sys.executable, "-c", TELL], cwd=folder, env={**os.environ, "PYTHONPATH": ""}, capture_output=True, text=True, check=True)
    return said.stdout.split("NAMES")[1].split("SQL")[0].split()


def copied(tmp_path, *left_out):
    for part in ("__spark_entry__.py", "corpus_pipeline.py"):
        if part not in left_out:
            shutil.copy(os.path.join(ROOT, part), tmp_path)
    for part in ("checks", "corpus_engine"):
        shutil.copytree(os.path.join(ROOT, part), tmp_path / part, ignore=shutil.ignore_patterns("__pycache__", *left_out))
    return str(tmp_path)


def test_without_the_training_data_operators_and_their_pipeline(tmp_path):
    found = names(copied(tmp_path, "llm", "corpus_pipeline.py"))
    assert "discovery_review" in found and "study_run" in found and "pipeline" not in found
    assert not any(n.startswith("op") and n[2].isdigit() for n in found)


def test_the_pipeline_alone_is_left_out_with_the_operators(tmp_path):
    found = names(copied(tmp_path, "llm"))
    assert "discovery_review" in found and "pipeline" not in found
