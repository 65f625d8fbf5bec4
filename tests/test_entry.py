"""The driver's contract, with and without the subpackage for training text."""

import shutil
import subprocess
import sys
from pathlib import Path

REPO = Path(__file__).resolve().parents[1]


def test_names_match():
    import __spark_entry__ as e

    assert set(e.oracle_sql()) <= set(e.queries()) and "latest_snapshot" in e.queries()


def test_the_rest_stands_alone(tmp_path):
    shutil.copytree(REPO / "siltstone", tmp_path / "siltstone", ignore=shutil.ignore_patterns("llm", "__pycache__"))
    shutil.copy(REPO / "__spark_entry__.py", tmp_path)
    said = subprocess.run([sys.executable, "-c", "import __spark_entry__ as e; print(len(e.queries()), sum(n.startswith('op') for n in e.queries()), 'pipeline' in e.queries())"], cwd=tmp_path, capture_output=True, text=True)
    assert said.returncode == 0, said.stderr
    n, ops, pipeline = said.stdout.split()
    assert int(n) > 60 and ops == "0" and pipeline == "False"


def test_a_missing_library_takes_only_the_training_text_along():
    script = "import sys; sys.modules['public_tokenizers'] = None; import __spark_entry__ as e; print(len(e.queries()), 'pipeline' in e.queries(), len(e.oracle_sql()))"
    said = subprocess.run([sys.executable, "-c", script], cwd=REPO, capture_output=True, text=True)
    assert said.returncode == 0, said.stderr
    n, pipeline, oracles = said.stdout.split()
    assert int(n) > 60 and pipeline == "False" and int(oracles) > 60
