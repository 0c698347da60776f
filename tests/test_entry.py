"""The entry module works without the optional subpackage, and only its absence is passed over."""

import shutil
import subprocess
import sys
from pathlib import Path

REPO = Path(__file__).resolve().parent.parent
SAY = "import __spark_entry__ as e; print(len(e.queries()), len(e.oracle_sql()), any(n.startswith('op') or n == 'pipeline' for n in e.queries()))"


def copied(tmp_path):
    shutil.copytree(REPO / "gatelens", tmp_path / "gatelens", ignore=shutil.ignore_patterns("llm", "__pycache__"))
    shutil.copy(REPO / "__spark_entry__.py", tmp_path)
    return tmp_path


def run(folder):
    return subprocess.run([sys.executable, "-c", SAY], cwd=folder, capture_output=True, text=True, timeout=120)


def test_without_the_subpackage(tmp_path):
    from gatelens.plans.queries import QUERIES

    done = run(copied(tmp_path))
    assert done.stdout.split() == [str(len(QUERIES)), str(len(QUERIES)), "False"], done.stderr


def test_errors_inside_are_not_passed_over(tmp_path):
    package = copied(tmp_path) / "gatelens" / "llm"
    package.mkdir()
    (package / "__init__.py").write_text("")
    (package / "oracle.py").write_text("import no_such_module")
    assert "no_such_module" in run(tmp_path).stderr
