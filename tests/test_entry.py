"""What is left where the subpackage and the pipeline are gone."""

import os
import shutil
import subprocess
import sys

import pytest

ROOT = os.path.dirname(os.path.dirname(os.path.abspath(__file__)))


@pytest.fixture
def rest(tmp_path):
    shutil.copytree(ROOT, tmp_path / "r", ignore=shutil.ignore_patterns(".git", "llm", "corpus_pipeline.py", "spark-warehouse", "__pycache__"))
    return tmp_path / "r"


def only(rest):
    """The environment with the copy first on the path, and without this repository on it."""
    others = [p for p in os.environ.get("PYTHONPATH", "").split(os.pathsep) if p and os.path.realpath(p) != os.path.realpath(ROOT)]
    return {**os.environ, "PYTHONPATH": os.pathsep.join([str(rest), *others])}


def said(rest, *command):
    run = subprocess.run([sys.executable, *command], cwd=rest, env=only(rest), capture_output=True, text=True)
    assert run.returncode == 0, run.stdout + run.stderr
    return run.stdout


def test_all_other_tests_can_be_collected_and_some_run(rest):
    assert "error" not in said(rest, "-m", "pytest", "tests", "--collect-only", "-q").lower().replace("errors", "")
    assert "passed" in said(rest, "-m", "pytest", "tests/test_queries.py", "-q", "-k", "missing_companies or company_list")


def test_errors_inside_the_subpackage_are_not_hidden(rest):
    os.makedirs(rest / "corvane" / "llm")
    (rest / "corvane" / "llm" / "__init__.py").write_text("")
    (rest / "corvane" / "llm" / "queries.py").write_text("import no_such_module\n")
    (rest / "corpus_pipeline.py").write_text("")
    run = subprocess.run([sys.executable, "-c", "import __spark_entry__"], cwd=rest, env=only(rest), capture_output=True, text=True)
    assert run.returncode and "no_such_module" in run.stderr
