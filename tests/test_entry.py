"""The entry file with and without the subpackage for corpora."""

import shutil
import subprocess
import sys
from pathlib import Path

import pytest

ROOT = Path(__file__).resolve().parent.parent
NAMES = "import __spark_entry__ as e; print(*sorted(e.queries())); print(*sorted(e.oracle_sql()))"


def names(folder):
    done = subprocess.run([sys.executable, "-c", NAMES], cwd=folder, capture_output=True, text=True, timeout=120)
    return done.returncode, done.stdout.split("\n")[:2], done.stderr


@pytest.fixture
def copy(tmp_path):
    left_out = shutil.ignore_patterns("llm", "corpus_pipeline.py", "__pycache__")
    shutil.copytree(ROOT / "reviewmill", tmp_path / "reviewmill", ignore=left_out)
    shutil.copy(ROOT / "__spark_entry__.py", tmp_path)
    return tmp_path


def test_review_queries_do_without_the_corpus_part(copy):
    code, (queries, oracles), error = names(copy)
    assert code == 0, error
    assert set(queries.split()) == set(oracles.split()) and "summary_counts" in queries.split()
    assert not any(q.startswith("op") or q == "pipeline" for q in queries.split() if q != "overview_counts")


def test_a_pipeline_without_its_operators_is_not_read(copy):
    (copy / "corpus_pipeline.py").write_text("raise RuntimeError('not to be imported')\n")
    assert names(copy)[0] == 0


def test_broken_operators_are_not_passed_over(copy):
    (copy / "reviewmill" / "llm").mkdir()
    (copy / "reviewmill" / "llm" / "__init__.py").write_text("")
    (copy / "reviewmill" / "llm" / "entries.py").write_text("import no_such_module_anywhere\n")
    code, _, error = names(copy)
    assert code != 0 and "no_such_module_anywhere" in error
