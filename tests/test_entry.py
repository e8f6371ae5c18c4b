"""The library and its entry file without the optional package."""

import shutil
import subprocess
import sys
from pathlib import Path

ROOT = Path(__file__).resolve().parent.parent

SCRIPT = """
import __spark_entry__ as e
from checks.queries import QUERIES
from checks.sql import SQL
assert set(e.queries()) == set(QUERIES), set(e.queries()) ^ set(QUERIES)
assert set(e.oracle_sql()) == set(SQL)
"""


def _copy(tmp_path, *left_out):
    names = {"tablemend", "checks", "tests", "__spark_entry__.py", "corpus_pipeline.py"}
    for name in names - set(left_out):
        source = ROOT / name
        if source.is_dir():
            shutil.copytree(source, tmp_path / name, ignore=shutil.ignore_patterns("llm", "__pycache__"))
        elif source.exists():
            shutil.copy(source, tmp_path / name)


def _run(folder):
    return subprocess.run([sys.executable, "-c", SCRIPT], cwd=folder, capture_output=True, text=True, timeout=120)


def test_entry_without_the_optional_package(tmp_path):
    _copy(tmp_path)
    done = _run(tmp_path)
    assert done.returncode == 0, done.stderr


def test_entry_without_the_optional_package_and_the_pipeline(tmp_path):
    _copy(tmp_path, "corpus_pipeline.py")
    done = _run(tmp_path)
    assert done.returncode == 0, done.stderr


def test_an_error_in_the_optional_package_is_not_hidden(tmp_path):
    _copy(tmp_path)
    (tmp_path / "tablemend" / "llm").mkdir()
    (tmp_path / "tablemend" / "llm" / "__init__.py").write_text("")
    (tmp_path / "tablemend" / "llm" / "queries.py").write_text("import no_such_module")
    done = _run(tmp_path)
    assert done.returncode != 0
    assert "no_such_module" in done.stderr
