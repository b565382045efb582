"""The entry points without the optional parts of the repository."""

import pathlib
import shutil
import subprocess
import sys

import pytest

REPO = pathlib.Path(__file__).resolve().parent.parent
OPTIONAL = ("layerforge/llm", "tests/llm", "corpus_pipeline.py")
LISTED = "import __spark_entry__ as e; print(len(e.queries()), len(e.oracle_sql()), any(n.startswith('op') for n in e.queries()))"


@pytest.mark.parametrize("gone", [OPTIONAL, OPTIONAL[:2], OPTIONAL[2:]])
def test_the_rest_imports_without_optional_parts(tmp_path, gone):
    copy = tmp_path / "repo"
    left_out = {str(REPO / p) for p in gone}

    def leave_out(folder, names):
        return [n for n in names if n in (".git", "__pycache__") or str(pathlib.Path(folder) / n) in left_out]

    shutil.copytree(REPO, copy, ignore=leave_out)
    out = subprocess.run([sys.executable, "-W", "ignore", "-c", LISTED], cwd=copy, capture_output=True, text=True, check=True)
    from layerforge.workload import queries

    n, n_sql, has_operators = out.stdout.split()
    assert int(n) >= len(queries.queries()) and int(n_sql) >= len(queries.queries())
    if "layerforge/llm" in gone:
        assert (int(n), has_operators) == (len(queries.queries()), "False")


def test_nothing_outside_imports_the_optional_package():
    for file in (REPO / "layerforge").rglob("*.py"):
        if "llm" not in file.relative_to(REPO).parts:
            assert "layerforge.llm" not in file.read_text()
