"""The entry point with and without the text operators."""

from __future__ import annotations

import os
import shutil
import subprocess
import sys

import pytest

ROOT = os.path.dirname(os.path.dirname(os.path.abspath(__file__)))
NAMES = "import __spark_entry__ as e; print(*sorted(e.queries())); print(*sorted(set(e.oracle_sql()) - set(e.queries())))"


def names(folder):
    """The queries that a copy of the tree registers, read in a process of its own."""
    environment = {**os.environ, "PYTHONPATH": str(folder), "PYTHONDONTWRITEBYTECODE": "1"}
    run = subprocess.run([sys.executable, "-c", NAMES], cwd=folder, env=environment, capture_output=True, text=True, timeout=120)
    if run.returncode:
        raise ImportError(run.stderr)
    found, alone = run.stdout.split("\n")[:2]
    assert alone == ""
    return found.split()


def copied(folder, *without):
    kept = shutil.ignore_patterns(".git", "tests", "__pycache__", *without)
    shutil.copytree(ROOT, folder, ignore=kept)
    return folder


def test_without_the_text_operators(tmp_path):
    for left in (("llm",), ("llm", "corpus_pipeline.py")):
        found = names(copied(tmp_path / str(len(left)), *left))
        assert len(found) >= 81 and not [n for n in found if n.startswith("op") or n == "pipeline"]


def test_an_error_inside_the_text_operators_shows(tmp_path):
    folder = copied(tmp_path / "copy")
    module = folder / "sparkclaims" / "llm" / "queries.py"
    if not module.exists():
        pytest.skip("no text operators here")
    module.write_text("import no_such_module\n")
    with pytest.raises(ImportError, match="no_such_module"):
        names(folder)
