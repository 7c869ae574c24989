"""The entry file works without the optional subpackage and pipeline."""

from __future__ import annotations

import os
import shutil
import subprocess
import sys

import pytest

from tests.conftest import ROOT


@pytest.mark.parametrize("files", [["__spark_entry__.py"], ["__spark_entry__.py", "corpus_pipeline.py"]])
def test_entry_without_the_optional_parts(tmp_path, files):
    for f in files:
        if os.path.exists(os.path.join(ROOT, f)):
            shutil.copy(os.path.join(ROOT, f), tmp_path)
    shutil.copytree(
        os.path.join(ROOT, "quire"), tmp_path / "quire", ignore=shutil.ignore_patterns("llm", "__pycache__")
    )
    code = "import __spark_entry__ as e; print(len(e.queries()), set(e.oracle_sql()) <= set(e.queries()))"
    # a PYTHONPATH that names the repository would find its subpackage and pipeline
    env = {k: v for k, v in os.environ.items() if k != "PYTHONPATH"}
    out = subprocess.run(
        [sys.executable, "-c", code], cwd=tmp_path, env=env, capture_output=True, text=True, check=True
    )
    n, covered = out.stdout.split()
    assert int(n) > 90 and covered == "True"
    assert not any("quire.llm" in open(os.path.join(d, f)).read()
                   for d, _, fs in os.walk(tmp_path / "quire") for f in fs if f.endswith(".py"))
