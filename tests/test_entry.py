"""The entry offers what can be imported, whatever else is missing."""

import subprocess
import sys
from pathlib import Path

import pytest

ROOT = str(Path(__file__).parent.parent)


@pytest.mark.parametrize("missing", ["olapkit.llm", "corpus_pipeline", "tokenizers", "public_tokenizers"])
def test_other_queries_stay_when_something_is_missing(missing):
    code = f"""
import sys
sys.path.insert(0, {ROOT!r})
sys.modules[{missing!r}] = None
import __spark_entry__ as e
from olapkit.registry import QUERIES
assert set(QUERIES) <= set(e.queries()) and len(QUERIES) > 150
assert set(e.oracle_sql()) <= set(e.queries())
print("pipeline" in e.queries())
"""
    done = subprocess.run([sys.executable, "-W", "always", "-c", code], capture_output=True, text=True, timeout=120)
    assert done.returncode == 0, done.stderr
    assert "False" in done.stdout and "without" in done.stderr and missing.split(".")[-1] in done.stderr
