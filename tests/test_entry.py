"""The entry point without the text operators."""

from __future__ import annotations

import subprocess
import sys
from pathlib import Path

import pytest

ROOT = Path(__file__).resolve().parent.parent
TRY = """
import sys
class Missing:
    def find_spec(self, name, path=None, target=None):
        if name in {names!r}:
            raise ModuleNotFoundError("No module named " + name, name=name)
sys.meta_path.insert(0, Missing())
import __spark_entry__ as entry
print(len(entry.queries()), sum(n.startswith("op") for n in entry.queries()), len(entry.oracle_sql()))
"""


@pytest.mark.parametrize("names", [("retailmart.llm",), ("corpus_pipeline",), ("ahocorasick",), ("xxhash",)])
def test_retail_queries_stand_alone(names):
    code = TRY.format(names=names)
    run = subprocess.run([sys.executable, "-c", code], cwd=ROOT, capture_output=True, text=True, timeout=120)
    assert run.returncode == 0, run.stderr
    every, text, sql = map(int, run.stdout.split())
    assert every > 200 and text == 0 and sql == every
    if (ROOT / "corpus_pipeline.py").exists() and (ROOT / "retailmart" / "llm").exists():
        assert ("left out" in run.stderr) == (names[0] in ("ahocorasick", "xxhash"))
