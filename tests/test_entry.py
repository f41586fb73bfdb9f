"""The entry module loads without the optional queries, or without what they need."""

import subprocess
import sys
from pathlib import Path

import pytest

ROOT = Path(__file__).resolve().parents[1]
LOAD = """
import sys
sys.modules.update(dict.fromkeys(sys.argv[1:]))
import __spark_entry__ as entry
print(len(entry.queries()), len(entry.QUERIES), all(k in entry.queries() for k in entry.oracle_sql()))
"""


@pytest.mark.parametrize("missing", [
    ["public_tokenizers"], ["xxhash"], ["corpus_pipeline"], ["cityviews.llm"], ["cityviews.llm.queries"]])
def test_queries_load_without(missing):
    found = subprocess.run(
        [sys.executable, "-c", LOAD, *missing], cwd=ROOT, capture_output=True, text=True, timeout=120)
    assert found.returncode == 0, found.stderr
    n, own, known = found.stdout.split()
    assert n == own and known == "True"
