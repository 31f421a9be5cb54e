"""The entry module without the text queries: folders gone, or a library of theirs missing."""

import subprocess
import sys
from pathlib import Path

import pytest

ROOT = str(Path(__file__).resolve().parent.parent)
COUNTED = """
import __spark_entry__ as e
from scholaris.plans import catalog
print(set(e.queries()) == set(catalog.QUERIES) == set(e.oracle_sql()), len(e.queries()) > 100)
"""


@pytest.mark.parametrize("missing", ["scholaris.llm", "corpus_pipeline", "public_tokenizers", "zstandard", "tokenizers", "ahocorasick"])
def test_all_other_queries_are_there(missing):
    code = f"import sys; sys.path.insert(0, {ROOT!r}); sys.modules[{missing!r}] = None\n{COUNTED}"
    done = subprocess.run([sys.executable, "-c", code], capture_output=True, text=True, timeout=120)
    assert done.stdout.split() == ["True", "True"], done.stderr[-1000:]
    assert "queries on training text are left out" in done.stderr
