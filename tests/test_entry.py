"""The entry works without the operators for training data."""

import subprocess
import sys
from pathlib import Path

import pytest

HOME = Path(__file__).resolve().parent.parent
CODE = """
import sys
class Gone:
    def find_spec(self, name, *_):
        if name == {gone!r} or name.startswith({gone!r} + "."):
            raise ModuleNotFoundError(name, name=name)
sys.meta_path.insert(0, Gone())
import __spark_entry__ as e
print(len(e.queries()), len(e.oracle_sql()), any(n.startswith("op") for n in e.queries()))
"""


@pytest.mark.parametrize("gone", ["tubetrace.llm", "corpus_pipeline", "tokenizers", "nothing"])
def test_entry(gone):
    done = subprocess.run([sys.executable, "-W", "ignore", "-c", CODE.format(gone=gone)], cwd=HOME,
                          capture_output=True, text=True, check=True, timeout=100)
    queries, oracles, operators = done.stdout.split()
    assert int(queries) >= 82 and int(oracles) >= 82
    present = operators == "True"
    has_llm = (HOME / "tubetrace" / "llm").is_dir()
    assert present == (has_llm and gone in ("corpus_pipeline", "nothing"))
