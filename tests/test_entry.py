"""The entry without the part for training text, or without a library that only it needs."""

import os
import subprocess
import sys

import pytest

ROOT = os.path.dirname(os.path.dirname(os.path.abspath(__file__)))


@pytest.mark.parametrize("missing", ["ahocorasick", "candlewright.llm", "corpus_pipeline"])
def test_other_queries_stay_when_the_text_part_cannot_be_imported(missing):
    code = (
        f"import sys; sys.path.insert(0, {ROOT!r}); sys.modules[{missing!r}] = None\n"
        "import __spark_entry__ as entry\n"
        "from workload.queries import QUERIES\n"
        "assert entry.queries().keys() == QUERIES.keys() and entry.oracle_sql()"
    )
    done = subprocess.run([sys.executable, "-W", "ignore", "-c", code], capture_output=True, text=True)
    assert done.returncode == 0, done.stderr
