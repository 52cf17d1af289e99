"""The entry point without the training-data subpackage or a library that it needs."""

import os
import subprocess
import sys

import pytest

HERE = os.path.dirname(os.path.dirname(os.path.abspath(__file__)))
PROBE = """
import sys, warnings
warnings.simplefilter("ignore")
for name in {blocked!r}:
    sys.modules[name] = None  # importing it raises ImportError
import __spark_entry__ as entry
from regiocast.registry import QUERIES
assert set(QUERIES) <= set(entry.queries()) and set(entry.oracle_sql()) <= set(entry.queries())
print(len(entry.queries()) - len(QUERIES))
"""


@pytest.mark.parametrize("blocked", [["regiocast.llm"], ["regiocast.llm.queries"], ["xxhash", "ahocorasick"], ["corpus_pipeline"]])
def test_core_queries_are_there_alike(blocked):
    run = subprocess.run([sys.executable, "-c", PROBE.format(blocked=blocked)], cwd=HERE, capture_output=True, text=True, timeout=120)
    assert run.returncode == 0, run.stderr
    if blocked != ["corpus_pipeline"]:
        assert run.stdout.strip() == "0" or blocked == ["xxhash", "ahocorasick"]
